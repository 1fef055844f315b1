"""Dimension tables: projections of the raw changes and last-write-wins upsert."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from leaseflow import schemas as S
from leaseflow.sources import changes as C


def project(rows: DataFrame, table: str, keep: tuple[str, ...] = ()) -> DataFrame:
    """Stored columns of a dimension, in table order."""
    return rows.select(*[c for c, _ in S.RAW[table]], *keep)


def upsert_latest(rows: DataFrame, keys: list[str], order: list[str],
                  keep_order: bool = False) -> DataFrame:
    """Last row per key in the given order; NULL keys compare equal.

    ``max_by`` combines before the shuffle, so a key with very many changes costs
    one row per task.
    """
    rest = [c for c in rows.columns if c not in keys and c not in order]
    position = F.struct(*order)
    latest = rows.groupBy(*keys).agg(
        F.max_by(F.struct(*rest, *[F.col(o) for o in order if keep_order]), position).alias("_v"))
    out = latest.select(*keys, "_v.*")
    return out.select(*[c for c in rows.columns if c in out.columns])


def dimension_changes(log: DataFrame, table: str, keep: tuple[str, ...] = ("arrival",)) -> DataFrame:
    """Envelope log of a dimension -> typed rows with an image and an id.

    The log is this dimension's own, so a row counts whether or not it names its table
    or operation; rows that name another table, or a deletion, do not.
    """
    rows = C.parse_images(log, table).filter(F.coalesce("table_name", F.lit(table)) == table)
    live = C.live_dim_rows(rows)
    return project(C.decode_after(live, table, keep), table, keep)


def dimension_table(log: DataFrame, table: str) -> DataFrame:
    """Current dimension from its change log. Deleted rows keep their last image."""
    return upsert_latest(dimension_changes(log, table), ["id"], ["arrival"])

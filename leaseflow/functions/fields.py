"""Field access with the null rules of the raw layer, and row-to-JSON."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F, types as T

from leaseflow import schemas as S
from leaseflow.functions import decode as D


def decoded_field(path: Column, kind: str) -> Column:
    """One raw field of an ``after`` image -> its logical value.

    ``*0`` kinds default to zero when missing; all others stay NULL.
    """
    if kind in ("long0", "int0"):
        return F.coalesce(path, F.lit(0).cast(S.KINDS[kind][1]))
    if kind == "wall":
        return D.micros_to_wall(path)
    if kind == "money":
        return D.decode_decimal(path)
    return path


def encoded_field(value: Column, kind: str) -> Column:
    """Inverse of :func:`decoded_field`, used to build envelopes."""
    if kind == "wall":
        return D.wall_to_micros(value)
    if kind == "money":
        return D.encode_decimal(value)
    return value


def parse_once(value: Column | str, schema: T.StructType) -> Column:
    """JSON record as a generator column: one parse per row.

    The record passes through a one-element array, which keeps filters on its fields
    above the parsing; otherwise every pushed-down condition would parse again.
    """
    return F.explode_outer(F.array(F.from_json(value, schema)))


def typed_null(data_type: str) -> Column:
    return F.lit(None).cast(data_type)


def row_count() -> Column:
    """Every row counts one: the unit measure of all window and summary tables."""
    return F.count(F.lit(1))


def to_json_row(columns: list[str], wall: tuple[str, ...] = (), text: tuple[str, ...] = ()) -> Column:
    """Row -> JSON object in the given column order, NULL fields written out.

    ``wall`` columns are written as six-digit wall text, ``text`` columns (the
    amounts) as plain decimal text.
    """
    parts = []
    for name in columns:
        value = F.col(name)
        if name in wall:
            value = D.wall_text(value)
        elif name in text:
            value = value.cast("string")
        parts.append(value.alias(name))
    return F.to_json(F.struct(*parts), {"ignoreNullFields": "false"})


def fact_text(name: str, data_type: T.DataType) -> Column:
    """A fact's column in the form its JSON carries: wall and amount texts, others as they are."""
    value = F.col(name)
    if data_type == S.WALL:
        value = D.wall_text(value)
    elif data_type == S.MONEY:
        value = value.cast("string")
    return value.alias(name)


def _columns_of(fact: str, data_type) -> tuple[str, ...]:
    return tuple(f.name for f in S.FACTS[fact] if f.dataType == data_type)


def fact_json(fact: str, extra: tuple[str, ...] = ()) -> Column:
    """A fact row, and extra columns, as the JSON text its topic carries."""
    return to_json_row([*S.FACTS[fact].names, *extra], wall=_columns_of(fact, S.WALL),
                       text=_columns_of(fact, S.MONEY))


def read_fact_json(text: DataFrame, fact: str, keep: tuple[str, ...] = ()) -> DataFrame:
    """JSON text of a fact topic (``value``) -> typed rows; unknown fields are ignored."""
    as_text = (S.WALL, S.MONEY)
    schema = T.StructType([
        T.StructField(f.name, T.StringType() if f.dataType in as_text else f.dataType)
        for f in S.FACTS[fact]])
    read = text.select(*keep, parse_once("value", schema).alias("_f"))

    def typed(field: T.StructField) -> Column:
        value = F.col(f"_f.{field.name}")
        if field.dataType == S.WALL:
            value = D.parse_wall(value)
        elif field.dataType == S.MONEY:
            value = value.try_cast(S.MONEY)
        return value.alias(field.name)

    return read.select(*keep, *[typed(f) for f in S.FACTS[fact]])

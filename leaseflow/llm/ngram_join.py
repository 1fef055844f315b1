"""N-gram Jaccard self-join by MinHash banding.

Texts become sets of runs of five words. A signature of ``bands`` x ``rows`` minima is made
per text; the counts come from :func:`choose_bands`, which meets a target recall at the
threshold. Texts that share a band hash are candidates, and every candidate pair is verified
on the full sets.

How this stays bounded at any skew:

* texts with the same word sequence are one class, and only its representative goes on, so a
  group of copies costs one row per task;
* band hashes are shuffled as (hash, id) with a smallest-id aggregate, which gives star edges,
  never pairs; their components are candidate families;
* a family is cut into blocks by hash, and each pair of blocks is one unit of work. Pairs are
  compared inside it and leave it as a count per text and one edge per text to the smallest id
  it is connected to. No pair is emitted and none is skipped.

Rules: words are runs of bytes other than ASCII white space and punctuation, A-Z lower-cased
(``breaks``/``fold`` choose others); a text of one to four words is one run; texts without
words have no set and link with nothing, not even with each other; null counts as empty. Rows
whose id is null take the ``class_id`` of a copy with an id, else null, and count as copies.
Different texts that share an id are one vertex, which has the links of all of them; their
``n_links`` are counted for each text. An empty table gives no rows; other columns are ignored.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from leaseflow.llm import text as X
from leaseflow.llm.components import components
from leaseflow.sources.scratch import materialize

THRESHOLD, WORDS, RECALL, MOST_HASHES = 0.8, 5, 0.995, 128
#: A block of a family: so many texts and runs at most, on average.
BLOCK_TEXTS, BLOCK_RUNS = 1024, 1_500_000


def choose_bands(threshold: float = THRESHOLD, recall: float = RECALL,
                 most: int = MOST_HASHES) -> tuple[int, int]:
    """(bands, rows): the most selective rows whose bands reach the recall within ``most``."""
    best = (1, 1)
    for rows in range(1, most + 1):
        p = threshold ** rows
        bands = 1 if p >= 1 else math.ceil(math.log1p(-recall) / math.log1p(-p))
        if bands * rows <= most:
            best = (bands, rows)
    return best


def band_hashes(runs: np.ndarray, where: np.ndarray, bands: int, rows: int) -> np.ndarray:
    """(texts, bands) hashes; texts without runs get zeros."""
    some = np.diff(where) > 0
    out = np.zeros((len(where) - 1, bands), np.uint64)
    if not some.any():
        return out
    at = where[:-1][some]
    low = (runs >> np.uint64(32)).astype(np.uint32) ^ runs.astype(np.uint32)
    salts = X.stream(21, 2 * bands * rows).reshape(-1, 2)
    for band in range(bands):
        total = np.full(len(at), band + 1, np.uint64)
        for salt, times in salts[band * rows:(band + 1) * rows]:
            x = (low ^ np.uint32(salt & np.uint64(0xFFFFFFFF))) * np.uint32(
                (times & np.uint64(0xFFFFFFFF)) | np.uint64(1))
            x ^= x >> np.uint32(15)
            x *= np.uint32((times >> np.uint64(32)) | np.uint64(1))
            least = np.minimum.reduceat(x, at)
            total = X.mix(total + least.astype(np.uint64))
        out[some, band] = total
    return out


def _prepare(data: np.ndarray, offsets: np.ndarray, n: int, breaks: np.ndarray, fold: bool):
    starts, ends, first = X.words(data, offsets, breaks)
    hashes = X.word_hashes(data, starts, ends, fold)
    return hashes, first, *X.shingles(hashes, first, n)


def _signatures(n: int, bands: int, rows: int, breaks: np.ndarray, fold: bool):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part, data, offsets in X.slices(batch, "text"):
                hashes, first, runs, where = _prepare(data, offsets, n, breaks, fold)
                keys = X.sequence_keys(hashes, first)
                signs = band_hashes(runs, where, bands, rows)
                flat = pa.array(signs.reshape(-1).view(np.int64))
                yield pa.RecordBatch.from_arrays(
                    [part.column("doc_id"), part.column("row_key"),
                     pa.array(keys[:, 0].copy().view(np.int64)),
                     pa.array(keys[:, 1].copy().view(np.int64)),
                     pa.array(np.diff(where)),
                     pa.ListArray.from_arrays(
                         pa.array(np.arange(0, len(flat) + 1, bands, dtype=np.int32)), flat)],
                    ["doc_id", "row_key", "k0", "k1", "n_runs", "bands"])
    return run


class _Unit:
    """Texts of one pair of blocks."""

    def __init__(self, rows: pa.Table, n: int, breaks: np.ndarray, fold: bool):
        self.ids = rows["rep"].to_numpy()
        self.row_keys = rows["row_key"].to_numpy()
        self.copies = rows["copies"].to_numpy()
        self.block = rows["block"].to_numpy()
        self.cross = rows["i"][0].as_py() != rows["j"][0].as_py()
        self.bands = np.stack(rows["bands"].to_numpy()) if len(rows) else np.zeros((0, 1))
        self.sets: list[np.ndarray] = []
        for batch in rows.select(["text"]).combine_chunks().to_batches():
            for _, data, offsets in X.slices(batch, "text"):
                _, _, runs, where = _prepare(data, offsets, n, breaks, fold)
                self.sets += [np.unique(runs[a:b]) for a, b in zip(where[:-1], where[1:], strict=True)]
        lengths = np.array([len(s) for s in self.sets])
        values, dense = np.unique(np.concatenate(self.sets), return_inverse=True)
        self.sizes, self.n_values = lengths, len(values)
        self.where = np.concatenate([[0], np.cumsum(lengths)])
        self.flat = dense

    def _marked(self, flag: np.ndarray, near: np.ndarray) -> np.ndarray:
        """Marked values in each of the given sets; many sets are counted in one pass."""
        low, high = self.where[near[0]], self.where[near[-1] + 1]
        if 4 * self.sizes[near].sum() > high - low:
            total = np.concatenate([[0], np.cumsum(flag[self.flat[low:high]], dtype=np.int64)])
            return total[self.where[near + 1] - low] - total[self.where[near] - low]
        return np.array([flag[self.flat[self.where[b]:self.where[b + 1]]].sum(dtype=np.int64)
                         for b in near.tolist()])

    def links(self, threshold: float) -> Iterator[tuple[int, np.ndarray]]:
        """Each text with the later texts similar to it."""
        flag = np.zeros(self.n_values, np.int8)
        for a in range(len(self.ids) - 1):
            near = (self.bands[a + 1:] == self.bands[a]).any(axis=1)
            if self.cross:
                near &= self.block[a + 1:] != self.block[a]
            near = np.flatnonzero(near) + a + 1
            # A set can't reach the threshold if the sizes are too far apart.
            small, large = np.minimum(self.sizes[near], self.sizes[a]), np.maximum(
                self.sizes[near], self.sizes[a])
            near = near[small >= threshold * large - 1e-9]
            if not len(near):
                continue
            own = self.flat[self.where[a]:self.where[a + 1]]
            flag[own] = 1
            shared = self._marked(flag, near)
            flag[own] = 0
            union = self.sizes[a] + self.sizes[near] - shared
            near = near[shared >= threshold * union - 1e-9]
            if len(near):
                yield a, near


def _verify(rows: pa.Table, n: int, threshold: float, breaks: np.ndarray, fold: bool
            ) -> pa.RecordBatch:
    unit = _Unit(rows, n, breaks, fold)
    counts = np.zeros(len(unit.ids), np.int64)
    root = np.arange(len(unit.ids))

    def find(x: int) -> int:
        while root[x] != x:
            root[x] = root[root[x]]
            x = root[x]
        return x

    for a, near in unit.links(threshold):
        counts[a] += unit.copies[near].sum()
        counts[near] += unit.copies[a]
        at = find(a)
        for b in near.tolist():
            at, other = find(at), find(b)
            if at != other:
                low, high = (at, other) if unit.ids[at] < unit.ids[other] else (other, at)
                root[high] = low
    some = np.flatnonzero(counts)
    roots = np.array([find(i) for i in some.tolist()], np.int64)
    return pa.RecordBatch.from_arrays(
        [pa.array(unit.ids[some]), pa.array(unit.row_keys[some]),
         pa.array(unit.ids[roots] if len(some) else unit.ids[:0]), pa.array(counts[some])],
        ["rep", "row_key", "root", "links"])


def _units(n: int, threshold: float, breaks: np.ndarray, fold: bool):
    """Verifies the units of a partition, which come one after another."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[pa.RecordBatch] = []
        last = None
        for batch in batches:
            if not batch.num_rows:
                continue
            unit = [batch.column(c).to_numpy() for c in ("family", "i", "j")]
            change = np.flatnonzero(np.any([u[1:] != u[:-1] for u in unit], axis=0)) + 1
            bounds = [0, *change.tolist(), batch.num_rows]
            for low, high in zip(bounds[:-1], bounds[1:], strict=True):
                key = tuple(int(u[low]) for u in unit)
                if key != last and held:
                    yield _verify(pa.Table.from_batches(held), n, threshold, breaks, fold)
                    held = []
                held.append(batch.slice(low, high - low))
                last = key
        if held:
            yield _verify(pa.Table.from_batches(held), n, threshold, breaks, fold)
    return run


def near_duplicates(docs: DataFrame, doc_id: str = "doc_id", text: str = "text",
                    threshold: float = THRESHOLD, n: int = WORDS, recall: float = RECALL,
                    breaks: np.ndarray = X.BREAKS, fold: bool = True,
                    block: tuple[int, int] = (BLOCK_TEXTS, BLOCK_RUNS)) -> DataFrame:
    """One row per input row: doc_id, row_key, class_id, n_links, kept.

    ``class_id`` is the smallest id reachable by links (copies included), ``n_links`` the
    number of other rows similar to this one, copies included. ``doc_id`` must be integer.
    """
    bands, rows = choose_bands(threshold, recall)
    source = docs.select(F.col(doc_id).cast("bigint").alias("doc_id"), F.col(text).alias("text"),
                         F.xxhash64(text).alias("row_key"))
    signed = materialize(source.mapInArrow(
        X.frugal(_signatures(n, bands, rows, breaks, fold)),
        "doc_id bigint, row_key bigint, k0 bigint, k1 bigint, n_runs bigint, bands array<bigint>"),
        "signatures")
    at = F.when(F.col("doc_id").isNotNull(), F.struct("doc_id", "row_key"))
    classes = materialize(signed.filter("n_runs > 0").groupBy("k0", "k1").agg(
        F.min(at).alias("at"), F.count("*").alias("copies"), F.first("bands").alias("bands"),
        F.first("n_runs").alias("n_runs")).select(
        "k0", "k1", F.col("at.doc_id").alias("rep"), F.col("at.row_key").alias("row_key"),
        "copies", "bands", "n_runs"), "classes")
    distinct = classes.filter("rep IS NOT NULL")
    # Ids with several classes: their texts meet in a family, and their copies tie classes.
    repeated = materialize(signed.filter("n_runs > 0 AND doc_id IS NOT NULL").groupBy("doc_id").agg(
        F.min("k0").alias("a0"), F.max("k0").alias("b0"), F.min("k1").alias("a1"),
        F.max("k1").alias("b1")).filter("a0 <> b0 OR a1 <> b1").select("doc_id"), "repeated")
    ties = signed.filter("n_runs > 0").join(repeated, "doc_id").join(
        distinct.select("k0", "k1", "rep"), ["k0", "k1"]).filter("doc_id <> rep").select(
        "rep", F.col("doc_id").alias("root"))

    banded = distinct.select("rep", F.explode("bands").alias("band"))
    buckets = banded.groupBy("band").agg(F.min("rep").alias("low"), F.count("*").alias("texts"))
    edges = banded.join(buckets.filter("texts > 1"), "band").filter("rep <> low").select(
        F.col("rep").alias("u"), F.col("low").alias("v"))
    found = components(edges).select(F.col("id").alias("rep"), F.col("root").alias("family"))
    alone = repeated.select(F.col("doc_id").alias("rep"), F.col("doc_id").alias("family")).join(
        found, "rep", "left_anti")
    families = materialize(
        found.unionByName(alone)
        .join(distinct.select("rep", "row_key", "copies", "bands", "n_runs"), "rep"), "families")
    sizes = families.groupBy("family").agg(
        F.greatest(F.ceil(F.count("*") / block[0]), F.ceil(F.sum("n_runs") / block[1])).cast("int")
        .alias("blocks"))
    members = families.join(sizes, "family").withColumn(
        "block", F.pmod(F.xxhash64("rep", "row_key"), F.col("blocks")).cast("int"))
    texts = members.join(
        source.select(F.col("doc_id").alias("rep"), "row_key", "text").filter("rep IS NOT NULL"),
        ["rep", "row_key"])
    units = texts.select(
        "family", "rep", "row_key", "copies", "bands", "text", "block",
        F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)).alias("other")).select(
        "family", F.least("block", "other").alias("i"), F.greatest("block", "other").alias("j"),
        "rep", "row_key", "copies", "bands", "text", "block")
    # Rows that repeat both id and text stand once.
    verified = materialize(
        units.repartition("family", "i", "j")
        .dropDuplicates(["family", "i", "j", "rep", "row_key"])
        .sortWithinPartitions("family", "i", "j", "rep", "row_key")
        .mapInArrow(X.frugal(_units(n, threshold, breaks, fold)),
                    "rep bigint, row_key bigint, root bigint, links bigint"), "links")
    counted = verified.groupBy("rep", "row_key").agg(F.sum("links").alias("links"))
    linked = components(verified.select("rep", "root").unionByName(ties), "rep", "root"
                        ).withColumnsRenamed({"id": "rep", "root": "class_id"})
    reps = classes.join(counted, ["rep", "row_key"], "left").join(linked, "rep", "left").select(
        "k0", "k1", F.coalesce("class_id", "rep").alias("class_id"),
        (F.col("copies") - 1 + F.coalesce("links", F.lit(0))).alias("n_links"))
    out = signed.join(reps, ["k0", "k1"], "left")
    own = F.col("n_runs") > 0
    return out.select(
        "doc_id", "row_key",
        F.when(own, F.col("class_id")).otherwise(F.col("doc_id")).alias("class_id"),
        F.when(own, F.col("n_links")).otherwise(F.lit(0)).cast("bigint").alias("n_links"),
        F.when(own & F.col("class_id").isNotNull(), F.col("doc_id") == F.col("class_id"))
        .otherwise(F.lit(True)).alias("kept"))


def keep_one(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", **options) -> DataFrame:
    """The rows of ``docs`` that stay: one per class; columns unchanged.

    Rows of a class without any id, and texts without words, all stay.
    """
    marked = near_duplicates(docs, doc_id, text, **options)
    stay = marked.filter(F.coalesce("kept", F.lit(False))).select(
        F.col("doc_id").alias("_stay_id"), F.col("row_key").alias("_stay_key")).distinct()
    keyed = docs.withColumn("_row_key", F.xxhash64(text))
    found = keyed.join(stay, F.col(doc_id).cast("bigint").eqNullSafe(F.col("_stay_id"))
                       & (F.col("_row_key") == F.col("_stay_key")), "left_semi")
    return found.select(*[F.col(f"`{c}`") for c in docs.columns])

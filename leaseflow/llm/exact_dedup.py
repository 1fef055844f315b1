"""Exact dedup by content-defined chunk recipes.

A text is normalised (each run of white space becomes one space) and cut where a rolling
gear hash of its last 32 bytes hits a mask, so equal passages give equal chunks. Every chunk
gets a 128-bit fingerprint. Chunks are shuffled once, by fingerprint, and compared byte by
byte: if each fingerprint stands for one content, fingerprints are verified identifiers and
texts are equal exactly if their ordered identifier lists are. Only these lists (16 bytes a
chunk) take part in grouping and joins. Should two contents ever share a fingerprint, the
pass is repeated with a fresh fingerprint key.

Rules: null counts as empty and equal to it; ``keep_id`` is the smallest non-null id of the
group, null if there is none; rows that repeat an id with an equal text are all ``kept`` (and
``drop_copies`` leaves one of them); an empty table gives no rows; other columns are ignored.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from leaseflow.llm import text as X
from leaseflow.sources.scratch import materialize

MIN_CHUNK, MAX_CHUNK, MASK_BITS = 256, 16384, 10
_GEAR = (X.stream(11, 256) >> np.uint64(32)).astype(np.uint32)


def normalise(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Each run of white space within a text becomes one space."""
    space = X.WHITESPACE[data]
    drop = space.copy()
    drop[1:] &= space[:-1]
    drop[:1] = False
    begins = offsets[:-1][offsets[:-1] < len(data)]
    drop[begins] = False
    keep = np.flatnonzero(~drop)
    return np.where(space, np.uint8(32), data)[keep], np.searchsorted(keep, offsets)


def cuts(data: np.ndarray, offsets: np.ndarray) -> list[list[int]]:
    """Chunk ends of each text."""
    h = _GEAR[data]
    for width in (1, 2, 4, 8, 16):
        shifted = h[:-width] << np.uint32(width)
        h = h.copy()
        h[width:] += shifted
    marks = np.flatnonzero(h >> np.uint32(32 - MASK_BITS) == 0) + 1
    span = np.searchsorted(marks, offsets)
    out = []
    for i, (low, high) in enumerate(zip(offsets[:-1].tolist(), offsets[1:].tolist(), strict=True)):
        ends, last = [], low
        for mark in marks[span[i]:span[i + 1]].tolist():
            while mark - last > MAX_CHUNK:
                last += MAX_CHUNK
                ends.append(last)
            if mark - last >= MIN_CHUNK:
                ends.append(mark)
                last = mark
        while high - last > MAX_CHUNK:
            last += MAX_CHUNK
            ends.append(last)
        if high > last:
            ends.append(high)
        out.append(ends)
    return out


def _fingerprints(data: np.ndarray, offsets: np.ndarray, key: bytes, width: int
                  ) -> Iterator[list[tuple[bytes, memoryview]]]:
    view = memoryview(data)
    for low, ends in zip(offsets[:-1].tolist(), cuts(data, offsets), strict=True):
        chunks = []
        for end in ends:
            part = view[low:end]
            chunks.append((hashlib.blake2b(part, digest_size=width, key=key).digest(), part))
            low = end
        yield chunks


def _recipes(key: bytes, width: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for rows, data, offsets in X.slices(batch, "text"):
                data, offsets = normalise(data, offsets)
                view = memoryview(data)
                shas = [hashlib.sha256(view[a:b]).hexdigest() for a, b in
                        zip(offsets[:-1].tolist(), offsets[1:].tolist(), strict=True)]
                recipes = [b"".join(f for f, _ in chunks)
                           for chunks in _fingerprints(data, offsets, key, width)]
                yield pa.RecordBatch.from_arrays(
                    [rows.column("doc_id"), rows.column("row_key"), pa.array(shas, pa.string()),
                     pa.array(recipes, pa.binary())],
                    ["doc_id", "row_key", "text_sha256", "recipe"])
    return run


def _chunks(key: bytes, width: int):
    """Chunks of a slice, each content once."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for _, data, offsets in X.slices(batch, "text"):
                data, offsets = normalise(data, offsets)
                seen: set[tuple[bytes, memoryview]] = set()
                for chunks in _fingerprints(data, offsets, key, width):
                    seen.update((f, bytes(part)) for f, part in chunks)
                if seen:
                    prints, parts = zip(*seen, strict=True)
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(prints, pa.binary()), pa.array(parts, pa.binary())],
                        ["print", "chunk"])
    return run


def recipes(docs: DataFrame, doc_id: str = "doc_id", text: str = "text",
            width: int = 16) -> DataFrame:
    """(doc_id, row_key, text_sha256, recipe) with verified chunk identifiers, stored.

    ``row_key`` is a hash of the raw text and, with the id, finds the row again.
    """
    rows = docs.select(F.col(doc_id).alias("doc_id"), F.col(text).alias("text"),
                       F.xxhash64(text).alias("row_key"))
    kind = rows.schema["doc_id"].dataType.simpleString()
    for attempt in range(8):
        key = attempt.to_bytes(4, "little")
        prints = rows.select("text").mapInArrow(X.frugal(_chunks(key, width)), "print binary, chunk binary")
        shared = (prints.repartition("print").groupBy("print", "chunk").agg(F.lit(1).alias("one"))
                  .groupBy("print").agg(F.count("*").alias("contents")).filter("contents > 1"))
        if shared.limit(1).count() == 0:
            break
        width = min(2 * width, 64)
    else:
        raise ValueError("chunk fingerprints keep colliding")
    return materialize(rows.mapInArrow(
        X.frugal(_recipes(key, width)),
        f"doc_id {kind}, row_key bigint, text_sha256 string, recipe binary"), "recipes")


def exact_duplicates(docs: DataFrame, doc_id: str = "doc_id", text: str = "text",
                     width: int = 16) -> DataFrame:
    """One row per input row: doc_id, keep_id, group_size, kept, text_sha256, row_key."""
    listed = recipes(docs, doc_id, text, width)
    groups = listed.groupBy("recipe").agg(F.min("doc_id").alias("keep_id"),
                                          F.count("*").alias("group_size"))
    return listed.join(groups, "recipe").select(
        "doc_id", "keep_id", "group_size",
        F.coalesce(F.col("doc_id") == F.col("keep_id"), F.lit(False)).alias("kept"),
        "text_sha256", "row_key")


def drop_copies(docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """The rows of ``docs`` that stay, one per group of equal texts; columns unchanged.

    A group without any non-null id keeps one of its rows.
    """
    marked = exact_duplicates(docs, doc_id, text)
    stay = marked.filter(F.col("kept") | F.col("keep_id").isNull()).select(
        F.col("doc_id").alias("_stay_id"), F.col("row_key").alias("_stay_key"), "text_sha256")
    # Of rows that share id and normalised text one stays, whatever its white space.
    stay = stay.groupBy("_stay_id", "text_sha256").agg(F.min("_stay_key").alias("_stay_key"))
    keyed = docs.withColumn("_row_key", F.xxhash64(text))
    found = keyed.join(stay, F.col(doc_id).eqNullSafe(F.col("_stay_id"))
                       & (F.col("_row_key") == F.col("_stay_key")), "left_semi")
    return found.dropDuplicates([doc_id, "_row_key"]).select(*[F.col(f"`{c}`") for c in docs.columns])

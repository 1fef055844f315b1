"""Packing documents into token windows, online and in bounded space.

Each task keeps a fixed number of open windows. A document goes to the fullest window it
fits; when it fits none and all are open, the fullest is emitted. Documents longer than a
window fill whole windows first. The pieces of windows still open at the end of a task are
the leftovers: they are dealt into groups by hash and packed again, longest first.

Token ids come from the tokenizer library, asked once a worker for each distinct run of
characters between ASCII white space: the vocabulary's pre-tokenizer drops white space and
never joins across it, so a text's ids are those of its runs, one after another (tests hold
this against whole texts).

Rules: null and empty texts are the end id alone; every row is a document, also rows that
repeat an id or have none; an empty table gives no rows; other columns are ignored.
"""

from __future__ import annotations

import bisect
import os
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, functions as F

from leaseflow.llm import text as X
from leaseflow.sources.scratch import materialize

WINDOW, END_ID, OPEN_WINDOWS = 4096, 2, 256
#: Leftover pieces packed by one task, on average.
GROUP_PIECES = 50_000
#: Different runs a worker remembers, with a length bound: some 40 MB.
CACHED_RUNS, CACHED_BYTES = 250_000, 64

_encoders: dict[str, tuple[object, dict[bytes, bytes]]] = {}


def _encoder(path: str):
    if path not in _encoders:
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer
        _encoders[path] = Tokenizer.from_file(path), {}
    return _encoders[path]


_MARKS = X.byte_set(b".,;:!?")
_LETTERS = X.byte_set(b"abcdefghijklmnopqrstuvwxyz")


def _split_marks(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The texts with A-Z lower-cased, as the tokenizer does first, and a space before a mark
    of ``.,;:!?`` that follows a-z, where its pattern starts a new piece anyway: fewer
    different runs are left. A slice that may hold a special string, which is found before
    lower-casing, stays as it is.
    """
    if b"<|" in data.tobytes():
        return data, offsets
    data = X.FOLD[data]
    split = _MARKS[data]
    split[1:] &= _LETTERS[data[:-1]]
    split[:1] = False
    split[offsets[:-1][offsets[:-1] < len(data)]] = False
    at = np.flatnonzero(split)
    return np.insert(data, at, 32), offsets + np.searchsorted(at, offsets)


def _ids_of(path: str, runs: list[bytes]) -> list[bytes]:
    """Ids (little-endian, 4 bytes each) of different runs; the worker remembers them."""
    tokenizer, known = _encoder(path)
    out = [known.get(r) for r in runs]
    new = [i for i, ids in enumerate(out) if ids is None]
    if len(known) + len(new) > CACHED_RUNS:
        # What this slice needs stays: frequent runs are in every slice.
        known.clear()
        known.update((r, ids) for r, ids in zip(runs, out, strict=True) if ids is not None)
    for at in range(0, len(new), 65536):
        part = new[at:at + 65536]
        # One call for many runs; word_ids says which run a token came from.
        got = tokenizer.encode([runs[i].decode() for i in part], is_pretokenized=True,
                               add_special_tokens=False)
        ids = np.array(got.ids, "<u4").tobytes()
        ends = 4 * np.cumsum(np.bincount(np.array(got.word_ids, np.int64), minlength=len(part)))
        low = 0
        for i, high in zip(part, ends.tolist(), strict=True):
            out[i] = ids[low:high]
            if len(runs[i]) <= CACHED_BYTES:
                known[runs[i]] = ids[low:high]
            low = high
    return out


def encode(path: str, data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Ids of all texts of a slice end to end, and where each text's ids begin."""
    data, offsets = _split_marks(data, offsets)
    starts, ends, first = X.words(data, offsets)
    _, one, which = np.unique(X.word_hashes(data, starts, ends), return_index=True, return_inverse=True)
    ids = _ids_of(path, [data[a:b].tobytes() for a, b in
                         zip(starts[one].tolist(), ends[one].tolist(), strict=True)])
    lengths = np.array([len(v) for v in ids], np.int64) // 4
    flat = np.frombuffer(b"".join(ids), "<u4")
    begin = np.cumsum(lengths) - lengths
    n = lengths[which]
    where = np.concatenate([[0], np.cumsum(n)])
    return flat[np.repeat(begin[which] - where[:-1], n) + np.arange(where[-1])], where[first]


class BestFit:
    """A bounded number of open windows; ``place`` says where a piece goes."""

    def __init__(self, window: int, most_open: int | None):
        self.window, self.most_open = window, most_open
        self.open: list[tuple[int, int]] = []  # (tokens, number), by tokens
        self.made = 0

    def place(self, length: int) -> tuple[int, int, int | None]:
        """(window, offset, window emitted to make room)."""
        at = bisect.bisect_right(self.open, (self.window - length, 1 << 62)) - 1
        emitted = None
        if at >= 0:
            offset, number = self.open.pop(at)
        else:
            if self.most_open is not None and len(self.open) >= self.most_open:
                emitted = self.open.pop()[1]
            offset, number = 0, self.made
            self.made += 1
        if offset + length < self.window:
            bisect.insort(self.open, (offset + length, number))
        return number, offset, emitted


def _pieces(path: str, window: int, end_id: int, most_open: int, with_ids: bool):
    end = np.array([end_id], "<u4").tobytes()
    names = ["doc_id", "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset",
             "leftover"] + ["ids"] * with_ids

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        base = TaskContext.get().partitionId() << 36
        fit = BestFit(window, most_open)
        held: dict[int, list[tuple]] = {}

        def out(rows: list[tuple]) -> pa.RecordBatch:
            columns = list(zip(*rows, strict=True))
            kinds = [kind[0], *[pa.int64()] * 6, pa.bool_()] + [pa.binary()] * with_ids
            return pa.RecordBatch.from_arrays(
                [pa.array(c, k) for c, k in zip(columns, kinds, strict=True)], names)

        kind = [pa.int64()]
        for batch in batches:
            kind[0] = batch.column("doc_id").type
            for part, data, offsets in X.slices(batch, "text"):
                stream, bounds = encode(path, data, offsets)
                view, bounds = memoryview(stream.tobytes()), (4 * bounds).tolist()
                ready: list[tuple] = []
                for doc_id, low, high in zip(part.column("doc_id").to_pylist(), bounds[:-1],
                                             bounds[1:], strict=True):
                    ids = bytes(view[low:high]) + end
                    total = len(ids) // 4
                    for start in range(0, total, window):
                        piece = ids[4 * start:4 * (start + window)]
                        length = len(piece) // 4
                        number, offset, emitted = fit.place(length)
                        row = (doc_id, start, length, zlib.crc32(piece), total, base + number, offset,
                               False) + ((piece,) if with_ids else ())
                        if emitted is not None:
                            ready += held.pop(emitted)
                        if offset + length == window:
                            ready += held.pop(number, [])
                            ready.append(row)
                        else:
                            held.setdefault(number, []).append(row)
                if ready:
                    yield out(ready)
        rest = [row[:7] + (True,) + row[8:] for rows in held.values() for row in rows]
        for at in range(0, len(rest), 4096):
            yield out(rest[at:at + 4096])
    return run


def _merge(window: int):
    """Packs the leftover pieces of a partition, which come longest first."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        base = (1 << 60) + (TaskContext.get().partitionId() << 36)
        fit = BestFit(window, None)
        for batch in batches:
            places = [fit.place(n)[:2] for n in batch.column("length").to_pylist()]
            columns = {name: batch.column(name) for name in batch.schema.names}
            columns["sequence_id"] = pa.array([base + n for n, _ in places], pa.int64())
            columns["offset"] = pa.array([o for _, o in places], pa.int64())
            yield pa.RecordBatch.from_arrays(list(columns.values()), list(columns))
    return run


def pack(docs: DataFrame, tokenizer: str, doc_id: str = "doc_id", text: str = "text",
         window: int = WINDOW, end_id: int = END_ID, most_open: int = OPEN_WINDOWS,
         with_ids: bool = False) -> DataFrame:
    """One row per piece: doc_id, start, length, ids_crc32, doc_tokens, sequence_id, offset.

    ``tokenizer`` is the path of a tokenizers file, the same on every executor; ``with_ids``
    adds each piece's ids as little-endian 32-bit bytes.
    """
    source = docs.select(F.col(doc_id).alias("doc_id"), F.col(text).alias("text"))
    kind = source.schema["doc_id"].dataType.simpleString()
    schema = (f"doc_id {kind}, start bigint, length bigint, ids_crc32 bigint, doc_tokens bigint, "
              "sequence_id bigint, offset bigint, leftover boolean" + ", ids binary" * with_ids)
    placed = materialize(source.mapInArrow(
        X.frugal(_pieces(tokenizer, window, end_id, most_open, with_ids)), schema), "pieces")
    rest = placed.filter("leftover")
    groups = max(1, -(-rest.count() // GROUP_PIECES))
    # Sequence numbers follow from the order within a task, so the result is stored.
    merged = materialize(
        rest.repartition(groups, F.pmod(F.xxhash64("doc_id", "start", "ids_crc32"), F.lit(groups)))
        .sortWithinPartitions(F.desc("length"), "doc_id", "start", "ids_crc32")
        .mapInArrow(_merge(window), schema), "leftovers")
    return placed.filter("NOT leftover").unionByName(merged).drop("leftover")

"""Words, hashes and shingles of whole texts, computed on Arrow buffers with numpy.

All helpers work on one slice of texts at a time: ``data`` holds their UTF-8 bytes end to
end, ``offsets`` the first byte of each text and the end of the last. Nulls read as empty.
"""

from __future__ import annotations

import ctypes
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa

#: Bytes of text handled at a time; a longer text is a slice of its own.
SLICE_BYTES = 4 << 20


def byte_set(members: bytes) -> np.ndarray:
    table = np.zeros(256, bool)
    table[list(members)] = True
    return table


WHITESPACE = byte_set(b" \t\n\v\f\r")
#: White space and ASCII punctuation.
BREAKS = WHITESPACE | byte_set(b"!\"#$%&'()*+,-./:;<=>?@[\\]^_`{|}~")
FOLD = np.arange(256, dtype=np.uint8)
FOLD[ord("A"):ord("Z") + 1] += 32


def mix(x: np.ndarray) -> np.ndarray:
    """Finalizer of the public splitmix64 generator; its constants are fixed values."""
    x = x ^ (x >> np.uint64(30))
    x = x * np.uint64(0xBF58476D1CE4E5B9)
    x = x ^ (x >> np.uint64(27))
    x = x * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def stream(seed: int, n: int) -> np.ndarray:
    """n pseudo-random 64-bit values."""
    golden = np.uint64(0x9E3779B97F4A7C15)
    return mix((np.arange(1, n + 1, dtype=np.uint64) + np.uint64(seed << 20)) * golden)


_BYTES = stream(1, 256)
_BASE = int(stream(2, 1)[0]) | 1
SHINGLE_BASE = np.uint64(int(stream(3, 1)[0]) | 1)
_powers: dict[int, np.ndarray] = {}
#: Powers kept by a worker for each base, and bytes hashed at a time.
KEPT_POWERS = 1 << 18


def powers(base: int, n: int) -> np.ndarray:
    have = _powers.get(base)
    if have is None or len(have) < n:
        full = np.full(max(n, 1 << 16), base, np.uint64)
        full[0] = 1
        have = np.cumprod(full)
        if len(have) <= KEPT_POWERS:
            _powers[base] = have
    return have[:n]


def release() -> None:
    """Give freed memory back: a worker goes on to other work, beside a large JVM."""
    pa.default_memory_pool().release_unused()
    trim = getattr(ctypes.CDLL(None), "malloc_trim", None)
    if trim is not None:
        trim(0)


Task = Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]


def frugal(run: Task) -> Task:
    """The same task function, giving memory back when its partition is done."""
    def wrapped(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        try:
            yield from run(batches)
        finally:
            release()
    return wrapped


def slices(batch: pa.RecordBatch, column: str, limit: int = SLICE_BYTES
           ) -> Iterator[tuple[pa.RecordBatch, np.ndarray, np.ndarray]]:
    """Parts of a batch with about ``limit`` bytes of text: rows, bytes, offsets."""
    texts = batch.column(column)
    if texts.null_count:
        texts = texts.fill_null("")
    large = pa.types.is_large_string(texts.type) or pa.types.is_large_binary(texts.type)
    _, where, bytes_ = texts.buffers()
    n = len(texts)
    if not n:
        return
    offsets = np.frombuffer(where, np.int64 if large else np.int32)[
        texts.offset:texts.offset + n + 1].astype(np.int64)
    data = np.frombuffer(bytes_, np.uint8) if bytes_ is not None else np.zeros(0, np.uint8)
    at = 0
    while at < n:
        to = int(np.searchsorted(offsets, offsets[at] + limit, "right")) - 1
        to = min(max(to, at + 1), n)
        low, high = offsets[at], offsets[to]
        yield batch.slice(at, to - at), data[low:high], offsets[at:to + 1] - low
        at = to


def words(data: np.ndarray, offsets: np.ndarray, breaks: np.ndarray = WHITESPACE
          ) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """First byte and end of each word, and the first word of each text (with the end)."""
    inside = np.zeros(len(data) + 1, bool)
    np.logical_not(breaks[data], out=inside[:-1])
    first = inside.copy()
    first[1:] &= ~inside[:-1]
    first[offsets] = inside[offsets]
    last = np.zeros(len(data) + 1, bool)
    last[1:] = inside[:-1] & ~inside[1:]
    inner = offsets[offsets > 0]
    last[inner] = inside[inner - 1]
    starts, ends = np.flatnonzero(first), np.flatnonzero(last)
    return starts, ends, np.searchsorted(starts, offsets)


def word_hashes(data: np.ndarray, starts: np.ndarray, ends: np.ndarray,
                fold: bool = False) -> np.ndarray:
    """A 64-bit hash of each word's bytes, lower-cased (A-Z) with ``fold``."""
    out = np.empty(len(starts), np.uint64)
    table = _BYTES[FOLD] if fold else _BYTES
    inverse = pow(_BASE, -1, 1 << 64)
    at = 0
    while at < len(starts):
        to = max(int(np.searchsorted(ends, starts[at] + KEPT_POWERS - 1, "right")), at + 1)
        low, high = int(starts[at]), int(ends[to - 1])
        total = np.zeros(high - low + 1, np.uint64)
        np.cumsum(table[data[low:high]] * powers(_BASE, high - low), out=total[1:])
        begin = starts[at:to] - low
        out[at:to] = (total[ends[at:to] - low] - total[begin]) * powers(
            inverse, high - low + 1)[begin]
        at = to
    return mix(out)


def shingles(hashes: np.ndarray, first: np.ndarray, n: int) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of all runs of n words within each text, and the first run of each text.

    A text of 1 to n-1 words has one run, all its words; a text without words has none.
    """
    counts = np.diff(first)
    runs = np.where(counts >= n, counts - n + 1, (counts > 0).astype(counts.dtype))
    where = np.concatenate([[0], np.cumsum(runs)])
    out = np.empty(where[-1], np.uint64)
    if len(hashes) >= n:
        total = np.zeros(len(hashes) - n + 1, np.uint64)
        for k in range(n):
            total = total * SHINGLE_BASE + hashes[k:len(hashes) - n + 1 + k]
        end = np.repeat(first[1:], counts)[:len(total)]
        full = np.repeat(counts >= n, runs)
        out[full] = total[np.arange(len(total)) + n <= end]
    short = np.flatnonzero((counts > 0) & (counts < n))
    if len(short):
        total = counts[short].astype(np.uint64)
        for k in range(n - 1):
            has = k < counts[short]
            value = hashes[np.minimum(first[short] + k, len(hashes) - 1)]
            total = np.where(has, total * SHINGLE_BASE + value, total)
        out[where[short]] = total
    return mix(out), where


def sequence_keys(hashes: np.ndarray, first: np.ndarray) -> np.ndarray:
    """Two 64-bit hashes of each text's whole word sequence, as an (n, 2) array."""
    counts = np.diff(first)
    place = (np.arange(len(hashes)) - np.repeat(first[:-1], counts)).astype(np.uint64)
    out = np.zeros((len(counts), 2), np.uint64)
    some = counts > 0
    for k in range(2):
        salted = mix(hashes + mix(place * np.uint64(2) + np.uint64(k + 1)))
        if some.any():
            out[some, k] = np.add.reduceat(salted, first[:-1][some])
    return mix(out + counts.astype(np.uint64)[:, None])


def word_codes(data: np.ndarray, starts: np.ndarray, ends: np.ndarray
               ) -> tuple[np.ndarray, pa.StringArray]:
    """A number for each word, and the different words by number, compared as bytes."""
    lengths = ends - starts
    places = np.zeros(len(data) + 1, np.int8)
    # A word may end where the next begins, at the border of two texts.
    places[starts] += 1
    places[ends] -= 1
    inside = np.cumsum(places[:-1], dtype=np.int8).view(bool)
    bounds = np.zeros(len(starts) + 1, np.int64)
    np.cumsum(lengths, out=bounds[1:])
    flat = pa.LargeStringArray.from_buffers(
        len(starts), pa.py_buffer(bounds), pa.py_buffer(data[inside].tobytes()))
    coded = flat.dictionary_encode()
    return np.asarray(coded.indices), coded.dictionary


def string_hashes(strings: pa.Array) -> np.ndarray:
    """A 64-bit hash of each string's bytes; the array has no nulls."""
    if not len(strings):
        return np.zeros(0, np.uint64)
    flat = strings.cast(pa.large_string()) if strings.type != pa.large_string() else strings
    _, where, bytes_ = flat.buffers()
    bounds = np.frombuffer(where, np.int64)[flat.offset:flat.offset + len(flat) + 1]
    data = np.frombuffer(bytes_, np.uint8) if bytes_ is not None else np.zeros(0, np.uint8)
    return word_hashes(data, bounds[:-1], bounds[1:])

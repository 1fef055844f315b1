"""Token counts by byte-pair merging, without making identifiers.

A text is cut at the vocabulary's special strings (one token each) and then by its
pre-tokenizer pattern. Each piece starts as one symbol a byte, in a linked list; a heap pops
the adjacent pair of lowest rank (leftmost among equals) until no pair can be merged. The
piece counts its bytes minus its merges. Pieces repeat, so each worker keeps their counts.

Rules: null counts as empty, 0 tokens; every row gives a row, also rows that repeat an id or
have none; an empty table gives no rows; other columns are ignored.
"""

from __future__ import annotations

import json
import re
from collections.abc import Iterable, Iterator
from heapq import heapify, heappop, heappush

import pyarrow as pa
import regex
from pyspark.sql import DataFrame, functions as F
from tokenizers import pre_tokenizers

LIMIT = 1024
#: Pieces a worker remembers, and their longest length.
CACHED, CACHED_CHARS = 700_000, 64
#: Texts above this length are cut lazily.
LONG_TEXT = 1 << 20
#: Fixed value: the byte-level pre-tokenizer pattern of this vocabulary family.
PATTERN = r"""'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""

#: Below this character both regular expression libraries agree on letters and digits.
_NEWER = re.compile("[\u0558-\U0010ffff]")
_BYTE_LEVEL = pre_tokenizers.ByteLevel(add_prefix_space=False, use_regex=True)


def byte_symbols() -> list[str]:
    """The printable character that stands for each byte in byte-level vocabularies."""
    plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
    other = [b for b in range(256) if b not in set(plain)]
    names = {b: chr(b) for b in plain} | {b: chr(256 + k) for k, b in enumerate(other)}
    return [names[b] for b in range(256)]


class Counter(dict):
    """Token count of each pre-token piece; computes and remembers missing ones."""

    def __init__(self, path: str):
        super().__init__()
        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        vocab = spec["model"]["vocab"]
        self.first = [vocab[s] for s in byte_symbols()]
        self.merges: dict[tuple[int, int], tuple[int, int]] = {}
        for rank, pair in enumerate(spec["model"]["merges"]):
            a, b = pair.split(" ") if isinstance(pair, str) else pair
            self.merges[vocab[a], vocab[b]] = (rank, vocab[a + b])
        special = sorted((t["content"] for t in spec["added_tokens"]), key=len, reverse=True)
        self.special = re.compile("|".join(map(re.escape, special))) if special else None
        self.pieces = regex.compile(PATTERN)
        self.bytes_of = {s: b for b, s in enumerate(byte_symbols())}

    def __missing__(self, piece: str | bytes) -> int:
        n = self.merged(piece if isinstance(piece, bytes) else piece.encode())
        if len(piece) <= CACHED_CHARS:
            if len(self) >= CACHED:
                self.clear()
            self[piece] = n
        return n

    def merged(self, piece: bytes) -> int:
        """Bytes minus merges."""
        symbols = [self.first[b] for b in piece]
        n = left = len(symbols)
        before, after = list(range(-1, n - 1)), [*range(1, n), -1]
        merges = self.merges
        heap = [(m[0], i, m[1], symbols[i + 1]) for i in range(n - 1)
                if (m := merges.get((symbols[i], symbols[i + 1])))]
        lefts = symbols  # the current symbol at each place, -1 where merged away
        heapify(heap)
        while heap:
            rank, i, made, right = heappop(heap)
            j = after[i]
            # The pair may have changed since it was pushed.
            if lefts[i] < 0 or j < 0 or lefts[j] != right or merges.get((lefts[i], right), (None,))[0] != rank:
                continue
            lefts[i], lefts[j] = made, -1
            after[i] = k = after[j]
            left -= 1
            if k >= 0:
                before[k] = i
                if m := merges.get((made, lefts[k])):
                    heappush(heap, (m[0], i, m[1], lefts[k]))
            h = before[i]
            if h >= 0 and (m := merges.get((lefts[h], made))):
                heappush(heap, (m[0], h, m[1], made))
        return left

    def _pieces(self, text: str) -> Iterable[str | bytes]:
        if _NEWER.search(text):
            # Letters that libraries class by different Unicode versions: ask the library.
            return (bytes(map(self.bytes_of.__getitem__, piece))
                    for piece, _ in _BYTE_LEVEL.pre_tokenize_str(text))
        if len(text) > LONG_TEXT:
            return (m.group() for m in self.pieces.finditer(text))
        return self.pieces.findall(text)

    def count(self, text: str | None) -> int:
        if not text:
            return 0
        if self.special is None or not self.special.search(text):
            return sum(map(self.__getitem__, self._pieces(text)))
        total, at = 0, 0
        for m in self.special.finditer(text):
            total += 1 + sum(map(self.__getitem__, self._pieces(text[at:m.start()])))
            at = m.end()
        return total + sum(map(self.__getitem__, self._pieces(text[at:])))


_counters: dict[str, Counter] = {}


def _counter(path: str) -> Counter:
    if path not in _counters:
        _counters[path] = Counter(path)
    return _counters[path]


def count_tokens(docs: DataFrame, tokenizer: str, doc_id: str = "doc_id", text: str = "text",
                 limit: int = LIMIT) -> DataFrame:
    """One row per input row: doc_id, n_bytes, n_tokens, over_limit.

    ``tokenizer`` is the path of a byte-level BPE tokenizers file, the same on every executor.
    """
    rows = docs.select(F.col(doc_id).alias("doc_id"), F.col(text).alias("text"),
                       F.coalesce(F.octet_length(text), F.lit(0)).cast("bigint").alias("n_bytes"))
    kind = rows.schema["doc_id"].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counter = _counter(tokenizer)
        for batch in batches:
            column = batch.column("text")
            counts = pa.array([counter.count(column[i].as_py()) for i in range(len(column))], pa.int64())
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), batch.column("n_bytes"), counts],
                ["doc_id", "n_bytes", "n_tokens"])

    return rows.mapInArrow(run, f"doc_id {kind}, n_bytes bigint, n_tokens bigint").withColumn(
        "over_limit", F.col("n_tokens") > limit)

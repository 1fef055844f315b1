"""Ranked lexical search over bit-sliced Bloom signatures.

The index holds, for blocks of documents with similar numbers of terms, a bit matrix: a column
a document, a row a hash position. A document sets three positions for each of its terms, and
three others for each level that the term's count exceeds (2, 3, 5, 9 occurrences or more). The
AND of a term's rows is then the bitmap of documents that may hold it, never missing one.

Searching a block adds up, term by term and level by level, what the bitmaps allow at most:
term weight times the largest value the count at that level can have in a document of its
length. That is an upper bound of the score. The documents with the highest bounds are scored
exactly; an item's ``top``-th best exact score so found is what a document must reach. In a
second pass every document whose bound reaches it is a candidate, and all candidates are scored
exactly from their texts. What isn't scored is provably below.

Scores (see :func:`factor`) are integers; sums stay below 2**53, so doubles hold them exactly.

Rules: null and blank texts have no terms and count nowhere; ids may be null (they sort last) or
repeat: rows are ranked as documents of their own; benchmark rows that repeat id and text are
one item; items without terms or matches have no rows; empty tables give no rows; other columns
are ignored. Items are taken in blocks of a fixed number of terms, each searched against all
documents; the index is built once.
"""

from __future__ import annotations

import heapq
import math
from collections.abc import Iterator
from dataclasses import dataclass
from functools import reduce

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Window, functions as F

from leaseflow.llm import text as X
from leaseflow.sources.scratch import materialize

TOP, SEEDS = 10, 50
#: Different terms of one block of items; a longer item is a block of its own.
BLOCK_TERMS = 20_000
HASHES, BITS_A_TERM = 3, 8
#: Counts from which a term is entered once more.
LEVELS = (1, 2, 3, 5, 9)
SLICE = 8 << 20
#: Documents whose bounds are computed together.
COLUMNS = 512

_term_bytes = set(b"0123456789ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz") | set(range(128, 256))
BREAKS = X.byte_set(bytes(set(range(256)) - _term_bytes))

_SALTS = X.stream(51, len(LEVELS))
INDEX = "width int, keys array<bigint>, lengths array<bigint>, bits binary"


def factor(tf: np.ndarray | int, m: np.ndarray) -> np.ndarray:
    """What tf occurrences are worth in a document of relative length m."""
    return (1_000_000_000 * np.asarray(tf, np.int64)) // (1000 * np.asarray(tf, np.int64) + 8 * m)


def relative_lengths(lengths: np.ndarray, documents: int, words: int) -> np.ndarray:
    """m of each length; in whole numbers of any size."""
    values, which = np.unique(lengths, return_inverse=True)
    m = [10 + 90 * n * documents // words for n in values.tolist()]
    return np.array(m, np.int64)[which]


def weight(documents: int, df: int) -> int:
    return math.floor(1000 * math.log((2 * documents + 2) / (2 * df + 1)))


def _terms(batch: pa.RecordBatch) -> Iterator[tuple[pa.RecordBatch, np.ndarray, np.ndarray, pa.Array]]:
    """Slices of rows: first term of each text, term numbers, the different terms."""
    for rows, data, offsets in X.slices(batch, "text", SLICE):
        data = X.FOLD[data]
        starts, ends, first = X.words(data, offsets, BREAKS)
        codes, vocabulary = X.word_codes(data, starts, ends)
        yield rows, first, codes, vocabulary


def _pairs(first: np.ndarray, codes: np.ndarray, size: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Different (document, term) pairs of a slice and how often each occurs."""
    doc = np.repeat(np.arange(len(first) - 1), np.diff(first))
    keys, counts = np.unique(doc * max(size, 1) + codes, return_counts=True)
    return keys // max(size, 1), keys % max(size, 1), counts


# --- index -------------------------------------------------------------------------------

def _positions(hashes: np.ndarray, level: int, width: int) -> list[np.ndarray]:
    salted = X.mix(hashes + _SALTS[level])
    step = X.mix(salted) | np.uint64(1)
    return [((salted + np.uint64(k) * step) & np.uint64(width - 1)).astype(np.int64) for k in range(HASHES)]


def _blocks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for rows, first, codes, vocabulary in _terms(batch):
            doc, term, count = _pairs(first, codes, len(vocabulary))
            hashes = X.string_hashes(vocabulary)
            entries = np.zeros(len(first) - 1, np.int64)
            for at_least in LEVELS:
                entries += np.bincount(doc[count >= at_least], minlength=len(entries))
            widths = 1 << np.ceil(np.log2(np.maximum(entries * BITS_A_TERM, 64))).astype(np.int64)
            lengths = np.diff(first)
            keys = rows.column("key").to_numpy()
            for width in np.unique(widths[entries > 0]).tolist():
                members = np.flatnonzero((widths == width) & (entries > 0))
                column = np.full(len(entries), -1, np.int64)
                column[members] = np.arange(len(members))
                bits = np.zeros((width, len(members)), bool)
                mine = column[doc] >= 0
                for level, at_least in enumerate(LEVELS):
                    some = mine & (count >= at_least)
                    for rows_of in _positions(hashes[term[some]], level, width):
                        bits[rows_of, column[doc[some]]] = True
                yield pa.RecordBatch.from_arrays([
                    pa.array([width], pa.int32()), pa.array([keys[members]], pa.list_(pa.int64())),
                    pa.array([lengths[members]], pa.list_(pa.int64())),
                    pa.array([np.packbits(bits, axis=1).tobytes()], pa.binary())],
                    ["width", "keys", "lengths", "bits"])


def row_key(*columns: str):
    """A number for a row. Rows that share one by chance are only scored once too often."""
    return F.xxhash64(*columns)


def build_index(docs: DataFrame) -> DataFrame:
    """Bit matrices of the rows (key, doc_id, text): width, keys, lengths, bits."""
    return materialize(docs.select("key", "text").mapInArrow(_blocks, INDEX), "signatures")


# --- items -------------------------------------------------------------------------------

def item_terms(text: str | None) -> list[str]:
    """The different terms of one text, in order."""
    data = np.frombuffer((text or "").encode(), np.uint8)
    data = X.FOLD[data]
    starts, ends, _ = X.words(data, np.array([0, len(data)]), BREAKS)
    return list(dict.fromkeys(data[a:b].tobytes().decode() for a, b in
                              zip(starts.tolist(), ends.tolist(), strict=True)))


@dataclass
class Items:
    """A block of items: ids, their terms, and the weights once the counts are known."""

    ids: list
    vocabulary: list[str]
    terms: list[np.ndarray]
    weights: np.ndarray | None = None
    documents: int = 0
    words: int = 0

    def of_term(self) -> tuple[np.ndarray, np.ndarray]:
        """Items by term: bounds for each term, and the items end to end."""
        item = np.repeat(np.arange(len(self.terms)), [len(t) for t in self.terms])
        term = np.concatenate(self.terms)
        order = np.argsort(term, kind="stable")
        return np.searchsorted(term[order], np.arange(len(self.vocabulary) + 1)), item[order]


def item_blocks(items: DataFrame, most: int = BLOCK_TERMS) -> Iterator[Items]:
    """All items with terms, in blocks; the driver holds one block and one partition's rows."""
    block, numbers = Items([], [], []), {}
    for row in items.dropDuplicates(["item_id", "text"]).toLocalIterator():
        terms = item_terms(row["text"])
        if not terms:
            continue
        if block.ids and len(numbers) + len(terms) > most:
            yield block
            block, numbers = Items([], [], []), {}
        codes = [numbers.setdefault(t, len(numbers)) for t in terms]
        block.vocabulary = list(numbers)
        block.ids.append(row["item_id"])
        block.terms.append(np.array(codes, np.int64))
    if block.ids:
        yield block


def _counts(vocabulary: list[str]):
    """Per slice: documents with terms, terms, and the document frequency of the vocabulary."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = pa.array(vocabulary, pa.large_string())
        df = np.zeros(len(vocabulary) + 2, np.int64)
        for batch in batches:
            for _, first, codes, terms in _terms(batch):
                place = pc.index_in(terms, value_set=known)
                _, term, _ = _pairs(first, codes, len(terms))
                held = np.bincount(term, minlength=len(terms))
                mine = np.asarray(place.is_valid())
                df[np.asarray(place.fill_null(0))[mine]] += held[mine]
                df[-2] += int((np.diff(first) > 0).sum())
                df[-1] += len(codes)
        some = np.flatnonzero(df)
        yield pa.RecordBatch.from_arrays([pa.array(some), pa.array(df[some])], ["term", "n"])
    return run


def weigh(docs: DataFrame, block: Items) -> Items:
    """The block with N, L and term weights counted over all documents."""
    size = len(block.vocabulary)
    counted = docs.select("text").mapInArrow(_counts(block.vocabulary), "term bigint, n bigint").groupBy(
        "term").agg(F.sum("n").alias("n")).toArrow()
    df = np.zeros(size + 2, np.int64)
    df[counted.column("term").to_numpy()] = counted.column("n").to_numpy()
    block.documents, block.words = int(df[-2]), int(df[-1])
    block.weights = np.array([weight(block.documents, n) if n else 0 for n in df[:size].tolist()], np.int64)
    return block


# --- search ------------------------------------------------------------------------------

def _bounds(index: dict, block: Items, hashes: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """(keys, bounds by item and document) for parts of one matrix."""
    width, keys = index["width"], np.asarray(index["keys"], np.int64)
    lengths = np.asarray(index["lengths"], np.int64)
    bits = np.frombuffer(index["bits"], np.uint8).reshape(width, -1)
    where = [_positions(hashes, level, width) for level in range(len(LEVELS))]
    for at in range(0, len(keys), COLUMNS):
        part = slice(at // 8, (at + COLUMNS) // 8)
        n = lengths[at:at + COLUMNS]
        m = relative_lengths(n, block.documents, block.words)
        worth = np.zeros((len(hashes), len(n)))
        before, may = np.zeros(len(n), np.int64), None
        for level, rows in enumerate(where):
            held = reduce(np.bitwise_and, [bits[r, part] for r in rows])
            may = held if may is None else may & held
            # The count is below the next level's, and never above the document's length.
            most = LEVELS[level + 1] - 1 if level + 1 < len(LEVELS) else n
            value = factor(np.minimum(most, n), m)
            worth += np.unpackbits(may, axis=1, count=len(n)) * (value - before).astype(float)
            before = value
        worth *= block.weights[:, None]
        yield keys[at:at + COLUMNS], np.stack([worth[t].sum(axis=0) for t in block.terms])


def _seeds(block: Items, most: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hashes = X.string_hashes(pa.array(block.vocabulary, pa.large_string()))
        best = [[] for _ in block.ids]
        for batch in batches:
            for row in batch.to_pylist():
                for keys, bounds in _bounds(row, block, hashes):
                    for heap, values in zip(best, bounds, strict=True):
                        least = heap[0][0] if len(heap) == most else 0
                        some = np.flatnonzero(values > least)
                        for i in some[np.argsort(-values[some])][:most].tolist():
                            entry = (values[i], int(keys[i]))
                            heapq.heappush(heap, entry) if len(heap) < most else heapq.heappushpop(heap, entry)
        rows = [(q, key, bound) for q, heap in enumerate(best) for bound, key in heap]
        if rows:
            yield pa.RecordBatch.from_arrays(
                [pa.array(c, t) for c, t in zip(zip(*rows, strict=True), (pa.int64(), pa.int64(), pa.float64()),
                                                strict=True)], ["item", "key", "bound"])
    return run


def _candidates(block: Items, least: np.ndarray):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hashes = X.string_hashes(pa.array(block.vocabulary, pa.large_string()))
        for batch in batches:
            for row in batch.to_pylist():
                for keys, bounds in _bounds(row, block, hashes):
                    reach = keys[(bounds >= least[:, None]).any(axis=0)]
                    if len(reach):
                        yield pa.RecordBatch.from_arrays([pa.array(reach)], ["key"])
    return run


def _exact(block: Items, top: int):
    """The best ``top`` documents of each item in a task: item, doc_id, score."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = pa.array(block.vocabulary, pa.large_string())
        bounds, items = block.of_term()
        spread = np.diff(bounds)
        best: list[list[tuple]] = [[] for _ in block.ids]
        kind = pa.int64()
        for batch in batches:
            kind = batch.column("doc_id").type
            for rows, first, codes, terms in _terms(batch):
                place = pc.index_in(terms, value_set=known).fill_null(-1)
                number = np.asarray(place).astype(np.int64)[codes]
                kept = np.concatenate([[0], np.cumsum(number >= 0)])[first]
                doc, term, tf = _pairs(kept, number[number >= 0], len(block.vocabulary))
                m = relative_lengths(np.diff(first), block.documents, block.words)
                score = block.weights[term] * factor(tf, m[doc])
                # Each pair counts for all items that hold its term.
                reps = spread[term]
                begin = np.repeat(bounds[term] - (np.cumsum(reps) - reps), reps)
                item = items[begin + np.arange(reps.sum())]
                n = len(first) - 1
                cell, which = np.unique(item * n + np.repeat(doc, reps), return_inverse=True)
                total = np.bincount(which, np.repeat(score, reps).astype(float), len(cell)).astype(np.int64)
                ids = rows.column("doc_id").to_pylist()
                order = np.lexsort((-total, cell // n))
                cell, total = cell[order], total[order]
                heads = np.flatnonzero(np.diff(cell // n, prepend=-1))
                for low, high in zip(heads.tolist(), [*heads[1:].tolist(), len(cell)], strict=True):
                    q = int(cell[low] // n)
                    # All that tie with the last place take part, so that ids decide.
                    last = total[min(low + top, high) - 1]
                    high = low + int(np.searchsorted(-total[low:high], -last, "right"))
                    got = [(-int(s), ids[c % n] is None, ids[c % n] or 0) for c, s in
                           zip(cell[low:high].tolist(), total[low:high].tolist(), strict=True) if s > 0]
                    best[q] = heapq.nsmallest(top, best[q] + got)
        out = [(q, None if null else doc_id, -score) for q, found in enumerate(best) for score, null, doc_id in found]
        if out:
            yield pa.RecordBatch.from_arrays(
                [pa.array(c, t) for c, t in zip(zip(*out, strict=True), (pa.int64(), kind, pa.int64()),
                                                strict=True)], ["item", "doc_id", "score"])
    return run


def _scored(docs: DataFrame, block: Items, top: int) -> DataFrame:
    """item, doc_id, score, rank of the best ``top`` documents of each item among ``docs``."""
    kind = docs.schema["doc_id"].dataType.simpleString()
    order = Window.partitionBy("item").orderBy(F.desc("score"), F.asc_nulls_last("doc_id"))
    return docs.select("doc_id", "text").mapInArrow(
        _exact(block, top), f"item bigint, doc_id {kind}, score bigint").withColumn(
        "rank", F.row_number().over(order)).filter(F.col("rank") <= top)


def reach(docs: DataFrame, index: DataFrame, block: Items, top: int, seeds: int) -> np.ndarray:
    """A score that ``top`` documents of each item have or exceed, 1 where fewer are known."""
    order = Window.partitionBy("item").orderBy(F.desc("bound"), "key")
    first = index.mapInArrow(_seeds(block, seeds), "item bigint, key bigint, bound double").withColumn(
        "place", F.row_number().over(order)).filter(F.col("place") <= seeds).select("key").distinct()
    # At most ``seeds`` keys an item of one block.
    scored = _scored(docs.join(F.broadcast(first), "key", "left_semi"), block, top)
    least = np.ones(len(block.ids))
    for row in scored.filter(F.col("rank") == top).select("item", "score").toLocalIterator():
        least[row["item"]] = row["score"]
    return least


def candidates(index: DataFrame, block: Items, least: np.ndarray) -> DataFrame:
    """Keys of all documents whose bound reaches the score of some item."""
    return index.mapInArrow(_candidates(block, least), "key bigint").distinct()


def search(docs: DataFrame, items: DataFrame, doc_id: str = "doc_id", text: str = "text",
           item_id: str = "item_id", item_text: str = "text", top: int = TOP, seeds: int = SEEDS,
           block_terms: int = BLOCK_TERMS) -> DataFrame:
    """The best documents of each item: item_id, rank, doc_id, score."""
    spark = docs.sparkSession
    rows = docs.select(F.col(doc_id).alias("doc_id"), F.col(text).alias("text")).withColumn(
        "key", row_key("doc_id", "text")).filter(F.length("text") > 0)
    asked = items.select(F.col(item_id).alias("item_id"), F.col(item_text).alias("text"))
    kinds = [asked.schema["item_id"].dataType.simpleString(), rows.schema["doc_id"].dataType.simpleString()]
    schema = f"item_id {kinds[0]}, rank int, doc_id {kinds[1]}, score bigint"
    index, out = None, None
    for block in item_blocks(asked, block_terms):
        index = build_index(rows) if index is None else index
        weigh(rows, block)
        if block.words:
            least = reach(rows, index, block, top, seeds)
            keys = materialize(candidates(index, block, least), "candidates")
            names = spark.createDataFrame(list(enumerate(block.ids)), f"item bigint, item_id {kinds[0]}")
            found = _scored(rows.join(keys, "key", "left_semi"), block, top).join(
                F.broadcast(names), "item").select("item_id", "rank", "doc_id", "score")
            found = materialize(found, "found")
            out = found if out is None else out.unionByName(found)
    return spark.createDataFrame([], schema) if out is None else out

"""Substring dedup: passages that also start in a document with a smaller id are removed.

The core is a compressed FM-index per shard: documents are streamed against the shard's index,
backward search over its wavelet matrix gives matching statistics cut off at the window length,
and the rows of intervals that reach it are located by the index's sampled places; the smallest
document among them is reported.

Shards are made by content, so that no document meets every shard:

1. texts with the same word sequence become one class, whose smallest id stands for it;
2. every window of 13 words has an anchor, the run of 7 words with the smallest hash in it;
   equal windows have equal anchors. (anchor, class) rows, about one for four words, are
   shuffled once, and anchors that only one class has are done with;
3. the stretches of text around the remaining anchors are dealt to shards by anchor, each
   content once a task; a shard indexes its contents and searches them, and returns for each
   content the smallest document of each of its windows;
4. these answers go back to the documents, and words under a window known from a smaller id
   are removed.

Hot anchors: where many classes of one slice share an anchor, two rows of it are shuffled
instead of all. The windows of such an anchor, and of one that is spread thinly over many
slices, are dealt one by one by their own hash, so that a line that a third of the documents
share spreads over all shards by what follows it.

Rules: words are runs of bytes other than ASCII white space, kept as they are; null counts as
empty; rows with a null id lose nothing and remove nothing; rows that share an id don't remove
from each other; an empty table gives no rows; other columns are ignored.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from itertools import compress

import numpy as np
import pyarrow as pa
import pyarrow.compute
from pyspark.sql import DataFrame, Window, functions as F

from leaseflow.llm import text as X
from leaseflow.llm.fm_index import FMIndex
from leaseflow.sources.scratch import discard, materialize, store

WINDOW, ANCHOR = 13, 7
#: Classes of one slice that share an anchor, from which it counts as hot.
HOT = 16
#: Rows of one anchor from all slices, from which it counts as hot too.
SPREAD = 4096
#: Words indexed together.
SHARD_WORDS = 200_000
EMPTY_SHA = hashlib.sha256(b"").hexdigest()


class Slice:
    """Words of a slice of texts and, per window, its text and anchor."""

    def __init__(self, data: np.ndarray, offsets: np.ndarray, window: int, anchor: int):
        self.data, self.window = data, window
        self.starts, self.ends, self.first = X.words(data, offsets)
        self.hashes = X.word_hashes(data, self.starts, self.ends)
        texts = len(offsets) - 1
        self.text_of = np.repeat(np.arange(texts), np.diff(self.first))
        n = max(0, len(self.hashes) - window + 1)
        inside = self.text_of[:n] == self.text_of[len(self.text_of) - n:]
        self.windows = np.flatnonzero(inside)  # first word of each window
        grams = _runs(self.hashes, anchor)
        least, place = grams[:n].copy(), np.arange(n)
        for k in range(1, window - anchor + 1):
            other = grams[k:k + n]
            better = other < least
            least[better] = other[better]
            place[better] = np.flatnonzero(better) + k
        self.anchors, self.places = least[self.windows], place[self.windows]
        self.texts = self.text_of[self.windows]

    def joined(self, low: int, high: int) -> bytes:
        """Words [low, high) of one text, one space between them."""
        return b" ".join(self.data[self.starts[low]:self.ends[high - 1]].tobytes().split())


def _runs(hashes: np.ndarray, n: int) -> np.ndarray:
    """Hash of the n words from each place on, across text ends too."""
    if len(hashes) < n:
        return np.zeros(0, np.uint64)
    return X.shingles(hashes, np.array([0, len(hashes)]), n)[0]


def _signature(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Word sequence keys, word counts and the hash of the words joined by spaces."""
    for batch in batches:
        for rows, data, offsets in X.slices(batch, "text"):
            starts, ends, first = X.words(data, offsets)
            keys = X.sequence_keys(X.word_hashes(data, starts, ends), first).view(np.int64)
            shas = [hashlib.sha256(b" ".join(data[a:b].tobytes().split())).hexdigest()
                    for a, b in zip(offsets[:-1].tolist(), offsets[1:].tolist(), strict=True)]
            yield pa.RecordBatch.from_arrays(
                [rows.column("doc_id"), rows.column("row_key"), pa.array(keys[:, 0].copy()),
                 pa.array(keys[:, 1].copy()), pa.array(np.diff(first)), pa.array(shas)],
                ["doc_id", "row_key", "k0", "k1", "n_words", "sha"])


PLAIN, MARK, DIRECT = 0, 1, 2


def _anchors(window: int, anchor: int, hot: int):
    """(p, v, kind) rows: plain (anchor, class); two marks (anchor, class) of a hot anchor;
    and direct answers (class, anchor) for the slice's own classes that have a hot one."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for _, data, offsets in X.slices(batch, "text"):
                part = Slice(data, offsets, window, anchor)
                if not len(part.windows):
                    continue
                keys = X.sequence_keys(part.hashes, part.first)[:, 0]
                new = np.concatenate([[True], (np.diff(part.places) != 0) | (np.diff(part.texts) != 0)])
                a, k = part.anchors[new], keys[part.texts[new]]
                order = np.lexsort((k, a))
                a, k = a[order], k[order]
                once = np.concatenate([[True], (a[1:] != a[:-1]) | (k[1:] != k[:-1])])
                a, k = a[once], k[once]
                head = np.flatnonzero(np.concatenate([[True], a[1:] != a[:-1]]))
                n = np.diff(np.append(head, len(a)))
                many = np.repeat(n >= hot, n)
                ends = np.concatenate([head[n >= hot], (head + n - 1)[n >= hot]])
                p = np.concatenate([a[~many], a[ends], k[many]])
                v = np.concatenate([k[~many], k[ends], a[many]])
                kind = np.repeat(np.array([PLAIN, MARK, DIRECT], np.int8),
                                 [(~many).sum(), len(ends), many.sum()])
                # In text order, neighbours share a class, which compresses.
                order = np.argsort(np.where(kind == DIRECT, p, v), kind="stable")
                yield pa.RecordBatch.from_arrays(
                    [pa.array(p[order].view(np.int64)), pa.array(v[order].view(np.int64)),
                     pa.array(kind[order])], ["p", "v", "kind"])
    return run


def _segments(part: Slice, wanted: np.ndarray, hot: np.ndarray
              ) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Stretches to search: first word, windows, key and content hash.

    ``wanted`` and ``hot`` are masks over the windows. Windows in a row with one anchor are
    one stretch; windows with a hot anchor stand alone, under their own hash.
    """
    at = np.flatnonzero(wanted)
    if not len(at):
        none = np.zeros(0, np.int64)
        return none, none, none.astype(np.uint64), none.astype(np.uint64)
    cut = np.concatenate([[True], (np.diff(part.windows[at]) != 1) | (np.diff(part.places[at]) != 0)
                          | (np.diff(part.texts[at]) != 0) | hot[at[1:]] | hot[at[:-1]]])
    head = np.flatnonzero(cut)
    first = part.windows[at[head]]
    windows = np.diff(np.append(head, len(at)))
    total = np.zeros(len(part.hashes) + 1, np.uint64)
    base = int(X.SHINGLE_BASE)
    np.cumsum(part.hashes * X.powers(base, len(part.hashes)), out=total[1:])
    end = first + windows + part.window - 1
    content = X.mix((total[end] - total[first]) * X.powers(pow(base, -1, 1 << 64), len(total))[first]
                    + windows.astype(np.uint64))
    key = np.where(hot[at[head]], content, part.anchors[at[head]])
    return first, windows, key, content


STRETCHES = ("key bigint, content bigint, doc_id bigint, row_key bigint, start bigint, "
             "many boolean, words binary")


def _stretches(window: int, anchor: int):
    """Candidate stretches of documents with their answered anchors, each with its place; the
    smallest document of each content in a slice has its words too, and whether it is alone."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for rows, data, offsets in X.slices(batch, "text"):
                part = Slice(data, offsets, window, anchor)
                listed = rows.column("anchors")
                lengths = _lengths(listed)
                flat = listed.flatten()
                text_of = np.repeat(np.arange(len(listed)), lengths).astype(np.uint64)
                salt = X.mix(text_of + np.uint64(1))
                known = flat.field("anchor").to_numpy().view(np.uint64) ^ salt
                is_hot = flat.field("hot").to_numpy(zero_copy_only=False)
                mine = part.anchors ^ X.mix(part.texts.astype(np.uint64) + np.uint64(1))
                first, windows, key, content = _segments(
                    part, np.isin(mine, known), np.isin(mine, known[is_hot]))
                if not len(first):
                    continue
                texts = part.text_of[first]
                ids = rows.column("doc_id").to_numpy()[texts]
                order = np.lexsort((ids, content, key))
                once = np.concatenate([[True], (np.diff(key[order]) != 0) | (np.diff(content[order]) != 0)])
                pick = order[once]
                # Sorted by document last: a content has several if its ends differ.
                last = order[np.append(np.flatnonzero(once)[1:], len(order)) - 1]
                many = np.zeros(len(first), bool)
                many[pick] = ids[pick] != ids[last]
                words: list[bytes | None] = [None] * len(first)
                for at, low, n in zip(pick.tolist(), first[pick].tolist(), windows[pick].tolist(), strict=True):
                    words[at] = part.joined(low, low + n + window - 1)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(key.view(np.int64)), pa.array(content.view(np.int64)), pa.array(ids),
                     rows.column("row_key").take(pa.array(texts)),
                     pa.array(first - part.first[texts]), pa.array(many), pa.array(words, pa.binary())],
                    ["key", "content", "doc_id", "row_key", "start", "many", "words"])
    return run


def shard_answers(contents: list[bytes], ids: np.ndarray, window: int
                  ) -> tuple[list[np.ndarray], list[bool]]:
    """For each content, given with its smallest document: the smallest document of each of
    its windows, and whether any window is found elsewhere in the shard.

    Only the index answers: rows of an interval that reaches the window's length are located
    in the text, once for all windows that end in the same interval.
    """
    words = [c.split(b" ") for c in contents]
    lengths = np.array([len(w) for w in words])
    symbols = pa.array([w for ws in words for w in ws], pa.binary()).dictionary_encode().indices
    # Each content and a separator 0 after it.
    ends = np.cumsum(lengths + 1)
    begins = ends - lengths - 1
    text = np.zeros(ends[-1], np.int64)
    text[np.setdiff1d(np.arange(len(text)), ends - 1, assume_unique=True)] = symbols.to_numpy() + 1
    index = FMIndex(text)
    counts = lengths - window + 1
    starts = np.repeat(begins - np.concatenate([[0], np.cumsum(counts)[:-1]]), counts) + np.arange(counts.sum())
    low, high, length = index.search(text[starts[:, None] + np.arange(window)])
    found = (length == window) & (high - low > 1)
    answer = np.repeat(ids, counts)
    if found.any():
        heads, once, which = np.unique(low[found], return_index=True, return_inverse=True)
        sizes = high[found][once] - heads
        at = np.cumsum(sizes) - sizes
        rows = np.repeat(heads - at, sizes) + np.arange(sizes.sum())
        owner = np.searchsorted(begins, index.locate(rows), "right") - 1
        answer[found] = np.minimum.reduceat(ids[owner], at)[which]
    at = np.concatenate([[0], np.cumsum(counts)])
    spans = list(zip(at[:-1].tolist(), at[1:].tolist(), strict=True))
    return [answer[a:b] for a, b in spans], [bool(found[a:b].any()) for a, b in spans]


def _shards(window: int, shard_words: int):
    def answer(held: dict[tuple[int, int], tuple[int, bool, bytes]]) -> Iterator[pa.RecordBatch]:
        if not held:
            return
        ids = np.array([d for d, _, _ in held.values()])
        least, found = shard_answers([w for _, _, w in held.values()], ids, window)
        rows = [(k, c, a) for ((k, c), (_, many, _)), a, f in
                zip(held.items(), least, found, strict=True) if many or f]
        if rows:
            keys, contents, least = zip(*rows, strict=True)
            yield pa.RecordBatch.from_arrays(
                [pa.array(keys, pa.int64()), pa.array(contents, pa.int64()),
                 pa.array(least, pa.list_(pa.int64()))], ["key", "content", "least"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[tuple[int, int], tuple[int, bool, bytes]] = {}
        size, last = 0, None
        for batch in batches:
            for key, content, doc_id, many, words in zip(*(batch.column(c).to_pylist() for c in (
                    "key", "content", "doc_id", "many", "words")), strict=True):
                if key != last and size >= shard_words:
                    yield from answer(held)
                    held, size = {}, 0
                last = key
                old = held.get((key, content))
                if old is None:
                    size += words.count(b" ") + 1
                    held[key, content] = doc_id, many, words
                else:
                    held[key, content] = (min(doc_id, old[0]), many or old[1] or doc_id != old[0], words)
        yield from answer(held)
    return run


def _remove(window: int, with_text: bool):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for rows, data, offsets in X.slices(batch, "text"):
                _, _, first = X.words(data, offsets)
                hits = rows.column("hits")
                text_of = np.repeat(np.arange(len(hits)), _lengths(hits))
                hit = hits.flatten()
                least = hit.field("least")
                n = _lengths(least)
                begin = np.cumsum(n) - n
                at = np.repeat(first[text_of] + hit.field("start").to_numpy() - begin, n) + np.arange(n.sum())
                ids = rows.column("doc_id").to_numpy()
                at = at[least.flatten().to_numpy() < np.repeat(ids[text_of], n)]
                size = int(first[-1]) + window + 1
                cover = np.bincount(at, minlength=size) - np.bincount(at + window, minlength=size)
                stay = np.cumsum(cover)[:first[-1]] == 0
                marks, removed, kept = stay.tolist(), np.diff(np.concatenate([[0], np.cumsum(~stay)])[first]), []
                for low, high, a, b in zip(offsets[:-1].tolist(), offsets[1:].tolist(),
                                           first[:-1].tolist(), first[1:].tolist(), strict=True):
                    kept.append(b" ".join(compress(data[low:high].tobytes().split(), marks[a:b])))
                yield pa.RecordBatch.from_arrays(
                    [rows.column("doc_id"), rows.column("row_key"), pa.array(removed, pa.int64()),
                     pa.array([hashlib.sha256(k).hexdigest() for k in kept], pa.string())]
                    + ([pa.array([k.decode() for k in kept], pa.string())] if with_text else []),
                    ["doc_id", "row_key", "n_removed", "kept_sha256"] + ["kept"] * with_text)
    return run


def _lengths(lists: pa.ListArray) -> np.ndarray:
    return pa.compute.list_value_length(lists).to_numpy(zero_copy_only=False)


def remove_repeats(docs: DataFrame, doc_id: str = "doc_id", text: str = "text",
                   window: int = WINDOW, anchor: int = ANCHOR, hot: int = HOT,
                   shard_words: int = SHARD_WORDS, with_text: bool = False,
                   spread: int = SPREAD) -> DataFrame:
    """One row per input row: doc_id, n_words, n_removed, kept_sha256; integer ids.

    ``with_text`` adds the kept words joined by spaces as ``kept``, null where nothing is
    removed.
    """
    texts = docs.select(F.col(doc_id).cast("bigint").alias("doc_id"),
                        F.xxhash64(text).alias("row_key"),
                        F.coalesce(F.col(text), F.lit("")).alias("text"))
    signed = materialize(texts.mapInArrow(
        _signature,
        "doc_id bigint, row_key bigint, k0 bigint, k1 bigint, n_words bigint, sha string"), "words")
    classes = materialize(
        signed.filter(f"doc_id IS NOT NULL AND n_words >= {window}").groupBy("k0", "k1").agg(
            F.min(F.struct("doc_id", "row_key")).alias("at")).select(
            "k0", "k1", F.col("at.doc_id").alias("rep"), F.col("at.row_key").alias("rep_key")), "classes")

    dealt = texts.filter("doc_id IS NOT NULL").select("text").mapInArrow(
        _anchors(window, anchor, hot), "p bigint, v bigint, kind tinyint")
    same = Window.partitionBy(F.col("kind") == DIRECT, "p")
    shared = dealt.withColumns({
        "low": F.min("v").over(same), "high": F.max("v").over(same), "most": F.max("kind").over(same),
        "spread": F.count("*").over(same)})
    is_hot = (F.col("most") > PLAIN) | (F.col("spread") > spread)
    answers = shared.filter(f"kind = {DIRECT} OR (kind = {PLAIN} AND low <> high)").select(
        F.when(F.col("kind") == DIRECT, F.col("p")).otherwise(F.col("v")).alias("k0"),
        F.struct(F.when(F.col("kind") == DIRECT, F.col("v")).otherwise(F.col("p")).alias("anchor"),
                 ((F.col("kind") == DIRECT) | is_hot).alias("hot")).alias("a"))
    candidates, candidates_at = store(
        answers.groupBy("k0").agg(F.collect_set("a").alias("anchors"))
        .join(classes, "k0").select("rep", "rep_key", "anchors"), "candidates")

    listed = texts.join(candidates, (F.col("doc_id") == F.col("rep"))
                        & (F.col("row_key") == F.col("rep_key"))).select(
        "doc_id", "row_key", "text", "anchors")
    # One pass over the texts, stored: words of contents and places are read from it apart.
    stretches, stretches_at = store(
        listed.mapInArrow(X.frugal(_stretches(window, anchor)), STRETCHES), "stretches")
    discard(docs.sparkSession, candidates_at)
    contents = stretches.filter("words IS NOT NULL").select("key", "content", "doc_id", "many", "words")
    least = contents.repartition("key").sortWithinPartitions("key").mapInArrow(
        X.frugal(_shards(window, shard_words)), "key bigint, content bigint, least array<bigint>")
    places = stretches.select("key", "content", "doc_id", "row_key", "start")
    hits = materialize(
        places.join(least, ["key", "content"]).filter("array_min(least) < doc_id")
        .select("doc_id", "row_key", F.struct("start", "least").alias("hit"))
        .groupBy("doc_id", "row_key").agg(F.collect_list("hit").alias("hits")), "hits")
    discard(docs.sparkSession, stretches_at)
    changed = texts.join(hits.withColumnsRenamed({"doc_id": "hit_id", "row_key": "hit_key"}),
                         (F.col("doc_id") == F.col("hit_id")) & (F.col("row_key") == F.col("hit_key"))
                         ).select("doc_id", "row_key", "text", "hits").mapInArrow(
        _remove(window, with_text), "doc_id bigint, row_key bigint, n_removed bigint, "
        "kept_sha256 string" + ", kept string" * with_text)
    changed = changed.dropDuplicates(["doc_id", "row_key"]).withColumnsRenamed(
        {"doc_id": "rep", "row_key": "rep_key"})
    known = classes.join(changed, ["rep", "rep_key"], "left").drop("rep_key")
    out = signed.join(known, ["k0", "k1"], "left")
    copy = F.coalesce(F.col("doc_id") > F.col("rep"), F.lit(False))
    some = F.col("doc_id").isNotNull()
    columns = [
        "doc_id", "n_words",
        F.when(copy, F.col("n_words")).when(some, F.coalesce("n_removed", F.lit(0))).otherwise(0)
        .cast("bigint").alias("n_removed"),
        F.when(copy, F.lit(EMPTY_SHA)).when(some, F.coalesce("kept_sha256", "sha"))
        .otherwise(F.col("sha")).alias("kept_sha256")]
    if with_text:
        columns.append(F.when(copy, F.lit("")).when(some, F.col("kept")).alias("kept"))
    return out.select(*columns)

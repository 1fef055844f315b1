"""Phrase collocations by the stripes pattern.

A stripe belongs to a prefix of 0 to 3 words and counts what comes next: ``prefix -> {next
word: count}``. Tasks make stripes of their slices of text, stripes of a prefix are shuffled as
wholes and merged elementwise. One structure then gives

* the extensions of a phrase and their counts (the entries of its stripe),
* the total of a prefix (its own entry one level up; that of the empty prefix is the sum of
  its stripe), and
* the most frequent longer phrase around a phrase (the largest entry of its own stripe, and
  the largest entry that ends the stripe of a longer prefix).

Levels go from the empty prefix upwards. A phrase is frequent only if what is left without
its last and without its first word is, so a level is made of occurrences whose two parts
were frequent at the level below. That test is a Bloom filter of a fixed number of bits:
a wrong yes costs work, never a result, and a full filter only prunes less. Prefixes that
hold more than a thousandth of all words, of which there are fewer than a thousand a level,
have their stripes split by the next word; the empty prefix's is always split.

Two words or phrases are the same when their bytes are; hashes only steer pruning and splits.

Rules: null texts count as empty; a null language is ``und``; ids are not read; rows that
repeat count each; an empty table gives no rows; other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Window, functions as F

from leaseflow.llm import text as X
from leaseflow.sources.scratch import materialize

LEAST, LONGEST, SUBSUMED, TOP = 30, 4, 80, 2000
SLICE = 12 << 20
FILTER_BITS, PROBES = 1 << 27, 4
#: Parts of a split stripe; a prefix is split above this share of all words.
PARTS, HOT_SHARE = 64, 1000
SALTS = 8
UNKNOWN = "und"

SEPARATORS = X.byte_set(b".,;:!?\n\v\f\r")
BREAKS = SEPARATORS | X.byte_set(b" \t")
_STEP = np.uint64(int(X.stream(41, 1)[0]) | 1)

STRIPE = "lang string, prefix string, part int, nexts array<string>, counts array<bigint>"


def gram_hashes(hashes: np.ndarray, langs: np.ndarray, n: int) -> np.ndarray:
    """A hash of each run of n words from its words' hashes and its language's."""
    size = max(len(hashes) - n + 1, 0)
    total = langs[:size].copy()
    for k in range(n):
        total = total * _STEP + hashes[k:k + size]
    return X.mix(total)


def _probes(hashes: np.ndarray, bits: int) -> Iterator[np.ndarray]:
    step = X.mix(hashes) | np.uint64(1)
    for k in range(PROBES):
        yield (hashes + np.uint64(k) * step) & np.uint64(bits - 1)


def may_hold(words: np.ndarray, hashes: np.ndarray) -> np.ndarray:
    """Whether the filter (as 64-bit words) may hold each hash."""
    yes = np.ones(len(hashes), bool)
    for at in _probes(hashes, 64 * len(words)):
        yes &= (words[(at >> np.uint64(6)).astype(np.int64)] >> (at & np.uint64(63))) & np.uint64(1) != 0
    return yes


def phrase_hashes(langs: pa.Array, phrases: pa.Array, n: int) -> np.ndarray:
    """Hashes of space-joined phrases of n words, as :func:`gram_hashes` gives them."""
    split = pc.split_pattern(phrases, " ")
    words = X.string_hashes(split.flatten())
    lang = np.repeat(X.string_hashes(langs), n)
    return gram_hashes(words, lang, n)[::n] if len(words) else np.zeros(0, np.uint64)


def _filter_words(bits: int, n: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            hashes = phrase_hashes(batch.column("lang"), batch.column("phrase"), n)
            at = np.unique(np.concatenate(list(_probes(hashes, bits))))
            if len(at):
                yield pa.RecordBatch.from_arrays(
                    [pa.array((at >> np.uint64(6)).astype(np.int64)),
                     pa.array((np.uint64(1) << (at & np.uint64(63))).view(np.int64))], ["word", "mask"])
    return run


def frequency_filter(entries: DataFrame, n: int, bits: int = FILTER_BITS) -> np.ndarray:
    """The Bloom filter of phrases of n words (lang, phrase), at most ``bits`` bits."""
    rows = entries.mapInArrow(_filter_words(bits, n), "word bigint, mask bigint").groupBy("word").agg(
        F.bit_or("mask").alias("mask")).toArrow()
    words = np.zeros(bits // 64, np.uint64)
    words[rows.column("word").to_numpy()] = rows.column("mask").to_numpy().view(np.uint64)
    return words


def _joined(vocabulary: pa.Array, codes: np.ndarray, at: np.ndarray, n: int) -> pa.Array:
    """The n words from each place on, joined by a space."""
    if n == 0:
        return pa.array([""] * len(at), vocabulary.type)
    parts = [vocabulary.take(pa.array(codes[at + k])) for k in range(n)]
    return parts[0] if n == 1 else pc.binary_join_element_wise(*parts, pa.scalar(" ", vocabulary.type))


def _slice_stripes(data: np.ndarray, offsets: np.ndarray, langs: pa.Array, level: int,
                   known: np.ndarray | None, hot: np.ndarray) -> pa.RecordBatch | None:
    """The stripes of prefixes of ``level`` words in one slice of texts."""
    data = X.FOLD[data]
    starts, ends, first = X.words(data, offsets, BREAKS)
    n = len(starts)
    if not n:
        return None
    codes, vocabulary = X.word_codes(data, starts, ends)
    coded = langs.dictionary_encode()
    lang = np.repeat(np.asarray(coded.indices), np.diff(first))
    pieces = np.searchsorted(np.flatnonzero(SEPARATORS[data]), starts)
    del data, starts, ends
    joins = np.zeros(n, bool)  # whether the next word is in the same piece
    np.equal(pieces[1:], pieces[:-1], out=joins[:-1])
    joins[first[first > 0] - 1] = False
    del pieces
    hashes = X.string_hashes(vocabulary)
    size = len(vocabulary)
    if level == 0:
        _, where, ids = np.unique(lang, return_index=True, return_inverse=True)
        split, follow = np.ones(len(where), bool), codes
    else:
        grams = gram_hashes(hashes[codes], X.string_hashes(coded.dictionary)[lang], level)
        for k in range(level - 1):
            joins[:n - 1 - k] &= joins[1:n - k]
        # joins: a run of level + 1 words; it counts where the filter knows both runs of level words
        at = np.flatnonzero(joins[:len(grams) - 1])
        at = at[may_hold(known, grams[at])]
        at = at[may_hold(known, grams[at + 1])]
        if not len(at):
            return None
        follow, ids = codes[at + level], lang[at].astype(np.int64)
        for k in range(level):
            _, where, ids = np.unique(ids * size + codes[at + k], return_index=True, return_inverse=True)
        where = at[where]
        split = np.isin(grams[where], hot)
        del grams, at
    keys, counts = np.unique(ids * np.int64(size) + follow, return_counts=True)
    of, follow = keys // size, keys % size
    part = np.where(split[of], (hashes[follow] % np.uint64(PARTS)).astype(np.int64), 0)
    if part.any():
        order = np.lexsort((part, of))
        of, follow, counts, part = of[order], follow[order], counts[order], part[order]
    new = np.flatnonzero(np.concatenate([[True], (of[1:] != of[:-1]) | (part[1:] != part[:-1])]))
    bounds = pa.array(np.append(new, len(of)).astype(np.int32))
    place = where[of[new]]
    return pa.RecordBatch.from_arrays([
        coded.dictionary.take(pa.array(lang[place])).cast(pa.string()),
        _joined(vocabulary, codes, place, level).cast(pa.string()),
        pa.array(part[new].astype(np.int32)),
        pa.ListArray.from_arrays(bounds, vocabulary.take(pa.array(follow)).cast(pa.string())),
        pa.ListArray.from_arrays(bounds, pa.array(counts.astype(np.int64)))],
        ["lang", "prefix", "part", "nexts", "counts"])


def _stripes(level: int, known, hot: np.ndarray):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        words = known.value if known is not None else None
        for batch in batches:
            for part, data, offsets in X.slices(batch, "text", SLICE):
                made = _slice_stripes(data, offsets, part.column("lang"), level, words, hot)
                if made is not None:
                    for at in range(0, made.num_rows, 16384):
                        yield made.slice(at, 16384)
    return run


def merged_stripes(docs: DataFrame, level: int, known=None, hot: np.ndarray | None = None,
                   least: int = LEAST) -> DataFrame:
    """One row per part of a prefix's stripe: lang, prefix, part, total, best, entries.

    ``entries`` has (next, n) of what follows ``least`` times or more and ``best`` the largest
    n among them (null if there is none); ``total`` is the sum of all that was counted.
    """
    hot = np.zeros(0, np.uint64) if hot is None else hot
    dealt = docs.mapInArrow(X.frugal(_stripes(level, known, hot)), STRIPE).repartition("lang", "prefix", "part")
    key = ["lang", "prefix", "part"]
    # The partitioning of the stripes holds for both groupings, so neither shuffles.
    counts = dealt.select(*key, F.explode(F.arrays_zip("nexts", "counts")).alias("e")).groupBy(
        *key, F.col("e.nexts").alias("next")).agg(F.sum("e.counts").alias("n"))
    often = F.col("n") >= least
    return counts.groupBy(*key).agg(
        F.sum("n").alias("total"), F.max(F.when(often, F.col("n"))).alias("best"),
        F.collect_list(F.when(often, F.struct("next", "n"))).alias("entries"))


def extensions(stripes: DataFrame, level: int) -> DataFrame:
    """The frequent phrases of level + 1 words: lang, phrase, n, rest (without its first word)."""
    rows = stripes.select("lang", "prefix", F.explode("entries").alias("e"))
    if level == 0:
        return rows.select("lang", F.col("e.next").alias("phrase"), F.col("e.n").alias("n"),
                           F.lit(None).cast("string").alias("rest"))
    phrase = F.concat_ws(" ", "prefix", "e.next")
    return rows.select("lang", phrase.alias("phrase"), F.col("e.n").alias("n"),
                       F.expr("substring(phrase, instr(phrase, ' ') + 1)").alias("rest"))


def collocations(docs: DataFrame, text: str = "text", lang: str = "lang", least: int = LEAST,
                 subsumed: int = SUBSUMED, top: int | None = TOP,
                 filter_bits: int = FILTER_BITS) -> DataFrame:
    """Each language's phrases of 2 to 4 words by score: lang, rank, phrase, a, l, r, n, score."""
    spark = docs.sparkSession
    source = docs.select(F.coalesce(F.col(lang).cast("string"), F.lit(UNKNOWN)).alias("lang"),
                         F.col(text).alias("text")).filter(F.length("text") > 0)
    levels: list[DataFrame] = []
    phrases: list[DataFrame] = []
    known, hot = None, np.zeros(0, np.uint64)
    for level in range(LONGEST):
        stripes = materialize(merged_stripes(source, level, known, hot, least), f"stripes{level}")
        levels.append(stripes)
        phrases.append(extensions(stripes, level))
        if known is not None:
            known.unpersist()
        if level + 1 == LONGEST:
            break
        if level == 0:
            words = stripes.agg(F.sum("total")).first()[0] or 0
        known = spark.sparkContext.broadcast(frequency_filter(phrases[level], level + 1, filter_bits))
        # A phrase in more than a thousandth of all places: fewer than a thousand of them.
        often = phrases[level].filter(F.col("n") * HOT_SHARE > words).select("lang", "phrase").toArrow()
        hot = phrase_hashes(often.column("lang").combine_chunks(),
                            often.column("phrase").combine_chunks(), level + 1)
    return _ranked(levels, phrases, subsumed, top)


def _ranked(levels: list[DataFrame], phrases: list[DataFrame], subsumed: int, top: int | None) -> DataFrame:
    """Scores and ranks of what the stripes of all levels hold."""
    totals = levels[0].groupBy("lang").agg(F.sum("total").alias("words"))
    prefixes, inner = None, None
    for level in range(1, LONGEST):
        own = levels[level].groupBy("lang", F.col("prefix").alias("phrase")).agg(F.max("best").alias("best"))
        ending = phrases[level].groupBy("lang", F.col("rest").alias("phrase")).agg(F.max("n").alias("best"))
        around = own.unionByName(ending)
        prefixes = around if prefixes is None else prefixes.unionByName(around)
        sized = phrases[level].withColumn("m", F.lit(level + 1))
        inner = sized if inner is None else inner.unionByName(sized)
    prefixes = prefixes.filter(F.instr("phrase", " ") > 0).groupBy("lang", "phrase").agg(
        F.max("best").alias("best"))
    whole = "decimal(38,0)"
    bounded = inner.join(prefixes, ["lang", "phrase"], "left")
    kept = bounded.filter(F.col("best").isNull() | (F.lit(100).cast(whole) * F.col("best").cast("decimal(20,0)")
                                                    < F.lit(subsumed).cast(whole) * F.col("n").cast("decimal(20,0)")))
    kept = materialize(kept.select("lang", "phrase", F.col("n").alias("a"), "m"), "phrases")
    counts = phrases[0].select("lang", "phrase", F.col("n").alias("count"))
    for level in range(1, LONGEST - 1):
        counts = counts.unionByName(phrases[level].select("lang", "phrase", F.col("n").alias("count")))
    # A word may begin or end very many phrases: the counts are spread over salts.
    known = counts.withColumn("salt", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))))
    cuts = kept.withColumn("k", F.explode(F.sequence(F.lit(1), F.col("m") - 1))).withColumn(
        "first", F.expr("substring_index(phrase, ' ', k)")).withColumn(
        "rest", F.expr("substring_index(phrase, ' ', k - m)")).withColumn(
        "salt", F.pmod(F.xxhash64("phrase"), F.lit(SALTS)).cast("int"))

    def looked_up(rows: DataFrame, part: str, name: str) -> DataFrame:
        side = known.select("lang", "salt", F.col("phrase").alias(part), F.col("count").alias(name))
        return rows.join(side, ["lang", "salt", part])

    both = looked_up(looked_up(cuts, "first", "l"), "rest", "r")
    score = F.expr("(2000000 * cast(a AS decimal(20,0))) div (cast(l AS decimal(20,0)) + r)")
    scored = both.withColumn("score", score).groupBy("lang", "phrase", "a").agg(
        F.min_by(F.struct("score", "l", "r"), F.struct("score", "k")).alias("cut")).select(
        "lang", "phrase", "a", F.col("cut.l").alias("l"), F.col("cut.r").alias("r"),
        F.col("cut.score").alias("score"))
    order = Window.partitionBy("lang").orderBy(F.desc("score"), F.desc("a"), "phrase")
    ranked = scored.withColumn("rank", F.row_number().over(order))
    if top is not None:
        ranked = ranked.filter(F.col("rank") <= top)
    return ranked.join(totals, "lang").select(
        "lang", F.col("rank").cast("bigint").alias("rank"), "phrase", "a", "l", "r",
        F.col("words").alias("n"), "score")

"""Collocations against a plain count of all phrases."""

from __future__ import annotations

import random
import re
from collections import Counter, defaultdict

import numpy as np
import pytest

from leaseflow.llm import collocations as C
from leaseflow.llm import queries as Q
from tests.conftest import SMALL
from tests.llm.data import documents, edge_rows

COLUMNS = ["lang", "rank", "phrase", "a", "l", "r", "n", "score"]


def plain(rows, least=30, top=2000):
    """rows of (text, lang)."""
    counts, words = defaultdict(Counter), Counter()
    for text, lang in rows:
        lang = "und" if lang is None else lang
        lower = re.sub("[A-Z]", lambda m: m.group().lower(), text or "")
        for piece in re.split("[.,;:!?\n\v\f\r]", lower):
            w = tuple(re.findall("[^ \t]+", piece))
            words[lang] += len(w)
            for m in range(1, 5):
                counts[lang].update(w[i:i + m] for i in range(len(w) - m + 1))
    out = []
    for lang, f in counts.items():
        often = {p: n for p, n in f.items() if len(p) > 1 and n >= least}
        around = defaultdict(int)
        for p, n in often.items():
            for m in range(2, len(p)):
                for i in range(len(p) - m + 1):
                    around[p[i:i + m]] = max(around[p[i:i + m]], n)
        scored = []
        for p, a in often.items():
            if 100 * around[p] >= 80 * a:
                continue
            score, k = min((2000000 * a // (f[p[:k]] + f[p[k:]]), k) for k in range(1, len(p)))
            scored.append((-score, -a, " ".join(p).encode(), f[p[:k]], f[p[k:]]))
        for rank, (score, a, phrase, left, right) in enumerate(sorted(scored)[:top], 1):
            out.append((lang, rank, phrase.decode(), -a, left, right, words[lang], -score))
    return sorted(out)


def result(frame):
    assert frame.columns == COLUMNS
    return sorted(tuple(r) for r in frame.collect())


def texts(seed, n, vocabulary=12):
    """Short vocabularies, so phrases are frequent; set phrases; all separators."""
    rng = random.Random(seed)
    marks = [" ", " ", " ", "  ", "\t", ", ", ". ", "\n", "! ", ":", ";", "?", "\r\n", "\v", "\f"]
    fixed = ["New York city hall", "once upon a time", "ÉTÉ chaud", "a b"]
    rows = []
    for _ in range(n):
        parts = []
        for _ in range(rng.randrange(40)):
            parts.append(rng.choice(fixed) if rng.random() < 0.1 else f"W{int(rng.random() ** 2 * vocabulary)}")
            parts.append(rng.choice(marks))
        rows.append(("".join(parts), rng.choice(["en", "en", "en", "de", None])))
    return rows


@pytest.mark.parametrize("least,top", [(30, 2000), (3, 7), (8, None)])
def test_equals_plain_counts(spark, least, top):
    rows = texts(least, 600)
    docs = documents(spark, [(i, t, "s", lang) for i, (t, lang) in enumerate(rows)])
    expected = plain(rows, least, top)
    assert expected
    assert result(C.collocations(docs, least=least, top=top)) == expected


def test_slices_splits_and_a_full_filter_change_nothing(spark, monkeypatch):
    """Tiny slices, every prefix split, and a filter that says yes to everything."""
    rows = texts(5, 300, 30)
    docs = documents(spark, [(i, t, "s", lang) for i, (t, lang) in enumerate(rows)]).repartition(5)
    expected = plain(rows, 5)
    monkeypatch.setattr(C, "SLICE", 200)
    monkeypatch.setattr(C, "HOT_SHARE", 10**9)
    assert result(C.collocations(docs, least=5)) == expected
    assert result(C.collocations(docs, least=5, filter_bits=64)) == expected


def test_stripes_are_split_by_the_next_word(spark):
    rows = [(i, "hot " + " hot ".join(f"x{i % 7}y{k}" for k in range(300)), "s", "en") for i in range(40)]
    docs = documents(spark, rows).select("text", "lang")
    level0 = C.merged_stripes(docs, 0, least=1)
    assert level0.count() == C.PARTS  # the empty prefix
    known = spark.sparkContext.broadcast(C.frequency_filter(C.extensions(level0, 0), 1))
    hot = C.phrase_hashes(*[spark.createDataFrame([("en", "hot")], "lang string, phrase string").toArrow()
                            .column(c).combine_chunks() for c in ("lang", "phrase")], 1)
    parts = C.merged_stripes(docs, 1, known, hot, least=1).filter("prefix = 'hot'")
    assert parts.count() > C.PARTS / 2
    assert parts.groupBy().sum("total").first()[0] == 40 * 300
    whole = C.merged_stripes(docs, 1, known, least=1).filter("prefix = 'hot'").collect()
    assert len(whole) == 1 and whole[0]["total"] == 40 * 300 and whole[0]["best"] == max(
        e["n"] for e in whole[0]["entries"])


def test_edge_rows(spark):
    rows = [r for r in edge_rows() for _ in range(3)]
    got = result(C.collocations(documents(spark, rows), least=3))
    assert got == plain([(r[1], r[3] if len(r) > 3 else "en") for r in rows], 3)
    assert result(C.collocations(documents(spark, []))) == []
    assert result(C.collocations(documents(spark, [(1, None), (2, " .,\n"), (3, "")]))) == []


def test_a_language_column_may_be_all_null(spark):
    rows = [(i, "alpha beta gamma", "s", None) for i in range(40)]
    got = result(C.collocations(documents(spark, rows)))
    assert got == [("und", 1, "alpha beta gamma", 40, 40, 40, 120, 1000000)]


def test_counts_beyond_64_bit_products(spark):
    """Exact scores from counts of 10^13, as merged stripes of a huge corpus would hold."""
    big = 10**13
    entry = "array<struct<next:string,n:bigint>>"
    schema = f"lang string, prefix string, part int, total bigint, best bigint, entries {entry}"

    def stripes(rows):
        return spark.createDataFrame(rows, schema)

    levels = [stripes([("en", "", 0, 9 * big, 3 * big, [("a", 3 * big + 1), ("b", 3 * big)])]),
              stripes([("en", "a", 0, 3 * big + 1, big + 7, [("b", big + 7)]), ("en", "b", 0, 3 * big, None, [])]),
              stripes([("en", "a b", 0, big + 7, None, [])]), stripes([])]
    got = result(C._ranked(levels, [C.extensions(s, i) for i, s in enumerate(levels)], 80, 10))
    assert got == [("en", 1, "a b", big + 7, 3 * big + 1, 3 * big, 9 * big,
                    2000000 * (big + 7) // (6 * big + 1))]


def test_filter_has_no_false_no():
    hashes = np.random.default_rng(1).integers(0, 1 << 63, 5000).astype(np.uint64)
    words = np.zeros(1 << 12, np.uint64)
    for at in C._probes(hashes, 64 << 12):
        np.bitwise_or.at(words, (at >> np.uint64(6)).astype(np.int64), np.uint64(1) << (at & np.uint64(63)))
    assert C.may_hold(words, hashes).all()


def test_query_on_the_given_table(spark):
    rows = [(r["text"], r["lang"]) for r in
            spark.read.parquet(f"{SMALL}/documents.parquet").select("text", "lang").collect()]
    assert result(Q.QUERIES["op12_collocations"](spark, SMALL)) == plain(rows)

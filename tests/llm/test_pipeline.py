"""The pipeline's stages against plain versions of their decisions."""

from __future__ import annotations

import re

import corpus_pipeline as C
from leaseflow.llm import mixing, ngram_join, queries, toxicity
from leaseflow.sources.scratch import materialize
from tests.conftest import SMALL
from tests.llm import test_mixing, test_ngram_join, test_packing
from tests.oracle_compare import compare, connect


def test_stages_decide_as_plain_versions(spark):
    docs = spark.read.parquet(f"{SMALL}/documents.parquet")
    columns = docs.columns
    seen = {}
    for name, stage in C.STAGES:
        docs = materialize(stage(spark, docs, SMALL), name)
        seen[name] = docs.collect()
        if name != "packing":
            assert docs.columns == columns
    everything = spark.read.parquet(f"{SMALL}/documents.parquet")

    # Toxicity: the model's own decisions, computed apart.
    model = toxicity.fit(everything, spark.read.parquet(f"{SMALL}/labels.parquet"))
    rejected = {r.doc_id for r in toxicity.score(everything, model).collect() if r.rejected}
    assert {r.doc_id for r in seen["toxicity"]} == {r.doc_id for r in everything.collect()} - rejected

    # Copies: the smallest id of each normalised text.
    first: dict[str, int] = {}
    for r in sorted(seen["toxicity"], key=lambda r: r.doc_id):
        first.setdefault(re.sub(r"[\x20\x09-\x0D]+", " ", r.text or ""), r.doc_id)
    assert {r.doc_id for r in seen["exact_dedup"]} == set(first.values())

    # Near copies: the smallest id of each class.
    classes = test_ngram_join.brute([(r.doc_id, r.text) for r in seen["exact_dedup"]])
    assert {r.doc_id for r in seen["ngram_jaccard_join"]} == {c[0] for c in classes if c[3]}

    # Mixing: whole documents, each source near its target.
    rows = [(r.doc_id, r.text, r.source) for r in seen["ngram_jaccard_join"]]
    frame = spark.createDataFrame(seen["ngram_jaccard_join"], everything.schema)
    weights = mixing.quality_weights(spark.read.parquet(f"{SMALL}/labels.parquet"))
    chosen = mixing.mix(frame, weights, whole=True).collect()
    test_mixing.check(rows, chosen, whole=True)
    times: dict[int, int] = {}
    for r in seen["mixing"]:
        times[r.doc_id] = times.get(r.doc_id, 0) + 1
    assert {r.doc_id: r.taken // r.size for r in chosen if r.taken} == {
        i: n for i, n in times.items() if n and next(c.size for c in chosen if c.doc_id == i)}

    # Packing: each copy's ids once.
    lengths = {r.doc_id: len(test_packing.ids(r.text)) for r in seen["mixing"]}
    total: dict[int, int] = {}
    for p in seen["packing"]:
        total[p.doc_id] = total.get(p.doc_id, 0) + p.length
    assert total == {i: lengths[i] * n for i, n in times.items()}


def test_run_is_repeatable(spark):
    decided = lambda: sorted((r.doc_id, r.start, r.length, r.ids_crc32)
                             for r in C.run(spark, SMALL).collect())
    assert decided() == decided()


def test_registered():
    import __spark_entry__ as entry
    names = [n for n in entry.queries() if re.match(r"op\d+_", n)]
    assert sorted(int(re.match(r"op(\d+)_", n)[1]) for n in names) == list(range(1, 11))
    assert "pipeline" in entry.queries() and set(queries.ORACLE) <= set(entry.oracle_sql())
    assert len(C.STAGES) == 5 and ngram_join.THRESHOLD == 0.8 and ngram_join.WORDS == 5


def test_dedup_query_equals_sql(spark):
    name = "op9_exact_dedup"
    rows, _, problem = compare(queries.QUERIES[name](spark, SMALL), connect(SMALL), queries.ORACLE[name])
    assert rows and not problem

"""The classifier: held-out accuracy, what it learns from, thresholds, edge cases."""

from __future__ import annotations

import random
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from leaseflow.llm import queries as Q
from leaseflow.llm import toxicity as T
from tests.conftest import MEDIUM
from tests.llm.data import SCHEMA, documents, edge_rows, sentence

BAD = {"en": ["vile", "filth"], "de": ["grimax", "grimok", "grimel"]}


def corpus(n: int, seed: int = 1):
    """Texts with labels: toxic ones hold a few marked words of their language."""
    rng = random.Random(seed)
    rows, labels = [], []
    for i in range(n):
        lang = "de" if i % 3 == 0 else "en"
        words = sentence(rng, rng.randrange(20, 120), 900).split()
        toxic = int(rng.random() < 0.15)
        if toxic:
            for _ in range(rng.randrange(2, 5)):
                words.insert(rng.randrange(len(words)), rng.choice(BAD[lang]))
        rows.append((i, " ".join(words), "s", lang))
        labels.append((i, 0, toxic))
    return rows, labels


@pytest.fixture(scope="module")
def fitted(spark):
    rows, labels = corpus(1500)
    docs = documents(spark, rows)
    return docs, T.fit(docs, spark.createDataFrame(labels, "doc_id bigint, quality int, toxic int")), labels


def test_held_out_accuracy(fitted):
    docs, model, labels = fitted
    got = T.score(docs, model).withColumn("held_out", T.held_out()).collect()
    toxic = {i: y for i, _, y in labels}
    assert {r.doc_id for r in got if r.held_out} == {
        i for i in toxic if zlib.crc32(str(i).encode()) % 5 == 0}
    test = [(toxic[r.doc_id], r) for r in got if r.held_out]
    for decide in (lambda r: r.score >= 0.5, lambda r: r.rejected):
        right = np.mean([decide(r) == bool(y) for y, r in test])
        found = np.mean([decide(r) for y, r in test if y])
        assert right > 0.97 and found > 0.9
    assert set(model.thresholds) == {"en", "de"}


def test_scores_depend_on_text_alone(spark, fitted):
    docs, model, _ = fitted
    some = docs.limit(200)
    other = some.withColumns({"doc_id": F.col("doc_id") + 10**6, "lang": F.lit(None).cast("string"),
                              "source": F.lit("z")})
    scores = lambda d: sorted(r.score for r in T.score(d, model).collect())
    assert scores(some) == scores(other)


def test_held_out_labels_are_not_learned(spark):
    rows, labels = corpus(300, 5)
    docs = documents(spark, rows)
    turned = [(i, q, 1 - y if zlib.crc32(str(i).encode()) % 5 == 0 else y) for i, q, y in labels]
    models = [T.fit(docs, spark.createDataFrame(ls, "doc_id bigint, quality int, toxic int"))
              for ls in (labels, turned)]
    assert (models[0].embed == models[1].embed).all() and models[0].bias == models[1].bias


def test_edge_cases(spark, fitted):
    _, model, _ = fitted
    rows = edge_rows()
    got = T.score(documents(spark, rows), model).collect()
    assert len(got) == len(rows) and all(0 <= r.score <= 1 for r in got)
    blank = {r.score for r in got if r.doc_id in (1, 2, 3)}
    assert len(blank) == 1
    assert T.score(documents(spark, [(None, "x")]), model).withColumn(
        "h", T.held_out()).first().h is True
    left = T.drop_toxic(documents(spark, rows), model)
    assert left.columns == documents(spark, rows).columns
    assert left.count() == sum(not r.rejected for r in got)
    assert T.score(spark.createDataFrame([], SCHEMA), model).count() == 0


@pytest.mark.parametrize("labels", [[], [(1, 0, 0)], [(1, 0, None), (None, 0, 1)]])
def test_without_labels_of_both_kinds(spark, labels):
    docs = documents(spark, edge_rows())
    model = T.fit(docs, spark.createDataFrame(labels, "doc_id bigint, quality int, toxic int"))
    assert {(r.score, r.rejected) for r in T.score(docs, model).collect()} == {(0.0, False)}


def test_the_sample_is_bounded(spark):
    rows, labels = corpus(400, 6)
    frame = spark.createDataFrame(labels + labels, "doc_id bigint, quality int, toxic int")
    got = T.sample(documents(spark, rows), frame, "doc_id", "text", "lang", "toxic", (20, 30)).collect()
    assert len(got) == 50 and len({r.doc_id for r in got}) == 50


def test_query(spark):
    """All documents come back and most labels of the held-out fold are met."""
    got = {r.doc_id: r for r in Q.QUERIES["op1_toxicity"](spark, MEDIUM).collect()}
    docs = spark.read.parquet(f"{MEDIUM}/documents.parquet")
    assert len(got) == docs.count()
    labels = spark.read.parquet(f"{MEDIUM}/labels.parquet").collect()
    held = [(r.toxic, got[r.doc_id].predicted) for r in labels if got[r.doc_id].held_out]
    assert np.mean([a == b for a, b in held]) > 0.95
    assert all(r.predicted == int(r.score >= 0.5) for r in got.values())

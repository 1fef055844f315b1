"""Convolutional text classifier for toxicity, trained in numpy, applied by Spark tasks.

A word's embedding is the sum of four hashed rows: the whole word and its first four,
five and six bytes (lower-cased), so that spellings which share a stem share what is learned.
Filters of widths one to three run over the words, ReLU and max pooling give one number a
filter, a logistic unit the score. Training starts from smoothed log-odds of the hashed rows
in one dimension (elsewhere at random) and goes on with Adagrad.

Training takes a bounded sample: at most ``MOST_TOXIC`` toxic and ``MOST_CLEAN`` clean
labelled documents, whole texts, those with the smallest hash of the id. Only the sample goes
to the driver. Scores depend on the text alone. A fifth of the sample is not trained on; it
gives a decision threshold for each language, 0.5 where it has too few toxic documents.

Rules: null, empty and word-less texts get the score of an empty text; documents with a null
id count as held out; a label of an id is toxic if any of its rows is; ids of null or without
label are not learned from; without labels of both kinds every score is 0 and nothing is
rejected; an empty table gives no rows; other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from leaseflow.llm import text as X

MOST_TOXIC, MOST_CLEAN = 2000, 4000
FOLDS = 5
ROWS_BITS, DIM, FILTERS, WIDTHS = 16, 8, 8, (1, 2, 3)
PREFIXES = (4, 5, 6)
EPOCHS, BATCH = 5, 48
#: Step sizes: embedding rows, filters and output.
EMBED_RATE, RATE = 0.004, 0.02
#: Documents at which a hashed row's log-odds count by half.
RARE = 8.0
#: Toxic documents of a language needed for a threshold of its own.
LEAST_TOXIC = 5
PAD = max(WIDTHS) - 1
SCORE_BYTES = 1 << 20


def held_out(doc_id: str = "doc_id") -> Column:
    return F.coalesce(F.crc32(F.col(doc_id).cast("string")) % FOLDS == 0, F.lit(True))


def hashed_words(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(words, kinds) embedding rows and the first word of each text, with padding words
    (row -1) after each text."""
    starts, ends, first = X.words(data, offsets, X.BREAKS)
    kinds = [X.word_hashes(data, starts, ends, True)]
    for k in PREFIXES:
        kinds.append(X.mix(X.word_hashes(data, starts, np.minimum(starts + k, ends), True)
                           + np.uint64(k)))
    rows = np.stack([(h >> np.uint64(64 - ROWS_BITS)).astype(np.int32) for h in kinds], axis=1)
    texts = len(offsets) - 1
    where = first + PAD * np.arange(texts + 1)
    out = np.full((where[-1], len(kinds)), -1, np.int32)
    out[np.arange(len(rows)) + PAD * np.repeat(np.arange(texts), np.diff(first))] = rows
    return out, where


@dataclass
class Model:
    """Weights and thresholds; a few MB, sent to tasks with the function that uses it."""

    embed: np.ndarray
    filters: list[np.ndarray]  # by width: (width, DIM, FILTERS)
    out: np.ndarray
    bias: float
    thresholds: dict[str | None, float] = field(default_factory=dict)
    trained: bool = True

    def maps(self, words: np.ndarray) -> tuple[np.ndarray, list[np.ndarray]]:
        """Embeddings and, by width, filter outputs at each position (0 on padding)."""
        x = self.embed[words[:, 0]]
        for k in range(1, words.shape[1]):
            x = x + self.embed[words[:, k]]
        pad = words[:, 0] < 0
        maps = []
        for width, w in zip(WIDTHS, self.filters, strict=True):
            a = x @ w[0]
            for o in range(1, width):
                a[:-o] += x[o:] @ w[o]
            np.maximum(a, 0, out=a)
            a[pad] = 0
            maps.append(a)
        return x, maps

    def scores(self, words: np.ndarray, where: np.ndarray) -> np.ndarray:
        if not self.trained:
            return np.zeros(len(where) - 1)
        _, maps = self.maps(words)
        pooled = np.concatenate([np.maximum.reduceat(a, where[:-1]) for a in maps], axis=1)
        logit = np.clip(pooled.astype(np.float64) @ self.out + self.bias, -30, 30)
        return 1 / (1 + np.exp(-logit))

    def threshold(self, lang: str | None) -> float:
        return self.thresholds.get(lang, 0.5)


def _start(docs: list[np.ndarray], labels: np.ndarray, rng: np.random.Generator) -> Model:
    rows, kinds = 1 << ROWS_BITS, 1 + len(PREFIXES)
    n = np.array([(labels == 0).sum(), (labels == 1).sum()])
    embed = rng.normal(0, 0.05, (rows + 1, DIM)).astype(np.float32)
    embed[:, :kinds] = 0
    for kind in range(kinds):
        found = np.zeros((2, rows + 1))
        for words, y in zip(docs, labels, strict=True):
            found[int(y), np.unique(words[:, kind])] += 1
        odds = np.log((found[1] + 0.2) / (n[1] + 1)) - np.log((found[0] + 0.2) / (n[0] + 1))
        total = found.sum(0)
        odds *= total / (total + RARE)  # rare rows say little
        seen = total > 0
        embed[seen, kind] = np.clip(odds[seen], -1, 5)
    embed[rows] = 0  # padding
    filters = [rng.normal(0, 0.05, (w, DIM, FILTERS)).astype(np.float32) for w in WIDTHS]
    for f in filters:
        for kind in range(kinds):
            f[:, kind, kind] += 0.5
    out = rng.normal(0, 0.05, FILTERS * len(WIDTHS))
    out.reshape(len(WIDTHS), FILTERS)[:, :kinds] += 0.3
    return Model(embed, filters, out, -3.0)


def train(docs: list[np.ndarray], labels: np.ndarray, seed: int = 7) -> Model:
    """Fits the model to documents given as rows of :func:`hashed_words`."""
    rng = np.random.default_rng(seed)
    model = _start(docs, labels, rng)
    seen_embed = np.full(model.embed.shape, 1e-3, np.float32)
    seen = [np.full(p.shape, 1e-3, np.float32) for p in model.filters]
    seen_out, seen_bias = np.full(model.out.shape, 1e-3), 1e-3
    for epoch in range(EPOCHS):
        order = rng.permutation(len(docs))
        for at in range(0, len(order), BATCH):
            pick = order[at:at + BATCH]
            words = np.concatenate([docs[i] for i in pick])
            where = np.concatenate([[0], np.cumsum([len(docs[i]) for i in pick])])
            x, maps = model.maps(words)
            best = [np.stack([low + a[low:high].argmax(0) for low, high in
                              zip(where[:-1], where[1:], strict=True)]) for a in maps]
            pooled = np.concatenate([np.take_along_axis(a, b, 0) for a, b in zip(maps, best, strict=True)],
                                    axis=1).astype(np.float64)
            p = 1 / (1 + np.exp(-np.clip(pooled @ model.out + model.bias, -30, 30)))
            slope = (p - labels[pick]) / len(pick)
            back = (slope[:, None] * model.out * (pooled > 0)).astype(np.float32)
            g_out, g_bias = pooled.T @ slope + 1e-4 * model.out, slope.sum()
            rows, row_grads, g_filters = [], [], []
            for k, (width, w) in enumerate(zip(WIDTHS, model.filters, strict=True)):
                d = back[:, k * FILTERS:(k + 1) * FILTERS]
                g = np.zeros_like(w)
                for o in range(width):
                    spot = np.minimum(best[k] + o, len(words) - 1)
                    g[o] = np.einsum("nf,nfd->df", d, x[spot])
                    dx = d[:, :, None] * w[o].T[None]
                    for c in range(words.shape[1]):
                        rows.append(words[spot, c].ravel())
                        row_grads.append(dx.reshape(-1, DIM))
                g_filters.append(g + 1e-4 * w)
            rows, at_row = np.unique(np.concatenate(rows), return_inverse=True)
            g_embed = np.zeros((len(rows), DIM), np.float32)
            np.add.at(g_embed, at_row, np.concatenate(row_grads))
            g_embed[rows < 0] = 0  # padding stays zero
            seen_embed[rows] += g_embed * g_embed
            model.embed[rows] -= EMBED_RATE * g_embed / np.sqrt(seen_embed[rows])
            for value, grad, sum_ in zip(model.filters, g_filters, seen, strict=True):
                sum_ += grad * grad
                value -= RATE * grad / np.sqrt(sum_)
            seen_out += g_out * g_out
            model.out -= RATE * g_out / np.sqrt(seen_out)
            seen_bias += g_bias * g_bias
            model.bias -= RATE * g_bias / np.sqrt(seen_bias)
    return model


def calibrate(scores: np.ndarray, labels: np.ndarray, langs: list, least: float = 0.2
              ) -> dict[str | None, float]:
    """By language, the threshold of the best F1, halfway to the next lower score."""
    out = {}
    langs = np.array([str(v) if v is not None else None for v in langs], object)
    for lang in set(langs.tolist()):
        mine = langs == lang
        s, y = scores[mine], labels[mine]
        if y.sum() < LEAST_TOXIC or y.sum() == len(y):
            continue
        order = np.argsort(-s, kind="stable")
        s, hits = s[order], np.cumsum(y[order])
        f1 = 2 * hits / (np.arange(1, len(s) + 1) + y.sum())
        f1[:-1][s[:-1] == s[1:]] = -1
        at = int(f1.argmax())
        low = s[at + 1] if at + 1 < len(s) else 0.0
        out[lang] = float(np.clip((s[at] + low) / 2, least, 1 - least))
    return out


def _featurize(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for rows, data, offsets in X.slices(batch, "text"):
            words, where = hashed_words(data, offsets)
            # Without padding, two bytes a row suffice.
            blobs = [words[a:b - PAD].astype("<u2").tobytes()
                     for a, b in zip(where[:-1], where[1:], strict=True)]
            yield pa.RecordBatch.from_arrays(
                [rows.column("doc_id"), rows.column("lang"), rows.column("toxic"),
                 pa.array(blobs, pa.binary())], ["doc_id", "lang", "toxic", "words"])


def sample(docs: DataFrame, labels: DataFrame, doc_id: str, text: str, lang: str, toxic: str,
           most: tuple[int, int]) -> DataFrame:
    """Bounded labelled sample (doc_id, lang, toxic, words), by hash of the id.

    The ids are chosen from the labels, so at most sum(most) of them are broadcast.
    """
    known = labels.filter(F.col(toxic).isNotNull() & ~held_out(doc_id)).groupBy(
        F.col(doc_id).cast("bigint").alias("label_id")).agg(F.max(F.col(toxic).cast("int")).alias("toxic"))
    chosen = [known.filter(F.col("toxic") == y).orderBy(F.xxhash64("label_id"), "label_id").limit(n)
              for y, n in zip((1, 0), most, strict=True)]
    ids = F.broadcast(chosen[0].unionByName(chosen[1]))
    rows = docs.select(F.col(doc_id).cast("bigint").alias("doc_id"), F.col(text).alias("text"),
                       F.col(lang).cast("string").alias("lang"))
    return rows.join(ids, F.col("doc_id") == F.col("label_id")).select(
        "doc_id", "text", "lang", "toxic").limit(2 * sum(most)).mapInArrow(
        _featurize, "doc_id bigint, lang string, toxic int, words binary")


def fit(docs: DataFrame, labels: DataFrame, doc_id: str = "doc_id", text: str = "text",
        lang: str = "lang", toxic: str = "toxic",
        most: tuple[int, int] = (MOST_TOXIC, MOST_CLEAN)) -> Model:
    """Trains on the labelled sample and calibrates thresholds by language."""
    rows = sample(docs, labels, doc_id, text, lang, toxic, most).toArrow().sort_by("doc_id")
    y = rows["toxic"].to_numpy().astype(np.float64)
    if not (0 < y.sum() < len(y)):
        nothing = np.zeros((1, DIM), np.float32)
        return Model(nothing, [], np.zeros(1), 0.0, trained=False)
    width = 1 + len(PREFIXES)
    pad = np.full((PAD, width), -1, np.int32)
    words = [np.concatenate([np.frombuffer(b.as_buffer(), "<u2").reshape(-1, width), pad])
             for b in rows["words"]]
    test = (X.mix(rows["doc_id"].to_numpy().astype(np.uint64)) % np.uint64(5) == 0)
    if not (0 < y[~test].sum() < (~test).sum()):
        test[:] = False
    model = train([w for w, t in zip(words, test, strict=True) if not t], y[~test])
    if test.any():
        kept = [w for w, t in zip(words, test, strict=True) if t]
        where = np.concatenate([[0], np.cumsum([len(w) for w in kept])])
        langs = [v for v, t in zip(rows["lang"].to_pylist(), test, strict=True) if t]
        words, y = np.concatenate(kept), y[test]
        # The bias moves so that 0.5 is the best threshold over all languages.
        best = calibrate(model.scores(words, where), y, ["all"] * len(y), 0.02).get("all", 0.5)
        model.bias -= float(np.log(best / (1 - best)))
        model.thresholds = calibrate(model.scores(words, where), y, langs)
    return model


def _batch_scores(model: Model, batch: pa.RecordBatch, column: str) -> np.ndarray:
    parts = [model.scores(*hashed_words(data, offsets))
             for _, data, offsets in X.slices(batch, column, SCORE_BYTES)]
    return np.concatenate(parts) if parts else np.zeros(0)


def score(docs: DataFrame, model: Model, doc_id: str = "doc_id", text: str = "text",
          lang: str = "lang") -> DataFrame:
    """One row per input row: doc_id, lang, score, rejected (by its language's threshold)."""
    rows = docs.select(F.col(doc_id).alias("doc_id"), F.col(text).alias("text"),
                       F.col(lang).cast("string").alias("lang"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            scores = _batch_scores(model, batch, "text")
            least = np.array([model.threshold(v) for v in batch.column("lang").to_pylist()])
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), batch.column("lang"), pa.array(scores),
                 pa.array(model.trained & (scores >= least), pa.bool_())],
                ["doc_id", "lang", "score", "rejected"])

    kind = rows.schema["doc_id"].dataType.simpleString()
    return rows.mapInArrow(X.frugal(run), f"doc_id {kind}, lang string, score double, rejected boolean")


def drop_toxic(docs: DataFrame, model: Model, text: str = "text", lang: str = "lang") -> DataFrame:
    """The rows of ``docs`` that are not rejected; columns unchanged."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            scores = _batch_scores(model, batch, text)
            least = np.array([model.threshold(v) for v in batch.column(lang).to_pylist()])
            yield batch.filter(pa.array(~(model.trained & (scores >= least)), pa.bool_()))

    return docs.mapInArrow(X.frugal(run), docs.schema)

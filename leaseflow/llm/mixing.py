"""Mixing sources to target weights by Efraimidis-Spirakis sampling.

Every source gets a word target. Complete epochs (target // size of the source) take every
document; the rest is a weighted sample without replacement: each document draws an
exponential key -ln(u) / weight, u from a hash of its id and text, and the documents with the
smallest keys are taken until the budget is used up.

No source is sorted in one task: keys fall into fixed key ranges, range sums (a few hundred
numbers a source) give each range its running start, and documents are sorted within
(source, range) only. Texts never move; sizes and keys do.

Rules: size is the number of runs of characters other than ASCII white space, 0 for null and
empty texts; a null source is a source of its own and comes last; documents without a known
quality weigh 1; keys tie only for equal id and text, and such rows are interchangeable; an
empty table gives no rows; other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window, functions as F

from leaseflow.sources.scratch import materialize

WEIGHTS, SHARE, MOST_EPOCHS = (5.0, 2.0, 1.0), 1.5, 2.0
KEY_RANGES, SEED = 512, 20240607
#: Sampling weight of a document by its quality label.
QUALITY = {0: 0.5, 1: 2.0}
WORD = r"[^\x20\x09-\x0D]+"


def quality_weights(labels: DataFrame, doc_id: str = "doc_id", quality: str = "quality",
                    weights: dict[int, float] = QUALITY) -> DataFrame:
    """(doc_id, weight) from quality labels; the best label of an id counts."""
    best = labels.groupBy(F.col(doc_id).alias("doc_id")).agg(F.max(quality).alias("q"))
    weight = F.lit(1.0)
    for label, value in weights.items():
        weight = F.when(F.col("q") == label, F.lit(float(value))).otherwise(weight)
    return best.filter("doc_id IS NOT NULL").select("doc_id", weight.alias("weight"))


def _keyed(docs: DataFrame, weights: DataFrame | None, doc_id: str, text: str, source: str,
           seed: int) -> DataFrame:
    rows = docs.select(
        F.col(doc_id).alias("doc_id"), F.xxhash64(text).alias("row_key"),
        F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("bigint").alias("size"),
        F.col(source).isNull().alias("no_source"),
        F.coalesce(F.col(source).cast("string"), F.lit("")).alias("source"))
    if weights is None:
        rows = rows.withColumn("weight", F.lit(1.0))
    else:
        known = weights.select(F.col("doc_id").alias("_id"), "weight")
        rows = rows.join(known, F.col("doc_id") == F.col("_id"), "left").drop("_id").withColumn(
            "weight", F.coalesce("weight", F.lit(1.0)))
    bits = F.shiftrightunsigned(F.xxhash64("doc_id", "row_key", F.lit(seed)), 11)
    u = (bits + F.lit(0.5)) / F.lit(float(1 << 53))
    rows = rows.withColumn("key", -F.log(u) / F.col("weight"))
    # 1 - exp(-key) is even over 0..1 for weight 1; any increasing map of the key would do.
    part = F.least(F.floor((1 - F.exp(-F.col("key"))) * KEY_RANGES), F.lit(KEY_RANGES - 1))
    return rows.withColumn("range", part.cast("int"))


def _ranked(sources: DataFrame) -> DataFrame:
    """Sources with their rank by code point, null last, without one global sort task."""
    dealt = materialize(sources.repartitionByRange(F.col("no_source"), F.col("source"))
                        .withColumn("part", F.spark_partition_id()), "sources")
    counts = dealt.groupBy("part").agg(F.count("*").alias("n"))
    before = counts.select("part", (F.sum("n").over(Window.orderBy("part")) - F.col("n")).alias("before"))
    place = F.row_number().over(Window.partitionBy("part").orderBy("no_source", "source"))
    return dealt.join(before, "part").select(
        "no_source", "source", "source_size", (F.col("before") + place - 1).alias("rank"))


def source_targets(rows: DataFrame, weights: Sequence[float] = WEIGHTS, share: float = SHARE,
                   most: float = MOST_EPOCHS) -> DataFrame:
    """(no_source, source, source_size, target); rows have source, no_source and size.

    Targets split ``share`` times all sizes by weight. A target above ``most`` times its
    source stops there and the excess is shared again by weight, until none is above.
    """
    sizes = rows.groupBy("no_source", "source").agg(F.sum("size").alias("source_size"))
    weight = F.lit(float(weights[0]))
    for k, value in enumerate(weights[1:], 1):
        weight = F.when(F.col("rank") % len(weights) == k, F.lit(float(value))).otherwise(weight)
    shares = materialize(_ranked(sizes).withColumn("w", weight).withColumn(
        "cap", F.col("source_size") * F.lit(float(most))), "shares")
    # A source is full once its weight's part exceeds its cap, that is cap / w < level.
    total, level, full = 0.0, 0.0, -1
    while True:
        at_cap = F.col("cap") < F.col("w") * F.lit(level)
        size, caps, open_w, count = shares.agg(
            F.sum("source_size"), F.sum(F.when(at_cap, F.col("cap"))),
            F.sum(F.when(~at_cap, F.col("w"))), F.count(F.when(at_cap, 1))).first()
        total = share * (size or 0)
        if count == full or not open_w:
            break
        full, level = count, (total - (caps or 0.0)) / open_w
    return shares.select("no_source", "source", "source_size",
                         F.least("cap", F.col("w") * F.lit(level)).alias("target"))


def mix(docs: DataFrame, quality: DataFrame | None = None, doc_id: str = "doc_id",
        text: str = "text", source: str = "source", weights: Sequence[float] = WEIGHTS,
        share: float = SHARE, most: float = MOST_EPOCHS, seed: int = SEED,
        whole: bool = False) -> DataFrame:
    """One row per input row: doc_id, size, source_size, target, taken, source, row_key.

    The document at the edge of a budget is taken in part (its first words); with ``whole``
    it is taken if that brings the source nearer to its target. ``quality`` has (doc_id,
    weight), one row an id.
    """
    rows = materialize(_keyed(docs, quality, doc_id, text, source, seed), "keyed")
    targets = source_targets(rows, weights, share, most)
    group = ["no_source", "source"]
    starts = rows.groupBy(*group, "range").agg(F.sum("size").alias("n")).withColumn(
        "start", F.sum("n").over(Window.partitionBy(*group).orderBy("range")) - F.col("n")).drop("n")
    inner = Window.partitionBy(*group, "range").orderBy("key", "doc_id", "row_key").rowsBetween(
        Window.unboundedPreceding, Window.currentRow)
    placed = rows.withColumn("upto", F.sum("size").over(inner))
    placed = placed.join(starts, [*group, "range"]).join(targets, group)
    before = F.col("start") + F.col("upto") - F.col("size")
    epochs = F.when(F.col("source_size") > 0,
                    F.floor(F.round("target") / F.col("source_size"))).otherwise(0).cast("bigint")
    rest = F.round("target").cast("bigint") - epochs * F.col("source_size") - before
    if whole:
        part = F.when(F.col("size") <= 2 * rest, F.col("size")).otherwise(0)
    else:
        part = F.greatest(F.lit(0), F.least(F.col("size"), rest))
    return placed.select(
        "doc_id", "size", "source_size", "target",
        (epochs * F.col("size") + part).cast("bigint").alias("taken"),
        F.when(~F.col("no_source"), F.col("source")).alias("source"), "row_key",
        (epochs + (part > 0).cast("bigint")).alias("copies"))


def take_mix(docs: DataFrame, quality: DataFrame | None = None, doc_id: str = "doc_id",
             text: str = "text", **options) -> DataFrame:
    """The rows of ``docs`` as often as the mix takes them, whole; columns unchanged.

    Documents without words take no budget; they come as often as the complete epochs. Rows
    that share id, text and source divide what the mix takes of them as evenly as it goes.
    """
    source = options.get("source", "source")
    chosen = materialize(mix(docs, quality, doc_id, text, whole=True, **options).groupBy(
        F.col("doc_id").alias("_mix_id"), F.col("row_key").alias("_mix_key"),
        F.col("source").alias("_mix_source")).agg(
        F.sum("copies").alias("_sum"), F.count("*").alias("_rows")).select(
        "_mix_id", "_mix_key", "_mix_source", F.floor(F.col("_sum") / F.col("_rows")).alias("_each"),
        (F.col("_sum") % F.col("_rows")).alias("_more")), "chosen")
    keyed = docs.withColumn("_row_key", F.xxhash64(text))

    def found(rows: DataFrame, taken: DataFrame) -> DataFrame:
        return rows.join(taken, F.col(doc_id).eqNullSafe(F.col("_mix_id"))
                         & (F.col("_row_key") == F.col("_mix_key"))
                         & F.col(source).cast("string").eqNullSafe(F.col("_mix_source")))

    def copies(rows: DataFrame, times) -> DataFrame:
        times = times.cast("int")
        return rows.withColumn("_times", F.explode(
            F.when(times > 0, F.sequence(F.lit(1), times)))).select(
            *[F.col(f"`{c}`") for c in docs.columns])

    uneven = chosen.filter("_more > 0")
    if uneven.isEmpty():
        return copies(found(keyed, chosen), F.col("_each"))
    # The first rows get one copy more; they are numbered by part, so no group is in one task.
    dealt = materialize(found(keyed.withColumn("_at", F.monotonically_increasing_id()), uneven)
                        .withColumn("_part", F.shiftright("_at", 33)), "uneven")
    same = ["_mix_id", "_mix_key", "_mix_source"]
    parts = dealt.groupBy(*same, "_part").agg(F.count("*").alias("_n"))
    before = parts.select(
        *[F.col(c).alias(f"{c}_of") for c in same], F.col("_part").alias("_part_of"),
        (F.sum("_n").over(Window.partitionBy(*same).orderBy("_part")) - F.col("_n")).alias("_before"))
    numbered = dealt.withColumn("_place", F.row_number().over(
        Window.partitionBy(*same, "_part").orderBy("_at"))).join(
        before, F.col("_mix_id").eqNullSafe(F.col("_mix_id_of"))
        & (F.col("_mix_key") == F.col("_mix_key_of"))
        & F.col("_mix_source").eqNullSafe(F.col("_mix_source_of"))
        & (F.col("_part") == F.col("_part_of")))
    extra = (F.col("_before") + F.col("_place") <= F.col("_more")).cast("int")
    return copies(found(keyed, chosen.filter("_more = 0")), F.col("_each")).unionByName(
        copies(numbered, F.col("_each") + extra))

"""Facts from stored running state: against one replay of the whole log, row by row."""

from __future__ import annotations

import random

import pytest
from pyspark.sql import functions as F

from leaseflow import schemas as S
from leaseflow.operators import replay as R
from leaseflow.operators import resume as RS
from leaseflow.plans.warehouse import Warehouse
from leaseflow.sources import changes as C
from tests import traces as TR
from tests.test_lifecycle import random_trace


def cut(rows, first, last):
    """Changes whose place in their trace is from ``first`` up to before ``last``."""
    return {t: [r for r in records if first <= r["seq"] < last] for t, records in rows.items()}


def logs(spark, rows):
    return {t: frame.select(F.col("seq").alias("arrival"), C.to_envelope(frame, t).alias("value"))
            for t, frame in TR.frames(spark, rows).items()}


def stored(house):
    return {f: TR.canonical(house.fact(f).collect()) for f in S.FACTS}


def wanted(rows, **how):
    return {f: TR.canonical(made) for f, made in TR.run_rules(rows, **how).items()}


def invented(keys, seed=5):
    rng = random.Random(seed)
    log = {key: random_trace(rng) for key in range(1, keys)}
    log[500] = " ".join(random_trace(rng) for _ in range(12))  # hot, in segments
    return TR.parse(log)


@pytest.mark.parametrize("limit,strict", [(None, True), (20, False)])
def test_any_cut_gives_the_same_facts(spark, limit, strict):
    """Both stages as DataFrames, state handed on between two parts of the log."""
    rows, states, found = invented(60), {"one": None, "two": None}, {f: [] for f in S.FACTS}
    end = 1 + max(r["seq"] for records in rows.values() for r in records)
    for part in (cut(rows, 0, 5), cut(rows, 5, end)):
        changes = TR.frames(spark, part)
        one = RS.go_on(R.facility_log(changes), RS.facility_stage(), states["one"], limit=limit).cache()
        facts = RS.facts_of(one).cache()
        made = R.of_type(facts, "dwd_lease_contract_produce", keep_order=True)
        stage = RS.credit_stage(strict)
        two = RS.go_on(R.credit_log(made, changes["contract"]), stage, states["two"], limit=limit).cache()
        for tagged, names in ((facts, R.STAGE_ONE_FACTS), (RS.facts_of(two), R.STAGE_TWO_FACTS)):
            for f in names:
                found[f] += [tuple(r) for r in R.of_type(tagged, f).collect()]
        for name, ended, of in (("one", one, RS.facility_stage()), ("two", two, stage)):
            new = RS.new_states(ended, of)
            if states[name] is not None:  # keys without changes keep their state
                new = new.unionByName(states[name].join(new, of.key, "left_anti"))
            states[name] = spark.createDataFrame(new.collect(), new.schema)
            assert states[name].groupBy(of.key).count().filter("count > 1").count() == 0
    assert {f: TR.canonical(v) for f, v in found.items()} == wanted(rows, strict_parity=strict)


def read_bytes(spark, after):
    """Bytes that the stages after one have read, and the last stage."""
    gateway, store = spark.sparkContext._gateway, spark._jsc.sc().statusStore()
    jvm = spark._jvm
    stages = store.stageList(jvm.java.util.ArrayList(), False, False,
                             gateway.new_array(jvm.double, 0), jvm.java.util.ArrayList())
    seen = [(stages.apply(i).stageId(), stages.apply(i).inputBytes()) for i in range(stages.size())]
    return sum(b for stage, b in seen if stage > after), max((s for s, _ in seen), default=-1)


def test_batches_retries_and_folds(spark, tmp_path):
    rows = invented(60)
    house = Warehouse(spark, str(tmp_path / "w"), "w", fold_after=2)
    cuts = [0, 3, 6, 1000]
    parts = [cut(rows, a, b) for a, b in zip(cuts, cuts[1:])]
    for number, part in enumerate(parts):
        house.load_facts(logs(spark, part), number)
        if number == 1:  # with wrong changes, then as they should be
            house.load_facts(logs(spark, parts[2]), 1)
            house.load_facts(logs(spark, part), 1)
    assert stored(house) == wanted(rows)
    # Batches that a fold took in are settled.
    assert house.settled(0) and not house.settled(2)
    house.load_facts(logs(spark, parts[2]), 0)
    assert stored(house) == wanted(rows)
    with pytest.raises(ValueError, match="another writer"):
        Warehouse(spark, house.root, "other").load_facts(logs(spark, parts[0]), 3)


def test_state_behind_the_changes_catches_up(spark, tmp_path):
    """A batch that stored its changes and facts but not its states."""
    rows = invented(40)
    house = Warehouse(spark, str(tmp_path / "w"), "w")
    for number, part in enumerate((cut(rows, 0, 4), cut(rows, 4, 7))):
        house.load_facts(logs(spark, part), number)
    for name in ("facility", "credit"):
        table = house.state_table(name)
        table._commit(lambda now: type(now)(now.version, now.entries[:1], now.covered, now.days))
    house.load_facts(logs(spark, cut(rows, 7, 1000)), 2)
    assert stored(house) == wanted(rows)


def test_reads_do_not_grow_with_history(spark, tmp_path):
    """The same facilities again and again: a late batch reads what an early one did."""
    house, read, last = Warehouse(spark, str(tmp_path / "w"), "w", fold_after=2), [], -1
    for number in range(6):
        trace = {key: " ".join(["F0"] * (4 * number) + ["F A7 R S16"]) for key in range(1, 300)}
        part = cut(TR.parse(trace), 4 * number + 1, 1000)
        source = {t: log.cache() for t, log in logs(spark, part).items()}
        _, last = read_bytes(spark, last)
        house.load_changes(source, number)
        house.load_facility_facts(number)
        size, last = read_bytes(spark, last)
        read.append(size)
    assert read[3] > 0
    # Between folds one more batch of states lies beside the folded ones.
    assert max(read[4:]) <= 1.15 * max(read[2:4]), read


def test_empty_batches(spark, tmp_path):
    house = Warehouse(spark, str(tmp_path / "w"), "w")
    nothing, rows = TR.parse({}), TR.parse({1: "F A7 R S16 C1opr K1s"})
    for number, part in enumerate((nothing, rows, nothing)):
        house.load_facts(logs(spark, part), number)
    assert stored(house) == wanted(rows)

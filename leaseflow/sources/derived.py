"""Raw leasing tables derived from the generic test tables (see FIXTURES.md).

Every order becomes a facility application; the modulo conditions only decide
which business path an order takes (assigned auditor, reply, credit, contract),
so that all branches of the lifecycle occur. No row of the source tables is left
out. Integer and exact decimal arithmetic only, so another SQL engine derives the
same rows.
"""

from __future__ import annotations

from collections.abc import Callable, Iterable, Iterator, Mapping
from functools import cache

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from leaseflow import schemas as S
from leaseflow.sources import changes as C

DIM_EPOCH = "timestamp_ntz'2020-01-01 00:00:00'"

class Tables(Mapping[str, DataFrame]):
    """Named DataFrames, each built when it is first asked for."""

    def __init__(self, names: Iterable[str], build: Callable[[str], DataFrame]):
        self._names, self._build = list(names), build
        self._built: dict[str, DataFrame] = {}

    def __getitem__(self, name: str) -> DataFrame:
        if name not in self._names:
            raise KeyError(name)
        if name not in self._built:
            self._built[name] = self._build(name)
        return self._built[name]

    def __iter__(self) -> Iterator[str]:
        return iter(self._names)

    def __len__(self) -> int:
        return len(self._names)


# Gives a source table by name.
Source = Callable[[str], DataFrame]


def source(spark: SparkSession, sf_dir: str) -> Source:
    """Source tables of one folder, each opened once."""
    return cache(lambda name: spark.read.parquet(f"{sf_dir}/{name}.parquet"))


def _plus_seconds(ts: Column, seconds: Column | int) -> Column:
    seconds = F.lit(seconds) if isinstance(seconds, int) else seconds
    return F.timestamp_add("SECOND", seconds, ts)


def _money(c: Column) -> Column:
    return c.cast("decimal(19,2)")


def _k() -> Column:
    return F.col("o_orderkey")


def _month_plus(seconds: Column | int) -> Column:
    month = F.trunc(F.to_date("o_orderdate"), "MM").cast("timestamp_ntz")
    return _plus_seconds(month, seconds)


def _minute_noise() -> Column:
    return _k() % 600


# --- dimensions -------------------------------------------------------------

def _dim_times(df: DataFrame) -> DataFrame:
    at = _plus_seconds(F.expr(DIM_EPOCH), F.col("id"))
    return df.withColumn("create_time", at).withColumn("update_time", at)


def business_partner(table: Source) -> DataFrame:
    rows = table("customer").select(
        F.col("c_custkey").alias("id"), F.col("c_name").alias("name"))
    return _dim_times(rows)


def _hierarchy(table: Source, prefix: str, absent_nation: int) -> DataFrame:
    region, nation = table("region"), table("nation")
    rk, nk = F.col("r_regionkey").cast("bigint"), F.col("n_nationkey").cast("bigint")
    nrk = F.col("n_regionkey").cast("bigint")

    def level(df: DataFrame, ident: Column, number: int, name: Column, parent: Column) -> DataFrame:
        return df.select(ident.alias("id"), F.lit(number).alias(f"{prefix}_level"),
                         name.alias(f"{prefix}_name"),
                         parent.cast("bigint").alias(f"superior_{prefix}_id"))

    top = level(region, rk + 1, 1, F.col("r_name"), F.lit(None))
    middle = level(nation.filter(F.col("n_nationkey") != absent_nation),
                   nk + 100, 2, F.col("n_name"), nrk + 1)
    # Five branches under every nation, named after the five regions.
    branches = nation.withColumn("r_regionkey", F.explode(F.sequence(F.lit(0), F.lit(4))))
    leaf = level(branches.join(region, "r_regionkey"), nk * 5 + rk + 1000, 3,
                 F.concat_ws("/", "n_name", "r_name"), nk + 100)
    return _dim_times(top.unionByName(middle).unionByName(leaf))


def department(table: Source) -> DataFrame:
    return _hierarchy(table, "department", absent_nation=7)


def industry(table: Source) -> DataFrame:
    return _hierarchy(table, "industry", absent_nation=9)


def employee(table: Source) -> DataFrame:
    key = F.col("s_suppkey")
    rows = table("supplier").select(
        key.alias("id"), F.col("s_name").alias("name"), (key % 4).alias("type"),
        F.when(key % 17 != 5, 1000 + F.col("s_nationkey").cast("bigint") * 5 + key % 6)
        .alias("department_id"))
    return _dim_times(rows)


# --- business tables ----------------------------------------------------------

def credit_facility(table: Source) -> DataFrame:
    k = _k()
    return table("orders").select(
        k.alias("id"),
        F.when(k % 50 != 0, F.col("o_orderpriority")).alias("lease_organization"),
        F.col("o_custkey").alias("business_partner_id"),
        (1000 + (F.col("o_custkey") % 27) * 5 + k % 5).alias("industry_id"),
        (k % 110).alias("salesman_id"),
        _money(F.col("o_totalprice")).alias("credit_amount"))


def credit_facility_status(table: Source) -> DataFrame:
    k, orders = _k(), table("orders")
    final = (F.when(F.col("o_orderstatus") == "F", 16)
             .when(F.col("o_orderstatus") == "O", 20)
             .when(F.col("o_orderstatus") == "P", 21))
    assigned = F.struct(
        (k * 10 + 4).alias("id"), k.alias("credit_facility_id"), F.lit(5).alias("status"),
        F.when(k % 23 != 0, k % 90).alias("employee_id"),
        _month_plus(_minute_noise()).alias("create_time"))
    decided = F.struct(
        (k * 10 + 5).alias("id"), k.alias("credit_facility_id"), final.alias("status"),
        F.lit(None).cast("bigint").alias("employee_id"),
        _month_plus(3600 + _minute_noise()).alias("create_time"))
    assigned_rows = orders.filter(k % 11 != 0).select(assigned.alias("s")).select("s.*")
    return assigned_rows.unionByName(orders.select(decided.alias("s")).select("s.*"))


def _reply_amount() -> Column:
    amount = _money(F.col("o_totalprice")) - (_k() % 1000).cast("decimal(19,2)")
    return amount.cast("decimal(19,2)")


def reply(table: Source) -> DataFrame:
    k = _k()
    return (
        table("orders")
        .filter((F.col("o_orderstatus") == "F") & (k % 13 != 0))
        .select((k * 10 + 1).alias("id"), k.alias("credit_facility_id"),
                _reply_amount().alias("credit_amount"),
                (k % 20).cast("decimal(19,2)").alias("irr"),
                (12 + k % 48).cast("int").alias("period"),
                _month_plus(3000).alias("create_time"))
    )


def _credit_orders(table: Source) -> DataFrame:
    return table("orders").filter(
        (F.col("o_orderstatus") == "F") & (_k() % 3 != 2))


def _produced() -> Column:
    return (_k() % 4 != 3) & (_k() % 5 != 4)


def credit(table: Source) -> DataFrame:
    k = _k()
    return _credit_orders(table).select(
        (k * 10 + 2).alias("id"), k.alias("credit_facility_id"),
        F.when(_produced(), k * 10 + 3).alias("contract_id"),
        _reply_amount().alias("credit_amount"),
        _month_plus(7200 + _minute_noise()).alias("create_time"),
        F.when(k % 4 != 3, _month_plus(10800 + _minute_noise())).alias("credit_occupy_time"),
        F.when(_produced(), _month_plus(14400 + _minute_noise())).alias("contract_produce_time"))


def contract(table: Source) -> DataFrame:
    k = _k()
    signed = k % 8 != 6
    return _credit_orders(table).filter(_produced()).select(
        (k * 10 + 3).alias("id"), (k * 10 + 2).alias("credit_id"),
        F.when(signed, _month_plus(18000 + _minute_noise())).alias("signed_time"),
        F.when(signed & (k % 7 != 6), _month_plus(21600 + _minute_noise()))
        .alias("execution_time"))


_BUILDERS = {f.__name__: f for f in (
    business_partner, department, employee, industry,
    credit_facility, credit_facility_status, reply, credit, contract)}


def _raw(table: Source, name: str) -> DataFrame:
    return _BUILDERS[name](table).select(*[c for c, _ in S.RAW[name]])


def raw_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """One decoded raw table in its stored column order."""
    return _raw(source(spark, sf_dir), name)


def raw_tables(spark: SparkSession, sf_dir: str) -> Tables:
    table = source(spark, sf_dir)
    return Tables(S.RAW, lambda name: _raw(table, name))


# --- change histories ---------------------------------------------------------

def dimension_history(spark: SparkSession, sf_dir: str, table: str) -> DataFrame:
    """Ordered changes of one dimension: first image, renamed image, deletion.

    Every id has its snapshot row; ids divisible by ten are renamed later, ids
    ending in three are deleted later (a deletion carries no image).
    """
    name = {"department": "department_name", "industry": "industry_name"}.get(table, "name")
    base = raw_table(spark, sf_dir, table)
    snapshot = base.withColumn("op", F.lit("r")).withColumn("seq", F.lit(0).cast("bigint"))
    renamed = (
        base.filter(F.col("id") % 10 == 0)
        .withColumn(name, F.concat(name, F.lit(" v2")))
        .withColumn("update_time", _plus_seconds(F.col("update_time"), 86400))
        .withColumn("op", F.lit("u")).withColumn("seq", F.lit(1).cast("bigint"))
    )
    deleted = (base.filter(F.col("id") % 10 == 3)
               .withColumn("op", F.lit("d")).withColumn("seq", F.lit(2).cast("bigint")))
    return snapshot.unionByName(renamed).unionByName(deleted)


def dimension_log(spark: SparkSession, sf_dir: str, table: str) -> DataFrame:
    """The history of one dimension as an envelope log (arrival, value)."""
    rows = dimension_history(spark, sf_dir, table)
    return rows.select(F.col("seq").alias("arrival"), C.to_envelope(rows, table).alias("value"))


def _changes(source_table: Source, table: str) -> DataFrame:
    """Shuffled change rows of one business table with op and arrival order ``seq``.

    Version 0 is the derived row. A later version with other values follows for
    three residues of the id modulo seven; some amounts are NULL. ``seq`` is
    unique within one facility and one credit.
    """
    base = _raw(source_table, table)
    later = base.filter((F.col("id") % 7).isin(1, 3, 5))
    ident = F.col("id")
    if table == "credit_facility_status":
        later = later.withColumn("create_time", _plus_seconds(F.col("create_time"), 60))
    elif table != "contract":
        later = later.withColumn("credit_amount",
                                 (F.col("credit_amount") + F.lit(1)).cast("decimal(19,2)"))
    rows = (
        base.withColumn("op", F.lit("r")).withColumn("version", F.lit(0))
        .unionByName(later.withColumn("op", F.lit("u")).withColumn("version", F.lit(1)))
    )
    number, version = C.TABLE_NUMBER[table], F.col("version")
    if table == "credit_facility":
        rows = rows.withColumn("credit_amount", F.when((ident + version) % 17 != 3,
                                                       F.col("credit_amount")))
    elif table == "reply":
        rows = rows.withColumn("credit_amount", F.when((ident + version) % 19 != 4,
                                                       F.col("credit_amount")))
    arrival = (ident * 7919 + number * 104729 + version * 50021) % 1000003
    return rows.withColumn("seq", (arrival * 5 + number) * 2 + version).drop("version")


def replay_changes(spark: SparkSession, sf_dir: str, table: str) -> DataFrame:
    """Change rows of one business table (``op``, ``seq``)."""
    return _changes(source(spark, sf_dir), table)


def replay_tables(spark: SparkSession, sf_dir: str) -> Tables:
    opened = source(spark, sf_dir)
    return Tables(C.TABLE_NUMBER, lambda table: _changes(opened, table))


def change_log(spark: SparkSession, sf_dir: str, table: str) -> DataFrame:
    """Snapshot envelope log of one raw table (arrival = id)."""
    rows = raw_table(spark, sf_dir, table).withColumn("op", F.lit("r"))
    return rows.select(F.col("id").alias("arrival"), C.to_envelope(rows, table).alias("value"))

"""Column lists of every layer.

Raw columns carry a *kind* that fixes both their form inside a change envelope
and their decoded Spark type; everything else (envelope schema, decoding
projection, table schema) is derived from these lists.
"""

from __future__ import annotations

from pyspark.sql import types as T

MONEY = T.DecimalType(19, 2)
WALL = T.TimestampNTZType()

# kind -> (type inside the envelope, decoded type)
KINDS: dict[str, tuple[T.DataType, T.DataType]] = {
    "id": (T.LongType(), T.LongType()),
    "long": (T.LongType(), T.LongType()),
    "long0": (T.LongType(), T.LongType()),      # missing -> 0
    "int": (T.IntegerType(), T.IntegerType()),
    "int0": (T.IntegerType(), T.IntegerType()),  # missing -> 0
    "text": (T.StringType(), T.StringType()),
    "wall": (T.LongType(), WALL),               # epoch microseconds
    "money": (T.StringType(), MONEY),           # base64 of the unscaled integer
}

# The columns read from each raw table.
RAW: dict[str, list[tuple[str, str]]] = {
    "business_partner": [
        ("id", "id"), ("create_time", "wall"), ("update_time", "wall"), ("name", "text"),
    ],
    "department": [
        ("id", "id"), ("create_time", "wall"), ("update_time", "wall"),
        ("department_level", "int"), ("department_name", "text"),
        ("superior_department_id", "long"),
    ],
    "employee": [
        ("id", "id"), ("create_time", "wall"), ("update_time", "wall"),
        ("name", "text"), ("type", "long"), ("department_id", "long"),
    ],
    "industry": [
        ("id", "id"), ("create_time", "wall"), ("update_time", "wall"),
        ("industry_level", "int"), ("industry_name", "text"),
        ("superior_industry_id", "long"),
    ],
    "credit_facility": [
        ("id", "id"), ("lease_organization", "text"), ("business_partner_id", "long0"),
        ("industry_id", "long0"), ("salesman_id", "long0"), ("credit_amount", "money"),
    ],
    "credit_facility_status": [
        ("id", "id"), ("credit_facility_id", "id"), ("status", "int0"),
        ("employee_id", "long"), ("create_time", "wall"),
    ],
    "reply": [
        ("id", "id"), ("credit_facility_id", "id"), ("credit_amount", "money"),
        ("irr", "money"), ("period", "int"), ("create_time", "wall"),
    ],
    "credit": [
        ("id", "id"), ("credit_facility_id", "id"), ("contract_id", "long0"),
        ("credit_amount", "money"), ("create_time", "wall"),
        ("credit_occupy_time", "wall"), ("contract_produce_time", "wall"),
    ],
    "contract": [
        ("id", "id"), ("credit_id", "id"), ("signed_time", "wall"), ("execution_time", "wall"),
    ],
}

DIMENSIONS = ["business_partner", "department", "employee", "industry"]
FACILITY_TABLES = ["credit_facility", "credit_facility_status", "reply", "credit"]

_AUDIT_COLUMNS = [
    ("lease_organization", T.StringType()), ("business_partner_id", T.LongType()),
    ("industry_id", T.LongType()), ("salesman_id", T.LongType()),
    ("audit_man_id", T.LongType()), ("apply_amount", MONEY),
]
_AMOUNTS = [("apply_amount", MONEY), ("reply_amount", MONEY), ("credit_amount", MONEY)]
_FACILITY = [("credit_facility_id", T.LongType())]
_CREDIT = [("credit_id", T.LongType())]

# Fact name -> (event-time column, columns). Order is the stored column order.
_FACT_COLUMNS: dict[str, tuple[str, list[tuple[str, T.DataType]]]] = {
    "dwd_audit_approve": ("approve_time", [
        ("lease_organization", T.StringType()), ("business_partner_id", T.LongType()),
        ("industry_id", T.LongType()), ("reply_id", T.LongType()),
        ("salesman_id", T.LongType()), ("audit_man_id", T.LongType()),
        ("apply_amount", MONEY), ("reply_amount", MONEY), ("reply_time", WALL),
        ("irr", MONEY), ("period", T.IntegerType()),
    ]),
    "dwd_audit_cancel": ("cancel_time", _AUDIT_COLUMNS),
    "dwd_audit_reject": ("reject_time", _AUDIT_COLUMNS),
    "dwd_credit_add": ("add_time", _FACILITY + _AMOUNTS),
    "dwd_credit_occupy": ("occupy_time", _FACILITY + _AMOUNTS),
    "dwd_lease_contract_produce": ("produced_time", _CREDIT + _FACILITY + _AMOUNTS),
    "dwd_lease_sign": ("signed_time", _CREDIT + _FACILITY + _AMOUNTS),
    "dwd_lease_execution": ("execution_time", _CREDIT + _FACILITY + _AMOUNTS),
}

FACTS: dict[str, T.StructType] = {
    name: T.StructType(
        [T.StructField("id", T.LongType()), T.StructField(time, WALL)]
        + [T.StructField(c, t) for c, t in cols]
    )
    for name, (time, cols) in _FACT_COLUMNS.items()
}
FACT_TIME: dict[str, str] = {name: time for name, (time, _) in _FACT_COLUMNS.items()}


def after_schema(table: str) -> T.StructType:
    """Schema of ``after`` inside an envelope of one raw table."""
    return T.StructType([T.StructField(c, KINDS[k][0]) for c, k in RAW[table]])


def envelope_schema(table: str) -> T.StructType:
    return T.StructType([
        T.StructField("source", T.StructType([T.StructField("table", T.StringType())])),
        T.StructField("op", T.StringType()),
        T.StructField("after", after_schema(table)),
    ])


def raw_schema(table: str) -> T.StructType:
    """Schema of one raw table once decoded."""
    return T.StructType([T.StructField(c, KINDS[k][1]) for c, k in RAW[table]])

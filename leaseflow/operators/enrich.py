"""Dimension look-ups: names and flattened three-level hierarchies.

Levels are positional: slot 3 is the node a fact or employee points to, slot 2 its
parent, slot 1 its grandparent. Two id rules exist when a node is missing:

* *pointer*: the id is what the child points to, even if no such row exists;
* *joined*: the id is that of the row found, so NULL if none is.

A hierarchy is flattened among the dimension rows first, so facts (or groups of
facts) need one left join per dimension. No join is forced to broadcast: Spark
compares the size of the dimension with its threshold and picks the strategy.
"""

from __future__ import annotations

from typing import Literal

from pyspark.sql import DataFrame, functions as F

Rule = Literal["pointer", "joined"]


def hierarchy(dim: DataFrame, prefix: str, rule: Rule) -> DataFrame:
    """(``_node``, 3/2/1 ids and names) for every node of a dimension."""
    parent, name = f"superior_{prefix}_id", f"{prefix}_name"
    own = dim.select(F.col("id").alias("_node"), F.col(name).alias(f"{prefix}3_name"),
                     F.col(parent).alias("_p2"))
    second = dim.select(F.col("id").alias("_id2"), F.col(name).alias(f"{prefix}2_name"),
                        F.col(parent).alias("_p1"))
    first = dim.select(F.col("id").alias("_id1"), F.col(name).alias(f"{prefix}1_name"))
    path = (own.join(second, F.col("_p2") == F.col("_id2"), "left")
            .join(first, F.col("_p1") == F.col("_id1"), "left"))
    ids = {"pointer": ("_p2", "_p1"), "joined": ("_id2", "_id1")}[rule]
    return path.select(
        "_node", F.col("_node").alias(f"{prefix}3_id"), f"{prefix}3_name",
        F.col(ids[0]).alias(f"{prefix}2_id"), f"{prefix}2_name",
        F.col(ids[1]).alias(f"{prefix}1_id"), f"{prefix}1_name")


def with_industry(rows: DataFrame, industry: DataFrame, rule: Rule,
                  key: str = "industry_id") -> DataFrame:
    """Add the industry path. Under the pointer rule slot 3 is the row's own id."""
    path = hierarchy(industry, "industry", rule)
    joined = rows.join(path, F.col(key) == F.col("_node"), "left").drop("_node")
    if rule == "pointer":
        joined = joined.withColumn("industry3_id", F.col(key))
    return joined


def employee_path(employee: DataFrame, department: DataFrame, rule: Rule) -> DataFrame:
    """(``_emp``, name, department path) for every employee."""
    path = hierarchy(department, "department", rule)
    staff = employee.select(F.col("id").alias("_emp"), F.col("name").alias("_emp_name"),
                            F.col("department_id").alias("_dep"))
    joined = staff.join(path, F.col("_dep") == F.col("_node"), "left")
    if rule == "pointer":
        joined = joined.withColumn("department3_id", F.col("_dep"))
    return joined.drop("_node", "_dep")


def with_salesman(rows: DataFrame, employee: DataFrame, department: DataFrame, rule: Rule,
                  key: str = "salesman_id") -> DataFrame:
    """Add salesman name and department path."""
    path = employee_path(employee, department, rule)
    return (rows.join(path, F.col(key) == F.col("_emp"), "left").drop("_emp")
            .withColumnRenamed("_emp_name", "salesman_name"))


def with_employee_name(rows: DataFrame, employee: DataFrame, key: str, name: str) -> DataFrame:
    """Add an employee's name, NULL if the id is unknown or missing."""
    names = employee.select(F.col("id").alias("_emp"), F.col("name").alias(name))
    return rows.join(names, F.col(key) == F.col("_emp"), "left").drop("_emp")

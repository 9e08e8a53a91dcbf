"""The driver's test tables seen as movements.

`movements` gives the typed view, `raw_movements` the same rows as they would
look in a delimited file (all text, decimal commas, some dirt). Joins happen only
for columns that are asked for. No side is hinted to broadcast: Spark compares
its size with `spark.sql.autoBroadcastJoinThreshold`, and adaptive execution
splits a skewed key of a shuffled join.
"""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ebbflow.functions import age_band, leading_digits, salary_band

# Declared, so that opening a table costs no schema-inference job.
SCHEMAS = {
    "lineitem": "l_orderkey bigint, l_partkey bigint, l_suppkey bigint, l_linenumber int, "
    "l_quantity double, l_extendedprice double, l_discount double, l_tax double, "
    "l_returnflag string, l_linestatus string, l_shipdate timestamp_ntz",
    "orders": "o_orderkey bigint, o_custkey bigint, o_orderstatus string, o_totalprice double, "
    "o_orderdate timestamp_ntz, o_orderpriority string",
    "customer": "c_custkey bigint, c_name string, c_nationkey int, c_acctbal double, "
    "c_mktsegment string",
    "supplier": "s_suppkey bigint, s_name string, s_nationkey int, s_acctbal double",
    "part": "p_partkey bigint, p_name string, p_brand string, p_type string, p_size int, "
    "p_retailprice double",
}


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    reader = spark.read.schema(SCHEMAS[name]) if name in SCHEMAS else spark.read
    return reader.parquet(f"{sf_dir}/{name}.parquet")


def _ordinal(timestamp: str) -> Column:
    return F.year(timestamp) * 12 + F.month(timestamp)


def _age() -> Column:
    return F.floor(F.col("l_quantity") * 1.6).cast("int")


def _salary() -> Column:
    return F.col("l_extendedprice") / 10


def _occupation() -> Column:
    return F.col("l_partkey").cast("string")


def _balance() -> Column:
    return F.when(F.col("l_linestatus") == "O", 1).when(F.col("l_linestatus") == "F", -1)


# built on demand: a query pays only for the columns it names
_TYPED = {
    "month_seq": lambda: _ordinal("l_shipdate"),
    "region": lambda: F.col("s_nationkey"),
    "section": lambda: F.col("l_returnflag"),
    "age": _age,
    "salary": _salary,
    "occupation": _occupation,
    "schooling": lambda: F.col("o_orderpriority"),
    "sex": lambda: F.col("l_linenumber") % 2,
    "movement_type": lambda: F.col("p_type"),
    "balance": _balance,
    "age_band": lambda: age_band(_age()),
    "salary_band": lambda: salary_band(_salary()),
    "occupation_group": lambda: leading_digits(_occupation()),
}


def movements(spark: SparkSession, sf_dir: str, columns: Iterable[str]) -> DataFrame:
    """Movement rows with the given columns (see `_TYPED`; bands may be asked for directly)."""
    columns = list(columns)
    rows = table(spark, sf_dir, "lineitem")
    if "region" in columns:
        supplier = table(spark, sf_dir, "supplier")
        rows = rows.join(supplier, rows["l_suppkey"] == supplier["s_suppkey"])
    if "schooling" in columns:
        orders = table(spark, sf_dir, "orders")
        rows = rows.join(orders, rows["l_orderkey"] == orders["o_orderkey"], "left")
    if "movement_type" in columns:
        part = table(spark, sf_dir, "part")
        rows = rows.join(part, rows["l_partkey"] == part["p_partkey"], "left")
    return rows.select(*[_TYPED[c]().alias(c) for c in columns])


def raw_movements(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Text rows with dirt: line 5 groups thousands, line 6 is blank, line 7 is not a number.

    The sign is unusable on the lines returned (`R`) with line number 1; the section
    is missing on accepted (`A`) lines with line number 2.
    """
    supplier = table(spark, sf_dir, "supplier")
    lines = table(spark, sf_dir, "lineitem")
    rows = lines.join(supplier, lines["l_suppkey"] == supplier["s_suppkey"])
    line = F.col("l_linenumber")
    cents = F.round(F.col("l_extendedprice") * 100).cast("bigint")
    whole = F.floor(cents / 100)
    decimals = F.lpad((cents % 100).cast("string"), 2, "0")
    plain = F.concat(whole.cast("string"), F.lit(","), decimals)
    grouped = F.concat(
        F.floor(whole / 1000).cast("string"),
        F.lit("."),
        F.lpad((whole % 1000).cast("string"), 3, "0"),
        F.lit(","),
        decimals,
    )
    salary = (
        F.when(line == 7, "abc").when(line == 6, " ").when(line == 5, grouped).otherwise(plain)
    )
    flag = F.col("l_returnflag")
    sign = F.when((flag == "R") & (line == 1), "x").when(F.col("l_linestatus") == "O", "1")
    month = F.year("l_shipdate") * 100 + F.month("l_shipdate")
    return rows.select(
        month.cast("string").alias("competênciamov"),
        F.col("s_nationkey").cast("string").alias("uf"),
        F.when((flag == "A") & (line == 2), None).otherwise(flag).alias("seção"),
        F.floor(F.col("l_quantity") * 1.6).cast("int").cast("string").alias("idade"),
        (line % 5).cast("string").alias("graudeinstrução"),
        F.col("l_partkey").cast("string").alias("cbo2002ocupação"),
        (line % 2).cast("string").alias("sexo"),
        salary.alias("salário"),
        sign.otherwise("-1").alias("saldomovimentação"),
        line.cast("string").alias("categoria"),
    )


def order_movements(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Orders as movements; status `P` has no usable sign."""
    orders = table(spark, sf_dir, "orders")
    customer = table(spark, sf_dir, "customer")
    sign = F.when(F.col("o_orderstatus") == "O", 1).when(F.col("o_orderstatus") == "F", -1)
    joined = orders.join(customer, orders["o_custkey"] == customer["c_custkey"], "left")
    return joined.select(
        _ordinal("o_orderdate").alias("month_seq"),
        F.col("c_nationkey").alias("region"),
        F.col("c_mktsegment").alias("section"),
        sign.otherwise(0).alias("balance"),
    )

"""The driver's tables as listings, registers and publications.

A register row is a customer, a listing row an order: order ``k`` lists its customer under flag
``k % 18``.  Two half-year windows of orders make two snapshots.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from vigilframe.operators.listing import bit, has_bit
from vigilframe.operators.update import POLICIES, apply_masks
from vigilframe.schema import BOUND, FLAGS

T0 = ("1997-07-01", "1998-01-01")
T1 = ("1997-10-01", "1998-04-01")
N_FLAGS = len(FLAGS)


# Declared, so that a read needs no job that looks at file footers first.
SCHEMAS = {
    "customer": "c_custkey long, c_name string, c_nationkey int, c_acctbal double, c_mktsegment string",
    "orders": "o_orderkey long, o_custkey long, o_orderstatus string, o_totalprice double, "
    "o_orderdate timestamp, o_orderpriority string",
    "supplier": "s_suppkey long, s_name string, s_nationkey int, s_acctbal double",
    "nation": "n_nationkey int, n_name string, n_regionkey int",
    "part": "p_partkey long, p_name string, p_brand string, p_type string, p_size int, p_retailprice double",
    "documents": "doc_id long, text string, lang string, source string, n_chars long",
    "pages": "page_id long, url string, html string",
    "conversations": "conv_id long, turn long, role string, text string",
}


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.schema(SCHEMAS[name]).parquet(f"{sf_dir}/{name}.parquet")


def window_orders(spark: SparkSession, sf_dir: str, window: tuple[str, str]) -> DataFrame:
    orders = table(spark, sf_dir, "orders")
    start, end = (F.lit(d).cast("timestamp") for d in window)
    return orders.where((F.col("o_orderdate") >= start) & (F.col("o_orderdate") < end))


def listing(spark: SparkSession, sf_dir: str, window: tuple[str, str]) -> DataFrame:
    """(o_custkey, flag_no), not yet distinct."""
    flag_no = (F.col("o_orderkey") % N_FLAGS).alias("flag_no")
    return window_orders(spark, sf_dir, window).select("o_custkey", flag_no)


def masks(spark: SparkSession, sf_dir: str, window: tuple[str, str]) -> DataFrame:
    """One row per listed customer, with its membership masks."""
    member = bit(F.col("o_orderkey") % N_FLAGS)
    grouped = window_orders(spark, sf_dir, window).groupBy("o_custkey").agg(F.bit_or(member).alias("yes"))
    return grouped.select("o_custkey", "yes", F.col("yes").alias("seen"))


def register(spark: SparkSession, sf_dir: str, window: tuple[str, str], *, unnamed: bool = False) -> DataFrame:
    """The bound register at a window; ``unnamed`` hides the name of every 89th row."""
    customer = table(spark, sf_dir, "customer")
    joined = customer.join(
        masks(spark, sf_dir, window), F.col("c_custkey") == F.col("o_custkey"), "left"
    )
    name = "if(c_custkey % 97 = 0, 'CUBA', upper(c_name))"
    if unnamed:
        name = f"if(c_custkey % 89 <> 0, {name}, null)"
    flags = [
        f"case when {has_bit('yes', i)} then 'YES' when c_custkey % 23 <> {i} then 'NO' end as {column}"
        for i, column in enumerate(BOUND.flags)
    ]
    return joined.selectExpr(
        "c_custkey as id",
        f"{name} as name_eng",
        "case when c_acctbal >= 0 then cast(floor(c_acctbal / 100) as int) end as cpi_score",
        *flags,
    )


def hits(reg: DataFrame, listed: DataFrame) -> DataFrame:
    """Listing masks per register id, for rows with a name."""
    named = reg.where(F.col("name_eng").isNotNull()).select("id")
    return named.join(listed.withColumnRenamed("o_custkey", "id"), "id")


def after_policies(spark: SparkSession, sf_dir: str, flags: tuple[str, ...]) -> DataFrame:
    """Register T0 with unnamed rows after listing T1: id and the given canonical flags."""
    reg = register(spark, sf_dir, T0, unnamed=True)
    listed = masks(spark, sf_dir, T1)
    policies = {flag: POLICIES[flag] for flag in flags}
    updated = apply_masks(reg, hits(reg, listed), listed, BOUND, policies)
    return updated.select("id", *BOUND.columns(flags))

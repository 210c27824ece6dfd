"""Customer and score tables derived from the order tables; every function is lazy.

``customer_base`` is one row per customer: features from orders before a cut-off 180 days before
the last order, and a label from the time after it.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from tenura.functions.expressions import hash32
from tenura.operators.cleaning import (
    add_missing_flags,
    apply_domain_rules,
    flagged_columns,
    missing_rates,
    sparse_columns,
)
from tenura.operators.features import UsageColumns, usage_features
from tenura.roles import Roles

BASE_ROLES = Roles(
    target="label", id_patterns=("row_id",), categorical=("area", "nation", "segment"), binary=(), row_id="row_id"
)
BASE_NUMERIC = ["acctbal", "avg3", "avg6", "avg12", "returned", "placed", "n_orders", "idle_days"]
USAGE = UsageColumns(
    recent="avg6", baseline="avg12", dropped="returned", placed="placed", device_days="idle_days",
    delta_name="usage_delta",
)
# The data has no device or subscriber columns; these stand in for them in the cleaning rules.
BASE_RULES = dict(
    non_negative=("acctbal",), upper_limits={"n_orders": 13.0, "placed": 50.0}, capped_by={"avg12": "avg6"}
)


def read(spark: SparkSession, folder: str, table: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{table}.parquet")


def customer_base(spark: SparkSession, folder: str) -> DataFrame:
    """Lines are summed per order and orders per customer before any join, so a customer with a
    large share of all orders costs one partial sum per task; nation and region are small enough
    for Spark's own size-checked broadcast."""
    orders = read(spark, folder, "orders").select("o_orderkey", "o_custkey", "o_orderdate", "o_totalprice")
    cut = orders.agg((F.max("o_orderdate") - F.expr("interval '180' day")).alias("c")).scalar()
    lines = (
        read(spark, folder, "lineitem")
        .groupBy("l_orderkey")
        .agg(F.count_if(F.col("l_returnflag") == "R").alias("r"), F.count(F.lit(1)).alias("n"))
    )
    dated = orders.join(lines, F.col("o_orderkey") == F.col("l_orderkey"), "left").withColumn("c", cut)
    before = F.col("o_orderdate") < F.col("c")

    def mean_price(days: int):
        recent = F.col("o_orderdate") >= F.col("c") - F.expr(f"interval '{days}' day")
        return F.avg(F.when(before & recent, F.col("o_totalprice")))

    def total(amount: Column) -> Column:
        return F.sum(F.when(before, F.coalesce(amount, F.lit(0))).otherwise(0))

    per_customer = dated.groupBy("o_custkey").agg(
        mean_price(90).alias("avg3"), mean_price(180).alias("avg6"), mean_price(360).alias("avg12"),
        total(F.col("r")).alias("returned"), total(F.col("n")).alias("placed"),
        F.count_if(before).alias("n_orders"),
        F.max(F.when(before, F.col("o_orderdate"))).alias("last_before"),
        F.count_if(~before).alias("later"),
    )
    nation, region = read(spark, folder, "nation"), read(spark, folder, "region")
    customer = (
        read(spark, folder, "customer")
        .join(nation, F.col("c_nationkey") == F.col("n_nationkey"))
        .join(region, F.col("n_regionkey") == F.col("r_regionkey"))
    )
    whole = lambda c: F.coalesce(F.col(c), F.lit(0)).cast("double").alias(c)
    return customer.join(per_customer, F.col("c_custkey") == F.col("o_custkey"), "left").select(
        F.col("c_custkey").alias("row_id"), F.col("r_name").alias("area"), F.col("n_name").alias("nation"),
        F.col("c_mktsegment").alias("segment"), F.col("c_acctbal").alias("acctbal"),
        "avg3", "avg6", "avg12", whole("returned"), whole("placed"), whole("n_orders"),
        F.datediff(cut, F.col("last_before")).cast("double").alias("idle_days"),
        F.when(F.coalesce(F.col("later"), F.lit(0)) == 0, 1).otherwise(0).alias("label"),
    )


def customer_history(spark: SparkSession, folder: str) -> DataFrame:
    """``row_id, months, revenue_delta`` of customers with orders: months of 30 days since the first order, and the
    change of revenue from the half year before the last one before the cut. Summed map-side per customer."""
    orders = read(spark, folder, "orders").select("o_custkey", "o_orderdate", "o_totalprice")
    cut = orders.agg((F.max("o_orderdate") - F.expr("interval '180' day")).alias("c")).scalar()
    dated = orders.withColumn("age", F.datediff(cut, F.col("o_orderdate"))).where("age > 0")
    recent, earlier = F.col("age") <= 180, (F.col("age") > 180) & (F.col("age") <= 360)
    spent = lambda when: F.sum(F.when(when, F.col("o_totalprice")).otherwise(0))
    return dated.groupBy(F.col("o_custkey").alias("row_id")).agg(
        F.floor(F.max("age") / 30).alias("months"), (spent(recent) - spent(earlier)).alias("revenue_delta")
    )


def prepared(base: DataFrame, roles: Roles = BASE_ROLES) -> tuple[DataFrame, dict]:
    """Domain rules, sparse columns out, missing flags, usage features; plus what was decided.

    The one thing collected is the missing rate per column, which decides the schema.
    """
    ruled = apply_domain_rules(base, **BASE_RULES)
    inputs = [c for c in ruled.columns if c not in (roles.row_id, roles.target)]
    rates = missing_rates(ruled, inputs)
    sparse = sparse_columns(rates)
    flagged = flagged_columns(rates)
    kept = add_missing_flags(ruled.drop(*sparse), flagged)
    featured, skipped = usage_features(kept, USAGE)
    return featured, {"rates": rates, "sparse": sparse, "flagged": flagged, "skipped": skipped}


def customer_features(spark: SparkSession, folder: str) -> DataFrame:
    return prepared(customer_base(spark, folder))[0]


def customer_raw_text(spark: SparkSession, folder: str) -> DataFrame:
    """``customer_base`` as a delimited file would carry it: decimal commas, damaged categories."""
    base = customer_base(spark, folder)
    damaged = F.when(F.col("row_id") % 7 != 0, F.concat(F.lit(" "), F.lower("segment"), F.lit(" ")))
    money = F.when(F.col("row_id") % 11 == 0, F.lit("n/a")).otherwise(
        F.replace(F.col("acctbal").cast("string"), F.lit("."), F.lit(","))
    )
    count = F.replace(F.col("n_orders").cast("string"), F.lit("."), F.lit(","))
    return base.select("row_id", damaged.alias("segment"), money.alias("acctbal"), count.alias("n_orders"), "label")


def scores(spark: SparkSession, folder: str) -> DataFrame:
    """Two models' probabilities per event on integer grids; ties are common."""
    events = read(spark, folder, "events").select(
        F.col("event_id").alias("row_id"), F.when(F.col("event_type") == "purchase", 1).otherwise(0).alias("label")
    )
    y = F.col("label")
    return events.select(
        "row_id", "label",
        ((F.lit(1000) + hash32("lr", F.col("row_id")) % 6001 + y * 2000) / F.lit(10000.0)).alias("prob_lr"),
        ((F.lit(1000) + hash32("gb", F.col("row_id")) % 5001 + y * 3000) / F.lit(10000.0)).alias("prob_gbm"),
    )


def labelled_lines(spark: SparkSession, folder: str) -> DataFrame:
    """Line items as a tall numeric table with a returned / not returned label."""
    return read(spark, folder, "lineitem").select(
        "l_quantity", "l_extendedprice", "l_discount", "l_tax",
        F.when(F.col("l_returnflag") == "R", 1).otherwise(0).alias("label"),
    )


LINE_MEASURES = ["l_quantity", "l_extendedprice", "l_discount", "l_tax"]

"""Leakage-free splits that depend only on ``row_id`` and a seed, never on row order."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from tenura.functions.expressions import hash32
from tenura.operators.ranking import rank_in_class_by_hash, smallest_in_class

SEED = 42
TEST_PERCENT = 20
EXPLAIN_ROWS = 2000


def split_hash(row_id: str | Column, seed: int | str = SEED) -> Column:
    return hash32(str(seed), F.col(row_id) if isinstance(row_id, str) else row_id)


def _ranked(df: DataFrame, row_id: str, label: str, seed: int | str) -> DataFrame:
    hashed = df.withColumn("__u", split_hash(row_id, seed))
    return rank_in_class_by_hash(hashed, "__u", row_id, label).drop("__u")


def stratified_split(
    df: DataFrame,
    *,
    row_id: str = "row_id",
    label: str = "label",
    test_percent: int = TEST_PERCENT,
    seed: int | str = SEED,
) -> DataFrame:
    """Add ``part``: exactly the first ceil(percent) of each class in hash order are ``test``.

    The last test row of each class is found from counts of the hash; then every row is compared with it where it
    stands, so no row moves. Rows without a class are left out.
    """
    narrow = df.select(F.col(label).alias("class"), split_hash(row_id, seed).alias("u"), F.col(row_id).alias("id"))
    quota = lambda rows: F.ceil(rows * test_percent / F.lit(100.0)).cast("bigint")
    last = smallest_in_class(narrow, quota)
    u, mine = split_hash(row_id, seed), F.get(F.filter(F.col("__last"), lambda x: x["class"] == F.col(label)), F.lit(0))
    within = (u < mine["u"]) | ((u == mine["u"]) & (F.col(row_id) <= mine["id"]))
    part = F.when(F.coalesce(within, F.lit(False)), "test").otherwise("train")
    known = df.where(F.col(label).isNotNull())
    return known.withColumn("__last", last.agg(F.collect_list(F.struct("class", "u", "id"))).scalar()).withColumn("part", part).drop("__last")


def stratified_folds(
    df: DataFrame,
    k: int = 5,
    *,
    row_id: str = "row_id",
    label: str = "label",
    seed: int | str = SEED,
    output: str = "fold",
) -> DataFrame:
    """Add a fold number 0..k-1, dealt out in hash order within each class."""
    fold = F.pmod(F.col("rank") - 1, F.lit(k)).cast("int")
    return _ranked(df, row_id, label, seed).withColumn(output, fold).drop("rank", "class_rows")


def explanation_sample(df: DataFrame, rows: int = EXPLAIN_ROWS, row_id: str = "row_id") -> DataFrame:
    """The sampling operator of the explanations: ``rows`` rows without replacement, by hash order."""
    return df.orderBy(split_hash(row_id, "explain"), row_id).limit(rows)

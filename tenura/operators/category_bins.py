"""Ordered bins of categories for tree learners.

Categories are ordered by their smoothed rate of the positive class and cut into at most 255 bins of similar weight, so a
split on the bin number is a split of the ordered categories. The learner sees one number of bounded range however many
categories there are; the categories themselves stay in a table.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

from tenura.operators.profiling import tall_text

#: Bins of a column at most, rows' worth of the overall rate in each category's rate, and steps between rates.
BINS, PRIOR_ROWS, RATE_STEPS = 255, 10, 65_536


def _rate_step(positives: Column, n: Column, overall: Column) -> Column:
    rate = (positives + overall * PRIOR_ROWS) / (n + F.lit(PRIOR_ROWS))
    return F.floor(rate * RATE_STEPS)


def fit_category_bins(train: DataFrame, columns: list[str], label: str, bins: int = BINS) -> DataFrame:
    """``feature, category, n, pos, bin, unseen``: every category with its bin, and the bin for categories not met here.

    Rows with a null label are not counted; NULL is a category. Up to ``bins`` different rates have a bin each; more are
    cut by the rows before them. A category is counted map-side, then categories by their rate; the windows hold at most
    65,537 rates of a column. No row and no category reaches the driver.
    """
    counts = (
        tall_text(train.where(F.col(label).isNotNull()), columns, [F.col(label).cast("bigint").alias("__y")])
        .groupBy("feature", "category")
        .agg(F.count(F.lit(1)).alias("n"), F.sum("__y").alias("pos"))
    )
    whole = counts.groupBy("feature").agg(F.sum("n").alias("__n"), F.sum("pos").alias("__pos"))
    # one row per column of the schema
    known = counts.join(F.broadcast(whole), "feature")
    overall = F.col("__pos") / F.col("__n")
    steps = known.withColumn("__step", _rate_step(F.col("pos"), F.col("n"), overall))
    rates = steps.groupBy("feature", "__step").agg(F.sum("n").alias("__here"))
    by_rate = Window.partitionBy("feature").orderBy("__step")
    every = Window.partitionBy("feature")
    before = F.sum("__here").over(by_rate) - F.col("__here")
    placed = rates.select(
        "feature", "__step", F.row_number().over(by_rate).alias("__place"), before.alias("__before"),
        F.count(F.lit(1)).over(every).alias("__rates"), F.sum("__here").over(every).alias("__all"),
    )
    number = F.when(F.col("__rates") <= bins, F.col("__place") - 1).otherwise(
        F.expr(f"{int(bins)} * __before div __all")
    )
    numbered = placed.select("feature", "__step", number.cast("int").alias("bin"))
    middle = F.floor(overall * RATE_STEPS)
    # the last bin at or below the overall rate; one row per column
    unseen = (
        numbered.join(F.broadcast(whole), "feature")
        .groupBy("feature")
        .agg(F.coalesce(F.max(F.when(F.col("__step") <= middle, F.col("bin"))), F.lit(0)).alias("unseen"))
    )
    return (
        # at most 65,537 rates a column
        steps.join(F.broadcast(numbered), ["feature", "__step"])
        .join(F.broadcast(unseen), "feature")
        .select("feature", "category", "n", "pos", "bin", "unseen")
    )


def unseen_bins(bins: DataFrame) -> dict[str, int]:
    """The bin of categories that were not met, per column."""
    return {r["feature"]: r["unseen"] for r in bins.groupBy("feature").agg(F.max("unseen").alias("unseen")).collect()}


def apply_category_bins(df: DataFrame, bins: DataFrame, unseen: dict[str, int], *, suffix: str = "__bin") -> DataFrame:
    """Add the bin of every column in ``unseen`` as a double.

    Spark picks the join by the size of the written table; beyond a broadcast, AQE splits a hot category.
    """
    for c, default in unseen.items():
        lookup = bins.where(F.col("feature") == c).select(F.col("category").alias("__k"), F.col("bin").alias("__b"))
        df = (
            df.join(lookup, F.col(c).cast("string").eqNullSafe(F.col("__k")), "left")
            .withColumn(c + suffix, F.coalesce(F.col("__b"), F.lit(default)).cast("double"))
            .drop("__k", "__b")
        )
    return df

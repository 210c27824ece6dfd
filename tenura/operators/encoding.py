"""Fitted column transforms: target encoding, median imputation, robust scaling.

Each ``fit_*`` and ``crossfit_*`` result is a table computed by Spark from the training rows only and written once; each
``apply_*`` is a projection or a join with that table. Spark knows the size of a written table and broadcasts it below
its own threshold in bytes; a larger one joins by shuffle, where AQE splits a hot category, NULL included.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, Window, functions as F

from tenura.operators.profiling import tall_text
from tenura.operators.ranking import cells_at_ranks, quantiles_from_cells, value_cells
from tenura.session import shared_table


def _smoothed(n: Column, positives: Column, all_n: Column, all_positives: Column) -> Column:
    """Empirical-Bayes shrinkage of a category mean towards the overall mean (binary target).

    ``n * V / (n * V + s2)`` weighs the category mean, with V the overall and s2 the category
    variance; where that is undefined the overall mean stands.
    """
    overall = all_positives / all_n
    spread = overall * (F.lit(1.0) - overall)
    rate = positives / n
    weight = F.try_divide(spread * n, spread * n + rate * (F.lit(1.0) - rate))
    return F.coalesce(weight * rate + (F.lit(1.0) - weight) * overall, overall)


def fit_target_encoding(train: DataFrame, columns: list[str], label: str) -> DataFrame:
    """``feature, category, n, encoding, overall`` from one aggregation over all columns."""
    counts = (
        tall_text(train, columns, [F.col(label).cast("double").alias("__y")])
        .groupBy("feature", "category")
        .agg(F.count(F.lit(1)).cast("double").alias("n"), F.sum("__y").alias("pos"))
    )
    whole = counts.groupBy("feature").agg(F.sum("n").alias("all_n"), F.sum("pos").alias("all_pos"))
    # One row per column of the schema.
    joined = counts.join(F.broadcast(whole), "feature")
    return shared_table(joined.select(
        "feature", "category", F.col("n").cast("bigint").alias("n"),
        _smoothed(F.col("n"), F.col("pos"), F.col("all_n"), F.col("all_pos")).alias("encoding"),
        (F.col("all_pos") / F.col("all_n")).alias("overall"),
    ))


def apply_target_encoding(
    df: DataFrame, encoding: DataFrame, columns: list[str], *, suffix: str = "_enc"
) -> DataFrame:
    """Look up each column's encoding; an unseen category gets the overall mean."""
    overall = encoding.agg(F.max("overall").alias("overall")).scalar()
    for c in columns:
        lookup = encoding.where(F.col("feature") == c).select(
            F.col("category").alias("__k"), F.col("encoding").alias("__e")
        )
        df = (
            df.join(lookup, F.col(c).cast("string").eqNullSafe(F.col("__k")), "left")
            .withColumn(c + suffix, F.coalesce(F.col("__e"), overall))
            .drop("__k", "__e")
        )
    return df


def crossfit_encoding(train: DataFrame, columns: list[str], label: str, fold: str) -> DataFrame:
    """``feature, category, fold, encoding``: each fold encoded by all the other folds.

    One aggregation by (feature, category, fold); the leave-fold-out statistics are the totals
    minus the fold's own.
    """
    counts = (
        tall_text(train, columns, [F.col(label).cast("double").alias("__y"), F.col(fold).alias("fold")])
        .groupBy("feature", "category", "fold")
        .agg(F.count(F.lit(1)).cast("double").alias("n"), F.sum("__y").alias("pos"))
    )
    # A window keeps the NULL category, and holds one row per fold.
    same = Window.partitionBy("feature", "category")
    with_category = counts.withColumns({"cat_n": F.sum("n").over(same), "cat_pos": F.sum("pos").over(same)})
    by_fold = counts.groupBy("feature", "fold").agg(F.sum("n").alias("fold_n"), F.sum("pos").alias("fold_pos"))
    whole = counts.groupBy("feature").agg(F.sum("n").alias("all_n"), F.sum("pos").alias("all_pos"))
    # (columns x folds) and (columns) rows.
    joined = (
        with_category.join(F.broadcast(by_fold), ["feature", "fold"])
        .join(F.broadcast(whole), "feature")
    )
    rest_n, rest_pos = F.col("cat_n") - F.col("n"), F.col("cat_pos") - F.col("pos")
    others_n, others_pos = F.col("all_n") - F.col("fold_n"), F.col("all_pos") - F.col("fold_pos")
    overall = others_pos / others_n
    smoothed = _smoothed(rest_n, rest_pos, others_n, others_pos)
    return shared_table(joined.select(
        "feature", "category", "fold",
        F.when(rest_n > 0, smoothed).otherwise(overall).alias("encoding"),
    ))


def apply_crossfit_encoding(
    train: DataFrame, encoding: DataFrame, columns: list[str], fold: str, *, suffix: str = "_enc"
) -> DataFrame:
    """Encode training rows by the statistics of the other folds."""
    for c in columns:
        lookup = encoding.where(F.col("feature") == c).select(
            F.col("category").alias("__k"), F.col("fold").alias("__f"), F.col("encoding").alias("__e")
        )
        match = F.col(c).cast("string").eqNullSafe(F.col("__k")) & (F.col(fold) == F.col("__f"))
        train = train.join(lookup, match, "left").withColumnRenamed("__e", c + suffix).drop("__k", "__f")
    return train


def fit_scaling(train: DataFrame, columns: list[str], probabilities=(0.25, 0.5, 0.75)) -> dict[str, dict[float, float]]:
    """Exact quartiles of the training rows as plan-time metadata: a few numbers per column."""
    cells = value_cells(train, columns)
    found = quantiles_from_cells(cells, ["series"], list(probabilities)).collect()
    fitted: dict[str, dict[float, float]] = {c: {} for c in columns}
    for r in found:
        fitted[r["series"]][r["q"]] = r["quantile"]
    return fitted


def fit_after_imputation(train: DataFrame, columns: list[str]) -> tuple[dict[str, float], dict[str, tuple[float, float]]]:
    """Medians for imputation, then centre and spread of the imputed columns.

    The imputed rows all equal the median, so in the sorted column they stand right behind the
    values up to it: the quartiles after imputation come from the same cells, with the later ones
    moved up by the number of missing rows. A quartile's rank is thus one of the known values' as it
    stands, or less the missing rows, or falls on the median; only cells near these ranks are ordered.
    """
    rows = train.count()
    places = [math.floor(q * (rows - 1)) + i for q in (0.25, 0.5, 0.75) for i in (0, 1)]

    def wanted(known: Column) -> Column:
        middle = F.floor(F.lit(0.5) * (known - 1))
        after = [F.lit(r) - moved for r in places for moved in (F.lit(0), F.lit(rows) - known)]
        return F.array(*[r.cast("bigint") for r in (middle, middle + 1, *after)])

    cells = cells_at_ranks(train, columns, wanted).persist()
    medians = dict.fromkeys(columns, 0.0) | {
        r["series"]: r["quantile"] for r in quantiles_from_cells(cells, ["series"], [0.5]).collect()
    }
    pairs = [F.lit(x) for c, m in medians.items() for x in (c, float(m))]
    median = F.try_element_at(F.create_map(*pairs), F.col("series"))
    moved = F.when(F.col("value") > median, F.lit(rows) - F.col("n_total")).otherwise(0)
    known = cells.select("series", "value", "n", (F.col("n_before") + moved).alias("n_before"), F.lit(rows).alias("n_total"))
    filled = (
        cells.groupBy("series", "n_total")
        .agg(F.coalesce(F.max(F.when(F.col("value") <= median, F.col("n_before") + F.col("n"))), F.lit(0)).alias("n_before"))
        .select("series", median.alias("value"), (F.lit(rows) - F.col("n_total")).alias("n"), "n_before", F.lit(rows).alias("n_total"))
        .where(F.col("n") > 0)
    )
    quartiles: dict[str, dict[float, float]] = {c: {} for c in columns}
    for r in quantiles_from_cells(known.unionByName(filled), ["series"], [0.25, 0.5, 0.75]).collect():
        quartiles[r["series"]][r["q"]] = r["quantile"]
    cells.unpersist()
    return medians, {c: centre_and_spread(q) for c, q in quartiles.items()}


def centre_and_spread(quartiles: dict[float, float]) -> tuple[float, float]:
    """Median and interquartile range; a zero range divides by one."""
    spread = quartiles.get(0.75, 0.0) - quartiles.get(0.25, 0.0)
    return quartiles.get(0.5, 0.0), spread if spread != 0.0 else 1.0


def impute(df: DataFrame, medians: dict[str, float]) -> DataFrame:
    return df.withColumns(
        {c: F.coalesce(F.col(c).cast("double"), F.lit(float(m))) for c, m in medians.items()}
    )


def robust_scale(df: DataFrame, scaling: dict[str, tuple[float, float]]) -> DataFrame:
    return df.withColumns(
        {c: (F.col(c) - F.lit(float(m))) / F.lit(float(s)) for c, (m, s) in scaling.items()}
    )

"""Profiling statistics of a labelled wide table.

The per-column statistics unpivot the table once and aggregate by ``series``, so a wide table
costs one small shuffle instead of one job per column.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from tenura.functions.expressions import normal_two_sided, rate_side, stars
from tenura.operators.ranking import by_class, quantiles_from_cells, value_cells

# Cut-offs and sizes of the profile.
OUTLIER_Z = 3.0
OUTLIER_MIN_ROWS = 10
OUTLIER_MIN_PERCENT = 1.0
CATEGORY_MIN_ROWS = 50
HISTOGRAM_BINS = 30
RISK_BINS = 50
WHISKER = 1.5


def tall(df: DataFrame, columns: list[str], keep: list[str] | None = None) -> DataFrame:
    """``(keep..., series, value)`` for numeric columns, NULLs dropped."""
    entries = [F.struct(F.lit(c).alias("series"), F.col(c).cast("double").alias("value")) for c in columns]
    return df.select(*(keep or []), F.inline(F.array(*entries))).where(F.col("value").isNotNull())


def tall_text(df: DataFrame, columns: list[str], keep: list[str], missing: str | None = None) -> DataFrame:
    """``(keep..., feature, category)``; ``missing`` names the category of NULL."""

    def text(c: str) -> Column:
        value = F.col(c).cast("string")
        return value if missing is None else F.coalesce(value, F.lit(missing))

    entries = [F.struct(F.lit(c).alias("feature"), text(c).alias("category")) for c in columns]
    return df.select(*keep, F.inline(F.array(*entries)))


def source_checks(df: DataFrame, target: str) -> DataFrame:
    """One row: row count, NULL targets, distinct target values."""
    return df.agg(
        F.count(F.lit(1)).alias("n_rows"),
        F.count_if(F.col(target).isNull()).alias("n_null_target"),
        F.count_distinct(target).alias("n_classes"),
    )


def target_distribution(df: DataFrame, label: str) -> DataFrame:
    """Count and share of both classes, each present even when empty."""
    one = df.agg(
        F.count_if(F.col(label) == 0).alias("zero"),
        F.count_if(F.col(label) == 1).alias("one"),
    )
    rows = F.array(
        F.struct(F.lit(0).alias("label"), F.col("zero").alias("n")),
        F.struct(F.lit(1).alias("label"), F.col("one").alias("n")),
    )
    total = F.col("zero") + F.col("one")
    return one.select(total.alias("__t"), F.inline(rows)).select(
        "label", "n", F.coalesce(F.try_divide(F.col("n"), F.col("__t")), F.lit(0.0)).alias("share")
    )


def duplicate_rows(df: DataFrame, exclude: list[str] | None = None) -> DataFrame:
    """Rows beyond the first of each group of equal rows (NULLs equal).

    Rows are grouped on their own values with map-side counts, so a group of many copies
    shuffles once per task.
    """
    columns = [c for c in df.columns if c not in (exclude or [])]
    groups = df.groupBy(*columns).agg(F.count(F.lit(1)).alias("__n"))
    total = F.coalesce(F.sum("__n"), F.lit(0))
    extra = total - F.count(F.lit(1))
    return groups.agg(
        total.alias("n_rows"),
        extra.alias("n_duplicates"),
        F.coalesce(F.try_divide(extra * 100.0, total), F.lit(0.0)).alias("duplicate_pct"),
    )


def cardinality(df: DataFrame, columns: list[str], *, approximate: bool = False) -> DataFrame:
    """Distinct non-null values per category, highest first."""
    long = tall_text(df, columns, []).where(F.col("category").isNotNull())
    count = F.approx_count_distinct("category") if approximate else F.count_distinct("category")
    return long.groupBy("feature").agg(count.alias("n_values")).orderBy(F.desc("n_values"), "feature")


def category_rates(
    df: DataFrame, columns: list[str], label: str, *, min_rows: int = CATEGORY_MIN_ROWS
) -> DataFrame:
    """Target rate and count per category of every feature, NULL as ``MISSING``, above/below global."""
    grouped = (
        tall_text(df, columns, [label], missing="MISSING")
        .groupBy("feature", "category")
        .agg(F.avg(label).alias("churn_rate"), F.count(F.lit(1)).alias("n"), F.sum(label).alias("__pos"))
    )
    # Every feature counts every row once, so the ratio over all groups is the overall rate.
    overall = grouped.agg((F.sum("__pos") / F.sum("n")).alias("r")).scalar()
    return (
        grouped.where(F.col("n") > min_rows)
        .drop("__pos")
        .withColumn("global_rate", overall)
        .withColumn("side", rate_side(F.col("churn_rate"), F.col("global_rate")))
        .orderBy("feature", "churn_rate", "category")
    )


def category_dispersion(df: DataFrame, columns: list[str], label: str, top: int = 9) -> DataFrame:
    """Categories ranked by the sample deviation of their unweighted rates; NULL left out."""
    rates = (
        tall_text(df, columns, [label])
        .where(F.col("category").isNotNull())
        .groupBy("feature", "category")
        .agg(F.avg(label).alias("rate"))
    )
    return (
        rates.groupBy("feature")
        .agg(F.count(F.lit(1)).alias("n_categories"), F.stddev_samp("rate").alias("dispersion"))
        .where(F.col("n_categories") >= 2)
        .orderBy(F.desc("dispersion"), "feature")
        .limit(top)
    )


def churn_by_area(df: DataFrame, area: str, label: str) -> DataFrame:
    """Mean and count per trimmed upper-case area."""
    return (
        df.groupBy(F.upper(F.trim(F.col(area))).alias("area"))
        .agg(F.avg(label).alias("churn_rate"), F.count(F.lit(1)).alias("n"))
        .withColumn("churn_rate_pct", F.bround(F.col("churn_rate") * 100, 1))
    )


def outlier_share(
    df: DataFrame,
    columns: list[str],
    *,
    z: float = OUTLIER_Z,
    min_rows: int = OUTLIER_MIN_ROWS,
    min_percent: float = OUTLIER_MIN_PERCENT,
) -> DataFrame:
    """Percent of values more than ``z`` population deviations from the mean, above ``min_percent``.

    Two aggregates over the table as it stands: means and deviations of all columns, then the values beyond them.
    """
    if not columns:
        return df.sparkSession.createDataFrame([], "series string, n bigint, n_outliers bigint, outlier_pct double")
    value = {c: F.col(c).cast("double") for c in columns}
    stats = df.agg(
        F.struct(
            *[F.struct(F.avg(x).alias("m"), F.stddev_pop(x).alias("s")).alias(f"c{i}") for i, x in enumerate(value.values())]
        ).alias("__s")
    ).scalar()
    far = [
        F.abs(F.try_divide(x - F.col(f"__s.c{i}.m"), F.col(f"__s.c{i}.s"))) > z for i, x in enumerate(value.values())
    ]
    counts = [
        F.struct(F.lit(c).alias("series"), F.count(x).alias("n"), F.count_if(hit).alias("n_outliers"))
        for (c, x), hit in zip(value.items(), far)
    ]
    found = df.select(*columns).withColumn("__s", stats).agg(F.array(*counts).alias("__found"))
    return (
        found.select(F.inline("__found"))
        .where(F.col("n") >= min_rows)
        .withColumn("outlier_pct", F.col("n_outliers") * 100.0 / F.col("n"))
        .where(F.col("outlier_pct") > min_percent)
        .orderBy(F.desc("outlier_pct"), "series")
    )


def class_histogram(df: DataFrame, columns: list[str], label: str, bins: int = HISTOGRAM_BINS) -> DataFrame:
    """Density histogram per class over that class's own range; the last bin is closed."""
    long = tall(df, columns, [label])
    ranges = long.groupBy("series", label).agg(
        F.min("value").alias("lo"), F.max("value").alias("hi"), F.count(F.lit(1)).alias("total")
    )
    flat = F.col("lo") == F.col("hi")
    ranges = ranges.select(
        "series", label, "total",
        F.when(flat, F.col("lo") - 0.5).otherwise(F.col("lo")).alias("lo"),
        F.when(flat, F.col("lo") + 0.5).otherwise(F.col("hi")).alias("hi"),
    ).withColumn("width", (F.col("hi") - F.col("lo")) / F.lit(float(bins)))
    # Two rows per column of the schema.
    joined = long.join(F.broadcast(ranges), ["series", label])
    guess = F.floor((F.col("value") - F.col("lo")) / (F.col("hi") - F.col("lo")) * F.lit(float(bins)))
    guess = F.least(F.greatest(guess, F.lit(0)), F.lit(bins - 1))
    joined = joined.withColumn("__g", guess)
    edge = lambda k: F.col("lo") + k * F.col("width")
    exact = (
        F.when(F.col("value") < edge(F.col("__g")), F.col("__g") - 1)
        .when((F.col("value") >= edge(F.col("__g") + 1)) & (F.col("__g") < bins - 1), F.col("__g") + 1)
        .otherwise(F.col("__g"))
    )
    return (
        joined.withColumn("bin", exact.cast("int"))
        .groupBy("series", label, "bin", "lo", "width", "total")
        .agg(F.count(F.lit(1)).alias("n"))
        .select(
            "series", label, "bin", "n",
            (F.col("lo") + F.col("bin") * F.col("width")).alias("bin_from"),
            (F.col("n") / (F.col("total") * F.col("width"))).alias("density"),
        )
    )


def risk_histogram(df: DataFrame, prob: str, label: str, bins: int = RISK_BINS) -> DataFrame:
    """Counts per class over even probability bins; 1.0 falls into the last one."""
    index = F.least(F.floor(F.col(prob) * F.lit(float(bins))), F.lit(bins - 1)).cast("int")
    return df.groupBy(index.alias("bin"), label).agg(F.count(F.lit(1)).alias("n"))


def boxplot_stats(df: DataFrame, columns: list[str], label: str) -> DataFrame:
    """Five-number summary and flier count per column and class."""
    cells = by_class(value_cells(df, columns, label))
    wide = (
        quantiles_from_cells(cells, ["series", "label"], [0.25, 0.5, 0.75])
        .groupBy("series", "label")
        .agg(
            F.max(F.when(F.col("q") == 0.25, F.col("quantile"))).alias("q1"),
            F.max(F.when(F.col("q") == 0.5, F.col("quantile"))).alias("median"),
            F.max(F.when(F.col("q") == 0.75, F.col("quantile"))).alias("q3"),
        )
    )
    reach = (F.col("q3") - F.col("q1")) * WHISKER
    # Two rows per column of the schema.
    fenced = cells.join(F.broadcast(wide), ["series", "label"])
    inside = F.col("value").between(F.col("q1") - reach, F.col("q3") + reach)
    return fenced.groupBy("series", "label", "q1", "median", "q3").agg(
        F.min(F.when(inside, F.col("value"))).alias("whisker_low"),
        F.max(F.when(inside, F.col("value"))).alias("whisker_high"),
        F.sum(F.when(~inside, F.col("n")).otherwise(0)).alias("n_fliers"),
    )


def mann_whitney(df: DataFrame, columns: list[str], label: str) -> DataFrame:
    """Two-sided rank test of class 0 against class 1 with mid-ranks and tie correction.

    Always the tie-corrected normal approximation with continuity correction; the exact small
    sample distribution is not used.
    """
    cells = value_cells(df, columns, label)
    n, pos = F.col("n").cast("double"), F.col("pos").cast("double")
    mid_rank = F.col("n_before") + (n + 1.0) / 2.0
    sums = cells.groupBy("series").agg(
        # Class sizes from the cell totals, so both branches of the prefix sum read the same columns.
        F.max("pos_total").cast("double").alias("n1"),
        F.max(F.col("n_total") - F.col("pos_total")).cast("double").alias("n0"),
        F.sum((n - pos) * mid_rank).alias("rank_sum"),
        F.sum(n * n * n - n).alias("ties"),
    )
    n0, n1 = F.col("n0"), F.col("n1")
    total = n0 + n1
    u0 = F.col("rank_sum") - n0 * (n0 + 1.0) / 2.0
    variance = n0 * n1 / 12.0 * ((total + 1.0) - F.try_divide(F.col("ties"), total * (total - 1.0)))
    larger = F.greatest(u0, n0 * n1 - u0)
    z = F.try_divide(larger - n0 * n1 / 2.0 - 0.5, F.sqrt(variance))
    tested = sums.select("series", u0.alias("u_statistic"), z.alias("z"))
    p = normal_two_sided(F.greatest(F.col("z"), F.lit(0.0)))
    return tested.withColumn("p_value", p).withColumn("significance", stars(F.col("p_value")))

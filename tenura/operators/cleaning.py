"""Typing and cleaning rules for a wide customer table."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame, functions as F

from tenura.functions.expressions import clean_category, decimal_comma, upper_clip
from tenura.roles import FLAG_SUFFIX, Roles

# Limits of the cleaning rules.
DROP_ABOVE = 0.50
FLAG_ABOVE = 0.20
UPPER_LIMITS = {"uniqsubs": 13.0, "actvsubs": 11.0}
NON_NEGATIVE = ("eqpdays",)
CAPPED_BY = {"drop_vce_Mean": "plcd_vce_Mean"}
PARSE_LOSS_LIMIT = 0.05


def drop_identifiers(df: DataFrame, roles: Roles) -> DataFrame:
    return df.drop(*roles.identifiers(df))


def type_measures(df: DataFrame, columns: list[str]) -> DataFrame:
    """Decimal-comma text to DOUBLE for the given columns; other types pass unchanged."""
    text = {name for name, kind in df.dtypes if kind == "string"}
    return df.withColumns({c: decimal_comma(F.col(c)) for c in columns if c in text})


def parse_quality(df: DataFrame, columns: list[str]) -> DataFrame:
    """Per column: texts present, numbers parsed, share lost, and a warning above the limit; from one aggregate row."""
    counts = [F.struct(F.count(c).alias("n_text"), F.count(decimal_comma(F.col(c))).alias("n_parsed")).alias(c) for c in columns]
    entries = [F.struct(F.lit(c).alias("column"), f"{c}.n_text", f"{c}.n_parsed") for c in columns]
    counted = df.agg(*counts).select(F.inline(F.array(*entries)))
    lost = F.coalesce(F.try_divide(F.col("n_text") - F.col("n_parsed"), F.col("n_text")), F.lit(0.0))
    return counted.withColumn("lost_share", lost).withColumn("warn", F.col("lost_share") > PARSE_LOSS_LIMIT)


def domain_predicates(
    df: DataFrame,
    non_negative: tuple[str, ...] = NON_NEGATIVE,
    upper_limits: Mapping[str, float] = UPPER_LIMITS,
    capped_by: Mapping[str, str] = CAPPED_BY,
) -> dict[str, Column]:
    """Rule name -> violation predicate, for the rules whose columns are present."""
    have = set(df.columns)
    rules = {f"{c}_negative": F.col(c) < 0 for c in non_negative if c in have}
    rules |= {f"{c}_above_limit": F.col(c) > hi for c, hi in upper_limits.items() if c in have}
    rules |= {
        f"{c}_above_{cap}": F.col(c) > F.col(cap)
        for c, cap in capped_by.items()
        if c in have and cap in have
    }
    return rules


def apply_domain_rules(
    df: DataFrame,
    non_negative: tuple[str, ...] = NON_NEGATIVE,
    upper_limits: Mapping[str, float] = UPPER_LIMITS,
    capped_by: Mapping[str, str] = CAPPED_BY,
) -> DataFrame:
    """Null out negatives, clip from above, cap one column by another. NULL stays NULL."""
    have = set(df.columns)
    fixed = {c: F.when(F.col(c) >= 0, F.col(c)) for c in non_negative if c in have}
    fixed |= {c: upper_clip(F.col(c), hi) for c, hi in upper_limits.items() if c in have}
    fixed |= {
        c: F.when(F.col(c) > F.col(cap), F.col(cap)).otherwise(F.col(c))
        for c, cap in capped_by.items()
        if c in have and cap in have
    }
    return df.withColumns(fixed) if fixed else df


def rule_violations(df: DataFrame, rules: Mapping[str, Column]) -> DataFrame:
    """One row per rule with the number of rows it changes; one aggregate row, nothing is unpivoted."""
    if not rules:
        return df.sparkSession.createDataFrame([], "rule string, violations long")
    entries = [F.struct(F.lit(name).alias("rule"), F.col(name).alias("violations")) for name in rules]
    return df.agg(*[F.count_if(hit).alias(name) for name, hit in rules.items()]).select(F.inline(F.array(*entries)))


def missing_counts(df: DataFrame, columns: list[str]) -> DataFrame:
    """Long table ``column, n_rows, n_missing, missing_rate`` from a single aggregate row."""
    totals = df.agg(
        F.count(F.lit(1)).alias("__rows"), *[F.count(F.col(c)).alias(c) for c in columns]
    )
    entries = [
        F.struct(F.lit(c).alias("column"), (F.col("__rows") - F.col(c)).alias("n_missing")) for c in columns
    ]
    return totals.select(F.col("__rows").alias("n_rows"), F.inline(F.array(*entries))).withColumn(
        "missing_rate", F.coalesce(F.try_divide("n_missing", "n_rows"), F.lit(0.0))
    )


def missing_rates(df: DataFrame, columns: list[str]) -> dict[str, float]:
    """Missing rates as plan-time metadata: one row, as many numbers as columns."""
    return {r["column"]: r["missing_rate"] for r in missing_counts(df, columns).collect()}


def sparse_columns(rates: Mapping[str, float], above: float = DROP_ABOVE) -> list[str]:
    return [c for c, rate in rates.items() if rate > above]


def flagged_columns(
    rates: Mapping[str, float], above: float = FLAG_ABOVE, up_to: float = DROP_ABOVE
) -> list[str]:
    return [c for c, rate in rates.items() if above < rate <= up_to]


def add_missing_flags(df: DataFrame, columns: list[str]) -> DataFrame:
    return df.withColumns({c + FLAG_SUFFIX: F.col(c).isNull().cast("int") for c in columns})


def normalise_categories(df: DataFrame, columns: list[str], missing: str | None = None) -> DataFrame:
    """Trim and upper-case; ``missing`` turns NULL into a category of its own."""
    return df.withColumns({c: clean_category(F.col(c), missing) for c in columns if c in df.columns})


def fill_categories(df: DataFrame, columns: list[str], value: str = "MISSING") -> DataFrame:
    return df.withColumns({c: F.coalesce(F.col(c).cast("string"), F.lit(value)) for c in columns})


def categories_as_text(df: DataFrame, columns: list[str]) -> DataFrame:
    """Binary categories typed as text; NULL stays NULL."""
    return df.withColumns({c: F.col(c).cast("string") for c in columns if c in df.columns})


def with_label(df: DataFrame, target: str, label: str = "label") -> DataFrame:
    return df.withColumn(label, F.col(target).cast("int")).drop(*([target] if target != label else []))


def class_values(df: DataFrame, column: str, label: str, value: int) -> DataFrame:
    """Non-null values of one column within one class."""
    return df.where((F.col(label) == value) & F.col(column).isNotNull()).select(column)



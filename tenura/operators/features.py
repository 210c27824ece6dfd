"""Engineered usage features and per-customer retention flags."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, functions as F

from tenura.operators.ranking import (
    BROADCAST_ROWS,
    add_prefix_sums,
    quantiles_from_cells,
    split_points,
    with_order_codes,
)
from tenura.session import broadcast_if_small

# Device age limit in days, early-tenure limit in months, contact share.
OLD_DEVICE_DAYS = 500
EARLY_MONTHS = 12
TOP_SHARE = 10


@dataclass(frozen=True)
class UsageColumns:
    """Inputs of the engineered features; a feature is skipped when an input is absent."""

    recent: str = "avg3mou"
    baseline: str = "avg6mou"
    dropped: str = "drop_vce_Mean"
    placed: str = "plcd_vce_Mean"
    device_days: str = "eqpdays"
    delta_name: str = "recent_usage_delta"


def old_device(days: Column) -> Column:
    return (days > OLD_DEVICE_DAYS).cast("double")


def drop_rate(dropped: Column, placed: Column) -> Column:
    """NULL where the denominator is zero."""
    return F.try_divide(dropped, placed + F.lit(1.0))


def usage_features(df: DataFrame, columns: UsageColumns = UsageColumns()) -> tuple[DataFrame, dict[str, str]]:
    """Add the usage features that can be built; the second result says why others were skipped."""
    c = columns
    plan = {
        c.delta_name: ((c.recent, c.baseline), lambda: F.col(c.recent) - F.col(c.baseline)),
        "drop_rate": ((c.dropped, c.placed), lambda: drop_rate(F.col(c.dropped), F.col(c.placed))),
        "old_phone": ((c.device_days,), lambda: old_device(F.col(c.device_days))),
    }
    skipped = {
        name: "absent: " + ", ".join(x for x in needs if x not in df.columns)
        for name, (needs, _) in plan.items()
        if any(x not in df.columns for x in needs)
    }
    built = {name: make() for name, (_, make) in plan.items() if name not in skipped}
    return (df.withColumns(built) if built else df), skipped


def segment_median(df: DataFrame, segment: str, column: str) -> DataFrame:
    """Exact median per segment through bucketed value counts; no segment is gathered."""
    points = split_points(df, [column])
    coded = with_order_codes(df.select(segment, column), [column], points)
    cells = (
        coded.where(F.col(column).isNotNull())
        .groupBy(segment, F.col(f"__code_{column}").alias("bucket"), F.col(column).cast("double").alias("value"))
        .agg(F.count(F.lit(1)).alias("n"))
    )
    cells = add_prefix_sums(cells, [segment], [F.asc("value")], ["n"])
    return quantiles_from_cells(cells, [segment], [0.5]).select(
        segment, F.col("quantile").alias("segment_median")
    )


def retention_flags(
    df: DataFrame,
    *,
    row_id: str = "row_id",
    segment: str = "segment",
    device_days: str = "eqpdays",
    delta: str = "recent_usage_delta",
    drop: str = "drop_rate",
    usage: str = "avgmou",
    months: str | None = "months",
    revenue_delta: str | None = None,
    risk_rank: str | None = None,
) -> DataFrame:
    """Per-customer triggers of the retention actions, 1 when an action applies.

    The segment average and the segment median are joined back per segment; a NULL input never
    triggers. ``risk_rank`` (1 = riskiest) adds the top-share flag.
    """
    averages = df.groupBy(segment).agg(F.avg(drop).alias("segment_drop"))
    stats = averages.join(segment_median(df, segment, usage), segment, "left")
    joined = df.join(broadcast_if_small(stats, BROADCAST_ROWS), segment, "left")

    def flag(condition: Column) -> Column:
        return F.coalesce(condition.cast("int"), F.lit(0))

    flags = {
        "device_upgrade": flag(F.col(device_days) > OLD_DEVICE_DAYS),
        "usage_outreach": flag(F.col(delta) < 0),
        "service_quality": flag(F.col(drop) > F.col("segment_drop")),
        "low_engagement": flag(F.col(usage) < F.col("segment_median")),
    }
    if months is not None:
        flags["early_lifecycle"] = flag(F.col(months) < EARLY_MONTHS)
    if revenue_delta is not None:
        flags["revenue_review"] = flag(F.col(revenue_delta) < 0)
    if risk_rank is not None:
        rows = df.agg(F.count(F.lit(1)).alias("n")).scalar()
        flags["priority_contact"] = flag(F.col(risk_rank) * 100 <= rows * TOP_SHARE)
    return joined.select(row_id, segment, *[e.alias(name) for name, e in flags.items()])

"""Campaign segmentation of a scored table: lift, gain, reach, exports."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from tenura.functions.expressions import driver_label, safe_div
from tenura.operators.metrics import threshold_predictions
from tenura.operators.ranking import rank_rows

# Segment sizes, number of gain points, contact range.
SEGMENT_PERCENTS = (10, 20, 30)
GAIN_POINTS = 200
CONTACT_PERCENTS = (1, 50)

# Telecom area -> state.
AREA_STATE = {
    "NORTHWEST/ROCKY MOUNTAIN AREA": "MT",
    "MIDWEST AREA": "IL",
    "NEW ENGLAND AREA": "MA",
    "GREAT LAKES AREA": "MI",
    "OHIO AREA": "OH",
    "TENNESSEE AREA": "TN",
    "HOUSTON AREA": "TX",
    "DALLAS AREA": "TX",
    "CENTRAL/SOUTH TEXAS AREA": "TX",
    "SOUTHWEST AREA": "AZ",
    "CALIFORNIA NORTH AREA": "CA",
    "LOS ANGELES AREA": "CA",
    "SOUTH FLORIDA AREA": "FL",
    "NORTH FLORIDA AREA": "FL",
    "ATLANTIC SOUTH AREA": "GA",
    "PHILADELPHIA AREA": "PA",
    "NEW YORK CITY AREA": "NY",
    "CHICAGO AREA": "IL",
    "DC/MARYLAND/VIRGINIA AREA": "VA",
}


def lookup(key: Column, table: dict[str, str]) -> Column:
    """A fixed lookup table as a map literal; an unknown key gives NULL."""
    entries = [F.lit(x) for pair in table.items() for x in pair]
    return F.try_element_at(F.create_map(*entries), key)


def ranked_scores(df: DataFrame, prob: str = "prob", label: str = "label", row_id: str = "row_id") -> DataFrame:
    """``row_id, prob, label, rank, label_upto, n_rows, label_total``: riskiest first, ties by ``row_id``."""
    narrow = df.select(
        F.col(row_id).alias("row_id"), F.col(prob).alias("prob"), F.col(label).cast("bigint").alias("label")
    )
    return rank_rows(narrow, "prob", "row_id", ["label"])


def segments(ranked: DataFrame, percents: tuple[int, ...] = SEGMENT_PERCENTS) -> DataFrame:
    """Size, positive rate and captured share of the top p percent, one conditional aggregate."""
    rows = ranked.select("rank", "label", F.col("n_rows").alias("n"), F.col("label_total").alias("pos"))
    size = {p: F.expr(f"n * {p} div 100") for p in percents}
    cut = rows.groupBy("n", "pos").agg(
        *[F.coalesce(F.sum(F.when(F.col("rank") <= size[p], F.col("label"))), F.lit(0)).alias(f"c{p}") for p in percents]
    )
    lines = [
        F.struct(F.lit(p).alias("percent"), size[p].alias("n_customers"), F.col(f"c{p}").alias("captured"))
        for p in percents
    ]
    return cut.select("pos", F.inline(F.array(*lines))).select(
        "percent", "n_customers",
        F.bround(safe_div(F.col("captured"), F.col("n_customers"), None) * 100, 1).alias("churn_rate_pct"),
        F.bround(F.col("captured") / F.greatest(F.col("pos"), F.lit(1)) * 100, 1).alias("churn_captured_pct"),
    )


def top_lift(segment_table: DataFrame, percent: int = 20) -> DataFrame:
    """Captured share over contacted share for one segment."""
    return segment_table.where(F.col("percent") == percent).select(
        "percent", (F.col("churn_captured_pct") / F.lit(float(percent))).alias("lift")
    )


def gain_curve(ranked: DataFrame, points: int = GAIN_POINTS) -> DataFrame:
    """About ``points`` evenly spaced points of the cumulative gain curve."""
    step = F.greatest(F.expr(f"n_rows div {points}"), F.lit(1))
    on_grid = ranked.where(F.pmod(F.col("rank") - 1, step) == 0)
    return on_grid.select(
        F.bround(F.col("rank") / F.col("n_rows") * 100, 2).alias("customer_pct"),
        F.bround(F.col("label_upto") / F.greatest(F.col("label_total"), F.lit(1)) * 100, 2).alias(
            "churners_captured_pct"
        ),
    )


def campaign_reach(ranked: DataFrame, low: int = CONTACT_PERCENTS[0], high: int = CONTACT_PERCENTS[1]) -> DataFrame:
    """Contacts, captures, precision and lift for every whole contact percentage.

    The last contacted row of p percent has rank n*p div 100 (at least 1), so each row knows from
    its rank which percentages end at it; almost all rows end none.
    """
    first = F.when(F.col("rank") == 1, F.lit(low)).otherwise(
        F.greatest(F.expr("(rank * 100 + n_rows - 1) div n_rows"), F.lit(low))
    )
    last = F.least(F.expr("((rank + 1) * 100 + n_rows - 1) div n_rows - 1"), F.lit(high))
    ends = ranked.select(
        F.col("rank").alias("contacted"), F.col("label_upto").alias("captured"), "label_total",
        first.cast("int").alias("first"), last.cast("int").alias("last"),
    ).where(F.col("first") <= F.col("last"))
    share = safe_div(F.col("captured"), F.col("label_total")) * 100
    return ends.withColumn("contact_pct", F.explode(F.sequence("first", "last"))).select(
        "contact_pct", "contacted", "captured",
        share.alias("capture_pct"),
        (F.col("captured") / F.col("contacted") * 100).alias("precision_pct"),
        (share / F.col("contact_pct")).alias("lift"),
    )


def predictions_table(df: DataFrame, prob: str, label: str, thresholds: dict[str, float], *, row_id: str | None = None) -> DataFrame:
    """The export columns; the file writer sorts them, equal probabilities by ``row_id`` if it is named here."""
    flags = threshold_predictions(prob, thresholds)
    return df.select(
        F.col(prob).alias("churn_probability"),
        *[column.alias(name) for name, column in flags.items()],
        F.col(label).cast("int").alias("true_label"),
        *([F.col(row_id).alias("row_id")] if row_id else []),
    )


def churn_by_state(areas: DataFrame, states: dict[str, str] = AREA_STATE) -> DataFrame:
    """Area rows with their state; areas without one drop out."""
    return areas.withColumn("state", lookup(F.col("area"), states)).where(F.col("state").isNotNull())


def state_rollup(by_area: DataFrame) -> DataFrame:
    """Count-weighted rate per state (several areas may share one)."""
    rate = F.sum(F.col("churn_rate") * F.col("n")) / F.sum("n")
    return by_area.groupBy("state").agg(rate.alias("churn_rate"), F.sum("n").alias("n"))


def high_risk_list(drivers: DataFrame, *, min_prob: float = 0.0, search: str = "") -> DataFrame:
    """Rank, risk and three driver labels, filtered by minimum score and literal driver text."""

    def label_at(i: int) -> Column:
        item = F.get("top_drivers", i)
        return F.coalesce(driver_label(item["feature"], item["shap_value"]), F.lit(""))

    shown = drivers.select(
        "rank", "churn_probability",
        F.bround(F.col("churn_probability") * 100, 1).alias("risk_pct"),
        label_at(0).alias("primary_driver"), label_at(1).alias("driver_2"), label_at(2).alias("driver_3"),
    )
    if min_prob > 0:
        shown = shown.where(F.col("churn_probability") >= min_prob)
    text = search.strip().lower()
    if text:
        words = F.lower(F.concat_ws(" ", "primary_driver", "driver_2", "driver_3"))
        shown = shown.where(words.contains(text))
    return shown

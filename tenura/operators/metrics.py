"""Ranking, threshold and calibration metrics of scored tables.

A scored table has one label and one or more probability columns; every metric handles all
probability columns in the same pass, keyed by ``series``.
"""

from __future__ import annotations

from pyspark.ml.feature import Bucketizer
from pyspark.sql import Column, DataFrame, Window, functions as F

from tenura.functions.expressions import count_edges, safe_div
from tenura.operators.profiling import tall
from tenura.operators.ranking import value_cells

# Threshold grid of 200 points, precision floor, inner calibration edges.
SWEEP_POINTS = 200
SWEEP_GRID = tuple([i * (1 / 199) for i in range(SWEEP_POINTS - 1)] + [1.0])
PRECISION_FLOOR = 0.60
CALIBRATION_EDGES = (0.1, 0.2, 0.30000000000000004, 0.4, 0.5, 0.6000000000000001, 0.7000000000000001, 0.8, 0.9)


def f1_of(precision: Column, recall: Column) -> Column:
    return safe_div(precision * recall * 2.0, precision + recall)


def curve_cells(df: DataFrame, probs: list[str], label: str) -> DataFrame:
    """Per series and distinct score, best first: counts, counts before, and class totals."""
    return value_cells(df, probs, label, descending=True).withColumns(
        {"all_pos": F.col("pos_total"), "all_neg": F.col("n_total") - F.col("pos_total")}
    )


def _with_counts(cells: DataFrame) -> DataFrame:
    tp = F.col("pos_before") + F.col("pos")
    return cells.withColumn("tp", tp).withColumn("fp", F.col("n_before") + F.col("n") - tp)


def _first_row(cells: DataFrame, **values: Column) -> DataFrame:
    return cells.select("series").distinct().select("series", *[v.alias(k) for k, v in values.items()])


def roc_points(cells: DataFrame) -> DataFrame:
    """``series, threshold, fpr, tpr`` at every distinct score, plus the origin (threshold NULL)."""
    points = _with_counts(cells).select(
        "series", F.col("value").alias("threshold"),
        safe_div(F.col("fp"), F.col("all_neg")).alias("fpr"),
        safe_div(F.col("tp"), F.col("all_pos")).alias("tpr"),
    )
    origin = _first_row(points, threshold=F.lit(None).cast("double"), fpr=F.lit(0.0), tpr=F.lit(0.0))
    return points.unionByName(origin)


def pr_points(cells: DataFrame) -> DataFrame:
    """``series, threshold, precision, recall``, plus the terminal point (1, 0)."""
    points = _with_counts(cells).select(
        "series", F.col("value").alias("threshold"),
        safe_div(F.col("tp"), F.col("tp") + F.col("fp")).alias("precision"),
        safe_div(F.col("tp"), F.col("all_pos")).alias("recall"),
    )
    end = _first_row(points, threshold=F.lit(None).cast("double"), precision=F.lit(1.0), recall=F.lit(0.0))
    return points.unionByName(end)


def auc(cells: DataFrame) -> DataFrame:
    """Share of (positive, negative) pairs in the right order, ties one half."""
    pos, neg = F.col("pos").cast("double"), (F.col("n") - F.col("pos")).cast("double")
    won = neg * (F.col("pos_before").cast("double") + pos / 2.0)
    pairs = F.max(F.col("all_pos").cast("double") * F.col("all_neg").cast("double"))
    return cells.groupBy("series").agg(F.try_divide(F.sum(won), pairs).alias("auc"))


def average_precision(cells: DataFrame) -> DataFrame:
    """Precision at each distinct score weighted by the recall gained there."""
    gained = safe_div(F.col("pos"), F.col("all_pos"), None)
    precision = safe_div(F.col("tp"), F.col("tp") + F.col("fp"))
    return _with_counts(cells).groupBy("series").agg(F.sum(gained * precision).alias("average_precision"))


def confusion(df: DataFrame, predictions: dict[str, Column], label: str) -> DataFrame:
    """``series, tn, fp, fn, tp`` for any number of hard predictions in one aggregate."""
    entries = [F.struct(F.lit(k).alias("series"), p.cast("int").alias("p")) for k, p in predictions.items()]
    y, p = F.col("y"), F.col("p")
    return (
        df.select(F.col(label).alias("y"), F.inline(F.array(*entries)))
        .groupBy("series")
        .agg(
            F.count_if((y == 0) & (p == 0)).alias("tn"),
            F.count_if((y == 0) & (p == 1)).alias("fp"),
            F.count_if((y == 1) & (p == 0)).alias("fn"),
            F.count_if((y == 1) & (p == 1)).alias("tp"),
        )
    )


def point_metrics(matrix: DataFrame) -> DataFrame:
    """Precision, recall and F1 beside each confusion matrix; 0 where undefined."""
    precision = safe_div(F.col("tp"), F.col("tp") + F.col("fp"))
    recall = safe_div(F.col("tp"), F.col("tp") + F.col("fn"))
    return (
        matrix.withColumn("precision", precision)
        .withColumn("recall", recall)
        .withColumn("f1", f1_of(F.col("precision"), F.col("recall")))
    )


def classification_report(matrix: DataFrame) -> DataFrame:
    """Rows ``0, 1, accuracy, macro avg, weighted avg`` with precision, recall, f1, support."""
    tn, fp, fn, tp = (F.col(c) for c in ("tn", "fp", "fn", "tp"))
    both = matrix.select(
        "series",
        (tn + fp).alias("s0"), (tp + fn).alias("s1"),
        safe_div(tn, tn + fn).alias("p0"), safe_div(tn, tn + fp).alias("r0"),
        safe_div(tp, tp + fp).alias("p1"), safe_div(tp, tp + fn).alias("r1"),
        safe_div(tn + tp, tn + fp + fn + tp).alias("acc"),
    )
    both = both.withColumn("f0", f1_of(F.col("p0"), F.col("r0"))).withColumn("f1", f1_of(F.col("p1"), F.col("r1")))
    all_rows = F.col("s0") + F.col("s1")

    def line(name: str, p: Column, r: Column, f: Column, support: Column) -> Column:
        return F.struct(
            F.lit(name).alias("row"), p.alias("precision"), r.alias("recall"),
            f.alias("f1_score"), support.cast("bigint").alias("support"),
        )

    def weighted(name: str) -> Column:
        return safe_div(F.col(f"{name}0") * F.col("s0") + F.col(f"{name}1") * F.col("s1"), all_rows)

    def macro(name: str) -> Column:
        return (F.col(f"{name}0") + F.col(f"{name}1")) / 2.0

    none, accuracy = F.lit(None).cast("double"), F.col("acc")
    lines = F.array(
        line("0", F.col("p0"), F.col("r0"), F.col("f0"), F.col("s0")),
        line("1", F.col("p1"), F.col("r1"), F.col("f1"), F.col("s1")),
        line("accuracy", none, none, accuracy, all_rows),
        line("macro avg", macro("p"), macro("r"), macro("f"), all_rows),
        line("weighted avg", weighted("p"), weighted("r"), weighted("f"), all_rows),
    )
    return both.select("series", F.inline(lines))


def threshold_sweep(df: DataFrame, probs: list[str], label: str) -> DataFrame:
    """Precision, recall and F1 of ``prob >= t`` at 200 thresholds from one pass over the rows.

    Each row is counted once at the last grid point it reaches; the at-least counts are reverse
    running sums over those 200 counts per series.
    """
    long = tall(df, probs, [F.col(label).cast("bigint").alias("y")])
    grid = Bucketizer(
        splits=[float("-inf"), *SWEEP_GRID, float("inf")], inputCol="value", outputCol="reached"
    )
    reached = (
        grid.transform(long)
        .groupBy("series", F.col("reached").cast("int").alias("reached"))
        .agg(F.count(F.lit(1)).alias("n"), F.sum("y").alias("pos"))
    )
    # A dense grid of 200 points per series, seeded from the counts themselves.
    steps = F.array(*[F.struct(F.lit(i).alias("i"), F.lit(t).alias("threshold")) for i, t in enumerate(SWEEP_GRID)])
    dense = reached.groupBy("series").agg(F.sum("pos").alias("all_pos")).select("series", "all_pos", F.inline(steps))
    filled = dense.join(reached.withColumn("i", F.col("reached") - 1), ["series", "i"], "left")
    above = Window.partitionBy("series").orderBy(F.desc("i")).rowsBetween(Window.unboundedPreceding, 0)
    flagged = F.coalesce(F.sum("n").over(above), F.lit(0))
    tp = F.coalesce(F.sum("pos").over(above), F.lit(0))
    counted = filled.select("series", "threshold", "all_pos", flagged.alias("flagged"), tp.alias("tp"))
    precision, recall = safe_div(F.col("tp"), F.col("flagged")), safe_div(F.col("tp"), F.col("all_pos"))
    return counted.select(
        "series", "threshold", precision.alias("precision"), recall.alias("recall")
    ).withColumn("f1", f1_of(F.col("precision"), F.col("recall")))


def best_thresholds(sweep: DataFrame, floor: float = PRECISION_FLOOR) -> DataFrame:
    """Best-F1 and business thresholds per series; the lowest threshold wins ties."""
    t = F.col("threshold")
    viable = F.col("precision") >= floor
    half = F.struct(F.abs(t - 0.5).alias("d"), t.alias("t"), F.col("recall").alias("r"))
    picked = sweep.groupBy("series").agg(
        F.max(F.struct(F.col("f1").alias("v"), (-t).alias("nt"))).alias("f"),
        F.max(F.when(viable, F.struct(F.col("recall").alias("v"), (-t).alias("nt")))).alias("b"),
        F.min(half).alias("h"),
    )
    return picked.select(
        "series",
        F.lit(0.5).alias("threshold_0_5"),
        (-F.col("f.nt")).alias("best_f1_threshold"),
        F.coalesce(-F.col("b.nt"), F.lit(0.5)).alias("business_threshold"),
        F.col("f.v").alias("best_f1"),
        F.coalesce(F.col("b.v"), F.col("h.r")).alias("business_recall"),
    )


def calibration_bins(df: DataFrame, probs: list[str], label: str, *, right_closed: bool = True) -> DataFrame:
    """Mean predicted against observed rate in ten even bins, empty bins absent.

    ``right_closed`` is the reliability-curve rule; the weighted calibration error uses left-closed.
    """
    long = tall(df, probs, [F.col(label).alias("y")])
    index = count_edges(F.col("value"), CALIBRATION_EDGES, inclusive=not right_closed)
    return long.groupBy("series", index.alias("bin")).agg(
        F.count(F.lit(1)).alias("n"), F.avg("value").alias("mean_predicted"), F.avg("y").alias("observed")
    )


def calibration_error(df: DataFrame, probs: list[str], label: str) -> DataFrame:
    """``approx_ece`` (unweighted, right-closed bins) and ``weighted_ece`` (left-closed bins)."""
    gap = F.abs(F.col("mean_predicted") - F.col("observed"))
    plain = calibration_bins(df, probs, label).groupBy("series").agg(F.avg(gap).alias("approx_ece"))
    weighted = calibration_bins(df, probs, label, right_closed=False).groupBy("series").agg(
        (F.sum(gap * F.col("n")) / F.sum("n")).alias("weighted_ece")
    )
    return plain.join(weighted, "series")


def threshold_predictions(prob: str, thresholds: dict[str, float]) -> dict[str, Column]:
    """``prediction_<name>`` columns of ``prob >= threshold``."""
    return {f"prediction_{k}": (F.col(prob) >= F.lit(float(t))).cast("int") for k, t in thresholds.items()}


def model_prediction(prob: str) -> Column:
    """A classifier's own hard label: strictly above one half."""
    return (F.col(prob) > 0.5).cast("int")

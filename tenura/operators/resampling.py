"""Bootstrap replicates of ranking metrics, with every metric from the same draws.

Two ways to resample n scored rows B times:

* multinomial - n hashed positions per replicate, the textbook draw with replacement. B*n positions
  are hashed; they reach the rows packed by blocks of row ids, some two bits each (see ``draws``).
* Poisson - every row carries an independent Poisson(1) weight per replicate, computed from
  ``row_id``. Tasks send packed score cells with vectors of B weight sums instead of rows (see
  ``weight_cells``). This is the one for large tables.
"""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame, Window, functions as F

from tenura.functions.expressions import safe_div
from tenura.operators import weight_cells
from tenura.operators.draws import Draws, cell_table, drawn_cells, multinomial_draws
from tenura.operators.metrics import f1_of
from tenura.operators.ranking import add_prefix_sums, split_points, with_order_codes

# Replicate counts, curve grid, confidence tails.
METRIC_REPLICATES = 300
DIFFERENCE_REPLICATES = 500
CURVE_REPLICATES = 100
CURVE_GRID = 100
GAIN_GRID = 200
TAILS = (0.025, 0.975)
MIN_CURVES = 10

METRICS = ("auc_roc", "f1", "precision", "recall", "avg_precision")


# ---- multinomial draws -------------------------------------------------------------------------


def multinomial_weights(df: DataFrame, replicates: int, row_id: str = "row_id", *, packed: bool = False) -> DataFrame | Draws:
    """``b, row_id, w``: how often each row is drawn in each replicate of n draws; ``packed`` for score cells of many rows."""
    drawn = multinomial_draws(df, replicates, row_id)
    return drawn if packed else drawn.long(df)


def replicate_cells(
    df: DataFrame, probs: list[str], label: str, weights: DataFrame | Draws, row_id: str = "row_id"
) -> DataFrame:
    """Weighted cells per (b, series, distinct score), best first, with the counts before them.

    Weights are packed draws, or a caller's own ``b, row_id, w``, which are joined to the rows.
    """
    if isinstance(weights, Draws):
        return cell_table(drawn_cells(df, probs, label, weights), dict(df.dtypes))
    points = split_points(df, probs)
    coded = with_order_codes(df.select(row_id, *probs, F.col(label).cast("bigint").alias("y")), probs, points)
    entries = [
        F.struct(F.lit(c).alias("series"), F.col(c).alias("value"), F.col(f"__code_{c}").alias("bucket"))
        for c in probs
    ]
    cells = (
        coded.join(weights, row_id)
        .select("b", "w", "y", F.inline(F.array(*entries)))
        .groupBy("b", "series", "bucket", "value")
        .agg(F.sum("w").alias("n"), F.sum(F.col("w") * F.col("y")).alias("pos"))
    )
    return add_prefix_sums(cells, ["b", "series"], [F.desc("value")], ["n", "pos"], descending_buckets=True)


def replicate_metrics(cells: DataFrame, cut: float = 0.5) -> DataFrame:
    """``b, series`` and the five metrics; replicates with a single class drop out."""
    pos, neg = F.col("pos").cast("double"), (F.col("n") - F.col("pos")).cast("double")
    tp = F.col("pos_before") + F.col("pos")
    flagged = F.col("value") > cut
    sums = cells.groupBy("b", "series").agg(
        F.sum(pos).alias("p"),
        F.sum(neg).alias("q"),
        F.sum(neg * (F.col("pos_before") + pos / 2.0)).alias("won"),
        F.sum(pos * tp / (F.col("n_before") + F.col("n"))).alias("ap"),
        F.sum(F.when(flagged, pos).otherwise(0.0)).alias("tp"),
        F.sum(F.when(flagged, neg).otherwise(0.0)).alias("fp"),
    )
    return _metrics_from_sums(sums)


def _metrics_from_sums(sums: DataFrame) -> DataFrame:
    valid = sums.where((F.col("p") > 0) & (F.col("q") > 0))
    rated = valid.select(
        "b", "series",
        (F.col("won") / (F.col("p") * F.col("q"))).alias("auc_roc"),
        (F.col("ap") / F.col("p")).alias("avg_precision"),
        safe_div(F.col("tp"), F.col("tp") + F.col("fp")).alias("precision"),
        safe_div(F.col("tp"), F.col("p")).alias("recall"),
    )
    return rated.withColumn("f1", f1_of(F.col("precision"), F.col("recall")))


# ---- Poisson weights ---------------------------------------------------------------------------


def poisson_replicate_metrics(
    df: DataFrame,
    probs: list[str],
    label: str,
    replicates: int,
    *,
    row_id: str = "row_id",
    cut: float = 0.5,
) -> DataFrame:
    """``b, series`` and the five metrics under Poisson weights; no row is shuffled, only packed cells."""
    cells = weight_cells.weight_cells(df, probs, label, replicates, row_id=row_id)
    return _metrics_from_sums(weight_cells.replicate_sums(cells, cut))


# ---- intervals ---------------------------------------------------------------------------------


def confidence_intervals(replicate_table: DataFrame, metrics: tuple[str, ...] = METRICS) -> DataFrame:
    """Long ``series, metric, mean, ci_low, ci_high, n_valid`` over the replicates."""
    entries = [F.struct(F.lit(m).alias("metric"), F.col(m).alias("v")) for m in metrics]
    return (
        replicate_table.select("series", F.inline(F.array(*entries)))
        .groupBy("series", "metric")
        .agg(
            F.avg("v").alias("mean"),
            F.percentile("v", TAILS[0]).alias("ci_low"),
            F.percentile("v", TAILS[1]).alias("ci_high"),
            F.count("v").alias("n_valid"),
        )
    )


def with_fallback(intervals: DataFrame, plain: DataFrame) -> DataFrame:
    """Where no replicate was valid: the plain metric with the interval [0, 1]."""
    joined = plain.select("series", "metric", F.col("value").alias("plain")).join(
        intervals, ["series", "metric"], "left"
    )
    return joined.select(
        "series", "metric",
        F.coalesce("mean", "plain").alias("mean"),
        F.coalesce("ci_low", F.lit(0.0)).alias("ci_low"),
        F.coalesce("ci_high", F.lit(1.0)).alias("ci_high"),
        F.coalesce("n_valid", F.lit(0)).alias("n_valid"),
    )


def auc_difference(replicate_table: DataFrame, first: str, second: str, replicates: int) -> DataFrame:
    """One row: mean difference of AUC (first minus second), interval, p-value, significance."""
    auc_of = lambda name: F.max(F.when(F.col("series") == name, F.col("auc_roc")))
    paired = replicate_table.groupBy("b").agg((auc_of(first) - auc_of(second)).alias("d"))
    d = F.col("d")
    share = lambda hit: F.avg(hit.cast("double"))
    return paired.where(d.isNotNull()).agg(
        F.count(F.lit(1)).alias("n_valid"),
        F.avg(d).alias("delta_auc_mean"),
        F.percentile(d, TAILS[0]).alias("ci_low"),
        F.percentile(d, TAILS[1]).alias("ci_high"),
        F.coalesce(
            F.greatest(F.least(F.least(share(d <= 0), share(d >= 0)) * 2.0, F.lit(1.0)), F.lit(1.0 / replicates)),
            F.lit(1.0),
        ).alias("p_value"),
    ).withColumn(
        "significant", F.coalesce((F.col("ci_low") > 0) | (F.col("ci_high") < 0), F.lit(False))
    )


def custom_metric(cells: DataFrame, terms: Mapping[str, Column], result: Column) -> DataFrame:
    """``b, series, value`` of a caller's own metric of each resample.

    ``terms`` are expressions over a score cell (``value``, ``n``, ``pos`` and what ranks before:
    ``n_before``, ``pos_before``, ``n_total``, ``pos_total``); they are summed over the cells of a
    replicate, and ``result`` combines the sums. So a replicate is never gathered.
    """
    sums = cells.groupBy("b", "series").agg(*[F.sum(term).alias(name) for name, term in terms.items()])
    return sums.select("b", "series", result.alias("value"))


def brier_scores(cells: DataFrame) -> DataFrame:
    """Mean squared distance of score and label in each resample: a custom metric of score cells."""
    v, n, pos = F.col("value"), F.col("n"), F.col("pos")
    terms = {"error": pos * (1 - v) * (1 - v) + (n - pos) * v * v, "rows": n}
    return custom_metric(cells, terms, F.col("error") / F.col("rows"))


# ---- curve bands -------------------------------------------------------------------------------


def _with_totals(cells: DataFrame) -> DataFrame:
    named = cells.withColumns(
        {"all_pos": F.col("pos_total"), "all_neg": F.col("n_total") - F.col("pos_total"), "all_n": F.col("n_total")}
    )
    return named.where((F.col("all_pos") > 0) & (F.col("all_neg") > 0))


def _grid_between(low: Column, high: Column, scale: Column, steps: int) -> Column:
    """Grid numbers i with low/scale <= i/steps < high/scale, in whole numbers."""
    first = F.ceil(low * steps / scale)
    last = F.ceil(high * steps / scale) - 1
    return F.when(last >= first, F.sequence(first, last)).otherwise(F.array().cast("array<bigint>"))


def roc_curves(cells: DataFrame, points: int = CURVE_GRID) -> DataFrame:
    """``b, series, grid, tpr`` of each replicate on an even false-positive grid.

    A cell with negatives is the segment from the counts before it to the counts after it and
    answers for the grid points it spans, so no replicate's curve is gathered.
    """
    steps = points - 1
    neg = (F.col("n") - F.col("pos")).cast("double")
    fp_before = (F.col("n_before") - F.col("pos_before")).cast("double")
    spans = _with_totals(cells).where(neg > 0)
    inside = spans.select(
        "b", "series", "all_pos", "all_neg", "pos", "pos_before",
        neg.alias("neg"), fp_before.alias("fp_before"),
        F.explode(_grid_between(fp_before, fp_before + neg, F.col("all_neg"), steps)).alias("grid"),
    )
    along = (F.col("grid") * F.col("all_neg") / F.lit(float(steps)) - F.col("fp_before")) / F.col("neg")
    curve = inside.select(
        "b", "series", "grid", ((F.col("pos_before") + F.col("pos") * along) / F.col("all_pos")).alias("tpr")
    )
    end = spans.select("b", "series").distinct().select(
        "b", "series", F.lit(steps).cast("bigint").alias("grid"), F.lit(1.0).alias("tpr")
    )
    return curve.unionByName(end)


def pr_curves(cells: DataFrame, points: int = CURVE_GRID) -> DataFrame:
    """``b, series, grid, precision`` of each replicate on an even recall grid.

    Points are the cells where recall grows, behind the point (0, 1). The previous point of a
    cell is the one before it in its bucket, or the last one of an earlier bucket; so the windows
    stay inside buckets or run over one row per bucket.
    """
    steps = points - 1
    keys = ["b", "series"]
    tp = (F.col("pos_before") + F.col("pos")).cast("double")
    grown = _with_totals(cells).where(F.col("pos") > 0).withColumns(
        {"tp": tp, "precision_here": tp / (F.col("n_before") + F.col("n"))}
    )
    earlier = Window.partitionBy(*keys).orderBy(F.desc("bucket"))
    ends = grown.groupBy(*keys, "bucket").agg(F.min_by("precision_here", "value").alias("end"))
    carried = ends.select(*keys, "bucket", F.coalesce(F.lag("end").over(earlier), F.lit(1.0)).alias("carried"))
    inside = Window.partitionBy(*keys, "bucket").orderBy(F.desc("value"))
    linked = grown.join(carried, [*keys, "bucket"]).withColumn(
        "precision_before", F.coalesce(F.lag("precision_here").over(inside), F.col("carried"))
    )
    spans = linked.withColumn("grid", _grid_between(F.col("pos_before"), F.col("tp"), F.col("all_pos"), steps))
    last = F.when(F.col("tp") == F.col("all_pos"), F.array(F.lit(steps).cast("bigint"))).otherwise(
        F.array().cast("array<bigint>")
    )
    hits = spans.withColumn("grid", F.explode(F.concat("grid", last)))
    along = (F.col("grid") * F.col("all_pos") / F.lit(float(steps)) - F.col("pos_before")) / F.col("pos")
    value = F.col("precision_before") + (F.col("precision_here") - F.col("precision_before")) * along
    return hits.select(*keys, "grid", value.alias("precision"))


def gain_curves(cells: DataFrame, points: int = GAIN_GRID) -> DataFrame:
    """``b, series, grid, captured`` percent at even positions of each resample.

    Equal scores share their positives evenly, as their order is arbitrary.
    """
    spans = _with_totals(cells).where(F.col("n") > 0)
    step = F.greatest(F.floor(F.col("all_n") / points), F.lit(1))
    first = F.ceil(F.col("n_before") / step)
    last = F.ceil((F.col("n_before") + F.col("n")) / step) - 1
    grid = F.when(last >= first, F.sequence(first, last)).otherwise(F.array().cast("array<bigint>"))
    hits = spans.select("*", step.alias("step"), F.explode(grid).alias("grid"))
    place = F.col("grid") * F.col("step") + 1 - F.col("n_before")
    captured = (F.col("pos_before") + F.col("pos") * place / F.col("n")) / F.col("all_pos") * 100.0
    return hits.select("b", "series", "grid", captured.alias("captured"))


def curve_band(curves: DataFrame, value: str) -> DataFrame:
    """Point-wise interval over the replicates; a grid point with fewer than ten has none."""
    return (
        curves.groupBy("series", "grid")
        .agg(
            F.count(F.lit(1)).alias("n_curves"),
            F.percentile(value, TAILS[0]).alias("ci_low"),
            F.percentile(value, TAILS[1]).alias("ci_high"),
        )
        .where(F.col("n_curves") >= MIN_CURVES)
    )

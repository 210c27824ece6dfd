import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from tenura.operators import comparison, metrics, resampling, segments, weight_cells
from tenura.operators.weight_cells import poisson_weights


@pytest.fixture(scope="module")
def scored(spark):
    """Ties, a hot score of one third, exact bin edges."""
    p = F.when(F.col("id") % 3 == 0, 0.4).otherwise((F.col("id") * 7919 % 101) / 100.0)
    y = ((F.col("id") * 31 % 10) / 10.0 < p).cast("int")
    return spark.range(1200).select(F.col("id").alias("row_id"), p.alias("prob"), (1 - p).alias("anti"), y.alias("label")).cache()


def brute_auc(y, p):
    pos, neg = p[y == 1], p[y == 0]
    return ((pos[:, None] > neg[None, :]).sum() + 0.5 * (pos[:, None] == neg[None, :]).sum()) / (len(pos) * len(neg))


def test_auc_and_symmetry(scored):
    pdf = scored.toPandas()
    got = {r["series"]: r["auc"] for r in metrics.auc(metrics.curve_cells(scored, ["prob", "anti"], "label")).collect()}
    assert math.isclose(got["prob"], brute_auc(pdf.label.to_numpy(), pdf.prob.to_numpy()), rel_tol=1e-12)
    assert math.isclose(got["prob"] + got["anti"], 1.0)
    squashed = scored.withColumn("prob", F.exp("prob"))
    again = metrics.auc(metrics.curve_cells(squashed, ["prob"], "label")).first()["auc"]
    assert math.isclose(again, got["prob"])


def test_average_precision(scored):
    pdf = scored.toPandas()
    total, got = pdf.label.sum(), 0.0
    last = 0
    for t in sorted(pdf.prob.unique(), reverse=True):
        hit = pdf[pdf.prob >= t]
        got += (hit.label.sum() - last) / total * hit.label.mean()
        last = hit.label.sum()
    assert math.isclose(metrics.average_precision(metrics.curve_cells(scored, ["prob"], "label")).first()[1], got)


def test_sweep_against_brute_force(scored):
    pdf = scored.toPandas()
    sweep = {r["threshold"]: r for r in metrics.threshold_sweep(scored, ["prob"], "label").collect()}
    assert sorted(sweep) == list(metrics.SWEEP_GRID) and np.array_equal(sorted(sweep), np.linspace(0, 1, 200))
    recalls = [sweep[t]["recall"] for t in sorted(sweep)]
    assert recalls == sorted(recalls, reverse=True)
    for t in (0.0, metrics.SWEEP_GRID[80], 1.0):
        hit = pdf[pdf.prob >= t]
        assert math.isclose(sweep[t]["recall"], hit.label.sum() / pdf.label.sum())
        assert math.isclose(sweep[t]["precision"], hit.label.mean() if len(hit) else 0.0)


def test_thresholds_ties_and_fallback(spark):
    df = spark.createDataFrame([(0.9, 0), (0.8, 0), (0.2, 1)], "p double, label int")
    r = metrics.best_thresholds(metrics.threshold_sweep(df, ["p"], "label")).first()
    assert r["business_threshold"] == 0.5 and r["business_recall"] == 0.0
    good = spark.createDataFrame([(0.9, 1), (0.1, 0)], "p double, label int")
    r = metrics.best_thresholds(metrics.threshold_sweep(good, ["p"], "label")).first()
    assert r["best_f1_threshold"] == r["business_threshold"] == next(t for t in metrics.SWEEP_GRID if t > 0.1)


def test_exactly_half(spark):
    df = spark.createDataFrame([(0.5, 1)], "p double, label int")
    got = df.select(metrics.model_prediction("p"), metrics.threshold_predictions("p", {"x": 0.5})["prediction_x"]).first()
    assert tuple(got) == (0, 1)


def test_calibration_edges(spark):
    edges = [0.1, 0.2, 0.3, 0.4, 0.5, 0.6, 0.7, 0.8, 0.9]
    df = spark.createDataFrame([(p, 0) for p in edges], "p double, label int")
    right = sorted(r["bin"] for r in metrics.calibration_bins(df, ["p"], "label").collect())
    left = sorted(r["bin"] for r in metrics.calibration_bins(df, ["p"], "label", right_closed=False).collect())
    inner = np.linspace(0, 1, 11)[1:-1]
    assert right == sorted(set(np.searchsorted(inner, edges, side="left")))
    assert left == sorted(set(np.searchsorted(inner, edges, side="right")))


def test_segments_small_and_whole(spark, scored):
    few = spark.createDataFrame([(i, 0.1 * i, i % 2) for i in range(5)], "row_id bigint, prob double, label int")
    got = {r["percent"]: r for r in segments.segments(segments.ranked_scores(few)).collect()}
    assert got[10]["n_customers"] == 0 and got[10]["churn_rate_pct"] is None and got[20]["n_customers"] == 1
    ranked = segments.ranked_scores(scored)
    curve = [tuple(r) for r in segments.gain_curve(ranked).collect()]
    curve.sort()
    assert len(curve) == 200 and all(a[1] <= b[1] for a, b in zip(curve, curve[1:]))
    reach = {r["contact_pct"]: r for r in segments.campaign_reach(ranked).collect()}
    assert len(reach) == 50 and reach[20]["contacted"] == 240
    assert math.isclose(reach[20]["lift"], reach[20]["capture_pct"] / 20)
    assert sum(r["label_upto"] == r["label_upto"] for r in ranked.collect()) == 1200


def test_mcnemar_without_discordance(spark):
    df = spark.createDataFrame([(1, 0.9), (0, 0.1)], "label int, p double")
    r = comparison.mcnemar(df, "label", {"t": (F.col("p") > 0.5, F.col("p") > 0.5)}).first()
    assert (r["chi2"], r["p_value"], r["significant"]) == (0.0, 1.0, False)


def test_mismatched_rows_raise(spark):
    a = spark.createDataFrame([(1, 0, 0.1), (2, 1, 0.2)], "row_id int, label int, prob double")
    b = spark.createDataFrame([(1, 0, 0.1), (3, 1, 0.2)], "row_id int, label int, prob double")
    with pytest.raises(comparison.MismatchedTestRows):
        comparison.require_aligned(comparison.align_models(a, b))


@pytest.mark.parametrize(
    "significant,recall,auc,winner",
    [(False, 0.04, 0.1, comparison.COMPLEX), (False, 0.03, 0.1, comparison.SIMPLE),
     (True, 0.0, 0.0, comparison.COMPLEX), (True, 0.9, -0.1, comparison.SIMPLE)],
)
def test_decision_table(spark, significant, recall, auc, winner):
    row = (0.7 + auc, 0.7, recall, 0.0, 0.01, -0.1, 0.2, significant)
    df = spark.createDataFrame([row], "auc_complex double, auc_simple double, recall_complex double, recall_simple double, p_value double, ci_low double, ci_high double, significant boolean")
    got = comparison.choose_model(df).first()
    assert got["winner"] == got["selected_model"] == winner and got["reason"] == got["selection_reason"]


def test_spearman_p_value(spark):
    # Student-t tails from published tables: two-sided p = 0.05, first with 1, 2, 3, 9, 10 and 60 degrees of freedom.
    tails = {1: 12.706, 2: 4.303, 3: 3.182, 9: 2.262, 10: 2.228, 60: 2.000}
    rows = [(t / math.sqrt(df + t**2), df + 2, 0.05) for df, t in tails.items()]
    rows += [(0.0, 12, 1.0), (1.0, 12, 0.0), (-1.0, 5, 0.0), (0.5, 2, None), (0.5, 0, None), (None, 9, None), (0.5, 3, 2 / 3)]
    got = spark.createDataFrame(rows, "rho double, n long, want double").select(comparison.spearman_p_value(F.col("rho"), F.col("n")).alias("p"), "want")
    for r in got.collect():
        assert r["p"] is r["want"] is None or r["p"] == pytest.approx(r["want"], abs=1e-4)


def test_poisson_weights_look_poisson():
    ids = np.arange(200_000)
    w = np.stack([poisson_weights(ids, b) for b in range(6)]).astype(float)
    assert np.allclose(w.mean(axis=1), 1.0, atol=0.01) and np.allclose(w.var(axis=1), 1.0, atol=0.02)
    off = np.corrcoef(w) - np.eye(6)
    assert abs(off).max() < 0.01
    assert abs(np.corrcoef(w[0][:-1], w[0][1:])[0, 1]) < 0.01
    # Row ids one modulus apart must not share their weights.
    assert abs(np.corrcoef(w[0], poisson_weights(ids + weight_cells.MODULUS, 0))[0, 1]) < 0.01


def test_poisson_replicates_brute_force(scored):
    pdf = scored.toPandas()
    got = resampling.poisson_replicate_metrics(scored, ["prob"], "label", 4).orderBy("b").collect()
    for r in got:
        again = pdf.loc[pdf.index.repeat(poisson_weights(pdf.row_id.to_numpy(), r["b"]))]
        assert math.isclose(r["auc_roc"], brute_auc(again.label.to_numpy(), again.prob.to_numpy()), rel_tol=1e-9)
        hit = again[again.prob > 0.5]
        assert math.isclose(r["precision"], hit.label.mean()) and math.isclose(r["recall"], hit.label.sum() / again.label.sum())
        ap, last = 0.0, 0
        for t in sorted(again.prob.unique(), reverse=True):
            top = again[again.prob >= t]
            ap += (top.label.sum() - last) / again.label.sum() * top.label.mean()
            last = top.label.sum()
        assert math.isclose(r["avg_precision"], ap, rel_tol=1e-9)


def test_multinomial_draws_n_rows(scored):
    weights = resampling.multinomial_weights(scored, 3)
    assert {r["s"] for r in weights.groupBy("b").agg(F.sum("w").alias("s")).collect()} == {1200}
    cells = resampling.replicate_cells(scored, ["prob"], "label", weights)
    own = resampling.custom_metric(cells, {"pos": F.col("pos"), "n": F.col("n")}, F.col("pos") / F.col("n"))
    rates = {r["b"]: r["x"] for r in cells.groupBy("b").agg((F.sum("pos") / F.sum("n")).alias("x")).collect()}
    assert {r["b"]: pytest.approx(r["value"]) for r in own.collect()} == rates


def test_one_class_replicates_and_fallback(spark):
    df = spark.createDataFrame([(i, 0.1 * i, 1) for i in range(6)], "row_id bigint, prob double, label int")
    reps = resampling.poisson_replicate_metrics(df, ["prob"], "label", 3)
    assert reps.count() == 0
    plain = spark.createDataFrame([("prob", "auc_roc", 0.5)], "series string, metric string, value double")
    got = resampling.with_fallback(resampling.confidence_intervals(reps), plain).first()
    assert (got["mean"], got["ci_low"], got["ci_high"]) == (0.5, 0.0, 1.0)
    diff = resampling.auc_difference(reps, "prob", "prob", 3).first()
    assert diff["p_value"] == 1.0 and diff["significant"] is False


def test_roc_curve_interpolation(scored):
    weights = scored.select(F.lit(0).alias("b"), "row_id", F.lit(1).cast("bigint").alias("w"))
    curve = resampling.roc_curves(resampling.replicate_cells(scored, ["prob"], "label", weights)).orderBy("grid").collect()
    pdf = scored.toPandas()
    fpr, tpr = [0.0], [0.0]
    for t in sorted(pdf.prob.unique(), reverse=True):
        top = pdf[pdf.prob >= t]
        fpr.append((top.label == 0).sum() / (pdf.label == 0).sum())
        tpr.append(top.label.sum() / pdf.label.sum())
    assert len(curve) == 100
    assert np.allclose([r["tpr"] for r in curve], np.interp(np.arange(100) / 99, fpr, tpr), atol=1e-9)
    gain = resampling.gain_curves(resampling.replicate_cells(scored, ["prob"], "label", weights)).toPandas()
    assert len(gain) == 200 and gain.sort_values("grid").captured.is_monotonic_increasing


def test_pr_curve_interpolation(scored):
    weights = scored.select(F.lit(0).alias("b"), "row_id", F.lit(1).cast("bigint").alias("w"))
    cells = resampling.replicate_cells(scored, ["prob"], "label", weights)
    curve = resampling.pr_curves(cells).orderBy("grid").collect()
    pdf = scored.toPandas()
    recall, precision = [0.0], [1.0]
    for t in sorted(pdf.prob.unique(), reverse=True):
        top = pdf[pdf.prob >= t]
        r = top.label.sum() / pdf.label.sum()
        if r > recall[-1]:
            recall.append(r)
            precision.append(top.label.mean())
    assert len(curve) == 100
    assert np.allclose([r["precision"] for r in curve], np.interp(np.arange(100) / 99, recall, precision), atol=1e-9)


def _resampled(pdf, b, column="prob"):
    return pdf.loc[pdf.index.repeat(poisson_weights(pdf.row_id.to_numpy(), b))].sort_values(column, ascending=False, kind="stable")


def test_weights_equal_their_definition():
    """The same numbers by plain whole-number arithmetic."""
    from tenura.functions.expressions import POISSON_ONE_CDF

    def plain(i, b):
        m = weight_cells.MODULUS
        x = pow((i % m) * weight_cells.ROW_STEP + (b + 1) * weight_cells.REPLICATE_STEP + weight_cells.WEIGHT_SEED, 5, m)
        x = pow(x + (i // m) * weight_cells.HIGH_STEP + (b + 1) * weight_cells.SECOND_STEP, 5, m)
        return sum(x / m >= c for c in POISSON_ONE_CDF)

    ids = np.array([0, 1, 2, 77, 2**31 - 2, 2**31 - 1, 2**31, 2**45 + 3, 2**62, *range(1000, 1400)])
    for b in (0, 1, 299):
        assert poisson_weights(ids, b).tolist() == [plain(int(i), b) for i in ids]


@pytest.mark.parametrize("few", [20, 100_000])
def test_poisson_curves_brute_force(spark, scored, few, monkeypatch):
    """Curves of each replicate against drawn samples, with cells as vectors and as row ids, in one strip and in many."""
    monkeypatch.setattr(weight_cells, "STRIP_NUMBERS", few)
    pdf = scored.toPandas()
    cells = weight_cells.weight_cells(scored, ["prob", "anti"], "label", 12)
    kinds = {r["kind"] for r in cells.records.select("kind").distinct().collect()}
    assert {weight_cells.VECTORS, weight_cells.SUMS} <= kinds
    grid = np.linspace(0, 1, 11)
    roc, pr, gain = ({(r["series"], r["b"], r["grid"]): r[2] for r in df.select("series", "grid", v, "b").collect()} for df, v in (
        (weight_cells.roc_curves(cells, 11), "tpr"), (weight_cells.pr_curves(cells, 11), "precision"), (weight_cells.gain_curves(cells, 10), "captured")))
    for name in ("prob", "anti"):
        for b in range(12):
            drawn = _resampled(pdf, b, name)
            y, v = drawn.label.to_numpy(), drawn[name].to_numpy()
            ends = np.append(np.flatnonzero(v[1:] != v[:-1]), len(v) - 1)
            tp, fp = np.cumsum(y)[ends], np.cumsum(1 - y)[ends]
            fpr, tpr = np.append(0, fp) / fp[-1], np.append(0, tp) / tp[-1]
            for k, x in enumerate(grid[:-1]):
                at = np.searchsorted(fpr, x, "right") - 1
                want = tpr[at] + (tpr[at + 1] - tpr[at]) * (x - fpr[at]) / (fpr[at + 1] - fpr[at])
                assert roc[name, b, k] == pytest.approx(want)
            assert roc[name, b, 10] == 1.0
            grown = np.flatnonzero(np.diff(np.append(0, tp)) > 0)
            recall, precision = np.append(0, tp[grown] / tp[-1]), np.append(1, tp[grown] / (tp + fp)[grown])
            for k, x in enumerate(grid):
                assert pr[name, b, k] == pytest.approx(np.interp(x, recall, precision), abs=1e-6), (name, b, k)
            step = max(len(y) // 10, 1)
            share = np.concatenate([np.zeros(0), *[np.full(n, c / n) for n, c in zip(np.diff(np.append(-1, ends)), np.diff(np.append(0, tp)))]])
            for k in range(0, -(-len(y) // step)):
                assert gain[name, b, k] == pytest.approx(share[: k * step + 1].sum() / tp[-1] * 100)


def test_poisson_cells_shuffle_no_rows(spark, scored):
    """Nothing but packed records and sums of replicates crosses an exchange, and no row reaches pandas."""
    cells = weight_cells.weight_cells(scored, ["prob"], "label", 5)
    plan = weight_cells.replicate_sums(cells)._jdf.queryExecution().executedPlan().toString()
    assert "InPandas" not in plan and "row_id" not in plan
    made = cells.records
    assert made.columns == ["series", "bucket", "kind", "size", "data"]
    # one record for each bucket and kind: a third of all rows share one score
    assert made.count() < 400


def test_cells_of_odd_scores(spark):
    """Null and NaN scores drop out; minus zero and zero are one score; infinite scores rank first and last."""
    rows = [(i, s, i % 2) for i, s in enumerate([None, float("nan"), 0.0, -0.0, float("inf"), float("-inf"), 0.5, 0.5])]
    df = spark.createDataFrame(rows, "row_id long, prob double, label int")
    got = weight_cells.replicate_sums(weight_cells.weight_cells(df, ["prob"], "label", 40)).collect()
    for r in got:
        w = {i: int(poisson_weights(np.array([i]), r["b"])[0]) for i in range(2, 8)}
        assert (r["p"], r["q"]) == (w[3] + w[5] + w[7], w[2] + w[4] + w[6])
        won = sum(w[i] * w[j] * ((rows[i][1] > rows[j][1]) + (rows[i][1] == rows[j][1]) / 2) for i in (3, 5, 7) for j in (2, 4, 6))
        assert r["won"] == pytest.approx(won)
    assert len(got) == 40
    assert weight_cells.replicate_sums(weight_cells.weight_cells(df.where("false"), ["prob"], "label", 3)).count() == 0

"""The registered queries: each runs one operator over whole tables of the given folder."""

from __future__ import annotations

import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, functions as F

from tenura.operators import (
    attribution,
    category_bins,
    cleaning,
    comparison,
    correlation,
    encoding,
    features,
    identity,
    metrics,
    models,
    persistence,
    profiling,
    ranking,
    resampling,
    segments,
    splitting,
    weight_cells,
)
from tenura.functions.expressions import clean_category, decimal_comma
from tenura.plans import reports, tables
from tenura.roles import FLAG_SUFFIX, Roles
from tenura.session import shared_folder, shared_table
from tenura.sources import readers, writers

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}

PROBS = ["prob_lr", "prob_gbm"]
CATEGORIES = ["area", "nation", "segment"]
THRESHOLDS = {"0_5": 0.5, "best_f1": 0.45, "business": 0.55}
COEFFICIENTS = {"acctbal": 0.0001, "avg12": -0.000004, "n_orders": -0.08, "returned": 0.03, "idle_days": 0.002}
AREA_TO_STATE = {"AMERICA": "W", "EUROPE": "W", "ASIA": "E", "MIDDLE EAST": "E"}


def query(fn: Query) -> Query:
    QUERIES[fn.__name__] = fn
    return fn


def rounded(df: DataFrame, digits: int = 6) -> DataFrame:
    """Doubles to six digits, so that summation order does not show in a comparison."""
    return df.select(*[F.round(c, digits).alias(c) if t == "double" else F.col(c) for c, t in df.dtypes])


def base_of(spark: SparkSession, sf: str) -> DataFrame:
    """The customer table, kept for queries that pass over it several times."""
    return tables.customer_base(spark, sf).persist()


# ---- regional rates ----------------------------------------------------------------------------


@query
def churn_by_area(spark, sf):
    return rounded(profiling.churn_by_area(tables.customer_base(spark, sf), "area", "label"))


@query
def churn_by_state(spark, sf):
    areas = profiling.churn_by_area(tables.customer_base(spark, sf), "area", "label")
    return rounded(segments.churn_by_state(areas, AREA_TO_STATE))


@query
def churn_state_rollup(spark, sf):
    areas = profiling.churn_by_area(tables.customer_base(spark, sf), "area", "label")
    return rounded(segments.state_rollup(segments.churn_by_state(areas, AREA_TO_STATE)))


# ---- cleaning and features ---------------------------------------------------------------------


@query
def decimal_comma_parse(spark, sf):
    raw = tables.customer_raw_text(spark, sf)
    return raw.select("row_id", decimal_comma(F.col("acctbal")).alias("acctbal"), decimal_comma(F.col("n_orders")).alias("n_orders"))


@query
def parse_quality(spark, sf):
    return rounded(cleaning.parse_quality(tables.customer_raw_text(spark, sf), ["acctbal", "n_orders"]))


@query
def domain_rules(spark, sf):
    ruled = cleaning.apply_domain_rules(tables.customer_base(spark, sf), **tables.BASE_RULES)
    return rounded(ruled.select("row_id", "acctbal", "n_orders", "placed", "avg12"))


@query
def typed_lines(spark, sf):
    """Order lines without identifiers, a binary category as text, and the target as a label."""
    lines = tables.read(spark, sf, "lineitem").select(
        F.col("l_partkey").alias("Customer_ID"), F.col("l_orderkey").alias("row_id"), "l_linenumber",
        F.when(F.col("l_linestatus") == "F", 1).when(F.col("l_returnflag") != "R", 0).alias("truck"),
        (F.col("l_returnflag") == "R").cast("string").alias("churn"),
    )
    typed = cleaning.categories_as_text(cleaning.drop_identifiers(lines, Roles()), ["truck"])
    return cleaning.with_label(typed.withColumn("churn", F.col("churn").cast("boolean")), "churn")


@query
def class_values(spark, sf):
    return rounded(cleaning.class_values(tables.customer_base(spark, sf), "avg12", "label", 1))


@query
def undeclared_text(spark, sf):
    """Text columns of the parts that the catalogue does not name, with their number of values."""
    parts = tables.read(spark, sf, "part")
    return profiling.cardinality(parts, tables.BASE_ROLES.undeclared_text(parts)).select("feature", "n_values")


@query
def rule_violations(spark, sf):
    base = tables.customer_base(spark, sf)
    return cleaning.rule_violations(base, cleaning.domain_predicates(base, **tables.BASE_RULES))


@query
def missing_report(spark, sf):
    counts = cleaning.missing_counts(tables.customer_base(spark, sf), tables.BASE_NUMERIC)
    pct = F.round(F.col("missing_rate") * 100, 6)
    return counts.where(F.col("n_missing") > 0).select("column", "n_rows", "n_missing", pct.alias("missing_pct"))


@query
def was_missing_flags(spark, sf):
    base = base_of(spark, sf)
    rates = cleaning.missing_rates(base, tables.BASE_NUMERIC)
    flagged = cleaning.flagged_columns(rates)
    flags = cleaning.add_missing_flags(base, flagged)
    entries = [F.struct(F.lit(c).alias("column"), F.col(c + FLAG_SUFFIX).alias("was_missing")) for c in flagged]
    return flags.select("row_id", F.inline(F.array(*entries)))


@query
def usage_features(spark, sf):
    built, _ = features.usage_features(tables.customer_base(spark, sf), tables.USAGE)
    return rounded(built.select("row_id", "usage_delta", "drop_rate", "old_phone"))


@query
def category_normalise(spark, sf):
    raw, segment = tables.customer_raw_text(spark, sf), F.col("segment")
    return raw.select(
        "row_id",
        clean_category(segment).alias("kept_null"),
        clean_category(segment, "NAN").alias("null_as_category"),
        F.coalesce(segment, F.lit("MISSING")).alias("filled"),
    )


@query
def retention_flags(spark, sf):
    base = base_of(spark, sf)
    built, _ = features.usage_features(base, tables.USAGE)
    risk = ranking.rank_rows(attribution.linear_scores(base, COEFFICIENTS), "prob", "row_id").select("row_id", "rank")
    # written: averages, medians, the number of rows and the flags each pass over the joined table
    known = shared_table(built.join(tables.customer_history(spark, sf), "row_id", "left").join(risk, "row_id", "left"))
    return features.retention_flags(
        known, device_days="idle_days", delta="usage_delta", usage="avg12", months="months", revenue_delta="revenue_delta",
        risk_rank="rank",
    )


# ---- profile -----------------------------------------------------------------------------------


@query
def source_checks(spark, sf):
    return profiling.source_checks(tables.customer_base(spark, sf), "label")


@query
def target_distribution(spark, sf):
    return rounded(profiling.target_distribution(tables.customer_base(spark, sf), "label"))


@query
def duplicate_rows(spark, sf):
    return rounded(profiling.duplicate_rows(tables.read(spark, sf, "documents"), exclude=["doc_id"]))


@query
def cardinality(spark, sf):
    return profiling.cardinality(tables.customer_base(spark, sf), CATEGORIES)


@query
def corr_with_target(spark, sf):
    return rounded(correlation.correlation_with_target(tables.customer_base(spark, sf), tables.BASE_NUMERIC, "label"))


@query
def top_correlations(spark, sf):
    all_r = correlation.correlation_with_target(tables.customer_base(spark, sf), tables.BASE_NUMERIC, "label")
    return rounded(correlation.top_correlated(all_r, 5))


@query
def corr_matrix(spark, sf):
    return rounded(correlation.correlation_matrix(tables.labelled_lines(spark, sf), tables.LINE_MEASURES))


@query
def corr_matrix_wide(spark, sf):
    base = base_of(spark, sf)
    names = F.lit(tables.BASE_NUMERIC)
    pairs = correlation.wide_correlations(base, tables.BASE_NUMERIC)
    return rounded(
        pairs.select(F.get(names, F.col("i")).alias("a"), F.get(names, F.col("j")).alias("b"), F.col("n").cast("bigint").alias("n"), "r")
    )


@query
def outlier_share(spark, sf):
    base = tables.customer_base(spark, sf)
    return rounded(profiling.outlier_share(base, tables.BASE_NUMERIC))


@query
def class_histogram(spark, sf):
    lines = tables.labelled_lines(spark, sf)
    return rounded(profiling.class_histogram(lines, tables.LINE_MEASURES, "label"), 9)


@query
def boxplot_stats(spark, sf):
    return rounded(profiling.boxplot_stats(base_of(spark, sf), tables.BASE_NUMERIC, "label"))


@query
def mann_whitney(spark, sf):
    return rounded(profiling.mann_whitney(tables.labelled_lines(spark, sf), tables.LINE_MEASURES, "label"))


@query
def category_rates(spark, sf):
    return rounded(profiling.category_rates(tables.customer_base(spark, sf), CATEGORIES, "label"))


@query
def category_dispersion(spark, sf):
    return rounded(profiling.category_dispersion(tables.customer_base(spark, sf), CATEGORIES, "label"))


# ---- scored tables -----------------------------------------------------------------------------


@query
def risk_histogram(spark, sf):
    return profiling.risk_histogram(tables.scores(spark, sf), "prob_gbm", "label")


def _curve(spark, sf):
    return metrics.curve_cells(tables.scores(spark, sf), PROBS, "label")


@query
def roc_points(spark, sf):
    return rounded(metrics.roc_points(_curve(spark, sf)))


@query
def pr_points(spark, sf):
    return rounded(metrics.pr_points(_curve(spark, sf)))


@query
def auc(spark, sf):
    return rounded(metrics.auc(_curve(spark, sf)))


@query
def average_precision(spark, sf):
    return rounded(metrics.average_precision(_curve(spark, sf)))


def _hard(threshold: float | None = None) -> dict:
    if threshold is None:
        return {p: metrics.model_prediction(p) for p in PROBS}
    return {p: (F.col(p) >= threshold).cast("int") for p in PROBS}


@query
def confusion(spark, sf):
    matrix = metrics.confusion(tables.scores(spark, sf), _hard(), "label")
    return rounded(metrics.point_metrics(matrix))


@query
def business_interpretation(spark, sf):
    matrix = metrics.confusion(tables.scores(spark, sf), _hard(), "label")
    return reports.business_interpretation(matrix)


@query
def classification_report(spark, sf):
    matrix = metrics.confusion(tables.scores(spark, sf), _hard(), "label")
    return rounded(metrics.classification_report(matrix))


@query
def threshold_sweep(spark, sf):
    return rounded(metrics.threshold_sweep(tables.scores(spark, sf), PROBS, "label"))


@query
def best_thresholds(spark, sf):
    return rounded(metrics.best_thresholds(metrics.threshold_sweep(tables.scores(spark, sf), PROBS, "label")))


@query
def calibration_bins(spark, sf):
    return rounded(metrics.calibration_bins(tables.scores(spark, sf), PROBS, "label"))


@query
def ece(spark, sf):
    return rounded(metrics.calibration_error(tables.scores(spark, sf), PROBS, "label"))


# ---- campaign segments -------------------------------------------------------------------------


def _ranked(spark, sf):
    return segments.ranked_scores(tables.scores(spark, sf), "prob_gbm")


@query
def risk_ranking(spark, sf):
    return _ranked(spark, sf).select("row_id", "prob", "rank", "label_upto")


@query
def segment_table(spark, sf):
    return segments.segments(_ranked(spark, sf))


@query
def top_lift(spark, sf):
    return rounded(segments.top_lift(segments.segments(_ranked(spark, sf))))


@query
def gain_curve(spark, sf):
    return segments.gain_curve(_ranked(spark, sf))


@query
def campaign_reach(spark, sf):
    return rounded(segments.campaign_reach(_ranked(spark, sf)))


@query
def predictions_export(spark, sf):
    return segments.predictions_table(tables.scores(spark, sf), "prob_gbm", "label", THRESHOLDS)


@query
def top_customers(spark, sf):
    return tables.scores(spark, sf).select("row_id", "prob_gbm").orderBy(F.desc("prob_gbm"), "row_id").limit(100)


# ---- resampling and comparison -----------------------------------------------------------------


def _multinomial(spark, sf, replicates: int) -> DataFrame:
    scored = tables.scores(spark, sf)
    weights = resampling.multinomial_weights(scored, replicates, packed=True)
    return resampling.replicate_cells(scored, PROBS, "label", weights)


@query
def bootstrap_ci(spark, sf):
    replicates = resampling.replicate_metrics(_multinomial(spark, sf, resampling.METRIC_REPLICATES))
    return rounded(resampling.confidence_intervals(replicates))


@query
def bootstrap_auc_diff(spark, sf):
    replicates = resampling.replicate_metrics(_multinomial(spark, sf, resampling.DIFFERENCE_REPLICATES))
    return rounded(resampling.auc_difference(replicates, "prob_gbm", "prob_lr", resampling.DIFFERENCE_REPLICATES))


def _poisson(spark, sf, replicates: int) -> DataFrame:
    return resampling.poisson_replicate_metrics(tables.scores(spark, sf), PROBS, "label", replicates)


@query
def bootstrap_ci_poisson(spark, sf):
    return rounded(resampling.confidence_intervals(_poisson(spark, sf, resampling.METRIC_REPLICATES)))


@query
def bootstrap_auc_diff_poisson(spark, sf):
    return rounded(resampling.auc_difference(_poisson(spark, sf, resampling.DIFFERENCE_REPLICATES), "prob_gbm", "prob_lr", resampling.DIFFERENCE_REPLICATES))


@query
def roc_band(spark, sf):
    curves = resampling.roc_curves(_multinomial(spark, sf, resampling.CURVE_REPLICATES))
    return rounded(resampling.curve_band(curves, "tpr"))


@query
def pr_band(spark, sf):
    curves = resampling.pr_curves(_multinomial(spark, sf, resampling.CURVE_REPLICATES))
    return rounded(resampling.curve_band(curves, "precision"))


@query
def gain_band(spark, sf):
    curves = resampling.gain_curves(_multinomial(spark, sf, resampling.CURVE_REPLICATES))
    return rounded(resampling.curve_band(curves, "captured"))


def _poisson_cells(spark, sf) -> weight_cells.WeightCells:
    return weight_cells.weight_cells(tables.scores(spark, sf), PROBS, "label", resampling.CURVE_REPLICATES)


@query
def roc_band_poisson(spark, sf):
    curves = weight_cells.roc_curves(_poisson_cells(spark, sf), resampling.CURVE_GRID)
    return rounded(resampling.curve_band(curves, "tpr"))


@query
def pr_band_poisson(spark, sf):
    curves = weight_cells.pr_curves(_poisson_cells(spark, sf), resampling.CURVE_GRID)
    return rounded(resampling.curve_band(curves, "precision"))


@query
def gain_band_poisson(spark, sf):
    curves = weight_cells.gain_curves(_poisson_cells(spark, sf), resampling.GAIN_GRID)
    return rounded(resampling.curve_band(curves, "captured"))


@query
def bootstrap_brier(spark, sf):
    scores = resampling.brier_scores(_multinomial(spark, sf, resampling.METRIC_REPLICATES))
    return rounded(resampling.confidence_intervals(scores.withColumnRenamed("value", "brier"), ("brier",)))


@query
def mcnemar(spark, sf):
    tests = {
        "threshold_0_5": (F.col("prob_gbm") > 0.5, F.col("prob_lr") > 0.5),
        "business_threshold": (F.col("prob_gbm") >= THRESHOLDS["business"], F.col("prob_lr") >= THRESHOLDS["best_f1"]),
    }
    return rounded(comparison.mcnemar(tables.scores(spark, sf), "label", tests))


@query
def aligned_models(spark, sf):
    scored = tables.scores(spark, sf)
    first = scored.select("row_id", "label", F.col("prob_lr").alias("prob"))
    second = scored.select("row_id", "label", F.col("prob_gbm").alias("prob"))
    return comparison.require_aligned(comparison.align_models(first, second))


def _point_values(spark, sf) -> DataFrame:
    """Long ``series, metric, mean`` of the plain metrics."""
    cells = _curve(spark, sf)
    hard = metrics.point_metrics(metrics.confusion(tables.scores(spark, sf), _hard(), "label"))
    wide = metrics.auc(cells).join(metrics.average_precision(cells), "series").join(hard, "series")
    names = {"auc_roc": "auc", "avg_precision": "average_precision", "precision": "precision", "recall": "recall", "f1": "f1"}
    entries = [F.struct(F.lit(k).alias("metric"), F.col(v).alias("mean")) for k, v in names.items()]
    return wide.select("series", F.inline(F.array(*entries)))


@query
def metric_comparison(spark, sf):
    return rounded(comparison.metric_comparison(_point_values(spark, sf), "prob_lr", "prob_gbm"))


@query
def winner_counts(spark, sf):
    return comparison.winner_counts(comparison.metric_comparison(_point_values(spark, sf), "prob_lr", "prob_gbm"))


@query
def model_decision(spark, sf):
    diff = resampling.auc_difference(_poisson(spark, sf, resampling.DIFFERENCE_REPLICATES), "prob_gbm", "prob_lr", resampling.DIFFERENCE_REPLICATES)
    value = lambda s, m: F.max(F.when((F.col("series") == s) & (F.col("metric") == m), F.col("mean")))
    points = _point_values(spark, sf).agg(
        value("prob_gbm", "auc_roc").alias("auc_complex"), value("prob_lr", "auc_roc").alias("auc_simple"),
        value("prob_gbm", "recall").alias("recall_complex"), value("prob_lr", "recall").alias("recall_simple"),
    )
    tested = reports.one_row(diff)
    evidence = points.withColumn("d", tested).select(
        "auc_complex", "auc_simple", "recall_complex", "recall_simple", "d.p_value", "d.ci_low", "d.ci_high", "d.significant"
    )
    return comparison.choose_model(evidence)


# ---- splits and fitted transforms --------------------------------------------------------------


@query
def stratified_split(spark, sf):
    return splitting.stratified_split(base_of(spark, sf).select("row_id", "label"))


@query
def row_identity(spark, sf):
    docs = tables.read(spark, sf, "documents").drop("doc_id")
    return identity.with_content_id(docs).select("row_id", "lang", "source", "n_chars", F.md5("text").alias("text_md5"))


@query
def stratified_folds(spark, sf):
    return splitting.stratified_folds(base_of(spark, sf).select("row_id", "label"))


@query
def explanation_sample(spark, sf):
    return splitting.explanation_sample(tables.scores(spark, sf).select("row_id", "label"))


@query
def target_encode(spark, sf):
    base = base_of(spark, sf)
    encoded = encoding.apply_target_encoding(base, encoding.fit_target_encoding(base, CATEGORIES, "label"), CATEGORIES)
    return rounded(encoded.select("row_id", *[c + "_enc" for c in CATEGORIES]))


@query
def target_encode_crossfit(spark, sf):
    folded = splitting.stratified_folds(base_of(spark, sf).select("row_id", "label", *CATEGORIES))
    table = encoding.crossfit_encoding(folded, CATEGORIES, "label", "fold")
    encoded = encoding.apply_crossfit_encoding(folded, table, CATEGORIES, "fold")
    return rounded(encoded.select("row_id", "fold", *[c + "_enc" for c in CATEGORIES]))


SCALED = ["acctbal", "avg6", "avg12", "returned", "n_orders", "idle_days"]


@query
def median_impute(spark, sf):
    base = base_of(spark, sf)
    medians = {c: q[0.5] for c, q in encoding.fit_scaling(base, SCALED, [0.5]).items()}
    return rounded(encoding.impute(base.select("row_id", *SCALED), medians))


@query
def robust_scale(spark, sf):
    base = base_of(spark, sf)
    medians, scaling = encoding.fit_after_imputation(base, SCALED)
    return rounded(encoding.robust_scale(encoding.impute(base.select("row_id", *SCALED), medians), scaling))


@query
def multicollinear_drop(spark, sf):
    base = base_of(spark, sf).withColumn("spend", F.col("avg12") * 1.1 + F.col("acctbal") * 0.5)
    columns = [*tables.BASE_NUMERIC, "spend"]
    dropped = correlation.multicollinear_columns(base, columns, "label")
    target = correlation.correlation_with_target(base, columns, "label")
    return rounded(target.select(F.col("series").alias("column"), F.col("series").isin(*dropped).alias("dropped"), F.col("r").alias("target_r")))


# ---- explanations ------------------------------------------------------------------------------


def _contributions(spark, sf) -> tuple[DataFrame, DataFrame]:
    base = base_of(spark, sf)
    return attribution.linear_attribution(base, COEFFICIENTS), attribution.linear_scores(base, COEFFICIENTS)


@query
def linear_attribution(spark, sf):
    return rounded(_contributions(spark, sf)[0])


@query
def global_importance(spark, sf):
    # The direction of a mean-centred contribution is the sign of a zero mean, so it is left out.
    return rounded(attribution.global_importance(_contributions(spark, sf)[0]).drop("direction"))


@query
def waterfall(spark, sf):
    return rounded(attribution.waterfall(_contributions(spark, sf)[0], 7, 0.0))


@query
def driver_topk(spark, sf):
    drivers = attribution.top_drivers(*_contributions(spark, sf))
    return drivers.select("rank", "row_id", "churn_probability", F.posexplode("top_drivers").alias("place", "d")).select(
        "rank", "row_id", "churn_probability", (F.col("place") + 1).alias("place"), "d.feature", "d.shap_value", "d.direction"
    )


@query
def driver_rollup(spark, sf):
    return rounded(attribution.driver_rollup(attribution.top_drivers(*_contributions(spark, sf))))


@query
def high_risk_list(spark, sf):
    drivers = attribution.top_drivers(*_contributions(spark, sf))
    return segments.high_risk_list(drivers, min_prob=0.5, search="Idle_")


@query
def spearman_importance(spark, sf):
    base = base_of(spark, sf)
    half = lambda p: correlation.correlation_with_target(base.where(p), tables.BASE_NUMERIC, "label").select(
        F.col("series").alias("feature"), F.abs("r").alias("importance")
    )
    west = F.col("area").isin("AMERICA", "EUROPE")
    pairs = comparison.common_importances(half(west), half(~west))
    return rounded(comparison.spearman(pairs))


@query
def importance_agreement(spark, sf):
    """Do mean absolute contributions rank the inputs as their coefficients do?"""
    found = attribution.global_importance(_contributions(spark, sf)[0], k=None)
    weights = models.importance_table(spark, {c: abs(w) for c, w in COEFFICIENTS.items()}, k=None)
    return rounded(comparison.spearman(comparison.common_importances(found, weights)))


# ---- models ------------------------------------------------------------------------------------


def _model_columns(df: DataFrame) -> models.Columns:
    flags = tuple(c for c in df.columns if c.endswith(FLAG_SUFFIX))
    known = {"row_id", "label", *CATEGORIES, *flags}
    return models.Columns(tuple(c for c in df.columns if c not in known), tuple(CATEGORIES), flags)


def _parts(spark, sf) -> tuple[DataFrame, DataFrame, models.Columns]:
    prepared, _ = tables.prepared(base_of(spark, sf))
    split = shared_table(splitting.stratified_split(prepared))
    side = lambda p: split.where(F.col("part") == p).drop("part")
    return side("train"), side("test"), _model_columns(prepared)


@query
def lr_scores(spark, sf):
    train, test, columns = _parts(spark, sf)
    return models.fit_linear(train, columns).score(test)


@query
def category_rate_bins(spark, sf):
    """Bins of parts, suppliers and line statuses by their rate of returned lines."""
    lines = tables.read(spark, sf, "lineitem").withColumn("label", (F.col("l_returnflag") == "R").cast("int"))
    return category_bins.fit_category_bins(lines, ["l_partkey", "l_suppkey", "l_linestatus"], "label")


@query
def model_round_trip(spark, sf):
    """Hold-out rows, and how many a model that was written and read back scores differently."""
    train, test, columns = _parts(spark, sf)
    fitted = models.fit_linear(train, columns)
    path = f"{shared_folder(spark)}/model-{uuid.uuid4().hex}"
    writers.write_model(persistence.pipeline(fitted), path)
    again = persistence.load_model(spark, path).score(test).select("row_id", F.col("prob").alias("again"))
    both = fitted.score(test).join(again, "row_id", "full")
    differs = ~F.col("prob").eqNullSafe(F.col("again"))
    return both.agg(F.count(F.lit(1)).alias("n_rows"), F.count_if(differs).alias("n_different"))


@query
def gbt_scores(spark, sf):
    train, test, columns = _parts(spark, sf)
    return models.fit_boosted(train, columns).score(test)


@query
def cv_summary(spark, sf):
    train, _, columns = _parts(spark, sf)
    folds = models.out_of_fold(train, lambda t: models.fit_linear(t, columns), models.CV_FOLDS)
    return models.cv_summary(models.fold_metrics(folds, k=models.CV_FOLDS))


@query
def oof_thresholds(spark, sf):
    train, _, columns = _parts(spark, sf)
    return models.select_thresholds(train, lambda t: models.fit_linear(t, columns), models.CV_FOLDS, fallback=False)


@query
def search_trials(spark, sf):
    train, _, columns = _parts(spark, sf)
    return models.search_boosted(train, columns, models.search_trials(models.SEARCH_TRIALS), models.SEARCH_FOLDS)


@query
def tree_attribution(spark, sf):
    train, test, columns = _parts(spark, sf)
    fitted = models.fit_boosted(train, columns)
    trees = attribution.ensemble_nodes(spark, fitted.ensemble)
    return attribution.tree_attribution(fitted.transform(test), trees, fitted.inputs)


# ---- reports -----------------------------------------------------------------------------------


@query
def preparation_report(spark, sf):
    base = base_of(spark, sf)
    prepared, decisions = tables.prepared(base)
    report = reports.preparation_report(base, prepared, decisions, tables.BASE_ROLES, ["usage_delta", "drop_rate", "old_phone"])
    return report.select(
        "n_rows", "churn_rate", "churn_count", "no_churn_count", "duplicate_row_count",
        F.array_join("dropped_columns", ",").alias("dropped_columns"),
        F.size("was_missing_flags").alias("n_flags"), F.size("missing_value_summary").alias("n_missing_columns"),
        F.col("missing_value_summary")[0]["column"].alias("most_missing"),
    )


@query
def profile_summary(spark, sf):
    report = reports.profile_summary(base_of(spark, sf), tables.BASE_ROLES, exclude=["row_id"])
    return report.select(
        "n_rows", "churn_rate", "churn_count", "no_churn_count", "duplicate_row_count",
        F.col("top_10_corr_with_churn")[0]["series"].alias("strongest"),
        F.col("missing_pct")[0]["column"].alias("most_missing"),
        F.col("categorical_cardinality")[0]["n_values"].alias("most_values"),
    )


@query
def segmentation_report(spark, sf):
    """The segmentation report as it is read back: a row for each section, with the number of gain points."""
    ranked = _ranked(spark, sf)
    path = f"{shared_folder(spark)}/segmentation-{uuid.uuid4().hex}"
    writers.write_report(reports.segmentation_report(segments.segments(ranked), segments.gain_curve(ranked)), path)
    sections = [F.struct(F.lit(p).alias("percent"), f"top_{p}_percent.*") for p in segments.SEGMENT_PERCENTS]
    read = readers.read_segmentation(spark, path)
    return read.select(F.size("gain_curve_data").alias("gain_points"), F.inline(F.array(*sections)))


@query
def kpi_row(spark, sf):
    scored = tables.scores(spark, sf)
    one = ["prob_gbm"]
    intervals = resampling.confidence_intervals(
        resampling.poisson_replicate_metrics(scored, one, "label", resampling.METRIC_REPLICATES), ("auc_roc",)
    )
    best = metrics.best_thresholds(metrics.threshold_sweep(scored, one, "label"))
    cut = best.select("business_threshold").scalar()
    business = metrics.point_metrics(metrics.confusion(scored, {"prob_gbm": F.col("prob_gbm") >= cut}, "label"))
    return rounded(reports.kpi_row(intervals, segments.segments(_ranked(spark, sf)), best, business))

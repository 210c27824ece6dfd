"""The two end-to-end runs: prepare, train, choose, evaluate; and profile.

Each stage reads and writes tables, so it can be rerun alone; what reaches the driver is
schema decisions, fitted parameters and one-row reports.
"""

from __future__ import annotations

from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession, functions as F

from tenura.operators import attribution, cleaning, comparison, features, metrics, models, persistence, resampling, segments, splitting
from tenura.operators.identity import with_content_id
from tenura.plans import reports
from tenura.roles import FLAG_SUFFIX, Roles
from tenura.session import shared_table
from tenura.sources import readers, writers


@dataclass(frozen=True)
class Settings:
    source: str
    output: str
    roles: Roles = Roles()
    usage: features.UsageColumns = features.UsageColumns()
    boosted: models.BoostedParams = models.BoostedParams()
    trials: int = models.SEARCH_TRIALS
    folds: int = models.CV_FOLDS
    metric_replicates: int = resampling.METRIC_REPLICATES
    difference_replicates: int = resampling.DIFFERENCE_REPLICATES
    explain_rows: int | None = None  #: rows to explain; None: all, so the riskiest customers are those of the whole table
    rules: dict = field(default_factory=dict)


def with_row_id(df: DataFrame, roles: Roles) -> DataFrame:
    """Give every row an identity from its content and freeze it by writing the table.

    Equal rows get different ids, and neither the order of rows nor their files and partitions matter: the hold-out of
    a table is the same however it is stored.
    """
    return shared_table(with_content_id(df, roles.row_id))


def prepare(spark: SparkSession, s: Settings) -> DataFrame:
    """Delimited source to the prepared table plus its report."""
    roles = s.roles
    raw = with_row_id(readers.read_delimited(spark, s.source), roles)
    readers.require_valid_source(raw, roles.target)
    ids = roles.identifiers(raw)
    measures = [c for c in roles.measures(raw) if c not in ids]
    writers.write_report(cleaning.parse_quality(raw, measures), f"{s.output}/parse_quality")
    typed = cleaning.type_measures(raw, measures).withColumn(roles.target, F.col(roles.target).try_cast("int"))
    typed = cleaning.categories_as_text(typed, list(roles.binary))
    predicates = cleaning.domain_predicates(typed, **s.rules)
    writers.write_report(cleaning.rule_violations(typed, predicates), f"{s.output}/rule_violations")
    ruled = cleaning.apply_domain_rules(typed, **s.rules).drop(*ids)
    inputs = [c for c in ruled.columns if c not in (roles.row_id, roles.target)]
    rates = cleaning.missing_rates(ruled, inputs)
    sparse = cleaning.sparse_columns(rates)
    flagged = cleaning.add_missing_flags(ruled.drop(*sparse), cleaning.flagged_columns(rates))
    built, skipped = features.usage_features(flagged, s.usage)
    writers.write_prepared(built, roles, f"{s.output}/prepared", normalised=True)
    prepared, _ = readers.read_prepared(spark, f"{s.output}/prepared")
    engineered = [s.usage.delta_name, "drop_rate", "old_phone"]
    decisions = {"sparse": sparse, "identifiers": ids, "skipped": skipped, "undeclared": roles.undeclared_text(built)}
    report = reports.preparation_report(raw.drop(roles.row_id), prepared, decisions, roles, engineered)
    writers.write_report(report, f"{s.output}/preparation_report")
    return prepared


def profile(spark: SparkSession, s: Settings) -> DataFrame:
    """Profile of the typed source; the domain rules are not applied here."""
    roles = s.roles.for_profile()
    raw = with_row_id(readers.read_delimited(spark, s.source), roles)
    typed = cleaning.type_measures(cleaning.drop_identifiers(raw, roles), roles.measures(raw))
    typed = shared_table(typed.withColumn(roles.target, F.col(roles.target).try_cast("int")))
    report = reports.profile_summary(typed, roles, exclude=[roles.row_id])
    writers.write_report(report, f"{s.output}/profile_summary")
    return report


def model_columns(df: DataFrame, roles: Roles) -> models.Columns:
    categories = tuple(roles.categories(df))
    flags = tuple(c for c in df.columns if c.endswith(FLAG_SUFFIX))
    numeric = tuple(c for c in roles.numeric(df, flags=False) if c not in categories)
    return models.Columns(numeric, categories, flags, roles.row_id, roles.target)


def train_and_compare(spark: SparkSession, s: Settings, prepared: DataFrame) -> dict[str, object]:
    """Fit both models on the same split, compare them, and write scores, thresholds and the choice."""
    roles, columns = s.roles, model_columns(prepared, s.roles)
    keys = {"row_id": roles.row_id, "label": roles.target}
    split = shared_table(splitting.stratified_split(prepared, **keys))
    train = split.where(F.col("part") == "train").drop("part")
    test = split.where(F.col("part") == "test").drop("part")
    log = writers.RunLog(spark, f"{s.output}/runs", "training")
    base = s.boosted
    if s.trials:
        search = log.child("search")
        try:
            trials = models.search_boosted(
                train, columns, models.search_trials(s.trials, base=base),
                on_trial=lambda t, p, auc: search.log("metric", {f"trial_{t}_auc": auc}),
            )
            base = models.best_params(trials, base)
        except Exception as failure:  # noqa: BLE001 - the baseline settings stand in
            log.log("tag", {"search_failed": str(failure)[:200]})
    fits = {
        comparison.SIMPLE: lambda t: models.fit_linear(t, columns),
        comparison.COMPLEX: lambda t: models.fit_boosted(t, columns, base),
    }

    def one(name: str) -> tuple[object, DataFrame, DataFrame]:
        fitted = fits[name](train)
        thresholds, summary = models.validate(train, fits[name], s.folds, **keys)
        if summary is not None:
            writers.write_report(summary, f"{s.output}/cross_validation/{name}")
        writers.write_model(persistence.pipeline(fitted), f"{s.output}/models/{name}")
        weights = fitted.coefficients() if name == comparison.SIMPLE else fitted.importances()
        writers.write_report(models.importance_table(spark, weights, k=None), f"{s.output}/model_weights/{name}")
        return fitted, shared_table(thresholds), shared_table(fitted.score(test))

    with ThreadPoolExecutor(max_workers=2) as pool:
        results = dict(zip(fits, pool.map(one, fits)))
    for name, (_, thresholds, scored) in results.items():
        scored.write.mode("overwrite").parquet(f"{s.output}/scores/{name}")
        writers.write_report(thresholds, f"{s.output}/thresholds/{name}")
    decision, pair = compare(s, results)
    writers.write_report(decision, f"{s.output}/model_selection_report")
    winner = decision.first()["winner"]
    log.log("tag", {"winner": winner})
    return {"results": results, "winner": winner, "decision": decision, "pair": pair, "test": test}


def compare(s: Settings, results: dict) -> tuple[DataFrame, DataFrame]:
    """Bootstrap difference, paired tests and the decision for two scored test sets."""
    simple, complex_ = results[comparison.SIMPLE][2], results[comparison.COMPLEX][2]
    id_name = simple.columns[0]
    pair = comparison.require_aligned(comparison.align_models(simple, complex_, id_name), id_name)
    pair = shared_table(pair.select(F.col(id_name).alias("row_id"), "label", "prob_1", "prob_2"))
    replicates = shared_table(
        resampling.poisson_replicate_metrics(pair, ["prob_1", "prob_2"], "label", s.difference_replicates)
    )
    diff = resampling.auc_difference(replicates, "prob_2", "prob_1", s.difference_replicates)
    intervals = resampling.confidence_intervals(replicates)
    auc = metrics.auc(metrics.curve_cells(pair, ["prob_1", "prob_2"], "label"))
    value = lambda t, c, name: F.max(F.when(F.col("series") == name, F.col(c)))
    recall = intervals.where(F.col("metric") == "recall")
    evidence = (
        auc.agg(value(auc, "auc", "prob_2").alias("auc_complex"), value(auc, "auc", "prob_1").alias("auc_simple"))
        .withColumn("recall_complex", recall.where(F.col("series") == "prob_2").select("mean").scalar())
        .withColumn("recall_simple", recall.where(F.col("series") == "prob_1").select("mean").scalar())
        .withColumn("d", reports.one_row(diff))
        .select("auc_complex", "auc_simple", "recall_complex", "recall_simple", "d.p_value", "d.ci_low", "d.ci_high", "d.significant")
    )
    cuts = {n: results[n][1].first()["business_threshold"] for n in (comparison.SIMPLE, comparison.COMPLEX)}
    tests = comparison.mcnemar(
        pair, "label",
        {
            "threshold_0_5": (F.col("prob_2") > 0.5, F.col("prob_1") > 0.5),
            "business_threshold": (
                F.col("prob_2") >= cuts[comparison.COMPLEX], F.col("prob_1") >= cuts[comparison.SIMPLE]
            ),
        },
    )
    table = comparison.metric_comparison(intervals, "prob_1", "prob_2")
    decision = comparison.choose_model(evidence).select(
        "*",
        reports.one_row(diff).alias("bootstrap_auc_comparison"),
        reports.gathered(tests, ["test"]).alias("mcnemar_tests"),
        reports.gathered(
            table.select("metric", F.bround("first", 4).alias("first"), F.bround("second", 4).alias("second"), "winner"), ["metric"]
        ).alias("metrics_comparison"),
    )
    return shared_table(decision), pair


def evaluate(spark: SparkSession, s: Settings, trained: dict[str, object]) -> DataFrame:
    """Final report, predictions, segments and drivers of the winning model."""
    winner = trained["winner"]
    fitted, thresholds, scored = trained["results"][winner]
    id_name = scored.columns[0]
    scored = scored.withColumnRenamed(id_name, "row_id")
    cuts = thresholds.first()
    named = {"0_5": 0.5, "best_f1": cuts["best_f1_threshold"], "business": cuts["business_threshold"]}
    replicates = resampling.poisson_replicate_metrics(scored, ["prob"], "label", s.metric_replicates)
    hard = {"prob": metrics.model_prediction("prob")}
    business = {"prob": F.col("prob") >= named["business"]}
    ranked = shared_table(segments.ranked_scores(scored))
    report = reports.evaluation_report(
        scored, winner,
        intervals=shared_table(resampling.confidence_intervals(replicates)),
        calibration=metrics.calibration_error(scored, ["prob"], "label"),
        matrix=metrics.point_metrics(metrics.confusion(scored, hard, "label")),
        thresholds=thresholds,
        matrix_business=metrics.point_metrics(metrics.confusion(scored, business, "label")),
        segment_table=segments.segments(ranked),
        gain=segments.gain_curve(ranked),
    )
    writers.write_report(report, f"{s.output}/final_evaluation")
    writers.write_report(report.select("business_segmentation.*"), f"{s.output}/business_segmentation")
    writers.write_predictions(segments.predictions_table(scored, "prob", "label", named, row_id="row_id"), f"{s.output}/predictions")
    sample = trained["test"] if s.explain_rows is None else splitting.explanation_sample(trained["test"], s.explain_rows, id_name)
    if winner == comparison.COMPLEX:
        trees = attribution.ensemble_nodes(spark, fitted.ensemble)
        contributions = attribution.tree_attribution(fitted.transform(sample), trees, fitted.inputs, row_id=id_name)
    else:
        contributions = attribution.linear_attribution(fitted.transformed(sample), fitted.coefficients(), row_id=id_name)
        contributions = contributions.withColumnRenamed(id_name, "row_id")
    contributions = shared_table(contributions)
    drivers = attribution.top_drivers(contributions, scored.join(sample.select(F.col(id_name).alias("row_id")), "row_id", "left_semi"))
    writers.write_report(drivers, f"{s.output}/top_churn_drivers")
    writers.write_report(attribution.global_importance(contributions), f"{s.output}/importance")
    weights = {c: abs(w) for c, w in trained["results"][comparison.SIMPLE][0].coefficients().items()}
    pairs = comparison.common_importances(
        attribution.global_importance(contributions, k=None), models.importance_table(spark, weights, k=None)
    )
    writers.write_report(comparison.spearman(pairs).withColumn("pairs", reports.gathered(pairs, ["feature"])), f"{s.output}/importance_agreement")
    return spark.read.json(f"{s.output}/final_evaluation")


def run(spark: SparkSession, s: Settings) -> DataFrame:
    prepared = prepare(spark, s)
    return evaluate(spark, s, train_and_compare(spark, s, prepared))

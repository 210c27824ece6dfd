"""Model fitting, scoring, cross-validation and search with Spark ML.

Fits read only training rows; every fold runs the whole preparation again, so nothing leaks from a
held-out row into an encoder, imputer or scaler.
"""

from __future__ import annotations

import logging
import math
import uuid
from collections.abc import Callable
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass, field, replace
from functools import reduce
from threading import Lock

from pyspark.errors import AnalysisException
from pyspark.ml.classification import GBTClassifier, LogisticRegression
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame, functions as F

from tenura.functions.expressions import overfit_flag
from tenura.operators import one_task_trees
from tenura.operators.category_bins import BINS, apply_category_bins, fit_category_bins, unseen_bins
from tenura.operators.correlation import multicollinear_columns
from tenura.operators.encoding import (
    apply_crossfit_encoding,
    apply_target_encoding,
    crossfit_encoding,
    fit_after_imputation,
    fit_target_encoding,
    impute,
    robust_scale,
)
from tenura.operators.metrics import auc, best_thresholds, confusion, curve_cells, point_metrics, threshold_sweep
from tenura.operators.splitting import stratified_folds, stratified_split
from tenura.session import shared_folder, shared_table

LOG = logging.getLogger(__name__)

# Fold counts, search size, regularisation, boosting defaults, search space.
CV_FOLDS, SEARCH_FOLDS, ENCODER_FOLDS, SEARCH_TRIALS = 5, 3, 5, 20
INVERSE_REGULARISATION, MAX_ITERATIONS = 0.1, 1000
SEARCH_TREES = 300
ENCODED = "_enc"
#: Bins of a feature in the tree learner: every bin of a category, and one more.
MAX_BINS = BINS + 1
#: Training rows that one task of the tree learner takes at least.
TREE_TASK_ROWS = 50_000
#: Fits of a search at a time at most: each is a thread of the driver that starts small jobs.
MAX_FITS = 16
CV_METRICS = ("roc_auc", "f1", "precision", "recall")


@dataclass(frozen=True)
class BoostedParams:
    """Boosted-tree settings that Spark's learner has a counterpart for."""

    learning_rate: float = 0.05
    max_depth: int = 6
    min_child_samples: int = 20
    subsample: float = 0.8
    colsample_bytree: float = 0.8
    n_trees: int = 500


SEARCH_SPACE = {
    "learning_rate": ("log", 0.01, 0.12),
    "max_depth": ("int", 3, 8),
    "min_child_samples": ("int", 20, 100),
    "subsample": ("float", 0.6, 1.0),
    "colsample_bytree": ("float", 0.6, 1.0),
}


@dataclass(frozen=True)
class Columns:
    """Feature columns of one table: numeric measures, 0/1 flags, categories."""

    numeric: tuple[str, ...]
    categorical: tuple[str, ...] = ()
    flags: tuple[str, ...] = ()
    row_id: str = "row_id"
    label: str = "label"


def with_class_weights(train: DataFrame, label: str, output: str = "weight") -> DataFrame:
    """Balanced weights n / (2 * class size); they add up to n."""
    sizes = train.agg(
        F.struct(F.count(F.lit(1)).alias("n"), F.count_if(F.col(label) == 1).alias("pos")).alias("s")
    ).scalar()
    size = F.when(F.col(label) == 1, F.col("__s.pos")).otherwise(F.col("__s.n") - F.col("__s.pos"))
    weighted = train.withColumn("__s", sizes)
    return weighted.withColumn(output, F.coalesce(F.try_divide(F.col("__s.n"), size * 2.0), F.lit(1.0))).drop("__s")


# ---- logistic regression -----------------------------------------------------------------------


@dataclass
class LinearModel:
    """Fitted preparation and classifier of the logistic-regression path."""

    columns: Columns
    dropped: list[str]
    encoding: DataFrame | None
    medians: dict[str, float]
    scaling: dict[str, tuple[float, float]]
    model: object = None
    inputs: list[str] = field(default_factory=list)

    def prepare(self, df: DataFrame) -> DataFrame:
        """Encode with all training rows, impute, scale, assemble."""
        df = _text_categories(df, self.columns)
        if self.encoding is not None:
            df = apply_target_encoding(df, self.encoding, list(self.columns.categorical), suffix=ENCODED)
        return self._finish(df)

    def _finish(self, df: DataFrame) -> DataFrame:
        ready = robust_scale(impute(df, self.medians), self.scaling)
        return VectorAssembler(inputCols=self.inputs, outputCol="features").transform(ready)

    def transformed(self, df: DataFrame) -> DataFrame:
        """Row id and scaled model inputs as plain columns, for attribution."""
        return self.prepare(df).select(self.columns.row_id, *self.inputs)

    def score(self, df: DataFrame, keep: tuple[str, ...] = ()) -> DataFrame:
        scored = self.model.transform(self.prepare(df))
        return _scored(scored, self.columns, keep)

    def coefficients(self) -> dict[str, float]:
        return dict(zip(self.inputs, (float(v) for v in self.model.coefficients)))


def _scored(transformed: DataFrame, c: Columns, keep: tuple[str, ...]) -> DataFrame:
    prob = F.get(vector_to_array("probability"), F.lit(1))
    return transformed.select(
        c.row_id, F.col(c.label).cast("int").alias("label"), prob.alias("prob"),
        F.col("prediction").cast("int").alias("pred"), *keep,
    )


def _text_categories(df: DataFrame, c: Columns) -> DataFrame:
    """The linear path reads NULL as the category NAN."""
    cleaned = {x: F.coalesce(F.upper(F.trim(F.col(x).cast("string"))), F.lit("NAN")) for x in c.categorical}
    return df.withColumns(cleaned) if cleaned else df


def fit_linear(train: DataFrame, columns: Columns, *, drop_collinear: bool = True) -> LinearModel:
    """Collinear columns out, cross-fitted target encoding, median, robust scale, balanced L2 fit."""
    dropped = multicollinear_columns(train, list(columns.numeric), columns.label) if drop_collinear else []
    kept = replace(columns, numeric=tuple(c for c in columns.numeric if c not in dropped))
    train = _text_categories(train, kept)
    inputs = [*kept.numeric, *kept.flags, *[c + ENCODED for c in kept.categorical]]
    encoding = None
    if kept.categorical:
        encoding = fit_target_encoding(train, list(kept.categorical), kept.label)
        # the statistics and the rows both read the folds, which are dealt by shuffle
        folded = shared_table(stratified_folds(
            train, ENCODER_FOLDS, row_id=kept.row_id, label=kept.label, seed="encode", output="__fold"
        ))
        cross = crossfit_encoding(folded, list(kept.categorical), kept.label, "__fold")
        train = apply_crossfit_encoding(folded, cross, list(kept.categorical), "__fold", suffix=ENCODED)
    train = shared_table(train.select(kept.row_id, kept.label, *inputs))
    medians, scaling = fit_after_imputation(train, inputs)
    fitted = LinearModel(kept, dropped, encoding, medians, scaling, None, inputs)
    ready = with_class_weights(fitted._finish(train), kept.label).select("features", kept.label, "weight").persist()
    n = ready.count()
    fitted.model = LogisticRegression(
        labelCol=kept.label, weightCol="weight", standardization=False, elasticNetParam=0.0,
        regParam=1.0 / (INVERSE_REGULARISATION * n), maxIter=MAX_ITERATIONS,
    ).fit(ready)
    ready.unpersist()
    return fitted


# ---- boosted trees -----------------------------------------------------------------------------


@dataclass
class BoostedModel:
    """Fitted category bins and ensemble; numeric NULLs become a value below the range plus an indicator."""

    columns: Columns
    sentinels: dict[str, float]
    bins: DataFrame | None
    unseen: dict[str, int]
    model: object
    inputs: list[str]

    def prepare(self, df: DataFrame) -> DataFrame:
        ready = _boosted_inputs(df, self.columns, self.sentinels)
        if self.bins is not None:
            ready = apply_category_bins(ready, self.bins, self.unseen)
        return VectorAssembler(inputCols=self.inputs, outputCol="features").transform(ready)

    def transform(self, df: DataFrame) -> DataFrame:
        return self.model.transform(self.prepare(df))

    def score(self, df: DataFrame, keep: tuple[str, ...] = ()) -> DataFrame:
        return _scored(self.transform(df), self.columns, keep)

    @property
    def ensemble(self):
        return self.model

    def importances(self) -> dict[str, float]:
        return dict(zip(self.inputs, (float(v) for v in self.ensemble.featureImportances.toArray())))


def _boosted_inputs(df: DataFrame, c: Columns, sentinels: dict[str, float]) -> DataFrame:
    filled = {x: F.coalesce(F.col(x).cast("double"), F.lit(sentinels[x])) for x in c.numeric}
    absent = {f"{x}__absent": F.col(x).isNull().cast("double") for x in c.numeric}
    texts = {x: F.coalesce(F.upper(F.trim(F.col(x).cast("string"))), F.lit("__NULL__")) for x in c.categorical}
    return df.withColumns(absent).withColumns(filled | texts)


@dataclass
class BoostedRows:
    """Training rows made ready once, for any number of fits."""

    prepared: BoostedModel  #: without a learner
    ready: DataFrame  #: features, label and weight
    rows: int


def in_one_task(rows: int, c: Columns) -> bool:
    """Are so many rows few enough for one task that grows all trees of a fit?"""
    return 0 < rows * (2 * len(c.numeric) + len(c.flags) + len(c.categorical)) <= one_task_trees.ONE_TASK_CELLS


def boosted_rows(train: DataFrame, columns: Columns) -> BoostedRows:
    """Category bins, values for NULL and class weights of the rows; categories enter as ordered bins, so their number does not matter to the learner."""
    row = train.agg(
        F.count(F.lit(1)).alias("rows"),
        *[F.min(F.col(c).cast("double")).alias(f"lo{i}") for i, c in enumerate(columns.numeric)],
    ).first()
    sentinels = {c: (row[f"lo{i}"] if row[f"lo{i}"] is not None else 0.0) - 1.0 for i, c in enumerate(columns.numeric)}
    binned = [c + "__bin" for c in columns.categorical]
    inputs = [*columns.numeric, *columns.flags, *[f"{c}__absent" for c in columns.numeric], *binned]
    bins, unseen = None, {}
    if binned:
        bins = shared_table(fit_category_bins(_boosted_inputs(train, columns, sentinels), list(columns.categorical), columns.label))
        unseen = unseen_bins(bins)
    prepared = BoostedModel(columns, sentinels, bins, unseen, None, inputs)
    weighted = with_class_weights(train, columns.label)
    return BoostedRows(prepared, shared_table(prepared.prepare(weighted).select("features", columns.label, "weight")), row["rows"])


def fit_boosted(train: DataFrame | BoostedRows, columns: Columns, params: BoostedParams = BoostedParams(), seed: int = 42) -> BoostedModel:
    """Balanced gradient-boosted trees. Rows that were made ready are one of many fits, which one task each grows if they are not too many."""
    known = train if isinstance(train, BoostedRows) else boosted_rows(train, columns)
    inputs = len(known.prepared.inputs)
    columns_per_node = max(1, round(params.colsample_bytree * inputs))
    learner = GBTClassifier(
        labelCol=columns.label, weightCol="weight", seed=seed, maxIter=params.n_trees,
        stepSize=params.learning_rate, maxDepth=params.max_depth,
        minInstancesPerNode=params.min_child_samples, subsamplingRate=params.subsample,
        featureSubsetStrategy=str(columns_per_node), maxBins=MAX_BINS,
    )
    if known is train and in_one_task(known.rows, columns):
        model = one_task_trees.fit(known.ready, learner, inputs)
    else:
        # every tree is several small jobs, so a task should have rows enough to be worth its start
        model = learner.fit(known.ready.coalesce(max(1, -(-known.rows // TREE_TASK_ROWS))))
    return replace(known.prepared, model=model)


# ---- validation --------------------------------------------------------------------------------

Fit = Callable[[DataFrame], object]


def out_of_fold(train: DataFrame, fit: Fit, k: int = CV_FOLDS, *, parallel: int = 2, parts: tuple[str, ...] = ("train", "test"), **split) -> DataFrame:
    """Each training row scored once, by the model of the folds it is not in.

    Returns ``fold, part, row_id, label, prob, pred`` with the training-side scores as
    ``part = 'train'`` and the held-out side as ``part = 'test'``; only the wanted ``parts`` are scored.
    """
    folded = shared_table(stratified_folds(train, k, **split))

    def one(fold: int) -> DataFrame:
        model = fit(folded.where(F.col("fold") != fold).drop("fold"))
        part = F.when(F.col("fold") == fold, "test").otherwise("train")
        rows = folded if set(parts) == {"train", "test"} else folded.where(part.isin(*parts))
        return model.score(rows, keep=("fold",)).withColumn("part", part).withColumn("fold", F.lit(fold))

    with ThreadPoolExecutor(max_workers=parallel) as pool:
        parts = list(pool.map(one, range(k)))
    return shared_table(reduce(DataFrame.unionByName, parts))


def fold_metrics(scored_folds: DataFrame, parts: tuple[str, ...] = ("train", "test"), k: int = CV_FOLDS) -> DataFrame:
    """Long ``part, fold, metric, value`` for AUC, F1, precision and recall of every fold."""
    names = {f"{p}_{i}": (p, i) for p in parts for i in range(k)}
    mine = {n: (F.col("part") == p) & (F.col("fold") == i) for n, (p, i) in names.items()}
    wide = scored_folds.select(
        "label", *[F.when(hit, F.col("prob")).alias(n) for n, hit in mine.items()],
        *[F.when(hit, F.col("pred")).alias(f"pred_{n}") for n, hit in mine.items()],
    )
    ranking = auc(curve_cells(wide, list(names), "label")).select("series", F.col("auc").alias("roc_auc"))
    hard = point_metrics(confusion(wide, {n: F.col(f"pred_{n}") for n in names}, "label"))
    joined = ranking.join(hard, "series")
    entries = [F.struct(F.lit(m).alias("metric"), F.col(m).alias("value")) for m in CV_METRICS]
    return joined.select(
        F.substring_index("series", "_", 1).alias("part"),
        F.substring_index("series", "_", -1).cast("int").alias("fold"),
        F.inline(F.array(*entries)),
    )


def cv_summary(folds: DataFrame) -> DataFrame:
    """Mean, population deviation and mean -/+ two deviations per metric and part, with the AUC gap."""
    summary = folds.groupBy("metric", "part").agg(F.avg("value").alias("mean"), F.stddev_pop("value").alias("std"))
    side = lambda p: F.max(F.when(F.col("part") == p, F.col("mean")))
    gaps = summary.groupBy("metric").agg((side("train") - side("test")).alias("train_test_gap"))
    return summary.join(gaps, "metric").select(
        "metric", "part", "mean", "std",
        (F.col("mean") - 2 * F.col("std")).alias("low"), (F.col("mean") + 2 * F.col("std")).alias("high"),
        "train_test_gap",
        ((F.col("metric") == "roc_auc") & overfit_flag(F.col("train_test_gap"))).alias("overfit"),
    )


def thresholds_from(scored: DataFrame, source: str) -> DataFrame:
    """Best thresholds of scored training rows, tagged with where they came from."""
    best = best_thresholds(threshold_sweep(scored, ["prob"], "label")).drop("series")
    return best.withColumn("selection_source", F.lit(source)).withColumn(
        "business_rule", F.lit("precision >= 0.60, highest recall")
    )


def validate(train: DataFrame, fit: Fit, k: int = CV_FOLDS, *, summary: bool = True, fallback: bool = False, **split) -> tuple[DataFrame, DataFrame | None]:
    """(thresholds, fold summary) from the same out-of-fold scores.

    Without ``summary`` there is none, and the training sides of the folds, which only it reads, are not scored. A fold
    that fails fails the validation. Only with ``fallback`` does it go on: thresholds then come from an inner 80/20
    split and say so, there is no summary, and the cause is logged with its trace.
    """
    try:
        folds = out_of_fold(train, fit, k, parts=("train", "test") if summary else ("test",), **split)
        best = thresholds_from(folds.where(F.col("part") == "test"), "out_of_fold")
        return best, cv_summary(fold_metrics(folds, k=k)) if summary else None
    except Exception:  # noqa: BLE001 - the fallback covers any failed fold
        if not fallback:
            raise
        LOG.warning("out-of-fold scores failed, thresholds come from an inner split", exc_info=True)
        inner = shared_table(stratified_split(train, seed="inner", **split))
        model = fit(inner.where(F.col("part") == "train").drop("part"))
        return thresholds_from(model.score(inner.where(F.col("part") == "test").drop("part")), "inner_split"), None


def select_thresholds(train: DataFrame, fit: Fit, k: int = CV_FOLDS, *, fallback: bool = True, **split) -> DataFrame:
    """Thresholds from out-of-fold scores; if that fails, from an inner 80/20 split, or with ``fallback=False`` none."""
    return validate(train, fit, k, summary=False, fallback=fallback, **split)[0]


# ---- search ------------------------------------------------------------------------------------


def search_trials(trials: int = SEARCH_TRIALS, seed: int = 42, base: BoostedParams = BoostedParams(n_trees=SEARCH_TREES)) -> list[BoostedParams]:
    """Seeded random settings from the search space (log-uniform, uniform, whole numbers)."""
    import random

    rng = random.Random(seed)
    drawn = []
    for _ in range(trials):
        values: dict[str, float | int] = {}
        for name, (kind, low, high) in SEARCH_SPACE.items():
            if kind == "int":
                values[name] = rng.randint(low, high)
            elif kind == "log":
                values[name] = math.exp(rng.uniform(math.log(low), math.log(high)))
            else:
                values[name] = rng.uniform(low, high)
        drawn.append(replace(base, **values))
    return drawn


def concurrent_fits(rows: int, cores: int) -> int:
    """Fits of so many rows that fill the cores, as a small fit is one task at a time; two at least, sixteen at most."""
    return max(2, min(MAX_FITS, cores // max(1, -(-rows // TREE_TASK_ROWS))))


def search_boosted(
    train: DataFrame,
    columns: Columns,
    trials: list[BoostedParams],
    k: int = SEARCH_FOLDS,
    *,
    on_trial: Callable[[int, BoostedParams, float], None] | None = None,
    parallel: int | None = None,
    ledger: str | None = None,
) -> DataFrame:
    """``trial, <params>, auc``: mean held-out AUC per setting over the same folds.

    Every finished (setting, fold) is written to the ``ledger`` folder at once, with its setting and the rows it was
    judged on; a search that starts on a ledger takes over what is there for the same setting and rows, so one that was
    ended goes on where it stopped. The rows of a fold are made ready once for all settings. ``parallel`` fits run at a
    time, by default as many as fill the cores.
    ``on_trial`` is called when the last fold of a setting ends; a failing callback
    never stops the search.
    """
    spark = train.sparkSession
    ledger = ledger or f"{shared_folder(spark)}/search-{uuid.uuid4().hex}"
    folded = shared_table(stratified_folds(train, k, row_id=columns.row_id, label=columns.label))
    sizes = {r["fold"]: r["count"] for r in folded.groupBy("fold").count().collect()}
    known = {(r["trial"], r["fold"]): r for r in read_ledger(spark, ledger).collect()}
    settings = lambda p: (*[float(getattr(p, n)) for n in SEARCH_SPACE], float(p.n_trees))
    done: dict[int, list[float]] = {}
    lock, sides = Lock(), {f: (Lock(), []) for f in range(k)}
    judging, judged = Lock(), {}
    waiting: dict[int, dict[int, object]] = {f: {} for f in range(k)}

    def side(fold: int) -> tuple[BoostedRows, DataFrame]:
        """Training rows and held-out vectors of a fold, made by the first fit that asks."""
        mine, made = sides[fold]
        with mine:
            if not made:
                rows = boosted_rows(folded.where(F.col("fold") != fold), columns)
                held = rows.prepared.prepare(folded.where(F.col("fold") == fold))
                made += rows, shared_table(held.select(columns.row_id, columns.label, "features"))
        return made[0], made[1]

    def one(job: tuple[int, int]) -> None:
        trial, fold = job
        params, row = trials[trial], known.get(job)
        if row is not None and tuple(row[n] for n in (*SEARCH_SPACE, "n_trees")) == settings(params) and row["rows"] == sizes[fold]:
            found = row["auc"]
        else:
            rows, held = side(fold)
            model = fit_boosted(rows, columns, params).model
            with lock:
                waiting[fold][trial] = model
            with judging:
                # all that wait for this fold, unless another one judged this fit with its own
                with lock:
                    some = dict(waiting[fold]) if trial in waiting[fold] else {}
                if some:
                    judged.update({(t, fold): value for t, value in _held_out_auc(some, held, columns).items()})
                    with lock:
                        waiting[fold] = {t: m for t, m in waiting[fold].items() if t not in some}
            found = judged[job]
            entry = spark.createDataFrame([(trial, fold, *settings(params), sizes[fold], found)], LEDGER)
            entry.coalesce(1).write.mode("overwrite").parquet(f"{ledger}/trial_{trial}_fold_{fold}")
        with lock:
            done.setdefault(trial, []).append(found)
            ended = len(done[trial]) == k
        if ended and on_trial is not None:
            try:
                on_trial(trial, params, _mean(done[trial]))
            except Exception as failure:  # noqa: BLE001 - logging is optional
                LOG.warning("trial %d not logged: %s", trial, failure)

    jobs = [(t, f) for t in range(len(trials)) for f in range(k)]
    rows, cores = sum(sizes.values()) - min(sizes.values(), default=0), spark.sparkContext.defaultParallelism
    # of fits in one task each some wait to be judged while others grow
    parallel = parallel or (concurrent_fits(1, 2 * cores) if in_one_task(rows, columns) else concurrent_fits(rows, cores))
    with ThreadPoolExecutor(max_workers=parallel) as pool:
        list(pool.map(one, jobs))
    rows = [(t, *settings(p)[:-1], _mean(done[t])) for t, p in enumerate(trials)]
    schema = "trial int, " + ", ".join(f"{n} double" for n in SEARCH_SPACE) + ", auc double"
    return spark.createDataFrame(rows, schema)


def _held_out_auc(fitted: dict[int, object], held: DataFrame, c: Columns) -> dict[int, float | None]:
    """AUC of every model on the same rows, by one query."""
    wide, names = held.withColumn("label", F.col(c.label).cast("int")), [f"prob_{t}" for t in fitted]
    for name, model in zip(names, fitted.values()):
        prob = F.get(vector_to_array("probability"), F.lit(1))
        wide = model.transform(wide).withColumn(name, prob).drop("probability", "rawPrediction", "prediction")
    scored = shared_table(wide.select("label", *names))
    found = {r["series"]: r["auc"] for r in auc(curve_cells(scored, names, "label")).collect()}
    return {t: found.get(f"prob_{t}") for t in fitted}


LEDGER = "trial int, fold int, " + ", ".join(f"{n} double" for n in SEARCH_SPACE) + ", n_trees double, rows bigint, auc double"


def _mean(values: list[float | None]) -> float | None:
    """The mean over all folds; a fold of a single class has no AUC, and then the setting has none."""
    return None if None in values else sum(values) / len(values)


def read_ledger(spark, path: str) -> DataFrame:
    """Finished (setting, fold) pairs of a search with their AUC; empty before the first has ended."""
    reader = spark.read.schema(LEDGER).option("recursiveFileLookup", "true")
    try:
        return reader.parquet(path)
    except AnalysisException as failure:
        if failure.getCondition() != "PATH_NOT_FOUND":
            raise
        return spark.createDataFrame([], LEDGER)


def best_params(trials: DataFrame, base: BoostedParams = BoostedParams()) -> BoostedParams:
    """Best row of the trial table; the base settings when no trial finished."""
    best = trials.where(F.col("auc").isNotNull()).orderBy(F.desc("auc"), "trial").first()
    if best is None:
        return base
    return replace(
        base, **{n: (int(best[n]) if SEARCH_SPACE[n][0] == "int" else best[n]) for n in SEARCH_SPACE}
    )


def importance_table(spark, importances: dict[str, float], k: int | None = 20) -> DataFrame:
    """Coefficients or gains by size with their direction; one row per model input."""
    rows = [(name, value, abs(value)) for name, value in importances.items()]
    table = spark.createDataFrame(rows, "feature string, value double, importance double").withColumn(
        "direction", F.when(F.col("value") > 0, "increases").otherwise("decreases")
    )
    ordered = table.orderBy(F.desc("importance"), "feature")
    return ordered if k is None else ordered.limit(k)

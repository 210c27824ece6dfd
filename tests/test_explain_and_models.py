import itertools
import math

import numpy as np
import pytest
from pyspark.ml.functions import vector_to_array
from pyspark.sql import functions as F

from tenura.operators import attribution, category_bins, models, persistence, ranking, splitting
from tenura.sources import writers


@pytest.fixture(scope="module")
def customers(spark):
    n = 400
    noise = (F.col("id") * 7919 % 1009) / 1009.0
    x = (F.col("id") * 37 % 101) / 100.0
    return spark.range(n).select(
        F.col("id").alias("row_id"), x.alias("x"),
        F.when(F.col("id") % 5 != 0, noise).alias("z"),
        (x * 2 + 0.01 * noise).alias("twin"),
        F.when(F.col("id") % 9 != 0, F.concat(F.lit("g"), (F.col("id") % 4).cast("string"))).alias("g"),
        (x + 0.3 * noise > 0.6).cast("int").alias("label"),
    ).cache()


COLUMNS = models.Columns(("x", "z", "twin"), ("g",))
QUICK = models.BoostedParams(n_trees=4, max_depth=3, learning_rate=0.3, min_child_samples=5, subsample=1.0, colsample_bytree=1.0)


def test_linear_attribution_adds_up(spark, customers):
    weights = {"x": 2.0, "z": -1.5}
    parts = attribution.linear_attribution(customers, weights)
    sums = {r["row_id"]: r["s"] for r in parts.groupBy("row_id").agg(F.sum("value").alias("s")).collect()}
    pdf = customers.toPandas()
    centred = 2.0 * (pdf.x - pdf.x.mean()) + (-1.5 * (pdf.z - pdf.z.mean())).fillna(0.0)
    assert np.allclose([sums[i] for i in pdf.row_id], centred)
    steps = attribution.waterfall(parts, 3, 0.25).orderBy("step").collect()
    assert math.isclose(steps[-1]["end"], 0.25 + sums[3]) and math.isclose(steps[0]["start"], 0.25)


def test_top_drivers_order_and_ties(spark):
    parts = spark.createDataFrame(
        [(1, "b", 0.5), (1, "a", -0.5), (1, "c", 0.9), (1, "d", 0.0), (2, "a", 0.1), (3, "a", 1.0)], "row_id bigint, feature string, value double"
    )
    scores = spark.createDataFrame([(1, 0.7), (2, 0.9), (3, 0.7)], "row_id bigint, prob double")
    got = attribution.top_drivers(parts, scores, customers=2).orderBy("rank").collect()
    assert [(r["rank"], r["row_id"]) for r in got] == [(1, 2), (2, 1)]
    assert [(d["feature"], d["direction"]) for d in got[1]["top_drivers"]] == [
        ("c", "increases_churn"), ("a", "decreases_churn"), ("b", "increases_churn")]
    rollup = {r["feature"]: (r["total"], r["label"]) for r in attribution.driver_rollup(attribution.top_drivers(parts, scores)).collect()}
    assert rollup["a"] == (1.6, "A")
    named = attribution.driver_rollup(attribution.top_drivers(parts.replace("a", "eqpdays"), scores))
    assert named.first()["label"] == "Equipment Age"
    assert attribution.insight_features(named).count() == 1


def test_tree_attribution_is_exact(spark, customers):
    fitted = models.fit_boosted(customers, COLUMNS, QUICK)
    trees = attribution.ensemble_nodes(spark, fitted.ensemble)
    sample = fitted.transform(customers.where("row_id < 25"))
    parts = attribution.tree_attribution(sample, trees, fitted.inputs).toPandas()
    sums = parts.groupby("row_id").value.sum() + attribution.expected_margin(trees)
    # Values are log-odds.
    prob = {r["row_id"]: r["p"] for r in sample.select("row_id", vector_to_array("probability")[1].alias("p")).collect()}
    for i in sums.index:
        assert math.isclose(1 / (1 + math.exp(-sums[i])), prob[i], abs_tol=1e-9)
    # Brute force over coalitions for one row and one tree.
    tree = trees[0]
    x = np.array(sample.select(vector_to_array("features")).where("row_id = 7").first()[0])
    used = sorted({f for f in tree["feature"] if f >= 0})

    def worth(coalition, node=0):
        f = tree["feature"][node]
        if f < 0:
            return tree["value"][node]
        left, right = tree["left"][node], tree["right"][node]
        if f in coalition:
            rule = tree["rule"][node]
            go = x[f] in rule if rule is not None else x[f] <= tree["threshold"][node]
            return worth(coalition, left if go else right)
        share = tree["cover"][left] / tree["cover"][node]
        return share * worth(coalition, left) + (1 - share) * worth(coalition, right)

    phi, base = attribution.attribute_batch(x[None, :], [tree], len(x))
    assert math.isclose(base, worth(set()), abs_tol=1e-12)
    for f in used:
        others, total = [u for u in used if u != f], 0.0
        for k in range(len(others) + 1):
            for c in itertools.combinations(others, k):
                w = math.factorial(k) * math.factorial(len(used) - k - 1) / math.factorial(len(used))
                total += w * (worth(set(c) | {f}) - worth(set(c)))
        assert math.isclose(phi[0, f], total, abs_tol=1e-9)


def test_linear_model_path(spark, customers):
    split = splitting.stratified_split(customers).cache()
    train, test = split.where("part = 'train'").drop("part"), split.where("part = 'test'").drop("part")
    fitted = models.fit_linear(train, COLUMNS)
    assert len(fitted.dropped) == 1 and fitted.dropped[0] in ("x", "twin")
    scored = fitted.score(test)
    assert scored.count() == test.count()
    # A test label never changes anything fitted.
    flipped = models.fit_linear(split.withColumn("label", F.when(F.col("part") == "test", 1 - F.col("label")).otherwise(F.col("label"))).where("part = 'train'").drop("part"), COLUMNS)
    assert flipped.medians == fitted.medians and flipped.scaling == fitted.scaling
    assert flipped.coefficients() == pytest.approx(fitted.coefficients())


def test_class_weights_sum_to_n(customers):
    r = models.with_class_weights(customers, "label").groupBy("label").agg(F.sum("weight").alias("w")).collect()
    assert [x["w"] for x in r] == pytest.approx([200.0, 200.0])


def test_out_of_fold_covers_each_row_once(customers):
    folds = models.out_of_fold(customers, lambda t: models.fit_boosted(t, COLUMNS, QUICK), 3)
    held = folds.where("part = 'test'")
    assert held.count() == held.select("row_id").distinct().count() == 400
    summary = {(r["metric"], r["part"]): r for r in models.cv_summary(models.fold_metrics(folds, k=3)).collect()}
    assert len(summary) == 8 and summary["roc_auc", "test"]["mean"] > 0.8
    best = models.thresholds_from(held, "out_of_fold").first()
    assert best["selection_source"] == "out_of_fold"


def test_threshold_fallback(customers):
    calls = []

    def fit(train):
        calls.append(1)
        if len(calls) <= 2:
            raise RuntimeError("a fold failed")
        return models.fit_boosted(train, COLUMNS, QUICK)

    got = models.select_thresholds(customers, fit, 2).first()
    assert got["selection_source"] == "inner_split"


def test_search_space_and_logging(customers):
    trials = models.search_trials(20)
    assert trials == models.search_trials(20) and len({t.learning_rate for t in trials}) == 20
    assert all(3 <= t.max_depth <= 8 and 0.01 <= t.learning_rate <= 0.12 for t in trials)

    def broken(*_):
        raise OSError("log is down")

    table = models.search_boosted(customers, COLUMNS, [QUICK], 2, on_trial=broken)
    assert table.first()["auc"] > 0.8 and models.best_params(table, QUICK).max_depth == 3
    assert models.best_params(table.where("trial < 0"), QUICK) == QUICK
    assert models.importance_table(customers.sparkSession, {"a": -2.0, "b": 1.0}).first()["direction"] == "decreases"


def test_search_goes_on_where_it_stopped(spark, customers, tmp_path, monkeypatch):
    """A search that is ended after two of six fits repeats none of them, and logs each setting once."""
    trials, path, real, fits, logged = [QUICK, models.replace(QUICK, max_depth=2), models.replace(QUICK, n_trees=2)], str(tmp_path / "ledger"), models.fit_boosted, [], []

    def counted(*args):
        if len(fits) == 2:
            raise KeyboardInterrupt
        fits.append(args[2])
        return real(*args)

    monkeypatch.setattr(models, "fit_boosted", counted)
    with pytest.raises(KeyboardInterrupt):
        models.search_boosted(customers, COLUMNS, trials, 2, parallel=1, ledger=path)
    assert models.read_ledger(spark, path).count() == 2
    monkeypatch.setattr(models, "fit_boosted", lambda *args: (fits.append(args[2]), real(*args))[1])
    table = models.search_boosted(customers, COLUMNS, trials, 2, parallel=1, ledger=path, on_trial=lambda t, p, a: logged.append((t, a)))
    assert len(fits) == 6 and sorted(t for t, _ in logged) == [0, 1, 2]
    rows = models.read_ledger(spark, path).collect()
    assert sorted((r["trial"], r["fold"]) for r in rows) == [(t, f) for t in range(3) for f in range(2)]
    assert sum(r["rows"] for r in rows) == 3 * 400
    means = {t: sum(r["auc"] for r in rows if r["trial"] == t) / 2 for t in range(3)}
    assert {r["trial"]: r["auc"] for r in table.collect()} == pytest.approx(means)
    # another setting under the same number is fitted anew
    models.search_boosted(customers, COLUMNS, [models.replace(QUICK, max_depth=1)], 2, parallel=1, ledger=path)
    assert len(fits) == 8


def test_hold_out_does_not_depend_on_partitions(spark):
    from tenura.plans import workflow
    from tenura.roles import Roles

    rows = [(str(i % 40), None if i % 3 else "x", "1,5" if i % 2 else "", str(i % 2)) for i in range(200)] + [("hot", "a", None, "1")] * 100
    found = []
    for parts in (1, 3, 17):
        df = spark.createDataFrame(rows[::-1] if parts == 3 else rows, "a string, b string, c string, churn string").repartition(parts)
        known = workflow.with_row_id(df, Roles())
        assert sorted(r[0] for r in known.select(Roles().row_id).collect()) == list(range(300))
        split = splitting.stratified_split(known, row_id=Roles().row_id, label="churn")
        found.append(sorted(map(repr, split.collect())))
    assert found[0] == found[1] == found[2]


def test_equal_rows_are_numbered_by_many_tasks(spark, monkeypatch):
    from tenura.operators import identity

    monkeypatch.setattr(identity, "EQUAL_ROWS", 7)
    df = spark.createDataFrame([("a", None)] * 50 + [("b", "")] * 3 + [("b", None)], "x string, y string")
    got = identity.with_content_id(df).collect()
    assert sorted(r["row_id"] for r in got) == list(range(54))
    numbers = sorted(r["row_id"] for r in got if r["x"] == "a")
    assert numbers == list(range(numbers[0], numbers[0] + 50))
    assert identity.with_content_id(df.limit(0)).count() == 0


def test_split_moves_only_keys(spark, tmp_path):
    """Only counts of the hash cross an exchange; a class of one row and a null class are defined."""
    df = spark.range(5000).select(F.col("id").alias("row_id"), (F.col("id") % 3).cast("int").alias("label"), F.rand(1).alias("feature"))
    df = df.unionByName(spark.createDataFrame([(9001, 7, 0.5), (9002, None, 0.5)], "row_id long, label int, feature double"))
    df.write.parquet(str(tmp_path / "rows"))
    df = spark.read.parquet(str(tmp_path / "rows"))
    split = splitting.stratified_split(df)
    # the rows themselves are only projected; the subquery that finds the last test rows never reads a feature
    plan = split.select("row_id", "feature")._jdf.queryExecution().optimizedPlan().toString()
    assert not any(word in plan for word in ("Join", "Aggregate", "Window", "Repartition"))
    narrow = df.select(F.col("label").alias("class"), splitting.split_hash("row_id").alias("u"), F.col("row_id").alias("id"))
    assert "feature" not in ranking.smallest_in_class(narrow, lambda n: n)._jdf.queryExecution().executedPlan().toString()
    ranked = {}
    for r in df.where("label is not null").select("label", "row_id", splitting.split_hash("row_id").alias("u")).collect():
        ranked.setdefault(r["label"], []).append((r["u"], r["row_id"]))
    want = {i for rows in ranked.values() for _, i in sorted(rows)[: -(-len(rows) * 20 // 100)]}
    assert {r["row_id"] for r in split.where("part = 'test'").collect()} == want
    assert split.count() == 5001


def test_bins_follow_the_smoothed_rate(spark):
    """Few rates have a bin each; many are cut by the rows before them; NULL is a category; unseen ones sit in the middle."""
    rows = [("a", 1)] * 30 + [("a", 0)] * 10 + [("b", 0)] * 40 + [(None, 1)] * 20 + [(None, 0)] * 20 + [("c", None)]
    found = category_bins.fit_category_bins(spark.createDataFrame(rows, "k string, label int"), ["k"], "label")
    assert {(r["category"], r["n"], r["pos"], r["bin"]) for r in found.collect()} == {("b", 40, 0, 0), (None, 40, 20, 1), ("a", 40, 30, 2)}
    assert category_bins.unseen_bins(found) == {"k": 0}
    two = category_bins.fit_category_bins(spark.createDataFrame(rows, "k string, label int"), ["k"], "label", bins=2)
    assert {r["category"]: r["bin"] for r in two.collect()} == {"b": 0, None: 0, "a": 1}
    asked = spark.createDataFrame([("a",), (None,), ("new",)], "k string")
    got = category_bins.apply_category_bins(asked, found, {"k": 0}).collect()
    assert {(r["k"], r["k__bin"]) for r in got} == {("a", 2.0), (None, 1.0), ("new", 0.0)}
    none = spark.createDataFrame([], "k string, label int")
    assert category_bins.fit_category_bins(none, ["k"], "label").count() == 0


def test_a_million_categories_need_no_more_bins(spark):
    """The learner's bins do not follow the number of categories, and the categories stay in a table."""
    n = 1_000_000
    df = spark.range(2 * n).select(
        F.col("id").alias("row_id"), F.concat(F.lit("k"), (F.col("id") % n).cast("string")).alias("key"),
        ((F.col("id") % n) % 4 == 0).cast("int").alias("label"),
    )
    fitted = models.fit_boosted(df, models.Columns((), ("key",)), models.BoostedParams(n_trees=2, max_depth=2, learning_rate=0.3))
    assert fitted.model.getMaxBins() == 256 and fitted.bins.count() == n
    assert fitted.bins.agg(F.max("bin")).first()[0] < 255
    right = fitted.score(df.where("row_id < 2000")).where("pred = label").count()
    assert right == 2000
    unknown = spark.createDataFrame([(1, "never seen", 0), (2, None, 0)], "row_id long, key string, label int")
    assert fitted.score(unknown).count() == 2


@pytest.mark.parametrize("kind", ["linear", "boosted"])
def test_written_model_scores_and_explains_the_same(spark, customers, tmp_path, kind):
    fitted = models.fit_linear(customers, COLUMNS) if kind == "linear" else models.fit_boosted(customers, COLUMNS, QUICK)
    writers.write_model(persistence.pipeline(fitted), str(tmp_path / "model"))
    again = persistence.load_model(spark, str(tmp_path / "model"))
    assert again.columns == fitted.columns and again.inputs == fitted.inputs
    assert sorted(again.score(customers).collect()) == sorted(fitted.score(customers).collect())
    weights = (lambda m: m.coefficients()) if kind == "linear" else (lambda m: m.importances())
    assert weights(again) == weights(fitted)
    # written as one Spark ML pipeline, it also runs as such
    from pyspark.ml import PipelineModel

    plain = PipelineModel.load(str(tmp_path / "model")).transform(customers)
    assert plain.count() == customers.count() and "probability" in plain.columns

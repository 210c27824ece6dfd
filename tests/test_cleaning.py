import math

from pyspark.sql import functions as F

from tenura.functions import expressions as X
from tenura.operators import cleaning, features
from tenura.roles import Roles


def one(spark, value, kind="double"):
    return spark.createDataFrame([(value,)], f"x {kind}")


def test_decimal_comma(spark, rows):
    df = spark.createDataFrame([("1,5",), ("1.234,5",), ("n/a",), (None,), ("NaN",), ("7",)], "x string")
    got = [r[0] for r in df.select(X.decimal_comma(F.col("x"))).collect()]
    assert got == [1.5, None, None, None, None, 7.0]


def test_missing_tokens(spark):
    df = spark.createDataFrame([("NA",), ("",), ("None",), ("nope",)], "x string")
    assert [r[0] for r in df.select(X.missing_to_null(F.col("x"))).collect()] == [None, None, None, "nope"]


def test_domain_rule_boundaries(spark, rows):
    df = spark.createDataFrame(
        [(1, -1.0, 14.0, 11.0, 5.0, 3.0), (2, 0.0, 13.0, 12.0, None, 3.0), (3, None, None, None, 2.0, None)],
        "row_id int, eqpdays double, uniqsubs double, actvsubs double, drop_vce_Mean double, plcd_vce_Mean double",
    )
    assert rows(cleaning.apply_domain_rules(df)) == [
        (1, None, 13.0, 11.0, 3.0, 3.0), (2, 0.0, 13.0, 11.0, None, 3.0), (3, None, None, None, 2.0, None),
    ]
    counts = dict(rows(cleaning.rule_violations(df, cleaning.domain_predicates(df))))
    assert counts == {
        "eqpdays_negative": 1, "uniqsubs_above_limit": 1, "actvsubs_above_limit": 1,
        "drop_vce_Mean_above_plcd_vce_Mean": 1,
    }


def test_absent_columns_are_skipped(spark):
    df = spark.createDataFrame([(1,)], "a int")
    assert cleaning.apply_domain_rules(df).columns == ["a"]
    built, skipped = features.usage_features(df)
    assert built.columns == ["a"] and set(skipped) == {"recent_usage_delta", "drop_rate", "old_phone"}


def test_missing_rate_bands():
    rates = {"a": 0.20, "b": 0.2000001, "c": 0.50, "d": 0.51}
    assert cleaning.sparse_columns(rates) == ["d"]
    assert cleaning.flagged_columns(rates) == ["b", "c"]


def test_old_device_boundary(spark):
    df = spark.createDataFrame([(500.0,), (501.0,), (None,)], "x double")
    assert [r[0] for r in df.select(features.old_device(F.col("x"))).collect()] == [0.0, 1.0, None]


def test_drop_rate_zero_denominator(spark):
    df = spark.createDataFrame([(1.0, -1.0), (1.0, 1.0)], "a double, b double")
    assert [r[0] for r in df.select(features.drop_rate(F.col("a"), F.col("b"))).collect()] == [None, 0.5]


def test_category_text(spark):
    df = spark.createDataFrame([(" ab ",), (None,)], "x string")
    assert [r[0] for r in df.select(X.clean_category(F.col("x"))).collect()] == ["AB", None]
    assert [r[0] for r in df.select(X.clean_category(F.col("x"), "NAN")).collect()] == ["AB", "NAN"]


def test_erfc_and_labels(spark):
    df = spark.createDataFrame([(float(i) / 7,) for i in range(30)], "x double")
    for r in df.select("x", X.erfc(F.col("x")).alias("y")).collect():
        assert math.isclose(r.y, math.erfc(r.x), rel_tol=2e-7)
    values = [0.4735, -0.4735, 0.0625, 0.1235, -0.0001, 1.0005, 2.0, 0.0005, 12.3465]
    got = [r[0] for r in spark.createDataFrame([(v,) for v in values], "x double").select(
        X.driver_label(F.lit("f"), F.col("x"))).collect()]
    assert got == [f"f ({v:+.3f})" for v in values]


def test_roles_schema_walks(spark):
    df = spark.createDataFrame(
        [(1, 0, "x", "y", 1.0, 2, 1)],
        "row_id int, churn int, area string, odd string, m double, truck int, m_was_missing int",
    )
    roles = Roles()
    assert roles.undeclared_text(df) == ["odd"]
    assert roles.numeric(df) == ["m", "m_was_missing"]
    assert roles.numeric(df, flags=False) == ["m"]
    assert Roles.from_json(roles.to_json()) == roles
    assert "forgntvl" not in roles.for_profile().binary


def test_projections_run_on_a_stream(spark, tmp_path):
    columns = "eqpdays double, avg3mou double, avg6mou double, drop_vce_Mean double, plcd_vce_Mean double"
    batch = spark.createDataFrame([(-1.0, 3.0, 1.0, 9.0, 4.0), (501.0, 1.0, 2.0, 1.0, 4.0)], columns)
    batch.write.parquet(str(tmp_path / "in"))
    whole = lambda df: features.usage_features(cleaning.apply_domain_rules(df))[0]
    stream = whole(spark.readStream.schema(columns).parquet(str(tmp_path / "in")))
    job = stream.writeStream.format("memory").queryName("projected").trigger(availableNow=True).start()
    job.awaitTermination(60)
    key = lambda r: repr(tuple(r))
    assert sorted(spark.table("projected").collect(), key=key) == sorted(whole(batch).collect(), key=key)

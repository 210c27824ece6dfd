"""Row identity from the rows' own content, so that it does not depend on files, partitions or their order."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

#: Hexadecimal digits of the digest that name a range, and equal rows that one task writes out.
RANGE_DIGITS, EQUAL_ROWS = 3, 65_536


def content_digest(columns: list[str]) -> Column:
    """md5 over all values with their lengths; NULL differs from every text."""
    parts = [F.coalesce(F.concat(F.length(F.col(c).cast("string")).cast("string"), F.lit(":"), F.col(c).cast("string")), F.lit("-")) for c in columns]
    return F.md5(F.concat_ws(",", *parts).cast("binary"))


def with_content_id(df: DataFrame, output: str = "row_id") -> DataFrame:
    """Add a number 0 .. n-1: the place of the row in the order of its content's digest; equal rows get neighbours.

    Equal rows are counted where they stand and numbered together, so a row that makes up a third of the table is one
    row until the end, where its numbers are written out by as many tasks as it needs.
    """
    columns = df.columns
    groups = df.withColumn("__digest", content_digest(columns)).groupBy(*columns, "__digest").agg(F.count(F.lit(1)).alias("__equal"))
    groups = groups.withColumn("__range", F.substring("__digest", 1, RANGE_DIGITS))
    totals = groups.groupBy("__range").agg(F.sum("__equal").alias("__rows"))
    # a row for each range of digests: 4,096
    before = totals.select("__range", (F.sum("__rows").over(Window.orderBy("__range")) - F.col("__rows")).alias("__before"))
    inside = Window.partitionBy("__range").orderBy("__digest", *columns).rowsBetween(Window.unboundedPreceding, -1)
    placed = groups.withColumn("__inside", F.coalesce(F.sum("__equal").over(inside), F.lit(0))).join(before, "__range")
    placed = placed.select(*columns, "__equal", (F.col("__before") + F.col("__inside")).alias("__first"))
    few, many = placed.where(F.col("__equal") <= EQUAL_ROWS), placed.where(F.col("__equal") > EQUAL_ROWS)
    runs = many.withColumn("__run", F.explode(F.sequence(F.lit(0).cast("bigint"), F.expr(f"(__equal - 1) div {EQUAL_ROWS}"))))
    size = F.least(F.lit(EQUAL_ROWS), F.col("__equal") - F.col("__run") * EQUAL_ROWS)
    runs = runs.select(*columns, size.alias("__equal"), (F.col("__first") + F.col("__run") * EQUAL_ROWS).alias("__first")).repartition("__first")
    numbers = F.explode(F.sequence(F.col("__first"), F.col("__first") + F.col("__equal") - 1)).alias(output)
    return few.select(*columns, numbers).unionByName(runs.select(*columns, numbers))

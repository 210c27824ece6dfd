"""Pearson correlations over pairwise-complete rows, and the multicollinearity filter."""

from __future__ import annotations

from collections.abc import Iterator, Mapping

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, functions as F

from tenura.operators.profiling import tall

# Fixed value: correlation above which one of two columns is dropped.
COLLINEAR_ABOVE = 0.85


def correlation_with_target(df: DataFrame, columns: list[str], label: str) -> DataFrame:
    """``series, n, r`` per column; a constant column gives NULL, a column without any pair has no row.

    One aggregate over the table as it stands: the co-moments of all columns are merged map-side, and only the single
    row of results is turned into one row a column.
    """
    y = F.col(label).cast("double")
    found = []
    for c in columns:
        x = F.col(c).cast("double")
        both = x.isNotNull() & y.isNotNull()
        spread = F.stddev_pop(F.when(both, x)) * F.stddev_pop(F.when(both, y))
        found.append(F.struct(F.lit(c).alias("series"), F.count_if(both).alias("n"), F.try_divide(F.covar_pop(x, y), spread).alias("r")))
    if not found:
        return df.sparkSession.createDataFrame([], "series string, n bigint, r double")
    return df.agg(F.array(*found).alias("__found")).select(F.inline("__found")).where(F.col("n") > 0)


def top_correlated(correlations: DataFrame, k: int) -> DataFrame:
    return correlations.where(F.col("r").isNotNull()).orderBy(F.desc(F.abs("r")), "series").limit(k)


def correlation_matrix(df: DataFrame, columns: list[str]) -> DataFrame:
    """Lower triangle ``a, b, n, r`` over column pairs (a later than b); pairs without a common row have none."""
    if len(columns) < 2:
        return df.sparkSession.createDataFrame([], "a string, b string, n bigint, r double")
    names = F.array(*[F.lit(c) for c in columns])
    pairs = wide_correlations(df, columns).where(F.col("n") > 0)
    return pairs.select(F.get(names, F.col("i")).alias("a"), F.get(names, F.col("j")).alias("b"), F.col("n").cast("bigint").alias("n"), "r")


PAIR_SUMS = "i int, j int, n double, sx double, sy double, sxx double, syy double, sxy double"


def wide_correlations(df: DataFrame, columns: list[str]) -> DataFrame:
    """All column pairs ``i > j`` (positions) of a wide table in one scan.

    Per Arrow batch the pair sums are matrix products over centred values, so the cost per row
    does not grow with an unpivot of p*p/2 rows; each task emits one row per pair.
    """
    centres = df.agg(*[F.avg(c).alias(c) for c in columns]).first()
    middle = np.array([centres[c] if centres[c] is not None else 0.0 for c in columns], dtype=float)
    rows, cols = np.tril_indices(len(columns), k=-1)

    def pair_sums(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        sums = np.zeros((6, len(rows)))
        for batch in batches:
            x = batch.to_numpy(dtype=float) - middle
            seen = (~np.isnan(x)).astype(float)
            x = np.nan_to_num(x, nan=0.0)
            by_pair = (seen.T @ seen, x.T @ seen, seen.T @ x, (x * x).T @ seen, seen.T @ (x * x), x.T @ x)
            sums += np.stack([m[rows, cols] for m in by_pair])
        yield pd.DataFrame(
            {"i": rows.astype("int32"), "j": cols.astype("int32")}
            | dict(zip(("n", "sx", "sy", "sxx", "syy", "sxy"), sums))
        )

    narrow = df.select(*[F.col(c).cast("double").alias(c) for c in columns])
    totals = (
        narrow.mapInPandas(pair_sums, PAIR_SUMS)
        .groupBy("i", "j")
        .agg(*[F.sum(s).alias(s) for s in ("n", "sx", "sy", "sxx", "syy", "sxy")])
    )
    n = F.col("n")
    cov = n * F.col("sxy") - F.col("sx") * F.col("sy")
    vx = n * F.col("sxx") - F.col("sx") * F.col("sx")
    vy = n * F.col("syy") - F.col("sy") * F.col("sy")
    return totals.select("i", "j", "n", F.try_divide(cov, F.sqrt(F.greatest(vx * vy, F.lit(0.0)))).alias("r"))


def columns_to_drop(
    columns: list[str],
    pair_r: Mapping[tuple[int, int], float],
    target_r: Mapping[str, float | None],
    above: float = COLLINEAR_ABOVE,
) -> list[str]:
    """Which columns give way, decided over the correlation table in column order.

    Of two close columns the one nearer to the target stays, ties keep the earlier one; an earlier
    column that lost still pushes out later ones it is close to. Unknown target correlation loses
    against any known one when it belongs to the earlier column.
    """
    strength = {c: abs(r) if r is not None and r == r else float("nan") for c, r in target_r.items()}
    close: dict[int, list[int]] = {}
    for (later, earlier), r in pair_r.items():
        if r is not None and abs(r) > above:
            close.setdefault(earlier, []).append(later)
    gone: set[str] = set()
    for first in sorted(close):
        if columns[first] in gone:
            continue
        for second in sorted(close[first]):
            a, b = columns[first], columns[second]
            if b not in gone:
                gone.add(b if strength.get(a, 0.0) >= strength.get(b, 0.0) else a)
    return [c for c in columns if c in gone]


def multicollinear_columns(
    train: DataFrame, columns: list[str], label: str, above: float = COLLINEAR_ABOVE
) -> list[str]:
    """Names to drop; only the p*(p-1)/2 correlations above the limit reach the driver."""
    if len(columns) < 2:
        return []
    close = wide_correlations(train, columns).where(F.abs("r") > above).collect()
    target = {r["series"]: r["r"] for r in correlation_with_target(train, columns, label).collect()}
    return columns_to_drop(columns, {(r["i"], r["j"]): r["r"] for r in close}, target, above)

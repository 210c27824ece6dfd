"""Packed multinomial draws against single draws."""

import hashlib
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from tenura.operators import draws, resampling


def _position(b: int, i: int, n: int) -> int:
    return int(hashlib.md5(f"{b}:{i}".encode()).hexdigest()[:15], 16) % n


@pytest.mark.parametrize(("b", "low", "high", "n"), [(0, 0, 12_345, 12_345), (123, 99_990, 150_010, 777), (499, 5, 6, 36_000_000), (7, 0, 1, 1)])
def test_positions_are_the_hash_of_replicate_and_draw(b, low, high, n):
    assert draws.positions(b, low, high, n).tolist() == [_position(b, i, n) for i in range(low, high)]


@pytest.fixture()
def odd(spark):
    """Copies of ids, rows without an id, frequent scores, and scores that are NULL or NaN."""
    scores = [0.5, 0.5, 0.25, None, float("nan"), 0.75, 0.1]
    data = [(i // 3 if i % 10 == 0 else i if i % 11 else None, scores[i % 7] if i % 3 else i / 1000, (i * 7919 % 1000) / 1000, i % 2) for i in range(900)]
    return spark.createDataFrame(data, "row_id bigint, first double, second double, label int").repartition(5)


def _expected(rows: list, replicates: int) -> Counter:
    """Weights by (b, row_id): every copy of an id has the draws of all its copies."""
    ids = sorted(r["row_id"] for r in rows if r["row_id"] is not None)
    found = Counter()
    for b in range(replicates):
        for i in range(len(rows)):
            place = _position(b, i, len(rows))
            if place < len(ids):
                found[b, ids[place]] += 1
    return found


@pytest.mark.parametrize(("at_once", "block"), [(1 << 24, 1 << 25), (40, 600)])
def test_cells_of_packed_draws_equal_joined_rows(odd, monkeypatch, at_once, block):
    """In one run of draws and one block, and in many: offsets as well as counts."""
    monkeypatch.setattr(draws, "DRAWS_AT_ONCE", at_once)
    monkeypatch.setattr(draws, "BLOCK_NUMBERS", block)
    monkeypatch.setattr(draws, "STRIP_NUMBERS", 64)
    want = _expected(odd.collect(), 6)
    long = resampling.multinomial_weights(odd, 6)
    own = Counter()
    for r in long.collect():
        own[r["b"], r["row_id"]] += r["w"]
    assert own == want
    packed = resampling.multinomial_weights(odd, 6, packed=True)
    cells = lambda w: sorted(map(str, resampling.replicate_cells(odd, ["first", "second"], "label", w).drop("bucket").collect()))
    assert cells(packed) == cells(long)


def test_no_single_draw_leaves_its_task(spark):
    rows = spark.range(200_000).select(F.col("id").alias("row_id"))
    packed = resampling.multinomial_weights(rows, 4, packed=True)
    found = packed.records.select("b", F.length("data").alias("bytes")).collect()
    assert len(found) <= 4 * packed.blocks <= 100 and sum(r["bytes"] for r in found) < 4 * 200_000 * 0.4
    assert np.unique([r["b"] for r in found]).tolist() == [0, 1, 2, 3]


def test_no_rows(spark):
    none = spark.createDataFrame([], "row_id bigint, prob double, label int")
    weights = resampling.multinomial_weights(none, 3, packed=True)
    assert resampling.replicate_cells(none, ["prob"], "label", weights).count() == 0


def test_retention_flags_pass_over_a_written_table(spark, tiny):
    """The joined table is computed once, not for each of its averages, medians and counts."""
    from tenura.plans.queries import QUERIES

    plan = QUERIES["retention_flags"](spark, tiny)._jdf.queryExecution().optimizedPlan().toString()
    assert "o_custkey" not in plan and "Join" in plan

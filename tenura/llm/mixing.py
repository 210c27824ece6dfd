"""Mixing of sources along a curriculum: how many words of each source, of which documents, and when in training.

1. A source has a weight that changes over training (straight lines between knots, time 0 to 1). Its integral is the
   source's share of all words to train on. No source gives more than ``most`` times its own words; what it cannot give
   is shared among the others by weight, in rounds of one aggregate each, until none is above.
2. The documents of a source stand in the order of a digest of id and text. Each has an offset: words of the source that
   come before it, by sums of digest ranges and a running sum within a range. So the largest source is many tasks.
3. A source is read in that order, again from the start once it is used up, until its target is met. What a document
   gives follows from its offset alone; only the last document of a source gives a part of itself.
4. The cumulative demand of a source up to time t is its target times the integral of its weight. Inverting it at the
   words read so far gives the position of each copy in training; sorting by position by ranges gives the order.

Everything but the choice of the target level runs as SQL functions; the driver holds two sums a round.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window, functions as F

from .common import drop_written, written

Knots = Sequence[tuple[float, float]]
#: Weights over training (time, weight), repeating over the sources in their order; the integrals are 3, 1 and 2.
SCHEDULES: tuple[Knots, ...] = (((0.0, 4.0), (1.0, 2.0)), ((0.0, 0.5), (0.5, 1.0), (1.0, 1.5)), ((0.0, 2.0), (1.0, 2.0)))
#: Share of all words to train on, and how often a source may be read.
SHARE, MOST = 1.5, 2
#: Documents of a digest range that a task adds up, on average.
RANGE_ROWS = 100_000
KEY = ["absent", "source"]


def integrals(knots: Knots) -> list[float]:
    """The integral of the weight from the start up to each knot."""
    times = [t for t, _ in knots]
    if len(knots) < 2 or times[0] != 0 or times[-1] != 1 or any(b <= a for a, b in zip(times, times[1:])) or any(w < 0 for _, w in knots):
        raise ValueError("a schedule goes from time 0 to time 1 with weights that are not negative")
    out = [0.0]
    for (t0, w0), (t1, w1) in zip(knots, knots[1:]):
        out.append(out[-1] + (t1 - t0) * (w0 + w1) / 2)
    return out


def _sources(sums: DataFrame, schedules: Sequence[Knots]) -> DataFrame:
    """Each source with its size, weight and schedule. Ranks come from ordered ranges and their counts, not one window."""
    sized = sums.groupBy(*KEY).agg(F.sum("words").alias("source_size"))
    ordered = written(sized.orderBy(*KEY).withColumn("range", F.spark_partition_id()))
    before = ordered.groupBy("range").agg(F.count("*").alias("count"))
    before = before.select("range", (F.sum("count").over(Window.orderBy("range")) - F.col("count")).alias("before"))  # a row for each range
    place = F.col("before") + F.row_number().over(Window.partitionBy("range").orderBy(*KEY)) - 1
    numbered = ordered.join(before, "range").withColumn("schedule", F.pmod(place, F.lit(len(schedules))).cast("int"))
    plans = F.array(*[F.struct(F.lit(integrals(k)[-1]).alias("weight"), *[F.array(*[F.lit(float(v)) for v in values]).alias(name) for name, values in zip(("times", "weights", "sums"), (*zip(*k), integrals(k)))]) for k in schedules])
    return written(numbered.select(*KEY, "source_size", plans[F.col("schedule")].alias("plan")).select(*KEY, "source_size", "plan.*"))


def _targets(sources: DataFrame, share: float, most: int) -> DataFrame:
    """Sources with ``target``: by weight, no more than ``most`` times their size, the excess shared again."""
    total = sources.agg(F.sum("source_size")).first()[0] or 0
    rest, weight, held = share * total, None, -1
    level: Column = F.lit(False)
    while True:
        row = sources.agg(F.sum(F.when(~level, F.col("weight"))), F.sum(F.when(level, F.col("source_size"))), F.count(F.when(level, 1))).first()
        if row[2] == held:
            break
        held, weight, rest = row[2], row[0], share * total - most * (row[1] or 0)
        if not weight:  # nothing left to share: every source is at its most
            break
        level = F.lit(most) * F.col("source_size") * F.lit(weight) < F.col("weight") * F.lit(float(rest))
    full = (F.lit(most) * F.col("source_size")).cast("double")
    own = F.col("weight") * F.lit(float(rest)) / F.lit(weight) if weight else full
    return sources.withColumn("target", F.when(level, full).otherwise(own))


def _position(words: Column, quota: Column) -> Column:
    """The time at which a source has given so many words of its quota: its cumulative weight, inverted."""
    due = words.cast("double") / quota.cast("double") * F.col("weight")
    knot = F.greatest(F.lit(1), F.least(F.size(F.filter("sums", lambda s: s <= due)), F.size("sums") - 1))
    at = lambda name, step=0: F.element_at(name, (knot + step).cast("int"))
    left = due - at("sums")
    slope = (at("weights", 1) - at("weights")) / (at("times", 1) - at("times"))
    root = F.sqrt(F.greatest(F.lit(0.0), at("weights") * at("weights") + 2 * slope * left))
    return at("times") + F.when(left > 0, 2 * left / (at("weights") + root)).otherwise(0.0)


def assign(docs: DataFrame, schedules: Sequence[Knots] = SCHEDULES, share: float = SHARE, most: int = MOST,
           id_column: str = "doc_id", text_column: str = "text", source_column: str = "source") -> DataFrame:
    """doc_id, source, digest, size, source_size, target, taken, copies (epoch, words, position) of every row.

    Null and empty texts have size 0 and are not taken; null ids are the empty text in the digest. A null source is a
    source that comes last. Rows that agree in id, text and source are documents each, and any of them may be the one
    that is taken in part. Where no source has words, or all weights are zero, targets are 0 or what sources can give.
    An empty table gives an empty table; other columns are not read, whatever their names.
    """
    text = F.coalesce(docs[text_column].cast("string"), F.lit(""))
    digest = F.md5(F.concat_ws(":", F.coalesce(docs[id_column].cast("string"), F.lit("")), text).cast("binary"))
    size = F.regexp_count(text, F.lit(r"[^\x20\x09-\x0D]+")).cast("long")
    rows = docs.select(docs[id_column].alias("doc_id"), docs[source_column].cast("string").alias("source"), size.alias("size"), digest.alias("digest"))
    rows = rows.select("doc_id", F.col("source").isNull().alias("absent"), F.coalesce("source", F.lit("")).alias("source"), "size", "digest")
    # equal rows are one until the end
    rows = written(rows.groupBy(*rows.columns).agg(F.count("*").alias("equal")))
    bits = min(31, int(rows.count() // RANGE_ROWS).bit_length())
    part = F.shiftright(F.conv(F.substring("digest", 1, 8), 16, 10).cast("long"), 32 - bits)
    rows = rows.withColumn("part", part)
    sums = written(rows.groupBy(*KEY, "part").agg(F.sum(F.col("size") * F.col("equal")).alias("words")))
    sources = _targets(_sources(sums, schedules), share, most)
    before = F.sum("words").over(Window.partitionBy(*KEY).orderBy("part")) - F.col("words")
    starts = sums.select(*KEY, "part", before.alias("before")).join(sources, KEY)

    inside = Window.partitionBy(*KEY, "part").orderBy("digest", "doc_id", "size").rowsBetween(Window.unboundedPreceding, -1)
    placed = rows.withColumn("inside", F.coalesce(F.sum(F.col("size") * F.col("equal")).over(inside), F.lit(0))).join(starts, [*KEY, "part"])
    placed = placed.withColumn("number", F.explode(F.sequence(F.lit(0).cast("long"), F.col("equal") - 1)))
    placed = placed.withColumn("offset", F.col("before") + F.col("inside") + F.col("number") * F.col("size")).withColumn("quota", F.floor(F.col("target") + 0.5))
    copies = []
    for epoch in range(most):
        begin = F.col("offset") + epoch * F.col("source_size")
        words = F.least(F.greatest(F.col("quota") - begin, F.lit(0)), F.col("size"))
        copies.append(F.when(words > 0, F.struct(F.lit(epoch).alias("epoch"), words.alias("words"), _position(begin, F.col("quota")).alias("position"))))
    placed = placed.withColumn("copies", F.filter(F.array(*copies), lambda c: c.isNotNull()))
    taken = F.aggregate("copies", F.lit(0).cast("long"), lambda s, c: s + c["words"])
    return placed.select("doc_id", F.when(~F.col("absent"), F.col("source")).alias("source"), "digest", "size", "source_size", "target", taken.alias("taken"), "copies")


def training_order(assigned: DataFrame) -> DataFrame:
    """One row for each copy (doc_id, source, epoch, words, position), sorted by position over ranges; ties by digest."""
    copies = assigned.select("doc_id", "source", "digest", F.explode("copies").alias("copy")).select("doc_id", "source", "digest", "copy.*")
    return copies.orderBy("position", "digest", "epoch").drop("digest")


def mix_totals(assigned: DataFrame) -> DataFrame:
    """Every document of the mix with how often and when it is first read, in training order; those not read come last."""
    first = F.element_at("copies", 1)["position"]
    rows = assigned.select("doc_id", "size", "source_size", "target", "taken", F.size("copies").cast("long").alias("n_copies"), F.when(F.size("copies") > 0, first).alias("position"), "digest")
    return rows.orderBy(F.asc_nulls_last("position"), "digest").drop("digest")


def mixing_sql(schedules: Sequence[Knots] = SCHEDULES, share: float = SHARE, most: int = MOST) -> str:
    """The same over ``documents`` as DuckDB SQL."""
    lists = lambda values: "[" + ", ".join("[" + ", ".join(f"{float(v)!r}::double" for v in row) + "]" for row in values) + "]"
    times, weights = ([[knot[i] for knot in s] for s in schedules] for i in (0, 1))
    sums = [integrals(s) for s in schedules]
    give = lambda e: f"least(greatest(quota - (off + {e} * source_size), 0), size)"
    return f"""
with docs as (select doc_id, source, cast(coalesce(len(regexp_extract_all(text, '[^\\x20\\x09-\\x0D]+')), 0) as bigint) as size,
    md5(coalesce(cast(doc_id as varchar), '') || ':' || coalesce(text, '')) as digest from documents),
sized as (select source, cast(sum(size) as bigint) as source_size from docs group by source),
numbered as (select *, (row_number() over (order by source nulls last) - 1) % {len(schedules)} + 1 as s from sized),
weighed as (select source, source_size, {lists(times)}[s] as times, {lists(weights)}[s] as weights, {lists(sums)}[s] as sums, {lists([[x[-1]] for x in sums])}[s][1] as weight from numbered),
ordered as (select *, row_number() over (order by source_size / weight, source nulls last) as j, {share} * (sum(source_size) over ())::double as total from weighed),
levels as (select *, total - {most} * coalesce(sum(source_size) over (order by j rows between unbounded preceding and 1 preceding), 0)::double as rest,
    sum(weight) over (order by j rows between current row and unbounded following) as others from ordered),
level as (select j as first_open, rest as open_rest, others as open_weight from levels where not {most} * source_size * others < weight * rest order by j limit 1),
sources as (select source as s, source_size, times, weights, sums, weight, case when j < first_open then ({most} * source_size)::double else weight * open_rest / open_weight end as target from levels, level),
placed as (select *, cast(floor(target + 0.5) as bigint) as quota, cast(sum(size) over (partition by source order by digest, doc_id, size rows unbounded preceding) - size as bigint) as off
    from docs join sources on source is not distinct from s),
taken as (select *, cast({' + '.join(map(give, range(most)))} as bigint) as taken, cast({' + '.join(f'case when {give(e)} > 0 then 1 else 0 end' for e in range(most))} as bigint) as n_copies,
    off::double / quota::double * weight as due from placed),
found as (select *, greatest(1, least(len(list_filter(sums, lambda x: x <= due)), len(sums) - 1)) as k from taken),
inverse as (select *, due - sums[k] as rest, weights[k] as w, (weights[k + 1] - weights[k]) / (times[k + 1] - times[k]) as slope from found)
select doc_id, size, source_size, target, taken, n_copies,
    case when n_copies > 0 then times[k] + case when rest > 0 then 2 * rest / (w + sqrt(greatest(0, w * w + 2 * slope * rest))) else 0 end end as position from inverse"""

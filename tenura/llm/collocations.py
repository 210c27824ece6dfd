"""Phrase collocations by counting quotient filters.

1. Words get ids of w bits: a hash of language and word, cut to the width at which no two words of the corpus share an
   id. All words are counted by id, and an id that stands for two words asks for another seed, so ids are lossless.
2. A phrase of k words is k lanes of w bits. An invertible permutation (a Feistel network over the lanes) spreads them
   evenly; the leading bits of the first lane are range and quotient, all other bits the remainder, kept in full.
3. A task counts its phrases in a filter: entries sorted by quotient and remainder, one bit for each quotient (is it
   taken), one bit for each entry (does it continue a run), the remainder's bytes, one byte of count and the counts that
   need more. It is sent as one block for each range, and the sorted blocks of a range are merged in one task. Ranges
   grow in number with the words of the corpus, so a range is of bounded size.
4. Every part of a phrase is as frequent as the phrase. Phrases with a word, or with a pair of words, that is too rare
   are not counted. Tasks know the frequent ones from a bitmap of at most 64 MB; false hits cost space, not results.
5. Scores, cuts, contained phrases and ranks are SQL over the frequent phrases; ids turn into words by joins.
"""

from __future__ import annotations

import struct
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window, functions as F

from .common import bit_set, drop_written, flat_bytes, in_bit_set, pieces, sorted_groups, written

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
#: Bytes of text handled at once, entries of a task's filter, occurrences for which a range is made.
TEXT_BYTES, SHARD_ENTRIES, RANGE_ENTRIES = 2 << 20, 1_500_000, 2_000_000
#: Bits of a bitmap at most (64 MB).
BITMAP_BITS = 29
#: Words of more bytes are hashed one by one.
LONG_WORD = 256
#: Parts of a language that are ranked before the language is.
RANK_PARTS = 64
WORD, BLANK, SPLIT = 0, 1, 2
_KIND = np.zeros(256, np.uint8)
_KIND[[32, 9]] = BLANK
_KIND[[ord(c) for c in ".,;:!?"] + list(range(10, 14))] = SPLIT
_FOLD = np.arange(256, dtype=np.uint8)
_FOLD[65:91] += 32
_ROUND = np.random.default_rng(77_031).integers(0, 2**63, (2, 5), dtype=np.uint64) * 2 + 1


def mix(x: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit integers that spreads every bit."""
    x = (x ^ (x >> np.uint64(32))) * np.uint64(0xD6E8FEB86659FD93)
    x = (x ^ (x >> np.uint64(32))) * np.uint64(0xD6E8FEB86659FD93)
    return x ^ (x >> np.uint64(32))


def spans(data: np.ndarray, starts: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Begin, end and text of every word, and whether it stands in the same piece as the word before it."""
    kind = _KIND[data]
    word = kind == WORD
    edge = np.zeros(len(data) + 1, bool)
    edge[starts] = True
    begin = np.flatnonzero(word & (edge[:-1] | ~np.concatenate([[False], word[:-1]])))
    end = np.flatnonzero(word & (edge[1:] | ~np.concatenate([word[1:], [False]]))) + 1
    text = np.searchsorted(starts, begin, "right") - 1
    piece = np.cumsum(kind == SPLIT)[begin] if len(begin) else begin
    joined = np.zeros(len(begin), bool)
    joined[1:] = (text[1:] == text[:-1]) & (piece[1:] == piece[:-1])
    return begin, end, text, joined


def word_ids(data: np.ndarray, begin: np.ndarray, end: np.ndarray, salt: np.ndarray, seed: int) -> np.ndarray:
    """64 bits for each word and the salt of its language, eight bytes at a time."""
    import xxhash

    length = end - begin
    wide = np.concatenate([data, np.zeros(8, np.uint8)])
    eight = np.ndarray((len(data) + 1,), "<u8", wide, strides=(1,))
    out = mix(salt + length.astype(np.uint64))
    live, at = np.flatnonzero(length <= LONG_WORD), 0
    while len(live):
        rest = np.minimum(length[live] - at, 8).astype(np.uint64)
        part = eight[begin[live] + at] & (np.uint64(0xFFFFFFFFFFFFFFFF) >> (np.uint64(64) - rest * np.uint64(8)))
        out[live] = mix(out[live] ^ part)
        at += 8
        live = live[length[live] > at]
    for i in np.flatnonzero(length > LONG_WORD):
        own = np.array([xxhash.xxh64_intdigest(data[begin[i] : end[i]].tobytes(), seed)], np.uint64)
        out[i] = mix(out[i : i + 1] ^ own)[0]
    return mix(out)


def _salts(langs: list[str], seed: int) -> np.ndarray:
    import xxhash

    known = {lang: xxhash.xxh64_intdigest(lang.encode(), seed) for lang in set(langs)}
    return np.array([known[lang] for lang in langs], np.uint64)


def _texts(batches: Iterator[pa.RecordBatch], seed: int):
    for batch, texts in pieces(batches, "text", TEXT_BYTES):
        data, starts = flat_bytes(texts)
        data = _FOLD[data]
        langs = batch.column("lang").to_pylist()
        begin, end, text, joined = spans(data, starts)
        yield langs, data, begin, end, text, joined, word_ids(data, begin, end, _salts(langs, seed)[text], seed)


def _words(seed: int):
    """Words with their counts in some texts of the task."""

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts: dict[int, int] = {}
        fresh: dict[int, tuple[str, str]] = {}

        def rows() -> pa.RecordBatch:
            ids = np.fromiter(fresh, np.uint64, len(fresh)).view(np.int64)
            columns = [pa.array(ids), pa.array([x[0] for x in fresh.values()], pa.string()), pa.array([x[1] for x in fresh.values()], pa.string()), pa.array([counts[i] for i in fresh], pa.int64())]
            return pa.RecordBatch.from_arrays(columns, ["id", "lang", "word", "n"])

        size = 0
        for langs, data, begin, end, text, _, ids in _texts(batches, seed):
            distinct, first, n = np.unique(ids, return_index=True, return_counts=True)
            raw = data.tobytes()
            for i, at, c in zip(distinct.tolist(), first.tolist(), n.tolist(), strict=True):
                # two words of one id within a task differ in their rows of other tasks or texts; see the check below
                word = raw[begin[at] : end[at]].decode()
                if i in counts and fresh[i] == (langs[text[at]], word):
                    counts[i] += c
                    continue
                if i in counts:
                    yield rows()
                    counts, fresh, size = {}, {}, 0
                counts[i], fresh[i] = c, (langs[text[at]], word)
                size += 100 + len(word)
            if size > 48 << 20:
                yield rows()
                counts, fresh, size = {}, {}, 0
        if counts:
            yield rows()

    return work


def permute(lanes: list[np.ndarray], width: int, back: bool = False) -> list[np.ndarray]:
    """A bijection of k lanes of ``width`` bits; ``back`` inverts it."""
    lanes, mask = list(lanes), np.uint64(2**width - 1)
    steps = [(r, i) for r in range(len(_ROUND)) for i in range(len(lanes))]
    for r, i in reversed(steps) if back else steps:
        lanes[i] = lanes[i] ^ (mix(lanes[i - 1] + _ROUND[r, i]) & mask)
    return lanes


def counted(lanes: list[np.ndarray], n: np.ndarray | None) -> tuple[list[np.ndarray], np.ndarray]:
    """Distinct entries in the order of their lanes, with their counts added up (n None: one each)."""
    order = np.argsort(lanes[0], kind="stable")
    for again in (False, True):
        ordered = [x[order] for x in lanes]
        same = ordered[0][1:] == ordered[0][:-1]
        equal = same.copy()
        for x in ordered[1:]:
            equal &= x[1:] == x[:-1]
        if again or not (same & ~equal).any():
            break
        order = np.lexsort(lanes[::-1])
    first = np.flatnonzero(np.concatenate([[True], ~equal])) if len(order) else np.zeros(0, np.int64)
    total = np.diff(np.append(first, len(order))) if n is None else np.add.reduceat(n[order], first) if len(first) else n
    return [x[first] for x in ordered], total


def _pack(x: np.ndarray, bits: int) -> bytes:
    return np.ascontiguousarray(x.astype("<u8").view(np.uint8).reshape(-1, 8)[:, : -(-bits // 8)]).tobytes()


def _unpack(raw: np.ndarray, n: int, bits: int) -> np.ndarray:
    out = np.zeros((n, 8), np.uint8)
    out[:, : -(-bits // 8)] = raw.reshape(n, -1)
    return out.reshape(-1).view("<u8").astype(np.uint64)


def filter_block(lanes: list[np.ndarray], n: np.ndarray, width: int, skip: int) -> bytes:
    """A quotient filter of sorted distinct entries that agree in the first ``skip`` bits."""
    quotient_bits = min(width - skip, max(0, int(len(n) - 1).bit_length()))
    low = width - skip - quotient_bits
    quotient = (lanes[0] >> np.uint64(low)) & np.uint64(2**quotient_bits - 1) if quotient_bits else np.zeros(len(n), np.uint64)
    taken = np.zeros(1 << quotient_bits, bool)
    taken[quotient.astype(np.int64)] = True
    more = np.concatenate([[False], quotient[1:] == quotient[:-1]])
    large = n[n >= 255]
    parts = [struct.pack("<IBI", len(n), quotient_bits, len(large)), np.packbits(taken).tobytes(), np.packbits(more).tobytes(), _pack(lanes[0] & np.uint64(2**low - 1), low)]
    parts += [_pack(x, width) for x in lanes[1:]]
    return b"".join([*parts, np.minimum(n, 255).astype(np.uint8).tobytes(), large.astype("<u8").tobytes()])


def read_block(block: bytes, k: int, width: int, skip: int, part: int) -> tuple[list[np.ndarray], np.ndarray]:
    """The entries of a filter, sorted, and their counts."""
    size, quotient_bits, large = struct.unpack_from("<IBI", block)
    raw, at = np.frombuffer(block, np.uint8), struct.calcsize("<IBI")
    low = width - skip - quotient_bits

    def take(n: int) -> np.ndarray:
        nonlocal at
        at += n
        return raw[at - n : at]

    taken = np.unpackbits(take(-(-(1 << quotient_bits) // 8)), count=1 << quotient_bits)
    more = np.unpackbits(take(-(-size // 8)), count=size)
    quotient = np.flatnonzero(taken).astype(np.uint64)[np.cumsum(1 - more.astype(np.int64)) - 1]
    head = np.uint64(part) << np.uint64(quotient_bits) | quotient
    # a shift by all 64 bits is not defined; it only occurs where nothing stands above
    lanes = [(head << np.uint64(low) if low < 64 else head) | _unpack(take(size * -(-low // 8)), size, low)]
    lanes += [_unpack(take(size * -(-width // 8)), size, width) for _ in range(k - 1)]
    n = take(size).astype(np.int64)
    n[n == 255] = take(8 * large).view("<u8").astype(np.int64)
    return lanes, n


def _known(bitmap: np.ndarray, bits: int, lane: np.ndarray, width: int) -> np.ndarray:
    return in_bit_set(bitmap, lane >> np.uint64(width - bits))


def _phrases(sizes: tuple[int, ...], seed: int, width: int, range_bits: int, words, pairs):
    """Filters of the phrases of some sizes, cut by range. ``pairs``: None, or the bitmap of frequent pairs."""

    def blocks(k: int, held: list[list[np.ndarray]]) -> Iterator[pa.RecordBatch]:
        lanes, n = counted([np.concatenate(x) for x in zip(*held, strict=True)], None)
        part = (lanes[0] >> np.uint64(width - range_bits)).astype(np.int64) if range_bits else np.zeros(len(n), np.int64)
        cuts = np.append(np.flatnonzero(np.concatenate([[True], part[1:] != part[:-1]])), len(n)) if len(n) else [0]
        made = [filter_block([x[a:b] for x in lanes], n[a:b], width, range_bits) for a, b in zip(cuts[:-1], cuts[1:], strict=True)]
        if made:
            yield pa.RecordBatch.from_arrays([pa.array([k] * len(made), pa.int32()), pa.array(part[cuts[:-1]]), pa.array(made, pa.binary())], ["k", "part", "block"])

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known, known_pairs = words.value, pairs and pairs.value
        held: dict[int, list[list[np.ndarray]]] = {k: [] for k in sizes}
        size = dict.fromkeys(sizes, 0)
        for *_, joined, ids in _texts(batches, seed):
            ids = ids >> np.uint64(64 - width)
            good = _known(*known, ids, width)
            # run[i]: words i-1 and i follow each other and may be part of a phrase
            run = joined & good & np.concatenate([[False], good[:-1]])
            if known_pairs:
                at = np.flatnonzero(run)
                run[at] = _known(*known_pairs, permute([ids[at - 1], ids[at]], width)[0], width)
            start = run[1:]
            for k in range(2, max(sizes) + 1):
                start = start if k == 2 else start[:-1] & run[k - 1 :]
                if k in sizes:
                    at = np.flatnonzero(start)
                    held[k].append(permute([ids[at + j] for j in range(k)], width))
                    size[k] += len(at)
                    if size[k] > SHARD_ENTRIES:
                        yield from blocks(k, held[k])
                        held[k], size[k] = [], 0
        for k in sizes:
            if size[k]:
                yield from blocks(k, held[k])

    return work


def _merged(width: int, range_bits: int, least: int):
    """The sorted filters of a range as one; the phrases that occur often enough, turned back into ids."""

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for group in sorted_groups(batches, ["k", "part"]):
            k, part = group.column("k")[0].as_py(), group.column("part")[0].as_py()
            read = [read_block(b.as_buffer().to_pybytes(), k, width, range_bits, part) for b in group.column("block")]
            lanes, n = counted([np.concatenate(x) for x in zip(*[r[0] for r in read], strict=True)], np.concatenate([r[1] for r in read]))
            often = n >= least
            lanes, n = [x[often] for x in lanes], n[often]
            ids = np.stack(permute(lanes, width, back=True), axis=1).astype(np.int64).ravel()
            yield pa.RecordBatch.from_arrays([pa.ListArray.from_arrays(pa.array(np.arange(len(n) + 1) * k, pa.int32()), pa.array(ids)), pa.array(lanes[0].astype(np.int64)), pa.array(n)], ["ids", "lane", "n"])

    return work


def _bitmap(rows: DataFrame, width: int, column: str):
    """(bitmap, bits) of the leading bits of a column of ``width`` bits; broadcast."""
    bits = min(BITMAP_BITS, width, max(10, int(16 * rows.count()).bit_length()))
    slots = rows.select(F.shiftrightunsigned(F.col(column), width - bits).alias("slot"))
    return rows.sparkSession.sparkContext.broadcast((bit_set(slots, bits), bits))


def _range_bits(entries: int, width: int) -> int:
    return min(width, 31, int(entries // RANGE_ENTRIES).bit_length())


def _vocabulary(docs: DataFrame) -> tuple[DataFrame, int, int]:
    """(id, lang, word, n) of every word, the seed, and the width at which ids differ; id has that width."""
    seed, width = 0, None
    while True:
        found = written(docs.mapInArrow(_words(seed), "id long, lang string, word string, n long"))
        # text of any length is aggregated once: ids of 64 bits that hold two words are looked for in the result
        words = written(found.groupBy("id").agg(F.sum("n").alias("n"), F.min(F.struct("lang", "word")).alias("one"), F.max(F.struct("lang", "word")).alias("two")))
        drop_written(found)
        if words.where("one <> two").isEmpty():
            break
        drop_written(words)
        seed += 1
    width = min(64, 4 + 2 * int(words.count() + 1).bit_length())
    while width < 64 and not words.groupBy(F.shiftrightunsigned("id", 64 - width)).count().where("count > 1").isEmpty():
        width = min(64, width + 4)
    return words.select(F.shiftrightunsigned("id", 64 - width).alias("id"), "one.lang", "one.word", "n"), seed, width


def collocations(docs: DataFrame, least: int = 100, longest: int = 5, top: int = 2000, lang_column: str = "lang", text_column: str = "text") -> DataFrame:
    """lang, rank, phrase, a, l, r, n, score: the first ``top`` phrases of 2 to ``longest`` words of each language.

    Null and empty texts hold no words; a null language is ``und``. Repeated rows count each. Ties go by count, then by
    phrase; equal cuts to the shortest first part. An empty table gives an empty table; other columns are not read,
    whatever their names.
    """
    if not 2 <= longest <= _ROUND.shape[1]:
        raise ValueError("longest must be 2 to 5")
    spark = docs.sparkSession
    source = docs.select(F.coalesce(docs[lang_column].cast("string"), F.lit("und")).alias("lang"), docs[text_column].cast("string").alias("text"))
    words, seed, width = _vocabulary(source)
    totals = written(words.groupBy("lang").agg(F.sum("n").alias("n")))
    often = written(words.where(F.col("n") >= least))
    known = _bitmap(often, width, "id")

    def phrases(sizes: tuple[int, ...], occurrences: int, pairs) -> DataFrame:
        bits = _range_bits(occurrences, width)
        blocks = source.mapInArrow(_phrases(sizes, seed, width, bits, known, pairs), "k int, part long, block binary")
        blocks = blocks.repartition("k", "part").sortWithinPartitions("k", "part")
        return written(blocks.mapInArrow(_merged(width, bits, least), "ids array<long>, lane long, n long"))

    grams = two = phrases((2,), often.agg(F.coalesce(F.sum("n"), F.lit(0))).first()[0], None)
    if longest > 2:
        # a phrase of three to five words has a frequent pair at its start
        pairs = _bitmap(two, width, "lane")
        grams = two.unionByName(phrases(tuple(range(3, longest + 1)), two.agg(F.coalesce(F.sum("n"), F.lit(0))).first()[0], pairs))
    ids = F.col("ids")
    frequent = grams.select("ids", F.col("n").alias("f")).unionByName(often.select(F.array("id").alias("ids"), F.col("n").alias("f")))
    candidates = grams.select("ids", F.col("n").alias("a"))

    # a phrase inside a longer one of its own count stands inside one of a single word more
    parts = candidates.where(F.size("ids") > 2).select(F.explode(F.array(F.slice(ids, F.lit(1), F.size(ids) - 1), F.slice(ids, F.lit(2), F.size(ids) - 1))).alias("ids"), "a")
    longer = parts.groupBy("ids").agg(F.max("a").alias("longer"))
    kept = candidates.join(longer, "ids", "left").where("longer is null or longer < a").select("ids", "a")
    # the words of each phrase, in place
    spelled = kept.select("ids", "a", F.posexplode("ids").alias("at", "id")).join(often.select("id", "lang", "word"), "id")
    spelled = spelled.groupBy("ids", "a", "lang").agg(F.sort_array(F.collect_list(F.struct("at", "word"))).alias("words"))
    spelled = written(spelled.select("ids", "a", "lang", F.concat_ws(" ", F.col("words.word")).alias("phrase")).join(totals, "lang"))

    cut = spelled.select("ids", "a", "n", F.explode(F.sequence(F.lit(1), F.size("ids") - 1)).alias("k"))
    cut = cut.select("ids", "a", "n", "k", F.slice(ids, F.lit(1), F.col("k")).alias("first"), F.slice(ids, F.col("k") + 1, F.size(ids) - F.col("k")).alias("rest"))
    cut = cut.join(frequent.select(ids.alias("first"), F.col("f").alias("l")), "first").join(frequent.select(ids.alias("rest"), F.col("f").alias("r")), "rest")
    score: Column = F.expr("cast(1000 * (cast(a as decimal(19,0)) * cast(n as decimal(19,0))) as decimal(38,0)) div (cast(l as decimal(19,0)) * cast(r as decimal(19,0)))")
    lowest = cut.select("ids", score.alias("score"), "k", "l", "r").groupBy("ids").agg(F.min(F.struct("score", "k", "l", "r")).alias("cut"))
    scored = spelled.join(lowest, "ids").select("lang", "phrase", "a", "cut.l", "cut.r", "n", "cut.score")

    order = [F.desc("score"), F.desc("a"), F.asc("phrase")]
    scored = scored.withColumn("part", F.pmod(F.xxhash64("phrase"), F.lit(RANK_PARTS)))
    first = scored.withColumn("rank", F.row_number().over(Window.partitionBy("lang", "part").orderBy(*order))).where(F.col("rank") <= top)
    ranked = first.withColumn("rank", F.row_number().over(Window.partitionBy("lang").orderBy(*order)).cast("long")).where(F.col("rank") <= top)
    return ranked.select("lang", "rank", "phrase", "a", "l", "r", "n", "score")


def collocations_sql(least: int = 100, longest: int = 5, top: int = 2000) -> str:
    """The same over ``documents`` as DuckDB SQL."""
    return f"""
with pieces as (select coalesce(lang, 'und') as lang, unnest(string_split_regex(translate(coalesce(text, ''), '{UPPER}', '{LOWER}'), '[.,;:!?\\x0A-\\x0D]')) as piece from documents),
tokens as (select lang, regexp_extract_all(piece, '[^\\x20\\x09]+') as ws from pieces),
spread as (select lang, ws, k, unnest(range(1, len(ws) - k + 2)) as i from (select lang, ws, unnest(range(1, {longest} + 1)) as k from tokens)),
grams as materialized (select lang, k, array_to_string(ws[i:i + k - 1], ' ') as phrase, count(*) as f from spread group by all),
totals as (select lang, sum(f) as n from grams where k = 1 group by lang),
frequent as materialized (select lang, k, phrase, string_split(phrase, ' ') as ws, f from grams where f >= {least}),
parts as (select lang, k - 1 as k, array_to_string(ws[j:j + k - 2], ' ') as phrase, f from (select *, unnest([1, 2]) as j from frequent where k > 2)),
longer as (select lang, phrase, max(f) as f from parts group by all),
kept as (select c.* from frequent c left join longer on longer.lang = c.lang and longer.phrase = c.phrase where c.k > 1 and coalesce(longer.f, 0) < c.f),
cuts as (select lang, phrase, f, k, ws, unnest(range(1, k)) as c from kept),
scores as (select cuts.lang, cuts.phrase, cuts.f as a, c, l.f as l, r.f as r, cast(n as bigint) as n,
        cast((1000::hugeint * cuts.f::hugeint * n::hugeint) // (l.f::hugeint * r.f::hugeint) as bigint) as score
    from cuts join frequent l on l.lang = cuts.lang and l.phrase = array_to_string(cuts.ws[1:c], ' ')
    join frequent r on r.lang = cuts.lang and r.phrase = array_to_string(cuts.ws[c + 1:], ' ')
    join totals on totals.lang = cuts.lang),
lowest as (select *, row_number() over (partition by lang, phrase order by score, c) as place from scores),
ranked as (select lang, row_number() over (partition by lang order by score desc, a desc, phrase) as rank, phrase, a, l, r, n, score from lowest where place = 1)
select lang, cast(rank as bigint) as rank, phrase, a, l, r, n, score from ranked where rank <= {top}"""

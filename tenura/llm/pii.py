"""Personal data by weak supervision, in DataFrame and SQL functions only.

Base matches of four kinds always count. Wider candidates (spelled-out addresses, local phone numbers, and base matches
that fail their check) are voted on by labelers: the kind's own check, a gazetteer, words just before, how the span is
bounded, and a base match close by. Expectation-maximisation over the counts of all vote patterns estimates how reliable
each labeler is; its probabilities train the final span classifier, a logistic regression on votes and kind. Vote
patterns are a table of fixed size whatever the corpus, so only that table reaches the driver.
"""

from __future__ import annotations

from pyspark.ml.classification import LogisticRegression
from pyspark.ml.feature import VectorAssembler
from pyspark.sql import Column, DataFrame, functions as F

from .common import written

KINDS = ("email", "ip", "card", "phone")
#: Base patterns, in a form that never scans a run of characters twice; the matches are those of the plain patterns
#: [A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+, [0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+), [0-9]([\x20-]?[0-9])+ and
#: \+[0-9][\x20().0-9-]+[0-9] that can pass their checks. A match begins where a run begins or the last match ended.
PATTERNS = {
    "email": r"(?:(?<![A-Za-z0-9._%+-])|\G)[A-Za-z0-9._%+-]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++",
    "ip": r"(?:(?<![0-9])|\G)[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++",
    "card": r"[0-9](?:[\x20-]?[0-9]){13,}+",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}
#: Wider candidates: kind and pattern.
WIDER = (
    ("email", r"(?<![A-Za-z0-9._%+-])[A-Za-z0-9._%+-]{1,64}+ ?[\[(] ?(?:at|AT) ?[\])] ?[A-Za-z0-9-]{1,63}+(?: ?(?:\.|[\[(] ?(?:dot|DOT) ?[\])]) ?[A-Za-z0-9-]{1,63}+){1,8}"),
    ("phone", r"(?<![0-9+.-])(?:\([0-9]{3}\) ?|[0-9]{3}[ .-])[0-9]{3}[ .-][0-9]{4}(?![0-9])"),
)
NEAR_WORDS = {
    "email": r"(?i)(?:mail|contact|write|address|kontakt|correo|courriel)\W{0,3}$",
    "ip": r"(?i)(?:\bip|host|server|address|client|adresse)\W{0,3}$",
    "card": r"(?i)(?:card|visa|credit|karte|carte|tarjeta|account)\W{0,3}$",
    "phone": r"(?i)(?:phone|tel|call|fax|mobile|cell|telefon|t[eé]l[eé]phone|tel[eé]fono)\W{0,3}$",
}
AGAINST = r"(?i)(?:version|isbn|issn|page|section|figure|table|no|nr|id|order|invoice|release)\W{0,3}$"
#: Top-level domains and first digits that the gazetteer labeler knows.
TOP_LEVEL = ("com", "org", "net", "edu", "gov", "info", "io", "de", "fr", "es", "uk", "eu", "it", "nl", "ch", "at")
CARD_STARTS = ("4", "51", "52", "53", "54", "55", "34", "37", "6011", "65", "35", "36", "38")
LABELERS = ("check", "gazetteer", "words", "bounds", "company")
#: Code points before and after a span that labelers look at, and the distance of a neighbour.
AROUND, COMPANY = 24, 80
BLOCK = 512
CUT = 0.5


def _prefix_sums(values: Column) -> Column:
    """0 and the running totals of an array of numbers, in blocks, so a text may have very many matches."""
    n = F.size(values)

    def block(b: Column) -> Column:
        base = F.aggregate(F.slice(values, F.lit(1), b * BLOCK), F.lit(0).cast("long"), lambda t, x: t + x)
        return F.slice(F.aggregate(F.slice(values, b * BLOCK + 1, F.lit(BLOCK)), F.array(base), lambda t, x: F.concat(t, F.array(F.element_at(t, -1) + x))), 1, F.lit(BLOCK))

    return F.flatten(F.transform(F.sequence(F.lit(0), F.floor(n / BLOCK).cast("int")), block))


def with_matches(docs: DataFrame, text: Column, searches: list[tuple[str, Column, str]]) -> DataFrame:
    """The input and, for each (name, condition, pattern), the leftmost non-overlapping matches in texts that meet the
    condition, as array<struct<start, end, value, before, after>> in code points, end exclusive.

    The steps are columns of their own, so each pattern runs once to find matches and once to cut the text at them.
    """
    empty = F.array().cast("array<string>")
    out = docs.withColumns({f"{n}_m": F.when(sign, F.regexp_extract_all(text, F.lit(p), F.lit(0))).otherwise(empty) for n, sign, p in searches})
    out = out.withColumns({f"{n}_g": F.when(F.size(f"{n}_m") > 0, F.split(text, p, -1)).otherwise(empty) for n, _, p in searches})
    lengths = lambda n: F.zip_with(f"{n}_m", F.slice(f"{n}_g", F.lit(1), F.size(f"{n}_m")), lambda m, g: (F.length(m) + F.length(g)).cast("long"))
    out = out.withColumns({f"{n}_l": lengths(n) for n, _, _ in searches})
    out = out.withColumns({f"{n}_p": _prefix_sums(F.col(f"{n}_l")) for n, _, _ in searches})

    def spans(n: str) -> Column:
        k = F.size(f"{n}_m")
        rows = F.arrays_zip(F.col(f"{n}_m").alias("m"), F.slice(f"{n}_g", F.lit(1), k).alias("g"), F.slice(f"{n}_g", F.lit(2), k).alias("h"), F.slice(f"{n}_p", F.lit(1), k).alias("p"))
        # the surroundings of a match reach no further than its neighbours
        return F.transform(rows, lambda r: F.struct(
            (r["p"] + F.length(r["g"])).alias("start"), (r["p"] + F.length(r["g"]) + F.length(r["m"])).alias("end"), r["m"].alias("value"),
            F.right(r["g"], F.lit(AROUND)).alias("before"), F.left(r["h"], F.lit(2)).alias("after"),
        ))

    out = out.withColumns({n: F.when(F.size(f"{n}_m") > 0, spans(n)) for n, _, _ in searches})
    return out.drop(*(f"{n}_{x}" for n, _, _ in searches for x in "mglp"))


def _digits(value: Column) -> Column:
    return F.regexp_replace(value, "[^0-9]", "")


def luhn(digits: Column) -> Column:
    n = F.length(digits)
    one = lambda i: F.substring(digits, n - i + 1, F.lit(1)).cast("int")
    double = lambda d: F.when(d > 4, 2 * d - 9).otherwise(2 * d)
    return F.aggregate(F.sequence(F.lit(1), n), F.lit(0), lambda t, i: t + F.when(i % 2 == 0, double(one(i))).otherwise(one(i))) % 10 == 0


def passes(kind: str, value: Column) -> Column:
    digits = _digits(value)
    if kind == "ip":
        return F.forall(F.split(value, r"\."), lambda p: F.coalesce(F.length(F.ltrim(p, F.lit("0"))) <= 3, F.lit(False)) & (F.right(p, F.lit(3)).cast("int") <= 255))
    if kind == "card":
        return F.when(F.length(digits).between(14, 19), luhn(digits)).otherwise(False)
    if kind == "phone":
        return F.length(digits).between(10, 15)
    return F.lit(True)


def _gazetteer(kind: str, value: Column) -> Column:
    """1: known, 0: says nothing, -1: known to be none."""
    if kind == "email":
        return F.when(F.lower(F.regexp_extract(value, r"([A-Za-z0-9-]+)$", 1)).isin(*TOP_LEVEL), 1).otherwise(0)
    digits = _digits(value)
    if kind == "card":
        return F.when(_starts(digits, CARD_STARTS), 1).otherwise(-1)
    if kind == "ip":
        return F.when(value.rlike(r"^0|^2[4-9][0-9]\.|^[0-9]\.[0-9]\.[0-9]\.[0-9]$"), -1).otherwise(0)
    return F.when(F.length(digits).between(10, 13), 1).otherwise(-1)


def _starts(digits: Column, heads) -> Column:
    found = F.lit(False)
    for head in heads:
        found = found | digits.startswith(head)
    return found


def _labelled(kind: str, spans: Column, base: bool) -> Column:
    """Each match with the votes that need only itself and its surroundings."""

    def vote(s: Column) -> Column:
        ok = passes(kind, s["value"]) if base else F.lit(None).cast("boolean")
        words = F.when(s["before"].rlike(NEAR_WORDS[kind]), 1).when(s["before"].rlike(AGAINST), -1).otherwise(0)
        bounds = F.when(s["before"].rlike(r"[\p{L}0-9_]$") | s["after"].rlike(r"^[\p{L}0-9_]"), -1).otherwise(1)
        return F.struct(
            s["start"].alias("start"), F.lit(KINDS.index(kind)).alias("kind"), s["end"].alias("end"),
            (F.coalesce(ok, F.lit(False)) if base else F.lit(False)).alias("base"),
            F.when(ok, 1).when(~ok, -1).otherwise(0).alias("check"), _gazetteer(kind, s["value"]).alias("gazetteer"), words.alias("words"), bounds.alias("bounds"),
        )

    return F.transform(spans, vote)


def candidates(docs: DataFrame, text: str = "text") -> DataFrame:
    """The input with ``spans``: base matches and wider candidates with their votes, by start, kind and end."""
    content = F.coalesce(F.col(text).cast("string"), F.lit(""))
    nothing = F.array().cast("array<struct<start:bigint,kind:int,end:bigint,base:boolean,check:int,gazetteer:int,words:int,bounds:int>>")
    # a text that holds no sign of a kind is not searched for it
    sign = {"email": content.contains("@"), "ip": content.rlike(r"[0-9]\.[0-9]"), "card": content.rlike("[0-9][0-9 -]{12}"), "phone": content.contains("+")}
    wide_sign = {"email": content.rlike(r"[\[(] ?(?:at|AT)"), "phone": content.rlike(r"[0-9]{3}[ .-][0-9]{4}")}
    searches = [(f"_find{i}", sign[k], PATTERNS[k]) for i, k in enumerate(KINDS)] + [(f"_wide{i}", wide_sign[k], p) for i, (k, p) in enumerate(WIDER)]
    out = with_matches(docs, content, searches)
    found = [_labelled(k, F.col(f"_find{i}"), True) for i, k in enumerate(KINDS)] + [_labelled(k, F.col(f"_wide{i}"), False) for i, (k, _) in enumerate(WIDER)]
    every = F.array_sort(F.concat(*(F.coalesce(x, nothing) for x in found)))
    return out.withColumn("spans", every).drop(*(n for n, _, _ in searches))


def _company(spans: Column) -> Column:
    """The votes of neighbours in the order of the text: 1 where one of them is a base match close by, else 0.

    A wider candidate that overlaps a base match next to it is dropped.
    """

    def neighbour(i: Column, step: int, test) -> Column:
        other = F.get(spans, i + step)
        return F.coalesce(other["base"] & test(other), F.lit(False))

    def near(s: Column, i: Column) -> Column:
        close = lambda b: (b["start"] < s["end"] + COMPANY) & (b["end"] + COMPANY > s["start"])
        return neighbour(i, -1, close) | neighbour(i, 1, close)

    def inside(s: Column, i: Column) -> Column:
        over = lambda b: (b["start"] < s["end"]) & (b["end"] > s["start"])
        return neighbour(i, -2, over) | neighbour(i, -1, over) | neighbour(i, 1, over) | neighbour(i, 2, over)

    voted = F.transform(spans, lambda s, i: s.withField("company", F.when(near(s, i), 1).otherwise(0)).withField("drop", ~s["base"] & inside(s, i)))
    return F.transform(F.filter(voted, lambda s: ~s["drop"]), lambda s: s.dropFields("drop"))


def reliabilities(patterns: list[tuple[tuple[int, ...], int]], rounds: int = 50) -> tuple[list[float], list[list[dict[int, float]]]]:
    """EM over (votes, count): the probability of each pattern, and each labeler's vote shares for false and true spans."""
    total = sum(c for _, c in patterns)
    # a start that trusts the labelers about equally
    belief = [min(0.95, max(0.05, 0.5 + 0.2 * sum(v))) for v, _ in patterns]
    shares: list[list[dict[int, float]]] = []
    for _ in range(rounds):
        prior = (sum(b * c for b, (_, c) in zip(belief, patterns, strict=True)) + 1) / (total + 2)
        shares = []
        for k in range(len(LABELERS)):
            own = []
            for truth in (0, 1):
                sums = {-1: 1.0, 0: 1.0, 1: 1.0}
                for b, (v, c) in zip(belief, patterns, strict=True):
                    sums[v[k]] += (b if truth else 1 - b) * c
                own.append({v: x / sum(sums.values()) for v, x in sums.items()})
            shares.append(own)
        new = []
        for v, _ in patterns:
            yes, no = prior, 1 - prior
            for k in range(len(LABELERS)):
                yes, no = yes * shares[k][1][v[k]], no * shares[k][0][v[k]]
            new.append(yes / (yes + no))
        done = max((abs(a - b) for a, b in zip(new, belief, strict=True)), default=0) < 1e-6
        belief = new
        if done:
            break
    return belief, shares


def classifier(voted: DataFrame) -> tuple[list[float], float] | None:
    """Weights of votes and kinds and the intercept, trained on what EM believes; None without candidates."""
    spark = voted.sparkSession
    rows = voted.select(F.explode("spans").alias("s")).groupBy("s.kind", *(f"s.{x}" for x in LABELERS)).agg(F.count("*").alias("count"))
    patterns = [(tuple(r[x] for x in LABELERS), r["kind"], r["count"]) for r in rows.orderBy("kind", *LABELERS).collect()]  # at most 4 * 3^5 rows
    if not patterns:
        return None
    by_kind: dict[int, list[tuple[tuple[int, ...], int]]] = {}
    for votes, kind, count in patterns:
        by_kind.setdefault(kind, []).append((votes, count))
    training = []
    for kind, own in by_kind.items():
        for (votes, count), belief in zip(own, reliabilities(own)[0], strict=True):
            features = [float(x) for x in votes] + [float(kind == k) for k in range(len(KINDS))]
            training += [(*features, 1.0, belief * count), (*features, 0.0, (1 - belief) * count)]
    names = [*LABELERS, *KINDS]
    table = spark.createDataFrame(training, ", ".join(f"{n} double" for n in [*names, "label", "weight"]))
    ready = VectorAssembler(inputCols=names, outputCol="features").transform(table.coalesce(1))
    model = LogisticRegression(weightCol="weight", regParam=1e-3, maxIter=50, standardization=False).fit(ready)
    return [float(x) for x in model.coefficients], float(model.intercept)


def accepted(spans: Column, model: tuple[list[float], float] | None) -> Column:
    """Base spans and those that the classifier takes."""
    if model is None:
        return F.filter(spans, lambda s: s["base"])
    weights, shift = model

    def good(s: Column) -> Column:
        total = F.lit(shift)
        for name, w in zip(LABELERS, weights, strict=False):
            total = total + s[name] * F.lit(w)
        for k, w in enumerate(weights[len(LABELERS) :]):
            total = total + F.when(s["kind"] == k, w).otherwise(0.0)
        return s["base"] | (1 / (1 + F.exp(-total)) >= CUT)

    return F.filter(spans, good)


def _listed(spans: Column) -> Column:
    names = F.array(*map(F.lit, KINDS))
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", F.element_at(names, s["kind"] + 1), s["start"], s["end"])), ",")


def find_personal_data(docs: DataFrame, id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """doc_id, n_email, n_ip, n_card, n_phone, base_sha256, spans of every row.

    Null and empty texts have no spans; ids may be null and may repeat; other columns are not read. The text is searched
    once: spans with votes are written to the shared folder, the votes are counted, and spans are taken from there.
    """
    found = candidates(docs.select(docs[id_column].cast("long").alias("doc_id"), docs[text_column].alias("text")))
    voted = written(found.select("doc_id", _company(F.col("spans")).alias("spans")))
    model = classifier(voted)
    base = F.filter("spans", lambda s: s["base"])
    count = lambda k: F.size(F.filter("spans", lambda s: s["base"] & (s["kind"] == k))).cast("long").alias(f"n_{KINDS[k]}")
    return voted.select("doc_id", *map(count, range(len(KINDS))), F.sha2(_listed(base), 256).alias("base_sha256"), _listed(accepted(F.col("spans"), model)).alias("spans"))


def masked(docs: DataFrame, text: str = "text") -> DataFrame:
    """The input's columns and rows, with every accepted span of ``text`` replaced by its kind in brackets.

    Spans that overlap become one, named by the first. Null texts stay null.
    """
    found = written(candidates(docs, text).withColumn("spans", _company(F.col("spans"))))
    model = classifier(found)
    taken = accepted(F.col("spans"), model)
    start = F.struct(F.lit(0).cast("long").alias("to"), F.array().cast("array<string>").alias("parts"))
    names = F.array(*map(F.lit, KINDS))

    def step(state: Column, s: Column) -> Column:
        cut = F.substring(F.col(text), (state["to"] + 1).cast("int"), (s["start"] - state["to"]).cast("int"))
        mark = F.concat(F.lit("["), F.upper(F.element_at(names, s["kind"] + 1)), F.lit("]"))
        fresh = s["start"] >= state["to"]
        return F.struct(F.greatest(state["to"], s["end"]).alias("to"), F.when(fresh, F.concat(state["parts"], F.array(cut, mark))).otherwise(state["parts"]).alias("parts"))

    done = F.aggregate(taken, start, step, lambda st: F.concat(F.array_join(st["parts"], ""), F.substring(F.col(text), (st["to"] + 1).cast("int"), F.length(text))))
    return found.withColumn(text, F.when(F.size(taken) > 0, done).otherwise(F.col(text))).drop("spans")

"""Judging URLs: host and path rules first, then a weighted vocabulary counted by Aho-Corasick."""

from __future__ import annotations

from collections.abc import Iterator, Mapping

import pandas as pd
from pyspark.sql import Column, DataFrame, functions as F

#: (action, host, path), a parameter: a rule fits its host and all subdomains when the path starts with the rule's.
RULES = (("block", "net", "/"), ("allow", "example.net", "/en/"), ("block", "example.com", "/de/"), ("allow", "org", "/fr/"))
#: One strict term rejects a URL; soft terms reject when the weights of the distinct ones found reach SOFT_LIMIT.
STRICT = ("porn", "xxx", "casino", "warez", "escort", "hentai", "phishing", "keygen")
SOFT = {"adult": 1, "bet": 1, "betting": 1, "cam": 1, "crack": 1, "dating": 1, "free": 1, "girls": 1, "poker": 1, "sex": 1, "torrent": 1, "viagra": 1}
SOFT_LIMIT = 2
_LOWER = "abcdefghijklmnopqrstuvwxyz"


def host_and_path(url: Column) -> tuple[Column, Column]:
    """Host (A-Z lower-cased) after the first ``://`` and path, both empty for null and for URLs without ``://``."""
    host = F.regexp_extract(url, r"(?s)^.*?://([^/?#]*)", 1)
    path = F.regexp_extract(url, r"(?s)^.*?://[^/?#]*([^?#]*)", 1)
    return F.coalesce(F.translate(host, _LOWER.upper(), _LOWER), F.lit("")), F.coalesce(path, F.lit(""))


def rule_columns(host: Column, path: Column, rules=RULES) -> tuple[Column, Column]:
    """The longest fitting rule as text and its action; null where none fits."""
    rule = action = F.lit(None).cast("string")
    for what, name, start in sorted(rules, key=lambda r: len(r[1] + r[2])):
        fits = ((host == name) | host.endswith("." + name)) & path.startswith(start)
        rule, action = F.when(fits, name + start).otherwise(rule), F.when(fits, what).otherwise(action)
    return rule, action


def automaton(strict, soft: Mapping[str, int]):
    import ahocorasick

    found = ahocorasick.Automaton()
    for term in strict:
        found.add_word(term, (term, 0))
    for term, weight in soft.items():
        found.add_word(term, (term, weight))
    found.make_automaton()
    return found


def _word(char: str) -> bool:
    return "a" <= char <= "z" or "0" <= char <= "9"


def count_terms(found, url: str | None) -> tuple[int, int]:
    """Distinct strict terms, and the weights of distinct soft terms, with no letter or digit on either side."""
    if not url:
        return 0, 0
    text = url.translate(_FOLD)
    hits = {}
    for end, (term, weight) in found.iter(text):
        before = end - len(term)
        if (before < 0 or not _word(text[before])) and (end + 1 == len(text) or not _word(text[end + 1])):
            hits[term] = weight
    return sum(w == 0 for w in hits.values()), sum(hits.values())


_FOLD = str.maketrans(_LOWER.upper(), _LOWER)


def url_filter(pages: DataFrame, rules=RULES, strict=STRICT, soft: Mapping[str, int] = SOFT, limit: int = SOFT_LIMIT,
               id_column: str = "page_id", url_column: str = "url") -> DataFrame:
    """page_id, host, path, rule, verdict, strict_hits, soft_weight: one row per input row, nothing is shuffled.

    A null or empty URL, or one without ``://``, has empty host and path, no rule, and the verdict of the vocabulary
    over what there is (null: allow). Repeated rows are judged each; other columns are not read.
    """
    soft = dict(soft)

    @F.pandas_udf("strict_hits int, soft_weight int")
    def terms(parts: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        found = automaton(strict, soft)
        for urls in parts:
            yield pd.DataFrame([count_terms(found, u) for u in urls], columns=["strict_hits", "soft_weight"])

    url = pages[url_column].cast("string")
    host, path = host_and_path(url)
    counted = pages.select(pages[id_column].alias("page_id"), host.alias("host"), path.alias("path"), terms(url).alias("found"))
    rule, action = rule_columns(F.col("host"), F.col("path"), rules)
    bad = (F.col("found.strict_hits") > 0) | (F.col("found.soft_weight") >= limit)
    return counted.select("page_id", "host", "path", rule.alias("rule"), F.coalesce(action, F.when(bad, "block").otherwise("allow")).alias("verdict"), "found.strict_hits", "found.soft_weight")


def url_filter_sql() -> str:
    """The same over ``pages`` as DuckDB SQL, with the default rules and vocabulary."""
    text = f"translate(coalesce(url, ''), '{_LOWER.upper()}', '{_LOWER}')"
    hit = lambda term: f"case when regexp_matches(u, '(^|[^0-9a-z]){term}([^0-9a-z]|$)') then 1 else 0 end"
    fits = lambda r: f"(host = '{r[1]}' or ends_with(host, '.{r[1]}')) and starts_with(path, '{r[2]}')"
    ordered = sorted(RULES, key=lambda r: -len(r[1] + r[2]))
    rule = " ".join(f"when {fits(r)} then '{r[1]}{r[2]}'" for r in ordered)
    action = " ".join(f"when {fits(r)} then '{r[0]}'" for r in ordered)
    return f"""
with a as (select page_id, {text} as u,
    translate(coalesce(regexp_extract(url, '(?s)^.*?://([^/?#]*)', 1), ''), '{_LOWER.upper()}', '{_LOWER}') as host,
    coalesce(regexp_extract(url, '(?s)^.*?://[^/?#]*([^?#]*)', 1), '') as path from pages),
b as (select page_id, host, path, {' + '.join(map(hit, STRICT))} as strict_hits,
    {' + '.join(f'{w} * {hit(t)}' for t, w in SOFT.items())} as soft_weight from a)
select page_id, host, path, case {rule} end as rule,
    case {action} when strict_hits > 0 or soft_weight >= {SOFT_LIMIT} then 'block' else 'allow' end as verdict,
    cast(strict_hits as integer) as strict_hits, cast(soft_weight as integer) as soft_weight from b"""

"""Links, components, repeats, URLs and pages against brute force."""

import hashlib
import random
import re
from collections import Counter, defaultdict

import numpy as np
import pytest

from tenura.llm import html_extract, ngram_join, repeats
from tenura.llm.components import components
from tenura.llm.embedding_join import near_vectors
from tenura.llm.ngram_join import ngram_jaccard
from tenura.llm.repeats import remove_repeats, suffix_groups
from tenura.llm.url_filter import url_filter


def _roots(nodes, pairs):
    parent = {n: n for n in nodes}

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for a, b in pairs:
        a, b = find(a), find(b)
        parent[max(a, b)] = min(a, b)
    return {n: find(n) for n in nodes}


def test_components_of_a_chain_and_a_hub(spark):
    pairs = [(k, k + 1) for k in range(20, 40)] + [(100, k) for k in range(101, 130)] + [(7, 7)]
    found = dict(map(tuple, components(spark.createDataFrame(pairs, "a long, b long")).collect()))
    assert found == _roots({x for p in pairs for x in p} - {7}, [p for p in pairs if p[0] != p[1]])
    assert components(spark.createDataFrame([], "a long, b long")).count() == 0


def _copies(seed, groups=12, extra=40):
    rnd = random.Random(seed)
    word = lambda: rnd.choice("ka lo mi ne pu ra si to vu we".split()) + rnd.choice("ban del fir gon".split())
    out = []
    for _ in range(groups):
        base = [word() for _ in range(rnd.randint(40, 120))]
        for _ in range(rnd.randint(1, 8)):
            own = list(base)
            for _ in range(rnd.choice([0, 0, 1, 1, 2, 3])):
                own[rnd.randrange(len(own))] = word()
            out.append(" ".join(own))
    return out + [" ".join(word() for _ in range(rnd.randint(1, 80))) for _ in range(extra)]


@pytest.mark.parametrize("crowd,block", [(64, 500), (2, 3)])
def test_jaccard_links_equal_brute_force(spark, texts, monkeypatch, crowd, block):
    monkeypatch.setattr(ngram_join, "CROWD", crowd)
    monkeypatch.setattr(ngram_join, "BLOCK", block)
    rows = list(enumerate(_copies(1))) + [(900, None), (901, ""), (902, " \n"), (903, "two words"), (904, "TWO  words"), (None, "two words")]
    rows += [(5, rows[5][1]), (6, rows[40][1])]  # a repeated row, and an id with a second text
    sets = []
    for _, text in rows:
        w = re.findall(r"[^\x20\x09-\x0D]+", (text or "").lower())
        sets.append(frozenset(tuple(w[k : k + 4]) for k in range(len(w) - 3)) if len(w) > 3 else frozenset([tuple(w)] if w else []))
    known = [k for k in range(len(rows)) if rows[k][0] is not None]
    pairs = [(a, b) for a in known for b in known if a < b and sets[a] and 100 * len(sets[a] & sets[b]) >= 85 * len(sets[a] | sets[b])]
    root = _roots(range(len(rows)), pairs)
    least = {r: min(rows[k][0] for k in known if root[k] == r) for r in {root[k] for k in known}}
    want = Counter((rows[k][0], len(sets[k]), None if rows[k][0] is None else least[root[k]]) for k in range(len(rows)))
    assert Counter(map(tuple, ngram_jaccard(texts(rows)).collect())) == want
    assert ngram_jaccard(texts([])).count() == 0


def test_vectors_equal_brute_force(spark):
    rng = np.random.default_rng(2)
    base = rng.normal(size=(60, 24))
    rows = [(v * s).tolist() for v in base for s in (1.0, 2.5)] + [(v + 0.03 * rng.normal(size=24)).tolist() for v in np.repeat(base[:20], 6, axis=0)]
    rows += [rows[3], rows[3], None, [], [0.0] * 24, [float("nan")] + [1.0] * 23, [None] + [1.0] * 23, [1.0, 2.0], [2.0, 4.0]]
    data = spark.createDataFrame([(k, v, 1) for k, v in enumerate(rows)] + [(None, rows[0], 1)], "vec_id long, embedding array<double>, id int")
    good = {k: np.array(v) / np.linalg.norm(v) for k, v in enumerate(rows) if v and None not in v and np.isfinite(v).all() and any(v)}
    pairs = [(a, b) for a in good for b in good if a < b and len(good[a]) == len(good[b]) and good[a] @ good[b] >= 0.95]
    links, root = Counter(x for p in pairs for x in p), _roots(range(len(rows)), pairs)
    found = near_vectors(data)
    assert {tuple(r) for r in found.where("vec_id is not null").collect()} == {(k, links[k], root[k], root[k] == k) for k in range(len(rows))}
    assert found.where("vec_id is null").first().n_links == 0 and near_vectors(data.limit(0)).count() == 0


def test_suffix_groups_equal_prefixes():
    data = np.frombuffer(b"abracadabra" * 9 + b"xyz" + b"abracadabra" * 3, np.uint8)
    rank, _ = suffix_groups(data, 20)
    own = [bytes(data[k : k + 20]).ljust(20, b"\0") for k in range(len(data))]
    assert np.array_equal(np.unique(rank, return_inverse=True)[1], np.unique(own, return_inverse=True)[1])


@pytest.mark.parametrize("shard", [5000, 2])
def test_removed_bytes_equal_brute_force(spark, texts, monkeypatch, shard):
    monkeypatch.setattr(repeats, "SHARD", shard)
    rnd, length = random.Random(6), 40
    passage = ["".join(rnd.choice("abcdé ") for _ in range(90)) for _ in range(4)]
    rows = [(k, "".join(rnd.choice("efgh ") for _ in range(rnd.randint(0, 90))) + rnd.choice(passage)[rnd.randint(0, 60) :] + "".join(rnd.choice("efgh ") for _ in range(30))) for k in range(60)]
    rows += [(70, "ab" * 100), (71, None), (72, ""), (73, rows[3][1]), (73, rows[3][1]), (None, rows[4][1])]
    data = [(t or "").encode() for _, t in rows]
    seen = Counter(b[k : k + length] for b in data for k in range(len(b) - length + 1))
    want = Counter()
    for (i, _), b in zip(rows, data, strict=True):
        gone = np.zeros(len(b) + 1, bool)
        for k in range(len(b) - length + 1):
            if seen[b[k : k + length]] > 1:
                gone[k : k + length] = True
        want[i, len(b), int(gone.sum()), int((np.diff(gone.astype(int), prepend=0) == 1).sum()), hashlib.sha256(bytes(x for x, g in zip(b, gone, strict=False) if not g)).hexdigest()] += 1
    assert Counter(map(tuple, remove_repeats(texts(rows), length, 12).collect())) == want
    assert remove_repeats(texts([]), length, 12).count() == 0


def test_urls(spark):
    urls = ["http://a.NET/x", "http://net", "https://example.net/en/1", "http://sub.example.com/de/", "http://fr.org/fr/q?x#y", "ftp://x.org/casino-royal", "http://x.org/casinos", "http://x.org/free-dating", "http://x.org/free?free", "", None, "no scheme porn"]
    rows = spark.createDataFrame(list(enumerate(urls)), "page_id long, url string")
    found = {r.page_id: (r.host, r.path, r.rule, r.verdict) for r in url_filter(rows).collect()}
    assert found == {
        0: ("a.net", "/x", "net/", "block"), 1: ("net", "", None, "allow"), 2: ("example.net", "/en/1", "example.net/en/", "allow"), 3: ("sub.example.com", "/de/", "example.com/de/", "block"),
        4: ("fr.org", "/fr/q", "org/fr/", "allow"), 5: ("x.org", "/casino-royal", None, "block"), 6: ("x.org", "/casinos", None, "allow"), 7: ("x.org", "/free-dating", None, "block"),
        8: ("x.org", "/free", None, "allow"), 9: ("", "", None, "allow"), 10: ("", "", None, "allow"), 11: ("", "", None, "block"),
    }


def _page(k, rnd):
    sentence = lambda: " ".join(rnd.choice("alpha beta gamma delta caf&eacute; &amp;".split()) for _ in range(12)).capitalize() + "."
    paragraphs = [" ".join(sentence() for _ in range(3)) for _ in range(rnd.randint(1, 4))]
    links = "".join(f"<li><a href=/{j}>Link {j}</a></li>" for j in range(5))
    body = "".join(f"<p><b>{p}</b>" for p in paragraphs)
    return f"<html><head><title>T</title><script>var a='</p>'</script></head><body><nav><ul>{links}</ul></nav><!-- x --><div class='ad'>Buy.</div><article><h1>Head {k}</h1>{body}</article><footer>&copy; me</footer>", " ".join([f"Head {k}", *paragraphs]).replace("&eacute;", "é").replace("&amp;", "&")


def test_main_text_of_pages(spark):
    rnd = random.Random(1)
    made = [_page(k, rnd) for k in range(80)]
    rows = [(k, "u", h) for k, (h, _) in enumerate(made)] + [(100, None, None), (101, "u", ""), (None, "u", made[0][0])]
    pages = spark.createDataFrame(rows, "page_id long, url string, html string")
    found = {r.page_id: r for r in html_extract.extract(pages, html_extract.fit(pages)).collect()}
    assert [found[k].text for k in range(80)] == [t for _, t in made]
    assert found[3].n_chars == len(made[3][1]) and found[100].text == found[101].text == "" and found[None].text == made[0][1]


def test_messages_equal_enumeration():
    page = html_extract.parse("<div><p>one<a>two</a></p><ul><li>x</ul></div>")
    f, rng = html_extract.forest([page]), np.random.default_rng(0)
    weights, edges = rng.normal(size=html_extract.FEATURES), rng.normal(size=(2, 2))
    n, total, each = len(f.parent), 0.0, defaultdict(float)
    for state in range(1 << n):
        s = [(state >> k) & 1 for k in range(n)]
        p = np.exp(sum(f.x[k] @ weights * s[k] for k in range(n)) + sum(edges[s[f.parent[k]], s[k]] for k in range(1, n)))
        total += p
        for k in range(n):
            each[k] += p * s[k]
    assert np.allclose(html_extract.marginals(f, weights, edges)[0], [each[k] / total for k in range(n)])

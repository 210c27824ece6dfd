"""Short benchmark items, and all items against a plain alignment over every place."""

import random

import pytest

from tenura.llm import decontamination
from tenura.llm.decontamination import build, leaks, normal, search


@pytest.mark.parametrize("text,held", [
    ("So: What is the  capital of France? Paris.", True), ("what is the capital of france", True),
    ("what is the capital of frances", False), ("somewhat is the capital of france", False),
    ("what is the capitol of france", False), ("what is the capital of frances. what is the capital of france.", True),
])
def test_short_items_on_word_boundaries(text, held):
    assert bool(list(search(build([(1, "What is the capital of France")]), [normal("x" * 50), normal(text)]))) == held


def test_short_items_of_other_scripts():
    index = build([(1, "法国的首都是哪座城"), (2, "yes"), (3, "ja, nein")])
    found = {(t, index.ids[i]) for t, i, *_ in search(index, [normal("请问法国的首都是哪座城市吗"), normal("yes ja, nein yes"), normal("")])}
    assert found == {(0, 1), (1, 3)}


def plain(item: bytes, text: bytes) -> int:
    """Fewest edits of the item over all places of the text."""
    cost = [0] * (len(text) + 1)
    for k, byte in enumerate(item):
        fresh = [k + 1]
        for j, other in enumerate(text):
            fresh.append(min(cost[j] + (byte != other), cost[j + 1] + 1, fresh[j] + 1))
        cost = fresh
    return min(cost)


def test_against_alignment_over_all_places():
    rng = random.Random(11)
    words = ["amber", "birch", "cedar", "delta", "ember", "fjord", "grove", "haven", "inlet", "jetty"]
    say = lambda n: " ".join(rng.choice(words) + str(rng.randrange(10)) for _ in range(n))
    items = [(i, say(rng.randrange(6, 14))) for i in range(12)]
    texts = []
    for _ in range(60):
        _, item = rng.choice(items)
        changed = list(item)
        for _ in range(rng.randrange(0, len(item) // 7)):
            at = rng.randrange(len(changed))
            changed[at : at + 1] = rng.choice([[], ["q"], [changed[at], "q"]])
        texts.append(f"{say(rng.randrange(20))} {''.join(changed)} {say(rng.randrange(20))}")
    texts += ["", say(40), items[0][1], f"{items[1][1]} {items[1][1]}"]
    index = build(items)
    found = {(t, i): edits for t, i, _, _, edits in search(index, [normal(x) for x in texts])}
    for t, text in enumerate(texts):
        for i in range(len(items)):
            fewest = plain(index.items[i], normal(text))
            assert found.get((t, i)) == (fewest if fewest <= index.edits[i] else None)
    assert len(found) > 30


def test_repeated_rows_and_clashing_columns(spark):
    """Repeated and null-id rows are reported each, a block's size does not matter, other columns are not read."""
    rows = [(1, "we ask what is the capital of france here", 5)] * 2 + [(None, "What is the capital of France", 5), (2, None, 5), (3, "", 5)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, item_id int")
    items = spark.createDataFrame([(7, "what is the capital of france", 1), (8, None, 1), (None, "we ask what is the capital", 1)], "item_id long, text string, doc_id int")
    got = leaks(docs, items)
    assert sorted((r.doc_id or 0, r.item_id, r.edits) for r in got.collect()) == [(0, 7, 0), (1, 7, 0), (1, 7, 0)]
    assert sorted(r.doc_id for r in decontamination.without_leaks(docs, items).collect()) == [2, 3]
    assert leaks(docs.limit(0), items).count() == 0 and leaks(docs, items.limit(0)).count() == 0

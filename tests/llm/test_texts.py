"""Token counts, byte-pair encoding, toxicity, decontamination and personal data against plain Python."""

import hashlib
import random
import re
import struct

import numpy as np
import pytest

from tenura.llm import toxicity
from tenura.llm.bpe import ByteBpe, bpe_round_trip
from tenura.llm.decontamination import leaks, without_leaks
from tenura.llm.pii import find_personal_data, masked
from tenura.llm.queries import tokenizer
from tenura.llm.token_counts import Counter, token_counts

ODD = [None, "", " ", "a", "  a  b \n c\t d  ", "x<|endoftext|>y <|endoftext|>", "▁a ▁b", "a" * 700, "don't we'll", "\n\n \n x", "é" * 300 + " " * 300 + "x", "日本語 テキスト 𝔘", "a  \n"]


def noise(n, letters="ab \n\t'sé1<>|▁日𝔘 .-  ", seed=1):
    rnd = random.Random(seed)
    return ["".join(rnd.choice(letters) for _ in range(rnd.randint(1, 60))) for _ in range(n)]


@pytest.fixture(scope="module")
def library():
    from sentencepiece import SentencePieceProcessor

    return SentencePieceProcessor(model_file=tokenizer("piece_bpe_32k.model"))


def test_counts_equal_the_library(spark, texts, library):
    rows = list(enumerate(ODD + noise(300))) + [(None, "a b"), (1, ""), (1, "")]
    found = token_counts(texts(rows), tokenizer("piece_bpe_32k.model"), limit=5)
    want = sorted((i, len((t or "").encode()), n := len(library.encode(t or "")), n > 5) for i, t in rows if i is not None)
    assert sorted(tuple(r) for r in found.where("doc_id is not null").collect()) == want
    assert found.where("doc_id is null").count() == 1
    assert token_counts(texts([]), tokenizer("piece_bpe_32k.model")).count() == 0


def test_splicing_equals_the_whole_text(library):
    odd = [" ".join(noise(40, seed=s)) for s in range(20)] + ["a" * 5000, "é日" * 900, " " * 3000, "x" * 90 + " y" * 400, "▁ab" * 300]
    for chunk, overlap in [(8, 1), (64, 4), (300, 8), (1024, 64)]:
        counter = Counter(tokenizer("piece_bpe_32k.model"), chunk, overlap)
        for text in odd + [t for t in ODD if t]:
            assert counter.count(text) == len(library.encode(text)), (chunk, text[:80])


def field(number, kind, data):
    """One field of a serialized model: a number, a float or bytes."""
    tag = bytes([number << 3 | kind]) if number < 16 else bytes([number << 3 & 127 | kind | 128, number >> 4])
    if kind == 0:
        return tag + bytes([data])
    return tag + (struct.pack("<f", data) if kind == 5 else bytes([len(data) & 127 | 128, len(data) >> 7]) + data)


def random_model(rnd, letters="abc", size=40):
    """A model of merges at random: every piece joins two earlier ones."""
    names = ["▁", *letters]
    while len(names) < size:
        name = rnd.choice(names) + rnd.choice(names)
        if name not in names:
            names.append(name)
    entries = [field(1, 2, b"<unk>") + field(2, 5, 0.0) + field(3, 0, 2)]
    entries += [field(1, 2, n.encode()) + field(2, 5, -float(i)) + field(3, 0, 1) for i, n in enumerate(names)]
    normal = field(1, 2, b"identity") + field(3, 0, 1) + field(4, 0, 0) + field(5, 0, 1)
    return b"".join(field(1, 2, e) for e in entries) + field(2, 2, field(3, 0, 2)) + field(3, 2, normal)


def test_boundaries_are_stable_in_random_vocabularies(tmp_path):
    from sentencepiece import SentencePieceProcessor

    rnd = random.Random(5)
    for k in range(40):
        path = tmp_path / f"{k}.model"
        path.write_bytes(random_model(rnd, size=rnd.choice([8, 20, 60])))
        own = SentencePieceProcessor(model_file=str(path))
        counter = Counter(str(path), rnd.choice([8, 16, 40]), rnd.choice([1, 3, 8]))
        assert counter.keeps_text
        for _ in range(60):
            text = "".join(rnd.choice(rnd.choice(["abc", "aab ", "a", "abz "])) for _ in range(rnd.randint(1, 200)))
            assert counter.count(text) == len(own.encode(text)), (k, text)


def test_ids_and_text_equal_the_library(spark, texts):
    from tokenizers import Tokenizer

    own = Tokenizer.from_file(tokenizer("byte_bpe_50k.json"))
    own.no_truncation()
    own.no_padding()
    rows = list(enumerate(ODD + noise(300, seed=2)))
    found = {r.doc_id: r for r in bpe_round_trip(texts(rows), tokenizer("byte_bpe_50k.json"), with_ids=True, with_text=True).collect()}
    for i, text in rows:
        ids = own.encode(text or "", add_special_tokens=False).ids
        assert found[i].ids == ids and found[i].n_tokens == len(ids)
        assert found[i].ids_sha256 == hashlib.sha256(np.array(ids, "<u4").tobytes()).hexdigest()
        assert found[i].decoded == own.decode(ids, skip_special_tokens=False)
    assert bpe_round_trip(texts([]), tokenizer("byte_bpe_50k.json")).count() == 0


def test_merges_of_one_long_word():
    from tokenizers import Tokenizer

    word = "".join(random.Random(4).choice("abcde") for _ in range(3000))
    ids, counts = ByteBpe(tokenizer("byte_bpe_50k.json")).encode([word])
    assert ids.tolist() == Tokenizer.from_file(tokenizer("byte_bpe_50k.json")).encode(word, add_special_tokens=False).ids


def _labelled(seed):
    rnd = random.Random(seed)
    words = [a + b for a in "ba be bi do du fa ge hi ka lo mu ne".split() for b in "ran tel sim nor pax".split()]
    clean = [" ".join(rnd.choice(words) for _ in range(60)) for _ in range(120)]
    bad = [" ".join(rnd.choice(words + ["grolbix", "grolbixen", "zwarkum"] * 6) for _ in range(60)) for _ in range(120)]
    return bad, clean


def test_toxicity_on_held_out_documents(spark, texts):
    bad, clean = _labelled(1)
    rows = list(enumerate(bad + clean)) + [(1000, None), (1001, ""), (None, "zwarkum")]
    labels = spark.createDataFrame([(i, int(i < 120)) for i in range(240)] + [(5, None), (None, 1)], "doc_id long, toxic int")
    docs = texts(rows)
    model = toxicity.fit(docs, labels)
    found = {r.doc_id: r for r in toxicity.score(docs, model).collect()}
    own = [r for i, r in found.items() if i is not None and i < 240 and r.held_out]
    assert len(found) == 243 and len(own) > 20
    assert np.mean([r.predicted == int(r.doc_id < 120) for r in own]) > 0.95
    assert found[1000].score == found[1001].score and found[1001].predicted == 0
    assert model.scores(["du bran g.r.o.l.b.i.x karan grolb_ix " * 5])[0] > 0.5
    kept = toxicity.score(docs, model, keep=True)
    assert kept.columns == docs.columns and 120 <= kept.count() <= 124
    assert toxicity.score(texts([]), model).count() == 0


def test_toxicity_without_labels(spark, texts):
    docs = texts([(1, "a b")])
    model = toxicity.fit(docs, spark.createDataFrame([], "doc_id long, toxic int"))
    assert [r.score for r in toxicity.score(docs, model).collect()] == [0.0]


def test_leaks_within_the_edit_budget(spark, texts):
    rnd = random.Random(3)
    word = lambda: "".join(rnd.choice("abcdefghij") for _ in range(rnd.randint(2, 8)))
    items = [(k, " ".join(word() for _ in range(25))) for k in range(12)] + [(50, None), (51, ""), (52, "short")]
    rows = []
    for k in range(60):
        text = bytearray(items[k % 12][1].encode())
        for _ in range(int(len(text) * 0.07) if k % 2 else 0):
            text[rnd.randrange(len(text))] = 97 + rnd.randrange(10)
        filler = [" ".join(word() for _ in range(40)) for _ in range(2)]
        rows.append((k, f"{filler[0]}\n {text.decode().upper()} {filler[1]}"))
    rows += [(100 + k, " ".join(word() for _ in range(200))) for k in range(40)] + [(200, None), (201, ""), (None, items[0][1])]
    benchmark = spark.createDataFrame(items, "item_id long, text string")
    found = {(r.doc_id, r.item_id) for r in leaks(texts(rows), benchmark).collect()}
    assert found == {(k, k % 12) for k in range(60)} | {(None, 0)}
    kept = without_leaks(texts(rows), benchmark)
    assert sorted(r.doc_id for r in kept.collect()) == [*range(100, 140), 200, 201]
    assert leaks(texts(rows), benchmark.limit(0)).count() == 0 and leaks(texts([]), benchmark).count() == 0


PATTERNS = {"email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", "ip": r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)", "card": r"[0-9]([\x20-]?[0-9])+", "phone": r"\+[0-9][\x20().0-9-]+[0-9]"}


def _base(text):
    def luhn(d):
        return sum(x if k % 2 == 0 else x * 2 - 9 * (x > 4) for k, x in enumerate(map(int, reversed(d)))) % 10 == 0

    out = []
    for k, (name, pattern) in enumerate(PATTERNS.items()):
        for m in re.finditer(pattern, text or ""):
            d = re.sub("[^0-9]", "", m.group())
            good = {"email": True, "ip": name == "ip" and all(int(x) <= 255 for x in m.group().split(".")), "card": 14 <= len(d) <= 19 and luhn(d), "phone": 10 <= len(d) <= 15}
            if good[name]:
                out.append((m.start(), k, f"{name}:{m.start()}:{m.end()}"))
    return ",".join(x[2] for x in sorted(out))


def test_base_spans_equal_plain_patterns(spark, texts):
    rnd = random.Random(3)
    parts = ["a", "@", ".", "b.c", "1", "23", "4111 1111 1111 1111", "4111111111111111", "+1 (988) 555-2485", "+", " ", "-", "(", ".com", "256", "10.0.0.1", "é", "𝔘", "_d@e.f", "%%", "\n"]
    rows = list(enumerate([None, ""] + ["".join(rnd.choice(parts) for _ in range(rnd.randint(1, 40))) for _ in range(250)] + [" x@y.zz 1.2.3.4" * 600, "a." * 20000 + "@", "1" * 20000]))
    found = {r.doc_id: r for r in find_personal_data(texts(rows)).collect()}
    for i, text in rows:
        base = _base(text)
        assert found[i].base_sha256 == hashlib.sha256(base.encode()).hexdigest(), text
        assert set(filter(None, base.split(","))) <= set(found[i].spans.split(","))
    assert find_personal_data(texts([])).count() == 0


def test_masking_keeps_the_rest(spark, texts):
    docs = texts([(1, "to a@b.cc é +1 (988) 555-2485 end"), (2, None), (3, ""), (4, "plain")])
    assert sorted((r.doc_id, r.text) for r in masked(docs).collect()) == [(1, "to [EMAIL] é [PHONE] end"), (2, None), (3, ""), (4, "plain")]

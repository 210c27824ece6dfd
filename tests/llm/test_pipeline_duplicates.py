"""Near duplicates are rejected by row where an id stands on rows of different texts."""

import corpus_pipeline


def words(tag, n=40):
    return " ".join(f"{tag}{k}" for k in range(n))


def test_other_texts_under_a_repeated_id_stay(spark, texts):
    a, b, c, d = words("a"), words("b"), words("c"), words("d")
    rows = [
        (1, a), (2, a), (2, b),  # 2 stands on a copy of 1 and on a text of its own
        (3, c), (3, d), (3, d + " end"), (3, ""),  # two texts and a near copy, and no words
        (4, d), (5, ""), (5, None), (None, a), (None, a),
    ]
    found = corpus_pipeline.drop_near_duplicates(spark, texts(rows), "")
    want = [(1, a), (2, b), (3, c), (3, d), (3, ""), (5, ""), (5, None), (None, a), (None, a)]
    assert sorted(((r.doc_id, r.text) for r in found.collect()), key=repr) == sorted(want, key=repr)
    assert found.columns == texts([]).columns


def test_unique_ids_keep_the_smallest(spark, texts):
    a, b = words("a"), words("b")
    found = corpus_pipeline.drop_near_duplicates(spark, texts([(7, a), (5, a), (6, a + " end"), (8, b), (9, "")]), "")
    assert sorted(r.doc_id for r in found.collect()) == [5, 8, 9]

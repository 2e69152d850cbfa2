"""The join goes by texts: ids that repeat or are missing lose no link; and its recall near the bound."""

import random

from parlance.llm import ngram_join

from .test_operators import SCHEMA, docs, prose, similarity


def changed(text, *places):
    words = text.split()
    for k in places:
        words[k] = f"changed{k}"
    return " ".join(words)


def test_ids_with_two_texts(spark):
    rng = random.Random(3)
    a, b = prose(rng, 60), prose(rng, 60)
    rows = [(1, a), (1, b), (2, changed(a, 59)), (3, changed(b, 59)), (1, a)]
    got = sorted((r.doc_id, r.class_id, r.entry_id, r.n_links) for r in ngram_join.ngram_join(spark.createDataFrame(rows, SCHEMA)).collect())
    assert got == [(1, 1, 1, 1)] * 3 + [(2, 1, 2, 1), (3, 1, 3, 1)]


def test_rows_without_an_id_take_part(spark):
    rng = random.Random(4)
    a, b = prose(rng, 60), prose(rng, 60)
    rows = [(None, a), (7, changed(a, 59)), (None, changed(a, 0)), (None, b), (None, changed(b, 59)), (None, None), (None, a)]
    got = sorted(((r.doc_id, r.class_id, r.entry_id, r.n_links) for r in ngram_join.ngram_join(spark.createDataFrame(rows, SCHEMA)).collect()), key=str)
    assert got == sorted([(None, 7, None, 2), (7, 7, 7, 2), (None, 7, None, 2), (None, None, None, 1), (None, None, None, 1), (None, None, None, 0), (None, 7, None, 2)], key=str)


def test_recall_of_pairs_near_the_bound(spark):
    """All rows whose id is divisible by 3 against all rows: no pair of at least 0.8 is lost."""
    rng = random.Random(5)
    texts = []
    for _ in range(60):
        base = prose(rng, rng.randint(60, 160))
        n = len(base.split())
        # a word changed inside costs up to five shingles of each side
        texts += [base, *(changed(base, *rng.sample(range(n), max(1, round(n * share)))) for share in (0.012, 0.018, 0.021, 0.024))]
    got = {r.doc_id: r for r in ngram_join.ngram_join(docs(spark, texts)).collect()}
    asked = found = 0
    for i in range(3, len(texts) + 1, 3):
        links = [j for j in range(1, len(texts) + 1) if j != i and similarity(texts[i - 1], texts[j - 1]) >= 0.8]
        asked += len(links)
        found += got[i].n_links
        assert all(got[j].class_id == got[i].class_id for j in links)
    assert asked > 50 and found == asked


def test_a_large_group_is_spread(spark):
    """A group of 700 near copies goes through cells of bounded size, dealt by ranges of rows."""
    rng = random.Random(6)
    base = prose(rng, 80)
    texts = [f"{changed(base, 79 if k % 2 else 3)} tail{k}" for k in range(700)]
    links = [sum(similarity(texts[k], other) >= 0.8 for other in texts) - 1 for k in (0, 1)]
    got = {r.doc_id: r for r in ngram_join.ngram_join(spark.createDataFrame(list(enumerate(texts, 1)), SCHEMA), block=32).collect()}
    assert {r.class_id for r in got.values()} == {1} and links[0] >= 349
    assert all(r.n_links == links[(i - 1) % 2] for i, r in got.items())

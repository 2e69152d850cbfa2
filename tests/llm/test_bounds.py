"""Bounds of samples, keys of lists in other forms, chunks without sentences, and all windows by brute force."""

import random
from collections import Counter

import numpy as np
from pyspark.sql import functions as F

from parlance.llm import common, decontaminate, exact_dedup, language, quality, url_filter
from parlance.llm.shingles import WordHashes, shingles, word_hashes

from .test_operators import SCHEMA, docs, prose


def test_samples_are_bounded_by_rows(spark):
    rows = spark.createDataFrame([(k % 7,) for k in range(100)], "doc_id long")
    taken = common.bounded_ids(rows, 40)
    assert sum(1 for k in range(100) if k % 7 in taken) <= 40 and len(taken) == 2
    assert common.bounded_ids(rows, 3) == []


def test_quality_takes_repeated_and_contradicting_labels(spark):
    rng = random.Random(4)
    texts = [(i, prose(rng, 40) if i <= 40 else "%%% " * 40) for i in range(1, 81)]
    df = spark.createDataFrame([*texts, *texts[:5], (None, "x")], SCHEMA)
    labels = [(i, int(i <= 40)) for i in range(1, 81)]
    model = lambda some: quality.fit(df, spark.createDataFrame(some, "doc_id long, quality int"))
    plain, repeated = model(labels), model(labels * 3)
    assert np.allclose(plain.weights, repeated.weights) and plain.shift == repeated.shift
    both = model([*labels, *((i, 1 - int(i <= 40)) for i in range(1, 81))])
    assert not both.weights.any()
    assert quality.score(df, plain).count() == 86


def test_language_scores_and_bounds(spark):
    rng = random.Random(6)
    say = lambda letters, n: " ".join("".join(rng.choice(letters) for _ in range(5)) for _ in range(n))
    a, b = "aeioulmnrst", "жзиклмнопрст"
    rows = [(i, say(a if i % 2 else b, 40), "la" if i % 2 else "cy") for i in range(1, 81)] + [(200, say(a, 1), None), (None, say(b, 30), "xx"), (201, say(a, 200), None)]
    df = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    got = {r.doc_id: r for r in language.predict(df, language.fit(df)).collect()}
    assert got[200].score < got[201].score < 1 and got[None].lang_pred == "cy" and not got[None].held_out
    assert len(language.fit(df, languages=1).names) == 1
    assert language.predict(df.limit(0), language.fit(df)).count() == 0


def test_keys_in_other_forms(spark):
    events = spark.createDataFrame([("a", "X.com", "add", 10), ("a", "x.com.", "remove", 20), ("b", "Y.org/P/", "add", 0)], "list string, key string, action string, at int")
    rows = [(1, "http://x.com/", 15), (2, "http://x.com/", 30), (3, "http://y.org/p/q", 1), (4, "http://y.org/" + "s/" * 3000, 1), (5, "http://y.org/pq", 1)]
    captures = spark.createDataFrame(rows, "page_id long, url string, fetched int")
    for how in ({}, {"most_rows": 0}):
        assert {r.page_id: r.blocked for r in url_filter.filtered(captures, events, **how).collect()} == {1: True, 2: False, 3: True, 4: False, 5: False}
    assert url_filter.filtered(captures.limit(0), events).count() == 0
    assert {r.blocked for r in url_filter.filtered(captures, events.limit(0)).collect()} == {False}


def test_chunks_without_sentences(spark):
    rng = random.Random(1)
    long = "".join(rng.choice("abcdefghijklmnopqrstuvwxyz") for _ in range(40_000))
    df = spark.createDataFrame([(1, long), (2, "#" + long)], SCHEMA).withColumn("c", exact_dedup.chunks(F.col("text"), 200, 900))
    a, b = (r.c for r in df.orderBy("doc_id").collect())
    assert "".join(a) == long and len(set(a) & set(b)) > len(a) * 0.8


def test_any_number_of_digest_collisions(spark, monkeypatch):
    monkeypatch.setattr(exact_dedup, "MAX_COLLISIONS", 1)
    rng = random.Random(2)
    texts = [prose(rng, 60) for _ in range(20)] * 2
    weak = lambda c: F.substring(F.md5(c), 1, 1).cast("binary")
    got = exact_dedup.exact_dedup(docs(spark, texts), digest=weak, cut=lambda t: exact_dedup.chunks(t, 16, 64)).collect()
    assert sorted(got) == sorted(exact_dedup.exact_dedup(docs(spark, texts)).collect())


def test_all_windows_by_brute_force(spark):
    """Every window of every item's length, compared by weighted Jaccard similarity without any index."""
    rng = random.Random(9)
    items = [prose(rng, rng.randint(6, 40)) for _ in range(12)]
    texts = []
    for k in range(40):
        words = rng.choice(items).split()
        for place in rng.sample(range(len(words)), k % 3):
            words[place] = f"other{k}"
        texts.append(" ".join([prose(rng, rng.randint(0, 30)), *words, prose(rng, rng.randint(0, 30)), *(words if k % 5 == 0 else [])]))
    bench = decontaminate.Benchmark(list(enumerate(items)), 0.8, decontaminate.RADIUS, 5)
    known, want = WordHashes(), set()
    for i, text in enumerate(texts, 1):
        hashes = shingles(word_hashes(text, known))
        for number, bag in enumerate(bench.bags):
            width = max(1, bench.words[number] - 4)
            if any(bench.exact(Counter(hashes[at : at + width].tolist()), bag) >= 0.8 for at in range(max(1, len(hashes) - width + 1))):
                want.add((i, number))
    got = decontaminate.contaminated(docs(spark, texts * 2), spark.createDataFrame(list(enumerate(items)), "item_id long, text string")).collect()
    assert len(want) > 15 and {(r.doc_id, r.item_id) for r in got} == want | {(i + len(texts), n) for i, n in want}

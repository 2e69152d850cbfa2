"""Ranked search, substring deduplication and spelling variants against brute force, and their edge cases."""

import hashlib
import math
import random
import re
import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

from parlance.llm import lexical, spelling, substrings

CLASHING = ("row", "own", "at", "n", "rank", "score", "query_key", "hash", "kept", "word", "alive", "item_id")


def table(spark, rows, schema="doc_id long, text string"):
    return spark.createDataFrame(rows, schema).withColumns({c: F.lit("x") for c in CLASHING if c not in schema})


def prose(rng, n, letters="abcde"):
    return " ".join("".join(rng.choice(letters) for _ in range(rng.randint(1, 4))) for _ in range(n))


@pytest.fixture(scope="module")
def corpus():
    rng = random.Random(7)
    texts = [prose(rng, rng.randint(0, 60)) for _ in range(120)]
    shared = prose(rng, 20, "xyz")
    for i in range(0, 120, 7):
        texts[i] = f"{texts[i]} {shared}\t{texts[i]}"
    texts += texts[:9] + [texts[3][:40]]
    rows = list(enumerate(texts, 1)) + [(900, None), (901, ""), (902, " \n\x0b"), (903, "Ça É\x00é—中文 ÇA"), (5, texts[20]), (5, texts[4]), (None, texts[7]), (None, texts[7]), (None, "only here"), (904, prose(rng, 3000))]
    return rows


TERM = re.compile("[^\x00-\x2f\x3a-\x40\x5b-\x60\x7b-\x7f]+")
LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def scores(rows, query):
    docs = [(i, Counter(TERM.findall((t or "").translate(LOWER)))) for i, t in rows]
    docs = [(i, c) for i, c in docs if c]
    count, length = len(docs), sum(c.total() for _, c in docs)
    out = []
    for i, c in docs:
        m, score = 50 + (50 * c.total() * count) // length, 0
        for t in set(TERM.findall((query or "").translate(LOWER))):
            df = sum(t in o for _, o in docs)
            if c[t]:
                score += math.floor(1000 * math.log((2 * count + 2) / (2 * df + 1))) * ((10**9 * c[t]) // (1000 * c[t] + 20 * m))
        if score > 0:
            out.append((-score, i is None, i or 0))
    return sorted(out)


@pytest.mark.parametrize("how", [{}, {"shard": 40, "most_queries": 2}])
def test_search(spark, corpus, how):
    queries = [(1, "ab cd xyz É"), (2, None), (3, "nowhere"), (4, "A b c d e ab ba ea"), (4, "ÇA"), (None, "ab cd xyz É"), (5, "")]
    got = defaultdict(list)
    for r in lexical.search(table(spark, corpus), table(spark, queries, "item_id long, text string"), k=15, **how).collect():
        got[r.item_id].append((r.rank, r.doc_id, r.score))
    for item in {i for i, _ in queries}:
        want = [(k, None if null else i, -s) for own, q in queries if own == item for k, (s, null, i) in enumerate(scores(corpus, q)[:15], 1)]
        assert sorted(got[item], key=str) == sorted(want, key=str)
    assert len({(r[0], r[1]) for r in got[1]}) == 15


def test_search_of_nothing(spark, corpus):
    items = table(spark, [(1, "ab")], "item_id long, text string")
    assert lexical.search(table(spark, []), items).count() == 0 and lexical.search(table(spark, [(1, "")]), items).count() == 0
    assert lexical.search(table(spark, corpus), items.limit(0)).count() == 0


def test_shards_probe_only_what_can_qualify():
    """A shard with a bar gives exactly the documents at or above it, whatever lists are essential."""
    rng = np.random.default_rng(3)
    for _ in range(30):
        held = rng.random((40, 12)) < 0.4
        rows, found = np.nonzero(held)
        tfs = rng.integers(1, 5, len(rows))
        shard = lexical.Shard(rng.integers(1, 99, 40), rows, found.astype(np.int32), tfs, rng.integers(1, 3000, 12), 500, 20_000)
        query = np.unique(rng.integers(0, 15, 6)).astype(np.int32)
        every, score = shard.search(query, 1)
        for bar in [1, *rng.choice(score, 3)] if len(score) else [1]:
            live, own = shard.search(query, int(bar))
            assert live.tolist() == every[score >= bar].tolist() and own.tolist() == score[score >= bar].tolist()


WHITE = re.compile(r"[^\x20\x09-\x0d]+")


def deduplicated(rows, size):
    least = {}
    for i, t in rows:
        words = WHITE.findall(t or "")
        for k in range(len(words) - size + 1):
            key = tuple(words[k : k + size])
            least[key] = min(least.get(key, math.inf), math.inf if i is None else i)
    out = []
    for i, t in rows:
        words = WHITE.findall(t or "")
        gone = {j for k in range(len(words) - size + 1) if least[tuple(words[k : k + size])] < (math.inf if i is None else i) for j in range(k, k + size)}
        out.append((i, len(words), len(gone), " ".join(w for j, w in enumerate(words) if j not in gone)))
    return sorted(out, key=str)


@pytest.mark.parametrize("how", [{}, {"window": 3}, {"window": 6, "start": 1, "chunk": 50}, {"start": 4, "chunk": 200}, {"window": 1}])
def test_substrings(spark, corpus, how):
    got = [tuple(r) for r in substrings.dedup(table(spark, corpus), **how).collect()]
    assert sorted(got, key=str) == deduplicated(corpus, how.get("window", 13))


def test_substrings_unique_ids_and_nothing(spark):
    rng = random.Random(1)
    passage = prose(rng, 60)
    rows = [(i, f"{prose(rng, 5)} {passage} {prose(rng, 5)}") for i in range(9, 0, -1)] + [(10, "short"), (11, None)]
    assert sorted((tuple(r) for r in substrings.dedup(table(spark, rows)).collect()), key=str) == deduplicated(rows, 13)
    assert substrings.dedup(table(spark, [])).count() == 0
    assert [tuple(r) for r in substrings.dedup(table(spark, [(1, "a  b")])).collect()] == [(1, 2, 0, "a b")]


def near(a, b):
    if len(a) == len(b):
        return sum(x != y for x, y in zip(a, b, strict=True)) == 1
    a, b = sorted((a, b), key=len)
    return len(b) - len(a) == 1 and any(b[:k] + b[k + 1 :] == a for k in range(len(b)))


def grouped(rows, every):
    total = Counter()
    for i, t in rows:
        for run in re.findall("[A-Za-zÀ-ÿ]+", t or ""):
            run = run.translate(LOWER)
            h = zlib.crc32(f"{'' if i is None else i}:{run}".encode())
            total[run[: h % len(run)] + run[h % len(run) + 1 :] if h % every == 0 else run] += 1
    words = {w: n for w, n in total.items() if len(w) >= 5 and n >= 3}
    form, out = {}, {}
    for w, n in words.items():
        own = sorted((-words[o], o) for o in words if near(w, o))
        out[w] = (n, len(own))
        if own and -own[0][0] >= 2 * n:
            form[w] = own[0][1]
    root = lambda w: root(form[w]) if w in form else w
    return sorted((w, form.get(w), root(w), *out[w], words.get(form.get(w))) for w in words)


@pytest.mark.parametrize("most", [20_000, 7])
def test_spelling(spark, most):
    rng = random.Random(4)
    base = ["".join(rng.choice("abé") for _ in range(rng.randint(4, 9))) for _ in range(40)] + ["aaaaa", "aaaaaa", "baaaaa", "aaaaab", "ÇÀÿ÷×", "Straßen", "straßen"]
    rows = [(i, " ".join(rng.choices(base, weights=[1 + k % 9 for k in range(len(base))], k=60)) + "—中x_ciao ciao1") for i in range(60)] + [(1, "aaaaa aaaaa"), (None, "aaaaab " * 5), (2, None), (3, "")]
    chain = {"zzzza": 3, "zzzzab": 7, "zzzzabb": 15}
    whole = next(i for i in range(1000, 2000) if all(zlib.crc32(f"{i}:{w}".encode()) % 5 for w in chain))
    rows.append((whole, " ".join(w for w, n in chain.items() for _ in range(n))))
    got = spelling.variants(table(spark, rows), every=5, most=most).select("word", "form", "root", "n", "n_near", "form_n").collect()
    want = grouped(rows, 5)
    assert sorted(map(tuple, got)) == want and sum(w[1] is not None for w in want) > 20 and ('zzzza', 'zzzzab', 'zzzzabb', 3, 1, 7) in want
    assert spelling.variants(table(spark, [])).count() == 0


def test_automaton_numbers_words():
    rng = random.Random(2)
    words = sorted({"".join(rng.choice("abc") for _ in range(rng.randint(1, 6))) for _ in range(300)})
    own = spelling.Automaton(words)
    assert [own.ends(w, 0, own.root, 0) for w in words] == list(range(len(words))) and own.ends("zz", 0, own.root, 0) == -1
    assert len(own.next) < sum(map(len, words)) / 3, "states are shared"
    for w in words[::7]:
        assert {words[k] for k in own.near(w, len(w) // 2)} == {o for o in words if near(w, o) and o[: len(w) // 2] == w[: len(w) // 2]}
    assert spelling.Automaton([]).near("abc", 1) == set()


def test_digests_are_of_whole_texts(spark, corpus):
    got = substrings.dedup(table(spark, corpus)).where("doc_id = 904").first()
    text = next(t for i, t in corpus if i == 904)
    assert got.n_words == 3000 and hashlib.sha256(got.kept.encode()).digest() == hashlib.sha256(" ".join(text.split()).encode()).digest()

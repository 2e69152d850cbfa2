"""Long pre-tokens are merged by places, and count as the library counts them."""

import random
import time

from tokenizers import Tokenizer

from parlance.llm import token_counts

from .test_operators import VOCABULARY, docs


def test_long_runs(spark):
    rng = random.Random(3)
    texts = ["".join(rng.choice(some) for _ in range(n)) for some, n in (("abcdefghijklmnopqrstuvwxyz", 30_000), ("aab", 9000), ("日本語", 9000), ("0123456789", 9000), ("!?-", 9000))]
    texts += ["a" * 20_001, " " * 20_000 + "x"]
    library = Tokenizer.from_file(VOCABULARY)
    got = {r.doc_id: r.n_tokens for r in token_counts.token_counts(docs(spark, texts), VOCABULARY).collect()}
    assert [got[i] for i in range(1, len(texts) + 1)] == [len(library.encode(t, add_special_tokens=False).ids) for t in texts]


def test_places_are_the_rounds():
    """Both ways of merging agree on short pieces too."""
    rng, merger = random.Random(5), token_counts.Counter(VOCABULARY).merger
    pieces = ["".join(rng.choice(some) for _ in range(rng.randint(1, 80))).encode() for some in (rng.sample("abcdehinorst", rng.randint(1, 6)) for _ in range(1500))]
    assert merger.counts(pieces).tolist() == [merger.count_long(p) for p in pieces]


def test_time_of_a_long_run():
    rng = random.Random(4)
    text = "".join(rng.choice("abcdefghijklmnopqrstuvwxyz") for _ in range(200_000))
    counter, began = token_counts.Counter(VOCABULARY), time.time()
    assert counter.batch([text])[0] > 0 and time.time() - began < 20


def test_empty_table(spark):
    assert token_counts.token_counts(docs(spark, []), VOCABULARY).count() == 0

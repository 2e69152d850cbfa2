"""Results don't depend on the number of blocks, and items without an id count."""

import random

from parlance.llm import decontaminate

from .test_operators import docs, prose


def test_blocks_and_items_without_an_id(spark):
    rng = random.Random(12)
    common = prose(rng, 12)
    items = [(k if k % 3 else None, f"{common} {prose(rng, 25)}") for k in range(12)]
    texts = [prose(rng, 60)]
    for k, (_, text) in enumerate(items):
        words = text.split()
        words[15 + k % 9] = "other"
        if k % 2:
            words[2] = "other"
        texts.append(prose(rng, 20) + " " + " ".join(words) + " " + prose(rng, 20))
    bench = spark.createDataFrame(items, "item_id long, text string")
    found = lambda **how: sorted((tuple(r) for r in decontaminate.contaminated(docs(spark, texts), bench, similarity=0.5, **how).collect()), key=str)
    whole = found()
    assert {r[1] for r in whole} >= {None, 1} and len(whole) >= 6
    for parts in (5, 1):
        got = found(most_items=parts)
        assert [r[:5] for r in got] == [r[:5] for r in whole] and all(abs(a[5] - b[5]) < 1e-12 for a, b in zip(got, whole, strict=True))
    gone = {r[0] for r in whole}
    for how in ({}, {"most_items": 1}):
        assert {r.doc_id for r in decontaminate.clean(docs(spark, texts), bench, similarity=0.5, **how).collect()} == set(range(1, len(texts) + 1)) - gone

"""Near copies are decided by row: ids that repeat with other texts, and rows without an id."""

import random

from parlance.llm import ngram_join

from .test_operators import SCHEMA, prose
from .test_pipeline import ODD


def kept(spark, rows, **how):
    return sorted(((r.doc_id, r.text) for r in ngram_join.keep_one(spark.createDataFrame(rows, SCHEMA), **how).collect()), key=str)


def test_other_texts_of_one_id_stay(spark):
    assert kept(spark, ODD) == sorted([(1, ODD[0][1]), ODD[3], (3, None), (4, ""), *[r for r in ODD if r[0] is None]], key=str)
    rng = random.Random(7)
    a, b, c = (prose(rng, 60) for _ in range(3))
    near = " ".join([*a.split()[:-1], "changed"])
    assert kept(spark, [(1, a), (2, near), (2, b), (2, c), (2, c)]) == sorted([(1, a), (2, b), (2, c)], key=str)


def test_rows_without_an_id_are_members(spark):
    rng = random.Random(9)
    a, b, c = (prose(rng, 60) for _ in range(3))
    change = lambda t: " ".join([*t.split()[:-1], "changed"])
    rows = [(1, a), (None, change(a)), (None, b), (None, change(b)), (None, c), (None, c), (5, None), (None, "")]
    got = kept(spark, rows, without_id=True)
    assert sum(r[1] in (b, change(b)) for r in got) == 1
    assert [r for r in got if r[1] not in (b, change(b))] == sorted([(1, a), (None, c), (5, None), (None, "")], key=str)

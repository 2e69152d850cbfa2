"""The pipeline and its stages against a brute-force version, with nulls, repeated rows and clashing columns."""

import hashlib
import random

import public_tokenizers
import pytest
from pyspark.sql import functions as F
from tokenizers import Tokenizer

import corpus_pipeline
from parlance.llm import bpe, decontaminate, exact_dedup, ngram_join

from .test_operators import prose, similarity

DOCUMENTS = "doc_id long, text string, lang string, source string, n_chars long"


def fixture():
    """(documents, labels, benchmark): good and bad prose, exact and near copies, items inside documents."""
    rng = random.Random(11)
    item = prose(rng, 40)
    good = [prose(rng, 90) + "." for _ in range(60)]
    bad = [" ".join([rng.choice("abc") * 3 + "%%%"] * 60) for _ in range(30)]
    near = []
    for base in good[:5]:
        words = base.split()
        words[40] = "changed"
        near.append(" ".join(words))
    held = [prose(rng, 50) + " " + item + " " + prose(rng, 30) + ".", good[20] + " " + item.upper() + "."]
    texts = good + bad + near + good[5:9] + held
    rows = [(i, t, "xx", "s", len(t)) for i, t in enumerate(texts, 1)]
    rows += [rows[30], (None, good[31], None, None, None), (None, prose(rng, 70) + ".", "xx", None, 1)]
    labels = [(i, int(i <= 60), 0) for i in range(1, 91)]
    return rows, labels, [(1, item), (2, prose(rng, 30)), (3, None)]


def brute(rows, item):
    """Ids of what stays, None for rows without an id."""
    left = [r for r in rows if "%%%" not in (r[1] or "")]
    best = {}
    for r in left:
        if r[1] not in best or (r[0] or -1) > (best[r[1]][0] or -1):
            best[r[1]] = r
    left = sorted(best.values(), key=lambda r: (r[0] is None, r[0] or 0))
    classes = []
    for r in left:
        if r[0] is None or not any(similarity(r[1], k[1]) >= 0.8 for k in classes if k[0] is not None):
            classes.append(r)
    return [r for r in classes if item not in r[1].lower()]


@pytest.fixture(scope="module")
def tables(spark, tmp_path_factory):
    rows, labels, items = fixture()
    path = str(tmp_path_factory.mktemp("corpus"))
    spark.createDataFrame(rows, DOCUMENTS).write.parquet(f"{path}/documents.parquet")
    spark.createDataFrame(labels, "doc_id long, quality int, toxic int").write.parquet(f"{path}/labels.parquet")
    spark.createDataFrame(items, "item_id long, text string").write.parquet(f"{path}/benchmark.parquet")
    return path, rows, items[0][1]


def test_run_is_the_brute_force_version(spark, tables):
    path, rows, item = tables
    library = Tokenizer.from_file(public_tokenizers.path(corpus_pipeline.VOCABULARY))
    want = []
    for i, text, *_ in brute(rows, item):
        ids = library.encode(text, add_special_tokens=False).ids
        want.append((i, len(ids), hashlib.sha256(bpe.packed(ids)).hexdigest(), hashlib.sha256(text.encode()).hexdigest()))
    got = [tuple(r) for r in corpus_pipeline.run(spark, path).select("doc_id", "n_tokens", "ids_sha256", "decoded_sha256").collect()]
    assert sorted(got, key=str) == sorted(want, key=str)


def test_stages_keep_columns_and_take_empty_tables(spark, tables):
    path = tables[0]
    clash = {c: F.lit("x") for c in ("n", "entry", "digest", "recipe", "kept", "keep_id", "class_id", "text_sha256", "label", "item_id", "bucket")}
    docs = spark.read.parquet(f"{path}/documents.parquet").withColumns(clash)
    for name, stage in corpus_pipeline.STAGES:
        for rows in (docs, docs.limit(0)):
            out = stage(spark, rows, path)
            assert out.count() <= rows.count(), name
            if name != corpus_pipeline.STAGES[-1][0]:
                assert out.columns == docs.columns, name
        none = docs.select(*[F.lit(None).cast(t).alias(c) for c, t in docs.dtypes])
        assert stage(spark, none, path).count() <= none.count(), name


ODD = [(1, "one two three four five six"), (1, "one two three four five six"), (2, "one two three four five six"), (2, "another text with that same id"), (None, "one two three four five six"), (None, "no id at all"), (None, "no id at all"), (3, None), (None, ""), (4, "")]


def test_exact_copies_with_repeated_and_missing_ids(spark):
    docs = spark.createDataFrame(ODD, "doc_id long, text string")
    got = sorted(((r.doc_id, r.text) for r in exact_dedup.keep_one(docs).collect()), key=str)
    assert got == sorted([(2, ODD[2][1]), (2, ODD[3][1]), (4, ""), (None, "no id at all")], key=str)


def test_near_copies_with_repeated_and_missing_ids(spark):
    docs = spark.createDataFrame([r for r in ODD if r != ODD[3]], "doc_id long, text string")
    got = sorted(((r.doc_id, r.text) for r in ngram_join.keep_one(docs).collect()), key=str)
    assert got == sorted([(1, ODD[0][1]), (3, None), (4, ""), *[r for r in ODD if r[0] is None]], key=str)


def test_items_in_rows_without_an_id(spark):
    item = " ".join(f"w{k}" for k in range(20))
    docs = spark.createDataFrame([(1, "clean words"), (None, f"x {item} y"), (None, "clean too"), (2, item), (2, "clean as well"), (3, None)], "doc_id long, text string")
    bench = spark.createDataFrame([(1, item), (2, "other item of the benchmark")], "item_id long, text string")
    for how in ({}, {"most_items": 1}):
        got = {r.text for r in decontaminate.clean(docs, bench, **how).collect()}
        assert got == {"clean words", "clean too", "clean as well", None}

"""The validation report."""

import glob
import json

from parlance import cli
from parlance.operators import validation
from pyspark.sql import functions as F


def rows(spark, given):
    schema = ", ".join(f"{c} {t}" for c, t in validation.COLUMNS.items())
    return spark.createDataFrame(given, schema)


def test_counts_and_pages(spark):
    df = rows(spark, [
        ("A", "x1", "warning", "NUMBERS", None, None, None, None, None, 3), ("A", "x1", "warning", "ACCENTS", None, None, None, None, None, 2), ("A", "x2", "warning", "NUMBERS", None, None, None, None, None, 1),
        ("A", "x2", "error", "UNBALANCED_DOTS", 7, "S", "a</b>", None, None, 1), ("A", "x2", "error", "TOKEN_TYPE_ERROR", 3, "S", "t", "a1", None, 1), ("A", "x2", "metadata", None, None, None, None, None, "gone", 1),
        ("B", "y1", "no-transcript", None, None, None, None, None, "no transcript", 1),
    ])
    sums = {(r.level, r.module, r.code, r.kind, r.rule): (r.n, r.conversations) for r in validation.totals(df).collect()}
    assert sums["module", "A", None, None, None] == (9, 2) and sums["rule", "A", None, "warning", "NUMBERS"] == (4, 2)
    assert sums["conversation", "A", "x1", None, None] == (5, 1) and sums["conversation rule", "A", "x1", "warning", "ACCENTS"] == (2, 1) and len(sums) == 2 + 6 + 3 + 7
    every = spark.createDataFrame([("A", "x1"), ("A", "x2"), ("A", "x3"), ("B", "y1")], "module string, code string")
    pages = validation.log_pages(every, validation.totals(df))
    got = {r.module: r for r in pages.collect()}
    assert (got["A"].conversations, got["A"].with_warnings, got["B"].with_warnings) == (3, 2, 0)
    assert "|x1 |ACCENTS:2, NUMBERS:3 |_\n|x2 |NUMBERS:1 |1\n|===" in got["A"].text and got["B"].text.endswith("tokens\n|===\n")
    assert "|A |3 |2\n|B |1 |0\n" in validation.log_overview(pages).first().text
    found = validation.records(df, (F.concat(F.lit("t/"), "code"), F.lit("e"))).orderBy("module", "place")
    got = [json.loads(r.json) for r in found.collect()]
    assert [(r["kind"], r["rule"]) for r in got] == [("metadata", None), ("error", "UNBALANCED_DOTS"), ("error", "TOKEN_TYPE_ERROR"), ("no-transcript", None)]
    assert got[1]["text"] == "a</b>" and got[1]["tsvUrl"] == "t/x2" and got[3]["tsvUrl"] is None and "span" not in got[0] and got[2]["span"] == "a1"
    pages = {r.module: r for r in validation.error_pages(found, limit=2).collect()}
    assert pages["A"].records == 3 and pages["A"].text.count('"kind"') == 2 and "</b>" not in pages["A"].text
    assert validation.totals(df.limit(0)).count() == 0 and validation.error_pages(found.limit(0)).count() == 0


def test_report_of_units(spark, tmp_path):
    (tmp_path / "BOA1.csv").write_text("tu_id\tspeaker\tstart\tend\tduration\ttext\n0\tA\t0.0\t1.0\t1.0\tho 2 °case\n1\tB\t1.5\t2.0\t0.5\tsì\n", encoding="utf-8")
    args = type("A", (), {"verb": "report", "input": f"{tmp_path}/*.csv", "output": f"{tmp_path}/out", "config": None, "threshold": None, "annotations": None})
    assert cli.run(spark, args) == 1
    text = lambda kind: "".join(open(p).read() for p in glob.glob(f"{tmp_path}/out/{kind}/*/part*"))
    assert "|BOA1 |NUMBERS:1 |_" in text("log") and "UNBALANCED_DOTS" in text("errors") and json.loads(text("records").strip())["tuId"] == 0

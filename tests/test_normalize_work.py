from pyspark.sql import functions as F

from parlance.operators.normalize import CORRECTIONS, WARNINGS, apply_checks, apply_rules
from parlance.plans.rules import CHARACTERS, norm_documents


def test_documents_of_one_row_group_are_dealt_by_size(spark, tmp_path):
    long = "di x. " * (CHARACTERS // 60)
    spark.range(60).select(F.col("id").alias("doc_id"), F.lit(long).alias("text")).coalesce(1).write.parquet(f"{tmp_path}/documents.parquet")
    assert norm_documents(spark, str(tmp_path)).rdd.getNumPartitions() == 6


def test_corrections_in_one_pass(spark):
    words = [w for pair in CORRECTIONS for w in pair]
    texts = [f"{a}{gap}{b} {a}" for a in words for b in words for gap in " ="]
    [rule] = [r for r in WARNINGS if r.name == "WORD_CORRECTIONS"]
    assert len(rule.steps) == 1
    rows = spark.createDataFrame([(t, t) for t in texts], "old string, text string")
    step, n = F.col("old"), F.lit(0)
    for wrong, right in CORRECTIONS:
        pattern = rf"(?<![^ =])\Q{wrong}\E(?![^ =])"
        n = n + F.regexp_count(step, F.lit(pattern))
        step = F.regexp_replace(step, pattern, right)
    got = apply_rules(rows, [rule]).select("text", "w_WORD_CORRECTIONS", step.alias("by_steps"), n.alias("n")).collect()
    assert [(r.text, r.w_WORD_CORRECTIONS) for r in got] == [(r.by_steps, r.n) for r in got]


def test_texts_without_marks_and_null(spark):
    rows = apply_checks(apply_rules(spark.createDataFrame([("  a ",), ("",), (None,), ("[]  ",), ("(",)], "text string"), WARNINGS)).collect()
    assert [r.text for r in rows] == ["a", "", None, "", ""]
    assert [r.w_EMPTY_UNIT for r in rows] == [0, 1, 0, 0 + 1, 1]

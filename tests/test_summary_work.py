"""Summaries are put together without joins, in as many tasks as the text asks for, and are the same however they are dealt."""

import json
import re

from pyspark.sql import functions as F

from parlance.operators import formats, tokens
from parlance.operators.units import prepare
from parlance.plans import process

TEXTS = ["ciao [bello] *", "[sì c(io)è ((ride)) xx (.)", "", "[]", "# uno °due", "#_ hello * there", "a * b [c"]


def frame(spark, transcripts=9, turns=14):
    rows = [(f"t{k}", i, "AB"[i % 2], 0.1 * i, 0.1 * i + 0.7 + 0.01 * k, TEXTS[(i + k) % 7]) for k in range(transcripts) for i in range(turns)] + [("none", 0, "A", 0.0, 1.0, ""), ("plain", 0, "A", 0.0, 1.0, "ciao")]
    return spark.createDataFrame(rows, "transcript_id string, tu_id int, speaker string, start double, end double, text string")


def test_a_summary_is_dealt_by_characters_once(spark, monkeypatch):
    monkeypatch.setattr(process, "CHARACTERS", 100)
    df = frame(spark)
    characters = prepare(df).agg(F.sum(F.length("text"))).first()[0]
    got = process.process(df)["summary"]
    plan = got._jdf.queryExecution().executedPlan().toString()
    assert "Join" not in plan and len(re.findall(r"\bExchange ", plan)) == 1
    assert characters > 500 and got.rdd.getNumPartitions() == -(-characters // 100)


def test_a_summary_has_what_its_units_and_tokens_have(spark):
    done = process.process(frame(spark))
    units, toks = done["units"].collect(), done["tokens"].collect()
    events = {(r.transcript_id, r.event) for r in done["overlaps"].collect()}
    got = {r.transcript_id: json.loads(r.json) for r in done["summary"].collect()}
    assert got.keys() == {r.transcript_id for r in units}
    for t, one in got.items():
        own = sorted((r for r in units if r.transcript_id == t and r.include), key=lambda r: r.tu_id)
        said = [r for r in toks if r.transcript_id == t]
        want = {"transcript": t, "TUs": len(own), "removed_TUs": sum(r.transcript_id == t and not r.include for r in units), "overlaps": sum(e[0] == t for e in events)}
        for who in sorted({r.speaker for r in own}):
            mine, words = [r for r in own if r.speaker == who], [r for r in said if r.speaker == who]
            time = 0.0
            for r in mine:
                time += r.duration
            kinds = {f"tokens-{k}": sum(r.type == name for r in words) for k, name in formats.TYPES.items()}
            want.setdefault("speakers", {})[who] = {"TUs": len(mine), "time": time, "tokens": len(words), **kinds, "code-switching": sum(r.variation != "none" for r in mine)}
        sums = {mark: {c[2:]: n for c in sorted(units[0].__fields__) if c.startswith(mark) and (n := sum(int(r[c] or 0) for r in own))} for mark in ("w_", "e_")}
        if sums["w_"] or sums["e_"]:
            want |= {"WARNINGS": sums["w_"], "ERRORS": sums["e_"]}
        details = [{"tu_id": r.tu_id, "rule": c[2:], "speaker": r.speaker, "text": r.text} for r in own for c in sorted(r.__fields__) if c.startswith("e_") and r[c]]
        wrong = [{"tu_id": r.tu_id, "idx": r.idx, "speaker": r.speaker, "span": r.span, "form": r.form, "context": r.text} for r in sorted(said, key=lambda r: (r.tu_id, r.idx)) if r.type == "error"]
        want |= ({"ERROR_DETAILS": details} if details else {}) | ({"ERROR_TOKENS": wrong} if wrong else {})
        assert one == want
    assert "speakers" not in got["none"] and "ERRORS" not in got["plain"] and any("ERROR_TOKENS" in x for x in got.values()) and any("ERROR_DETAILS" in x for x in got.values()) and any(x["overlaps"] for x in got.values())


def test_a_summary_is_the_same_in_more_tasks(spark):
    ready = prepare(frame(spark)).withColumn("duration", F.col("end") - F.col("start"))
    plain = tokens.tokenize(ready)
    counts = plain.groupBy("transcript_id", "tu_id", "speaker", "variation").agg(*formats.type_counts())
    rows = [sorted(map(tuple, formats.json_summary(ready, counts, plain, tasks=n).collect())) for n in (None, 1, 7, 40)]
    assert len(rows[0]) == 11 and all(x == rows[0] for x in rows)

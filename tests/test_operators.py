"""Overlaps, formats, fields, metadata, patches, alignment, reports, files and the whole way."""

import random
from itertools import combinations

from pyspark.sql import functions as F

from parlance.functions import fields as X
from parlance.operators import alignment, formats, metadata, overlaps, patches
from parlance.sources import config, files


def units(spark, rows, **columns):
    return spark.createDataFrame([("t", i, float(s), float(e)) for i, (s, e) in enumerate(rows)], "transcript_id string, tu_id int, start double, end double").withColumns({k: F.lit(v) for k, v in columns.items()})


def test_overlap_pairs_and_slots(spark):
    rng = random.Random(1)
    rows = [(s := rng.uniform(0, 50), s + rng.uniform(0.1, 9)) for _ in range(40)] + [(100, 101), (101, 102)]
    want = {(i, j) for i, j in combinations(range(len(rows)), 2) if rows[i][1] > rows[j][0] and rows[j][1] > rows[i][0]}
    for width in (None, 5):
        assert {(r.u, r.v) for r in overlaps.overlap_join(units(spark, rows), width).collect()} == want
    graph = {tuple(r.members) for r in overlaps.cliques(overlaps.overlap_join(units(spark, rows))).collect()}
    sweep = {tuple(r.members) for r in overlaps.interval_cliques(units(spark, rows)).collect()}
    assert graph == sweep
    every = {frozenset(c) for c in graph}
    assert all(all((min(a, b), max(a, b)) in want for a, b in combinations(c, 2)) for c in every) and not any(a < b for a in every for b in every)


def test_short_overlap_is_nudged_away(spark):
    df = units(spark, [(0, 1.05), (1, 2)], n_spans=0, all_nvb=False, any_nvb=False)
    got = overlaps.resolve(df, 0.1)
    assert [(round(r.start, 6), round(r.end, 6), r.moved) for r in got["units"].orderBy("tu_id").collect()] == [(0.0, 1.025, 1), (1.025, 2.0, 1)]
    assert got["members"].count() == 0 and {r.outcome for r in got["verdicts"].collect()} == {"matched"}


def test_spans_match_events(spark):
    df = units(spark, [(0, 2), (1, 4), (3, 5), (8, 9)], all_nvb=False, any_nvb=False).withColumn("n_spans", F.element_at(F.array(*map(F.lit, [1, 2, 0, 1])), F.col("tu_id") + 1))
    got = overlaps.resolve(df, 0.1)
    assert {(r.tu_id, r.span_id): r.event for r in got["matches"].collect()} == {(0, 0): "0", (1, 0): "0", (1, 1): "1", (3, 0): "?"}
    assert {r.tu_id: r.error for r in got["verdicts"].collect()} == {0: None, 1: None, 2: "OVERLAPS:MISSING_ANNOTATION", 3: "OVERLAPS:MISSING_TIME"}
    assert [(r.partners, r.duration) for r in got["durations"].collect()] == [("1", 1.0)]


def one(spark, column, **values):
    return spark.range(1).select(*[F.lit(v).alias(k) for k, v in values.items()]).select(column).first()[0]


def test_fields(spark):
    x = F.col("x")
    assert one(spark, X.format_feats(X.feats(x)), x="A=1|B|A=2") == "A=2|B" and one(spark, X.format_feats(X.feats(x)), x="_") == "_"
    assert one(spark, X.with_prolongations(x, F.col("y")), x="ciao", y="2x3,3x1") == "cia:::o:"
    assert one(spark, X.form_from_span(x), x="$[CIA::o],") == "ciao" and one(spark, X.form_from_span(x), x="((ride))") is None
    assert one(spark, X.format_feats(X.feats_from_span(x)), x="°po'°.") == "Volume=Low|Intonation=Falling"
    assert one(spark, X.clock(F.lit(3_661_000))) == "1:01:01" and one(spark, X.iso_duration(x), x="00:07:09") == "PT7M9S" and one(spark, X.iso_duration(x), x="soon") == "soon"
    assert one(spark, X.milliseconds(x, "Begin"), x="Begin=1.0005|End=2") == 1000 and one(spark, X.clique_ids(x), x="0-3(1),2-4(?)") == ["1"]
    assert one(spark, X.latex(x), x="a_b&~") == r"a\_b\&\textasciitilde{}" and one(spark, X.xml(x), x='<&">') == "&lt;&amp;&quot;&gt;"
    assert one(spark, X.multivalue(x), x="b; a;b") == "b,a" and one(spark, X.infer_type(x), x="xx") == "unknown"


VERT = [("0-0", "A", "l'", "l'", "linguistic", "SpaceAfter=No", "Begin=0.0"), ("0-1", "A", "albero,", "albero", "linguistic", "Intonation=WeaklyRising|ProsodicLink=Yes", "_"), ("0-2", "A", "(.)", "(.)", "shortpause", "_", "_"), ("0-3", "A", "xxx", "xxx", "unknown", "_", "_"), ("0-4", "A", "@no", "@no", "anonymized", "_", "End=1.5")]


def vert(spark):
    rows = [("t", k, i, s, 0, str(k), sp, f, ty, jf, al) for k, (i, s, sp, f, ty, jf, al) in enumerate(VERT)]
    df = spark.createDataFrame(rows, "transcript_id string, line int, token_id string, speaker string, tu_id int, id string, span string, form string, type string, jefferson_feats string, align string")
    return df.withColumns({c: F.lit("_") for c in ("lemma", "upos", "xpos", "feats", "deprel", "meta_label", "prolongations", "pace", "guesses", "overlaps")} | {"variation": F.lit("unspecified")})


K = ["transcript_id", "tu_id"]


def test_texts(spark):
    r = formats.linear(vert(spark), K).first()
    assert r.jefferson == "l'albero,=(.) xxx" and r.orthographic == "l'albero xxx"
    r = formats.rebuilt(vert(spark), K).first()
    assert r.text == "# l'albero,=(.) xxx @no" and (r.start, r.end) == (0.0, 1.5)
    # a linked token takes the place of the character before it, be it a space or not
    lines = formats.conllu(vert(spark), K).first().text.split("\n")
    assert lines[:4] == ["# sent_id = 0", "# text = lalbero xxx @no", "# jefferson_text = l=albero, (.) xxx @no", "# speaker_id = A"] and "PauseAfter=Yes" in lines[5] and "KID=0-1" in lines[5] and len(lines) == 9
    tei = formats.tei(vert(spark)).first().text
    assert '<when xml:id="T1" absolute="PT1.500S"/>' in tei and 'who="#A"' in tei and '<pause dur="short"/>' in tei and 'join="right"' in tei
    assert formats.chat(vert(spark)).first().text == "*A:\tl' albero (.) xxx xxx . \x150_1500\x15"
    meta = spark.createDataFrame([("t", "x", "00:01:00")], "code string, type string, duration string")
    people = spark.createDataFrame([("A", "F")], "code string, gender string")
    text = formats.vertical(vert(spark), meta, people, "http://h/").first().text
    assert '<annotation begin="0" end="1500"' in text and 'participant_sex="F"' in text and text.endswith("//\n</annotation>\n</conversation>\n</doc>")
    assert "<g/>" in formats.vertical(vert(spark), meta, people, "http://h/", dynamic=True).first().text


def test_eaf_round_trip(spark, tmp_path):
    df = spark.createDataFrame([("t", 0, "A", 0.0, 1.5, "ciao <b> & c", True), ("t", 1, "B", 1.0, 2.0, "sì", True)], "transcript_id string, tu_id int, speaker string, start double, end double, text string, include boolean")
    (tmp_path / "t.eaf").write_text(formats.eaf(df).first().text, encoding="utf-8")
    got = files.read_eaf(spark, str(tmp_path / "t.eaf")).orderBy("tu_id").collect()
    assert [(r.transcript_id, r.tu_id, r.speaker, r.start, r.end, r.text) for r in got] == [("t", 0, "A", 0.0, 1.5, "ciao <b> & c"), ("t", 1, "B", 1.0, 2.0, "sì")]


def test_files(spark, tmp_path):
    (tmp_path / "c.csv").write_text('tu_id\tspeaker\tstart\tend\tduration\ttext\tparent_tu_id\n0\tA\t0.0\t1.0\t1.0\t"dice ""ciao"""\t_\n1\tA_trad\t0.0\t1.0\t1.0\thello\t0\n2\tnoise\t0\t1\t1\t\t_\n', encoding="utf-8")
    got = files.read_units(spark, str(tmp_path / "c.csv"), ignore=["noise"], suffix="_trad").orderBy("tu_id").collect()
    assert [(r.transcript_id, r.text, r.target, r.parent_tu_id) for r in got] == [("c", 'dice "ciao"', "unit", None), ("c", "hello", "translation", 0), ("c", "", "ignored", None)]
    (tmp_path / "l.txt").write_text("A\tciao\nno tab\n", encoding="utf-8")
    assert [(r.speaker, r.text) for r in files.read_linear(spark, str(tmp_path / "l.txt")).orderBy("line").collect()] == [("A", "ciao"), ("???", "no tab")]
    assert files.read_metadata(spark, str(tmp_path / "absent.tsv")).count() == 0
    assert config.merged({"a": {"b": 1, "c": [1]}, "d": 1}, {"a": {"c": [2]}}) == {"a": {"b": 1, "c": [2]}, "d": 1}


def test_alignment(spark):
    df = spark.createDataFrame([(1, ["a", "b", "c"], ["a", "x", "c", "d"]), (2, [], None)], "k int, a array<string>, b array<string>")
    rows = alignment.alignment_rows(df, ["k"])
    assert [(r.a, r.b, r.match) for r in rows.orderBy("position").collect()] == [("a", "a", 0), ("b", "x", 2), ("c", "c", 0), ("_", "d", 1)]
    r = alignment.error_rate(rows, ["k"]).first()
    assert (r.substitutions, r.deletions, r.insertions, r.n, round(r.wer, 4), r.score) == (1, 0, 1, 3, 0.6667, 0.625)
    assert alignment.word_cursor(["ciao", "sì", "no"], ["ciao,", "(.)", "sì", "no."]) == [0, 2, 3]


def test_lemma_rows_and_feats(spark):
    df = spark.createDataFrame([("1-0", " a ", "a"), ("1-0b", "x", "x")], "token_id string, span string, form string")
    assert [tuple(r) for r in patches.lemma_rows(df).collect()] == [("1-0", "a", "a")]
    got = one(spark, patches.updated_feats(F.col("f"), F.col("s"), F.lit(True), F.col("l")), f="Intonation=Rising|ProsodicLink=Yes", s="Ciao.", l="eng")
    assert got == "Volume=High|Intonation=Falling|ProsodicLink=Yes|Lang=eng"


def test_merge_keeps_first(spark):
    a = spark.createDataFrame([("P1", "x", 0), ("P1", "y", 1)], "code string, occupation string, line int")
    b = spark.createDataFrame([("P1", "z", 0), ("P2", "w:sub", 1)], "code string, `school-region` string, line int")
    got = metadata.merged([a, b], metadata.PARTICIPANTS, {"school-region": "birth-region"}, ("birth-region",)).orderBy("code").collect()
    assert [(r.code, r.occupation, r["birth-region"]) for r in got] == [("P1", "x", ""), ("P2", "", "w")]


def test_process_and_refresh(spark, tmp_path):
    from parlance.plans.process import process
    from parlance.streaming.refresh import refresh_stream

    rows = [("t", 0, "A", 0.0, 2.0, "ciao [bello]"), ("t", 1, "B", 1.0, 3.0, "[sì] c(io)è ((ride))"), ("t", 2, "A_trad", 0.0, 1.0, "hello"), ("t", 3, "A", 5.0, 6.0, "[]")]
    df = spark.createDataFrame(rows, "transcript_id string, tu_id int, speaker string, start double, end double, text string")
    got = process(df)
    vert = {r.token_id: r for r in got["vert"].collect()}
    assert vert["0-1"].overlaps == "0-5(0)" and vert["1-0"].overlaps == "0-2(0)" and "Reduced=Yes" in vert["1-1"].jefferson_feats and vert["0-0"].align == "Begin=0.0"
    text = got["summary"].first().json
    assert '"TUs":2' in text and '"removed_TUs":1' in text and '"overlaps":1' in text
    assert got["translations"].count() == 1
    df.coalesce(1).write.parquet(str(tmp_path / "in"))
    for _ in range(2):
        refresh_stream(spark, str(tmp_path / "in"), str(tmp_path / "out"), str(tmp_path / "state")).awaitTermination(120)
    assert spark.read.parquet(str(tmp_path / "out/vert")).count() == len(vert)

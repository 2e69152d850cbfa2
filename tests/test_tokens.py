from parlance.operators import tokens as T
from parlance.operators import units as U


def units(spark, texts, **config):
    df = spark.createDataFrame([("t", i, "A", float(i), float(i) + 1, t) for i, t in enumerate(texts)], "transcript_id string, tu_id int, speaker string, start double, end double, text string")
    return U.prepare(df)


def plain(spark, texts):
    """Units that are normalised already."""
    rows = [("t", i, "A", float(i), float(i) + 1, t.removeprefix("#_ "), "all" if t.startswith("#_") else "none", True) for i, t in enumerate(texts)]
    return spark.createDataFrame(rows, "transcript_id string, tu_id int, speaker string, start double, end double, text string, variation string, include boolean")


def toks(spark, texts, markers=()):
    return T.tokenize(plain(spark, texts), markers=markers).orderBy("tu_id", "idx").collect()


def test_prepare(spark):
    got = {r.tu_id: r for r in units(spark, ["", "  ", "#_ foreign  words", "# sì certo", "[][]", "c(io)è (forse) ((ride))", "°piano° <lento> SÌ CERTO", None]).collect()}
    assert [got[i].include for i in range(8)] == [False, False, True, True, False, True, True, False]
    assert got[2].variation == "all" and got[2].text == "foreign  words" and got[2].w_MULTIPLE_SPACES == 0
    assert got[3].variation == "unspecified" and got[3].text == "sì certo"
    assert [(x.s, x.e) for x in got[5].reduction_spans] == [(1, 5)] and [(x.s, x.e) for x in got[5].guess_spans] == [(7, 14)]
    assert [(x.s, x.e) for x in got[6].low] == [(0, 7)] and [(x.s, x.e) for x in got[6].slow] == [(8, 15)] and [(x.s, x.e) for x in got[6].high] == [(16, 24)]


def test_split_and_offsets(spark):
    got = toks(spark, ["l'albero=verde (.) sì"])
    assert [(r.span, r.s, r.e) for r in got] == [("l'", 0, 2), ("albero", 2, 8), ("verde", 9, 14), ("(.)", 15, 18), ("sì", 19, 21)]
    assert [r.space_after for r in got] == [False, True, True, True, True]
    assert [r.link for r in got] == [False, True, False, False, False]
    assert [r.pause_after for r in got] == [False, False, True, False, False]
    assert not got[0].truncated and (got[0].first, got[-1].last) == (True, True)


def test_classes(spark):
    words = {"(.)": "shortpause", "((ride))": "nonverbalbehavior", "@nome": "anonymized", "{P}": "shortpause", "{x}": "nonverbalbehavior", "xxx": "unknown", "po':": "linguistic", "ciao,": "linguistic", "a1": "error", "'sto": "linguistic", "ann-": "linguistic", "non-so": "linguistic"}
    got = toks(spark, [" ".join(words)])
    assert [r.type for r in got] == list(words.values())
    assert got[6].form == "po'" and got[5].syllables == 3 and got[7].intonation == "WeaklyRising" and got[7].form == "ciao"
    assert got[9].truncated and got[10].interrupted and not got[6].truncated


def test_variation_markers(spark):
    got = toks(spark, ["#ciao $bello #*strano #1"], ("hash_doubtful", "hash_token", "dollar"))
    assert [(r.type, r.token_variation, r.form) for r in got] == [("linguistic", "token", "ciao"), ("linguistic", "emerging", "bello"), ("linguistic", "doubtful", "strano"), ("warning", "token", "1")]
    assert [r.language for r in got] == ["NO_ISO_CODE", None, "NO_ISO_CODE", "NO_ISO_CODE"]
    assert [r.type for r in toks(spark, ["#ciao"])] == ["error"]


def test_foreign_units_keep_empty_pieces(spark):
    got = toks(spark, ["#_ a  b (.)"])
    assert [(r.span, r.type) for r in got] == [("a", "linguistic"), ("", "linguistic"), ("b", "linguistic"), ("(.)", "linguistic")]
    assert not any(r.pause_after for r in got)


def test_prolongations_and_volume(spark):
    r = toks(spark, ["CIA::o:?"])[0]
    assert (r.form, r.volume, r.intonation) == ("ciao", "high", "Rising") and [(p.at, p.n) for p in r.prolongations] == [(2, 2), (3, 1)]


def test_spans_on_tokens(spark):
    u = units(spark, ["[ciao bel]lo l'[albero] °piano° (non so)", "c(io)è m(e l)o"])
    got = T.with_spans(T.tokenize(u), u, ["cioè"]).orderBy("tu_id", "idx").collect()
    assert [r.guesses for r in got if r.tu_id == 0] == [None, None, None, None, None, "0-3(0)", "0-2(0)"]
    assert got[4].volume == "low"
    assert [(r.reduced, r.guesses) for r in got if r.tu_id == 1] == [(True, None), (False, "1-2(1)"), (False, "0-1(1)")]


def test_unit_variation(spark):
    t = T.tokenize(units(spark, ["#ciao bello", "#ciao", "# ciao", "ciao"]), markers=("hash_token",))
    assert {r.tu_id: r.variation for r in T.unit_variation(t).collect()} == {0: "yes", 1: "all", 2: "unspecified", 3: "none"}

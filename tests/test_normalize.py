from parlance.functions.italian import cardinal
from parlance.functions.matches import map_matches, spans
from parlance.operators.normalize import ERRORS, WARNINGS, apply_checks, apply_rules, normalize
from pyspark.sql import functions as F


def rows(spark, texts):
    return spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "n int, text string")


def one_rule(spark, numbers, cases):
    """cases: text, text afterwards, changes."""
    rules = [WARNINGS[n] for n in numbers]
    got = apply_rules(rows(spark, [c[0] for c in cases]), rules).orderBy("n").collect()
    assert [(r.text, r[f"w_{rules[0].name}"]) for r in got] == [(c[1], c[2]) for c in cases]


def test_symbols(spark):
    one_rule(spark, [0], [("ciao! «bella»", "ciao bella", 3), ("è così: [sì]", "è così: [sì]", 0), ("#*x $y @z", "#*x $y @z", 0), ("", "", 0)])


def test_meta_tags(spark):
    one_rule(spark, [1], [("((ride forte)) sì", "((ride_forte)) sì", 1), ("((ride)) ((fa un po'))", "((ride)) ((fa_un_po'))", 2), ("niente", "niente", 0)])


def test_spacing(spark):
    cases = [
        ("bla[ ciao]", "bla [ciao]", 1), ("[ ciao]", "[ciao]", 1), ("[ciao ]bla", "[ciao] bla", 1), ("[ciao ]", "[ciao]", 1), ("ciao ,bla", "ciao, bla", 1),
        ("ciao ,", "ciao,", 1), ("ciao(.)bene", "ciao (.) bene", 2), ("sì((ride))", "sì ((ride))", 1),
    ]
    one_rule(spark, [2], cases)


def test_trimming(spark):
    one_rule(spark, [3], [("(.) sì (.)", "sì", 2), ("[(.) sì]", "[sì]", 1), ("sì (.) no", "sì (.) no", 0)])
    one_rule(spark, [4], [("=sì=", "sì", 2), ("sì = no", "sì = no", 0)])
    one_rule(spark, [5], [("sì = no", "sì= no", 1)])


def test_prolongation_and_spaces(spark):
    one_rule(spark, [6], [("ci:[:ao]", "c[i::ao]", 1)])
    one_rule(spark, [7], [("a\t\tb\nc   d", "a b c d", 3)])


def test_accents(spark):
    one_rule(spark, [8], [("perchè no", "perché no", 1), ("nè questo", "né questo", 1), ("caffè", "caffè", 0)])
    one_rule(spark, [9], [("un pò", "un po'", 1), ("p:ò", "p:o'", 1), ("però", "però", 0)])
    one_rule(spark, [10], [("pero' sì", "però sì", 1), ("perche'", "perché", 1), ("puo'", "può", 1)])


def test_corrections(spark):
    one_rule(spark, [11], [("va beh", "vabbè", 1), ("hm sì", "mh sì", 1), ("m(e l)o", "m(e l)o", 0), ("m m", "mh mh", 2), ("mhm", "mhmh", 1), ("cè=cè", "c(io)è=c(io)è", 2)])


def test_numbers(spark):
    cases = {"0": "zero", "3": "tre", "23": "ventitré", "28": "ventotto", "100": "cento", "108": "centotto", "180": "centottanta", "1000": "mille", "2001": "duemilauno", "1000000": "un milione", "2500000": "due milioni e cinquecentomila", "103": "centotré", "13": "tredici"}
    got = rows(spark, list(cases)).orderBy("n").select(cardinal(F.col("text"))).collect()
    assert [r[0] for r in got] == list(cases.values())
    one_rule(spark, [12], [("ho 2 cani e 33 gatti", "ho due cani e trentatré gatti", 2)])


def test_inner_spaces(spark):
    one_rule(spark, [13], [("° piano °", "°piano°", 2), ("°piano° forte", "°piano° forte", 0)])
    one_rule(spark, [14], [("< lento > e > veloce <", "<lento> e >veloce<", 4), ("< aperto", "<aperto", 1)])


def test_switches(spark):
    one_rule(spark, [15], [("sì.:", "sì:.", 1), ("[sì,]", "[sì],", 1), ("a.b", "ab.", 1), ("sì,-", "sì,-", 0)])
    one_rule(spark, [16], [("[((ride)) sì]", "((ride)) [ sì]", 1), ("((.) sì)", "(.) ( sì)", 1), ("[(.) sì]", "[(.) sì]", 0), ("<sì (.)>", "<sì > (.)", 1)])


def test_empty(spark):
    one_rule(spark, [18], [("sì [] no", "sì no", 1), ("< >", "", 1)])
    one_rule(spark, [19], [("[]()<>°-'#", "", 1), ("sì", "sì", 0)])


def test_errors(spark):
    faults = {"ok": [], "°a": ["UNBALANCED_DOTS"], "<a": ["UNBALANCED_PACE"], "<<a>>": ["UNBALANCED_PACE"], ">a< <b>": [], "(a": ["UNBALANCED_GUESS"], "((ride)) (.)": [], "[a]]": ["UNBALANCED_OVERLAP"], "[[a]]": ["UNBALANCED_OVERLAP"]}
    got = apply_checks(rows(spark, list(faults))).orderBy("n").collect()
    assert [[c.name for c in ERRORS if r[f"e_{c.name}"]] for r in got] == list(faults.values())


def test_whole_chain_and_config(spark):
    r = normalize(rows(spark, ["perchè  no ,[ 2 ]"])).first()
    assert r.text == "perché no, [due]" and r.w_ACCENTS == 1 and r.w_NUMBERS == 1 and r.w_UNEVEN_SPACES >= 2
    r = normalize(rows(spark, ["perchè 2 (a"]), config={"NUMBERS": False, "UNBALANCED_GUESS": False}).first()
    assert r.text == "perché 2 (a" and r.w_NUMBERS == 0 and not r.e_UNBALANCED_GUESS


def test_spans_and_mapping(spark):
    df = rows(spark, ["[a] b [cd]", "none", "[x]", ""])
    got = df.orderBy("n").select(spans(F.col("text"), r"\[[^\]]+\]").alias("x")).collect()
    assert [[(s.s, s.e) for s in r.x] for r in got] == [[(0, 3), (6, 10)], [], [(0, 3)], []]
    assert df.orderBy("n").select(map_matches(F.col("text"), "[a-d]", F.upper)).collect()[0][0] == "[A] B [CD]"


def test_numbers_of_any_length(spark):
    want = {
        "007": "sette", "000": "zero", "1000000": "un milione", "1001003": "un milione e milletré", "1000000000000": "un bilione", "2000000000000000003": "due trilioni e tré",
        "4994226020900891": "quattro biliardi, novecentonovantaquattro bilioni, duecentoventisei miliardi, venti milioni e novecentomilaottocentonovantuno",
        "1" + "0" * 64: "dieci deciliardi", "1" + "0" * 65: "1" + "0" * 65,
    }
    got = spark.createDataFrame([(k,) for k in want], "digits string").select("digits", cardinal(F.col("digits")).alias("words")).collect()
    assert {r.digits: r.words for r in got} == want


def test_matches_are_rewritten_in_linear_time(spark):
    """A text of 40,000 matches; with work for every pair of them this would take hours."""
    text = "x perchè " * 20_000
    got = apply_rules(spark.createDataFrame([(text,)], "text string"), WARNINGS).first()
    assert got.text.strip() == ("x perché " * 20_000).strip() and got.w_ACCENTS == 20_000

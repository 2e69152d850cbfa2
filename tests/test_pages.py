"""Texts for readers: markup, recaps, patches, issue tables, registry drafts."""

from pyspark.sql import functions as F

from parlance.functions import fields as X
from parlance.operators import pages, patches, reports


def marked(spark, *texts):
    df = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "i int, text string")
    return [r.x for r in df.select("i", pages.markup(F.col("text")).alias("x")).orderBy("i").collect()]


def test_markup(spark):
    got = marked(spark, "a [b° c] ((ride & x)) (.)", "°pia [no] °", "cia~ be:::ne <x>", "°a [b° c]", None)
    assert got[0] == 'a <span class="overlap">[b° c]</span> <span class="para">((ride &amp; x))</span> <span class="pause">(.)</span>'
    assert got[1] == '<span class="quiet">°pia <span class="overlap">[no]</span> °</span>'
    assert got[2] == '<span class="trunc">cia~</span> be<span class="length">:::</span>ne &lt;x&gt;'
    assert got[3] == '°a <span class="overlap">[b° c]</span>' and got[4] is None


def test_html_page(spark):
    df = spark.createDataFrame([("t", 0, "A", 0.0, 1.0, "ciao"), ("t", 1, "A", 61.0, 62.0, "sì")], "transcript_id string, tu_id int, speaker string, start double, end double, text string")
    text = pages.html_pages(df).first().text
    assert text.index('id="tu-0"') < text.index('id="tu-1"') and text.count('<span class="who">A</span>') == 1 and '<span class="time">1:01</span>' in text


SCHEMA = "file string, line int, tu_id int, token_id string, change string, old_span string, new_span string, old_form string, new_form string, old_jefferson_feats string, new_jefferson_feats string, old_align string, new_align string, notes array<string>"


def test_recap(spark):
    rows = [
        ("f", 0, 0, "0-0", "changed", "a|b", "c", "a", "a", "_", "_", "_", "_", []), ("f", 1, 0, "0-1", "dropped", "x", None, "x", None, "K=v", None, "_", None, ["⚠️ look"]),
        ("f", 2, 0, "0-2", "kept", "x", "x", "x", "x", "_", "_", "_", "_", []), ("f", 3, 1, "1-0", "added", None, "y", None, "y", None, "_", None, "_", None),
    ]
    text = pages.recap_markdown(spark.createDataFrame(rows, SCHEMA)).first().text
    assert "| modifiche | 1 |" in text and "| eliminazioni | 1 |" in text and "| aggiunte | 1 |" in text
    assert "## ⚠️ TU 0 · `0-0` → `0-1` · 1 modif., 1 elim." in text and "| token_id | tipo | span | form | jefferson_feats |\n|---|---|---|---|---|\n" in text
    assert "| `0-0` | ✏️ | `a\\|b` → `c` | `a` |  |" in text and "| `0-1` | 🗑️ | `x` | `x` | `K=v` |" in text and "> ⚠️ look" in text
    assert "## ✅ TU 1 · `1-0` · 1 agg." in text and "| `1-0` | ➕ | `y` | `y` |" in text and "0-2" not in text
    assert pages.recap_markdown(spark.createDataFrame(rows[2:3], SCHEMA)).count() == 0
    text = pages.recap_markdown(spark.createDataFrame(rows, SCHEMA), fields=True).first().text
    assert "## ➕ ✅ · TU 1 · `1-0`\n\n| campo | valore aggiunto |\n|-------|----------------|\n| span | `y` |\n| form | `y` |" in text and "| `0-0` | ✏️ | `a\\|b` → `c` | `a` |  |" in text
    rows = [("f", 0, 0, "0-0", "changed", "a|b", "c", "a", "a", "_", "_", "Begin=1", "_", ["⚠️ look"]), ("f", 1, 1, "1-0", "dropped", "x", None, "x", None, "_", None, "End=1", None, [])]
    text = pages.recap_markdown(spark.createDataFrame(rows, SCHEMA), fields=True).first().text
    assert "## ✏️ ⚠️ · TU 0 · `0-0`\n\n| campo | prima | dopo |\n|-------|-------|------|\n| span | `a\\|b` | `c` |\n| align | `Begin=1` | `_` |\n> ⚠️ look" in text
    assert text.endswith("## 🗑️ ✅ · TU 1 · `1-0`\n\n| campo | valore eliminato |\n|-------|-----------------|\n| span | `x` |\n| form | `x` |")


def test_patches(spark):
    old = spark.createDataFrame([("f", 0, "a"), ("f", 1, "b"), ("g", 0, "same")], "file string, line int, text string")
    new = spark.createDataFrame([("f", 0, "a"), ("f", 1, "c"), ("g", 0, "same")], "file string, line int, text string")
    got = pages.patches_of(old, new).collect()
    assert [r.file for r in got] == ["f"] and got[0].patch == "--- a/f\n+++ b/f\n@@ -1,2 +1,2 @@\n a\n-b\n+c\n"


def test_added_rows(spark):
    tokens = spark.createDataFrame([("t", "0-0", "A", "0", "ciao", "ciao", "_", "linguistic", "_")], "transcript_id string, token_id string, speaker string, tu_id string, span string, form string, jefferson_feats string, type string, upos string")
    edited = spark.createDataFrame([("t", 0, "0-0", "A", "0", "ciao", "ciao", "_"), ("t", 1, "0-1", None, None, "Bene?", "bene", "Lang=eng|Volume=Low")], "transcript_id string, line int, token_id string, speaker string, tu_id string, span string, form string, jefferson_feats string")
    r = patches.added_rows(edited, tokens).collect()
    assert len(r) == 1 and (r[0].token_id, r[0].speaker, r[0].tu_id, r[0].jefferson_feats, r[0].type, r[0].upos) == ("0-1", "A", "0", "Volume=High|Intonation=Rising|Lang=eng", "linguistic", "_")


def test_issue_tables_and_stats(spark):
    rows = spark.createDataFrame([("m", "b", "unit", "x|y"), ("m", "a", "unit", None)], "module string, code string, kind string, detail string")
    text = pages.issue_tables(rows, limit=1).first().text
    assert text.startswith("== m (2)\n") and "| a\n| unit\n| " in text and "| b" not in text
    df = reports.widened(spark.createDataFrame([(1, [5]), (2, None)], "k int, n array<int>"), "n", 2)
    assert df.columns == ["k", "n::0", "n::1"] and sorted(map(tuple, df.collect())) == [(1, 5, 0), (2, 0, 0)]


def test_registry_and_words(spark):
    text = pages.registry("C", ["code", "type", "participants"], ["code", "age-range", "conversations"], "m")
    assert 'ATTRIBUTE participant_age_range {\n        LABEL "Participant Age Range"' in text and 'SUBCORPATTRS "conversation.type|transcription_unit.participant_code|transcription_unit.participant_age_range"' in text
    df = spark.createDataFrame([("c'era po' 'sti =ehi seduta=sul=eh",)], "t string").select(X.split_words(F.col("t")).alias("w"), X.module_of(F.lit("PTB001"), "x").alias("m"))
    assert tuple(df.first()) == (["c'", "era", "po'", "'sti", "=ehi", "seduta=", "sul=", "eh"], "ParlaTO")

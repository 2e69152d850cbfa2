"""Texts for readers: marked-up transcripts, recaps of edits, patches, tables of issues, registry drafts."""

from __future__ import annotations

import difflib

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from parlance.functions import fields as X
from parlance.operators.formats import ordered, turns_timeline

#: Classes of marked-up notation, in the order in which they are looked for.
CLASSES = ["para", "overlap", "quiet", "pause", "trunc", "length"]
#: Icons and Italian words of a recap.
ICONS = {"changed": "✏️", "dropped": "🗑️", "added": "➕"}
SHORT = {"changed": "modif.", "dropped": "elim.", "added": "agg."}
SHOWN = ["span", "form", "jefferson_feats", "align"]
#: Attributes of a registry that have a label of their own, and those that no subcorpus is made by.
LABELS = {"code": "Codice conversazione", "full_conversation": "Trascrizione completa", "duration": "Durata", "topic": "Argomento", "participant_code": "Codice partecipante", "begin": "Inizio", "end": "Fine", "audio_file": "Audio"}
NO_SUBCORPUS = ["code", "full_conversation", "duration", "begin", "end", "audio_file"]


def markup(text: Column) -> Column:
    """Notation as HTML spans; everything else is escaped.

    Spans are held as private characters until the end, one that opens for each class and one that
    closes, so that no later pattern reaches across the border of an earlier one.
    """
    close, opens = chr(0xE000), {c: chr(0xE001 + k) for k, c in enumerate(CLASSES)}
    mark = r"\x{E000}-\x{E00F}"
    inner = rf"(?:[^°{mark}]|[\x{{E001}}-\x{{E00F}}][^°{mark}]*\x{{E000}})"
    patterns = {
        "para": r"(\(\(.+?\)\))", "overlap": r"(\[[^\[\]]+\])", "quiet": rf"(°{inner}+°)",
        "pause": r"(\(\.{1,3}\))", "trunc": rf"([^\s{mark}]+~)", "length": r"(?<=\w)(:{2,})",
    }
    out = F.replace(X.xml(F.regexp_replace(text, rf"[{mark}]", "")), F.lit("'"), F.lit("&#x27;"))
    for name in CLASSES:
        out = F.regexp_replace(out, patterns[name], f"{opens[name]}$1{close}")
    for name in CLASSES:
        out = F.replace(out, F.lit(opens[name]), F.lit(f'<span class="{name}">'))
    return F.replace(out, F.lit(close), F.lit("</span>"))


def html_pages(units: DataFrame) -> DataFrame:
    """Rows (transcript_id, text): a page of turns with clock, place on the timeline and marked-up text. Styles and scripts are a site's own."""
    places = turns_timeline(units).select("transcript_id", "tu_id", "colour", "shown", "left", "width")
    df = units.select("transcript_id", "tu_id", "speaker", "start", "text").join(places, ["transcript_id", "tu_id"])
    who = F.when(F.col("shown"), X.xml(F.col("speaker"))).otherwise("")
    line = F.concat(
        F.lit('<div class="turn speaker-'), F.col("colour").cast("string"), F.lit('" id="tu-'), F.col("tu_id").cast("string"), F.lit('">\n<span class="time">'), X.clock(F.col("start") * 1000), F.lit('</span> <span class="who">'), who,
        F.lit('</span> <span class="bar" style="left:calc(100% * '), F.col("left"), F.lit(");width:calc(100% * "), F.col("width"), F.lit(')"></span>\n<p>'), markup(F.col("text")), F.lit("</p>\n</div>"),
    )
    bodies = df.withColumn("line", line).groupBy("transcript_id").agg(ordered(["tu_id"], F.col("line"), "\n").alias("body"))
    name = X.xml(F.col("transcript_id").cast("string"))
    return bodies.select("transcript_id", F.concat(F.lit('<!DOCTYPE html>\n<html lang="it">\n<head><meta charset="utf-8"><title>'), name, F.lit("</title></head>\n<body>\n<h1>"), name, F.lit("</h1>\n"), "body", F.lit("\n</body>\n</html>")).alias("text"))


def cell(value: Column) -> Column:
    """A value in a Markdown table; missing values leave it empty."""
    return F.when(X.missing(value), F.lit("")).otherwise(F.concat(F.lit("`"), F.replace(value, F.lit("|"), F.lit("\\|")), F.lit("`")))


def recap_markdown(items: DataFrame, file: str = "file", order: str = "line", stamp: str = "", fields: bool = False) -> DataFrame:
    """Rows (file, text): what an edit changed, dropped and added, consecutive rows of a unit in one table; with `fields`, a row alone has a table of its fields.

    Items have tu_id, token_id, change, notes (an array) and old_ and new_ values of SHOWN. Features
    and times are shown where a row of the group changes them; the worst note makes the group's icon.
    """
    by = Window.partitionBy(file).orderBy(order)
    df = items.where(F.col("change") != "kept").withColumn("__new", (~F.lag("tu_id").over(by).eqNullSafe(F.col("tu_id"))).cast("int"))
    df = df.withColumn("__group", F.sum("__new").over(by))
    old, new = (lambda c: F.coalesce(f"old_{c}", F.lit("_"))), (lambda c: F.coalesce(f"new_{c}", F.lit("_")))
    changed = F.col("change") == "changed"
    only = lambda c: F.when(F.col("change") == "dropped", old(c)).otherwise(new(c))
    cells = F.array(*[F.when(changed & (old(c) != new(c)), F.concat(F.lit("`"), F.replace(old(c), F.lit("|"), F.lit("\\|")), F.lit("` → `"), F.replace(new(c), F.lit("|"), F.lit("\\|")), F.lit("`"))).otherwise(cell(only(c))) for c in SHOWN])
    shows = lambda c: F.bool_or(F.when(changed, old(c) != new(c)).otherwise(F.lit(c != "align") & ~X.missing(only(c))))
    notes = F.flatten(F.transform(F.sort_array(F.collect_list(F.struct(order, F.coalesce("notes", F.array().cast("array<string>")).alias("n")))), lambda x: x["n"]))
    quoted = lambda x: F.concat(F.lit("`"), F.replace(x, F.lit("|"), F.lit("\\|")), F.lit("`"))
    field = lambda c: F.when(changed, F.when(old(c) != new(c), F.concat(F.lit(f"| {c} | "), quoted(old(c)), F.lit(" | "), quoted(new(c)), F.lit(" |")))).otherwise(F.when(F.lit(c != "align") & ~X.missing(only(c)), F.concat(F.lit(f"| {c} | "), quoted(only(c)), F.lit(" |"))))
    # The heads of these tables.
    head_of = F.when(changed, "| campo | prima | dopo |\n|-------|-------|------|").when(F.col("change") == "dropped", "| campo | valore eliminato |\n|-------|-----------------|").otherwise("| campo | valore aggiunto |\n|-------|----------------|")
    alone = F.concat_ws("\n", head_of, F.filter(F.array(*map(field, SHOWN)), lambda x: x.isNotNull()))
    groups = df.withColumns({"__cells": cells, "__alone": alone, "__icon": X.mapped(F.col("change"), ICONS)}).groupBy(file, "__group").agg(
        F.count("*").alias("size"), F.min_by("__alone", order).alias("alone"), F.min(order).alias("first"), F.first("tu_id").alias("tu_id"), F.min_by("token_id", order).alias("a"), F.max_by("token_id", order).alias("b"), shows("jefferson_feats").alias("feats"), shows("align").alias("times"), notes.alias("notes"),
        *[F.count_if(F.col("change") == c).alias(c) for c in ICONS], F.sort_array(F.collect_list(F.struct(order, "token_id", F.col("__icon").alias("icon"), F.col("__cells").alias("cells")))).alias("rows"),
    )
    said = lambda sign: F.exists("notes", lambda n: n.startswith(sign))
    icon = F.when(said("❌"), "❌").when(said("⚠️"), "⚠️").otherwise("✅")
    pick = lambda x: F.concat(F.slice(x, 1, 2), F.when(F.col("feats"), F.slice(x, 3, 1)).otherwise(F.array().cast("array<string>")), F.when(F.col("times"), F.slice(x, 4, 1)).otherwise(F.array().cast("array<string>")))
    bar = lambda x: F.concat(F.lit("| "), F.array_join(x, " | "), F.lit(" |"))
    head = pick(F.array(*map(F.lit, SHOWN)))
    ids = F.when(F.col("a") == F.col("b"), F.concat(F.lit("`"), "a", F.lit("`"))).otherwise(F.concat(F.lit("`"), "a", F.lit("` → `"), "b", F.lit("`")))
    counts = F.array_join(F.filter(F.array(*[F.when(F.col(c) > 0, F.concat(F.col(c).cast("string"), F.lit(f" {w}"))) for c, w in SHORT.items()]), lambda x: x.isNotNull()), ", ")
    text = F.concat_ws(
        "\n", F.concat(F.lit("## "), icon, F.lit(" TU "), F.coalesce(F.col("tu_id").cast("string"), F.lit("?")), F.lit(" · "), ids, F.lit(" · "), counts), F.lit(""),
        bar(F.concat(F.array(F.lit("token_id"), F.lit("tipo")), head)), F.concat(F.lit("|"), F.repeat(F.lit("---|"), F.size(head) + 2)),
        F.transform("rows", lambda r: bar(F.concat(F.array(F.concat(F.lit("`"), r["token_id"], F.lit("`")), r["icon"]), pick(r["cells"])))), F.lit(""), F.transform("notes", lambda n: F.concat(F.lit("> "), n)),
    )
    doubt = F.when(said("❌") | said("⚠️"), "⚠️").otherwise("✅")
    single = F.concat_ws("\n", F.concat(F.lit("## "), F.get("rows", F.lit(0))["icon"], F.lit(" "), doubt, F.lit(" · TU "), F.coalesce(F.col("tu_id").cast("string"), F.lit("?")), F.lit(" · `"), "a", F.lit("`")), F.lit(""), "alone", F.transform("notes", lambda n: F.concat(F.lit("> "), n)))
    pages = groups.withColumn("text", F.when(F.lit(fields) & (F.col("size") == 1), single).otherwise(text)).groupBy(file).agg(ordered(["first"], F.col("text"), "\n\n").alias("body"), *[F.sum(c).alias(c) for c in ICONS])
    top = F.concat(F.lit("# Patch recap — "), F.col(file).cast("string"), F.lit(f"\n{stamp}\n\n| tipo | conteggio |\n|------|----------|\n| modifiche | "), F.col("changed").cast("string"), F.lit(" |\n| eliminazioni | "), F.col("dropped").cast("string"), F.lit(" |\n| aggiunte | "), F.col("added").cast("string"), F.lit(" |\n\n---\n\n"))
    return pages.select(file, F.concat(top, "body").alias("text"))


def patches_of(old: DataFrame, new: DataFrame, file: str = "file", order: str = "line", text: str = "text") -> DataFrame:
    """Rows (file, patch): unified differences of the lines of two versions of a file; files without any are left out. A group is one file."""
    kind = dict(old.dtypes)[file]

    def work(a: pa.Table, b: pa.Table) -> pa.Table:
        name = (a if len(a) else b)[file][0]
        sides = [[f"{x}\n" for x in side.sort_by(order)[text].to_pylist()] for side in (a, b)]
        lines = "".join(difflib.unified_diff(*sides, fromfile=f"a/{name}", tofile=f"b/{name}"))
        return pa.table({file: pa.array([name.as_py()] if lines else [], name.type), "patch": pa.array([lines] if lines else [], pa.string())})

    return old.select(file, order, text).groupBy(file).cogroup(new.select(file, order, text).groupBy(file)).applyInArrow(work, f"{file} {kind}, patch string")


def issue_tables(rows: DataFrame, module: str = "module", limit: int = 500) -> DataFrame:
    """Rows (module, text): an AsciiDoc table of the first `limit` issues (code, kind, detail) of each module, which the page limits, and how many there are."""
    by = Window.partitionBy(module).orderBy("code", "kind", "detail")
    df = rows.withColumns({"__n": F.row_number().over(by), "__all": F.count("*").over(Window.partitionBy(module))}).where(F.col("__n") <= limit)
    bar = lambda c: F.concat(F.lit("| "), F.replace(F.coalesce(F.col(c).cast("string"), F.lit("")), F.lit("|"), F.lit("\\|")))
    pages = df.withColumn("line", F.concat_ws("\n", bar("code"), bar("kind"), bar("detail"))).groupBy(module).agg(F.first("__all").alias("n"), ordered(["__n"], F.col("line"), "\n\n").alias("body"))
    return pages.select(module, F.concat(F.lit("== "), F.col(module).cast("string"), F.lit(" ("), F.col("n").cast("string"), F.lit(')\n\n[cols="1,1,3",options="header"]\n|===\n| code | kind | detail\n\n'), "body", F.lit("\n|===\n")).alias("text"))


def attribute(name: str, indent: str = "    ", whole: frozenset[str] = frozenset(), many: frozenset[str] = frozenset({"languages"})) -> str:
    """One attribute of a registry: its label, and whether it lists all its values or holds several."""
    body = [f'LABEL "{LABELS.get(name, X.label_for(name))}"'] + ['MAXLISTSIZE "0"'] * (name in whole) + ['MULTIVALUE "1"', 'MULTISEP   ","'] * (name in many)
    return "\n".join([f"{indent}ATTRIBUTE {name} {{", *[f"{indent}    {b}" for b in body], f"{indent}}}"])


def registry(corpus: str, conversations: list[str], participants: list[str], maintainer: str = "", path: str = "/corpora", home: str = "") -> str:
    """The draft of a corpus registry from the column names of two metadata tables."""
    own = ["code", "full_conversation"] + [X.attribute_name(c) for c in conversations if c not in ("code", "participants")]
    turn = ["participant_code", "begin", "end", "audio_file"] + [f"participant_{X.attribute_name(c)}" for c in participants if c not in ("code", "conversations")]
    by = [f"{s}.{a}" for s, names in (("conversation", own), ("transcription_unit", turn)) for a in names if a not in NO_SUBCORPUS]
    top = {"MAINTAINER": maintainer, "INFO": corpus, "NAME": corpus, "PATH": f"{path}/{corpus}/indexed/", "ENCODING": "UTF-8", "LANGUAGE": "Italian", "VERTICAL": f"{path}/{corpus}/vertical/source", "INFOHREF": home}
    lower = {"LABEL": '"word (lowercase)"', "DYNAMIC": "utf8lowercase", "DYNLIB": "internal", "ARG1": '"C"', "FUNTYPE": "s", "FROMATTR": "word", "TYPE": "index", "TRANSQUERY": "yes"}
    shape = {"DISPLAYTAG": "0", "DISPLAYBEGIN": '"·[%(participant_code)]·"', "DISPLAYEND": '""', "NESTED": "1"}
    return "\n".join([
        *[f'{k} "{v}"' for k, v in top.items()], "DOCSTRUCTURE conversation", f'SUBCORPATTRS "{"|".join(by)}"', "", "ATTRIBUTE word", attribute("token_id", ""),
        "ATTRIBUTE lc {", *[f"    {k} {v}" for k, v in lower.items()], "}", "", "STRUCTURE conversation {", *map(attribute, own), "}", "",
        "STRUCTURE transcription_unit {", *map(attribute, turn), *[f"    {k} {v}" for k, v in shape.items()], "}", "", "STRUCTURE g {", "    DISPLAYTAG 0", '    DISPLAYBEGIN "_EMPTY_"', "}", "",
    ])

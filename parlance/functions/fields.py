"""The small text formats inside token tables, and other scalar functions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

MISSING = "_"
#: Labels of features in other vocabularies.
PITCH = {"WeaklyRising": "weakly_asc", "Rising": "asc", "Falling": "desc", "WeaklyFalling": "weakly_desc", "Level": "normal"}
LANGUAGES = {"italian": "ita", "dialect": "it-x-dialect", "english": "eng", "french": "fra", "german": "deu", "spanish": "spa"}
SEXES = {"M": "2", "F": "1"}
SPAN_DERIVED = ["Intonation", "Interrupted", "Truncated", "Volume"]
PAIRS = "array<struct<k:string,v:string>>"


def missing(x: Column) -> Column:
    """Null, blank or `_`."""
    return F.coalesce(F.trim(x), F.lit("")).isin("", MISSING)


def or_missing(x: Column) -> Column:
    return F.when(F.coalesce(x, F.lit("")) == "", MISSING).otherwise(x)


def feats(text: Column, bare: bool = True) -> Column:
    """`k=v|k=v` as an ordered array of struct(k, v). A key without = has the value '' (or is dropped); the last of equal keys counts."""
    parts = F.filter(F.split(F.when(missing(text), "").otherwise(text), r"\|"), lambda p: p.contains("=") if not bare else p != "")
    got = F.transform(parts, lambda p: F.struct(F.split(p, "=", 2)[0].alias("k"), F.coalesce(F.get(F.split(p, "=", 2), F.lit(1)), F.lit("")).alias("v")))
    last = lambda k: F.get(F.filter(F.reverse(got), lambda x: x["k"] == k), F.lit(0))
    keys = F.array_distinct(F.transform(got, lambda x: x["k"]))
    return F.when(F.size(keys) == F.size(got), got).otherwise(F.transform(keys, last))


def format_feats(pairs: Column) -> Column:
    text = F.array_join(F.transform(pairs, lambda x: F.when(x["v"] == "", x["k"]).otherwise(F.concat(x["k"], F.lit("="), x["v"]))), "|")
    return or_missing(text)


def feat(text: Column, key: str) -> Column:
    """The value of a key in `k=v|k=v`; null without it."""
    return F.get(F.filter(feats(text), lambda x: x["k"] == key), F.lit(0))["v"]


def jefferson_feats() -> Column:
    """The features of a token row, in their fixed order."""
    yes = lambda name, test: F.when(test, f"{name}=Yes")
    said = lambda name, c: F.when(c.isNotNull(), F.concat(F.lit(f"{name}="), c.cast("string")))
    return or_missing(F.concat_ws(
        "|", said("Intonation", F.col("intonation")), yes("Interrupted", F.col("interrupted")), yes("Truncated", F.col("truncated")), yes("Reduced", F.col("reduced")),
        yes("ProsodicLink", F.col("link")), F.when(~F.col("space_after"), "SpaceAfter=No"), yes("PauseAfter", F.col("pause_after")), said("Language", F.col("language")),
        yes("Orthography", F.col("token_variation") == "emerging"), said("Volume", F.col("volume")),
        F.when(F.col("token_variation") != "none", F.concat(F.lit("Variation="), F.initcap("token_variation"))), said("Syllables", F.col("syllables")),
    ))


def prolongation_text(pairs: Column) -> Column:
    return or_missing(F.array_join(F.transform(pairs, lambda x: F.concat(x["at"].cast("string"), F.lit("x"), x["n"].cast("string"))), ","))


def pace_text(slow: Column, fast: Column) -> Column:
    said = lambda name, c: F.when(c.isNotNull(), F.concat(F.lit(f"{name}="), c))
    return or_missing(F.concat_ws("|", said("Slow", slow), said("Fast", fast)))


def align_text(start: Column, end: Column) -> Column:
    said = lambda name, c: F.when(c.isNotNull(), F.concat(F.lit(f"{name}="), c.cast("string")))
    return or_missing(F.concat_ws("|", said("Begin", start), said("End", end)))


def seconds(align: Column, name: str) -> Column:
    return F.nullif(F.regexp_extract(align, rf"{name}=(-?[0-9.]+)", 1), F.lit("")).cast("double")


def milliseconds(align: Column, name: str) -> Column:
    """Rounded half to even."""
    return F.bround(seconds(align, name) * 1000).cast("long")


def clique_ids(overlaps: Column) -> Column:
    """The numbered events of an overlap field; unknown ones are left out."""
    return F.regexp_extract_all(overlaps, F.lit(r"\((\d+)\)"), F.lit(1))


def with_prolongations(form: Column, field: Column) -> Column:
    """The form with its colons back."""
    parts = F.split(F.when(missing(field), "").otherwise(field), ",")
    colons = lambda i: F.repeat(F.lit(":"), F.coalesce(F.get(F.filter(F.transform(parts, lambda p: F.split(p, "x")), lambda p: p[0] == i.cast("string")), F.lit(0))[1].cast("int"), F.lit(0)))
    return F.when(missing(field), form).otherwise(F.array_join(F.transform(F.split(form, ""), lambda c, i: F.concat(c, colons(i))), ""))


def feats_from_span(span: Column) -> Column:
    """What a token's text alone says, as ordered pairs."""
    core = F.regexp_replace(span, r"[°\[\]]", "")
    flat = F.regexp_replace(core, ":+", "")
    base = F.regexp_replace(flat, "[.,?]+$", "")
    pair = lambda k, test, v: F.when(test, F.struct(F.lit(k).alias("k"), F.lit(v).alias("v")))
    interrupted = base.rlike("[~-]$|^[~-]")
    every = F.array(
        F.coalesce(pair("Volume", core.rlike(r"\p{Lu}"), "High"), pair("Volume", span.contains("°"), "Low")),
        F.coalesce(pair("Intonation", flat.endswith("."), "Falling"), pair("Intonation", flat.endswith(","), "WeaklyRising"), pair("Intonation", flat.endswith("?"), "Rising")),
        F.coalesce(pair("Interrupted", interrupted, "Yes"), pair("Truncated", base.rlike("'$|^'") & (F.regexp_replace(base, r"[^\p{L}]", "") != "po"), "Yes")),
    )
    return F.when(missing(span), F.array().cast(PAIRS)).otherwise(F.filter(every, lambda x: x.isNotNull()))


def form_from_span(span: Column) -> Column:
    """The form that follows from a token's text; null where none does."""
    bare = F.regexp_replace(span, r"[\[\]()<>°]", "")
    bare = F.regexp_replace(F.regexp_replace(bare, "^[$#]", ""), "[.,?]$", "")
    form = F.lower(F.replace(bare, F.lit(":"), F.lit("")))
    special = missing(span) | (span == "(.)") | span.rlike(r"^\(\(.*\)\)$") | span.rlike(r"^\{.*\}$") | F.regexp_replace(span, r"[\[\]()<>°]", "").rlike("^x+$")
    return F.when(special | (form == ""), None).otherwise(form)


def infer_type(span: Column) -> Column:
    return F.when(span.isin("(.)", "{P}"), "shortpause").when(span.rlike(r"^\(\(.*\)\)$|^\{.*\}$"), "nonverbalbehavior").when(span.rlike("^x+$"), "unknown").otherwise("linguistic")


def codes(text: Column) -> Column:
    """`a; b ;c` as an array without blanks."""
    return F.filter(F.transform(F.split(F.coalesce(text, F.lit("")), ";"), lambda x: F.trim(x)), lambda x: x != "")


def multivalue(text: Column) -> Column:
    return F.when(F.coalesce(text, F.lit("")).contains(";"), F.array_join(F.array_distinct(codes(text)), ",")).otherwise(F.coalesce(text, F.lit("")))


def files_field(text: Column) -> Column:
    return F.array_join(F.array_sort(F.array_distinct(codes(text))), ", ")


def attribute_name(name: str) -> str:
    return name.strip().replace("-", "_")


def label_for(name: str) -> str:
    return name.replace("-", " ").replace("_", " ").title()


def joined_url(base: Column, path: Column) -> Column:
    return F.concat(F.rtrim(base, F.lit("/")), F.lit("/"), F.ltrim(path, F.lit("/")))


def clock(ms: Column) -> Column:
    """M:SS, or H:MM:SS from an hour on."""
    s = F.floor(ms / 1000)
    h, m, r = F.floor(s / 3600), F.floor(s / 60) % 60, s % 60
    return F.when(h > 0, F.format_string("%d:%02d:%02d", h, m, r)).otherwise(F.format_string("%d:%02d", m, r))


def fixed(x: Column, digits: int) -> Column:
    """A number with so many decimals, rounded by its exact binary value, ties to even, as C's printf does; format_string rounds the shortest decimal and ties up."""
    return F.call_function("format_number", x, F.lit("0." + "0" * digits))


def iso_duration(hms: Column) -> Column:
    """HH:MM:SS as an ISO 8601 duration; anything else stays."""
    p = F.split(F.trim(hms), ":")
    n = lambda k: F.get(p, F.lit(k)).try_cast("int")
    whole = F.when(n(0) > 0, F.concat(F.lit("PT"), n(0), F.lit("H"), n(1), F.lit("M"), n(2), F.lit("S"))).otherwise(F.concat(F.lit("PT"), n(1), F.lit("M"), n(2), F.lit("S")))
    return F.when((F.size(p) == 3) & n(0).isNotNull() & n(1).isNotNull() & n(2).isNotNull(), whole).otherwise(hms)


def marked_variation(text: Column, variation: Column) -> Column:
    return F.when(variation == "unspecified", F.concat(F.lit("# "), text)).when(variation == "all", F.concat(F.lit("#_ "), text)).otherwise(text)


def xml(text: Column) -> Column:
    for a, b in (("&", "&amp;"), ("<", "&lt;"), (">", "&gt;"), ('"', "&quot;")):
        text = F.replace(text, F.lit(a), F.lit(b))
    return text


def mapped(value: Column, words: dict[str, str]) -> Column:
    """A label from a fixed dictionary; other values stay."""
    return F.coalesce(F.element_at(F.create_map(*[F.lit(x) for p in words.items() for x in p]), value), value)


def latex(text: Column) -> Column:
    """Characters that mean something to LaTeX, escaped one by one."""
    special = {"\\": r"\textbackslash{}", "~": r"\textasciitilde{}", "^": r"\textasciicircum{}"} | {c: f"\\{c}" for c in "&%$#_{}"}
    return F.array_join(F.transform(F.split(text, ""), lambda c: mapped(c, special)), "")


#: Modules of a collection by the first letters of a code.
MODULES = {"KIP": ["BOA", "BOC", "BOD", "TOA", "TOC", "TOD"], "KIPasti": ["KPC", "KPN", "KPS"], "ParlaBO": ["PBA", "PBB", "PBC"], "ParlaTO": ["PTA", "PTB", "PTD"]}


def module_of(code: Column, otherwise: str) -> Column:
    """The module that a code's first letters name."""
    words = {start: module for module, starts in MODULES.items() for start in starts}
    return F.coalesce(F.element_at(F.create_map(*[F.lit(x) for p in words.items() for x in p]), F.substring(code, 1, 3)), F.lit(otherwise))


def split_words(text: Column) -> Column:
    """The words of a line, each cut after an apostrophe or `=` in its middle."""
    return F.filter(F.split(F.trim(text), r"\s+|(?<=[^\s'=]['=])(?=[^\s'=])"), lambda w: w != "")

"""A patch from an edited table: what the source token table becomes, line by line, and what was done to it.

Source rows are (file, line, cols, cells): the header's columns and a map of their values. Rows of
the edited table are (file, line, token_id, span, form, and any of tu_id, speaker, jefferson_feats).
Tokens in both stay, with the span, form and language of the edited table; tokens of the source
alone are dropped and their times go to the neighbours that stay; tokens of the edited table alone
are added and take times from the neighbours in their unit. The result is in the edited table's
order. What stays is decided by windows over a file; a run of added rows is one fold, as each row
looks at the one before it. Of repeated ids in an edited table the first has the place and the last
the values; a source's ids are unique. Files are matched by name; one without a counterpart is left out.
"""

from __future__ import annotations

import difflib

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from parlance.functions import fields as X
from parlance.operators.patches import lemma_rows

#: Columns whose values a person has to move when a token goes.
MANUAL = ["prolongations", "pace", "guesses", "overlaps"]
OPTIONAL = ["tu_id", "speaker", "jefferson_feats"]
NO_NOTES = "array<string>"


def source_rows(lines: DataFrame) -> tuple[DataFrame, DataFrame]:
    """From raw lines (transcript_id, line, raw, eol): the rows of files (file, line, cols, cells), and their headers (file, cols, eol, head)."""
    parts = F.split(F.regexp_replace("raw", "[\r\n]+$", ""), "\t", -1)
    rows = lines.select(F.col("transcript_id").alias("file"), "line", "raw", "eol", parts.alias("parts"))
    heads = rows.where("line = 0").select("file", F.col("parts").alias("cols"), "eol", F.col("raw").alias("head"))
    cells = F.map_from_arrays("cols", F.transform("cols", lambda c, i: F.coalesce(F.get("parts", i), F.lit(X.MISSING))))
    return rows.where("line > 0").drop("eol").join(heads, "file").select("file", "line", "cols", cells.alias("cells")), heads


def edited_rows(edited: DataFrame) -> DataFrame:
    """Rows (file, e_at, token_id, e): one for each token of an edited table, e its values."""
    values = [F.col(c) if c in edited.columns else F.lit(X.MISSING).alias(c) for c in ("span", "form", *OPTIONAL)]
    rows = lemma_rows(edited.select(F.col("file"), F.col("line").cast("string").alias("__line"), "token_id", *values)).withColumn("line", F.col("__line").cast("long"))
    return rows.groupBy("file", "token_id").agg(F.min("line").alias("e_at"), F.max_by(F.struct("span", "form", *OPTIONAL), "line").alias("e"))


def pairs(align: Column) -> Column:
    return X.feats(align, bare=False)


def value(align: Column, key: str) -> Column:
    return F.get(F.filter(pairs(align), lambda x: x["k"] == key), F.lit(0))["v"]


def timed(align: Column, begin: Column, end: Column) -> Column:
    """The field with these times: Begin, End, and then what else it has. As it is where they are its own."""
    said = lambda k, v: F.when(v.isNotNull(), F.array(F.struct(F.lit(k).alias("k"), v.alias("v")))).otherwise(F.array().cast(X.PAIRS))
    others = F.filter(pairs(align), lambda x: ~x["k"].isin("Begin", "End"))
    text = X.or_missing(F.array_join(F.transform(F.concat(said("Begin", begin), said("End", end), others), lambda x: F.concat_ws("=", x["k"], x["v"])), "|"))
    return F.when(begin.eqNullSafe(value(align, "Begin")) & end.eqNullSafe(value(align, "End")), align).otherwise(text)


def features(old: Column, edited: Column, changed: Column, span: Column) -> Column:
    """Features after an edit: those that a changed span says are made again, after the others; the language is the edited table's, where the old one stood."""
    lang = X.feat(edited, "Lang")
    kept = F.filter(X.feats(old), lambda x: ~(changed & x["k"].isin(X.SPAN_DERIVED)))
    every = F.concat(kept, F.when(changed, X.feats_from_span(span)).otherwise(F.array().cast(X.PAIRS)))
    own = F.transform(every, lambda x: F.when((x["k"] == "Lang") & lang.isNotNull(), F.struct(x["k"].alias("k"), lang.alias("v"))).otherwise(x))
    added = F.when(lang.isNotNull() & ~F.exists(every, lambda x: x["k"] == "Lang"), F.array(F.struct(F.lit("Lang").alias("k"), lang.alias("v")))).otherwise(F.array().cast(X.PAIRS))
    return X.format_feats(F.concat(own, added))


def kind_of(span: Column, form: Column) -> Column:
    """The type of an added token."""
    event = span.rlike(r"^\(\(.*\)\)$|^\{.*\}$")
    return F.when(span.isin("(.)", "{P}") | form.isin("(.)", "{P}", "[PAUSE]"), "shortpause").when(event | (form == "[NVB]"), "nonverbalbehavior").when(form == "x", "unknown").otherwise("linguistic")


def inferred(before: Column, after: Column) -> Column:
    """A missing value from the values of both neighbours (null where missing): theirs if they agree or only one has any."""
    return F.when(after.isNull() | (before == after), before).when(before.isNull(), after)


def said(*parts: Column | str) -> Column:
    return F.concat(*[F.lit(p) if isinstance(p, str) else p for p in parts])


def noted(*notes: tuple[Column, Column]) -> Column:
    return F.filter(F.array(*[F.when(test, text) for test, text in notes]), lambda x: x.isNotNull())


def by_file(rows: DataFrame, tasks: int | None) -> DataFrame:
    """Rows dealt by file to so many tasks, if a number is given: left to the planner, they are put together by compressed bytes, which are few beside what windows hold."""
    return rows.repartition(tasks, "file") if tasks else rows


def compared(source: DataFrame, edited: DataFrame, tasks: int | None = None) -> DataFrame:
    """Source rows with what was edited (null where dropped), times moved from dropped rows to those that stay, and notes on how."""
    cell = lambda c: F.col("cells")[c]
    rows = source.withColumn("token_id", cell("token_id")).join(edited, ["file", "token_id"], "left")
    rows = by_file(rows, tasks)
    blank = (F.trim(F.coalesce(cell("span"), F.lit(""))) == "") | (F.trim(F.coalesce(cell("form"), F.lit(""))) == "")
    rows = rows.withColumn("cells", F.when(blank, F.raise_error(F.lit("a row needs span and form"))).otherwise(F.col("cells")))
    stays = F.col("e").isNotNull()
    align = F.coalesce(cell("align"), F.lit(X.MISSING))
    by = Window.partitionBy("file").orderBy("line")
    rows = rows.withColumns({"stays": stays, "begin": value(align, "Begin"), "end": value(align, "End"), "k": F.sum(stays.cast("int")).over(by.rowsBetween(Window.unboundedPreceding, 0))})
    rows = rows.withColumn("h", F.col("k") - stays.cast("int"))
    whole = (Window.unboundedPreceding, Window.unboundedFollowing)
    after, before = Window.partitionBy("file", "k").orderBy("line"), Window.partitionBy("file", "h").orderBy("line")
    lost = lambda c: F.when(~F.col("stays"), F.col(c))
    own = lambda *c: F.when(F.col("stays"), F.struct(*c))
    rows = rows.withColumns({
        "prev": F.first(own("token_id", "begin", "end"), ignorenulls=True).over(after.rowsBetween(*whole)), "next": F.last(own("token_id", "begin", "end"), ignorenulls=True).over(before.rowsBetween(*whole)),
        "ended": F.first(lost("end"), ignorenulls=True).over(after.rowsBetween(*whole)), "ends": F.sum(lost("end").isNotNull().cast("int")).over(after.rowsBetween(Window.unboundedPreceding, -1)),
        "pending": F.last(lost("begin"), ignorenulls=True).over(before.rowsBetween(Window.unboundedPreceding, -1)), "begins": F.sum(lost("begin").isNotNull().cast("int")).over(before.rowsBetween(1, Window.unboundedFollowing)),
    })
    # The notes of a recap.
    b, e = F.col("begin"), F.col("end")
    taken = F.coalesce(F.col("prev.end"), F.when(F.col("ends") > 0, F.col("ended")))
    lasts = b.isNotNull() & (F.coalesce("begins", F.lit(0)) == 0) & F.col("next").isNotNull()
    notes = noted(
        (e.isNotNull() & F.col("prev").isNull(), said("❌ End=", e, " — no previous token")),
        (e.isNotNull() & F.col("prev").isNotNull() & taken.isNotNull(), said("❌ End conflict: End=", e, " but `", F.col("prev.token_id"), "` already has End=", taken)),
        (e.isNotNull() & F.col("prev").isNotNull() & taken.isNull(), said("✅ End=", e, " → `", F.col("prev.token_id"), "`")),
        (b.isNotNull() & F.col("pending").isNotNull(), said("❌ Begin conflict: pending Begin=", F.col("pending"), " overwritten by Begin=", b)),
        *[(~X.missing(cell(c)), said(f"⚠️ {c}=`", cell(c), "`")) for c in MANUAL],
        (lasts & F.col("next.begin").isNull(), said("✅ Begin=", b, " → `", F.col("next.token_id"), "`")),
        (lasts & F.col("next.begin").isNotNull(), said("❌ Begin=", b, " conflict: `", F.col("next.token_id"), "` already has Begin=", F.col("next.begin"))),
    )
    moved = {"new_begin": F.coalesce("begin", "pending"), "new_end": F.coalesce("end", "ended"), "notes": F.when(~F.col("stays"), notes).otherwise(F.array().cast(NO_NOTES))}
    return rows.withColumns(moved).drop("prev", "next", "ended", "ends", "pending", "begins", "h")


def kept_rows(rows: DataFrame) -> DataFrame:
    """The rows that stay, with new values: span, form, features, unit and speaker."""
    cell = lambda c: F.col("cells")[c]
    known = lambda x: F.when(~X.missing(x), x)
    df = rows.where("stays")
    by = Window.partitionBy("file").orderBy("line")
    past = by.rowsBetween(Window.unboundedPreceding, -1)
    for c in ("tu_id", "speaker"):
        df = df.withColumns({f"raw_{c}": known(cell(c)), f"own_{c}": F.coalesce(known(cell(c)), known(F.col(f"e.{c}")))})
    # A row whose next row misses the value too takes the one before, so what the row before has is what is known last.
    before = lambda c: F.last(f"own_{c}", ignorenulls=True).over(past)
    after = lambda c: F.lead(f"raw_{c}").over(by)
    df = df.withColumn("tu_id", F.coalesce("own_tu_id", inferred(before("tu_id"), after("tu_id"))))
    unit = F.coalesce(F.when(F.lag("tu_id").over(by) == F.col("tu_id"), before("speaker")), F.when(F.lead("raw_tu_id").over(by) == F.col("tu_id"), after("speaker")))
    df = df.withColumn("speaker", F.coalesce("own_speaker", unit, inferred(before("speaker"), after("speaker"))))
    new = lambda c: F.when(F.col("cells").getItem(c).isNotNull() & (F.col(f"e.{c}") != ""), F.col(f"e.{c}")).otherwise(cell(c))
    df = df.withColumns({"span": new("span"), "form": new("form")})
    df = df.withColumn("feats", features(cell("jefferson_feats"), F.col("e.jefferson_feats"), F.col("span") != cell("span"), F.col("span")))
    differs = F.lit(False)
    for c, n in (("span", "span"), ("form", "form"), ("jefferson_feats", "feats"), ("tu_id", "tu_id"), ("speaker", "speaker")):
        differs = differs | F.coalesce(F.col(n) != cell(c), F.lit(False))
    derived = X.form_from_span(F.col("span"))
    doubtful = (F.col("form") != cell("form")) & (F.col("span") == cell("span")) & derived.isNotNull() & (F.col("form") != derived)
    place = F.row_number().over(Window.partitionBy("file").orderBy("e_at"))
    return df.withColumns({"change": F.when(differs, "changed").otherwise("kept"), "notes": noted((doubtful, F.lit("⚠️ forma non derivabile dallo span — verifica manuale"))), "place": place})


ADDED = "struct<e_at:bigint,token_id:string,tu_id:string,speaker:string,begin:string,end:string,takes_end:boolean,takes_begin:boolean,from:string>"


def added_rows(kept: DataFrame, new: DataFrame, tasks: int | None = None) -> DataFrame:
    """Runs of added rows between two that stay: (file, run, added, end_gone, begin_gone), `run` the place of the row before (0 if none)."""
    known = lambda x: F.when(~X.missing(x), x)
    stay = F.struct("token_id", "tu_id", "speaker", F.col("new_begin").alias("begin"), F.col("new_end").alias("end"))
    both = kept.select("file", "e_at", stay.alias("stay"), F.lit(None).cast("struct<token_id:string,tu_id:string,speaker:string>").alias("new"))
    both = both.unionByName(new.select("file", "e_at", F.struct("token_id", known(F.col("e.tu_id")).alias("tu_id"), known(F.col("e.speaker")).alias("speaker")).alias("new")), allowMissingColumns=True)
    both = by_file(both, tasks)
    by = Window.partitionBy("file").orderBy("e_at")
    both = both.withColumn("run", F.sum(F.col("stay").isNotNull().cast("int")).over(by))
    ahead = F.first("stay", ignorenulls=True).over(by.rowsBetween(1, Window.unboundedFollowing))
    both = both.withColumns({"ahead": ahead, "behind": F.last("stay", ignorenulls=True).over(by)}).where("new is not null")
    runs = both.groupBy("file", "run").agg(F.first("behind").alias("p"), F.first("ahead").alias("n"), F.array_sort(F.collect_list(F.struct("e_at", "new"))).alias("xs"))
    n = F.col("n")
    start = F.struct(F.col("p").isNotNull().alias("is"), F.col("p.token_id").alias("id"), F.col("p.tu_id").alias("tu"), F.col("p.speaker").alias("sp"), F.col("p.end").alias("end"), n["begin"].alias("begin"), F.array().cast(f"array<{ADDED}>").alias("out"))

    def step(s: Column, x: Column) -> Column:
        tu = F.coalesce(x["new"]["tu_id"], inferred(s["tu"], n["tu_id"]))
        unit = F.coalesce(F.when(s["tu"] == tu, s["sp"]), F.when(n["tu_id"] == tu, n["speaker"]))
        sp = F.coalesce(x["new"]["speaker"], unit, inferred(s["sp"], n["speaker"]))
        takes_end = s["is"] & s["tu"].eqNullSafe(tu) & s["end"].isNotNull()
        takes_begin = n.isNotNull() & n["tu_id"].eqNullSafe(tu) & s["begin"].isNotNull()
        end, begin = F.when(takes_end, s["end"]), F.when(takes_begin, s["begin"])
        row = F.struct(x["e_at"].alias("e_at"), x["new"]["token_id"].alias("token_id"), tu.alias("tu_id"), sp.alias("speaker"), begin.alias("begin"), end.alias("end"), takes_end.alias("takes_end"), takes_begin.alias("takes_begin"), s["id"].alias("from")).cast(ADDED)
        return F.struct(F.lit(True).alias("is"), x["new"]["token_id"].alias("id"), tu.alias("tu"), sp.alias("sp"), end.alias("end"), F.when(~takes_begin, s["begin"]).alias("begin"), F.concat(s["out"], F.array(row)).alias("out"))

    runs = runs.withColumn("added", F.aggregate("xs", start, step, lambda s: s["out"]))
    gone = {"end_gone": F.get("added", F.lit(0))["takes_end"], "begin_gone": F.exists("added", lambda x: x["takes_begin"])}
    return runs.withColumns(gone).select("file", "run", "added", F.col("n.token_id").alias("to"), *gone)


def patched(source: DataFrame, heads: DataFrame, edited: DataFrame, tasks: int | None = None) -> DataFrame:
    """Rows (file, change, token_id, tu_id, old, new, notes, line, e_at, k): what was kept, changed, dropped and added; old and new are maps of values, null where there are none.

    `line` is the place in the source and `e_at` that in the edited table; `k` counts the rows before
    that stay, the row itself included, in the one (source) or the other (added rows). `tasks`: how many tasks the rows of files are dealt to.
    """
    edits = edited_rows(edited).join(heads.select("file"), "file", "left_semi")
    rows = compared(source.join(edits.select("file").distinct(), "file", "left_semi"), edits, tasks)
    kept = kept_rows(rows)
    new = edits.join(source.select("file", F.col("cells")["token_id"].alias("token_id")), ["file", "token_id"], "left_anti")
    runs = added_rows(kept, new, tasks)
    behind = runs.where("end_gone").select("file", F.col("run").alias("place"), "end_gone")
    ahead = runs.where("begin_gone").select("file", (F.col("run") + 1).alias("place"), "begin_gone")
    kept = kept.join(behind, ["file", "place"], "left").join(ahead, ["file", "place"], "left")
    kept = kept.withColumnsRenamed({"tu_id": "new_tu_id", "speaker": "new_speaker"})  # the item's own tu_id is that of the source
    begin, end = F.when(F.col("begin_gone").isNull(), F.col("new_begin")), F.when(F.col("end_gone").isNull(), F.col("new_end"))
    set_to = {"span": F.col("span"), "form": F.col("form"), "jefferson_feats": F.col("feats"), "tu_id": F.col("new_tu_id"), "speaker": F.col("new_speaker"), "align": timed(F.col("cells")["align"], begin, end)}

    def renewed(k: Column, v: Column) -> Column:
        out = v
        for c, x in set_to.items():
            out = F.when(k == c, F.coalesce(x, v)).otherwise(out)
        return out

    stayed = kept.select("file", "change", "token_id", F.coalesce(F.col("cells")["tu_id"], F.lit("?")).alias("tu_id"), F.col("cells").alias("old"), F.transform_values("cells", renewed).alias("new"), "notes", "line", "e_at", "k")
    nothing = F.lit(None).cast("map<string,string>")
    dropped = rows.where("not stays").select("file", F.lit("dropped").alias("change"), "token_id", F.coalesce(F.col("cells")["tu_id"], F.lit("?")).alias("tu_id"), F.col("cells").alias("old"), nothing.alias("new"), "notes", "line", F.lit(None).cast("long").alias("e_at"), "k")
    each = runs.select("file", "run", "to", F.posexplode("added").alias("i", "x"), "added").select("file", "run", "to", "x.*", F.coalesce(F.get("added", F.col("i") + 1)["takes_end"], F.lit(False)).alias("passed"))
    each = each.join(new.select("file", "token_id", "e"), ["file", "token_id"]).join(heads.select("file", "cols"), "file")
    put = {
        "token_id": F.col("token_id"), "span": F.col("e.span"), "form": F.col("e.form"), "tu_id": F.coalesce("tu_id", F.lit(X.MISSING)), "speaker": F.coalesce("speaker", F.lit(X.MISSING)), "type": kind_of(F.col("e.span"), F.col("e.form")),
        "jefferson_feats": features(F.lit(X.MISSING), F.col("e.jefferson_feats"), F.lit(True), F.col("e.span")), "align": timed(F.lit(X.MISSING), F.col("begin"), F.when(~F.col("passed"), F.col("end"))),
    }
    made = F.map_from_arrays("cols", F.transform("cols", lambda c: F.coalesce(*[F.when(c == k, v) for k, v in put.items()], F.lit(X.MISSING))))
    notes = noted((F.col("takes_end"), said("✅ End=", F.col("end"), " ← `", F.col("from"), "`")), (F.col("takes_begin"), said("✅ Begin=", F.col("begin"), " ← `", F.col("to"), "`")), (~F.col("takes_end") & ~F.col("takes_begin"), F.lit("⚠️ verifica allineamento manualmente")))
    added = each.select("file", F.lit("added").alias("change"), "token_id", F.coalesce("tu_id", F.lit(X.MISSING)).alias("tu_id"), nothing.alias("old"), made.alias("new"), notes.alias("notes"), F.lit(None).cast("long").alias("line"), "e_at", F.col("run").alias("k"))
    return stayed.withColumn("line", F.col("line").cast("long")).unionByName(dropped.withColumn("line", F.col("line").cast("long"))).unionByName(added)


def new_lines(rows: DataFrame, heads: DataFrame) -> DataFrame:
    """Rows (file, line, raw): the files as they become, with the source's line ends."""
    line = F.concat(F.array_join(F.transform("cols", lambda c: F.coalesce(F.col("new")[c], F.lit(X.MISSING))), "\t"), "eol")
    body = rows.where("new is not null").join(heads, "file").select("file", (F.col("e_at") + 1).alias("line"), line.alias("raw"))
    return body.unionByName(heads.join(rows.select("file").distinct(), "file", "left_semi").select("file", F.lit(-1).cast("long").alias("line"), F.col("head").alias("raw")))


def recap_items(rows: DataFrame) -> DataFrame:
    """Rows for a recap: those that changed, in the order of the differences between the two lists of ids.

    Where the ids that stay are in the same order in both, the order follows from how many stay
    before a row: a row that stays, what was dropped after it, what was added after it. Files in
    which rows have moved go through a function, one file at a time; a row that moved isn't listed.
    """
    by = Window.partitionBy("file").orderBy("line")
    moved = rows.where("old is not null and new is not null").withColumn("back", F.col("e_at") < F.lag("e_at").over(by)).where("back").select("file").distinct()
    group = F.when(F.col("change") == "dropped", 1).when(F.col("change") == "added", 2).otherwise(0)
    plain = rows.join(moved, "file", "left_anti").withColumn("order", F.struct(F.col("k").cast("long").alias("a"), group.cast("long").alias("b"), F.coalesce("line", "e_at").alias("c")))

    def opcodes(table: pa.Table) -> pa.Table:
        ids = table["token_id"].to_pylist()
        a = [ids[i] for i in _sorted(table["line"])]
        b = [ids[i] for i in _sorted(table["e_at"])]
        out = []
        for tag, i1, i2, j1, j2 in difflib.SequenceMatcher(a=a, b=b).get_opcodes():
            out += [(t, "stays") for t in a[i1:i2]] if tag == "equal" else [(t, "dropped") for t in a[i1:i2]] + [(t, "added") for t in b[j1:j2]]
        name = table["file"][0].as_py()
        return pa.table({"file": pa.array([name] * len(out), table["file"].type), "token_id": pa.array([t for t, _ in out], pa.string()), "tag": pa.array([g for _, g in out], pa.string()), "at": pa.array(range(len(out)), pa.int64())})

    turned = rows.join(moved, "file", "left_semi")
    places = turned.select("file", "token_id", "line", "e_at").groupBy("file").applyInArrow(opcodes, f"file {dict(rows.dtypes)['file']}, token_id string, tag string, at long")
    tag = F.when(F.col("change").isin("dropped", "added"), F.col("change")).otherwise("stays")
    turned = turned.withColumn("tag", tag).join(places, ["file", "token_id", "tag"]).withColumn("order", F.struct(F.col("at").alias("a"), F.lit(0).cast("long").alias("b"), F.lit(0).cast("long").alias("c"))).drop("tag", "at")
    every = plain.unionByName(turned).where("change <> 'kept'")
    return every.withColumn("at", F.row_number().over(Window.partitionBy("file").orderBy("order"))).drop("order")


def _sorted(column: pa.ChunkedArray) -> list[int]:
    values = column.to_pylist()
    return sorted((i for i, v in enumerate(values) if v is not None), key=values.__getitem__)


def unified(old: DataFrame, new: DataFrame, folder: str = "tsv", suffix: str = ".vert.tsv") -> DataFrame:
    """Rows (file, patch): the unified difference of raw lines with their own line ends; files without any are left out. A group is one file."""
    kind = dict(old.dtypes)["file"]

    def work(a: pa.Table, b: pa.Table) -> pa.Table:
        name = a["file"][0]
        sides = [side.sort_by("line")["raw"].to_pylist() for side in (a, b)]
        place = f"{folder}/{name}{suffix}"
        lines = "".join(difflib.unified_diff(*sides, fromfile=f"a/{place}", tofile=f"b/{place}")) if len(b) else ""
        return pa.table({"file": pa.array([name.as_py()] if lines else [], name.type), "patch": pa.array([lines] if lines else [], pa.string())})

    read = old.select("file", F.col("line").cast("long").alias("line"), "raw")
    return read.join(new.select("file").distinct(), "file", "left_semi").groupBy("file").cogroup(new.select("file", "line", "raw").groupBy("file")).applyInArrow(work, f"file {kind}, patch string")

"""The validation report: how often each rule was applied, by module and by conversation, and every fault that is left.

An occurrence is (module, code, kind, rule, tu_id, speaker, text, span, detail, n): kind is warning,
error, metadata or no-transcript. All counts come from one pass with grouping sets. Pages are text for each
module; a page shows a limited number of records, and says how many there are.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from parlance.operators.formats import rule_counts
from parlance.operators.normalize import ERRORS
from parlance.operators.reports import PAGE_ROWS

COLUMNS = {"module": "string", "code": "string", "kind": "string", "rule": "string", "tu_id": "long", "speaker": "string", "text": "string", "span": "string", "detail": "string", "n": "long"}
#: Fixed value: the rule that tokens of no known type break.
TOKEN_RULE = "TOKEN_TYPE_ERROR"


def shaped(df: DataFrame) -> DataFrame:
    return df.select(*[(F.col(c) if c in df.columns else F.lit(None)).cast(t).alias(c) for c, t in COLUMNS.items()])


def occurrences(units: DataFrame, tokens: DataFrame, module: Column, conversations: DataFrame | None = None, checks: DataFrame | None = None) -> DataFrame:
    """What there is to say of processed transcripts; `module` is a column of `code`, the transcript.

    Units have include, w_ and e_; tokens have type. `conversations` (code): those that should have a
    transcript. `checks` (code, problem): what is wrong in the metadata.
    """
    named = lambda df: shaped(df.withColumn("module", module))
    counted = rule_counts(units).where("kind = 'WARNINGS'").select(F.col("transcript_id").cast("string").alias("code"), F.lit("warning").alias("kind"), "rule", "n")
    faults = F.filter(F.array(*[F.when(F.col(f"e_{c.name}"), F.lit(c.name)) for c in ERRORS]), lambda x: x.isNotNull())
    errors = units.where("include").select(F.col("transcript_id").cast("string").alias("code"), F.lit("error").alias("kind"), F.explode(faults).alias("rule"), "tu_id", "speaker", "text", F.lit(1).alias("n"))
    wrong = tokens.where("type = 'error'").select(F.col("transcript_id").cast("string").alias("code"), F.lit("error").alias("kind"), F.lit(TOKEN_RULE).alias("rule"), "tu_id", "speaker", "text", "span", F.lit(1).alias("n"))
    out = named(counted).unionByName(named(errors)).unionByName(named(wrong))
    if checks is not None:
        out = out.unionByName(named(checks.select(F.col("code").cast("string").alias("code"), F.lit("metadata").alias("kind"), F.col("problem").alias("detail"), F.lit(1).alias("n"))))
    if conversations is not None:
        there = units.select(F.col("transcript_id").cast("string").alias("code")).distinct()
        gone = conversations.select(F.col("code").cast("string").alias("code")).distinct().join(there, "code", "left_anti")
        out = out.unionByName(named(gone.select("code", F.lit("no-transcript").alias("kind"), F.lit("no transcript found for this conversation").alias("detail"), F.lit(1).alias("n"))))
    return out


def totals(rows: DataFrame) -> DataFrame:
    """Rows (level, module, code, kind, rule, n, conversations): sums by module, by rule of a module, by conversation, and by rule of a conversation, in one pass. What a level doesn't go by is null."""
    sets = [["module"], ["module", "kind", "rule"], ["module", "code"], ["module", "code", "kind", "rule"]]
    keys = ["module", "code", "kind", "rule"]
    # the finest level first, so that what is made fourfold is small
    every = rows.groupBy(*keys).agg(F.sum("n").alias("n")).groupingSets([[F.col(c) for c in s] for s in sets], *[F.col(c) for c in keys]).agg(F.sum("n").alias("n"), F.countDistinct("code").alias("conversations"), F.grouping_id(*keys).alias("__id"))
    level = F.element_at(F.create_map(*[F.lit(x) for pair in ((7, "module"), (4, "rule"), (3, "conversation"), (0, "conversation rule")) for x in pair]), F.col("__id").cast("int"))
    return every.select(level.alias("level"), *keys, "n", "conversations")


def counts_cell(pairs: Column) -> Column:
    """`rule:n, rule:n` by name; `_` for none."""
    text = F.array_join(F.transform(F.array_sort(pairs), lambda x: F.concat(x["rule"], F.lit(":"), x["n"].cast("string"))), ", ")
    return F.when(F.size(pairs) > 0, text).otherwise("_")


def log_pages(conversations: DataFrame, sums: DataFrame) -> DataFrame:
    """Rows (module, conversations, with_warnings, text): the AsciiDoc section of a module's log. Conversations are (module, code); those without warnings and faulty tokens are counted, not listed."""
    rows = sums.where("level = 'conversation rule' and (kind = 'warning' or rule = 'TOKEN_TYPE_ERROR')")
    warned = F.collect_list(F.when(F.col("kind") == "warning", F.struct("rule", "n")))
    per = rows.groupBy("module", "code").agg(counts_cell(warned).alias("said"), F.coalesce(F.sum(F.when(F.col("rule") == TOKEN_RULE, F.col("n"))), F.lit(0)).alias("tokens"))
    line = F.concat(F.lit("|"), "code", F.lit(" |"), "said", F.lit(" |"), F.when(F.col("tokens") > 0, F.col("tokens").cast("string")).otherwise("_"))
    every = conversations.select("module", "code").distinct().join(per, ["module", "code"], "left").withColumn("line", line)
    pages = every.groupBy("module").agg(F.count("*").alias("conversations"), F.count("line").alias("with_warnings"), F.array_join(F.transform(F.array_sort(F.collect_list(F.when(F.col("line").isNotNull(), F.struct("code", "line")))), lambda x: x["line"]), "\n").alias("body"))
    anchor = F.replace(F.lower("module"), F.lit(" "), F.lit("-"))
    text = F.concat(F.lit("[["), anchor, F.lit("]]\n== "), "module", F.lit('\n\n[cols="1,4,1"]\n|===\n|Code |Warnings |Error tokens\n'), F.when(F.col("body") != "", F.concat("body", F.lit("\n"))).otherwise(""), F.lit("|===\n"))
    return pages.select("module", "conversations", "with_warnings", text.alias("text"))


def log_overview(pages: DataFrame) -> DataFrame:
    """One row (text): the table of modules that a log begins with."""
    line = F.concat(F.lit("|"), "module", F.lit(" |"), F.col("conversations").cast("string"), F.lit(" |"), F.col("with_warnings").cast("string"))
    rows = pages.agg(F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("module", line.alias("line")))), lambda x: x["line"]), "\n").alias("body"))
    return rows.select(F.concat(F.lit('== Overview\n\n[cols="1,1,1"]\n|===\n|Module |Conversations |With warnings\n'), "body", F.lit("\n|===\n")).alias("text"))


def records(rows: DataFrame, urls: tuple[Column, Column] | None = None) -> DataFrame:
    """Rows (module, code, place, json): every fault as a record, those of a conversation in order. `urls`: of a transcript's table and its recording, columns of module and code."""
    faults = rows.where("kind <> 'warning'")
    table, recording = urls or (F.lit(None).cast("string"), F.lit(None).cast("string"))
    there = F.col("kind") != "no-transcript"
    ends = [F.when(there, table).alias("tsvUrl"), F.when(there, recording).alias("eafUrl")]
    plain = ["module", "code", "kind", "rule", F.col("tu_id").alias("tuId"), "speaker", "text"]
    as_text = lambda *columns: F.to_json(F.struct(*columns), {"ignoreNullFields": "false"})
    text = F.when(F.col("kind") == "error", as_text(*plain, "span", "detail", *ends)).otherwise(as_text(*plain, "detail", *ends))
    rank = F.when(F.col("kind") == "no-transcript", 0).when(F.col("kind") == "metadata", 1).when(F.col("rule") != TOKEN_RULE, 2).otherwise(3)
    by = Window.partitionBy("module", "code").orderBy(rank, "tu_id", "rule", "span", "detail")
    # a closing tag inside a record would end the script that holds it
    return faults.select("module", "code", F.row_number().over(by).alias("place"), F.replace(text, F.lit("</"), F.lit("<\\/")).alias("json"))


def error_pages(rows: DataFrame, limit: int = PAGE_ROWS) -> DataFrame:
    """Rows (module, records, text): a module's page with its first `limit` records embedded, the number of all in its head."""
    by = Window.partitionBy("module").orderBy("code", "place")
    all_of = rows.groupBy("module").agg(F.count("*").alias("records"))
    shown = rows.withColumn("__n", F.row_number().over(by)).where(F.col("__n") <= limit)
    data = F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("__n", "json"))), lambda x: x["json"]), ", ")
    pages = shown.groupBy("module").agg(data.alias("data")).join(all_of, "module")
    text = F.concat(F.lit("= Validation errors: "), "module", F.lit(" ("), F.col("records").cast("string"), F.lit(')\n\n++++\n<script type="application/json" class="records">['), "data", F.lit("]</script>\n++++\n"))
    return pages.select("module", "records", text.alias("text"))

"""Reports over transcripts: one table of issues, their order, and overviews."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Rows of an issues page: a limit of the page, not of the table.
PAGE_ROWS = 500


def issues(conversations: DataFrame, summary: DataFrame, metadata: DataFrame, details: DataFrame, tokens: DataFrame) -> DataFrame:
    """Rows (code, kind, detail) of all that is wrong: no transcript, metadata, faulty units, faulty tokens."""
    told = lambda df, kind, detail: df.select("code", F.lit(kind).alias("kind"), detail.cast("string").alias("detail"))
    return (
        told(conversations.join(summary, "code", "left_anti"), "missing", F.lit("no transcript"))
        .unionByName(told(metadata, "metadata", F.col("problem")))
        .unionByName(told(details, "unit", F.col("rule")))
        .unionByName(told(tokens, "token", F.col("form")))
    )


def severity(missing: Column, errors: Column, warnings: Column, data: Column) -> Column:
    return F.when(missing, 0).when(errors > 0, 1).when(warnings > 0, 2).when(~data, 3).otherwise(4)


def report(conversations: DataFrame, summary: DataFrame) -> DataFrame:
    """One row per conversation: severity (0 missing, 1 errors, 2 warnings, 3 no data, 4 fine), errors, warnings, tokens. Summary: code, units, errors, warnings, tokens."""
    df = conversations.select("code").distinct().join(summary.withColumn("__here", F.lit(True)), "code", "left")
    here = F.coalesce(F.col("__here"), F.lit(False))
    zero = lambda c: F.coalesce(F.col(c), F.lit(0)).cast("long")
    return df.select("code", severity(~here, zero("errors"), zero("warnings"), zero("units") > 0).alias("severity"), zero("errors").alias("errors"), zero("warnings").alias("warnings"), zero("tokens").alias("tokens"))


def actionable(rows: DataFrame) -> DataFrame:
    """Conversations that an errors page lists: without transcript, with faulty units, or with metadata issues; faulty tokens alone don't count."""
    return rows.where("severity = 0 or errors > 0 or metadata_issues > 0")


def overview(rows: DataFrame, module: str = "module") -> DataFrame:
    return rows.groupBy(module).agg(F.count("*").alias("conversations"), F.count_if(F.col("severity") <= 2).alias("with_issues"), F.sum("errors").alias("errors"), F.sum("warnings").alias("warnings"))


def counts_text(rules: DataFrame, key: str = "code") -> DataFrame:
    """Rows (key, text): `rule:n` by name."""
    return rules.groupBy(key).agg(F.array_join(F.array_sort(F.collect_list(F.concat("rule", F.lit(":"), F.col("n").cast("string")))), " ").alias("text"))


def page(rows: DataFrame, order: list[Column], limit: int = PAGE_ROWS) -> DataFrame:
    """The first rows of an issues page."""
    return rows.orderBy(*order).limit(limit)


def upserted(old: DataFrame, new: DataFrame, key: str = "transcript") -> DataFrame:
    """Summaries with those of `new` in place of old ones of the same transcript."""
    return old.join(new.select(key).distinct(), key, "left_anti").unionByName(new)


def widened(rows: DataFrame, column: str, width: int | None = None) -> DataFrame:
    """An array column as `column::0`, `column::1` and so on; 0 where a row's array is shorter. Without a width, as many columns as the longest array has values."""
    if width is None:
        width = rows.agg(F.coalesce(F.max(F.size(column)), F.lit(0))).first()[0]
        width = max(0, width)
    return rows.select(*[c for c in rows.columns if c != column], *[F.coalesce(F.get(column, F.lit(k)), F.lit(0)).alias(f"{column}::{k}") for k in range(width)])

"""Queries of texts for readers, and of the helpers that they use."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from parlance.functions import fields as X
from parlance.operators import alignment, formats, pages, patches, reports
from parlance.plans.registry import query, table, timed, units
from parlance.plans.speech import verts

FILE = "conv_id"


def edited(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Turns as tokens, with what an edit made of each: every fifth dropped, every seventh added, every third another."""
    n, t = F.col("turn"), F.col("conv_id") + F.col("turn")
    change = F.when(t % 5 == 0, "dropped").when(t % 7 == 0, "added").when(t % 3 == 0, "changed").otherwise("kept")
    old, new = F.col("role"), F.when(t % 2 == 0, F.concat("role", F.lit("|x"))).otherwise(F.concat("role", F.lit("y")))
    df = table(spark, sf_dir, "conversations").select(FILE, n.alias("line"), F.floor(n / 2).alias("tu_id"), F.concat("conv_id", F.lit("-"), n).alias("token_id"), change.alias("change"), old.alias("old_span"), new.alias("new_span"), old.alias("old_form"), old.alias("new_form"), F.when(t % 4 == 0, "Volume=High").otherwise("_").alias("new_jefferson_feats"), F.when(t % 10 == 0, F.array(F.lit("⚠️ no time"))).alias("notes"))
    return df.withColumns({c: F.lit("_") for c in ("old_jefferson_feats", "old_align", "new_align")})


@query()
def recap_pages(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pages.recap_markdown(edited(spark, sf_dir), FILE)


@query()
def unified_patches(spark: SparkSession, sf_dir: str) -> DataFrame:
    c = table(spark, sf_dir, "conversations").select(FILE, F.col("turn").alias("line"), "text")
    return pages.patches_of(c, c.where((F.col("line") + F.col(FILE)) % 9 != 4), FILE)


@query("""
WITH d AS (SELECT conv_id, turn, CAST(turn // 2 AS VARCHAR) AS tu_id, (conv_id + turn) % 7 = 0 AS new, CASE WHEN (conv_id + turn) % 7 <> 0 OR turn % 2 = 0 THEN CAST(turn // 2 AS VARCHAR) END AS unit, role, CASE WHEN (conv_id + turn) % 7 <> 0 THEN role END AS said FROM conversations),
     u AS (SELECT *, last_value(unit IGNORE NULLS) OVER b AS pu, first_value(unit IGNORE NULLS) OVER a AS nu FROM d WINDOW b AS (PARTITION BY conv_id ORDER BY turn ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), a AS (PARTITION BY conv_id ORDER BY turn ROWS BETWEEN 1 FOLLOWING AND UNBOUNDED FOLLOWING)),
     f AS (SELECT *, CASE WHEN unit IS NOT NULL THEN unit WHEN pu = nu THEN pu WHEN nu IS NULL AND pu IS NOT NULL THEN pu WHEN pu IS NULL AND nu IS NOT NULL THEN nu ELSE '_' END AS u FROM u),
     s AS (SELECT *, last_value(CASE WHEN said IS NOT NULL THEN said END IGNORE NULLS) OVER b AS p, last_value(CASE WHEN said IS NOT NULL THEN u END IGNORE NULLS) OVER b AS pg, first_value(CASE WHEN said IS NOT NULL THEN said END IGNORE NULLS) OVER a AS n, first_value(CASE WHEN said IS NOT NULL THEN u END IGNORE NULLS) OVER a AS ng FROM f WINDOW b AS (PARTITION BY conv_id ORDER BY turn ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), a AS (PARTITION BY conv_id ORDER BY turn ROWS BETWEEN 1 FOLLOWING AND UNBOUNDED FOLLOWING))
SELECT conv_id, turn AS line, conv_id || '-' || turn AS token_id, u AS tu_id, CASE WHEN said IS NOT NULL THEN said WHEN pg = u THEN p WHEN ng = u THEN n WHEN p = n THEN p WHEN n IS NULL AND p IS NOT NULL THEN p WHEN p IS NULL AND n IS NOT NULL THEN n ELSE '_' END AS speaker, '_' AS lemma, 'Volume=High|Intonation=Rising' AS jefferson_feats, 'linguistic' AS type FROM s WHERE new
""")
def token_rows_added(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Turns that the token table hasn't: unit and speaker come from the neighbours."""
    new, n = (F.col(FILE) + F.col("turn")) % 7 == 0, F.col("turn")
    c = table(spark, sf_dir, "conversations")
    rows = c.select(FILE, n.alias("line"), F.concat(FILE, F.lit("-"), n).alias("token_id"), F.lit("Ciao?").alias("span"), F.lit("ciao").alias("form"), F.when(~new | (n % 2 == 0), F.floor(n / 2).cast("string")).alias("tu_id"), F.when(~new, F.col("role")).alias("speaker"), new.alias("new"))
    known = rows.where("not new").select(FILE, "token_id", "speaker", "tu_id", "span", "form", F.lit("x").alias("lemma"), F.lit("_").alias("jefferson_feats"), F.lit("_").alias("type"))
    return patches.added_rows(rows.drop("new"), known, FILE).select(FILE, "line", "token_id", "tu_id", "speaker", "lemma", "jefferson_feats", "type")


@query(r"""
WITH e AS (SELECT transcript_id, tu_id, replace(replace(replace(replace(replace(text, '&', '&amp;'), '<', '&lt;'), '>', '&gt;'), '"', '&quot;'), '''', '&#x27;') AS t FROM {units} u),
     a AS (SELECT *, regexp_replace(t, '(\(\(.+?\)\))', chr(57345) || '\1' || chr(57344), 'g') AS x FROM e),
     b AS (SELECT transcript_id, tu_id, regexp_replace(x, '(\[[^\[\]]+\])', chr(57346) || '\1' || chr(57344), 'g') AS x FROM a),
     c AS (SELECT transcript_id, tu_id, regexp_replace(x, '(°(?:[^°\x{E000}-\x{E00F}]|[\x{E001}-\x{E00F}][^°\x{E000}-\x{E00F}]*\x{E000})+°)', chr(57347) || '\1' || chr(57344), 'g') AS x FROM b),
     d AS (SELECT transcript_id, tu_id, regexp_replace(x, '(\(\.{1,3}\))', chr(57348) || '\1' || chr(57344), 'g') AS x FROM c),
     f AS (SELECT transcript_id, tu_id, regexp_replace(x, '([^\s\x{E000}-\x{E00F}]+~)', chr(57349) || '\1' || chr(57344), 'g') AS x FROM d),
     g AS (SELECT transcript_id, tu_id, regexp_replace(x, '(\w)(:{2,})', '\1' || chr(57350) || '\2' || chr(57344), 'g') AS x FROM f)
SELECT transcript_id, tu_id, replace(replace(replace(replace(replace(replace(replace(x, chr(57345), '<span class="para">'), chr(57346), '<span class="overlap">'), chr(57347), '<span class="quiet">'), chr(57348), '<span class="pause">'), chr(57349), '<span class="trunc">'), chr(57350), '<span class="length">'), chr(57344), '</span>') AS html FROM g
""")
def notation_markup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return units(spark, sf_dir).select("transcript_id", "tu_id", pages.markup(F.col("text")).alias("html"))


@query()
def html_pages(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pages.html_pages(timed(spark, sf_dir))


def metadata_of(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    """Conversations and participants (roles) as metadata tables."""
    c = table(spark, sf_dir, "conversations")
    conv = c.groupBy(F.col("conv_id").alias("code")).agg(F.lit("free").alias("type"), F.array_join(F.array_sort(F.collect_set("role")), ";").alias("participants"), F.count("*").cast("string").alias("participants-number"))
    return conv, c.select(F.col("role").alias("code")).distinct().select("code", F.lit("F").alias("gender"), F.concat("code", F.lit("; x")).alias("age-range"))


@query()
def vertical(spark: SparkSession, sf_dir: str) -> DataFrame:
    return formats.vertical(verts(spark, sf_dir), *metadata_of(spark, sf_dir), "http://corpus.example/")


@query()
def vertical_dynamic(spark: SparkSession, sf_dir: str) -> DataFrame:
    return formats.vertical(verts(spark, sf_dir), *metadata_of(spark, sf_dir), "http://corpus.example/", dynamic=True)


@query("""
WITH i AS (SELECT o_orderstatus AS module, o_custkey AS code, 'unit' AS kind, o_orderpriority AS detail, row_number() OVER (PARTITION BY o_orderstatus ORDER BY o_custkey, o_orderpriority) AS n, count(*) OVER (PARTITION BY o_orderstatus) AS every FROM orders)
SELECT module, '== ' || module || ' (' || max(every) || ')' || chr(10) || chr(10) || '[cols="1,1,3",options="header"]' || chr(10) || '|===' || chr(10) || '| code | kind | detail' || chr(10) || chr(10)
       || string_agg('| ' || code || chr(10) || '| ' || kind || chr(10) || '| ' || detail, chr(10) || chr(10) ORDER BY n) || chr(10) || '|===' || chr(10) AS text
FROM i WHERE n <= 500 GROUP BY module
""")
def issue_tables(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The first 500 issues of each module, which the page limits."""
    o = table(spark, sf_dir, "orders").select(F.col("o_orderstatus").alias("module"), F.col("o_custkey").alias("code"), F.lit("unit").alias("kind"), F.col("o_orderpriority").alias("detail"))
    return pages.issue_tables(o)


@query("""
SELECT c_custkey, CASE WHEN c_custkey % 5 = 0 THEN 'KIP' WHEN c_custkey % 5 = 1 THEN 'KIPasti' WHEN c_custkey % 5 = 2 THEN 'ParlaBO' WHEN c_custkey % 5 = 3 THEN 'ParlaTO' ELSE 'other' END AS module FROM customer
""")
def module_routing(spark: SparkSession, sf_dir: str) -> DataFrame:
    k = F.col("c_custkey")
    start = F.when(k % 5 == 0, F.when(k % 2 == 0, "BOA").otherwise("TOD")).when(k % 5 == 1, "KPS").when(k % 5 == 2, "PBB").when(k % 5 == 3, "PTD").otherwise("XYZ")
    return table(spark, sf_dir, "customer").select("c_custkey", X.module_of(F.concat(start, k.cast("string")), "other").alias("module"))


@query("""
WITH l AS (SELECT o_custkey, list(o_orderkey ORDER BY o_orderkey) AS n FROM orders GROUP BY 1)
SELECT o_custkey, array_to_string(list_resize(n, (SELECT max(len(n)) FROM l), 0), ',') AS wide FROM l
""")
def stats_widened_whole(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All orders of each customer, widened to the longest list; the columns as one text, as their number follows from the data."""
    df = table(spark, sf_dir, "orders").groupBy("o_custkey").agg(F.array_sort(F.collect_list("o_orderkey")).alias("n"))
    wide = reports.widened(df, "n")
    return wide.select("o_custkey", F.concat_ws(",", *[F.col(f"`{c}`").cast("string") for c in wide.columns[1:]]).alias("wide"))


@query(r"""
WITH t AS (SELECT conv_id, turn, translate(text, 'en', '''=') AS x FROM conversations),
     a AS (SELECT conv_id, turn, regexp_replace(regexp_replace(x, '([^\s''=][''=])([^\s''=])', '\1 \2', 'g'), '([^\s''=][''=])([^\s''=])', '\1 \2', 'g') AS x FROM t),
     b AS (SELECT conv_id, turn, list_filter(string_split_regex(x, '\s+'), lambda w: w <> '') AS w FROM a)
SELECT conv_id, turn, CAST(len(w) AS BIGINT) AS n, array_to_string(w, '|') AS words FROM b
""")
def word_split(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Words cut after apostrophes and links in their middle; e and n are made to be them."""
    w = X.split_words(F.translate("text", "en", "'="))
    return table(spark, sf_dir, "conversations").select("conv_id", "turn", F.size(w).cast("long").alias("n"), F.array_join(w, "|").alias("words"))


@query()
def pair_alignment(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two transcriptions of each item, paired by their names and aligned; the k-th word of an item ends at k."""
    b = table(spark, sf_dir, "benchmark").select("item_id", F.transform(F.split("text", r"\s+"), lambda x, i: F.struct(x.alias("w"), (i + 1).cast("double").alias("end"))).alias("w"))
    files = b.select(F.concat(F.lit("dir/1_item"), "item_id").alias("path"), F.col("w").alias("t")).unionByName(b.select(F.concat(F.lit("dir/2_item"), "item_id").alias("path"), F.filter("w", lambda x, i: i % 6 != 2).alias("t")))
    files = files.select("path", F.col("t.w").alias("tokens"), F.col("t.end").alias("ends"), F.array_max("t.end").alias("length"))
    return alignment.alignment_rows(alignment.file_pairs(files), ["base", "first", "second"])


@query(r"SELECT item_id, CAST(i AS BIGINT) AS form, CAST(i AS BIGINT) AS word FROM (SELECT item_id, unnest(range(0, len(regexp_split_to_array(text, '\s+')))) AS i FROM benchmark) t")
def soft_alignment(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every form finds its own word when nothing was left out."""
    b = table(spark, sf_dir, "benchmark").select("item_id", F.split("text", r"\s+").alias("w"))
    forms = F.transform("w", lambda x: F.lower(F.regexp_replace(x, "[.,?!:;]", "")))
    got = b.select("item_id", F.posexplode(alignment.soft_align(forms, F.col("w"))).alias("form", "word"))
    return got.select("item_id", F.col("form").cast("long").alias("form"), F.col("word").cast("long").alias("word"))

"""Queries of metadata, patches, alignments and reports."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from parlance.functions import fields as X
from parlance.operators import alignment, metadata, patches, reports
from parlance.plans.registry import query, table, tasks


def people(spark: SparkSession, sf_dir: str) -> list[DataFrame]:
    """Two modules of participants: customers, and suppliers whose codes overlap with them and whose columns are others."""
    a = table(spark, sf_dir, "customer").select(F.concat(F.lit("P"), "c_custkey").alias("code"), F.concat("c_mktsegment", F.lit(":x")).alias("birth-region"), F.col("c_name").alias("occupation"), F.col("c_custkey").alias("line"))
    b = table(spark, sf_dir, "supplier").select(F.concat(F.lit("P"), F.col("s_suppkey") * 3).alias("code"), F.concat(F.lit("N"), "s_nationkey").alias("school-region"), F.lit("extra").alias("other"), F.col("s_suppkey").alias("line"))
    return [a, b]


@query("""
SELECT code, occupation, region FROM (
  SELECT *, row_number() OVER (PARTITION BY code ORDER BY m, line) AS r FROM (
    SELECT 'P' || c_custkey AS code, c_name AS occupation, split_part(c_mktsegment || ':x', ':', 1) AS region, 0 AS m, c_custkey AS line FROM customer
    UNION ALL SELECT 'P' || (s_suppkey * 3), '', 'N' || s_nationkey, 1, s_suppkey FROM supplier) u) v WHERE r = 1
""")
def meta_merge(spark: SparkSession, sf_dir: str) -> DataFrame:
    df = metadata.merged(people(spark, sf_dir), metadata.PARTICIPANTS, {"school-region": "birth-region"}, ("birth-region",))
    return df.select("code", "occupation", F.col("birth-region").alias("region"))


@query("SELECT code, name FROM (SELECT 'C' || (c_custkey % 100) AS code, c_name AS name, row_number() OVER (PARTITION BY c_custkey % 100 ORDER BY c_custkey DESC) AS r FROM customer) t WHERE r = 1")
def meta_lookup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Of equal codes the last."""
    df = table(spark, sf_dir, "customer").select(F.concat(F.lit("C"), F.col("c_custkey") % 100).alias("code"), F.col("c_name").alias("name"), F.col("c_custkey").alias("line"))
    return metadata.last_by_code(df).select("code", "name")


def dictionary(spark: SparkSession, sf_dir: str) -> DataFrame:
    n = table(spark, sf_dir, "nation").where("n_nationkey % 3 <> 0")
    return n.select(F.lit("people").alias("table"), F.lit("nation").alias("column"), F.col("n_name").alias("en"), F.lower("n_name").alias("it"))


@query("""
SELECT c_custkey, CASE WHEN a.n_nationkey % 3 <> 0 THEN lower(a.n_name) ELSE a.n_name END || ';' || CASE WHEN b.n_nationkey % 3 <> 0 THEN lower(b.n_name) ELSE b.n_name END AS nation
FROM customer JOIN nation a ON a.n_nationkey = c_nationkey JOIN nation b ON b.n_nationkey = (c_nationkey + 1) % 25
""")
def meta_translate(spark: SparkSession, sf_dir: str) -> DataFrame:
    n = table(spark, sf_dir, "nation")
    df = table(spark, sf_dir, "customer").join(n.select(F.col("n_nationkey").alias("c_nationkey"), F.col("n_name").alias("a")), "c_nationkey")
    df = df.withColumn("k", (F.col("c_nationkey") + 1) % 25).join(n.select(F.col("n_nationkey").alias("k"), F.col("n_name").alias("b")), "k").withColumn("nation", F.concat("a", F.lit(";"), "b"))
    return metadata.translated(df, dictionary(spark, sf_dir), "people", ["nation"], {"nation": ";"}).select("c_custkey", "nation")


@query("SELECT DISTINCT 'nation' AS \"column\", n_name AS value FROM customer JOIN nation ON n_nationkey = c_nationkey WHERE n_nationkey % 3 = 0")
def meta_untranslated(spark: SparkSession, sf_dir: str) -> DataFrame:
    df = table(spark, sf_dir, "customer").join(table(spark, sf_dir, "nation"), F.col("c_nationkey") == F.col("n_nationkey")).withColumn("nation", F.col("n_name"))
    return metadata.untranslated(df, dictionary(spark, sf_dir), "people", ["nation"])


@query("""
WITH x AS (SELECT c_custkey, unnest([c_mktsegment, CAST(c_nationkey % 3 AS VARCHAR)]) AS value FROM customer WHERE c_mktsegment IN ('MACHINERY', 'BUILDING'))
SELECT DISTINCT 'type' AS "column", value FROM x WHERE value <> '0'
""")
def meta_left_untranslated(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Parts of values of which no part was translated; 0 is translated to itself."""
    c = table(spark, sf_dir, "customer")
    words = c.where("c_mktsegment not in ('MACHINERY', 'BUILDING')").select(F.lit("talks").alias("table"), F.lit("type").alias("column"), F.col("c_mktsegment").alias("en"), F.lower("c_mktsegment").alias("it")).distinct()
    words = words.unionByName(spark.range(1).select(F.lit("talks").alias("table"), F.lit("type").alias("column"), F.lit("0").alias("en"), F.lit("0").alias("it")))
    return metadata.left_untranslated(c.select(F.concat("c_mktsegment", F.lit(":"), F.col("c_nationkey") % 3).alias("type")), words, "talks", ["type"], {"type": ":"})


def lists(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    """Conversations (orders' days) and participants (customers) that list each other, not always both ways."""
    o = table(spark, sf_dir, "orders").select(F.concat(F.lit("D"), F.date_format("o_orderdate", "yyyyMM")).alias("d"), F.col("o_custkey"), "o_orderkey")
    conv = o.where("o_orderkey % 5 <> 0").groupBy(F.col("d").alias("code")).agg(F.array_join(F.collect_set(F.concat(F.lit("P"), "o_custkey")), ";").alias("participants"))
    part = o.where("o_orderkey % 7 <> 0 and o_custkey % 11 <> 0").groupBy(F.concat(F.lit("P"), "o_custkey").alias("code")).agg(F.array_join(F.collect_set("d"), "; ").alias("conversations"))
    return conv, part


LISTS = """
WITH o AS (SELECT 'D' || strftime(o_orderdate, '%Y%m') AS conversation, 'P' || o_custkey AS participant, o_orderkey, o_custkey FROM orders),
     h AS (SELECT DISTINCT conversation, participant FROM o WHERE o_orderkey % 5 <> 0), t AS (SELECT DISTINCT conversation, participant FROM o WHERE o_orderkey % 7 <> 0 AND o_custkey % 11 <> 0)
"""


@query(LISTS + """
SELECT conversation, participant, 'unknown participant' AS problem FROM h WHERE participant NOT IN (SELECT participant FROM t)
UNION ALL SELECT conversation, participant, 'unknown conversation' FROM t WHERE conversation NOT IN (SELECT conversation FROM h)
UNION ALL SELECT conversation, participant, 'not listed by participant' FROM h WHERE participant IN (SELECT participant FROM t) AND NOT EXISTS (SELECT 1 FROM t WHERE t.conversation = h.conversation AND t.participant = h.participant)
UNION ALL SELECT conversation, participant, 'not listed by conversation' FROM t WHERE conversation IN (SELECT conversation FROM h) AND NOT EXISTS (SELECT 1 FROM h WHERE t.conversation = h.conversation AND t.participant = h.participant)
""")
def back_references(spark: SparkSession, sf_dir: str) -> DataFrame:
    return metadata.back_references(*lists(spark, sf_dir))


def said(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Who speaks in conversations: customers of most days, and unknown people."""
    o = table(spark, sf_dir, "orders").where("o_orderkey % 3 <> 0 and month(o_orderdate) <> 5")
    who = F.when(F.col("o_orderkey") % 13 == 0, "??").when(F.col("o_orderkey") % 17 == 0, "Suoni").otherwise(F.concat(F.lit(" P"), "o_custkey"))
    return o.select(F.concat(F.lit("D"), F.date_format("o_orderdate", "yyyyMM")).alias("transcript_id"), who.alias("speaker"))


SAID = """, s AS (SELECT DISTINCT 'D' || strftime(o_orderdate, '%Y%m') AS conversation, CASE WHEN o_orderkey % 13 = 0 THEN '??' WHEN o_orderkey % 17 = 0 THEN 'Suoni' ELSE 'P' || o_custkey END AS participant FROM orders WHERE o_orderkey % 3 <> 0 AND month(o_orderdate) <> 5),
     r AS (SELECT * FROM s WHERE participant NOT IN ('??', 'Suoni'))
"""


@query(LISTS + SAID + """
SELECT DISTINCT conversation, CAST(NULL AS VARCHAR) AS participant, 'no transcript' AS problem FROM h WHERE conversation NOT IN (SELECT conversation FROM s)
UNION ALL SELECT conversation, participant, 'does not speak' FROM h WHERE conversation IN (SELECT conversation FROM s) AND NOT EXISTS (SELECT 1 FROM r WHERE r.conversation = h.conversation AND r.participant = h.participant)
UNION ALL SELECT conversation, participant, 'speaks but is not listed' FROM r WHERE conversation IN (SELECT conversation FROM h) AND NOT EXISTS (SELECT 1 FROM h WHERE r.conversation = h.conversation AND r.participant = h.participant)
""")
def participants_check(spark: SparkSession, sf_dir: str) -> DataFrame:
    return metadata.speaker_checks(lists(spark, sf_dir)[0], said(spark, sf_dir))


@query(LISTS + SAID + """
SELECT c.conversation AS code, CASE WHEN x.q IS NULL THEN '_' WHEN x.q THEN 'yes' ELSE 'no' END AS unknown FROM (SELECT DISTINCT conversation FROM h) c LEFT JOIN (SELECT conversation, bool_or(participant = '??') AS q FROM s GROUP BY 1) x ON x.conversation = c.conversation
""")
def unknown_participant(spark: SparkSession, sf_dir: str) -> DataFrame:
    return metadata.unknown_participant(lists(spark, sf_dir)[0], said(spark, sf_dir)).select("code", F.col("unknown-participant").alias("unknown"))


@query("""
WITH a AS (SELECT l_orderkey, l_linenumber, l_quantity, l_returnflag FROM lineitem WHERE l_orderkey % 10 <> 1),
     b AS (SELECT l_orderkey, l_linenumber, CASE WHEN l_orderkey % 10 = 2 THEN l_quantity + 1 ELSE l_quantity END AS l_quantity, CASE WHEN l_linenumber = 3 THEN 'X' ELSE l_returnflag END AS l_returnflag FROM lineitem WHERE l_orderkey % 10 <> 3)
SELECT coalesce(a.l_orderkey, b.l_orderkey) AS l_orderkey, coalesce(a.l_linenumber, b.l_linenumber) AS l_linenumber,
       CASE WHEN b.l_orderkey IS NULL THEN 'dropped' WHEN a.l_orderkey IS NULL THEN 'added' WHEN a.l_quantity <> b.l_quantity OR a.l_returnflag <> b.l_returnflag THEN 'changed' ELSE 'kept' END AS change,
       CASE WHEN a.l_orderkey IS NULL OR b.l_orderkey IS NULL THEN '' ELSE concat_ws(',', CASE WHEN a.l_quantity <> b.l_quantity THEN 'l_quantity' END, CASE WHEN a.l_returnflag <> b.l_returnflag THEN 'l_returnflag' END) END AS changed
FROM a FULL OUTER JOIN b ON a.l_orderkey = b.l_orderkey AND a.l_linenumber = b.l_linenumber
""")
def keyed_diff(spark: SparkSession, sf_dir: str) -> DataFrame:
    li = table(spark, sf_dir, "lineitem").select("l_orderkey", "l_linenumber", "l_quantity", "l_returnflag")
    new = li.where("l_orderkey % 10 <> 3").withColumns({"l_quantity": F.when(F.col("l_orderkey") % 10 == 2, F.col("l_quantity") + 1).otherwise(F.col("l_quantity")), "l_returnflag": F.when(F.col("l_linenumber") == 3, "X").otherwise(F.col("l_returnflag"))})
    return patches.keyed_diff(li.where("l_orderkey % 10 <> 1"), new, ["l_orderkey", "l_linenumber"], ["l_quantity", "l_returnflag"])


@query("""
WITH r AS (SELECT o_custkey, o_orderkey, CASE WHEN (o_orderkey + o_custkey) % 3 = 0 THEN '_' ELSE o_orderstatus END AS v, substr(o_orderpriority, 1, 1) AS g FROM orders),
     f AS (SELECT *, last_value(CASE WHEN v <> '_' THEN v END IGNORE NULLS) OVER b AS p, last_value(CASE WHEN v <> '_' THEN g END IGNORE NULLS) OVER b AS pg, first_value(CASE WHEN v <> '_' THEN v END IGNORE NULLS) OVER a AS n, first_value(CASE WHEN v <> '_' THEN g END IGNORE NULLS) OVER a AS ng FROM r
           WINDOW b AS (PARTITION BY o_custkey ORDER BY o_orderkey ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), a AS (PARTITION BY o_custkey ORDER BY o_orderkey ROWS BETWEEN 1 FOLLOWING AND UNBOUNDED FOLLOWING))
SELECT o_custkey, o_orderkey, CASE WHEN v <> '_' THEN v WHEN pg = g THEN p WHEN ng = g THEN n WHEN p = n THEN p WHEN n IS NULL AND p IS NOT NULL THEN p WHEN p IS NULL AND n IS NOT NULL THEN n ELSE '_' END AS filled FROM f
""")
def neighbor_fill(spark: SparkSession, sf_dir: str) -> DataFrame:
    df = table(spark, sf_dir, "orders").select("o_custkey", "o_orderkey", F.when((F.col("o_orderkey") + F.col("o_custkey")) % 3 == 0, "_").otherwise(F.col("o_orderstatus")).alias("v"), F.substring("o_orderpriority", 1, 1).alias("g"))
    return patches.neighbour_filled(df, "o_custkey", "o_orderkey", "v", "g").select("o_custkey", "o_orderkey", "filled")


@query("""
WITH r AS (SELECT o_custkey AS o, o_orderkey AS n, (o_orderkey + o_custkey) % 3 = 0 AS gone, CASE WHEN o_orderkey % 2 = 1 THEN o_orderkey * 10 END AS b, CASE WHEN o_orderkey % 2 = 0 THEN o_orderkey * 10 + 5 END AS e FROM orders),
     k AS (SELECT *, coalesce(lag(n) OVER (PARTITION BY o ORDER BY n), -1) AS before, coalesce(lead(n) OVER (PARTITION BY o ORDER BY n), 1000000000) AS after FROM r WHERE NOT gone),
     x AS (SELECT k.o, k.n, k.b, k.e, max(CASE WHEN r.n < k.n THEN r.b END) AS cb, max(CASE WHEN r.n > k.n THEN r.e END) AS ce FROM k LEFT JOIN r ON r.o = k.o AND r.gone AND r.n > k.before AND r.n < k.after GROUP BY 1, 2, 3, 4)
SELECT o AS o_custkey, n AS o_orderkey, coalesce(b, cb) AS begin_out, coalesce(e, ce) AS end_out, coalesce(b <> cb, false) AS begin_conflict, coalesce(e <> ce, false) AS end_conflict FROM x
""")
def align_transfer(spark: SparkSession, sf_dir: str) -> DataFrame:
    k = F.col("o_orderkey")
    df = table(spark, sf_dir, "orders").select("o_custkey", "o_orderkey", F.when((k + F.col("o_custkey")) % 3 == 0, "dropped").otherwise("kept").alias("change"), F.when(k % 2 == 1, k * 10).alias("begin"), F.when(k % 2 == 0, k * 10 + 5).alias("end"))
    return patches.times_moved(df, "o_custkey", "o_orderkey").select("o_custkey", "o_orderkey", "begin_out", "end_out", "begin_conflict", "end_conflict")


@query("""
WITH d AS (SELECT l_orderkey, CASE WHEN l_partkey % 5 = 0 THEN 'dropped' WHEN l_partkey % 5 = 1 THEN 'added' WHEN l_partkey % 50 = 2 THEN 'changed' ELSE 'kept' END AS change FROM lineitem)
SELECT l_orderkey, CASE WHEN bool_or(change = 'dropped') THEN '❌' ELSE '⚠️' END AS icon, count(*) FILTER (WHERE change = 'kept') AS kept, count(*) FILTER (WHERE change = 'changed') AS changed, count(*) FILTER (WHERE change = 'dropped') AS dropped, count(*) FILTER (WHERE change = 'added') AS added
FROM d GROUP BY 1 HAVING bool_or(change <> 'kept')
""")
def recap(spark: SparkSession, sf_dir: str) -> DataFrame:
    p = F.col("l_partkey")
    df = table(spark, sf_dir, "lineitem").select("l_orderkey", "l_linenumber", F.when(p % 5 == 0, "dropped").when(p % 5 == 1, "added").when(p % 50 == 2, "changed").otherwise("kept").alias("change"))
    return patches.recap(df, "l_linenumber", "l_orderkey").drop("first")


@query("""
WITH d AS (SELECT l_suppkey % 50 AS file, l_orderkey * 100 + row_number() OVER (PARTITION BY l_orderkey ORDER BY l_linenumber, l_partkey, l_suppkey, l_extendedprice) AS line, l_orderkey % 3 AS unit,
                  CASE WHEN l_partkey % 5 = 0 THEN 'dropped' WHEN l_partkey % 5 = 1 THEN 'added' WHEN l_partkey % 50 = 2 THEN 'changed' ELSE 'kept' END AS change FROM lineitem),
     m AS (SELECT *, lag(unit) OVER (PARTITION BY file ORDER BY line) AS before FROM d WHERE change <> 'kept'),
     o AS (SELECT *, count(*) FILTER (WHERE before IS NULL OR before <> unit) OVER (PARTITION BY file ORDER BY line) AS run FROM m),
     r AS (SELECT d.*, coalesce(o.run, last_value(o.run IGNORE NULLS) OVER (PARTITION BY d.file ORDER BY d.line ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW), 0) AS run FROM d LEFT JOIN o USING (file, line))
SELECT file, unit, run, CASE WHEN bool_or(change = 'dropped') THEN '❌' ELSE '⚠️' END AS icon, count(*) FILTER (WHERE change = 'kept') AS kept, count(*) FILTER (WHERE change = 'changed') AS changed, count(*) FILTER (WHERE change = 'dropped') AS dropped, count(*) FILTER (WHERE change = 'added') AS added
FROM r GROUP BY 1, 2, 3 HAVING bool_or(change <> 'kept')
""")
def recap_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Consecutive changes of a unit, file by file: a unit that comes again later has a run of its own."""
    p = F.col("l_partkey")
    place = F.row_number().over(Window.partitionBy("l_orderkey").orderBy("l_linenumber", "l_partkey", "l_suppkey", "l_extendedprice"))
    change = F.when(p % 5 == 0, "dropped").when(p % 5 == 1, "added").when(p % 50 == 2, "changed").otherwise("kept")
    raw = table(spark, sf_dir, "lineitem")
    n = tasks(raw)
    low, high = raw.agg(F.coalesce(F.min("l_orderkey"), F.lit(0)), F.coalesce(F.max("l_orderkey"), F.lit(0))).first()
    df = raw.repartition(n, "l_orderkey").select((F.col("l_suppkey") % 50).alias("file"), (F.col("l_orderkey") * 100 + place).alias("line"), (F.col("l_orderkey") % 3).alias("unit"), change.alias("change"))
    return patches.recap(df, "line", "unit", "file", n, (100 * low, 100 * (high + 1))).drop("first")


def lemma_table(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Order lines as an edited lemma table with faults of every kind."""
    n, k = F.col("l_linenumber"), F.col("l_orderkey")
    token = F.when(k % 97 == 0, "").when(k % 5 == 0, F.concat(k, F.lit("-"), n, F.when(k % 2 == 0, "A").otherwise("b"))).when(k % 5 == 1, F.concat(k, F.lit("-"), n, F.lit("-"), n + 1)).otherwise(F.concat(k, F.lit("-"), n))
    span = F.when(F.col("l_partkey") % 11 == 0, "(.)").when(F.col("l_partkey") % 11 == 1, "((ride))").otherwise("ciao")
    return table(spark, sf_dir, "lineitem").select(F.concat(F.lit("f"), k).alias("file"), token.alias("token_id"), span.alias("span"), F.when(F.col("l_suppkey") % 3 == 0, "_").when(F.col("l_suppkey") % 3 == 1, "[x]").otherwise("x").alias("lemma"), F.when(F.col("l_suppkey") % 4 == 0, "_").when(F.col("l_suppkey") % 4 == 1, "X").when(F.col("l_suppkey") % 4 == 2, "VERB").otherwise("V").alias("upos"))


@query(r"""
WITH r AS (SELECT 'f' || l_orderkey AS file, CASE WHEN l_orderkey % 97 = 0 THEN '' WHEN l_orderkey % 5 = 0 THEN l_orderkey || '-' || l_linenumber || CASE WHEN l_orderkey % 2 = 0 THEN 'A' ELSE 'b' END WHEN l_orderkey % 5 = 1 THEN l_orderkey || '-' || l_linenumber || '-' || (l_linenumber + 1) ELSE l_orderkey || '-' || l_linenumber END AS token_id,
                  CASE WHEN l_partkey % 11 = 0 THEN 'p' WHEN l_partkey % 11 = 1 THEN 'p' ELSE 'w' END AS kind, CASE WHEN l_suppkey % 3 = 0 THEN '_' WHEN l_suppkey % 3 = 1 THEN '[x]' ELSE 'x' END AS lemma, CASE WHEN l_suppkey % 4 = 0 THEN '_' WHEN l_suppkey % 4 = 1 THEN 'X' WHEN l_suppkey % 4 = 2 THEN 'VERB' ELSE 'V' END AS upos FROM lineitem),
     s AS (SELECT *, regexp_matches(token_id, '^\d+-\d+[A-Za-z]$') AS sub, regexp_matches(token_id, '^\d+-\d+-\d+$') AS whole FROM r)
SELECT file, token_id, 'error' AS severity, 'token_id is empty' AS "check" FROM s WHERE token_id = ''
UNION ALL SELECT file, token_id, 'error', 'sub-token suffix is upper case' FROM s WHERE sub AND regexp_matches(token_id, '[A-Z]$')
UNION ALL SELECT file, token_id, 'error', 'sub-token without parent' FROM s WHERE sub
UNION ALL SELECT file, token_id, 'error', 'unknown upos' FROM s WHERE token_id <> '' AND upos = 'V'
UNION ALL SELECT file, token_id, 'error', 'multi-word token with lemma or upos' FROM s WHERE whole AND NOT (lemma = '_' AND upos = '_')
UNION ALL SELECT file, token_id, 'error', 'pause or event without [lemma] and X' FROM s WHERE token_id <> '' AND NOT whole AND kind = 'p' AND NOT (lemma = '[x]' AND upos = 'X')
UNION ALL SELECT file, token_id, 'warning', 'lemma is missing' FROM s WHERE token_id <> '' AND NOT whole AND kind = 'w' AND lemma = '_'
UNION ALL SELECT file, token_id, 'warning', 'upos is missing' FROM s WHERE token_id <> '' AND NOT whole AND kind = 'w' AND upos = '_'
""")
def csv_validate(spark: SparkSession, sf_dir: str) -> DataFrame:
    return patches.checked(lemma_table(spark, sf_dir))


def texts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Benchmark items beside their words with some left out, doubled or changed."""
    words = F.split("text", r"\s+")
    other = F.filter(F.transform(words, lambda w, i: F.when(i % 7 == 3, F.lit("x")).otherwise(w)), lambda w: ~w.startswith("th"))
    return table(spark, sf_dir, "benchmark").select("item_id", words.alias("a"), other.alias("b"))


@query()
def nw_align(spark: SparkSession, sf_dir: str) -> DataFrame:
    return alignment.alignment_rows(texts(spark, sf_dir), ["item_id"])


@query()
def wer(spark: SparkSession, sf_dir: str) -> DataFrame:
    return alignment.error_rate(alignment.alignment_rows(texts(spark, sf_dir), ["item_id"]), ["item_id"])


@query("""
WITH t AS (SELECT conv_id, turn, row_number() OVER (PARTITION BY conv_id, role, text ORDER BY turn) AS k, role, text FROM conversations),
     u AS (SELECT conv_id, turn, row_number() OVER (PARTITION BY conv_id, role, text ORDER BY turn) AS k, role, text FROM conversations WHERE turn % 4 <> 1)
SELECT t.conv_id, t.turn, u.turn AS tu_id FROM t LEFT JOIN u ON u.conv_id = t.conv_id AND u.role = t.role AND u.text = t.text AND u.k = t.k
""")
def turn_unit_align_whole(spark: SparkSession, sf_dir: str) -> DataFrame:
    c = table(spark, sf_dir, "conversations").select("conv_id", "turn", F.col("role").alias("speaker"), "text")
    return alignment.turns_to_units(c, c.where("turn % 4 <> 1").withColumnRenamed("turn", "tu_id"), "conv_id")


@query("""
WITH RECURSIVE t AS (SELECT conv_id, turn, role, trim(text) AS text, row_number() OVER (PARTITION BY conv_id ORDER BY turn) AS k FROM conversations),
     u AS (SELECT conv_id, turn AS tu_id, role, text, row_number() OVER (PARTITION BY conv_id ORDER BY turn) - 1 AS p FROM conversations WHERE turn % 4 <> 1 AND text <> ''),
     c AS (SELECT DISTINCT conv_id, CAST(0 AS BIGINT) AS k, CAST(0 AS BIGINT) AS pos, CAST(NULL AS BIGINT) AS turn, CAST(NULL AS BIGINT) AS place FROM t
           UNION ALL
           SELECT conv_id, k, coalesce(place + 1, pos) AS pos, turn, place
           FROM (SELECT c.conv_id, t.k, c.pos, t.turn, coalesce(min(CASE WHEN u.p >= c.pos THEN u.p END), min(CASE WHEN u.p >= c.pos - 3 THEN u.p END)) AS place
                 FROM c JOIN t ON t.conv_id = c.conv_id AND t.k = c.k + 1 LEFT JOIN u ON u.conv_id = t.conv_id AND u.role = t.role AND u.text = t.text
                 GROUP BY c.conv_id, t.k, c.pos, t.turn) n)
SELECT c.conv_id, c.turn, u.tu_id FROM c LEFT JOIN u ON u.conv_id = c.conv_id AND u.p = c.place WHERE c.k > 0
""")
def turn_unit_cursor(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Turns and the units that a pass through both in order finds for them."""
    c = table(spark, sf_dir, "conversations").select("conv_id", "turn", F.col("role").alias("speaker"), "text")
    return alignment.turns_by_cursor(c, c.where("turn % 4 <> 1").withColumnRenamed("turn", "tu_id"), "conv_id")


@query("""
WITH r AS (SELECT conv_id, turn, CASE WHEN turn % 3 = 1 THEN 'u' || conv_id || '-' || (turn * 2) END AS kid FROM conversations),
     f AS (SELECT *, max(CASE WHEN kid IS NOT NULL THEN turn END) OVER (PARTITION BY conv_id ORDER BY turn) AS last_turn FROM r)
SELECT conv_id, turn, CASE WHEN last_turn IS NULL THEN NULL ELSE 'u' || conv_id || '-' || (last_turn * 2 + turn - last_turn) END AS kid FROM f
""")
def kid_fill(spark: SparkSession, sf_dir: str) -> DataFrame:
    c = table(spark, sf_dir, "conversations").select("conv_id", "turn", F.when(F.col("turn") % 3 == 1, F.concat(F.lit("u"), "conv_id", F.lit("-"), F.col("turn") * 2)).alias("kid"))
    return alignment.kids(c, ["conv_id"], "turn")


@query(r"""
WITH r AS (SELECT 'f' || (l_suppkey % 10) AS file, l_orderkey || '-' || (l_linenumber // 2) || CASE l_linenumber % 3 WHEN 0 THEN '' WHEN 1 THEN 'a' ELSE 'b' END AS token_id, l_returnflag AS form FROM lineitem),
     s AS (SELECT *, regexp_replace(token_id, '[a-z]$', '') AS parent FROM r WHERE regexp_matches(token_id, '[a-z]$'))
SELECT file, parent AS token_id, string_agg(form, '' ORDER BY token_id, form) AS form FROM s WHERE NOT EXISTS (SELECT 1 FROM r WHERE r.file = s.file AND r.token_id = s.parent) GROUP BY file, parent
""")
def orphan_parents(spark: SparkSession, sf_dir: str) -> DataFrame:
    n = F.col("l_linenumber")
    df = table(spark, sf_dir, "lineitem").select(F.concat(F.lit("f"), F.col("l_suppkey") % 10).alias("file"), F.concat("l_orderkey", F.lit("-"), F.floor(n / 2), F.when(n % 3 == 0, "").when(n % 3 == 1, "a").otherwise("b")).alias("token_id"), F.col("l_returnflag").alias("form"))
    return alignment.orphan_parents(df, "file")


def summaries(spark: SparkSession, sf_dir: str) -> DataFrame:
    o = table(spark, sf_dir, "orders").where("o_custkey % 4 <> 0")
    return o.groupBy(F.col("o_custkey").alias("code")).agg(F.count("*").alias("units"), F.count_if(F.col("o_orderpriority").startswith("1")).alias("errors"), F.count_if(F.col("o_orderpriority").startswith("2")).alias("warnings"), F.sum(F.floor("o_totalprice")).alias("tokens"))


REPORT = """
(WITH s AS (SELECT o_custkey AS code, count(*) AS units, count(*) FILTER (WHERE o_orderpriority LIKE '1%') AS errors, count(*) FILTER (WHERE o_orderpriority LIKE '2%') AS warnings, sum(CAST(floor(o_totalprice) AS BIGINT)) AS tokens FROM orders WHERE o_custkey % 4 <> 0 GROUP BY 1)
SELECT c_custkey AS code, CASE WHEN s.code IS NULL THEN 0 WHEN errors > 0 THEN 1 WHEN warnings > 0 THEN 2 WHEN units = 0 THEN 3 ELSE 4 END AS severity, CAST(coalesce(errors, 0) AS BIGINT) AS errors, CAST(coalesce(warnings, 0) AS BIGINT) AS warnings, CAST(coalesce(tokens, 0) AS BIGINT) AS tokens
FROM customer LEFT JOIN s ON s.code = c_custkey)
"""


@query(f"SELECT * FROM {REPORT} r")
def issue_report(spark: SparkSession, sf_dir: str) -> DataFrame:
    return reports.report(table(spark, sf_dir, "customer").select(F.col("c_custkey").alias("code")), summaries(spark, sf_dir))


@query(f"SELECT code % 7 AS module, count(*) AS conversations, count(*) FILTER (WHERE severity <= 2) AS with_issues, CAST(sum(errors) AS BIGINT) AS errors, CAST(sum(warnings) AS BIGINT) AS warnings FROM {REPORT} r GROUP BY 1")
def report_overview(spark: SparkSession, sf_dir: str) -> DataFrame:
    return reports.overview(issue_report(spark, sf_dir).withColumn("module", F.col("code") % 7))


@query(f"SELECT code, severity FROM (SELECT *, row_number() OVER (ORDER BY severity, code) AS n FROM {REPORT} r WHERE severity = 0 OR errors > 0 OR code % 50 = 0) x WHERE n <= 500")
def issue_page(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The first rows of an issues page, which the page limits."""
    rows = reports.actionable(issue_report(spark, sf_dir).withColumn("metadata_issues", F.when(F.col("code") % 50 == 0, 1).otherwise(0)))
    return reports.page(rows, [F.col("severity"), F.col("code")]).select("code", "severity")


@query("SELECT o_custkey AS code, string_agg(p || ':' || n, ' ' ORDER BY p) AS text FROM (SELECT o_custkey, substr(o_orderpriority, 1, 1) AS p, count(*) AS n FROM orders GROUP BY 1, 2) x GROUP BY 1")
def counts_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    rules = table(spark, sf_dir, "orders").groupBy(F.col("o_custkey").alias("code"), F.substring("o_orderpriority", 1, 1).alias("rule")).agg(F.count("*").alias("n"))
    return reports.counts_text(rules)


@query("""
SELECT c_custkey AS code, 'missing' AS kind, 'no transcript' AS detail FROM customer WHERE c_custkey NOT IN (SELECT o_custkey FROM orders)
UNION ALL SELECT o_custkey, 'metadata', o_orderpriority FROM orders WHERE o_orderkey % 10 = 0
UNION ALL SELECT o_custkey, 'unit', o_orderstatus FROM orders WHERE o_orderkey % 10 = 1
UNION ALL SELECT o_custkey, 'token', CAST(o_orderkey AS VARCHAR) FROM orders WHERE o_orderkey % 10 = 2
""")
def issue_records(spark: SparkSession, sf_dir: str) -> DataFrame:
    o = table(spark, sf_dir, "orders").withColumn("code", F.col("o_custkey"))
    part = lambda k, c, n: o.where(f"o_orderkey % 10 = {k}").select("code", F.col(c).alias(n))
    return reports.issues(table(spark, sf_dir, "customer").select(F.col("c_custkey").alias("code")), o.select("code").distinct(), part(0, "o_orderpriority", "problem"), part(1, "o_orderstatus", "rule"), part(2, "o_orderkey", "form"))


@query("SELECT o_custkey AS transcript, o_orderkey AS v FROM orders WHERE o_custkey % 3 <> 0 UNION ALL SELECT c_custkey, -1 FROM customer WHERE c_custkey % 3 = 0")
def summary_upsert(spark: SparkSession, sf_dir: str) -> DataFrame:
    old = table(spark, sf_dir, "orders").select(F.col("o_custkey").alias("transcript"), F.col("o_orderkey").alias("v"))
    return reports.upserted(old, table(spark, sf_dir, "customer").where("c_custkey % 3 = 0").select(F.col("c_custkey").alias("transcript"), F.lit(-1).cast("long").alias("v")))


@query("""
SELECT o_orderkey, CASE WHEN h > 0 THEN printf('%d:%02d:%02d', h, m, s) ELSE printf('%d:%02d', m, s) END AS clock, 'PT' || CASE WHEN h > 0 THEN h || 'H' ELSE '' END || m || 'M' || s || 'S' AS iso
FROM (SELECT o_orderkey, (o_orderkey * 37 % 9000) // 3600 AS h, (o_orderkey * 37 % 9000) % 3600 // 60 AS m, (o_orderkey * 37 % 9000) % 60 AS s FROM orders) x
""")
def clocks(spark: SparkSession, sf_dir: str) -> DataFrame:
    t = F.col("o_orderkey") * 37 % 9000
    hms = F.format_string("%02d:%02d:%02d", F.floor(t / 3600), F.floor(t % 3600 / 60), t % 60)
    return table(spark, sf_dir, "orders").select("o_orderkey", X.clock(t * 1000 + 999).alias("clock"), X.iso_duration(hms).alias("iso"))


@query("""
SELECT l_orderkey, l_linenumber, 'A=' || l_returnflag || '|B=' || l_linenumber || '|C' AS again, l_returnflag AS a FROM lineitem
""")
def feature_fields(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Features parsed and written again."""
    text = F.concat(F.lit("A="), "l_returnflag", F.lit("|B="), "l_linenumber", F.lit("|C"))
    return table(spark, sf_dir, "lineitem").select("l_orderkey", "l_linenumber", X.format_feats(X.feats(text)).alias("again"), X.feat(text, "A").alias("a"))


@query("SELECT n_nationkey, array_to_string(list_distinct_ordered, ',') AS many FROM (SELECT n_nationkey, [n_name, 'x'] AS list_distinct_ordered FROM nation) t")
def multivalues(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "nation").select("n_nationkey", X.multivalue(F.concat("n_name", F.lit("; x ;; "), "n_name", F.lit(";x"))).alias("many"))

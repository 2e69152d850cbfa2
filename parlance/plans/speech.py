"""Queries of tokens, spans, overlapping speech and text formats."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from parlance.functions import fields as X
from parlance.functions.matches import spans
from parlance.operators import formats, overlaps, tokens
from parlance.operators.units import total_length as length_of
from parlance.plans.process import process
from parlance.plans.registry import query, table, timed

K = ["transcript_id", "tu_id"]

#: Tokens as DuckDB computes them.
TOKENS_SQL = r"""
(WITH t AS (SELECT transcript_id, tu_id, speaker, start_ms, end_ms, replace(text, chr(10), ' ') AS text FROM {units} u),
 p AS (SELECT t.*, unnest(string_split_regex(text, '[ =]')) AS piece, generate_subscripts(string_split_regex(text, '[ =]'), 1) AS pos FROM t),
 m AS (SELECT *, (regexp_extract_all(text, '[ =]'))[pos] AS mark, strpos(piece, '''') AS q FROM p),
 e AS (SELECT *, CASE WHEN q > 0 AND regexp_matches(substr(piece, 1, q), '\p{L}') AND regexp_matches(substr(piece, q + 1), '\p{L}') THEN [substr(piece, 1, q), substr(piece, q + 1)] ELSE [piece] END AS parts FROM m),
 x AS (SELECT *, unnest(parts) AS span, generate_subscripts(parts, 1) AS part FROM e),
 y AS (SELECT *, part = len(parts) AS space_after, part = len(parts) AND coalesce(mark, '') = '=' AS link,
              length(span) + CASE WHEN part = len(parts) AND mark IS NOT NULL THEN 1 ELSE 0 END AS width, regexp_replace(span, '[\[\]()<>°]', '', 'g') AS bare FROM x),
 z AS (SELECT transcript_id, tu_id, speaker, start_ms, end_ms, text, span, bare, space_after, link,
              row_number() OVER w - 1 AS idx, CAST(coalesce(sum(width) OVER (w ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS BIGINT) AS s,
              count(*) OVER (PARTITION BY transcript_id, tu_id) AS n_tokens FROM y WINDOW w AS (PARTITION BY transcript_id, tu_id ORDER BY pos, part)),
 c AS (SELECT *, s + length(span) AS e,
              CASE WHEN span = '(.)' THEN 'shortpause' WHEN starts_with(span, '((') AND ends_with(span, '))') THEN 'nonverbalbehavior' WHEN trim(bare) = '' THEN 'error' WHEN starts_with(bare, '@') THEN 'anonymized'
                   WHEN bare = '{P}' THEN 'shortpause' WHEN starts_with(bare, '{') THEN 'nonverbalbehavior' WHEN regexp_full_match(bare, 'x+') THEN 'unknown'
                   WHEN regexp_full_match(bare, 'po'':*[.,?]?') OR regexp_full_match(bare, '[''~-]?\p{L}[\p{L}:]*(-\p{L}[\p{L}:]*)*[-''~]?[.,?]?') THEN 'linguistic' ELSE 'error' END AS type FROM z),
 f AS (SELECT *, type IN ('linguistic', 'anonymized') AS has, CASE WHEN span = '(.)' OR (starts_with(span, '((') AND ends_with(span, '))')) THEN span WHEN trim(bare) = '' THEN '' WHEN regexp_full_match(bare, 'po'':*[.,?]?') THEN regexp_replace(bare, '''(:*)', '\1''', 'g') ELSE bare END AS form0 FROM c),
 g AS (SELECT *, CASE WHEN has AND ends_with(form0, '.') THEN 'Falling' WHEN has AND ends_with(form0, ',') THEN 'WeaklyRising' WHEN has AND ends_with(form0, '?') THEN 'Rising' END AS intonation FROM f),
 h AS (SELECT *, CASE WHEN intonation IS NOT NULL THEN substr(form0, 1, length(form0) - 1) ELSE form0 END AS form1 FROM g)
 SELECT transcript_id, tu_id, speaker, start_ms, end_ms, text, idx, span, s, e, n_tokens, link, space_after, type, intonation,
        has AND regexp_matches(form1, '^[~-]|[~-]$') AS interrupted, has AND regexp_matches(form1, '^''|''$') AND regexp_replace(form1, '[^\p{L}]', '', 'g') <> 'po' AND space_after AS truncated,
        CASE WHEN (has OR type = 'unknown') AND regexp_matches(form1, '\p{Lu}') THEN 'high' END AS volume,
        CASE WHEN has THEN replace(lower(form1), ':', '') WHEN type = 'unknown' THEN lower(form1) ELSE form1 END AS form, CASE WHEN type = 'unknown' THEN length(bare) END AS syllables,
        CASE WHEN has AND regexp_matches(lower(form1), '^.*[^:''~-].*:') THEN 1 ELSE 0 END AS prolonged,
        coalesce(lead(type) OVER (PARTITION BY transcript_id, tu_id ORDER BY idx) = 'shortpause', false) AS pause_after FROM h)
"""


def tok(sql: str) -> str:
    return sql.replace("{tokens}", TOKENS_SQL)


def spoken(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The units without normalisation, line ends aside."""
    return timed(spark, sf_dir).withColumns({"text": F.replace(F.col("text"), F.lit("\n"), F.lit(" ")), "variation": F.lit("none"), "include": F.lit(True)})


def toks(spark: SparkSession, sf_dir: str) -> DataFrame:
    return tokens.tokenize(spoken(spark, sf_dir))


#: Fixed value: characters of text whose tokens one task sorts.
CHARACTERS = 1_000_000


def dealt(units: DataFrame, characters: int) -> DataFrame:
    """Units dealt by their keys to as many tasks as their text asks for. What is made of their tokens by unit needs no other shuffle, and no task more memory when there are more units: tokens are many times the bytes by which the planner puts partitions together."""
    return units.repartition(max(units.sparkSession.sparkContext.defaultParallelism, -(-characters // CHARACTERS)), *K)


def verts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A token table of tokens without spans; line orders a unit's rows."""
    characters = table(spark, sf_dir, "conversations").agg(F.coalesce(F.sum(F.length("text")), F.lit(0))).first()[0]
    df = tokens.tokenize(dealt(spoken(spark, sf_dir), characters)).withColumns({c: F.lit(None).cast("string") for c in ("slow", "fast", "guesses", "overlaps")} | {"reduced": F.lit(False)})
    # the unit's own column stays, by which its rows are dealt
    return formats.vert(df.withColumn("__unit", F.col("tu_id")), keep=["__unit"]).withColumns({"line": F.col("id").cast("int"), "tu_id": F.col("__unit")}).drop("__unit")


def long(df: DataFrame, *names: str) -> DataFrame:
    return df.withColumns({n: F.col(n).cast("long") for n in names})


@query(tok("SELECT transcript_id, tu_id, CAST(idx AS BIGINT) AS idx, span, CAST(s AS BIGINT) AS s, CAST(e AS BIGINT) AS e, link, space_after, CAST(n_tokens AS BIGINT) AS n_tokens FROM {tokens} k"))
def tokenize(spark: SparkSession, sf_dir: str) -> DataFrame:
    df = tokens.split_tokens(spoken(spark, sf_dir))
    return long(df.select(*K, "idx", "span", "s", "e", "link", "space_after", "n_tokens"), "idx", "s", "e", "n_tokens")


@query(tok("SELECT transcript_id, tu_id, CAST(idx AS BIGINT) AS idx, type, form, CAST(syllables AS BIGINT) AS syllables FROM {tokens} k"))
def token_classify(spark: SparkSession, sf_dir: str) -> DataFrame:
    return long(toks(spark, sf_dir).select(*K, "idx", "type", "form", "syllables"), "idx", "syllables")


@query(tok("SELECT transcript_id, tu_id, CAST(idx AS BIGINT) AS idx, intonation, interrupted, truncated, volume, pause_after FROM {tokens} k"))
def token_features(spark: SparkSession, sf_dir: str) -> DataFrame:
    return long(toks(spark, sf_dir).select(*K, "idx", "intonation", "interrupted", "truncated", "volume", "pause_after"), "idx")


@query(tok("SELECT transcript_id, tu_id, CAST(count(*) AS BIGINT) AS tokens, CAST(sum(prolonged) AS BIGINT) AS prolonged FROM {tokens} k GROUP BY 1, 2"))
def token_prolongations(spark: SparkSession, sf_dir: str) -> DataFrame:
    return toks(spark, sf_dir).groupBy(*K).agg(F.count("*").alias("tokens"), F.count_if(F.size("prolongations") > 0).alias("prolonged"))


@query(tok("SELECT speaker, type, CAST(count(*) AS BIGINT) AS tokens, CAST(count(DISTINCT form) AS BIGINT) AS forms, CAST(sum(length(form)) AS BIGINT) AS chars FROM {tokens} k GROUP BY 1, 2"))
def token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Tokens of every speaker by kind."""
    return toks(spark, sf_dir).groupBy("speaker", "type").agg(F.count("*").alias("tokens"), F.countDistinct("form").alias("forms"), F.sum(F.length("form")).alias("chars"))


@query(r"SELECT transcript_id, tu_id, CAST(len(regexp_extract_all(text, '\[[^\]]+\]')) AS BIGINT) AS n, array_to_string(regexp_extract_all(text, '\[[^\]]+\]'), '|') AS texts, array_to_string(regexp_extract_all(text, '°[^°]+°'), '|') AS low FROM {units} u")
def spans_extracted(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Offsets, held against the text by cutting it there."""
    df = timed(spark, sf_dir).withColumns({"a": spans(F.col("text"), r"\[[^\]]+\]"), "b": spans(F.col("text"), "°[^°]+°")})
    cut = lambda c: F.array_join(F.transform(c, lambda x: F.substring("text", x["s"] + 1, x["e"] - x["s"])), "|")
    return df.select(*K, F.size("a").cast("long").alias("n"), cut("a").alias("texts"), cut("b").alias("low"))


MAP_SQL = r"""
WITH k AS (SELECT * FROM {tokens} k0), t AS (SELECT DISTINCT transcript_id, tu_id, text, regexp_extract_all(text, '\[[^\]]+\]') AS ms, string_split_regex(text, '\[[^\]]+\]') AS gaps FROM k),
     i AS (SELECT *, unnest(range(1, len(ms) + 1)) AS j FROM t),
     x AS (SELECT transcript_id, tu_id, j - 1 AS span_id, CAST(list_sum(list_transform(gaps[1:j], lambda g: length(g))) + coalesce(list_sum(list_transform(ms[1:j - 1], lambda g: length(g))), 0) AS BIGINT) AS xs, length(ms[j]) AS w FROM i),
     h AS (SELECT k.transcript_id, k.tu_id, k.idx, x.span_id, length(regexp_replace(substr(k.span, 1, greatest(xs - s, 0)), '[:.,?\[\]()<>°]', '', 'g')) AS cs,
                  length(regexp_replace(substr(k.span, 1, least(xs + w - s, length(k.span))), '[:.,?\[\]()<>°]', '', 'g')) AS ce
           FROM k JOIN x ON k.transcript_id = x.transcript_id AND k.tu_id = x.tu_id AND xs < e AND xs + w > s)
SELECT transcript_id, tu_id, CAST(idx AS BIGINT) AS idx, CAST(span_id AS BIGINT) AS span_id, CAST(cs AS BIGINT) AS cs, CAST(ce AS BIGINT) AS ce FROM h WHERE ce > cs
"""


@query(tok(MAP_SQL))
def span_token_map(spark: SparkSession, sf_dir: str) -> DataFrame:
    none = F.array().cast("array<struct<s:int,e:int>>")
    own = spoken(spark, sf_dir).withColumns({c: none for c in ("slow", "fast", "low", "guess_spans", "reduction_spans")} | {"overlap_spans": spans(F.col("text"), r"\[[^\]]+\]")})
    return long(tokens.touched(tokens.tokenize(own), own).select(*K, "idx", "span_id", "cs", "ce"), "idx", "span_id", "cs", "ce")


FEATS = "nullif(concat_ws('|', 'Intonation=' || intonation, CASE WHEN interrupted THEN 'Interrupted=Yes' END, CASE WHEN truncated THEN 'Truncated=Yes' END, CASE WHEN link THEN 'ProsodicLink=Yes' END, CASE WHEN NOT space_after THEN 'SpaceAfter=No' END, CASE WHEN pause_after THEN 'PauseAfter=Yes' END, 'Volume=' || volume, 'Syllables=' || syllables), '')"


@query(tok(f"""
SELECT transcript_id, tu_id || '-' || idx AS token_id, coalesce({FEATS}, '_') AS jefferson_feats,
       coalesce(nullif(concat_ws('|', CASE WHEN idx = 0 THEN 'Begin=' || start_ms END, CASE WHEN idx = n_tokens - 1 THEN 'End=' || end_ms END), ''), '_') AS align FROM {{tokens}} k
"""))
def vert_projection(spark: SparkSession, sf_dir: str) -> DataFrame:
    return verts(spark, sf_dir).select("transcript_id", "token_id", "jefferson_feats", "align")


LINEAR_SQL = r"""
SELECT transcript_id, tu_id, nullif(regexp_replace(trim(string_agg(CASE WHEN type IN ('nonverbalbehavior', 'shortpause', 'unknown', 'linguistic', 'error') THEN span ELSE '' END || CASE WHEN link THEN '=' WHEN NOT space_after THEN '' ELSE ' ' END, '' ORDER BY idx)), ' +', ' ', 'g'), '') AS jefferson,
       nullif(regexp_replace(trim(string_agg(CASE type WHEN 'unknown' THEN regexp_replace(span, '[^x]', '', 'g') WHEN 'linguistic' THEN form WHEN 'error' THEN regexp_replace(form, '[^\p{L}]', '', 'g') ELSE '' END || CASE WHEN link THEN ' ' WHEN NOT space_after THEN '' ELSE ' ' END, '' ORDER BY idx)), ' +', ' ', 'g'), '') AS orthographic
FROM {tokens} k GROUP BY 1, 2
"""


@query(tok(LINEAR_SQL))
def linear_texts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return formats.linear(verts(spark, sf_dir), K).select(*K, "jefferson", "orthographic")


@query("SELECT transcript_id, tu_id, speaker, CAST(start_ms AS DOUBLE) AS start, CAST(end_ms AS DOUBLE) AS end_time, replace(text, chr(10), ' ') AS text FROM {units} u")
def round_trip(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Units split into tokens and put together again are the units."""
    return formats.rebuilt(verts(spark, sf_dir), K).select(*K, "speaker", "start", F.col("end").alias("end_time"), "text")


@query("SELECT transcript_id, tu_id, CAST(start_ms * 1000 AS BIGINT) AS begin_ms, CAST(end_ms * 1000 AS BIGINT) AS end_ms FROM {units} u")
def unit_times(spark: SparkSession, sf_dir: str) -> DataFrame:
    return formats.unit_times(verts(spark, sf_dir), K)


@query("SELECT transcript_id, seconds, 'T' || (row_number() OVER (PARTITION BY transcript_id ORDER BY seconds) - 1) AS name FROM (SELECT transcript_id, CAST(start_ms AS DOUBLE) AS seconds FROM {units} u UNION SELECT transcript_id, CAST(end_ms AS DOUBLE) FROM {units} v) q")
def timeline(spark: SparkSession, sf_dir: str) -> DataFrame:
    return formats.timeline(verts(spark, sf_dir)).withColumnRenamed("at", "seconds")


@query("""
WITH c AS (SELECT *, CASE WHEN turn % 3 = 2 THEN '_' ELSE role END AS value FROM conversations),
     f AS (SELECT *, coalesce(last_value(nullif(value, '_') IGNORE NULLS) OVER (PARTITION BY conv_id ORDER BY turn ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW), '0') AS v FROM c),
     g AS (SELECT *, CASE WHEN v IS DISTINCT FROM lag(v) OVER (PARTITION BY conv_id ORDER BY turn) THEN 1 ELSE 0 END AS ch FROM f)
SELECT conv_id, turn, CAST(sum(ch) OVER (PARTITION BY conv_id ORDER BY turn) AS BIGINT) AS run FROM g
""")
def islands(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Runs of consecutive rows of one unit; `_` goes on with the run before."""
    df = spark.read.parquet(f"{sf_dir}/conversations.parquet").withColumn("value", F.when(F.col("turn") % 3 == 2, "_").otherwise(F.col("role")))
    return formats.islands(df, ["conv_id"], "value", "turn").select("conv_id", "turn", F.col("group").alias("run"))


@query("""
SELECT a.transcript_id, a.tu_id AS u, b.tu_id AS v, greatest(a.start_ms, b.start_ms) AS start_ms, least(a.end_ms, b.end_ms) AS end_ms
FROM {units} a JOIN {units} b ON a.transcript_id = b.transcript_id AND a.tu_id < b.tu_id AND a.end_ms > b.start_ms AND b.end_ms > a.start_ms
""")
def overlap_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return overlaps.overlap_join(timed(spark, sf_dir), 5000).select("transcript_id", "u", "v", F.col("start").alias("start_ms"), F.col("end").alias("end_ms"))


EVENTS_SQL = "(SELECT user_id, event_id, epoch_us(ts) // 1000 AS s, epoch_us(ts) // 1000 + CAST(floor(abs(value) * 100000) AS BIGINT) + 1 AS e FROM events)"


def event_units(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events as intervals of a user."""
    s = F.floor(F.unix_micros(F.col("ts").cast("timestamp")) / 1000)
    return spark.read.parquet(f"{sf_dir}/events.parquet").select(F.col("user_id").alias("transcript_id"), F.col("event_id").alias("tu_id"), s.alias("start"), (s + F.floor(F.abs("value") * 100000) + 1).alias("end"))


@query(f"SELECT a.user_id AS transcript_id, a.event_id AS u, b.event_id AS v, least(a.e, b.e) - greatest(a.s, b.s) AS duration FROM {EVENTS_SQL} a JOIN {EVENTS_SQL} b ON a.user_id = b.user_id AND a.event_id < b.event_id AND a.e > b.s AND b.e > a.s")
def overlap_join_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Many short intervals over a long time: dealt by time slots too."""
    return overlaps.overlap_join(event_units(spark, sf_dir), 3_600_000).select("transcript_id", "u", "v", "duration")


EDGES = "(SELECT a.transcript_id, a.tu_id AS u, b.tu_id AS v, least(a.end_ms, b.end_ms) - greatest(a.start_ms, b.start_ms) AS d FROM {units} a JOIN {units} b ON a.transcript_id = b.transcript_id AND a.tu_id < b.tu_id AND a.end_ms > b.start_ms AND b.end_ms > a.start_ms)"


@query(f"SELECT transcript_id, u, v, d AS duration FROM {EDGES} e WHERE u % 4 <> 1 AND v % 4 <> 1 AND NOT (u = 2 AND v = 3)")
def overlap_prune(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Without units of events alone (here every fourth), and without pairs that are named."""
    own = timed(spark, sf_dir)
    edges = overlaps.without_units(overlaps.overlap_join(own), own.where("tu_id % 4 = 1"))
    named = overlaps.ignored_pairs(own.select("transcript_id").distinct().withColumn("ids", F.lit("3 2")))
    return overlaps.without_pairs(edges, named).select("transcript_id", "u", "v", "duration")


@query(f"""
WITH e AS (SELECT * FROM {EDGES} e0 WHERE d < 600 AND u % 3 <> 0 AND v % 3 <> 0),
     m AS (SELECT transcript_id, tu_id, sum(off) AS off, sum(o) AS o, count(*) AS moved FROM (SELECT transcript_id, u AS tu_id, d / 2.0 AS off, 0.0 AS o FROM e UNION ALL SELECT transcript_id, v, 0.0, d / 2.0 FROM e) x GROUP BY 1, 2)
SELECT u.transcript_id, u.tu_id, CAST(u.start_ms + coalesce(m.o, 0) AS DOUBLE) AS start_time, CAST(u.end_ms - coalesce(m.off, 0) AS DOUBLE) AS end_time, CAST(coalesce(m.moved, 0) AS BIGINT) AS moved
FROM {{units}} u LEFT JOIN m ON m.transcript_id = u.transcript_id AND m.tu_id = u.tu_id
""")
def overlap_nudge(spark: SparkSession, sf_dir: str) -> DataFrame:
    own = timed(spark, sf_dir).withColumn("n_spans", F.when(F.col("tu_id") % 3 == 0, 1).otherwise(0))
    short = overlaps.short_edges(overlaps.overlap_join(own), own, 600)
    return overlaps.nudged(own, short).select(*K, F.col("start").cast("double").alias("start_time"), F.col("end").cast("double").alias("end_time"), "moved")


#: Sets of units active at a start, those that no other set holds.
CLIQUES = """
(WITH s AS (SELECT DISTINCT user_id, s AS t0 FROM {ev} q), a AS (SELECT s.user_id, s.t0, list_sort(list(e.event_id)) AS members FROM s JOIN {ev} e ON e.user_id = s.user_id AND e.s <= s.t0 AND e.e > s.t0 GROUP BY 1, 2)
 SELECT DISTINCT a.user_id, a.members FROM a WHERE len(a.members) > 1 AND NOT EXISTS (SELECT 1 FROM a b WHERE b.user_id = a.user_id AND len(b.members) > len(a.members) AND list_has_all(b.members, a.members)))
""".replace("{ev}", EVENTS_SQL)


@query(f"SELECT user_id AS transcript_id, array_to_string(members, ' ') AS members FROM {CLIQUES} c")
def overlap_cliques(spark: SparkSession, sf_dir: str) -> DataFrame:
    """By the sweep, which holds while no single edge was taken out."""
    return overlaps.interval_cliques(event_units(spark, sf_dir)).select("transcript_id", F.array_join(F.transform("members", lambda x: x.cast("string")), " ").alias("members"))


@query(f"SELECT user_id AS transcript_id, array_to_string(members, ' ') AS members FROM {CLIQUES} c")
def overlap_cliques_graph(spark: SparkSession, sf_dir: str) -> DataFrame:
    """By the graph, which holds always."""
    edges = overlaps.overlap_join(event_units(spark, sf_dir), 3_600_000)
    return overlaps.cliques(edges).select("transcript_id", F.array_join(F.transform("members", lambda x: x.cast("string")), " ").alias("members"))


@query(f"""
WITH c AS (SELECT user_id, members, unnest(members) AS tu_id FROM {CLIQUES} c0),
     e AS (SELECT c.user_id, c.members, max(x.s) AS os, min(x.e) AS oe, bool_or(x.event_id % 5 = 0) AS nvb FROM c JOIN {EVENTS_SQL} x ON x.event_id = c.tu_id AND x.user_id = c.user_id GROUP BY 1, 2),
     p AS (SELECT c.user_id, c.tu_id, count(*) AS m, count(*) FILTER (WHERE oe - os < 20000000 OR nvb) AS r FROM c JOIN e ON e.user_id = c.user_id AND e.members = c.members GROUP BY 1, 2),
     v AS (SELECT x.user_id AS transcript_id, x.event_id AS tu_id, x.event_id % 4 AS n, coalesce(p.m, 0) AS m, coalesce(p.r, 0) AS r FROM {EVENTS_SQL} x LEFT JOIN p ON p.user_id = x.user_id AND p.tu_id = x.event_id)
SELECT transcript_id, tu_id, CAST(n AS BIGINT) AS n_spans, CAST(m AS BIGINT) AS n_events, CAST(r AS BIGINT) AS n_removable,
       CASE WHEN n = m THEN 'matched' WHEN n = 0 THEN 'none' WHEN m > n AND r = m - n THEN 'trimmed' ELSE 'unknown' END AS outcome,
       CASE WHEN n <> m AND (n = 0 AND r >= m OR n > 0 AND m > n AND r = m - n) THEN 'MISMATCHING_OVERLAPS' END AS warning,
       CASE WHEN n = m THEN NULL WHEN n = 0 THEN CASE WHEN r < m THEN 'OVERLAPS:MISSING_ANNOTATION' END WHEN m = 0 THEN 'OVERLAPS:MISSING_TIME' WHEN m > n AND r = m - n THEN NULL ELSE 'MISMATCHING_OVERLAPS' END AS error
FROM v
""")
def overlap_match(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What becomes of a unit's annotated spans against its events."""
    own = event_units(spark, sf_dir).withColumns({"n_spans": F.col("tu_id") % 4, "any_nvb": F.col("tu_id") % 5 == 0})
    members = overlaps.events(overlaps.cliques(overlaps.overlap_join(own, 3_600_000)), own)
    return overlaps.judged(own, members, 20_000_000)


@query()
def overlap_matches(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Which event each annotated span stands for."""
    own = event_units(spark, sf_dir).withColumns({"n_spans": F.col("tu_id") % 4, "any_nvb": F.col("tu_id") % 5 == 0, "all_nvb": F.lit(False)})
    return overlaps.resolve(own, 20_000_000, width=3_600_000)["matches"]


@query(tok("""
SELECT k.transcript_id, k.speaker, CAST(count(DISTINCT k.tu_id) AS BIGINT) AS units, CAST(count(*) AS BIGINT) AS tokens, CAST(count(*) FILTER (WHERE type = 'linguistic') AS BIGINT) AS tokens_ling,
       CAST(count(*) FILTER (WHERE type = 'unknown') AS BIGINT) AS tokens_unk, CAST(count(*) FILTER (WHERE type = 'anonymized') AS BIGINT) AS tokens_anonym, CAST(count(*) FILTER (WHERE type = 'nonverbalbehavior') AS BIGINT) AS tokens_nvb,
       CAST(count(*) FILTER (WHERE type = 'shortpause') AS BIGINT) AS tokens_pause, CAST(count(*) FILTER (WHERE type = 'error') AS BIGINT) AS tokens_err, CAST(sum(CASE WHEN idx = 0 THEN end_ms - start_ms END) AS BIGINT) AS total_time
FROM {tokens} k GROUP BY 1, 2
"""))
def json_summary_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The counts of a transcript's summary."""
    own = spoken(spark, sf_dir).withColumn("duration", F.col("end") - F.col("start"))
    df = formats.speaker_summary(own, tokens.tokenize(own))
    return df.select("transcript_id", "speaker", F.col("TUs").alias("units"), "tokens", *[f"tokens_{k}" for k in formats.TYPES], F.col("time").cast("long").alias("total_time"))


@query("""
WITH u AS (SELECT * FROM {units} u0), w AS (SELECT *, max(end_ms) OVER (PARTITION BY transcript_id) AS whole, lag(speaker) OVER (PARTITION BY transcript_id ORDER BY tu_id) AS before FROM u),
     c AS (SELECT transcript_id, speaker, (row_number() OVER (PARTITION BY transcript_id ORDER BY min(tu_id)) - 1) % 10 AS colour FROM u GROUP BY 1, 2)
SELECT w.transcript_id, w.tu_id, CAST(c.colour AS BIGINT) AS colour, before IS NULL OR before <> w.speaker AS shown, printf('%.6f', start_ms / whole) AS left_share, printf('%.6f', (end_ms - start_ms) / whole) AS width
FROM w JOIN c ON c.transcript_id = w.transcript_id AND c.speaker = w.speaker
""")
def turns_timeline(spark: SparkSession, sf_dir: str) -> DataFrame:
    return formats.turns_timeline(timed(spark, sf_dir)).select(*K, F.col("colour").cast("long").alias("colour"), "shown", F.col("left").alias("left_share"), "width")


def clique_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Turns as rows of a token table that name overlap events."""
    df = spark.read.parquet(f"{sf_dir}/conversations.parquet")
    text = F.when(F.col("turn") % 3 == 0, "_").when(F.col("turn") % 3 == 1, F.concat(F.lit("0-3("), F.floor(F.col("turn") / 4).cast("string"), F.lit(")"))).otherwise(F.concat(F.lit("0-2("), F.floor(F.col("turn") / 4).cast("string"), F.lit("),2-4(?)")))
    return df.select(F.col("conv_id").alias("transcript_id"), F.col("turn").alias("tu_id"), F.col("turn").alias("line"), text.alias("overlaps"))


@query("""
SELECT conv_id AS transcript_id, CAST(turn // 4 AS VARCHAR) AS clique, string_agg(CAST(turn AS VARCHAR), ' ' ORDER BY turn) AS units, min(turn) AS first_unit FROM conversations WHERE turn % 3 <> 0 GROUP BY conv_id, turn // 4
""")
def clique_links(spark: SparkSession, sf_dir: str) -> DataFrame:
    df = formats.clique_units(clique_rows(spark, sf_dir))
    return df.select("transcript_id", "clique", F.array_join(F.transform("units", lambda x: x.cast("string")), " ").alias("units"), "first_unit")


def processed(spark: SparkSession, sf_dir: str) -> dict[str, DataFrame]:
    raw = timed(spark, sf_dir).withColumns({"start": F.col("start") / 1000, "end": F.col("end") / 1000})
    return process(raw, width=60)


@query()
def process_vert(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The token table of the whole way."""
    return processed(spark, sf_dir)["vert"]


@query()
def process_summary(spark: SparkSession, sf_dir: str) -> DataFrame:
    return processed(spark, sf_dir)["summary"]


@query()
def process_linear(spark: SparkSession, sf_dir: str) -> DataFrame:
    return processed(spark, sf_dir)["linear"]


@query()
def conllu(spark: SparkSession, sf_dir: str) -> DataFrame:
    return formats.conllu(verts(spark, sf_dir), K)


@query()
def tei(spark: SparkSession, sf_dir: str) -> DataFrame:
    return formats.tei(verts(spark, sf_dir).withColumn("overlaps", F.when(F.col("line") % 7 == 3, "0-1(1)").otherwise("_")))


@query()
def chat(spark: SparkSession, sf_dir: str) -> DataFrame:
    return formats.chat(verts(spark, sf_dir).withColumn("overlaps", F.when(F.col("line") % 7 == 3, "0-1(1)").otherwise("_")))


@query("""
WITH r AS (SELECT transcript_id, tu_id, speaker, replace(replace(replace(replace(text, '&', '&amp;'), '<', '&lt;'), '>', '&gt;'), '"', '&quot;') AS x, row_number() OVER (PARTITION BY transcript_id ORDER BY tu_id) AS n,
                  CAST(trunc(start_ms / 1000 * 1000) AS BIGINT) AS b, CAST(trunc(end_ms / 1000 * 1000) AS BIGINT) AS e FROM {units} u),
     s AS (SELECT transcript_id, string_agg('<TIME_SLOT TIME_SLOT_ID="ts' || (2 * n - 1) || '" TIME_VALUE="' || b || '"/>' || chr(10) || '<TIME_SLOT TIME_SLOT_ID="ts' || (2 * n) || '" TIME_VALUE="' || e || '"/>', chr(10) ORDER BY n) AS slots FROM r GROUP BY 1),
     t AS (SELECT transcript_id, speaker, min(n) AS f, '<TIER LINGUISTIC_TYPE_REF="default-lt" TIER_ID="' || speaker || '">' || chr(10) || string_agg('<ANNOTATION><ALIGNABLE_ANNOTATION ANNOTATION_ID="a' || n || '" TIME_SLOT_REF1="ts' || (2 * n - 1) || '" TIME_SLOT_REF2="ts' || (2 * n) || '"><ANNOTATION_VALUE>' || x || '</ANNOTATION_VALUE></ALIGNABLE_ANNOTATION></ANNOTATION>', chr(10) ORDER BY n) || chr(10) || '</TIER>' AS tier FROM r GROUP BY 1, 2),
     b AS (SELECT transcript_id, string_agg(tier, chr(10) ORDER BY f) AS tiers FROM t GROUP BY 1)
SELECT b.transcript_id, concat_ws(chr(10), '<?xml version="1.0" encoding="UTF-8"?>', '<ANNOTATION_DOCUMENT FORMAT="3.0" VERSION="3.0">', '<HEADER MEDIA_FILE="" TIME_UNITS="milliseconds"/>', '<TIME_ORDER>', slots, '</TIME_ORDER>', tiers,
       '<LINGUISTIC_TYPE LINGUISTIC_TYPE_ID="default-lt" TIME_ALIGNABLE="true"/>', '</ANNOTATION_DOCUMENT>') AS text
FROM b JOIN s ON s.transcript_id = b.transcript_id
""")
def eaf(spark: SparkSession, sf_dir: str) -> DataFrame:
    return formats.eaf(timed(spark, sf_dir).withColumns({"start": F.col("start") / 1000, "end": F.col("end") / 1000}))


@query(tok(r"SELECT transcript_id, tu_id, CAST(idx AS BIGINT) AS idx, coalesce(nullif(CASE WHEN regexp_matches(regexp_replace(span, '[\[\]()<>°]', '', 'g'), '^x+$') OR span = '(.)' OR regexp_matches(span, '^\(\(.*\)\)$') OR regexp_matches(span, '^\{.*\}$') OR trim(span) IN ('', '_') THEN NULL ELSE lower(replace(regexp_replace(regexp_replace(regexp_replace(span, '[\[\]()<>°]', '', 'g'), '^[$#]', ''), '[.,?]$', ''), ':', '')) END, ''), '-') AS derived FROM {tokens} k"))
def form_from_span(spark: SparkSession, sf_dir: str) -> DataFrame:
    return toks(spark, sf_dir).select(*K, F.col("idx").cast("long").alias("idx"), F.coalesce(X.form_from_span(F.col("span")), F.lit("-")).alias("derived"))


@query(tok("""
SELECT transcript_id, tu_id, token_id, CASE WHEN state IS NOT NULL AND state <> coalesce(before, 'normal') THEN state END AS loud_shift, CAST(NULL AS VARCHAR) AS tempo_shift, CAST(idx + 1 AS BIGINT) AS n
FROM (SELECT *, last_value(state IGNORE NULLS) OVER (PARTITION BY transcript_id, tu_id ORDER BY idx ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS before
      FROM (SELECT transcript_id, tu_id, idx, tu_id || '-' || idx AS token_id, CASE WHEN type NOT IN ('shortpause', 'nonverbalbehavior', 'anonymized') THEN CASE volume WHEN 'low' THEN 'p' WHEN 'high' THEN 'f' ELSE 'normal' END END AS state FROM {tokens} k) a) b
"""))
def pause_windows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Turns of state for a reader: where loudness and tempo change."""
    df = formats.in_runs(verts(spark, sf_dir), K)
    return formats.shifts(df, K).select(*K, "token_id", "loud_shift", "tempo_shift", F.row_number().over(Window.partitionBy(*K).orderBy("line")).cast("long").alias("n"))


@query("SELECT transcript_id, end_ms AS tot_length FROM (SELECT *, row_number() OVER (PARTITION BY transcript_id ORDER BY start_ms DESC, tu_id DESC) AS r FROM {units} u) t WHERE r = 1")
def total_length(spark: SparkSession, sf_dir: str) -> DataFrame:
    return length_of(timed(spark, sf_dir))

"""Queries of edited tables and of the validation report over the driver's tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from parlance.operators import formats, patching, validation, wip
from parlance.operators.normalize import ERRORS, NAMES, normalize
from parlance.plans.registry import ORACLE_SQL, lines, query, table, tasks, units
from parlance.plans.rules import norm_full

COLUMNS = ["token_id", "speaker", "tu_id", "span", "form", "type", "jefferson_feats", "align", "pace"]

#: Orders as tokens, the orders of a customer as a file. Both engines read this text.
SOURCE_SQL = """
SELECT o_custkey AS file, o_orderkey AS line, CAST(o_orderkey AS STRING) AS token_id,
       CASE WHEN (o_orderkey + o_custkey) % 4 = 0 THEN '_' ELSE o_orderstatus END AS speaker, CASE WHEN o_orderkey % 3 = 0 THEN '_' ELSE substr(o_orderpriority, 1, 1) END AS tu_id,
       CASE WHEN o_orderkey % 2 = 0 THEN 'Ciao.' ELSE 'ciao' END AS span, 'ciao' AS form, 'linguistic' AS type,
       CASE WHEN o_orderkey % 2 = 0 THEN 'Volume=High|Intonation=Falling' WHEN o_orderkey % 5 = 0 THEN 'ProsodicLink=Yes' ELSE '_' END AS jefferson_feats,
       CASE o_orderkey % 7 WHEN 0 THEN concat('Begin=', CAST(o_orderkey AS STRING)) WHEN 1 THEN concat('End=', CAST(o_orderkey AS STRING)) WHEN 2 THEN concat('Begin=', CAST(o_orderkey AS STRING), '|End=', CAST(o_orderkey + 1 AS STRING)) ELSE '_' END AS align,
       CASE WHEN o_orderkey % 11 = 0 THEN 'Slow=1' ELSE '_' END AS pace
FROM orders WHERE (o_orderkey + o_custkey) % 5 <> 0
"""
#: The same customers' tables after an edit: other orders are missing, some text is new.
EDITED_SQL = """
SELECT o_custkey AS file, o_orderkey AS line, CAST(o_orderkey AS STRING) AS token_id, CASE WHEN o_orderkey % 13 = 0 THEN ' eh? ' WHEN o_orderkey % 2 = 0 THEN 'Ciao.' ELSE 'ciao' END AS span,
       CASE WHEN o_orderkey % 13 = 0 THEN 'eh' WHEN o_orderkey % 17 = 0 THEN 'ciò' ELSE 'ciao' END AS form,
       CASE WHEN o_orderkey % 4 = 1 THEN substr(o_orderpriority, 1, 1) ELSE '_' END AS tu_id, CASE WHEN o_orderkey % 6 = 1 THEN 'Z' ELSE '_' END AS speaker, CASE WHEN o_orderkey % 19 = 0 THEN 'Lang=eng' ELSE '_' END AS jefferson_feats
FROM orders WHERE (o_orderkey + 2 * o_custkey) % 3 <> 0
"""

#: Kept rows by windows, added rows by walking through a file row by row.
PATCH_SQL = f"""
WITH RECURSIVE s0 AS ({SOURCE_SQL}), e0 AS ({EDITED_SQL}), both_files AS (SELECT DISTINCT file FROM s0 JOIN (SELECT DISTINCT file FROM e0) USING (file)),
     s AS (SELECT s0.*, nullif(regexp_extract(align, 'Begin=([0-9]+)', 1), '') AS b, nullif(regexp_extract(align, 'End=([0-9]+)', 1), '') AS e FROM s0 JOIN both_files USING (file)),
     d AS (SELECT e0.file, e0.line, e0.token_id, trim(e0.span) AS span, e0.form, nullif(e0.tu_id, '_') AS tu, nullif(e0.speaker, '_') AS sp, e0.jefferson_feats AS jf FROM e0 JOIN both_files USING (file)),
     k AS (SELECT s.*, d.span AS dspan, d.form AS dform, d.tu AS dtu, d.sp AS dsp, d.jf AS djf, row_number() OVER w AS k, lag(s.line, 1, -1) OVER w AS below, lead(s.line, 1, 9000000000) OVER w AS above,
                  nullif(s.tu_id, '_') AS raw_tu, nullif(s.speaker, '_') AS raw_sp FROM s JOIN d USING (file, token_id) WINDOW w AS (PARTITION BY s.file ORDER BY s.line)),
     x AS (SELECT s.file, s.line, s.token_id, s.tu_id, s.b, s.e, s.pace, p.token_id AS p_id, p.e AS p_e, n.token_id AS n_id, n.b AS n_b, p.k AS pk, n.k AS nk,
                  min(CASE WHEN s.e IS NOT NULL THEN s.line END) OVER (PARTITION BY s.file, p.k) AS first_e, max(CASE WHEN s.b IS NOT NULL THEN s.line END) OVER (PARTITION BY s.file, p.k) AS last_b,
                  last_value(s.b IGNORE NULLS) OVER (PARTITION BY s.file, p.k ORDER BY s.line ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS earlier_b, first_value(s.e IGNORE NULLS) OVER (PARTITION BY s.file, p.k ORDER BY s.line ROWS BETWEEN UNBOUNDED PRECEDING AND UNBOUNDED FOLLOWING) AS some_e
           FROM s LEFT JOIN k AS p ON p.file = s.file AND p.line < s.line AND p.above > s.line LEFT JOIN k AS n ON n.file = s.file AND n.line > s.line AND n.below < s.line
           WHERE NOT EXISTS (SELECT 1 FROM d WHERE d.file = s.file AND d.token_id = s.token_id)),
     ends AS (SELECT file, pk AS k, e FROM x WHERE line = first_e AND pk IS NOT NULL), begins AS (SELECT file, nk AS k, b FROM x WHERE line = last_b AND nk IS NOT NULL),
     t AS (SELECT *, coalesce(raw_tu, dtu) AS own_tu, coalesce(raw_sp, dsp) AS own_sp, last_value(coalesce(raw_tu, dtu) IGNORE NULLS) OVER w AS p_tu, lead(raw_tu) OVER v AS n_tu, last_value(coalesce(raw_sp, dsp) IGNORE NULLS) OVER w AS p_sp, lead(raw_sp) OVER v AS n_sp
           FROM k WINDOW v AS (PARTITION BY file ORDER BY line), w AS (PARTITION BY file ORDER BY line ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)),
     u AS (SELECT *, coalesce(own_tu, CASE WHEN n_tu IS NULL OR p_tu = n_tu THEN p_tu WHEN p_tu IS NULL THEN n_tu END) AS tu FROM t),
     v AS (SELECT *, coalesce(own_sp, CASE WHEN lag(tu) OVER o = tu THEN p_sp END, CASE WHEN n_tu = tu THEN n_sp END, CASE WHEN n_sp IS NULL OR p_sp = n_sp THEN p_sp WHEN p_sp IS NULL THEN n_sp END) AS sp FROM u WINDOW o AS (PARTITION BY file ORDER BY line)),
     kept AS (SELECT v.*, coalesce(v.b, begins.b) AS nb, coalesce(v.e, ends.e) AS ne FROM v LEFT JOIN ends USING (file, k) LEFT JOIN begins USING (file, k)),
     r AS (SELECT d.file, d.token_id, d.tu AS dtu, d.sp AS dsp, kept.k IS NOT NULL AS stays, kept.tu AS ktu, kept.sp AS ksp, kept.ne AS ke, row_number() OVER (PARTITION BY d.file ORDER BY d.line) AS i,
                  coalesce(max(kept.k) OVER (PARTITION BY d.file ORDER BY d.line), 0) + 1 AS after FROM d LEFT JOIN kept USING (file, token_id)),
     nx AS (SELECT r.*, n.token_id AS n_id, n.tu AS ntu, n.sp AS nsp, n.nb AS nb FROM r LEFT JOIN kept n ON n.file = r.file AND n.k = r.after),
     walk AS (
         SELECT file, CAST(0 AS BIGINT) AS i, CAST(NULL AS VARCHAR) AS id, CAST(NULL AS VARCHAR) AS tu, CAST(NULL AS VARCHAR) AS sp, CAST(NULL AS VARCHAR) AS e, false AS used, false AS stays, CAST(NULL AS VARCHAR) AS b, false AS took, CAST(NULL AS VARCHAR) AS from_id, CAST(NULL AS VARCHAR) AS n_id FROM both_files
         UNION ALL
         SELECT q.file, q.i, q.token_id, q.tu, q.sp, CASE WHEN q.stays THEN q.ke WHEN q.took THEN q.pe END, CASE WHEN q.stays THEN false ELSE q.used OR q.gets END, q.stays, CASE WHEN NOT q.stays AND q.gets THEN q.nb END, NOT q.stays AND q.took, q.pid, q.n_id
         FROM (SELECT z.*, z.pid IS NOT NULL AND coalesce(z.ptu, '_') = coalesce(z.tu, '_') AND z.pe IS NOT NULL AS took, z.n_id IS NOT NULL AND NOT z.used AND coalesce(z.ntu, '_') = coalesce(z.tu, '_') AND z.nb IS NOT NULL AS gets
               FROM (SELECT y.*, CASE WHEN stays THEN ksp ELSE coalesce(dsp, CASE WHEN ptu = tu THEN psp END, CASE WHEN ntu = tu THEN nsp END, CASE WHEN nsp IS NULL OR psp = nsp THEN psp WHEN psp IS NULL THEN nsp END) END AS sp
                     FROM (SELECT nx.file, nx.i, nx.token_id, nx.stays, nx.ksp, nx.dsp, nx.ke, nx.n_id, nx.ntu, nx.nsp, nx.nb, w.id AS pid, w.tu AS ptu, w.sp AS psp, w.e AS pe, w.used,
                                  CASE WHEN nx.stays THEN nx.ktu ELSE coalesce(nx.dtu, CASE WHEN nx.ntu IS NULL OR w.tu = nx.ntu THEN w.tu WHEN w.tu IS NULL THEN nx.ntu END) END AS tu
                           FROM walk w JOIN nx ON nx.file = w.file AND nx.i = w.i + 1) y) z) q),
     done AS (SELECT *, coalesce(lead(took) OVER (PARTITION BY file ORDER BY i), false) AS passed FROM walk WHERE i > 0),
     gone_b AS (SELECT DISTINCT file, n_id FROM done WHERE NOT stays AND b IS NOT NULL),
     rows_out AS (
         SELECT kept.file, kept.token_id, CASE WHEN kept.span <> dspan OR kept.form <> dform OR djf <> '_' OR coalesce(kept.tu, kept.tu_id) <> kept.tu_id OR coalesce(kept.sp, kept.speaker) <> kept.speaker THEN 'changed' ELSE 'kept' END AS change,
                coalesce(kept.tu, '_') AS tu_id, coalesce(kept.sp, '_') AS speaker, dspan AS span, dform AS form, kept.jefferson_feats AS old_jf, djf, dspan <> kept.span AS respelt, CASE WHEN gone_b.n_id IS NULL THEN nb END AS b, CASE WHEN NOT done.passed THEN ne END AS e,
                CASE WHEN kept.form <> dform AND kept.span = dspan AND lower(rtrim(dspan, '.')) <> dform THEN '⚠️ forma non derivabile dallo span — verifica manuale' ELSE '' END AS notes
         FROM kept JOIN done ON done.file = kept.file AND done.id = kept.token_id LEFT JOIN gone_b ON gone_b.file = kept.file AND gone_b.n_id = kept.token_id
         UNION ALL
         SELECT x.file, x.token_id, 'dropped', NULL, NULL, NULL, NULL, NULL, NULL, NULL, NULL, NULL, concat_ws(' / ',
                CASE WHEN e IS NULL THEN NULL WHEN pk IS NULL THEN '❌ End=' || e || ' — no previous token' WHEN p_e IS NULL AND line = first_e THEN '✅ End=' || e || ' → `' || p_id || '`' ELSE '❌ End conflict: End=' || e || ' but `' || p_id || '` already has End=' || coalesce(p_e, some_e) END,
                CASE WHEN b IS NOT NULL AND earlier_b IS NOT NULL THEN '❌ Begin conflict: pending Begin=' || earlier_b || ' overwritten by Begin=' || b END, CASE WHEN pace <> '_' THEN '⚠️ pace=`' || pace || '`' END,
                CASE WHEN line = last_b AND nk IS NOT NULL THEN CASE WHEN n_b IS NULL THEN '✅ Begin=' || b || ' → `' || n_id || '`' ELSE '❌ Begin=' || b || ' conflict: `' || n_id || '` already has Begin=' || n_b END END) FROM x
         UNION ALL
         SELECT done.file, id, 'added', coalesce(done.tu, '_'), coalesce(done.sp, '_'), d.span, d.form, '_', d.jf, true, b, CASE WHEN NOT passed THEN e END,
                CASE WHEN took OR b IS NOT NULL THEN concat_ws(' / ', CASE WHEN took THEN '✅ End=' || e || ' ← `' || from_id || '`' END, CASE WHEN b IS NOT NULL THEN '✅ Begin=' || b || ' ← `' || n_id || '`' END) ELSE '⚠️ verifica allineamento manualmente' END
         FROM done JOIN d ON d.file = done.file AND d.token_id = done.id WHERE NOT stays)
SELECT file, token_id, change, tu_id, speaker, span, form, CASE WHEN change <> 'dropped' THEN
         coalesce(nullif(concat_ws('|', CASE WHEN respelt THEN CASE WHEN old_jf LIKE '%ProsodicLink%' THEN 'ProsodicLink=Yes' END ELSE nullif(old_jf, '_') END,
             CASE WHEN respelt THEN nullif(concat_ws('|', CASE WHEN span = 'Ciao.' THEN 'Volume=High|Intonation=Falling' WHEN span = 'eh?' THEN 'Intonation=Rising' END), '') END, nullif(djf, '_')), ''), '_') END AS jefferson_feats,
       CASE WHEN change <> 'dropped' THEN coalesce(nullif(concat_ws('|', 'Begin=' || b, 'End=' || e), ''), '_') END AS align, notes
FROM rows_out
"""


def sides(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame, DataFrame]:
    table(spark, sf_dir, "orders").createOrReplaceTempView("orders")
    flat = spark.sql(SOURCE_SQL)
    cols = F.array(*map(F.lit, COLUMNS))
    source = flat.select("file", "line", cols.alias("cols"), F.map_from_arrays(cols, F.array(*COLUMNS)).alias("cells"))
    heads = flat.select("file").distinct().select("file", cols.alias("cols"), F.lit("\n").alias("eol"), F.lit("\t".join(COLUMNS) + "\n").alias("head"))
    return source, heads, spark.sql(EDITED_SQL)


@query(PATCH_SQL)
def patch_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every token of both sides: what becomes of it, and the notes of the recap."""
    df = patching.patched(*sides(spark, sf_dir), tasks=tasks(table(spark, sf_dir, "orders")))
    return df.select("file", "token_id", "change", *[F.col("new")[c].alias(c) for c in ("tu_id", "speaker", "span", "form", "jefferson_feats", "align")], F.array_join("notes", " / ").alias("notes"))


#: Order lines as the tokens of CoNLL-U sentences: ranges with and without ids, parts without a range, missing ids, pauses and events; and for each what the transcript has in its place. Both engines read this text.
CONLLU_SQL = """
SELECT concat('F', CAST(k % 97 AS STRING)) AS file, k AS sent, n AS idx, concat(CAST(k AS STRING), '_x') AS sent_id, concat('S', CAST(k % 3 AS STRING)) AS speaker_id,
       CASE WHEN k % 4 <> 0 OR n < 2 THEN CAST(n AS STRING) WHEN n = 2 THEN '2-3' ELSE CAST(n - 1 AS STRING) END AS id,
       CASE WHEN (k + 3 * n) % 17 = 0 THEN '(.)' WHEN (k + 3 * n) % 19 = 0 THEN '((ride))' ELSE word END AS form, concat('l', word) AS lemma, 'VERB' AS upos,
       CASE WHEN kid IS NULL THEN CASE WHEN (k + n) % 7 = 0 THEN 'PauseAfter=Yes' ELSE '_' END WHEN (k + n) % 7 = 0 THEN concat('KID=', kid, '|PauseAfter=Yes') ELSE concat('KID=', kid) END AS misc,
       CASE WHEN k % 4 = 0 AND n IN (3, 4) OR k % 4 = 1 AND n = 4 OR (k + n) % 13 = 0 THEN '' ELSE
           concat(CASE WHEN (k + n) % 11 = 0 THEN 'mah ' WHEN (k + n) % 23 = 0 THEN '| ((tosse)) ' WHEN (k + n) % 29 = 0 THEN '{ride} ' ELSE '' END,
                  CASE WHEN (k + 3 * n) % 17 = 0 THEN '(.)' WHEN (k + 3 * n) % 19 = 0 THEN '((ride))' ELSE spoken END, CASE WHEN (k + n) % 14 = 0 THEN ' (1.5)' ELSE '' END) END AS piece
FROM (SELECT l_orderkey AS k, l_linenumber AS n,
             CASE WHEN l_orderkey % 4 = 0 AND l_linenumber = 2 THEN NULL WHEN l_orderkey % 8 = 0 AND l_linenumber IN (3, 4) THEN concat(CAST(l_orderkey AS STRING), '-1')
                  WHEN l_orderkey % 8 = 4 AND l_linenumber IN (3, 4) THEN concat(CAST(l_orderkey AS STRING), CASE WHEN l_linenumber = 3 THEN '-1a' ELSE '-1b' END)
                  WHEN l_orderkey % 4 = 1 AND l_linenumber IN (3, 4) THEN concat(CAST(l_orderkey AS STRING), CASE WHEN l_linenumber = 3 THEN '-2a' ELSE '-2b' END)
                  WHEN l_orderkey % 8 = 1 AND l_linenumber = 5 THEN concat(CAST(l_orderkey AS STRING), '-2')
                  WHEN (l_orderkey + l_linenumber) % 5 < 2 THEN NULL ELSE concat(CAST(l_orderkey AS STRING), '-', CAST(l_linenumber - 1 AS STRING)) END AS kid,
             CASE (7 * l_orderkey + l_linenumber) % 6 WHEN 0 THEN 'ciao' WHEN 1 THEN 'c''' WHEN 2 THEN 'era' WHEN 3 THEN 'x' WHEN 4 THEN 'sì' ELSE 'bello' END AS word,
             CASE (7 * l_orderkey + l_linenumber) % 6 WHEN 0 THEN '[cia::o].' WHEN 1 THEN 'c''era' WHEN 2 THEN '>era<' WHEN 3 THEN '[xxx]' WHEN 4 THEN 'Sì,=' ELSE 'bel°lo=' END AS spoken
      FROM (SELECT l_orderkey, row_number() OVER (PARTITION BY l_orderkey ORDER BY l_linenumber, l_partkey, l_suppkey, l_extendedprice, l_quantity) AS l_linenumber FROM lineitem) l) t
"""

#: Ids by windows, and the words of a sentence dealt by walking through its tokens.
WIP_SQL = f"""
WITH RECURSIVE c AS ({CONLLU_SQL}),
     texts AS (SELECT file, sent, string_agg(piece, ' ' ORDER BY idx) AS text FROM c GROUP BY file, sent),
     t0 AS (SELECT c.*, nullif(regexp_extract(misc, 'KID=([^|]+)', 1), '') AS kid0, TRY_CAST(id AS INTEGER) AS n, contains(id, '-') AS is_range FROM c),
     r AS (SELECT file, sent, idx AS head, kid0 AS own, CAST(split_part(id, '-', 1) AS INTEGER) AS a, CAST(split_part(id, '-', 2) AS INTEGER) AS b FROM t0 WHERE is_range),
     parts AS (SELECT t0.file, t0.sent, t0.idx, r.head, r.own, row_number() OVER w AS place, first_value(t0.kid0) OVER w AS first FROM t0 JOIN r ON r.file = t0.file AND r.sent = t0.sent AND t0.idx > r.head AND t0.n BETWEEN r.a AND r.b WINDOW w AS (PARTITION BY t0.file, t0.sent, r.head ORDER BY t0.idx)),
     t1 AS (SELECT t0.*, CASE WHEN is_range AND kid0 IS NULL AND h.first IS NOT NULL THEN regexp_replace(h.first, '[a-z]$', '')
                              WHEN p.first IS NOT NULL AND p.own IS NULL AND NOT regexp_matches(p.first, '[a-z]$') THEN p.first || chr(CAST(96 + p.place AS INTEGER)) ELSE kid0 END AS kid1,
                   is_range AND kid0 IS NULL AND h.first IS NOT NULL AND NOT regexp_matches(h.first, '[a-z]$') AS lettered
            FROM t0 LEFT JOIN parts p USING (file, sent, idx) LEFT JOIN (SELECT file, sent, head AS idx, any_value(first) AS first FROM parts GROUP BY ALL) h ON h.file = t0.file AND h.sent = t0.sent AND h.idx = t0.idx),
     t2 AS (SELECT *, row_number() OVER o AS i, last_value(CASE WHEN regexp_matches(kid1, '^[0-9]+-[0-9]+$') THEN kid1 END IGNORE NULLS) OVER b AS known FROM t1 WINDOW o AS (PARTITION BY file, sent ORDER BY idx), b AS (PARTITION BY file, sent ORDER BY idx ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)),
     t3 AS (SELECT *, i - coalesce(last_value(CASE WHEN kid1 IS NOT NULL THEN i END IGNORE NULLS) OVER (PARTITION BY file, sent ORDER BY idx ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS since FROM t2),
     t4 AS (SELECT *, coalesce(kid1, coalesce(split_part(known, '-', 1), split_part(sent_id, '_', 1)) || '-' || CAST(coalesce(CAST(split_part(known, '-', 2) AS BIGINT), -1) + since AS VARCHAR)) AS kid FROM t3),
     t5 AS (SELECT t4.*, CASE WHEN regexp_matches(kid, '^[0-9]+-[0-9]+[a-z]$') THEN left(kid, -1) END AS base, EXISTS (SELECT 1 FROM r WHERE r.file = t4.file AND r.sent = t4.sent AND t4.n BETWEEN r.a AND r.b) AS covered FROM t4),
     orphans AS (SELECT file, sent, base, min(n) AS low, max(n) AS high, count(*) AS many FROM t5 WHERE base IS NOT NULL AND NOT covered AND NOT EXISTS (SELECT 1 FROM t5 o WHERE o.file = t5.file AND o.sent = t5.sent AND o.kid = t5.base) GROUP BY ALL),
     made AS (SELECT file, sent, base, min(i) AS i FROM t5 JOIN orphans USING (file, sent, base) GROUP BY ALL),
     em AS (SELECT t5.file, t5.sent, t5.i, 1 AS after, t5.id, t5.kid, t5.form, t5.lemma, t5.upos, t5.misc, t5.covered OR o.base IS NOT NULL AS is_sub, false AS made, t5.is_range AS whole, speaker_id, CASE WHEN lettered THEN 'letters of parts made up' END AS note FROM t5 LEFT JOIN orphans o USING (file, sent, base)
            UNION ALL SELECT file, sent, made.i, 0, CASE WHEN many > 1 THEN low || '-' || high ELSE CAST(low AS VARCHAR) END, base, '_', '_', '_', '_', false, true, true, t5.speaker_id, 'parent made up' FROM made JOIN orphans USING (file, sent, base) JOIN t5 USING (file, sent, i)),
     e AS (SELECT *, row_number() OVER (PARTITION BY file, sent ORDER BY i, after) AS k, form IN ('(.)', '{{P}}') AS pause, regexp_matches(form, '^\\(\\(.*\\)\\)$|^\\{{.*\\}}$') AS tag, contains(misc, 'PauseAfter=Yes') AS pauses FROM em),
     words AS (SELECT file, sent, flatten([string_split(regexp_replace(w, '([^''=])([''=])([^''=])', '\\1\\2 \\3', 'g'), ' ') FOR w IN string_split_regex(trim(text), '\\s+') IF w <> '' AND w <> '|' AND NOT regexp_matches(w, '^\\(\\(.*\\)\\)$')]) AS ws FROM texts),
     near AS (SELECT *, [CASE WHEN regexp_matches(x, '^x+$') THEN 'x' ELSE x END FOR x IN [lower(regexp_replace(regexp_replace(regexp_replace(regexp_replace(w, '[\\[\\]()<>°]', '', 'g'), '[.,?]+$', ''), ':+', '', 'g'), '=+$', '')) FOR w IN ws]] AS ns FROM words),
     walk AS (
         SELECT file, sent, CAST(0 AS BIGINT) AS k, CAST(1 AS BIGINT) AS pos, false AS paused, CAST(NULL AS VARCHAR) AS span, CAST(NULL AS VARCHAR) AS passed, false AS gone, CAST(NULL AS VARCHAR) AS silence FROM near
         UNION ALL
         SELECT file, sent, k, CASE WHEN gone THEN pos0 WHEN is_sub THEN pos0 ELSE here + 1 + CASE WHEN says AND coalesce(regexp_matches(ws[here + 1], '^(\\(\\.+\\)|\\([0-9]+[.,][0-9]+\\))$'), false) THEN 1 ELSE 0 END END,
                NOT gone AND NOT is_sub AND pauses, CASE WHEN is_sub THEN '_' ELSE coalesce(ws[here], '_') END, CASE WHEN here > pos THEN ws[pos] END, gone,
                CASE WHEN NOT gone AND says THEN CASE WHEN regexp_matches(ws[here + 1], '^(\\(\\.+\\)|\\([0-9]+[.,][0-9]+\\))$') THEN ws[here + 1] ELSE '(.)' END END
         FROM (SELECT *, pos + CASE WHEN NOT is_sub AND NOT made AND NOT pause AND NOT tag AND pos + 1 <= len(ws) AND ns[pos] <> lower(form) AND ns[pos + 1] = lower(form) THEN 1 ELSE 0 END AS here, NOT is_sub AND NOT pause AND pauses AS says
               FROM (SELECT e.*, w.pos AS pos0, near.ws, near.ns, e.pause AND NOT e.is_sub AND w.paused AS gone,
                            CASE WHEN e.is_sub OR e.tag THEN w.pos ELSE coalesce([j FOR j IN range(w.pos, len(near.ws) + 1) IF NOT regexp_matches(near.ws[j], '^(\\(\\([A-Za-z][A-Za-z0-9_]*\\)\\)|\\{{[A-Za-z][A-Za-z0-9]*\\}})$')][1], greatest(w.pos, len(near.ws) + 1)) END AS pos
                     FROM walk w JOIN e ON e.file = w.file AND e.sent = w.sent AND e.k = w.k + 1 JOIN near ON near.file = w.file AND near.sent = w.sent))),
     placed AS (SELECT e.*, w.span, w.passed, w.silence, CASE WHEN contains(kid, '-') THEN split_part(kid, '-', 1) ELSE '' END AS unit, NOT whole AND NOT is_sub AND pause AS p, NOT whole AND NOT is_sub AND tag AND NOT pause AS v FROM e JOIN walk w USING (file, sent, k) WHERE NOT w.gone)
SELECT file, kid AS token_id, CASE WHEN is_sub AND NOT whole THEN '_' ELSE speaker_id END AS speaker, CASE WHEN is_sub AND NOT whole THEN '_' ELSE unit END AS tu_id, unit, id, span,
       CASE WHEN made THEN span WHEN p THEN '[PAUSE]' WHEN v THEN '[NVB]' ELSE form END AS form, CASE WHEN whole THEN '_' WHEN p THEN '[PAUSE]' WHEN v THEN '[NVB]' ELSE lemma END AS lemma, CASE WHEN whole THEN '_' WHEN p OR v THEN 'X' ELSE upos END AS upos, '_' AS jefferson_feats,
       concat_ws('; ', note, 'word passed over: ' || passed) AS note FROM placed
UNION ALL
SELECT file, CASE WHEN regexp_matches(kid, '^[0-9]+-[0-9]+$') THEN unit || '-' || CAST(CAST(split_part(kid, '-', 2) AS BIGINT) + 1 AS VARCHAR) ELSE unit || '-?' END, speaker_id, unit, unit, '_', silence, '[PAUSE]', '[PAUSE]', 'X', '_', '' FROM placed WHERE silence IS NOT NULL
"""


@query(WIP_SQL)
def conllu_to_wip(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The whole conversion of CoNLL-U sentences, with words left out, words too many, and clitics."""
    lines(spark, sf_dir).createOrReplaceTempView("lineitem")
    tokens = spark.sql(CONLLU_SQL)
    pieces = F.collect_list("piece").over(Window.partitionBy("file", "sent").orderBy("idx").rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing))
    return wip.converted(tokens.withColumn("jefferson_text", F.array_join(pieces, " ")).drop("piece")).drop("sort")


#: What the rules did to units, unpivoted: a row for each conversation and rule, and one for each fault.
OCCURRENCES_SQL = f"""
WITH full_rows AS ({ORACLE_SQL[norm_full.__name__]}),
     w AS (SELECT 'M' || transcript_id % 7 AS module, CAST(transcript_id AS VARCHAR) AS code, 'warning' AS kind, rule, CAST(sum(n) AS BIGINT) AS n, NULL AS tu_id, NULL AS speaker, NULL AS text
           FROM (UNPIVOT (SELECT transcript_id, {', '.join(f'CAST(w_{n} AS BIGINT) AS "{n}"' for n in NAMES)} FROM full_rows) ON {', '.join(f'"{n}"' for n in NAMES)} INTO NAME rule VALUE n) GROUP BY ALL HAVING sum(n) > 0),
     e AS (SELECT 'M' || transcript_id % 7 AS module, CAST(transcript_id AS VARCHAR) AS code, 'error' AS kind, rule, CAST(1 AS BIGINT) AS n, tu_id, speaker, text
           FROM (UNPIVOT (SELECT transcript_id, tu_id, speaker, text, {', '.join(f'CAST(e_{c.name} AS BIGINT) AS "{c.name}"' for c in ERRORS)} FROM full_rows) ON {', '.join(f'"{c.name}"' for c in ERRORS)} INTO NAME rule VALUE n) WHERE n > 0),
     o AS (SELECT * FROM w UNION ALL SELECT * FROM e)
"""


def said_of_units(spark: SparkSession, sf_dir: str) -> DataFrame:
    df = normalize(units(spark, sf_dir).drop("start_ms", "end_ms")).withColumn("include", F.lit(True))
    none = spark.createDataFrame([], "transcript_id string, tu_id long, speaker string, text string, span string, type string")
    return validation.occurrences(df, none, F.concat(F.lit("M"), (F.col("code").cast("long") % 7).cast("string")))


@query(OCCURRENCES_SQL + """
SELECT CASE GROUPING(code) * 2 + GROUPING(rule) WHEN 3 THEN 'module' WHEN 2 THEN 'rule' WHEN 1 THEN 'conversation' ELSE 'conversation rule' END AS level, module, code, kind, rule, CAST(sum(n) AS BIGINT) AS n, count(DISTINCT code) AS conversations
FROM o GROUP BY GROUPING SETS ((module), (module, kind, rule), (module, code), (module, code, kind, rule))
""")
def validation_totals(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Warnings and errors of all units at four levels, in one pass."""
    return validation.totals(said_of_units(spark, sf_dir))


@query(OCCURRENCES_SQL + """
     , c AS (SELECT module, code, string_agg(rule || ':' || n, ', ' ORDER BY rule) AS said FROM w GROUP BY ALL),
     every_one AS (SELECT DISTINCT 'M' || conv_id % 7 AS module, CAST(conv_id AS VARCHAR) AS code FROM conversations)
SELECT module, count(*) AS conversations, count(said) AS with_warnings,
       '[[' || lower(module) || ']]' || chr(10) || '== ' || module || chr(10) || chr(10) || '[cols="1,4,1"]' || chr(10) || '|===' || chr(10) || '|Code |Warnings |Error tokens' || chr(10)
       || coalesce(string_agg('|' || code || ' |' || said || ' |_', chr(10) ORDER BY code) || chr(10), '') || '|===' || chr(10) AS text
FROM every_one LEFT JOIN c USING (module, code) GROUP BY module
""")
def validation_log(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The log of every module."""
    every = table(spark, sf_dir, "conversations").select(F.concat(F.lit("M"), (F.col("conv_id") % 7).cast("string")).alias("module"), F.col("conv_id").cast("string").alias("code"))
    return validation.log_pages(every, validation.totals(said_of_units(spark, sf_dir)))


@query(OCCURRENCES_SQL + """
SELECT module, code, CAST(row_number() OVER (PARTITION BY module, code ORDER BY tu_id, rule) AS INTEGER) AS place,
       replace('{"module":' || to_json(module) || ',"code":' || to_json(code) || ',"kind":"error","rule":' || to_json(rule) || ',"tuId":' || tu_id || ',"speaker":' || to_json(speaker) || ',"text":' || to_json(text) || ',"span":null,"detail":null,"tsvUrl":null,"eafUrl":null}', '</', '<\\/') AS json
FROM e
""")
def validation_records(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every fault of every unit as a record."""
    return validation.records(said_of_units(spark, sf_dir))


@query("""
WITH t AS (SELECT l_suppkey % 40 AS transcript_id, l_orderkey * 100 + row_number() OVER (PARTITION BY l_orderkey ORDER BY l_linenumber, l_partkey, l_suppkey, l_extendedprice) AS line, CASE l_linenumber % 6 WHEN 0 THEN 'shortpause' WHEN 1 THEN 'nonverbalbehavior' ELSE 'linguistic' END AS type,
                  CASE WHEN l_partkey % 4 = 0 THEN '_' ELSE CAST(l_orderkey // 50 AS VARCHAR) END AS sent_id, CASE WHEN l_partkey % 3 = 0 THEN '' ELSE CAST(l_partkey % 11 AS VARCHAR) END AS iu_id FROM lineitem),
     e AS (SELECT transcript_id, line, 'sentences' AS layer, sent_id AS span FROM t WHERE type = 'linguistic' UNION ALL SELECT transcript_id, line, 'intonation-units', iu_id FROM t WHERE type = 'linguistic')
SELECT transcript_id, layer, span, CAST(min(line) AS VARCHAR) AS first_token, CAST(max(line) AS VARCHAR) AS last_token, min(line) AS first FROM e WHERE span NOT IN ('', '_') GROUP BY 1, 2, 3
""")
def span_layers(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two layers of spans that cross each other and the units."""
    place = F.row_number().over(Window.partitionBy("l_orderkey").orderBy("l_linenumber", "l_partkey", "l_suppkey", "l_extendedprice"))
    k, p, n = F.col("l_orderkey"), F.col("l_partkey"), F.col("l_linenumber") % 6
    rows = table(spark, sf_dir, "lineitem").select(
        (F.col("l_suppkey") % 40).alias("transcript_id"), (k * 100 + place).alias("line"), F.when(n == 0, "shortpause").when(n == 1, "nonverbalbehavior").otherwise("linguistic").alias("type"),
        F.when(p % 4 == 0, "_").otherwise(F.floor(k / 50).cast("string")).alias("sent_id"), F.when(p % 3 == 0, "").otherwise((p % 11).cast("string")).alias("iu_id"),
    )
    return formats.span_layers(rows.withColumn("token_id", F.col("line").cast("string")), {"sent_id": "sentences", "iu_id": "intonation-units"})

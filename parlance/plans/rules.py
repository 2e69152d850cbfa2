"""Queries of single rules, of checks, and of the whole normalisation."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from parlance.functions.italian import MOST_DIGITS, SCALES, cardinal
from parlance.operators.normalize import ACUTE, APOSTROPHES, CORRECTIONS, EITHER, END_LINK, END_PAUSE, NAMES, PACE, SPACING, WARNINGS, apply_checks, apply_rules, normalize
from parlance.operators.units import prepare, route
from parlance.plans.registry import ORACLE_SQL, UNITS_SQL, query, table, timed, units

#: Characters of documents that one task rewrites.
CHARACTERS = 2_000_000

TRIM = ("^\\s+|\\s+$", "")


def steps_sql(steps: list[tuple[str, str]], after: list[tuple[str, str]] = (), first: str = "text") -> str:
    """SQL that rewrites `text` step by step and counts; `after` isn't counted. DuckDB's regular expressions."""
    quoted = lambda x: "'" + x.replace("'", "''") + "'"
    sql = f"SELECT transcript_id, tu_id, {first} AS t, CAST(0 AS BIGINT) AS n FROM {{units}} u"
    for p, r in steps:
        sql = f"SELECT transcript_id, tu_id, regexp_replace(t, {quoted(p)}, {quoted(r)}, 'g') AS t, n + len(regexp_extract_all(t, {quoted(p)})) AS n FROM ({sql})"
    for p, r in after:
        sql = f"SELECT transcript_id, tu_id, regexp_replace(t, {quoted(p)}, {quoted(r)}, 'g') AS t, n FROM ({sql})"
    return f"SELECT transcript_id, tu_id, t AS new_text, CAST(n AS BIGINT) AS changes FROM ({sql})"


def one(spark: SparkSession, sf_dir: str, *numbers: int) -> DataFrame:
    rules = [WARNINGS[n] for n in numbers]
    df = apply_rules(units(spark, sf_dir).select("transcript_id", "tu_id", "text"), rules)
    return df.select("transcript_id", "tu_id", F.col("text").alias("new_text"), F.col(f"w_{rules[0].name}").alias("changes"))


@query(steps_sql([(r"[^{}_,?.:=°><\[\]()\p{L}\p{N}\s'\-~$#@*]", "")], [TRIM]))
def norm_symbols(spark: SparkSession, sf_dir: str) -> DataFrame:
    return one(spark, sf_dir, 0)


@query("""
SELECT transcript_id, tu_id, CAST(len(regexp_extract_all(text, '\\(\\([^()]*\\)\\)')) AS BIGINT) AS changes,
       regexp_replace(regexp_replace(regexp_replace(text, '(\\(\\([^() ]*) ([^()]*\\)\\))', '\\1_\\2', 'g'), '(\\(\\([^() ]*) ([^()]*\\)\\))', '\\1_\\2', 'g'), '(\\(\\([^() ]*) ([^()]*\\)\\))', '\\1_\\2', 'g') AS new_text
FROM {units} u
""")
def norm_metatags(spark: SparkSession, sf_dir: str) -> DataFrame:
    return one(spark, sf_dir, 1)


#: DuckDB writes groups of a match otherwise.
SPACES = [(pattern, mended.replace("$", "\\")) for pattern, mended in SPACING]


@query(steps_sql(SPACES, [TRIM]))
def norm_spaces(spark: SparkSession, sf_dir: str) -> DataFrame:
    return one(spark, sf_dir, 2)


@query(steps_sql([(END_PAUSE, r"\1\2")], [TRIM]))
def norm_trim_pauses(spark: SparkSession, sf_dir: str) -> DataFrame:
    return one(spark, sf_dir, 3)


@query(steps_sql([(END_LINK, r"\1\2")], [TRIM]))
def norm_trim_links(spark: SparkSession, sf_dir: str) -> DataFrame:
    return one(spark, sf_dir, 4)


@query(steps_sql([(" =|= ", "=")], [TRIM]))
def norm_links(spark: SparkSession, sf_dir: str) -> DataFrame:
    return one(spark, sf_dir, 5)


@query(steps_sql([(r"([\p{L}\p{N}_]:*)\[:", r"[\1:")]))
def norm_prolongations(spark: SparkSession, sf_dir: str) -> DataFrame:
    return one(spark, sf_dir, 6)


@query(steps_sql([(r"\t+", " "), (r"\n+", " "), (r"\s\s+", " ")], [TRIM]))
def norm_multispace(spark: SparkSession, sf_dir: str) -> DataFrame:
    return one(spark, sf_dir, 7)


#: What isn't part of a word, as DuckDB's own word edges are those of ASCII.
NO_WORD = r"[^\p{L}\p{M}\p{Nd}_]"


def accents_sql() -> str:
    """Greedy expressions within a stretch; `pò` twice, as neighbours share the character between them."""
    inside = lambda word, other: f"[^{other}]*".join(word)
    steps = [(rf"({inside(w[:-1], " ='")}[^ =']*)è({NO_WORD}|$)", r"\1é\2") for w in ACUTE]
    steps += [(rf"(^|{NO_WORD})p([^ =\p{{L}}]*)ò({NO_WORD}|$)", r"\1p\2o'\3")] * 2
    steps += [(rf"(^|{NO_WORD})({inside(w[:-2], " =")}[^ =]*){w[-2]}[^ ={w[-2]}]*'", rf"\1\2{last}") for w, last in APOSTROPHES]
    # after `pò` the ends are trimmed, which no later step depends on
    return steps_sql(steps, [TRIM])


@query(accents_sql())
def norm_accents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return one(spark, sf_dir, 8, 9, 10)


def corrections_sql() -> str:
    """Delimiters doubled, so that neighbouring words don't share one."""
    twice = lambda w: w.replace(" ", "  ")
    escaped = lambda w: twice(w).replace("'", "'").replace("(", "\\(").replace(")", "\\)")
    sql = steps_sql([(rf"(^|[ =]){escaped(w)}([ =]|$)", rf"\1{twice(r)}\2") for w, r in CORRECTIONS], first="replace(replace(text, ' ', '  '), '=', '==')")
    return f"SELECT transcript_id, tu_id, replace(replace(new_text, '==', '='), '  ', ' ') AS new_text, changes FROM ({sql})"


@query(corrections_sql())
def norm_word_corrections(spark: SparkSession, sf_dir: str) -> DataFrame:
    return one(spark, sf_dir, 11)


#: Italian cardinals below a million, of the numbers in `keys`.
SMALL_SQL = """
WITH small(n, w) AS (SELECT CAST(n AS BIGINT), w FROM (SELECT unnest(range(0, 20)) AS n, unnest(['zero','uno','due','tre','quattro','cinque','sei','sette','otto','nove','dieci','undici','dodici','tredici','quattordici','quindici','sedici','diciassette','diciotto','diciannove']) AS w)),
     tens(n, w) AS (SELECT CAST(n AS BIGINT), w FROM (SELECT unnest(range(2, 10)) AS n, unnest(['vent','trent','quarant','cinquant','sessant','settant','ottant','novant']) AS w)),
     hundred(n, w) AS (SELECT n, w FROM small UNION ALL
        SELECT t.n * 10 + u.n, CASE WHEN u.n IN (1, 8) THEN t.w || u.w ELSE t.w || CASE WHEN t.n = 2 THEN 'i' ELSE 'a' END || CASE WHEN u.n = 0 THEN '' ELSE u.w END END FROM tens t, small u WHERE u.n < 10),
     thousand(n, w) AS (SELECT n, w FROM hundred UNION ALL
        SELECT h.n * 100 + r.n, replace(replace(CASE WHEN h.n = 1 THEN '' ELSE h.w END || 'cento' || CASE WHEN r.n = 0 THEN '' ELSE r.w END, 'oo', 'o'), 'ao', 'o') FROM small h, hundred r WHERE h.n BETWEEN 1 AND 9),
"""
WORDS_SQL = """,
     words AS (SELECT k.n, CASE WHEN k.n // 1000 = 0 THEN r.w WHEN k.n // 1000 = 1 THEN 'mille' || CASE WHEN r.n = 0 THEN '' ELSE r.w END ELSE q.w || 'mila' || CASE WHEN r.n = 0 THEN '' ELSE r.w END END AS w
               FROM keys k JOIN thousand q ON q.n = k.n // 1000 JOIN thousand r ON r.n = k.n % 1000)
"""
ACCENTED_SQL = "SELECT n, CASE WHEN w LIKE '%tre' AND length(w) > 3 THEN regexp_replace(w, 'tre$', 'tré') ELSE w END AS words FROM words"


@query(SMALL_SQL + "     keys AS (SELECT DISTINCT o_orderkey AS n FROM orders)" + WORDS_SQL + ACCENTED_SQL)
def number_words(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Italian words of all order keys."""
    return table(spark, sf_dir, "orders").select(F.col("o_orderkey").alias("n")).distinct().select("n", cardinal(F.col("n").cast("string")).alias("words"))


#: Cardinals of any size, of the strings of digits in `keys`: the part below a million and those of every scale, joined by commas and at last by e.
LONG_WORDS_SQL = f""",
     sized AS (SELECT m, ltrim(m, '0') AS d, greatest(2, (length(ltrim(m, '0')) + 2) // 3) AS size FROM keys),
     grouped AS (SELECT m, size, p, CAST(substr(lpad(d, CAST(3 * size AS INTEGER), '0'), CAST(3 * (size - p) - 2 AS INTEGER), 3) AS BIGINT) AS n FROM (SELECT *, unnest(range(0, size)) AS p FROM sized WHERE length(d) BETWEEN 1 AND {MOST_DIGITS})),
     low AS (SELECT lo.m, CASE hi.n WHEN 0 THEN '' WHEN 1 THEN 'mille' ELSE h.w || 'mila' END || CASE lo.n WHEN 0 THEN '' ELSE l.w END AS w
             FROM grouped lo JOIN grouped hi ON hi.m = lo.m AND hi.p = 1 JOIN thousand h ON h.n = hi.n JOIN thousand l ON l.n = lo.n WHERE lo.p = 0),
     scaled AS (SELECT g.m, g.p, CASE WHEN g.n = 1 THEN 'un ' || s ELSE t.w || ' ' || left(s, -1) || 'i' END AS w
                FROM (SELECT *, {SCALES!r}[p - 1] AS s FROM grouped WHERE p > 1 AND n > 0) g JOIN thousand t ON t.n = g.n),
     parts AS (SELECT m, list(w ORDER BY p DESC) AS ws FROM (SELECT m, 0 AS p, w FROM low WHERE w <> '' UNION ALL SELECT * FROM scaled) GROUP BY m),
     joined AS (SELECT m, CASE WHEN len(ws) = 1 THEN ws[1] ELSE array_to_string(ws[:len(ws) - 1], ', ') || ' e ' || ws[len(ws)] END AS w FROM parts),
     named AS (SELECT k.m, CASE WHEN d = '' THEN 'zero' WHEN w IS NULL THEN k.m WHEN w LIKE '%tre' AND length(w) > 3 THEN regexp_replace(w, 'tre$', 'tré') ELSE w END AS words FROM sized k LEFT JOIN joined j ON j.m = k.m)
"""


@query(SMALL_SQL + r"     keys AS (SELECT DISTINCT m FROM (SELECT unnest(regexp_extract_all(text, '\b[0-9]+\b')) AS m FROM {units} k0) k1)" + LONG_WORDS_SQL + r""",
     p AS (SELECT transcript_id, tu_id, regexp_extract_all(text, '\b[0-9]+\b') AS ms, string_split_regex(text, '\b[0-9]+\b') AS gaps FROM {units} u),
     i AS (SELECT *, unnest(range(1, len(gaps) + 1)) AS j FROM p),
     x AS (SELECT i.transcript_id, i.tu_id, i.j, len(ms) AS n, gaps[i.j] || coalesce(named.words, '') AS piece FROM i LEFT JOIN named ON named.m = ms[i.j])
SELECT transcript_id, tu_id, string_agg(piece, '' ORDER BY j) AS new_text, CAST(max(n) AS BIGINT) AS changes FROM x GROUP BY 1, 2
""")
def norm_numbers(spark: SparkSession, sf_dir: str) -> DataFrame:
    return one(spark, sf_dir, 12)


def inner_sql(source: str, pattern: str) -> str:
    """SQL that takes a space after the first and before the last character out of every match of `pattern` in `t`, and counts them."""
    return rf"""
SELECT transcript_id, tu_id, trim(string_agg(gap || coalesce(short, ''), '' ORDER BY j)) AS t, CAST(max(n) + coalesce(sum(length(span) - length(short)), 0) AS BIGINT) AS n
FROM (SELECT *, regexp_replace(regexp_replace(span, '^(.) ', '\1', 's'), ' (.)$', '\1', 's') AS short
      FROM (SELECT transcript_id, tu_id, n, unnest(range(1, len(gaps) + 1)) AS j, unnest(gaps) AS gap, unnest(spans) AS span
            FROM (SELECT transcript_id, tu_id, n, string_split_regex(t, '{pattern}') AS gaps, regexp_extract_all(t, '{pattern}') AS spans FROM ({source}))))
GROUP BY transcript_id, tu_id
"""


INNER_SQL = inner_sql(inner_sql("SELECT transcript_id, tu_id, text AS t, CAST(0 AS BIGINT) AS n FROM {units} u", "°[^°]+°"), PACE)


@query(f"SELECT transcript_id, tu_id, t AS new_text, n AS changes FROM ({INNER_SQL})")
def norm_inner_spaces(spark: SparkSession, sf_dir: str) -> DataFrame:
    return one(spark, sf_dir, 13, 14)


@query(steps_sql([(r"([.,?])([:-~])", r"\2\1")], [TRIM]))
def norm_switches(spark: SparkSession, sf_dir: str) -> DataFrame:
    return one(spark, sf_dir, 15)


@query(steps_sql([(r"(\[)(\(\([^()]*\)\))", r"\2 \1"), (rf"([(<>°])({EITHER})", r"\2 \1"), (r"(\(\([^()]*\)\))(])", r"\2 \1"), (rf"({EITHER})([)><°])", r"\2 \1")], [TRIM]))
def norm_switched_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    return one(spark, sf_dir, 16)


@query(steps_sql([(r"\[\s*\]|\(\s*\)|<\s*>|>\s*<|°\s*°", "")], [(" {2,}", " "), TRIM]))
def norm_empty_spans(spark: SparkSession, sf_dir: str) -> DataFrame:
    return one(spark, sf_dir, 18)


@query(r"""
SELECT transcript_id, tu_id, CASE WHEN e THEN '' ELSE text END AS new_text, CAST(CASE WHEN e THEN 1 ELSE 0 END AS BIGINT) AS changes
FROM (SELECT *, regexp_replace(text, '[\[\]()<>°\-''#\s]', '', 'g') = '' AS e FROM {units} u)
""")
def norm_empty_unit(spark: SparkSession, sf_dir: str) -> DataFrame:
    return one(spark, sf_dir, 19)


@query(r"""
SELECT transcript_id, tu_id, length(regexp_replace(text, '[^°]', '', 'g')) % 2 = 1 AS dots,
       NOT regexp_matches(text, '^([^<>]*(<[^<>]*>|>[^<>]*<))*[^<>]*$') AS pace,
       NOT regexp_matches(regexp_replace(text, '\(\([^()]*\)\)|\(\.\)', '_', 'g'), '^[^()]*(\([^()]*\)[^()]*)*$') AS guess,
       NOT regexp_matches(text, '^[^\[\]]*(\[[^\[\]]*\][^\[\]]*)*$') AS overlap
FROM {units} u
""")
def err_balance(spark: SparkSession, sf_dir: str) -> DataFrame:
    df = apply_checks(units(spark, sf_dir))
    return df.select("transcript_id", "tu_id", F.col("e_UNBALANCED_DOTS").alias("dots"), F.col("e_UNBALANCED_PACE").alias("pace"), F.col("e_UNBALANCED_GUESS").alias("guess"), F.col("e_UNBALANCED_OVERLAP").alias("overlap"))


#: The queries of the rules in their order, and the count that each adds to.
CHAIN = [
    ("norm_symbols", "SYMBOL_NOT_ALLOWED"), ("norm_metatags", "META_TAGS"), ("norm_spaces", "UNEVEN_SPACES"), ("norm_trim_pauses", "TRIM_PAUSES"), ("norm_trim_links", "TRIM_PROSODICLINKS"),
    ("norm_links", "UNEVEN_SPACES"), ("norm_prolongations", "OVERLAP_PROLONGATION"), ("norm_multispace", "MULTIPLE_SPACES"), ("norm_accents", "ACCENTS"), ("norm_word_corrections", "WORD_CORRECTIONS"),
    ("norm_numbers", "NUMBERS"), ("norm_inner_spaces", "UNEVEN_SPACES"), ("norm_switches", "SWITCHES"), ("norm_switched_events", "SWITCHES"), ("norm_spaces", "UNEVEN_SPACES"),
    ("norm_empty_spans", "EMPTY_SPANS"), ("norm_empty_unit", "EMPTY_UNIT"),
]


def chain_sql(source: str) -> str:
    """The SQL of every rule on what the one before it left, from (transcript_id, tu_id, text): the last text, counts w_ and errors e_."""
    over = lambda name, rows: ORACLE_SQL[name].replace(f"({UNITS_SQL})", rows)
    before = lambda k: f"(SELECT transcript_id, tu_id, new_text AS text FROM r{k})"
    steps = [f"r{k} AS MATERIALIZED ({over(name, before(k - 1) if k else f'({source})')})" for k, (name, _) in enumerate(CHAIN)]
    counts = [f"{' + '.join(f'r{k}.changes' for k, (_, n) in enumerate(CHAIN) if n == name)} AS w_{name}" for name in NAMES]
    last = len(CHAIN) - 1
    joins = " ".join(f"JOIN r{k} USING (transcript_id, tu_id)" for k in range(1, last + 1))
    errors = [f"e.{c} AS e_UNBALANCED_{c.upper()}" for c in ("dots", "pace", "guess", "overlap")]
    return f"WITH {', '.join(steps)} SELECT transcript_id, tu_id, r{last}.new_text AS text, {', '.join(counts + errors)} FROM r0 {joins} JOIN ({over('err_balance', before(last))}) e USING (transcript_id, tu_id)"


@query(f"SELECT x.*, u.speaker FROM ({chain_sql('SELECT transcript_id, tu_id, text FROM {units} s')}) x JOIN {{units}} u USING (transcript_id, tu_id)")
def norm_full(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every rule in order, with its counts and the errors left."""
    return normalize(units(spark, sf_dir).drop("start_ms", "end_ms"))


@query(f"SELECT transcript_id AS doc_id, length(text) AS length, {', '.join('w_' + n for n in NAMES)} FROM ({chain_sql('SELECT doc_id AS transcript_id, 0 AS tu_id, text FROM documents')})")
def norm_documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The whole chain over long texts; the size of the new text and all counts."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    characters = docs.agg(F.coalesce(F.sum(F.length("text")), F.lit(0))).first()[0]
    # a file of few row groups would be few tasks, each of minutes
    df = normalize(docs.repartition(max(spark.sparkContext.defaultParallelism, -(-characters // CHARACTERS)), "doc_id"))
    return df.select("doc_id", F.length("text").cast("long").alias("length"), *[f"w_{n}" for n in NAMES])


#: Units as they come to the rules: without white space at the ends and without the mark of variation.
BEFORE_SQL = r"""
SELECT transcript_id, tu_id, variation, stripped = '' AS blank, CASE variation WHEN 'all' THEN regexp_replace(substr(stripped, 3), '^\s+', '') WHEN 'unspecified' THEN regexp_replace(substr(stripped, 2), '^\s+', '') ELSE stripped END AS text
FROM (SELECT *, CASE WHEN stripped LIKE '#\_%' ESCAPE '\' THEN 'all' WHEN stripped LIKE '# %' THEN 'unspecified' ELSE 'none' END AS variation
      FROM (SELECT transcript_id, tu_id, regexp_replace(text, '^\s+|\s+$', '', 'g') AS stripped FROM {units} w) v)
"""
#: Letters as DuckDB's word edges know them: any capital is A, any other letter beyond ASCII is a.
ASCII_SQL = r"regexp_replace(regexp_replace(replace(text, '°', ' '), '[ÀÈÉÌÒÓÙ]', 'A', 'g'), '[^\x00-\x7F]', 'a', 'g')"


@query(rf"""
SELECT transcript_id, tu_id, include, variation, text, if(usable AND NOT pace AND contains(text, '<'), len(regexp_extract_all(text, '<[^<>]*>')), 0) AS slow,
       if(usable AND NOT pace AND contains(text, '<'), len(regexp_extract_all(text, '>[^<>]*<')), 0) AS fast, if(usable AND NOT dots, len(regexp_extract_all(text, '°[^°]+°')), 0) AS low,
       if(usable, len(regexp_extract_all({ASCII_SQL}, '\b[A-Z]+(?:\s+[A-Z]+)*\b')), 0) AS high, if(usable AND NOT overlap, len(regexp_extract_all(text, '\[[^\]]+\]')), 0) AS overlap_spans,
       if(usable AND NOT guess, len(gaps) - 1 - reduced, 0) AS guess_spans, if(usable AND NOT guess, reduced, 0) AS reduction_spans
FROM (SELECT *, (SELECT count(*) FROM (SELECT unnest(gaps[:-2]) AS g, unnest(gaps[2:]) AS h) WHERE regexp_matches(g, '\p{{L}}$') AND regexp_matches(h, '^\p{{L}}')) AS reduced
      FROM (SELECT *, include AND variation <> 'all' AS usable, string_split_regex(regexp_replace(text, '\(\([^()]*\)\)|\(\.\)', '_', 'g'), '\([^)]+\)') AS gaps
            FROM (SELECT transcript_id, tu_id, b.variation, NOT blank AND (b.variation = 'all' OR x.text <> '') AS include, CASE WHEN blank OR b.variation = 'all' OR x.text = '' THEN b.text ELSE x.text END AS text,
                         e_UNBALANCED_PACE AS pace, e_UNBALANCED_DOTS AS dots, e_UNBALANCED_GUESS AS guess, e_UNBALANCED_OVERLAP AS overlap
                  FROM ({BEFORE_SQL}) b JOIN ({chain_sql(f'SELECT transcript_id, tu_id, text FROM ({BEFORE_SQL}) s')}) x USING (transcript_id, tu_id))))
""")
def units_prepared(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Units with their variation, whether they count, and how many spans of each kind they have."""
    df = prepare(timed(spark, sf_dir))
    return df.select("transcript_id", "tu_id", "include", "variation", "text", *[F.size(c).alias(c) for c in ("slow", "fast", "low", "high", "overlap_spans", "guess_spans", "reduction_spans")])


@query("""
SELECT c_custkey AS id, c_mktsegment AS speaker,
       CASE WHEN c_mktsegment = 'MACHINERY' THEN 'ignored' WHEN c_mktsegment = 'BUILDING' OR c_mktsegment LIKE '%HOLD' THEN 'translation' ELSE 'unit' END AS target
FROM customer
""")
def tu_scan_route(spark: SparkSession, sf_dir: str) -> DataFrame:
    df = table(spark, sf_dir, "customer").select(F.col("c_custkey").alias("id"), F.col("c_mktsegment").alias("speaker"))
    return route(df, ["MACHINERY"], ["BUILDING"], "HOLD")

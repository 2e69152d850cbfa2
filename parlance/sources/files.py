"""Readers and writers of the file formats, on Spark's own sources."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from parlance.functions import fields as X
from parlance.operators.metadata import last_by_code
from parlance.operators.units import parent_id, route

UNIT = "tu_id string, speaker string, start string, end string, duration string, text string"


def transcript_id(path=None):
    """The file's name up to its first dot. Spark gives names as in a URL."""
    if path is None:
        path = F.url_decode(F.replace(F.input_file_name(), F.lit("+"), F.lit("%2B")))
    return F.regexp_extract(path, r"([^/.]+)[^/]*$", 1)


def there(spark: SparkSession, path: str) -> bool:
    """Whether a path or a glob has files, on whatever file system it names."""
    place = spark._jvm.org.apache.hadoop.fs.Path(path)
    found = place.getFileSystem(spark._jsc.hadoopConfiguration()).globStatus(place)
    return found is not None and len(found) > 0


def read_table(spark: SparkSession, path: str, sep: str = "\t") -> DataFrame:
    """A delimited file with a header, all text: the byte order mark and blanks around names are cut, empty values stay empty. Adds transcript_id and line."""
    df = spark.read.csv(path, sep=sep, header=True, quote='"', escape='"', multiLine=True, encoding="UTF-8", nullValue="\x00", emptyValue="", inferSchema=False)
    names = [c.strip().lstrip("﻿").strip('"') for c in df.columns]
    df = df.toDF(*names)
    # a file that has quoted line ends is read by one task, so its rows keep their order
    return df.withColumns({"transcript_id": transcript_id(), "line": F.monotonically_increasing_id()})


def read_units(spark: SparkSession, path: str, ignore: list[str] = (), extract: list[str] = (), suffix: str = "") -> DataFrame:
    """Utterance tables: typed, with `target` unit, translation or ignored."""
    df = read_table(spark, path)
    parent = parent_id(F.col("parent_tu_id")) if "parent_tu_id" in df.columns else F.lit(None).cast("int")
    df = df.select("transcript_id", "line", F.col("tu_id").cast("int").alias("tu_id"), "speaker", F.col("start").cast("double").alias("start"), F.col("end").cast("double").alias("end"), F.col("duration").cast("double").alias("duration"), F.coalesce("text", F.lit("")).alias("text"), parent.alias("parent_tu_id"))
    return route(df, ignore, extract, suffix)


#: What is read of an ELAN document.
EAF = """
TIME_ORDER struct<TIME_SLOT array<struct<_TIME_SLOT_ID string, _TIME_VALUE string>>>,
TIER array<struct<_TIER_ID string, ANNOTATION array<struct<
    ALIGNABLE_ANNOTATION struct<_ANNOTATION_ID string, _TIME_SLOT_REF1 string, _TIME_SLOT_REF2 string, ANNOTATION_VALUE string>,
    REF_ANNOTATION struct<_ANNOTATION_ID string, _ANNOTATION_REF string, ANNOTATION_VALUE string>>>>>
"""


def read_eaf(spark: SparkSession, path: str) -> DataFrame:
    """ELAN files: rows (transcript_id, tu_id, old_id, speaker, start, end, duration, text, parent_tu_id), ids from 0 by start, then order of tiers and annotations. A blank start counts as 0; a file that isn't XML is an error. A file is one row until it is parsed."""
    options = {"ignoreSurroundingSpaces": "false", "mode": "FAILFAST"}
    text = F.regexp_replace("value", "^\ufeff", "")
    raw = spark.read.text(path, wholetext=True).select(transcript_id().alias("transcript_id"), F.from_xml(text, EAF, options).alias("x"))
    slots = raw.select("transcript_id", F.explode("x.TIME_ORDER.TIME_SLOT").alias("s")).select("transcript_id", F.col("s._TIME_SLOT_ID").alias("slot"), F.nullif(F.trim("s._TIME_VALUE"), F.lit("")).cast("long").alias("ms"))
    tiers = raw.select("transcript_id", F.posexplode("x.TIER").alias("tier", "t"))
    notes = tiers.select("transcript_id", "tier", F.col("t._TIER_ID").alias("speaker"), F.posexplode("t.ANNOTATION").alias("n", "o"))
    own, other = "o.ALIGNABLE_ANNOTATION", "o.REF_ANNOTATION"
    either = lambda c: F.coalesce(f"{own}.{c}", f"{other}.{c}")
    rows = notes.select("transcript_id", "tier", "n", "speaker", either("_ANNOTATION_ID").alias("id"), F.col(f"{own}._TIME_SLOT_REF1").alias("a"), F.col(f"{own}._TIME_SLOT_REF2").alias("b"), F.nullif(F.col(f"{other}._ANNOTATION_REF"), F.lit("")).alias("ref"), F.coalesce(either("ANNOTATION_VALUE"), F.lit("")).alias("raw"))
    for side, name in (("a", "start"), ("b", "end")):
        rows = rows.join(slots.select("transcript_id", F.col("slot").alias(side), (F.col("ms") / 1000).alias(name)), ["transcript_id", side], "left").drop(side)
    # an annotation of a child tier has the times of the one it refers to
    times = rows.select("transcript_id", F.col("id").alias("ref"), F.col("start").alias("rs"), F.col("end").alias("re"))
    rows = rows.join(times, ["transcript_id", "ref"], "left").withColumns({"start": F.coalesce("start", "rs", F.lit(0.0)), "end": F.coalesce("end", "re", F.lit(0.0))})
    rows = rows.withColumn("tu_id", F.row_number().over(Window.partitionBy("transcript_id").orderBy("start", "tier", "n")) - 1)
    parents = rows.select("transcript_id", F.col("id").alias("ref"), F.col("tu_id").alias("parent_tu_id"))
    return rows.join(parents, ["transcript_id", "ref"], "left").select(
        "transcript_id", "tu_id", F.nullif(F.regexp_extract("raw", r"^id:(\d+) ", 1), F.lit("")).cast("int").alias("old_id"), "speaker", "start", "end", F.round(F.col("end") - F.col("start"), 3).alias("duration"),
        F.regexp_replace("raw", r"^id:\d+ ", "").alias("text"), "parent_tu_id",
    )


def remapped_pairs(pairs: DataFrame, units: DataFrame) -> DataFrame:
    """Ignored pairs (transcript_id, u, v) of ids that annotations were given before, as the ids that they have now."""
    now = units.where("old_id is not null").select("transcript_id", "old_id", "tu_id")
    for c in ("u", "v"):
        pairs = pairs.join(now.select("transcript_id", F.col("old_id").alias(c), F.col("tu_id").alias("__n")), ["transcript_id", c], "left").withColumn(c, F.coalesce("__n", c)).drop("__n")
    return pairs.select("transcript_id", "u", "v")


def read_lines(spark: SparkSession, path: str) -> DataFrame:
    """The lines of files as they are: rows (transcript_id, line, raw, eol), raw with its line end, eol the file's (`\\r\\n` where it has one at all). A file is one row until it is split."""
    whole = spark.read.text(path, wholetext=True).withColumns({"transcript_id": transcript_id(), "eol": F.when(F.contains("value", F.lit("\r\n")), "\r\n").otherwise("\n")})
    return whole.select("transcript_id", "eol", F.posexplode(F.regexp_extract_all("value", F.lit(r"[^\n]*\n|[^\n]+$"), F.lit(0))).alias("line", "raw")).select("transcript_id", "line", "raw", "eol")


def read_vert(spark: SparkSession, path: str) -> DataFrame:
    return read_table(spark, path)


def read_linear(spark: SparkSession, path: str) -> DataFrame:
    """Text of `speaker<tab>text` lines; a line without a tab is said by `???`."""
    df = spark.read.text(path).withColumns({"transcript_id": transcript_id(), "line": F.monotonically_increasing_id()}).where("trim(value) <> ''")
    parts = F.split("value", "\t", 2)
    return df.select("transcript_id", "line", F.when(F.size(parts) == 2, parts[0]).otherwise("???").alias("speaker"), F.element_at(parts, -1).alias("text"))


def read_translations(spark: SparkSession, path: str) -> DataFrame:
    """Translations from .json or a delimited table, those with text."""
    if path.endswith(".json"):
        df = spark.read.schema("tu_id int, speaker string, start double, end double, parent_tu_id int, text string").json(path, multiLine=True).withColumn("transcript_id", transcript_id())
    else:
        df = read_table(spark, path).withColumn("parent_tu_id", parent_id(F.col("parent_tu_id")))
    return df.where("trim(coalesce(text, '')) <> ''")


def read_metadata(spark: SparkSession, path: str, unique: bool = False) -> DataFrame:
    """A metadata table; an absent file has no rows. `unique`: of equal codes the last."""
    if not there(spark, path):
        return spark.createDataFrame([], "code string, line long")
    df = read_table(spark, path).drop("transcript_id")
    return last_by_code(df) if unique else df


def read_conllu(spark: SparkSession, path: str) -> DataFrame:
    """CoNLL-U tokens with their sentence's comments: rows (transcript_id, sent, sent_id, text, jefferson_text, speaker_id, idx, 10 fields). Rows of fewer fields are left out."""
    # either line end; a file is one row until it is split
    whole = spark.read.text(path, wholetext=True).withColumns({"transcript_id": transcript_id(), "value": F.regexp_replace("value", "\r\n?", "\n")})
    raw = whole.select("transcript_id", F.posexplode(F.split("value", r"\n[ \t]*\n+")).alias("sent", "value")).withColumn("sent", F.col("sent").cast("long")).where("trim(value) <> ''")
    said = lambda k: F.regexp_extract("value", rf"(?m)^# {k} = (.*)$", 1).alias(k)
    names = ["id", "form", "lemma", "upos", "xpos", "feats", "head", "deprel", "deps", "misc"]
    lines = raw.select("transcript_id", "sent", said("sent_id"), said("text"), said("jefferson_text"), said("speaker_id"), F.posexplode(F.filter(F.split("value", "\n"), lambda x: ~x.startswith("#") & (x != ""))).alias("idx", "x"))
    parts = F.split("x", "\t")
    return lines.where(F.size(parts) >= 10).select("transcript_id", "sent", "sent_id", "text", "jefferson_text", "speaker_id", "idx", *[parts[k].alias(n) for k, n in enumerate(names)])


def speakers(vert: DataFrame) -> DataFrame:
    return vert.select("transcript_id", F.trim("speaker").alias("speaker")).where("speaker <> ''").distinct()


def write_table(df: DataFrame, path: str, by: str = "transcript_id", order: list[str] = (), sep: str = "\t", drop: list[str] = ()) -> None:
    """A folder of delimited text for each value of `by`; each value is one file, in order. Columns of the order that are in `drop` aren't written."""
    filled = df.select(*[c if c in (by, *order) else X.or_missing(F.col(c).cast("string")).alias(c) for c in df.columns])
    filled.repartition(by).sortWithinPartitions(by, *order).drop(*drop).write.mode("overwrite").partitionBy(by).csv(path, sep=sep, header=True, quote='"', escape='"')


def write_texts(df: DataFrame, path: str, by: str = "transcript_id", order: list[str] = (), text: str = "text") -> None:
    """A folder of text for each value of `by`."""
    df.select(by, *order, text).repartition(by).sortWithinPartitions(by, *order).drop(*order).write.mode("overwrite").partitionBy(by).text(path)

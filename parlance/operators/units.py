"""Transcription units: routing of tiers, preparation, span extraction.

A unit is a row (transcript_id, tu_id, speaker, start, end, text). Preparation adds: original, text
(normalised), include, variation (none, all, unspecified), the rule columns of `normalize`, and the
span lists slow, fast, low, high, overlap_spans, guess_spans, reduction_spans.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from parlance.functions.matches import SPANS, spans
from parlance.operators.normalize import ERRORS, NAMES, masked, normalize, trimmed

KEYS = ["transcript_id", "tu_id"]


def route(tiers: DataFrame, ignore: list[str] = (), extract: list[str] = (), suffix: str = "") -> DataFrame:
    """Adds `target`: unit, translation or ignored, by the speaker's tier. Ignored tiers come first."""
    to_side = F.col("speaker").isin(list(extract)) if extract else F.lit(False)
    if suffix:
        to_side = to_side | F.col("speaker").endswith(suffix)
    ignored = F.col("speaker").isin(list(ignore)) if ignore else F.lit(False)
    return tiers.withColumn("target", F.when(ignored, "ignored").when(to_side, "translation").otherwise("unit"))


def parent_id(raw: Column) -> Column:
    """The parent's id; null for `_`, blanks and what isn't a number."""
    return F.when(F.trim(raw).rlike(r"^-?\d+$"), F.trim(raw)).cast("int")


def candidate(text: Column, s: Column, e: Column) -> Column:
    """A bracket with letters right before and after it: perhaps a reduction, not a guess."""
    letter = lambda at: F.substring(text, at, F.lit(1)).rlike(r"^\p{L}$")
    return (s > 0) & (e < F.length(text)) & letter(s) & letter(e + 1)


def with_spans(df: DataFrame) -> DataFrame:
    """The span lists of the normalised text. A kind whose marks aren't balanced has none."""
    text, none = F.col("text"), F.array().cast(SPANS)
    usable = F.col("include") & (F.col("variation") != "all")
    def of(mark: str, fault: str, pattern: str, source: Column = text) -> Column:
        return F.when(usable & text.contains(mark) & ~F.col(f"e_{fault}"), spans(source, pattern)).otherwise(none)
    capitals = "A-ZÀÈÉÌÒÓÙ"
    df = df.withColumns({
        "slow": of("<", "UNBALANCED_PACE", "<[^<>]*>"),
        "fast": of("<", "UNBALANCED_PACE", ">[^<>]*<"),
        "low": of("°", "UNBALANCED_DOTS", "°[^°]+°"),
        "high": F.when(usable & text.rlike(f"[{capitals}]"), spans(text, rf"(?U)\b[{capitals}]+(?:\s+[{capitals}]+)*\b")).otherwise(none),
        "overlap_spans": of("[", "UNBALANCED_OVERLAP", r"\[[^\]]+\]"),
        "brackets": of("(", "UNBALANCED_GUESS", r"\([^)]+\)", masked(text)),
    })
    return df.withColumns({
        "reduction_spans": F.filter("brackets", lambda x: candidate(text, x["s"], x["e"])),
        "guess_spans": F.filter("brackets", lambda x: ~candidate(text, x["s"], x["e"])),
    }).drop("brackets")


def prepare(units: DataFrame, config: dict[str, bool] | None = None) -> DataFrame:
    """Normalise the units and extract their spans. Blank units, and units of nothing but marks, aren't included."""
    stripped = trimmed(F.coalesce(F.col("text"), F.lit("")))
    variation = F.when(F.col("stripped").startswith("#_"), "all").when(F.col("stripped").startswith("# "), "unspecified").otherwise("none")
    body = F.when(F.col("variation") == "all", trimmed(F.substring("stripped", 3, 2**30))).when(F.col("variation") == "unspecified", trimmed(F.substring("stripped", 2, 2**30))).otherwise(F.col("stripped"))
    df = units.withColumns({"original": F.col("text"), "stripped": stripped}).withColumn("variation", variation).withColumn("before", body).withColumn("text", F.col("before"))
    df = normalize(df, "text", config)
    skipped = (F.col("stripped") == "") | (F.col("variation") == "all")
    included = (F.col("stripped") != "") & ((F.col("variation") == "all") | (F.col("text") != ""))
    df = df.withColumns(
        {f"w_{n}": F.when(skipped, F.lit(0).cast("long")).otherwise(F.col(f"w_{n}")) for n in NAMES}
        | {f"e_{c.name}": F.col(f"e_{c.name}") & ~skipped for c in ERRORS}
        # an excluded unit keeps the text it came with
        | {"include": included, "text": F.when(skipped | (F.col("text") == ""), F.col("before")).otherwise(F.col("text"))}
    )
    return with_spans(df.drop("before", "stripped"))


def total_length(units: DataFrame) -> DataFrame:
    """Rows (transcript_id, tot_length): where the unit that starts last ends, of equal starts the one of the greatest id. Not the greatest end."""
    return units.groupBy("transcript_id").agg(F.max_by("end", F.struct("start", "tu_id")).alias("tot_length"))

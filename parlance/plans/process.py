"""The whole way from utterance tables to token tables and summaries, as one plan."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from parlance.operators import formats, overlaps, tokens, units
from parlance.operators.units import KEYS
from parlance.sources.config import load
from parlance.sources.work import written

#: Fixed value: characters of text whose transcripts one task puts together to summaries.
CHARACTERS = 4_000_000


def process(raw: DataFrame, config: dict | None = None, ignore: DataFrame | None = None, width: float | None = None) -> dict[str, DataFrame]:
    """Units, tokens, vert, summary, linear and translations of utterances (transcript_id, tu_id, speaker, start, end, text).

    `ignore`: pairs (transcript_id, u, v) of overlaps to leave out. Prepared units feed every result, so
    they are written to the work folder when this is called; the results are lazy. Times, variation and
    the texts of spans are joined to units, which are split into tokens last: tokens are never moved.
    """
    config = load() if config is None else config
    routed = units.route(raw, config["ignored_tiers"], config["extracted_tiers"], config["translation_suffix"]) if "target" not in raw.columns else raw
    ready = written(units.prepare(routed.where("target = 'unit'").drop("target"), config["normalization"]).withColumn("duration", F.col("end") - F.col("start")), "units")
    markers = tuple(config["variation_markers"])
    nvb, foreign = F.col("type") == "nonverbalbehavior", F.col("language").isNotNull()
    plain = tokens.tokenize(ready, markers=markers)
    each = plain.groupBy(*KEYS, "speaker", F.col("variation").alias("own")).agg(F.bool_and(nvb).alias("all_nvb"), F.bool_or(nvb).alias("any_nvb"), F.bool_and(foreign).alias("every"), F.bool_or(foreign).alias("some"), *formats.type_counts())
    told = written(each.select(*KEYS, "speaker", "all_nvb", "any_nvb", tokens.final_variation().alias("__v"), "tokens", *[f"tokens_{k}" for k in formats.TYPES]), "told")
    timed = ready.where("include").select(*KEYS, "start", "end", F.size("overlap_spans").alias("n_spans")).join(told.select(*KEYS, "all_nvb", "any_nvb"), KEYS)
    found = overlaps.resolve(written(timed, "timed"), config["duration_threshold"], config["nvb_participates"], ignore, width)
    final = told.select(*KEYS, "__v")
    said = ready.join(final, KEYS, "left").withColumn("variation", F.coalesce("__v", "variation")).drop("__v")
    # a nudged boundary is what the token table shows
    times = found["units"].select(*KEYS, F.col("start").alias("__s"), F.col("end").alias("__e"))
    marks = tokens.unit_marks(ready, config["reduction_words"], found["matches"], markers=markers)
    whole = ready.where("include").select(*KEYS, *tokens.UNIT_COLUMNS).join(times, KEYS, "left").join(final, KEYS, "left").join(marks, KEYS, "left")
    whole = whole.withColumns({"start": F.coalesce("__s", "start"), "end": F.coalesce("__e", "end")})
    own = tokens.with_marks(tokens.tokenize(whole, keep=[*tokens.UNIT_COLUMNS, "__v", "marks"], markers=markers))
    full, shown = own.drop("__v"), own.withColumn("variation", F.col("__v")).drop("__v")
    # times and texts of spans aren't in a summary, so it takes the tokens that units have without them
    tasks = max(ready.sparkSession.sparkContext.defaultParallelism, -(-ready.agg(F.coalesce(F.sum(F.length("text")), F.lit(0))).first()[0] // CHARACTERS))
    summary = formats.json_summary(ready, told.withColumnRenamed("__v", "variation"), plain, found["members"], tasks)
    return {
        "units": said, "tokens": full, "vert": formats.vert(shown), "overlaps": found["members"], "verdicts": found["verdicts"],
        "summary": summary, "linear": formats.linear_units(said, full), "translations": routed.where("target = 'translation' and trim(coalesce(text, '')) <> ''").drop("target"),
    }

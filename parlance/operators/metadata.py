"""Metadata tables: merging modules, translating values, and checking them against each other."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from parlance.functions.fields import codes, missing

PARTICIPANTS = ["code", "occupation", "gender", "conversations", "birth-region", "age-range", "study-level"]
CONVERSATIONS = ["code", "type", "duration", "participants-number", "participants", "participants-relationship", "moderator", "topic", "year", "collection-point", "unknown-participant"]
#: Tiers that aren't people.
PLACEHOLDERS = ["commenti", "suoni", "sottofondo", "gruppo", "video", "trad_video"]


def first_of(df: DataFrame, by: list[str], order: list[Column]) -> DataFrame:
    """One row for each key, the first in that order."""
    n = F.row_number().over(Window.partitionBy(*by).orderBy(*order))
    return df.withColumn("__n", n).where("__n = 1").drop("__n")


def aligned(df: DataFrame, columns: list[str], renames: dict[str, str] | None = None, subtypes: tuple[str, ...] = ()) -> DataFrame:
    """The columns of a target table: renamed where the target is absent, '' where there are none; `subtypes` lose what follows a colon."""
    for old, new in (renames or {}).items():
        if old in df.columns and new not in df.columns:
            df = df.withColumnRenamed(old, new)
    value = lambda c: F.coalesce(F.col(f"`{c}`"), F.lit("")) if c in df.columns else F.lit("")
    return df.select(*[(F.split(value(c), ":")[0] if c in subtypes else value(c)).alias(c) for c in columns])


def merged(modules: list[DataFrame], columns: list[str], renames: dict[str, str] | None = None, subtypes: tuple[str, ...] = (), key: str = "code", line: str = "line") -> DataFrame:
    """The modules' rows under one another, of equal codes the first by module and line. Modules have a line number."""
    parts = [aligned(m.drop(line), columns, renames, subtypes).withColumns({"__m": F.lit(k), "__l": F.lit(0)}) if line not in m.columns else aligned(m, [*columns, line], renames, subtypes).withColumn("__m", F.lit(k)).withColumnRenamed(line, "__l") for k, m in enumerate(modules)]
    return first_of(reduce(DataFrame.unionByName, parts), [key], [F.col("__m"), F.col("__l")]).drop("__m", "__l")


def last_by_code(df: DataFrame, line: str = "line", key: str = "code") -> DataFrame:
    """The lookup table of a metadata file: of equal codes the last."""
    return first_of(df, [key], [F.desc(line)])


def translated(df: DataFrame, dictionary: DataFrame, table: str, columns: list[str], separators: dict[str, str] | None = None) -> DataFrame:
    """Values replaced by the dictionary (table, column, en, it); unknown ones stay. `separators`: columns of several values.

    Where a value has several translations the last counts, by the dictionary's column `line`; without one the greatest.
    """
    rows = dictionary.where((F.col("table") == table) & F.col("en").isNotNull())
    rows = rows.groupBy("column", "en").agg(F.max_by("it", F.col("line") if "line" in dictionary.columns else F.col("it")).alias("it"))
    for column in columns:
        # Every distinct value once, in its parts, by an equal join with the dictionary; and back to the rows by the value.
        sep = (separators or {}).get(column)
        value = F.col(f"`{column}`").cast("string")
        parts = F.split("__value", sep) if sep else F.array("__value")
        words = rows.where(F.col("column") == column).select(F.col("en").alias("__part"), "it")
        each = df.select(value.alias("__value")).where("__value is not null").distinct().select("__value", F.posexplode(parts).alias("__at", "__part"))
        new = F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("__at", F.coalesce("it", "__part").alias("v")))), lambda x: x["v"]), sep or "")
        known = each.join(words, "__part", "left").groupBy("__value").agg(new.alias("__new"))
        df = df.join(known, value == F.col("__value"), "left").withColumn(column, F.col("__new")).drop("__value", "__new")
    return df


def untranslated(df: DataFrame, dictionary: DataFrame, table: str, columns: list[str]) -> DataFrame:
    """Rows (column, value) of values that the dictionary lacks; blanks aren't missed."""
    pairs = F.array(*[F.struct(F.lit(c).alias("column"), F.col(f"`{c}`").cast("string").alias("value")) for c in columns])
    found = df.select(F.explode(pairs).alias("x")).select("x.column", "x.value").where(~missing(F.col("value"))).distinct()
    known = dictionary.where(F.col("table") == table).select("column", F.col("en").alias("value"))
    return found.join(known, ["column", "value"], "left_anti")


def left_untranslated(df: DataFrame, dictionary: DataFrame, table: str, columns: list[str], separators: dict[str, str] | None = None) -> DataFrame:
    """Rows (column, value) of the parts of values that `translated` leaves whole as they are and that the dictionary lacks; blanks aren't missed."""
    separators = separators or {}
    both = translated(df.select(*[F.col(f"`{c}`").cast("string").alias(c) for c in columns], *[F.col(f"`{c}`").cast("string").alias(f"__was {c}") for c in columns]), dictionary, table, columns, separators)
    parts = lambda c: F.split(F.col(f"`__was {c}`"), separators[c]) if c in separators else F.array(F.col(f"`__was {c}`"))
    same = lambda c: F.when(F.col(f"`{c}`") == F.col(f"`__was {c}`"), parts(c)).otherwise(F.array().cast("array<string>"))
    named = lambda c: F.transform(same(c), lambda v: F.struct(F.lit(c).alias("column"), v.alias("value")))
    pairs = F.flatten(F.array(*map(named, columns)))
    found = both.select(F.explode(pairs).alias("x")).select("x.column", "x.value").where("value <> ''").distinct()
    known = dictionary.where(F.col("table") == table).select("column", F.col("en").alias("value")).distinct()
    return found.join(known, ["column", "value"], "left_anti")


def placeholder(speaker: Column) -> Column:
    return speaker.rlike(r"^\?+$") | F.lower(speaker).isin(PLACEHOLDERS)


def listed(df: DataFrame, column: str, name: str) -> DataFrame:
    """Rows (code, name): the codes in a `;` list."""
    return df.select("code", F.explode(codes(F.col(f"`{column}`"))).alias(name)).distinct()


def back_references(conversations: DataFrame, participants: DataFrame) -> DataFrame:
    """Rows (conversation, participant, problem): one lists the other, and not the other way round; or lists a code that isn't there."""
    here = listed(conversations, "participants", "participant").withColumnRenamed("code", "conversation")
    there = listed(participants, "conversations", "conversation").withColumnRenamed("code", "participant")
    people, talks = participants.select(F.col("code").alias("participant")).distinct(), conversations.select(F.col("code").alias("conversation")).distinct()
    told = lambda df, problem: df.select("conversation", "participant", F.lit(problem).alias("problem"))
    real = here.where(~placeholder(F.col("participant")))
    return (
        told(real.join(people, "participant", "left_anti"), "unknown participant")
        .unionByName(told(there.join(talks, "conversation", "left_anti"), "unknown conversation"))
        .unionByName(told(real.join(people, "participant", "left_semi").join(there, ["conversation", "participant"], "left_anti"), "not listed by participant"))
        .unionByName(told(there.join(talks, "conversation", "left_semi").join(here, ["conversation", "participant"], "left_anti"), "not listed by conversation"))
    )


def speaker_checks(conversations: DataFrame, speakers: DataFrame) -> DataFrame:
    """Rows (conversation, participant, problem) against the speakers (transcript_id, speaker) of token tables."""
    here = listed(conversations, "participants", "participant").withColumnRenamed("code", "conversation").where(~placeholder(F.col("participant")))
    spoken = speakers.select(F.col("transcript_id").alias("conversation"), F.trim("speaker").alias("participant")).where("participant <> ''").distinct().where(~placeholder(F.col("participant")))
    talks, files = conversations.select(F.col("code").alias("conversation")).distinct(), speakers.select(F.col("transcript_id").alias("conversation")).distinct()
    told = lambda df, problem: df.select("conversation", "participant", F.lit(problem).alias("problem"))
    absent = talks.join(files, "conversation", "left_anti").withColumn("participant", F.lit(None).cast("string"))
    return (
        told(absent, "no transcript")
        .unionByName(told(here.join(files, "conversation", "left_semi").join(spoken, ["conversation", "participant"], "left_anti"), "does not speak"))
        .unionByName(told(spoken.join(talks, "conversation", "left_semi").join(here, ["conversation", "participant"], "left_anti"), "speaks but is not listed"))
    )


def unregistered(speakers: DataFrame, participants: DataFrame) -> DataFrame:
    """Rows (conversation, participant, problem): who speaks somewhere and has no row among the participants; the conversation is null, as the problem is the person's."""
    spoken = speakers.select(F.trim("speaker").alias("participant")).where("participant <> ''").distinct().where(~placeholder(F.col("participant")))
    lost = spoken.join(participants.select(F.trim("code").alias("participant")).distinct(), "participant", "left_anti")
    return lost.select(F.lit(None).cast("string").alias("conversation"), "participant", F.lit("speaker without a row").alias("problem"))


def module_checks(conversations: DataFrame, participants: DataFrame, speakers: DataFrame) -> DataFrame:
    """Rows (conversation, participant, problem): all that is wrong with a module's metadata and its transcripts. Without participants, only what needs none is checked."""
    found = speaker_checks(conversations, speakers)
    if "conversations" not in participants.columns:
        return found
    return found.unionByName(unregistered(speakers, participants)).unionByName(back_references(conversations, participants))


def unknown_participant(conversations: DataFrame, speakers: DataFrame) -> DataFrame:
    """conversations with unknown-participant: yes where a placeholder of question marks speaks, no where none does, _ without a transcript."""
    has = speakers.groupBy(F.col("transcript_id").alias("code")).agg(F.bool_or(F.col("speaker").rlike(r"^\?+$")).alias("__has"))
    df = conversations.drop("unknown-participant").join(has, "code", "left")
    return df.withColumn("unknown-participant", F.when(F.col("__has"), "yes").when(~F.col("__has"), "no").otherwise("_")).drop("__has")

"""From CoNLL-U to the table that lemmas are edited in.

Token rows are (file, sent, idx, sent_id, jefferson_text, speaker_id, id, form, lemma, upos, misc), as
`read_conllu` gives them. Ids (KID) that are missing come from the parts of a range, or are counted
on from the last one known; parts of a word without a row of its own get a parent. The words of the
transcript are then dealt to the tokens of a sentence in order: a word that no token has is passed
over where the next one fits, parts of words have none, pauses that a token says are put in. The
ids, and what a sentence knows of itself (its ranges, its ids), are windows over sentences, and the
dealing is one fold for each sentence, so that tokens are shuffled once, by their sentence. The
fold only finds the words; what a row says is put together where it stands by itself.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from parlance.functions import fields as X
from parlance.functions.matches import let
from parlance.operators.patches import natural

FIELDS = ["token_id", "speaker", "tu_id", "unit", "id", "span", "form", "lemma", "upos", "jefferson_feats"]
#: The forms of the notation.
NUMBERED, LETTERED = r"^\d+-\d+$", r"^\d+-\d+[a-z]$"
TAG = r"^(?:\(\([A-Za-z][A-Za-z0-9_]*\)\)|\{[A-Za-z][A-Za-z0-9]*\})$"
ANY_TAG = r"^\(\(.*\)\)$|^\{.*\}$"
SAID_PAUSE = r"^(?:\(\.+\)|\(\d+[.,]\d+\))$"
SENTENCE = ["file", "sent"]


def approximate(word: Column) -> Column:
    """A word of a transcript as a form would have it: without marks of overlap, pace, volume, intonation, length and a link at its end; any number of x is one."""
    bare = F.lower(F.regexp_replace(F.translate(F.regexp_replace(F.translate(word, "[]()<>°", ""), "[.,?]+$", ""), ":", ""), "=+$", ""))
    return F.when(bare.rlike("^x+$"), "x").otherwise(bare)


def transcript_words(text: Column) -> Column:
    """The words of a transcript that tokens are made of: without bars and events, cut after an inner apostrophe or link."""
    words = F.filter(F.split(F.trim(F.coalesce(text, F.lit(""))), r"\s+"), lambda w: (w != "") & (w != "|") & ~w.rlike(r"^\(\(.*\)\)$"))
    return F.flatten(F.transform(words, X.split_words))


def split_id(kid: Column, part: int) -> Column:
    return F.regexp_extract(kid, r"^(\d+)-(\d+)$", part)


def identified(tokens: DataFrame) -> DataFrame:
    """Tokens with `kid`: their own, that of a range's first part, that of a part with a letter, or the last number known and how many are missing since. Adds `n`, the number of a token that isn't a range, and `note`."""
    by = Window.partitionBy(*SENTENCE).orderBy("idx")
    # a sentence's text goes on with its first token only
    tokens = tokens.withColumn("jefferson_text", F.when(F.row_number().over(by) == 1, F.col("jefferson_text")))
    df = tokens.withColumns({"kid": X.feat(F.col("misc"), "KID"), "n": F.when(F.col("id").rlike(r"^\d+$"), F.col("id").cast("int")), "is_range": F.col("id").rlike(NUMBERED)})
    # A range's parts follow it, so a stretch begins at every row that has no plain number.
    df = df.withColumn("stretch", F.sum(F.col("n").isNull().cast("int")).over(by.rowsBetween(Window.unboundedPreceding, 0)))
    own = Window.partitionBy(*SENTENCE, "stretch").orderBy("idx")
    head = F.first(F.struct("is_range", "id", "kid")).over(own)
    bound = lambda k: F.split(head["id"], "-")[k].cast("int")
    is_part = F.coalesce(head["is_range"] & F.col("n").isNotNull() & (F.max("n").over(own) <= bound(1)) & (F.col("n") >= bound(0)), F.lit(False))
    df = df.withColumns({"is_part": is_part, "head_kid": head["kid"]})
    whole = own.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    # of the first part only: it may have no id while a later one has
    first = F.nullif(F.first(F.when(F.col("is_part"), F.struct("kid")), ignorenulls=True).over(whole)["kid"], F.lit(""))
    place = F.sum(F.col("is_part").cast("int")).over(own.rowsBetween(Window.unboundedPreceding, 0)) - 1
    df = df.withColumns({"first": first, "place": place})
    lettered, open_ = F.col("first").rlike(LETTERED), F.col("head_kid").isNull() & F.col("first").isNotNull()
    letter = F.expr("repeat(char(97 + place % 26), cast(floor(place / 26) as int) + 1)")
    kid = F.when(F.col("is_range") & open_, F.when(lettered, F.regexp_replace("first", "[a-z]$", "")).otherwise(F.col("first"))).when(F.col("is_part") & open_ & ~lettered, F.concat("first", letter)).otherwise(F.col("kid"))
    df = df.withColumns({"kid": kid, "note": F.when(F.col("is_range") & open_ & ~lettered, F.lit("letters of parts made up"))})
    past = by.rowsBetween(Window.unboundedPreceding, -1)
    known = F.last(F.when(F.col("kid").rlike(NUMBERED), F.col("kid")), ignorenulls=True).over(past)
    since = F.col("idx") - F.coalesce(F.last(F.when(F.col("kid").isNotNull(), F.col("idx")), ignorenulls=True).over(past), F.min("idx").over(Window.partitionBy(*SENTENCE)) - 1)
    # idx may have gaps, so rows are counted by their place
    df = df.withColumn("idx", F.row_number().over(by)).withColumns({"__known": known, "__since": since})
    made = F.concat(F.coalesce(split_id(F.col("__known"), 1), F.split("sent_id", "_")[0]), F.lit("-"), (F.coalesce(split_id(F.col("__known"), 2).cast("long"), F.lit(-1)) + F.col("__since")).cast("string"))
    return df.withColumn("kid", F.coalesce("kid", made)).drop("stretch", "is_part", "head_kid", "first", "place", "__known", "__since")


def with_parents(tokens: DataFrame) -> DataFrame:
    """Rows in the order of emission, `seq` an array of (idx, 0 or 1): tokens with `is_sub`, and before the first of the parts that have neither a range nor a parent, a parent (`made`)."""
    base = F.when(F.col("kid").rlike(LETTERED), F.regexp_replace("kid", "[a-z]$", ""))
    whole = Window.partitionBy(*SENTENCE)
    df = tokens.withColumns({
        "base": base,
        "ranges": F.collect_set(F.when(F.col("is_range"), F.struct(F.split("id", "-")[0].cast("int").alias("a"), F.split("id", "-")[1].cast("int").alias("b")))).over(whole),
        "numbered": F.collect_set(F.when(F.col("kid").rlike(NUMBERED), F.col("kid"))).over(whole),
    })
    covered = F.coalesce(F.exists("ranges", lambda r: (r["a"] <= F.col("n")) & (F.col("n") <= r["b"])), F.lit(False))
    df = df.withColumn("covered", covered).withColumn("orphan", F.coalesce(F.col("base").isNotNull() & ~F.col("covered") & ~F.array_contains("numbered", F.col("base")), F.lit(False)))
    group = Window.partitionBy(*SENTENCE, "base")
    df = df.withColumns({
        "in_group": F.col("base").isNotNull() & F.max("orphan").over(group), "low": F.min(F.when(F.col("orphan"), F.col("n"))).over(group), "high": F.max(F.when(F.col("orphan"), F.col("n"))).over(group),
        "many": F.count(F.when(F.col("orphan"), F.col("n"))).over(group), "nth": F.row_number().over(group.orderBy("idx")),
    }).withColumns({"is_sub": F.col("covered") | F.col("in_group")})
    name = F.when(F.col("many") > 1, F.concat_ws("-", "low", "high")).otherwise(F.coalesce(F.col("low").cast("string"), F.lit("?")))
    blank = F.lit(X.MISSING)
    own = ["id", "kid", "form", "lemma", "upos", "misc", "is_sub", "is_range", "note"]
    token = F.struct(*own, F.lit(False).alias("made"))
    parent = {"id": name, "kid": F.col("base"), "form": blank, "lemma": blank, "upos": blank, "misc": blank, "is_sub": F.lit(False), "is_range": F.lit(True), "note": F.lit("parent made up")}
    parent = F.struct(*[parent[c].alias(c) for c in own], F.lit(True).alias("made"))
    each = F.explode(F.when(F.col("in_group") & (F.col("nth") == 1), F.array(parent, token)).otherwise(F.array(token)))
    return df.select(*SENTENCE, "sent_id", "jefferson_text", "speaker_id", "idx", each.alias("x")).select(*SENTENCE, "sent_id", "jefferson_text", "speaker_id", "idx", "x.*")


def dealt(rows: DataFrame) -> DataFrame:
    """Rows (file, sent, speaker_id, row, place): the words of a sentence dealt to its tokens, and pauses that tokens say."""
    misc = lambda k: X.feat(F.col("misc"), k)
    pause = F.col("form").isin("(.)", "{P}") | F.coalesce(misc("Type").isin("shortpause", "longpause"), F.lit(False))
    df = rows.withColumns({"pause": pause, "tag": F.col("form").rlike(ANY_TAG), "pauses": F.coalesce(misc("PauseAfter") == "Yes", F.lit(False)) & ~F.col("is_sub")})
    event, is_word = F.col("tag") & ~F.col("pause"), ~F.col("is_sub") & ~F.col("made") & ~F.col("pause") & ~F.col("tag")
    token = F.struct(
        "idx", F.when(F.col("made"), 0).otherwise(1).alias("after"), "id", "kid", "form", "lemma", "upos", "is_sub", "made", "is_range", "note", "pause", "tag", event.alias("event"), "pauses",
        is_word.alias("is_word"), F.lower("form").alias("near"), (F.col("pauses") & ~F.col("pause")).alias("says"),
    )
    sentences = df.groupBy(*SENTENCE).agg(F.first("speaker_id").alias("speaker_id"), F.first("jefferson_text", ignorenulls=True).alias("text"), F.array_sort(F.collect_list(token)).alias("tokens"))
    words = F.transform(transcript_words(F.col("text")), lambda w: F.struct(w.alias("w"), approximate(w).alias("near"), w.rlike(TAG).alias("tag"), w.rlike(SAID_PAUSE).alias("pause")))
    sentences = sentences.withColumn("words", words)
    # the first word at or after each place that is no tag
    plain = F.filter(F.transform("words", lambda w, i: F.when(~w["tag"], i)), lambda i: i.isNotNull())
    sentences = sentences.withColumn("plain", plain)
    sentences = sentences.withColumn("onward", F.transform("words", lambda w, i: F.coalesce(F.array_min(F.filter("plain", lambda p: p >= i)), F.size("words"))))
    word = lambda at: F.get("words", at)
    kind = dict(sentences.select(F.get("tokens", F.lit(0)).alias("t")).dtypes)["t"]
    item = f"struct<t:{kind},span:string,passed:string,silent:boolean>"
    start = F.struct(F.lit(0).alias("at"), F.lit(False).alias("paused"), F.array().cast(f"array<{item}>").alias("out"))

    def step(s: Column, t: Column) -> Column:
        repeated = t["pause"] & ~t["is_sub"] & s["paused"]
        at = F.when(t["is_sub"] | t["tag"], s["at"]).otherwise(F.coalesce(F.get("onward", s["at"]), s["at"]))

        def skipped(at: Column) -> Column:
            skips = F.coalesce(t["is_word"] & (at + 1 < F.size("words")) & (word(at)["near"] != t["near"]) & (word(at + 1)["near"] == t["near"]), F.lit(False))
            return let(F.struct(at.alias("at"), skips.alias("skips"), (at + skips.cast("int")).alias("here")), placed)

        def placed(x: Column) -> Column:
            span = F.when(t["is_sub"], X.MISSING).otherwise(F.coalesce(word(x["here"])["w"], F.lit(X.MISSING)))
            then = x["here"] + (~t["is_sub"]).cast("int")
            row = F.struct(t.alias("t"), span.alias("span"), F.when(x["skips"], word(x["at"])["w"]).alias("passed"), F.lit(False).alias("silent")).cast(item)

            def said(written: Column) -> Column:
                silence = F.struct(t.alias("t"), F.when(written, word(then)["w"]).otherwise("(.)").alias("span"), F.lit(None).cast("string").alias("passed"), F.lit(True).alias("silent")).cast(item)
                return F.struct((then + written.cast("int")).cast("int").alias("at"), t["pauses"].alias("paused"), F.concat(s["out"], F.array(row, silence)).alias("out"))

            silent = F.struct(then.cast("int").alias("at"), t["pauses"].alias("paused"), F.concat(s["out"], F.array(row)).alias("out"))
            return F.when(t["says"], let(F.coalesce(word(then)["pause"], F.lit(False)), said)).otherwise(silent)

        passed = F.struct(s["at"].alias("at"), F.lit(False).alias("paused"), s["out"].alias("out"))
        return F.when(repeated, passed).otherwise(let(at, skipped))

    each = sentences.select(*SENTENCE, "speaker_id", F.posexplode(F.aggregate("tokens", start, step, lambda s: s["out"])).alias("place", "x"))
    return each.select(*SENTENCE, "speaker_id", "place", shown(F.col("x.t"), F.col("x.span"), F.col("x.passed"), F.col("x.silent")).alias("row"))


def shown(t: Column, span: Column, passed: Column, silent: Column) -> Column:
    """What the row of a token says with this span, or that of the pause after it."""
    unit = F.when(t["kid"].contains("-"), F.split(t["kid"], "-")[0]).otherwise("")
    kind = F.when(silent, "pause").when(t["is_range"], "whole").when(t["is_sub"], "part").when(t["pause"], "pause").when(t["event"], "event").otherwise("word")
    fixed = F.when(kind == "pause", "[PAUSE]").when(kind == "event", "[NVB]")
    next_id = F.when(t["kid"].rlike(NUMBERED), F.concat(split_id(t["kid"], 1), F.lit("-"), (split_id(t["kid"], 2).cast("long") + 1).cast("string"))).otherwise(F.concat(unit, F.lit("-?")))
    return F.struct(
        F.when(silent, next_id).otherwise(t["kid"]).alias("token_id"), unit.alias("unit"), F.when(silent, X.MISSING).otherwise(t["id"]).alias("id"), kind.alias("kind"), span.alias("span"),
        F.when(t["made"] & ~silent, span).otherwise(F.coalesce(fixed, t["form"])).alias("form"), F.when(kind == "whole", X.MISSING).otherwise(F.coalesce(fixed, t["lemma"])).alias("lemma"),
        F.when(kind == "whole", X.MISSING).when(fixed.isNotNull(), "X").otherwise(t["upos"]).alias("upos"),
        F.when(silent, "").otherwise(F.concat_ws("; ", t["note"], F.when(passed.isNotNull(), F.concat(F.lit("word passed over: "), passed)))).alias("note"),
    )


def converted(tokens: DataFrame) -> DataFrame:
    """Rows (file, the FIELDS, note, sort): every file's table; `sort` is its order. `note` says what a person should look at."""
    part = F.col("row.kind") == "part"
    speaker = F.when(part, X.MISSING).otherwise(F.coalesce("speaker_id", F.lit("")))
    rows = dealt(with_parents(identified(tokens)))
    of = lambda c: F.col(f"row.{c}").alias(c)
    tu = F.when(part, X.MISSING).otherwise(F.col("row.unit"))
    numbers = F.when(F.col("row.token_id").rlike(r"^\d+-\d+[a-z]*$"), natural(F.col("row.token_id"))).otherwise(F.struct(F.lit(0).cast("long").alias("a"), F.lit(0).cast("long").alias("b"), F.col("row.token_id").alias("c")))
    return rows.select("file", of("token_id"), speaker.alias("speaker"), tu.alias("tu_id"), of("unit"), of("id"), of("span"), of("form"), of("lemma"), of("upos"), F.lit(X.MISSING).alias("jefferson_feats"), of("note"), F.struct(numbers.alias("key"), "sent", "place").alias("sort"))

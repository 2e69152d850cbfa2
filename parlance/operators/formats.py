"""What tables of units and tokens are turned into: token table, texts, summaries, and other formats.

Texts are put together with ordered aggregates; the long state machines of the reference formats are
windows over a unit. Every builder returns rows of text by transcript (and order), which the text
sinks write.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from parlance.functions import fields as X
from parlance.operators.metadata import first_of, last_by_code
from parlance.operators.normalize import ERRORS, NAMES
from parlance.operators.units import KEYS

VERT = ["token_id", "speaker", "tu_id", "unit", "id", "span", "form", "lemma", "upos", "xpos", "feats", "deprel", "type", "meta_label", "variation", "jefferson_feats", "align", "prolongations", "pace", "guesses", "overlaps"]


def ordered(order: list[str], text: Column, sep: str = "") -> Column:
    """An aggregate: the texts joined in that order."""
    return F.array_join(F.transform(F.sort_array(F.collect_list(F.struct(*order, text.alias("__text")))), lambda x: x["__text"]), sep)


def vert(tokens: DataFrame, variation: DataFrame | None = None, keep: list[str] = ()) -> DataFrame:
    """The token table, all text, `_` where there is nothing. Tokens come from tokens.with_spans; columns in `keep` stay as they are."""
    df = tokens
    if variation is not None:
        df = df.drop("variation").join(variation, KEYS)
    none = F.lit(X.MISSING)
    number = lambda c: F.col(c).cast("string")
    return df.select(
        "transcript_id", F.concat(number("tu_id"), F.lit("-"), number("idx")).alias("token_id"), "speaker", number("tu_id").alias("tu_id"), number("tu_id").alias("unit"), number("idx").alias("id"),
        "span", "form", *[none.alias(c) for c in ("lemma", "upos", "xpos", "feats", "deprel")], "type", none.alias("meta_label"), "variation", X.jefferson_feats().alias("jefferson_feats"),
        X.align_text(F.when(F.col("first"), F.col("start")), F.when(F.col("last"), F.col("end"))).alias("align"), X.prolongation_text(F.col("prolongations")).alias("prolongations"),
        X.pace_text(F.col("slow"), F.col("fast")).alias("pace"), X.or_missing(F.col("guesses")).alias("guesses"), X.or_missing(F.col("overlaps")).alias("overlaps"), *keep,
    )


def islands(rows: DataFrame, keys: list[str], value: str, line: str = "line", sticky: str | None = X.MISSING) -> DataFrame:
    """Adds `group`: the number of the run of equal values that a row belongs to; a sticky value goes on with the run before it."""
    by = Window.partitionBy(*keys).orderBy(line)
    own = F.when(F.col(value) == sticky, None).otherwise(F.col(value)) if sticky else F.col(value)
    filled = F.coalesce(F.last(own, ignorenulls=True).over(by.rowsBetween(Window.unboundedPreceding, 0)), F.lit("0"))
    df = rows.withColumn("__value", filled)
    change = F.coalesce(F.col("__value") != F.lag("__value").over(by), F.lit(True)).cast("int")
    return df.withColumn("__change", change).withColumn("group", F.sum("__change").over(by.rowsBetween(Window.unboundedPreceding, 0))).drop("__change", "__value")


def linear(rows: DataFrame, keys: list[str], order: str = "line") -> DataFrame:
    """Per unit the Jefferson and the orthographic text, from rows of type, span, form, jefferson_feats. A text with nothing in it is null."""
    kind, jf = F.col("type"), F.col("jefferson_feats")
    jefferson = F.when(kind.isin("nonverbalbehavior", "shortpause", "unknown", "linguistic", "error"), F.col("span")).otherwise("")
    orthographic = F.when(kind == "unknown", F.regexp_replace("span", "[^x]", "")).when(kind == "linguistic", F.col("form")).when(kind == "error", F.regexp_replace("form", r"[^\p{L}]", "")).otherwise("")
    gap = lambda mark: F.when(jf.contains("ProsodicLink=Yes"), mark).when(jf.contains("SpaceAfter=No"), "").otherwise(" ")
    got = rows.groupBy(*keys).agg(F.min_by("speaker", order).alias("speaker"), F.min(order).alias("first_line"), ordered([order], F.concat(jefferson, gap("="))).alias("jefferson"), ordered([order], F.concat(orthographic, gap(" "))).alias("orthographic"))
    tidy = lambda c: F.nullif(F.regexp_replace(F.trim(F.col(c)), " +", " "), F.lit(""))
    return got.withColumns({c: tidy(c) for c in ("jefferson", "orthographic")})


def rebuilt(rows: DataFrame, keys: list[str], order: str = "line") -> DataFrame:
    """Units back from a token table: speaker, start, end, text with its marks of variation. Units without both times are left out."""
    last = F.row_number().over(Window.partitionBy(*keys).orderBy(F.desc(order))) == 1
    jf = F.coalesce(F.col("jefferson_feats"), F.lit(""))
    gap = F.when(F.col("__last") | jf.contains("SpaceAfter=No"), "").when(jf.contains("ProsodicLink=Yes"), "=").otherwise(" ")
    got = rows.withColumn("__last", last).groupBy(*keys).agg(
        F.min_by("speaker", order).alias("speaker"), F.min_by("variation", order).alias("variation"), X.seconds(F.min_by("align", order), "Begin").alias("start"), X.seconds(F.max_by("align", order), "End").alias("end"),
        ordered([order], F.concat(F.coalesce("span", F.lit("")), gap)).alias("text"),
    )
    return got.where("start is not null and end is not null").withColumn("text", X.marked_variation(F.col("text"), F.col("variation"))).drop("variation")


def unit_times(rows: DataFrame, keys: list[str], order: str = "line", first_begin: bool = True) -> DataFrame:
    """begin_ms and end_ms of units: the first (or last) Begin and the last End."""
    begin, end = X.milliseconds(F.col("align"), "Begin"), X.milliseconds(F.col("align"), "End")
    pick = F.min_by if first_begin else F.max_by
    return rows.groupBy(*keys).agg(pick(begin, F.when(begin.isNotNull(), F.col(order))).alias("begin_ms"), F.max_by(end, F.when(end.isNotNull(), F.col(order))).alias("end_ms"))


TYPES = {"ling": "linguistic", "unk": "unknown", "anonym": "anonymized", "nvb": "nonverbalbehavior", "pause": "shortpause", "err": "error"}


def type_counts() -> list[Column]:
    """Aggregates of tokens: how many, and how many of each type."""
    return [F.count("*").alias("tokens"), *[F.count_if(F.col("type") == t).alias(f"tokens_{k}") for k, t in TYPES.items()]]


def speaker_summary(units: DataFrame, tokens: DataFrame) -> DataFrame:
    """Per transcript and speaker: included units, time, tokens by type, units with other languages. Units have duration and the final variation."""
    counts = tokens.groupBy(*KEYS).agg(*type_counts())
    got = units.where("include").join(counts, KEYS, "left").fillna(0, ["tokens", *[f"tokens_{k}" for k in TYPES]])
    return got.groupBy("transcript_id", "speaker").agg(F.count("*").alias("TUs"), F.sum("duration").alias("time"), F.sum("tokens").alias("tokens"), *[F.sum(f"tokens_{k}").alias(f"tokens_{k}") for k in TYPES], F.count_if(F.col("variation") != "none").alias("code_switching"))


def rule_counts(units: DataFrame) -> DataFrame:
    """Rows (transcript_id, kind, rule, n) of warnings summed and errors counted over included units; zeros left out."""
    pairs = [F.struct(F.lit("WARNINGS").alias("kind"), F.lit(n).alias("rule"), F.col(f"w_{n}").alias("n")) for n in NAMES]
    pairs += [F.struct(F.lit("ERRORS").alias("kind"), F.lit(c.name).alias("rule"), F.col(f"e_{c.name}").cast("long").alias("n")) for c in ERRORS]
    each = units.where("include").select("transcript_id", F.explode(F.filter(F.array(*pairs), lambda x: x["n"] > 0)).alias("x"))
    return each.groupBy("transcript_id", "x.kind", "x.rule").agg(F.sum("x.n").alias("n"))


def json_summary(units: DataFrame, counts: DataFrame, tokens: DataFrame, overlaps: DataFrame | None = None, tasks: int | None = None) -> DataFrame:
    """Rows (transcript_id, json): the summary of a transcript.

    `counts`: rows (transcript_id, speaker, variation, tokens, and tokens_ with each of TYPES), as many for a speaker as
    included units; `variation` is the final one. `overlaps`: rows (transcript_id, event). All parts are dealt by
    transcript at once, to `tasks` if given, and put together without joins: what a task holds are its transcripts.
    """
    sums = ["tokens", *[f"tokens_{k}" for k in TYPES], "code_switching"]
    rules, T = [f"w_{n}" for n in NAMES] + [f"e_{c.name}" for c in ERRORS], "transcript_id"
    faults = F.filter(F.array(*[F.when(F.col(f"e_{c.name}"), F.lit(c.name)) for c in ERRORS]), lambda x: x.isNotNull())
    details = F.transform(faults, lambda x: F.struct("tu_id", x.alias("rule"), "speaker", "text"))
    kind = units.schema["duration"].dataType
    rows = units.select(T, "speaker", "include", *rules, F.when(F.col("include"), F.struct("tu_id", "duration")).alias("__time"), F.when(F.col("include") & (F.size(faults) > 0), details).alias("__details"))
    wrong = F.struct("tu_id", "idx", "speaker", "span", "form", F.col("text").alias("context"))
    parts = [counts.select(T, "speaker", *sums[:-1], (F.col("variation") != "none").cast("int").alias("code_switching")), tokens.where("type = 'error'").select(T, "speaker", wrong.alias("__wrong"))]
    # an event is of no speaker
    parts += [overlaps.select(T, "event")] if overlaps is not None else []
    for part in parts:
        rows = rows.unionByName(part, allowMissingColumns=True)
    rows = rows.repartition(tasks, T) if tasks else rows.repartition(T)
    counted = [F.sum(F.when(F.col("include"), F.col(f"w_{n}"))).alias(f"w_{n}") for n in NAMES] + [F.count_if(F.col("include") & F.col(f"e_{c.name}")).alias(f"e_{c.name}") for c in ERRORS]
    events = F.size(F.collect_set("event")) if overlaps is not None else F.lit(0)
    # in order of units, so that a sum of fractions doesn't depend on how rows were dealt
    times = F.filter(F.transform(F.sort_array(F.collect_list("__time")), lambda x: x["duration"]), lambda x: x.isNotNull())
    people = rows.groupBy(T, "speaker").agg(
        F.count_if("include").alias("TUs"), F.count_if(~F.col("include")).alias("removed_TUs"), times.alias("__times"), *[F.coalesce(F.sum(c), F.lit(0)).alias(c) for c in sums], *counted,
        F.flatten(F.collect_list("__details")).alias("__details"), F.collect_list("__wrong").alias("__wrong"), events.alias("overlaps"),
    )
    time = F.when(F.size("__times") > 0, F.aggregate("__times", F.lit(0).cast(kind), lambda n, x: (n + x).cast(kind)))
    said = F.struct("TUs", time.alias("time"), "tokens", *[F.col(f"tokens_{k}").alias(f"tokens-{k}") for k in TYPES], F.col("code_switching").alias("code-switching"))
    filled = lambda xs: F.when(F.size(xs) > 0, xs)
    out = people.groupBy(T).agg(
        filled(F.sort_array(F.collect_list(F.when(F.col("TUs") > 0, F.struct("speaker", said.alias("of")))))).alias("speakers"), *[F.sum(c).alias(c) for c in ("TUs", "removed_TUs", "overlaps", *rules)],
        filled(F.sort_array(F.flatten(F.collect_list("__details")))).alias("ERROR_DETAILS"), filled(F.sort_array(F.flatten(F.collect_list("__wrong")))).alias("ERROR_TOKENS"),
    )
    broken = F.lit(False)
    for c in rules:
        broken = broken | (F.coalesce(F.col(c), F.lit(0)) > 0)
    found = lambda mark: F.when(broken, F.map_from_entries(F.filter(F.array(*[F.struct(F.lit(c[2:]).alias("rule"), F.col(c).alias("n")) for c in sorted(rules) if c.startswith(mark)]), lambda x: x["n"] > 0)))
    out = out.where("TUs + removed_TUs > 0").withColumns({"speakers": F.map_from_entries("speakers"), "WARNINGS": found("w_"), "ERRORS": found("e_")})
    return out.select(T, F.to_json(F.struct(F.col(T).alias("transcript"), "speakers", "TUs", "removed_TUs", "overlaps", "WARNINGS", "ERRORS", "ERROR_DETAILS", "ERROR_TOKENS")).alias("json"))


def linear_units(units: DataFrame, tokens: DataFrame) -> DataFrame:
    """One row per included unit with its counts of warnings, errors and tokens, as the linear table has them."""
    error = F.col("type") == "error"
    # only what is put together is moved, before it is gathered: rows of many units that are gathered where they are made would be sorted there
    per = tokens.select(*KEYS, "idx", "form", "type").repartition(*KEYS).groupBy(*KEYS).agg(
        ordered(["idx"], F.col("form"), " ").alias("orthographic"), F.count_if(error).alias("errors"), F.array_join(F.transform(F.sort_array(F.collect_list(F.when(error, F.struct("idx", "form")))), lambda x: x["form"]), " ").alias("wrong"),
        *[F.count_if(F.col("type") == t).alias(f"T:{t}") for t in ("shortpause", "nonverbalbehavior", "linguistic")],
    )
    w = {"normalized_spaces": "UNEVEN_SPACES", "numbers": "NUMBERS", "accents": "ACCENTS", "non_jefferson": "SYMBOL_NOT_ALLOWED", "pauses_trim": "TRIM_PAUSES", "prosodic_trim": "TRIM_PROSODICLINKS", "switches": "SWITCHES"}
    e = {"volume": "UNBALANCED_DOTS", "pace": "UNBALANCED_PACE", "guess": "UNBALANCED_GUESS", "overlap": "UNBALANCED_OVERLAP"}
    return units.where("include").join(per, KEYS, "left").select(
        *KEYS, "speaker", "start", "end", "include", F.when(F.col("variation") == "none", "_").otherwise(F.col("variation")).alias("variation"), "original",
        X.marked_variation(F.col("text"), F.col("variation")).alias("text"), "orthographic", *[F.col(f"w_{v}").alias(f"W:{k}") for k, v in w.items()], *[F.col(f"e_{v}").alias(f"E:{k}") for k, v in e.items()],
        "T:shortpause", "T:nonverbalbehavior", F.when(F.col("wrong") == "", F.col("errors").cast("string")).otherwise(F.concat(F.col("errors").cast("string"), F.lit(", "), F.col("wrong"))).alias("T:errors"), "T:linguistic",
    )


def conllu_misc() -> Column:
    """The MISC field of a token row; both kinds of pace are said where both are there."""
    pairs = F.concat(
        F.when(F.col("token_id") != "_", F.array(F.struct(F.lit("KID").alias("k"), F.col("token_id").alias("v")))).otherwise(F.array().cast(X.PAIRS)),
        X.feats(F.col("jefferson_feats")), X.feats(F.col("meta_label")), X.feats(F.col("align")),
        F.filter(F.array(
            F.when(F.col("type") == "error", F.struct(F.lit("Type").alias("k"), F.lit("error").alias("v"))), F.when(~X.missing(F.col("prolongations")), F.struct(F.lit("Prolonged").alias("k"), F.lit("Yes").alias("v"))),
            F.when(F.col("pace").contains("Slow="), F.struct(F.lit("PaceSlow").alias("k"), F.lit("Yes").alias("v"))), F.when(F.col("pace").contains("Fast="), F.struct(F.lit("PaceFast").alias("k"), F.lit("Yes").alias("v"))),
            F.when(F.col("overlaps") != "_", F.struct(F.lit("OverlappingGroup").alias("k"), F.array_join(X.clique_ids(F.col("overlaps")), ",").alias("v"))),
            F.when(F.col("pause_next"), F.struct(F.lit("PauseAfter").alias("k"), F.lit("Yes").alias("v"))),
        ), lambda x: x.isNotNull()),
    )
    return X.or_missing(F.array_join(F.array_sort(F.array_distinct(F.transform(pairs, lambda x: F.concat(x["k"], F.lit("="), x["v"])))), "|"))


def conllu(rows: DataFrame, keys: list[str], order: str = "line") -> DataFrame:
    """Rows (keys, text): a CoNLL-U block per unit that has a token besides pauses and events."""
    by = Window.partitionBy(*keys).orderBy(order)
    pause, event = F.col("type") == "shortpause", F.col("type") == "nonverbalbehavior"
    # a pause says so on the token before it, whatever events stand between
    block = F.sum(F.when(~pause & ~event, 1).otherwise(0)).over(by.rowsBetween(Window.unboundedPreceding, 0))
    df = rows.withColumn("__block", block)
    df = df.withColumn("pause_next", F.max(pause).over(Window.partitionBy(*keys, "__block")) & ~pause & ~event)
    head = F.when(F.col("deprel") == "_", "_").otherwise(F.element_at(F.split("deprel", ":"), -1))
    rel = F.when(F.col("deprel") == "_", "_").otherwise(F.regexp_replace("deprel", ":[^:]*$", ""))
    line = F.concat_ws("\t", "id", "form", "lemma", "upos", "xpos", "feats", head, rel, F.lit("_"), conllu_misc())
    jf, none = F.col("jefferson_feats"), F.lit("")
    shown = F.col("span") != "_"
    # a backspace takes back the space before a token that is linked
    said = lambda c: F.when(jf.contains("ProsodicLink"), F.concat(F.lit("\b"), c, F.lit(" "))).when(jf.contains("SpaceAfter"), c).otherwise(F.concat(c, F.lit(" ")))
    plain = F.when(pause | event | ~shown, none).otherwise(said(F.col("form")))
    jeff = F.when(pause, "(.) ").when(event, F.concat("span", F.lit(" "))).when(~shown, none).when(jf.contains("ProsodicLink"), F.concat(F.lit("\b="), F.col("span"), F.lit(" "))).otherwise(said(F.col("span")))
    tidy = lambda c: F.trim(F.replace(F.regexp_replace(c, "(?s).\b", ""), F.lit("\b"), F.lit("")))
    word = ~pause & ~event
    got = df.groupBy(*keys).agg(
        tidy(ordered([order], plain)).alias("plain"), tidy(ordered([order], jeff)).alias("jeff"), F.coalesce(F.max_by("speaker", F.when(word & (F.col("speaker") != "_"), F.col(order))), none).alias("who"), F.count_if(word).alias("n"),
        F.array_join(F.transform(F.sort_array(F.collect_list(F.when(word, F.struct(order, line.alias("x"))))), lambda x: x["x"]), "\n").alias("lines"),
    )
    unit = F.col(keys[-1]).cast("string")
    return got.where("n > 0").select(*keys, F.concat(F.lit("# sent_id = "), unit, F.lit("\n# text = "), "plain", F.lit("\n# jefferson_text = "), "jeff", F.lit("\n# speaker_id = "), "who", F.lit("\n"), "lines", F.lit("\n")).alias("text"))


def attributes(pairs: list[tuple[str, Column]]) -> Column:
    return F.concat(*[x for name, c in pairs for x in (F.lit(f' {name}="'), F.coalesce(c.cast("string"), F.lit("")), F.lit('"'))])


def vertical(rows: DataFrame, conversations: DataFrame, participants: DataFrame, base_url: str, dynamic: bool = False, order: str = "line") -> DataFrame:
    """Rows (transcript_id, text): the vertical format of corpus engines. `dynamic`: all metadata columns, token ids and glue, else the fixed ones and a `//` after each unit."""
    keys = ["transcript_id", "tu_id"]
    times = unit_times(rows, keys, order)
    used = (F.col("form") != "_") & (F.col("form") != "")
    glued = F.concat_ws("\t", *[c for c in rows.columns if c not in ("transcript_id", order)]).contains("SpaceAfter=No")
    line = F.concat("form", F.lit("\t"), "token_id", F.when(glued, "\n<g/>").otherwise("")) if dynamic else F.col("form")
    units = rows.groupBy(*keys).agg(F.min(order).alias("first"), F.min_by("speaker", order).alias("speaker"), F.array_join(F.transform(F.sort_array(F.collect_list(F.when(used, F.struct(order, line.alias("x"))))), lambda x: x["x"]), "\n").alias("lines")).join(times, keys)
    people = participants.select(F.col("code").alias("speaker"), *[F.col(f"`{c}`").alias(f"p_{c}") for c in participants.columns if c not in ("code", "conversations")])
    units = units.join(people, "speaker", "left")
    own = lambda c: F.coalesce(F.col(f"`p_{c}`"), F.lit("")) if c in participants.columns else F.lit("")
    url = X.joined_url(F.lit(base_url), F.concat(F.lit("player/player.cgi?code="), "transcript_id", F.lit("&begin="), F.coalesce(F.col("begin_ms").cast("string"), F.lit("")), F.lit("&end="), F.coalesce(F.col("end_ms").cast("string"), F.lit(""))))
    start = [("begin", F.col("begin_ms")), ("end", F.col("end_ms")), ("audio_file", url), ("participant_code", F.col("speaker"))]
    tag = "transcription_unit" if dynamic else "annotation"
    if dynamic:
        start += [(f"participant_{X.attribute_name(c)}", X.multivalue(F.col(f"`p_{c}`"))) for c in participants.columns if c not in ("code", "conversations")]
    else:
        region = F.when(own("birth-region") != "", own("birth-region")).otherwise(own("school-region"))
        start += [("participant_occupation", own("occupation")), ("participant_sex", own("gender")), ("participant_school_region", region), ("participant_age_range", own("age-range"))]
    body = F.concat(F.lit(f"<{tag}"), attributes(start), F.lit(">\n"), F.when(F.col("lines") == "", "").otherwise(F.concat("lines", F.lit("\n"))), F.lit("" if dynamic else "//\n"), F.lit(f"</{tag}>"))
    bodies = units.withColumn("body", body).groupBy("transcript_id").agg(ordered(["first"], F.col("body"), "\n").alias("body"))
    conv = conversations.select(F.col("code").alias("transcript_id"), *[F.col(f"`{c}`").alias(f"c_{c}") for c in conversations.columns if c != "code"])
    df = bodies.join(conv, "transcript_id", "left")
    of = lambda c: F.coalesce(F.col(f"`c_{c}`"), F.lit("")) if c in conversations.columns else F.lit("")
    page = X.joined_url(F.lit(base_url), F.concat(F.lit("html/"), "transcript_id", F.lit(".html")))
    if dynamic:
        head = [("code", F.col("transcript_id")), ("full_conversation", page)] + [(X.attribute_name(c), X.multivalue(F.col(f"`c_{c}`"))) for c in conversations.columns if c not in ("code", "participants")]
        text = F.concat(F.lit("<conversation"), attributes(head), F.lit(">\n"), "body", F.lit("\n</conversation>"))
    else:
        head = [("code", F.col("transcript_id"))] + [(X.attribute_name(c), of(c)) for c in ("type", "duration", "participants-number", "participants-relationship", "moderator", "topic", "year")] + [("point", of("collection-point"))]
        text = F.concat(F.lit("<doc"), attributes([("doc_number", F.col("transcript_id")), ("full_conversation", page)]), F.lit(">\n<conversation"), attributes(head), F.lit(">\n"), "body", F.lit("\n</conversation>\n</doc>"))
    return df.select("transcript_id", text.alias("text"))


def timeline(rows: DataFrame) -> DataFrame:
    """Rows (transcript_id, at, name): the distinct times of a transcript as T0, T1 and so on."""
    every = rows.select("transcript_id", F.explode(F.filter(F.array(X.seconds(F.col("align"), "Begin"), X.seconds(F.col("align"), "End")), lambda x: x.isNotNull())).alias("at")).distinct()
    return every.withColumn("name", F.concat(F.lit("T"), (F.row_number().over(Window.partitionBy("transcript_id").orderBy("at")) - 1).cast("string")))


def clique_units(rows: DataFrame, order: str = "line") -> DataFrame:
    """Rows (transcript_id, clique, units, first_unit): the units of every overlap event, in order of their first token."""
    each = rows.where("overlaps <> '_'").select("transcript_id", "tu_id", order, F.explode(F.array_distinct(X.clique_ids(F.col("overlaps")))).alias("clique"))
    first = each.groupBy("transcript_id", "clique", "tu_id").agg(F.min(order).alias("first"))
    return first.groupBy("transcript_id", "clique").agg(F.transform(F.sort_array(F.collect_list(F.struct("first", "tu_id"))), lambda x: x["tu_id"]).alias("units"), F.min_by("tu_id", "first").alias("first_unit"))


def in_runs(rows: DataFrame, keys: list[str], order: str = "line") -> DataFrame:
    """Adds clique (the first event of a token, or null), opens and closes: where a run of tokens of one event begins and ends."""
    by = Window.partitionBy(*keys).orderBy(order)
    df = rows.withColumn("clique", F.get(X.clique_ids(F.col("overlaps")), F.lit(0)))
    same = lambda other: F.coalesce(other == F.col("clique"), F.lit(False))
    return df.withColumns({"opens": F.col("clique").isNotNull() & ~same(F.lag("clique").over(by)), "closes": F.col("clique").isNotNull() & ~same(F.lead("clique").over(by))})


def shifts(rows: DataFrame, keys: list[str], order: str = "line") -> DataFrame:
    """Adds loud_shift and tempo_shift: the new state before a token where it changes, else null; and the states last_loud, last_tempo of the unit's end.

    Pauses, events, anonymised tokens and tokens in overlaps are passed over.
    """
    by = Window.partitionBy(*keys).orderBy(order)
    tracked = ~F.col("type").isin("shortpause", "nonverbalbehavior", "anonymized") & F.col("clique").isNull()
    volume = X.feat(F.col("jefferson_feats"), "Volume")
    loud = F.when(volume == "low", "p").when(volume == "high", "f").otherwise("normal")
    tempo = F.when(F.col("pace").contains("Slow="), "l").when(F.col("pace").contains("Fast="), "aa").otherwise("normal")
    df = rows.withColumns({"__loud": F.when(tracked, loud), "__tempo": F.when(tracked, tempo)})
    out = {}
    for name in ("loud", "tempo"):
        before = F.coalesce(F.last(f"__{name}", ignorenulls=True).over(by.rowsBetween(Window.unboundedPreceding, -1)), F.lit("normal"))
        out[f"{name}_shift"] = F.when(F.col(f"__{name}").isNotNull() & (F.col(f"__{name}") != before), F.col(f"__{name}"))
        out[f"last_{name}"] = F.coalesce(F.last(f"__{name}", ignorenulls=True).over(Window.partitionBy(*keys).orderBy(order).rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)), F.lit("normal"))
    return df.withColumns(out).drop("__loud", "__tempo")


#: The fields of a conversation that its source is noted with.
NOTED = ["type", "collection-point", "topic", "participants-relationship", "moderator"]


def tag(name: str, text: Column, **attributes_: Column | str) -> Column:
    """An element with its text, or null where the text is missing."""
    head = [F.lit(f"<{name}")]
    for key, value in attributes_.items():
        head += [F.lit(f' {key}="'), X.xml(value if isinstance(value, Column) else F.lit(value)), F.lit('"')]
    return F.when(~X.missing(text), F.concat(*head, F.lit(">"), X.xml(text), F.lit(f"</{name}>")))


def empty_tag(name: str, key: str, value: Column) -> Column:
    return F.when(~X.missing(value), F.concat(F.lit(f'<{name} {key}="'), X.xml(value), F.lit('"/>')))


def tei_people(rows: DataFrame, conversations: DataFrame | None, participants: DataFrame | None, order: str = "line") -> DataFrame:
    """Rows (transcript_id, people): the speakers of a transcript, first come first, with what is known of them; who moderates has an R as the third letter of the code."""
    said = rows.where(~X.missing(F.col("speaker"))).groupBy("transcript_id", "speaker").agg(F.min(order).alias("first"))
    of = lambda c, df: F.col(f"`p_{c}`") if df is not None and c in df.columns else F.lit(None).cast("string")
    if participants is not None:
        people = last_by_code(participants)
        said = said.join(people.select(*[F.col(f"`{c}`").cast("string").alias(f"p_{c}") for c in people.columns]), F.col("speaker") == F.col("p_code"), "left")
    moderated = F.lit(False)
    if conversations is not None and {"moderator", "participants"} <= set(conversations.columns):
        talks = first_of(conversations, ["code"], [F.col("line")] if "line" in conversations.columns else [F.to_json(F.struct("*"))])
        said = said.join(talks.select(F.col("code").alias("transcript_id"), F.col("moderator").alias("__mod"), F.split("participants", ";").alias("__here")), "transcript_id", "left")
        moderated = F.coalesce((F.lower("__mod") == "yes") & F.array_contains("__here", F.col("speaker")) & (F.substring("speaker", 3, 1) == "R"), F.lit(False))
    known = F.concat_ws(
        "", empty_tag("sex", "value", X.mapped(of("gender", participants), X.SEXES)), tag("age", of("age-range", participants)),
        F.concat(F.lit("<birth>"), tag("region", of("birth-region", participants)), F.lit("</birth>")), tag("occupation", of("occupation", participants)), tag("education", of("study-level", participants)),
    )
    person = F.concat(F.lit('<person xml:id="'), X.xml(F.col("speaker")), F.lit('" role="'), F.when(moderated, "moderator").otherwise("participant"), F.lit('">'), tag("persName", F.col("speaker")), known, F.lit("</person>"))
    return said.groupBy("transcript_id").agg(ordered(["first"], person, "\n").alias("people"))


def tei_sources(conversations: DataFrame) -> DataFrame:
    """Rows (transcript_id, dur, bibl, languages, setting): what the header says of a conversation, of equal codes the first."""
    own = first_of(conversations, ["code"], [F.col("line")] if "line" in conversations.columns else [F.to_json(F.struct("*"))])
    of = lambda c: F.col(f"`{c}`").cast("string") if c in own.columns else F.lit(None).cast("string")
    date = empty_tag("date", "when", of("year"))
    notes = [tag("note", of(c), type=c) for c in NOTED]
    bibl = F.concat(F.lit("<bibl>"), F.concat_ws("", tag("title", of("code")), date, *notes), F.lit("</bibl>"))
    language = lambda x: F.concat(F.lit('<language ident="'), X.xml(X.mapped(x, X.LANGUAGES)), F.lit('">'), X.xml(F.concat(F.upper(F.substring(x, 1, 1)), F.lower(F.substring(x, 2, 1 << 20)))), F.lit("</language>"))
    languages = F.when(~X.missing(of("languages")), F.concat(F.lit("<langUsage>"), F.array_join(F.transform(X.codes(of("languages")), language), ""), F.lit("</langUsage>")))
    place = F.concat_ws("", tag("name", of("collection-point"), type="collection-point"), date)
    setting = F.when(place != "", F.concat(F.lit("<settingDesc><setting>"), place, F.lit("</setting></settingDesc>")))
    return own.select(F.col("code").alias("transcript_id"), F.when(~X.missing(of("duration")), X.iso_duration(of("duration"))).alias("dur"), bibl.alias("bibl"), languages.alias("languages"), setting.alias("setting"))


def span_layers(rows: DataFrame, layers: dict[str, str], order: str = "line") -> DataFrame:
    """Rows (transcript_id, layer, span, first_token, last_token, first): of every value of a layer's column, which may reach over units and cross others, the first and the last word that has it. `layers`: column to name."""
    words = rows.where(~F.col("type").isin("shortpause", "nonverbalbehavior", "anonymized"))
    every = F.array(*[F.struct(F.lit(name).alias("layer"), F.col(column).cast("string").alias("span")) for column, name in layers.items()])
    each = words.select("transcript_id", order, "token_id", F.explode(every).alias("x")).select("transcript_id", order, "token_id", "x.*").where(~X.missing(F.col("span")))
    return each.groupBy("transcript_id", "layer", "span").agg(F.min_by("token_id", order).alias("first_token"), F.max_by("token_id", order).alias("last_token"), F.min(order).alias("first"))


def tei_spans(rows: DataFrame, layers: dict[str, str], order: str = "line") -> DataFrame:
    """Rows (transcript_id, spans): the groups of the layers, each with its spans in order of their first word."""
    span = F.concat(F.lit('<span xml:id="'), F.substring("layer", 1, 2), X.xml(F.col("span")), F.lit('" from="#w'), "first_token", F.lit('" to="#w'), "last_token", F.lit('"/>'))
    groups = span_layers(rows, layers, order).groupBy("transcript_id", "layer").agg(ordered(["first"], span, "\n").alias("body"))
    return groups.groupBy("transcript_id").agg(ordered(["layer"], F.concat(F.lit('<spanGrp type="'), "layer", F.lit('">\n'), "body", F.lit("\n</spanGrp>\n"))).alias("spans"))


def unresolved(texts: DataFrame) -> DataFrame:
    """Rows (transcript_id, ref): references of TEI documents to ids that they don't have."""
    ids = texts.select("transcript_id", F.explode(F.regexp_extract_all("text", F.lit('xml:id="([^"]+)"'), F.lit(1))).alias("ref")).distinct()
    said = F.flatten(F.transform(F.regexp_extract_all("text", F.lit('(?:who|start|end|from|to|targets)="(#[^"]+)"'), F.lit(1)), lambda x: F.split(x, " ")))
    refs = texts.select("transcript_id", F.explode(said).alias("ref")).select("transcript_id", F.regexp_replace("ref", "^#", "").alias("ref")).distinct()
    return refs.join(ids, ["transcript_id", "ref"], "left_anti")


def tei(rows: DataFrame, conversations: DataFrame | None = None, order: str = "line", participants: DataFrame | None = None, layers: dict[str, str] | None = None, publisher: str = "") -> DataFrame:
    """Rows (transcript_id, text): TEI XML with a header from metadata, timeline, blocks of utterances, anchors of overlaps and their links, and groups of spans."""
    keys = ["transcript_id", "tu_id"]
    df = shifts(in_runs(rows, keys, order), keys, order)
    jf = F.col("jefferson_feats")
    lang, pitch = X.feat(jf, "Language"), X.feat(jf, "Intonation")
    opt = lambda name, c: F.coalesce(F.concat(F.lit(f' {name}="'), X.xml(c), F.lit('"')), F.lit(""))
    rend = F.nullif(F.concat_ws(" ", F.when(jf.contains("Reduced=Yes"), "reduced"), F.when(jf.contains("ProsodicLink=Yes"), "prosodicLink")), F.lit(""))
    handled = ["Truncated", "Volume", "Language", "Intonation", "SpaceAfter", "ProsodicLink"]
    kept = F.concat(
        F.filter(F.array(*[F.when(~X.missing(F.col(c)) & (F.col(c) != "none"), F.struct(F.lit(c).alias("k"), F.col(c).alias("v"))) for c in ("upos", "xpos", "feats", "deprel", "variation", "meta_label")]), lambda x: x.isNotNull()),
        F.transform(F.filter(X.feats(jf, bare=False), lambda x: ~x["k"].isin(handled)), lambda x: F.struct(F.concat(F.lit("jf."), x["k"]).alias("k"), x["v"].alias("v"))),
    )
    fs = F.when(F.size(kept) > 0, F.concat(F.lit("<fs>"), F.array_join(F.transform(kept, lambda x: F.concat(F.lit('<f name="'), x["k"], F.lit('"><string>'), X.xml(x["v"]), F.lit("</string></f>"))), ""), F.lit("</fs>"))).otherwise("")
    colons = X.with_prolongations(F.col("form"), F.col("prolongations"))
    text = F.regexp_replace(X.xml(colons), ":+", '<c type="prolongation"/>')
    kind = F.when(jf.contains("Truncated=Yes"), "interrupted").when(F.col("type") == "error", "error")
    word = F.concat(
        F.lit('<w xml:id="w'), "token_id", F.lit('"'), opt("lemma", F.when(~X.missing(F.col("lemma")), F.col("lemma"))), opt("type", kind), opt("xml:lang", F.when(lang != "ita", lang)),
        opt("cert", F.when(F.col("guesses") != "_", "low")), opt("join", F.when(jf.contains("SpaceAfter=No"), "right")), opt("rend", rend), F.lit(">"), text,
        F.coalesce(F.concat(F.lit('<shift feature="pitch" new="'), X.mapped(pitch, X.PITCH), F.lit('"/>')), F.lit("")), fs, F.lit("</w>"),
    )
    item = (
        F.when(F.col("type") == "shortpause", '<pause dur="short"/>').when(F.col("type") == "nonverbalbehavior", F.concat(F.lit("<vocal><desc>"), X.xml(F.regexp_replace("form", r"^\(+|\)+$", "")), F.lit("</desc></vocal>")))
        .when(F.col("type") == "anonymized", F.concat(F.lit('<w xml:id="w'), "token_id", F.lit('" type="anonymized">'), X.xml(F.col("form")), F.lit("</w>"))).otherwise(word)
    )
    anchor = lambda test, name: F.when(test, F.concat(F.lit(f'<anchor xml:id="{name}_'), "clique", F.lit("_"), F.col("tu_id").cast("string"), F.lit('"/>'))).otherwise("")
    shift = lambda name: F.coalesce(F.concat(F.lit(f'<shift feature="{name}" new="'), F.col(f"{name}_shift"), F.lit('"/>')), F.lit(""))
    df = df.withColumn("item", F.concat(anchor(F.col("opens"), "OVS"), shift("loud"), shift("tempo"), item, anchor(F.col("closes"), "OVE")))
    closing = F.concat(*[F.when(F.max(f"last_{n}") != "normal", f'<shift feature="{n}" new="normal"/>').otherwise("") for n in ("loud", "tempo")])
    last = lambda name: F.max_by(X.seconds(F.col("align"), name), F.when(X.seconds(F.col("align"), name).isNotNull(), F.col(order)))
    blocks = df.groupBy(*keys).agg(F.min(order).alias("first"), F.min_by("speaker", order).alias("speaker"), last("Begin").alias("b"), last("End").alias("e"), F.concat(ordered([order], F.col("item")), closing).alias("u"))
    times = timeline(rows)
    blocks = blocks.join(times.select("transcript_id", F.col("at").alias("b"), F.col("name").alias("bn")), ["transcript_id", "b"], "left").join(times.select("transcript_id", F.col("at").alias("e"), F.col("name").alias("en")), ["transcript_id", "e"], "left")
    n = (F.row_number().over(Window.partitionBy("transcript_id").orderBy("first", "tu_id")) - 1).cast("string")
    blocks = blocks.withColumn("n", n).withColumn("block", F.concat(F.lit('<annotationBlock who="#'), X.xml(F.col("speaker")), F.lit('" xml:id="ab'), "n", F.lit('"'), opt("start", F.concat(F.lit("#"), "bn")), opt("end", F.concat(F.lit("#"), "en")), F.lit('><u xml:id="u'), "n", F.lit('">'), "u", F.lit("</u></annotationBlock>")))
    body = blocks.groupBy("transcript_id").agg(ordered(["first", "tu_id"], F.col("block"), "\n").alias("blocks")).join(tei_people(rows, conversations, participants, order), "transcript_id", "left")
    line = times.groupBy("transcript_id").agg(ordered(["at"], F.concat(F.lit('<when xml:id="'), "name", F.lit('" absolute="'), F.lit("PT"), X.fixed(F.col("at"), 3), F.lit('S"/>')), "\n").alias("times"))
    ends = lambda name: F.concat(F.lit('<link targets="'), F.array_join(F.transform("units", lambda u: F.concat(F.lit(f"#{name}_"), F.col("clique"), F.lit("_"), u.cast("string"))), " "), F.lit('"/>'))
    links = clique_units(rows, order).groupBy("transcript_id").agg(F.concat(F.lit('<linkGrp type="overlaps">\n'), ordered(["clique"], F.concat(ends("OVS"), F.lit("\n"), ends("OVE")), "\n"), F.lit("\n</linkGrp>\n")).alias("links"))
    whole = body.join(line, "transcript_id", "left").join(links, "transcript_id", "left")
    blank = F.lit("")
    duration, bibl, languages, setting, spans = blank, blank, blank, blank, blank
    if conversations is not None:
        whole = whole.join(tei_sources(conversations), "transcript_id", "left")
        duration, bibl, languages, setting = opt("dur", F.col("dur")), *[F.coalesce(c, blank) for c in ("bibl", "languages", "setting")]
    if layers:
        whole = whole.join(tei_spans(rows, layers, order), "transcript_id", "left")
        spans = F.coalesce("spans", blank)
    text = F.concat(
        F.lit('<TEI xmlns="http://www.tei-c.org/ns/1.0">\n<teiHeader><fileDesc><titleStmt><title>'), "transcript_id", F.lit("</title></titleStmt>"), F.lit(f"<publicationStmt><p>{publisher}</p></publicationStmt>" if publisher else ""), F.lit('<sourceDesc><recordingStmt><recording type="audio"'), duration, F.lit('><media mimeType="audio/wav" url="'), "transcript_id",
        F.lit('.wav"/></recording></recordingStmt>'), bibl, F.lit("</sourceDesc></fileDesc><profileDesc>"), languages, F.lit("<particDesc><listPerson>\n"), F.coalesce("people", blank), F.lit("\n</listPerson></particDesc>"), setting, F.lit('</profileDesc></teiHeader>\n<text><body><div type="interaction" xml:id="'), "transcript_id",
        F.lit('">\n<timeline unit="s" xml:id="TL">\n'), F.coalesce("times", blank), F.lit("\n</timeline>\n"), "blocks", F.lit("\n"), spans, F.coalesce("links", blank), F.lit("</div></body></text>\n</TEI>"),
    )
    return whole.select("transcript_id", text.alias("text"))


def chat(rows: DataFrame, order: str = "line") -> DataFrame:
    """Rows (transcript_id, tu_id, first, text): a CHAT line per unit."""
    keys = ["transcript_id", "tu_id"]
    jf = F.col("jefferson_feats")
    form = F.concat(X.with_prolongations(F.col("form"), F.col("prolongations")), F.when(jf.contains("Truncated=Yes"), "-").otherwise(""))
    lang, volume = X.feat(jf, "Language"), X.feat(jf, "Volume")
    codes = F.concat_ws(" ", F.when(volume == "low", "[=! soft]").when(volume == "high", "[=! loud]"), F.when(F.col("pace").contains("Slow="), "[=! slow]").when(F.col("pace").contains("Fast="), "[=! fast]"), F.when(F.col("guesses") != "_", "[?]"))
    spoken = F.concat(form, F.coalesce(F.concat(F.lit("@l:"), F.when(lang != "ita", lang)), F.lit("")))
    full = F.concat(F.when(codes == "", spoken).otherwise(F.concat(F.lit("<"), spoken, F.lit("> "), codes)), F.when(jf.contains("PauseAfter=Yes"), " (.)").otherwise(""))
    item = F.when(F.col("type") == "shortpause", "(.)").when(F.col("type") == "nonverbalbehavior", F.concat(F.lit("[^ "), F.regexp_replace("form", r"^[({]+|[)}]+$", ""), F.lit("]"))).when(F.col("type") == "anonymized", "xxx").when(F.col("clique").isNotNull(), form).otherwise(full)
    df = in_runs(rows, keys, order).join(clique_units(rows, order).select("transcript_id", "clique", "first_unit"), ["transcript_id", "clique"], "left")
    close = F.when(F.col("closes"), F.concat(F.lit("> "), F.when(F.col("first_unit") == F.col("tu_id"), "[>]").otherwise("[<]"))).otherwise("")
    end = F.element_at(F.create_map(*[F.lit(x) for p in {"Falling": ".", "WeaklyRising": ".", "Rising": "?"}.items() for x in p]), X.feat(jf, "Intonation"))
    df = df.withColumns({"item": F.concat(F.when(F.col("opens"), "<").otherwise(""), item, close), "terminator": end})
    got = df.groupBy(*keys).agg(F.min(order).alias("first"), F.min_by("speaker", order).alias("speaker"), ordered([order], F.col("item"), " ").alias("words"), F.coalesce(F.max_by("terminator", F.when(F.col("terminator").isNotNull(), F.col(order))), F.lit(".")).alias("stop"))
    got = got.join(unit_times(rows, keys, order, first_begin=False), keys)
    bullet = F.when(F.col("begin_ms").isNotNull() & F.col("end_ms").isNotNull(), F.concat(F.lit(" \x15"), "begin_ms", F.lit("_"), "end_ms", F.lit("\x15"))).otherwise("")
    return got.select(*keys, "first", F.concat(F.lit("*"), "speaker", F.lit(":\t"), "words", F.lit(" "), "stop", bullet).alias("text"))


def eaf(units: DataFrame, media: str = "", order: str = "tu_id", translations: DataFrame | None = None) -> DataFrame:
    """Rows (transcript_id, text): ELAN XML, tiers in order of first appearance, times cut to milliseconds.

    Translations (transcript_id, parent_tu_id, text) stand on their parent's tier name with `_trad`, at the middle of the parent.
    """
    own = units.where("include") if "include" in units.columns else units
    rows = own.select("transcript_id", F.col(order).alias("o"), "speaker", (F.col("start") * 1000).cast("long").alias("b"), (F.col("end") * 1000).cast("long").alias("e"), "text")
    if translations is not None:
        parents = own.select("transcript_id", F.col("tu_id").alias("parent_tu_id"), F.col(order).alias("o"), "speaker", ((F.col("start") + F.col("end")) / 2 * 1000).cast("long").alias("b"))
        more = translations.where("trim(text) <> ''").select("transcript_id", "parent_tu_id", "text").join(parents, ["transcript_id", "parent_tu_id"])
        rows = rows.unionByName(more.select("transcript_id", "o", F.concat("speaker", F.lit("_trad")).alias("speaker"), "b", F.col("b").alias("e"), "text"))
    n = F.row_number().over(Window.partitionBy("transcript_id").orderBy("o", "speaker"))
    rows = rows.withColumn("n", n)
    slots = rows.groupBy("transcript_id").agg(ordered(["n"], F.concat(F.lit('<TIME_SLOT TIME_SLOT_ID="ts'), (F.col("n") * 2 - 1).cast("string"), F.lit('" TIME_VALUE="'), "b", F.lit('"/>\n<TIME_SLOT TIME_SLOT_ID="ts'), (F.col("n") * 2).cast("string"), F.lit('" TIME_VALUE="'), "e", F.lit('"/>')), "\n").alias("slots"))
    note = F.concat(F.lit('<ANNOTATION><ALIGNABLE_ANNOTATION ANNOTATION_ID="a'), "n", F.lit('" TIME_SLOT_REF1="ts'), (F.col("n") * 2 - 1).cast("string"), F.lit('" TIME_SLOT_REF2="ts'), (F.col("n") * 2).cast("string"), F.lit('"><ANNOTATION_VALUE>'), X.xml(F.col("text")), F.lit("</ANNOTATION_VALUE></ALIGNABLE_ANNOTATION></ANNOTATION>"))
    tiers = rows.groupBy("transcript_id", "speaker").agg(F.min("n").alias("first"), ordered(["n"], note, "\n").alias("notes"))
    body = tiers.groupBy("transcript_id").agg(ordered(["first"], F.concat(F.lit('<TIER LINGUISTIC_TYPE_REF="default-lt" TIER_ID="'), X.xml(F.col("speaker")), F.lit('">\n'), "notes", F.lit("\n</TIER>")), "\n").alias("tiers"))
    text = F.concat(F.lit(f'<?xml version="1.0" encoding="UTF-8"?>\n<ANNOTATION_DOCUMENT FORMAT="3.0" VERSION="3.0">\n<HEADER MEDIA_FILE="{media}" TIME_UNITS="milliseconds"/>\n<TIME_ORDER>\n'), "slots", F.lit("\n</TIME_ORDER>\n"), "tiers", F.lit('\n<LINGUISTIC_TYPE LINGUISTIC_TYPE_ID="default-lt" TIME_ALIGNABLE="true"/>\n</ANNOTATION_DOCUMENT>'))
    return body.join(slots, "transcript_id").select("transcript_id", text.alias("text"))


def turns_timeline(units: DataFrame) -> DataFrame:
    """Adds left and width: a unit's place on its transcript's time line as shares of the latest end, six decimals; colour: the speaker's number by first appearance, modulo 10; shown: whether the speaker changes."""
    whole = F.max("end").over(Window.partitionBy("transcript_id"))
    share = lambda c: X.fixed(F.when(whole > 0, c / whole).otherwise(0.0), 6)
    first = units.groupBy("transcript_id", "speaker").agg(F.min("tu_id").alias("first"))
    colours = first.withColumn("colour", (F.row_number().over(Window.partitionBy("transcript_id").orderBy("first")) - 1) % 10).drop("first")
    by = Window.partitionBy("transcript_id").orderBy("tu_id")
    df = units.withColumns({"left": share(F.col("start")), "width": share(F.col("end") - F.col("start")), "shown": F.coalesce(F.col("speaker") != F.lag("speaker").over(by), F.lit(True))})
    return df.join(colours, ["transcript_id", "speaker"])

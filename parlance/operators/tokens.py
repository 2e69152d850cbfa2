"""Tokens of transcription units: splitting, classification, features, and spans mapped onto them.

Tokens are exploded rows. Offsets and what looks at the neighbours in a unit are made in the array
that is exploded, so that tokens need no shuffle: the text of a unit isn't moved with each of them.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from parlance.functions.matches import let, spans
from parlance.operators.units import KEYS

#: Fixed value: what a word looks like, with marks of prosody.
WORD = r"^['~-]?\p{L}[\p{L}:]*+(?:-\p{L}[\p{L}:]*+)*+[-'~]?[.,?]?$"
MARKS = r"[\[\]()<>°]"
INTONATION = {".": "Falling", ",": "WeaklyRising", "?": "Rising"}
UNIT_COLUMNS = ["speaker", "start", "end", "text", "variation"]


def pieces(text: Column) -> Column:
    """What stands between spaces and prosodic links, empty pieces too, and the mark that follows each."""
    return F.arrays_zip(F.split(text, "[ =]", -1).alias("piece"), F.regexp_extract_all(text, F.lit("[ =]"), F.lit(0)).alias("mark"))


def elided(piece: Column) -> Column:
    """The piece in two at its first apostrophe, if letters stand on both sides of it."""
    at = F.instr(piece, "'")
    left, right = F.substring(piece, F.lit(1), at), F.substring(piece, at + 1, F.length(piece))
    both = (at > 0) & left.rlike(r"\p{L}") & right.rlike(r"\p{L}")
    return F.when(both, F.array(left, right)).otherwise(F.array(piece))


#: Fixed value: how many sums are made one by one before they are put together.
BLOCK = 64


def sums(xs: Column, start: Column) -> Column:
    """`start`, and what it becomes with every number added in turn."""
    return F.aggregate(xs, F.array(start), lambda out, x: F.concat(out, F.array(F.element_at(out, -1) + x)))


def running(xs: Column) -> Column:
    """For each number the sum of those before it. In blocks, as an array that grows one by one is copied each time."""
    of = lambda xs, start: F.slice(sums(xs, start), F.lit(1), F.size(xs))
    blocks = F.transform(F.sequence(F.lit(0), F.floor((F.size(xs) - 1) / BLOCK).cast("int")), lambda k: F.slice(xs, k * BLOCK + 1, F.lit(BLOCK)))
    totals = lambda bs: of(F.transform(bs, lambda b: F.aggregate(b, F.lit(0), lambda n, x: n + x)), F.lit(0))
    return let(blocks, lambda bs: F.flatten(F.zip_with(bs, totals(bs), of)))


def cells(text: Column) -> Column:
    """Array of the tokens of a text: struct(span, s, n_tokens, link, space_after, following), the last the span of the next one."""
    def parts(x: Column) -> Column:
        return let(elided(x["piece"]), lambda e: F.transform(e, lambda p, i: F.struct(p.alias("span"), (i == F.size(e) - 1).alias("last"), F.when(i == F.size(e) - 1, x["mark"]).alias("mark"))))
    width = lambda x: F.length(x["span"]) + F.when(x["mark"].isNotNull(), 1).otherwise(0)
    def placed(xs: Column) -> Column:
        return let(running(F.transform(xs, width)), lambda at: F.transform(xs, lambda x, i: F.struct(
            x["span"].alias("span"), F.get(at, i).alias("s"), F.size(xs).alias("n_tokens"), (F.coalesce(x["mark"], F.lit("")) == "=").alias("link"), x["last"].alias("space_after"), F.get(xs, i + 1)["span"].alias("following"),
        )))
    return let(F.flatten(F.transform(pieces(text), parts)), placed)


def split_tokens(units: DataFrame, keys: list[str] = KEYS, keep: list[str] = UNIT_COLUMNS) -> DataFrame:
    """One row per token: keys, kept columns, idx, span, s, e, link, space_after, n_tokens, following (the next span). Offsets count from 0."""
    rows = units.select(*keys, *keep, F.posexplode(cells(F.col("text"))).alias("idx", "__x"))
    return rows.select(*keys, *keep, "idx", *[F.col(f"__x.{c}").alias(c) for c in ("span", "s", "n_tokens", "link", "space_after", "following")]).withColumn("e", F.col("s") + F.length("span"))


def short_pause(span: Column) -> Column:
    """Whether a token of this text is a short pause, as `classified` has it."""
    return (span == "(.)") | ((F.regexp_replace(span, MARKS, "") == "{P}") & ~(span.startswith("((") & span.endswith("))")))


def classified(tokens: DataFrame, markers: tuple[str, ...] = ()) -> DataFrame:
    """Adds type, form (before features), token_variation, syllables. `markers`: which of hash_doubtful, hash_token, dollar mean something."""
    span = F.col("span")
    bare = F.regexp_replace(span, MARKS, "")
    marked = F.when(F.lit("hash_doubtful" in markers) & bare.startswith("#*"), "doubtful").when(F.lit("hash_token" in markers) & bare.startswith("#"), "token").when(F.lit("dollar" in markers) & bare.startswith("$"), "emerging").otherwise("none")
    df = tokens.withColumn("bare", bare).withColumn("token_variation", marked)
    cut = F.when(F.col("token_variation") == "doubtful", F.substring("bare", 3, 2**30)).when(F.col("token_variation") != "none", F.substring("bare", 2, 2**30)).otherwise(F.col("bare"))
    df = df.withColumn("word", cut)
    word = F.col("word")
    special = [
        (span == "(.)", "shortpause"), (span.startswith("((") & span.endswith("))"), "nonverbalbehavior"), (F.regexp_replace("bare", r"(?U)\s", "") == "", "error"),
        (F.col("bare").startswith("@"), "anonymized"), (F.col("bare") == "{P}", "shortpause"), (F.col("bare").startswith("{"), "nonverbalbehavior"), (F.col("bare").rlike("^x+$"), "unknown"),
    ]
    early, kind = F.lit(False), F.when(word.rlike(r"^po':*[.,?]?$") | word.rlike(WORD), "linguistic").when(F.col("token_variation") != "none", "warning").otherwise("error")
    for test, name in reversed(special):
        kind = F.when(test, name).otherwise(kind)
    for test, _ in special:
        early = early | test
    form = (
        F.when((span == "(.)") | (span.startswith("((") & span.endswith("))")), span)
        .when(F.regexp_replace("bare", r"(?U)\s", "") == "", "")
        .when(early, F.col("bare"))
        .when(word.rlike(r"^po':*[.,?]?$"), F.regexp_replace("word", "'(:*)", "$1'"))
        .otherwise(word)
    )
    return df.withColumns({
        "type": kind, "form": form, "token_variation": F.when(early, "none").otherwise(F.col("token_variation")),
        "syllables": F.when(kind == "unknown", F.length("bare")),
    }).drop("bare", "word")


def prolonged(text: Column) -> Column:
    """Array of struct(at, n): after which character of the form how many colons stood; the last run after a character counts."""
    runs = F.transform(spans(text, ":+"), lambda x: F.struct((F.length(F.regexp_replace(F.substring(text, F.lit(1), x["s"]), "[:'~-]", "")) - 1).alias("at"), (x["e"] - x["s"]).alias("n")))
    return F.filter(runs, lambda x, i: (x["at"] >= 0) & ~F.exists(F.slice(runs, i + 2, F.size(runs)), lambda y: y["at"] == x["at"]))


def featured(tokens: DataFrame) -> DataFrame:
    """Adds intonation, interrupted, truncated, volume, prolongations; the form loses what they say. Words, unknown and anonymised tokens have features."""
    has = F.col("type").isin("linguistic", "anonymized")
    last = F.right("form", F.lit(1))
    df = tokens.withColumn("intonation", F.when(has & last.isin(list(INTONATION)), F.element_at(F.create_map(*[F.lit(x) for p in INTONATION.items() for x in p]), last)))
    df = df.withColumn("form", F.when(F.col("intonation").isNotNull(), F.substring("form", F.lit(1), F.length("form") - 1)).otherwise(F.col("form")))
    df = df.withColumns({
        "interrupted": has & F.col("form").rlike("^[~-]|[~-]$"),
        "truncated": has & F.col("form").rlike("^'|'$") & (F.regexp_replace("form", r"[^\p{L}]", "") != "po") & F.col("space_after"),
        "volume": F.when((has | (F.col("type") == "unknown")) & F.col("form").rlike(r"\p{Lu}"), "high"),
    })
    df = df.withColumn("form", F.when(has | (F.col("type") == "unknown"), F.lower("form")).otherwise(F.col("form")))
    none = F.array().cast("array<struct<at:int,n:int>>")
    df = df.withColumn("prolongations", F.when(has & F.col("form").contains(":"), prolonged(F.col("form"))).otherwise(none))
    return df.withColumn("form", F.when(has, F.replace(F.col("form"), F.lit(":"), F.lit(""))).otherwise(F.col("form")))


def tokenize(units: DataFrame, keys: list[str] = KEYS, keep: list[str] = UNIT_COLUMNS, markers: tuple[str, ...] = ()) -> DataFrame:
    """The tokens of the included units, with all features that need no other unit."""
    units = units.where("include") if "include" in units.columns else units
    df = featured(classified(split_tokens(units, keys, keep), markers))
    foreign = F.col("variation") == "all"
    df = df.withColumns({
        "type": F.when(foreign, "linguistic").otherwise(F.col("type")),
        "language": F.when(foreign | F.col("token_variation").isin("doubtful", "token"), "NO_ISO_CODE"),
    })
    pause_after = ~foreign & F.coalesce(short_pause(F.col("following")), F.lit(False))
    return df.withColumns({"pause_after": pause_after, "first": F.col("idx") == 0, "last": F.col("idx") == F.col("n_tokens") - 1}).drop("following")


def unit_variation(tokens: DataFrame, keys: list[str] = KEYS) -> DataFrame:
    """Rows (keys, variation): all if every token is in another language, else unspecified if the unit says so, else yes if any is."""
    foreign = F.col("language").isNotNull()
    got = tokens.groupBy(*keys, F.col("variation").alias("own")).agg(F.bool_and(foreign).alias("every"), F.bool_or(foreign).alias("some"))
    return got.select(*keys, final_variation().alias("variation"))


def final_variation() -> Column:
    """From whether every token, and any, is in another language, and what the unit says."""
    return F.when(F.col("every"), "all").when(F.col("own") == "unspecified", "unspecified").when(F.col("some"), "yes").otherwise(F.col("own"))


def form_place(span: Column, upto: Column) -> Column:
    """How many characters of the form stand in the first `upto` characters of a token's text: all but colons, stops and brackets."""
    return F.length(F.regexp_replace(F.substring(span, F.lit(1), upto), r"[:.,?\[\]()<>°]", ""))


LISTS = {"slow": "slow", "fast": "fast", "low": "low", "guess_spans": "guesses", "reduction_spans": "reduced", "overlap_spans": "overlaps"}


def labelled(spans: str, kind: str) -> Column:
    return F.transform(spans, lambda x, i: F.struct(F.lit(kind).alias("kind"), i.alias("span_id"), x["s"].alias("xs"), x["e"].alias("xe")))


def every_span() -> Column:
    """Array of struct(kind, span_id, xs, xe) of all spans of a unit."""
    return F.concat(*[labelled(c, k) for c, k in LISTS.items()])


def unit_spans(units: DataFrame, keys: list[str] = KEYS) -> DataFrame:
    """Rows (keys, kind, span_id, xs, xe, offset) of all spans of the units; offset is the unit's number of guesses."""
    rows = units.select(*keys, F.size("guess_spans").alias("offset"), F.explode(every_span()).alias("x"))
    return rows.select(*keys, "offset", "x.kind", "x.span_id", "x.xs", "x.xe")


def touched(tokens: DataFrame, units: DataFrame, keys: list[str] = KEYS) -> DataFrame:
    """Rows (keys, idx, form, kind, span_id, cs, ce, offset): which characters of which token's form each span of a unit covers."""
    return covered(tokens.select(*keys, "idx", "span", "form", "s", "e").join(unit_spans(units, keys), keys).where("xs < e and xe > s"), keys)


def touched_own(units: DataFrame, keys: list[str] = KEYS, markers: tuple[str, ...] = ()) -> DataFrame:
    """What `touched` gives for the tokens of the units themselves, which are split here, without a join. Units should be written: what they are computed from is computed again for the test that they have spans."""
    own = units.withColumns({"__spans": every_span(), "offset": F.size("guess_spans")}).where("size(__spans) > 0")
    rows = tokenize(own, keys, [*UNIT_COLUMNS, "__spans", "offset"], markers)
    hit = rows.select(*keys, "idx", "span", "form", "s", "e", "offset", F.explode(F.filter("__spans", lambda x: (x["xs"] < F.col("e")) & (x["xe"] > F.col("s")))).alias("x"))
    return covered(hit.select(*keys, "idx", "span", "form", "s", "e", "offset", "x.*"), keys)


def covered(hit: DataFrame, keys: list[str] = KEYS) -> DataFrame:
    """Tokens beside the spans they meet, as rows of `touched`."""
    cs = form_place(F.col("span"), F.greatest(F.col("xs") - F.col("s"), F.lit(0)))
    ce = form_place(F.col("span"), F.least(F.col("xe") - F.col("s"), F.length("span")))
    return hit.select(*keys, "idx", "form", "kind", "span_id", cs.alias("cs"), ce.alias("ce"), "offset").where("ce > cs")


def with_reductions(spans: DataFrame, whitelist: list[str], keys: list[str] = KEYS) -> DataFrame:
    """Brackets inside a word reduce it if the forms they touch are on the whitelist; else they are guesses, numbered after the unit's own."""
    by = Window.partitionBy(*keys, "kind", "span_id")
    phrase = F.lower(F.array_join(F.transform(F.sort_array(F.collect_list(F.struct("idx", "form")).over(by)), lambda x: x["form"]), " "))
    known = F.col("phrase").isin([w.lower() for w in whitelist]) if whitelist else F.lit(False)
    other = (F.col("kind") == "reduced") & ~known
    df = spans.withColumn("phrase", F.when(F.col("kind") == "reduced", phrase))
    return df.withColumns({"span_id": F.when(other, F.col("span_id") + F.col("offset")).otherwise(F.col("span_id")), "kind": F.when(other, "guesses").otherwise(F.col("kind"))}).drop("phrase", "offset", "form")


KINDS = ["slow", "fast", "low", "guesses", "reduced", "overlaps"]


def span_texts(hits: DataFrame, whitelist: list[str] = (), matches: DataFrame | None = None, keys: list[str] = KEYS) -> DataFrame:
    """Rows (keys, idx, KINDS): the texts of the spans on a token, such as 0-3(0), empty where it has none; from rows of `touched`."""
    spans = with_reductions(hits, list(whitelist), keys).withColumn("label", F.col("span_id").cast("string"))
    if matches is not None:
        named = matches.select(*keys, "span_id", F.col("event").cast("string").alias("event"), F.lit("overlaps").alias("kind"))
        spans = spans.join(named, [*keys, "kind", "span_id"], "left").withColumn("label", F.when(F.col("kind") == "overlaps", F.col("event")).otherwise(F.col("label"))).drop("event")
    spans = spans.where("kind <> 'overlaps' or label is not null") if matches is not None else spans.where("kind <> 'overlaps'")
    item = F.concat_ws("", F.col("cs").cast("string"), F.lit("-"), F.col("ce").cast("string"), F.lit("("), F.col("label"), F.lit(")"))
    texts = [F.array_join(F.transform(F.sort_array(F.collect_list(F.when(F.col("kind") == k, F.struct(F.col("span_id").alias("o"), item.alias("t"))))), lambda x: x["t"]), ",").alias(k) for k in KINDS]
    return spans.groupBy(*keys, "idx").agg(*texts)


def with_texts(tokens: DataFrame, text: dict[str, Column]) -> DataFrame:
    """Tokens with slow, fast, guesses, overlaps (null where empty), reduced; low volume overrides the volume."""
    out = tokens.withColumns({k: F.when(c != "", c) for k, c in text.items()})
    return out.withColumns({"reduced": F.col("reduced").isNotNull(), "volume": F.when(F.col("low").isNotNull(), "low").otherwise(F.col("volume"))}).drop("low")


def with_spans(tokens: DataFrame, units: DataFrame, whitelist: list[str] = (), matches: DataFrame | None = None, keys: list[str] = KEYS) -> DataFrame:
    """Adds slow, fast, guesses, overlaps (texts such as 0-3(0), or null), reduced; low volume overrides the volume.

    `matches`: rows (keys, span_id, event) of overlap spans and the event, or `?`, that each stands for;
    without them overlaps stay null.
    """
    out = tokens.join(span_texts(touched(tokens, units, keys), whitelist, matches, keys), [*keys, "idx"], "left")
    return with_texts(out, {k: F.col(k) for k in KINDS})


def unit_marks(units: DataFrame, whitelist: list[str] = (), matches: DataFrame | None = None, keys: list[str] = KEYS, markers: tuple[str, ...] = ()) -> DataFrame:
    """Rows (keys, marks): of the units with spans, the texts of every token that has any, an array of struct(idx, KINDS)."""
    texts = span_texts(touched_own(units, keys, markers), whitelist, matches, keys)
    return texts.groupBy(*keys).agg(F.collect_list(F.struct("idx", *KINDS)).alias("marks"))


def with_marks(tokens: DataFrame) -> DataFrame:
    """What `with_spans` adds, from `marks` that tokens have of their unit."""
    own = tokens.withColumn("__mark", F.get(F.filter("marks", lambda m: m["idx"] == F.col("idx")), F.lit(0)))
    return with_texts(own, {k: F.col(f"__mark.{k}") for k in KINDS}).drop("__mark", "marks")

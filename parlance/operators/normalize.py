"""Normalisation and validation of transcription units: an ordered registry of column rules.

A warning rule rewrites the text and counts its changes; an error rule judges the final text. Rules
run in their order, each on what the one before it left, as a few expressions of nested bindings
(a projection for each would make a plan of a hundred of them); counts of the same name add up. Patterns are Java's, with (?U) where word characters, word edges or
white space are meant in Unicode. Rules are guarded by a search for what they need, which is literal
strings where these suffice: bytes are searched, and the text isn't decoded for a pattern.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass, field
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from parlance.functions.italian import cardinal
from parlance.functions.matches import count, let, map_matches, matches

#: Fixed values of the notation: a short pause, a non-verbal event, and either.
PAUSE = r"\(\.\)"
EVENT = r"\(\([^()]*\)\)"
EITHER = rf"{EVENT}|{PAUSE}"

#: Errors of spacing and how they are mended, one after the other. Texts and counts depend on each.
SPACING = [
    (r"([^ \[\(<>°])([\[\(]) ([^ ])", "$1 $2$3"),
    (r"([\[\(]) ([^ ])", "$1$2"),
    (r"([^ ]) ([\)\]])([^ ])", "$1$2 $3"),
    (r"([^ ]) ([\)\]])", "$1$2"),
    (r"([^ ]) ([.,:?])([^ ])", "$1$2 $3"),
    (r"([^ ]) ([.,:?])", "$1$2"),
    (r"([^ \[\(<>°])(\(\([^()]*\)\)|\(\.\))", "$1 $2"),
    (r"(\(\([^()]*\)\)|\(\.\))([^ \]\)<>°])", "$1 $2"),
]
#: A pause and a prosodic link at either end of a unit; a bracket beyond them stays ($1$2).
END_PAUSE = r"^([\[\]()<>°]?)\s*\(\.\)\s*|\s*\(\.\)\s*([\[\]()<>°]?)$"
END_LINK = r"^([\[\]()<>°]?)\s*=\s*|\s*=\s*([\[\]()<>°]?)$"
#: Words whose final è is é, whatever markers stand between their letters.
ACUTE = ["perchè", "benchè", "finchè", "poichè", "anzichè", "dopodichè", "granchè", "fuorchè", "affinchè", "pressochè", "nè"]
#: Words written with an apostrophe for the accent, and their last letter as it should be.
APOSTROPHES = [("pero'", "ò"), ("perche'", "é"), ("puo'", "ò")]
#: Spellings of discourse markers, corrected one after the other.
CORRECTIONS = [
    ("va beh", "vabbè"), ("va be'", "vabbè"), ("va be", "vabbè"), ("ma va'", "ma va"), ("vabbe", "vabbè"), ("cè", "c(io)è"), ("mha", "mah"), ("emh", "ehm"), ("hem", "ehm"),
    ("he", "eh"), ("hmhm", "mhmh"), ("mhm", "mhmh"), ("hm", "mh"), ("m", "mh"), ("ih", "hi"), ("vah", "va"), ("và", "va"),
]


def present(text: Column, needs: str | tuple[str, ...] | None) -> Column | None:
    """Whether the text has any of the strings, or the pattern; None if nothing is needed."""
    if isinstance(needs, tuple):
        return reduce(lambda a, b: a | b, [text.contains(n) for n in needs])
    return text.rlike(needs) if needs else None


@dataclass(frozen=True)
class Sub:
    """A substitution; `needs` is a pattern, or strings of which one is there, without which it can't match, cheaper to look for.

    Matches are counted only where the text has changed, unless `same` says that a match may leave it as it was.
    """

    pattern: str
    replacement: str
    needs: str | tuple[str, ...] | None = None
    same: bool = False

    def count(self, text: Column) -> Column:
        return count(text, self.pattern)

    def apply(self, text: Column) -> Column:
        return F.regexp_replace(text, self.pattern, self.replacement)


@dataclass(frozen=True)
class Mapped:
    """Every match rewritten by a column function."""

    pattern: str
    change: Callable[[Column], Column]
    needs: str | tuple[str, ...]
    changes: Callable[[Column], Column] | None = None

    def count(self, text: Column) -> Column:
        if self.changes:
            return F.aggregate(F.transform(matches(text, self.pattern), self.changes), F.lit(0), lambda a, b: a + b)
        return count(text, self.pattern)

    def apply(self, text: Column) -> Column:
        return map_matches(text, self.pattern, self.change)


@dataclass(frozen=True)
class Emptied:
    """Nothing but marks of structure: the unit becomes empty."""

    needs: str = r"(?U)^[\[\]()<>°\-'#\s]*+\z"

    def count(self, text: Column) -> Column:
        return F.lit(1)

    def apply(self, text: Column) -> Column:
        return F.lit("")


@dataclass(frozen=True)
class Rule:
    """A named warning rule: steps in order, white space at the ends cut afterwards if `trim`, `also` after that without being counted.

    `needs` is what one step at least needs: without it all steps leave the text as it is.
    """

    name: str
    steps: list = field(default_factory=list)
    trim: bool = True
    also: list = field(default_factory=list)
    default: bool = True
    needs: str | tuple[str, ...] | None = None


@dataclass(frozen=True)
class Check:
    """A named error rule: true where the text is faulty."""

    name: str
    faulty: Callable[[Column], Column]
    default: bool = True


def trimmed(text: Column) -> Column:
    # most texts have none: their first and last characters are looked at before the whole
    ends = F.concat(F.substring(text, 1, 1), F.substring(text, -1, 1))
    return F.when(ends.rlike(r"(?U)\s"), F.regexp_replace(text, r"(?U)^\s+|\s+$", "")).otherwise(text)


#: What a rule of spacing is about.
OPENS, CLOSES, STOPS, EVENTS = ("[ ", "( "), (" )", " ]"), (" .", " ,", " :", " ?"), ("((", "(.)")


def spacing() -> list[Sub]:
    """SPACING, each guarded by the sign that it is about."""
    guards = [OPENS, OPENS, CLOSES, CLOSES, STOPS, STOPS, EVENTS, EVENTS]
    return [Sub(pattern, mended, guard) for (pattern, mended), guard in zip(SPACING, guards, strict=True)]


def ordered(letters: str, outside: str) -> str:
    """Within a stretch free of the characters `outside`: the letters in order, each the first of its kind after the one before, so that the search never goes back."""
    return letters[0] + "".join(f"[^{outside}{c}]*+{c}" for c in letters[1:])


def acute(words: list[str]) -> Mapped:
    """In a stretch without space, = and ' that has the letters of a word in order, up to an è that ends a word: the last such è, for every word in turn. Only stretches with an è are taken out."""
    patterns = [rf"(?sU)^[^{w[0]}]*+{ordered(w[:-1], '')}.*è\b" for w in words]

    def step(x: Column, p: Column) -> Column:
        found = F.regexp(x["text"], p)
        return F.struct(F.when(found, F.regexp_replace(x["text"], r"(?sU)è\b(?!.*è\b)", "é")).otherwise(x["text"]).alias("text"), (x["n"] + found.cast("int")).alias("n"))

    # most stretches have no word at all
    some = "(?sU)^(?:" + "|".join(rf"[^{w[0]}]*+{ordered(w[:-1], '')}.*è\b" for w in words) + ")"
    mended = lambda m: F.aggregate(F.array(*map(F.lit, patterns)), F.struct(m.alias("text"), F.lit(0).alias("n")), step)
    return Mapped(r"(?<![^ ='])[^ ='è]*+è[^ =']*+", lambda m: F.when(F.regexp(m, F.lit(some)), mended(m)["text"]).otherwise(m), ("è",), lambda m: F.when(F.regexp(m, F.lit(some)), mended(m)["n"]).otherwise(0))


def apostrophe(word: str, last: str) -> Mapped:
    """In a stretch without space and = that has the letters of the word in order, from the start of a word: what follows the last letter up to the last apostrophe goes."""
    letter = word[-2]
    has = rf"(?U)\b{ordered(word[:-1], ' =')}[^ =]*'"
    return Mapped("[^ =]+", lambda m: F.when(m.rlike(has), F.regexp_replace(m, f"{letter}[^{letter}]*'([^']*)$", f"{last}$1")).otherwise(m), has, lambda m: m.rlike(has).cast("int"))


def corrections(words: list[tuple[str, str]]) -> Mapped:
    """Whole words: between the ends, spaces and prosodic links, nothing else. In one pass, which is the same as one after the other: no spelling ends with the word that another begins with, nor with what one becomes."""
    pattern = rf"(?<![^ =])(?:{'|'.join(rf'\Q{wrong}\E' for wrong, _ in words)})(?![^ =])"
    return Mapped(pattern, lambda m: F.element_at(F.create_map(*[F.lit(x) for pair in words for x in pair]), m), pattern)


def inside(text: Column) -> tuple[Column, Column]:
    """A span without one space after its first character, and then without one before its last; how many went."""
    first = (F.substring(text, 2, 1) == " ").cast("int")
    text = F.when(first == 1, F.concat(F.substring(text, 1, 1), F.substring(text, F.lit(3), F.length(text)))).otherwise(text)
    last = ((F.length(text) > 1) & (F.substring(text, F.length(text) - 1, F.lit(1)) == " ")).cast("int")
    text = F.when(last == 1, F.concat(F.substring(text, F.lit(1), F.length(text) - 2), F.right(text, F.lit(1)))).otherwise(text)
    return text, first + last


#: A span of slow or fast pace; one that isn't closed reaches to the end. Marks of its own kind may stand inside.
PACE = r"<[^>]*>|<[^>]*$|>[^<]*<|>[^<]*$"

WARNINGS = [
    Rule("SYMBOL_NOT_ALLOWED", [Sub(r"(?U)[^{}_,?.:=°><\[\]()\w\s'\-~$#@*]", "")]),
    Rule("META_TAGS", [Mapped(EVENT, lambda m: F.replace(m, F.lit(" "), F.lit("_")), ("((",))], trim=False),
    Rule("UNEVEN_SPACES", spacing(), needs=OPENS + CLOSES + STOPS + EVENTS),
    Rule("TRIM_PAUSES", [Sub(f"(?U){END_PAUSE}", "$1$2", ("(.)",))]),
    Rule("TRIM_PROSODICLINKS", [Sub(f"(?U){END_LINK}", "$1$2", ("=",))]),
    Rule("UNEVEN_SPACES", [Sub(" =|= ", "=", (" =", "= "))]),
    Rule("OVERLAP_PROLONGATION", [Sub(r"(?U)(\w:*)\[:", "[$1:", ("[:",))], trim=False),
    Rule("MULTIPLE_SPACES", [Sub(r"\t+", " ", ("\t",)), Sub(r"\n+", " ", ("\n",)), Sub(r"(?U)\s\s+", " ", r"(?U)\s\s")]),
    Rule("ACCENTS", [acute(ACUTE)], trim=False),
    Rule("ACCENTS", [Sub(r"(?U)\bp([^ =\p{L}]*)ò\b", "p$1o'", ("ò",))]),
    Rule("ACCENTS", [apostrophe(*x) for x in APOSTROPHES], trim=False, needs=("'",)),
    Rule("WORD_CORRECTIONS", [corrections(CORRECTIONS)], trim=False),
    Rule("NUMBERS", [Mapped(r"(?U)\b[0-9]+\b", cardinal, "[0-9]")], trim=False),
    Rule("UNEVEN_SPACES", [Mapped("°[^°]+°", lambda m: inside(m)[0], ("°",), lambda m: inside(m)[1])]),
    Rule("UNEVEN_SPACES", [Mapped(PACE, lambda m: inside(m)[0], ("<", ">"), lambda m: inside(m)[1])]),
    Rule("SWITCHES", [Sub("([.,?])([:-~])", "$2$1", "[.,?][:-~]", same=True)]),
    Rule("SWITCHES", [
        Sub(rf"(\[)({EVENT})", "$2 $1", ("[((",)), Sub(rf"([(<>°])({EITHER})", "$2 $1", ("((", "<(", ">(", "°(")),
        Sub(rf"({EVENT})(\])", "$2 $1", ("))]",)), Sub(rf"({EITHER})([)><°])", "$2 $1", ("))", ")>", ")<", ")°")),
    ], needs=("((", "(.)")),
    Rule("UNEVEN_SPACES", spacing(), needs=OPENS + CLOSES + STOPS + EVENTS),
    Rule("EMPTY_SPANS", [Sub(r"(?U)\[\s*\]|\(\s*\)|<\s*>|>\s*<|°\s*°", "", r"(?U)\[\s*\]|\(\s*\)|<\s*>|>\s*<|°\s*°")], also=[Sub(" {2,}", " ")]),
    Rule("EMPTY_UNIT", [Emptied()], trim=False),
]


def masked(text: Column) -> Column:
    """Pauses and events blanked out by as many underscores, so that offsets stay."""
    return F.when(present(text, EVENTS), map_matches(text, EITHER, lambda m: F.repeat(F.lit("_"), F.length(m)))).otherwise(text)


def marked(text: Column, marks: str, faulty: Column) -> Column:
    """A text without any of the marks isn't faulty."""
    return F.when(present(text, tuple(marks)), faulty).otherwise(F.lit(False))


ERRORS = [
    Check("UNBALANCED_DOTS", lambda t: marked(t, "°", F.length(F.regexp_replace(t, "[^°]", "")) % 2 == 1)),
    Check("UNBALANCED_PACE", lambda t: marked(t, "<>", ~t.rlike(r"^(?:[^<>]*+(?:<[^<>]*+>|>[^<>]*+<))*+[^<>]*+$"))),
    Check("UNBALANCED_GUESS", lambda t: marked(t, "()", ~masked(t).rlike(r"^[^()]*+(?:\([^()]*+\)[^()]*+)*+$"))),
    Check("UNBALANCED_OVERLAP", lambda t: marked(t, "[]", ~t.rlike(r"^[^\[\]]*+(?:\[[^\[\]]*+\][^\[\]]*+)*+$"))),
]
NAMES = list(dict.fromkeys(r.name for r in WARNINGS))


def enabled(rule: Rule | Check, config: dict[str, bool] | None) -> bool:
    return (config or {}).get(rule.name, rule.default)


def stepped(step: Sub | Mapped | Emptied) -> Callable[[Column], Column]:
    def use(x: Column) -> Column:
        if isinstance(step, Sub) and not step.same:
            counted = lambda new: F.struct(new.alias("text"), F.when(new == x["text"], x["n"]).otherwise(x["n"] + step.count(x["text"])).alias("n"))
            got = let(step.apply(x["text"]), counted)
        else:
            got = F.struct(step.apply(x["text"]).alias("text"), (x["n"] + step.count(x["text"])).alias("n"))
        has = present(x["text"], step.needs)
        return got if has is None else F.when(has, got).otherwise(x)

    return use


def ruled(rule: Rule) -> Callable[[Column], Column]:
    """The state (text, changes of every rule so far) after a rule."""

    def use(state: Column) -> Column:
        start = F.struct(state["text"].alias("text"), F.lit(0).alias("n"))
        got = start
        for step in rule.steps:
            got = let(got, stepped(step))
        if rule.needs:
            got = F.when(present(state["text"], rule.needs), got).otherwise(start)

        def last(x: Column) -> Column:
            text = x["text"]
            for step in rule.also:
                text = step.apply(text)
            ended = lambda t: F.struct((trimmed(t) if rule.trim else t).alias("text"), F.concat(state["counts"], F.array(x["n"])).alias("counts"))
            return let(text, ended) if rule.also else ended(text)

        return let(got, last)

    return use


#: Bindings of one expression: the analyzer resolves one more in every round, and its rounds are limited.
DEPTH = 20


def stages(rules: list[Rule]) -> list[list[Rule]]:
    out, depth = [], DEPTH
    for rule in rules:
        own = len(rule.steps) + 2 + bool(rule.also)
        if depth + own > DEPTH:
            out.append([])
            depth = 0
        out[-1].append(rule)
        depth += own
    return out


def apply_rules(df: DataFrame, rules: list[Rule], text: str = "text", names: list[str] | None = None) -> DataFrame:
    """`df` with the column `text` rewritten by the rules, and w_<name> counting their changes."""
    names = names or list(dict.fromkeys(r.name for r in rules))
    df = df.withColumn("__state", F.struct(F.col(text).alias("text"), F.array().cast("array<int>").alias("counts")))
    for stage in stages(rules):
        state = F.col("__state")
        for rule in stage:
            state = let(state, ruled(rule))
        df = df.withColumn("__state", state)
    counts = F.col("__state.counts")
    total = {n: sum((counts[k] for k, r in enumerate(rules) if r.name == n), F.lit(0)).cast("long") for n in names}
    return df.withColumns({text: F.col("__state.text")} | {f"w_{n}": total[n] for n in names}).drop("__state")


def apply_checks(df: DataFrame, text: str = "text", config: dict[str, bool] | None = None) -> DataFrame:
    """`df` with e_<name>: whether the text fails the check. A check that is off never fails."""
    return df.withColumns({f"e_{c.name}": F.coalesce(c.faulty(F.col(text)), F.lit(False)) if enabled(c, config) else F.lit(False) for c in ERRORS})


def normalize(df: DataFrame, text: str = "text", config: dict[str, bool] | None = None) -> DataFrame:
    """`df` with `text` normalised, a count w_<rule> for every warning rule and a flag e_<rule> for every error rule."""
    return apply_checks(apply_rules(df, [r for r in WARNINGS if enabled(r, config)], text, NAMES), text, config)

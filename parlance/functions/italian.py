"""Italian cardinal numbers as a column expression."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from parlance.functions.matches import let

#: The words that cardinals are built from.
SMALL = ["zero", "uno", "due", "tre", "quattro", "cinque", "sei", "sette", "otto", "nove", "dieci", "undici", "dodici", "tredici", "quattordici", "quindici", "sedici", "diciassette", "diciotto", "diciannove"]
TENS = ["", "dieci", "venti", "trenta", "quaranta", "cinquanta", "sessanta", "settanta", "ottanta", "novanta"]
#: What stands before -ilione and -iliardo, from a million upwards.
LARGE = ["m", "b", "tr", "quadr", "quint", "sest", "sett", "ott", "nov", "dec"]
SCALES = [f"{prefix}il{end}" for prefix in LARGE for end in ("ione", "iardo")]
#: Vowels that fall away before uno and otto.
CONTRACTIONS = [("ao", "o"), ("io", "o"), ("au", "u"), ("iu", "u")]
#: Digits of the longest number that has a name.
MOST_DIGITS = 6 + 3 * len(SCALES) - 1


def contracted(text: Column) -> Column:
    for a, b in CONTRACTIONS:
        text = F.replace(text, F.lit(a), F.lit(b))
    return text


def word(words: list[str], n: Column) -> Column:
    return F.element_at(F.array(*map(F.lit, words)), (n + 1).cast("int"))


def below_hundred(n: Column) -> Column:
    """Empty for 0."""
    return F.when(n == 0, "").when(n < 20, word(SMALL, n % 20)).otherwise(contracted(F.concat(word(TENS, F.floor(n / 10)), F.when(n % 10 == 0, "").otherwise(word(SMALL, n % 10)))))


def below_thousand(n: Column) -> Column:
    """Empty for 0."""
    many = lambda rest: F.concat(F.when(n < 200, "").otherwise(word(SMALL, F.floor(n / 100) % 10)), F.lit("cento"), rest)
    return let(below_hundred(n % 100), lambda rest: F.when(n < 100, rest).otherwise(F.replace(many(rest), F.lit("oo"), F.lit("o"))))


def preceded(rest: Column, n: Column, words: Column, scale: Column) -> Column:
    """So many of a scale (a million, or more than that) before the rest."""
    many = F.concat(F.substring(scale, F.lit(1), F.length(scale) - 1), F.lit("i"))
    head = F.when(n == 1, F.concat(F.lit("un "), scale)).otherwise(F.concat(words, F.lit(" "), many))
    return F.when(n == 0, rest).when(rest == "", head).otherwise(F.concat(head, F.when(rest.contains(" e "), ", ").otherwise(" e "), rest))


def composed(groups: Column, words: Column) -> Column:
    """From the three-digit groups of a number, the lowest first and two at least, and their words."""
    thousands = F.when(groups[1] == 0, "").when(groups[1] == 1, "mille").otherwise(F.concat(words[1], F.lit("mila")))
    names = F.array(*map(F.lit, SCALES))
    higher = F.transform(F.slice(groups, F.lit(3), F.size(groups)), lambda n, k: F.struct(n.alias("n"), F.get(words, k + 2).alias("words"), F.get(names, k).alias("scale")))
    return F.aggregate(higher, F.concat(thousands, words[0]), lambda rest, x: preceded(rest, x["n"], x["words"], x["scale"]))


def cardinal(digits: Column) -> Column:
    """The words for a string of digits, `tre` at the end of a longer word accented. Zeros in front don't count; a number of more than MOST_DIGITS has no name and stays as it is."""
    def words(number: Column) -> Column:
        size = F.greatest(F.lit(2), F.ceil(F.length(number) / 3)).cast("int")
        padded = F.lpad(number, size * 3, "0")
        groups = F.transform(F.sequence(size - 1, F.lit(0), F.lit(-1)), lambda k: F.substring(padded, k * 3 + 1, F.lit(3)).cast("long"))
        text = let(groups, lambda g: let(F.transform(g, below_thousand), lambda w: composed(g, w)))
        return F.when(number == "", SMALL[0]).otherwise(F.regexp_replace(text, "(?<=.)tre$", "tré"))
    return let(F.regexp_replace(digits, "^0+", ""), lambda number: F.when(F.length(number) > MOST_DIGITS, digits).otherwise(words(number)))

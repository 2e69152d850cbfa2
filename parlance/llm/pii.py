"""PII: keyed surrogates of the same type and format, in DataFrame functions only.

Entities are found by one pattern, and on request cards and IBANs must have valid check digits. Each
entity stands for one or two identities: a name for a surname and a given name of a gender, an
e-mail address for itself in lower case, any other for itself. The surrogate depends on the key and
the identity, so it is the same wherever the identity stands (coreference): Mr John Smith, Mrs Smith
and a bare John Smith or Smith later in that text share a surname. Digits of phones, cards, social
security numbers and IBANs, and the two halves of IP addresses, pass a keyed Feistel network over
their own number of digits: a permutation, so different entities of one format never share a
surrogate; the format stays (spaces, hyphens, country code, check digits that hold). E-mail
addresses, secrets, IPv6 addresses and names get hashed surrogates; a name keeps its title and its
case, and its words are drawn by the gender of the title and in the script of the name.

All distinct identities are checked: where two of a kind share a surrogate, all but the first are
given another, and so is one whose surrogate is an identity that the documents have, until none is
left. With every attempt names get two syllables more, so they can't run out.

Defined results: null text counts as empty and has no entity; overlapping finds go to the one that
starts first, then to the order of KINDS; repeated rows get the same result; rows with a null id
keep their surrogates too; a long text is one row like others. An empty table gives no rows. Other
columns are ignored, whatever their names.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import small, whole_text, written

#: Titles by gender, and the words that surrogate names are made of.
MALE = ["Mr", "Herr", "Señor", "Monsieur", "Signor", "господин"]
FEMALE = ["Mrs", "Ms", "Miss", "Frau", "Señora", "Madame", "Signora", "госпожа"]
NEUTRAL = ["Dr", "Prof", "Doctor", "Professor"]
GIVEN = {
    ("latin", "m"): ["Adam", "Bruno", "David", "Emil", "Felix", "Hugo", "Jonas", "Leo", "Marco", "Oscar", "Paul", "Simon", "Theo", "Victor", "Walter", "Xavier"],
    ("latin", "f"): ["Alma", "Bianca", "Clara", "Diana", "Emma", "Flora", "Greta", "Ida", "Julia", "Laura", "Maria", "Nina", "Olivia", "Rosa", "Sofia", "Vera"],
    ("cyrillic", "m"): ["Андрей", "Борис", "Виктор", "Глеб", "Денис", "Егор", "Иван", "Кирилл", "Лев", "Максим", "Никита", "Олег", "Павел", "Роман", "Сергей", "Юрий"],
    ("cyrillic", "f"): ["Алла", "Вера", "Галина", "Дарья", "Елена", "Жанна", "Зоя", "Инна", "Лидия", "Мария", "Нина", "Ольга", "Полина", "Раиса", "Тамара", "Юлия"],
}
SYLLABLES = {
    "latin": ["ba", "ce", "di", "fo", "ga", "he", "ki", "lo", "ma", "ne", "po", "ri", "sa", "te", "vi", "zo"],
    "cyrillic": ["ба", "ве", "ги", "до", "жа", "зе", "ки", "ло", "ма", "не", "по", "ри", "са", "те", "фи", "хо"],
}
OCTET = r"(?:25[0-5]|2[0-4]\d|1\d\d|[1-9]?\d)"
TITLES = "|".join([*MALE, *FEMALE, *NEUTRAL, *[t.upper() for t in MALE + FEMALE + NEUTRAL]])
HEXTET = r"[0-9A-Fa-f]{1,4}"
#: Words before a surname that belong to it, in small letters or with a capital.
PARTICLES = ["van", "von", "der", "den", "de", "del", "della", "di", "da", "dos", "du", "la", "le", "ten", "ter", "zu", "zum"]
PARTICLE = "|".join([*PARTICLES, *map(str.capitalize, PARTICLES)])
#: A word of a name: parts of it may follow an apostrophe or a hyphen. A surname: such a word, with its particles.
NAME_WORD = r"\p{Lu}(?:\p{L}*+['’-]\p{L})*+\p{L}*+"
SURNAME = rf"(?:(?:{PARTICLE})[ ])*{NAME_WORD}"
#: What an entity of each kind looks like. None can backtrack over a long run.
KINDS = {
    "email": r"(?<![A-Za-z0-9._%+-])[A-Za-z0-9._%+-]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)+",
    "phone": r"(?<![\w+])\+\d{1,3}[ .-]?\(?\d{2,4}\)?(?:[ .-]?\d{2,4}){2,3}(?!\w|\.\d)|(?<![\w+])(?:\(\d{3}\) ?|\d{3}[.-])\d{3}[.-]\d{4}(?!\w|\.\d)|(?<![\w+])(?=(?:\d ?){9,12}(?![\d ]*\d))0\d{1,4}(?: \d{2,4}){2,4}(?!\w|\.\d)",
    "card": r"(?<!\w)\d{4}[ -]?\d{4}[ -]?\d{4}[ -]?\d{4}(?!\w)",
    "ssn": r"(?<!\w)\d{3}-\d{2}-\d{4}(?!\w)",
    "ip": rf"(?<![\w.])(?:{OCTET}\.){{3}}{OCTET}(?!\w|\.\d)",
    "ipv6": rf"(?<![\w:.])(?:{HEXTET}:){{7}}{HEXTET}(?![\w:])|(?<![\w:.])(?:{HEXTET}:){{2,6}}(?::{HEXTET}){{1,5}}(?![\w:])",
    "iban": r"(?<!\w)[A-Z]{2}\d{2}(?: ?[A-Z0-9]{4}){2,7}(?: ?[A-Z0-9]{1,3})?(?!\w)",
    "access_key": r"(?<!\w)(?:AKIA|ASIA)[A-Z0-9]{16}(?!\w)",
    "token": r"(?<!\w)(?:gh[opsru]_[A-Za-z0-9]{30,}+|xox[abprs]-[A-Za-z0-9-]{10,}+|sk-[A-Za-z0-9_-]{20,}+)(?!\w)",
    "secret": r"(?<!\w)(?i:password|passwd|secret|token|api_?key)[ \t]{0,3}[=:][ \t]{0,3}[\"']?[A-Za-z0-9_+/-]{8,}",
    "name": rf"(?<!\p{{L}})(?:{TITLES})\.?[ ](?:{SURNAME}(?:[ ]{SURNAME})?)(?<=\p{{L}}\p{{L}})",
}
#: No entity starts after a character of a word, which is asked once for all kinds.
PATTERN = rf"(?<!\w)(?:{'|'.join(f'(?:{p})' for p in KINDS.values())})"
#: Texts without any of these hold no entity.
GUARD = rf"[0-9@=:_]|(?<!\w)(?:xox|sk-|(?:{TITLES})\.? \p{{L}})"
#: Two characters that Unicode leaves to programs. The first is doubled by a third where a text has it, so the two together only stand at the ends of entities.
ESCAPE, MARK, PLAIN = "\ufdd0", "\ufdd0\ufdd1", "\ufdd0\ufdd2"
ROUNDS, ATTEMPTS = 8, 20
KEY = "surrogates"


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """`body` of a value that is worked out once, and stands once in the plan."""
    return F.element_at(F.transform(F.array(value), body), 1)


def number(key: str, *parts: Column | str | int) -> Column:
    """60 bits, as a number, that depend on the key and the parts."""
    text = F.concat_ws("|", F.lit(key), *[p.cast("string") if isinstance(p, Column) else F.lit(str(p)) for p in parts])
    return F.conv(F.substring(F.sha2(text, 256), 1, 15), 16, 10).cast("long")


def feistel(left: Column, right: Column, most_left: Column, most_right: Column, key: str, tweak: Column) -> Column:
    """A keyed permutation of the pairs (left, right) below the two bounds: struct (a, b)."""
    start = F.struct(left.cast("long").alias("a"), right.cast("long").alias("b"))
    return F.aggregate(
        F.sequence(F.lit(0), F.lit(ROUNDS - 1)), start,
        lambda x, i: F.struct(x["b"].alias("a"), F.pmod(x["a"] + number(key, tweak, i, x["b"]), F.when(i % 2 == 0, most_left).otherwise(most_right)).alias("b")),
    )


def digits_of(text: Column) -> Column:
    return F.regexp_replace(text, r"[^0-9]", "")


def permuted(digits: Column, key: str, tweak: Column) -> Column:
    """A keyed permutation of the digit strings of the same length, up to 36 digits."""
    n = F.length(digits)
    half = F.floor(n / 2).cast("int")
    power = lambda k: F.pow(F.lit(10.0), k).cast("long")
    whole = lambda s: F.when(s == "", F.lit(0)).otherwise(s.cast("long"))
    both = feistel(whole(F.substring(digits, F.lit(1), half)), whole(F.substring(digits, half + 1, n)), power(half), power(n - half), key, tweak)
    return F.concat(F.lpad(both["a"].cast("string"), half, "0"), F.lpad(both["b"].cast("string"), n - half, "0"))


def refilled(x: Column) -> Column:
    """The shape with its digits replaced by other digits, in order; and its capitals by others, where they aren't null."""
    so_far = lambda i, other: F.length(F.regexp_replace(F.substring(x["shape"], F.lit(1), i + 1), other, ""))
    one = lambda c, i: F.when(c.rlike("[0-9]"), F.substring(x["digits"], so_far(i, "[^0-9]"), F.lit(1))).when(c.rlike("[A-Z]"), F.coalesce(F.substring(x["capitals"], so_far(i, "[^A-Z]"), F.lit(1)), c)).otherwise(c)
    return F.array_join(F.transform(F.split(x["shape"], ""), one), "")


def luhn(digits: Column) -> Column:
    """The check digit of a digit string."""
    total = F.aggregate(
        F.transform(F.split(F.reverse(digits), ""), lambda c, i: F.when(i % 2 == 1, c.cast("int")).otherwise(F.element_at(F.array(*[F.lit(k * 2 - 9 * (k > 4)) for k in range(10)]), c.cast("int") + 1))),
        F.lit(0), lambda a, b: a + b,
    )
    return F.pmod(10 - F.pmod(total, F.lit(10)), F.lit(10))


def mod97(text: Column) -> Column:
    """The remainder of capitals and digits as ISO 13616 reads them: A is 10, Z is 35."""
    value = lambda c: F.when(c.rlike("[0-9]"), c.cast("int")).otherwise(F.ascii(c) - 55)
    return F.aggregate(F.split(text, ""), F.lit(0), lambda total, c: F.pmod(total * F.when(c.rlike("[0-9]"), 10).otherwise(100) + value(c), F.lit(97)))


def letters(key: str, entity: Column, attempt: Column, chars: str, count: int) -> Column:
    """`count` characters of `chars`, at most 32, that depend on the entity."""
    digest = F.sha2(F.concat_ws("|", F.lit(f"{key}|letters"), attempt.cast("string"), entity), 256)
    byte = lambda k: F.conv(F.substring(digest, 2 * k + 1, F.lit(2)), 16, 10).cast("int")
    return F.array_join(F.transform(F.sequence(F.lit(0), F.lit(count - 1)), lambda k: F.substring(F.lit(chars), F.pmod(byte(k), F.lit(len(chars))) + 1, F.lit(1))), "")


def long_hash(key: str, entity: Column, attempt: Column) -> Column:
    return F.concat(*[F.sha2(F.concat_ws("|", F.lit(key), F.lit(str(k)), attempt.cast("string"), entity), 256) for k in range(2)])


def picked(words: list[str], n: Column) -> Column:
    return F.element_at(F.split(F.lit(" ".join(words)), " "), (F.pmod(n, F.lit(len(words))) + 1).cast("int"))


def kind_of(entity: Column, checked: bool) -> Column:
    """The kind of a find; where check digits are asked for, empty if they don't hold."""
    out = F.lit("name")
    for kind in reversed([k for k in KINDS if k != "name"]):
        out = F.when(entity.rlike(f"^(?:{KINDS[kind]})$"), kind).otherwise(out)
    if not checked:
        return out
    last = F.right(digits_of(entity), F.lit(1)).cast("int")
    code = F.regexp_replace(entity, " ", "")
    card = luhn(F.regexp_replace(digits_of(entity), ".$", "")) == last
    iban = mod97(F.concat(F.substring(code, F.lit(5), F.length(code)), F.substring(code, 1, 4))) == 1
    return let(out, lambda kind: F.when((kind == "card") & ~card, "").when((kind == "iban") & ~iban, "").otherwise(kind))


def name_parts(name: Column) -> Column:
    """Of a name without its title: the given name, if it has one, and the surname with its particles."""
    first = F.substring_index(name, " ", 1)
    alone = ~name.contains(" ") | F.lower(first).isin(PARTICLES)
    return F.when(alone, F.array(name)).otherwise(F.array(first, F.substring(name, F.length(first) + 2, F.length(name))))


def title_of(name: Column) -> Column:
    return F.regexp_extract(name, r"^(\p{L}+\.?[ ])", 1)


def identities(kind: Column, entity: Column) -> Column:
    """What an entity stands for: an array of (kind, value)."""
    one = lambda k, v: F.struct(k.alias("kind"), v.alias("value"))
    none = F.filter(F.array(one(kind, entity)), lambda _: F.lit(False))

    def names(title: Column) -> Column:
        bare = F.lower(F.regexp_replace(title, r"[. ]", ""))
        gender = F.when(bare.isin([t.lower() for t in MALE]), "m").when(bare.isin([t.lower() for t in FEMALE]), "f").otherwise("n")
        named = F.lower(F.substring(entity, F.length(title) + 1, F.length(entity)))
        script = F.when(named.rlike(r"\p{IsCyrillic}"), "cyrillic").otherwise("latin")
        return let(F.struct(name_parts(named).alias("words"), script.alias("script"), gender.alias("gender")), parts)

    def parts(x: Column) -> Column:
        # a Cyrillic surname goes by gender too, as its ending does
        family = one(F.concat_ws(":", F.lit("family"), x["script"], F.when(x["script"] == "cyrillic", x["gender"]).otherwise("n")), F.element_at(x["words"], -1))
        given = one(F.concat_ws(":", F.lit("given"), x["script"], x["gender"]), x["words"][0])
        return F.when(F.size(x["words"]) > 1, F.array(given, family)).otherwise(F.array(family))

    return F.when(kind == "name", let(title_of(entity), names)).when(kind == "email", F.array(one(kind, F.lower(entity)))).when(kind == "", none).otherwise(F.array(one(kind, entity)))


def numeric(kind: Column, entity: Column, key: str, attempt: Column) -> Column:
    """The replacement of a phone, a card, a social security number or an IBAN."""
    digits = digits_of(entity)
    # what is permuted: of a phone the digits after the country code, of a card all but the last, of an IBAN those after the check digits
    code = F.when(kind == "phone", F.concat(F.regexp_extract(entity, r"^\+(\d{1,3})[ .(-]", 1), F.regexp_extract(entity, "^0", 0))).otherwise("")
    shape = F.when(kind == "iban", F.substring(entity, F.lit(5), F.length(entity))).otherwise(entity)
    inner = F.when(kind == "card", F.regexp_replace(digits, ".$", "")).when(kind == "iban", digits_of(shape)).otherwise(F.substring(digits, F.length(code) + 1, F.length(digits)))
    country = F.when(kind == "iban", F.substring(entity, 1, 2)).otherwise("")
    parts = F.struct(code.alias("code"), shape.alias("shape"), inner.alias("inner"), country.alias("country"), F.right(digits, F.lit(1)).cast("int").alias("last"))

    def formed(x: Column, new: Column) -> Column:
        # the check digit of a card is as far from the right one as it was
        card = F.concat(new, F.pmod(x["last"] - luhn(x["inner"]) + luhn(new), F.lit(10)).cast("string"))
        # the capitals of an IBAN are moved by amounts that depend on the new digits
        moved = F.transform(F.split(F.regexp_replace(x["shape"], "[^A-Z]", ""), ""), lambda c, i: F.when(c == "", "").otherwise(F.char(F.pmod(F.ascii(c) - 65 + number(key, "capital", attempt, i, new), F.lit(26)) + 65)))
        return let(F.struct(x["shape"].alias("shape"), F.when(kind == "card", card).otherwise(F.concat(x["code"], new)).alias("digits"), F.when(kind == "iban", F.array_join(moved, "")).alias("capitals")), refilled)

    def whole(x: Column, body: Column) -> Column:
        # the check digits of an IBAN are as far from the right ones as they were
        two = lambda b: 98 - mod97(F.concat(F.regexp_replace(b, " ", ""), x["country"], F.lit("00")))
        return F.when(kind == "iban", F.concat(x["country"], F.lpad(F.pmod(F.substring(entity, 3, 2).cast("int") - two(x["shape"]) + two(body), F.lit(100)).cast("string"), 2, "0"), body)).otherwise(body)

    tweak = lambda x: F.concat_ws(":", attempt.cast("string"), kind, x["code"], x["country"])
    return let(parts, lambda x: let(let(permuted(x["inner"], key, tweak(x)), lambda new: formed(x, new)), lambda body: whole(x, body)))


def hashed(kind: Column, entity: Column, key: str, attempt: Column) -> Column:
    """The replacement of an IPv6 address, an e-mail address, an access key, a token or a secret."""
    email = F.concat(letters(key, entity, attempt, "abcdefghijklmnopqrstuvwxyz", 10), F.regexp_replace(F.regexp_extract(entity, r"^[^@]*?([._-]?\d*)@", 1), r"\d", "7"), F.lit("@"), letters(key, F.concat(F.lit("host"), F.substring_index(entity, "@", -1)), F.lit(0), "abcdefghijklmnopqrstuvwxyz", 8), F.lit(".example"))
    access = F.concat(F.substring(entity, 1, 4), letters(key, entity, attempt, "ABCDEFGHIJKLMNOPQRSTUVWXYZ234567", 16))
    ipv6 = lambda hexes: F.array_join(F.transform(F.split(entity, ""), lambda c, i: F.when(c.rlike("[0-9a-f]"), F.substring(hexes, i + 1, F.lit(1))).when(c.rlike("[A-F]"), F.upper(F.substring(hexes, i + 1, F.lit(1)))).otherwise(c)), "")
    start = F.when(kind == "token", F.regexp_extract(entity, r"^(gh._|xox.-|sk-)", 1)).otherwise(F.regexp_extract(entity, r"^(\w+[ \t]*[=:][ \t]*[\"']?)", 1))
    secret = lambda x: F.concat(x["start"], F.substring(F.repeat(x["hexes"], F.ceil(x["n"] / 128).cast("int")), F.lit(1), x["n"]))
    hexes = long_hash(key, entity, attempt)
    return F.when(kind == "email", email).when(kind == "ipv6", let(hexes, ipv6)).when(kind == "access_key", access).otherwise(let(F.struct(start.alias("start"), hexes.alias("hexes"), (F.length(entity) - F.length(start)).alias("n")), secret))


def word(kind: Column, entity: Column, key: str, attempt: Column) -> Column:
    """The replacement of a given name or a surname."""

    def drawn(script: str, n: Column) -> Column:
        syllables, men, women = SYLLABLES[script], GIVEN[script, "m"], GIVEN[script, "f"]
        more = F.when(attempt > 0, F.array_join(F.transform(F.sequence(F.lit(1), F.greatest(2 * attempt, F.lit(1))), lambda k: picked(syllables, number(key, "syllable", entity, attempt, k))), "")).otherwise(F.lit(""))
        ending = F.when(kind == "family:cyrillic:f", "ва").when(kind.startswith("family:cyrillic"), "в").otherwise("")
        given = F.when(kind.endswith("m"), picked(men, n)).when(kind.endswith("f"), picked(women, n)).otherwise(picked(men + women, n))
        family = F.initcap(F.concat(*[picked(syllables, F.shiftright(n, 8 + 6 * k)) for k in range(4)], more))
        return F.when(kind.startswith("given"), F.concat(given, more)).otherwise(F.concat(family, ending))

    return let(number(key, "name", kind, entity, attempt), lambda n: F.when(kind.contains("cyrillic"), drawn("cyrillic", n)).otherwise(drawn("latin", n)))


def address(entity: Column, key: str, attempt: Column) -> Column:
    """The replacement of an IPv4 address."""
    pair = lambda x: feistel(x[0] * 256 + x[1], x[2] * 256 + x[3], F.lit(65536), F.lit(65536), key, F.concat_ws(":", attempt.cast("string"), F.lit("ip")))
    octets = F.transform(F.split(entity, r"\."), lambda x: x.cast("long"))
    return let(let(octets, pair), lambda x: F.concat_ws(".", *[y.cast("string") for half in ("a", "b") for y in (F.floor(x[half] / 256), x[half] % 256)]))


def surrogate(kind: Column, entity: Column, key: str, attempt: Column) -> Column:
    """The replacement of one identity."""
    return (
        F.when(kind.isin("phone", "card", "ssn", "iban"), numeric(kind, entity, key, attempt)).when(kind == "ip", address(entity, key, attempt))
        .when(kind.contains(":"), word(kind, entity, key, attempt)).otherwise(hashed(kind, entity, key, attempt))
    )


def found(text: Column) -> Column:
    """What the pattern finds in a text, in order."""
    return F.when(text.rlike(GUARD), F.regexp_extract_all(text, F.lit(PATTERN), F.lit(0))).otherwise(F.array().cast("array<string>"))


def pieces(text: Column) -> Column:
    """A text in pieces, by one pass of the pattern: finds at odd places, what stands between them at even ones."""
    marked = F.regexp_replace(F.regexp_replace(text, ESCAPE, PLAIN), PATTERN, f"{MARK}$0{MARK}")
    return F.when(text.rlike(GUARD), F.transform(F.split(marked, MARK, -1), lambda x: F.regexp_replace(x, PLAIN, ESCAPE))).otherwise(F.array(text))


def tagged(entities: Column, checked: bool) -> Column:
    return F.transform(entities, lambda e: F.struct(kind_of(e, checked).alias("kind"), e.alias("value")))


def colliding(table: DataFrame) -> DataFrame:
    """Of the rows (kind, value, attempt, surrogate): those whose surrogate a row before them of their kind has, or is a value of their kind; a part of a name of any kind is one."""
    sort = F.when(F.col("kind").contains(":"), "name").otherwise(F.col("kind")).alias("sort")
    plain = table.select("kind", sort, F.lower("surrogate").alias("low"), "value", "attempt")
    firsts = plain.groupBy("kind", "low").agg(F.min("value").alias("first"), F.count("*").alias("n")).where("n > 1").select("kind", "low", "first")
    shared = plain.join(firsts, ["kind", "low"]).where("value <> first").select("kind", "value", "attempt")
    real = plain.join(table.select(sort, F.lower("value").alias("low")).distinct(), ["sort", "low"], "left_semi").select("kind", "value", "attempt")
    return shared.unionByName(real).distinct()


def second_choices(rows: DataFrame, key: str, checked: bool) -> DataFrame | None:
    """Rows (kind, value, surrogate) for identities that can't have their first surrogate; None if all can."""
    spark = rows.sparkSession
    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    distinct = rows.select(F.explode(F.array_distinct("entities")).alias("e")).distinct().select(F.explode(identities(kind_of(F.col("e"), checked), F.col("e"))).alias("i")).select("i.*").distinct()
    chosen = lambda df: df.withColumn("surrogate", surrogate(F.col("kind"), F.col("value"), key, F.col("attempt")))
    # dealt to all tasks by number: the rows are few and small, the work on each isn't; by the value alone, as a
    # repartition by what the rows are already dealt by is left out of the plan, and its tasks are put together
    table = written(chosen(distinct.withColumn("attempt", F.lit(0)).repartition(parts, "value")), "entities")
    for _ in range(ATTEMPTS):
        again = written(colliding(table).withColumn("attempt", F.col("attempt") + 1), "again")
        if again.isEmpty():
            changed = table.where("attempt > 0")
            return None if changed.isEmpty() else changed.select("kind", "value", "surrogate")
        table = written(table.join(again, ["kind", "value"], "left_anti").unionByName(chosen(again.repartition(parts, "value"))), "entities")
    raise RuntimeError(f"surrogates still collide after {ATTEMPTS} attempts; their formats are too small for so many entities")


def with_seconds(rows: DataFrame, second: DataFrame) -> DataFrame:
    """`rows` with a map `second` from identities to surrogates that aren't the first choice."""
    # by the finds of a row, not by its id, which may be missing or repeat; rows without any are dealt by text and meet nothing
    rows = rows.withColumn("key", F.when(F.size("found") > 0, F.sha2(F.to_json("found"), 256)).otherwise(F.xxhash64("text").cast("string")))
    per = rows.where(F.size("found") > 0).select("key", "found").dropDuplicates(["key"])
    per = per.select("key", F.explode(F.array_distinct(F.flatten(F.transform("found", lambda t: identities(t["kind"], t["value"]))))).alias("i")).select("key", "i.*").join(second, ["kind", "value"])
    pairs = F.collect_list(F.struct(F.concat_ws("|", "kind", "value").alias("k"), "surrogate"))
    per = written(per.groupBy("key", F.length("key").alias("again")).agg(F.map_from_entries(pairs).alias("second")).drop("again"), "seconds")
    return rows.join(small(per, "second"), "key", "left")


def surrogates(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", key: str = KEY, check_digits: bool = False) -> DataFrame:
    """One row per document: doc_id, text with surrogates, n_entities, kinds (distinct, in order of the alphabet).

    With `check_digits`, numbers in the form of a card or an IBAN whose check digits don't hold are
    no entities; without, they are, and their check digits don't hold afterwards either.
    """
    plain = docs.select(F.col(doc_id).alias("doc_id"), whole_text(text).alias("text"))
    second = second_choices(plain.select(found(F.col("text")).alias("entities")), key, check_digits)
    rows = plain.withColumn("pieces", pieces(F.col("text")))
    rows = rows.withColumn("found", tagged(F.filter("pieces", lambda _, i: i % 2 == 1), check_digits))
    if second is not None:
        rows = with_seconds(rows, second)

    def own(i: Column) -> Column:
        first = surrogate(i["kind"], i["value"], key, F.lit(0))
        return first if second is None else F.coalesce(F.element_at("second", F.concat_ws("|", i["kind"], i["value"])), first)

    def cased(new: Column, old: Column) -> Column:
        return F.when((F.upper(old) == old) & (F.length(old) > 1), F.upper(new)).otherwise(new)

    def replaced(t: Column) -> Column:
        title = title_of(t["value"])
        words = name_parts(F.substring(t["value"], F.length(title) + 1, F.length(t["value"])))
        new = F.transform(identities(t["kind"], t["value"]), own)
        named = F.concat(title, F.array_join(F.transform(F.arrays_zip(new.alias("n"), words.alias("w")), lambda x: cased(x["n"], x["w"])), " "))
        return F.when(t["kind"] == "", t["value"]).when(t["kind"] == "name", named).otherwise(new[0])

    rows = rows.withColumn("new", F.transform("found", replaced))
    # Names of the text, without their titles: whole ones, surnames, given names. One pass with one pattern, so
    # that what has been put in isn't read again; longer ones first, and of equal ones the first.
    bare = lambda e: F.substring(e, F.length(title_of(e)) + 1, F.length(e))
    pairs = F.filter(F.arrays_zip("found", "new"), lambda x: x["found"]["kind"] == "name")

    def parts(x: Column) -> Column:
        old, new = bare(x["found"]["value"]), bare(x["new"])
        both = F.arrays_zip(name_parts(old).alias("old"), F.split(new, " ").alias("new"))
        return F.concat(F.array(F.struct(old.alias("old"), new.alias("new"))), F.when(F.size(both) > 1, F.reverse(both)).otherwise(F.array().cast("array<struct<old:string,new:string>>")))

    rows = rows.withColumn("names", F.flatten(F.transform(pairs, parts)))
    ranked = F.transform(F.sort_array(F.array_distinct(F.transform("names", lambda x: F.struct((-F.length(x["old"])).alias("n"), x["old"].alias("old"))))), lambda x: x["old"])
    rows = rows.withColumn("pattern", F.concat(F.lit(r"(?<!\p{L})(?:"), F.array_join(ranked, "|"), F.lit(r")(?!\p{L})")))
    put = lambda m: F.get(F.filter("names", lambda x: x["old"] == m), F.lit(0))["new"]
    again = lambda p: F.array_join(F.zip_with(F.split(p, F.col("pattern"), -1), F.transform(F.regexp_extract_all(p, F.col("pattern"), F.lit(0)), put), lambda g, m: F.concat(g, F.coalesce(m, F.lit("")))), "")
    joined = F.array_join(F.transform("pieces", lambda p, i: F.when(i % 2 == 1, F.get("new", F.floor(i / 2).cast("int"))).when(F.size("names") > 0, again(p)).otherwise(p)), "")
    kinds = F.filter(F.transform("found", lambda t: t["kind"]), lambda k: k != "")
    return rows.select(
        "doc_id",
        F.when(F.size("found") == 0, F.col("text")).otherwise(joined).alias("text"),
        F.size(kinds).cast("long").alias("n_entities"),
        F.array_join(F.array_sort(F.array_distinct(kinds)), ",").alias("kinds"),
    )

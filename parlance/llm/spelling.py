"""Spelling variants: words one edit from each other, and the more frequent form that each follows.

Words are counted in tasks and summed in a shuffle. A word is looked up in two halves, as one edit
leaves one of them whole: words are dealt to bins by their first halves (at the two lengths that a
word within one edit may have cut there) and by their last halves. A bin holds a minimal acyclic
automaton of its words, read forwards or backwards. Every state knows how many words lie beyond it,
which gives each word its number in sorted order and its count by that number. A word that asks
walks its half exactly and is completed with one error. A word found backwards whose first half is
whole too was found forwards, so it is left out there. A half that very many words share is dealt
over several cells, by what is held and by what asks, so that every word that asks meets all of it. Nothing but one row for each
word and direction leaves a bin: how many words are near, and the most frequent. Chains of forms are
followed by doubling.

Defined results: null and empty texts have no words; a null id counts as an empty one in the
checksum; repeated rows count as often as they come; of near words with equal counts the smallest by
code points is the form. An empty table gives no rows. Other columns are ignored, whatever their names.
"""

from __future__ import annotations

import math
import re
import zlib
from collections import Counter, defaultdict
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import removed, settled, small, whole_groups, whole_text, written

LEAST_LENGTH, LEAST_COUNT = 5, 3
#: Words in a bin; entries of a task's own count.
BIN, HELD = 20_000, 400_000
#: Characters of several bytes that are no letters of U+00C0 to U+00FF, and then all bytes but those of letters.
OTHERS = re.compile(rb"[\xc2\xc4-\xf4][\x80-\xbf]+")
LETTERS = bytes(b if b >= 0x80 or chr(b).isalpha() else 0x20 for b in range(256)).lower()


def runs(text: str) -> list[bytes]:
    return OTHERS.sub(b" ", text.encode()).translate(LETTERS).split()


def altered(run: bytes, checksum: int, every: int) -> bytes:
    """The run, or where `every` divides the checksum, the run without the code point that the checksum names."""
    if checksum % every:
        return run
    word = run.decode()
    at = checksum % len(word)
    return (word[:at] + word[at + 1 :]).encode()


def counted(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", every: int = 97) -> DataFrame:
    """Rows (word, n) of the words that are long and frequent enough."""
    rows = docs.select(F.coalesce(F.col(doc_id).cast("string"), F.lit("")).alias("doc_id"), whole_text(text).alias("text"))

    def sent(total: Counter) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array(list(total), pa.binary()).cast(pa.string()), pa.array(list(total.values()), pa.int64())], ["word", "n"])

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = Counter()
        for batch in batches:
            for name, value in zip(batch.column("doc_id").to_pylist(), batch.column("text"), strict=True):
                start = zlib.crc32(f"{name}:".encode())
                for run, n in Counter(runs(value.as_py())).items():
                    total[altered(run, zlib.crc32(run, start), every)] += n
                if len(total) >= HELD:
                    yield sent(total)
                    total = Counter()
        yield sent(total)

    found = rows.mapInArrow(work, "word string, n long").where(F.length("word") >= LEAST_LENGTH)
    return found.groupBy("word").agg(F.sum("n").alias("n")).where(F.col("n") >= LEAST_COUNT)


class Automaton:
    """Minimal acyclic automaton of sorted words. next[s] maps a letter to a state and to the number of words that come before those beyond it."""

    def __init__(self, words: list[str]):
        self.next: list[dict[str, tuple[int, int]]] = []
        self.final: list[bool] = []
        self.size: list[int] = []
        known: dict[tuple, int] = {}

        def closed(final: bool, arcs: list[tuple[str, int]]) -> int:
            """The state with these arcs, made if there is none yet."""
            key = (final, *arcs)
            state = known.get(key)
            if state is None:
                state = known[key] = len(self.next)
                out, before = {}, int(final)
                for letter, child in arcs:
                    out[letter] = (child, before)
                    before += self.size[child]
                self.next.append(out)
                self.final.append(final)
                self.size.append(before)
            return state

        # the open path of the last word: for each of its places whether a word ends there, and the arcs that are closed
        path: list[tuple[bool, list]] = [(False, [])]
        last = ""
        for word in words:
            same = 0
            top = min(len(last), len(word))
            while same < top and last[same] == word[same]:
                same += 1
            for k in range(len(last), same, -1):
                final, arcs = path.pop()
                path[-1][1].append((last[k - 1], closed(final, arcs)))
            for _ in range(same + 1, len(word)):
                path.append((False, []))
            if len(word) > same:
                path.append((True, []))
            else:
                path[-1] = (True, path[-1][1])
            last = word
        for k in range(len(last), 0, -1):
            final, arcs = path.pop()
            path[-1][1].append((last[k - 1], closed(final, arcs)))
        self.root = closed(*path.pop())

    def ends(self, word: str, at: int, state: int, number: int) -> int:
        """The number of the word whose rest from `at` leads from the state to an end, or -1."""
        for letter in word[at:]:
            arc = self.next[state].get(letter)
            if arc is None:
                return -1
            state, number = arc[0], number + arc[1]
        return number if self.final[state] else -1

    def near(self, word: str, half: int) -> set[int]:
        """Numbers of the words that begin with the first `half` letters and differ in one place after them."""
        state = self.root
        number = 0
        for letter in word[:half]:
            arc = self.next[state].get(letter)
            if arc is None:
                return set()
            state, number = arc[0], number + arc[1]
        found = set()
        for at in range(half, len(word) + 1):
            own = word[at] if at < len(word) else None
            if own:
                found.add(self.ends(word, at + 1, state, number))
            for letter, (child, before) in self.next[state].items():
                found.add(self.ends(word, at, child, number + before))
                if own and letter != own:
                    found.add(self.ends(word, at + 1, child, number + before))
            arc = self.next[state].get(own)
            if arc is None:
                break
            state, number = arc[0], number + arc[1]
        found.discard(-1)
        return found


def searched(words: list[str], counts: list[int], asks: list[bool], holds: list[bool], backwards: bool) -> Iterator[tuple[str, int, int, str]]:
    """(word, number of near words, count of the best, the best) for every asking word that has any, in one automaton."""
    turned = (lambda w: w[::-1]) if backwards else (lambda w: w)
    held = {turned(w): n for w, n, h in zip(words, counts, holds, strict=True) if h}
    order = sorted(held)
    automaton = Automaton(order)
    sizes = [held[w] for w in order]
    for word in dict.fromkeys(w for w, a in zip(words, asks, strict=True) if a):
        first = len(word) // 2
        found = automaton.near(turned(word), len(word) - first if backwards else first)
        if found:
            near = [(-sizes[k], turned(order[k])) for k in found]
            if backwards:
                near = [x for x in near if not x[1].startswith(word[:first])]
            if near:
                best = min(near)
                yield word, len(near), -best[0], best[1]


def bins(words: DataFrame, most: int, many: int) -> DataFrame:
    """Rows (bin, backwards, cell, word, n, asks, holds): each word where it is held and where it asks. A half that is dealt over several cells has automata of their own, so that a word is found in one of them only."""
    length = F.length("word")
    even, first = length % 2 == 0, F.floor(length / 2)
    last = length - first
    # the halves of a word and of words one letter shorter or longer, cut where they would be cut
    kinds = F.array(
        F.struct(F.lit(False).alias("backwards"), F.lit(True).alias("asks"), F.substring("word", F.lit(1), first).alias("half")),
        F.struct(F.lit(False).alias("backwards"), F.lit(False).alias("asks"), F.substring("word", F.lit(1), F.when(even, first - 1).otherwise(first + 1)).alias("half")),
        F.struct(F.lit(True).alias("backwards"), F.lit(True).alias("asks"), F.right("word", last).alias("half")),
        F.struct(F.lit(True).alias("backwards"), F.lit(False).alias("asks"), F.right("word", F.when(even, last + 1).otherwise(last - 1)).alias("half")),
    )
    rows = words.select("word", "n", F.explode(kinds).alias("x")).select("word", "n", "x.*")
    sizes = rows.groupBy("backwards", "half").agg(F.count("*").alias("size"))
    hot = written(sizes.where(F.col("size") > most).select("backwards", "half", F.ceil(F.col("size") / most).cast("int").alias("parts")), "halves")
    rows = rows.join(small(hot, "half"), ["backwards", "half"], "left").withColumn("parts", F.coalesce("parts", F.lit(1)))
    rows = rows.withColumn("own", F.pmod(F.xxhash64("word"), F.col("parts")).cast("int"))
    # (held, asking, asks, holds): words that ask and words that are held are both dealt, so that a cell has a part of each
    place = lambda x, y, asks, holds: F.struct(x.cast("int").alias("x"), y.cast("int").alias("y"), asks.alias("asks"), F.lit(holds).alias("holds"))
    every, own = F.sequence(F.lit(0), F.col("parts") - 1), F.col("own")
    asking = F.when(F.col("asks"), F.transform(every, lambda x: place(x, own, F.lit(True), False))).otherwise(F.array().cast("array<struct<x:int,y:int,asks:boolean,holds:boolean>>"))
    cells = F.when(F.col("parts") == 1, F.array(place(own, own, F.col("asks"), True))).otherwise(F.concat(asking, F.transform(every, lambda y: place(own, y, F.lit(False), True))))
    rows = rows.withColumn("c", F.explode(cells))
    name = F.when(F.col("parts") > 1, F.concat_ws("/", "half", "c.x", "c.y")).otherwise("")
    return rows.select(F.pmod(F.xxhash64("backwards", "half", "c.x", "c.y"), F.lit(many)).alias("bin"), "backwards", name.alias("cell"), "word", "n", "c.asks", "c.holds")


def near_words(words: DataFrame, most: int = BIN) -> DataFrame:
    """Rows (word, n_near, form_n, form): of every word that has near words, their number and the most frequent of them."""

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for group in whole_groups(batches, "bin"):
            parts = defaultdict(list)
            for row in zip(*(group.column(c).to_pylist() for c in ("bin", "backwards", "cell", "word", "n", "asks", "holds")), strict=True):
                parts[row[:3]].append(row[3:])
            for (_, backwards, _), rows in parts.items():
                got = list(searched(*map(list, zip(*rows, strict=True)), backwards))
                if got:
                    yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*got, strict=True), (pa.string(), pa.int64(), pa.int64(), pa.string()), strict=True)], ["word", "n_near", "form_n", "form"])

    # a task for each bin or so: the work goes with words, not with the bytes that tasks are put together by
    many = max(1, math.ceil(4 * words.count() / most))
    found = bins(words, most, many).repartition(many, "bin").sortWithinPartitions("bin").mapInArrow(work, "word string, n_near long, form_n long, form string")
    best = F.min(F.struct((-F.col("form_n")).alias("n"), F.col("form").alias("form")))
    return found.groupBy("word").agg(F.sum("n_near").alias("n_near"), best.alias("best")).select("word", "n_near", (-F.col("best.n")).alias("form_n"), F.col("best.form").alias("form"))


def roots(forms: DataFrame) -> DataFrame:
    """Rows (word, root) of the chains (word, form): the last form of each. A step doubles how far every row has gone, so few steps are needed; counts at least double along a chain, so there are no circles."""
    spark = forms.sparkSession
    ways, path = settled(forms.select("word", F.col("form").alias("root")), "roots")
    while True:
        on = ways.select(F.col("word").alias("root"), F.col("root").alias("further"))
        step, new = settled(ways.join(on, "root", "left").select("word", F.coalesce("further", "root").alias("root"), F.col("further").isNotNull().alias("moved")), "roots")
        removed(spark, path)
        ways, path = step.select("word", "root"), new
        if step.where("moved").isEmpty():
            return ways


def variants(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", every: int = 97, most: int = BIN) -> DataFrame:
    """One row per word: word, form, root, n, n_near, form_n."""
    words, _ = settled(counted(docs, doc_id, text, every), "words")
    near, _ = settled(near_words(words, most), "near")
    rows = words.join(near, "word", "left")
    follows = F.col("form_n") >= 2 * F.col("n")
    rows = rows.select("word", "n", F.coalesce("n_near", F.lit(0)).cast("long").alias("n_near"), F.when(follows, F.col("form")).alias("form"), F.when(follows, F.col("form_n")).alias("form_n"))
    ends = roots(rows.where("form is not null"))
    return rows.join(ends, "word", "left").select("word", "form", F.coalesce("root", "word").alias("root"), "n", "n_near", "form_n")


ORACLE_SQL = r"""
WITH RECURSIVE crc(k, v) AS (SELECT i, list_reduce(list_prepend(CAST(i AS BIGINT), [CAST(x AS BIGINT) FOR x IN range(8)]), lambda c, b: CASE WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END) FROM range(256) t(i)),
     tab AS (SELECT list(v ORDER BY k) AS tab FROM crc),
     d AS (SELECT row_number() OVER () AS r, doc_id, regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[a-z\x{00C0}-\x{00FF}]+') AS ws FROM documents),
     o AS (SELECT doc_id, w, count(*) AS c FROM (SELECT r, doc_id, unnest(ws) AS w FROM d) GROUP BY r, doc_id, w),
     h AS (SELECT w, c, xor(list_reduce(list_prepend(CAST(4294967295 AS BIGINT), [CAST(('0x' || x) AS BIGINT) FOR x IN regexp_extract_all(hex(encode(coalesce(CAST(doc_id AS VARCHAR), '') || ':' || w)), '..')]), lambda s, b: xor(s >> 8, tab[CAST(xor(s, b) & 255 AS INTEGER) + 1])), 4294967295) AS h FROM o, tab),
     x AS (SELECT CASE WHEN h % 97 = 0 THEN left(w, CAST(h % length(w) AS INTEGER)) || substr(w, CAST(h % length(w) AS INTEGER) + 2) ELSE w END AS word, c FROM h),
     v AS (SELECT word, CAST(sum(c) AS BIGINT) AS n FROM x WHERE length(word) >= 5 GROUP BY word HAVING sum(c) >= 3),
     del AS (SELECT DISTINCT word, i, left(word, i - 1) || substr(word, i + 1) AS cut FROM (SELECT word, unnest(range(1, length(word) + 1)) AS i FROM v)),
     near AS (SELECT a.word, b.word AS other FROM del a JOIN del b ON a.i = b.i AND a.cut = b.cut AND a.word <> b.word
              UNION SELECT d.word, v.word FROM del d JOIN v ON d.cut = v.word UNION SELECT v.word, d.word FROM del d JOIN v ON d.cut = v.word),
     best AS (SELECT near.word, count(*) AS n_near, max(v.n) AS top, arg_min(v.word, (-v.n, v.word)) AS other FROM near JOIN v ON v.word = near.other GROUP BY near.word),
     f AS (SELECT v.word, v.n, CAST(coalesce(n_near, 0) AS BIGINT) AS n_near, CASE WHEN top >= 2 * v.n THEN other END AS form, CASE WHEN top >= 2 * v.n THEN top END AS form_n FROM v LEFT JOIN best USING (word)),
     way AS (SELECT word, word AS at, form AS next FROM f UNION ALL SELECT way.word, f.word, f.form FROM way JOIN f ON f.word = way.next)
SELECT f.word, f.form, way.at AS root, f.n, f.n_near, f.form_n FROM f JOIN way ON way.word = f.word AND way.next IS NULL
"""

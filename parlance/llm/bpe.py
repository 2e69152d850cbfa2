"""BPE encoding and decoding by tree concatenation.

Text is encoded without being split first. A text longer than a leaf is halved until its pieces are
leaves; leaves are encoded by themselves, in parallel threads, and neighbours are joined up the tree.
At a join a window of a few tokens of both sides is encoded again, and grows until its first and its
last token are those that the two sides have there, and both its ends are settled. What lies outside
such a window is what the whole text has there:

- An end of a window is settled before white space that follows another character, as no pre-token
  spans such a place, so every scan that sees both characters parts there; inside a run of letters,
  of digits, of white space or of other characters that reaches three characters into the window, as
  no pre-token that starts before the join can then end elsewhere than it did in the side by itself
  (the longest thing the pattern looks at besides runs is a contraction of three characters); and at
  the end of the text.
- Inside a pre-token, two tokens that stand side by side in some encoding may stand side by side in
  any, and a sequence of which that holds throughout is the encoding of its bytes.

Special strings in a text become their own ids, as the tokenizers library does by default. Decoding
puts the bytes of the tokens together, special strings included; bytes that aren't UTF-8 become
U+FFFD.

Defined results: null text counts as empty, which has no ids and decodes to the empty text; a very
long text costs time in proportion to its length and the height of its tree; repeated rows are
returned as they come; ids may be null. An empty table gives no rows. Other columns are ignored,
whatever their names. A vocabulary file that asks for anything but byte-level BPE is refused.
"""

from __future__ import annotations

import functools
import hashlib
import json
import re
import sys
import unicodedata
from array import array
from collections.abc import Iterable, Iterator
from concurrent.futures import ThreadPoolExecutor
from typing import NamedTuple

import numpy as np
import pyarrow as pa
import regex
import tiktoken
from pyspark import SparkFiles
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import whole_text

#: The white space of Unicode; the byte-level pattern, and the same with white space spelled out.
SPACE = r"\t-\r \x85\xa0\u1680\u2000-\u200a\u2028\u2029\u202f\u205f\u3000"
SPLIT = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
PATTERN = rf"'s|'t|'re|'ve|'m|'ll|'d| ?\p{{L}}+| ?\p{{N}}+| ?[^{SPACE}\p{{L}}\p{{N}}]+|[{SPACE}]+(?![^{SPACE}])|[{SPACE}]+"
#: Characters of a leaf, tokens of the first window on each side of a join, threads that encode leaves, and characters of texts encoded together.
LEAF, WINDOW, THREADS, AT_A_TIME = 1024, 8, 2, 1_000_000
#: Characters of one kind that settle the end of a window inside a run: as many as the longest contraction has.
RUN = 3
#: Where a unit may end: before a single space between two characters that aren't white space.
CUT = re.compile(r"(?<=\S) (?=\S)")
UNEVEN = re.compile(r"\s | \s")


def byte_letters() -> dict[str, int]:
    """The letter that stands for each byte in a byte-level vocabulary: itself if it prints, else from 256 on."""
    plain = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    rest = [b for b in range(256) if b not in set(plain)]
    return {chr(b): b for b in plain} | {chr(256 + k): b for k, b in enumerate(rest)}


#: The settings of a byte-level file that the split pattern and the merging here stand for.
SETTINGS = {
    ("normalizer",): None, ("post_processor",): None, ("truncation",): None, ("padding",): None,
    ("pre_tokenizer", "type"): "ByteLevel", ("pre_tokenizer", "add_prefix_space"): False, ("pre_tokenizer", "use_regex"): True, ("decoder", "type"): "ByteLevel",
    ("model", "type"): "BPE", ("model", "dropout"): None, ("model", "unk_token"): None, ("model", "continuing_subword_prefix"): None, ("model", "end_of_word_suffix"): None,
    ("model", "byte_fallback"): False, ("model", "ignore_merges"): False,
}


def check(kept: dict) -> None:
    """Refuse a tokenizers file with other settings, or whose merges aren't in the order of their ids."""
    for path, want in SETTINGS.items():
        value = kept
        for name in path:
            value = (value or {}).get(name)
        if (value or None) != (want or None):
            raise ValueError(f"{'.'.join(path)} of the vocabulary is {value!r}, and has to be {want!r}")
    for x in kept["added_tokens"]:
        if any(x.get(name) for name in ("single_word", "lstrip", "rstrip", "normalized")):
            raise ValueError(f"the added token {x['content']!r} isn't matched as it stands")
    vocab = kept["model"]["vocab"]
    ranks = [vocab["".join(m.split(" ") if isinstance(m, str) else m)] for m in kept["model"]["merges"]]
    if any(a >= b for a, b in zip(ranks, ranks[1:], strict=False)):
        raise ValueError("the merges of the vocabulary aren't in the order of their ids")


class Vocabulary:
    """The tokens of a tokenizers .json file of byte-level BPE."""

    def __init__(self, path: str):
        with open(path, encoding="utf-8") as f:
            kept = json.load(f)
        check(kept)
        letters = byte_letters()
        self.special = {x["content"]: x["id"] for x in kept["added_tokens"]}
        self.ranks = {bytes(letters[c] for c in token): i for token, i in kept["model"]["vocab"].items() if token not in self.special}
        self.bytes = dict(zip(self.ranks.values(), self.ranks, strict=True)) | {i: s.encode() for s, i in self.special.items()}
        self.split = re.compile("(" + "|".join(re.escape(s) for s in sorted(self.special, key=len, reverse=True)) + ")") if self.special else None
        self.pattern = regex.compile(PATTERN)

    def parts(self, text: str) -> Iterator[tuple[str, int | None]]:
        """Stretches of plain text (id None), and special strings with their ids."""
        for k, part in enumerate(self.split.split(text) if self.split and any(s in text for s in self.special) else [text]):
            if part:
                yield part, self.special[part] if k % 2 else None


def units(text: str) -> list[str]:
    """Pieces that are encoded alike alone and in the text; put together they are the text."""
    even = text[0] != " " and text[-1] != " " and not UNEVEN.search(text)
    pieces = text.split(" ") if even else CUT.split(text)
    return [pieces[0], *[" " + p for p in pieces[1:]]]


def kind(c: str) -> str:
    """What the pattern takes a character for: white space, a letter, a digit or another; none of these (empty) where Unicode has no character yet."""
    if c.isspace() and not "\x1c" <= c <= "\x1f":
        return "Z"
    category = unicodedata.category(c)
    return "" if category == "Cn" else category[0] if category[0] in "LN" else "O"


def one_kind(text: str) -> bool:
    return len(text) == RUN and kind(text[0]) != "" and len(set(map(kind, text))) == 1


def parted(before: str, after: str) -> bool:
    """Whether pre-tokens part between two characters, whatever stands around them."""
    return kind(before) != "Z" and kind(after) == "Z"


class Encoded(NamedTuple):
    ids: array
    joins: int
    windows: int


class Codec:
    def __init__(self, path: str, leaf: int = LEAF, window: int = WINDOW, threads: int = THREADS):
        self.vocabulary = v = Vocabulary(path)
        self.leaf, self.window, self.threads = leaf, window, threads
        self.engine = tiktoken.Encoding("own", pat_str=SPLIT, mergeable_ranks=v.ranks, special_tokens=v.special)
        self.pool = ThreadPoolExecutor(threads)

    def leaves(self, text: str, start: int, end: int) -> Iterator[str]:
        """The pieces of text[start:end] that repeated halving leaves, in order."""
        if end - start <= self.leaf:
            yield text[start:end]
        else:
            middle = (start + end) // 2
            yield from self.leaves(text, start, middle)
            yield from self.leaves(text, middle, end)

    def encode_leaves(self, leaves: list[str]) -> list[array]:
        work = lambda some: [array("I", ids) for ids in map(self.engine.encode_ordinary, some)]
        size = -(-len(leaves) // self.threads) or 1
        return [ids for some in self.pool.map(work, [leaves[at : at + size] for at in range(0, len(leaves), size)]) for ids in some]

    def joined(self, text: str, start: int, end: int, leaves: Iterator[array]) -> Encoded:
        """The encoding of text[start:end] from those of its leaves."""
        if end - start <= self.leaf:
            return Encoded(next(leaves), 0, 0)
        middle = (start + end) // 2
        left, right = self.joined(text, start, middle, leaves), self.joined(text, middle, end, leaves)
        ids, windows = self.join(text, start, middle, end, left.ids, right.ids)
        return Encoded(ids, left.joins + right.joins + 1, left.windows + right.windows + windows)

    def join(self, text: str, start: int, middle: int, end: int, left: array, right: array) -> tuple[array, int]:
        """The encoding of text[start:end] from those of its halves, and the number of windows that were encoded."""
        reach, of, windows = self.window, self.vocabulary.bytes, 0
        while True:
            a, b = left[-reach:], right[:reach]
            before, after = (b"".join(map(of.__getitem__, x)) for x in (a, b))
            all_left, all_right = len(a) == len(left), len(b) == len(right)
            # a window neither starts nor ends inside a character; bytes of the form 10xxxxxx go on with one
            first = start if all_left else middle - sum(c & 0xC0 != 0x80 for c in before)
            last = end if all_right else middle + sum(c & 0xC0 != 0x80 for c in after)
            inside = (all_left or before[0] & 0xC0 != 0x80) and (all_right or of[right[reach]][0] & 0xC0 != 0x80)
            if inside and (all_left or parted(text[first - 1], text[first]) or one_kind(text[first : min(first + RUN, middle)])):
                if all_right or parted(text[last - 1], text[last]) or one_kind(text[max(last - RUN, middle) : last]):
                    windows += 1
                    ids = array("I", self.engine.encode_ordinary(text[first:last]))
                    if (all_left or ids[0] == a[0]) and (all_right or ids[-1] == b[-1]):
                        return left[: len(left) - len(a)] + ids + right[len(b) :], windows
            reach *= 2

    def encode_all(self, texts: list[str]) -> list[Encoded]:
        """The encodings of texts; the leaves of all of them are encoded together."""
        parts = [list(self.vocabulary.parts(t)) for t in texts]
        leaves = iter(self.encode_leaves([x for of_text in parts for part, special in of_text if special is None for x in self.leaves(part, 0, len(part))]))
        out = []
        for of_text in parts:
            done = [Encoded(array("I", [special]), 0, 0) if special is not None else self.joined(part, 0, len(part), leaves) for part, special in of_text]
            out.append(done[0] if len(done) == 1 else Encoded(sum((x.ids for x in done), array("I")), sum(x.joins for x in done), sum(x.windows for x in done)))
        return out

    def encode(self, text: str) -> array:
        return self.encode_all([text])[0].ids

    def decode(self, ids: Iterable[int]) -> str:
        return b"".join(map(self.vocabulary.bytes.__getitem__, ids)).decode("utf-8", "replace")


def groups(texts: pa.Array, chars: int = AT_A_TIME) -> Iterator[list[str]]:
    """The texts of a batch in lists of bounded length; a text is never divided."""
    held, length = [], 0
    for value in texts:
        held.append(value.as_py())
        length += len(held[-1])
        if length >= chars:
            yield held
            held, length = [], 0
    if held:
        yield held


def packed(ids: Iterable[int]) -> bytes:
    if sys.byteorder == "little" and array("I").itemsize == 4:
        return (ids if isinstance(ids, array) else array("I", ids)).tobytes()
    return np.array(ids, "<u4").tobytes()


def unpacked(ids: bytes | None) -> list[int]:
    return np.frombuffer(ids or b"", "<u4").tolist()


@functools.lru_cache(1)
def codec(path: str, leaf: int, window: int) -> Codec:
    return Codec(path, leaf, window)


def shipped(spark, path: str) -> str:
    """Send a vocabulary file to every executor; the name to ask SparkFiles for."""
    spark.sparkContext.addFile(path)
    return path.rpartition("/")[2]


def encode(docs: DataFrame, vocabulary: str, doc_id: str = "doc_id", text: str = "text", leaf: int = LEAF, window: int = WINDOW) -> DataFrame:
    """Rows (doc_id, text, ids): ids is binary, little-endian unsigned 32-bit integers."""
    name = shipped(docs.sparkSession, vocabulary)

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = codec(SparkFiles.get(name), leaf, window)
        for batch in batches:
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array([packed(x.ids) for some in groups(batch.column(1)) for x in own.encode_all(some)], pa.binary())], ["doc_id", "text", "ids"])

    return docs.select(F.col(doc_id).cast("long").alias("doc_id"), whole_text(text).alias("text")).mapInArrow(work, "doc_id long, text string, ids binary")


def decode(encoded: DataFrame, vocabulary: str, doc_id: str = "doc_id", ids: str = "ids") -> DataFrame:
    """Rows (doc_id, text) from binary ids."""
    name = shipped(encoded.sparkSession, vocabulary)

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = codec(SparkFiles.get(name), LEAF, WINDOW)
        for batch in batches:
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array([own.decode(unpacked(x.as_py())) for x in batch.column(1)], pa.string())], ["doc_id", "text"])

    return encoded.select(F.col(doc_id).alias("doc_id"), F.col(ids).alias("ids")).mapInArrow(work, "doc_id long, text string")


def digests(docs: DataFrame, vocabulary: str, doc_id: str = "doc_id", text: str = "text", leaf: int = LEAF, window: int = WINDOW) -> DataFrame:
    """Encode, decode, and what identifies both: doc_id, n_tokens, ids_sha256, decoded_sha256; and the joins of the tree with the windows they took. Ids and texts stay in the task."""
    name = shipped(docs.sparkSession, vocabulary)
    schema = "doc_id long, n_tokens long, ids_sha256 string, decoded_sha256 string, n_joins long, n_windows long"

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = codec(SparkFiles.get(name), leaf, window)
        for batch in batches:
            rows = []
            for some in groups(batch.column(1)):
                for x in own.encode_all(some):
                    rows.append((len(x.ids), hashlib.sha256(packed(x.ids)).hexdigest(), hashlib.sha256(own.decode(x.ids).encode()).hexdigest(), x.joins, x.windows))
            kinds = [pa.int64(), pa.string(), pa.string(), pa.int64(), pa.int64()]
            columns = zip(*rows, strict=True) if rows else [()] * len(kinds)
            yield pa.RecordBatch.from_arrays([batch.column(0), *(pa.array(c, k) for c, k in zip(columns, kinds, strict=True))], ["doc_id", "n_tokens", "ids_sha256", "decoded_sha256", "n_joins", "n_windows"])

    return docs.select(F.col(doc_id).cast("long").alias("doc_id"), whole_text(text).alias("text")).mapInArrow(work, schema)

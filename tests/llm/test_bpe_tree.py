"""Every text over a leaf goes through the tree, and comes out as the library has it."""

import json
import random

import public_tokenizers
import pytest
from tokenizers import Tokenizer

from parlance.llm import bpe

from .test_operators import VOCABULARY, docs, prose

PARTS = ["a", "é", " ", "  ", "\n", "1", "!", "'s", "'re", "'", "r", "e", "l", "<|endoftext|>", "字", "ing", " the", "\xa0", "\x1c", "🙂", "\t", "'ll", "abc", "123", "!!!", "    ", "\n\n\n", "ß", "ж"]


@pytest.mark.parametrize(("leaf", "window"), [(1, 1), (2, 1), (3, 1), (5, 2), (16, 3)])
def test_small_leaves(leaf, window):
    rng = random.Random(leaf)
    texts = ["".join(rng.choice(some) for _ in range(rng.randint(1, 60))) for some in (rng.sample(PARTS, rng.randint(1, len(PARTS))) for _ in range(1500))]
    library = Tokenizer.from_file(VOCABULARY).encode_batch(texts, add_special_tokens=False)
    for text, want, got in zip(texts, library, bpe.Codec(VOCABULARY, leaf, window).encode_all(texts), strict=True):
        assert list(got.ids) == want.ids, text


def test_long_texts_have_joins(spark):
    rng = random.Random(3)
    texts = [prose(rng, 2000), "".join(rng.choice("abcdefghij") for _ in range(100_000)), " " * 50_000 + "x", "short", "", None]
    got = {r.doc_id: r for r in bpe.digests(docs(spark, texts), VOCABULARY).collect()}
    library = Tokenizer.from_file(VOCABULARY)
    for i, text in enumerate(texts, 1):
        assert got[i].n_tokens == len(library.encode(text or "", add_special_tokens=False).ids)
        assert (got[i].n_joins > 0) == (len(text or "") > bpe.LEAF) and got[i].n_windows >= got[i].n_joins


def test_other_settings_are_refused(tmp_path):
    with open(VOCABULARY, encoding="utf-8") as f:
        kept = json.load(f)
    kept["pre_tokenizer"]["add_prefix_space"] = True
    path = tmp_path / "other.json"
    path.write_text(json.dumps(kept), encoding="utf-8")
    with pytest.raises(ValueError, match="add_prefix_space"):
        bpe.Vocabulary(str(path))
    with pytest.raises(ValueError):
        bpe.Vocabulary(public_tokenizers.path("word_bpe_49k.json"))

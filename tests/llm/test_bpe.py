"""The transducers against the tokenizers library."""

import random

import numpy as np
import public_tokenizers
import pytest
from tokenizers import Tokenizer

from tidemark.llm import bpe

DEFINITION = open(public_tokenizers.path("byte_bpe_50k.json"), encoding="utf-8").read()


@pytest.fixture(scope="module")
def library():
    return Tokenizer.from_str(DEFINITION)


@pytest.fixture(scope="module")
def merges():
    return bpe.MergeList(DEFINITION)


def expected(library, text):
    return np.array(library.encode(text, add_special_tokens=False).ids, "<u4").tobytes()


def samples():
    rng = random.Random(5)
    letters = ["ab", "etaoinshr", " \n", "'s te re'll", "é日a 🙂", "<|endoftext|>a ", "0123a", "!?- ", "  a\t\r", "\u0085\xa0　a"]
    for k in range(120):
        yield "".join(rng.choice(letters[k % len(letters)]) for _ in range(rng.choice([0, 1, 5, 60, 3000])))
    yield "x" * 5000 + " <|endoftext|>" + " " * 700 + "y"


def test_whole_texts_match_the_library(merges, library):
    encoder, decoder = bpe.Encoder(merges), bpe.Decoder(merges)
    for text in samples():
        packed = encoder.encode(text)
        assert packed == expected(library, text)
        assert decoder.decode(packed) == library.decode(np.frombuffer(packed, "<u4").tolist(), skip_special_tokens=False) == text


@pytest.mark.parametrize("size", [1, 3, 40, 1000])
def test_slices_do_not_matter(merges, library, size, monkeypatch):
    monkeypatch.setattr(bpe, "SLICE", 200)
    encoder = bpe.Encoder(merges, block=64)
    for text in samples():
        parts = [encoder.feed(text[k : k + size]) for k in range(0, len(text), size)]
        assert b"".join([*parts, encoder.finish()]) == expected(library, text)


def test_what_is_held_back_is_bounded(merges):
    encoder = bpe.Encoder(merges)
    rng = random.Random(1)
    for _ in range(12):
        encoder.feed("".join(rng.choice("etaoin") for _ in range(bpe.SLICE)))
        assert len(encoder.pending) <= encoder.block + merges.lookahead
        assert len(encoder.rest) <= 2 * bpe.SLICE
    encoder.finish()


def test_lookahead_bounds_every_change(merges):
    """Tokens that end further left than the lookahead stay, whatever follows."""
    rng = random.Random(2)
    for _ in range(60):
        left = bytes(rng.choice(b"abcdeinorst") for _ in range(merges.lookahead + 200))

        def stable(right):
            end, kept = 0, []
            for i in merges.merge(left + right):
                end += len(merges.bytes_of[i])
                if end > len(left) - merges.lookahead:
                    break
                kept.append(i)
            return kept

        assert stable(b"") == stable(b"ing") == stable(b"zz") == stable(b"e" * 40)


def test_lookahead_of_a_small_list():
    """With merges ab, bc and abc -> d, a byte decides over two to its left."""
    letters = ["a", "b", "c", *[c for c in bpe.byte_letters() if c not in "abc"]]
    vocab = {c: k for k, c in enumerate(letters)} | {"bc": 300, "ab": 301}
    small = bpe.MergeList('{"added_tokens": [], "model": %s}' % __import__("json").dumps({"vocab": vocab, "merges": [["b", "c"], ["a", "b"]]}))
    assert small.lookahead == 2
    assert small.merge(b"abc") == [0, 300] and small.merge(b"ab") == [301]


def test_broken_bytes_decode_like_the_library(merges, library):
    ids = np.random.default_rng(3).integers(0, 50_257, 3000).astype("<u4")
    assert bpe.Decoder(merges).decode(ids.tobytes()) == library.decode(ids.tolist(), skip_special_tokens=False)


def test_odd_rows(odd_docs, no_docs, library):
    clash = odd_docs.withColumnRenamed("lang", "ids")
    tokens = bpe.bpe_encode(clash, DEFINITION)
    assert sorted(tokens.columns) == sorted(clash.columns)
    for row in bpe.bpe_decode(tokens, DEFINITION).collect():
        assert bytes(row["ids"]) == expected(library, row["text"] or "") and row["decoded"] == (row["text"] or "")
    assert bpe.bpe_encode(no_docs, DEFINITION).count() == 0

"""Words made to collide in polynomial hashes are still told apart."""

import zlib

import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest
from tokenizers import Tokenizer

from orderloom.llm import packing, repetition, substrings
from orderloom.llm.common import word_hash_pairs, words_of

from .conftest import plain

CASELESS = public_tokenizers.path("word_bpe_49k.json")


def thue_morse(n):
    """The sequence and its complement, as words of n letters."""
    bits = [bin(i).count("1") % 2 for i in range(n)]
    return "".join("ab"[b] for b in bits), "".join("ba"[b] for b in bits)


def pairs(texts):
    return word_hash_pairs(words_of(pa.record_batch([pa.array(texts)], ["text"])))


@pytest.mark.parametrize("n", [1024, 2048, 8192])
def test_words_of_one_polynomial_hash_differ(spark, n):
    one, other = thue_morse(n)
    found = pairs([f"{one} {other}"])
    assert (found[0] != found[1]).all()

    want = [Tokenizer.from_file(CASELESS).encode(t, add_special_tokens=False).ids for t in (one, other)]
    ids = packing.Ids(CASELESS)
    for t, w in zip((one, other), want, strict=True):
        assert ids([t]) == [np.array(w, "<u4").tobytes()]
    both = spark.createDataFrame([(1, one), (2, other)], "doc_id long, text string").coalesce(1)
    got = {(r.doc_id, r.start): r.ids_crc32 for r in packing.pack(both, CASELESS).collect()}
    for i, w in enumerate(want):
        full = np.array([*w, 1], "<u4")
        for s in range(0, len(full), 2048):
            assert got[i + 1, s] == zlib.crc32(full[s:s + 2048].tobytes())

    lead = " ".join(f"w{i}" for i in range(19))
    docs = spark.createDataFrame([(1, f"{lead} {one}"), (2, f"{lead} {other}")],
                                 "doc_id long, text string")
    assert [r.n_removed for r in substrings.digest(docs).orderBy("doc_id").collect()] == [0, 0]

    seven = " ".join(f"v{i}" for i in range(7))
    text = f"{seven} {one} {seven} {other}"
    docs = spark.createDataFrame([(1, text)], "doc_id long, text string")
    assert [r.n_repeat_words for r in repetition.repetition(docs).collect()] == [0]


def test_hashes_of_short_words_are_their_own():
    rng = np.random.default_rng(5)
    words = {bytes(rng.integers(33, 127, rng.integers(1, 12)).astype(np.uint8)).decode()
             for _ in range(20_000)} | {"a", "a\0", "\0a", "é", "\0", "\0\0", "aaaaaaa", "aaaaaaaa"}
    words = sorted(words)
    own = packing.exact_pairs(words_of(pa.record_batch([pa.array([" ".join([*words, "x" * 15, "x" * 16,
                                                                             "x" * 17])])], ["text"])))
    assert len(np.unique(own, axis=0)) == len(own) == len(words) + 3
    found = pairs([" ".join(words)])
    assert len(found) == len(words)
    assert len(np.unique(found[:, 0])) == len(np.unique(found[:, 1])) == len(words)
    assert (pairs(words) == found).all()


def test_changed_hash_of_a_known_pre_token_goes_to_the_library(monkeypatch):
    ids, library = packing.Ids(CASELESS), Tokenizer.from_file(CASELESS)
    ids(["other words", "thing"])
    real = packing.exact_pairs
    monkeypatch.setattr(packing, "exact_pairs",
                        lambda w: np.stack([np.full(len(w.first), real(w)[0, 0]), real(w)[:, 1]], 1))
    texts = ["apple pear", "pear", "apple"]
    want = [np.array(library.encode(t, add_special_tokens=False).ids, "<u4").tobytes() for t in texts]
    assert ids(texts) == want


def test_spans_are_told_by_their_words_not_their_spaces(spark):
    a = [f"word{i}" for i in range(25)]
    docs = spark.createDataFrame([(1, " ".join(a)), (2, "\n \t".join(a))], "doc_id long, text string")
    assert plain(substrings.digest(docs).select("doc_id", "n_removed")) == [(1, 0), (2, 25)]

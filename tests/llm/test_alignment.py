"""Alignment of two tokenizers against a plain count over whole texts."""

import base64
import hashlib
import random
import re
from collections import Counter

import public_tokenizers
import pytest
import sentencepiece
from tokenizers import Tokenizer

from orderloom.llm import alignment

from .conftest import document_rows, plain

BYTES = public_tokenizers.path("byte_bpe_50k.json")
PIECES = public_tokenizers.path("piece_bpe_32k.model")


@pytest.fixture(scope="module")
def libraries():
    a, b = Tokenizer.from_file(BYTES), sentencepiece.SentencePieceProcessor(model_file=PIECES)
    a.encode_special_tokens = True
    with open(public_tokenizers.path("byte_bpe_50k.tiktoken"), "rb") as f:
        a_bytes = {int(i): base64.b64decode(t) for t, i in map(bytes.split, f)}
    b_bytes = {}
    for i in range(b.get_piece_size()):
        p = b.id_to_piece(i)
        byte = re.fullmatch("<0x(..)>", p)
        b_bytes[i] = bytes.fromhex(byte[1]) if byte else p.replace("\u2581", " ").encode()
    return a, b, a_bytes, b_bytes


def groups_of(libraries, text):
    """Plain groups of a whole text, from decoded bytes only; none if a side does not decode."""
    a, b, a_bytes, b_bytes = libraries
    if not text:
        return [], [], []
    one, other = a.encode(" " + text, add_special_tokens=False).ids, b.encode(text)
    want = (" " + text).encode()
    if b"".join(map(a_bytes.get, one)) != want or b"".join(map(b_bytes.get, other)) != want:
        return [], [], []
    groups, i, j = [([], [])], 0, 0
    x = y = 0
    while i < len(one) or j < len(other):
        if x <= y and i < len(one):
            groups[-1][0].append(one[i])
            x, i = x + len(a_bytes[one[i]]), i + 1
        else:
            groups[-1][1].append(other[j])
            y, j = y + len(b_bytes[other[j]]), j + 1
        if x == y:
            groups.append(([], []))
    return one, other, groups[:-1]


def plain_alignment(libraries, rows):
    found = [(d, *groups_of(libraries, t)) for d, t in rows]
    count = Counter((g[0][-1], g[1][-1]) for *_, groups in found for g in groups)
    most = {}
    for (_, b), n in count.items():
        most[b] = max(n, most.get(b, 0))
    out = []
    for d, one, other, groups in found:
        pairs = [(g[0][-1], g[1][-1]) for g in groups]
        said = ";".join(f"{','.join(map(str, x))}|{','.join(map(str, y))}" for x, y in groups)
        out.append((d, len(one), len(other), len(groups), len(pairs),
                    sum(count[p] == most[p[1]] for p in pairs), sum(count[p] for p in pairs),
                    hashlib.sha256(said.encode()).hexdigest() if groups else ""))
    return sorted(out, key=repr)


ODD = ["\u65e5\u672c\u8a9e \u4e2d\u6587\U0001f600x \U0001f9d1\u200d\U0001f680", " ", "  ", "a ", " a", "a  b   c ",
       "tab\there\n new\n\n  line \n", "nb\u00a0sp \u00a0x\u00a0 y", "under\u2581score", "<s> </s> <unk> <|endoftext|>",
       "<0x0A> <0xE9>", "caf\u00e9 na\u00efve \u1e9e\u0131\u0130", "e\u0301 \u0928\u092e\u0938\u094d\u0924\u0947",
       "\x1c x\x1f y\x85z \u2028w\u3000v", "\x00 \x00a", "{\r\n}\r ();\r x", "it's we'll 'tis", "\t", "\n \n", "1234567 89.0",
       "\ufb01 \ufb02 \uff21\uff22 \u2460", "x" * 500, "\u9f98" * 30, "a\u0308" * 20, ".. ... ,,, ;;", "\ufeffx"]


def test_odd_texts_equal_the_plain_alignment(spark, libraries):
    rng = random.Random(8)
    letters = [*"ab  \n\t.'1\u00e9\u4e2d\U0001f600\u2581\u00a0\x1c\r", "the", " ing", "  ", "<s>", "'s", *",;:!?", "a,", ".b", "\u0101!", "\u00d7."]
    texts = ODD + ["".join(rng.choices(letters, k=rng.randint(1, 30))) for _ in range(1500)]
    rows = list(enumerate(texts))
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    assert plain(alignment.alignment(docs, BYTES, PIECES)) == plain_alignment(libraries, rows)


def test_documents_equal_the_plain_alignment(docs, libraries):
    want = plain_alignment(libraries, [r[:2] for r in document_rows()])
    assert plain(alignment.alignment(docs, BYTES, PIECES)) == want


def test_more_partitions_than_tasks_change_nothing(spark, libraries):
    rows = [(i, f"the {w} of {w}s, {w}") for i, w in enumerate(["cat", "dogma", "na\u00efve", "token", "x"] * 30)]
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(40)
    assert plain(alignment.alignment(docs, BYTES, PIECES)) == plain_alignment(libraries, rows)


def test_small_blocks_and_a_small_memory_change_nothing(docs, libraries, monkeypatch):
    want = plain_alignment(libraries, [r[:2] for r in document_rows()])
    own = alignment.Aligner(BYTES, PIECES)
    rows = alignment._block_rows(BYTES, PIECES, 5)
    monkeypatch.setattr(alignment, "blocks", lambda d, *a: d.select("doc_id", "text").mapInArrow(
        rows, f"block long, doc_id long, {alignment.TEXTS}, links binary, pairs binary, counts binary"))
    assert plain(alignment.alignment(docs, BYTES, PIECES)) == want
    monkeypatch.setattr(alignment, "REMEMBERED", 3)
    texts = [r[1] for r in document_rows()]
    for _ in range(2):
        got = [(n_a, n_b, sha) for _, sha, n_a, n_b in own.texts(texts)]
        assert got == [w[1:3] + w[7:] for w in (plain_alignment(libraries, [(0, t)])[0] for t in texts)]


def test_nothing(no_docs, spark):
    assert alignment.alignment(no_docs, BYTES, PIECES).collect() == []
    empty = spark.createDataFrame([(1, None), (2, "")], "doc_id long, text string")
    assert plain(alignment.alignment(empty, BYTES, PIECES)) == [(i, 0, 0, 0, 0, 0, 0, "") for i in (1, 2)]


def test_ends_inside_characters_come_from_decoded_bytes():
    import numpy as np
    a = lambda *x: np.array(x)
    # one token over a whole character, three in parts of the next, one behind
    assert alignment.token_ends(a(3, 6, 6, 6, 9), a(3, 3, 3, 3, 3), a(3, 1, 1, 1, 3)).tolist() == [3, 4, 5, 6, 9]
    assert alignment.token_ends(a(0, 0, 0, 3), a(0, 0, 0, 3), a(1, 1, 1, 3)).tolist() == [1, 2, 3, 3]


def test_pair_table_counts_every_link(docs, libraries):
    want = Counter((g[0][-1], g[1][-1]) for r in document_rows()
                   for g in groups_of(libraries, r[1])[2])
    got = alignment.pair_table(docs, BYTES, PIECES).collect()
    assert {(r.a_id, r.b_id): r.links for r in got} == want

"""Token counts and packing against the tokenizer library itself."""

import os
import random
import string
import time
import zlib

import numpy as np
import pandas as pd
import public_tokenizers
import pyarrow as pa
import pytest
from tokenizers import Tokenizer

from orderloom.llm import packing, tokencount

from .conftest import document_rows, plain

BYTES = public_tokenizers.path("byte_bpe_50k.json")
CASELESS = public_tokenizers.path("word_bpe_49k.json")


def test_counts_are_the_library_s(docs):
    library = Tokenizer.from_file(BYTES)
    want = []
    for i, t, *_ in document_rows():
        n = len(library.encode(t or "", add_special_tokens=False).ids)
        want.append((i, len((t or "").encode()), n, n > 512))
    assert plain(tokencount.token_counts(docs, BYTES)) == sorted(want, key=repr)


def test_latin_texts_are_cut_as_the_library_cuts_them():
    pieces = tokencount.Pieces(BYTES)
    cut = pieces.tokenizer.pre_tokenizer.pre_tokenize_str
    for c in map(chr, range(0x250)):
        text = f"a{c}b {c} 1{c}{c}! {c}'s {c}\n {c}  "
        ours, at = [], 0
        for w in tokencount.PATTERN.findall(text):
            ours.append((at, at + len(w)))
            at += len(w)
        assert ours == [where for _, where in cut(text)], hex(ord(c))


def test_ids_of_plain_texts_are_the_library_s():
    ids, library = packing.Ids(CASELESS, most=50), Tokenizer.from_file(CASELESS)
    texts = ["", " ", "it's the DOG'S ,'s 'sun we'll''d rock'n'roll don't, 12x3 ...?! a1b2 _x_ O'Neil's"]
    for c in map(chr, range(1, 0x260)):
        texts.append(f"a{c}B {c}{c} 1{c}2{c}! {c}'s x'{c} {c}\n{c}ing The end {c}")
    want = [np.array(x.ids, "<u4").tobytes() for x in
            library.encode_batch(texts, add_special_tokens=False)]
    for _ in range(2):
        assert ids(texts) == want
    assert [i for i, t in enumerate(texts) if ids([t]) != [want[i]]] == []


def test_counts_of_nothing(no_docs):
    assert tokencount.token_counts(no_docs, BYTES).collect() == []


@pytest.mark.skipif(not os.path.exists("/proc/self/smaps_rollup"), reason="read from there")
def test_workers_do_not_grow_with_the_tasks_that_count_pieces(spark):
    def held(batches):
        task = sum(batch.id.sum() for batch in batches)
        rng = random.Random(int(task))
        words = ["".join(rng.choices(string.ascii_lowercase, k=8)) for _ in range(30_000)]
        tokencount.pieces_of(BYTES).counts(words)
        del words
        tokencount.give_back()
        with open("/proc/self/smaps_rollup") as f:
            kb = next(int(x.split()[1]) for x in f if x.startswith("Pss_Anon:"))
        yield pd.DataFrame({"pid": [os.getpid()], "at": [time.time()], "mb": [kb / 1024]})

    got = spark.range(0, 24, 1, 24).mapInPandas(held, "pid long, at double, mb double").toPandas()
    steps = got.sort_values("at").groupby("pid").mb.diff().dropna()
    assert len(steps) and steps.mean() < 4


def test_large_frequencies_and_sums_in_parts():
    import pyarrow as pa
    block = tokencount._Block()
    block.add(1, 0, ["thorreou"] * 70_000 + ["x"], 0, frozenset())
    block.add(2, 0, ["thorreou"], 5, frozenset())
    batch = block.batch(0, pa.int64())
    batch = batch.append_column("pieces", pa.array([3, 2, None, None], pa.int32()))
    for most in (10**6, 0):
        rows = list(tokencount._partial_rows(most)(iter([batch.drop_columns(["pre_token"])])))
        got = tokencount._sum_block(pa.Table.from_batches(rows))
        assert got["n_tokens"].to_pylist() == [210_002, 8]


@pytest.mark.parametrize("window", [64, 2048])
def test_pieces_cover_every_id_once(docs, window):
    got = packing.pack(docs, CASELESS, window=window).toPandas()
    library, want = Tokenizer.from_file(CASELESS), []
    for i, t, *_ in document_rows():
        ids = np.array([*library.encode(t or "", add_special_tokens=False).ids, 1], "<u4")
        want += [(i, s, len(ids[s:s + window]), zlib.crc32(ids[s:s + window].tobytes()), len(ids))
                 for s in range(0, len(ids), window)]
    key = lambda r: tuple(-1 if x is None or x != x else int(x) for x in r)
    cols = ["doc_id", "start", "length", "ids_crc32", "doc_tokens"]
    assert sorted(map(key, got[cols].itertuples(index=False))) == sorted(map(key, want))
    for _, s in got.sort_values("offset").groupby("sequence_id"):
        assert s.length.sum() <= window
        assert (s.offset == s.length.cumsum() - s.length).all()


def test_a_row_repeated_often_is_packed_in_runs(spark):
    """9,000 equal rows are more than two runs; every copy has a place of its own."""
    text = "one two three"
    docs = spark.range(9_000).selectExpr("cast(null as long) doc_id", f"'{text}' text").unionAll(
        spark.range(20).selectExpr("id doc_id", f"'{text} four' text"))
    got = packing.pack(docs, CASELESS, window=64).toPandas()
    assert len(got) == 9_020 and got.doc_id.isna().sum() == 9_000
    assert sorted(got.doc_id.dropna().astype(int)) == list(range(20))
    assert not got.duplicated(["sequence_id", "offset"]).any()
    for _, s in got.sort_values("offset").groupby("sequence_id"):
        assert s.length.sum() <= 64
        assert (s.offset == s.length.cumsum() - s.length).all()


@pytest.mark.skipif(not os.path.exists("/proc/self/smaps_rollup"), reason="read from there")
def test_workers_do_not_grow_with_the_tasks_that_pack(spark):
    def held(batches):
        task = sum(batch.id.sum() for batch in batches)
        rng = random.Random(int(task))
        letters = string.ascii_lowercase + "абвгде"
        texts = [" ".join("".join(rng.choices(letters[:n], k=8)) for _ in range(200))
                 for n in (26, 32) for _ in range(75)]
        batch = pa.record_batch({"doc_id": pa.array(range(len(texts))), "text": pa.array(texts)})
        del texts
        n = sum(out.num_rows for out in packing._piece_rows(CASELESS, 2048, 1)(iter([batch])))
        with open("/proc/self/smaps_rollup") as f:
            kb = next(int(x.split()[1]) for x in f if x.startswith("Pss_Anon:"))
        yield pd.DataFrame({"pid": [os.getpid()], "at": [time.time()], "mb": [kb / 1024], "n": [n]})

    got = spark.range(0, 24, 1, 24).mapInPandas(held, "pid long, at double, mb double, n long").toPandas()
    steps = got.sort_values("at").groupby("pid").mb.diff().dropna()
    assert (got.n >= 150).all() and len(steps) and steps.mean() < 3


def test_a_task_cuts_a_bounded_amount_of_text_at_once(monkeypatch):
    sizes, real = [], packing.Ids.__call__
    monkeypatch.setattr(packing.Ids, "__call__",
                        lambda self, texts: sizes.append(sum(map(len, texts))) or real(self, texts))
    texts = [f"word{i} " * 10_000 for i in range(40)]
    batch = pa.record_batch({"doc_id": pa.array(range(40)), "text": pa.array(texts)})
    out = pa.Table.from_batches(packing._piece_rows(CASELESS, 2048, 1)(iter([batch])))
    assert sum(sizes) == sum(map(len, texts)) and max(sizes) <= 1_000_000
    library = Tokenizer.from_file(CASELESS)
    want = [len(library.encode(x, add_special_tokens=False).ids) + 1 for x in texts]
    assert out.group_by("doc_id").aggregate([("length", "sum")]).sort_by("doc_id")[
        "length_sum"].to_pylist() == want


def test_packing_nothing(no_docs):
    assert packing.pack(no_docs, CASELESS).collect() == []


def test_least_squares_is_optimal():
    rng = np.random.default_rng(3)
    a, b = rng.random((20, 50)), rng.random(20) * 9
    x = packing.nonnegative_least_squares(a, b)
    gain = a.T @ (b - a @ x)
    assert (x >= 0).all() and gain.max() < 1e-6 and abs(x * gain).max() < 1e-6


@pytest.mark.parametrize("n", [1, 40, 3000, 200_000])
def test_plan_uses_the_histogram_and_pads_little(n):
    rng = np.random.default_rng(n)
    units = 128
    h = np.bincount(np.minimum(units, 1 + rng.gamma(1.2, 25, n).astype(int)), minlength=units + 1)
    found = packing.plan(h)
    used = np.zeros(units + 1, int)
    for way, times in found:
        assert sum(way) <= units and times > 0
        np.add.at(used, list(way), times)
    assert (used == h).all()
    sequences = sum(times for _, times in found)
    assert n < 3000 or (h * np.arange(units + 1)).sum() > 0.98 * sequences * units


def test_combinations_fill_the_window():
    assert sorted(packing.combinations(5)) == [(2, 2, 1), (3, 1, 1), (3, 2), (4, 1), (5,)]

"""Language identification against a plain sum over segmentations and held-out accuracy."""

import math
import zlib
from collections import Counter, defaultdict
from functools import cache

import numpy as np
import public_tokenizers
import pytest

from orderloom.llm import language

from .conftest import SF, document_rows, plain

MODEL = public_tokenizers.path("piece_bpe_32k.model")


@pytest.fixture(scope="module")
def pieces():
    return language.Pieces(MODEL)


def segmentations(word, known):
    """All ways to cut a word; a character that is no piece is cut out as None."""
    if not word:
        yield ()
        return
    for k in range(1, len(word) + 1):
        head = word[:k]
        if head in known or k == 1:
            for rest in segmentations(word[k:], known):
                yield (known.get(head), *rest)


def random_table(n, languages, seed=3):
    table = np.random.default_rng(seed).random((n + 1, languages))
    table /= table.sum(0)
    table[-1] = language.UNKNOWN
    return table


WORDS = ["▁the", "▁x", "▁thing", "▁çelle", "▁été", "▁龘x", "▁ing", "ing", "a", "▁überall", "▁日本"]


def test_forward_sums_all_segmentations(pieces):
    known = {n: i for i, n in enumerate(pieces.names)}
    table = random_table(len(pieces), 3)
    got = language.log_probabilities(WORDS, pieces, table)
    for word, row in zip(WORDS, got, strict=True):
        want = sum(np.prod([table[len(pieces) if p is None else p] for p in s], axis=0)
                   for s in segmentations(word, known))
        assert np.allclose(row, np.log(want), rtol=1e-9), word


def test_expected_counts_are_those_of_all_segmentations(pieces):
    known = {n: i for i, n in enumerate(pieces.names)}
    table = random_table(len(pieces), 2)
    times, own = np.arange(1, len(WORDS) + 1) * 1.0, np.arange(len(WORDS)) % 2
    got = language.expected_counts(WORDS, times, own, pieces, table)
    want = defaultdict(float)
    for word, n, k in zip(WORDS, times, own, strict=True):
        ways = [[len(pieces) if p is None else p for p in s] for s in segmentations(word, known)]
        chance = [math.prod(table[p, k] for p in s) for s in ways]
        for s, c in zip(ways, chance, strict=True):
            for p in s:
                want[p, k] += n * c / sum(chance)
    assert {(int(p), int(k)) for p, k in zip(*np.nonzero(got), strict=True)} == {(p, int(k)) for p, k in want}
    assert all(math.isclose(got[k], v, rel_tol=1e-9) for k, v in want.items())


def test_words_are_runs_of_letters():
    assert language.words_in("It's ÉTÉ 12x3_y² Ⅷ é") == ["▁it", "▁s", "▁été", "▁x", "▁y", "▁é"]
    long = "a" * 70
    assert "".join(language.words_in(long)) == "▁" + long
    assert max(map(len, language.words_in(long))) == language.LONGEST + 1
    assert language.words_in("12 ² _ ½ ...") == []


def held(doc):
    return doc is not None and zlib.crc32(str(doc).encode()) % 4 == 2


def plain_predictions(rows, model, pieces):
    known = {n: i for i, n in enumerate(pieces.names)}

    @cache
    def log(word):
        alpha = [np.ones(len(model.languages))] + [np.zeros(len(model.languages)) for _ in word]
        for j in range(len(word)):
            for k in range(1, min(20, len(word) - j) + 1):
                p = known.get(word[j:j + k], len(pieces) if k == 1 else None)
                if p is not None:
                    alpha[j + k] = alpha[j + k] + alpha[j] * model.table[p]
        return np.log(alpha[-1])

    out = []
    for doc, text in rows:
        words = language.words_in(text or "")
        if not words or not model.languages:
            out.append((doc, held(doc), "und", 0.0))
            continue
        total = model.prior + sum(log(w) for w in words)
        chance = np.exp(total - total.max())
        out.append((doc, held(doc), model.languages[int(total.argmax())], round(1 / chance.sum(), 6)))
    return sorted(out, key=repr)


def test_odd_rows_equal_the_plain_forward(spark, docs, pieces):
    rows = document_rows()
    mixed = spark.createDataFrame(
        [(i, t, [None, "a", "b"][n % 3]) for n, (i, t, *_) in enumerate(rows)] + [
            (500, "12 34", "b"), (501, "²", "a"), (502, "x" * 100, "a"), (503, "日本 語", "b")],
        "doc_id long, text string, lang string").repartition(3)
    model = language.fit(mixed, MODEL)
    assert model.languages == ["a", "b"]
    got = [(d, h, p, round(s, 6)) for d, h, p, s in plain(language.languages(mixed, MODEL))]
    assert sorted(got, key=repr) == plain_predictions([(r[0], r[1]) for r in mixed.collect()], model, pieces)
    assert language.languages(docs, MODEL).where("lang_pred not in ('en', 'und')").count() == 0


def test_nothing_to_learn_from(spark, docs, no_docs):
    from pyspark.sql import functions as F
    assert language.languages(no_docs, MODEL).collect() == []
    got = language.languages(docs.withColumn("lang", F.lit(None).cast("string")), MODEL)
    assert {(r.lang_pred, r.score) for r in got.collect()} == {("und", 0.0)}


def test_held_out_accuracy(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    got = language.languages(docs, MODEL).join(docs.select("doc_id", "lang", "text"), "doc_id")
    tested = got.where("held_out and lang is not null and lang_pred <> 'und'").collect()
    right = Counter(r.lang == r.lang_pred for r in tested)
    assert len(tested) > 30 and right[True] > 0.95 * len(tested)


def test_each_language_is_learned_from_a_bounded_sample(spark):
    rows = [(i, f"word{'abc'[i % 3]} only", "xy"[i % 2]) for i in range(4000)] + [(7, "again", "x")] * 50
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string").repartition(5)
    sample, shares = language._sample(docs, 100, 1)
    n = Counter(r.lang for r in sample.collect())
    assert 60 < n["x"] < 150 and 60 < n["y"] < 150 and set(shares) == {"x", "y"}
    every, _ = language._sample(docs, 4000, 1)
    assert every.count() == sum(not held(r[0]) for r in rows[:4000])
    assert plain(sample) == plain(language._sample(docs.repartition(2), 100, 1)[0])

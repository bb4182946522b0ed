"""Importance resampling against a plain count, and its SQL twin (test_queries)."""

import hashlib
import math
import re
import zlib
from collections import Counter

import pytest

from orderloom.llm import resampling

from .conftest import document_rows, plain

WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
UPPER = {c: c + 32 for c in range(65, 91)}
TARGET = ["The target has THESE words\nand lines é", None, "", "a b c d e a b", "shared words"]


def runs(text, longest):
    words = WORD.findall((text or "").translate(UPPER))
    return [" ".join(words[i:i + n]) for n in range(1, longest + 1) for i in range(len(words) - n + 1)]


def bucket(run, buckets):
    return zlib.crc32(run.encode()) % buckets


def plain_scores(rows, target, longest, buckets, percent=10):
    own = [[bucket(r, buckets) for r in runs(t, longest)] for _, t in rows]
    s, t = Counter(b for x in own for b in x), Counter(bucket(r, buckets) for x in target
                                                       for r in runs(x, longest))
    s_all, t_all = sum(s.values()), sum(t.values())
    gain = [math.floor(1000 * math.log((t[b] + 1) * (s_all + buckets) / ((s[b] + 1) * (t_all + buckets))))
            for b in range(buckets)]
    out = []
    for (doc, text), x in zip(rows, own, strict=True):
        h = int(hashlib.sha256(f"2024:{'' if doc is None else doc}".encode()).hexdigest()[:8], 16)
        weight = sum(gain[b] for b in x)
        score = weight + math.floor(-1000 * math.log(-math.log((h + 0.5) / 2**32)))
        out.append((doc, len(runs(text, 1)), len(x), weight, score))
    fit = sorted((r for r in out if r[1] >= 20), key=lambda r: (-r[4], r[0] is None, r[0] or 0))
    drawn = [(r, i + 1) for i, r in enumerate(fit[:len(fit) * percent // 100])]
    return sorted(out, key=repr), drawn


@pytest.mark.parametrize("longest,buckets", [(1, 10_000), (1, 7), (3, 500)])
def test_scores_and_ranks_are_the_plain_ones(spark, docs, longest, buckets):
    target = spark.createDataFrame(list(enumerate(TARGET)), "item_id long, text string")
    rows = [r[:2] for r in document_rows()]
    want, drawn = plain_scores(rows, TARGET, longest, buckets, 40)
    got = resampling.resample(docs, target, longest, buckets, percent=40)
    assert plain(got.drop("rank")) == want
    first = sorted((r.rank, *r[:5]) for r in got.where("rank is not null").collect())
    assert [r[0] for r in first] == list(range(1, len(drawn) + 1))
    assert [(r[1], r[5]) for r in first] == [(r[0], r[4]) for r, _ in drawn]


def test_runs_across_lines_are_those_of_no_line():
    for text in ("a b\nc d e\n\nf", "a\nb\nc", "", "\n", "a b c"):
        lines = [resampling.line_words(x) for x in text.encode().split(b"\n")]
        for longest in (1, 2, 3, 5):
            got = [r for x in lines for r in resampling.runs_within(x, longest)]
            got += resampling.runs_across(lines, longest)
            assert Counter(got) == Counter(r.encode() for r in runs(text, longest))


def test_repeated_lines_cross_tasks_as_one(spark, monkeypatch):
    text = "The same old line.\n" * 300 + "one of its own {}"
    rows = [(i, text.format(i)) for i in range(40)]
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(4)
    counts = resampling.bucket_counts(docs)
    assert counts.sum() == sum(len(runs(t, 1)) for _, t in rows)
    lines = (docs.select("text").mapInArrow(resampling._line_rows(1, 10), "line binary, bucket int, n long")
             .groupBy("line").sum("n").collect())
    assert len(lines) == 41 and max(r[1] for r in lines) == 40 * 300
    monkeypatch.setattr(resampling, "LINES", 1)
    assert (resampling.bucket_counts(docs) == counts).all()


def test_draws_follow_the_weights(spark):
    """Documents like the target are drawn far more often than their share."""
    rows = [(i, " ".join(["plain"] * 30 if i % 2 else ["wanted"] * 3 + ["plain"] * 27)) for i in range(2000)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    target = spark.createDataFrame([(1, "wanted " * 5 + "plain " * 5)], "item_id long, text string")
    got = resampling.resampled(docs, target).collect()
    assert len(got) == 200 and sum(r.doc_id % 2 == 0 for r in got) > 190


def test_nothing(spark, no_docs, docs):
    target = spark.createDataFrame([(1, "x")], "item_id long, text string")
    assert resampling.resample(no_docs, target).collect() == []
    assert resampling.resample(docs, target.where("false")).count() == len(document_rows())

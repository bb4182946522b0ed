"""Near duplicates and repeated spans against plain versions."""

import hashlib
from collections import Counter, defaultdict
from itertools import combinations

import numpy as np
import pytest
from pyspark.sql import functions as F

from orderloom.llm import neardup, substrings
from orderloom.llm.common import gram_hashes, powers

from .conftest import SF, document_rows, plain, words


def shingles(text):
    w = words(text)
    n = min(5, len(w))
    return Counter(tuple(w[i:i + n]) for i in range(len(w) - n + 1)) if w else None


def similarity(x, y, counted):
    if not counted:
        x, y = Counter(set(x)), Counter(set(y))
    if counted == "log":
        x, y = (Counter({k: n.bit_length() for k, n in z.items()}) for z in (x, y))
    both = sum((x & y).values())
    return both / (sum(x.values()) + sum(y.values()) - both)


def plain_classes(rows, counted=False):
    """Class of each (row number): least id of all rows linked to it."""
    bags = [shingles(t) for _, t in rows]
    parent = list(range(len(rows)))

    def root(i):
        while parent[i] != i:
            i = parent[i]
        return i

    for a, b in combinations(range(len(rows)), 2):
        if bags[a] and bags[b] and similarity(bags[a], bags[b], counted) >= 0.8:
            parent[root(b)] = root(a)
    least = defaultdict(lambda: None)
    for i, (doc, _) in enumerate(rows):
        if doc is not None:
            r = root(i)
            least[r] = doc if least[r] is None else min(least[r], doc)
    return sorted(((d, least[root(i)] if bags[i] else d) for i, (d, _) in enumerate(rows)), key=repr)


@pytest.mark.parametrize("counted", [False, True, "log"])
def test_classes_of_odd_rows(docs, counted):
    got = neardup.near_duplicates(docs, counted=counted)
    assert plain(got.select("doc_id", "class_id")) == plain_classes(
        [r[:2] for r in document_rows()], counted)


def test_a_common_repeated_line_makes_no_near_duplicates(spark):
    rows = [(i, " ".join(f"w{i}x{j}" for j in range(40)) + " same old line." * 200) for i in range(6)]
    table = spark.createDataFrame(rows, "doc_id long, text string")
    for counted, classes in ((False, 6), (True, 1), ("log", 6)):
        got = neardup.near_duplicates(table, counted=counted)
        assert got.select("class_id").distinct().count() == classes


def test_classes_of_a_given_table(spark):
    table = spark.read.parquet(f"{SF}/documents.parquet")
    got = neardup.near_duplicates(table)
    assert plain(got.select("doc_id", "class_id")) == plain_classes(
        [tuple(r) for r in table.select("doc_id", "text").collect()])


def test_one_document_of_each_class_stays(docs):
    got = neardup.one_of_each(docs)
    assert got.columns == docs.columns
    kept = [r.doc_id for r in got.collect()]
    assert 1 in kept and 2 not in kept and 3 not in kept and kept.count(11) == 1
    assert {4, 5, 6} <= set(kept)


def test_near_duplicates_of_nothing(no_docs):
    assert neardup.near_duplicates(no_docs).collect() == []
    assert neardup.one_of_each(no_docs).collect() == []


def test_what_the_leader_leaves_is_compared(spark):
    """One bucket of six; the leader meets all, the others meet across classes only."""
    buckets = spark.createDataFrame(
        [(7, bytes([i]), 9 if i == 2 else 1, 0, 0) for i in range(6)],
        "band long, key binary, degree long, sketch0 long, sketch1 long")
    pairs = neardup.leader_pairs(buckets)
    tested = {(r.a[0], r.b[0]) for r in pairs.collect()}
    assert tested == {tuple(sorted((2, i))) for i in range(6) if i != 2}
    classes = spark.createDataFrame([(bytes([i]), bytes([0])) for i in (0, 1, 2)],
                                    "key binary, class binary")
    mixed = neardup.mixed_buckets(buckets, classes)
    # 5 shares too little with anyone, 4 too little for a text as large as 3.
    sizes = spark.createDataFrame([(bytes([i]), 90 if i == 3 else 80, n) for i, n in
                                   enumerate((80, 80, 80, 90, 74, 60))],
                                  "key binary, size long, shared long")
    # The long sketch of 1 is far from all others.
    sizes = sizes.withColumns({c: F.when(F.col("key") == bytes([1]), -1).otherwise(0).cast("long")
                               for c in neardup.LONGS})
    # A second bucket with the same members: a pair is met in one of them only.
    both = mixed.unionByName(mixed.withColumn("band", F.col("band") + 1))
    more = neardup.class_pairs(both, sizes, pairs, 0.8).collect()
    assert sorted((r.a[0], r.b[0]) for r in more) == [(0, 3), (0, 4)]
    none = neardup.mixed_buckets(buckets, spark.createDataFrame(
        [(bytes([i]), bytes([0])) for i in range(6)], "key binary, class binary"))
    assert none.count() == 0


def test_shared_weight_counts_what_others_have(spark):
    rows = spark.createDataFrame([(b"a", 1, 2), (b"a", 2, 3), (b"b", 2, 1), (b"c", 3, 4)],
                                 "key binary, shingle long, weight long")
    got = {bytes(r.key): (r["size"], r.shared) for r in neardup.shared_weight(rows).collect()}
    assert got == {b"a": (5, 3), b"b": (1, 1), b"c": (4, 0)}


def test_components_of_a_long_path(spark):
    from orderloom.llm.common import Scratch
    path = spark.createDataFrame([(bytes([i]), bytes([i + 1])) for i in range(40) if i != 20],
                                 "a binary, b binary")
    got = {r.key[0]: r["class"][0] for r in
           neardup.components(path, Scratch(path, "t"), "p").collect()}
    assert got == {i: 0 if i <= 20 else 21 for i in range(41)}


def test_agreement_estimates_weighted_similarity():
    rng = np.random.default_rng(0)
    ids = rng.integers(1, 1 << 63, 400).astype(np.uint64)
    a, b = rng.integers(1, 9, 400), rng.integers(1, 9, 400)
    b[:300] = a[:300]
    k = 4000
    x, y = (neardup.darts(np.zeros(400, int), ids, w, 1, k)[0] for w in (a, b))
    truth = np.minimum(a, b).sum() / np.maximum(a, b).sum()
    assert abs((x == y).mean() - truth) < 4 * np.sqrt(truth * (1 - truth) / k)
    assert (x == neardup.darts(np.zeros(400, int), ids, a, 1, k)[0]).all()


def plain_digest(rows, width=20):
    first = {}
    order = sorted(range(len(rows)), key=lambda i: (rows[i][0] is not None, rows[i][0] or 0))
    places = sorted(((rows[i][0] is not None, rows[i][0] or 0, s, rows[i][1]) for i in order
                     for s in range(len(words(rows[i][1])) - width + 1)), key=lambda p: p[:3])
    cut = {i: words(rows[i][1]) for i in order}
    for known, doc, s, text in places:
        first.setdefault(tuple(words(text)[s:s + width]), (known, doc, s))
    out = []
    for i in order:
        w, gone = cut[i], set()
        for s in range(len(w) - width + 1):
            if first[tuple(w[s:s + width])] != (rows[i][0] is not None, rows[i][0] or 0, s):
                gone.update(range(s, s + width))
        kept = [x for j, x in enumerate(w) if j not in gone]
        out.append((rows[i][0], len(w), len(gone), hashlib.sha256(" ".join(kept).encode()).hexdigest()))
    return sorted(out, key=repr)


def test_spans_of_odd_rows(docs):
    small = docs.where("n_chars is null or n_chars < 20000")
    want = plain_digest([r[:2] for r in document_rows() if len(r[1] or "") < 20000])
    assert plain(substrings.digest(small)) == want


def test_spans_of_nothing(no_docs):
    assert substrings.digest(no_docs).collect() == []
    assert substrings.without_repeats(no_docs).collect() == []


def test_periodic_and_overlapping_repeats(spark):
    rows = [(1, "a " * 90), (2, "a b " * 40), (3, "b a " * 50 + "c " * 25), (4, "x " + "a " * 30)]
    got = substrings.digest(spark.createDataFrame(rows, "doc_id long, text string"))
    assert plain(got) == plain_digest(rows)


def test_texts_are_cut_and_keep_their_white_space(spark):
    passage = " ".join(f"w{i}" for i in range(25))
    rows = [(1, f"one\n{passage} end", 0, "k"), (2, f"two \t{passage}\n\nlast  words", 0, None),
            (3, passage, 0, None), (4, None, None, None), (5, "", 0, None)]
    got = substrings.without_repeats(spark.createDataFrame(
        rows, "doc_id long, text string, n_chars long, spans string"))
    assert plain(got) == sorted([rows[0], (2, "two \tlast  words", 16, None), *rows[3:]], key=repr)


@pytest.mark.parametrize("n", [1, 2, 3, 5, 6, 8, 19, 20])
def test_rolling_hash_is_the_polynomial(n):
    h = np.random.default_rng(n).integers(0, 1 << 63, 40).astype(np.uint64)
    base = 0x9E3779B97F4A7C15
    want = [sum(int(x) * pow(base, n - 1 - j, 1 << 64) for j, x in enumerate(h[i:i + n])) % (1 << 64)
            for i in range(41 - n)]
    assert gram_hashes(h, n).tolist() == want
    assert int(powers(base, 4)[3]) == pow(base, 3, 1 << 64)

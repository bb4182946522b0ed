"""Plain versions of the classifier and of the whole pipeline."""

import hashlib
import math
import re
import zlib
from collections import Counter, defaultdict

import numpy as np
import public_tokenizers
import pytest
import xxhash
from pyspark.sql import functions as F
from tokenizers import Tokenizer

import corpus_pipeline
from orderloom.llm import toxicity
from orderloom.llm.common import from_parquet

from .conftest import SF, document_rows, plain, words
from .test_duplicates import plain_classes

CASELESS = public_tokenizers.path("word_bpe_49k.json")


# ------------------------------------------------------------ the classifier

def plain_features(text):
    """Numbers of the words of a text and of their beginnings."""
    out = set()
    for word in set(words(text)):
        w = word.lower().strip(".,;:!?()[]{}\"'|*#<>-_")
        if w:
            out |= {w + "$", *(w[:n] for n in range(3, 9) if n <= len(w))}
    return {xxhash.xxh32_intdigest(x.encode("utf-8", "surrogatepass")) for x in out}


def plain_score(text, model):
    total = model.intercept + sum(model.weights.get(f, 0.0) for f in sorted(plain_features(text)))
    return 1 / (1 + math.exp(-total))


def test_scores_are_the_plain_ones(spark, docs):
    labels = from_parquet(spark, SF, "labels")
    whole = from_parquet(spark, SF, "documents")
    model = toxicity.fit(whole, labels)
    assert model.weights
    want = {r.doc_id: plain_score(r.text, model) for r in whole.collect()}
    for r in toxicity.toxicity(whole, labels).collect():
        assert math.isclose(r.score, want[r.doc_id], rel_tol=1e-9)
        assert r.predicted == (r.score >= 0.3)
        assert r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 4 == 2)


@pytest.mark.parametrize("fairness", [0.0, 1.0, 20.0])
def test_fit_reaches_the_least_loss(fairness):
    """Against plain proximal gradient steps in double precision, many and short."""
    rng = np.random.default_rng(9)
    n, k, sparsity = 60, 8, 1e-2
    x = (rng.random((n, k)) < 0.4).astype(np.float64)
    y = (x[:, 0] + x[:, 1] - x[:, 2] + rng.normal(0, 0.7, n) > 0.5).astype(np.float64)
    d = rng.integers(-1, 2, (12, k)).astype(np.float64)
    weight = np.where(y == 1, 2.0, 1.0)
    weight /= weight.sum()

    def loss(w, b):
        z = x @ w + b
        return (weight @ (np.logaddexp(0, z) - y * z) + sparsity * abs(w).sum()
                + fairness * np.mean((d @ w) ** 2))

    w, b = np.zeros(k), 0.0
    step = 0.5 / (1 + 2 * fairness * np.linalg.norm(d.T @ d, 2) / len(d) + np.linalg.norm(x, 2) ** 2 / n)
    for _ in range(60_000):
        error = weight * (1 / (1 + np.exp(-(x @ w + b))) - y)
        g = x.T @ error + 2 * fairness / len(d) * d.T @ (d @ w)
        w = w - step * g
        w = np.sign(w) * np.maximum(abs(w) - step * sparsity, 0)
        b -= step * error.sum()
    f32 = lambda v: v.astype(np.float32)
    got_w, got_b = toxicity._minimise(f32(x), f32(y), f32(weight), f32(d), sparsity, fairness, 2000)
    assert loss(got_w.astype(float), float(got_b)) <= loss(w, b) + 1e-5


# -------------------------------------------------------------- the pipeline

def without_toxic(rows, model):
    return [r for r in rows if plain_score(r[1], model) < 0.3]


def one_of_each(rows):
    """The least doc_id of each class; texts without words stay."""
    named = dict(plain_classes([r[:2] for r in rows], "log"))
    return [r for r in rows if named[r[0]] == r[0]]


def without_repeats(rows, width=20):
    seen, out = set(), []
    for doc, text, *rest in sorted(rows):
        found = list(re.finditer(r"[^\x20\x09-\x0D]+", text or ""))
        gone = set()
        for i in range(len(found) - width + 1):
            key = tuple(m.group() for m in found[i:i + width])
            if key in seen:
                gone.update(range(i, i + width))
            seen.add(key)
        if found and len(gone) == len(found):
            continue
        if gone:  # a removed run goes with the white space behind it
            kept, at = [], 0
            for i, m in enumerate(found):
                if i in gone:
                    if i - 1 not in gone:
                        kept.append(text[at:m.start()])
                    at = found[i + 1].start() if i + 1 < len(found) else len(text)
            text = "".join(kept) + text[at:]
            rest[-1] = len(text)
        out.append((doc, text, *rest))
    return out


def mixed(rows):
    by_source = defaultdict(list)
    for r in rows:
        by_source[r[3]].append((hashlib.md5(f"17:{r[0]}".encode()).hexdigest(), r[0], len(words(r[1])), r))
    names = sorted(by_source, key=lambda s: (s is None, s or ""))
    n = {s: sum(x[2] for x in by_source[s]) for s in names}
    weight = {s: (5, 2, 1)[i % 3] for i, s in enumerate(names)}
    full: set = set()
    while True:
        rest = 1.5 * sum(n.values()) - sum(2 * n[s] for s in full)
        level = rest / (sum(weight[s] for s in names if s not in full) or 1)
        more = {s for s in names if s not in full and weight[s] * level >= 2 * n[s]}
        if not more:
            break
        full |= more
    out = []
    for s in names:
        quota = 2 * n[s] if s in full else math.floor(weight[s] * level)
        if not n[s]:
            continue
        before = 0
        for _, _, size, row in sorted(by_source[s], key=lambda x: x[:3]):
            taken = quota // n[s] * size + min(size, max(0, quota % n[s] - before))
            before += size
            out += [row] * (math.floor(taken / size + 0.5) if size else 0)
    return out


def packed(rows, window=2048):
    library, out = Tokenizer.from_file(CASELESS), []
    for doc, text, *_ in rows:
        ids = np.array([*library.encode(text or "", add_special_tokens=False).ids, 1], "<u4")
        out += [(doc, s, len(ids[s:s + window]), zlib.crc32(ids[s:s + window].tobytes()), len(ids))
                for s in range(0, len(ids), window)]
    return sorted(out)


def pipeline_rows(spark):
    """Odd rows and given documents, each id once, with known copies and shared passages."""
    own = {r[0]: (*r[:4], r[4]) for r in document_rows() if r[0] is not None}
    given = from_parquet(spark, SF, "documents").where("doc_id between 200 and 260").collect()
    return [*own.values(), *((r.doc_id + 1000, r.text, r.lang, r.source, r.n_chars) for r in given)]


def test_pipeline_equals_the_plain_one(spark, tmp_path):
    rows = pipeline_rows(spark)
    folder = str(tmp_path / "tables")
    schema = "doc_id long, text string, lang string, source string, n_chars long"
    spark.createDataFrame(rows, schema).repartition(3).write.parquet(f"{folder}/documents.parquet")
    labels = from_parquet(spark, SF, "labels").where("doc_id between 200 and 260").withColumn(
        "doc_id", F.col("doc_id") + 1000)
    labels.write.parquet(f"{folder}/labels.parquet")
    docs = from_parquet(spark, folder, "documents")
    model = toxicity.fit(docs, from_parquet(spark, folder, "labels"))

    want, found = rows, docs
    plain_stages = [lambda r: without_toxic(r, model), one_of_each, without_repeats, mixed]
    for (name, stage), plain_stage in zip(corpus_pipeline.STAGES, plain_stages, strict=False):
        stage(spark, found, folder).write.parquet(f"{folder}/{name}")
        found, before, want = spark.read.parquet(f"{folder}/{name}"), want, plain_stage(want)
        assert plain(found) == sorted(want, key=repr), name
        assert want != before or name == "toxicity", name
    got = corpus_pipeline.run(spark, folder).toPandas()
    shown = ["doc_id", "start", "length", "ids_crc32", "doc_tokens"]
    assert sorted(map(tuple, got[shown].to_numpy().tolist())) == packed(want)
    for _, s in got.sort_values("offset").groupby("sequence_id"):
        assert s.length.sum() <= 2048 and (s.offset == s.length.cumsum() - s.length).all()
    assert Counter(got.doc_id)

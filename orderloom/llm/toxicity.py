"""Toxicity: a counterfactual-regularised linear classifier.

Features of a text are the words it holds and their beginnings (stems carry the meaning
where endings vary), each counted once however often it occurs. The weights minimise

    weighted logistic loss + sparsity * sum|w| + fairness * mean (w . d)**2

where d is how a labelled text's features change when the identity terms of its sentences
are swapped for others of their group, or when a neutral mention of a term is added. The last
term keeps the score from moving with the group that is mentioned.

Labels are learned on a bounded, hash-ordered sample (``fit_rows`` of each class); scoring
runs over whole texts in the executors and needs no shuffle.

Defined results: a null or empty text gets the score of a text without features; several label
rows of one document count as toxic if one does; label rows with a null are left out; without
a toxic training row every score is 0, without a clean one every score is 1. A null doc_id is
never held out and never learned from. Other columns of the input are ignored.
"""

import math
from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, functions as F

from orderloom.llm.common import WORD, Memo, column, slices, texts_of

THRESHOLD = 0.3

#: Identity terms by group; a term is swapped for the next of its group.
IDENTITY_GROUPS = (
    ("women", "men"), ("girls", "boys"), ("she", "he"),
    ("muslims", "christians", "jews", "hindus", "atheists"),
    ("immigrants", "refugees", "foreigners", "locals"),
    ("black", "white", "asian", "latino"), ("gay", "straight", "lesbian", "transgender"),
    ("frauen", "männer"), ("muslime", "christen", "juden"), ("ausländer", "einheimische"),
    ("femmes", "hommes"), ("musulmans", "chrétiens", "juifs"), ("immigrés", "réfugiés"),
    ("mujeres", "hombres"), ("musulmanes", "cristianos", "judíos"),
    ("inmigrantes", "refugiados"),
)

#: Lengths of word beginnings that are features, and what is cut from a word's ends.
STEMS = range(3, 9)
EDGES = ".,;:!?()[]{}\"'|*#<>-_"


class Model(NamedTuple):
    weights: dict[int, float]
    intercept: float


def held_out(doc_id: Column) -> Column:
    """Rows that are kept for testing: crc32 of the id as text leaves 2 modulo 4."""
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % 4 == 2, F.lit(False))


def word_features(word: str) -> tuple[int, ...]:
    w = word.lower().strip(EDGES)
    if not w:
        return ()
    return tuple(xxhash.xxh32_intdigest(x.encode("utf-8", "surrogatepass"))
                 for x in [w + "$", *(w[:n] for n in STEMS if n <= len(w))])


def swapped(words: set[str], groups) -> dict[str, str]:
    """The identity terms among the words, and what each is swapped for."""
    following = {t: g[(i + 1) % len(g)] for g in groups for i, t in enumerate(g)}
    return {w: following[s] for w in words if (s := w.lower().strip(EDGES)) in following}


def _sample(labels: DataFrame, rows: int, seed: int) -> tuple[DataFrame, dict[int, int]]:
    """The first rows of each class in hash order, and how many rows each class has."""
    known = (labels.select("doc_id", F.col("toxic").cast("int").alias("label"))
             .where("doc_id is not null and label in (0, 1)").where(~held_out(F.col("doc_id")))
             .groupBy("doc_id").agg(F.max("label").alias("label")))
    total = {r.label: r["count"] for r in known.groupBy("label").count().collect()}
    order = F.xxhash64(F.lit(seed), "doc_id")
    parts = [known.where(F.col("label") == k).orderBy(order, "doc_id").limit(rows) for k in (0, 1)]
    return parts[0].union(parts[1]), total


def _features(groups):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        memo = Memo(word_features, 50_000)
        pack = lambda words: np.unique(np.fromiter(
            (f for w in words for f in memo[w]), np.uint32)).tobytes()
        for part in slices(batches):
            own, other = [], []
            for text in texts_of(part):
                words = set(WORD.findall(text))
                own.append(pack(words))
                swaps = swapped(words, groups)
                other.append(pack({swaps.get(w, w) for w in words}) if swaps else None)
            yield pa.RecordBatch.from_arrays(
                [column(part, "doc_id").cast(pa.string()), column(part, "label"),
                 pa.array(own, pa.binary()), pa.array(other, pa.binary())],
                names=["doc", "label", "own", "other"])
    return run


def fit(docs: DataFrame, labels: DataFrame, fit_rows: int = 3000, features: int = 2048,
        groups=IDENTITY_GROUPS, sparsity: float = 1e-4, fairness: float = 1.0,
        rounds: int = 400, seed: int = 7) -> Model:
    """Learn the weights from at most ``fit_rows`` labelled documents of each class, and of at most
    ``features`` features, those that differ most between the classes."""
    sample, total = _sample(labels, fit_rows, seed)
    if not total.get(1) or not total.get(0):
        return Model({}, math.inf if total.get(1) else -math.inf)
    # The sample is broadcast: at most 2 * fit_rows pairs of numbers.
    got = (docs.select("doc_id", "text").join(F.broadcast(sample), "doc_id")
           .mapInArrow(_features(groups), "doc string, label int, own binary, other binary")
           .toPandas().sort_values(["doc", "own"]))
    y = got["label"].to_numpy(np.float32)
    if not 0 < y.sum() < len(y):
        return Model({}, math.inf if len(y) and y.all() else -math.inf)
    own = [np.frombuffer(x, np.uint32) for x in got["own"]]
    kept = _select(own, y, features)
    x = _matrix(own, kept)
    changed = [i for i, z in enumerate(got["other"]) if z is not None]
    swaps = _matrix([np.frombuffer(got["other"].iloc[i], np.uint32) for i in changed], kept)
    mentions = _matrix([np.unique(np.array(word_features(t), np.uint32))
                        for g in groups for t in g], kept)
    d = np.concatenate([swaps - x[changed], mentions])
    weight = np.where(y == 1, total[1] / y.sum(), total[0] / (len(y) - y.sum()))
    w, b = _minimise(x, y, (weight / weight.sum()).astype(np.float32), d, sparsity, fairness, rounds)
    return Model({int(k): float(v) for k, v in zip(kept, w, strict=True) if v}, float(b))


def _select(own: list[np.ndarray], y: np.ndarray, most: int) -> np.ndarray:
    """The features whose share differs most between the classes, in standard errors."""
    names, at = np.unique(np.concatenate(own), return_inverse=True)
    label = np.repeat(y, [len(o) for o in own])
    n1, n = np.bincount(at, label, len(names)), np.bincount(at, minlength=len(names))
    share = n / len(y)
    gap = n1 / y.sum() - (n - n1) / (len(y) - y.sum())
    error = np.sqrt(share * (1 - share) * (1 / y.sum() + 1 / (len(y) - y.sum()))) + 1e-12
    rank = np.where(n >= 3, np.abs(gap) / error, 0)
    best = np.lexsort((names, -rank))[:most]
    return np.sort(names[best[rank[best] > 2]])


def _matrix(rows: list[np.ndarray], kept: np.ndarray) -> np.ndarray:
    out = np.zeros((len(rows), len(kept)), np.float32)
    for i, r in enumerate(rows):
        at = np.searchsorted(kept, r)
        at = at[(at < len(kept)) & (kept[np.minimum(at, len(kept) - 1)] == r)] if len(kept) else at[:0]
        out[i, at] = 1
    return out


def _minimise(x, y, weight, d, sparsity, fairness, rounds):
    """Accelerated proximal gradient; the intercept is not made sparse."""
    x1 = np.concatenate([x, np.ones((len(x), 1), np.float32)], 1)
    d1 = np.concatenate([d, np.zeros((len(d), 1), np.float32)], 1)
    each = fairness / max(1, len(d))
    v = np.full(x1.shape[1], x1.shape[1] ** -0.5, np.float32)
    for _ in range(20):  # the largest curvature, by power iteration
        v = x1.T @ (weight * (x1 @ v)) / 4 + 2 * each * (d1.T @ (d1 @ v))
        top = float(np.linalg.norm(v))
        v /= top or 1
    step, w = 1 / (1.1 * top + 1e-9), np.zeros(x1.shape[1], np.float32)
    z, t = w, 1.0
    for _ in range(rounds):
        p = 1 / (1 + np.exp(-np.clip(x1 @ z, -30, 30)))
        new = z - step * (x1.T @ (weight * (p - y)) + 2 * each * (d1.T @ (d1 @ z)))
        new[:-1] = np.sign(new[:-1]) * np.maximum(np.abs(new[:-1]) - step * sparsity, 0)
        t, before = (1 + math.sqrt(1 + 4 * t * t)) / 2, t
        w, z = new, new + (before - 1) / t * (new - w)
    return w[:-1], w[-1]


def _scored(batches, model: Model):
    """Parts of the batches with the score of each row: the probability that it is toxic."""
    known = model.weights
    memo = Memo(lambda w: tuple(f for f in word_features(w) if f in known), 150_000)
    for part in slices(batches):
        yield part, np.array([_score(x, memo, model) for x in texts_of(part)], np.float64)


def _score(text: str, memo: Memo, model: Model) -> float:
    found = {f for w in set(WORD.findall(text)) for f in memo[w]}
    total = model.intercept + math.fsum(model.weights[f] for f in found)
    return 1 / (1 + math.exp(-total)) if total > -700 else 0.0


def toxicity(docs: DataFrame, labels: DataFrame, threshold: float = THRESHOLD,
             **fitting) -> DataFrame:
    """doc_id, held_out, score, predicted for every document."""
    model = fit(docs, labels, **fitting)

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part, scores in _scored(batches, model):
            yield pa.RecordBatch.from_arrays([column(part, "doc_id"), pa.array(scores)],
                                             names=["doc_id", "score"])

    kind = docs.schema["doc_id"].dataType.simpleString()
    scored = docs.select("doc_id", "text").mapInArrow(rows, f"doc_id {kind}, score double")
    return scored.select("doc_id", held_out(F.col("doc_id")).alias("held_out"), "score",
                         (F.col("score") >= threshold).cast("int").alias("predicted"))


def without_toxic(docs: DataFrame, labels: DataFrame, threshold: float = THRESHOLD,
                  **fitting) -> DataFrame:
    """The documents that are not predicted toxic, with all their columns, whatever the names."""
    model = fit(docs, labels, **fitting)
    # Other columns travel under names of our own; a name with a dot is no path then.
    inner = {c: c if c == "text" else f"c{i}" for i, c in enumerate(docs.columns)}

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part, scores in _scored(batches, model):
            yield part.filter(pa.array(scores < threshold)).rename_columns(list(inner))

    named = docs.select(*[F.col(f"`{c}`").alias(n) for c, n in inner.items()])
    return named.mapInArrow(rows, docs.schema)

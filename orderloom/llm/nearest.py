"""Nearest neighbours by multi-index hashing of learned binary codes.

Vectors are turned by a learned rotation (iterative quantisation, on a bounded sample) into
64-bit codes whose Hamming distance follows the angle; a coordinate added to the stored
vectors makes the angle follow the inner product where lengths differ. Each code is cut into
``SUBSTRINGS`` substrings with an index each. Of two codes that differ in at most r bits some
substring differs in at most r / SUBSTRINGS bits (pigeonhole), so probing those buckets
of all indexes retrieves every code within r; candidates are checked on the whole code and
ranked by the inner product of the original vectors in double precision.

The radius is fitted, too: the least that holds ``RECALL`` of the true neighbours within the
sample, however wide; for long vectors in nearly random directions it is over half of the bits,
most codes are retrieved, and a block is all but scanned. A block with fewer than k codes within it is taken whole, so every query gets k rows if
there are as many.

Stored vectors and queries are dealt into blocks of bounded size; each pair of blocks is one task
that probes the block's own indexes and sends on the best few. Equal vectors are one entry with
its k + 1 least ids (more can never be among k results), so a hot vector is one row.

Defined results: a vector that is null, empty, zero, of another length than most, or holds a
null or non-finite component takes no part, nor does a null vec_id; rows that repeat vec_id and
vector count once; equal scores go to the smaller vec_id; an empty table gives an empty result.
"""

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window, functions as F

from orderloom.llm.common import Scratch

K = 20
EVERY = 20
BITS, SUBSTRINGS = 64, 8
FIT_ROWS, FIT_QUERIES, RECALL = 4000, 200, 0.96
BLOCK, QUERY_BLOCK = 16_384, 2_048


class Codes:
    """A fitted rotation with the radius that goes with it."""

    def __init__(self, sample: np.ndarray, longest: float, k: int = K, rounds: int = 30,
                 seed: int = 5):
        rng = np.random.default_rng(seed)
        self.longest = longest
        x = self._lifted(sample)
        self.mean = x.mean(0)
        x = x - self.mean
        # A principal axis without spread (the added one, where lengths agree) carries nothing.
        values, axes = np.linalg.eigh(x.T @ x)
        axes = axes[:, ::-1][:, :max(1, min(BITS, int((values > 1e-9 * values.max()).sum())))]
        parts = []
        while sum(p.shape[1] for p in parts) < BITS:
            turn, _ = np.linalg.qr(rng.normal(size=(axes.shape[1],) * 2))
            z = x @ axes
            for _ in range(rounds):
                u, _, v = np.linalg.svd(z.T @ np.where(z @ turn > 0, 1.0, -1.0))
                turn = u @ v
            parts.append(axes @ turn)
        self.turn = np.concatenate(parts, 1)[:, :BITS]
        self.radius = self._fitted_radius(sample, k, rng)

    def _lifted(self, x: np.ndarray) -> np.ndarray:
        x = x / self.longest
        return np.c_[x, np.sqrt(np.maximum(0, 1 - (x * x).sum(1)))]

    def _packed(self, lifted: np.ndarray) -> np.ndarray:
        bits = (lifted - self.mean) @ self.turn > 0
        return np.packbits(bits, axis=1, bitorder="little").view("<u8")[:, 0]

    def stored(self, x: np.ndarray) -> np.ndarray:
        return self._packed(self._lifted(x))

    def queries(self, q: np.ndarray) -> np.ndarray:
        q = q / np.linalg.norm(q, axis=1, keepdims=True)
        return self._packed(np.c_[q, np.zeros(len(q))])

    def _fitted_radius(self, sample: np.ndarray, k: int, rng) -> int:
        pick = rng.permutation(len(sample))[:FIT_QUERIES]
        score = sample[pick] @ sample.T
        score[np.arange(len(pick)), pick] = -np.inf
        best = np.argsort(-score, axis=1, kind="stable")[:, :min(k, len(sample) - 1)]
        if not best.size:
            return BITS
        far = np.bitwise_count(self.queries(sample[pick])[:, None] ^ self.stored(sample)[best])
        return int(np.ceil(np.quantile(far, RECALL, method="higher")))


class SubstringIndex:
    """One index per substring over the codes of a block."""

    def __init__(self, codes: np.ndarray):
        self.codes = codes
        parts = codes.astype("<u8")[:, None].view(np.uint8)
        self.order = [np.argsort(parts[:, j], kind="stable") for j in range(SUBSTRINGS)]
        self.size = [np.bincount(parts[:, j], minlength=256) for j in range(SUBSTRINGS)]

    def within(self, code: np.uint64, radius: int) -> np.ndarray:
        """Places of all codes within the radius."""
        near = np.zeros(len(self.codes), bool)
        part = np.array([code], "<u8").view(np.uint8)
        for j in range(SUBSTRINGS):
            buckets = np.bitwise_count(np.arange(256, dtype=np.uint8) ^ part[j]) <= radius // SUBSTRINGS
            near[self.order[j][np.repeat(buckets, self.size[j])]] = True
        found = np.flatnonzero(near)
        return found[np.bitwise_count(self.codes[found] ^ code) <= radius]


def usable(vectors: DataFrame) -> DataFrame:
    """vec_id and vector (doubles) of the rows that take part, repeated ones once."""
    kept = vectors.select("vec_id", F.col("embedding").cast("array<double>").alias("vector")).where(
        F.col("vec_id").isNotNull()
        & F.forall("vector", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
        & F.exists("vector", lambda x: x != 0))
    sizes = kept.groupBy(F.size("vector").alias("n")).count().orderBy(F.desc("count"), F.desc("n"))
    most = sizes.limit(1).collect()
    return kept.where(F.size("vector") == (most[0].n if most else 0)).distinct()


def _search(codes: Codes, k: int):
    def run(queries: pd.DataFrame, stored: pd.DataFrame) -> pd.DataFrame:
        out = []
        if len(queries) and len(stored):
            x = np.stack(stored["vector"].to_numpy())
            q = np.stack(queries["vector"].to_numpy())
            first = stored["first"].to_numpy()
            index, sizes = SubstringIndex(codes.stored(x)), stored["size"].to_numpy()
            for key, v, code in zip(queries["query"], q, codes.queries(q), strict=True):
                at = index.within(code, codes.radius)
                if sizes[at].sum() <= k:
                    at = np.arange(len(x))
                score = x[at] @ v
                if len(at) > 4 * k:
                    cut = np.partition(score, len(at) - k - 1)[len(at) - k - 1]
                    at, score = at[score >= cut], score[score >= cut]
                best = np.lexsort((first[at], -score))[:k + 1]
                out.append(pd.DataFrame({"query": key, "candidate": first[at[best]],
                                         "score": score[best],
                                         "ids": stored["ids"].to_numpy()[at[best]]}))
        return pd.concat(out) if out else pd.DataFrame(
            {"query": [], "candidate": [], "score": [], "ids": []})
    return run


def nearest(vectors: DataFrame, k: int = K, every: int = EVERY) -> DataFrame:
    """query_id, rank, vec_id, score: the k nearest rows of each row whose id is divisible."""
    scratch = Scratch(vectors.select("vec_id"), "nearest")
    rows = scratch.keep(usable(vectors), "rows")
    inside = Window.partitionBy("vector").orderBy("vec_id")
    entries = scratch.keep(
        rows.withColumn("n", F.row_number().over(inside)).where(F.col("n") <= k + 1)
        .groupBy("vector").agg(F.sort_array(F.collect_list("vec_id")).alias("ids"))
        .withColumn("first", F.col("ids")[0]).withColumn("size", F.size("ids")), "entries")
    asked = scratch.keep(rows.where(F.col("vec_id") % every == 0).join(
        entries.select("vector", F.col("first").alias("query")), "vector"), "asked")
    shape = entries.agg(
        F.count("*").alias("n"),
        F.max(F.sqrt(F.aggregate("vector", F.lit(0.0), lambda a, x: a + x * x))).alias("longest"))
    queries = asked.groupBy("query").agg(F.first("vector").alias("vector"))
    total, n_queries = shape.first(), queries.count()
    result = "query long, candidate long, score double, ids array<long>"
    if n_queries:
        sample = entries.orderBy(F.xxhash64("first"), "first").limit(FIT_ROWS).toPandas()
        codes = Codes(np.stack(sample["vector"].to_numpy()), float(total.longest), k)
        blocks, query_blocks = -(-total.n // BLOCK), -(-n_queries // QUERY_BLOCK)
        deal = lambda c, n: F.pmod(F.xxhash64(c), F.lit(n)).cast("int")
        every_block = lambda n: F.explode(F.sequence(F.lit(0), F.lit(n - 1)))
        left = (queries.withColumn("qb", deal("query", query_blocks))
                .withColumn("eb", every_block(blocks)))
        right = (entries.withColumn("eb", deal("first", blocks))
                 .withColumn("qb", every_block(query_blocks)))
        found = (left.groupBy("qb", "eb").cogroup(right.groupBy("qb", "eb"))
                 .applyInPandas(_search(codes, k), result))
    else:
        found = vectors.sparkSession.createDataFrame([], result)
    best = Window.partitionBy("query").orderBy(F.desc("score"), "candidate")
    found = scratch.keep(found.withColumn("n", F.row_number().over(best))
                         .where(F.col("n") <= k + 1).drop("n"), "found")
    scratch.drop("rows")
    listed = found.groupBy("query").agg(F.collect_list(F.struct("score", "ids")).alias("near"))
    pairs = (asked.select(F.col("vec_id").alias("query_id"), "query").join(listed, "query")
             .select("query_id", F.explode("near").alias("near"))
             .select("query_id", "near.score", F.explode("near.ids").alias("vec_id"))
             .where("vec_id <> query_id").distinct())
    order = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    return (pairs.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)
            .select("query_id", "rank", "vec_id", "score"))

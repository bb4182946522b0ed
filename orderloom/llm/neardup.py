"""Near-duplicate documents: DartMinHash signatures, banded joining, exact check, components.

A text is the weighted set of its shingles (``SHINGLE`` words; a shorter text with any word is
one shingle). A shingle that occurs n times has weight 1 + floor(log2(n)) (``counted="log"``), so
repeats count, but texts that share little but one line repeated many times stay apart; ``True`` takes
n itself and ``False`` sets. Darts of a fixed random process are thrown
at the area (shingle x weight x rank); those that land within a text's weights are kept in
order of rank and each of ``COORDINATES`` coordinates keeps its earliest dart. Two texts
agree in a coordinate with probability equal to their weighted Jaccard similarity, and the
cost is the number of darts plus shingles, not their product.

Bands of coordinates are the join keys. Each bucket links its members to one leader, the
member that meets most others in all its buckets (the hub of a family of copies), never all pairs
of a group; candidates are checked exactly on their shingles. What a bucket still holds in
different classes after that is compared inside the join: a pair leaves it, from the first bucket
it shares, only if a 128-bit and a 1,024-bit sketch say it may be similar and both have enough
shingles that any other candidate has at all (a text with many shingles of its own cannot reach
the similarity with anything). No link between different texts is lost to the leaders. Classes are connected components, found by contraction
in Spark; no link, class or signature passes through the driver.

Exact copies are one node (md5 of the text), so a group of copies costs one signature row.

With 32 bands of 4 coordinates a pair at similarity 0.8 is missed with probability 5e-8.

Defined results: null, empty and blank texts have no shingles and are each a class of
their own; repeated rows are copies; a class is named by its least doc_id (null if
it has no other). ``links`` counts the checked links of the row's text to other texts. Other
columns are ignored.
"""

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from orderloom.llm.common import (U64, Scratch, column, gram_hashes, gram_valid, mix, signed, slices,
                                  word_hashes, words_of)
from orderloom.operators.picking import first_rows, lookup_groups

SHINGLE = 5
SIMILARITY = 0.8
BANDS, ROWS = 32, 4
COORDINATES = BANDS * ROWS
#: Least number of equal sketch bits (of 128) for a pair to be checked exactly. At similarity
#: 0.8 a bit agrees with probability 0.9: 115 expected, 3.4 standard deviation.
SKETCH_BITS = 97
#: Bits of the longer sketch, for texts the leaders left, and how many standard deviations a
#: similar pair may fall short of the expected agreement (a miss in 75,000 at the threshold).
LONG_SKETCH, SHORTFALL = 1024, 4.2
LONGS = [f"long{i}" for i in range(LONG_SKETCH // 64)]
UNIT = 2.0 ** -53
Counted = bool | str


def _uniform(x: np.ndarray) -> np.ndarray:
    return ((x >> U64(11)).astype(np.float64) + 0.5) * UNIT


def weighted_shingles(h: np.ndarray, ends: np.ndarray, counted: Counted, n: int = SHINGLE):
    """(owner, shingle, weight) of each text's distinct shingles, ordered by both."""
    sizes = np.diff(ends)
    grams = mix(gram_hashes(h, n))
    at = np.flatnonzero(gram_valid(ends, n))
    owner = np.searchsorted(ends, at, "right") - 1
    ids = grams[at]
    for size in range(1, n):  # texts that are one short shingle
        few = np.flatnonzero(sizes == size)
        if len(few):
            owner = np.r_[owner, few]
            ids = np.r_[ids, mix(gram_hashes(h, size)[ends[few]] ^ U64(size))]
    order = np.lexsort((ids, owner))
    owner, ids = owner[order], ids[order]
    first = np.flatnonzero(np.r_[True, (np.diff(owner) != 0) | (ids[1:] != ids[:-1])][:len(ids)])
    weight = np.diff(np.r_[first, len(ids)]) if counted else np.ones(len(first), np.int64)
    if counted == "log":
        weight = np.frexp(weight)[1].astype(np.int64)  # the number of binary digits
    return owner[first], ids[first], weight


def _throw(ids: np.ndarray, weights: np.ndarray, limit: np.ndarray, owner: np.ndarray):
    """(owner, rank, dart) of the darts that land within the weights and below the limits.

    The weight axis of an element is cut into regions [2**v - 1, 2**(v + 1) - 1); region v
    gets darts as a Poisson process of rate 2**v in rank. A dart is kept if its place on the
    weight axis lies below the element's weight.
    """
    out = [], [], []
    for v in range(int(np.log2(weights.max() + 1)) + 1):
        size = 2.0 ** v
        alive = np.flatnonzero(weights > size - 1)
        seed = mix(ids[alive] ^ U64(0x5851F42D4C957F2D * (v + 1) & (2 ** 64 - 1)))
        rank, j = np.zeros(len(alive)), 0
        while len(alive):
            j += 1
            here = mix(seed + U64(j * 0x9E3779B97F4A7C15 & (2 ** 64 - 1)))
            rank = rank - np.log(_uniform(here)) / size
            near = rank < limit[alive]
            alive, seed, rank, here = alive[near], seed[near], rank[near], here[near]
            place = size - 1 + size * _uniform(mix(here ^ U64(0xA0761D6478BD642F)))
            hit = place < weights[alive]
            for x, got in zip(out, (owner[alive], rank, mix(here ^ U64(0xE7037ED1A0B428DB))),
                              strict=True):
                x.append(got[hit])
    return [np.concatenate(x) for x in out]


def darts(owner: np.ndarray, ids: np.ndarray, weights: np.ndarray, n: int,
          k: int = COORDINATES, at_once: int = 250_000) -> np.ndarray:
    """Signatures of n texts (``owner`` ascending): for each coordinate the id of its
    earliest dart. Texts are taken some at a time, about ``at_once`` darts."""
    step = max(1, int(at_once / (k * (np.log(k) + 3))))
    out = np.zeros((n, k), U64)
    for t in range(0, n, step):
        end = min(n, t + step)
        lo, hi = np.searchsorted(owner, [t, end])
        out[t:end] = _earliest(owner[lo:hi] - t, ids[lo:hi], weights[lo:hi], end - t, k)
    return out


def _earliest(owner: np.ndarray, ids: np.ndarray, weights: np.ndarray, n: int, k: int) -> np.ndarray:
    """Ranks up to a limit for k (ln k + 3) darts fill all coordinates of most texts; the
    limit of the others doubles until theirs are filled, too."""
    total = np.bincount(owner, weights, n)
    todo, out = total > 0, np.zeros(n * k, U64)
    limit = k * (np.log(k) + 3) / np.maximum(total, 1)
    while todo.any():
        some = todo[owner]
        who, rank, dart = _throw(ids[some], weights[some], limit[owner[some]], owner[some])
        at = who * k + (dart % U64(k)).astype(np.int64)
        best = np.full(n * k, np.inf)
        np.minimum.at(best, at, rank)
        win = rank == best[at]
        out[at[win]] = dart[win]
        todo &= ~np.isfinite(best.reshape(n, k)).all(1)
        limit[todo] *= 2
    return out.reshape(n, k)


def _signature_rows(counted: Counted):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in slices(batches):
            words = words_of(part)
            sign = darts(*weighted_shingles(word_hashes(words), words.ends, counted), part.num_rows)
            kept = np.flatnonzero(np.diff(words.ends) > 0)
            sign = sign[kept]
            bits = (mix(sign) & U64(1)).reshape(len(kept), 2, 64) << np.arange(64, dtype=U64)
            sketch = np.bitwise_or.reduce(bits, 2)
            band = gram_hashes_rows(sign.reshape(len(kept), BANDS, ROWS))
            keys = mix(band + np.arange(BANDS, dtype=U64) * U64(0x9E3779B97F4A7C15))
            yield pa.RecordBatch.from_arrays(
                [column(part, "key").take(pa.array(kept)),
                 pa.ListArray.from_arrays(pa.array(np.arange(len(kept) + 1) * BANDS, pa.int32()),
                                          pa.array(signed(keys.ravel()))),
                 pa.array(signed(np.ascontiguousarray(sketch[:, 0]))),
                 pa.array(signed(np.ascontiguousarray(sketch[:, 1])))],
                names=["key", "bands", "sketch0", "sketch1"])
    return run


def gram_hashes_rows(band: np.ndarray) -> np.ndarray:
    out = band[..., 0]
    for i in range(1, band.shape[-1]):
        out = mix(out) + band[..., i]
    return mix(out)


def _keyed(docs: DataFrame) -> DataFrame:
    text = F.coalesce(F.col("text"), F.lit(""))
    return docs.select("doc_id", "text", F.unhex(F.md5(text.cast("binary"))).alias("key"))


def signatures(keyed: DataFrame, counted: Counted = "log") -> DataFrame:
    """One row per distinct text with a word: key, bands, sketch0, sketch1."""
    found = keyed.select("key", "text").mapInArrow(
        _signature_rows(counted), "key binary, bands array<long>, sketch0 long, sketch1 long")
    return first_rows(found, ["key"], ["sketch0"])


def _near(a: str, b: str) -> F.Column:
    differ = sum(F.bit_count(F.col(f"{a}.sketch{i}").bitwiseXOR(F.col(f"{b}.sketch{i}")))
                 for i in (0, 1))
    return differ <= COORDINATES - SKETCH_BITS


def shared_buckets(nodes: DataFrame, scratch: Scratch) -> DataFrame:
    """(band, key, degree, sketch0, sketch1) for buckets with several members; degree counts
    whom a key meets in all its buckets."""
    bands = nodes.select(F.explode("bands").alias("band"), "key")
    several = lookup_groups(bands, ["band"]).agg(F.count("*").alias("n")).where("n > 1")
    met = scratch.keep(bands.join(several.select("band", "n"), "band"), "met")
    degree = met.groupBy("key").agg(F.sum("n").alias("degree"))
    known = degree.join(nodes.select("key", "sketch0", "sketch1"), "key")
    return scratch.keep(met.drop("n").join(known, "key"), "buckets")


def leader_pairs(buckets: DataFrame) -> DataFrame:
    """Candidates (a, b), a < b: members of a bucket with its member of greatest degree."""
    leader = (lookup_groups(buckets, ["band"])
              .agg(F.max(F.struct("degree", "key", "sketch0", "sketch1")).alias("lead")).drop("_hash"))
    # Both sides come from a shuffle, so a hot bucket is split.
    met = buckets.alias("m").join(leader, "band").where("m.key <> lead.key").where(_near("m", "lead"))
    return met.select(F.least("lead.key", "m.key").alias("a"),
                      F.greatest("lead.key", "m.key").alias("b")).distinct()


def mixed_buckets(buckets: DataFrame, classes: DataFrame) -> DataFrame:
    """The rows of buckets whose members are in different classes, with ``class``."""
    named = buckets.join(classes, "key", "left").withColumn("class", F.coalesce("class", "key"))
    mixed = (lookup_groups(named, ["band"]).agg(F.min("class").alias("x"), F.max("class").alias("y"))
             .where("x <> y").select("band"))
    return named.join(mixed, "band")


def shared_weight(rows: DataFrame) -> DataFrame:
    """(key, size, shared): all of a text's shingles, and those some other text has, too.

    ``rows`` are (key, shingle, weight). A shingle of one text is found by its count alone.
    """
    single = (rows.groupBy("shingle")
              .agg(F.count("*").alias("n"), F.min("key").alias("key"), F.min("weight").alias("weight"))
              .where("n = 1").groupBy("key").agg(F.sum("weight").alias("own")))
    size = rows.groupBy("key").agg(F.sum("weight").alias("size"))
    return size.join(single, "key", "left").select(
        "key", "size", (F.col("size") - F.coalesce("own", F.lit(0))).alias("shared"))


def class_pairs(mixed: DataFrame, sizes: DataFrame, tested: DataFrame, least: float) -> DataFrame:
    """Candidates that the leaders left: in one bucket, in different classes, similar by both
    sketches, with shared shingles enough, not tested yet.

    Similarity s means common shingles of s / (1 + s) times both sizes, and no more can be common
    than either text shares with anyone. ``sizes`` has key, size, shared and the long sketch;
    a key's buckets are gathered (BANDS at most), so that a pair is met in one of them.
    """
    equal = (1 + least) / 2  # expected share of equal bits
    differ = LONG_SKETCH * (1 - equal) + SHORTFALL * (LONG_SKETCH * equal * (1 - equal)) ** 0.5
    apart = sum(F.bit_count(F.col(f"p.{c}").bitwiseXOR(F.col(f"q.{c}"))) for c in LONGS)
    own = mixed.groupBy("key").agg(F.sort_array(F.collect_set("band")).alias("bands"))
    left = (mixed.join(sizes.where(F.col("shared") >= least * F.col("size")), "key")
            .join(own, "key"))
    met = left.alias("p").join(left.alias("q"), F.expr(
        "p.band = q.band and p.key < q.key and p.class <> q.class") & _near("p", "q")
        & (F.least("p.shared", "q.shared") * (1 + least)
           >= least * (F.col("p.size") + F.col("q.size")) - 1e-9)
        & (apart <= differ)
        & (F.array_min(F.array_intersect("p.bands", "q.bands")) == F.col("p.band")))
    return (met.select(F.col("p.key").alias("a"), F.col("q.key").alias("b"))
            .join(tested, ["a", "b"], "left_anti"))


def _set_rows(counted: Counted, sketched: bool):
    """Packed shingles of each text (ids ascending, then weights), and its long sketch."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in slices(batches):
            words = words_of(part)
            owner, ids, n = weighted_shingles(word_hashes(words), words.ends, counted)
            at = np.searchsorted(owner, np.arange(part.num_rows + 1))
            weight = n.astype("<u4")
            out = [ids[a:b].tobytes() + weight[a:b].tobytes()
                   for a, b in zip(at[:-1], at[1:], strict=True)]
            more = []
            if sketched:
                sign = darts(owner, ids, n, part.num_rows, LONG_SKETCH)
                bits = (mix(sign) & U64(1)).reshape(part.num_rows, -1, 64)
                long = np.bitwise_or.reduce(bits << np.arange(64, dtype=U64), 2)
                more = [pa.array(signed(np.ascontiguousarray(c))) for c in long.T]
            yield pa.RecordBatch.from_arrays(
                [column(part, "key"), pa.array(out, pa.binary()), *more],
                names=["key", "shingles", *LONGS[:len(more)]])
    return run


def _shingle_rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Packed sets to one row per shingle."""
    for batch in batches:
        for at in range(0, batch.num_rows, 2_000):
            part = batch.slice(at, 2_000)
            sets = [_unpacked(x) for x in column(part, "shingles").to_pylist()]
            owner = np.repeat(np.arange(len(sets)), [len(i) for i, _ in sets])
            ids, weights = (np.concatenate(x) for x in zip(*sets, strict=True))
            yield pa.RecordBatch.from_arrays(
                [column(part, "key").take(pa.array(owner)), pa.array(signed(ids)),
                 pa.array(weights, pa.int64())], names=["key", "shingle", "weight"])


def _unpacked(packed: bytes) -> tuple[np.ndarray, np.ndarray]:
    n = len(packed) // 12
    return np.frombuffer(packed, U64, n), np.frombuffer(packed, "<u4", n, 8 * n)


def weighted_jaccard(a: bytes, b: bytes) -> float:
    """Similarity of two packed shingle sets."""
    (x, m), (y, n) = _unpacked(a), _unpacked(b)
    _, i, j = np.intersect1d(x, y, assume_unique=True, return_indices=True)
    both = int(np.minimum(m[i], n[j]).sum())
    return both / (int(m.sum()) + int(n.sum()) - both)


def _similar(least: float):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            x, y = (column(batch, c) for c in ("x", "y"))
            ok = [weighted_jaccard(x[i].as_py(), y[i].as_py()) >= least
                  for i in range(batch.num_rows)]
            yield batch.select(["a", "b"]).filter(pa.array(ok, pa.bool_()))
    return run


def texts_of_keys(keyed: DataFrame, wanted: DataFrame) -> DataFrame:
    """key and text, once for each wanted key."""
    found = keyed.select("key", "text", "doc_id").join(wanted, "key")
    return first_rows(found, ["key"], ["doc_id"]).select("key", "text")


def shingle_sets(keyed: DataFrame, wanted: DataFrame, counted: Counted, sketched: bool) -> DataFrame:
    longs = "".join(f", {c} long" for c in LONGS) if sketched else ""
    return texts_of_keys(keyed, wanted).mapInArrow(
        _set_rows(counted, sketched), f"key binary, shingles binary{longs}")


def checked(pairs: DataFrame, sets: DataFrame, least: float) -> DataFrame:
    """The pairs whose exact similarity reaches the least one."""
    sets = sets.select("key", "shingles")
    return (pairs.join(sets.toDF("a", "x"), "a").join(sets.toDF("b", "y"), "b")
            .mapInArrow(_similar(least), "a binary, b binary"))


def components(links: DataFrame, scratch: Scratch, name: str) -> DataFrame:
    """(key, class): the least key of each connected component, for keys with a link.

    Each round gives every node its least neighbour or itself and contracts the links to
    those; a component at least halves per round.
    """
    link = links.select("a", "b")
    named, i = None, 0
    while True:
        both = link.union(link.select(F.col("b"), F.col("a"))).toDF("u", "v")
        step = scratch.keep(lookup_groups(both, ["u"]).agg(F.least(F.min("v"), F.min("u")).alias("to"))
                            .select("u", "to"), f"{name}-step{i}")
        if named is None:
            named = step.select(F.col("u").alias("key"), F.col("to").alias("class"))
        else:
            named = (named.join(step, named["class"] == step["u"], "left")
                     .select("key", F.coalesce("to", "class").alias("class")))
        named = scratch.keep(named, f"{name}-names{i}")
        link = scratch.keep(link.join(step.toDF("a", "a2"), "a").join(step.toDF("b", "b2"), "b")
                            .where("a2 <> b2")
                            .select(F.least("a2", "b2").alias("a"), F.greatest("a2", "b2").alias("b"))
                            .distinct(), f"{name}-links{i}")
        i += 1
        if link.isEmpty():
            return named


def links_and_classes(docs: DataFrame, least: float = SIMILARITY,
                      counted: Counted = "log") -> tuple[DataFrame, DataFrame]:
    """Checked links between distinct texts (a, b), and (key, class) for linked texts."""
    scratch = Scratch(docs.select("doc_id"), "neardup")
    keyed = _keyed(docs)
    nodes = scratch.keep(signatures(keyed, counted), "signatures")
    buckets = shared_buckets(nodes, scratch)
    scratch.drop("met")
    pairs = scratch.keep(leader_pairs(buckets), "leader-pairs")
    wanted = pairs.select(F.explode(F.array("a", "b")).alias("key")).distinct()
    sets = scratch.keep(shingle_sets(keyed, wanted, counted, False), "leader-sets")
    first = scratch.keep(checked(pairs, sets, least), "leader-links")
    scratch.drop("leader-sets")
    classes = components(first, scratch, "leaders")
    mixed = scratch.keep(mixed_buckets(buckets, classes), "mixed")
    scratch.drop("signatures", "buckets")
    sets = scratch.keep(shingle_sets(keyed, mixed.select("key").distinct(), counted, True),
                        "class-sets")
    rows = sets.select("key", "shingles").mapInArrow(
        _shingle_rows, "key binary, shingle long, weight long")
    sizes = scratch.keep(shared_weight(rows), "sizes").join(sets.drop("shingles"), "key")
    more = scratch.keep(class_pairs(mixed, sizes, pairs, least), "class-pairs")
    scratch.drop("leader-pairs", "mixed", "sizes")
    second = scratch.keep(checked(more, sets, least), "class-links")
    scratch.drop("class-pairs", "class-sets")
    links = first.union(second)
    return links, classes if second.isEmpty() else components(links, scratch, "classes")


def near_duplicates(docs: DataFrame, least: float = SIMILARITY, counted: Counted = "log") -> DataFrame:
    """doc_id, class_id, links, keep for every row; keep marks the class's least doc_id
    (on each of its rows, if that id repeats) and every text without words."""
    links, classes = links_and_classes(docs, least, counted)
    degree = (links.select(F.explode(F.array("a", "b")).alias("key")).groupBy("key")
              .agg(F.count("*").alias("links")))
    keyed = _keyed(docs)
    blank = F.coalesce(~F.col("text").rlike(r"[^\x20\x09-\x0D]"), F.lit(True))
    rows = keyed.select("doc_id", "key", blank.alias("blank"))
    named = classes.join(degree, "key", "left")
    rows = (rows.join(named, "key", "left")
            .withColumn("class", F.coalesce("class", "key"))
            .withColumn("links", F.coalesce("links", F.lit(0)).cast("long")))
    first = lookup_groups(rows.where("not blank"), ["class"]).agg(F.min("doc_id").alias("first"))
    rows = rows.join(first.select("class", "first"), "class", "left")
    return rows.select(
        "doc_id", F.when(F.col("blank"), F.col("doc_id")).otherwise(F.col("first")).alias("class_id"),
        "links", (F.col("blank") | F.col("doc_id").eqNullSafe(F.col("first"))).alias("keep"))


def one_of_each(docs: DataFrame, least: float = SIMILARITY, counted: Counted = "log") -> DataFrame:
    """The documents with one row of each class, all columns as they were."""
    _, classes = links_and_classes(docs, least, counted)
    text = F.coalesce(F.col("text"), F.lit(""))
    # The row travels as one column, so that no name can clash.
    rows = docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row"), "doc_id",
                       F.unhex(F.md5(text.cast("binary"))).alias("key"),
                       F.coalesce(~text.rlike(r"[^\x20\x09-\x0D]"), F.lit(True)).alias("blank"))
    named = rows.where("not blank").join(classes, "key", "left").withColumn(
        "class", F.coalesce("class", "key"))
    one = first_rows(named, ["class"], [F.col("doc_id").asc_nulls_last(), "key"])
    return one.select("row.*").unionByName(rows.where("blank").select("row.*"))

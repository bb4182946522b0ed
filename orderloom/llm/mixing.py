"""Mix overlapping sources to target weights by min-cost flow, then pick seeded documents.

Documents are summed up by membership pattern (the set of sources they belong to). Patterns send
words to the quotas of their sources; a pattern's first pass over its documents is free,
each further pass costs more (a convex cost), so text is repeated only where a quota needs
it. Sources and patterns stay tables of any size: targets come from a few sums over the sources, and
the flow of a source that shares no document is the lesser of its quota and its passes. Only
sources that share documents, directly or through others, need the solver: each such
component is solved on its patterns alone, in a task of its own.

Documents of a pattern are taken whole in the order of a seeded hash, every pass over all
of them before the next; the last one taken of a pass is taken in part, so that the
words taken equal the flow. Only the place of that one is looked for: by sums per slice of the
hash, then among the documents of one slice, equal ones counted as one. Every other document is
taken or not by comparing its own place with it, so texts are read where they lie and none is
shuffled or sorted. Rows of one place (equal ids and sizes) that a pass cuts apart are
numbered by a distributed sort of their texts. Nothing depends on row order or partitions:
reruns agree.

Defined results: a null or empty text has size 0 and nothing is taken of it; the null source
is one source, the last; sources without words have target 0; rows that repeat are separate
documents. An empty table gives an empty result.
"""

from collections.abc import Sequence

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window, functions as F

from orderloom.llm.common import Scratch, size_of
from orderloom.llm.neardup import components
from orderloom.operators.picking import positions

WEIGHTS = (5, 2, 1)
SHARE = 1.5
PASSES = 2
SEED = 17
SLICE_DIGITS = 3  # hex digits of the hash that make a slice: 4096 slices a pattern


def targets(sizes: dict, weights: Sequence[float] = WEIGHTS, share: float = SHARE,
            most: float = PASSES) -> dict:
    """Words for each source: ``share`` of all by weight, none above ``most`` times its size;
    what exceeds that is shared again by weight. Sources come by code point, null last."""
    names = sorted(sizes, key=lambda s: (s is None, s or ""))
    weight = {s: weights[i % len(weights)] for i, s in enumerate(names)}
    left, open_, out = share * sum(sizes.values()), list(names), {}
    for s in sorted(names, key=lambda s: most * sizes[s] / weight[s]):
        level = left / sum(weight[x] for x in open_)
        if most * sizes[s] > weight[s] * level:
            return out | {x: weight[x] * level for x in open_}
        out[s] = float(most * sizes[s])
        left -= most * sizes[s]
        open_.remove(s)
    return out


def min_cost_flow(capacity: Sequence[int], members: Sequence[Sequence[int]],
                  quota: Sequence[int], passes: int = PASSES) -> np.ndarray:
    """Words each pattern (row) gives to each source (column)."""
    out = np.zeros((len(capacity), len(quota)), np.int64)
    for i, j, words in flows(capacity, members, quota, passes):
        out[i, j] = words
    return out


def flows(capacity: Sequence[int], members: Sequence[Sequence[int]], quota: Sequence[int],
          passes: int = PASSES) -> list[tuple[int, int, int]]:
    """(pattern, source, words) for every membership.

    Successive shortest paths, the costs of the passes being 0, 1, 4, ...; ``members``
    lists the sources of each pattern.
    """
    p, s = len(capacity), len(quota)
    start, end, sink = 0, p + s + 1, p + s + 1
    arcs = [(start, 1 + i, c, k * k) for i, c in enumerate(capacity) for k in range(passes)]
    arcs += [(1 + i, 1 + p + j, passes * capacity[i], 0) for i in range(p) for j in members[i]]
    arcs += [(1 + p + j, sink, q, 0) for j, q in enumerate(quota)]
    tail, head, room, cost = (np.array([f(a) for a in arcs], np.int64) for f in (
        lambda a: a[0], lambda a: a[1], lambda a: a[2], lambda a: a[3]))
    tail, head = np.r_[tail, head], np.r_[head, tail]
    room, cost = np.r_[room, np.zeros_like(room)], np.r_[cost, -cost]
    n = len(arcs)
    far = np.iinfo(np.int64).max // 4
    while True:
        length = np.full(end + 1, far)
        length[start] = 0
        by = np.full(end + 1, -1)
        while True:  # Bellman-Ford over all arcs at once
            open_ = np.flatnonzero((room > 0) & (length[tail] < far))
            reach = length[tail[open_]] + cost[open_]
            better = reach < length[head[open_]]
            if not better.any():
                break
            order = np.argsort(-reach[better], kind="stable")
            at = open_[better][order]
            length[head[at]], by[head[at]] = reach[better][order], at
        if length[sink] >= far:
            break
        path, node = [], sink
        while node != start:
            path.append(by[node])
            node = tail[by[node]]
        most = room[path].min()
        room[path] -= most
        room[[(a + n) % (2 * n) for a in path]] += most
    return [(u - 1, v - 1 - p, int(c - room[a])) for a, (u, v, c, _) in enumerate(arcs)
            if 1 <= u <= p and v < sink]


def aims(sizes: DataFrame, weights: Sequence[float] = WEIGHTS, share: float = SHARE,
         most: int = PASSES) -> DataFrame:
    """``targets`` of a table (source, n) of any length, as ``aim``; sources in their order."""
    at = F.pmod(F.col("position"), F.lit(len(weights))).cast("int")
    rows = positions(sizes, ["source"]).select(
        "source", "n", (F.col("n") * most).alias("cap"),
        F.element_at(F.array(*map(F.lit, map(float, weights))), at + 1).alias("weight"))
    all_ = rows.agg(F.sum("n").alias("n"), F.sum("weight").alias("weight")).first()
    level, capped = share * (all_.n or 0) / (all_.weight or 1), None
    while True:  # the level rises as the sources that are full leave more to the others
        full = F.col("cap") <= F.col("weight") * level
        now = rows.agg(F.count_if(full).alias("full"), F.sum(F.when(full, F.col("cap"))).alias("cap"),
                       F.sum(F.when(~full, F.col("weight"))).alias("weight")).first()
        if now.full == capped or not now.weight:
            break
        level, capped = (share * all_.n - (now.cap or 0)) / now.weight, now.full
    return rows.select("source", "n", F.when(full, F.col("cap").cast("double")).otherwise(
        F.col("weight") * level).alias("aim"))


def mix(docs: DataFrame, sources: Column, weights: Sequence[float] = WEIGHTS,
        share: float = SHARE, passes: int = PASSES, seed: int = SEED) -> DataFrame:
    """The documents with ``_size``, ``_source_size``, ``_target`` (of the first source by
    code point) and ``_taken``, the words the mix takes, repeats counted.

    ``sources`` is an array column: all sources a row belongs to.
    """
    pattern = F.to_json(F.array_sort(F.array_distinct(sources)), {"ignoreNullFields": "false"})
    order = F.md5(F.concat(F.lit(f"{seed}:"), F.coalesce(F.col("doc_id").cast("string"), F.lit("")))
                  .cast("binary"))
    dealt = (docs.withColumn("_pattern", pattern).withColumn("_order", order)
             .withColumn("_slice", F.substring("_order", 1, SLICE_DIGITS)))
    rows = dealt.withColumn("_size", size_of(F.col("text")))
    sizes = rows.select("_size", "_pattern", "_slice").groupBy("_pattern", "_slice").agg(
        F.sum("_size").alias("_words"))
    scratch = Scratch(docs.select("doc_id"), "mixing")
    sizes = scratch.keep(sizes, "sizes")
    whole = F.when(F.col("_all") > 0, F.expr("_flow div _all")).otherwise(0)
    plan = scratch.keep(_plan(sizes, scratch, weights, share, passes).withColumn("_whole", whole)
                        .withColumn("_rest", F.col("_flow") - F.col("_whole") * F.col("_all")), "plan")
    cuts = scratch.keep(_cuts(dealt, sizes, plan, scratch), "cuts")
    placed = rows.join(cuts, "_pattern")
    part = (F.when(_place() < F.col("_cut"), F.col("_size"))
            .when(_place() == F.col("_cut"), F.least("_size", "_left")).otherwise(0))
    out = [*docs.columns, "_size", "_source_size", "_target",
           (F.col("_whole") * F.col("_size") + part).cast("long").alias("_taken")]
    if cuts.where("_n > 1").isEmpty():
        return placed.select(*out)
    tied = F.coalesce((F.col("_n") > 1) & (_place() == F.col("_cut")), F.lit(False))
    copies = scratch.keep(placed.where(tied).withColumn("_text", F.md5(F.col("text").cast("binary")))
                          .withColumn("_copy", F.monotonically_increasing_id()), "tied")
    numbered = positions(copies, ["_pattern", "_text", "_copy"], "_number")
    first = numbered.groupBy("_pattern").agg(F.min("_number").alias("_first"))
    left = F.col("_left") - (F.col("_number") - F.col("_first")) * F.col("_size")
    numbered = numbered.join(first, "_pattern").withColumn("_left", F.greatest(F.lit(0), left))
    return placed.where(~tied).select(*out).unionAll(numbered.select(*out))


def _place() -> Column:
    """Where a document stands in its pattern."""
    return F.struct("_order", "doc_id", "_size")


def _cuts(dealt: DataFrame, sizes: DataFrame, plan: DataFrame, scratch: Scratch) -> DataFrame:
    """The plan with the place ``_cut`` at which the last pass over a pattern ends, the words
    ``_left`` for it there, and the number ``_n`` of documents at that place."""
    before = F.coalesce(F.sum("_words").over(Window.partitionBy("_pattern").orderBy("_slice")
                        .rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    last = scratch.keep(
        sizes.withColumn("_before", before).join(plan.select("_pattern", "_rest"), "_pattern")
        .where("_before <= _rest and _rest < _before + _words").drop("_words"), "last")
    inside = (Window.partitionBy("_pattern").orderBy("_cut")
              .rowsBetween(Window.unboundedPreceding, -1))
    words = F.col("_n") * F.col("_cut._size")
    # Joined before sizes are needed, so that words are counted in one slice only.
    found = (dealt.join(last, ["_pattern", "_slice"]).withColumn("_size", size_of(F.col("text")))
             .select("_pattern", "_before", "_rest", _place().alias("_cut"))
             .groupBy("_pattern", "_before", "_rest", "_cut").agg(F.count("*").alias("_n"))
             .withColumn("_at", F.col("_before") + F.coalesce(F.sum(words).over(inside), F.lit(0)))
             .where((F.col("_at") <= F.col("_rest")) & (F.col("_rest") < F.col("_at") + words))
             .select("_pattern", "_cut", "_n", (F.col("_rest") - F.col("_at")).alias("_left")))
    return plan.join(found, "_pattern", "left").drop("_flow", "_all", "_rest")


def _solved(passes: int):
    def run(rows: pd.DataFrame) -> pd.DataFrame:
        rows = rows.sort_values(["_pattern", "source"])
        pattern, first = np.unique(rows["_pattern"].to_numpy(str), return_index=True)
        source, one = np.unique(rows["source"].to_numpy(str), return_index=True)
        own = np.split(np.searchsorted(source, rows["source"].to_numpy(str)), first[1:])
        words = np.zeros(len(pattern), np.int64)
        for i, _, n in flows(rows["_all"].to_numpy()[first].tolist(), [x.tolist() for x in own],
                             rows["quota"].to_numpy()[one].tolist(), passes):
            words[i] += n
        return pd.DataFrame({"_pattern": rows["_pattern"].to_numpy()[first], "_flow": words})
    return run


def _plan(sizes: DataFrame, scratch: Scratch, weights, share, passes) -> DataFrame:
    """_pattern, _flow, _all, _source_size, _target for every membership pattern."""
    # Names by code point, the null source last.
    named = F.transform(F.from_json("_pattern", "array<string>"), lambda x: F.when(
        x.isNull(), "1").otherwise(F.concat(F.lit("0"), x)))
    patterns = scratch.keep(sizes.groupBy("_pattern").agg(F.sum("_words").alias("_all"))
                            .withColumn("_names", named), "patterns")
    members = patterns.select("_pattern", "_all", F.explode("_names").alias("source"))
    found = scratch.keep(aims(members.groupBy("source").agg(F.sum("_all").alias("n")),
                              weights, share, passes), "aims")
    alone = F.least(F.floor("aim"), F.col("_all") * passes).alias("_flow")
    plan = patterns.join(found, F.col("_names")[0] == found["source"]).select(
        "_pattern", alone, "_all", F.col("n").alias("_source_size"), F.col("aim").alias("_target"))
    several = patterns.where(F.size("_names") > 1)
    if several.isEmpty():
        return plan
    links = several.select(F.col("_names")[0].alias("a"), F.explode("_names").alias("b")).where("a <> b")
    classes = components(links.distinct(), scratch, "shared")
    solved = (members.join(found.select("source", F.floor("aim").alias("quota")), "source")
              .join(classes.select(F.col("key").alias("source"), "class"), "source")
              .groupBy("class").applyInPandas(_solved(passes), "_pattern string, _flow long"))
    return plan.withColumnRenamed("_flow", "_alone").join(solved, "_pattern", "left").select(
        "_pattern", F.coalesce("_flow", "_alone").alias("_flow"), "_all", "_source_size", "_target")


def mixed_sizes(docs: DataFrame) -> DataFrame:
    """doc_id, size, source_size, target, taken for every document, one source each."""
    found = mix(docs.select("doc_id", "text", "source"), F.array("source"))
    return found.select("doc_id", F.col("_size").alias("size"),
                        F.col("_source_size").alias("source_size"),
                        F.col("_target").alias("target"), F.col("_taken").alias("taken"))


def mixed_documents(docs: DataFrame) -> DataFrame:
    """The documents of the mix, one row for each time one is read: a document of which at
    least half is taken in a pass is read whole in it. All columns as they were."""
    copies = F.when(F.col("_size") > 0, F.round(F.col("_taken") / F.col("_size"))).otherwise(0)
    rows = docs.select("doc_id", "text", "source", F.struct(*_all(docs)).alias("row"))
    found = mix(rows, F.array("source")).withColumn("_copies", copies.cast("int"))
    return (found.where("_copies > 0")
            .withColumn("_copy", F.explode(F.sequence(F.lit(1), F.col("_copies"))))
            .select("row.*"))


def _all(docs: DataFrame) -> list[Column]:
    return [F.col(f"`{c}`") for c in docs.columns]

"""Substring dedup: remove long word spans that occur earlier in the corpus.

The windows of ``width`` words are the k-mers of a De Bruijn graph. They are never
shuffled one by one:

* ``edges``: each text is cut into edges, runs of windows that share an anchor (the least hash
  among the ``ANCHOR``-word grams a window holds). Which anchor a window has depends on its
  words alone, so equal windows always lie on edges with the same anchor. An edge is a
  path of the graph without branches inside; its content hash names it.
* ``sources``: anchors seen once end the matter for their edges. For the others one join by
  (anchor, content) gives each path its source, its first coordinate; all other
  occurrences are copies as a whole, whatever their number.
* ``source_windows``: an anchor with several contents is a branch (the end of a copy, an edit).
  Only there, and only for the source of each content, single windows are compared.
* the repeated stretches are merged per document and cut from the text.

A coordinate counts as a copy of its source only if cryptographic digests of the words
themselves agree, 64 bits of a path's besides its anchor and 128 of a single window's. Joins
are against one row per key and both sides come from a shuffle, so adaptive execution splits
a hot key.

Defined results: coordinates are ordered by (doc_id, start), a null doc_id first; rows with
the same doc_id and the same text count as one document and get the same result; rows with the
same doc_id and different texts are told apart by the crc32 of the text, which also
orders equal starts. Texts with fewer than ``width`` words, empty and null texts lose nothing.
"""

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, functions as F

from orderloom.llm.common import (U64, Scratch, Words, column, gram_hashes, gram_valid, mix, signed,
                                  slices, word_hashes, words_of)
from orderloom.operators.picking import lookup_groups

WIDTH = 20
ANCHOR = 6

#: A text's coordinate system: its id, and its crc32 in case the id repeats.
DOC = ["doc_id", "_tag"]


def _tag():
    return F.crc32(F.coalesce(F.col("text"), F.lit("")).cast("binary"))


def _rows(docs: DataFrame) -> DataFrame:
    return docs.select("doc_id", "text", _tag().alias("_tag"))


def _here():
    return F.struct("doc_id", "start", "_tag")


def _least(values: np.ndarray, n: int) -> np.ndarray:
    """Where the leftmost least of each n consecutive values is, by doubling."""
    best, at, reach = values, np.arange(len(values)), 1
    while reach < n:
        shift = min(reach, n - reach)
        left = best[:-shift] <= best[shift:]
        best, at = (np.where(left, x[:-shift], x[shift:]) for x in (best, at))
        reach += shift
    return at


class Spans:
    """Digests of the words of spans of a batch, joined by one space. (Without an argument, bytes are
    split at just the white space that separates words.)"""

    def __init__(self, words: Words):
        places = words.places.tolist()
        texts = (words.data[a:b].tobytes().split() for a, b in zip(places[:-1], places[1:], strict=True))
        self.data = memoryview(b"".join([b" ".join([*t, b""]) for t in texts if t]))
        self.at = np.cumsum(np.r_[0, words.last - words.first + 1])

    def digests(self, first: np.ndarray, end: np.ndarray, size: int) -> np.ndarray:
        """One row of ``size`` bytes as 64-bit numbers for each span of words."""
        data, where = self.data, zip(self.at[first].tolist(), (self.at[end] - 1).tolist(), strict=True)
        found = b"".join([hashlib.blake2b(data[a:b], digest_size=size).digest() for a, b in where])
        return np.frombuffer(found, "<u8").reshape(-1, size // 8)


def cut_edges(words: Words, width: int):
    """Edges of a batch: text number, first window, windows, anchor, content digest."""
    h, ends = word_hashes(words), words.ends
    starts = np.flatnonzero(gram_valid(ends, width))
    if not len(starts):
        return [np.zeros(0, np.int64)] * 3 + [np.zeros(0, U64)] * 2
    grams = mix(gram_hashes(h, ANCHOR))
    at = _least(grams, width - ANCHOR + 1)[starts]
    owner = np.searchsorted(ends, starts, "right") - 1
    first = np.flatnonzero(np.r_[True, (np.diff(at) != 0) | (np.diff(owner) != 0)])
    count = np.diff(np.r_[first, len(starts)])
    s, a, o = starts[first], at[first], owner[first]
    content = Spans(words).digests(s, s + count + width - 1, 8)[:, 0]
    content = mix(content ^ ((a - s) * 64 + count).astype(U64))
    return o, s - ends[o], count, grams[a], content


def _edge_rows(width: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in slices(batches):
            words = words_of(part)
            o, start, count, anchor, content = cut_edges(words, width)
            owners = pa.array(o)
            yield pa.RecordBatch.from_arrays(
                [column(part, "doc_id").take(owners), column(part, "_tag").take(owners),
                 pa.array(start, pa.int32()), pa.array(count, pa.int32()),
                 pa.array(signed(anchor)), pa.array(signed(content))],
                names=[*DOC, "start", "windows", "anchor", "content"])
    return run


def edges(rows: DataFrame, width: int = WIDTH) -> DataFrame:
    kind = rows.schema["doc_id"].dataType.simpleString()
    return rows.mapInArrow(_edge_rows(width), f"doc_id {kind}, _tag long, start int, windows int, "
                                              "anchor long, content long")


def repeated_anchors(found: DataFrame) -> DataFrame:
    """The edges whose anchor occurs more than once; only anchors are counted for it."""
    again = lookup_groups(found, ["anchor"]).agg(F.count("*").alias("n")).where("n > 1")
    return found.join(again.select("anchor"), "anchor")


def sources(many: DataFrame) -> DataFrame:
    """(anchor, content, windows, source): each path's first coordinate."""
    return lookup_groups(many, ["anchor", "content"]).agg(
        F.min("windows").alias("windows"), F.min(_here()).alias("source")).drop("_hash")


def _window_rows(width: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in slices(batches):
            words, lists = words_of(part), column(part, "spans")
            owner = np.repeat(np.arange(part.num_rows), pc.list_value_length(lists).to_numpy())
            spans = lists.flatten()
            start, count = (spans.field(k).to_numpy().astype(np.int64) for k in (0, 1))
            who = np.repeat(owner, count)
            at = (np.repeat(start, count) + np.arange(len(who))
                  - np.repeat(np.cumsum(count) - count, count))
            flat, owners = at + words.ends[who], pa.array(who)
            digests = Spans(words).digests(flat, flat + width, 16)
            yield pa.RecordBatch.from_arrays(
                [column(part, "doc_id").take(owners), column(part, "_tag").take(owners),
                 pa.array(at, pa.int32()),
                 *(pa.array(signed(np.ascontiguousarray(digests[:, k]))) for k in (0, 1))],
                names=[*DOC, "start", "one", "two"])
    return run


def _same_document(a: DataFrame, b: DataFrame):
    return a["doc_id"].eqNullSafe(b["doc_id"]) & (a["_tag"] == b["_tag"])


def source_windows(rows: DataFrame, first: DataFrame, width: int = WIDTH) -> DataFrame:
    """The windows of the sources at branches, one row each, with the halves of a digest."""
    branch = lookup_groups(first, ["anchor"]).agg(F.count("*").alias("n")).where("n > 1")
    spans = (first.join(branch.select("anchor"), "anchor").select("source.*", "windows")
             .groupBy(*DOC).agg(F.collect_list(F.struct("start", "windows")).alias("spans")))
    texts = rows.dropDuplicates(DOC)
    kind = rows.schema["doc_id"].dataType.simpleString()
    return (texts.join(spans, _same_document(texts, spans))
            .select(texts["doc_id"], "text", texts["_tag"], "spans")
            .mapInArrow(_window_rows(width),
                        f"doc_id {kind}, _tag long, start int, one long, two long"))


def repeats(rows: DataFrame, scratch: Scratch, width: int = WIDTH) -> DataFrame:
    """(doc_id, _tag, _spans): lists of (start, end) word spans all of whose windows occur
    earlier."""
    many = scratch.keep(repeated_anchors(scratch.keep(edges(rows, width), "edges")), "repeated")
    scratch.drop("edges")
    first = scratch.keep(sources(many), "sources")
    copy = ~_here().eqNullSafe(F.col("source"))
    whole = many.drop("windows").join(first, ["anchor", "content"]).where(copy).select(
        *DOC, "start", (F.col("start") + F.col("windows") + (width - 1)).alias("end"))
    windows = scratch.keep(source_windows(rows, first, width), "windows")
    again = (lookup_groups(windows, ["one", "two"])
             .agg(F.count("*").alias("n"), F.min(_here()).alias("source"))
             .where("n > 1").drop("n", "_hash"))
    single = windows.join(again, ["one", "two"]).where(copy).select(
        *DOC, "start", (F.col("start") + width).alias("end"))
    spans = scratch.keep(whole.unionByName(single).groupBy(*DOC)
                         .agg(F.collect_list(F.struct("start", "end")).alias("_spans")), "spans")
    scratch.drop("repeated", "sources", "windows")
    return spans


def with_spans(docs: DataFrame, width: int = WIDTH) -> DataFrame:
    """All columns of the documents, ``_tag``, and ``_spans``: the list of repeated
    (start, end) word spans, null where there is none."""
    scratch = Scratch(docs.select("doc_id"), "substrings")
    gone = repeats(_rows(docs), scratch, width)
    named = docs.withColumn("_tag", _tag())
    return scratch.few(named.join(gone, _same_document(named, gone), "left").select(
        *[named[c] for c in docs.columns], named["_tag"], gone["_spans"]))


def kept_words(part: pa.RecordBatch, words) -> np.ndarray:
    """Which words of a batch lie in none of their text's spans."""
    lists = column(part, "_spans")
    sizes = pc.fill_null(pc.list_value_length(lists), 0).to_numpy()
    base = np.repeat(words.ends[:-1], sizes)
    spans = lists.flatten()
    change = np.zeros(len(words.first) + 1, np.int64)
    np.add.at(change, spans.field(0).to_numpy() + base, 1)
    np.add.at(change, spans.field(1).to_numpy() + base, -1)
    return np.cumsum(change[:-1]) == 0


def joined_words(words, kept: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Bytes of the kept words of each text joined by one space, and where each text begins."""
    first, last, owner = words.first[kept], words.last[kept], words.owners()[kept]
    size = last - first + 1  # with the space behind it
    final = np.r_[owner[1:] != owner[:-1], True][:len(owner)]
    size = size - final
    at = np.cumsum(size) - size
    out = np.full(int(size.sum()), 0x20, np.uint8)
    length = last - first
    into = np.repeat(at - (np.cumsum(length) - length), length) + np.arange(length.sum())
    from_ = np.repeat(first - (np.cumsum(length) - length), length) + np.arange(length.sum())
    out[into] = words.data[from_]
    begins = np.bincount(owner, size, len(words.ends) - 1).astype(np.int64)
    return out, np.r_[0, np.cumsum(begins)]


def _digest(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for part in slices(batches):
        words = words_of(part)
        kept = kept_words(part, words)
        data, at = joined_words(words, kept)
        n = np.diff(words.ends)
        left = np.bincount(words.owners()[kept], minlength=len(n))
        sha = [hashlib.sha256(data[a:b]).hexdigest() for a, b in zip(at[:-1], at[1:], strict=True)]
        yield pa.RecordBatch.from_arrays(
            [column(part, "doc_id"), pa.array(n, pa.int64()), pa.array(n - left, pa.int64()),
             pa.array(sha, pa.string())], names=["doc_id", "n_words", "n_removed", "kept_sha256"])


def digest(docs: DataFrame, width: int = WIDTH) -> DataFrame:
    """doc_id, n_words, n_removed, kept_sha256 for every document."""
    kind = docs.schema["doc_id"].dataType.simpleString()
    return with_spans(docs.select("doc_id", "text"), width).mapInArrow(
        _digest, f"doc_id {kind}, n_words long, n_removed long, kept_sha256 string")


def cut_text(words, kept: np.ndarray, t: int) -> str:
    """Text t without the words that are not kept; the rest keeps its white space. A run of
    removed words goes with the white space behind it."""
    lo, hi = words.ends[t], words.ends[t + 1]
    begin, end = words.places[t], words.places[t + 1]
    mask = np.ones(end - begin, bool)
    drops = np.flatnonzero(~kept[lo:hi]) + lo
    for run in np.split(drops, np.flatnonzero(np.diff(drops) > 1) + 1):
        after = words.first[run[-1] + 1] if run[-1] + 1 < hi else end
        mask[words.first[run[0]] - begin:after - begin] = False
    return words.data[begin:end][mask].tobytes().decode("utf-8")


def without_repeats(docs: DataFrame, width: int = WIDTH) -> DataFrame:
    """The documents with repeated spans cut from their texts and ``n_chars`` (if there)
    counted anew; a document that loses all its words goes."""
    # Other columns travel under names of our own, so that none can clash.
    inner = {c: c if c in ("doc_id", "text") else f"c{i}" for i, c in enumerate(docs.columns)}
    named = docs.select(*[F.col(f"`{c}`").alias(n) for c, n in inner.items()])
    return with_spans(named, width).mapInArrow(_cut_rows(inner), docs.schema)


def _cut_rows(names: dict[str, str]):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in slices(batches):
            words = words_of(part)
            kept = kept_words(part, words)
            left = np.bincount(words.owners()[kept], minlength=part.num_rows)
            lost = np.diff(words.ends) - left
            rows = np.flatnonzero((lost == 0) | (left > 0))
            new = [cut_text(words, kept, t) if lost[t] else None for t in rows]
            yield _replaced(part, names, rows, new)
    return run


def _replaced(part: pa.RecordBatch, names: dict[str, str], rows, new) -> pa.RecordBatch:
    """The given rows, with the new text where there is one. ``names`` has the batch's name of
    each column."""
    at, out = pa.array(rows, pa.int64()), []
    changed = pa.array([x is not None for x in new], pa.bool_())
    for name, inner in names.items():
        values = column(part, inner).take(at)
        if name == "text":
            values = pc.if_else(changed, pa.array(new, values.type), values)
        elif name == "n_chars":
            sizes = pa.array([None if x is None else len(x) for x in new], values.type)
            values = pc.if_else(changed, sizes, values)
        out.append(values)
    return pa.RecordBatch.from_arrays(out, names=list(names))

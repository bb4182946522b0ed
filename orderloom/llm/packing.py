"""Pack token ids into sequences of a window by non-negative least squares.

A text's ids are cut into full windows and one rest; the rest stays whole. Rests are counted in
a histogram of ``STEP``-wide length classes (rounded up), the only thing the planner sees:

* every combination of up to ``DEPTH`` classes that fills the window exactly is a column;
* non-negative least squares finds how often to use each so that the histogram is met;
* the counts are rounded down, and what is left is packed greedily, largest class first,
  each combination as often as the histogram allows.

The plan has a row per combination, whatever the number of documents. Pieces get a number
within their length class in two levels (class and slice of a hash, then slices added up), so
no class is sorted in one task, and find their sequence by binary search in the plan. Equal
pieces (of rows that repeat) are counted before they are numbered and told apart again in runs of
``RUN``, so a row that is there very often is neither one group nor one task.

Ids come from the tokenizer library, once per distinct pre-token of a task: texts are cut into
pre-tokens on their bytes, told apart by two numbers (equal only for equal words or,
if long, equal 128-bit digests), and only new ones are tokenized, all in one call. Texts with special strings or characters outside the Latin letters go to the
library whole.

Defined results: a null or empty text is one piece with the closing id alone; repeated rows are
separate documents; sequences hold 1 to ``window`` ids. Other columns are ignored.
"""

import re
import zlib
from collections.abc import Iterator
from functools import cached_property
from itertools import combinations_with_replacement

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window, functions as F

from orderloom.llm.common import (U64, Scratch, Words, column, give_back, kept_over_tasks, mix, slices,
                                  texts_of, word_hash_pairs)

WINDOW = 2048
STEP = 8
DEPTH = 3
CLOSING = 1
SLICES = 256
RUN = 4096
#: Bytes of text that a task cuts at once; the arrays for it take many times that.
SLICE = 1_000_000

#: Texts of these characters only are cut here: white space that the library and Python agree
#: on, printable ASCII, and letters from U+00C0 to U+024F (without the dotted capital I, whose
#: lower case is two characters).
_PLAIN = re.compile("[\t-\r\x20-\x7e\xc0-\xd6\xd8-\xf6\xf8-\u012f\u0131-\u024f]*")

#: Kinds of bytes in such texts: white space, letters (and all bytes of longer characters),
#: digits, which stand alone, and the rest.
_SPACE, _LETTER, _DIGIT, _OTHER = range(4)
_KIND = np.array([_SPACE if b == 0x20 or 0x09 <= b <= 0x0D else _DIGIT if 0x30 <= b <= 0x39
                  else _LETTER if b >= 0x80 or chr(b).isalpha() else _OTHER for b in range(256)], np.int8)
_APOSTROPHE = 0x27


def pre_tokens(data: np.ndarray, places: np.ndarray) -> Words:
    """Pre-tokens of lower-case plain texts: runs of letters, single digits, runs of others.

    A run between white space that has an apostrophe stays whole, as contractions are cut
    by rules of their own; the library sees to those.
    """
    kind = _KIND[data]
    edge = np.zeros(len(data) + 1, bool)
    edge[places] = True
    solid = kind != _SPACE
    apart = np.r_[True, kind[1:] != kind[:-1]][:len(data)] | edge[:-1]
    run = solid & (np.r_[True, ~solid][:-1] | edge[:-1])
    number = np.cumsum(run) - 1
    whole = np.bincount(number[(data == _APOSTROPHE) & solid], minlength=int(run.sum()) + 1) > 0
    begin = solid & (run | ((apart | (kind == _DIGIT)) & ~whole[number]))
    first = np.flatnonzero(begin)
    stop = np.flatnonzero((begin | ~solid | edge[:-1])[1:]) + 1
    stop = np.r_[stop, len(data)]
    last = stop[np.searchsorted(stop, first, "right")] if len(first) else first
    return Words(data, places, first, last, np.searchsorted(first, places))


def _spread(begin: np.ndarray, size: np.ndarray) -> np.ndarray:
    """All places begin[i], ..., begin[i] + size[i] - 1, one i after the other."""
    end = np.cumsum(size)
    return np.repeat(begin - (end - size), size) + np.arange(end[-1] if len(end) else 0)


#: Which bits of the first and the second eight bytes belong to a word of 0 to 15 bytes.
_BITS = np.array([[(1 << 8 * min(8, n)) - 1, (1 << 8 * max(0, n - 8)) - 1] for n in range(16)], U64)


def exact_pairs(words: Words) -> np.ndarray:
    """Two numbers (n, 2) of each word that agree in both only for equal words of up to 15 bytes:
    the bytes and their number, spread by rounds that can be undone; longer words have the halves
    of a digest."""
    size = words.last - words.first
    short = size < 16
    out = np.empty((len(size), 2), U64)
    bytes_ = np.lib.stride_tricks.sliding_window_view(np.r_[words.data, np.zeros(16, np.uint8)], 16)
    lanes = np.ascontiguousarray(bytes_[words.first[short]]).view("<u8") & _BITS[size[short]]
    right = lanes[:, 1] | size[short].astype(U64) << U64(56)
    left = lanes[:, 0] ^ mix(right)
    right = right ^ mix(left + U64(1))
    out[short] = np.stack([left ^ mix(right + U64(2)), right], 1)
    if not short.all():
        out[~short] = word_hash_pairs(words._replace(first=words.first[~short], last=words.last[~short]))
    return out


def _whole_tokenizer(vocabulary: str):
    """The library's tokenizer without its cache, whose memory, one for each thread, outlives it."""
    from tokenizers import Tokenizer
    found = Tokenizer.from_file(vocabulary)
    found.model._resize_cache(0)
    return found


def _word_tokenizer(vocabulary: str):
    """The library's model for words that are cut and lower-case already, and which ids end a
    pre-token."""
    from tokenizers import pre_tokenizers
    words = _whole_tokenizer(vocabulary)
    words.normalizer = None
    words.pre_tokenizer = pre_tokenizers.Sequence([
        pre_tokenizers.WhitespaceSplit(),
        pre_tokenizers.ByteLevel(add_prefix_space=False, use_regex=False)])
    vocab = words.get_vocab(with_added_tokens=False)
    final = np.zeros(max(vocab.values()) + 1, bool)
    final[[i for w, i in vocab.items() if w.endswith("</w>")]] = True
    return words, final


class Ids:
    """Token ids of texts; ``most`` pre-tokens are remembered."""

    def __init__(self, vocabulary: str, most: int = 400_000):
        self.vocabulary = vocabulary
        self.words, self.final = kept_over_tasks(("packing, words", vocabulary),
                                                 lambda: _word_tokenizer(vocabulary))
        self.most = most
        self._forget(np.zeros(0, U64))

    def _forget(self, but: np.ndarray) -> None:
        """Drop what is known but for the given hashes (sorted)."""
        if not len(but):
            self.known, self.ids = np.zeros(0, U64), np.zeros(0, np.uint32)
            self.second = self.known
            self.begin = self.size = np.zeros(0, np.int64)
            return
        at = np.searchsorted(self.known, but)
        self.ids = self.ids[_spread(self.begin[at], self.size[at])]
        self.known, self.second, self.size = but, self.second[at], self.size[at]
        self.begin = np.cumsum(self.size) - self.size

    @cached_property
    def tokenizer(self):
        """The whole tokenizer, for texts and words that are not cut here."""
        return kept_over_tasks(("packing, whole", self.vocabulary),
                               lambda: _whole_tokenizer(self.vocabulary))

    def _whole(self, texts: list[str]) -> list[np.ndarray]:
        if not texts:
            return []
        found = self.tokenizer.encode_batch_fast(texts, add_special_tokens=False)
        return [np.array(x.ids, np.uint32) for x in found]

    def _cut(self, words: Words, at: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Ids of the pre-tokens and how many each has, by one call: words are joined by
        spaces, and some ids only ever end a pre-token."""
        first, size = words.first[at], words.last[at] - words.first[at]
        text = np.full(int(size.sum()) + len(at), 0x20, np.uint8)
        begin = np.cumsum(size + 1) - size - 1
        text[_spread(begin, size)] = words.data[_spread(first, size)]
        found = self.words.encode(text.tobytes().decode(), add_special_tokens=False).ids
        ids = np.array(found, np.uint32)
        stop = np.flatnonzero(self.final[ids]) + 1
        return ids, np.diff(np.r_[0, stop])

    def _learn(self, words: Words, hashes: np.ndarray, second: np.ndarray, at: np.ndarray) -> None:
        """Tokenize the pre-tokens at the given places whose hashes (sorted) are new."""
        known = np.isin(hashes, self.known, assume_unique=True)
        if known.all():
            return
        if len(self.known) + len(hashes) > self.most:
            self._forget(hashes[known])
        new, second, at = hashes[~known], second[~known], at[~known]
        marks = np.r_[0, np.cumsum(words.data == _APOSTROPHE)]
        whole = marks[words.last[at]] > marks[words.first[at]]
        ids, size = self._cut(words, at[~whole])
        rest = self._whole([words.data[a:b].tobytes().decode() for a, b in zip(
            words.first[at[whole]].tolist(), words.last[at[whole]].tolist(), strict=True)])
        size = np.r_[size, np.array([len(x) for x in rest], np.int64)]
        begin = len(self.ids) + np.cumsum(size) - size
        self.ids = np.concatenate([self.ids, ids, *rest])
        hashes = np.r_[self.known, new[~whole], new[whole]]
        order = np.argsort(hashes, kind="stable")
        self.known = hashes[order]
        self.second = np.r_[self.second, second[~whole], second[whole]][order]
        self.begin, self.size = np.r_[self.begin, begin][order], np.r_[self.size, size][order]

    def _plain(self, texts: list[str]) -> list[bytes]:
        raw = [t.lower().encode() for t in texts]
        words = pre_tokens(np.frombuffer(b"".join(raw), np.uint8),
                           np.cumsum([0, *map(len, raw)]))
        pairs = exact_pairs(words)
        hashes, at, back = np.unique(pairs[:, 0], return_index=True, return_inverse=True)
        self._learn(words, hashes, pairs[at, 1], at)
        own = np.searchsorted(self.known, hashes)
        size = self.size[own][back]
        done = np.r_[0, np.cumsum(size)]
        out = self.ids[_spread(self.begin[own][back], size)].astype("<u4").tobytes()
        ends = (done[words.ends] * 4).tolist()
        found = [out[a:b] for a, b in zip(ends[:-1], ends[1:], strict=True)]
        # Words with one hash that differ in the second: the library has the last word.
        unlike = np.unique(words.owners()[self.second[own][back] != pairs[:, 1]]).tolist()
        for i, ids in zip(unlike, self._whole([texts[i] for i in unlike]), strict=True):
            found[i] = ids.astype("<u4").tobytes()
        return found

    def __call__(self, texts: list[str]) -> list[bytes]:
        """Ids of each text as little-endian unsigned 32-bit bytes."""
        plain = [_PLAIN.fullmatch(t) is not None and "<|" not in t for t in texts]
        own = iter(self._plain([t for t, p in zip(texts, plain, strict=True) if p]))
        rest = iter(self._whole([t for t, p in zip(texts, plain, strict=True) if not p]))
        return [next(own) if p else next(rest).astype("<u4").tobytes() for p in plain]


def _piece_rows(vocabulary: str, window: int, closing: int):
    end = np.array([closing], "<u4").tobytes()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        ids_of = Ids(vocabulary)
        for part in slices(batches, size=SLICE):
            owner, rows = [], []
            for i, ids in enumerate(ids_of(texts_of(part))):
                ids += end
                total = len(ids) // 4
                for start in range(0, total, window):
                    cut = ids[4 * start:4 * (start + window)]
                    owner.append(i)
                    rows.append((start, len(cut) // 4, zlib.crc32(cut), total))
            start, length, crc, total = zip(*rows, strict=True)
            yield pa.RecordBatch.from_arrays(
                [column(part, "doc_id").take(pa.array(owner)), pa.array(start, pa.int64()),
                 pa.array(length, pa.int64()), pa.array(crc, pa.int64()),
                 pa.array(total, pa.int64())],
                names=["doc_id", "start", "length", "ids_crc32", "doc_tokens"])
        ids_of = None
        give_back()
    return run


def pieces(docs: DataFrame, vocabulary: str, window: int = WINDOW,
           closing: int = CLOSING) -> DataFrame:
    """doc_id, start, length, ids_crc32, doc_tokens: each document's ids, cut at the window."""
    kind = docs.schema["doc_id"].dataType.simpleString()
    return docs.select("doc_id", "text").mapInArrow(
        _piece_rows(vocabulary, window, closing),
        f"doc_id {kind}, start long, length long, ids_crc32 long, doc_tokens long")


def combinations(units: int, depth: int = DEPTH) -> list[tuple[int, ...]]:
    """All ways to fill ``units`` with at most ``depth`` classes, largest first."""
    out = [(units,)]
    for n in range(2, depth + 1):
        for some in combinations_with_replacement(range(1, units), n - 1):
            last = units - sum(some)
            if last >= some[-1]:
                out.append((last, *some[::-1]))
    return out


def nonnegative_least_squares(a: np.ndarray, b: np.ndarray, rounds: int = 1000) -> np.ndarray:
    """x >= 0 that makes a @ x nearest to b (active set method of Lawson and Hanson)."""
    x, free = np.zeros(a.shape[1]), np.zeros(a.shape[1], bool)
    norm, scale = np.linalg.norm(a, axis=0), max(1.0, float(np.abs(b).max()))
    tried = np.zeros(a.shape[1], bool)
    for _ in range(rounds):
        gain = np.where(free | tried, -np.inf, a.T @ (b - a @ x) / norm)
        best = int(gain.argmax())
        if gain[best] <= 1e-9 * scale:
            break
        free[best] = True
        while True:
            z = np.zeros_like(x)
            some = a[:, free]
            z[free] = np.linalg.solve(some.T @ some + 1e-9 * np.eye(some.shape[1]), some.T @ b)
            low = free & (z <= 1e-12 * scale)
            if not low.any():
                break
            if low[best] and x[best] == 0:  # rounding made it look useful
                free[best], tried[best] = False, True
                z = x
                break
            share = (x[low] / np.maximum(x[low] - z[low], 1e-300)).min()
            x = x + share * (z - x)
            free &= x > 1e-12 * scale
            x[~free] = 0
        if z is not x:
            tried[:] = False
        x = z
    return x


def plan(histogram: np.ndarray, depth: int = DEPTH) -> list[tuple[tuple[int, ...], int]]:
    """(classes, times): combinations that use up the histogram.

    ``histogram[u]`` counts the pieces of u units, its last entry being the full window.
    """
    units, left = len(histogram) - 1, histogram.astype(np.int64).copy()
    out = [((units,), int(left[units]))] if left[units] else []
    left[units] = 0
    ways = combinations(units, depth)[1:]
    if left.any() and ways:
        a = np.zeros((units + 1, len(ways)))
        for j, way in enumerate(ways):
            np.add.at(a[:, j], list(way), 1)
        times = np.floor(nonnegative_least_squares(a, left.astype(float)) + 1e-6).astype(np.int64)
        for j in np.argsort(-times, kind="stable"):
            used = a[:, j].astype(np.int64)
            n = int(min(times[j], (left[used > 0] // used[used > 0]).min()))
            if n > 0:
                out.append((ways[j], n))
                left -= n * used
    while left.any():
        way, room = [], units
        for u in range(units, 0, -1):
            if left[u] and u <= room:
                fits = int(min(left[u], room // u))
                way += [u] * fits
                room -= fits * u
        used = np.bincount(way, minlength=units + 1)
        n = int((left[used > 0] // used[used > 0]).min())
        out.append((tuple(way), n))
        left -= n * used
    return out


def slots(found: list[tuple[tuple[int, ...], int]], units: int):
    """For each class: where runs of its piece numbers begin, the first sequence of each run,
    and the place of the piece in its sequence."""
    out = [([], [], []) for _ in range(units + 1)]
    taken, sequence = [0] * (units + 1), 0
    for way, times in found:
        for place, u in enumerate(way):
            out[u][0].append(taken[u])
            out[u][1].append(sequence)
            out[u][2].append(place)
            taken[u] += times
        sequence += times
    return [tuple(np.array(x, np.int64) for x in three) for three in out]


def _seat_rows(runs):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            unit, number = (column(batch, c).to_numpy() for c in ("_unit", "_number"))
            sequence, place = np.zeros(len(unit), np.int64), np.zeros(len(unit), np.int64)
            for u in np.unique(unit):
                here = unit == u
                first, base, where = runs[u]
                at = np.searchsorted(first, number[here], "right") - 1
                sequence[here] = base[at] + number[here] - first[at]
                place[here] = where[at]
            keep = [c for c in batch.schema.names if not c.startswith("_")]
            yield pa.RecordBatch.from_arrays(
                [column(batch, c) for c in keep] + [pa.array(sequence), pa.array(place)],
                names=[*keep, "sequence_id", "_place"])
    return run


def pack(docs: DataFrame, vocabulary: str, window: int = WINDOW, step: int = STEP,
         depth: int = DEPTH, closing: int = CLOSING) -> DataFrame:
    """One row per piece: doc_id, start, length, ids_crc32, doc_tokens, sequence_id, offset."""
    cut = Scratch(docs.select("doc_id"), "packing").keep(
        pieces(docs, vocabulary, window, closing), "pieces")
    units = -(-window // step)
    unit = F.ceil(F.col("length") / step).cast("int")
    own = ["length", "start", "ids_crc32", "doc_tokens"]
    rows = cut.withColumn("_unit", unit).withColumn(
        "_slice", F.pmod(F.xxhash64("doc_id", *own), F.lit(SLICES)).cast("int"))
    counts = rows.groupBy("_unit", "_slice").agg(F.count("*").alias("n"))
    # At most (window / step) * SLICES rows.
    got = np.array([tuple(r) for r in counts.collect()], np.int64).reshape(-1, 3)
    table = np.zeros((units + 1, SLICES), np.int64)
    table[got[:, 0], got[:, 1]] = got[:, 2]
    runs = slots(plan(table.sum(1), depth), units)
    before = np.cumsum(table, 1) - table
    starts = docs.sparkSession.createDataFrame(
        [(int(u), int(s), int(before[u, s])) for u, s in got[:, :2]] or [(0, 0, 0)],
        "_unit int, _slice int, _before long")
    equal = rows.groupBy("_unit", "_slice", "doc_id", *own).agg(F.count("*").alias("_n"))
    earlier = (Window.partitionBy("_unit", "_slice").orderBy("doc_id", *own)
               .rowsBetween(Window.unboundedPreceding, -1))
    first = F.col("_before") + F.coalesce(F.sum("_n").over(earlier), F.lit(0))
    numbered = (equal.join(F.broadcast(starts), ["_unit", "_slice"]).withColumn("_number", first)
                .withColumn("_run", F.explode(F.expr(f"sequence(0L, _n - 1, {RUN}L)")))
                .repartition("_unit", "_number", "_run")
                .withColumn("_copy", F.explode(F.expr(f"sequence(_run, least(_run + {RUN}, _n) - 1)")))
                .select("_unit", (F.col("_number") + F.col("_copy")).alias("_number"), *cut.columns))
    kind = cut.schema["doc_id"].dataType.simpleString()
    seated = numbered.mapInArrow(
        _seat_rows(runs), f"doc_id {kind}, start long, length long, ids_crc32 long, "
                          "doc_tokens long, sequence_id long, _place long")
    earlier = (Window.partitionBy("sequence_id").orderBy("_place")
               .rowsBetween(Window.unboundedPreceding, -1))
    return seated.withColumn("offset", F.coalesce(F.sum("length").over(earlier), F.lit(0))
                             .cast("long")).drop("_place")

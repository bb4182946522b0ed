"""Importance resampling towards a target distribution of word n-grams.

Features are the runs of 1 to ``longest`` words of a text, hashed into ``BUCKETS`` buckets. A
bucket's gain is the logarithm of how much likelier the target has it than the corpus; a
document's weight is the sum of its gains, and with seeded Gumbel noise the highest scores are a
draw without replacement in proportion to the weights.

Newlines are separators, so texts are cut into lines and no word lies across two:

* tasks count the distinct lines they meet, one shuffle adds these counts up, and each distinct
  line's features are counted once and multiplied by its occurrences;
* runs across lines (none if ``longest`` is 1) belong to no line; tasks count them by bucket, and
  they are added separately;
* a document's weight is the sum over its lines, which a task weighs once while it remembers
  them, and over its runs across lines.

A common line is one row per task before the shuffle. Counts of buckets (``BUCKETS`` numbers) are all
that reaches the driver. Scores are settled, then ranked by a range sort, not in one task.

Defined results: a null text has no words; n_features and weight are 0 then. Repeated rows are
documents of their own with equal scores; a null doc_id is drawn as the empty text and loses
ties. Ranks follow (score, doc_id); rows that tie in both are in any order. An empty corpus gives
no rows, an empty target only smoothed counts. Other columns are ignored. A line is a row of
the shuffle, so the longest line must fit into a task, as must its text.
"""

import hashlib
import math
import zlib
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from orderloom.llm.common import Memo, Scratch, column, slices, words_of
from orderloom.operators.picking import positions

BUCKETS = 10_000
LONGEST = 1
FEWEST_WORDS = 20
PERCENT = 10
SEED = 2024

#: Lines a task counts or remembers, and the bytes of those it remembers.
LINES, LINE_BYTES = 50_000, 2_000

#: Bytes between words, and A to Z as a to z; bytes of longer characters are word bytes.
SEPARATOR = np.array([not (0x30 <= b <= 0x39 or 0x41 <= b <= 0x5A or 0x61 <= b <= 0x7A or b >= 0x80)
                      for b in range(256)])
FOLDED = np.array([b + 32 if 0x41 <= b <= 0x5A else b for b in range(256)], np.uint8)
_KEPT = bytes(0x20 if s else f for s, f in zip(SEPARATOR.tolist(), FOLDED.tolist(), strict=True))


def line_words(line: bytes) -> list[bytes]:
    """The words of a line (or of a whole text), A to Z in lower case."""
    return line.translate(_KEPT).split()


def buckets_of(runs, buckets: int) -> np.ndarray:
    return np.array([zlib.crc32(r) % buckets for r in runs], np.int64)


def runs_within(words: list[bytes], longest: int) -> list[bytes]:
    """The runs of 1 to ``longest`` words of one line."""
    out = list(words)
    for n in range(2, longest + 1):
        out += [b" ".join(words[i:i + n]) for i in range(len(words) - n + 1)]
    return out


def runs_across(lines: list[list[bytes]], longest: int) -> Iterator[bytes]:
    """The runs of 2 to ``longest`` words that lie in more than one line."""
    words = [w for line in lines for w in line]
    line_of = [i for i, line in enumerate(lines) for _ in line]
    for n in range(2, longest + 1):
        for i in range(len(words) - n + 1):
            if line_of[i] != line_of[i + n - 1]:
                yield b" ".join(words[i:i + n])


def _texts(part) -> list[bytes]:
    return [x or b"" for x in column(part, "text").cast(pa.binary()).to_pylist()]


def _line_rows(longest: int, buckets: int):
    """Rows (line, null, n) of distinct lines, and (null, bucket, n) of runs across lines."""
    def batch(lines: Counter, across: np.ndarray) -> pa.RecordBatch:
        at = np.flatnonzero(across)
        return pa.RecordBatch.from_arrays(
            [pa.array([*lines, *[None] * len(at)], pa.binary()),
             pa.array([*[None] * len(lines), *at.tolist()], pa.int32()),
             pa.array([*lines.values(), *across[at].tolist()], pa.int64())], names=["line", "bucket", "n"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        lines, across, held = Counter(), np.zeros(buckets, np.int64), 0
        for part in slices(batches):
            for text in _texts(part):
                cut = text.split(b"\n")
                lines.update(cut)
                if longest > 1:
                    own = buckets_of(runs_across([line_words(x) for x in cut], longest), buckets)
                    across += np.bincount(own, minlength=buckets)
                held += len(text)
            if len(lines) > LINES or held > 8_000_000:
                yield batch(lines, across)
                lines, across, held = Counter(), np.zeros(buckets, np.int64), 0
        yield batch(lines, across)
    return run


def _bucket_rows(longest: int, buckets: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(buckets, np.int64)
        for part in slices(batches, "line"):
            lines, other, n = (column(part, c) for c in ("line", "bucket", "n"))
            n = n.to_numpy()
            if longest == 1:  # all words of a slice in one go
                words = words_of(part, "line", SEPARATOR, FOLDED)
                raw = words.data.tobytes()
                own = buckets_of([raw[a:b] for a, b in zip(words.first.tolist(), words.last.tolist(),
                                                           strict=True)], buckets)
                times = np.repeat(n, np.diff(words.ends))
            else:
                found = [buckets_of(runs_within(line_words(x or b""), longest), buckets)
                         for x in lines.to_pylist()]
                own, times = np.concatenate(found), np.repeat(n, [len(f) for f in found])
            total += np.bincount(own, times, buckets).astype(np.int64)
            across = other.is_valid().to_numpy(zero_copy_only=False)
            total += np.bincount(other.drop_null().to_numpy(), n[across], buckets).astype(np.int64)
        at = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(at, pa.int32()), pa.array(total[at])],
                                         names=["bucket", "n"])
    return run


def bucket_counts(texts: DataFrame, longest: int = LONGEST, buckets: int = BUCKETS) -> np.ndarray:
    """How many features of the texts fall into each bucket."""
    lines = (texts.select("text").mapInArrow(_line_rows(longest, buckets), "line binary, bucket int, n long")
             .groupBy("line", "bucket").agg(F.sum("n").alias("n")))
    found = (lines.mapInArrow(_bucket_rows(longest, buckets), "bucket int, n long")
             .groupBy("bucket").agg(F.sum("n").alias("n")).collect())
    out = np.zeros(buckets, np.int64)
    for r in found:
        out[r.bucket] = r.n
    return out


def gains(corpus: np.ndarray, target: np.ndarray) -> np.ndarray:
    """Thousandths of the logarithm of each bucket's smoothed share in the target over the corpus's."""
    s_all, t_all, k = int(corpus.sum()), int(target.sum()), len(corpus)
    return np.array([math.floor(1000 * math.log((t + 1) * (s_all + k) / ((s + 1) * (t_all + k))))
                     for s, t in zip(corpus.tolist(), target.tolist(), strict=True)], np.int64)


def noise(doc_id, seed: int = SEED) -> int:
    """Thousandths of a Gumbel variate, from the seed and the id alone."""
    text = f"{seed}:{'' if doc_id is None else doc_id}"
    h = int(hashlib.sha256(text.encode()).hexdigest()[:8], 16)
    return math.floor(-1000 * math.log(-math.log((h + 0.5) / 4294967296)))


def _weight_rows(gain: np.ndarray, longest: int, seed: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        gained = gain.tolist()
        weigh = lambda runs: sum([gained[zlib.crc32(r) % len(gained)] for r in runs])

        def line_values(line: bytes) -> tuple[int, int, int]:
            words = line_words(line)
            runs = runs_within(words, longest)
            return len(words), len(runs), weigh(runs)

        memo = Memo(line_values, LINES // 10)
        for part in slices(batches):
            rows, docs = [], column(part, "doc_id")
            for text in _texts(part):
                cut = text.split(b"\n")
                found = [memo[x] if len(x) <= LINE_BYTES else line_values(x) for x in cut]
                words, features, weight = map(sum, zip(*found, strict=True))
                if longest > 1:
                    across = list(runs_across([line_words(x) for x in cut], longest))
                    features, weight = features + len(across), weight + weigh(across)
                rows.append((words, features, weight))
            words, features, weight = np.array(rows, np.int64).reshape(-1, 3).T
            score = weight + np.array([noise(d, seed) for d in docs.to_pylist()], np.int64)
            yield pa.RecordBatch.from_arrays([docs, *map(pa.array, (words, features, weight, score))],
                                             names=["doc_id", "n_words", "n_features", "weight", "score"])
    return run


def resample(docs: DataFrame, target: DataFrame, longest: int = LONGEST, buckets: int = BUCKETS,
             percent: int = PERCENT, seed: int = SEED) -> DataFrame:
    """doc_id, n_words, n_features, weight, score of every document, and its rank if it is drawn."""
    gain = gains(bucket_counts(docs, longest, buckets), bucket_counts(target, longest, buckets))
    kind = docs.schema["doc_id"].dataType.simpleString()
    scratch = Scratch(docs, "resampling")
    scored = scratch.keep(docs.select("doc_id", "text").mapInArrow(
        _weight_rows(gain, longest, seed),
        f"doc_id {kind}, n_words long, n_features long, weight long, score long"), "scores")
    fit = F.col("n_words") >= FEWEST_WORDS
    drawn = scored.where(fit).count() * percent // 100
    placed = positions(scored.where(fit), [F.desc("score"), F.asc_nulls_last("doc_id")], "place")
    rank = F.when(F.col("place") < drawn, F.col("place") + 1).cast("long").alias("rank")
    rest = scored.where(~fit).withColumn("place", F.lit(None).cast("long"))
    return placed.unionByName(rest).select("doc_id", "n_words", "n_features", "weight", "score", rank)


def resampled(docs: DataFrame, target: DataFrame, **options) -> DataFrame:
    """The ids of the drawn documents with their ranks."""
    return resample(docs, target, **options).where("rank is not null").select("doc_id", "rank")

"""Helpers the operators share: words, hashes over word sequences, text batches, scratch tables."""

import contextlib
import ctypes
import hashlib
import re
import sys
from typing import NamedTuple

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession, functions as F

from orderloom.session import new_folder

#: A word: a run without space, tab, line feed, vertical tab, form feed, carriage return.
WORD = re.compile(r"[^\x20\x09-\x0D]+")
WORD_SQL = r"[^\x20\x09-\x0D]+"

#: Fixed odd multiplier of the rolling hashes over a few words.
BASE = 0x9E3779B97F4A7C15
U64 = np.uint64
SHUFFLE_CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


class Scratch:
    """Tables an operator writes to the shared folder and reads back.

    What follows no longer depends on recomputing what came before, so a lost executor costs
    little. The shuffle files of a table are freed when it is written, and a table that is
    no longer needed is dropped, so the disk holds one step at a time. Tables have at most a
    file for every ``ROWS_A_FILE`` rows of the operator's input, or one for every core: their
    number follows the input and not how finely a join was split.
    """

    ROWS_A_FILE = 8_000

    def __init__(self, source: DataFrame, purpose: str):
        self.spark = source.sparkSession
        self.folder = new_folder(self.spark, purpose)
        self.files = max(self.spark.sparkContext.defaultParallelism,
                         -(-source.count() // self.ROWS_A_FILE))

    def few(self, df: DataFrame) -> DataFrame:
        """The rows in no more tasks than the table would have files."""
        return df.coalesce(self.files)

    def keep(self, df: DataFrame, name: str) -> DataFrame:
        path, before = f"{self.folder}/{name}", self.spark.conf.get(SHUFFLE_CLEANUP, "false")
        self.spark.conf.set(SHUFFLE_CLEANUP, "true")
        try:
            self.few(df).write.parquet(path)
        finally:
            self.spark.conf.set(SHUFFLE_CLEANUP, before)
        return self.spark.read.schema(df.schema).parquet(path)

    def drop(self, *names: str) -> None:
        jvm, conf = self.spark._jvm, self.spark._jsc.hadoopConfiguration()
        for name in names:
            path = jvm.org.apache.hadoop.fs.Path(f"{self.folder}/{name}")
            path.getFileSystem(conf).delete(path, True)


class Memo(dict):
    """A dictionary that makes what is missing and never holds more than ``most`` entries."""

    def __init__(self, make, most: int = 300_000):
        super().__init__()
        self.make, self.most = make, most

    def __missing__(self, key):
        if len(self) >= self.most:
            self.clear()
        value = self[key] = self.make(key)
        return value


_KEPT: dict[tuple, object] = {}


def kept(key: tuple, make):
    """An object that a task makes once. (This module travels by value, so that every task
    has a ``_KEPT`` of its own.)"""
    if key not in _KEPT:
        _KEPT[key] = make()
    return _KEPT[key]


def kept_over_tasks(key: tuple, make):
    """An object that a worker process makes once and keeps over its tasks. It lies outside this
    module and must not grow, as it is there until the process ends."""
    held = sys.__dict__.setdefault("_orderloom_kept", {})
    if key not in held:
        held[key] = make()
    return held[key]


def slices(batches, text: str = "text", size: int = 2_000_000):
    """Row ranges of Arrow batches with a bounded amount of text (one row at least), so
    that what a task holds does not depend on how many rows Spark puts into a batch. What
    was used is given back at the end, as worker processes outlive their tasks."""
    for batch in batches:
        lengths = pc.fill_null(pc.binary_length(column(batch, text)), 0).to_numpy(
            zero_copy_only=False)
        first = total = 0
        for i, n in enumerate(lengths.tolist()):
            if total + n > size and i > first:
                yield batch.slice(first, i - first)
                first, total = i, 0
            total += n
        if first < len(lengths):
            yield batch.slice(first)
    give_back()


def give_back() -> None:
    """Return memory that is no longer used to the system; worker processes outlive their tasks."""
    pa.default_memory_pool().release_unused()
    with contextlib.suppress(OSError, AttributeError):  # only the GNU library has it
        ctypes.CDLL(None).malloc_trim(0)


def column(batch, name: str):
    return batch.column(batch.schema.get_field_index(name))


def texts_of(batch, name: str = "text") -> list[str]:
    """The texts; a null one is empty."""
    return [x or "" for x in column(batch, name).to_pylist()]


def text_bytes(batch, name: str = "text") -> tuple[np.ndarray, np.ndarray]:
    """UTF-8 bytes of all texts in one array, and where each text begins (n + 1)."""
    values = pc.fill_null(column(batch, name), "")
    kind = np.int64 if pa.types.is_large_string(values.type) else np.int32
    _, places, data = values.buffers()
    places = np.frombuffer(places, kind)[values.offset:values.offset + len(values) + 1]
    data = np.frombuffer(data, np.uint8) if data is not None else np.zeros(0, np.uint8)
    return data[places[0]:places[-1]], (places - places[0]).astype(np.int64)


class Words(NamedTuple):
    """Words of a batch of texts: word i is data[first[i]:last[i]], text t has the words
    ends[t] to ends[t + 1]."""
    data: np.ndarray
    places: np.ndarray
    first: np.ndarray
    last: np.ndarray
    ends: np.ndarray

    def owners(self) -> np.ndarray:
        return np.repeat(np.arange(len(self.ends) - 1), np.diff(self.ends))


#: Word separators; no byte of a longer UTF-8 sequence is one of them.
_SPACE = np.isin(np.arange(256), [0x20, *range(0x09, 0x0E)])


def words_of(batch, name: str = "text", separator: np.ndarray = _SPACE,
             folded: np.ndarray | None = None) -> Words:
    """Words between bytes marked in ``separator``, bytes replaced by ``folded`` before."""
    data, places = text_bytes(batch, name)
    if folded is not None:
        data = folded[data]
    edge = np.zeros(len(data) + 1, bool)
    edge[places] = True
    space = separator[data]
    first = np.flatnonzero(~space & (np.r_[True, space][:-1] | edge[:-1]))
    last = np.flatnonzero(~space & (np.r_[space, True][1:] | edge[1:])) + 1
    return Words(data, places, first, last, np.searchsorted(first, places))


#: A word of more bytes than this is hashed by digest, a shorter one is its own number.
_PACKED = 7


def word_hashes(words: Words) -> np.ndarray:
    """A 64-bit hash of each word's bytes, the first of ``word_hash_pairs``."""
    return word_hash_pairs(words)[:, 0]


def word_hash_pairs(words: Words) -> np.ndarray:
    """Two 64-bit hashes (n, 2) of each word's bytes.

    Up to seven bytes and their number are one 64-bit number, spread by bijections, so
    such words never agree; of longer words the two are halves of a keyed cryptographic
    digest, remembered for words that come again.
    """
    size = words.last - words.first
    out = np.empty((len(size), 2), U64)
    short = size <= _PACKED
    eight = np.lib.stride_tricks.sliding_window_view(np.r_[words.data, np.zeros(8, np.uint8)], 8)
    packed = np.ascontiguousarray(eight[words.first[short]]).view("<u8")[:, 0]
    bits = (8 * size[short]).astype(U64)
    packed = packed & ((U64(1) << bits) - U64(1)) | (bits << U64(53))
    out[short] = np.stack([mix(packed), mix(packed ^ U64(BASE))], 1)
    data, memo = words.data.tobytes(), kept(("digests",), lambda: Memo(_digest_of, 30_000))
    first, last = words.first[~short].tolist(), words.last[~short].tolist()
    found = b"".join([memo[data[a:b]] if b - a <= 40 else _digest_of(data[a:b])
                      for a, b in zip(first, last, strict=True)])
    out[~short] = np.frombuffer(found, "<u8").reshape(-1, 2)
    return out


def _digest_of(word: bytes) -> bytes:
    return hashlib.blake2b(word, digest_size=16, key=b"word").digest()


def powers(base: int, n: int) -> np.ndarray:
    """base**0 .. base**(n - 1) modulo 2**64."""
    out = np.full(n, U64(base))
    out[:1] = 1
    return np.multiply.accumulate(out)


def mix(x: np.ndarray) -> np.ndarray:
    """Spread every input bit over the result (the public splitmix64 finaliser)."""
    x = (x ^ (x >> U64(30))) * U64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> U64(27))) * U64(0x94D049BB133111EB)
    return x ^ (x >> U64(31))


def gram_hashes(h: np.ndarray, n: int, base: int = BASE) -> np.ndarray:
    """Rolling polynomial hash of every n consecutive entries, by doubling."""
    if len(h) < n:
        return h[:0]
    power = lambda k: U64(pow(base, k, 1 << 64))
    done, covered, part, width = None, 0, h, 1
    while True:
        if n & width:
            if done is None:
                done, covered = part, width
            else:
                size = len(h) - covered - width + 1
                done = done[:size] * power(width) + part[covered:covered + size]
                covered += width
        if covered == n:
            return done
        part = part[:-width] * power(width) + part[width:]
        width *= 2


def gram_valid(ends: np.ndarray, n: int) -> np.ndarray:
    """Which of the flat positions start n entries of one text."""
    total = int(ends[-1])
    if total < n:
        return np.zeros(0, bool)
    owner_end = np.repeat(ends[1:], np.diff(ends))
    return owner_end[:total - n + 1] - np.arange(total - n + 1) >= n


def signed(x: np.ndarray) -> np.ndarray:
    return x.view(np.int64)


def size_of(text) -> F.Column:
    """Number of words of a text column, 0 for null; runs in the JVM."""
    text = F.coalesce(text, F.lit(""))
    return F.regexp_count(text, F.lit(WORD_SQL)).cast("long")


def from_parquet(spark, sf_dir: str, table: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{table}.parquet")

"""Token counts without token ids: pieces per distinct pre-token, times its frequencies.

A byte-level tokenizer cuts a text into pre-tokens and each of them, on its own, into pieces.
So a text's count is the sum over its distinct pre-tokens of frequency times pieces:

* ``pieces``: every distinct pre-token of the corpus is tokenized once.
* ``postings``: texts are read in blocks; for each distinct pre-token of a block one row
  holds how often each text of the block has it. Pre-tokens that are one piece (a table no
  larger than the vocabulary) are summed at once and need no row.
* one join brings the pieces to the postings; each task sums what it sees of a block, and
  one sum per block adds that up.

A pre-token that all texts share has one row per block, and the join splits hot keys. The
texts are cut twice, which costs less than storing the frequencies for a second use.

Defined results: a null text is empty and has no tokens; special strings in a text count as
the one token they stand for; repeated rows are counted separately; a null doc_id stays null.
"""

import json
import re
from collections.abc import Iterator
from functools import cached_property

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame, functions as F

from orderloom.llm.common import column, give_back, kept, kept_over_tasks, slices, texts_of

LIMIT = 512
BLOCK_TEXTS = 16_384
BLOCK_WORDS = 500_000
BLOCK_ENTRIES = 20_000_000

#: Up to U+024F: letters, numbers and white space, as the byte-level tokenizer's pattern means
#: them. Its pattern (fixed and public) with these classes cuts texts of such characters;
#: other texts are cut by the library itself, whose Unicode version then decides.
_L = "A-Za-z\xaa\xb5\xba\xc0-\xd6\xd8-\xf6\xf8-\u024f"
_N = "0-9\xb2\xb3\xb9\xbc-\xbe"
_S = "\t-\r \x85\xa0"
LATIN = re.compile("[\0-\u024f]*")
PATTERN = re.compile(f"'s|'t|'re|'ve|'m|'ll|'d| ?[{_L}]+| ?[{_N}]+| ?[^{_S}{_L}{_N}]+"
                     f"|[{_S}]+(?![^{_S}])|[{_S}]+")


class Pieces:
    """Pre-tokens of texts, and their numbers of pieces."""

    def __init__(self, vocabulary: str):
        self.vocabulary = vocabulary
        with open(vocabulary, encoding="utf-8") as f:
            special = [t["content"] for t in json.load(f)["added_tokens"]]
        special.sort(key=len, reverse=True)
        self.special = re.compile("|".join(map(re.escape, special)) or r"(?!)")

    @cached_property
    def tokenizer(self):
        return kept_over_tasks(("piece counts", self.vocabulary), self._load)

    def _load(self):
        """The library's tokenizer. Each pre-token is counted once, so its cache finds little;
        the cache's memory, one for each thread, outlives the tokenizer."""
        from tokenizers import Tokenizer
        found = Tokenizer.from_file(self.vocabulary)
        found.model._resize_cache(0)
        return found

    def find(self, text: str) -> list[str]:
        if LATIN.fullmatch(text):
            return PATTERN.findall(text)
        return [text[a:b] for _, (a, b) in self.tokenizer.pre_tokenizer.pre_tokenize_str(text)]

    def counts(self, pre_tokens: list[str]) -> list[int]:
        return [len(x.ids) for x in
                self.tokenizer.encode_batch_fast(pre_tokens, add_special_tokens=False)]

    def single(self) -> frozenset[str]:
        """Pre-tokens that are one piece: at most one per vocabulary entry."""
        own = [self.tokenizer.decode([i]) for i in range(self.tokenizer.get_vocab_size(False))]
        own = [w for w in own if "\ufffd" not in w and self.find(w) == [w]]
        return frozenset(w for w, n in zip(own, self.counts(own), strict=True) if n == 1)

    def cut(self, text: str) -> tuple[list[str], int]:
        """The pre-tokens of a text, and how many special strings it has."""
        if not self.special.search(text):
            return self.find(text), 0
        parts = self.special.split(text)
        return [w for p in parts for w in self.find(p)], len(parts) - 1


def pieces_of(vocabulary: str) -> Pieces:
    return kept(("pieces", vocabulary), lambda: Pieces(vocabulary))


def _distinct_rows(vocabulary: str, single: frozenset[str], most: int = BLOCK_WORDS):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pieces, seen = pieces_of(vocabulary), set()
        for part in slices(batches):
            for text in texts_of(part):
                seen.update(pieces.cut(text)[0])
            if len(seen) > most:
                yield pa.RecordBatch.from_arrays([pa.array(list(seen - single), pa.string())],
                                                 names=["pre_token"])
                seen = set()
        yield pa.RecordBatch.from_arrays([pa.array(list(seen - single), pa.string())],
                                         names=["pre_token"])
        seen = None
        give_back()
    return run


def pieces(docs: DataFrame, vocabulary: str, single: frozenset[str]) -> DataFrame:
    """(pre_token, pieces) for each distinct pre-token of several pieces."""
    found = docs.select("text").mapInArrow(_distinct_rows(vocabulary, single), "pre_token string")
    return found.distinct().withColumn("pieces", piece_counts(vocabulary)("pre_token"))


#: A text of a block (at most BLOCK_TEXTS), as often as it has the pre-token, which takes less
#: than a number for each; and a text with a sum of pieces.
POSTING = np.dtype("<u2")
PARTIAL = np.dtype([("text", "<u2"), ("n", "<u4")])


class _Block:
    """Distinct pre-tokens of some texts and their frequencies."""

    def __init__(self):
        self.number, self.owners, self.found, self.head = {}, [], [], []
        self.entries = 0

    def add(self, doc, n_bytes: int, words: list[str], base: int, single: frozenset[str]):
        several = [w for w in words if w not in single]
        number, text = self.number, len(self.head)
        self.head.append((doc, n_bytes, base + len(words) - len(several)))
        own = [number.setdefault(w, len(number)) for w in several]
        self.found.append(np.array(own, np.int32))
        self.owners.append(np.full(len(own), text, np.int32))
        self.entries += len(own)

    def full(self) -> bool:
        return (len(self.head) >= BLOCK_TEXTS or len(self.number) >= BLOCK_WORDS
                or self.entries >= BLOCK_ENTRIES)

    def batch(self, block: int, kind: pa.DataType) -> pa.RecordBatch:
        """One row per pre-token with its postings, one per text with what it has already.

        Texts get a key of their own in place of a pre-token (no pre-token mixes digits with
        other characters), so that both go through the same join, evenly dealt.
        """
        key = np.sort((np.concatenate(self.found).astype(np.int64) << 32)
                      + np.concatenate(self.owners))
        places = (np.searchsorted(key >> 32, np.arange(len(self.number) + 1))
                  * POSTING.itemsize).astype(np.int32)
        entries = (key & 0xFFFFFFFF).astype(POSTING)
        words, texts = len(self.number), len(self.head)
        docs, sizes, base = zip(*self.head, strict=True)
        postings = pa.Array.from_buffers(
            pa.binary(), words, [None, pa.py_buffer(places), pa.py_buffer(entries.tobytes())])
        nothing = lambda k, t: pa.nulls(k, t)
        head = pa.StructArray.from_arrays(
            [pa.array(range(texts), pa.int32()), pa.array(docs, kind),
             pa.array(sizes, pa.int64()), pa.array(base, pa.int64())],
            names=["text_number", "doc_id", "n_bytes", "base"])
        return pa.RecordBatch.from_arrays(
            [pa.array(np.full(words + texts, block)),
             pa.concat_arrays([pa.array(list(self.number), pa.string()),
                               pa.array([f"#{block}:{i}" for i in range(texts)], pa.string())]),
             pa.concat_arrays([postings, nothing(texts, pa.binary())]),
             pa.concat_arrays([nothing(words, head.type), head])],
            names=["block", "pre_token", "postings", "head"])


def _posting_rows(vocabulary: str, single: frozenset[str]):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pieces, number = pieces_of(vocabulary), TaskContext.get().partitionId() << 32
        block, kind = _Block(), pa.null()
        for part in slices(batches):
            docs, kind = column(part, "doc_id").to_pylist(), column(part, "doc_id").type
            for doc, text in zip(docs, texts_of(part), strict=True):
                block.add(doc, len(text.encode("utf-8")), *pieces.cut(text), single)
                if block.full():
                    yield block.batch(number, kind)
                    block, number = _Block(), number + 1
        if block.head:
            yield block.batch(number, kind)
        block = None
        give_back()
    return run


def postings(docs: DataFrame, vocabulary: str, single: frozenset[str]) -> DataFrame:
    kind = docs.schema["doc_id"].dataType.simpleString()
    return docs.select("doc_id", "text").mapInArrow(
        _posting_rows(vocabulary, single), "block long, pre_token string, postings binary, "
        f"head struct<text_number:int,doc_id:{kind},n_bytes:bigint,base:bigint>")


def piece_counts(vocabulary: str):
    @F.pandas_udf("int")
    def run(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        pieces = pieces_of(vocabulary)
        for words in batches:
            yield pd.Series(pieces.counts(list(words)), dtype="int32")
        give_back()
    return run


class _Sums:
    """Running sums of pieces of the texts of some blocks."""

    def __init__(self):
        self.blocks: dict[int, np.ndarray] = {}

    def add(self, blocks: np.ndarray, postings: list[bytes], pieces: np.ndarray):
        sizes = np.array([len(p) for p in postings]) // POSTING.itemsize
        texts = np.frombuffer(b"".join(postings), POSTING)
        each = np.repeat(pieces, sizes).astype(np.float64)
        owner = np.repeat(blocks, sizes)
        for block in np.unique(blocks).tolist():
            here = owner == block
            got = np.bincount(texts[here], each[here]).astype(np.int64)
            old = self.blocks.get(block, got[:0])
            if len(old) < len(got):
                old, got = got, old
            old[:len(got)] += got
            self.blocks[block] = old

    def entries(self) -> int:
        return sum(map(len, self.blocks.values()))

    def rows(self) -> Iterator[tuple[int, bytes]]:
        for block, sums in self.blocks.items():
            out = np.empty(np.count_nonzero(sums), PARTIAL)
            out["text"], out["n"] = np.flatnonzero(sums), sums[sums > 0]
            yield block, out.tobytes()


def _partial_rows(most: int = 2_000_000):
    """Postings times pieces, summed per block as far as a task sees it; other rows as they
    are. Sums are sent on whenever they fill ``most`` entries."""
    def sent(sums: _Sums, like: pa.RecordBatch) -> pa.RecordBatch:
        blocks, packed = zip(*sums.rows(), strict=True)
        columns = {"block": pa.array(blocks, pa.int64()), "sums": pa.array(packed, pa.binary())}
        return pa.RecordBatch.from_arrays(
            [columns.get(f.name, pa.nulls(len(blocks), f.type)) for f in like.schema],
            schema=like.schema)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums, heads = _Sums(), None
        for batch in batches:
            head = pc.is_valid(column(batch, "head"))
            body = batch.filter(pc.invert(head))
            heads = batch.filter(head).drop_columns(["postings", "pieces"])
            heads = heads.append_column("sums", pa.nulls(heads.num_rows, pa.binary()))
            if heads.num_rows:
                yield heads
            for at in range(0, body.num_rows, 20_000):
                some = body.slice(at, 20_000)
                sums.add(column(some, "block").to_numpy(), column(some, "postings").to_pylist(),
                         column(some, "pieces").to_numpy(zero_copy_only=False).astype(np.int64))
                if sums.entries() > most:
                    yield sent(sums, heads)
                    sums = _Sums()
        if sums.blocks:
            yield sent(sums, heads)
    return run


def _sum_block(rows: pa.Table) -> pa.Table:
    head = pa.Table.from_struct_array(rows.filter(pc.is_valid(rows["head"]))["head"])
    head = head.sort_by("text_number")
    total = np.array(head["base"].to_numpy())
    for packed in rows.filter(pc.is_valid(rows["sums"]))["sums"].to_pylist():
        part = np.frombuffer(packed, PARTIAL)
        total[part["text"]] += part["n"]
    return head.select(["doc_id", "n_bytes"]).append_column("n_tokens", pa.array(total, pa.int64()))


def token_counts(docs: DataFrame, vocabulary: str, limit: int = LIMIT) -> DataFrame:
    """doc_id, n_bytes, n_tokens, over_limit for every document."""
    kind = docs.schema["doc_id"].dataType.simpleString()
    single = Pieces(vocabulary).single()
    rows, known = postings(docs, vocabulary, single), pieces(docs, vocabulary, single)
    # With the length as a second key neither side lends the join its partitioning, so that
    # Spark can split a pre-token that all blocks have.
    same = ((rows["pre_token"] == known["pre_token"])
            & (F.length(rows["pre_token"]) == F.length(known["pre_token"])))
    head = f"struct<text_number:int,doc_id:{kind},n_bytes:bigint,base:bigint>"
    return (rows.join(known, same, "left").select("block", "postings", "head", "pieces")
            .mapInArrow(_partial_rows(), f"block long, head {head}, sums binary")
            .groupBy("block")
            .applyInArrow(_sum_block, f"doc_id {kind}, n_bytes long, n_tokens long")
            .withColumn("over_limit", F.col("n_tokens") > limit))

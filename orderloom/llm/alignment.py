"""Cross-tokenizer alignment: where the tokens of two tokenizers end at the same byte.

A byte-level tokenizer (A) and a piece tokenizer (B) encode the same text, a space and the
document. Their common token ends cut both sequences into groups; the two tokens that end a
group are linked, and a pair of ids is as strong as it has links in the whole corpus.

Token ends come from the libraries' own spans: character offsets of A, spans of the piece
messages of B. These are coarse where a token holds a part of a character (A gives all its tokens
the whole character, B gives all but the last of its byte pieces nothing); there the decoded
bytes of the tokens tell the ends.

Neither tokenizer has a token across a space that follows a character which is no white space,
nor across a letter and a mark such as a comma (looked up in the vocabulary of B; A's rule cuts
there). Texts are cut at these places, each distinct part is encoded and aligned once per worker
while it is remembered, and a text's groups are those of its parts. A text one of whose parts does not decode to itself is encoded whole.

Parts of texts are read once. A task writes blocks of whole texts to the shared folder: each
text's links as numbers of the distinct pairs of its block, and these pairs with their counts. The
pairs are summed over all blocks, the largest sum of each B id is found, and each block gets
back the sums of its own pairs only. No pair travels once per link or per text, and no table of
pairs is broadcast.

Defined results: texts that are null, empty, or do not decode to a space and themselves have no
tokens: zeros and an empty ``groups_sha256``; repeated rows count as often as they are there;
a null doc_id stays null; equal counts are all highest. Other columns are ignored. A task holds one
slice of texts (or one very long text) and one block (``BLOCK_LINKS``, or one such text).
"""

import hashlib
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame, functions as F

from orderloom.llm.common import Scratch, column, kept, slices
from orderloom.operators.picking import lookup_groups

BLOCK_LINKS = 1_000_000
REMEMBERED, REMEMBERED_CHARS, IN_A_ROW = 200_000, 48, 2000
B_BITS = 15

#: Marks that A cuts off a letter before them, as its rule says; B does where no piece has both.
MARKS = ",.;:!?"
LETTER = " a"
_LATIN = "A-Za-z\u00c0-\u00d6\u00d8-\u00f6\u00f8-\u024f"


def part_pattern(marks: str) -> re.Pattern:
    """Parts of a text: up to a space that follows a character that is no white space, or up to
    a mark that follows a Latin letter. (Python's white space is a little more than the
    tokenizers'; parts are only longer for it.)"""
    if not marks:
        return re.compile(r"\s*\S*(?:[^\S ]\s*\S*)*")
    m = re.escape(marks)
    body = rf"(?:[^\s{m}]+|(?<![{_LATIN}])[{m}])*"
    return re.compile(rf"(?:\s+|[{m}]?){body}(?:[^\S ]\s*{body})*")


_SPACE_PIECE = "▁"
_BYTE_PIECE = re.compile("<0x([0-9A-F]{2})>")


def byte_alphabet() -> dict[str, int]:
    """The public byte-level alphabet: printable bytes stand for themselves, the others for
    the characters from U+0100 on, in order."""
    own = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    rest = [b for b in range(256) if b not in own]
    return {chr(b): b for b in own} | {chr(0x100 + i): b for i, b in enumerate(rest)}


def token_ends(ends: np.ndarray, spans: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """Byte ends of a sequence of tokens.

    ``ends`` and ``spans`` are the coarse ends and lengths in bytes as the library gives them,
    ``sizes`` the numbers of decoded bytes. A token whose span is as long as its bytes ends where the
    span does; others (parts of characters) lie at their decoded bytes behind the last such.
    """
    decoded = np.cumsum(sizes)
    whole = spans == sizes
    last = np.maximum.accumulate(np.where(whole, np.arange(len(sizes)), -1))
    return decoded + np.where(last < 0, 0, (ends - decoded)[last])


#: Of a text or part: its links, each an unsigned 32-bit number A id * 2**B_BITS + B id; its groups
#: as text (or the digest of that); its numbers of A and of B tokens.
Found = tuple[bytes, bytes | str, int, int]


class Aligner:
    """Tokens of both tokenizers and their common ends, for texts with a space before them."""

    def __init__(self, byte_vocabulary: str, piece_model: str):
        import sentencepiece
        from tokenizers import Tokenizer, pre_tokenizers
        self.a = Tokenizer.from_file(byte_vocabulary)
        self.a.encode_special_tokens = True
        self.b = sentencepiece.SentencePieceProcessor(model_file=piece_model)
        alphabet = byte_alphabet()
        names = self.a.get_vocab(with_added_tokens=True)
        self.a_bytes = [b""] * (max(names.values()) + 1)
        for name, i in names.items():
            self.a_bytes[i] = bytes(alphabet[c] for c in name) if all(
                c in alphabet for c in name) else name.encode()
        pieces = [self.b.id_to_piece(i) for i in range(self.b.get_piece_size())]
        self.b_bytes = [bytes([int(_BYTE_PIECE.fullmatch(p)[1], 16)]) if self.b.is_byte(i)
                        else p.replace(_SPACE_PIECE, " ").encode() for i, p in enumerate(pieces)]
        self.a_size, self.b_size = (np.array([len(x) for x in y]) for y in (self.a_bytes, self.b_bytes))
        # Parts are encoded alone if no piece goes across a space behind another character.
        self.in_parts = (isinstance(self.a.pre_tokenizer, pre_tokenizers.ByteLevel)
                         and not any(_SPACE_PIECE in p.lstrip(_SPACE_PIECE) for p in pieces))
        self.part = part_pattern("".join(m for m in MARKS if not any(
            re.search(f"[{_LATIN}]{re.escape(m)}", p) for p in pieces)))
        self.lone_space = self.b.piece_to_id(_SPACE_PIECE)
        if len(self.a_bytes) > 1 << 17 or len(pieces) > 1 << B_BITS:
            raise ValueError("a pair of ids must fit into 32 bits")
        self.memo: dict[str, Found | None] = {}
        self.old = self.memo

    def _a_tokens(self, text: str) -> tuple[np.ndarray, np.ndarray]:
        """Ids of A and their byte ends."""
        found = self.a.encode(text, add_special_tokens=False)
        ids = np.array(found.ids, np.int64)
        begin, end = np.array(found.offsets, np.int64).reshape(-1, 2).T
        if not text.isascii():
            code = np.frombuffer(text.encode("utf-32-le"), "<u4")
            place = np.r_[0, np.cumsum(1 + (code > 0x7F) + (code > 0x7FF) + (code > 0xFFFF))]
            begin, end = place[begin], place[end]
        return ids, token_ends(end, end - begin, self.a_size[ids])

    def _b_tokens(self, text: str) -> tuple[np.ndarray, np.ndarray]:
        """Ids of B and their byte ends; the library adds the space before the text itself."""
        found = self.b.encode(text[1:], return_type="proto").pieces
        rows = [x for p in found for x in (p.id, p.begin, p.end)]
        if not rows and text == " ":  # it adds none to an empty text
            rows = [self.lone_space, 0, 0]
        ids, begin, end = np.array(rows, np.int64).reshape(-1, 3).T
        return ids, token_ends(end + 1, end - begin, self.b_size[ids])

    def align(self, parts: list[str]) -> list[Found | None]:
        """What there is to know of each part; None if a side does not decode to it.

        Parts are encoded in a row where that is the same: each begins with a space (one that begins
        with a mark gets a letter before it), and the one before it does not end with white space.
        """
        out: dict[int, Found | None] = {}
        in_row = [i for i, p in enumerate(parts) if not p[-1].isspace()]
        alone = [i for i, p in enumerate(parts) if p[-1].isspace()]
        todo = [in_row[i:i + IN_A_ROW] for i in range(0, len(in_row), IN_A_ROW)] + [[i] for i in alone]
        while todo:
            some = todo.pop()
            row = [x for i in some for x in ([LETTER, parts[i]] if parts[i][0] != " " else [parts[i]])]
            found = self._aligned(row)
            found = found and [f for f, p in zip(found, row, strict=True) if p is not LETTER]
            if found is None and len(some) > 1:  # find the part that does not decode
                todo += [some[:len(some) // 2], some[len(some) // 2:]]
            else:
                out.update(zip(some, found or [None], strict=True))
        return [out[i] for i in range(len(parts))]

    def _aligned(self, parts: list[str]) -> list[Found] | None:
        text = "".join(parts)
        (a, a_end), (b, b_end) = self._a_tokens(text), self._b_tokens(text)
        a_ids, b_ids, raw = a.tolist(), b.tolist(), text.encode()
        if (b"".join([self.a_bytes[i] for i in a_ids]) != raw
                or b"".join([self.b_bytes[i] for i in b_ids]) != raw):
            return None
        at = np.flatnonzero(np.isin(a_end, b_end, assume_unique=True))
        bt = np.searchsorted(b_end, a_end[at])
        links = ((a[at] << B_BITS) + b[bt]).astype("<u4").tobytes()
        a_text, b_text = [*map(str, a_ids)], [*map(str, b_ids)]
        groups, i, j = [], 0, 0
        for x, y in zip((at + 1).tolist(), (bt + 1).tolist(), strict=True):
            groups.append(f"{a_text[i] if x == i + 1 else ','.join(a_text[i:x])}|"
                          f"{b_text[j] if y == j + 1 else ','.join(b_text[j:y])}")
            i, j = x, y
        ends = np.cumsum([len(p.encode()) for p in parts])
        last = np.searchsorted(a_end[at], ends)  # a part's last group ends with it
        g = [0, *(last + 1).tolist()]
        n_a, n_b = (np.diff(np.r_[0, x[last] + 1]).tolist() for x in (at, bt))
        return [(links[4 * g[k]:4 * g[k + 1]], ";".join(groups[g[k]:g[k + 1]]).encode(), n_a[k], n_b[k])
                for k in range(len(parts))]

    def whole(self, text: str) -> Found:
        found = self.align([" " + text])[0]
        if found is None:
            return b"", "", 0, 0
        return found[0], hashlib.sha256(found[1]).hexdigest(), *found[2:]

    def _recent(self, wanted: set[str]) -> tuple[dict, dict]:
        """The parts remembered of late, and those of the time before. What both lack long enough
        is forgotten, so frequent parts stay."""
        if len(self.memo) + len(wanted - self.memo.keys()) > REMEMBERED:
            self.old, self.memo = self.memo, {}
        return self.memo, self.old

    def texts(self, texts: list[str | None]) -> Iterator[Found]:
        """Links, digest of the groups and numbers of tokens of each text."""
        cut = [self.part.findall(" " + t)[:-1] if t and self.in_parts else [] for t in texts]
        wanted = {p for parts in cut for p in parts}
        memo, old = self._recent(wanted)
        new = [p for p in wanted if p not in memo]
        memo.update({p: old[p] for p in new if p in old})
        new = [p for p in new if p not in memo]
        memo.update(zip(new, self.align(new), strict=True))
        for text, parts in zip(texts, cut, strict=True):
            found = [memo[p] for p in parts]
            if not text:
                yield b"", "", 0, 0
            elif not parts or None in found:
                yield self.whole(text)
            else:
                links, groups, n_a, n_b = zip(*found, strict=True)
                yield (b"".join(links), hashlib.sha256(b";".join(groups)).hexdigest(), sum(n_a), sum(n_b))
        for p in new:  # long parts seldom come again
            if len(p) > REMEMBERED_CHARS:
                del memo[p]


def aligner(byte_vocabulary: str, piece_model: str) -> Aligner:
    return kept(("aligner", byte_vocabulary, piece_model),
                lambda: Aligner(byte_vocabulary, piece_model))


TEXTS = "n_a long, n_b long, n_groups long, groups_sha256 string"


class _Block:
    """Texts of a block, and the distinct pairs of their links."""

    def __init__(self, number: int):
        self.number, self.rows, self.links = number, [], 0

    def add(self, doc, found: Found):
        self.rows.append((doc, *found))
        self.links += len(found[0]) // 4

    def batch(self, kind: pa.DataType) -> pa.RecordBatch:
        docs, links, digests, n_a, n_b = zip(*self.rows, strict=True)
        sizes = np.array([len(x) // 4 for x in links], np.int64)
        pairs, at, count = np.unique(np.frombuffer(b"".join(links), "<u4"), return_inverse=True,
                                     return_counts=True)
        numbers = at.astype("<u2" if len(pairs) <= 1 << 16 else "<u4")
        width, ends = numbers.itemsize, np.cumsum(sizes)
        raw = numbers.tobytes()
        own = [raw[(e - n) * width:e * width] for e, n in zip(ends.tolist(), sizes.tolist(), strict=True)]
        last = len(docs)  # a row more for the pairs
        none = lambda values, t: pa.array([*values, None], t)
        return pa.RecordBatch.from_arrays(
            [pa.array(np.full(last + 1, self.number)), pa.concat_arrays([pa.array(docs, kind), pa.nulls(1, kind)]),
             none(n_a, pa.int64()), none(n_b, pa.int64()), none(sizes, pa.int64()),
             none(digests, pa.string()), none(own, pa.binary()),
             pa.array([*[None] * last, pairs.tobytes()], pa.binary()),
             pa.array([*[None] * last, count.astype("<i8").tobytes()], pa.binary())],
            names=["block", "doc_id", "n_a", "n_b", "n_groups", "groups_sha256", "links", "pairs", "counts"])


def _source(rows: pa.RecordBatch) -> int:
    """The partition the rows were read from (``_part``), without that column the task's."""
    at = rows.schema.get_field_index("_part")
    return rows.column(at)[0].as_py() if at >= 0 else TaskContext.get().partitionId()


def _block_rows(byte_vocabulary: str, piece_model: str, most: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        both, block, kind = aligner(byte_vocabulary, piece_model), None, pa.null()
        for part in slices(batches, size=500_000):
            if block is None:
                number = _source(part) << 32
                block = _Block(number)
            ids, kind = column(part, "doc_id").to_pylist(), column(part, "doc_id").type
            for doc, found in zip(ids, both.texts(column(part, "text").to_pylist()), strict=True):
                block.add(doc, found)
                if block.links >= most:
                    yield block.batch(kind)
                    number += 1
                    block = _Block(number)
        if block and block.rows:
            yield block.batch(kind)
    return run


def blocks(docs: DataFrame, byte_vocabulary: str, piece_model: str, most: int = BLOCK_LINKS) -> DataFrame:
    """One row per text with its links as numbers of its block's pairs, and one per block
    (``pairs`` is there) with these pairs and their counts.

    Blocks are numbered within the partition they are read from. The task's own number would not do:
    a task that reads several partitions, as below a ``coalesce``, runs this once for each.
    """
    kind = docs.schema["doc_id"].dataType.simpleString()
    return docs.select("doc_id", "text", F.spark_partition_id().alias("_part")).mapInArrow(
        _block_rows(byte_vocabulary, piece_model, most),
        f"block long, doc_id {kind}, {TEXTS}, links binary, pairs binary, counts binary")


def _pair_rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for block, pairs, counts in zip(*(c.to_pylist() for c in batch.columns), strict=True):
            pairs = np.frombuffer(pairs, "<u4").astype(np.int64)
            yield pa.RecordBatch.from_arrays(
                [pa.array(np.full(len(pairs), block)), pa.array(pairs), pa.array(np.frombuffer(counts, "<i8"))],
                names=["block", "pair", "n"])


def pair_sums(found: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(block, pair, n) of every block, and (pair, links, best): the corpus-wide numbers of
    links, and whether no other pair of the B id has more."""
    own = found.where("pairs is not null").select("block", "pairs", "counts").mapInArrow(
        _pair_rows, "block long, pair long, n long")
    sums = lookup_groups(own, ["pair"]).agg(F.sum("n").alias("links")).drop("_hash")
    b = (F.col("pair") % (1 << B_BITS)).alias("b")
    highest = sums.groupBy(b).agg(F.max("links").alias("_most"))
    return own, (sums.withColumn("b", b).join(highest, "b")
                 .select("pair", "links", (F.col("links") == F.col("_most")).alias("best")))


def _block_sums(key, texts: pa.Table, known: pa.Table) -> pa.Table:
    """Sums over the links of each text of a block. Pairs are numbered in their order."""
    order = np.argsort(known["pair"].to_numpy())
    links, best = (known[c].to_numpy()[order].astype(np.int64) for c in ("links", "best"))
    width, own = 2 if len(order) <= 1 << 16 else 4, texts["links"].to_pylist()
    sizes = np.array([len(x) // width for x in own], np.int64)
    at = np.frombuffer(b"".join(own), f"<u{width}")
    total = lambda v: np.diff(np.r_[0, np.cumsum(v[at])][np.r_[0, np.cumsum(sizes)]])
    return pa.table({"doc_id": texts["doc_id"], "n_a": texts["n_a"], "n_b": texts["n_b"],
                     "n_groups": texts["n_groups"], "n_links": texts["n_groups"],
                     "n_best": pa.array(total(best), pa.int64()),
                     "count_sum": pa.array(total(links), pa.int64()),
                     "groups_sha256": texts["groups_sha256"]})


def alignment(docs: DataFrame, byte_vocabulary: str, piece_model: str) -> DataFrame:
    """doc_id, n_a, n_b, n_groups, n_links, n_best, count_sum, groups_sha256 of every document."""
    scratch = Scratch(docs, "alignment")
    kind = docs.schema["doc_id"].dataType.simpleString()
    found = scratch.keep(blocks(docs, byte_vocabulary, piece_model), "blocks")
    own, sums = pair_sums(found)
    known = own.join(sums, "pair").select("block", "pair", "links", "best")
    texts = found.where("pairs is null").drop("pairs", "counts")
    return texts.groupBy("block").cogroup(known.groupBy("block")).applyInArrow(
        _block_sums, f"doc_id {kind}, n_a long, n_b long, n_groups long, n_links long, n_best long, "
                     "count_sum long, groups_sha256 string")


def pair_table(docs: DataFrame, byte_vocabulary: str, piece_model: str) -> DataFrame:
    """(a_id, b_id, links, best): every linked pair of ids with its number of links."""
    found = Scratch(docs, "alignment").keep(blocks(docs, byte_vocabulary, piece_model), "blocks")
    return pair_sums(found)[1].select((F.col("pair") / (1 << B_BITS)).cast("int").alias("a_id"),
                                      (F.col("pair") % (1 << B_BITS)).cast("int").alias("b_id"), "links", "best")

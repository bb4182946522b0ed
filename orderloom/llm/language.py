"""Language identification by unigram pieces, summed over all segmentations.

Each language has a probability for every piece of a fixed public vocabulary. A word's probability
in a language is the sum over all ways to cut it into pieces of the product of their
probabilities, by a forward pass; a text's is the product over its words. The prediction is the
language with the largest posterior.

Words are runs of letters in lower case with a word-begin mark, as the vocabulary has it; runs of
more than ``LONGEST`` letters are scored in parts of that length. A letter that is no piece of its
own counts as an unknown one, equally improbable in all languages.

The piece probabilities are fitted by expectation maximisation on a bounded sample: about
``fit_rows`` documents of each language, a share of the hash range. Its words are
counted once per language; each round is one job over them (forward and backward over all
segmentations), which returns at most one number per piece and language. Smoothing mixes in the
pieces of all languages. All texts are scored whole in their tasks, without a shuffle: the lattices
of a slice's new words are built together in numpy, and words are remembered.

Defined results: a null text, or one without a letter, is ``und`` with score 0, and so is every text
if there is nothing to learn from. Rows with a null doc_id are neither held out nor learned from;
repeated rows of a document are learned once; ties go to the least language name. The score is the
posterior of the predicted language. Other columns are ignored.
"""

import re
from collections import Counter
from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from orderloom.llm.common import Scratch, column, kept, slices
from orderloom.llm.toxicity import held_out

UNDETERMINED = "und"
LONGEST = 32
MARK = "▁"
UNKNOWN = 1e-7
SMOOTHING = 0.02
#: Word vectors a worker remembers, in numbers; and how fine expected counts are summed.
REMEMBERED = 4_000_000
UNIT = 1 << 20


_ALNUM = re.compile(r"[^\W\d_]+")


def _runs(text: str) -> list[str]:
    """Runs of letters: word characters without decimal digits, underscore and other numbers."""
    found = _ALNUM.findall(text)
    if "".join(found).isalpha():
        return found
    return [r for w in found for r in "".join(c if c.isalpha() else " " for c in w).split()]


def words_in(text: str) -> list[str]:
    """Lower-case words with their mark, long ones in parts (the first has the mark)."""
    out = [MARK + w for w in _runs(text.lower())]
    if not out or len(max(out, key=len)) <= LONGEST + 1:
        return out
    return [x for w in out for x in (w[:LONGEST + 1], *(
        w[i:i + LONGEST] for i in range(LONGEST + 1, len(w), LONGEST)))]


class Pieces:
    """The letter pieces of a vocabulary as a trie over code points.

    A node's child by a character is found by binary search in the sorted keys
    ``node << 21 | character``.
    """

    def __init__(self, model: str):
        import sentencepiece
        b = sentencepiece.SentencePieceProcessor(model_file=model)
        names = {b.id_to_piece(i) for i in range(b.get_piece_size())
                 if not (b.is_byte(i) or b.is_control(i) or b.is_unknown(i) or b.is_unused(i))}
        self.names = sorted(n for n in names if n == n.lower() and (
            n == MARK or n.removeprefix(MARK).isalpha()))
        children: dict[int, int] = {}
        piece_of = [-1]
        for i, name in enumerate(self.names):
            node = 0
            for c in name:
                key = node << 21 | ord(c)
                if key not in children:
                    children[key] = len(piece_of)
                    piece_of.append(-1)
                node = children[key]
            piece_of[node] = i
        self.keys = np.array(sorted(children), np.int64)
        self.child = np.array([children[k] for k in self.keys.tolist()], np.int64)
        self.piece_of = np.array(piece_of, np.int64)

    def __len__(self):
        return len(self.names)

    def step(self, node: np.ndarray, char: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Which nodes have a child by the character, and these children."""
        key = node << 21 | char
        at = np.minimum(np.searchsorted(self.keys, key), len(self.keys) - 1)
        there = np.flatnonzero(self.keys[at] == key)
        return there, self.child[at[there]]

    def lattice(self, chars: np.ndarray) -> list[tuple[int, int, np.ndarray, np.ndarray]]:
        """All pieces in words of one length (a row each): (begin, end, rows, pieces), by begin. A
        character that is no piece is the unknown piece, the one behind the last."""
        out, (n, size) = [], chars.shape
        for begin in range(size):
            rows, node = np.arange(n), np.zeros(n, np.int64)
            for end in range(begin + 1, size + 1):
                there, node = self.step(node, chars[rows, end - 1])
                rows = rows[there]
                piece = self.piece_of[node]
                own = piece >= 0
                if end == begin + 1:
                    unknown = np.ones(n, bool)
                    unknown[rows[own]] = False
                    lost = np.flatnonzero(unknown)
                    if len(lost):
                        out.append((begin, end, lost, np.full(len(lost), len(self))))
                if own.any():
                    out.append((begin, end, rows[own], piece[own]))
                if not len(rows):
                    break
        return out


def pieces_of(model: str) -> Pieces:
    return kept(("letter pieces", model), lambda: Pieces(model))


def by_length(words: list[str], most: int = 4096) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Places of words of one length, and their code points (a row each)."""
    sizes = np.array([len(w) for w in words])
    order = np.argsort(sizes, kind="stable")
    starts = np.flatnonzero(np.r_[True, np.diff(sizes[order]) > 0]) if len(order) else []
    for some in np.split(order, starts[1:]):
        for at in range(0, len(some), most):
            rows = some[at:at + most]
            text = "".join([words[i] for i in rows.tolist()])
            yield rows, np.frombuffer(text.encode("utf-32-le"), "<u4").astype(np.int64).reshape(len(rows), -1)


def forward(lattice, shape: tuple[int, int], probability) -> np.ndarray:
    """(place, word, ...): probability of what stands before each place, over all segmentations."""
    n, size = shape
    first = probability(np.arange(0), np.zeros(0, np.int64))
    alpha = np.zeros((size + 1, n, *first.shape[1:]))
    alpha[0] = 1
    for begin, end, rows, pieces in lattice:
        alpha[end, rows] += alpha[begin, rows] * probability(rows, pieces)
    return alpha


def log_probabilities(words: list[str], pieces: Pieces, table: np.ndarray) -> np.ndarray:
    """(word, language): log of each word's probability; ``table`` is (piece, language)."""
    out = np.zeros((len(words), table.shape[1]))
    for rows, chars in by_length(words):
        alpha = forward(pieces.lattice(chars), chars.shape, lambda _, p: table[p])
        out[rows] = np.log(alpha[-1])
    return out


def expected_counts(words: list[str], times: np.ndarray, language: np.ndarray, pieces: Pieces,
                    table: np.ndarray) -> np.ndarray:
    """(piece, language): how often each piece is expected in the words of each language."""
    total = np.zeros(table.shape)
    for at, chars in by_length(words):
        (n, size), own = chars.shape, language[at]
        lattice = pieces.lattice(chars)
        probability = lambda rows, p: table[p, own[rows]]
        alpha, beta = forward(lattice, chars.shape, probability), np.zeros((size + 1, n))
        beta[size] = 1
        for begin, end, rows, p in reversed(lattice):
            beta[begin, rows] += probability(rows, p) * beta[end, rows]
        each = times[at] / alpha[-1]
        for begin, end, rows, p in lattice:
            np.add.at(total, (p, own[rows]),
                      alpha[begin, rows] * probability(rows, p) * beta[end, rows] * each[rows])
    return total


class Model(NamedTuple):
    """Languages, log of their shares, and (piece, language) probabilities."""
    languages: list[str]
    prior: np.ndarray
    table: np.ndarray


def _sample(docs: DataFrame, rows: int, seed: int) -> tuple[DataFrame, dict[str, int]]:
    """(lang, text) of some documents of each language, those whose hash lies in the first
    ``rows``-th of as many parts as the language has documents; and these numbers of documents."""
    known = docs.where("doc_id is not null and lang is not null").where(~held_out(F.col("doc_id")))
    known = known.select("lang", "text", F.xxhash64(F.lit(seed), "doc_id").alias("order"))
    shares = {r.lang: r["count"] for r in known.groupBy("lang").count().collect()}
    # An entry for each language, as the model has; the texts are not shuffled for it.
    limits = F.create_map(*[F.lit(x) for lang, n in shares.items() for x in (
        lang, -2**63 + min(2**64 - 1, rows * 2**64 // n))]) if shares else F.lit(None).cast("map<string,long>")
    some = known.where(F.col("order") <= F.element_at(limits, F.col("lang")))
    return some.groupBy("lang", "order").agg(F.max("text").alias("text")).select("lang", "text"), shares


def _word_rows(most: int = 200_000):
    def batch(found: Counter) -> pa.RecordBatch:
        langs, words = zip(*found, strict=True) if found else ((), ())
        return pa.RecordBatch.from_arrays(
            [pa.array(langs, pa.string()), pa.array(words, pa.string()), pa.array([*found.values()], pa.int64())],
            names=["lang", "word", "n"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        found: Counter = Counter()
        for part in slices(batches):
            for lang, text in zip(*(column(part, c).to_pylist() for c in ("lang", "text")), strict=True):
                for word, n in Counter(words_in(text or "")).items():
                    found[lang, word] += n
            if len(found) > most:
                yield batch(found)
                found.clear()
        yield batch(found)
    return run


def _count_rows(model: str, languages: list[str], table: np.ndarray):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        number, total = {x: i for i, x in enumerate(languages)}, np.zeros(table.shape)
        for batch in batches:
            total += expected_counts(
                column(batch, "word").to_pylist(), column(batch, "n").to_numpy().astype(float),
                np.array([number[x] for x in column(batch, "lang").to_pylist()], np.int64),
                pieces_of(model), table)
        piece, language = np.nonzero(total)
        sums = np.round(total[piece, language] * UNIT).astype(np.int64)
        yield pa.RecordBatch.from_arrays([pa.array(piece), pa.array(language), pa.array(sums)],
                                         names=["piece", "language", "n"])
    return run


def fit(docs: DataFrame, model: str, fit_rows: int = 1500, rounds: int = 4, seed: int = 11) -> Model:
    """Learn the probabilities from about ``fit_rows`` documents of each language."""
    sample, shares = _sample(docs, fit_rows, seed)
    languages = sorted(shares)
    size = len(Pieces(model)) + 1
    table = np.full((size, len(languages)), 1 / size)
    table[-1] = UNKNOWN
    if languages:
        words = Scratch(docs.select("doc_id"), "language").keep(
            sample.mapInArrow(_word_rows(), "lang string, word string, n long")
            .groupBy("lang", "word").agg(F.sum("n").alias("n")).sortWithinPartitions("lang", "word"), "words")
        for _ in range(rounds):
            found = (words.mapInArrow(_count_rows(model, languages, table), "piece long, language long, n long")
                     .groupBy("piece", "language").agg(F.sum("n").alias("n")).collect())
            count = np.zeros(table.shape)
            for r in found:
                count[r.piece, r.language] = r.n / UNIT
            table = _smoothed(count)
    total = max(1, sum(shares.values()))
    return Model(languages, np.log([max(1, shares[x]) / total for x in languages]), table)


def _smoothed(count: np.ndarray) -> np.ndarray:
    """Shares of the pieces in each language, mixed with their shares in all languages."""
    count = count[:-1]
    all_ = count.sum(1, keepdims=True) + 0.01
    own = count / np.maximum(count.sum(0), 1e-300)
    mixed = (1 - SMOOTHING) * own + SMOOTHING * all_ / all_.sum()
    return np.concatenate([mixed, np.full((1, count.shape[1]), UNKNOWN)])


class Scorer:
    """Word vectors of a model, remembered up to a number of them."""

    def __init__(self, pieces: Pieces, model: Model):
        self.pieces, self.model = pieces, model
        self.most = max(20_000, REMEMBERED // max(1, len(model.languages)))
        self._forget()

    def _forget(self):
        self.place: dict[str, int] = {}
        self.vectors = np.zeros((0, len(self.model.languages)))

    def __call__(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """(text, language) log posteriors, and whether a text has a letter."""
        words = [words_in(t) for t in texts]
        sizes = np.array([len(w) for w in words], np.int64)
        every = [w for some in words for w in some]
        new = sorted(set(every) - self.place.keys())
        if len(self.place) + len(new) > self.most:
            self._forget()
            new = sorted(set(every))
        found = log_probabilities(new, self.pieces, self.model.table)
        self.place.update(zip(new, range(len(self.vectors), len(self.vectors) + len(new)), strict=True))
        self.vectors = np.concatenate([self.vectors, found])
        own = self.vectors[np.array([self.place[w] for w in every], np.int64)]
        total = np.zeros((len(texts), own.shape[1])) + self.model.prior
        some = np.flatnonzero(sizes)
        if len(some):
            total[some] += np.add.reduceat(own, (np.cumsum(sizes) - sizes)[some])
        return total, sizes > 0


def _scored_rows(model_file: str, model: Model):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        scorer = Scorer(pieces_of(model_file), model)
        names = np.array([*model.languages, UNDETERMINED], object)
        for part in slices(batches, size=1_000_000):
            n = part.num_rows
            best, score = np.full(n, len(names) - 1), np.zeros(n)
            if model.languages:
                total, lettered = scorer([x or "" for x in column(part, "text").to_pylist()])
                best = np.where(lettered, total.argmax(1), best)
                share = 1 / np.exp(total - total.max(1, keepdims=True)).sum(1)
                score = np.where(lettered, share, 0.0)
            yield pa.RecordBatch.from_arrays(
                [column(part, "doc_id"), pa.array(names[best].tolist(), pa.string()), pa.array(score)],
                names=["doc_id", "lang_pred", "score"])
    return run


def languages(docs: DataFrame, model_file: str, **fitting) -> DataFrame:
    """doc_id, held_out, lang_pred, score of every document."""
    model = fit(docs.select("doc_id", "text", "lang"), model_file, **fitting)
    kind = docs.schema["doc_id"].dataType.simpleString()
    found = docs.select("doc_id", "text").mapInArrow(
        _scored_rows(model_file, model), f"doc_id {kind}, lang_pred string, score double")
    return found.select("doc_id", held_out(F.col("doc_id")).alias("held_out"), "lang_pred", "score")

"""License scan: template fingerprints pick stretches of text, a banded alignment checks them.

Words are runs of letters and digits, ASCII case folded. Fingerprints are hashes of ``GRAM``
consecutive words (fewer in short templates): all of a template, or of a long one the least of
every ``WINNOW`` (winnowing). They make an inverted index that does not grow with the documents.
All rolling hashes of a document are looked up in it. A hit marks the stretch that a match
through it may take; in stretches that meet, the longest common subsequence of template and
text gives the matched words, their share of the template, and where they lie. It is taken inside a band
over all diagonals of the stretch's hits, with a margin of as many words as may be foreign or
missing in a match: no pair of words of a match with a hit lies outside of it, so words may be missing or
foreign one by one or in runs. A match is no longer than twice its template (a third more
for templates under ``WHOLE`` words).

Rows stay where they are, there is no shuffle, and whole texts are scanned.

Defined results: null, empty and blank texts match nothing; a text that holds a notice twice has
two rows; repeated documents have their rows each; of templates that match at one place the best
is reported, so a paragraph of a whole text that was found has no row of its own. A one-line
notice needs its name and version. ``published`` tells whether the template's words stand in a row in one
of the published license files; all other templates are approximations. Other columns are ignored.
"""

import math
import re
from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from orderloom.llm.common import (column, gram_hashes, gram_valid, mix, slices, word_hashes, words_of)
from orderloom.llm.notices import GENERIC, published, templates

GRAM, WINNOW = 3, 3
LEAST_COVERAGE = 0.8
#: Templates below SHORT words are sought by shorter grams, from LONG words on winnowed, and from
#: WHOLE words on a match may hold as many foreign words as the template has words. A stretch
#: needs a hit for every SEEDS words of its template.
SHORT, LONG, WHOLE, SEEDS = 10, 64, 24, 40

TEMPLATES, _NOTICES = templates()
PUBLISHED = published(TEMPLATES)


def names_of(name: str, text: str) -> str:
    """The words of a notice without which it is another license's or none, else nothing."""
    if name not in _NOTICES:
        return ""
    return " ".join(w for w in re.findall("[a-z0-9]+", text.lower()) if w not in GENERIC)


_BYTE = np.arange(256)
_LETTER = ((_BYTE >= 0x80) | ((_BYTE >= 0x30) & (_BYTE <= 0x39)) | ((_BYTE >= 0x41) & (_BYTE <= 0x5A))
           | ((_BYTE >= 0x61) & (_BYTE <= 0x7A)))
_FOLDED = np.where((_BYTE >= 0x41) & (_BYTE <= 0x5A), _BYTE + 0x20, _BYTE).astype(np.uint8)


def _words(batch):
    return words_of(batch, separator=~_LETTER, folded=_FOLDED)


class Template(NamedTuple):
    """A template's name, number of words, the words that a match needs, the longest match, and
    for each word its places as bits, from the front and from the back; the words of which
    none may be missing."""
    name: str
    size: int
    need: int
    longest: int
    front: dict[int, int]
    back: dict[int, int]
    names: frozenset[int] = frozenset()


class Index(NamedTuple):
    """Templates; for each gram size sorted fingerprints with their template and place in it."""
    templates: list[Template]
    prints: dict[int, tuple[np.ndarray, np.ndarray, np.ndarray]]


def room(size: int) -> int:
    """How many words longer than its template a match may be; short notices stay short."""
    return size if size >= WHOLE else size // 3


def gram_of(size: int) -> int:
    return GRAM if size >= SHORT else min(size, GRAM - 1)


def winnow(grams: np.ndarray, window: int = WINNOW) -> np.ndarray:
    """Places of the least of every ``window`` consecutive hashes, the rightmost on ties."""
    if not len(grams):
        return np.zeros(0, np.int64)
    window = min(window, len(grams))
    views = np.lib.stride_tricks.sliding_window_view(grams, window)
    return np.unique(np.arange(len(views)) + window - 1 - views[:, ::-1].argmin(1))


def template_of(name: str, words: list[int], least: float, names=()) -> Template:
    size, front, back = len(words), {}, {}
    for i, w in enumerate(words):
        front[w] = front.get(w, 0) | 1 << i
        back[w] = back.get(w, 0) | 1 << (size - 1 - i)
    need = max(1, math.ceil(least * size - 1e-9))
    return Template(name, size, need, size + room(size), front, back, frozenset(names))


def hashes(texts: list[str]) -> list[np.ndarray]:
    """The word hashes of each text."""
    words = _words(pa.RecordBatch.from_arrays([pa.array(texts, pa.string())], names=["text"]))
    h = word_hashes(words)
    return [h[a:b] for a, b in zip(words.ends[:-1], words.ends[1:], strict=True)]


def index(templates: dict[str, str], least: float = LEAST_COVERAGE) -> Index:
    own = hashes(list(templates.values()))
    named = hashes([names_of(n, t) for n, t in templates.items()])
    found = {}
    for k, t in enumerate(own):
        if len(t):
            gram = gram_of(len(t))
            grams = mix(gram_hashes(t, gram))
            place = winnow(grams) if len(t) >= LONG else np.arange(len(grams))
            found.setdefault(gram, []).append((grams[place], np.full(len(place), k), place))
    prints = {}
    for gram, parts in found.items():
        keys, which, place = (np.concatenate(x) for x in zip(*parts, strict=True))
        order = np.argsort(keys, kind="stable")
        prints[gram] = keys[order], which[order], place[order]
    return Index([template_of(n, t.tolist(), least, w.tolist())
                  for n, t, w in zip(templates, own, named, strict=True)], prints)


def hits(idx: Index, h: np.ndarray, ends: np.ndarray):
    """(place in all words, template, place in it) of every fingerprint found."""
    out = [[np.zeros(0, np.int64)] * 3]
    for gram, (prints, which, place) in idx.prints.items():
        at = np.flatnonzero(gram_valid(ends, gram))
        if not len(at):
            continue
        grams = mix(gram_hashes(h, gram))[at]
        low = np.searchsorted(prints, grams)
        hit = np.flatnonzero(prints[np.minimum(low, len(prints) - 1)] == grams)
        low, size = low[hit], np.searchsorted(prints, grams[hit], "right") - low[hit]
        entry = np.repeat(low - (np.cumsum(size) - size), size) + np.arange(size.sum())
        out.append([np.repeat(at[hit], size), which[entry], place[entry]])
    return [np.concatenate(x) for x in zip(*out, strict=True)]


def regions(idx: Index, h: np.ndarray, ends: np.ndarray):
    """(text, template, first, end, lowest, highest) of the stretches of words that may hold a match: a
    match lies inside the stretch around any of its hits, and stretches that meet are one. The last two
    are the diagonals (place in all words less place in the template) that a match may touch."""
    where, template, place = hits(idx, h, ends)
    size, need, longest = (np.array([getattr(t, n) for t in idx.templates], np.int64)
                           for n in ("size", "need", "longest"))
    text = np.searchsorted(ends, where, "right") - 1
    fits = np.diff(ends)[text] >= need[template]
    where, template, place, text = where[fits], template[fits], place[fits], text[fits]
    low = where - place - (longest - need)[template]
    order = np.lexsort((where, low, template, text))
    where, template, text, low = where[order], template[order], text[order], low[order]
    diagonal = where - place[order]
    high = low + (2 * longest - need + size - need)[template]
    new = np.ones(len(low), bool)
    new[1:] = (np.diff(text) != 0) | (np.diff(template) != 0) | (low[1:] > high[:-1])
    first = np.flatnonzero(new)
    last = np.r_[first[1:], len(new)][:len(first)] - 1
    if len(first):
        margin = (longest - need)[template[first]]
        lowest = np.minimum.reduceat(diagonal, first) - margin
        highest = np.maximum.reduceat(diagonal, first) + margin
    else:
        lowest = highest = first
    enough = last - first + 1 >= size[template[first]] // SEEDS
    first, last, lowest, highest = first[enough], last[enough], lowest[enough], highest[enough]
    text, template = text[first], template[first]
    return (text, template, np.maximum(low[first], ends[text]), np.minimum(high[last], ends[text + 1]),
            lowest, highest)


def grow(masks: list, size: int, enough: int) -> tuple[int, int]:
    """The longest common subsequence of a template and the words with these masks, or ``enough``
    of it, and how many words that takes. One addition handles a word: a row of the table is kept
    as the bits where it does not rise, and a carry out of it is one more match."""
    full = (1 << size) - 1
    row, found, end = full, 0, 0
    for j, mask in enumerate(masks):
        if mask and (same := row & mask):
            total = row + same
            if total > full:
                found, end = found + 1, j + 1
                if found == enough:
                    break
            row = (total | (row - same)) & full
    return found, end


def first_match(t: Template, front: list, back: list, start: int, stop: int):
    """The match that ends first of those that begin at ``start`` or later, as (first, end)
    with only the words it needs, or None."""
    while stop - start >= t.need:
        limit = min(stop, start + 2 * t.longest)
        found, size = grow(front[start:limit], t.size, t.need)
        if found < t.need:
            if limit == stop:
                return None
            start += t.longest
            continue
        end = start + size
        first = end - grow(back[start:end][::-1], t.size, t.need)[1]
        if end - first <= t.longest:
            return first, end
        start = first + 1
    return None


def widest(t: Template, front: list, back: list, start: int, stop: int) -> tuple[int, int, int]:
    """(matched words, first, end) of all that is common between two places."""
    end = start + grow(front[start:stop], t.size, t.size)[1]
    found, size = grow(back[start:end][::-1], t.size, t.size)
    return found, end - size, end


def banded(t: Template, words: list[int], lowest: int, highest: int) -> tuple[list, list]:
    """For each word its places in the template, from the front and from the back, as far as they
    lie between two diagonals; None where there is none."""
    front, back = [], []
    for j, w in enumerate(words):
        bits, low, high = t.front.get(w), max(0, j - highest), min(t.size, j - lowest + 1)
        if bits is None or low >= high:
            bits = other = None
        else:
            other = t.back[w]
            if low > 0 or high < t.size:
                bits = bits & ((1 << high) - (1 << low)) or None
                other = other & ((1 << (t.size - low)) - (1 << (t.size - high))) or None
        front.append(bits)
        back.append(other)
    return front, back


def matches(t: Template, words: list[int], lowest: int, highest: int) -> list[tuple[int, int, int]]:
    """(matched words, first, end) of the matches of a template in a stretch of words, between
    the lowest and the highest diagonal (place in the stretch less place in the template).

    A match holds at least ``need`` words of the template in order and is at most ``longest``
    words long, wherever words are missing or foreign. Matches are told apart by the words
    they need at least, and then take what else there is up to the next one.
    """
    front, back = banded(t, words, lowest, highest)
    if len(front) - front.count(None) < t.need:
        return []
    cores, at = [], 0
    while (core := first_match(t, front, back, at, len(words))) is not None:
        # A stray word before it may have made it wide: the narrowest of those that overlap.
        while (other := first_match(t, front, back, core[0] + 1, min(len(words), core[1] + t.longest))
               ) and other[0] < core[1] and other[1] - other[0] < core[1] - core[0]:
            core = other
        cores.append(core)
        at = core[1]
    out, done = [], 0
    for i, (first, end) in enumerate(cores):
        begin = max(done, end - t.longest)
        stop = min(cores[i + 1][0] if i + 1 < len(cores) else len(words), first + t.longest)
        match = widest(t, front, back, begin, stop)
        if match[2] - match[1] > t.longest:  # words from both sides: first those behind, then before
            end = widest(t, front, back, first, stop)[2]
            match = widest(t, front, back, max(done, end - t.longest), end)
        done = match[2]
        if t.names <= set(words[match[1]:match[2]]):
            out.append(match)
    return out


class Match(NamedTuple):
    """A template found in a text, with places in the words of all texts."""
    text: int
    template: Template
    found: int
    first: int
    end: int


def best_of(found: list[Match], h: np.ndarray) -> list[Match]:
    """The matches without those whose words a better one has. The better one matches more words,
    less those of its template that it misses. Two matches that only touch are both kept:
    one has the other's words if it loses half as many without them."""
    out, order = [], sorted(found, key=lambda m: (
        m.text, m.template.size - 2 * m.found, -m.found / m.template.size, m.first))
    for m in order:
        rivals = (o for o in reversed(out) if o.first < m.end and m.first < o.end)
        if not any(2 * loss(o, m, h) >= m.found for o in rivals):
            out.append(m)
    return sorted(out, key=lambda m: (m.text, m.first, m.end, m.template.name))


def loss(m: Match, other: Match, h: np.ndarray) -> int:
    """How many words fewer match without those the other match takes."""
    if m.template.size == 2 * m.found - m.end + m.first:  # nothing foreign, nothing missing
        return min(m.end, other.end) - max(m.first, other.first)
    rest = [*h[m.first:max(m.first, other.first)].tolist(), *h[min(m.end, other.end):m.end].tolist()]
    return m.found - grow([m.template.front.get(w) for w in rest], m.template.size, m.template.size)[0]


def _scan_rows(templates: dict[str, str], least: float):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        idx = index(templates, least)
        for part in slices(batches):
            words = _words(part)
            h = word_hashes(words)
            starts = np.r_[0, np.cumsum((words.data & 0xC0) != 0x80)]
            every = [Match(t, idx.templates[k], found, lo + first, lo + end)
                     for t, k, lo, hi, a, b in zip(*(x.tolist() for x in regions(idx, h, words.ends)), strict=True)
                     for found, first, end in matches(idx.templates[k], h[lo:hi].tolist(), a - lo, b - lo)]
            rows = [(m.text, m.template.name, m.found, m.found / m.template.size,
                     int(starts[words.first[m.first]] - starts[words.places[m.text]]),
                     int(starts[words.last[m.end - 1]] - starts[words.places[m.text]]))
                    for m in best_of(every, h)]
            owner, name, matched, share, first, end = zip(*rows, strict=True) if rows else [()] * 6
            yield pa.RecordBatch.from_arrays(
                [column(part, "doc_id").take(pa.array(owner, pa.int64())), pa.array(name, pa.string()),
                 pa.array(matched, pa.int64()), pa.array(share, pa.float64()),
                 pa.array(first, pa.int64()), pa.array(end, pa.int64())],
                names=["doc_id", "license", "matched_words", "coverage", "start_char", "end_char"])
    return run


def scan(docs: DataFrame, templates: dict[str, str] = TEMPLATES, least: float = LEAST_COVERAGE,
         published: frozenset[str] = PUBLISHED) -> DataFrame:
    """doc_id, license, matched_words, coverage, start_char, end_char, published for every match."""
    kind = docs.schema["doc_id"].dataType.simpleString()
    return docs.select("doc_id", "text").mapInArrow(
        _scan_rows(templates, least), f"doc_id {kind}, license string, matched_words long, "
                                      "coverage double, start_char long, end_char long").withColumn(
        "published", F.col("license").isin(sorted(published)))

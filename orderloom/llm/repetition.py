"""Quality rules on repetition: how much of a text lies inside repeated word runs and lines.

Rolling hashes of word n-grams are taken for whole batches of texts in numpy. An n-gram can
only repeat where the shorter one at its start does, so each length looks at what the length
before left; texts without repeats cost one sort. Measured per text, in shares of the
characters inside words:

* of the most frequent 2-, 3- and 4-gram (all its occurrences);
* inside 5- to 10-grams that occur more than once (``repeated``), and inside their second and
  later occurrences only (``again``);
* inside lines that repeat an earlier line, and the share of such lines.

A text is kept if no measure exceeds its limit (``repeated`` has none) and it has at most ``SYMBOLS``
symbols a word. The limits of n-grams fall with n. Those of top n-grams and of characters in lines
are the ones published for a large web corpus; those of ``again`` lie 0.05 above them, and half of
the lines may repeat in place of 0.3, as poems and lists among good texts do that. They were chosen on
one labelled table (sf0.01); README has what they lose and find on two others. Rows stay
where they are: there is no shuffle, and a hot source costs nothing extra.

Defined results: a null, empty or blank text has 0 words and fails the base rule; every row is
judged on its own, so ties and repeated rows do not matter. Other columns are ignored.
Equal n-grams are told by 64-bit hashes.
"""

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from orderloom.llm.common import (U64, column, gram_hashes, gram_valid, mix, slices, word_hashes,
                                  words_of)

#: Largest shares: of a top n-gram, inside n-grams that come again, of repeated lines and inside them.
TOP = {2: 0.20, 3: 0.18, 4: 0.16}
AGAIN = {5: 0.20, 6: 0.19, 7: 0.18, 8: 0.17, 9: 0.16, 10: 0.15}
LINES, LINE_CHARS = 0.50, 0.20
SYMBOLS = 0.1
FEWEST_WORDS, WINDOW, WINDOW_PERCENT = 20, 8, 30

_SYMBOL = np.isin(np.arange(256), [ord(c) for c in "#*$%&|<>"])
_BLANK = b" \t\n\v\f\r"


def _repeats(key: np.ndarray):
    """Which entries occur more than once; and group number and size of each of those."""
    order = np.argsort(key)
    ordered = key[order]
    first = np.flatnonzero(np.r_[True, ordered[1:] != ordered[:-1]][:len(key)])
    size = np.diff(np.r_[first, len(key)])
    several = np.repeat(size > 1, size)
    return order[several], size[size > 1]


def measures(part: pa.RecordBatch) -> dict[str, np.ndarray]:
    """Counts and shares of each text of a batch."""
    words = words_of(part)
    n, owner = part.num_rows, words.owners()
    sum_of = lambda values: np.bincount(owner, values, n).astype(np.int64)
    starts = np.r_[0, np.cumsum((words.data & 0xC0) != 0x80)]
    chars = starts[words.last] - starts[words.first]
    symbols = np.r_[0, np.cumsum(_SYMBOL[words.data])][words.places]
    out = {"n_words": np.diff(words.ends), "word_chars": sum_of(chars),
           "n_symbols": np.diff(symbols)}
    total = np.maximum(out["word_chars"], 1)
    out |= _line_measures(words, n)

    h, seed = word_hashes(words), mix(np.arange(n, dtype=U64))
    char_ends = np.r_[0, np.cumsum(chars)]
    at = np.arange(len(h))
    for k in range(2, max(AGAIN) + 1):
        valid = gram_valid(words.ends, k)
        at = at[at < len(valid)]
        at = at[valid[at]]
        grams = gram_hashes(h, k)
        where, size = _repeats(mix(grams[at] ^ seed[owner[at]])) if len(at) else (at, at)
        at = at[where]
        if k in TOP:
            best = np.zeros(n, np.int64)
            if len(at):
                lead = at[np.cumsum(size) - size]
                np.maximum.at(best, owner[lead], size * (char_ends[lead + k] - char_ends[lead]))
            out[f"top{k}"] = best / total
        covered = _covered(at, k, len(h))
        if k in AGAIN:
            out[f"repeated{k}"] = sum_of(chars * covered) / total
            earliest = np.minimum.reduceat(at, np.cumsum(size) - size) if len(at) else at
            later = at[at != np.repeat(earliest, size)]
            out[f"again{k}"] = sum_of(chars * _covered(later, k, len(h))) / total
        if k == WINDOW:
            out["n_repeat_words"] = sum_of(covered)
        at = np.sort(at)
    return out


def _covered(starts: np.ndarray, k: int, n: int) -> np.ndarray:
    change = np.zeros(n + k + 1, np.int64)
    change[starts] += 1
    change[starts + k] -= 1
    return np.cumsum(change[:n]) > 0


def _line_measures(words, n: int) -> dict[str, np.ndarray]:
    repeated, share, chars = np.zeros(n, np.int64), np.zeros(n), np.zeros(n)
    for t in range(n):
        text = words.data[words.places[t]:words.places[t + 1]].tobytes()
        if b"\n" not in text:
            continue
        seen, lines, again, size, all_size = set(), 0, 0, 0, 0
        for line in text.split(b"\n"):
            if line.strip(_BLANK):
                lines += 1
                all_size += len(line)
                if line in seen:
                    again += 1
                    size += len(line)
                else:
                    seen.add(line)
        repeated[t], share[t], chars[t] = again, again / max(lines, 1), size / max(all_size, 1)
    return {"n_dup_lines": repeated, "line_share": share, "line_chars": chars}


def verdicts(found: dict[str, np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    """(base_failed, kept)."""
    failed = ((found["n_words"] < FEWEST_WORDS)
              | (100 * found["n_repeat_words"] > WINDOW_PERCENT * found["n_words"]))
    bad = failed | (found["n_symbols"] > SYMBOLS * found["n_words"])
    bad |= (found["line_share"] > LINES) | (found["line_chars"] > LINE_CHARS)
    for k, most in TOP.items():
        bad |= found[f"top{k}"] > most
    for k, most in AGAIN.items():
        bad |= found[f"again{k}"] > most
    return failed, ~bad


COUNTS = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words"]
SHARES = [*(f"top{k}" for k in TOP), *(f"repeated{k}" for k in AGAIN),
          *(f"again{k}" for k in AGAIN), "line_share", "line_chars"]


def _rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for part in slices(batches):
        found = measures(part)
        failed, kept = verdicts(found)
        yield pa.RecordBatch.from_arrays(
            [column(part, "doc_id"), *(pa.array(found[c], pa.int64()) for c in COUNTS),
             pa.array(failed), pa.array(kept), *(pa.array(found[c], pa.float64()) for c in SHARES)],
            names=["doc_id", *COUNTS, "base_failed", "kept", *SHARES])


def repetition(docs: DataFrame) -> DataFrame:
    """doc_id, counts, base_failed, kept, and the shares the verdict rests on."""
    kind = docs.schema["doc_id"].dataType.simpleString()
    return docs.select("doc_id", "text").mapInArrow(
        _rows, f"doc_id {kind}, " + ", ".join(f"{c} long" for c in COUNTS)
        + ", base_failed boolean, kept boolean, " + ", ".join(f"{c} double" for c in SHARES))

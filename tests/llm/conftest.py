"""Small document tables with every odd case, and plain versions of shared steps."""

import random
import re
import string

import pytest

SF = "/root/testdata/sf0.001"
WORD = re.compile(r"[^\x20\x09-\x0D]+")
#: The last columns are named like ones the operators use inside.
NAMES = ["_tag", "_spans", "row", "key", "class", "blank", "_size", "_copies", "spans", "c0", "a.b"]
SCHEMA = ("doc_id long, text string, lang string, source string, n_chars long, "
          + ", ".join(f"`{n}` string" for n in NAMES))


def words(text):
    return WORD.findall(text or "")


def prose(rng, n):
    return " ".join("".join(rng.choices(string.ascii_lowercase, k=rng.randint(2, 8)))
                    for _ in range(n))


def document_rows():
    """Nulls in every column, empty and blank texts, a very long one, exact and near copies,
    repeated rows, one id with two texts, accents, special strings, separators."""
    rng = random.Random(4)
    base, shared = prose(rng, 120), prose(rng, 40)
    near = base.split()
    near[60] = "changed"
    out = [(1, base), (2, base), (3, " ".join(near)), (4, None), (5, ""), (6, " \t\n "),
           (7, prose(rng, 30) + " " + shared + " " + prose(rng, 10)),
           (8, shared), (9, prose(rng, 5) + "\n" + shared + "\n" + prose(rng, 70)),
           (10, prose(rng, 30_000)), (11, "one"), (11, "one"), (12, "twö wörds"), (12, prose(rng, 50)),
           (None, base), (None, "é <|endoftext|> 中文 x<|startoftext|>'s \u00a0nb  sp"),
           (13, "a b c d e " * 60), (14, "x\u0085y\u001cz\u2028w " * 9), (15, shared + " " + shared)]
    out += [(100 + i, prose(rng, 25) + " " + shared[:200] + " " + prose(rng, 25)) for i in range(12)]
    rows = [(i, t, "en", f"src{(i or 0) % 3}", None if t is None else len(t), *["x"] * len(NAMES))
            for i, t in out]
    return [*rows, (16, "no source here at all", None, None, None, *[None] * len(NAMES))]


@pytest.fixture(scope="module")
def docs(spark):
    return spark.createDataFrame(document_rows(), SCHEMA).repartition(3)


@pytest.fixture(scope="module")
def no_docs(spark):
    return spark.createDataFrame([], SCHEMA)


def plain(df):
    return sorted((tuple(r) for r in df.collect()), key=repr)

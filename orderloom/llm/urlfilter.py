"""URL filter: all glob rules at once, by a bit-parallel automaton.

Each rule becomes globs over the canonical URL (host and path): ``*`` stands for any
characters but ``/``, ``**`` for any at all. A glob with n literal bytes has n + 1 states, one bit
each; the states of all globs lie side by side in 64-bit words. For every byte of the URL

    states = (states << 1) & follows[byte] | states & stays[byte]

moves all globs of a whole batch of URLs together; ``follows`` marks states whose literal is
that byte, ``stays`` those in front of a wildcard that takes it. At the end a glob fits if
its last state is on. The masks are as large as the rules; rows stay where they are and are read
in slices of bounded text and states, so a task's memory follows neither rows nor globs.

Defined results: a null url, or one without ``://``, has empty host and path, no rule, and the
verdict for URLs that no glob fits (allow); bytes of characters outside ASCII are matched as
they are; repeated rows are judged each. Other columns are ignored.
"""

from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from orderloom.llm.common import U64, column, slices, text_bytes

#: Verdicts by host and path. A rule holds for its host and all hosts below it, where
#: the path starts with the rule's; the longest rule wins.
RULES = (("block", "net", "/"), ("allow", "example.net", "/en/"),
         ("block", "example.com", "/de/"), ("allow", "org", "/fr/"))

#: Where no rule fits, these are blocked and all else is allowed. Endings of files that
#: are no pages; whole parts of a path that lead to accounts, shops, forms, searches and machinery;
#: whole labels of a host that serve advertising, mail, media or machines.
ENDINGS = """7z apk avi bin bmp bz2 cab css csv deb dll dmg doc docx eot exe flac flv gif gz ico iso jar
jpeg jpg js json m4a mkv mov mp3 mp4 mpeg msi ogg otf pdf png pps ppt pptx ps rar rpm rss svg swf tar tgz
tif tiff ttf wav webm webp whl wma wmv woff woff2 xls xlsx xml xz zip""".split()
PARTS = """account add-to-cart admin basket cart cgi-bin checkout comment-page compare facebook
feed forgot-password login logout lostpassword my-account oauth password-reset pinterest print
privacy-policy register search share sign-in sign-up signin signup sso subscribe tag terms-of-service
unsubscribe wishlist wp-admin wp-content wp-includes wp-json wp-login xmlrpc""".split()
LABELS = """ad ads adserver affiliate analytics api banner cdn click doubleclick ftp imap mail metrics
pixel pop smtp static stats telemetry tracker tracking webmail""".split()

HOST = r"(?s)^.*?://([^/?#]*)"
PATH = r"(?s)^.*?://[^/?#]*([^?#]*)"


class Automaton:
    """Masks of some globs."""

    def __init__(self, globs: Sequence[str]):
        sizes = [len(g.replace("*", "").encode()) + 1 for g in globs]
        bits = sum(sizes)
        self.words = -(-bits // 64)
        follows, stays = np.zeros((256, bits), bool), np.zeros((256, bits), bool)
        self.first = np.cumsum([0, *sizes[:-1]])
        self.last = np.cumsum(sizes) - 1
        for glob, state in zip(globs, self.first.tolist(), strict=True):
            data = glob.encode()
            i = 0
            while i < len(data):
                if data[i:i + 2] == b"**":
                    stays[:, state] = True
                    i += 2
                elif data[i:i + 1] == b"*":
                    stays[:, state] = True
                    stays[ord("/"), state] = False
                    i += 1
                else:
                    state += 1
                    follows[data[i], state] = True
                    i += 1
        self.follows, self.stays = self._packed(follows), self._packed(stays)
        start = np.zeros((1, bits), bool)
        start[0, self.first] = True
        self.start = self._packed(start)[0]

    def _packed(self, bits: np.ndarray) -> np.ndarray:
        padded = np.zeros((len(bits), self.words * 64), bool)
        padded[:, :bits.shape[1]] = bits
        return np.packbits(padded, axis=1, bitorder="little").view("<u8").astype(U64)

    def fits(self, data: np.ndarray, places: np.ndarray) -> np.ndarray:
        """Which glob (column) fits which text (row)."""
        sizes = np.diff(places)
        order = np.argsort(-sizes, kind="stable")  # longest first: those that go on are a prefix
        begin, sizes = places[:-1][order], sizes[order]
        states = np.repeat(self.start[None], len(order), 0)
        going = np.searchsorted(-sizes, -np.arange(1, (sizes[0] if len(sizes) else 0) + 1), "right")
        for t, n in enumerate(going.tolist()):
            byte, now = data[begin[:n] + t], states[:n]
            moved = now << U64(1)
            moved[:, 1:] |= now[:, :-1] >> U64(63)
            states[:n] = (moved & self.follows[byte]) | (now & self.stays[byte])
        out = np.empty((len(order), len(self.last)), bool)
        out[order] = (states[:, self.last // 64] >> (self.last % 64).astype(U64)) & U64(1) == 1
        return out


def rule_globs(host: str, path: str) -> tuple[str, str]:
    return f"{host}{path}**", f"*.{host}{path}**"


def blocked_globs(endings: Sequence[str] = ENDINGS, parts: Sequence[str] = PARTS,
                  labels: Sequence[str] = LABELS) -> list[str]:
    """Globs of the words as wholes: a part of a path ends at ``/``, ``.`` or the end (so ``login``
    blocks ``/login.php`` and not ``/loginov``), a label of a host at a dot."""
    return ([f"*/**.{e}" for e in endings] + [f"**/{p}{end}" for p in parts for end in ("", "/**", ".**")]
            + [f"{start}{x}.**" for x in labels for start in ("", "*.")])


#: A slice of URLs has at most so many states in 64-bit words, whatever the number of globs.
STATES = 1 << 17


def parts_of(batches: Iterator[pa.RecordBatch], rows: int) -> Iterator[pa.RecordBatch]:
    """The batches in slices of bounded text and number of rows."""
    for part in slices(batches, "_url"):
        for first in range(0, part.num_rows, rows):
            yield part.slice(first, rows)


def _verdict_rows(rules, blocked):
    rules = sorted(rules, key=lambda r: -len(r[1] + r[2]))  # the longest first
    globs = [g for _, host, path in rules for g in rule_globs(host, path)]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        automaton = Automaton([*globs, *blocked])
        names = np.array([host + path for _, host, path in rules] + [None], object)
        for batch in parts_of(batches, max(1, STATES // automaton.words)):
            fits = automaton.fits(*text_bytes(batch, "_url"))
            ruled = fits[:, :len(globs)].reshape(len(fits), len(rules), 2).any(2)
            rule = np.c_[ruled, np.ones(len(ruled), bool)].argmax(1)  # the last one where none fits
            other = np.where(fits[:, len(globs):].any(1), "block", "allow")
            said = np.array([v for v, _, _ in rules] + [""], object)[rule]
            verdict = np.where(rule < len(rules), said, other)
            yield pa.RecordBatch.from_arrays(
                [column(batch, c) for c in ("page_id", "host", "path")]
                + [pa.array(names[rule].tolist(), pa.string()),
                   pa.array(verdict.tolist(), pa.string())],
                names=["page_id", "host", "path", "rule", "verdict"])
    return run


def judge(pages: DataFrame, rules=RULES, blocked: Sequence[str] | None = None) -> DataFrame:
    """page_id, host, path, rule, verdict for every page; ``blocked`` are globs, by default those of
    ``blocked_globs``."""
    kind = pages.schema["page_id"].dataType.simpleString()
    url = F.coalesce(F.col("url"), F.lit(""))
    upper = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
    host = F.translate(F.regexp_extract(url, HOST, 1), upper, upper.lower())
    parts = pages.select("page_id", host.alias("host"), F.regexp_extract(url, PATH, 1).alias("path"))
    return parts.withColumn("_url", F.concat("host", "path")).mapInArrow(
        _verdict_rows(rules, blocked_globs() if blocked is None else blocked),
        f"page_id {kind}, host string, path string, rule string, verdict string")

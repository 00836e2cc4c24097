"""Document fingerprints by a homomorphic hash of the multiset of paragraphs.

Every paragraph (line) is hashed to a wide vector, and the vectors of a text are added, each
lane modulo a power of two. So the order of paragraphs does not matter, and paragraphs can be
put in or taken out by adding or subtracting their vectors. The vector has two parts:

* 32 lanes modulo 2**32 of a cryptographic hash of the paragraph, for equality;
* 512 lanes modulo 2**32, in which each run of three words of the paragraph adds or takes one
  in a lane of its hash, for likeness: the squared length of the difference of two such
  vectors estimates how many runs the texts do not share.

Likeness is one minus that, by the sum of the squared lengths, held to 0..1: 1 for equal
fingerprints, near 0 for unrelated texts.

Rules for odd input: null counts as the empty text, which is one empty paragraph and has no
runs; two texts without runs have likeness 1 if their fingerprints are equal, else 0. For the
edited text see ``edit``. Rows with the same id are taken in the order of a hash of their text; null ids
come last. A table of one row follows itself; an empty table gives an empty result. Other
columns are ignored.
"""

from __future__ import annotations

import base64
import hashlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .shared import in_order

EQUAL_LANES, LIKE_LANES, RUN = 32, 512, 3
#: an odd constant for mixing 64-bit words (the golden ratio's fraction)
MIX = np.uint64(0x9E3779B97F4A7C15)
SCHEMA = "doc_id long, n_chars long, edited_sha256 string, fingerprint string, edited_fingerprint string, near_edited double, near_next double"


def mixed(x: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit words that spreads every bit."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


_RANDOM = np.random.default_rng(20)
#: a random 64-bit value per byte, and powers of a random odd number for the places in a word
BYTES = _RANDOM.integers(0, 2**64, 256, dtype=np.uint64)
PLACES = np.cumprod(np.full(4096, _RANDOM.integers(0, 2**63, dtype=np.uint64) * np.uint64(2) + np.uint64(1), np.uint64))
SPACE = np.zeros(256, bool)
SPACE[[9, 10, 11, 12, 13, 32]] = True


def word_hashes(data: bytes) -> tuple[np.ndarray, np.ndarray]:
    """64-bit hashes of the words between ASCII white space, and where each starts. Nothing is
    kept from text to text, so memory is bounded by the text."""
    flat = np.frombuffer(data, np.uint8)
    inside = ~SPACE[flat]
    at = np.flatnonzero(inside)
    if not len(at):
        return np.empty(0, np.uint64), at
    first = np.flatnonzero(np.diff(at, prepend=-2) > 1)  # of each word, among the bytes of words
    lengths = np.diff(first, append=len(at))
    place = np.arange(len(at)) - np.repeat(first, lengths)
    longest = int(lengths.max())
    powers = PLACES if longest <= len(PLACES) else np.cumprod(np.full(longest, PLACES[0], np.uint64))
    sums = np.add.reduceat(BYTES[flat[at]] * powers[place], first)
    return mixed(sums + lengths.astype(np.uint64) * MIX), at[first]


class Fingerprint:
    """The vector; can be added to, taken from, compared and written."""

    def __init__(self, equal: np.ndarray | None = None, like: np.ndarray | None = None):
        self.equal = np.zeros(EQUAL_LANES, np.uint32) if equal is None else equal
        self.like = np.zeros(LIKE_LANES, np.uint32) if like is None else like

    def __add__(self, other: Fingerprint) -> Fingerprint:
        return Fingerprint(self.equal + other.equal, self.like + other.like)

    def __sub__(self, other: Fingerprint) -> Fingerprint:
        return Fingerprint(self.equal - other.equal, self.like - other.like)

    def text(self) -> str:
        return base64.b64encode(self.equal.astype("<u4").tobytes() + self.like.astype("<u4").tobytes()).decode()

    @classmethod
    def read(cls, text: str) -> Fingerprint:
        data = base64.b64decode(text)
        return cls(np.frombuffer(data, "<u4", EQUAL_LANES).copy(), np.frombuffer(data, "<u4", LIKE_LANES, 4 * EQUAL_LANES).copy())

    def likeness(self, other: Fingerprint) -> float:
        a, b = self.like.view(np.int32).astype(np.float64), other.like.view(np.int32).astype(np.float64)
        apart = (self.like - other.like).view(np.int32).astype(np.float64)
        whole = a @ a + b @ b
        if not whole:
            return float(np.array_equal(self.equal, other.equal))
        return float(min(1.0, max(0.0, 1 - (apart @ apart) / whole)))


def paragraph_vectors(paragraphs: list[str]) -> Fingerprint:
    """The sum of the vectors of some paragraphs."""
    data = [p.encode("utf-8", "surrogatepass") for p in paragraphs]
    digests = b"".join([hashlib.shake_128(d).digest(4 * EQUAL_LANES) for d in data])
    equal = np.frombuffer(digests, "<u4").reshape(-1, EQUAL_LANES).sum(axis=0, dtype=np.uint32)
    flat, starts = word_hashes(b"\n".join(data))
    if not len(flat):
        return Fingerprint(equal, None)
    ends = np.cumsum([len(d) + 1 for d in data])
    lengths = np.bincount(np.searchsorted(ends, starts, "right"), minlength=len(data))
    # runs start at every word that has two more in its paragraph; a shorter paragraph is one run
    left = np.repeat(np.cumsum(lengths), lengths) - np.arange(len(flat))
    first = np.zeros(len(flat), bool)
    first[(np.cumsum(lengths) - lengths)[lengths > 0]] = True
    run = flat.copy()
    for k in range(1, RUN):
        ahead = np.zeros_like(flat)
        ahead[:-k] = flat[k:]
        run = run * MIX + np.where(left > k, ahead, np.uint64(k))
    run = mixed(run[(left >= RUN) | first])
    lane = (run % np.uint64(LIKE_LANES)).astype(np.int64)
    sign = ((run >> np.uint64(40)) & np.uint64(1)).astype(bool)
    like = np.bincount(lane[sign], minlength=LIKE_LANES) - np.bincount(lane[~sign], minlength=LIKE_LANES)
    return Fingerprint(equal, like.astype(np.int64).astype(np.uint32))


def fingerprint(text: str) -> Fingerprint:
    return paragraph_vectors(text.split("\n"))


def edit(text: str, following: str) -> str:
    """The last third of the text's code points, rounded down, replaced by as many of the
    first of the following text (all of it if it has fewer)."""
    n = len(text) // 3
    return text[: len(text) - n] + following[:n]


def _rows(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """Frames come in the order of in_order: every row is the one that follows the row before."""
    at, before = None, None
    columns = [c.split()[0] for c in SCHEMA.split(", ")]
    for frame in frames:
        out = []
        for number, side, doc_id, text in zip(frame["_range"], frame["_side"], frame["doc_id"], frame["text"], strict=True):
            own = fingerprint(text)
            if not side:
                # rows come in ascending order of the key, so the row before is the next one
                near_text, near = before if at == number and before is not None else (text, own)
                edited = edit(text, near_text)
                other = fingerprint(edited)
                out.append((doc_id, len(text), hashlib.sha256(edited.encode()).hexdigest(), own.text(), other.text(), own.likeness(other), own.likeness(near)))
            at, before = number, (text, own)
        yield pd.DataFrame(out, columns=columns).astype({"doc_id": "Int64"})


def with_next(docs: DataFrame, *, id_col: str = "doc_id", text_col: str = "text", ranges: int | None = None) -> DataFrame:
    """The fingerprint of every text, of its edited text, and their likeness; the next document
    is that of the next lower id, after the lowest the highest."""
    n = ranges or int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.coalesce(F.col(text_col), F.lit("")).alias("text"))
    # ascending, nulls before all: the document that follows in descending order stands before
    key = [F.col("doc_id").isNotNull(), F.coalesce("doc_id", F.lit(0))]
    return in_order(rows, key, n, ties=F.xxhash64("text")).select("_range", "_side", "doc_id", "text").mapInPandas(_rows, SCHEMA)

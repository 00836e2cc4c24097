"""Verbatim passages of test items in training texts, by suffix arrays of the training texts.

Items are written once, as blocks of a bounded number of words, to the shared folder. A shard is
what a task holds of the corpus at a time: its words are numbered by a block's vocabulary, what
no pair of neighbouring words of an item runs through is cut out (no match can lie there), and
the suffixes of the rest are sorted. Every suffix of an item that starts a window is then
looked up by binary search, one word deeper at a time, which gives the interval of all places
that share its window. Each place from which the match cannot be prolonged to the left is
prolonged to the right as far as item and text agree: a longest verbatim match and its place.

Nothing depends on how many items there are but the number of blocks: a task reads one at a time
and keeps the last few.

Rules for odd input: null and empty texts have no words, no matches and count as clean; items
without words match nothing; an item shorter than a window is one window; rows of items with the
same id are one item, and an item with a null id marks words without being named. Repeated
documents are each searched; tables may be empty; other columns are kept as they are.
"""

from __future__ import annotations

from collections import OrderedDict
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import pyarrow.parquet as pq
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.functions import arrow_udf

from .files import resolve
from .pieces import text_runs
from .shared import released, written
from .suffixes import sorted_suffixes, spread, stretches, words_of

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
WORD = r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+"
#: words of a block of items
BLOCK_WORDS = 200_000
#: blocks that a worker keeps, and pairs of an item's suffix and a place that are open at a time
BLOCKS_KEPT, PAIRS_OPEN = 4, 1 << 20

_FOLD = bytes(b if b >= 0x80 or chr(b) in LOWER or 0x30 <= b <= 0x39 else b + 32 if chr(b) in UPPER else 0x20 for b in range(256))


def plain_words(text: Column) -> Column:
    """The words of a text, A-Z in lower case."""
    return F.regexp_extract_all(F.translate(F.coalesce(text, F.lit("")), UPPER, LOWER), F.lit(f"({WORD})"), F.lit(1))


def folded_words(texts: pa.Array) -> tuple[pa.Array, np.ndarray]:
    """The same words of many texts, and the bounds of each text's: bytes outside words become
    spaces, which leaves all offsets as they are."""
    if not len(texts):
        return texts, np.zeros(1, np.int64)
    _, offsets, data = texts.buffers()
    ends = np.frombuffer(offsets, np.int32)[texts.offset : texts.offset + len(texts) + 1]
    folded = data.slice(ends[0], ends[-1] - ends[0]).to_pybytes().translate(_FOLD) if data else b""
    clean = pa.Array.from_buffers(pa.string(), len(texts), [None, pa.py_buffer(ends - ends[0]), pa.py_buffer(folded)])
    return words_of(pc.ascii_split_whitespace(clean))


class ItemBlock:
    """Items as numbers of their words, and the suffixes that start a window."""

    def __init__(self, names: list[str | None], texts: pa.Array, window: int):
        self.names = names
        words, bounds = words_of(pc.ascii_split_whitespace(texts))
        found = words.dictionary_encode()
        self.vocabulary = found.dictionary
        self.words = found.indices.to_numpy().astype(np.int32) + 1
        sizes = np.diff(bounds)
        starts = np.where(sizes > 0, np.maximum(sizes - window, 0) + 1, 0)
        self.item = np.repeat(np.arange(len(sizes)), starts)
        self.first = bounds[:-1]
        self.at = spread(bounds[:-1], starts)
        self.stop = bounds[1:][self.item]
        self.need = np.minimum(window, sizes)[self.item]
        self.least = int(self.need.min()) if len(self.need) else 0
        inner = np.ones(len(self.words), bool)
        inner[bounds[1:][sizes > 0] - 1] = False
        a = np.flatnonzero(inner)
        self.shift = np.uint32(32 - max(16, int(len(a)).bit_length() + 5))
        self.pairs = np.zeros(1 << int(32 - self.shift), bool)
        self.pairs[self._slot(self.words[a], self.words[np.minimum(a + 1, len(self.words) - 1)])] = True

    def _slot(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        return (a.astype(np.uint32) * np.uint32(0x9E3779B1) + b.astype(np.uint32) * np.uint32(0x85EBCA77)) >> self.shift

    def rest(self, ids: np.ndarray, bounds: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """What of a shard may hold a match: its symbols (0 after each stretch), which of them
        are such ends, and their places in the shard."""
        known = ids > 0
        on = known[:-1] & known[1:]
        on &= self.pairs[self._slot(ids[:-1], ids[1:])]
        last = bounds[1:-1] - 1
        on[last[(last >= 0) & (last < len(on))]] = False
        start, stop = stretches(on)
        if self.least == 1:
            lone = known & ~np.concatenate([[False], on]) & ~np.concatenate([on, [False]])
            start, stop = np.concatenate([start, np.flatnonzero(lone)]), np.concatenate([stop, np.flatnonzero(lone)])
        size = stop - start + 1
        start, size = start[size >= self.least], size[size >= self.least]
        place = spread(start, size + 1)
        ends = np.zeros(len(place), bool)
        ends[np.cumsum(size + 1) - 1] = True
        symbols = np.where(ends, 0, ids[np.minimum(place, len(ids) - 1)])
        return symbols, ends, place

    def intervals(self, symbols: np.ndarray, order: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """For every suffix that starts a window, the interval of sorted suffixes that share it."""
        firsts = symbols[order]
        words = self.words[self.at]
        low, high = np.searchsorted(firsts, words, "left"), np.searchsorted(firsts, words, "right")
        open_ = np.flatnonzero((low < high) & (self.need > 1))
        depth = 1
        while len(open_):
            word = self.words[self.at[open_] + depth]
            a, b = low[open_], high[open_]
            low[open_] = self._lower(symbols, order, a, b, depth, word)
            high[open_] = self._lower(symbols, order, low[open_], b, depth, word + 1)
            depth += 1
            open_ = open_[(low[open_] < high[open_]) & (self.need[open_] > depth)]
        return low, high

    @staticmethod
    def _lower(symbols: np.ndarray, order: np.ndarray, low: np.ndarray, high: np.ndarray, depth: int, word: np.ndarray) -> np.ndarray:
        """The first place from ``low`` to ``high`` whose symbol at ``depth`` is not below."""
        low, high = low.copy(), high.copy()
        left = np.flatnonzero(low < high)
        while len(left):
            middle = (low[left] + high[left]) >> 1
            less = symbols[order[middle] + depth] < word[left]
            low[left[less]] = middle[less] + 1
            high[left[~less]] = middle[~less]
            left = left[low[left] < high[left]]
        return low

    def matches(self, ids: np.ndarray, bounds: np.ndarray) -> np.ndarray:
        """Rows (item, word of the item, place in the shard, words) of all longest matches."""
        none = np.empty((0, 4), np.int64)
        if not len(ids) or not len(self.at):
            return none
        symbols, ends, place = self.rest(ids, bounds)
        if not len(symbols):
            return none
        order, _ = sorted_suffixes(symbols, ends)
        low, high = self.intervals(symbols, order)
        count = high - low
        which = np.flatnonzero(count)
        sums = np.cumsum(count[which])
        out, done = [none], 0
        while done < len(which):
            upto = max(done + 1, int(np.searchsorted(sums, (sums[done - 1] if done else 0) + PAIRS_OPEN, "right")))
            w = which[done:upto]
            done = upto
            t, p = np.repeat(w, count[w]), order[spread(low[w], count[w])]
            # a match that goes on to the left is found from there
            at = self.at[t]
            begins = (at == self.first[self.item[t]]) | (p == 0) | (self.words[at - 1] != symbols[p - 1])
            t, p = t[begins], p[begins]
            at, length = self.at[t], self.need[t].copy()
            on = np.arange(len(t))
            while len(on):
                on = on[at[on] + length[on] < self.stop[t[on]]]
                on = on[self.words[at[on] + length[on]] == symbols[p[on] + length[on]]]
                length[on] += 1
            out.append(np.stack([self.item[t], at - self.first[self.item[t]], place[p], length], axis=1))
        return np.concatenate(out)


_BLOCKS: OrderedDict[tuple[str, int], ItemBlock] = OrderedDict()


def _block(path: str, window: int) -> ItemBlock:
    if (path, window) in _BLOCKS:
        _BLOCKS.move_to_end((path, window))
    else:
        fs, at = resolve(path)
        with fs.open_input_file(at) as src:
            table = pq.read_table(src, columns=["item", "words"])
        _BLOCKS[path, window] = ItemBlock(table["item"].to_pylist(), table["words"].combine_chunks(), window)
        while len(_BLOCKS) > BLOCKS_KEPT:
            _BLOCKS.popitem(last=False)
    return _BLOCKS[path, window]


MATCH = pa.struct([("item", pa.string()), ("item_start", pa.int64()), ("start", pa.int64()), ("length", pa.int64())])
FOUND = pa.struct([("n_words", pa.int64()), ("n_hit", pa.int64()), ("matches", pa.list_(MATCH))])


def _found(texts: pa.Array, blocks: list[str], window: int) -> pa.StructArray:
    words, bounds = folded_words(texts)
    encoded = words.dictionary_encode()
    numbers = encoded.indices.to_numpy()
    rows, names = [np.empty((0, 4), np.int64)], []
    for path in blocks:
        block = _block(path, window)
        known = pc.fill_null(pc.index_in(encoded.dictionary, block.vocabulary), -1).to_numpy().astype(np.int32) + 1
        found = block.matches(known[numbers] if len(numbers) else np.empty(0, np.int32), bounds)
        found[:, 0] += len(names)
        rows.append(found)
        names += block.names
    item, item_start, place, length = np.concatenate(rows).T
    steps = np.zeros(bounds[-1] + 1, np.int64)
    np.add.at(steps, place, 1)
    np.add.at(steps, place + length, -1)
    hits = np.concatenate([[0], np.cumsum(np.cumsum(steps[:-1]) > 0)])
    text = np.searchsorted(bounds, place, "right") - 1
    order = np.lexsort((item_start, item, place))
    held = np.bincount(text, minlength=len(texts))
    columns = [pa.array(names, pa.string()).take(pa.array(item[order])), *(pa.array(c[order]) for c in (item_start, place - bounds[text], length))]
    listed = pa.ListArray.from_arrays(pa.array(np.concatenate([[0], np.cumsum(held)]), pa.int32()), pa.StructArray.from_arrays(columns, fields=list(MATCH)))
    return pa.StructArray.from_arrays([pa.array(np.diff(bounds)), pa.array(np.diff(hits[bounds])), listed], fields=list(FOUND))


def item_blocks(items: DataFrame, id_col: str = "item_id", text_col: str = "text", block_words: int = BLOCK_WORDS) -> list[str]:
    """Writes the items' words to the shared folder; the files, each of about so many words."""
    words = plain_words(F.col(text_col))
    rows = items.select(F.col(id_col).cast("string").alias("item"), words.alias("words")).where(F.size("words") > 0)
    n = rows.agg(F.sum(F.size("words"))).first()[0] or 0
    if not n:
        return []
    blocks = written(rows.select("item", F.array_join("words", " ").alias("words")).repartition(-(-n // block_words)), "items")
    return sorted(blocks.inputFiles())


def searched(text: Column, blocks: list[str], window: int = 10) -> Column:
    """struct<n_words, n_hit, matches: array<struct<item, item_start, start, length>>> of a text:
    all longest matches of at least a window, by their first word, and the words in them."""
    kind = "n_words bigint, n_hit bigint, matches array<struct<item: string, item_start: bigint, start: bigint, length: bigint>>"

    @arrow_udf(kind)
    def found(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        for batch in batches:
            parts = [_found(run, blocks, window) for run in text_runs(batch)]
            yield pa.concat_arrays(parts) if parts else pa.array([], FOUND)
        released()

    return found(text)


def decontaminated(docs: DataFrame, items: DataFrame, window: int = 10, text_col: str = "text") -> DataFrame:
    """``docs`` without those that hold a window of an item."""
    row = F.struct(*[F.col(f"`{c}`") for c in docs.columns])
    held = docs.select(row.alias("row")).select("row", searched(F.col("row")[text_col], item_blocks(items), window).alias("found"))
    return held.where(F.col("found.n_hit") == 0).select(*[F.col("row")[c].alias(c) for c in docs.columns])


def digest_columns(rows: DataFrame) -> DataFrame:
    """doc_id, n_words, n_hit, and which items were found."""
    items = F.array_sort(F.array_compact(F.array_distinct(F.col("found.matches.item"))))
    rows = rows.select("doc_id", F.col("found.n_words").alias("n_words"), F.col("found.n_hit").alias("n_hit"), items.alias("items"))
    return rows.select("doc_id", "n_words", "n_hit", F.size("items").cast("long").alias("n_items"), F.sha2(F.array_join("items", ","), 256).alias("items_sha256"), (F.col("n_hit") > 0).alias("contaminated"))


ORACLE = r"""
WITH d AS (SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'UPPER', 'LOWER'), 'WORD') AS w FROM documents),
b AS (SELECT item_id, regexp_extract_all(translate(coalesce(text, ''), 'UPPER', 'LOWER'), 'WORD') AS w FROM benchmark),
windows AS (
  SELECT DISTINCT item_id, least(len(w), 10) AS size, unnest(list_transform(range(greatest(len(w) - 9, 1)), lambda j: array_to_string(w[j + 1:j + 10], ' '))) AS gram
  FROM b WHERE len(w) > 0),
grams AS (
  SELECT doc_id, size, unnest(range(len(w) - size + 1)) AS k, unnest(list_transform(range(len(w) - size + 1), lambda j: array_to_string(w[j + 1:j + size], ' '))) AS gram
  FROM d, (SELECT DISTINCT size FROM windows) WHERE len(w) >= size),
found AS (SELECT doc_id, k, size, item_id FROM grams JOIN windows USING (size, gram)),
hit AS (SELECT doc_id, count(DISTINCT i) AS n_hit FROM (SELECT doc_id, unnest(range(k, k + size)) AS i FROM found) GROUP BY doc_id),
items AS (SELECT doc_id, count(*) AS n_items, string_agg(name, ',' ORDER BY name) AS names FROM (SELECT DISTINCT doc_id, item_id::VARCHAR AS name FROM found) GROUP BY doc_id)
SELECT doc_id, len(w) AS n_words, coalesce(n_hit, 0) AS n_hit, coalesce(n_items, 0) AS n_items,
       sha256(coalesce(names, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AS contaminated
FROM d LEFT JOIN hit USING (doc_id) LEFT JOIN items USING (doc_id)
""".replace("UPPER", UPPER).replace("LOWER", LOWER).replace("WORD", WORD)

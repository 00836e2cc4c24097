"""Which tokens of two vocabularies say the same: alignment by byte offsets, anchored at spaces.

Each text is encoded in full by both tokenizers and the bytes of either's tokens are compared
with the text's. Where tokens that begin with a space start at one byte offset in both, the
tokens before them end together: these anchors cut a document into windows, short tuples of
token ids of either side. A window is aligned by walking the ends of its tokens, once for each
distinct pair of id tuples: windows are found, numbered and put together again by Arrow and
numpy, and a cache of bounded size remembers what a window came to.

Links are the pairs of tokens whose byte ranges end together, one at the end of each group. How
often a pair is linked in the whole corpus is counted by a plain aggregation; the frequent pairs
go to all tasks in a table of bounded size, the others meet their counts by a shuffle.

Rules for odd input: null and empty texts, and texts that either side's tokens do not spell byte
by byte (U+2581 is one such case), have no tokens. Rows are told apart by themselves, so ids may
be null or repeat; tables may be empty; other columns are untouched.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.functions import arrow_udf

from .pieces import PieceCache, by_kind, encode_pieces, flat_ids, from_flat, text_runs
from .shared import released, written
from .suffixes import spread
from .token_blocks import ByteLevelEncoder

SPACE = "\u2581"
#: pieces of a text that no token of the other vocabulary reaches beyond
SPACED = r" *[^ \n]+| +|\n"
#: pairs whose counts are broadcast; all others are joined by a shuffle
PAIRS_SENT = 500_000


class ByteTokens(ByteLevelEncoder):
    """A byte-level vocabulary of the tokenizers library; special tokens in a text are text."""

    def __init__(self, path: str):
        super().__init__(path)
        self.tokenizer.encode_special_tokens = True
        self.special = []
        own = [*range(33, 127), *range(161, 173), *range(174, 256)]
        rest = [b for b in range(256) if b not in own]
        byte = {chr(b): b for b in own} | {chr(256 + k): b for k, b in enumerate(rest)}
        label = self.tokenizer.id_to_token
        self.bytes = pa.array([bytes(byte[c] for c in label(i) or "") for i in range(self.tokenizer.get_vocab_size())], pa.binary())


class PieceTokens:
    """A vocabulary of the sentencepiece library that puts a space before the text.

    If no token goes on beyond a space that follows something else, and none holds a line feed,
    a text is cut there and each distinct piece is encoded once; texts with the divider in them,
    and all texts with other vocabularies, go through the library as a whole.
    """

    def __init__(self, path: str):
        import sentencepiece

        self.model = sentencepiece.SentencePieceProcessor(model_file=path)
        labels = [self.model.id_to_piece(i) for i in range(self.model.get_piece_size())]
        kind = [self.model.is_byte(i) for i in range(len(labels))]
        spelt = [bytes([int(s[3:5], 16)]) if b else s.replace(SPACE, " ").encode() for s, b in zip(labels, kind, strict=True)]
        self.bytes = pa.array(spelt, pa.binary())
        feed = self.model.encode("\n\n")
        whole = all(SPACE not in s.lstrip(SPACE) for s in labels) and not any("\n" in s for s in labels)
        self.divider = feed[-1] if whole and feed[-2:] == [feed[-1]] * 2 and spelt[feed[-1]] == b"\n" else None
        self.pieces = PieceCache(200_000)

    def _by_library(self, pieces: list[str]) -> list[bytes]:
        """Distinct pieces, many at a time, with a line feed before each."""
        out: list[bytes] = []
        for i in range(0, len(pieces), 4096):
            ids = np.array(self.model.encode("".join(["\n" + ("." if p == "\n" else p) for p in pieces[i : i + 4096]])), "<u4")
            cuts = np.append(np.flatnonzero(ids == self.divider), len(ids)).tolist()
            data = ids.tobytes()
            out += [data[4 * a + 4 : 4 * b] for a, b in zip(cuts[:-1], cuts[1:], strict=True)]
        if "\n" in pieces:
            out[pieces.index("\n")] = np.array([self.divider], "<u4").tobytes()
        return out

    def _distinct(self, pieces: pa.Array) -> pa.Array:
        return pa.array(self.pieces.look_up(pieces.to_pylist(), self._by_library), pa.binary())

    def _cut(self, texts: pa.Array) -> pa.Array:
        return encode_pieces(pc.split_pattern(pc.replace_substring_regex(texts, SPACED, "\\0\x1f"), "\x1f"), self._distinct)

    def _whole(self, texts: pa.Array) -> pa.Array:
        return pa.array([np.array(self.model.encode(t[1:]), "<u4").tobytes() for t in texts.to_pylist()], pa.binary())

    def encode_array(self, texts: pa.Array) -> pa.Array:
        """The ids of texts that begin with the space that the library would put there."""
        cut = pc.invert(pc.match_substring(texts, "\x1f")) if self.divider is not None else pa.array(np.zeros(len(texts), bool))
        return by_kind(texts, cut, self._cut, self._whole)


@dataclass
class Side:
    """The tokens of one vocabulary for many texts, one after another."""

    ids: np.ndarray
    bounds: np.ndarray
    sizes: np.ndarray

    def only(self, held: np.ndarray) -> Side:
        """Those of some of the texts."""
        n = np.diff(self.bounds)
        stays = np.repeat(held, n)
        return Side(self.ids[stays], np.concatenate([[0], np.cumsum(n[held])]), self.sizes[stays])


def _text_bytes(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    ends = np.frombuffer(texts.buffers()[1], np.int32)[texts.offset : texts.offset + len(texts) + 1].astype(np.int64)
    data = texts.buffers()[2]
    return (np.frombuffer(data, np.uint8)[ends[0] : ends[-1]] if data else np.empty(0, np.uint8)), ends - ends[0]


class Aligner:
    def __init__(self, a_path: str, b_path: str):
        self.a, self.b = ByteTokens(a_path), PieceTokens(b_path)
        self.size = [pc.binary_length(x.bytes).to_numpy().astype(np.int64) for x in (self.a, self.b)]
        self.spaced = [pc.starts_with(x.bytes, b" ").to_numpy(zero_copy_only=False) for x in (self.a, self.b)]
        self.windows = PieceCache(200_000, longest=256)
        # the ids as they stand in a group's text, by what follows
        words = [[str(i) for i in range(len(n))] for n in self.size]
        self.told = pa.array([w + x for w_, xs in zip(words, (",|", (",", ";", "")), strict=True) for x in xs for w in w_])

    def _side(self, which: int, texts: pa.Array) -> Side:
        ids, bounds = flat_ids((self.a, self.b)[which].encode_array(texts))
        return Side(ids, bounds, self.size[which][ids])

    def _spells(self, which: int, side: Side, texts: pa.Array) -> np.ndarray:
        """Which texts the bytes of their tokens are."""
        data, ends = _text_bytes(texts)
        sums = np.concatenate([[0], np.cumsum(side.sizes)])
        same = np.diff(sums[side.bounds]) == np.diff(ends)
        if not same.all():
            data, ends = _text_bytes(texts.filter(pa.array(same)))
            side = side.only(same)
        spelt = (self.a, self.b)[which].bytes.take(pa.array(side.ids))
        wrong = np.flatnonzero(_text_bytes(spelt)[0] != data)
        if len(wrong):
            same[np.flatnonzero(same)[np.unique(np.searchsorted(ends, wrong, "right") - 1)]] = False
        return same

    def _align(self, windows: list[bytes]) -> list[tuple[str, bytes]]:
        """groups as text and links as pairs of ids, for windows given as the number of A's ids,
        these, and B's: all windows are walked at once, one after another."""
        flat = np.frombuffer(b"".join(windows), "<u4")
        sizes = np.fromiter(map(len, windows), np.int64, len(windows)) // 4
        starts = np.cumsum(sizes) - sizes
        n_a = flat[starts].astype(np.int64)
        n_b = sizes - 1 - n_a
        a, b = flat[spread(starts + 1, n_a)].astype(np.int64), flat[spread(starts + 1 + n_a, n_b)].astype(np.int64)
        end_a, end_b = np.cumsum(self.size[0][a]), np.cumsum(self.size[1][b])
        marks = np.zeros(end_a[-1] + 1, np.uint8)
        marks[end_a] = 1
        marks[end_b] |= 2
        last_a, last_b = marks[end_a] == 3, marks[end_b] == 3  # in their groups
        # in the text a group's tokens of A stand before those of B, each with what follows it
        a_before, b_before = np.append(0, np.flatnonzero(last_a) + 1), np.append(0, np.flatnonzero(last_b) + 1)
        told = np.empty(len(a) + len(b), np.int64)
        told[np.arange(len(a)) + b_before[np.cumsum(last_a) - last_a]] = a + len(self.size[0]) * last_a
        follows = last_b.astype(np.int64)
        follows[np.cumsum(n_b) - 1] = 2
        told[np.arange(len(b)) + a_before[np.cumsum(last_b) - last_b + 1]] = 2 * len(self.size[0]) + b + len(self.size[1]) * follows
        ends = np.concatenate([[0], np.cumsum(n_a + n_b)])
        texts = pc.binary_join(pa.ListArray.from_arrays(pa.array(ends, pa.int32()), self.told.take(pa.array(told))), "").to_pylist()
        links = np.stack([a[last_a], b[last_b]], axis=1).astype("<u4").tobytes()
        cuts = (8 * np.concatenate([[0], np.cumsum(last_a)])[np.concatenate([[0], np.cumsum(n_a)])]).tolist()
        return [(t, links[x:y]) for t, x, y in zip(texts, cuts[:-1], cuts[1:], strict=True)]

    def _windows(self, a: Side, b: Side, ends: np.ndarray) -> tuple[pa.DictionaryArray, np.ndarray]:
        """The windows of all texts, and the bounds of each text's. ``ends``: of the texts' bytes."""
        marks = np.zeros(ends[-1] + 1, np.uint8)
        starts = [np.cumsum(x.sizes) - x.sizes for x in (a, b)]
        for k, (side, start) in enumerate(zip((a, b), starts, strict=True)):
            marks[start[self.spaced[k][side.ids]]] |= 1 << k
        marks[ends] = 3
        anchors = np.flatnonzero(marks == 3)
        at_a, at_b = (np.searchsorted(start, anchors) for start in starts)
        n_a, n_b, n = np.diff(at_a), np.diff(at_b), len(anchors) - 1
        bounds = at_a + at_b + np.arange(n + 1)
        flat = np.empty(bounds[-1], np.uint32)
        flat[bounds[:-1]] = n_a
        flat[spread(bounds[:-1] + 1, n_a)] = a.ids
        flat[spread(bounds[:-1] + 1 + n_a, n_b)] = b.ids
        return from_flat(flat, bounds).dictionary_encode(), np.searchsorted(anchors, ends)

    def describe(self, texts: pa.Array) -> pa.StructArray:
        given = pc.greater(pc.binary_length(texts), 0).to_numpy(zero_copy_only=False)
        spaced = pc.binary_join_element_wise(pa.scalar(" "), texts.filter(pa.array(given)), "")
        a, b = self._side(0, spaced), self._side(1, spaced)
        held = self._spells(0, a, spaced) & self._spells(1, b, spaced)
        if not held.all():
            a, b, spaced = a.only(held), b.only(held), spaced.filter(pa.array(held))
        place = np.full(len(texts), len(spaced), np.int64)  # where a text's values are; the last are those of none
        place[np.flatnonzero(given)[held]] = np.arange(len(spaced))
        _, ends = _text_bytes(spaced)
        windows, bounds = self._windows(a, b, ends)
        known = self.windows.look_up(windows.dictionary.to_pylist(), self._align)
        which = windows.indices
        groups = pc.binary_join(pa.ListArray.from_arrays(pa.array(bounds, pa.int32()), pa.array([g for g, _ in known], pa.string()).take(which)), ";")
        pairs, cuts = flat_ids(pa.array([x for _, x in known], pa.binary()).take(which))
        links = np.diff(cuts[bounds]) // 2
        text = np.repeat(np.arange(len(spaced)), links)
        pairs = pairs.reshape(-1, 2).astype(np.int64)
        n_b = len(self.size[1])
        found, times = np.unique((text * len(self.size[0]) + pairs[:, 0]) * n_b + pairs[:, 1], return_counts=True)
        head, tail = np.divmod(found, n_b)
        text, head = np.divmod(head, len(self.size[0]))
        kinds = np.bincount(text, minlength=len(spaced))
        entries = pa.StructArray.from_arrays([pa.array(x.astype(np.int32)) for x in (head, tail, times)], fields=list(LINK))
        listed = pa.ListArray.from_arrays(pa.array(np.concatenate([[0], np.cumsum(kinds)]), pa.int32()), entries)
        counts = [np.append(np.diff(x), 0) for x in (a.bounds, b.bounds)] + [np.append(links, 0)]
        groups = pa.concat_arrays([groups, pa.array([""])])
        listed = pa.concat_arrays([listed, pa.array([[]], listed.type)])
        return pa.StructArray.from_arrays([*(pa.array(x) for x in counts), groups, listed], fields=list(ALIGNED)).take(pa.array(place))


LINK = pa.struct([("a", pa.int32()), ("b", pa.int32()), ("n", pa.int32())])
ALIGNED = pa.struct([("n_a", pa.int64()), ("n_b", pa.int64()), ("n_groups", pa.int64()), ("groups", pa.string()), ("links", pa.list_(LINK))])
_ALIGNERS: dict[tuple[str, str], Aligner] = {}


def aligned(text: Column, a_path: str, b_path: str) -> Column:
    """struct<n_a, n_b, n_groups, groups, links: array<struct<a, b, n>>> of a text.

    groups: ids between shared ends, as ``a1,a2|b1;a3|b2,b3``; links: the distinct pairs of ids
    whose tokens end together, each with how often they do in this text."""

    @arrow_udf("n_a bigint, n_b bigint, n_groups bigint, groups string, links array<struct<a: int, b: int, n: int>>")
    def described(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        own = _ALIGNERS.get((a_path, b_path)) or _ALIGNERS.setdefault((a_path, b_path), Aligner(a_path, b_path))
        for batch in batches:
            parts = [own.describe(run) for run in text_runs(batch, 2 << 20)]
            yield pa.concat_arrays(parts) if parts else pa.array([], ALIGNED)
        released()

    return described(text)


def link_counts(links: DataFrame) -> DataFrame:
    """a, b, count: how often a pair is linked in all texts; best: whether no other pair of the
    same b is linked more often. ``links``: a, b, n."""
    counted = written(links.groupBy("a", "b").agg(F.sum("n").alias("count")), "link-counts")
    top = counted.groupBy("b").agg(F.max("count").alias("top"))
    return counted.join(top, "b").select("a", "b", "count", (F.col("count") == F.col("top")).alias("best"))


def with_counts(links: DataFrame, counts: DataFrame, sent: int = PAIRS_SENT) -> DataFrame:
    """``links`` with the columns of ``counts``. The most frequent pairs, at most ``sent``, are
    broadcast, so none of those left to the shuffle is a hot key."""
    n = counts.count()
    if n <= sent:
        return links.join(F.broadcast(counts), ["a", "b"])
    head = written(counts.orderBy(F.col("count").desc(), "a", "b").limit(sent), "frequent-links")
    tail = counts.join(F.broadcast(head.select("a", "b")), ["a", "b"], "left_anti")
    rare = links.join(F.broadcast(head.select("a", "b")), ["a", "b"], "left_anti")
    return links.join(F.broadcast(head), ["a", "b"]).unionByName(rare.join(tail, ["a", "b"]))


def alignments(docs: DataFrame, a_path: str, b_path: str, sent: int = PAIRS_SENT) -> DataFrame:
    """doc_id, n_a, n_b, n_groups, n_links, n_best, count_sum, groups_sha256 of each document."""
    found = docs.select("doc_id", aligned(F.col("text"), a_path, b_path).alias("x"))
    digest = F.when(F.col("x.n_a") > 0, F.sha2("x.groups", 256)).otherwise(F.lit(""))
    columns = [F.col(f"x.{c}").alias(c) for c in ("n_a", "n_b", "n_groups", "links")]
    rows = written(found.select(F.monotonically_increasing_id().alias("row"), "doc_id", *columns, digest.alias("groups_sha256")), "alignments")
    links = rows.select("row", F.explode("links").alias("l")).select("row", "l.a", "l.b", "l.n")
    counts = written(link_counts(links), "links")
    n = F.col("n").cast("long")
    sums = with_counts(links, counts, sent).groupBy("row").agg(F.sum(n).alias("n_links"), F.sum(F.when(F.col("best"), n)).alias("n_best"), F.sum(n * F.col("count")).alias("count_sum"))
    both = rows.drop("links").join(sums, "row", "left")
    filled = [F.coalesce(c, F.lit(0)).cast("long").alias(c) for c in ("n_links", "n_best", "count_sum")]
    return both.select("doc_id", "n_a", "n_b", "n_groups", *filled, "groups_sha256")

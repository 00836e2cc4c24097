"""Periodic runs of words, by uniting classes of suffixes in descending order of their LCP.

The suffixes of a text's words are sorted and neighbours are linked by the length of their
common prefix. Links are taken from the longest down: each joins two classes of suffixes by
union-find, and a class keeps its positions in order. When two positions p < q become neighbours
in a class at prefix length L and q - p <= L, the words from p to q + L have the period q - p.
Every maximal repetition is found that way from its first word, with its smallest period; seeds
that one more word to the left would prolong are no starts and go.

Runs shorter than ``least`` words need no suffix whose common prefix is below half of that, so
the symbols that are sorted are the stretches of so many words: one sort leaves nearly all
positions of ordinary text alone, and only repeated ones go on to doubling and to union-find.

Rules for odd input: null and empty texts, and texts of white space alone, have no words, no
runs and the empty collapsed text. Repeated rows and ids do not matter, as each text is read by
itself; tables may be empty; other columns are untouched.
"""

from __future__ import annotations

from bisect import bisect_left
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.functions import arrow_udf

from .pieces import text_runs
from .shared import WORD, released
from .suffixes import common_prefixes, sorted_suffixes, spread, words_of

FACTORS = (0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9, 0xD6E8FEB86659FD93)


def _stretches(ids: np.ndarray, text: np.ndarray, span: int, factor: int) -> np.ndarray:
    """A 64-bit key for the ``span`` words from each position, and for the text they are in."""
    key = text.astype(np.uint64) + np.uint64(1)
    padded = np.concatenate([ids, np.zeros(span, ids.dtype)]).astype(np.uint64)
    for k in range(span):
        key = (key ^ (key >> np.uint64(29))) * np.uint64(factor) + padded[k : k + len(ids)]
    return (key ^ (key >> np.uint64(32))) * np.uint64(factor)


def _seeds(order: np.ndarray, first: np.ndarray, second: np.ndarray, shared: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Positions p, q and prefix lengths at which p and q become neighbours in a class within
    that length. ``first``, ``second``: linked positions; ``shared``: their LCP."""
    places = np.unique(np.concatenate([first, second]))
    by_length = np.argsort(-shared, kind="stable")
    left, right = np.searchsorted(places, first[by_length]).tolist(), np.searchsorted(places, second[by_length]).tolist()
    home = list(range(len(places)))
    members = [[p] for p in places.tolist()]
    found: list[tuple[int, int, int]] = []
    for x, y, length in zip(left, right, shared[by_length].tolist(), strict=True):
        while home[x] != x:
            home[x] = x = home[home[x]]
        while home[y] != y:
            home[y] = y = home[home[y]]
        large, small = members[x], members[y]
        if len(large) < len(small):
            x, y, large, small = y, x, small, large
        home[y] = x
        members[y] = None
        # what becomes a neighbour: between two of the small class lies one of the large, or not
        spots = [bisect_left(large, p) for p in small]
        last = len(small) - 1
        for k, (p, spot) in enumerate(zip(small, spots, strict=True)):
            if spot and (not k or spots[k - 1] < spot) and p - large[spot - 1] <= length:
                found.append((large[spot - 1], p, length))
            if spot < len(large) and (k == last or spots[k + 1] > spot) and large[spot] - p <= length:
                found.append((p, large[spot], length))
        for p, spot in zip(reversed(small), reversed(spots), strict=True):
            large.insert(spot, p)
    table = np.array(found, np.int64).reshape(-1, 3)
    return table[:, 0], table[:, 1], table[:, 2]


def runs_of(ids: np.ndarray, bounds: np.ndarray, least: int) -> np.ndarray:
    """The runs of many texts as rows (text, start, length, period), in this order.

    ``ids``: numbers of the words of all texts; ``bounds``: where each text starts, and the end.
    """
    if least < 3:
        raise ValueError("runs have three words at least")
    span = (least + 1) // 2
    n_words = np.diff(bounds)
    none = np.empty((0, 4), np.int64)
    if not len(ids):
        return none
    text = np.repeat(np.arange(len(n_words)), n_words)
    # no stretch starts in the last words of a text
    alone = np.arange(len(ids)) + span > np.repeat(bounds[1:], n_words)
    for factor in FACTORS:
        order, ranks = sorted_suffixes(_stretches(ids, text, span, factor), alone)
        linked = ranks[0][order[1:]] == ranks[0][order[:-1]]
        first, second = order[:-1][linked], order[1:][linked]
        same = text[first] == text[second]
        for k in range(span):
            same &= ids[first + k] == ids[second + k]
        if same.all():
            break
    else:
        raise RuntimeError("stretches of words could not be told apart")
    if not len(first):
        return none
    p, q, length = _seeds(order, first, second, common_prefixes(ranks, first, second) + span - 1)
    starts = bounds[text[p]]
    whole = q - p + length
    longer = (p > starts) & (ids[p - 1] == ids[q - 1])
    held = ~longer & (whole >= least)
    rows = np.stack([text[p], p - starts, whole, q - p], axis=1)[held]
    return rows[np.lexsort((rows[:, 3], rows[:, 1], rows[:, 0]))]


def _kept(bounds: np.ndarray, runs: np.ndarray) -> np.ndarray:
    """Which words stay when of every run only its first period does."""
    steps = np.zeros(bounds[-1] + 1, np.int64)
    starts = bounds[runs[:, 0]] + runs[:, 1]
    np.add.at(steps, starts + runs[:, 3], 1)
    np.add.at(steps, starts + runs[:, 2], -1)
    return np.cumsum(steps[:-1]) == 0


RUN = pa.struct([("start", pa.int64()), ("length", pa.int64()), ("period", pa.int64())])


def _described(texts: pa.Array, least: int) -> pa.StructArray:
    words, bounds = words_of(pc.ascii_split_whitespace(texts))
    ids = words.dictionary_encode().indices.to_numpy()
    runs = runs_of(ids, bounds, least)
    held = np.bincount(runs[:, 0], minlength=len(texts))
    entries = pa.StructArray.from_arrays([pa.array(runs[:, k]) for k in (1, 2, 3)], fields=list(RUN))
    listed = pa.ListArray.from_arrays(pa.array(np.concatenate([[0], np.cumsum(held)]), pa.int32()), entries)
    if len(runs):
        stays = _kept(bounds, runs)
        words, bounds = words.filter(pa.array(stays)), np.concatenate([[0], np.cumsum(stays)])[bounds]
    collapsed = pc.binary_join(pa.ListArray.from_arrays(pa.array(bounds, pa.int32()), words), " ")
    return pa.StructArray.from_arrays([listed, collapsed], ["runs", "collapsed"])


def repetitions(text: Column, least: int = 12) -> Column:
    """struct<runs: array<struct<start, length, period>>, collapsed> of a text's words.

    runs: every maximal stretch of words with smallest period q and at least max(least, 2 q)
    words, by start, then period. collapsed: the words that are not in a run after its first q
    words, joined by a space.
    """
    kind = "runs array<struct<start: bigint, length: bigint, period: bigint>>, collapsed string"

    @arrow_udf(kind)
    def described(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        empty = pa.array([], pa.struct([("runs", pa.list_(RUN)), ("collapsed", pa.string())]))
        for batch in batches:
            parts = [_described(run, least) for run in text_runs(batch)]
            yield pa.concat_arrays(parts) if parts else empty
        released()

    return described(text)


def collapse(docs: DataFrame, text_col: str = "text", least: int = 12) -> DataFrame:
    """``docs`` with texts in which periodic runs are cut to their first period: white space
    becomes one space in those, all other texts stay as they are."""
    row = F.struct(*[F.col(f"`{c}`") for c in docs.columns])
    held = docs.select(row.alias("row")).select("row", repetitions(F.col("row")[text_col], least).alias("found"))
    text = F.when(F.size("found.runs") > 0, F.col("found.collapsed")).otherwise(F.col("row")[text_col])
    return held.select(*[(text if c == text_col else F.col("row")[c]).alias(c) for c in docs.columns])


def planted(docs: DataFrame) -> DataFrame:
    """doc_id, text: of every tenth document (by the checksum of its id) the words from a
    position on repeat with a period, both taken from that checksum; other texts are as given."""
    h = F.crc32(F.col("doc_id").cast("string").cast("binary"))
    g = F.floor(h / 10)
    words = F.regexp_extract_all(F.col("text"), F.lit(f"({WORD})"), F.lit(1))
    rows = docs.select("doc_id", "text", F.when(h % 10 == 0, words).alias("words"), g.alias("g"))
    n = F.size("words")
    rows = rows.withColumn("n", n).withColumn("a", F.when(n > 0, F.pmod("g", F.nullif(n, F.lit(0))).cast("int")))
    left = F.col("n") - F.col("a")
    rows = rows.withColumn("p", F.when(F.col("n") > 0, (1 + F.floor(left / (3 + F.col("g") % 8))).cast("int")))
    period = F.slice("words", F.col("a") + 1, F.col("p"))
    times = F.ceil(left / F.col("p")).cast("int")
    tail = F.slice(F.flatten(F.array_repeat(period, times)), F.lit(1), left)
    text = F.array_join(F.concat(F.slice("words", F.lit(1), F.col("a")), tail), " ")
    return rows.select("doc_id", F.when(F.col("n") > 0, text).otherwise(F.col("text")).alias("text"))


def digest_columns(rows: DataFrame) -> DataFrame:
    """doc_id, n_runs, the longest run, and digests of all runs and of the collapsed text."""
    runs = F.col("found.runs")
    longest = F.array_max(F.transform(runs, lambda r: F.struct(r["length"].alias("length"), (-r["start"]).alias("start"), (-r["period"]).alias("period"))))
    lines = F.transform(runs, lambda r: F.concat_ws(",", r["start"], r["length"], r["period"]))
    out = rows.select("doc_id", F.size(runs).cast("long").alias("n_runs"), longest.alias("best"), F.array_join(F.transform(lines, lambda x: F.concat(x, F.lit("\n"))), "").alias("lines"), F.col("found.collapsed").alias("collapsed"))
    start, length, period = (-F.col("best.start")), F.col("best.length"), (-F.col("best.period"))
    return out.select(
        "doc_id", "n_runs", start.alias("start"), length.alias("length"), period.alias("period"),
        F.expr("(1000 * best.length) div (-best.period)").alias("exponent_milli"),
        F.sha2("lines", 256).alias("runs_sha256"), F.sha2("collapsed", 256).alias("collapsed_sha256"),
    )


ORACLE = r"""
WITH RECURSIVE bits(b, v, k) AS (
  SELECT range, range, 0 FROM range(256)
  UNION ALL SELECT b, xor(v >> 1, CASE WHEN v & 1 = 1 THEN 3988292384 ELSE 0 END), k + 1 FROM bits WHERE k < 8),
table_of AS (SELECT list(v ORDER BY b) AS t FROM bits WHERE k = 8),
hashed AS (
  SELECT doc_id, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS w,
         xor(list_reduce(list_prepend(4294967295::BIGINT, list_transform(string_split(doc_id::VARCHAR, ''), lambda c: ascii(c)::BIGINT)),
                         lambda s, c: xor(s >> 8, t[1 + (xor(s, c) & 255)])), 4294967295) AS h
  FROM documents, table_of),
cut AS (SELECT doc_id, w, len(w) AS n, h, h // 10 AS g, CASE WHEN len(w) > 0 THEN (h // 10) % len(w) END AS a FROM hashed),
planted AS (SELECT *, 1 + (n - a) // (3 + g % 8) AS p FROM cut),
texts AS (
  SELECT doc_id, n, CASE WHEN h % 10 = 0 AND n > 0 THEN list_transform(range(n), lambda i: CASE WHEN i < a THEN w[i + 1] ELSE w[1 + a + (i - a) % p] END) ELSE w END AS w
  FROM planted),
words AS (SELECT doc_id, unnest(range(n)) AS i, unnest(w) AS word FROM texts WHERE n > 0),
grams AS (SELECT doc_id, unnest(range(n - 5)) AS i, unnest(list_transform(range(n - 5), lambda i: array_to_string(w[i + 1:i + 6], ' '))) AS gram FROM texts WHERE n > 5),
matches AS (SELECT x.doc_id, x.i, y.i - x.i AS q FROM grams x JOIN grams y ON x.doc_id = y.doc_id AND x.gram = y.gram AND x.i < y.i),
islands AS (SELECT *, i - row_number() OVER (PARTITION BY doc_id, q ORDER BY i) AS island FROM matches),
stretches AS (SELECT doc_id, q, min(i) AS s, count(*) + 5 + q AS l FROM islands GROUP BY doc_id, q, island HAVING count(*) + 5 >= q AND count(*) + 5 + q >= 12),
runs AS (SELECT * FROM stretches x WHERE NOT EXISTS (SELECT 1 FROM stretches y WHERE y.doc_id = x.doc_id AND y.q < x.q AND y.s <= x.s AND y.s + y.l >= x.s + x.l)),
listed AS (
  SELECT doc_id, count(*) AS n_runs, string_agg(s || ',' || l || ',' || q || chr(10), '' ORDER BY s, q) AS lines,
         min({'l': -l, 's': s, 'q': q}) AS best
  FROM runs GROUP BY doc_id),
gone AS (SELECT DISTINCT doc_id, unnest(range(s + q, s + l)) AS i FROM runs),
collapsed AS (SELECT doc_id, string_agg(word, ' ' ORDER BY i) AS text FROM words ANTI JOIN gone USING (doc_id, i) GROUP BY doc_id)
SELECT t.doc_id, coalesce(n_runs, 0) AS n_runs, best.s AS start, -best.l AS length, best.q AS period, 1000 * -best.l // best.q AS exponent_milli,
       sha256(coalesce(lines, '')) AS runs_sha256, sha256(coalesce(c.text, '')) AS collapsed_sha256
FROM texts t LEFT JOIN listed USING (doc_id) LEFT JOIN collapsed c USING (doc_id)
"""

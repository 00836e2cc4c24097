"""Periodic runs, verbatim passages and token alignment against brute force, and odd input."""

import random
import re

import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from carbonsieve.llm import period_runs, suffix_search, token_alignment
from carbonsieve.llm.suffixes import common_prefixes, sorted_suffixes

A, B = public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.path("piece_bpe_32k.model")


def test_sorted_suffixes_and_common_prefixes():
    rng = random.Random(1)
    for _ in range(200):
        n = rng.randrange(1, 60)
        keys = np.array([rng.randrange(1, 4) for _ in range(n)])
        alone = np.array([rng.random() < 0.1 for _ in range(n - 1)] + [True])
        keys[alone] = 0
        order, ranks = sorted_suffixes(keys, alone)
        # symbols that are alone differ, in the order in which they were put
        place = {p: k for k, p in enumerate(order.tolist())}
        symbols = [(0, place[i]) if alone[i] else (int(k), 0) for i, k in enumerate(keys)]
        assert order.tolist() == sorted(range(n), key=lambda i: symbols[i:])
        shared = lambda i, j: next(k for k in range(n) if symbols[i + k] != symbols[j + k])  # noqa: B023, E731
        assert common_prefixes(ranks, order[:-1], order[1:]).tolist() == [shared(i, j) for i, j in zip(order[:-1].tolist(), order[1:].tolist(), strict=True)]


def plain_runs(words, least):
    n, found = len(words), []
    for q in range(1, n // 2 + 1):
        i = 0
        while i + q < n:
            j = i
            while j + q < n and words[j] == words[j + q]:
                j += 1
            if j > i and j - i + q >= max(least, 2 * q):
                found.append((i, j - i + q, q))
            i = max(j, i + 1)
    smaller = lambda i, size, q: any(all(words[k] == words[k + p] for k in range(i, i + size - p)) for p in range(1, q))
    return sorted((r for r in found if not smaller(*r)), key=lambda r: (r[0], r[2]))


def test_runs_equal_brute_force():
    rng = random.Random(2)
    for _ in range(400):
        least = rng.choice([3, 4, 7, 12])
        texts = []
        for _ in range(rng.randrange(1, 5)):
            n = rng.randrange(0, 60)
            words = [rng.randrange(rng.randrange(1, 4)) for _ in range(n)]
            if n and rng.random() < 0.5:
                a, p = rng.randrange(n), rng.randrange(1, 8)
                words = [words[i] if i < a else words[min(n - 1, a + (i - a) % p)] for i in range(n)]
            texts.append(words)
        bounds = np.concatenate([[0], np.cumsum([len(t) for t in texts])]).astype(np.int64)
        got = period_runs.runs_of(np.array([w for t in texts for w in t], np.int32), bounds, least)
        assert [tuple(r) for r in got.tolist()] == [(k, *r) for k, t in enumerate(texts) for r in plain_runs(t, least)]


def test_runs_of_odd_texts(spark):
    rows = [(1, None), (1, ""), (None, " \t\n\x0b\x0c\r "), (2, "a  b\n" * 6), (2, "x " + "é " * 50_000), (3, "x\xa0y " * 11), (4, "one two")]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    got = [tuple(r) for r in docs.select(period_runs.repetitions(F.col("text")).alias("f")).select("f.runs", "f.collapsed").collect()]
    assert got == [([], ""), ([], ""), ([], ""), ([(0, 12, 2)], "a b"), ([(1, 50_000, 1)], "x é"), ([], " ".join(["x\xa0y"] * 11)), ([], "one two")]
    assert docs.limit(0).select(period_runs.repetitions(F.col("text")).alias("f")).count() == 0


def test_collapse_keeps_other_columns_and_texts(spark):
    docs = spark.createDataFrame([("r", "a b " * 9, "f", 1), (None, " a  b ", None, 2)], "row string, text string, found string, `runs.x` int")
    assert [tuple(r) for r in period_runs.collapse(docs).collect()] == [("r", "a b", "f", 1), (None, " a  b ", None, 2)]


def test_planted_periods(spark):
    rows = [(i, " ".join(f"w{k}" for k in range(i % 40))) for i in range(200)] + [(5, None), (None, "a b")]
    got = sorted((tuple(r) for r in period_runs.planted(spark.createDataFrame(rows, "doc_id long, text string")).collect()), key=str)
    want, changed = [], 0
    import zlib

    for i, t in rows:
        h = zlib.crc32(str(i).encode()) if i is not None else 1
        words = (t or "").split()
        if h % 10 == 0 and words:
            g, n = h // 10, len(words)
            a = g % n
            p = 1 + (n - a) // (3 + g % 8)
            t = " ".join(words[k] if k < a else words[a + (k - a) % p] for k in range(n))
            changed += 1
        want.append((i, t))
    assert got == sorted(want, key=str) and changed > 9


def words_of(text):
    return re.findall(suffix_search.WORD, "".join(c.lower() if "A" <= c <= "Z" else c for c in text or ""))


def plain_matches(text, items, window):
    """n_words, words in a window, and (item, word of item, word, words) of longest matches."""
    w, hit, found = words_of(text), set(), set()
    for name, t in items:
        x = words_of(t)
        m = min(window, len(x))
        for k in range(len(x) - m + 1 if m else 0):
            for p in range(len(w) - m + 1):
                if w[p : p + m] == x[k : k + m]:
                    hit |= set(range(p, p + m))
                    if k == 0 or p == 0 or w[p - 1] != x[k - 1]:
                        size = m
                        while p + size < len(w) and k + size < len(x) and w[p + size] == x[k + size]:
                            size += 1
                        found.add((name, k, p, size))
    return len(w), len(hit), found


@pytest.mark.parametrize("block_words", [1, 6, 10_000])
def test_matches_equal_brute_force(spark, block_words, monkeypatch):
    monkeypatch.setattr(suffix_search, "PAIRS_OPEN", 3)
    rng = random.Random(block_words)
    say = lambda n: "".join(rng.choice(["a", "b", "Ca", "é1", "x2"]) + rng.choice([" ", ", ", "\n", "--"]) for _ in range(n))
    items = [(rng.choice(["i1", "i2", None, f"j{k}"]), say(rng.randrange(0, 12))) for k in range(14)] + [("n", None), ("e", ""), ("s", " -- ")]
    docs = [(k % 50, say(rng.randrange(0, 40)) + rng.choice(items)[1].__str__()) for k in range(80)] + [(None, None), (7, ""), (8, "Ca " * 3000)]
    items_table = spark.createDataFrame(items, "item_id string, text string")
    blocks = suffix_search.item_blocks(items_table, block_words=block_words)
    assert len(blocks) > 1 or block_words == 10_000
    found = suffix_search.searched(F.col("text"), blocks, 3)
    got = spark.createDataFrame(docs, "doc_id long, text string").select(found.alias("f")).select("f.*").collect()
    for (_, t), r in zip(docs, got, strict=True):
        assert (r["n_words"], r["n_hit"], {tuple(m) for m in r["matches"]}) == plain_matches(t, items, 3)


def test_affected_documents_go(spark):
    items = spark.createDataFrame([("q", "one two three four five six seven eight nine ten eleven"), ("short", "only so")], "item_id string, text string")
    nine = "one two three four five six seven eight nine"
    rows = [(1, f"x {nine} ten y", "a"), (2, f"{nine} x", "b"), (3, "ONLY, so!", "c"), (4, None, None), (4, "only so", "d")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, found string").withColumnRenamed("doc_id", "row")
    assert sorted(r["row"] for r in suffix_search.decontaminated(docs, items).collect()) == [2, 4, 4]
    assert suffix_search.decontaminated(docs, items).columns == ["row", "text", "found"]
    assert suffix_search.decontaminated(docs, items.limit(0)).count() == 5 and suffix_search.decontaminated(docs.limit(0), items).count() == 0


ODD = ["", None, " ", "  a  b ", "\n", "a\n\n b \n", "x\x1fy z", "a▁b c", "<|endoftext|> hi <s>", "日本語 テスト 😀", "\x00 a", "é", "a\tb", "x" * 3000, "don't  stop—now…", " \n \n", "\r\n a", "a b", "a c"]


def test_alignment_of_odd_texts(spark):
    from test_queries import byte_spelling, plain_alignment

    spelling = byte_spelling()
    docs = spark.createDataFrame([(t,) for t in ODD], "text string")
    got = docs.coalesce(1).select(token_alignment.aligned(F.col("text"), A, B).alias("x")).select("x.*").collect()
    for t, r in zip(ODD, got, strict=True):
        a, b, groups = plain_alignment(t, spelling)
        assert (r["n_a"], r["n_b"], r["n_groups"]) == (len(a), len(b), len(groups)), t
        assert r["groups"] == ";".join(",".join(map(str, x)) + "|" + ",".join(map(str, y)) for x, y in groups)
        links = [(x[-1], y[-1]) for x, y in groups]
        assert [tuple(x) for x in r["links"]] == sorted((*x, links.count(x)) for x in set(links))
    assert sum(r["n_a"] == 0 for r in got) == 3  # null, empty and U+2581


@pytest.mark.parametrize("sent", [10_000, 3, 0])
def test_counts_of_links_with_any_number_sent(spark, sent):
    rows = [(None, "the cat sat on the mat"), (1, "the cat"), (1, "the cat"), (2, None), (3, "")]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    got = token_alignment.alignments(docs, A, B, sent)
    want = token_alignment.alignments(docs, A, B)
    key = lambda rows: sorted(map(str, rows.collect()))
    assert key(got) == key(want) and got.count() == 5
    top = got.where("doc_id is null").first()
    # the: 4 links in all texts and twice here, cat: 3, and three that occur once
    assert top["n_links"] == top["n_groups"] == 6 and top["count_sum"] == 2 * 4 + 3 + 3
    assert token_alignment.alignments(docs.limit(0), A, B).count() == 0


def test_spellings_that_differ_have_no_tokens():
    own = token_alignment.Aligner(A, B)
    texts = pa.array(["a b", "c d", "e"])
    side = own._side(0, texts)
    side.ids = side.ids.copy()
    side.ids[0] = own._side(0, pa.array(["x"])).ids[0]
    assert own._spells(0, side, texts).tolist() == [False, True, True]


def test_texts_that_share_their_first_words():
    """A text's empty last piece, before a new piece that begins with a space, is no white space."""
    from tokenizers import Tokenizer

    from carbonsieve.llm.token_blocks import ByteLevelEncoder

    own, library = ByteLevelEncoder(A), Tokenizer.from_file(A)
    texts = ["The a", "The b", "The", " b", "", "The\n c"]
    got = [np.frombuffer(x, "<u4").tolist() for x in own.encode_array(pa.array(texts)).to_pylist()]
    assert got == [library.encode(t, add_special_tokens=False).ids for t in texts]

"""Each operator against a plain version on small tables with every kind of odd row."""

import glob
import hashlib
import io
import os
import random
import re
import zlib
from collections import defaultdict

import numpy as np
import public_tokenizers
import pytest
from pyspark.sql import functions as F

from carbonsieve.llm import bpe_automaton, components, exact_dedup, lang_id, mixing, multiset_hash, page_diff, set_sketch, shared, token_blocks, warc, weak_pii

DOCS = "doc_id long, text string, lang string, source string, digest string, n long"
BYTE_BPE, WORD_BPE = public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.path("word_bpe_49k.json")
SF = "/root/testdata/sf0.01"
WORDS = "the of and ing ent for with word le la que un der die das nicht él está año".split()


def text(rng, n):
    return " ".join(rng.choice(WORDS) + rng.choice(["", "", ".", ","]) for _ in range(n))


@pytest.fixture(scope="module")
def rows():
    """Copies, near copies, empty, null and long texts, a hot source, repeated rows."""
    rng = random.Random(11)
    out = []
    for i in range(60):
        out.append([i, text(rng, rng.randrange(1, 60)), rng.choice(["en", "fr", None]), rng.choice(["a", "b", "é", None])])
    hot = text(rng, 50)
    for i in range(60, 90):
        words = hot.split(" ")
        words[rng.randrange(50)] = "changed"
        out.append([i, " ".join(words), "en", "a"])
    for i in range(90, 110):
        out.append([i, hot, "en", "a"])
    out += [[110, None, "en", "a"], [111, "", "fr", None], [112, " \n\t", "en", "b"], [113, "one", "en", "b"], [114, "one", "en", "b"], [115, "123 456 !!", "en", "b"]]
    out += [[116, text(rng, 20000), "en", "c"], [117, "ONE two\nTHREE four", "en", "a"], [118, "one TWO three FOUR", "en", "a"], [118, "one TWO three FOUR", "en", "a"]]
    return [(*r, "clash", 7) for r in out]


@pytest.fixture(scope="module")
def docs(spark, rows):
    return spark.createDataFrame(rows, DOCS).repartition(3)


@pytest.fixture(scope="module")
def none(spark):
    return spark.createDataFrame([], DOCS)


def test_exact_duplicates(spark, docs, rows, none):
    got = [tuple(r) for r in exact_dedup.duplicates(docs).collect()]
    groups = defaultdict(list)
    for r in rows:
        groups[r[1] or ""].append(r[0])
    want = [(i, max(ids), len(ids), i == max(ids), hashlib.sha256(t.encode()).hexdigest()) for t, ids in groups.items() for i in ids]
    assert sorted(got) == sorted(want)
    # a digest of sixteen values: all hits are told apart by their bytes
    weak = exact_dedup.duplicates(docs, digest=lambda c: F.encode(F.substring(F.sha2(c, 256), 1, 1), "UTF-8"))
    assert sorted(map(tuple, weak.collect())) == sorted(want)
    assert exact_dedup.duplicates(none).count() == 0
    kept = exact_dedup.drop_duplicates(docs)
    assert kept.columns == docs.columns and {r["doc_id"] for r in kept.collect()} == {w[0] for w in want if w[3]}


def test_exact_duplicates_null_ids_and_runs(spark):
    df = spark.createDataFrame([(None, "x"), (3, "x"), (None, "y"), (None, "y")], "doc_id long, text string")
    got = sorted(map(str, ((r["doc_id"], r["keep_id"], r["group_size"], r["kept"]) for r in exact_dedup.duplicates(df).collect())))
    assert got == sorted(map(str, [(None, 3, 2, False), (3, 3, 2, True), (None, None, 2, True), (None, None, 2, True)]))
    kept = exact_dedup.drop_duplicates(df.unionByName(df)).collect()
    assert sorted(map(str, map(tuple, kept))) == sorted(map(str, [(3, "x"), (None, "y")]))
    index = exact_dedup.DigestIndex(spark, keep="min")
    for ids in ([5, 6], [2], [9]):
        index.flush(spark.createDataFrame([(i, "same") for i in ids], "doc_id long, text string"))
        index.compact()
        # what was merged is gone: the next compaction reads this run and those after it
        assert [p.split("/")[-1] for p in glob.glob(index.path.removeprefix("file://") + "/*")] == [r.path.split("/")[-1] for r in index.runs] and len(index.runs) == 1
    assert [(r["id"], r["n"]) for r in index.entries().collect()] == [(2, 4)]


@pytest.mark.parametrize("keep", ["min", "max"])
def test_index_of_many_batches(spark, keep):
    """Levels of growing size: what is written stays far below batches times entries, and lookups
    give after every batch what a plain index gives."""
    rng, index, plain, flushed = random.Random(6), exact_dedup.DigestIndex(spark, keep=keep), defaultdict(list), 0
    digest = lambda t: hashlib.sha256(t.encode()).digest()
    batches = 13
    for k in range(batches):
        batch = [(100 * k + i, f"text {rng.randrange(400)}") for i in range(60)]
        index.flush(spark.createDataFrame(batch, "doc_id long, text string").coalesce(2))
        index.settle()
        flushed += len(batch)
        for i, t in batch:
            plain[digest(t)].append(i)
        assert all(sum(r.level == x for r in index.runs) < exact_dedup.FANOUT for x in range(3))
        if k % 4 == 3:
            asked = [digest(f"text {x}") for x in range(0, 500, 7)]
            got = {bytes(r["digest"]): (r["id"], r["n"]) for r in index.lookup(spark.createDataFrame([(d,) for d in asked * 2], "digest binary")).collect()}
            best = min if keep == "min" else max
            assert got == {d: (best(plain[d]), len(plain[d])) for d in asked if d in plain}
    assert {r.level for r in index.runs} == {0, 1} and len(index.runs) == 4
    # each entry was flushed once and merged about once; merging all with every batch would write
    # half the number of batches times as much
    assert index.entries_written <= 2 * flushed < batches / 2 * index.entries().count()
    assert index.entries().count() == len(plain)
    index.compact()
    assert len(index.runs) == 1 and {bytes(r["digest"]): r["n"] for r in index.entries().collect()} == {d: len(ids) for d, ids in plain.items()}


def test_filters_pass_all_that_they_hold(spark, monkeypatch):
    all_rows = spark.range(2000).select(F.unhex(F.sha2(F.col("id").cast("string"), 256)).alias("digest"), "id")
    held = all_rows.where("id < 300")
    for most in (2**29, 2**15, 64):
        monkeypatch.setattr(exact_dedup, "MOST_BITS", most)
        marked = {r["id"]: r["_maybe"] for r in exact_dedup.DigestFilter(held).mark(all_rows).collect()}
        assert len(marked) == 2000 and all(marked[i] for i in range(300))
        assert most < 100 or sum(marked.values()) < 700
    assert not exact_dedup.DigestFilter(held.where("false")).mark(all_rows).where("_maybe").count()


def test_mixing(spark, docs, rows, none):
    got = mixing.plan(docs).collect()
    size = lambda t: len(re.findall(r"[^\x20\x09-\x0D]+", t or ""))
    sums = defaultdict(int)
    for r in rows:
        sums[r[3]] += size(r[1])
    names = sorted([s for s in sums if s is not None]) + [None]
    weight = dict(zip(names, [5, 2, 1] * 9, strict=False))
    goal, free, left = {}, set(names), float(sum(sums.values()))
    while True:
        share = {s: left * weight[s] / sum(weight[x] for x in free) for s in free}
        over = [s for s in free if share[s] > 3 * sums[s]]
        if not over:
            goal |= share
            break
        for s in over:
            goal[s] = 3.0 * sums[s]
            left -= goal[s]
            free.discard(s)
    source = {r[0]: r[3] for r in rows}
    for r in got:
        s = source[r["doc_id"]]
        assert r["source_size"] == sums[s] and r["target"] == pytest.approx(goal[s])
        assert r["taken"] <= 3 * r["size"] and r["taken"] == r["size"] * r["copies"]
    assert sorted(map(tuple, mixing.plan(docs.repartition(7)).collect())) == sorted(map(tuple, got))
    taken = mixing.mixed(docs)
    assert taken.columns == docs.columns
    counts = defaultdict(int)
    for r in taken.collect():
        counts[r["doc_id"]] += 1
    planned = defaultdict(int)
    for r in got:
        planned[r["doc_id"]] += r["copies"]
    assert {k: v for k, v in planned.items() if v} == dict(counts)
    assert mixing.plan(none).count() == 0 and mixing.mixed(none).count() == 0


def test_mixing_draws_come_near_their_rate(spark):
    df = spark.range(20000).select(F.col("id").alias("doc_id"), F.when(F.col("id") % 10 == 0, "a").otherwise("b").alias("source"), F.lit("w w w").alias("text"))
    rows = mixing.plan(df).groupBy("target").agg(F.sum("taken").alias("t")).collect()
    assert all(abs(r["t"] / r["target"] - 1) < 0.05 for r in rows)


def test_blocks_round_trip():
    rng = np.random.default_rng(5)
    for n in (1, 2, 4095, 4096, 65535):
        for top in (1, 2, 300, 50257, 2**32):
            v = rng.integers(0, top, n).astype(np.uint32)
            v[rng.integers(0, n)] = 2**32 - 1
            assert (token_blocks.unpack_block(token_blocks.pack_block(v)) == v).all()
    out = io.BytesIO()
    w = token_blocks.BlockFileWriter(out)
    each = [rng.integers(0, 50257, n).astype(np.uint32) for n in (0, 1, 5000, 12, 20000, 0)]
    for i, ids in enumerate(each):
        w.add(i if i else None, ids)
    w.close()
    f = token_blocks.BlockFile(io.BytesIO(out.getvalue()), len(out.getvalue()))
    flat = np.concatenate(each)
    assert all((f.tokens(a, b) == flat[a:b]).all() for a, b in ((0, 0), (0, 1), (4090, 4100), (5000, 25013)))
    assert [(d, s, ids.tolist()) for d, s, ids in f.documents()] == [(i or None, sum(map(len, each[:i])), x.tolist()) for i, x in enumerate(each)]


def test_token_files(spark, docs, rows, none):
    from tokenizers import Tokenizer

    library = Tokenizer.from_file(BYTE_BPE)
    more = [(1000 + i, t, None, None, "c", 1) for i, t in enumerate(["a  b", " x", "y ", "\n\n z", "<|endoftext|> a<|endoftext|>", "é 日本 😀", "a\tb\n c"])] + [(None, "last", None, None, "c", 1)]
    folder = shared.shared_dir(spark, "t")
    token_blocks.write_tokens(docs.unionByName(spark.createDataFrame(more, DOCS)), folder, BYTE_BPE)
    got = {(r["doc_id"], r["start"]): bytes(r["ids"]) for r in token_blocks.read_tokens(spark, folder).collect()}
    at = 0
    for r in sorted(rows + more, key=lambda r: (r[0] is None, r[0])):
        ids = library.encode(r[1] or "", add_special_tokens=False).ids + [2]
        assert np.frombuffer(got[r[0], at], "<u4").tolist() == ids
        at += len(ids)
    folder = shared.shared_dir(spark, "t")
    token_blocks.write_tokens(none, folder, BYTE_BPE)
    assert token_blocks.read_tokens(spark, folder).count() == 0


def test_warc_records():
    data = b"".join(warc.record_bytes(i, None if i == 2 else "http://x/\r\n", b"\xff" * i * 90000, 1 if i > 2 else None, i > 2) for i in range(5))
    got = list(warc.read_records(io.BytesIO(data)))
    assert [(g[0], g[2], g[3], g[4]) for g in got] == [(i, "revisit" if i > 2 else "response", 1 if i > 2 else None, i * 90000) for i in range(5)]
    head = zlib.compressobj(6, zlib.DEFLATED, 31)
    plain = zlib.decompress(warc.record_bytes(1, "u", b"abc", None, False), 31).replace(b"abc\r\n", b"abd\r\n")
    with pytest.raises(ValueError, match="digest"):
        list(warc.read_records(io.BytesIO(head.compress(plain) + head.flush())))
    with pytest.raises(ValueError):
        list(warc.read_records(io.BytesIO(data[:-4])))
    assert [warc.page_of(warc.record_id(i)) for i in (None, 0, -1, 2**63 - 1, -(2**63))] == [None, 0, -1, 2**63 - 1, -(2**63)]


def test_warc_archives(spark):
    rows = [(1, "u1", "aé"), (2, "u1", "b"), (3, None, "aé"), (4, "u", None), (5, "u", ""), (6, "u", "aé"), (None, "u", "b"), (7, "x", "z" * 300000)]
    for least, firsts in ((0, {"aé": 1, "b": 2, "": 4}), (3, {"aé": 1})):
        folder = shared.shared_dir(spark, "w")
        warc.write_archives(spark.createDataFrame([(*r, "clash") for r in rows], "page_id long, url string, html string, digest string"), folder, least_bytes=least)
        got = {r["page_id"]: r for r in warc.read_archives(spark, folder).collect()}
        for i, url, html in rows:
            first = firsts.get(html or "", i)
            r = got[i]
            assert (r["record_type"], r["refers_to"]) == (("response", None) if first == i else ("revisit", first))
            assert r["payload_bytes"] == len((html or "").encode()) and r["payload_digest"] == warc.sha1_base32((html or "").encode()) and r["url"] == url
    folder = shared.shared_dir(spark, "w")
    warc.write_archives(spark.createDataFrame([], "page_id long, url string, html string"), folder)
    assert warc.read_archives(spark, folder).count() == 0


BASE = {
    "email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", "ip": r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)", "card": r"[0-9]([\x20-]?[0-9])+", "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}


def luhn(d):
    return sum((v := int(c) * (1 + i % 2)) - 9 * (v > 9) for i, c in enumerate(reversed(d))) % 10 == 0


def valid(kind, m):
    d = re.sub("[^0-9]", "", m)
    return kind == "email" or kind == "ip" and all(int(x) <= 255 for x in m.split(".")) or kind == "card" and 13 <= len(d) <= 19 and luhn(d) or kind == "phone" and 9 <= len(d) <= 15


def test_pii_base_spans(spark):
    rng = random.Random(2)
    bits = ["a", "@", "b.c", ".", " ", "-", "1", "23", "+", "4111 1111 1111 1111", "(", "😀", "é", "_", "%", "10.0.0.1", "256", "0001", "\n", "+1 (555) 123-4567", "x@y.z"]
    data = [(i, "".join(rng.choice(bits) for _ in range(rng.randint(0, 14)))) for i in range(800)]
    data += [(1000, None), (1001, ""), (1002, "1 " * 30000), (1003, "a" * 50000 + "@"), (1004, "1" * 40000), (1005, "+1" + "(" * 20000), (1006, "x@y.z"), (1006, "x@y.z")]
    df = spark.createDataFrame([(*r, "c", "d") for r in data], "doc_id long, text string, m string, kind string")
    got = {r["doc_id"]: r for r in weak_pii.digest_columns(weak_pii.marked(df, weak_pii.train(df))).collect()}
    for i, t in data:
        spans = {k: [(m.start(), m.end()) for m in re.finditer(p, t or "") if valid(k, m[0])] for k, p in BASE.items()}
        listed = [f"{k}:{a}:{b}" for k in BASE for a, b in spans[k]]
        assert tuple(got[i])[1:6] == (*[len(spans[k]) for k in BASE], hashlib.sha256(",".join(listed).encode()).hexdigest())
        assert set(listed) <= set(got[i]["spans"].split(",")) | {""}
    empty = df.where("false")
    assert weak_pii.digest_columns(weak_pii.marked(empty, weak_pii.train(empty))).count() == 0


def test_pii_adds_secrets_and_leaves_plain_texts(spark):
    rng = random.Random(8)
    hexes = lambda: "".join(rng.choice("0123456789abcdef") for _ in range(40))
    data = [(i, f'{text(rng, 9)} token = "{hexes()}" {text(rng, 5)}') for i in range(60)] + [(100 + i, text(rng, 40) + " pneumonoultramicroscopic") for i in range(60)]
    df = spark.createDataFrame(data, "doc_id long, text string")
    got = {r["doc_id"]: r["spans"] for r in weak_pii.digest_columns(weak_pii.marked(df, weak_pii.train(df))).collect()}
    for i, t in data:
        at = t.find('"') + 1
        assert got[i] == (f"secret:{at}:{at + 40}" if i < 100 else "")


def decoy(rng):
    word = lambda: "".join(rng.choice("abcdefghilmnoprstu") for _ in range(rng.randint(3, 9)))
    return rng.choice(
        [
            lambda: "-".join([word() for _ in range(4)] + ["2024", word(), f"{rng.randrange(10**5):05d}"]),
            lambda: "/" + "/".join([word(), word(), f"{word()}_{word()}_{rng.randrange(10**8):08d}", f"x{rng.randrange(9)}"]),
            lambda: "_".join([word(), word(), f"v{rng.randrange(9)}", word(), f"{rng.randrange(2000, 2030)}", word()]),
            lambda: "".join(word() for _ in range(6)),
            lambda: "-".join("".join(rng.choice("0123456789abcdef") for _ in range(n)) for n in (8, 4, 4, 4, 12)),
        ]
    )()


def test_pii_tells_secrets_from_names(spark):
    """As many decoys (slugs, paths, names, identifiers, long words) as secrets, in the same kinds of places."""
    rng = random.Random(12)
    alphabets = ["0123456789abcdef", "0123456789abcdefghijklmnopqrstuvwxyzABCDEFGHIJKLMNOPQRSTUVWXYZ"]
    data = []
    for i in range(600):
        if i % 2:
            letters = rng.choice(alphabets)
            key = "".join(rng.choice(letters) for _ in range(rng.choice([24, 32, 40])))
            data.append((i, f'{text(rng, 6)} {rng.choice(["token", "api_key", "secret"])} = "{key}" {text(rng, 4)}', key))
        else:
            name = decoy(rng)
            data.append((i, f'{text(rng, 6)} {rng.choice(["see", "file =", "open", "path:", "id"])} {name} {text(rng, 4)}', name))
    df = spark.createDataFrame([r[:2] for r in data], "doc_id long, text string")
    model = weak_pii.train(df)
    got = {r["doc_id"]: r["spans"] for r in weak_pii.digest_columns(weak_pii.marked(df, model)).collect()}
    marked = {i for i, t, key in data if len(key) >= 20 and f"secret:{t.find(key)}:{t.find(key) + len(key)}" in got[i].split(",")}
    true = {i for i, *_ in data if i % 2}
    assert len(marked & true) >= 0.9 * len(true) and len(marked & true) >= 0.9 * len(marked)
    assert sum(len(key) >= 20 for i, _, key in data if not i % 2) > 250
    assert all("secret" not in got[i] for i in got.keys() - marked)


def test_pii_classifier_equals_plain_counts(spark):
    """The classifier and what it decides, from the votes and buckets of each candidate in plain Python."""
    rng = random.Random(3)
    data = [(i, " ".join(rng.choice([decoy(rng), f'token = "{rng.getrandbits(128):032x}"', text(rng, 3)]) for _ in range(4))) for i in range(120)]
    df = spark.createDataFrame(data, "doc_id long, text string")
    found = weak_pii.candidates(F.col("text"), "secret")
    wide = F.transform(found, lambda c: F.struct(c["start"], c["end"], weak_pii._ballot("secret")(c).alias("b")))
    rows = [(r["doc_id"], c["start"], c["end"], tuple(map(int, c["b"]["votes"])), c["b"]["buckets"]) for r in df.select("doc_id", wide.alias("c")).collect() for c in r["c"]]
    prior, right, belief = 0.5, [(0.8, 0.8)] * 4, {}
    bound = lambda a, b: min(0.99, max(0.51, (a + 4) / (b + 5)))
    for _ in range(60):
        belief = {}
        for *_, votes, _ in rows:
            yes, no = prior, 1 - prior
            for v, (tp, tn) in zip(votes, right, strict=True):
                yes, no = (yes * (tp if v else 1 - tp), no * (1 - tn if v else tn)) if v != 2 else (yes, no)
            belief[votes] = yes / (yes + no)
        beliefs = [belief[v] for *_, v, _ in rows]
        prior = min(0.99, max(0.01, sum(beliefs) / len(rows)))
        right = []
        for k in range(4):
            cast = [(b, v[k]) for b, (*_, v, _) in zip(beliefs, rows, strict=True) if v[k] != 2]
            right.append((bound(sum(b for b, v in cast if v), sum(b for b, _ in cast)), bound(sum(1 - b for b, v in cast if not v), sum(1 - b for b, _ in cast))))
    share = lambda f, x, w: (1 + sum(b for b, (*_, k) in zip(w, rows, strict=True) if k[f] == x)) / (weak_pii.BUCKETS + sum(w))
    others = [1 - b for b in beliefs]
    score = lambda k: np.log(prior / (1 - prior)) + sum(np.log(share(f, x, beliefs) / share(f, x, others)) for f, x in enumerate(k))
    cut = np.log(weak_pii.LEAST / (1 - weak_pii.LEAST))
    want = {(i, a, b) for i, a, b, _, k in rows if score(k) >= cut}
    got = {(r["doc_id"], s["start"], s["end"]) for r in weak_pii.marked(df, weak_pii.train(df)).collect() for s in r["added_secret"]}
    assert got == want and 0 < len(want) < len(rows)


@pytest.mark.skipif(not os.path.isdir(SF), reason="the given tables are not there")
def test_pii_finds_the_secrets_of_the_given_documents(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    got = {r["doc_id"]: r["spans"].split(",") for r in weak_pii.digest_columns(weak_pii.marked(docs, weak_pii.train(docs))).collect()}
    planted = [(r["doc_id"], f"secret:{m.start(1)}:{m.end(1)}") for r in docs.collect() for m in re.finditer(r'token = "([0-9a-f]{20,})"', r["text"] or "")]
    assert planted and all(span in got[i] for i, span in planted)
    assert sum(s.startswith("secret") for spans in got.values() for s in spans) == len(planted)


def test_reliabilities_tell_good_labelers():
    prior, right, belief = weak_pii.reliabilities({(1, 1, 1, 2): 50, (0, 0, 0, 2): 50, (1, 1, 0, 2): 5, (0, 0, 1, 2): 5})
    assert 0.4 < prior < 0.6 and right[0][0] > right[2][0] and belief[1, 1, 1, 2] > 0.95 > 0.05 > belief[0, 0, 0, 2]


def test_fingerprints(spark, docs, rows, none):
    got = multiset_hash.with_next(docs.dropDuplicates(["doc_id"])).collect()
    by = {r["doc_id"]: r for r in got}
    order = sorted({r[0]: r[1] or "" for r in rows}.items(), reverse=True)
    assert len(got) == len(order)
    prints = {}
    for (i, t), (_, nxt) in zip(order, order[1:] + order[:1], strict=True):
        n = len(t) // 3
        edited = t[: len(t) - n] + nxt[:n]
        assert by[i]["n_chars"] == len(t) and by[i]["edited_sha256"] == hashlib.sha256(edited.encode()).hexdigest()
        assert prints.setdefault(t, by[i]["fingerprint"]) == by[i]["fingerprint"]
        assert 0 <= by[i]["near_next"] <= 1 and 0 <= by[i]["near_edited"] <= 1
        assert by[i]["near_next"] == 1.0 or t != nxt
    assert len(set(prints.values())) == len(prints)
    assert by[116]["near_edited"] > 0.5 > by[116]["near_next"]
    assert multiset_hash.with_next(none).count() == 0


def test_fingerprints_do_not_depend_on_order_and_can_be_edited():
    of = lambda *p: multiset_hash.paragraph_vectors(list(p))
    assert of("a b c d", "e", "e").text() == of("e", "a b c d", "e").text() != of("e", "a b c d").text()
    assert (of("a b c d", "e") + of("f g")).text() == of("f g", "a b c d", "e").text()
    assert (of("a b c d", "e") - of("e")).text() == of("a b c d").text()
    assert multiset_hash.Fingerprint.read(of("x y z").text()).text() == of("x y z").text()


@pytest.mark.parametrize("n", [100, 50_000, 65_536, 140_000])
def test_likeness_of_runs_repeated_often(n):
    """The edited third holds a run that the text has not: squares of 2 n n apart in 14 n n."""
    whole, edited = (multiset_hash.fingerprint(t) for t in ("a b c\n" * (3 * n), "a b c\n" * (2 * n) + "d e f\n" * n))
    assert multiset_hash.Fingerprint.read(whole.text()).likeness(edited) == pytest.approx(6 / 7, abs=1e-4)
    assert np.array_equal((whole - edited + edited).like, whole.like)


def shingles(t, k):
    w = (t or "").encode().lower().split()
    return frozenset(tuple(w[i : i + k]) for i in range(len(w) - k + 1)) if len(w) >= k else frozenset([tuple(w)] if w else [])


@pytest.mark.parametrize("size", [2, 5])
def test_near_duplicates(spark, docs, rows, none, size):
    sets = {r[0]: shingles(r[1], size) for r in rows}
    root = {i: i for i in sets}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    ids = sorted(sets)
    for n, i in enumerate(ids):
        for j in ids[:n]:
            both = len(sets[i] & sets[j])
            if both and 100 * both >= 80 * len(sets[i] | sets[j]):
                a, b = find(i), find(j)
                root[max(a, b)] = min(a, b)
    got = {tuple(r) for r in set_sketch.near_duplicates(docs, shingle=size).collect()}
    assert got == {(i, len(sets[i]), find(i), find(i) == i) for i in sets}
    if size == 5:
        kept = set_sketch.drop_near_duplicates(docs)
        assert kept.columns == docs.columns and {r["doc_id"] for r in kept.collect()} == {i for i in sets if find(i) == i}
        assert set_sketch.near_duplicates(none).count() == 0


def test_texts_of_one_id_are_one_document(spark):
    a, b = (" ".join(f"{x}{i}" for i in range(40)) for x in "ab")
    rows = [(3, a), (5, a), (5, b), (7, b), (8, a + " more"), (9, b + " more"), (9, None), (None, a), (2, "alone")]
    got = set_sketch.near_duplicates(spark.createDataFrame(rows, "doc_id long, text string"), shingle=2).collect()
    assert {(r["doc_id"], r["component_id"]) for r in got} == {(3, 3), (5, 3), (7, 3), (8, 3), (9, 3), (9, 9), (None, None), (2, 2)}


def test_chains_across_a_bucket_keep_every_link(spark):
    """Each text is like the next alone, so hubs alone would not do."""
    words = [f"w{i}" for i in range(400)]
    rows = [(100 - k, " ".join(words[8 * k : 8 * k + 120])) for k in range(30)]
    got = {r["component_id"] for r in set_sketch.near_duplicates(spark.createDataFrame(rows, "doc_id long, text string"), shingle=2).collect()}
    assert got == {71}


def test_blocks_of_large_buckets_find_what_pairs_find(spark, monkeypatch):
    rng = random.Random(4)
    base = [f"w{i}" for i in range(60)]
    rows = []
    for i in range(40):
        words = list(base)
        for _ in range(rng.randrange(9)):
            words[rng.randrange(60)] = f"x{rng.randrange(40)}"
        rows.append((i, " ".join(words)))
    df = spark.createDataFrame(rows, "doc_id long, text string")
    want = sorted(map(tuple, set_sketch.near_duplicates(df, shingle=2).collect()))
    for name, value in (("PAIRED", 1), ("BLOCK", 4), ("PROBES", 3)):
        monkeypatch.setattr(set_sketch, name, value)
    assert sorted(map(tuple, set_sketch.near_duplicates(df, shingle=2).collect())) == want
    sets = {i: shingles(t, 2) for i, t in rows}
    linked = {i for i in sets for j in sets if i != j and 100 * len(sets[i] & sets[j]) >= 80 * len(sets[i] | sets[j])}
    assert {r[0] for r in want if r[2] != r[0]} <= linked and len({r[2] for r in want}) > 1


def alike_and_alone(spark):
    """Texts of one bucket: 60 that all resemble each other, 20 that resemble nothing."""
    near = [(i, " ".join(f"w{k}" if k != i else f"x{i}" for k in range(100))) for i in range(60)]
    alone = [(100 + i, " ".join(f"y{i}_{k}" for k in range(40))) for i in range(20)]
    return spark.createDataFrame(near + alone, "node long, text string")


def test_blocks_give_fewer_links_than_members(spark):
    texts = alike_and_alone(spark)
    left = texts.select(F.lit(1).cast("long").alias("key"), "node", F.col("node").alias("component"), F.lit(80).cast("long").alias("size"))
    links = set_sketch._block_links(left, texts, 2, 80)
    assert links.count() < 60
    assert {r["node"]: r["component"] for r in components.components(links).collect()} == {i: 0 for i in range(60)}


def test_large_buckets_are_joined_in_blocks_of_their_own_first(spark, monkeypatch):
    for name, value in (("BLOCK", 8), ("PROBES", 10)):
        monkeypatch.setattr(set_sketch, name, value)
    texts = alike_and_alone(spark)
    met = texts.select(F.lit(1).cast("long").alias("key"), F.lit(0).alias("band"), "node")
    none = spark.createDataFrame([], "node long, component long")
    found, left = set_sketch._joined_in_blocks(met, none, texts, 2, 80)
    now = {r["node"]: r["component"] for r in found.collect()}
    assert set(now) <= set(range(60)) and len(set(now.values())) < 10 and left.count() == 80
    links = set_sketch._edges(found).unionByName(set_sketch._block_links(left, texts, 2, 80))
    assert {r["node"]: r["component"] for r in components.components(links).collect()} == {i: 0 for i in range(60)}


def test_sketches_estimate_overlap_and_merge():
    rng = np.random.default_rng(3)
    s = set_sketch.Sketcher()
    pool = rng.integers(0, 2**63, 3000, dtype=np.uint64)
    a, b = np.unique(pool[:2000]), np.unique(pool[200:2200])
    ra, rb = s.registers(a), s.registers(b)
    assert (np.maximum(ra, rb) == s.registers(np.unique(np.concatenate([a, b])))).all()
    ask = lambda y, n: set_sketch.may_reach(80, np.array([2000.0]), np.array([n]), ra[None].astype(int), y[None].astype(int))[0]
    assert ask(rb, 2000.0) and not ask(s.registers(pool[1800:]), 1200.0)


def test_components(spark):
    links = [(1, 2), (2, 3), (9, 3), (20, 21), (7, 7), (None, 4)] + [(50, k) for k in range(51, 90)] + [(k, k + 1) for k in range(100, 140)]
    got = {r["node"]: r["component"] for r in components.components(spark.createDataFrame(links, "a long, b long")).collect()}
    assert got == {1: 1, 2: 1, 3: 1, 9: 1, 20: 20, 21: 20} | {k: 50 for k in range(50, 90)} | {k: 100 for k in range(100, 141)}
    assert components.components(spark.createDataFrame([], "a long, b long")).count() == 0


def test_components_go_on_from_those_found(spark):
    """Links that come later join whole components: as if all had come at once."""
    rng = random.Random(8)
    links = [(rng.randrange(200), rng.randrange(200)) for _ in range(150)]
    root = list(range(200))
    for a, b in links:
        low, high = sorted((root[a], root[b]))
        root = [low if x == high else x for x in root]
    found = None
    for part in (links[:60], links[60:140], links[140:], links[:20]):
        found = components.joined(spark.createDataFrame(part, "a long, b long"), found)
    assert sorted(map(tuple, found.select("node", "component").collect())) == [(i, r) for i, r in enumerate(root) if r != i]


def test_components_shuffle_once_a_round(spark):
    """Every shuffle has all its tasks however few the links are: two rounds and the roots are three."""
    links = spark.createDataFrame([(50, k) for k in range(20, 90)], "a long, b long")
    put = {"spark.sql.shuffle.partitions": "40", "spark.sql.adaptive.coalescePartitions.enabled": "false"}
    was, tracker = {k: spark.conf.get(k) for k in put}, spark.sparkContext.statusTracker()
    try:
        for k, v in put.items():
            spark.conf.set(k, v)
        spark.sparkContext.setJobGroup("components", "components")
        assert {r["component"] for r in components.components(links).collect()} == {20}
        stages = {s for j in tracker.getJobIdsForGroup("components") for s in tracker.getJobInfo(j).stageIds}
    finally:
        spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)
        for k, v in was.items():
            spark.conf.set(k, v)
    infos = [tracker.getStageInfo(s) for s in stages]
    assert sum(i.numCompletedTasks >= 40 for i in infos if i) <= 3


PAGE = "<html><head><title>t</title></head><body><nav>Menu {n}</nav><div class='ad-slot'>Buy</div>{body}<form>f</form><footer>&copy; x</footer></body></html>"


def test_page_lines():
    html = PAGE.format(n=1, body="<article><h1>A &amp; B</h1><p>one<br>two <b>three<p>four&nbsp;five<aside>no</aside><script>var a='<p>x</p>'</script><ul><li>x<li>y</ul></article><section id=comments><p>me</p></section>")
    own = page_diff.lines_of(html)
    assert page_diff.main_text(own, None) == "A & B\none two three\nfour five\nx\ny"
    assert page_diff.main_text(page_diff.lines_of(None), None) == "" == page_diff.main_text(page_diff.lines_of("<p class='x"), None)
    assert page_diff.main_text(page_diff.lines_of("a <p>b</p> c &lt; d<!-- e --> <p>cut &am"), None) == "a\nb\nc < d\ncut &am"


def test_common_lines_are_longest():
    rng = random.Random(6)
    for _ in range(200):
        a, b = ([rng.choice("abcd") for _ in range(rng.randrange(9))] for _ in range(2))
        best = [[0] * (len(b) + 1) for _ in range(len(a) + 1)]
        for i, x in enumerate(a):
            for j, y in enumerate(b):
                best[i + 1][j + 1] = best[i][j] + 1 if x == y else max(best[i][j + 1], best[i + 1][j])
        got = page_diff.common_lines(a, b)
        assert len(got) == best[-1][-1] and all(a[i] == b[j] for i, j in got) and got == sorted(got) and len({j for _, j in got}) == len(got)


def test_page_differencing(spark):
    plain = "<div>Top line</div><p>Story {k}</p><p>Only {k}</p><div>Bottom line</div>"
    rows = [(k, f"http://h.org/a/{k}", PAGE.format(n=k, body=plain.format(k=k))) for k in range(5)]
    rows += [(10, "http://alone.org/x", "<p>All mine</p>"), (11, None, None), (12, None, "<p>n</p>"), (13, "http://copy.org/1", "<p>c</p>"), (14, "http://copy.org/2", "<p>c</p>"), (15, "bad url", "")]
    df = spark.createDataFrame([(*r, "c", 1) for r in rows], "page_id long, url string, html string, host string, path int").repartition(3)
    for ranges in (1, 4, 11):
        got = {r["page_id"]: (r["url"], r["text"], r["n_chars"]) for r in page_diff.extract(df, ranges).collect()}
        want = {k: f"Story {k}\nOnly {k}" for k in range(5)} | {10: "All mine", 11: "", 12: "n", 13: "c", 14: "c", 15: ""}
        assert got == {i: (u, want[i], len(want[i])) for i, u, _ in rows}
    assert page_diff.extract(df.where("false")).count() == 0


def test_page_differencing_equals_pairing_by_hand(spark):
    rng = random.Random(8)
    site = [f"<div>site {i}</div>" for i in range(4)]
    rows = []
    for k in range(60):
        body = "".join(rng.sample(site, rng.randrange(4))) + "".join(f"<p>line {rng.randrange(30)}</p>" for _ in range(rng.randrange(5)))
        if rng.random() < 0.5:
            body += f"<article><p>story {rng.randrange(4)}</p></article>"
        rows.append((k, f"http://{rng.choice('AbB')}.org/{rng.choice(['x', 'y/z', ''])}{rng.randrange(40)}", body))
    rows += [rows[5], (None, rows[7][1], rows[7][2]), (60, "http://a.org/" + "x" * 5000, "<p>" + "long " * 50000 + "</p>")]
    order = sorted(rows, key=lambda r: (r[1].split("/")[2].lower(), r[1].split("/", 3)[3], 2**63 if r[0] is None else r[0]))
    want = []
    for k, (i, url, html) in enumerate(order):
        host, path = url.split("/")[2].lower(), "/" + url.split("/", 3)[3]
        beside = [order[j] for j in (k - 1, k + 1) if 0 <= j < len(order) and order[j][1].split("/")[2].lower() == host]
        match = lambda r: len(os.path.commonprefix([path, "/" + r[1].split("/", 3)[3]]))  # noqa: B023, E731
        near = page_diff.lines_of(max(beside, key=match)[2]) if beside else []
        own = page_diff.lines_of(html)
        shared_lines = {a for a, _ in page_diff.common_lines([x for x, _ in own], [x for x, _ in near])}
        story = [a for a, (_, place) in enumerate(own) if place == 2]
        rest = [a for a, (_, place) in enumerate(own) if place == 0 and a not in shared_lines and (near or not story)]
        keep = sorted(story + rest) or [a for a, (_, place) in enumerate(own) if place == 0]
        want.append((i, "\n".join(own[a][0] for a in keep)))
    df = spark.createDataFrame(rows, "page_id long, url string, html string").repartition(4)
    for ranges in (1, 5):
        assert sorted(((r["page_id"], r["text"]) for r in page_diff.extract(df, ranges).collect()), key=str) == sorted(want, key=str)


def test_language(spark, none):
    rng = random.Random(9)
    vocab = {"en": "the of and with this that from have".split(), "de": "der die und nicht mit auch sich über".split(), "es": "el los que para está año muy también".split()}
    rows = [(i, " ".join(rng.choice(vocab[x]) for _ in range(rng.randrange(3, 30))), x) for i, x in enumerate(rng.choice(list(vocab)) for _ in range(400))]
    odd = [(1000, None, "en"), (1001, "123 !?", "de"), (1002, "", None), (1003, "überaus", None), (1004, "the " * 50000, None), (None, "los", "es")]
    df = spark.createDataFrame([(*r, "x", 1.0) for r in rows + odd], "doc_id long, text string, lang string, word string, score double")
    out = lang_id.identify(df).withColumn("held", lang_id.held_out(F.col("doc_id"))).collect()
    got = {r["doc_id"]: r for r in out}
    assert len(out) == len(rows + odd)
    held = [(i, x) for i, _, x in rows if got[i]["held"]]
    assert all(got[i]["held"] == (zlib.crc32(str(i).encode()) % 4 == 2) for i, _, _ in rows)
    assert sum(got[i]["_lang"]["lang"] == x for i, x in held) >= 0.98 * len(held) > 50
    assert [got[i]["_lang"]["lang"] for i in (1000, 1001, 1002, 1003, 1004)] == ["und", "und", "und", "de", "en"]
    assert all(0 <= r["_lang"]["score"] <= 1 for r in out)
    unlabelled = lang_id.identify(df.withColumn("lang", F.lit(None).cast("string")))
    assert {r["_lang"]["lang"] for r in unlabelled.collect()} == {"und"}
    assert lang_id.identify(none).count() == 0


@pytest.mark.skipif(not os.path.isdir(SF), reason="the given tables are not there")
def test_language_of_held_out_documents(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text", "lang")
    rows = [r for r in lang_id.identify(docs).where(lang_id.held_out(F.col("doc_id"))).collect() if r["lang"] and r["text"]]
    assert len(rows) > 30 and sum(r["_lang"]["lang"] == r["lang"] for r in rows) >= 0.98 * len(rows)


def test_language_counts_words_outside_the_broadcast_ones(spark):
    """However few words are broadcast, every trained word and n-gram counts, and shares are of
    all that a language trained; held against plain counts."""
    rng = random.Random(19)
    letters = {"de": "abcdeü", "en": "bcdefgh", "es": "cdefñoi"}
    words = {x: ["".join(rng.choice(s) for _ in range(rng.randrange(1, 8))) for _ in range(300)] + [s * 5] for x, s in letters.items()}
    langs = [rng.choice(["en", "en", "en", "de", "es"]) for _ in range(200)]
    rows = [(i, " ".join(rng.choice(words[x]) for _ in range(rng.randrange(1, 12))), x) for i, x in enumerate(langs)]
    rows += [(500 + i, t, None) for i, t in enumerate([None, "12 !", "ж", "ж ü", "zzzz", *[rows[3][1]] * 3])] + [(3, rows[3][1], rows[3][2])]

    total = {k: defaultdict(lambda: defaultdict(int)) for k in (0, 4, 3, 2, 1)}
    for i, t, x in rows:
        if x and zlib.crc32(str(i).encode()) % 4 != 2:
            for w in re.findall(r"[^\W\d_]+", t.lower()):
                total[0][w][x] += 1
                for k in (4, 3, 2, 1):
                    p = f" {w} "
                    for j in range(max(len(p) - k + 1, 1)):
                        total[k][p[j : j + k]][x] += 1
    sums = {k: {x: sum(n[x] for n in t.values()) + 0.5 * (len(t) + 1) for x in sorted(words)} for k, t in total.items()}
    share = lambda k, e: np.array([np.log((total[k][e].get(x, 0) + 0.5) / s) for x, s in sums[k].items()])

    def plain(t):
        found = re.findall(r"[^\W\d_]+", (t or "").lower())
        score = np.zeros(3)
        for w in found:
            p = f" {w} "
            if w in total[0]:
                score += share(0, w)
                continue
            for k in (4, 3, 2, 1):
                if pieces := [p[j : j + k] for j in range(len(p) - k + 1) if p[j : j + k] in total[k]]:
                    score += np.mean([share(k, e) for e in pieces], axis=0)
                    break
        return (sorted(words)[int(score.argmax())], 1 / np.exp(score - score.max()).sum()) if found else ("und", 0.0)

    df = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    for limits in ({"max_words": 10, "max_grams": 3}, {"max_words": 0, "max_grams": 0}, {"max_words": 10**6, "max_grams": 3}, {}):
        out = lang_id.identify(df, **limits).collect()
        assert sorted(r["doc_id"] for r in out) == sorted(r[0] for r in rows)
        for r in out:
            x, score = plain(r["text"])
            assert r["_lang"]["score"] == pytest.approx(score, abs=1e-3)
            assert r["_lang"]["lang"] == x or 0 < score < 0.51
    trained = lang_id.train(lang_id.training_rows(df), max_words=10, max_grams=3)
    assert len(trained.model.words.keys) <= 10
    left = {r["doc_id"] for r in lang_id.in_a_language(df, trained).collect()}
    assert left == {r[0] for r in rows} - {500, 501}


def test_language_writes_each_table_once(spark, monkeypatch):
    """Training writes words, their counts by language and those of all n-grams; a step of the
    search by n-grams writes one table. Every file of a task starts processes beside it."""
    written, names = lang_id.written, []
    monkeypatch.setattr(lang_id, "written", lambda df, name: names.append(name) or written(df, name))
    df = spark.createDataFrame([(1, "der die das", "de"), (3, "the of and", "en"), (4, "thede щщ x", None)], "doc_id long, text string, lang string")
    trained = lang_id.train(df, max_words=2, max_grams=2)
    assert names == ["lang-words", "lang-entries", "lang-entries"]
    assert {k: g.size for k, g in trained.grams.items()} == {k: len({g for w in "der die das the of and".split() for g in grams_of(f" {w} ", k)}) for k in (4, 3, 2, 1)}
    names.clear()
    assert lang_id.scores(df, trained).count() == 3
    assert [n for n in names if n.startswith(("lang-grams", "lang-open"))] == [f"lang-grams-{k}" for k in (4, 3, 2, 1)]


def grams_of(padded, k):
    return [padded[i : i + k] for i in range(max(1, len(padded) - k + 1))]


def test_language_backs_off_to_shorter_grams():
    table = lambda d: lang_id.Table({k: i for i, k in enumerate(d)}, np.array(list(d.values()) or [[0, 0]], np.float32))
    m = lang_id.Model(["a", "b"], table({"known": [0, -9]}), {4: table({"abcd": [-9, 0]}), 3: table({"xyz": [0, -9]}), 2: table({}), 1: table({})})
    s = lang_id.Scorer(m)
    assert [s.text(t)[0] for t in ("known", "xabcdx", "wxyzw", "qq")] == ["a", "b", "a", "a"]


def test_bpe_equals_the_library(spark, docs, rows, none):
    from tokenizers import Tokenizer

    library, own = Tokenizer.from_file(WORD_BPE), bpe_automaton.WordBpe(bpe_automaton.bpe_file(WORD_BPE))
    rng = random.Random(5)
    letters = " \n\t\r\v\f  .a'sbeéÉéßΣσİ١3<|endoftext|>|<😀日本語　\x1c \x85‍''lvermd!!..--ing"
    texts = ["".join(rng.choice(letters) for _ in range(rng.randint(0, 14))) for _ in range(3000)] + [r[1] or "" for r in rows] + ["a<|endoftext|>b<|startoftext|>", "x" * 3000, "aaaa" * 50]
    for t, ids in zip(texts, own.encode(texts), strict=True):
        want = library.encode(t, add_special_tokens=False).ids
        assert np.frombuffer(ids, "<u4").tolist() == want, t
        assert own.decode(ids) == library.decode(want, skip_special_tokens=False)
    got = docs.select("doc_id", bpe_automaton.round_trip(F.col("text"), WORD_BPE).alias("r"))
    assert all(r["r"]["decoded"] == own.decode(bytes(r["r"]["ids"])) for r in got.collect())
    assert got.where(bpe_automaton.decoded(F.col("r.ids"), WORD_BPE) != F.col("r.decoded")).count() == 0
    assert none.select(bpe_automaton.round_trip(F.col("text"), WORD_BPE)).count() == 0


def test_automaton_on_random_merges():
    """Against applying the merges one after another, leftmost first."""
    rng = random.Random(7)
    for _ in range(150):
        tokens, merges = ["a", "b", "c"], []
        for _ in range(rng.randrange(12)):
            u, v = rng.choice(tokens), rng.choice(tokens)
            if u + v not in tokens and len(u + v) < 9:
                merges.append((u, v))
                tokens.append(u + v)
        at = {t: i for i, t in enumerate(tokens)}
        m = bpe_automaton.MergeAutomaton({x: at[x] for x in "abc"}, [(at[u], at[v], at[u + v]) for u, v in merges])
        for _ in range(40):
            word = [rng.choice("abc") for _ in range(rng.randrange(1, 14))]
            now = list(word)
            for u, v in merges:
                k = 0
                while k + 1 < len(now):
                    if (now[k], now[k + 1]) == (u, v):
                        now[k : k + 2] = [u + v]
                    k += 1
            assert [tokens[i] for i in m.encode(word)] == now
    with pytest.raises(ValueError):
        bpe_automaton.MergeAutomaton({"a": 0}, [(0, 5, 1)])


def test_order_gives_every_row_its_neighbours(spark):
    rng = random.Random(1)
    keys = rng.sample(range(10000), 300)
    df = spark.createDataFrame([(k,) for k in keys], "k long").repartition(5)
    parts = shared.in_order(df, [F.col("k")], 7, both_sides=True).select("_range", "_side", "k").rdd.glom().collect()
    before, after = {}, {}
    for part in parts:
        for x, y in zip(part, part[1:], strict=False):
            if x["_range"] == y["_range"]:
                if y["_side"] == 0:
                    before[y["k"]] = x["k"]
                if x["_side"] == 0:
                    after[x["k"]] = y["k"]
    s = sorted(keys)
    assert before == dict(zip(s, s[-1:] + s[:-1], strict=True)) and after == dict(zip(s, s[1:], strict=False))


@pytest.mark.parametrize("heavy", [False, True])
def test_order_parts_rows_of_one_key_by_ties(spark, heavy):
    rows = [(1000 if heavy and i % 3 == 0 else i // 2, f"t{i}") for i in range(300)]
    df = spark.createDataFrame(rows, "k long, text string").repartition(5)
    parts = shared.in_order(df, [F.col("k")], 7, both_sides=True, ties=F.xxhash64("text")).select("_range", "_side", "k", "text").rdd.glom().collect()
    before, after = {}, {}
    for part in parts:
        for x, y in zip(part, part[1:], strict=False):
            if x["_range"] == y["_range"]:
                if y["_side"] == 0:
                    before[y["text"]] = x["text"]
                if x["_side"] == 0:
                    after[x["text"]] = y["text"]
    s = [r["text"] for r in df.orderBy("k", F.xxhash64("text")).collect()]
    assert before == dict(zip(s, s[-1:] + s[:-1], strict=True)) and after == dict(zip(s, s[1:], strict=False))
    assert max(sum(r["_side"] == 0 for r in p) for p in parts) < 100


def test_order_finds_its_bounds_without_reading_texts(spark):
    read = spark.sparkContext.accumulator(0)

    @F.udf("string")
    def text(k):
        read.add(1)
        return f"t{k}"

    df = spark.range(200).withColumnRenamed("id", "k").withColumn("text", text("k"))
    out = shared.in_order(df, [F.col("k")], 4, ties=F.xxhash64("text"))
    assert read.value == 0
    assert out.count() >= 200


@pytest.mark.parametrize("ranges", [1, 4])
def test_next_documents_with_null_and_repeated_ids(spark, ranges):
    rng = random.Random(3)
    rows = [(None if i % 3 == 0 else i // 4, None if i == 8 else " ".join(rng.choices(["a", "b", "\u00e9", "c\n"], k=i % 11))) for i in range(60)]
    for some in (rows, rows[:1], rows[:0]):
        df = spark.createDataFrame(some, "doc_id long, text string")
        hashed = df.select("doc_id", F.coalesce("text", F.lit("")).alias("text")).orderBy(F.col("doc_id").asc_nulls_first(), F.xxhash64("text")).collect()
        want = []
        for k, r in enumerate(hashed):
            edited = multiset_hash.edit(r["text"], hashed[k - 1]["text"])
            want.append((str(r["doc_id"]), len(r["text"]), hashlib.sha256(edited.encode()).hexdigest()))
        got = [(str(r["doc_id"]), r["n_chars"], r["edited_sha256"]) for r in multiset_hash.with_next(df, ranges=ranges).collect()]
        assert sorted(got) == sorted(want)


@pytest.mark.parametrize("common, apart", [(8, 2), (80, 20), (81, 19), (800, 200), (810, 190)])
def test_no_filter_of_the_chain_loses_pairs_at_the_threshold(spark, common, apart):
    """Pairs of overlap 0.80 to 0.81 through every filter before the full sets: bands, likelihood
    and, in small buckets, one bit a register."""
    rng, sketcher, pairs = np.random.default_rng(common), set_sketch.Sketcher(), 300
    width, band = set_sketch.REGISTERS, set_sketch.ROWS
    a, b, n_a, n_b = [], [], [], []
    for k in range(pairs):
        both = rng.integers(0, 2**64, common + apart, dtype=np.uint64)
        cut = common + apart * (k % 3) // 2
        x, y = both[:cut], np.concatenate([both[:common], both[cut:]])
        a.append(sketcher.registers(x)), b.append(sketcher.registers(y))
        n_a.append(float(len(x))), n_b.append(float(len(y)))
    a, b = np.array(a), np.array(b)
    assert ((a == b).reshape(pairs, width // band, band).all(axis=2).any(axis=1)).all()
    assert set_sketch.may_reach(80, np.array(n_a), np.array(n_b), a.astype(np.int32), b.astype(np.int32)).all()
    rows = [(bytearray(x.astype(">u2").tobytes()), bytearray(y.astype(">u2").tobytes())) for x, y in zip(a, b, strict=True)]
    df = spark.createDataFrame(rows, "x binary, y binary")
    bits = df.select(*[c.alias(f"{s}{k}") for s in "xy" for k, c in enumerate(set_sketch._bit_signature(F.col(s)))])
    most = bits.selectExpr("max(bit_count(x0 ^ y0) + bit_count(x1 ^ y1)) as most").first()["most"]
    assert most <= set_sketch._most_bits(80)


def test_pipeline_stages(spark, docs, none):
    import corpus_pipeline

    now = docs
    for name, stage in corpus_pipeline.STAGES[:-1]:
        out = shared.written(stage(spark, now, ""), name)
        assert out.columns == now.columns
        assert {r["doc_id"] for r in out.collect()} <= {r["doc_id"] for r in now.collect()}
        now = out
    ids = [r["doc_id"] for r in now.collect()]
    assert not {110, 111, 112, 115} & set(ids) and len({i for i in ids if 60 <= i < 110}) <= 1
    assert corpus_pipeline.STAGES[-1][1](spark, now, "").count() == len(ids)
    empty = none
    for _, stage in corpus_pipeline.STAGES:
        empty = shared.written(stage(spark, empty, ""), "none")
        assert empty.count() == 0


CLASHING = ["_id", "_sha", "_n", "_gone", "_text", "_digest", "_found", "_lang", "_row", "_copy", "_source", "_goal_source", "_maybe", "_bucket", "_key", "digest", "id", "n", "node", "component", "word", "head", "part", "kept", "keep_id", "group_size", "row", "size", "target", "copies", "count", "a", "b"]


@pytest.mark.parametrize("limits", [{}, {"max_words": 3, "max_grams": 1}])
def test_stages_keep_columns_of_any_name(spark, limits, monkeypatch):
    """Every name that an operator uses inside, as a column beside those of the documents."""
    import corpus_pipeline

    if limits:
        train = lang_id.train
        monkeypatch.setattr(lang_id, "train", lambda rows, **_: train(rows, **limits))
    texts = ["the cat sat on the mat and saw the dog", "der Hund und die Katze sind nicht da", "the cat sat on the mat and saw the dog", "12 34", None, "und der Hund ist da"]
    rows = [(i, t, "en" if t and t[0] == "t" else "de" if i == 1 else None, "s", *[f"{c}{i}" for c in CLASHING]) for i, t in enumerate(texts)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, " + ", ".join(f"`{c}` string" for c in CLASHING))
    now, kept = docs, [{0, 1, 2, 5}, {1, 2, 5}, {1, 2, 5}, None]
    for (name, stage), left in zip(corpus_pipeline.STAGES[:-1], kept, strict=True):
        now = shared.written(stage(spark, now, ""), name)
        assert now.columns == docs.columns
        found = now.collect()
        assert left is None or {r["doc_id"] for r in found} == left
        assert all(r[c] == f"{c}{r['doc_id']}" for r in found for c in CLASHING)
        assert all(r["lang"] == ("en" if r["text"][0] == "t" else "de") for r in found)
    assert corpus_pipeline.STAGES[-1][1](spark, now, "").count() == now.count()


def test_identify_replaces_a_column_of_its_name_and_keeps_others(spark):
    rows = [(i, t, x, "k", "l") for i, (t, x) in enumerate([("the cat", "en"), ("der Hund", "de"), ("the dog", "en"), ("die Katze", "de"), ("a", None)])]
    df = spark.createDataFrame(rows, "doc_id long, text string, lang string, _text string, _lang string")
    for limits in ({}, {"max_words": 1, "max_grams": 1}):
        out = lang_id.identify(df, train_on=df, **limits)
        assert out.columns == df.columns and {r["_text"] for r in out.collect()} == {"k"}
        assert {r["doc_id"]: r["_lang"]["lang"] for r in out.collect()}[3] == "de"

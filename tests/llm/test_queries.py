"""Every registered query and the whole pipeline on a small table, against plain versions."""

import base64
import hashlib
import random
import re
import zlib
from collections import Counter, defaultdict

import duckdb
import numpy as np
import public_tokenizers
import pytest
import sentencepiece
from test_operators import BASE, shingles, valid
from tokenizers import Tokenizer

import corpus_pipeline
from carbonsieve.llm import mixing, queries

VOCAB = {"en": "the of and with this that from have", "de": "der die und nicht mit auch sich über", "es": "el los que para está año muy también"}


@pytest.fixture(scope="module")
def rows():
    """doc_id, text, lang, source: copies, near copies, a hot source, no text, no letter, long."""
    rng = random.Random(31)
    say = lambda x, n: "".join(rng.choice(VOCAB[x].split()) + rng.choice([" ", " ", " ", ", ", "\n"]) for _ in range(n))
    langs = [rng.choice(list(VOCAB)) for _ in range(60)]
    out = [(i, say(x, rng.randrange(1, 60)), x if i % 7 else None, rng.choice(["a", "a", "b", "é", None])) for i, x in enumerate(langs)]
    base = say("en", 90).split(" ")
    for i in range(60, 80):
        words = list(base)
        for _ in range(rng.randrange(4)):
            words[rng.randrange(len(words))] = f"n{rng.randrange(9)}"
        out.append((i, " ".join(words), "en", "a"))
    out += [(80 + k, t, "en", s) for k, (t, s) in enumerate([(None, "a"), ("", None), (" \n", "b"), ("12 34 !", "b"), ("one", "b"), ("one", "a"), ("ж 日本 😀 x@y.zz", None)])]
    out += [(90, say("de", 9000), "de", "a"), (91, "call +1 (555) 123-4567 or 10.0.0.1, pay 4111 1111 1111 1111 " * 3, "en", "b"), (92, "<|endoftext|> it's  9", None, "a")]
    return out


PAGES = [(k, f"http://h.org/a/{k}", f"<nav>Menu {k}</nav><div>Top line</div><p>Story {k}</p><div>Bottom line</div>") for k in range(4)] + [
    (4, "http://i.org/x", "<header>h</header><article><h1>A &amp; B</h1><p>one  <b>two</b></p></article><footer>f</footer>"),
    (5, "http://i.org/y", None),
    (6, None, "<p>n</p>"),
    (7, "http://j.org/", "<p>n</p>"),
]


@pytest.fixture(scope="module")
def folder(spark, rows, tmp_path_factory):
    at = str(tmp_path_factory.mktemp("tables"))
    spark.createDataFrame(rows, "doc_id long, text string, lang string, source string").repartition(3).write.parquet(f"{at}/documents.parquet")
    words = next(t for i, t, *_ in rows if i == 90).split()
    items = [(k, " ".join(words[a : a + n])) for k, (a, n) in enumerate([(0, 40), (30, 9), (200, 10), (3000, 1200), (8990, 10)])]
    items += [(7, None), (8, ""), (9, "One"), (9, "no such words at all"), (10, "It's 9, <|endoftext|>!"), (11, "never found " * 8)]
    spark.createDataFrame(items, "item_id long, text string").repartition(2).write.parquet(f"{at}/benchmark.parquet")
    spark.createDataFrame(PAGES, "page_id long, url string, html string").repartition(2).write.parquet(f"{at}/pages.parquet")
    return at


@pytest.fixture(scope="module")
def result(spark, folder):
    return lambda name: queries.queries()[name](spark, folder).collect()


def groups(sets):
    """The least id reachable over links of 80 of 100."""
    home = {i: i for i in sets}
    for i in sorted(sets):
        for j in sorted(sets):
            both = len(sets[i] & sets[j])
            if i < j and both and 100 * both >= 80 * len(sets[i] | sets[j]) and home[i] != home[j]:
                low, high = sorted((home[i], home[j]))
                home |= {k: low for k in home if home[k] == high}
    return home


def library(name):
    return Tokenizer.from_file(public_tokenizers.path(name))


def as_bytes(ids):
    return np.array(ids, "<u4").tobytes()


def sha(data):
    return hashlib.sha256(data).hexdigest()


def test_op1(rows, result):
    sets = {i: shingles(t, 2) for i, t, *_ in rows}
    home = groups(sets)
    assert sorted(map(tuple, result("op1_set_sketch_dedup"))) == sorted((i, len(sets[i]), home[i], home[i] == i) for i in sets)
    assert len(set(home.values())) < len(home) - 10


def test_op2(rows, result):
    own, want, at = library("byte_bpe_50k.json"), [], 0
    for i, t, *_ in sorted(rows):
        ids = own.encode(t or "", add_special_tokens=False).ids + [2]
        want.append((i, at, len(ids), zlib.crc32(as_bytes(ids))))
        at += len(ids)
    assert sorted((r["doc_id"], r["start"], r["n_tokens"], r["ids_crc32"]) for r in result("op2_token_blocks")) == want


def test_op3(result):
    first, want = {}, []
    for i, _, html in PAGES:
        data = (html or "").encode()
        seen = first.setdefault(data, i)
        want.append((i, len(data), base64.b32encode(hashlib.sha1(data).digest()).decode(), "response" if seen == i else "revisit", None if seen == i else seen))
    assert sorted(map(tuple, result("op3_warc"))) == want


def test_op4(rows, result):
    got = {r["doc_id"]: r for r in result("op4_weak_pii")}
    assert len(got) == len(rows)
    for i, t, *_ in rows:
        spans = {k: [(m.start(), m.end()) for m in re.finditer(p, t or "") if valid(k, m[0])] for k, p in BASE.items()}
        listed = [f"{k}:{a}:{b}" for k in BASE for a, b in spans[k]]
        assert [got[i][f"n_{k}"] for k in BASE] == [len(spans[k]) for k in BASE] and got[i]["base_sha256"] == sha(",".join(listed).encode())
        assert set(listed) <= set(got[i]["spans"].split(",")) | {""}
    assert got[91]["n_phone"] == got[91]["n_ip"] == got[91]["n_card"] == 3


def runs(text):
    """Counts of runs of three words of a line; a shorter line is one run."""
    lines = [line.encode().split() for line in text.split("\n")]
    return Counter(tuple(w[k : k + 3]) for w in lines if w for k in range(max(1, len(w) - 2)))


def likeness(a, b):
    x, y = runs(a), runs(b)
    whole = sum(n * n for n in [*x.values(), *y.values()])
    apart = sum((x[k] - y[k]) ** 2 for k in x.keys() | y.keys())
    return max(0.0, 1 - apart / whole) if whole else float(sorted(a.split("\n")) == sorted(b.split("\n")))


def test_op5(rows, result):
    got = {r["doc_id"]: r for r in result("op5_multiset_fingerprints")}
    order = sorted(((i, t or "") for i, t, *_ in rows), reverse=True)
    prints, apart = {}, []
    for (i, t), (_, after) in zip(order, order[1:] + order[:1], strict=True):
        n = len(t) // 3
        edited = t[: len(t) - n] + after[:n]
        r = got.pop(i)
        assert (r["n_chars"], r["edited_sha256"]) == (len(t), sha(edited.encode()))
        # 512 lanes estimate what plain counts give; standard deviations are below 0.07
        apart += [abs(r["near_edited"] - likeness(t, edited)), abs(r["near_next"] - likeness(t, after))]
        assert prints.setdefault(t, r["fingerprint"]) == r["fingerprint"] and (edited != t or r["edited_fingerprint"] == r["fingerprint"])
    assert max(apart) < 0.25 and sum(apart) / len(apart) < 0.05
    assert not got and len(set(prints.values())) == len(prints)


@pytest.mark.parametrize("name", ["op6_mixing", "op7_exact_dedup", "op11_period_runs", "op12_suffix_search"])
def test_queries_with_sql(folder, result, name):
    with duckdb.connect() as db:
        for table in ("documents", "benchmark"):
            db.execute(f"CREATE VIEW {table} AS SELECT * FROM '{folder}/{table}.parquet/*.parquet'")
        columns = [d[0] for d in db.execute(queries.oracle_sql()[name]).description]
        want = db.fetchall()
    got = [tuple(r[c] for c in columns) for r in result(name)]
    plain = lambda found: sorted(tuple(round(v, 6) if isinstance(v, float) else v for v in r) for r in found)
    assert plain(got) == plain(want)


def test_op8(result):
    want = {k: f"Story {k}" for k in range(4)} | {4: "A & B\none two", 5: "", 6: "n", 7: "n"}
    got = {r["page_id"]: (r["url"], r["text"], r["n_chars"]) for r in result("op8_page_differencing")}
    assert got == {i: (u, want[i], len(want[i])) for i, u, _ in PAGES}


def words_of(text):
    return re.findall(r"[^\W\d_]+", (text or "").lower())


def pieces(word, k):
    padded = f" {word} "
    return [padded[j : j + k] for j in range(max(len(padded) - k + 1, 1))]


def plain_language(rows):
    """A function of text to (language, score), from plain counts of words and n-grams."""
    counts = {k: defaultdict(Counter) for k in range(5)}
    for _, t, lang in rows:
        for w in words_of(t):
            counts[0][w][lang] += 1
            for k in range(1, 5):
                for g in pieces(w, k):
                    counts[k][g][lang] += 1
    langs = sorted({lang for _, _, lang in rows})
    sums = {k: {x: sum(n[x] for n in t.values()) + 0.5 * (len(t) + 1) for x in langs} for k, t in counts.items()}
    share = lambda k, e: np.array([np.log((counts[k][e][x] + 0.5) / sums[k][x]) for x in langs])

    def of(word):
        if word in counts[0]:
            return share(0, word)
        for k in (4, 3, 2, 1):
            if known := [g for g in pieces(word, k) if g in counts[k]]:
                return np.mean([share(k, g) for g in known], axis=0)
        return np.zeros(len(langs))

    def predict(text):
        if not (found := words_of(text)):
            return "und", 0.0
        score = sum(of(w) for w in found)
        return langs[int(score.argmax())], float(1 / np.exp(score - score.max()).sum())

    return predict


def test_op9(rows, result):
    held = {i: zlib.crc32(str(i).encode()) % 4 == 2 for i, *_ in rows}
    predict = plain_language([(i, t, x) for i, t, x, _ in rows if t is not None and x and not held[i]])
    got = {r["doc_id"]: r for r in result("op9_language_id")}
    assert len(got) == len(rows)
    for i, t, *_ in rows:
        lang, score = predict(t)
        assert got[i]["held_out"] == held[i] and got[i]["score"] == pytest.approx(score, abs=1e-3)
        assert got[i]["lang_pred"] == lang or 0 < score < 0.51


def test_op10(rows, result):
    own = library("word_bpe_49k.json")
    want = []
    for i, t, *_ in rows:
        ids = own.encode(t or "", add_special_tokens=False).ids
        want.append((i, len(ids), sha(as_bytes(ids)), sha(own.decode(ids, skip_special_tokens=False).encode())))
    assert sorted(map(tuple, result("op10_bpe_automaton"))) == sorted(want)


def byte_spelling():
    """The bytes of every token of the byte-level file and of the piece file."""
    own = library("byte_bpe_50k.json")
    shown = [*range(33, 127), *range(161, 173), *range(174, 256)]
    hidden = [b for b in range(256) if b not in shown]
    byte = {chr(b): b for b in shown} | {chr(256 + k): b for k, b in enumerate(hidden)}
    a = [bytes(byte[c] for c in own.id_to_token(i)) for i in range(own.get_vocab_size())]
    pieces = sentencepiece.SentencePieceProcessor(model_file=public_tokenizers.path("piece_bpe_32k.model"))
    labels = [pieces.id_to_piece(i) for i in range(pieces.get_piece_size())]
    b = [bytes([int(x[3:5], 16)]) if re.fullmatch("<0x[0-9A-F]{2}>", x) else x.replace("\u2581", " ").encode() for x in labels]
    return a, b


def plain_alignment(text, spelling):
    """ids of A and B, and for each group its ids, or nothing where the bytes differ."""
    if not text:
        return [], [], []
    own, pieces = library("byte_bpe_50k.json"), sentencepiece.SentencePieceProcessor(model_file=public_tokenizers.path("piece_bpe_32k.model"))
    own.encode_special_tokens = True
    a, b = own.encode(" " + text, add_special_tokens=False).ids, pieces.encode(text)
    if any(b"".join(s[i] for i in ids) != (" " + text).encode() for s, ids in zip(spelling, (a, b), strict=True)):
        return [], [], []
    ends = [np.cumsum([len(s[i]) for i in ids]).tolist() for s, ids in zip(spelling, (a, b), strict=True)]
    groups, i, j = [], 0, 0
    for x in sorted({*ends[0]} & {*ends[1]}):
        m, n = ends[0].index(x) + 1, ends[1].index(x) + 1
        groups.append((a[i:m], b[j:n]))
        i, j = m, n
    return a, b, groups


def test_op13(rows, result):
    spelling = byte_spelling()
    found = {i: plain_alignment(t, spelling) for i, t, *_ in rows}
    count, best = Counter((x[-1], y[-1]) for _, _, groups in found.values() for x, y in groups), Counter()
    for (_, y), n in count.items():
        best[y] = max(best[y], n)
    got = {r["doc_id"]: r for r in result("op13_token_alignment")}
    assert len(got) == len(rows)
    for i, (a, b, groups) in found.items():
        r, links = got[i], [(x[-1], y[-1]) for x, y in groups]
        told = ";".join(",".join(map(str, x)) + "|" + ",".join(map(str, y)) for x, y in groups)
        assert (r["n_a"], r["n_b"], r["n_groups"], r["n_links"]) == (len(a), len(b), len(groups), len(links))
        assert r["groups_sha256"] == (sha(told.encode()) if a else "")
        assert r["count_sum"] == sum(count[x] for x in links) and r["n_best"] == sum(count[x] == best[x[1]] for x in links)


def test_pipeline_equals_its_stages_by_hand(spark, rows, folder, tmp_path):
    """A letter, and a language for those without; the largest id of equal texts; the least id
    of near ones; copies by SQL; ids."""
    predict = plain_language([(i, t, x) for i, t, x, _ in rows if t is not None and x and zlib.crc32(str(i).encode()) % 4 != 2])
    kept = {i: (t, lang or predict(t)[0], source) for i, t, lang, source in rows if any(c.isalpha() for c in t or "")}
    assert any(lang is None for i, _, lang, _ in rows if i in kept)
    last = {t: i for i, (t, _, _) in sorted(kept.items())}
    kept = {i: r for i, r in kept.items() if last[r[0]] == i}
    home = groups({i: shingles(t, 5) for i, (t, _, _) in kept.items()})
    kept = {i: r for i, r in kept.items() if home[i] == i}
    assert len(home) - 20 < len(kept) < len(home) < len(rows) - 4
    at = str(tmp_path / "survivors")
    spark.createDataFrame([(i, *r) for i, r in kept.items()], "doc_id long, text string, lang string, source string").write.parquet(at)
    with duckdb.connect() as db:
        db.execute(f"CREATE VIEW documents AS SELECT * FROM '{at}/*.parquet'")
        copies = {i: taken // size for i, size, _, _, taken in db.execute(mixing.ORACLE).fetchall()}
    own = library("word_bpe_49k.json")
    want = []
    for i, (t, lang, source) in kept.items():
        ids = own.encode(t, add_special_tokens=False).ids
        want += [(i, source, lang, len(ids), as_bytes(ids), sha(own.decode(ids, skip_special_tokens=False).encode()))] * copies[i]
    got = [(r["doc_id"], r["source"], r["lang"], r["n_tokens"], bytes(r["ids"]), r["decoded_sha256"]) for r in corpus_pipeline.run(spark, folder).collect()]
    assert sorted(got, key=str) == sorted(want, key=str)

"""Near-duplicate documents by SetSketch registers, bands and an exact check.

A text is the set of its word shingles. Register i keeps, on an exponential scale, the
truncated minimum over the set of an exponentially distributed hash: sketches of sets merge by
the larger register, and registers of two sets are equal about as often as the sets overlap.
Registers are grouped into bands; texts that agree in all of a band meet. Of each pair that
meets, the overlap is estimated by the joint likelihood of the numbers of larger, equal and
smaller registers given both sizes; pairs whose likelihood rules the threshold out go, and the
rest is confirmed on the full sets.

Groups of copies do not give all pairs. Texts with the same set are one node. In each band's
bucket every node is first paired with the least node only, and the confirmed links are joined
to components. Buckets that still hold several components are taken up again: a few times with
another hub, drawn by hash, for the members outside its component, and at last for everything
across components: in small buckets by the pairs that sizes and one bit per register do not rule
out, in large ones by looking the members outside the largest component up in indexed blocks of
the bucket; where these are many, blocks of the bucket's members are joined in themselves before.
A block gives only as many links as join its components, however many pairs hold. So no link
between components is lost to the economy of the first steps.

Rules for odd input: a null or empty text has the empty set and is linked with nothing; a text
with fewer words than a shingle is one shingle of all its words; rows with the same id are one
document, so what links one of its texts links all (but for rows with the empty set); rows with
a null id are linked with nothing and have a null component. An empty table gives an empty result; other columns are ignored.
"""

from __future__ import annotations

import itertools
from collections.abc import Callable, Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.functions import pandas_udf

from .components import joined
from .multiset_hash import MIX, mixed, word_hashes
from .shared import own_name, released, small_side, written

#: 32 bands of 4 registers miss a pair of overlap 0.8 about once in 20 million
BANDS, ROWS = 32, 4
REGISTERS = BANDS * ROWS
#: the scale of the registers: base, rate, and the largest value before truncation
BASE, RATE, LARGEST = 1.001, 20.0, 2**16 - 2
#: so often another hub is tried in a bucket before pairs are
HUB_TURNS = 1
#: buckets of up to so many members are settled by pairs, larger ones by blocks of so many
#: indexed members and so many looked up at a time
PAIRED, BLOCK, PROBES = 64, 256, 512
#: a pair goes when its overlap is below the threshold with this log-likelihood ratio
SURE = 16.0


def shingle_set(text: str, size: int) -> np.ndarray:
    """Sorted distinct 64-bit hashes of the shingles; words as bytes between ASCII white
    space, A-Z in lower case."""
    words, _ = word_hashes(text.encode("utf-8", "surrogatepass").lower())
    n = len(words)
    if not n:
        return words
    span = min(size, n)
    out = words[: n - span + 1].copy()
    for k in range(1, span):
        out = out * MIX + words[k : n - span + 1 + k]
    return np.unique(mixed(out + np.uint64(span)))


class Sketcher:
    def __init__(self, registers: int = REGISTERS, seed: int = 7):
        rng = np.random.default_rng(seed)
        self.factor = rng.integers(0, 2**63, registers, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
        self.shift = rng.integers(0, 2**63, registers, dtype=np.uint64)

    def registers(self, hashes: np.ndarray) -> np.ndarray:
        """Unsigned 16-bit registers; all zero for the empty set."""
        least = np.full(len(self.factor), 2**64 - 1, np.uint64)
        for i in range(0, len(hashes), 2048):
            part = hashes[i : i + 2048, None] * self.factor
            part += self.shift
            np.minimum(least, part.min(axis=0), out=least)
        if not len(hashes):
            return np.zeros(len(self.factor), np.uint16)
        exponential = -np.log1p(-(least.astype(np.float64) + 0.5) / 2.0**64 * (1 - 1e-16)) / RATE
        return np.clip(np.floor(1 - np.log(exponential) / np.log(BASE)), 0, LARGEST + 1).astype(np.uint16)


def _log_likelihood(overlap: np.ndarray, above: np.ndarray, below: np.ndarray, equal: np.ndarray, u: np.ndarray, v: np.ndarray) -> np.ndarray:
    """Of the counts of registers, given the overlap and the shares u + v = 1 of the sizes."""
    p = lambda x: -np.log1p(-np.clip(x, 0, 1) * (BASE - 1) / BASE) / np.log(BASE)
    more, less = p(u - v * overlap), p(v - u * overlap)
    safe = lambda x: np.log(np.maximum(x, 1e-12))
    return above * safe(more) + below * safe(less) + equal * safe(1 - more - less)


def may_reach(percent: int, size_a: np.ndarray, size_b: np.ndarray, a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Which pairs of sketches (rows of registers) the likelihood does not rule out."""
    threshold = percent / 100
    above, below = (a > b).sum(axis=1), (a < b).sum(axis=1)
    equal = a.shape[1] - above - below
    u = size_a / (size_a + size_b)
    v = 1 - u
    top = np.minimum(u, v) / np.maximum(u, v)
    grid = np.linspace(0, 1, 101)[:, None] * top
    scores = _log_likelihood(grid, above, below, equal, u, v)
    best = grid[scores.argmax(axis=0), np.arange(len(u))]
    at = _log_likelihood(np.minimum(threshold, top), above, below, equal, u, v)
    return (top >= threshold - 1e-9) & ((best >= threshold) | (scores.max(axis=0) - at <= SURE))


def sketch(text: Column, size: int) -> Column:
    """struct<n: distinct shingles, digest: of the set, registers> of a text."""

    @pandas_udf("n long, digest binary, registers binary")
    def of(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        import xxhash

        sketcher = Sketcher()
        for batch in batches:
            sets = [shingle_set(t or "", size) for t in batch]
            yield pd.DataFrame(
                {
                    "n": [len(s) for s in sets],
                    "digest": [xxhash.xxh3_128_digest(s.tobytes()) for s in sets],
                    "registers": [sketcher.registers(s).astype(">u2").tobytes() for s in sets],
                }
            )
        released()

    return of(text)


def _likely(percent: int, n_a: Column, n_b: Column, a: Column, b: Column) -> Column:
    @pandas_udf("boolean")
    def likely(n_a: pd.Series, n_b: pd.Series, a: pd.Series, b: pd.Series) -> pd.Series:
        if not len(n_a):
            return pd.Series([], dtype=bool)
        rows = [np.frombuffer(b"".join(x), ">u2").reshape(len(x), -1).astype(np.int32) for x in (a, b)]
        return pd.Series(may_reach(percent, n_a.to_numpy(float), n_b.to_numpy(float), *rows))

    return likely(n_a, n_b, a, b)


def _confirmed(percent: int, size: int, a: Column, b: Column) -> Column:
    @pandas_udf("boolean")
    def confirmed(batches: Iterator[tuple[pd.Series, pd.Series]]) -> Iterator[pd.Series]:
        for left, right in batches:
            last, held, out = None, None, []
            for x, y in zip(left, right, strict=True):
                if x != last:
                    last, held = x, shingle_set(x or "", size)
                other = shingle_set(y or "", size)
                both = len(np.intersect1d(held, other, assume_unique=True))
                out.append(100 * both >= percent * (len(held) + len(other) - both) and both > 0)
            yield pd.Series(out, dtype=bool)

    return confirmed(a, b)


def _links(pairs: DataFrame, texts: DataFrame, nodes: DataFrame, size: int, percent: int) -> DataFrame:
    """The distinct pairs (a, b) that hold on their full sets. ``nodes``: node, n, registers. No ``b``
    is in more pairs than its buckets and their hubs give; an ``a`` may be in any number."""
    side = lambda x: nodes.select(F.col("node").alias(x), F.col("n").alias(f"n_{x}"), F.col("registers").alias(f"r_{x}"))
    # dealt by b once, for the distinct pairs and the join with b's sketches
    near = pairs.repartition("b").distinct().join(side("b"), "b").join(side("a"), "a")
    near = written(near.where(_likely(percent, F.col("n_a"), F.col("n_b"), F.col("r_a"), F.col("r_b"))).select("a", "b"), "near-pairs")
    # texts are fetched once for all pairs that they are in
    wanted = written(near.select(F.col("a").alias("node")).unionByName(near.select(F.col("b").alias("node"))).distinct(), "near-nodes")
    held = written(texts.join(small_side(wanted), "node"), "near-texts")
    rows = near.join(held.select(F.col("node").alias("b"), F.col("text").alias("text_b")), "b").join(held.select(F.col("node").alias("a"), F.col("text").alias("text_a")), "a")
    return written(rows.where(_confirmed(percent, size, F.col("text_a"), F.col("text_b"))).select("a", "b"), "near-links")


def near_duplicates(docs: DataFrame, *, shingle: int = 5, percent: int = 80, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Per row: doc_id, n_shingles, component_id (least id reachable over links), kept."""
    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text"))
    sketched = written(rows.select("doc_id", sketch(F.col("text"), shingle).alias("s")).select("doc_id", "s.*"), "sketches")

    # texts with one set are one node, named by their least id
    some = sketched.where("n > 0 and doc_id is not null")
    nodes = written(
        some.groupBy("digest", "n").agg(F.min(F.struct("doc_id", "registers")).alias("first")).select("digest", "n", F.col("first.doc_id").alias("node"), F.col("first.registers").alias("registers")),
        "nodes",
    )
    # a document repeated with different texts may name several nodes: each keeps its sketch, all
    # its texts are fetched by its id, and what links one of them links the document
    sketches = nodes.select("node", "n", "registers")
    several = some.groupBy("doc_id").agg(F.min("digest").alias("d0"), F.max("digest").alias("d1")).where("d0 <> d1").select("doc_id")
    several = small_side(written(several, "repeated-ids"))
    same = written(some.join(several, "doc_id").join(nodes.select("digest", "n", "node"), ["digest", "n"]).select(F.col("doc_id").alias("a"), F.col("node").alias("b")).where("a <> b").distinct(), "same-ids")
    texts = rows.where("doc_id is not null").select(F.col("doc_id").alias("node"), "text")

    part = 2 * ROWS
    bands = F.array(*[F.xxhash64(F.lit(k), F.substring(F.col("registers"), k * part + 1, part)) for k in range(BANDS)])
    keys = nodes.select("node", F.posexplode(bands).alias("band", "key"))
    buckets = written(keys.groupBy("key").agg(F.min("node").alias("hub"), F.max("node").alias("last")).where("hub < last").select("key", "hub"), "buckets")
    met = written(keys.join(buckets, "key"), "bucket-members")

    stars = met.where("node <> hub").select(F.col("hub").alias("a"), F.col("node").alias("b"))
    found = joined(same.unionByName(_links(stars, texts, sketches, shingle, percent)))

    # buckets in which several components are left: each time another hub is tried
    for turn in range(HUB_TURNS):
        placed = _placed(met, found)
        draw = F.struct(F.xxhash64("node", F.lit(turn)).alias("h"), "node", "component")
        several = placed.groupBy("key").agg(F.min("component").alias("c0"), F.max("component").alias("c1"), F.min(draw).alias("hub")).where("c0 < c1")
        # written first: joined to its own groups, a frequent key could not be split
        several = written(several.select("key", F.col("hub.node").alias("other"), F.col("hub.component").alias("other_component")), "open-hubs")
        tried = placed.join(small_side(several), "key").where("component <> other_component")
        more = tried.select(F.col("other").alias("a"), F.col("node").alias("b"))
        found = joined(_links(more, texts, sketches, shingle, percent), found)

    found, left = _joined_in_blocks(met, found, texts, shingle, percent)

    # and then everything across components: pairs in small buckets, blocks in large ones
    about = sketches.select("node", "n", *_bit_signature(F.col("registers")), bands.alias("keys"))
    small = left.where(F.col("size") <= PAIRED).join(about, "node")
    across = small.alias("x").join(
        small.alias("y"),
        F.expr(
            "x.key = y.key and x.component < y.component"
            f" and 100 * least(x.n, y.n) >= {percent} * greatest(x.n, y.n)"
            f" and bit_count(x.b0 ^ y.b0) + bit_count(x.b1 ^ y.b1) <= {_most_bits(percent)}"
        ),
    )
    rest = across.select(F.least("x.node", "y.node").alias("a"), F.greatest("x.node", "y.node").alias("b"))
    links = _links(rest, texts, sketches, shingle, percent)
    links = links.unionByName(_block_links(left.where(F.col("size") > PAIRED), texts, shingle, percent))
    final = joined(links, found)

    home = nodes.select("digest", F.col("n").alias("n_of"), "node").join(final, "node", "left").select("digest", "n_of", F.coalesce("component", "node").alias("component_id"))
    out = sketched.select("doc_id", "n", "digest").join(home, (F.col("n") == F.col("n_of")) & (sketched["digest"] == home["digest"]), "left")
    component = F.when(F.col("doc_id").isNotNull(), F.coalesce("component_id", "doc_id"))
    return out.select("doc_id", F.col("n").alias("n_shingles"), component.alias("component_id")).withColumn("kept", F.expr("doc_id <=> component_id"))


def _joined_in_blocks(met: DataFrame, found: DataFrame, texts: DataFrame, size: int, percent: int) -> tuple[DataFrame, DataFrame]:
    """The components after large buckets that many members are apart in were cut into blocks, each
    joined in itself, and what is left open. The blocks are dealt anew as long as that joins at least
    half of what was apart; each round reads a member of a bucket once."""
    left, apart = _open(met, found), None
    for turn in itertools.count():
        wide = _plan(left.where(F.col("size") > PAIRED)).where(F.col("outside") > PROBES)
        wide = written(wide.select("key", "parts", F.ceil(F.col("all") / BLOCK).cast("int").alias("blocks")), "wide-buckets")
        now = wide.agg(F.sum("parts")).first()[0]
        if not now or apart is not None and now > apart / 2:
            return found, left
        apart = now
        dealt = written(left.join(small_side(wide), "key").select("key", "node", "component", _share("blocks", turn + 3).alias("block")), "own-blocks")
        work = _with_texts(dealt, texts).withColumns({"held": F.lit(True), "probe": F.lit(True)})
        links = written(work.groupBy("key", "block").applyInPandas(_joins(size, percent), "a long, b long").distinct(), "own-links")
        found = joined(links, found)
        left = _open(met, found)


def _block_links(left: DataFrame, texts: DataFrame, size: int, percent: int) -> DataFrame:
    """Links that join all components which links on full sets join in large buckets, without
    forming pairs.

    A bucket is cut into blocks of about ``BLOCK`` members, whose sets are indexed by shingle.
    The members outside of the bucket's largest component are looked up in every block, about
    ``PROBES`` at a time, so a group holds a bounded number of texts whatever the bucket, and it
    gives fewer links than it holds components."""
    plan = _plan(left)
    plan = plan.select("key", "main", F.ceil(F.col("all") / BLOCK).cast("int").alias("blocks"), F.ceil(F.col("outside") / PROBES).cast("int").alias("turns"))
    # written first: joined to its own groups, a frequent key could not be split
    plan = small_side(written(plan, "large-plans"))
    rows = written(left.select("key", "node", "component").join(plan, "key"), "large-buckets")
    every = lambda count: F.explode(F.sequence(F.lit(0), F.col(count) - 1))
    indexed = rows.select("key", "node", "component", F.lit(True).alias("held"), F.lit(False).alias("probe"), _share("blocks", 1).alias("block"), every("turns").alias("turn"))
    probes = rows.where("component <> main").select("key", "node", "component", F.lit(False).alias("held"), F.lit(True).alias("probe"), _share("turns", 2).alias("turn"), every("blocks").alias("block"))
    work = _with_texts(indexed.unionByName(probes), texts, rows)
    found = work.groupBy("key", "block", "turn").applyInPandas(_joins(size, percent), "a long, b long")
    return written(found.distinct(), "block-links")


def _joins(size: int, percent: int) -> Callable[[pd.DataFrame], pd.DataFrame]:
    """Of a group's links between members that are looked up (``probe``) and members that are
    indexed (``held``): as many as join the components, so that fewer links come out than
    components go in, however many pairs hold."""

    def joins(group: pd.DataFrame) -> pd.DataFrame:
        nodes, texts = group["node"].tolist(), group["text"].fillna("").tolist()
        label = np.unique(group["component"].to_numpy(), return_inverse=True)[1]
        of = {t: shingle_set(t, size) for t in set(texts)}
        held, out = np.flatnonzero(group["held"].to_numpy(bool)), []
        if len(held):
            lengths = np.array([len(of[texts[k]]) for k in held])
            flat, owner = np.concatenate([of[texts[k]] for k in held]), np.repeat(np.arange(len(held)), lengths)
            order = np.argsort(flat, kind="stable")
            flat, owner = flat[order], owner[order]
            for i in np.flatnonzero(group["probe"].to_numpy(bool)).tolist():
                if (label[held] == label[i]).all():
                    continue
                mine = of[texts[i]]
                lo, hi = np.searchsorted(flat, mine, "left"), np.searchsorted(flat, mine, "right")
                n = hi - lo
                at = np.repeat(lo - np.cumsum(n) + n, n) + np.arange(n.sum())
                both = np.bincount(owner[at], minlength=len(held))
                near = held[(both > 0) & (100 * both >= percent * (len(mine) + lengths - both))]
                while len(near := near[label[near] != label[i]]):
                    other = nodes[near[0]]
                    out.append((min(nodes[i], other), max(nodes[i], other)))
                    label[label == label[near[0]]] = label[i]
        return pd.DataFrame(out, columns=["a", "b"], dtype="int64")

    return joins


def _plan(left: DataFrame) -> DataFrame:
    """Per bucket: its largest component (main), members outside of it, all members, components."""
    sizes = left.groupBy("key", "component").agg(F.count("*").alias("c"), F.first("size").alias("size"))
    most = F.max_by("component", F.struct("c", "component"))
    return sizes.groupBy("key").agg(most.alias("main"), (F.max("size") - F.max("c")).alias("outside"), F.max("size").alias("all"), F.count("*").alias("parts"))


def _share(count: str, salt: int) -> Column:
    return F.pmod(F.xxhash64("node", F.lit(salt)), F.col(count)).cast("int")


def _with_texts(rows: DataFrame, texts: DataFrame, of: DataFrame | None = None) -> DataFrame:
    """``rows`` with the texts of their nodes, which are those of ``of``, fetched once."""
    wanted = written((rows if of is None else of).select("node").distinct(), "block-nodes")
    return rows.join(written(texts.join(small_side(wanted), "node"), "block-texts"), "node")


def _edges(found: DataFrame) -> DataFrame:
    """Links (a, b) that give the components again."""
    return found.select(F.col("node").alias("a"), F.col("component").alias("b"))


def _open(met: DataFrame, found: DataFrame) -> DataFrame:
    """The members of buckets that hold several components, with the size of the bucket."""
    placed = _placed(met, found)
    several = placed.groupBy("key").agg(F.min("component").alias("c0"), F.max("component").alias("c1"), F.count("*").alias("size")).where("c0 < c1").select("key", "size")
    # written first: joined to its own groups, a frequent key could not be split
    return written(placed.join(small_side(written(several, "open-keys")), "key"), "open-buckets")


def _placed(met: DataFrame, found: DataFrame) -> DataFrame:
    """The members of buckets with the component that each is in so far."""
    return met.join(found, "node", "left").select("key", "band", "node", F.coalesce("component", "node").alias("component"))


def _bit_signature(registers: Column) -> list[Column]:
    """One hashed bit of each register, as two longs."""
    halves = []
    for h in range(2):
        bits = [
            F.shiftleft(F.xxhash64(F.substring(registers, 2 * i + 1, 2)).bitwiseAND(F.lit(1)), i - h * REGISTERS // 2)
            for i in range(h * REGISTERS // 2, (h + 1) * REGISTERS // 2)
        ]
        whole = bits[0]
        for b in bits[1:]:
            whole = whole.bitwiseOR(b)
        halves.append(whole.alias(f"b{h}"))
    return halves


def _most_bits(percent: int) -> int:
    """So many bits differ between sets at the threshold at most, seven standard deviations up."""
    p = (1 - percent / 100) / 2
    return int(REGISTERS * p + 7 * (REGISTERS * p * (1 - p)) ** 0.5) + 1


def drop_near_duplicates(docs: DataFrame, *, shingle: int = 5, percent: int = 80, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``docs`` with one document of each group of near-duplicates, with all columns."""
    own = own_name(docs, "_gone")
    found = near_duplicates(docs, shingle=shingle, percent=percent, id_col=id_col, text_col=text_col)
    gone = written(found.where("not kept").select(F.col("doc_id").alias(own)).distinct(), "near-gone")
    return docs.join(small_side(gone), F.col(id_col) == F.col(own), "left_anti")

"""BPE encoding by a deterministic automaton over tokens, and decoding by its arc labels.

The automaton starts with one state that reads every base symbol and returns to itself. Each
merge (u, v) -> w, in order, adds one gadget: the state s that u leads to is copied without
its arc for v, u is led to the copy, and every state that reads u also reads w and goes where
v leads. All arcs of a token lead to one state, and tokens whose arcs start at the same states
are one column, so the finished table is a bit per state and column: some ten thousand of each,
whatever is encoded. It is compiled once, on the driver, and sent to the tasks.

A pre-split word has exactly one accepted path, found from left to right: of every prefix the
automaton leaves one last token. The new words of a batch go through the table together, one
transition of all of them at a time.

Each distinct word of a batch is encoded once, and words are kept in a cache of bounded size.
Normalising and pre-splitting follow the vocabulary file: where its rules are those below,
texts of plain characters are cut by Arrow, and all others at ASCII white space (no token spans
it) and then by the library. Special tokens in a text are matched as the file says.

Rules for odd input: null and empty texts give no tokens and the empty decoded text; repeated
rows are encoded alike; tables may be empty; other columns are untouched. A vocabulary whose
merges use tokens that no earlier merge made is refused, as the automaton would differ.
"""

from __future__ import annotations

import json
import os
import re
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, SparkSession
from pyspark.sql.functions import arrow_udf

from .pieces import PieceCache, by_kind, encode_pieces, flat_ids, ids_array, text_runs
from .shared import released

#: what a text has that is not of printable ASCII, white space of it and the letters of Latin-1
STRANGE = r"[^\t-\r -~À-ÖØ-öø-ÿ]"
#: the words of other texts, in lower case
PLAIN_WORDS = r"'s|'t|'re|'ve|'m|'ll|'d|[a-zß-öø-ÿ]+|[0-9]|[^a-z0-9ß-öø-ÿ\t-\r ]+"
#: the rules of a vocabulary file for which PLAIN_WORDS is a shortcut
NORMAL_RULES = {"type": "Sequence", "normalizers": [{"type": "NFC"}, {"type": "Replace", "pattern": {"Regex": r"\s+"}, "content": " "}, {"type": "Lowercase"}]}
WORD_RULES = {
    "type": "Sequence",
    "pretokenizers": [
        {"type": "Split", "pattern": {"Regex": r"'s|'t|'re|'ve|'m|'ll|'d|[\p{L}]+|[\p{N}]|[^\s\p{L}\p{N}]+"}, "behavior": "Removed", "invert": True},
        {"type": "ByteLevel", "add_prefix_space": False, "trim_offsets": True, "use_regex": False},
    ],
}
#: words of more symbols take the table one by one
LONG_WORD = 64


class MergeAutomaton:
    """The arc table over the tokens of a list of merges, and the tree of their spellings."""

    def __init__(self, base: dict[str, int], merges: list[tuple[int, int, int]]):
        """``base``: symbols to ids; ``merges``: (u, v, w) ids in order of priority."""
        size = max([*base.values(), *(i for m in merges for i in m), 0]) + 1
        self.symbols = {s: k for k, s in enumerate(base)}
        #: the state that a token's arcs lead to, and its column of the arc table; -1 for none
        self.state, self.column = np.full(size, -1, np.int32), np.full(size, -1, np.int32)
        self._compile(list(base.values()), merges)
        self._spell(list(base.values()), merges)

    def _compile(self, base: list[int], merges: list[tuple[int, int, int]]) -> None:
        state, column = self.state.tolist(), self.column.tolist()
        for b in base:
            state[b] = column[b] = 0
        users, sharers = [len(base)], [len(base)]  # how many tokens lead to a state, have a column
        arcs = np.full((64, 8), 255, np.uint8)  # a bit per state and column
        idle: set[int] = set()
        for u, v, w in merges:
            if u in idle or v in idle:
                idle.add(w)
                continue
            if state[u] < 0 or state[v] < 0 or state[w] >= 0:
                raise ValueError("merges must build each token once, from earlier ones")
            s, c = state[u], column[v]
            if not arcs[s, c >> 3] >> (c & 7) & 1:
                # no word brings u and v together at this point, so there is no gadget
                idle.add(w)
                continue
            state[w] = state[v]
            users[state[v]] += 1
            if users[s] > 1:
                users[s] -= 1
                users.append(1)
                if len(users) > len(arcs):
                    arcs = np.concatenate([arcs, np.zeros_like(arcs)])
                arcs[len(users) - 1] = arcs[s]
                s = state[u] = len(users) - 1
            if sharers[c] > 1:
                sharers[c] -= 1
                sharers.append(1)
                new = len(sharers) - 1
                if new >= 8 * arcs.shape[1]:
                    arcs = np.concatenate([arcs, np.zeros_like(arcs)], axis=1)
                held = arcs[: len(users)]
                bits = (held[:, c >> 3] >> (c & 7)) & 1
                # the bit of a fresh column may hold anything so far
                held[:, new >> 3] = (held[:, new >> 3] & (255 ^ (1 << (new & 7)))) | (bits << (new & 7))
                c = column[v] = new
            arcs[s, c >> 3] &= 255 ^ (1 << (c & 7))
            column[w] = column[u]
            sharers[column[u]] += 1
        self.arcs = np.ascontiguousarray(arcs[: len(users), : (len(sharers) + 7) // 8])
        self.state, self.column = np.array(state, np.int32), np.array(column, np.int32)

    def _spell(self, base: list[int], merges: list[tuple[int, int, int]]) -> None:
        """The tree: node * symbols + symbol -> node, and the token that ends at a node."""
        n = len(self.symbols)
        spelt: dict[int, tuple[int, ...]] = {b: (k,) for k, b in enumerate(base)}
        for u, v, w in merges:
            if self.state[w] >= 0:
                spelt[w] = spelt[u] + spelt[v]
        edges: dict[int, int] = {}
        ends = [-1]
        self.length = np.zeros(len(self.state), np.int32)
        for t, word in spelt.items():
            self.length[t], at = len(word), 0
            for symbol in word:
                key = at * n + symbol
                if (at := edges.get(key, -1)) < 0:
                    at = edges[key] = len(ends)
                    ends.append(-1)
            ends[at] = t
        self.edges = np.array(sorted(edges), np.int64)
        self.nodes = np.array([edges[k] for k in self.edges.tolist()], np.int32)
        self.ends = np.array(ends, np.int32)

    def reads(self, last: np.ndarray, token: np.ndarray) -> np.ndarray:
        """Whether the states after the tokens ``last`` have arcs for the tokens ``token``."""
        c = self.column[token]
        return (self.arcs[self.state[last], c >> 3] >> (c & 7)) & 1 > 0

    def step(self, node: np.ndarray, symbol: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Which of the nodes of the tree go on by their symbols, and where those lead."""
        if not len(self.edges):
            return np.zeros(len(node), bool), node[:0]
        key = node * np.int64(len(self.symbols)) + symbol
        at = np.minimum(np.searchsorted(self.edges, key), len(self.edges) - 1)
        hit = self.edges[at] == key
        return hit, self.nodes[at[hit]]

    def encode_all(self, symbols: np.ndarray, lengths: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The tokens on the accepted paths of many words, one after another, and how many each
        word has. ``symbols``: numbers of the base symbols of all words, one after another."""
        last = np.full(len(symbols), -1, np.int32)  # the last token of the prefix that ends here
        starts = np.cumsum(lengths) - lengths
        order = np.argsort(-lengths, kind="stable")
        first, size = starts[order], lengths[order]
        for j in range(int(size[0]) if len(size) else 0):
            active = int(np.searchsorted(-size, -j, "left"))  # words longer than j come first
            at, left = first[:active] + j, size[:active] - j
            before = last[at - 1] if j else None
            node = np.zeros(active, np.int32)
            while len(at):
                hit, node = self.step(node, symbols[at])
                at, left = at[hit], left[hit]
                token = self.ends[node]
                new = np.flatnonzero((token >= 0) & (last[at] < 0))
                if j:
                    before = before[hit]
                    new = new[self.reads(before[new], token[new])]
                last[at[new]] = token[new]
                on = np.flatnonzero(left > 1)
                at, left, node = at[on] + 1, left[on] - 1, node[on]
                before = before[on] if j else None
        # back from the ends of the words
        marked = np.zeros(len(symbols), bool)
        at, floor = (starts + lengths - 1)[lengths > 0], starts[lengths > 0]
        while len(at):
            marked[at] = True
            at = at - self.length[last[at]]
            on = at >= floor
            at, floor = at[on], floor[on]
        sums = np.concatenate([[0], np.cumsum(marked)])
        return last[marked], sums[starts + lengths] - sums[starts]

    def encode(self, symbols: list[str]) -> list[int]:
        """The tokens on the one accepted path that spells the base symbols."""
        return self.encode_long(np.array([self.symbols[s] for s in symbols], np.int64)).tolist()

    def encode_long(self, symbols: np.ndarray) -> np.ndarray:
        """The same for a single word: all starts of a token at one position are tried together."""
        tree = [(0, -1)]  # (node, token before its start) of the spellings under way
        last = np.full(len(symbols), -1, np.int32)
        for i in range(len(symbols)):
            before = np.array([b for _, b in tree], np.int32)
            hit, node = self.step(np.array([n for n, _ in tree], np.int32), np.full(len(tree), symbols[i]))
            before, token = before[hit], self.ends[node]
            for b, t in zip(before.tolist(), token.tolist(), strict=True):
                if t >= 0 and (b < 0 or self.reads(np.array([b]), np.array([t]))[0]):
                    last[i] = t
                    break
            tree = [*zip(node.tolist(), before.tolist(), strict=True), (0, int(last[i]))]
        out, i = [], len(symbols) - 1
        while i >= 0:
            out.append(last[i])
            i -= int(self.length[last[i]])
        return np.array(out[::-1], np.int32)


def _byte_alphabet() -> dict[str, int]:
    """The characters that stand for bytes in byte-level vocabularies."""
    own = [*range(33, 127), *range(161, 173), *range(174, 256)]
    rest = [b for b in range(256) if b not in own]
    return {chr(b): b for b in own} | {chr(256 + k): b for k, b in enumerate(rest)}


@dataclass
class BpeFile:
    """What the tasks need of a vocabulary file: its rules without the model's tables, the
    automaton, and the label of every id."""

    rules: dict
    automaton: MergeAutomaton
    labels: pa.Array


class WordBpe:
    """A vocabulary file of the tokenizers library with word ends, by the automaton."""

    def __init__(self, file: BpeFile):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        spec, self.automaton = file.rules, file.automaton
        end = spec["model"].get("end_of_word_suffix") or ""
        # the file's own normaliser and pre-tokenizer cut the words; merging is done here
        library = Tokenizer.from_str(json.dumps(spec))
        self.normalizer, self.pre_tokenizer = library.normalizer, library.pre_tokenizer
        self.plain_rules = spec["pre_tokenizer"] == WORD_RULES and spec["normalizer"] == NORMAL_RULES
        self.special = {t["content"]: t["id"] for t in spec["added_tokens"]}
        self.special_cut = re.compile("(" + "|".join(map(re.escape, sorted(self.special, key=len, reverse=True))) + ")") if self.special else None
        self.labels = file.labels
        # a symbol outside the vocabulary has no token, as in a file without one for unknowns
        numbers = self.automaton.symbols
        alphabet = _byte_alphabet()
        self.bytes_of = {ord(c): chr(b) for c, b in alphabet.items()}
        self.inner, self.final = np.full(256, -1, np.int64), np.full(256, -1, np.int64)
        for c, b in alphabet.items():
            self.inner[b], self.final[b] = numbers.get(c, -1), numbers.get(c + end, -1)
        self.words, self.pieces = PieceCache(100_000), PieceCache(25_000)

    def _words(self, words: list[bytes]) -> list[bytes]:
        """The ids of distinct words."""
        flat = np.frombuffer(b"".join(words), np.uint8)
        lengths = np.fromiter(map(len, words), np.int64, len(words))
        symbols = self.inner[flat]
        ends = np.cumsum(lengths) - 1
        symbols[ends[lengths > 0]] = self.final[flat[ends[lengths > 0]]]
        known = symbols >= 0
        if not known.all():
            sums = np.concatenate([[0], np.cumsum(known)])
            lengths, symbols = sums[ends + 1] - sums[ends + 1 - lengths], symbols[known]
        long = lengths > LONG_WORD
        in_long = np.repeat(long, lengths)
        tokens, counts = self.automaton.encode_all(symbols[~in_long], np.where(long, 0, lengths))
        data, stops = tokens.astype("<u4").tobytes(), (4 * np.cumsum(counts)).tolist()
        out = [data[a:b] for a, b in zip([0, *stops], stops, strict=False)]
        starts = np.cumsum(lengths) - lengths
        for k in np.flatnonzero(long).tolist():
            out[k] = self.automaton.encode_long(symbols[starts[k] : starts[k] + lengths[k]]).astype("<u4").tobytes()
        return out

    def _distinct_words(self, words: pa.Array) -> pa.Array:
        words = words.cast(pa.binary()).to_pylist()
        return pa.array(self.words.look_up(words, self._words), pa.binary())

    def _is_plain(self, texts: pa.Array) -> pa.Array:
        if not self.plain_rules:
            return pa.array(np.zeros(len(texts), bool))
        other = pc.match_substring_regex(texts, STRANGE)
        for token in self.special:
            other = pc.or_(other, pc.match_substring(texts, token))
        return pc.invert(other)

    def _plain(self, texts: pa.Array) -> pa.Array:
        cut = pc.replace_substring_regex(pc.utf8_lower(texts), PLAIN_WORDS, r"\0 ")
        return encode_pieces(pc.ascii_split_whitespace(cut), self._distinct_words)

    def _mixed(self, texts: pa.Array) -> pa.Array:
        kinds = lambda pieces: by_kind(pieces, self._is_plain(pieces), self._plain, self._strange)
        return encode_pieces(pc.ascii_split_whitespace(texts), kinds)

    def _strange(self, pieces: pa.Array) -> pa.Array:
        return pa.array(self.pieces.look_up(pieces.to_pylist(), self._by_library), pa.binary())

    def _by_library(self, pieces: list[str]) -> list[bytes]:
        cut = [self._cut(p) for p in pieces]
        distinct = list({w for ws in cut for w in ws if isinstance(w, bytes)})
        known = dict(zip(distinct, self.words.look_up(distinct, self._words), strict=True))
        return [b"".join([known[w] if isinstance(w, bytes) else w.to_bytes(4, "little") for w in ws]) for ws in cut]

    def _cut(self, text: str) -> list[bytes | int]:
        """The words of a text as bytes, and the ids of special tokens between them."""
        if self.special_cut and (parts := self.special_cut.split(text))[1:]:
            return [x for p in parts if p for x in ([self.special[p]] if p in self.special else self._cut(p))]
        norm = self.normalizer.normalize_str(text) if self.normalizer else text
        return [word.translate(self.bytes_of).encode("latin-1") for word, _ in self.pre_tokenizer.pre_tokenize_str(norm)]

    def encode_array(self, texts: pa.Array) -> pa.Array:
        """The ids of each text as little-endian unsigned 32-bit integers."""
        return by_kind(texts, self._is_plain(texts), self._plain, self._mixed)

    def decode_array(self, ids: pa.Array) -> pa.Array:
        """The labels of the ids' arcs, joined as the library does without a decoder."""
        flat, bounds = flat_ids(ids)
        labels = self.labels.take(pa.array(flat))
        return pc.binary_join(pa.ListArray.from_arrays(pa.array(bounds, pa.int32()), labels), " ")

    def encode(self, texts: list[str]) -> list[bytes]:
        return self.encode_array(pa.array(texts, pa.string())).to_pylist()

    def decode(self, ids: bytes) -> str:
        return self.decode_array(pa.array([ids], pa.binary()))[0].as_py()


def bpe_file(path: str) -> BpeFile:
    """Reads a vocabulary file and compiles its automaton."""
    with open(path, encoding="utf-8") as f:
        spec = json.load(f)
    vocab = spec["model"]["vocab"]
    merges = [tuple(m.split(" ")) if isinstance(m, str) else tuple(m) for m in spec["model"]["merges"]]
    made = {u + v for u, v in merges}
    automaton = MergeAutomaton({s: i for s, i in vocab.items() if s not in made}, [(vocab[u], vocab[v], vocab[u + v]) for u, v in merges])
    labels = {i: s for s, i in vocab.items()} | {t["id"]: t["content"] for t in spec["added_tokens"]}
    rules = spec | {"model": spec["model"] | {"vocab": {}, "merges": []}}
    return BpeFile(rules, automaton, pa.array([labels.get(i, "") for i in range(max(labels) + 1)]))


_SENT: dict[str, object] = {}
_WORD_BPE: dict[str, WordBpe] = {}


def _sent(path: str):
    """What a file says as a broadcast of this session: its size is the vocabulary's."""
    spark = SparkSession.getActiveSession()
    key = f"{spark.sparkContext.applicationId} {path}"
    if key not in _SENT:
        _SENT[key] = spark.sparkContext.broadcast(bpe_file(path))
    return _SENT[key]


def _word_bpe(path: str, sent) -> WordBpe:
    if path not in _WORD_BPE:
        _WORD_BPE[path] = WordBpe(sent.value)
    return _WORD_BPE[path]


def round_trip(text: Column, tokenizer_path: str) -> Column:
    """struct<ids binary, decoded string> of a text."""
    sent = _sent(tokenizer_path)

    @arrow_udf("ids binary, decoded string")
    def encode_and_decode(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        bpe = _word_bpe(tokenizer_path, sent)
        for batch in batches:
            ids = ids_array([bpe.encode_array(run) for run in text_runs(batch)])
            decoded = [bpe.decode_array(run) for run in text_runs(ids)]
            yield pa.StructArray.from_arrays([ids, pa.concat_arrays(decoded) if decoded else pa.array([], pa.string())], ["ids", "decoded"])
            del batch, ids, decoded
            released()

    return encode_and_decode(text)


def decoded(ids: Column, tokenizer_path: str) -> Column:
    """The text of ids given as little-endian unsigned 32-bit integers; null gives empty."""
    sent = _sent(tokenizer_path)

    @arrow_udf("string")
    def decode(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        bpe = _word_bpe(tokenizer_path, sent)
        for batch in batches:
            out = [bpe.decode_array(run) for run in text_runs(batch)]
            yield pa.concat_arrays(out) if out else pa.array([], pa.string())

    return decode(ids)

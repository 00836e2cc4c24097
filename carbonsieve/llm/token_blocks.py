"""Token ids in binary files of patched frame-of-reference blocks.

A file holds the ids of many documents, one after another, cut into blocks. Of each block the
minimum is subtracted, the rest is packed at the width that a percentile of the values needs,
and what does not fit keeps its low bits in place and its high bits in an exception list. The
footer has the start of every block and the id and length of every document, so a reader can
go to any token without reading what lies before. Files are written and read through a Spark
data source, ``token_blocks``: rows (doc_id, ids) in partition order, ids little-endian
unsigned 32-bit integers, or rows (doc_id, text) with a tokenizer to encode them by.

Rules for odd input: a null text is encoded as the empty text; null ids of documents come
last and are kept as null; rows with the same id are all written, ordered by their text; an
empty table gives a set without files. Other columns are ignored.
"""

from __future__ import annotations

import json
import os
import struct
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.datasource import DataSource, DataSourceArrowWriter, DataSourceReader

from . import files
from .pieces import PieceCache, by_kind, encode_pieces, flat_ids, text_runs

MAGIC = b"PFORTOK1"
BLOCK = 4096
PERCENTILE = 90
BLOCK_HEAD = struct.Struct("<IIBH")
TRAILER = struct.Struct("<QQQQ8s")
BATCH_BYTES = 4 << 20


# ---- blocks -------------------------------------------------------------------------------


def pack_block(values: np.ndarray, percentile: int = PERCENTILE) -> bytes:
    """One block of at most 65,535 unsigned 32-bit values."""
    low = int(values.min())
    rest = (values - np.uint32(low)).astype(np.uint32)
    at = (len(rest) * percentile - 1) // 100
    width = int(np.partition(rest, at)[at]).bit_length()
    wide = np.flatnonzero(rest >> np.uint32(width)) if width < 32 else np.empty(0, np.int64)
    out = [BLOCK_HEAD.pack(len(rest), low, width, len(wide))]
    if width:
        bits = (rest[:, None] >> np.arange(width, dtype=np.uint32)) & np.uint32(1)
        out.append(np.packbits(bits.astype(np.uint8).ravel(), bitorder="little").tobytes())
    out += [wide.astype("<u2").tobytes(), (rest[wide] >> np.uint32(width)).astype("<u4").tobytes() if len(wide) else b""]
    return b"".join(out)


def unpack_block(data: bytes) -> np.ndarray:
    n, low, width, n_wide = BLOCK_HEAD.unpack_from(data)
    at = BLOCK_HEAD.size
    packed = (n * width + 7) // 8
    if width:
        bits = np.unpackbits(np.frombuffer(data, np.uint8, packed, at), count=n * width, bitorder="little").reshape(n, width)
        filled = np.zeros((n, 32), np.uint8)
        filled[:, :width] = bits
        values = np.packbits(filled, axis=1, bitorder="little").view("<u4").ravel()
    else:
        values = np.zeros(n, np.uint32)
    at += packed
    if n_wide:
        where = np.frombuffer(data, "<u2", n_wide, at)
        high = np.frombuffer(data, "<u4", n_wide, at + 2 * n_wide)
        values[where] |= high << np.uint32(width)
    return values + np.uint32(low)


# ---- files --------------------------------------------------------------------------------


class BlockFileWriter:
    def __init__(self, out):
        self.out, self.at = out, 0
        self.starts: list[int] = []
        self.ids: list[int] = []
        self.nulls: list[int] = []
        self.lengths: list[int] = []
        self.waiting: list[np.ndarray] = []
        self.held = self.total = 0
        self._put(MAGIC)

    def _put(self, data: bytes) -> None:
        self.out.write(data)
        self.at += len(data)

    def _block(self, values: np.ndarray) -> None:
        self.starts.append(self.at)
        self._put(pack_block(values))

    def add(self, doc_id: int | None, ids: np.ndarray) -> None:
        self.ids.append(doc_id or 0)
        self.nulls.append(doc_id is None)
        self.lengths.append(len(ids))
        self.total += len(ids)
        self.waiting.append(ids)
        self.held += len(ids)
        if self.held >= BLOCK:
            flat = np.concatenate(self.waiting)
            whole = self.held // BLOCK * BLOCK
            for i in range(0, whole, BLOCK):
                self._block(flat[i : i + BLOCK])
            self.waiting, self.held = [flat[whole:]], self.held - whole

    def close(self) -> None:
        if self.held:
            self._block(np.concatenate(self.waiting))
        footer = self.at
        for values, kind in ((self.starts, "<u8"), (self.ids, "<i8"), (self.lengths, "<u8"), (self.nulls, "u1")):
            self._put(np.array(values, dtype=kind).tobytes())
        self._put(TRAILER.pack(footer, len(self.starts), len(self.ids), self.total, MAGIC))


class BlockFile:
    """A file opened for reading: ``src`` is seekable."""

    def __init__(self, src, size: int):
        self.src = src
        src.seek(size - TRAILER.size)
        self.footer, n_blocks, n_docs, self.total, magic = TRAILER.unpack(src.read(TRAILER.size))
        if magic != MAGIC:
            raise ValueError("not a token block file")
        src.seek(self.footer)
        data = src.read(size - TRAILER.size - self.footer)
        self.starts = np.frombuffer(data, "<u8", n_blocks)
        self.ids = np.frombuffer(data, "<i8", n_docs, 8 * n_blocks)
        self.lengths = np.frombuffer(data, "<u8", n_docs, 8 * (n_blocks + n_docs))
        self.nulls = np.frombuffer(data, "u1", n_docs, 8 * (n_blocks + 2 * n_docs))

    def block(self, k: int) -> np.ndarray:
        end = int(self.starts[k + 1]) if k + 1 < len(self.starts) else self.footer
        self.src.seek(int(self.starts[k]))
        return unpack_block(self.src.read(end - int(self.starts[k])))

    def tokens(self, start: int, stop: int) -> np.ndarray:
        """Tokens start to stop of this file; only their blocks are read."""
        if stop <= start:
            return np.empty(0, np.uint32)
        first = start // BLOCK
        flat = np.concatenate([self.block(k) for k in range(first, (stop - 1) // BLOCK + 1)])
        return flat[start - first * BLOCK : stop - first * BLOCK]

    def documents(self) -> Iterator[tuple[int | None, int, np.ndarray]]:
        """(doc_id, start, ids) in file order, with a few blocks in memory at a time."""
        at, k, held = 0, 0, np.empty(0, np.uint32)
        for doc_id, null, n in zip(self.ids.tolist(), self.nulls.tolist(), self.lengths.tolist(), strict=True):
            if len(held) < n:
                more, have = [held], len(held)
                while have < n:
                    more.append(self.block(k))
                    have += len(more[-1])
                    k += 1
                held = np.concatenate(more)
            yield None if null else doc_id, at, held[:n]
            held, at = held[n:], at + n


# ---- data source --------------------------------------------------------------------------


class TokenBlocks(DataSource):
    """spark.read / df.write with format("token_blocks"); writes take (doc_id long, ids binary)."""

    @classmethod
    def name(cls) -> str:
        return "token_blocks"

    def schema(self) -> str:
        return "doc_id long, start long, n_tokens long, ids binary"

    def reader(self, schema):
        return TokenBlockReader(self.options["path"])

    def writer(self, schema, overwrite: bool):
        return TokenBlockWriter(self.options["path"], self.options.get("tokenizer"), int(self.options.get("endId", 2)))


class TokenBlockWriter(DataSourceArrowWriter):
    """Rows have ids, or a text that is encoded as it is written."""

    def __init__(self, folder: str, tokenizer: str | None = None, end_id: int = 2):
        self.folder, self.tokenizer, self.end = folder, tokenizer, np.array([end_id], "<u4")

    def _documents(self, batch: pa.RecordBatch) -> Iterator[tuple[int | None, np.ndarray]]:
        if self.tokenizer is None:
            for doc_id, ids in zip(batch.column("doc_id").to_pylist(), batch.column("ids").to_pylist(), strict=True):
                yield doc_id, np.frombuffer(ids or b"", "<u4")
            return
        encoder, ids_of = encoder_of(self.tokenizer), batch.column("doc_id").to_pylist()
        at = 0
        for run in text_runs(batch.column("text")):
            flat, bounds = flat_ids(encoder.encode_array(run))
            for doc_id, a, b in zip(ids_of[at : at + len(run)], bounds[:-1].tolist(), bounds[1:].tolist(), strict=True):
                yield doc_id, np.concatenate([flat[a:b], self.end])
            at += len(run)

    def write(self, batches):
        path = files.fresh_file(self.folder, ".tok")
        fs, at = files.resolve(path)
        with fs.open_output_stream(at, compression=None) as out:
            writer = BlockFileWriter(out)
            for batch in batches:
                for doc_id, ids in self._documents(batch):
                    writer.add(doc_id, ids)
            writer.close()
        return files.Written(TaskContext.get().partitionId(), path, len(writer.ids), writer.total)

    def commit(self, messages):
        files.commit(self.folder, messages)

    def abort(self, messages):
        files.abort(messages)


class TokenBlockReader(DataSourceReader):
    def __init__(self, folder: str):
        self.folder = folder

    def partitions(self):
        return files.parts(self.folder) or [files.FilePart("", 0)]

    def read(self, part):
        if not part.file:
            return
        schema = pa.schema([("doc_id", pa.int64()), ("start", pa.int64()), ("n_tokens", pa.int64()), ("ids", pa.binary())])
        fs, at = files.resolve(part.file)
        with fs.open_input_file(at) as src:
            rows, held = [], 0
            for doc_id, start, ids in BlockFile(src, src.size()).documents():
                rows.append((doc_id, part.first_unit + start, len(ids), ids.astype("<u4").tobytes()))
                held += 4 * len(ids)
                if held >= BATCH_BYTES:
                    yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows, strict=True), schema.types, strict=True)], schema=schema)
                    rows, held = [], 0
            if rows:
                yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows, strict=True), schema.types, strict=True)], schema=schema)


# ---- encoding -----------------------------------------------------------------------------


#: what a text has that is not of printable ASCII, line feeds and the letters of Latin-1, and
#: white space beside a space or line feed (but for a space after a line feed) or at the end
STRANGE = r"[^\n -~À-ÖØ-öø-ÿ]| [ \n]|\n\n|[ \n]\z"
#: the pieces of other texts by the rules below
PLAIN_PIECES = r"'s|'t|'re|'ve|'m|'ll|'d| ?[A-Za-zÀ-ÖØ-öø-ÿ]+| ?[0-9]+| ?[^A-Za-z0-9À-ÖØ-öø-ÿ \n]+|\n"
#: the pre-tokenizer of a vocabulary file for which PLAIN_PIECES is a shortcut
PIECE_RULES = {"type": "ByteLevel", "add_prefix_space": False, "trim_offsets": True, "use_regex": True}


class ByteLevelEncoder:
    """Encodes with a byte-level vocabulary of the tokenizers library.

    Nothing is merged across the pieces of its pre-tokenizer. Where the file has the rules above,
    texts of plain characters are cut into pieces by Arrow and each distinct piece goes through
    the library once; other texts and those with a special token go through it as a whole.
    """

    def __init__(self, path: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        self.tokenizer = Tokenizer.from_file(path)
        self.tokenizer.no_truncation()
        self.tokenizer.no_padding()
        self.special = [t.content for t in self.tokenizer.get_added_tokens_decoder().values()]
        feed = self._whole("\n")
        self.divider = feed[0] if len(feed) == 1 else None
        self.plain_rules = spec["pre_tokenizer"] == PIECE_RULES and spec["normalizer"] is None and self.divider is not None
        self.pieces = PieceCache(400_000)

    def _whole(self, text: str) -> list[int]:
        return self.tokenizer.encode_batch_fast([text], add_special_tokens=False)[0].ids

    def _is_plain(self, texts: pa.Array) -> pa.Array:
        if not self.plain_rules:
            return pa.array(np.zeros(len(texts), bool))
        other = pc.match_substring_regex(texts, STRANGE)
        for token in self.special:
            other = pc.or_(other, pc.match_substring(texts, token))
        return pc.invert(other)

    def _by_library(self, pieces: list[str]) -> list[bytes]:
        """Distinct pieces, many at a time: a line feed between them is a piece of its own."""
        out: list[bytes] = []
        for i in range(0, len(pieces), 4096):
            # nothing, or a line feed, between two dividers would be one piece with them
            ids = np.array(self._whole("\n".join(["." if p in ("", "\n") else p for p in pieces[i : i + 4096]])), "<u4")
            cuts = np.flatnonzero(ids == self.divider)
            starts, ends = [0, *(cuts + 1).tolist()], [*cuts.tolist(), len(ids)]
            data = ids.tobytes()
            out += [data[4 * a : 4 * b] for a, b in zip(starts, ends, strict=True)]
        for piece, data in (("", b""), ("\n", struct.pack("<I", self.divider))):
            if piece in pieces:
                out[pieces.index(piece)] = data
        return out

    def _distinct(self, pieces: pa.Array) -> pa.Array:
        return pa.array(self.pieces.look_up(pieces.to_pylist(), self._by_library), pa.binary())

    def _plain(self, texts: pa.Array) -> pa.Array:
        # every piece is followed by a divider that no plain text has
        cut = pc.split_pattern(pc.replace_substring_regex(texts, PLAIN_PIECES, "\\0\x1f"), "\x1f")
        return encode_pieces(cut, self._distinct)

    def _other(self, texts: pa.Array) -> pa.Array:
        return pa.array([np.array(self._whole(t), "<u4").tobytes() for t in texts.to_pylist()], pa.binary())

    def encode_array(self, texts: pa.Array) -> pa.Array:
        """The ids of each text as little-endian unsigned 32-bit integers."""
        return by_kind(texts, self._is_plain(texts), self._plain, self._other)


_ENCODERS: dict[str, ByteLevelEncoder] = {}


def encoder_of(path: str) -> ByteLevelEncoder:
    return _ENCODERS.get(path) or _ENCODERS.setdefault(path, ByteLevelEncoder(path))


def write_tokens(docs: DataFrame, folder: str, tokenizer_path: str, *, end_id: int = 2, id_col: str = "doc_id", text_col: str = "text") -> None:
    """Writes the ids of all texts in ascending order of the documents' ids."""
    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text"))
    order = [F.col("doc_id").asc_nulls_last(), F.col("text")]
    rows = rows.repartitionByRange(*order[:1]).sortWithinPartitions(*order)
    docs.sparkSession.dataSource.register(TokenBlocks)
    rows.write.format("token_blocks").option("tokenizer", tokenizer_path).option("endId", end_id).mode("append").save(folder)


def read_tokens(spark, folder: str) -> DataFrame:
    """doc_id, start (tokens of all documents before it), n_tokens, ids (bytes)."""
    spark.dataSource.register(TokenBlocks)
    return spark.read.format("token_blocks").load(folder)

"""Token files: blocks of ids are turned into bit or byte planes, each compressed with zstandard, behind a chunk index.

A file is, in order:

* head: ``TLTOKEN1``, number of the writing partition, number of the file in it, ids in a block, planes of a block
  (32: bits, 4: bytes), each a little-endian uint32;
* the blocks, each as its planes from the lowest to the highest one. All blocks but the last hold the same number of ids,
  so the block of an id follows by division. A plane of zeros takes no bytes;
* the index (zstandard): number of ids, number of blocks, compressed bytes of every plane of every block (uint32), then the
  documents (Arrow stream: doc_id in its own type, start within the file, n_tokens);
* the index's length (uint64) and ``TLTOKEND``, without which a file counts as broken off.

A document lies in one file. A file ends with the document that brings it to ``file_ids`` ids.
"""

from __future__ import annotations

import os
import re
import struct
import zlib
from dataclasses import dataclass
from functools import lru_cache

import numpy as np
import pyarrow as pa
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_type

from tracelake.llm.common import as_bytes, batch_slices, scratch, ship, ship_file, shipped_file, stored

MAGIC, END = b"TLTOKEN1", b"TLTOKEND"
_HEAD, _TAIL = struct.Struct("<8s4I"), struct.Struct("<Q8s")
#: Ids in a block, ids after which a file ends (with the document that reaches it), zstandard level.
BLOCK_IDS, FILE_IDS, LEVEL = 1 << 16, 1 << 23, 3
PLANES = {"bit": 32, "byte": 4}
#: White-space-separated pieces that a worker remembers in each of two generations; longer ones are not remembered.
REMEMBERED, LONGEST_REMEMBERED = 400_000, 64


def to_planes(ids: np.ndarray, planes: int) -> list[bytes]:
    """The planes of a block of uint32 ids, lowest first; a plane of zeros is empty. 8 ids share a byte of a bit plane."""
    if planes == 4:
        parts = ids.astype("<u4").view(np.uint8).reshape(-1, 4).T
        return [p.tobytes() if p.any() else b"" for p in parts]
    top = int(ids.max()).bit_length() if len(ids) else 0
    parts = [np.packbits((ids >> np.uint32(p) & np.uint32(1)).astype(np.uint8)) for p in range(top)]
    return [p.tobytes() if p.any() else b"" for p in parts] + [b""] * (32 - top)


def from_planes(parts: list[bytes], n: int) -> np.ndarray:
    """The ``n`` ids of a block's planes."""
    ids = np.zeros(n, "<u4")
    for p, data in enumerate(parts):
        if data:
            if len(parts) == 4:
                ids |= np.frombuffer(data, np.uint8).astype(np.uint32) << np.uint32(8 * p)
            else:
                ids |= np.unpackbits(np.frombuffer(data, np.uint8), count=n).astype(np.uint32) << np.uint32(p)
    return ids


class FileWriter:
    """Builds one file in memory: ``add`` documents, then ``close`` to get its bytes."""

    def __init__(self, part: int, seq: int, planes: int, block_ids: int, id_type: pa.DataType):
        self.planes, self.block, self.id_type = planes, block_ids, id_type
        self.out = bytearray(_HEAD.pack(MAGIC, part, seq, block_ids, planes))
        self.open, self.lengths = bytearray(), []
        self.ids, self.docs, self.starts, self.counts = 0, [], [], []
        self.zstd = zstandard.ZstdCompressor(level=LEVEL)

    def add(self, doc: pa.Scalar, ids: bytes) -> None:
        """``ids``: little-endian uint32."""
        self.docs.append(doc)
        self.starts.append(self.ids)
        self.counts.append(len(ids) // 4)
        self.ids += len(ids) // 4
        self.open += ids
        whole = len(self.open) // (4 * self.block) * 4 * self.block
        if whole:
            for at in range(0, whole, 4 * self.block):
                self._block(np.frombuffer(self.open[at : at + 4 * self.block], "<u4"))
            del self.open[:whole]

    def _block(self, ids: np.ndarray) -> None:
        for p in to_planes(ids, self.planes):
            data = self.zstd.compress(p) if p else b""
            self.lengths.append(len(data))
            self.out += data

    def close(self) -> bytes:
        if self.open:
            self._block(np.frombuffer(bytes(self.open), "<u4"))
        sink = pa.BufferOutputStream()
        docs = pa.table({"doc_id": pa.array(self.docs, self.id_type), "start": pa.array(self.starts, pa.int64()), "n_tokens": pa.array(self.counts, pa.int64())})
        with pa.ipc.new_stream(sink, docs.schema) as w:
            w.write_table(docs)
        index = struct.pack("<QI", self.ids, len(self.lengths) // self.planes) + np.array(self.lengths, "<u4").tobytes() + sink.getvalue().to_pybytes()
        index = self.zstd.compress(index)
        self.out += index
        self.out += struct.pack("<Q", len(index))  # END follows: the writer's line separator
        return bytes(self.out)


@dataclass
class TokenFile:
    """A file's bytes with its index read; ``ids(a, b)`` inflates only the blocks that hold ids a to b."""

    data: bytes

    def __post_init__(self):
        magic, self.part, self.seq, self.block, self.planes = _HEAD.unpack_from(self.data)
        size, end = _TAIL.unpack(self.data[-_TAIL.size :])
        if magic != MAGIC or end != END:
            raise ValueError("no token file, or one that broke off")
        index = zstandard.decompress(self.data[-_TAIL.size - size : -_TAIL.size])
        self.n_ids, n_blocks = struct.unpack_from("<QI", index)
        at = 12 + 4 * n_blocks * self.planes
        lengths = np.frombuffer(index[12:at], "<u4").astype(np.int64)
        self.bounds = _HEAD.size + np.concatenate([[0], np.cumsum(lengths)])
        self.docs = pa.ipc.open_stream(index[at:]).read_all()

    def _ids_of(self, k: int) -> np.ndarray:
        b = self.bounds[k * self.planes : (k + 1) * self.planes + 1].tolist()
        parts = [zstandard.decompress(self.data[x:y]) if y > x else b"" for x, y in zip(b, b[1:], strict=False)]
        return from_planes(parts, min(self.block, self.n_ids - k * self.block))

    def ids(self, a: int, b: int) -> np.ndarray:
        if a >= b:
            return np.zeros(0, "<u4")
        first = a // self.block
        got = np.concatenate([self._ids_of(k) for k in range(first, (b - 1) // self.block + 1)])
        return got[a - first * self.block : b - first * self.block]

    def documents(self):
        """(place in ``docs``, ids) of each document in turn; a block is inflated once."""
        held, at, k = np.zeros(0, "<u4"), 0, 0  # ids from id ``at`` on that are inflated, next block
        for i, (a, n) in enumerate(zip(self.docs["start"].to_pylist(), self.docs["n_tokens"].to_pylist(), strict=True)):
            parts, have = [held[a - at :]], at + len(held)
            while have < a + n:
                parts.append(self._ids_of(k))
                have += len(parts[-1])
                k += 1
            held, at = np.concatenate(parts) if len(parts) > 1 else parts[0], a
            yield i, held[:n]


@lru_cache(2)
def _tokenizer(name: str):
    os.environ["TOKENIZERS_PARALLELISM"] = "false"  # a task has one core
    from tokenizers import Tokenizer

    return Tokenizer.from_file(shipped_file(name))


#: Letters and marks of plain words: a-z and U+00C0 to U+00FF without the signs in them, then ASCII marks (no apostrophe,
#: and none of the signs that added tokens are usually written with).
_LETTERS = "abcdefghijklmnopqrstuvwxyz" + "".join(map(chr, [*range(0xC0, 0xD7), *range(0xD8, 0xF7), *range(0xF8, 0x100)]))
_MARKS = '.,;:!?$#*"()-+=/&%@~^_'
_PLAIN = re.compile(rb"((?:[a-z]|\xc3[\x80-\x96\x98-\xb6\xb8-\xbf])+)([" + re.escape(_MARKS).encode() + rb"]*)")


def _plain_letters(tokenizer) -> dict[int, str] | None:
    """How the library hands each letter to its model, if it takes letters as one pre-token and marks behind them as another.

    Then words can go to the library's model directly. Asked of every letter, every mark behind every letter and every
    pair of marks; no added token may consist of such signs alone, as it could stand in the middle of a word.
    """
    if tokenizer.normalizer is None or tokenizer.pre_tokenizer is None:
        return None

    def pieces(text: str) -> list[str]:
        return [p for p, _ in tokenizer.pre_tokenizer.pre_tokenize_str(tokenizer.normalizer.normalize_str(text))]

    each = {c: "".join(pieces(c)) for c in _LETTERS + _LETTERS[:26].upper()}
    if any(pieces(c.upper()) != [each[c]] for c in _LETTERS[:26]) or pieces(_LETTERS) != ["".join(each[c] for c in _LETTERS)]:
        return None
    marks = {m: "".join(pieces(m)) for m in _MARKS}
    if any(pieces(c + m) != [each[c], marks[m]] for c in _LETTERS for m in _MARKS):
        return None
    if any(pieces("a" + m + n) != [each["a"], marks[m] + marks[n]] for m in _MARKS for n in _MARKS):
        return None
    added = [t.content.encode().lower() for t in tokenizer.get_added_tokens_decoder().values()]
    sign = re.compile(rb"(?:[a-z]|\xc3[\x80-\xbf]|[" + re.escape(_MARKS).encode() + rb"])*")
    return None if any(sign.fullmatch(t) for t in added) else {ord(c): p for c, p in each.items()}


class _Pieces(dict):
    """Ids of pieces; a missing one comes from the generation before or from ``make``. Long ones are not kept."""

    def __init__(self, make, old: dict):
        super().__init__()
        self.make, self.old = make, old

    def __missing__(self, piece: bytes) -> bytes:
        ids = self.old.get(piece)
        if ids is None:
            ids = self.make(piece)
        if len(piece) <= LONGEST_REMEMBERED:
            self[piece] = ids
        return ids


class Encoder:
    """Texts to little-endian uint32 ids by the tokenizers library, ``add_special_tokens=False``.

    ``words``: for tokenizers that drop white space, so that no token reaches over it: the library encodes each distinct
    piece between ASCII white space once, as long as the worker remembers it (two generations). Else it gets whole texts.
    """

    def __init__(self, tokenizer, words: bool):
        self.tokenizer, self.words = tokenizer, words
        self.letters = _plain_letters(tokenizer) if words else None
        self.known = _Pieces(self._piece, {})

    def _ids(self, texts: list[bytes]) -> list[bytes]:
        found = self.tokenizer.encode_batch_fast([t.decode("utf-8", "replace") for t in texts], add_special_tokens=False)
        return [struct.pack(f"<{len(e)}I", *e.ids) for e in found]

    def _piece(self, piece: bytes) -> bytes:
        if self.letters and (m := _PLAIN.fullmatch(piece.lower())):
            word, marks = m.groups()
            if word != piece:
                return self.known[word] + (self.known[marks] if marks else b"")
            ids = [t.id for t in self.tokenizer.model.tokenize(word.decode().translate(self.letters))]
            return struct.pack(f"<{len(ids)}I", *ids)
        return self._ids([piece])[0]

    def encode(self, texts: list[bytes]) -> list[bytes]:
        if not self.words:
            return self._ids(texts)
        if len(self.known) > REMEMBERED:
            self.known.old = {}
            self.known = _Pieces(self._piece, self.known)
        of = self.known.__getitem__
        return [b"".join(map(of, t.split())) for t in texts]


@lru_cache(2)
def _encoder(name: str, words: bool) -> Encoder:
    return Encoder(_tokenizer(name), words)


def _files_of(name: str, words: bool, end: bytes, planes: int, block_ids: int, file_ids: int, id_type: pa.DataType):
    def run(batches):
        part, seq, w = TaskContext.get().partitionId(), 0, None
        encoder = _encoder(name, words)
        for whole in batches:
            for batch in batch_slices(whole, "text", 1 << 20):
                for doc, ids in zip(batch.column(0).to_pylist(), encoder.encode(batch.column(1).to_pylist()), strict=True):
                    w = w or FileWriter(part, seq, planes, block_ids, id_type)
                    w.add(doc, ids + end)
                    if w.ids >= file_ids:
                        yield pa.RecordBatch.from_arrays([pa.array([w.close()], pa.binary())], names=["value"])
                        w, seq = None, seq + 1
        if w:
            yield pa.RecordBatch.from_arrays([pa.array([w.close()], pa.binary())], names=["value"])

    return run


def write_token_files(
    docs: DataFrame, tokenizer_file: str, path: str, end_id: int | None = 1, words: bool = False, planes: str = "byte",
    block_ids: int = BLOCK_IDS, file_ids: int = FILE_IDS, id_col: str = "doc_id", text_col: str = "text",
) -> None:
    """Write the ids of every text (null: empty), each with ``end_id`` behind it, in ascending ``id_col`` order.

    Null ids come first; rows of one id follow each other by their text's hash, equal rows in any order. Texts are dealt by
    ranges of (id, hash, place in the scan), so an id that many rows share spans partitions, and are encoded once, behind
    that shuffle. Other columns are not read. Bytes that are no UTF-8 are encoded as U+FFFD. A task holds one file at a
    time; its memory follows ``file_ids`` and the longest text. ``words`` as in ``Encoder``. The place of an id among all is
    known once all files are there: ``read_documents`` sums the counts of the files before it.
    """
    spark = docs.sparkSession
    ship(spark)
    name = ship_file(spark, tokenizer_file)
    id_type = docs.schema[id_col].dataType
    src = docs.select(F.col(id_col).alias("doc_id"), as_bytes(text_col).alias("text"), F.xxhash64(as_bytes(text_col)).alias("tie"), F.monotonically_increasing_id().alias("place"))
    order = ["doc_id", "tie", "place"]
    dealt = src.repartitionByRange(*order).sortWithinPartitions(*order).select("doc_id", "text")
    end = b"" if end_id is None else struct.pack("<I", end_id)
    rows = dealt.mapInArrow(_files_of(name, words, end, PLANES[planes], block_ids, file_ids, to_arrow_type(id_type)), "value binary")
    # Spark's text writer puts the bytes down as they are: one record, hence one file, a row
    w = rows.select(F.col("value").cast("string")).write.option("lineSep", END.decode()).option("maxRecordsPerFile", 1)
    w.option("compression", "none").text(path)


def _read(with_ids: bool, id_type: pa.DataType):
    def run(batches):
        for batch in batches:
            for data in batch.column(0).to_pylist():
                f = TokenFile(data)
                n, ids, crc = f.docs.num_rows, [], []
                for _, x in f.documents():
                    raw = x.tobytes()
                    crc.append(zlib.crc32(raw))
                    if with_ids:
                        ids.append(raw)
                cols = [pa.array([f.part] * n, pa.int64()), pa.array([f.seq] * n, pa.int64()), f.docs["doc_id"].combine_chunks().cast(id_type), f.docs["start"].combine_chunks(), f.docs["n_tokens"].combine_chunks(), pa.array(crc, pa.int64())]
                names = ["part", "seq", "doc_id", "start", "n_tokens", "ids_crc32"]
                if with_ids:
                    cols, names = [*cols, pa.array(ids, pa.binary())], [*names, "ids"]
                whole = pa.RecordBatch.from_arrays([c.combine_chunks() if isinstance(c, pa.ChunkedArray) else c for c in cols], names=names)
                for at in range(0, n, 10_000):
                    yield whole.slice(at, 10_000)

    return run


def read_documents(spark: SparkSession, path: str, id_type: T.DataType | None = None, with_ids: bool = False) -> DataFrame:
    """Documents of token files: (doc_id, start, n_tokens, ids_crc32[, ids]).

    ``start`` counts the ids of all documents before it in the order of the files; ``ids_crc32`` is the unsigned CRC-32 of
    the ids as little-endian uint32, ``ids`` these bytes. A task holds one file. The sums over files work on one row per
    file and, for the files of the partitions before, one row per writing partition.
    """
    ship(spark)
    id_type = id_type or T.LongType()
    files = spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(path).where(F.col("length") > 0).select("content")
    cols = [T.StructField(c, T.LongType()) for c in ("part", "seq")] + [T.StructField("doc_id", id_type)]
    cols += [T.StructField(c, T.LongType()) for c in ("start", "n_tokens", "ids_crc32")] + ([T.StructField("ids", T.BinaryType())] if with_ids else [])
    rows = stored(files.mapInArrow(_read(with_ids, to_arrow_type(id_type)), T.StructType(cols)), "token-rows")
    sizes = rows.groupBy("part", "seq").agg(F.sum("n_tokens").alias("n"))
    before = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    parts = sizes.groupBy("part").agg(F.sum("n").alias("n")).select("part", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("base"))
    inside = Window.partitionBy("part").orderBy("seq").rowsBetween(Window.unboundedPreceding, -1)
    bases = sizes.select("part", "seq", F.coalesce(F.sum("n").over(inside), F.lit(0)).alias("above")).join(parts, "part")
    bases = bases.select("part", "seq", (F.col("base") + F.col("above")).alias("base"))
    out = rows.join(bases, ["part", "seq"]).withColumn("start", F.col("base") + F.col("start"))
    return out.select("doc_id", "start", "n_tokens", "ids_crc32", *(["ids"] if with_ids else []))


def file_round_trip(docs: DataFrame, tokenizer_file: str, words: bool = False, end_id: int | None = 1, id_col: str = "doc_id", text_col: str = "text", **layout) -> DataFrame:
    """Write ``docs`` as token files in the shared folder and read them back: (doc_id, start, n_tokens, ids_crc32) per row."""
    path = scratch(docs.sparkSession, "token-files")
    write_token_files(docs, tokenizer_file, path, end_id, words, id_col=id_col, text_col=text_col, **layout)
    return read_documents(docs.sparkSession, path, docs.schema[id_col].dataType)

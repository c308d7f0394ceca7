"""Operator 3: token ids in binary files of independent zstandard frames with a trailing seek table.

File format (``.tokz``): zstandard frames, each with a content checksum and each independent of the others, that
hold the ids of whole documents, one after the other, little-endian, ``id_bytes`` each. Then one skippable frame (magic 0x184D2A5E, little-endian
length) that plain zstandard readers pass over. It holds, per frame, compressed size, raw size and crc32 of the raw bytes
(unsigned 32 bits each); per document, its id (signed 64), its frame (unsigned 32), its first byte within the
frame and its number of ids (unsigned 32); then the numbers of frames and documents (unsigned 32), ``id_bytes`` (one byte) and the
magic number 0x8F92EAB1. A reader fetches the tail, then only the frames of the documents it wants.

Texts are encoded by the ``tokenizers`` library. The vocabulary drops white space and lower-cases, and its splitting pattern never crosses white
space; so each stretch between white space is encoded once per worker and kept (at most ``CACHED`` of late and as many before; many new ones in one call), and a text's
ids are those of its stretches in order. A text that holds ``<|`` could name a special token and is encoded in one piece.

The table is cut into ranges of (``doc_id``, hash of the text); each range is one task, which starts a new file whenever one holds ``file_bytes`` of ids or ``file_docs``
documents, so that neither a writer nor a reader holds a longer seek table, however large a range is. Files are named after the range and their number in it and renamed into
place when they are complete, so that a repeated task leaves whole files. The files' order is that of these two numbers, also where one id fills several of them.
Defined results: a null text is empty (one id, the end); null ids come first; rows that repeat an id keep their rows, in an order that the text gives;
an empty table gives no file; columns other than ``doc_id`` and ``text`` are not read.
"""

from __future__ import annotations

import os
import struct
import uuid
import zlib
from array import array
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import zstandard
from pyarrow import fs
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from genoframe.llm.common import reduce_tasks, settle, shared_folder

FRAME_BYTES = 1 << 18
FILE_BYTES = 1 << 30
FILE_DOCS = 4_000_000
CACHED = 800_000
_SKIPPABLE, _END = 0x184D2A5E, 0x8F92EAB1
_FRAME = np.dtype([("packed", "<u4"), ("raw", "<u4"), ("crc", "<u4")])
_DOC = np.dtype([("doc_id", "<i8"), ("frame", "<u4"), ("first", "<u4"), ("count", "<u4")])
_NULL_ID = -(1 << 63)


class Encoder:
    """Ids of texts as little-endian bytes."""

    def __init__(self, path: str, id_bytes: int, end_id: int | None):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.tokenizer, self.type = Tokenizer.from_file(path), f"<u{id_bytes}"
        self.end = b"" if end_id is None else np.array([end_id], self.type).tobytes()
        mark = self.tokenizer.encode("\1", add_special_tokens=False).ids
        self.mark = mark[0] if len(mark) == 1 else None
        self.known: dict[bytes, bytes] = {}
        self.older: dict[bytes, bytes] = {}

    def _ids(self, texts: list[str]) -> list[bytes]:
        return [np.array(e.ids, self.type).tobytes() for e in self.tokenizer.encode_batch_fast(texts, add_special_tokens=False)]

    def _ids_of_words(self, words: list[bytes]) -> list[bytes]:
        """Ids of words without white space, many in one call: a control character stands between them, whose id parts them again."""
        if self.mark is None or any(b"\1" in w for w in words):
            return self._ids([w.decode() for w in words])
        ids = np.array(self.tokenizer.encode_batch_fast([b" \1 ".join(words).decode()], add_special_tokens=False)[0].ids, self.type)
        cuts, raw, size = np.flatnonzero(ids == self.mark), ids.tobytes(), ids.itemsize
        return [raw[a:b] for a, b in zip([0, *((cuts + 1) * size).tolist()], [*(cuts * size).tolist(), len(raw)], strict=True)]

    def encode(self, texts: list[bytes]) -> list[bytes]:
        split = [None if b"<|" in t else t.lower().split() for t in texts]
        if len(self.known) > CACHED:
            self.older, self.known = self.known, {}
        known, older = self.known, self.older
        fresh = []
        for w in {w for words in split if words for w in words if w not in known}:
            ids = older.get(w)
            if ids is None:
                fresh.append(w)
            else:
                known[w] = ids
        for lo in range(0, len(fresh), 10_000):
            some = fresh[lo : lo + 10_000]
            known.update(zip(some, self._ids_of_words(some), strict=True))
        get = known.__getitem__
        return [(self._ids([t.decode()])[0] if words is None else b"".join(map(get, words))) + self.end for t, words in zip(texts, split, strict=True)]


_ENCODERS: dict[tuple, Encoder] = {}


def encoder(path: str, id_bytes: int, end_id: int | None) -> Encoder:
    """One for each worker process, so that what it has learnt of the vocabulary stays."""
    key = (path, id_bytes, end_id)
    if key not in _ENCODERS:
        _ENCODERS[key] = Encoder(path, id_bytes, end_id)
    return _ENCODERS[key]


class Writer:
    """Writes one file; documents in the order given."""

    def __init__(self, out, id_bytes: int):
        self.out, self.id_bytes = out, id_bytes
        self.frames = array("I")  # packed, raw, crc of each
        self.ids, self.places = array("q"), array("I")  # of each document its id; its frame, first byte, number of ids
        self.held: list[bytes] = []
        self.size = self.total = 0
        self.packer = zstandard.ZstdCompressor(level=3, write_checksum=True)

    def add(self, doc_id: int | None, ids: bytes) -> None:
        self.ids.append(_NULL_ID if doc_id is None else doc_id)
        self.places.extend((len(self.frames) // 3, self.size, len(ids) // self.id_bytes))
        self.held.append(ids)
        self.size += len(ids)
        self.total += len(ids)
        if self.size >= FRAME_BYTES:
            self._frame()

    def _frame(self) -> None:
        raw = b"".join(self.held)
        packed = self.packer.compress(raw)
        self.out.write(packed)
        self.frames.extend((len(packed), len(raw), zlib.crc32(raw)))
        self.held, self.size = [], 0

    def close(self) -> None:
        if self.held:
            self._frame()
        docs, places = np.empty(len(self.ids), _DOC), np.array(self.places, "<u4").reshape(-1, 3)
        docs["doc_id"] = self.ids
        for k, name in enumerate(("frame", "first", "count")):
            docs[name] = places[:, k]
        table = np.array(self.frames, "<u4").tobytes() + docs.tobytes() + struct.pack("<IIBI", len(self.frames) // 3, len(docs), self.id_bytes, _END)
        self.out.write(struct.pack("<II", _SKIPPABLE, len(table)) + table)


class Reader:
    """Reads documents of one file; ``source`` can seek."""

    def __init__(self, source):
        self.source = source
        size = source.seek(0, 2)
        source.seek(size - 13)
        frames, docs, self.id_bytes, end = struct.unpack("<IIBI", source.read(13))
        if end != _END:
            raise ValueError("no seek table at the end of the file")
        length = frames * _FRAME.itemsize + docs * _DOC.itemsize
        source.seek(size - 13 - length)
        table = source.read(length)
        self.frames = np.frombuffer(table, _FRAME, frames)
        self.docs = np.frombuffer(table, _DOC, docs, frames * _FRAME.itemsize)
        self.starts = np.concatenate(([0], np.cumsum(self.frames["packed"], dtype=np.int64)))
        self.unpacker = zstandard.ZstdDecompressor()
        self.at, self.raw = -1, b""

    def read(self, place: int) -> bytes:
        """The id bytes of the document at this place of the file; only its frame is decompressed."""
        doc = self.docs[place]
        frame = int(doc["frame"])
        if frame != self.at:
            self.source.seek(int(self.starts[frame]))
            self.raw = self.unpacker.decompress(self.source.read(int(self.frames[frame]["packed"])), max_output_size=int(self.frames[frame]["raw"]))
            if zlib.crc32(self.raw) != int(self.frames[frame]["crc"]):
                raise ValueError(f"frame {frame} does not match its checksum")
            self.at = frame
        first = int(doc["first"])
        return self.raw[first : first + int(doc["count"]) * self.id_bytes]

    def find(self, doc_id: int) -> list[int]:
        """Places of a document id."""
        return np.flatnonzero(self.docs["doc_id"] == doc_id).tolist()


def _opened(uri: str):
    return fs.FileSystem.from_uri(uri) if "://" in uri else (fs.LocalFileSystem(), uri)


_FILES = pa.schema([("file", pa.string()), ("part", pa.int32()), ("number", pa.int32()), ("least", pa.int64()), ("docs", pa.int64()), ("ids", pa.int64())])


class _Output:
    """A file that is being written by the task of a range."""

    def __init__(self, folder: str, part: int, number: int, id_bytes: int, least: int | None):
        self.store, root = _opened(folder)
        self.store.create_dir(root, recursive=True)
        self.name = f"{part:06d}-{number:06d}-{uuid.uuid4().hex}"
        self.folder, self.path, self.key = folder, f"{root}/{self.name}", (part, number, _NULL_ID if least is None else least)
        self.out = self.store.open_output_stream(f"{self.path}.part", compression=None)
        self.writer = Writer(self.out, id_bytes)

    def close(self) -> tuple:
        """Its row of the list of files."""
        self.writer.close()
        self.out.close()
        self.store.move(f"{self.path}.part", f"{self.path}.tokz")
        return f"{self.folder}/{self.name}.tokz", *self.key, len(self.writer.ids), self.writer.total // self.writer.id_bytes


def write_files(docs: DataFrame, folder: str, tokenizer_path: str, end_id: int | None = 1, id_bytes: int = 2, file_bytes: int = FILE_BYTES, file_docs: int = FILE_DOCS) -> DataFrame:
    """Writes ``docs`` (doc_id, text) in id order; gives (file, part, number, least, docs, ids) for each file: ``part`` and ``number`` its place in that order, ``least`` its first id."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        current, done = None, []
        # the number of the task is that of its range
        place = TaskContext.get().partitionId()
        for batch in batches:
            for lo in range(0, batch.num_rows, 500):
                part = batch.slice(lo, 500)
                texts = [(v.as_buffer().to_pybytes() if v.is_valid else b"") for v in part.column(1)]
                for doc_id, ids in zip(part.column(0).to_pylist(), encoder(tokenizer_path, id_bytes, end_id).encode(texts), strict=True):
                    if current is not None and (current.writer.total >= file_bytes or len(current.writer.ids) >= file_docs):
                        done.append(current.close())
                        current = None
                    if current is None:
                        current = _Output(folder, place, len(done), id_bytes, doc_id)
                    current.writer.add(doc_id, ids)
        if current is not None:
            done.append(current.close())
        columns = list(zip(*done, strict=True)) or [[]] * len(_FILES)
        yield pa.RecordBatch.from_arrays([pa.array(c, t.type) for c, t in zip(columns, _FILES, strict=True)], schema=_FILES)

    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    parts = max(1, reduce_tasks(docs.sparkSession))
    ranged = rows.repartitionByRange(parts, F.col("doc_id").asc_nulls_first(), F.xxhash64("text")).sortWithinPartitions(F.col("doc_id").asc_nulls_first(), F.xxhash64("text"))
    # the list of the files is what counts: files that a lost task left behind are in no list
    return settle(ranged.mapInArrow(run, "file string, part int, number int, least long, docs long, ids long"), "token-file-list")


_DOCS = pa.schema([("file", pa.string()), ("place", pa.int64()), ("doc_id", pa.int64()), ("before", pa.int64()), ("ids", pa.binary())])


def read_files(files: DataFrame, digest: bool = False) -> DataFrame:
    """(file, place, doc_id, before, ids) for each document; ``before`` counts the ids before it in its file.

    With ``digest`` the bytes are replaced by their number and the crc32 of the ids as unsigned 32-bit integers.
    """
    schema = pa.schema([*list(_DOCS)[:4], ("n_tokens", pa.int64()), ("ids_crc32", pa.int64())]) if digest else _DOCS

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for file in batch.column(0).to_pylist():
                store, path = _opened(file)
                with store.open_input_file(path) as source:
                    reader = Reader(source)
                    counts = reader.docs["count"].astype(np.int64)
                    before = np.cumsum(counts) - counts
                    for lo in range(0, len(counts), 1000):
                        here = range(lo, min(lo + 1000, len(counts)))
                        ids = [reader.read(k) for k in here]
                        values = [[len(x) // reader.id_bytes for x in ids], [zlib.crc32(np.frombuffer(x, f"<u{reader.id_bytes}").astype("<u4")) for x in ids]] if digest else [ids]
                        names = [None if i == _NULL_ID else i for i in reader.docs["doc_id"][lo : lo + 1000].tolist()]
                        columns = [[file] * len(ids), list(here), names, before[lo : lo + 1000], *values]
                        yield pa.RecordBatch.from_arrays([pa.array(c, t.type) for c, t in zip(columns, schema, strict=True)], schema=schema)

    ddl = "file string, place long, doc_id long, before long, " + ("n_tokens long, ids_crc32 long" if digest else "ids binary")
    spread = files.select("file").repartition(max(1, reduce_tasks(files.sparkSession)), "file")
    return spread.mapInArrow(run, ddl)


def placed(files: DataFrame) -> DataFrame:
    """(doc_id, start, n_tokens, ids_crc32) of each document of the files that ``write_files`` gave; ``start`` counts the ids of all documents before it."""
    # one row per file: ids of the files before it
    order = Window.orderBy("part", "number").rowsBetween(Window.unboundedPreceding, -1)
    starts = files.select("file", F.coalesce(F.sum("ids").over(order), F.lit(0)).alias("base"))
    rows = read_files(files, digest=True).join(F.broadcast(starts), "file")
    return rows.select("doc_id", (F.col("base") + F.col("before")).alias("start"), "n_tokens", "ids_crc32")


def op3(spark: SparkSession, sf_dir: str, tokenizer_path: str | None = None) -> DataFrame:
    import public_tokenizers

    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text")
    files = write_files(docs, shared_folder(spark, "token-files"), tokenizer_path or public_tokenizers.path("word_bpe_49k.json"))
    return placed(files)

"""Operator 6: telephony audio as media columns.

mu-law and A-law bytes expand to 16-bit samples by lookup tables; IMA ADPCM blocks are decoded with numpy across blocks (one step per
sample of a block, all blocks of a file at once); 16-bit PCM is resampled by linear interpolation and stored as WAVE bytes.

``store_payload`` keeps a payload losslessly as the 8-bit samples of a mu-law WAVE file (format tag 7), one sample a byte, and
``read_payload`` takes it back from the file's data chunk. Payloads are padded with bytes 0 to a positive
multiple of 64, the size of one ADPCM block here, so that the same bytes can be heard as mu-law, A-law or ADPCM.

Defined results: a null text is empty and gives one block of 64 zero bytes; repeated rows and equal texts give equal values; a file without a data chunk,
or of a format tag that is not known, raises an error that names it.
"""

from __future__ import annotations

import hashlib
import struct
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from genoframe.llm.common import must_be_free, place_of, settle

BLOCK = 64
RATE = 8000
WIDE_RATE = 16000
PCM, A_LAW, MU_LAW, IMA_ADPCM = 1, 6, 7, 0x11


def _mu_law_table() -> np.ndarray:
    code = ~np.arange(256, dtype=np.int64) & 0xFF
    size = ((((code & 15) << 3) + 132) << ((code >> 4) & 7)) - 132
    return np.where(code & 128, -size, size).astype(np.int16)


def _a_law_table() -> np.ndarray:
    code = np.arange(256, dtype=np.int64) ^ 0x55
    power, part = (code >> 4) & 7, code & 15
    size = np.where(power == 0, (part << 4) + 8, ((part << 4) + 264) << np.maximum(power - 1, 0))
    return np.where(code & 128, size, -size).astype(np.int16)


MU_TABLE, A_TABLE = _mu_law_table(), _a_law_table()

# Fixed values of the IMA ADPCM format: step sizes and index changes.
STEPS = np.array(
    [
        7, 8, 9, 10, 11, 12, 13, 14, 16, 17, 19, 21, 23, 25, 28, 31, 34, 37, 41, 45, 50, 55, 60, 66, 73, 80, 88, 97, 107, 118,
        130, 143, 157, 173, 190, 209, 230, 253, 279, 307, 337, 371, 408, 449, 494, 544, 598, 658, 724, 796, 876, 963, 1060, 1166,
        1282, 1411, 1552, 1707, 1878, 2066, 2272, 2499, 2749, 3024, 3327, 3660, 4026, 4428, 4871, 5358, 5894, 6484, 7132, 7845,
        8630, 9493, 10442, 11487, 12635, 13899, 15289, 16818, 18500, 20350, 22385, 24623, 27086, 29794, 32767,
    ],
    np.int32,
)
INDEX_CHANGES = np.array([-1, -1, -1, -1, 2, 4, 6, 8], np.int32)


def _adpcm_differences() -> np.ndarray:
    """Change of the prediction by step index and code: sign, then step times (2 * size + 1) / 8 in the format's shifts."""
    step = STEPS[:, None].astype(np.int64)
    code = np.arange(16)[None, :]
    size = (step >> 3) + np.where(code & 4, step, 0) + np.where(code & 2, step >> 1, 0) + np.where(code & 1, step >> 2, 0)
    return np.where(code & 8, -size, size).astype(np.int32)


DIFFERENCES = _adpcm_differences()
_NEXT_INDEX = np.clip(np.arange(89)[:, None] + INDEX_CHANGES[np.arange(16) & 7][None, :], 0, 88).astype(np.int32)


def expand(codes: np.ndarray, law: int = MU_LAW) -> np.ndarray:
    """16-bit samples of mu-law or A-law bytes."""
    return (MU_TABLE if law == MU_LAW else A_TABLE)[codes]


def compress_mu_law(samples: np.ndarray) -> np.ndarray:
    """The mu-law byte whose value is nearest to each sample (ties: the smaller value)."""
    values, first = np.unique(MU_TABLE, return_index=True)
    middle = (values[1:].astype(np.int32) + values[:-1]) / 2
    return first[np.searchsorted(middle, samples)].astype(np.uint8)


def decode_adpcm(data: np.ndarray, block: int = BLOCK) -> np.ndarray:
    """Samples of mono IMA ADPCM blocks (4 bytes of header, then two codes a byte, low first), block after block."""
    blocks = data.reshape(-1, block)
    header = np.ascontiguousarray(blocks[:, :4])
    value = header[:, :2].copy().view("<i2").ravel().astype(np.int32)
    index = np.minimum(header[:, 2], 88).astype(np.int32)
    codes = np.empty((2 * (block - 4), len(blocks)), np.uint8)
    codes[0::2] = (blocks[:, 4:] & 15).T
    codes[1::2] = (blocks[:, 4:] >> 4).T
    out = np.empty((len(codes) + 1, len(blocks)), np.int16)
    out[0] = value
    index *= 16
    changes, nexts = DIFFERENCES.ravel(), _NEXT_INDEX.ravel() * 16
    for k, code in enumerate(codes, 1):
        at = index + code
        value += changes.take(at)
        np.minimum(value, 32767, out=value)
        np.maximum(value, -32768, out=value)
        index = nexts.take(at)
        out[k] = value
    return out.T.reshape(-1)


def resample(samples: np.ndarray, rate: int, wanted: int) -> np.ndarray:
    """Linear interpolation in whole numbers, 16 bits; the last sample is held."""
    if rate == wanted or not len(samples):
        return samples
    count = -(-len(samples) * wanted // rate)
    if wanted == 2 * rate:
        wide = np.empty(count, np.int16)
        wide[0::2] = samples
        following = np.append(samples[1:], samples[-1:]).astype(np.int32)
        wide[1::2] = (samples.astype(np.int32) + following) >> 1
        return wide
    place = np.arange(count, dtype=np.int64) * rate
    at, rest = place // wanted, place % wanted
    following = samples[np.minimum(at + 1, len(samples) - 1)].astype(np.int64)
    return (samples[at] + (following - samples[at]) * rest // wanted).astype(np.int16)


def wave(data: bytes, tag: int, rate: int, bits: int, align: int) -> bytes:
    """RIFF/WAVE bytes, mono."""
    body = struct.pack("<4sIHHIIHH", b"fmt ", 16, tag, 1, rate, rate * align if tag != IMA_ADPCM else rate * align // (2 * (align - 4) + 1), align, bits)
    body += struct.pack("<4sI", b"data", len(data)) + data + b"\0" * (len(data) % 2)
    return struct.pack("<4sI4s", b"RIFF", len(body) + 4, b"WAVE") + body


def read_wave(media: bytes) -> tuple[int, int, int, bytes]:
    """(format tag, rate, block size, data) of RIFF/WAVE bytes."""
    if media[:4] != b"RIFF" or media[8:12] != b"WAVE":
        raise ValueError("not a RIFF/WAVE file")
    at, tag, rate, align = 12, None, 0, 1
    while at + 8 <= len(media):
        name, size = struct.unpack_from("<4sI", media, at)
        if name == b"fmt ":
            tag, _, rate, _, align = struct.unpack_from("<HHIIH", media, at + 8)
        elif name == b"data":
            if tag is None:
                raise ValueError("data before the format")
            return tag, rate, align, media[at + 8 : at + 8 + size]
        at += 8 + size + size % 2
    raise ValueError("no data chunk")


def samples_of(media: bytes) -> tuple[int, np.ndarray]:
    """(rate, 16-bit samples) of a telephony WAVE file."""
    tag, rate, align, data = read_wave(media)
    codes = np.frombuffer(data, np.uint8)
    if tag in (MU_LAW, A_LAW):
        return rate, expand(codes, tag)
    if tag == IMA_ADPCM:
        return rate, decode_adpcm(codes, align)
    if tag == PCM:
        return rate, np.frombuffer(data, "<i2")
    raise ValueError(f"format tag {tag} is not known")


def to_pcm(media: bytes, rate: int = WIDE_RATE) -> bytes:
    """The file as 16-bit PCM at another rate."""
    own, samples = samples_of(media)
    return wave(resample(samples, own, rate).astype("<i2").tobytes(), PCM, rate, 16, 2)


def store_payload(data: bytes) -> bytes:
    padded = data + b"\0" * (-len(data) % BLOCK or (BLOCK if not data else 0))
    return wave(padded, MU_LAW, RATE, 8, 1)


def read_payload(media: bytes) -> bytes:
    return read_wave(media)[3]


def features(stored: list[bytes]) -> list[str]:
    """For each file: peak, mean size and sign changes of the mu-law samples; crc32 of the resampled PCM and of the bytes heard as A-law and as ADPCM.

    The ADPCM blocks of all files are decoded at once.
    """
    parts = [read_wave(media) for media in stored]
    codes = [np.frombuffer(data, np.uint8) for _, _, _, data in parts]
    blocks = np.cumsum([len(c) // BLOCK for c in codes]) * (2 * (BLOCK - 4) + 1)
    heard = np.split(decode_adpcm(np.concatenate(codes)), blocks[:-1]) if codes else []
    crc = lambda x: zlib.crc32(np.ascontiguousarray(x, "<i2"))
    out = []
    for (_, rate, _, _), own, adpcm in zip(parts, codes, heard, strict=True):
        samples = expand(own)
        size = np.abs(samples.astype(np.int32))
        changes = int(np.count_nonzero((samples[1:] < 0) != (samples[:-1] < 0)))
        wide = resample(samples, rate, WIDE_RATE)
        out.append(f"peak={int(size.max())};mean={int(size.sum()) // len(size)};changes={changes};pcm16k={crc(wide):08x};alaw={crc(expand(own, A_LAW)):08x};adpcm={crc(adpcm):08x}")
    return out


def with_media(df: DataFrame, text: str = "text", out: str = "media") -> DataFrame:
    """``df`` with the stored form of its texts as a binary column."""
    return _mapped(df, text, out, "binary", pa.binary(), store_payload)


def with_pcm(df: DataFrame, media: str = "media", out: str = "pcm", rate: int = WIDE_RATE) -> DataFrame:
    """``df`` with its telephony files as resampled 16-bit PCM files; null stays null."""
    return _mapped(df, media, out, "binary", pa.binary(), lambda x: to_pcm(x, rate), keep_null=True)


def _mapped(df: DataFrame, source: str, out: str, ddl: str, kind: pa.DataType, fn, keep_null: bool = False) -> DataFrame:
    must_be_free(df, out)
    place = place_of(df, source)
    from pyspark.sql import types as T

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for lo in range(0, batch.num_rows, 500):
                part = batch.slice(lo, 500)
                values = [fn(v.as_buffer().to_pybytes() if v.is_valid else b"") if v.is_valid or not keep_null else None for v in part.column(place)]
                yield pa.RecordBatch.from_arrays([*part.columns, pa.array(values, kind)], names=[*part.schema.names, out])

    return df.mapInArrow(run, T.StructType([*df.schema.fields, T.StructField(out, T.BinaryType())]))


_READ = pa.schema([("doc_id", pa.int64()), ("n_bytes", pa.int64()), ("payload_bytes", pa.int64()), ("payload_sha256", pa.string()), ("tail_crc32", pa.int64()), ("media_bytes", pa.int64()), ("media_sha256", pa.string()), ("feature", pa.string())])


def _read_back(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for lo in range(0, batch.num_rows, 200):
            part = batch.slice(lo, 200)
            files = [v.as_buffer().to_pybytes() for v in part.column(2)]
            payloads = [read_payload(m) for m in files]
            rows = [(len(p), hashlib.sha256(p).hexdigest(), zlib.crc32(p[-BLOCK:]), len(m), hashlib.sha256(m).hexdigest(), f) for p, m, f in zip(payloads, files, features(files), strict=True)]
            columns = [part.column(0), part.column(1), *map(list, zip(*rows, strict=True))]
            yield pa.RecordBatch.from_arrays([c if isinstance(c, pa.Array) else pa.array(c, t.type) for c, t in zip(columns, _READ, strict=True)], schema=_READ)


def op6(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select(F.col("doc_id").cast("long").alias("doc_id"), F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"))
    stored = settle(with_media(docs.select("doc_id", F.octet_length("text").cast("long").alias("n_bytes"), "text")).drop("text"), "media")
    return stored.mapInArrow(_read_back, "doc_id long, n_bytes long, payload_bytes long, payload_sha256 string, tail_crc32 long, media_bytes long, media_sha256 string, feature string")

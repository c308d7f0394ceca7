"""Operator 5: Order MinHash fingerprints, sensitive to edit distance.

The units are the ``K`` code points from each place of a text, numbered by occurrence (the second "abc..." differs from the first). For each of ``SKETCHES`` hash
functions the ``PICKS`` units of smallest value are selected, put back in the order of the text, and their tuple is hashed to 16 bits. Two fingerprints
are as like as the share of sketches that agree. A text of fewer than ``K`` code points is one unit; of fewer than ``PICKS`` units, all are selected.

The next document in id order is found without one task that sees all: rows go to ranges by quantiles of the ids, each range's first document is sent to the
range before it too, and ranges are sorted in tasks. An id that fills several quantiles, and the null id likewise, has as many ranges of its own, cut by the hash of the text; so
only rows equal in id and text must stay in one range, as a sorted stream. Texts are shuffled once.

Defined results: a null text is empty; the fingerprint of the empty text is that of no unit; two empty texts are alike (1.0); null ids come first; rows of equal id are
ordered by the hash of the text, then by text; a single row is its own next document; an empty table gives an empty result.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from genoframe.llm.common import reduce_tasks

K = 8
SKETCHES = 64
PICKS = 2
#: Ranges are read as sorted streams, so that larger ranges only take longer.
MOST_RANGES = 65_536

_MIX = np.uint64(0x9E3779B97F4A7C15)
_STEP = np.uint64(0xD1342543DE82EF95)
_LOW = np.uint64((1 << 14) - 1)
#: Odd multipliers, one per sketch, from a fixed generator.
_FACTORS = (np.random.Generator(np.random.PCG64(20)).integers(0, 1 << 31, SKETCHES, np.uint32) * np.uint32(2) + np.uint32(1)).astype(np.uint32)


def _mixed(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(32))) * _MIX
    x = (x ^ (x >> np.uint64(29))) * _STEP
    return x ^ (x >> np.uint64(32))


def _power(n: int) -> np.uint64:
    return np.uint64(pow(int(_STEP), n, 1 << 64))


def unit_hashes(points: np.ndarray) -> np.ndarray:
    """64-bit hashes of the occurrence-numbered units of a text's code points, in text order."""
    if not len(points):
        return np.empty(0, np.uint64)
    h = points.astype(np.uint64) + np.uint64(1)
    width = min(K, len(points))
    built, size = h, 1
    while size * 2 <= width:
        built = built[: len(built) - size] * _power(size) + built[size:]
        size *= 2
    if size < width:
        built = built[: len(points) - width + 1] * _power(width - size) + built[width - size : width - size + len(points) - width + 1]
    units = _mixed(built + np.uint64(width))
    ordered = np.sort(units)
    again = ordered[1:][ordered[1:] == ordered[:-1]]
    if len(again):
        # places whose low bits are those of a repeated unit: few more than the repeated ones
        table = np.zeros(1 << 14, bool)
        table[again & _LOW] = True
        at = np.flatnonzero(table[units & _LOW])
        order = np.argsort(units[at], kind="stable")
        own = units[at][order]
        first = np.flatnonzero(np.concatenate(([True], own[1:] != own[:-1])))
        number = np.arange(len(own)) - np.repeat(first, np.diff(first, append=len(own)))
        later = number > 0
        units[at[order[later]]] = _mixed(own[later] + number[later].astype(np.uint64) * _MIX)
    return units


def fingerprint(points: np.ndarray) -> np.ndarray:
    """SKETCHES numbers of 16 bits."""
    units = unit_hashes(points)
    if not len(units):
        return np.zeros(SKETCHES, np.uint16)
    short = (units >> np.uint64(32)).astype(np.uint32)
    picks = np.empty((SKETCHES, min(PICKS, len(units))), np.int64)
    at_once = max(1, (1 << 18) // len(short))
    for lo in range(0, SKETCHES, at_once):
        values = short * _FACTORS[lo : lo + at_once, None]
        rows = np.arange(len(values))
        for j in range(picks.shape[1]):
            at = values.argmin(axis=1)
            picks[lo : lo + at_once, j] = at
            values[rows, at] = 0xFFFFFFFF
    picks.sort(axis=1)
    chosen = units[picks]
    out = np.full(SKETCHES, 7, np.uint64)
    for j in range(chosen.shape[1]):
        out = _mixed(out * _STEP + chosen[:, j])
    return (out >> np.uint64(48)).astype(np.uint16)


def likeness(a: np.ndarray, b: np.ndarray) -> float:
    return float(np.count_nonzero(a == b)) / SKETCHES


def _text(values: np.ndarray) -> str:
    return values.astype(">u2").tobytes().hex()


def _points(text: bytes) -> np.ndarray:
    return np.frombuffer(text.decode().encode("utf-32-le"), np.uint32)


_OUT = pa.schema([("doc_id", pa.int64()), ("n_chars", pa.int64()), ("edited_sha256", pa.string()), ("fingerprint", pa.string()), ("edited_fingerprint", pa.string()), ("near_edited", pa.float64()), ("near_next", pa.float64())])
_OUT_DDL = "doc_id long, n_chars long, edited_sha256 string, fingerprint string, edited_fingerprint string, near_edited double, near_next double"


def _compared(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows (range, guest, doc_id, text) sorted; a range ends with the first row of the next one as guest."""
    held: tuple | None = None  # range, guest, doc_id, code points, fingerprint
    rows: list[tuple] = []
    for batch in batches:
        for lo in range(0, batch.num_rows, 1000):
            part = batch.slice(lo, 1000)
            ranges, guests, ids = (part.column(k).to_pylist() for k in range(3))
            for where, guest, doc_id, text in zip(ranges, guests, ids, part.column(3), strict=True):
                points = _points(text.as_buffer().to_pybytes())
                print_of = fingerprint(points)
                if held is not None and held[0] == where:
                    _, _, own_id, own, own_print = held
                    half = len(own) // 2
                    edited = np.concatenate((own[: len(own) - half], points[:half]))
                    changed = fingerprint(edited)
                    digest = hashlib.sha256(edited.tobytes().decode("utf-32-le").encode()).hexdigest()
                    rows.append((own_id, len(own), digest, _text(own_print), _text(changed), likeness(own_print, changed), likeness(own_print, print_of)))
                held = None if guest else (where, guest, doc_id, points, print_of)
            if rows:
                yield pa.RecordBatch.from_arrays([pa.array(c, t.type) for c, t in zip(zip(*rows, strict=True), _OUT, strict=True)], schema=_OUT)
                rows = []


def with_next(docs: DataFrame) -> DataFrame:
    """Fingerprints of ``docs`` (doc_id, text), of their edited texts, and likenesses to these and the next document's."""
    spark = docs.sparkSession
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"))
    wanted = min(MOST_RANGES, 8 * reduce_tasks(spark))
    # range bounds from the ids alone; ``wanted`` numbers come to the driver
    quantiles = F.percentile_approx("doc_id", [k / wanted for k in range(1, wanted)], 100 * wanted)
    bounds, n, unknown = rows.agg(quantiles.alias("q"), F.count("*"), F.count_if(F.col("doc_id").isNull())).first()
    placed = rows.withColumn("hash", F.shiftrightunsigned(F.xxhash64("text"), 1)).withColumn("range", _range_of(bounds or [], -(-unknown * wanted // max(n, 1))))
    # one row for each range, of which there are three for each quantile at most
    ranges = placed.groupBy("range").agg(F.min(F.struct(F.col("doc_id").isNotNull().alias("known"), "doc_id", "hash")).alias("least")).collect()
    present = sorted(r["range"] for r in ranges)
    before = {r: present[k - 1] for k, r in enumerate(present)}
    follow = spark.createDataFrame([(r["range"], before[r["range"]], r["least"]["doc_id"], r["least"]["hash"]) for r in ranges], "r int, before int, least long, least_hash long")
    firsts = placed.join(F.broadcast(follow), F.col("range") == F.col("r"))
    # the first row of a range: of equal ids and hashes the one whose text comes first
    guests = firsts.where("doc_id <=> least and hash = least_hash").groupBy("before", "doc_id", "hash").agg(F.min("text").alias("text"))
    own = placed.select("range", F.lit(0).alias("guest"), "doc_id", "text", "hash")
    both = own.unionByName(guests.select(F.col("before").alias("range"), F.lit(1).alias("guest"), "doc_id", "text", "hash"))
    dealt = both.repartition(reduce_tasks(spark), "range").sortWithinPartitions("range", "guest", F.col("doc_id").asc_nulls_first(), "hash", "text")
    return dealt.drop("hash").mapInArrow(_compared, _OUT_DDL)


def slices(bounds: list[int], unknown: int) -> tuple[list[int], list[int], list[int]]:
    """Distinct bounds, the number of slices of each (0: the id is not that frequent) and the number of its range; null ids have the first ``unknown`` ranges."""
    cuts = sorted(set(bounds))
    times = {c: 0 for c in cuts}
    for c in bounds:
        times[c] += 1
    widths = [times[c] if times[c] > 1 else 0 for c in cuts]
    starts = (unknown + np.arange(len(cuts)) + np.cumsum([0, *widths])[: len(cuts)]).tolist()
    return cuts, widths, starts


def _range_of(bounds: list[int], unknown: int) -> Column:
    """The number of a row's range: ids between two bounds have one, an id that is several bounds at once as many more, by the share of hashes (of 63 bits) below the row's."""
    cuts, widths, starts = slices(bounds, unknown)
    slice_of = lambda width: F.floor(F.shiftright("hash", 31).cast("double") * width / F.lit(float(1 << 32))).cast("int")
    of_null = slice_of(F.lit(unknown))
    if not cuts:
        return F.when(F.col("doc_id").isNull(), of_null).otherwise(F.lit(unknown))
    last = starts[-1] + widths[-1] + 1
    # position, bound, slices and first range together, so that the search is written once
    table = F.array(*(F.struct(F.lit(c).cast("long").alias("cut"), F.lit(w).alias("width"), F.lit(s).alias("start")) for c, w, s in zip(cuts, widths, starts, strict=True)))
    found = F.transform(F.array(F.get(table, _below(cuts))), lambda x: F.when(x.isNull(), F.lit(last)).when((F.col("doc_id") == x["cut"]) & (x["width"] > 0), x["start"] + 1 + slice_of(x["width"])).otherwise(x["start"]))
    return F.when(F.col("doc_id").isNull(), of_null).otherwise(F.get(found, F.lit(0)))


def _below(cuts: list[int]) -> Column:
    """Number of cuts below the id, by binary search over an array literal."""
    array = F.array(*(F.lit(c).cast("long") for c in cuts))
    low, high = F.lit(0), F.lit(len(cuts))
    steps = len(cuts).bit_length()
    start = F.struct(low.alias("a"), high.alias("b"))
    middle = lambda s: F.floor((s["a"] + s["b"]) / 2).cast("int")

    def narrowed(s, _):
        m = middle(s)
        over = F.col("doc_id") > F.get(array, m)
        done = s["a"] >= s["b"]
        return F.struct(F.when(done | ~over, s["a"]).otherwise(m + 1).alias("a"), F.when(done | over, s["b"]).otherwise(m).alias("b"))

    return F.aggregate(F.sequence(F.lit(1), F.lit(steps)), start, narrowed, lambda s: s["a"])


def op5(spark: SparkSession, sf_dir: str) -> DataFrame:
    return with_next(spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text"))

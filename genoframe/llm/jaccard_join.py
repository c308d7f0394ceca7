"""Operator 7: exact Jaccard join on word shingles, for near-duplicate groups.

Two sets A and B are linked when 100 * |A & B| >= 80 * |A | B|, i.e. when their Jaccard distance is at most 0.2.

1. Equal sets are one class (64-bit digest of the set). Shortened shingle codes go, packed by bucket, to the reducers, which count in how
   many classes each occurs. A class can only have a partner if at least 80 % of its shingles occur in another class too; all others leave here.
   Shortening can only merge codes, never part them, so that it lets more classes pass, but drops none (codes that merge within a class are
   counted and allowed for).
2. Pivots create regions. Each shared code elects, among the classes that have it in their prefix (the ``n - ceil(0.8 n) + 1`` rarest codes), the
   one with the smallest share of shingles of its own. A class is put in the region of each pivot that its prefix reaches, so in those of
   near pivots, and boundary classes in several. Two linked classes share a code of their prefixes, hence a pivot's region. (Regions over
   a few pivots for all documents would not do: unrelated documents all lie at distance 1 from each other.)
3. Distances to the pivots are taken. Members that links connect are one component. Only members of other components are compared further, region by
   region, with new pivots (first one open member of each component, then more of them, four times as many in each round), skipping by the triangle inequality
   pairs whose distances to the region's pivot differ by more than 0.2. A region ends when its open members are in one component.
4. Links give connected components; the smallest document id of a component names it.

Distances are exact: they come from the words of both texts, numbered in each batch, not from hashes. Only the equality of whole sets rests on a digest
(two of N different sets meet with a chance of about N * N / 2**65).

Defined results: null or word-free texts have the empty set and form a component of their own; a text of fewer
than five words has one shingle, its whole word sequence; repeated rows and repeated ids are separate rows that share a class
when their sets are equal; a null id never names a component unless nothing else is there. Only the columns
``doc_id`` and ``text`` are read, so others may have any name.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import Window
from pyspark.sql import functions as F

from genoframe.llm.common import release, settle, words_of

WORDS = 5
PERCENT = 80
#: Entries that a map task holds before it sends them on.
CHUNK = 1_500_000
#: Bytes of text for each task that counts codes, and the parts in which a task works through them, to hold less at a time.
TASK_BYTES = 16 << 20
PARTS = 8
#: Bytes of text that are compared at a time.
COMPARED = 8 << 20
FIRST_PIVOTS = 16

_ODD = np.uint64(0x9E3779B97F4A7C15)


def shingle_codes(text: bytes | None, words: int = WORDS) -> np.ndarray:
    """Sorted distinct 64-bit codes of the word shingles of a text."""
    found = words_of(text or b"")
    if not found:
        return np.empty(0, np.uint64)
    digest = xxhash.xxh3_64_intdigest
    codes = np.fromiter(map(digest, found), np.uint64, len(found))
    width = min(words, len(found))
    out = codes[: len(codes) - width + 1].copy()
    for i in range(1, width):
        out = (out ^ (out >> np.uint64(29))) * _ODD + codes[i : len(codes) - width + 1 + i]
    out = (out ^ (out >> np.uint64(31))) * _ODD
    out ^= out >> np.uint64(28)
    if len(found) < words:
        out += np.uint64(len(found))
    return np.unique(out)


def _bucketed(codes: np.ndarray, buckets: int) -> np.ndarray:
    """Sorted distinct shortened codes: the bucket, which the high 16 bits give, above the low 32 bits."""
    bucket = ((codes >> np.uint64(48)) * np.uint64(buckets)) >> np.uint64(16)
    return np.unique((bucket << np.uint64(32) | (codes & np.uint64(0xFFFFFFFF))).astype(np.int64))


#: A class at home: its digest, its number of shingles and of shortened codes, and one of its documents (hash of the text, id, whether that is null).
_HOME = np.dtype([("cls", "<i8"), ("n", "<u4"), ("short", "<u4"), ("hash", "<i8"), ("doc_id", "<i8"), ("none", "u1")])
_PACKED = pa.schema([("bucket", pa.int32()), ("doc_id", pa.int64()), ("n", pa.int64()), ("cls", pa.int64()), ("codes", pa.binary()), ("counts", pa.binary()), ("classes", pa.binary()), ("homed", pa.binary())])
_PACKED_DDL = "bucket int, doc_id long, n long, cls long, codes binary, counts binary, classes binary, homed binary"


def _runs(keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Begins and lengths of the runs of equal keys, cut so that a length fits one byte."""
    starts = np.flatnonzero(np.diff(keys, prepend=keys[0] - 1)) if len(keys) else np.empty(0, np.int64)
    lengths = np.diff(starts, append=len(keys))
    pieces = -(-lengths // 255)
    at = np.arange(pieces.sum()) - np.repeat(np.cumsum(pieces) - pieces, pieces)
    return np.repeat(starts, pieces) + at * 255, np.minimum(255, np.repeat(lengths, pieces) - at * 255)


def _pack(sets: list[np.ndarray], homes: np.ndarray, buckets: int) -> pa.RecordBatch:
    """One row per bucket: codes class by class, with counts by class; and the classes at home there."""
    lengths = np.fromiter(map(len, sets), np.int64, len(sets))
    codes = np.concatenate(sets)
    key = (codes >> 32) * len(sets) + np.repeat(np.arange(len(sets)), lengths)
    order = np.argsort(key, kind="stable")
    codes, key = codes[order].astype("<u4"), key[order]
    group, count = _runs(key)
    owner, bucket = key[group] % len(sets), key[group] // len(sets)
    first = np.append(np.flatnonzero(np.diff(bucket, prepend=-1)), len(bucket))
    ends = np.append(group, len(key))
    home = homes["cls"] % buckets
    at_home = np.argsort(home, kind="stable")
    bounds = np.searchsorted(home[at_home], np.arange(buckets + 1))
    rows: dict[int, list] = {int(bucket[a]): [codes[ends[a] : ends[b]].tobytes(), count[a:b].astype("u1").tobytes(), homes["cls"][owner[a:b]].tobytes(), b""] for a, b in zip(first, first[1:], strict=False)}
    for k in np.unique(home).tolist():
        rows.setdefault(k, [b"", b"", b"", b""])[3] = homes[at_home[bounds[k] : bounds[k + 1]]].tobytes()
    none = pa.nulls(len(rows), pa.int64())
    return pa.RecordBatch.from_arrays([pa.array(list(rows), pa.int32()), none, none, none, *(pa.array(list(c), pa.binary()) for c in zip(*rows.values(), strict=True))], schema=_PACKED)


def _shingled(buckets: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sets: list[np.ndarray] = []
        homes: list[tuple] = []
        seen: set[int] = set()
        held = 0
        for batch in batches:
            ids, ns, own = batch.column(0), [], []
            for doc_id, value, digest in zip(ids.to_pylist(), batch.column(1), batch.column(2).to_pylist(), strict=True):
                codes = shingle_codes(value.as_buffer().to_pybytes() if value.is_valid else None)
                ns.append(len(codes))
                name = xxhash.xxh3_64_intdigest(codes.tobytes()) - (1 << 63)
                own.append(name)
                if len(codes) and name not in seen:
                    seen.add(name)
                    sets.append(_bucketed(codes, buckets))
                    homes.append((name, len(codes), len(sets[-1]), digest, doc_id or 0, doc_id is None))
                    held += len(codes)
                    if held >= CHUNK:
                        yield _pack(sets, np.array(homes, _HOME), buckets)
                        sets, homes, held = [], [], 0
                        if len(seen) > 200_000:
                            seen = set()
            spread = np.arange(batch.num_rows) * 31 % buckets
            nothing = pa.nulls(batch.num_rows, pa.binary())
            yield pa.RecordBatch.from_arrays([pa.array(spread, pa.int32()), ids, pa.array(ns, pa.int64()), pa.array(own, pa.int64()), *[nothing] * 4], schema=_PACKED)
        if sets:
            yield _pack(sets, np.array(homes, _HOME), buckets)

    return run


_SHARED = pa.schema([("home", pa.int32()), ("doc_id", pa.int64()), ("n", pa.int64()), ("cls", pa.int64()), ("bucket", pa.int32()), ("codes", pa.binary()), ("spread", pa.binary()), ("counts", pa.binary()), ("classes", pa.binary()), ("homed", pa.binary())])
_SHARED_DDL = "home int, doc_id long, n long, cls long, bucket int, codes binary, spread binary, counts binary, classes binary, homed binary"


def _rows_of(schema: pa.Schema, size: int, **columns) -> pa.RecordBatch:
    """A batch in which the columns that are not given are null."""
    filled = [columns.get(f.name) for f in schema]
    return pa.RecordBatch.from_arrays([pa.nulls(size, f.type) if c is None else c if isinstance(c, pa.Array) else pa.array(c, f.type) for c, f in zip(filled, schema, strict=True)], schema=schema)


def _rarity(counts: np.ndarray) -> np.ndarray:
    """A byte that grows with the number of classes: exact up to 16, then in steps of an eighth of a doubling."""
    return np.where(counts <= 16, counts, np.minimum(255, 16 + np.ceil(8 * np.log2(np.maximum(counts, 1) / 16)))).astype("u1")


def _counted(homes: int):
    """Keeps the codes that occur in two classes or more, with their rarity; sends them to the class's home."""

    def found(bucket: int, codes: np.ndarray, names: np.ndarray) -> Iterator[list]:
        order = np.lexsort((names, codes))
        codes, names = codes[order], names[order]
        fresh = np.ones(len(codes), bool)
        fresh[1:] = (codes[1:] != codes[:-1]) | (names[1:] != names[:-1])
        codes, names = codes[fresh], names[fresh]
        starts = np.flatnonzero(np.diff(codes.astype(np.int64), prepend=-1))
        spread = np.diff(starts, append=len(codes))
        spread = np.repeat(spread, spread)
        keep = spread > 1
        codes, names, spread = codes[keep], names[keep], _rarity(spread[keep])
        order = np.lexsort((names, names % homes))
        codes, names, spread = codes[order], names[order], spread[order]
        home = names % homes
        cuts = np.append(np.flatnonzero(np.diff(home, prepend=-1)), len(home)).tolist()
        for a, b in zip(cuts, cuts[1:], strict=False):
            group, count = _runs(names[a:b])
            yield [int(home[a]), bucket, codes[a:b].tobytes(), spread[a:b].tobytes(), count.astype("u1").tobytes(), names[a:b][group].tobytes()]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        parts: dict[int, list[tuple]] = {}
        for batch in batches:
            packed = batch.column(4).is_valid()
            plain = batch.filter(pa.compute.invert(packed))
            yield _rows_of(_SHARED, plain.num_rows, home=plain.column(0), doc_id=plain.column(1), n=plain.column(2), cls=plain.column(3))
            batch = batch.filter(packed)
            yield _rows_of(_SHARED, batch.num_rows, home=batch.column(0), homed=batch.column(7))
            for bucket, codes, counts, names in zip(*(batch.column(k).to_pylist() for k in (0, 4, 5, 6)), strict=True):
                parts.setdefault(bucket, []).append((np.frombuffer(codes, "<u4"), np.repeat(np.frombuffer(names, np.int64), np.frombuffer(counts, "u1"))))
        for bucket in sorted(parts):
            codes, names = (np.concatenate(c) for c in zip(*parts.pop(bucket), strict=True))
            turn = codes >> np.uint32(29)
            for k in range(PARTS):
                held = list(found(bucket, codes[turn == k], names[turn == k]))
                for lo in range(0, len(held), 1000):
                    some = held[lo : lo + 1000]
                    yield _rows_of(_SHARED, len(some), **dict(zip(_SENT, zip(*some, strict=True), strict=True)))

    return run


_SENT = ("home", "bucket", "codes", "spread", "counts", "classes")
_CLASS = pa.schema([("doc_id", pa.int64()), ("n", pa.int64()), ("cls", pa.int64()), ("hash", pa.int64()), ("own", pa.int64()), ("shared", pa.int64()), ("prefix", pa.list_(pa.int64()))])
_CLASS_DDL = "doc_id long, n long, cls long, hash long, own long, shared long, prefix array<long>"


def _candidates(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows as they are; and of each class of which enough is shared: ``own``, which grows with its shingles of its own, the most shingles that it may share, and its prefix, the rarest shared codes."""
    parts: list[tuple] = []
    known: list[np.ndarray] = []
    for batch in batches:
        coded, homed = batch.column(5).is_valid(), batch.column(9).is_valid()
        plain = batch.filter(pa.compute.and_(pa.compute.invert(coded), pa.compute.invert(homed)))
        yield _rows_of(_CLASS, plain.num_rows, doc_id=plain.column(1), n=plain.column(2), cls=plain.column(3))
        for bucket, codes, spread, counts, names in zip(*(batch.filter(coded).column(k).to_pylist() for k in range(4, 9)), strict=True):
            parts.append((np.frombuffer(codes, "<u4").astype(np.int64) | bucket << 32, np.repeat(np.frombuffer(names, np.int64), np.frombuffer(counts, "u1")), np.frombuffer(spread, "u1")))
        known += [np.frombuffer(h, _HOME) for h in batch.filter(homed).column(9).to_pylist()]
    if not parts:
        return
    # of a class that several tasks met the same entry, whatever their order
    homes = np.sort(np.concatenate(known), order=["cls", "none", "doc_id", "hash"])
    homes = homes[np.flatnonzero(np.diff(homes["cls"], prepend=homes["cls"][0] - 1))]
    codes, names, spread = (np.concatenate(c) for c in zip(*parts, strict=True))
    del parts, known
    # first those classes only of which enough is shared
    place = np.searchsorted(homes["cls"], names)
    common = np.bincount(place, minlength=len(homes))
    n, short = homes["n"].astype(np.int64), homes["short"].astype(np.int64)
    prefix = np.where(common > 0, n - (PERCENT * n + 99) // 100 + 1 - (short - common), 0)
    keep = prefix[place] > 0
    codes, spread, place = codes[keep], spread[keep], place[keep]
    order = np.lexsort((codes, spread, place))
    codes, place = codes[order], place[order]
    starts = np.flatnonzero(np.diff(place, prepend=-1))
    own = place[starts]
    for lo in range(0, len(own), 2000):
        some = own[lo : lo + 2000]
        lists = [codes[a : a + prefix[k]] for a, k in zip(starts[lo : lo + 2000], some, strict=True)]
        ids = pa.array(homes["doc_id"][some], pa.int64(), mask=homes["none"][some].astype(bool))
        yield _rows_of(_CLASS, len(some), doc_id=ids, n=n[some], cls=homes["cls"][some], hash=homes["hash"][some], own=(n[some] * 1_000_000) // common[some], shared=common[some] + n[some] - short[some], prefix=lists)


def _task_keys(spark: SparkSession, tasks: int) -> Column:
    """An array of numbers of which the k-th goes to the k-th of ``tasks`` partitions, so that buckets are dealt evenly."""
    many = spark.range(tasks * 40).groupBy(F.pmod(F.hash(F.col("id").cast("int")), F.lit(tasks)).alias("task")).agg(F.min(F.col("id").cast("int")).alias("key"))
    found = {r["task"]: r["key"] for r in many.collect()}
    return F.array(*(F.lit(found.get(k, k)) for k in range(tasks)))


def tasks_for(docs: DataFrame) -> int:
    """Tasks for the texts of ``docs``, by their bytes."""
    size = docs.agg(F.sum(F.octet_length(F.col("text").cast("string")))).first()[0] or 0
    return min(65536, max(8, -(-size // TASK_BYTES)))


def classes_of(docs: DataFrame, tasks: int) -> tuple[DataFrame, DataFrame]:
    """(doc_id, n, cls) of every document, and (cls, n, own, shared, prefix, text) of each class that may have a partner."""
    spark = docs.sparkSession
    source = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"), F.xxhash64(F.col("text").cast("string")).alias("hash"))
    keys = _task_keys(spark, tasks)
    packed = source.mapInArrow(_shingled(tasks), _PACKED_DDL).repartition(tasks, keys[F.col("bucket")])
    shared = packed.mapInArrow(_counted(tasks), _SHARED_DDL).repartition(tasks, keys[F.col("home")])
    rows = settle(shared.mapInArrow(_candidates, _CLASS_DDL), "jaccard-classes")
    lists = rows.where("prefix is not null").select("cls", "n", "own", "shared", "prefix", "hash", F.col("doc_id").alias("of"))
    # the text of one document of each class; rows that repeat id and text are brought together after a first step in each task
    told = source.join(lists.select("cls", "hash", "of"), "hash").where(F.col("doc_id").eqNullSafe(F.col("of"))).groupBy("cls").agg(F.first("text").alias("text"))
    texts = settle(told.coalesce(tasks), "jaccard-texts")
    return rows.where("prefix is null").select("doc_id", "n", "cls"), lists.select("cls", "n", "own", "shared", "prefix").join(texts, "cls")


def _numbered(texts: list[bytes], words: int = WORDS) -> list[np.ndarray]:
    """The shingle sets of texts as sorted numbers; equal shingles of any two of them have equal numbers, others have not."""
    names: dict[bytes, int] = {}
    short: dict[tuple, int] = {}
    coded = [np.fromiter((names.setdefault(w, len(names)) for w in words_of(t)), np.int64) for t in texts]
    if not any(len(c) >= words for c in coded):
        return [np.array([short.setdefault(tuple(c.tolist()), len(short))] if len(c) else [], np.int64) for c in coded]
    flat = np.concatenate(coded)
    # numbers of longer and longer sequences: of the sequence before and the word after it
    grams = flat
    for k in range(1, words):
        grams = np.unique(grams[:-1] * (len(names) + 1) + flat[k:], return_inverse=True)[1]
    out, at = [], 0
    for c in coded:
        own = np.unique(grams[at : at + len(c) - words + 1]) if len(c) >= words else np.array([-1 - short.setdefault(tuple(c.tolist()), len(short))] if len(c) else [], np.int64)
        out.append(own)
        at += len(c)
    return out


def _measured(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(a, b, common, either) of pairs of texts (a, b, text_a, text_b)."""

    def measure(a: list, b: list, pairs: list[tuple[bytes, bytes]]) -> pa.RecordBatch:
        places = {t: k for k, t in enumerate(dict.fromkeys(t for p in pairs for t in p))}
        sets = _numbered(list(places))
        common, either = [], []
        for s, t in pairs:
            x, y = sets[places[s]], sets[places[t]]
            shared = len(x) + len(y) - len(np.unique(np.concatenate((x, y))))
            common.append(shared)
            either.append(len(x) + len(y) - shared)
        return pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in (a, b, common, either)], names=["a", "b", "common", "either"])

    for batch in batches:
        a, b, held, size, begin = batch.column(0).to_pylist(), batch.column(1).to_pylist(), [], 0, 0
        for k, (s, t) in enumerate(zip(batch.column(2), batch.column(3), strict=True)):
            held.append((s.as_buffer().to_pybytes(), t.as_buffer().to_pybytes()))
            size += len(held[-1][0]) + len(held[-1][1])
            if size >= COMPARED:
                yield measure(a[begin : k + 1], b[begin : k + 1], held)
                held, size, begin = [], 0, k + 1
        if held:
            yield measure(a[begin:], b[begin:], held)


def _verified(pairs: DataFrame, texts: DataFrame, tasks: int) -> DataFrame:
    """(a, b, common, either) with the sizes of intersection and union."""
    left = texts.select(F.col("cls").alias("a"), F.col("text").alias("text_a"))
    right = texts.select(F.col("cls").alias("b"), F.col("text").alias("text_b"))
    joined = pairs.join(right, "b").join(left, "a").select("a", "b", "text_a", "text_b")
    return joined.coalesce(tasks).mapInArrow(_measured, "a long, b long, common long, either long")


def _near(n1: str, rest1: str, n2: str, rest2: str) -> str:
    """Whether sizes let two members of a region be linked by it: if one of its codes is the first that they share, they share no more than what either has from it on."""
    return f"100 * least({n1}, {n2}) >= {PERCENT} * greatest({n1}, {n2}) and {100 + PERCENT} * least({rest1}, {rest2}) >= {PERCENT} * ({n1} + {n2})"


def roots_of(lists: DataFrame, tasks: int) -> DataFrame:
    """(node, root) of the connected components of all linked pairs of classes (unlinked classes may be missing). What is written goes into ``tasks`` files at most."""
    texts = lists.select("cls", "text")
    index = lists.select("cls", "n", "own", "shared", F.posexplode("prefix").alias("at", "code")).select("cls", "n", "own", "code", (F.col("shared") - F.col("at")).alias("rest"))
    elected = index.groupBy("code").agg(F.min(F.struct("own", "cls", "n", "rest")).alias("p"), F.count("*").alias("size")).where("size > 1")
    elected = elected.select("code", F.col("p.cls").alias("region"), F.col("p.n").alias("pivot_n"), F.col("p.rest").alias("pivot_rest"))
    near = F.expr(_near("n", "rest", "pivot_n", "pivot_rest"))
    regions = index.join(elected, "code").groupBy("region", "cls").agg(F.max("rest").alias("rest"), F.max(near).alias("near"), F.first("n").alias("n"), F.first("own").alias("own"))
    regions = settle(regions.coalesce(tasks), "jaccard-regions")
    pairs = regions.where("cls <> region and near").select(F.col("region").alias("a"), F.col("cls").alias("b"))
    tested = settle(_verified(pairs, texts, tasks), "jaccard-tested")
    found = tested.where(f"100 * common >= {PERCENT} * either").select("a", "b")
    roots = components(found, tasks)
    distance = tested.select(F.col("a").alias("region"), F.col("b").alias("cls"), (1 - F.col("common") / F.col("either")).alias("distance"))
    state = regions.where("cls <> region").select("region", "cls", "n", "rest", "own").join(distance, ["region", "cls"], "left").withColumn("open", F.lit(True))
    done, most, round_no = tested.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")), FIRST_PIVOTS, 0
    while True:
        # regions whose open members are not all connected yet
        labelled = _labelled(state, roots)
        mixed = labelled.where("open").groupBy("region").agg(F.min("label").alias("lo"), F.max("label").alias("hi")).where("lo < hi").select("region", "lo")
        state = settle(labelled.join(mixed, "region").coalesce(tasks), "jaccard-open")
        if state.isEmpty():
            return roots
        # the next pivots of a region: first one open member of each component but the first, then any open members of those
        own = state.where("open and label <> lo")
        if round_no == 0:
            own = own.groupBy("region", "label").agg(F.min(F.struct("own", "cls", "n", "rest", "distance")).alias("q")).select("region", "label", "q.*")
        turn = Window.partitionBy("region").orderBy("own", "cls")
        chosen = own.withColumn("turn", F.row_number().over(turn)).where(F.col("turn") <= most)
        chosen = settle(chosen.select("region", F.col("cls").alias("q"), F.col("n").alias("qn"), F.col("rest").alias("qr"), F.col("label").alias("ql"), F.col("distance").alias("qd")).coalesce(tasks), "jaccard-pivots")
        near = state.join(chosen, "region").where("label <> ql").where(_near("n", "rest", "qn", "qr"))
        near = near.where("qd is null or distance is null or abs(qd - distance) <= 0.2 + 1e-9")
        pairs = near.select(F.least("q", "cls").alias("a"), F.greatest("q", "cls").alias("b")).distinct().join(done, ["a", "b"], "left_anti")
        pairs = settle(pairs.coalesce(tasks), "jaccard-pairs")
        if not pairs.isEmpty():
            done = done.unionByName(pairs)
            linked = settle(_verified(pairs, texts, tasks), "jaccard-tested").where(f"100 * common >= {PERCENT} * either").select("a", "b")
            if not linked.isEmpty():
                roots = _joined_roots(roots, linked, tasks)
        closed = chosen.select("region", F.col("q").alias("cls"), F.lit(False).alias("shut"))
        state = state.join(closed, ["region", "cls"], "left").select("region", "cls", "n", "rest", "own", "distance", F.coalesce("shut", "open").alias("open"))
        most, round_no = most * 4, round_no + 1


def _labelled(rows: DataFrame, roots: DataFrame) -> DataFrame:
    """``rows`` with the root of each class's component so far."""
    return rows.join(roots.select(F.col("node").alias("cls"), F.col("root").alias("label")), "cls", "left").withColumn("label", F.coalesce("label", "cls"))


def _joined_roots(roots: DataFrame, linked: DataFrame, tasks: int) -> DataFrame:
    """``roots``, which is removed, after more links (a, b): only their components are joined, not their nodes anew."""
    ends = _labelled(linked.select(F.col("a").alias("cls"), "b"), roots).select(F.col("label").alias("a"), F.col("b").alias("cls"))
    contracted = components(_labelled(ends, roots).select("a", F.col("label").alias("b")), tasks)
    over = contracted.select(F.col("node").alias("root"), F.col("root").alias("now"))
    # a node that had no link yet is its own root
    nodes = roots.unionByName(over.select(F.col("root").alias("node"), "root").join(roots.select("node"), "node", "left_anti"))
    joined = settle(nodes.join(over, "root", "left").select("node", F.coalesce("now", "root").alias("root")).coalesce(tasks), "jaccard-roots")
    release(roots, contracted)
    return joined


def components(edges: DataFrame, tasks: int) -> DataFrame:
    """(node, root), written: for every node of the edges (a, b), the smallest node that it is connected with."""
    measure = F.struct(F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)")))
    current = settle(edges.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).where("a <> b").distinct().coalesce(tasks), "components")
    known = current.agg(measure).first()[0]
    while True:
        # large star: larger neighbours of a node point to its smallest neighbour
        around = current.select(F.col("a").alias("node"), F.col("b").alias("other")).unionByName(current.select(F.col("b").alias("node"), F.col("a").alias("other")))
        least = around.groupBy("node").agg(F.least(F.min("other"), F.first("node")).alias("least"))
        large = around.where("other > node").join(least, "node").select(F.col("other").alias("a"), F.col("least").alias("b"))
        # small star: smaller neighbours and the node itself point to the smallest
        large = large.where("a <> b").distinct()
        small = large.groupBy("a").agg(F.min("b").alias("least"))
        moved = large.join(small, "a").select(F.col("b").alias("x"), F.col("a").alias("y"), "least")
        moved = moved.select("x", "least").unionByName(moved.select(F.col("y").alias("x"), "least")).where("x <> least")
        older, current = current, settle(moved.select(F.col("x").alias("a"), F.col("least").alias("b")).distinct().coalesce(tasks), "components")
        release(older)
        before, known = known, current.agg(measure).first()[0]
        if known == before:
            # every node but a root points to its root
            rows = current.select(F.col("a").alias("node"), F.col("b").alias("root"))
            roots = settle(rows.unionByName(rows.select(F.col("root").alias("node"), "root").distinct()).coalesce(tasks), "jaccard-roots")
            release(current)
            return roots


def grouped(docs: DataFrame) -> DataFrame:
    """doc_id, n (shingles) and cls (the component; 0 shingles have none) for each row of ``docs`` (doc_id, text)."""
    tasks = tasks_for(docs)
    rows, lists = classes_of(docs, tasks)
    roots = roots_of(lists, tasks)
    edges = roots.select(F.col("node").alias("cls"), "root")
    return rows.join(edges, "cls", "left").select("doc_id", "n", F.coalesce("root", "cls").alias("cls"))


def near_duplicates(docs: DataFrame) -> DataFrame:
    """doc_id, n_shingles, component_id for each row of ``docs`` (doc_id, text)."""
    named = grouped(docs)
    # the smallest id of each component
    full = named.where("n > 0")
    least = full.groupBy("cls").agg(F.min("doc_id").alias("component_id"))
    out = full.join(least, "cls").select("doc_id", F.col("n").alias("n_shingles"), "component_id")
    return out.unionByName(named.where("n = 0").select("doc_id", F.col("n").alias("n_shingles"), F.col("doc_id").alias("component_id")))


def op7(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_duplicates(spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text"))

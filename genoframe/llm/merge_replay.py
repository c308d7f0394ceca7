"""Operator 8: byte-level BPE by replaying the merges over a corpus of distinct pieces.

The corpus of a replay is the set of distinct pieces (matches of the splitting pattern) of the documents that a task holds at a time: some ``CORPUS`` code points of text.
All pieces are laid out as one sequence of symbols with links to left and right neighbours. An inverted index
maps what a pair would merge to (its rank) to the places where the pair stands. Ranks are taken in order from a heap; all places of a
rank are merged left to right, and only the two neighbours of each merged pair are looked up and indexed
again. Where a merge makes a pair of lower rank within the same piece, that one is taken first, so that each piece comes out as if it were
encoded alone by its lowest rank first. A piece that is in the vocabulary as a whole is one id.

The corpus is a task's and not the table's: ids then need no join back to the 600 pieces of each document, nothing is shuffled, and
memory is bound by ``CORPUS`` and ``PIECES``. Pieces met before in the same worker process are kept (at most ``CACHED``) with their ids, the decimals of these and the
bytes that they decode to. The first links and places come from arrays of all bytes at once, and where a rank stands at
many places (``MANY``), those that are the only ones in their pieces are merged at once too.

Defined results: a null text is empty (no ids); every byte is in the vocabulary, so that any text is encoded and decoding gives its
bytes back; texts of any length are encoded whole, ``PIECES`` distinct pieces at a time, within a text too.
"""

from __future__ import annotations

import base64
import hashlib
import heapq
from array import array
from collections.abc import Iterator
from itertools import chain

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame, SparkSession

from genoframe.llm.common import must_be_free, place_of

PIECES = 200_000
CORPUS = 4_000_000
CACHED = 400_000
MANY = 48


class Vocabulary:
    """Ranks of a rank file, and the encoder state of one worker."""

    def __init__(self, path: str, pattern: str):
        with open(path, "rb") as lines:
            self.ranks = {base64.b64decode(a): int(b) for a, b in (line.split() for line in lines if line.strip())}
        self.bytes_of = {rank: piece for piece, rank in self.ranks.items()}
        self.pattern = regex.compile(pattern)
        self.single = np.array([self.ranks[bytes([b])] for b in range(256)])
        self.size = max(self.bytes_of) + 1
        # what pairs of ids merge to, by left * size + right: each way to cut an entry in two
        get = self.ranks.get
        cuts = ((get(piece[:k]), get(piece[k:]), rank) for piece, rank in self.ranks.items() for k in range(1, len(piece)))
        self.pairs = {left * self.size + right: rank for left, right, rank in cuts if left is not None and right is not None}
        keys, ranks = (np.fromiter(x, np.int64, len(self.pairs)) for x in (self.pairs, self.pairs.values()))
        left, right = keys // self.size, keys % self.size
        self.by_left, self.by_right, self.by_rank = (self._sorted_by(*x) for x in ((left, right, ranks), (right, left, ranks), (ranks, keys, ranks)))
        self.byte_pairs = np.array([get(bytes([a, b]), -1) for a in range(256) for b in range(256)])
        # of pieces: ids, their decimals, what they decode to
        self.known: dict[str, tuple[int, ...]] = {}
        self.decimals: dict[str, str] = {}
        self.decoded: dict[str, bytes] = {}

    def _sorted_by(self, first: np.ndarray, second: np.ndarray, ranks: np.ndarray) -> tuple[list[int], np.ndarray, np.ndarray]:
        """Where each id begins in ``first``, sorted, and the other two in its order."""
        order = np.lexsort((second, first))
        return np.searchsorted(first[order], np.arange(self.size + 1)).tolist(), second[order], ranks[order]

    def replay(self, pieces: list[bytes]) -> list[tuple[int, ...]]:
        """Ids of each piece, by one replay of the merges over all of them."""
        out: list[tuple[int, ...] | None] = [None] * len(pieces)
        rest = []
        for k, piece in enumerate(pieces):
            whole = self.ranks.get(piece)
            if whole is not None:
                out[k] = (whole,)
            else:
                rest.append(k)
        data = np.frombuffer(b"".join([pieces[k] for k in rest]), np.uint8)
        bounds = np.cumsum([0, *(len(pieces[k]) for k in rest)])
        links = np.arange(len(data))
        links[bounds[:-1]] = 0
        left = array("q", (links - 1).tobytes())
        links = np.arange(1, len(data) + 1)
        links[bounds[1:] - 1] = -1
        right = array("q", links.tobytes())
        symbols = array("q", self.single[data].tobytes())
        # (the same memory)
        left_at, right_at, symbol_at = (np.frombuffer(x, np.int64) for x in (left, right, symbols))
        piece_at = np.repeat(np.arange(len(rest)), np.diff(bounds))
        ranks = self.byte_pairs[data[:-1].astype(np.int64) * 256 + data[1:]]
        ranks[bounds[1:-1] - 1] = -1
        stands = np.flatnonzero(ranks >= 0)
        stands = stands[np.argsort(ranks[stands], kind="stable")]
        names, begins = np.unique(ranks[stands], return_index=True)
        stands = stands.tolist()
        index: dict[int, list[int]] = {r: stands[a:b] for r, a, b in zip(names.tolist(), begins.tolist(), [*begins.tolist()[1:], len(stands)])}
        merged, size = self.pairs.get, self.size

        def add(table: tuple[list[int], np.ndarray, np.ndarray], rank: int, others: np.ndarray, places: np.ndarray) -> None:
            """Indexes what ``rank`` and its neighbours ``others`` would merge to."""
            starts, names, ranks = table
            lo, hi = starts[rank], starts[rank + 1]
            if lo == hi:
                return
            found = np.minimum(np.searchsorted(names[lo:hi], others), hi - lo - 1) + lo
            is_pair = names[found] == others
            for new, place in zip(ranks[found[is_pair]].tolist(), places[is_pair].tolist(), strict=True):
                if new in index:
                    index[new].append(place)
                else:
                    index[new] = [place]
                    heapq.heappush(heap, new)

        def merge_alone(rank: int, places: list[int]) -> list[int]:
            """Merges the places that are the only ones in their pieces; gives the others."""
            at = np.array(places)
            at = at[(symbol_at[at] >= 0) & (right_at[at] >= 0)]
            keys = symbol_at[at] * size + symbol_at[right_at[at]]
            starts, names, _ = self.by_rank
            at = at[np.logical_or.reduce([keys == key for key in names[starts[rank] : starts[rank + 1]].tolist()])]
            alone = np.ones(len(at), bool)
            same = np.diff(piece_at[at]) == 0
            alone[1:][same] = alone[:-1][same] = False
            others, at = at[~alone].tolist(), at[alone]
            after = right_at[at]
            beyond, before = right_at[after], left_at[at]
            symbol_at[at], symbol_at[after], right_at[at] = rank, -1, beyond
            has = beyond >= 0
            left_at[beyond[has]] = at[has]
            add(self.by_left, rank, symbol_at[beyond[has]], at[has])
            before = before[before >= 0]
            add(self.by_right, rank, symbol_at[before], before)
            return others

        heap = list(index)
        heapq.heapify(heap)
        while heap:
            rank = heapq.heappop(heap)
            places = index.pop(rank, None)
            if places is None:
                continue
            places.sort()
            if len(places) >= MANY:
                places = merge_alone(rank, places)
            later: list[int] = []
            held_until = -1  # places of the piece that has a lower rank to take first
            for at in places:
                if at <= held_until:
                    later.append(at)
                    continue
                symbol = symbols[at]
                if symbol < 0 or (after := right[at]) < 0 or merged(symbol * size + symbols[after], -1) != rank:
                    continue
                symbols[at] = rank
                symbols[after] = -1
                beyond = right[after]
                right[at] = beyond
                lower = False
                if beyond >= 0:
                    left[beyond] = at
                    new = merged(rank * size + symbols[beyond], -1)
                    if new >= 0:
                        if new in index:
                            index[new].append(at)
                        else:
                            index[new] = [at]
                            heapq.heappush(heap, new)
                        lower = new < rank
                before = left[at]
                if before >= 0:
                    new = merged(symbols[before] * size + rank, -1)
                    if new >= 0:
                        if new in index:
                            index[new].append(before)
                        else:
                            index[new] = [before]
                            heapq.heappush(heap, new)
                        lower = lower or new < rank
                if lower:
                    end = at
                    while right[end] >= 0:
                        end = right[end]
                    held_until = end
            if later:
                if rank in index:
                    index[rank].extend(later)
                else:
                    index[rank] = later
                    heapq.heappush(heap, rank)
        alive = symbol_at >= 0
        ids = symbol_at[alive].tolist()
        bounds = np.concatenate(([0], np.cumsum(alive)))[bounds].tolist()
        for k, lo, hi in zip(rest, bounds, bounds[1:]):
            out[k] = tuple(ids[lo:hi])
        return out

    def split(self, texts: list[str]) -> Iterator[list[str]]:
        """Each text's pieces, in order; ``known``, ``decimals`` and ``decoded`` have them all until the next text is taken."""
        split: list[list[str]] = []
        fresh: set[str] = set()
        known, find = self.known, self.pattern.findall

        def finish() -> Iterator[list[str]]:
            missing = list(fresh)
            for lo in range(0, len(missing), PIECES):
                some = missing[lo : lo + PIECES]
                for piece, ids in zip(some, self.replay([p.encode() for p in some]), strict=True):
                    known[piece], self.decimals[piece], self.decoded[piece] = ids, ",".join(map(str, ids)), self.decode(ids)
            yield from split
            split.clear()
            fresh.clear()
            if len(known) > CACHED:
                for kept in (known, self.decimals, self.decoded):
                    kept.clear()

        for text in texts:
            pieces = find(text)
            split.append(pieces)
            fresh |= set(pieces).difference(known)
            if len(fresh) >= PIECES:
                yield from finish()
        yield from finish()

    def encode(self, texts: list[str]) -> list[list[int]]:
        """Ids of each text."""
        return [list(chain.from_iterable(map(self.known.__getitem__, pieces))) for pieces in self.split(texts)]

    def decode(self, ids: list[int] | tuple[int, ...]) -> bytes:
        return b"".join(map(self.bytes_of.__getitem__, ids))


_VOCABULARIES: dict[tuple, Vocabulary] = {}


def vocabulary(path: str, pattern: str) -> Vocabulary:
    if (path, pattern) not in _VOCABULARIES:
        _VOCABULARIES[path, pattern] = Vocabulary(path, pattern)
    return _VOCABULARIES[path, pattern]


def _default(path: str | None, pattern: str | None) -> tuple[str, str]:
    import public_tokenizers

    return path or public_tokenizers.path("byte_bpe_multi_50k.tiktoken"), pattern or public_tokenizers.PATTERN


def _batches(batches: Iterator[pa.RecordBatch], column: int) -> Iterator[tuple[pa.RecordBatch, list[str]]]:
    for batch in batches:
        begin, held, size = 0, [], 0
        for k, text in enumerate(batch.column(column)):
            held.append(text.as_py() or "")
            size += len(held[-1])
            if size >= CORPUS or k + 1 == batch.num_rows:
                yield batch.slice(begin, k + 1 - begin), held
                begin, held, size = k + 1, [], 0


def with_ids(df: DataFrame, text: str = "text", out: str = "ids", path: str | None = None, pattern: str | None = None) -> DataFrame:
    """``df`` with the ids of its text as an array of ints in column ``out``, which it must not have yet."""
    must_be_free(df, out)
    where, cut, place = *_default(path, pattern), place_of(df, text)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part, texts in _batches(batches, place):
            ids = vocabulary(where, cut).encode(texts)
            yield pa.RecordBatch.from_arrays([*part.columns, pa.array(ids, pa.list_(pa.int32()))], names=[*part.schema.names, out])

    from pyspark.sql import types as T

    return df.mapInArrow(run, T.StructType([*df.schema.fields, T.StructField(out, T.ArrayType(T.IntegerType()))]))


def digests(df: DataFrame, path: str | None = None, pattern: str | None = None) -> DataFrame:
    """doc_id, n_tokens, ids_sha256 and decoded_sha256 of ``df`` (doc_id, text)."""
    where, cut = _default(path, pattern)
    schema = pa.schema([("doc_id", pa.int64()), ("n_tokens", pa.int64()), ("ids_sha256", pa.string()), ("decoded_sha256", pa.string())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part, texts in _batches(batches, 1):
            counts, names, back = [], [], []
            words = vocabulary(where, cut)
            for pieces in words.split(texts):
                ids = ",".join(map(words.decimals.__getitem__, pieces))
                counts.append(ids.count(",") + 1 if ids else 0)
                names.append(hashlib.sha256(ids.encode()).hexdigest())
                back.append(hashlib.sha256(b"".join(map(words.decoded.__getitem__, pieces))).hexdigest())
            yield pa.RecordBatch.from_arrays([part.column(0), pa.array(counts, pa.int64()), pa.array(names), pa.array(back)], schema=schema)

    rows = df.selectExpr("cast(doc_id as long) as doc_id", "cast(text as string) as text")
    return rows.mapInArrow(run, "doc_id long, n_tokens long, ids_sha256 string, decoded_sha256 string")


def op8(spark: SparkSession, sf_dir: str) -> DataFrame:
    return digests(spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text"))

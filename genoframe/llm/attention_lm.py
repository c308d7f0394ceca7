"""Operator 10: language-model scores by a causal self-attention model in numpy over subword ids.

Base score: add-one unigrams of words over all training documents. Tasks count words in their part, Spark sums the counts. The most frequent words (at most
``HOT_WORDS``, by a count threshold) go to every task; the other words of a document are looked up by a join. Nothing of the vocabulary's size comes to the driver or to one task.

Model: subword ids of a public vocabulary fall into ``CLASSES`` classes by their counts in the training documents (the most frequent ones alone, the others by
falling count in classes of about equal weight). ``p(id) = p(class | classes before) * p(id | class, id before)``; the second factor is from counts of all training
documents (of an id after another one, on top of add-one counts of the id; as with words, the most frequent pairs of ids, at most ``HOT_PAIRS``, go to every task and
the others are looked up by a join), the first one a one-layer causal self-attention model on top of a class bigram prior (counts of all training documents), with a softmax in two
steps (group of classes, class in the group). It learns from the whole text of every training document, cut into consecutive windows: each id is learnt in one of the
rounds, ``EPOCHS`` times; the prior is taken without the occurrence that is being learnt, as the model would else trust it more than held-out text bears out. In each round replicas of the common weights learn from about ``REPLICA_IDS`` ids each
with one optimiser and one falling rate over all of them, and Spark averages them by their windows. Which
replica learns from a document, and in which order, comes from a hash, so that the weights do not depend on how files are split or how many tasks run.

Scoring: windows of ``WINDOW`` ids overlap; each id is scored once, with at least ``WINDOW - STRIDE`` ids before it (or all there are), in batches with a causal mask.
A document's last id is its end.

Defined results: a null text is empty, it has one token, the end; a held-out row is never learnt from; repeated rows are counted and scored row by row; with no training row N and V are 0 and
the model keeps its first weights; texts of any length are scored whole, some windows at a time; an empty table gives an empty result.
"""

from __future__ import annotations

import math
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from genoframe.llm.common import crc32_of_id, settle, words_of
from genoframe.llm.token_files import encoder

HOT_WORDS = HOT_PAIRS = 1 << 18
#: Weight of p(id | class) beside the counts of an id after another one.
PAIR_SMOOTH = 3.0
GROUPS = 32
CLASSES, ALONE = GROUPS * GROUPS, 960
WIDTH, HIDDEN = 16, 32
WINDOW, STRIDE = 16, 12
#: Ids that a replica learns from in all rounds, about; windows that it takes at a time.
REPLICA_IDS = 4_000_000
TAUGHT = 65_536
#: Windows in one row at most, so that long texts go on in several.
ROW_WINDOWS = 4_096
ROUNDS, EPOCHS, RATE = 2, 2, 0.02
#: Windows of a step, at least and at most, and the steps that a replica's round has, about, in between.
BATCH, LARGEST, STEPS = 128, 256, 960
FOLDS, HELD = 7, 2
#: Words that a task counts before it sends its counts on.
COUNTED = 400_000
END = 0  # of the model's ids; the vocabulary's ids follow, one higher
BEGIN = 0  # the class that stands before the first id


# --- the model ---------------------------------------------------------------------------------------------------


def _shapes() -> dict[str, tuple[int, ...]]:
    d, c, h = WIDTH, CLASSES, HIDDEN
    return {"embed": (c, d), "place": (WINDOW, d), "query": (d, d), "key": (d, d), "value": (d, d), "mix": (d, d), "up": (d, h), "up_bias": (h,), "down": (h, d), "out": (d, GROUPS), "bias": (GROUPS,), "inner": (GROUPS, d, GROUPS), "inner_bias": (GROUPS, GROUPS)}


def first_weights() -> dict[str, np.ndarray]:
    """Weights whose output adds nothing yet to the bigram prior."""
    random = np.random.default_rng(5)
    still = {"out", "inner"}
    return {k: np.zeros(s, np.float32) if len(s) == 1 or k in still or k.endswith("bias") else random.normal(0, 0.5 if k == "embed" else 0.25, s).astype(np.float32) for k, s in _shapes().items()}


def prior_of(pairs: np.ndarray, smooth: float = 20.0) -> tuple[np.ndarray, ...]:
    """Log p(group | class before) and log p(member | group, class before) from counts (class before, class); and for both what their logarithm loses if one occurrence is left out."""
    # class c is member c // GROUPS of group c % GROUPS
    counts = pairs.reshape(CLASSES, GROUPS, GROUPS).transpose(0, 2, 1).astype(np.float64)
    alone = counts.sum(0) + 0.5
    by_group = counts.sum(2) + smooth * alone.sum(1) / alone.sum()
    inner = counts + smooth / 4 * (alone / alone.sum(1, keepdims=True))
    logs = np.log(by_group / by_group.sum(1, keepdims=True)), np.log(inner / inner.sum(2, keepdims=True))
    # (what was never counted has nothing to lose; the other classes' shares follow by the softmax)
    lost = np.log(by_group - np.minimum(counts.sum(2), 1)) - np.log(by_group), np.log(inner - np.minimum(counts, 1)) - np.log(inner)
    return tuple(x.astype(np.float32, order="C") for x in (*logs, *lost))


def flat(weights: dict[str, np.ndarray]) -> np.ndarray:
    return np.concatenate([weights[k].ravel() for k in _shapes()])


def unflat(values: np.ndarray) -> dict[str, np.ndarray]:
    out, at = {}, 0
    for k, shape in _shapes().items():
        size = int(np.prod(shape))
        out[k] = np.asarray(values[at : at + size], np.float32).reshape(shape)
        at += size
    return out


_MASK = np.triu(np.full((WINDOW, WINDOW), -1e9, np.float32), 1)
#: The mask and the largest exponent in one: what a product may be at most.
_MOST = np.where(_MASK < 0, _MASK, np.float32(60))
#: Rows of one product with the weights of a group, at least.
CHUNK = 32
_CELLS = np.arange(CLASSES * WIDTH).reshape(CLASSES, WIDTH)


def _forward(w: dict[str, np.ndarray], x: np.ndarray) -> dict[str, np.ndarray]:
    """Hidden states of windows of classes ``x`` (windows, WINDOW)."""
    h = w["embed"][x] + w["place"]
    flat_h = h.reshape(-1, WIDTH)
    q, k, v = ((flat_h @ w[name]).reshape(h.shape) for name in ("query", "key", "value"))
    s = np.matmul(q, k.transpose(0, 2, 1))
    s *= np.float32(1 / math.sqrt(WIDTH))
    s += _MASK
    np.minimum(s, np.float32(60), out=s)
    a = np.exp(s, out=s)
    a /= a.sum(-1, keepdims=True)
    z = np.matmul(a, v)
    o = h + (z.reshape(-1, WIDTH) @ w["mix"]).reshape(h.shape)
    m = np.maximum(o.reshape(-1, WIDTH) @ w["up"] + w["up_bias"], 0)
    f = o + (m @ w["down"]).reshape(h.shape)
    return {"x": x, "h": h, "q": q, "k": k, "v": v, "a": a, "z": z, "o": o, "m": m, "f": f}


def _by_group(group: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Lays places out by their groups in chunks of equally many rows, so that one call multiplies all of them: the place in each row (place 0 where a group's last
    chunk has rows to spare), each place's row, and each chunk's group."""
    counts, size = np.bincount(group, minlength=GROUPS), max(CHUNK, len(group) // (4 * GROUPS))
    chunks = -(-counts // size)
    first = np.cumsum(chunks) - chunks
    order = np.argsort(group.astype(np.uint8), kind="stable")
    filled = np.arange(len(group)) + np.repeat(first * size - np.cumsum(counts) + counts, counts)
    places, rows = np.zeros(int(chunks.sum()) * size, np.int64), np.empty(len(group), np.int64)
    places[filled], rows[order] = order, filled
    return places, rows, np.repeat(np.arange(GROUPS), chunks)


def _exponentials(logits: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray | float]:
    """Exponentials of rows less a number, the sums of the rows, and the number. It is 0 (the prior's logits are log probabilities already) unless a sum would come near
    the ends of the type's range; then it is each row's largest."""
    with np.errstate(over="ignore"):
        found = np.exp(logits)
        sums = found @ np.ones(logits.shape[1], logits.dtype)
    if not len(sums) or (sums.min() > 1e-30 and sums.max() < 1e30):
        return found, sums, 0.0
    top = logits.max(1)
    np.exp(logits - top[:, None], out=found)
    return found, found.sum(1), top


def _log_softmax_at(logits: np.ndarray, own: np.ndarray) -> np.ndarray:
    """Log probabilities of the places ``own`` of ``logits`` (places, classes), one in each row."""
    _, sums, top = _exponentials(logits)
    return logits.take(own) - top - np.log(sums)


_ONES = np.ones(WINDOW, np.float32)


def _hidden(w: dict[str, np.ndarray], x: np.ndarray, skip: int) -> np.ndarray:
    """What ``_forward`` gives for the places from ``skip`` on of each window, as rows."""
    ask, look = w["query"] * np.float32(1 / math.sqrt(WIDTH)), np.hstack((w["key"], w["value"]))
    # (a class and a place are multiplied apart: there are fewer classes than places in windows)
    late = w["embed"].take(x[:, skip:], 0)
    late += w["place"][skip:]
    q = (w["embed"] @ ask).take(x[:, skip:], 0)
    q += w["place"][skip:] @ ask
    looks = (w["embed"] @ look).take(x, 0)
    looks += w["place"] @ look
    a = np.matmul(q, looks[..., :WIDTH].transpose(0, 2, 1))
    np.minimum(a, _MOST[skip:], out=a)
    np.exp(a, out=a)
    z = np.matmul(a, looks[..., WIDTH:]).reshape(-1, WIDTH)
    z /= (a.reshape(-1, WINDOW) @ _ONES)[:, None]
    o = z @ w["mix"]
    o += late.reshape(-1, WIDTH)
    m = o @ w["up"]
    m += w["up_bias"]
    np.maximum(m, np.zeros_like(m), out=m)
    o += m @ w["down"]
    return o


def _group_logits(prior: tuple, out: np.ndarray, f: np.ndarray, before: np.ndarray) -> np.ndarray:
    """Logits of the groups, a row for each place; ``out`` has the biases as its last row, ``f`` ones as its last column."""
    rows = prior[0].take(before, 0)
    rows += f @ out
    return rows


def _member_logits(prior: tuple, inner: np.ndarray, f: np.ndarray, told: np.ndarray) -> np.ndarray:
    """Logits of the members of each place's group, a row for each place; places lie in chunks (chunks, rows, states), ``inner`` has the weights of each chunk's group;
    ``told`` are places of (class before, group) in the prior."""
    rows = prior[1].reshape(-1, GROUPS).take(told, 0)
    rows += np.matmul(f, inner).reshape(rows.shape)
    return rows


def class_log_probs(w: dict[str, np.ndarray], prior: tuple, x: np.ndarray, y: np.ndarray, keep: np.ndarray, skip: int) -> np.ndarray:
    """Natural log probabilities of the classes ``y`` at the places from ``skip`` on of the windows ``x`` where ``keep`` (rows of such places): of the
    group, then of the class within it."""
    states = _hidden(w, x, skip)
    wanted, before = y[:, skip:].ravel(), x[:, skip:].ravel()
    if not keep.all():
        states, wanted, before = states[keep], wanted[keep], before[keep]
    if not len(wanted):
        return np.zeros(0, states.dtype)
    f = np.ones((len(wanted), WIDTH + 1), states.dtype)
    f[:, :WIDTH] = states
    group = wanted % GROUPS
    logs = _log_softmax_at(_group_logits(prior, np.concatenate((w["out"], w["bias"][None])), f, before), np.arange(0, len(wanted) * GROUPS, GROUPS) + group)
    places, rows, chunk_group = _by_group(group)
    inner = np.concatenate((w["inner"], w["inner_bias"][:, None]), 1).take(chunk_group, 0)
    logits = _member_logits(prior, inner, f.take(places, 0).reshape(len(chunk_group), -1, WIDTH + 1), (before * GROUPS + group).take(places))
    logs += _log_softmax_at(logits, np.arange(0, len(places) * GROUPS, GROUPS) + (wanted // GROUPS).take(places)).take(rows)
    return logs


def _joint_shapes() -> dict[str, tuple[int, ...]]:
    """Shapes of the weights as they are learnt: what multiplies the same states side by side, biases as a last row."""
    d, c, h = WIDTH, CLASSES, HIDDEN
    return {"embed": (c, d), "place": (WINDOW, d), "looks": (d, 3 * d), "mix": (d, d), "up": (d + 1, h), "down": (h, d), "out": (d + 1, GROUPS), "inner": (GROUPS, d + 1, GROUPS)}


def _views(values: np.ndarray) -> dict[str, np.ndarray]:
    """Arrays of ``_joint_shapes`` within one row of values."""
    out, at = {}, 0
    for k, shape in _joint_shapes().items():
        size = math.prod(shape)
        out[k] = values[at : at + size].reshape(shape)
        at += size
    return out


def _joint(w: dict[str, np.ndarray]) -> np.ndarray:
    values = np.empty(sum(map(math.prod, _joint_shapes().values())), w["embed"].dtype)
    t = _views(values)
    for k in ("embed", "place", "mix", "down"):
        t[k][:] = w[k]
    t["looks"][:] = np.hstack([w["query"], w["key"], w["value"]])
    for k in ("up", "out", "inner"):
        t[k][..., :-1, :], t[k][..., -1, :] = w[k], w["bias" if k == "out" else f"{k}_bias"]
    return values


def _apart(values: np.ndarray) -> dict[str, np.ndarray]:
    t = _views(values)
    w = {k: t[k] for k in ("embed", "place", "mix", "down")} | dict(zip(("query", "key", "value"), np.split(t["looks"], 3, axis=1), strict=True))
    for k in ("up", "out", "inner"):
        w[k], w["bias" if k == "out" else f"{k}_bias"] = t[k][..., :-1, :], t[k][..., -1, :]
    return {k: w[k].copy() for k in _shapes()}


def _joint_gradients(w: dict[str, np.ndarray], g: dict[str, np.ndarray], prior: tuple, x: np.ndarray, y: np.ndarray, scored: np.ndarray, left_out: bool) -> None:
    """Puts the gradients of the mean loss over the scored places into ``g``."""
    n, d, kind = x.size, WIDTH, w["embed"].dtype
    scale, cube = kind.type(1 / math.sqrt(d)), (*x.shape, d)
    before, wanted = x.ravel(), y.ravel()
    share = scored.ravel() / kind.type(max(1, scored.sum()))

    def softmax_error(logits: np.ndarray, own: np.ndarray, weight: np.ndarray) -> np.ndarray:
        error, sums, _ = _exponentials(logits)
        error *= (weight / sums)[:, None]
        error.reshape(-1)[own] -= weight
        return error

    # forward; states that have a bias get a last column of ones; what asks is scaled by its weights
    looking = w["looks"].copy()
    looking[:, :d] *= scale
    h = (w["embed"].take(x, 0) + w["place"]).reshape(n, d)
    looks = (h @ looking).reshape(*x.shape, 3 * d)
    q, k, v = looks[..., :d], looks[..., d : 2 * d], looks[..., 2 * d :]
    a = np.matmul(q, k.transpose(0, 2, 1))
    np.minimum(a, _MOST, out=a)
    np.exp(a, out=a)
    rows = a.reshape(n, WINDOW)
    rows /= (rows @ np.ones(WINDOW, kind))[:, None]
    z = np.matmul(a, v).reshape(n, d)
    o = np.ones((n, d + 1), kind)
    np.add(h, z @ w["mix"], out=o[:, :d])
    m = o @ w["up"]
    np.maximum(m, np.zeros_like(m), out=m)
    f = np.ones((n, d + 1), kind)
    np.add(o[:, :d], m @ w["down"], out=f[:, :d])
    group, member = wanted % GROUPS, wanted // GROUPS
    told, own = before * GROUPS + group, np.arange(0, n * GROUPS, GROUPS) + group
    logits = _group_logits(prior, w["out"], f, before)
    if left_out:
        logits.reshape(-1)[own] += prior[2].take(told)
    p = softmax_error(logits, own, share)
    np.matmul(f.T, p, out=g["out"])
    back = p @ w["out"][:d].T
    # the places in chunks of their groups; rows to spare have no share
    places, at, chunk_group = _by_group(group)
    told, member, weight = told.take(places), member.take(places), np.zeros(len(places), kind)
    weight[at] = share
    own = np.arange(0, len(places) * GROUPS, GROUPS) + member
    inner, f = w["inner"].take(chunk_group, 0), f.take(places, 0).reshape(len(chunk_group), -1, d + 1)
    logits = _member_logits(prior, inner, f, told)
    if left_out:
        logits.reshape(-1)[own] += prior[3].take(told * GROUPS + member)
    p = softmax_error(logits, own, weight).reshape(len(chunk_group), -1, GROUPS)
    # (sums over the chunks of a group; quicker than reduceat)
    np.matmul((chunk_group == np.arange(GROUPS)[:, None]).astype(kind), np.matmul(f.transpose(0, 2, 1), p).reshape(len(chunk_group), -1), out=g["inner"].reshape(GROUPS, -1))
    back += np.matmul(p, inner[:, :d].transpose(0, 2, 1)).reshape(-1, d).take(at, 0)
    dm = back @ w["down"].T
    dm *= m > 0
    np.matmul(m.T, back, out=g["down"])
    np.matmul(o.T, dm, out=g["up"])
    back += dm @ w["up"][:d].T
    np.matmul(z.T, back, out=g["mix"])
    dz = back @ w["mix"].T
    # (the products of errors and shares, summed over what is looked at, are those of the sums)
    ds = np.matmul(dz.reshape(cube), v.transpose(0, 2, 1))
    ds -= ((dz * z) @ np.ones(d, kind)).reshape(*x.shape, 1)
    ds *= a
    dlooks = np.empty_like(looks)
    np.matmul(ds, k, out=dlooks[..., :d])
    np.matmul(ds.transpose(0, 2, 1), q, out=dlooks[..., d : 2 * d])
    np.matmul(a.transpose(0, 2, 1), dz.reshape(cube), out=dlooks[..., 2 * d :])
    dlooks = dlooks.reshape(n, 3 * d)
    np.matmul(h.T, dlooks, out=g["looks"])
    g["looks"][:, :d] *= scale
    back += dlooks @ looking.T
    g["place"][:] = back.reshape(cube).sum(0)
    g["embed"][:] = np.bincount(_CELLS.take(before, 0).ravel(), back.ravel(), g["embed"].size).reshape(-1, d)


def _gradients(w: dict[str, np.ndarray], prior: tuple, x: np.ndarray, y: np.ndarray, scored: np.ndarray, left_out: bool = False) -> dict[str, np.ndarray]:
    """Gradients of the mean loss over the scored places; with ``left_out`` the prior is that without each place's own occurrence."""
    values = _joint(w)
    found = np.empty_like(values)
    _joint_gradients(_views(values), _views(found), prior, x, y, scored, left_out)
    return _apart(found)


class Learner:
    """Adam over windows of WINDOW + 1 classes; moments and the falling rate go on from one call to the next. ``windows`` are about as many as all calls bring: many
    make larger steps, at a rate that grows with their square root."""

    def __init__(self, w: dict[str, np.ndarray], prior: tuple, windows: int, seed: int) -> None:
        self.values, self.prior, self.random = _joint(w), prior, np.random.default_rng(seed)
        self.found, self.one, self.two = (np.zeros_like(self.values) for _ in range(3))
        self.batch = min(LARGEST, max(BATCH, EPOCHS * windows // STEPS))
        self.step, self.steps, self.rate = 0, max(1, EPOCHS * -(-windows // self.batch)), RATE * math.sqrt(self.batch / BATCH)

    @property
    def w(self) -> dict[str, np.ndarray]:
        return _apart(self.values)

    def learn(self, windows: np.ndarray, lengths: np.ndarray) -> None:
        """EPOCHS passes over windows, of which ``lengths`` classes count; the first class of a window is context."""
        weights, gradients, g, t = _views(self.values), _views(self.found), self.found, np.empty_like(self.found)
        for _ in range(EPOCHS):
            order = self.random.permutation(len(windows))
            for lo in range(0, len(order), self.batch):
                rows = order[lo : lo + self.batch]
                some = windows[rows].astype(np.int64)
                x, y = some[:, :-1], some[:, 1:]
                scored = np.arange(WINDOW)[None, :] < (lengths[rows].astype(np.int64) - 1)[:, None]
                self.step += 1
                rate = self.rate * (1 - 0.9 * min(1.0, self.step / self.steps))
                _joint_gradients(weights, gradients, self.prior, x, y, scored, True)
                # the moments without their factors 0.1 and 0.01, which go into the numbers below
                self.one *= np.float32(0.9)
                self.one += g
                g *= g
                self.two *= np.float32(0.99)
                self.two += g
                np.sqrt(self.two, out=t)
                spread = math.sqrt(0.01 / (1 - 0.99**self.step))
                t += np.float32(1e-6 / spread)
                np.divide(self.one, t, out=t)
                t *= np.float32(rate * 0.1 / (1 - 0.9**self.step) / spread)
                self.values -= t


# --- counts ------------------------------------------------------------------------------------------------------

_COUNTS = pa.schema([("kind", pa.int32()), ("word", pa.binary()), ("id", pa.int32()), ("n", pa.int64()), ("ids", pa.binary()), ("text", pa.binary())])
_COUNTS_DDL = "kind int, word binary, id int, n long, ids binary, text binary"
_WORD, _ID, _TEXT = 0, 1, 2


def _ids_of(ids: bytes) -> np.ndarray:
    return np.frombuffer(ids, "<u2").astype(np.int64) + 1


def _gather(tokenizer_path: str):
    """Counts of words (kind 0) and ids (kind 1) of training documents; of all documents text and ids (kind 2; ``n`` is the document's id)."""

    def rows(kind: int, words=None, ids=None, ns=None, coded=None, texts=None) -> pa.RecordBatch:
        size = len(next(c for c in (words, ids, coded) if c is not None))
        columns = [pa.array(np.full(size, kind), pa.int32())]
        for c, t in zip((words, ids, ns, coded, texts), list(_COUNTS)[1:], strict=True):
            columns.append(pa.nulls(size, t.type) if c is None else c if isinstance(c, pa.Array) else pa.array(c, t.type))
        return pa.RecordBatch.from_arrays(columns, schema=_COUNTS)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counted: Counter = Counter()
        ids = np.zeros(1 << 16, np.int64)
        for batch in batches:
            for lo in range(0, batch.num_rows, 500):
                part = batch.slice(lo, 500)
                texts = [v.as_buffer().to_pybytes() if v.is_valid else b"" for v in part.column(1)]
                coded = encoder(tokenizer_path, 2, None).encode(texts)
                yield rows(_TEXT, ns=part.column(0), coded=coded, texts=texts)
                taught = [k for k, x in enumerate(part.column(2).to_pylist()) if not x]
                if not taught:
                    continue
                for k in taught:
                    counted.update(words_of(texts[k]))
                ids += np.bincount(_ids_of(b"".join(coded[k] for k in taught)), minlength=1 << 16)
                ids[END] += len(taught)
                if len(counted) >= COUNTED:
                    yield rows(_WORD, words=list(counted), ns=list(counted.values()))
                    counted = Counter()
        if counted:
            yield rows(_WORD, words=list(counted), ns=list(counted.values()))
        seen = np.flatnonzero(ids)
        if len(seen):
            yield rows(_ID, ids=seen.astype(np.int32), ns=ids[seen])

    return run


def _class_pairs(classes: np.ndarray):
    """Counts of (class before, class) of documents (ids)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pairs = np.zeros(CLASSES * CLASSES, np.int64)
        for batch in batches:
            for lo in range(0, batch.num_rows, 500):
                owns = [np.append(_ids_of(v.as_buffer().to_pybytes()), END) for v in batch.column(0).slice(lo, 500)]
                own = classes[np.concatenate(owns)]
                before = np.concatenate(([BEGIN], own[:-1]))
                before[np.cumsum([0, *map(len, owns[:-1])])] = BEGIN
                pairs += np.bincount(before * CLASSES + own, minlength=CLASSES * CLASSES)
        seen = np.flatnonzero(pairs)
        for lo in range(0, len(seen), 100_000):
            some = seen[lo : lo + 100_000]
            yield pa.RecordBatch.from_arrays([pa.array(some, pa.int32()), pa.array(pairs[some], pa.int64())], names=["id", "n"])

    return run


def _id_counts(rows: DataFrame) -> np.ndarray:
    """Counts (id, n) summed; one row for each id of the vocabulary at most."""
    ids = np.zeros(1 << 16, np.int64)
    for r in rows.groupBy("id").agg(F.sum("n").alias("n")).collect():
        ids[r["id"]] = r["n"]
    return ids


def classes_of(counts: np.ndarray) -> np.ndarray:
    """Class of each id; class 0 stands for the begin only."""
    order = np.argsort(-counts, kind="stable")
    classes = np.empty(len(counts), np.int64)
    classes[order[:ALONE]] = np.arange(1, ALONE + 1)
    rest = order[ALONE:]
    weight = np.cumsum(np.sqrt(counts[rest] + 1.0))
    groups = CLASSES - 1 - ALONE
    classes[rest] = ALONE + 1 + np.minimum((weight / weight[-1] * groups).astype(np.int64), groups - 1)
    return classes


def inside_classes(counts: np.ndarray, classes: np.ndarray) -> np.ndarray:
    """log10 p(id | class), add-one."""
    sums, sizes = np.bincount(classes, counts, CLASSES), np.bincount(classes, minlength=CLASSES)
    return np.log10((counts + 1) / (sums + sizes)[classes])


def _wholes_of(pairs: np.ndarray, ids_classes: np.ndarray) -> np.ndarray:
    """(id before, class) of pairs (id before, id)."""
    return (pairs >> 16) * CLASSES + ids_classes[pairs & 0xFFFF]


def pairs_inside(pairs: np.ndarray, counts: np.ndarray, ids_classes: np.ndarray, wholes: tuple[np.ndarray, np.ndarray] | None = None) -> tuple[np.ndarray, ...]:
    """Tables for ``inside_logs``: rising pairs (id before, id) with their counts, rising (id before, class) with the sums over all pairs, and what of those sums is of
    pairs that the table has not got. ``wholes`` are (id before, class) with their sums; without them the pairs are all there are."""
    order = np.argsort(pairs, kind="stable")
    pairs, counts = pairs[order], counts[order].astype(np.float64)
    names, at = np.unique(_wholes_of(pairs, ids_classes), return_inverse=True)
    sums = np.bincount(at, counts, len(names))
    if wholes is None:
        return pairs, counts, names, sums, np.zeros(len(names))
    order = np.argsort(wholes[0], kind="stable")
    every, whole = wholes[0][order], wholes[1][order].astype(np.float64)
    return pairs, counts, every, whole, whole - _found(names, sums, every)


def _found(keys: np.ndarray, values: np.ndarray, wanted: np.ndarray) -> np.ndarray:
    if not len(keys):
        return np.zeros(len(wanted))
    at = np.minimum(np.searchsorted(keys, wanted), len(keys) - 1)
    return np.where(keys[at] == wanted, values[at], 0.0)


def _open_places(ids: np.ndarray, starts: np.ndarray, classes: np.ndarray) -> np.ndarray:
    """Places of ids that share their class with others, but for the first ones."""
    open_ = classes[ids] > ALONE
    open_[starts] = False
    return np.flatnonzero(open_)


def inside_logs(ids: np.ndarray, starts: np.ndarray, classes: np.ndarray, inside: np.ndarray, tables: tuple) -> np.ndarray:
    """log10 p(id | class, id before) of id sequences that begin at ``starts``; a first id, and one alone in its class, has log10 p(id | class). Pairs that the
    table has not got count as not seen; ``rare_pairs`` has what is still to be added for them."""
    out = inside[ids]
    at = _open_places(ids, starts, classes)
    before, own = ids[at - 1], ids[at]
    seen, sums = _found(tables[0], tables[1], before << 16 | own), _found(tables[2], tables[3], before * CLASSES + classes[own])
    out[at] = np.log10((seen + PAIR_SMOOTH * 10 ** out[at]) / (sums + PAIR_SMOOTH))
    return out


_RARE_PAIRS = pa.list_(pa.struct([("pair", pa.int64()), ("times", pa.int64()), ("weight", pa.float64())]))


def rare_pairs(texts: list[np.ndarray], classes: np.ndarray, inside: np.ndarray, tables: tuple) -> pa.Array:
    """Of each id sequence the pairs that training documents may have although the table has not got them, how often they occur, and ``PAIR_SMOOTH`` times
    p(id | class): a pair counted n times adds log10(1 + n / weight) to each of its occurrences."""
    lengths = np.fromiter(map(len, texts), np.int64, len(texts))
    ids = np.concatenate(texts)
    at = _open_places(ids, np.cumsum(lengths) - lengths, classes) if tables[4].any() else np.empty(0, np.int64)
    pairs = ids[at - 1] << 16 | ids[at]
    left = (_found(tables[2], tables[4], _wholes_of(pairs, classes)) > 0) & (_found(tables[0], tables[1], pairs) == 0)
    at, pairs = at[left], pairs[left]
    keys, times = np.unique(np.stack((np.searchsorted(np.cumsum(lengths), at, "right"), pairs), 1), axis=0, return_counts=True)
    offsets = np.searchsorted(keys[:, 0], np.arange(len(texts) + 1))
    found = pa.StructArray.from_arrays([pa.array(keys[:, 1]), pa.array(times, pa.int64()), pa.array(PAIR_SMOOTH * 10 ** inside[keys[:, 1] & 0xFFFF])], fields=list(_RARE_PAIRS.value_type))
    return pa.ListArray.from_arrays(pa.array(offsets, pa.int32()), found, type=_RARE_PAIRS)


def _id_pairs(classes: np.ndarray):
    """Counts of (id before, id) of documents (ids), for ids that share their class with others."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[np.ndarray] = []
        size = 0

        def counted() -> pa.RecordBatch:
            pairs, n = np.unique(np.concatenate(held), return_counts=True)
            return pa.RecordBatch.from_arrays([pa.array(pairs, pa.int64()), pa.array(n, pa.int64())], names=["pair", "n"])

        for batch in batches:
            for value in batch.column(0):
                ids = np.append(_ids_of(value.as_buffer().to_pybytes()), END)
                open_ = classes[ids[1:]] > ALONE
                held.append(ids[:-1][open_] << 16 | ids[1:][open_])
                size += len(held[-1])
                if size >= COUNTED:
                    yield counted()
                    held, size = [], 0
        if held:
            yield counted()

    return run


def _whole_counts(classes: np.ndarray):
    """Counts of (id before, class) from counts of pairs."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            names, at = np.unique(_wholes_of(batch.column(0).to_numpy(), classes), return_inverse=True)
            yield pa.RecordBatch.from_arrays([pa.array(names, pa.int64()), pa.array(np.bincount(at, batch.column(1).to_numpy(), len(names)).astype(np.int64))], names=["whole", "n"])

    return run


def _pair_tables(coded: DataFrame, classes: np.ndarray) -> tuple[tuple[np.ndarray, ...], DataFrame]:
    """Tables for ``inside_logs`` with the most frequent pairs, at most HOT_PAIRS of them by a count threshold, and the other pairs (pair, n)."""
    pairs = settle(coded.select("ids").mapInArrow(_id_pairs(classes), "pair long, n long").groupBy("pair").agg(F.sum("n").alias("n")), "lm-pairs")
    bin_of = F.floor(F.log2("n") * 8).cast("int")
    held, least = 0, None
    for r in sorted(pairs.groupBy(bin_of.alias("bin")).agg(F.count("*").alias("k")).collect(), key=lambda r: -r["bin"]):
        if held + r["k"] > HOT_PAIRS:
            break
        held, least = held + r["k"], r["bin"]
    hot = pairs.where(bin_of >= least if least is not None else F.lit(False)).toArrow()
    # (as many rows as the vocabulary has ids, times the few classes with several ids, at most)
    wholes = pairs.mapInArrow(_whole_counts(classes), "whole long, n long").groupBy("whole").agg(F.sum("n").alias("n")).toArrow()
    tables = pairs_inside(*(hot.column(c).to_numpy() for c in ("pair", "n")), classes, tuple(wholes.column(c).to_numpy() for c in ("whole", "n")))
    return tables, pairs if least is None else pairs.where(bin_of < least)


def windows_of(code: bytes, classes: np.ndarray, round_no: int) -> tuple[np.ndarray, np.ndarray]:
    """The round's windows of a document's ids, rows of WINDOW + 1 classes, and how many of each count. Consecutive windows share a class, the context of
    the second; they take turns in the rounds, from a round that the ids' hash gives. Each id, the end included, follows in one window of one round."""
    own = classes[np.append(_ids_of(code), END)]
    count = -(-len(own) // WINDOW)
    full = np.full(count * WINDOW + 1, BEGIN, np.int64)
    full[1 : len(own) + 1] = own
    number = np.arange((round_no - xxhash.xxh3_64_intdigest(code)) % ROUNDS, count, ROUNDS)
    return full[number[:, None] * WINDOW + np.arange(WINDOW + 1)], np.minimum(WINDOW, len(own) - number * WINDOW) + 1


_ROWS = pa.schema([("key", pa.int64()), ("part", pa.int32()), ("windows", pa.binary()), ("lengths", pa.binary())])


def _windowed(classes: np.ndarray, round_no: int):
    """The round's windows of documents (doc_id, ids), with the hash that places them."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for lo in range(0, batch.num_rows, 200):
                rows = []
                part = batch.slice(lo, 200)
                for doc_id, code in zip(part.column(0).to_pylist(), part.column(1), strict=True):
                    code = code.as_buffer().to_pybytes()
                    windows, lengths = windows_of(code, classes, round_no)
                    key = xxhash.xxh3_64_intdigest(code, seed=(doc_id or 0) & 0xFFFF_FFFF) - (1 << 63)
                    for k in range(0, len(lengths), ROW_WINDOWS):
                        rows.append((key, k // ROW_WINDOWS, windows[k : k + ROW_WINDOWS].astype("<u2").tobytes(), lengths[k : k + ROW_WINDOWS].astype("u1").tobytes()))
                columns = list(zip(*rows, strict=True)) or [[]] * 4
                yield pa.RecordBatch.from_arrays([pa.array(c, t.type) for c, t in zip(columns, _ROWS, strict=True)], schema=_ROWS)

    return run


def _windows(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """All windows of rows (key, part, windows, lengths), at most TAUGHT at a time, wherever the batches end."""
    held, size = [], 0
    for batch in batches:
        for windows, lengths in zip(batch.column(2), batch.column(3), strict=True):
            # two bytes a class until they are used
            rows = np.frombuffer(windows.as_buffer().to_pybytes(), "<u2").reshape(-1, WINDOW + 1)
            held.append((rows, np.frombuffer(lengths.as_buffer().to_pybytes(), "u1")))
            size += len(rows)
            if size >= TAUGHT:
                rows, lengths = (np.concatenate(c) for c in zip(*held, strict=True))
                for lo in range(0, size - TAUGHT + 1, TAUGHT):
                    yield rows[lo : lo + TAUGHT], lengths[lo : lo + TAUGHT]
                rest = size - size % TAUGHT
                held, size = [(rows[rest:], lengths[rest:])], size % TAUGHT
    if size:
        rows, lengths = (np.concatenate(c) for c in zip(*held, strict=True))
        yield rows, lengths


def _trained(coded: DataFrame, classes: np.ndarray, prior: tuple, weights: dict[str, np.ndarray], round_no: int, replicas: int, ids: int) -> dict[str, np.ndarray]:
    """Replicas trained on the round's windows of all documents ``coded`` (doc_id, ids; ``ids`` in all), averaged by their numbers of windows."""
    expected = -(-ids // (WINDOW * ROUNDS * replicas))
    shared = coded.sparkSession.sparkContext.broadcast((prior, weights))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        before, start = shared.value
        learner, used = Learner(start, before, expected, 11 + round_no), 0
        for rows, lengths in _windows(batches):
            learner.learn(rows, lengths)
            used += len(rows)
        if used:
            values = flat(learner.w).astype(np.float64)
            yield pa.RecordBatch.from_arrays([pa.array([used], pa.int64()), pa.array([values], pa.list_(pa.float64()))], names=["n", "w"])

    windows = coded.mapInArrow(_windowed(classes, round_no), "key long, part int, windows binary, lengths binary")
    dealt = windows.repartition(replicas, "key").sortWithinPartitions("key", "part", "windows")
    parts = dealt.mapInArrow(run, "n long, w array<double>").select("n", F.posexplode("w").alias("at", "value"))
    mean = parts.groupBy("at").agg((F.sum(F.col("n") * F.col("value")) / F.sum("n")).alias("value")).collect()
    return unflat(np.array([r["value"] for r in sorted(mean, key=lambda r: r["at"])])) if mean else weights


# --- scores ------------------------------------------------------------------------------------------------------


def text_scores(weights: dict[str, np.ndarray], prior: tuple, classes: np.ndarray, inside: np.ndarray, texts: list[np.ndarray], at_once: int = 1024, tables: tuple | None = None) -> np.ndarray:
    """log10 probabilities of id sequences, each with its end; without ``tables`` ids in a class do not depend on the id before."""
    lengths = np.fromiter(map(len, texts), np.int64, len(texts))
    ids = np.concatenate(texts)
    starts = np.cumsum(lengths) - lengths
    own = classes[ids]
    before = np.concatenate(([BEGIN], own[:-1]))
    before[starts] = BEGIN
    per_text = np.maximum(1, -(-np.maximum(lengths - WINDOW, 0) // STRIDE) + 1)
    owner = np.repeat(np.arange(len(texts)), per_text)
    number = np.arange(len(owner)) - np.repeat(np.cumsum(per_text) - per_text, per_text)
    first = number * STRIDE
    out = np.add.reduceat(inside[ids] if tables is None else inside_logs(ids, starts, classes, inside, tables), starts)
    span = np.arange(WINDOW)
    total = np.zeros(len(texts))
    for skip, chosen in ((0, first == 0), (WINDOW - STRIDE, first > 0)):
        who, base = owner[chosen], first[chosen]
        for lo in range(0, len(who), at_once):
            whom = who[lo : lo + at_once]
            place = base[lo : lo + at_once, None] + span
            last = lengths[whom][:, None] - 1
            at = np.minimum(place, last) + starts[whom][:, None]
            keep = (place[:, skip:] <= last).ravel()
            logs = class_log_probs(weights, prior, before[at], own[at], keep, skip)
            total += np.bincount(np.repeat(whom, WINDOW - skip)[keep], logs, len(texts))
    return out + total / math.log(10)


_SCORED = pa.schema([("row", pa.int64()), ("doc_id", pa.int64()), ("n_tokens", pa.int64()), ("n_known", pa.int64()), ("hot_sum", pa.float64()), ("rare", pa.list_(pa.binary())), ("rare_pairs", _RARE_PAIRS), ("score", pa.float64())])
_SCORED_DDL = "row long, doc_id long, n_tokens long, n_known long, hot_sum double, rare array<binary>, rare_pairs array<struct<pair: long, times: long, weight: double>>, score double"


def scored(docs: DataFrame, tokenizer_path: str) -> DataFrame:
    """doc_id, held_out, n_tokens, n_known, train_tokens, base_score and score for each row of ``docs`` (doc_id, text)."""
    spark = docs.sparkSession
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    held = crc32_of_id("doc_id") % FOLDS == HELD
    flagged = rows.select("doc_id", "text", held.alias("held"))
    gathered = settle(flagged.mapInArrow(_gather(tokenizer_path), _COUNTS_DDL), "lm-gathered")
    words = settle(gathered.where(F.col("kind") == _WORD).groupBy("word").agg(F.sum("n").alias("c")), "lm-words")
    bin_of = F.floor(F.log2("c") * 8).cast("int")
    bins = sorted(words.groupBy(bin_of.alias("bin")).agg(F.count("*").alias("k"), F.sum("c").alias("n")).collect(), key=lambda r: -r["bin"])
    ids = _id_counts(gathered.where(F.col("kind") == _ID).select("id", "n"))
    classes = classes_of(ids)
    inside = inside_classes(ids, classes)
    coded = gathered.where((F.col("kind") == _TEXT) & ~(crc32_of_id("n") % FOLDS == HELD)).select(F.col("n").alias("doc_id"), "ids")
    pairs = np.zeros(CLASSES * CLASSES, np.int64)  # (at most as many rows come to the driver)
    for batch in coded.select("ids").mapInArrow(_class_pairs(classes), "id int, n long").groupBy("id").agg(F.sum("n").alias("n")).toArrow().to_batches():
        pairs[batch.column("id").to_numpy()] = batch.column("n").to_numpy()
    prior = prior_of(pairs)
    ends = int(ids[END])
    total = sum(r["n"] for r in bins) + ends
    distinct = sum(r["k"] for r in bins) + (ends > 0)
    # words from this count on are at most HOT_WORDS
    least, held_words = None, 0
    for r in bins:
        if held_words + r["k"] > HOT_WORDS:
            break
        held_words, least = held_words + r["k"], r["bin"]
    frequent = words.where(bin_of >= least) if least is not None else words.limit(0)
    hot = {bytes(r["word"]): math.log10(r["c"] + 1) for r in frequent.toLocalIterator(prefetchPartitions=True)}
    weights = first_weights()
    replicas = max(1, round(int(ids.sum()) / REPLICA_IDS))
    for k in range(ROUNDS):
        weights = _trained(coded, classes, prior, weights, k, replicas, int(ids.sum()))
    tables, other_pairs = _pair_tables(coded, classes)
    shared = spark.sparkContext.broadcast((hot, classes, inside, tables, prior[:2], weights))
    end_log = math.log10(ends + 1)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known, own, within, paired, before, model = shared.value
        row = TaskContext.get().partitionId() << 33
        get = known.get
        for batch in batches:
            for lo in range(0, batch.num_rows, 200):
                part = batch.slice(lo, 200)
                texts = [v.as_buffer().to_pybytes() for v in part.column(1)]
                tokens, hots, totals, rares = [], [], [], []
                for text in texts:
                    split = words_of(text)
                    values = list(map(get, split))
                    rare = [w for w, v in zip(split, values, strict=True) if v is None] if None in values else []
                    tokens.append(len(split) + 1)
                    hots.append(len(split) - len(rare) + (ends > 0))
                    totals.append(math.fsum(v for v in values if v is not None) + end_log)
                    rares.append(rare)
                coded = [np.append(_ids_of(v.as_buffer().to_pybytes()), END) for v in part.column(2)]
                scores = text_scores(model, before, own, within, coded, tables=paired)
                columns = [np.arange(row, row + len(texts)), part.column(0), tokens, hots, totals, rares, rare_pairs(coded, own, within, paired), scores]
                row += len(texts)
                yield pa.RecordBatch.from_arrays([c if isinstance(c, pa.Array) else pa.array(c, t.type) for c, t in zip(columns, _SCORED, strict=True)], schema=_SCORED)

    texts = gathered.where(F.col("kind") == _TEXT).select(F.col("n").alias("doc_id"), "text", "ids")
    first = settle(texts.mapInArrow(run, _SCORED_DDL), "lm-scored")
    others = words if least is None else words.where(bin_of < least)
    counts = others.select("word", F.log10(F.col("c") + 1).alias("value"))
    rare = first.select("row", F.explode("rare").alias("word")).join(counts, "word").select("row", "value", F.lit(0.0).alias("added"), F.lit(1).alias("word"))
    paired = first.select("row", F.inline("rare_pairs")).join(other_pairs, "pair")
    paired = paired.select("row", F.lit(0.0).alias("value"), (F.col("times") * F.log10(1 + F.col("n") / F.col("weight"))).alias("added"), F.lit(0).alias("word"))
    sums_of = rare.unionAll(paired).groupBy("row").agg(F.sum("value").alias("rare_sum"), F.sum("word").alias("rare_known"), F.sum("added").alias("added"))
    out = first.drop("rare", "rare_pairs").join(sums_of, "row", "left")
    floor = F.lit(math.log10(total + distinct + 1))
    return out.select(
        "doc_id",
        (crc32_of_id("doc_id") % FOLDS == HELD).alias("held_out"),
        "n_tokens",
        (F.col("n_known") + F.coalesce("rare_known", F.lit(0))).alias("n_known"),
        F.lit(total).cast("long").alias("train_tokens"),
        (F.col("hot_sum") + F.coalesce("rare_sum", F.lit(0.0)) - F.col("n_tokens") * floor).alias("base_score"),
        (F.col("score") + F.coalesce("added", F.lit(0.0))).alias("score"),
    )


def op10(spark: SparkSession, sf_dir: str, tokenizer_path: str | None = None) -> DataFrame:
    import public_tokenizers

    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text")
    return scored(docs, tokenizer_path or public_tokenizers.path("word_bpe_49k.json"))

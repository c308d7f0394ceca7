"""The training-data operators against brute force, and on nulls, empty and long texts, ties, repeated rows, empty tables and clashing columns."""

from __future__ import annotations

import base64
import hashlib
import io
import math
import re
import zlib
from collections import Counter

import numpy as np
import regex
import public_tokenizers
import pyarrow as pa
import pytest
import tiktoken
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from genoframe.llm import attention_lm, jaccard_join, merge_replay, order_minhash, pii, rule_quality, sharding, telephony, temperature_mix, token_files

DATA = "/root/testdata/sf0.001"
SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"


@pytest.fixture(scope="module")
def docs(spark):
    return spark.read.parquet(f"{DATA}/documents.parquet").toPandas().sort_values("doc_id").reset_index(drop=True)


@pytest.fixture(scope="module")
def odd(spark):
    long = " ".join(f"w{k % 977}x{k}" for k in range(30_000))
    rows = [(1, None, None, None, None), (2, "", "en", "a", 0), (3, "one", "en", "a", 3), (4, "one", "en", "b", 3), (4, "one", "en", "b", 3), (5, long, "en", "a", 1), (6, "\U0001f600 a\tb　c 'S", "fr", None, 9), (7, "1 " * 20_000, "en", "a", 1), (8, "9" * 50_000 + " " + "a" * 50_000 + "@", "en", "a", 1), (None, "no id here at all you see", "en", "a", 1)]
    return spark.createDataFrame(rows, SCHEMA)


@pytest.fixture(scope="module")
def nothing(spark):
    return spark.createDataFrame([], SCHEMA)


# --- 7


def _sets(texts):
    out = []
    for t in texts:
        w = (t or "").encode().lower().split()
        out.append(frozenset(tuple(w[k : k + 5]) for k in range(len(w) - 4)) if len(w) >= 5 else frozenset([tuple(w)] if w else []))
    return out


def _components(ids, sets):
    root = {i: i for i in ids}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for i, a in zip(ids, sets, strict=True):
        for j, b in zip(ids, sets, strict=True):
            if i < j and a and b and 100 * len(a & b) >= 80 * len(a | b):
                x, y = find(i), find(j)
                root[max(x, y)] = min(x, y)
    return {i: find(i) for i in ids}


def test_jaccard_against_brute_force(spark, docs):
    got = jaccard_join.op7(spark, DATA).toPandas().set_index("doc_id")
    sets = _sets(docs.text)
    expected = _components(docs.doc_id.tolist(), sets)
    assert got.component_id.to_dict() == expected
    assert got.n_shingles.to_dict() == dict(zip(docs.doc_id, map(len, sets), strict=True))


def test_jaccard_families_of_edited_copies(spark):
    random = np.random.default_rng(2)
    base = [f"t{k}" for k in range(200)]
    rows = []
    for i in range(120):
        words = list(base)
        for _ in range(int(random.integers(0, 8))):
            words[int(random.integers(0, 200))] = f"e{int(random.integers(0, 40))}"
        rows.append((i, " ".join(words), None, None, 0))
    got = jaccard_join.near_duplicates(spark.createDataFrame(rows, SCHEMA)).toPandas().set_index("doc_id")
    assert got.component_id.to_dict() == _components(list(range(120)), _sets([r[1] for r in rows]))


def test_jaccard_shingle_numbers():
    """Sets of numbered shingles are the sets of word tuples, short texts and repeats included."""
    random = np.random.default_rng(4)
    texts = [" ".join(random.choice(["a", "B", "c"], int(n))).encode() for n in random.integers(0, 30, 60)] + [b"", b"a b", b"A  b", b"a b c d", b"a b c d e"]
    sets, got = _sets([t.decode() for t in texts]), jaccard_join._numbered(texts)
    for i in range(len(texts)):
        for j in range(len(texts)):
            assert len(np.intersect1d(got[i], got[j])) == len(sets[i] & sets[j])
    short = jaccard_join._numbered([b"a b", b"a  B", b"b a", b""])
    assert short[0].tolist() == short[1].tolist() != short[2].tolist() and len(short[3]) == 0


def test_jaccard_sql(spark):
    """The oracle's SQL gives the same rows on the larger of the small tables."""
    import duckdb

    from genoframe.llm import queries

    con = duckdb.connect()
    con.execute("create view documents as select * from '/root/testdata/sf0.01/documents.parquet'")
    expected = con.execute(queries.oracle_sql()["op7_ngram_jaccard_join"]).fetchall()
    got = jaccard_join.op7(spark, "/root/testdata/sf0.01").select("doc_id", "n_shingles", "component_id").collect()
    assert sorted(map(tuple, got)) == sorted(expected)


def test_jaccard_many_partitions(spark, docs):
    """The same components with 211 shuffle partitions, and where shortened codes run into each other."""
    before = spark.conf.get("spark.sql.shuffle.partitions")
    expected = _components(docs.doc_id.tolist(), _sets(docs.text))
    spark.conf.set("spark.sql.shuffle.partitions", "211")
    try:
        got = jaccard_join.op7(spark, DATA).toPandas().set_index("doc_id")
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", before)
    assert got.component_id.to_dict() == expected


def test_jaccard_odd_rows(odd, nothing):
    got = sorted(map(tuple, jaccard_join.near_duplicates(odd.withColumn("n", F.lit(1)).withColumn("cls", F.lit(2))).collect()), key=str)
    by = {}
    for doc_id, n, component in got:
        by.setdefault(doc_id, []).append((n, component))
    assert by[1] == [(0, 1)] and by[2] == [(0, 2)] and by[3] == [(1, 3)] and by[4] == [(1, 3), (1, 3)]
    assert by[7] == [(1, 7)] and by[None][0][1] is None
    assert jaccard_join.near_duplicates(nothing).count() == 0


# --- 1

PLAIN = {"email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", "ip": r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)", "card": r"[0-9]([\x20-]?[0-9])+", "phone": r"\+[0-9][\x20().0-9-]+[0-9]"}


def _luhn(digits):
    return sum(sum(divmod(int(c) * (1 + k % 2), 10)) for k, c in enumerate(reversed(digits))) % 10 == 0


def _base(text):
    spans = []
    for rank, (kind, pattern) in enumerate(PLAIN.items()):
        for m in re.finditer(pattern, text or ""):
            digits = re.sub("[^0-9]", "", m.group())
            keep = {"email": True, "ip": kind == "ip" and all(int(x) <= 255 for x in m.group().split(".")), "card": 12 <= len(digits) <= 19 and _luhn(digits), "phone": 9 <= len(digits) <= 15}[kind]
            if keep:
                spans.append((m.start(), rank, f"{kind}:{m.start()}:{m.end()}"))
    return ",".join(s[2] for s in sorted(spans))


def test_pii_base_on_documents(spark, docs):
    got = pii.op1(spark, DATA).toPandas().set_index("doc_id")
    for doc_id, text in zip(docs.doc_id, docs.text, strict=True):
        assert got.base_sha256[doc_id] == hashlib.sha256(_base(text).encode()).hexdigest()


TRICKY = [
    "a@b.c.d@e.f g@h.i_j@k.l x@y", "1.2.3.4.5.6.7.8 256.1.1.1 001.002.003.004 999999999999.1.1.1", "4111 1111 1111 1111 4111-1111-1111-1112 4111  1111 1111 1111 41111111111111111111111111",
    "+1 (984) 555-5227 ++12 345 678 90 +1 2", "\U0001f600 a.b@c-d.e 10.0.0.1", "GB82 WEST 1234 5698 7654 32, GB82 WEST 1234 5698 7654 33", "social security 123-45-6789 and 123-45-6789 far from any word that would help it to score well", 'token = "24be64439e3e49cf46b2d7c90f3602a3d0b907ff"', None, "",
]


def test_pii_tricky_texts(spark):
    df = spark.createDataFrame(list(enumerate(TRICKY)), "doc_id long, text string")
    got = {r.doc_id: r.spans for r in pii.with_spans(df).select("doc_id", pii._text_of(F.filter("spans", lambda s: s["rank"] < 4)).alias("spans")).collect()}
    assert got == {k: _base(t) for k, t in enumerate(TRICKY)}
    every = {r.doc_id: [(pii.KINDS[s["rank"]], s["match"]) for s in r.spans] for r in pii.with_spans(df).collect()}
    assert ("iban", "GB82 WEST 1234 5698 7654 32") in every[5] and len(every[5]) == 1
    assert sum(kind == "ssn" for kind, _ in every[6]) == 1 or every[6][0][0] == "ssn"
    assert [kind for kind, _ in every[7]] == ["secret"]


def test_pii_redact_and_long_texts(odd, nothing, spark):
    df = spark.createDataFrame([(1, "mail a.b@c.de or 10.0.0.1!", 5), (2, None, 6)], "doc_id long, text string, spans int")
    assert [tuple(r) for r in pii.redact(df).orderBy("doc_id").collect()] == [(1, "mail <EMAIL> or <IP>!", 5), (2, None, 6)]
    assert pii.redact(odd).count() == 10
    assert pii.redact(nothing).count() == 0


# --- 2


def test_shards(spark, docs, odd, nothing):
    got = sharding.op2(spark, DATA).toPandas()
    assert len(got) == len(docs) and set(got["shard"]) == set(range(8))
    sizes = got.groupby("shard")["size"].sum()
    assert sizes.max() - sizes.min() <= 2 * got["size"].max() and sizes.max() < 1.1 * sizes.mean()
    for _, part in got.groupby("shard"):
        assert sorted(part["slot"]) == list(range(len(part)))
    text = dict(zip(docs.doc_id, docs.text, strict=True))
    assert all(s == len(text[i].encode()) + 1 and c == zlib.crc32(text[i].encode()) for i, s, c in zip(got.doc_id, got["size"], got.text_crc32, strict=True))
    assert sharding.kd_shards(odd, 8).count() == 10
    assert sharding.kd_shards(nothing, 8).count() == 0
    same = spark.createDataFrame([(k, "same text", "en", "hot", 9) for k in range(800)], SCHEMA)
    counts = sharding.kd_shards(same, 8).groupBy("shard").count().toPandas()["count"]
    assert counts.min() >= 99 and counts.max() <= 101
    assert sharding.kd_shards(same, target_bytes=2100).select("shard").distinct().count() == 4
    for wrong in ({}, {"shards": 6}, {"shards": 8, "target_bytes": 10}):
        with pytest.raises(ValueError):
            sharding.kd_shards(same, **wrong)


@pytest.mark.parametrize("how", [{"shards": 8}, {"target_bytes": 6_000}])
def test_tree_by_hand(spark, odd, how):
    """The same leaves as a tree that is split node by node; leaves stop one by one when they hold the target, or can't be split any more."""
    for docs in (spark.read.parquet(f"{DATA}/documents.parquet").select("doc_id", "text", "lang", "source"), odd):
        rows = sharding.metadata(docs).toPandas()
        dims = [f"d{k}" for k in range(4)]
        spread = [max(1, int(rows[d].max()) - int(rows[d].min())) for d in dims]

        def grow(part, depth):
            lo, hi = [int(part[d].min()) for d in dims], [int(part[d].max()) for d in dims]  # noqa: B023
            wide = [(b - a) / s for a, b, s in zip(lo, hi, spread, strict=True)]  # noqa: B023
            k = max(range(4), key=lambda i: (wide[i], -i))
            if depth == 3 if "shards" in how else part["size"].sum() <= how["target_bytes"] or hi[k] == lo[k]:
                return [part]
            sums = part.groupby(dims[k])["size"].sum().sort_index()
            half, upto = part["size"].sum() / 2, sums.cumsum()
            at = upto.index[int(np.argmax((upto >= half).to_numpy()))]
            before = upto[at] - sums[at]
            cut = at if upto[at] - half <= half - before else at - 1
            return [leaf for side in (part[part[dims[k]] <= cut], part[part[dims[k]] > cut]) if len(side) for leaf in grow(side, depth + 1)]

        expected = [sorted(zip(leaf.doc_id.fillna(-1), leaf.text_crc32, strict=True)) for leaf in grow(rows, 0)]
        got = sharding.kd_shards(docs, **how).toPandas()
        assert [sorted(zip(leaf.doc_id.fillna(-1), leaf.text_crc32, strict=True)) for _, leaf in got.groupby("shard")] == expected
        for _, leaf in got.groupby("shard"):
            assert sorted(leaf.slot) == list(range(len(leaf)))


def test_many_leaves(spark):
    """Every leaf holds the target bytes at most, or a single document."""
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    got = sharding.kd_shards(docs.select("doc_id", "text", "lang", "source"), target_bytes=20_000).toPandas()
    sizes = got.groupby("shard")["size"].agg(["sum", "count"])
    assert len(got) == docs.count() and len(sizes) > 100 and sizes.index.tolist() == list(range(len(sizes)))
    assert ((sizes["sum"] <= 20_000) | (sizes["count"] == 1)).all()


# --- 3


def test_token_files(spark, docs):
    got = token_files.op3(spark, DATA).toPandas().set_index("doc_id")
    tokenizer, at = Tokenizer.from_file(public_tokenizers.path("word_bpe_49k.json")), 0
    for doc_id, text in zip(docs.doc_id, docs.text, strict=True):
        ids = [*tokenizer.encode(text, add_special_tokens=False).ids, 1]
        assert (got.start[doc_id], got.n_tokens[doc_id], got.ids_crc32[doc_id]) == (at, len(ids), zlib.crc32(np.array(ids, "<u4").tobytes()))
        at += len(ids)


def test_token_encoder_words():
    own = token_files.Encoder(public_tokenizers.path("word_bpe_49k.json"), 2, None)
    plain = Tokenizer.from_file(public_tokenizers.path("word_bpe_49k.json"))
    for text in ("", "Don't stop, it's 42.", "É́ ÇA va bien", "a<|endoftext|>b <|x", "\U0001f600\U0001f600", "ΑΣ ΣΑΣ", "Ḱ ́x", "a\1b \1 \1\1c", "\u0301a \u0308 e\u0301"):
        assert np.frombuffer(own.encode([text.encode()])[0], "<u2").tolist() == plain.encode(text, add_special_tokens=False).ids


def test_token_file_format_and_damage():
    out = io.BytesIO()
    writer = token_files.Writer(out, 2)
    random = np.random.default_rng(0)
    wanted = [random.integers(0, 60_000, n).astype("<u2").tobytes() for n in (0, 5, 70_000, 3, 140_000, 1)]
    for k, ids in enumerate(wanted):
        writer.add(k if k else None, ids)
    writer.close()
    reader = token_files.Reader(io.BytesIO(out.getvalue()))
    assert [reader.read(k) for k in (4, 1, 0, 2, 3, 5)] == [wanted[k] for k in (4, 1, 0, 2, 3, 5)]
    assert reader.find(3) == [3] and len(reader.frames) >= 2
    broken = bytearray(out.getvalue())
    broken[100] ^= 255
    with pytest.raises(Exception):  # noqa: B017, PT011  (zstandard's checksum or the table's)
        token_files.Reader(io.BytesIO(bytes(broken))).read(2)


def test_token_files_odd(odd, nothing, spark, tmp_path):
    path = public_tokenizers.path("word_bpe_49k.json")
    back = token_files.read_files(token_files.write_files(odd, f"file://{tmp_path}/a", path))
    assert sorted(str(r.doc_id) for r in back.collect()) == sorted(map(str, [None, 1, 2, 3, 4, 4, 5, 6, 7, 8]))
    assert token_files.read_files(token_files.write_files(nothing, f"file://{tmp_path}/b", path)).count() == 0


def test_token_files_start_anew(spark, docs, tmp_path):
    """A range of many ids goes to several files; starts and ids stay those of one file each."""
    path = public_tokenizers.path("word_bpe_49k.json")
    some = spark.createDataFrame(docs[["doc_id", "text"]].head(90)).repartition(3)
    whole = sorted(map(tuple, token_files.placed(token_files.write_files(some, f"file://{tmp_path}/a", path)).collect()))
    for name, limits in (("b", {"file_docs": 4}), ("c", {"file_bytes": 3000})):
        files = token_files.write_files(some, f"file://{tmp_path}/{name}", path, **limits)
        listed = files.toPandas()
        assert listed["number"].max() >= 2 and not listed.duplicated(["part", "number"]).any() and listed["docs"].sum() == 90
        assert (listed["docs"] <= 4).all() if name == "b" else (listed[listed["ids"] * 2 < 3000].groupby("part").size() <= 1).all()
        assert sorted(map(tuple, token_files.placed(files).collect())) == whole


def test_token_starts_of_repeated_ids(spark, tmp_path):
    """Null and repeated ids that fill several files: the starts leave no gap and follow the ids, in each of two runs alike."""
    rows = [(None, f"no id {k} {k % 7}") for k in range(400)] + [(5, f"five {k}") for k in range(400)] + [(7, f"seven of {k}") for k in range(30)] + [(7, "same"), (7, "same")]
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(5)
    found = []
    for run in range(2):
        files = token_files.write_files(docs, f"file://{tmp_path}/{run}", public_tokenizers.path("word_bpe_49k.json"))
        assert files.where("least < 0").count() >= 2 and files.count() >= 3
        got = sorted(map(tuple, token_files.placed(files).collect()), key=lambda r: r[1])
        assert [r[1] for r in got] == [0, *np.cumsum([r[2] for r in got])[:-1].tolist()]
        assert [r[0] for r in got] == [None] * 400 + [5] * 400 + [7] * 32
        found.append(got)
    assert found[0] == found[1]


# --- 4


def test_quality_held_out(spark):
    sf = "/root/testdata/sf0.01"
    got = rule_quality.op4(spark, sf).join(spark.read.parquet(f"{sf}/labels.parquet"), "doc_id").where("held_out").toPandas()
    assert (got.predicted == got.quality).mean() > 0.9
    assert got.score.between(0, 1).all()


def test_quality_odd(odd, nothing, spark):
    labels = spark.createDataFrame([(3, 1, 0), (99, 0, 0), (None, 1, 0)], "doc_id long, quality int, toxic int")
    model = rule_quality.fit(odd, labels)
    assert rule_quality.scored(odd.withColumn("x", F.lit(1)), model).where("score between 0 and 1").count() == 10
    assert rule_quality.fit(nothing, labels).score([F.lit(0.0)] * len(rule_quality.NAMES)) is not None
    assert rule_quality.scored(nothing, model).count() == 0
    assert list(rule_quality.statistics(F.lit(""))) == rule_quality.NAMES


def test_rules_match_their_columns(spark):
    random = np.random.default_rng(0)
    x = random.random((500, len(rule_quality.NAMES)))
    y = ((x[:, 2] > 0.5) & (x[:, 3] < 0.7)).astype(float)
    model = rule_quality.fit_rules(x, y)
    df = spark.createDataFrame(x.tolist(), ", ".join(f"c{k} double" for k in range(x.shape[1])))
    got = [r[0] for r in df.select(model.score([F.col(f"c{k}") for k in range(x.shape[1])])).collect()]
    eta = model.bias + sum(w * r.of(x) for r, w in model.rules)
    assert np.allclose(got, 1 / (1 + np.exp(-eta)))
    assert ((np.array(got) > 0.5) == (y > 0.5)).mean() > 0.97


def test_quality_names_and_repeats(spark):
    """Columns named like the helpers come back as they were; many rows of one id reach the fit only up to a bound."""
    rows = [(k, f"word{k} and some more words, {k}", k, k + 1, "s") for k in range(60)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, __row int, __score int, __stat_upper string")
    model = rule_quality.Model(0.0, ((rule_quality.Rule(((0, True, 0.0),)), 1.0),))
    got = rule_quality.accepted(docs, model, 0.5)
    assert got.columns == docs.columns and sorted(map(tuple, got.collect())) == rows
    assert rule_quality.scored(docs, model).columns == [*docs.columns, "score"]
    with pytest.raises(ValueError, match="score"):
        rule_quality.scored(docs.withColumn("score", F.lit(1)), model)
    one = next(k for k in range(100) if zlib.crc32(str(k).encode()) % 4 != 2)
    hot = spark.createDataFrame([(one, f"text number {k % 50}") for k in range(400)], "doc_id long, text string")
    labels = spark.createDataFrame([(one, q) for q in (0, 1) for _ in range(30)], "doc_id long, quality int")
    seen = {}
    before = rule_quality.fit_rules
    rule_quality.fit_rules = lambda x, y, seed=7: seen.setdefault("rows", len(y)) and before(x, y, seed)
    try:
        rule_quality.fit(hot, labels)
    finally:
        rule_quality.fit_rules = before
    assert seen["rows"] == 2 * rule_quality.ROWS_PER_ID


_BLANK = r"[ \t\n\x0b\f\r]"


def _statistics(text):
    """The statistics by plain regular expressions."""
    t = text or ""
    size, solid = max(len(t), 1), _BLANK.replace("[", "[^", 1)
    words, lines = max(len(re.findall(f"{solid}+", t)), 1), t.split("\n")
    share = lambda pattern, of: len(regex.findall(pattern, t)) / of
    repeats = len(regex.findall(rf"(?<!{solid})({solid}++){_BLANK}(?=\1(?!{solid}))", t))
    return [
        math.log1p(len(t)), len(t) / words, share(r"[#$%&*+=<>{}\[\]\\^~_@]", size), share(r"\|", words), share("!", words), share(r"\p{Lu}", size), share("[0-9]", size),
        share(r"[.?;:]", words), share(",", words), repeats / words, len(lines) / words, 1 - len(set(lines)) / len(lines),
    ]


def test_quality_rules_by_hand(spark, docs):
    """Scores of all documents from plain statistics, rule by rule; the rules keep few of the paths."""
    table = spark.read.parquet(f"{DATA}/documents.parquet")
    model = rule_quality.fit(table, spark.read.parquet("/root/testdata/sf0.001/labels.parquet"))
    got = rule_quality.scored(table.select("doc_id", "text"), model).toPandas().set_index("doc_id").score
    for doc_id, text in zip(docs.doc_id, docs.text, strict=True):
        x = _statistics(text)
        total = model.bias + sum(w for rule, w in model.rules if all((x[k] > bound) if above else (x[k] <= bound) for k, above, bound in rule.parts))
        assert got[doc_id] == pytest.approx(1 / (1 + math.exp(-total)), rel=1e-9)


def test_lasso_is_a_minimum():
    """No single weight can be moved to lower the penalised loss."""
    random = np.random.default_rng(3)
    z = (random.random((300, 6)) < 0.4).astype(float)
    y = (random.random(300) < 1 / (1 + np.exp(-(2 * z[:, 0] - 1.5 * z[:, 1])))).astype(float)
    bias, w = rule_quality._lasso(z, y)
    scale = np.maximum(z.std(0), 0.02)

    def loss(bias, w):
        eta = z @ w + bias
        return np.mean(np.log1p(np.exp(eta)) - y * eta) + rule_quality.LASSO * np.abs(w * scale).sum()

    for k in range(6):
        for step in (-0.02, 0.02):
            moved = w.copy()
            moved[k] += step
            assert loss(bias, moved) >= loss(bias, w) - 1e-9
    assert w[0] > 1 and w[1] < -0.7


# --- 5


def _mixed(x):
    x = (x ^ (x >> 32)) * 0x9E3779B97F4A7C15 % 2**64
    x = (x ^ (x >> 29)) * 0xD1342543DE82EF95 % 2**64
    return x ^ (x >> 32)


def _print(text):
    """Order MinHash in plain numbers, one unit after the other."""
    if not text:
        return np.zeros(order_minhash.SKETCHES, np.uint16)
    width, seen, units = min(order_minhash.K, len(text)), Counter(), []
    for k in range(len(text) - width + 1):
        value = 0
        for c in text[k : k + width]:
            value = (value * 0xD1342543DE82EF95 + ord(c) + 1) % 2**64
        unit = _mixed((value + width) % 2**64)
        number = seen[unit]
        seen[unit] += 1
        units.append(_mixed((unit + number * 0x9E3779B97F4A7C15) % 2**64) if number else unit)
    out = []
    for factor in order_minhash._FACTORS.tolist():
        least = sorted(range(len(units)), key=lambda k: ((units[k] >> 32) * factor % 2**32, k))[: order_minhash.PICKS]
        value = 7
        for k in sorted(least):
            value = _mixed((value * 0xD1342543DE82EF95 + units[k]) % 2**64)
        out.append(value >> 48)
    return np.array(out, np.uint16)


def test_fingerprints(spark, docs):
    got = order_minhash.op5(spark, DATA).toPandas().set_index("doc_id")
    texts = docs.text.tolist()
    for k, (doc_id, text) in enumerate(zip(docs.doc_id, texts, strict=True)):
        following, half = texts[(k + 1) % len(texts)], len(text) // 2
        edited = text[: len(text) - half] + following[:half]
        row = got.loc[doc_id]
        assert row.n_chars == len(text) and row.edited_sha256 == hashlib.sha256(edited.encode()).hexdigest()
        if k < 12 and len(text) < 4000:
            a, b, c = _print(text), _print(edited), _print(following)
            assert row.fingerprint == a.astype(">u2").tobytes().hex()
            assert row.near_edited == pytest.approx((a == b).mean()) and row.near_next == pytest.approx((a == c).mean())
    assert got.near_edited.mean() > got.near_next.mean() + 0.05


def test_fingerprints_feel_order_and_distance():
    words = [f"word{k}" for k in range(60)]
    prints = lambda w: order_minhash.fingerprint(np.array([ord(c) for c in " ".join(w)], np.uint32))
    base = prints(words)
    near = order_minhash.likeness(base, prints([*words[:30], "other", *words[31:]]))
    turned = order_minhash.likeness(base, prints([*words[30:], *words[:30]]))
    far = order_minhash.likeness(base, prints([f"else{k}" for k in range(60)]))
    assert near > turned > far


def test_fingerprints_odd(odd, nothing, spark):
    got = order_minhash.with_next(odd).toPandas()
    assert len(got) == 10 and got.near_next.between(0, 1).all()
    assert order_minhash.with_next(nothing).count() == 0
    assert order_minhash.with_next(odd.where("doc_id = 3")).first().near_next == 1.0


def test_fingerprints_of_hot_ids(spark):
    """One id and the null id hold most rows: each gets ranges of its own, and every row still meets the one that follows it."""
    rows = [(None, f"nobody {k}") for k in range(120)] + [(7, f"seven {k % 90}") for k in range(200)] + [(k, f"text {k}") for k in range(60)] + [(7, None), (7, "")]
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(6)
    keyed = df.selectExpr("doc_id", "coalesce(text, '') as text", "shiftrightunsigned(xxhash64(coalesce(text, '')), 1) as h").collect()
    texts = [(r.doc_id, r.text) for r in sorted(keyed, key=lambda r: (r.doc_id is not None, r.doc_id or 0, r.h, r.text))]
    expected = []
    for (doc_id, text), (_, following) in zip(texts, [*texts[1:], texts[0]], strict=True):
        edited = text[: len(text) - len(text) // 2] + following[: len(text) // 2]
        expected.append((str(doc_id), len(text), hashlib.sha256(edited.encode()).hexdigest()))
    for some in (df, df.where("doc_id is null"), df.where("doc_id = 7")):
        got = order_minhash.with_next(some)
        if some is df:
            assert sorted((str(r.doc_id), r.n_chars, r.edited_sha256) for r in got.collect()) == sorted(expected)
        assert got.count() == some.count()
    bounds, n, unknown = [1, 5, 7, 7, 7, 9], 386, 3
    cuts, widths, starts = order_minhash.slices(bounds, unknown)
    assert (cuts, widths, starts) == ([1, 5, 7, 9], [0, 0, 3, 0], [3, 4, 5, 9])
    placed = df.selectExpr("doc_id", "shiftrightunsigned(xxhash64(text), 1) as hash").withColumn("range", order_minhash._range_of(bounds, unknown))
    by = {}
    for r in placed.collect():
        by.setdefault(r.range, set()).add(r.doc_id)
    assert {k for k, v in by.items() if v == {None}} == {0, 1, 2} and {k for k, v in by.items() if v == {7}} == {6, 7, 8}
    assert by[3] == {0, 1} and by[5] == {6} and by[9] == {8, 9} and by[10] == set(range(10, 60))


# --- 6


def test_media(spark, docs, odd):
    got = telephony.op6(spark, DATA).toPandas().set_index("doc_id")
    for doc_id, text in zip(docs.doc_id, docs.text, strict=True):
        data = text.encode()
        padded = data + b"\0" * (-len(data) % 64 or (64 if not data else 0))
        row = got.loc[doc_id]
        assert (row.n_bytes, row.payload_bytes, row.payload_sha256, row.tail_crc32) == (len(data), len(padded), hashlib.sha256(padded).hexdigest(), zlib.crc32(padded[-64:]))
    assert telephony.with_pcm(telephony.with_media(odd)).where("length(pcm) > 44").count() == 10


def test_codecs():
    assert telephony.MU_TABLE[0xFF] == 0 and telephony.MU_TABLE[0x00] == -32124 and telephony.MU_TABLE[0x80] == 32124
    assert telephony.A_TABLE[0xD5] == 8 and telephony.A_TABLE[0x2A] == -32256
    assert np.array_equal(telephony.expand(telephony.compress_mu_law(telephony.MU_TABLE)), telephony.MU_TABLE)
    random = np.random.default_rng(1)
    data = random.integers(0, 256, 64 * 7).astype(np.uint8)
    expected = []
    for block in data.reshape(-1, 64):  # one sample after the other, by the format's description
        value, index = int(block[:2].copy().view("<i2")[0]), min(int(block[2]), 88)
        expected.append(value)
        for byte in block[4:]:
            for code in (int(byte) & 15, int(byte) >> 4):
                step = int(telephony.STEPS[index])
                change = step >> 3
                change += step if code & 4 else 0
                change += step >> 1 if code & 2 else 0
                change += step >> 2 if code & 1 else 0
                value = max(-32768, min(32767, value - change if code & 8 else value + change))
                index = max(0, min(88, index + int(telephony.INDEX_CHANGES[code & 7])))
                expected.append(value)
    assert telephony.decode_adpcm(data).tolist() == expected
    assert telephony.resample(np.array([0, 10, -10], np.int16), 8000, 16000).tolist() == [0, 5, 10, 0, -10, -10]
    with pytest.raises(ValueError, match="WAVE"):
        telephony.read_wave(b"nothing")


# --- 8


def test_byte_bpe(spark, docs):
    ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, open(public_tokenizers.path("byte_bpe_multi_50k.tiktoken"), "rb"))}
    plain = tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})
    got = merge_replay.op8(spark, DATA).toPandas().set_index("doc_id")
    for doc_id, text in zip(docs.doc_id, docs.text, strict=True):
        ids = plain.encode_ordinary(text)
        assert got.n_tokens[doc_id] == len(ids)
        assert got.ids_sha256[doc_id] == hashlib.sha256(",".join(map(str, ids)).encode()).hexdigest()
        assert got.decoded_sha256[doc_id] == hashlib.sha256(text.encode()).hexdigest()
    own = merge_replay.vocabulary(*merge_replay._default(None, None))
    random = np.random.default_rng(4)
    texts = ["".join(random.choice(list("aaabbxyzé \n\t0123!'s"), int(random.integers(0, 60)))) for _ in range(1500)] + ["a" * 3000, "", "漢字\U0001f600 　" * 30]
    assert own.encode(texts) == [plain.encode_ordinary(t) for t in texts]
    assert all(own.decode(i) == t.encode() for i, t in zip(own.encode(texts), texts, strict=True))


def test_byte_bpe_odd(odd, nothing):
    assert merge_replay.with_ids(odd).where("doc_id = 1").first().ids == []
    assert merge_replay.with_ids(nothing).count() == 0
    with pytest.raises(ValueError, match="ids"):
        merge_replay.with_ids(odd.withColumn("ids", F.lit(1)))


# --- 9


def test_mixing_weights_and_budget(spark):
    rows = [(k, "w " * (1 + k % 5), "en", f"s{min(k // 40, 3)}", 1) for k in range(400)]
    df = spark.createDataFrame(rows, SCHEMA)
    got = temperature_mix.mixed(df, target=0.97, most_repeats=4).toPandas()
    shares = got.groupby("source").mix_tokens.sum() / got.mix_tokens.sum()
    weights = got.groupby("source").mix_weight.first()
    assert np.allclose(shares, weights, atol=0.02) and weights.sum() == pytest.approx(1)
    assert set(got.doc_id) == set(range(400))
    assert -(weights * np.log(weights)).sum() >= 0.97 * math.log(4) - 0.01 or got.mix_block.max() == 3
    for _, part in got.groupby("source"):
        passes = part.groupby("doc_id").size()
        assert passes.max() - passes.min() <= 1
    small = temperature_mix.mixed(df, target=0.0, most_repeats=100, budget=500.0).toPandas()
    assert 400 <= small.mix_tokens.sum() <= 500


def test_mixing_odd(odd, nothing):
    got = temperature_mix.mixed(odd).toPandas()
    assert len(got[got.mix_block == 0]) == 10
    assert temperature_mix.mixed(nothing).count() == 0
    with pytest.raises(ValueError, match="mix_block"):
        temperature_mix.mixed(odd.withColumn("mix_block", F.lit(1)))


def test_mix_names(spark):
    """Columns named like the helpers come back as they were."""
    rows = [(k, f"text {k}", f"s{k % 3}", k, "x", k + 1) for k in range(30)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, source string, __key int, __source string, __s int")
    got = temperature_mix.mixed(docs)
    assert got.columns[:6] == docs.columns
    assert {tuple(r)[:6] for r in got.collect()} == set(rows)


def test_pii_names(spark):
    docs = spark.createDataFrame([(1, "a.b@c.de", 5)], "doc_id long, text string, SPANS int")
    with pytest.raises(ValueError, match="spans"):
        pii.with_spans(docs)


def test_merge_replay_long_texts(spark):
    """A text of many pieces goes through several replays, with the same ids."""
    words = merge_replay.Vocabulary(*merge_replay._default(None, None))
    text = " ".join(f"w{k}x" for k in range(500))
    whole = words.encode([text])
    before = merge_replay.PIECES
    merge_replay.PIECES = 37
    try:
        assert merge_replay.Vocabulary(*merge_replay._default(None, None)).encode([text, "", text]) == [*whole, [], *whole]
    finally:
        merge_replay.PIECES = before


def test_merge_replay_at_once(monkeypatch):
    """Places that are merged at once give the ids of places merged one by one, also where a piece has several or ends there; pieces are kept with decimals and bytes."""
    ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, open(public_tokenizers.path("byte_bpe_multi_50k.tiktoken"), "rb"))}
    plain = tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})
    random = np.random.default_rng(6)
    texts = ["".join(random.choice(list("aaabnthe é\n\x1c\x85漢's"), int(random.integers(0, 60)))) for _ in range(3000)] + ["ana" * 500, "\u3000", ""]
    for many in (1, 5, 1 << 60):
        monkeypatch.setattr(merge_replay, "MANY", many)
        words = merge_replay.Vocabulary(*merge_replay._default(None, None))
        for lo in range(0, len(texts), 600):
            some = texts[lo : lo + 600]
            wanted = [plain.encode_ordinary(t) for t in some]
            assert words.encode(some) == wanted
            for text, ids, pieces in zip(some, wanted, words.split(some), strict=True):
                assert ",".join(words.decimals[p] for p in pieces) == ",".join(map(str, ids))
                assert b"".join(words.decoded[p] for p in pieces) == text.encode()
    assert words.replay([]) == []


def test_places_in_blocks(spark, docs, odd):
    """Places of a source's block run from 0 without gaps, blocks differ in their order, and the last block is a begin of its order."""
    for table, budget in ((spark.read.parquet(f"{DATA}/documents.parquet"), None), (odd, None), (spark.read.parquet(f"{DATA}/documents.parquet"), 30_000.0)):
        got = temperature_mix.mixed(table, place=True, budget=budget).toPandas()
        plain = temperature_mix.mixed(table, budget=budget).toPandas()
        columns = ["doc_id", "source", "mix_tokens", "mix_block"]
        assert sorted(map(repr, got[columns].itertuples(index=False))) == sorted(map(repr, plain[columns].itertuples(index=False)))
        for _, block in got.groupby(["source", "mix_block"], dropna=False):
            assert sorted(block.mix_place) == list(range(len(block)))
    again = temperature_mix.mixed(spark.read.parquet(f"{DATA}/documents.parquet").repartition(7), place=True).toPandas().sort_values(["mix_block", "doc_id"])
    got = temperature_mix.mixed(spark.read.parquet(f"{DATA}/documents.parquet"), place=True).toPandas().sort_values(["mix_block", "doc_id"])
    assert got.mix_place.tolist() == again.mix_place.tolist()
    some = got[got.source == got.source.mode()[0]]
    orders = [b.sort_values("mix_place").doc_id.tolist() for _, b in some.groupby("mix_block")]
    assert all(o != sorted(o) for o in orders) and len({tuple(o) for o in orders}) == len(orders)
    for b, order in enumerate(orders):
        key = {r.doc_id: r.key for r in docs_key(spark).collect()}
        hashed = spark.createDataFrame([(d, b, key[d]) for d in order], "doc_id long, b int, key long").select("doc_id", F.xxhash64("b", "key").alias("h")).toPandas()
        assert hashed.h.is_unique


def docs_key(spark):
    return spark.read.parquet(f"{DATA}/documents.parquet").select("doc_id", F.xxhash64("doc_id", "text").alias("key"))


def test_names_are_compared_as_spark_does(spark):
    """Columns that differ by spelling only from what is added, or from the text column."""
    df = spark.createDataFrame([(1, "a text", "x")], "doc_id long, TEXT string, ids string")
    with pytest.raises(ValueError):
        merge_replay.with_ids(df, out="IDS")
    with pytest.raises(ValueError):
        telephony.with_media(df.withColumnRenamed("ids", "MEDIA"))
    got = telephony.with_pcm(telephony.with_media(merge_replay.with_ids(df, out="tokens"))).first()
    assert got.ids == "x" and len(got.tokens) == 2 and telephony.read_payload(got.media)[:6] == b"a text" and got.pcm[:4] == b"RIFF"
    with pytest.raises(ValueError):
        telephony.with_pcm(telephony.with_media(df).withColumn("PCM", F.lit(1)))


def test_mix_by_hand(spark, docs):
    """The exponent by plain bisection, and the last block of each source document by document."""
    table = spark.read.parquet(f"{DATA}/documents.parquet").select("doc_id", "text", "source")
    rows = table.select("*", F.xxhash64("doc_id", "text").alias("key")).toPandas()
    rows["tokens"] = [max(len(re.findall(r"[^ \t\n\x0b\f\r]+", t or "")), 1) for t in rows.text]
    sums = rows.groupby("source", dropna=False).tokens.sum()
    share = (sums / sums.sum()).to_numpy()

    def weights(a):
        return share**a / (share**a).sum()

    def bisected(holds, lo=0.0, hi=1.0):
        for _ in range(60):
            lo, hi = ((lo + hi) / 2, hi) if holds((lo + hi) / 2) else (lo, (lo + hi) / 2)
        return lo

    entropy = lambda a: -(weights(a) * np.log(weights(a))).sum()
    passes = lambda a: (share ** (a - 1)).max() / (share ** (a - 1)).min()
    exponent = max(bisected(lambda a: entropy(a) >= temperature_mix.TARGET * math.log(len(share))), bisected(lambda a: passes(a) > temperature_mix.MOST_REPEATS))
    got = temperature_mix.mixed(table).toPandas()
    weight = got.groupby("source", dropna=False).mix_weight.first()
    assert weight.reindex(sums.index).to_numpy() == pytest.approx(weights(exponent), rel=2e-5)
    taken = Counter(zip(got.doc_id, got.text, strict=True))
    # from here with the operator's own weights, so that rounding of the exponent does not matter
    own = weight.reindex(sums.index)
    budget = (sums / own).max()
    for source, part in rows.groupby("source", dropna=False):
        owed = own[source] * budget
        full = math.floor(owed / part.tokens.sum() + 1e-9)
        rest = max(owed - full * part.tokens.sum(), 0.0)
        buckets = -(-len(part) // temperature_mix.BUCKET_DOCS)
        keys = spark.createDataFrame([(int(k),) for k in part.key], "key long").select("key", F.xxhash64(F.lit(full), "key").alias("turn")).collect()
        turn = {r.key: r.turn for r in keys}
        place = lambda k: ((turn[k] % 2**64 >> 20) % buckets, turn[k])  # noqa: B023, E731
        upto, whole = 0, rest > 0.5 and rest >= part.tokens.sum() - 1e-6
        for r in sorted(part.itertuples(), key=lambda r: place(r.key)):
            upto += r.tokens
            assert taken[r.doc_id, r.text] == full + (whole or upto <= rest), (source, r.doc_id)


# --- 10


def test_language_model(spark, docs):
    got = attention_lm.op10(spark, DATA).toPandas().set_index("doc_id")
    held = {i: zlib.crc32(str(i).encode()) % 7 == 2 for i in docs.doc_id}
    counts = Counter()
    for i, t in zip(docs.doc_id, docs.text, strict=True):
        if not held[i]:
            counts.update([*t.encode().lower().split(), None])
    total, kinds = sum(counts.values()), len(counts)
    for i, t in zip(docs.doc_id, docs.text, strict=True):
        words = [*t.encode().lower().split(), None]
        row = got.loc[i]
        assert row.base_score == pytest.approx(sum(math.log10((counts[w] + 1) / (total + kinds + 1)) for w in words), rel=1e-9)
        assert (row.held_out, row.n_tokens, row.n_known, row.train_tokens) == (held[i], len(words), sum(counts[w] > 0 for w in words), total)
    assert (got.score < 0).all()


def test_attention_scores_once_and_causally():
    random = np.random.default_rng(0)
    counts = random.integers(0, 50, 1 << 16)
    classes = attention_lm.classes_of(counts)
    inside = attention_lm.inside_classes(counts, classes)
    for c in range(1, attention_lm.CLASSES):
        assert (10 ** inside[classes == c]).sum() == pytest.approx(1)
    weights = {k: v + random.normal(0, 0.1, v.shape).astype(np.float32) for k, v in attention_lm.first_weights().items()}
    pairs = random.integers(0, 3, attention_lm.CLASSES**2)
    prior = attention_lm.prior_of(pairs)
    text = random.integers(0, 1 << 16, 61)
    whole = attention_lm.text_scores(weights, prior, classes, inside, [text, text[:7]])
    assert whole[1] == pytest.approx(attention_lm.text_scores(weights, prior, classes, inside, [text[:7]])[0], rel=1e-6)
    # by hand: each place once, with the window that covers it
    own = classes[text]
    before = np.concatenate(([0], own[:-1]))
    total = inside[text].sum()
    for place in range(len(text)):
        start = 0 if place < attention_lm.WINDOW else (place - attention_lm.WINDOW) // attention_lm.STRIDE * attention_lm.STRIDE + attention_lm.STRIDE
        x = np.zeros((1, attention_lm.WINDOW), np.int64)
        piece = before[start : place + 1]
        x[0, : len(piece)] = piece
        f = attention_lm._forward(weights, x)["f"][0, place - start]
        g, m, b = own[place] % 32, own[place] // 32, before[place]
        for logits, at in ((f @ weights["out"] + weights["bias"] + prior[0][b], g), (f @ weights["inner"][g] + weights["inner_bias"][g] + prior[1][b, g], m)):
            total += (logits[at] - np.log(np.exp(logits - logits.max()).sum()) - logits.max()) / math.log(10)
    assert whole[0] == pytest.approx(total, rel=1e-5)


def test_training_gradients():
    random = np.random.default_rng(1)
    weights = {k: (v + random.normal(0, 0.3, v.shape)).astype(np.float64) for k, v in attention_lm.first_weights().items()}
    prior = tuple(p.astype(np.float64) for p in attention_lm.prior_of(np.ones(attention_lm.CLASSES**2)))
    x, y = random.integers(0, attention_lm.CLASSES, (3, attention_lm.WINDOW)), random.integers(1, attention_lm.CLASSES, (3, attention_lm.WINDOW))
    scored = np.ones(x.shape, bool)

    def loss(w):
        return -attention_lm.class_log_probs(w, prior, x, y, np.ones(x.size, bool), 0).mean()

    got = attention_lm._gradients(weights, prior, x, y, scored)
    for name in ("query", "value", "mix", "up", "place", "out", "inner"):
        at = tuple(random.integers(0, n) for n in weights[name].shape)
        if name == "inner":
            at = (int(y[0, 0] % 32), 3, int(y[0, 0] // 32))
        up, down = ({k: v.copy() for k, v in weights.items()} for _ in range(2))
        up[name][at] += 1e-3
        down[name][at] -= 1e-3
        assert got[name][at] == pytest.approx((loss(up) - loss(down)) / 2e-3, rel=0.05, abs=2e-5)


def test_softmax_of_rows_far_from_one():
    """Sums are taken without a shift where they keep to the type's range, and with each row's largest where they do not."""
    random = np.random.default_rng(2)
    own = np.arange(5) * 32 + random.integers(0, 32, 5)
    for shift in (0.0, -300.0, 300.0, np.array([[0.0], [-300.0], [300.0], [-60.0], [60.0]])):
        logits = (random.normal(-3, 2, (5, 32)) + shift).astype(np.float32)
        exact = logits.astype(np.float64)
        exact -= exact.max(1)[:, None]
        exact -= np.log(np.exp(exact).sum(1))[:, None]
        assert attention_lm._log_softmax_at(logits, own) == pytest.approx(exact.ravel()[own], abs=1e-4)
        found, sums, _ = attention_lm._exponentials(logits)
        assert found / sums[:, None] == pytest.approx(np.exp(exact), abs=1e-4)
    assert len(attention_lm._log_softmax_at(np.empty((0, 32), np.float32), np.empty(0, np.int64))) == 0


def test_learning_is_adam_on_the_gradients():
    """Steps over joint arrays are those of each array of weights; priors lie row by row, so that none is copied to be looked up in."""
    random = np.random.default_rng(4)
    prior = attention_lm.prior_of(random.integers(0, 4, attention_lm.CLASSES**2))
    assert all(p.flags.c_contiguous for p in prior)
    weights = {k: v + random.normal(0, 0.2, v.shape).astype(np.float32) for k, v in attention_lm.first_weights().items()}
    windows, lengths = random.integers(1, 40, (50, attention_lm.WINDOW + 1)).astype("<u2"), random.integers(2, attention_lm.WINDOW + 2, 50).astype("u1")
    assert all((v == weights[k]).all() and v.shape == weights[k].shape for k, v in attention_lm.Learner(weights, prior, 50, 7).w.items())
    learner = attention_lm.Learner(weights, prior, 50, 7)
    learner.learn(windows, lengths)
    order, own = np.random.default_rng(7), {k: v.astype(np.float64) for k, v in weights.items()}
    one, two = ({k: np.zeros(v.shape) for k, v in own.items()} for _ in range(2))
    for step in range(1, attention_lm.EPOCHS + 1):
        rows = order.permutation(50)
        x, y = windows[rows, :-1].astype(int), windows[rows, 1:].astype(int)
        scored = np.arange(attention_lm.WINDOW) < lengths[rows, None].astype(int) - 1
        for k, g in attention_lm._gradients(own, prior, x, y, scored, True).items():
            one[k] += 0.1 * (g - one[k])
            two[k] += 0.01 * (g * g - two[k])
            rate = attention_lm.RATE * (1 - 0.9 * step / attention_lm.EPOCHS)
            own[k] -= rate * (one[k] / (1 - 0.9**step)) / (np.sqrt(two[k] / (1 - 0.99**step)) + 1e-6)
    for k, v in learner.w.items():
        assert np.quantile(np.abs(v - own[k]), 0.99) < 1e-3, k
    assert any((v != weights[k]).any() for k, v in learner.w.items())


def test_steps_grow_with_the_windows_of_a_replica():
    """Few windows keep small steps; many make larger ones, so that a step's fixed cost falls on more ids. Each window is in EPOCHS steps either way."""
    weights, prior = attention_lm.first_weights(), attention_lm.prior_of(np.ones(attention_lm.CLASSES**2))
    for windows, batch in ((1, 128), (28_000, 128), (90_000, 187), (125_000, 256), (10_000_000, 256)):
        learner = attention_lm.Learner(weights, prior, windows, 7)
        assert (learner.batch, learner.steps) == (batch, attention_lm.EPOCHS * -(-windows // batch))
        assert learner.rate == pytest.approx(attention_lm.RATE * math.sqrt(batch / 128))


@pytest.mark.parametrize("windows", [1, 20, 700])
def test_groups_in_chunks(windows):
    """Each place has one row, in a chunk of its group; products over chunks are those of each place with its own group's weights, however uneven the groups are."""
    random = np.random.default_rng(windows)
    kind, d, n = attention_lm.GROUPS, attention_lm.WIDTH, windows * attention_lm.WINDOW
    x, y = ((random.random((windows, attention_lm.WINDOW)) ** 6 * (attention_lm.CLASSES - 1)).astype(int) + 1 for _ in range(2))
    group, member = y.ravel() % kind, y.ravel() // kind
    places, rows, chunk_group = attention_lm._by_group(group)
    assert (places[rows] == np.arange(n)).all() and len(places) % len(chunk_group) == 0 and len(places) < 2 * n + kind * attention_lm.CHUNK
    assert (np.repeat(chunk_group, len(places) // len(chunk_group))[rows] == group).all()
    weights = {k: (v + random.normal(0, 0.3, v.shape)).astype(np.float64) for k, v in attention_lm.first_weights().items()}
    prior = tuple(p.astype(np.float64) for p in attention_lm.prior_of(random.integers(0, 3, attention_lm.CLASSES**2)))
    f = attention_lm._forward(weights, x)["f"].reshape(n, d)
    expected, shares = np.zeros(n), np.zeros((kind, d, kind))
    for logits, own, inner in (
        (f @ weights["out"] + weights["bias"] + prior[0][x.ravel()], group, False),
        (np.einsum("nd,ndk->nk", f, weights["inner"][group]) + weights["inner_bias"][group] + prior[1][x.ravel(), group], member, True),
    ):
        p = np.exp(logits - logits.max(1)[:, None])
        p /= p.sum(1)[:, None]
        expected += np.log(p[np.arange(n), own])
        if inner:
            p[np.arange(n), own] -= 1
            np.add.at(shares, group, f[:, :, None] * p[:, None] / n)
    assert np.allclose(attention_lm.class_log_probs(weights, prior, x, y, np.ones(n, bool), 0), expected)
    assert np.allclose(attention_lm._gradients(weights, prior, x, y, np.ones(x.shape, bool))["inner"], shares)


def test_training_leaves_the_own_occurrence_out():
    """With ``left_out`` the gradients are those under priors counted without the place that is learnt."""
    random = np.random.default_rng(8)
    n = attention_lm.CLASSES
    pairs = np.zeros(n * n, np.int64)
    x, y = random.integers(0, 40, (1, attention_lm.WINDOW)), random.integers(1, 40, (1, attention_lm.WINDOW))
    np.add.at(pairs, x.ravel() * n + y.ravel(), random.integers(1, 4, x.size))
    weights = {k: v + random.normal(0, 0.1, v.shape) for k, v in attention_lm.first_weights().items()}
    prior = tuple(p.astype(np.float64) for p in attention_lm.prior_of(pairs))
    got = attention_lm._gradients(weights, prior, x, y, np.ones(x.shape, bool), True)
    f = attention_lm._forward(weights, x)["f"][0]
    bias = np.zeros(attention_lm.GROUPS)
    alone = (pairs.reshape(n, attention_lm.GROUPS, attention_lm.GROUPS).sum(0).T + 0.5).sum(1)
    for place in range(x.size):
        b, c = x[0, place], y[0, place]
        counts = pairs.reshape(n, n)[b].reshape(attention_lm.GROUPS, attention_lm.GROUPS).T.astype(float)
        counts[c % 32, c // 32] -= 1
        by_group = counts.sum(1) + 20.0 * alone / alone.sum()
        logits = f[place] @ weights["out"] + weights["bias"] + np.log(by_group)
        p = np.exp(logits - logits.max())
        p /= p.sum()
        p[c % 32] -= 1
        bias += p / x.size
    assert np.allclose(got["bias"], bias, atol=1e-5)


def test_ids_inside_classes_given_the_id_before():
    """Probabilities of all ids of a class sum to one after any id, and are counts smoothed by those of the id alone."""
    random = np.random.default_rng(3)
    counts = random.integers(0, 50, 1 << 16)
    classes = attention_lm.classes_of(counts)
    inside = attention_lm.inside_classes(counts, classes)
    lumped = int(classes.max())
    members = np.flatnonzero(classes == lumped)
    pairs = np.concatenate((7 << 16 | members[:3], 9 << 16 | members[2:4], [7 << 16 | int(np.flatnonzero(classes == lumped - 1)[0])]))
    tables = attention_lm.pairs_inside(random.permutation(pairs), np.ones(len(pairs), np.int64) * 2, classes)
    for before in (7, 9, 11):
        text = np.ravel([[before, m] for m in members])
        logs = attention_lm.inside_logs(text, np.arange(0, len(text), 2), classes, inside, tables)
        assert (10 ** logs[1::2]).sum() == pytest.approx(1) and np.allclose(logs[::2], inside[before])
        q = 10 ** inside[members[2]]
        seen, total = {7: (2, 6), 9: (2, 4), 11: (0, 0)}[before]
        assert 10 ** logs[5] == pytest.approx((seen + attention_lm.PAIR_SMOOTH * q) / (total + attention_lm.PAIR_SMOOTH))
    starts = np.array([0, 1])
    assert np.allclose(attention_lm.inside_logs(np.array([7, members[0]]), starts, classes, inside, tables), inside[[7, members[0]]])


@pytest.mark.parametrize("hot", [0, 40, 1 << 18])
def test_pairs_of_ids_beyond_the_frequent_ones_count_too(spark, docs, monkeypatch, hot):
    """Scores are those with the counts of all pairs, however few of them go to every task (here under first weights)."""
    path = public_tokenizers.path("word_bpe_49k.json")
    monkeypatch.setattr(attention_lm, "ROUNDS", 0)
    monkeypatch.setattr(attention_lm, "HOT_PAIRS", hot)
    got = attention_lm.op10(spark, DATA).toPandas().set_index("doc_id").score
    tokenizer = Tokenizer.from_file(path)
    texts = [np.array([e + 1 for e in tokenizer.encode(t or "", add_special_tokens=False).ids] + [0]) for t in docs.text]
    taught = [x for i, x in zip(docs.doc_id, texts, strict=True) if zlib.crc32(str(i).encode()) % 7 != 2]
    counts = np.bincount(np.concatenate(taught), minlength=1 << 16)
    classes = attention_lm.classes_of(counts)
    after = np.bincount(np.concatenate([np.concatenate(([attention_lm.BEGIN], classes[x[:-1]])) * attention_lm.CLASSES + classes[x] for x in taught]), minlength=attention_lm.CLASSES**2)
    pairs, n = np.unique(np.concatenate([x[:-1] << 16 | x[1:] for x in taught]), return_counts=True)
    shared = classes[pairs & 0xFFFF] > attention_lm.ALONE
    assert shared.sum() > 100
    tables = attention_lm.pairs_inside(pairs[shared], n[shared], classes)
    inside = attention_lm.inside_classes(counts, classes)
    expected = attention_lm.text_scores(attention_lm.first_weights(), attention_lm.prior_of(after), classes, inside, texts, tables=tables)
    assert got.loc[docs.doc_id].to_numpy() == pytest.approx(expected, rel=1e-6, abs=1e-4)


def test_held_out_score_is_better_than_the_base(spark):
    """On the larger of the small tables; both are log10 probabilities of the same texts."""
    got = attention_lm.op10(spark, "/root/testdata/sf0.01").where("held_out").agg(F.sum("score").alias("score"), F.sum("base_score").alias("base"), F.sum("n_tokens").alias("n")).first()
    print(got.score / got.n, got.base / got.n)
    assert got.score / got.n > got.base / got.n + 0.01


def test_language_model_odd(odd, nothing):
    path = public_tokenizers.path("word_bpe_49k.json")
    got = attention_lm.scored(odd, path).toPandas()
    assert len(got) == 10 and np.isfinite(got.score).all() and np.isfinite(got.base_score).all()
    assert attention_lm.scored(nothing, path).count() == 0


def test_every_id_is_learnt_once():
    random = np.random.default_rng(2)
    classes = random.permutation(1 << 16)
    texts = [random.integers(0, 49_000, n).astype("<u2").tobytes() for n in (0, 1, 14, 15, 16, 17, 400, 200_000)]
    batches = [pa.RecordBatch.from_arrays([pa.array([k] * 4, pa.int64()), pa.array(texts[k::2], pa.binary())], names=["doc_id", "ids"]) for k in range(2)]
    found = Counter()
    for k in range(attention_lm.ROUNDS):
        for rows, lengths in attention_lm._windows(attention_lm._windowed(classes, k)(iter(batches))):
            assert 0 < len(rows) <= attention_lm.TAUGHT
            for row, n in zip(rows, lengths, strict=True):
                found.update(zip(row[: n - 1].tolist(), row[1:n].tolist(), strict=True))
    expected = Counter()
    for t in texts:
        own = classes[np.append(np.frombuffer(t, "<u2").astype(int) + 1, 0)].tolist()
        expected.update(zip([attention_lm.BEGIN, *own[:-1]], own, strict=True))
    assert found == expected


def test_classes_follow_the_counts_of_all_training_documents(spark, monkeypatch):
    path = public_tokenizers.path("word_bpe_49k.json")
    rows = [(k, " ".join(f"{w}{k % 3}" for w in words)) for k, words in enumerate([["alpha"] * 40, ["beta", "gamma"] * 30, ["delta"] * 20, ["beta"] * 50, ["omega", "alpha"] * 10])]
    texts = [t.encode() for i, t in rows if zlib.crc32(str(i).encode()) % 7 != 2]
    expected = np.zeros(1 << 16, np.int64)
    for code in token_files.encoder(path, 2, None).encode(texts):
        expected += np.bincount(np.append(np.frombuffer(code, "<u2").astype(int) + 1, 0), minlength=1 << 16)
    given, classes_of = [], attention_lm.classes_of
    monkeypatch.setattr(attention_lm, "classes_of", lambda counts: classes_of(given.append(counts.copy()) or counts))
    attention_lm.scored(spark.createDataFrame(rows, "doc_id long, text string"), path)
    assert len(given) == 1 and (given[0] == expected).all() and expected.sum() > 0


def test_scores_do_not_depend_on_partitions(spark, docs):
    """The same rows in one and in seven partitions: replicas learn from the same documents in the same order."""
    path, found = public_tokenizers.path("word_bpe_49k.json"), []
    rows = spark.read.parquet(f"{DATA}/documents.parquet").select("doc_id", "text")
    for parts in (1, 7):
        found.append(attention_lm.scored(rows.repartition(parts), path).toPandas().set_index("doc_id").score)
    assert np.allclose(found[0], found[1].loc[found[0].index], rtol=1e-5)

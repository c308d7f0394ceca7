"""The corpus pipeline on small tables: what each stage keeps, and the registration."""

from __future__ import annotations

import corpus_pipeline
import __spark_entry__
import pytest
from pyspark.sql import functions as F

DATA = "/root/testdata/sf0.001"


def test_stages(spark):
    docs = spark.read.parquet(f"{DATA}/documents.parquet")
    columns, found = docs.columns, {}
    for name, stage in corpus_pipeline.STAGES:
        docs = stage(spark, docs, DATA).checkpoint()
        found[name] = docs.toPandas()
        if name != "encode":
            assert docs.columns == columns
    assert len(found["quality"]) < 200
    assert found["near_duplicates"].doc_id.is_unique
    assert set(found["near_duplicates"].doc_id) <= set(found["quality"].doc_id)
    assert not found["personal_data"].text.str.contains(r"[\w.]+@[\w-]+\.\w+").any()
    assert set(found["mix"].doc_id) == set(found["personal_data"].doc_id)
    assert (found["encode"].n_tokens == found["encode"].ids.map(len)).all()


def test_clean_documents_stay(spark):
    docs, labels = spark.read.parquet("/root/testdata/sf0.01/documents.parquet"), spark.read.parquet("/root/testdata/sf0.01/labels.parquet")
    kept = corpus_pipeline.quality(spark, docs, "/root/testdata/sf0.01").select("doc_id", F.lit(1).alias("kept"))
    clean = labels.where("quality = 1").join(kept, "doc_id", "left").agg(F.avg(F.coalesce("kept", F.lit(0)))).first()[0]
    bad = labels.where("quality = 0").join(kept, "doc_id", "left").agg(F.avg(F.coalesce("kept", F.lit(0)))).first()[0]
    assert clean > 0.97 and bad < 0.3


def test_registered():
    found = __spark_entry__.queries()
    assert "pipeline" in found
    for n in range(1, 11):
        assert sum(name.startswith(f"op{n}_") for name in found) == 1


@pytest.mark.parametrize("stage", [s for s, _ in corpus_pipeline.STAGES])
def test_empty_tables(spark, stage):
    empty = spark.createDataFrame([], "doc_id long, text string, lang string, source string, n_chars long")
    assert dict(corpus_pipeline.STAGES)[stage](spark, empty, DATA).count() == 0


def test_near_duplicates_by_row(spark):
    one, two = (" ".join(f"{w}{k}" for k in range(40)) for w in "ab")
    rows = [(7, one), (7, one), (7, one), (3, two), (9, two), (9, one), (None, one), (None, one), (5, "other words that stand alone here"), (6, None), (6, ""), (None, "no id but words of its own"), (None, "no id but words of its own")]
    docs = spark.createDataFrame([(i, t, "en", "a", len(t or "")) for i, t in rows], "doc_id long, text string, lang string, source string, n_chars long")
    kept = corpus_pipeline.near_duplicates(spark, docs, DATA)
    assert kept.columns == docs.columns
    expected = [(7, one), (3, two), (5, rows[8][1]), (6, None), (6, ""), (None, rows[11][1])]
    assert sorted(((r.doc_id, r.text) for r in kept.collect()), key=str) == sorted(expected, key=str)


def test_stages_by_hand(spark):
    """Rejected rows by their score, one row of each component, redaction by the spans, ids as tiktoken gives them."""
    import public_tokenizers
    import tiktoken
    from tiktoken.load import load_tiktoken_bpe

    from genoframe.llm import pii, rule_quality
    from test_operators import _components, _sets

    docs = spark.read.parquet(f"{DATA}/documents.parquet")
    model = rule_quality.fit(docs, spark.read.parquet(f"{DATA}/labels.parquet"))
    scores = rule_quality.scored(docs, model).toPandas().set_index("doc_id").score
    kept = corpus_pipeline.quality(spark, docs, DATA).checkpoint()
    ids = sorted(r.doc_id for r in kept.select("doc_id").collect())
    assert ids == sorted(scores.index[scores >= corpus_pipeline.LEAST_QUALITY])
    text = kept.toPandas().set_index("doc_id").text
    component = _components(ids, _sets([text[i] for i in ids]))
    single = corpus_pipeline.near_duplicates(spark, kept, DATA).checkpoint()
    assert sorted(r.doc_id for r in single.select("doc_id").collect()) == sorted(set(component.values()))
    spans = {r.doc_id: r.spans for r in pii.with_spans(single).select("doc_id", "spans").collect()}
    clean = corpus_pipeline.personal_data(spark, single, DATA).checkpoint()
    for row in clean.collect():
        out, at = [], 0
        for s in spans[row.doc_id]:
            if s["start"] >= at:
                out += [text[row.doc_id][at : s["start"]], f"<{pii.KINDS[s['rank']].upper()}>"]
            at = max(at, s["end"])
        assert row.text == "".join(out) + text[row.doc_id][at:] and row.n_chars == len(row.text)
    coded = tiktoken.Encoding("x", pat_str=public_tokenizers.PATTERN, mergeable_ranks=load_tiktoken_bpe(public_tokenizers.path("byte_bpe_multi_50k.tiktoken")), special_tokens={})
    plain = {r.doc_id: r.text for r in clean.collect()}
    for row in corpus_pipeline.encode(spark, clean, DATA).collect():
        assert list(row.ids) == coded.encode_ordinary(plain[row.doc_id]) and row.n_tokens == len(row.ids)


@pytest.mark.parametrize("stage", [s for s, _ in corpus_pipeline.STAGES])
def test_odd_rows(spark, stage):
    """Nulls in any column, repeated rows, empty and long texts, columns named like the helpers."""
    long = " ".join(f"w{k % 977}x{k}" for k in range(20_000))
    rows = [(1, None, None, None, None), (2, "", "en", "a", 0), (2, "", "en", "a", 0), (4, "one two three four five six", "en", "b", 3), (4, "one two three four five six", "en", "b", 3), (5, long, "en", "a", 1), (None, "no id, mail a.b@c.de", None, "a", 1)]
    docs = spark.createDataFrame([(*r, k, "s", 0.5) for k, r in enumerate(rows)], "doc_id long, text string, lang string, source string, n_chars long, __row int, __s string, __score double")
    out = dict(corpus_pipeline.STAGES)[stage](spark, docs, DATA)
    found = out.collect()
    if stage == "encode":
        assert len(found) == len(rows)
        return
    assert out.columns == docs.columns
    assert {r["__row"] for r in found} <= set(range(len(rows)))
    if stage == "near_duplicates":
        assert sorted(r["__row"] for r in found) in ([0, 1, 2, 3, 5, 6], [0, 1, 2, 4, 5, 6])
    if stage in ("personal_data", "mix"):
        assert {r["__row"] for r in found} == set(range(len(rows)))

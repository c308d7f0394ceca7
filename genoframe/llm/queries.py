"""Registered queries of the training-data operators."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from genoframe.llm import attention_lm, jaccard_join, merge_replay, metric_trees, order_minhash, pii, rule_quality, sharding, sign_hashing, telephony, temperature_mix, token_files, whitening


def pipeline(spark: SparkSession, sf_dir: str) -> DataFrame:
    import corpus_pipeline

    return corpus_pipeline.run(spark, sf_dir)


QUERIES = {
    "op1_pii": pii.op1,
    "op2_kd_sharding": sharding.op2,
    "op3_token_files": token_files.op3,
    "op4_rule_quality": rule_quality.op4,
    "op5_order_minhash": order_minhash.op5,
    "op6_telephony_media": telephony.op6,
    "op7_ngram_jaccard_join": jaccard_join.op7,
    "op8_byte_bpe": merge_replay.op8,
    "op9_temperature_mix": temperature_mix.op9,
    "op10_attention_lm": attention_lm.op10,
    "op11_whitening": whitening.op11,
    "op12_metric_tree_codes": metric_trees.op12,
    "op13_sign_hash_duplicates": sign_hashing.op13,
    "pipeline": pipeline,
}
#: Words and shingles as text, links from counts of common shingles, components by rounds of least labels (far more than a chain of links needs here).
_WORDS = r"regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+')"
_ROUNDS = 12
_OP7 = (
    f"""with w as materialized (select doc_id, {_WORDS} as w from documents),
 s as materialized (select distinct doc_id, unnest(case when len(w) >= 5 then [array_to_string(w[i : i + 4], chr(10)) for i in range(1, len(w) - 3)] when len(w) > 0 then [array_to_string(w, chr(10))] else [] end) as g from w),
 n as materialized (select doc_id, count(g) as n from w left join s using (doc_id) group by 1),
 c as (select a.doc_id as a, b.doc_id as b, count(*) as k from s a join s b on a.g = b.g and a.doc_id < b.doc_id group by 1, 2),
 l as materialized (select a, b from c join n x on x.doc_id = a join n y on y.doc_id = b where 100 * k >= 80 * (x.n + y.n - k)),
 e as materialized (select a, b from l union all select b, a from l), r0 as materialized (select doc_id, doc_id as root from n)"""
    + "".join(f", r{k + 1} as materialized (select r.doc_id, least(r.root, coalesce(min(o.root), r.root)) as root from r{k} r left join e on e.a = r.doc_id left join r{k} o on o.doc_id = e.b group by r.doc_id, r.root)" for k in range(_ROUNDS))
    + f" select doc_id, n as n_shingles, root as component_id from r{_ROUNDS} join n using (doc_id)"
)
_SOUND = "embedding is not null and len(embedding) > 0 and len(list_filter(embedding, lambda c: c is null or not isfinite(c))) = 0"
#: Six rounds of assignments and floored means, each over all entries.
_NEAREST = "select x.vec_id, x.part, c.entry, sum((x.v - c.v) * (x.v - c.v))::bigint as d from x join c{k} c using (part, pos) group by 1, 2, 3"
_OP12 = (
    f"""with k as materialized (select vec_id, label, embedding::double[] as e from embeddings where {_SOUND}),
 x as materialized (select vec_id, (i - 1) // (len(e) // 8) as part, (i - 1) % (len(e) // 8) as pos, floor(4096 * e[i])::bigint as v from (select vec_id, e, unnest(range(1, len(e) + 1)) as i from k)),
 f as (select vec_id, row_number() over (order by vec_id) - 1 as entry from k qualify entry < 16),
 c0 as materialized (select part, entry, pos, v from x join f using (vec_id))"""
    + "".join(
        f""", o{k} as materialized (select vec_id, part, min(d * 16 + entry) % 16 as entry from ({_NEAREST.format(k=k)}) group by 1, 2),
 c{k + 1} as materialized (select c.part, c.entry, c.pos, coalesce((m.s - ((m.s % m.n) + m.n) % m.n) // m.n, c.v)::bigint as v from c{k} c
 left join (select part, entry, pos, sum(v)::bigint as s, count(*) as n from x join o{k} using (vec_id, part) group by 1, 2, 3) m using (part, entry, pos))"""
        for k in range(6)
    )
    + f""", o as materialized (select vec_id, part, min(d * 16 + entry) as t from ({_NEAREST.format(k=6)}) group by 1, 2),
 r as materialized (select vec_id, label, string_agg(printf('%02x', t % 16), '' order by part) as code, sum(t // 16)::bigint as error from o join k using (vec_id) group by 1, 2)
 select vec_id, code, error, sum(error) over (partition by label)::bigint as label_error, (select sha256(string_agg(v::varchar, ',' order by part, entry, pos)) from c6) as codebooks_sha256 from r"""
)
_OP13 = (
    f"""with k as materialized (select vec_id, embedding::double[] as e from embeddings where {_SOUND} and len(list_filter(embedding, lambda c: c <> 0)) > 0),
 e as materialized (select a.vec_id as a, b.vec_id as b from k a join k b on a.vec_id <> b.vec_id where list_cosine_similarity(a.e, b.e) >= 0.9),
 r0 as materialized (select vec_id, vec_id as root from embeddings)"""
    + "".join(f", r{k + 1} as materialized (select r.vec_id, least(r.root, coalesce(min(o.root), r.root)) as root from r{k} r left join e on e.a = r.vec_id left join r{k} o on o.vec_id = e.b group by r.vec_id, r.root)" for k in range(_ROUNDS))
    + f" select vec_id, (select count(*) from e where a = vec_id) as n_links, root as component_id, vec_id = root as kept from r{_ROUNDS}"
)
ORACLES: dict[str, str] = {"op7_ngram_jaccard_join": _OP7, "op12_metric_tree_codes": _OP12, "op13_sign_hash_duplicates": _OP13}


def queries() -> dict:
    return dict(QUERIES)


def oracle_sql() -> dict[str, str]:
    return dict(ORACLES)

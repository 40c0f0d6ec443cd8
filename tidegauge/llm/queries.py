"""The queries of the operators over the given tables, and their SQL where SQL can say it."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import mixing, negatives, packing, phrases, pii, postings, quality, secrets, simhash, token_output, vectors, warc
from .common import table


def vocabulary(name: str) -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


def op1_embedding_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return vectors.near_duplicates(table(spark, sf_dir, "embeddings"), 0.9, with_recall=True).drop("audited")


def op2_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return secrets.report(table(spark, sf_dir, "documents"))


def op3_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.rates(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op4_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack(table(spark, sf_dir, "documents"), vocabulary("word_bpe_49k.json"), 4096)


def op5_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pii.report(table(spark, sf_dir, "documents"))


def op6_exact_topk(spark: SparkSession, sf_dir: str) -> DataFrame:
    return vectors.exact_top(table(spark, sf_dir, "embeddings"), 50, 5, 256.0)


def op7_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.scored(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"), 0.3)


def op8_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    folder, _ = warc.write_archives(table(spark, sf_dir, "pages"))
    return warc.read_archives(spark, folder, with_payload=False).drop("url")


def op9_token_output(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_output.token_index(table(spark, sf_dir, "documents"), vocabulary("byte_bpe_50k.json"))


def op10_simhash_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = simhash.groups(table(spark, sf_dir, "documents"), words=3, radius=3)
    return out.select("doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id")


def op11_collocations(spark: SparkSession, sf_dir: str) -> DataFrame:
    return phrases.collocations(table(spark, sf_dir, "documents"), 2000, 30)


def op12_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = postings.contamination(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"), 10)
    ids = F.array_join(F.array_sort(F.transform("item_ids", lambda i: i.cast("string"))), ",")
    return out.select("doc_id", "n_words", "n_hit", F.size("item_ids").cast("long").alias("n_items"), F.sha2(ids, 256).alias("items_sha256"), "contaminated")


def op13_hard_negatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    label = F.when(F.pmod("vec_id", F.lit(7)) == 0, F.pmod(F.col("label") + 1, F.lit(10))).otherwise(F.col("label"))
    return negatives.hard_negatives(table(spark, sf_dir, "embeddings"), label)


def pipeline(spark: SparkSession, sf_dir: str) -> DataFrame:
    import corpus_pipeline

    return corpus_pipeline.run(spark, sf_dir)


QUERIES = {
    f.__name__: f
    for f in (
        op1_embedding_near_dedup,
        op2_secret_scan,
        op3_mixing,
        op4_packing,
        op5_pii,
        op6_exact_topk,
        op7_quality,
        op8_warc,
        op9_token_output,
        op10_simhash_near_dedup,
        op11_collocations,
        op12_decontamination,
        op13_hard_negatives,
        pipeline,
    )
}

SQL = {
    "op1_embedding_near_dedup": """
with recursive v as (select vec_id, list_transform(embedding, lambda x: cast(x as double)) e from embeddings where embedding is not null),
n as (select vec_id, e, sqrt(list_inner_product(e, e)) z from v),
links as (select a.vec_id u, b.vec_id v from n a join n b on a.vec_id <> b.vec_id where list_inner_product(a.e, b.e) / (a.z * b.z) >= 0.9),
reach as (select vec_id u, vec_id v from embeddings union select reach.u, links.v from reach join links on links.u = reach.v)
select e.vec_id, coalesce(l.n, 0) as n_links, r.c as component_id, e.vec_id = r.c as kept, 1.0e0 as recall from embeddings e
left join (select u, count(*) n from links group by u) l on l.u = e.vec_id
join (select u, min(v) c from reach group by u) r on r.u = e.vec_id""",
    "op6_exact_topk": """
with v as (select vec_id, list_transform(embedding, lambda x: floor(256 * cast(x as double))) e from embeddings where embedding is not null),
s as (select q.vec_id query_id, c.vec_id, cast(list_inner_product(q.e, c.e) as bigint) score from v q join v c on q.vec_id % 50 = 0 and q.vec_id <> c.vec_id)
select query_id, cast(row_number() over (partition by query_id order by score desc, vec_id) as int) as rank, vec_id, score from s
qualify row_number() over (partition by query_id order by score desc, vec_id) <= 5""",
    "op8_warc": """
with p as (select page_id, coalesce(html, '') h from pages),
l as (select *, strlen(h) n, max(page_id) over (partition by h) top from p)
select page_id, n as payload_bytes, sha1(h) as payload_digest, case when n >= 1000 and page_id < top then 'revisit' else 'response' end as record_type,
case when n >= 1000 and page_id < top then top end as refers_to from l""",
    "op11_collocations": r"""
with t as (select coalesce(lang, 'und') lang, row_number() over () d, translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') x from documents),
p as (select lang, d, unnest(regexp_split_to_array(x, '[.,;:!?\x0A-\x0D]')) p from t),
w as (select lang, regexp_extract_all(p, '[^\x20\x09]+') w from p),
g as (select lang, k.k, array_to_string(list_slice(w, i.i, i.i + k.k - 1), ' ') phrase from w, (select unnest([1, 2, 3, 4]) k) k, unnest(range(1, len(w) - k.k + 2)) i(i)),
f as (select lang, k, phrase, count(*) f from g group by all),
n as (select lang, cast(sum(f) as bigint) n from f where k = 1 group by lang),
c as (select * from f where k > 1 and f >= 30),
cuts as (select c.lang, c.phrase, c.k, c.f a, j.j, array_to_string(list_slice(string_split(phrase, ' '), 1, j.j), ' ') x, array_to_string(list_slice(string_split(phrase, ' '), j.j + 1, c.k), ' ') y from c, (select unnest([1, 2, 3]) j) j where j.j < c.k),
s as (select cuts.lang, cuts.phrase, cuts.k, a, j, l.f l, r.f r, 2000000::hugeint * a // (l.f + r.f) score from cuts join f l on l.lang = cuts.lang and l.phrase = x join f r on r.lang = cuts.lang and r.phrase = y),
b as (select * from s qualify row_number() over (partition by lang, phrase order by score, j) = 1),
part as (select c.lang, c.f longer, array_to_string(list_slice(string_split(phrase, ' '), i.i, i.i + m.m - 1), ' ') phrase from c, (select unnest([2, 3]) m) m, unnest(range(1, c.k - m.m + 2)) i(i) where m.m < c.k),
up as (select lang, phrase, max(longer) longer from part group by all),
alive as (select b.* from b left join up on up.lang = b.lang and up.phrase = b.phrase where up.longer is null or 100 * up.longer < 80 * b.a),
ranked as (select *, row_number() over (partition by lang order by score desc, a desc, phrase) rank from alive)
select lang, rank, phrase, a, l, r, n, cast(score as bigint) score, cast(k as bigint) n_words from ranked join n using (lang) where rank <= 2000""",
    "op12_decontamination": r"""
with d as (select row_number() over () d, doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') w from documents),
b as (select item_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') w from benchmark),
win as (select distinct item_id, least(10, len(w)) n, array_to_string(list_slice(w, i.i, i.i + 9), ' ') p from b, unnest(range(1, greatest(len(w) - 9, 1) + 1)) i(i) where len(w) > 0),
run as (select d, n.n, i.i, array_to_string(list_slice(w, i.i, i.i + n.n - 1), ' ') p from d, (select distinct n from win) n, unnest(range(1, len(w) - n.n + 2)) i(i)),
hit as (select run.d, run.n, run.i, item_id from run join win on win.n = run.n and win.p = run.p),
words as (select d, count(distinct i + j.j) h from (select distinct d, n, i from hit) x, unnest(range(0, n)) j(j) group by d),
items as (select d, count(distinct item_id) c, string_agg(distinct cast(item_id as varchar), ',' order by cast(item_id as varchar)) s from hit group by d)
select doc_id, len(w) as n_words, coalesce(h, 0) as n_hit, coalesce(c, 0) as n_items, sha256(coalesce(s, '')) as items_sha256, coalesce(h, 0) > 0 as contaminated from d left join words using (d) left join items using (d)""",
    "op13_hard_negatives": """
with v as (select vec_id, case when vec_id % 7 = 0 then (label + 1) % 10 else label end as label, list_transform(embedding, lambda x: floor(256 * cast(x as double))) e from embeddings where embedding is not null and label is not null),
s as (select q.vec_id a, c.vec_id v, q.label = c.label as same, cast(list_inner_product(q.e, c.e) as bigint) score from v q join v c on q.vec_id % 100 = 0 and q.vec_id <> c.vec_id),
p as (select a, v, score from s where same qualify row_number() over (partition by a order by score desc, v) <= 5)
select p.a as anchor_id, p.v as positive_id, cast(row_number() over (partition by p.a, p.v order by s.score desc, s.v) as int) as rank, s.v as negative_id, p.score as positive_score, s.score as negative_score
from p join s on s.a = p.a and not s.same and 30 * p.score <= 100 * s.score and 100 * s.score <= 90 * p.score
qualify row_number() over (partition by p.a, p.v order by s.score desc, s.v) <= 10""",
}

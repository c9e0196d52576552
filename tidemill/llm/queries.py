"""The operators applied to the given tables, and SQL with the same meaning where there is one."""

from __future__ import annotations

from collections.abc import Callable

import corpus_pipeline
import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemill.llm import bpe, clustering, decontaminate, exact_dedup, licenses, minhash, packing, pii, quality, ranking, secrets, urls, warc
from tidemill.llm.common import read

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
SQL: dict[str, str] = {}


def query(fn: Callable[[SparkSession, str], DataFrame]) -> Callable[[SparkSession, str], DataFrame]:
    QUERIES[fn.__name__] = fn
    return fn


@query
def op1_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document with the row that stays for its text."""
    out = exact_dedup.decisions(read(spark, sf_dir, "documents"))
    return out.select(F.col("id").alias("doc_id"), "keep_id", "group_size", "kept", F.lower(F.hex("digest")).alias("text_sha256"))


SQL["op1_exact_dedup"] = r"""
with d as (select doc_id, sha256(regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]+', ' ', 'g')) as text_sha256 from documents),
     g as (select text_sha256, min(doc_id) as keep_id, count(*) as group_size from d group by text_sha256)
select doc_id, keep_id, group_size, doc_id = keep_id as kept, text_sha256 from d join g using (text_sha256)"""


@query
def op2_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every page written to an archive and read back."""
    return warc.round_trip(read(spark, sf_dir, "pages"))


SQL["op2_warc"] = r"""
with p as (select page_id, encode(coalesce(html, '')) as b from pages),
     h as (select page_id, octet_length(b) as payload_bytes, sha1(b) as hex from p),
     d as (select page_id, payload_bytes, array_to_string(list_transform(range(32), lambda i: substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567',
             1 + ((('0x' || substr(hex, 1 + 5 * (i // 4)::int, 5))::int >> (5 * (3 - i % 4))::int) & 31), 1)), '') as payload_digest from h),
     f as (select payload_digest, min(page_id) as first_id from d group by payload_digest)
select page_id, payload_bytes, payload_digest, case when page_id = first_id then 'response' else 'revisit' end as record_type,
       case when page_id = first_id then null else first_id end as refers_to
from d join f using (payload_digest)"""


@query
def op9_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A verdict for every page's URL. No SQL: the trees decide where no rule fits."""
    return urls.verdicts(read(spark, sf_dir, "pages")).withColumnRenamed("id", "page_id")


@query
def op6_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A quality score for every document. No SQL: the scores are a trained model's."""
    out = quality.scored(read(spark, sf_dir, "documents"), read(spark, sf_dir, "labels"))
    return out.select("doc_id", quality.held_out(F.col("doc_id")).alias("held_out"), "score", (F.col("score") >= quality.THRESHOLD).cast("int").alias("predicted"))


@query
def op3_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document that holds a benchmark item. No SQL: tested against a brute-force version."""
    out = decontaminate.leaks(read(spark, sf_dir, "documents"), read(spark, sf_dir, "benchmark"))
    return out.withColumnsRenamed({"id": "doc_id", "item": "item_id"}).drop("row")


@query
def op10_minhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document with the smallest id of its group of near-duplicates, over two-word shingles."""
    out = minhash.near_duplicates(read(spark, sf_dir, "documents"), shingle=2)
    return out.select(F.col("id").alias("doc_id"), F.col("n").alias("n_shingles"), "component_id", (F.col("id") == F.col("component_id")).alias("kept"))


SQL["op10_minhash"] = r"""
with recursive w as (select doc_id, list_filter(regexp_split_to_array(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
               '[\x20\x09-\x0D]+'), lambda x: x <> '') as words from documents),
  s as (select distinct doc_id, unnest(case when len(words) = 0 then []::varchar[] when len(words) = 1 then [words[1]]
               else list_transform(range(1, len(words)), lambda i: words[i] || ' ' || words[i + 1]) end) as shingle from w),
  n as (select doc_id, count(*) as n from s group by doc_id),
  pairs as (select a.doc_id as a, b.doc_id as b, count(*) as shared from s a join s b on a.shingle = b.shingle and a.doc_id <> b.doc_id
            group by a.doc_id, b.doc_id),
  links as (select a, b from pairs join n x on x.doc_id = a join n y on y.doc_id = b where 100 * shared >= 80 * (x.n + y.n - shared)),
  reach(doc_id, other) as (select doc_id, doc_id from w union select r.doc_id, l.b from reach r join links l on l.a = r.other),
  c as (select doc_id, min(other) as component_id from reach group by doc_id)
select doc_id, coalesce(n.n, 0) as n_shingles, component_id, doc_id = component_id as kept from c left join n using (doc_id)"""


@query
def op8_secrets(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Secrets of every document. No SQL: the Markov models add spans."""
    out = secrets.scan(read(spark, sf_dir, "documents").select("doc_id", "text")).drop("text")
    count = lambda kind: F.size(F.filter("spans", lambda x: x.kind == kind)).cast("bigint").alias(f"n_{kind}")
    base = F.filter("spans", lambda x: x.kind != "markov")
    return out.select("doc_id", count("assign"), count("access"), count("hex"), F.sha2(secrets.joined(base), 256).alias("base_sha256"), secrets.joined(F.col("spans")).alias("spans"))


@query
def op4_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Personal data of every document. No SQL: the trees add spans."""
    out = pii.find(read(spark, sf_dir, "documents"))
    count = lambda kind: F.size(F.filter("base", lambda x: x.kind == kind)).cast("bigint").alias(f"n_{kind}")
    return out.select(F.col("id").alias("doc_id"), *[count(k) for k in pii.BASE_KINDS], F.sha2(pii.joined(F.col("base")), 256).alias("base_sha256"), pii.joined(F.col("spans")).alias("spans"))


@query
def op7_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document encoded and decoded. No SQL: tested against the library."""
    path = public_tokenizers.path("byte_bpe_multi_50k.tiktoken")
    out = bpe.encode(read(spark, sf_dir, "documents").select("doc_id", "text"), path, public_tokenizers.PATTERN)
    return out.select("doc_id", F.size("ids").cast("bigint").alias("n_tokens"), bpe.ids_digest("ids").alias("ids_sha256"), F.sha2(bpe.decoder(path)(F.col("ids")), 256).alias("decoded_sha256"))


@query
def op5_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The licence of every document, its path being source/language/hundred/id. No SQL: tested against a brute-force version."""
    docs = read(spark, sf_dir, "documents")
    path = F.concat_ws("/", "source", "lang", F.floor(F.col("doc_id") / 100).cast("string"), F.concat(F.col("doc_id").cast("string"), F.lit(".txt")))
    out = licenses.scan(docs.select("doc_id", path.alias("path"), "text"), "doc_id", "path")
    return out.withColumnRenamed("id", "doc_id")


@query
def op11_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The place of every document's pieces in sequences of 2048 tokens. No SQL: the ids are a tokenizer's; tested against brute force."""
    return packing.pack(read(spark, sf_dir, "documents"), public_tokenizers.path("word_bpe_49k.json")).withColumnRenamed("id", "doc_id")


def clustering_sql(seeds: int = clustering.SEEDS, rounds: int = clustering.ROUNDS) -> str:
    """The rounds written out one after another."""
    parts = [f"""v as materialized (select row_number() over () as r, vec_id, list_transform(embedding, lambda x: floor(64 * x::double)::bigint) as p from embeddings
      where len(embedding) = 64 and len(list_filter(embedding, lambda x: x is null or not isfinite(x))) = 0),
  x as materialized (select r, unnest(p) as x, unnest(range(64)) as i from v),
  c0 as materialized (select k, unnest(p) as x, unnest(range(64)) as i from (select p, row_number() over (order by sha256('1:' || vec_id::varchar), p) - 1 as k from v) where k < {seeds})"""]
    for n in range(rounds + 1):
        parts.append(f"""a{n} as materialized (select r, k, d from (select r, k, d, row_number() over (partition by r order by d, k) as o
      from (select r, k, sum((x.x - c.x) * (x.x - c.x))::bigint as d from x join c{n} c using (i) group by r, k)) where o = 1)""")
        if n < rounds:
            parts.append(f"""m{n} as materialized (select k, i, sum(x.x)::bigint as s, count(*) as n from x join a{n} using (r) group by k, i),
  c{n + 1} as materialized (select k, i, coalesce((s - ((s % n) + n) % n) // n, c.x) as x from c{n} c left join m{n} using (k, i))""")
    return f"""with {", ".join(parts)},
  h as (select k, sha256(string_agg(x::varchar, ',' order by i)) as centroid_sha256 from c{rounds} group by k)
select vec_id, k::int as "cluster", d as distance, sum(d) over (partition by k)::bigint as cluster_inertia, sum(d) over ()::bigint as inertia, centroid_sha256
from a{rounds} join v using (r) join h using (k)"""


@query
def op12_clustering(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The cluster of every vector after three rounds from 16 seeds."""
    return clustering.clusters(read(spark, sf_dir, "embeddings")).withColumnRenamed("id", "vec_id")


SQL["op12_clustering"] = clustering_sql()


@query
def op13_lexical_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The 20 best documents of every benchmark item."""
    found = ranking.search(read(spark, sf_dir, "documents"), read(spark, sf_dir, "benchmark"))
    return found.select(F.col("item").alias("item_id"), "rank", F.col("id").alias("doc_id"), "score")


SQL["op13_lexical_search"] = r"""
with d as materialized (select row_number() over () as r, doc_id, regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
              '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+') as t from documents),
     g as (select count(*) as big_n, sum(len(t)) as l from d where len(t) > 0),
     p as materialized (select r, term, count(*) as tf from (select r, unnest(t) as term from d) group by all),
     w as (select term, floor(1000 * ln((2 * big_n + 2) / (2 * count(*) + 1)))::bigint as w from p, g group by term, big_n),
     i as (select row_number() over () as k, item_id, regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
              '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+') as t from benchmark),
     a as (select k, item_id, term, count(*) as c from (select k, item_id, unnest(t) as term from i) group by all),
     s as (select k, item_id, doc_id, r, sum(c * w * ((1000000000 * tf) // (1000 * tf + 12 * (100 - 25 + (25 * len(t) * big_n) // l))))::bigint as score
           from a join p using (term) join w using (term) join d using (r), g group by k, item_id, doc_id, r),
     o as (select *, row_number() over (partition by k order by score desc, doc_id nulls last)::int as "rank" from s where score > 0)
select item_id, "rank", doc_id, score from o where "rank" <= 20"""


QUERIES["pipeline"] = corpus_pipeline.run

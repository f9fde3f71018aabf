"""The operators over the supplied tables, with production parameters, and their SQL twins."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import functions as F

from curbline.llm import (
    bpe, chunking, clustering, embeddings, exact, language, negatives, packing, pseudonyms, secrets, simhash, suffixes,
    urls,
)
from curbline.llm.common import table, written
from curbline.session import settings

KEY = b"documents"


def op1_exact_dedup(spark, sf):
    return exact.groups(table(spark, sf, "documents")).select(
        "doc_id", "keep_id", "group_size", "kept", F.lower(F.hex("digest")).alias("text_sha256"))


def op2_url_filter(spark, sf):
    return urls.judge(table(spark, sf, "pages"))


def op3_bpe_round_trip(spark, sf):
    path, pattern = public_tokenizers.path("byte_bpe_multi_50k.tiktoken"), public_tokenizers.PATTERN
    coded = bpe.decode(bpe.encode(table(spark, sf, "documents"), path, pattern), path, pattern)
    digests = coded.select("doc_id", F.size("ids").cast("long").alias("n_tokens"),
                           F.sha2(F.array_join("ids", ","), 256).alias("ids_sha256"),
                           F.sha2("decoded", 256).alias("decoded_sha256"))
    # A task holds four batches at once, texts, ids twice and bytes; by default a batch is 10,000 documents.
    with settings(spark, {"spark.sql.execution.arrow.maxRecordsPerBatch": str(bpe.ROWS)}):
        return written(digests, "round-trip")


def op4_chunk_dedup(spark, sf):
    return chunking.dedup(table(spark, sf, "documents")).select(
        "doc_id", "n_bytes", "n_removed", "n_spans", "spans", "kept_sha256")


def op5_packing(spark, sf):
    pieces = packing.pack(table(spark, sf, "documents"), public_tokenizers.path("byte_bpe_50k.json"))
    return pieces.select("doc_id", "start", "length", F.crc32("ids").alias("ids_crc32"), "doc_tokens",
                         "sequence_id", "offset")


def op6_repeat_removal(spark, sf):
    return suffixes.remove(table(spark, sf, "documents")).select(
        "doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256", F.col("n_noted").alias("n_repeated"),
        F.col("noted").alias("repeats"))


def op7_embedding_near_dedup(spark, sf):
    return embeddings.near_groups(table(spark, sf, "embeddings")).select(
        "vec_id", "n_links", "component_id", "kept")


def op8_simhash_near_dedup(spark, sf):
    return simhash.near_groups(table(spark, sf, "documents")).select(
        "doc_id", F.lpad(F.lower(F.hex("fp")), 16, "0").alias("fingerprint"), "component_id", "kept")


def op9_pseudonyms(spark, sf):
    docs = table(spark, sf, "documents").select("doc_id", "text")
    made = pseudonyms.pseudonymise(docs, KEY, "spans")
    return made.select("doc_id", "text", "spans", F.size("spans").cast("long").alias("n_values"))


def op10_language_id(spark, sf):
    docs = table(spark, sf, "documents")
    held = language.held_out(F.col("doc_id"))
    net = language.fit(docs.where(~held).select("doc_id", "text", "lang"))
    return language.predict(docs.select("doc_id", held.alias("held_out"), "text"), net).select(
        "doc_id", "held_out", "lang_pred", "score", "byte_share")


def op11_hard_negatives(spark, sf):
    moved = F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))
    vectors = table(spark, sf, "embeddings").select("vec_id", "embedding", moved.alias("label"))
    return negatives.hard_negatives(vectors, F.col("vec_id") % 100 == 0)


def op12_secret_scan(spark, sf):
    base = F.filter("secrets", lambda s: s["kind"] != "random")
    count = [F.expr(f"cast(size(filter(secrets, s -> s.kind = '{k}')) as bigint)").alias(f"n_{k}")
             for k in ("assign", "access", "hex")]
    return secrets.scan(table(spark, sf, "documents")).select(
        "doc_id", *count, F.sha2(secrets.as_text(base), 256).alias("base_sha256"),
        secrets.as_text(F.col("secrets")).alias("spans"))


def op13_centroid_clustering(spark, sf):
    return clustering.clusters(table(spark, sf, "embeddings")).drop("met")


QUERIES = {f.__name__: f for f in (
    op1_exact_dedup, op2_url_filter, op3_bpe_round_trip, op4_chunk_dedup, op5_packing,
    op6_repeat_removal, op7_embedding_near_dedup, op8_simhash_near_dedup, op9_pseudonyms, op10_language_id,
    op11_hard_negatives, op12_secret_scan, op13_centroid_clustering)}

_LOWER = "translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"

_WHOLE = "[cast(floor(256 * cast(e as double)) as bigint) for e in embedding]"
_FINITE = "embedding is not null and len([e for e in embedding if e is null or not isfinite(e)]) = 0"


def _sum(a: str, b: str, of: str) -> str:
    return f"cast(list_sum([{of} for p in list_zip({a}, {b})]) as bigint)"


_ASSIGN = """a{i} as materialized (
  select vec_id, x, cluster, distance
  from (select vec_id, x, cluster, %s as distance from v, c{i})
  qualify row_number() over (partition by vec_id order by distance, cluster) = 1),
""" % _sum("x", "c", "(p[1] - p[2]) * (p[1] - p[2])")
_MOVE = """c{j} as materialized (
  select c{i}.cluster, coalesce(m.c, c{i}.c) as c from c{i} left join (
    select cluster, list(s order by d) as c from (
      select cluster, d, cast(floor(sum(e)::decimal(38,0) / count(*)) as bigint) as s
      from (select cluster, unnest(x) as e, generate_subscripts(x, 1) as d from a{i}) group by cluster, d)
    group by cluster) m on m.cluster = c{i}.cluster),
"""
_ROUNDS = "".join((_ASSIGN + (_MOVE if i < 5 else "")).format(i=i, j=i + 1) for i in range(6)).rstrip().rstrip(",")

ORACLES = {
    "op1_exact_dedup": f"""
select doc_id, max(doc_id) over (partition by digest) as keep_id,
  count(*) over (partition by digest) as group_size,
  doc_id = max(doc_id) over (partition by digest) as kept, digest as text_sha256
from (select doc_id, sha256({_LOWER}) as digest from documents)""",
    "op11_hard_negatives": f"""
with v as materialized (
  select vec_id, case when vec_id % 7 = 0 then (label + 1) % 10 else label end as label, {_WHOLE} as x
  from embeddings where label is not null and {_FINITE}),
s as materialized (
  select a.vec_id as anchor_id, b.vec_id as vec_id, a.label = b.label as same,
    {_sum('a.x', 'b.x', 'p[1] * p[2]')} as score
  from v a join v b on a.vec_id % 100 = 0 and a.vec_id <> b.vec_id),
p as (select anchor_id, vec_id as positive_id, score as positive_score from s where same
  qualify row_number() over (partition by anchor_id order by score desc, vec_id) <= 5)
select p.anchor_id, positive_id,
  cast(row_number() over (partition by p.anchor_id, positive_id order by score desc, vec_id) as int) as rank,
  vec_id as negative_id, positive_score, score as negative_score
from p join s on s.anchor_id = p.anchor_id and not same
  and 80 * positive_score <= 100 * score and 100 * score <= 100 * positive_score
qualify rank <= 5""",
    "op13_centroid_clustering": f"""
with v as materialized (
  select vec_id, {_WHOLE} as x from embeddings where len(embedding) = 64 and {_FINITE}),
c0 as materialized (
  select cast(row_number() over (order by sha256('2:' || vec_id)) - 1 as int) as cluster, x as c
  from v order by sha256('2:' || vec_id) limit 40),
{_ROUNDS}
select vec_id, cluster, distance,
  cast(sum(distance) over (partition by cluster) as bigint) as cluster_inertia,
  cast(sum(distance) over () as bigint) as inertia, sha256(array_to_string(c, ',')) as centroid_sha256
from a5 join c5 using (cluster)""",
}

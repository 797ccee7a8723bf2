"""One query for each operator of this package, over its whole table and with production parameters."""

from __future__ import annotations

import hashlib

import numpy as np
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from millrace.llm import alignment, bayes_join, block_max, bpe, byte_level, centroids, chaining, chunk_bpe, edit_counts, factorization, line_runs, quotations, shuffle, tiling
from millrace.llm.registry import QUERIES, SQL, query, table

__all__ = ["QUERIES", "SQL"]


@query("op1_line_dedup", sql=r"""
    with docs as (select doc_id, string_split(coalesce(text, ''), chr(10)) as lines from documents),
      l as (select doc_id, unnest(range(1, len(lines) + 1)) as pos, unnest(lines) as line from docs),
      k as (select doc_id, pos, line, translate(trim(line, ' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') as key from l),
      r as (select key, max(doc_id) as top from k where length(key) >= 20 group by key having count(distinct doc_id) >= 3),
      m as (select k.doc_id, pos, line, coalesce(k.doc_id <> r.top, false) as gone from k left join r using (key))
    select doc_id, count(*)::bigint as n_lines, count(*) filter (where gone)::bigint as n_dropped,
      sha256(coalesce(string_agg(line, chr(10) order by pos) filter (where not gone), '')) as kept_sha256
    from m group by doc_id""")
def op1_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = line_runs.dedup_lines(table(spark, sf_dir, "documents").select("doc_id", "text"))
    return out.select("row.doc_id", "n_lines", "n_dropped", F.sha2(F.encode("kept", "UTF-8"), 256).alias("kept_sha256"))


@query("op4_hypergeometric_shuffle")
def op4_hypergeometric_shuffle(spark: SparkSession, sf_dir: str) -> DataFrame:
    text = F.coalesce(F.col("text"), F.lit(""))
    rows = table(spark, sf_dir, "documents").select("doc_id", (F.octet_length(text) + 1).cast("long").alias("size"), F.crc32(F.encode(text, "UTF-8")).alias("text_crc32"))
    out = shuffle.shuffle_into_shards(rows, shards=8)
    return out.select("row.doc_id", "row.size", "row.text_crc32", F.lit("rows").alias("law"), F.col("shard").cast("int").alias("shard"), "slot", F.lit(None).cast("int").alias("grown_shard"))


def mailbox(conversations: DataFrame) -> DataFrame:
    """The conversations as mail: every message quotes the one before it, every third the one before that, with what that one quotes nested below it.

    The table itself holds no quote marks, so the query derives the quotations that the operator then has to take apart.
    """
    base = conversations.select("conv_id", "turn", "role", F.coalesce("text", F.lit("")).alias("text"))
    back = F.when((F.col("turn") >= 2) & (F.pmod(F.col("conv_id") + F.col("turn"), F.lit(3)) == 0), 2).otherwise(1)

    def quoting(quoted: DataFrame) -> DataFrame:
        right = quoted.select("conv_id", F.col("turn").alias("target"), F.regexp_replace("text", "(?m)^", "> ").alias("quote"))
        mail = base.withColumn("target", F.col("turn") - back).join(right, ["conv_id", "target"], "left")
        intro = F.concat(F.lit("\nMessage "), F.col("target").cast("string"), F.lit(" wrote:\n"))
        return mail.select("conv_id", "turn", "role", F.concat(F.col("text"), F.coalesce(F.concat(intro, F.col("quote")), F.lit(""))).alias("text"))

    return quoting(quoting(base))


@query("op10_quotation_linking", sql=r"""
    with recursive b as (select conv_id, turn, role, coalesce(text, '') as text,
        turn - case when turn >= 2 and (conv_id + turn) % 3 = 0 then 2 else 1 end as target from conversations),
      own as (select conv_id, turn, trim(regexp_replace(lower(unnest(string_split(text, chr(10)))), '\s+', ' ', 'g')) as key from b),
      keys as (select conv_id, turn, key, count(*) as n from own where key <> '' group by all),
      quoted as (select b.conv_id, b.turn, k.key, k.n from b join keys k on k.conv_id = b.conv_id and k.turn = b.target),
      sources as (select q.conv_id, q.turn, q.key, any_value(q.n) as n, max(k.turn) as source from quoted q join keys k on k.conv_id = q.conv_id and k.key = q.key and k.turn < q.turn group by all),
      votes as (select conv_id, turn, source, sum(n) as n from sources group by all),
      best as (select conv_id, turn, arg_max(source, n * 1000000 + source) as linked, sum(n)::bigint as n_linked from votes group by all),
      edges as (select b.conv_id, b.turn, b.role, b.text, coalesce(linked, lag(b.turn) over (partition by b.conv_id order by b.turn)) as reply_to, coalesce(n_linked, 0)::bigint as n_linked
        from b left join best on best.conv_id = b.conv_id and best.turn = b.turn),
      walk as (select conv_id, turn, 0::bigint as depth from edges where reply_to is null
        union all select e.conv_id, e.turn, w.depth + 1 from edges e join walk w on w.conv_id = e.conv_id and w.turn = e.reply_to)
    select e.conv_id, e.turn, e.role, e.reply_to, w.depth, row_number() over (partition by e.conv_id order by w.depth, e.turn)::bigint as reply_pos,
      e.n_linked, sha256(trim(e.text, ' ' || chr(9) || chr(13) || chr(10))) as own_sha256
    from edges e join walk w on w.conv_id = e.conv_id and w.turn = e.turn""")
def op10_quotation_linking(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = quotations.reply_ordered(mailbox(table(spark, sf_dir, "conversations")))
    return out.select("conv_id", "turn", "role", "reply_to", "depth", "reply_pos", "n_linked", F.sha2(F.encode("own_text", "UTF-8"), 256).alias("own_sha256"))


def byte_codec() -> bpe.Codec:
    import public_tokenizers

    return bpe.read_codec(public_tokenizers.path("byte_bpe_50k.tiktoken"), public_tokenizers.PATTERN)


@query("op5_byte_bpe")
def op5_byte_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    return round_trip(table(spark, sf_dir, "documents"))


def round_trip(docs: DataFrame) -> DataFrame:
    """Digests of every document's ids and of what they decode to."""
    codec = byte_codec()
    out = bpe.decode(bpe.encode(docs, codec), codec)
    return out.select("doc_id", "n_tokens", F.sha2("ids", 256).alias("ids_sha256"), F.sha2("decoded", 256).alias("decoded_sha256"))


def remainder(doc_id: str = "doc_id"):
    """The fold of a document; rows of remainder 1 are held out from learning."""
    return F.crc32(F.col(doc_id).cast("string").cast("binary")) % 3


TOXIC_FROM = 0.7


def toxicity_model(docs: DataFrame, labels: DataFrame) -> factorization.Model:
    return factorization.learn(docs.select("doc_id", "text"), labels.select("doc_id", "toxic"), remainder() != 1)


@query("op6_toxicity")
def op6_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    out = factorization.score(docs, toxicity_model(docs, table(spark, sf_dir, "labels")))
    return out.select("doc_id", F.coalesce(remainder() == 1, F.lit(False)).alias("held_out"), "score", (F.col("score") >= TOXIC_FROM).cast("int").alias("predicted"))


@query("op7_benchmark_tiling")
def op7_benchmark_tiling(spark: SparkSession, sf_dir: str) -> DataFrame:
    return tiling.contaminated(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


@query("op8_bayes_jaccard_join")
def op8_bayes_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return bayes_join.similar(table(spark, sf_dir, "documents"))


@query("op9_chained_passages")
def op9_chained_passages(spark: SparkSession, sf_dir: str) -> DataFrame:
    return chaining.passages(table(spark, sf_dir, "documents"))


@query("op2_edit_token_counts")
def op2_edit_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Token counts of every document before and after a clean-up of its whole text."""
    codec = byte_codec()
    out = edit_counts.apply_edits(edit_counts.build(table(spark, sf_dir, "documents"), codec, edits_of=edit_counts.cleaning_edits), codec)
    return out.select("doc_id", F.col("n_before").alias("n_tokens_before"), F.col("n_tokens").alias("n_tokens_after"), "n_edits", F.col("n_redone").alias("n_chars_encoded_again"), F.sha2(F.encode("text", "UTF-8"), 256).alias("text_sha256"))


@query("op3_block_max_search")
def op3_block_max_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The ten best documents, by BM25 over all words of its text, for every document whose id is divisible by 50."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    out = block_max.search_texts(docs.where(F.col("doc_id") % 50 == 0), docs, terms=None, least_df=1)
    return out.select(F.col("q").alias("query_id"), F.col("rank").cast("int").alias("rank"), F.col("id").alias("doc_id"), "score")


def clustering_sql(k: int = 16, rounds: int = 3) -> str:
    """The rounds as one chain of common tables: distances to all centroids, nearest by (distance, number), exact floor of the mean."""
    steps = [f"""
        kept as (select row_number() over () as r, vec_id, list_transform(embedding, lambda x: floor(64 * x::double)::bigint) as v from embeddings
          where len(embedding) = 64 and len(list_filter(embedding, lambda x: x is null or not isfinite(x))) = 0),
        c0 as (select row_number() over (order by sha256('1:' || coalesce(vec_id::varchar, '')), v) - 1 as cluster, v from kept order by 1 limit {k})"""]
    for i in range(rounds + 1):
        steps.append(f"""
        d{i} as (select r, vec_id, kept.v, cluster, list_sum(list_transform(list_zip(kept.v, c{i}.v), lambda p: (p[1] - p[2]) * (p[1] - p[2])))::bigint as distance from kept cross join c{i}),
        a{i} as (select * exclude (n) from (select *, row_number() over (partition by r order by distance, cluster) as n from d{i}) where n = 1)""")
        if i < rounds:
            steps.append(f"""
        s{i} as (select cluster, i, sum(x) as s, count(*) as n from (select cluster, generate_subscripts(v, 1) as i, unnest(v) as x from a{i}) group by all),
        m{i} as (select cluster, list((((s - ((s % n) + n) % n) // n)::bigint) order by i) as v from s{i} group by cluster),
        c{i + 1} as (select c{i}.cluster, coalesce(m{i}.v, c{i}.v) as v from c{i} left join m{i} using (cluster))""")
    return "with" + ",".join(steps) + f"""
        select vec_id, a.cluster::int as cluster, distance, sum(distance) over (partition by a.cluster)::bigint as cluster_inertia, sum(distance) over ()::bigint as inertia,
          sha256(array_to_string(c.v, ',')) as centroid_sha256
        from a{rounds} a join c{rounds} c on c.cluster = a.cluster"""


@query("op13_hadamard_clustering", sql=clustering_sql())
def op13_hadamard_clustering(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = centroids.cluster(table(spark, sf_dir, "embeddings"), k=16, rounds=3)
    return out.select("vec_id", "cluster", "distance", "cluster_inertia", "inertia", F.sha2("centroid", 256).alias("centroid_sha256"))


def byte_vocabulary():
    import public_tokenizers

    return byte_level.read_vocabulary(public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.PATTERN)


def digests(vocabulary):
    """Digests of the ids and of the text that they decode to."""

    def sha(data: bytes) -> str:
        return hashlib.sha256(data).hexdigest()

    return lambda text, ids: (sha(np.array(ids, "<u4").tobytes()), sha(chunk_bpe.decoded(vocabulary, ids).decode("utf-8", "replace").encode()))


@query("op12_chunk_reuse_bpe")
def op12_chunk_reuse_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    return chunk_bpe.encode(table(spark, sf_dir, "documents"), byte_vocabulary(), results=("ids_sha256 string, decoded_sha256 string", digests))


@query("op11_token_alignment")
def op11_token_alignment(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers

    pieces = alignment.read_pieces(public_tokenizers.path("piece_bpe_32k.model"))
    return alignment.align(table(spark, sf_dir, "documents"), byte_vocabulary(), pieces)

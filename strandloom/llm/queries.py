"""The queries of the training-data operators, by name, and DuckDB SQL for those that SQL can express."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import secrets, toxicity
from .common import scratch_path, table
from .decontamination import leaks
from .minhash import near_duplicates
from .mixing import mix_sources
from .nearest import nearest
from .repeats import remove_repeats
from .sharding import shard_documents
from .tokens import read_tokens, write_tokens
from .urls import bad_texts, judge_by_texts


def op1_tokens(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers

    path = scratch_path(spark, "token-files")
    write_tokens(table(spark, sf_dir, "documents"), path, str(public_tokenizers.path("byte_bpe_50k.json")))
    return read_tokens(spark, path)


def op2_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return leaks(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark")).drop("h")


def op3_minhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_duplicates(table(spark, sf_dir, "documents"), width=2, percent=80).drop("text_hash")


def op4_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    return toxicity.score(docs, toxicity.train(docs, table(spark, sf_dir, "labels")))


def op5_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    text = F.coalesce(F.col("text"), F.lit(""))
    sized = {"size": (F.octet_length(text) + 1).cast("bigint"), "text_crc32": F.crc32(text.cast("binary"))}
    docs = table(spark, sf_dir, "documents").select("doc_id", "text").withColumns(sized)  # so that no text is shuffled
    return shard_documents(docs, 16).select("doc_id", "size", "text_crc32", F.lit("bytes").alias("law"), "shard", "slot", F.lit(None).cast("int").alias("grown_shard"))


def op6_secrets(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = secrets.scan(table(spark, sf_dir, "documents"), secrets.train())
    return found.drop("string")  # the digest names places, not the secrets themselves


def op7_urls(spark: SparkSession, sf_dir: str) -> DataFrame:
    model = bad_texts(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))
    return judge_by_texts(table(spark, sf_dir, "pages"), model)


def op8_nearest(spark: SparkSession, sf_dir: str) -> DataFrame:
    return nearest(table(spark, sf_dir, "embeddings"), "vec_id % 50 = 0", 5)


def op9_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "source", "text")
    return mix_sources(docs).select("doc_id", "source", "mix_slot", "mix_row", "mix_block", "mix_phase", "mix_due")


def op10_repeats(spark: SparkSession, sf_dir: str) -> DataFrame:
    return remove_repeats(table(spark, sf_dir, "documents")).drop("spans")


QUERIES = {"op1_tokens": op1_tokens, "op2_decontamination": op2_decontamination, "op3_minhash": op3_minhash, "op4_toxicity": op4_toxicity, "op5_sharding": op5_sharding, "op6_secrets": op6_secrets, "op7_urls": op7_urls, "op8_nearest": op8_nearest, "op9_mixing": op9_mixing, "op10_repeats": op10_repeats}
SQL: dict[str, str] = {
    "op3_minhash": r"""with recursive
  w as (select doc_id, list_filter(regexp_split_to_array(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[\x20\x09-\x0D]+'), lambda x: x <> '') as ws from documents),
  sh as (select doc_id, unnest(list_distinct(case when len(ws) < 2 then ws else list_transform(range(1, len(ws)), lambda i: ws[i] || ' ' || ws[i + 1]) end)) as s from w),
  n as (select doc_id, count(*) as n from sh group by doc_id),
  both_in as (select a.doc_id as x, b.doc_id as y, count(*) as i from sh a join sh b on a.s = b.s and a.doc_id < b.doc_id group by all),
  links as (select x, y from both_in join n a on a.doc_id = x join n b on b.doc_id = y where 100 * i >= 80 * (a.n + b.n - i)),
  edges as (select x, y from links union all select y, x from links),
  reach as (select doc_id as x, doc_id as y from documents union select r.x, e.y from reach r join edges e on e.x = r.y),
  least as (select x, min(y) as c from reach group by x)
  select d.doc_id, cast(coalesce(n.n, 0) as bigint) as n_shingles, c as component_id, d.doc_id = c as kept from documents d left join n using (doc_id) join least on x = d.doc_id""",
    "op10_repeats": """with
  h as (select doc_id, hex(encode(coalesce(text, ''))) as x from documents),
  starts as (select doc_id, unnest(range(0, length(x) // 2 - 399)) as p, x from h where length(x) >= 800),
  windows as (select doc_id, p, md5_number(substr(x, 2 * p + 1, 800)) as m from starts),
  again as (select doc_id, p from windows where m in (select m from windows group by m having count(*) > 1)),
  marked as (select *, case when p <= lag(p) over (partition by doc_id order by p) + 400 then 0 else 1 end as new from again),
  spans as (select doc_id, min(p) as a, max(p) + 400 as z from (select *, sum(new) over (partition by doc_id order by p) as g from marked) group by doc_id, g),
  cuts as (select doc_id, lag(z, 1, 0) over (partition by doc_id order by a) as s, a as e from spans union all select doc_id, max(z), null from spans group by doc_id),
  kept as (select c.doc_id, string_agg(case when e is null then substr(x, 2 * s + 1) else substr(x, 2 * s + 1, 2 * (e - s)) end, '' order by s) as k from cuts c join h using (doc_id) group by c.doc_id),
  w as (select doc_id, md5(text) as t, list_filter(regexp_split_to_array(coalesce(text, ''), '[\x20\x09-\x0D]+'), lambda x: x <> '') as ws from documents),
  each_word as (select doc_id, t, len(ws) as n, unnest(ws) as word, generate_subscripts(ws, 1) as i from w where len(ws) >= 51),
  passages as (select * from (select doc_id, t, i, n, md5_number(string_agg(word, ' ') over (partition by doc_id, t order by i rows between current row and 50 following)) as m from each_word) where i <= n - 50),
  elsewhere as (select m from passages group by m having count(distinct (doc_id, t)) > 1),
  covered as (select doc_id, t, sum(step) as c from (select doc_id, t, least(51, coalesce(i - lag(i) over (partition by doc_id, t order by i), 51)) as step from passages where m in (select m from elsewhere)) group by doc_id, t)
  select h.doc_id, cast(length(x) // 2 as bigint) as n_bytes, cast((length(x) - length(coalesce(k, x))) // 2 as bigint) as n_removed,
    cast((select count(*) from spans s where s.doc_id = h.doc_id) as bigint) as n_spans, sha256(unhex(coalesce(k, x))) as kept_sha256, c is not null as has_passage, cast(coalesce(c, 0) as bigint) as passage_words
  from h left join kept using (doc_id) left join covered using (doc_id)""",
}

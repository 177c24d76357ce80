"""The registered queries of the corpus operators and, where SQL can express them, their oracles."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from daymark.llm import (decontamination, exact_dedup, language, licenses, near_dedup, negatives, packing, personal_data, pieces,
                         repeats, secrets, spelling, toxicity)

QUERIES: dict = {}
ORACLES: dict[str, str] = {}


def query(name: str, sql: str | None = None):
    def add(fn):
        QUERIES[name] = fn
        if sql is not None:
            ORACLES[name] = sql.strip()
        return fn
    return add


def read(spark: SparkSession, sf_dir: str, name: str = "documents") -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def tokenizer_files() -> tuple[str, str, tuple[tuple[str, int], ...]]:
    """Rank file, pre-tokeniser pattern and added tokens of the public byte-level BPE."""
    import public_tokenizers

    added = packing.added_tokens(public_tokenizers.path("byte_bpe_50k.json"))
    return public_tokenizers.path("byte_bpe_50k.tiktoken"), public_tokenizers.PATTERN, added


@query("op1_license_scan")
def op1(spark, sf_dir):
    return licenses.scan_documents(read(spark, sf_dir))


@query("op2_decontamination", r"""
with d as (
  select doc_id as id, list_filter(string_split_regex(lower(coalesce(text, '')), '[\x00-\x2F\x3A-\x60\x7B-\x7F]+'), lambda x: x <> '') as w from documents
), i as (
  select item_id as id, list_filter(string_split_regex(lower(coalesce(text, '')), '[\x00-\x2F\x3A-\x60\x7B-\x7F]+'), lambda x: x <> '') as w from benchmark
), dg as (
  select distinct id as doc_id, unnest(case when len(w) >= 5 then list_transform(range(1, len(w) - 3), lambda k: array_to_string(w[k:k + 4], ' '))
                                            else [array_to_string(w, ' ')] end) as gram from d where len(w) > 0
), ig as (
  select distinct id as item_id, unnest(case when len(w) >= 5 then list_transform(range(1, len(w) - 3), lambda k: array_to_string(w[k:k + 4], ' '))
                                             else [array_to_string(w, ' ')] end) as gram from i where len(w) > 0
), n as (select item_id, count(*) as n from ig group by 1)
select item_id, doc_id, count(*) as shared, n as item_shingles, count(*) / n as containment
from dg join ig using (gram) join n using (item_id) group by item_id, doc_id, n having count(*) >= 0.8 * n - 1e-9
""")
def op2(spark, sf_dir):
    return decontamination.contained(read(spark, sf_dir), read(spark, sf_dir, "benchmark"))


@query("op3_exact_dedup", """
select doc_id, max(doc_id) over g as keep_id, count(*) over g as group_size, doc_id = max(doc_id) over g as kept,
       sha256(coalesce(text, '')) as text_sha256
from documents window g as (partition by coalesce(text, ''))
""")
def op3(spark, sf_dir):
    return exact_dedup.exact_groups(read(spark, sf_dir))


@query("op4_toxicity")
def op4(spark, sf_dir):
    return toxicity.toxicity(read(spark, sf_dir), read(spark, sf_dir, "labels"))


@query("op5_near_dedup")
def op5(spark, sf_dir):
    return near_dedup.near_duplicates(read(spark, sf_dir))


@query("op6_secret_scan")
def op6(spark, sf_dir):
    return secrets.scan_documents(read(spark, sf_dir))


@query("op7_personal_data")
def op7(spark, sf_dir):
    return personal_data.find(read(spark, sf_dir))


@query("op8_repeat_removal")
def op8(spark, sf_dir):
    return repeats.remove_repeats(read(spark, sf_dir))


@query("op9_packing")
def op9(spark, sf_dir):
    return packing.pack_documents(read(spark, sf_dir), *tokenizer_files())


@query("op10_language_id")
def op10(spark, sf_dir):
    return language.identify(read(spark, sf_dir))


@query("op11_hard_negatives", """
with e as (
  select vec_id as id, case when vec_id % 7 = 0 then (label + 1) % 10 else label end as label,
         list_transform(embedding, lambda x: floor(256 * x::double)) as q
  from embeddings
  where vec_id is not null and label is not null and embedding is not null
    and len(list_filter(embedding, lambda x: x is null or not isfinite(256 * x::double))) = 0
), s as (
  select a.id as anchor_id, r.id as other_id, a.label = r.label as same, list_inner_product(a.q, r.q)::bigint as score
  from e a join e r on a.id <> r.id where a.id % 100 = 0
), p as (
  select anchor_id, other_id as positive_id, score as positive_score from s where same
  qualify row_number() over (partition by anchor_id order by score desc, other_id) <= 5
)
select anchor_id, positive_id, row_number() over w::int as rank, other_id as negative_id, positive_score, score as negative_score
from p join s using (anchor_id)
where not same and 30 * positive_score <= 100 * score and 100 * score <= 90 * positive_score
window w as (partition by anchor_id, positive_id order by score desc, other_id)
qualify row_number() over w <= 10
""")
def op11(spark, sf_dir):
    rows = negatives.taking_part(read(spark, sf_dir, "embeddings"))
    relabelled = F.when(F.col("id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))
    return negatives.hard_negatives(rows.withColumn("label", relabelled), F.col("id") % 100 == 0)


@query("op12_spelling_variants")
def op12(spark, sf_dir):
    return spelling.spelling_groups(read(spark, sf_dir))


@query("op13_piece_encoding")
def op13(spark, sf_dir):
    import public_tokenizers

    return pieces.encoding_digests(read(spark, sf_dir), public_tokenizers.path("piece_bpe_32k.model"), check=True)

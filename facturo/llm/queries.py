"""Registered queries of the training-data operators, with their oracle SQL where SQL can express them."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import byte_bpe, decontaminate, exact_dedup, filter_audit, langid, licences, near_dedup, packing, pii, token_store, url_filter, vector_codes, warc
from .common import prepare, read_table
from .tokens import default_tokenizer

# The rules of the URL query, as (verdict, host, path).
URL_RULES = [
    ("allow", "org", "/"),
    ("block", "example.org", "/es/"),
    ("block", "example.org", "/en/1"),
    ("allow", "com", "/fr/"),
    ("block", "com", "/de/"),
]


def op1_token_ids(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_store.token_index(spark, read_table(spark, sf_dir, "documents"), default_tokenizer(), end_id=2)


def op2_licence_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return licences.scan_licences(read_table(spark, sf_dir, "documents"))


def op3_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exact_dedup.mark_copies(read_table(spark, sf_dir, "documents"))


def op4_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents (doc_id) and pages (page_id): one row each."""
    docs, pages = read_table(spark, sf_dir, "documents"), read_table(spark, sf_dir, "pages")
    none = F.lit(None).cast("long")
    evidence = ["text", "declared", "host"]
    both = langid.document_evidence(docs).select(F.lit("documents").alias("source"), F.col("row.doc_id").alias("doc_id"), none.alias("page_id"), *evidence)
    both = both.unionAll(langid.page_evidence(pages).select(F.lit("pages"), none, "row.page_id", *evidence))
    found = langid.identify(both, langid.fit(langid.labelled_documents(docs)))
    return found.select("source", "doc_id", "page_id", "declared", "host", "lang", F.round("posterior", 6).alias("posterior"), F.expr("lang <> 'und'").alias("kept"))


def op5_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    return warc.archive_round_trip(spark, read_table(spark, sf_dir, "pages")).drop("url")


def op6_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A row for every contaminated document and item of the benchmark in it."""
    found = decontaminate.contaminated(read_table(spark, sf_dir, "documents"), read_table(spark, sf_dir, "benchmark"))
    return found.select("doc_id", "item_id", "item_words", "covered", F.round("coverage", 6).alias("coverage"), F.size("tiles").alias("n_tiles"))


def op7_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = near_dedup.mark_near_copies(read_table(spark, sf_dir, "documents").select("doc_id", "text"))
    return found.select(F.col("row.doc_id").alias("doc_id"), "class_id", "class_size", "kept")


def op8_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    rules = spark.createDataFrame(URL_RULES, url_filter.RULES)
    return url_filter.judge_urls(read_table(spark, sf_dir, "pages"), rules)


def op9_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack(read_table(spark, sf_dir, "documents"), default_tokenizer(), capacity=4096, end_id=1)


def op10_personal_data(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pii.digest(pii.personal_data(read_table(spark, sf_dir, "documents")))


def op11_vector_codes(spark: SparkSession, sf_dir: str) -> DataFrame:
    return vector_codes.vector_codes(read_table(spark, sf_dir, "embeddings"))


def op12_filter_audit(spark: SparkSession, sf_dir: str) -> DataFrame:
    return filter_audit.filter_audit(read_table(spark, sf_dir, "documents"), read_table(spark, sf_dir, "labels"))


def op13_byte_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    return byte_bpe.token_digests(read_table(spark, sf_dir, "documents"))


_BLANKS = r"[\x20\x09-\x0D]+"
_SQL = {
    "op2_licence_scan": licences.licence_sql(),
    "op3_exact_dedup": rf"""
with t as (select doc_id, regexp_replace(coalesce(text, ''), '{_BLANKS}', ' ', 'g') as norm from documents),
g as (select norm, min(doc_id) as keep_id, count(*) as group_size from t group by norm)
select doc_id, keep_id, group_size, doc_id = keep_id as kept, sha256(t.norm) as text_sha256 from t join g on t.norm = g.norm
""",
    "op5_warc": """
with p as (select page_id, coalesce(html, '') as html from pages),
d as (select page_id, html, octet_length(encode(html)) as payload_bytes from p),
f as (select html, max(page_id) as first_id from d where payload_bytes >= 1000 group by html)
select page_id, payload_bytes::bigint as payload_bytes, sha1(d.html) as payload_digest,
       case when first_id is null or first_id = page_id then 'response' else 'revisit' end as record_type,
       case when first_id <> page_id then first_id end as refers_to
from d left join f on d.html = f.html
""",
    "op11_vector_codes": vector_codes.oracle_sql(),
    "op12_filter_audit": filter_audit.oracle_sql(),
}


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    every = [op1_token_ids, op2_licence_scan, op3_exact_dedup, op4_language_id, op5_warc, op6_decontaminate, op7_near_dedup, op8_url_filter, op9_packing, op10_personal_data, op11_vector_codes, op12_filter_audit, op13_byte_bpe]

    def wrap(f: Callable[[SparkSession, str], DataFrame]) -> Callable[[SparkSession, str], DataFrame]:
        return lambda spark, sf_dir: f(prepare(spark), sf_dir)

    return {f.__name__: wrap(f) for f in every}


def oracle_sql() -> dict[str, str]:
    return dict(_SQL)

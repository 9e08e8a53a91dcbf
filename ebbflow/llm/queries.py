"""One registered query for each operator, over its whole table, with production parameters."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ebbflow.llm import (
    arc,
    bitpack,
    imatch,
    jaccard,
    language,
    licences,
    merkle,
    mixing,
    packing,
    periodic,
    repetition,
    sharding,
    vantage,
)
from ebbflow.llm.registry import ORACLES, QUERIES, query, table

__all__ = ["ORACLES", "QUERIES"]

PACK_VOCABULARY, PACK_END = public_tokenizers.path("byte_bpe_50k.json"), 1
FILE_VOCABULARY, FILE_END = public_tokenizers.path("word_bpe_49k.json"), 2
REVISIT_FROM_BYTES = 0


@query("op1_imatch_fingerprints")
def op1(spark: SparkSession, sf_dir: str) -> DataFrame:
    return imatch.fingerprints(table(spark, sf_dir, "documents"))


@query("op2_repetition_coverage")
def op2(spark: SparkSession, sf_dir: str) -> DataFrame:
    return repetition.judged(table(spark, sf_dir, "documents"))


@query("op3_power_of_two_packing")
def op3(spark: SparkSession, sf_dir: str) -> DataFrame:
    pieces = packing.pack(table(spark, sf_dir, "documents"), PACK_VOCABULARY, PACK_END)
    return pieces.select(
        "doc_id", "start", "length", F.crc32("ids").alias("ids_crc32"), "doc_tokens", "sequence_id", "offset"
    )


@query("op4_ngram_jaccard_join")
def op4(spark: SparkSession, sf_dir: str) -> DataFrame:
    return jaccard.grouped(table(spark, sf_dir, "documents"))


OP5_SQL = """
WITH p AS (
    SELECT page_id, coalesce(html, '') AS h, sha1(coalesce(html, '')) AS x FROM pages
), m AS (
    SELECT *, min(page_id) OVER (PARTITION BY h) AS least FROM p
)
SELECT page_id, strlen(h)::BIGINT AS payload_bytes,
    array_to_string(list_transform(range(0, 32), lambda k: substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567',
        1 + (((('0x' || substr(x, (1 + 5 * (k // 4))::BIGINT, 5))::BIGINT >> (15 - 5 * (k % 4))::BIGINT) & 31))::BIGINT, 1)), '')
        AS payload_digest,
    CASE WHEN page_id = least THEN 'response' ELSE 'revisit' END AS record_type,
    CASE WHEN page_id <> least THEN least END AS refers_to
FROM m"""


@query("op5_arc_to_warc", OP5_SQL)
def op5(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = arc.new_archive_set(spark)
    arc.convert(arc.arc_archives(table(spark, sf_dir, "pages")), path, REVISIT_FROM_BYTES)
    return arc.read_warc(spark, path).select(
        "page_id", "payload_bytes", "payload_digest", "record_type", "refers_to"
    )


@query("op6_source_mixing")
def op6(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.taken(table(spark, sf_dir, "documents"))


@query("op7_licence_sentences", licences.scan_sql())
def op7(spark: SparkSession, sf_dir: str) -> DataFrame:
    return licences.scanned(table(spark, sf_dir, "documents"))


@query("op8_language_fusion")
def op8(spark: SparkSession, sf_dir: str) -> DataFrame:
    # documents have neither markup nor addresses; the pipeline's stage reads them
    pages = language.evidence_of_pages(table(spark, sf_dir, "pages"))
    return language.identified(pages).drop("text_hash").withColumnRenamed("doc_id", "page_id")


@query("op9_bit_packed_ids")
def op9(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = bitpack.new_file_set(spark)
    bitpack.write_ids(table(spark, sf_dir, "documents"), FILE_VOCABULARY, FILE_END, path)
    return bitpack.read_documents(spark, path)


@query("op10_label_propagation_shards")
def op10(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sharding.sharded(table(spark, sf_dir, "documents"))


@query("op11_periodic_runs")
def op11(spark: SparkSession, sf_dir: str) -> DataFrame:
    return periodic.digests(periodic.periodic_runs(periodic.with_planted_periods(table(spark, sf_dir, "documents"))))


@query("op12_merkle_manifest", merkle.manifest_sql())
def op12(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    return merkle.summary(merkle.verified(docs, merkle.without_line_ends(docs)))


@query("op13_vantage_simhash")
def op13(spark: SparkSession, sf_dir: str) -> DataFrame:
    return vantage.near_copies(table(spark, sf_dir, "documents"))

"""Registered queries of the training-data operators: ``name -> fn(spark, sf_dir) -> DataFrame``."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from shopstream.llm import (decontaminate, exact_dedup, fill_middle, line_dedup, merkle, ngram_join, packing, quality,
                            secret_scan, simhash, token_files, toxicity, warc)
from shopstream.llm.common import cut, documents, text_of

QueryFn = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, QueryFn] = {}

# fixed values: the end ids and window of the contracts
PACK_END_ID, FILE_END_ID, WINDOW = 2, 0, 4096
TOXIC_THRESHOLD = 0.7


def register(name: str):
    def deco(fn: QueryFn) -> QueryFn:
        QUERIES[name] = fn
        return fn
    return deco


def vocabulary(name: str) -> str:
    """Path of a public vocabulary file."""
    import public_tokenizers

    return str(public_tokenizers.path(name))


@register("op1_secret_scan")
def op1(spark, sf_dir):
    found = secret_scan.scan(spark, documents(spark, sf_dir))
    return found.select("doc_id", "n_assign", "n_access", "n_hex", F.sha2("base", 256).alias("base_sha256"), "spans",
                        "n_bare", "n_live", "n_copied")


@register("op2_quality")
def op2(spark, sf_dir):
    docs = documents(spark, sf_dir)
    model = quality.train(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))
    return quality.posteriors(spark, docs, model, host=F.col("source"), path=F.col("lang"))


@register("op3_warc")
def op3(spark, sf_dir):
    manifest = warc.write_archives(spark, spark.read.parquet(f"{sf_dir}/pages.parquet"))
    read = warc.read_archives(spark, manifest, payloads=False).where("status = 'ok'")
    records = cut(spark, read.select("record_type", "record_id", "refers_to", "payload_digest", "payload_bytes"),
                  "warc-records")
    return warc.resolve_revisits(records).select(
        warc.key_of(F.col("record_id")).alias("page_id"), "payload_bytes", "payload_digest", "record_type",
        warc.key_of(F.col("refers_to")).alias("refers_to"))


@register("op4_content_sort_dedup")
def op4(spark, sf_dir):
    return exact_dedup.decisions(spark, documents(spark, sf_dir))


@register("op5_simhash")
def op5(spark, sf_dir):
    return simhash.near_duplicates(spark, documents(spark, sf_dir))


@register("op6_decontamination")
def op6(spark, sf_dir):
    found = decontaminate.contaminated(spark, documents(spark, sf_dir), spark.read.parquet(f"{sf_dir}/benchmark.parquet"))
    return found.select("doc_id", "item_id", "start", "length", "matches", F.lit(True).alias("contaminated"))


@register("op7_toxicity")
def op7(spark, sf_dir):
    docs = documents(spark, sf_dir)
    model = toxicity.train(spark, docs, spark.read.parquet(f"{sf_dir}/labels.parquet"),
                           fold=_remainder("label_id") != 1)
    score = toxicity.scores(spark, model, text_of())
    scored = docs.select("doc_id", F.coalesce(_remainder("doc_id") == 1, F.lit(False)).alias("held_out"),
                         score.alias("score"))
    return scored.withColumn("predicted", (F.col("score") >= TOXIC_THRESHOLD).cast("int"))


def _remainder(id_col: str):
    return F.crc32(F.col(id_col).cast("string")) % 3


@register("op8_packing")
def op8(spark, sf_dir):
    pieces = packing.pack(spark, documents(spark, sf_dir), vocabulary("word_bpe_49k.json"), PACK_END_ID, window=WINDOW)
    return pieces.select("doc_id", "start", "length", F.crc32("ids").alias("ids_crc32"), "doc_tokens", "sequence_id",
                         "offset", "boundary")


@register("op9_token_files")
def op9(spark, sf_dir):
    manifest = token_files.write_files(spark, documents(spark, sf_dir), vocabulary("byte_bpe_50k.json"), FILE_END_ID)
    return token_files.read_files(spark, manifest).select("doc_id", "start", "n_tokens",
                                                          F.crc32("ids").alias("ids_crc32"))


@register("op10_line_dedup")
def op10(spark, sf_dir):
    kept = line_dedup.dedup_lines(documents(spark, sf_dir).select("doc_id", "text"))
    return kept.select("doc_id", "n_lines", "n_dropped", F.sha2(text_of(), 256).alias("kept_sha256"))


@register("op11_ngram_join")
def op11(spark, sf_dir):
    return ngram_join.similar_documents(spark, documents(spark, sf_dir))


@register("op12_merkle_manifest")
def op12(spark, sf_dir):
    docs = documents(spark, sf_dir)
    tampered = F.crc32(F.col("doc_id").cast("string")) % 7 == 0
    return merkle.audit(spark, docs, {"n_chars": F.when(tampered, F.col("n_chars") + 1).otherwise(F.col("n_chars"))})


@register("op13_fill_middle")
def op13(spark, sf_dir):
    return fill_middle.round_trip(spark, documents(spark, sf_dir))

"""The queries of the text operators, by the names under which the entry module registers them."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from millrace.llm.shared import smaller_batches


def _documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    smaller_batches(spark)
    return spark.read.parquet(f"{sf_dir}/documents.parquet")


def op10_prefix_bpe(spark: SparkSession, sf_dir: str, docs: DataFrame | None = None) -> DataFrame:
    import public_tokenizers

    from millrace.llm.prefix_bpe import encode_documents

    docs = _documents(spark, sf_dir) if docs is None else docs
    e = encode_documents(docs, public_tokenizers.path("byte_bpe_50k.tiktoken"), public_tokenizers.PATTERN, decoded=True)
    return e.select("doc_id", (F.octet_length("ids") / 4).cast("long").alias("n_tokens"), F.sha2("ids", 256).alias("ids_sha256"), F.sha2("decoded", 256).alias("decoded_sha256"))


def op1_token_shards(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers

    from millrace.llm.token_shards import read_tokens, write_tokens

    docs = _documents(spark, sf_dir)
    manifest = write_tokens(docs, public_tokenizers.path("byte_bpe_50k.json"), end_id=2, vocabulary=50257)
    out = read_tokens(spark, manifest, docs.select("doc_id"))
    return out.select("doc_id", "start", (F.octet_length("ids") / 4).cast("long").alias("n_tokens"), F.crc32("ids").alias("ids_crc32"))


def op2_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    from millrace.llm.substring import drop_repeats

    out = drop_repeats(_documents(spark, sf_dir), width=35)
    return out.select("doc_id", "n_words", "n_removed", F.sha2("kept", 256).alias("kept_sha256"))


def op8_set_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    from millrace.llm.setjoin import similar_groups

    return similar_groups(_documents(spark, sf_dir), k=4, percent=85)


def op3_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    from millrace.llm.fmindex import contamination, is_contaminated

    out = contamination(_documents(spark, sf_dir), spark.read.parquet(f"{sf_dir}/benchmark.parquet"), width=13)
    return out.select("doc_id", "n_words", "n_hit", F.size("items").cast("long").alias("n_items"), F.sha2(F.array_join("items", ","), 256).alias("items_sha256"), is_contaminated().alias("contaminated"))


def op6_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    from millrace.llm.linededup import drop_repeated_lines

    return drop_repeated_lines(_documents(spark, sf_dir), width=3)


def op9_syncmers(spark: SparkSession, sf_dir: str) -> DataFrame:
    from millrace.llm.syncmers import fingerprint_pairs

    return fingerprint_pairs(_documents(spark, sf_dir))


def held_out():
    """Documents that language models are not fitted on."""
    return F.coalesce(F.crc32(F.col("doc_id").cast("string")) % 4 == 2, F.lit(False))


def op4_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers

    from millrace.llm.langid import fit, identify

    docs = _documents(spark, sf_dir)
    model = fit(docs, public_tokenizers.path("piece_bpe_32k.model"), ~held_out())
    return identify(docs, model).select("doc_id", held_out().alias("held_out"), "lang_pred", "score")


def op5_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    from millrace.llm.urlfilter import fit, judge, labelled_table

    return judge(spark.read.parquet(f"{sf_dir}/pages.parquet"), fit(labelled_table(spark)))


def graded(labels: DataFrame) -> DataFrame:
    """Grades from the two labels: 0 toxic, 1 of low quality, 2 good."""
    return labels.select("doc_id", F.when(F.col("toxic") == 1, 0).when(F.col("quality") == 0, 1).when((F.col("quality") == 1) & (F.col("toxic") == 0), 2).alias("grade"))


def op7_quality_grade(spark: SparkSession, sf_dir: str) -> DataFrame:
    from millrace.llm.ordinal import fit, grade_documents

    docs = _documents(spark, sf_dir)
    model = fit(docs, graded(spark.read.parquet(f"{sf_dir}/labels.parquet")))
    return grade_documents(docs, model, tail=2)


def op11_source_divergence(spark: SparkSession, sf_dir: str) -> DataFrame:
    from millrace.llm.divergence import divergence

    return divergence(_documents(spark, sf_dir))


def op12_simhash_anchors(spark: SparkSession, sf_dir: str) -> DataFrame:
    from millrace.llm.simhash import near_groups

    return near_groups(_documents(spark, sf_dir), k=3, most=3)


def op13_target_sample(spark: SparkSession, sf_dir: str) -> DataFrame:
    from millrace.llm.importance import resample

    return resample(_documents(spark, sf_dir), spark.read.parquet(f"{sf_dir}/benchmark.parquet"), share=5)


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {f.__name__: f for f in (op1_token_shards, op2_substring_dedup, op3_decontamination, op4_language_id, op5_url_filter, op6_line_dedup, op7_quality_grade, op8_set_join, op9_syncmers, op10_prefix_bpe, op11_source_divergence, op12_simhash_anchors, op13_target_sample)}


def oracle_sql() -> dict[str, str]:
    from millrace.llm import divergence, linededup

    return {"op6_line_dedup": linededup.duckdb_sql(), "op11_source_divergence": divergence.duckdb_sql()}

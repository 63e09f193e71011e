"""The operators applied to the given tables, one query for each, and the pipeline's stages."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from atelier.llm import decontaminate, exactdedup, langid, linededup, merkle, mixing, ngramjoin, recompress, secretscan, spelling, tokenids, toxicity, warc
from atelier.llm.staging import remainder, table, with_types

TOKENIZER = "byte_bpe_50k.json"
#: A document whose language is less sure than this doesn't enter the corpus.
LEAST_LANGUAGE_SCORE = 0.4


def tokenizer_file() -> str:
    import public_tokenizers

    return str(public_tokenizers.path(TOKENIZER))


def _language_model(docs: DataFrame) -> langid.ByteNetwork | None:
    rows = with_types(docs, doc_id="long", text="string", lang="string")
    return langid.learn(rows.where(remainder("doc_id", 4) != 2))


def op1_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    found = langid.identify(docs, _language_model(docs), F.col("doc_id"))
    held_out = F.coalesce(remainder("row", 4) == 2, F.lit(False))
    return found.select(F.col("row").alias("doc_id"), held_out.alias("held_out"), "lang_pred", "score")


def op2_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontaminate.contaminated(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark")).drop("mark")


def op3_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return linededup.deduplicate_lines(table(spark, sf_dir, "documents")).drop("keep_bitmap")


def op4_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    return warc.archive_pages(table(spark, sf_dir, "pages"))


def op5_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.mix(table(spark, sf_dir, "documents")).select("doc_id", "size", "source_size", "target", "taken", "source", "times")


def op6_token_ids(spark: SparkSession, sf_dir: str) -> DataFrame:
    return tokenids.token_files(table(spark, sf_dir, "documents"), tokenizer_file())


def op7_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exactdedup.deduplicate(table(spark, sf_dir, "documents")).drop("n_points")


def op8_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return secretscan.scan(table(spark, sf_dir, "documents"))


def op9_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    model = toxicity.learn(docs, table(spark, sf_dir, "labels"), remainder("doc_id", 3) == 1)
    held_out = F.coalesce(remainder("doc_id", 3) == 1, F.lit(False))
    return toxicity.score(docs, model).select("doc_id", held_out.alias("held_out"), "score", "predicted")


def op10_ngram_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ngramjoin.near_groups(table(spark, sf_dir, "documents"))


def op11_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = recompress.deduplicate_substrings(table(spark, sf_dir, "documents"), digests=True)
    return found.withColumnRenamed("kept", "kept_sha256")


def op12_merkle_manifest(spark: SparkSession, sf_dir: str) -> DataFrame:
    tampered = F.when(remainder("doc_id", 5) == 0, merkle.leaf_digest(text=merkle.lower_ascii(F.col("text"))))
    rows = merkle.manifest(table(spark, sf_dir, "documents"), carried={"tampered": tampered})
    start = F.coalesce("tampered", "leaf")
    found = rows.select("doc_id", "leaf", "subroot", "root", merkle.proof_digest(F.col("path")).alias("proof_sha256"), merkle.folded(start, F.col("path")).alias("folded_root"))
    return found.withColumn("verified", F.col("folded_root") == F.col("root"))


def op13_spelling_variants(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spelling.spelling_groups(spelling.word_counts(table(spark, sf_dir, "documents"), every=97))


def language_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose language is determined."""
    return langid.identified_rows(docs, _language_model(docs), LEAST_LANGUAGE_SCORE)


def near_copy_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near copies."""
    return ngramjoin.one_of_each(docs)


def decontamination_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without a passage of the benchmark."""
    return decontaminate.clean_rows(docs, table(spark, sf_dir, "benchmark"))


def mixing_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents as often as the mix takes them."""
    return mixing.mixed_rows(docs)


def token_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The files' contents: where each document's ids begin, how many there are, and their checksum."""
    return tokenids.token_files(docs, tokenizer_file())


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {
        f.__name__: f
        for f in (
            op1_language_id, op2_decontaminate, op3_line_dedup, op4_warc, op5_mixing, op6_token_ids,
            op7_exact_dedup, op8_secret_scan, op9_toxicity, op10_ngram_join, op11_substring_dedup, op12_merkle_manifest,
            op13_spelling_variants,
        )
    }

"""The queries of these operators and their SQL counterparts."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from vigilframe.llm import alignment, codes, decontam, katz, langid, lines, mixing, neardup, packing, quality, sampling, tokens, toxicity, vectors
from vigilframe.llm.ship import ship
from vigilframe.llm.text import remainder


def _read(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    ship(spark)
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op1_near_duplicates(spark: SparkSession, sf_dir: str) -> DataFrame:
    return neardup.near_duplicates(_read(spark, sf_dir, "documents"))


def op2_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = mixing.mix(_read(spark, sf_dir, "documents"))
    taken = (F.col("whole") * F.col("size") + F.col("part")).cast("long")
    return rows.select("doc_id", "size", "source_size", "target", taken.alias("taken"))


def op3_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, held = _read(spark, sf_dir, "documents"), remainder("doc_id", 5) == 0
    sample = sampling.labelled(docs, _read(spark, sf_dir, "labels"), "quality", ~held, 4000)
    scored = quality.score(docs, quality.train(sample))
    return scored.select("doc_id", held.alias("held_out"), "score", (F.col("score") >= 0.3).cast("int").alias("predicted"))


def op4_language_model(spark: SparkSession, sf_dir: str) -> DataFrame:
    return katz.score(_read(spark, sf_dir, "documents"), remainder("doc_id", 7) == 2)


def op5_language(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, held = _read(spark, sf_dir, "documents"), remainder("doc_id", 4) == 2
    found = langid.identify(docs, langid.train(docs, ~held))
    return found.select("doc_id", held.alias("held_out"), "lang_pred", "score")


def encoder() -> tokens.Encoder:
    import public_tokenizers

    return tokens.Encoder(str(public_tokenizers.path("byte_bpe_50k.json")))


def op6_token_ids(spark: SparkSession, sf_dir: str) -> DataFrame:
    path, manifest = tokens.write_tokens(_read(spark, sf_dir, "documents"), encoder())
    return tokens.read_tokens(path, manifest)


def op7_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, held = _read(spark, sf_dir, "documents"), remainder("doc_id", 4) == 2
    sample = sampling.labelled(docs, _read(spark, sf_dir, "labels"), "toxic", ~held, 12_000)
    scored = toxicity.score(docs, toxicity.train(sample))
    return scored.select("doc_id", held.alias("held_out"), "score", (F.col("score") >= 0.3).cast("int").alias("predicted"))


def op8_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontam.contaminated(_read(spark, sf_dir, "documents"), _read(spark, sf_dir, "benchmark"))


def op9_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = lines.dedup_lines(_read(spark, sf_dir, "documents").select("doc_id", "text"))
    return found.select("doc_id", "n_lines", "n_dropped", F.sha2("kept_text", 256).alias("kept_sha256"))


def op10_near_vectors(spark: SparkSession, sf_dir: str) -> DataFrame:
    return vectors.near_vectors(_read(spark, sf_dir, "embeddings"))


def op11_vector_codes(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows, books = codes.compressed(_read(spark, sf_dir, "embeddings"))
    code = F.lower(F.hex("codes")).alias("code")
    return rows.select(F.col("id").alias("vec_id"), code, "error", "label_error", F.lit(books.digest()).alias("codebooks_sha256"))


def op12_alignment(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers

    a, b = (str(public_tokenizers.path(name)) for name in ("byte_bpe_50k.json", "piece_bpe_32k.model"))
    return alignment.align(_read(spark, sf_dir, "documents"), a, b).documents()


def op13_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers

    return packing.placed(packing.cut(_read(spark, sf_dir, "documents"), str(public_tokenizers.path("word_bpe_49k.json"))))


QUERIES = {
    f.__name__: f
    for f in (
        op1_near_duplicates, op2_mixing, op3_quality, op4_language_model, op5_language, op6_token_ids, op7_toxicity, op8_decontamination, op9_line_dedup,
        op10_near_vectors, op11_vector_codes, op12_alignment, op13_packing,
    )
}

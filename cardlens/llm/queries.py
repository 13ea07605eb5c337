"""One query for each operator of this package, over whole tables."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from cardlens.llm import (
    ann_forest, centroid_clusters, chat_format, embedding_dedup, fill_in_middle, jaccard_join, language_id,
    license_scan, line_dedup, lm_scoring, mixing, quality, sentencepiece_codec,
)
from cardlens.llm.tables import table


def remainder(divisor: int) -> Column:
    """crc32 of the id as text, by a divisor; rows without id count as remainder -1."""
    return F.coalesce(F.crc32(F.col("doc_id").cast("string")) % divisor, F.lit(-1))


def op1_sentencepiece(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Number of ids, a hash of them, and whether decoding them gives the text again."""
    codec = sentencepiece_codec.SentencePiece(sentencepiece_codec.default_model_path(spark))
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    both = docs.withColumn("both", codec.round_trip(F.col("text")))
    encoded = both.select("doc_id", "text", "both.ids", "both.decoded")
    # the blank sign of the pieces stands for a blank in a text as well
    same = F.col("decoded").eqNullSafe(F.translate("text", "\u2581", " "))
    return encoded.select(
        "doc_id",
        F.when(F.col("ids").isNull(), 0).otherwise(F.size("ids")).cast("bigint").alias("n_tokens"),
        F.xxhash64("ids").alias("ids_hash"),
        same.alias("round_trip"),
    )


def op2_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    model = language_id.train(docs.filter(remainder(5) != 0).select("text", "lang"))
    guess = language_id.identify(F.col("text"), model)
    return docs.select("doc_id", (remainder(5) == 0).alias("held_out"), guess.alias("g")).select(
        "doc_id", "held_out", "g.lang_pred", "g.score"
    )


def op3_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text", "source")
    mixed = mixing.with_copies(docs)
    return mixed.select(
        "doc_id", "mix.size", "mix.source_size", "mix.target",
        (F.col("mix.size") * F.col("mix.copies")).alias("taken"),
    )


def op4_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return jaccard_join.jaccard_components(table(spark, sf_dir, "documents"))


def op5_lm_scoring(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    held_out = remainder(7) == 2
    return lm_scoring.score_documents(docs, held_out).withColumn("held_out", held_out)


def op6_chat_format(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Digests of the rendered pairs, and how many characters of each completion are trained on."""
    pairs = chat_format.neighbouring_pairs(table(spark, sf_dir, "conversations"))

    def trained(spans: str) -> Column:
        lengths = F.transform(spans, lambda s: s["end"] - s["start"])
        return F.aggregate(lengths, F.lit(0), lambda x, y: x + y).cast("bigint")

    return chat_format.preference_pairs(pairs).select(
        "pair_id", F.col("prompt_turns").cast("bigint").alias("prompt_turns"),
        *[F.md5(c).alias(f"{c}_md5") for c in ("prompt", "chosen", "rejected")],
        trained("chosen_spans").alias("chosen_trained"), trained("rejected_spans").alias("rejected_trained"),
    )


def op7_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Licences of every document with a match, in the order in which they occur."""
    docs = table(spark, sf_dir, "documents").select("doc_id", license_scan.find_licenses(F.col("text")).alias("found"))
    names = F.transform("found", lambda m: m["license"])
    least = F.array_min(F.transform("found", lambda m: m["containment"]))
    return docs.select(
        "doc_id", F.size("found").cast("bigint").alias("n_matches"), F.array_join(names, ", ").alias("licenses"),
        F.get(F.transform("found", lambda m: m["start"]), F.lit(0)).alias("first_start"), least.alias("least_containment"),
    )


def op8_ann_forest(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ann_forest.nearest(table(spark, sf_dir, "embeddings"), F.col("vec_id") % 100 == 0)


def op9_embedding_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return embedding_dedup.near_duplicates(table(spark, sf_dir, "embeddings"))


def op10_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    learning = docs.filter(remainder(3) != 1)
    model = quality.train(learning, table(spark, sf_dir, "labels").filter(remainder(3) != 1))
    scored = docs.select(
        "doc_id", (remainder(3) == 1).alias("held_out"),
        quality.quality_score(F.col("text"), model).alias("score"),
    )
    return scored.withColumn("predicted", (F.col("score") >= 0.5).cast("int"))


def op11_fill_in_middle(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Digests of the rearranged texts, and of what is rebuilt from these."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    cut = docs.select("doc_id", fill_in_middle.fill_in_middle(F.col("text"), F.col("doc_id")).alias("fim"))
    restored = fill_in_middle.restore(F.col("fim.output"), F.col("fim.form"))
    return cut.select(
        "doc_id", "fim.n", "fim.form", "fim.prefix_chars", "fim.middle_chars",
        F.sha2("fim.output", 256).alias("output_sha256"), F.sha2(restored, 256).alias("restored_sha256"),
    )


def op12_centroid_clusters(spark: SparkSession, sf_dir: str) -> DataFrame:
    return centroid_clusters.cluster_vectors(table(spark, sf_dir, "embeddings"))


def op13_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = line_dedup.drop_repeated_lines(table(spark, sf_dir, "documents").select("doc_id", "text"))
    return docs.select("doc_id", "n_lines", "n_dropped", F.sha2("kept", 256).alias("kept_sha256"))


QUERIES = {
    "op1_sentencepiece": op1_sentencepiece,
    "op2_language_id": op2_language_id,
    "op3_mixing": op3_mixing,
    "op4_jaccard_join": op4_jaccard_join,
    "op5_lm_scoring": op5_lm_scoring,
    "op6_chat_format": op6_chat_format,
    "op7_license_scan": op7_license_scan,
    "op8_ann_forest": op8_ann_forest,
    "op9_embedding_dedup": op9_embedding_dedup,
    "op10_quality": op10_quality,
    "op11_fill_in_middle": op11_fill_in_middle,
    "op12_centroid_clusters": op12_centroid_clusters,
    "op13_line_dedup": op13_line_dedup,
}

"""One query per corpus operator, over its whole table, with its reference SQL where SQL can express it."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import cut_lineage, scratch_path
from . import brown, chat_format, common, decontaminate, line_dedup, line_quality, lsh_forest, oracles, packing, phrases, private_data, sharding, toxicity, warc, whitening


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder.rstrip('/')}/{name}.parquet")


def op1_spaced_seeds(spark: SparkSession, folder: str) -> DataFrame:
    """Documents that hold a benchmark passage, with the item."""
    docs = table(spark, folder, "documents").select("doc_id", "text")
    return decontaminate.contaminated(docs, table(spark, folder, "benchmark")).select("doc_id", "item_id", "n_equal")


def op2_feistel_shards(spark: SparkSession, folder: str) -> DataFrame:
    """All documents in 24 shards; rows are numbered by id, then by text."""
    docs = table(spark, folder, "documents")
    text = F.coalesce("text", F.lit(""))
    narrow = docs.select("doc_id", (F.octet_length(text) + 8).cast("long").alias("size"), F.crc32(text.cast("binary")).alias("text_crc32"))
    placed = sharding.assign(narrow, 24, [F.col("doc_id"), F.col("text_crc32"), F.col("size")])
    return placed.select("row.*", F.lit("rows").alias("law"), "shard", "slot", F.lit(None).cast("int").alias("grown_shard"), "number")


def op3_line_frequency(spark: SparkSession, folder: str) -> DataFrame:
    """Base counts and verdict of every document."""
    found = line_quality.judge(table(spark, folder, "documents").select("doc_id", "source", "text"))
    return found.selectExpr("row.doc_id doc_id", *line_quality.COUNTS, "base_failed", "kept", "n_removed", "n_left")


def op4_brown_classes(spark: SparkSession, folder: str) -> DataFrame:
    """Language-model scores of all documents, learnt from six sevenths of them."""
    held_out = common.fold("doc_id", 7) == 2
    return brown.score(table(spark, folder, "documents"), held_out).withColumnRenamed("id", "doc_id")


def op5_lsh_forest(spark: SparkSession, folder: str) -> DataFrame:
    """Classes of near-duplicate documents."""
    found = lsh_forest.cluster(table(spark, folder, "documents").select("doc_id", "text"))
    return found.selectExpr("row.doc_id doc_id", "n_shingles", "component_id", "coalesce(row.doc_id = component_id, false) kept")


def op6_weak_supervision(spark: SparkSession, folder: str) -> DataFrame:
    """Personal data of all documents: base spans and those the classifier adds."""
    found = private_data.personal_data(table(spark, folder, "documents").select("doc_id", "text"))
    counts = [private_data.count_of("base", k).cast("long").alias(f"n_{name}") for k, name in enumerate(private_data.KINDS[:4])]
    base = private_data.spelled(F.col("base"))
    return found.select("row.doc_id", *counts, F.sha2(base, 256).alias("base_sha256"), private_data.spelled(F.col("spans")).alias("spans"))


def op7_vector_packing(spark: SparkSession, folder: str) -> DataFrame:
    """Every document's ids in sequences of at most 1024."""
    found = packing.pack(table(spark, folder, "documents").select("doc_id", "text"))
    return found.select("row.doc_id", "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset")


def op8_warc_index(spark: SparkSession, folder: str) -> DataFrame:
    """All pages written to archives and read back through the index."""
    archives = scratch_path(spark, "warc")
    index = warc.write_archives(table(spark, folder, "pages"), archives)
    read = warc.read_records(index, archives, keep_payload=False)
    owners = index.select("uid", "page_id", "refers_to")
    return read.join(owners, "uid").select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")


def op9_counterfactual(spark: SparkSession, folder: str) -> DataFrame:
    """Toxicity of all documents, learnt from four fifths of the labelled ones."""
    docs = table(spark, folder, "documents").select("doc_id", "text")
    held_out = common.fold("doc_id", 5) == 0
    model = toxicity.learn(docs, table(spark, folder, "labels"), ~held_out)
    found = toxicity.score(docs, model).select("row.doc_id", "score")
    return found.select("doc_id", held_out.alias("held_out"), "score", (F.col("score") >= 0.5).cast("int").alias("predicted"))


def op10_fuzzy_lines(spark: SparkSession, folder: str) -> DataFrame:
    """Texts without the lines that copy an earlier one, as digests."""
    found = line_dedup.keep_first_lines(table(spark, folder, "documents").select("doc_id", "text"))
    return found.selectExpr("row.doc_id doc_id", "n_lines", "n_removed", "length(clean) n_chars", "crc32(cast(clean as binary)) text_crc32")


def op11_whitened_components(spark: SparkSession, folder: str) -> DataFrame:
    """All embeddings projected on their 16 leading components, with unit variance."""
    found = whitening.whiten(table(spark, folder, "embeddings").select("vec_id", "embedding"))
    return found.withColumnRenamed("id", "vec_id").withColumn("deviation", F.col("deviation").cast("long"))


def op12_phrase_mining(spark: SparkSession, folder: str) -> DataFrame:
    """The first 2000 collocations of each language."""
    return phrases.collocations(table(spark, folder, "documents").select("text", "lang"))


def op13_chat_formatting(spark: SparkSession, folder: str) -> DataFrame:
    """All conversations and one of control strings, formatted and read back."""
    said = "</s>[INST] ok [/INST]"
    probe = spark.createDataFrame([(-1, 0, "user", said), (-1, 1, "assistant", said)], "conv_id long, turn long, role string, text string")
    turns = table(spark, folder, "conversations").select("conv_id", "turn", "role", "text").unionByName(probe)
    return chat_format.digests(cut_lineage(chat_format.format_parts(turns), "formatted"))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    f.__name__: f
    for f in (
        op1_spaced_seeds,
        op2_feistel_shards,
        op3_line_frequency,
        op4_brown_classes,
        op5_lsh_forest,
        op6_weak_supervision,
        op7_vector_packing,
        op8_warc_index,
        op9_counterfactual,
        op10_fuzzy_lines,
        op11_whitened_components,
        op12_phrase_mining,
        op13_chat_formatting,
    )
}

ORACLE: dict[str, str] = {
    "op1_spaced_seeds": oracles.OP1,
    "op3_line_frequency": oracles.OP3,
    "op5_lsh_forest": oracles.OP5,
    "op8_warc_index": oracles.OP8,
    "op12_phrase_mining": oracles.OP12,
    "op13_chat_formatting": oracles.OP13,
}


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return dict(QUERIES)


def oracle_sql() -> dict[str, str]:
    return dict(ORACLE)

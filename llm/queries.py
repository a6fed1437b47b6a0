"""One query per operator over its whole table, with production parameters."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from llm.decontaminate import matches
from llm.kneser_ney import quality_classified
from llm.language import fit, predicted, remainder
from llm.lines import line_dedup
from llm.near_dedup import near_duplicates
from llm.negatives import hard_negatives
from llm.passages import RUN_WORDS, without_repeats
from llm.quality import quality
from llm.scratch import Scratch
from llm.shards import reshard, rewritten, sized, write_shards
from llm.shipping import ship
from llm.token_files import stored_tokens
from llm.tokens import encoded
from llm.warc import archived
from llm.whitening import whitened

Query = Callable[[SparkSession, str], DataFrame]
REGISTERED: dict[str, Query] = {}


def query(build: Query) -> Query:
    """Register a query under its function name."""
    REGISTERED[build.__name__] = build
    return build


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    ship(spark)
    return spark.read.parquet(f"{folder}/{name}.parquet")


@query
def op4_minhash_near_dedup(spark, folder):
    """Links of 0.8 or more over four-word shingles."""
    found = near_duplicates(table(spark, folder, "documents"), size=4, threshold=0.8)
    return found.select("doc_id", "n_shingles", "component_id", "kept")


@query
def op3_quality_rules(spark, folder):
    """Base measures and line frequency per source."""
    judged = quality(table(spark, folder, "documents"))
    return judged.select(
        "doc_id",
        "n_words",
        "word_chars",
        "n_symbols",
        "n_dup_lines",
        "n_repeat_words",
        "n_common_lines",
        "n_words_left",
        "base_failed",
        "kept",
    )


@query
def op1_benchmark_decontamination(spark, folder):
    """Hits of ten-word windows of benchmark items in documents."""
    found = matches(table(spark, folder, "documents"), table(spark, folder, "benchmark"), window=10)
    return found.select(
        "doc_id",
        "n_words",
        "n_hit",
        F.size("item_ids").cast("bigint").alias("n_items"),
        F.sha2(F.array_join("item_ids", ","), 256).alias("items_sha256"),
        (F.col("n_hit") > 0).alias("contaminated"),
    )


# Where the public vocabularies are; a parameter of the operator.
PIECES = "/opt/tokenizers/piece_bpe_32k.model"


@query
def op9_sentencepiece_tokens(spark, folder):
    """Tokens of all documents, and whether they decode to the text again."""
    found = encoded(table(spark, folder, "documents").select("doc_id", "text"), PIECES)
    return found.select(
        "doc_id", "token_ids", "n_tokens", "n_byte_tokens", "ids_crc32", "round_trip"
    )


@query
def op2_line_dedup(spark, folder):
    """Documents without repeated lines."""
    found = line_dedup(table(spark, folder, "documents"))
    return found.select(
        "doc_id",
        "n_lines",
        "n_removed",
        F.length("text").cast("bigint").alias("n_chars_left"),
        F.md5("text").alias("text_md5"),
    )


# Shards before and after resharding.
OLD_SHARDS, NEW_SHARDS = 32, 40


@query
def op7_min_cost_flow_sharding(spark, folder):
    """From 32 shards by key to 40 of near-equal bytes, moving the fewest bytes."""
    scratch = Scratch(spark, "shards")
    docs = table(spark, folder, "documents").select("doc_id", "text")
    old = F.pmod(F.crc32(F.coalesce(F.col("doc_id").cast("string"), F.lit(""))), F.lit(OLD_SHARDS))
    stored = write_shards(docs, old, scratch.new_path())
    rows = reshard(scratch.write(sized(stored)), OLD_SHARDS, NEW_SHARDS, scratch)
    # What follows is read from the files that hold the shards after the move.
    out = rewritten(stored, rows, scratch.new_path(), scratch)
    out = out.withColumn("text_crc32", F.crc32(F.coalesce("text", F.lit(""))))
    return out.select(
        "doc_id",
        "size",
        "text_crc32",
        F.lit("bytes").alias("law"),
        "shard",
        "slot",
        F.lit(None).cast("int").alias("grown_shard"),
        "old_shard",
    )


@query
def op8_warc_archives(spark, folder):
    """All pages written to WARC files and read back through the merged index."""
    # The tables have no capture times; a page's number stands for its second.
    second = F.coalesce(F.pmod(F.col("page_id"), F.lit(31_536_000)), F.lit(0)) + 1_704_067_200
    captured = F.date_format(F.timestamp_seconds(second), "yyyy-MM-dd'T'HH:mm:ss'Z'")
    index = archived(table(spark, folder, "pages"), captured)
    return index.select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")


@query
def op10_repeated_passages(spark, folder):
    """Documents without passages that repeat across documents."""
    docs = table(spark, folder, "documents").select("doc_id", "text")
    return without_repeats(docs, threshold=0.8, exact_words=RUN_WORDS)


@query
def op5_language_id(spark, folder):
    """Languages of all documents, learned from four fifths of them."""
    docs = table(spark, folder, "documents").select("doc_id", "text", "lang")
    held_out = remainder(F.col("doc_id")) == 0
    model = fit(docs.filter(~held_out).select("text", "lang"))
    rows = docs.select("doc_id", "text", held_out.alias("held_out"))
    return predicted(rows, model).select("doc_id", "held_out", "lang_pred", "score")


@query
def op6_quality_perplexity(spark, folder):
    """Perplexity of all documents under trusted text, and thresholds by language."""
    docs = table(spark, folder, "documents").select("doc_id", "lang", "text")
    found = quality_classified(docs, table(spark, folder, "labels"))
    return found.select("doc_id", "lang", "perplexity", "threshold", "kept")


@query
def op11_embedding_whitening(spark, folder):
    """The first 32 whitened components of all vectors."""
    return whitened(table(spark, folder, "embeddings"), 32)


# The tokenizer of the token files; a parameter of the operator.
BYTE_PIECES = "/opt/tokenizers/byte_bpe_50k.json"


@query
def op12_seekable_token_files(spark, folder):
    """All documents as token files in zstandard frames, read back from these."""
    found = stored_tokens(table(spark, folder, "documents"), BYTE_PIECES)
    return found.select("doc_id", "start", "n_tokens", "ids_crc32")


@query
def op13_hard_negatives(spark, folder):
    """Hard negatives of every fiftieth vector; some labels are changed first."""
    vectors = table(spark, folder, "embeddings")
    moved = F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10)
    relabelled = vectors.withColumn("label", F.coalesce(moved, F.col("label")))
    return hard_negatives(relabelled, F.col("vec_id") % 50 == 0)

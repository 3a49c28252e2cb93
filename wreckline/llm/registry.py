"""Queries ``opN_<name>``: each applies one operator, with production parameters, to its
whole table. ``ORACLE_SQL`` has the DuckDB SQL of those that SQL can express."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from pyspark.sql import functions as F

from ..session import shared_dir
from .common import staged, table
from .conversation_repair import repair_conversations, text_digests
from .decontaminate import benchmark_hits
from .filter_audit import filter_audit, standard_filters
from .html_text import extract_main_text
from .language_id import identify_language, markup_language, page_text
from .line_crf import fit_line_model, score_quality
from .mixing import mix_sources
from .ngram_join import ngram_components
from .oracle_filters import filter_audit_sql
from .oracle_mixing import mixing_sql
from .oracle_ngram import ngram_join_sql
from .oracle_rules import quality_rules_sql
from .quality_rules import quality_rules
from .secrets import fit_markov, labelled_samples, secret_scan
from .sharding import edit_slot_map, load_slot_map, place_records, record_runs, save_slot_map, slot_bytes
from .toxicity import fit_toxicity, score_toxicity
from .warc import archive_folder, normalise_archives, read_archives, write_archives

SHARDS = 24


def _held_out():
    return F.pmod(F.crc32(F.encode(F.col("doc_id").cast("string"), "UTF-8")), F.lit(5)) == 0


def op1_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    files = write_archives(table(spark, sf_dir, "pages"), archive_folder(spark))
    return read_archives(normalise_archives(files))


def op2_html_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    return extract_main_text(table(spark, sf_dir, "pages"))


def op3_ngram_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ngram_components(table(spark, sf_dir, "documents"))


def op4_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = quality_rules(table(spark, sf_dir, "documents").select("doc_id", "text"))
    return out.select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept"
    )


def op5_line_crf(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    labels = table(spark, sf_dir, "labels").where(~_held_out()).select("doc_id", "quality")
    model = fit_line_model(docs, labels)
    return score_quality(docs, model).select(
        "doc_id", _held_out().alias("held_out"), "score", (F.col("score") >= 0.3).cast("int").alias("predicted"))


def op6_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents (declared language: their metadata; host: their source) and pages
    (declared language: the html element; address: the url), each judged by its own table."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text", "lang", "source")
    found = identify_language(docs, F.col("text"), F.col("lang"), F.col("source"))
    pages = table(spark, sf_dir, "pages").select(
        "page_id", "url", page_text(F.col("html")).alias("text"), markup_language(F.col("html")).alias("declared"))
    read = identify_language(pages, F.col("text"), F.col("declared"), F.col("url"))
    none = F.lit(None).cast("long")
    return found.select("doc_id", none.alias("page_id"), "language", "posterior", "kept").unionByName(
        read.select(none.alias("doc_id"), "page_id", "language", "posterior", "kept"))


def op7_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return benchmark_hits(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def op8_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A first map of one shard less is stored, edited to ``SHARDS`` and stored as the next
    version; the records go where the newest stored version says."""
    store = shared_dir(spark, "slot-maps")
    runs = staged(record_runs(table(spark, sf_dir, "documents")), "shard-runs")
    totals = staged(slot_bytes(runs), "slot-bytes")
    save_slot_map(edit_slot_map(totals, SHARDS - 1), store, 1)
    save_slot_map(edit_slot_map(totals, SHARDS, load_slot_map(spark, store)), store, 2)
    placed = place_records(runs, load_slot_map(spark, store))
    return placed.select(
        "doc_id", "size", "text_crc32", F.lit("bytes").alias("law"), "shard", "slot",
        F.lit(None).cast("int").alias("grown_shard"), "vslot")


def op9_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    found = secret_scan(docs, fit_markov(labelled_samples(docs)))
    return found.select("doc_id", "n_assign", "n_access", "n_hex", "base_sha256", "spans", "n_markov")


def op10_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text", "source")
    return mix_sources(docs).select("doc_id", "size", "source_size", "target", "taken")


def op11_filter_audit(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text", "lang")
    return filter_audit(docs, standard_filters(F.col("text")), F.col("lang"), F.col("doc_id"), F.col("text"),
                        table(spark, sf_dir, "labels"))


def op12_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    labels = table(spark, sf_dir, "labels").where(~_held_out()).select("doc_id", "toxic")
    model = fit_toxicity(docs, labels)
    return score_toxicity(docs, model).select(
        "doc_id", _held_out().alias("held_out"), "score", (F.col("score") >= 0.5).cast("int").alias("predicted"))


def damaged(conversations: DataFrame) -> DataFrame:
    """The conversations with one row in five dropped, emptied, cut, repeated or given to the user."""
    def filled(c: str):
        return F.coalesce(F.col(c).cast("string"), F.lit(" "))

    fate = F.pmod(F.crc32(F.encode(F.concat(filled("conv_id"), F.lit(":"), filled("turn")), "UTF-8")), F.lit(20))
    text = F.when(F.col("fate") == 1, "").when(F.col("fate") == 2, F.regexp_replace("text", "[.!?]", "")).otherwise(F.col("text"))
    rows = conversations.select("conv_id", "turn", filled("role").alias("role"), filled("text").alias("text"), fate.alias("fate"))
    rows = rows.where("fate <> 0").withColumn("copy", F.explode(F.expr("IF(fate = 3, array(1, 2), array(1))")))
    return rows.select("conv_id", "turn", F.when(F.col("fate") == 4, "user").otherwise(F.col("role")).alias("role"), text.alias("text"))


def op13_conversation_repair(spark: SparkSession, sf_dir: str) -> DataFrame:
    given = table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    summary, repaired = repair_conversations(damaged(given), conversations=given)
    digests = text_digests(repaired, summary).withColumnRenamed("conv", "c")
    return summary.join(digests, F.col("conv").eqNullSafe(F.col("c"))).select(
        F.col("conv").alias("conv_id"), "gaps", "blank", "duplicate", "truncated", "illegal", "cost", "audit",
        F.col("sha256").alias("repaired_sha256"))


QUERIES = {
    "op1_warc": op1_warc,
    "op2_html_text": op2_html_text,
    "op3_ngram_join": op3_ngram_join,
    "op4_quality_rules": op4_quality_rules,
    "op5_line_crf": op5_line_crf,
    "op6_language_id": op6_language_id,
    "op7_decontamination": op7_decontamination,
    "op8_sharding": op8_sharding,
    "op9_secret_scan": op9_secret_scan,
    "op10_mixing": op10_mixing,
    "op11_filter_audit": op11_filter_audit,
    "op12_toxicity": op12_toxicity,
    "op13_conversation_repair": op13_conversation_repair,
}

ORACLE_SQL = {
    "op3_ngram_join": ngram_join_sql(),
    "op4_quality_rules": quality_rules_sql(),
    "op10_mixing": mixing_sql(),
    "op11_filter_audit": filter_audit_sql(),
}

"""The queries of the training-data operators, each over its whole tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import alignment, encoding, language, leakage, matching, packing, residue, turns
from .common import table


def _language(spark: SparkSession, d: str) -> tuple[DataFrame, language.Network]:
    documents = table(spark, d, "documents").select("doc_id", "text", "lang", "detectedlanguage")
    return documents, language.fit(documents, table(spark, d, "eval_items").select("lang", "text"))


def p1_languages(spark: SparkSession, d: str) -> DataFrame:
    """Language of every document and of whole sentences in other languages, with confidence."""
    documents, net = _language(spark, d)
    return language.detect(documents, net)


def p1_found(spark: SparkSession, d: str) -> DataFrame:
    documents, net = _language(spark, d)
    excluded = residue.residue_spans(documents).select("doc_id").distinct()
    found = language.corrections(documents, net)
    return found.join(excluded, "doc_id", "left_anti").select("doc_id", "seg_no", "lang_code").distinct()


def _matches(spark: SparkSession, d: str) -> DataFrame:
    left, right = matching.film_sides(table(spark, d, "titles"), table(spark, d, "douban_subjects"))
    return matching.matches(left, right)


def p2_matches(spark: SparkSession, d: str) -> DataFrame:
    """The pairs of the same film with their confidence."""
    return _matches(spark, d).select(F.col("left_id").cast("bigint").alias("tmdb_id"), F.col("right_id").alias("douban_id"), F.round("confidence", 6).alias("confidence"))


def p2_found(spark: SparkSession, d: str) -> DataFrame:
    return _matches(spark, d).select(F.col("left_id").cast("bigint").alias("tmdb_id"), F.col("right_id").alias("douban_id")).distinct()


def _damaged(spark: SparkSession, d: str) -> DataFrame:
    documents = table(spark, d, "documents").select("doc_id", "text")
    # repeated captions are looked at where they lie: only what is found is shuffled to be told apart
    cues = table(spark, d, "cues").select("cue_key", "text")
    model = encoding.fit(table(spark, d, "eval_items").select("text"), [(documents, "doc_id", "text"), (cues, "cue_key", "text")])
    own = [encoding.damaged(df, key, "text", model).select(F.lit(name).alias("table_name"), F.col(key).cast("bigint").alias("row_key"), "restored", "spans") for df, key, name in ((documents, "doc_id", "documents"), (cues, "cue_key", "cues"))]
    return own[0].unionByName(own[1])


def p3_repairs(spark: SparkSession, d: str) -> DataFrame:
    """Damaged texts as they were before, as far as they can be given back, with the spans and encodings."""
    found = _damaged(spark, d)
    return found.groupBy("table_name", "row_key").agg(F.min_by(F.struct("restored", "spans"), "restored").alias("r")).select("table_name", "row_key", "r.restored", "r.spans")


def p3_found(spark: SparkSession, d: str) -> DataFrame:
    return _damaged(spark, d).select("table_name", "row_key").distinct()


def _turns(spark: SparkSession, d: str) -> DataFrame:
    captions = turns.captions_of(
        table(spark, d, "cues").select("cue_key", "file_id", "cue_id", "start_time", "end_time", "text", "ingested_at"), table(spark, d, "units").select("file_id", "spans")
    )
    members = turns.cast_of(table(spark, d, "subtitle_files"), table(spark, d, "titles"), table(spark, d, "cast_members"))
    return turns.marked_segments(turns.segments_of(captions, members))


def p4_turns(spark: SparkSession, d: str) -> DataFrame:
    """Clean turns in order, with speaker, time and text."""
    return turns.turns(_turns(spark, d))


def p4_found(spark: SparkSession, d: str) -> DataFrame:
    return _turns(spark, d).where("begins").select("file_id", "cue_id", "speaker_id").distinct()


def p5_sentences(spark: SparkSession, d: str) -> DataFrame:
    """Linked sentences with their score."""
    return alignment.aligned_sentences(table(spark, d, "units"), table(spark, d, "translations"))


def p5_found(spark: SparkSession, d: str) -> DataFrame:
    return alignment.aligned_spans(table(spark, d, "units"), table(spark, d, "translations"))


def p6_pack(spark: SparkSession, d: str) -> DataFrame:
    """Where each document, or piece of one, goes."""
    return packing.pack(table(spark, d, "documents").select("doc_id", "text"), table(spark, d, "pack_profiles"))


def p6_fill(spark: SparkSession, d: str) -> DataFrame:
    """How well the containers of each profile are filled."""
    profiles = table(spark, d, "pack_profiles")
    return packing.fill(packing.pack(table(spark, d, "documents").select("doc_id", "text"), profiles), profiles)


def _leaks(spark: SparkSession, d: str) -> DataFrame:
    return leakage.leaks(table(spark, d, "documents").select("doc_id", "text"), table(spark, d, "eval_items").select("item_id", "text"))


def p7_spans(spark: SparkSession, d: str) -> DataFrame:
    """What to remove from each document, over all items."""
    return leakage.removal_spans(_leaks(spark, d))


def p7_found(spark: SparkSession, d: str) -> DataFrame:
    return _leaks(spark, d).select("doc_id", "item_id").distinct()


def p8_residue(spark: SparkSession, d: str) -> DataFrame:
    """Documents with residue: its spans by kind, the share that it covers, and whether to leave the document out."""
    return residue.residue_documents(table(spark, d, "documents").select("doc_id", "text"))


def p8_found(spark: SparkSession, d: str) -> DataFrame:
    return residue.residue_spans(table(spark, d, "documents").select("doc_id", "text")).select("doc_id").distinct()


def queries() -> dict:
    own = (p1_found, p1_languages, p2_found, p2_matches, p3_found, p3_repairs, p4_found, p4_turns, p5_found, p5_sentences, p6_pack, p6_fill, p7_found, p7_spans, p8_found, p8_residue)
    return {f.__name__: f for f in own}


def oracle_sql() -> dict[str, str]:
    """None: learned models, indexes and assignments aren't SQL; tests hold them against brute force, round trips and held-out labels."""
    return {}

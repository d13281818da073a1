"""A training corpus from `documents`: language ID, line dedup, SimHash near-dedup, decontamination, encoding.

Each stage takes (spark, docs, sf_dir) and returns what it keeps; `run` writes that as
Parquet to the shared folder and reads it again as the next stage's docs, and deletes what stages before it wrote. All stages but the last
return the columns of `documents`, whichever they are. An empty table gives an empty result in every stage; ids must be numbers or null.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from voxelloom.llm import decontam, langcodes, linededup, piecetable, simhash
from voxelloom.llm.queries import PIECE_MODEL
from voxelloom.llm.shared import drop, materialize, table, temporary


def language_id(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without a letter, null and empty ones among them, and those whose language is ambiguous, go; repeated rows are judged each, null ids teach nothing."""
    judged = langcodes.identify(docs, keep=tuple(c for c in docs.columns if c != "text"), keep_text=True)
    return judged.where("lang_pred <> 'und' and not ambiguous").select(*[F.col("text") if c == "text" else F.col("row")[c].alias(c) for c in docs.columns])


def line_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Repeated lines go from all documents but the last that holds them; every row stays, a null text as an empty one. Rows with null ids lose nothing, rows of one id count as one document."""
    kept = linededup.dedup_lines(docs, keep=tuple(c for c in docs.columns if c not in ("text", "n_chars")))
    new = {"text": F.col("kept_text"), "n_chars": F.length("kept_text").cast(docs.schema["n_chars"].dataType)}
    return kept.select(*[(new[c] if c in new else F.col("row")[c]).alias(c) for c in docs.columns])


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each group of near copies the smallest id stays. Of several rows of that id, one for each fingerprint does: the one whose text has the smallest hash, and of equal texts the least row.
    Null and empty texts are near copies of each other. Rows with null ids are in no group and stay."""
    found = simhash.near_duplicates(docs, keep_mark=True)
    stay = found.where("doc_id = component_id").groupBy("doc_id", "fingerprint").agg(F.min("mark").alias("mark"))
    columns = docs.columns
    marked = docs.where("doc_id is not null").select(F.struct(*columns).alias("row"), F.col("doc_id").alias("id"), F.xxhash64("text").alias("mark"))
    once = marked.join(stay.hint("merge"), (F.col("id") == stay["doc_id"]) & (marked["mark"] == stay["mark"]), "left_semi").groupBy("id", "mark").agg(F.min("row").alias("row"))
    return once.select(*[F.col("row")[c].alias(c) for c in columns]).unionByName(docs.where("doc_id is null"))


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold a copy of a benchmark item go, with all rows of their id; null and empty texts and null ids stay."""
    return decontam.clean(docs, table(spark, sf_dir, "benchmark")).select(*docs.columns)


def encoding(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token ids of every text that is left, with digests of ids and of the text decoded from them; a null text counts as empty, repeated rows give repeated results."""
    return piecetable.encode_decode(docs, PIECE_MODEL, keep_ids=True)


STAGES = [
    ("language_id", language_id),
    ("line_dedup", line_dedup),
    ("simhash_near_dedup", near_dedup),
    ("decontamination", decontamination),
    ("sentencepiece", encoding),
]

#: SQL expresses neither the language model, XXH64, alignment nor piece encoding; tests/llm holds the stages against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        with temporary():
            kept = materialize(stage(spark, docs, sf_dir), f"pipeline-{name}", keep=True)
        drop(docs)
        docs = kept
    return docs

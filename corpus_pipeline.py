"""From documents to packed training sequences, in five stages.

Each stage takes (spark, docs, sf_dir) and returns a DataFrame, which is written
and read back as the next one's docs.  All but the last return the columns of
documents.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from millrace.llm.base import materialize, table
from millrace.llm.jaccard_join import keep_one
from millrace.llm.mixing import mix_sources
from millrace.llm.packing import pack
from millrace.llm.quality_rff import score_quality
from millrace.llm.suffix_dedup import remove_repeats


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the classifier rejects go."""
    whole = docs.select(F.struct(*docs.columns).alias("doc"), "doc_id", "text")  # no column's name meets one of the operator's
    scored = score_quality(whole, table(spark, sf_dir, "labels"), keep=("doc",))
    return scored.filter("predicted = 1").select(*[F.col("doc")[c].alias(c) for c in docs.columns])


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group stays; documents link from a similarity of 0.8 of their five-word shingles."""
    return keep_one(docs, n_words=5, percent=80)


def repeated_strings(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Strings of 200 bytes that occur again go from the texts; a character that was cut in two goes with them."""
    rest = [c for c in docs.columns if c != "text"]
    named = docs.select(F.struct(*rest).alias("doc"), "text")
    out = remove_repeats(named, id_col="doc", characters=True).select("doc_id", "n_removed", F.col("kept").cast("string").alias("text"))
    out = out.withColumn("text", F.make_valid_utf8("text"))  # changes only bytes that were no UTF-8 in the source
    cols = {c: F.col("doc_id")[c] for c in rest} | {"text": F.col("text")}
    if "n_chars" in rest:
        cols["n_chars"] = F.when(F.col("n_removed") > 0, F.char_length("text").cast(docs.schema["n_chars"].dataType)).otherwise(F.col("doc_id")["n_chars"])
    return out.select(*[cols[c].alias(c) for c in docs.columns])


def mixture(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Each document as often as its source's target asks for.

    Rows are told apart by id, source and text, so ids may be null or shared; those
    that agree in all three are taken equally often.
    """
    keys = ["doc_id", "source", "text_crc"]
    copies = mix_sources(docs).filter("copies > 0").groupBy(*keys).agg(F.max("copies").alias("__copies")).withColumnsRenamed({k: f"__{k}" for k in keys})
    crc = F.crc32(F.coalesce(F.col("text"), F.lit("")).cast("binary"))
    same = docs["doc_id"].eqNullSafe(copies["__doc_id"]) & docs["source"].cast("string").eqNullSafe(copies["__source"]) & (crc == copies["__text_crc"])
    out = docs.join(copies, same)
    return out.withColumn("__copy", F.explode(F.sequence(F.lit(1).cast("long"), "__copies"))).select(*docs.columns)


def packed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token ids in sequences of 1024."""
    return pack(docs)


STAGES = [
    ("quality classifier", quality),
    ("n-gram Jaccard join", near_duplicates),
    ("suffix-array dedup", repeated_strings),
    ("mixing sources to target weights", mixture),
    ("packing", packed),
]

#: SQL expresses none of the learnt, random or iterated stages; the tests hold them against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = materialize(stage(spark, docs, sf_dir), name.replace(" ", "-"))
    return STAGES[-1][1](spark, docs, sf_dir)

"""The corpus pipeline: toxicity, near duplicates, secrets, packing.

A stage takes (spark, docs, sf_dir) and returns a DataFrame; ``run`` writes it as Parquet to
the shared folder and rereads it as the next stage's docs.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lociq.llm import near_join, packing, secrets, toxicity
from lociq.llm.frames import read_table
from lociq.llm.queries import tokenizer_path
from lociq.plans.storage import Stages, delete_path, materialise, scratch_cleared, scratch_path


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the toxicity model rejects go. It is fitted on labelled rows of these documents."""
    return toxicity.drop_toxic(docs, toxicity.fit(docs, read_table(spark, sf_dir, "labels")))


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each group that near-duplicate links join, one row stays: the least by id (nulls last) and text digest."""
    classes = near_join.near_classes(docs)
    key = F.struct(F.col("doc_id").isNull().alias("nameless"), "doc_id", "digest")
    least = classes.groupBy("root").agg(F.min(key).alias("least")).select("least.doc_id", "least.digest")
    # rows that share id and text are alike but for other columns: any one of them stays
    often = classes.groupBy("doc_id", "digest").agg(F.count(F.lit(1)).alias("n"))
    same = lambda a, b: a["doc_id"].eqNullSafe(b["doc_id"]) & a["digest"].eqNullSafe(b["digest"])
    kept = materialise(often.join(least, same(often, least), "left_semi"), "kept")
    keyed = docs.withColumn("digest", near_join.text_digest())
    once, more = kept.filter("n = 1"), kept.filter("n > 1")
    tied = keyed.join(more, same(keyed, more), "left_semi").dropDuplicates(["doc_id", "digest"])
    return keyed.join(once, same(keyed, once), "left_semi").unionByName(tied).select(*docs.columns)


def redact_secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Every secret span is replaced by its kind in brackets, and n_chars follows; no document goes."""
    return secrets.redact_texts(docs, tokenizer_path())


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of the packed sequences, with their ids as little-endian unsigned 32-bit integers. Columns of documents are left out but for doc_id."""
    packed = packing.pack_pieces(docs, tokenizer_path())
    return packed.select("doc_id", "start", "length", "ids", F.crc32("ids").alias("ids_crc32"), "doc_tokens", "sequence_id", "offset")


STAGES = [("toxicity", drop_toxic), ("near_duplicates", drop_near_copies), ("secrets", redact_secrets), ("packing", pack)]

#: Model fits, similarity joins and packing aren't said in SQL; tests hold the stages against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str, folder: str | None = None) -> DataFrame:
    """Rows of the last stage.

    With ``folder`` every stage's table stays there, and a run that is started again takes up those
    that are whole, as long as documents, labels and stages before are the same. Without it
    a stage's table goes when the next one is written.
    """
    docs, before = read_table(spark, sf_dir, "documents"), None
    if folder:
        stages, after = Stages(spark, folder), f"{sf_dir}/documents.parquet"
        for name, stage in STAGES:
            docs, after = stages.table(name, lambda stage=stage, docs=docs: stage(spark, docs, sf_dir), inputs=[after, f"{sf_dir}/labels.parquet"]), name
        return docs
    for name, stage in STAGES:
        path = scratch_path(spark, name)
        with scratch_cleared(spark):  # a stage's own tables go when its result is written
            out = stage(spark, docs, sf_dir)
            out.write.option("compression", "zstd").parquet(path)
        docs = spark.read.schema(out.schema).parquet(path)
        if before:
            delete_path(spark, before)
        before = path
    return docs

"""Corpus pipeline: toxicity, near duplicates, secrets, packing.

Every stage is ``(spark, docs, sf_dir) -> DataFrame`` on what the stage
before it kept; its result is written as Parquet in the shared folder and
read again.  All but the last return the columns of ``documents``.

1. ``toxicity`` drops documents the fitted lexicon scores at 0.5 or more.
2. ``near_duplicates`` keeps of each group (five-word shingles, similarity
   0.8 or more) the document of smallest id, once if that row repeats.
   Rows of one id are separate documents unless their texts are near too.
3. ``secrets`` replaces findings by ``[kind]`` and sets n_chars anew; it
   drops no document.
4. ``packing`` cuts the texts' token ids into sequences of 1024 at most.

Null texts count as empty, rows with a null id are never duplicates, and
further columns of ``docs`` pass through the first three stages whatever
their names are.  An empty table goes through all stages.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from arealens.llm import minhash, packing, secret_scan, toxicity
from arealens.llm.base import fresh_name
from arealens.llm.queries import toxicity_model
from arealens.session import materialize
from arealens.sources.tables import read_table

SALTS = 32      # tasks that one group of near duplicates is dealt to


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    model = toxicity_model(read_table(spark, sf_dir, "documents", ["doc_id", "text"]), sf_dir)
    marked = toxicity.score(docs, model)
    score = marked.columns[len(docs.columns)]
    return marked.where(F.col(score) < 0.5).select(*docs.columns)


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    # rows of one id with unlike texts are separate documents; texts without words are alike
    words = F.translate(F.coalesce("text", F.lit("")), " \t\n\r\x0b\x0c", "") != ""
    hashed = F.when(words, F.xxhash64("text")).otherwise(F.lit(0).cast("bigint"))
    document = lambda of: F.when(F.col("doc_id").isNotNull(), F.xxhash64("doc_id", of))
    slim = docs.select("doc_id", "text", hashed.alias("same_text")).withColumn("document", document("same_text"))
    marks = materialize(minhash.near_duplicates(slim, id_col="document", shingle=5, percent=80).select(
        F.col("doc_id").alias("document"), "component_id").where(F.col("document").isNotNull()), "marks")
    # the members of every group: the documents tied to another one, and those they are tied to
    tied = marks.where("document != component_id").select("document", "component_id")
    members = tied.unionByName(tied.select(F.col("component_id").alias("document"), "component_id")).distinct()
    # and its document of smallest id
    key = F.struct("doc_id", "same_text")
    grouped = slim.drop("text").join(members, "document").distinct()
    first = grouped.groupBy("component_id").agg(F.min(key).alias("first"))
    # a group may hold a third of all documents: its members meet their first one in SALTS tasks
    first = first.withColumn("salt", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))))
    salted = grouped.withColumn("salt", F.pmod("document", F.lit(SALTS)).cast("int"))
    # documents whose 64-bit keys are equal by chance all stay
    gone = (salted.join(first, ["component_id", "salt"]).groupBy("document")
            .agg(F.min(key != F.col("first")).alias("gone"), F.count("*").alias("n")).where("gone AND n = 1")
            .select("document"))
    again = marks.groupBy("document").agg(F.count("*").alias("n")).where("n > 1").select("document")
    name, text = fresh_name(docs, "document"), fresh_name(docs, "same_text")
    kept = docs.withColumn(text, hashed).withColumn(name, document(text)).join(gone.withColumnRenamed("document", name), name, "left_anti")
    again = again.withColumnRenamed("document", name)
    # the few documents with several rows: one row stays, the same in every run
    row = F.struct(*[F.col(c) for c in docs.columns])
    once = (kept.join(again, name, "left_semi").groupBy(name, "doc_id", text)
            .agg(F.min_by(row, F.to_json(row)).alias("row")).select("row.*"))
    return kept.join(again, name, "left_anti").select(*docs.columns).unionByName(once)


def redact_secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    key, blob, found = (fresh_name(docs, c) for c in ("id", "blob", "found"))
    spans = secret_scan.scan(docs).where(F.size("findings") > 0).select(
        F.col("doc_id").alias(key), F.col("blob").alias(blob), F.col("findings").alias(found)).distinct()
    joined = docs.join(spans, F.col("doc_id").eqNullSafe(F.col(key))
                       & (secret_scan.address(F.col("text")) == F.col(blob)), "left")
    text = secret_scan.redact(F.col("text"), F.col(found))
    clean = F.when(F.col(found).isNull(), F.col("text")).otherwise(text)
    new = {"text": clean}
    if "n_chars" in docs.columns:
        new["n_chars"] = F.when(F.col(found).isNull(), F.col("n_chars")).otherwise(
            F.length(text).cast(docs.schema["n_chars"].dataType))
    return joined.select(*[new[c].alias(c) if c in new else F.col(c) for c in docs.columns])


def pack_sequences(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return packing.pack(docs, keep_ids=False)


STAGES = [("toxicity", drop_toxic), ("near_duplicates", drop_near_duplicates), ("secrets", redact_secrets),
          ("packing", pack_sequences)]

#: Learned scores, components and token ids are beyond SQL; tests hold the stages against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read_table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = materialize(stage(spark, docs, sf_dir), name)
    return docs

"""Corpus pipeline: reject toxic texts, drop near copies, decontaminate, mix to target weights, write token files.

Each stage takes (spark, docs, sf_dir) and returns a DataFrame, which is written as Parquet and read again as the
next stage's documents.  All stages but the last return the columns of their documents.
"""

from pyspark.sql import functions as F

from chartfold.llm.common import durable, table
from chartfold.llm.decontaminate import contamination
from chartfold.llm.mixing import copies, mix, train_domains
from chartfold.llm.ngram_join import jaccard_components
from chartfold.llm.queries import byte_bpe_path
from chartfold.llm.token_files import token_documents
from chartfold.llm.toxicity import held_out, score_texts, train
from chartfold.session import scratch_path

REJECT_FROM = 0.5


def toxicity(spark, docs, sf_dir):
    """Documents with a toxicity score under ``REJECT_FROM``; the model is fitted on the labelled rows that are not held out."""
    labels = table(spark, sf_dir, "labels").where(~held_out(F.col("doc_id")))
    return score_texts(docs, train(docs, labels)).where(F.col("score") < REJECT_FROM).select("row.*")


def ngram_join(spark, docs, sf_dir):
    """One row of every group of near copies: the smallest doc_id (a row without one last), then the smallest text hash.

    Decided by row, (doc_id, text hash): a clean row stays whatever other rows have its doc_id.  Of rows equal in
    both the least by all columns stays.  Rows without words are linked with nothing and all stay.
    """
    rows = durable(jaccard_components(docs).where("label is not null").select(
        "label", F.struct(F.col("doc_id").isNull().alias("unnamed"), "doc_id", "text_key").alias("at"))
        .groupBy("label", "at").agg(F.count(F.lit(1)).alias("n")))
    kept = rows.groupBy("label").agg(F.min("at").alias("at"))
    gone = rows.select("label", "at").exceptAll(kept).select("at.*")
    again = rows.where("n > 1").join(kept, ["label", "at"], "left_semi").select("at.*")

    def among(found, how):
        return keyed.join(found.select(F.col("doc_id").alias("__id"), F.col("text_key").alias("__text")),
                          F.col("__doc").eqNullSafe(F.col("__id")) & F.col("__key").eqNullSafe(F.col("__text")), how)
    keyed = docs.withColumns({"__doc": F.col("doc_id").cast("long"), "__key": F.xxhash64(F.col("text").cast("string"))})
    keyed = among(gone, "left_anti")
    row = F.struct(*[F.col(f"`{c}`") for c in docs.columns])
    single = among(again, "left_anti").select(*[f"`{c}`" for c in docs.columns])
    least = among(again, "left_semi").groupBy("__doc", "__key").agg(F.min(row).alias("__row")).select("__row.*")
    return single.unionByName(least)


def decontaminate(spark, docs, sf_dir):
    """Documents without a benchmark window."""
    return contamination(docs, table(spark, sf_dir, "benchmark")).where("n_hit = 0").select("doc.*")


def mixing(spark, docs, sf_dir):
    """Each document as often as its rate says: the whole part, and the fraction by a hash of its id."""
    model = train_domains(docs, table(spark, sf_dir, "labels"))
    rated = mix(docs, model).select("row", copies(F.col("row.doc_id"), F.col("rate")).alias("n")).where("n > 0")
    return rated.select("row", F.explode(F.sequence(F.lit(1), F.col("n")))).select("row.*")


def token_files(spark, docs, sf_dir):
    """Token files of the mix, read back: doc_id, start, n_tokens, ids_crc32."""
    return token_documents(docs, byte_bpe_path())


STAGES = [("toxicity", toxicity), ("ngram_join", ngram_join), ("decontaminate", decontaminate), ("mixing", mixing), ("token_files", token_files)]

#: Learned models and token ids are beyond SQL; tests/llm/test_pipeline.py checks that each stage keeps a part of its input and repeats itself, not yet brute force.
ORACLE_SQL = None


def run(spark, sf_dir):
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        path = scratch_path(spark, "pipeline", name)
        stage(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
    return docs

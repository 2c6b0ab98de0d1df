"""Corpus pipeline: five stages over ``documents``, each one of the text operators.

Every stage takes (spark, docs, sf_dir) and returns a DataFrame that is written as Parquet and read
again as the next stage's ``docs``.  All but the last return the columns of ``documents``.

Defined cases: other columns, whatever their names, pass through every stage (of the last stage's own columns
each replaces a user column of its name); an empty table passes as an empty table; null
texts are scored, kept and counted as empty texts; documents of a null id count as one document where a
stage joins by id.
"""

from __future__ import annotations

from functools import wraps

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tableguard.llm import decontaminate, line_dedup, mixing, ngram_join, quality_cnn
from tableguard.llm.arrays import aside, materialize

COLUMNS = ("doc_id", "text", "lang", "source", "n_chars")


def _untouched(stage):
    """The stage with all columns but those of ``documents`` put aside under names that nothing in it uses."""
    @wraps(stage)
    def run_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
        held, names = aside(docs, COLUMNS)
        out = stage(spark, held, sf_dir)
        back = {c: n for n, c in names.items()}
        made = [c for c in out.columns if c not in held.columns]
        quoted = lambda c: F.col("`" + c.replace("`", "``") + "`")
        return out.select(*(quoted(back.get(c, c)).alias(c) for c in docs.columns if c not in made), *made)
    return run_stage


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


@_untouched
def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the classifier rejects go."""
    judged = quality_cnn.classify(docs, _table(spark, sf_dir, "labels"))
    return judged.where("predicted = 1").select(*docs.columns)


@_untouched
def lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Runs of two or more lines that stand earlier in the corpus go; so does a document of which nothing is left.
    ``n_chars`` follows the text."""
    kept = line_dedup.line_dedup(docs, passages=True).where("NOT (removed_lines > 0 AND text = '')")
    return kept.withColumn("n_chars", F.when(F.col("removed_lines") > 0, F.length("text").cast("long"))
                           .otherwise(F.col("n_chars"))).select(*docs.columns)


@_untouched
def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The document of the smallest id stays of each group; rows equal in id and text become one."""
    groups = ngram_join.near_groups(docs, long=ngram_join.LONG)
    stay = groups.where(F.col("doc_id").eqNullSafe(F.col("component_id"))).select(F.col("doc_id").alias("stay")).distinct()
    return docs.join(stay, F.col("doc_id").eqNullSafe(F.col("stay")), "left_semi").dropDuplicates(["doc_id", "text"])


@_untouched
def benchmark(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold a passage of a benchmark item go."""
    judged = decontaminate.decontaminate(docs, _table(spark, sf_dir, "benchmark"))
    return judged.where(F.size("words") == 0).select(*docs.columns)


@_untouched
def mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The mix in the order of virtual finish time: its documents with the words taken of each."""
    placed = mixing.schedule(docs, texts=True).where("taken > 0")
    finish = (F.col("start") + F.col("size")) / F.col("target")
    return (placed.withColumn("finish", finish).orderBy("finish", "source_no", "doc_id")
            .select(*docs.columns, "size", "source_size", "target", "taken", "finish"))


STAGES = [("quality", quality), ("line_dedup", lines), ("near_duplicates", near_duplicates),
          ("benchmark", benchmark), ("mix", mix)]

#: The classifier and the similarity join have no SQL form; tests compare with brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = materialize(stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)

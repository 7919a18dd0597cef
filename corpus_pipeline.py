"""Corpus pipeline: quality classifier, near-duplicate removal, repeated-passage removal,
mixing to target weights, packing into training sequences.

``STAGES`` lists (name, function); each function takes (spark, docs, sf_dir) and returns a
DataFrame that is written as Parquet and read again as the next stage's documents. All but
the last return the columns of ``documents``; each works on all that its predecessor kept.
Empty tables and null columns pass through as the operators define.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from faresight.llm import minhash, mixing, packing, quality, rindex
from faresight.llm.common import Workspace, join_back
from faresight.llm.queries import tokenizer_path
from faresight.sources.tables import table_path

#: Shortest repeated string that is cut, in bytes: about 50 short words.
PASSAGE_BYTES = 200
#: No source is passed more often than this; every document is taken at least once.
MAX_REPEAT = 2.0


def quality_classifier(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the classifier accepts (score >= 0.7); rows are otherwise unchanged."""
    model = quality.fit(docs, spark.read.parquet(table_path(sf_dir, "labels")))
    cols = docs.columns
    kept = quality.score(docs.withColumnsRenamed({c: f"c{i}" for i, c in enumerate(cols)}).withColumn("text", F.col(f"c{cols.index('text')}")),
                         model, [f"c{i}" for i in range(len(cols))])
    return kept.filter(F.col("score") >= 0.7).select(*[F.col(f"c{i}").alias(c) for i, c in enumerate(cols)])


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One row, that of the smallest doc_id (null last), of each group of near duplicates
    (five-word shingles, similarity 0.8 or more). Every row is a document of its own, under a
    row number: repeated rows, null ids and one doc_id with several texts are decided by row.
    Rows without words are linked with nothing and stay."""
    ws, cols = Workspace(spark, "near-duplicates"), [F.col(f"`{c}`") for c in docs.columns]
    rows = ws.table(docs.withColumn("__row", F.monotonically_increasing_id()), "rows")
    found = minhash.near_duplicates(rows, words=5, percent=80, id_col="__row").select(F.col("doc_id").alias("row"), "component_id")
    member = ws.table(found.join(rows.select(F.col("__row").alias("row"), F.col("doc_id").cast("long").alias("id")), "row"), "members")
    groups = ws.table(member.groupBy("component_id").agg(F.count(F.lit(1)).alias("cnt"), F.min(F.struct(F.col("id").isNull().alias("no_id"), "id", "row")).alias("first"))
                      .filter("cnt > 1").select("component_id", "cnt", F.col("first.row").alias("stays")), "groups")
    total = groups.agg(F.sum("cnt")).first()[0] or 0
    gone = ws.table(join_back(member, groups, ["component_id"], total).filter("row <> stays").select(F.col("row").alias("__row")), "gone")
    ws.drop(member, groups)
    return rows.join(gone, "__row", "left_anti").select(*cols)


def repeated_passages(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without the strings of PASSAGE_BYTES bytes that occur more than once."""
    return rindex.remove_repeats(docs, PASSAGE_BYTES)


def source_mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents, those of smaller sources repeated, so that source weights are as even as
    MAX_REPEAT passes allow; none is dropped."""
    return mixing.realise(docs, budget_tokens="cover", max_repeat=MAX_REPEAT)


def packed_sequences(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces with their token ids and place in sequences of 2048 tokens."""
    return packing.pack(docs, tokenizer_path())


STAGES = [
    ("quality classifier", quality_classifier),
    ("near duplicates", near_duplicates),
    ("repeated passages", repeated_passages),
    ("source mix", source_mix),
    ("packed sequences", packed_sequences),
]

#: SQL cannot express the learned classifier, byte-level repeats or the packing search.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    ws = Workspace(spark, "pipeline")
    docs = spark.read.parquet(table_path(sf_dir, "documents"))
    for k, (_, stage) in enumerate(STAGES):
        docs = ws.table(stage(spark, docs, sf_dir), f"stage-{k}")
    return docs

"""The corpus pipeline: from ``documents`` to packed training sequences.

Each stage takes what its predecessor kept, written as Parquet and read
again. All but the last return the columns of ``documents``. ``run`` deletes
the tables of a stage when the next one is written.
"""

from __future__ import annotations

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from millstat.llm import decontaminate, jaccard_join, langid, packing, secrets
from millstat.llm.shared import BROADCAST, bitmap_test, discard, finished, numbered, stored, written


def language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Texts whose letters are hardly in a script of the learned languages, or that have none, go."""
    return langid.accepted(docs, langid.learn(langid.learnable(docs)))


def _rows(docs: DataFrame, name: str) -> DataFrame:
    """``docs`` as c0, c1, ... with a number ``row`` of their own: stages decide on rows, whatever their ids are.

    Parquet files as they are need no copy: the number is made of the file and the row's place in it. All else is written.
    """
    rows = _placed(docs)
    return rows if rows is not None else stored(numbered(docs).withColumn("row", F.monotonically_increasing_id()), name)


def _placed(docs: DataFrame) -> DataFrame | None:
    """``docs`` with a ``row`` of 36 bits of the file's hash and 27 bits of the place in it; None if these don't tell rows apart."""
    if docs._jdf.queryExecution().analyzed().getClass().getSimpleName() != "LogicalRelation":
        return None  # what is computed may come out otherwise when read again
    meta = docs.metadataColumn("_metadata")
    try:
        rows = docs.select("*", meta["file_path"].alias("path"), meta["row_index"].alias("place"))
    except AnalysisException:  # not files, or not of Parquet
        return None
    rows = rows.toDF(*[f"c{i}" for i in range(len(docs.columns))], "path", "place")
    files = rows.groupBy("path").agg(F.max("place").alias("last"))
    for seed in range(4):
        at = F.xxhash64(F.lit(seed), F.col("path")).bitwiseAND((1 << 36) - 1)
        n, different, last = files.agg(F.count(F.lit(1)), F.count_distinct(at), F.max("last")).first()
        if different == n and (last or 0) < 1 << 27:
            return rows.withColumn("row", F.shiftleft(at, 27) + F.col("place")).drop("path", "place")
    return None


def _texts(rows: DataFrame, docs: DataFrame) -> DataFrame:
    return rows.select(F.col("row").alias("doc_id"), F.col(f"c{docs.columns.index('text')}").alias("text"))


def _without(rows: DataFrame, gone: DataFrame, docs: DataFrame, name: str) -> DataFrame:
    """The rows not in ``gone``. These numbers are written first: few are broadcast; of many a bitmap is made, and only
    the texts whose bit is set are moved to where they are joined.
    """
    gone = stored(gone.select("row").distinct(), name)
    n = gone.count()
    if n <= BROADCAST:
        left = rows.join(gone, "row", "left_anti")
    else:
        may_go = bitmap_test(gone, "row", n)
        left = rows.where(may_go).join(gone, "row", "left_anti").unionByName(rows.where(~may_go).select("row", *rows.drop("row").columns))
    return left.drop("row").toDF(*docs.columns)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each group of near-duplicates the row with the smallest id stays (NULL ids last; ties: any one).

    Rows that share an id with different texts are told apart; rows with a NULL id take part.
    """
    rows = _rows(docs, "pipeline-rows")
    found = jaccard_join.jaccard_join(_texts(rows, docs)).select(F.col("doc_id").alias("row"), "component_id")
    key = F.col(f"c{docs.columns.index('doc_id')}").cast("long").alias("id")
    ranked = found.join(rows.select("row", key), "row")
    first = ranked.groupBy("component_id").agg(F.min(F.struct(F.col("id").isNull().alias("none"), "id", "row")).alias("first"))
    gone = found.join(first.select(F.col("first.row").alias("row")), "row", "left_anti")
    return _without(rows, gone, docs, "pipeline-copies")


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents with benchmark content go, whatever their ids."""
    rows = _rows(docs, "pipeline-rows")
    found = decontaminate.contaminated(_texts(rows, docs), spark.read.parquet(f"{sf_dir}/benchmark.parquet"))
    return _without(rows, found.select(F.col("doc_id").alias("row")), docs, "pipeline-leaks")


def secret_scan(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Secrets are masked in the texts; no document goes."""
    return secrets.redact(docs, secrets.train(secrets.labelled_findings(spark)))


def packed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Places of all pieces in sequences of at most 2048 tokens."""
    return packing.pack_documents(docs)


STAGES = [("language_id", language), ("jaccard_join", near_duplicates), ("decontamination", decontamination),
          ("secret_scan", secret_scan), ("packing", packed)]

#: no SQL: language ID and the forest of the secret scan are learned, packing is a search; see tests/llm
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages on the ``documents`` of ``sf_dir``."""
    docs, before = spark.read.parquet(f"{sf_dir}/documents.parquet"), []
    for name, stage in STAGES[:-1]:
        with written() as own:
            docs = finished(spark, lambda stage=stage, docs=docs: stage(spark, docs, sf_dir), f"pipeline-{name}")
        discard(spark, before)  # the next stage reads this one's table alone
        before = own
    return STAGES[-1][1](spark, docs, sf_dir)

"""Runs over pairs of dates that do again only what has changed.

A run keeps two tables below one folder: results, partitioned by a text of the pair and overwritten partition by partition, and a manifest to which each run adds a row for each pair that it
worked on: its signature (a digest of the pair's input rows, whatever their order), its status and a sequence number. Results carry the signature that they were made from, and are read through the manifest: a run that dies between
the two writes leaves rows that nobody reads, and the next run does the pair again. A second run on the same inputs writes nothing.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from groundshift.operators.components import written

MANIFEST = "pair string, signature string, status string, run bigint"


def pair_name(*keys: str) -> Column:
    return F.concat_ws("_", *(F.col(k).cast("string") for k in keys))


def signatures(inputs: DataFrame, pair: str = "pair") -> DataFrame:
    """(pair, signature): number of rows, and the sum and exclusive or of two hashes of each row."""
    rest = sorted(c for c in inputs.columns if c != pair)
    text = F.to_json(F.struct(*rest))
    h = inputs.select(F.col(pair).alias("pair"), F.xxhash64(text).alias("h"), F.xxhash64(text, F.lit(1)).alias("g"))
    g = h.groupBy("pair").agg(F.count(F.lit(1)).alias("n"), F.sum(F.col("h").cast("decimal(38,0)")).alias("s"), F.bit_xor("g").alias("x"))
    return g.select("pair", F.sha2(F.concat_ws("|", "n", "s", "x"), 256).alias("signature"))


def manifest(spark: SparkSession, target: str) -> DataFrame:
    """The last row of each pair."""
    path = spark._jvm.org.apache.hadoop.fs.Path(f"{target}/manifest")
    if not path.getFileSystem(spark._jsc.hadoopConfiguration()).exists(path):
        return spark.createDataFrame([], MANIFEST)
    m = spark.read.schema(MANIFEST).parquet(f"{target}/manifest")
    return m.groupBy("pair").agg(F.max_by(F.struct("signature", "status", "run"), "run").alias("m")).select("pair", "m.*")


def pending(requested: DataFrame, done: DataFrame) -> DataFrame:
    """Requested (pair, signature) that no successful last run has."""
    return requested.join(done.where("status = 'SUCCESS'").select("pair", "signature"), ["pair", "signature"], "left_anti")


def run(inputs: DataFrame, compute: Callable[[DataFrame], DataFrame], target: str) -> int:
    """Work on the pairs of inputs (pair, ...) that are new or changed, or failed last time; the number of pairs worked on. compute gets their rows and returns rows with pair; a pair may have none.
    If it fails, these pairs are entered as failed and the error goes on."""
    spark = inputs.sparkSession
    done = manifest(spark, target)
    todo = written(pending(signatures(inputs), done))
    n = todo.count()
    if not n:
        return 0
    number = (done.agg(F.max("run")).first()[0] or 0) + 1

    def enter(status: str) -> None:
        todo.select("pair", "signature", F.lit(status).alias("status"), F.lit(number).cast("bigint").alias("run")).write.mode("append").parquet(f"{target}/manifest")

    try:
        out = compute(inputs.join(todo.select("pair"), "pair", "left_semi")).join(todo, "pair")
        out.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("pair").parquet(f"{target}/results")
    except Exception:
        enter("FAILED")
        raise
    enter("SUCCESS")
    return n


def collected(spark: SparkSession, target: str, pairs: list[str] | None = None, schema=None) -> DataFrame:
    """Results of all pairs in one table with pair and run, by the signatures of their last runs; pairs without results are allowed, pairs that were asked for and have no successful run are an error."""
    done = manifest(spark, target).where("status = 'SUCCESS'")
    if pairs is not None:
        asked = spark.createDataFrame([(p,) for p in pairs], "pair string")
        missing = [r["pair"] for r in asked.join(done, "pair", "left_anti").limit(5).collect()]
        if missing:
            raise ValueError(f"pairs without a successful run: {', '.join(missing)}")
        done = done.join(asked, "pair", "left_semi")
    rows = spark.read.option("basePath", f"{target}/results").parquet(f"{target}/results").withColumn("pair", F.col("pair").cast("string"))
    return rows.join(done.select("pair", "signature", "run"), ["pair", "signature"]).drop("signature")

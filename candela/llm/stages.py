"""Hand-over tables between the steps of an operator, in the shared folder of ``spark.checkpoint.dir``."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from candela.session import scratch_path


def written(df: DataFrame, name: str) -> DataFrame:
    """``df`` written once as Parquet and read back: cuts lineage, survives lost executors."""
    spark = df.sparkSession
    path = scratch_path(spark, name)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def bucketed(df: DataFrame, name: str, by: str, n: int) -> DataFrame:
    """As ``written``, in ``n`` buckets of the column ``by``, so that joins on it do not move the table. The catalog keeps no entry."""
    spark = df.sparkSession
    path = scratch_path(spark, name)
    entry = path.rsplit("/", 1)[-1].replace("-", "_")
    df.write.bucketBy(n, by).format("parquet").option("path", path).saveAsTable(entry)
    out = spark.table(entry)
    spark.sql(f"DROP TABLE {entry}")
    return out


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")

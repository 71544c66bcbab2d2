"""Shared scratch space for cutting lineage."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession

_KEY = "spark.checkpoint.dir"


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Checkpoint folder of the session; an error where none is set."""
    context = spark.sparkContext
    current = context.getCheckpointDir()
    if current:
        return current
    folder = spark.conf.get(_KEY, None) or context.getConf().get(_KEY)
    if not folder:
        raise ValueError(f"set {_KEY} to a folder that the driver and every executor can reach")
    context.setCheckpointDir(folder)
    return context.getCheckpointDir()


def store(df: DataFrame) -> DataFrame:
    """Compute ``df`` once into reliable storage that outlives lost executors."""
    ensure_checkpoint_dir(df.sparkSession)
    return df.checkpoint()


def _found(spark: SparkSession, path: str):
    """A path and its file system, of any store that Spark reads."""
    place = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return place, place.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())


def exists(spark: SparkSession, path: str) -> bool:
    """Whether there is a file or folder."""
    place, system = _found(spark, path)
    return system.exists(place)


def delete(spark: SparkSession, path: str) -> None:
    """Delete a file or folder; nothing happens where there is none."""
    place, system = _found(spark, path)
    system.delete(place, True)


def move(spark: SparkSession, path: str, folder: str) -> None:
    """Move a file below ``folder``, keeping its name and that of its own folder."""
    place, system = _found(spark, path)
    target, _ = _found(spark, f"{folder}/{place.getParent().getName()}")
    system.mkdirs(target)
    named = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(target, place.getName())
    if system.exists(place) and not system.rename(place, named):
        raise OSError(f"cannot move {path} to {named.toString()}")


class Shelf:
    """Written tables of one job under the checkpoint folder.

    ``put`` computes a frame once into Parquet and reads it back; ``clear``
    deletes everything that was put, after which those frames are dead. As a
    context it clears itself, also when the job fails.
    """

    def __init__(self, spark: SparkSession):
        self.spark = spark
        self.folder = f"{ensure_checkpoint_dir(spark)}/shelf-{uuid.uuid4().hex}"
        self._tables = 0

    def __enter__(self) -> Shelf:
        return self

    def __exit__(self, *_) -> None:
        self.clear()

    def place(self) -> str:
        self._tables += 1
        return f"{self.folder}/{self._tables}"

    def put(self, df: DataFrame, partition_by: tuple[str, ...] = ()) -> DataFrame:
        path = self.place()
        df.write.partitionBy(*partition_by).parquet(path)
        stored = self.spark.read.schema(df.schema).parquet(path)
        return stored.select(*[f"`{c}`" for c in df.columns])

    def put_bucketed(self, df: DataFrame, by: list[str], buckets: int) -> DataFrame:
        """Like ``put``, in ``buckets`` that are sorted by ``by``.

        Joins and groupings on ``by`` read it without an exchange. ``df`` should come dealt
        by ``by`` into as many partitions as there are buckets, so that a bucket is one file.
        """
        path, table = self.place(), f"bucketed_{uuid.uuid4().hex}"
        writer = df.write.bucketBy(buckets, *by).sortBy(*by)
        writer.option("path", path).saveAsTable(table)
        stored = self.spark.table(table)
        stored.schema  # resolved: from here on the frame knows its files and buckets by itself
        self.spark.sql(f"DROP TABLE {table}")  # the files stay
        return stored

    def clear(self) -> None:
        delete(self.spark, self.folder)

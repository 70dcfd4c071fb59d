"""Reading and writing tables and fitted models."""

from __future__ import annotations

import os
import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

FREED = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
RELEVANCE_FILES = {
    "train.csv": ["id", "product_uid", "product_title", "search_term", "relevance"],
    "product_descriptions.csv": ["product_uid", "product_description"],
    "attributes.csv": ["product_uid", "name", "value"],
}


def _strings(names: list[str]) -> T.StructType:
    return T.StructType([T.StructField(n, T.StringType()) for n in names])


def read_csv(
    spark: SparkSession, path: str, columns: list[str], multi_line: bool = False
) -> DataFrame:
    """CSV with a header, every column text.

    ``multi_line`` allows line breaks inside quoted fields, but then a file is read by one task;
    use it on folders of many files.
    """
    return (
        spark.read.schema(_strings(columns))
        .option("header", True)
        .option("enforceSchema", False)
        .option("multiLine", multi_line)
        .option("escape", '"')
        .csv(path)
    )


def read_relevance_csv(
    spark: SparkSession,
    folder: str,
    columns: dict[str, list[str]] | None = None,
    multi_line: bool = False,
) -> tuple[DataFrame, DataFrame, DataFrame]:
    """The rated pairs, the descriptions and the attributes, in this order."""
    columns = columns or RELEVANCE_FILES
    train, descriptions, attributes = (
        read_csv(spark, f"{folder}/{name}", columns[name], multi_line) for name in RELEVANCE_FILES
    )
    return train, descriptions, attributes


def tell_workers(spark: SparkSession) -> None:
    """Where this package is, for Python workers on this machine; a cluster ships it."""
    root = os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__))))
    spark.sparkContext.environment.setdefault("PYTHONPATH", root)


def read_table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def spread(df: DataFrame, key: str) -> DataFrame:
    """Deal a table of fewer splits than cores out over them; a larger table stays as it is.

    For work that is dear per row on tables that are small as files, such as one row group of
    long texts.
    """
    cores = df.sparkSession.sparkContext.defaultParallelism
    return df.repartition(4 * cores, key) if df.rdd.getNumPartitions() < cores else df


@contextmanager
def shuffles_freed(spark: SparkSession) -> Iterator[None]:
    """Shuffles of what is run meanwhile go as soon as it has ended, and not when the driver happens
    to collect its garbage. For jobs whose result is kept elsewhere."""
    before = spark.conf.get(FREED, "false")
    spark.conf.set(FREED, "true")
    try:
        yield
    finally:
        spark.conf.set(FREED, before)


def materialize(
    df: DataFrame, path: str, mode: str = "errorifexists", codec: str | None = None
) -> DataFrame:
    """Write to parquet and go on from what was written."""
    with shuffles_freed(df.sparkSession):
        df.write.mode(mode).parquet(path, compression=codec)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def shared_folder(spark: SparkSession) -> str:
    """The folder the cluster names for checkpoints; a temporary one only on a local master."""
    folder = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if folder:
        return folder
    if not spark.sparkContext.master.startswith("local"):
        raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
    return tempfile.mkdtemp(prefix="shelfmatch-")


def cut_lineage(df: DataFrame, codec: str | None = None) -> DataFrame:
    """Write the frame as a table in the shared folder and go on from there.

    What follows neither recomputes it nor loses it with an executor, reads only the columns it
    needs, and plans with the table's true size.
    """
    return materialize(df, f"{shared_folder(df.sparkSession)}/kept-{uuid.uuid4().hex}", codec=codec)


def drop_kept(*kept: DataFrame) -> None:
    """Delete tables that ``cut_lineage`` wrote, once nothing is left that reads them."""
    for df in kept:
        jvm = df.sparkSession._jvm
        for folder in sorted({f.rsplit("/", 1)[0] for f in df.inputFiles()}):
            if not folder.rsplit("/", 1)[1].startswith("kept-"):
                raise ValueError(f"{folder} was not kept by cut_lineage")
            path = jvm.org.apache.hadoop.fs.Path(folder)
            path.getFileSystem(df.sparkSession._jsc.hadoopConfiguration()).delete(path, True)


def is_empty(df: DataFrame) -> bool:
    return df.isEmpty()


def save_model(model, path: str, overwrite: bool = True) -> None:
    writer = model.write()
    (writer.overwrite() if overwrite else writer).save(path)


def load_model(cls, path: str):
    return cls.load(path)

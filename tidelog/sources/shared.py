"""The shared folder every executor can reach."""

from __future__ import annotations

import atexit
import shutil
import tempfile
import uuid
from collections.abc import Iterator, Sequence
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession

CHECKPOINT_SETTING = "spark.checkpoint.dir"
#: Set while a run's folder is open.
RUN_SETTING = "tidelog.run.dir"


def shared_dir(spark: SparkSession) -> str:
    """The folder named by the cluster. Only a local session, whose one machine reads what it
    wrote, gets a temporary one where none is set; it goes when Python ends."""
    folder = spark.conf.get(CHECKPOINT_SETTING, None) or spark.sparkContext.getConf().get(
        CHECKPOINT_SETTING, None
    )
    if folder:
        return folder
    if not spark.sparkContext.master.startswith("local["):
        raise ValueError(f"set {CHECKPOINT_SETTING} to a folder that every executor reaches")
    folder = tempfile.mkdtemp(prefix="run-")
    atexit.register(shutil.rmtree, folder, ignore_errors=True)
    spark.conf.set(CHECKPOINT_SETTING, folder)
    return folder


def new_table_path(spark: SparkSession, name: str) -> str:
    """A fresh table path in the open run's folder, else in the shared folder."""
    folder = spark.conf.get(RUN_SETTING, None) or shared_dir(spark)
    return f"{folder.rstrip('/')}/{name}-{uuid.uuid4().hex}"


def written(df: DataFrame, name: str) -> DataFrame:
    """Cut lineage: write ``df`` once to the shared folder and read it back."""
    path = new_table_path(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def _table_name(path: str) -> str:
    return path.rstrip("/").rsplit("/", 1)[1].replace("-", "_")


def stored_by(
    df: DataFrame, name: str, keys: Sequence[str], lies: bool = False
) -> DataFrame:
    """Like ``written``, stored in one bucket per shuffle partition by ``keys``: joins and groups on
    them move none of its rows. ``lies``: a join on the keys has placed the rows already, so
    they are not shuffled for the write either.
    """
    spark = df.sparkSession
    path = new_table_path(spark, name)
    run = spark.conf.get(RUN_SETTING, None)
    table = (_table_name(run) + "_" if run else "") + _table_name(path)
    buckets = int(spark.conf.get("spark.sql.shuffle.partitions"))
    placed = df if lies else df.repartition(buckets, *keys)
    # The table is external: the catalog holds a name for the folder, which goes with the run.
    placed.write.bucketBy(buckets, *keys).option("path", path).format("parquet").saveAsTable(table)
    return spark.table(table)


@contextmanager
def run_folder(spark: SparkSession) -> Iterator[str]:
    """What plans write inside the block goes to one folder, which is removed after it.

    Results that still read those tables must be written out within the block.
    """
    folder = new_table_path(spark, "run")
    spark.conf.set(RUN_SETTING, folder)
    try:
        yield folder
    finally:
        spark.conf.unset(RUN_SETTING)
        for table in spark.catalog.listTables(pattern=f"{_table_name(folder)}*"):
            spark.sql(f"DROP TABLE IF EXISTS {table.name}")
        path = spark._jvm.org.apache.hadoop.fs.Path(folder)
        path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)

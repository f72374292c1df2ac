"""Session helpers. On a cluster every setting comes from the session itself."""

from __future__ import annotations

import atexit
import shutil
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession


def local_session(cores: int = 8, partitions: int = 8, memory: str = "8g") -> SparkSession:
    """A local session for tests and the bench."""
    spark = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName("folioflow")
        .config("spark.sql.shuffle.partitions", str(partitions))
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.driver.memory", memory)
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def shared_folder(spark: SparkSession) -> str:
    """The folder that spark.checkpoint.dir names. Where it is unset, a temporary one on a local master; on a cluster that is an error, as executors would not see one another's files."""
    sc = spark.sparkContext
    if not sc._jsc.sc().getCheckpointDir().isDefined():
        folder = sc.getConf().get("spark.checkpoint.dir")
        if not folder:
            if not sc.master.startswith("local["):
                raise ValueError("spark.checkpoint.dir must name a folder that all executors share")
            folder = tempfile.mkdtemp(prefix="folioflow-")
            atexit.register(shutil.rmtree, folder, ignore_errors=True)
        sc.setCheckpointDir(folder)
    return sc._jsc.sc().getCheckpointDir().get()


#: Tables written by cut_lineage that go when the session's process ends.
_written: list[str] = []


def drop_written(spark: SparkSession) -> None:
    """Delete the intermediate tables written so far; results that still read them must have been taken."""
    path = spark._jvm.org.apache.hadoop.fs.Path
    while _written:
        p = path(_written.pop())
        p.getFileSystem(spark._jsc.hadoopConfiguration()).delete(p, True)


def cut_lineage(df: DataFrame) -> DataFrame:
    """df as a table written in the shared folder and read again.

    All executors share the folder, so a lost one costs nothing. A columnar
    table is smaller than a checkpoint, and later reads take only their columns.
    The table stays as long as a result may read it; drop_written deletes it.
    """
    path = f"{shared_folder(df.sparkSession)}/table-{uuid.uuid4().hex}"
    df.write.option("compression", "zstd").parquet(path)
    _written.append(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def each_once(df: DataFrame, key: str) -> DataFrame:
    """df without repeated rows. Only the keys are shuffled to see whether there are any; whole rows only if there are."""
    alone = df.groupBy(key).count().filter("count > 1").isEmpty()
    return df if alone else df.distinct()


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")

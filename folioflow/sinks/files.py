"""Files out: dataset JSON and Markdown, figures, reports."""

from __future__ import annotations

from pathlib import Path

from pyarrow import fs
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from folioflow.operators.datasets import dataset_markdown


def write_datasets(datasets: DataFrame, folder: str, partitions: list[str] = ()) -> None:
    """One JSON object a line, null fields left out, in files partitioned as asked."""
    w = datasets.write.mode("overwrite").option("ignoreNullFields", True)
    (w.partitionBy(*partitions) if partitions else w).json(folder)


def file_system(folder: str, shared: bool = True):
    """(file system, path) of a folder, by its address; a path without one is of this machine, which on a cluster (shared) no other sees."""
    if "://" in folder:
        return fs.FileSystem.from_uri(folder)
    if shared:
        raise ValueError(f"{folder}: on a cluster the folder needs an address, such as hdfs://host/folder")
    return fs.LocalFileSystem(), str(Path(folder).resolve())


def _write_each(rows: DataFrame, folder: str, suffix: str) -> None:
    """(name, content) rows as single files, written where the rows are."""
    shared = not rows.sparkSession.sparkContext.master.startswith("local")
    file_system(folder, shared)

    def run(part):
        system, path = file_system(folder, shared)
        system.create_dir(path, recursive=True)
        for r in part:
            data = bytes(r.content) if isinstance(r.content, (bytes, bytearray)) else r.content.encode("utf-8")
            with system.open_output_stream(f"{path}/{r.name}{suffix}") as out:
                out.write(data)

    rows.foreachPartition(run)


def write_dataset_files(datasets: DataFrame, folder: str) -> None:
    """<stem>.json per dataset, indented, other alphabets as they are; an existing file is replaced."""
    body = F.to_json(F.struct(*[c for c in datasets.columns if c != "doc_id"]), {"pretty": "true", "ignoreNullFields": "true"})
    _write_each(datasets.select(F.col("doc_id").alias("name"), body.alias("content")), folder, ".json")


def write_markdown_files(datasets: DataFrame, folder: str) -> None:
    _write_each(datasets.select(F.col("doc_id").alias("name"), dataset_markdown().alias("content")), folder, ".md")


def write_assets(figures: DataFrame, folder: str) -> None:
    """figures: (asset, content), asset being the whole file name."""
    _write_each(figures.select(F.col("asset").alias("name"), "content"), folder, "")


def append_cache(rows: DataFrame, folder: str) -> None:
    rows.write.mode("append").parquet(folder)

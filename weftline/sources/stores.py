"""Files by name on executors: reads at any place and writes of whole files.

Spark's own writers choose file names and its readers take whole files; where a format needs neither, the
tasks open files through Arrow's file systems (local or mounted folders, HDFS, S3, GCS).
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import pandas as pd
from pyarrow import NativeFile
from pyarrow import fs as arrow_fs
from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def located(uri: str) -> tuple[arrow_fs.FileSystem, str]:
    """The store of a file and its path there."""
    if uri.startswith("file:"):
        return arrow_fs.LocalFileSystem(), re.sub(r"^file:/+", "/", uri)
    return arrow_fs.FileSystem.from_uri(uri)


def open_file(uri: str) -> NativeFile:
    """A file for reads at any place."""
    store, path = located(uri)
    return store.open_input_file(path)


def write_files(df: DataFrame, root: str, name: str, content: str) -> int:
    """Write each row's ``content`` (text or binary) as the file ``name`` below ``root``; the number of files.

    A task that runs again writes the same files again, so a lost executor costs nothing but time.
    """
    binary = dict(df.dtypes)[content] == "binary"

    def write(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        store, folder = located(root)
        store.create_dir(folder, recursive=True)
        n = 0
        for pdf in batches:
            for file, data in zip(pdf["name"], pdf["content"], strict=True):
                with store.open_output_stream(f"{folder}/{file}") as out:
                    out.write(bytes(data) if binary else data.encode("utf-8"))
                n += 1
        yield pd.DataFrame({"n": [n]})

    return df.select(F.col(name).alias("name"), F.col(content).alias("content")).mapInPandas(write, "n long").agg(F.sum("n")).first()[0] or 0

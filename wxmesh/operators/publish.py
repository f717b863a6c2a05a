"""Atomic publication of a table's files.

A table is a folder with a small file ``_current`` that names the sub-folders
holding its rows. A write puts its files into new sub-folders, which nobody reads yet,
and then replaces that file by one rename. So a reader sees the table as it
was or as it is now, and a write that dies in between leaves it as it was;
sub-folders that are no longer named are removed afterwards. A folder without
``_current`` is read as it is (a table filled by other means).
"""

from __future__ import annotations

import uuid
from collections.abc import Collection

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

from ..session import delete_path

CURRENT = "_current"


def _path(spark: SparkSession, path: str):
    return spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)


def _files(spark: SparkSession, path: str):
    return _path(spark, path).getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())


def exists(spark: SparkSession, path: str) -> bool:
    return _files(spark, path).exists(_path(spark, path))


def children(spark: SparkSession, path: str) -> list[str]:
    return sorted(s.getPath().getName() for s in _files(spark, path).listStatus(_path(spark, path))) if exists(spark, path) else []


def current(spark: SparkSession, path: str) -> list[str] | None:
    """The sub-folders that hold the table's rows; None if none were ever published."""
    at = f"{path.rstrip('/')}/{CURRENT}"
    if not exists(spark, at):
        return None
    with_bytes = _files(spark, at).open(_path(spark, at))
    try:
        text = spark.sparkContext._jvm.org.apache.commons.io.IOUtils.toString(with_bytes, "UTF-8")
    finally:
        with_bytes.close()
    return text.split("\n") if text else []


def switch(spark: SparkSession, path: str, folders: list[str]) -> None:
    """Let ``folders`` be the table from now on: one file is written aside and renamed over the old one."""
    jvm, base = spark.sparkContext._jvm, path.rstrip("/")
    aside = f"{base}/{CURRENT}-{uuid.uuid4().hex[:12]}"
    out = _files(spark, base).create(_path(spark, aside))
    try:
        out.write("\n".join(folders).encode())
    finally:
        out.close()
    option = getattr(jvm, "org.apache.hadoop.fs.Options$Rename")
    options = spark.sparkContext._gateway.new_array(option, 1)
    options[0] = option.valueOf("OVERWRITE")
    target = _path(spark, f"{base}/{CURRENT}")
    jvm.org.apache.hadoop.fs.FileContext.getFileContext(_files(spark, base).getUri(), spark.sparkContext._jsc.hadoopConfiguration()) \
        .rename(_path(spark, aside), target, options)


def read(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    """The table as it is published now, with its declared schema; an empty frame if there is none."""
    base, folders = path.rstrip("/"), current(spark, path)
    if folders is None:
        return spark.read.schema(schema).parquet(base) if exists(spark, base) else spark.createDataFrame([], schema)
    if not folders:
        return spark.createDataFrame([], schema)
    return spark.read.schema(schema).option("basePath", base).parquet(*[f"{base}/{f}" for f in folders])


def replace(df: DataFrame, path: str) -> None:
    """Publish ``df`` as the whole table."""
    spark, base, version = df.sparkSession, path.rstrip("/"), f"v-{uuid.uuid4().hex[:12]}"
    df.write.parquet(f"{base}/{version}")
    switch(spark, base, [version])
    for name in children(spark, base):
        if name not in (CURRENT, version):
            delete_path(spark, f"{base}/{name}")


def replace_partitions(df: DataFrame, path: str, column: str, keep: str) -> None:
    """Publish ``df`` in place of all partitions of ``column`` from the value ``keep`` on; earlier ones stay as they are.

    The names of a column's values must sort as the values do (dates do).
    """
    before = _partitioned(df.sparkSession, path, column)
    _swap(df, path, column, before, [f for f in before if f.split("/")[0] < f"{column}={keep}"])


def replace_values(df: DataFrame, path: str, column: str, values: Collection[str]) -> None:
    """Publish ``df`` in place of the partitions with these values of ``column``; a value without rows is gone afterwards.

    ``df`` must hold no other values. The values are folder names: plain text without signs that a path escapes.
    """
    before, gone = _partitioned(df.sparkSession, path, column), {f"{column}={v}" for v in values}
    _swap(df, path, column, before, [f for f in before if f.split("/")[0] not in gone])


def values_of(spark: SparkSession, path: str, column: str) -> list[str]:
    """The values of ``column`` that the table has now, sorted, from the names of its sub-folders."""
    return sorted({f.split("/")[0].partition("=")[2] for f in _partitioned(spark, path, column)})


def read_values(spark: SparkSession, path: str, schema: T.StructType, column: str, values: Collection[str]) -> DataFrame:
    """The rows with these values of the partition column: no folder of another value is listed or opened."""
    base, wanted = path.rstrip("/"), {f"{column}={v}" for v in values}
    folders = [f"{base}/{f}" for f in _partitioned(spark, path, column) if f.split("/")[0] in wanted]
    if not folders:
        return spark.createDataFrame([], schema)
    return spark.read.schema(schema).option("basePath", base).parquet(*folders)


def _partitioned(spark: SparkSession, path: str, column: str) -> list[str]:
    """The table's sub-folders, each of one value of ``column``."""
    published = current(spark, path.rstrip("/"))
    return published if published is not None else [n for n in children(spark, path) if n.startswith(f"{column}=")]


def _swap(df: DataFrame, path: str, column: str, before: list[str], stays: list[str]) -> None:
    """Publish ``df`` beside those of the folders ``before`` that stay."""
    spark, base, version = df.sparkSession, path.rstrip("/"), f"v-{uuid.uuid4().hex[:12]}"
    aside = f"{base}/_aside-{version}"
    df.write.partitionBy(column).parquet(aside)
    comes, files = [], _files(spark, base)
    for name in children(spark, aside):
        if name.startswith(f"{column}="):  # as many as there are new partitions
            files.mkdirs(_path(spark, f"{base}/{name}"))
            files.rename(_path(spark, f"{aside}/{name}"), _path(spark, f"{base}/{name}/{version}"))
            comes.append(f"{name}/{version}")
    switch(spark, base, stays + comes)
    delete_path(spark, aside)
    for folder in set(before) - set(stays):
        partition, inner = folder.split("/")[0], folder.partition("/")[2]
        own = [folder] if inner else [f"{partition}/{n}" for n in children(spark, f"{base}/{partition}") if f"{partition}/{n}" not in comes]
        for name in own:
            delete_path(spark, f"{base}/{name}")
        if not children(spark, f"{base}/{partition}"):
            delete_path(spark, f"{base}/{partition}")

"""Text and columnar files as sources."""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from flowlab.operators.cleaning import union_all
from flowlab.session import cut_lineage


def is_directory(spark: SparkSession, path: str) -> bool:
    jvm = spark.sparkContext._jvm
    location = jvm.org.apache.hadoop.fs.Path(path)
    system = location.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    return bool(system.getFileStatus(location).isDirectory())


def list_files(spark: SparkSession, path: str, glob: str | None = None) -> DataFrame:
    """``path`` and ``length`` of all files below; contents are not read."""
    reader = spark.read.format("binaryFile").option("recursiveFileLookup", "true")
    if glob:
        reader = reader.option("pathGlobFilter", glob)
    return reader.load(path).select("path", "length")


def _arrow_location(uri: str):
    from pyarrow import fs

    if uri.startswith("file:"):
        uri = "file://" + "/" + uri[len("file:"):].lstrip("/")
    return fs.FileSystem.from_uri(uri)


def open_input(uri: str):
    """A random access file for a task, on any file system Arrow knows."""
    system, path = _arrow_location(uri)
    return system.open_input_file(path)


def write_bytes(uri: str, data: bytes) -> None:
    system, path = _arrow_location(uri)
    system.create_dir(path.rsplit("/", 1)[0], recursive=True)
    with system.open_output_stream(path) as f:
        f.write(data)


def read_csv(spark: SparkSession, path: str | Sequence[str]) -> DataFrame:
    """Header CSV, all columns as text: no inference pass over the data."""
    return spark.read.option("header", "true").option("inferSchema", "false").csv(path)


def _first_line(uri: str) -> str:
    """All up to the first line end, however long it is."""
    parts = []
    with open_input(uri) as f:
        while part := f.read(1 << 16):
            head, end, _ = part.partition(b"\n")
            parts.append(head)
            if end:
                break
    return b"".join(parts).decode("utf-8", "replace").strip()


def _first_lines(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    for batch in batches:
        heads, errors = [], []
        for uri in batch["path"]:
            head = error = None
            try:
                head = _first_line(uri)
            except Exception as e:  # noqa: BLE001 - an unreadable file is a reject
                error = f"{type(e).__name__}: {e}"[:500]
            heads.append(head)
            errors.append(error)
        yield pd.DataFrame({"path": batch["path"], "header": heads, "error": errors})


def csv_headers(spark: SparkSession, path: str, glob: str = "*.csv") -> DataFrame:
    """``path``, ``header`` and ``error`` of every CSV file; the rows with an
    error are the files that :func:`read_csv_by_name` cannot read."""
    return list_files(spark, path, glob).select("path").mapInPandas(_first_lines, "path string, header string, error string")


def read_csv_by_name(spark: SparkSession, path: str, glob: str = "*.csv") -> DataFrame:
    """Union of CSV files whose headers differ, matched by trimmed name.

    Only the first line of each file is looked at to group the files; each
    group of equal headers is then one ordinary scan. Files without a readable
    header are left out; :func:`csv_headers` reports them.
    """
    groups = (
        csv_headers(spark, path, glob)
        .where(F.col("error").isNull())
        .groupBy("header")
        .agg(F.collect_list("path").alias("paths"))  # file names only
        .orderBy("header")
        .collect()
    )
    if not groups:
        raise ValueError(f"no readable CSV files in {path}")
    frames = []
    for g in groups:
        df = read_csv(spark, sorted(g["paths"]))
        frames.append(df.toDF(*[c.strip() for c in df.columns]))
    return union_all(frames)


def _inspect(fmt: str, deep: bool):
    """Schema, or the reason why a file cannot be read, of every file."""

    def look(uri: str) -> str:
        if fmt != "parquet":
            return _first_line(uri) if fmt == "csv" else ""
        import pyarrow.parquet as pq

        with open_input(uri) as f:
            file = pq.ParquetFile(f)
            if deep:  # every page is decoded, a row group at a time
                for group in range(file.num_row_groups):
                    for _ in file.iter_batches(row_groups=[group]):
                        pass
            schema = file.schema_arrow.remove_metadata().to_string()
        if not schema:
            raise ValueError("no columns")
        return schema

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            found = []
            for uri in batch["path"]:
                try:
                    found.append((uri, look(uri), None))
                except Exception as e:  # noqa: BLE001 - an unreadable file is a reject
                    found.append((uri, None, f"{type(e).__name__}: {e}".split("\n")[0][:500]))
            yield pd.DataFrame(found, columns=["path", "kind", "error"])

    return run


def read_tolerant(
    spark: SparkSession, paths: Sequence[str], fmt: str = "parquet", deep: bool = True
) -> tuple[DataFrame | None, DataFrame]:
    """Rows of the readable files, and ``(path, error)`` of all others.

    Every file is opened by a task before anything is read: with ``deep`` all
    its pages are decoded, without it only its footer or first line is looked
    at, and damage further on stops the later read. Nothing is skipped without
    a reject. Files are read in groups of equal schema.
    """
    listed, bad = [], []
    for path in paths:
        try:
            listed.append(list_files(spark, path).select("path"))
        except Exception as e:  # noqa: BLE001 - a path that is not there is a reject
            bad.append((path, str(e).split("\n")[0][:500]))
    missing = spark.createDataFrame(bad, "path string, error string")
    if not listed:
        return None, missing
    seen = union_all(listed).repartition(4 * max(spark.sparkContext.defaultParallelism, 1), "path")
    seen = cut_lineage(seen.mapInPandas(_inspect(fmt, deep), "path string, kind string, error string"))
    rejects = seen.where(F.col("error").isNotNull()).select("path", "error").unionByName(missing)
    groups = (
        seen.where(F.col("error").isNull()).groupBy("kind").agg(F.collect_list("path").alias("paths")).orderBy("kind").collect()
    )  # file names only
    frames = [spark.read.option("header", "true").format(fmt).load(sorted(g["paths"])) for g in groups]
    return (union_all(frames) if frames else None), rejects

"""What several operators of this subpackage share."""

from __future__ import annotations

import ctypes
import gc
import uuid
from collections.abc import Callable, Iterable, Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from flowlab.session import checkpoint_dir

#: white space that separates words, as a Java pattern
SPACES = r"[\x20\x09-\x0D]+"
#: the same characters, for translate()
SPACE_CHARS = " \t\n\x0b\f\r"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def stored(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` into the shared folder and read it back.

    Cuts the lineage with a columnar, compressed copy that survives the loss
    of executors and is computed once however often it is read.
    """
    folder = f"{checkpoint_dir(df.sparkSession).rstrip('/')}/{name}-{uuid.uuid4().hex}"
    df.write.parquet(folder)
    return df.sparkSession.read.schema(df.schema).parquet(folder)


def quoted(name: str) -> str:
    """A column name as schema texts and ``F.col`` take it, blanks and dots included."""
    return "`" + name.replace("`", "``") + "`"


def fresh(name: str, *taken: DataFrame) -> str:
    """``name``, or a longer one where a table has such a column already."""
    used = {c.lower() for df in taken for c in df.columns}
    while name.lower() in used:
        name = f"_{name}"
    return name


def split_remainder(doc_id: str | Column, parts: int = 5) -> Column:
    """``crc32(doc_id as text) mod parts``; a null id counts as the empty text."""
    text = F.coalesce(F.col(doc_id).cast("string") if isinstance(doc_id, str) else doc_id, F.lit(""))
    return F.pmod(F.crc32(text.cast("binary")), F.lit(parts))


def words_of(text: bytes | None) -> list[bytes]:
    """Words between ASCII white space; ``bytes.split`` knows exactly that set."""
    return text.split() if text else []


def byte_column(column: pa.Array) -> Iterator[bytes | None]:
    """Values of a string column as UTF-8, without decoding them."""
    kind = pa.large_binary() if pa.types.is_large_string(column.type) else pa.binary()
    for value in column.cast(kind):
        yield value.as_py()


def frugal(run: Callable) -> Callable:
    """A function for ``mapInArrow`` that gives back its memory at the end.

    Python workers outlive their tasks; what their allocators keep would add up
    with the memory of the next stages.
    """

    def wrapped(batches):
        try:
            yield from run(batches)
        finally:
            release_memory()

    return wrapped


def release_memory() -> None:
    gc.collect()
    pa.default_memory_pool().release_unused()
    trim = getattr(ctypes.CDLL(None), "malloc_trim", None)  # of glibc
    if trim is not None:
        trim(0)


def batches_of(rows: Iterable[tuple], schema: pa.Schema, size: int = 20_000) -> Iterator[pa.RecordBatch]:
    """Tuples packed into Arrow batches."""
    waiting = []
    for row in rows:
        waiting.append(row)
        if len(waiting) >= size:
            yield _packed(waiting, schema)
            waiting = []
    if waiting:
        yield _packed(waiting, schema)


def _packed(rows: list[tuple], schema: pa.Schema) -> pa.RecordBatch:
    columns = zip(*rows)
    return pa.RecordBatch.from_arrays(
        [pa.array(c, type=f.type) for c, f in zip(columns, schema)], schema=schema
    )

"""Token counts from flat, unindexed token files by a separator scan.

A token file is nothing but numbers, 16 bits each, little-endian; a document
ends at the number ``END``. There is no index, so a file is cut into blocks of
bytes that know nothing of documents. Each block is searched for separators
with one vectorised comparison and reports, for every piece of a document in
it, the number of tokens; a prefix scan over the separators of the blocks
before gives each piece the ordinal of its document and its place in the file,
and the pieces of a document are added up.

Files are read by byte ranges in tasks, so a single file of any size is many
tasks, and written by Spark's own text writer, whose line separator is the
end-of-document number, so they are committed like any other output.

``write_token_files`` puts each document's id in front of its text as a line,
so that the file alone tells which document is which; ``count_documents`` takes
that line out of the counts again.

Defined results: a null or empty text has no tokens; ids may be of any length
and hold line breaks (they are escaped in the line), and null and empty ids
come back as what they were; repeated rows are repeated documents; an empty
file has no documents; tokens after the last separator are a document that was
cut off (``complete`` is false); an empty table gives an empty result. Other
columns are ignored, so their names cannot clash.
"""

from __future__ import annotations

import base64
import re
import uuid
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import tiktoken
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from flowlab.llm.common import byte_column, stored
from flowlab.session import checkpoint_dir
from flowlab.sources.files import list_files, open_input

#: the end-of-document number; it must fit 16 bits as all numbers do
END = 50_256
#: bytes of a block; a multiple of the width of a number
BLOCK_BYTES = 4 << 20
WIDTH = 2
#: tokens at the beginning of a document that the scan keeps; an id line that
#: is longer is read from the file once more
HEAD = 24
# Fixed value: how the vocabulary cuts a text into pieces.
PATTERN = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"

_encodings: dict[str, tiktoken.Encoding] = {}


def encoding(path: str) -> tiktoken.Encoding:
    """The byte-level vocabulary of a file of ranks, once per worker."""
    if path not in _encodings:
        with open(path, "rb") as f:
            ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}
        _encodings[path] = tiktoken.Encoding("file", pat_str=PATTERN, mergeable_ranks=ranks, special_tokens={})
    return _encodings[path]


def _escaped(key: str | None) -> str:
    """An id as one line; null has a form that no id can get."""
    return r"\N" if key is None else key.replace("\\", r"\\").replace("\n", r"\n")


def _unescaped(line: str) -> str | None:
    if line == r"\N":
        return None
    return re.sub(r"\\(.)", lambda m: "\n" if m[1] == "n" else m[1], line)


def write_token_files(docs: DataFrame, folder: str, path: str, text: str = "text", key: str = "doc_id") -> None:
    """Flat token files of all documents, each with its id as first line."""
    source = docs.select(F.col(f"`{key}`").cast("string").alias("key"), F.col(f"`{text}`").alias("text"))
    schema = pa.schema([("value", pa.binary())])

    def run(batches):
        model = encoding(path)
        for batch in batches:
            for at in range(0, batch.num_rows, 256):
                part = batch.slice(at, 256)
                keys = part.column(0).to_pylist()
                rows = [
                    np.concatenate(
                        [model.encode_ordinary(_escaped(k) + "\n"), model.encode_ordinary(t or "")]
                    ).astype("<u2").tobytes()
                    for k, t in zip(keys, part.column(1).to_pylist())
                ]
                yield pa.RecordBatch.from_arrays([pa.array(rows, pa.binary())], schema=schema)

    # the writer copies bytes as they are; the separator ends every document
    numbers = source.mapInArrow(run, "value binary").select(F.col("value").cast("string"))
    separator = END.to_bytes(WIDTH, "little").decode("latin-1")
    numbers.write.option("lineSep", separator).option("encoding", "ISO-8859-1").option("compression", "none").text(folder)


def blocks_of(spark: SparkSession, folder: str, block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """``file``, ``block``, ``start``, ``length`` (bytes) of all blocks; only
    the names and sizes of the files are listed."""
    if block_bytes % WIDTH:
        raise ValueError("a block must hold whole numbers")
    files = list_files(spark, folder).select(F.col("path").alias("file"), F.col("length").alias("bytes"))
    starts = F.sequence(F.lit(0).cast("long"), F.col("bytes") - 1, F.lit(block_bytes).cast("long"))
    return (
        files.where("bytes > 0")
        .select("file", "bytes", F.posexplode(starts).alias("block", "start"))
        .select("file", "block", "start", F.least(F.lit(block_bytes), F.col("bytes") - F.col("start")).alias("length"))
    )


def scan_block(data: bytes, end: int = END, head: int = HEAD) -> tuple[np.ndarray, list[bytes]]:
    """Tokens of each piece of a document in the block, and its first bytes.

    The last piece is what follows the last separator, possibly nothing.
    """
    numbers = np.frombuffer(data, dtype="<u2")
    ends = np.flatnonzero(numbers == end)
    starts = np.concatenate([[0], ends + 1])
    sizes = np.append(ends, len(numbers)) - starts
    first = [data[WIDTH * a : WIDTH * (a + min(n, head))] for a, n in zip(starts.tolist(), sizes.tolist())]
    return sizes, first


def scan(spark: SparkSession, folder: str, block_bytes: int = BLOCK_BYTES, end: int = END) -> DataFrame:
    """Documents of the files: ``file``, ``document`` (from 0), ``start`` (in
    tokens), ``n_tokens``, ``head`` (its first numbers), ``complete``."""
    blocks = blocks_of(spark, folder, block_bytes)
    schema = pa.schema(
        [
            ("file", pa.string()),
            ("block", pa.int32()),
            ("start", pa.int64()),
            ("piece", pa.int32()),
            ("n", pa.int64()),
            ("offset", pa.int64()),
            ("head", pa.binary()),
            ("closed", pa.bool_()),
        ]
    )

    def read(batches):
        for batch in batches:
            for row in batch.to_pylist():
                with open_input(row["file"]) as f:
                    f.seek(row["start"])
                    data = f.read(row["length"])
                if len(data) != row["length"] or len(data) % WIDTH:
                    raise ValueError(f"{row['file']} does not hold whole numbers of {WIDTH} bytes")
                sizes, first = scan_block(data, end)
                n = len(sizes)
                offset = np.cumsum(sizes + 1) - sizes - 1 + row["start"] // WIDTH
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array([row["file"]] * n, pa.string()),
                        pa.array(np.full(n, row["block"], np.int32)),
                        pa.array(np.full(n, row["start"], np.int64)),
                        pa.array(np.arange(n, dtype=np.int32)),
                        pa.array(sizes.astype(np.int64)),
                        pa.array(offset.astype(np.int64)),
                        pa.array(first, pa.binary()),
                        pa.array(np.arange(n) < n - 1),
                    ],
                    schema=schema,
                )

    kinds = "file string, block int, start long, piece int, n long, offset long, head binary, closed boolean"
    pieces = stored(blocks.repartition(F.col("file"), F.col("block")).mapInArrow(read, kinds), "pieces")
    # the prefix scan: separators in the blocks before, one row per block
    before = Window.partitionBy("file").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    carried = (
        pieces.groupBy("file", "block")
        .agg((F.count(F.lit(1)) - 1).alias("separators"))
        .select("file", "block", F.coalesce(F.sum("separators").over(before), F.lit(0)).alias("carried"))
    )
    placed = pieces.join(carried, ["file", "block"]).withColumn("document", F.col("carried") + F.col("piece"))
    # only the first and last piece of a block can belong to a document that
    # goes on; all others are whole
    last = F.max("piece").over(Window.partitionBy("file", "block"))
    marked = placed.withColumn("edge", (F.col("piece") == 0) | (F.col("piece") == last))
    whole = marked.where("not edge").select("file", "document", F.col("offset").alias("start"), F.col("n").alias("n_tokens"), "head", "closed")
    joined = (
        marked.where("edge")
        .groupBy("file", "document")
        .agg(
            F.min("offset").alias("start"),
            F.sum("n").alias("n_tokens"),
            F.expr("substring(array_join(transform(sort_array(collect_list(struct(block, hex(head)))), x -> x.col2), ''), 1, " + str(4 * HEAD) + ")").alias("hexed"),
            F.max("closed").alias("closed"),
        )
        .select("file", "document", "start", "n_tokens", F.unhex("hexed").alias("head"), "closed")
    )
    found = whole.unionByName(joined)
    # after the last separator there is no document unless tokens follow
    return found.where("closed or n_tokens > 0").withColumnRenamed("closed", "complete")


def _numbers_from(head: bytes, file: str, start: int) -> Iterator[int]:
    """Numbers of a document: those of its head, then those of the file."""
    yield from np.frombuffer(head, "<u2").tolist()
    with open_input(file) as f:
        f.seek(WIDTH * start + len(head))
        while data := f.read(1 << 14):
            yield from np.frombuffer(data, "<u2").tolist()


def count_documents(docs: DataFrame, path: str, text: str = "text", key: str = "doc_id", block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """Write the token files of all documents and count by scanning them.

    Columns: ``key``, n_tokens of the text, and the place of its first token.
    """
    spark = docs.sparkSession
    folder = f"{checkpoint_dir(spark).rstrip('/')}/tokens-{uuid.uuid4().hex}"
    write_token_files(docs, folder, path, text, key)
    found = scan(spark, folder, block_bytes).select("file", "document", "start", "n_tokens", "head")
    kind = docs.select(F.col(f"`{key}`")).schema[0].dataType.simpleString()

    def name(batches):
        model = encoding(path)
        for batch in batches:
            keys, lines = [], []
            places = zip(batch.column(0).to_pylist(), batch.column(2).to_pylist())
            for head, place in zip(byte_column(batch.column(4)), places):
                line, used = b"", 0
                for number in _numbers_from(head, *place):
                    line += model.decode_single_token_bytes(number)
                    used += 1
                    if line.endswith(b"\n"):
                        break
                keys.append(_unescaped(line[:-1].decode()))
                lines.append(used)
            used = np.array(lines, dtype=np.int64)
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array(keys, pa.string()),
                    pa.array(batch.column(3).to_numpy() - used),
                    batch.column(0),
                    batch.column(1).cast(pa.int64()),
                    pa.array(batch.column(2).to_numpy() + used),
                ],
                names=["key", "n_tokens", "file", "document", "start"],
            )

    named = found.mapInArrow(name, "key string, n_tokens long, file string, document long, start long")
    return named.select(
        F.col("key").cast(kind).alias(key), "n_tokens", F.element_at(F.split("file", "/"), -1).alias("file"), "document", "start"
    )

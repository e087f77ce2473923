"""Byte-level BPE with the tiktoken library and a local rank file.

A worker loads the rank file once. Texts longer than ``CHUNK_CHARS`` are cut
where the splitting pattern always ends a match, whatever stands around: a
character that is no white space followed by a blank or a line break, and a
letter next to a digit. No match crosses such a place and none looks behind
itself, so the ids of the pieces are the ids of the whole text. Decoding joins
the bytes of the tokens; they need not be valid UTF-8, so the result is binary.

Defined results: a null text is the empty one; an empty text has no ids and
decodes to no bytes; null ids decode to no bytes; names of special tokens are
ordinary text; a null id stays null; repeated rows give repeated rows; an empty
table an empty result. A long text without a safe place is encoded in one
piece. Other columns are ignored, so their names cannot clash.
"""

from __future__ import annotations

import base64
import hashlib
import re
from collections.abc import Iterator

import pyarrow as pa
import tiktoken
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_type

from flowlab.llm.common import batches_of

#: characters that are encoded at once
CHUNK_CHARS = 1 << 16

# str.isspace() knows more white space than the pattern, so the left side of
# the first place is never white space there
_SAFE = re.compile(r"\S(?=[ \n])|[0-9](?=[A-Za-z])|[A-Za-z](?=[0-9])")


def safe_chunks(text: str, size: int = CHUNK_CHARS) -> Iterator[str]:
    """``text`` in pieces of at least ``size`` characters, cut at safe places."""
    start = 0
    while len(text) - start > size:
        place = _SAFE.search(text, start + size - 1)
        if place is None:
            break
        yield text[start : place.end()]
        start = place.end()
    if start < len(text):
        yield text[start:] if start else text


class RankBpe:
    """Ranks of a file and a splitting pattern."""

    def __init__(self, path: str, pattern: str):
        with open(path, "rb") as f:
            ranks = {base64.b64decode(token): int(rank) for token, rank in map(bytes.split, f)}
        self.library = tiktoken.Encoding("local", pat_str=pattern, mergeable_ranks=ranks, special_tokens={})
        self.tokens = [b""] * (max(ranks.values(), default=-1) + 1)
        for token, rank in ranks.items():
            self.tokens[rank] = token
        self.decimals = [str(i) for i in range(len(self.tokens))]

    def encode(self, text: str | None) -> Iterator[list[int]]:
        """Ids of the text, chunk after chunk."""
        for chunk in safe_chunks(text or ""):
            yield self.library.encode_ordinary(chunk)

    def decode(self, ids) -> bytes:
        return b"".join(map(self.tokens.__getitem__, ids))

    def digest(self, text: str | None) -> tuple[int, str, str]:
        """Number of ids, digest of the ids in decimals, digest of the bytes."""
        n, written, back = 0, hashlib.sha256(), hashlib.sha256()
        for ids in self.encode(text):
            if not ids:
                continue
            if n:
                written.update(b" ")
            n += len(ids)
            written.update(" ".join(map(self.decimals.__getitem__, ids)).encode())
            back.update(self.decode(ids))
        return n, written.hexdigest(), back.hexdigest()


_loaded: dict[tuple[str, str], RankBpe] = {}


def load(path: str, pattern: str) -> RankBpe:
    """The ranks of a file, once per worker."""
    if (path, pattern) not in _loaded:
        _loaded[path, pattern] = RankBpe(path, pattern)
    return _loaded[path, pattern]


def _mapped(docs: DataFrame, key: str, value: str, row, out: list[tuple[str, pa.DataType, str]], path: str, pattern: str):
    """``key`` and the columns ``out`` that ``row(model, value)`` gives."""
    source = docs.select(F.col(f"`{key}`").alias("key"), F.col(f"`{value}`").alias("value"))
    kind = source.schema["key"].dataType
    schema = pa.schema([("key", to_arrow_type(kind)), *[(name, arrow) for name, arrow, _ in out]])

    def run(batches):
        model = load(path, pattern)
        for batch in batches:
            keys, values = batch.columns
            rows = ((k.as_py(), *row(model, v.as_py())) for k, v in zip(keys, values))
            yield from batches_of(rows, schema, 500)

    columns = ", ".join(["key " + kind.simpleString(), *[f"{name} {sql}" for name, _, sql in out]])
    return source.mapInArrow(run, columns).withColumnRenamed("key", key)


def encode(docs: DataFrame, path: str, pattern: str, text: str = "text", key: str = "doc_id") -> DataFrame:
    """``key`` and ``ids`` (array of int) of every whole text.

    ``path`` is a rank file that every executor can open.
    """

    def row(model: RankBpe, value: str | None) -> tuple:
        return ([i for ids in model.encode(value) for i in ids],)

    return _mapped(docs, key, text, row, [("ids", pa.list_(pa.int32()), "array<int>")], path, pattern)


def decode(encoded: DataFrame, path: str, pattern: str, ids: str = "ids", key: str = "doc_id") -> DataFrame:
    """``key`` and ``raw`` (binary), the bytes of the ids."""

    def row(model: RankBpe, value: list[int] | None) -> tuple:
        return (model.decode(value or ()),)

    return _mapped(encoded, key, ids, row, [("raw", pa.binary(), "binary")], path, pattern)


def digests(docs: DataFrame, path: str, pattern: str, text: str = "text", key: str = "doc_id") -> DataFrame:
    """Encode every text, decode the ids, and keep the count and two digests.

    Columns: ``key``, n_tokens, ids_sha256 (decimal ids joined by one blank),
    decoded_sha256 (the decoded bytes).
    """
    out = [("n_tokens", pa.int64(), "long"), ("ids_sha256", pa.string(), "string"), ("decoded_sha256", pa.string(), "string")]
    return _mapped(docs, key, text, RankBpe.digest, out, path, pattern)

"""Byte-pair encoding and decoding with an index of pair occurrences.

A partition's distinct chunks (runs without white space) are encoded together:
their symbols lie in one array, an index maps every mergeable pair to all its
positions, and the ranks that occur are applied in ascending order. A merge
touches only the positions of its pair and the two lists of every position
beside it. Frequent chunks stay in a bounded cache of the worker.

Defined results: a null text is the empty one; an empty text has no tokens and
decodes to the empty text; a null id stays null; repeated rows give repeated
rows; an empty table an empty result. Other columns are ignored, so their
names cannot clash.
"""

from __future__ import annotations

import hashlib
import heapq
import json
import re
import unicodedata
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame

from flowlab.llm.common import batches_of, frugal, quoted

#: chunks kept by a worker between batches
CACHE_CHUNKS = 200_000
#: distinct chunks that are encoded together
GROUP_CHUNKS = 100_000

#: bits of a symbol in a pair key
_SHIFT = 20
# white space of the normalizer's pattern that str.split() does not share
_CONTROL = re.compile("[\x1c-\x1f]")
_NOT_SPACE = re.compile("[^\t-\r \x85\xa0  -     　]+")


class WordBpe:
    """A tokenizer file with word ends, lower case and byte-level letters."""

    def __init__(self, path: str):
        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        model = spec["model"]
        vocab = model["vocab"]
        suffix = model["end_of_word_suffix"]
        self.special = {t["content"]: t["id"] for t in spec["added_tokens"]}
        ids = {**vocab, **self.special}
        self.tokens = [b""] * (max(ids.values()) + 1)
        for token, i in ids.items():
            self.tokens[i] = token.encode()
        letters = _byte_letters()
        self.inner = np.array([vocab[c] for c in letters], dtype=np.int32)
        self.final = np.array([vocab[c + suffix] for c in letters], dtype=np.int32)
        merges = [m if isinstance(m, list) else m.split(" ") for m in model["merges"]]
        left = np.array([vocab[a] for a, _ in merges], dtype=np.int64)
        right = np.array([vocab[b] for _, b in merges], dtype=np.int64)
        self.left, self.right = left, right
        self.merged = np.array([vocab[a + b] for a, b in merges], dtype=np.int32)
        keys = left << _SHIFT | right
        self.by_key = np.argsort(keys, kind="stable")
        self.keys = keys[self.by_key]
        pieces = next(p for p in spec["pre_tokenizer"]["pretokenizers"] if p["type"] == "Split")
        self.piece = regex.compile(pieces["pattern"]["Regex"])
        self.cut = re.compile("|".join(map(re.escape, self.special))) if self.special else None
        self.cache: dict[str, bytes] = {}

    # --- text to chunks to pieces

    def chunks(self, text: str | None) -> list[str]:
        if not text:
            return []
        if self.cut and "<|" in text:
            text = self.cut.sub(r" \g<0> ", text)
        return _NOT_SPACE.findall(text) if _CONTROL.search(text) else text.split()

    def _pieces(self, chunk: str) -> list[bytes]:
        if chunk.isascii():
            chunk = chunk.lower()
            if chunk.isalpha():
                return [chunk.encode()]
        else:
            # letter by letter: no special form of sigma at the end of a word
            chunk = unicodedata.normalize("NFC", chunk).replace("Σ", "σ").lower()
        return [p.encode() for p in self.piece.findall(chunk)]

    # --- merging

    def _ranks(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        """Rank of each pair, -1 where the pair never merges."""
        wanted = a.astype(np.int64) << _SHIFT | b
        at = np.minimum(np.searchsorted(self.keys, wanted), len(self.keys) - 1)
        return np.where(self.keys[at] == wanted, self.by_key[at], -1)

    def encode_pieces(self, pieces: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        """All token ids in order, and the number of tokens of each piece."""
        lengths = np.array([len(p) for p in pieces], dtype=np.int64)
        if not len(lengths):
            return np.zeros(0, np.int32), lengths
        data = np.frombuffer(b"".join(pieces), dtype=np.uint8)
        ends = np.cumsum(lengths)
        n = len(data)
        symbol = self.inner[data]
        symbol[ends - 1] = self.final[data[ends - 1]]
        after = np.arange(1, n + 1)
        after[ends - 1] = -1
        before = np.arange(-1, n - 1)
        before[ends - lengths] = -1
        alive = np.ones(n, dtype=bool)
        touched = np.full(n, -1)  # last rank that changed a position
        index: dict[int, list[np.ndarray]] = {}
        active: list[int] = []

        def note(positions: np.ndarray) -> None:
            """Enter the pairs that start at ``positions`` into the index."""
            positions = positions[after[positions] >= 0]
            if not len(positions):
                return
            ranks = self._ranks(symbol[positions], symbol[after[positions]])
            known = ranks >= 0
            ranks, positions = ranks[known], positions[known]
            if not len(ranks):
                return
            order = np.argsort(ranks, kind="stable")
            ranks, positions = ranks[order], positions[order]
            cuts = np.flatnonzero(ranks[1:] != ranks[:-1]) + 1
            starts = [0, *cuts.tolist(), len(ranks)]
            for i, rank in enumerate(ranks[starts[:-1]].tolist()):
                lists = index.get(rank)
                if lists is None:
                    lists = index[rank] = []
                    heapq.heappush(active, rank)
                lists.append(positions[starts[i] : starts[i + 1]])

        note(np.arange(n))
        while active:
            rank = heapq.heappop(active)
            lists = index.pop(rank)
            at = lists[0] if len(lists) == 1 else np.concatenate(lists)
            a, b = self.left[rank], self.right[rank]
            nxt = after[at]
            valid = alive[at] & (symbol[at] == a) & (nxt >= 0)
            valid &= symbol[nxt] == b
            at = at[valid]
            if a == b and len(at) > 1:
                at = _not_overlapping(np.sort(at), after)
            if not len(at):
                continue
            gone = after[at]
            symbol[at] = self.merged[rank]
            alive[gone] = False
            nxt = after[gone]
            after[at] = nxt
            linked = nxt >= 0
            before[nxt[linked]] = at[linked]
            touched[at] = rank
            prev = before[at]
            prev = prev[prev >= 0]
            note(np.concatenate([at, prev[touched[prev] != rank]]))
        kept = np.concatenate([[0], np.cumsum(alive)])
        return symbol[alive], kept[ends] - kept[ends - lengths]

    def _learn(self, chunks: list[str]) -> None:
        for start in range(0, len(chunks), GROUP_CHUNKS):
            group = chunks[start : start + GROUP_CHUNKS]
            pieces, per_chunk = [], []
            for chunk in group:
                own = [] if chunk in self.special else self._pieces(chunk)
                pieces += own
                per_chunk.append(len(own))
            tokens, counts = self.encode_pieces(pieces)
            data = tokens.astype("<u4").tobytes()
            ends = np.concatenate([[0], np.cumsum(counts)])
            cuts = (4 * ends[np.concatenate([[0], np.cumsum(per_chunk)])]).tolist()
            for i, chunk in enumerate(group):
                self.cache[chunk] = data[cuts[i] : cuts[i + 1]]
        for chunk, i in self.special.items():
            self.cache[chunk] = int(i).to_bytes(4, "little")

    # --- whole texts

    def encode_batch(self, texts: list[str | None]) -> list[bytes]:
        """Ids of each text as little-endian unsigned 32-bit integers."""
        split = [self.chunks(text) for text in texts]
        seen: set[str] = set()
        seen.update(*split)
        if len(self.cache) > CACHE_CHUNKS:  # what this batch needs is kept
            self.cache = {c: self.cache[c] for c in seen.intersection(self.cache)}
        new = seen.difference(self.cache)
        if new:
            self._learn(list(new))
        known = self.cache.__getitem__
        return [b"".join(map(known, chunks)) for chunks in split]

    def decode(self, ids: bytes | np.ndarray) -> bytes:
        """Text of the ids in UTF-8: the file names no decoder, so tokens are
        joined by blanks and special tokens are kept."""
        numbers = np.frombuffer(ids, "<u4") if isinstance(ids, bytes) else ids
        return b" ".join(map(self.tokens.__getitem__, numbers.tolist()))


def _byte_letters() -> list[str]:
    """The printable letter of each byte: itself where visible, else the next
    free code point from 256 on."""
    visible = [*range(33, 127), *range(161, 173), *range(174, 256)]
    letters, free = [], 256
    for b in range(256):
        if b in visible:
            letters.append(chr(b))
        else:
            letters.append(chr(free))
            free += 1
    return letters


def _not_overlapping(at: np.ndarray, after: np.ndarray) -> np.ndarray:
    """Of runs of the same symbol take every second position, from the left."""
    taken, blocked = [], -1
    for p in at.tolist():
        if p != blocked:
            taken.append(p)
            blocked = int(after[p])
    return np.array(taken, dtype=np.int64)


_loaded: dict[str, WordBpe] = {}


def load(path: str) -> WordBpe:
    """The tokenizer of a file, once per worker."""
    if path not in _loaded:
        _loaded[path] = WordBpe(path)
    return _loaded[path]


def text_groups(ids: list, texts: pa.Array, most_chars: int = 3_000_000) -> Iterator[tuple[list, list]]:
    """Rows of a batch in groups of bounded text size; a long text is a group."""
    keys, group, size = [], [], 0
    for key, value in zip(ids, texts):
        text = value.as_py()
        keys.append(key)
        group.append(text)
        size += len(text or "")
        if size > most_chars:
            yield keys, group
            keys, group, size = [], [], 0
    if group:
        yield keys, group


def encode(docs: DataFrame, path: str, text: str = "text", key: str = "doc_id") -> DataFrame:
    """``key`` and ``ids`` (array of int) of every whole text.

    ``path`` is a tokenizer file that every executor can open.
    """
    source = docs.select(key, text)
    schema = pa.schema([(key, _arrow_type(source, key)), ("ids", pa.list_(pa.int32()))])

    def run(batches):
        model = load(path)
        for batch in batches:
            for keys, texts in text_groups(batch.column(0).to_pylist(), batch.column(1)):
                ids = [np.frombuffer(x, "<u4").astype(np.int32) for x in model.encode_batch(texts)]
                yield from batches_of(zip(keys, ids), schema, 2_000)

    return source.mapInArrow(run, f"{quoted(key)} {source.schema[key].dataType.simpleString()}, ids array<int>")


def decode(encoded: DataFrame, path: str, ids: str = "ids", key: str = "doc_id") -> DataFrame:
    """``key`` and ``text`` of encoded rows; null ids give the empty text."""
    source = encoded.select(key, ids)
    schema = pa.schema([(key, _arrow_type(source, key)), ("text", pa.string())])

    def run(batches):
        model = load(path)
        for batch in batches:
            keys = batch.column(0).to_pylist()
            rows = ((k, model.decode(np.array(v.as_py() or [], np.int64)).decode()) for k, v in zip(keys, batch.column(1)))
            yield from batches_of(rows, schema, 2_000)

    return source.mapInArrow(run, f"{quoted(key)} {source.schema[key].dataType.simpleString()}, text string")


def digests(docs: DataFrame, path: str, text: str = "text", key: str = "doc_id") -> DataFrame:
    """Encode and decode every text in one pass and keep counts and digests.

    Columns: ``key``, n_tokens, ids_sha256 (ids as little-endian unsigned
    32-bit integers), decoded_sha256 (UTF-8).
    """
    source = docs.select(key, text)
    schema = pa.schema(
        [(key, _arrow_type(source, key)), ("n_tokens", pa.int64()), ("ids_sha256", pa.string()), ("decoded_sha256", pa.string())]
    )

    def run(batches):
        model = load(path)
        for batch in batches:
            for keys, texts in text_groups(batch.column(0).to_pylist(), batch.column(1)):
                rows = (
                    (k, len(ids) // 4, hashlib.sha256(ids).hexdigest(), hashlib.sha256(model.decode(ids)).hexdigest())
                    for k, ids in zip(keys, model.encode_batch(texts))
                )
                yield from batches_of(rows, schema)
        model.cache.clear()  # workers outlive the stage

    kind = source.schema[key].dataType.simpleString()
    return source.mapInArrow(frugal(run), f"{quoted(key)} {kind}, n_tokens long, ids_sha256 string, decoded_sha256 string")


def _arrow_type(df: DataFrame, column: str) -> pa.DataType:
    from pyspark.sql.pandas.types import to_arrow_type

    return to_arrow_type(df.schema[column].dataType)

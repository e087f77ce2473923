"""Alignment of two tokenizers over distinct texts.

Documents are shuffled by their full text; every distinct text is encoded by a
byte-level BPE file (A) and by a sentencepiece model (B) and aligned once. Byte
offsets where tokens of both end cut the tokens into groups; all pairs of an A
and a B token of a group are links. How many documents hold a pair linked is
the sum of the multiplicities of the texts that hold it; the measures of a text
are joined back to the documents by the digest of the text. A text that holds
more than one of ``HOT_SHARES`` equal parts of the rows is split for that join,
by row, into as many parts as it has such shares.

Long texts are encoded in pieces that begin with a blank after a character
that is none: no token of A crosses such a place, and none of B, because the
model is only cut there if no piece of its vocabulary has a blank after another
character. Memory follows one piece, and the distinct pairs of a text.

Defined results: null and empty texts, and texts whose joined tokens of A or B
are not a blank and the text, have no tokens: zeros and the empty string. Names
of special tokens are ordinary text. Repeated rows and null ids keep their own
rows; an empty table gives an empty result. Other columns are ignored, so their
names cannot clash.
"""

from __future__ import annotations

import hashlib
import json
import re
from collections.abc import Iterator
from itertools import chain, count, islice

import numpy as np
import pyarrow as pa
import sentencepiece
import tiktoken
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from flowlab.llm.common import batches_of, stored

#: characters of texts that are encoded and aligned at once
BATCH_CHARS = 1 << 20
#: characters of a piece of a long text
PIECE_CHARS = 1 << 16
#: links of a group that are written out one by one
SMALL_GROUP = 4_096
#: a text with more than 1/HOT_SHARES of the rows is split; at most as many are
HOT_SHARES = 256
#: distinct pairs that are sent to every task
BROADCAST_PAIRS = 500_000

_BLANK = "▁"  # the sign for a blank in pieces
# something follows the blank: the model adds none to an empty text
_PLACE = re.compile(r"\S(?= [\s\S])")


class Aligner:
    """Both tokenizers and their tokens as bytes."""

    def __init__(self, byte_file: str, pattern: str, piece_file: str):
        with open(byte_file, encoding="utf-8") as f:
            spec = json.load(f)
        special = {t["content"] for t in spec["added_tokens"]}
        vocab = {t: i for t, i in spec["model"]["vocab"].items() if t not in special}
        parts = [m if isinstance(m, list) else m.split(" ") for m in spec["model"]["merges"]]
        merged = [vocab[a + b] for a, b in parts]
        if spec["normalizer"] or merged != sorted(merged):
            raise ValueError("not a byte-level file whose ids follow the order of its merges")
        letter = _bytes_of_letters()
        ranks = {bytes(letter[c] for c in token): i for token, i in vocab.items()}
        self.bytewise = tiktoken.Encoding("bytewise", pat_str=pattern, mergeable_ranks=ranks, special_tokens={})
        self.piecewise = sentencepiece.SentencePieceProcessor(model_file=piece_file)
        self.a_bytes = _by_id(ranks)
        names = self.piecewise.id_to_piece(list(range(self.piecewise.get_piece_size())))
        self.b_bytes = [_piece_bytes(name) for name in names]
        self.a_length = np.array(list(map(len, self.a_bytes)), dtype=np.int64)
        self.b_length = np.array(list(map(len, self.b_bytes)), dtype=np.int64)
        self.divisible = not any(_BLANK in name.lstrip(_BLANK) for name in names)
        # every id in decimals with each sign that may follow it
        self.written = [f"{i}{sign}" for i in range(max(len(self.a_bytes), len(names))) for sign in ",|;"]

    # --- encoding

    def pieces(self, text: str) -> list[str]:
        """A blank and the text, in pieces that each begin with a blank."""
        whole = " " + text
        cut, start = [], 0
        while self.divisible and len(whole) - start > PIECE_CHARS:
            place = _PLACE.search(whole, start + PIECE_CHARS)
            if place is None:
                break
            cut.append(whole[start : place.end()])
            start = place.end()
        cut.append(whole[start:] if start else whole)
        return cut

    def encode(self, texts: list[str]) -> tuple[list[list[int]], list[list[int]]]:
        """Ids of each text by A and by B; empty where bytes get lost."""
        a_ids, b_ids = [], []
        pieces = [self.pieces(t) for t in texts]
        flat = [p for own in pieces for p in own]
        encoded_b = iter(self.piecewise.encode([p[1:] for p in flat], num_threads=1))
        for text, own in zip(texts, pieces):
            a = list(chain.from_iterable(map(self.bytewise.encode_ordinary, own)))
            b = list(chain.from_iterable(islice(encoded_b, len(own))))
            raw = (" " + text).encode()
            same = b"".join(map(self.a_bytes.__getitem__, a)) == raw == b"".join(map(self.b_bytes.__getitem__, b))
            a_ids.append(a if same else [])
            b_ids.append(b if same else [])
        return a_ids, b_ids

    # --- alignment

    def align(self, texts: list[str]) -> Iterator[tuple]:
        """Per text: n_a, n_b, n_groups, n_links, groups, pairs, links.

        ``groups`` is the written form, ``pairs`` numbers each pair of ids once
        (A id times the size of B's vocabulary plus B id), ``links`` counts its
        links.
        """
        a_ids, b_ids = self.encode(texts)
        n_a = np.array(list(map(len, a_ids)), dtype=np.int64)
        n_b = np.array(list(map(len, b_ids)), dtype=np.int64)
        a = np.fromiter(chain.from_iterable(a_ids), np.int64, n_a.sum())
        b = np.fromiter(chain.from_iterable(b_ids), np.int64, n_b.sum())
        del a_ids, b_ids
        a_end, b_end = np.cumsum(self.a_length[a]), np.cumsum(self.b_length[b])
        total = int(a_end[-1]) if len(a_end) else 0
        ends = np.zeros(total + 1, dtype=np.int8)
        ends[a_end] = 1
        ends[b_end] += 1
        before = np.cumsum(ends == 2)  # common ends up to an offset
        a_group, b_group = before[a_end - 1], before[b_end - 1]
        groups = int(before[-1])
        wide, high = np.bincount(a_group, minlength=groups), np.bincount(b_group, minlength=groups)
        owner = np.repeat(np.arange(len(texts)), n_a)[np.cumsum(wide) - 1] if groups else np.zeros(0, np.int64)
        n_groups = np.bincount(owner, minlength=len(texts))
        n_links = np.zeros(len(texts), dtype=np.int64)
        np.add.at(n_links, owner, wide * high)
        written = self._write(a, b, a_group, b_group, wide, high)
        key, links = self._pairs(a, b, wide, high, owner)
        size = len(self.a_bytes) * len(self.b_bytes)
        cuts = np.searchsorted(key, np.arange(len(texts) + 1) * size)
        at = 0
        for i in range(len(texts)):
            n = int(n_a[i] + n_b[i])
            own = slice(cuts[i], cuts[i + 1])
            form = "".join(written[at : at + n])[:-1]
            at += n
            yield (
                *map(int, (n_a[i], n_b[i], n_groups[i], n_links[i])), form, key[own] - i * size, links[own]
            )

    def _write(self, a, b, a_group, b_group, wide, high) -> list[str]:
        """All ids in written form: A's tokens of a group, then B's."""
        place = np.empty(len(a) + len(b), dtype=np.int64)
        a_last, b_last = np.cumsum(wide), np.cumsum(high)
        a_place = np.arange(len(a)) + (b_last - high)[a_group]
        b_place = np.arange(len(b)) + a_last[b_group]
        a_sign, b_sign = np.zeros(len(a), np.int64), np.zeros(len(b), np.int64)
        a_sign[a_last - 1], b_sign[b_last - 1] = 1, 2
        place[a_place], place[b_place] = 3 * a + a_sign, 3 * b + b_sign
        return list(map(self.written.__getitem__, place.tolist()))

    def _pairs(self, a, b, wide, high, owner) -> tuple[np.ndarray, np.ndarray]:
        """Distinct (text, A id, B id) as ordered numbers, and their links."""
        width = len(self.b_bytes)
        size = len(self.a_bytes) * width
        a_first, b_first = np.cumsum(wide) - wide, np.cumsum(high) - high
        product = wide * high
        small = np.flatnonzero(product <= SMALL_GROUP)
        group = np.repeat(small, product[small])
        inner = np.arange(len(group)) - np.repeat(np.cumsum(product[small]) - product[small], product[small])
        left = a[a_first[group] + inner // high[group]]
        right = b[b_first[group] + inner % high[group]]
        keys = [owner[group] * size + left * width + right]
        weights = [np.ones(len(group), dtype=np.int64)]
        for g in np.flatnonzero(product > SMALL_GROUP).tolist():  # ids that repeat are counted first
            a_own, a_n = np.unique(a[a_first[g] : a_first[g] + wide[g]], return_counts=True)
            b_own, b_n = np.unique(b[b_first[g] : b_first[g] + high[g]], return_counts=True)
            keys.append((owner[g] * size + a_own[:, None] * width + b_own).ravel())
            weights.append((a_n[:, None] * b_n).ravel())
        if len(keys) == 1:
            return np.unique(keys[0], return_counts=True)
        key, weight = np.concatenate(keys), np.concatenate(weights)
        order = np.argsort(key, kind="stable")
        key, weight = key[order], weight[order]
        first = np.flatnonzero(np.concatenate([[True], key[1:] != key[:-1]]))
        return key[first], np.add.reduceat(weight, first)


def _bytes_of_letters() -> dict[str, int]:
    """Byte of each letter of a byte-level file: visible bytes stand for
    themselves, the others are numbered from 256 on."""
    visible = {*range(33, 127), *range(161, 173), *range(174, 256)}
    hidden = [b for b in range(256) if b not in visible]
    return {chr(b): b for b in visible} | {chr(256 + i): b for i, b in enumerate(hidden)}


def _piece_bytes(name: str) -> bytes:
    if re.fullmatch("<0x[0-9A-F]{2}>", name):
        return bytes([int(name[3:5], 16)])
    return name.replace(_BLANK, " ").encode()


def _by_id(ranks: dict[bytes, int]) -> list[bytes]:
    tokens = [b""] * (max(ranks.values()) + 1)
    for token, i in ranks.items():
        tokens[i] = token
    return tokens


_loaded: dict[tuple, Aligner] = {}


def load(*files: str) -> Aligner:
    """The aligner of two files, once per worker."""
    if files not in _loaded:
        _loaded[files] = Aligner(*files)
    return _loaded[files]


# ---------------------------------------------------------------------------
# documents
# ---------------------------------------------------------------------------

_ALIGNED = pa.schema(
    [
        ("text_id", pa.int64()),
        ("text_key", pa.binary()),
        ("copies", pa.int64()),
        *[(c, pa.int64()) for c in ("n_a", "n_b", "n_groups", "n_links")],
        ("groups", pa.string()),
        ("pairs", pa.list_(pa.int64())),
        ("links", pa.list_(pa.int64())),
    ]
)
_ALIGNED_SQL = (
    "text_id long, text_key binary, copies long, n_a long, n_b long, n_groups long, n_links long, "
    "groups string, pairs array<long>, links array<long>"
)
_COUNTS = ("n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum")


def _key(text: str) -> Column:
    return F.unhex(F.sha2(F.col(text).cast("binary"), 256))


def distinct_texts(docs: DataFrame, text: str = "text") -> DataFrame:
    """``text``, ``copies``: documents by their full text, without empty ones."""
    named = docs.select(F.col(f"`{text}`").cast("string").alias("text"))
    return named.where(F.length("text") > 0).groupBy("text").agg(F.count(F.lit(1)).alias("copies"))


def aligned(texts: DataFrame, byte_file: str, pattern: str, piece_file: str, digest: bool = False) -> DataFrame:
    """Each distinct text (``text``, ``copies``) encoded and aligned.

    ``text_id`` numbers the rows of one computation (store it before use),
    ``text_key`` is the SHA-256 of the text; the other columns are those of
    :meth:`Aligner.align`, ``groups`` as its SHA-256 if ``digest`` is set.
    """

    def row(number, key, copies, found):
        n_a, n_b, n_groups, n_links, form, pairs, links = found
        if digest and n_a:
            form = hashlib.sha256(form.encode()).hexdigest()
        return number, key.as_py(), copies.as_py(), n_a, n_b, n_groups, n_links, form, pairs, links

    def run(batches):
        model = load(byte_file, pattern, piece_file)
        number = count(TaskContext.get().partitionId() << 40)
        for batch in batches:
            keys, copies, values = batch.columns
            for first, group in _bounded(values):
                found = zip(number, keys.slice(first), copies.slice(first), model.align(group))
                yield from batches_of((row(*one) for one in found), _ALIGNED, 200)

    return texts.select(_key("text").alias("k"), "copies", "text").mapInArrow(run, _ALIGNED_SQL)


def _bounded(values: pa.Array) -> Iterator[tuple[int, list[str]]]:
    """Texts in groups of bounded size, with the place of the first."""
    group, size, first = [], 0, 0
    for i, value in enumerate(values):
        group.append(value.as_py())
        size += len(group[-1])
        if size > BATCH_CHARS:
            yield first, group
            group, size, first = [], 0, i + 1
    if group:
        yield first, group


def pair_counts(texts: DataFrame, b_size: int) -> DataFrame:
    """``pair``, ``count`` (documents that hold it linked), ``best`` (no pair of
    the same A id has more) of aligned texts; a row per pair of ids."""
    counted = texts.select(F.explode("pairs").alias("pair"), "copies").groupBy("pair").agg(F.sum("copies").alias("count"))
    counts = stored(counted.withColumn("a", F.expr(f"pair div {b_size}")), "pair-counts")
    highest = counts.groupBy("a").agg(F.max("count").alias("most"))
    return counts.join(highest, "a").select("pair", "count", (F.col("count") == F.col("most")).alias("best"))


def link_measures(texts: DataFrame, counts: DataFrame) -> DataFrame:
    """``text_id``, n_best, count_sum of aligned texts with links.

    A small table of counts is sent to the texts; a larger one meets their
    pairs in a shuffle by pair, where a pair has a row per distinct text.
    """
    if counts.limit(BROADCAST_PAIRS + 1).count() <= BROADCAST_PAIRS:
        counts = F.broadcast(counts)
    pairs = texts.select("text_id", F.explode(F.arrays_zip("pairs", "links")).alias("e"))
    return (
        pairs.select("text_id", F.col("e.pairs").alias("pair"), F.col("e.links").alias("links"))
        .join(counts, "pair")
        .groupBy("text_id")
        .agg(
            F.sum(F.when(F.col("best"), F.col("links")).otherwise(0)).alias("n_best"),
            F.sum(F.col("links") * F.col("count")).alias("count_sum"),
        )
    )


def align_documents(
    docs: DataFrame,
    byte_file: str,
    pattern: str,
    piece_file: str,
    text: str = "text",
    key: str = "doc_id",
    digest: bool = False,
) -> DataFrame:
    """Measures of every document: ``key``, n_a, n_b, n_groups, n_links, n_best
    (links of pairs with the highest count of their A id), count_sum (counts
    summed over the links), and ``groups`` or its digest ``groups_sha256``.

    ``pattern`` splits texts for the byte-level file. All executors can open
    both files.
    """
    texts = stored(aligned(distinct_texts(docs, text), byte_file, pattern, piece_file, digest), "aligned-texts")
    b_size = sentencepiece.SentencePieceProcessor(model_file=piece_file).get_piece_size()
    counts = stored(pair_counts(texts, b_size), "pair-ranks")
    form = "groups_sha256" if digest else "groups"
    found = (
        texts.drop("pairs", "links")
        .join(link_measures(texts, counts), "text_id", "left")
        .select("text_key", "copies", *_COUNTS, F.col("groups").alias(form))
    )
    return _by_document(docs, text, key, found, texts)


def _by_document(docs: DataFrame, text: str, key: str, found: DataFrame, texts: DataFrame) -> DataFrame:
    """Join the rows of the texts to the documents; texts that many documents
    share are split by row, rows without text are spread."""
    total = texts.agg(F.sum("copies")).first()[0] or 0
    often = texts.where(F.col("copies") * HOT_SHARES > total).select("text_key", "copies").collect()
    split = docs.sparkSession.createDataFrame(
        [(r.text_key, -(-r.copies * HOT_SHARES // total)) for r in often], "text_key binary, parts long"
    )
    parts = F.coalesce("parts", F.lit(1))
    row = F.monotonically_increasing_id()
    rows = (
        docs.select(F.col(f"`{key}`").alias("key"), F.when(F.length(f"`{text}`") > 0, _key(f"`{text}`")).alias("text_key"))
        .join(F.broadcast(split), "text_key", "left")
        .select("key", "text_key", F.pmod(row, F.when(F.col("text_key").isNull(), HOT_SHARES).otherwise(parts)).alias("part"))
    )
    copies = (
        found.join(F.broadcast(split), "text_key", "left")
        .withColumn("part", F.explode(F.sequence(F.lit(0).cast("long"), parts - 1)))
        .drop("parts", "copies")
    )
    form = found.columns[-1]
    return rows.join(copies, ["text_key", "part"], "left").select(
        F.col("key").alias(key),
        *[F.coalesce(c, F.lit(0)).alias(c) for c in _COUNTS],
        F.coalesce(form, F.lit("")).alias(form),
    )

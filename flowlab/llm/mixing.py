"""Mixing sources to target weights with a hypergeometric splitting tree.

Each source is a stream of words: its documents in a seeded order, one after
the other. The stream is cut into blocks of ``block_words``; a source with a
target of ``q`` words gives ``q // size`` whole passes of its stream and, of one
more pass, the blocks that come first in a permutation, the last one cut where
the target is met. So every source meets its target to the word, and no
document is taken more than ``MOST_REPEATS`` times.

The drawn blocks of all sources are dealt to the output shards by a splitting
tree: a node halves its shards, gives the left half its share of blocks, and
draws how many come from each source from a multivariate hypergeometric
distribution. Every shard walks from the root to its leaf with random numbers
that depend on the node alone, so all shards agree without exchanging anything
and their quotas add up exactly. A source's draws are then given out in order,
which keeps the blocks of the shards disjoint, and each shard orders its blocks
by a seeded hash. The number of shards grows with the blocks. The dealt pieces
are written once, shard by shard in that order, and every result is read from
them: the words taken of a document are those of its pieces in the shards, and
the mix as rows has a row per piece, in the order of the shards.

Running positions within a source come from counts by hash bucket, so a source
with most rows is never sorted in one task.

Defined results: a null source is a source of its own, last in the order; a
document without words (null, empty) has size 0 and nothing is taken of it; a
source of size 0 has target 0; repeated rows are separate documents; a null id
stays null; an empty table gives an empty result. Only ``key``, ``text`` and
``source`` are read, so other columns cannot clash.
"""

from __future__ import annotations

import math
import re
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from flowlab.llm.common import SPACES, release_memory, stored
from flowlab.operators.scale import checked_broadcast

#: weights of the sources, repeated over their order
WEIGHTS = (3, 1, 2)
SHARE_PERCENT = 150
MOST_REPEATS = 2
BLOCK_WORDS = 512
#: blocks of an output shard, at most on average
SHARD_BLOCKS = 4_096
#: shards of a small mix
LEAST_SHARDS = 8
#: entries of the table of shard borders (sources times shards); with so many
#: sources that it would be larger, shards are larger instead
MOST_BORDERS = 4_000_000
SEED = 11
#: blocks from which numpy draws no hypergeometric numbers
NUMPY_TOTAL = 1_000_000_000
#: draws up to this many blocks are binomial in so large a total
FEW_BLOCKS = 10_000
FEISTEL_ROUNDS = 6
#: sources whose totals may be handled on the driver, one row each
MOST_SOURCES = 100_000


def sizes(docs: DataFrame, text: str = "text", key: str = "doc_id", source: str = "source", row: str | None = None) -> DataFrame:
    """One row per document: ``_row``, ``_key``, ``_source``, ``_size`` in words,
    ``_hash``. ``row`` names a column that identifies rows, if there is one."""
    words = F.size(F.split(F.col(text), SPACES)).cast("long")
    # split() gives an empty string before a leading and after a trailing gap
    edges = F.when(F.col(text).rlike(r"^[\x20\x09-\x0D]"), 1).otherwise(0) + F.when(
        F.col(text).rlike(r"[\x20\x09-\x0D]\z"), 1
    ).otherwise(0)
    blank = ~F.coalesce(F.col(text).rlike(r"[^\x20\x09-\x0D]"), F.lit(False))
    return docs.select(
        (F.col(row) if row else F.monotonically_increasing_id()).alias("_row"),
        F.col(key).alias("_key"),
        F.col(source).cast("string").alias("_source"),
        F.when(blank, F.lit(0)).otherwise(words - edges).cast("long").alias("_size"),
        F.xxhash64(F.lit(SEED), F.col(key).cast("string"), F.xxhash64(text)).alias("_hash"),
    )


def targets_of(names: list, totals: list[int], weights=WEIGHTS, percent: int = SHARE_PERCENT, most: int = MOST_REPEATS) -> list[float]:
    """Targets of the sources: shares by weight, capped at ``most`` times the
    size, the excess shared again among the others until none is above."""
    order = sorted(range(len(names)), key=lambda i: (names[i] is None, (names[i] or "").encode()))
    weight = [0] * len(names)
    for place, i in enumerate(order):
        weight[i] = weights[place % len(weights)]
    target = [0.0] * len(names)
    open_, left = list(order), sum(totals) * percent / 100
    while open_:
        whole = sum(weight[i] for i in open_)
        full = [i for i in open_ if left * weight[i] / whole > most * totals[i]]
        if not full:
            for i in open_:
                target[i] = left * weight[i] / whole
            break
        for i in full:
            target[i] = float(most * totals[i])
            left -= target[i]
        open_ = [i for i in open_ if i not in set(full)]
    return target


def shards_for(blocks: int, sources: int) -> int:
    """Output shards of a mix of so many blocks."""
    return max(LEAST_SHARDS, min(math.ceil(blocks / SHARD_BLOCKS), MOST_BORDERS // max(sources, 1)))


def _plan(documents: DataFrame, block_words: int, shards: int | None, seed: int) -> tuple[DataFrame, int, np.ndarray]:
    """One row per source (size, target, passes, blocks, first draw), the
    number of shards, and their borders.

    The draws of all sources are numbered through, so the borders are one
    ascending table: of each source the first draw of every shard, and the end.
    """
    spark = documents.sparkSession
    totals = documents.groupBy("_source").agg(F.sum("_size").alias("n")).limit(MOST_SOURCES + 1).collect()
    if len(totals) > MOST_SOURCES:
        raise ValueError(f"more than {MOST_SOURCES} sources")
    totals = sorted(totals, key=lambda r: (r[0] is None, (r[0] or "").encode()))
    names, n = [r[0] for r in totals], [int(r[1]) for r in totals]
    target = targets_of(names, n)
    rows, drawn = [], []
    for name, size, t in zip(names, n, target):
        words = min(round(t), MOST_REPEATS * size)
        passes = words // size if size else 0
        rest = words - passes * size
        blocks = math.ceil(size / block_words)
        drawn.append(passes * blocks + math.ceil(rest / block_words))
        rows.append((name, size, float(t), words, int(passes), int(rest), int(blocks)))
    shards = shards or shards_for(sum(drawn), len(drawn))
    first = np.cumsum([0, *drawn])[:-1].tolist()
    borders = [np.array(b, dtype=np.int64) + f for b, f in zip(shard_borders(spark, drawn, shards, seed), first)]
    plan = spark.createDataFrame(
        [(*r, f) for r, f in zip(rows, first)],
        "_plan_source string, source_size long, target double, _words long, _passes long, _rest long, _blocks long, _first long",
    )
    return plan, shards, np.concatenate([np.zeros(0, np.int64), *borders])


def split_node(counts: np.ndarray, left: int, right: int, node: int, seed: int) -> np.ndarray:
    """Blocks of each source that go to the left half of a node; their sum is
    exactly the left half's share.

    numpy draws totals below 10^9. Above, sources are drawn one after the other
    from the distribution's limits: binomial where few blocks are drawn or held,
    normal elsewhere, kept within what is possible, so quotas stay exact.
    """
    total = int(counts.sum())
    take = total * left // (left + right)
    random = np.random.default_rng([seed, node])
    if total < NUMPY_TOTAL:
        return random.multivariate_hypergeometric(counts, take, method="marginals")
    out = np.zeros(len(counts), dtype=np.int64)
    for i, held in enumerate(counts.tolist()):
        out[i] = x = _drawn(random, held, total, take)
        total, take = total - held, take - x
    return out


def _drawn(random: np.random.Generator, held: int, total: int, take: int) -> int:
    """How many of ``take`` blocks out of ``total`` are among ``held`` ones."""
    least, most = max(0, take - (total - held)), min(held, take)
    if least == most:
        return least
    if most <= FEW_BLOCKS:
        x = int(random.binomial(most, max(held, take) / total))
    else:
        share = held / total
        spread = math.sqrt(take * share * (1 - share) * ((total - take) / (total - 1)))
        # the mean in whole numbers: a double has 53 bits
        x = take * held // total + round(random.normal() * spread)
    return min(max(x, least), most)


def quotas_of(shard: int, counts: np.ndarray, shards: int, seed: int) -> np.ndarray:
    """Blocks of each source in one shard: the walk from the root to its leaf."""
    low, high, node = 0, shards, 1
    while high - low > 1:
        middle = (low + high) // 2
        left = split_node(counts, middle - low, high - middle, node, seed)
        if shard < middle:
            counts, high, node = left, middle, 2 * node
        else:
            counts, low, node = counts - left, middle, 2 * node + 1
    return counts


def shard_borders(spark, drawn: list[int], shards: int, seed: int) -> list[list[int]]:
    """For each source the first draw of every shard, and the end."""
    counts = np.array(drawn, dtype=np.int64)
    if not len(counts):
        return []

    def walk(batches):
        for batch in batches:
            for shard in batch.column(0).to_pylist():
                quota = quotas_of(shard, counts, shards, seed)
                yield pa.RecordBatch.from_pydict({"shard": pa.array([shard], pa.int64()), "quota": pa.array([quota.tolist()], pa.list_(pa.int64()))})

    leaves = spark.range(shards).mapInArrow(walk, "shard long, quota array<long>").collect()
    table = np.array([r.quota for r in sorted(leaves, key=lambda r: r.shard)], dtype=np.int64)
    ends = np.concatenate([np.zeros((1, len(counts)), np.int64), np.cumsum(table, axis=0)])
    return ends.T.tolist()


def _positions(documents: DataFrame) -> DataFrame:
    """Where each document starts in the stream of its source.

    The order is by hash; its leading bits are buckets whose sums are carried
    over from a small table.
    """
    marked = documents.withColumn("_bucket", F.shiftright("_hash", 52))
    group = F.struct("_source", "_bucket")
    before = Window.partitionBy("_g._source").orderBy("_g._bucket").rowsBetween(Window.unboundedPreceding, -1)
    carried = (
        marked.groupBy(group.alias("_g"))
        .agg(F.sum("_size").alias("_n"))
        .select("_g", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_before"))
    )
    inside = Window.partitionBy("_g").orderBy("_hash", "_row").rowsBetween(Window.unboundedPreceding, -1)
    return (
        marked.withColumn("_g", group)
        .join(carried, "_g")
        .withColumn("_start", F.col("_before") + F.coalesce(F.sum("_size").over(inside), F.lit(0)))
        .drop("_g", "_bucket", "_before")
    )


def permuted(block: np.ndarray, size: np.ndarray, seed: int) -> np.ndarray:
    """A keyed bijection of 0 .. size - 1, for each row with its own size;
    every block must be below its size.

    A Feistel network over the smallest even number of bits that holds the
    numbers; a value outside walks on along its cycle, at most a few steps on
    average, since the network's domain is below four times the size.
    """
    value = block.astype(np.uint64)
    size = size.astype(np.uint64)
    half = (np.array([max(1, (int(n) - 1).bit_length() + 1 >> 1) for n in size], dtype=np.uint64) if len(size) else size)
    mask = (np.uint64(1) << half) - np.uint64(1)
    todo = np.flatnonzero(size > 1)
    while len(todo):
        h, m, v = half[todo], mask[todo], value[todo]
        high, low = v >> h, v & m
        for turn in range(FEISTEL_ROUNDS):
            high, low = low, high ^ (_mixed(low, np.uint64(seed * FEISTEL_ROUNDS + turn)) & m)
        value[todo] = (high << h) | low
        todo = todo[value[todo] >= size[todo]]
    return value.astype(np.int64)


def _mixed(x: np.ndarray, key: np.uint64) -> np.ndarray:
    """A 64-bit hash: multiplications and shifts, modulo 2^64."""
    x = (x + key + np.uint64(1)) * np.uint64(0x9E3779B97F4A7C15)
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def _places(block: np.ndarray, blocks: np.ndarray, seed: int) -> np.ndarray:
    """Place of a block in the draw. The last, shorter block keeps the last place."""
    size = np.maximum(blocks - 1, 1)
    return np.where(block >= blocks - 1, block, permuted(np.minimum(block, size - 1), size, seed))


def _permuted(block: Column, blocks: Column, seed: int) -> Column:
    """``_places`` of columns."""

    @F.pandas_udf("long")
    def place(at: pd.Series, count: pd.Series) -> pd.Series:
        return pd.Series(_places(at.to_numpy(), count.to_numpy(), seed))

    return place(block, blocks)


def mix(
    docs: DataFrame,
    text: str = "text",
    key: str = "doc_id",
    source: str = "source",
    block_words: int = BLOCK_WORDS,
    shards: int | None = None,
    seed: int = SEED,
    row: str | None = None,
) -> tuple[DataFrame, DataFrame]:
    """``(documents, pieces)``; ``shards`` by default from the number of blocks.

    ``documents`` has a row per document: ``_row``, ``_key``, ``_source``,
    ``_size``, ``source_size``, ``target``. ``pieces`` are the parts of the
    mix: ``_row``, ``shard``, ``place`` (order within the shard, a hash),
    ``pass``, and the words ``word_from`` to ``word_to`` of the document. They
    are read from the dealt shards, which are written here.
    """
    described, pieces, shards = _dealt(docs, text, key, source, block_words, shards, seed, row)
    return described, stored(shuffled(pieces, shards), "shards")


def _dealt(docs, text, key, source, block_words=BLOCK_WORDS, shards=None, seed=SEED, row=None) -> tuple[DataFrame, DataFrame, int]:
    """``(documents, pieces, shards)``; the pieces know their shard and place."""
    documents = stored(sizes(docs, text, key, source, row), "sizes")
    plan, shards, borders = _plan(documents, block_words, shards, seed)
    plan = checked_broadcast(plan)
    shared = documents.sparkSession.sparkContext.broadcast(borders)

    # place and shards of a block in one function: a task needs one Python worker
    @F.pandas_udf("rank long, shards array<int>")
    def deal(block: pd.Series, count: pd.Series, passes: pd.Series, first: pd.Series) -> pd.DataFrame:
        count = count.to_numpy()
        rank = _places(block.to_numpy(), count, seed)
        turns = passes.to_numpy() + 1
        ends = np.cumsum(turns)
        row = np.repeat(np.arange(len(rank)), turns)
        draw = first.to_numpy()[row] + (np.arange(len(row)) - (ends - turns)[row]) * count[row] + rank[row]
        shard = ((np.searchsorted(shared.value, draw, side="right") - 1) % (shards + 1)).astype(np.int32)
        return pd.DataFrame({"rank": rank, "shards": np.split(shard, ends[:-1])[: len(rank)]})

    same = F.col("_source").eqNullSafe(F.col("_plan_source"))
    joined = _positions(documents.where("_size > 0")).join(plan, same)
    first = F.floor(F.col("_start") / F.lit(block_words)).cast("long")
    last = F.floor((F.col("_start") + F.col("_size") - 1) / F.lit(block_words)).cast("long")
    blocks = joined.withColumn("_block", F.explode(F.sequence(first, last)))
    block_start = F.col("_block") * F.lit(block_words)
    blocks = (
        blocks.withColumn("_deal", deal("_block", "_blocks", "_passes", "_first"))
        .withColumn("_rank", F.col("_deal.rank"))
        # words of the block that the cut pass takes
        .withColumn("_part", F.greatest(F.lit(0), F.least(F.lit(block_words), F.col("_rest") - F.col("_rank") * F.lit(block_words))))
        .select("*", F.posexplode("_deal.shards").alias("pass", "shard"))
        .withColumn("pass", F.col("pass").cast("long"))
        .withColumn("_take", F.when(F.col("pass") < F.col("_passes"), F.lit(block_words)).otherwise(F.col("_part")))
        .withColumn("word_from", F.greatest(F.lit(0), block_start - F.col("_start")))
        .withColumn("word_to", F.least(F.col("_size"), block_start + F.col("_take") - F.col("_start")))
        .where("word_to > word_from")
        .withColumn("_draw", F.col("pass") * F.col("_blocks") + F.col("_rank"))
        .withColumn("place", F.xxhash64(F.lit(seed), "shard", "_source", "_draw"))
        .withColumn("_at", F.col("_start") + F.col("word_from"))
    )
    pieces = blocks.select("_row", "_key", "_source", "_size", "shard", "place", "_draw", "_at", "pass", "word_from", "word_to")
    described = documents.join(plan, same).select("_row", "_key", "_source", "_size", "source_size", "target")
    return described, pieces, shards


def shuffled(pieces: DataFrame, shards: int) -> DataFrame:
    """Pieces dealt to their shards, each in its local random order; the words
    of a block stay in the order of their source."""
    return pieces.repartitionByRange(shards, "shard", "place").sortWithinPartitions("shard", "place", "_source", "_draw", "_at")


def taken(docs: DataFrame, text: str = "text", key: str = "doc_id", source: str = "source", **kw) -> DataFrame:
    """One row per document: ``key``, size, source_size, target, taken, and
    ``shards``, the words of it in each shard that has some, by shard."""
    described, pieces = mix(docs, text, key, source, **kw)
    dealt = pieces.groupBy("_row", "shard").agg(F.sum(F.col("word_to") - F.col("word_from")).alias("words"))
    words = dealt.groupBy("_row").agg(
        F.sum("words").alias("_taken"), F.sort_array(F.collect_list(F.struct("shard", "words"))).alias("shards")
    )
    return described.join(words, "_row", "left").select(
        F.col("_key").alias(key),
        F.col("_size").alias("size"),
        "source_size",
        "target",
        F.coalesce("_taken", F.lit(0)).cast("long").alias("taken"),
        F.coalesce("shards", F.expr("cast(array() as array<struct<shard:int,words:bigint>>)")).alias("shards"),
    )


#: a word with the white space after it, and before it at the beginning
_WORD = re.compile(rb"(?:\A[\x20\x09-\x0D]+)?[^\x20\x09-\x0D]+[\x20\x09-\x0D]*")


def spans_of(text: str, starts, ends) -> list[str]:
    """The words ``starts[i]`` to ``ends[i]`` of a text, with their white space."""
    data = text.encode()
    at = [m.start() for m in _WORD.finditer(data)]
    at.append(len(data))
    return [data[at[a] : at[b]].decode() for a, b in zip(starts, ends)]


def _spans(columns: Iterator[tuple[pd.Series, pd.Series, pd.Series]]) -> Iterator[pd.Series]:
    """Of texts, starts and ends."""
    try:
        for batch in columns:
            yield pd.Series([None if t is None else spans_of(t, a, b) for t, a, b in zip(*batch)], dtype=object)
    finally:
        release_memory()


def mixed_documents(docs: DataFrame, text: str = "text", key: str = "doc_id", source: str = "source", **kw) -> DataFrame:
    """The mix as rows with the columns of ``docs``, in the order of the shards.

    There is a row per dealt piece: the words of a document in one drawn block,
    as they are in the text. A document that lies within a block comes in full.
    """
    names = docs.columns
    whole = stored(docs.select(F.struct(*names).alias("__doc"), F.monotonically_increasing_id().alias("__id")), "mix-input")
    flat = whole.select("__id", *[F.col(f"__doc.`{c}`").alias(c) for c in dict.fromkeys((key, text, source))])
    _, dealt, shards = _dealt(flat, text, key, source, row="__id", **kw)
    pieces = stored(shuffled(dealt, shards), "shards")
    full = (F.col("word_from") == 0) & (F.col("word_to") == F.col("_size"))
    parts = pieces.groupBy("_row").agg(
        F.sort_array(F.collect_list(F.struct("shard", "place", "_source", "_draw", "_at", "word_from", "word_to", full.alias("full")))).alias("_parts"),
        F.bool_and(full).alias("_uncut"),
    )
    value = F.col(f"__doc.`{text}`")
    cut = whole.join(parts, F.col("__id") == F.col("_row")).withColumn(
        # texts that no piece cuts do not pass through Python
        "_texts", F.pandas_udf(_spans, "array<string>")(F.when(~F.col("_uncut"), value), F.col("_parts.word_from"), F.col("_parts.word_to"))
    )
    rows = cut.select("__doc", F.posexplode("_parts").alias("_i", "_part"), "_texts").select(
        F.col("__doc").alias("__whole"), F.when(~F.col("_part.full"), F.get("_texts", F.col("_i"))).alias("__cut"), "_part.*"
    )
    value = F.when(F.col("full"), F.col(f"__whole.`{text}`")).otherwise(F.col("__cut"))
    out = rows.select(
        *[(value if c == text else F.col(f"__whole.`{c}`")).alias(f"__{i}") for i, c in enumerate(names)],
        "shard", "place", "_source", "_draw", "_at",
    )
    return shuffled(out, shards).select(*[F.col(f"__{i}").alias(c) for i, c in enumerate(names)])

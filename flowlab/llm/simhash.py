"""Near-duplicates by SimHash, found by pigeonhole blocks.

A fingerprint is cut into ``BLOCKS`` blocks. Two fingerprints that differ in at
most ``distance`` bits agree in at least ``BLOCKS - distance`` blocks, so they
share one of the keys made of that many blocks. Rows meet on these keys and
every meeting is verified by its Hamming distance.

Equal fingerprints are one point from the start, whatever the number of
copies. A key that many points share is cut into cells of bounded size, one
task-sized cell for every pair of parts, and a cell returns a spanning forest
of its links instead of all of them: components stay exact and no row per pair
of a group is ever made.

Defined results: a null or empty text has the fingerprint zero, which links
like any other; a text shorter than a shingle is hashed whole; a null id takes
part and is ignored as smallest id unless its component has no other; repeated
rows give repeated rows; an empty table gives an empty result; other columns
are ignored, so their names cannot clash.
"""

from __future__ import annotations

from itertools import combinations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from flowlab.llm.common import byte_column, fresh, frugal, quoted, stored, words_of
from flowlab.operators.clustering import connected_components
from flowlab.operators.scale import checked_broadcast

SHINGLE = 4
SEED = 42
DISTANCE = 4
#: pieces of a fingerprint; 7 with 3 in common give 35 keys of 27 or 28 bits
BLOCKS = 7
#: points of a key that one cell compares with each other
CELL = 2_048
#: points that are compared at once inside a cell
STEP = 512


def fingerprint(text: bytes | None, shingle: int = SHINGLE) -> int:
    """Bit by bit the majority of the shingles' hashes, repeats included."""
    words = words_of(text.lower() if text else text)
    if not words:
        return 0
    if len(words) <= shingle:
        return xxhash.xxh64_intdigest(b" ".join(words), SEED)
    joined = b" ".join(words)
    starts = np.zeros(len(words), dtype=np.int64)
    np.cumsum(np.fromiter(map(len, words[:-1]), np.int64, len(words) - 1) + 1, out=starts[1:])
    ends = np.append(starts[1:] - 1, len(joined))
    digest = xxhash.xxh64_intdigest
    hashes = np.fromiter(
        (digest(joined[a:b], SEED) for a, b in zip(starts.tolist(), ends[shingle - 1 :].tolist())),
        dtype=np.uint64,
        count=len(words) - shingle + 1,
    )
    ones = np.zeros(64, dtype=np.int64)
    for at in range(0, len(hashes), 65_536):
        bits = np.unpackbits(hashes[at : at + 65_536].view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
        ones += bits.sum(axis=0, dtype=np.int64)
    majority = np.packbits(2 * ones > len(hashes), bitorder="little")
    return int.from_bytes(majority.tobytes(), "little")


def fingerprints(docs: DataFrame, text: str = "text", key: str = "doc_id", shingle: int = SHINGLE) -> DataFrame:
    """``key``, ``fp``, the fingerprint as the same 64 bits of a long, and
    ``_text``, a hash of the whole text as it stands."""
    from flowlab.llm.bpe import _arrow_type

    source = docs.select(key, text, F.xxhash64(text).alias("_text"))
    schema = pa.schema([(key, _arrow_type(source, key)), ("fp", pa.int64()), ("_text", pa.int64())])

    def run(batches):
        for batch in batches:
            values = np.array([fingerprint(t, shingle) for t in byte_column(batch.column(1))], dtype=np.uint64)
            yield pa.RecordBatch.from_arrays(
                [batch.column(0).cast(schema.field(0).type), pa.array(values.view(np.int64)), batch.column(2)], schema=schema
            )

    return source.mapInArrow(frugal(run), f"{quoted(key)} {source.schema[key].dataType.simpleString()}, fp long, _text long")


def block_masks(blocks: int = BLOCKS, distance: int = DISTANCE) -> list[int]:
    """One mask of bits for every choice of the blocks that must agree."""
    cuts = [64 * i // blocks for i in range(blocks + 1)]
    whole = [((1 << (b - a)) - 1) << a for a, b in zip(cuts, cuts[1:])]
    return [sum(chosen) for chosen in combinations(whole, blocks - distance)]


def _signed(x: int) -> int:
    return x - (1 << 64) if x >= 1 << 63 else x


def links(points: DataFrame, distance: int = DISTANCE, blocks: int = BLOCKS, cell: int = CELL) -> DataFrame:
    """Links ``(u, v)``, u > v, that connect exactly what all links connect.

    ``points`` has distinct ``fp``. A point goes to one row per key; keys with
    more than ``cell`` points are cut into parts, and each pair of parts is a
    cell of its own.
    """
    if blocks <= distance:
        raise ValueError("more blocks than differing bits are needed")
    masks = [_signed(m) for m in block_masks(blocks, distance)]
    keyed = points.select(
        "fp",
        F.posexplode(F.array(*[F.col("fp").bitwiseAND(F.lit(m)) for m in masks])).alias("table", "bits"),
    ).select("fp", F.xxhash64("table", "bits").alias("key"))
    crowded = (
        keyed.groupBy("key")
        .agg(F.count(F.lit(1)).alias("n"))
        .where(F.col("n") > cell)
        .select("key", F.ceil(F.col("n") / F.lit(cell)).cast("int").alias("parts"))
    )
    marked = keyed.join(checked_broadcast(crowded), "key", "left").withColumn("parts", F.coalesce("parts", F.lit(1)))
    part = F.pmod(F.xxhash64("fp"), F.col("parts")).cast("int")
    dealt = (
        marked.withColumn("part", part)
        .withColumn("other", F.explode(F.sequence(F.lit(0), F.col("parts") - 1)))
        .select(
            F.when(F.col("parts") == 1, F.col("key"))
            .otherwise(F.xxhash64("key", F.least("part", "other"), F.greatest("part", "other")))
            .alias("key"),
            "fp",
        )
    )
    found = (
        dealt.repartition("key")
        .sortWithinPartitions("key")
        .mapInArrow(frugal(lambda batches: _compare_runs(batches, distance)), "u long, v long")
    )
    return found.distinct()


def _compare_runs(batches, distance: int):
    """Links within each run of equal keys; the rest of a run waits for more."""
    rest_key = np.zeros(0, np.int64)
    rest_fp = np.zeros(0, np.int64)
    schema = pa.schema([("u", pa.int64()), ("v", pa.int64())])

    def answer(keys, fps):
        pairs = _links_of_runs(keys, fps, distance)
        if len(pairs):
            return pa.RecordBatch.from_arrays([pa.array(pairs.max(axis=1)), pa.array(pairs.min(axis=1))], schema=schema)
        return None

    for batch in batches:
        keys = np.concatenate([rest_key, batch.column(0).to_numpy(zero_copy_only=False)])
        fps = np.concatenate([rest_fp, batch.column(1).to_numpy(zero_copy_only=False)])
        if not len(keys):
            continue
        last = np.searchsorted(keys, keys[-1])
        if (out := answer(keys[:last], fps[:last])) is not None:
            yield out
        rest_key, rest_fp = keys[last:], fps[last:]
    if (out := answer(rest_key, rest_fp)) is not None:
        yield out


def _links_of_runs(keys: np.ndarray, fps: np.ndarray, distance: int) -> np.ndarray:
    """Pairs within ``distance`` bits: all of short runs, a forest of long ones."""
    if len(keys) < 2:
        return np.zeros((0, 2), np.int64)
    starts = np.flatnonzero(np.append(True, keys[1:] != keys[:-1]))
    sizes = np.diff(np.append(starts, len(keys)))
    found = []
    for shift in range(1, 8):  # neighbours at each distance in runs of up to 8
        left = np.flatnonzero(keys[shift:] == keys[:-shift])
        left = left[np.repeat(sizes, sizes)[left] <= 8]
        if not len(left):
            break
        # bitwise_count takes the absolute value of signed numbers
        near = np.bitwise_count((fps[left] ^ fps[left + shift]).view(np.uint64)) <= distance
        found.append(np.stack([fps[left[near]], fps[left[near] + shift]], axis=1))
    for i in np.flatnonzero(sizes > 8):
        found.append(forest(fps[starts[i] : starts[i] + sizes[i]], distance))
    pairs = np.concatenate(found) if found else np.zeros((0, 2), np.int64)
    return pairs[pairs[:, 0] != pairs[:, 1]]


def forest(fps: np.ndarray, distance: int) -> np.ndarray:
    """A spanning forest of the links among distinct points.

    Breadth first, with whole frontiers compared in blocks with the points not
    yet reached: memory is bounded by ``STEP`` times the run.
    """
    values = np.unique(fps).view(np.uint64)
    left = np.arange(1, len(values))
    frontier = np.array([0])
    edges = []
    while len(left):
        if not len(frontier):
            frontier, left = left[:1], left[1:]
            continue
        reached = []
        for at in range(0, len(frontier), STEP):
            if not len(left):
                break
            some = frontier[at : at + STEP]
            near = np.bitwise_count(values[left][:, None] ^ values[some][None, :]) <= distance
            hit = near.any(axis=1)
            if hit.any():
                new = left[hit]
                edges.append(np.stack([values[some[near[hit].argmax(axis=1)]], values[new]], axis=1))
                reached.append(new)
                left = left[~hit]
        frontier = np.concatenate(reached) if reached else np.zeros(0, np.int64)
    if not edges:
        return np.zeros((0, 2), np.int64)
    return np.concatenate(edges).view(np.int64)


def near_duplicates(
    docs: DataFrame, text: str = "text", key: str = "doc_id", distance: int = DISTANCE, blocks: int = BLOCKS, cell: int = CELL
) -> DataFrame:
    """``key``, ``fingerprint`` (16 hex digits) and ``component_id`` of each row.

    The component is the smallest ``key`` that a document reaches by links.
    """
    return _classes(docs, text, key, distance, blocks, cell).select(
        F.col("id").alias(key), F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id"
    )


def _classes(docs: DataFrame, text: str, key: str, distance: int = DISTANCE, blocks: int = BLOCKS, cell: int = CELL) -> DataFrame:
    """Each row's ``id`` with its component: ``root``, one of its fingerprints,
    and ``component_id``."""
    own = docs.select(F.col(quoted(key)).alias("id"), F.col(quoted(text)).alias("text"))
    printed = stored(fingerprints(own, "text", "id"), "fingerprints")
    points = stored(printed.groupBy("fp").agg(F.min("id").alias("_least")), "points")
    found = stored(links(points, distance, blocks, cell), "links")
    linked = found.select(F.col("u").alias("node")).union(found.select("v")).distinct()
    roots = stored(connected_components(linked, found), "roots")
    named = points.join(roots.select(F.col("node").alias("fp"), "root"), "fp", "left").select(
        "fp", "_least", F.coalesce("root", "fp").alias("root")
    )
    smallest = named.groupBy("root").agg(F.min("_least").alias("component_id"))
    classes = named.join(smallest, "root").select("fp", "root", "component_id")
    # a fingerprint may belong to a third of the rows: dealt over several tasks
    salts = 16
    spread = classes.withColumn("_salt", F.explode(F.sequence(F.lit(0), F.lit(salts - 1))))
    return (
        printed.withColumn("_salt", F.pmod(F.xxhash64("id"), F.lit(salts)).cast("int"))
        .join(spread, ["fp", "_salt"])
        .select("id", "fp", "_text", "root", "component_id")
    )


def one_of_each(docs: DataFrame, text: str = "text", key: str = "doc_id") -> DataFrame:
    """One row of every component, with all its columns.

    It is the row of the smallest id, null ids last; of rows that share it the
    one with the least hash of its text, whatever copies of it there are.
    """
    id_, text_, rows_ = (fresh(f"__kept_{n}", docs) for n in ("id", "text", "rows"))
    classes = stored(_classes(docs, text, key), "classes")
    kept = (
        classes.groupBy("root", "id", "_text")
        .agg(F.count(F.lit(1)).alias("n"))
        .groupBy("root")
        .agg(F.min(F.struct(F.col("id").isNull().alias("none"), "id", "_text", "n")).alias("k"))
        .select(F.col("k.id").alias(id_), F.col("k._text").alias(text_), F.col("k.n").alias(rows_))
    )
    columns = [F.col(quoted(c)) for c in docs.columns]
    same = F.col(quoted(key)).eqNullSafe(F.col(id_)) & (F.xxhash64(F.col(quoted(text))) == F.col(text_))
    chosen = docs.join(kept, same)
    single = chosen.where(F.col(rows_) == 1).select(*columns)
    several = (
        chosen.where(F.col(rows_) > 1)
        .groupBy(id_, text_)
        .agg(F.min_by(F.struct(*columns), _row_hash(docs)).alias("row"))
        .select("row.*")
    )
    return single.unionByName(several)


def _row_hash(docs: DataFrame) -> Column:
    """A hash of whole rows; columns that hold maps are hashed as JSON."""
    return F.xxhash64(*[
        F.to_json(F.struct(F.col(quoted(f.name)).alias("v"))) if "map<" in f.dataType.simpleString() else F.col(quoted(f.name))
        for f in docs.schema.fields
    ])

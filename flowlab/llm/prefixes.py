"""Trie of conversation prefixes by ROLLUP over positional turn columns.

Every turn gets an id: 16 bytes of the SHA-256 of its role and text, and the
length of the text. ``BLOCK`` turns of a conversation are a row of positional
columns ``t1, t2, ...`` with the key of the node that the turns before it end
in; one ROLLUP over the columns, beside block and key, aggregates all prefixes
of all blocks together, and ``grouping_id`` tells their depths. The key of a
node is the exclusive or of a 128-bit hash of every turn with its depth, so the
keys of all blocks come from one running aggregate and no block waits for the
one before it.

Sums over subtrees need no ancestors either. A node belongs to its smallest
member; what the nodes of a conversation weigh is summed per conversation and a
second ROLLUP sums that over the members of every node. Of the nodes outside
the subtree only the ones above it on its own smallest member's path are in
that sum, and they are taken off by a running sum.

Running aggregates go through sums of chunks, so a long conversation is not
ordered in one task. Parents with more than one of ``HOT_SHARES`` parts of the
nodes are joined by broadcast, which are at most ``HOT_SHARES`` rows. The
members that end in a node are packed into strings in the tasks of a range
sort; only those strings meet for the digest, which has to be computed in order.

Defined results: null roles and texts are empty; a null turn comes first; turns
with equal numbers are ordered by their ids; rows without a conversation id
belong to no conversation; conversation ids are whole numbers; an empty table
has no nodes, not even a root. Other columns are ignored, so their names cannot
clash. Names with blanks work.
"""

from __future__ import annotations

import hashlib
from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from flowlab.llm.common import batches_of, stored
from flowlab.operators.scale import number_rows

#: turns in a row of positional columns
BLOCK = 8
#: turn numbers, blocks or depths of a conversation that are ordered in one task
CHUNK = 2_048
#: parents with more than 1/HOT_SHARES of all nodes are joined by broadcast
HOT_SHARES = 256
#: members in one packed string
PACKED = 50_000

_TURNS = [f"t{i}" for i in range(1, BLOCK + 1)]
_NODE = ["k1", "k2", "depth"]


def turns_of(
    rows: DataFrame, conv: str = "conv_id", turn: str = "turn", role: str = "role", text: str = "text"
) -> DataFrame:
    """``conv_id``, ``pos`` (from 1), ``turn_id`` of the turns in their order."""
    who, said = (F.coalesce(F.col(f"`{c}`").cast("string"), F.lit("")) for c in (role, text))
    whole = F.concat(F.octet_length(who).cast("string"), F.lit(":"), who, said)
    digest = F.substring(F.sha2(whole.cast("binary"), 256), 1, 32)
    length = F.lpad(F.hex(F.octet_length(said).cast("long")), 16, "0")
    named = rows.select(
        F.col(f"`{conv}`").cast("long").alias("conv_id"),
        F.col(f"`{turn}`").alias("turn"),
        F.unhex(F.concat(digest, length)).alias("turn_id"),
    ).where(F.col("conv_id").isNotNull())
    chunk = F.floor(F.col("turn") / CHUNK)
    numbered = number_rows(named, F.struct("turn", "turn_id"), within=["conv_id"], bucket=chunk, out="pos")
    return numbered.select("conv_id", "pos", "turn_id")


def shared_heads(turns: DataFrame, group: int = 5, longest: int = 8) -> tuple[DataFrame, DataFrame]:
    """Conversations that begin with the turns of another one.

    Conversation c gets the first h turns of conversation ``c - c % group`` (all
    if it has fewer, none if there is none) and then its own turns after its
    first h, with h the CRC-32 of its decimal id modulo ``longest + 1``.
    Returns the turns (conv_id, pos, turn_id) and the conversations (conv_id,
    n_turns), those without turns included.
    """
    base = F.col("conv_id") - F.col("conv_id") % group
    head = F.crc32(F.col("conv_id").cast("string").cast("binary")) % (longest + 1)
    lengths = turns.groupBy("conv_id").agg(F.max("pos").alias("n"))
    given = F.max(F.when(F.col("conv_id") == F.col("base"), F.col("n"))).over(Window.partitionBy("base"))
    convs = lengths.select("conv_id", "n", base.alias("base"), head.alias("head")).withColumn(
        "shared", F.least("head", F.coalesce(given, F.lit(0)))
    )
    own = (
        turns.join(convs, "conv_id")
        .where(F.col("pos") > F.col("head"))
        .select("conv_id", (F.col("shared") + F.col("pos") - F.col("head")).alias("pos"), "turn_id")
    )
    first = turns.where((F.col("pos") <= longest) & (F.col("conv_id") == base)).withColumnRenamed("conv_id", "base")
    heads = first.join(convs, "base").where(F.col("pos") <= F.col("head")).select("conv_id", "pos", "turn_id")
    n_turns = F.col("shared") + F.greatest(F.col("n") - F.col("head"), F.lit(0))
    return own.unionByName(heads), convs.select("conv_id", n_turns.alias("n_turns"))


# ---------------------------------------------------------------------------
# blocks and rollups
# ---------------------------------------------------------------------------


def _lane(number: int, depth: Column, turn_id: Column) -> Column:
    return F.xxhash64(F.lit(number), depth, turn_id)


def _xor(*columns: Column) -> Column:
    total = F.coalesce(columns[0], F.lit(0).cast("long"))
    for c in columns[1:]:
        total = total.bitwiseXOR(F.coalesce(c, F.lit(0).cast("long")))
    return total


def _running(
    df: DataFrame, order: str, chunk: str, values: dict[str, str], total: Callable, both: Callable
) -> DataFrame:
    """Add for each value the ``total`` of the earlier rows of the conversation,
    under the given name; ``both`` joins two totals of which any may be null."""
    upto = F.col(order)
    before = Window.partitionBy("conv_id").orderBy(chunk).rowsBetween(Window.unboundedPreceding, -1)
    inside = Window.partitionBy("conv_id", chunk).orderBy(upto).rowsBetween(Window.unboundedPreceding, -1)
    sums = df.groupBy("conv_id", chunk).agg(*[total(v).alias(f"_{v}") for v in values])
    offsets = sums.select("conv_id", chunk, *[total(f"_{v}").over(before).alias(f"_{v}") for v in values])
    return (
        df.join(offsets, ["conv_id", chunk])
        .withColumns({out: both(total(v).over(inside), F.col(f"_{v}")) for v, out in values.items()})
        .drop(*[f"_{v}" for v in values])
    )


def blocks_of(turns: DataFrame, convs: DataFrame) -> DataFrame:
    """A row for every ``BLOCK`` turns of a conversation, and one for none.

    ``t1, ...``: turn ids by position; ``p1, p2``: key of the node before the
    block; ``x1, x2``: what the block adds to it; ``ends``: last of its
    conversation.
    """
    block = F.expr(f"(pos - 1) div {BLOCK}")
    slots = turns.select(
        "conv_id", block.alias("block"), F.col("pos"), "turn_id", F.lit(False).alias("ends")
    ).unionByName(
        convs.select(
            "conv_id",
            F.expr(f"greatest(n_turns - 1, 0) div {BLOCK}").alias("block"),
            F.lit(None).cast("long").alias("pos"),
            F.lit(None).cast("binary").alias("turn_id"),
            F.lit(True).alias("ends"),
        )
    )
    at = F.col("pos") - BLOCK * F.col("block")
    rows = (
        slots.withColumn("chunk", F.expr(f"block div {CHUNK}"))
        .repartition("conv_id", "chunk")
        .groupBy("conv_id", "chunk", "block")
        .agg(
            *[F.max(F.when(at == i, F.col("turn_id"))).alias(t) for i, t in enumerate(_TURNS, 1)],
            *[
                F.coalesce(F.bit_xor(F.when(F.col("pos").isNotNull(), _lane(n, F.col("pos"), F.col("turn_id")))), F.lit(0)).alias(f"x{n}")
                for n in (1, 2)
            ],
            F.max("ends").alias("ends"),
        )
    )
    return _running(rows, "block", "chunk", {"x1": "p1", "x2": "p2"}, F.bit_xor, _xor).drop("chunk")


def rolled_up(blocks: DataFrame, aggregates: str) -> DataFrame:
    """All prefixes of all blocks: ``k1, k2, depth``, the key of the parent
    (``q1, q2``), ``last`` (id of the last turn), and the aggregates."""
    grouped = blocks.sparkSession.sql(
        f"""
        select block, p1, p2, {", ".join(_TURNS)}, {BLOCK} - bit_count(grouping_id()) as d, {aggregates}
        from {{blocks}}
        group by block, p1, p2, rollup({", ".join(_TURNS)})
        """,
        blocks=blocks,
    )
    last = F.expr(f"element_at(array({', '.join(_TURNS)}), cast(d as int))")
    # the row of no turns is the node before the block, which only the root lacks
    real = grouped.withColumn("last", F.when(F.col("d") > 0, last)).where(
        F.col("last").isNotNull() | ((F.col("d") == 0) & (F.col("block") == 0))
    )
    depth = F.col("block") * BLOCK + F.col("d")

    def key(n: int) -> Column:
        lanes = [F.when(F.col(t).isNotNull(), _lane(n, F.col("block") * BLOCK + i, F.col(t))) for i, t in enumerate(_TURNS, 1)]
        return _xor(F.col(f"p{n}"), *lanes)

    keyed = real.withColumns({"depth": depth, "k1": key(1), "k2": key(2)})
    above = {f"q{n}": F.when(F.col("d") > 0, _xor(F.col(f"k{n}"), _lane(n, F.col("depth"), F.col("last")))) for n in (1, 2)}
    return keyed.withColumns(above).drop("block", "p1", "p2", "d", *_TURNS)


# ---------------------------------------------------------------------------
# the trie
# ---------------------------------------------------------------------------


def prefix_trie(turns: DataFrame, convs: DataFrame) -> DataFrame:
    """A row per node of the trie of ``turns`` (conv_id, pos, turn_id).

    ``convs`` lists every conversation (conv_id, n_turns), also those without
    turns. Columns: conv_id (smallest member), depth, parent_conv_id, n_convs,
    n_children, n_leaves, saved_tokens, ends_sha256; ``k1, k2`` with the depth
    are the key of a node.
    """
    blocks = stored(blocks_of(turns, convs), "prefix-blocks")
    length = F.conv(F.hex(F.substring("last", 17, 8)), 16, 10).cast("long")
    found = rolled_up(blocks, "min(conv_id) as conv_id, count(*) as n_convs").select(
        *_NODE, "q1", "q2", "conv_id", "n_convs",
        F.coalesce((F.col("n_convs") - 1) * length, F.lit(0)).alias("weight"),
    )
    found = stored(found, "prefix-nodes")
    children = (
        found.where(F.col("depth") > 0)
        .groupBy(F.col("q1").alias("k1"), F.col("q2").alias("k2"), (F.col("depth") - 1).alias("depth"))
        .agg(F.count(F.lit(1)).alias("n_children"))
    )
    nodes = stored(found.join(children, _NODE, "left").fillna(0, ["n_children"]), "prefix-counted")
    return (
        _with_parents(nodes)
        .join(_subtrees(blocks, nodes), _NODE, "left")
        .join(_ends(blocks), _NODE, "left")
        .select(
            "conv_id",
            "depth",
            "parent_conv_id",
            "n_convs",
            "n_children",
            "n_leaves",
            (F.col("below") - F.col("above")).alias("saved_tokens"),
            F.coalesce("ends_sha256", F.lit(hashlib.sha256().hexdigest())).alias("ends_sha256"),
            "k1",
            "k2",
        )
    )


def _subtrees(blocks: DataFrame, nodes: DataFrame) -> DataFrame:
    """Per node, over its members: ``n_leaves`` and ``below``, the leaves and
    the weight of the nodes that belong to them."""
    own = nodes.groupBy("conv_id").agg(
        F.sum("weight").alias("own_weight"), F.count_if(F.col("n_children") == 0).alias("own_leaves")
    )
    sums = rolled_up(blocks.join(own, "conv_id"), "sum(own_leaves) as n_leaves, sum(own_weight) as below")
    return sums.select(*_NODE, "n_leaves", "below")


def _with_parents(nodes: DataFrame) -> DataFrame:
    """Add ``above`` (weight of the nodes above that belong to the same
    conversation) and ``parent_conv_id``."""
    nodes = nodes.withColumns({"chunk": F.expr(f"depth div {CHUNK}"), "one": F.lit(1)})
    placed = _running(
        nodes, "depth", "chunk", {"weight": "above", "one": "_earlier"}, F.sum,
        lambda a, b: F.coalesce(a, F.lit(0)) + F.coalesce(b, F.lit(0)),
    )
    # the nodes of a conversation are the lower end of its path: below the first
    # of them the parent belongs to the same conversation
    total = nodes.count()
    crowded = nodes.where(F.col("n_children") * HOT_SHARES > total).select(*_NODE, "conv_id").collect()
    hot = nodes.sparkSession.createDataFrame(
        [tuple(r) for r in crowded], "q1 long, q2 long, _q long, _hot long"
    )
    row = F.monotonically_increasing_id()
    asked = placed.withColumn("_q", F.col("depth") - 1).join(F.broadcast(hot), ["q1", "q2", "_q"], "left")
    answered = (F.col("_earlier") > 0) | F.col("_hot").isNotNull() | (F.col("depth") == 0)
    asked = asked.withColumn("_q", F.when(answered, -1 - row).otherwise(F.col("_q")))
    parents = nodes.select(
        F.col("k1").alias("q1"), F.col("k2").alias("q2"), F.col("depth").alias("_q"), F.col("conv_id").alias("_parent")
    )
    parent = F.when(F.col("_earlier") > 0, F.col("conv_id")).otherwise(F.coalesce("_hot", "_parent"))
    return (
        asked.join(parents, ["q1", "q2", "_q"], "left")
        .withColumn("parent_conv_id", F.when(F.col("depth") > 0, parent))
        .drop("q1", "q2", "_q", "_hot", "_parent", "_earlier", "one", "chunk", "weight")
    )


def _ends(blocks: DataFrame) -> DataFrame:
    """Per node in which conversations end: SHA-256 of their decimal ids."""
    full = sum((F.col(t).isNotNull().cast("long") for t in _TURNS), F.lit(0).cast("long"))
    ends = blocks.where("ends").select(
        _xor(F.col("p1"), F.col("x1")).alias("k1"),
        _xor(F.col("p2"), F.col("x2")).alias("k2"),
        (F.col("block") * BLOCK + full).alias("depth"),
        "conv_id",
    )
    order = [*_NODE, "conv_id"]
    packed = ends.repartitionByRange(*order).sortWithinPartitions(*order).mapInArrow(
        _pack, "k1 long, k2 long, depth long, first long, ids string"
    )
    return (
        packed.repartition(*_NODE)
        .sortWithinPartitions(*_NODE, "first")
        .mapInArrow(_hash, "k1 long, k2 long, depth long, ends_sha256 string")
    )


_KEY_FIELDS = [("k1", pa.int64()), ("k2", pa.int64()), ("depth", pa.int64())]


def _rows(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple]:
    for batch in batches:
        yield from zip(*[c.to_pylist() for c in batch.columns])


def _pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Ordered members of a node as comma-joined strings of bounded length."""

    def packs():
        key, ids = None, []
        for k1, k2, depth, member in _rows(batches):
            if (k1, k2, depth) != key or len(ids) == PACKED:
                if ids:
                    yield (*key, ids[0], ",".join(map(str, ids)))
                key, ids = (k1, k2, depth), []
            ids.append(member)
        if ids:
            yield (*key, ids[0], ",".join(map(str, ids)))

    schema = pa.schema([*_KEY_FIELDS, ("first", pa.int64()), ("ids", pa.string())])
    yield from batches_of(packs(), schema, 2_000)


def _hash(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """One digest per node over its strings, which come in order."""

    def digests():
        key, state = None, None
        for k1, k2, depth, _, ids in _rows(batches):
            if (k1, k2, depth) != key:
                if state:
                    yield (*key, state.hexdigest())
                key, state = (k1, k2, depth), hashlib.sha256()
            else:
                state.update(b",")
            state.update(ids.encode())
        if state:
            yield (*key, state.hexdigest())

    yield from batches_of(digests(), pa.schema([*_KEY_FIELDS, ("ends_sha256", pa.string())]))


# ---------------------------------------------------------------------------
# the registered query
# ---------------------------------------------------------------------------


def trie_of_shared_heads(rows: DataFrame) -> DataFrame:
    """The trie of a table of conversations after :func:`shared_heads`."""
    turns = stored(turns_of(rows), "turns")
    return prefix_trie(*shared_heads(turns)).drop("k1", "k2")


#: the same rows in DuckDB, by ancestors of every node
SQL = """
with t as (
  select conv_id as c, row_number() over (partition by conv_id order by turn nulls first, role, text) as pos,
    md5(coalesce(role, '')) || md5(coalesce(text, '')) as id, strlen(coalesce(text, '')) as bytes
  from conversations where conv_id is not null
),
convs as (
  select c, count(*) as n, c - c % 5 as base,
    xor(list_reduce(
      list_concat([4294967295::bigint], list_transform(string_split(c::varchar, ''), lambda x: ascii(x)::bigint)),
      lambda crc, byte: list_reduce(
        list_concat([xor(crc, byte)], range(8)),
        lambda r, i: case when r & 1 = 1 then xor(r >> 1, 3988292384::bigint) else r >> 1 end)
    ), 4294967295::bigint) % 9 as h
  from t group by c
),
heads as (
  select a.c, a.n, a.base, a.h, least(a.h, coalesce(b.n, 0)) as shared
  from convs a left join convs b on b.c = a.base
),
turns as (
  select h.c, h.shared + t.pos - h.h as d, t.id, t.bytes from heads h join t on t.c = h.c and t.pos > h.h
  union all
  select h.c, t.pos, t.id, t.bytes from heads h join t on t.c = h.base and t.pos <= h.h
),
paths as (
  select c, d, bytes, md5(string_agg(id, '') over (partition by c order by d)) as k from turns
  union all
  select c, 0, 0, '' from convs
),
lengths as (select c, max(d) as n from paths group by c),
nodes as (
  select p.k, p.d, min(p.c) as c, count(*) as n_convs, (count(*) - 1) * any_value(p.bytes) as weight,
    string_agg(case when l.n = p.d then p.c::varchar end, ',' order by p.c) as ends
  from paths p join lengths l using (c) group by p.k, p.d
),
linked as (
  select n.*, q.k as parent, m.c as parent_c
  from nodes n left join paths q on q.c = n.c and q.d = n.d - 1 left join nodes m on m.k = q.k and m.d = q.d
),
children as (select parent as k, d - 1 as d, count(*) as n_children from linked where parent is not null group by all),
counted as (select l.*, coalesce(x.n_children, 0) as n_children from linked l left join children x on x.k = l.k and x.d = l.d),
below as (
  select p.k, p.d, sum(u.weight) as saved, count(*) filter (where u.n_children = 0) as n_leaves
  from counted u join paths p on p.c = u.c and p.d <= u.d group by p.k, p.d
)
select n.c::bigint as conv_id, n.d::bigint as depth, n.parent_c::bigint as parent_conv_id, n.n_convs::bigint as n_convs,
  n.n_children::bigint as n_children, b.n_leaves::bigint as n_leaves, b.saved::bigint as saved_tokens,
  sha256(coalesce(n.ends, '')) as ends_sha256
from counted n join below b on b.k = n.k and b.d = n.d
"""

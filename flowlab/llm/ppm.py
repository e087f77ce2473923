"""Language-model scores by prediction by partial matching over bytes.

A text is a sequence of tokens: lower-cased words and one end. A token is coded
byte by byte, a word closed by a terminator; the end is the terminator alone.

*Contexts.* The longest context of a byte is everything since the token began:
a node of a trie over all training tokens. A symbol that the node has seen
costs its share of the count; otherwise an escape is coded and the symbol comes
from the contexts of the last four bytes, three, two, one, none, and the uniform
distribution, each with its own escape, and with the symbols excluded that the
longer context would have coded. Escape estimates follow Good-Turing: the share
of a node's tokens that went to symbols seen once. A token may also escape as a
whole at the root and be spelled by the short contexts; both ways are added up.

*Pretrained and adaptive.* The code length of a document is that of a mixture
of two models: the trained trie, and the trie blended with what the document
itself has shown so far (its words and pairs of words). The mixture is over
whole documents, so adapting costs an ordinary text next to nothing.

*Distribution.* One pass over the texts turns them into blocks: a dictionary of
distinct words with their training counts, and the documents as positions in
it. Words of all blocks meet once, dealt by their first bytes, so that every
subtree of the trie lies in one task; the nodes above are a table of bounded,
checked size. The short contexts spell new words, so they count every distinct
training word of the corpus once. All of them count, however rare: the
probability of each context and symbol that words need is computed by joins, one
order after the other. The commonest of these spellings are broadcast, a bounded
table; the others come to the tasks with the words that need them. Scores return
to the blocks. What is gathered grows with the corpus, and nothing that does is
broadcast or sent to the driver.

Defined results: a null or empty text is the end alone; a null id counts as the
empty text in the choice of training rows; repeated rows are scored alike;
without training rows every token has probability by the uniform contexts; an
empty table gives an empty result. Only ``key`` and ``text`` are read, so other
columns cannot clash.
"""

from __future__ import annotations

import math
import zlib

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from flowlab.llm.common import byte_column, split_remainder, stored, words_of

#: bytes of text whose words share a dictionary
BLOCK_BYTES = 24_000_000
#: share of all dictionary rows that one subtree should hold at most
SUBTREE_SHARE = 1 / 64
#: rows of the table of nodes above the subtrees
MOST_PREFIXES = 1_000_000
#: bytes of the longest short context
ORDER = 4
#: spellings (context and symbol) that are broadcast; the others are joined
COMMON_SPELLINGS = 500_000
END = 256  # the terminator
SYMBOLS = 257
#: prior weight of the adaptive model
ADAPTIVE = 0.1
#: escape of a context that has only ever continued in one way
SURE = 0.3
#: new words are foreseen at the root, so nodes escape less than estimated
DAMPED = 0.1
_BOUNDARY = 32

_BLOCK_SCHEMA = pa.schema(
    [
        ("block", pa.int64()),
        ("place", pa.int32()),
        ("word", pa.binary()),
        ("n", pa.int64()),
        ("key", pa.string()),
        ("held_out", pa.bool_()),
        ("tokens", pa.binary()),
    ]
)


# --- texts to blocks


def _blocks(batches):
    """Rows of dictionaries (``word`` set) and of documents (``tokens`` set)."""
    part, number = TaskContext.get().partitionId(), 0
    index: dict[bytes, int] = {}
    docs, size = [], 0
    for batch in batches:
        keys, held = batch.column(0).to_pylist(), batch.column(2).to_pylist()
        for key, text, out in zip(keys, byte_column(batch.column(1)), held):
            words = words_of(text.lower() if text else text)
            words.append(b"")
            # a new word gets the next number
            places = np.fromiter((index.setdefault(w, len(index)) for w in words), np.uint32, len(words))
            docs.append((key, out, places))
            size += len(text or b"") + 16
            if size >= BLOCK_BYTES:
                yield from _block_rows(part << 24 | number, index, docs)
                index, docs, size, number = {}, [], 0, number + 1
    if docs:
        yield from _block_rows(part << 24 | number, index, docs)


def _block_rows(block: int, index: dict, docs: list):
    counts = np.zeros(len(index), np.int64)
    for _, out, places in docs:
        if not out:
            counts += np.bincount(places, minlength=len(index))
    none = lambda n, t: pa.nulls(n, t)
    words = list(index)
    for at in range(0, len(words), 50_000):
        part = words[at : at + 50_000]
        n = len(part)
        yield pa.RecordBatch.from_arrays(
            [
                pa.array(np.full(n, block)),
                pa.array(np.arange(at, at + n, dtype=np.int32)),
                pa.array(part, pa.binary()),
                pa.array(counts[at : at + n]),
                none(n, pa.string()),
                none(n, pa.bool_()),
                none(n, pa.binary()),
            ],
            schema=_BLOCK_SCHEMA,
        )
    for at in range(0, len(docs), 500):
        part = docs[at : at + 500]
        n = len(part)
        yield pa.RecordBatch.from_arrays(
            [
                pa.array(np.full(n, block)),
                none(n, pa.int32()),
                none(n, pa.binary()),
                none(n, pa.int64()),
                pa.array([d[0] for d in part], pa.string()),
                pa.array([d[1] for d in part], pa.bool_()),
                pa.array([zlib.compress(d[2].tobytes(), 1) for d in part], pa.binary()),
            ],
            schema=_BLOCK_SCHEMA,
        )


# --- short contexts


class Short:
    """Probabilities after the last bytes, with escapes and exclusion.

    One table per order, from no byte to ``ORDER`` bytes; the longest context
    that is in a table decides, and what it has not seen escapes to the next.
    """

    def __init__(self, rows: list[tuple[int, int, int, float]]):
        """``rows``: (order, context as a number, symbol, count), no repeats."""
        order, context, symbol, count = (np.array(c) for c in zip(*rows)) if rows else (np.zeros(0, np.int64),) * 4
        self.codes, self.tables = [], []
        shorter = np.full((1, SYMBOLS), 1 / SYMBOLS)
        for k in range(ORDER + 1):
            own = order == k
            codes = np.unique(context[own])
            counts = np.zeros((len(codes), SYMBOLS))
            counts[np.searchsorted(codes, context[own]), symbol[own]] = count[own]
            if k == 0 and not len(codes):
                codes, counts = np.zeros(1, np.int64), np.zeros((1, SYMBOLS))
            # a context is kept with all its endings
            suffix = np.searchsorted(self.codes[-1], codes & (1 << 8 * (k - 1)) - 1) if k else np.zeros(len(codes), np.int64)
            self.codes.append(codes)
            shorter = _level(counts, shorter[suffix])
            self.tables.append(np.log10(shorter).astype(np.float32))

    def log10(self, context: np.ndarray, symbol: np.ndarray) -> np.ndarray:
        out = self.tables[0][0, symbol].astype(float)
        for k in range(1, ORDER + 1):
            codes = self.codes[k]
            if not len(codes):
                break
            wanted = context & (1 << 8 * k) - 1
            at = np.minimum(np.searchsorted(codes, wanted), len(codes) - 1)
            out = np.where(codes[at] == wanted, self.tables[k][at, symbol], out)
        return out


def spellings(counted: DataFrame) -> DataFrame:
    """``code`` (context and symbol), log10 probability ``low`` and ``uses``.

    ``counted`` has every pair of ``context`` and ``symbol`` of all words: ``n``
    training words have it, ``uses`` words in all. Of the orders up to one byte
    there are at most 257 * 257 pairs; the driver computes them.
    """
    by_order = {ORDER: counted}
    for k in range(ORDER - 1, 0, -1):  # each order from the next longer one
        context = F.col("context").bitwiseAND(F.lit((1 << 8 * k) - 1)).alias("context")
        by_order[k] = stored(by_order[k + 1].groupBy(context, "symbol").agg(F.sum("n").alias("n")), f"order{k}")
    one = [tuple(r) for r in by_order[1].select("context", "symbol", "n").collect()]
    none: dict[int, int] = {}
    for _, symbol, n in one:
        none[symbol] = none.get(symbol, 0) + n
    short = Short([(0, 0, s, n) for s, n in none.items() if n] + [(1, c, s, n) for c, s, n in one if n])
    context, symbol = (np.array([r[i] for r in one], dtype=np.int64) for i in (0, 1))
    low = short.log10(context, symbol)
    shorter = counted.sparkSession.createDataFrame(
        list(zip(context.tolist(), symbol.tolist(), (10.0**low).tolist())), "shorter long, symbol int, q double"
    )
    for k in range(2, ORDER + 1):
        whole = Window.partitionBy("context")
        seen = F.col("n") > 0
        known = by_order[k].withColumn("shorter", F.col("context").bitwiseAND(F.lit((1 << 8 * (k - 1)) - 1))).join(shorter, ["shorter", "symbol"])
        sums = known.withColumns({
            "_n": F.sum("n").over(whole),
            "_d": F.sum(seen.cast("int")).over(whole),
            "_taken": F.sum(F.when(seen, F.col("q")).otherwise(0.0)).over(whole),
        })
        # as in _level: seen symbols share n of n + d, an escape leads to the others
        escaped = (F.col("_d") < SYMBOLS) & (F.col("_taken") < 1)
        mass = F.col("_n") + F.when(escaped, F.col("_d")).otherwise(0)
        p = (
            F.when(F.col("_n") == 0, F.col("q"))
            .when(seen, F.col("n") / mass)
            .when(escaped, F.col("q") * F.col("_d") / (mass * (1 - F.col("_taken"))))
            .otherwise(0.0)
        )
        uses = ["uses"] if k == ORDER else []
        shorter = sums.select(F.col("context").alias("shorter"), "symbol", p.alias("q"), *uses)
    code = F.shiftleft("shorter", 9).bitwiseOR(F.col("symbol").cast("long"))
    return shorter.select(code.alias("code"), F.log10(F.greatest("q", F.lit(1e-300))).alias("low"), "uses")


class Spelling:
    """Log10 probabilities of symbols after short contexts, by table."""

    def __init__(self, code: np.ndarray, low: np.ndarray, more: Spelling | None = None):
        self.code, at = np.unique(code, return_index=True)
        self.low, self.more = low[at], more

    def known(self, code: np.ndarray) -> np.ndarray:
        at = np.minimum(np.searchsorted(self.code, code), len(self.code) - 1)
        return self.code[at] == code if len(self.code) else np.zeros(len(code), bool)

    def log10(self, context: np.ndarray, symbol: np.ndarray) -> np.ndarray:
        code = context << 9 | symbol
        own = self.known(code)
        if not own.all() and self.more is None:
            raise ValueError("a spelling is missing")
        out = np.empty(len(code))
        out[own] = self.low[np.searchsorted(self.code, code[own])]
        if not own.all():
            out[~own] = self.more.log10(context[~own], symbol[~own])
        return out


def common_spellings(spelt: DataFrame) -> Spelling:
    """The most used ones, at most ``COMMON_SPELLINGS``."""
    bits = F.floor(F.log2("uses")).cast("int")
    sizes = {r[0]: r[1] for r in spelt.groupBy(bits.alias("b")).agg(F.count(F.lit(1))).collect()}
    total, least = 0, 64
    for b in sorted(sizes, reverse=True):
        total += sizes[b]
        if total > COMMON_SPELLINGS:
            break
        least = b
    found = spelt.where(bits >= least).select("code", "low").toArrow()
    return Spelling(found.column("code").to_numpy(), found.column("low").to_numpy())


def _rare(batches, common: Spelling, depth: int, inner: bool):
    """``head`` and ``code`` of spellings that are not common: within the first
    ``depth`` bytes of words, or (``inner``) from there on."""
    for batch in batches:
        words = batch.column(0).to_pylist()
        data, offset, length = _spelled(words)
        row, codes = [], []
        for at, active, o, symbol in _symbols(data, offset, length, depth if inner else 0, None if inner else depth):
            code = _context(data, o, at) << 9 | symbol
            left = ~common.known(code)
            row.append(active[left])
            codes.append(code[left])
        row, code = (np.concatenate(x) if x else np.zeros(0, np.int64) for x in (row, codes))
        heads = pa.array([w[:depth] for w in words], pa.binary()).dictionary_encode()
        group = heads.indices.to_numpy(zero_copy_only=False)[row]
        width = 8 * ORDER + 9  # bits of a code
        pairs = np.unique(group.astype(np.int64) << width | code)
        yield pa.RecordBatch.from_arrays(
            [heads.dictionary.take(pa.array(pairs >> width)), pa.array(pairs & (1 << width) - 1)], names=["head", "code"]
        )


def _level(counts: np.ndarray, shorter: np.ndarray) -> np.ndarray:
    """One order: seen symbols share n of n + d, an escape leads to the others."""
    seen = counts > 0
    n, d = counts.sum(axis=1, keepdims=True), seen.sum(axis=1, keepdims=True)
    others = np.where(seen, 0, shorter)
    left = others.sum(axis=1, keepdims=True)
    scale = np.divide(d, (n + d) * left, out=np.zeros_like(left), where=(left > 0) & (n > 0))
    mass = np.where(left > 0, n + d, n)  # nothing to escape to: no escape
    return np.where(n > 0, np.where(seen, counts / np.maximum(mass, 1), others * scale), shorter)


def _spelled(words: list[bytes]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Flat bytes of the words, offsets and lengths."""
    length = np.fromiter(map(len, words), np.int64, len(words))
    return np.frombuffer(b"".join(words) + b"\0", np.uint8), np.cumsum(length) - length, length


def _context(data, offset, depth: int) -> np.ndarray:
    """The ``ORDER`` bytes before position ``depth`` as a number."""
    code = np.zeros(len(offset), np.int64)
    for back in range(ORDER, 0, -1):
        code = code << 8 | (data[offset + depth - back] if depth >= back else _BOUNDARY)
    return code


def _symbols(data, offset, length, start: int, stop: int | None):
    """Depth, words that reach it, their offsets and symbols there."""
    depth = start
    active = np.flatnonzero(length >= start)
    while len(active) and depth != stop:
        o, l = offset[active], length[active]
        yield depth, active, o, np.where(l == depth, END, data[np.minimum(o + depth, len(data) - 1)].astype(np.int64))
        active = active[l > depth]
        depth += 1


def _short_counts(batches):
    """Counts of (context, symbol) over distinct words, each counted once: the
    training words ``n`` and all words ``uses``."""
    total: dict[int, tuple[int, int]] = {}

    def rows():
        code = np.fromiter(total, np.int64, len(total))
        n, uses = np.array(list(total.values()), dtype=np.int64).reshape(-1, 2).T
        total.clear()
        return pa.RecordBatch.from_arrays(
            [pa.array(code >> 9), pa.array((code & 511).astype(np.int32)), pa.array(n), pa.array(uses)],
            names=["context", "symbol", "n", "uses"],
        )

    for batch in batches:
        data, offset, length = _spelled(batch.column(0).to_pylist())
        trained = batch.column(1).to_numpy() > 0
        codes, owners = [], []
        for depth, active, o, symbol in _symbols(data, offset, length, 0, None):
            codes.append(_context(data, o, depth) << 9 | symbol)
            owners.append(trained[active])
        if not codes:
            continue
        code, at, uses = np.unique(np.concatenate(codes), return_inverse=True, return_counts=True)
        n = np.bincount(at, weights=np.concatenate(owners), minlength=len(code)).astype(np.int64)
        for c, k, u in zip(code.tolist(), n.tolist(), uses.tolist()):
            a, b = total.get(c, (0, 0))
            total[c] = (a + k, b + u)
        if len(total) > 200_000:  # summed by the shuffle
            yield rows()
    if total:
        yield rows()


# --- the trie


def escape(n, once, distinct, chain):
    """Probability that a node's next symbol is one it has not seen.

    ``once``: symbols seen once; ``chain``: the node's parent had no other
    continuation either, so the token is probably determined by now.
    """
    estimate = np.minimum((once + SURE) / (n + 1.0), 0.9)
    sure = SURE * np.where(n > 1, SURE, 0.4) / (n + 1.0)
    return DAMPED * np.where(chain & (distinct == 1), sure, estimate)


def walk(words: list[bytes], counts: np.ndarray, start: int, stop: int | None, score: np.ndarray, plain: np.ndarray, chain: np.ndarray, short: Short | Spelling) -> None:
    """Add the log10 probabilities of the symbols at depths ``start`` to ``stop``.

    ``words`` are distinct, sorted, at least ``start`` bytes long and complete
    for each of their prefixes of that length. ``score`` (by the trie), ``plain``
    (by the short contexts alone) and ``chain`` describe the path so far and are
    updated.
    """
    data, offset, length = _spelled(words)
    active = np.arange(len(words))
    alive = np.ones(len(words), dtype=bool)  # the word's path is still in the trie
    new = np.ones(len(words), dtype=bool)  # first word of a node
    prefix = [w[:start] for w in words]
    new[1:] = [a != b for a, b in zip(prefix, prefix[1:])]
    depth = start
    while len(active) and depth != stop:
        o = offset[active]
        closes = length[active] == depth
        symbol = np.where(closes, END, data[np.minimum(o + depth, len(data) - 1)].astype(np.int64))
        low = short.log10(_context(data, o, depth), symbol)
        # children: runs of a symbol within a node; sorted words keep them together
        child_new = new | np.append(True, symbol[1:] != symbol[:-1])
        child_at, node_at = np.flatnonzero(child_new), np.flatnonzero(new)
        child, node = np.cumsum(child_new) - 1, np.cumsum(new) - 1
        child_n = np.add.reduceat(counts[active], child_at)
        seen = child_n > 0

        def of_node(values, owner=node[child_at], nodes=len(node_at)):
            return np.bincount(owner, weights=values, minlength=nodes)

        n, once, distinct = of_node(child_n), of_node(child_n == 1), of_node(seen)
        # what the short contexts would give to symbols that the node codes itself
        taken = of_node(np.where(seen, 10.0 ** low[child_at], 0))
        e = escape(n, once, distinct, chain[active[node_at]])[node]
        own = np.log10(np.maximum((1 - e) * child_n[child], 1e-300) / np.maximum(n[node], 1))
        left = np.log10(e) - np.log10(np.maximum(1 - taken[node], 1e-12)) + low
        in_trie = alive[active] & (n[node] > 0)
        plain[active] += low
        score[active] += np.where(in_trie, np.where(seen[child], own, left), low)
        alive[active] = in_trie & seen[child]
        chain[active] = distinct[node] == 1
        # runs of children become the nodes of the next depth
        go = ~closes
        new, active = child_new[go], active[go]
        depth += 1


class Top:
    """Nodes above the subtrees: every prefix shorter than ``depth``."""

    def __init__(self, rows: list[tuple[bytes, int]], depth: int, short: Short | Spelling):
        """``rows``: (first ``depth`` bytes of words, training tokens); a prefix
        shorter than ``depth`` is a whole word."""
        self.depth = depth
        count = dict(rows)
        words = sorted(count)
        score, plain, chain = np.zeros(len(words)), np.zeros(len(words)), np.zeros(len(words), dtype=bool)
        if words:
            walk(words, np.array([count[w] for w in words], dtype=np.int64), 0, depth, score, plain, chain, short)
        self.paths = dict(zip(words, zip(score.tolist(), plain.tolist(), chain.tolist())))


def _score_words(batches, top: Top, common: Spelling):
    """Scores of words that arrive sorted; whole subtrees are scored together.

    Rows without a word come before the words of their ``head``: the spellings
    of these words that are not among the common ones.
    """
    waiting: list[pa.RecordBatch] = []

    def answer(table: pa.Table):
        rare = table.filter(pc.is_null(table.column("word")))
        short = Spelling(rare.column("code").to_numpy(), rare.column("low").to_numpy(), common)
        table = table.filter(pc.is_valid(table.column("word")))
        words = table.column("word").to_pylist()
        counts = table.column("n").to_numpy()
        paths = [top.paths[w[: top.depth]] for w in words]
        score, plain, chain = (np.array(c) for c in zip(*paths))
        # a word shorter than the prefixes is coded already
        at = np.flatnonzero(np.fromiter((len(w) >= top.depth for w in words), bool, len(words)))
        if len(at):
            part, low = score[at], plain[at]
            walk([words[i] for i in at.tolist()], counts[at], top.depth, None, part, low, chain[at], short)
            score[at], plain[at] = part, low
        return table.select(["places", "n"]).append_column("score", pa.array(score)).append_column("plain", pa.array(plain))

    for batch in batches:
        if not batch.num_rows:
            continue
        waiting.append(batch)
        if sum(b.num_rows for b in waiting) < 200_000:
            continue
        table = pa.Table.from_batches(waiting)
        # keep the last subtree back, it may go on
        heads = table.column("head")
        last = heads[-1].as_py()
        low, high = 0, table.num_rows
        while low < high:  # first row of the last subtree
            middle = (low + high) // 2
            if heads[middle].as_py() < last:
                low = middle + 1
            else:
                high = middle
        if low:
            yield from answer(table.slice(0, low)).to_batches()
        waiting = table.slice(low).to_batches()
    if waiting:
        yield from answer(pa.Table.from_batches(waiting)).to_batches()


# --- scores back to documents


def document_scores(tokens: list[np.ndarray], score: np.ndarray, n: np.ndarray) -> tuple[np.ndarray, ...]:
    """Of each document: tokens, known ones, sum of log10(c + 0.5), and the
    log10 probability, from per-word tables."""
    length = np.array([len(t) for t in tokens], dtype=np.int64)
    flat = np.concatenate(tokens).astype(np.int64)
    doc = np.repeat(np.arange(len(tokens)), length)
    start = np.repeat(np.cumsum(length) - length, length)
    t = np.arange(len(flat)) - start
    fixed = score[flat]
    width = np.int64(len(score))
    before = _seen_before(doc * width + flat)
    after = np.append(-1, flat[:-1])  # the word before
    pair = (doc * width + flat) * (width + 1) + np.where(t > 0, after, width)
    if len(tokens) * float(width) * float(width + 1) < 9e18:
        pairs = _seen_before(pair)
    else:  # such a key would not fit: number the words of this group first
        _, small = np.unique(flat, return_inverse=True)
        w = np.int64(small.max() + 1)
        pairs = _seen_before((doc * w + small) * (w + 1) + np.where(t > 0, np.append(w, small[:-1]), w))
    # how often the word before had been followed by anything
    led = np.where(t > 0, np.append(0, before[:-1]), 0)
    p = 10.0**fixed
    single = before / np.maximum(t, 1)
    blend = np.where(
        led > 0,
        0.3 * p + 0.2 * single + 0.5 * pairs / np.maximum(led, 1),
        np.where(t > 0, 0.6 * p + 0.4 * single, p),
    )
    add = lambda v: np.bincount(doc, weights=v, minlength=len(tokens))
    trained, adapted = add(fixed), add(np.log10(np.maximum(blend, 1e-300)))
    a, b = trained + math.log10(1 - ADAPTIVE), adapted + math.log10(ADAPTIVE)
    top = np.maximum(a, b)
    total = top + np.log10(10.0 ** (a - top) + 10.0 ** (b - top))
    return length, add(n[flat] > 0).astype(np.int64), add(np.log10(n[flat] + 0.5)), total


def _seen_before(key: np.ndarray) -> np.ndarray:
    """How often each value occurred earlier."""
    order = np.argsort(key, kind="stable")
    ordered = key[order]
    first = np.append(True, ordered[1:] != ordered[:-1]) if len(key) else np.zeros(0, bool)
    run = np.cumsum(first) - 1
    out = np.empty(len(key), np.int64)
    out[order] = np.arange(len(key)) - np.flatnonzero(first)[run]
    return out


def _score_block(docs: pa.Table, words: pa.Table, unseen: float) -> pa.Table:
    """Documents of one block with the scores of its words."""
    place = words.column("place").to_numpy()
    size = int(place.max()) + 1 if len(place) else 0
    score, n = np.zeros(size), np.zeros(size, np.int64)
    # a word is one of the trie, or a new one spelled by the short contexts
    blend = (1 - unseen) * 10.0 ** words.column("score").to_numpy() + unseen * 10.0 ** words.column("plain").to_numpy()
    score[place] = np.log10(np.maximum(blend, 1e-300))
    n[place] = words.column("n").to_numpy()
    keys, held = docs.column("key"), docs.column("held_out")
    packed = docs.column("tokens").to_pylist()
    columns: list[list] = [[], [], [], []]
    at = 0
    while at < len(packed):
        group, count = [], 0
        while at < len(packed) and count < 400_000:
            group.append(np.frombuffer(zlib.decompress(packed[at]), np.uint32))
            count += len(group[-1])
            at += 1
        for column, values in zip(columns, document_scores(group, score, n)):
            column.append(values)
    joined = [np.concatenate(c) for c in columns]
    return pa.table(
        {
            "key": keys,
            "held_out": held,
            "n_tokens": pa.array(joined[0], pa.int64()),
            "n_known": pa.array(joined[1], pa.int64()),
            "_base": pa.array(joined[2], pa.float64()),
            "score": pa.array(joined[3], pa.float64()),
        }
    )


def score(docs: DataFrame, text: str = "text", key: str = "doc_id", held_out=None, block_bytes: int | None = None) -> DataFrame:
    """``key``, held_out, n_tokens, n_known, train_tokens, base_score, score.

    ``held_out`` is a boolean column of rows that are not learned from; by
    default those whose crc32 of the id leaves 1 when divided by 5.
    """
    held = (split_remainder(key) == 1) if held_out is None else held_out
    kind = docs.schema[key].dataType.simpleString()
    source = docs.select(F.col(key).cast("string").alias("key"), F.col(text).alias("text"), held.alias("held_out"))
    spec = "block long, place int, word binary, n long, key string, held_out boolean, tokens binary"
    blocks = stored(source.mapInArrow(_blocks, spec), "blocks")
    dictionary = blocks.where(F.col("word").isNotNull()).select("block", "place", "word", "n")

    depth, heads = 2, None
    while True:
        head = F.expr(f"substring(word, 1, {depth})")
        heads = stored(dictionary.groupBy(head.alias("head")).agg(F.sum("n").alias("n"), F.count(F.lit(1)).alias("rows")), "heads")
        size = heads.agg(F.count(F.lit(1)), F.max("rows"), F.sum("n"), F.sum("rows")).first()
        if size[1] is None or size[1] <= SUBTREE_SHARE * size[3] or depth == 6 or size[0] * 64 > MOST_PREFIXES:
            break
        depth += 1
    if size[0] > MOST_PREFIXES:
        raise ValueError(f"more than {MOST_PREFIXES} prefixes of {depth} bytes")
    train_tokens = int(size[2] or 0)
    distinct_words = stored(dictionary.groupBy("word").agg(F.sum("n").alias("n")), "distinct")
    counted = stored(
        distinct_words.mapInArrow(_short_counts, "context long, symbol int, n long, uses long")
        .groupBy("context", "symbol").agg(F.sum("n").alias("n"), F.sum("uses").alias("uses")),
        "contexts",
    )
    spelt = stored(spellings(counted), "spellings")
    common = common_spellings(spelt)
    send = blocks.sparkSession.sparkContext.broadcast
    commons = send(common)

    def rare(words: DataFrame, inner: bool) -> DataFrame:
        found = words.select("word").mapInArrow(lambda batches: _rare(batches, commons.value, depth, inner), "head binary, code long")
        return found.join(spelt.select("code", "low"), "code")

    # of the table of nodes above the subtrees: bounded as that is
    extra = rare(heads.select(F.col("head").alias("word")), False).select("code", "low").distinct().toArrow()
    known = Spelling(extra.column("code").to_numpy(), extra.column("low").to_numpy(), common)
    top = Top([(bytes(r["head"]), int(r["n"])) for r in heads.select("head", "n").collect()], depth, known)
    tops = send(top)

    spelled = rare(distinct_words, True)
    place = F.when(F.col("word").isNotNull(), F.struct("block", "place"))
    gathered = (
        dictionary.withColumn("head", F.expr(f"substring(word, 1, {depth})"))
        .unionByName(spelled, allowMissingColumns=True)
        .repartition("head")
        .groupBy("head", "word", "code", "low")
        .agg(F.sum("n").alias("n"), F.collect_list(place).alias("places"))
        .sortWithinPartitions("head", F.col("word").asc_nulls_first())
        .select("head", "word", "n", "places", "code", "low")
    )
    scored = stored(
        gathered.mapInArrow(
            lambda batches: _score_words(batches, tops.value, commons.value), "places array<struct<block:bigint,place:int>>, n long, score double, plain double"
        ),
        "words",
    )
    distinct, once = scored.agg(F.count(F.when(F.col("n") > 0, 1)), F.count(F.when(F.col("n") == 1, 1))).first()
    # Good-Turing: the share of tokens that are new is that of words seen once
    unseen = min(max(once / max(train_tokens, 1), 1e-6), 0.5)
    words = scored.select(F.explode("places").alias("p"), "n", "score", "plain").select("p.block", "p.place", "n", "score", "plain")
    rows = blocks.where(F.col("tokens").isNotNull()).select("block", "key", "held_out", "tokens")
    found = (
        rows.groupBy("block")
        .cogroup(words.groupBy("block"))
        .applyInArrow(lambda d, w: _score_block(d, w, unseen), "key string, held_out boolean, n_tokens long, n_known long, _base double, score double")
    )
    norm = math.log10(train_tokens + 0.5 * (distinct + 1))
    return found.select(
        F.col("key").cast(kind).alias(key),
        "held_out",
        "n_tokens",
        "n_known",
        F.lit(train_tokens).cast("long").alias("train_tokens"),
        (F.col("_base") - F.col("n_tokens") * F.lit(norm)).alias("base_score"),
        "score",
    )

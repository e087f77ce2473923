"""Quality classifier: attention-based multiple-instance learning.

A text is a bag of passages. Every passage is encoded by a small layer over
counts that need no dictionary (bytes by class, lengths of words and lines,
repeats of neighbouring words, hashed words); a gated attention layer,
``w . (tanh(V h) * sigmoid(U h))``, weights the passages; the weighted sum of
the encodings is scored by a logistic unit. Only labels of texts are known, so
the attention learns which passages decide.

Training is a bounded job on the driver: at most ``TRAIN_ROWS`` labelled rows
outside the held-out fold, the ones with the least hash of their id, and of
each training text at most ``TRAIN_PASSAGES`` passages in even steps. Scoring
is one pass over all rows and all passages of whole texts, without a shuffle.

Labels, lang, source and ids are never inputs of a score.

Defined results: a null or empty text is one empty passage and gets the score
of an empty text; a null id is in the fold of the empty text; repeated rows are
scored alike; without usable labels of both kinds every score is the share of
label 1 (0.5 without labels); an empty table gives an empty result. Only
``key`` and ``text`` are read, so other columns cannot clash.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from flowlab.llm.common import byte_column, fresh, frugal, quoted, split_remainder

#: labelled rows the classifier is fitted on
TRAIN_ROWS = 4_000
#: passages of one training text
TRAIN_PASSAGES = 24
#: bytes of a passage; it ends at the next white space
PASSAGE_BYTES = 512
#: buckets of hashed words
HASHED = 64
HIDDEN = 24
ATTENTION = 16
EPOCHS = 30
THRESHOLD = 0.3
#: bytes of text whose passages are encoded together
GROUP_BYTES = 1_500_000

_SPACE = np.zeros(256, dtype=bool)
_SPACE[[9, 10, 11, 12, 13, 32]] = True


def _byte_classes() -> np.ndarray:
    """Class of each byte: letters by case, digits, every punctuation mark of
    its own, the rest of ASCII, and two kinds of bytes beyond."""
    classes = np.zeros(256, dtype=np.int64)
    classes[ord("a") : ord("z") + 1] = 1
    classes[ord("A") : ord("Z") + 1] = 2
    classes[ord("0") : ord("9") + 1] = 3
    classes[_SPACE] = 4
    classes[10] = 5
    classes[0x80:0xC0] = 6
    classes[0xC0:] = 7
    marks = [b for b in range(33, 127) if not chr(b).isalnum()]
    classes[marks] = 8 + np.arange(len(marks))
    return classes


_CLASS = _byte_classes()
_CLASSES = int(_CLASS.max()) + 1
#: bytes whose features are computed together
AT_ONCE = 1 << 20
#: features of one passage
WIDTH = _CLASSES + 8 + HASHED


def passage_cuts(data: np.ndarray, size: int = PASSAGE_BYTES) -> np.ndarray:
    """Start of each passage of one text, then its length. A passage ends at
    the first white space at or after ``size`` bytes, or after twice as many."""
    n = len(data)
    if n <= size:
        return np.array([0, n])
    gaps = np.flatnonzero(_SPACE[data])
    cuts, at = [0], 0
    while n - at > size:
        i = np.searchsorted(gaps, at + size)
        end = int(gaps[i]) + 1 if i < len(gaps) else n
        at = min(end, at + 2 * size, n)
        cuts.append(at)
    if cuts[-1] != n:
        cuts.append(n)
    return np.array(cuts)


def passage_features(texts: list[bytes | None], most: int | None = None) -> tuple[np.ndarray, np.ndarray]:
    """Features of all passages of the texts, and the number of each text's.

    ``most`` takes that many passages of a text in even steps.
    """
    parts, sizes, numbers = [], [], []
    for text in texts:
        data = np.frombuffer(text or b"", dtype=np.uint8)
        cuts = passage_cuts(data)
        spans = np.stack([cuts[:-1], cuts[1:]], axis=1)
        if most is not None and len(spans) > most:
            spans = spans[np.linspace(0, len(spans) - 1, most).round().astype(int)]
            data = np.concatenate([data[a:b] for a, b in spans.tolist()])
        parts.append(data)
        sizes.append(spans[:, 1] - spans[:, 0])
        numbers.append(len(spans))
    data = np.concatenate(parts) if parts else np.zeros(0, np.uint8)
    size = np.concatenate(sizes) if sizes else np.zeros(0, np.int64)
    # about a megabyte at a time: the arrays on the way take many bytes per byte
    ends = np.cumsum(size)
    cuts = np.unique(np.searchsorted(ends, np.arange(AT_ONCE, len(data), AT_ONCE)))
    edges = [0, *cuts[cuts > 0].tolist(), len(size)]
    found = [
        _features(data[ends[a] - size[a] : ends[b - 1]], size[a:b]) for a, b in zip(edges, edges[1:]) if b > a
    ]
    return np.concatenate(found) if found else _features(data, size), np.array(numbers, dtype=np.int64)


def _features(data: np.ndarray, size: np.ndarray) -> np.ndarray:
    n = len(size)
    passage = np.repeat(np.arange(n), size)
    length = np.maximum(size, 1)[:, None]
    counted = np.bincount(passage * _CLASSES + _CLASS[data], minlength=n * _CLASSES).reshape(n, _CLASSES)
    space = _SPACE[data]
    first = np.zeros(len(data), dtype=bool)  # bytes that begin a passage
    begins = np.cumsum(size) - size
    first[begins[size > 0]] = True
    start = ~space & (np.append(True, space[:-1])[: len(data)] | first)
    out = np.zeros((n, WIDTH))
    out[:, :_CLASSES] = np.sqrt(counted / length)
    at = np.flatnonzero(start)
    if len(at):
        # a rolling sum per word as its hash: reduceat over weighted bytes
        ends = np.append(at[1:], len(data))
        weighted = np.where(space, 0, (data.astype(np.int64) | 32) * _WEIGHTS[np.minimum(np.arange(len(data)) - np.repeat(np.append(0, at), np.diff(np.concatenate([[0], at, [len(data)]]))), 63)])
        hashed = np.add.reduceat(weighted, at)
        letters = np.add.reduceat((~space).astype(np.int64), at)
        del weighted, ends
        owner = passage[at]
        words = np.bincount(owner, minlength=n).astype(float)
        some = np.maximum(words, 1)
        same = np.append(False, (hashed[1:] == hashed[:-1]) & (owner[1:] == owner[:-1]))
        next_but_one = np.zeros(len(at), dtype=bool)
        next_but_one[2:] = (hashed[2:] == hashed[:-2]) & (owner[2:] == owner[:-2])
        total = np.bincount(owner, weights=letters, minlength=n)
        square = np.bincount(owner, weights=letters.astype(float) ** 2, minlength=n)
        mean = total / some
        pairs = np.unique(owner * np.int64(1 << 32) + (hashed & 0xFFFFFFFF))
        distinct = np.bincount(pairs >> 32, minlength=n)
        lines = counted[:, 5] + 1
        out[:, _CLASSES : _CLASSES + 8] = np.stack(
            [
                np.log1p(words) / 5,
                mean / 10,
                np.sqrt(np.maximum(square / some - mean**2, 0)) / 10,
                np.bincount(owner, weights=same, minlength=n) / some,
                np.bincount(owner, weights=next_but_one, minlength=n) / some,
                distinct / some,
                np.bincount(owner, weights=letters <= 3, minlength=n) / some,
                np.log1p(words / lines) / 5,
            ],
            axis=1,
        )
        bucket = ((hashed * 0x9E3779B1) >> 7) % HASHED
        spread = np.bincount(owner * HASHED + bucket, minlength=n * HASHED).reshape(n, HASHED)
        out[:, _CLASSES + 8 :] = np.sqrt(spread / some[:, None])
    return out


_WEIGHTS = np.random.default_rng(7).integers(1, 1 << 40, 64)


class Model:
    """Gated attention over encoded passages, with its training by Adam."""

    def __init__(self, seed: int = 1):
        draw = np.random.default_rng(seed)
        scale = lambda a, b: draw.normal(0, 1 / np.sqrt(a), (a, b))
        self.prior = None
        self.mean = np.zeros(WIDTH)
        self.spread = np.ones(WIDTH)
        self.p = {
            "E": scale(WIDTH, HIDDEN),
            "e": np.zeros(HIDDEN),
            "V": scale(HIDDEN, ATTENTION),
            "U": scale(HIDDEN, ATTENTION),
            "w": draw.normal(0, 0.1, ATTENTION),
            "c": draw.normal(0, 0.1, HIDDEN),
            "b": np.zeros(1),
        }

    def _forward(self, x: np.ndarray, numbers: np.ndarray) -> dict:
        p = self.p
        bag = np.repeat(np.arange(len(numbers)), numbers)
        starts = np.cumsum(numbers) - numbers
        h = np.tanh(x @ p["E"] + p["e"])
        t = np.tanh(h @ p["V"])
        g = 1 / (1 + np.exp(-(h @ p["U"])))
        a = (t * g) @ p["w"]
        a = np.exp(a - np.maximum.reduceat(a, starts)[bag])
        a /= np.add.reduceat(a, starts)[bag]
        z = np.add.reduceat(a[:, None] * h, starts)
        s = 1 / (1 + np.exp(-np.clip(z @ p["c"] + p["b"], -40, 40)))
        return {"bag": bag, "starts": starts, "h": h, "t": t, "g": g, "a": a, "z": z, "s": s}

    def _gradient(self, x, numbers, y, weight, decay=1e-4) -> dict:
        p, f = self.p, self._forward(x, numbers)
        d = (f["s"] - y) * weight / weight.sum()
        dz = d[:, None] * p["c"]
        per = dz[f["bag"]]
        da = (per * f["h"]).sum(axis=1)
        inner = np.add.reduceat(f["a"] * da, f["starts"])[f["bag"]]
        dl = f["a"] * (da - inner)
        dt = dl[:, None] * f["g"] * p["w"] * (1 - f["t"] ** 2)
        dg = dl[:, None] * f["t"] * p["w"] * f["g"] * (1 - f["g"])
        dh = f["a"][:, None] * per + dt @ p["V"].T + dg @ p["U"].T
        dh *= 1 - f["h"] ** 2
        grad = {
            "E": x.T @ dh,
            "e": dh.sum(axis=0),
            "V": f["h"].T @ dt,
            "U": f["h"].T @ dg,
            "w": (dl[:, None] * f["t"] * f["g"]).sum(axis=0),
            "c": f["z"].T @ d,
            "b": np.array([d.sum()]),
        }
        return {k: v + decay * p[k] for k, v in grad.items()}

    def fit(self, x: np.ndarray, numbers: np.ndarray, y: np.ndarray, epochs: int = EPOCHS, seed: int = 1) -> Model:
        if not len(y) or y.min() == y.max():
            self.prior = float(y.mean()) if len(y) else 0.5
            return self
        self.mean, self.spread = x.mean(axis=0), x.std(axis=0) + 1e-2
        x = (x - self.mean) / self.spread
        starts = np.cumsum(numbers) - numbers
        # half of the weight on each label, so that rare junk counts
        weight = np.where(y == 1, 0.5 / y.mean(), 0.5 / (1 - y.mean()))
        draw = np.random.default_rng(seed)
        first = {k: np.zeros_like(v) for k, v in self.p.items()}
        second = {k: np.zeros_like(v) for k, v in self.p.items()}
        step = 0
        for _ in range(epochs):
            order = draw.permutation(len(y))
            for at in range(0, len(y), 128):
                some = order[at : at + 128]
                rows = np.concatenate([np.arange(starts[i], starts[i] + numbers[i]) for i in some])
                grad = self._gradient(x[rows], numbers[some], y[some], weight[some])
                step += 1
                for k, g in grad.items():
                    first[k] = 0.9 * first[k] + 0.1 * g
                    second[k] = 0.999 * second[k] + 0.001 * g * g
                    self.p[k] -= 0.01 * (first[k] / (1 - 0.9**step)) / (np.sqrt(second[k] / (1 - 0.999**step)) + 1e-8)
        return self

    def score(self, texts: list[bytes | None]) -> np.ndarray:
        if self.prior is not None:
            return np.full(len(texts), self.prior)
        out, group, size = [], [], 0
        for text in texts:
            group.append(text)
            size += len(text or b"")
            if size >= GROUP_BYTES:
                out.append(self._score(group))
                group, size = [], 0
        if group:
            out.append(self._score(group))
        return np.concatenate(out) if out else np.zeros(0)

    def _score(self, texts):
        x, numbers = passage_features(texts)
        return self._forward((x - self.mean) / self.spread, numbers)["s"]


def training_rows(docs: DataFrame, labels: DataFrame, text: str = "text", key: str = "doc_id", rows: int = TRAIN_ROWS) -> DataFrame:
    """Labelled texts outside the held-out fold: ``text`` and ``quality``.

    The ids are chosen before texts are read: those with the least hash. Ids may
    be of any type; if the tables differ in it, they are compared as texts.
    """
    chosen = (
        labels.where(F.col("quality").isin(0, 1) & (split_remainder("doc_id") != 0))
        .groupBy(F.col("doc_id").alias("_id"))
        .agg(F.max("quality").cast("int").alias("quality"))
        .orderBy(F.xxhash64("_id"), "_id")
        .limit(rows)
    )
    own = docs.select(F.col(key).alias("_id"), F.col(text).alias("text"))
    if own.schema["_id"].dataType != chosen.schema["_id"].dataType:
        own, chosen = (df.withColumn("_id", F.col("_id").cast("string")) for df in (own, chosen))
    return own.join(F.broadcast(chosen), "_id").where(split_remainder("_id") != 0).select("_id", "text", "quality")


def fit(docs: DataFrame, labels: DataFrame, text: str = "text", key: str = "doc_id", rows: int = TRAIN_ROWS) -> Model:
    """Fit on a bounded sample of labelled rows; repeated ids count once.

    Features are computed in tasks; the driver gets at most ``rows`` bags of
    ``TRAIN_PASSAGES`` short vectors.
    """
    sample = training_rows(docs, labels, text, key, rows)
    kind = sample.schema["_id"].dataType.simpleString()

    def encode(batches) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids = (batch.column(0).slice(i, 1) for i in range(batch.num_rows))
            for i, t, q in zip(ids, byte_column(batch.column(1)), batch.column(2).to_pylist()):
                x, numbers = passage_features([t], TRAIN_PASSAGES)
                yield pa.RecordBatch.from_pydict(
                    {
                        "id": i,
                        "check": pa.array([zlib.crc32(t or b"")], pa.int64()),
                        "quality": pa.array([q], pa.int32()),
                        "x": pa.array([x.astype(np.float32).tobytes()], pa.binary()),
                    }
                )

    bags = (
        sample.mapInArrow(frugal(encode), f"id {kind}, check long, quality int, x binary")
        .groupBy("id")
        .agg(F.min(F.struct("check", "quality", "x")).alias("bag"))
        .select("bag.quality", "bag.x", "id")
        .orderBy("id")
        .limit(rows)
        .collect()
    )
    x = [np.frombuffer(r["x"], np.float32).reshape(-1, WIDTH) for r in bags]
    y = np.array([r["quality"] for r in bags], dtype=float)
    numbers = np.array([len(v) for v in x], dtype=np.int64)
    features = np.concatenate(x).astype(float) if x else np.zeros((0, WIDTH))
    return Model().fit(features, numbers, y)


def score(docs: DataFrame, model: Model, text: str = "text", keep: list[str] | None = None, out: str = "score") -> DataFrame:
    """``keep`` columns and the score of every row, in one pass."""
    keep = ["doc_id"] if keep is None else keep
    source = docs.select(*map(quoted, keep), F.col(quoted(text)).alias(fresh("__text", docs)))

    def run(batches):
        for batch in batches:
            for at in range(0, batch.num_rows, 500):  # a few texts at a time
                part = batch.slice(at, 500)
                scores = model.score(list(byte_column(part.column(part.num_columns - 1))))
                columns = [*part.columns[:-1], pa.array(scores, pa.float64())]
                yield pa.RecordBatch.from_arrays(columns, names=[*keep, out])

    fields = ", ".join(f"{quoted(f.name)} {f.dataType.simpleString()}" for f in source.schema.fields[:-1])
    return source.mapInArrow(frugal(run), f"{fields}, {quoted(out)} double")


def classify(docs: DataFrame, labels: DataFrame, text: str = "text", key: str = "doc_id") -> DataFrame:
    """``key``, ``held_out``, ``score``, ``predicted`` of every row."""
    model = fit(docs, labels, text, key)
    return score(docs, model, text, [key]).select(
        key,
        (split_remainder(key) == 0).alias("held_out"),
        "score",
        (F.col("score") >= THRESHOLD).cast("int").alias("predicted"),
    )


def accepted(docs: DataFrame, labels: DataFrame, text: str = "text", key: str = "doc_id") -> DataFrame:
    """The rows of ``docs`` that the classifier does not reject."""
    model = fit(docs, labels, text, key)
    name = fresh("__score", docs)
    return score(docs, model, text, docs.columns, name).where(F.col(name) >= THRESHOLD).drop(name)

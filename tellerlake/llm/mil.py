"""Document quality by attention-based multiple-instance learning.

A document is a bag of passages. Each passage is encoded, gated attention
weighs the passages, and the weighted representation is scored; the weights are
learned from labels of whole documents. The network is small enough for numpy.

Fitting uses a bounded sample: at most ``max_labels`` labelled ids of the given
folds, taken in the order of a hash of the id, with one text each (of an id with
several the one of the least hash, whatever its label). Every passage of these
texts is encoded and learnt from. Their features are written to the shared folder
in the order of the hash and streamed from there in every epoch, so the driver
holds the bags of a few minibatches at a time, however long the texts are. Scoring
reads every passage of every text, in tasks that need nothing but the weights, a
few kilobytes that travel with them.

Defined results: a null or empty text is one passage of zeros and gets a score;
a null label is no label, and repeated labels of an id are averaged; without
labels of both kinds every score is the share of good labels, or one half;
repeated rows get equal scores; other columns are kept, a column named like
``out`` is replaced; an empty table stays empty.
"""

from __future__ import annotations

import math
from collections import Counter
from collections.abc import Iterator
from itertools import pairwise

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tellerlake.operators.joins import written

PASSAGE_WORDS = 64
MAX_LABELS = 12_000
HIDDEN, GATES = 24, 12
#: Bags, and their bytes, from which minibatches are drawn while an epoch streams by.
WINDOW, WINDOW_BYTES = 1024, 32 << 20
#: Documents that are scored in one matrix product.
BLOCK = 512

#: Bytes that are counted together.
CLASSES = (
    b"abcdefghijklmnopqrstuvwxyz",
    b"ABCDEFGHIJKLMNOPQRSTUVWXYZ",
    b"0123456789",
    bytes(range(128, 256)),
    b"!",
    b"?",
    b".,;:",
    b"#*$%&|<>",
    b"'\"`",
    b"()[]{}",
    b"-_/\\+=@^~",
    bytes(range(32)),
)
_CLASS_OF = np.full(256, len(CLASSES), np.uint8)
for _k, _members in enumerate(CLASSES):
    _CLASS_OF[list(_members)] = _k
N_CLASSES = len(CLASSES)
FEATURES = N_CLASSES + 12


def passages(text: bytes | None) -> np.ndarray:
    """A row of features for each passage of PASSAGE_WORDS words; at least one row."""
    text = text or b""
    words = text.split()
    if not words:
        return np.zeros((1, FEATURES))
    lines = [line for line in text.split(b"\n") if line.strip()]
    whole = (
        math.log1p(len(words)) / 10,
        len(set(words)) / len(words),
        len(set(lines)) / max(1, len(lines)),
        len(set(pairwise(words))) / max(1, len(words) - 1),
        math.log1p(len(lines)) / 10,
    )
    starts = range(0, len(words), PASSAGE_WORDS)
    out = np.zeros((len(starts), FEATURES))
    for row, start in zip(out, starts):
        part = words[start : start + PASSAGE_WORDS]
        joined = b"".join(part)
        counts = np.bincount(_CLASS_OF[np.frombuffer(joined, np.uint8)], minlength=N_CLASSES + 1)
        lengths = list(map(len, part))
        mean = len(joined) / len(part)
        row[:N_CLASSES] = np.sqrt(counts[:N_CLASSES] / len(joined))
        row[N_CLASSES:] = (
            len(set(part)) / len(part),
            sum(a == b for a, b in pairwise(part)) / len(part),
            max(Counter(part).values()) / len(part),
            len(set(pairwise(part))) / max(1, len(part) - 1),
            mean / 10,
            min(2.0, math.sqrt(sum((n - mean) ** 2 for n in lengths) / len(part)) / 5),
            len(part) / PASSAGE_WORDS,
            *whole,
        )
    return out


def _sigmoid(x):
    return 1 / (1 + np.exp(-np.clip(x, -40, 40)))


class Model:
    """Encoder, gated attention and score; bags are given as stacked passages and their first rows."""

    def __init__(self, mean: np.ndarray, scale: np.ndarray, prior: float, seed: int = 7):
        rng = np.random.default_rng(seed)
        self.mean, self.scale, self.prior = mean, scale, prior
        draw = lambda a, b: rng.normal(0, 1 / math.sqrt(a), (a, b))
        self.p = {
            "W": draw(FEATURES, HIDDEN),
            "w": np.zeros(HIDDEN),
            "V": draw(HIDDEN, GATES),
            "U": draw(HIDDEN, GATES),
            "a": np.zeros(GATES),
            "c": np.zeros(HIDDEN),
            "d": np.array(math.log(prior / (1 - prior))),
        }
        self.trained = False

    def forward(self, x: np.ndarray, starts: np.ndarray):
        p, sizes = self.p, np.diff([*starts, len(x)])
        x = np.clip((x - self.mean) / self.scale, -6, 6)
        h = np.tanh(x @ p["W"] + p["w"])
        t, g = np.tanh(h @ p["V"]), _sigmoid(h @ p["U"])
        e = (t * g) @ p["a"]
        e = np.exp(e - np.repeat(np.maximum.reduceat(e, starts), sizes))
        weight = e / np.repeat(np.add.reduceat(e, starts), sizes)
        z = np.add.reduceat(weight[:, None] * h, starts, axis=0)
        return _sigmoid(z @ p["c"] + p["d"]), (x, h, t, g, weight, z, sizes)

    def gradients(self, x, starts, y, decay: float):
        p = self.p
        score, (x, h, t, g, weight, z, sizes) = self.forward(x, starts)
        ds = (score - y) / len(y)
        dz = np.repeat(ds[:, None] * p["c"], sizes, axis=0)
        dw = (dz * h).sum(axis=1)
        de = weight * (dw - np.repeat(np.add.reduceat(weight * dw, starts), sizes))
        dtg = de[:, None] * p["a"]
        dt, dg = dtg * g * (1 - t**2), dtg * t * g * (1 - g)
        dh = weight[:, None] * dz + dt @ p["V"].T + dg @ p["U"].T
        dpre = dh * (1 - h**2)
        out = {
            "W": x.T @ dpre,
            "w": dpre.sum(axis=0),
            "V": h.T @ dt,
            "U": h.T @ dg,
            "a": (t * g).T @ de,
            "c": z.T @ ds,
            "d": ds.sum(),
        }
        return {k: v + decay * p[k] * (k in "WVUc") for k, v in out.items()}

    def fit(self, bags: Bags, epochs: int = 40, batch: int = 128, rate: float = 0.01):
        rng = np.random.default_rng(11)
        first, second = ({k: np.zeros_like(v) for k, v in self.p.items()} for _ in range(2))
        step, seen = 0, 0
        for _ in range(epochs):
            for part in bags.batches(batch, rng):
                x, y = [bag for bag, _ in part], np.array([label for _, label in part])
                starts = np.cumsum([0, *map(len, x)])[:-1]
                step, seen = step + 1, seen + len(part)
                now = rate * (1 - 0.95 * seen / (epochs * bags.count))
                for name, g in self.gradients(np.concatenate(x), starts, y, 1e-5).items():
                    first[name] = 0.9 * first[name] + 0.1 * g
                    second[name] = 0.999 * second[name] + 0.001 * g**2
                    up = (first[name] / (1 - 0.9**step)) / (np.sqrt(second[name] / (1 - 0.999**step)) + 1e-8)
                    self.p[name] = self.p[name] - now * up
        self.trained = True

    def score(self, bags: list[np.ndarray]) -> np.ndarray:
        if not self.trained:
            return np.full(len(bags), self.prior)
        starts = np.cumsum([0, *map(len, bags)])[:-1]
        return self.forward(np.concatenate(bags), starts)[0]


class Bags:
    """Encoded texts with their labels, streamed from a written table; and mean and scale over all passages."""

    def __init__(self, table: DataFrame):
        self.table, self.count, self.good = table, 0, 0.0
        n, total, squares = 0, np.zeros(FEATURES), np.zeros(FEATURES)
        for x, y in self:
            x = x.astype(float)
            n, total, squares = n + len(x), total + x.sum(axis=0), squares + (x**2).sum(axis=0)
            self.count, self.good = self.count + 1, self.good + y
        self.mean = total / max(1, n)
        self.scale = np.sqrt(np.maximum(0, squares / max(1, n) - self.mean**2)) + 1e-3

    def __iter__(self) -> Iterator[tuple[np.ndarray, float]]:
        for row in self.table.toLocalIterator():
            yield np.frombuffer(row.x, np.float32).reshape(-1, FEATURES), row.y

    def batches(self, size: int, rng: np.random.Generator) -> Iterator[list[tuple[np.ndarray, float]]]:
        """Minibatches drawn from a window over the hashed order, of WINDOW bags or WINDOW_BYTES."""
        held, held_bytes = [], 0
        for bag in self:
            held.append(bag)
            held_bytes += bag[0].nbytes
            if len(held) >= WINDOW or (held_bytes >= WINDOW_BYTES and len(held) >= size):
                held = [held[k] for k in rng.permutation(len(held))]
                while len(held) >= size:
                    yield held[:size]
                    held = held[size:]
                held_bytes = sum(x.nbytes for x, _ in held)
        held = [held[k] for k in rng.permutation(len(held))]
        for k in range(0, len(held), size):
            yield held[k : k + size]


def train(
    docs: DataFrame,
    labels: DataFrame,
    id: str = "doc_id",
    text: str = "text",
    label: str = "quality",
    max_labels: int = MAX_LABELS,
) -> Model:
    """A model of ``label`` (0 or 1) fitted to at most ``max_labels`` of the rows of ``labels``."""
    known = labels.where(F.col(f"`{label}`").isNotNull() & F.col(f"`{id}`").isNotNull())
    known = known.groupBy(F.col(f"`{id}`").alias("labelled")).agg(F.avg(f"`{label}`").alias("y"))
    sample = known.orderBy(F.xxhash64("labelled"), "labelled").limit(max_labels)

    def bag(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for k, text in enumerate(batch.column(1).cast(pa.binary())):
                one = batch.slice(k, 1)
                x = pa.array([passages(text.as_py()).astype(np.float32).tobytes()], pa.binary())
                yield pa.RecordBatch.from_arrays([one.column(0), x, one.column(2)], ["y", "x", "place"])

    # The sample has a bound, so it may be broadcast. Each task sends one text of an id, however often the id is repeated.
    chosen = docs.select(F.col(f"`{id}`").alias("own"), F.col(f"`{text}`").alias("text"))
    chosen = chosen.join(F.broadcast(sample), F.col("own") == F.col("labelled"))
    least = F.min(F.struct(F.xxhash64("text").alias("place"), "text"))
    chosen = chosen.groupBy("labelled", "y").agg(least.alias("least")).select("y", "least.text", F.xxhash64("labelled"))
    encoded = chosen.mapInArrow(bag, "y double, x binary, place long")
    # The bounded sample goes to one sorted file, so every epoch streams it in the same order.
    bags = Bags(written(encoded.repartition(1).sortWithinPartitions("place", "y"), "mil-bags"))
    prior = float(np.clip(bags.good / bags.count, 0.01, 0.99)) if bags.count else 0.5
    model = Model(bags.mean, bags.scale, prior)
    if 0 < bags.good < bags.count:
        model.fit(bags)
    return model


def score(docs: DataFrame, model: Model, text: str = "text", out: str = "score") -> DataFrame:
    """``docs`` with the model's probability that a text is good in ``out``."""

    def run(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        for batch in batches:
            done = []
            for k in range(0, len(batch), BLOCK):
                texts = batch.slice(k, BLOCK).cast(pa.binary()).to_pylist()
                done.append(model.score([passages(t) for t in texts]))
            yield pa.array(np.concatenate(done) if done else [], pa.float64())

    run.__annotations__ = {"batches": Iterator[pa.Array], "return": Iterator[pa.Array]}
    return docs.withColumn(out, F.arrow_udf(run, "double")(F.col(f"`{text}`")))

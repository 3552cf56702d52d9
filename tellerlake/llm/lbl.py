"""Language-model scores from a log-bilinear model trained with noise-contrastive estimation.

The model predicts a class from the two before it: their vectors, each through a
matrix of its place, add up to a predicted vector whose product with a class's
vector, plus a bias, is the class's score. A class is one of the most frequent
words or a spelling class, which holds all other words whose first bytes hash
alike; a word has its smoothed share of its class. Words and the end of each
text are tokens.

Every training document is used in exactly one of ``ROUNDS`` rounds. In a round
each task trains a copy in numpy on its documents, against noise drawn from the
class frequencies, and Spark averages the copies, weighted by their tokens. The
model has a fixed size, so the normaliser of every pair of contexts is one
product of two matrices, computed once; scoring then looks up three tables.

Counts cover all training documents. The most frequent words travel to the
tasks (``LEXICON`` of at most ``LEXICON_BYTES`` bytes each, a fixed bound);
the counts of all others are joined by shuffle.

Defined results: a null or empty text is its end token; a null id counts as
empty text in the fold; rows that repeat an id and text are returned as often
as they occur; without training documents every class is as likely as any
other; an empty table gives an empty result; other columns play no part.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator
from functools import cache

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tellerlake.operators.joins import on_hot_key, written

CLASSES = 1024
SPELLINGS = 256
#: Class 0 stands before the first token. The others are words (with the end token), then spellings.
WORDS = CLASSES - SPELLINGS - 1
WIDTH = 16
ROUNDS = 3
BATCH, NOISE, RATE = 256, 64, 0.05
LEXICON, LEXICON_BYTES = 100_000, 64
#: Bytes of texts that a task splits at a time, and those whose distinct words it counts at a time: a word takes some ten
#: times its bytes while its text is scored, less while it is counted, and larger pieces repeat fewer words.
PIECE, COUNTED = 1 << 20, 1 << 22
#: Rows that a task hands on at a time, tokens it trains on at a time, and steps it prepares at a time.
SENT = 50_000
TRAINED = 1 << 18
STEPS = 128
#: The end of a text, as a token: no word is empty.
END = b""


def spelling(word: bytes) -> int:
    """The spelling class of a word that is no class of its own."""
    return CLASSES - SPELLINGS + zlib.crc32(word[:2]) % SPELLINGS


@cache
def _spellings() -> np.ndarray:
    """The spelling class by the first two bytes, then by the only one, then of the empty word."""
    heads = [*(bytes(x) for x in np.ndindex(256, 256)), *(bytes([x]) for x in range(256)), END]
    return np.array(list(map(spelling, heads)), np.int64)


def _buffers(words: pa.BinaryArray) -> tuple[np.ndarray, pa.Buffer]:
    """Where each word begins and the last ends, and the bytes."""
    _, offsets, data = words.buffers()
    return np.frombuffer(offsets, np.int32, len(words) + 1, 4 * words.offset), data or pa.py_buffer(b"")


def spellings(words: pa.BinaryArray) -> np.ndarray:
    """``spelling`` of every word."""
    offsets, data = _buffers(words)
    # Two bytes more, so that the last word has a second one, and an empty word a first.
    head = np.concatenate([np.frombuffer(data, np.uint8), np.zeros(2, np.uint8)]).astype(np.int64)
    first, size = head[offsets[:-1]], np.diff(offsets)
    several = (first << 8) + head[offsets[:-1] + 1]
    return _spellings()[np.where(size > 1, several, np.where(size == 1, 65536 + first, 65792))]


def places(words: pa.BinaryArray, listed: pa.BinaryArray) -> np.ndarray:
    """Where each word stands in ``listed``, or -1."""
    return pc.index_in(words, value_set=listed).fill_null(-1).to_numpy(zero_copy_only=False).astype(np.int64)


def tokens(texts: pa.Array) -> tuple[pa.BinaryArray, np.ndarray]:
    """The tokens of all texts in one array, and how many of them each text has."""
    texts = texts.cast(pa.binary()).fill_null(b"")
    # Bytes need not be valid UTF-8; the rules are ASCII's.
    parts = pc.ascii_split_whitespace(pc.ascii_lower(texts.view(pa.string())))
    offsets, data = _buffers(parts.values.view(pa.binary()))
    # The parts lie side by side, so a word is its end: empty parts go, and each text's last end comes again for END.
    full, of_text = np.diff(offsets) > 0, parts.offsets.to_numpy()
    sizes = np.diff(np.concatenate([[0], np.cumsum(full)])[of_text]) + 1
    ends = np.empty(sizes.sum(), np.int32)
    is_end = np.zeros(len(ends), bool)
    is_end[np.cumsum(sizes) - 1] = True
    ends[~is_end], ends[is_end] = offsets[1:][full], offsets[of_text[1:]]
    where = pa.py_buffer(np.concatenate([offsets[:1], ends]))
    return pa.Array.from_buffers(pa.binary(), len(ends), [None, where, data]), sizes


def _pieces(batches: Iterator[pa.RecordBatch], most: int, text: int = 0) -> Iterator[pa.RecordBatch]:
    """Slices of the batches with texts of at most ``most`` bytes, or one longer text; none is empty."""
    for batch in batches:
        size = np.cumsum(pc.binary_length(batch.column(text)).fill_null(0).to_numpy(zero_copy_only=False), dtype=np.int64)
        at = 0
        while at < len(size):
            to = max(at + 1, int(np.searchsorted(size, most + (size[at - 1] if at else 0), "right")))
            yield batch.slice(at, to - at)
            at = to


def _counts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for piece in _pieces(batches, COUNTED):
        found = tokens(piece.column(0))[0].value_counts()
        yield pa.RecordBatch.from_arrays([found.field("values"), found.field("counts")], ["word", "n"])


class Parameters:
    """The trained arrays, and one pass of noise-contrastive gradient steps."""

    SHAPES = {"context": (CLASSES, WIDTH), "target": (CLASSES, WIDTH), "place": (2 * WIDTH, WIDTH), "bias": (CLASSES, 1)}

    def __init__(self, share: np.ndarray):
        rng = np.random.default_rng(3)
        self.share = share
        self.log_expected, self.cumulative = np.log(share * NOISE).astype(np.float32), np.cumsum(share)
        self.a = {k: rng.normal(0, 0.1, s) for k, s in self.SHAPES.items()}
        self.a["place"] = np.concatenate([np.eye(WIDTH), np.eye(WIDTH)]) + self.a["place"] * 0.1
        # Near zero, so that the model starts as the class frequencies and contexts must earn their weight.
        self.a["target"] *= 0.1
        self.a["bias"] = np.log(share)[:, None]
        self.a = {k: v.astype(np.float32) for k, v in self.a.items()}
        self.squares = {k: np.full(s, 1e-2, np.float32) for k, s in self.SHAPES.items()}

    def train(self, one: np.ndarray, two: np.ndarray, target: np.ndarray, rng: np.random.Generator):
        """Steps of BATCH: contexts (the class before, the one before that), their targets, and noise that a step shares."""
        # Targets and biases meet the same classes, so they move as one array.
        joint = {"context": (self.a["context"], self.squares["context"]), "place": (self.a["place"], self.squares["place"])}
        joint["target"] = tuple(np.concatenate([x["target"], x["bias"]], axis=1) for x in (self.a, self.squares))
        for k in range(0, len(target), BATCH * STEPS):
            at = slice(k, k + BATCH * STEPS)
            whole = len(target[at]) // BATCH * BATCH
            if whole:
                self._steps(joint, *(x[at][:whole].reshape(-1, BATCH) for x in (one, two, target)), rng)
            if len(target[at]) > whole:
                self._steps(joint, *(x[at][None, whole:] for x in (one, two, target)), rng)
        for x, moved in zip((self.a, self.squares), joint["target"]):
            x["target"], x["bias"] = moved[:, :-1].copy(), moved[:, -1:].copy()

    def _steps(self, joint: dict, one: np.ndarray, two: np.ndarray, target: np.ndarray, rng: np.random.Generator):
        """A step for each row; what does not depend on the parameters is prepared for all rows at once."""
        (context, context_squares), (place, place_squares), (output, output_squares) = joint["context"], joint["place"], joint["target"]
        near, far = place[:WIDTH], place[WIDTH:]
        count, n = target.shape
        noise = np.minimum(np.searchsorted(self.cumulative, rng.random((count, NOISE)), "right"), CLASSES - 1)
        before_rows, target_rows = np.concatenate([one, two], axis=1), np.concatenate([target, noise], axis=1)
        expected = self.log_expected[target_rows]
        for k, (used, rows) in enumerate(zip(_groups(before_rows), _groups(target_rows))):
            both, wanted = context.take(before_rows[k], axis=0), output.take(target_rows[k], axis=0)
            before, earlier, sampled = both[:n], both[n:], wanted[n:, :-1]
            bias, wanted = wanted[:, -1], wanted[:n, :-1]
            predicted = before @ near
            predicted += earlier @ far
            # In single precision 1 + exp(-30) is 1, so one bound is enough.
            up = np.einsum("ij,ij->i", predicted, wanted) + bias[:n] - expected[k, :n]
            up = -1 / (1 + np.exp(np.minimum(up, 30)))
            down = predicted @ sampled.T
            down += bias[n:] - expected[k, n:]
            np.exp(np.negative(np.maximum(down, -30, out=down), out=down), out=down)
            down += 1
            np.reciprocal(down, out=down)
            d_predicted = down @ sampled
            d_predicted += up[:, None] * wanted
            extended, contexts = np.empty((n + NOISE, WIDTH + 1), np.float32), np.empty((2 * n, WIDTH), np.float32)
            np.multiply(up[:, None], predicted, out=extended[:n, :-1])
            extended[n:, :-1] = down.T @ predicted
            extended[:n, -1], extended[n:, -1] = up, down.sum(axis=0)
            extended /= n
            places = np.concatenate([before.T @ d_predicted, earlier.T @ d_predicted])
            places /= n
            np.matmul(d_predicted, near.T, out=contexts[:n])
            np.matmul(d_predicted, far.T, out=contexts[n:])
            contexts /= n
            _move(output, output_squares, extended, *rows)
            _move(context, context_squares, contexts, *used)
            place_squares += places**2
            place -= RATE * places / np.sqrt(place_squares)

    def rows(self) -> Iterator[tuple[str, int, list[float]]]:
        for name, values in self.a.items():
            for k, v in enumerate(values):
                yield name, k, [*v.tolist(), *[0.0] * (WIDTH - len(v))]


def _groups(keys: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """For each row of ``keys``: its order, where a key first stands in that order, and these keys."""
    order = np.argsort(keys.astype(np.int16), axis=1, kind="stable")
    ordered = np.take_along_axis(keys, order, axis=1)
    first = np.ones(keys.shape, bool)
    first[:, 1:] = ordered[:, 1:] != ordered[:, :-1]
    for k in range(len(keys)):
        at = np.flatnonzero(first[k])
        yield order[k], at, ordered[k].take(at)


def _move(values: np.ndarray, squares: np.ndarray, gradients: np.ndarray, order, first, rows):
    """One step of the rows by their summed gradients."""
    gradient = np.add.reduceat(gradients.take(order, axis=0), first, axis=0)
    grown = squares.take(rows, axis=0)
    grown += gradient * gradient
    squares[rows] = grown
    gradient *= RATE
    gradient /= np.sqrt(grown, out=grown)
    values[rows] = np.subtract(values.take(rows, axis=0), gradient, out=gradient)


def contexts(ids: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(class before, the one before that, target) of all tokens of the texts."""
    target = np.concatenate(ids)
    starts = np.cumsum([0, *map(len, ids)])[:-1]
    one = np.concatenate([[0], target[:-1]])
    one[starts] = 0
    two = np.concatenate([[0], one[:-1]])
    two[starts] = 0
    return one, two, target


class Tables:
    """Normalised log10 probabilities: near[a, w] + far[b, w] - norm[a, b]."""

    def __init__(self, p: Parameters):
        c, t, place, bias = (p.a[k].astype(float) for k in ("context", "target", "place", "bias"))
        near = c @ place[:WIDTH] @ t.T + bias[:, 0]
        far = c @ place[WIDTH:] @ t.T
        # The sum over all classes for every pair of contexts, as one matrix product.
        top, high = near.max(axis=1, keepdims=True), far.max(axis=1, keepdims=True)
        norm = np.log(np.exp(near - top) @ np.exp(far - high).T) + top + high.T
        self.near, self.far, self.norm = (np.asarray(x / np.log(10), np.float32) for x in (near, far, norm))

    def log10(self, one: np.ndarray, two: np.ndarray, target: np.ndarray) -> np.ndarray:
        return self.near[one, target].astype(float) + self.far[two, target] - self.norm[one, two]


class Model:
    """Corpus statistics and tables; plain arrays and lists, bounded by the constants above."""

    def __init__(self, numbers, total, distinct, class_total, class_distinct, parameters):
        self.numbers, self.total, self.distinct = numbers, total, distinct
        self.class_total, self.class_distinct = class_total, class_distinct
        tables = Tables(parameters)
        self.near, self.far, self.norm = tables.near, tables.far, tables.norm


def count_words(training: DataFrame, text: str) -> DataFrame:
    """(word, n) over all texts, the end token included; settled."""
    counted = training.select(F.col(f"`{text}`").alias("text")).mapInArrow(_counts, "word binary, n long")
    return written(counted.groupBy("word").agg(F.sum("n").alias("n")), "lbl-counts")


def most_frequent(counts: DataFrame) -> list[tuple[bytes, int]]:
    """At most LEXICON words with their counts, by count and then word.

    A histogram over the logarithm of the count, of a few thousand rows at any
    size, gives the count from which on the words are few enough; so only these
    words come to the driver, and no task sends a candidate list of its own.
    """
    step = F.floor(F.log2("n") * 64)
    known = counts.where(F.octet_length("word") <= LEXICON_BYTES).withColumn("step", step)
    sizes = {r["step"]: r["count"] for r in known.groupBy("step").count().collect()}
    lowest, size = None, 0
    for at in sorted(sizes, reverse=True):
        size += sizes[at]
        if size > LEXICON:
            break
        lowest = at
    if lowest is None:
        return []
    found = known.where(F.col("step") >= lowest).select("word", "n").toArrow()
    return sorted(zip(found["word"].to_pylist(), found["n"].to_pylist()), key=lambda x: (-x[1], x[0]))


def train(training: DataFrame, counts: DataFrame, id: str = "doc_id", text: str = "text") -> tuple[dict, dict]:
    """The model as plain data, and the lexicon: word to count."""
    top = most_frequent(counts)
    numbers = {w: k + 1 for k, (w, _) in enumerate(top[:WORDS])}
    own = training.sparkSession.createDataFrame([(bytearray(w), True) for w in numbers], "own binary, is_class boolean")
    spelled = F.pmod(F.crc32(F.substring("word", 1, 2)), F.lit(SPELLINGS)) + (CLASSES - SPELLINGS)
    # The classes' words have a fixed bound: WORDS words of LEXICON_BYTES.
    placed = counts.join(F.broadcast(own), F.col("word") == F.col("own"), "left")
    group = F.when(F.col("own").isNull(), spelled).otherwise(0).alias("class")
    sums = placed.groupBy(group).agg(F.sum("n").alias("n"), F.count("*").alias("v")).collect()
    class_total, class_distinct = np.zeros(CLASSES), np.zeros(CLASSES)
    total, distinct = sum(r.n for r in sums), sum(r.v for r in sums)
    for r in sums:
        if r["class"]:
            class_total[r["class"]], class_distinct[r["class"]] = r.n, r.v
    share = class_total.copy()
    share[1 : len(numbers) + 1] = [n for _, n in top[:WORDS]]
    parameters = Parameters((share + 0.5) / (share + 0.5).sum())
    for part in range(ROUNDS if total else 0):
        chosen = training.where(F.pmod(F.xxhash64(f"`{id}`"), F.lit(ROUNDS)) == part)
        parameters = _round(chosen.select(F.col(f"`{text}`").alias("text")), numbers, parameters, part)
    model = Model(numbers, total, distinct, class_total, class_distinct, parameters)
    return vars(model), dict(top)


def _round(texts: DataFrame, numbers: dict, parameters: Parameters, part: int) -> Parameters:
    """Copies trained on the partitions of ``texts``, averaged."""
    share, arrays, squares = parameters.share, parameters.a, parameters.squares

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own, listed, rng = Parameters(share), pa.array(numbers, pa.binary()), np.random.default_rng(part)
        own.a = {k: v.copy() for k, v in arrays.items()}
        own.squares = {k: v.copy() for k, v in squares.items()}
        seen, waiting, size = 0, [], 0

        def learn():
            one, two, target = contexts(waiting)
            order = rng.permutation(len(target))
            own.train(one[order], two[order], target[order], rng)

        for piece in _pieces(batches, PIECE):
            words, sizes = tokens(piece.column(0))
            number = places(words, listed) + 1
            number = np.where(number > 0, number, spellings(words))
            for ids in np.split(number, np.cumsum(sizes)[:-1]):
                waiting.append(ids)
                size += len(ids)
                if size >= TRAINED:
                    learn()
                    seen, waiting, size = seen + size, [], 0
        if waiting:
            learn()
            seen += size
        if seen:
            names, rows, values = zip(*own.rows())
            columns = np.array(values).T
            where = [pa.array(names), pa.array(rows, pa.int32()), pa.array([float(seen)] * len(rows))]
            titles = ["name", "row", "seen", *(f"v{k}" for k in range(WIDTH))]
            yield pa.RecordBatch.from_arrays([*where, *map(pa.array, columns)], titles)

    schema = "name string, row int, seen double, " + ", ".join(f"v{k} double" for k in range(WIDTH))
    copies = texts.mapInArrow(run, schema).groupBy("name", "row")
    weighted = [F.sum(F.col("seen") * F.col(f"v{k}")) / F.sum("seen") for k in range(WIDTH)]
    averaged = copies.agg(*[w.alias(f"v{k}") for k, w in enumerate(weighted)])
    mixed = Parameters(share)
    mixed.a = {k: v.copy() for k, v in arrays.items()}
    mixed.squares = squares
    for r in averaged.collect():
        kept = mixed.a[r["name"]][r["row"]]
        kept[:] = [r[f"v{k}"] for k in range(len(kept))]
    return mixed


_ROWS = pa.schema(
    [
        ("id", pa.string()),
        ("digest", pa.int64()),
        ("word", pa.binary()),
        ("times", pa.int64()),
        ("copies", pa.int64()),
        ("n_tokens", pa.int64()),
        ("n_known", pa.int64()),
        ("base", pa.float64()),
        ("score", pa.float64()),
    ]
)


def _rows(*columns) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(columns, _ROWS)], schema=_ROWS)


def _scorer(model, lexicon):
    """Per text a row of sums over its lexicon words, and a row for each other distinct word."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import xxhash

        m, known = model.value, lexicon.value
        tables = Tables.__new__(Tables)
        tables.near, tables.far, tables.norm = m["near"], m["far"], m["norm"]
        listed = pa.array(known, pa.binary())
        class_of = np.array([m["numbers"].get(w) or spelling(w) for w in known], np.int64)
        counts = np.array(list(known.values()), float)
        all_log = np.log10(m["total"] + 0.5 * (m["distinct"] + 1))
        class_log = np.log10(m["class_total"] + 0.5 * (m["class_distinct"] + 1))
        # A word that is a class of its own has the whole of it. The last row stands for all that are not listed.
        base_of = np.append(np.log10(counts + 0.5) - all_log, -all_log)
        share_of = np.where(class_of >= CLASSES - SPELLINGS, np.log10(counts + 0.5) - class_log[class_of], 0.0)
        class_of, share_of = np.append(class_of, 0), np.append(share_of, 0.0)
        for piece in _pieces(batches, PIECE, 1):
            ids, texts = piece.column(0), piece.column(1).cast(pa.binary()).fill_null(b"")
            digests = np.array([xxhash.xxh64_intdigest(t.as_py()) - (1 << 63) for t in texts], np.int64)
            words, sizes = tokens(texts)
            ends = np.cumsum(sizes)
            at = places(words, listed)
            rare = np.flatnonzero(at < 0)
            classes, own = class_of[at], share_of[at]
            others = words.take(pa.array(rare))
            classes[rare] = spellings(others)
            own[rare] = -class_log[classes[rare]]
            own += tables.log10(*contexts(np.split(classes, ends[:-1])))

            def of_texts(values: np.ndarray) -> np.ndarray:
                return np.add.reduceat(values, ends - sizes)

            of_text = [sizes, of_texts((at >= 0).astype(np.int64)), of_texts(base_of[at]), of_texts(own)]
            n = len(sizes)
            yield _rows(ids, digests, pa.nulls(n, pa.binary()), np.zeros(n, np.int64), np.ones(n, np.int64), *of_text)
            if len(rare):
                others = others.dictionary_encode()
                each = len(others.dictionary)
                pairs, times = np.unique(np.searchsorted(ends, rare, "right") * each + others.indices.to_numpy(), return_counts=True)
                for k in range(0, len(pairs), SENT):
                    of, word = np.divmod(pairs[k : k + SENT], each)
                    none, nothing = np.zeros(len(of), np.int64), np.zeros(len(of))
                    named = [ids.take(pa.array(of)), digests[of], others.dictionary.take(pa.array(word)), times[k : k + SENT]]
                    yield _rows(*named, none, none, none, nothing, nothing)

    return run


def score(docs: DataFrame, held_out, id: str = "doc_id", text: str = "text") -> DataFrame:
    """Per row of ``docs``: its id, ``held_out``, counts, the base score and the model's log10 probability.

    The rows for which the column ``held_out`` is false are the training documents.
    """
    docs = docs.select(F.col(f"`{id}`").alias(id), F.col(f"`{text}`").alias("__text"), held_out.alias("held_out"))
    training = docs.where(~F.col("held_out"))
    counts = count_words(training, "__text")
    model, lexicon = train(training, counts, id, "__text")
    context = docs.sparkSession.sparkContext
    run = _scorer(context.broadcast(model), context.broadcast(lexicon))
    kind = docs.schema[id].dataType
    key = F.col(f"`{id}`").cast("string")
    rows = docs.select(key.alias("id"), "__text").mapInArrow(
        run,
        "id string, digest long, word binary, times long, copies long, n_tokens long, n_known long, base double, score double",
    )
    # Rows of texts carry no word; a word of their own keeps them from meeting in one partition.
    rows = rows.withColumn("word", F.coalesce("word", F.concat(F.lit(" "), F.col("digest").cast("string")).cast("binary")))
    seen = counts.select(F.col("word").alias("counted"), F.col("n").alias("c"))
    met = rows.join(seen, on_hot_key("word", "counted"), "left")
    log = F.col("times") * F.log10(F.coalesce("c", F.lit(0)) + 0.5)
    sums = met.groupBy("id", "digest").agg(
        F.sum("copies").alias("copies"),
        F.sum("n_tokens").alias("n_tokens"),
        F.sum(F.col("n_known") + F.when(F.col("c").isNotNull(), F.col("times")).otherwise(0)).alias("n_known"),
        F.sum(F.col("base") + log).alias("base_score"),
        F.sum(F.col("score") + log).alias("score"),
    )
    # A text that occurs more than once has each sum as many times.
    each = [(F.col(c) / F.col("copies")).cast("long").alias(c) for c in ("n_tokens", "n_known")]
    each += [(F.col(c) / F.col("copies")).alias(c) for c in ("base_score", "score")]
    back = F.col("id").cast(kind).alias(id)
    one = sums.select(back, F.explode(F.sequence(F.lit(1), F.col("copies"))).alias("__copy"), *each)
    return one.drop("__copy").withColumn("train_tokens", F.lit(model["total"]).cast("long"))

"""Quality scores from random-indexing word vectors, pooled per document, and a two-layer network trained in numpy.

Every unit of text has a sparse random index vector of a few +1 and -1, drawn from its hash. The vector of a unit is the
sum of the index vectors of its neighbours over all texts of the corpus: a count, made in the tasks, summed by Spark, and
of fixed size, because units are hashed into a fixed number of rows. A word gives two units: its bare form (in lower case,
without marks at its ends) and its shape (whether it starts with capitals, small letters, digits or marks, and the marks
at its end). A document is the mean and the spread of the vectors of its words and of their shapes, its length and its share
of different words. Rare forms share rows, which blurs their vectors.

Probabilities are calibrated by a temperature, set from the logits of all labelled rows that are not held out.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import xxhash
from pyspark import Broadcast
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from shelfmark.llm.common import as_bytes, mix, small_batches, stored
from shelfmark.llm.toxicity import held_out, sigmoid

WORD_ROWS = 1 << 14
SHAPE_ROWS = 1 << 9
ROWS = WORD_ROWS + SHAPE_ROWS
DIMENSION = 32
NONZERO = 2  # entries of an index vector
REACH = 2  # neighbours on either side
WORDS_AT_ONCE = 1 << 16
CACHED_WORDS = 200_000

SAMPLE = 8000  # bound of the labelled sample the network is fitted on
HIDDEN = 24
EPOCHS = 60
BATCH = 64
RATE = 0.003
DECAY = 1e-3

STEPS = 16  # bins of a logit's unit in the counts the temperature is read from
FARTHEST = 60  # logits beyond are counted with it
TEMPERATURES = np.exp(np.linspace(np.log(0.25), np.log(16), 121))

MARKS = bytes(b for b in range(0x21, 0x7F) if not chr(b).isalnum())
# Capitals as A, small letters and all beyond ASCII as a, digits as 0; marks stay.
CLASSES = bytes(65 if 65 <= b <= 90 else 97 if 97 <= b <= 122 or b >= 128 else 48 if 48 <= b <= 57 else b for b in range(256))
LONGEST_MARKS = 4


class Units(dict):
    """Words to a number that holds their two units (row of the bare form, row of the shape), remembered until the store is full."""

    def __missing__(self, word: bytes) -> int:
        if len(self) >= CACHED_WORDS:
            self.clear()
        rest = word.rstrip(MARKS)
        shape = word[:2].translate(CLASSES) + word[len(rest):][:LONGEST_MARKS]
        found = self[word] = (xxhash.xxh3_64_intdigest(rest.lstrip(MARKS).lower()) % WORD_ROWS * SHAPE_ROWS
                              + xxhash.xxh3_64_intdigest(shape) % SHAPE_ROWS)
        return found

    def of(self, words: list[bytes]) -> np.ndarray:
        """A row per word with its two units."""
        both = np.fromiter(map(self.__getitem__, words), dtype=np.int64, count=len(words))
        return np.stack([both // SHAPE_ROWS, WORD_ROWS + both % SHAPE_ROWS], axis=1)


def index_vectors() -> np.ndarray:
    """The sparse index vector of every row: NONZERO entries of +1 or -1 (or their sum where two fall together)."""
    draws = mix(np.arange(1, ROWS * NONZERO + 1, dtype=np.uint64)).reshape(ROWS, NONZERO)
    index = np.zeros((ROWS, DIMENSION), np.int8)
    np.add.at(index, (np.arange(ROWS)[:, None], (draws % np.uint64(DIMENSION)).astype(np.int64)),
              np.where(draws >> np.uint64(63), 1, -1).astype(np.int8))
    return index


def pieces(texts: list[bytes], units: Units) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Units and text numbers of WORDS_AT_ONCE words or more at a time; a long text alone gives several pieces."""
    words, owner = [], []

    def piece() -> tuple[np.ndarray, np.ndarray]:
        return units.of(words), np.concatenate(owner)

    for n, text in enumerate(texts):
        own = text.split()
        for at in range(0, len(own), WORDS_AT_ONCE):
            part = own[at:at + WORDS_AT_ONCE]
            words.extend(part)
            owner.append(np.full(len(part), n))
            if len(words) >= WORDS_AT_ONCE:
                yield piece()
                words, owner = [], []
    if words:
        yield piece()


def add_contexts(table: np.ndarray, units: np.ndarray, owner: np.ndarray, index: np.ndarray) -> None:
    """Add to the vectors of a piece's units the index vectors of the units up to REACH words before and after, in the same text."""
    own = index[units[:, 0]] + index[units[:, 1]]
    near = np.zeros_like(own)
    for distance in range(1, min(REACH, len(units) - 1) + 1):
        same = (owner[distance:] == owner[:-distance])[:, None]
        near[:-distance] += own[distance:] * same
        near[distance:] += own[:-distance] * same
    for kind in (0, 1):
        order = np.argsort(units[:, kind].astype(np.uint16), kind="stable")  # ROWS fit; of this type it is a radix sort
        rows = units[order, kind]
        first = np.flatnonzero(np.concatenate([[True], rows[1:] != rows[:-1]]))
        table[rows[first]] += np.add.reduceat(near[order], first, axis=0, dtype=np.int32)


def count_contexts(docs: DataFrame) -> np.ndarray:
    """The vectors of all units over all texts: summed per task, then in Spark. The driver gets at most ROWS rows."""
    names = [f"d{i}" for i in range(DIMENSION)]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        units, index = Units(), index_vectors()
        table = np.zeros((ROWS, DIMENSION), np.int64)
        for batch in small_batches(batches):
            for coded, owner in pieces(as_bytes(batch.column(0)), units):
                add_contexts(table, coded, owner, index)
        met = np.flatnonzero(table.any(1))
        yield pa.RecordBatch.from_arrays([pa.array(met.astype(np.int32)), *(pa.array(table[met, i]) for i in range(DIMENSION))],
                                         names=["unit", *names])

    schema = ", ".join(["unit int", *(f"{n} long" for n in names)])
    summed = docs.select("text").mapInArrow(run, schema).groupBy("unit").agg(*(F.sum(n).alias(n) for n in names)).toPandas()
    table = np.zeros((ROWS, DIMENSION), np.int64)
    table[summed["unit"].to_numpy(np.int64)] = summed[names].to_numpy(np.int64)
    return table


def unit_vectors(table: np.ndarray) -> np.ndarray:
    """Vectors of length 1, words and shapes each without their common mean; units never met with are 0."""
    length = np.sqrt((table.astype(np.float64) ** 2).sum(1))
    vectors = table / np.maximum(length, 1)[:, None]
    for part in (slice(0, WORD_ROWS), slice(WORD_ROWS, ROWS)):
        met = length[part] > 0
        if met.any():
            vectors[part][met] -= vectors[part][met].mean(0)
    return vectors


def pooled(texts: list[bytes], vectors: np.ndarray, units: Units) -> np.ndarray:
    """A row per text: mean and spread of its word and shape vectors, length, share of different words; 0 for empty ones."""
    width = 2 * DIMENSION
    n_words, total, squares = np.zeros(len(texts)), np.zeros((len(texts), width)), np.zeros((len(texts), width))
    shapes = vectors[WORD_ROWS:]
    shape_squares = shapes ** 2
    for coded, owner in pieces(texts, units):
        x = vectors[coded[:, 0]]
        first = np.flatnonzero(np.concatenate([[True], owner[1:] != owner[:-1]]))
        for start, end in zip(first, [*first[1:], len(x)]):
            own = x[start:end]
            total[owner[start], :DIMENSION] += own.sum(0)
            squares[owner[start], :DIMENSION] += np.einsum("ij,ij->j", own, own)
            met = np.bincount(coded[start:end, 1] - WORD_ROWS, minlength=SHAPE_ROWS)
            total[owner[start], DIMENSION:] += met @ shapes
            squares[owner[start], DIMENSION:] += met @ shape_squares
            n_words[owner[start]] += end - start
    some = np.maximum(n_words, 1)[:, None]
    mean = total / some
    spread = np.sqrt(np.maximum(squares / some - mean * mean, 0))
    different = np.array([len(set(t.split())) for t in texts]) if texts else np.zeros(0)
    return np.concatenate([mean, spread, np.log1p(n_words)[:, None], (different / some[:, 0])[:, None]], axis=1)


@dataclass
class Network:
    centre: np.ndarray
    scale: np.ndarray
    first: np.ndarray
    first_bias: np.ndarray
    second: np.ndarray
    second_bias: float

    def logits(self, x: np.ndarray) -> np.ndarray:
        return np.tanh((x - self.centre) / self.scale @ self.first + self.first_bias) @ self.second + self.second_bias

    def gradients(self, x: np.ndarray, y: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """Of the mean cross entropy by the four parameters."""
        x = (x - self.centre) / self.scale
        hidden = np.tanh(x @ self.first + self.first_bias)
        error = (sigmoid(hidden @ self.second + self.second_bias) - y) / len(y)
        back = error[:, None] * self.second * (1 - hidden ** 2)
        return x.T @ back, back.sum(0), hidden.T @ error, error.sum()


PARAMETERS = ("first", "first_bias", "second", "second_bias")


def fit(x: np.ndarray, y: np.ndarray, seed: int = 5) -> Network:
    """Train by Adam with weight decay. Without rows of both labels the logits are 0 throughout."""
    rng = np.random.default_rng(seed)
    width = 4 * DIMENSION + 2
    net = Network(np.zeros(width), np.ones(width), rng.normal(0, width ** -0.5, (width, HIDDEN)), np.zeros(HIDDEN), np.zeros(HIDDEN), 0.0)
    if len(set(y.tolist())) < 2:
        return net
    net.centre, net.scale = x.mean(0), x.std(0) + 1e-3
    net.second = rng.normal(0, HIDDEN ** -0.5, HIDDEN)
    net.second_bias = float(np.log(y.sum() / (len(y) - y.sum())))
    moment = {p: [0.0, 0.0] for p in PARAMETERS}
    step = 0
    for _ in range(EPOCHS):
        order = rng.permutation(len(y))
        for at in range(0, len(y), BATCH):
            chosen = order[at:at + BATCH]
            step += 1
            for name, grad in zip(PARAMETERS, net.gradients(x[chosen], y[chosen])):
                value, m = getattr(net, name), moment[name]
                m[0] = 0.9 * m[0] + 0.1 * grad
                m[1] = 0.999 * m[1] + 0.001 * grad ** 2
                move = m[0] / (1 - 0.9 ** step) / (np.sqrt(m[1] / (1 - 0.999 ** step)) + 1e-8)
                kept = 1 - RATE * DECAY * 10 if name in ("first", "second") else 1
                setattr(net, name, value * kept - RATE * move)
    return net


def usable(labels: DataFrame) -> DataFrame:
    """doc_id and quality of the labels that may be learned from, one for each document: the lower where they contradict."""
    known = labels.where("quality IN (0, 1) AND doc_id IS NOT NULL").select(
        F.col("doc_id").cast("long").alias("doc_id"), F.col("quality").cast("int").alias("quality"))
    return known.where(~held_out(F.col("doc_id"))).groupBy("doc_id").agg(F.min("quality").alias("quality"))


def sample(docs: DataFrame, known: DataFrame, vectors: Broadcast) -> tuple[np.ndarray, np.ndarray]:
    """Pooled vectors and labels of at most SAMPLE labelled rows by a hash of doc_id; equal texts count once. Texts are pooled
    where they are read: the driver gets a row of fixed size for each of the sample's documents."""
    picked = known.orderBy(F.xxhash64("doc_id"), "doc_id").limit(SAMPLE)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        units = Units()
        for batch in small_batches(batches):
            texts = as_bytes(batch.column(2))
            names = [xxhash.xxh3_128_hexdigest(t) for t in texts]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(1), pa.array(names, pa.string()), pa.array(list(pooled(texts, vectors.value, units)), pa.list_(pa.float64()))],
                names=["doc_id", "quality", "name", "pooled"])

    texts = docs.select(docs["doc_id"].cast("long").alias("doc_id"), docs["text"]).where("text <> ''")
    # SAMPLE ids at most are sent to the tasks; repeated rows of an id are merged before they come back.
    met = texts.join(F.broadcast(picked), "doc_id").select("doc_id", "quality", "text").mapInArrow(
        run, "doc_id long, quality int, name string, pooled array<double>")
    rows = met.groupBy("doc_id").agg(F.min(F.struct("name", "quality", "pooled")).alias("row")).select("doc_id", "row.*").toPandas()
    rows = rows.sort_values("doc_id").drop_duplicates("name")
    x = np.array(rows["pooled"].tolist(), np.float64).reshape(len(rows), 4 * DIMENSION + 2)
    return x, rows["quality"].to_numpy(np.int64)


def best_temperature(counts: np.ndarray) -> float:
    """The temperature of least cross entropy, from rows counted by label and bin of the logit; 1 where a label has no row."""
    if not counts.sum(1).all():
        return 1.0
    logits = (np.arange(counts.shape[1]) + 0.5) / STEPS - FARTHEST
    loss = [(counts[1] * np.logaddexp(0, -logits / t) + counts[0] * np.logaddexp(0, logits / t)).sum() for t in TEMPERATURES]
    return float(TEMPERATURES[int(np.argmin(loss))])


def temperature(raw: DataFrame, known: DataFrame) -> float:
    """From all labelled rows of `raw` (doc_id, logit) that are not held out, counted in Spark: a row per label and bin
    reaches the driver. Equal rows count once."""
    bin_ = F.least(F.lit(2 * FARTHEST * STEPS - 1), F.greatest(F.lit(0), F.floor((F.col("logit") + FARTHEST) * STEPS).cast("int")))
    scored = raw.where("NOT held_out").select("doc_id", "logit").distinct().join(known, "doc_id")
    counts = np.zeros((2, 2 * FARTHEST * STEPS), np.int64)
    for row in scored.groupBy("quality", bin_.alias("bin")).count().collect():
        counts[row["quality"], row["bin"]] = row["count"]
    return best_temperature(counts)


def score_quality(docs: DataFrame, labels: DataFrame, threshold: float = 0.3) -> DataFrame:
    """doc_id, held_out, score (probability of quality 1) and predicted (1 from `threshold` on) of every whole text.

    A null text counts as empty; all texts without words get the same score. A null doc_id is not held out and not
    trained on. Repeated rows are scored each, and count as often in the vectors. labels: doc_id, quality 0 or 1; other values are
    ignored, repeated labels of a document count once, and the lower where they contradict each other. Without labels of both kinds
    every score is 0.5. An empty table gives an empty one. Columns beyond doc_id and text are not read.
    """
    context = docs.sparkSession.sparkContext
    vectors = context.broadcast(unit_vectors(count_contexts(docs)))  # ROWS x DIMENSION numbers
    known = usable(labels)
    network = context.broadcast(fit(*sample(docs, known, vectors)))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        units = Units()
        for batch in small_batches(batches):
            logit = network.value.logits(pooled(as_bytes(batch.column(2)), vectors.value, units))
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(logit, pa.float64())],
                                             names=["doc_id", "held_out", "logit"])

    slim = docs.select(docs["doc_id"].cast("long").alias("doc_id"), docs["text"]).select(
        "doc_id", held_out(F.col("doc_id")).alias("held_out"), "text")
    raw = stored(slim.mapInArrow(run, "doc_id long, held_out boolean, logit double"), "logits")
    scale = temperature(raw, known)
    scored = raw.select("doc_id", "held_out", (1 / (1 + F.exp(-F.col("logit") / F.lit(scale)))).alias("score"))
    return scored.select("*", F.when(F.col("score") >= threshold, 1).otherwise(0).alias("predicted"))

"""Toxicity scores from a small convolutional text classifier, trained in numpy.

A word is the sum of three hashed embeddings: two of the whole word and one of its first letters, so that a chance
collision in one table does not make two words alike, and inflected forms share something. Filters of one, two and three
words run over the text, each keeps its highest response, and a logistic layer weighs them. After training, a filter is a
table lookup per word and place, and scoring adds the looked-up rows of neighbouring words.

Thresholds are calibrated for each language, which is told by the function words of the text itself, from the scores of
all labelled rows that are not held out; the score is shifted so that 0.5 is the threshold of the text's language.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from shelfmark.llm.common import as_bytes, small_batches, stored

# Bounds of the labelled sample the classifier is fitted on.
TOXIC_ROWS = 3000
OTHER_ROWS = 5000
LONGEST = 200_000  # characters; longer texts are scored but not trained on
CALIBRATION_SHARE = 4  # one sample row in so many is kept from training, so that not only rows learned by heart set the thresholds
LEAST_LABELS = 20  # a language with fewer toxic or other rows takes the threshold of all
STEPS = 64  # bins of a logit's unit in the counts that thresholds are read from
FARTHEST = 30  # logits beyond are counted with it

BUCKETS = 1 << 19
DIMENSION = 8
WIDTHS = (1, 2, 3)
FILTERS = 8
PREFIX = 5
LEAST_TEXTS = 8  # a word or prefix found in fewer texts of the sample has no embedding
DROPPED = 0.3  # share of the words left out at random in each step of training
EPOCHS = 4
BATCH = 32
RATE = 0.02
CACHED_WORDS = 300_000
FOLDS = 5

# Frequent function words that tell the languages apart.
FUNCTION_WORDS = {
    "en": "the and of to in is that for was with as on are by this",
    "de": "der die und das von zu mit den ist für auf sich dem ein nicht",
    "fr": "le les des et une est pour dans du au sur pas ce aux il",
    "es": "el los las del por con una su para al lo como más y es",
}
LANGUAGES = tuple(FUNCTION_WORDS)
LANGUAGE_OF = {w: i for i, words in enumerate(FUNCTION_WORDS.values()) for w in words.split()}
EDGE = re.compile(r"^[\W_]+|[\W_]+$")


def features(word: bytes) -> tuple[int, int, int, int]:
    """Three embedding rows of a word, and the number of the language it speaks for (or that of none)."""
    bare = EDGE.sub("", word.decode("utf-8", "surrogatepass").lower())
    digest = xxhash.xxh3_128_intdigest(bare.encode("utf-8", "surrogatepass"))
    prefix = xxhash.xxh3_64_intdigest(bare[:PREFIX].encode("utf-8", "surrogatepass"), seed=1)
    return digest % BUCKETS, (digest >> 64) % BUCKETS, prefix % BUCKETS, LANGUAGE_OF.get(bare, len(LANGUAGES))


class WordRows(dict):
    """Words numbered in the order they are met, with their features; emptied when full."""

    def __init__(self) -> None:
        super().__init__()
        self.rows: list[tuple[int, int, int, int]] = []

    def __missing__(self, word: bytes) -> int:
        self.rows.append(features(word))
        number = self[word] = len(self) + 1
        return number  # from 1 on; 0 is the padding

    def of(self, text: bytes) -> np.ndarray:
        words = text.split()
        return np.fromiter(map(self.__getitem__, words), dtype=np.int64, count=len(words))


def joined(texts: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Word numbers of several texts with padding after each, as long as the widest filter, and the first place and the end of
    the places a filter may start from: every word and the first padding."""
    pad = np.zeros(max(WIDTHS), np.int64)
    lengths = np.array([len(t) for t in texts])
    starts = np.cumsum(lengths + len(pad)) - lengths - len(pad)
    return np.concatenate([x for t in texts for x in (t, pad)]), starts, starts + lengths + 1


@dataclass
class Model:
    table: np.ndarray  # BUCKETS x DIMENSION
    filters: dict[int, np.ndarray]  # width -> place, DIMENSION, FILTERS
    bias: np.ndarray
    weights: np.ndarray
    offset: float
    shift: np.ndarray  # by language, the last for texts that speak none

    def projected(self, rows: np.ndarray) -> np.ndarray:
        """For each word (its embedding rows) the responses of every filter at every place, side by side."""
        x = self.table[rows[:, 0]] + self.table[rows[:, 1]] + self.table[rows[:, 2]]
        return np.concatenate([x @ self.filters[k][j] for k in WIDTHS for j in range(k)], axis=1)

    def pooled(self, responses: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
        """The highest response of each filter in each text, from the projected words of the padded texts."""
        n, at, parts = len(responses), 0, []
        borders = np.stack([starts, ends], axis=1).ravel()
        for k in WIDTHS:
            total = responses[:n, at:at + FILTERS].copy()
            for j in range(1, k):
                total[:n - j] += responses[j:, at + j * FILTERS:at + (j + 1) * FILTERS]
            at += k * FILTERS
            parts.append(np.maximum.reduceat(total, borders, axis=0)[::2])
        return np.concatenate(parts, axis=1)

    def logits(self, pooled: np.ndarray) -> np.ndarray:
        return np.maximum(pooled + self.bias, 0) @ self.weights + self.offset


def sigmoid(x: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(x, -30, 30)))


def gradients(model: Model, x: np.ndarray, starts: np.ndarray, ends: np.ndarray, labels: np.ndarray, weight: np.ndarray):
    """Of the cross entropy of some texts, each times its `weight`, from their word vectors with padding (see `joined`): by weights, bias
    and offset, by the filters, and by the word vectors. A filter learns at the place of its highest response."""
    filters, places, best = model.filters, [], []
    for k in WIDTHS:
        total = np.zeros((len(x), FILTERS), np.float32)
        for j in range(k):
            total[:len(x) - j] += (x @ filters[k][j])[j:]
        place = np.stack([a + total[a:b].argmax(0) for a, b in zip(starts, ends)])
        places.append(place)
        best.append(np.take_along_axis(total, place, 0))
    pooled = np.concatenate(best, axis=1)
    active = np.maximum(pooled + model.bias, 0)
    error = (sigmoid(active @ model.weights + model.offset) - labels) * weight
    to_pool = error[:, None] * model.weights * (pooled + model.bias > 0)
    steps = {"weights": active.T @ error, "bias": to_pool.sum(0), "offset": error.sum()}
    of_filters, grad_x = {}, np.zeros_like(x)
    for n, k in enumerate(WIDTHS):
        g = to_pool[:, n * FILTERS:(n + 1) * FILTERS]
        of_filters[k] = np.zeros_like(filters[k])
        for j in range(k):
            where = np.minimum(places[n] + j, len(x) - 1)
            of_filters[k][j] = np.einsum("bf,bfd->df", g, x[where])
            np.add.at(grad_x, where.ravel(), (g[:, :, None] * filters[k][j].T[None]).reshape(-1, DIMENSION))
    return steps, of_filters, grad_x


def train(texts: list[bytes], labels: np.ndarray, seed: int = 11) -> Model:
    """Fit the classifier by stochastic gradient descent with per-weight step sizes, without the rows kept aside. Without rows
    of both labels the model answers 0 for everything."""
    rng = np.random.default_rng(seed)
    table = np.zeros((BUCKETS, DIMENSION), np.float32)
    filters = {k: rng.normal(0, 0.1, (k, DIMENSION, FILTERS)).astype(np.float32) for k in WIDTHS}
    for f in filters.values():
        f[:, 0] = rng.uniform(0.2, 0.6, f[:, 0].shape)
    n_filters = FILTERS * len(WIDTHS)
    model = Model(table, filters, np.zeros(n_filters, np.float32), np.full(n_filters, 0.3, np.float32), -1.0,
                  np.zeros(len(LANGUAGES) + 1))
    if len(set(labels.tolist())) < 2:
        model.weights[:], model.offset = 0, -20.0
        return model
    words = WordRows()
    coded = [words.of(t) for t in texts]
    rows = np.array([(0, 0, 0, len(LANGUAGES)), *words.rows], np.int64)
    kept = np.array([xxhash.xxh3_64_intdigest(t) % CALIBRATION_SHARE == 0 for t in texts])
    order = np.flatnonzero(~kept)
    if len(set(labels[order].tolist())) < 2:
        order, kept = np.arange(len(texts)), np.ones(len(texts), bool)
    evidence = first_evidence([coded[i] for i in order], labels[order], rows)
    known = np.isfinite(evidence)
    table[known] = rng.normal(0, 0.05, (known.sum(), DIMENSION))
    table[known, 0] = evidence[known]
    balance = np.where(labels == 1, 0.5 / max(1, labels[order].sum()), 0.5 / max(1, (1 - labels[order]).sum())) * len(order)

    seen = {"table": np.full(BUCKETS, 1e-6, np.float32), "bias": np.full(n_filters, 1e-6), "weights": np.full(n_filters, 1e-6),
            "offset": 1e-6, **{k: np.full(filters[k].shape, 1e-6) for k in WIDTHS}}
    for epoch in range(EPOCHS):
        rng.shuffle(order)
        for at in range(0, len(order), BATCH):
            chosen = order[at:at + BATCH]
            ids, starts, ends = joined([coded[i] for i in chosen])
            e = rows[ids, :3]
            x = table[e].sum(1)
            x[(ids == 0) | (rng.random(len(ids)) < DROPPED)] = 0
            steps, of_filters, grad_x = gradients(model, x, starts, ends, labels[chosen], balance[chosen] / len(chosen))
            steps["weights"] += 1e-4 * model.weights
            for k, step in of_filters.items():
                seen[k] += step ** 2
                filters[k] -= (RATE * step / np.sqrt(seen[k])).astype(np.float32)
            by_offset = steps.pop("offset")
            for name, step in steps.items():
                seen[name] += step ** 2
                setattr(model, name, (getattr(model, name) - RATE * step / np.sqrt(seen[name])).astype(np.float32))
            seen["offset"] += by_offset ** 2
            model.offset -= RATE * float(by_offset) / np.sqrt(seen["offset"])
            touched = np.flatnonzero(grad_x.any(1) & x.any(1))
            target, grads = e[touched].ravel(), np.repeat(grad_x[touched], 3, axis=0)
            target, grads = target[known[target]], grads[known[target]]
            np.add.at(seen["table"], target, (grads ** 2).sum(1))
            np.add.at(table, target, -RATE * grads / np.sqrt(seen["table"][target])[:, None])
    return model


def first_evidence(coded: list[np.ndarray], labels: np.ndarray, rows: np.ndarray) -> np.ndarray:
    """Where each embedding row starts in the first dimension; NaN for rows without an embedding.

    Under max pooling a word learns only where it has the highest response, which one word among hundreds hardly ever
    has by chance. So words and prefixes found in LEAST_TEXTS texts start at the lower bound of their
    log odds between the labels, which is 0 for nearly all.
    """
    words = np.zeros((len(rows), 2))
    prefixes = np.zeros((BUCKETS, 2))
    for ids, label in zip(coded, labels.tolist()):
        once = np.unique(ids)
        words[once, label] += 1
        prefixes[np.unique(rows[once, 2]), label] += 1
    total = np.maximum(np.bincount(labels, minlength=2), 1)

    def lower(count: np.ndarray) -> np.ndarray:
        odds = np.log((count[:, 1] + 1) / (total[1] + 2)) - np.log((count[:, 0] + 1) / (total[0] + 2))
        return np.clip(odds - 2 * np.sqrt((1 / (count + 1)).sum(1)), 0, 5) / 2

    found = np.full(BUCKETS, np.nan)
    often = np.flatnonzero(prefixes.sum(1) >= LEAST_TEXTS)
    found[often] = lower(prefixes[often])
    often = np.flatnonzero(words.sum(1) >= LEAST_TEXTS)
    for column in (0, 1):
        found[rows[often, column]] = lower(words[often]) / 2
    found[rows[0, :3]] = np.nan
    return found


def thresholds(counts: np.ndarray) -> np.ndarray:
    """From rows counted by language, label and bin of the logit the threshold of each language: where most of them, weighed to
    one toxic in ten, are told rightly."""
    total = counts.sum((0, 2))
    if not total.all():
        return np.zeros(len(counts))

    def threshold(rows: np.ndarray) -> float:
        wrong_below = np.concatenate([[0], np.cumsum(rows[1])]) * 0.1 / total[1]
        wrong_above = np.concatenate([np.cumsum(rows[0][::-1])[::-1], [0]]) * 0.9 / total[0]
        filled = np.flatnonzero(rows.any(0))
        wrong = (wrong_below + wrong_above)[filled[0]:filled[-1] + 2]
        least = np.flatnonzero(np.isclose(wrong, wrong.min(), rtol=1e-9, atol=0))
        widest = max(np.split(least, np.flatnonzero(np.diff(least) > 1) + 1), key=len)
        return (filled[0] + (widest[0] + widest[-1]) / 2) / STEPS - FARTHEST

    everything = threshold(counts.sum(0))
    return np.array([threshold(c) if c.sum(1).min() >= LEAST_LABELS else everything for c in counts])


def calibrate(model: Model, raw: DataFrame, labels: DataFrame) -> None:
    """Set the thresholds from all labelled rows of `raw` (doc_id, logit, language) that are not held out. They are counted in
    Spark: the driver gets one row per language, label and bin. Copies count once."""
    if not model.weights.any():
        return
    once = usable(labels).groupBy("doc_id").agg(F.min("toxic").alias("toxic"))
    scored = raw.where("NOT held_out").select("doc_id", "logit", "language").distinct().join(once, "doc_id")
    place = F.floor((F.col("logit") + FARTHEST) * STEPS).cast("int")
    place = F.greatest(F.lit(0), F.least(F.lit(2 * FARTHEST * STEPS - 1), place))
    counts = np.zeros((len(LANGUAGES) + 1, 2, 2 * FARTHEST * STEPS), np.int64)
    for row in scored.groupBy("language", "toxic", place.alias("bin")).count().collect():
        counts[row["language"], row["toxic"], row["bin"]] = row["count"]
    model.shift[:] = thresholds(counts)


class Scorer:
    """Scores texts with remembered filter responses of words."""

    def __init__(self, model: Model) -> None:
        self.model = model
        self._forget()

    def _forget(self) -> None:
        self.words = WordRows()
        width = FILTERS * sum(WIDTHS)
        self.responses = np.zeros((1024, width), np.float32)
        self.language = np.zeros((1024, len(LANGUAGES)), np.int32)
        self.filled = 1

    def raw(self, texts: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        """Logits and languages."""
        if not texts:
            return np.empty(0), np.empty(0, np.int64)
        if len(self.words) > CACHED_WORDS:
            self._forget()
        coded = [self.words.of(t) for t in texts]
        fresh = np.array(self.words.rows, np.int64).reshape(-1, 4)
        self.words.rows.clear()
        need = self.filled + len(fresh)
        if need > len(self.responses):
            grown = max(need, 2 * len(self.responses)) - len(self.responses)
            self.responses = np.concatenate([self.responses, np.zeros((grown, self.responses.shape[1]), np.float32)])
            self.language = np.concatenate([self.language, np.zeros((grown, len(LANGUAGES)), np.int32)])
        self.responses[self.filled:need] = self.model.projected(fresh[:, :3])
        spoken = np.flatnonzero(fresh[:, 3] < len(LANGUAGES))
        self.language[self.filled + spoken, fresh[spoken, 3]] = 1
        self.filled = need
        logit, votes = [], []
        at = 0
        while at < len(texts):  # a few hundred thousand words at once
            end, size = at, 0
            while end < len(texts) and (end == at or size + len(coded[end]) < 200_000):
                size += len(coded[end])
                end += 1
            ids, starts, ends = joined(coded[at:end])
            logit.append(self.model.logits(self.model.pooled(self.responses[ids], starts, ends)))
            votes.append(np.add.reduceat(self.language[ids], starts, axis=0))
            at = end
        votes = np.concatenate(votes)
        return np.concatenate(logit), np.where(votes.any(1), votes.argmax(1), len(LANGUAGES))


def held_out(doc_id: Column) -> Column:
    """True for rows whose labels are never learned from."""
    return F.coalesce(F.pmod(F.crc32(F.encode(doc_id.cast("string"), "UTF-8")), F.lit(FOLDS)) == 0, F.lit(False))


def usable(labels: DataFrame) -> DataFrame:
    """doc_id and toxic of the labels that may be learned from, once each."""
    known = labels.where("toxic IN (0, 1) AND doc_id IS NOT NULL").select(F.col("doc_id").cast("long"), F.col("toxic").cast("int"))
    return known.where(~held_out(F.col("doc_id"))).distinct()


def sample(docs: DataFrame, labels: DataFrame) -> tuple[list[bytes], np.ndarray]:
    """The labelled rows to fit on: of each label a bounded number, by a hash of doc_id, none held out."""
    known = usable(labels)
    picked = None
    for label, most in ((1, TOXIC_ROWS), (0, OTHER_ROWS)):
        part = known.where(F.col("toxic") == label).orderBy(F.xxhash64("doc_id"), "doc_id").limit(most)
        picked = part if picked is None else picked.unionAll(part)
    texts = docs.select(docs["doc_id"].cast("long").alias("doc_id"), docs["text"]).where(
        F.length("text").between(1, LONGEST))
    # At most TOXIC_ROWS + OTHER_ROWS ids are sent to the tasks, and as many texts come back; copies count once.
    rows = texts.join(F.broadcast(picked), "doc_id").select("doc_id", "toxic", "text").toPandas()
    rows = rows.sort_values(["doc_id", "toxic", "text"]).drop_duplicates("doc_id")
    rows = rows.drop_duplicates("text")
    return [t.encode("utf-8", "surrogatepass") for t in rows["text"]], rows["toxic"].to_numpy(np.int64)


def score_toxicity(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """doc_id, held_out, score (0 to 1) and predicted (1 from 0.5 on) of every whole text.

    A null text counts as empty; texts without words get the score of no filter responding. A null doc_id is not held
    out and not trained on. Repeated rows are scored each. labels: doc_id, toxic 0 or 1; other values are ignored.
    Without labels of both kinds every score is near 0. Columns beyond doc_id and text are not read.
    """
    texts, toxic = sample(docs, labels)
    model = train(texts, toxic)
    sent = docs.sparkSession.sparkContext.broadcast(model)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        scorer = Scorer(sent.value)
        for batch in small_batches(batches):
            logit, language = scorer.raw(as_bytes(batch.column(2)))
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(1), pa.array(logit, pa.float64()), pa.array(language.astype(np.int32))],
                names=["doc_id", "held_out", "logit", "language"])

    slim = docs.select(docs["doc_id"].cast("long").alias("doc_id"), docs["text"]).select("doc_id", held_out(F.col("doc_id")).alias("held_out"), "text")
    raw = stored(slim.mapInArrow(run, "doc_id long, held_out boolean, logit double, language int"), "logits")
    calibrate(model, raw, labels)
    shift = F.array(*(F.lit(float(x)) for x in model.shift))
    beyond = F.greatest(F.lit(-30.0), F.least(F.lit(30.0), F.col("logit") - F.get(shift, F.col("language"))))
    scored = raw.select("doc_id", "held_out", (1 / (1 + F.exp(-beyond))).alias("score"))
    return scored.select("*", F.when(F.col("score") >= 0.5, 1).otherwise(0).alias("predicted"))

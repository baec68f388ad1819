"""Graded quality by ordinal cumulative-link regression over hashed text."""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from namewright.llm.words import ALPHANUMERIC, buffers, mix, spans_hash, words
from namewright.sources.staging import stage

#: Runs of ASCII marks count as words of their own: tables, markup and shouting show in them.
MARKS = np.zeros(256, dtype=bool)
MARKS[0x21:0x7F] = True
MARKS &= ~ALPHANUMERIC

#: Bytes of the word beginnings that are features besides the words.
PREFIXES = (5, 8)
#: A text of n features scales them by n to this power: signs of a bad text count nearly as much in a long one.
POWER = 0.25


@dataclass(frozen=True)
class Settings:
    buckets: int = 1 << 18
    #: Labelled rows that are fitted at most, the lowest by hash; the bound of what the driver holds.
    sample: int = 12_000
    epochs: int = 20
    rate: float = 0.5
    decay: float = 1e-5
    #: Standard errors by which a feature must tell good texts from others; else it would only learn its documents by heart.
    telling: float = 2.5
    batch: int = 32
    seed: int = 5
    #: Share of the best-graded held-out documents that the selection must keep; its probability never needs to exceed ``cap``.
    keep: float = 0.995
    cap: float = 0.9


@dataclass
class Ordinal:
    """P(grade <= k) = logistic(cuts[k] - weights . features), one weight vector for all grades."""

    weights: np.ndarray
    cuts: np.ndarray
    #: Buckets that the fit knows; the others are no features.
    seen: np.ndarray
    threshold: float = 0.5

    def tail(self, scores: np.ndarray) -> np.ndarray:
        """P(grade > k) for every k but the last."""
        return 1 / (1 + np.exp(-np.clip(scores[:, None] - self.cuts[None, :], -60, 60)))


def text_features(column: pa.Array, buckets: int) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """(first row, row, bucket) of the distinct features of each row, sorted by row; whole texts."""
    offsets, data = buffers(column)
    marks = words(column, MARKS)
    for part in words(column):
        mark = next(marks)
        rows = [np.repeat(np.arange(len(p.counts)), p.counts) for p in (part, mark)]
        codes = [part.hashes, mix(mark.hashes + np.uint64(1))]
        places = offsets[part.first + rows[0]]
        for step, size in enumerate(PREFIXES):
            longer = part.ends - part.starts > size
            begin = places[longer] + part.starts[longer]
            codes.append(mix(spans_hash(data, begin, begin + size) + np.uint64(2 + step)))
            rows.append(rows[0][longer])
        row = np.concatenate(rows).astype(np.uint64)
        bucket = np.concatenate(codes) % np.uint64(buckets)
        keys = np.unique(row * np.uint64(buckets) + bucket)
        yield part.first, (keys // np.uint64(buckets)).astype(np.int64), (keys % np.uint64(buckets)).astype(np.int64)


def quality_classifier(
    documents: DataFrame,
    ratings: DataFrame,
    settings: Settings = Settings(),
    id_column: str = "doc_id",
    text_column: str = "text",
) -> DataFrame:
    """Grades all documents by a model of the rated ones; one row per input row.

    ``ratings`` has (id, grade), grades 0, 1, ... from worst to best. Columns: id, expected_grade, tail_probability (of the best grade) and
    kept. The features of a text are its distinct words, word beginnings and runs of marks, hashed to buckets and scaled to length 1. The model is a
    cumulative-link regression: one weight per bucket for all grades, and ordered thresholds between them. It is fitted in the driver on at
    most ``settings.sample`` rated rows, the lowest by hash. A fifth of them is held out and sets the selection: a document is kept if the
    probability of the best grade reaches the value that keeps ``settings.keep`` of the held-out best ones, at most ``cap``.

    Scoring is one parallel pass; the model is a fixed 1 MB array. Null and empty texts have no features: the thresholds alone grade them.
    Ratings that are null or without a document are ignored; of several for one id all count. With no ratings, or of one grade only, nothing is learned: expected grade and
    probability are null and every document is kept. Repeated rows are graded alike.
    """
    model = fit(*_sample(documents, ratings, settings, id_column, text_column), settings)
    rows = documents.select(F.col(id_column).cast("long").alias("_id"), F.col(text_column).cast("string").alias("_text"))
    scored = rows.mapInArrow(
        lambda batches: _score(batches, model, settings), "_id long, expected_grade double, tail_probability double, kept boolean"
    )
    return scored.withColumnRenamed("_id", id_column)


def select_quality(
    documents: DataFrame,
    ratings: DataFrame,
    settings: Settings = Settings(),
    id_column: str = "doc_id",
    text_column: str = "text",
) -> DataFrame:
    """The documents, all columns, that ``quality_classifier`` keeps; decided where the row lies, without a join."""
    model = fit(*_sample(documents, ratings, settings, id_column, text_column), settings)

    def keep(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            text = batch.column(text_column)
            yield batch.filter(pa.array(_judge(text, model, settings)[2]))

    return documents.mapInArrow(keep, documents.schema)


def _sample(
    documents: DataFrame, ratings: DataFrame, settings: Settings, id_column: str, text_column: str
) -> tuple[list[np.ndarray], np.ndarray]:
    order = F.xxhash64("_rated")
    rated = (
        ratings.select(F.col(id_column).cast("long").alias("_rated"), F.col("grade").cast("int").alias("grade"))
        .where("_rated IS NOT NULL AND grade >= 0").orderBy(order, "grade").limit(settings.sample)
    )
    # At most ``sample`` rows of two numbers.
    joined = documents.select(F.col(id_column).cast("long").alias("_id"), F.col(text_column).cast("string").alias("_text")).join(
        F.broadcast(rated), F.col("_id") == F.col("_rated")
    )
    features = stage(
        joined.select("_id", "grade", "_text").mapInArrow(
            lambda batches: _features(batches, settings), "_id long, grade int, features array<int>"
        ),
        "rated-features",
    )
    order = F.xxhash64("_id", "grade", "features")
    picked = features.orderBy(order, "_id").limit(settings.sample).select("grade", "features").toArrow()
    lists = picked["features"].combine_chunks()
    if not len(lists):
        return [], np.zeros(0, dtype=np.int64)
    values, cuts = lists.flatten().to_numpy(), np.cumsum(pa.compute.list_value_length(lists).to_numpy())
    return np.split(values, cuts[:-1]), picked["grade"].to_numpy().astype(np.int64)


def _features(batches: Iterator[pa.RecordBatch], settings: Settings) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        found: list = [[] for _ in range(len(batch))]
        for first, row, bucket in text_features(batch.column("_text"), settings.buckets):
            rows, begins = np.unique(row, return_index=True)
            for at, part in zip(rows, np.split(bucket, begins[1:]), strict=True) if len(rows) else ():
                found[first + at] = part
        yield pa.RecordBatch.from_arrays(
            [batch.column("_id"), batch.column("grade"), pa.array(found, pa.list_(pa.int32()))], names=["_id", "grade", "features"]
        )


def _judge(text: pa.Array, model: Ordinal | None, settings: Settings) -> tuple[np.ndarray | None, np.ndarray | None, np.ndarray]:
    """Expected grade, probability of the best grade, and whether kept."""
    if model is None:
        return None, None, np.ones(len(text), dtype=bool)
    scores = np.zeros(len(text))
    for first, row, bucket in text_features(text, settings.buckets):
        if not len(row):
            continue
        row, bucket = row[model.seen[bucket]], bucket[model.seen[bucket]]
        counts = np.bincount(row)
        total = np.bincount(row, weights=model.weights[bucket])
        scores[first : first + len(total)] = total * np.maximum(counts, 1.0) ** -POWER
    tail = model.tail(scores)
    return tail.sum(axis=1), tail[:, -1], tail[:, -1] >= model.threshold


def _score(batches: Iterator[pa.RecordBatch], model: Ordinal | None, settings: Settings) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        grade, tail, kept = _judge(batch.column("_text"), model, settings)
        none = pa.nulls(len(batch), pa.float64())
        yield pa.RecordBatch.from_arrays(
            [batch.column("_id"), none if grade is None else pa.array(grade), none if tail is None else pa.array(tail), pa.array(kept)],
            names=["_id", "expected_grade", "tail_probability", "kept"],
        )


# Fitting

def fit(features: list[np.ndarray], grades: np.ndarray, settings: Settings) -> Ordinal | None:
    """Stochastic ascent of the log likelihood of four fifths; the rest sets the selection threshold."""
    if len(np.unique(grades)) < 2:
        return None
    draw = np.random.default_rng(settings.seed)
    order = draw.permutation(len(grades))
    held, used = order[: len(order) // 5], order[len(order) // 5 :]
    levels = int(grades.max()) + 1
    value = _values([features[i] for i in used], grades[used], levels, settings)
    seen = value > 0
    features = [f[seen[f]] for f in features]
    model = Ordinal(np.zeros(settings.buckets), _first_cuts(grades, levels), seen)
    for epoch in range(settings.epochs):
        draw.shuffle(used)
        rate = settings.rate / (1 + epoch / 4)
        for start in range(0, len(used), settings.batch):
            batch = used[start : start + settings.batch]
            row, bucket, scale, scores = _scores(model, [features[i] for i in batch], value)
            score_gradient, cut_gradient = likelihood_gradient(scores, model.cuts, grades[batch])
            touched, place = np.unique(bucket, return_inverse=True)
            gradient = np.bincount(place, weights=(score_gradient * scale)[row] * value[bucket], minlength=len(touched)) / len(batch)
            # Plain steps: scaling each weight's step by its own history would undo what telling features count.
            model.weights[touched] += rate * (gradient - settings.decay * model.weights[touched])
            model.cuts += rate * cut_gradient / len(batch)
            for k in range(1, levels - 1):  # the thresholds stay in order
                model.cuts[k] = max(model.cuts[k], model.cuts[k - 1] + 1e-3)
    best = [features[i] for i in held if grades[i] == levels - 1]
    if best:
        tail = model.tail(_scores(model, best, value)[3])[:, -1]
        model.threshold = float(min(np.quantile(tail, 1 - settings.keep), settings.cap))
    model.weights = (model.weights * value).astype(np.float32)
    return model


def _first_cuts(grades: np.ndarray, levels: int) -> np.ndarray:
    share = (np.cumsum(np.bincount(grades, minlength=levels))[:-1] + 0.5) / (len(grades) + 1)
    return np.log(share / (1 - share)) + 1e-3 * np.arange(levels - 1)


def _values(features: list[np.ndarray], grades: np.ndarray, levels: int, settings: Settings) -> np.ndarray:
    """What the presence of a bucket counts: how far its share of the best grade is from its share of the others, as the
    absolute log ratio (Wang and Manning 2012) less ``telling`` standard errors; 0 where that leaves nothing."""
    counts = np.zeros((2, settings.buckets))
    sizes = np.zeros(2)
    for found, grade in zip(features, grades, strict=True):
        counts[int(grade == levels - 1), found] += 1
        sizes[int(grade == levels - 1)] += 1
    shares = (counts + 1) / (sizes[:, None] + 2)
    spread = np.sqrt((1 / (counts + 1)).sum(axis=0))
    return np.maximum(np.abs(np.log(shares[1] / shares[0])) - settings.telling * spread, 0.0)


def _scores(model: Ordinal, features: list[np.ndarray], value: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    sizes = np.array([len(f) for f in features])
    row = np.repeat(np.arange(len(features)), sizes)
    bucket = np.concatenate(features)
    scale = np.maximum(sizes, 1.0) ** -POWER
    return row, bucket, scale, np.bincount(row, weights=(model.weights * value)[bucket], minlength=len(features)) * scale


def likelihood_gradient(scores: np.ndarray, cuts: np.ndarray, grades: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Gradients of the log likelihood by each score and, summed, by each cut."""
    edges = np.concatenate([[-60.0], cuts, [60.0]])
    below = 1 / (1 + np.exp(np.clip(scores - edges[grades], -60, 60)))
    above = 1 / (1 + np.exp(np.clip(scores - edges[grades + 1], -60, 60)))
    likelihood = np.maximum(above - below, 1e-12)
    slope_below, slope_above = below * (1 - below), above * (1 - above)
    by_score = (slope_below - slope_above) / likelihood
    by_edge = np.bincount(grades + 1, weights=slope_above / likelihood, minlength=len(edges))
    by_edge -= np.bincount(grades, weights=slope_below / likelihood, minlength=len(edges))
    return by_score, by_edge[1:-1]

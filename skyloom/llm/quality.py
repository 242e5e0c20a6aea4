"""Quality of texts by naive Bayes support vectors: n-gram indicators, scaled by log-count ratios, in a linear hinge model."""

from collections.abc import Iterable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from skyloom.llm.common import slices
from skyloom.llm.words import lowered, mix, span_hashes, text_bytes, word_spans

BITS = 18
TRAIN_ROWS = 12_000
TRAIN_FEATURES = 1 << 25
FEATURES = np.uint64((1 << BITS) - 1)


def held_out(doc_id: Column) -> Column:
    """Rows never learnt from: crc32 of the id as text leaves 0 when divided by 5."""
    return F.coalesce(F.crc32(doc_id.cast("string")) % 5 == 0, F.lit(False))


def shapes(data: np.ndarray, starts: np.ndarray, stops: np.ndarray, hashes: np.ndarray, first: np.ndarray) -> np.ndarray:
    """What a word looks like, whatever it says: case, digits, the sign it ends with, length, and whether it repeats."""

    def count(mask: np.ndarray) -> np.ndarray:
        upto = np.concatenate([[0], np.cumsum(mask)])
        return upto[stops] - upto[starts]

    length = stops - starts
    upper = count((data >= 65) & (data <= 90))
    lower = count((data >= 97) & (data <= 122))
    digits = count((data >= 48) & (data <= 57))
    signs = length - upper - lower - digits - count(data >= 128)
    last = data[stops - 1] if len(stops) else np.empty(0, np.uint8)
    end = np.where((last < 128) & ~((last >= 65) & (last <= 90)) & ~((last >= 97) & (last <= 122)) & ~((last >= 48) & (last <= 57)), last, 0)
    case = np.where(upper > 1, 2 + (lower == 0), (upper == 1).astype(np.int64))
    again = np.zeros(len(hashes), np.int64)
    again[1:] = hashes[1:] == hashes[:-1]
    again[first[:-1][first[:-1] < len(hashes)]] = 0
    long = np.searchsorted([3, 8, 16, 30], length)
    code = ((((case * 3 + np.minimum(digits, 2)) * 4 + np.minimum(signs, 3)) * 5 + long) * 2 + again) * 256 + end
    return mix(code.astype(np.uint64) + np.uint64(1))


def indicators(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The hashed n-grams of each text, each once, and where each text's begin.

    n-grams are single words and pairs of words in lower case, and runs of one to three word shapes.
    """
    data, at = text_bytes(texts)
    starts, stops, first = word_spans(data, at)
    words = span_hashes(lowered(data), starts, stops)
    looks = shapes(data, starts, stops, words, first)
    text = np.repeat(np.arange(len(first) - 1), np.diff(first))
    found, owners = [mix(words + np.uint64(1)), mix(looks + np.uint64(2))], [text, text]
    same = text[1:] == text[:-1]
    found += [mix(words[:-1] * np.uint64(3) + words[1:])[same], mix(looks[:-1] * np.uint64(5) + looks[1:])[same]]
    owners += [text[1:][same]] * 2
    both = same[1:] & same[:-1]
    found.append(mix(looks[:-2] * np.uint64(25) + looks[1:-1] * np.uint64(7) + looks[2:])[both])
    owners.append(text[2:][both])
    value = (np.concatenate(found) & FEATURES).astype(np.int64)
    pair = np.unique((np.concatenate(owners).astype(np.int64) << BITS) | value)
    return pair & int(FEATURES), np.searchsorted(pair >> BITS, np.arange(len(first)))


@dataclass
class Model:
    """Weights of n-grams and what turns a margin into a score."""

    weights: np.ndarray
    bias: float
    slope: float
    shift: float

    def score(self, features: np.ndarray, where: np.ndarray) -> np.ndarray:
        upto = np.concatenate([[0.0], np.cumsum(self.weights[features])])
        margin = upto[where[1:]] - upto[where[:-1]] + self.bias
        return 1 / (1 + np.exp(-np.clip(self.slope * margin + self.shift, -40, 40)))


def descend(
    features: np.ndarray, where: np.ndarray, learn: np.ndarray, signs: np.ndarray, ratio: np.ndarray, cost: float, rounds: int, seed: int, close: float
) -> tuple[np.ndarray, float]:
    """Dual coordinate descent for the linear hinge loss over indicators scaled by ``ratio``; the bias is a feature of 1.

    Text ``i`` has the features ``where[i]`` to ``where[i + 1]``; those of ``learn`` are learnt from.
    """
    values = ratio.astype(np.float32)[features]
    bounds = list(zip(where[learn].tolist(), where[learn + 1].tolist(), strict=True))
    squares = [float(values[a:b] @ values[a:b]) + 1.0 for a, b in bounds]
    alpha, weights, bias = np.zeros(len(learn)), np.zeros(len(ratio)), 0.0
    shuffled = np.random.default_rng(seed)
    for _ in range(rounds):
        worst = 0.0  # how far any text is from its optimum
        for i in shuffled.permutation(len(learn)).tolist():
            a, b = bounds[i]
            row, value, sign = features[a:b], values[a:b], signs[i]
            slope = sign * (float(weights[row] @ value) + bias) - 1
            new = min(max(alpha[i] - slope / squares[i], 0.0), cost)
            worst = max(worst, abs(new - alpha[i]) * squares[i])
            if new != alpha[i]:
                step = (new - alpha[i]) * sign
                weights[row] += step * value
                bias += step
                alpha[i] = new
        if worst < close:
            break
    return weights * ratio, bias


def calibrated(margin: np.ndarray, good: np.ndarray, rounds: int = 100) -> tuple[float, float]:
    """Slope and shift of the logistic curve through margins of rows that were not learnt from, by Newton steps."""
    ones, zeros = int(good.sum()), int((~good).sum())
    aim = np.where(good, (ones + 1) / (ones + 2), 1 / (zeros + 2))
    scale = float(np.abs(margin).mean()) or 1.0
    x = np.stack([margin / scale, np.ones(len(margin))], axis=1)
    beta = np.array([1.0, 0.0])
    for _ in range(rounds):
        p = 1 / (1 + np.exp(-np.clip(x @ beta, -40, 40)))
        grade = x.T @ (p - aim) + 1e-3 * beta
        bend = (x * (p * (1 - p))[:, None]).T @ x + 1e-3 * np.eye(2)
        step = np.linalg.solve(bend, grade)
        beta -= np.clip(step, -1, 1)
        if np.abs(step).max() < 1e-9:
            break
    return float(beta[0]) / scale, float(beta[1])


def fit(
    texts: Iterable[tuple[np.ndarray, bool]], cost: float = 1.0, smooth: float = 1.0, rounds: int = 20, seed: int = 7,
    most: int = TRAIN_FEATURES, close: float = 1e-2,
) -> Model:
    """Learn from the n-grams of texts and whether each is good, as far as ``most`` n-grams reach.

    One text in five is kept from the descent and only calibrates the scores.  With one class or no texts the score
    is the share of good texts, with one added to both.
    """
    size, found, where, good = 1 << BITS, [], [0], []
    for row, mark in texts:
        if where[-1] + len(row) > most:
            break
        found.append(row)
        where.append(where[-1] + len(row))
        good.append(mark)
    features = np.concatenate([*found, np.zeros(0, np.int32)])
    del found
    where, good = np.array(where), np.array(good, bool)
    prior = (good.sum() + 1) / (len(good) + 2)
    flat = Model(np.zeros(size), 0.0, 0.0, float(np.log(prior / (1 - prior))))
    part = np.arange(len(good)) % 5 == 4
    learn = np.flatnonzero(~part)
    if min(good[learn].sum(), (~good[learn]).sum()) == 0 or not part.any():
        return flat
    counts = {True: np.full(size, smooth), False: np.full(size, smooth)}
    for i in learn.tolist():
        counts[bool(good[i])][features[where[i] : where[i + 1]]] += 1  # a text has each feature once
    ratio = np.log(counts[True] / counts[True].sum()) - np.log(counts[False] / counts[False].sum())
    weights, bias = descend(features, where, learn, np.where(good[learn], 1.0, -1.0), ratio, cost, rounds, seed, close)
    margin = np.array([weights[features[where[i] : where[i + 1]]].sum() + bias for i in np.flatnonzero(part)])
    slope, shift = calibrated(margin, good[part])
    return Model(weights, bias, slope, shift) if slope > 0 else flat


def training_rows(docs: DataFrame, labels: DataFrame, most: int = TRAIN_ROWS) -> DataFrame:
    """Texts with their label, of at most ``most`` labelled ids that are not held out, those with the smallest hashes.

    The ids are at most ``most``, so they are broadcast and the texts need no shuffle.
    """
    usable = labels.where(F.col("doc_id").isNotNull() & F.col("quality").isin(0, 1) & ~held_out(F.col("doc_id")))
    order = F.xxhash64("doc_id")
    chosen = usable.groupBy("doc_id").agg(F.max("quality").alias("_quality")).orderBy(order, "doc_id").limit(most)
    return docs.select("doc_id", "text").join(F.broadcast(chosen), "doc_id").select("doc_id", "text", "_quality")


def _features(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for part in slices(batch, "text"):
            features, at = indicators(part.column("text"))
            rows = [features[a:b].astype("<i4").tobytes() for a, b in zip(at[:-1].tolist(), at[1:].tolist(), strict=True)]
            yield pa.RecordBatch.from_arrays(
                [*[part.column(c) for c in ("doc_id", "said", "_quality")], pa.array(rows, pa.binary())], ["doc_id", "said", "_quality", "features"]
            )


def train(docs: DataFrame, labels: DataFrame, most: int = TRAIN_ROWS, most_features: int = TRAIN_FEATURES) -> Model:
    """Fit on a bounded sample: ``most`` ids, and of those with the smallest hashes as many as have ``most_features`` n-grams together.

    The n-grams are found where the texts lie, and only their numbers reach the one task that fits, each as four bytes.  Of an id
    that repeats, the text with the smallest hash is learnt from.  The driver sees the model only, a fixed number of weights.
    """

    def learn(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def texts() -> Iterator[tuple[np.ndarray, bool]]:
            for batch in batches:
                for features, quality in zip(batch.column("features"), batch.column("_quality").to_pylist(), strict=True):
                    yield np.frombuffer(features.as_py(), "<i4"), quality == 1

        model = fit(texts(), most=most_features)
        numbers = [pa.array([x], pa.float64()) for x in (model.bias, model.slope, model.shift)]
        yield pa.RecordBatch.from_arrays([pa.array([model.weights.tobytes()], pa.binary()), *numbers], names=["weights", "bias", "slope", "shift"])

    chosen = training_rows(docs, labels, most)
    kind = chosen.schema["doc_id"].dataType.simpleString()
    texts = chosen.select("doc_id", F.xxhash64("text").alias("said"), F.col("_quality").cast("int").alias("_quality"), "text")
    found = texts.mapInArrow(_features, f"doc_id {kind}, said long, _quality int, features binary")
    once = found.groupBy("doc_id").agg(F.min(F.struct("said", "features", "_quality")).alias("t")).select("doc_id", "t.*")
    # at most ``most`` rows; a sort, unlike a limit in order, goes to disk where memory is short
    sample = once.repartition(1).sortWithinPartitions(F.xxhash64("doc_id"), "doc_id").select("features", "_quality")
    rows = sample.mapInArrow(learn, "weights binary, bias double, slope double, shift double").collect()
    if not rows:
        return fit([])
    return Model(np.frombuffer(rows[0].weights), rows[0].bias, rows[0].slope, rows[0].shift)


def score(docs: DataFrame, model: Model) -> DataFrame:
    """Add ``score`` to doc_id and text; only the weights travel, a fixed number of them."""

    def scored(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch, "text"):
                value = model.score(*indicators(part.column("text")))
                yield pa.RecordBatch.from_arrays([part.column("row"), pa.array(value)], names=["row", "score"])

    row = F.struct(*[F.col(f"`{c}`") for c in docs.columns])
    rows = docs.select(row.alias("row"), F.col("text").cast("string").alias("text"))
    return rows.mapInArrow(scored, T.StructType().add("row", docs.schema).add("score", T.DoubleType()))


def classify(docs: DataFrame, labels: DataFrame, threshold: float = 0.3, most: int = TRAIN_ROWS) -> DataFrame:
    """Score every row of ``docs`` (doc_id, text) by what ``labels`` (doc_id, quality) says of some.

    Returns doc_id, held_out, score (0 to 1, higher where the text is more likely good) and predicted (1 from
    ``threshold``).  A null or empty text has no n-grams and gets the score of the bias; a null doc_id is not
    held out and never learnt from; ids that are labelled twice count as good if one label says so; with no usable
    labels every text gets the same score; an empty table gives an empty one; other columns are not looked at.
    """
    scored = score(docs.select("doc_id", "text"), train(docs, labels, most))
    held = held_out(F.col("row.doc_id"))
    return scored.select("row.doc_id", held.alias("held_out"), "score", (F.col("score") >= threshold).cast("int").alias("predicted"))


def good_rows(docs: DataFrame, labels: DataFrame, threshold: float = 0.3, most: int = TRAIN_ROWS) -> DataFrame:
    """The rows of ``docs`` that are not rejected."""
    return score(docs, train(docs, labels, most)).where(F.col("score") >= threshold).select("row.*")

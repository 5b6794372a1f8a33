"""Language identification: multinomial logistic regression on TF-IDF character n-grams.

Document frequencies are counted over all learnable rows. The weights are learned by follow-the-regularised-leader with
L1 and L2 penalties on a bounded sample, spread evenly over the languages, and divided by a temperature that a held-back
part of the sample calibrates. Whole texts are read, in learning and in predicting.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tabloom.llm.common import claim, on_executors, sliced
from tabloom.session import scratch_path

ORDERS = (1, 2, 3)
DIMENSIONS = 1 << 15
#: Different texts to learn from, at most; shared evenly by the languages.
SAMPLE = 4_000
UNDETERMINED = "und"
_OTHER = re.compile(r"[\W\d_]+")
_STEP = np.uint64(0x9E3779B97F4A7C15)
_MULTIPLY = np.uint64(0xBF58476D1CE4E5B9)


def gram_counts(text: str, dimensions: int = DIMENSIONS) -> np.ndarray:
    """How often each hashed n-gram of letters and word ends occurs in the whole text."""
    plain = _OTHER.sub(" ", f" {text.lower()} ")
    codes = np.frombuffer(plain.encode("utf-32-le", "surrogatepass"), "<u4").astype(np.uint64)
    hashed, rolled = [], np.zeros(len(codes), np.uint64)
    for order in range(1, max(ORDERS) + 1):
        if len(codes) < order:
            break
        rolled = (rolled[: len(codes) - order + 1] + codes[order - 1:] + np.uint64(order)) * _STEP
        rolled ^= rolled >> np.uint64(29)
        if order in ORDERS:
            hashed.append(((rolled * _MULTIPLY) >> np.uint64(40)).astype(np.int64) % dimensions)
    return np.bincount(np.concatenate(hashed), minlength=dimensions) if hashed else np.zeros(dimensions, np.int64)


def tf_idf(text: str, idf: np.ndarray) -> np.ndarray:
    x = np.log1p(gram_counts(text, len(idf))) * idf
    norm = np.sqrt(x @ x)
    return x / norm if norm > 0 else x


@dataclass
class Model:
    """Weights (n-grams and a bias by languages), already divided by the temperature; ``languages`` in order."""

    languages: list[str]
    idf: np.ndarray
    weights: np.ndarray
    temperature: float
    rows: dict[str, int] = field(default_factory=dict)

    def probabilities(self, text: str) -> np.ndarray:
        return softmax(tf_idf(text, self.idf) @ self.weights[:-1] + self.weights[-1])


def softmax(logits: np.ndarray) -> np.ndarray:
    e = np.exp(logits - logits.max(axis=-1, keepdims=True))
    return e / e.sum(axis=-1, keepdims=True)


def ftrl(rows: list[tuple[np.ndarray, np.ndarray, int]], size: int, classes: int, alpha: float = 0.5, beta: float = 1.0,
         l1: float = 0.02, l2: float = 0.02, epochs: int = 3) -> np.ndarray:
    """Weights (size + 1, classes); the last row is the bias. Each row: indices, values, class."""
    z, n = np.zeros((size + 1, classes)), np.zeros((size + 1, classes))
    penalty = np.full(size + 1, l1)
    penalty[size] = 0.0  # the bias is free

    def weights(at) -> np.ndarray:
        zs = z[at]
        shrunk = np.sign(zs) * np.maximum(np.abs(zs) - penalty[at][:, None], 0.0)
        return -shrunk / ((beta + np.sqrt(n[at])) / alpha + l2)

    for _ in range(epochs):
        for at, values, label in rows:
            at, values = np.append(at, size), np.append(values, 1.0)
            w = weights(at)
            error = softmax(values @ w)
            error[label] -= 1.0
            g = values[:, None] * error
            more = n[at] + g * g
            z[at] += g - (np.sqrt(more) - np.sqrt(n[at])) / alpha * w
            n[at] = more
    return weights(np.arange(size + 1))


def temperature(logits: np.ndarray, labels: np.ndarray) -> float:
    """The divisor of the logits with the smallest log loss, by golden-section search on its logarithm.

    The right language counts as (rows + 1) / (rows + 2) likely, so that faultless rows do not ask for certainty.
    """
    if len(labels) == 0 or logits.shape[1] < 2:
        return 1.0
    doubt = 1.0 / (len(labels) + 2)
    aims = np.full(logits.shape, doubt / (logits.shape[1] - 1))
    aims[np.arange(len(labels)), labels] = 1 - doubt

    def loss(log_t: float) -> float:
        return -(aims * np.log(np.maximum(softmax(logits / np.exp(log_t)), 1e-300))).sum(axis=1).mean()

    low, high, ratio = -3.0, 3.0, (5**0.5 - 1) / 2
    for _ in range(40):
        a, b = high - ratio * (high - low), low + ratio * (high - low)
        low, high = (low, b) if loss(a) <= loss(b) else (a, high)
    return float(np.exp((low + high) / 2))


def _document_frequencies(rows: DataFrame, dimensions: int) -> np.ndarray:
    """log((1 + rows) / (1 + rows with the n-gram)) + 1. Each task sends one count per n-gram."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen = np.zeros(dimensions + 1, np.int64)
        claim("language", lambda: None)
        for batch in sliced(batches):
            for text in batch.column(0).to_pylist():
                seen[:-1] += gram_counts(text, dimensions) > 0
                seen[-1] += 1
        at = np.flatnonzero(seen)
        yield pa.RecordBatch.from_arrays([pa.array(at, pa.int32()), pa.array(seen[at], pa.int64())], ["at", "n"])

    found = on_executors(rows.select("text"), count, "at int, n bigint").groupBy("at").agg(F.sum("n").alias("n")).toPandas()
    seen = np.zeros(dimensions + 1)
    seen[found["at"].to_numpy(np.int64)] = found["n"].to_numpy(np.float64)
    return np.log((1 + seen[-1]) / (1 + seen[:-1])) + 1


def drawn(rows: DataFrame, texts: dict[str, int], each: int, seed: int) -> DataFrame:
    """(label, text, draw) of rows (label, text): different texts, some more than ``each`` of a language that has so many.

    A text comes in by a hash of itself, so reruns agree, and once per label however many copies it has.
    """
    least = each + 4 * each**0.5  # a draw of this mean falls short of ``each`` in one of 30,000
    at = F.pmod(F.xxhash64("text", F.lit(seed)), F.lit(1 << 30)) / float(1 << 30)
    share = F.element_at(F.create_map(*[x for name, n in texts.items() for x in (F.lit(name), F.lit(min(1.0, least / n)))]), F.col("label"))
    keyed = rows.where(at < share).withColumn("draw", F.xxhash64("text", F.lit(seed + 1)))
    return keyed.groupBy("label", "draw").agg(F.min("text").alias("text")).select("label", "text", "draw")


def fit(learnable: DataFrame, label: str = "lang", sample: int = SAMPLE, dimensions: int = DIMENSIONS, seed: int = 11) -> Model:
    """Learn from the rows with text and label: from ``sample`` different texts at most, as many of each language.

    A fifth of them is held back for the temperature by a hash of the text; a language's first text is learned from.
    Only one number per n-gram, one row per language and the finished weights come to the driver; the sample goes to one
    task, as sparse vectors. Without a learnable row the model knows no language.
    """
    spark = learnable.sparkSession
    rows = learnable.where(F.col(label).isNotNull() & F.col("text").isNotNull()).select(F.col(label).cast("string").alias("label"), "text")
    of_text = rows.groupBy("label", F.xxhash64("text").alias("t")).agg(F.count("*").alias("n"))
    counted = of_text.groupBy("label").agg(F.sum("n").alias("n"), F.count("*").alias("texts")).collect()
    counts = {r["label"]: r["n"] for r in counted}
    if not counts:
        return Model([], np.zeros(dimensions), np.zeros((dimensions + 1, 0)), 1.0)
    idf = _document_frequencies(rows, dimensions)
    languages = sorted(counts)
    index = {name: i for i, name in enumerate(languages)}
    each = max(1, sample // len(languages))
    shared = spark.sparkContext.broadcast(idf)
    chosen = drawn(rows, {r["label"]: r["texts"] for r in counted}, each, seed)

    def vectors(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in sliced(batches):
            out = []
            for name, text, order in zip(*[batch.column(n).to_pylist() for n in ("label", "text", "draw")]):
                x = tf_idf(text, shared.value)
                at = np.flatnonzero(x)
                out.append((index[name], order, at.astype("<i4").tobytes(), x[at].astype("<f4").tobytes()))
            if out:
                kinds = (pa.int32(), pa.int64(), pa.binary(), pa.binary())
                yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*out), kinds)], ["label", "draw", "at", "x"])

    def learn(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table = [r for b in batches for r in zip(*[b.column(n).to_pylist() for n in ("draw", "label", "at", "x")])]
        table.sort()
        of_label: list[list] = [[] for _ in languages]
        for r in table:
            if len(of_label[r[1]]) < each:
                of_label[r[1]].append(r)
        first = {own[0][0] for own in of_label if own}
        read = [(np.frombuffer(at, "<i4").astype(np.int64), np.frombuffer(x, "<f4").astype(np.float64), y, draw % 5 == 4 and draw not in first)
                for draw, y, at, x in sorted(r for own in of_label for r in own)]
        back = [r[:3] for r in read if r[3]]
        weights = ftrl([r[:3] for r in read if not r[3]], dimensions, len(languages))
        logits = np.array([x @ weights[at] + weights[-1] for at, x, _ in back]).reshape(-1, len(languages))
        t = temperature(logits, np.array([y for _, _, y in back], np.int64))
        at, cls = np.nonzero(weights)
        yield pa.RecordBatch.from_arrays(
            [pa.array([*at, -1], pa.int32()), pa.array([*cls, 0], pa.int32()), pa.array([*weights[at, cls], t], pa.float64())], ["at", "cls", "weight"],
        )

    path = scratch_path(spark, "language-model")
    sparse = on_executors(chosen, vectors, "label int, draw bigint, at binary, x binary")
    sparse.repartition(1).mapInArrow(learn, "at int, cls int, weight double").write.parquet(path)
    learned = spark.read.parquet(path).toPandas()
    t = float(learned.loc[learned["at"] < 0, "weight"].iloc[0])
    learned = learned[learned["at"] >= 0]
    weights = np.zeros((dimensions + 1, len(languages)))
    weights[learned["at"].to_numpy(), learned["cls"].to_numpy()] = learned["weight"].to_numpy() / t
    return Model(languages, idf, weights, t, counts)


def predict(docs: DataFrame, model: Model) -> DataFrame:
    """``docs`` with ``lang_pred`` and ``score``, the probability of that language; equal ones go to the first by name.

    A text that is null or has no letter is ``und`` with score 0; so is every text if the model knows no language.
    Columns of these names are replaced. Rows are independent of each other.
    """
    spark = docs.sparkSession
    shared = spark.sparkContext.broadcast(model)
    base = docs.drop("lang_pred", "score").withColumn("_letters", F.coalesce(F.col("text").rlike(r"\p{L}"), F.lit(False)))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = shared.value
        claim("language", lambda: None)
        for batch in sliced(batches):
            names, scores = [], []
            for text, letters in zip(batch.column("text").to_pylist(), batch.column("_letters").to_pylist()):
                if letters and known.languages:
                    p = known.probabilities(text)
                    best = int(p.argmax())
                    names.append(known.languages[best])
                    scores.append(float(p[best]))
                else:
                    names.append(UNDETERMINED)
                    scores.append(0.0)
            keep = [n for n in batch.schema.names if n != "_letters"]
            yield pa.RecordBatch.from_arrays(
                [*[batch.column(n) for n in keep], pa.array(names, pa.string()), pa.array(scores, pa.float64())], [*keep, "lang_pred", "score"],
            )

    kept = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in base.schema.fields if f.name != "_letters")
    return on_executors(base, run, f"{kept}, lang_pred string, score double")


def held_out(doc_id: Column | str) -> Column:
    """A fixed quarter of the documents, by key; null keys are not held out."""
    key = F.col(doc_id) if isinstance(doc_id, str) else doc_id
    return F.coalesce(F.crc32(key.cast("string")) % 4 == 2, F.lit(False))


def identify(docs: DataFrame, **settings) -> DataFrame:
    """Learn from the labelled rows that are not held out, predict all."""
    return predict(docs, fit(docs.where(~held_out("doc_id") & F.col("doc_id").isNotNull()), **settings))

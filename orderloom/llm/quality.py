"""Quality classifier: a factorisation machine over hashed words, structure and size.

score = sigmoid(b + w.x + 1/2 sum_f((V_f.x)^2 - V_f^2.x^2)): the pairwise interactions of all
features at low rank, in time linear in the features. Inputs come from the text alone: hashed
words, and structure statistics and sizes as one-hot bins of training quantiles.

The model is fitted on at most SAMPLE labelled rows, those first by a hash of the id; scoring
covers every row and whole texts. Defined results: a null text counts as empty, and a null id hashes as an empty one; rows without a
label, and those of the held-out part, are never learnt from; of several labels of one id the
greatest counts; without any labelled row every score is PRIOR.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from operator import eq
from zlib import crc32

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

# The most labelled rows that the model is fitted on.
SAMPLE = 12_000
HASHED = 4096
RANK = 8
BINS = 10
EPOCHS = 6
# Small samples are gone through more often, up to so many steps.
STEPS = 600
BATCH = 128
RATE = 0.05
DECAY = 1e-4
PRIOR = 0.5
THRESHOLD = 0.3

# Classes of bytes: other, lower, upper, digit, space, line end, sentence mark, other mark, non-ASCII.
_CLASS = np.array(
    [
        8 if b >= 128 else 1 if 97 <= b <= 122 else 2 if 65 <= b <= 90 else 3 if 48 <= b <= 57
        else 4 if b in b" \t" else 5 if b in b"\r\n" else 6 if b in b".,;:?!'\"-()" else 7 if b > 32 else 0
        for b in range(256)
    ],
    np.uint8,
)
STATS = 18


def held_out(id_col: str = "doc_id", parts: int = 5, part: int = 0) -> Column:
    name = F.coalesce(F.col(id_col).cast("string"), F.lit(""))
    return F.crc32(name.cast("binary")) % parts == part


def stats_of(text: str, raw: bytes, words: list[bytes]) -> list[float]:
    """Sizes and structure of a text, all finite; zeros for an empty one."""
    n, k = max(1, len(raw)), max(1, len(words))
    c = np.bincount(_CLASS[np.frombuffer(raw, np.uint8)], minlength=9) / n
    lines = [x for x in text.split("\n") if x.strip()]
    distinct = len(set(words))
    odd = sum([not (w[-1] >= 128 or 97 <= w[-1] <= 122 or w[-1] in b".,;:?") for w in words])
    return [
        np.log1p(len(text)), np.log1p(len(words)), len(raw) / k, distinct / k,
        sum(map(eq, words, words[1:])) / k, odd / k,
        *c[1:9].tolist(),
        np.log1p(len(lines)), len(set(lines)) / max(1, len(lines)),
        np.log1p(k / max(1, len(lines))), c[2] / max(1e-9, c[1] + c[2]),
    ]


def inputs(text: str | None, hashed: int) -> tuple[np.ndarray, np.ndarray, list[float]]:
    """Buckets of the hashed words, their values (a unit vector), and the statistics."""
    text = text or ""
    raw = text.encode("utf-8", "surrogatepass")
    words = raw.lower().split()
    counts = np.bincount(np.fromiter(map(crc32, words), np.int64, len(words)) % hashed, minlength=hashed)
    at = np.flatnonzero(counts)
    x = np.log1p(counts[at])
    return at, x / max(1e-12, float(np.sqrt(x @ x))), stats_of(text, raw, words)


@dataclass
class Model:
    """Bias, linear weights, factors and bin edges; features are hashed words, then bins."""

    bias: float
    linear: np.ndarray
    factors: np.ndarray
    edges: np.ndarray
    hashed: int

    def dense(self, rows: list[tuple]) -> np.ndarray:
        bins = self.edges.shape[1] + 1
        out = np.zeros((len(rows), self.hashed + STATS * bins), np.float32)
        for i, (at, x, stats) in enumerate(rows):
            out[i, at] = x
            places = (self.edges < np.asarray(stats)[:, None]).sum(axis=1)
            out[i, self.hashed + np.arange(STATS) * bins + places] = 1 / np.sqrt(STATS)
        return out

    def scores(self, rows: list[tuple]) -> np.ndarray:
        return 1 / (1 + np.exp(-np.clip(_margin(self.dense(rows), self.bias, self.linear, self.factors)[0], -30, 30)))


def _margin(x: np.ndarray, bias: float, linear: np.ndarray, factors: np.ndarray):
    """Margins by the sum-of-squares identity, and the factor sums."""
    sums = x @ factors
    squares = (x * x) @ (factors * factors)
    return bias + x @ linear + 0.5 * (sums * sums - squares).sum(axis=1), sums


def fit(rows: list[tuple], labels: np.ndarray, hashed: int, rank: int, epochs: int, seed: int) -> Model | None:
    """AdaGrad on the logistic loss, in a fixed order of batches."""
    if not rows or labels.min() == labels.max():
        return None
    rng = np.random.default_rng(seed)
    edges = np.quantile(np.array([r[2] for r in rows]), np.arange(1, BINS) / BINS, axis=0).T
    size = hashed + STATS * BINS
    m = Model(
        float(np.log(labels.mean() / (1 - labels.mean()))), np.zeros(size, np.float32),
        rng.normal(0, 0.05, (size, rank)).astype(np.float32), edges, hashed,
    )
    seen = [np.full(1, 1e-6), np.full(size, 1e-6, np.float32), np.full((size, rank), 1e-6, np.float32)]
    epochs = max(epochs, STEPS * BATCH // len(rows))
    for _ in range(epochs):
        order = rng.permutation(len(rows))
        for at in range(0, len(rows), BATCH):
            chosen = order[at : at + BATCH]
            x = m.dense([rows[i] for i in chosen])
            margin, sums = _margin(x, m.bias, m.linear, m.factors)
            error = ((1 / (1 + np.exp(-np.clip(margin, -30, 30))) - labels[chosen]) / len(chosen)).astype(np.float32)
            weighed = x * error[:, None]
            grads = (
                np.array([error.sum()]),
                error @ x + DECAY * m.linear,
                x.T @ (error[:, None] * sums) - m.factors * (x * weighed).sum(axis=0)[:, None] + DECAY * m.factors,
            )
            for total, g in zip(seen, grads):
                total += g * g
            m.bias -= float(RATE * grads[0][0] / np.sqrt(seen[0][0]))
            m.linear -= RATE * grads[1] / np.sqrt(seen[1])
            m.factors -= RATE * grads[2] / np.sqrt(seen[2])
    return m


def train(
    docs: DataFrame,
    labels: DataFrame,
    label: str = "quality",
    sample: int = SAMPLE,
    hashed: int = HASHED,
    rank: int = RANK,
    epochs: int = EPOCHS,
    seed: int = 42,
    id_col: str = "doc_id",
    text: str = "text",
) -> Model | None:
    """Fit on at most ``sample`` labelled ids outside the held-out part; None without both classes."""
    usable = labels.filter(F.col(id_col).isNotNull() & F.col(label).isNotNull() & ~held_out(id_col))
    chosen = usable.groupBy(id_col).agg(F.max(label).cast("int").alias("_y"))
    chosen = chosen.orderBy(F.xxhash64(id_col), id_col).limit(sample)
    rows = docs.select(id_col, text).join(F.broadcast(chosen), id_col).withColumn("_h", F.xxhash64(text))
    # Ids may repeat in the documents: one text of each is learnt from, the same in every run.
    schema = "id long, y int, at array<int>, x array<float>, stats array<double>, h long"
    kind = pa.schema(
        [("id", pa.int64()), ("y", pa.int32()), ("at", pa.list_(pa.int32())),
         ("x", pa.list_(pa.float32())), ("stats", pa.list_(pa.float64())), ("h", pa.int64())]
    )

    def features(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            made = [inputs(t.as_py(), hashed) for t in batch.column(1)]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0).cast(pa.int64()), batch.column(2).cast(pa.int32()),
                 pa.array([m[0] for m in made], kind.field(2).type),
                 pa.array([m[1] for m in made], kind.field(3).type),
                 pa.array([m[2] for m in made], kind.field(4).type), batch.column(3)],
                schema=kind,
            )

    one = F.min_by(F.struct("y", "at", "x", "stats"), "h").alias("r")
    found = rows.mapInArrow(features, schema).groupBy("id").agg(one).select("id", "r.*").toArrow().sort_by("id")
    at, x, stats = (_rows(found[c].combine_chunks()) for c in ("at", "x", "stats"))
    made = list(zip(at, x, stats))
    return fit(made, np.asarray(found["y"], np.float32), hashed, rank, epochs, seed)


def _rows(lists: pa.ListArray) -> list[np.ndarray]:
    flat, ends = lists.flatten().to_numpy(zero_copy_only=False), lists.offsets.to_numpy()
    return np.split(flat, ends[1:-1] - ends[0]) if len(lists) else []


def with_score(docs: DataFrame, model: Model | None, text: str = "text", out: str = "score") -> DataFrame:
    """``docs`` with the probability of label 1. An input column of that name is replaced."""
    docs = docs.drop(out)
    schema = T.StructType([*docs.schema.fields, T.StructField(out, T.DoubleType())])
    sent = docs.sparkSession.sparkContext.broadcast(vars(model) if model else None)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = Model(**sent.value) if sent.value else None
        for batch in batches:
            texts = batch.column(batch.schema.get_field_index(text))
            values: list[float] = []
            for at in range(0, len(texts), BATCH):
                some = texts.slice(at, BATCH)
                if model is None:
                    values += [PRIOR] * len(some)
                else:
                    values += model.scores([inputs(t.as_py(), model.hashed) for t in some]).tolist()
            yield pa.RecordBatch.from_arrays(
                [*batch.columns, pa.array(values, pa.float64())], [*batch.schema.names, out]
            )

    return docs.mapInArrow(run, schema)

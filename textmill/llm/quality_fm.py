"""Quality classifier: a factorisation machine over hashed words, structure and metadata.

``score = sigmoid(b + sum w_i x_i + 1/2 sum_f ((sum v_if x_i)^2 - sum v_if^2 x_i^2))``: all pairwise
interactions in time linear in the number of features. Words of the whole text are hashed to
``BUCKETS`` (weights: root of the share of the words), structure statistics and numeric metadata
columns are standardised and have buckets of their own.

The model is fitted in one task on at most ``SAMPLE`` labelled rows, those with the smallest hash of
their id; scoring reads every row once and moves none. A null text counts as empty and gets a score
like any other; null or non-finite metadata counts as 0; rows that repeat get equal scores. Labels
that are null are no labels, of several for one document the smallest counts. Without labels, or
with one class only, all scores are the share of label 1 (0.5 without labels).
"""

from __future__ import annotations

import pickle
import zlib

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F
from pyspark.sql.types import DoubleType, StructField, StructType

from textmill.llm.bounded import smallest_hashes

#: Bound of the labelled rows used for fitting.
SAMPLE = 12_000
BUCKETS, RANK = 1 << 15, 8
EPOCHS, BATCH, RATE, DECAY = 8, 64, 0.05, 1e-5

_CLASSES = np.zeros(256, np.int64)  # of bytes: 0 letter or other, 1 upper, 2 digit, 3 blank, 4 line end, 5 common mark, 6 symbol
_CLASSES[[*range(65, 91)]] = 1
_CLASSES[[*range(48, 58)]] = 2
_CLASSES[[9, 11, 12, 13, 32]] = 3
_CLASSES[10] = 4
_CLASSES[[*b".,;:!?'\"()-"]] = 5
_CLASSES[[*b"#$%&*+/<=>@[\\]^_`{|}~"]] = 6


def held_out(doc_id: str, folds: int = 5) -> Column:
    fold = F.pmod(F.crc32(F.encode(F.col(doc_id).cast("string"), "UTF-8")), F.lit(folds))
    return F.coalesce(fold == 0, F.lit(False))  # a null id is not held out, and not learned from


def features(text: str | None, metadata) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Word buckets, their weights, and the unscaled statistics of one document."""
    raw = (text or "").encode("utf-8", "replace")
    words = raw.lower().split()
    n, size = len(words), len(raw)
    hashed = np.fromiter(map(zlib.crc32, words), np.uint32, n) % BUCKETS
    buckets, counts = np.unique(hashed, return_counts=True)
    lines = raw.split(b"\n")
    share = np.bincount(_CLASSES[np.frombuffer(raw, np.uint8)], minlength=7) / max(size, 1)
    stats = [
        np.log1p(n), size / max(n, 1), len(buckets) / max(n, 1), *share[1:],
        np.log1p(len(lines)), len(set(lines)) / len(lines), n / len(lines),
        counts.max() / n if n else 0.0, max(map(len, lines)) / max(size, 1),
        np.mean(hashed[1:] == hashed[:-1]) if n > 1 else 0.0,
    ]
    meta = [float(np.log1p(abs(x))) if x is not None and np.isfinite(x) else 0.0 for x in metadata]
    return buckets, np.sqrt(counts / max(n, 1)), np.array(stats + meta)


def _feature_rows(columns, rows: int):
    texts = columns[0]
    for i in range(rows):
        yield features(texts[i].as_py(), [c[i].as_py() for c in columns[1:]])


class Machine:
    """Weights ``w``, factors ``v`` and bias over word buckets followed by the statistics."""

    def __init__(self, stats: int, seed: int = 10):
        random = np.random.default_rng(seed)
        size = BUCKETS + stats
        self.bias, self.w = 0.0, np.zeros(size)
        self.v = random.normal(0, 0.05, (size, RANK))
        self.mean, self.scale = np.zeros(stats), np.ones(stats)

    def state(self) -> tuple:
        """All a scorer needs, small enough for the driver: ``BUCKETS * (RANK + 1)`` numbers."""
        return self.bias, self.w.astype(np.float32), self.v.astype(np.float32), self.mean, self.scale

    @classmethod
    def of(cls, state: tuple) -> "Machine":
        machine = cls(len(state[3]))
        machine.bias, machine.w, machine.v, machine.mean, machine.scale = state
        return machine

    def inputs(self, row) -> tuple[np.ndarray, np.ndarray]:
        buckets, weights, stats = row
        scaled = np.clip((stats - self.mean) / self.scale, -5, 5) / np.sqrt(len(stats))
        return np.concatenate([buckets, BUCKETS + np.arange(len(stats))]), np.concatenate([weights, scaled])

    def margin(self, at: np.ndarray, x: np.ndarray) -> float:
        sums = x @ self.v[at]
        return self.bias + x @ self.w[at] + 0.5 * float(sums @ sums - np.sum((x[:, None] * self.v[at]) ** 2))

    def score(self, row) -> float:
        return float(1 / (1 + np.exp(-np.clip(self.margin(*self.inputs(row)), -500, 500))))

    def fit(self, rows: list, labels: np.ndarray, seed: int = 10) -> None:
        share = float(labels.mean()) if len(labels) else 0.5
        if not len(rows) or not 0 < share < 1:
            self.v[:] = 0
            self.bias = float(np.log(max(share, 1e-6) / max(1 - share, 1e-6)))
            return
        stats = np.stack([r[2] for r in rows])
        self.mean, self.scale = stats.mean(axis=0), stats.std(axis=0) + 1e-9
        self.bias = float(np.log(share / (1 - share)))
        inputs = [self.inputs(r) for r in rows]
        random = np.random.default_rng(seed)
        seen_w, seen_v = np.full_like(self.w, 1e-3), np.full_like(self.v, 1e-3)
        for _ in range(EPOCHS):
            order = random.permutation(len(rows))
            for i in range(0, len(order), BATCH):
                part = order[i : i + BATCH]
                at, x = (np.concatenate([inputs[j][k] for j in part]) for k in (0, 1))
                sizes = np.array([len(inputs[j][0]) for j in part])
                begin = np.cumsum(sizes) - sizes
                xv = x[:, None] * self.v[at]
                sums = np.add.reduceat(xv, begin)
                pair = 0.5 * (sums**2 - np.add.reduceat(xv**2, begin)).sum(axis=1)
                margin = self.bias + np.add.reduceat(x * self.w[at], begin) + pair
                wrong = 1 / (1 + np.exp(-np.clip(margin, -500, 500))) - labels[part]
                each = np.repeat(wrong, sizes)
                grad_w = each * x / len(part)
                grad_v = grad_w[:, None] * (np.repeat(sums, sizes, axis=0) - xv)
                used, place = np.unique(at, return_inverse=True)
                step_w = np.bincount(place, grad_w) + DECAY * self.w[used]
                step_v = np.stack([np.bincount(place, grad_v[:, f]) for f in range(RANK)], 1) + DECAY * self.v[used]
                seen_w[used] += step_w**2
                seen_v[used] += step_v**2
                self.w[used] -= RATE * step_w / np.sqrt(seen_w[used])
                self.v[used] -= RATE * step_v / np.sqrt(seen_v[used])
                self.bias -= RATE * float(wrong.mean())


def fit(
    documents: DataFrame, labels: DataFrame, label: str = "quality", doc_id: str = "doc_id", text: str = "text",
    metadata: tuple[str, ...] = (), sample: int = SAMPLE,
) -> Machine:
    """Fit on labelled rows of ``documents`` that are not held out."""
    known = labels.select(F.col(doc_id).alias("_id"), F.col(label).cast("int").alias("_label"))
    known = known.filter(F.col("_id").isNotNull() & F.col("_label").isin(0, 1) & ~held_out("_id"))
    # each label once, the smallest hashes: at most ``sample`` rows, small enough to broadcast
    chosen = smallest_hashes(known.groupBy("_id").agg(F.min("_label").alias("_label")), "_id", sample)
    columns = [F.col(m).cast("double") for m in metadata]
    rows = documents.select(F.col(doc_id).alias("_id"), F.col(text).cast("string").alias("_text"), *columns)
    found = rows.join(F.broadcast(chosen), "_id").select("_id", "_label", "_text", *metadata)

    def prepare(batches):
        for batch in batches:
            packed = [
                pickle.dumps(tuple(a.astype(t) for a, t in zip(r, (np.int32, np.float32, np.float64))))
                for r in _feature_rows(batch.columns[2:], batch.num_rows)
            ]
            yield pa.RecordBatch.from_arrays([*batch.columns[:2], pa.array(packed, pa.binary())], ["_id", "_label", "row"])

    id_type = found.schema["_id"].dataType.simpleString()
    prepared = found.mapInArrow(prepare, f"_id {id_type}, _label int, row binary")

    def train(pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.sort_values(["_id", "row"])
        return pd.DataFrame({"model": [pickle.dumps(trained(list(pdf["row"]), pdf["_label"].to_numpy()))]})

    def trained(rows, values):
        rows = [pickle.loads(r) for r in rows]
        machine = Machine(len(rows[0][2]))
        machine.fit(rows, values.astype(np.float64))
        return machine.state()

    # one group of a bounded number of rows; repeated documents count once
    models = prepared.groupBy("_id").agg(F.min("_label").alias("_label"), F.min("row").alias("row"))
    models = models.withColumn("_all", F.lit(0)).groupBy("_all").applyInPandas(train, "model binary").collect()
    if not models:
        machine = Machine(len(features("", [0.0] * len(metadata))[2]))
        machine.fit([], np.zeros(0))
        return machine
    return Machine.of(pickle.loads(models[0]["model"]))


def score(
    documents: DataFrame, machine: Machine, text: str = "text", metadata: tuple[str, ...] = (), name: str = "score"
) -> DataFrame:
    """All columns of ``documents`` and ``name``, the probability of label 1; it replaces a column of
    that name."""
    documents = documents.drop(name)
    extra = [F.col(m).cast("double").alias(f"_fm_meta{i}") for i, m in enumerate(metadata)]
    schema = StructType([*documents.schema.fields, StructField(name, DoubleType())])
    width = len(documents.columns)
    shared = documents.sparkSession.sparkContext.broadcast(machine.state())  # BUCKETS * (RANK + 1) numbers

    def run(batches):
        model = Machine.of(shared.value)
        for batch in batches:
            scores = [model.score(r) for r in _feature_rows(batch.columns[width:], batch.num_rows)]
            yield pa.RecordBatch.from_arrays([*batch.columns[:width], pa.array(scores, pa.float64())], schema.names)

    whole = documents.select("*", F.col(text).cast("string").alias("_fm_text"), *extra)
    return whole.mapInArrow(run, schema)

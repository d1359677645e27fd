"""Feed-forward net: mini-batch steps inside tasks, one distributed average of the copies a pass, weighted loss, patience.

A Spark job for every mini-batch would cost more than its arithmetic.  So a job is a whole pass: each task adds up the
held-out loss of the weights it was given, makes its own optimiser steps on its rows, and gives its copy out in blocks.
Spark averages the blocks (weights and moments, by rows learned); the driver holds one model, whatever the rows are.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.functions import pandas_udf

from episodica.operators.linear import as_array, matrix
from episodica.sources.shared import store

BLOCK = 4096  # weights a row of the averaged table


@dataclass(frozen=True)
class NetSettings:
    hidden: tuple[int, ...] = (256, 128, 64)
    dropout: float = 0.2
    epochs: int = 30
    batch: int = 256
    rate: float = 1e-3
    decay: float = 1e-5
    patience: int = 2
    chunk: int = 1 << 15  # rows that a task holds at a time
    seed: int = 42


def layers(flat: np.ndarray, widths: list[int]) -> list[tuple[np.ndarray, np.ndarray]]:
    """Views of one vector as (matrix, bias) per layer."""
    out, at = [], 0
    for a, b in zip(widths[:-1], widths[1:], strict=True):
        out.append((flat[at : at + a * b].reshape(a, b), flat[at + a * b : at + a * b + b]))
        at += a * b + b
    return out


def size_of(widths: list[int]) -> int:
    return sum(a * b + b for a, b in zip(widths[:-1], widths[1:], strict=True))


def untrained(widths: list[int], seed: int) -> np.ndarray:
    rng, flat = np.random.default_rng(seed), np.zeros(size_of(widths), np.float32)
    for w, _ in layers(flat, widths):
        w[:] = rng.standard_normal(w.shape) * np.sqrt(2 / max(len(w), 1))
    return flat


def margins(flat: np.ndarray, widths: list[int], x: np.ndarray) -> np.ndarray:
    """Log odds of each row."""
    *inner, (w, b) = layers(flat, widths)
    for m, c in inner:
        x = np.maximum(x @ m + c, 0)
    return (x @ w + b)[:, 0]


def losses(margin: np.ndarray, y: np.ndarray, weight: np.ndarray) -> np.ndarray:
    return weight * (np.logaddexp(0, margin) - y * margin)


def gradient(flat: np.ndarray, widths: list[int], x: np.ndarray, y: np.ndarray, weight: np.ndarray, rng=None, dropout: float = 0.0) -> tuple[float, np.ndarray]:
    """Mean weighted log loss of a batch and its gradient; with ``rng``, units are dropped at random."""
    parts, out = layers(flat, widths), np.zeros_like(flat)
    inputs, masks = [x], []
    for m, c in parts[:-1]:
        h = inputs[-1] @ m + c
        mask = (h > 0).astype(flat.dtype)
        if rng is not None and dropout:
            mask *= (rng.random(h.shape, np.float32) >= dropout) / flat.dtype.type(1 - dropout)
        inputs.append(h * mask)
        masks.append(mask)
    margin = (inputs[-1] @ parts[-1][0] + parts[-1][1])[:, 0]
    back = ((weight * (1 / (1 + np.exp(-margin)) - y)) / len(y)).astype(flat.dtype)[:, None]
    for k in range(len(parts) - 1, -1, -1):
        dm, dc = layers(out, widths)[k]
        dm[:], dc[:] = inputs[k].T @ back, back.sum(axis=0)
        if k:
            back = (back @ parts[k][0].T) * masks[k - 1]
    return float(losses(margin, y, weight).mean()), out


class State:
    """Weights with the two moments of Adam and the number of steps made."""

    def __init__(self, values: np.ndarray, steps: int):
        self.values, self.steps = values.copy(), steps

    def step(self, g: np.ndarray, s: NetSettings) -> None:
        w, m, v = self.values
        self.steps += 1
        m += 0.1 * (g - m)
        v += 0.001 * (g * g - v)
        w -= s.rate * ((m / (1 - 0.9**self.steps)) / (np.sqrt(v / (1 - 0.999**self.steps)) + 1e-8) + s.decay * w)


def learn(state: State, widths: list[int], x: np.ndarray, y: np.ndarray, weight: np.ndarray, s: NetSettings, rng) -> None:
    """One step a mini-batch, over the rows in random order."""
    order = rng.permutation(len(x))
    for at in range(0, len(order), s.batch):
        some = order[at : at + s.batch]
        state.step(gradient(state.values[0], widths, x[some], y[some], weight[some], rng, s.dropout)[1], s)


PART = "block int, values binary, steps long, learned double, loss double, held double"


def pass_over(rows: DataFrame, values: np.ndarray, steps: int, widths: list[int], positive_weight: float, s: NetSettings, epoch: int, train: bool):
    """One job: ``(averaged values, steps, held-out loss of the given values)``; the loss is None without held-out rows.

    A task whose executor is lost begins again from the same weights, rows and random numbers.
    """
    shared = rows.sparkSession.sparkContext.broadcast(values)

    def run(batches):
        given, rng = shared.value, np.random.default_rng([s.seed, epoch, TaskContext.get().partitionId()])
        state, parts, size, learned, loss, held = State(given, steps), [], 0, 0, 0.0, 0

        def trained():
            x, y = (np.concatenate(c) for c in zip(*parts, strict=True))
            learn(state, widths, x, y, np.where(y > 0, np.float32(positive_weight), np.float32(1)), s, rng)

        for batch in batches:
            x, y = matrix(batch.column(0), widths[0]).astype(np.float32), batch.column(1).to_numpy().astype(np.float32)
            out = batch.column(2).to_numpy(zero_copy_only=False).astype(bool)
            if out.any():
                loss += float(losses(margins(given[0], widths, x[out]), y[out], np.where(y[out] > 0, positive_weight, 1.0)).sum())
                held += int(out.sum())
            if train and not out.all():
                parts.append((x[~out], y[~out]))
                size += len(parts[-1][0])
                if size >= s.chunk:
                    trained()
                    learned, parts, size = learned + size, [], 0
        if size:
            trained()
            learned += size
        made = []
        if learned:
            made = [(at // BLOCK, np.ascontiguousarray(state.values[:, at : at + BLOCK]).tobytes(), state.steps, learned, 0.0, 0.0) for at in range(0, len(given[0]), BLOCK)]
        columns = zip(*made, (-1, b"", 0, 0.0, loss, held), strict=True)
        types = (pa.int32(), pa.binary(), pa.int64(), pa.float64(), pa.float64(), pa.float64())
        yield pa.RecordBatch.from_arrays([pa.array(list(c), t) for c, t in zip(columns, types, strict=True)], names=[c.split()[0] for c in PART.split(", ")])

    def averaged(table: pa.Table) -> pa.Table:
        n = table.column("learned").to_numpy()
        total, mean = n.sum(), b""
        if total:
            copies = zip(table.column("values").to_pylist(), n, strict=True)
            mean = sum(np.frombuffer(v, np.float32).astype(np.float64) * (k / total) for v, k in copies).astype(np.float32).tobytes()
        cells = [
            table.column("block")[0].as_py(), mean, int((table.column("steps").to_numpy() * n).sum() / total) if total else 0, float(total),
            float(table.column("loss").to_numpy().sum()), float(table.column("held").to_numpy().sum()),
        ]
        return pa.Table.from_arrays([pa.array([c], f.type) for c, f in zip(cells, table.schema, strict=True)], names=table.schema.names)

    # one row a block of 4,096 weights: as large as the model
    found = rows.mapInArrow(run, PART).groupBy("block").applyInArrow(averaged, PART).collect()
    shared.destroy()
    made, loss = values.copy(), None
    for r in found:
        if r.block >= 0:
            made[:, r.block * BLOCK : (r.block + 1) * BLOCK] = np.frombuffer(bytes(r["values"]), np.float32).reshape(3, -1)
            steps = r.steps
        elif r.held:
            loss = r.loss / r.held
    return made, steps, loss


@dataclass
class FeedForward:
    """Widths of the layers and all weights; the held-out loss before each pass over the rows."""

    widths: list[int]
    weights: np.ndarray
    history: list[float] = field(default_factory=list)

    def transform(self, df: DataFrame, features: str = "features") -> DataFrame:
        """Adds the probability ``p``; the weights are broadcast, their size is that of the layers.  NULL features give NULL."""
        shared, widths = df.sparkSession.sparkContext.broadcast(self.weights), self.widths

        @pandas_udf("double")
        def probability(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
            for column in batches:
                there = column.notna().to_numpy()
                out = np.full(len(column), np.nan)
                if there.any():
                    x = np.stack(column[there].to_list()).astype(np.float32)
                    out[there] = 1 / (1 + np.exp(-margins(shared.value, widths, x).astype(np.float64)))
                yield pd.Series(out).astype(object).where(there, None)

        return df.withColumn("p", probability(as_array(df, features)))

    def save(self, spark, path: str) -> None:
        row = [(self.widths, bytearray(self.weights.tobytes()))]
        spark.createDataFrame(row, "widths array<int>, weights binary").coalesce(1).write.mode("overwrite").parquet(path)

    @classmethod
    def load(cls, spark, path: str) -> "FeedForward":
        row = spark.read.parquet(path).first()
        return cls(list(row.widths), np.frombuffer(bytes(row.weights), np.float32).copy())


def fit_net(rows: DataFrame, settings: NetSettings = NetSettings(), features: str = "features", label: str = "label", held: str = "is_validation") -> FeedForward:
    """A net with one output for log loss, positive rows weighted by negatives / positives, dropout and weight decay.

    Rows with ``held`` are not learned from: after each pass their weighted loss is taken, the weights with the lowest
    one are kept, and ``patience`` passes without a lower one end the training.  Without such rows all passes are made.
    Rows with a NULL label or features are left out; without rows, or with one class, every score is the share of positives.
    """
    kept = rows.select(
        as_array(rows, features).cast("array<float>").alias("x"), F.col(label).cast("double").alias("y"), F.coalesce(F.col(held), F.lit(False)).alias("held")
    )
    kept = store(kept.where("x is not null and y is not null"), "net-rows")
    facts = kept.agg(F.max(F.size("x")).alias("d"), F.count_if(~F.col("held")).alias("n"), F.count_if(~F.col("held") & (F.col("y") > 0)).alias("positive")).first()
    if not facts.n or facts.positive in (0, facts.n):
        share = facts.positive / facts.n if facts.n else 0.0
        flat = np.zeros((facts.d or 0) + 1, np.float32)
        flat[-1] = np.log(max(share, 1e-30) / max(1 - share, 1e-30))
        return FeedForward([facts.d or 0, 1], flat)
    widths = [facts.d, *settings.hidden, 1]
    flat = untrained(widths, settings.seed)
    values, steps = np.stack([flat, np.zeros_like(flat), np.zeros_like(flat)]), 0
    best, history = flat, []
    for epoch in range(settings.epochs + 1):
        before = values
        values, steps, loss = pass_over(kept, values, steps, widths, (facts.n - facts.positive) / facts.positive, settings, epoch, epoch < settings.epochs)
        if loss is None:
            best = values[0]
            continue
        if not history or loss < min(history) - 1e-6:
            best = before[0]
        history.append(loss)
        if len(history) - 1 - int(np.argmin(history)) >= settings.patience:
            break
    return FeedForward(widths, best.copy(), history)

"""A multi-layer perceptron trained over blocks of rows: local steps in each, averaged once an epoch.

An epoch deals all rows to blocks anew, by a hash of their id. A block takes
Adam's steps over its own mini-batches from the weights that all share, and the
blocks' weights and moments are averaged by their rows, by a tree of fixed
fan-in in the order of the blocks (local SGD). With one block this is ordinary
mini-batch training. No task holds more than a block, the driver holds one
state, and a result doesn't depend on the input's partitions.
"""

from __future__ import annotations

import json
from collections.abc import Callable

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .lineage import Tables

#: Numbers (rows times width) that a block holds at most, 32 MB of doubles.
BLOCK_NUMBERS = 1 << 22
#: Blocks that one task of the tree adds up.
FAN_IN = 32
#: Copies of one row that a task writes at most.
COPIES = 10_000
#: Thousandths of the rows that early stopping looks at.
HELD = 200

Layers = list[tuple[np.ndarray, np.ndarray]]


def flat(layers: Layers) -> np.ndarray:
    return np.concatenate([p.ravel() for layer in layers for p in layer])


def shaped(vector: np.ndarray, sizes: list[int]) -> Layers:
    out, at = [], 0
    for a, b in zip(sizes, sizes[1:]):
        out.append((vector[at : at + a * b].reshape(a, b), vector[at + a * b : at + a * b + b]))
        at += a * b + b
    return out


def probability(layers: Layers, z: np.ndarray) -> np.ndarray:
    for k, (w, b) in enumerate(layers):
        z = z @ w + b
        if k + 1 < len(layers):
            z = np.maximum(z, 0)
    return 1 / (1 + np.exp(-np.clip(z[:, 0], -60, 60)))


def cross_entropy(layers: Layers, z: np.ndarray, y: np.ndarray, weight: float) -> float:
    """The sum over rows; label 1 counts weight times."""
    p = np.clip(probability(layers, z), 1e-9, 1 - 1e-9)
    return float(-(weight * y * np.log(p) + (1 - y) * np.log(1 - p)).sum())


def gradient(layers: Layers, z: np.ndarray, y: np.ndarray, weight: float, dropout: float, draw: np.random.Generator) -> np.ndarray:
    """That of the mean cross-entropy, by back-propagation, as one vector."""
    acts, masks = [z], []
    for k, (w, b) in enumerate(layers):
        h = acts[-1] @ w + b
        if k + 1 < len(layers):
            masks.append((draw.random(h.shape) >= dropout) / (1 - dropout) * (h > 0))
            h = h * masks[-1]
        acts.append(h)
    p = 1 / (1 + np.exp(-np.clip(acts[-1][:, 0], -60, 60)))
    back = ((p - y) * np.where(y == 1, weight, 1) / len(y))[:, None]
    out: Layers = []
    for k in range(len(layers) - 1, -1, -1):
        out.append((acts[k].T @ back, back.sum(0)))
        if k:
            back = back @ layers[k][0].T * masks[k - 1]
    return flat(out[::-1])


class Perceptron:
    """Hidden ReLU layers and one logit over standardised features."""

    def __init__(self, weights: Layers, mean: np.ndarray, scale: np.ndarray) -> None:
        self.weights, self.mean, self.scale = weights, mean, scale

    def forward(self, x: np.ndarray) -> np.ndarray:
        return probability(self.weights, (x - self.mean) / self.scale)

    def to_json(self) -> str:
        return json.dumps({"w": [(a.tolist(), b.tolist()) for a, b in self.weights], "mean": self.mean.tolist(), "scale": self.scale.tolist()})

    @classmethod
    def from_json(cls, text: str) -> Perceptron:
        d = json.loads(text)
        return cls([(np.array(a), np.array(b)) for a, b in d["w"]], np.array(d["mean"]), np.array(d["scale"]))


Part = tuple[np.ndarray, np.ndarray]  # a block's counts, and its vectors in one


def _added(parts: list[Part]) -> Part:
    return sum(p[0] for p in parts), sum(p[1] for p in parts)


def _pooled(parts: list[Part]) -> Part:
    """Rows, sums and squared deviations from the own mean; those of a whole from those of its parts."""
    n, s, d = parts[0][0][0], *np.split(parts[0][1], 2)
    for (m,), body in parts[1:]:
        t, e = np.split(body, 2)
        if n and m:
            e = e + (s / n - t / m) ** 2 * (n * m / (n + m))
        n, s, d = n + m, s + t, d + e
    return np.array([n]), np.concatenate([s, d])


class Blocks:
    """Rows (label, features) as a written table with an id each; copies have ids of their own, whatever the partitions."""

    def __init__(self, rows: DataFrame, block_numbers: int = BLOCK_NUMBERS) -> None:
        self.tables = Tables(rows.sparkSession)
        counts = rows.groupBy(F.col("label").cast("int").alias("label"), "features").agg(F.count(F.lit(1)).alias("n"))
        steps = counts.select("label", "features", "n", F.explode(F.sequence(F.lit(0).cast("long"), F.col("n") - 1, F.lit(COPIES).cast("long"))).alias("s"))
        spread = steps.repartition(F.xxhash64("label", "features", "s"))  # a row with very many copies is written by many tasks
        each = spread.select("label", "features", F.explode(F.sequence("s", F.least(F.col("s") + COPIES, "n") - 1)).alias("s"))
        self.rows = self.tables.written(each.select("label", "features", F.xxhash64("label", "features", "s").alias("id")), "rows")
        sums = self.rows.agg(F.count(F.lit(1)).alias("n"), F.max(F.size("features")).alias("width")).first()
        if not sums.n:
            raise ValueError("no rows to fit")
        self.width = int(sums.width)
        self.blocks = -(-int(sums.n) // max(1, block_numbers // max(1, self.width)))

    def drop(self) -> None:
        self.tables.drop("rows")

    def total(self, epoch: int, work: Callable[[int, pd.DataFrame], Part], merge: Callable[[list[Part]], Part], mark: Column | None = None) -> Part:
        """work of each block of an epoch, merged by the tree in the order of the blocks; mark is one more column."""
        kind = "block int, counts array<double>, body binary"

        def packed(block: int, part: Part) -> pd.DataFrame:
            return pd.DataFrame({"block": [block], "counts": [part[0].tolist()], "body": [part[1].tobytes()]})

        def own(rows: pd.DataFrame) -> pd.DataFrame:
            block = int(rows.block.iloc[0])
            return packed(block, work(block, rows.sort_values("id", kind="stable")))

        def joined(rows: pd.DataFrame) -> pd.DataFrame:
            rows = rows.sort_values("block")
            return packed(int(rows.block.iloc[0]) // FAN_IN, merge([(np.array(c, float), np.frombuffer(b)) for c, b in zip(rows.counts, rows.body)]))

        block = F.pmod(F.xxhash64("id", F.lit(epoch)), F.lit(self.blocks)).cast("int")
        out = self.rows.select("id", "label", "features", (F.lit(0) if mark is None else mark).alias("mark"), block.alias("block")).groupBy("block").applyInPandas(own, kind)
        left = self.blocks
        while left > 1:
            out = out.groupBy(F.floor(F.col("block") / FAN_IN)).applyInPandas(joined, kind)
            left = -(-left // FAN_IN)
        row = out.first()
        return np.array(row.counts, float), np.frombuffer(row.body)


def _matrix(rows: pd.DataFrame) -> np.ndarray:
    return np.array(rows.features.tolist(), np.float64).reshape(len(rows), -1)


State = tuple[np.ndarray, np.ndarray, np.ndarray, float]  # weights, both moments of Adam, steps


class Descent:
    """What an epoch does in a block, and when training ends."""

    def __init__(self, sizes: list[int], rate: float, epochs: int, dropout: float, batch: int, seed: int, weight: float, patience: int) -> None:
        self.sizes, self.rate, self.epochs, self.dropout, self.batch, self.seed, self.weight, self.patience = sizes, rate, epochs, dropout, batch, seed, weight, patience

    def first(self) -> State:
        draw = np.random.default_rng(self.seed)
        w = flat([(draw.normal(0, np.sqrt(2 / a), (a, b)), np.zeros(b)) for a, b in zip(self.sizes, self.sizes[1:])])
        return w, np.zeros_like(w), np.zeros_like(w), 0.0

    def epoch(self, k: int, block: int, state: State, z: np.ndarray, y: np.ndarray, seen: np.ndarray, own: np.ndarray) -> Part:
        """The loss of the state on the rows `seen`, and the state after steps over the rows `own`; after the last epoch the loss alone."""
        w, m, v, t = state
        loss = cross_entropy(shaped(w, self.sizes), z[seen], y[seen], self.weight)
        draw = np.random.default_rng([self.seed & 0xFFFFFFFF, k, block])
        order = draw.permutation(own) if k < self.epochs else own[:0]
        at = 0
        for at, lo in enumerate(range(0, len(order), self.batch), 1):
            some = order[lo : lo + self.batch]
            g = gradient(shaped(w, self.sizes), z[some], y[some], self.weight, self.dropout, draw)
            m, v = 0.9 * m + 0.1 * g, 0.999 * v + 0.001 * g**2
            w = w - self.rate * (m / (1 - 0.9 ** (t + at))) / (np.sqrt(v / (1 - 0.999 ** (t + at))) + 1e-8)
        return np.array([len(own), len(own) * at, loss, len(seen)], float), np.concatenate([w, m, v]) * len(own)

    def run(self, step: Callable[[int, State], Part]) -> np.ndarray:
        """The weights of the best epoch; step gives an epoch's sums over blocks."""
        state = self.first()
        best, kept, wait = np.inf, state[0], 0
        for k in range(self.epochs + 1):
            counts, body = step(k, state)
            if k:
                loss = counts[2] / max(1.0, counts[3])
                wait = 0 if loss < best - 1e-6 else wait + 1
                if not wait:
                    best, kept = loss, state[0]
            if k == self.epochs or wait >= self.patience:
                break
            state = (*np.split(body / counts[0], 3), state[3] + counts[1] / counts[0])
        return kept


def train(blocks: Blocks, hidden: list[int], rate: float, epochs: int, dropout: float, batch: int, seed: int, patience: int = 5) -> Perceptron:
    """Weighted cross-entropy, Adam, dropout, and the weights of the epoch that is best on a fifth of the rows, held out by hash.

    Training ends when `patience` epochs bring nothing. Without a held-out row (few
    rows), all rows are looked at instead. A single block goes through its epochs
    in one task, by the same steps.
    """
    held = F.pmod(F.xxhash64("id", F.lit(f"held-{seed}")), F.lit(1000)) < HELD
    sums = blocks.rows.agg(F.count_if(held).alias("held"), F.count_if(~held & (F.col("label") == 0)).alias("zeros"), F.count_if(~held & (F.col("label") == 1)).alias("ones")).first()
    watched = held if sums.held else F.lit(True)
    own = ~held if sums.zeros + sums.ones else F.lit(True)
    mark = watched.cast("int") + 2 * own.cast("int")
    descent = Descent([blocks.width, *hidden, 1], rate, epochs, dropout, batch, seed, max(1e-6, sums.zeros / max(1, sums.ones)), patience)

    def moments(_: int, rows: pd.DataFrame) -> Part:
        x = _matrix(rows)
        return np.array([len(x)], float), np.concatenate([x.sum(0), ((x - x.mean(0)) ** 2).sum(0)])

    (n,), body = blocks.total(-1, moments, _pooled)
    mean, scale = np.split(body, 2)[0] / n, np.sqrt(np.split(body, 2)[1] / n) + 1e-6

    def read(rows: pd.DataFrame) -> tuple[np.ndarray, ...]:
        marks = rows.mark.to_numpy()
        return (_matrix(rows) - mean) / scale, rows.label.to_numpy(np.float64), np.flatnonzero(marks & 1), np.flatnonzero(marks & 2)

    def step(k: int, state: State) -> Part:
        return blocks.total(k, lambda block, rows: descent.epoch(k, block, state, *read(rows)), _added, mark)

    def alone(block: int, rows: pd.DataFrame) -> Part:
        data = read(rows)
        return np.zeros(1), descent.run(lambda k, state: descent.epoch(k, block, state, *data))

    kept = blocks.total(0, alone, _added, mark)[1] if blocks.blocks == 1 else descent.run(step)
    return Perceptron(shaped(kept, descent.sizes), mean, scale)

"""Models fitted by gradients that tasks sum up: the two-task ranker and the neighbourhood network.

A step is one pass: each task returns the sums of its rows, Spark adds them by parameter, and the driver, which holds
parameters and never rows, moves on. Passes read a written table, so a lost task repeats only its part.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from dataclasses import dataclass, field

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Shape of the two-task ranker: rank of the crosses, experts and their width; the weight of conversions is a fixed value.
CROSS_RANK, EXPERTS, WIDTH = 3, 3, 8
CVR_WEIGHT = 0.5
RIDGE = 1e-4


def summed(rows: DataFrame, partial: Callable[[pa.RecordBatch], np.ndarray], size: int) -> np.ndarray:
    """The sum over all rows of a vector of ``size`` numbers per batch."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(size)
        for batch in batches:
            if batch.num_rows:
                total += partial(batch)
        yield pa.RecordBatch.from_arrays([pa.array(np.arange(size)), pa.array(total)], ["i", "v"])

    whole = rows.mapInArrow(run, "i bigint, v double").groupBy("i").agg(F.sum("v").alias("v")).toArrow()
    out = np.zeros(size)
    out[whole["i"].to_numpy()] = whole["v"].to_numpy()
    return out


def matrix(column: pa.Array, width: int) -> np.ndarray:
    return column.flatten().to_numpy(zero_copy_only=False).astype(float).reshape(-1, width)


def sigmoid(z: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(z, -500, 500)))


def log_loss(y: np.ndarray, z: np.ndarray) -> float:
    """Sum of the logistic losses of labels at logits."""
    return float((np.logaddexp(0, z) - y * z).sum())


class Shapes:
    """Named arrays in one flat vector."""

    def __init__(self, **shapes: tuple[int, ...]):
        self.shapes = shapes
        self.sizes = {n: int(np.prod(s)) for n, s in shapes.items()}
        self.size = sum(self.sizes.values())

    def split(self, flat: np.ndarray) -> dict[str, np.ndarray]:
        cuts = np.cumsum([0, *self.sizes.values()])
        return {n: flat[a:b].reshape(s) for (n, s), a, b in zip(self.shapes.items(), cuts, cuts[1:])}

    def join(self, arrays: dict[str, np.ndarray]) -> np.ndarray:
        return np.concatenate([np.ravel(arrays[n]) for n in self.shapes])


def descend(start: np.ndarray, loss_and_gradient: Callable[[np.ndarray], tuple[float, np.ndarray]], steps: int, rate: float) -> np.ndarray:
    """Steps with momentum and a rate per parameter (Adam), and the best point seen."""
    x, m, v = start.copy(), np.zeros_like(start), np.zeros_like(start)
    best, least = x, np.inf
    for t in range(1, steps + 1):
        loss, g = loss_and_gradient(x)
        if loss < least:
            best, least = x.copy(), loss
        m, v = 0.9 * m + 0.1 * g, 0.99 * v + 0.01 * g * g
        x = x - rate * (m / (1 - 0.9**t)) / (np.sqrt(v / (1 - 0.99**t)) + 1e-8)
    return best if loss_and_gradient(x)[0] > least else x


@dataclass
class TwoTasks:
    """Clicks and conversions from shared parts: low-rank crosses of the inputs feed experts, each task mixes the experts by a gate
    of its own, and its head reads the mix and the inputs themselves."""

    mean: np.ndarray
    spread: np.ndarray
    shapes: Shapes = field(init=False)
    flat: np.ndarray = field(init=False)

    def __post_init__(self):
        d = len(self.mean)
        self.shapes = Shapes(
            U=(d, CROSS_RANK), V=(d, CROSS_RANK), W=(EXPERTS, 2 * d, WIDTH), b=(EXPERTS, WIDTH), G=(2, d, EXPERTS), c=(2, EXPERTS),
            w=(2, WIDTH), v=(2, d), k=(2,),
        )
        rng = np.random.default_rng(11)
        self.flat = rng.normal(size=self.shapes.size) * 0.3
        self.flat[-2 * d - 2 :] = 0

    def inputs(self, raw: np.ndarray) -> np.ndarray:
        return np.divide(raw - self.mean, self.spread, out=np.zeros_like(raw), where=self.spread > 0)

    def forward(self, x: np.ndarray, p: dict[str, np.ndarray]) -> dict[str, np.ndarray]:
        low = x @ p["V"]
        cross = low @ p["U"].T
        s = np.concatenate([x, x * cross], axis=1)
        hidden = np.maximum(np.einsum("ns,esm->nem", s, p["W"]) + p["b"], 0)
        gate = np.einsum("nd,tde->nte", x, p["G"]) + p["c"]
        gate = np.exp(gate - gate.max(axis=2, keepdims=True))
        gate /= gate.sum(axis=2, keepdims=True)
        mix = np.einsum("nte,nem->ntm", gate, hidden)
        logits = np.einsum("ntm,tm->nt", mix, p["w"]) + x @ p["v"].T + p["k"]
        return {"low": low, "cross": cross, "s": s, "hidden": hidden, "gate": gate, "mix": mix, "logits": logits}

    def gradient(self, x: np.ndarray, y: np.ndarray, flat: np.ndarray) -> np.ndarray:
        """Summed joint loss, then its gradient."""
        p = self.shapes.split(flat)
        f = self.forward(x, p)
        weight = np.array([1.0, CVR_WEIGHT])
        loss = sum(weight[t] * log_loss(y[:, t], f["logits"][:, t]) for t in range(2))
        off = weight * (sigmoid(f["logits"]) - y)
        d_mix = off[:, :, None] * p["w"]
        d_hidden = np.einsum("nte,ntm->nem", f["gate"], d_mix) * (f["hidden"] > 0)
        d_gate = np.einsum("ntm,nem->nte", d_mix, f["hidden"])
        d_gate = f["gate"] * (d_gate - (f["gate"] * d_gate).sum(axis=2, keepdims=True))
        d_cross = np.einsum("nem,esm->ns", d_hidden, p["W"])[:, x.shape[1] :] * x
        g = {
            "U": d_cross.T @ f["low"], "V": x.T @ (d_cross @ p["U"]), "W": np.einsum("ns,nem->esm", f["s"], d_hidden), "b": d_hidden.sum(axis=0),
            "G": np.einsum("nd,nte->tde", x, d_gate), "c": d_gate.sum(axis=0), "w": np.einsum("nt,ntm->tm", off, f["mix"]), "v": off.T @ x,
            "k": off.sum(axis=0),
        }
        return np.append(loss, self.shapes.join(g))

    def head_sums(self, x: np.ndarray, y: np.ndarray, flat: np.ndarray) -> np.ndarray:
        """Gradient and curvature of each head over its inputs: the mix, ``x`` and one."""
        f, out = self.forward(x, self.shapes.split(flat)), []
        for t in range(2):
            phi = np.concatenate([f["mix"][:, t], x, np.ones((len(x), 1))], axis=1)
            p = sigmoid(f["logits"][:, t])
            out += [phi.T @ (p - y[:, t]), ((phi * (p * (1 - p))[:, None]).T @ phi).ravel()]
        return np.concatenate(out)

    def score(self, inputs: list[Column], names: tuple[str, str]) -> dict[str, Column]:
        """The two probabilities as columns over the raw inputs."""
        width, flat = len(self.mean), self.flat

        @F.pandas_udf("array<double>")
        def both(vectors: pd.Series) -> pd.Series:
            if not len(vectors):
                return pd.Series([], dtype=object)
            x = self.inputs(np.stack(vectors.to_numpy()).astype(float).reshape(-1, width))
            return pd.Series(list(sigmoid(self.forward(x, self.shapes.split(flat))["logits"])))

        found = both(F.array(*[c.cast("double") for c in inputs]))
        return {name: found[t] for t, name in enumerate(names)}


def fit_two_tasks(examples: DataFrame, inputs: tuple[str, ...], labels: tuple[str, str], steps: int = 40, rate: float = 0.05, polish: int = 8) -> TwoTasks:
    """All parts fitted together on clicks plus half the conversions; then the heads, whose loss is convex, to their optimum.

    At the end each head's predictions sum to its labels, alone and times every input: its biases and direct weights are free.
    """
    rows = examples.select(F.array(*[F.col(c).cast("double") for c in inputs]).alias("x"), F.array(*[F.col(c).cast("double") for c in labels]).alias("y"))
    stats = examples.agg(F.count(F.lit(1)).alias("n"), *[f(F.col(c).cast("double")).alias(f"{f.__name__}_{c}") for c in inputs for f in (F.avg, F.stddev_pop)]).first()
    n, d = stats["n"], len(inputs)
    model = TwoTasks(*(np.array([stats[f"{f.__name__}_{c}"] or 0.0 for c in inputs]) for f in (F.avg, F.stddev_pop)))
    if not n:
        return model
    free = model.shapes.size - 2 * d - 2  # biases of the heads and their direct weights come last and are not held back

    def over(partial: Callable[[np.ndarray, np.ndarray], np.ndarray], size: int) -> np.ndarray:
        return summed(rows, lambda batch: partial(model.inputs(matrix(batch.column("x"), d)), matrix(batch.column("y"), 2)), size)

    def joint(flat: np.ndarray) -> tuple[float, np.ndarray]:
        found = over(lambda x, y: model.gradient(x, y, flat), model.shapes.size + 1) / n
        held = np.where(np.arange(len(flat)) < free, RIDGE * flat, 0)
        return found[0] + 0.5 * float(held @ flat), found[1:] + held

    model.flat = descend(model.flat, joint, steps, rate)
    width = WIDTH + d + 1
    ridge = np.diag([RIDGE] * WIDTH + [0.0] * (d + 1))
    for _ in range(polish):
        flat = model.flat
        found = over(lambda x, y: model.head_sums(x, y, flat), 2 * (width + width * width)) / n
        p, most = model.shapes.split(flat.copy()), 0.0
        for t in range(2):
            part = found[t * (width + width * width) :][: width + width * width]
            theta = np.concatenate([p["w"][t], p["v"][t], p["k"][t : t + 1]])
            g, h = part[:width] + ridge @ theta, part[width:].reshape(width, width) + ridge
            step = np.linalg.lstsq(h, g, rcond=1e-12)[0]
            step *= min(1.0, 4.0 / max(np.abs(step).max(), 1e-300))  # far steps are shortened
            theta -= step
            most = max(most, float(np.abs(g).max()))
            p["w"][t], p["v"][t], p["k"][t] = theta[:WIDTH], theta[WIDTH:-1], theta[-1]
        model.flat = model.shapes.join(p)
        if most < 1e-10:
            break
    return model


@dataclass
class Neighbourhood:
    """One hidden layer over a node's own features beside the mean of its neighbours', and a logistic output."""

    mean: np.ndarray
    spread: np.ndarray
    hidden: int = 16
    shapes: Shapes = field(init=False)
    flat: np.ndarray = field(init=False)

    def __post_init__(self):
        self.shapes = Shapes(W=(len(self.mean), self.hidden), b=(self.hidden,), w=(self.hidden,), k=(1,))
        rng = np.random.default_rng(29)
        p = self.shapes.split(rng.normal(size=self.shapes.size))
        self.flat = self.shapes.join({"W": p["W"] / max(1.0, np.sqrt(len(self.mean))), "b": 0.1 * p["b"], "w": 0.3 * p["w"], "k": np.zeros(1)})

    def inputs(self, raw: np.ndarray) -> np.ndarray:
        return np.divide(raw - self.mean, self.spread, out=np.zeros_like(raw), where=self.spread > 0)

    def forward(self, x: np.ndarray, p: dict[str, np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
        hidden = np.maximum(x @ p["W"] + p["b"], 0)
        return hidden, hidden @ p["w"] + p["k"]

    def gradient(self, x: np.ndarray, y: np.ndarray, flat: np.ndarray) -> np.ndarray:
        p = self.shapes.split(flat)
        hidden, z = self.forward(x, p)
        off = sigmoid(z) - y
        d_hidden = off[:, None] * p["w"] * (hidden > 0)
        g = {"W": x.T @ d_hidden, "b": d_hidden.sum(axis=0), "w": hidden.T @ off, "k": off.sum(keepdims=True)}
        return np.append(log_loss(y, z), self.shapes.join(g))

    def score(self, features: Column) -> Column:
        width, flat = len(self.mean), self.flat

        @F.pandas_udf("double")
        def risk(vectors: pd.Series) -> pd.Series:
            if not len(vectors):
                return pd.Series([], dtype=float)
            x = self.inputs(np.stack(vectors.to_numpy()).astype(float).reshape(-1, width))
            return pd.Series(sigmoid(self.forward(x, self.shapes.split(flat))[1]))

        return risk(features)


def fit_neighbourhood(rows: DataFrame, steps: int, rate: float = 0.1, features: str = "x", label: str = "label") -> Neighbourhood | None:
    """The network of rows with an array of features and a 0/1 label; None without rows. Both layers are fitted together."""
    first = rows.select(F.size(features).alias("n")).first()
    if first is None:
        return None
    d = first.n
    given = rows.select(F.col(features).cast("array<double>").alias("x"), F.col(label).cast("double").alias("y"))
    # number of rows, sums and sums of squares
    moments = summed(given, lambda b: np.concatenate([[b.num_rows], (x := matrix(b.column("x"), d)).sum(axis=0), (x * x).sum(axis=0)]), 2 * d + 1)
    n, mean = moments[0], moments[1 : d + 1] / moments[0]
    variance = moments[d + 1 :] / n - mean * mean
    model = Neighbourhood(mean, np.sqrt(np.where(variance > 1e-12 * mean * mean, variance, 0)))  # a constant has none but rounding

    def joint(flat: np.ndarray) -> tuple[float, np.ndarray]:
        found = summed(given, lambda b: model.gradient(model.inputs(matrix(b.column("x"), d)), b.column("y").to_numpy(), flat), model.shapes.size + 1) / n
        held = RIDGE * flat
        held[-1] = 0
        return found[0] + 0.5 * float(held @ flat), found[1:] + held

    model.flat = descend(model.flat, joint, steps, rate)
    return model

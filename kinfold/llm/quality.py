"""Quality by attention-based multiple-instance learning.

A text is a bag of passages of ``PASSAGE`` words. Each passage becomes a vector of ratios and of shares of word shapes,
an encoder maps it to a hidden vector, gated attention weighs the passages (tanh times sigmoid units), and a logistic
unit scores the weighted sum. Only the label of the whole text is given; the passage weights are learned.

The model has a few thousand weights. It is fitted in numpy on at most ``sample`` labelled texts, half of each label,
those with the least hash of their id; every text is scored with all its passages.

Defined cases: a text without words is one passage of zeros; label rows that are null are ignored, of several labels
the lowest counts; without labels of both kinds every score is 0.5; repeated rows are scored each; other columns are
not read.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from kinfold.llm.common import Words, flat, fold, map_batches, save, workspace
from kinfold.llm.statistics import _CONTINUES, _DIGIT, _LETTER, _SYMBOL, _UPPER, _with_text, repeated_words

PASSAGE = 64
SHAPES = 32
RATIOS = 11
SAMPLE = 4_000
HIDDEN = 24
ATTENTION = 16

#: Class of each byte by which word shapes are told apart.
_CLASS = np.full(256, 6, np.int64)
_CLASS[0x61:0x7B] = 0
_CLASS[_UPPER] = 1
_CLASS[_DIGIT] = 2
_CLASS[0x80:] = 3
_CLASS[_SYMBOL] = 4
_CLASS[list(b".,;:'\"()-")] = 5


def encode(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Vectors of all passages, and ``n + 1`` bounds of the texts among them."""
    data, offsets = flat(column)
    words = Words(data, offsets)
    hashes = words.hashes()
    per_text = np.maximum(-(-words.count // PASSAGE), 1)
    bounds = np.concatenate([[0], np.cumsum(per_text)])
    out = np.zeros((int(bounds[-1]), RATIOS + SHAPES))
    if not len(words.starts):
        return out, bounds
    place = np.arange(len(words.starts)) - words.bounds[words.doc]
    passage = bounds[words.doc] + place // PASSAGE
    first = np.flatnonzero(np.concatenate([[True], passage[1:] != passage[:-1]]))
    rows = passage[first]
    last = np.append(first[1:], len(passage)) - 1
    n = last - first + 1

    def inside(mask: np.ndarray) -> np.ndarray:
        total = np.concatenate([[0], np.cumsum(mask, dtype=np.int64)])
        return total[words.ends[last]] - total[words.starts[first]]

    chars = np.maximum(inside(words.inside & ~_CONTINUES[data]), 1)
    ends = _LETTER[data[words.ends - 1]]
    _, once = np.unique(_with_text(hashes, passage), return_index=True)
    again = np.concatenate([[0], np.cumsum(repeated_words(hashes, words))])
    closed = np.concatenate([[0], np.cumsum(~ends)])
    out[rows, 0] = np.log1p(n)
    out[rows, 1] = chars / n
    for i, mask in enumerate((_SYMBOL[data], _UPPER[data], _DIGIT[data], words.inside & ~_LETTER[data] & ~_DIGIT[data])):
        out[rows, 2 + i] = inside(mask) / chars
    out[rows, 6] = (closed[last + 1] - closed[first]) / n
    out[rows, 7] = np.bincount(passage[once], minlength=len(out))[rows] / n
    out[rows, 8] = (again[last + 1] - again[first]) / n
    out[rows, 9] = inside(data == 0x0A) / n
    out[:, 10] = np.log1p(np.repeat(words.count, per_text))
    size = np.digitize(words.ends - words.starts, [2, 4, 8, 16])
    shape = (_CLASS[data[words.starts]] * 35 + _CLASS[data[words.ends - 1]] * 5 + size) * 2654435761 % 2**32 * SHAPES // 2**32
    shares = np.bincount(passage * SHAPES + shape, minlength=len(out) * SHAPES).reshape(-1, SHAPES)
    out[rows, RATIOS:] = shares[rows] / n[:, None]
    return out, bounds


class Network:
    """Encoder, gated attention and classifier; ``w`` holds the weights by name."""

    def __init__(self, w: dict[str, np.ndarray], mean: np.ndarray, scale: np.ndarray):
        self.w, self.mean, self.scale = w, mean, scale

    def forward(self, x: np.ndarray, bounds: np.ndarray) -> dict[str, np.ndarray]:
        w, starts, sizes = self.w, bounds[:-1], np.diff(bounds)
        h = np.tanh(x @ w["W"] + w["b"])
        t, g = np.tanh(h @ w["V"]), 1 / (1 + np.exp(-(h @ w["U"])))
        e = (t * g) @ w["a"]
        e = np.exp(e - np.repeat(np.maximum.reduceat(e, starts), sizes))
        a = e / np.repeat(np.add.reduceat(e, starts), sizes)
        z = np.add.reduceat(a[:, None] * h, starts)
        p = 1 / (1 + np.exp(-np.clip(z @ w["c"] + w["d"], -30, 30)))
        return {"h": h, "t": t, "g": g, "a": a, "z": z, "p": p}

    def score(self, x: np.ndarray, bounds: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Probability of each text, and the weight of each passage."""
        out = self.forward((x - self.mean) / self.scale, bounds)
        return out["p"], out["a"]


def fit(x: np.ndarray, bounds: np.ndarray, y: np.ndarray, steps: int = 400, rate: float = 0.02, decay: float = 1e-4) -> Network:
    """Adam on the cross-entropy of whole texts; both labels weigh the same."""
    rng = np.random.default_rng(7)
    mean, scale = x.mean(0), np.maximum(x.std(0), 1e-3)
    x = ((x - mean) / scale).clip(-8, 8)
    w = {
        "W": rng.normal(0, 0.2, (x.shape[1], HIDDEN)), "b": np.zeros(HIDDEN), "V": rng.normal(0, 0.3, (HIDDEN, ATTENTION)),
        "U": rng.normal(0, 0.3, (HIDDEN, ATTENTION)), "a": rng.normal(0, 0.3, ATTENTION), "c": rng.normal(0, 0.3, HIDDEN), "d": np.zeros(1),
    }
    net = Network(w, mean, scale)
    starts, sizes = bounds[:-1], np.diff(bounds)
    weight = np.where(y == 1, 0.5 / max((y == 1).sum(), 1), 0.5 / max((y == 0).sum(), 1))
    first, second = ({k: np.zeros_like(v) for k, v in w.items()} for _ in range(2))
    for step in range(1, steps + 1):
        f = net.forward(x, bounds)
        error = (f["p"] - y) * weight
        dz = np.repeat(error[:, None] * w["c"], sizes, axis=0)
        da = (dz * f["h"]).sum(1)
        de = f["a"] * (da - np.repeat(np.add.reduceat(f["a"] * da, starts), sizes))
        dt = de[:, None] * w["a"] * f["g"] * (1 - f["t"] ** 2)
        dg = de[:, None] * w["a"] * f["t"] * f["g"] * (1 - f["g"])
        dh = f["a"][:, None] * dz + dt @ w["V"].T + dg @ w["U"].T
        dx = dh * (1 - f["h"] ** 2)
        slope = {
            "W": x.T @ dx, "b": dx.sum(0), "V": f["h"].T @ dt, "U": f["h"].T @ dg,
            "a": (f["t"] * f["g"]).T @ de, "c": f["z"].T @ error, "d": np.array([error.sum()]),
        }
        for k in w:
            grad = slope[k] + decay * w[k]
            first[k] = 0.9 * first[k] + 0.1 * grad
            second[k] = 0.999 * second[k] + 0.001 * grad**2
            w[k] -= rate * (first[k] / (1 - 0.9**step)) / (np.sqrt(second[k] / (1 - 0.999**step)) + 1e-8)
    return net


def _bags(batch: pa.RecordBatch) -> dict:
    x, bounds = encode(batch.column("text"))
    x = x.astype("<f4")
    return {"quality": batch.column("quality"), "bag": [x[a:b].tobytes() for a, b in zip(bounds[:-1], bounds[1:], strict=True)]}


def _score(net: Network | None, kept: list[str]):
    def make(batch: pa.RecordBatch) -> dict:
        out = {c: batch.column(c) for c in kept}
        x, bounds = encode(batch.column("text"))
        if net is None:
            p, a = np.full(batch.num_rows, 0.5), np.repeat(1 / np.diff(bounds), np.diff(bounds))
        else:
            x = net.mean + ((x - net.mean) / net.scale).clip(-8, 8) * net.scale
            p, a = net.score(x, bounds)
        return out | {"score": p, "weights": pa.ListArray.from_arrays(pa.array(bounds.astype(np.int32)), pa.array(a.astype(np.float32)))}

    return make


def learn(docs: DataFrame, labels: DataFrame, scratch, sample: int = SAMPLE) -> Network | None:
    marks = labels.filter("quality in (0, 1) and doc_id is not null").groupBy(F.col("doc_id").alias("labelled")).agg(F.min("quality").alias("quality"))
    order = [F.xxhash64("labelled"), F.col("labelled")]
    some = [marks.filter(F.col("quality") == v).orderBy(*order).limit(sample // 2) for v in (0, 1)]
    chosen = save(scratch, some[0].unionByName(some[1]), "chosen")
    # At most ``sample`` rows are broadcast.
    texts = docs.select("doc_id", "text").join(F.broadcast(chosen), F.col("doc_id") == F.col("labelled"))
    rows = map_batches(texts.select("quality", "text"), _bags, "quality int, bag binary").orderBy("quality", F.xxhash64("bag")).toArrow()
    y = rows["quality"].to_numpy()
    if len(set(y.tolist())) < 2:
        return None
    bags = [np.frombuffer(b, "<f4").reshape(-1, RATIOS + SHAPES) for b in rows["bag"].to_pylist()]
    return fit(np.concatenate(bags).astype(float), np.concatenate([[0], np.cumsum([len(b) for b in bags])]), y)


def quality(docs: DataFrame, labels: DataFrame, parts: int = 5, held: int = 0, sample: int = SAMPLE) -> DataFrame:
    """``docs`` with ``score`` and the ``weights`` of the passages; columns with those names are replaced.

    Rows with ``crc32(doc_id) mod parts = held`` lend no label.
    """
    scratch = workspace(docs.sparkSession, "quality")
    net = learn(docs, labels.filter(fold("doc_id", parts) != held), scratch, sample)
    kept = [c for c in docs.columns if c.lower() not in ("score", "weights")]
    read = docs.select(*[F.col(f"`{c}`") for c in kept])
    ddl = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in read.schema)
    return map_batches(read, _score(net, kept), f"{ddl}, score double, weights array<float>")

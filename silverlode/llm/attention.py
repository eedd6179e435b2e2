"""Quality scores by attention-based multiple-instance learning: a document is a bag of passages."""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

PASSAGE_WORDS = 64
BUCKETS = 96
HIDDEN = 24
ATTENTION = 16
# The bound of the sample that the model is fitted on: labelled documents of each class, lowest hashes first.
TRAIN_PER_CLASS = 2000
EPOCHS = 40
SEED = 31

_KINDS = ("upper", "lower", "digit", "symbol", "stop", "other")
FEATURES = BUCKETS + len(_KINDS) + 4


def passages(text: str | None) -> np.ndarray:
    """A row of features for every passage of 64 words; a text without words is one empty passage.

    Shares of the passage's hashed character pairs, shares of kinds of characters, and four measures of its words: mean
    length, share of different words, share of words without a letter, and how full the passage is.
    """
    words = (text or "").split()
    rows = []
    for i in range(0, max(len(words), 1), PASSAGE_WORDS):
        part = words[i : i + PASSAGE_WORDS]
        row = np.zeros(FEATURES, np.float32)
        line = " ".join(part)
        points = np.frombuffer(line.encode("utf-32-le", "surrogatepass"), "<u4").astype(np.int64)
        if len(points) > 1:
            pairs = (points[:-1] * 1_000_003 + points[1:] * 7919) % 8191 % BUCKETS
            row[:BUCKETS] = np.sqrt(np.bincount(pairs, minlength=BUCKETS) / len(pairs))
        if len(points):
            upper = np.mean([c.isupper() for c in line])
            lower = np.mean([c.islower() for c in line])
            digit = np.mean((points >= 48) & (points <= 57))
            stop = np.mean((points == 44) | (points == 46))
            space = np.mean(points == 32)
            symbol = max(0.0, 1 - upper - lower - digit - stop - space)
            row[BUCKETS : BUCKETS + len(_KINDS)] = np.sqrt([upper, lower, digit, symbol, stop, space])
            row[-4:] = (
                np.log1p(len(line) / len(part)),
                len(set(part)) / len(part),
                np.mean([not any(c.isalpha() for c in w) for w in part]),
                len(part) / PASSAGE_WORDS,
            )
        rows.append(row)
    return np.stack(rows)


@dataclass
class Attention:
    """Encoder, gated attention and head: h = relu(xW + b), a = softmax(w(tanh(hV) * sigmoid(hU))), score = sigmoid(c . sum a h)."""

    mean: np.ndarray
    spread: np.ndarray
    weights: dict[str, np.ndarray]

    def _forward(self, x: np.ndarray, bag: np.ndarray, bags: int) -> dict[str, np.ndarray]:
        w = self.weights
        h = np.maximum(x @ w["W"] + w["b"], 0)
        t, s = np.tanh(h @ w["V"]), 1 / (1 + np.exp(-(h @ w["U"])))
        e = (t * s) @ w["w"]
        top = np.full(bags, -np.inf)
        np.maximum.at(top, bag, e)
        a = np.exp(e - top[bag])
        a /= np.bincount(bag, a, bags)[bag]
        z = np.zeros((bags, h.shape[1]))
        np.add.at(z, bag, a[:, None] * h)
        p = 1 / (1 + np.exp(-np.clip(z @ w["c"] + w["d"], -30, 30)))
        return {"h": h, "t": t, "s": s, "a": a, "z": z, "p": p}

    def scores(self, bags: list[np.ndarray]) -> np.ndarray:
        if not bags:
            return np.empty(0)
        x = (np.concatenate(bags) - self.mean) / self.spread
        return self._forward(x, np.repeat(np.arange(len(bags)), [len(b) for b in bags]), len(bags))["p"]

    def gradients(self, x: np.ndarray, bag: np.ndarray, y: np.ndarray, weight: np.ndarray) -> dict[str, np.ndarray]:
        w, f = self.weights, self._forward(x, bag, len(y))
        err = (f["p"] - y) * weight / weight.sum()
        dz = err[:, None] * w["c"]
        dh = f["a"][:, None] * dz[bag]
        pull = (dz[bag] * f["h"]).sum(1)
        de = f["a"] * (pull - np.bincount(bag, f["a"] * pull, len(y))[bag])
        gate = de[:, None] * w["w"]
        dt, ds = gate * f["s"] * (1 - f["t"] ** 2), gate * f["t"] * f["s"] * (1 - f["s"])
        dh += dt @ w["V"].T + ds @ w["U"].T
        dh *= f["h"] > 0
        return {
            "W": x.T @ dh,
            "b": dh.sum(0),
            "V": f["h"].T @ dt,
            "U": f["h"].T @ ds,
            "w": (f["t"] * f["s"]).T @ de,
            "c": f["z"].T @ err,
            "d": err.sum(keepdims=True),
        }


def fit(bags: list[np.ndarray], labels: np.ndarray, epochs: int = EPOCHS, seed: int = SEED) -> Attention:
    """Adam on the log loss of document labels, classes weighed alike. One class only, or none, gives its share as every score."""
    draw = np.random.default_rng(seed)
    shapes = {"W": (FEATURES, HIDDEN), "b": HIDDEN, "V": (HIDDEN, ATTENTION), "U": (HIDDEN, ATTENTION), "w": ATTENTION, "c": HIDDEN, "d": 1}
    weights = {k: draw.normal(0, 0.0 if k in "bd" else 0.15, s) for k, s in shapes.items()}
    x = np.concatenate(bags) if bags else np.zeros((1, FEATURES))
    model = Attention(x.mean(0), x.std(0) + 0.05, weights)
    if len(set(labels.tolist())) < 2:
        share = labels.mean() if len(labels) else 0.5
        weights["c"][:], weights["d"][:] = 0, np.log((share + 0.01) / (1.01 - share))
        return model
    x = (x - model.mean) / model.spread
    sizes = np.array([len(b) for b in bags])
    first = np.append(0, sizes.cumsum())
    balance = np.where(labels == 1, 0.5 / labels.mean(), 0.5 / (1 - labels.mean()))
    moment = {k: (np.zeros(s), np.zeros(s)) for k, s in shapes.items()}
    step = 0
    for _ in range(epochs):
        order = draw.permutation(len(bags))
        for part in np.array_split(order, max(1, len(bags) // 64)):
            step += 1
            at = np.concatenate([np.arange(first[i], first[i + 1]) for i in part])
            bag = np.repeat(np.arange(len(part)), sizes[part])
            for k, g in model.gradients(x[at], bag, labels[part], balance[part]).items():
                g = g + 1e-4 * weights[k]
                m, v = moment[k]
                m += 0.1 * (g - m)
                v += 0.001 * (g * g - v)
                weights[k] -= 0.004 * (m / (1 - 0.9**step)) / (np.sqrt(v / (1 - 0.999**step)) + 1e-8)
    return model


def held_out(doc_id: Column) -> Column:
    """Whether crc32 of the id's digits leaves 1 when divided by three; a null id is not held out."""
    return F.coalesce(F.crc32(F.encode(doc_id.cast("string"), "UTF-8")) % 3 == 1, F.lit(False))


def train(docs: DataFrame, labels: DataFrame, per_class: int = TRAIN_PER_CLASS) -> Attention:
    """A model from documents whose label may be learnt from.

    The sample holds at most ``per_class`` documents of each label, those whose ids have the lowest hashes; their passages' features
    (a few hundred bytes each) come to the driver. Repeated and null labels count like others, or not at all.
    """
    known = labels.where(F.col("quality").isin(0, 1) & F.col("doc_id").isNotNull()).select("doc_id", "quality")
    known = known.where(~held_out(F.col("doc_id"))).dropDuplicates(["doc_id", "quality"])
    order = F.xxhash64(F.lit(SEED), "doc_id")
    chosen = None
    for label in (0, 1):
        own = known.where(F.col("quality") == label).orderBy(order, "doc_id").limit(per_class)
        chosen = own if chosen is None else chosen.unionAll(own)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            features = [passages(t.as_py()).tobytes() for t in batch.column("text")]
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), batch.column("quality"), pa.array(features, pa.binary())],
                ["doc_id", "quality", "features"],
            )

    sample = docs.select("doc_id", "text").join(chosen, "doc_id").select("doc_id", F.col("quality").cast("int"), "text")
    rows = sorted(
        (r["doc_id"], r["quality"], bytes(r["features"]))
        for r in sample.mapInArrow(run, "doc_id long, quality int, features binary").toLocalIterator()
    )
    bags = [np.frombuffer(f, np.float32).reshape(-1, FEATURES) for _, _, f in rows]
    return fit(bags, np.array([q for _, q, _ in rows], float))


def score(docs: DataFrame, model: Attention, carried: list[str] | None = None) -> DataFrame:
    """``docs`` with a column ``score`` (0 to 1) from the text alone.

    Every passage of 64 words is encoded; attention weighs the passages' encodings, and the head scores their weighted sum. A null,
    empty or blank text is one empty passage. Repeated rows score alike; an empty table gives no rows. Only
    columns named in ``carried`` (all, by default) come back; one named score is replaced.
    """
    columns = [c for c in carried or docs.columns if c != "score"]
    sent = docs.sparkSession.sparkContext.broadcast(model)
    given = docs.select(F.struct(*[F.col(f"`{c}`") for c in columns]).alias("row"), "text")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts, found = batch.column("text").to_pylist(), []
            for i in range(0, len(texts), 256):
                found.append(sent.value.scores([passages(t) for t in texts[i : i + 256]]))
            values = pa.array(np.concatenate(found) if found else np.empty(0), pa.float64())
            yield pa.RecordBatch.from_arrays([batch.column("row"), values], ["row", "score"])

    schema = T.StructType([given.schema["row"], T.StructField("score", T.DoubleType())])
    return given.mapInArrow(run, schema).select("row.*", "score")

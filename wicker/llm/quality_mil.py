"""Quality classifier: attention-based multiple-instance learning.

A text is a bag of passages of ``PASSAGE`` words.  Every passage is measured and
encoded; gated attention, tanh(V h) times sigmoid(U h), gives each passage a weight
within its text; the weighted mean of the encodings is scored.  Only texts have
labels: the weights of passages are learned from them.

Training takes at most ``TRAIN_ROWS`` labelled rows, the first by a hash of their
ids, and of each at most ``TRAIN_PASSAGES`` passages, evenly spread; measuring runs
in the tasks and only measures come to the driver.  Scoring takes every passage of
every text.

Null and empty texts are one passage without words.  Repeated rows get equal
scores.  A null id counts as the empty text for the split, so it is held out.
Labels that are null are passed over, and of repeated ones the larger counts.
Other columns of the documents may have any names; ids, languages, sources and
labels are never looked at for a score.  An empty table gives no rows; without two
kinds of labels every score is the share of label 1, or 0.5.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import map_batches, text_of

PASSAGE = 64
TRAIN_ROWS = 6000
FOLDS = 5
CUT = 0.3
HIDDEN, GATES = 16, 8
ROUNDS, RATE, DECAY, SEED = 200, 0.03, 1e-4, 7

_GROUPS = (b"abcdefghijklmnopqrstuvwxyz", b"ABCDEFGHIJKLMNOPQRSTUVWXYZ", b"0123456789", b" \t\r\x0b\x0c", b"\n", b".", b",;:", b"!", b"?", b"|", b"#*$%&<>",
    b"\"'()[]{}`", b"=+/_-\\^~@", bytes(range(0x80, 0x100)))
_KIND = np.full(256, len(_GROUPS), np.uint8)
for _i, _g in enumerate(_GROUPS):
    _KIND[list(_g)] = _i
N_FEATURES = len(_GROUPS) + 1 + 5
_MULTIPLY = np.uint64(0x9E3779B97F4A7C15)


def measure(texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """(passages, N_FEATURES) and the number of passages of each text."""
    raw = [t.encode("utf-8", "surrogatepass") for t in texts]
    data = np.frombuffer(b" ".join(raw) + b" ", np.uint8)
    size = np.fromiter(map(len, raw), np.int64, len(raw)) + 1
    begin = np.cumsum(size) - size
    kind = _KIND[data]
    blank = (kind == 3) | (kind == 4)
    starts = np.flatnonzero(~blank & np.append(True, blank[:-1]))
    ends = np.flatnonzero(~blank[:-1] & blank[1:]) + 1
    text_of_word = np.searchsorted(begin, starts, "right") - 1
    words = np.bincount(text_of_word, minlength=len(raw))
    rank = np.arange(len(starts)) - (np.cumsum(words) - words)[text_of_word]
    bags = np.maximum(1, -(-words // PASSAGE))
    first = np.cumsum(bags) - bags
    passage = first[text_of_word] + rank // PASSAGE
    # A passage's bytes run from its first word's to the next one's.
    edge = np.zeros(int(bags.sum()), np.int64)
    edge[first] = begin
    opens = (rank % PASSAGE == 0) & (rank > 0)
    edge[passage[opens]] = starts[opens]
    n = len(edge)
    length = np.diff(np.append(edge, len(data)))
    share = np.stack([np.add.reduceat((kind == g).astype(np.int32), edge) / length for g in range(len(_GROUPS) + 1)], 1)
    with np.errstate(over="ignore"):
        spread = (data.astype(np.uint64) + np.uint64(1)) * _MULTIPLY
        spread ^= spread >> np.uint64(29)
        place = np.arange(len(data)) - np.maximum.accumulate(np.where(~blank & np.append(True, blank[:-1]), np.arange(len(data)), 0))
        total = np.append(np.uint64(0), np.cumsum(spread * (place.astype(np.uint64) * np.uint64(2) + np.uint64(1))))
        word = total[ends] - total[starts]
    long = (ends - starts).astype(float)
    count = np.bincount(passage, minlength=n)
    some = np.maximum(count, 1)
    mean = np.bincount(passage, long, n) / some
    sd = np.sqrt(np.maximum(np.bincount(passage, long**2, n) / some - mean**2, 0))
    order = np.lexsort((word, passage))
    p, w = passage[order], word[order]
    fresh = np.append(True, (p[1:] != p[:-1]) | (w[1:] != w[:-1]))[: len(p)]
    kinds = np.bincount(p[fresh], minlength=n) / some
    again = np.zeros(len(word), bool)
    again[1:] = (word[1:] == word[:-1]) & (text_of_word[1:] == text_of_word[:-1])
    repeats = np.bincount(passage, again, n) / some
    return np.column_stack([share, np.log1p(count), mean, sd, kinds, repeats]), bags


def _sigmoid(x: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(x, -30, 30)))


@dataclass(frozen=True)
class Model:
    """Scaling of the measures; encoder, gates and score; 0.5 without training."""

    centre: np.ndarray
    scale: np.ndarray
    w: dict[str, np.ndarray]

    def forward(self, x: np.ndarray, bags: np.ndarray) -> dict[str, np.ndarray]:
        w, at = self.w, np.cumsum(bags) - bags
        h = np.tanh(x @ w["encode"] + w["shift"])
        v, u = np.tanh(h @ w["V"]), _sigmoid(h @ w["U"])
        e = (v * u) @ w["gate"]
        e = np.exp(e - np.repeat(np.maximum.reduceat(e, at), bags))
        a = e / np.repeat(np.add.reduceat(e, at), bags)
        z = np.add.reduceat(a[:, None] * h, at)
        return {"h": h, "v": v, "u": u, "a": a, "z": z, "p": _sigmoid(z @ w["score"] + w["bias"])}

    def scaled(self, measures: np.ndarray) -> np.ndarray:
        return np.clip((measures - self.centre) / self.scale, -5, 5)

    def score(self, measures: np.ndarray, bags: np.ndarray) -> np.ndarray:
        """Score of each text."""
        return self.forward(self.scaled(measures), bags)["p"]


def train(measures: np.ndarray, bags: np.ndarray, labels: np.ndarray) -> Model:
    """By Adam on the logistic loss of the texts' labels."""
    rng = np.random.default_rng(SEED)
    draw = lambda *shape: rng.normal(0, shape[0] ** -0.5, shape)
    share = np.clip(labels.mean() if len(labels) else 0.5, 1e-3, 1 - 1e-3)
    w = {"encode": draw(N_FEATURES, HIDDEN), "shift": np.zeros(HIDDEN), "V": draw(HIDDEN, GATES), "U": draw(HIDDEN, GATES), "gate": draw(GATES),
        "score": np.zeros(HIDDEN), "bias": np.array(np.log(share / (1 - share)))}
    if not len(labels) or labels.min() == labels.max():
        return Model(np.zeros(N_FEATURES), np.ones(N_FEATURES), w)
    model = Model(measures.mean(0), measures.std(0) + 1e-6, w)
    x, at, n = model.scaled(measures), np.cumsum(bags) - bags, len(labels)
    first, second = ({k: np.zeros_like(v) for k, v in w.items()} for _ in range(2))
    for step in range(1, ROUNDS + 1):
        f = model.forward(x, bags)
        error = (f["p"] - labels) / n
        g = {"score": f["z"].T @ error, "bias": np.array(error.sum())}
        dz = np.repeat(error[:, None] * w["score"], bags, 0)
        da = (dz * f["h"]).sum(1)
        de = f["a"] * (da - np.repeat(np.add.reduceat(f["a"] * da, at), bags))
        vu = f["v"] * f["u"]
        g["gate"] = vu.T @ de
        dvu = de[:, None] * w["gate"]
        dv, du = dvu * f["u"] * (1 - f["v"] ** 2), dvu * f["v"] * f["u"] * (1 - f["u"])
        g["V"], g["U"] = f["h"].T @ dv, f["h"].T @ du
        dh = (f["a"][:, None] * dz + dv @ w["V"].T + du @ w["U"].T) * (1 - f["h"] ** 2)
        g["encode"], g["shift"] = x.T @ dh, dh.sum(0)
        for k in w:
            grad = g[k] + DECAY * w[k]
            first[k] = 0.9 * first[k] + 0.1 * grad
            second[k] = 0.999 * second[k] + 0.001 * grad**2
            w[k] = w[k] - RATE * (first[k] / (1 - 0.9**step)) / (np.sqrt(second[k] / (1 - 0.999**step)) + 1e-8)
    return model


def fold(doc_id: str | Column = "doc_id", folds: int = FOLDS) -> Column:
    """crc32 of the id as text, modulo ``folds``; 0 for a null id."""
    c = F.col(doc_id) if isinstance(doc_id, str) else doc_id
    return F.crc32(F.coalesce(c.cast("string"), F.lit("")).cast("binary")) % folds


def fit(docs: DataFrame, labels: DataFrame, text: str = "text", doc_id: str = "doc_id", label: str = "quality", rows: int = TRAIN_ROWS) -> Model:
    """A model of the labels outside fold 0."""
    known = labels.where(F.col(label).isNotNull() & F.col(doc_id).isNotNull() & (fold(doc_id) != 0))
    known = known.groupBy(F.col(doc_id).alias("id")).agg(F.max(label).cast("int").alias("label"))
    known = F.broadcast(known.orderBy(F.xxhash64("id"), "id").limit(rows))  # ``rows`` of two numbers
    source = docs.select(F.col(doc_id).alias("id"), text_of(text).alias("text")).join(known, "id").select("id", "label", "text")

    def run(batch: pa.RecordBatch) -> pa.RecordBatch:
        x, bags = measure(batch.column(2).to_pylist())
        parts = [part.astype(np.float32).tobytes() for part in np.split(x, np.cumsum(bags)[:-1])]
        return pa.RecordBatch.from_arrays([batch.column(0).cast(pa.int64()), batch.column(1), pa.array(parts, pa.binary())], ["id", "label", "x"])

    got = map_batches(source, run, "id long, label int, x binary").orderBy("id", "x").toArrow()
    bags_ = [np.frombuffer(b, np.float32).reshape(-1, N_FEATURES) for b in got.column("x").to_pylist()]
    x = np.concatenate(bags_).astype(float) if bags_ else np.zeros((0, N_FEATURES))
    return train(x, np.array(list(map(len, bags_)), np.int64), np.array(got.column("label").to_pylist(), float))


def score_documents(docs: DataFrame, model: Model, text: str = "text", doc_id: str = "doc_id") -> DataFrame:
    """doc_id, held_out, score, predicted, n_passages of every row."""
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def run(batch: pa.RecordBatch) -> pa.RecordBatch:
        x, bags = measure(batch.column(2).to_pylist())
        p = shared.value.score(x, bags)
        return pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(p), pa.array((p >= CUT).astype(np.int32)), pa.array(bags, pa.int64())], ["doc_id",
            "held_out", "score", "predicted", "n_passages"])

    source = docs.select(F.col(doc_id).cast("long").alias("doc_id"), (fold(doc_id) == 0).alias("held_out"), text_of(text).alias("text"))
    return map_batches(source, run, "doc_id long, held_out boolean, score double, predicted int, n_passages long")

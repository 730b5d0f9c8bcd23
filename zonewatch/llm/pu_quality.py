"""Quality classifier (operator 1): positive-unlabelled learning.

Trusted positives are documents labelled quality 1; unlabelled text is a
sample of all training documents, labels hidden.  A logistic model of
standardised features minimises the non-negative unbiased risk

    prior * R_p(+) + max(0, R_u(-) - prior * R_p(-)),

and where the bracket is negative steps back up its gradient.  The prior is
estimated from the two samples alone: a positive-against-unlabelled model is
fitted on one half of each, and on the other half the smallest ratio of tail
shares, unlabelled over positive (the best bin), bounds the share of positives.

The samples are bounded by ``SAMPLE_POSITIVE`` and ``SAMPLE_UNLABELLED``: the
documents whose salted id hashes are smallest, so a run repeats exactly.  Every
document is scored over its whole text.  Features: shares of word shapes
(letters, capitals, digits, signs; hashed into ``SHAPES`` places) and a few
figures about lengths and repetition.

Cases: a null text is empty; it has a score from its zero features.  A null
doc_id is never held out nor labelled.  Labels that are null or repeat are
ignored or counted once.  Without a positive, nothing can be rejected: every
score is 1.  An empty table gives an empty result.  Extra columns are ignored.
"""

from __future__ import annotations

import re
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from zonewatch.llm.common import SPACE, Words, slices, utf8

SAMPLE_POSITIVE, SAMPLE_UNLABELLED = 6000, 12000
FOLDS = 5
THRESHOLD = 0.3
SHAPES, FIGURES = 256, 8
STEPS, RATE, DECAY, CLIP = 400, 0.05, 1e-3, 6.0

_TABLE = bytes(97 if 97 <= b <= 122 or b >= 128 else 65 if 65 <= b <= 90 else 48 if 48 <= b <= 57 else b for b in range(256))
_RUN = re.compile(rb"([aA0])\1+")
_CAPITALS, _DIGITS = bytes(range(65, 91)), bytes(range(48, 58))
_LETTERS = bytes(range(97, 123)) + _CAPITALS + bytes(range(128, 256))


def _shape(word: bytes) -> int:
    return xxhash.xxh3_64_intdigest(_RUN.sub(rb"\1", word.translate(_TABLE))) % SHAPES


_shapes = Words(_shape)


def features(text: bytes) -> np.ndarray:
    """Shares of word shapes, then figures; all zero for a text without words."""
    out = np.zeros(SHAPES + FIGURES, np.float32)
    words = text.split()
    if not words:
        return out
    n = len(words)
    out[:SHAPES] = np.bincount(np.fromiter(map(_shapes.__getitem__, words), np.int64, n), minlength=SHAPES) / n
    solid = text.translate(None, SPACE)
    letters = len(solid) - len(solid.translate(None, _LETTERS))
    lines = [x for x in text.split(b"\n") if x.strip(SPACE)]
    out[SHAPES:] = (
        np.log1p(n) / 10, len(set(words)) / n, 1 - len(set(lines)) / len(lines), min(len(solid) / n, 50) / 10,
        letters / len(solid), (len(solid) - len(solid.translate(None, _CAPITALS))) / len(solid),
        (len(solid) - len(solid.translate(None, _DIGITS))) / len(solid), len(set(words)) / n ** 0.8 / 5)
    return out


def _softplus(x: np.ndarray) -> np.ndarray:
    return np.logaddexp(0, x)


def _sigmoid(x: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(x, -40, 40)))


def _descend(x: np.ndarray, slope: Callable[[np.ndarray], np.ndarray]) -> np.ndarray:
    """Weights after Adam steps down ``slope``, which maps outputs to d risk / d output."""
    w, m, v = np.zeros(x.shape[1]), np.zeros(x.shape[1]), np.zeros(x.shape[1])
    for step in range(1, STEPS + 1):
        g = x.T @ slope(x @ w) + DECAY * w
        m, v = 0.9 * m + 0.1 * g, 0.999 * v + 0.001 * g * g
        w = w - RATE * (m / (1 - 0.9 ** step)) / (np.sqrt(v / (1 - 0.999 ** step)) + 1e-8)
    return w


def nn_risk_slope(f: np.ndarray, n_pos: int, prior: float) -> np.ndarray:
    """Slope of the non-negative risk; the first ``n_pos`` outputs are positives'."""
    p, u = f[:n_pos], f[n_pos:]
    out = np.zeros(len(f))
    negative = _softplus(u).mean() - prior * _softplus(p).mean()
    sign = 1.0 if negative >= 0 else -1.0
    out[:n_pos] = -sign * prior * _sigmoid(p) / n_pos
    out[n_pos:] = sign * _sigmoid(u) / len(u)
    if negative >= 0:
        out[:n_pos] -= prior * _sigmoid(-p) / n_pos
    return out


def estimate_prior(pos: np.ndarray, unl: np.ndarray) -> float:
    """Share of positives among the unlabelled, from held-back halves of both samples."""
    half_p, half_u = len(pos) // 2, len(unl) // 2
    if half_p < 20 or half_u < 20:
        return 0.5
    x = np.vstack([pos[:half_p], unl[:half_u]])

    def slope(f: np.ndarray) -> np.ndarray:
        out = _sigmoid(f)
        out[:half_p] = -_sigmoid(-f[:half_p]) / half_p
        out[half_p:] /= half_u
        return out

    w = _descend(x, slope)
    p, u = np.sort(pos[half_p:] @ w), np.sort(unl[half_u:] @ w)
    cuts = np.unique(np.concatenate([p, u]))
    tail_p = 1 - np.searchsorted(p, cuts) / len(p)
    tail_u = 1 - np.searchsorted(u, cuts) / len(u)
    good = tail_p >= 0.05
    slack = np.sqrt(np.log(40) / 2) * (1 / np.sqrt(len(p)) + 1 / np.sqrt(len(u)))
    best = np.argmin((tail_u[good] + slack) / tail_p[good])
    return float(np.clip(tail_u[good][best] / tail_p[good][best], 0.05, 0.99))


class Model:
    """Standardisation, weights and the estimated prior."""

    def __init__(self, pos: np.ndarray, unl: np.ndarray):
        self.prior = 1.0
        self.weights: np.ndarray | None = None
        if not len(pos) or not len(unl):
            return
        self.mean, self.std = unl.mean(axis=0), np.maximum(unl.std(axis=0), 1e-3)
        pos, unl = self._scale(pos), self._scale(unl)
        self.prior = estimate_prior(pos, unl)
        x = np.vstack([pos, unl])
        self.weights = _descend(x, lambda f: nn_risk_slope(f, len(pos), self.prior))

    def _scale(self, x: np.ndarray) -> np.ndarray:
        z = np.clip((x.astype(np.float64) - self.mean) / self.std, -CLIP, CLIP)
        return np.hstack([z, np.ones((len(z), 1))])

    def scores(self, x: np.ndarray) -> np.ndarray:
        if self.weights is None:
            return np.ones(len(x))
        return _sigmoid(self._scale(x) @ self.weights)


def _matrix(texts: list[bytes]) -> np.ndarray:
    return np.stack([features(t) for t in texts])


def _featured(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    schema = pa.schema([("rank", pa.int64()), ("positive", pa.bool_()), ("x", pa.binary())])
    for part in parts:
        rows = _matrix(utf8(part.column(2))) if part.num_rows else []
        yield pa.RecordBatch.from_arrays([part.column(0), part.column(1), pa.array([r.tobytes() for r in rows], pa.binary())],
                                         schema=schema)


def held_out(doc_id):
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % FOLDS == 0, F.lit(False))


def fit(docs: DataFrame, labels: DataFrame) -> Model:
    """A model of at most SAMPLE_POSITIVE + SAMPLE_UNLABELLED documents outside the held-out fold."""
    def least(ids: DataFrame, salt: int, most: int) -> DataFrame:
        # repeated ids count once: ties in the order would make the sample depend on the plan
        return ids.distinct().withColumn("rank", F.xxhash64(F.lit(salt), "doc_id")).orderBy("rank", "doc_id").limit(most)

    ids = docs.select(docs["doc_id"].cast("long").alias("doc_id")).filter(F.col("doc_id").isNotNull())
    trusted = labels.filter(labels["quality"] == 1).select(labels["doc_id"].cast("long").alias("doc_id"))
    chosen = [least(t.filter(~held_out(F.col("doc_id"))), salt, most).select(
        F.col("doc_id").alias("_id"), "rank", F.lit(positive).alias("positive"))
        for salt, (t, most, positive) in enumerate([
            (trusted.join(ids, "doc_id", "left_semi"), SAMPLE_POSITIVE, True), (ids, SAMPLE_UNLABELLED, False)])]
    sample = chosen[0].unionByName(chosen[1])  # bounded by the two parameters, so it may be broadcast
    rows = docs.join(F.broadcast(sample), docs["doc_id"] == sample["_id"]).select("rank", "positive", docs["text"]).mapInArrow(
        _featured, "rank long, positive boolean, x binary").toArrow()
    x = np.frombuffer(b"".join(rows.column("x").to_pylist()), np.float32).reshape(-1, SHAPES + FIGURES)
    order = np.lexsort((rows.column("rank").to_numpy(),))
    positive = np.array(rows.column("positive").to_pylist(), bool)
    return Model(x[order[positive[order]]], x[order[~positive[order]]])


def _scorer(model: Model):
    def score(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        schema = pa.schema([("doc_id", pa.int64()), ("score", pa.float64())])
        for part in parts:
            ids, texts = part.column(0), utf8(part.column(1))
            for at, to in slices(texts, 1 << 20):
                yield pa.RecordBatch.from_arrays([ids.slice(at, to - at), pa.array(model.scores(_matrix(texts[at:to])))],
                                                 schema=schema)
    return score


def score_documents(docs: DataFrame, model: Model) -> DataFrame:
    """doc_id, held_out, score, predicted for every document."""
    scored = docs.select(docs["doc_id"].cast("long").alias("doc_id"), docs["text"].alias("text")).mapInArrow(
        _scorer(model), "doc_id long, score double")
    return scored.select("doc_id", held_out(F.col("doc_id")).alias("held_out"), "score",
                         (F.col("score") >= THRESHOLD).cast("int").alias("predicted"))

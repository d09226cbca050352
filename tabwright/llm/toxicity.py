"""Toxicity scores from confirmed toxic examples and unlabelled text.

Non-negative positive-unlabelled learning (a linear model with sigmoid loss in numpy): the risk of
a classifier is estimated from positives P and unlabelled text U as

    prior * R_P(+)  +  max(0, R_U(-) - prior * R_P(-))

where R_X(s) is the mean loss of calling the rows of X the sign s. The part in brackets estimates
the risk on the unseen negatives. It cannot be negative; where a step would make it so, the model
fits positives among the unlabelled rows, and the step is taken back.
"""

from __future__ import annotations

import zlib
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tabwright.llm.common import slices, with_field
from tabwright.llm.encode import Memory, keep_only

#: Hash buckets of the features.
BUCKETS = 1 << 20
#: Characters that end a word, and leading characters of a word that count as features too.
PUNCTUATION = ".,;:!?\"'()[]{}«»“”„…"
STEMS = (4, 5, 6)
#: Scores from here on say toxic.
THRESHOLD = 0.7


@dataclass(frozen=True)
class Learning:
    """Sizes of the sample that a model is fitted on, and the steps of the fit."""

    positives: int = 8_000      #: confirmed toxic documents at most (chosen by hash)
    unlabelled: int = 24_000    #: unlabelled documents at most (chosen by hash)
    least_rows: int = 3         #: positives that a feature must occur in
    precise: float = 0.5        #: share of positives that its rows must have by the prior
    deviations: float = 5.0     #: by which it must be more frequent among positives
    epochs: int = 30
    batch: int = 512
    rate: float = 0.05
    decay: float = 1e-4
    seed: int = 42


def bucket(feature: str) -> int:
    return zlib.crc32(feature.encode()) % BUCKETS


def word_features(word: str) -> bytes:
    """Buckets of a word and of its stems, as 32-bit integers."""
    bare = word.strip(PUNCTUATION)
    if not bare:
        return b""
    found = [bucket(" " + bare), *(bucket(bare[:n]) for n in STEMS if len(bare) > n)]
    return np.array(found, np.int32).tobytes()


_WORDS = Memory(word_features, 300_000)


def text_features(text: str | None) -> np.ndarray:
    """Distinct feature buckets of a whole text, in order."""
    words = set((text or "").lower().split())
    return np.unique(np.frombuffer(b"".join(map(_WORDS.__getitem__, words)), np.int32))


def sigmoid(x: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(x, -60, 60)))


class Rows:
    """Sparse 0/1 rows over a dense range of features."""

    def __init__(self, rows: list[np.ndarray]):
        self.sizes = np.array([len(r) for r in rows], np.int64)
        self.starts = np.cumsum(self.sizes) - self.sizes
        self.cells = np.concatenate(rows) if rows else np.zeros(0, np.int64)

    def take(self, chosen: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Cells of the chosen rows, and the number of the row that each belongs to."""
        sizes = self.sizes[chosen]
        owner = np.repeat(np.arange(len(chosen)), sizes)
        inside = np.arange(len(owner)) - np.repeat(np.cumsum(sizes) - sizes, sizes)
        return self.cells[self.starts[chosen][owner] + inside], owner


def raised_features(positives: list[np.ndarray], unlabelled: list[np.ndarray], prior: float,
                    how: Learning) -> np.ndarray:
    """Features clearly more frequent among positives than among unlabelled rows, in order.

    With shares p and u of rows that have a feature, prior * p / u of its rows are positive. There is
    no least share of the positives: the words of a small language are rare among all of them.
    """
    seen, counts = np.unique(np.concatenate(positives), return_counts=True)
    common = counts >= how.least_rows
    seen, counts = seen[common], counts[common]
    others, other_counts = np.unique(np.concatenate(unlabelled), return_counts=True)
    at = np.minimum(np.searchsorted(others, seen), max(0, len(others) - 1))
    there = np.where(others[at] == seen, other_counts[at], 0) if len(others) else 0 * counts
    p, u = counts / len(positives), (there + 0.5) / (len(unlabelled) + 1)
    spread = np.sqrt(u * (1 - u) * (1 / len(positives) + 1 / len(unlabelled)))
    return seen[(prior * p >= how.precise * u) & (p - u >= how.deviations * spread)]


def fit_nnpu(positives: list[np.ndarray], unlabelled: list[np.ndarray], prior: float,
             how: Learning) -> tuple[np.ndarray, np.ndarray]:
    """Buckets and their weights (the bias last), by Adam on the non-negative risk.

    Features that are no more frequent among positives than among unlabelled rows tell nothing of
    the positive class and would only add noise to the sums of long texts; they are left out.
    """
    kept = raised_features(positives, unlabelled, prior, how)
    dims = len(kept) + 1

    def dense(rows):
        out = []
        for r in rows:
            at = np.searchsorted(kept, r)
            at[at == len(kept)] = 0
            hit = kept[at] == r if len(kept) else np.zeros(len(r), bool)
            out.append(np.append(at[hit], dims - 1))  # the last feature is the bias
        return Rows(out)

    p_rows, u_rows = dense(positives), dense(unlabelled)
    rng = np.random.default_rng(how.seed)
    w, first, second, step = np.zeros(dims), np.zeros(dims), np.zeros(dims), 0
    steps = max(1, -(-len(unlabelled) // how.batch))
    p_batch = max(1, -(-len(positives) // steps))

    def losses(rows, chosen):
        cells, owner = rows.take(chosen)
        z = np.bincount(owner, w[cells], len(chosen))
        s = sigmoid(z)
        return cells, owner, s, s * (1 - s) / len(chosen)

    for _ in range(how.epochs):
        p_order, u_order = rng.permutation(len(positives)), rng.permutation(len(unlabelled))
        for k in range(steps):
            chosen = u_order[k * how.batch:(k + 1) * how.batch]
            u_cells, u_owner, u_score, u_slope = losses(u_rows, chosen)
            p_chosen = p_order[np.arange(k * p_batch, (k + 1) * p_batch) % len(positives)]
            p_cells, p_owner, p_score, p_slope = losses(p_rows, p_chosen)
            # Loss of calling a row negative is its score, of calling it positive 1 - score.
            negative_risk = u_score.mean() - prior * p_score.mean()
            grad_p = np.bincount(p_cells, p_slope[p_owner], dims)
            grad_negative = np.bincount(u_cells, u_slope[u_owner], dims) - prior * grad_p
            grad = -prior * grad_p + grad_negative if negative_risk >= 0 else -grad_negative
            grad = grad + how.decay * w
            step += 1
            first = 0.9 * first + 0.1 * grad
            second = 0.999 * second + 0.001 * grad ** 2
            w -= how.rate * (first / (1 - 0.9 ** step)) / (
                np.sqrt(second / (1 - 0.999 ** step)) + 1e-8)
            # Raised features speak for the positive class only; so length alone never decides.
            np.maximum(w[:-1], 0, out=w[:-1])
    return kept, w


def held_out(doc_id: Column) -> Column:
    """One third of the documents, by their id."""
    return F.coalesce(F.pmod(F.crc32(doc_id.cast("string").cast("binary")), F.lit(3)) == 1,
                      F.lit(False))


def chosen_by_hash(rows: DataFrame, count: int, most: int) -> DataFrame:
    """About ``most`` of ``count`` rows, the same ones in every run; equal rows count once."""
    edge = int(min(1.0, most / max(1, count)) * (1 << 32))
    return rows.where(F.pmod(F.xxhash64(*rows.columns, F.lit(11)), F.lit(1 << 32)) <= edge).distinct()


@dataclass(frozen=True)
class Model:
    """Weights by bucket and the bias; an unfitted model has no weights and scores alike.

    The sign of the weighted sum is the decision; scores are shifted so that it falls at
    ``THRESHOLD``.
    """

    buckets: np.ndarray
    weights: np.ndarray
    bias: float

    def scores(self, texts: list[str | None]) -> np.ndarray:
        """Scores from 0 to 1 of whole texts."""
        rows = [text_features(t) for t in texts]
        sums = np.full(len(rows), self.bias)
        if len(self.buckets):
            cells = Rows(rows)
            at = np.searchsorted(self.buckets, cells.cells)
            at[at == len(self.buckets)] = 0
            hit = self.buckets[at] == cells.cells
            owner = np.repeat(np.arange(len(rows)), cells.sizes)
            sums = sums + np.bincount(owner[hit], self.weights[at[hit]], len(rows))
        return sigmoid(sums + np.log(THRESHOLD / (1 - THRESHOLD)))


def learn(docs: DataFrame, labels: DataFrame, how: Learning = Learning()) -> Model:
    """Fit a model on documents that are not held out.

    Positives are documents with a label ``toxic`` = 1; all others are unlabelled text, whatever
    their label. The prior is the share of toxic labels among the labels read. Both sets are
    bounded samples by hash (see :class:`Learning`); their features come to the driver, about 2 kB
    a document. Without positives or other text there is nothing to fit, and every text scores 0.
    """
    training = docs.select("doc_id", "text").where(~held_out(F.col("doc_id")))
    known = (labels.select("doc_id", "toxic").where(F.col("toxic").isNotNull())
             .where(~held_out(F.col("doc_id")))
             .groupBy("doc_id").agg(F.max(F.col("toxic").cast("int")).alias("toxic")))
    toxic = known.where("toxic = 1").select("doc_id")
    seen, confirmed = known.agg(F.count(F.lit(1)), F.coalesce(F.sum("toxic"), F.lit(0))).first()
    if not confirmed:
        return Model(np.zeros(0, np.int32), np.zeros(0), -60.0)
    total = training.count()
    # At most about ``how.positives`` ids, whatever the number of labels.
    picked = F.broadcast(chosen_by_hash(toxic, confirmed, how.positives))
    sample = (training.join(picked, "doc_id", "left_semi").distinct()
              .select(F.lit(True).alias("positive"), "text").unionByName(
              chosen_by_hash(training, total, how.unlabelled).join(toxic, "doc_id", "left_anti")
              .select(F.lit(False).alias("positive"), "text")))

    def features(batches):
        keep_only(_WORDS)
        for batch in slices(batches):
            rows = [text_features(t).tobytes() for t in batch.column("text").to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [batch.column("positive"), pa.array(rows, pa.binary())],
                names=["positive", "features"])

    rows = sample.mapInArrow(features, "positive boolean, features binary").toArrow()
    # A fixed order, whatever the order in which tasks ended.
    cells = sorted(zip(rows.column("positive").to_pylist(), rows.column("features").to_pylist()))
    toxic_rows = [np.frombuffer(x, np.int32) for positive, x in cells if positive]
    other_rows = [np.frombuffer(x, np.int32) for positive, x in cells if not positive]
    if not toxic_rows or not other_rows:
        return Model(np.zeros(0, np.int32), np.zeros(0), -60.0)
    kept, weights = fit_nnpu(toxic_rows, other_rows, confirmed / seen, how)
    return Model(kept, weights[:-1], float(weights[-1]))


def score(docs: DataFrame, model: Model, column: str = "score") -> DataFrame:
    """Adds ``column``, the score (0 to 1, higher: likelier toxic) of each row's whole ``text``.

    A null or empty text has no features and scores by the bias alone; every row is scored on its
    own; a column of that name is replaced; an empty table gives no rows.
    """
    rows = docs.drop(column)
    sent = rows.sparkSession.sparkContext.broadcast(model)  # at most BUCKETS weights

    def score_part(batches):
        keep_only(_WORDS)
        for batch in slices(batches):
            found = sent.value.scores(batch.column("text").to_pylist())
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(found)],
                                             names=[*batch.schema.names, column])

    return rows.mapInArrow(score_part, with_field(rows, column, "double"))

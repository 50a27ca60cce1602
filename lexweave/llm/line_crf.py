"""Document quality by a linear-chain conditional random field over lines (operator 4).

Every line is good or bad. A line's evidence is a linear function of its own
features and of its neighbours'; a chain over the lines of a document ties
labels of adjacent lines. Forward-backward gives each line's probability to be
good; their mean, weighed by the lines' lengths, is the document's quality.
Trained by gradients of the chain's likelihood on labelled documents, all of
whose lines carry the document's label.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, IntegerType, StructType

from lexweave.llm import hashing
from lexweave.llm.common import mapped, packed, slices

CLASSES = 8  # lower-case and other letters, upper case, digits, full stops and commas, '!' and '?', '|', other signs, white space
_CLASS = np.full(256, 6, np.uint8)
_CLASS[ord("a") : ord("z") + 1] = 0
_CLASS[128:] = 0
_CLASS[ord("A") : ord("Z") + 1] = 1
_CLASS[ord("0") : ord("9") + 1] = 2
_CLASS[[ord(c) for c in ".,;:'\"()-"]] = 3
_CLASS[[ord(c) for c in "!?"]] = 4
_CLASS[ord("|")] = 5
_CLASS[[0x20, *range(0x09, 0x0E)]] = 7
FEATURES = 21


def line_features(texts: list[bytes]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Features of every line, lines of each text, and their lengths in bytes; an empty text has one empty line."""
    raw = np.frombuffer(b"\n".join(texts) + b"\n", np.uint8)
    ends = np.flatnonzero(raw == 10)
    starts = np.concatenate([[0], ends[:-1] + 1])
    text_ends = np.cumsum([len(t) + 1 for t in texts])
    lines = np.diff(np.searchsorted(ends, text_ends, "left"), prepend=0)
    size = (ends - starts).astype(float)
    kinds = _CLASS[raw]
    share = np.empty((len(ends), CLASSES))
    for k in range(CLASSES):
        upto = np.zeros(len(raw) + 1, np.int32)
        np.cumsum(kinds == k, out=upto[1:])
        share[:, k] = upto[ends] - upto[starts]
    w_start, w_end, h = hashing.words(raw)
    line = np.searchsorted(ends, w_start)
    n = np.bincount(line, minlength=len(ends)).astype(float)
    mean = lambda x: np.bincount(line, x, len(ends)) / np.maximum(n, 1)
    long = (w_end - w_start).astype(float)
    same_line = np.zeros(len(h), bool)
    same_line[1:] = line[1:] == line[:-1]
    again = same_line.copy()
    again[1:] &= h[1:] == h[:-1]
    both = np.unique(h ^ hashing.mix64(line.astype(np.uint64) + np.uint64(1)), return_index=True)[1]
    distinct = np.bincount(line[both], minlength=len(ends)) / np.maximum(n, 1)
    last = kinds[np.maximum(w_end - 1, 0)]
    whole = np.maximum(size, 1)[:, None]
    out = np.empty((len(ends), FEATURES), np.float32)
    out[:, :CLASSES] = share / whole
    out[:, 8] = np.log1p(size) / 8
    out[:, 9] = np.log1p(n) / 6
    out[:, 10] = np.minimum(mean(long) / 16, 2)
    out[:, 11] = mean(again)
    out[:, 12] = np.where(n > 0, 1 - distinct, 0)
    out[:, 13] = mean(last >= 4)
    out[:, 14] = mean(long <= 3)
    out[:, 15] = np.sqrt(share[:, 4:7].sum(1) / whole[:, 0])
    out[:, 16] = np.sqrt(share[:, 1] / np.maximum(share[:, 0] + share[:, 1], 1))
    out[:, 17] = size == 0
    out[:, 18] = np.sqrt(out[:, 5])
    out[:, 19] = np.sqrt(out[:, 11])
    out[:, 20] = mean((long == 1) & (last >= 4))
    return out, lines, size


@dataclass
class Chain:
    """weights: features of the previous, this and the next line, and a constant; moves: from and to bad (0) or good (1)."""

    weights: np.ndarray
    moves: np.ndarray

    @staticmethod
    def inputs(x: np.ndarray, lines: np.ndarray) -> np.ndarray:
        """What the evidence of each line is linear in."""
        first = np.zeros(len(x), bool)
        last = np.zeros(len(x), bool)
        stop = np.cumsum(lines)
        first[(stop - lines)[lines > 0]] = True
        last[(stop - 1)[lines > 0]] = True
        before = np.where(first[:, None], 0, np.roll(x, 1, 0))
        after = np.where(last[:, None], 0, np.roll(x, -1, 0))
        return np.hstack([before, x, after, first[:, None], last[:, None], np.ones((len(x), 1))]).astype(np.float32)

    def marginals(self, evidence: np.ndarray, lines: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Each line's probability to be good; expected counts of the moves. All chains advance together."""
        base = np.cumsum(lines) - lines
        order = np.argsort(-lines, kind="stable")
        base, n = base[order], lines[order]
        longest = int(n[0]) if len(n) else 0
        active = len(n) - np.searchsorted(n[::-1], np.arange(longest), "right")
        unary = np.stack([np.zeros(len(evidence)), evidence], 1)
        ahead, back = np.zeros_like(unary), np.zeros_like(unary)
        for t in range(longest):
            at = base[: active[t]] + t
            if t == 0:
                ahead[at] = unary[at]
            else:
                f = ahead[at - 1]
                ahead[at] = unary[at] + np.logaddexp(f[:, :1] + self.moves[0], f[:, 1:] + self.moves[1])
        for t in range(longest - 2, -1, -1):
            at = base[: active[t + 1]] + t
            g = unary[at + 1] + back[at + 1]
            back[at] = np.logaddexp(g[:, :1] + self.moves[:, 0], g[:, 1:] + self.moves[:, 1])
        log_odds = (ahead + back)[:, 1] - (ahead + back)[:, 0]
        good = 1 / (1 + np.exp(-np.clip(log_odds, -60, 60)))
        later = np.ones(len(evidence), bool)
        later[base[n > 0]] = False
        at = np.flatnonzero(later)
        joint = ahead[at - 1][:, :, None] + self.moves + (unary + back)[at][:, None, :]
        joint = np.exp(joint - joint.max((1, 2), keepdims=True))
        return good, (joint / joint.sum((1, 2), keepdims=True)).sum(0)

    def score(self, x: np.ndarray, lines: np.ndarray, size: np.ndarray) -> np.ndarray:
        """Quality of each text: its lines' probabilities weighed by length."""
        good, _ = self.marginals(self.inputs(x, lines) @ self.weights, lines)
        text = np.repeat(np.arange(len(lines)), lines)
        weight = np.maximum(size, 1e-3)
        return np.bincount(text, good * weight, len(lines)) / np.maximum(np.bincount(text, weight, len(lines)), 1e-9)


def train(x: np.ndarray, lines: np.ndarray, labels: np.ndarray, rounds: int = 300, rate: float = 0.2, shrink: float = 1e-5) -> Chain:
    """Gradient ascent (Adam) on the mean log-likelihood of the lines' labels."""
    inputs = Chain.inputs(x, lines)
    y = np.repeat(labels, lines).astype(float)
    chain = Chain(np.zeros(inputs.shape[1]), np.zeros((2, 2)))
    later = np.ones(len(y), bool)
    later[(np.cumsum(lines) - lines)[lines > 0]] = False
    at = np.flatnonzero(later)
    seen = np.zeros((2, 2))
    np.add.at(seen, (y[at - 1].astype(int), y[at].astype(int)), 1)
    both = np.concatenate([chain.weights, chain.moves.ravel()])
    m, v = np.zeros_like(both), np.zeros_like(both)
    for k in range(1, rounds + 1):
        chain = Chain(both[:-4], both[-4:].reshape(2, 2))
        good, moves = chain.marginals(inputs @ chain.weights, lines)
        slope = np.concatenate([inputs.T @ (y - good), (seen - moves).ravel()]) / max(len(lines), 1) - shrink * both
        m, v = 0.9 * m + 0.1 * slope, 0.999 * v + 0.001 * slope**2
        both = both + rate * (m / (1 - 0.9**k)) / (np.sqrt(v / (1 - 0.999**k)) + 1e-8)
    return Chain(both[:-4], both[-4:].reshape(2, 2))


def held_out(id_col: Column) -> Column:
    """Documents that nothing is learned from; a null id counts as one of them."""
    return F.coalesce(F.crc32(id_col.cast("string")) % 5 == 0, F.lit(True))


def windows(lines: int, most: int, parts: int = 4) -> list[tuple[int, int]]:
    """First line and number of lines of the stretches that a text is learned by: all of it, or `parts` from all over it."""
    if lines <= most:
        return [(0, lines)]
    width = max(1, most // parts)
    return [(k * (lines - width) // max(1, parts - 1), width) for k in range(parts)]


def fit(docs: DataFrame, labels: DataFrame, id_col: str, text_col: str, label_col: str, sample: int, lines: int) -> Chain | None:
    """A chain learned from `sample` labelled documents that are not held out, by at most `lines` lines of each.

    The sample are the documents of the smallest hashes of their ids; of a
    longer text four stretches from all over it are chains of their own. So
    what comes to the driver is bounded: features of at most 4 * sample
    different stretches, whatever repeats an id. A document with several labels counts
    with the smallest. None if not both labels occur.
    """
    known = labels.select(F.col(id_col).alias("id"), F.col(label_col).cast("int").alias("label")).where("id is not null and label in (0, 1)").where(~held_out(F.col("id")))
    drawn = known.groupBy("id").agg(F.min("label").alias("label")).orderBy(F.xxhash64("id", F.lit("quality")), "id").limit(sample)
    texts = docs.select(F.col(id_col).alias("id"), F.col(text_col).cast("string").alias("text"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, "text", 1 << 20):
            x, found, _ = line_features(batch.column("text").fill_null("").cast(pa.binary()).to_pylist())
            base = np.cumsum(found) - found
            cut = [(k, at + first, n) for k, (at, m) in enumerate(zip(base.tolist(), found.tolist(), strict=True)) for first, n in windows(m, lines)]
            rows = pa.array([k for k, _, _ in cut], pa.int32())
            yield pa.RecordBatch.from_arrays([batch.column("id").take(rows), batch.column("label").take(rows), pa.array([x[at : at + n].tobytes() for _, at, n in cut], pa.binary())], ["id", "label", "x"])

    kind = texts.schema["id"].dataType.simpleString()
    # drawn has at most `sample` rows of an id and a label
    chains = mapped(texts.join(F.broadcast(drawn), "id").select("id", "label", "text"), run, f"id {kind}, label int, x binary")
    got = chains.distinct().orderBy(F.xxhash64("id", "x"), "id", "x").limit(4 * sample).toPandas()
    if got["label"].nunique() < 2:
        return None
    parts = [np.frombuffer(b, np.float32).reshape(-1, FEATURES) for b in got["x"]]
    return train(np.concatenate(parts), np.array([len(p) for p in parts]), got["label"].to_numpy())


def quality(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", label_col: str = "quality", threshold: float = 0.3, sample: int = 3000, lines: int = 256, keep: bool = False) -> DataFrame:
    """Rows (id, held_out, score, predicted), one for each input row; with keep: (row, score, predicted), row being the input's.

    Learned from a bounded sample of the labelled documents whose crc32(id)
    mod 5 is not 0. Null and empty texts are one empty line and get that
    line's probability. Without labels of both kinds every score is 0.5.
    Repeated rows stay repeated. An empty table gives no rows. No shuffle over
    the texts.
    """
    sent = docs.sparkSession.sparkContext.broadcast(fit(docs, labels, id_col, text_col, label_col, sample, lines))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        chain = sent.value
        for batch in slices(batches, "text", 1 << 20):
            texts = [t or b"" for t in batch.column("text").cast(pa.binary()).to_pylist()]
            score = chain.score(*line_features(texts)) if chain else np.full(len(texts), 0.5)
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(score), pa.array((score >= threshold).astype(np.int32))], [*batch.schema.names, "score", "predicted"])

    rows = packed(docs, text_col) if keep else docs.select(F.col(id_col), held_out(F.col(id_col)).alias("held_out"), F.col(text_col).cast("string").alias("text"))
    out = mapped(rows, run, StructType([*rows.schema, *StructType().add("score", DoubleType()).add("predicted", IntegerType())]))
    return out.drop("text") if keep else out.select(id_col, "held_out", "score", "predicted")

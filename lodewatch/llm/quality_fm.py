"""Quality score of texts by a factorisation machine.

Features of a text: its distinct words, hashed into `DIMS` places with weight tf / |tf| (length 1 together), and
structure statistics (shares of symbols, capitals, digits, repeated words and lines, word and text length) and metadata
(whether the table states a number of characters, that number, and how it differs from the text's own), scaled and cut
to [-3, 3]. The model is w0 + sum w_i x_i + 1/2 sum_f ((sum_i v_if x_i)^2 - sum_i v_if^2 x_i^2): pairwise
interactions of rank `RANK` at a cost that is linear in the number of features. The id, language, source and labels
are never features.

It is trained on at most `SAMPLE` labelled documents, those with the smallest hash of their id among the documents
that are not held out: a documented bound, so that the driver never holds more than SAMPLE x DIMS weights, also where rows
share an id (then the first SAMPLE rows by hash of id, id and features). Scoring
goes over whole texts on the executors; the model (DIMS x (RANK + 1) numbers) travels with the task.

Results by case: null counts as empty; an empty text has structure features only and gets a score like any other;
repeated rows get equal scores; without labelled documents of both kinds every score is the share of good labels
(1/2 without any); several labels of a document count as their least; an empty table gives an empty frame; a missing
metadata column, nulls in it and values that are no finite number from 0 count as not stated.
"""

from __future__ import annotations

import math
import zlib
from collections import Counter

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lodewatch.llm.text import map_texts

DIMS = 4096
RANK = 6
SAMPLE = 6000
EPOCHS = 12
CUT = 0.7
STRUCTURE = 11
METADATA = 3
DENSE = STRUCTURE + METADATA
SYMBOLS = b"#*$%&|<>"
CAPITALS = bytes(range(65, 91))
DIGITS = b"0123456789"
BLANK_BYTES = b" \t\n\x0b\x0c\r"
INNER_BYTES = bytes(range(0x80, 0xC0))  # of UTF-8, those that begin no character


def structure(text: bytes, words: list[bytes], counts: Counter) -> list[float]:
    n, dense = len(words), text.translate(None, BLANK_BYTES)
    size = max(len(dense), 1)
    share = lambda chars: (len(dense) - len(dense.translate(None, chars))) / size
    lines = [x for x in text.split(b"\n") if x and not x.isspace()]
    pairs = set(zip(words, words[1:]))
    capital_words = sum(w.isupper() for w in counts) / max(len(counts), 1)
    raw = [
        1.0 if n else 0.0,
        (math.log1p(n) - 5.5) / 1.5,
        10 * share(SYMBOLS),
        5 * share(CAPITALS),
        5 * share(DIGITS),
        3 * capital_words,
        3 * (1 - len(lines and set(lines)) / max(len(lines), 1)),
        3 * (1 - len(counts) / max(n, 1)),
        3 * (1 - len(pairs) / max(n - 1, 1)) if n > 1 else 0.0,
        (len(dense) / max(n, 1) - 5.5) / 2,
        5 * share(b"!?"),
    ]
    return [max(-3.0, min(3.0, x)) for x in raw]


def metadata(text: bytes, chars: float | None) -> list[float]:
    if chars is None or not math.isfinite(chars) or chars < 0:
        return [0.0] * METADATA
    own = len(text.translate(None, INNER_BYTES))
    raw = [1.0, (math.log1p(chars) - 7.5) / 1.5, math.log1p(chars) - math.log1p(own)]
    return [max(-3.0, min(3.0, x)) for x in raw]


def features(text: bytes, chars: float | None = None) -> tuple[np.ndarray, np.ndarray, list[float]]:
    """Places and weights of the hashed words, and the features of structure and metadata."""
    words = text.split()
    counts = Counter(words)
    dense = structure(text, words, counts) + metadata(text, chars)
    if not words:
        return np.zeros(0, np.int32), np.zeros(0, np.float32), dense
    place = np.fromiter(map(zlib.crc32, counts), np.int64, len(counts)) % DIMS
    tf = np.bincount(place, np.fromiter(counts.values(), np.float64, len(counts)), DIMS)
    at = np.flatnonzero(tf)
    return at.astype(np.int32), (tf[at] / math.sqrt(float(tf[at] @ tf[at]))).astype(np.float32), dense


class Machine:
    """w0, linear weights and factors over the `DIMS` + `DENSE` features."""

    def __init__(self, w0: float, w: np.ndarray, v: np.ndarray):
        self.w0, self.w, self.v = w0, w, v

    def score(self, text: bytes, chars: float | None = None) -> float:
        at, x, dense = features(text, chars)
        at = np.concatenate([at, np.arange(DIMS, DIMS + DENSE)])
        x = np.concatenate([x, np.array(dense, np.float32)])
        vx = self.v[at] * x[:, None]
        total = vx.sum(0)
        z = self.w0 + float(self.w[at] @ x) + 0.5 * float(total @ total - (vx * vx).sum())
        return 1 / (1 + math.exp(-max(-30.0, min(30.0, z))))


def train(rows: list[tuple[list[int], list[float], list[float], int]], rank: int = RANK, epochs: int = EPOCHS, seed: int = 7) -> Machine:
    """Minibatch Adam on log loss; `rows` are (places, weights, structure, label) in a fixed order."""
    rng = np.random.default_rng(seed)
    n = DIMS + DENSE
    y = np.array([r[3] for r in rows], np.float64)
    base = float(y.mean()) if len(y) else 0.5
    w0 = math.log(max(base, 1e-3) / max(1 - base, 1e-3))
    w, v = np.zeros(n), rng.normal(0, 0.02, (n, rank))
    if len(set(y.tolist())) < 2:
        return Machine(w0, w.astype(np.float32), np.zeros((n, rank), np.float32))
    at = [np.concatenate([np.asarray(r[0], np.int64), np.arange(DIMS, n)]) for r in rows]
    xs = [np.concatenate([np.asarray(r[1], np.float64), np.asarray(r[2], np.float64)]) for r in rows]
    params = np.column_stack([w, v])  # column 0: linear weights
    m1, m2, b1, b2, step = np.zeros_like(params), np.zeros_like(params), 0.0, 0.0, 0
    decay = np.full((n, 1), 2e-3)
    decay[DIMS:] = 1e-4
    for epoch in range(epochs):
        rate = 0.03 / (1 + 0.5 * epoch)
        order = rng.permutation(len(rows))
        for part in np.array_split(order, max(1, len(rows) // 64)):
            lengths = [len(at[i]) for i in part]
            where, x = np.concatenate([at[i] for i in part]), np.concatenate([xs[i] for i in part])
            starts = np.concatenate([[0], np.cumsum(lengths)[:-1]])
            px = params[where] * x[:, None]
            sums = np.add.reduceat(px, starts)
            squares = np.add.reduceat((px[:, 1:] ** 2).sum(1), starts)
            z = w0 + sums[:, 0] + 0.5 * ((sums[:, 1:] ** 2).sum(1) - squares)
            error = (1 / (1 + np.exp(-np.clip(z, -30, 30))) - y[part]) / len(part)
            spread = np.repeat(np.arange(len(part)), lengths)
            grad = np.empty_like(px)
            grad[:, 0] = x
            grad[:, 1:] = x[:, None] * (sums[spread, 1:] - px[:, 1:])
            grad *= error[spread][:, None]
            dense = np.stack([np.bincount(where, grad[:, c], n) for c in range(rank + 1)], 1) + decay * params / 10
            step += 1
            m1, m2 = 0.9 * m1 + 0.1 * dense, 0.999 * m2 + 0.001 * dense * dense
            params = params - rate * (m1 / (1 - 0.9**step)) / (np.sqrt(m2 / (1 - 0.999**step)) + 1e-8)
            g0 = float(error.sum())
            b1, b2 = 0.9 * b1 + 0.1 * g0, 0.999 * b2 + 0.001 * g0 * g0
            w0 -= rate * (b1 / (1 - 0.9**step)) / (math.sqrt(b2 / (1 - 0.999**step)) + 1e-8)
    return Machine(w0, params[:, 0].astype(np.float32), params[:, 1:].astype(np.float32))


def _feature_rows(texts: list[bytes], chars: list[float | None]) -> list[tuple]:
    return [(at.tolist(), x.tolist(), dense) for at, x, dense in map(features, texts, chars)]


def _texts(docs: DataFrame, id_col: str, text_col: str, chars_col: str) -> DataFrame:
    chars = F.col(f"`{chars_col}`").cast("string").try_cast("double") if chars_col in docs.columns else F.lit(None).cast("double")
    return docs.select(F.col(f"`{id_col}`").alias("id"), F.col(f"`{text_col}`").cast("string").alias("text"), chars.alias("chars"))


def held_out(identity: F.Column) -> F.Column:
    """True for a quarter of the ids: crc32 of the id as text, remainder 2 by 4; false for a null id."""
    return F.coalesce(F.crc32(identity.cast("string").cast("binary")) % 4 == 2, F.lit(False))


def fit(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", sample: int = SAMPLE, chars_col: str = "n_chars") -> Machine:
    """Trains on the bounded sample of labelled documents that are not held out."""
    known = labels.where("doc_id is not null and quality is not null").groupBy("doc_id").agg(F.min("quality").cast("int").alias("label_"))
    usable = known.where(~held_out(F.col("doc_id"))).withColumnRenamed("doc_id", "label_id_")
    chosen = usable.orderBy(F.xxhash64(F.col("label_id_").cast("string")), "label_id_").limit(sample)
    texts = _texts(docs, id_col, text_col, chars_col)
    joined = texts.join(F.broadcast(chosen), F.col("id") == F.col("label_id_")).select("id", "label_", "text", "chars")
    made = map_texts(joined, "text", {"at": "array<int>", "x": "array<float>", "dense": "array<float>"}, _feature_rows, keep=["id", "label_", "chars"], also=("chars",))
    rows = made.orderBy(F.xxhash64(F.col("id").cast("string")), "id", "dense", "at", "x").limit(sample).toArrow().to_pydict()
    ordered = sorted(zip(rows["id"], rows["at"], rows["x"], rows["dense"], rows["label_"]), key=lambda r: (zlib.crc32(str(r[0]).encode()), str(r[0])))
    return train([r[1:] for r in ordered])


def score(docs: DataFrame, model: Machine, id_col: str = "doc_id", text_col: str = "text", cut: float = CUT, chars_col: str = "n_chars") -> DataFrame:
    """One row per document: id, held_out, score, predicted."""
    texts = _texts(docs, id_col, text_col, chars_col)
    scored = map_texts(texts, "text", {"score": "double"}, lambda batch, chars: [(model.score(t, c),) for t, c in zip(batch, chars)], keep=["id", "chars"], also=("chars",))
    return scored.select("id", held_out(F.col("id")).alias("held_out"), "score", (F.col("score") >= cut).cast("int").alias("predicted"))

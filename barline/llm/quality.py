"""Quality classifier: random-indexing word vectors, a two-layer network, calibrated probabilities.

Every word row has a sparse random index vector; a row's word vector is the sum of
the index vectors of its neighbours over the whole corpus. A document is the mean
and the spread of its words' vectors. A two-layer numpy network reads that, and a
temperature fitted on rows that it was not trained on makes its outputs
probabilities.
"""

from __future__ import annotations

import re
import zlib

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F, types as T

from barline.llm.common import text_bytes

#: Letters of words longer than this are told apart by their shape only.
SHORT = 4
#: So many rows share the words of a shape and length between them.
SORTS = 8
#: Bytes to their kinds: small and other letters a, capitals A, digits 0, the rest as it is.
KINDS = bytes(
    0x41 if 0x41 <= b <= 0x5A else 0x61 if 0x61 <= b <= 0x7A or b >= 0x80 else 0x30 if 0x30 <= b <= 0x39 else b for b in range(256)
)
RUNS = re.compile(rb"(.)\1+", re.S)


class Rows(dict):
    """Word to row: short words by themselves, longer ones by shape, length and a few bits of their hash."""

    def __init__(self, rows: int) -> None:
        super().__init__()
        self.rows = rows

    def __missing__(self, word: bytes) -> int:
        key = word
        if len(word) > SHORT:
            shape = RUNS.sub(rb"\1", word.translate(KINDS))[:16]
            key = b"%s %d %d" % (shape, min(len(word), 24) // 4, zlib.crc32(word) % SORTS)
        found = zlib.crc32(key) % self.rows
        if len(self) < 1 << 17:
            self[word] = found
        return found

    def of(self, text: bytes) -> np.ndarray:
        return np.array(list(map(self.__getitem__, text.split())), np.int64)


def index_vectors(rows: int, dims: int, seed: int, ones: int = 4) -> np.ndarray:
    """Sparse ternary vectors: ``ones`` places of each are 1 or -1."""
    rng = np.random.default_rng(seed)
    out = np.zeros((rows, dims), np.int64)
    for r in range(rows):
        out[r, rng.choice(dims, ones, replace=False)] = rng.choice([-1, 1], ones)
    return out


def word_vectors(texts: DataFrame, rows: int = 2048, dims: int = 48, seed: int = 5) -> np.ndarray:
    """Unit vectors (rows, dims) from all of ``text``. A task hands on rows times dims sums, however much it reads."""
    index = index_vectors(rows, dims, seed)

    def neighbours(batches):
        known, pairs = Rows(rows), np.zeros(rows * rows, np.int64)
        for b in batches:
            held, size = [], 0
            for text in text_bytes(b, "text"):
                words = known.of(text)
                held.append(words[:-1] * rows + words[1:])
                size += len(words)
                if size > 1 << 20:
                    pairs += np.bincount(np.concatenate(held), minlength=rows * rows)
                    held, size = [], 0
            if held:
                pairs += np.bincount(np.concatenate(held), minlength=rows * rows)
        pairs = pairs.reshape(rows, rows)
        sums = pairs @ index + pairs.T @ index
        place = np.flatnonzero(sums)
        yield pa.RecordBatch.from_arrays([pa.array(place), pa.array(sums.ravel()[place])], ["place", "n"])

    summed = texts.select("text").mapInArrow(neighbours, "place long, n long").groupBy("place").agg(F.sum("n").alias("n"))
    table = summed.toArrow()
    out = np.zeros(rows * dims)
    out[table.column("place").to_numpy()] = table.column("n").to_numpy()
    out = out.reshape(rows, dims)
    # Rare rows are drawn to the middle, where there is nothing known of them.
    return out / (np.linalg.norm(out, axis=1, keepdims=True) + 8.0)


def pooled(words: np.ndarray, vectors: np.ndarray) -> np.ndarray:
    """Mean, spread, mean over distinct rows, mean change from word to word, and length; zeros without words."""
    n, dims = len(words), vectors.shape[1]
    if n == 0:
        return np.zeros(4 * dims + 2)
    kinds, times = np.unique(words, return_counts=True)
    held, share = vectors[kinds], times / n
    mean = share @ held
    spread = np.sqrt(np.maximum(share @ (held * held) - mean * mean, 0) * (n / max(1, n - 1)))
    steps = np.abs(np.diff(vectors[words], axis=0)).mean(0) if n > 1 else spread
    return np.concatenate([mean, spread, held.mean(0), steps, [np.log1p(n), len(kinds) / n]])


class Network:
    """Two layers and a temperature. Without rows of both kinds it gives their share, or 0.5."""

    def __init__(self, x: np.ndarray, y: np.ndarray, hidden: int = 32, epochs: int = 60, seed: int = 3) -> None:
        self.temperature = 1.0
        self.constant = None
        if len(np.unique(y)) < 2:
            self.constant = float(y[0]) * 0.98 + 0.01 if len(y) else 0.5
            return
        rng = np.random.default_rng(seed)
        self.middle, self.width = x.mean(0), x.std(0) + 1e-6
        x = (x - self.middle) / self.width
        fit = rng.random(len(x)) >= 0.15
        if len(np.unique(y[fit])) < 2 or fit.all():
            fit[:] = True
        self._train(x[fit], y[fit], hidden, epochs, rng)
        held = ~fit if not fit.all() else fit
        logits = self._logits(x[held])
        self.temperature = min(np.geomspace(0.25, 8, 61), key=lambda t: _loss(logits / t, y[held]))

    def _train(self, x: np.ndarray, y: np.ndarray, hidden: int, epochs: int, rng: np.random.Generator) -> None:
        self.params = [rng.normal(0, 1 / np.sqrt(x.shape[1]), (x.shape[1], hidden)), np.zeros(hidden), rng.normal(0, 0.2, hidden), np.zeros(1)]
        moments = [(np.zeros_like(p), np.zeros_like(p)) for p in self.params]
        step = 0
        for _ in range(epochs):
            for part in np.array_split(rng.permutation(len(x)), max(1, len(x) // 256)):
                step += 1
                w, b, v, _c = self.params
                h = np.tanh(x[part] @ w + b)
                wrong = (_sigmoid(self._logits(x[part])) - y[part]) / len(part)
                back = wrong[:, None] * v * (1 - h * h)
                grads = [x[part].T @ back + 1e-4 * w, back.sum(0), h.T @ wrong + 1e-4 * v, wrong.sum(keepdims=True)]
                for p, g, (m, s) in zip(self.params, grads, moments):
                    m += 0.1 * (g - m)
                    s += 0.001 * (g * g - s)
                    p -= 0.005 * (m / (1 - 0.9**step)) / (np.sqrt(s / (1 - 0.999**step)) + 1e-8)

    def _logits(self, x: np.ndarray) -> np.ndarray:
        w, b, v, c = self.params
        return np.tanh(x @ w + b) @ v + c[0]

    def scores(self, x: np.ndarray) -> np.ndarray:
        if self.constant is not None:
            return np.full(len(x), self.constant)
        return _sigmoid(self._logits((x - self.middle) / self.width) / self.temperature)


def _sigmoid(x: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(x, -60, 60)))


def _loss(logits: np.ndarray, y: np.ndarray) -> float:
    return float(np.mean(np.logaddexp(0, logits) - y * logits))


def held_out(id_col: str | Column) -> Column:
    """Rows that nothing is learned from: crc32 of the id as text leaves 1 when divided by 3."""
    c = F.col(id_col) if isinstance(id_col, str) else id_col
    return F.coalesce(F.pmod(F.crc32(c.cast("string").cast("binary")), F.lit(3)) == 1, F.lit(False))


def quality_scores(
    docs: DataFrame,
    labels: DataFrame,
    *,
    id_col: str = "doc_id",
    text_col: str = "text",
    label_col: str = "quality",
    most_labelled: int = 20_000,
    rows: int = 2048,
    dims: int = 48,
) -> DataFrame:
    """Per row ``doc_id``, ``held_out``, ``score`` (0 to 1, higher: label 1 likelier) and ``predicted`` (1 from 0.5).

    Word vectors come from all texts. The network learns from at most
    ``most_labelled`` labelled ids (those of smallest hash) that are not held out; an
    id with several labels has the smallest. Only the text enters a score. NULL and
    empty texts are documents without words and have the score of that; a NULL id is
    not held out and has no label; NULL labels are none. Repeated ids and rows are
    scored each by itself. Without labels the score is 0.5. An empty table gives no
    rows. Columns besides those named are not read.
    """
    named = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"))
    scored = with_scores(
        named, labels, id_col="id", label_id=id_col, label_col=label_col, most_labelled=most_labelled, rows=rows, dims=dims
    )
    predicted = (F.col("quality_score") >= 0.5).cast("int").alias("predicted")
    return scored.select(F.col("id").alias("doc_id"), held_out("id").alias("held_out"), F.col("quality_score").alias("score"), predicted)


def with_scores(
    docs: DataFrame,
    labels: DataFrame,
    *,
    id_col: str = "doc_id",
    text_col: str = "text",
    label_id: str = "doc_id",
    label_col: str = "quality",
    most_labelled: int = 20_000,
    rows: int = 2048,
    dims: int = 48,
    score_col: str = "quality_score",
) -> DataFrame:
    """``docs``, all columns, with ``score_col``; rows as in ``quality_scores``."""
    named = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"))
    vectors = word_vectors(named, rows, dims)
    network = _fitted(named, labels, vectors, label_id, label_col, most_labelled)
    names = docs.columns

    def score(batches):
        known = Rows(rows)
        for b in batches:
            x = np.array([pooled(known.of(t), vectors) for t in text_bytes(b, text_col)]).reshape(-1, 4 * dims + 2)
            yield pa.RecordBatch.from_arrays([*b.columns, pa.array(network.scores(x), pa.float64())], [*names, score_col])

    return docs.mapInArrow(score, T.StructType([*docs.schema.fields, T.StructField(score_col, T.DoubleType())]))


def _fitted(named: DataFrame, labels: DataFrame, vectors: np.ndarray, label_id: str, label_col: str, most: int) -> Network:
    """The network fitted to at most ``most`` labelled documents, whose pooled vectors come to the driver."""
    rows = len(vectors)
    seen = labels.select(F.col(label_id).alias("id"), F.col(label_col).cast("double").alias("label")).dropna()
    chosen = (
        seen.filter(~held_out("id")).groupBy("id").agg(F.min("label").alias("label"))
        .orderBy(F.xxhash64("id"), "id").limit(most)
    )

    def pool(batches):
        known = Rows(rows)
        for b in batches:
            packed = [pooled(known.of(t), vectors).tobytes() for t in text_bytes(b, "text")]
            yield pa.RecordBatch.from_arrays([b.column("id"), b.column("label"), pa.array(packed, pa.binary())], ["id", "label", "x"])

    kind = named.schema["id"].dataType.simpleString()
    learned = named.join(F.broadcast(chosen), "id").mapInArrow(pool, f"id {kind}, label double, x binary").toArrow()
    x = np.array([np.frombuffer(v) for v in learned.column("x").to_pylist()]).reshape(-1, 4 * vectors.shape[1] + 2)
    order = np.lexsort((*x.T[:2], np.array(learned.column("id").to_pylist())))
    return Network(x[order], np.array(learned.column("label").to_pylist(), float)[order])

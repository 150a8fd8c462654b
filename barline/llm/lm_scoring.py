"""Language-model scores by masked pseudo-likelihood.

A window network predicts every token from two on either side: embeddings of the
four, a hidden layer, a softmax over token classes, and the word's share of its class
(``word_scores``). The vocabulary and its embeddings grow with the corpus. The
network starts from a smaller one of classes with one token on either side
(``lm_scores``), trained in numpy, full-batch, on how often the whole corpus has each
class between each pair of classes. From there the embedding of every word at every
place takes a Newton step along its gradient over all tokens, summed in Spark. A
document's score is the sum of its tokens' conditional log-probabilities.
"""

from __future__ import annotations

import math
import zlib
from collections import Counter
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, functions as F

from barline.llm.common import text_bytes
from barline.sources.tables import stage

#: The class of what stands before the first and after the last token.
EDGE = 0


class Classes(dict):
    """Token to class: a frequent word has its own, the others share buckets by hash."""

    def __init__(self, frequent: list[bytes], buckets: int) -> None:
        super().__init__((w, i + 1) for i, w in enumerate(frequent))
        self.first, self.buckets, self.most = len(frequent) + 1, buckets, len(frequent) + (1 << 17)

    def __missing__(self, word: bytes) -> int:
        found = self.first + zlib.crc32(word) % self.buckets
        if len(self) < self.most:
            self[word] = found
        return found

    def of(self, text: bytes) -> np.ndarray:
        return np.array(list(map(self.__getitem__, text.lower().split())), np.int64)


def cells(tokens: np.ndarray, classes: int) -> np.ndarray:
    """For each token the number of (left, right, token)."""
    padded = np.concatenate([[EDGE], tokens, [EDGE]])
    return (padded[:-2] * classes + padded[2:]) * classes + tokens


def frequent_words(rows: DataFrame, most: int) -> list[bytes]:
    """The ``most`` most frequent words of the corpus, ties by bytes."""

    def count(batches):
        for b in batches:
            n: Counter = Counter()
            for text in text_bytes(b, "text"):
                n.update(text.lower().split())
                if len(n) > 1 << 19:
                    yield _pairs(n, pa.binary(), ["word", "n"])
                    n.clear()
            if n:
                yield _pairs(n, pa.binary(), ["word", "n"])

    counted = rows.select("text").mapInArrow(count, "word binary, n long").groupBy("word").agg(F.sum("n").alias("n"))
    return [bytes(r.word) for r in counted.orderBy(F.desc("n"), "word").limit(most).collect()]


def _pairs(n: dict, kind: pa.DataType, names: list[str]) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(n.keys(), kind), pa.array(n.values(), pa.int64())], names)


def window_counts(rows: DataFrame, words: list[bytes], buckets: int) -> np.ndarray:
    """How often each class stands between each pair of classes, over all rows: (pairs, classes)."""
    classes = len(words) + 1 + buckets

    def count(batches):
        known, total = Classes(words, buckets), np.zeros(classes**3, np.int64)
        for b in batches:
            held: list[np.ndarray] = []
            for text in text_bytes(b, "text"):
                held.append(cells(known.of(text), classes))
                if sum(map(len, held[-64:])) > 1 << 20 or len(held) >= 4096:
                    total += np.bincount(np.concatenate(held), minlength=classes**3)
                    held = []
            if held:
                total += np.bincount(np.concatenate(held).astype(np.int64), minlength=classes**3)
        there = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(there), pa.array(total[there])], ["cell", "n"])

    counted = rows.select("text").mapInArrow(count, "cell long, n long").groupBy("cell").agg(F.sum("n").alias("n"))
    table = counted.toArrow()
    total = np.zeros(classes**3)
    total[table.column("cell").to_numpy()] = table.column("n").to_numpy()
    return total.reshape(classes * classes, classes)


def train(counts: np.ndarray, **how) -> np.ndarray:
    """Log-probabilities (pairs, classes) of the network fitted to ``counts``."""
    el, er, b, w, c = fitted(counts, **how)
    every = np.arange(len(counts))
    return _log_softmax(np.tanh(el[every // len(el)] + er[every % len(el)] + b) @ w + c).astype(np.float32)


def fitted(counts: np.ndarray, *, hidden: int = 24, steps: int = 150, rate: float = 0.05, seed: int = 11) -> list[np.ndarray]:
    """Left and right embeddings, hidden bias, output weights and bias, fitted to ``counts`` by full-batch Adam."""
    classes = counts.shape[1]
    rng = np.random.default_rng(seed)
    seen = np.flatnonzero(counts.sum(1))
    target = counts[seen] / max(1.0, counts.sum())
    weight = target.sum(1, keepdims=True)
    left, right = seen // classes, seen % classes
    params = [rng.normal(0, 0.1, s) for s in ((classes, hidden), (classes, hidden), (hidden,), (hidden, classes))]
    params.append(np.log(counts.sum(0) + 1.0) - np.log(counts.sum() + classes))
    moments = [(np.zeros_like(p), np.zeros_like(p)) for p in params]
    for step in range(1, steps + 1 if len(seen) else 1):
        el, er, b, w, c = params
        h = np.tanh(el[left] + er[right] + b)
        wrong = np.exp(_log_softmax(h @ w + c)) * weight - target
        back = (wrong @ w.T) * (1 - h * h)
        grads = [_summed(back, left, classes), _summed(back, right, classes), back.sum(0), h.T @ wrong, wrong.sum(0)]
        for p, g, (m, v) in zip(params, grads, moments):
            m += 0.1 * (g - m)
            v += 0.001 * (g * g - v)
            p -= rate * (m / (1 - 0.9**step)) / (np.sqrt(v / (1 - 0.999**step)) + 1e-10)
    return params


def _log_softmax(x: np.ndarray) -> np.ndarray:
    x = x - x.max(1, keepdims=True)
    return x - np.log(np.exp(x).sum(1, keepdims=True))


def _summed(rows: np.ndarray, to: np.ndarray, n: int) -> np.ndarray:
    out = np.zeros((n, rows.shape[1]))
    np.add.at(out, to, rows)
    return out


def lm_scores(
    docs: DataFrame,
    *,
    id_col: str = "doc_id",
    text_col: str = "text",
    classes: int = 128,
    buckets: int = 32,
    trainer: Callable[[np.ndarray], np.ndarray] = train,
) -> DataFrame:
    """Per row ``doc_id``, ``n_tokens``, ``log_likelihood``, ``mean_log_prob`` and ``perplexity``.

    Tokens are runs without blanks, A-Z lower-cased; of the ``classes`` one is the
    edge of a text and ``buckets`` are for words beyond the most frequent ones. NULL
    and empty texts have no token, log-likelihood 0, and NULL for the mean and the
    perplexity. NULL and repeated ids and repeated rows are scored each by itself. An
    empty table gives no rows. Columns besides the two named are not read. To the
    driver come the frequent words and the window counts, at most ``classes`` cubed.
    """
    rows = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"))
    words = frequent_words(rows, classes - 1 - buckets)
    counts = window_counts(rows, words, buckets)
    size = counts.shape[1]
    table = docs.sparkSession.sparkContext.broadcast(trainer(counts).ravel())

    def score(batches):
        known, logs = Classes(words, buckets), table.value
        for b in batches:
            sizes, sums = [], []
            for text in text_bytes(b, "text"):
                tokens = known.of(text)
                sizes.append(len(tokens))
                sums.append(float(logs[cells(tokens, size)].sum(dtype=np.float64)))
            yield pa.RecordBatch.from_arrays(
                [b.column("id"), pa.array(sizes, pa.int64()), pa.array(sums, pa.float64())], ["doc_id", "n_tokens", "log_likelihood"]
            )

    scored = rows.mapInArrow(score, f"doc_id {rows.schema['id'].dataType.simpleString()}, n_tokens long, log_likelihood double")
    mean = F.when(F.col("n_tokens") > 0, F.col("log_likelihood") / F.col("n_tokens"))
    return scored.withColumn("mean_log_prob", mean).withColumn("perplexity", F.exp(-F.col("mean_log_prob")))


#: Places of the window, relative to the token that is predicted.
PLACES = (-2, -1, 1, 2)
#: Fixed point of summed gradients, so that sums do not depend on their order.
UNIT = 1 << 16
#: Texts are taken up so many bytes at a time, tokens so many.
TAKEN, BLOCK = 1 << 22, 1 << 14


def tokens(batch: pa.RecordBatch):
    """Parts of a batch: how many tokens each row has, a number per token, and the word of each number."""
    texts = pc.ascii_lower(pc.fill_null(batch.column("text"), ""))
    ends = np.cumsum(pc.binary_length(texts).to_numpy(), dtype=np.int64)
    at = 0
    while at < len(texts):
        to = max(at + 1, int(np.searchsorted(ends, (ends[at - 1] if at else 0) + TAKEN, "right")))
        split = pc.ascii_split_whitespace(texts.slice(at, to - at))
        words = split.flatten()
        there = pc.greater(pc.binary_length(words), 0)
        total = np.concatenate([[0], np.cumsum(there.to_numpy(zero_copy_only=False))])
        offsets = split.offsets.to_numpy() - split.offsets[0].as_py()
        found = words.filter(there).cast(pa.binary()).dictionary_encode()
        yield np.diff(total[offsets]), found.indices.to_numpy(), found.dictionary
        at = to


class Vocabulary:
    """Words to numbers: 0 an edge, then words by falling frequency, the last number for all rarer ones."""

    def __init__(self, words: list[bytes], n: np.ndarray, rare: int, classes: int, buckets: int) -> None:
        self.number = {w: i + 1 for i, w in enumerate(words)}
        self.rare = len(words) + 1
        own = min(len(words), classes - 1 - buckets)
        self.kind = np.zeros(self.rare + 1, np.int64)
        self.kind[1 : own + 1] = np.arange(1, own + 1)
        self.kind[own + 1 : -1] = [own + 1 + zlib.crc32(w) % (buckets - 1) for w in words[own:]]
        self.kind[-1] = own + buckets
        self.classes = own + 1 + buckets
        self.n = np.concatenate([[0.0], n, [rare]])
        of_kind = np.bincount(self.kind, self.n, self.classes)
        #: Of a token given its class; that of a rare word is up to its letters.
        self.within = np.log(np.maximum(self.n, 1) / np.maximum(of_kind[self.kind], 1))

    def padded(self, sizes: np.ndarray, codes: np.ndarray, words: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """Numbers of all tokens with two edges before, between and behind rows; and the places of the tokens."""
        get, rare = self.number.get, self.rare
        numbers = np.array([get(w, rare) for w in words.to_pylist()], np.int64)
        places = np.arange(len(codes)) + 2 * np.repeat(np.arange(1, len(sizes) + 1), sizes)
        out = np.zeros(len(codes) + 2 * len(sizes) + 2, np.int64)
        out[places] = numbers[codes] if len(codes) else 0
        return out, places


#: Words that a task counts before it hands the counts on.
HELD_WORDS = 1 << 18


def word_counts(rows: DataFrame) -> DataFrame:
    """``word`` and ``n``, of every word of the corpus. A task adds up its parts before they move."""

    def handed(held: dict[bytes, int]) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays(
            [pa.array(list(held), pa.binary()), pa.array(list(held.values()), pa.int64())], ["word", "n"]
        )

    def count(batches):
        held: dict[bytes, int] = {}
        for b in batches:
            for _, codes, words in tokens(b):
                times = np.bincount(codes, minlength=len(words)).tolist()
                for word, n in zip(words.to_pylist(), times):
                    held[word] = held.get(word, 0) + n
                if len(held) > HELD_WORDS:
                    yield handed(held)
                    held = {}
        yield handed(held)

    return rows.select("text").mapInArrow(count, "word binary, n long").groupBy("word").agg(F.sum("n").alias("n"))


def _letters(words: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """Of each byte of the words, and the end of each, the pair it makes with the byte before; where the words start."""
    line = np.frombuffer(b"\n" + b"".join(w + b"\n" for w in words), np.uint8).astype(np.int64)
    return line[:-1] * 256 + line[1:], np.concatenate([[0], np.flatnonzero(line[1:] == 10)[:-1] + 1]).astype(np.int64)


def spelling(rare: DataFrame) -> np.ndarray:
    """Log-probabilities of a byte, or a word's end, after another, from the words of ``rare`` as often as they occur."""

    def count(batches):
        total = np.zeros(1 << 16, np.int64)
        for b in batches:
            if b.num_rows:
                pairs, starts = _letters(b.column("word").to_pylist())
                times = np.repeat(b.column("n").to_numpy(), np.diff(np.append(starts, len(pairs))))
                total += np.bincount(pairs, times, 1 << 16).astype(np.int64)
        there = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(there), pa.array(total[there])], ["pair", "n"])

    table = rare.mapInArrow(count, "pair long, n long").groupBy("pair").agg(F.sum("n").alias("n")).toArrow()
    n = np.full(1 << 16, 0.1)
    n[table.column("pair").to_numpy()] += table.column("n").to_numpy()
    n = n.reshape(256, 256)
    return np.log(n / n.sum(1, keepdims=True)).ravel()


def _class_counts(rows: DataFrame, vocabulary) -> np.ndarray:
    """How often each class stands between each pair of classes: (pairs, classes)."""
    size = vocabulary.value.classes

    def count(batches):
        known, total = vocabulary.value, np.zeros(size**3, np.int64)
        for b in batches:
            for part in tokens(b):
                numbers, at = known.padded(*part)
                kinds = known.kind[numbers]
                total += np.bincount((kinds[at - 1] * size + kinds[at + 1]) * size + kinds[at], minlength=size**3)
        there = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(there), pa.array(total[there])], ["cell", "n"])

    table = rows.select("text").mapInArrow(count, "cell long, n long").groupBy("cell").agg(F.sum("n").alias("n")).toArrow()
    total = np.zeros(size**3)
    total[table.column("cell").to_numpy()] = table.column("n").to_numpy()
    return total.reshape(size * size, size)


def _slopes(counts: np.ndarray, params: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Of every pair of classes the expected output weights and the hidden layer's slope; the mean curvature of the loss."""
    el, er, b, w, c = params
    every = np.arange(len(counts))
    h = np.tanh(el[every // len(el)] + er[every % len(el)] + b)
    p = np.exp(_log_softmax(h @ w + c))
    expected, slope = p @ w.T, 1 - h * h
    share = counts.sum(1, keepdims=True) / max(1.0, counts.sum())
    curvature = (share * slope**2 * (p @ (w * w).T - expected**2)).sum(0)
    return expected.astype(np.float32), slope.astype(np.float32), curvature


def _word_gradients(rows: DataFrame, vocabulary, start) -> np.ndarray:
    """The gradient of the loss by the embedding of every word at every place, over all tokens: (places, words, hidden)."""
    hidden = start.value[0].shape[1]
    width = len(PLACES) * hidden

    def sums(batches):
        known, (expected, slope, weights) = vocabulary.value, start.value
        total = np.zeros((len(PLACES), len(known.n), hidden))
        for b in batches:
            for part in tokens(b):
                numbers, _ = known.padded(*part)
                numbers = np.pad(numbers, 3)
                kinds = known.kind[numbers]
                for i in range(3, len(numbers) - 3, BLOCK):
                    to = min(i + BLOCK, len(numbers) - 3)
                    # A word at place o of a token is what stands there; the token is o before the word.
                    pairs = kinds[i - 3 : to + 1] * known.classes + kinds[i - 1 : to + 3]
                    back = expected.take(pairs, 0)
                    back -= weights.take(kinds[i - 2 : to + 2], 0)
                    back *= slope.take(pairs, 0)
                    back[numbers[i - 2 : to + 2] == EDGE] = 0
                    block = numbers[i:to]
                    order = np.argsort(block)
                    last = np.flatnonzero(np.diff(block[order], append=-1))
                    back, ends = np.ascontiguousarray(back.T), block[order[last]]
                    for k, o in enumerate(PLACES):
                        run = np.cumsum(back.take(order + (2 - o), 1), 1, np.float64).take(last, 1)
                        total[k, ends] += np.diff(run, axis=1, prepend=0.0).T
        there = np.flatnonzero(total.any((0, 2)))
        for i in range(0, len(there), BLOCK):
            part = there[i : i + BLOCK]
            rounded = np.rint(total[:, part] * UNIT).astype(np.int64).transpose(1, 0, 2).reshape(len(part), -1)
            yield pa.RecordBatch.from_arrays([pa.array(part), pa.array(_packed(rounded), pa.binary())], ["number", "sums"])

    def added(batches):
        """The sums of the words of a partition; as floats, since no more is added."""
        place: dict[int, int] = {}
        total = np.zeros((0, width), np.int64)
        for b in batches:
            numbers = b.column("number").to_pylist()
            at = np.array([place.setdefault(n, len(place)) for n in numbers], np.int64)
            if len(place) > len(total):
                total = np.concatenate([total, np.zeros((max(len(place) - len(total), len(total)), width), np.int64)])
            for rows_at, sums in _unpacked(b.column("sums").to_pylist(), width):
                np.add.at(total, at[rows_at], sums)
        if place:
            found = [v.tobytes() for v in (total[: len(place)] / UNIT).astype(np.float32)]
            yield pa.RecordBatch.from_arrays([pa.array(list(place), pa.int64()), pa.array(found, pa.binary())], ["number", "sums"])

    kind = "number long, sums binary"
    table = rows.select("text").mapInArrow(sums, kind).repartition("number").mapInArrow(added, kind).toArrow()
    out = np.zeros((len(vocabulary.value.n), len(PLACES), hidden))
    if table.num_rows:
        found = np.frombuffer(b"".join(table.column("sums").to_pylist()), np.float32)
        out[table.column("number").to_numpy()] = found.reshape(-1, len(PLACES), hidden)
    return out.transpose(1, 0, 2)


def _packed(rows: np.ndarray) -> list[bytes]:
    """Each row's integers in four bytes, or eight where they need them, bytes of one weight side by side: zeros meet zeros."""
    wide = np.abs(rows).max(1) >= 1 << 31
    out = np.empty(len(rows), object)
    for kind, weight, mine in (("<i4", 4, ~wide), ("<i8", 8, wide)):
        part = np.ascontiguousarray(rows[mine].astype(kind))
        planes = part.view(np.uint8).reshape(len(part), rows.shape[1], weight).transpose(0, 2, 1)
        for i, plane in zip(np.flatnonzero(mine), planes):
            out[i] = plane.tobytes()
    return out.tolist()


def _unpacked(packed: list[bytes], width: int) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Which rows, and their integers, of those in four bytes and those in eight."""
    sizes = np.array([len(p) for p in packed])
    for kind, weight in (("<i4", 4), ("<i8", 8)):
        at = np.flatnonzero(sizes == weight * width)
        if len(at):
            planes = np.frombuffer(b"".join(packed[i] for i in at), np.uint8).reshape(len(at), weight, width)
            yield at, np.ascontiguousarray(planes.transpose(0, 2, 1)).view(kind).reshape(len(at), width).astype(np.int64)


def _embeddings(vocabulary: Vocabulary, params: list[np.ndarray], gradients: np.ndarray, curvature: np.ndarray) -> np.ndarray:
    """Each word's vector at each place: that of its class, moved a Newton step; words seen seldom move less."""
    el, er = params[:2]
    out = np.zeros(gradients.shape)
    out[1], out[2] = el[vocabulary.kind], er[vocabulary.kind]
    n = np.maximum(vocabulary.n, 1.0)
    n[EDGE] = n.sum()
    out -= STEP * gradients / (n[:, None] * curvature + DAMPING * curvature.mean() + 1e-9)
    return out.astype(np.float32)


#: Part of a Newton step that words move, all at once; and the tokens' worth of doubt about each.
STEP, DAMPING = 0.12, 50.0


def _log_probabilities(numbers: np.ndarray, at: np.ndarray, known: Vocabulary, model: tuple) -> np.ndarray:
    """Of each token given the words at ``PLACES``, but for the letters of rare words."""
    vectors, b, w, c = model
    out, ones = np.empty(len(at)), np.ones(len(c), np.float32)
    # Hidden values are at most 1, so output is as well bounded; exponentials mostly stay in the range of floats.
    wide = np.abs(w).sum(0).max() + np.abs(c).max() > 80
    for i in range(0, len(at), BLOCK >> 3):
        place = at[i : i + (BLOCK >> 3)]
        token = numbers[place]
        h = vectors[0].take(numbers[place - 2], 0)
        for k, o in enumerate(PLACES[1:], 1):
            h += vectors[k].take(numbers[place + o], 0)
        h += b
        x = np.tanh(h, out=h) @ w
        x += c
        if wide:
            x -= x.max(1, keepdims=True)
        right = x[np.arange(len(place)), known.kind[token]]
        out[i : i + len(place)] = right - np.log(np.exp(x, out=x) @ ones) + known.within[token]
    return out


def word_scores(docs: DataFrame, *, id_col: str = "doc_id", text_col: str = "text", classes: int = 128, buckets: int = 32) -> DataFrame:
    """``lm_scores`` of words, not classes, each predicted from two on either side; columns and rows as there.

    A token's probability is that of its class given the window, times that of the
    word in its class. Every word that occurs at least 8 times, or a hundredth of the
    root of the number of tokens where that is more, is in the vocabulary: it has a
    vector of its own for each place of the window and its own share of its class.
    The words below that are one class, told apart by their bytes. To the driver come
    the vocabulary, four vectors for each of its words, and at most ``classes`` cubed
    counts.
    """
    rows = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"))
    context = docs.sparkSession.sparkContext
    counted = stage(word_counts(rows), "lm-words")
    total = counted.agg(F.sum("n")).first()[0] or 0
    least = max(8, math.isqrt(total) // 100)
    table = counted.filter(F.col("n") >= least).toArrow()
    words, n = table.column("word").to_pylist(), table.column("n").to_numpy()
    order = sorted(range(len(words)), key=lambda i: (-n[i], words[i]))
    known = Vocabulary([words[i] for i in order], n[order], total - int(n.sum()), classes, buckets)
    vocabulary = context.broadcast(known)
    letters = spelling(counted.filter(F.col("n") < least))
    counts = _class_counts(rows, vocabulary)
    params = fitted(counts)
    expected, slope, curvature = _slopes(counts, params)
    start = context.broadcast((expected, slope, params[3].T.astype(np.float32)))
    vectors = _embeddings(known, params, _word_gradients(rows, vocabulary, start), curvature)
    model = context.broadcast((vectors, *(p.astype(np.float32) for p in params[2:]), letters))

    def score(batches):
        known, (*net, spelled) = vocabulary.value, model.value
        for b in batches:
            sizes, sums = [np.zeros(0, np.int64)], [np.zeros(0)]
            for size, codes, words in tokens(b):
                numbers, at = known.padded(size, codes, words)
                logs = _log_probabilities(numbers, at, known, net)
                if len(codes):
                    pairs, starts = _letters(words.to_pylist())
                    logs += np.where(numbers[at] == known.rare, np.add.reduceat(spelled[pairs], starts)[codes], 0.0)
                sizes.append(size)
                sums.append(np.bincount(np.repeat(np.arange(len(size)), size), logs, len(size)))
            yield pa.RecordBatch.from_arrays(
                [b.column("id"), pa.array(np.concatenate(sizes), pa.int64()), pa.array(np.concatenate(sums))], ["doc_id", "n_tokens", "log_likelihood"]
            )

    scored = rows.mapInArrow(score, f"doc_id {rows.schema['id'].dataType.simpleString()}, n_tokens long, log_likelihood double")
    mean = F.when(F.col("n_tokens") > 0, F.col("log_likelihood") / F.col("n_tokens"))
    return scored.withColumn("mean_log_prob", mean).withColumn("perplexity", F.exp(-F.col("mean_log_prob")))

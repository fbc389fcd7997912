"""Language identification by a byte convolutional network, trained in numpy.

Bytes fold to ``CLASSES`` classes (letters without case, space, digits, punctuation, the bytes of
other alphabets). Filters of several widths slide over a fixed-length window of embedded
bytes; each filter's greatest response in the window is kept, and a softmax over those gives
the languages. It is trained by Adam on windows of a bounded sample: ``PER_LANGUAGE`` documents of
each language at most, the first by hash, outside the held-out fold. Only text and lang are used. A limit on
the hash, from counts by language, keeps nearly all other documents out of the sample's shuffle at every size.

To apply it, each filter becomes tables of responses by byte pair, so a window costs a few
lookups a byte. Every text is cut whole into consecutive windows, evaluated in batches;
a text's probabilities are the mean of its windows', weighted by their bytes. One scan, no shuffle.

Defined results: a text that is null or has no letter is ``und`` with score 0; with nothing to
learn from, every text is. Repeated rows get equal results; a null doc_id is not held out; an empty table
gives an empty result; other columns are not read, whatever their names.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from strata.llm import textbatch as tb

WINDOW, CLASSES, EMBEDDED, FILTERS, WIDTHS = 256, 64, 8, 8, (2, 3, 4)
PER_LANGUAGE, EXCERPTS, EPOCHS, BATCH, SEED = 300, 4, 6, 64, 3
#: Times ``PER_LANGUAGE`` that the hash limit is expected to let through; raised where too few have text.
SPARE = 2
UNKNOWN = "und"
#: The pipeline rejects texts under this score, little over what a guess among four languages gets.
MIN_SCORE = 0.3

_SPACE, _DIGIT, _OTHER = 26, 27, 28
FOLD = np.full(256, _OTHER, np.uint8)
FOLD[[9, 10, 11, 12, 13, 32]] = _SPACE
FOLD[48:58] = _DIGIT
FOLD[65:91] = FOLD[97:123] = np.arange(26)
FOLD[128:] = _OTHER + 1 + np.arange(128) % (CLASSES - _OTHER - 1)
LETTER = np.zeros(256, bool)
LETTER[65:91] = LETTER[97:123] = True


@dataclass
class Network:
    """Parameters and their use; ``languages`` names the outputs."""

    languages: list[str]
    embedding: np.ndarray
    kernels: list[np.ndarray]  # width x EMBEDDED x FILTERS
    shifts: list[np.ndarray]
    dense: np.ndarray
    bias: np.ndarray

    @classmethod
    def random(cls, languages: list[str], rng: np.random.Generator) -> Network:
        scale = lambda *s, by: rng.normal(0, by, s).astype(np.float32)
        return cls(languages, scale(CLASSES, EMBEDDED, by=0.5),
                   [scale(w, EMBEDDED, FILTERS, by=1 / np.sqrt(w * EMBEDDED)) for w in WIDTHS],
                   [np.zeros(FILTERS, np.float32) for _ in WIDTHS],
                   scale(FILTERS * len(WIDTHS), len(languages), by=0.1), np.zeros(len(languages), np.float32))

    def parameters(self) -> list[np.ndarray]:
        return [self.embedding, *self.kernels, *self.shifts, self.dense, self.bias]

    def gradients(self, x: np.ndarray, y: np.ndarray) -> list[np.ndarray]:
        """Of the mean cross entropy for windows ``x`` (rows of classes) and language numbers ``y``."""
        n, rows = len(x), np.arange(len(x))
        e = self.embedding[x]
        pooled, at, stacks = [], [], []
        for kernel, shift in zip(self.kernels, self.shifts, strict=True):
            w = len(kernel)
            places = x.shape[1] - w + 1
            stack = np.concatenate([e[:, j: j + places] for j in range(w)], 2)
            out = stack.reshape(n * places, -1) @ kernel.reshape(w * EMBEDDED, FILTERS)
            out = out.reshape(n, places, FILTERS)
            best = out.argmax(1)
            pooled.append(np.take_along_axis(out, best[:, None], 1)[:, 0] + shift)
            at.append(best)
            stacks.append(stack)
        raw = np.concatenate(pooled, 1)
        hidden = np.maximum(raw, 0)
        logits = hidden @ self.dense + self.bias
        p = np.exp(logits - logits.max(1, keepdims=True))
        p /= p.sum(1, keepdims=True)
        p[rows, y] -= 1
        p /= n
        back = (p @ self.dense.T) * (raw > 0)
        g_embedding = np.zeros_like(self.embedding)
        g_kernels, g_shifts = [], []
        for k, kernel in enumerate(self.kernels):
            w = len(kernel)
            g = back[:, k * FILTERS: (k + 1) * FILTERS]
            seen = np.take_along_axis(stacks[k], at[k][:, :, None], 1)  # n x FILTERS x (w * EMBEDDED)
            g_kernels.append(np.einsum("nf,nfd->df", g, seen).reshape(kernel.shape))
            g_shifts.append(g.sum(0))
            into = g[:, :, None, None] * kernel.transpose(2, 0, 1)[None]  # n x FILTERS x w x EMBEDDED
            classes = x[rows[:, None, None], at[k][:, :, None] + np.arange(w)]
            np.add.at(g_embedding, classes.reshape(-1), into.reshape(-1, EMBEDDED))
        return [g_embedding, *g_kernels, *g_shifts, hidden.T @ p, p.sum(0)]

    def compiled(self) -> Compiled:
        return Compiled(self)


class Compiled:
    """Filters as tables of responses by byte class pair."""

    def __init__(self, net: Network):
        self.dense, self.bias, self.languages = net.dense, net.bias, net.languages
        self.shift = np.concatenate(net.shifts)
        single = [[(net.embedding @ k[j]).astype(np.float32) for j in range(len(k))] for k in net.kernels]
        pair = lambda a, b: (a[:, None] + b[None]).reshape(-1, FILTERS)
        self.tables = [(pair(s[0], s[1]), s[2] if len(s) == 3 else pair(s[2], s[3]) if len(s) == 4 else None)
                       for s in single]

    def probabilities(self, x: np.ndarray) -> np.ndarray:
        """Of each window (a row of classes) by language."""
        out = np.empty((len(x), len(self.languages)), np.float32)
        room = np.empty((2, 64 * WINDOW, FILTERS), np.float32)
        for at in range(0, len(x), 64):
            c = x[at: at + 64].astype(np.intp)
            pairs = c[:, :-1] * CLASSES + c[:, 1:]
            pooled = []
            for width, (first, second) in zip(WIDTHS, self.tables, strict=True):
                places = c.shape[1] - width + 1
                n = len(c) * places
                r = np.take(first, pairs[:, :places].reshape(-1), axis=0, out=room[0, :n], mode="clip")
                if second is not None:
                    rest = (c if width == 3 else pairs)[:, 2: 2 + places].reshape(-1)
                    r += np.take(second, rest, axis=0, out=room[1, :n], mode="clip")
                pooled.append(r.reshape(len(c), places, FILTERS).max(1))
            hidden = np.maximum(np.concatenate(pooled, 1) + self.shift, 0)
            logits = hidden @ self.dense + self.bias
            p = np.exp(logits - logits.max(1, keepdims=True))
            out[at: at + 64] = p / p.sum(1, keepdims=True)
        return out


def windows(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Consecutive windows over each row's bytes (the last one padded with space), their rows and bytes."""
    size = np.diff(offsets)
    count = -(-size // WINDOW)
    row = np.repeat(np.arange(len(size)), count)
    within = np.arange(len(row)) - np.repeat(np.cumsum(count) - count, count)
    start = offsets[:-1][row] + within * WINDOW
    n = np.minimum(WINDOW, offsets[1:][row] - start)
    folded = np.concatenate([FOLD[data], np.full(WINDOW, _SPACE, np.uint8)])
    x = folded[start[:, None] + np.arange(WINDOW)]
    short = np.flatnonzero(n < WINDOW)
    x[short] = np.where(np.arange(WINDOW) < n[short, None], x[short], _SPACE)
    return x, row, n


def train(samples: list[tuple[str, str]], seed: int = SEED, epochs: int = EPOCHS) -> Network | None:
    """A network from (language, excerpt) pairs; None without any."""
    languages = sorted({lang for lang, _ in samples})
    if not languages:
        return None
    rng = np.random.default_rng(seed)
    net = Network.random(languages, rng)
    excerpts = [t.encode()[:WINDOW] for _, t in samples]
    y = np.array([languages.index(lang) for lang, _ in samples])
    x = np.full((len(samples), WINDOW), _SPACE, np.uint8)
    for i, t in enumerate(excerpts):
        x[i, : len(t)] = FOLD[np.frombuffer(t, np.uint8)]
    m = [np.zeros_like(p) for p in net.parameters()]
    v = [np.zeros_like(p) for p in net.parameters()]
    step = 0
    for _ in range(epochs):
        order = rng.permutation(len(x))
        for at in range(0, len(order), BATCH):
            take = order[at: at + BATCH]
            seen = x[take].copy()
            # Some windows shortened, as the last ones of texts are.
            for i in np.flatnonzero(rng.random(len(take)) < 0.4):
                seen[i, rng.integers(12, WINDOW):] = _SPACE
            step += 1
            for p, g, a, b in zip(net.parameters(), net.gradients(seen, y[take]), m, v, strict=True):
                a += 0.1 * (g - a)
                b += 0.01 * (g * g - b)
                p -= (0.01 * (a / (1 - 0.9**step)) / (np.sqrt(b / (1 - 0.99**step)) + 1e-8)).astype(np.float32)
    return net


def held_out() -> Column:
    """The fold that nothing is learned from: crc32 of doc_id as text, modulo 4, is 2."""
    return F.coalesce(F.crc32(F.col("doc_id").cast("string").cast("binary")) % 4 == 2, F.lit(False))


def sample(docs: DataFrame, per_language: int = PER_LANGUAGE, excerpts: int = EXCERPTS) -> list[tuple[str, str]]:
    """(lang, excerpt) pairs of at most ``per_language`` documents a language, spread over their texts."""
    n = F.length("text")
    pieces = F.array_distinct(F.array(*[
        F.substring(F.col("text"), (F.floor(n * (k / excerpts)) + 1).cast("int"), F.lit(WINDOW))
        for k in range(excerpts)]))
    usable = docs.filter(~held_out() & F.col("lang").isNotNull()).select(
        F.col("lang").cast("string").alias("lang"), "doc_id", "text", F.xxhash64("doc_id").alias("h"))
    counts = {r["lang"]: r["n"] for r in usable.groupBy("lang").agg(F.count(F.lit(1)).alias("n")).collect()}
    if not counts:
        return []
    first = Window.partitionBy("lang").orderBy("h", "doc_id", "pieces")
    spare = SPARE
    while True:
        # The least hashes are wanted: a limit that some more than those lie under keeps the rest out of the shuffle.
        share = {lang: min(1.0, spare * per_language / n) for lang, n in counts.items()}
        limits = docs.sparkSession.createDataFrame(
            [(lang, min(2**63 - 1, int(s * 2**64) - 2**63)) for lang, s in share.items()], "lang string, most long")
        rows = (usable.join(F.broadcast(limits), "lang").filter((F.col("h") <= F.col("most")) & (F.trim("text") != ""))
                .select("lang", "doc_id", "h", pieces.alias("pieces"))
                .withColumn("n", F.row_number().over(first)).filter(F.col("n") <= per_language))
        # Bounded: per_language * excerpts * WINDOW characters a language.
        got = rows.select("lang", "pieces").collect()
        have = Counter(r["lang"] for r in got)
        if all(have[lang] == per_language or s == 1.0 for lang, s in share.items()):
            return sorted((r["lang"], piece) for r in got for piece in r["pieces"])
        spare *= 16


def _judged(model: Compiled | None, texts: pa.Array) -> tuple[list[str], np.ndarray]:
    """Language and score of every text."""
    data, offsets = tb.buffers(texts)
    letters = np.r_[0, np.cumsum(LETTER[data])]
    known = letters[offsets[1:]] > letters[offsets[:-1]]
    for i in np.flatnonzero(~known & (np.diff(offsets) > 0)).tolist():
        known[i] = any(map(str.isalpha, texts[i].as_py()))
    if not model or not len(data):
        return [UNKNOWN] * len(known), np.zeros(len(known))
    x, row, n = windows(data, offsets)
    total = np.zeros((len(known), len(model.languages)))
    np.add.at(total, row, model.probabilities(x) * n[:, None])
    total /= np.maximum(1, np.diff(offsets))[:, None]
    names = [model.languages[b] if k else UNKNOWN for b, k in zip(total.argmax(1).tolist(), known.tolist(), strict=True)]
    return names, np.where(known, np.clip(total.max(1), 0, 1), 0.0)


def predict(docs: DataFrame, net: Network | None) -> DataFrame:
    """doc_id, held_out, lang_pred, score for every row."""
    sent = docs.sparkSession.sparkContext.broadcast(net)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = sent.value.compiled() if sent.value else None
        for batch in tb.chunks(batches):
            names, score = _judged(model, batch.column("text"))
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), batch.column("held_out"), pa.array(names, pa.string()),
                 pa.array(score, pa.float64())], names=["doc_id", "held_out", "lang_pred", "score"])

    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), held_out().alias("held_out"), "text")
    return rows.mapInArrow(run, "doc_id long, held_out boolean, lang_pred string, score double")


def identify(docs: DataFrame) -> DataFrame:
    return predict(docs, train(sample(docs)))


def recognised(docs: DataFrame, net: Network | None, least: float = MIN_SCORE) -> DataFrame:
    """The rows of ``docs``, all columns, whose text has a language with a score of ``least`` or more."""
    sent = docs.sparkSession.sparkContext.broadcast(net)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = sent.value.compiled() if sent.value else None
        for batch in tb.chunks(batches):
            names, score = _judged(model, batch.column("text"))
            keep = (np.array(names, object) != UNKNOWN) & (score >= least)
            yield batch.filter(pa.array(keep, pa.bool_()))

    return docs.mapInArrow(run, docs.schema)

"""Quality classifier: a byte-level convolutional network in numpy.

Learned filters of WIDTH bytes slide over the text with a stride of STRIDE; their outputs are max-pooled in
half-overlapping chunks of CHUNK bytes that cover the whole document; a hidden layer reads each chunk; its
outputs are pooled over the chunks (maximum and mean) and combined into one probability. Maxima weigh against
quality only: a chunk that would score lower than a text alone then lowers the text it is added to, wherever it is.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from terraloom.llm.tokens import text_slices

WIDTH, STRIDE, HALF, FILTERS, HIDDEN = 6, 2, 256, 24, 16
CHUNK = 2 * HALF
LEAD = WIDTH - STRIDE
#: Bounds of the fitting sample: texts and bytes of text on the driver.
SAMPLE_DOCS, SAMPLE_BYTES = 4000, 32 << 20
EPOCHS, BATCH_BYTES, RATE, SEED = 14, 150_000, 0.01, 11


def layout(buf: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Texts padded with zero bytes to whole half-chunks, two at least, and the first half-chunk of each. The zeros
    before a text keep the last windows of its predecessor from reading it: a score depends on its text alone."""
    sizes = np.diff(offsets)
    halves = np.maximum(2, -(-(sizes + LEAD + WIDTH) // HALF))
    first = np.r_[0, np.cumsum(halves)]
    out = np.zeros(first[-1] * HALF + WIDTH, np.uint8)
    out[np.arange(len(buf)) + np.repeat(first[:-1] * HALF + LEAD - offsets[:-1], sizes)] = buf
    return out, first


def against(w2: np.ndarray) -> np.ndarray:
    """``w2`` with no positive weight on a maximum."""
    w2[:HIDDEN] = np.minimum(w2[:HIDDEN], 0)
    return w2


@dataclass
class ByteNet:
    conv: np.ndarray  # (WIDTH, 256, FILTERS)
    conv_b: np.ndarray
    w1: np.ndarray
    b1: np.ndarray
    w2: np.ndarray  # (2 * HIDDEN,)
    b2: np.ndarray
    _pairs: list | None = None

    @classmethod
    def new(cls, rng: np.random.Generator) -> "ByteNet":
        f = np.float32
        return cls(rng.normal(0, 0.3, (WIDTH, 256, FILTERS)).astype(f), np.zeros(FILTERS, f), rng.normal(0, 0.3, (FILTERS, HIDDEN)).astype(f), np.zeros(HIDDEN, f), against(rng.normal(0, 0.3, 2 * HIDDEN).astype(f)), np.zeros(1, f))

    def params(self) -> list[np.ndarray]:
        return [self.conv, self.conv_b, self.w1, self.b1, self.w2, self.b2]

    def halves(self, x: np.ndarray, keep: bool = False):
        """Largest output of each filter in each half-chunk, and where (with ``keep``)."""
        n = (len(x) - WIDTH) // STRIDE
        if keep:
            z = self.conv[0][x[0 : 2 * n : 2]]
            for j in range(1, WIDTH):
                z += self.conv[j][x[j : j + 2 * n : 2]]
        else:  # two bytes a lookup
            if self._pairs is None:
                self._pairs = [(self.conv[j][:, None] + self.conv[j + 1][None]).reshape(65536, FILTERS) for j in range(0, WIDTH, 2)]
            two = x[: len(x) // 2 * 2].view(">u2").astype(np.int64)
            z = self._pairs[0][two[:n]]
            for k in range(1, WIDTH // 2):
                z += self._pairs[k][two[k : k + n]]
        z = z.reshape(-1, HALF // STRIDE, FILTERS)
        return (z.max(1), z.argmax(1)) if keep else z.max(1)

    def head(self, h: np.ndarray, first: np.ndarray):
        """From half-chunk maxima to probabilities, with what training needs."""
        last = first[1:] - 1
        inner = np.ones(len(h), bool)
        inner[last] = False
        at = np.flatnonzero(inner)  # chunk k covers halves at[k] and at[k]+1
        m = np.maximum(h[at], h[at + 1])
        a = np.maximum(m + self.conv_b, 0)
        z = np.tanh(a @ self.w1 + self.b1)
        b = first[:-1] - np.arange(len(first) - 1)
        top, mean = np.maximum.reduceat(z, b), np.add.reduceat(z, b) / (np.diff(first) - 1)[:, None]
        pooled = np.concatenate([top, mean], 1)
        return 1 / (1 + np.exp(-np.clip(pooled @ self.w2 + self.b2, -30, 30))), (at, m, a, z, b, pooled)

    def score(self, texts: pa.Array) -> np.ndarray:
        out = np.zeros(len(texts))
        for row, buf, offsets in text_slices(texts, 1 << 19):
            x, first = layout(buf, offsets)
            out[row : row + len(offsets) - 1] = self.head(np.concatenate([self.halves(x[i * HALF : min(first[-1], i + 2048) * HALF + WIDTH]) for i in range(0, first[-1], 2048)]), first)[0]
        return out

    def gradients(self, buf: np.ndarray, offsets: np.ndarray, y: np.ndarray, weight: np.ndarray):
        x, first = layout(buf, offsets)
        h, where = self.halves(x, True)
        p, (at, m, a, z, b, pooled) = self.head(h, first)
        d = ((p - y) * weight / len(y)).astype(np.float32)
        g2, gb2 = pooled.T @ d, d.sum(keepdims=True)
        dp = d[:, None] * self.w2
        chunks = np.diff(first) - 1
        doc = np.repeat(np.arange(len(y)), chunks)
        is_top = (z == pooled[doc, :HIDDEN]).astype(z.dtype)
        is_top /= np.add.reduceat(is_top, b)[doc]  # chunks alike share the slope of their maximum
        dz = dp[doc, :HIDDEN] * is_top + dp[doc, HIDDEN:] / chunks[doc, None]
        dz *= 1 - z * z
        g1, gb1 = a.T @ dz, dz.sum(0)
        da = (dz @ self.w1.T) * (a > 0)
        left = h[at] >= h[at + 1]
        half = np.where(left, at[:, None], at[:, None] + 1)
        pos = half * HALF + where[half, np.arange(FILTERS)] * STRIDE
        gc = np.zeros_like(self.conv)
        f = np.broadcast_to(np.arange(FILTERS), pos.shape)
        live = da != 0
        pos, f, v = pos[live], f[live], da[live]
        for j in range(WIDTH):
            gc[j] = np.bincount(x[pos + j].astype(np.int64) * FILTERS + f, v, 256 * FILTERS).reshape(256, FILTERS)
        loss = -np.mean(weight * (y * np.log(p + 1e-9) + (1 - y) * np.log(1 - p + 1e-9)))
        return loss, [gc, da.sum(0), g1, gb1, g2, gb2]


def train(texts: pa.Array, y: np.ndarray, epochs: int = EPOCHS, seed: int = SEED) -> ByteNet:
    """Adam over batches of whole texts of about BATCH_BYTES. Without both labels the score is their constant."""
    rng = np.random.default_rng(seed)
    net = ByteNet.new(rng)
    if len(y) == 0 or y.min() == y.max():
        net.w2[:] = 0
        net.b2[:] = 0 if len(y) == 0 else (4 if y[0] > 0.5 else -4)
        return net
    weight = np.where(y > 0.5, 1.0, min(2.0, max(1.0, 0.5 * y.mean() / (1 - y.mean()))))
    m, v, t = [np.zeros_like(p) for p in net.params()], [np.zeros_like(p) for p in net.params()], 0
    for epoch in range(epochs):
        order = rng.permutation(len(y))
        rate = RATE * 0.5 * (1 + np.cos(np.pi * epoch / epochs))
        for row, buf, offsets in text_slices(texts.take(pa.array(order)), BATCH_BYTES):
            i = order[row : row + len(offsets) - 1]
            _, grads = net.gradients(buf, offsets, y[i], weight[i])
            t += 1
            for p, g, mi, vi in zip(net.params(), grads, m, v):
                mi += 0.1 * (g - mi)
                vi += 0.001 * (g * g - vi)
                p -= (rate * (mi / (1 - 0.9**t)) / (np.sqrt(vi / (1 - 0.999**t)) + 1e-8)).astype(np.float32)
            against(net.w2)
    return net


def fit(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", label_col: str = "quality",
        max_docs: int = SAMPLE_DOCS, max_bytes: int = SAMPLE_BYTES) -> ByteNet:
    """A network from a hash sample of at most about ``max_docs`` labelled texts and ``max_bytes`` of text.

    Null labels and ids teach nothing; of several labels of a document the largest counts. The sampled ids
    are broadcast: their number is bounded by ``max_docs``."""
    lab = (labels.select(F.col(id_col).alias("key"), F.col(label_col).alias("y")).where("key is not null and y is not null")
           .groupBy("key").agg(F.max("y").cast("double").alias("y")))
    n = lab.count()
    d = docs.select(F.col(id_col).alias("key"), F.col(text_col).alias("text"))
    h = F.pmod(F.xxhash64(F.lit("quality"), F.col("key").cast("string")), F.lit(1 << 30))
    lab = lab.where(h < min(1.0, max_docs / max(n, 1)) * (1 << 30))
    sample = d.join(F.broadcast(lab), "key").where("text is not null")
    total = sample.agg(F.coalesce(F.sum(F.octet_length("text")), F.lit(0))).first()[0]
    if total > max_bytes:
        sample = sample.where(h < max_docs / max(n, max_docs) * max_bytes / total * (1 << 30))
    rows = sample.orderBy("key").select("text", "y").toArrow()
    return train(rows.column("text").combine_chunks(), rows.column("y").to_numpy())


def with_quality(docs: DataFrame, net: ByteNet, text_col: str = "text") -> DataFrame:
    """``docs`` with ``_quality``: the probability of label 1. A null text scores as the empty one."""
    shared = docs.sparkSession.sparkContext.broadcast(net.params())
    ready = []

    @F.arrow_udf("double")
    def score(texts: pa.Array) -> pa.Array:
        if not ready:
            ready.append(ByteNet(*shared.value))
        return pa.array(ready[0].score(texts))

    return docs.withColumn("_quality", score(F.col(text_col)))

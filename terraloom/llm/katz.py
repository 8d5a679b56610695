"""Katz backoff scores of whole texts.

Tokens are words with A-Z lower-cased, and one end token a text. Word and word-pair counts of the training
texts are discounted by Good-Turing (counts up to K; Katz's form) and backed off with weights that make every
history's distribution sum to one exactly, by one formula for all histories:

    p(w|h) = d(c(hw)) c(hw) / (c(h) + UNSEEN)   if the pair was seen in training
           = alpha(h) p(w)                      otherwise, with p(w) the discounted word distribution
    p(w)   = d(c(w)) c(w) / N, and the mass that is left for the class of unknown words.

UNSEEN leaves something to back off to where nothing is discounted (a history whose pairs all occur more than
K times); alpha(h) is what the seen pairs leave over the word mass of the unseen, one for an unknown history.

Counts live in hash-partitioned tables (buckets): words by word, pairs by their history, so that a bucket
has all that alpha(h) needs. Histories with at least 1/HOT_PARTS of all tokens (at most HOT_PARTS of them)
are spread over all buckets by their second word and their weights are summed up afterwards, which changes no
probability. Texts are never moved row by row: batches of a few MB ask the word buckets for the counts of their distinct words, then send
their distinct pairs, each with the list of its texts, to the pair buckets, which return one partial
log-probability per text.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from terraloom.llm.common import drop_staged, partitions, release, staged
from terraloom.llm.tokens import mix64, per_text, segment_sums, text_slices, word_hashes, words

K = 5
#: Count every history keeps for the unseen.
UNSEEN = 0.5
HOT_PARTS = 2000
SLICE_BYTES = 8 << 20
#: Bytes of text whose counts share a bucket: a bucket stays as small when the input grows and the partitions do not.
BUCKET_BYTES = 32 << 20
LOW = np.uint64(0xFFFFFFFFFFFF)
END, START = np.uint64(0x454E44454E44454E), np.uint64(0x5354415254535441)
_C = np.uint64(0x9E3779B97F4A7C15)


def tokens(buf: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Token hashes of all texts, each closed by END; the text of each token; each text's first token."""
    s, e = words(buf, offsets)
    first = per_text(s, offsets)
    docs = len(offsets) - 1
    start = first + np.arange(docs + 1)
    out = np.full(len(s) + docs, END, np.uint64)
    out[np.arange(len(s)) + np.repeat(np.arange(docs), np.diff(first))] = word_hashes(buf, s, e)
    return out, np.repeat(np.arange(docs), np.diff(start)), start


def short(x: np.ndarray) -> bytes:
    """The low six bytes of each hash: inside a bucket they tell its histories, and a history's words, apart."""
    return np.ascontiguousarray(x).view(np.uint8).reshape(-1, 8)[:, :6].tobytes()


def unshort(raw, k: int, at: int) -> np.ndarray:
    out = np.zeros((k, 8), np.uint8)
    out[:, :6] = np.frombuffer(raw, np.uint8, 6 * k, at).reshape(-1, 6)
    return out.view(np.uint64)[:, 0]


def by_bucket(bucket: np.ndarray, n: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Stable order by bucket, the cuts between buckets, and the buckets that have entries."""
    order = np.argsort(bucket, kind="stable")
    cut = np.searchsorted(bucket[order], np.arange(n + 1))
    return order, cut, np.flatnonzero(np.diff(cut))


def discounts(n: np.ndarray) -> np.ndarray:
    """Discount ratios d[0..K] from counts of counts n[1..K+1] (n[0] is unused).

    Katz's Good-Turing ratios; where the counts of counts are too sparse to give ratios in (0, 1], absolute
    discounting with n1/(n1+2 n2); without singletons nothing is discounted."""
    n = n.astype(float)
    r = np.arange(1, K + 1)
    if n[1] <= 0:
        return np.ones(K + 1)
    d = np.zeros(K)
    a = (K + 1) * n[K + 1] / n[1]
    if (n[1 : K + 2] > 0).all() and a < 1:
        d = ((r + 1) * n[2 : K + 2] / (r * n[1 : K + 1]) - a) / (1 - a)
    if not ((d > 0) & (d <= 1)).all():
        d = (r - n[1] / (n[1] + 2 * max(n[2], 0.5))) / r
    return np.r_[1.0, d]


class Model:
    """Closed forms shared by all buckets: N, V and counts of counts of words and pairs."""

    def __init__(self, stats: np.ndarray):
        self.stats = stats
        nw, n2, (self.n, self.v) = stats[: K + 2], stats[K + 2 : 2 * K + 4], stats[2 * K + 4 :]
        self.dw, self.d2 = discounts(nw), discounts(n2)
        held = sum((1 - self.dw[r]) * r * nw[r] for r in range(1, K + 1)) / max(self.n, 1)
        floor = 1 / (self.n + self.v + 1)
        self.unknown = max(held, floor) if self.n else 1.0
        self.scale = (1 - self.unknown) / (1 - held) if self.n else 0.0

    def discounted(self, c: np.ndarray, d: np.ndarray) -> np.ndarray:
        return np.where(c <= K, d[np.minimum(c, K)], 1.0) * c

    def p_word(self, c: np.ndarray) -> np.ndarray:
        return np.where(c > 0, self.discounted(c, self.dw) * self.scale / max(self.n, 1), self.unknown)

    def base(self, c: np.ndarray) -> np.ndarray:
        return np.log10((c + 0.5) / (self.n + 0.5 * (self.v + 1)))


def pair_scores(m: Model, h: np.ndarray, w: np.ndarray, cw: np.ndarray, n: np.ndarray, hot: np.ndarray, hot_c: np.ndarray):
    """For entries sorted by (h, w) with training counts ``n``: the log10 probability of each entry, and for
    hot histories (index, seen mass, word mass of the seen, per-entry index or -1 for unseen pairs)."""
    new_h = np.r_[True, h[1:] != h[:-1]]
    new = new_h | np.r_[True, w[1:] != w[:-1]]
    at = np.flatnonzero(new)
    pair = np.cumsum(new) - 1
    c = np.add.reduceat(n, at)
    hp, pw = h[at], m.p_word(cw[at])
    first = np.flatnonzero(new_h[at])
    hist = np.cumsum(new_h[at]) - 1
    ch = np.add.reduceat(c, first).astype(float)
    k = np.minimum(np.searchsorted(hot, hp[first]), max(len(hot) - 1, 0))
    is_hot = (hot[k] == hp[first]) if len(hot) else np.zeros(len(first), bool)
    if len(hot):
        ch = np.where(is_hot, hot_c[k], ch)
    mass = m.discounted(c, m.d2) / (ch + UNSEEN)[hist]
    seen = c > 0
    d = np.add.reduceat(mass, first)
    s = np.add.reduceat(np.where(seen, pw, 0.0), first)
    alpha = np.where(ch > 0, (1 - d) / np.maximum(1 - s, 1e-12), 1.0)
    alpha = np.where(is_hot, 1.0, alpha)
    with np.errstate(divide="ignore"):
        value = np.log10(np.where(seen, mass, alpha[hist] * pw))
    return value[pair], (k[is_hot], d[is_hot], s[is_hot]), np.where(is_hot[hist] & ~seen, k[hist], -1)[pair]


def katz_scores(docs: DataFrame, held_out: Column, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score) for every row.

    ``held_out`` rows teach nothing. A null text is empty: one end token. Repeated rows count each time.
    Without training texts every token is unknown with probability one. An empty table gives no rows; extra
    columns are ignored.
    """
    spark = docs.sparkSession
    d = docs.select(F.col(id_col).alias("doc_id"), held_out.alias("held"), F.col(text_col).alias("text"))
    id_type = d.schema["doc_id"].dataType.simpleString()
    size = d.agg(F.coalesce(F.sum(F.octet_length("text")), F.lit(0))).first()[0]
    buckets = max(2 * partitions(spark), size // BUCKET_BYTES)

    def slices(batches):
        """(number of the slice in the whole input, rows, bytes, offsets): the same at each pass and retry."""
        part, k = TaskContext.get().partitionId(), 0
        for batch in batches:
            for row, buf, offsets in text_slices(batch.column("text"), SLICE_BYTES):
                yield part << 24 | k, batch.slice(row, len(offsets) - 1), buf, offsets
                k += 1

    def count(batches):
        for no, rows, buf, offsets in slices(batches):
            w, doc, start = tokens(buf, offsets)
            train = ~rows.column("held").to_numpy(zero_copy_only=False)[doc]
            u, inv = np.unique(w, return_inverse=True)
            c = np.bincount(inv, train, len(u)).astype(np.uint32)
            order, cut, full = by_bucket((mix64(u) % np.uint64(buckets)).astype(np.int64), buckets)
            out = [u[order[cut[b] : cut[b + 1]]].tobytes() + c[order[cut[b] : cut[b + 1]]].tobytes() for b in full]
            h = np.r_[START, w[:-1]]
            h[start[:-1]] = START
            pair, c = np.unique(mix64(h * _C + w)[train], return_counts=True)
            order, cut, full2 = by_bucket((mix64(pair) % np.uint64(buckets)).astype(np.int64), buckets)
            short = pair.view(np.uint8).reshape(-1, 8)[:, :6]
            out += [short[order[cut[b] : cut[b + 1]]].tobytes() + c[order[cut[b] : cut[b + 1]]].astype(np.uint32).tobytes() for b in full2]
            n = len(full) + len(full2)
            yield pa.RecordBatch.from_arrays([pa.array(np.r_[full, full2].astype(np.int32)), pa.array(np.full(n, no)), pa.array(np.r_[np.zeros(len(full), np.int32), np.ones(len(full2), np.int32)].astype(np.int32)), pa.array(out, pa.binary())], ["bucket", "batch", "kind", "payload"])

    table = "batch long, bucket int, payload binary, stats array<long>"

    def add_up(t: pa.Table) -> pa.Table:
        kind, payload = t.column("kind").to_numpy(), [x.as_buffer() for x in t.column("payload")]
        batch = t.column("batch").to_numpy()
        at = np.flatnonzero(kind == 0)
        keys = [np.frombuffer(payload[i], np.uint64, payload[i].size // 12) for i in at]
        sums = [np.frombuffer(payload[i], np.uint32, len(k), 8 * len(k)) for i, k in zip(at, keys)]
        u, inv = np.unique(np.concatenate(keys) if keys else np.zeros(0, np.uint64), return_inverse=True)
        c = np.bincount(inv, np.concatenate(sums) if sums else None, len(u)).astype(np.int64)
        ends = np.cumsum([len(k) for k in keys])
        answers = [c[inv[e - len(k) : e]].astype(np.uint32).tobytes() for k, e in zip(keys, ends)]
        parts = [np.frombuffer(payload[i], np.uint8) for i in np.flatnonzero(kind == 1)]
        count2 = np.zeros(0, np.int64)
        if parts:
            full = np.zeros((sum(len(p) // 10 for p in parts), 8), np.uint8)
            full[:, :6] = np.concatenate([p[: len(p) // 10 * 6] for p in parts]).reshape(-1, 6)
            n2 = np.concatenate([p[len(p) // 10 * 6 :].view(np.uint32) if p.ctypes.data % 4 == 0 and (len(p) // 10 * 6) % 4 == 0 else np.frombuffer(p[len(p) // 10 * 6 :].tobytes(), np.uint32) for p in parts]).astype(np.int64)
            x = full.view(np.uint64)[:, 0]
            order = np.argsort(x, kind="stable")
            x = x[order]
            count2 = np.add.reduceat(n2[order], np.flatnonzero(np.r_[True, x[1:] != x[:-1]]))
        tally = lambda v: np.r_[0, np.bincount(v[(v > 0) & (v <= K + 1)], minlength=K + 2)[1:]]
        stats = np.r_[tally(c), tally(count2), c.sum(), (c > 0).sum()]
        b = t.column("bucket")[0].as_py()
        stored = u[c > 0].tobytes() + c[c > 0].tobytes()  # this bucket of the word table
        return pa.table({"batch": pa.array(np.r_[batch[at], -1].astype(np.int64)), "bucket": pa.array(np.full(len(at) + 1, b, np.int32)), "payload": pa.array([*answers, stored], pa.binary()), "stats": pa.array([None] * len(at) + [stats.tolist()], pa.list_(pa.int64()))})

    counted = staged(d.select("held", "text").mapInArrow(count, "bucket int, batch long, kind int, payload binary").groupBy("bucket").applyInArrow(add_up, table), "words")
    release(spark)
    own = counted.where("batch = -1")
    summed = own.select(F.posexplode("stats")).groupBy("pos").agg(F.sum("col").alias("n")).collect()
    stats = np.zeros(2 * K + 6, np.int64)
    for r in summed:
        stats[r["pos"]] = r["n"]
    model = Model(stats)
    n_train = int(model.n)

    def frequent(batches):
        for b in batches:
            for x in b.column("payload"):
                n = x.as_buffer().size // 16
                u, c = np.frombuffer(x.as_buffer(), np.uint64, n), np.frombuffer(x.as_buffer(), np.int64, n, 8 * n)
                top = c * HOT_PARTS >= max(n_train, 1)
                yield pa.RecordBatch.from_arrays([pa.array(u[top].view(np.int64)), pa.array(c[top])], ["h", "c"])

    rows = own.select("payload").mapInArrow(frequent, "h long, c long").collect()
    hot = np.array([r["h"] for r in rows], np.int64).view(np.uint64)
    hot_c = np.array([r["c"] for r in rows], np.int64)
    hot, hot_c = np.r_[hot, START], np.r_[hot_c, hot_c[hot == END].sum()]
    order = np.argsort(hot)
    hot, hot_c = hot[order], hot_c[order]

    # the pair buckets know histories by their low six bytes
    order = np.argsort(hot & LOW)
    hot_short, hot_short_c = (hot & LOW)[order], hot_c[order]

    def ship(batches):
        for no, rows, buf, offsets in slices(batches):
            one = np.array([0, len(rows)], np.int32)
            yield pa.RecordBatch.from_arrays([
                pa.array([no]), pa.ListArray.from_arrays(pa.array(one), rows.column("doc_id")), pa.ListArray.from_arrays(pa.array(one), rows.column("held")),
                pa.array([pa.Codec("zstd", compression_level=9).compress(buf.tobytes(), asbytes=True)], pa.binary()), pa.array([len(buf)]), pa.array([offsets.astype(np.int64).tobytes()], pa.binary())], ["batch", "ids", "held", "text", "size", "offsets"])

    texts = d.mapInArrow(ship, f"batch long, ids array<{id_type}>, held array<boolean>, text binary, size long, offsets binary")
    entries = f"bucket long, batch long, kind int, payload binary, ids array<{id_type}>, held array<boolean>"

    def ask(left: pa.Table, right: pa.Table) -> pa.Table:
        row = left.slice(0, 1)
        no = row.column("batch")[0].as_py()
        offsets = np.frombuffer(row.column("offsets")[0].as_buffer(), np.int64)
        buf = np.frombuffer(pa.decompress(row.column("text")[0].as_buffer(), row.column("size")[0].as_py(), "zstd"), np.uint8) if offsets[-1] else np.zeros(0, np.uint8)
        w, doc, start = tokens(buf, offsets)
        held = row.column("held").combine_chunks().flatten().to_numpy(zero_copy_only=False)
        u, inv = np.unique(w, return_inverse=True)
        order, cut, _ = by_bucket((mix64(u) % np.uint64(buckets)).astype(np.int64), buckets)
        cw = np.zeros(len(u), np.int64)
        for b, x in zip(right.column("bucket").to_pylist(), right.column("payload")):
            cw[order[cut[b] : cut[b + 1]]] = np.frombuffer(x.as_buffer(), np.uint32)
        c = cw[inv]
        info = np.diff(start).astype(np.int64).tobytes() + segment_sums(c > 0, start).astype(np.int64).tobytes() + segment_sums(model.base(c), start).tobytes()
        hi = np.r_[0, inv[:-1]].astype(np.uint64)
        hi[start[:-1]] = len(u)
        key = hi << np.uint64(32) | inv.astype(np.uint64)
        order = np.argsort(key, kind="stable")  # texts stay in order inside a pair
        key, doc = key[order], doc[order]
        new_k = np.r_[True, key[1:] != key[:-1]]
        new_d = np.flatnonzero(new_k | np.r_[True, doc[1:] != doc[:-1]])
        times = np.diff(np.r_[new_d, len(key)])
        doc = doc[new_d]
        e = np.flatnonzero(new_k[new_d])  # first text of each pair
        lists = np.diff(np.r_[e, len(doc)])
        key = key[new_d][e]
        names = np.r_[u, START]
        h, wi = names[(key >> np.uint64(32)).astype(np.int64)], (key & np.uint64(0xFFFFFFFF)).astype(np.int64)
        word = u[wi]
        n_train = np.add.reduceat(times * ~held[doc], e)
        spread = np.isin(h, hot)
        bucket = (mix64(np.where(spread, h * _C + word, h)) % np.uint64(buckets)).astype(np.int64)
        order, cut, full = by_bucket(bucket, buckets)
        out = []
        for b in full:
            i = order[cut[b] : cut[b + 1]]
            hh = h[i]
            heads = np.flatnonzero(np.r_[True, hh[1:] != hh[:-1]])
            k = lists[i]
            j = np.repeat(e[i] - np.r_[0, np.cumsum(k)[:-1]], k) + np.arange(k.sum())
            mine, at = np.unique(wi[i], return_inverse=True)  # each word of the bucket once
            raw = short(hh[heads]) + short(u[mine]) + b"".join(x.tobytes() for x in (np.diff(np.r_[heads, len(i)]).astype(np.uint32), cw[mine].astype(np.uint32), at.astype(np.uint32), n_train[i].astype(np.uint32), k.astype(np.uint32), doc[j].astype(np.uint32), times[j].astype(np.uint32)))
            out.append(np.array([len(heads), len(mine), len(i), len(j)], np.uint32).tobytes() + pa.compress(raw, "zstd", asbytes=True))
        n = len(full)
        return pa.table({"bucket": pa.array(np.r_[full, -1 - no].astype(np.int64)), "batch": pa.array(np.full(n + 1, no)), "kind": pa.array(np.r_[np.ones(n), 0].astype(np.int32)), "payload": pa.array([*out, info], pa.binary()),
                         "ids": pa.concat_arrays([pa.nulls(n, row.schema.field("ids").type), row.column("ids").combine_chunks()]), "held": pa.concat_arrays([pa.nulls(n, row.schema.field("held").type), row.column("held").combine_chunks()])})

    parts_type = f"batch long, kind int, payload binary, x int, d double, s double, ids array<{id_type}>, held array<boolean>"

    def evaluate(t: pa.Table) -> pa.Table:
        def rows(batch, kind, payload, x=None, dd=None, ss=None, ids=None, held=None):
            n = len(batch)
            null = lambda v, k: pa.nulls(n, k) if v is None else v
            return pa.table({"batch": pa.array(batch, pa.int64()), "kind": pa.array(kind, pa.int32()), "payload": null(payload, pa.binary()), "x": null(x, pa.int32()), "d": null(dd, pa.float64()), "s": null(ss, pa.float64()),
                             "ids": null(ids, t.schema.field("ids").type), "held": null(held, t.schema.field("held").type)})

        if t.column("kind")[0].as_py() == 0:
            return rows(t.column("batch").to_pylist(), [0] * len(t), t.column("payload").combine_chunks(), ids=t.column("ids").combine_chunks(), held=t.column("held").combine_chunks())
        batch = t.column("batch").to_numpy()
        cols = [[] for _ in range(8)]
        for row, x in enumerate(t.column("payload")):
            buf = x.as_buffer()
            heads, mine, n, m = (int(v) for v in np.frombuffer(buf, np.uint32, 4))
            raw = pa.decompress(buf.slice(16), 10 * heads + 10 * mine + 12 * n + 8 * m, "zstd")
            h, mw = unshort(raw, heads, 0), unshort(raw, mine, 6 * heads)
            fan, mc, at, nt, k, doc, times = np.split(np.frombuffer(raw, np.uint32, offset=6 * (heads + mine)), np.cumsum([heads, mine, n, n, n, m]))
            for c, v in zip(cols, [np.repeat(h, fan), mw[at], mc[at], nt, k, doc, times, np.full(n, row, np.int32)]):
                c.append(v)
        h, w, cw, nt, k, doc, times, row = (np.concatenate(c) for c in cols)
        order = np.lexsort((w, h))
        value, (hx, hd, hs), unseen = pair_scores(model, h[order], w[order], cw[order].astype(np.int64), nt[order].astype(np.int64), hot_short, hot_short_c)
        back = np.empty(len(order), np.int64)
        back[order] = np.arange(len(order))
        value, unseen = value[back], unseen[back]
        entry = np.repeat(np.arange(len(k)), k)
        per = doc.max() + 1 if len(doc) else 1
        slot = row[entry].astype(np.int64) * per + doc
        total = np.bincount(slot, value[entry] * times, len(batch) * per).reshape(len(batch), per)
        touched = np.bincount(slot, minlength=len(batch) * per).reshape(len(batch), per) > 0
        payload, kinds, of = [], [], []
        for i in range(len(batch)):
            on = np.flatnonzero(touched[i])
            payload.append(on.astype(np.uint32).tobytes() + total[i, on].tobytes())
            kinds.append(1)
            of.append(int(batch[i]))
        lost = np.flatnonzero(unseen[entry] >= 0)
        if len(lost):  # unseen pairs of hot histories still need alpha(h): how many per text and history
            key = (slot[lost] * len(hot) + unseen[entry][lost]).astype(np.int64)
            key, inv = np.unique(key, return_inverse=True)
            n = np.bincount(inv, times[lost])
            which = key // len(hot) // per
            cut = np.searchsorted(which, np.arange(len(batch) + 1))
            for i in range(len(batch)):
                s = slice(cut[i], cut[i + 1])
                if cut[i + 1] > cut[i]:
                    payload.append((key[s] // len(hot) % per).astype(np.uint32).tobytes() + (key[s] % len(hot)).astype(np.uint32).tobytes() + n[s].astype(np.uint32).tobytes())
                    kinds.append(2)
                    of.append(int(batch[i]))
        out = rows(of, kinds, pa.array(payload, pa.binary()))
        return pa.concat_tables([out, rows([-1] * len(hx), [3] * len(hx), None, pa.array(hx.astype(np.int32)), pa.array(hd), pa.array(hs))])

    asked = texts.groupBy("batch").cogroup(counted.where("batch >= 0").select("batch", "bucket", "payload").groupBy("batch")).applyInArrow(ask, entries)
    parts = staged(asked.groupBy("bucket").applyInArrow(evaluate, parts_type), "parts")
    release(spark)
    drop_staged(counted)
    alpha = np.zeros(len(hot))
    for r in parts.where("kind = 3").groupBy("x").agg(F.sum("d").alias("d"), F.sum("s").alias("s")).collect():
        alpha[r["x"]] = np.log10(max(1 - r["d"], 1e-12) / max(1 - r["s"], 1e-12)) if hot_short_c[r["x"]] else 0.0

    def gather(t: pa.Table) -> pa.Table:
        kind = t.column("kind").to_numpy()
        i = int(np.flatnonzero(kind == 0)[0])
        ids, held = t.column("ids")[i].values, t.column("held")[i].values
        info = t.column("payload")[i].as_buffer()
        n = len(ids)
        score = np.zeros(n)
        for k, x in zip(kind, t.column("payload")):
            b = x.as_buffer()
            if k == 1:
                m = b.size // 12
                score[np.frombuffer(b, np.uint32, m)] += np.frombuffer(b.to_pybytes(), np.float64, m, 4 * m)
            elif k == 2:
                m = b.size // 12
                v = np.frombuffer(b, np.uint32)
                score += np.bincount(v[:m], alpha[v[m : 2 * m]] * v[2 * m :], n)
        return pa.table({"doc_id": ids, "held_out": held, "n_tokens": pa.array(np.frombuffer(info, np.int64, n)), "n_known": pa.array(np.frombuffer(info, np.int64, n, 8 * n)), "train_tokens": pa.array(np.full(n, n_train)),
                         "base_score": pa.array(np.frombuffer(info, np.float64, n, 16 * n)), "score": pa.array(score)})

    return parts.where("kind < 3").groupBy("batch").applyInArrow(gather, f"doc_id {id_type}, held_out boolean, n_tokens long, n_known long, train_tokens long, base_score double, score double")

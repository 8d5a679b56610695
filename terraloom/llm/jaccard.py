"""Exact n-gram Jaccard join by universe partition and pigeonhole.

A document's set holds its distinct word 5-grams (64-bit hashes). Two sets of sizes a and b reach the
similarity only if their symmetric difference is at most (1-t)/(1+t) * (a+b). Per size band (a power of two)
the shingle universe is hashed into m segments, of which the first r also index one-deletion neighbourhoods;
one agreeing segment counts one unit, a segment that agrees up to one deletion two, so a set whose segments
give more units than the largest difference cannot miss a partner. A cost model picks m and r for each band;
per set, segments without a rare shingle (blank ones, or shared passages only) are left out and not counted.
Sets left with too few units ("poor") also index a prefix of their rarest shingles, which finds all pairs of
poor sets. Which shingles count as frequent comes from a bounded sample; it moves cost only, never results.

Each set then leaves its largest candidate groups to the others as far as its spare units allow, so groups
around shared passages fall away. Signatures travel packed, a few rows per task and bucket. Candidate groups are verified exactly: first each
set against a hub of its groups, then, after merging what is linked, only pairs of
different components. Identical sets are one set throughout; groups of copies never expand into pairs.
"""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from terraloom.llm.common import connected_components, drop_staged, in_batches_of, partitions, release, staged
from terraloom.llm.tokens import mix64, per_text, text_slices, word_hashes, words

N = 5
#: Texts of the frequency sample: SAMPLE, or one in SAMPLE_SHARE of a larger corpus. A shingle counts as frequent from
#: FREQUENT sampled sets on; of more than HOT such shingles the most frequent are taken (this moves cost only).
SAMPLE, SAMPLE_SHARE, FREQUENT, HOT = 10_000, 1000, 4, 1 << 20
#: Bytes of text handled at once, and of an Arrow batch: a batch passes its limit by a row, which seldom makes a second slice.
SLICE_BYTES, BATCH_BYTES = 4 << 20, 7 << 19
#: Rows of Parquet decoded at once.
READ_ROWS = 256
#: Shingles whose signatures are worked out at once.
PIECE = 1 << 17
#: Shingles whose signatures share a bucket: a bucket stays as small when the input grows and the partitions do not.
BUCKET_SHINGLES = 4_000_000
#: Least and largest size of a candidate filter, as powers of two of its bits.
MIN_FILTER_BITS, MAX_FILTER_BITS = 20, 28
#: Members of a candidate group in one row.
CHUNK = 8192
BINS = 1024
#: Members of a candidate group compared at once with as many others.
BLOCK = 512
_C = [np.uint64(c) for c in (0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9, 0xD6E8FEB86659FD93, 0xA0761D6478BD642F)]
_K = np.uint64(0x8EBC6AF09C88C6E3)


def shingle_sets(buf: np.ndarray, offsets: np.ndarray, n: int = N) -> tuple[np.ndarray, np.ndarray]:
    """Sorted distinct shingle hashes of all texts, one after another, and each text's set size.

    Fewer than ``n`` words make one shingle of the whole sequence; no word, no shingle."""
    s, e = words(buf, offsets)
    w = word_hashes(buf, s, e)
    first = per_text(s, offsets)
    count = np.diff(first)
    runs = np.zeros(max(0, len(w) - n + 1), np.uint64)
    for j in range(n):
        runs += w[j : j + len(runs)] * np.uint64(int(_C[j % 5]) * (2 * (j // 5) + 1) % 2**64)
    runs = mix64(runs)
    parts, sizes = [], np.zeros(len(count), np.int64)
    for i, k in enumerate(count):
        a = first[i]
        if k >= n:
            x = np.unique(runs[a : a + k - n + 1])
        elif k:
            scale = np.array([int(_C[j % 5]) * (2 * (j // 5) + 1) % 2**64 for j in range(k)], np.uint64)
            x = mix64((np.add.reduce(w[a : a + k] * scale, keepdims=True) + np.uint64(k)) ^ _K)
        else:
            continue
        sizes[i] = len(x)
        parts.append(x)
    return (np.concatenate(parts) if parts else np.zeros(0, np.uint64)), sizes


def fingerprints(h: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """One even 64-bit fingerprint a set (0 for the empty one); the last bit is left for a role."""
    out = np.zeros(len(sizes), np.uint64)
    live = np.flatnonzero(sizes)
    if len(live):
        at = np.r_[0, np.cumsum(sizes)[:-1]][live]
        out[live] = mix64(np.add.reduceat(mix64(h ^ _K), at) * _C[1] + np.add.reduceat(h, at) * _C[2] + sizes[live].astype(np.uint64)) & ~np.uint64(1)
    return out


def band_plan(percent: int, bands: int = 40) -> tuple[np.ndarray, np.ndarray]:
    """Segments m and one-deletion segments r of each size band [2^b, 2^(b+1)): the cheapest split whose
    expected units at the band's top, less three deviations, still exceed the largest difference."""
    m_of, r_of = np.ones(bands, np.int64), np.zeros(bands, np.int64)
    for b in range(bands):
        top = 2 ** (b + 1) - 1
        need = max_difference(2 * top, percent) + 1
        best = None
        for rho in (0, 0.05, 0.1, 0.2, 0.35, 0.5, 1):
            m = max(1, int(need / (1 + rho)))
            while True:
                r = math.ceil(rho * m)
                lam = top / m
                none, one = math.exp(-lam), lam * math.exp(-lam)
                units = (m - r) * (1 - none) + r * (2 - 2 * none - one)
                if units - 3 * math.sqrt(m * none + r * one) >= need or m > 4 * need + 16:
                    break
                m += max(1, m // 50)
            size = 0.75 * top
            cost = m * (1 - math.exp(-size / m)) + r * size / m
            if best is None or cost < best[0]:
                best = (cost, m, r)
        m_of[b], r_of[b] = best[1:]
    return m_of, r_of


def max_difference(total: int, percent: int) -> int:
    """Largest symmetric difference of two sets with ``total`` elements together and enough similarity."""
    return (100 - percent) * total // (100 + percent)


def signatures(h: np.ndarray, sizes: np.ndarray, hot: np.ndarray, hot_n: np.ndarray, percent: int, plan) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Signatures, 2 * set index + role of each, and the slack (set, role), for runs of sets of about PIECE shingles."""
    start = np.r_[0, np.cumsum(sizes)]
    sig, doc, slack = [np.zeros(0, np.uint64)], [np.zeros(0, np.int64)], [np.zeros((0, 2), np.int64)]
    i = 0
    while i < len(sizes):
        j = max(i + 1, int(np.searchsorted(start, start[i] + PIECE, "right")) - 1)
        s, d, k = _signatures(h[start[i] : start[j]], sizes[i:j], hot, hot_n, percent, plan)
        sig.append(s)
        doc.append(d + 2 * i)
        slack.append(k)
        i = j
    return np.concatenate(sig), np.concatenate(doc), np.concatenate(slack)


def _signatures(h: np.ndarray, sizes: np.ndarray, hot: np.ndarray, hot_n: np.ndarray, percent: int, plan) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The same for one run; see the module's text.

    Role 0 is a set in its own size band, role 1 a visitor in the next. The last bit of a signature tells
    prefix (1) from segment (0). Slack: the units a set has beyond those it needs, -1 if it is poor."""
    out_s, out_d = [np.zeros(0, np.uint64)], [np.zeros(0, np.int64)]
    n_docs = len(sizes)
    slack = np.full((n_docs, 2), -1)
    even = ~np.uint64(1)
    doc = np.repeat(np.arange(n_docs), sizes)
    if len(hot):
        at = np.minimum(np.searchsorted(hot, h), len(hot) - 1)
        df = np.where(hot[at] == h, hot_n[at], 0)
    else:
        df = np.zeros(len(h), np.int64)
    rare = df == 0
    value, place = mix64(h ^ _K), mix64(h + _C[3])
    start = np.r_[0, np.cumsum(sizes)]
    own = np.frexp(np.maximum(sizes, 1).astype(np.float64))[1] - 1
    for visit in (0, 1):
        band = own + visit
        floor = 1 << band
        # as a visitor in the next band a set meets larger ones only, of at most size / similarity
        use = (sizes > 0) & ((visit == 0) | (100 * sizes >= percent * floor))
        if not use.any():
            continue
        m, r = np.where(use, plan[0][band], 0), plan[1][band]
        base = np.r_[0, np.cumsum(m)]
        live = use[doc]
        d, v = doc[live], value[live]
        seg = (place[live] % m[d].astype(np.uint64)).astype(np.int64)
        g = base[d] + seg
        total = int(base[-1])
        sums = np.zeros(total, np.uint64)
        np.add.at(sums, g, v)
        rares = np.bincount(g, rare[live], total).astype(np.int64)
        seg_doc = np.repeat(np.arange(n_docs), m)
        seg_no = np.arange(total) - base[seg_doc]
        tag = mix64((band[seg_doc].astype(np.uint64) << np.uint64(40)) + seg_no.astype(np.uint64) + _C[4])
        deletes = (seg_no < r[seg_doc]) & (rares >= 2)
        whole = rares >= 1
        out_s.append(mix64(sums[whole] + tag[whole]) & even)
        out_d.append(2 * seg_doc[whole] + visit)
        z = deletes[g]
        out_s.append(mix64(sums[g[z]] - v[z] + tag[g[z]]) & even)
        out_d.append(2 * d[z] + visit)
        units = np.bincount(seg_doc, whole.astype(np.int64) + deletes, n_docs)
        partner = np.minimum(100 * sizes // percent, 2 * floor - 1)
        need = (100 - percent) * (sizes + partner) // (100 + percent) + 1
        # a segment counts once here even where it stands for two units: what may be skipped errs on the safe side
        slack[:, visit] = np.where(use & (units >= need), (units - need) // np.where(r > 0, 2, 1), -1)
        for i in np.flatnonzero(use & (units < need)):
            x, f = h[start[i] : start[i + 1]], df[start[i] : start[i + 1]]
            k = len(x) - -(-percent * len(x) // 100) + 1
            x = x[np.lexsort((x, f))[:k]]
            out_s.append(mix64(x + mix64(np.array([band[i] + 1000], np.uint64))) | np.uint64(1))
            out_d.append(np.full(k, 2 * i + visit))
    return np.concatenate(out_s), np.concatenate(out_d), slack


def pack(fp: np.ndarray, sig: np.ndarray, doc: np.ndarray) -> bytes:
    present, idx = np.unique(doc, return_inverse=True)
    short = np.ascontiguousarray(sig).view(np.uint8).reshape(-1, 8)[:, :5]
    return np.array([len(present), len(sig)], np.uint32).tobytes() + fp[present].tobytes() + short.tobytes() + idx.astype(np.uint32 if len(present) > 65535 else np.uint16).tobytes()


def unpack(blob) -> tuple[np.ndarray, np.ndarray]:
    """Signatures (40 bits) and fingerprints of one packed row."""
    docs, k = (int(x) for x in np.frombuffer(blob, np.uint32, 2))
    fp = np.frombuffer(blob, np.uint64, docs, 8)
    short = np.frombuffer(blob, np.uint8, 5 * k, 8 + 8 * docs).reshape(-1, 5)
    sig = np.zeros((k, 8), np.uint8)
    sig[:, :5] = short
    idx = np.frombuffer(blob, np.uint32 if docs > 65535 else np.uint16, k, 8 + 8 * docs + 5 * k)
    return sig.view(np.uint64)[:, 0], fp[idx]


def unique_sets(text: pa.Array, n: int):
    """Per slice of texts: (first row, sizes, fingerprints of all; shingles, sizes, fingerprints of the different sets)."""
    for row, buf, offsets in text_slices(text, SLICE_BYTES):
        h, sizes = shingle_sets(buf, offsets, n)
        fp = fingerprints(h, sizes)
        _, keep = np.unique(fp, return_index=True)
        keep = np.sort(keep[sizes[keep] > 0])
        start = np.r_[0, np.cumsum(sizes)]
        parts = [h[start[i] : start[i + 1]] for i in keep]
        yield row, sizes, fp, (np.concatenate(parts) if parts else h[:0]), sizes[keep], fp[keep]


def _slot(fp: np.ndarray, bits: int) -> np.ndarray:
    """Place of each fingerprint in a filter of 2^bits bits: its top bits."""
    return (fp.view(np.uint64) >> np.uint64(64 - bits)).astype(np.int64)


def fixed_filter(ids: DataFrame) -> tuple[int, np.ndarray]:
    """(bits, bitmap of 2^bits bits) over the ids' top bits, ORed by map-side aggregation. It has eight bits an id
    up to 2^MAX_FILTER_BITS (32 MB); beyond that it only lets more through."""
    n = ids.count()
    bits = min(MAX_FILTER_BITS, max(MIN_FILTER_BITS, (8 * n).bit_length()))
    slot = F.shiftrightunsigned("fp", 64 - bits)
    rows = ids.groupBy(F.shiftright(slot, 6).alias("word")).agg(F.bit_or(F.expr(f"shiftleft(1L, CAST(shiftrightunsigned(fp, {64 - bits}) & 63 AS INT))")).alias("mask")).toArrow()
    packed = np.zeros(1 << bits - 6, np.uint64)
    packed[rows.column("word").to_numpy()] = rows.column("mask").to_numpy().view(np.uint64)
    return bits, packed


def passes(fp: np.ndarray, bits: int, packed: np.ndarray) -> np.ndarray:
    at = _slot(fp, bits)
    return (packed[at >> 6] >> (at & 63).astype(np.uint64) & np.uint64(1)).astype(bool)


def bounded(pairs: DataFrame, profiles: DataFrame, percent: int) -> DataFrame:
    """The pairs that may reach the similarity: the sum over BINS hash bins of the smaller count is never
    below the intersection, so a pair is dropped only if its sets cannot be similar enough."""
    def bound(batches):
        for batch in batches:
            x = np.frombuffer(b"".join(batch.column("pa").to_pylist()), np.uint8).reshape(-1, BINS).astype(np.int32)
            y = np.frombuffer(b"".join(batch.column("pb").to_pylist()), np.uint8).reshape(-1, BINS).astype(np.int32)
            both = np.minimum(x, y).sum(1)
            full = (x == 255).any(1) | (y == 255).any(1)
            yield batch.select(["a", "b"]).filter(pa.array(full | (100 * both >= percent * (x.sum(1) + y.sum(1) - both))))

    j = pairs.join(profiles.select(F.col("fp").alias("b"), F.col("profile").alias("pb")), "b")
    j = j.join(profiles.select(F.col("fp").alias("a"), F.col("profile").alias("pa")), "a").select("a", "b", "pa", "pb")
    return j.mapInArrow(bound, "a long, b long")


def verified(pairs: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """The pairs (a, b) whose sets reach the similarity, compared element by element."""
    def compare(batches):
        for batch in batches:
            keep = []
            for x, y in zip(batch.column("sa"), batch.column("sb")):
                u, v = np.frombuffer(x.as_buffer(), np.uint64), np.frombuffer(y.as_buffer(), np.uint64)
                both = len(np.intersect1d(u, v, assume_unique=True))
                keep.append(100 * both >= percent * (len(u) + len(v) - both))
            yield batch.select(["a", "b"]).filter(pa.array(keep, pa.bool_()))

    j = pairs.join(sets.select(F.col("fp").alias("b"), F.col("shingles").alias("sb")), "b")
    j = j.join(sets.select(F.col("fp").alias("a"), F.col("shingles").alias("sa")), "a").select("a", "b", "sa", "sb")
    return j.mapInArrow(compare, "a long, b long")


@in_batches_of(BATCH_BYTES, READ_ROWS)
def jaccard_components(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", percent: int = 75, n: int = N) -> DataFrame:
    """(doc_id, n_shingles, component_id) for every row.

    Documents link when 100 * intersection >= ``percent`` * union of their sets of word ``n``-grams (A-Z
    lower-cased; fewer words: the whole sequence). ``component_id`` is the smallest doc_id reachable. A null
    or wordless text has no shingle and links with nothing: its component is its own id. Repeated rows and
    copies share a component. Extra columns are ignored; an empty table gives no rows.
    """
    spark = docs.sparkSession
    d = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text"))
    plan = band_plan(percent)

    def describe(batches):
        for batch in batches:
            for row, sizes, fp, *_ in unique_sets(batch.column("text"), n):
                ids = batch.column("doc_id").slice(row, len(sizes))
                yield pa.RecordBatch.from_arrays([ids, pa.array(sizes), pa.array(fp.view(np.int64))], ["doc_id", "n_shingles", "fp"])

    id_type = d.schema["doc_id"].dataType.simpleString()
    known = staged(d.mapInArrow(describe, f"doc_id {id_type}, n_shingles long, fp long"), "known")
    rows, shingles = known.agg(F.count("*"), F.coalesce(F.sum("n_shingles"), F.lit(0))).first()

    # frequent shingles of a bounded sample of different sets
    drawn = F.pmod(F.xxhash64(F.lit("jaccard"), F.col("doc_id").cast("string"), F.length("text")), F.lit(1 << 30)) < min(1.0, max(SAMPLE / max(rows, 1), 1 / SAMPLE_SHARE)) * (1 << 30)

    def sets_of(batches, bitmap=None):
        for batch in batches:
            for *_, h, sizes, fp in unique_sets(batch.column("text"), n):
                keep = np.arange(len(fp))
                if bitmap is not None:
                    keep = np.flatnonzero(passes(fp, *bitmap))
                start = np.r_[0, np.cumsum(sizes)]
                blobs = [h[start[i] : start[i + 1]].tobytes() for i in keep]
                yield pa.RecordBatch.from_arrays([pa.array(fp[keep].view(np.int64)), pa.array(blobs, pa.binary())], ["fp", "shingles"])

    def tally(batches):
        parts = [np.frombuffer(x.as_buffer(), np.int64) for b in batches for x in b.column("shingles")]
        g, k = np.unique(np.concatenate(parts), return_counts=True) if parts else (np.zeros(0, np.int64), np.zeros(0, np.int64))
        yield pa.RecordBatch.from_arrays([pa.array(g), pa.array(k)], ["h", "n"])

    sample = d.where(drawn).mapInArrow(sets_of, "fp long, shingles binary").dropDuplicates(["fp"])
    hot = sample.mapInArrow(tally, "h long, n long").groupBy("h").agg(F.sum("n").alias("n")).where(F.col("n") >= FREQUENT).orderBy(F.desc("n"), "h").limit(HOT).toArrow()
    hot_h = hot.column("h").to_numpy().view(np.uint64)
    order = np.argsort(hot_h)
    frequent = spark.sparkContext.broadcast((hot_h[order], hot.column("n").to_numpy()[order]))

    buckets = max(2 * partitions(spark), shingles // BUCKET_SHINGLES)

    def index(batches):
        for batch in batches:
            for *_, h, sizes, fp in unique_sets(batch.column("text"), n):
                sig, doc, _ = signatures(h, sizes, *frequent.value, percent, plan)
                fp = np.repeat(fp, 2) | np.tile(np.array([0, 1], np.uint64), len(fp))
                bucket = ((sig >> np.uint64(40)) % np.uint64(buckets)).astype(np.int64)
                by = np.argsort(bucket, kind="stable")
                cut = np.searchsorted(bucket[by], np.arange(buckets + 1))
                full = np.flatnonzero(np.diff(cut))
                blobs = [pack(fp, sig[by[cut[b] : cut[b + 1]]], doc[by[cut[b] : cut[b + 1]]]) for b in full]
                yield pa.RecordBatch.from_arrays([pa.array(full.astype(np.int32)), pa.array(blobs, pa.binary())], ["bucket", "payload"])

    def groups_of(t: pa.Table) -> pa.Table:
        got = [unpack(x.as_buffer()) for x in t.column("payload")]
        sig, fp = np.concatenate([x[0] for x in got]), np.concatenate([x[1] for x in got])
        del got
        by = np.argsort(sig, kind="stable")
        sig, fp = sig[by], fp[by]
        alike = np.zeros(len(sig) + 1, bool)
        alike[1:-1] = sig[1:] == sig[:-1]
        keep = alike[1:] | alike[:-1]  # signatures seen once are no candidates
        sig, fp = sig[keep], fp[keep]
        by = np.lexsort((fp, sig))
        sig, fp = sig[by], fp[by]
        new = np.ones(len(sig), bool)
        new[1:] = (sig[1:] != sig[:-1]) | (fp[1:] != fp[:-1])
        sig, fp = sig[new], fp[new]
        cut = np.flatnonzero(np.r_[True, sig[1:] != sig[:-1]]) if len(sig) else np.zeros(0, np.int64)
        size = np.diff(np.r_[cut, len(sig)])
        kind = sig[cut] & np.uint64(1)
        gid = mix64(np.add.reduceat(mix64(fp + _C[0]), cut) + (size.astype(np.uint64) << np.uint64(1)) + kind) if len(cut) else np.zeros(0, np.uint64)
        _, once, times = np.unique(gid, return_index=True, return_counts=True)
        once, times = once[size[once] > 1], times[size[once] > 1]
        # a row holds CHUNK members at most: members are sorted, so a group has the same chunks in every bucket
        chunks = -(-size[once] // CHUNK)
        of = np.repeat(np.arange(len(once)), chunks)
        chunk = np.arange(len(of)) - np.repeat(np.r_[0, np.cumsum(chunks)][:-1], chunks)
        begin = cut[once][of] + chunk * CHUNK
        length = np.minimum(CHUNK, size[once][of] - chunk * CHUNK)
        offs = np.r_[0, np.cumsum(length)]
        flat = fp[np.repeat(begin - offs[:-1], length) + np.arange(offs[-1])]
        return pa.table({"gid": pa.array(gid[once][of].view(np.int64)), "chunk": pa.array(chunk.astype(np.int32)), "prefix": pa.array(kind[once][of] == 1), "times": pa.array(times[of]), "n": pa.array(size[once][of]),
                         "members": pa.ListArray.from_arrays(pa.array(offs.astype(np.int32)), pa.array(flat.view(np.int64)))})

    packed = d.select("text").mapInArrow(index, "bucket int, payload binary")
    groups = "gid long, chunk int, prefix boolean, times long, n long, members array<long>"
    found = staged(packed.groupBy("bucket").applyInArrow(groups_of, groups), "found")
    release(spark)
    # a group that several signatures share is one group, counted as often
    whole = found.groupBy("gid", "chunk").agg(F.first("prefix").alias("prefix"), F.sum("times").alias("times"), F.first("n").alias("n"), F.first("members").alias("members"))
    member = staged(whole.select("gid", "prefix", "times", "n", F.explode("members").alias("fp"))
                    .withColumn("role", F.col("fp").bitwiseAND(1)).withColumn("fp", F.col("fp").bitwiseAND(-2)), "member")
    drop_staged(found)

    def of_candidates(ids: DataFrame, name: str) -> DataFrame:
        """Sets (or their bin counts) of the texts whose fingerprint is among ``ids``, read from the texts again."""
        bitmap = spark.sparkContext.broadcast(fixed_filter(ids))

        def profiles_of(batches):
            for batch in sets_of(batches, bitmap.value):
                sets = [np.frombuffer(x.as_buffer(), np.uint64) for x in batch.column("shingles")]
                rows = [np.minimum(np.bincount((x >> np.uint64(54)).astype(np.int64), minlength=BINS), 255).astype(np.uint8).tobytes() for x in sets]
                slack = signatures(np.concatenate(sets), np.array([len(x) for x in sets]), *frequent.value, percent, plan)[2] if sets else np.zeros((0, 2), np.int64)
                yield pa.RecordBatch.from_arrays([batch.column("fp"), pa.array(rows, pa.binary()), pa.array(slack[:, 0]), pa.array(slack[:, 1])], ["fp", "profile", "own", "visit"])

        if name == "profiles":
            got = d.select("text").mapInArrow(profiles_of, "fp long, profile binary, own long, visit long")
        else:
            got = d.select("text").mapInArrow(lambda it: sets_of(it, bitmap.value), "fp long, shingles binary")
        out = staged(got.join(ids, "fp", "left_semi").dropDuplicates(["fp"]), name)
        release(spark)
        return out

    def linked(pairs: DataFrame, name: str) -> DataFrame:
        likely = staged(pairs, name + "-likely")
        sets = of_candidates(likely.select(F.col("a").alias("fp")).union(likely.select("b")).distinct(), "sets")
        out = staged(verified(likely, sets, percent), name)
        drop_staged(sets, likely)
        release(spark)
        return out

    profiles = of_candidates(member.select("fp").distinct(), "profiles")
    # cost-based allocation: of the groups of its segments a set leaves out the largest, as many as its slack
    # allows (all, if it is poor); what remains still has more units than any partner can differ in
    slack = F.when(F.col("role") == 0, F.col("own")).otherwise(F.col("visit"))
    spent = F.sum(F.when(F.col("prefix"), 0).otherwise(F.col("times"))).over(Window.partitionBy("fp", "role").orderBy(F.desc("n"), "gid").rowsBetween(Window.unboundedPreceding, 0))
    probing = F.col("prefix") | ((slack >= 0) & (spent > slack))
    member = staged(member.join(profiles.select("fp", "own", "visit"), "fp").select("gid", "fp", "n", probing.alias("probing")), "probes")
    member = staged(member.join(member.where("probing").select("gid").distinct(), "gid", "left_semi"), "alive")

    # first try: each set with the hub it shares most groups with; a group's hub is its member in most company
    company = member.groupBy("fp").agg(F.sum("n").alias("score"))
    hubs = member.join(company, "fp").groupBy("gid").agg(F.max_by("fp", F.struct("score", "fp")).alias("hub"))
    best = (member.join(hubs, "gid").where("fp <> hub").groupBy("fp", "hub").agg(F.count("*").alias("n"))
            .groupBy("fp").agg(F.max_by("hub", F.struct("n", "hub")).alias("a")).select("a", F.col("fp").alias("b")))
    tried = staged(best, "tried")
    links = linked(bounded(tried, profiles, percent), "links")
    comp = connected_components(links)

    # what the first links leave apart inside a candidate group
    apart = member.select("gid", "fp", "probing").join(comp.select(F.col("node").alias("fp"), "component"), "fp", "left").withColumn("component", F.coalesce("component", "fp"))
    mixed = apart.groupBy("gid").agg(F.min("component").alias("lo"), F.max("component").alias("hi"), F.count("*").alias("n")).where("lo <> hi").select("gid", "n")
    apart = staged(apart.join(mixed, "gid"), "apart")
    # each pair of blocks of a group's members is one small unit of work, several units go to one bucket
    blocks = F.ceil(F.col("n") / BLOCK)
    mine = F.pmod(F.xxhash64("fp"), blocks)
    units = (apart.withColumn("block", mine).withColumn("other", F.explode(F.sequence(F.lit(0).cast("long"), blocks - 1)))
             .withColumn("lo", F.least("block", "other")).withColumn("hi", F.greatest("block", "other")))
    spread = max(2 * partitions(spark), apart.count() // 20_000)
    units = units.withColumn("bucket", F.pmod(F.xxhash64("gid", "lo", "hi"), F.lit(spread))).join(profiles.select("fp", "profile"), "fp")

    def crossed(t: pa.Table) -> pa.Table:
        gid, lo, hi, block = (t.column(c).to_numpy() for c in ("gid", "lo", "hi", "block"))
        order = np.lexsort((hi, lo, gid))
        key = np.stack([gid, lo, hi])[:, order]
        cut = np.r_[np.flatnonzero(np.r_[True, (key[:, 1:] != key[:, :-1]).any(0)]), len(order)]
        fp, of, probe = t.column("fp").to_numpy(), t.column("component").to_numpy(), t.column("probing").to_numpy(zero_copy_only=False)
        prof = np.frombuffer(b"".join(t.column("profile").to_pylist()), np.uint8).reshape(-1, BINS)
        size = prof.sum(1, dtype=np.int64)
        full = (prof == 255).any(1)
        out = []
        for c0, c1 in zip(cut, cut[1:]):
            rows = order[c0:c1]
            if lo[rows[0]] == hi[rows[0]]:
                i, j = np.triu_indices(len(rows), 1)
            else:
                left = block[rows] == lo[rows[0]]
                i, j = (x.ravel() for x in np.meshgrid(np.flatnonzero(left), np.flatnonzero(~left), indexing="ij"))
            i, j = rows[i], rows[j]
            ok = (of[i] != of[j]) & (probe[i] | probe[j]) & (full[i] | full[j] | (100 * np.minimum(size[i], size[j]) >= percent * np.maximum(size[i], size[j])))
            i, j = i[ok], j[ok]
            for k in range(0, len(i), 20_000):
                x, y = i[k : k + 20_000], j[k : k + 20_000]
                both = np.minimum(prof[x], prof[y]).sum(1, dtype=np.int64)
                near = full[x] | full[y] | (100 * both >= percent * (size[x] + size[y] - both))
                out.append(np.stack([np.minimum(fp[x[near]], fp[y[near]]), np.maximum(fp[x[near]], fp[y[near]])]))
        pairs = np.unique(np.concatenate(out, 1), axis=1) if out else np.zeros((2, 0), np.int64)
        return pa.table({"a": pairs[0], "b": pairs[1]})

    rest = units.groupBy("bucket").applyInArrow(crossed, "a long, b long").distinct()
    done = tried.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b"))
    more = linked(rest.join(done, ["a", "b"], "left_anti"), "more")
    drop_staged(apart, member, profiles)
    if more.limit(1).count():
        comp = connected_components(links.unionByName(more))
    release(spark)

    reps = known.where("n_shingles > 0").groupBy("fp").agg(F.min("doc_id").alias("least"))
    joined = reps.join(comp.select(F.col("node").alias("fp"), "component"), "fp", "left").withColumn("component", F.coalesce("component", "fp"))
    low = joined.groupBy("component").agg(F.min("least").alias("component_id"))
    of = joined.select("fp", "component").join(low, "component").select("fp", "component_id")
    return (known.join(of, (known["fp"] == of["fp"]) & (known["n_shingles"] > 0), "left")
            .select("doc_id", "n_shingles", F.coalesce("component_id", "doc_id").alias("component_id")))

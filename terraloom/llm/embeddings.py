"""Near-duplicate embeddings by a forest of random-projection trees with spill.

Each tree splits the vectors of a label again and again at the median of their projection on a random
direction; vectors within SPILL of the threshold go to both sides. Thresholds come from bounded samples: one of
each leaf that is still too large, round after round, so the depth follows the data; every vector is indexed. A
node that most vectors would leave on both sides (a dense cluster) is not split; the comparison of a leaf that
stays large is dealt over pairs of blocks. Vectors are compared (double precision) only inside leaves. A linked
pair counts in the first leaf that holds both, so link counts need no list of pairs; of the links only a
spanning forest per unit of work is kept, and a union over all gives the components. Equal vectors are one vector.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from terraloom.llm.common import connected_components, drop_staged, staged

#: Trees; vectors a leaf should hold; half width of the spill, in units of 1/sqrt(dimensions).
TREES, LEAF, SPILL = 8, 1000, 0.16
#: Vectors of a fitting sample (one a leaf that is split); a round has at most SAMPLE / 16 leaves for each.
SAMPLE = 4000
#: A leaf above LARGE * LEAF is split again unless the last split left it KEPT of its size; members of a leaf compared in one unit.
LARGE, KEPT, PART = 1.5, 0.9, 4096
#: Share of vectors on both sides from which a node is left whole.
DENSE = 0.5
#: Thresholds up to which the models of a round are broadcast; beyond it they are joined.
SHIPPED = 1 << 20
SEED = 97
FIRST = 16  # leaf code of the first tree's root; a split appends eight bits


def directions(dim: int, depth: int, leaf: int, seed: int = SEED) -> np.ndarray:
    """(depth, dim) unit vectors: one random direction for each level below ``leaf``."""
    v = np.random.default_rng([seed, dim, leaf]).normal(size=(24, dim))[: max(depth, 1)]
    return v / np.linalg.norm(v, axis=1, keepdims=True)


def fit_tree(x: np.ndarray, dirs: np.ndarray, depth: int, spill: float) -> np.ndarray:
    """Median thresholds of a complete binary tree in heap order (node 1 is the root), infinite where a node is dense."""
    cut = np.full(1 << depth, np.inf)
    row, node = np.arange(len(x)), np.ones(len(x), np.int64)
    for level in range(depth):
        p = (x @ dirs[level])[row]
        for k in range(1 << level, 2 << level):
            at = p[node == k]
            if len(at):
                c = np.median(at)
                if (np.abs(at - c) <= spill).mean() <= DENSE:
                    cut[k] = c
        row, node = descend(row, node, p - cut[node], spill)
    return cut


def descend(row: np.ndarray, node: np.ndarray, gap: np.ndarray, spill: float) -> tuple[np.ndarray, np.ndarray]:
    left, right = gap < spill, gap >= -spill
    return np.concatenate([row[left], row[right]]), np.concatenate([2 * node[left], 2 * node[right] + 1])


def leaves_of(x: np.ndarray, dirs: np.ndarray, cut: np.ndarray, depth: int, spill: float) -> tuple[np.ndarray, np.ndarray]:
    """(row, leaf) pairs; a row has one leaf or, by spill, several."""
    row, node = np.arange(len(x)), np.ones(len(x), np.int64)
    for level in range(depth):
        row, node = descend(row, node, (x @ dirs[level])[row] - cut[node], spill)
    return row, node


def matrix(vec, dim: int) -> np.ndarray:
    """Rows of an Arrow list column as unit vectors in double precision; huge and tiny components are scaled first."""
    vec = vec.combine_chunks() if isinstance(vec, pa.ChunkedArray) else vec
    x = vec.flatten().to_numpy(zero_copy_only=False).astype(np.float64).reshape(-1, dim)
    top = np.abs(x).max(1, keepdims=True) if len(x) else x
    odd = ((top < 1e-100) | (top > 1e100)).ravel()
    if odd.any():
        x[odd] /= top[odd]
    return x / np.linalg.norm(x, axis=1, keepdims=True)


def stretches(b: pa.RecordBatch, names: tuple[str, ...]):
    """Stretches of a batch with equal values of ``names``; rows are sorted by them."""
    key = list(zip(*[b.column(n).to_pylist() for n in names]))
    cut = [0, *[i for i in range(1, len(key)) if key[i] != key[i - 1]], len(key)]
    return [(key[a], b.slice(a, c - a)) for a, c in zip(cut, cut[1:]) if c > a]


def split_codes(x: np.ndarray, dim: int, leaf: int, depth: int, cuts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(row, code) of the leaves below ``leaf``."""
    row, node = leaves_of(x, directions(dim, depth, leaf), cuts, depth, SPILL / np.sqrt(dim))
    return row, leaf << 8 | node


def compare_block(x: np.ndarray, bits: np.ndarray, left: np.ndarray, right: np.ndarray | None, copies: np.ndarray, threshold: float):
    """Link counts and a spanning forest of the links among ``left`` (``right`` None), or between ``left`` and ``right``,
    leaving out pairs with a common bit (they met in an earlier leaf)."""
    links, root, edges = np.zeros(len(x), np.int64), np.arange(len(x)), []
    for i0 in range(0, len(left), 512):
        a = left[i0 : i0 + 512]
        other = left[i0:] if right is None else right
        for j0 in range(0, len(other), 512):
            b = other[j0 : j0 + 512]
            i, j = np.nonzero(x[a] @ x[b].T >= threshold)
            if right is None and j0 == 0:
                up = i < j
                i, j = i[up], j[up]
            i, j = a[i], b[j]
            for k in range(0, len(i), 1 << 15):
                p, q = i[k : k + (1 << 15)], j[k : k + (1 << 15)]
                new = ~(bits[p] & bits[q]).any(1)
                p, q = p[new], q[new]
                links += np.bincount(p, copies[q], len(x)).astype(np.int64) + np.bincount(q, copies[p], len(x)).astype(np.int64)
                while len(p):
                    while (root[root] != root).any():
                        root = root[root]
                    apart = root[p] != root[q]
                    p, q = p[apart], q[apart]
                    # of the links between different trees, one for each larger root: these never close a circle
                    hi, lo = np.maximum(root[p], root[q]), np.minimum(root[p], root[q])
                    hi, first = np.unique(hi, return_index=True)
                    root[hi] = lo[first]
                    edges.append(np.stack([p[first], q[first]], 1))
    return links, np.concatenate(edges) if edges else np.zeros((0, 2), np.int64)


def near_duplicates(vectors: DataFrame, id_col: str = "vec_id", vector_col: str = "embedding", label_col: str = "label",
                    threshold: float = 0.93, trees: int = TREES, leaf_size: int = LEAF, sample: int = SAMPLE, part: int = PART) -> DataFrame:
    """(vec_id, n_links, component_id, kept) for every row.

    Vectors link when their labels and lengths are equal, the label is not null and the cosine is at least
    ``threshold``. Null, empty and zero vectors and those with null or non-finite components, and rows with a
    null label, link with nothing: no links, their own component. Repeated rows are different vectors that
    link (unless invalid). A row with a null id counts as a vector like any other; a component's id is its
    smallest id that is not null, and such a row is kept only if its component has no other id. Extra columns
    are ignored; an empty table gives no rows.
    """
    spark = vectors.sparkSession
    single = vectors.schema[vector_col].dataType.simpleString() == "array<float>"
    vec_type = "array<float>" if single else "array<double>"
    zero = F.lit(0.0).cast("float" if single else "double")  # adding it makes the negative zero a plain one
    v = vectors.select(F.col(id_col).alias("vec_id"), F.transform(F.col(vector_col).cast(vec_type), lambda x: x + zero).alias("vec"), F.col(label_col).alias("label"))
    fine = (F.col("label").isNotNull() & F.col("vec").isNotNull() & F.forall("vec", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
            & F.exists("vec", lambda x: x != 0))
    v = v.withColumn("fine", F.coalesce(fine, F.lit(False)))
    keys = [F.xxhash64("label", "vec").alias("k1"), F.xxhash64(F.lit(SEED), "vec", "label").alias("k2")]
    one = (v.where("fine").groupBy("label", "vec").agg(F.min("vec_id").alias("rep"), F.count("*").alias("copies"))
           .select(F.monotonically_increasing_id().alias("node"), *keys, "rep", "copies", "label", F.size("vec").alias("dim"), "vec"))
    one = staged(one, "one")
    label_type = v.schema["label"].dataType.simpleString()
    by = ["label", "dim", "leaf"]

    def grow(t: pa.Table) -> pa.Table:
        n, dim, leaf = (t.column(c)[0].as_py() for c in ("n", "dim", "leaf"))
        x = matrix(t.column("vec"), dim)
        depth = max(0, min(int(np.ceil(np.log2(max(n / leaf_size, 1)))), int(np.log2(max(len(x) // 16, 1))), 7))
        cuts = fit_tree(x, directions(dim, depth, leaf), depth, SPILL / np.sqrt(dim))
        return pa.table({"label": t.column("label")[:1], "dim": t.column("dim")[:1], "leaf": t.column("leaf")[:1], "depth": pa.array([depth], pa.int32()), "cuts": pa.array([cuts.tolist()], pa.list_(pa.float64()))})

    def small(df: DataFrame, limit: int = 20_000) -> DataFrame:
        return F.broadcast(df) if df.limit(limit + 1).count() <= limit else df

    def split(placed: DataFrame, large: DataFrame) -> DataFrame:
        """``placed`` with the leaves in ``large`` split once more."""
        of = small(large)
        h = F.pmod(F.xxhash64(F.lit("forest"), "node"), F.lit(1 << 30))
        drawn = placed.withColumn("leaf", F.explode("leaves")).join(of, by).where(h < F.least(F.lit(1.0), F.lit(float(sample)) / F.col("n")) * (1 << 30))
        model = staged(drawn.select(*by, "n", "vec").groupBy(*by).applyInArrow(grow, f"label {label_type}, dim int, leaf long, depth int, cuts array<double>"), "model")
        if model.agg(F.coalesce(F.sum(F.size("cuts")), F.lit(0))).first()[0] <= SHIPPED:
            shared = spark.sparkContext.broadcast({(r["label"], r["dim"], r["leaf"]): (r["depth"], np.array(r["cuts"])) for r in model.collect()})

            def place(batches):
                for b in batches:
                    for (label, dim), rows in stretches(b, ("label", "dim")):
                        x = matrix(rows.column("vec"), dim)
                        lists = rows.column("leaves")
                        row, code = np.repeat(np.arange(len(x)), np.diff(lists.offsets.to_numpy())), lists.flatten().to_numpy()
                        out = [(row, code)]
                        for c in np.unique(code).tolist():
                            if (label, dim, c) in shared.value:
                                at = row[code == c]
                                sub, new = split_codes(x[at], dim, c, *shared.value[label, dim, c])
                                out.append((at[sub], new))
                        gone = np.array([(label, dim, c) in shared.value for c in code.tolist()], bool)
                        out[0] = (row[~gone], code[~gone])
                        row, code = (np.concatenate(z) for z in zip(*out))
                        order = np.lexsort((code, row))
                        cut = np.searchsorted(row[order], np.arange(len(x) + 1)).astype(np.int32)
                        yield pa.RecordBatch.from_arrays([*[rows.column(c) for c in ("node", "label", "dim", "copies", "vec")], pa.ListArray.from_arrays(pa.array(cut), pa.array(code[order].astype(np.int64)))],
                                                         ["node", "label", "dim", "copies", "vec", "leaves"])

            return placed.sortWithinPartitions("label", "dim").mapInArrow(place, f"node long, label {label_type}, dim int, copies long, vec {vec_type}, leaves array<long>")

        def place_joined(batches):
            for b in batches:
                for (dim, leaf), rows in stretches(b, ("dim", "leaf")):
                    node = rows.column("node")
                    if rows.column("depth")[0].as_py() is None:
                        yield pa.RecordBatch.from_arrays([node, rows.column("leaf")], ["node", "leaf"])
                        continue
                    for _, same in stretches(rows, ("label",)):
                        row, code = split_codes(matrix(same.column("vec"), dim), dim, leaf, same.column("depth")[0].as_py(), np.array(same.column("cuts")[0].as_py()))
                        yield pa.RecordBatch.from_arrays([same.column("node").take(pa.array(row)), pa.array(code)], ["node", "leaf"])

        spread = placed.select("node", "label", "dim", "vec", F.explode("leaves").alias("leaf")).join(model, by, "left")
        codes = spread.sortWithinPartitions("dim", "leaf", "label").mapInArrow(place_joined, "node long, leaf long").groupBy("node").agg(F.array_sort(F.collect_list("leaf")).alias("leaves"))
        return placed.drop("leaves").join(codes, "node")

    # rounds: what is still large is split by trees of its own
    placed = one.select("node", "label", "dim", "copies", "vec", F.lit([FIRST + k for k in range(trees)]).cast("array<long>").alias("leaves"))
    roots = F.explode(F.lit([FIRST + k for k in range(trees)]).cast("array<long>")).alias("leaf")
    sizes = staged(one.groupBy("label", "dim").agg(F.count("*").alias("n")).select("label", "dim", roots, "n"), "sizes")
    large = sizes.where(F.col("n") > LARGE * leaf_size)
    for _ in range(7):
        if not large.limit(1).count():
            break
        placed = staged(split(placed, large), "placed")
        before = large.select("label", "dim", F.col("leaf").alias("up"), F.col("n").alias("was"))
        sizes = staged(placed.select("label", "dim", F.explode("leaves").alias("leaf")).groupBy(*by).agg(F.count("*").alias("n")).withColumn("up", F.shiftright("leaf", 8)), "sizes")
        large = sizes.join(before, ["label", "dim", "up"]).where((F.col("n") > LARGE * leaf_size) & (F.col("n") <= KEPT * F.col("was"))).select(*by, "n")

    spread = placed.withColumn("leaf", F.explode("leaves"))
    heavy = sizes.where(F.col("n") > part).select(*by, F.ceil(F.col("n") / part).alias("blocks"))
    if heavy.limit(1).count():  # leaves that stay large: pairs of blocks
        spread = spread.join(small(heavy), by, "left").withColumn("blocks", F.coalesce("blocks", F.lit(1).cast("long")))
        spread = (spread.withColumn("block", F.pmod(F.xxhash64("node"), F.col("blocks"))).withColumn("other", F.explode(F.sequence(F.lit(0).cast("long"), F.col("blocks") - 1)))
                  .withColumn("lo", F.least("block", "other")).withColumn("hi", F.greatest("block", "other")))
    else:
        none = F.lit(0).cast("long")
        spread = spread.withColumn("block", none).withColumn("lo", none).withColumn("hi", none)
    spread = spread.select(*by, "lo", "hi", "block", "node", "copies", "vec", "leaves")

    def compare(t: pa.Table) -> pa.Table:
        dim, here, lo, hi = (t.column(c)[0].as_py() for c in ("dim", "leaf", "lo", "hi"))
        node, copies, block = (t.column(c).to_numpy() for c in ("node", "copies", "block"))
        lists = t.column("leaves").combine_chunks()
        row, code = np.repeat(np.arange(len(node)), np.diff(lists.offsets.to_numpy())), lists.flatten().to_numpy()
        # a bit for each earlier leaf that several rows of this one share
        _, inv, times = np.unique(code, return_inverse=True, return_counts=True)
        use = (code < here) & (times[inv] > 1)
        _, bit = np.unique(code[use], return_inverse=True)
        bits = np.zeros((len(node), bit.max() // 64 + 1 if len(bit) else 1), np.uint64)
        np.bitwise_or.at(bits, (row[use], bit // 64), np.uint64(1) << (bit % 64).astype(np.uint64))
        left = np.flatnonzero(block == lo)
        links, e = compare_block(matrix(t.column("vec"), dim), bits, left, None if lo == hi else np.flatnonzero(block == hi), copies, threshold)
        on = np.flatnonzero(links)
        return pa.table({"a": np.r_[node[on], node[e[:, 0]]], "b": pa.concat_arrays([pa.nulls(len(on), pa.int64()), pa.array(node[e[:, 1]])]), "links": np.r_[links[on], np.zeros(len(e), np.int64)]})

    found = staged(spread.groupBy(*by, "lo", "hi").applyInArrow(compare, "a long, b long, links long"), "found")
    links = found.where("b is null").groupBy(F.col("a").alias("node")).agg(F.sum("links").alias("links"))
    comp = connected_components(found.where("b is not null").select("a", "b"))
    named = one.select("node", "k1", "k2", "rep", "copies").join(comp, "node", "left").withColumn("component", F.coalesce("component", "node"))
    least = named.where("component <> node").groupBy("component").agg(F.min("rep").alias("low"))
    low = F.least("rep", "low")  # of a component's first vector
    heads = named.join(least, "component").where("component = node").select("component", low.alias("component_id"))
    reps = (named.join(heads, "component", "left").join(links, "node", "left")
            .select("k1", "k2", (F.coalesce("links", F.lit(0)) + F.col("copies") - 1).alias("n_links"), F.when(F.col("component_id").isNull(), F.col("rep")).otherwise(F.col("component_id")).alias("component_id")))
    valid = v.where("fine").select("vec_id", *keys).join(reps, ["k1", "k2"], "left").select("vec_id", F.col("n_links").cast("long").alias("n_links"), "component_id")
    alone = v.where("not fine").select("vec_id", F.lit(0).cast("long").alias("n_links"), F.col("vec_id").alias("component_id"))
    return valid.unionByName(alone).withColumn("kept", F.col("vec_id").eqNullSafe(F.col("component_id")))

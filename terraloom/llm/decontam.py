"""Benchmark decontamination by pigeonhole edit matching.

A test item of m characters that occurs in a text with at most k edits leaves one of its k + 1 pieces
untouched: every piece is looked up exactly (one automaton over all pieces), the window around each hit is
checked with Myers' bit-parallel distance (item anywhere in the window). The error budget is ``rate`` of the
item's length. Items pass over all texts in blocks of a bounded size.
"""

from __future__ import annotations

from collections.abc import Iterator

import ahocorasick
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_type

#: Edits allowed per character of an item.
RATE = 0.06
#: Characters of items in one block of a pass (one automaton holds about as many states).
BLOCK_CHARS = 1 << 20

_FOLD = {i: i + 32 for i in range(65, 91)}


def normalise(text: str) -> str:
    """A-Z lower-cased, runs of blanks one space, none at the ends."""
    return " ".join(text.translate(_FOLD).split())


def pieces(item: str, k: int) -> list[tuple[int, str]]:
    """k + 1 pieces of nearly equal length with their offsets; empty pieces (item too short) are left out."""
    cuts = [len(item) * i // (k + 1) for i in range(k + 2)]
    return [(a, item[a:b]) for a, b in zip(cuts, cuts[1:]) if b > a]


def pattern_masks(item: str) -> dict[str, int]:
    masks: dict[str, int] = {}
    for i, c in enumerate(item):
        masks[c] = masks.get(c, 0) | 1 << i
    return masks


def myers(masks: dict[str, int], m: int, window: str, k: int) -> int | None:
    """Smallest edit distance of the item to any substring of ``window``, None if above ``k``.

    Myers' bit vectors on Python integers: any item length in one word."""
    if m == 0:
        return 0
    full, top = (1 << m) - 1, 1 << (m - 1)
    pv, mv, score, best = full, 0, m, m
    for c in window:
        eq = masks.get(c, 0)
        xv = eq | mv
        xh = (((eq & pv) + pv) ^ pv) | eq
        ph = mv | ~(xh | pv) & full
        mh = pv & xh
        if ph & top:
            score += 1
        elif mh & top:
            score -= 1
        ph = ph << 1 & full
        mh = mh << 1 & full
        pv = mh | ~(xv | ph) & full
        mv = ph & xv
        if score < best:
            best = score
    return best if best <= k else None


class Matcher:
    """All items of one block."""

    def __init__(self, items: list[tuple[object, str]], rate: float = RATE):
        self.items, at = [], {}
        for key, text in items:
            t = normalise(text or "")
            if t:
                k = int(rate * len(t))
                n = len(self.items)
                self.items.append((key, t, k, pattern_masks(t)))
                for off, p in pieces(t, k):
                    at.setdefault(p, []).append((n, off))
        self.auto = ahocorasick.Automaton()
        for p, of in at.items():
            self.auto.add_word(p, (len(p), of))
        if at:
            self.auto.make_automaton()

    def search(self, text: str | None) -> Iterator[tuple[object, int, int]]:
        """(item key, smallest distance, budget) of the items that occur in ``text``."""
        if not self.items or not text:
            return
        t = normalise(text)
        windows: dict[int, list[list[int]]] = {}
        for end, (size, of) in self.auto.iter(t):
            for n, off in of:
                k, m = self.items[n][2], len(self.items[n][1])
                begin = end - size + 1 - off
                a, b = max(0, begin - k), min(len(t), begin + m + k)
                w = windows.setdefault(n, [])
                if w and a <= w[-1][1] and begin - w[-1][2] <= m:  # hits in text order: overlapping windows are one
                    w[-1][1] = max(w[-1][1], b)
                    w[-1][0] = min(w[-1][0], a)
                else:
                    w.append([a, b, begin])
        for n in sorted(windows):
            key, item, k, masks = self.items[n]
            best = None
            for a, b, _ in windows[n]:
                d = myers(masks, len(item), t[a:b], k if best is None else best - 1)
                if d is not None:
                    best = d
                    if d == 0:
                        break
            if best is not None:
                yield key, best, k


def item_blocks(items: DataFrame, id_col: str, text_col: str) -> Iterator[list[tuple[object, str]]]:
    """The items in blocks of about BLOCK_CHARS characters, one at a time on the driver."""
    block, size = [], 0
    rows = items.select(F.col(id_col).alias("k"), F.col(text_col).alias("t")).where("t is not null").orderBy("k", "t")
    for r in rows.toLocalIterator():
        block.append((r["k"], r["t"]))
        size += len(r["t"])
        if size >= BLOCK_CHARS:
            yield block
            block, size = [], 0
    if block:
        yield block


def contaminated(docs: DataFrame, items: DataFrame, id_col: str = "doc_id", text_col: str = "text", item_id: str = "item_id",
                 item_text: str = "text", rate: float = RATE) -> DataFrame:
    """(doc_id, item_id, distance, budget): each item found in each text.

    Null and blank items and texts match nothing; a text with repeated ids gives rows for each; no items, no
    rows. Extra columns are ignored.
    """
    spark = docs.sparkSession
    d = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text"))
    doc_type, item_type = d.schema["doc_id"].dataType.simpleString(), items.schema[item_id].dataType.simpleString()
    schema = f"doc_id {doc_type}, item_id {item_type}, distance int, budget int"
    arrow_item = to_arrow_type(items.schema[item_id].dataType)
    out = None
    for block in item_blocks(items, item_id, item_text):
        shared = spark.sparkContext.broadcast(block)

        def scan(batches, shared=shared):
            matcher = Matcher(shared.value, rate)
            for batch in batches:
                ids, found = batch.column("doc_id"), []
                for i, text in enumerate(batch.column("text")):
                    found += [(i, *hit) for hit in matcher.search(text.as_py())]
                yield pa.RecordBatch.from_arrays([ids.take(pa.array([x[0] for x in found], pa.int64())), pa.array([x[1] for x in found], arrow_item),
                                                  pa.array([x[2] for x in found], pa.int32()), pa.array([x[3] for x in found], pa.int32())], ["doc_id", "item_id", "distance", "budget"])

        part = d.mapInArrow(scan, schema)
        out = part if out is None else out.unionByName(part)
    return spark.createDataFrame([], schema) if out is None else out


def with_contamination(docs: DataFrame, items: DataFrame, text_col: str = "text", item_id: str = "item_id", item_text: str = "text", rate: float = RATE) -> DataFrame:
    """``docs`` with ``_hits``: the number of items found in the text (0 for null and blank texts)."""
    spark = docs.sparkSession

    def hits_of(shared):
        ready = []

        @F.arrow_udf("int")
        def hits(texts: pa.Array) -> pa.Array:
            if not ready:
                ready.append(Matcher(shared.value, rate))
            return pa.array([sum(1 for _ in ready[0].search(t.as_py())) for t in texts], pa.int32())

        return hits(F.col(text_col))

    total = F.lit(0)
    for block in item_blocks(items, item_id, item_text):
        total = total + hits_of(spark.sparkContext.broadcast(block))
    return docs.withColumn("_hits", total)

"""Language identification with bit-sliced Bloom filters.

Each slot of the filter holds one bit a language; ANDing the slots of an n-gram gives the mask of all
languages that contain it. Per text and language the hits are counted (a popcount of that bit over the
n-grams), the rate is corrected for the filter's false positives, and the largest rate decides.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from terraloom.llm.tokens import segment_sums, text_slices

UND = "und"
#: Expected number of training texts a language (drawn by hash): the bound of the fitting sample.
SAMPLE_PER_LANG = 1500
#: An n-gram belongs to a language if that share of its texts hold it, and at least FOREIGN of the largest share of any language.
MIN_SHARE, FOREIGN = 0.01, 0.15
SLOT_BITS = 20
#: A text is in none of the learned languages if its best rate is more than DEVIATIONS standard deviations, of a share
#: of KNOWN among as many n-grams, below KNOWN: never with 19 n-grams or fewer.
KNOWN, DEVIATIONS = 0.45, 4

_MUL = (np.uint32(0x9E3779B1), np.uint32(0x85EBCA77))
_fold = np.full(256, 32, np.uint8)
_fold[np.r_[97:123, 128:256]] = np.r_[97:123, 128:256].astype(np.uint8)


def grams(buf: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Byte 4-grams of lower-cased letters with at most an outer blank, and each text's bounds among them.

    Each text is framed by blanks; n-grams never cross texts.
    """
    n, docs = len(buf), len(offsets) - 1
    b = np.full(n + 2 * docs, 32, np.uint8)
    sizes = np.diff(offsets)
    shift = 2 * np.repeat(np.arange(docs), sizes) + 1
    b[np.arange(n) + shift] = _fold[buf]
    ends = offsets + 2 * np.arange(docs + 1)
    if len(b) < 4:
        return np.zeros(0, np.uint32), np.zeros(docs + 1, np.int64)
    x = b.astype(np.uint32)
    g = x[:-3] | x[1:-2] << np.uint32(8) | x[2:-1] << np.uint32(16) | x[3:] << np.uint32(24)
    ok = (b[1:-2] != 32) & (b[2:-1] != 32)
    at = np.flatnonzero(ok)
    return g[at], np.searchsorted(at, ends)


def lowered(texts: pa.Array) -> pa.Array:
    return pc.utf8_lower(texts.cast(pa.large_string()).fill_null(""))


def slots(g: np.ndarray) -> list[np.ndarray]:
    return [((g ^ (g >> np.uint32(15))) * m) >> np.uint32(32 - SLOT_BITS) for m in _MUL]


@dataclass
class LanguageFilters:
    langs: list[str]
    table: np.ndarray  # (slots,) of the narrowest unsigned type, or (slots, groups of 64 languages)

    @classmethod
    def build(cls, members: dict[str, np.ndarray]) -> "LanguageFilters":
        langs = sorted(members)
        groups = max(1, -(-len(langs) // 64))
        kind = next((t for t, n in ((np.uint8, 8), (np.uint16, 16), (np.uint32, 32)) if len(langs) <= n), np.uint64)
        table = np.zeros((1 << SLOT_BITS, groups), kind)
        for i, lang in enumerate(langs):
            for s in slots(members[lang].astype(np.uint32)):
                table[s, i // 64] |= kind(1 << (i % 64))
        return cls(langs, table)

    def __post_init__(self):
        fill = np.array([((self.table[:, i // 64] >> self.table.dtype.type(i % 64)) & self.table.dtype.type(1)).mean() for i in range(len(self.langs))])
        self.false_rate = fill ** len(_MUL)

    def rates(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """Corrected share of each text's n-grams that each language contains, (texts, languages), and their number."""
        out, total = np.zeros((len(texts), len(self.langs))), np.zeros(len(texts), np.int64)
        one = self.table.dtype.type(1)
        for row, buf, offsets in text_slices(lowered(texts)):
            g, bounds = grams(buf, offsets)
            a, b = slots(g)
            total[row : row + len(offsets) - 1] = np.diff(bounds)
            n = np.maximum(np.diff(bounds), 1)
            for group in range(self.table.shape[1]):
                mask = self.table[a, group] & self.table[b, group]
                for i in range(64 * group, min(len(self.langs), 64 * group + 64)):
                    hits = segment_sums((mask >> self.table.dtype.type(i % 64)) & one, bounds)
                    out[row : row + len(offsets) - 1, i] = np.where(np.diff(bounds) > 0, (hits / n - self.false_rate[i]) / max(1e-9, 1 - self.false_rate[i]), 0)
        return np.clip(out, 0, 1), total

    def predict(self, texts: pa.Array) -> tuple[pa.Array, np.ndarray, np.ndarray, np.ndarray]:
        """Language, score, best rate and number of n-grams of each text."""
        r, n = self.rates(texts)
        if not self.langs:
            return pa.array([UND] * len(texts)), np.zeros(len(texts)), np.zeros(len(texts)), n
        best = r.argmax(1)
        top = r[np.arange(len(r)), best] if len(r) else np.zeros(0)
        total = r.sum(1)
        score = np.divide(top, total, out=np.zeros(len(r)), where=total > 0)
        known = pc.match_substring_regex(texts.cast(pa.large_string()).fill_null(""), r"\p{L}").to_numpy(zero_copy_only=False)
        lang = np.where(known, np.array(self.langs, object)[best], UND)
        return pa.array(lang, pa.string()), np.where(known, score, 0.0), np.where(known, top, 0.0), n


def fit(docs: DataFrame, text_col: str = "text", lang_col: str = "lang", per_lang: int = SAMPLE_PER_LANG,
        key: str = "doc_id") -> LanguageFilters:
    """Filters from a hash sample of about ``per_lang`` texts of each language. Null languages teach nothing.

    The driver gets one row a language and the n-grams over MIN_SHARE, at most (mean n-grams a text) /
    MIN_SHARE a language."""
    d = docs.select(F.col(text_col).alias("text"), F.col(lang_col).cast("string").alias("lang"), F.col(key).alias("key")).where("lang is not null and text is not null")
    share = {r["lang"]: min(1.0, per_lang / r["n"]) for r in d.groupBy("lang").agg(F.count("*").alias("n")).collect()}
    if not share:
        return LanguageFilters.build({})
    limits = F.create_map(*[F.lit(x) for kv in share.items() for x in kv])
    drawn = F.pmod(F.xxhash64(F.lit("langid"), F.coalesce(F.col("key").cast("string"), F.lit("")), "text"), F.lit(1 << 30)) < limits[F.col("lang")] * (1 << 30)

    def count(batches):
        total, texts = {}, {}
        for batch in batches:
            lang = np.array(batch.column("lang").to_pylist(), object)
            for row, buf, offsets in text_slices(lowered(batch.column("text"))):
                g, bounds = grams(buf, offsets)
                for i in range(len(offsets) - 1):
                    l = lang[row + i]
                    texts[l] = texts.get(l, 0) + 1
                    total.setdefault(l, []).append(np.unique(g[bounds[i] : bounds[i + 1]]))
        for l, parts in total.items():
            g, n = np.unique(np.concatenate(parts), return_counts=True)
            yield pa.RecordBatch.from_arrays([pa.array([l] * (len(g) + 1), pa.string()), pa.array(np.r_[g.astype(np.int64), -1]), pa.array(np.r_[n, texts[l]])], ["lang", "gram", "n"])

    counts = d.where(drawn).select("text", "lang").mapInArrow(count, "lang string, gram long, n long").groupBy("lang", "gram").agg(F.sum("n").alias("n"))
    rows = counts.withColumn("n", F.col("n").cast("double"))
    docs_of = rows.where("gram = -1").select("lang", F.col("n").alias("texts"))
    shares = rows.where("gram >= 0").join(F.broadcast(docs_of), "lang").where((F.col("n") >= 2) | (F.col("texts") < 20)).select("lang", "gram", (F.col("n") / F.col("texts")).alias("share")).where(F.col("share") >= MIN_SHARE)
    top = F.max("share").over(Window.partitionBy("gram"))
    kept = shares.withColumn("top", top).where(F.col("share") >= FOREIGN * F.col("top")).select("lang", "gram").toArrow()
    lang, gram = np.array(kept.column("lang").to_pylist(), object), kept.column("gram").to_numpy()
    return LanguageFilters.build({l: gram[lang == l] for l in share})


def with_language(docs: DataFrame, model: LanguageFilters, text_col: str = "text") -> DataFrame:
    """``docs`` with a struct column ``_lang`` (lang, score, rate, grams). A null text or one without a letter gets
    ``und``; an empty table stays empty."""
    shared = docs.sparkSession.sparkContext.broadcast((model.langs, model.table))
    ready = []

    @F.arrow_udf("struct<lang:string,score:double,rate:double,grams:long>")
    def predict(texts: pa.Array) -> pa.Array:
        if not ready:
            ready.append(LanguageFilters(*shared.value))
        lang, score, rate, grams = ready[0].predict(texts)
        return pa.StructArray.from_arrays([lang, pa.array(score), pa.array(rate), pa.array(grams)], ["lang", "score", "rate", "grams"])

    return docs.withColumn("_lang", predict(F.col(text_col)))


def in_learned(lang: Column) -> Column:
    """Whether a text is in a learned language, from its ``_lang`` of ``with_language``; ``und`` is in none."""
    least = KNOWN - DEVIATIONS * F.sqrt(KNOWN * (1 - KNOWN) / F.greatest(lang["grams"], F.lit(1)))
    return (lang["lang"] != UND) & (lang["rate"] >= least)

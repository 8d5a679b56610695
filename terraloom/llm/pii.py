"""Personal data by candidate gradient boosting.

High-recall generators propose overlapping candidate spans; each gets a bit mask of format and context
features; boosted trees of depth two over the bits, fitted on half of the documents, score it, and a threshold
calibrated on the other half decides (Elkan and Noto's rule for positive and unlabelled examples: half the mean
score of the labelled ones there). No document is left out: the trees and the threshold need only counts per mask. Labels come from the validated base formats alone (mail, IP, Luhn card,
international phone): a candidate is positive if one covers it. What decides those formats (the @, the plus sign,
the check digit, the octets, and hence the kind) is hidden from the features, so the trees learn the shape and
the context of personal data, and unlabelled candidates are ranked by them. Base spans always stay.

Numbers whose format refutes them (16 to 19 digits that fail the check, dotted quads out of range) teach nothing
and are never added. Scanning, features and scores are DataFrame expressions; the driver sees only
the counts per half and feature mask (at most 2 * 2^len(FEATURES) rows). ``pii_table`` scans each text once: the
proposals are written to the shared folder, and both fitting and scoring read them there.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from terraloom.llm.common import staged
from terraloom.llm.spans import count_kind, digest, find_spans, let, no_spans, touches, with_cells

#: Groups repeat possessively and runs start only where a run can start, so no pattern recurses or rescans: the
#: classes of a run and of what ends it are disjoint, which keeps the matches of the plain forms.
EMAIL = r"(?:\G|(?<![A-Za-z0-9._%+-]))[A-Za-z0-9._%+-]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++"
IP = r"(?<![0-9])[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++"
CARD = r"[0-9](?:[\x20-]?[0-9]){15,}+"  # sixteen digits at least: shorter maximal runs are dropped anyway
PHONE = r"\+[0-9][\x20().0-9-]+[0-9]"
#: Generators: numbers of seven digits or more with separators (a letter at the end refutes them), and addresses,
#: plain or spelled out.
NUMBER = r"(?<![A-Za-z0-9.])\(?[0-9](?:[\x20().-]{0,2}[0-9]){6,}+[A-Za-z]?"
ADDRESS = r"(?<![A-Za-z0-9._%+-])[A-Za-z0-9._%+-]++(?:@|\x20?[\[(](?:at|AT)[\])]\x20?)[A-Za-z0-9-]++(?:(?:\.|\x20?[\[(](?:dot|DOT)[\])]\x20?)[A-Za-z0-9-]++)*+"
HINTS = tuple(rf"(?i)(?:{words})[^A-Za-z0-9]{{0,4}}(?:no|nr|number)?[^A-Za-z0-9]{{0,4}}$" for words in ("phone|tel|call|mobile|fax|cell", "mail|contact|write to|reach", "card|visa|iban|account|ssn"))
ROUNDS, RATE = 20, 0.4
FEATURES = ("address", "digits_8_15", "digits_16_19", "grouped", "parens", "dotted", "long_piece", "hint_phone", "hint_mail", "hint_card", "colon", "short_top")


def digits(x: Column) -> Column:
    return F.regexp_replace(x, "[^0-9]", "")


def luhn(number: Column) -> Column:
    """Whether a string of digits passes the Luhn check."""
    places = F.filter(F.split(F.reverse(number), ""), lambda c: c != "")
    total = F.aggregate(F.transform(places, lambda c, i: F.when(i % 2 == 0, c.cast("int")).otherwise(c.cast("int") * 2 - F.when(c.cast("int") > 4, 9).otherwise(0))), F.lit(0), lambda a, b: a + b)
    return total % 10 == 0


def _octets(m: Column) -> Column:
    return F.forall(F.split(m, r"\."), lambda p: (F.length(F.regexp_replace(p, "^0+", "")) <= 3) & (F.right(p, F.lit(9)).cast("int") <= 255))


def base_spans(text: Column) -> Column:
    """Base spans by kind (email, ip, card, phone), then start."""
    n = lambda m: F.length(digits(m))
    return F.concat(find_spans(text, EMAIL, "email", 0, lambda m: F.lit(True)), find_spans(text, IP, "ip", 1, _octets),
                    find_spans(text, CARD, "card", 2, lambda m: n(m).between(16, 19) & luhn(digits(m))), find_spans(text, PHONE, "phone", 3, lambda m: n(m).between(8, 15)))


def describe(s: Column, covered: Column) -> Column:
    """struct(span, mask, y, refuted) of one proposal."""
    def bits(num: Column, n: Column) -> Column:
        x = s["text"]
        of = (s["kind"] == "contact", n.between(8, 15), n.between(16, 19), x.rlike(r"[0-9][\x20-][0-9]"), x.rlike(r"\("), x.rlike(r"[0-9]\.[0-9]"), x.rlike("[0-9]{7,}"),
              *[s["before"].rlike(h) for h in HINTS], s["before"].rlike(r"[:=]\x20?$"), x.rlike(r"[^A-Za-z][A-Za-z]{2,6}$"))
        mask = sum((F.when(b, 1 << i).otherwise(0) for i, b in enumerate(of)), F.lit(0))
        no_card = F.when(n.between(16, 19), ~luhn(num)).otherwise(False)
        no_quad = F.when(x.rlike(r"^[0-9]{1,9}(?:\.[0-9]{1,9}){3}$"), ~_octets(x)).otherwise(False)
        refuted = F.when(s["kind"] == "contact", ~x.rlike(r"(?:\.|[\])]\x20?)[A-Za-z][A-Za-z0-9-]*$") | ~x.rlike(r"(?:\.|dot|DOT)")).otherwise(no_card | no_quad | (n > 19) | x.rlike("[A-Za-z]$"))
        return F.struct(s.alias("span"), mask.alias("mask"), covered.alias("y"), refuted.alias("refuted"))

    return let(digits(s["text"]), lambda num: let(F.length(num), lambda n: bits(num, n)))


def candidates(docs: DataFrame) -> DataFrame:
    """``docs`` (with ``text``) plus ``base`` and ``cand``: structs (span, mask, y, refuted) of the proposals."""
    t, any_ = F.col("text"), lambda m: F.lit(True)
    d = docs.withColumn("base", base_spans(t))
    proposals = F.concat(find_spans(t, ADDRESS, "contact", 4, any_), find_spans(t, NUMBER, "number", 5, any_))
    found = lambda p: with_cells(F.col("base"), F.length(t), lambda cells: F.transform(p, lambda s: describe(s, touches(cells, s))))
    return d.withColumn("cand", let(proposals, lambda p: F.when(F.size(p) > 0, found(p))))


def boost(counts: list[tuple[int, float, float]], rounds: int = ROUNDS, rate: float = RATE) -> list[tuple[int, int, tuple[float, float, float, float]]]:
    """Logistic boosting of depth-two trees on (mask, positives, all): trees (bit a, bit b, leaves for 00 01 10 11)."""
    bits = len(FEATURES)
    total, positive = sum(c[2] for c in counts), sum(c[1] for c in counts)
    base = math.log((positive + 0.5) / (total - positive + 0.5))
    trees = [(0, 0, (base, base, base, base))]
    score = {m: base for m, _, _ in counts}
    for _ in range(rounds):
        best = None
        stats = [(m, p - n / (1 + math.exp(-score[m])), n * (q := 1 / (1 + math.exp(-score[m]))) * (1 - q)) for m, p, n in counts]
        for a in range(bits):
            for b in range(a, bits):
                g, h = [0.0] * 4, [1.0] * 4
                for m, gm, hm in stats:
                    k = 2 * (m >> a & 1) + (m >> b & 1)
                    g[k] += gm
                    h[k] += hm
                gain = sum(x * x / y for x, y in zip(g, h))
                if best is None or gain > best[0] + 1e-12:
                    best = (gain, a, b, tuple(rate * x / y for x, y in zip(g, h)))
        _, a, b, leaves = best
        trees.append((a, b, leaves))
        for m, _, _ in counts:
            score[m] += leaves[2 * (m >> a & 1) + (m >> b & 1)]
    return trees


def tree_score(trees, mask: int) -> float:
    return sum(leaves[2 * (mask >> a & 1) + (mask >> b & 1)] for a, b, leaves in trees)


def fold(id_: Column) -> Column:
    """0 for documents that teach the trees, 1 for those that calibrate the threshold (a null id counts as empty)."""
    return F.pmod(F.xxhash64(F.lit("pii"), F.coalesce(id_.cast("string"), F.lit(""))), F.lit(2))


def _proposed(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """(doc_id, base, cand) of every row; a null text is empty."""
    d = docs.select(F.col(id_col).alias("doc_id"), F.coalesce(F.col(text_col), F.lit("")).alias("text"))
    return candidates(d).select("doc_id", "base", "cand")


def _learn(proposed: DataFrame):
    """(trees, threshold) from all proposals."""
    c = proposed.select(fold(F.col("doc_id")).alias("fold"), F.explode_outer("cand").alias("c"))  # an inner explode would have Spark test, and so compute, the candidates first
    rows = (c.where(~F.col("c.refuted") | F.col("c.y")).groupBy("fold", F.col("c.mask").alias("mask"))
            .agg(F.count("*").alias("n"), F.sum(F.col("c.y").cast("int")).alias("p")).collect())
    learn = sorted((r["mask"], float(r["p"]), float(r["n"])) for r in rows if r["fold"] == 0)
    check = sorted((r["mask"], float(r["p"]), float(r["n"])) for r in rows if r["fold"] == 1)
    if not learn or not any(p for _, p, _ in learn):
        return [], None
    trees = boost(learn)
    chance = [(1 / (1 + math.exp(-tree_score(trees, m))), p) for m, p, _ in check]
    found = sum(p for _, p in chance)
    if not found:
        return trees, None
    half = sum(g * p for g, p in chance) / found / 2
    return trees, math.log(half / (1 - half))


def _select(proposed: DataFrame, trees, threshold: float | None) -> DataFrame:
    """(doc_id, base, added) of proposals."""
    def score(mask: Column) -> Column:
        total = F.lit(0.0)
        for a, b, (l00, l01, l10, l11) in trees:
            x, y = F.getbit(mask, F.lit(a)) == 1, F.getbit(mask, F.lit(b)) == 1
            total = total + F.when(x & y, l11).when(x, l10).when(y, l01).otherwise(l00)
        return total

    limit = threshold if threshold is not None else float("inf")
    chosen = F.filter("cand", lambda c: ~c["y"] & ~c["refuted"] & (score(c["mask"]) >= limit))
    return proposed.select("doc_id", "base", F.coalesce(F.transform(chosen, lambda c: c["span"]), no_spans()).alias("added"))


def _digests(s: DataFrame) -> DataFrame:
    return s.select("doc_id", *[count_kind(F.col("base"), k).alias(f"n_{k}") for k in ("email", "ip", "card", "phone")],
                    F.sha2(digest(F.col("base")), 256).alias("base_sha256"), digest(F.concat("base", "added")).alias("spans"))


def fit(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text"):
    """(trees, threshold) from all texts; half of them calibrate the threshold.

    Null and empty texts, and repeated rows, teach what they hold; extra columns are ignored. Without a candidate
    (an empty table) or without a positive one nothing is ever added (threshold None)."""
    return _learn(_proposed(docs, id_col, text_col))


def scan(docs: DataFrame, trees, threshold: float | None, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, base, added): base spans, and the selected candidates that overlap no base span.

    A null text is empty and has no span; repeated rows each give a row; extra columns are ignored; an empty table
    gives no rows."""
    return _select(_proposed(docs, id_col, text_col), trees, threshold)


def pii_digests(docs: DataFrame, trees, threshold: float | None, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, n_email, n_ip, n_card, n_phone, base_sha256, spans) for every row of ``docs``; rows as in ``scan``."""
    return _digests(scan(docs, trees, threshold, id_col, text_col))


def pii_table(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``pii_digests`` with the model fitted on the same ``docs``, each text scanned once."""
    p = staged(_proposed(docs, id_col, text_col), "proposed")
    return _digests(_select(p, *_learn(p)))

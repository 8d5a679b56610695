"""Secret scan: key formats, and a randomness test battery over all other long tokens.

For each token the encoding is inferred (hex, base32, lower or upper alphanumeric, base64) and three tests ask
whether it could be a uniform draw over that alphabet: chi-squared of the symbol counts (exact tail),
Wald-Wolfowitz runs about the alphabet's middle, lag-one serial correlation. Both kinds of error are controlled
over a document's tokens by the Benjamini-Hochberg procedure, weighted by token length: the battery's p-values
(least of three, Bonferroni) decide which tokens are not random, and the evidence against an ordinary token
decides which of the others are reported. That evidence is the likelihood ratio of the uniform draw to a model
of identifiers: the symbol counts and lag-one changes the tests look at, as letter frequencies and steps between
small and capital letters, digits and signs. Its inverse bounds the chance under the model (Markov's inequality).

A token is walked once and its symbols sorted once, so long tokens (inline images, certificates) cost n log n.
"""

from __future__ import annotations

import json
import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from terraloom.llm.spans import count_kind, digest, find_spans, let, no_spans, touches, with_cells

KEY = "[Pp][Aa][Ss][Ss][Ww][Oo][Rr][Dd]|[Pp][Aa][Ss][Ss][Ww][Dd]|[Ss][Ee][Cc][Rr][Ee][Tt]|[Tt][Oo][Kk][Ee][Nn]|[Aa][Pp][Ii]_?[Kk][Ee][Yy]"
ASSIGN = rf"""({KEY})["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)"""
#: The base forms [A-Z0-9]+ and [0-9a-f]+ with their least lengths built in: both are maximal runs.
ACCESS = "AKIA[A-Z0-9]{12,}"
HEX = "[0-9a-f]{32,}"
TOKEN = "(?<![A-Za-z0-9+/_-])[A-Za-z0-9+/_-]{20,}+"
#: Level of the control over reported tokens; level of the control over tokens the battery calls not random.
FALSE_RATE, REJECT = 0.001, 0.01
#: Ordinary tokens: percent of the letters a to z, none under RARE; chances of the class (small, capital, digit, sign) after each class.
LETTERS, RARE = (8.2, 1.5, 2.8, 4.3, 12.7, 2.2, 2.0, 6.1, 7.0, 0.2, 0.8, 4.0, 2.4, 6.7, 7.5, 1.9, 0.1, 6.0, 6.3, 9.1, 2.8, 1.0, 2.4, 0.2, 2.0, 0.1), 0.8
STEPS = ((0.87, 0.05, 0.04, 0.04), (0.40, 0.47, 0.05, 0.08), (0.10, 0.08, 0.70, 0.12), (0.55, 0.20, 0.15, 0.10))

_ALPHABETS = (("^[0-9a-f]+$", "0123456789abcdef"), ("^[0-9A-F]+$", "0123456789ABCDEF"), ("^[A-Z2-7]+$", "ABCDEFGHIJKLMNOPQRSTUVWXYZ234567"),
              ("^[0-9a-z]+$", "0123456789abcdefghijklmnopqrstuvwxyz"), ("^[0-9A-Z]+$", "0123456789ABCDEFGHIJKLMNOPQRSTUVWXYZ"),
              ("^[A-Za-z0-9+/]+$", "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789+/"))
_URL_SAFE = "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789-_"
_SYMBOLS = "abcdefghijklmnopqrstuvwxyzABCDEFGHIJKLMNOPQRSTUVWXYZ0123456789+/-_"
_CLASS = [0] * 26 + [1] * 26 + [2] * 10 + [3] * 4
_TABLES = [*[(p, a) for p, a in _ALPHABETS], ("", _URL_SAFE)]
#: Chebyshev coefficients of erfc (fixed values; relative error under 1.2e-7 everywhere).
ERFC = (-1.26551223, 1.00002368, 0.37409196, 0.09678418, -0.18628806, 0.27886807, -1.13520398, 1.48851587, -0.82215223, 0.17087277)


def _log_symbols() -> list[float]:
    """Log chance of each of _SYMBOLS within its class in an ordinary token."""
    letters = [max(x, RARE) for x in LETTERS]
    return [math.log(x / sum(letters)) for x in letters] * 2 + [-math.log(10)] * 10 + [-math.log(4)] * 4


def table(values: list) -> Column:
    """A constant array (or array of arrays) of doubles as one expression."""
    return F.from_json(F.lit(json.dumps(values)), "array<array<double>>" if isinstance(values[0], list) else "array<double>")


def erfc(x: Column) -> Column:
    """Complementary error function of ``x`` >= 0."""
    def at(t: Column) -> Column:
        p = F.lit(ERFC[-1])
        for c in reversed(ERFC[:-1]):
            p = c + t * p
        return p

    return let(x, lambda v: let(1 / (1 + 0.5 * v), lambda t: t * F.exp(-v * v + at(t))))


def two_sided(z: Column) -> Column:
    """Chance of a standard normal value at least as far from zero as ``z``."""
    return erfc(F.abs(z) / math.sqrt(2))


def chi_squared_tail(x: Column, df: Column) -> Column:
    """Chance of a chi-squared value above ``x``, by the finite series that holds for odd ``df``."""
    start = F.struct(F.sqrt(x).alias("term"), F.lit(0.0).alias("sum"))
    more = lambda acc, r: F.struct((acc["term"] * x / (2 * r + 1)).alias("term"), (acc["sum"] + acc["term"]).alias("sum"))
    series = F.when(df > 1, F.aggregate(F.sequence(F.lit(1), F.greatest(((df - 1) / 2).cast("int"), F.lit(1))), start, more, lambda acc: acc["sum"])).otherwise(0.0)
    return F.when(x > 1400, 0.0).otherwise(F.least(F.lit(1.0), erfc(F.sqrt(x / 2)) + math.sqrt(2 / math.pi) * F.exp(-x / 2) * series))


def walk(codes: Column, places: Column, middle: Column) -> Column:
    """One pass over a token's symbols: sums for serial correlation, runs, and the log chance of an ordinary token
    (its first class is any of four alike)."""
    one, steps, classes = table(_log_symbols()), table([math.log(x) for row in STEPS for x in row]), table(_CLASS)

    def state(was, first, last, total, squares, lag, ups, runs, log):
        named = dict(was=was, first=first, last=last, total=total, squares=squares, lag=lag, ups=ups, runs=runs, log=log)
        return F.struct(*[v.alias(k) for k, v in named.items()])

    zero = F.lit(0.0)

    def step(acc: Column, i: Column) -> Column:
        x, now, begun = F.element_at(places, i), F.element_at(classes, i), acc["was"] >= 0
        high = x > middle
        moved = F.when(begun, F.element_at(steps, (F.greatest(acc["was"], zero) * 4 + now + 1).cast("int"))).otherwise(0.0)
        return state(now, F.when(begun, acc["first"]).otherwise(x), x, acc["total"] + x, acc["squares"] + x * x, acc["lag"] + acc["last"] * x, acc["ups"] + F.when(high, 1.0).otherwise(0.0),
                     acc["runs"] + F.when(begun & (high == (acc["last"] > middle)), 0.0).otherwise(1.0), acc["log"] + moved + F.element_at(one, i))

    return F.aggregate(codes, state(F.lit(-1.0), zero, zero, zero, zero, zero, zero, zero, F.lit(-math.log(4))), step)


def count_squares(codes: Column) -> Column:
    """Sum of the squared symbol counts, from the sorted symbols."""
    start = F.struct(F.lit(0).alias("was"), F.lit(0.0).alias("run"), F.lit(0.0).alias("sum"))

    def step(acc: Column, i: Column) -> Column:
        run = F.when(i == acc["was"], acc["run"] + 1).otherwise(1.0)
        return F.struct(i.alias("was"), run.alias("run"), (acc["sum"] + 2 * run - 1).alias("sum"))

    return F.aggregate(F.sort_array(codes), start, step, lambda acc: acc["sum"])


def randomness(span: Column) -> Column:
    """struct(span, n, p_random, p_null) of one candidate: the battery's p-value, and the bound of the ordinary-token p-value."""
    token = span["text"]
    kind = F.lit(len(_TABLES) - 1)
    for k, (pattern, _) in reversed(list(enumerate(_TABLES[:-1]))):
        kind = F.when(token.rlike(pattern), k).otherwise(kind)
    places = table([[float(a.find(c) + 1) for c in _SYMBOLS] for _, a in _TABLES])
    codes = F.transform(F.filter(F.split(token, ""), lambda c: c != ""), lambda c: F.instr(F.lit(_SYMBOLS), c))

    def tests(b: Column, w: Column) -> Column:
        n, a = F.size(b["codes"]).cast("double"), b["a"]
        chi = F.greatest(a / n * count_squares(b["codes"]) - n, F.lit(0.0))
        mean_runs = 2 * w["ups"] * (n - w["ups"]) / n + 1
        z_runs = (w["runs"] - mean_runs) / F.sqrt(F.greatest((mean_runs - 1) * (mean_runs - 2) / (n - 1), F.lit(1e-6)))
        mean = w["total"] / n
        var = F.greatest(w["squares"] - n * mean * mean, F.lit(1e-9))
        lag = w["lag"] - mean * (2 * w["total"] - w["first"] - w["last"]) + (n - 1) * mean * mean
        p = let(chi, lambda x: F.least(chi_squared_tail(x, a - 1), two_sided(z_runs), two_sided(lag / var * F.sqrt(n))))
        return F.struct(span.alias("span"), n.alias("n"), F.least(F.lit(1.0), 3 * p).alias("p_random"), F.least(F.lit(1.0), F.exp(n * F.log(a) + w["log"])).alias("p_null"))

    sizes = table([float(len(a)) for _, a in _TABLES])
    bound = let(kind, lambda k: F.struct(codes.alias("codes"), F.element_at(places, k + 1).alias("places"), F.element_at(sizes, k + 1).alias("a")))
    return let(bound, lambda b: let(walk(b["codes"], b["places"], b["a"] / 2), lambda w: tests(b, w)))


def discoveries(p: Column, level: float) -> Column:
    """Largest of the sorted values ``p`` that the Benjamini-Hochberg procedure rejects at ``level``; null if none."""
    return let(F.sort_array(p), lambda s: let(F.size(s), lambda m: F.array_max(F.transform(s, lambda q, i: F.when(q <= (i + 1) * level / m, q)))))


def scan(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, base, added): arrays of base spans (by start, then kind) and of spans the test battery adds.

    A null text is empty and has no span; repeated rows each give a row; extra columns are ignored; an empty
    table gives no rows. Spans never depend on other rows. Added spans overlap no base span.
    """
    d = docs.select(F.col(id_col).alias("doc_id"), F.coalesce(F.col(text_col), F.lit("")).alias("text"))
    t, any_ = F.col("text"), lambda m: F.lit(True)
    d = d.withColumn("base", F.array_sort(F.concat(find_spans(t, ASSIGN, "assign", 0, lambda m: F.length(F.regexp_extract(m, ASSIGN, 2)) >= 8),
                                                   find_spans(t, ACCESS, "access", 1, any_), find_spans(t, HEX, "hex", 2, any_))))
    tokens = find_spans(t, TOKEN, "random", 3, lambda m: m.rlike("[0-9]") & m.rlike("[A-Za-z]") & ~m.rlike("^[0-9a-f]{8}(-[0-9a-f]{4}){3}-[0-9a-f]{12}$"))

    def weighted(found: Column) -> Column:
        """The tokens with their p-values over their length weights."""
        total = F.aggregate(found, F.lit(0.0), lambda acc, c: acc + c["n"]) / F.size(found)
        return let(total, lambda mean: F.transform(found, lambda c: F.struct(c["span"].alias("span"), (c["p_random"] * mean / c["n"]).alias("random"), (c["p_null"] * mean / c["n"]).alias("null"))))

    def chosen(found: Column) -> Column:
        limits = F.struct(F.coalesce(discoveries(F.transform(found, lambda c: c["random"]), REJECT), F.lit(-1.0)).alias("random"),
                          F.coalesce(discoveries(F.transform(found, lambda c: c["null"]), FALSE_RATE), F.lit(-1.0)).alias("null"))
        return let(limits, lambda cut: F.transform(F.filter(found, lambda c: (c["random"] > cut["random"]) & (c["null"] <= cut["null"])), lambda c: c["span"]))

    d = d.withColumn("found", let(tokens, lambda f: F.when(F.size(f) > 0, let(weighted(F.transform(f, randomness)), chosen))))
    clear = with_cells(F.col("base"), F.length(t), lambda cells: F.filter("found", lambda s: ~touches(cells, s)))
    return d.select("doc_id", "base", F.when(F.size("found") > 0, clear).otherwise(no_spans()).alias("added"))


def secret_digests(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, n_assign, n_access, n_hex, base_sha256, spans) for every row of ``docs``; rows as in ``scan``."""
    s = scan(docs, id_col, text_col)
    return s.select("doc_id", *[count_kind(F.col("base"), k).alias(f"n_{k}") for k in ("assign", "access", "hex")],
                    F.sha2(digest(F.col("base")), 256).alias("base_sha256"), digest(F.array_sort(F.concat("base", "added"))).alias("spans"))

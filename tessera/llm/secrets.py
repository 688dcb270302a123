"""Secret scans: patterns, and a battery of randomness tests.

Long tokens are taken as candidates.  For each, an encoding is inferred (hex,
base32, base36, base62 or base64) and three tests ask whether its symbols could
be random draws from that alphabet: chi-squared uniformity, runs above and below
the middle of the alphabet, and serial correlation, as one p-value (Bonferroni
over the three).  The Benjamini-Hochberg step takes these p-values, apart for
each encoding and class of lengths over the candidates of the whole corpus:
what it rejects is not random, and at most ``fdr`` of that is expected to be.

Ordinary words, too, can pass, the shorter the more easily.  So as an extra
condition a token must change between lower case, upper case, digits and signs
about as often as draws from its alphabet do.  The step bounds the random tokens
that are lost, not the ordinary ones that are reported.

Only DataFrame functions.  The first pass counts candidates per (encoding,
length class, p-value bin), a few thousand numbers; the second reports spans.
Nothing else is shuffled.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tessera.llm.common import let, text_or_empty

#: Kinds in the order in which equal starts are listed, their pattern, and the least length of a group.
ASSIGN = "(?i)(password|passwd|secret|token|api_?key)[\"']?\\x20*[:=]\\x20*[\"']?([A-Za-z0-9+/_.=-]+)"
PATTERNS = [
    ("assign", ASSIGN, 2, 6),
    # a run of hex digits below 24, or of letters and digits after AKIA below 16, cannot hold a match
    ("access", "AKIA[A-Z0-9]{16,}", 0, 20),
    ("hex", "[0-9a-f]{24,}", 0, 24),
]
KINDS = [k for k, *_ in PATTERNS] + ["random"]
CANDIDATE = "[A-Za-z0-9+/_-]{20,}"

HEX, BASE32 = "0123456789abcdef", "ABCDEFGHIJKLMNOPQRSTUVWXYZ234567"
BASE36 = "0123456789abcdefghijklmnopqrstuvwxyz"
BASE64 = "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789+/-_"
#: (encoding, pattern of the whole token, alphabet, number of symbols); the first that fits is inferred.
ENCODINGS = [
    ("hex", "^[0-9a-f]+$", HEX, 16),
    ("HEX", "^[0-9A-F]+$", HEX.upper(), 16),
    ("BASE32", "^[A-Z2-7]+$", BASE32, 32),
    ("base32", "^[a-z2-7]+$", BASE32.lower(), 32),
    ("BASE36", "^[A-Z0-9]+$", BASE36.upper(), 36),
    ("base36", "^[a-z0-9]+$", BASE36, 36),
    ("base62", "^[A-Za-z0-9]+$", BASE64[:62], 62),
    ("base64", "^[A-Za-z0-9+/_-]+$", BASE64, 64),
]
#: Encodings by number; groups count from 0 by encoding, then by length class.
NUMBERED = ["base62", "base64", "hex", "HEX", "BASE32", "base32", "BASE36", "base36"]

SPANS = "array<struct<at:int,order:int,kind:string,end:int>>"
BLOCK = 256

#: Least lengths of the length classes.
LENGTHS = [20, 24, 32, 48, 64, 128]
BINS = 400  # of -ln p, each a tenth wide
FEW_CHANGES = 1.645  # standard deviations below the mean: one random token in twenty


def spans_of(text: Column, pattern: str, group: int, least: int, kind: str) -> Column:
    """(at, order, kind, end) of the leftmost non-overlapping matches whose group has ``least`` characters.

    Places come from the lengths of what lies between the matches.
    """
    order = KINDS.index(kind)
    none = F.array().cast(SPANS)

    def placed(x: Column) -> Column:
        last = F.size(x.found) - 1

        def add(acc: Column, i: Column) -> Column:
            start = acc.at + F.length(x.gaps[i])
            end = start + F.length(x.found[i])
            span = F.struct(start.alias("at"), F.lit(order).alias("order"), F.lit(kind).alias("kind"), end.alias("end"))
            fits = F.length(x.groups[i]) >= least
            return F.struct(end.alias("at"), F.when(fits, F.array_append(acc.spans, span)).otherwise(acc.spans).alias("spans"))

        def block(acc: Column, first: Column) -> Column:
            """The next BLOCK matches; appending to short arrays keeps long texts from quadratic time."""
            steps = F.sequence(first, F.least(first + BLOCK - 1, last))
            done = F.aggregate(steps, F.struct(acc.at.alias("at"), none.alias("spans")), add)
            return let(done, lambda d: F.struct(d.at.alias("at"), F.array_append(acc.blocks, d.spans).alias("blocks")))

        start = F.struct(F.lit(0).alias("at"), F.array().cast(f"array<{SPANS}>").alias("blocks"))
        return F.aggregate(F.sequence(F.lit(0), last, F.lit(BLOCK)), start, block, lambda acc: F.flatten(acc.blocks))

    cut = F.struct(
        F.split(text, pattern).alias("gaps"),
        F.regexp_extract_all(text, F.lit(pattern), 0).alias("found"),
        F.regexp_extract_all(text, F.lit(pattern), group).alias("groups"),
    )
    return F.when(text.rlike(pattern), let(cut, placed)).otherwise(none)


# ------------------------------------------------------------ the battery ----


def _normal_tail(z: Column) -> Column:
    """Upper tail of the standard normal, by the logistic approximation."""
    return 1 / (1 + F.exp(F.least(1.5976 * z + 0.07056 * z * z * z, F.lit(700.0))))


def inferred(token: Column) -> Column:
    """Name of the first encoding that fits."""
    encoding = F.lit(None).cast("string")
    for name, pattern, *_ in reversed(ENCODINGS):
        encoding = F.when(token.rlike(pattern), name).otherwise(encoding)
    return encoding


def randomness(token: Column) -> Column:
    """Struct (encoding, p): the p-value of the battery under random draws from the inferred alphabet."""

    def spec(encoding: Column) -> Column:
        alphabet, size = F.lit(""), F.lit(0)
        for name, _, symbols, n in ENCODINGS:
            alphabet = F.when(encoding == name, symbols).otherwise(alphabet)
            size = F.when(encoding == name, n).otherwise(size)
        return F.struct(encoding.alias("encoding"), alphabet.alias("alphabet"), size.cast("double").alias("size"))

    def tested(x: Column) -> Column:
        # values from 0; the two spellings of the last base64 symbols count as one
        values = F.transform(
            F.split(token, ""), lambda c: F.least(F.instr(x.alphabet, c) - 1, x.size - 1).cast("double")
        )
        return let(values, lambda v: battery(v, x.size))

    def battery(v: Column, k: Column) -> Column:
        n = F.size(v).cast("double")

        def sums(f) -> Column:
            return F.aggregate(f, F.lit(0.0), lambda a, b: a + b)

        # chi-squared, made normal by the cube root
        df = k - 1
        squares = sums(F.transform(F.array_distinct(v), lambda s: F.pow(F.size(F.filter(v, lambda c: c == s)).cast("double"), F.lit(2.0))))
        chi = k / n * squares - n
        z_chi = (F.cbrt(F.greatest(chi, F.lit(0.0)) / df) - (1 - 2 / (9 * df))) / F.sqrt(2 / (9 * df))
        # runs above and below the middle
        high = F.transform(v, lambda c: F.when(c >= k / 2, 1.0).otherwise(0.0))

        def runs(h: Column) -> Column:
            n1 = sums(h)
            n2 = n - n1
            r = 1 + sums(F.zip_with(F.slice(h, 2, F.size(h)), F.slice(h, 1, F.size(h) - 1), lambda a, b: F.abs(a - b)))
            mean = 1 + 2 * n1 * n2 / n
            var = (mean - 1) * (mean - 2) / (n - 1)
            return F.when(var > 0, F.abs(r - mean) / F.sqrt(var)).otherwise(F.sqrt(n))

        # serial correlation of neighbours
        def serial(mean: Column) -> Column:
            off = F.transform(v, lambda c: c - mean)

            def ratio(o: Column) -> Column:
                var = sums(F.transform(o, lambda c: c * c))
                cov = sums(F.zip_with(F.slice(o, 2, F.size(o)), F.slice(o, 1, F.size(o) - 1), lambda a, b: a * b))
                return F.when(var > 0, F.abs(cov / var) * F.sqrt(n)).otherwise(F.sqrt(n))

            return let(off, ratio)

        worst = F.least(
            _normal_tail(z_chi), 2 * _normal_tail(let(high, runs)), 2 * _normal_tail(let(sums(v) / n, serial))
        )
        return F.least(F.lit(1.0), 3 * worst)

    return let(let(inferred(token), spec), lambda x: F.struct(x.encoding.alias("encoding"), tested(x).alias("p")))


def _marks(symbols: str, n: int) -> list[float]:
    """Shares of lower case, upper case, digits and signs in an alphabet."""
    kinds = [str.islower, str.isupper, str.isdigit]
    counts = [sum(map(kind, symbols)) for kind in kinds]
    return [c / n for c in [*counts, n - sum(counts)]]


def changes_often(token: Column, encoding: Column) -> Column:
    """Does the token change class about as often as draws from its alphabet, and at least once?"""
    marks = F.transform(
        F.split(token, ""),
        lambda c: F.when(c.between("a", "z"), 0).when(c.between("A", "Z"), 1).when(c.between("0", "9"), 2).otherwise(3),
    )

    def enough(m: Column) -> Column:
        n = F.size(m) - 1
        changes = F.aggregate(
            F.zip_with(F.slice(m, 2, n), F.slice(m, 1, n), lambda a, b: (a != b).cast("int")), F.lit(0), lambda a, b: a + b
        )
        least = F.lit(None).cast("double")
        for name, _, symbols, size in ENCODINGS:
            shares = _marks(symbols, size)
            two, three = sum(p**2 for p in shares), sum(p**3 for p in shares)
            # changes of neighbouring places are not independent
            var = n * two * (1 - two) + 2 * (n - 1) * (three - two**2)
            least = F.when(encoding == name, n * (1 - two) - FEW_CHANGES * F.sqrt(var)).otherwise(least)
        return (changes > 0) & (changes >= least)

    return let(marks, enough)


def _group(token: Column, encoding: Column) -> Column:
    """Number of the encoding and length class."""
    out, number = F.lit(0), F.lit(0)
    for i, n in enumerate(LENGTHS):
        out = F.when(F.length(token) >= n, i).otherwise(out)
    for i, name in enumerate(NUMBERED):
        number = F.when(encoding == name, i).otherwise(number)
    return number * len(LENGTHS) + out


def discovery_limits(docs: DataFrame, text: str = "text", fdr: float = 0.01) -> dict[int, float]:
    """Of each encoding and length class with a random token, the p-value of the battery that one must be above.

    The Benjamini-Hochberg step over the candidates of the whole corpus rejects
    those at or below it; it is 0 if none is.  At most ``BINS`` counts per group
    are shuffled from each task.
    """
    tokens = docs.select(F.explode(F.regexp_extract_all(text_or_empty(text), F.lit(CANDIDATE), 0)).alias("token"))
    tested = tokens.select("token", randomness(F.col("token")).alias("r"))
    bins = (
        tested.select(
            _group(F.col("token"), F.col("r.encoding")).alias("group"),
            F.least(F.floor(-F.log("r.p") * 10), F.lit(BINS)).cast("int").alias("bin"),
            changes_often(F.col("token"), F.col("r.encoding")).cast("int").alias("mixed"),
        )
        .groupBy("group", "bin")
        .agg(F.count("*").alias("n"), F.sum("mixed").alias("mixed"))
    )
    over = Window.partitionBy("group")
    ranked = bins.withColumn("m", F.sum("n").over(over)).withColumn("k", F.sum("n").over(over.orderBy(F.desc("bin"))))
    # p of a bin is at most exp(-bin / 10); the k tokens from it on are rejected if that is below k / m of the rate
    rejects = (F.col("bin") > 0) & (F.exp(-F.col("bin") / 10) <= F.col("k") / F.col("m") * fdr)
    lows = ranked.withColumn("low", F.min(F.when(rejects, F.col("bin"))).over(over))
    kept = lows.filter((F.col("mixed") > 0) & (F.col("low").isNull() | (F.col("bin") < F.col("low"))))
    rows = kept.groupBy("group").agg(F.min("low").alias("low")).collect()
    return {r["group"]: 0.0 if r["low"] is None else math.exp(-r["low"] / 10) for r in rows}


def find_secrets(
    docs: DataFrame,
    limits: dict[int, float] | None = None,
    text: str = "text",
    fdr: float = 0.01,
) -> DataFrame:
    """Add ``spans``: array of (at, order, kind, end) by start, then kind, in code points, end exclusive.

    Pattern spans (assign, access, hex) are all leftmost non-overlapping
    matches; ``random`` spans are candidates whose battery is above the
    discovery limits (by default those of ``docs`` itself), that change class
    often and touch no pattern span.

    Null and empty texts have no spans.  Repeated rows are judged alike and all
    stay; an input column named spans is replaced.  An empty table stays empty.
    """
    if limits is None:
        limits = discovery_limits(docs, text, fdr)
    t = text_or_empty(text)
    base = F.concat(*(spans_of(t, pattern, group, least, kind) for kind, pattern, group, least in PATTERNS))
    candidates = spans_of(t, CANDIDATE, 0, 20, "random")

    def accepted(s: Column, found: Column) -> Column:
        clear = ~F.exists(found, lambda b: (b.at < s.end) & (s.at < b.end))

        def passes(token: Column) -> Column:
            def above(x: Column) -> Column:
                limit = F.lit(math.inf)
                for g, low in limits.items():
                    limit = F.when(x.group == g, low).otherwise(limit)
                return (limit < 1) & changes_often(token, x.encoding) & (randomness(token).p > limit)

            def grouped(encoding: Column) -> Column:
                return F.struct(encoding.alias("encoding"), _group(token, encoding).alias("group"))

            return let(let(inferred(token), grouped), above)

        return clear & let(F.substring(t, s.at + 1, s.end - s.at), passes)

    def both(found: Column) -> Column:
        return F.array_sort(F.concat(found, F.filter(candidates, lambda s: accepted(s, found))))

    rest = [c for c in docs.columns if c != "spans"]
    return docs.select(*rest, let(base, both).alias("spans"))


def spans_text(spans: Column) -> Column:
    """kind:start:end of each span, comma-joined."""
    return F.array_join(
        F.transform(spans, lambda s: F.concat_ws(":", s.kind, s.at.cast("string"), s.end.cast("string"))), ","
    )


def redact(text: Column, spans: Column, mark: str = "[REDACTED]") -> Column:
    """The text with each span, or run of overlapping ones, replaced by ``mark``."""

    def add(acc: Column, s: Column) -> Column:
        gap = F.substring(text, acc.at + 1, s.at - acc.at)
        return F.when(s.end <= acc.at, acc).otherwise(
            F.struct(
                s.end.alias("at"),
                F.when(s.at < acc.at, acc.out).otherwise(F.concat(acc.out, gap, F.lit(mark))).alias("out"),
            )
        )

    return F.aggregate(
        spans,
        F.struct(F.lit(0).alias("at"), F.lit("").alias("out")),
        add,
        lambda acc: F.concat(acc.out, F.substring(text, acc.at + 1, F.length(text))),
    )

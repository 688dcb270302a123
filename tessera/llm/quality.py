"""Quality rules: distribution divergence from language references.

Per document two histograms are taken: of character classes, and of the common
words of its language.  The references are the sums of these histograms over
all documents of a language.  A document fails if it is long enough for its
histogram to be telling and the Jensen-Shannon distance to its reference is
over a limit; plain length and repetition rules come before.

Only DataFrame functions.  Two passes over the text: the first sums histograms
per language, the second compares.  Every language has its own reference,
whatever its share, if that holds enough characters; without one (or without a
language) nothing is compared.  References are broadcast, so the text is not
shuffled; beyond MOST_BROADCAST of them, the documents of the rarer languages
are joined by language.
"""

from __future__ import annotations

from dataclasses import dataclass, field

import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tessera.llm.common import WS_CLASS, let, space_words, stored, text_or_empty

#: Most common function words of each language with a word histogram: fixed values.
COMMON_WORDS = {
    "en": "the of and to a in that it is was for on with as be at by this from or an are not have which".split(),
    "de": "der die und das in den von zu mit sich des auf für ist im dem nicht ein eine als auch es an werden aus".split(),
    "fr": "de la le et les des en un une du que est dans qui par pour au il sur pas plus ne se ce avec".split(),
    "es": "de la que el en y a los se del las un por con no una su para es al lo como más o pero".split(),
}
#: Character classes after a-z: what does not belong to them.
CLASSES = ["[^A-Z]+", "[^0-9]+", "[^\\x09-\\x0D\\x20]+", "[^.,;:!?'\"()-]+", "[^#*$%&|<>@^~`_=+/\\\\{}\\[\\]]+"]
#: Least characters of a language's documents for a reference.
MIN_REFERENCE = 2000
MOST_BROADCAST = 1000


@dataclass(frozen=True)
class QualityRules:
    """Limits; lengths are in words (word histogram) and code points (classes)."""

    min_words: int = 50
    max_repeat_percent: int = 50
    min_chars: int = 200
    max_class_distance: float = 0.3
    min_histogram_words: int = 150
    max_word_distance: float = 0.3
    common_words: dict[str, list[str]] = field(default_factory=lambda: COMMON_WORDS)


def without_lower(text: Column) -> Column:
    """The text without a-z, which the counts of all other classes can do without."""
    return F.regexp_replace(text, "[a-z]+", "")


def class_histogram(text: Column, rest: Column) -> Column:
    """Counts of a-z, of each class, then of all other characters (letters beyond ASCII mostly).

    ``rest`` is the text without a-z.
    """
    counts = [F.length(F.regexp_replace(rest, c, "")) for c in CLASSES]
    return let(
        F.array(*counts),
        lambda h: F.concat(
            F.array(F.length(text) - F.length(rest)),
            h,
            F.array(F.length(rest) - F.aggregate(h, F.lit(0), lambda a, b: a + b)),
        ).cast("array<long>"),
    )


def _slots(common: list[str]) -> tuple[int, dict[int, str]]:
    """A table size, and the slot of each word in it by hash, without collisions."""
    size = 64
    while True:
        slots = {xxhash.xxh64_intdigest(w.encode(), 42) % size: w for w in common}
        if len(slots) == len(common):
            return size, slots
        size *= 2


def word_histogram(words: Column, common: list[str]) -> Column:
    """Counts of the common words (any case), then of all other words.

    Each common word is looked up by hash in a literal table and becomes one
    character; what is missing of the joined characters without it is its count.
    """
    signs = {w: chr(ord("0") + i) for i, w in enumerate(common)}
    size, slots = _slots(common)
    word_at = F.split(F.lit(" ".join(slots.get(i, "") for i in range(size))), " ")
    sign_at = F.split(F.lit(" ".join(signs.get(slots.get(i), "") for i in range(size))), " ")
    longest = max(len(w.encode()) for w in common)

    def code(w: Column) -> Column:
        low = F.lower(w)
        at = F.pmod(F.xxhash64(low), F.lit(size)).cast("int")
        return F.when((F.octet_length(w) <= longest) & (F.get(word_at, at) == low), F.get(sign_at, at))

    return let(
        F.array_join(F.transform(words, code), ""),
        lambda s: F.concat(
            F.array(*(F.length(s) - F.length(F.replace(s, F.lit(c), F.lit(""))) for c in signs.values())),
            F.array(F.size(words) - F.length(s)),
        ).cast("array<long>"),
    )


def histograms(text: Column, lang: Column, words: Column, rest: Column, rules: QualityRules) -> Column:
    """Struct of both histograms; languages without a word list have an empty second one."""
    by_lang = F.array().cast("array<long>")
    for name, common in rules.common_words.items():
        by_lang = F.when(lang == name, word_histogram(words, common)).otherwise(by_lang)
    return F.struct(class_histogram(text, rest).alias("classes"), by_lang.alias("words"))


def _cut(text: Column) -> Column:
    return F.struct(space_words(text).alias("words"), without_lower(text).alias("rest"))


def distance(counts: Column, reference: Column) -> Column:
    """Jensen-Shannon distance (base 2, 0 to 1) of two histograms; null if either is empty."""

    def total(h: Column) -> Column:
        return F.aggregate(h, F.lit(0.0), lambda a, b: a + b)

    def part(p: Column, m: Column) -> Column:
        return F.when(p > 0, p * F.log2(p / m)).otherwise(0.0)

    def terms(p: Column, q: Column) -> Column:
        m = (p + q) / 2
        return (part(p, m) + part(q, m)) / 2

    def compared(sums: Column) -> Column:
        each = F.zip_with(counts, reference, lambda a, b: terms(a / sums[0], b / sums[1]))
        return F.when((sums[0] > 0) & (sums[1] > 0), F.sqrt(F.greatest(F.lit(0.0), total(each))))

    return let(F.array(total(counts), total(reference)), compared)


def language_references(docs: DataFrame, rules: QualityRules, text: str = "text", lang: str = "lang") -> DataFrame:
    """(lang, classes, words): summed histograms per language, and of the whole corpus under null.

    Languages with less than MIN_REFERENCE characters, and documents without a
    language, have no row of their own.  Only sums of as many numbers as there
    are bins are shuffled.
    """
    t, code = text_or_empty(text), F.coalesce(F.col(lang), F.lit(""))
    rows = docs.select(code.alias("lang"), let(_cut(t), lambda x: histograms(t, code, x.words, x.rest, rules)).alias("h"))
    bins = len(CLASSES) + 2
    most = max(len(w) for w in rules.common_words.values()) + 1
    sums = [F.sum(F.get("h.classes", F.lit(i))).alias(f"c{i}") for i in range(bins)]
    sums += [F.sum(F.get("h.words", F.lit(i))).alias(f"w{i}") for i in range(most)]
    per_lang = rows.groupBy("lang").agg(F.count("*").alias("n"), *sums)
    per_lang = per_lang.cube("lang").agg(*(F.sum(c).alias(c) for c in per_lang.columns if c != "lang"))
    per_lang = stored(per_lang, "languages")  # read several times below
    # the cube's null row is the whole corpus (languages are never null here); a bin that no row has is null
    characters = sum((F.col(f"c{i}") for i in range(1, bins)), F.col("c0"))
    own = (F.col("lang") != "") & (characters >= MIN_REFERENCE)
    return per_lang.filter(F.col("lang").isNull() | own).select(
        "lang",
        F.array_compact(F.array(*(f"c{i}" for i in range(bins)))).alias("classes"),
        F.when(F.col("lang").isNotNull(), F.array_compact(F.array(*(f"w{i}" for i in range(most)))))
        .otherwise(F.array().cast("array<long>"))
        .alias("words"),
    )


def repeated_words(words: Column) -> Column:
    """Words in windows of three that stand twice or more in the text, the first one included."""

    def windows(w: Column) -> Column:
        each = F.transform(w, lambda x, i: F.xxhash64(x, F.get(w, i + 1), F.get(w, i + 2)))
        return F.slice(each, 1, F.greatest(F.size(w) - 2, F.lit(0)))

    def spread(at: Column) -> Column:
        """Words covered by windows at ascending places."""
        steps = F.transform(at, lambda p, j: F.least(F.lit(3), F.coalesce(F.get(at, j + 1) - p, F.lit(3))))
        return F.aggregate(steps, F.lit(0).cast("long"), lambda a, b: a + b)

    def by_search(h: Column, twice: Column) -> Column:
        return F.array_compact(F.transform(h, lambda x, i: F.when(F.array_contains(twice, x), i)))

    def by_sort(h: Column) -> Column:
        ordered = F.sort_array(F.transform(h, lambda x, i: F.struct(x.alias("h"), i.alias("i"))))

        def places(s: Column) -> Column:
            same = F.filter(s, lambda x, j: (F.get(s, j - 1).h == x.h) | (F.get(s, j + 1).h == x.h))
            return F.sort_array(F.transform(same, lambda x: x.i))

        return let(ordered, places)

    def covered(h: Column, twice: Column) -> Column:
        # few repeated windows are looked up, many are found by sorting
        at = F.when(F.size(twice) <= 32, by_search(h, twice)).otherwise(by_sort(h))
        return F.when(F.size(twice) == 0, F.lit(0).cast("long")).otherwise(let(at, spread))

    def repeated(h: Column) -> Column:
        twice = let(F.sort_array(h), lambda s: F.array_distinct(F.filter(s, lambda x, j: F.get(s, j + 1) == x)))
        return let(twice, lambda d: covered(h, d))

    return let(windows(words), repeated)


def measures(text: Column, words: Column, rest: Column) -> Column:
    """Struct of the plain measures of a text."""
    lines = F.filter(F.split(text, "\n"), lambda x: x.rlike(WS_CLASS.replace("[", "[^")))
    return F.struct(
        F.size(words).cast("long").alias("n_words"),
        F.length(F.array_join(words, "")).cast("long").alias("word_chars"),
        (F.length(rest) - F.length(F.regexp_replace(rest, "[#*$%&|<>]+", ""))).cast("long").alias("n_symbols"),
        let(lines, lambda x: F.size(x) - F.size(F.array_distinct(x))).cast("long").alias("n_dup_lines"),
        repeated_words(words).alias("n_repeat_words"),
    )


MEASURES = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words"]
RESULTS = [*MEASURES, "base_failed", "class_distance", "word_distance", "kept"]


def _with_references(docs: DataFrame, refs: DataFrame, code: Column) -> DataFrame:
    """``docs`` with the reference (__lang, __ref) of their language, null if there is none."""
    few = refs.limit(MOST_BROADCAST + 1).count() <= MOST_BROADCAST
    if few:
        return docs.join(F.broadcast(refs), code == F.col("__lang"), "left")
    size = F.aggregate("__ref.classes", F.lit(0).cast("long"), lambda a, b: a + b)
    common = refs.orderBy(size.desc(), "__lang").limit(MOST_BROADCAST)
    names = F.broadcast(common.select("__lang"))
    rest = refs.join(names, "__lang", "left_anti")
    # a rarer language has less than one character in MOST_BROADCAST
    near = docs.join(F.broadcast(common), code == F.col("__lang"))
    rare = docs.filter(code != "").join(names, code == F.col("__lang"), "left_anti").join(rest, code == F.col("__lang"), "left")
    without = docs.filter(code == "").select("*", *(F.lit(None).cast(f.dataType).alias(f.name) for f in refs.schema))
    return near.unionByName(rare).unionByName(without)


def judge(
    docs: DataFrame,
    rules: QualityRules | None = None,
    references: DataFrame | None = None,
    text: str = "text",
    lang: str = "lang",
) -> DataFrame:
    """Add the measures, base_failed, both distances and kept to every row.

    ``references`` defaults to those of ``docs`` itself.  Null and empty texts
    have no words and fail the base rules; a null or empty language has no
    reference, nor has one with too few characters.  A distance that cannot be
    taken (too short a text, or no reference) is null and rejects nothing.  Repeated
    rows are judged alike and all stay; input columns that carry a name of the
    result are replaced.  An empty table stays empty.
    """
    rules = rules or QualityRules()
    if references is None:
        references = language_references(docs, rules, text, lang)
    refs = references.filter(F.col("lang").isNotNull() & (F.col("lang") != "")).select(
        F.col("lang").alias("__lang"), F.struct("classes", "words").alias("__ref")
    )
    kept_columns = [c for c in docs.columns if c not in RESULTS]
    t, code = text_or_empty(text), F.coalesce(F.col(lang), F.lit(""))
    joined = _with_references(docs.select(*kept_columns), refs, code)
    none = F.array().cast("array<long>")
    ref = F.coalesce("__ref", F.struct(none.alias("classes"), none.alias("words")))

    def judged(c: Column) -> Column:
        return let(
            F.struct(
                measures(t, c.words, c.rest).alias("m"), histograms(t, code, c.words, c.rest, rules).alias("h")
            ),
            lambda x: F.struct(
                *(x.m[c].alias(c) for c in MEASURES),
                F.when(F.length(t) >= rules.min_chars, distance(x.h.classes, ref.classes)).alias("class_distance"),
                F.when(F.size(c.words) >= rules.min_histogram_words, distance(x.h.words, ref.words)).alias("word_distance"),
            ),
        )

    out = joined.withColumn("__q", let(_cut(t), judged))
    failed = (F.col("__q.n_words") < rules.min_words) | (
        100 * F.col("__q.n_repeat_words") > rules.max_repeat_percent * F.col("__q.n_words")
    )
    diverges = (F.coalesce("__q.class_distance", F.lit(0.0)) > rules.max_class_distance) | (
        F.coalesce("__q.word_distance", F.lit(0.0)) > rules.max_word_distance
    )
    return out.select(
        *kept_columns,
        *(F.col(f"__q.{c}").alias(c) for c in MEASURES),
        failed.alias("base_failed"),
        F.col("__q.class_distance").alias("class_distance"),
        F.col("__q.word_distance").alias("word_distance"),
        (~failed & ~diverges).alias("kept"),
    )

"""License scans by diagonal voting.

Templates of license notices are cut into word k-grams, as are the documents;
all rolling k-gram hashes of the documents are joined with the template
positions.  A hit votes for the diagonal (word place in the document minus
place in the template); votes of neighbouring diagonals are merged, so that a
notice with a few words added or missing still counts as one span.  A span is
verified if the template places whose words it holds (each once) are a large
enough share of the template, it is not much longer than the template, it holds
the template's version and variant words (2, 0, nc, sharealike, ...) and no
other variant word.  Of spans that overlap, the one with most votes stays.

Only DataFrame functions.  The template table has as many rows as the templates
have words, whatever the corpus is, so it is broadcast; the documents'
k-grams meet it in the scan and only hits are shuffled.
"""

from __future__ import annotations

import re

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tessera.llm.common import ascii_lower, let, text_or_empty

WORD_GAP = "[\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+"
K = 3
NEAR_DIAGONALS = 3

#: (phrase, label) found word by word.
PHRASES = [("mit license", "mit"), ("apache license", "apache"), ("general public license", "gpl")]

#: Words that tell one license of a family from another.
VARIANTS = "nc sa nd noncommercial noncommercially sharealike noderivatives noderivs lesser affero".split()

_FREE = "{0} is free software{1} you can redistribute it and/or modify it under the terms of the GNU {2} as published by the Free Software Foundation{3} either version {4} of the License"
_BSD_2 = (
    "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the "
    "following conditions are met: 1. Redistributions of source code must retain the above copyright notice, this list "
    "of conditions and the following disclaimer. 2. Redistributions in binary form must reproduce the above copyright "
    "notice, this list of conditions and the following disclaimer in the documentation and/or other materials provided "
    "with the distribution. "
)
_BSD_3 = (
    "3. Neither the name of the copyright holder nor the names of its contributors may be used to endorse or promote "
    "products derived from this software without specific prior written permission. "
)
_BSD_END = (
    "THIS SOFTWARE IS PROVIDED BY THE COPYRIGHT HOLDERS AND CONTRIBUTORS \"AS IS\" AND ANY EXPRESS OR IMPLIED "
    "WARRANTIES, INCLUDING, BUT NOT LIMITED TO, THE IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS FOR A PARTICULAR "
    "PURPOSE ARE DISCLAIMED. IN NO EVENT SHALL THE COPYRIGHT HOLDER OR CONTRIBUTORS BE LIABLE FOR ANY DIRECT, INDIRECT, "
    "INCIDENTAL, SPECIAL, EXEMPLARY, OR CONSEQUENTIAL DAMAGES (INCLUDING, BUT NOT LIMITED TO, PROCUREMENT OF SUBSTITUTE "
    "GOODS OR SERVICES; LOSS OF USE, DATA, OR PROFITS; OR BUSINESS INTERRUPTION) HOWEVER CAUSED AND ON ANY THEORY OF "
    "LIABILITY, WHETHER IN CONTRACT, STRICT LIABILITY, OR TORT (INCLUDING NEGLIGENCE OR OTHERWISE) ARISING IN ANY WAY "
    "OUT OF THE USE OF THIS SOFTWARE, EVEN IF ADVISED OF THE POSSIBILITY OF SUCH DAMAGE."
)
_CC = {
    "by": "Attribution",
    "by-sa": "Attribution-ShareAlike",
    "by-nc": "Attribution-NonCommercial",
    "by-nd": "Attribution-NoDerivatives",
    "by-nc-sa": "Attribution-NonCommercial-ShareAlike",
    "by-nc-nd": "Attribution-NonCommercial-NoDerivatives",
}

#: (label, notice): openings, short forms and short full texts of public licenses, fixed values.
TEMPLATES = [
    ("mit", "Released under the MIT License"),
    (
        "mit",
        "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated "
        "documentation files (the \"Software\"), to deal in the Software without restriction",
    ),
    ("apache-2.0", "Licensed under the Apache License, Version 2.0"),
    ("apache-2.0", "you may not use this file except in compliance with the License"),
    ("gpl-3.0", "This work is licensed under the GNU General Public License, version 3"),
    (
        "gpl",
        "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General "
        "Public License as published by the Free Software Foundation",
    ),
    (
        "bsd",
        "Redistribution and use in source and binary forms, with or without modification, are permitted provided that "
        "the following conditions are met",
    ),
    ("cc-by-nc-4.0", "Licensed under CC BY-NC 4.0"),
    ("cc-by-4.0", "This work is licensed under a Creative Commons Attribution 4.0 International License"),
    (
        "mit",
        "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated "
        "documentation files (the \"Software\"), to deal in the Software without restriction, including without "
        "limitation the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the "
        "Software, and to permit persons to whom the Software is furnished to do so, subject to the following "
        "conditions: The above copyright notice and this permission notice shall be included in all copies or "
        "substantial portions of the Software. THE SOFTWARE IS PROVIDED \"AS IS\", WITHOUT WARRANTY OF ANY KIND, EXPRESS "
        "OR IMPLIED, INCLUDING BUT NOT LIMITED TO THE WARRANTIES OF MERCHANTABILITY, FITNESS FOR A PARTICULAR PURPOSE "
        "AND NONINFRINGEMENT. IN NO EVENT SHALL THE AUTHORS OR COPYRIGHT HOLDERS BE LIABLE FOR ANY CLAIM, DAMAGES OR "
        "OTHER LIABILITY, WHETHER IN AN ACTION OF CONTRACT, TORT OR OTHERWISE, ARISING FROM, OUT OF OR IN CONNECTION "
        "WITH THE SOFTWARE OR THE USE OR OTHER DEALINGS IN THE SOFTWARE.",
    ),
    ("mit", "Licensed under the MIT License"),
    ("bsd-2-clause", _BSD_2 + _BSD_END),
    ("bsd-3-clause", _BSD_2 + _BSD_3 + _BSD_END),
    (
        "isc",
        "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby "
        "granted, provided that the above copyright notice and this permission notice appear in all copies. THE SOFTWARE "
        "IS PROVIDED \"AS IS\" AND THE AUTHOR DISCLAIMS ALL WARRANTIES WITH REGARD TO THIS SOFTWARE INCLUDING ALL IMPLIED "
        "WARRANTIES OF MERCHANTABILITY AND FITNESS. IN NO EVENT SHALL THE AUTHOR BE LIABLE FOR ANY SPECIAL, DIRECT, "
        "INDIRECT, OR CONSEQUENTIAL DAMAGES OR ANY DAMAGES WHATSOEVER RESULTING FROM LOSS OF USE, DATA OR PROFITS, "
        "WHETHER IN AN ACTION OF CONTRACT, NEGLIGENCE OR OTHER TORTIOUS ACTION, ARISING OUT OF OR IN CONNECTION WITH THE "
        "USE OR PERFORMANCE OF THIS SOFTWARE.",
    ),
    (
        "isc",
        "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby "
        "granted, provided that the above copyright notice and this permission notice appear in all copies",
    ),
    ("isc", "Licensed under the ISC License"),
    (
        "mpl-2.0",
        "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0. If a copy of the MPL was not "
        "distributed with this file, You can obtain one at http://mozilla.org/MPL/2.0/",
    ),
    (
        "mpl-1.1",
        "The contents of this file are subject to the Mozilla Public License Version 1.1 (the \"License\"); you may not "
        "use this file except in compliance with the License",
    ),
    *((f"mpl-{v}", f"Licensed under the Mozilla Public License, version {v}") for v in ("1.1", "2.0")),
    *((f"apache-{v}", f"Licensed under the Apache License, Version {v}") for v in ("1.0", "1.1")),
    *((f"gpl-{v}.0", _FREE.format("This program", ":", "General Public License", ",", v)) for v in "23"),
    *((f"lgpl-{v}", _FREE.format("This library", ";", "Lesser General Public License", ";", v)) for v in ("2.1", "3")),
    ("agpl-3.0", _FREE.format("This program", ":", "Affero General Public License", ",", "3")),
    ("gpl-2.0", "This work is licensed under the GNU General Public License, version 2"),
    *(
        (f"{label}-{v}", f"Licensed under the GNU {name}General Public License, version {v}")
        for label, name, versions in (("gpl", "", "23"), ("lgpl", "Lesser ", ("2.1", "3")), ("agpl", "Affero ", "3"))
        for v in versions
    ),
    *((f"cc-{kind}-{v}", f"Licensed under CC {kind.upper()} {v}") for kind in _CC for v in ("3.0", "4.0")),
    *(
        (f"cc-{kind}-{v}", f"licensed under a Creative Commons {name} {v} {place} License")
        for kind, name in _CC.items()
        for v, place in (("3.0", "Unported"), ("4.0", "International"))
    ),
]
# one label for a license, with or without the .0 of its version
TEMPLATES = [({"gpl-2": "gpl-2.0", "gpl-3": "gpl-3.0", "lgpl-3": "lgpl-3.0", "agpl-3": "agpl-3.0"}.get(x, x), t) for x, t in TEMPLATES]


def license_words(text: Column) -> Column:
    """Words of a text, A-Z in lower case."""
    return F.array_remove(F.split(ascii_lower(text), WORD_GAP), "")


def template_grams(spark: SparkSession, templates: list[tuple[str, str]], k: int = K) -> DataFrame:
    """(gram, template, place, n_grams): one row per k-gram of each template."""
    rows = spark.createDataFrame([(i, t) for i, (_, t) in enumerate(templates)], "template int, notice string")
    words = rows.select("template", license_words(F.col("notice")).alias("w"))
    grams = words.select("template", F.posexplode(_grams(F.col("w"), k)).alias("place", "gram"))
    return grams.withColumn("n_grams", F.count("*").over(Window.partitionBy("template")))


def _grams(words: Column, k: int) -> Column:
    """Hash of the k words from each place on; empty if there are fewer."""

    def rolled(w: Column) -> Column:
        each = F.transform(w, lambda x, i: F.xxhash64(x, *(F.get(w, i + j) for j in range(1, k))))
        return F.slice(each, 1, F.greatest(F.size(w) - (k - 1), F.lit(0)))

    return let(words, rolled)


def distinctive(notice: str) -> list[str]:
    """The version and variant words of a template; numbered clauses of a long text are none."""
    words = re.findall("[a-z0-9]+", notice.lower())
    versions = [w for w in words if w.isdigit()] if len(words) < 60 else []
    return sorted({*versions, *(w for w in words if w in VARIANTS)})


def _best(spans: Column) -> Column:
    """Without spans that overlap one with more votes (then share, then the earlier template)."""
    order = F.array_sort(
        F.transform(
            spans,
            lambda s: F.struct((-s.votes).alias("a"), (-s.share).alias("b"), s.template.alias("c"), s.start.alias("d"), s.alias("s")),
        )
    )

    def add(kept: Column, x: Column) -> Column:
        clash = F.exists(kept, lambda o: (o.start < x.s.end) & (x.s.start < o.end))
        return F.when(clash, kept).otherwise(F.array_append(kept, x.s))

    return F.aggregate(order, F.filter(spans, lambda s: F.lit(False)), add)


def license_spans(
    docs: DataFrame, templates: list[tuple[str, str]], key: list[str], text: str, k: int, min_share: float
) -> DataFrame:
    """(key..., spans): spans (template, start, end, share, votes) of each document that has any.

    Rows with equal keys must have equal texts; their hits count once.
    """
    grams = F.broadcast(template_grams(docs.sparkSession, templates, k))
    rolled = docs.select(*key, F.posexplode(_grams(license_words(text_or_empty(text)), k)).alias("at", "gram"))
    hits = rolled.join(grams, "gram").select(
        *key, "template", "n_grams", "place", "at", (F.col("at") - F.col("place")).alias("diagonal")
    )
    diagonals = hits.groupBy(*key, "template", "n_grams", "diagonal").agg(
        F.min("at").alias("start"), F.max("at").alias("last"), F.collect_set("place").alias("places")
    )
    # neighbouring diagonals that touch are one span
    order = Window.partitionBy(*key, "template").orderBy("diagonal")
    apart = F.coalesce(F.col("diagonal") - F.lag("diagonal").over(order) > NEAR_DIAGONALS, F.lit(True))
    spans = (
        diagonals.withColumn("new", apart.cast("int"))
        .withColumn("span", F.sum("new").over(order))
        .groupBy(*key, "template", "n_grams", "span")
        .agg(
            F.min("start").alias("start"),
            (F.max("last") + k).alias("end"),
            F.size(F.array_distinct(F.flatten(F.collect_list("places")))).alias("votes"),
        )
        .withColumn("share", F.col("votes") / F.col("n_grams"))
        .filter((F.col("share") >= min_share) & (F.col("end") - F.col("start") <= 2 * (F.col("n_grams") + k)))
    )
    return spans.groupBy(*key).agg(F.collect_list(F.struct("template", "start", "end", "share", "votes")).alias("spans"))


def _phrase_starts(words: Column, phrase: str) -> Column:
    """Places where the words of the phrase stand one after the other."""
    first, *rest = phrase.split(" ")

    def starts(w: Column) -> Column:
        def here(x: Column, i: Column) -> Column:
            fits = x == first
            for j, r in enumerate(rest, 1):
                fits = fits & (F.coalesce(F.get(w, i + j), F.lit("")) == r)
            return F.when(fits, i)

        return F.array_compact(F.transform(w, here))

    return let(words, starts)


def scan_licenses(
    docs: DataFrame,
    templates: list[tuple[str, str]] | None = None,
    phrases: list[tuple[str, str]] | None = None,
    k: int = K,
    min_share: float = 0.6,
    doc_id: str = "doc_id",
    text: str = "text",
) -> DataFrame:
    """One row per document: n_words, n_base, first_word, last_word, base_labels, labels, spans, score.

    ``spans`` holds the verified (label, start, end, share) in word places;
    ``score`` is the largest share of a template that a span covers, at least
    0.5 if a phrase was found, else 0.

    Null and empty texts have no words, labels or spans.  Repeated rows and
    null ids stay; rows with the same id and text get the same result.  Other
    columns, whatever their names, are not carried.  An empty table gives an
    empty result.
    """
    templates, phrases = templates or TEMPLATES, phrases or PHRASES
    t = text_or_empty(text)
    rows = docs.select(
        F.col(doc_id).alias("doc_id"), t.alias("text"), F.xxhash64(t).alias("h1"), F.xxhash64(t, F.lit("b")).alias("h2")
    )
    key = ["doc_id", "h1", "h2"]
    found = license_spans(rows, templates, key, "text", k, min_share)
    names = F.array(*(F.lit(label) for label, _ in templates))
    empty = F.array().cast("array<struct<at:int,label:string>>")
    musts = [distinctive(notice) for _, notice in templates]
    must = F.array(*(F.array(*map(F.lit, m)) if m else F.array().cast("array<string>") for m in musts))
    telling = F.array(*map(F.lit, sorted({*VARIANTS, *(w for m in musts for w in m)})))
    variants = F.array(*map(F.lit, VARIANTS))
    last_words = F.array(*(F.lit(p.split(" ")[-1]) for p, _ in phrases))

    def places(w: Column, phrase: str, label: str) -> Column:
        return F.transform(_phrase_starts(w, phrase), lambda i: F.struct(i.alias("at"), F.lit(label).alias("label")))

    def counts(w: Column) -> Column:
        each = [places(w, phrase, label) for phrase, label in phrases]
        base = F.when(F.arrays_overlap(w, last_words), F.concat(*each)).otherwise(empty)
        told = F.array_compact(
            F.transform(w, lambda x, i: F.when(F.array_contains(telling, x), F.struct(i.alias("at"), x.alias("word"))))
        )
        told = F.when(F.arrays_overlap(w, telling), told)
        return F.struct(F.size(w).cast("long").alias("n_words"), base.alias("base"), told.alias("told"))

    counted = rows.select(*key, let(license_words(F.col("text")), counts).alias("c")).select(*key, "c.*")
    joined = counted.join(found.withColumnsRenamed({c: f"__{c}" for c in key}), _same(key), "left")
    none = F.array().cast("array<struct<label:string,start:int,end:int,share:double>>")

    def fits(s: Column) -> Column:
        """The span's telling words are the template's."""
        near = F.filter("told", lambda x: (x.at >= s.start) & (x.at < s.end))
        words = F.coalesce(F.transform(near, lambda x: x.word), F.array().cast("array<string>"))
        own = must[s.template]
        return let(
            words,
            lambda w: (F.size(F.array_except(own, w)) == 0)
            & (F.size(F.array_except(F.array_intersect(w, variants), own)) == 0),
        )

    named = F.transform(
        F.array_sort(let(F.filter("spans", fits), _best)),
        lambda s: F.struct(
            names[s.template].alias("label"), s.start.alias("start"), s.end.alias("end"), s.share.alias("share")
        ),
    )
    joined = joined.withColumn("spans", F.coalesce(named, none))
    labels = F.array_sort(F.array_distinct(F.col("base.label")))
    both = F.array_sort(F.array_distinct(F.concat(F.col("base.label"), F.col("spans.label"))))
    best = F.coalesce(F.array_max(F.col("spans.share")), F.lit(0.0))
    return joined.select(
        "doc_id",
        "n_words",
        F.size("base").cast("long").alias("n_base"),
        F.array_min(F.col("base.at")).cast("long").alias("first_word"),
        F.array_max(F.col("base.at")).cast("long").alias("last_word"),
        F.array_join(labels, ",").alias("base_labels"),
        F.array_join(both, ",").alias("labels"),
        F.greatest(best, F.when(F.size("base") > 0, 0.5).otherwise(0.0)).alias("score"),
        "spans",
    )


def _same(key: list[str]) -> Column:
    same = F.lit(True)
    for c in key:
        same = same & F.col(c).eqNullSafe(F.col(f"__{c}"))
    return same

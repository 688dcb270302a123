"""Blank-delimited term matching expressed as Spark column expressions.

A term is mentioned by a text when ``" " + text + " "`` contains
``" " + term + " "``: case-sensitive, delimited by single blanks only (tabs,
newlines and punctuation are part of a word), body text only.

Equivalent token form used for many terms at once: split the text on every
blank (keeping empty tokens); a term of ``m`` blank-separated words is
mentioned exactly when its ``m`` words occur as ``m`` consecutive tokens.
"""

from __future__ import annotations

from collections.abc import Callable, Iterable, Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

BLANK = " "


def as_col(c: str | Column) -> Column:
    return F.col(c) if isinstance(c, str) else c


def term_width(term: str) -> int:
    """Number of blank-separated words (empty words count)."""
    return len(term.split(BLANK))


def mentions_term(text: str | Column, term: str) -> Column:
    """True iff the padded text contains the padded term; null text -> false."""
    padded = F.concat(F.lit(BLANK), as_col(text), F.lit(BLANK))
    return F.coalesce(padded.contains(BLANK + term + BLANK), F.lit(False))


def tokens(text: str | Column) -> Column:
    """Split on every blank, keeping empty tokens (Java ``split(" ", -1)``)."""
    return F.split(as_col(text), BLANK, -1)


def shingles(toks: Column, width: int) -> Column:
    """All runs of ``width`` consecutive tokens, joined by one blank."""
    if width == 1:
        return toks
    n = F.size(toks) - (width - 1)
    runs = F.transform(
        F.sequence(F.lit(1), n), lambda i: F.array_join(F.slice(toks, i, width), BLANK)
    )
    return F.when(n > 0, runs).otherwise(F.array().cast("array<string>"))


def with_tokens(text: str | Column, widths: Iterable[int], body: Callable[[Column], Column]) -> Column:
    """``body`` of a text's tokens, split once.

    Runs of several words read the tokens inside a lambda, where a plain
    expression would be computed again for every run; a lambda's argument is not.
    """
    toks = tokens(text)
    if all(w == 1 for w in widths):
        return body(toks)
    return F.get(F.transform(F.array(toks), body), F.lit(0))


def matched_terms(text: str | Column, terms: Iterable[str]) -> Column:
    """Distinct terms of ``terms`` mentioned by ``text`` (array<string>).

    One split per row and a hash-set intersection per term width; the term
    list is inlined as a literal, so it must be short (the caller checks).
    """
    by_width: dict[int, list[str]] = {}
    for t in dict.fromkeys(terms):
        by_width.setdefault(term_width(t), []).append(t)
    if not by_width:
        return F.array().cast("array<string>")

    def found(toks: Column) -> Column:
        parts = [
            F.array_intersect(shingles(toks, w), F.array(*[F.lit(t) for t in ts]))
            for w, ts in sorted(by_width.items())
        ]
        return parts[0] if len(parts) == 1 else F.concat(*parts)

    return with_tokens(text, by_width, found)


def literal_map(pairs: Sequence[tuple[object, object]]) -> Column:
    """A map literal built from (key, value) pairs."""
    args: list[Column] = []
    for k, v in pairs:
        args.extend([F.lit(k), v if isinstance(v, Column) else F.lit(v)])
    return F.create_map(*args)

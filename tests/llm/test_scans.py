"""Secret scan, license scan, quality rules and URL filter against brute force."""

from __future__ import annotations

import hashlib
import random
import re
import string
from collections import Counter

import pytest
from pyspark.sql import functions as F

from tessera.llm import licenses as C
from tessera.llm import quality as Q
from tessera.llm import secrets as S
from tessera.llm.url_filter import filter_urls, match_rules
from tests.conftest import has_python_node, plan_text
from tests.llm import helpers as H


def order(rows):
    return sorted(rows, key=lambda r: tuple((v is not None, str(v)) for v in r))


# --------------------------------------------------------------- secrets ----

ASSIGN = re.compile(
    "(?:" + "|".join("".join(f"[{c}{c.upper()}]" if c.isalpha() else c for c in w)
                     for w in ("password", "passwd", "secret", "token", "api_?key"))
    + ")[\"']?\x20*[:=]\x20*[\"']?([A-Za-z0-9+/_.=-]+)"
)


def base_spans(text):
    s = text or ""
    spans = [(m.start(), 0, "assign", m.end()) for m in ASSIGN.finditer(s) if len(m[1]) >= 6]
    spans += [(m.start(), 1, "access", m.end()) for m in re.finditer("AKIA[A-Z0-9]+", s) if len(m[0]) >= 20]
    spans += [(m.start(), 2, "hex", m.end()) for m in re.finditer("[0-9a-f]+", s) if len(m[0]) >= 24]
    return sorted(spans)


def drawn_secrets(seed, n=150):
    rnd = random.Random(seed)
    bits = ["password", "Token", "API_KEY", "apikey", "=", ":", " ", '"', "'", "😀", "é", "AKIA", "abc", "\n", "passwd=", "secret: "]
    tail = [string.hexdigits[:16], string.ascii_uppercase + string.digits, string.ascii_letters + "+/=.-_"]
    texts = []
    for _ in range(n):
        parts = [rnd.choice(bits) if rnd.random() < 0.6 else "".join(rnd.choices(rnd.choice(tail), k=rnd.randrange(1, 45)))
                 for _ in range(rnd.randrange(25))]
        texts.append("".join(parts))
    return texts + ["password=token:abcdefgh", "AKIAAKIA" + "B" * 20, "a" * 23, "f" * 24, "token=abcdef " * 700]


def test_pattern_spans(spark):
    docs = H.documents(spark, drawn_secrets(1)).unionByName(H.awkward(spark))
    found = S.find_secrets(docs, limits={})
    assert found.columns == [c for c in docs.columns if c != "spans"] + ["spans"]
    for r in found.select("text", "spans").collect():
        assert [(s.at, s.order, s.kind, s.end) for s in r.spans] == base_spans(r.text)
    assert not has_python_node(plan_text(S.find_secrets(spark.read.parquet("/root/testdata/sf0.001/documents.parquet"))))


def test_random_tokens_are_found_and_words_are_not(spark):
    rnd = random.Random(2)
    keys = ["".join(rnd.choices(string.ascii_letters + string.digits, k=rnd.choice([24, 32, 40, 64]))) for _ in range(200)]
    others = ["treauxenmentelletionenouquela", "A" * 40, "abcdefghijklmnopqrstuvwxyz0123456789",
              "someVeryLongCamelCaseIdentifierName", "a_very_long_snake_case_identifier", "2024-01-01T00-00-00_2025-01-01"]
    texts = [f"see {k} here" for k in keys] + [f"see {o} here" for o in others * 30]
    rows = S.find_secrets(H.documents(spark, texts)).select("doc_id", "spans").orderBy("doc_id").collect()
    hits = [[s for s in r.spans if s.kind == "random"] for r in rows]
    assert sum(bool(h) for h in hits[:200]) >= 190
    assert not any(hits[200:])
    assert all((h[0].at, h[0].end) == (4, 4 + len(k)) for h, k in zip(hits, keys) if h)


def test_random_spans_leave_pattern_spans_alone(spark):
    key = "aB3dE5gH7jK9mN1pQ3sT5vW7yZ9bC1dF3"
    docs = H.documents(spark, [f"token={key} and {key}x" for _ in range(20)])
    for r in S.find_secrets(docs, limits={i: 0.0 for i in range(6)}).select("text", "spans").collect():
        assert [(s.at, s.order, s.kind, s.end) for s in r.spans if s.kind != "random"] == base_spans(r.text)
        assert [s.kind for s in r.spans] == ["assign", "random"]


def test_false_discovery_limit_counts_all_candidates(spark):
    word = "ordinarylettersonlyhere"
    few = S.discovery_limits(H.documents(spark, ["x9K2mQ7vL4pR8tW3nB6z" + "Zq1"] * 5))
    many = S.discovery_limits(H.documents(spark, ["x9K2mQ7vL4pR8tW3nB6z" + "Zq1"] * 5 + [word] * 4000))
    assert list(few) == [0] and many.get(0, 99) >= few[0]
    assert S.discovery_limits(H.documents(spark, [word] * 10)) == {}
    assert S.discovery_limits(H.empty(spark)) == {}


def test_secrets_of_every_encoding_are_found(spark):
    rnd = random.Random(6)
    alphabets = {"hex": "0123456789abcdef", "HEX": "0123456789ABCDEF", "BASE32": S.BASE32, "base32": S.BASE32.lower(),
                 "BASE36": S.BASE36.upper(), "base36": S.BASE36, "base62": string.ascii_letters + string.digits,
                 "base64": string.ascii_letters + string.digits + "+/"}
    cases = [(e, n) for e in alphabets for n in (20, 32, 40, 64)]
    texts, of = [], []
    for e, n in cases:
        texts += [f"see {''.join(rnd.choices(alphabets[e], k=n))} here" for _ in range(60)]
        of += [(e, n)] * 60
    words = ["someVeryLongCamelCaseIdentifierName", "internationalizationcommittee", "december2019newsletters",
             "images/2019/05/photo-12345", "AVERYLONGCONSTANTNAME2"]
    docs = H.documents(spark, texts + [f"see {w} here" for w in words * 20])
    rows = S.find_secrets(docs).select("doc_id", "spans").orderBy("doc_id").collect()
    found = Counter(c for r, c in zip(rows, of) if any((s.at, s.end) == (4, 4 + c[1]) for s in r.spans))
    assert not any(r.spans for r in rows[len(of):])
    assert min(found[c] for c in cases) >= 51, found


def test_redaction(spark):
    texts = ["é password=abcdef1 and AKIA" + "Z" * 16 + " end", "token=" + "a1" * 20, None, "plain"]
    docs = S.find_secrets(H.documents(spark, texts), limits={})
    out = docs.orderBy("doc_id").select(S.redact(F.coalesce("text", F.lit("")), F.col("spans")).alias("t"))
    assert [r.t for r in out.collect()] == ["é [REDACTED] and [REDACTED] end", "[REDACTED]", "", "plain"]
    spans = docs.select(S.spans_text(F.col("spans")).alias("t")).first().t
    assert hashlib.sha256(spans.encode()) and spans == "assign:2:18,access:23:43"


# -------------------------------------------------------------- licenses ----

WORD = re.compile("[^\x00-\x2f\x3a-\x60\x7b-\x7f]+")


def base_labels(text):
    w = WORD.findall((text or "").translate(H.LOWER))
    places = []
    for phrase, label in C.PHRASES:
        p = phrase.split()
        places += [(i, label) for i in range(len(w) - len(p) + 1) if w[i : i + len(p)] == p]
    at = [i for i, _ in places]
    return len(w), len(places), min(at, default=None), max(at, default=None), ",".join(sorted({x for _, x in places}))


def test_license_scan(spark):
    rnd = random.Random(1)
    bits = ["MIT", "license", "License,", "apache", "General", "Public", "LICENSE", "gpl", "é", "中文", "x9", "\n", "mit-license"]
    texts = [" ".join(rnd.choices(bits, k=rnd.randrange(20))) for _ in range(120)]
    docs = H.documents(spark, texts).unionByName(H.awkward(spark))
    rows = C.scan_licenses(docs).collect()
    expected = [(r.doc_id, *base_labels(r.text)) for r in docs.collect()]
    assert order((r.doc_id, r.n_words, r.n_base, r.first_word, r.last_word, r.base_labels) for r in rows) == order(expected)
    for r in rows:
        assert set(filter(None, r.base_labels.split(","))) <= set(r.labels.split(",")) and 0 <= r.score <= 1


def test_license_spans_survive_small_edits(spark):
    notice = C.TEMPLATES[1][1]
    w = notice.split()
    edited = " ".join(w[:8] + ["really"] + w[8:14] + w[15:])
    texts = [f"one two three {notice} four", f"one {edited} two", " ".join(w[:6]), "This program is free", f"{notice} x {notice}"]
    rows = C.scan_licenses(H.documents(spark, texts)).orderBy("doc_id").collect()
    assert [r.labels for r in rows] == ["mit", "mit", "", "", "mit"]
    assert (rows[0].spans[0].start, rows[0].spans[0].end, rows[0].score) == (3, 3 + len(w), 1.0)
    assert 0.6 <= rows[1].score < 1 and rows[2].score == 0 and len(rows[4].spans) == 2


def test_notices_beside_the_given_lines(spark):
    cases = [
        ("Licensed under CC BY 4.0", "cc-by-4.0"),
        ("Licensed under CC BY-SA 4.0", "cc-by-sa-4.0"),
        ("Licensed under CC BY-NC 4.0", "cc-by-nc-4.0"),
        ("This work is licensed under a Creative Commons Attribution-ShareAlike 4.0 International License.", "cc-by-sa-4.0"),
        ("This work is licensed under a Creative Commons Attribution 4.0 International License.", "cc-by-4.0"),
        ("This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0. If a copy of the MPL was not "
         "distributed with this file, You can obtain one at https://mozilla.org/MPL/2.0/.", "mpl-2.0"),
        ("Licensed under the Apache License, Version 1.1", "apache-1.1"),
        ("This work is licensed under the GNU General Public License, version 2", "gpl-2.0"),
        ("This work is licensed under the GNU Lesser General Public License, version 3", "lgpl-3.0"),
        ("This library is free software; you can redistribute it and/or modify it under the terms of the GNU Lesser General "
         "Public License as published by the Free Software Foundation; either version 2.1 of the License", "lgpl-2.1"),
        ("This program is free software: you can redistribute it and/or modify it under the terms of the GNU Affero General "
         "Public License as published by the Free Software Foundation, either version 3 of the License", "agpl-3.0"),
        ("Licensed under the ISC License", "isc"),
        (C._BSD_2 + C._BSD_3 + C._BSD_END, "bsd-3-clause"),
        (C._BSD_2 + C._BSD_END, "bsd-2-clause"),
    ]
    rows = C.scan_licenses(H.documents(spark, [f"one two {t} three" for t, _ in cases])).orderBy("doc_id").collect()
    assert [sorted({s.label for s in r.spans}) for r in rows] == [[label] for _, label in cases]


def test_license_scan_is_native_and_shuffles_hits_only(spark):
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    plan = plan_text(C.scan_licenses(docs))
    assert not has_python_node(plan) and "BroadcastHashJoin" in plan


# --------------------------------------------------------------- quality ----


def measures(text):
    w = H.words(text)
    windows = Counter(zip(w, w[1:], w[2:]))
    covered = {j for i in range(len(w) - 2) if windows[tuple(w[i : i + 3])] > 1 for j in (i, i + 1, i + 2)}
    seen, dup = set(), 0
    for line in (text or "").split("\n"):
        if H.SPACE_WORD.search(line):
            dup += line in seen
            seen.add(line)
    return len(w), sum(map(len, w)), sum(c in "#*$%&|<>" for c in text or ""), dup, len(covered)


def test_measures(spark):
    rnd = random.Random(3)
    bits = ["the", "of", "a", "ça", "#x", "<b>", "|", "$&", "\n", "\t", "word", "😀"]
    texts = [" ".join(rnd.choices(bits[: rnd.randrange(2, 13)], k=rnd.randrange(150))) for _ in range(150)]
    texts += [" ".join(f"w{i}" for i in range(300)) * 2, "a b " * 500]
    docs = H.documents(spark, texts).unionByName(H.awkward(spark))
    rows = Q.judge(docs).collect()
    expected = []
    for r in docs.collect():
        m = measures(r.text)
        expected.append((r.doc_id, *m, m[0] < 50 or 100 * m[4] > 50 * m[0]))
    assert order((r.doc_id, *(r[c] for c in Q.MEASURES), r.base_failed) for r in rows) == order(expected)
    assert not any(r.kept and r.base_failed for r in rows)
    assert not has_python_node(plan_text(Q.judge(spark.read.parquet("/root/testdata/sf0.001/documents.parquet"))))


def prose(rnd, lang, n):
    common = Q.COMMON_WORDS[lang]
    return " ".join(rnd.choice(common[:12]) if rnd.random() < 0.3 else "".join(rnd.choices("aeinrstlo", k=7)) for _ in range(n))


def test_divergent_documents_go_and_clean_ones_stay(spark):
    rnd = random.Random(4)
    langs = [rnd.choice(["en", "de", "fr"]) for _ in range(200)]
    texts = [prose(rnd, x, 300) for x in langs]
    bad = [prose(rnd, "en", 300).upper(), " ".join("%$#" + str(i) for i in range(300)), prose(rnd, "es", 300)]
    short = ["XQ " * 2 + "ZV " * 40 + " ".join(f"Q{i}" for i in range(20))]
    docs = H.documents(spark, texts + bad + short + [prose(rnd, "en", 300)], langs + ["en"] * 4 + [None])
    kept = [r.kept for r in Q.judge(docs, Q.QualityRules(min_chars=500)).orderBy("doc_id").collect()]
    assert all(kept[:200])
    assert not any(kept[200:203])
    assert kept[204]  # without a language, classes are compared with the whole corpus


def test_rare_languages_use_the_whole_corpus(spark):
    docs = H.documents(spark, ["some words of text here"] * 300, ["en"] * 290 + [f"l{i}" for i in range(8)] + [None] * 2)
    refs = {r.lang: r for r in Q.language_references(docs, Q.QualityRules()).collect()}
    assert set(refs) == {None, "en"}
    assert sum(refs[None].classes) == 300 * 23 and sum(refs["en"].classes) == 290 * 23
    assert sum(refs["en"].words) == 290 * 5


@pytest.mark.parametrize("others", [880, 1200])  # 1.1 % and 0.8 % of the rows
def test_rare_languages_have_their_own_reference(spark, others, monkeypatch):
    rnd = random.Random(7)
    russian = [" ".join("".join(rnd.choices("оеаинтсрвлкм", k=6)) for _ in range(150)) + "." for _ in range(9)]
    odd = [" ".join("%$#" + str(i) for i in range(300)), prose(rnd, "es", 300)]
    german = [prose(rnd, "de", 300) for _ in range(6)]
    mixed = [*german, odd[0], odd[1], *russian, russian[0], *[prose(rnd, "en", 200)] * others]
    langs = ["de"] * 8 + ["ru"] * 9 + [None] + ["en"] * others
    docs = H.documents(spark, mixed, langs)
    for most in (1000, 1):  # by broadcast, and by language
        monkeypatch.setattr(Q, "MOST_BROADCAST", most)
        rows = Q.judge(docs, Q.QualityRules(max_repeat_percent=100)).orderBy("doc_id").collect()
        assert len(rows) == len(langs)
        assert all(r.kept for r in rows[:6] + rows[8:18]) and not any(r.kept for r in rows[6:8])
        assert rows[7].word_distance > 0.3 and rows[8].class_distance < 0.1 and rows[17].class_distance is None


def test_distance():
    # by hand: disjoint histograms are 1 apart, equal ones 0
    import math

    def js(p, q):
        p, q = [x / sum(p) for x in p], [x / sum(q) for x in q]
        m = [(a + b) / 2 for a, b in zip(p, q)]
        part = lambda r: sum(a * math.log2(a / c) for a, c in zip(r, m) if a)
        return math.sqrt((part(p) + part(q)) / 2)

    assert js([1, 0], [0, 1]) == 1 and js([2, 6], [1, 3]) == 0


@pytest.mark.parametrize("p,q,expected", [([1, 0], [0, 1], 1.0), ([2, 6], [1, 3], 0.0), ([0, 0], [1, 3], None), ([], [], None),
                                          ([3, 1], [1, 3], 0.43443)])
def test_distance_in_spark(spark, p, q, expected):
    df = spark.createDataFrame([(p, q)], "p array<long>, q array<long>")
    found = df.select(Q.distance(F.col("p"), F.col("q")).alias("d")).first().d
    assert found == expected if expected is None else abs(found - expected) < 1e-4


# ------------------------------------------------------------------- urls ----

RULES = [("com", "/", "allow"), ("example.com", "/en/", "block"), ("www.example.com", "/en/", "allow"),
         ("net", "/es/", "block"), ("Example.ORG", "", "block"), ("a.example.org", "/x", "allow"), ("example.org", "/x/y", "block")]


def verdict(url):
    rest = url.split("://", 1)[1] if url and "://" in url else ""
    host = re.match("[^/?#]*", rest)[0]
    path = re.match("[^?#]*", rest[len(host):])[0]
    host = host.translate(H.LOWER)
    fits = [(len(h) + len(p), len(h), v == "block", h.lower() + p, v) for h, p, v in RULES
            if (host == h.lower() or host.endswith("." + h.lower())) and path.startswith(p)]
    best = max(fits, default=None)
    return host, path, best[3] if best else None, best[4] if best else "allow"


def urls():
    rnd = random.Random(5)
    hosts = ["x.com", "com", "example.com", "WWW.Example.com", "a.www.example.com", "notexample.com", "b.net", "example.org",
             "a.example.org", "b.a.example.org:80", "user@example.org", "", "..", ".com"]
    paths = ["", "/", "/en", "/en/", "/en/a/b", "/es/1", "/x", "/x/y/z", "/xy", "//en/", "?q=/en/", "#f", "/en/?a#b"]
    made = [f"{rnd.choice(['http', 'https', ''])}://{rnd.choice(hosts)}{rnd.choice(paths)}" for _ in range(300)]
    return made + [None, "", "no scheme", "a://b://c/en/", "http://" + "l." * 3000 + "com/" + "p/" * 3000]


def test_url_filter(spark):
    pages = spark.createDataFrame([(i, u, "x", 1) for i, u in enumerate(urls())], "page_id long, url string, rule string, host int")
    pages = pages.unionByName(pages.filter("page_id < 40")).unionByName(pages.limit(3).withColumn("page_id", F.lit(None).cast("long")))
    rules = spark.createDataFrame(RULES, "host string, path string, verdict string")
    found = filter_urls(pages, rules)
    assert found.columns == ["page_id", "url", "host", "path", "rule", "verdict"]
    rows = [(r.page_id, r.host, r.path, r.rule, r.verdict) for r in found.collect()]
    assert order(rows) == order((r.page_id, *verdict(r.url)) for r in pages.collect())


def test_url_filter_without_rows_or_rules(spark):
    pages = spark.createDataFrame([(1, "http://a.com/")], "page_id long, url string")
    rules = spark.createDataFrame(RULES, "host string, path string, verdict string")
    assert filter_urls(pages.limit(0), rules).collect() == []
    assert filter_urls(pages, rules.limit(0), default="block").first().verdict == "block"
    assert match_rules(spark.createDataFrame([("com", "")], "host string, path string"), rules).collect() == []


def test_empty_tables(spark):
    none = H.empty(spark)
    assert S.find_secrets(none).collect() == []
    assert C.scan_licenses(none).collect() == []
    assert Q.judge(none).collect() == []

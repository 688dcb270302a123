"""The pipeline and the registered queries on a small table."""

from __future__ import annotations

import hashlib
import math
import re
import subprocess
import sys
import zlib

import duckdb
import numpy as np
import pytest

import __spark_entry__ as E
import corpus_pipeline
from tessera.llm import quality as Q
from tessera.llm.catalog import ORACLE, QUERIES
from tests.conftest import SF_SMALL
from tests.llm import helpers as H
from tests.llm.test_bytebpe import TIKTOKEN, TOKENIZER
from tests.llm.test_dedup import expected_groups, expected_lines
from tests.llm.test_scans import base_labels, base_spans, measures

ROOT = E._HERE


@pytest.fixture(scope="module")
def documents():
    con = duckdb.connect()
    return con.sql(f"SELECT doc_id, text, lang FROM '{SF_SMALL}/documents.parquet' ORDER BY doc_id").fetchall()


def kept_by_quality(docs):
    """Ids that the quality rules keep, by hand."""
    rules = Q.QualityRules()
    classes = ["a-z", "A-Z", "0-9", "\\x09-\\x0D\\x20", ".,;:!?'\"()-", "#*$%&|<>@^~`_=+/\\\\{}\\[\\]"]

    def class_counts(t):
        counts = [len(re.findall(f"[{c}]", t.replace("-", "\x1f") if "-" in c and c[0] == "#" else t)) for c in classes]
        return [*counts, len(t) - sum(counts)]

    def word_counts(t, lang):
        common = rules.common_words.get(lang)
        if not common:
            return []
        w = [x.lower() for x in H.words(t)]
        return [*(w.count(c) for c in common), sum(x not in common for x in w)]

    def js(p, q):
        if not sum(p) or not sum(q):
            return 0.0
        p, q = [x / sum(p) for x in p], [x / sum(q) for x in q]
        terms = [(a, b, (a + b) / 2) for a, b in zip(p, q)]
        part = sum((a * math.log2(a / m) if a else 0) + (b * math.log2(b / m) if b else 0) for a, b, m in terms)
        return math.sqrt(max(0.0, part / 2))

    refs = {}
    for _, t, lang in docs:
        for at, counts in ((0, class_counts(t)), (1, word_counts(t, lang))):
            held = refs.setdefault((lang, at), [0] * len(counts))
            refs[lang, at] = [a + b for a, b in zip(held, counts)]
    keep = set()
    for i, t, lang in docs:
        m = measures(t)
        far = (len(t) >= rules.min_chars and js(class_counts(t), refs[lang, 0]) > rules.max_class_distance) or (
            m[0] >= rules.min_histogram_words and js(word_counts(t, lang), refs[lang, 1]) > rules.max_word_distance
        )
        if m[0] >= 50 and 100 * m[4] <= 50 * m[0] and not far:
            keep.add(i)
    return keep


def redacted(text):
    out, at = [], 0
    for start, _, _, end in base_spans(text):
        if end > at:
            out += [text[at:start], "[REDACTED]"] if start >= at else []
            at = end
    return "".join(out) + text[at:]


def test_pipeline_equals_brute_force(spark, documents):
    kept = kept_by_quality(documents)
    assert 0 < len(kept) < len(documents)
    rows = [(i, t) for i, t, _ in documents if i in kept]
    rows = [(i, t) for i, t, _, _ in expected_lines(rows, 20, 3)]
    roots = H.components(rows, 5, 80)
    rows = [(i, t) for (i, t), root in zip(rows, roots) if i == root or not H.words(t)]
    texts = {i: redacted(t) for i, t in rows}
    found = {}
    for r in corpus_pipeline.run(spark, SF_SMALL).collect():
        found.setdefault(r.doc_id, []).append((r.start, np.frombuffer(r.ids, "<u4").tolist(), r.doc_tokens))
    expected = {i: TOKENIZER.encode(t, add_special_tokens=False).ids + [1] for i, t in texts.items()}
    assert {i: [x for _, ids, _ in sorted(p) for x in ids] for i, p in found.items()} == expected
    assert all(n == len(expected[i]) for i, p in found.items() for _, _, n in p)


def test_stages_keep_the_columns_of_documents(spark):
    docs = spark.read.parquet(f"{SF_SMALL}/documents.parquet")
    for name, stage in corpus_pipeline.STAGES[:-1]:
        out = stage(spark, docs, SF_SMALL)
        assert out.schema.simpleString() == docs.schema.simpleString(), name
    assert [n for n, _ in corpus_pipeline.STAGES] == [
        "quality_rules", "line_dedup", "near_duplicates", "secret_scan", "packing"
    ]


def test_stages_take_awkward_tables(spark):
    for docs in (H.awkward(spark), H.empty(spark)):
        for _, stage in corpus_pipeline.STAGES:
            stage(spark, docs, SF_SMALL).collect()


@pytest.mark.parametrize("name", sorted(ORACLE))
def test_query_equals_its_sql(spark, name):
    con = duckdb.connect()
    for t in ("documents", "embeddings", "pages"):
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{SF_SMALL}/{t}.parquet'")
    sql = con.sql(ORACLE[name])
    out = QUERIES[name](spark, SF_SMALL)
    assert sorted(out.columns) == sorted(sql.columns)
    rows = [tuple(r[c] for c in sql.columns) for r in out.collect()]
    assert sorted(rows, key=repr) == sorted(sql.fetchall(), key=repr)


def by_id(spark, name):
    return {r.doc_id: r for r in E.queries()[name](spark, SF_SMALL).collect()}


def test_op1(spark, documents):
    rows = by_id(spark, "op1_secret_scan")
    assert len(rows) == len(documents)
    for i, t, _ in documents:
        spans = base_spans(t)
        text = ",".join(f"{k}:{a}:{b}" for a, _, k, b in spans)
        kinds = [k for _, _, k, _ in spans]
        r = rows[i]
        assert [r.n_assign, r.n_access, r.n_hex] == [kinds.count(k) for k in ("assign", "access", "hex")]
        assert r.base_sha256 == hashlib.sha256(text.encode()).hexdigest()
        assert set(filter(None, text.split(","))) <= set(r.spans.split(","))


def test_op2(spark, documents):
    rows = by_id(spark, "op2_exact_dedup")
    assert sorted((r.doc_id, r.keep_id, r.group_size) for r in rows.values()) == sorted(
        expected_groups([(i, t) for i, t, _ in documents])
    )


def test_op3(spark, documents):
    pieces = {}
    for r in E.queries()["op3_packing"](spark, SF_SMALL).collect():
        pieces.setdefault(r.doc_id, []).append(r)
    for i, t, _ in documents:
        ids = TOKENIZER.encode(t, add_special_tokens=False).ids + [1]
        at = 0
        for p in sorted(pieces[i], key=lambda p: p.start):
            raw = np.array(ids[at : at + p.length], "<u4").tobytes()
            assert (p.start, p.doc_tokens, p.ids_crc32) == (at, len(ids), zlib.crc32(raw))
            at += p.length
        assert at == len(ids)


def test_op4_and_op9(spark, documents):
    counts, codes = by_id(spark, "op4_token_counts"), by_id(spark, "op9_bpe_codec")
    for i, t, _ in documents:
        n = len(TOKENIZER.encode(t, add_special_tokens=False).ids)
        assert tuple(counts[i]) == (i, len(t.encode()), n, n > 1024)
        ids = TIKTOKEN.encode_ordinary(t)
        digests = (hashlib.sha256(x).hexdigest() for x in (",".join(map(str, ids)).encode(), t.encode()))
        assert tuple(codes[i]) == (i, len(ids), *digests)


def test_op5_op6_op7(spark, documents):
    near, licences, quality = (by_id(spark, n) for n in ("op5_ngram_jaccard", "op6_license_scan", "op7_quality_rules"))
    rows, kept = [(i, t) for i, t, _ in documents], kept_by_quality(documents)
    for (i, t), root in zip(rows, H.components(rows, 4, 85)):
        assert tuple(near[i]) == (i, len(H.shingles(t, 4)), root)
        r = licences[i]
        assert (r.n_words, r.n_base, r.first_word, r.last_word, r.base_labels) == base_labels(t)
        q = quality[i]
        assert tuple(q[c] for c in Q.MEASURES) == measures(t) and q.kept == (i in kept)


def test_every_dealt_query_is_registered():
    names = [n for n in E.queries() if re.match(r"op\d+_", n)]
    assert sorted(int(n[2:].split("_")[0]) for n in names) == list(range(1, 14)) and "pipeline" in E.queries()


def test_entry_works_without_the_subpackage():
    code = (
        "import sys\n"
        "class Block:\n"
        "    def find_spec(self, name, path=None, target=None):\n"
        "        if name == 'corpus_pipeline' or name.startswith('tessera.llm'):\n"
        "            raise ModuleNotFoundError(name, name=name)\n"
        "sys.meta_path.insert(0, Block())\n"
        "import __spark_entry__ as e\n"
        "assert len(e.queries()) > 50 and not any(n.startswith('op') for n in e.queries())\n"
    )
    subprocess.run([sys.executable, "-c", code], cwd=ROOT, check=True, timeout=120)

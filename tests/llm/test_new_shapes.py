"""Fill-in-middle, vector codes and mixing against plain Python."""

from __future__ import annotations

import hashlib
import math
import random
import re
from collections import Counter, defaultdict
from fractions import Fraction

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from tessera.llm import common
from tessera.llm import infill as I
from tessera.llm import mixing as M
from tessera.llm import vector_codes as V
from tests.llm.helpers import DOC_SCHEMA, awkward, doc_rows, documents, empty, words

TOKEN = re.compile("[\x20\x09-\x0d]*[^\x20\x09-\x0d]+|[\x20\x09-\x0d]+")


def rough(seed, n):
    """Texts of few kinds of characters, many of them white space or of several bytes."""
    r = random.Random(seed)
    letters = "ab \t\n\x0b\x0c\r\x08\x0e\x1f!\x7f\x80é 中😀<P>S"
    return ["".join(r.choice(letters) for _ in range(r.choice((0, 1, 3, 7, 8, 9, 16, 40, 200)))) for _ in range(n)]


# ---------------------------------------------------------- fill in middle ----


def test_masks_of_every_byte():
    data = bytes(range(256))
    found = I.space_mask(np.frombuffer(data, np.uint64)).view(np.uint8)
    assert [b for b in data if found[b]] == [9, 10, 11, 12, 13, 32]
    found = I.lead_mask(np.frombuffer(data, np.uint64)).view(np.uint8)
    assert [b for b in data if not found[b]] == list(range(0x80, 0xC0))


def test_masks_do_not_leak_between_bytes():
    raw = np.random.default_rng(1).choice([0x00, 0x08, 0x09, 0x0D, 0x0E, 0x20, 0x21, 0x7F, 0x80, 0x89, 0xA0, 0xFF], 8000)
    raw = raw.astype(np.uint8)
    found = I.space_mask(raw.view(np.uint64)).view(np.uint8)
    assert (found == np.where((raw == 32) | ((raw >= 9) & (raw <= 13)), 0x80, 0)).all()


def test_select_in_word():
    for bits in range(1, 256):
        marks = sum(0x80 << 8 * i for i in range(8) if bits >> i & 1)
        places = [i for i in range(8) if bits >> i & 1]
        found = I.select_byte(np.full(len(places), marks, np.uint64), np.arange(1, len(places) + 1))
        assert found.tolist() == places


def test_units_cut_anywhere():
    texts = rough(2, 300)
    units = I.Units(pa.array([*texts, None]))
    assert units.n.tolist() == [len(TOKEN.findall(t)) for t in texts] + [0]
    for share in (0.0, 0.3, 0.8, 1.0):
        k = (units.n * share).astype(np.int64)
        found = units.chars(units.cut(k)).tolist()
        assert found == [len("".join(TOKEN.findall(t)[:n])) for t, n in zip([*texts, ""], k.tolist())]


def filled(doc_id, text, percent=50, spm=80):
    t = text or ""
    u = TOKEN.findall(t)
    h = hashlib.sha256(f"42:{'' if doc_id is None else doc_id}".encode()).hexdigest()
    h1, h2, h3, h4 = (int(h[8 * i : 8 * i + 8], 16) for i in range(4))
    a, b = sorted((h1 % (len(u) + 1), h2 % (len(u) + 1)))
    p, m, s = "".join(u[:a]), "".join(u[a:b]), "".join(u[b:])
    if t == "" or any(x in t for x in I.SENTINELS) or h3 % 100 >= percent:
        return doc_id, len(u), "plain", None, None, t
    if h4 % 100 < spm:
        return doc_id, len(u), "spm", len(p), len(m), f"<S>{s}<P>{p}<M>{m}"
    return doc_id, len(u), "psm", len(p), len(m), f"<P>{p}<S>{s}<M>{m}"


def test_fill_in_middle(spark):
    docs = documents(spark, [*rough(3, 400), "w " * 300_000, "<" * 50 + " P> S> <", "a<M>b", " "]).unionByName(awkward(spark))
    docs = docs.withColumns({"output": F.lit(1), "form": F.lit(2), "cut": F.lit("mine"), "digest": F.lit("too")})
    out = I.fill_in_middle(docs)
    assert set(out.columns) == {*docs.columns, "n", "prefix_chars", "middle_chars"}
    names = ("doc_id", "n", "form", "prefix_chars", "middle_chars", "output")
    rows = out.withColumn("back", I.restore(F.col("output"), F.col("form"))).collect()
    expected = [filled(r.doc_id, r.text) for r in docs.select("doc_id", "text").collect()]
    assert Counter(tuple(r[c] for c in names) for r in rows) == Counter(expected)
    assert all(r.back == (r.text or "") and r.cut == "mine" and r.digest == "too" for r in rows)
    assert {r.form for r in rows} == {"plain", "spm", "psm"}


def test_fill_in_middle_options(spark):
    docs = documents(spark, rough(4, 100))
    out = I.fill_in_middle(docs, percent=100, spm_percent=0).select("doc_id", "n", "form", "prefix_chars", "middle_chars", "output")
    expected = [filled(r.doc_id, r.text, 100, 0) for r in docs.collect()]
    assert Counter(map(tuple, out.collect())) == Counter(expected)
    assert I.fill_in_middle(empty(spark)).count() == 0


# ------------------------------------------------------------ vector codes ----


def sign_changes(row):
    return sum(a != b for a, b in zip(row, row[1:]))


@pytest.mark.parametrize("width", [1, 2, 3, 4, 7, 8, 16])
def test_transform_keeps_distances_in_sequency_order(width):
    size = 1 << max(width - 1, 0).bit_length()
    basis = V.walsh(np.eye(size, dtype=np.int64))  # column c holds the c-th function
    assert [sign_changes(basis[:, c].tolist()) for c in range(size)] == list(range(size))
    x = np.random.default_rng(width).integers(-50, 50, (9, width))
    assert ((V.walsh(x) ** 2).sum(1) == size * (x**2).sum(1)).all()


@pytest.mark.parametrize("most", [2, 600, 1 << 24, 1 << 40])
@pytest.mark.parametrize("width", [1, 3, 16])
def test_nearest(most, width):
    r = np.random.default_rng(most + width)
    parts, entries = (r.integers(-most, most + 1, (n, width)) for n in (200, 40))
    entries[7] = entries[3]  # ties
    parts[:5] = entries[3]
    kind = V.exact_type(most, width)
    assert (kind is object) == (most == 1 << 40)
    index, d2 = V.nearest(parts.astype(kind), entries.astype(kind))
    for i, p in enumerate(parts.tolist()):
        all_d2 = [sum((a - b) ** 2 for a, b in zip(p, e)) for e in entries.tolist()]
        assert (int(d2[i]), int(index[i])) == min((d, k) for k, d in enumerate(all_d2))


def coded(rows, entries, rounds, dim):
    """Rows (vec_id, label, vector) by the contract, in plain Python."""
    width = -(-dim // 4)
    ints = [[math.floor(1024 * x) for x in v] + [0] * (4 * width - dim) for _, _, v in rows]
    order = sorted(range(len(rows)), key=lambda i: (rows[i][0] is None, rows[i][0] or 0, ints[i]))
    parts = [[v[p * width : (p + 1) * width] for p in range(4)] for v in ints]
    books = [[parts[i][p] for i in order[:entries]] for p in range(4)]

    def assign(p):
        return [min((sum((a - b) ** 2 for a, b in zip(v[p], e)), k) for k, e in enumerate(books[p])) for v in parts]

    for _ in range(rounds):
        for p in range(4):
            members = defaultdict(list)
            for v, (_, k) in zip(parts, assign(p)):
                members[k].append(v[p])
            books[p] = [
                [sum(c) // len(members[k]) for c in zip(*members[k])] if k in members else e
                for k, e in enumerate(books[p])
            ]
    final = [assign(p) for p in range(4)]
    most = (1 << 63) - 1
    error = [min(sum(final[p][i][0] for p in range(4)), most) for i in range(len(rows))]
    by_label = Counter()
    for (_, label, _), e in zip(rows, error):
        by_label[label] += e
    return books, [
        (r[0], r[1], "".join("%02x" % final[p][i][1] for p in range(4)), error[i], min(by_label[r[1]], most))
        for i, r in enumerate(rows)
    ]


def compressed(vectors, **options):
    codes, books = V.compress(vectors, **options)
    rows = codes.select("vec_id", "label", V.code_text(F.col("code")).alias("code"), "error", "label_error").collect()
    return books, Counter(map(tuple, rows))


VECTORS = "vec_id long, embedding array<double>, label int, code string, ints int, error double, part int"


def vector_rows(seed, n, dim, scale=1.0):
    r = random.Random(seed)
    return [(i, r.choice((None, 1, 2)), [r.gauss(0, scale) for _ in range(dim)]) for i in range(n)]


@pytest.mark.parametrize(("dim", "scale"), [(8, 1.0), (6, 1e9), (1, 3.0)])
def test_codes(spark, dim, scale):
    rows = vector_rows(dim, 90, dim, scale)
    rows += [(None, 3, rows[0][2]), rows[4], rows[4], (5, None, rows[6][2])]
    bad = [None, [], [None] * dim, [math.nan] * dim, [math.inf] * dim, [1.0] * (dim + 1)]
    table = [(i, v, lab, "c", 1, 2.0, 3) for i, lab, v in rows] + [(7, v, 1, "c", 1, 2.0, 3) for v in bad]
    vectors = spark.createDataFrame(table, VECTORS).repartition(5)
    books, found = compressed(vectors, entries=12, rounds=3)
    expected_books, expected = coded(rows, 12, 3, dim)
    assert books == expected_books
    assert found == Counter(expected)


def test_codes_where_labels_are_joined(spark, monkeypatch):
    rows = vector_rows(5, 60, 4)
    vectors = spark.createDataFrame([(i, v, lab, "c", 1, 2.0, 3) for i, lab, v in rows], VECTORS)
    monkeypatch.setattr(common, "BROADCAST_BYTES", 0)
    assert compressed(vectors, entries=8, rounds=1)[1] == Counter(coded(rows, 8, 1, 4)[1])


def test_codes_of_copies_and_of_nothing(spark):
    vectors = spark.createDataFrame([(1, [0.5, 0.5, 0.5, 0.5], 1, "c", 1, 2.0, 3)] * 20, VECTORS)
    books, found = compressed(vectors, entries=4)
    assert found == {(1, 1, "00000000", 0, 0): 20}
    assert books == [[[512]] * 4] * 4
    codes, books = V.compress(vectors.limit(0))
    assert codes.collect() == [] and books == [[], [], [], []]
    zero = spark.createDataFrame([(1, [], 1, "c", 1, 2.0, 3), (2, [], None, "c", 1, 2.0, 3)], VECTORS)
    assert compressed(zero)[1] == {(1, 1, "00000000", 0, 0): 1, (2, None, "00000000", 0, 0): 1}


def test_components_saturate(spark):
    vectors = spark.createDataFrame([(i, [x] * 4, 1, "c", 1, 2.0, 3) for i, x in enumerate((1e300, -1e300))], VECTORS)
    books, found = compressed(vectors, entries=1, rounds=0)
    assert books == [[[1 << 62]]] * 4
    assert found == {(0, 1, "00000000", 0, (1 << 63) - 1): 1, (1, 1, "00000000", (1 << 63) - 1, (1 << 63) - 1): 1}


# ------------------------------------------------------------------ mixing ----


def targets(sizes, weights, epochs):
    """Words per source by repeated clamping, in exact fractions."""
    order = sorted(sizes, key=lambda s: (s is None, (s or "").encode()))
    w = {s: weights[i % len(weights)] for i, s in enumerate(order)}
    total, clamped = sum(sizes.values()), set()
    while True:
        free = [s for s in order if s not in clamped]
        rest = total - sum(epochs * sizes[s] for s in clamped)
        share = {s: Fraction(rest * w[s], sum(w[x] for x in free)) for s in free}
        above = {s for s in free if share[s] > epochs * sizes[s]}
        if not above:
            return {**{s: Fraction(epochs * sizes[s]) for s in clamped}, **share}
        clamped |= above


def check_mix(docs, weights=(5, 2, 1), epochs=3):
    out = M.mix(docs, weights=weights, max_epochs=epochs)
    rows = out.collect()
    sizes, taken, copies = Counter(), Counter(), Counter()
    for r in rows:
        assert r.size == len(words(r.text))
        assert r.taken == r["size"] * r.repeats + r.part_words <= epochs * r["size"]
        assert r.part_words < max(r["size"], 1)
        sizes[r.source] += r["size"]
        taken[r.source] += r.taken
        copies[r.doc_id, r.text, r.source] += 1
    goal = targets(sizes, weights, epochs)
    for r in rows:
        assert r.source_size == sizes[r.source]
        assert r.target == pytest.approx(float(goal[r.source]), rel=1e-12)
    for s, t in goal.items():
        assert abs(taken[s] - t) <= 1 + max(n for (_, _, x), n in copies.items() if x == s)
    again = M.mix(docs.repartition(7), weights=weights, max_epochs=epochs)
    assert Counter(map(tuple, again.collect())) == Counter(map(tuple, rows))
    return out, rows


def mix_rows(seed, n, sources):
    r = random.Random(seed)
    texts = [" ".join(["w"] * r.choice((0, 1, 5, 30, 200))) for _ in range(n)]
    return [(i, t, "en", r.choice(sources), *row[4:]) for i, (t, row) in enumerate(zip(texts, doc_rows(texts)))]


@pytest.mark.parametrize("weights", [(5, 2, 1), (1,), (1, 100, 3, 1000)])
def test_mix(spark, weights):
    rows = mix_rows(1, 300, ["a", "b", "Z", "é", "😀", "￿", None])
    rows += mix_rows(2, 3, ["small"]) + [(1, "x " * 9_000, "en", "big", *rows[0][4:])]
    docs = spark.createDataFrame(rows, DOC_SCHEMA).withColumns({"taken": F.lit("x"), "work": F.lit(1), "of": F.lit(2)})
    out, found = check_mix(docs, weights)
    assert set(out.columns) == {*docs.columns, "size", "source_size", "target", "repeats", "part_words"}
    mixed = M.repeated(out).collect()
    assert sum(len(words(r.text)) for r in mixed) == sum(r.taken for r in found)
    by_doc = Counter()
    for r in mixed:
        by_doc[r.doc_id, r.source] += 1
    assert by_doc == Counter({(r.doc_id, r.source): n for r in found if (n := r.repeats + (r.part_words > 0))})
    whole = {r.text for r in found}
    assert all(r.text in whole for r in mixed if r.repetition <= r.repeats)


def test_mix_with_sources_joined(spark, monkeypatch):
    monkeypatch.setattr(common, "BROADCAST_BYTES", 0)
    check_mix(spark.createDataFrame(mix_rows(3, 200, ["a", "b", "c", None]), DOC_SCHEMA))


def test_mix_where_words_run_out_among_copies(spark):
    rows = mix_rows(4, 60, ["a", "b"])
    rows += [(None, "one two three four five", "en", "a", *rows[0][4:])] * 400
    _, found = check_mix(spark.createDataFrame(rows, DOC_SCHEMA), (1, 5))
    assert len({r.taken for r in found if r.doc_id is None}) == 1


def test_mix_awkward(spark):
    check_mix(awkward(spark))
    assert M.mix(empty(spark)).count() == 0
    nothing = M.mix(documents(spark, [None, "", " "])).select("size", "target", "repeats", "taken").collect()
    assert [tuple(r) for r in nothing] == [(0, 0.0, 0, 0)] * 3
    assert M.repeated(M.mix(documents(spark, [None, ""]))).count() == 0


def test_joins_on_names_in_use(spark):
    rows = spark.createDataFrame([(1, "a"), (2, None), (3, "c")], "salt long, key string")
    per_key = spark.createDataFrame([("a", 10), (None, 20)], "key string, v long")
    expected = {(1, "a", 10), (2, None, 20), (3, "c", None)}
    for most in (common.BROADCAST_BYTES, 0):
        with pytest.MonkeyPatch.context() as m:
            m.setattr(common, "BROADCAST_BYTES", most)
            out = common.join_per_key(rows, per_key, "key", F.col("salt"))
            assert out.columns == ["salt", "key", "v"] and {tuple(r) for r in out.collect()} == expected

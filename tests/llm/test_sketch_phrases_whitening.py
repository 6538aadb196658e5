"""Fingerprints, collocations and whitening against brute force, edge cases included."""

import hashlib
import math
import os
import random
import re
import sys
from collections import Counter, defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

import brute
import oracle
from brookmark.llm import phrases, sketch, whitening
from brookmark.llm.queries import ORACLE, QUERIES

SF = "/root/testdata/sf0.001"
random.seed(11)
WORDS = [f"w{i}" for i in range(30)] + ["Été", "x", "X"]


def some(n):
    return " ".join(random.choice(WORDS) for _ in range(n))


@pytest.mark.parametrize("name", ["op11_document_fingerprints", "op12_phrase_collocations"])
def test_query_matches_its_sql(spark, name):
    assert oracle.difference(QUERIES[name](spark, SF), oracle.connect(SF), ORACLE[name]) is None


# fingerprints


def low(text, k=sketch.SIZE, n=5):
    return sorted({hashlib.md5(" ".join(g).encode()).hexdigest()[:16] for g in brute.grams(text, n)})[:k]


def alike(a, b, k=sketch.SIZE):
    union = sorted({*a, *b})[:k]
    return len(set(union) & set(a) & set(b)) / len(union) if union else 1.0


@pytest.fixture(scope="module")
def texts():
    base = [None, "", " \n\t ", "One", "one", "Été bien sûr " * 3, some(4), some(400), some(900), "x " * 500, some(30_000)]
    return base + [base[7], base[7] + " more", "日本語 " * 40]


def test_fingerprints_of_followers(spark, texts):
    rows = [(3 * i, t) for i, t in enumerate(texts)]
    shuffled = random.sample(rows, len(rows))
    found = sketch.compare_edits(spark.createDataFrame(shuffled, "doc_id long, text string").repartition(3)).collect()
    assert len(found) == len(rows)
    for r in found:
        at = r["doc_id"] // 3
        own, after = texts[at] or "", texts[(at + 1) % len(texts)] or ""
        half = len(own) // 2
        changed = own[: len(own) - half] + after[:half]
        assert r["edited"] == changed
        assert (r["sketch"], r["edited_sketch"], r["next_sketch"]) == (low(own), low(changed), low(after))


@pytest.mark.parametrize("parts", [1, 2, 7, 40])
def test_every_row_has_its_follower_whatever_the_parts(spark, parts):
    """A third of the rows under one id, rows without one, and rows equal in all columns."""
    rows = [(i, f"t{i}") for i in range(40)] + [(17, f"same{i}") for i in range(30)] + [(None, "a"), (None, "a"), (None, None)]
    rows += [(17, "twice")] * 9
    docs = spark.createDataFrame(rows, "doc_id long, text string").withColumn("copy", F.lit(1)).withColumn("part", F.lit(2))
    found = sketch.with_next(docs.repartition(5), parts).collect()
    assert Counter((r["doc_id"], r["text"]) for r in found) == Counter((i, t or "") for i, t in rows)
    # every row is the follower of one row, and ids never fall except at the end
    assert Counter(r["next_text"] for r in found) == Counter(t or "" for _, t in rows)
    by_text = {t: i for i, t in rows if i is not None}
    for r in found:
        if r["doc_id"] not in (None, 17, 39):
            assert by_text[r["next_text"]] in (r["doc_id"], r["doc_id"] + 1)


def test_followers_of_few_rows(spark):
    assert sketch.with_next(spark.createDataFrame([], "doc_id long, text string")).count() == 0
    assert [tuple(r) for r in sketch.with_next(spark.createDataFrame([(5, "a")], "doc_id long, text string")).collect()] == [(5, "a", "a")]


def test_estimates(spark):
    a, b = [f"a{i}" for i in range(6000)], [f"a{i}" for i in range(3000, 6000)] + [f"b{i}" for i in range(1000)]
    one = spark.createDataFrame([(" ".join(a), " ".join(b), "p q r s t u", "", None)], "a string, b string, c string, d string, e string")
    s = one.select(*[sketch.sketch(F.col(c), 1024).alias(c) for c in "abcde"])
    got = s.select(
        sketch.resemblance(F.col("a"), F.col("b"), 1024), sketch.containment(F.col("b"), F.col("a"), 1024),
        sketch.distinct_count(F.col("a"), 1024), sketch.distinct_count(F.col("c"), 1024), sketch.resemblance(F.col("d"), F.col("e")),
        sketch.resemblance(F.col("c"), F.col("d")), sketch.containment(F.col("d"), F.col("c")), sketch.distinct_count(F.col("d")),
    ).first()
    assert math.isclose(got[0], 2996 / 6996, abs_tol=0.06)
    assert math.isclose(got[1], 2996 / 3996, abs_tol=0.1)
    assert math.isclose(got[2], 5996, rel_tol=0.12)
    assert got[3:] == (2.0, 1.0, 0.0, 1.0, 0.0)


def test_sketches_merge_by_group(spark):
    rows = [("x", some(200)) for _ in range(20)] + [("y", "one two three four five six"), ("z", None), (None, "a b c d e")]
    parts = spark.createDataFrame(rows, "grp string, text string").repartition(4).select("grp", sketch.sketch(F.col("text"), 64).alias("sketch"))
    found = {r["grp"]: r["sketch"] for r in sketch.merged(parts, "grp", k=64).collect()}
    whole = defaultdict(set)
    for g, t in rows:
        whole[g] |= brute.grams(t)
    hashes = {g: sorted(hashlib.md5(" ".join(x).encode()).hexdigest()[:16] for x in s)[:64] for g, s in whole.items()}
    assert found == {**hashes, "z": [], None: hashes[None]}


def test_fingerprints_use_no_python(spark):
    plan = QUERIES["op11_document_fingerprints"](spark, SF)._jdf.queryExecution().toString()
    for python in ("MapInArrow", "MapInPandas", "PythonUDF", "EvalPython", "CartesianProduct"):
        assert python not in plan


# collocations


def plain_phrases(docs, most=4, least=30, top=2000, cover=80):
    counts, n = defaultdict(Counter), Counter()
    for text, lang in docs:
        for piece in re.split(r"[.,;:!?\x0A-\x0D]", (text or "").translate(brute.LOW)):
            w = re.findall(r"[^\x20\x09]+", piece)
            n[lang or "und"] += len(w)
            for m in range(1, most + 1):
                for i in range(len(w) - m + 1):
                    counts[lang or "und"][tuple(w[i : i + m])] += 1
    out = []
    for lang, f in counts.items():
        cands = {p: a for p, a in f.items() if len(p) > 1 and a >= least}
        inside = defaultdict(int)
        for p, a in cands.items():
            for s in range(2, len(p)):
                for i in range(len(p) - s + 1):
                    inside[p[i : i + s]] = max(inside[p[i : i + s]], a)
        best = []
        for p, a in cands.items():
            if 100 * inside[p] >= cover * a:
                continue
            score, k = min((2_000_000 * a // (f[p[:k]] + f[p[k:]]), k) for k in range(1, len(p)))
            best.append((-score, -a, " ".join(p).encode(), f[p[:k]], f[p[k:]]))
        for rank, (score, a, phrase, left, right) in enumerate(sorted(best)[:top], 1):
            out.append((lang, rank, phrase.decode(), -a, left, right, n[lang], -score))
    return sorted(out)


@pytest.fixture(scope="module")
def spoken():
    tails = ["new york city hall", "ice cream", "NEW YORK", "a b a b a b a b"]
    docs = [(f"{some(6)}. {random.choice(tails)}, {some(3)}\n{random.choice(tails)} {some(2)}", random.choice(["en", "fr", None])) for _ in range(300)]
    docs += [(None, "en"), ("", None), ("...;;\t\n", "xx"), ("no no " * 5000, "en"), (some(20_000), "fr")]
    return docs + [docs[0]] * 60


@pytest.mark.parametrize("spacing, most", [(1, 4), (3, 4), (12, 4), (12, 2), (5, 3)])
def test_phrases_are_counted_once(spark, spoken, spacing, most):
    docs = spark.createDataFrame(spoken, "text string, lang string").withColumn("own", F.lit("x")).withColumn("times", F.lit(7))
    found = phrases.collocations(docs.repartition(5), most=most, spacing=spacing).select("lang", "rank", "phrase", "a", "l", "r", "n", "score")
    assert sorted(map(tuple, found.collect())) == plain_phrases(spoken, most)


def test_top_and_ties(spark):
    docs = [("a b. c d. e f. g h.", "en")] * 40
    found = phrases.collocations(spark.createDataFrame(docs, "text string, lang string"), top=3).collect()
    assert [r["phrase"] for r in sorted(found, key=lambda r: r["rank"])] == ["a b", "c d", "e f"]


def test_no_phrases(spark):
    empty = spark.createDataFrame([], "text string, lang string")
    assert phrases.collocations(empty).count() == 0
    assert phrases.collocations(spark.createDataFrame([("a b c", "en")], "text string, lang string")).count() == 0


def test_equal_text_parses_alike():
    """The same words give the same chunks behind any start, but for the first chunk."""
    body = some(2000).encode()
    cut = [{c for _, _, c in phrases.chunks([head + body], 4, 12)} for head in (b"", b"q ", b"q r s t ")]
    assert len(cut[0] & cut[1] & cut[2]) >= len(cut[0]) - 1
    for row, own, words in phrases.chunks([body], 4, 12):
        assert len(words.split()) in (own, own + 3)


def test_small_maps_only_cost_work(spark, spoken):
    docs = spark.createDataFrame(spoken, "text string, lang string")
    found = phrases.collocations(docs, map_bits=16).select("lang", "rank", "phrase", "a", "l", "r", "n", "score")
    assert sorted(map(tuple, found.collect())) == plain_phrases(spoken)


# whitening


def test_inertia_counts_eigenvalues():
    rng = np.random.default_rng(3)
    for _ in range(200):
        n = rng.integers(1, 9)
        a = rng.integers(-2, 3, (n, n)).astype(float)
        a += a.T
        for shift in (0.3, -1.7, 2.1):
            assert whitening.inertia(a, shift) == (np.linalg.eigvalsh(a) > shift).sum()
    assert whitening.inertia(np.zeros((4, 4)), 0.0) == 0


@pytest.mark.parametrize("size, kind", [(64, "plain"), (1, "plain"), (6, "ties"), (64, "ties"), (40, "close"), (6, "rank"), (3, "zero")])
def test_slices_find_the_leading_pairs(size, kind):
    rng = np.random.default_rng(size)
    q, _ = np.linalg.qr(rng.normal(size=(size, size)))
    e = rng.uniform(1, 1e5, size)
    if kind == "ties":
        e[: size // 2] = 77777.0
    if kind == "close":
        e[:10] = 1e5 * (1 + np.arange(10) * 1e-13)
    if kind in ("rank", "zero"):
        e[2 if kind == "rank" else 0 :] = 0
    v = q @ np.diag(e) @ q.T
    v = (v + v.T) / 2
    found = whitening.slices(v, 8)
    assert len(found.values) == {"rank": 2, "zero": 0}.get(kind, min(size, 8))
    want = np.sort(np.linalg.eigvalsh(v))[::-1][: len(found.values)]
    assert np.allclose(found.values, want, rtol=1e-12, atol=1e-12)
    assert np.allclose(v @ found.vectors, found.vectors * found.values, atol=1e-7)
    assert np.allclose(found.vectors.T @ found.vectors, np.eye(len(found.values)), atol=1e-12)


def brute_whitening(vectors):
    x = [[math.floor(1024 * float(c)) + 100000 for c in v] for v in vectors]
    n, s = len(x), [sum(c) for c in zip(*x)]
    away = np.array([[n * a - b for a, b in zip(row, s)] for row in x], object)
    v = np.array(away.T @ away / n**3, float)
    e, q = np.linalg.eigh(v)
    return n, [int((row * row).sum()) for row in away], e[::-1], (away.astype(float) / n) @ q[:, ::-1] / np.sqrt(e[::-1]), np.trace(v)


def test_whitening_matches_brute_force(spark):
    rng = np.random.default_rng(5)
    vectors = (rng.normal(size=(500, 12)) * np.linspace(0.1, 3, 12)).astype(np.float32).tolist()
    vectors += [vectors[0]] * 250  # a third of all rows alike
    rows = [(i, v) for i, v in enumerate(vectors)]
    odd = [(900, None), (901, [None] + [1.0] * 11), (902, [float("nan")] * 12), (903, [float("inf")] + [0.0] * 11), (904, [1.0]), (905, []), (906, [1e30] * 12)]
    table = spark.createDataFrame(rows + odd + [(None, vectors[3])], "vec_id long, embedding array<float>").withColumn("n", F.lit("x")).repartition(4)
    found = whitening.whiten(table).collect()
    n, deviation, e, white, trace = brute_whitening(vectors + [vectors[3]])
    assert len(found) == 8 * n
    sign = {}
    for r in found:
        at = len(vectors) if r["vec_id"] is None else r["vec_id"]
        k = r["component"] - 1
        assert (r["n"], int(r["deviation"])) == (n, deviation[at])
        assert math.isclose(r["explained"], e[k] / trace, rel_tol=1e-9)
        sign.setdefault(k, math.copysign(1, r["whitened"] * white[at, k]))
        assert math.isclose(r["whitened"], sign[k] * white[at, k], abs_tol=1e-7)
        assert r["identity_error"] < 1e-9


def test_whitening_of_odd_tables(spark):
    schema = "vec_id long, embedding array<double>"
    assert whitening.whiten(spark.createDataFrame([], schema)).count() == 0
    assert whitening.whiten(spark.createDataFrame([(1, None), (2, [None])], schema)).count() == 0
    assert whitening.whiten(spark.createDataFrame([(1, [1.0, 2.0])] * 3, schema)).count() == 0  # nothing varies
    few = whitening.whiten(spark.createDataFrame([(1, [1.0, 2.0]), (2, [3.0, 2.0])], schema)).collect()
    assert [(r["component"], round(abs(r["whitened"]), 12), r["explained"]) for r in few] == [(1, 1.0, 1.0)] * 2


def test_whitening_of_wide_numbers_is_exact(spark):
    big = [[float(1 << 42), -float(1 << 41)], [-float(1 << 42), 3.0], [5.5, 7.25]]
    found = whitening.whiten(spark.createDataFrame(list(enumerate(big)), "vec_id long, embedding array<double>")).collect()
    _, deviation, *_ = brute_whitening(big)
    assert {r["vec_id"]: int(r["deviation"]) for r in found} == dict(enumerate(deviation))


def test_whitening_query(spark):
    rows = QUERIES["op13_embedding_whitening"](spark, SF).toPandas()
    vectors = spark.read.parquet(f"{SF}/embeddings.parquet").orderBy("vec_id").toPandas().embedding.tolist()
    n, deviation, e, white, trace = brute_whitening(vectors)
    assert len(rows) == 8 * n and (rows.n == n).all() and rows.identity_error.max() < 1e-9
    assert rows[rows.component == 1].sort_values("vec_id").deviation.tolist() == deviation
    for k in range(8):
        own = rows[rows.component == k + 1].sort_values("vec_id")
        assert np.allclose(np.abs(own.whitened), np.abs(white[:, k]), atol=1e-7)
        assert np.allclose(own.explained, e[k] / trace, rtol=1e-9)

"""Whitening, hard negatives and weighted-sampling fingerprints against brute force, and on awkward tables."""

from __future__ import annotations

import collections
import hashlib
import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from plyscope.llm import fingerprints, negatives, whitening
from plyscope.llm.queries import QUERIES
from tests.llm.test_corpus_operators import awkward, docs_of  # noqa: F401

VECTORS = "vec_id long, embedding array<double>, label long, id long, v string, x int, n string, rank int"


def vectors_of(spark, rows):
    """Vectors with columns whose names clash with those that operators add."""
    return spark.createDataFrame([(i, v, c, 5, "v", 6, "n", 7) for i, v, c in rows], VECTORS)


def brute_whitening(rows, wanted=4):
    x = {}
    for i, v in rows:
        if v and all(c is not None and np.isfinite(c) for c in v):
            x.setdefault(len(v), []).append((i, tuple(int(np.floor(256 * c)) for c in v)))
    out = collections.defaultdict(list)
    for d, members in x.items():
        fit = np.array(sorted({m for _, m in members}), dtype=object)
        n, sums = len(fit), fit.sum(axis=0)
        z = ((n * fit - sums) / n).astype(float)
        values, axes = np.linalg.eigh(z.T @ z / n)
        values, axes = values[::-1], axes[:, ::-1]
        for i, m in members:
            deviation = n * np.array(m, dtype=object) - sums
            for k in range(min(wanted, d)):
                flat = values[k] <= 1e-12 * max(values.sum(), 0)
                w = None if flat else abs(float((deviation / n).astype(float) @ axes[:, k]) / np.sqrt(values[k]))
                share = max(values[k], 0) / values.sum() if values.sum() > 0 else None
                out[i, k + 1].append((n, int((deviation**2).sum()), w, share))
    return out


def same_whitening(got, want):
    found = collections.defaultdict(list)
    for r in got:
        assert r["identity_error"] is None or r["identity_error"] < 1e-9
        found[r["vec_id"], r["component"]].append((r["n"], r["deviation"], None if r["whitened"] is None else abs(r["whitened"]), r["explained"]))
    assert found.keys() == want.keys()
    for key, rows in want.items():
        assert len(rows) == len(found[key])
        for a, b in zip(sorted(rows, key=str), sorted(found[key], key=str), strict=True):
            assert a[:2] == b[:2]
            for u, v in zip(a[2:], b[2:], strict=True):
                assert (u is None) == (v is None) and (u is None or abs(u - v) < 1e-7 * max(1, abs(u)))


@pytest.mark.parametrize("dims", [1, 3, 40])
def test_whitening_matches_the_eigenvectors(spark, dims):
    rng = np.random.default_rng(dims)
    m = rng.standard_normal((300, dims)) * np.linspace(3, 0.2, dims)
    rows = [(i, v.tolist()) for i, v in enumerate(m)] + [(7, m[7].tolist()), (None, m[8].tolist())]
    rows += [(901, None), (902, []), (903, [float("nan")] * dims), (904, [None] * dims), (905, [float("inf")] * dims)]
    got = whitening.whitened(vectors_of(spark, [(i, v, 1) for i, v in rows])).collect()
    same_whitening(got, brute_whitening(rows))


def test_whitening_without_variance_and_of_mixed_dimensions(spark):
    rows = [(1, [0.5, 0.25]), (2, [0.5, 0.25]), (3, [1.0]), (4, [2.0]), (5, [4.0])]
    got = whitening.whitened(vectors_of(spark, [(i, v, 1) for i, v in rows])).collect()
    same_whitening(got, brute_whitening(rows))
    two = [r for r in got if r["vec_id"] in (1, 2)]
    assert len(two) == 4 and all(r["whitened"] is None and r["explained"] is None and r["deviation"] == 0 for r in two)
    assert whitening.whitened(vectors_of(spark, [])).collect() == []


def test_whitening_query_on_the_table(spark, sf):
    rows = [(r["vec_id"], r["embedding"]) for r in spark.read.parquet(f"{sf}/embeddings.parquet").collect()]
    same_whitening(QUERIES["op11_jacobi_davidson"](spark, sf).collect(), brute_whitening(rows))


def test_jacobi_davidson_locks_close_and_repeated_values():
    rng = np.random.default_rng(2)
    values = np.array([5.0, 5.0, 4.999999, 1.0, *rng.uniform(0, 0.9, 56)])
    q = np.linalg.qr(rng.standard_normal((60, 60)))[0]
    a = (q * values) @ q.T
    found, vectors = whitening.jacobi_davidson(lambda u: a @ u, 60, 4)
    assert np.allclose(found, values[:4], atol=1e-12)
    assert np.abs(a @ vectors - vectors * found).max() < 1e-11
    assert np.allclose(vectors.T @ vectors, np.eye(4), atol=1e-12)


def test_deviations_are_exact_beyond_64_bits():
    x = np.array([[2**50, -(2**50)], [3, 5]])
    d = whitening.deviations(x, 2**20, [7, 9])
    assert d.tolist() == [[2**70 - 7, -(2**70) - 9], [3 * 2**20 - 7, 5 * 2**20 - 9]]
    assert whitening.squares(d)[0] is None and whitening.squares(d)[1] == (3 * 2**20 - 7) ** 2 + (5 * 2**20 - 9) ** 2


def brute_negatives(rows, every, positives=5, negatives_=10):
    usable = {
        (i, c, tuple(int(np.floor(256 * x)) for x in v))
        for i, v, c in rows
        if i is not None and c is not None and v is not None and all(x is not None and np.isfinite(x) for x in v)
    }
    out = []
    for i, c, a in usable:
        if i % every:
            continue
        scored = sorted((-sum(p * q for p, q in zip(a, b)), j, d) for j, d, b in usable if j != i and len(a) == len(b))
        for s, j, _ in [x for x in scored if x[2] == c][:positives]:
            inside = [x for x in scored if x[2] != c and 30 * -s <= 100 * -x[0] <= 90 * -s][:negatives_]
            out += [(i, j, rank + 1, x[1], -s, -x[0]) for rank, x in enumerate(inside)]
    return sorted(out)


@pytest.mark.parametrize("anchor_rows,block_rows", [(4, 16), (512, 4096)])
def test_hard_negatives_match_brute_force(spark, anchor_rows, block_rows):
    rng = np.random.default_rng(3)
    centers = rng.standard_normal((6, 9))
    rows = []
    for i in range(240):
        v = centers[i % 6] + 0.3 * rng.standard_normal(9)
        rows.append((i, v.tolist(), int(rng.integers(0, 4))))
    rows += [(300 + i, rows[3][1], i % 2) for i in range(40)]  # copies of one vector: ties
    rows += [rows[0], rows[10], (None, rows[0][1], 1), (400, None, 1), (410, rows[0][1], None)]
    rows += [(420, [float("nan")] * 9, 1), (430, [None] * 9, 1), (440, [1.0, 2.0], 1), (441, [1.0, 1.0], 2), (442, [1.0, 2.0], 1)]
    rows += [(450, [0.0] * 9, 1), (460, [], 1), (470, [1e6] * 9, 1)]
    table = negatives.labelled_vectors(vectors_of(spark, rows))
    found = negatives.hard_negatives(table, 10, anchor_rows=anchor_rows, block_rows=block_rows)
    columns = ["anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score"]
    assert sorted(tuple(r) for r in found.select(*columns).collect()) == brute_negatives(rows, 10)


def test_hard_negatives_of_few_rows(spark):
    assert negatives.hard_negatives(negatives.labelled_vectors(vectors_of(spark, []))).collect() == []
    alone = [(100, [1.0, 2.0], 1), (101, [1.0, 1.0], 1)]
    assert negatives.hard_negatives(negatives.labelled_vectors(vectors_of(spark, alone))).collect() == []


def test_tree_bounds_leave_candidates_unscored():
    rng = np.random.default_rng(4)
    near = rng.standard_normal(16) + 0.02 * rng.standard_normal((40, 16))
    rows = np.concatenate([near, rng.standard_normal((2000, 16))]) * 256
    order, parents, edges = negatives.spanning_tree(near * 256)
    anchors = (near * 256)[order]
    block = {"dims": 16, "ids": order.astype("<i8").tobytes(), "labels": np.zeros(40, "<i8").tobytes(), "data": anchors.astype("<f8").tobytes()}
    block |= {"parents": parents.tobytes(), "edges": edges.tobytes()}
    ids = np.arange(len(rows))
    labels = np.where(ids < 40, 0, 1)
    data = {"dims": 16, "ids": ids.astype("<i8").tobytes(), "labels": labels.astype("<i8").tobytes(), "data": rows.astype("<f8").tobytes()}
    pair = negatives.Pair(block, data)
    best = {j: [(int(i), int(s)) for i, s in zip(pair.row_ids[at], score)] for j, at, score in pair.positives(5)}
    before = pair.scored
    for j, at in ((j, at) for j, _, _, at, _ in pair.negatives(10, best, 30, 90)):
        assert len(at)
    assert pair.scored - before < 0.6 * 40 * len(rows)
    exact = rows @ anchors.T
    for j, found in best.items():
        want = sorted(((-exact[i, j], i) for i in range(40) if i != order[j]))[:5]
        assert [i for i, _ in found] == [i for _, i in want]


def likeness(a, b):
    return sum(a[i : i + 4] == b[i : i + 4] for i in range(0, len(a), 4)) / (len(a) // 4)


def test_samples_collide_as_often_as_the_generalised_jaccard(spark):
    rng = np.random.default_rng(1)
    rows, want = [], []
    for g in range(600):
        a, b = rng.integers(0, 6, (2, 12))
        want.append(np.minimum(a, b).sum() / np.maximum(a, b).sum())
        rows += [(g, 100 * g + i, int(p), int(q)) for i, (p, q) in enumerate(zip(a, b))]
    terms = spark.createDataFrame(rows, "g long, term long, p long, q long")
    sampled = fingerprints.fingerprints(terms, ["g"], {"a": "p", "b": "q"})
    texts = [fingerprints.written(F.col(c)).alias(c) for c in "ab"]
    made = {r["g"]: likeness(r["a"], r["b"]) for r in sampled.select("g", *texts).collect()}
    gaps = np.array([made[g] - want[g] for g in range(600)])
    assert abs(gaps.mean()) < 0.012 and gaps.std() < 0.075


def test_fingerprints_of_awkward_texts(spark, awkward):  # noqa: F811
    rows = [*awkward, (30, "漢字かな交じり文 と 한국어"), (31, "漢字かな交じり文 と 한국어!"), (32, "w " * 30_000)]
    got = collections.defaultdict(set)
    for r in fingerprints.edited(docs_of(spark, rows)).collect():
        got[r["doc_id"]].add(tuple(r))
    assert fingerprints.edited(docs_of(spark, rows)).count() == len(rows)
    texts = sorted({(-(2**63) if i is None else i, t or "") for i, t in rows if i != 9})
    by_text = collections.defaultdict(set)
    for at, (i, t) in enumerate(texts):
        if i == 8 or i == 10:  # next to the repeated id 9
            continue
        following = texts[(at + 1) % len(texts)][1]
        edited = t[: len(t) - len(t) // 4] + following[: len(t) // 4]
        (row,) = got[None if i == -(2**63) else i]
        assert row[1] == len(t) and row[2] == hashlib.sha256(edited.encode()).hexdigest()
        assert 0 <= row[5] <= 1 and 0 <= row[6] <= 1 and row[5] == (1.0 if row[3] == row[4] else likeness(row[3], row[4]))
        by_text[t].add(row[3])
    assert all(len(found) == 1 for found in by_text.values())
    assert got[5] and {r[3] for r in got[5]} == {"0000" * fingerprints.SAMPLES}
    assert likeness(*[next(iter(got[i]))[3] for i in (30, 31)]) > 0.7
    assert fingerprints.edited(docs_of(spark, [])).collect() == []
    (only,) = fingerprints.edited(docs_of(spark, [(1, "one two three four")])).collect()
    assert only["near_next"] == 1.0 and only["edited_sha256"] == hashlib.sha256(b"one two three one ").hexdigest()


def test_likeness_follows_the_texts(spark, sf):
    made = {r["doc_id"]: r for r in QUERIES["op13_weighted_sampling"](spark, sf).collect()}
    texts = sorted((r["doc_id"], r["text"] or "") for r in spark.read.parquet(f"{sf}/documents.parquet").select("doc_id", "text").collect())
    gaps = []
    for at, (i, t) in enumerate(texts):
        following = texts[(at + 1) % len(texts)][1]
        edited = t[: len(t) - len(t) // 4] + following[: len(t) // 4]
        assert made[i]["edited_sha256"] == hashlib.sha256(edited.encode()).hexdigest()
        for other, found in ((edited, made[i]["near_edited"]), (following, made[i]["near_next"])):
            a, b = (collections.Counter(x.lower().split()) for x in (t, other))
            gaps.append(found - sum((a & b).values()) / max(1, sum((a | b).values())))
    assert abs(np.mean(gaps)) < 0.03 and np.std(gaps) < 0.08 and np.abs(gaps).max() < 0.35


def test_fingerprints_use_no_python(spark, sf):
    plan = QUERIES["op13_weighted_sampling"](spark, sf)._jdf.queryExecution().toString()
    assert "Python" not in plan and "Pandas" not in plan and "Arrow" not in plan


def test_bid_of_weight_one_is_not_divided(spark):
    rows = [(0.0, 0.25, 0.0), (1.5, 0.25, 0.0), (1.5, 0.75, 1.0), (0.5, 0.9, 2.0), (1.5, 0.5, None)]
    drawn = spark.createDataFrame(rows, "r double, b double, l double")
    got = drawn.select("r", "b", "l", fingerprints.bid((F.col("r"), F.lit(0.125), F.col("b")), F.col("l")).alias("bid")).collect()
    for r, b, log_weight, bid in got:
        t = None if log_weight is None else 0 if log_weight == 0 else math.floor(log_weight / r + b)
        assert bid == (None if t is None else 0.125 - r * (t - b + 1.0))

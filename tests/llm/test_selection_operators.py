"""Clusters, power-of-two packing and importance resampling against plain versions, SQL and odd tables."""

import hashlib
import math
import os
import random
import re
import sys
import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest

sys.path.insert(0, os.path.dirname(__file__))

import brute
from compare import connect, difference
from hailgrid.llm import binary_packing, clusters, resample, tokens
from hailgrid.llm.catalog import ORACLES, QUERIES
from test_corpus import ODD, SF_DIR, documents, frame, ordered
from test_text_operators import reference_ids


@pytest.mark.parametrize("name", ["op11_clusters", "op13_resample"])
def test_sql(spark, name):
    assert difference(QUERIES[name](spark, SF_DIR).toPandas(), connect(SF_DIR).execute(ORACLES[name]).fetch_df()) is None


# ---- clusters

def plain_clusters(rows, centroids, rounds, dimensions, scale=64, seed=1):
    limit = 1 << 27
    kept = []
    for vec_id, x in rows:
        if x is not None and len(x) == dimensions and all(v is not None and math.isfinite(v) for v in x):
            kept.append((vec_id, [max(-limit, min(limit, math.floor(v * scale) if abs(v) < 1e30 else math.copysign(limit, v))) for v in x]))
    name = lambda i: hashlib.sha256(f"{seed}:{'' if i is None else i}".encode()).hexdigest()
    points = [v for _, v in sorted(kept, key=lambda r: (name(r[0]), r[0] is None, r[0] or 0, r[1]))[:centroids]]
    near = lambda v: min((sum((a - b) ** 2 for a, b in zip(v, p, strict=True)), k) for k, p in enumerate(points))
    for _ in range(rounds):
        own = defaultdict(list)
        for _, v in kept:
            own[near(v)[1]].append(v)
        points = [[int(sum(c)) // len(own[k]) for c in zip(*own[k], strict=True)] if k in own else p for k, p in enumerate(points)]
    return [(i, *reversed(near(v))) for i, v in kept], points


VECTORS = "vec_id long, embedding array<double>, vector string, distances string, cluster string"


def vectors(spark, rows):
    return spark.createDataFrame([(i, x, "v", "d", "c") for i, x in rows], VECTORS)


NAN, INF = float("nan"), float("inf")
STRANGE = [
    (1, None), (2, []), (3, [1.0, 2.0]), (4, [NAN, 0.0, 0.0]), (5, [INF, 0.0, 0.0]), (6, [None, 0.0, 0.0]), (7, [0.0] * 4),
    (8, [1e300, -1e300, 0.0]), (9, [-1e18, 3e6, 2.5e6]), (None, [0.5, 0.25, -0.01]), (None, [0.0, 0.0, 0.0]), (10, [-0.001, 0.0156, 0.015625]),
    *[(11, [0.5, 0.5, 0.5])] * 9, (12, [0.5, 0.5, 0.5]), (13, [-0.0, 0.0, 1e-320]),
]


@pytest.mark.parametrize("k, rounds, pivots", [(3, 3, 2), (40, 2, 12), (1, 1, 1), (4, 0, 3)])
def test_clusters_odd(spark, k, rounds, pivots):
    rng = random.Random(k)
    spread = [(100 + n, [rng.choice([0, 5, -5]) + rng.gauss(0, 0.05) for _ in range(3)]) for n in range(60)]
    ties = [(200 + n, [float(rng.randrange(-2, 3)) for _ in range(3)]) for n in range(60)]
    rows = [*STRANGE, *spread, *ties]
    got = clusters.cluster_vectors(vectors(spark, rows), k, rounds, pivots, dimensions=3)
    want, points = plain_clusters(rows, k, rounds, 3)
    assert got.centroids.tolist() == points
    assert ordered(got.rows.select("vec_id", "cluster", "distance").collect()) == ordered(want)
    assert len(got.measured) == rounds and all(m <= n for m, n in got.measured)


def test_no_vectors(spark):
    for rows in ([], STRANGE[:7]):
        assert clusters.cluster_vectors(vectors(spark, rows), dimensions=3).rows.count() == 0
    out = clusters.cluster_digest(vectors(spark, STRANGE))
    assert out.count() == 0 and [t for _, t in out.dtypes] == ["bigint", "int", "bigint", "bigint", "bigint", "string"]


def test_huge_inertia_is_held(spark):
    far = [(n, [(-1.0) ** n * 1e9] * 64) for n in range(40)]
    got = clusters.cluster_vectors(vectors(spark, far), centroids=1, rounds=1)
    assert {r["distance"] for r in got.rows.collect()} == {64 * (1 << 54)}
    assert clusters.cluster_digest(vectors(spark, far)).count() == 40


def test_pivots_discard_what_is_far():
    rng = np.random.default_rng(1)
    centres = rng.integers(-4000, 4000, (16, 64))
    own = centres[rng.integers(0, 16, 5000)] + rng.integers(-20, 20, (5000, 64))
    fixed = clusters.far_apart(own[:256], 12)
    cluster, best, measured = clusters.Centroids(centres, clusters.to_pivots(centres, fixed)).nearest(own, clusters.to_pivots(own, fixed))
    assert measured < 2 * len(own)
    assert (best == np.stack([clusters.squared(own, c) for c in centres], axis=1).min(axis=1)).all()


# ---- power-of-two packing

def check_binary(got, data, capacity=2048):
    want = []
    for (doc_id, _), ids in zip(data, reference_ids([t for _, t in data]), strict=True):
        ids = [*ids[:-1], 1]
        at, left = 0, len(ids)
        while left:
            n = min(capacity, 1 << (left.bit_length() - 1))
            want.append((doc_id, at, n, zlib.crc32(np.array(ids[at : at + n], "<u4").tobytes()), len(ids)))
            at, left = at + n, left - n
    assert ordered((r["doc_id"], r["start"], r["length"], r["ids_crc32"], r["doc_tokens"]) for r in got) == ordered(want)
    assert len({r["sequence_id"] for r in got}) == len(got) and {r["offset"] for r in got} <= {0}
    buckets = defaultdict(list)
    for r in got:
        buckets[r["length"]].append(r["number"])
        assert r["sequence_id"] == r["number"] * capacity.bit_length() + r["length"].bit_length() - 1
    assert all(sorted(x) == list(range(len(x))) for x in buckets.values())
    assert all(n & n - 1 == 0 and n <= capacity for n in buckets)


def test_binary_packing(spark):
    _, data = documents(spark)
    check_binary(QUERIES["op12_binary_packing"](spark, SF_DIR).collect(), data)


@pytest.mark.parametrize("capacity", [1, 4, 2048])
def test_binary_packing_odd(spark, capacity):
    clashing = frame(spark, ODD).withColumnsRenamed({"items": "number", "slice": "_bucket", "fp": "length", "n_words": "_inside"})
    check_binary(binary_packing.binary_packed(clashing, capacity).collect(), ODD, capacity)
    assert binary_packing.binary_packed(clashing.limit(0), capacity).count() == 0


def test_only_powers_of_two_hold_a_sequence(spark):
    with pytest.raises(ValueError):
        binary_packing.binary_packed(frame(spark, ODD), 1000)


RUNS = {"blanks": "x" + " " * 10**6 + "y", "lines": "\n" * 10**6, "mixed": " \n" * 400_000 + "z", "letters": "a" * 10**6, "signs": "!" * 10**6}


@pytest.mark.parametrize("name", RUNS)
def test_long_runs_of_one_sign(name):
    """The ids are those of the named tokenizer, also where the faster one runs out of stack."""
    ids = tokens.encoder(tokens.default_vocabulary())(RUNS[name])
    assert [*ids.tolist(), 2] == reference_ids([RUNS[name]])[0]


def test_long_runs_are_packed(spark):
    from hailgrid.llm import packing

    data = [(k, t) for k, t in enumerate(RUNS.values())]
    check_binary(binary_packing.binary_packed(frame(spark, data)).collect(), data)
    got = packing.packed(frame(spark, data)).collect()
    assert Counter(r["doc_id"] for r in got) == Counter({k: -(-len(ids) // 1024) for k, ids in enumerate(reference_ids([t for _, t in data]))})


# ---- importance resampling

def plain_features(text):
    words = re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", (text or "").translate(brute.LOWER))
    return len(words), [*words, *map(" ".join, zip(words, words[1:], strict=False))]


def plain_resample(docs, target, percent=25, least_words=20, width=10000, seed=7):
    bucket = lambda f: zlib.crc32(f.encode("utf-8")) % width
    s, t = (Counter(bucket(f) for x in texts for f in plain_features(x)[1]) for texts in ([x for _, x in docs], target))
    s_all, t_all = sum(s.values()), sum(t.values())
    gain = lambda b: math.floor(1000 * math.log((t[b] + 1) * (s_all + width) / ((s[b] + 1) * (t_all + width))))
    out = []
    for k, (doc_id, text) in enumerate(docs):
        n, features = plain_features(text)
        weight = sum(gain(bucket(f)) for f in features) // len(features) if features else 0
        h = int(hashlib.sha256(f"{seed}:{'' if doc_id is None else doc_id}".encode()).hexdigest()[:8], 16)
        out.append((doc_id, len(features), weight, weight + math.floor(-1000 * math.log(-math.log((h + 0.5) / 4294967296))), n))
    able = sorted((r for r in out if r[4] >= least_words), key=lambda r: (-r[3], r[0] is None, r[0] or 0, r[1]))
    drawn = able[: percent * len(able) // 100]
    ranks = defaultdict(list)
    for k, r in enumerate(drawn):
        ranks[r].append(k + 1)
    return [(*r[:4], ranks[r].pop(0) if ranks[r] else None) for r in out]


def resampled(spark, data, target, **more):
    clashing = frame(spark, data).withColumnsRenamed({"items": "rank", "slice": "place", "fp": "score"})
    bench = spark.createDataFrame([(k, t, 1) for k, t in enumerate(target)], "item_id long, text string, n int")
    return ordered(tuple(r) for r in resample.resampled(clashing, bench, **more).collect())


@pytest.mark.parametrize("part, last", [(1 << 20, 4096), (7, 1), (1, 3)])
def test_resample_in_parts(spark, part, last):
    _, data = documents(spark)
    bench = spark.read.parquet(f"{SF_DIR}/benchmark.parquet")
    want = ordered(plain_resample(data, [r["text"] for r in bench.collect()]))
    docs = spark.createDataFrame(data, "doc_id long, text string").repartition(5)
    got = resample.resampled(docs, bench, part=part, last=last)
    assert ordered(tuple(r) for r in got.collect()) == want
    assert sum(r[4] is not None for r in want) > 20


@pytest.mark.parametrize("percent", [0, 1, 25, 100])
@pytest.mark.parametrize("last", [1, 4096])
def test_resample_odd(spark, percent, last):
    copies = [(50, "one two three four five six " * 5)] * 40 + [(None, "seven eight nine " * 9)] * 3
    data = [*ODD, *copies, *[(k, f"word {k} " * 12) for k in range(60, 90)]]
    target = [None, "", "One, two; THREE!", "ünï cödé", "w1 w2 w3 w4"]
    assert resampled(spark, data, target, percent=percent, part=4, last=last) == ordered(plain_resample(data, target, percent))


def test_resample_empty(spark):
    assert resampled(spark, [], ["a b"]) == []
    assert resampled(spark, ODD, []) == ordered(plain_resample(ODD, []))


def test_median_of_medians_has_a_quarter_on_either_side():
    rng = random.Random(4)
    for _ in range(200):
        parts = [sorted((rng.randrange(50), rng.random()) for _ in range(rng.randrange(1, 30))) for _ in range(rng.randrange(1, 12))]
        pivot = resample.weighted_median([(p[(len(p) - 1) // 2], len(p)) for p in parts])
        keys = [k for p in parts for k in p]
        assert 4 * sum(k <= pivot for k in keys) >= len(keys) and 4 * sum(k >= pivot for k in keys) >= len(keys)

"""Operators on documents against their plain versions, and on odd tables."""

import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(__file__))

import brute
from hailgrid.llm.catalog import QUERIES
from hailgrid.llm.decontaminate import benchmark_hits, contamination
from hailgrid.llm.simhash import simhash_groups
from hailgrid.llm.substrings import repeated_windows, substring_digest

SF_DIR = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")

LONG = " ".join(f"w{k}" for k in range(3000))
ODD = [
    (1, None),
    (2, ""),
    (3, "   \n\t "),
    (4, "one"),
    (5, LONG),
    (6, LONG),
    (6, LONG),
    (None, "Alpha beta gamma delta epsilon zeta eta theta iota kappa lambda"),
    (7, "alpha beta gamma delta epsilon zeta eta theta iota kappa lambda"),
    (8, "a " * 120),
    (9, "ünï cödé ßtraße " * 30 + "x"),
    (10, " ".join(f"w{k}" for k in range(500, 620)) + " tail " + " ".join(f"w{k}" for k in range(560, 640))),
]


def rows(df, *names):
    return sorted((tuple(r) for r in df.select(*names).collect()), key=repr)


def frame(spark, data):
    """Documents with extra columns whose names clash with inner ones."""
    return spark.createDataFrame(
        [(i, t, "en", "x", 1, 2, 3) for i, t in data], "doc_id long, text string, lang string, items string, slice long, fp long, n_words int"
    )


def documents(spark):
    df = spark.read.parquet(f"{SF_DIR}/documents.parquet")
    return df, [(r["doc_id"], r["text"]) for r in df.select("doc_id", "text").collect()]


def ordered(out):
    return sorted((tuple(x) for x in out), key=repr)


CONTAMINATION = ("doc_id", "n_words", "n_hit", "n_items", "items_sha256", "contaminated")
ITEMS = [(1, "W5 w6, w7 w8 w9 w10 w11 w12 w13 w14 w15 w16"), (2, "one"), (10, "beta GAMMA"), (3, None), (4, ""), (5, "beta gamma"), (6, "--- !!")]


def test_contamination(spark):
    docs, data = documents(spark)
    bench = spark.read.parquet(f"{SF_DIR}/benchmark.parquet")
    items = [(r["item_id"], r["text"]) for r in bench.collect()]
    want = brute.contamination(data, items)
    assert any(x[-1] for x in want)
    assert rows(QUERIES["op5_decontaminate"](spark, SF_DIR), *CONTAMINATION) == ordered(want)


@pytest.mark.parametrize("pass_bytes", [1 << 20, 40])
def test_contamination_odd(spark, pass_bytes):
    bench = spark.createDataFrame([(*x, 0) for x in ITEMS], "item_id long, text string, n_words int")
    hits = benchmark_hits(frame(spark, ODD), bench, pass_bytes=pass_bytes)
    want = brute.contamination(ODD, ITEMS)
    got = ordered((r["doc_id"], r["n_words"], sum(x["stop"] - x["start"] for x in r["hit_words"]), len(r["items"]), brute.sha(",".join(r["items"])), bool(r["items"])) for r in hits.collect())
    assert got == ordered(want)


def test_contamination_empty(spark):
    bench = spark.createDataFrame([], "item_id long, text string")
    assert {r["contaminated"] for r in contamination(frame(spark, ODD), bench).collect()} == {False}
    assert contamination(frame(spark, []), bench).count() == 0


SUBSTRING = ("doc_id", "n_words", "n_removed", "kept_sha256")


def test_substrings(spark):
    _, data = documents(spark)
    want = brute.substring_digest(data, 35)
    assert any(x[2] for x in want)
    assert rows(QUERIES["op8_substring_dedup"](spark, SF_DIR), *SUBSTRING) == ordered(want)


@pytest.mark.parametrize("window", [1, 2, 5, 35])
def test_substrings_odd(spark, window):
    got = repeated_windows(frame(spark, ODD), window, slice_rows=3, buckets=5)
    got = ordered((r["doc_id"], r["n_words"], r["n_removed"], brute.sha(r["kept"])) for r in got.collect())
    assert got == ordered(brute.substring_digest(ODD, window))
    assert substring_digest(frame(spark, []), window).count() == 0


def test_substrings_share_one_shuffle_of_the_texts(spark):
    df = repeated_windows(frame(spark, ODD))
    df.collect()
    plan = df._jdf.queryExecution().executedPlan().toString().split("== Initial Plan ==")[0]
    assert plan.count("ReusedExchange") >= 3


def test_simhash(spark):
    _, data = documents(spark)
    want = [(i, f"{p:016x}", c) for i, p, c in brute.simhash_groups(data)]
    assert any(i != c for i, _, c in want)
    assert rows(QUERIES["op9_simhash"](spark, SF_DIR), "doc_id", "fingerprint", "component_id") == ordered(want)


@pytest.mark.parametrize("radius", [0, 2, 4])
def test_simhash_odd(spark, radius):
    got = rows(simhash_groups(frame(spark, ODD), 3, radius), "doc_id", "fp", "component_id")
    want = ordered((i, p - (1 << 64) if p >> 63 else p, c) for i, p, c in brute.simhash_groups(ODD, 3, radius))
    assert got == want
    assert simhash_groups(frame(spark, [])).count() == 0


def test_chains_become_one_group(spark):
    from hailgrid.llm.components import connected

    links = [(k, k + 1) for k in range(0, 40)] + [(100, 101), (101, 100), (102, 102)]
    got = {(r["node"], r["root"]) for r in connected(spark.createDataFrame(links, "u long, v long")).collect()}
    assert got == {(k, 0) for k in range(41)} | {(100, 100), (101, 100)}

"""Very long, deep and repeated inputs, memory of tables, and what rejects a language."""

import inspect
import os
import pickle
import random
import sys
import time
import tracemalloc

import numpy as np
import pyarrow as pa
import pyarrow.parquet as pq
import pytest

sys.path.insert(0, os.path.dirname(__file__))

import brute
from hailgrid.llm import decontaminate, language, pages, pii, simhash
from hailgrid.llm.substrings import repeated_windows
from test_corpus import ODD, SF_DIR, frame, ordered, rows

LONG = " ".join(f"Sentence {k} of a text that goes on for a while." for k in range(12))


# ---- pages

def test_a_hundred_thousand_open_elements():
    n = 100_000
    deep = {
        "div": "<div>" * n + f"<p>{LONG}</p>",
        "p in table": "<p><table>" + "<div>" * n + f"<p>{LONG}</p>",
        "li": "<li>" * n + f"<p>{LONG}</p>",
        "li in div": "<ul><li>" + "<div><li>" * (n // 2) + f"<p>{LONG}</p>",
        "li far below": "<li><ul>" + "<div>" * (n // 2) + "<li>" * (n // 2) + f"<p>{LONG}</p>",
        "end tags": "<div>" * (n // 2) + "</section>" * (n // 2) + f"<p>{LONG}</p>",
    }
    for name, html in deep.items():
        began = time.process_time()
        assert pages.main_text(html) == LONG, name
        assert time.process_time() - began < 10, name


WITHOUT_ARTICLE = [
    (f"<body><div><a href=a>Home</a><a href=b>News</a><a href=c>About</a></div><div><h1>Title</h1><p>{LONG}</p><p>End.</p></div>"
     "<div><a href=x>one</a> <a href=y>two</a> <a href=z>three</a></div></body>", f"Title\n\n{LONG}\n\nEnd."),
    (f"<body><ul><li><a href=a>Home</a></li><li><a href=b>News</a></li></ul><section><p>{LONG}</p><p>{LONG}</p></section>"
     "<div><ul><li><a href=x>x</a></li><li><a href=y>y</a></li><li><a href=z>z</a></li></ul></div></body>", f"{LONG}\n\n{LONG}"),
]


@pytest.mark.parametrize("html, want", WITHOUT_ARTICLE)
def test_ratios_choose_where_no_tag_says(html, want):
    assert pages.main_text(html) == want


def test_pages_without_their_article_tag(spark):
    for r in spark.read.parquet(f"{SF_DIR}/pages.parquet").collect():
        renamed = r["html"].replace("<article>", "<div>").replace("</article>", "</div>")
        assert pages.main_text(renamed) == pages.main_text(r["html"])


def test_a_paragraph_ends_however_deep_its_inline_elements_are():
    html = "<article><p>one " + "<b class=x>" * 20 + "two<div>three</div></article>"
    assert pages.main_text(html) == "one two\n\nthree"


# ---- personal data

def test_addresses_are_alike_with_their_dots():
    g = pii.graph("a 10.0.0.1 b 10.0.0.1 c 1.11.1.11 d 11.1.11.1 e", [])
    assert g.skips == [(0, 1)]
    assert pii.shape("9" * 30) != pii.shape("9" * 31)


LOST = {
    "card": [lambda d: f"no. 12 {d}", lambda d: f"ref {d} 7", lambda d: "-".join(d[k : k + 4] for k in range(0, len(d), 4)) + " 03"],
    "phone": [lambda d: f"tel {d}", lambda d: f"call {d[:3]} {d[3:6]} {d[6:]}", lambda d: f"fax {d[:4]}-{d[4:7]}-{d[7:]}"],
}


def test_values_that_patterns_miss_are_found_by_their_other_occurrence():
    """A number of the document once more, in a form no pattern takes, far from the first."""
    texts = pq.read_table(f"{os.path.dirname(SF_DIR)}/sf0.1/documents.parquet").column("text").to_pylist()
    f = pii.factors([(*key, n) for key, n in pii.fit_counts(texts).items() if n > 1 or key[0] not in ("node", "number")])
    rng = random.Random(3)
    planted = found = elsewhere = 0
    for text in texts:
        numbers = [(a, b, kind) for a, b, kind in pii.base_spans(text or "") if kind in LOST]
        if not numbers:
            continue
        a, b, kind = rng.choice(numbers)
        digits = "".join(c for c in text[a:b] if c.isdigit())
        again = rng.choice(LOST[kind])(digits)
        at = len(text) + len(" Please note that ")
        [(base, spans)] = pii.find_spans([f"{text} Please note that {again} is on file."], f)
        if any(x < at + len(again) and at < y for x, y, _ in base):
            continue  # the patterns take it
        added = [s for s in spans if s not in base]
        there = [s for s in added if s[0] < at + len(again) and at < s[1]]
        planted, found, elsewhere = planted + 1, found + bool(there), elsewhere + len(added) - len(there)
    assert planted > 200 and found >= 0.99 * planted and elsewhere <= 0.01 * planted


# ---- benchmark

def test_tables_of_a_full_pass_are_small():
    rng = random.Random(1)
    words = ["".join(rng.choice("abcdefghijklmnop") for _ in range(rng.randrange(2, 9))) for _ in range(20_000)]
    items, size = [], 0
    while size < decontaminate.PASS_BYTES:
        items.append((str(len(items)), " ".join(rng.choices(words, k=rng.randrange(5, 400)))))
        size += len(items[-1][1])
    tracemalloc.start()
    tables = decontaminate.window_tables(items, 10)
    _, peak = tracemalloc.get_traced_memory()
    tracemalloc.stop()
    assert len(pickle.dumps(tables)) < 100e6 and peak < 300e6
    text = " ".join(rng.choices(words, k=500)) + " " + " ".join(items[7][1].split()[:10]) + " tail"
    _, runs, found = decontaminate.scan(pa.array([text, items[3][1], "nothing"]), tables)
    assert runs[0][-1] == (500, 510) if len(items[7][1].split()) >= 10 else True
    assert "3" in found[1] and not found[2]


@pytest.mark.parametrize("pass_bytes", [30, 200])
def test_passes_end_in_tables(spark, pass_bytes):
    items = [(1, "W5 w6, w7 w8 w9 w10 w11 w12 w13 w14 w15 w16"), (1, "alpha beta"), (None, "gamma delta epsilon"), (2, "one"), (2, "one")]
    bench = spark.createDataFrame(items, "item_id long, text string")
    docs = frame(spark, ODD)
    hits = decontaminate.benchmark_hits(docs, bench, pass_bytes=pass_bytes)
    if pass_bytes == 30:
        assert "MapInArrow" in (plan := hits._jdf.queryExecution().executedPlan().toString()) and plan.count("MapInArrow") == 1
    want = brute.contamination(ODD, [("" if i is None else i, t) for i, t in items])
    assert ordered((r["doc_id"], len(r["items"])) for r in hits.collect()) == ordered((x[0], x[3]) for x in want)
    assert rows(decontaminate.uncontaminated(docs, bench, pass_bytes=pass_bytes), "doc_id") == ordered((x[0],) for x in want if not x[-1])


# ---- repeated windows

@pytest.mark.parametrize("copies", [2, 300])
def test_rows_alike_travel_as_one(spark, copies):
    text = " ".join(f"w{k}" for k in range(60))
    data = [(1, text)] * copies + [(2, text + " tail"), (3, "x y z"), (None, None), (None, None), (4, " ".join(f"v{k}" for k in range(50)))]
    got = repeated_windows(frame(spark, data), 5, slice_rows=2, slice_bytes=200, buckets=3)
    assert ordered((r["doc_id"], r["n_words"], r["n_removed"], brute.sha(r["kept"])) for r in got.collect()) == ordered(brute.substring_digest(data, 5))


# ---- fingerprints

def test_links_of_close_fingerprints(spark):
    rng = random.Random(5)
    flip = lambda x, n: x ^ sum(1 << b for b in rng.sample(range(64), n))
    some = {rng.getrandbits(64) for _ in range(300)}
    for x in list(some)[:150]:
        some |= {flip(x, n) for n in (1, 2, 2, 3, 4)}
    some |= {0, 1, 3, 7, (1 << 64) - 1, (1 << 64) - 2, 1 << 63}
    fps = sorted(some)
    table = spark.createDataFrame([(x - (1 << 64) if x >> 63 else x,) for x in fps], "fp long")
    for radius in (0, 1, 2, 4):
        got = {frozenset((r["a"] % (1 << 64), r["b"] % (1 << 64))) for r in simhash.pivot_links(table, radius).collect()}
        want = {frozenset((a, b)) for n, a in enumerate(fps) for b in fps[n + 1 :] if (a ^ b).bit_count() <= radius}
        assert got == want
    assert simhash.pivot_links(table.limit(0), 2).count() == 0


# ---- language

def docstrings(names):
    out = []
    for name in names:
        module = __import__(name, fromlist=["x"])
        members = [getattr(module, n) for n in dir(module)]
        members += [getattr(c, n, None) for c in members if inspect.isclass(c) for n in dir(c)]
        texts = dict.fromkeys(d for m in members if isinstance(d := getattr(m, "__doc__", None), str) and len(d) > 150)
        out.append(" ".join(" ".join(t.split()) for t in texts))
    return out


def test_prose_of_another_kind_stays(spark):
    """English of modules that played no part in choosing the bars."""
    known = spark.read.parquet(f"{os.path.dirname(SF_DIR)}/sf0.1/documents.parquet")
    model = language.fitted_model(known)
    texts = docstrings(["ftplib", "imaplib", "inspect", "ast", "optparse", "pdb", "doctest", "difflib", "string", "textwrap", "calendar", "locale", "codecs", "heapq", "fractions", "smtplib", "traceback", "turtle", "ipaddress", "contextlib", "enum", "warnings", "selectors", "queue", "sched", "uuid", "weakref", "configparser", "cmd", "mailbox"])
    for size in (200, 500, 1000, 2000):
        parts = [t[k : k + size] for t in texts for k in range(0, len(t) - size + 1, size)]
        found = [model.predict(parts[a:b]) for a, b in language.chunks(parts)]
        gone = np.concatenate([f[2] for f in found])
        assert len(parts) > 50 and gone.mean() < 0.02, (size, len(parts), gone.mean())


def test_nearest_centroid_n_gram_by_n_gram(spark):
    table = spark.read.parquet(f"{SF_DIR}/documents.parquet")
    model = language.fitted_model(table)
    texts = [r["text"] for r in table.collect() if language.has_letter(r["text"])][:60] + ["zzqxj " * 80, "Ünï, CÖDÉ -- 12", "a"]
    labels, scores, rejected = model.predict(texts)
    for text, label, score, gone in zip(texts, labels, scores, rejected, strict=True):
        want, best, second, n = brute.language(model, text)
        assert label == want and abs(score - best) < 1e-4
        size = np.log2(n)
        bar = model.least[min(int(size), len(model.least) - 1)]
        very_far = best < bar * np.clip(0.54 + 0.12 * (size - 9.2), 0.4, 0.72)
        ambiguous = second > best * np.clip(0.935 - 0.03 * (size - 9.2), 0.86, 1.0)
        assert gone == (best < bar and (very_far or ambiguous))

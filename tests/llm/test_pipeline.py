"""Each stage on its own input, and the whole run."""

import os
import sys

sys.path.insert(0, os.path.dirname(__file__))

import brute
import corpus_pipeline
from hailgrid.llm import language
from test_corpus import ODD, SF_DIR, frame
from test_text_operators import check_packing

STAGES = dict(corpus_pipeline.STAGES)


def test_stages_in_order(spark, tmp_path):
    docs = spark.read.parquet(f"{SF_DIR}/documents.parquet")
    before = [tuple(r) for r in docs.collect()]
    for k, (name, stage) in enumerate(corpus_pipeline.STAGES):
        out = stage(spark, docs, SF_DIR)
        out.write.parquet(str(tmp_path / str(k)))
        if name != "packing":
            assert out.schema.simpleString() == docs.schema.simpleString()
        docs = spark.read.parquet(str(tmp_path / str(k)))
        after = [tuple(r) for r in docs.collect()]
        texts = [(r[0], r[1]) for r in before]
        if name == "language":
            gone = {r[0] for r in before} - {r[0] for r in after}
            assert gone == {i for i, t in texts if not language.has_letter(t)}
        elif name == "near_copies":
            groups = brute.simhash_groups(texts)
            assert {r[0] for r in after} == {c for _, _, c in groups} and len(after) == len({c for _, _, c in groups})
        elif name == "decontamination":
            items = [tuple(r) for r in spark.read.parquet(f"{SF_DIR}/benchmark.parquet").collect()]
            assert {r[0] for r in after} == {x[0] for x in brute.contamination(texts, items) if not x[-1]}
        elif name == "personal_data":
            new = {r[0]: r for r in after}
            assert set(new) == {r[0] for r in before}
            assert not any(brute.base_spans(r[1]) for r in after)
            assert all(new[i][1] == t for i, t in texts if not any(c.isdigit() or c == "@" for c in t))
            assert all(r[4] == len(r[1]) for r in after)
        else:
            check_packing(docs.collect(), texts)
        before = after
    whole = corpus_pipeline.run(spark, SF_DIR)
    assert sorted((r["doc_id"], r["piece"], r["ids_crc32"]) for r in whole.collect()) == sorted((r["doc_id"], r["piece"], r["ids_crc32"]) for r in docs.collect())


def test_stages_on_odd_rows(spark):
    odd = frame(spark, ODD).withColumnRenamed("items", "n_chars_2")
    for name, stage in corpus_pipeline.STAGES:
        out = stage(spark, odd, SF_DIR)
        assert name == "packing" or out.columns == odd.columns
        out.collect()
        assert stage(spark, odd.limit(0), SF_DIR).count() == 0
    kept = [tuple(r)[:2] for r in STAGES["near_copies"](spark, odd, SF_DIR).collect()]
    groups = {c for _, _, c in brute.simhash_groups(ODD)}
    assert len(kept) == len(groups) and {i for i, _ in kept} == groups


def test_near_copies_leave_columns_of_any_name_alone(spark):
    names = ["doc_id", "text", "_id", "_hash", "_none", "ID", "Hash", "row", "fp", "keep"]
    data = [(1, "a b c d", "mongo-1", "h1", "n", 1.5, "H", 7, "f", None), (2, "A B C D", "mongo-2", "h2", "n", 2.5, "H", 8, "f", "k"), (3, "other words altogether", None, "h3", "n", 3.5, "H", 9, "f", "k")]
    kinds = "doc_id long, text string, _id string, _hash string, _none string, ID double, Hash string, row int, fp string, keep string"
    docs = spark.createDataFrame(data, kinds)
    out = STAGES["near_copies"](spark, docs, SF_DIR)
    assert out.columns == names and out.dtypes == docs.dtypes
    assert sorted(tuple(r) for r in out.collect()) == [data[0], data[2]]

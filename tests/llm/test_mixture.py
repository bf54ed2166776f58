from pyspark.sql import functions as F
from llm_frames import frame  # noqa: F401

from tidemill.llm import mixture


def test_targets_and_takes(frame):
    rows = [(i, "w " * (1 + i % 7), ("a", "b", "c", "d", None)[i % 5]) for i in range(600)]
    got = mixture.mix(frame(rows))
    per = got.groupBy("source_size", "target").agg(F.sum("taken").alias("taken")).collect()
    assert abs(sum(r.target for r in per) - 1.5 * sum(r.source_size for r in per)) < 1e-6
    for r in per:
        assert r.target <= 2 * r.source_size + 1e-9 and abs(r.taken - r.target) <= 7
    assert got.where("taken > 2 * size").count() == 0


def test_larger_budget_takes_a_superset(frame):
    docs = frame([(i, "w w", "a" if i % 2 else "b") for i in range(300)])
    taken = [{r.doc_id for r in mixture.mix(docs, share=s, most=1.0).where("copies > 0").collect()} for s in (0.2, 0.4, 0.9)]
    assert taken[0] < taken[1] < taken[2]


def test_edges_of_the_input(frame):
    rows = [(1, None, "a"), (2, "", "a"), (3, "x y", None), (3, "x y", None), (None, "z", ""), (4, "word " * 40_000, "b")]
    got = {(r.doc_id, r.size) for r in mixture.mix(frame(rows)).collect()}
    assert got == {(1, 0), (2, 0), (3, 2), (None, 1), (4, 40_000)}
    assert mixture.mix(frame(rows)).count() == len(rows)
    assert mixture.mix(frame(rows).where("doc_id > 99")).count() == 0


def test_mixed_rows_match_the_plan(frame):
    docs = frame([(i, "w " * (i % 9), ("a", "b", "c", None)[i % 4]) for i in range(200)])
    plan = {r.doc_id: r.copies for r in mixture.mix(docs).collect()}
    rows = mixture.mixed(docs)
    assert rows.columns == docs.columns
    got = {r.doc_id: r["count"] for r in rows.groupBy("doc_id").count().collect()}
    assert got == {k: v for k, v in plan.items() if v}

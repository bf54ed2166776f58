"""Helpers of the operators."""

from llm_frames import frame  # noqa: F401

from tidemill.llm.common import without


def test_without_runs_no_python_on_the_executors(frame):
    rows = [(i, f"t{i}") for i in [*range(500), 5, 7, -3]] + [(None, "n"), (None, "n")]
    docs, leaving = frame(rows), frame([(i, "") for i in [*range(0, 500, 3), -3, None]]).select("doc_id")
    left = without(docs, leaving)
    want = [r for r in rows if r[0] is None or r[0] % 3]
    assert sorted(map(tuple, left.select("doc_id", "text").collect()), key=str) == sorted(want, key=str)
    assert "Eval" not in left._jdf.queryExecution().executedPlan().toString()


def test_without_keeps_one_of_the_doubtful(frame):
    docs, ids = frame([(1, "a"), (1, "a"), (1, "b"), (2, "c"), (2, "c"), (3, "d"), (None, "n")]), frame([(3, ""), (1, "")]).select("doc_id")
    left = without(docs, ids.where("doc_id = 3"), ids.where("doc_id = 1"))
    assert sorted(map(tuple, left.select("doc_id", "text").collect()), key=str) == sorted([(1, "a"), (1, "b"), (2, "c"), (2, "c"), (None, "n")], key=str)

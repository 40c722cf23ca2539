"""op7: Python workers at a time."""

from rootloom.llm import substring


def test_a_task_has_one_python_worker(spark):
    """Windows are found and filtered in one step; two steps in a row keep two workers and two sets of Arrow buffers per task."""
    words = [f"w{i}" for i in range(40)]
    docs = spark.createDataFrame([(1, " ".join(words)), (2, "x " + " ".join(words[5:30]) + " y"), (3, None)], "doc_id long, text string")
    found = substring.repeated_windows(docs, 8, 4, 2 ** 15, 4)
    lines = [line for line in found._jdf.queryExecution().optimizedPlan().toString().split("\n") if "MapInArrow" in line]
    assert len(lines) == 2, lines  # blocks, and single windows
    out = {r.doc_id: (r.n_words, r.n_removed, r.kept) for r in substring.remove_repeats(docs, 8, 4, 2 ** 15, 4).collect()}
    assert out == {1: (40, 0, " ".join(words)), 2: (27, 25, "x y"), 3: (0, 0, "")}

"""Line runs against a plain count: batches of which later ones repeat lines of earlier ones, and an empty batch."""

from collections import defaultdict

from tickloom.llm import lines
from tickloom.llm.lines import LineRuns

BATCHES = [
    [(1, 10, 0), (1, 11, 0), (1, 10, 0), (2, 10, 0)],
    [(3, 10, 0), (3, 12, 5), (4, 12, 6)],
    [],
    [(5, 11, 0), (5, 12, 5), (6, 13, 1), (7, 10, 0)],
    [(8, 14, 0), (9, 13, 1)],
]


def test_runs_hold_each_line_once_and_count_all(spark, tmp_path):
    runs, want = LineRuns(spark, str(tmp_path / "runs"), fan_in=2), defaultdict(set)
    assert runs.merged().count() == 0
    for batch in BATCHES:
        runs.ingest(spark.createDataFrame(batch, "did long, a long, b long"))
        for did, a, b in batch:
            want[a, b].add(did)
    held = [(r.a, r.b) for r in runs.held().collect()]
    assert sorted(held) == sorted(want) and all(len(level) < 2 for level in runs.levels)
    assert len(runs.again) < 2  # counts beside the runs are summed up
    assert {(r.a, r.b): (r.n, r.top) for r in runs.merged().collect()} == {k: (len(v), max(v)) for k, v in want.items()}


def test_batches_are_read_from_their_own_folders(spark, monkeypatch):
    read = []

    class Watched(LineRuns):
        def ingest(self, batch):
            read.append((batch.inputFiles(), batch._jdf.queryExecution().executedPlan().toString()))
            super().ingest(batch)

    monkeypatch.setattr(lines, "LineRuns", Watched)
    monkeypatch.setattr(lines, "MOST_BATCHES", 7)
    docs = spark.createDataFrame([(i, f"a line that many documents hold\nown line of document number {i}") for i in range(40)], "doc_id long, text string")
    left = lines.dedup_lines(docs, batch_lines=3).collect()
    assert sorted(r.rest.doc_id for r in left if r.n_dropped == 0) == [39] and len(left) == 40
    assert len(read) == 7 and all("PartitionFilters: [isnotnull(batch" in plan for _, plan in read)

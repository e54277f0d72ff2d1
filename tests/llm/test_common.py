"""What workers keep between tasks."""

import pyarrow as pa

from tickloom.llm.common import KEPT, drop_memos, process_memo


def made_in(spark, name, tasks=20):
    def run(batches):
        import os

        made = []
        for _ in batches:
            pass
        process_memo(name, lambda: made.append(1) or object())
        yield pa.RecordBatch.from_arrays([pa.array([os.getpid()], pa.int64()), pa.array([len(made)], pa.int64())], ["pid", "made"])

    return spark.range(0, tasks, 1, tasks).mapInArrow(run, "pid long, made long").collect()


def test_a_worker_makes_a_thing_once(spark):
    rows = made_in(spark, "once") + made_in(spark, "once")
    assert len(rows) == 40
    assert sum(r.made for r in rows) <= len({r.pid for r in rows}) < 40


def test_few_things_are_kept():
    made = []
    for name in ("a", "b", "a", "c", "c", "a"):
        process_memo(name, lambda name=name: made.append(name) or name)
    assert made == ["a", "b", "c", "a"] and KEPT == 2  # the oldest goes
    drop_memos()
    process_memo("a", lambda: made.append("again"))
    drop_memos()
    assert made[-1] == "again"

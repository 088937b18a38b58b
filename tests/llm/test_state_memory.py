"""State stores of the stream do not stay open in the executor."""

from pagewright.llm import exact_dedup
from test_native import ROWS, SCHEMA, norm


def open_stores():
    """RocksDB's working folders that a process of this session holds a lock in."""
    import psutil

    found = set()
    for p in [psutil.Process(), *psutil.Process().children(recursive=True)]:
        found |= {f.path for f in p.open_files() if f.path.endswith("/LOCK") and "StateStore" in f.path}
    return found


def test_stores_are_closed_after_the_stream(spark, tmp_path):
    before = open_stores()
    docs = spark.createDataFrame([(i, t, None, None, None) for i, t in ROWS], SCHEMA)
    narrow = exact_dedup.locators(docs)
    at, state = f"file://{tmp_path}/in", f"file://{tmp_path}/state"
    narrow.write.parquet(at)
    groups = exact_dedup.stream_groups(narrow, at, state)
    assert open_stores() <= before
    assert groups.count() == len({norm(t) for _, t in ROWS})
    narrow.write.mode("append").parquet(at)  # the closed state is found again
    again = exact_dedup.stream_groups(narrow, at, state)
    assert dict(again.select("digest", "group_size").collect()) == {r.digest: 2 * r.group_size for r in groups.collect()}

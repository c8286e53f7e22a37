"""The stream gives the batch result (events are in time order, no late rows)."""

import pytest
from pyspark.sql import functions as F

from tessera.operators.clean import clean_strings
from tessera.session import scratch_path
from tessera.streaming.incremental import dedupe_run, incremental_run, read_file_stream
from tests.conftest import SF001


def fn(df):
    return clean_strings(df).select("event_id", F.upper("event_type").alias("kind"), (F.col("value") * 2).alias("v2"))


def test_stream_equals_batch(spark):
    batch = spark.read.parquet(f"{SF001}/events.parquet")
    out = scratch_path(spark, "w1")
    stream = read_file_stream(spark, f"{SF001}/events.parquet", batch.schema)
    incremental_run(stream, fn, out, scratch_path(spark, "w1ck"))
    assert sorted(spark.read.parquet(out).collect()) == sorted(fn(batch).collect())


def test_stream_foreach_batch_sink(spark):
    batch = spark.read.parquet(f"{SF001}/events.parquet")
    out = scratch_path(spark, "w1csv")
    stream = read_file_stream(spark, f"{SF001}/events.parquet", batch.schema)
    incremental_run(stream, fn, out, scratch_path(spark, "w1csvck"), sink="jsonl")
    back = spark.read.schema("event_id long, kind string, v2 double").json(out)
    assert back.count() == batch.count()


@pytest.mark.parametrize("files", [0, 6])
def test_runs_are_the_same_for_a_file_and_a_folder(spark, files):
    """0: the table as one file; 6: as a folder, one file for each trigger."""
    batch = spark.read.parquet(f"{SF001}/events.parquet")
    path = f"{SF001}/events.parquet"
    if files:
        path = scratch_path(spark, "folder")
        n = batch.count()
        for k in range(files):         # by event id, which is the order of arrival
            batch.where((F.col("event_id") * files / n).cast("int") == k).coalesce(1).write.mode("append").parquet(path)
    read = lambda: read_file_stream(spark, path, batch.schema, max_files_per_trigger=1)
    out = scratch_path(spark, "w1")
    incremental_run(read(), fn, out, scratch_path(spark, "w1ck"))
    assert sorted(spark.read.parquet(out).collect()) == sorted(fn(batch).collect())
    out = scratch_path(spark, "w2")
    q = dedupe_run(read(), ["user_id", "event_type"], ["ts", "event_id"], out, scratch_path(spark, "w2ck"))
    assert len([p for p in q.recentProgress if p.numInputRows]) == max(files, 1)
    keys = spark.read.parquet(out).select("user_id", "event_type")
    assert keys.count() == keys.distinct().count() == batch.select("user_id", "event_type").distinct().count()


def test_first_batch_wins_and_late_rows_count(spark):
    src = scratch_path(spark, "late")
    schema = "event_id long, user_id long, event_type string, ts timestamp"
    import datetime as dt
    day = lambda k: dt.datetime(2024, 1, 1 + k)
    batches = [[(1, 7, "a", day(20)), (2, 7, "a", day(19)), (3, None, "a", day(1))],
               [(4, 7, "a", day(1)), (5, 8, "a", day(0)), (6, None, "a", day(0))],      # older than what came first
               [(7, 8, "a", day(0)), (8, 9, None, day(0)), (9, 9, None, day(0))]]
    out, check = scratch_path(spark, "late_out"), scratch_path(spark, "late_ck")
    for rows in batches:
        spark.createDataFrame(rows, schema).coalesce(1).write.mode("append").parquet(src)
        dedupe_run(read_file_stream(spark, src, spark.read.parquet(src).schema), ["user_id", "event_type"], ["ts", "event_id"], out, check)
    assert sorted(r.event_id for r in spark.read.parquet(out).collect()) == [2, 3, 5, 8]


def test_stream_table_sink_replay_safe(spark):
    from tessera.sources.doctable import DocumentTable
    batch = spark.read.parquet(f"{SF001}/events.parquet")
    out = scratch_path(spark, "w1table")
    stream = read_file_stream(spark, f"{SF001}/events.parquet", batch.schema)
    incremental_run(stream, fn, out, scratch_path(spark, "w1tableck"), sink="table")
    t = DocumentTable(spark, out)
    n = t.count()
    assert n == batch.count()
    # the same micro-batch delivered again is skipped
    t.save(fn(batch), run_id="x", target_name="t", batch_key="replayed#0")
    t.save(fn(batch), run_id="x", target_name="t", batch_key="replayed#0")
    assert t.count() == 2 * n


def test_dedupe_state_is_replayed_and_looked_up(spark, monkeypatch):
    """A batch whose sink write failed comes again with the same rows; a batch reads its own keys only."""
    src, out, check = (scratch_path(spark, n) for n in ("w2_src", "w2_out", "w2_ck"))
    schema = "user_id long, event_type string, ts long"
    run = lambda: dedupe_run(read_file_stream(spark, src, schema), ["user_id", "event_type"], ["ts"], out, check)
    add = lambda rows: spark.createDataFrame(rows, schema).coalesce(1).write.mode("append").parquet(src)
    read = lambda: sorted((tuple(r) for r in spark.read.parquet(out).drop("batch_id").collect()), key=str)
    add([(i, "a", 100 - i) for i in range(50)] + [(1, "a", 5)] * 20)
    run()
    first = [(i, "a", 5 if i == 1 else 100 - i) for i in range(50)]
    assert read() == sorted(first, key=str)
    add([(1, "a", 0), (1, "b", 3), (1, "b", 2), (None, None, 1)])
    from pyspark.sql.readwriter import DataFrameWriter
    whole = DataFrameWriter.parquet

    def broken(self, path, *a, **k):
        if "w2_out" in path:
            raise IOError("the sink is away")
        return whole(self, path, *a, **k)

    monkeypatch.setattr(DataFrameWriter, "parquet", broken)
    with pytest.raises(Exception, match="the sink is away"):
        run()
    monkeypatch.undo()
    q = run()                       # the failed batch again
    assert read() == sorted([*first, (1, "b", 2), (None, None, 1)], key=str)
    state = q.lastProgress["stateOperators"][0]
    assert state["numRowsTotal"] == 52 and state["numRowsUpdated"] == 3
    q = run()                       # nothing new: nothing happens
    assert len(read()) == 52


def test_runs_of_micro_batches_are_stored_once(spark, monkeypatch):
    """Results, rejects, errors and log rows of each batch appear together; a batch that failed half-way comes again."""
    from tessera.sources.batches import BatchStore
    from tessera.streaming.incremental import incremental_outputs
    src, path, check = (scratch_path(spark, n) for n in ("runs_src", "runs_store", "runs_ck"))
    schema = "page_id long, url string, html string"
    page = lambda i: (i, f"http://h.example/{i}", f'<p class="r"><b>{i if i % 3 else "n/a"}</b><a href="{"//[x" if i % 4 == 0 else "y"}">l</a></p>')
    add = lambda ids: spark.createDataFrame([page(i) for i in ids], schema).coalesce(1).write.mode("append").parquet(src)
    specs = [{"name": "recs", "extract": {"item_selector": "p.r", "fields": {"n": "b::text", "l": "a::attr(href)"}},
              "cleaner": {"field_validation": {"n": {"type": "int", "required": True}}}},
             {"name": "heads", "extract": {"item_selector": "p.r", "fields": {"t": "b::text"}}}]
    run = lambda: incremental_outputs(read_file_stream(spark, src, schema), specs, path, check)
    add(range(12))
    run()
    add(range(12, 20))
    whole = BatchStore.commit

    def interrupted(self, key, outputs):
        def fails(_):
            raise IOError("lost between two writes")
        return whole(self, key, {**outputs, "run_log": fails})

    monkeypatch.setattr(BatchStore, "commit", interrupted)
    with pytest.raises(Exception, match="lost between"):
        run()
    monkeypatch.undo()
    run()
    run()
    store = BatchStore(spark, path)
    ids = lambda name, target: sorted(r.page_id for r in store.read(name).where(F.col("target_name") == target).collect())
    assert ids("results", "recs") == [i for i in range(20) if i % 3 and i % 4]
    assert ids("rejected", "recs") == [i for i in range(20) if i % 3 == 0 and i % 4] and ids("errors", "recs") == list(range(0, 20, 4))
    assert ids("results", "heads") == list(range(20))
    log = store.read("run_log").where("target_name = 'recs'").orderBy("run_id").collect()
    assert [(r.run_id, r.scraped_count, r.failed_count, r.processed_count) for r in log] == [("run-0", 9, 6, 6), ("run-1", 6, 4, 4)]

"""High-water marks, incremental loads and the streaming load."""

import pytest

from quarrymill.operators import cursors
from quarrymill.operators.cursors import StreamConfig, load_stream
from quarrymill.sinks import store as sinks
from quarrymill.sources.records import scan_cursor
from quarrymill.streaming.file_load import stream_load


def test_cursor_round_trip(store):
    assert cursors.cursor_get(store, "pg", "orders:at") is None
    cursors.cursor_set(store, "pg", "orders:at", "2024-01-01")
    assert cursors.cursor_get(store, "pg", "orders:at") == "2024-01-01"
    cursors.cursor_set(store, "pg", "orders:at", "2024-02-01")
    cursors.cursor_set(store, "pg", "other:at", "x")
    assert cursors.cursor_get(store, "pg", "orders:at") == "2024-02-01"
    cursors.cursor_clear(store, "pg", "orders:at")
    assert cursors.cursor_get(store, "pg", "orders:at") is None
    cursors.compact_cursors(store)
    assert cursors.cursor_get(store, "pg", "other:at") == "x"


def test_next_cursor_is_typed_and_never_falls(frame):
    df = frame("c bigint", (9,), (10,), (None,))
    assert cursors.next_cursor(df, "c").first()["value"] == "10"
    assert cursors.next_cursor(df, "c", "200").first()["value"] == "200"
    assert cursors.next_cursor(df.limit(0), "c", "7").first()["value"] == "7"
    assert cursors.next_cursor(df.limit(0), "c").first()["value"] is None


def _source(frame, *rows):
    df = frame("id int, at bigint, name string", *rows)
    return lambda mark: scan_cursor(df, "at", mark)


def test_incremental_append(store, frame, rows):
    config = StreamConfig(cursor_field="at", initial_value="5")
    first = _source(frame, (1, 4, "old"), (2, 9, "a"), (3, 10, "b"))
    assert load_stream(store, "pg", "sales.orders", first, config).rows == 2
    assert load_stream(store, "pg", "sales.orders", first, config).rows == 0
    later = _source(frame, (3, 10, "b"), (4, 11, "c"))
    assert load_stream(store, "pg", "sales.orders", later, config).rows == 1
    assert rows(store.table("raw_pg_sales_orders"), "id") == [(2,), (3,), (4,)]
    assert cursors.cursor_get(store, "pg", "sales.orders:at") == "11"


def test_merge_load_and_full_refresh(store, frame, rows):
    config = StreamConfig("merge", primary_key="id", cursor_field="at")
    load_stream(store, "pg", "u", _source(frame, (1, 1, "a"), (2, 2, "b")), config)
    load_stream(store, "pg", "u", _source(frame, (1, 3, "a2")), config)
    assert rows(store.table("raw_pg_u")) == [(1, 3, "a2"), (2, 2, "b")]
    load_stream(store, "pg", "u", _source(frame, (7, 1, "z")), config, full_refresh=True)
    assert rows(store.table("raw_pg_u")) == [(7, 1, "z")]
    assert cursors.cursor_get(store, "pg", "u:at") == "1"


def test_a_failed_load_leaves_the_mark(store, frame):
    config = StreamConfig("merge", primary_key="id", cursor_field="at")
    load_stream(store, "pg", "u", _source(frame, (1, 1, "a")), config)
    with pytest.raises(ValueError, match="duplicated"):
        load_stream(store, "pg", "u", _source(frame, (2, 5, "x"), (2, 6, "y")), config)
    assert cursors.cursor_get(store, "pg", "u:at") == "1"


def test_load_rules(store, frame):
    source = _source(frame, (1, 1, "a"))
    with pytest.raises(ValueError, match="requires primary_key"):
        load_stream(store, "pg", "u", source, StreamConfig("merge"))
    with pytest.raises(ValueError, match="composite"):
        load_stream(store, "pg", "u", source, StreamConfig("merge", primary_key=["a", "b"]))
    with pytest.raises(ValueError, match="unknown load strategy"):
        load_stream(store, "pg", "u", source, strategy="upsert")
    assert load_stream(store, "pg", "u", source, StreamConfig("merge"), unique_key="id").rows == 1
    assert load_stream(store, "pg", "w", source).rows == 1


def test_timestamp_marks_come_back_as_they_went(store, spark):
    events = spark.read.parquet("/root/testdata/sf0.001/events.parquet")
    config = StreamConfig(cursor_field="ts")
    load_stream(store, "ch", "events", lambda mark: scan_cursor(events, "ts", mark), config)
    again = load_stream(store, "ch", "events", lambda mark: scan_cursor(events, "ts", mark), config)
    assert again.rows == 0


def test_stream_takes_up_only_new_files(store, spark, frame, rows, tmp_path):
    landing, checkpoint = str(tmp_path / "in"), str(tmp_path / "checkpoint")
    for wave in ([(1, "a")], [(2, "b"), (3, "c")], []):
        if wave:
            frame("id int, name string", *wave).write.mode("append").parquet(landing)
        stream_load(store, "s", landing, "id int, name string", checkpoint).awaitTermination()
    assert rows(store.table("s")) == [(1, "a"), (2, "b"), (3, "c")]


def test_stream_batch_that_runs_again_is_not_doubled(store, spark, frame, rows, tmp_path):
    """As after a crash between landing a batch and committing it: the commit is missing."""
    landing, checkpoint = str(tmp_path / "in"), tmp_path / "checkpoint"
    frame("id int", (1,), (2,)).write.parquet(landing)
    stream_load(store, "s", landing, "id int", str(checkpoint)).awaitTermination()
    for left in (checkpoint / "commits").iterdir():
        left.unlink()
    stream_load(store, "s", landing, "id int", str(checkpoint)).awaitTermination()
    assert rows(store.table("s")) == [(1,), (2,)]


def test_stream_merge(store, frame, rows, tmp_path):
    landing, checkpoint = str(tmp_path / "in"), str(tmp_path / "checkpoint")
    for wave in ([(1, "a", 1), (1, "b", 2)], [(1, "c", 3), (2, "d", 1)]):
        frame("id int, name string, n int", *wave).write.mode("append").parquet(landing)
        run = stream_load(store, "s", landing, "id int, name string, n int", checkpoint, "merge", key="id", seq="n")
        run.awaitTermination()
    assert rows(store.table("s")) == [(1, "c", 3), (2, "d", 1)]
    with pytest.raises(ValueError, match="primary_key"):
        stream_load(store, "s", landing, "id int", checkpoint, "merge")


def test_batches_and_streams_share_a_table(store, spark, frame, rows, tmp_path):
    """Appends by batch, by stream, by batch again, compaction, and another run of the stream."""
    landing, checkpoint = str(tmp_path / "in"), str(tmp_path / "check")
    sinks.write_append(store, "s", frame("id int, name string", (1, "a")))
    for k in (2, 5):
        frame("id int, name string", (k, "stream"), (None, "n")).write.mode("append").parquet(landing)
        stream_load(store, "s", landing, "id int, name string", checkpoint).awaitTermination()
        sinks.write_append(store, "s", frame("id int, name string", (k + 1, "batch")))
        sinks.compact(store, "s")
    assert rows(store.table("s")) == [
        (1, "a"), (2, "stream"), (3, "batch"), (5, "stream"), (6, "batch"), (None, "n"), (None, "n"),
    ]


@pytest.mark.parametrize("strategy", ["append", "merge"])
def test_a_batch_that_runs_again_changes_nothing(store, frame, rows, tmp_path, strategy):
    landing, checkpoint = str(tmp_path / "in"), tmp_path / "check"
    frame("id int, name string", (1, "a"), (None, "n")).write.parquet(landing)
    for _ in range(2):
        stream_load(store, "s", landing, "id int, name string", str(checkpoint), strategy, key="id").awaitTermination()
        assert rows(store.table("s")) == [(1, "a"), (None, "n")]
        # As if the job had died before the batch was noted as done.
        for done in (checkpoint / "commits").glob("*"):
            done.unlink()


@pytest.mark.parametrize("max_files", [1, 1000])
def test_merge_by_sequence_does_not_depend_on_batches(store, frame, rows, tmp_path, max_files):
    landing = str(tmp_path / "in")
    for n, name in ((9, "new"), (5, "old")):
        frame("id int, name string, n int", (1, name, n)).coalesce(1).write.mode("append").parquet(landing)
    stream_load(
        store, "s", landing, "id int, name string, n int", str(tmp_path / "c"), "merge", "id", "n", max_files=max_files
    ).awaitTermination()
    assert rows(store.table("s")) == [(1, "new", 9)]


def test_marks_never_fall_and_ties_are_kept(store, frame, rows):
    """Rows at the mark that arrive later are merged in; a late row below it does not move it."""
    config = cursors.StreamConfig("merge", primary_key="id", cursor_field="at", inclusive=True)
    state = []

    def extract(mark):
        return scan_cursor(frame("id int, at bigint", *state), "at", mark, inclusive=True)

    state[:] = [(1, 10), (2, 12)]
    cursors.load_stream(store, "x", "s", extract, config)
    state[:] = [(1, 10), (2, 12), (3, 12)]
    cursors.load_stream(store, "x", "s", extract, config)
    assert rows(store.table("raw_x_s")) == [(1, 10), (2, 12), (3, 12)]
    late = lambda mark: frame("id int, at bigint", (4, 11))
    cursors.load_stream(store, "x", "s", late, config)
    assert cursors.cursor_get(store, "x", cursors.cursor_key("s", "at")) == "12"
    with pytest.raises(ValueError, match="inclusive"):
        cursors.load_stream(store, "x", "t", late, cursors.StreamConfig("append", cursor_field="at", inclusive=True))


def test_all_declared_streams_are_loaded(store, frame):
    streams = {"a": cursors.StreamConfig(identifier="big.a"), "b": cursors.StreamConfig("replace")}
    loaded = cursors.load_streams(store, "x", streams, lambda name, config: lambda mark: frame("id int, t string", (1, name)))
    assert [r.target.split(".")[-1] for r in loaded] == ["raw_x_a", "raw_x_b"]


def test_many_sets_leave_one_small_table(store):
    for n in range(12):
        cursors.cursor_set(store, "shop", f"s{n % 3}", str(n))
    cursors.cursor_clear(store, "shop", "s0")
    assert len(store.versions(cursors.CURSOR_TABLE)) <= 2
    assert store.table(cursors.CURSOR_TABLE).count() == 2
    assert [cursors.cursor_get(store, "shop", f"s{n}") for n in range(3)] == [None, "10", "11"]

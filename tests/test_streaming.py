from __future__ import annotations

import datetime
import pathlib
import random

import pandas as pd
import pytest
from pyspark.sql import functions as F

from tests.rows import feed, item_record, metrics, order_record, record
from tidemark.operators.changes import current_rows, flatten, unreadable
from tidemark.operators.sales import DAY, TIMESTAMP, sales_metrics
from tidemark.schemas import ORDER_ITEMS, ORDERS
from tidemark.session import stateful_session
from tidemark.settings import WATERMARK_DELAY
from tidemark.sources.feeds import decode_json, encode_metrics, file_feed
from tidemark.streaming import closing, revising, views
from tidemark.streaming import joined as joined_module
from tidemark.streaming.joined import joined_sales, start_joined_sales
from tidemark.streaming.revising import RevisingSales
from tidemark.streaming.views import (
    maintain_metrics_days,
    maintain_table,
    stored_metrics_days,
    trigger_options,
)
from tidemark.streaming.windowed import windowed_daily_sales


def batch_result(spark, records, grain=DAY):
    """The metrics of all records at once, by the batch job."""
    changes = {
        t.name: current_rows(flatten(decode_json(feed(spark, records), t), t), t)
        for t in (ORDERS, ORDER_ITEMS)
    }
    return metrics(sales_metrics(changes["order_items"], changes["orders"], grain, "event_ts"))


def run(spark, job, *batches, first=0):
    for number, records in enumerate(batches, first):
        job.apply(spark, feed(spark, records), number)
    return metrics(job.result(spark))


A1 = order_record(1, "2024-01-01 01:00:00", "c", "A", "Pending")
A2 = order_record(2, "2024-01-03 01:00:00", "u", "A", "Completed")
A3 = order_record(3, "2024-01-05 01:00:00", "u", "A", "Cancelled")
A4 = order_record(4, "2024-01-06 01:00:00", "d", "A")
B1 = order_record(5, "2024-01-01 01:00:00", "c", "B", "Completed")
B2 = order_record(6, "2024-02-01 01:00:00", "u", "B", "Completed")
I1 = item_record(11, "2024-01-01 02:00:00", "c", "I1", "A", 1)
I1_MORE = item_record(12, "2024-01-01 05:00:00", "u", "I1", "A", 4)
I1_MOVED = item_record(13, "2024-02-02 05:00:00", "u", "I1", "A", 6)
I2 = item_record(14, "2024-01-01 02:00:00", "c", "I2", "B", 2)
I2_GONE = item_record(15, "2024-03-01 02:00:00", "d", "I2")
LATE = item_record(16, "2023-12-31 02:00:00", "c", "I3", "B", 8)
TOMBSTONE = record("orders", "order_id", "A", 7, "2024-01-07 01:00:00", None)


@pytest.fixture
def job(tmp_path):
    return RevisingSales(str(tmp_path / "job"), buckets=2)


def test_order_completes_then_is_cancelled(spark, job):
    assert run(spark, job, [A1, I1]) == {}
    assert run(spark, job, [A2], first=1) == batch_result(spark, [A1, I1, A2]) != {}
    assert run(spark, job, [A3], first=2) == {}


def test_delete_and_tombstone_remove_an_order(spark, job):
    assert list(run(spark, job, [A1, A2, I1, B1, I2], [A4, TOMBSTONE])) == ["2024-01-01"]
    assert run(spark, job, [I1_MORE], first=2)["2024-01-01"][:2] == (1, 2)


def test_items_change_move_and_go(spark, job):
    batches = [A2, I1, B1, I2], [I1_MORE], [I1_MOVED, LATE], [I2_GONE, B2]
    assert run(spark, job, *batches) == batch_result(spark, sum(batches, []))


def test_older_version_after_a_newer_one_changes_nothing(spark, job):
    run(spark, job, [A2, I1_MOVED], [A1, I1], [A4])
    assert run(spark, job, [A3], first=3) == {}
    assert metrics(job.result(spark)) == batch_result(spark, [A2, I1_MOVED, A1, I1, A4, A3])


def test_repeated_version_and_repeated_batch_do_not_double(spark, job):
    expected = batch_result(spark, [B1, I2])
    assert run(spark, job, [B1, I2], [B2]) == expected
    assert run(spark, job, [B2], first=1) == expected


@pytest.mark.parametrize(("grain", "seed"), [(DAY, 1), (DAY, 2), (TIMESTAMP, 3)])
def test_any_split_gives_the_batch_result(spark, job, grain, seed):
    records = [A1, A2, A3, B1, B2, I1, I1_MORE, I1_MOVED, I2, LATE]
    shuffled = random.Random(seed).sample(records, len(records))
    job = RevisingSales(job.root, grain, buckets=2)
    got = run(spark, job, shuffled[:3], shuffled[3:6], shuffled[6:])
    assert got == batch_result(spark, records, grain) != {}


@pytest.mark.parametrize(
    "broken_step", ["_merge_order_days", "_merge_silver", "_merge_sums", "_add_deltas"])
def test_batch_that_failed_midway_can_run_again(spark, job, monkeypatch, broken_step):
    run(spark, job, [A2, B1, I1, I2])
    whole = getattr(RevisingSales, broken_step)
    calls = []

    def fail(self, *args):
        calls.append(args)
        if broken_step != "_merge_silver" or len(calls) == 2:
            raise RuntimeError("driver lost")
        whole(self, *args)

    monkeypatch.setattr(RevisingSales, broken_step, fail)
    with pytest.raises(RuntimeError):
        run(spark, job, [A3, I1_MOVED, LATE], first=1)
    monkeypatch.undo()
    again = [A3, I1_MOVED, LATE]
    assert run(spark, job, again, first=1) == batch_result(spark, [A2, B1, I1, I2, *again])


def test_items_without_a_quantity_add_nothing(spark, job, tmp_path):
    bare = item_record(90, "2024-01-01 06:00:00", "c", "N1", "B", None)
    want = {"2024-01-01": (1, 2)}

    def counted(found):
        return {d: m[:2] for d, m in found.items()}

    assert counted(run(spark, job, [B1, bare], [I2])) == want
    assert counted(run(spark, job, [item_record(91, "2024-01-01 07:00:00", "u", "N1", "B", 5)], first=2)) == {
        "2024-01-01": (1, 7)}


def test_a_total_takes_a_delta_once(spark, job, monkeypatch):
    """A batch that added its deltas but did not get to say so is run again."""
    records = [A2, B1, I1, I2], [A3, I1_MOVED, LATE]
    run(spark, job, *records)
    for _ in range(2):
        assert run(spark, job, records[1], first=1) == batch_result(spark, sum(records, []))


def test_a_row_is_moved_once_a_batch_and_says_what_it_replaced(spark, job, monkeypatch):
    """One exchange by key brings the batch and the stored rows together, and none follows."""
    run(spark, job, [A2, I1])
    plans, write = [], revising.overwrite_partitions

    def recorded(rows, path, *partitions):
        if "/silver/" in path:
            plans.append(rows._jdf.queryExecution().sparkPlan().toString()
                         + rows._jdf.queryExecution().executedPlan().toString())
        write(rows, path, *partitions)

    monkeypatch.setattr(revising, "overwrite_partitions", recorded)
    for _ in range(2):
        assert run(spark, job, [A3, I1_MORE], first=1) == {}
        items = job._silver(spark, ORDER_ITEMS).select("batch_id", "quantity", "replaced.quantity")
        assert [tuple(r) for r in items.collect()] == [(1, 4, 1)]
    assert len(plans) == 4 and all(p.count("Exchange ") == 1 for p in plans)


def _files(root, *parts):
    return [p for part in parts for p in root.glob(f"{part}/**/*.parquet")]


def test_a_batch_of_many_records_is_not_parsed_to_find_its_buckets(spark, job, monkeypatch):
    asked, values_of = [], revising.values_of

    def recorded(rows, column):
        asked.append("from_json" in rows._jdf.queryExecution().optimizedPlan().toString())
        return values_of(rows, column)

    monkeypatch.setattr(revising, "values_of", recorded)
    monkeypatch.setattr(revising, "MANY", 0)
    batches = [A1, A2, I1, B1, I2], [I1_MOVED, A3, LATE], [I2_GONE, TOMBSTONE]
    assert run(spark, job, *batches) == batch_result(spark, sum(batches, []))
    assert asked and not any(asked)


def test_a_changed_order_reads_its_own_buckets_and_months_only(spark, tmp_path):
    """All other files are broken before the batch; reading one would end it."""
    job, buckets = RevisingSales(str(tmp_path / "job"), buckets=16), 16
    orders, items = [], []
    for i in range(40):
        orders.append(order_record(i, "2024-01-01 01:00:00", "c", f"O{i}", "Completed"))
        items += [item_record(100 + 3 * i + k, f"2024-0{1 + (i + k) % 9}-02 02:00:00", "c", f"I{i}-{k}",
                              f"O{i}", 1) for k in range(3)]
    run(spark, job, orders + items)
    expected = batch_result(spark, [
        *orders, *items, order_record(500, "2024-02-01 01:00:00", "u", "O7", "Cancelled")])

    def bucket(*key):
        row = spark.createDataFrame([key]).select(F.pmod(F.xxhash64("*"), F.lit(buckets)))
        return row.first()[0]

    days = [datetime.date(2024, 1 + (7 + k) % 9, 2) for k in range(3)]
    of_order, of_sums = bucket("O7"), {bucket("O7", d) for d in days}
    root, broken = tmp_path / "job", 0
    keep = {f"bucket={of_order}"}, {f"bucket={b}" for b in of_sums}, {"sale_month=2024%02d" % d.month for d in days}
    for kept, parts in zip(keep, (["silver/orders", "order_days"], ["sums"], ["totals"])):
        for file in _files(root, *parts):
            if file.parent.name not in kept:
                file.write_bytes(b"broken")
                broken += 1
    for file in _files(root, "silver/order_items", "bronze/batch_id=0", "changed", "pairs", "deltas"):
        file.write_bytes(b"broken")
        broken += 1
    assert broken > 40
    job.apply(spark, feed(spark, [order_record(500, "2024-02-01 01:00:00", "u", "O7", "Cancelled")]), 1)
    got = metrics(job.revised(spark, 1))
    assert got == {str(d): expected[str(d)] for d in days}


def test_old_batches_are_expired(spark, job):
    batches = [A2, I1, B1], [I2], [I1_MORE], [A3]
    expected = batch_result(spark, sum(batches, []))
    for number, records in enumerate(batches):
        run(spark, job, records, first=number)
        job.expire(spark, 2)
    assert metrics(job.result(spark)) == expected
    root = pathlib.Path(job.root)
    assert sorted(p.name for p in (root / "deltas").iterdir()) == ["batch_id=2", "batch_id=3"]
    assert len(list((root / "bronze").glob("batch_id=*"))) == 4
    job.expire(spark, 1, feed_too=True)
    assert len(list((root / "bronze").glob("batch_id=*"))) == 1
    assert run(spark, job, [I1_MOVED], first=4) == batch_result(spark, [*sum(batches, []), I1_MOVED])


def test_unreadable_records_are_kept_aside(spark, job):
    garbage = (*A1[:5], "{broken")
    run(spark, job, [garbage, B1, I2])
    assert job.set_aside(spark, ORDERS).count() == 1
    assert [r.order_id for r in job.current(spark, ORDERS).collect()] == ["B"]


def test_stream_resumes_from_its_progress(spark, job, tmp_path):
    landing = str(tmp_path / "feed")
    seen, sent = [], []
    for part in ([A1, I1, B1], [A2, I2], [A3, LATE]):
        seen += part
        feed(spark, part).write.mode("append").parquet(landing)
        stream = file_feed(spark, landing)
        job.start(stream, run_once=True, on_revised=lambda df: sent.append(metrics(df))).awaitTermination()
        assert metrics(job.result(spark)) == batch_result(spark, seen)
    assert [sorted(days) for days in sent] == [[], ["2024-01-01"], ["2023-12-31", "2024-01-01"]]


def test_view_appends_every_version_once(spark, tmp_path):
    landing, table, progress = (str(tmp_path / n) for n in ("feed", "orders", "progress"))
    for part in ([A1, A2, I1], [A3, A4]):
        feed(spark, part).write.mode("append").parquet(landing)
        maintain_table(file_feed(spark, landing), ORDERS, table, progress, run_once=True).awaitTermination()
    rows = spark.read.parquet(table)
    assert sorted(r.status for r in rows.collect()) == ["Cancelled", "Completed", "Pending"]
    assert rows.where("kafka_ts IS NULL").isEmpty()
    assert rows.select("kafka_ts").distinct().count() == 2


def test_withdrawn_days_are_sent_without_measures(spark, job):
    run(spark, job, [A2, I1])
    assert encode_metrics(job.revised(spark, 0)).first().value is not None
    run(spark, job, [A3], first=1)
    assert [(str(r.sale_date), r.total_orders) for r in job.revised(spark, 1).collect()] == [
        ("2024-01-01", None)]
    sent = encode_metrics(job.revised(spark, 1)).collect()
    assert [(r.key[:17], r.value) for r in sent] == [('{"ts":"2024-01-01', None)]


def test_another_number_of_buckets_is_refused(spark, job):
    run(spark, job, [A2, I1])
    with pytest.raises(ValueError, match="2 buckets"):
        run(spark, RevisingSales(job.root, buckets=7), [I1_MORE], first=1)
    again = RevisingSales(job.root)
    assert run(spark, again, [I1_MORE], first=1) == batch_result(spark, [A2, I1, I1_MORE])


def test_view_sets_unreadable_changes_aside(spark, tmp_path):
    landing, table, progress = (str(tmp_path / n) for n in ("feed", "orders", "progress"))
    feed(spark, [A1, (*A1[:5], "{broken")]).write.parquet(landing)
    maintain_table(file_feed(spark, landing), ORDERS, table, progress, run_once=True).awaitTermination()
    assert spark.read.parquet(table).count() == 1
    assert spark.read.parquet(f"{table}_aside").count() == 1


def test_view_looks_for_unreadable_changes_only_if_it_counted_some(spark, tmp_path, monkeypatch):
    landing, table, progress = (str(tmp_path / n) for n in ("feed", "orders", "progress"))
    looked = []
    monkeypatch.setattr(views, "unreadable", lambda *given: looked.append(1) or unreadable(*given))

    def step(*records):
        feed(spark, records).write.mode("append").parquet(landing)
        maintain_table(
            file_feed(spark, landing), ORDERS, table, progress, run_once=True).awaitTermination()
        aside = spark.read.parquet(f"{table}_aside")
        return len(looked), spark.read.parquet(table).count(), aside.count()

    assert step(A1, A2) == (0, 2, 0)
    broken = (*A1[:5], "{broken")
    assert step(A3, broken) == (1, 3, 1)
    # Batches without a row to store, with and without something to set aside.
    assert step(broken, broken)[1:] == (3, 3)
    assert step(order_record(9, "2024-01-09 00:00:00", "d", "A"))[1:] == (3, 3)
    assert step(I1)[1:] == (3, 3)


def test_metrics_view_keeps_one_row_a_day_and_takes_withdrawals(spark, job, tmp_path):
    landing, view = str(tmp_path / "records"), str(tmp_path / "view")

    def step(number, records):
        run(spark, job, records, first=number)
        encode_metrics(job.revised(spark, number)).selectExpr(
            "topic", "0 AS partition", f"{number}L AS offset", "TIMESTAMP '2024-01-01' AS timestamp",
            "key", "value").write.mode("append").parquet(landing)
        maintain_metrics_days(file_feed(spark, landing), view, run_once=True).awaitTermination()
        got = metrics(stored_metrics_days(spark, view))
        assert got == metrics(job.result(spark))
        return {day: m[:2] for day, m in got.items()}

    assert step(0, [B1, I1, I2, LATE]) == {"2023-12-31": (1, 8), "2024-01-01": (1, 2)}
    assert step(1, [A2]) == {"2023-12-31": (1, 8), "2024-01-01": (2, 3)}
    assert step(2, [A3, I2_GONE]) == {"2023-12-31": (1, 8)}


@pytest.fixture
def joined(spark, tmp_path):
    """Runs the joined job over what has landed so far; its metrics."""
    landing, root = str(tmp_path / "feed"), str(tmp_path / "joined")

    def step(records):
        feed(spark, records).write.mode("append").parquet(landing)
        stream = file_feed(stateful_session(spark, 3), landing)
        start_joined_sales(spark, stream, root, run_once=True).awaitTermination()
        return metrics(joined_sales(spark, root))

    return step


def test_joined_sales_follow_the_feed(spark, joined):
    seen = []
    for part in ([A1, I1, B1, I2], [A2], [I1_MORE, LATE], [A3], [I1_MOVED, I2_GONE]):
        seen += part
        assert joined(part) == batch_result(spark, seen)
    assert joined([A1, TOMBSTONE, I2]) == batch_result(spark, [*seen, A1, TOMBSTONE, I2])


@pytest.mark.parametrize("seed", [1, 2])
def test_joined_sales_of_any_split(spark, joined, seed):
    records = [A1, A2, A3, B1, B2, I1, I1_MORE, I1_MOVED, I2, LATE]
    shuffled = random.Random(seed).sample(records, len(records))
    joined(shuffled[:4])
    joined(shuffled[4:7])
    assert joined(shuffled[7:]) == batch_result(spark, records) != {}


def test_joined_sales_know_no_distance_in_time(spark, joined):
    far = item_record(40, "2031-06-01 02:00:00", "c", "I9", "A", 2)
    assert joined([I1, far]) == {}
    both = joined([A2])
    assert {d: m[:2] for d, m in both.items()} == {"2024-01-01": (1, 1), "2031-06-01": (1, 2)}
    assert joined([A3]) == {}


def test_a_batch_of_joined_sales_that_failed_runs_again(spark, joined, monkeypatch):
    from tidemark.streaming import joined as job

    whole, calls = job.add_deltas, []

    def fail_after(*args):
        whole(*args)
        calls.append(args)
        raise RuntimeError("driver lost")

    joined([B1, I2])
    monkeypatch.setattr(job, "add_deltas", fail_after)
    with pytest.raises(Exception, match="driver lost"):
        joined([A2, I1])
    monkeypatch.undo()
    assert calls and joined([LATE]) == batch_result(spark, [B1, I2, A2, I1, LATE])


def test_a_hot_order_has_one_state_entry_a_day(spark, joined, tmp_path):
    items = [item_record(100 + i, f"2024-03-0{1 + i % 3} 02:00:00", "c", f"H{i}", "A", 1)
             for i in range(300)]
    found = joined([A2, *items])
    assert {d: m[:2] for d, m in found.items()} == {
        f"2024-03-0{d}": (1, 100) for d in (1, 2, 3)}
    days = spark.read.format("statestore").option("stateVarName", "days").load(
        str(tmp_path / "joined" / "progress"))
    assert days.count() == 3


def test_parallelism_of_a_stream_is_its_number_of_state_partitions(spark, joined, tmp_path):
    joined([A2, I1])
    state = tmp_path / "joined" / "progress" / "state"
    for operator in state.iterdir():
        assert sorted(p.name for p in operator.iterdir() if p.name.isdigit()) == ["0", "1", "2"]


def test_a_cell_of_state_is_read_and_written_once_a_batch():
    class Held:
        value, calls = None, 0

        def get(self):
            self.calls += 1
            return self.value

        def update(self, value):
            self.calls, self.value = self.calls + 1, value

        def getValueState(self, name, schema):
            return self

    def rows(number, pieces, at_us):
        return iter([pd.DataFrame([
            (f"I{i}", at_us, i, True, f"O{i % 7}", 19_000, 1, pieces, 10, 5) for i in range(number)
        ], columns=joined_module._ITEM_ROWS.names)])

    versions, held = joined_module.ItemVersions(), Held()
    versions.init(held)
    for number, pieces, at_us, added in ((200, 1, 5, 200), (50, 3, 6, 100), (200, 9, 4, 0)):
        before = held.calls
        found = list(versions.handleInputRows((0,), rows(number, pieces, at_us), None))
        assert sum(f["pieces"].sum() for f in found) == added
        assert held.calls - before <= 2


def test_a_cell_is_held_by_key():
    """Like values lie together, so that a cell takes little room."""
    rows = joined_module._ORDER_ROWS.empty_table().from_pylist(
        [{"order_id": o, "at_us": i, "offset": i, "counts": True} for i, o in enumerate("CAB")],
        schema=joined_module._ORDER_ROWS)
    held = joined_module._held(joined_module._to_hold(rows), joined_module._ORDER_ROWS)
    assert held["order_id"].to_pylist() == ["A", "B", "C"]
    assert held["at_us"].to_pylist() == [1, 2, 0]


def test_any_number_of_cells_gives_the_same_and_another_one_is_refused(spark, tmp_path):
    landing, root = str(tmp_path / "feed"), str(tmp_path / "joined")
    seen = []
    for part in ([A1, I1, B1, I2, LATE], [A2, I1_MORE], [A3], [I1_MOVED, I2_GONE, B2]):
        seen += part
        feed(spark, part).write.mode("append").parquet(landing)
        stream = file_feed(stateful_session(spark, 2), landing)
        start_joined_sales(spark, stream, root, run_once=True, cells=1).awaitTermination()
        assert metrics(joined_sales(spark, root)) == batch_result(spark, seen)
    with pytest.raises(ValueError, match="1 buckets"):
        start_joined_sales(spark, stream, root, run_once=True, cells=5)


def test_triggers():
    assert trigger_options(False) == {"processingTime": "60 seconds"}
    assert trigger_options(True) == {"availableNow": True}
    assert WATERMARK_DELAY == "10 seconds"


def test_windowed_job_drops_late_rows(spark, tmp_path):
    items_dir, orders_dir, out, progress = (str(tmp_path / n) for n in ("i", "o", "out", "p"))
    item_sql = (
        "SELECT '{0}' AS order_id, {1}L AS quantity, CAST(10 AS DECIMAL(10,2)) AS price, "
        "CAST(7 AS DECIMAL(10,2)) AS cost_price, TIMESTAMP '{2}' AS ts"
    )
    order_sql = "SELECT '{0}' AS order_id, 'Completed' AS status, TIMESTAMP '{1}' AS order_ts"

    def step(items, orders):
        for rows, sql, path in ((items, item_sql, items_dir), (orders, order_sql, orders_dir)):
            spark.sql(" UNION ALL ".join(sql.format(*r) for r in rows)).write.mode("append").parquet(path)
        streams = [
            spark.readStream.schema(spark.read.parquet(p).schema).parquet(p) for p in (items_dir, orders_dir)
        ]
        (
            windowed_daily_sales(*streams, "7 days", "120 days").writeStream.format("parquet").outputMode("append")
            .option("checkpointLocation", progress).trigger(availableNow=True).start(out).awaitTermination()
        )
        return metrics(spark.read.parquet(out))

    far = "2025-01-01 00:00:00"
    first = step(
        [("A", 1, "2024-01-01 01:00:00"), ("A", 2, "2024-01-01 02:00:00"), ("B", 4, "2024-01-01 03:00:00"),
         ("Z", 1, far)],
        [("A", "2024-01-01 00:00:00"), ("B", "2024-01-01 00:00:00"), ("Z", far)],
    )
    assert first == {"2024-01-01": (2, 7, "70.00", "49.00", "21.00", "35.00")}
    late = step([("A", 8, "2024-01-01 04:00:00"), ("Z", 1, far)], [("Y", far)])
    assert late == first


@pytest.fixture
def closing_days(spark, tmp_path):
    """Runs the closing job over what has landed; its final days, late differences and counts."""
    landing, root = str(tmp_path / "feed"), str(tmp_path / "closing")

    def step(records):
        feed(spark, records).write.mode("append").parquet(landing)
        stream = file_feed(stateful_session(spark, 3), landing)
        query = closing.start_closing_days(stream, root, run_once=True)
        query.awaitTermination()
        late = {str(r.sale_date): tuple(r)[1:3] for r in closing.late_differences(spark, root).collect()}
        final = {d: m[:2] for d, m in metrics(closing.final_days(spark, root)).items()}
        return final, late, closing.counted(query)

    return step


def test_days_close_with_the_watermark_and_nothing_late_is_lost(spark, closing_days):
    after = [order_record(50, "2024-01-02 00:00:11", "c", "Z", "Pending"),
             item_record(51, "2024-01-02 00:00:11", "c", "Z1", "Z")]
    # Ten seconds behind, the watermark has not quite passed the day.
    assert closing_days([B1, I2, order_record(48, "2024-01-02 00:00:05", "c", "Y", "Pending"),
                         item_record(49, "2024-01-02 00:00:05", "c", "Y1", "Y")])[0] == {}
    final, late, counted = closing_days(after)
    assert (final, late, counted) == ({"2024-01-01": (1, 2)}, {}, {"final": 1, "late": 0})
    # A late item, an item for a day never seen, and an order that is completed too late.
    final, late, counted = closing_days([A2, I1, LATE])
    assert final == {"2024-01-01": (1, 2)}
    assert late == {"2024-01-01": (1, 1), "2023-12-31": (1, 8)} and counted["late"] == 2
    final, late, _ = closing_days([I2_GONE, A3])
    assert final["2024-01-01"] == (1, 2) and late == {"2024-01-01": (-1, -2), "2023-12-31": (1, 8)}


def test_a_slow_feed_holds_the_watermark_back(closing_days):
    """The items are far ahead of the orders, so no day is closed yet."""
    far = item_record(60, "2024-05-01 00:00:00", "c", "F", "B")
    assert closing_days([B1, I2, far]) == ({}, {}, {"final": 0, "late": 0})
    # A feed that is quiet after a restart holds it back too, so both go on.
    ahead = [order_record(61, "2024-06-01 00:00:00", "c", "W", "Pending"),
             item_record(62, "2024-05-01 00:00:00", "c", "F2", "W")]
    final, late, _ = closing_days(ahead)
    assert final == {"2024-01-01": (1, 2)} and late == {}


@pytest.mark.parametrize("seed", [4, 5])
def test_final_and_late_add_up_to_the_feed(spark, closing_days, seed):
    records = [A1, A2, A3, B1, B2, I1, I1_MORE, I1_MOVED, I2, LATE]
    shuffled = random.Random(seed).sample(records, len(records))
    end = [order_record(70, "2025-01-01 00:00:00", "c", "Z", "Pending"),
           item_record(71, "2025-01-01 00:00:00", "c", "Z1", "Z")]
    for part in (shuffled[:5], shuffled[5:], end):
        final, late, _ = closing_days(part)
    total = {}
    for found in (final, late):
        for day, sums in found.items():
            total[day] = tuple(a + b for a, b in zip(total.get(day, (0, 0)), sums))
    want = {d: m[:2] for d, m in batch_result(spark, records).items()}
    assert {d: t for d, t in total.items() if any(t)} == want

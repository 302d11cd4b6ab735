from __future__ import annotations

import datetime as dt
import os
import uuid

import pytest
from pyspark.errors import AnalysisException
from pyspark.sql import functions as F

from tallybank.operators import analytics, quality
from tallybank.plans.tuning import plan_report
from tallybank.sources.files import read_table
from tallybank.sources.streams import in_files, land_days, land_partition, stream_rate, stream_table
from tallybank.streaming import operators as ops
from tallybank.streaming import segments, sinks
from tallybank.streaming.replays import finish
from tests.conftest import rows, same_rows, txn

CLOSER = dict(transaction_id=999999, account_id=77, event_ts="2024-03-01 00:00:00")


def dates(df):
    return [r[0] for r in df.select("event_date").distinct().orderBy("event_date").collect()]


@pytest.fixture(scope="module")
def feed(spark, bank, tmp_path_factory):
    """The table landed one event date at a time, then one row far ahead that closes all windows."""
    folder = str(tmp_path_factory.mktemp("feed"))
    in_order = bank.transaction.coalesce(1)
    for date in dates(bank.transaction):
        land_partition(in_order, date, folder)
    land_partition(txn(spark, CLOSER).coalesce(1), "2024-03-01", folder)
    return folder


@pytest.fixture
def stream(spark, feed):
    return stream_table(spark, feed, max_files=5)


@pytest.fixture
def work(tmp_path):
    return str(tmp_path / "out"), str(tmp_path / "checkpoint")


def hourly(df):
    return (
        analytics.partial_totals(df, F.window("event_ts", "1 hour").alias("window"), "account_id")
        .transform(analytics.finish, "window", "account_id", total="hourly_total")
    )


def test_hourly_stream_equals_batch_and_resumes(spark, bank, stream, work):
    out, checkpoint = work
    for _ in range(2):
        finish(sinks.start_parquet(ops.hourly_totals(stream), out, checkpoint, once=True))
        same_rows(read_table(spark, out), hourly(bank.transaction))


def test_stop_and_restart_with_late_rows(spark, tmp_path, work):
    out, checkpoint = work
    folder = str(tmp_path / "feed")

    def land(*records):
        txn(spark, *records).coalesce(1).write.mode("append").parquet(folder)

    def run():
        finish(sinks.start_parquet(ops.hourly_totals(stream_table(spark, folder)), out, checkpoint, once=True))

    land(dict(transaction_id=1, event_ts="2024-01-10 10:10:00", amount=1.0))
    run()
    land(
        dict(transaction_id=2, event_ts="2024-01-10 10:50:00", amount=2.0),
        dict(transaction_id=3, event_ts="2024-01-08 10:00:00", amount=4.0),
        dict(transaction_id=4, event_ts="2024-01-05 10:00:00", amount=8.0),
    )
    run()
    land(CLOSER)
    run()
    closed = {r.window.start.day: r.hourly_total for r in read_table(spark, out).collect()}
    assert closed == {10: 3.0, 8: 4.0}


def test_velocity_stream_equals_batch(spark, bank, stream, work):
    out, checkpoint = work
    alerts = ops.velocity_alerts_stream(stream)
    finish(sinks.start_updates(alerts, out, checkpoint, once=True))
    found = sinks.latest_updates(spark, out, alerts.schema, ["window", "account_id"])
    batch = ops.velocity_alerts_stream(bank.transaction)
    same_rows(found, batch)
    assert found.count() > 0


def test_enriched_stream_equals_batch(spark, bank, stream, work):
    out, checkpoint = work
    finish(sinks.start_parquet(ops.enrich_stream(stream, bank.product, bank.branch), out, checkpoint, once=True))
    batch = ops.enrich_stream(bank.transaction, bank.product, bank.branch)
    same_rows(read_table(spark, out).filter("account_id is distinct from 77 or transaction_id <> 999999"), batch)


def test_dedup_stream(spark, bank, stream, work):
    out, checkpoint = work
    finish(sinks.start_parquet(ops.dedup_stream(stream), out, checkpoint, once=True))
    ids = read_table(spark, out).select("transaction_id")
    kept = rows(ids.filter("transaction_id <> 999999").distinct())
    assert kept == rows(bank.transaction.select("transaction_id").distinct())


@pytest.mark.parametrize("salts", [1, 4])
def test_dedup_is_bounded_by_the_delay(spark, tmp_path, work, salts):
    out, checkpoint = work
    folder = str(tmp_path / "feed")

    def land(*records):
        txn(spark, *records).coalesce(1).write.mode("append").parquet(folder)
        stream = stream_table(spark, folder)
        query = sinks.start_parquet(ops.dedup_stream(stream, salts=salts), out, checkpoint, once=True)
        finish(query)
        return query

    land(dict(transaction_id=1, amount=1.0), dict(transaction_id=1, amount=2.0))
    land(dict(transaction_id=1, event_ts="2024-01-06 12:00:00"))
    assert read_table(spark, out).count() == 1
    # Beyond the delay the id is forgotten and passes again.
    query = land(dict(transaction_id=2, event_ts="2024-01-20 12:00:00"))
    land(dict(transaction_id=1, event_ts="2024-01-19 12:00:00"))
    assert sorted(r[0] for r in read_table(spark, out).select("transaction_id").collect()) == [1, 1, 2]
    progress = sinks.progress_frame(spark, query)
    assert progress.agg(F.max("state_rows")).first()[0] > 0
    assert progress.agg(F.sum("input_rows")).first()[0] == 1


def test_unbounded_dedup_keeps_every_id(spark, bank, stream, work):
    out, checkpoint = work
    query = sinks.start_parquet(ops.dedup_stream(stream, bounded=False), out, checkpoint, once=True)
    finish(query)
    ids = bank.transaction.select("transaction_id").distinct().count() + 1
    assert read_table(spark, out).count() == ids
    assert sinks.progress_frame(spark, query).agg(F.max("state_rows")).first()[0] == ids


def test_quality_routing(spark, bank, feed, work):
    out, checkpoint = work
    stream = stream_table(spark, feed, max_files=5)
    finish(sinks.route_quality(stream, out, checkpoint, every=2, once=True))
    everything = spark.read.parquet(feed)
    valid, quarantine = quality.split_quality(everything)
    same_rows(sinks.routed_rows(spark, out, "valid"), valid)
    same_rows(sinks.routed_rows(spark, out, "quarantine"), quarantine)
    assert tuple(sinks.routing_summary(spark, out).first()) == tuple(quality.quality_summary(everything).first())
    assert read_table(spark, f"{out}/summary").count() == 1


def test_replayed_batch_changes_nothing(spark, bank, tmp_path):
    out = str(tmp_path / "out")
    for batch_id in (0, 1, 1):
        sinks.write_batch(bank.transaction.filter(F.pmod("transaction_id", F.lit(2)) == batch_id), batch_id, out)
    summary = sinks.routing_summary(spark, out).first()
    assert tuple(summary) == tuple(quality.quality_summary(bank.transaction).first())
    same_rows(sinks.routed_rows(spark, out, "valid"), quality.split_quality(bank.transaction)[0])


def folders(path):
    return sum(len(names) for _, names, _ in os.walk(path))


def test_folders_stay_few_over_many_batches(spark, bank, tmp_path, monkeypatch):
    """50 batches, each of them retried once: the same rows and counts, and folders that do not grow with the batches."""
    merged = segments.merge_closed
    monkeypatch.setattr(segments, "merge_closed", lambda *a, **more: merged(*a, **{**more, "fan": 4}))
    out = str(tmp_path / "out")
    counted, seen = [], []
    rows_of = bank.transaction.withColumn("part", F.pmod(F.xxhash64("transaction_id", "event_ts"), F.lit(50)))
    rows_of = rows_of.coalesce(1).cache()
    for batch_id in range(50):
        batch = rows_of.filter(F.col("part") == batch_id).drop("part")
        for _ in range(2 if batch_id % 7 == 0 else 1):
            sinks.write_batch(batch, batch_id, out)
        if batch_id % 12 == 11:
            counted.append(folders(out))
            seen.append(sinks.routing_summary(spark, out).first()["total_rows"])
            assert seen[-1] == rows_of.filter(F.col("part") <= batch_id).count()
    assert max(counted[1:]) <= counted[0] + 20
    assert tuple(sinks.routing_summary(spark, out).first()) == tuple(quality.quality_summary(bank.transaction).first())
    valid, quarantine = quality.split_quality(bank.transaction)
    same_rows(sinks.routed_rows(spark, out, "valid"), valid)
    same_rows(sinks.routed_rows(spark, out, "quarantine"), quarantine)
    rows_of.unpersist()


def test_merged_updates_keep_the_last_state(spark, tmp_path):
    path, schema = str(tmp_path / "updates"), "account_id long, n long"
    kept = {}
    for batch_id in range(13):
        rows_now = [(a, 100 * batch_id + (a or 0)) for a in (1, 2, batch_id, None)]
        batch = spark.createDataFrame(list(dict(rows_now).items()), schema)
        kept.update(dict(rows_now))
        last = lambda rows: sinks._last(rows, ["account_id"])
        segments.merge_closed(spark, path, batch_id, batch.schema, reduced=last, fan=3)
        segments.write_recent(batch, batch_id, path)
    found = {r.account_id: r.n for r in sinks.latest_updates(spark, path, batch.schema, ["account_id"]).collect()}
    assert found == kept
    stored = segments.publish.latest(spark, path)["segments"]
    assert sum(spark.read.parquet(s["path"]).count() for s in stored) < 13 * 4


def test_a_merge_that_ends_early_changes_nothing(spark, tmp_path, monkeypatch):
    path = str(tmp_path / "table")
    for batch_id in range(3):
        segments.write_recent(spark.createDataFrame([(batch_id,)], "n long"), batch_id, path)
    schema = spark.createDataFrame([(1,)], "n long").schema
    before = rows(segments.read_batches(spark, path, schema))

    def crash(*_):
        raise OSError("gone")

    with monkeypatch.context() as patched:
        patched.setattr(segments.publish, "publish", crash)
        with pytest.raises(OSError):
            segments.merge_closed(spark, path, 3, schema, fan=3)
    assert rows(segments.read_batches(spark, path, schema)) == before == [(0, 0), (1, 1), (2, 2)]
    assert segments.merge_closed(spark, path, 3, schema, fan=3)
    assert rows(segments.read_batches(spark, path, schema)) == before


def test_unique_rows_of_stream_and_batch(spark, tmp_path, work):
    """Whole rows; ids seen again after the delay pass; rows without an id or a time all stay."""
    out, checkpoint = work
    folder = str(tmp_path / "feed")
    arrivals = [
        [dict(transaction_id=1, amount=2.0), dict(transaction_id=1, amount=1.0), dict(transaction_id=None)],
        [dict(transaction_id=None), dict(transaction_id=None, amount=3.0), dict(transaction_id=2, event_ts="2024-01-06 01:00:00")],
        [dict(transaction_id=1, event_ts="2024-01-08 11:59:59"), dict(transaction_id=2, event_ts="2024-01-09 02:00:00")],
        [dict(transaction_id=1, event_ts="2024-01-08 12:00:01"), dict(transaction_id=3, event_ts=None, event_date="2024-01-08")],
        [dict(transaction_id=3, event_ts=None, event_date="2024-01-08")],
    ]
    for records in arrivals:
        txn(spark, *records).coalesce(1).write.mode("append").parquet(folder)
        stream = stream_table(spark, folder)
        finish(sinks.start_unique(stream, out, checkpoint, once=True))
    found = sinks.unique_rows(spark, out, stream.schema)
    shown = sorted(((r.transaction_id, r.amount, str(r.event_ts)) for r in found.collect()), key=repr)
    assert shown == sorted(
        [
            (1, 1.0, "2024-01-05 12:00:00"),
            (1, 10.0, "2024-01-08 12:00:01"),
            (2, 10.0, "2024-01-06 01:00:00"),
            (2, 10.0, "2024-01-09 02:00:00"),
            (3, 10.0, "None"),
            (3, 10.0, "None"),
            (None, 10.0, "2024-01-05 12:00:00"),
            (None, 10.0, "2024-01-05 12:00:00"),
            (None, 3.0, "2024-01-05 12:00:00"),
        ],
        key=repr,
    )


def test_rows_without_an_id_pass_the_state(spark, tmp_path, work):
    out, checkpoint = work
    folder = str(tmp_path / "feed")
    txn(spark, *[dict(transaction_id=i) for i in (None, None, 1, 1, None)]).coalesce(1).write.parquet(folder)
    for k, options in enumerate((dict(), dict(salts=3), dict(bounded=False))):
        stream = ops.dedup_stream(stream_table(spark, folder), **options)
        finish(sinks.start_parquet(stream, f"{out}{k}", f"{checkpoint}{k}", once=True))
        ids = [r[0] for r in read_table(spark, f"{out}{k}").select("transaction_id").collect()]
        assert sorted(ids, key=repr) == [1, None, None, None]


def test_days_land_in_order_as_whole_batches(spark, bank, tmp_path):
    folder = str(tmp_path / "days")
    days = land_days(bank.transaction, folder, "ingest_date", files=2)
    same_rows(spark.read.parquet(folder), bank.transaction)
    seen = []
    stream = stream_table(spark, folder, bank.transaction.schema, max_files=4)
    query = stream.writeStream.foreachBatch(lambda b, _: seen.append([r[0] for r in b.select("ingest_date").distinct().collect()]))
    finish(query.option("checkpointLocation", str(tmp_path / "checkpoint")).trigger(availableNow=True).start())
    assert [len(batch) for batch in seen[:-1]] == [2] * (len(seen) - 1)
    flat = [day for batch in seen for day in sorted(batch)]
    assert flat == sorted(set(flat)) and len(flat) == days


def test_dashboard(spark, feed, stream):
    name = f"dashboard_{uuid.uuid4().hex}"
    finish(sinks.dashboard(stream, name, once=True))
    same_rows(spark.table(name), analytics.totals_by(spark.read.parquet(feed), ["transaction_type", "currency"]))


def test_output_modes(spark, stream, work):
    _, checkpoint = work
    with pytest.raises(AnalysisException):
        sinks.start_memory(ops.running_totals(stream), "never", "append", once=True)
    # Complete mode accepts a watermark but keeps all state.
    name = f"complete_{uuid.uuid4().hex}"
    query = sinks.start_memory(ops.hourly_totals(stream), name, "complete", once=True)
    finish(query)
    assert sinks.progress_frame(spark, query).agg(F.max("state_rows")).first()[0] == spark.table(name).count()
    with pytest.raises(AnalysisException):
        sinks.start_memory(stream, "never", "complete", once=True)


def test_append_mode_forgets_closed_windows(spark, stream, work):
    out, checkpoint = work
    query = sinks.start_parquet(ops.hourly_totals(stream), out, checkpoint, once=True)
    finish(query)
    states = [r.state_rows for r in sinks.progress_frame(spark, query).orderBy("batch_id").collect()]
    assert states[-1] < max(states)


def test_console_sink(spark, stream, work):
    query = sinks.start_console(ops.velocity_alerts_stream(stream), work[1], once=True)
    finish(query)
    assert query.exception() is None
    assert "ConsoleTable" in str(query.lastProgress["sink"]) and not query.isActive


def test_rate_source(spark):
    name = f"rate_{uuid.uuid4().hex}"
    source = stream_rate(spark, 100)
    from tallybank.schemas import SYNTHETIC

    assert {tuple(c.split()) for c in SYNTHETIC["transaction"].split(", ")} == set(source.dtypes)
    query = sinks.start_memory(source, name, "append")
    try:
        deadline = dt.datetime.now() + dt.timedelta(seconds=30)
        while spark.table(name).count() == 0 and dt.datetime.now() < deadline:
            query.awaitTermination(1)
        assert spark.table(name).count() > 0
    finally:
        query.stop()


def test_a_day_landed_as_one_file_is_not_shuffled(bank, tmp_path):
    one, two = (in_files(bank.transaction, files) for files in (1, 2))
    assert plan_report(one)["shuffles"] == 0 and plan_report(two)["shuffles"] == 1
    for files, frame in ((1, one), (2, two)):
        frame.write.parquet(f"{tmp_path}/{files}")
        assert len(list((tmp_path / str(files)).glob("part-*"))) == files
    same_rows(one, two)

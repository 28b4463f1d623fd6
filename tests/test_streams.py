"""Late rows as rows, repeated deliveries, and reports refreshed by week."""

import json
import os

from helpers import at, lines, rows, table

from spanwatch.operators.series import accel_minute
from spanwatch.plans import queries
from spanwatch.plans.ingest import ingest
from spanwatch.plans.weekly import ingest_and_report, read_reports, refresh_reports, report_path, weekly_backfill
from spanwatch.session import shared_folder
from spanwatch.sources.statistics import read_statistics
from spanwatch.sources.store import read_table, read_tables
from spanwatch.streaming import late
from spanwatch.streaming.bins import stream_accel_minute
from spanwatch.streaming.ingest import merge_chunks, stream_ingest


def accel(spark, *stamps):
    return table(spark, "accel_all", [{"datetime": s and at(s), "A30_x": 3.0, "A30_y": 0.0, "A30_z": 4.0 + i} for i, s in enumerate(stamps)])


def drained(query):
    assert query.awaitTermination(300) and query.exception() is None


def test_late_rows_are_kept_and_the_others_binned(spark, tmp_path):
    base, source = str(tmp_path / "base"), str(tmp_path / "in")
    parts = [
        ("2025-12-01T10:00:00", "2025-12-01T10:00:30", None),
        ("2025-12-01T12:00:00",),
        # The watermark is at 11:00: a bin that ends there is closed, the next is not.
        ("2025-12-01T10:59:59", "2025-12-01T11:00:00", "2025-12-01T09:00:00"),
    ]
    schema = accel(spark).schema
    for part in parts:
        accel(spark, *part).coalesce(1).write.mode("append").parquet(source)

    def receive():
        stream = spark.readStream.schema(schema).option("maxFilesPerTrigger", 1).parquet(source)
        drained(late.stream_receive(stream, base, str(tmp_path / "check")))

    def closed():
        minutes = stream_accel_minute(late.on_time(spark, base, schema), ["A30"])
        drained(minutes.writeStream.format("parquet").option("checkpointLocation", str(tmp_path / "bins")).option("path", str(tmp_path / "out")).trigger(availableNow=True).start())
        return rows(spark.read.parquet(str(tmp_path / "out")), "minute")

    receive()
    lateness = rows(late.late_rows(spark, base, schema).select("datetime"), "datetime")
    assert lateness == [(at("2025-12-01T09:00:00"),), (at("2025-12-01T10:59:59"),)]
    assert [r[1] for r in closed()] == [at("2025-12-01T10:00:00")]
    # The next start goes on from there, with one more late row.
    accel(spark, "2025-12-20T00:00:00").coalesce(1).write.mode("append").parquet(source)
    accel(spark, "2025-12-01T10:00:10").coalesce(1).write.mode("append").parquet(source)
    receive()
    assert len(rows(late.late_rows(spark, base, schema))) == 3
    kept = accel(spark, *parts[0][:2]).unionByName(accel(spark, *parts[1])).unionByName(accel(spark, *parts[2]).where("datetime = timestamp_ntz'2025-12-01 11:00:00'"))
    assert closed() == rows(accel_minute(kept, ["A30"]), "minute")
    # Only the last two marks are left, and a whole batch is not written again.
    assert len(os.listdir(f"{base}/greatest")) == 2
    last = max(int(n.split("=")[1]) for n in os.listdir(f"{base}/greatest"))
    late._receive(accel(spark, "2025-12-02"), last, base, 1, None)
    assert len(rows(late.late_rows(spark, base, schema))) == 3


def document(stamp, value):
    points = [{"f": f, "a": 0.1 * f} for f in (1.0, 2.0, 2.0, 4.0)]
    return json.dumps({"time": {"datetime": stamp}, "A30": {"x": value, "y": 0.0, "z": 0.0, "fft": {"main": {"f": 2.0, "a": 0.2}, "spectrum": points}}, "S7": {"s": value}, "T1": {"t": 4.0}})


def test_repeated_deliveries(spark, tmp_path):
    source, chunks, check, base = (str(tmp_path / n) for n in ("in", "chunks", "check", "out"))
    texts = [document(f"2025-12-0{d}T00:00:00", float(d)) for d in (1, 2, 8)] + ["{broken"]

    def deliver(*some):
        lines(spark, *some).coalesce(1).write.mode("append").text(source)

    deliver(*texts[:2], texts[0])
    deliver(*texts[1:])
    drained(stream_ingest(spark, source, chunks, check, max_files=1, repeats_within="14 days"))
    assert merge_chunks(spark, chunks, base) == [(2025, 49), (2025, 50)]
    deliver(*texts)
    drained(stream_ingest(spark, source, chunks, check, max_files=1, repeats_within="14 days"))
    assert merge_chunks(spark, chunks, base) == []
    once = str(tmp_path / "once")
    ingest(spark, lines(spark, *texts), once)
    for key in ("accel_all", "fft_hub2", "sst_hub2"):
        assert rows(read_table(spark, base, key), "datetime") == rows(read_table(spark, once, key), "datetime")
    assert spark.read.parquet(f"{chunks}/quarantine").count() == 1
    order = ["table_key", "iso_week", "sensor_id"]
    assert rows(read_statistics(spark, base), *order) == rows(read_statistics(spark, once), *order)
    assert len([n for n in os.listdir(f"{chunks}/written") if n.startswith("ingest_batch")]) == 1


def test_both_deliveries_lie_compressed(spark, tmp_path):
    spark.sql("select id as event_id, timestamp_ntz'2024-01-01' + make_dt_interval(0, cast(id as int)) as ts, 'view' as event_type, id / 2D as value, '{\"k\": 3}' as props from range(60)").write.parquet(str(tmp_path / "events.parquet"))
    spark.sql("select id as vec_id, array(1f, 2f, 4f) as embedding, cast(id as int) as label from range(4)").write.parquet(str(tmp_path / "embeddings.parquet"))
    folder = f"{shared_folder(spark)}/spanwatch"
    before = set(os.listdir(folder)) if os.path.isdir(folder) else set()
    assert queries.all_queries()["stream_ingest_repeats"](spark, str(tmp_path)).count() == 9
    (made,) = [n for n in os.listdir(folder) if n.startswith("streamed-") and n not in before]
    received = [r.value for r in spark.read.text(f"{folder}/{made}/in").collect()]
    assert len(received) == 128 and len(set(received)) == 64
    held = sum(os.path.getsize(f"{folder}/{made}/in/{n}") for n in os.listdir(f"{folder}/{made}/in") if n.startswith("part-"))
    assert 3 * held < sum(len(line) for line in received)


def test_a_late_document_refreshes_its_week_only(spark, tmp_path):
    base = str(tmp_path / "weekly")
    texts = [document(f"2025-{d}T00:00:00", float(i)) for i, d in enumerate(("11-25", "11-26", "12-02", "12-03", "12-09", "12-10"))]
    ingest(spark, lines(spark, *texts), base)
    refresh_reports(spark, base)

    def files(week):
        return sorted(os.listdir(f"{report_path(base)}/iso_year=2025/iso_week={week}"))

    before = {w: files(w) for w in (48, 49, 50)}
    texts.append(document("2025-12-04T00:00:00", 99.0))
    assert ingest_and_report(spark, lines(spark, *texts), base, 2025, 49) == {(2025, 49)}
    assert files(48) == before[48] and files(50) == before[50] and files(49) != before[49]
    order = ["iso_week", "chart", "sensor_id"]
    assert rows(read_reports(spark, base), *order) == rows(weekly_backfill(read_tables(spark, base)), *order)
    # The offset puts it into the week before.
    texts.append(document("2025-12-08T00:30:00+02:00", 7.0))
    assert ingest_and_report(spark, lines(spark, *texts), base, 2025, 50) == {(2025, 49), (2025, 50)}
    assert rows(read_reports(spark, base), *order) == rows(weekly_backfill(read_tables(spark, base)), *order)
    # A week without documents loses its report, and what it lent to its neighbour.
    assert ingest_and_report(spark, lines(spark), base, 2025, 50) == {(2025, 49), (2025, 50)}
    assert rows(read_reports(spark, base), *order) == rows(weekly_backfill(read_tables(spark, base)), *order)
    assert {r.iso_week for r in read_reports(spark, base).collect()} == {48, 49}

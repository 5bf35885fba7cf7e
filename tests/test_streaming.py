import json

from pyspark.sql import functions as F

from tidemark.operators.routing import final_minutes, minute_coverage, revised_minutes, routing_minutes
from tidemark.streaming import routing_stream as S


def line(i, t, prefixes, gone=()):
    return json.dumps({"id": f"m{i}", "timestamp": t, "host": "rrc00.x", "peer": "1.2.3.4", "peer_asn": "7", "path": ["1", str(64500 + i % 3)], "announcements": [{"next_hop": "n", "prefixes": list(prefixes)}], "withdrawals": list(gone)})


def feed(path):
    path.mkdir()
    start = 1704067200
    for part in range(4):
        rows = [line(i, start + i * 7, [f"10.0.{i % 5}.0/24"], ["10.9.0.0/16"] if i % 4 == 0 else []) for i in range(part * 20, part * 20 + 20)]
        (path / f"{part}.txt").write_text("\n".join([*rows, "not a message"]))
    # A much later message moves the watermark over all minutes before it.
    (path / "9.txt").write_text("\n".join([line(99, start + 90000, ["10.0.0.0/24"])]))


def test_minutes_are_those_of_the_batch(spark, tmp_path):
    feed(tmp_path / "in")
    good, _ = S.parse_stream(S.read_messages(spark, str(tmp_path / "in")))
    S.write_minutes(S.minute_stream(good), str(tmp_path / "out"), str(tmp_path / "cp")).awaitTermination()
    got = {str(r.bucket_start): (r.messages, r.announcements, r.withdrawals, r.n_announced, r.n_withdrawn, r.n_origins) for r in spark.read.parquet(str(tmp_path / "out")).collect()}
    batch, bad = S.parse_stream(S.parse_messages(spark.read.text(str(tmp_path / "in"))))
    want = {str(r.bucket_start): (r.messages, r.announcements, r.withdrawals, r.n_announced, r.n_withdrawn, r.n_origins) for r in routing_minutes(batch).where("messages > 0").collect()}
    assert bad.count() == 4
    late = max(want)
    assert got == {k: v for k, v in want.items() if k != late}


def test_segments_exist_once(spark, tmp_path):
    feed(tmp_path / "in")
    good, _ = S.parse_stream(S.read_messages(spark, str(tmp_path / "in")))
    S.write_segments(S.dedupe_stream(good), str(tmp_path / "out"), str(tmp_path / "cp")).awaitTermination()
    assert S.segments(spark, str(tmp_path / "out")).agg(F.sum("messages")).first()[0] == 81
    assert S.kept(spark, str(tmp_path / "out")).count() == 81


def batches(spark, folder, *files):
    """Every file as a micro-batch of its own, in order."""
    import os

    (folder / "in").mkdir()
    for i, lines in enumerate(files):
        (folder / "in" / f"{i}.txt").write_text("\n".join(lines))
        os.utime(folder / "in" / f"{i}.txt", (1000 + i, 1000 + i))
    return lambda: S.parse_stream(S.parse_messages(spark.readStream.option("maxFilesPerTrigger", 1).text(str(folder / "in"))))[0]


def test_a_batch_that_is_sent_twice_counts_once(spark, tmp_path):
    one = [line(i, 1704067200 + i, ["10.0.0.0/24"]) for i in range(10)]
    same = [line(1, 1704067201, ["10.0.0.0/24"])] * 2
    other = [line(i, 1704067200 + i, ["10.0.1.0/24"]) for i in range(10)]
    read = batches(spark, tmp_path, one, one[::-1], same, same[:1], [], other)
    S.write_segments(read(), str(tmp_path / "out"), str(tmp_path / "cp")).awaitTermination()
    told = S.segments(spark, str(tmp_path / "out")).orderBy("batch").collect()
    # The second batch is the first in another order; a message sent twice isn't the message sent once; equal ids may say other things.
    assert [r.messages for r in told] == [10, 2, 1, 10] and len({r.content for r in told}) == 4
    assert S.kept(spark, str(tmp_path / "out")).count() == 23
    assert [str(x.bucket_start) for x in S.touched_minutes(spark, str(tmp_path / "out"), -1).collect()] == ["2024-01-01 00:00:00"]


def test_a_failure_between_the_two_writes_loses_nothing(spark, tmp_path, monkeypatch):
    read = batches(spark, tmp_path, [line(i, 1704067200 + i, ["10.0.0.0/24"]) for i in range(5)], [line(9, 1704067900, ["10.0.0.0/24"])])
    real, calls = S.commit_segment, []

    def fails_once(*args):
        calls.append(args)
        if len(calls) == 2:
            raise RuntimeError("stopped between the writes")
        real(*args)

    monkeypatch.setattr(S, "commit_segment", fails_once)
    try:
        S.write_segments(read(), str(tmp_path / "out"), str(tmp_path / "cp")).awaitTermination()
    except Exception as e:
        assert "between the writes" in str(e)
    assert [r.messages for r in S.segments(spark, str(tmp_path / "out")).collect()] == [5] and S.kept(spark, str(tmp_path / "out")).count() == 5
    S.write_segments(read(), str(tmp_path / "out"), str(tmp_path / "cp")).awaitTermination()
    assert sorted(r.messages for r in S.segments(spark, str(tmp_path / "out")).collect()) == [1, 5] and S.kept(spark, str(tmp_path / "out")).count() == 6


def test_zero_minutes_and_redirty(spark):
    sessions = spark.sql("select timestamp'2024-01-01 00:00:30' as start, timestamp'2024-01-01 00:03:00' as end, true as failed")
    minutes = spark.sql("select timestamp'2024-01-01 00:01:00' as bucket_start, 5L as messages")
    assert {(str(r.bucket_start)[-5:], r.messages) for r in S.fill_minutes(minutes, sessions).collect()} == {("00:00", 0), ("01:00", 5), ("02:00", 0)}
    assert S.redirty(sessions).count() == 3


def test_late_rows_revise_their_minute(spark, tmp_path):
    feed(tmp_path / "in")
    read = lambda: S.parse_stream(S.read_messages(spark, str(tmp_path / "in")))[0]
    run = lambda: (S.write_minutes(S.minute_stream(read()), str(tmp_path / "out"), str(tmp_path / "cp")).awaitTermination(), S.write_segments(read(), str(tmp_path / "seg"), str(tmp_path / "cp2")).awaitTermination())
    run()
    (tmp_path / "in" / "late.txt").write_text(line(500, 1704067205, ["10.77.0.0/16"]))
    run()
    minutes, kept = spark.read.parquet(str(tmp_path / "out")), S.kept(spark, str(tmp_path / "seg"))
    first = minutes.where("bucket_start = timestamp'2024-01-01 00:00:00'").first()
    rows = {str(r.bucket_start): r for r in final_minutes(revised_minutes(kept, minutes), F.lit("2024-01-01 00:30:00").cast("timestamp")).collect()}
    assert list(rows) == ["2024-01-01 00:00:00"]
    last = S.segments(spark, str(tmp_path / "seg")).agg(F.max("batch")).first()[0]
    touched = S.touched_minutes(spark, str(tmp_path / "seg"), last - 1)
    assert [tuple(r) for r in revised_minutes(kept, minutes, touched=touched).collect()] == [tuple(rows["2024-01-01 00:00:00"])]
    new = rows["2024-01-01 00:00:00"]
    assert (new.messages, new.announcements) == (first.messages + 1, first.announcements + 1)


def test_rejected_lines_degrade_their_minute(spark):
    lines = spark.createDataFrame([(json.dumps({"timestamp": 1704067230}), "2024-01-01 09:00:00"), ("no message", "2024-01-01 00:02:10"), (line(1, 1704067270, ["10.0.0.0/24"]), "2024-01-01 00:01:11")], "value string, received string").withColumn("received", F.col("received").cast("timestamp"))
    bad = S.rejected_minutes(lines, "received")
    assert {(str(r.bucket_start)[-5:], r.rejected) for r in bad.collect()} == {("00:00", 1), ("02:00", 1)}
    minutes = spark.sql("select explode(sequence(timestamp'2024-01-01 00:00:00', timestamp'2024-01-01 00:02:00', interval 1 minute)) as bucket_start")
    sessions = spark.sql("select timestamp'2024-01-01 00:00:00' as start, timestamp'2024-01-01 00:03:00' as end, 'p' as profile, false as degraded")
    got = {str(r.bucket_start)[-5:]: r.coverage for r in minute_coverage(minutes, sessions, bad).collect()}
    assert got == {"00:00": "DEGRADED", "01:00": "COMPLETE", "02:00": "DEGRADED"}

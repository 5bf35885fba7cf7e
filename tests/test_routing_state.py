import json

import pytest
from pyspark.sql import functions as F

from tidemark.streaming import routing_state as RT
from tidemark.streaming import routing_stream as S

START = 1704067200  # an hour begins


def line(i, second, prefixes=("10.0.0.0/24",), gone=(), host="rrc00.x", peer="7"):
    return json.dumps({"id": f"m{i}", "timestamp": START + second, "host": host, "peer": "1.2.3.4", "peer_asn": peer, "path": ["1", str(64500 + i % 3)], "announcements": [{"next_hop": "n", "prefixes": list(prefixes)}], "withdrawals": list(gone)})


@pytest.fixture
def rocks(spark):
    spark.conf.set("spark.sql.streaming.stateStore.providerClass", RT.ROCKSDB)
    yield spark
    spark.conf.unset("spark.sql.streaming.stateStore.providerClass")


def run(spark, folder, keep_s=86_400):
    rows = RT.keyed(S.parse_messages(spark.readStream.option("maxFilesPerTrigger", 1).text(f"{folder}/in")), F.lit("ris"))
    out = RT.closing_stream(rows, keep_s=keep_s)
    out.writeStream.format("parquet").outputMode("append").option("path", f"{folder}/out").option("checkpointLocation", f"{folder}/cp").trigger(availableNow=True).start().awaitTermination()
    return spark.read.parquet(f"{folder}/out")


def put(folder, batches):
    """Files in the order of their names, a batch each."""
    folder.mkdir(exist_ok=True)
    import os

    for name, lines in batches.items():
        (folder / f"{name}.txt").write_text("\n".join(lines))
        os.utime(folder / f"{name}.txt", (int(name), int(name)))


def told(df):
    return {(r.rrc, int(r.bucket_start.timestamp()) - START): tuple(r[c] for c in ("minutes", "complete", *RT.COUNTS, *RT.SIZES)) for r in df.collect()}


def test_the_stream_is_its_batch_twin(rocks, tmp_path):
    batches = {
        "1001": [line(i, 7 * i, [f"10.0.{i % 5}.0/24", "2001:db8::/32"][: 1 + i % 2], ["10.9.0.0/16"] if i % 4 == 0 else [], peer=str(i % 3)) for i in range(40)] + ["no message", json.dumps({"timestamp": START + 65})],
        "1002": [line(100 + i, 400 + 50 * i, [f"10.1.{i}.0/24"], host="rrc01.y") for i in range(30)],  # most of the hour, another collector
        "1003": [line(200, 10, ["10.77.0.0/16"]), line(201, 4000, ["10.0.0.0/24"])],  # a late row, and the hour's end
        "1004": [line(300, 4500), line(301, 130, ["10.0.1.0/24"], ["2001:db8::/32"]), json.dumps({"timestamp": START + 3000})],
        "1005": [line(400, 20_000), line(404, 140)],  # the closed hour once more
        "1006": [line(401, 19_990, host="rrc02.z"), line(402, 900, host="rrc02.z"), line(403, 20_001)],
    }
    put(tmp_path / "in", batches)
    out = run(rocks, tmp_path)
    rows = RT.keyed(S.parse_messages(rocks.read.text(str(tmp_path / "in"))), F.lit("ris"))
    now = F.timestamp_seconds(F.lit(START + 20_001))
    for granularity in ("MINUTE", "HOUR"):
        want = told(RT.closed(rows, granularity, now))
        assert told(RT.newest(out, granularity)) == want and len(want) > 10
    minutes = out.where("granularity = 'MINUTE'")
    first = [(r.revision, r.messages, r.rejected) for r in minutes.where((F.col("rrc") == "rrc00") & (F.col("bucket_start") == F.timestamp_seconds(F.lit(START)))).orderBy("revision").collect()]
    assert first == [(1, 9, 0), (2, 10, 0)]
    # A minute that nothing came for is a valid zero; a rejected line makes its minute incomplete.
    by = told(RT.newest(out, "MINUTE"))
    assert by["rrc00", 600][:3] == (1, True, 0) and by["", 60][:2] == (1, False)
    hours = {(r.bucket_start.timestamp() - START, r.revision): (r.minutes, r.messages) for r in out.where("granularity = 'HOUR' and rrc = 'rrc00'").collect()}
    assert hours[0, 1] == (60, 42) and hours[0, 2] == (60, 43)
    assert out.select("rrc", "granularity", "bucket_start", "revision").distinct().count() == out.count()
    # Nothing new: a second run adds nothing.
    n = out.count()
    assert run(rocks, tmp_path).count() == n


def test_an_earlier_first_minute_and_rows_beyond_the_state(rocks, tmp_path):
    put(tmp_path / "in", {"1001": [line(1, 7200)], "1002": [line(2, 7500)], "1003": [line(3, 7000)], "1004": [line(4, 12_000)], "1005": [line(5, 13_000)], "1006": [line(6, 7300)], "1007": [line(7, 13_001)]})
    out = run(rocks, tmp_path, keep_s=4000)
    by = told(RT.newest(out, "MINUTE"))
    # The collector's minutes begin with its earliest row; the row of 7,300 came when its hour had left the state.
    assert min(k[1] for k in by) == 6960 and by["rrc00", 7260][2] == 0 and by["rrc00", 7200][2] == 1 and by["rrc00", 7080][2] == 0
    assert max(k[1] for k in by) == 12_720
    hours = told(RT.newest(out, "HOUR"))
    assert hours["rrc00", 3600][:3] == (4, False, 1) and hours["rrc00", 7200][:3] == (60, True, 2)


def test_keyed_rows_of_odd_messages(spark):
    lines = spark.createDataFrame([("no message", "2024-01-01 00:02:10"), (line(1, 5), None), (json.dumps({"timestamp": START + 70}), None), ("", None)], "value string, got string").withColumn("got", F.col("got").cast("timestamp"))
    rows = {(r.second - START, r.rejected, len(r.announced), r.rrc) for r in RT.keyed(S.parse_messages(lines, keep=["got"]), F.lit("ris"), "got").collect()}
    assert rows == {(130, True, 0, ""), (5, False, 1, "rrc00"), (70, True, 0, "")}

"""Streams over files give what the same rows give as a batch."""

import datetime as dt
import random
import time

from pyspark.sql import functions as F

from threadline.streaming import replay, stateful, streams

DDL = "msg_id long, chat_id long, type string, message string, ts timestamp"
T0 = dt.datetime(2024, 1, 1)


def stream(spark, tmp_path, rows):
    src = str(tmp_path / "in")
    spark.createDataFrame(rows, DDL).coalesce(1).write.parquet(src)
    return spark.readStream.schema(DDL).parquet(src)


def in_files(spark, tmp_path, *parts):
    """A stream of one file per batch."""
    src = str(tmp_path / "in")
    for rows in parts:
        spark.createDataFrame(rows, DDL).coalesce(1).write.mode("append").parquet(src)
        time.sleep(1.1)  # files are taken by age
    return spark.readStream.schema(DDL).option("maxFilesPerTrigger", 1).parquet(src)


def finished(df, tmp_path, mode="append"):
    name = f"out_{abs(hash(str(tmp_path)))}"
    q = df.writeStream.format("memory").queryName(name).outputMode(mode).option("checkpointLocation", str(tmp_path / "cp")).trigger(availableNow=True).start()
    q.awaitTermination(120)
    return df.sparkSession.table(name).collect()


def at(seconds):
    return T0 + dt.timedelta(seconds=seconds)


def test_ids_once(spark, tmp_path):
    rows = [(1, 1, "user", "a", at(0)), (1, 1, "user", "a", at(1)), (2, 1, "user", "b", at(2))]
    assert sorted(r.msg_id for r in finished(streams.first_of_each_id(stream(spark, tmp_path, rows)), tmp_path)) == [1, 2]


def test_bursts(spark, tmp_path):
    rows = [(1, 1, "assistant", "a", at(0)), (2, 1, "team", "b", at(30)), (3, 1, "user", "x", at(40)), (4, 1, "assistant", "c", at(200)), (9, 2, "assistant", "end", at(90_000))]
    got = finished(streams.bursts(stream(spark, tmp_path, rows)), tmp_path, "complete")
    assert sorted((r.chat_id, r.n_messages) for r in got) == [(1, 1), (1, 2), (2, 1)]


def test_daily(spark, tmp_path):
    rows = [(1, 1, "user", "a", at(0)), (2, 1, "team", "b", at(30)), (3, 1, "user", "c", at(90_000))]
    got = finished(streams.daily_counts(stream(spark, tmp_path, rows)), tmp_path, "complete")
    assert sorted((r.messages, r.from_users) for r in got) == [(1, 1), (2, 1)]


def test_late_rows_are_set_aside(spark, tmp_path):
    rows = [(1, 1, "user", "old", at(0)), (2, 1, "user", "new", at(10 * 86_400))]
    q = streams.write_batches(stream(spark, tmp_path, rows), str(tmp_path / "out"), str(tmp_path / "cp")).trigger(availableNow=True).start()
    q.awaitTermination(120)
    assert [r.msg_id for r in spark.read.parquet(str(tmp_path / "out")).collect()] == [2]
    assert [r.msg_id for r in spark.read.parquet(str(tmp_path / "out_late")).select(F.col("msg_id")).collect()] == [1]


def test_near_copies_of_a_stream(spark, tmp_path):
    a = [(1, 1, "assistant", "x", at(0)), (2, 1, "team", "x", at(1)), (3, 1, "user", "x", at(1)), (4, 2, "assistant", "x", at(1))]
    b = [(5, 1, "assistant", "x", at(2)), (6, 1, "assistant", "x", at(2.5)), (7, 1, "assistant", "x", at(4)), (8, 1, "assistant", "y", at(4))]
    got = finished(stateful.without_near_copies(in_files(spark, tmp_path, a, b)), tmp_path)
    assert sorted(r.msg_id for r in got) == [1, 3, 4, 6, 8]


def test_chunks_of_a_stream_are_those_of_a_table(spark, tmp_path):
    from threadline.operators import chunks as ch

    rng, rows = random.Random(4), []
    for chat in range(6):
        when = 0
        for _ in range(15):
            when += rng.choice([30, 60, 61, 3000, 3601, 86_400, 3 * 86_400])
            rows.append((len(rows), chat, rng.choice(["user", "assistant", "automated"]), "m", at(when)))
    rows.sort(key=lambda r: r[4])
    end = [[(10_000 + i, 99, "assistant", "end", at(10_000_000 * (i + 1)))] for i in range(2)]
    got = finished(stateful.chunks(in_files(spark, tmp_path, rows[:40], rows[40:], *end)), tmp_path)
    table = [(i, c, c, kind, m, int((t - T0).total_seconds() * 1_000_000)) for i, c, kind, m, t in rows]
    want = ch.chunks(spark.createDataFrame(table, "msg_id long, chat_id long, user_id long, type string, message string, at_us long")).collect()
    assert {(r.msg_id, r.chunk_no, r.kind) for r in got if r.chat_id != 99} == {(r.msg_id, r.chunk_no, r.kind) for r in want}


def messages(seed, chats, each):
    rng, rows = random.Random(seed), []
    for chat in range(chats):
        when = 0
        for _ in range(each):
            when += rng.choice([0, 30, 60, 61, 3000, 3601, 86_400, 3 * 86_400])
            rows.append((len(rows), chat, chat, rng.choice(["user", "assistant", "automated"]), "m", at(when)))
    return rows


BATCH = "msg_id long, chat_id long, user_id long, type string, message string, ts timestamp"


def batch_chunks(spark, rows):
    from threadline.operators import chunks as ch

    table = [(i, c, u, kind, m, int((t - T0).total_seconds() * 1_000_000) + 1_704_067_200_000_000) for i, c, u, kind, m, t in rows]
    found = ch.chunks(spark.createDataFrame(table, "msg_id long, chat_id long, user_id long, type string, message string, at_us long"))
    return {(r.msg_id, r.chunk_no, r.kind) for r in found.collect()}


def test_stream_with_late_rows_equals_the_batch_segments(spark, tmp_path):
    """Rows come shuffled over four batches, so most chats get rows long before ones they have."""
    rows = messages(6, 5, 14)
    order = rows[:]
    random.Random(1).shuffle(order)
    src, path = str(tmp_path / "in"), str(tmp_path / "segments")
    for i in range(4):
        spark.createDataFrame(order[i::4] + order[i : i + 1], BATCH).coalesce(1).write.mode("append").parquet(src)
        time.sleep(1.1)
    files = spark.readStream.schema(BATCH).option("maxFilesPerTrigger", 1).parquet(src)
    replay.segment_batches(files, path, str(tmp_path / "cp"), buckets=3).trigger(availableNow=True).start().awaitTermination(300)
    got = lambda: {(r.msg_id, r.chunk_no, r.kind) for r in replay.current(spark, path).collect()}
    want = batch_chunks(spark, rows)
    assert got() == want
    # a batch that is tried again, here as the newest, changes nothing; nor does cleaning up
    again = spark.createDataFrame(order[3::4], BATCH)
    replay.segment_batch(again, 3, path, buckets=3)
    assert got() == want
    assert replay.vacuum(spark, path) > 0
    assert got() == want


def test_only_touched_chats_are_made_again(spark, tmp_path):
    """A batch writes new versions of its chats' buckets only, and a version that is not listed is not seen."""
    rows, path = messages(7, 6, 6), str(tmp_path / "segments")
    replay.segment_batch(spark.createDataFrame(rows, BATCH), 0, path, buckets=4)
    late = [(1000, 2, 2, "user", "late", at(10))]
    replay.segment_batch(spark.createDataFrame(late, BATCH), 1, path, buckets=4)
    assert sorted(r["batch"] for r in replay.versions(spark, path).collect()).count(1) == 1
    assert {(r.msg_id, r.chunk_no, r.kind) for r in replay.current(spark, path).collect()} == batch_chunks(spark, rows + late)
    spark.range(1).selectExpr("1L chat_id", "77L msg_id", "0 bucket", "9L batch").write.mode("append").partitionBy("bucket", "batch").parquet(path)
    assert replay.current(spark, path).where("msg_id = 77").isEmpty()


def test_state_is_bounded_and_restarts(spark, tmp_path):
    """Decided rows leave the state; a query that stops goes on from its checkpoint, with chunks numbered on."""
    from threadline.operators import chunks as ch

    day = 86_400
    rows = [(i, 1, "user" if i % 10 == 0 else "assistant", "m", at(i * day / 2)) for i in range(60)]
    end = [(10_000 + i, 99, "assistant", "end", at(10_000_000 * (i + 1))) for i in range(2)]
    src, out, cp = str(tmp_path / "in"), str(tmp_path / "out"), str(tmp_path / "cp")
    held = []
    for part in (rows[:30], rows[30:], end[:1], end[1:]):
        spark.createDataFrame(part, DDL).coalesce(1).write.mode("append").parquet(src)
        found = stateful.chunks(spark.readStream.schema(DDL).parquet(src))  # a new query each time
        q = found.writeStream.option("checkpointLocation", cp).trigger(availableNow=True).start(out)
        q.awaitTermination(120)
        held.append(q.lastProgress["stateOperators"][0]["numRowsTotal"])
    got = {(r.msg_id, r.chunk_no, r.kind) for r in spark.read.parquet(out).collect() if r.chat_id == 1}
    table = [(i, c, c, kind, m, int((t - T0).total_seconds() * 1_000_000)) for i, c, kind, m, t in rows]
    want = ch.chunks(spark.createDataFrame(table, "msg_id long, chat_id long, user_id long, type string, message string, at_us long")).collect()
    assert got == {(r.msg_id, r.chunk_no, r.kind) for r in want}
    assert max(held) < 30  # of 62 rows

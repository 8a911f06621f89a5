"""Keyed tables, versioned tables, and logs that end at a marker."""

import json
import os
from pathlib import Path

import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from tidewatch.session import scratch_path
from tidewatch.sources import keyed, messages, versioned
from tidewatch.sources.sinks import epoch_writer, read_epochs
from tidewatch.sources.streams import decode_json
from tidewatch.streaming.running import drain, drain_until, to_batches

SCHEMA = "id bigint, part string, v double"
KEYS = ("id", "part")


def local(path):
    return Path(path.removeprefix("file:"))


def files_below(path):
    return sorted(str(p) for p in local(path).rglob("*") if p.is_file() and not p.name.startswith((".", "_")))


def rows(spark, numbers, v=1.0):
    return spark.createDataFrame([(i, f"p{i % 3}" if i % 7 else None, v) for i in numbers], SCHEMA)


def stored(spark, path):
    return sorted((tuple(r) for r in keyed.read_keyed(spark, path, SCHEMA).collect()), key=str)


def test_keyed_table_takes_a_batch_once(spark):
    path = scratch_path(spark, "keyed")
    assert stored(spark, path) == []
    first = rows(spark, range(40))
    keyed.write_keyed(first, path, KEYS, buckets=4)
    keyed.write_keyed(first, path, KEYS, buckets=4)
    keyed.write_keyed(rows(spark, range(30, 60), 2.0).unionByName(rows(spark, range(50, 60), 3.0)), path, KEYS, buckets=4)
    got = stored(spark, path)
    assert [r[0] for r in sorted(got)] == list(range(60))
    assert all(r[2] == 1.0 for r in got if r[0] < 40) and all(r[2] in (2.0, 3.0) for r in got if r[0] >= 40)


def test_keyed_table_replaces(spark):
    path = scratch_path(spark, "keyed")
    for v in (1.0, 2.0, 3.0):
        keyed.write_keyed(rows(spark, range(20 if v == 1.0 else 10), v), path, KEYS, "replace", buckets=3)
    assert {r[0]: r[2] for r in stored(spark, path)} == {i: 3.0 if i < 10 else 1.0 for i in range(20)}


def test_keyed_table_stays_few_files(spark):
    path = scratch_path(spark, "keyed")
    for k in range(25):
        keyed.write_keyed(rows(spark, range(4 * k, 4 * k + 4)), path, KEYS, buckets=2)
    assert len(stored(spark, path)) == 100
    assert len(files_below(path)) <= 2 * keyed.MOST_FILES + 2 * keyed.KEPT * 2 + keyed.KEPT + 1


def batches(numbers):
    table = pa.table({"id": numbers, "part": ["x"] * len(numbers), "v": [0.5] * len(numbers), keyed.BUCKET: pa.array([n % 2 for n in numbers], pa.int32())})
    return iter(table.to_batches())


def test_tasks_and_batches_that_run_twice(spark):
    """Attempts of one task both write; only the one that is committed counts. An aborted batch leaves nothing."""
    path = scratch_path(spark, "keyed")
    writer = keyed._StreamWriter({"path": path, "keys": "id,part"})
    lost, won = writer.write(batches([1, 2, 3])), writer.write(batches([1, 2, 3]))
    assert set(lost.files.values()).isdisjoint(won.files.values())
    writer.commit([won, None], 0)
    assert len(stored(spark, path)) == 3
    # The same batch again, as after a driver that died between the two commits.
    writer.commit([writer.write(batches([1, 2, 3]))], 0)
    assert len(stored(spark, path)) == 3
    failed = writer.write(batches([3, 4, 5]))
    before = newest = keyed.newest_snapshot(path)
    writer.abort([failed, None], 1)
    assert keyed.newest_snapshot(path) == before == newest and len(stored(spark, path)) == 3
    assert not any(str(local(path) / n) in files_below(path) for n in failed.files.values())
    writer.commit([writer.write(batches([3, 4, 5]))], 1)
    assert sorted(r[0] for r in stored(spark, path)) == [1, 2, 3, 4, 5]


def test_a_bucket_reads_its_own_files_only(spark):
    path = scratch_path(spark, "keyed")
    writer = keyed._BatchWriter({"path": path, "keys": "id,part"})
    writer.commit([writer.write(batches(list(range(10))))])
    odd = keyed.newest_snapshot(path).files["1"]
    for name in odd:
        (local(path) / name).write_bytes(b"not parquet")
    writer.commit([writer.write(batches([0, 2, 100]))])  # even keys never touch the odd bucket
    assert len(keyed.newest_snapshot(path).files["0"]) == 2
    with pytest.raises(pa.ArrowInvalid):
        writer.write(batches([1]))


def test_keyed_stream_with_a_repeated_batch(spark):
    folder, path = scratch_path(spark, "in"), scratch_path(spark, "keyed")
    for k in range(3):
        rows(spark, range(10 * k, 10 * k + 15)).coalesce(1).write.mode("append").parquet(folder)
    read = lambda: spark.readStream.schema(SCHEMA).option("maxFilesPerTrigger", 1).parquet(folder)
    drain(keyed.keyed_writer(read(), path, KEYS, scratch_path(spark, "c"), buckets=3))
    assert [r[0] for r in sorted(stored(spark, path))] == list(range(35))
    # All batches once more, from a new checkpoint.
    drain(keyed.keyed_writer(read(), path, KEYS, scratch_path(spark, "c"), buckets=3))
    assert [r[0] for r in sorted(stored(spark, path))] == list(range(35))


def test_versions_replace_each_other_and_files_stay_few(spark):
    path = scratch_path(spark, "versions")
    make = lambda i: lambda before: spark.createDataFrame([(i, 0 if before is None else before.count())], "i int, n int")
    counts = set()
    for i in range(50):
        assert versioned.replace_version(spark, path, i, make(i)) == i
        if i >= versioned.SLOTS:
            counts.add(len(files_below(path)))
    assert len(counts) == 1
    assert tuple(versioned.read_version(spark, path).first()) == (49, 1)
    assert versioned.replace_version(spark, path, 49, make(99)) == 49  # a repeated batch
    assert versioned.read_version(spark, path).first().i == 49


def test_a_version_that_was_not_committed_is_not_seen(spark):
    path = scratch_path(spark, "versions")
    with pytest.raises(FileNotFoundError):
        versioned.read_version(spark, path)
    assert versioned.read_version(spark, path, "i int").count() == 0
    one = lambda i: lambda before: spark.createDataFrame([(i,)], "i int")
    versioned.replace_version(spark, path, 0, one(0), "i int")
    spark.createDataFrame([(7,)], "i int").write.parquet(f"{path}/data/1")  # written, but the writer died
    assert versioned.read_version(spark, path).first().i == 0
    versioned.replace_version(spark, path, 1, one(1), "i int")
    assert versioned.read_version(spark, path).first().i == 1


def feed(path, partition, name, numbers, marker=None):
    folder = local(path) / partition
    os.makedirs(folder, exist_ok=True)
    lines = [json.dumps({"id": n, "text": f"é id {n} -1"}) for n in numbers] + (["no json -1"] if name == "a" else [])
    lines += [json.dumps({"id": marker})] if marker is not None else []
    (folder / name).write_text("\n".join(lines) + ("\n" if name < "c" else ""), encoding="utf-8")


def test_log_is_read_to_its_markers_over_a_restart(spark):
    log, ends, out, checkpoint = (scratch_path(spark, n) for n in ("log", "ends", "out", "c"))
    os.makedirs(local(log))
    feed(log, "p0", "a", range(0, 50))
    feed(log, "p1", "a", range(100, 120))

    def run():
        stream, reached = messages.log_until(spark, log, ends, -1)
        decoded = decode_json(stream, "id bigint", keep=("partition", "position"))
        return to_batches(decoded, epoch_writer(out), checkpoint), reached

    writer, reached = run()
    kinds = "partition string, position bigint, id bigint, epoch bigint"
    count = lambda: read_epochs(spark, out, kinds).count()
    drain_until(writer, lambda: count() == 72, timeout=60)
    assert not reached()
    feed(log, "p0", "b", range(50, 60), marker=-1)
    feed(log, "p0", "c", range(60, 70), marker=-1)  # beyond the marker
    feed(log, "p1", "b", range(120, 125))
    feed(log, "p1", "c", [125], marker=-1)
    writer, reached = run()
    drain_until(writer, reached, timeout=60)
    writer, reached = run()
    drain_until(writer, reached, timeout=60)  # nothing is left to read
    got = spark.read.parquet(out).orderBy("partition", "position").collect()
    ids = {p: [r.id for r in got if r.partition == p] for p in ("p0", "p1")}
    assert ids == {"p0": [*range(50), None, *range(50, 60), -1], "p1": [*range(100, 120), None, *range(120, 126), -1]}


def test_log_in_one_folder_and_a_second_consumer(spark):
    log = scratch_path(spark, "log")
    feed(log, ".", "a", range(5), marker="end")
    for _ in range(2):
        ends, out = scratch_path(spark, "ends"), scratch_path(spark, "out")
        stream, reached = messages.log_until(spark, log, ends, "end")
        drain_until(to_batches(stream.select("value"), epoch_writer(out), scratch_path(spark, "c")), reached, timeout=60)
        assert spark.read.parquet(out).filter(F.col("value").contains("end")).count() == 1
        assert spark.read.parquet(out).count() == 7


def test_append_of_facts_that_is_repeated(spark):
    from tidewatch.sources.sinks import append_rows, within_batch

    path = scratch_path(spark, "facts")
    for _ in range(2):
        append_rows(rows(spark, range(12)), path, KEYS)
    assert len(stored(spark, path)) == 12
    near = within_batch(rows(spark, range(100)), rows(spark, range(10, 13)), "id")
    assert sorted(r.id for r in near.collect()) == [10, 11, 12]
    assert within_batch(rows(spark, range(3)), rows(spark, range(3)).filter("false"), "id").count() == 0

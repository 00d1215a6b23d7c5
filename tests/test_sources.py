"""Files, partitions, tables and topic options."""

import time

import pytest
from pyspark.sql import functions as F

from tests import fixtures
from tidematch import schemas
from tidematch.sources import files, kafka, partitions, tables
from tidematch.streaming import jobs


def test_rows_and_lines(spark, tmp_path):
    people = files.from_rows(spark, [(1, "a", "b")], schemas.PEOPLE)
    assert people.first()["name"] == "a"
    (tmp_path / "lines.txt").write_text("one\ntwo\n")
    assert files.text_lines(spark, str(tmp_path)).count() == 2


def test_delimited_with_header_and_crlf(spark, tmp_path):
    names = schemas.USER_LOCATION.fieldNames()
    row = ["1", "11111", "12.1012", "32.1012", "", "destination1"]
    text = "\x01".join(names) + "\r\n" + "\x01".join(row)
    (tmp_path / "users.csv").write_bytes(text.encode())
    got = files.delimited(spark, str(tmp_path), schemas.USER_LOCATION, header=True).collect()
    assert [tuple(r) for r in got] == [("1", "11111", "12.1012", "32.1012", None, "destination1")]


def test_delimited_round_trip(spark, tmp_path):
    users = fixtures.user_location_info(spark)
    files.write_delimited(users, f"{tmp_path}/out")
    back = files.delimited(spark, f"{tmp_path}/out", schemas.USER_LOCATION_INFO)
    assert sorted(map(tuple, back.collect())) == sorted(map(tuple, users.collect()))


def test_numbered_rows(spark):
    got = [r["value"] for r in files.numbered_rows(spark, 2).orderBy("value").collect()]
    assert got == ["0\x01name0\x01\x01destination0", "1\x01name1\x01\x01destination1"]


def test_spread_scan_only_small_tables(spark, tmp_path):
    spark.range(10).coalesce(1).write.parquet(f"{tmp_path}/one")
    spark.range(1000).repartition(40).write.parquet(f"{tmp_path}/many")
    cores = spark.sparkContext.defaultParallelism
    one = files.spread_scan(spark.read.parquet(f"{tmp_path}/one"))
    assert one.rdd.getNumPartitions() == cores
    many = spark.read.option("maxPartitionBytes", 1).parquet(f"{tmp_path}/many")
    if many.rdd.getNumPartitions() >= cores:
        assert files.spread_scan(many) is many


@pytest.fixture(scope="module")
def users_table(spark):
    tables.create_table(
        spark, "user_location_temporal", schemas.USER_LOCATION_INFO,
        properties={"streaming-source.partition.include": "latest"},
    )
    table = "user_location_temporal"
    tables.overwrite_partition(fixtures.user_location_info(spark, 6), table, "20220217")
    tables.overwrite_partition(fixtures.user_location_info(spark, 7), table, "20220218")
    return table


def test_latest_partition_by_name(spark, users_table):
    assert partitions.latest_by_name(spark, users_table) == "20220218"
    assert partitions.latest_partition(spark, users_table).count() == 7
    assert tables.table_property(
        spark, users_table, "streaming-source.partition.include") == "latest"


def test_latest_partition_by_write_time(spark, users_table):
    time.sleep(1.1)
    tables.overwrite_partition(fixtures.user_location_info(spark, 5), users_table, "20220217")
    assert partitions.latest_partition(spark, users_table, "create-time").count() == 5
    assert partitions.latest_partition(spark, users_table).count() == 7


def test_one_partition_is_scanned(spark, users_table):
    chosen = partitions.fixed_partition(partitions.read_table(spark, users_table), "20220218")
    assert chosen.count() == 7
    assert len(chosen.inputFiles()) == len(
        {f for f in spark.table(users_table).inputFiles() if "partstart=20220218" in f}
    )


def test_latest_is_looked_up_again_after_the_interval(spark, tmp_path):
    path = f"{tmp_path}/users"
    rows = fixtures.user_location(spark).select("cert_nbr")
    tables.write_partitioned(rows.withColumn("partstart", F.lit("20220207")), path)
    always = partitions.LatestPartition(path)
    rarely = partitions.LatestPartition(path, interval_s=3600)
    assert always(spark).count() == rarely(spark).count() == 6
    tables.write_partitioned(rows.limit(2).withColumn("partstart", F.lit("20220210")), path)
    assert always(spark).count() == 2
    assert partitions.latest_by_write_time(spark, path) == "20220210"
    assert rarely(spark).count() == 6
    assert partitions.read_table(spark, path).count() == 8


def test_table_stream_reads_a_file_or_a_folder(spark, tmp_path):
    spark.range(5).coalesce(1).write.parquet(f"{tmp_path}/many.parquet")
    part = next((tmp_path / "many.parquet").glob("part-*"))
    (tmp_path / "one.parquet").write_bytes(part.read_bytes())
    for name in ("many", "one"):
        stream = files.table_stream(spark, str(tmp_path), name)
        out = f"{tmp_path}/out-{name}"
        jobs.run_available(jobs.file_writer(stream, out, f"{tmp_path}/checkpoint-{name}"))
        assert spark.read.parquet(out).count() == 5


def test_empty_table_has_no_latest_partition(spark):
    tables.create_table(spark, "no_users", schemas.USER_LOCATION)
    assert partitions.latest_partition(spark, "no_users").count() == 0
    assert partitions.LatestPartition("no_users")(spark).count() == 0


def test_properties_say_which_partitions(spark, users_table):
    latest = partitions.table_reader(spark, users_table)
    assert isinstance(latest, partitions.LatestPartition) and latest(spark).count() == 7
    whole = partitions.table_reader(spark, users_table, {partitions.INCLUDE: "all"})
    assert whole(spark).count() == spark.table(users_table).count()
    slow = partitions.table_reader(
        spark, users_table, {partitions.INTERVAL: "12 h", partitions.ORDER: "create-time"}
    )
    assert (slow.interval_s, slow.order) == (43200, "create-time")


def test_insert_and_truncate(spark):
    tables.create_table(spark, "people", schemas.PEOPLE, partition=None)
    tables.insert_rows(files.from_rows(spark, [(1, "a", "b")], schemas.PEOPLE), "people")
    tables.insert_rows(files.from_rows(spark, [(2, "c", "d")], schemas.PEOPLE), "people")
    assert spark.table("people").count() == 2
    tables.truncate(spark, "people")
    assert spark.table("people").count() == 0


def test_topic_options():
    assert kafka.source_options("host:1", ["a", "b"], "earliest", max_per_trigger=5) == {
        "kafka.bootstrap.servers": "host:1",
        "subscribe": "a,b",
        "startingOffsets": "earliest",
        "maxOffsetsPerTrigger": "5",
    }
    by_time = kafka.source_options("host:1", "a", start_timestamp_ms=7, min_partitions=3)
    assert by_time["startingTimestamp"] == "7" and "startingOffsets" not in by_time
    assert by_time["minPartitions"] == "3"


def test_a_file_written_in_place_makes_its_partition_the_latest(spark, tmp_path):
    """Folders' times do not change, names with special characters do not matter."""
    path = f"{tmp_path}/users"
    rows = fixtures.user_location(spark).select("cert_nbr").coalesce(1)
    for value in ("20220207", "2022 02/10", "20220218"):
        tables.write_partitioned(rows.withColumn("partstart", F.lit(value)), path)
        time.sleep(0.05)
    assert partitions.latest_by_write_time(spark, path) == "20220218"
    folder = next(p for p in (tmp_path / "users").iterdir() if "02%2F10" in p.name)
    before = folder.stat().st_mtime_ns
    file = next(folder.glob("*.parquet"))
    with file.open("r+b") as open_file:
        data = open_file.read()
        open_file.seek(0)
        open_file.write(data)
    assert folder.stat().st_mtime_ns == before
    assert partitions.latest_by_write_time(spark, path) == "2022 02/10"
    assert partitions.latest_partition(spark, path, "create-time").count() == rows.count()
    assert set(partitions.newest_files(spark, path)) == {"20220207", "2022 02/10", "20220218"}

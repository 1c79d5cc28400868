from types import SimpleNamespace

import pytest
from conftest import plan_of, rows_of
from pyspark.sql import functions as F

from marquee.functions import values
from marquee.plans import transport
from marquee.schemas import REVIEW, UNIFIED_REVIEW
from marquee import session as sessions
from marquee.session import drop_scratch, materialize, path_exists, scratch_path, shared_folder
from marquee.sources import files
from marquee.streaming import feeds, runs, topics


UNIFIED = [(f.name, f.dataType.simpleString()) for f in UNIFIED_REVIEW.fields]


@pytest.fixture
def published(spark, tmp_path):
    """A topic of 300 reviews in several files."""
    path = str(tmp_path / "topic")
    n = F.col("id")
    rows = spark.range(0, 300, 1, 6).select(
        F.concat(F.lit("rw"), n).alias("review_id"),
        F.concat(F.lit("Título "), n % 20).alias("movie"),
        F.when(n % 9 != 0, n % 10 + 0.5).alias("rating"),
        F.lit("2020-05-03").alias("review_date"),
        F.lit("2019.0").alias("release_time"),
    )
    topics.publish_files(topics.as_messages(rows, F.col("review_id")), path, "imdb")
    return path, rows


def test_broker_options():
    options = topics.kafka_source_options("host:1", "imdb")
    assert options == {
        "kafka.bootstrap.servers": "host:1",
        "subscribe": "imdb",
        "startingOffsets": "earliest",
        "failOnDataLoss": "true",
    }
    more = topics.kafka_source_options(
        "host:1", "imdb", "latest", True, 100, **{"kafka.security.protocol": "SSL"}
    )
    assert more["failOnDataLoss"] == "false" and more["maxOffsetsPerTrigger"] == "100"
    assert more["startingOffsets"] == "latest" and more["kafka.security.protocol"] == "SSL"


def test_places_in_a_topic_are_unique(spark, published):
    path, rows = published
    stored = spark.read.parquet(path)
    assert stored.select("topic", "partition", "offset").distinct().count() == rows.count()
    text = topics.message_text(stored)
    assert text.filter("key = 'rw5'").select("value").first()[0].startswith('{"review_id":"rw5"')


def test_stream_equals_batch(spark, published, tmp_path):
    path, _ = published
    table = str(tmp_path / "keyed")
    stream = feeds.parse(topics.read_files(spark, path, max_files_per_trigger=2), "imdb")
    query = runs.upsert(stream, table, str(tmp_path / "progress"), interval=None)
    runs.finish(query, timeout=120)
    assert len(query.recentProgress) >= 3
    batch = runs.visible(feeds.parse(spark.read.parquet(path), "imdb"))
    assert rows_of(runs.read_keyed(spark, table, stream.schema)) == rows_of(batch)
    assert batch.dtypes == UNIFIED


def test_replay_and_restart_leave_the_table_as_it_is(spark, published, tmp_path):
    path, rows = published
    table = str(tmp_path / "keyed")
    stream = feeds.parse(topics.read_files(spark, path, max_files_per_trigger=2), "imdb")
    once = None
    for checkpoint in ("a", "a", "b"):  # start, restart, replay from the beginning
        runs.finish(runs.upsert(stream, table, str(tmp_path / checkpoint), interval=None), 120)
        now = rows_of(runs.read_keyed(spark, table, stream.schema))
        once = once or now
        assert now == once and len(now) == rows.count()
    compacted = str(tmp_path / "compacted")
    runs.compact(spark, table, compacted, stream.schema)
    assert rows_of(runs.read_keyed(spark, compacted, stream.schema)) == once
    assert spark.read.parquet(compacted).count() == len(once) < spark.read.parquet(table).count()


def test_repeated_batch_replaces_itself(spark, published, tmp_path):
    """A batch that fails after writing is written again, not added."""
    path, rows = published
    table = str(tmp_path / "keyed")
    stream = feeds.parse(topics.read_files(spark, path), "imdb")
    write = runs.keyed_writer(table)

    def write_then_fail(batch, epoch):
        write(batch, epoch)
        raise RuntimeError("lost after writing")

    checkpoint = str(tmp_path / "progress")
    with pytest.raises(Exception, match="lost after writing"):
        runs.finish(runs.each_batch(stream, write_then_fail, checkpoint, interval=None), 120)
    runs.finish(runs.each_batch(stream, write, checkpoint, interval=None), 120)
    assert spark.read.parquet(table).count() == rows.count()


def test_later_message_supersedes(spark, tmp_path):
    path, table = str(tmp_path / "topic"), str(tmp_path / "keyed")
    row_id = values.stable_id(F.lit("imdb"), F.col("review_id"))
    for rating in (3.0, 8.0):
        row = spark.createDataFrame([("rw1", "a", rating, None, None)], REVIEW)
        topics.publish_files(topics.as_messages(row), path, "imdb")
        stream = feeds.parse(topics.read_files(spark, path), "imdb", row_id)
        runs.finish(runs.upsert(stream, table, str(tmp_path / "progress"), interval=None), 120)
    got = runs.read_keyed(spark, table, stream.schema).collect()
    assert len(got) == 1 and got[0].rating == 8.0


def test_empty_table(spark, tmp_path):
    got = runs.read_keyed(spark, str(tmp_path / "none"), UNIFIED_REVIEW)
    assert got.count() == 0 and got.schema == UNIFIED_REVIEW


def test_landing_appends(spark, published, tmp_path):
    path, rows = published
    landed, checkpoint = str(tmp_path / "landed"), str(tmp_path / "progress")
    for _ in range(2):
        text = topics.message_text(topics.read_files(spark, path, max_files_per_trigger=4))
        parsed = text.select(F.from_json("value", REVIEW).alias("v")).select("v.*")
        runs.finish(runs.land_json(parsed, landed, checkpoint, interval=None), 120)
    assert rows_of(files.read_json_lines(spark, landed, REVIEW)) == rows_of(rows)


def test_interval_trigger_and_timeout(spark, published, tmp_path):
    path, _ = published
    seen = []
    query = runs.each_batch(
        topics.read_files(spark, path), lambda df, epoch: seen.append((epoch, df.count())),
        str(tmp_path / "progress"), interval="1 second",
    )
    query.processAllAvailable()
    with pytest.raises(TimeoutError):
        runs.finish(query, timeout=1)
    assert not query.isActive
    assert seen[0] == (0, 300)


def test_writer_outside_a_stream(spark, tmp_path):
    with pytest.raises(RuntimeError, match="streaming query"):
        runs.keyed_writer(str(tmp_path))(spark.range(1), 0)


def test_feeds_share_one_schema(spark):
    shapes = {
        "imdb": ('{"review_id":"r","movie":"m","rating":7}', (None, None, 7.0, None)),
        "mubi-sqlite": ('{"review_id":"r","reviewer":"u","rating":"7"}', ("u", None, 3.5, 7.0)),
        "rotten-tomatoes": (
            '{"reviewId":"r","userId":"u","movieYear":"2019.0","rating":4.5,"score":9}',
            ("u", 2019, 4.5, 9.0),
        ),
    }
    for topic, (value, expected) in shapes.items():
        message = spark.createDataFrame([(value,)], "value string")
        row = feeds.parse(message, topic, F.lit("x"))
        assert row.dtypes == UNIFIED
        assert tuple(row.select("userId", "movieYear", "rating", "score").first()) == expected
        assert row.first().feed == topic and row.first().reviewId == "r"


def test_shared_folder(spark, tmp_path):
    def session(named, master, checkpoints=None):
        context = SimpleNamespace(
            master=master, getCheckpointDir=lambda: checkpoints, setCheckpointDir=used.append
        )
        conf = SimpleNamespace(get=lambda key, default: named)
        return SimpleNamespace(conf=conf, sparkContext=context)

    used = []
    assert shared_folder(session("hdfs://host/shared/", "yarn")) == "hdfs://host/shared"
    assert used == []
    with pytest.raises(RuntimeError, match="spark.checkpoint.dir"):
        shared_folder(session(None, "yarn"))
    local = shared_folder(session(None, "local[2]"))
    assert shared_folder(session(None, "local[2]", "set already")) == local
    assert used == [local + "/checkpoints"]
    assert scratch_path(spark, "a") != scratch_path(spark, "a")
    assert path_exists(spark, str(tmp_path)) and not path_exists(spark, str(tmp_path / "no"))
    assert path_exists(spark, f"file://{tmp_path}")


def test_scratch_is_dropped(spark, monkeypatch):
    monkeypatch.setattr(sessions, "_scratch_paths", [])
    kept = materialize(spark.range(5), "five")
    (path,) = sessions._scratch_paths
    assert kept.count() == 5 and path_exists(spark, path)
    drop_scratch(spark)
    assert not path_exists(spark, path) and sessions._scratch_paths == []


@pytest.mark.parametrize("repeated", [0, 1, 9, 90])
def test_ids_that_were_written_once_are_not_shuffled(spark, tmp_path, repeated):
    """Whatever the part of ids that come again, the last row of each is there, one of those without
    an id among them; without repeated ids reading exchanges nothing."""
    table, schema = str(tmp_path / "keyed"), "id string, v int, _timestamp int, _offset int"
    first = [(f"i{n}", n, 1, n) for n in range(100)] + [(None, -1, 1, 200)]
    later = [(f"i{n}", n + 1000, 2, 0) for n in range(repeated)] + [(f"i{n}", 7, 1, -1) for n in range(repeated)]
    later += [(None, -2, 3, 0)] * (repeated > 0)
    for rows in (first, later):
        spark.createDataFrame(rows, schema).write.mode("append").parquet(table)
    got = runs.read_keyed(spark, table, spark.createDataFrame([], schema).schema)
    want = [(f"i{n}", n + 1000 * (n < repeated)) for n in range(100)] + [(None, -1 - (repeated > 0))]
    assert sorted(map(tuple, got.collect()), key=str) == sorted(want, key=str)
    plan = plan_of(got).split("Physical Plan")[1]
    assert ("Exchange hashpartitioning" in plan) == (repeated > 0)


def test_a_drained_topic_goes(spark, sf_dir, monkeypatch):
    """What is on disk when a topic is published: no other topic."""
    published, there = [], []

    def publish(messages, path, topic):
        there.extend(path_exists(spark, p) for p in published)
        published.append(path)
        write(messages, path, topic)

    write = transport.topics.publish_files
    monkeypatch.setattr(transport.topics, "publish_files", publish)
    assert transport.stream_index(spark, sf_dir).count() > 0
    assert len(there) == 3 and not any(there) and not path_exists(spark, published[-1])

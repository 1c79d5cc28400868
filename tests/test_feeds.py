"""What is kept of a feed: offsets, sketches, counters, seen keys, the bucketed table."""

import random

import pytest
from conftest import rows_of
from pyspark.sql import functions as F
from pyspark.sql import types as T

from marquee.operators import frequency, heavy, quantiles
from marquee.operators.regression import evaluate
from marquee.sources import sinks
from marquee.streaming import buckets, offsets, runs


def _messages(spark, offsets_by_partition):
    rows = [("t", p, o) for p, all_ in offsets_by_partition.items() for o in all_]
    return spark.createDataFrame(rows, "topic string, partition int, offset long")


def test_offset_runs_of_any_batches(spark):
    draw = random.Random(5)
    landed = {p: sorted(draw.sample(range(200), 150)) * (p + 1) for p in range(2)}
    landed[2] = [7]
    whole = offsets.offset_runs(_messages(spark, landed), cell=16)
    parts = []
    for n in range(3):  # overlapping batches
        batch = {p: [o for o in all_ if o % 3 != n] for p, all_ in landed.items()}
        parts.append(offsets.offset_runs(_messages(spark, batch), cell=16))
    merged = offsets.merge_runs(parts[0].union(parts[1]).union(parts[2]))
    assert rows_of(merged) == rows_of(whole)
    gone = {
        (p, o)
        for p, first, last, n in (
            (r.partition, r.first, r.last, r.n) for r in offsets.missing_offsets(merged).collect()
        )
        for o in range(first, last + 1)
        if n == last - first + 1
    }
    want = {(p, o) for p, all_ in landed.items() for o in range(min(all_), max(all_)) if o not in set(all_)}
    assert gone == want


def test_offset_runs_without_offsets(spark):
    rows = spark.createDataFrame([("t", 0, None)], "topic string, partition int, offset long")
    assert offsets.missing_offsets(offsets.offset_runs(rows)).count() == 0
    assert offsets.offset_runs(rows).count() == 0


def test_quantiles_of_merged_sketches(spark):
    n = F.col("id")
    rows = spark.range(0, 60_000, 1, 6).select(
        (n % 3).alias("g"), (n * 7919 % 60_000).cast("double").alias("v"), (n % 5).alias("batch")
    )
    rows = rows.withColumn("v", F.when(F.col("g") != 2, F.col("v"))).unionByName(
        spark.createDataFrame([(0, float("nan"), 0)], "g long, v double, batch long")
    )
    kept = quantiles.sketch_values(rows, ["g", "batch"], "v")
    found = quantiles.quantiles(quantiles.merge_sketches(kept, ["g"]), ["g"], [0.0, 0.1, 0.5, 1.0])
    values = {g: sorted(v) for g, v in rows.where("v is not null and not isnan(v)").groupBy("g")
              .agg(F.collect_list("v")).collect()}
    seen = 0
    for row in found.collect():
        if row.g == 2:
            assert (row.n, row.value) == (0, None)
            continue
        rank = sum(v <= row.value for v in values[row.g]) / row.n
        assert row.n == 20_000 and abs(rank - row.share) <= 2 * quantiles.rank_error()
        seen += 1
    assert seen == 8


@pytest.mark.parametrize("width", [64, 1 << 16])
def test_frequent_values_equal_an_exact_count(spark, width):
    """With 64 cells every cell is full of other values: nothing is left out, nothing is wrong."""
    value = F.when(F.rand(3) < 0.4, F.lit(1)).otherwise((F.rand(4) * 3000).cast("int"))
    rows = spark.range(0, 20_000, 1, 4).select("id", value.alias("v"))
    rows = spark.createDataFrame(rows.collect() + [(-1, None)] * 50, "id long, v int").coalesce(3)
    want = frequency.frequent_values(rows, "v", 8)
    for parts in (1, 4):
        cells = None
        for k in range(parts):
            batch = heavy.count_cells(rows.where(F.pmod("id", F.lit(parts)) == k), "v", width)
            cells = batch if cells is None else cells.union(batch)
        merged = heavy.merge_cells(cells)
        assert rows_of(heavy.frequent_in_feed(rows, "v", merged, 8, width)) == rows_of(want)
    likely = heavy.candidates(rows, "v", merged, 1000, width)
    assert likely.where("v = 1").count() == rows.where("v = 1").count()
    if width > 64:
        assert likely.select("v").distinct().count() < 10


def _feed(spark, path, rows):
    schema = "id string, v int, at timestamp"
    spark.createDataFrame(rows, schema).coalesce(1).write.mode("append").parquet(path)
    return spark.readStream.schema(schema).option("maxFilesPerTrigger", "1").parquet(path)


def test_replayed_keys_land_once(spark, tmp_path):
    import datetime as dt

    path, landed, progress = (str(tmp_path / n) for n in ("feed", "landed", "progress"))
    start = dt.datetime(2024, 1, 1)
    rows = [(f"k{n}", n, start + dt.timedelta(minutes=n)) for n in range(20)]
    later = [(k, v + 100, at + dt.timedelta(minutes=5)) for k, v, at in rows]
    after = [("k3", 7, start + dt.timedelta(hours=9)), ("new", 1, start + dt.timedelta(hours=9))]
    expired = [("k3", 8, start + dt.timedelta(hours=10))]
    for batch in (rows + rows[:5], later, after, expired):  # a restart for each
        stream = runs.once(_feed(spark, path, batch), "id", "at", "1 hour").select("id", "v")
        runs.finish(runs.land_json(stream, landed, progress, interval=None))
    got = spark.read.json(landed).groupBy("id").agg(F.count("*").alias("n")).collect()
    counts = {row.id: row.n for row in got}
    assert set(counts) == {f"k{n}" for n in range(20)} | {"new"}
    assert counts.pop("k3") == 2  # again after its horizon, not again within it
    assert set(counts.values()) == {1}


@pytest.fixture
def keyed(spark, tmp_path):
    schema = T.StructType([
        T.StructField("id", T.StringType()), T.StructField("v", T.IntegerType()),
        T.StructField("_at", T.TimestampType()),
    ])
    return buckets.KeyedTable(str(tmp_path / "keyed"), schema, buckets=4, fan_in=3)


def _write(spark, tmp_path, keyed, name, parts):
    import datetime as dt

    path = str(tmp_path / name)
    for n, rows in enumerate(parts):
        stamped = [(k, v, dt.datetime(2024, 1, 1) + dt.timedelta(minutes=v)) for k, v in rows]
        stream = _feed(spark, path, stamped).withColumnRenamed("at", "_at")
        query = buckets.upsert_buckets(stream, keyed, str(tmp_path / f"{name}-progress"), interval=None)
        runs.finish(query)


def test_bucketed_table_merges_and_reads_without_a_shuffle(spark, tmp_path, keyed):
    assert buckets.read_buckets(spark, keyed).count() == 0
    parts = [[(f"k{n}", 10 * b + n) for n in range(b, b + 6)] for b in range(8)]
    _write(spark, tmp_path, keyed, "a", parts[:2])
    old = buckets.read_buckets(spark, keyed)  # planned before anything is merged
    want_old = {k: v for part in parts[:2] for k, v in part}
    _write(spark, tmp_path, keyed, "a", parts[2:])
    assert {r.id: r.v for r in old.collect()} == want_old
    tiers = sorted(buckets.manifest(spark, keyed).values())
    assert tiers == [0, 0, 1, 1]  # eight runs by threes
    now = buckets.read_buckets(spark, keyed)
    want = {k: v for part in parts for k, v in part}
    assert {r.id: r.v for r in now.collect()} == want and now.columns == ["id", "v"]
    assert "Exchange" not in now._jdf.queryExecution().executedPlan().toString()
    buckets.forget(spark, keyed)
    assert {r.id: r.v for r in buckets.read_buckets(spark, keyed).collect()} == want
    folders = {p.name for p in (tmp_path / "keyed" / "data").iterdir() if p.name.startswith("run=")}
    assert folders == {f"run={run}" for run in buckets.manifest(spark, keyed)}


def test_bucketed_table_keeps_the_newest_and_survives_a_failed_merge(spark, tmp_path, keyed, monkeypatch):
    _write(spark, tmp_path, keyed, "new", [[("x", 50)], [("y", 60)]])

    def fail(*args):
        raise OSError("lost")

    with monkeypatch.context() as patch:
        patch.setattr(buckets, "latest", fail)
        with pytest.raises(Exception, match="lost"):
            _write(spark, tmp_path, keyed, "old", [[("x", 5), ("y", 70)]])
    assert len(buckets.manifest(spark, keyed)) == 3  # published, not merged
    _write(spark, tmp_path, keyed, "old", [[("z", 1)]])  # the batch comes again, then the next
    assert {r.id: r.v for r in buckets.read_buckets(spark, keyed).collect()} == {"x": 50, "y": 70, "z": 1}


def test_another_number_of_buckets_is_refused(spark, tmp_path, keyed):
    _write(spark, tmp_path, keyed, "a", [[("x", 1)]])
    other = buckets.KeyedTable(keyed.path, keyed.schema, buckets=5)
    with pytest.raises(ValueError, match="buckets"):
        buckets.read_buckets(spark, other)


def test_a_repeated_run_replaces_its_metrics(spark, tmp_path):
    log = str(tmp_path / "log")
    rows = spark.createDataFrame([(1.0, 2.0), (3.0, 3.0)], "rating double, rating_prediction double")
    for run in ("a", "a", "b", None, None):
        evaluate(rows, "lr", metrics_path=log, run_id=run)
    assert sinks.read_metrics(spark, log).count() == 4


@pytest.mark.parametrize("chunk", [1, 8, 1 << 20])
def test_runs_are_merged_across_chunks(spark, chunk):
    """Overlapping runs, some longer than many chunks, below zero and without a topic or partition."""
    draw = random.Random(7)
    landed, rows = {}, []
    for place in (("t", 0), ("t", 1), (None, 0), ("t", None)):
        for _ in range(40):
            first = draw.randrange(-200, 600)
            last = first + draw.choice([0, 0, 1, 5, 60])
            rows.append((*place, first, last))
            landed.setdefault(place, set()).update(range(first, last + 1))
    merged = offsets.merge_runs(spark.createDataFrame(rows, offsets.RUNS), chunk)
    want = [
        (*place, first, next(o for o in range(first, 2000) if o + 1 not in all_))
        for place, all_ in landed.items() for first in all_ if first - 1 not in all_
    ]
    assert sorted(map(str, map(tuple, merged.collect()))) == sorted(map(str, want))
    gone = {place: set() for place in landed}
    for row in offsets.missing_offsets(spark.createDataFrame(rows, offsets.RUNS), chunk).collect():
        gone[row.topic, row.partition] |= set(range(row.first, row.last + 1))
        assert row.n == row.last - row.first + 1
    assert gone == {p: set(range(min(all_), max(all_))) - all_ for p, all_ in landed.items()}


def test_no_task_takes_all_runs_of_a_partition(spark):
    runs_ = spark.range(1000).select(
        F.lit("t").alias("topic"), F.lit(0).alias("partition"),
        (F.col("id") * 3).alias("first"), (F.col("id") * 3 + 1).alias("last"),
    )
    inside = offsets._merged_inside(offsets._chunked(runs_, 64)).groupBy(F.spark_partition_id().alias("p"))
    before = spark.conf.get("spark.sql.adaptive.coalescePartitions.enabled")
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        assert max(r["count"] for r in inside.count().collect()) < 1000
    finally:
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", before)
    assert offsets.missing_offsets(runs_, 64).count() == 999


def test_buckets_follow_the_ids():
    assert buckets.bucket_count(15_000) == 8
    assert buckets.bucket_count(54_000_000) >= 54_000_000 / buckets.BUCKET_IDS

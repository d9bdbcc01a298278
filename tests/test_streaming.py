"""Streams with state: late data, a restart, and the batch form's rows in the end."""

import random
from datetime import datetime, timedelta, timezone

import pytest
from pyspark.sql import functions as F

from loomspark.plans import lookback, research
from loomspark.streaming import edits as E

SCHEMA = "page string, rev long, at timestamp, editor string, sha string"


@pytest.fixture
def stored(spark):
    spark.conf.set("spark.sql.streaming.stateStore.providerClass", E.STATE_STORE)
    yield spark
    spark.conf.unset("spark.sql.streaming.stateStore.providerClass")


def arrivals():
    """Edits over ten hours in the order of arrival, up to half an hour late, and one far later that ends all waiting."""
    rng = random.Random(4)
    start = datetime(2024, 1, 1, tzinfo=timezone.utc)
    rows = [(rng.choice("pq") if i % 2 else "hot", i, start + timedelta(seconds=rng.randrange(36_000)), rng.choice("xyz"), rng.choice(["a", "b", "c", None])) for i in range(240)]
    rows.sort(key=lambda r: r[2] + timedelta(seconds=rng.randrange(1800)))
    return rows, ("end", 9999, start + timedelta(days=9), "x", "a")


def replayed(spark, tmp_path, stream, name):
    """What the stream appends over five files, with a stop and a new start after each, and the whole input."""
    rows, last = arrivals()
    source, target = tmp_path / f"in-{name}", tmp_path / f"out-{name}"
    for k in range(6):
        part = rows[k * 48 : (k + 1) * 48] if k < 5 else [last]
        spark.createDataFrame(part, SCHEMA).coalesce(1).write.mode("append").parquet(str(source))
        if k >= 4:  # the watermark moves between batches: the last start settles what it let go
            for _ in range(2 if k == 5 else 1):
                _run(spark, source, target, stream, tmp_path / f"check-{name}")
        else:
            _run(spark, source, target, stream, tmp_path / f"check-{name}")
    return spark.read.parquet(str(target)), spark.createDataFrame(rows, SCHEMA)


def _run(spark, source, target, stream, checkpoint):
    edits = spark.readStream.schema(SCHEMA).parquet(str(source))
    query = stream(edits).writeStream.format("parquet").option("path", str(target)).option("checkpointLocation", str(checkpoint)).trigger(availableNow=True).start()
    query.awaitTermination(300)
    assert query.exception() is None


def test_reverts(stored, tmp_path):
    got, whole = replayed(stored, tmp_path, lambda e: E.revert_stream(e, "page", "rev", "at", "sha", "1 hour", radius=5), "reverts")
    want = lookback.identity_reverts(whole.withColumn("ms", F.unix_millis("at")), "page", "rev", "ms", "sha", radius=5)
    assert sorted(map(repr, got.where("page <> 'end'").select("page", "rev", "position", "reverts_to").collect())) == sorted(map(repr, want.select("page", "rev", F.col("position").cast("long"), F.col("reverts_to").cast("long")).collect()))


def test_sessions(spark, tmp_path):
    got, whole = replayed(spark, tmp_path, lambda e: E.session_stream(e, "page", "editor", "at", "5 minutes", "1 hour"), "sessions")
    want = research.hyperevents(whole, "page", "editor", "at", "5 minutes")
    assert sorted(map(repr, got.where("page <> 'end'").collect())) == sorted(map(repr, want.select("page", "editors", "start").collect()))

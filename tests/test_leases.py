"""Key leases and token buckets: one task a key, its rate kept."""

import time

import pytest
from pyspark.sql import functions as F

from sentimart.operators.classify import rule_based_classifier
from sentimart.operators.leases import TokenBucket, classify_leased, deal, lease_report
from sentimart.schemas import SENTINEL
from sentimart.session import scratch_path


class Clock:
    def __init__(self):
        self.now, self.slept = 100.0, 0.0

    def time(self):
        return self.now

    def sleep(self, seconds):
        assert seconds > 0
        self.now += seconds
        self.slept += seconds


def test_bucket_keeps_rate_and_burst():
    clock = Clock()
    bucket = TokenBucket(4.0, burst=3, clock=clock.time, sleep=clock.sleep)
    taken = [bucket.take() for _ in range(20)]
    assert taken[:3] == [100.0] * 3
    assert all(b - a >= 0.25 - 1e-9 for a, b in zip(taken, taken[3:]))
    clock.now += 60                                        # never more than a burst is saved up
    assert [round(bucket.take() - clock.now, 6) for _ in range(3)] == [0, 0, 0] and clock.time() == pytest.approx(taken[-1] + 60)
    clock.now -= 1_000                                     # a clock set back gives nothing
    before = clock.slept
    bucket.take()
    assert clock.slept > before


def test_a_later_attempt_starts_without_tokens():
    clock = Clock()
    assert TokenBucket(2.0, burst=5, full=False, clock=clock.time, sleep=clock.sleep).take() == pytest.approx(100.5)
    with pytest.raises(ValueError):
        TokenBucket(0.0)


@pytest.mark.parametrize("parts", [1, 3, 16])
def test_rows_are_dealt_evenly_one_partition_a_key(spark, parts):
    dealt = deal(spark.range(0, 1_000, 1, parts).withColumn("hot", F.lit(1)), 4)
    n = {r["p"]: r["n"] for r in dealt.groupBy(F.spark_partition_id().alias("p")).agg(F.count("*").alias("n")).collect()}
    assert set(n) == {0, 1, 2, 3} and max(n.values()) - min(n.values()) <= parts


def counting_client(key):
    """Fails every third call, and marks its answers with its key."""
    calls = [0]

    def call(texts):
        calls[0] += 1
        if calls[0] % 3 == 0:
            raise ConnectionError("transient")
        return "\n".join(f"Comment {i}: key{key}, neutral" for i in range(1, len(texts) + 1))
    return call


@pytest.mark.parametrize("parts,barrier", [(1, False), (2, True), (24, False)])
def test_calls_of_a_key_neither_overlap_nor_exceed_its_rate(spark, parts, barrier):
    df = spark.range(0, 600, 1, parts).select("id", F.when(F.col("id") % 50 != 0, F.concat(F.lit("t"), "id")).alias("textoriginal"))
    out = classify_leased(df, [counting_client(k) for k in range(3)], rate=40.0, burst=2, batch_size=20,
                          sleep=lambda s: time.sleep(min(s, 0.05)), barrier=barrier)
    path = scratch_path(spark, "leased")
    out.write.parquet(path)                                # calls once: the report reads what is stored
    rows = spark.read.parquet(path)
    assert rows.count() == 600 and rows.where("textoriginal is null").select("emotion").distinct().first()[0] == SENTINEL
    assert rows.where("textoriginal is null and call is not null").count() == 0
    sent = rows.where("call is not null")
    assert sent.where("emotion <> concat('key', call.lease)").count() == 0          # each key by its own client
    report = {r["lease"]: r for r in lease_report(rows, 40.0, burst=2).collect()}
    assert set(report) == {0, 1, 2}
    assert all(r["n_overlapping"] == 0 and r["n_over_rate"] == 0 and r["n_calls"] >= 9 for r in report.values())
    assert sent.where("call.attempts > 1").count() > 0


def test_report_finds_what_breaks_the_lease(spark):
    rows = [((0, 0, 1, [0.0], [1.0]),), ((0, 1, 1, [0.5], [2.0]),), ((1, 0, 1, [0.0], [0.1]),), ((1, 1, 1, [0.2], [0.3]),)]
    df = spark.createDataFrame(rows, "call struct<lease:int,slice:long,attempts:int,started:array<double>,ended:array<double>>")
    got = {r["lease"]: (r["n_overlapping"], r["n_over_rate"]) for r in lease_report(df, rate=1.0).collect()}
    assert got == {0: (1, 1), 1: (0, 1)}


def test_rule_based_labels_are_the_same_as_without_leases(spark):
    df = spark.createDataFrame([("I love it",), ("sad",), (None,)], "textoriginal string")
    got = {r["textoriginal"]: r["emotion"] for r in classify_leased(df, [rule_based_classifier] * 2, rate=1_000.0).collect()}
    assert got == {"I love it": "love", "sad": "sadness", None: SENTINEL}

from pyspark.sql import functions as F

from stormledger.functions import flags, times, weather
from stormledger.functions.scores import safe_ratio
from stormledger.operators.training import hash_split
from stormledger.sources.outages import outage_part
from stormledger.schemas import OUTAGE_RAW

from .helpers import at, rows


def times_of(spark, *texts):
    return spark.createDataFrame([(at(t),) for t in texts], "t timestamp_ntz")


def test_block_boundaries(spark):
    df = times_of(spark, "2024-03-10 05:59:59", "2024-03-10 06:00:00", "2024-03-10 23:59:59")
    got = df.select(times.block_end_6h(F.col("t")).alias("b"), times.block_start_6h(F.col("t")), times.trunc_hour(F.col("t")))
    assert dict(got.dtypes)["b"] == "timestamp_ntz"
    assert rows(got) == [
        (at("2024-03-10 06:00"), at("2024-03-10 00:00"), at("2024-03-10 05:00")),
        (at("2024-03-10 12:00"), at("2024-03-10 06:00"), at("2024-03-10 06:00")),
        (at("2024-03-11 00:00"), at("2024-03-10 18:00"), at("2024-03-10 23:00")),
    ]


def test_minutes_are_elapsed_and_truncated(spark):
    df = spark.createDataFrame(
        [(at("2024-03-10 01:00"), at("2024-03-10 04:00:59")), (at("2024-03-10 00:00"), at("2024-03-12 00:00:00")),
         (at("2024-03-10 00:00"), at("2024-03-10 00:00:59"))],
        "a timestamp_ntz, b timestamp_ntz",
    )
    assert rows(df.select(times.minutes_between(F.col("a"), F.col("b")))) == [(180,), (2880,), (0,)]


def test_chunk_start(spark):
    df = times_of(spark, "2024-03-10 02:29:59", "2024-03-10 23:30:00")
    assert rows(df.select(times.chunk_start(F.col("t"), 30))) == [(at("2024-03-10 02:00"),), (at("2024-03-10 23:30"),)]


def test_unknown_updraft_stays_unknown(spark):
    df = spark.createDataFrame([(-2.0,), (2.0,), (None,)], "omega double")
    assert rows(df.select(weather.updraft_proxy(F.col("omega")))) == [(2.0,), (0.0,), (None,)]


def test_safe_ratio(spark):
    df = spark.createDataFrame([(1, 4), (1, 0), (1, None), (None, 4)], "a bigint, b bigint")
    assert rows(df.select(safe_ratio(F.col("a"), F.col("b")))) == [(0.25,), (None,), (None,), (None,)]


def test_outage_part_normalises(spark):
    raw = spark.createDataFrame(
        [(1051, "Elmore", "Alabama", 5, at("2024-03-10 00:15"), 100), (48001, "A", "T", 5, at("2024-03-10 00:15"), 0)],
        OUTAGE_RAW,
    )
    got = outage_part(raw)
    assert [r.county_fips for r in got.collect()] == ["01051", "48001"]
    assert [r.outage_ratio for r in got.collect()] == [0.05, None]
    assert got.columns == ["county_fips", "county", "state", "customers_out", "total_customers", "outage_ratio", "ts"]


def test_tiers(spark):
    df = spark.createDataFrame([(0.15,), (0.05,), (0.049,), (0.7,), (0.3,)], "x double")
    got = rows(df.select(flags.severity_tier(F.col("x")), flags.probability_tier(F.col("x"))))
    assert got == [("SEVERE", "LOW"), ("OUTAGE", "LOW"), ("NORMAL", "LOW"), ("SEVERE", "HIGH"), ("SEVERE", "MEDIUM")]


def test_split_keeps_a_county_day_together(spark):
    df = spark.createDataFrame(
        [(f"{c:05d}", at(f"2024-03-{d:02d} {h:02d}:00")) for c in range(40) for d in range(1, 11) for h in (0, 6, 18)],
        "c string, t timestamp_ntz",
    )
    got = df.withColumn("s", hash_split(F.col("c"), F.col("t"))).groupBy("c", F.to_date("t").alias("d")).agg(
        F.countDistinct("s").alias("n"), F.max("s").alias("s")
    ).collect()
    assert all(r.n == 1 for r in got)
    assert 0.12 < sum(r.s == "TEST" for r in got) / len(got) < 0.28

"""Generator (B1-B12): determinism, rates, shape, and that the cleaner digests it."""

from pyspark.sql import functions as F

from plume.operators import ingest
from tests.tools import generator


def test_deterministic_and_partition_free(spark):
    a = generator.generate_readings(spark.range(3000), seed=7)
    b = generator.generate_readings(spark.range(3000).repartition(7), seed=7)
    key = ["_ord", "timestamp", "engine_id", "chamber_pressure", "fuel_flow", "temperature"]
    assert sorted(map(tuple, a.select(key).collect())) == sorted(map(tuple, b.select(key).collect()))
    c = generator.generate_readings(spark.range(3000), seed=8)
    assert a.select("chamber_pressure").collect() != c.select("chamber_pressure").collect()


def test_rates_and_timeline(spark):
    n = 20000
    r = generator.generate_readings(spark.range(n), seed=42)
    orig = r.where(F.col("_ord") < (1 << 40))
    stats = orig.agg(
        F.count(F.lit(1)).alias("n"),
        F.count_if(F.col("chamber_pressure").isNull() | F.col("fuel_flow").isNull()
                   | F.col("temperature").isNull()).alias("missing"),
        F.min("timestamp").alias("t0"), F.max("timestamp").alias("t1"),
        F.countDistinct("engine_id").alias("engines")).collect()[0]
    assert stats["n"] == n
    assert 0.02 < stats["missing"] / n < 0.04
    assert stats["engines"] == 5
    span = (stats["t1"] - stats["t0"]).total_seconds()
    assert 2.9 * n < span < 3.1 * n                 # mean step 3 s
    dups = r.count() - n
    assert 0.03 < dups / n < 0.05
    # timestamps strictly increase with the id
    w = orig.orderBy("_ord").select("timestamp").collect()
    assert all(w[i][0] < w[i + 1][0] for i in range(len(w) - 1))


def test_generated_lines_clean(spark):
    lines = generator.generate_jsonl(spark, 5000, seed=3)
    s = ingest.summary_from_lines(lines).collect()[0]
    assert s["parsing_errors"] == 0
    assert s["total_records"] == lines.count()
    assert s["duplicate_records"] > 0
    assert s["valid_records"] > 0.97 * s["total_records"]
    clean = ingest.clean_lines(lines)
    bad = clean.where((F.col("chamber_pressure").cast("double") < 0) | (F.col("fuel_flow").cast("double") == 0))
    assert bad.count() == 0
    # dedup is idempotent
    again = ingest.clean_lines(generator.to_jsonl(
        clean.withColumn("timestamp", F.col("timestamp").cast("timestamp_ntz"))
        .withColumn("_ord", F.monotonically_increasing_id())))
    assert again.count() == clean.count()


def test_anomaly_value_ranges(spark):
    r = generator.generate_readings(spark.range(60000), seed=9).where(F.col("_ord") < (1 << 40))
    p, f, t = F.col("chamber_pressure"), F.col("fuel_flow"), F.col("temperature")
    s = r.agg(
        F.count_if(p.between(400, 600) & (p > 350)).alias("spike"),        # critical pressure spike
        F.count_if(p < 0).alias("neg_p"),                                   # instability / out of range
        F.count_if(p > 600).alias("over_p"),                                # out of range 500-1000
        F.count_if(f == 0).alias("zero_f"),
        F.count_if(f >= 300).alias("high_f"),
        F.count_if(t < 0).alias("neg_t"),
        F.count_if(t >= 8000).alias("hot_t"),
        F.count_if(t.between(5000, 8000)).alias("runaway_t"),
        F.min(p).alias("min_p"), F.max(p).alias("max_p"), F.min(t).alias("min_t"), F.max(t).alias("max_t"),
    ).collect()[0]
    for k in ("spike", "neg_p", "over_p", "zero_f", "high_f", "neg_t", "hot_t", "runaway_t"):
        assert s[k] > 0, k
    assert -100 <= s["min_p"] and s["max_p"] <= 1000
    assert -300 <= s["min_t"] and s["max_t"] <= 12000


def test_timeline_independent_of_block_size(spark):
    from tests.tools import generator as g
    a = g.generate_readings(spark.range(25000), seed=4).select("_ord", "timestamp")
    b = g.generate_readings(spark.range(25000), seed=4, n=25000 * 100_000).select("_ord", "timestamp")  # 1 block
    diff = a.join(b.withColumnRenamed("timestamp", "t2"), "_ord").where(
        F.abs(F.unix_micros(F.col("timestamp").cast("timestamp")) - F.unix_micros(F.col("t2").cast("timestamp"))) > 1)
    assert diff.count() == 0

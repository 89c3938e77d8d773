import datetime as dt

from pyspark.sql import functions as F

from auric.functions import bigint_half_even, normalize_record, parse_cursor, safe_bool, \
    safe_date, safe_double


def _one(spark, expr, values, dtype="string"):
    df = spark.createDataFrame([(i, v) for i, v in enumerate(values)], f"i int, v {dtype}")
    return [r[0] for r in df.orderBy("i").select(expr(F.col("v"))).collect()]


def test_safe_date_edges(spark):
    vals = ["2024-01-15", "2024-01-15T10:00:00Z", "", "2024-02-30", "01/02/2024", "2024",
            "2024-01", "2024/01/15", " 2024-01-15 ", None]
    d = dt.date(2024, 1, 15)
    assert _one(spark, safe_date, vals) == [d, d, None, None, None, None, None, d, d, None]


def test_safe_double_edges(spark):
    vals = ["1000.5", "", "12abc", "1,234.5", "1e3", " 12 ", "1d", "1_000", None]
    assert _one(spark, safe_double, vals) == [1000.5, None, None, None, 1000.0, 12.0, None,
                                              1000.0, None]


def test_safe_bool_edges(spark):
    vals = ["true", "True", "1", "false", None, "", "junk", " true ", "yes", "on"]
    assert _one(spark, safe_bool, vals) == [True, True, True, False, None, None, None, None,
                                            True, None]


def test_half_even(spark):
    vals = [2.5, 3.5, 1.9, -2.5, 0.5]
    assert _one(spark, bigint_half_even, vals, "double") == [2, 4, 2, -2, 0]


def test_parse_cursor_shapes(spark):
    vals = ["1700000000000", "2024-01-15T10:00:00Z", "2024-01-15T10:00:00.000+0000",
            "2024-01-15T12:00:00+02:00", "2024-01-15T10:00:00.123456Z",
            "2024-01-15T10:00:00", None, "", "bad"]
    got = _one(spark, parse_cursor, vals)
    ten = dt.datetime(2024, 1, 15, 10)
    assert got[0] == dt.datetime(2023, 11, 14, 22, 13, 20)
    assert got[1:4] == [ten, ten, ten]
    assert got[4] == dt.datetime(2024, 1, 15, 10, 0, 0, 123456)
    assert got[5:] == [None, None, None, None]
    # CSV text: digits are not a datetime
    assert _one(spark, lambda c: parse_cursor(c, allow_epoch_ms=False), ["1700000000000"]) \
        == [None]


def test_normalize_record(spark):
    df = spark.createDataFrame(
        [({"type": "Account"}, 5, "", True, 1.5, 1700000000000)],
        "attributes struct<type:string>, Id long, Name string, Flag boolean, "
        "Amount double, SystemModstamp long")
    out = normalize_record(df, "SystemModstamp")
    assert out.columns == ["Id", "Name", "Flag", "Amount", "SystemModstamp"]
    r = out.first()
    assert (r.Id, r.Name, r.Flag, r.Amount) == ("5", None, "true", "1.5")
    assert r.SystemModstamp == dt.datetime(2023, 11, 14, 22, 13, 20)


# value -> what the reference engine reads, in the shapes that differ between engines
DATE_SHAPES = [
    "2024-01-15", "2024-1-5", " 2024-01-15 ", "2024/01/15", "2024 01 15", "2024\\01\\15",
    "2024-01/15", "24-01-15", "4-01-15", "124-1-1", "2024-13-01", "2024-02-30", "2024-02-29",
    "2023-02-29", "2024-00-10", "2024-01-00", "2024-001-15", "2024-01-015", "2024-01-15x",
    "2024-01-15T", "2024-01-15T10", "2024-01-15 10:00", "2024-01-15T10:00:00", "2024-01-15 1:2:3",
    "2024-01-15 24:00:00", "2024-01-15 24:00:01", "2024-01-15 25:00:00", "2024-01-15 10:60:00",
    "2024-01-15 10:00:60", "2024-01-15 10:00:00.", "2024-01-15 10:00:00.1234567890",
    "2024-01-15 10:00:00Z", "2024-01-15 10:00:00 Z", "2024-01-15 10:00:00z", "2024-01-15 10:00Z",
    "2024-01-15 10:00:00 UTC", "2024-01-15 10:00:00UTC", "2024-01-15 10:00:00 utc",
    "2024-01-15 10:00:00+01", "2024-01-15 10:00:00+1", "2024-01-15 10:00:00+0100",
    "2024-01-15 10:00:00 +01:00", "2024-01-15 23:30:00-02:00", "2024-01-15 10:00:00 Europe/Berlin",
    "2024/01/15 10:00:00", "2024 01 15 10:00:00", "24-01-15 10:00:00", "2024-01-15  10:00:00",
    "2024-01-15t10:00:00", "2024", "2024-01", "20240115", "", "  ", "epoch", " EPOCH", "today",
    "+2024-01-15", "\t2024-01-15\n", "15/01/2024", "2024.01.15", "2024-Jan-15",
    "2024-01-15T10:00:00.000+0000", "2024-01-15 10:00.5", "2024-01-15 10:000", None,
]


def test_dates_as_the_reference_engine_reads_them(spark):
    import duckdb
    con = duckdb.connect()
    want = [con.execute("SELECT try_cast(? AS date)", [x]).fetchone()[0] for x in DATE_SHAPES]
    df = spark.createDataFrame(list(enumerate(DATE_SHAPES)), "i int, t string")
    got = {r.i: r.d for r in df.select("i", safe_date("t").alias("d")).collect()}
    assert {DATE_SHAPES[i]: d for i, d in got.items()} == dict(zip(DATE_SHAPES, want))


def test_years_past_9999(spark):
    df = spark.createDataFrame([("10000-01-01",), ("99999-12-31 10:00:00",)], "t string")
    got = [r[0] for r in df.select(safe_date("t").cast("string")).collect()]
    assert [g.lstrip("+") for g in got] == ["10000-01-01", "99999-12-31"]


def test_exact_sum_does_not_depend_on_the_partitions(spark):
    """Bit-equal at 1, 7 and 200 partitions, next to the true sum; edge values."""
    import math
    import random
    import struct
    from pyspark.sql import functions as F
    from auric.functions.casts import exact_sum
    rng = random.Random(1)
    values = [round(rng.uniform(-1e6, 1e9), rng.choice((0, 1, 2, 6))) for _ in range(20_000)]
    values += [0.1] * 1000 + [-0.1] * 999 + [1e15 + 0.5, -1e15 - 0.25, None]
    df = spark.createDataFrame([(v,) for v in values], "x double")
    bits = set()
    for n in (1, 7, 200):
        got = df.repartition(n).groupBy(F.lit(1)).agg(exact_sum("x").alias("s")).first()["s"]
        bits.add(struct.pack("<d", got))
    want = math.fsum(v for v in values if v is not None)
    assert len(bits) == 1 and math.isclose(struct.unpack("<d", bits.pop())[0], want, rel_tol=4e-16)

    def total(*xs):
        return spark.createDataFrame([(x,) for x in xs], "x double").agg(
            exact_sum("x").alias("s")).first()["s"]
    assert total() is None and total(None) is None and total(0.1, 0.2) == 0.3
    assert total(1e300, 1.5) == 1e300 + 1.5 and total(float("inf"), 1.0) == float("inf")
    assert math.isnan(total(float("nan"), 1.0)) and math.isnan(total(float("inf"), -float("inf")))
    assert total(-0.25, -0.5) == -0.75 and total(None, 2.0) == 2.0


def test_gold_sums_are_bit_equal_over_partitions(spark):
    from auric.plans.registry import QUERIES
    before = spark.conf.get("spark.sql.shuffle.partitions")
    seen = set()
    try:
        for n in (1, 7, 200):
            spark.conf.set("spark.sql.shuffle.partitions", n)
            rows = QUERIES["baseline_certification"](spark, "/root/testdata/sf0.001").collect()
            seen.add(tuple(sorted(repr(sorted(r.asDict().items())) for r in rows)))
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", before)
    assert len(seen) == 1

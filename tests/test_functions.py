"""Literal edge cases of the cleaning expressions and flags."""

import datetime as dt

from pyspark.sql import functions as F

from emporia.functions import flags as Q
from emporia.functions.calendar import week_of_year
from emporia.functions.measures import rate_pct
from emporia.functions.text import first_upper, parse_dmy, to_dec, to_int
from emporia.operators.gold import dim_date


def one(spark, expr, value, dtype="string"):
    return spark.createDataFrame([(value,)], f"x {dtype}").select(expr.alias("r")).first()["r"]


def test_parse_dmy(spark):
    assert one(spark, parse_dmy("x"), "02-10-2017 10:56") == dt.datetime(2017, 10, 2, 10, 56)
    for bad in ("", "  ", "31-02-2017 10:00", "2017-10-02 10:56", "not a date", None):
        assert one(spark, parse_dmy("x"), bad) is None
    assert one(spark, parse_dmy("x"), " 02-10-2017 ") == dt.datetime(2017, 10, 2)


def test_first_upper_not_initcap(spark):
    assert one(spark, first_upper("x"), " sao paulo ") == "Sao paulo"
    assert one(spark, first_upper("x"), "SAO PAULO") == "Sao paulo"
    assert one(spark, first_upper("x"), None) is None


def test_try_casts(spark):
    assert one(spark, to_int("x"), "1.5") is None
    assert one(spark, to_int("x"), " 12 ") == 12
    assert one(spark, to_int("x"), "n/a") is None
    assert one(spark, to_int("x"), "") is None
    assert str(one(spark, to_dec("x"), "12.50")) == "12.50"
    assert one(spark, to_dec("x"), "n/a") is None
    assert one(spark, to_dec("x"), "  ") is None


def test_free_shipping_is_textual(spark):
    got = [one(spark, Q.free_shipping("x"), v) for v in ("0", "0.0", "0.00", None, " 0 ")]
    assert got == [1, 1, 0, 0, 1]


def test_payment_flags(spark):
    assert one(spark, Q.payment_zero_value("x"), None) == 0
    assert one(spark, Q.payment_zero_value("x"), "0.00") == 1
    assert one(spark, Q.payment_not_defined("x"), " NOT_DEFINED ") == 1


def test_order_flags(spark):
    df = spark.createDataFrame(
        [(" delivered ", "", "01-01-2017 10:00"),
         ("unavailable", None, "01-01-2017 10:00"),
         ("Canceled ", "02-01-2017 10:00", "01-01-2017 10:00"),
         ("shipped", None, None)],
        "st string, cust string, carr string")
    st = Q.order_status("st")
    rows = df.select(
        st.alias("s"),
        Q.delivery_inconsistent(st, "cust").alias("inc"),
        Q.canceled_in_transit(st, "carr", "cust").alias("transit"),
        Q.canceled_but_reached(st, "carr", "cust").alias("reached"),
        Q.shipped_missing(st, "carr").alias("shipmiss"),
    ).collect()
    assert [r.s for r in rows] == ["DELIVERED", "UNAVAILABLE", "CANCELED", "SHIPPED"]
    assert [r.inc for r in rows] == [1, 0, 0, 0]
    assert [r.transit for r in rows] == [0, 1, 0, 0]
    assert [r.reached for r in rows] == [0, 0, 1, 0]
    assert [r.shipmiss for r in rows] == [0, 0, 0, 1]
    # Q03 and Q04 are disjoint by construction
    assert all(not (r.transit and r.reached) for r in rows)


def test_invalid_sequence_needs_direct_comparison(spark):
    df = spark.createDataFrame([(dt.datetime(2017, 1, 2), None, dt.datetime(2017, 1, 1), None)],
                               "p timestamp_ntz, a timestamp_ntz, c timestamp_ntz, d timestamp_ntz")
    r = df.select(Q.invalid_date_sequence(F.col("p"), F.col("a"), F.col("c"), F.col("d")).alias("f")).first()
    assert r.f == 0


def test_week_of_year_sunday_start(spark):
    df = spark.createDataFrame([(dt.date(2016, 1, 1),), (dt.date(2016, 1, 3),), (dt.date(2016, 12, 31),)], "d date")
    assert [r.w for r in df.select(week_of_year(F.col("d")).alias("w")).collect()] == [1, 2, 53]


def test_default_calendar_has_1827_days(spark):
    cal = dim_date(spark)
    assert cal.count() == 1827
    r = cal.where("date_key = 20160101").first()
    assert (r.year, r.quarter, r.month_name, r.day_name, r.week_of_year, r.day_of_week, r.is_weekend) == (
        2016, 1, "January", "Friday", 1, 6, 0)


def test_rate_pct(spark):
    df = spark.createDataFrame([(1, 3), (2, 3), (0, 0), (20, 1), (1, 8)], "n long, d long")
    got = [r.r for r in df.select(rate_pct(F.col("n"), F.col("d")).alias("r")).collect()]
    assert [None if g is None else str(g) for g in got] == ["33.33", "66.67", None, None, "12.50"]


def test_rate_and_average_match_decimal_half_up(spark):
    """Exact integer rate and decimal average against Python's Decimal arithmetic, random inputs."""
    import random
    from decimal import ROUND_HALF_UP, Decimal

    from emporia.functions.measures import avg_money

    rnd = random.Random(11)
    pairs = [(rnd.randint(0, 10**7), rnd.randint(1, 10**7)) for _ in range(2000)]
    pairs += [(1, 8), (3, 8), (5, 8), (1, 3), (2, 3), (0, 5), (999, 100)]
    df = spark.createDataFrame(pairs, "n long, d long")
    got = {(r.n, r.d): r.r for r in df.select("n", "d", rate_pct(F.col("n"), F.col("d")).alias("r")).collect()}
    for n, d in pairs:
        want = (Decimal(n) * 100 / Decimal(d)).quantize(Decimal("0.01"), ROUND_HALF_UP)
        assert got[(n, d)] == (want if want < 1000 else None), (n, d)

    vals = [Decimal(rnd.randint(0, 10**9)) / 100 for _ in range(997)]
    g = spark.createDataFrame([(i % 7, v) for i, v in enumerate(vals)], "g int, v decimal(10,2)")
    out = {r.g: r.a for r in g.groupBy("g").agg(avg_money("v").alias("a")).collect()}
    for k in range(7):
        part = [v for i, v in enumerate(vals) if i % 7 == k]
        want = (sum(part) / len(part)).quantize(Decimal("0.000001"), ROUND_HALF_UP)
        assert out[k] == want

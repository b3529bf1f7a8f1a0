import random
from datetime import date, timedelta
from decimal import ROUND_HALF_UP, Decimal

from fixtures import SAMPLE_EVENTS, WEEK_DATES
from helpers import log_of
from pyspark.sql import functions as F

from perennia.functions.money import count_ratio, lifetime_value, parse_amount, per_unit
from perennia.functions.tags import explode_tags
from perennia.functions.times import event_date
from perennia.functions.weeks import POLICIES, week_of
from perennia.operators.fold import entities_of
from perennia.plans.ltv import frame_weeks, ltv, ltv_timeframe


def test_sunday_u_is_strftime(spark):
    days = spark.sql("SELECT explode(sequence(DATE'1970-01-01', DATE'2100-12-31')) AS d")
    rows = days.select("d", week_of(F.col("d")).alias("u"), week_of(F.col("d"), "iso").alias("i"), week_of(F.col("d"), "sunday_calendar").alias("c"))
    for r in rows.collect():
        assert r.u == int(r.d.strftime("%U"))
        assert r.i == r.d.isocalendar()[1]
        assert r.c == r.d - timedelta(days=r.d.isoweekday() % 7)


def test_worked_week_example(spark):
    visits = spark.createDataFrame([(str(i), "c", date.fromisoformat(d)) for i, d in enumerate(WEEK_DATES)], "key string, customer_id string, event_date date")
    sales = spark.createDataFrame([("o", "c", date(2018, 1, 1), Decimal("6"))], "key string, customer_id string, event_date date, amount decimal(18,4)")
    people = spark.createDataFrame([("c",)], "customer_id string")
    current = entities_of(people, visits, sales)
    got = {p: (r.weeks, float(r.visits_per_week)) for p in POLICIES for r in [ltv(current, p).first()]}
    assert got == {"iso": (4, 1.5), "sunday_u": (5, 1.2), "sunday_calendar": (5, 1.2)}
    # 2017-01-01 to 2018-06-03 are 75 Sunday weeks.
    assert frame_weeks(visits).first().weeks == 75
    row = ltv_timeframe(current).first()
    assert (row.weeks, float(row.visits_per_week), float(row.ltv)) == (75, 0.08, 41.6)


def test_ratios_are_exact_half_up(spark):
    rng = random.Random(3)
    cases = [(Decimal(rng.randrange(-(10**9), 10**9)) / 10000, rng.choice([1, 2, 3, 7, 8, 400, rng.randrange(1, 10**7)]), rng.randrange(1, 55)) for _ in range(3000)]
    cases += [(Decimal("0.005"), 1, 1), (Decimal("-0.005"), 1, 1), (Decimal("1.25"), 1000, 3), (Decimal("99999999999999.9999"), 3, 1)]
    rows = spark.createDataFrame(cases, "a decimal(18,4), n bigint, w bigint")
    rated = rows.withColumn("rpv", per_unit(F.col("a"), F.col("n"))).withColumn("vpw", count_ratio(F.col("n"), F.col("w")))
    cent = Decimal("0.01")
    for r in rated.withColumn("v", lifetime_value(F.col("rpv"), F.col("vpw"))).collect():
        rpv = (r.a / r.n).quantize(cent, ROUND_HALF_UP)
        vpw = (Decimal(r.n) / r.w).quantize(cent, ROUND_HALF_UP)
        assert (r.rpv, r.vpw, r.v) == (rpv, vpw, (520 * rpv * vpw).quantize(cent, ROUND_HALF_UP))
        # Visits cancel: up to the rounding of the factors the value is 520 x revenue / weeks.
        assert abs(r.v - 520 * r.a / r.w) <= 520 * (cent / 2 * vpw + cent / 2 * abs(rpv) + cent)


def test_zero_denominators(spark):
    row = spark.range(1).select(
        per_unit(F.lit(Decimal("5.0000")), F.lit(0).cast("bigint")).alias("a"),
        count_ratio(F.lit(3).cast("bigint"), F.lit(None).cast("bigint")).alias("b"),
    ).first()
    assert (row.a, row.b) == (0, 0)


def test_amounts(spark):
    texts = ["12.34 USD", "5", " 7 USD", "-5.00 USD", "1e3 USD", "0.125 USD", "N/A", "nan", "inf", "1_000 USD", "", "5 EUR", "12.34USD"]
    rows = spark.createDataFrame([(t,) for t in texts], "t string").select("t", parse_amount(F.col("t")).alias("a")).collect()
    got = {r.t: None if r.a is None else float(r.a) for r in rows}
    good = {"12.34 USD": 12.34, "5": 5.0, " 7 USD": 7.0, "-5.00 USD": -5.0, "1e3 USD": 1000.0, "0.125 USD": 0.125}
    assert got == {t: good.get(t) for t in texts}


def test_event_dates(spark):
    good = ["2018-01-20T12:47:12.344Z", "2018-01-11T12.55:55.555Z", "2018-01-20", "2018-1-5T3:04", "2018-01-20T23:55-05:00", "2018-01-20 23:55:01+0530"]
    bad = ["2018-01-2000T12:46:12.384Z", "2018-13-01T00:00:00Z", "2018-01-20T25:00:00Z", "2018-01-20Tnoon", "2018-02-30", "junk", "", None]
    rows = spark.createDataFrame([(t,) for t in good + bad], "t string").select("t", event_date(F.col("t")).alias("d")).collect()
    assert [str(r.d) for r in rows[: len(good)]] == ["2018-01-20", "2018-01-11", "2018-01-20", "2018-01-05", "2018-01-20", "2018-01-20"]
    assert all(r.d is None for r in rows[len(good) :])


def test_tags_of_both_shapes(spark, folder):
    log = log_of(spark, folder, SAMPLE_EVENTS + [
        {**SAMPLE_EVENTS[1], "key": "p2", "tags": {"a": "1", "b": "2"}},
        {**SAMPLE_EVENTS[1], "key": "p3", "tags": [{"a": "1"}, {"a": "2"}]},
        {k: v for k, v in {**SAMPLE_EVENTS[1], "key": "p4"}.items() if k != "tags"},
    ])
    rows = explode_tags(log.where("type = 'SITE_VISIT'")).collect()
    assert sorted(tuple(r) for r in rows) == [
        ("ac05e815502f", "some key", "some value"), ("p2", "a", "1"), ("p2", "b", "2"), ("p3", "a", "1"), ("p3", "a", "2"),
    ]

import datetime as dt

from staygrid.plans.busy import busy_hotels
from staygrid.plans.temperature import temperature_range_topk
from staygrid.plans.trend import weather_trend

BOOK = "id long, hotel_id long, srch_ci date, srch_co date, srch_adults_cnt int, srch_children_cnt int"


def test_busy_counts_each_month_and_null_children(spark):
    rows = [(1, 1, dt.date(2020, 1, 15), dt.date(2020, 2, 15), 2, 1),
            (2, 2, dt.date(2020, 1, 31), dt.date(2020, 2, 1), 1, None),
            (3, 3, dt.date(2020, 2, 3), None, 5, 5)]
    out = busy_hotels(spark.createDataFrame(rows, BOOK)).collect()
    got = [(r.year, r.month, r.rank, r.hotel_id, r.visits_per_month) for r in out]
    assert got == [(2020, 2, 1, 1, 3), (2020, 1, 1, 1, 3), (2020, 1, 2, 2, None)]


def test_trend_includes_checkout_day_and_long_stays_only(spark):
    b = spark.createDataFrame([(1, 7, dt.date(2020, 1, 1), dt.date(2020, 1, 9), 1, 0),
                               (2, 7, dt.date(2020, 1, 1), dt.date(2020, 1, 8), 1, 0)], BOOK)
    hw = spark.createDataFrame([(7, dt.date(2020, 1, 1) + dt.timedelta(days=i), float(i)) for i in range(8)],
                               "id long, wthr_date date, avg_tmpr_c double")
    out = weather_trend(b, hw).collect()
    assert len(out) == 1
    r = out[0]
    assert (r.visit_id, r.days_of_stay, r.checkin_tmpr, r.checkout_tmpr, r.weather_trend) == (1, 8, 0.0, None, None)
    assert r.avg_tmpr_during_stay == sum(range(8)) / 8  # the day without a reading is ignored


def test_temperature_rank_keeps_ties_and_nulls_last(spark):
    rows = []
    for hid, temps in {1: [0, 10], 2: [5, 15], 3: [1, 3], 4: [None, None]}.items():
        for i, t in enumerate(temps):
            rows.append((hid, f"h{hid}", dt.date(2020, 1, 1 + i), None if t is None else float(t)))
    hw = spark.createDataFrame(rows, "id long, name string, wthr_date date, avg_tmpr_c double")
    out = [(r.rank, r.hotel_id) for r in temperature_range_topk(hw, k=2).collect()]
    assert sorted(out) == [(1, 1), (1, 2)]
    out3 = [(r.rank, r.hotel_id) for r in temperature_range_topk(hw, k=4).collect()]
    assert sorted(out3) == [(1, 1), (1, 2), (3, 3), (4, 4)]


def test_trend_keeps_repeated_bookings(spark):
    row = (1, 7, dt.date(2020, 1, 1), dt.date(2020, 1, 9), 1, 0)
    b = spark.createDataFrame([row, row], BOOK)
    hw = spark.createDataFrame([(7, dt.date(2020, 1, 1), 5.0)], "id long, wthr_date date, avg_tmpr_c double")
    assert [r.checkin_tmpr for r in weather_trend(b, hw).collect()] == [5.0, 5.0]


def test_forms_without_the_grid_equal_the_forms_over_it(spark):
    from staygrid.plans.enrichment import daily_cell_weather, enrich_hotels
    from staygrid.plans.temperature import temperature_range_by_cell
    from staygrid.plans.trend import weather_trend_by_cell
    from staygrid.sources import surrogates as sg
    sf = "/root/testdata/sf0.001"
    hotels, weather, bookings = sg.hotels(spark, sf), sg.weather(spark, sf), sg.trend_bookings(spark, sf)
    cells, grid = daily_cell_weather(weather), enrich_hotels(hotels, weather)
    bag = lambda df: sorted(str([round(v, 6) if isinstance(v, float) else v for v in r]) for r in df.collect())
    assert bag(temperature_range_by_cell(hotels, cells)) == bag(temperature_range_topk(grid))
    assert bag(weather_trend_by_cell(bookings, hotels, cells)) == bag(weather_trend(bookings, grid))


def test_long_stays_equal_the_day_by_day_form(spark):
    """Stays of up to 10,000 days over readings with gaps, NULL, NaN and infinite days, hotels without a
    cell and cells without a reading."""
    import random

    from staygrid.plans.trend import weather_trend_by_cell
    rnd, start = random.Random(3), dt.date(1995, 1, 1)
    day = lambda n: start + dt.timedelta(days=n)
    odd = {("b", 700): float("nan"), ("c", 900): float("inf"), ("c", 1200): float("-inf"), ("b", 100): None}
    readings = [(day(n), c, odd.get((c, n), rnd.uniform(-40, 40))) for c in "abc" for n in
                sorted({100, 700, 900, 1200, *rnd.sample(range(11_000), 900)})]
    hotels = [(1, "a"), (2, "b"), (3, "c"), (4, "none"), (5, None)]
    stays = []
    for i in range(400):
        ci = rnd.randrange(0, 1500)
        stays.append((i, rnd.choice([1, 2, 3, 4, 5, 6, None]), day(ci), day(ci + rnd.choice([7, 8, 30, 400, 10_000])), 1, 0))
    stays += [stays[0], (900, 1, None, day(9), 1, 0), (901, 1, day(50), day(20), 1, 0)]
    b = spark.createDataFrame(stays, BOOK)
    cells = spark.createDataFrame(readings, "wthr_date date, geohash string, avg_tmpr_c double")
    h = spark.createDataFrame(hotels, "id long, geohash string")
    grid = h.join(cells, "geohash").select("id", "wthr_date", "avg_tmpr_c")
    bag = lambda df: sorted(str([round(v, 6) if isinstance(v, float) else v for v in r]) for r in df.collect())
    got = weather_trend_by_cell(b, h, cells)
    assert bag(got) == bag(weather_trend(b, grid))
    # the only rows made are those of repeated bookings
    plan = got._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("Generate") == 1 and "copies" in plan.split("Generate")[1].splitlines()[0]

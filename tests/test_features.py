import math
from datetime import datetime

import pytest

from meterline.operators import features as f
from meterline.operators.clean import clean
from meterline.schema import GOLD_COLUMNS
from meterline.settings import FeatureGroups, JoinBounds
from meterline.sources.trips import with_months
from tests.making import column, trips


def at(spark, *times):
    return f.add_time_features(trips(spark, *[{"tpep_pickup_datetime": t} for t in times]))


def test_calendar(spark):
    df = at(spark, datetime(2024, 1, 1), datetime(2024, 1, 7), datetime(2024, 12, 30, 23, 59), None)
    assert column(df, "pickup_day_of_week") == [0, 6, 0, None]
    assert column(df, "pickup_week_of_year") == [1, 1, 1, None]
    assert column(df, "pickup_day_of_month") == [1, 7, 30, None]
    assert column(df, "pickup_hour") == [0, 0, 23, None]
    assert column(df, "pickup_month") == [1, 1, 12, None]
    assert column(df, "pickup_year") == [2024, 2024, 2024, None]
    assert column(df, "is_weekend") == [False, True, False, None]


def test_hours(spark):
    hours = list(range(24))
    df = at(spark, *[datetime(2024, 1, 1, h) for h in hours])
    peak = [h for h in hours if column(df, "is_peak_hour")[h]]
    assert peak == [7, 8, 9, 10, 16, 17, 18, 19]
    assert [h for h in hours if column(df, "is_night")[h]] == [0, 1, 2, 3, 4, 5, 22, 23]
    assert column(df, "is_rush_hour") == column(df, "is_peak_hour")


def test_cyclic_columns_lie_on_the_circle(spark):
    df = at(spark, *[datetime(2024, 1, 1 + h % 7, h) for h in range(24)])
    for row in df.collect():
        assert math.isclose(row.sin_hour**2 + row.cos_hour**2, 1)
        assert math.isclose(row.sin_day_of_week**2 + row.cos_day_of_week**2, 1)
        assert math.isclose(row.sin_hour, math.sin(2 * math.pi * row.pickup_hour / 24), abs_tol=1e-15)


def test_distance(spark):
    df = f.add_distance_features(trips(spark, *[{"trip_distance": d} for d in (0.5, 1.0, 10.0, 10.1, None)]))
    assert column(df, "is_short_trip") == [True, False, False, False, None]
    assert column(df, "is_long_trip") == [False, False, False, True, None]
    assert column(df, "log_trip_distance")[1] == math.log1p(1.0)
    assert column(df, "sqrt_trip_distance")[2] == math.sqrt(10.0)


def test_ratios(spark):
    none = {"extra": None, "congestion_surcharge": None, "Airport_fee": None, "cbd_congestion_fee": None}
    df = f.add_ratio_features(
        trips(spark, {}, {"total_amount": 0.0}, {"total_amount": None}, {"trip_distance": 0.0}, none, {"tolls_amount": None})
    )
    assert column(df, "fare_per_mile") == [5.0, 5.0, 5.0, None, 5.0, 5.0]
    assert column(df, "surcharge_ratio") == [3.5 / 20.5, None, None, 3.5 / 20.5, 0.0, 3.5 / 20.5]
    assert column(df, "toll_ratio") == [0.0, None, None, 0.0, 0.0, None]


def test_flags(spark):
    df = f.add_flag_features(trips(spark, {}, {"tolls_amount": 1.0, "Airport_fee": None}, {"total_amount": None}))
    assert column(df, "has_tolls") == [0, 1, 0]
    assert column(df, "has_airport_fee") == [0, 0, 0]
    assert column(df, "has_congestion_fee") == [1, 1, 1]
    assert column(df, "non_fare_amount") == [5.5, 5.5, None]
    assert dict(df.dtypes)["has_tolls"] == "int"


def test_zones_and_routes(spark):
    zones = [("7", "007"), ("x", "7"), (None, "5"), ("5", None), ("7.0", " 7 "), ("3000000000", "1"), ("7.5.1", "-1")]
    df = trips(spark, *[{"PULocationID": a, "DOLocationID": b} for a, b in zones])
    df = f.add_route(f.normalise_zones(df))
    assert column(df, "PULocationID") == ["7", None, None, "5", "7", None, None]
    assert column(df, "DOLocationID") == ["7", "7", "5", None, "7", "1", "-1"]
    assert column(df, "route_id") == ["7_7", "7", "5", "5", "7_7", "1", "-1"]
    assert column(df, "is_same_zone") == [True, None, None, None, True, None, None]


PAIRS = [("1", "2"), ("1", "2"), ("1", "3"), (None, "2"), (None, "2"), ("2", None), ("4", "1")]
EVERY_WAY = [
    JoinBounds(),
    JoinBounds(broadcast_rows=0, hot_keys=1, salts=4),
    JoinBounds(broadcast_rows=0, hot_keys=3, salts=1),
    JoinBounds(broadcast_rows=0, hot_keys=1000, salts=16),
]


@pytest.mark.parametrize("bounds", EVERY_WAY)
def test_frequencies(spark, bounds):
    df = trips(spark, *[{"PULocationID": a, "DOLocationID": b} for a, b in PAIRS])
    df = f.add_location_features(df, bounds=bounds)
    assert column(df, "pickup_zone_trip_count") == [3, 3, 3, None, None, 1, 1]
    assert column(df, "dropoff_zone_trip_count") == [4, 4, 1, 4, 4, None, 1]
    # "2" is the route of (NULL, 2) and of (2, NULL) alike
    assert column(df, "route_trip_count") == [2, 2, 1, 3, 3, 3, 1]


@pytest.mark.parametrize("bounds", EVERY_WAY)
def test_frequencies_within_a_scope(spark, bounds):
    months = [{"tpep_pickup_datetime": datetime(2024, 1 + i % 2, 3)} for i in range(6)]
    df = with_months(trips(spark, *months))
    scoped = f.add_location_features(df, scope=("year", "month"), bounds=bounds)
    assert column(scoped, "route_trip_count") == [3] * 6
    assert column(f.add_location_features(df, bounds=bounds), "route_trip_count") == [6] * 6


@pytest.mark.parametrize("bounds", EVERY_WAY)
def test_frequencies_equal_the_literal_joins(spark, sf_dir, bounds):
    """Counting and joining one key after the other, as the definition has it."""
    from meterline.suite.frames import silver

    df = silver(spark, sf_dir).transform(f.normalise_zones).transform(f.add_route)
    literal = df
    for name, key in f.FREQUENCIES.items():
        counts = literal.groupBy(key).count().withColumnRenamed("count", name)
        literal = literal.join(counts, key, "left")
    mine = f.add_frequencies(df, bounds=bounds).select(*literal.columns)
    assert mine.exceptAll(literal).isEmpty() and literal.exceptAll(mine).isEmpty()


def test_gold_columns_and_order(spark):
    silver = clean(with_months(trips(spark, {}, {})))
    assert f.add_features(silver).columns == [*GOLD_COLUMNS, "year", "month"]
    assert len(GOLD_COLUMNS) == 49


def test_groups_can_be_switched_off(spark):
    silver = clean(trips(spark, {}))
    none = FeatureGroups(False, False, False, False, False, False, False)
    kept = [name for name in silver.columns if name not in ("tpep_dropoff_datetime", "total_amount")]
    assert sorted(f.add_features(silver, none).columns) == sorted(kept)
    no_cyclic = f.add_features(silver, FeatureGroups(cyclic=False, frequency=False)).columns
    assert "is_weekend" in no_cyclic and "sin_hour" not in no_cyclic and "route_trip_count" not in no_cyclic
    # cyclic needs time, frequency needs location
    alone = f.add_features(silver, FeatureGroups(time=False, location=False)).columns
    assert "sin_hour" not in alone and "route_trip_count" not in alone

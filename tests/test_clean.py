from datetime import timedelta

import pytest

from meterline.operators import clean as c
from meterline.schema import BRONZE_COLUMNS, SILVER_COLUMNS
from meterline.settings import CleaningLimits
from meterline.sources.trips import conform
from tests.making import START, after, column, kept, trips

NAN = float("nan")


def test_duration_counts_whole_seconds(spark):
    df = trips(
        spark,
        {
            "tpep_pickup_datetime": START + timedelta(milliseconds=900),
            "tpep_dropoff_datetime": START + timedelta(seconds=1),
        },
        {"tpep_dropoff_datetime": START + timedelta(seconds=90)},
        {"tpep_dropoff_datetime": None},
    )
    assert column(c.add_duration(df), "trip_duration_min") == [1 / 60, 1.5, None]


@pytest.mark.parametrize("zone", ["UTC", "America/New_York"])
def test_duration_does_not_depend_on_the_session_zone(spark, zone):
    spark.conf.set("spark.sql.session.timeZone", zone)
    try:
        # clocks go forward in New York between these two times
        df = trips(
            spark,
            {
                "tpep_pickup_datetime": START.replace(month=3, day=10, hour=1),
                "tpep_dropoff_datetime": START.replace(month=3, day=10, hour=4),
            },
        )
        assert column(c.add_duration(df), "trip_duration_min") == [180.0]
    finally:
        spark.conf.set("spark.sql.session.timeZone", "UTC")


def test_duration_bounds_are_strict(spark):
    minutes = (0, 0.5, 179.9, 180, -1)
    df = trips(spark, *[{"tpep_dropoff_datetime": after(m)} for m in minutes], {"tpep_dropoff_datetime": None})
    assert kept(c.keep_valid_durations(c.add_duration(df))) == [1, 2]


def test_distance_bounds_are_strict(spark):
    df = trips(spark, *[{"trip_distance": d} for d in (0.0, 0.1, 59.9, 60.0, -1.0, None, NAN)])
    assert kept(c.keep_valid_distances(df)) == [1, 2]


def test_fare_bounds_are_strict_and_the_total_bound_is_inclusive(spark):
    df = trips(
        spark,
        *[{"fare_amount": v} for v in (0.0, 0.01, 499.9, 500.0, None, NAN)],
        *[{"total_amount": v} for v in (-0.01, 0.0, None, NAN)],
    )
    # NaN is above every number, so a NaN total stays
    assert kept(c.keep_valid_money(df)) == [1, 2, 7, 9]


def test_rows_without_a_critical_value_go(spark):
    names = ("tpep_pickup_datetime", "tpep_dropoff_datetime", "PULocationID", "DOLocationID")
    df = trips(spark, *[{name: None} for name in names], {}, {"VendorID": None})
    assert kept(c.keep_complete(df)) == [4, 5]


def test_missing_values_are_filled(spark):
    names = ("passenger_count", "RatecodeID", "congestion_surcharge", "Airport_fee", "store_and_fwd_flag")
    row = c.fill_missing(trips(spark, dict.fromkeys(names))).first()
    assert [row[name] for name in names] == [1, 1, 0.0, 0.0, "N"]
    assert c.fill_missing(trips(spark, {"Airport_fee": NAN})).first().Airport_fee == 0.0


def test_rate_code_is_clipped(spark):
    df = trips(spark, *[{"RatecodeID": v} for v in (None, 0, 1, 6, 7, 99)])
    assert column(c.clip_rate_code(c.fill_missing(df)), "RatecodeID") == [1, 1, 1, 6, 6, 6]


def test_tip_is_clipped_between_zero_and_a_multiple_of_the_fare(spark):
    df = trips(spark, *[{"tip_amount": v} for v in (-1.0, 0.0, 30.0, 30.01, None)])
    assert column(c.clip_tip(df), "tip_amount") == [0.0, 0.0, 30.0, 30.0, None]
    assert column(c.clip_tip(df, CleaningLimits(max_tip_multiplier=1.0)), "tip_amount")[2] == 15.0


def test_only_known_columns_stay_in_order(spark):
    df = c.add_duration(trips(spark, {})).drop("cbd_congestion_fee").withColumnRenamed("extra", "other")
    expected = [name for name in SILVER_COLUMNS if name not in ("cbd_congestion_fee", "extra")]
    assert c.keep_known_columns(df).columns == expected


def test_clean_gives_the_silver_columns_and_bounds(spark):
    df = trips(spark, {}, {"trip_distance": 60.0}, {"RatecodeID": None, "tip_amount": 99.0})
    silver = c.clean(df)
    assert silver.columns == SILVER_COLUMNS
    assert kept(silver) == [0, 2]
    assert column(silver, "tip_amount") == [3.0, 30.0]


def test_conform_casts_and_adds_absent_columns(spark):
    raw = trips(spark, {}).drop("cbd_congestion_fee", "extra")
    raw = raw.withColumnRenamed("Airport_fee", "airport_fee").withColumn("PULocationID", raw.PULocationID.cast("long"))
    made = conform(raw.withColumn("note", raw.VendorID))
    assert made.columns == [*BRONZE_COLUMNS, "note"]
    row = made.first()
    assert (row.PULocationID, row.cbd_congestion_fee, row.extra, row.Airport_fee) == ("10", None, None, 0.0)
    assert dict(made.dtypes)["cbd_congestion_fee"] == "double"
    with pytest.raises(ValueError, match="DOLocationID"):
        conform(raw.drop("DOLocationID"))

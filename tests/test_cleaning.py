"""Edge rules of casts, nulls, filters, duplicates and the join on literal frames."""

from __future__ import annotations

import datetime as dt

import numpy as np
import pytest
from pyspark.sql import functions as F

from tripwell.functions.casts import to_double, to_float, to_int, to_timestamp_ampm
from tripwell.functions.indicators import indicators
from tripwell.functions.timeparts import duration_minutes, is_weekend, weekday
from tripwell.operators import cleaning, projection
from tripwell.operators.joins import broadcast_zone_join
from tripwell.operators.quantiles import exact_quantiles, filter_quantile_band


def values(df, column):
    return [r[0] for r in df.select(column).collect()]


def test_bad_text_becomes_null(spark):
    df = spark.createDataFrame([("",), ("x",), ("1.5",), ("7",), (None,)], "s string")
    assert values(df, to_double(F.col("s"))) == [None, None, 1.5, 7.0, None]
    assert values(df, to_int(F.col("s"))) == [None, None, 1, 7, None]
    assert values(df, to_float(F.col("s"))) == [None, None, 1.5, 7.0, None]


def test_nan_text_is_nan_and_dropped(spark):
    df = spark.createDataFrame([("NaN",), ("2",)], "fare_amount string")
    typed = cleaning.cast_double_columns(df)
    assert values(cleaning.drop_nulls(typed, ["fare_amount"]), "fare_amount") == [2.0]


def test_twelve_hour_timestamps(spark):
    df = spark.createDataFrame([("01/02/2023 12:32:10 AM",), ("01/02/2023 12:00:00 PM",),
                                ("2023-01-02",), ("",)], "s string")
    assert values(df, to_timestamp_ampm(F.col("s"))) == [
        dt.datetime(2023, 1, 2, 0, 32, 10), dt.datetime(2023, 1, 2, 12, 0), None, None]


def test_both_weekend_rules(spark):
    days = spark.createDataFrame([(dt.date(2023, 1, d),) for d in range(1, 8)], "d date")  # 1st is a Sunday
    calendar = values(days, is_weekend(weekday(F.col("d"))))
    threshold = values(days, is_weekend(weekday(F.col("d")), "ge6"))
    assert calendar == [1.0, 0, 0, 0, 0, 0, 1.0]
    assert threshold == [0, 0, 0, 0, 0, 1.0, 1.0]
    with pytest.raises(ValueError):
        is_weekend(F.col("d"), "lunar")


def test_zero_duration_is_filtered(spark):
    t = dt.datetime(2023, 1, 1, 8)
    df = spark.createDataFrame([(t, t, 1.0, 1.0), (t, t + dt.timedelta(seconds=90), 1.0, 1.0),
                                (t, t + dt.timedelta(minutes=2), 0.0, 1.0)],
                               "a timestamp, b timestamp, trip_distance double, fare_amount double")
    df = df.withColumn("trip_duration_min", duration_minutes(F.col("a"), F.col("b")))
    assert values(cleaning.filter_logical(df), "trip_duration_min") == [1.5]


@pytest.mark.parametrize("bad", [None, float("nan")])
@pytest.mark.parametrize("column", ["passenger_count", "trip_distance", "fare_amount"])
def test_critical_columns_reject_null_and_nan(spark, bad, column):
    row = {"passenger_count": 1.0, "trip_distance": 2.0, "fare_amount": 3.0}
    df = spark.createDataFrame([tuple({**row, column: bad}.values()), tuple(row.values())],
                               "passenger_count double, trip_distance double, fare_amount double")
    assert cleaning.drop_nulls(df, list(row)).count() == 1


def test_unseen_and_null_categories_give_zeros(spark):
    df = spark.createDataFrame([(9.0, None, "x", 7.0), (1.0, 5.0, "N", 99.0)],
                               "VendorID double, payment_type double, store_and_fwd_flag string, RatecodeID double")
    made = indicators()
    rows = df.select(*[c.alias(n) for n, c in made.items()]).collect()
    assert sum(rows[0]) == 0.0
    assert {n for n in made if rows[1][n] == 1.0} == {
        "VendorID_1", "payment_type_5", "store_and_fwd_flag_N", "RatecodeID_99"}


def test_volume_reduction_in_both_orders(spark):
    df = spark.createDataFrame([(1, 1), (1, 1), (None, 2), (None, 2), (3, 3)], "a int, b int")
    first = cleaning.volume_reduction(df, ["a"]).first()
    assert tuple(first) == (5, 2, 1, 2)
    second = cleaning.volume_reduction(df, ["a"], nulls_first=False).first()
    assert tuple(second) == (5, 1, 2, 2)


def test_zone_join_fans_out_and_keeps_unmatched(spark):
    trips = spark.createDataFrame([("1",), ("2",), (None,)], "PULocationID string")
    zones = spark.createDataFrame([("1", "A", "a", "s"), ("1", "B", "b", "s")],
                                  "LocationID string, Borough string, Zone string, service_zone string")
    rows = {tuple(r) for r in broadcast_zone_join(trips, zones).collect()}
    assert rows == {("1", "A", "a"), ("1", "B", "b"), ("2", None, None), (None, None, None)}
    assert broadcast_zone_join(trips, None).columns == ["PULocationID"]


@pytest.mark.parametrize("bound", [2, 5])
def test_zone_join_beyond_the_bound_gives_the_same_rows(spark, bound):
    # One key holds most of the trips, some trips have no key, one key fans out.
    trips = spark.createDataFrame([("1",)] * 300 + [("2",)] * 20 + [("9",), (None,), (None,)]
                                  + [(str(i),) for i in range(1000, 1150)], "PULocationID string")
    zones = spark.createDataFrame([(str(i), "A", f"z{i}", "s") for i in range(5)] + [("1", "B", "y", "s")],
                                  "LocationID string, Borough string, Zone string, service_zone string")
    small = sorted(map(str, broadcast_zone_join(trips, zones).collect()))
    large = sorted(map(str, broadcast_zone_join(trips, zones, max_broadcast_rows=bound).collect()))
    assert small == large and len(small) == 773


def test_lookup_keeps_unmapped_values(spark):
    df = spark.createDataFrame([("pickup_hour",), ("other",), (None,)], "f string")
    assert values(df, projection.map_values(F.col("f"), projection.FEATURE_LABELS)) == [
        "Pickup Hour", "other", None]


def test_available_columns_keep_the_requested_order(spark):
    df = spark.createDataFrame([(1, 2, 3)], "c int, a int, z int")
    assert projection.available_columns(df, ["a", "b", "c"]) == ["a", "c"]


@pytest.mark.parametrize("data", [
    [5.0], [1.0, 2.0], [3.0] * 40, [float(i % 7) for i in range(101)],
    [(-1.0) ** i * 10.0 ** (i % 30) for i in range(500)], [1e308, -1e308, 0.0, 1.0]])
def test_quantiles_are_exact(spark, data):
    df = spark.createDataFrame([(x,) for x in data] + [(None,), (float("nan"),)], "x double").repartition(3)
    probabilities = [0.0, 0.01, 0.25, 0.5, 0.99, 1.0]
    got = exact_quantiles(df, ["x"], probabilities)["x"]
    ordered = np.sort(data)
    for p, value in zip(probabilities, got):
        position = p * (len(data) - 1)
        low, high = ordered[int(np.floor(position))], ordered[int(np.ceil(position))]
        if abs(high - low) < 1e300:
            assert value == pytest.approx(low + (high - low) * (position - np.floor(position)), rel=1e-12)


def test_quantiles_of_an_empty_column(spark):
    df = spark.createDataFrame([(None,)], "x double")
    assert exact_quantiles(df, ["x"], [0.5]) == {"x": [None]}


def test_quantile_band_includes_both_ends(spark):
    df = spark.createDataFrame([(float(i),) for i in range(101)], "x double")
    assert sorted(values(filter_quantile_band(df, "x"), "x")) == [float(i) for i in range(1, 100)]


# ---------------------------------------------------------------- quantiles

@pytest.mark.parametrize("values", [
    [float("inf"), float("-inf"), 1.0, 2.0, 3.0, 4.0, None, float("nan"), float("inf"), 5.0, 6.0],
    [10.0 ** e for e in range(-300, 301)] + [-(10.0 ** e) for e in range(-300, 301, 7)],
    [7.0] * 50, [float("inf")] * 3, [3.0],
])
def test_quantiles_of_awkward_values(spark, values):
    from tripwell.operators.quantiles import exact_quantiles

    df = spark.createDataFrame([(v,) for v in values], "v double")
    usable = np.sort(np.array([v for v in values if v is not None and v == v]))
    got = exact_quantiles(df, ["v"], [0.0, 0.01, 0.5, 0.99, 1.0])["v"]
    for p, g in zip([0.0, 0.01, 0.5, 0.99, 1.0], got):
        at = p * (len(usable) - 1)
        low, high = usable[int(np.floor(at))], usable[int(np.ceil(at))]
        want = low if low == high else low + (high - low) * (at - np.floor(at))
        assert g == pytest.approx(want, rel=1e-12, nan_ok=True)


def test_quantiles_narrow_large_columns(spark, monkeypatch):
    from tripwell.operators import quantiles

    monkeypatch.setattr(quantiles, "MAX_VALUES", 200)
    df = spark.range(60_000).selectExpr("cast(pmod(id * 7919, 60000) as double) * 1.5 as v", "cast(null as double) as w")
    got = quantiles.exact_quantiles(df, ["v", "w"], [0.25, 0.99])
    assert got["v"] == pytest.approx([0.25 * 59_999 * 1.5, 0.99 * 59_999 * 1.5]) and got["w"] == [None, None]


def test_quantiles_between_two_heavy_values_end(spark, monkeypatch):
    # The middle lies so close to the border of two heavy values that percentiles cannot part them.
    from tripwell.operators import quantiles

    calls, propose = [], quantiles._propose
    monkeypatch.setattr(quantiles, "MAX_VALUES", 50)

    def counted(df, brackets):
        calls.append(1)
        assert len(calls) < 9, "the brackets do not shrink"
        propose(df, brackets)

    monkeypatch.setattr(quantiles, "_propose", counted)
    for low, high in ((20_000, 20_002), (20_001, 20_000), (20_000, 20_000)):
        df = spark.range(low + high).select((F.col("id") >= low).cast("double").alias("a"),
                                            F.when(F.col("id") < low, 3).otherwise(F.col("id") % 4 + 7).alias("b"))
        for name in ("a", "b"):
            xs = [float(x) for x in values(df, name)]
            calls.clear()
            assert exact_quantiles(df, [name], [0.25, 0.5, 0.75])[name] == np.quantile(xs, [0.25, 0.5, 0.75]).tolist()


def test_rows_are_dealt_before_copies_are_dropped(spark, capsys, monkeypatch):
    monkeypatch.setattr(cleaning, "FEW_ROWS", -1)
    nan = float("nan")
    rows = [(1, "a", 0.0), (1, "a", -0.0), (2, None, nan), (2, None, nan), (None, None, None), (None, None, None), (3, "c", 1.5)]
    df = spark.createDataFrame(rows, "k long, s string, x double")
    found = cleaning.drop_duplicates(df)
    assert found.columns == df.columns and found.count() == 4
    found.explain()
    plan = capsys.readouterr().out
    below = plan[plan.index("Exchange"):]
    assert "Aggregate" not in below and plan.count("Exchange") == 1
    assert cleaning.drop_duplicates(df.limit(0)).count() == 0


def test_columns_evaluated_once_keep_rows_order_and_names(spark):
    df = spark.createDataFrame([("1", "x", 1), ("1", "x", 1), (None, None, 2), ("a", "", None)], "a string, b string, c int")
    cast = df.withColumn("a", to_double(F.col("a")))
    found = cleaning.evaluated_once(cast, ["A", "b"])
    assert found.columns == ["a", "b", "c"] and found.dtypes == cast.dtypes
    assert sorted(map(str, found.collect())) == sorted(map(str, cast.collect()))

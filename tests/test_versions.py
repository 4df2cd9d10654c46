"""Two writers of one versioned table."""

from __future__ import annotations

import os

from shelfcast.operators import weather
from shelfcast.sources import latest_version, publish_version, read_version, update_versioned


def fitted(spark, *labels):
    rows = [(label, 9 - i, float(i)) for i, label in enumerate(labels)]
    return spark.createDataFrame(rows, "WeatherDescriptor string, n_rows long, Weather_Code double")


def codes(df):
    return {r.WeatherDescriptor: r.Weather_Code for r in df.collect()}


def test_two_writers_at_once(spark, tmp_path):
    folder = f"{tmp_path}/codes"
    assert latest_version(spark, folder) == 0
    first = update_versioned(spark, folder, lambda saved: weather.extended_codes(saved, fitted(spark, "Sun", "Rain")))
    assert codes(first) == {"Sun": 0.0, "Rain": 1.0}
    calls = []

    def change(saved):
        calls.append(codes(saved))
        out = weather.extended_codes(saved, fitted(spark, "Rain", "Fog", "Sun"))
        if len(calls) == 1:  # another writer publishes in between
            other = weather.extended_codes(read_version(spark, folder, 1), fitted(spark, "Sun", "Snow", "Hail"))
            assert publish_version(other, folder, 2)
        return out

    got = codes(update_versioned(spark, folder, change))
    assert calls == [{"Sun": 0.0, "Rain": 1.0}, {"Sun": 0.0, "Rain": 1.0, "Snow": 2.0, "Hail": 3.0}]
    assert got == calls[1] | {"Fog": 4.0} and latest_version(spark, folder) == 3
    assert codes(read_version(spark, folder, 1)) == {"Sun": 0.0, "Rain": 1.0}
    # Nothing new, no new version; nothing half-written is left.
    update_versioned(spark, folder, lambda saved: weather.extended_codes(saved, fitted(spark, "Fog")))
    assert sorted(os.listdir(folder)) == ["v00000001", "v00000002", "v00000003"]


def test_a_taken_number_is_refused(spark, tmp_path):
    folder = f"{tmp_path}/t"
    assert publish_version(fitted(spark, "a"), folder, 1)
    assert not publish_version(fitted(spark, "b"), folder, 1)
    assert codes(read_version(spark, folder, 1)) == {"a": 0.0} and os.listdir(folder) == ["v00000001"]

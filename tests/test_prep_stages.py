"""Short series run through the preparation as plain windows, long ones in chunks; both give the same rows."""

import datetime as dt

from pandas.testing import assert_frame_equal

from devicelife.plans import prep, training
from devicelife.series import Series, with_chunks


def events(spark):
    at = dt.datetime(2024, 1, 1)
    rows = []
    for user in (1, 2, None):
        for k in range(60):
            kind = training.catalog.EVENT_TYPES[(k * 7 + (user or 0)) % 5]
            value = None if k % 9 == 4 else float((k * 37 + (user or 0)) % 50)
            rows.append((user, at + dt.timedelta(minutes=4 * k + (180 if k > 40 else 0)), kind, value, value))
    rows += [rows[3], rows[70], (1, None, "view", 1.0, 1.0)]
    return spark.createDataFrame(rows, "user_id long, Datetime timestamp_ntz, event_type string, value double, level double")


def prepared(spark, rows_per_chunk):
    cfg = training.event_prep_config()
    cfg.rows_per_chunk = rows_per_chunk
    out = prep.prepare(events(spark), cfg, typed=True)
    frame = out.toPandas()
    return frame.sort_values(list(frame.columns)).reset_index(drop=True)


def test_short_series_are_cut_only_where_rows_are_read_twice(spark, monkeypatch):
    taken = []
    real = prep.cut_lineage
    monkeypatch.setattr(prep, "cut_lineage", lambda d: (taken.append(1), real(d))[1])
    plain = prepared(spark, None)
    assert len(taken) == 3
    chunked = prepared(spark, 2)
    assert len(plain) > 140 and plain["user_id"].isna().any()
    assert_frame_equal(plain, chunked[plain.columns], check_exact=False, rtol=1e-12)


def test_series_that_are_all_short_come_back_as_they_are(spark):
    d, s = with_chunks(events(spark), Series.of("user_id", "Datetime"), 100)
    assert s.chunk is None and s.helper_cols() == [] and d.columns == events(spark).columns
    _, s = with_chunks(events(spark), Series.of("user_id", "Datetime"), 2)
    assert s.chunk is not None

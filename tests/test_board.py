"""A search board that is killed goes on, and other rows or settings are other fits."""

import pytest
from pyspark.sql import functions as F

from daymark.operators import history
from daymark.plans import bindings as b
from daymark.plans import forecasting
from daymark.session import scratch_path


@pytest.fixture(scope="module")
def frame(spark):
    return b.feature_frame(spark, "/root/testdata/sf0.01").where("lag_28 is not null and date < '1995-10-01'").cache()


def settings(n=4):
    return [forecasting.ResidualForecaster("forest", "compact", trees=3, depth=d) for d in range(1, n)] + [forecasting.BaselineForecaster("lag_7")]


def test_a_killed_search_goes_on(spark, frame, monkeypatch):
    path, fits = scratch_path(spark, "board"), []
    plain = forecasting.ResidualForecaster._fit

    def counted(self, rows):
        if len(fits) == 4:
            raise RuntimeError("killed")
        fits.append(self.describe())
        return plain(self, rows)

    monkeypatch.setattr(forecasting.ResidualForecaster, "_fit", counted)
    with pytest.raises(RuntimeError, match="killed"):
        forecasting.search_on_board(frame, settings(), path, workers=1)
    monkeypatch.setattr(forecasting.ResidualForecaster, "_fit", lambda self, rows: fits.append(self.describe()) or plain(self, rows))
    board = forecasting.search_on_board(frame, settings()[::-1], path)
    assert board.count() == 12 and len(fits) == 9  # 4 before, 5 after, none twice
    again = forecasting.search_on_board(frame, settings()[::-1], path)
    assert len(fits) == 9 and sorted(map(tuple, again.collect())) == sorted(map(tuple, board.collect()))
    want = forecasting.grid_search_chrono(frame, settings()[::-1])
    columns = ["candidate", "fold", "mae", "train_mae", "days"]
    assert [tuple(r) for r in board.select(columns).orderBy("candidate", "fold").collect()] == [
        tuple(r) for r in want.select(columns).orderBy("candidate", "fold").collect()]


def test_other_rows_find_no_row_of_theirs(spark, frame):
    path, one = scratch_path(spark, "board"), [forecasting.BaselineForecaster("lag_7")]
    first = forecasting.search_on_board(frame, one, path).agg(F.sum("mae")).first()[0]
    moved = frame.withColumn("trips", F.col("trips") + F.dayofmonth("date"))
    other = forecasting.search_on_board(moved, one, path).agg(F.sum("mae")).first()[0]
    assert first != other and forecasting.search_on_board(frame, one, path).agg(F.sum("mae")).first()[0] == first


def test_the_plan_has_all_settings():
    told = lambda cs: len({str(c.describe()) for c in cs})
    assert told(forecasting.forest_settings()) == 36 and told(forecasting.boosted_settings()) == 96


def test_every_feature_set_is_in_the_frame(frame):
    for name, columns in history.FEATURE_SETS.items():
        if not name.startswith("weather"):
            assert set(columns) <= set(frame.columns) and len(set(columns)) == len(columns)

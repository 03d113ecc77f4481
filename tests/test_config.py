from datetime import date, datetime

import pytest

from docklens.config import (
    as_datetime,
    as_ids,
    check_city,
    check_count,
    check_ordering,
    city_list,
    time_window,
)
from docklens.functions.timecols import grid_seconds, step_seconds, step_text


def test_time_window_backward_and_forward():
    back = time_window("2024-01-20", 7)
    assert back == (date(2024, 1, 13), date(2024, 1, 20), date(2024, 1, 20))
    ahead = time_window(date(2024, 1, 20), 7, backward=False)
    assert ahead == (date(2024, 1, 20), date(2024, 1, 27), date(2024, 1, 20))


def test_unknown_arguments_are_refused():
    with pytest.raises(ValueError):
        check_city("paris")
    with pytest.raises(ValueError):
        check_ordering("name")
    with pytest.raises(ValueError):
        check_count("limit", -1)
    with pytest.raises(ValueError):
        time_window("20/01/2024")
    assert city_list(None) == ["lyon", "bordeaux"]
    assert city_list("lyon") == ["lyon"]


def test_ids_and_times():
    assert as_ids("93,35") == ["93", "35"]
    assert as_ids([93, "35"]) == ["93", "35"]
    assert as_ids("") == []
    assert as_datetime("2024-01-20") == datetime(2024, 1, 20)
    assert as_datetime("2024-01-20T10:30") == datetime(2024, 1, 20, 10, 30)
    with pytest.raises(ValueError):
        as_datetime("2024-01-20T10:30+01:00")


@pytest.mark.parametrize(
    "text, seconds", [("30T", 1800), ("1H", 3600), ("10m", 600), ("5min", 300), ("D", 86400)]
)
def test_steps(text, seconds):
    assert step_seconds(text) == seconds


def test_step_spelling_and_grid():
    assert step_text("60T") == step_text("1h") == "1H"
    assert step_text("30m") == "30T"
    for bad in ("x", "10 weeks", "0T"):
        with pytest.raises(ValueError):
            step_seconds(bad)
    with pytest.raises(ValueError):
        grid_seconds("7T")

import pytest

from eventlake.settings import Settings, parse_duration, spark_interval


@pytest.mark.parametrize("value,ms", [("5s", 5000), ("13m", 780000), ("2h", 7200000)])
def test_durations_accepted(value, ms):
    assert parse_duration(value) == ms


@pytest.mark.parametrize("value", ["", "0s", "abc", None, "5d", "-1m"])
def test_durations_rejected(value):
    with pytest.raises(ValueError):
        parse_duration(value)


def test_interval_and_defaults():
    assert spark_interval("6h") == "6 hours"
    s = Settings()
    assert (s.window_ms, s.lateness_ms, s.early_ms) == (300000, 300000, 60000)
    d = Settings.deployed()
    assert (d.window_ms, d.lateness_ms, d.early_ms) == (6000, 8000, 2000)
    with pytest.raises(ValueError):
        Settings(window_size="0s")

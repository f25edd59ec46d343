from __future__ import annotations

import pytest

from kinfold import Settings


@pytest.mark.parametrize("threshold", [0.0, -0.1, 1.01])
def test_threshold_range(threshold):
    with pytest.raises(ValueError, match="threshold"):
        Settings(match_threshold=threshold)


def test_threshold_one_is_allowed():
    assert Settings(match_threshold=1.0).match_threshold == 1.0


@pytest.mark.parametrize("field", ["namespace", "table"])
def test_names_must_not_be_empty(field):
    with pytest.raises(ValueError, match="blank"):
        Settings(**{field: ""})


def test_argument_beats_environment_beats_default():
    env = {"KINFOLD_MATCH_THRESHOLD": "0.8", "KINFOLD_SEED": "5", "KINFOLD_TABLE": ""}
    settings = Settings.from_environment(env)
    assert (settings.match_threshold, settings.seed, settings.table) == (0.8, 5, "golden_records")
    assert Settings.based_on(settings, match_threshold=0.7, seed=None) == Settings(match_threshold=0.7, seed=5)


@pytest.mark.parametrize(("name", "text", "kind"), [("SEED", "1.5", "as int"), ("MATCH_THRESHOLD", "high", "as float")])
def test_bad_numbers_are_reported(name, text, kind):
    with pytest.raises(ValueError, match=kind):
        Settings.from_environment({f"KINFOLD_{name}": text})


def test_session_settings(spark):
    spark.conf.set("spark.kinfold.seed", "9")
    try:
        assert Settings.from_session(spark).seed == 9
    finally:
        spark.conf.unset("spark.kinfold.seed")

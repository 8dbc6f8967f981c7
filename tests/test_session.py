"""Shared folder and settings."""

import pytest

from caselens.params import Params
from caselens.session import SETTINGS, shared_folder
from datetime import date


def test_shared_folder_comes_from_the_session(spark):
    root = spark.conf.get("spark.checkpoint.dir")
    first, second = shared_folder(spark), shared_folder(spark)
    assert first.startswith(f"{root}/caselens-") and first != second


class _Session:
    class conf:
        @staticmethod
        def get(key, *default):
            return {"spark.sql.warehouse.dir": "file:/wh/"}.get(key, *default)


def test_without_a_checkpoint_folder_the_warehouse_is_used():
    assert shared_folder(_Session()).startswith("file:/wh/caselens-")


def test_settings_are_applied(spark):
    for key, value in SETTINGS.items():
        assert spark.conf.get(key) == value


def test_params_are_checked():
    with pytest.raises(ValueError):
        Params(bucket_bounds=(7, 7, 90, 180))
    with pytest.raises(ValueError):
        Params(window_end=date(2026, 1, 1))
    assert Params().closed_before == date(2026, 7, 6)

"""Job options and session settings."""

from __future__ import annotations

import datetime as dt

import pytest

from folioflow.options import JobOptions
from folioflow.schemas import PORTFOLIO, RAW


def test_options_validate():
    with pytest.raises(ValueError, match="number_mode"):
        JobOptions(root="/x", number_mode="us")
    with pytest.raises(ValueError, match="page_size"):
        JobOptions(root="/x", page_size=1201)
    with pytest.raises(ValueError, match="index_mode"):
        JobOptions(root="/x", index_mode="dir")


def test_options_paths_and_modes():
    o = JobOptions(root="s3a://b/feeds/", run_timestamp=dt.datetime(2025, 7, 25, 14, 32, 40))
    assert o.raw_path == "s3a://b/feeds/portfolio-raw"
    assert o.transformed_path == "s3a://b/feeds/portfolio-transformed"
    assert o.run_date == dt.date(2025, 7, 25)
    assert o.group_keys == () and o.leading_partitions == () and o.raw_schema == RAW
    col = JobOptions(root="/x", index_mode="column")
    assert col.group_keys == ("index",) and col.leading_partitions == ()
    assert col.raw_schema.fieldNames()[0] == "index" and col.portfolio_schema.fieldNames()[1:] == PORTFOLIO.fieldNames()
    part = JobOptions(root="/x", index_mode="partition")
    assert part.group_keys == ("index",) and part.leading_partitions == ("index",) and part.raw_schema == RAW


def test_the_language_chooses_the_number_grammar():
    assert JobOptions(root="/x").number_mode == "ptbr"
    assert JobOptions(root="/x", language="en-us").number_mode == "enus"
    assert JobOptions(root="/x", language="fr", number_mode="compat").number_mode == "compat"
    with pytest.raises(ValueError, match="language"):
        JobOptions(root="/x", language="fr")


def test_users_settings_win_over_the_defaults(spark):
    from folioflow.session import SESSION_DEFAULTS, build_session

    assert "minPartitionSize" not in str(SESSION_DEFAULTS)
    again = build_session("local[*]", **{"spark.sql.shuffle.partitions": "8"})
    assert again.conf.get("spark.sql.shuffle.partitions") == "8"


def test_no_scratch_folder_is_made_up_on_a_cluster(spark):
    from types import SimpleNamespace

    from folioflow.session import shared_dir

    context = SimpleNamespace(master="yarn", getCheckpointDir=lambda: None, getConf=lambda: {})
    with pytest.raises(RuntimeError, match="spark.checkpoint.dir"):
        shared_dir(SimpleNamespace(sparkContext=context))

import json

import pytest

from snapsync.options import (
    MIB,
    CatalogTarget,
    ConnectorTarget,
    CopyOptions,
    FileTarget,
    load_settings,
)
from snapsync.sources.files import FileSource
from snapsync.sources.jdbc import JdbcSource, sql_string

SETTINGS = {
    "source-db": {
        "url": "jdbc:mysql://host/shop?noTimezoneConversionForDateType=false",
        "user": "robot",
        "password": "hidden-word",
        "database": "shop",
        "tables-whitelist": ["Orders", "lineitem"],
        "tables-blacklist": [],
        "auto-parallelize": True,
        "megabytes-per-partition": 300,
    },
    "gcp": {
        "project-id": "proj",
        "tempbucket-id": "bucket",
        "dataset-id": "data",
        "create-if-absent": True,
        "overwrite-existing": False,
        "table-prefix": "pre_",
    },
    "attempt-incremental-updates": False,
    "max-parallel-writers": 4,
    "max-retries": 3,
}


def test_defaults():
    options = CopyOptions()
    assert options.bytes_per_split == 100 * MIB
    assert options.min_split_bytes == 200 * MIB
    assert options.max_parallel_writers == 8
    assert options.max_attempts == 1
    assert options.auto_split and options.overwrite_existing and options.create_if_absent
    assert not options.incremental and not options.raise_on_failure
    assert options.whitelist == options.blacklist == frozenset()
    assert options.marker == "updated_at"


def test_lists_are_lower_cased():
    assert CopyOptions(whitelist=["Users"]).whitelist == {"users"}


@pytest.mark.parametrize("attempts", [-1, 0, 1])
def test_at_least_one_attempt(attempts):
    assert CopyOptions(max_attempts=attempts).max_attempts == 1


@pytest.mark.parametrize(
    "bad",
    [
        {"bytes_per_split": 0},
        {"max_parallel_writers": 0},
        {"max_splits": 0},
        {"min_split_bytes": -1},
        {"lookback": -1},
        {"split_by": "hash"},
    ],
)
def test_bad_options(bad):
    with pytest.raises(ValueError):
        CopyOptions(**bad)


def test_one_name_is_no_list():
    with pytest.raises(TypeError):
        CopyOptions(whitelist="users")


def test_settings():
    env = {"GOOGLE_APPLICATION_CREDENTIALS": "/keys/k.json"}
    source, target, options = load_settings(json.dumps(SETTINGS), env)
    assert isinstance(source, JdbcSource) and source.database == "shop"
    assert options.whitelist == {"orders", "lineitem"}
    assert options.bytes_per_split == 300 * MIB
    assert options.max_attempts == 3 and options.max_parallel_writers == 4
    assert options.overwrite_existing is False and options.create_if_absent is True
    assert isinstance(target, ConnectorTarget) and target.prefix == "pre_"
    assert target.write_options("pre_lineitem") == {
        "temporaryGcsBucket": "bucket",
        "parentProject": "proj",
        "credentialsFile": "/keys/k.json",
        "table": "proj:data.pre_lineitem",
    }


def test_settings_for_files_and_catalog():
    source, target, options = load_settings(
        {
            "source-files": {"path": "/in", "keys": {"t": ["id"]}, "tables-blacklist": ["X"]},
            "target-files": {"path": "/out/", "table-prefix": "p_"},
            "attempt-incremental-updates": True,
        },
        {},
    )
    assert source == FileSource("/in", keys={"t": ["id"]})
    assert target == FileTarget("/out/", prefix="p_")
    assert target.qualified("p_t") == "/out/p_t"
    assert options.incremental and options.blacklist == {"x"}
    _, target, _ = load_settings(
        {"source-files": {"path": "/in"}, "target-catalog": {"database": "db"}}, {}
    )
    assert target == CatalogTarget("db") and target.qualified("t") == "db.t"


@pytest.mark.parametrize("section,key", [("source-db", "url"), ("gcp", "dataset-id")])
def test_missing_settings(section, key):
    settings = json.loads(json.dumps(SETTINGS))
    del settings[section][key]
    with pytest.raises(ValueError, match=key):
        load_settings(settings, {})
    with pytest.raises(ValueError, match=section):
        load_settings({k: v for k, v in settings.items() if k != section}, {})


def test_every_field_has_a_setting():
    settings = {
        "source-db": SETTINGS["source-db"] | {
            "driver": "d", "fetch-size": 5, "options": {"a": "b"}, "catalog": "metadata",
            "max-splits": 9, "mutable-marker": "changed",
        },
        "target-files": {
            "path": "/o", "keep-versions": 4, "max-parts": 6, "verify": True,
            "write-options": {"maxRecordsPerFile": "7"},
        },
        "retry-wait-seconds": 1.5,
    }
    source, target, options = load_settings(settings, {})
    assert (source.driver, source.fetchsize, source.catalog) == ("d", 5, "metadata")
    assert source.options == {"a": "b"} and source.catalog_kind == "metadata"
    assert target == FileTarget(
        "/o", keep_versions=4, max_parts=6, verify=True, write_options={"maxRecordsPerFile": "7"}
    )
    assert (options.max_splits, options.marker, options.retry_wait_seconds) == (9, "changed", 1.5)
    _, target, _ = load_settings(
        {"source-files": {"path": "/in"}, "target-catalog": {"database": "d", "format": "orc"}}, {}
    )
    assert target == CatalogTarget("d", format="orc")


@pytest.mark.parametrize(
    "section,key",
    [(None, "max-retrys"), ("source-db", "fetchsize"), ("gcp", "project"), ("source-db", "path")],
)
def test_unknown_settings_are_refused(section, key):
    settings = json.loads(json.dumps(SETTINGS))
    (settings if section is None else settings[section])[key] = 1
    with pytest.raises(ValueError, match=key):
        load_settings(settings, {})


def test_passwords_are_masked_wherever_they_are():
    source = JdbcSource(
        "jdbc:mysql://u:in-host@h/db?user=a&password=in-url&x=y", "db", password="plain-word",
        options={"trustStorePassword": "in-options", "fetch": "shown"},
    )
    text = "in-host in-url plain-word in-options shown"
    assert source.masked(text) == "*** *** *** *** shown"
    assert not any(s in repr(source) for s in ("in-host", "in-url", "plain-word", "in-options"))
    assert source.reader_options()["preferTimestampNTZ"] == "true"
    off = JdbcSource("jdbc:x", "db", options={"preferTimestampNTZ": "false"})
    assert off.reader_options()["preferTimestampNTZ"] == "false"


def test_reader_options_of_mysql():
    source, _, _ = load_settings(SETTINGS, {})
    options = source.reader_options()
    assert options["url"].endswith("&useCursorFetch=true")
    assert options["driver"] == "com.mysql.cj.jdbc.Driver"
    assert options["fetchsize"] == "10000"
    assert (options["user"], options["password"]) == ("robot", "hidden-word")
    assert source.catalog_kind == "information_schema"
    assert JdbcSource("jdbc:derby:memory:x", "APP").catalog_kind == "metadata"
    assert "useCursorFetch" not in JdbcSource("jdbc:derby:memory:x", "APP").reader_options()["url"]


def test_names_are_quoted_for_the_database(spark):
    source, _, _ = load_settings(SETTINGS, {})
    assert source.open(spark).qualified("order") == "`shop`.`order`"
    assert JdbcSource("jdbc:derby:memory:x", "APP").open(spark).qualified("t") == '"APP"."t"'
    assert sql_string("o'clock") == "'o''clock'"


def test_password_is_not_shown():
    source, target, _ = load_settings(SETTINGS, {})
    assert "hidden-word" not in repr(source) and "bucket" not in repr(target)

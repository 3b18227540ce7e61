"""A table that repeats an id stops the close, or is put right with the rest set aside."""

import dataclasses
import tempfile

import pytest
from pyspark.sql import functions as F
from settlebook.functions import decimals_to_double
from settlebook.oracle.compare import digest
from settlebook.plans import FIXTURE, close_period
from settlebook.sources import DriverTables, settlement_inputs, write_stage
from settlebook.sources.keys import RepeatedKeys, repeated_keys, split_repeated, verified

from conftest import SF_SMALL


@pytest.fixture(scope="module")
def sound(spark):
    return settlement_inputs(DriverTables(spark, SF_SMALL))


@pytest.fixture(scope="module")
def broken(sound):
    """Events 1 and 2 once more (2 with an end date in the past, so that the sound row is the greater), one order three times."""
    again = sound.events.where("id between 1 and 2").withColumn("end_date", F.lit("1990-01-01").cast("timestamp_ntz")).withColumn("start_date", F.lit("1980-01-01").cast("timestamp_ntz"))
    order = sound.orders.where("id = 3")
    return dataclasses.replace(sound, events=sound.events.unionByName(again), orders=sound.orders.unionByName(order).unionByName(order))


def test_sound_inputs_pass(sound):
    assert repeated_keys(sound) == []
    x, aside = verified(sound)
    assert x == sound and aside == {}


def test_the_close_stops_and_names_tables_and_ids(broken):
    with pytest.raises(RepeatedKeys) as e:
        verified(broken)
    assert "events: 2 values of id have 4 rows (the least is 1, the greatest 2)" in str(e.value)
    assert "orders: 1 values of id have 3 rows (the least is 3, the greatest 3)" in str(e.value)


def test_quarantine_gives_the_sound_close_and_the_other_rows(sound, broken):
    x, aside = verified(broken, "quarantine")
    def fingerprint(inputs):
        df = decimals_to_double(close_period(inputs, FIXTURE).balance)
        return digest(df.columns, [tuple(r) for r in df.collect()])
    assert sorted(aside) == ["events", "orders"]
    assert aside["orders"].count() == 2 and aside["events"].count() == 2
    assert x.events.exceptAll(sound.events).isEmpty() and sound.events.exceptAll(x.events).isEmpty()
    assert fingerprint(x) == fingerprint(sound)


def test_split_keeps_one_row_and_every_other(spark):
    rows = [(1, "a", None), (1, "b", 2), (1, "b", 2), (2, "c", 1), (None, "d", 1), (None, "d", 1)]
    kept, rest = split_repeated(spark.createDataFrame(rows, "id long, t string, n int"), "id")
    assert sorted(map(tuple, kept.collect()), key=str) == sorted([(1, "b", 2), (2, "c", 1), (None, "d", 1), (None, "d", 1)], key=str)
    assert sorted(map(tuple, rest.collect()), key=str) == sorted([(1, "a", None), (1, "b", 2)], key=str)


def test_cli_checks_keys(spark, broken):
    from settlebook.close import main
    root, out = tempfile.mkdtemp(prefix="settlebook-wh-"), tempfile.mkdtemp(prefix="settlebook-out-")
    for f in dataclasses.fields(broken):
        write_stage(getattr(broken, f.name), f"{root}/{f.name}")
    with pytest.raises(RepeatedKeys):
        main(["--inputs", root, "--out", out, "--period", "driver_fixture"])
    main(["--inputs", root, "--out", out, "--period", "driver_fixture", "--keys", "quarantine"])
    assert spark.read.parquet(f"{out}/quarantine/events").count() == 2

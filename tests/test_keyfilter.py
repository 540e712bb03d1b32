"""The filter over held keys: never misses one, and spares most look-ups."""

import pytest
from pyspark.sql import functions as F

from meterflow.operators import keyfilter as K
from meterflow.operators.staging import insert_missing
from meterflow.sources import master
from meterflow.sources.master import Master, add_missing, read_master, seed_devices
from tests.helpers import LOADED, rows_of


@pytest.fixture(scope="module")
def held(spark):
    return spark.range(20_000).select(F.concat(F.lit("MTR-"), F.col("id")).alias("k"), F.lit("old").alias("v"))


def test_every_held_key_is_found_and_few_others(spark, held):
    blocks = K.blocks_for(20_000)
    found = K.key_filter(held, ["k"], blocks)
    new = spark.range(15_000, 45_000).select(F.concat(F.lit("MTR-"), F.col("id")).alias("k"), "id")
    probed = K.with_maybe_held(new, found, ["k"], blocks)
    assert probed.columns == ["k", "id", "_maybe"] and probed.count() == 30_000
    assert probed.filter("id < 20000 AND NOT _maybe").count() == 0
    assert probed.filter("id >= 20000 AND _maybe").count() < 25_000 / 400


def test_filters_are_put_together(spark, held):
    whole = K.key_filter(held, ["k"], 7)
    parts = [K.key_filter(held.filter(F.xxhash64("k") % 2 == i), ["k"], 7) for i in (-1, 0, 1)]
    assert rows_of(K.merged(parts[0].union(parts[1]).union(parts[2]))) == rows_of(whole)
    share = whole.agg(K.fill_share(whole, 7)).first()[0]
    assert 0.2 < share < 0.4 and spark.range(0).select(F.lit(b"").alias("bits")).agg(K.fill_share(whole, 7)).first()[0] == 0


def test_inserts_equal_the_anti_join(spark, held):
    new = spark.range(30_000).select(
        F.when(F.col("id") % 100 != 0, F.concat(F.lit("MTR-"), F.col("id") * 7 % 29_000)).alias("k"), F.lit("new").alias("v"))
    blocks = K.blocks_for(20_000)
    unheld, checked = K.insert_missing_filtered(new, held, "k", K.key_filter(held, ["k"], blocks), blocks)
    assert "old" not in {r.v for r in unheld.unionByName(checked).select("v").distinct().collect()}
    assert rows_of(unheld.unionByName(checked)) == rows_of(insert_missing(new, held, "k"))
    assert checked.count() < unheld.count() / 100


def test_nothing_held_and_nothing_new(spark, held):
    empty = held.limit(0)
    unheld, checked = K.insert_missing_filtered(held, empty, "k", K.key_filter(empty, ["k"], 1), 1)
    assert (unheld.count(), checked.count()) == (20_000, 0)
    unheld, checked = K.insert_missing_filtered(empty, held, "k", K.key_filter(held, ["k"], 40), 40)
    assert (unheld.count(), checked.count()) == (0, 0)


def test_a_known_new_row_reads_nothing_of_the_table(spark, held):
    table = held.withColumn("stored", F.lit("in the table"))
    unheld, checked = K.insert_missing_filtered(held, table, "k", K.key_filter(held, ["k"], 40), 40)
    assert "LeftAnti" not in unheld._jdf.queryExecution().optimizedPlan().toString()
    assert "LeftAnti" in checked._jdf.queryExecution().optimizedPlan().toString()


def numbered_devices(spark, first, end):
    one = seed_devices(spark, LOADED).limit(1).drop("device_id")
    return spark.range(first, end).select(F.concat(F.lit("N-"), F.col("id")).alias("device_id")).crossJoin(one).select(
        *master.TABLES["device_master"].names)


def test_master_inserts_keep_a_filter_and_spare_the_table(spark, tmp_path, monkeypatch):
    source, table = Master(path=str(tmp_path)), "device_master"
    add_missing(spark, source, table, numbered_devices(spark, 0, 50))
    add_missing(spark, source, table, numbered_devices(spark, 40, 60))
    assert read_master(spark, source, table).count() == 60
    kept = [p.name for p in (tmp_path / "_keys" / table).iterdir()]
    assert kept == ["blocks-1"]
    monkeypatch.setattr(master, "read_master", lambda *a: pytest.fail("the table was read"))
    add_missing(spark, source, table, numbered_devices(spark, 100, 105))
    monkeypatch.undo()
    rows = read_master(spark, source, table)
    assert (rows.count(), rows.select("device_id").distinct().count()) == (65, 65)


def test_a_full_filter_is_built_anew_and_an_unfinished_one_left(spark, tmp_path):
    source, table = Master(path=str(tmp_path)), "device_master"
    add_missing(spark, source, table, numbered_devices(spark, 0, 10))
    add_missing(spark, source, table, numbered_devices(spark, 5, 9_000))
    add_missing(spark, source, table, numbered_devices(spark, 8_990, 9_010))
    widths = sorted(p.name for p in (tmp_path / "_keys" / table).iterdir())
    assert widths == ["blocks-1", "blocks-9"]
    (tmp_path / "_keys" / table / "blocks-9" / "_SUCCESS").unlink()
    add_missing(spark, source, table, numbered_devices(spark, 9_000, 9_020))
    rows = read_master(spark, source, table)
    assert (rows.count(), rows.select("device_id").distinct().count()) == (9_020, 9_020)

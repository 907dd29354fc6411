from __future__ import annotations

import pytest
from pyspark.sql import functions as F

from scoreloom.loader import Loader, batch_rows


@pytest.fixture(scope="module")
def rows(spark):
    return spark.range(1000).withColumnRenamed("id", "seq_id")


def order(df):
    placed = df.select((F.col("batch_id") * 64 + F.col("pos_in_batch")).alias("at"), "seq_id").orderBy("at").collect()
    assert [r["at"] for r in placed] == list(range(len(placed)))
    return [r["seq_id"] for r in placed]


def test_shuffle_is_seeded_and_complete(rows):
    first = order(Loader(shuffle=True, seed=1).run(rows))
    assert sorted(first) == list(range(1000)) and first != sorted(first)
    assert first == order(Loader(shuffle=True, seed=1).run(rows.repartition(7)))
    assert first != order(Loader(shuffle=True, seed=2).run(rows))


def test_repeat_keeps_or_changes_the_order(rows):
    same = order(Loader(shuffle=True, seed=1, repeat_count=2).run(rows))
    assert same[:1000] == same[1000:]
    new = order(Loader(shuffle=True, shuffle_repeat=True, seed=1, repeat_count=2).run(rows))
    assert new[:1000] != new[1000:] and sorted(new[:1000]) == sorted(new[1000:])
    with pytest.raises(ValueError):
        Loader(repeat_count=-1).run(rows)


def test_batches(rows):
    whole = Loader(batch_size=64).run(rows).groupBy("batch_id").count()
    assert sorted(r["count"] for r in whole.collect()) == [40] + [64] * 15
    full = Loader(batch_size=64, batch_drop_remainder=True).run(rows)
    assert full.count() == 15 * 64
    lists = batch_rows(full, "seq_id").collect()
    assert all(len(r["seq_id"]) == 64 for r in lists)
    with pytest.raises(ValueError):
        Loader(batch_size=-1).run(rows)


def test_steps_in_order(spark, rows, tmp_path):
    loader = Loader(
        parse=lambda df: df.withColumn("x", F.col("seq_id") * 2),
        map=lambda df: df.withColumn("x", F.col("x") + 1),
        filter=F.col("x") < 101,
        cache=True,
        cache_path=str(tmp_path / "cache"),
        batch_size=None,
    )
    assert loader.run(rows).agg(F.count("*"), F.max("x")).first() == (50, 99)
    assert spark.read.parquet(str(tmp_path / "cache")).count() == 50
    assert Loader(filter=lambda df: df.limit(3), cache=True, batch_size=None).run(rows).count() == 3

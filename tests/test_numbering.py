import random

import frames
import pytest
from pyspark.sql import functions as F

from quotaflow.operators import numbering as N


@pytest.mark.parametrize("partitions", [None, 1, 5, 40])
def test_numbers_are_dense_and_ordered(spark, partitions):
    ids = random.Random(4).sample(range(10_000), 700)
    df = spark.createDataFrame([(i,) for i in ids], "id long").repartition(6)
    got = frames.rows(N.number_rows(df, ["id"], "n", partitions), "id", "n")
    assert got == [(v, i + 1) for i, v in enumerate(sorted(ids))]


def test_descending_strings_with_null(spark):
    df = spark.createDataFrame([("b",), (None,), ("a",), ("ç",)], "s string")
    got = {r.s: r.n for r in N.number_rows(df, [F.desc("s")], "n").collect()}
    assert got == {"ç": 1, "b": 2, "a": 3, None: 4}


def test_no_rows(spark):
    assert N.number_rows(spark.createDataFrame([], "id long"), ["id"], "n").count() == 0


def test_numbers_survive_being_read_twice(spark):
    """The ranges are written once, so two reads cannot disagree."""
    df = spark.range(5000).withColumn("v", F.rand())
    numbered = N.number_rows(df, ["v"], "n", 7)
    assert numbered.join(numbered.withColumnRenamed("n", "m"), ["id", "v"]).where("n <> m").count() == 0
    assert numbered.agg(F.countDistinct("n"), F.max("n")).first()[:] == (5000, 5000)


@pytest.mark.parametrize("partitions", [1, 6])
def test_running_total(spark, partitions):
    rng = random.Random(5)
    rows = [(i, rng.randrange(100)) for i in range(300)]
    df = spark.createDataFrame(rows, "k long, v long").repartition(5)
    so_far, expected = 0, []
    for k, v in rows:
        so_far += v
        expected.append((k, so_far))
    assert frames.rows(N.running_total(df, ["k"], "v", "t", partitions), "k", "t") == expected


@pytest.mark.parametrize("values", [[1, 1, 1, 1], [1, 2, 3, 4, 5, 6, 7], [5] * 30 + [1, 2, 9, 9, 9], [3], [None, 2, 4]])
def test_rank_cuts_equal_percent_rank(spark, values):
    df = spark.createDataFrame([(v,) for v in values], "v long")
    cuts = N.rank_cuts(df, "v", (1 / 3, 2 / 3)).first()
    known = [v for v in values if v is not None]
    rank = {v: sum(o < v for o in known) / (len(known) - 1) if len(known) > 1 else 0.0 for v in known}
    for cut, share in zip(cuts, (1 / 3, 2 / 3)):
        reached = [v for v in known if rank[v] >= share]
        assert cut == (min(reached) if reached else None)


def test_unread_numbers_cost_no_join(spark, capsys):
    N.number_rows(spark.range(100), ["id"], "n").select("id").explain()
    assert "Join" not in capsys.readouterr().out

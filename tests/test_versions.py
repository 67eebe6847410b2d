"""Published versions and snapshots: runs that fail, runs that are repeated, and changed cells."""

import glob

import pytest
from pyspark.sql import functions as F

from demandtide.operators.quality import check_contract, column_profile, column_values
from demandtide.sources import writing as W


def test_a_failed_try_changes_nothing_and_a_repeated_one_neither(spark, tmp_path, rows):
    path = str(tmp_path / "t")
    with pytest.raises(FileNotFoundError):
        W.published(spark, path)
    first = spark.createDataFrame([(1, 1.0), (2, None)], "k int, v double")
    assert W.publish(first, path, "a") and not W.publish(first.limit(1), path, "a")
    broken = first.repartition(4).withColumn("v", F.when(F.col("k") == 2, F.raise_error(F.lit("stop")).cast("double")).otherwise(F.col("v")))
    with pytest.raises(Exception, match="stop"):
        W.publish(broken, path, "b")
    assert rows(W.published(spark, path), "k") == [(1, 1.0), (2, None)]
    assert W.publish(first.withColumn("v", F.lit(5.0)), path, "b")  # the second try of the same version
    assert rows(W.published(spark, path), "k") == [(1, 5.0), (2, 5.0)]
    assert rows(W.reload_table(W.published(spark, path).withColumn("v", F.col("v") + 1), path, "c"), "k") == [(1, 6.0), (2, 6.0)]
    assert W.published(spark, path, every=True).count() == 6 and [c.version for c in W.commits(spark, path)] == ["a", "b", "c"]


def test_content_sums_see_changes_and_not_the_order(spark):
    values = [(k, "x" if k % 3 else None, None if k % 5 else 0.5) for k in range(50)]
    df = spark.createDataFrame(values, "k int, s string, v double")
    one = W.content_sum(df).first()
    assert one == W.content_sum(df.repartition(7).orderBy(F.desc("k"))).first()
    assert one != W.content_sum(df.withColumn("v", F.when(F.col("k") == 7, 1.0).otherwise(F.col("v")))).first()
    assert W.content_sum(spark.createDataFrame([(None, 1)], "a int, b int")).first() != W.content_sum(spark.createDataFrame([(1, None)], "a int, b int")).first()
    assert tuple(W.content_sum(df.limit(0)).first()) == (0, "0")


def test_snapshots_come_back_in_their_types_and_notice_a_changed_cell(spark, tmp_path):
    texts = ["", None, "\\N", "a;b", 'say "x"', "two\nlines\r\n", "back\\slash\\n", " spaced ", "ü"]
    odd = spark.createDataFrame([(k, t, k / 7, k % 2 == 0) for k, t in enumerate(texts)] + [(None, None, None, None)], "k long, t string, v double, b boolean")
    odd = odd.withColumn("d", F.lit("2020-02-29").cast("date")).withColumn("ts", F.lit("2020-02-29 12:00:00.123456").cast("timestamp"))
    tables = {"odd": odd, "none": odd.limit(0)}
    W.write_snapshot(spark, tables, str(tmp_path), "1")
    back = W.read_snapshot(spark, str(tmp_path), "1")
    key = lambda r: str(r)
    assert sorted(back["odd"].collect(), key=key) == sorted(odd.collect(), key=key) and back["none"].count() == 0 and back["none"].schema == odd.schema
    part = next(p for p in glob.glob(str(tmp_path / "1_odd.csv" / "part-*.csv")) if "spaced" in open(p, encoding="utf-8").read())
    body = open(part, encoding="utf-8").read()
    open(part, "w", encoding="utf-8").write(body.replace("spaced", "changed"))
    for crc in glob.glob(str(tmp_path / "1_odd.csv" / ".*.crc")):
        open(crc, "wb").close()  # the file system's own check is not what is tested
    with pytest.raises(Exception, match="odd|[Cc]hecksum"):
        W.read_snapshot(spark, str(tmp_path), "1")


def test_values_of_all_columns(spark, rows):
    df = spark.createDataFrame([(1, "a"), (1, None), (2, "a")], "n int, s string")
    assert sorted(rows(column_values(df)), key=str) == sorted([("n", "1", 2), ("n", "2", 1), ("s", "a", 2), ("s", None, 1)], key=str)
    assert "values_text" not in column_profile(df).columns and column_profile(df, 2).filter("column_name = 'n'").first().values_text == "1,"
    with pytest.raises(ValueError, match="repeated"):
        check_contract(df.select("n", F.col("s").alias("n")), ["n"])


def test_snapshot_cells_of_numbers_are_neither_searched_nor_split(spark):
    """Only text can hold what has to be escaped; its cells come back whatever they hold."""
    texts = ["", "\\", "\\\\", "\\N", "\\\\N", "\\n", "a\nb", "a\\\nb\r", "a\\\\", ";\"x\"", None]
    df = spark.createDataFrame([(k, None if k == 3 else k / 4.0, k % 2 == 0, t) for k, t in enumerate(texts)], "k long, v double, b boolean, t string")
    plans = [x._jdf.queryExecution().optimizedPlan().toString() for x in (W._as_text(df.select("k", "v", "b")), W._from_text(W._as_text(df), df.schema).select("k", "v", "b"))]
    assert all(word not in plan for plan in plans for word in ("replace", "transform", "split"))
    back = W._from_text(W._as_text(df), df.schema)
    assert back.schema == df.schema and sorted(back.collect()) == sorted(df.collect())

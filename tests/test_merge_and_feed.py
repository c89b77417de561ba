"""NULL keys, repeated keys and columns of one side only."""

from __future__ import annotations

import pytest

from tidemark.operators import feed, merge

T = "k BIGINT, v STRING"


def rows(df):
    return sorted((tuple(r) for r in df.collect()), key=repr)


def test_merge_refuses_a_repeated_source_key(spark):
    target = spark.createDataFrame([(1, "a"), (2, "b"), (None, "n")], T)
    assert rows(merge.merge_upsert(target, spark.createDataFrame([(1, "x"), (None, "m"), (None, "m")], T), "k")) == sorted(
        [(1, "x"), (2, "b"), (None, "n"), (None, "m"), (None, "m")], key=repr
    )
    with pytest.raises(Exception, match="repeats k = 1"):
        merge.merge_upsert(target, spark.createDataFrame([(1, "x"), (1, "y")], T), "k").collect()


def test_insert_keeps_every_row_without_a_key(spark):
    target = spark.createDataFrame([(1, "a"), (None, "n")], T)
    new = spark.createDataFrame([(None, "x"), (None, "x"), (2, "z"), (2, "y"), (1, "b")], T)
    assert rows(merge.insert_if_absent(target, new, "k")) == sorted(
        [(1, "a"), (None, "n"), (None, "x"), (None, "x"), (2, "y")], key=repr
    )
    pairs = "a BIGINT, b BIGINT, v STRING"
    target = spark.createDataFrame([(1, 1, "a")], pairs)
    new = spark.createDataFrame([(1, 2, "x"), (1, 1, "y"), (1, None, "z")], pairs)
    assert rows(merge.insert_if_absent(target, new, ["a", "b"])) == sorted([(1, 1, "a"), (1, 2, "x"), (1, None, "z")], key=repr)


@pytest.mark.parametrize("operator", [merge.insert_if_absent, merge.merge_upsert])
def test_columns_of_one_side_are_an_error(spark, operator):
    with pytest.raises(ValueError, match="extra"):
        operator(spark.createDataFrame([(1, "a")], T), spark.createDataFrame([(2, "b", 1)], T + ", extra INT"), "k")


def test_feed_shows_added_and_removed_columns(spark):
    old = spark.createDataFrame([(1, "a"), (2, "b"), (3, "c"), (None, "n")], T)
    new = spark.createDataFrame([(1, "a", 7), (2, "b", None), (4, "d", 1), (None, "n", None)], T + ", extra INT")
    got = feed.change_feed(old, new, "k").select("k", "op", "before.extra", "after.extra")
    assert rows(got) == sorted([(1, "u", None, 7), (3, "d", None, None), (4, "c", None, 1), (None, "d", None, None), (None, "c", None, None)], key=repr)
    back = feed.change_feed(new, old, "k").select("k", "op")
    assert (1, "u") in rows(back)
    with pytest.raises(ValueError, match="v is string and bigint"):
        feed.change_feed(old, spark.createDataFrame([(1, 2)], "k BIGINT, v BIGINT"), "k")
    with pytest.raises(Exception, match="repeats k = 1"):
        feed.change_feed(old.union(old), old, "k").collect()


@pytest.mark.parametrize("key", ["bigint", "string"])
def test_sparse_feed_equals_the_whole_one(spark, key):
    old = spark.range(0, 3000, 1, 4).selectExpr(f"CAST(id - 1500 AS {key}) AS k", "CAST(id AS STRING) AS v", "CAST(NULL AS STRING) AS w")
    old = old.unionByName(spark.createDataFrame([(None, "n", "n")], f"k {key}, v STRING, w STRING"))
    moved = "k = '7' OR k = '-1400'"  # a value that changes its column is a change, though NULL adds nothing to a hash
    new = old.selectExpr("k", f"CASE WHEN {moved} THEN w ELSE v END AS v", f"CASE WHEN {moved} THEN v ELSE w END AS w")
    new = new.where("k IS NULL OR k NOT IN ('8', '900')").unionByName(new.where("k = '1000'").selectExpr(f"CAST('5000' AS {key}) AS k", "v", "w"))
    whole = rows(feed.change_feed(old, new, "k"))
    assert rows(feed.sparse_change_feed(old, new, "k")) == whole and len(whole) == 7
    assert rows(feed.sparse_change_feed(old, old.where("k IS NOT NULL"), "k"))[0][1] == "d"
    assert feed.sparse_change_feed(old.dropna(subset=["k"]), old.dropna(subset=["k"]), "k").isEmpty()
    assert feed.sparse_change_feed(old.limit(0), old.limit(0), "k").isEmpty()
    with pytest.raises(Exception, match="repeats k = 3"):
        feed.sparse_change_feed(old, old.unionByName(old.where("k = '3'")), "k").collect()
    # an added column is a change where it holds a value
    wider = old.selectExpr("*", "CASE WHEN k = '11' THEN 1 END AS extra")
    assert [r[1] for r in rows(feed.sparse_change_feed(old, wider, "k").where("k IS NOT NULL"))] == ["u"]

"""Lists in bounded parts."""

import pytest
from pyspark.sql import functions as F

from curata.operators import dims, lists, quality
from tests.conftest import rows


def test_a_key_with_a_million_details(spark):
    df = spark.range(1_000_000).select(F.lit("hot").alias("k"), F.col("id").alias("d")).unionByName(
        spark.createDataFrame([("cold", 5), (None, 7), ("cold", 5)], "k string, d long"))
    p = dims.collapse_parts(df, ["k"], ["d"]).select("k", "part", F.size("entries").alias("n"), F.col("entries")[0]["d"].alias("low"),
                                                     F.element_at("entries", -1)["d"].alias("high"))
    got = p.orderBy("k", "part").collect()
    hot = [r for r in got if r["k"] == "hot"]
    assert len(hot) >= 100 and max(r["n"] for r in got) <= lists.PER_PART and sum(r["n"] for r in hot) == 1_000_000
    assert hot[0]["low"] == 0 and all(a["high"] + 1 == b["low"] for a, b in zip(hot, hot[1:]))
    assert sorted((str(r["k"]), r["n"]) for r in got if r["k"] != "hot") == [("None", 1), ("cold", 1)]


@pytest.mark.parametrize("per_part", [1, 3, 100])
def test_parts_join_to_the_whole_lists(spark, per_part):
    v = spark.createDataFrame([(1, x) for x in "qwertyuiop"] + [(1, "q"), (2, "a, b"), (3, None)], "list_id int, column_value string")
    p = quality.value_list_parts(v, per_part=per_part)
    whole = p.groupBy("list_id").agg(F.array_join(F.transform(F.sort_array(F.collect_list(F.struct("part", "valid_list"))), lambda x: x["valid_list"]), ",").alias("valid_list"))
    assert rows(whole, "list_id", "valid_list") == [r for r in rows(quality.value_lists(v), "list_id", "valid_list") if r[1]]
    d = v.where("column_value IS NOT NULL").distinct()
    again = lists.joined(lists.parts(d, ["list_id"], ["column_value"], per_part=per_part), ["list_id"])
    assert {r["list_id"]: [x[0] for x in r["entries"]] for r in again.collect()} == {1: sorted("qwertyuiop"), 2: ["a, b"]}
    assert lists.parts(d.limit(0), ["list_id"], ["column_value"]).count() == 0
    with pytest.raises(ValueError):
        lists.parts(d, ["list_id"], ["column_value"], per_part=0)

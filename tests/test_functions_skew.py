"""Scalar functions (P3-P16), sources (S2-S5) and the skew-safe helpers against plain Spark forms."""

import datetime as dt
import decimal
import os

from pyspark.sql import Window
from pyspark.sql import functions as F

from graphmill.functions import keys as K
from graphmill.functions import rows as R
from graphmill.operators import skew as S
from graphmill.sources import index as IX
from graphmill.sources import providers as PR
from graphmill.sources import whitelist as WL


def mixed(spark):
    # FIXTURES 4: 100 rows of mixed types; the date text is 19/12/{1970+i}
    data = [
        (f"Person-{i}", i, [f"Fruit-{i}", f"Game-{i}"], dt.datetime(1970 + i, 12, 19), decimal.Decimal(i), dt.date(1970 + i, 12, 19))
        for i in range(100)
    ]
    schema = "String string, Integer long, List array<string>, Timestamp timestamp_ntz, Decimal decimal(10,0), DateType date"
    return spark.createDataFrame(data, schema)


def test_row_to_json_roundtrip(spark):
    df = mixed(spark).withColumn("String", F.when(F.col("Integer") == 3, None).otherwise(F.col("String")))
    js = R.row_to_json(df, "graph_node")
    assert js.columns == ["graph_node"]
    row3 = js.collect()[3]["graph_node"]
    assert '"String":null' in row3 and '"Decimal":3.0' in row3
    back = js.select(R.json_to_row("graph_node", df.schema.simpleString()).alias("r")).select("r.*")
    assert back.where("Integer = 7").collect()[0]["List"] == ["Fruit-7", "Game-7"]
    m = js.select(R.json_to_map("graph_node").alias("m")).collect()[3]["m"]
    assert "String" in m and m["String"] is None


def test_scalar_forms(spark):
    df = spark.createDataFrame([(dt.datetime(2024, 3, 5, 7, 8, 9),)], "ts timestamp_ntz")
    r = df.select(
        R.ts_text("ts").alias("t"),
        R.unix_seconds("ts").alias("u"),
        K.translation_id(F.lit("req"), F.col("ts"), F.lit("src")).alias("tid"),
    ).collect()[0]
    assert r["t"] == "2024-03-05 07:08:09" and r["u"] == 1709622489 and r["tid"] == "req_2024_3_5_7_8_9_src"
    p = spark.createDataFrame([(25, 200), (75, 200), (1, 0)], "p long, c long").select(R.percent_done("p", "c").alias("x")).collect()
    assert [x["x"] for x in p] == [12.0, 38.0, None]  # half to even; no division by zero
    nested = spark.createDataFrame([([[["a"], ["b"]], [["c"]]],)], "x array<array<array<string>>>")
    assert nested.select(R.flatten_all("x", nested.schema["x"].dataType).alias("f")).collect()[0]["f"] == ["a", "b", "c"]
    e = spark.createDataFrame([(1, "a", "z")], "event_id long, user string, _hidden string")
    assert e.select(R.to_json_without(e, ["user"])).collect()[0][0] == '{"event_id":1,"_hidden":"z"}'
    long = R.to_entries(e, ["event_id", "user", "_hidden"]).collect()
    assert sorted((r["attribute"], r["value"]) for r in long) == [("event_id", "1"), ("user", "a")]


def test_sources(spark, tmp):
    ids = spark.range(10).withColumnRenamed("id", "i")
    srcs = PR.mock_sources(ids)
    assert [s.name for s in srcs] == ["source-1", "source-2"]
    r = srcs[0].data.where("age = 3").collect()[0]
    assert (r["_uid"], r["name"], r["likes"], r["email"]) == ("source-1-3", "3-source-1", ["3-Oranges", "3-Apples"], "3-source-1@gmail.com")
    docs = PR.index_documents(spark.range(100).withColumnRenamed("id", "i"))
    path = os.path.join(tmp, "idx")
    docs.where("pid < 50").withColumn("long_text", F.array(F.lit("x"), F.lit("y"))).write.json(path + "/a")
    docs.where("pid >= 50").withColumn("long_text", F.lit("only")).write.json(path + "/b")
    got = IX.read_index(spark, path + "/*", "json", array_fields=["long_text"])
    assert got.count() == 100
    assert {tuple(r["long_text"]) for r in got.collect()} == {("x", "y"), ("only",)}
    wl_path = os.path.join(tmp, "wl.txt")
    with open(wl_path, "w") as f:
        f.write("source-1\n\n  source-3 \n")
    sources = spark.createDataFrame([("source-1",), ("source-2",), ("source-3",)], "source_name string")
    assert sorted(r[0] for r in WL.select_sources(sources, WL.read_white_list(spark, wl_path)).collect()) == ["source-1", "source-3"]


def _events(spark):
    return spark.read.parquet("/root/testdata/sf0.001/events.parquet").select("user_id", "ts", "event_id", "event_type")


def test_number_within_equals_window(spark):
    ev = _events(spark)
    # a hot key: every row of user 3 repeated under user 3 again, so it spans several range partitions
    ev = ev.unionByName(ev.withColumn("user_id", F.lit(3).cast("long")).withColumn("event_id", F.col("event_id") + 100000))
    mine = S.number_within(ev, ["user_id"], ["ts", "event_id"], partitions=8)
    ref = ev.withColumn("rn", F.row_number().over(Window.partitionBy("user_id").orderBy("ts", "event_id")))
    key = ["user_id", "event_id", "rn"]
    assert sorted(tuple(r) for r in mine.select(*key).collect()) == sorted(tuple(r) for r in ref.select(*key).collect())
    glob = S.number_within(ev, [], ["event_id"], out="g")
    assert sorted(r["g"] for r in glob.collect()) == list(range(1, ev.count() + 1))


def test_number_within_has_one_shuffle_and_needs_no_checkpoint(spark):
    """A key over all partitions, one that ends where a partition does, null and NaN keys, nested keys, a map beside them."""
    ev = _events(spark).withColumn("m", F.create_map(F.lit("a"), "event_id"))
    hot = ev.withColumns({"k": F.when(F.col("event_id") % 3 > 0, F.lit(7.0)).when(F.col("event_id") % 2 == 0, F.lit(float("nan"))), "a": F.array((F.col("event_id") % 2).cast("int"))})
    for keys in (["k"], ["k", "a"], [], ["event_id"]):
        mine = S.number_within(hot, keys, [F.col("ts").desc(), "event_id"], partitions=16)
        w = Window.partitionBy(*keys).orderBy(F.col("ts").desc(), "event_id")
        ref = hot.withColumn("rn", F.row_number().over(w))
        rows = mine.select("event_id", "rn", "m").collect()
        assert sorted((r["event_id"], r["rn"], r["m"]["a"]) for r in rows) == sorted((r["event_id"], r["rn"], r["m"]["a"]) for r in ref.collect())
        mine = S.number_within(hot, keys, [F.col("ts").desc(), "event_id"], partitions=16)
        mine.write.format("noop").mode("overwrite").save()
        first = mine._jdf.queryExecution()
        first.executedPlan().execute().count()
        plan = first.executedPlan().toString()
        final = plan[: plan.index("== Initial Plan ==")] if "== Initial Plan ==" in plan else plan
        assert final.count("Exchange rangepartitioning") - final.count("ReusedExchange [") <= 1, final
        assert "Scan ExistingRDD" not in plan  # no checkpoint
    assert S.number_within(hot.limit(0), ["k"], ["event_id"]).collect() == []


def test_top_n_and_latest(spark):
    ev = _events(spark)
    mine = S.top_n_within(ev, ["user_id"], [F.col("ts").desc(), F.col("event_id").desc()], 3, partitions=8)
    ref = ev.withColumn("rn", F.row_number().over(Window.partitionBy("user_id").orderBy(F.col("ts").desc(), F.col("event_id").desc()))).where("rn <= 3")
    key = ["user_id", "event_id", "rn"]
    assert sorted(tuple(r) for r in mine.select(*key).collect()) == sorted(tuple(r) for r in ref.select(*key).collect())
    latest = S.latest_per_key(ev, ["user_id"], ["ts", "event_id"], count_as="n")
    top1 = {r["user_id"]: r["event_id"] for r in ref.where("rn = 1").collect()}
    assert {r["user_id"]: r["event_id"] for r in latest.collect()} == top1


def test_split_join_all_kinds(spark):
    big = spark.range(0, 5000).select(F.when(F.col("id") < 2000, 0).otherwise(F.col("id") % 300).cast("long").alias("k"), F.col("id"))
    small = spark.range(0, 250).select(F.col("id").alias("sk"), (F.col("id") * 10).alias("payload"))
    assert S.hot_keys(big, "k", min_rows=1000) == [(0, 2010)]
    assert S.hot_keys_by_column(big, ["k", "id"], min_rows=1000) == {"k": [(0, 2010)], "id": []}
    for how in ("inner", "left", "left_semi", "left_anti"):
        a = S.split_join(big, small, "k", "sk", how, min_rows=1000)
        b = S.split_join(big, small, "k", "sk", how, min_rows=None)
        assert sorted(tuple(r) for r in a.collect()) == sorted(tuple(r) for r in b.collect()), how


def test_sizing():
    from graphmill.session import sizing

    s = sizing(10 * 2**40, 30 * 2**40)
    assert s["spark.sql.shuffle.partitions"] == "122880" and s["graph_buckets"] == "65536"
    assert sizing(1)["spark.sql.shuffle.partitions"] == "8" and sizing(1)["graph_buckets"] == "1"


def test_hot_keys_on_a_sample(spark):
    # 300k rows: key 0 holds 100k, key 1 holds 10k, the rest are spread thin
    df = spark.range(300_000).select(
        F.when(F.col("id") < 100_000, 0).when(F.col("id") < 110_000, 1).otherwise(F.col("id")).alias("k")
    )
    hot = S.hot_keys(df, "k", min_rows=50_000)  # sample rate 0.2
    assert [k for k, _ in hot] == [0] and 90_000 < hot[0][1] < 110_000
    both = S.hot_keys_by_column(df.withColumn("j", F.col("k")), ["k", "j"], min_rows=50_000)
    assert [k for k, _ in both["k"]] == [0] and [k for k, _ in both["j"]] == [0]

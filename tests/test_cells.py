import pytest
from pyspark.sql import functions as F

from roadpulse.operators import cells as C
from roadpulse.operators import ranks
from roadpulse.sources import celltable


@pytest.fixture(scope="module")
def rows(spark):
    return spark.createDataFrame(
        [("r1", {"a": "1", "b": "2"}), ("r2", {"a": "3"}), ("r3", {}), ("r4", None)],
        "rowkey string, cells map<string,string>")


def as_set(df):
    return {tuple(r) for r in df.select(*C.FULL).collect()}


def test_puts_agree(spark, rows):
    want = {("r1", "f", "a", 7, "1"), ("r1", "f", "b", 7, "2"), ("r2", "f", "a", 7, "3")}
    assert as_set(C.put_family(rows, "f", 7)) == want
    lists = spark.createDataFrame([("r1", ["1", "2"]), ("r2", ["3", None])], "rowkey string, vals array<string>")
    assert as_set(C.put_headers(lists, "f", ["a", "b"], 7)) == want
    nested = rows.select("rowkey", F.create_map(F.lit("f"), "cells").alias("families"))
    assert as_set(C.put_nested(nested.where("cells IS NOT NULL" if "cells" in nested.columns else "true"), 7)) == want
    flat = spark.createDataFrame([("r1", 1, 2), ("r2", 3, None)], "id string, a int, b int")
    assert as_set(C.put_columns(flat, "f", 7)) == want
    versioned = rows.select("rowkey", F.transform_values("cells", lambda k, v: F.struct(
        v.alias("value"), F.lit(7).cast("bigint").alias("version"))).alias("cells"))
    assert as_set(C.put_versioned(versioned, "f")) == want


@pytest.fixture(scope="module")
def store(spark):
    data = [("r1", "f", "a", 1, "old"), ("r1", "f", "a", 2, "new"), ("r1", "g", "x", 1, "gx"),
            ("r2", "f", "b", 5, "b5"), ("r3", "f", "a", 1, "a1"), ("r3", "f", "b", 1, "b1"), ("r3", "g", "x", 1, "g3")]
    return spark.createDataFrame(data, "rowkey string, family string, qualifier string, version bigint, value string")


def test_reads(store):
    got = {r.rowkey: r.families for r in C.read_columns(store, {"f": ["a"], "g": ["x"]}).collect()}
    assert got == {"r1": {"f": {"a": "new"}, "g": {"x": "gx"}}, "r3": {"f": {"a": "a1"}, "g": {"x": "g3"}}}
    versions = {r.rowkey: r.families for r in C.read_columns(store, {"f": ["a"]}, versions=True).collect()}
    assert tuple(versions["r1"]["f"]["a"]) == ("new", 2)
    whole = C.read_families(store, ["f"])
    newest = {("r1", "f", "a", 2, "new"), ("r2", "f", "b", 5, "b5"), ("r3", "f", "a", 1, "a1"), ("r3", "f", "b", 1, "b1")}
    assert as_set(whole) == newest
    assert {r.rowkey: r.families for r in C.nest(whole).collect()} == {
        "r1": {"f": {"a": "new"}}, "r2": {"f": {"b": "b5"}}, "r3": {"f": {"a": "a1", "b": "b1"}}}


def test_markers_of_all_kinds_at_once(spark, store):
    keys = spark.createDataFrame([("r1",), ("r1",), (None,)], "rowkey string")
    one = spark.createDataFrame([("r3", "f", "a", None), ("r2", "f", "b", 4), ("r2", "f", "b", 5)],
                                "rowkey string, family string, qualifier string, version bigint")
    markers = C.union_cells(C.family_markers(keys, ["g"]), C.column_markers(keys, {"f": ["b"], "g": ["x"]}),
                            C.listed_markers(one))
    left = C.delete_marked(store, markers)
    assert as_set(left) == as_set(store) - {("r1", "g", "x", 1, "gx"), ("r3", "f", "a", 1, "a1"), ("r2", "f", "b", 5, "b5")}
    assert as_set(C.delete_marked(store, C.union_cells(markers, C.row_markers(keys)))) == {
        c for c in as_set(left) if c[0] != "r1"}
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", -1)
    try:
        plan = C.delete_marked(store, markers)._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    cells_side = plan[plan.index("SortMergeJoin"):plan.index("Sort [_rowkey#")]
    assert plan.count("SortMergeJoin") == 1 and cells_side.count("Exchange") == 1


def test_point_get(spark, store):
    keys = spark.createDataFrame([("r1",), ("r1",), ("r9",)], "rowkey string")
    assert {r.rowkey for r in C.get_rows(store, keys).collect()} == {"r1"}
    assert C.get_rows(store, keys).count() == 3


def test_deletes(spark, store):
    k = spark.createDataFrame([("r1",)], "rowkey string")
    everything = as_set(store)
    assert as_set(C.delete_rows(store, k)) == {c for c in everything if c[0] != "r1"}
    assert as_set(C.delete_families(store, k, ["g"])) == everything - {("r1", "g", "x", 1, "gx")}
    assert as_set(C.delete_columns(store, k, {"f": ["a"]})) == {c for c in everything if c[:3] != ("r1", "f", "a")}
    per_row = spark.createDataFrame([("r1", ["a"]), ("r3", ["b"])], "rowkey string, columns array<string>")
    gone = {("r1", "f", "a"), ("r3", "f", "b")}
    assert as_set(C.delete_listed(store, C.listed_columns(per_row, family="f"))) == {
        c for c in everything if c[:3] not in gone}
    nested = spark.createDataFrame([("r3", {"f": ["a"], "g": ["x"]})], "rowkey string, columns map<string,array<string>>")
    assert as_set(C.delete_listed(store, C.listed_columns(nested))) == {
        c for c in everything if c[:3] not in {("r3", "f", "a"), ("r3", "g", "x")}}
    one = spark.createDataFrame([("r1", "f", "a", 1), ("r2", "f", "b", None)],
                                "rowkey string, family string, qualifier string, version bigint")
    assert as_set(C.delete_listed(store, one)) == everything - {("r1", "f", "a", 1, "old"), ("r2", "f", "b", 5, "b5")}


def test_sorted_layout_and_split_ranges(spark):
    many = spark.range(2000).select(
        F.format_string("k%04d", F.col("id") % 500).alias("rowkey"), F.lit("f").alias("family"),
        F.concat(F.lit("q"), (F.col("id") % 3).cast("string")).alias("qualifier"),
        F.col("id").alias("version"), F.lit("v").alias("value"))
    parts = C.sorted_layout(many, 4).rdd.glom().collect()
    keys = [[(r.rowkey, r.qualifier, -r.version) for r in p] for p in parts if p]
    assert len(keys) > 1 and all(k == sorted(k) for k in keys)
    assert all(a[-1][:2] < b[0][:2] for a, b in zip(keys, keys[1:]))
    splits = ranks.split_keys(many.select("rowkey"), "rowkey", 4)
    sizes = {r.region: r["count"] for r in C.with_range(many, splits).groupBy("region").count().collect()}
    assert set(sizes) == {0, 1, 2, 3} and max(sizes.values()) - min(sizes.values()) <= 8


def test_range_read_skips_the_other_files(spark, tmp_path):
    many = spark.range(20_000).select(
        F.format_string("k%05d", "id").alias("rowkey"), F.when(F.col("id") % 2 == 0, "f").otherwise("g").alias("family"),
        F.lit("q").alias("qualifier"), F.col("id").alias("version"), F.lit("v").alias("value"))
    path = str(tmp_path / "generation")
    celltable.bulk_load(many, path, 8)
    found = celltable.read_range(spark, path, "f", "k05000", "k05100")
    plan = found._jdf.queryExecution().executedPlan()
    assert {r.rowkey for r in found.collect()} == {f"k{i:05d}" for i in range(5000, 5100, 2)}
    scans = plan.collectLeaves()
    rows = [scans.apply(i).metrics().apply("numOutputRows").value() for i in range(scans.length())]
    assert 50 <= sum(rows) < 4_000 < many.where("family = 'f'").count(), rows


def test_cell_table(spark, store, tmp_path):
    path = str(tmp_path / "cells")
    celltable.append_cells(store, path)
    more = spark.createDataFrame([("r1", "f", "a", 3, "newest")],
                                 "rowkey string, family string, qualifier string, version bigint, value string")
    celltable.append_cells(more, path)
    back = celltable.read_cells(spark, path)
    assert as_set(back) == as_set(store) | as_set(more)
    newest = C.read_columns(back, {"f": ["a"]}).where("rowkey = 'r1'").first()
    assert newest.families["f"]["a"] == "newest"
    plan = C.wanted(back, {"f": ["a"]}).where("rowkey = 'r1'")._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(family" in plan and "EqualTo(rowkey,r1)" in plan
    sorted_path = str(tmp_path / "sorted")
    celltable.bulk_load(C.delete_rows(back, more.select("rowkey")), sorted_path, 2)
    assert {r.rowkey for r in celltable.read_cells(spark, sorted_path).collect()} == {"r2", "r3"}


def test_families_come_out_one_row_per_key(spark, data):
    from roadpulse.plans.catalog import QUERIES

    got = QUERIES["cells_families"](spark, data)
    orders = spark.read.parquet(f"{data}/orders.parquet")
    assert got.count() == orders.count() == got.select("rowkey").distinct().count()
    key = orders.where("o_orderkey % 3 = 0").first().o_orderkey
    row = got.where(F.col("rowkey") == str(key)[::-1]).first()
    assert row.o_price.startswith("9") and row.o_price_version == key + 1_000_000_000 and row.m_date_version == key

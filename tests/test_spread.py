from leadloom.plans import derived


def test_rows_from_one_small_file_are_dealt_out_before_they_are_normalised(spark, tmp_path):
    cores = spark.sparkContext.defaultParallelism
    tables = {
        "customer": spark.range(40).selectExpr("id AS c_custkey", "CAST(id % 2 AS INT) AS c_nationkey", "'MACHINERY' AS c_mktsegment"),
        "nation": spark.range(2).selectExpr("CAST(id AS INT) AS n_nationkey", "'NATION_' || id AS n_name"),
        "events": spark.range(40).selectExpr("id AS event_id", "timestamp'2026-01-01' AS ts", "'click' AS event_type", "id % 7 AS user_id"),
        "orders": spark.range(40).selectExpr("id AS o_orderkey", "id % 9 AS o_custkey"),
    }
    for name, rows in tables.items():
        rows.coalesce(1).write.parquet(f"{tmp_path}/{name}.parquet")
    for build in (derived.leads, derived.submissions, derived.contested, derived.followups):
        rows = build(spark, str(tmp_path))
        key = "id" if build is derived.leads else "seq"
        assert sorted(r[key] for r in rows.select(key).collect()) == list(range(1, 41))
        assert rows.rdd.getNumPartitions() >= cores

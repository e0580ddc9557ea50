"""Physical-plan checks: native expressions, top-k, join strategy, pushdown."""
from conftest import SF001
from contactlane.operators import directory as Dir
from contactlane.operators import validate as V
from contactlane.plans import queries as QS
from contactlane.sources import fixtures as fx


def plan(df) -> str:
    return df._jdf.queryExecution().toString()


def test_native_paths_have_no_python(spark):
    for name in ("validation_shaped", "routed", "review_queue", "emails_extracted",
                 "kpi_counts", "decisions", "outgoing_emails", "document_contacts"):
        p = plan(QS.REGISTRY[name](spark, SF001))
        assert "BatchEvalPython" not in p and "ArrowEvalPython" not in p, name
        assert "PythonUDF" not in p, name


def test_topk_is_take_ordered(spark):
    for name in ("pending_topk", "audit_log_topk", "followup_list"):
        assert "TakeOrderedAndProject" in plan(QS.REGISTRY[name](spark, SF001)), name


def test_small_directory_is_broadcast_at_run_time(spark):
    df = QS.directory_exists_join(spark, SF001)
    df.collect()
    final = df._jdf.queryExecution().executedPlan().toString().split("== Initial Plan ==")[0]
    assert "BroadcastHashJoin" in final and "SortMergeJoin" not in final


def test_building_plans_runs_nothing(spark):
    """No job starts before an action, also over derived frames (reading a
    table's schema is the one job that ``spark.read.parquet`` itself runs)."""
    from contactlane.operators import queue as Q
    from contactlane.plans import intake

    emails, actions, directory = fx.emails(spark, SF001), fx.actions(spark, SF001), QS.directory(spark, SF001)
    tracker = spark.sparkContext.statusTracker()
    spark.sparkContext.setJobGroup("building", "plans")
    derived = emails.groupBy("email_id", "sender", "body").count().drop("count")
    queue = intake.queue_rows(derived, directory, QS.as_of())
    dec = intake.decisions(queue, actions)
    frames = [queue, dec, intake.approved(dec, emails, "a", QS.as_of()), Q.with_body(queue, emails),
              Q.kpi_counts(Q.pending(queue, actions)), Dir.with_directory_flag(queue.drop("sap_exists"), directory)]
    jobs = list(tracker.getJobIdsForGroup("building"))
    spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)
    assert frames and jobs == []


def test_decisions_read_no_bodies(spark):
    assert not {"body", "email_body"} & set(QS.decided(spark, SF001).columns)


def test_large_directory_shuffles_with_salted_null_keys(spark):
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        df = Dir.with_directory_flag(V.validate_fields(fx.fields(spark, SF001)),
                                     QS.directory(spark, SF001))
        p = plan(df)
        assert "SortMergeJoin [_ex_lkey" in p and "BroadcastHashJoin" not in p
        assert df.where("sap_exists").count() == 106
        assert df.count() == 150
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def test_scans_prune_and_push_down(spark):
    p = plan(QS.new_since(spark, SF001))
    assert "PushedFilters: [IsNotNull(ts), GreaterThan(ts," in p.replace("\n", " ") or \
        "GreaterThan(ts" in p
    assert "ReadSchema: struct<ts:timestamp_ntz,event_type:string>" in p
    p = plan(QS.directory(spark, SF001))
    assert "PushedFilters: [IsNotNull(o_orderstatus), EqualTo(o_orderstatus,F)" in p
    assert "ReadSchema: struct<o_custkey:bigint,o_orderstatus:string>" in p


SKEW_CONF = {"spark.sql.autoBroadcastJoinThreshold": "-1",
             "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
             "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "1k",
             "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "2",
             "spark.sql.adaptive.advisoryPartitionSizeInBytes": "1k",
             "spark.sql.adaptive.coalescePartitions.enabled": "false",
             "spark.sql.shuffle.partitions": "8"}


def test_hot_key_is_split_and_results_whole(spark):
    """One non-NULL key holds a third of the rows, another third has NULL keys:
    AQE splits the hot partition (both join inputs are plain shuffles) and
    every row comes out exactly once."""
    from pyspark.sql import functions as F
    from contactlane.plans import joins

    n = 30000
    left = spark.range(n).select(
        F.when(F.col("id") % 3 == 0, F.lit("HOT"))
         .when(F.col("id") % 3 == 1, F.lit(None).cast("string"))
         .otherwise(F.concat(F.lit("K"), F.col("id").cast("string"))).alias("k"), "id")
    keys = spark.range(0, n, 2).select(F.concat(F.lit("K"), F.col("id").cast("string")).alias("k")) \
        .union(spark.createDataFrame([("HOT",), ("HOT",)], "k string"))
    old = {k: spark.conf.get(k, None) for k in SKEW_CONF}
    try:
        for k, v in SKEW_CONF.items():
            spark.conf.set(k, v)
        flagged = joins.exists_flag(left, keys, "k", "k", "hit")
        rows = flagged.collect()
        assert "SortMergeJoin(skew=true)" in flagged._jdf.queryExecution().executedPlan().toString()
        assert len(rows) == n and sum(r.hit for r in rows) == 15000
        assert len({r.id for r in rows}) == n
        anti = joins.anti_join(left, keys, "k", "k")
        ids = [r.id for r in anti.collect()]
        assert "SortMergeJoin(skew=true)" in anti._jdf.queryExecution().executedPlan().toString()
        assert len(ids) == 15000 and len(set(ids)) == 15000   # NULL keys + odd K keys
        right = keys.distinct().withColumn("v", F.length("k"))
        looked = joins.lookup(left, right, "k", "k")
        got = looked.collect()
        assert "SortMergeJoin(skew=true)" in looked._jdf.queryExecution().executedPlan().toString()
        assert len(got) == n and sum(1 for r in got if r.v is not None) == 15000
    finally:
        for k, v in old.items():
            if v is None:
                spark.conf.unset(k)
            else:
                spark.conf.set(k, v)


def test_rules_run_in_whole_stage_codegen(spark):
    """Every projection of the queue plan (extraction, rules, lookup, routing)
    is codegen'd -- marked ``*(n)`` in the executed plan."""
    df = QS.queue_direct(spark, SF001)
    df.collect()
    final = df._jdf.queryExecution().executedPlan().toString().split("== Initial Plan ==")[0]
    nodes = [ln.strip() for ln in final.splitlines() if "Project [" in ln]
    assert len(nodes) >= 4
    assert all(ln.lstrip(":+- ").startswith("*(") for ln in nodes), nodes[:3]


def test_bodies_are_cut_once(spark):
    """The label pattern runs twice a body -- to cut it and to name the cuts -- however
    many fields are read, in the frame and in the SQL function."""
    from pyspark.sql import functions as F

    from contactlane.operators import extract as X

    emails = fx.emails(spark, SF001).select("email_id", "body")
    struct = emails.select(F.expr(X.extract_struct_sql("body")).alias("x")).select("x.*")
    for df in (X.extract_labelled(emails), struct):
        optimized = df._jdf.queryExecution().optimizedPlan().toString()
        assert optimized.count("regexp_extract_all(") == 1 and optimized.count("split(") == 1


def test_hot_account_of_the_sql_statement_is_split(spark):
    from pyspark.sql import functions as F

    from contactlane.plans import composed_sql

    body = F.concat(F.lit("Name: A B SAP ID: "), F.when(F.col("id") % 3 == 0, "SAP000001").otherwise(
        F.concat(F.lit("SAP"), F.lpad(F.col("id").cast("string"), 6, "0"))), F.lit(" Thank you"))
    emails = spark.range(30000).select(F.concat(F.lit("e"), "id").alias("email_id"), F.lit("s").alias("sender"),
                                       body.alias("body"))
    directory = spark.range(5000).select(F.concat(F.lit("SAP"), F.lpad(F.col("id").cast("string"), 6, "0")).alias("sap_id"))
    kept = {k: spark.conf.get(k, None) for k in SKEW_CONF}
    try:
        for k, v in SKEW_CONF.items():
            spark.conf.set(k, v)
        out = composed_sql.review_records(spark, emails, directory)
        assert len(out.collect()) == 30000
        assert "SortMergeJoin(skew=true)" in out._jdf.queryExecution().executedPlan().toString()
    finally:
        for k, v in kept.items():
            spark.conf.unset(k) if v is None else spark.conf.set(k, v)

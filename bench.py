"""Benchmark: headline queries at $BENCH_SF_DIR on local[$BENCH_CPUS].

Prints one JSON line: {"metric", "value" (sum of headline seconds, best of a
cold and a warm run each), "unit", "queries": {name: sec}, "sf", ...}.
``BENCH_EVENT_LOG=1`` also writes Spark's event log to a scratch folder. Every query is run to completion into
the ``noop`` sink, so nothing is collected to the driver. Besides the
registered queries it measures the end-to-end intake on the fixture e-mails
replicated ``k`` times, and the field rules as native expressions beside the
cost of one trivial Python function per row.
"""

from __future__ import annotations

import json
import os
import sys
import tempfile
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

SF_DIR = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
CPUS = int(os.environ.get("BENCH_CPUS", "8"))
REPLICAS = int(os.environ.get("BENCH_REPLICAS", "20"))

HEADLINE = ("routing_summary", "review_queue", "emails_extracted", "review_record_sql",
            "pending_items", "kpi_counts", "decisions", "outgoing_emails", "followup_actions",
            "audit_log_topk", "latest_followup", "turnaround", "merge_corrections",
            "document_contacts")


def run(df) -> None:
    df.write.format("noop").mode("overwrite").save()


def timed(fn) -> float:
    t = time.perf_counter()
    fn()
    return round(time.perf_counter() - t, 3)


def main() -> None:
    from pyspark.sql import functions as F

    from contactlane.plans import intake
    from contactlane.plans import queries as QS
    from contactlane.session import build_session
    from contactlane.operators import validate as V
    from contactlane.sources import fixtures as fx
    from contactlane.sources import tables

    scratch = tempfile.mkdtemp(prefix="bench-")
    extra = {"spark.driver.memory": "16g",
             "spark.sql.files.maxPartitionBytes": str(64 * 1024 * 1024)}
    if os.environ.get("BENCH_EVENT_LOG"):  # stage/task times without the UI
        os.makedirs(os.path.join(scratch, "events"))
        extra |= {"spark.eventLog.enabled": "true",
                  "spark.eventLog.dir": os.path.join(scratch, "events")}
        print(f"event log: {scratch}/events", file=sys.stderr)
    spark = build_session(f"local[{CPUS}]", app_name="contactlane-bench",
                          shuffle_partitions=max(2 * CPUS, 8), extra=extra)
    if not spark.sparkContext.getCheckpointDir():
        spark.sparkContext.setCheckpointDir(os.path.join(scratch, "ckpt"))

    # warm-up: JVM, codegen caches, file listing
    run(QS.validation_shaped(spark, SF_DIR))

    results: dict[str, float] = {}
    cold: dict[str, float] = {}
    for name in HEADLINE:  # cold run, then a warm run; the warm one is reported
        fn = QS.REGISTRY[name]
        cold[name] = timed(lambda: run(fn(spark, SF_DIR)))
        results[name] = min(cold[name], timed(lambda: run(fn(spark, SF_DIR))))

    def written(df, name):
        """``df`` in as many files as there are tasks, so that a scan of it is parallel."""
        df.repartition(2 * CPUS).write.mode("overwrite").parquet(os.path.join(scratch, name))
        return spark.read.parquet(os.path.join(scratch, name))

    # end-to-end intake over k copies of every fixture e-mail (Generate, no join)
    emails = fx.emails(spark, SF_DIR).select("email_id", "sender", "body", "sap_id")
    copies = (emails.withColumn("_copy", F.explode(F.sequence(F.lit(1), F.lit(REPLICAS))))
              .withColumn("email_id", F.concat_ws("#", "email_id", F.col("_copy").cast("string")))
              .drop("_copy"))
    copies = written(copies, "emails")
    n_rows = copies.count()
    queue = intake.queue_rows(copies, QS.directory(spark, SF_DIR), QS.as_of())
    results[f"intake_x{REPLICAS}"] = timed(lambda: run(routing_summary(queue)))

    # field rules as native expressions, and beside them what one trivial Python
    # function per row costs on the same rows (persisted once for both)
    fields = fx.fields(spark, SF_DIR)
    fcopies = written(fields.withColumn("_copy", F.explode(F.sequence(F.lit(1), F.lit(REPLICAS))))
                      .drop("_copy"), "fields").persist()
    n_fields = fcopies.count()
    native = V.validate_fields(fcopies).select("email_id", "sap_id_valid", "name_valid",
                                              "email_valid", "phone_valid", "normalized_sap_id",
                                              "normalized_name", "normalized_phone", "error_list")
    n_vowels = F.udf(lambda s: sum(ch in "aeiou" for ch in s or ""), "int")
    python = fcopies.select("email_id", n_vowels("contact_name").alias("n_vowels"))
    for df in (native, python):  # warm-up: JIT of the generated code / start of the Python workers
        run(df)
    t_native = min(timed(lambda: run(native)), timed(lambda: run(native)))
    t_python = min(timed(lambda: run(python)), timed(lambda: run(python)))
    results[f"validate_native_x{REPLICAS}"] = t_native
    results[f"trivial_python_udf_x{REPLICAS}"] = t_python

    # lookup join on the replicated fields: as AQE decides by size, and with broadcasts off
    from contactlane.operators import directory as Dir
    from contactlane.operators import queue as Q
    validated = V.validate_fields(fcopies)
    directory = QS.directory(spark, SF_DIR)
    results[f"lookup_x{REPLICAS}"] = timed(lambda: run(
        Dir.with_directory_flag(validated, directory).groupBy("sap_exists").count()))
    saved = {k: spark.conf.get(k, None) for k in ("spark.sql.autoBroadcastJoinThreshold",
                                            "spark.sql.adaptive.autoBroadcastJoinThreshold")}
    for k in saved:
        spark.conf.set(k, "-1")
    results[f"lookup_shuffled_x{REPLICAS}"] = timed(lambda: run(
        Dir.with_directory_flag(validated, directory)
        .groupBy("sap_exists").count()))
    for k, v in saved.items():
        if v is None:
            spark.conf.unset(k)
        else:
            spark.conf.set(k, v)

    fcopies.unpersist()

    # pending anti-join + KPI while the action log grows k-fold (2M rows at sf0.1)
    queue = tables.materialize(QS.queue_extracted(spark, SF_DIR), "bench-queue")
    actions = fx.actions(spark, SF_DIR)
    grown = actions.withColumn("_copy", F.explode(F.sequence(F.lit(1), F.lit(REPLICAS)))).drop("_copy")
    results["pending_kpi_actions_x1"] = timed(lambda: run(Q.kpi_counts(Q.pending(queue, actions))))
    results[f"pending_kpi_actions_x{REPLICAS}"] = timed(
        lambda: run(Q.kpi_counts(Q.pending(queue, grown))))

    headline_total = round(sum(results[n] for n in HEADLINE), 3)
    out = {
        "metric": "headline_queries_total",
        "value": headline_total,
        "unit": "sec",
        "queries": results,
        "sf": os.path.basename(SF_DIR.rstrip("/")).replace("sf", ""),
        "cold_queries": cold,
        "cold_total": round(sum(cold.values()), 3),
        "cpus": CPUS,
        "intake_rows": n_rows,
        "intake_rows_per_sec": round(n_rows / max(results[f"intake_x{REPLICAS}"], 1e-9)),
        "validate_rows": n_fields,
        "validate_native_rows_per_sec": round(n_fields / max(t_native, 1e-9)),
        "trivial_python_udf_rows_per_sec": round(n_fields / max(t_python, 1e-9)),
    }
    print(json.dumps(out))
    spark.stop()


def routing_summary(queue):
    from contactlane.operators import routing as G

    return G.routing_summary(queue)


if __name__ == "__main__":
    main()

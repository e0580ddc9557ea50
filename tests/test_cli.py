"""The command-line jobs, run in-process on the test session."""
import os

from conftest import SF001
from contactlane import cli
from contactlane.sources import fixtures as fx


def test_cli_end_to_end(spark, tmpdir_path):
    d = lambda *p: os.path.join(tmpdir_path, *p)
    fx.emails(spark, SF001).select("email_id", "sender", "body", "sap_id").write.parquet(d("emails"))
    fx.directory_ids(spark, SF001).write.parquet(d("ids"))
    stamp = ["--as-of", "2024-01-01 00:00:00"]
    assert cli.main(stamp + ["directory", "--ids", d("ids"), "--out", d("directory")],
                    spark)["rows"] == 145
    out = cli.main(stamp + ["intake", "--emails", d("emails"), "--directory", d("directory"),
                            "--out", d("queue")], spark)
    assert (out["rows"], out["PASS"], out["NEEDS_REVIEW"], out["FAIL"]) == (150, 36, 1, 113)
    db = "cli_" + os.path.basename(tmpdir_path).replace("-", "_")
    spark.sql(f"CREATE DATABASE IF NOT EXISTS {db}")
    review = ["review", "--queue", d("queue"), "--emails", d("emails"), "--warehouse", d("wh"),
              "--database", db, "--actor", "rev@example.com"]
    assert cli.main(stamp + review, spark) == {"command": "review", "confirm": 36, "followup": 114}
    assert cli.main(stamp + review, spark) == {"command": "review"}
    kpi = cli.main(stamp + ["report", "kpi", "--queue", d("queue"), "--warehouse", d("wh"),
                            "--database", db, "--out", d("kpi")], spark)
    assert kpi["rows"] == 1
    assert spark.read.parquet(d("kpi")).first()["total"] == 0
    audit = cli.main(stamp + ["report", "audit", "--warehouse", d("wh"), "--database", db,
                              "--out", d("audit"), "--format", "csv", "--limit", "10"], spark)
    assert audit["rows"] == 10


def test_cli_reports(spark, tmpdir_path):
    d = lambda *p: os.path.join(tmpdir_path, *p)
    fx.emails(spark, SF001).select("email_id", "sender", "body", "sap_id").write.parquet(d("emails"))
    fx.directory_ids(spark, SF001).write.parquet(d("ids"))
    stamp = ["--as-of", "2024-01-01 00:00:00"]
    cli.main(stamp + ["directory", "--ids", d("ids"), "--out", d("directory")], spark)
    cli.main(stamp + ["intake", "--emails", d("emails"), "--directory", d("directory"),
                      "--out", d("queue")], spark)
    db = "clirep_" + os.path.basename(tmpdir_path).replace("-", "_")
    spark.sql(f"CREATE DATABASE IF NOT EXISTS {db}")
    common = ["--warehouse", d("wh"), "--database", db]
    pend = cli.main(stamp + ["report", "pending", "--queue", d("queue"), *common, "--out", d("p"),
                             "--search", "SAP00001", "--limit", "5"], spark)
    assert pend["rows"] == 5
    cli.main(stamp + ["review", "--queue", d("queue"), "--emails", d("emails"), *common,
                      "--actor", "rev@example.com"], spark)
    assert cli.main(stamp + ["report", "followups", *common, "--out", d("f"), "--limit", "7"],
                    spark)["rows"] == 7
    turn = cli.main(stamp + ["report", "turnaround", "--queue", d("queue"), *common,
                             "--out", d("t")], spark)
    assert turn["rows"] == 3
    assert spark.read.parquet(d("t")).agg({"n_actioned": "sum"}).first()[0] == 150

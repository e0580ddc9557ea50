"""Registered SQL functions agree with the DataFrame path."""
from conftest import SF001
from contactlane.functions.sqlfuncs import register_functions
from contactlane.plans import composed_sql
from contactlane.plans import queries as QS
from contactlane.sources import fixtures as fx


def test_routing_function_cases(spark):
    spark.createDataFrame([("SAP000001",)], "sap_id string").createOrReplaceTempView("t_dir")
    register_functions(spark, "t_dir", prefix="t_")
    r = spark.sql("""SELECT t_route_validation(true, true, true, true, true) AS p,
                            t_route_validation(true, true, true, true, false) AS r,
                            t_route_validation(false, true, true, true, true) AS f,
                            t_route_validation(true, true, true, true, NULL) AS n,
                            t_sap_exists('sap000001') AS e1, t_sap_exists(NULL) AS e2,
                            t_sap_exists('SAP000002') AS e3""").collect()[0]
    assert (r["p"]["validation_status"], r["p"]["queue_type"]) == ("PASS", "quick_approval")
    assert (r["r"]["validation_status"], r["r"]["queue_type"]) == ("NEEDS_REVIEW", "detailed_review")
    assert r["f"]["validation_status"] == "FAIL" and r["n"]["validation_status"] == "FAIL"
    assert (r["e1"], r["e2"], r["e3"]) == (True, False, False)
    v = spark.sql("""SELECT t_validate_phone('555-123-4567') AS ph, t_validate_email(' a@b.co ') AS em,
                            t_validate_name('mary-jane o''brien') AS nm, t_validate_sap_id('sap123456') AS id,
                            t_extract_email('Hello Name: John Smith SAP ID: SAP123456 Email: j@x.com Phone: 555-123-4567 Thank you!') AS ex
                  """).collect()[0]
    assert v["ph"]["normalized"] == "(555) 123-4567" and v["em"]["is_valid"]
    assert v["nm"]["normalized"] == "Mary-Jane O'Brien" and v["id"]["normalized"] == "SAP123456"
    assert (v["ex"]["contact_name"], v["ex"]["sap_id"], v["ex"]["contact_email"],
            v["ex"]["contact_phone"], v["ex"]["request_type"]) == (
        "John Smith", "SAP123456", "j@x.com", "555-123-4567", "account_update")


def test_composed_statement_equals_dataframe_path(spark):
    sql_rows = composed_sql.review_records(spark, fx.emails(spark, SF001), QS.directory(spark, SF001))
    cols = sql_rows.columns
    df_rows = QS.queue_extracted(spark, SF001).select(*cols)
    a = sorted(tuple(r) for r in sql_rows.collect())
    b = sorted(tuple(r) for r in df_rows.collect())
    assert a == b and len(a) == 150


def test_sql_validators_on_null_and_blank(spark):
    spark.createDataFrame([("SAP000001",)], "sap_id string").createOrReplaceTempView("t_dir2")
    register_functions(spark, "t_dir2", prefix="u_")
    r = spark.sql("""SELECT u_validate_email(NULL) AS e, u_validate_phone('   ') AS p,
                            u_validate_sap_id('') AS s, u_validate_name(NULL) AS n,
                            u_extract_email(NULL) AS x""").collect()[0]
    assert (r.e.is_valid, r.e.error) == (False, "Email is empty")
    assert (r.p.is_valid, r.p.normalized, r.p.error) == (False, None, "Phone is empty")
    assert (r.s.is_valid, r.s.error) == (False, "SAP ID is empty")
    assert (r.n.is_valid, r.n.error) == (False, "Name is empty")
    assert r.x.error == "no_response" and r.x.request_type == "account_update"

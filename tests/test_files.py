"""CSV and table input and output."""

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidewatch import schemas as S
from tidewatch.plans import contracts, exports
from tidewatch.sources import files


def test_text_with_quotes_and_line_breaks_survives(spark, tmp_path):
    texts = ['said "ok"', "two\nlines", "comma, here", None, "", "back\\slash", 'ends with "']
    rows = [(f"r{i}", "o", 5, t, "d") for i, t in enumerate(texts)]
    path = str(tmp_path / "reviews")
    files.write_csv(spark.createDataFrame(rows, S.REVIEWS), path)
    again = files.read_csv(spark, path, S.REVIEWS, line_breaks=True).orderBy("review_id").collect()
    assert [r.review_comment_message for r in again] == texts


def test_columns_are_found_by_name(spark, tmp_path):
    (tmp_path / "c.csv").write_text("extra,customer_state,customer_id\n1,SP,c1\n2,,c2\n")
    rows = files.read_csv(spark, str(tmp_path / "c.csv"), S.CUSTOMERS).collect()
    assert [(r.customer_id, r.customer_state) for r in rows] == [("c1", "SP"), ("c2", None)]
    with pytest.raises(ValueError, match="order_status"):
        files.read_csv(spark, str(tmp_path / "c.csv"), S.ORDERS)


def test_byte_order_mark_and_broken_utf8(spark, tmp_path):
    path = tmp_path / "t.csv"
    path.write_bytes(b"\xef\xbb\xbfproduct_category_name,product_category_name_english\nbeb\xe9s,baby\n")
    row = files.read_csv(spark, str(path), S.TRANSLATION).first()
    assert row.product_category_name == "beb�s" and row.product_category_name_english == "baby"


def test_header_inference_and_existence(spark, tmp_path):
    (tmp_path / "x.csv").write_text("a,b\n1,2.5\n")
    path = str(tmp_path / "x.csv")
    assert files.header_of(spark, path) == ["a", "b"]
    assert [f.dataType for f in files.read_csv_inferred(spark, path).schema] == [T.IntegerType(), T.DoubleType()]
    assert files.file_exists(spark, path) and not files.file_exists(spark, path + ".not")


def test_tables_are_replaced_and_guarded(spark):
    files.create_database(spark, "files_db")
    files.replace_table(spark.range(3), "files_db.numbers")
    assert files.replace_table(spark.range(5), "files_db.numbers").count() == 5
    assert files.table_names(spark, "files_db") == ["numbers"]
    assert files.require_table(spark, "files_db.numbers", "job").count() == 5
    assert files.table_if_exists(spark, "files_db.nothing") is None
    with pytest.raises(RuntimeError, match="run make_it first"):
        files.require_table(spark, "files_db.nothing", "make_it")


def test_a_failed_replacement_leaves_the_table(spark):
    files.create_database(spark, "swap_db")
    files.replace_table(spark.range(4).withColumn("a", F.lit("old")), "swap_db.t")
    breaks = F.when(F.col("id") == 70, F.raise_error(F.lit("broken row"))).otherwise(F.lit("new"))
    with pytest.raises(Exception, match="broken row"):
        files.replace_table(spark.range(100).withColumn("a", breaks), "swap_db.t")
    assert [r.a for r in spark.table("swap_db.t").collect()] == ["old"] * 4
    assert files.table_names(spark, "swap_db") == ["t"]
    # Other columns than before, and rows read from the table itself.
    own = spark.table("swap_db.t").select((F.col("id") + 1).alias("next"))
    assert sorted(r.next for r in files.replace_table(own, "swap_db.t").collect()) == [1, 2, 3, 4]
    assert files.table_names(spark, "swap_db") == ["t"] and spark.table("swap_db.t").columns == ["next"]


def test_export_contract_checks(spark, tmp_path):
    contract = [contracts.ExportContract("out.csv", 2, ("a", "c"))]
    missing = contracts.export_report(spark, str(tmp_path), contract).collect()
    assert [(r.check, r.status) for r in missing] == [("File exists", "FAIL")]
    frame = spark.range(1).select(F.col("id").alias("a"), F.lit(None).cast("string").alias("b"))
    files.write_csv(frame, str(tmp_path / "out.csv"), single_file=True)
    found = {r.check: (r.status, r.detail) for r in contracts.export_report(spark, str(tmp_path), contract).collect()}
    assert found["File exists"][0] == "PASS"
    assert found["Row count >= 2"] == ("FAIL", "Got 1")
    assert found["Required columns present"] == ("FAIL", "Missing: ['c']")
    assert found["No fully-null columns"] == ("WARN", "Empty cols: b")


def test_column_listing(spark, tmp_path):
    written = exports.export_tables({"fct_server_health": spark.range(2).selectExpr("id AS x", "id AS y")}, str(tmp_path))
    rows = exports.column_listing(spark, written).orderBy("position").collect()
    assert [(r.file, r.column) for r in rows] == [("fct_server_health.csv", "x"), ("fct_server_health.csv", "y")]

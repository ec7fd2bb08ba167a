from __future__ import annotations

import pytest
from pyspark.sql import types as T
from samples import catalog, sales

from tillstar import schemas
from tillstar.operators import gates
from tillstar.plans import report
from tillstar.sources import audit, delimited, sinks

HEADER = "product_id,product_name,category,price\n"


def write(path, text):
    path.mkdir()
    (path / "part.csv").write_text(text)
    return str(path)


def test_typed_read(spark, rows, tmp_path):
    path = write(tmp_path / "in", HEADER + '1,"a, b",c,1.5\n2,"q\\"q",,x\n007, ,c,\n')
    df = delimited.read_delimited(spark, path, schemas.CATALOG)
    assert schemas.shape(df.schema) == schemas.shape(schemas.CATALOG)
    assert rows(df) == [(1, "a, b", "c", 1.5), (2, 'q"q', None, None), (7, " ", "c", None)]


def test_violations_are_counted(spark, rows, tmp_path):
    path = write(tmp_path / "in", HEADER + "1,a,c,1.5\nz,a,c,x\n3,a,c,2,9,9\n")
    text = delimited.read_text(spark, path, schemas.CATALOG)
    assert rows(delimited.contract_violations(text, schemas.CATALOG)) == [
        ("_corrupt_line", 1),
        ("price", 1),
        ("product_id", 1),
    ]


def test_wrong_header_is_refused(spark, tmp_path):
    path = write(tmp_path / "in", "product_id,name,category,price\n1,a,c,1\n")
    with pytest.raises(Exception, match="header"):
        delimited.read_delimited(spark, path, schemas.CATALOG).collect()


def test_missing_source_names_the_path(spark, tmp_path):
    with pytest.raises(Exception, match="no-such-place"):
        delimited.read_delimited(spark, f"{tmp_path}/no-such-place", schemas.CATALOG).collect()


def test_phone_keeps_its_leading_zero(spark, rows, tmp_path):
    sinks.write_table(sales(spark, {"phone": "0123456789"}), f"{tmp_path}/s", "csv")
    df = delimited.read_delimited(spark, f"{tmp_path}/s", schemas.SALES)
    assert rows(df, "phone") == [("0123456789",)]


def test_landing_lines_that_do_not_split_are_set_aside_whole(spark, rows, tmp_path):
    landing, raw = tmp_path / "landing", str(tmp_path / "raw")
    landing.mkdir()
    lines = [",".join(schemas.CATALOG.names), "1,Pen,Office,5", "2,Cup,Home,3,more", "3,Mug"]
    (landing / "a.csv").write_text("\n".join(lines) + "\n")
    delimited.landing_to_raw(spark, str(landing), raw, schemas.CATALOG)
    assert delimited.read_text(spark, raw, schemas.CATALOG).count() == 3
    aside = delimited.read_unsplit(spark, raw, schemas.CATALOG)
    assert rows(aside, delimited.CORRUPT) == [("2,Cup,Home,3,more",), ("3,Mug",)]


def test_a_raw_copy_still_knows_its_broken_lines(spark, rows, tmp_path):
    landing, raw = tmp_path / "landing", f"{tmp_path}/raw"
    text = "1;Pen;Office;5\n2;Cup;Home;3;more\n3;Mug\n1;Pen;Office;5\n2;Cup;Home;3\n"
    path = write(landing, HEADER.replace(",", ";") + text)
    for _ in range(2):
        delimited.landing_to_raw(spark, path, raw, schemas.CATALOG, sep=";")
    whole = delimited.read_raw(spark, raw, schemas.CATALOG)
    assert rows(whole) == rows(delimited.read_text(spark, path, schemas.CATALOG, sep=";"))
    assert rows(delimited.contract_violations(whole, schemas.CATALOG)) == [
        ("_corrupt_line", 2), ("price", 0), ("product_id", 0)
    ]
    # A later copy without broken lines leaves none behind, and a plain folder is read as it is.
    write(tmp_path / "clean", HEADER + "4,Jug,Home,1\n")
    delimited.landing_to_raw(spark, f"{tmp_path}/clean", raw, schemas.CATALOG)
    assert rows(delimited.read_raw(spark, raw, schemas.CATALOG)) == [("4", "Jug", "Home", "1", None)]
    assert delimited.read_raw(spark, f"{tmp_path}/clean", schemas.CATALOG).count() == 1


def test_landing_to_raw_keeps_text_as_it_is(spark, rows, tmp_path):
    landing = write(tmp_path / "in", 'product_id;product_name;category;price\n01;"a;b";  ;1.50\n2;say "x";c;\n')
    raw = f"{tmp_path}/raw"
    for _ in range(2):
        delimited.landing_to_raw(spark, landing, raw, schemas.CATALOG, sep=";")
    text = delimited.read_text(spark, raw, schemas.CATALOG).drop(delimited.CORRUPT)
    assert rows(text) == [("01", "a;b", "  ", "1.50"), ("2", 'say "x"', "c", None)]
    [file] = [f for f in (tmp_path / "raw").iterdir() if f.name.endswith(".csv")]
    assert file.read_text().splitlines()[:2] == [
        '"product_id","product_name","category","price"',
        '"01","a;b","  ","1.50"',
    ]


def test_line_breaks_inside_fields(spark, rows, tmp_path):
    path = write(tmp_path / "in", HEADER + '1,"a\nb",c,1\n')
    df = delimited.read_delimited(spark, path, schemas.CATALOG, multi_line=True)
    assert rows(df) == [(1, "a\nb", "c", 1.0)]


def test_csv_table_keeps_its_spaces_and_is_replaced(spark, rows, tmp_path):
    first = catalog(spark, (1, " a ", "c", 1.0), (2, "b", "c", 2.0))
    sinks.write_table(first, f"{tmp_path}/t", "csv")
    sinks.write_table(catalog(spark, (3, "  ", "c", 1.0)), f"{tmp_path}/t", "csv")
    df = spark.read.schema(schemas.CATALOG).option("header", True).csv(f"{tmp_path}/t")
    assert rows(df) == [(3, "  ", "c", 1.0)]


def test_table_is_written_by_all_tasks(spark, tmp_path):
    df = spark.range(0, 1000, numPartitions=4)
    sinks.write_table(df, f"{tmp_path}/t")
    assert len([f for f in (tmp_path / "t").iterdir() if f.name.startswith("part-")]) == 4
    sinks.write_table(df, f"{tmp_path}/small", rows_per_file=100)
    assert len([f for f in (tmp_path / "small").iterdir() if f.name.startswith("part-")]) == 12


def test_scratch_is_the_shared_folder(spark):
    root = spark.conf.get("spark.checkpoint.dir").rstrip("/")
    one, two = (sinks.scratch_path(spark, "x") for _ in range(2))
    assert one.startswith(f"{root}/tillstar/x-") and one != two
    stored = sinks.staged(spark, "test")(spark.range(3))
    assert stored.count() == 3 and root in stored.inputFiles()[0]


def test_schema_mismatch_names_the_columns(spark):
    df = catalog(spark, (1, "a", "c", 1.0))
    assert schemas.require_schema(df, schemas.CATALOG, "t") is df
    with pytest.raises(schemas.SchemaMismatch, match=r"t: expected 4 columns, found 3.*price"):
        schemas.require_schema(df.drop("price"), schemas.CATALOG, "t")
    with pytest.raises(schemas.SchemaMismatch, match="string"):
        schemas.require_schema(df.withColumn("price", df.price.cast("string")), schemas.CATALOG, "t")
    with pytest.raises(schemas.SchemaMismatch, match="order"):
        schemas.require_schema(df.select("price", *df.columns[:3]), schemas.CATALOG, "t")


def test_load_gate(spark):
    df = catalog(spark, (1, "a", "c", 1.0))
    gates.enforce(gates.load_gate(df, schemas.CATALOG, "catalog"))
    with pytest.raises(gates.GateFailure, match="catalog: rows: expected 1, found 0"):
        gates.enforce(gates.load_gate(df.limit(0), schemas.CATALOG, "catalog"))
    with pytest.raises(gates.GateFailure, match="catalog: columns: expected 4, found 3"):
        gates.enforce(gates.load_gate(df.drop("price"), schemas.CATALOG, "catalog"))


def test_audit_lines_add_up(spark, tmp_path):
    for run in ("a", "b"):
        audit.append_run(spark, f"{tmp_path}/audit", "p", audit.SUCCEEDED, run)
    lines = audit.read_runs(spark, f"{tmp_path}/audit").orderBy("run_id").collect()
    assert [(r["pipeline_name"], r["status"], r["run_id"]) for r in lines] == [
        ("p", "Succeeded", "a"),
        ("p", "Succeeded", "b"),
    ]
    assert isinstance(audit.schemas.AUDIT["time"].dataType, T.TimestampType)
    assert all(r["time"] is not None for r in lines)


def test_reports_run(spark):
    products = catalog(spark, (100, "Pen", "Office", 5.0), (101, "Cup", "Home", 2.0))
    df = sales(spark, {}, {"transaction_id": 1, "payment_status": "FAILED"}, {"customer_id": 11})
    found = report.sales_report(df, products)
    assert found["conflicting_rows"].count() == 3
    assert found["shared_names"].count() == 2
    found.update(report.catalog_report(products))
    for name, part in found.items():
        part.collect()
        assert part.columns, name

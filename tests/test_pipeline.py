from __future__ import annotations

from pathlib import Path

import pytest
from samples import GOOD

from tillstar import schemas
from tillstar.operators import gates
from tillstar.plans import pipeline, star
from tillstar.sources import audit, delimited, published


def csv_line(row):
    return ",".join("" if v is None else str(v) for v in row)


@pytest.fixture
def place(tmp_path):
    """Writes the three raw sources; ``changes`` are per source lists of row changes."""

    def build(products, **sources):
        paths = {}
        for name, changes in sources.items():
            folder = tmp_path / name
            folder.mkdir()
            lines = [csv_line({**GOOD, **c}[n] for n in schemas.SALES.names) for c in changes]
            (folder / "data.csv").write_text("\n".join([csv_line(schemas.SALES.names), *lines]) + "\n")
            paths[name] = str(folder)
        (tmp_path / "catalog").mkdir()
        (tmp_path / "catalog" / "data.csv").write_text(
            "\n".join([csv_line(schemas.CATALOG.names), *map(csv_line, products)]) + "\n"
        )
        return paths, str(tmp_path / "catalog"), str(tmp_path / "out")

    return build


PRODUCTS = [(100, "Pen", "Office", 5.0), (101, "Cup", "Home", 2.0)]


def audit_lines(spark, target):
    return [(r["run_id"], r["status"]) for r in audit.read_runs(spark, f"{target}/run_audit").collect()]


@pytest.mark.parametrize("fmt", ["parquet", "csv"])
def test_run(spark, rows, place, fmt):
    paths, catalog, target = place(
        PRODUCTS,
        one=[{}, {}, {"transaction_id": 2, "quantity": -1}, {"transaction_id": 3, "city": "  "}],
        two=[{}, {"transaction_id": 4, "email": "nope", "transaction_date": "25-01-2024"}],
    )
    pipeline.run(spark, paths, catalog, target, pipeline.Options(fmt=fmt), run_id="r1")

    def table(name, schema):
        return published.read(spark, target, name, schema)

    fact = table("fact_sales", schemas.FACT_SALES)
    assert rows(fact, "transaction_id", "valid_quantity") == [
        (1, "Valid"),
        (1, "Valid"),
        (2, "Invalid"),
        (4, "Valid"),
    ]
    assert table("dim_customer", schemas.DIM_CUSTOMER).count() == 2
    assert rows(table("dim_product", schemas.DIM_PRODUCT)) == PRODUCTS
    assert audit_lines(spark, target) == [("r1", "Succeeded")]


def test_findings_and_rejects_are_kept(spark, rows, place):
    paths, catalog, target = place(
        PRODUCTS,
        one=[{}, {"city": "  "}, {"transaction_date": "03-04-2024"}],
        two=[{}, {"transaction_date": "abc"}, {"quantity": "two"}],
    )
    pipeline.run(spark, paths, catalog, target, run_id="r1")
    assert rows(spark.read.parquet(f"{target}/run_findings"), "finding", "row_count") == [
        ("ambiguous_dates", 1),
        ("lost:quantity", 1),
        ("rejected_contacts", 0),
        ("rejected_rows", 2),
        ("unreadable_dates", 1),
    ]
    rejected = published.read(spark, target, "rejected_sales", schemas.REJECTED_SALES)
    assert rows(rejected, "src", "reject_reason") == [("one", "blank:city"), ("two", "null:quantity")]


def test_strict_run_refuses_lost_values(spark, place):
    paths, catalog, target = place(PRODUCTS, one=[{}], two=[{}, {"quantity": "two"}])
    with pytest.raises(gates.GateFailure, match="values lost in quantity: expected 0, found 1"):
        pipeline.run(spark, paths, catalog, target, pipeline.Options(strict=True))


def test_values_and_lines_that_do_not_fit_are_found_and_kept(spark, rows, place):
    paths, catalog, target = place(PRODUCTS, one=[{}, {"price": "abc"}], two=[{}, {"email": "no"}])
    with open(f"{paths['two']}/data.csv", "a") as raw:
        raw.write(csv_line([*[GOOD[n] for n in schemas.SALES.names], "seventeenth"]) + "\n7,8\n")
    pipeline.run(spark, paths, catalog, target, run_id="r1")
    found = dict(rows(spark.read.parquet(f"{target}/run_findings"), "finding", "row_count"))
    assert found["lost:price"] == 1 and found["lost:_corrupt_line"] == 2
    assert found["rejected_contacts"] == 2
    lost = rows(published.read(spark, target, "lost_values", schemas.LOST_VALUES))
    assert ("one", "price", "abc") in lost and ("two", "_corrupt_line", "7,8") in lost
    assert any(v.endswith("seventeenth") for _, _, v in lost)


def test_a_row_lost_in_a_stored_part_stops_the_run(spark, place, monkeypatch):
    paths, catalog, target = place(PRODUCTS, one=[{}], two=[{}, {"transaction_id": 2}])
    store = pipeline.materialise

    def losing(df, path):
        return store(df.limit(1) if path.endswith("sales-1") else df, path)

    monkeypatch.setattr(pipeline, "materialise", losing)
    with pytest.raises(gates.GateFailure, match="rows of two stored: expected 2, found 1"):
        pipeline.run(spark, paths, catalog, target)


def scratch_files(spark):
    root = spark.conf.get("spark.checkpoint.dir")
    return {str(f) for f in Path(root).rglob("*.parquet")}


def test_failure_leaves_published_tables_and_no_scratch(spark, place, monkeypatch):
    paths, catalog, target = place(PRODUCTS, one=[{}], two=[{"transaction_id": 2}])
    before = scratch_files(spark)
    pipeline.run(spark, paths, catalog, target)
    assert scratch_files(spark) == before

    def broken(*_):
        raise RuntimeError("stopped")

    monkeypatch.setattr(pipeline, "build_fact", broken)
    monkeypatch.setattr(star, "dim_product", lambda catalog: catalog.limit(0))
    with pytest.raises(Exception):
        pipeline.run(spark, paths, catalog, target)
    assert published.read(spark, target, "dim_product", schemas.DIM_PRODUCT).count() == 2
    assert published.read(spark, target, "fact_sales", schemas.FACT_SALES).count() == 2
    assert scratch_files(spark) == before
    assert len(list(Path(target).glob("_runs/*"))) == 1


def test_run_again_replaces_tables_and_adds_an_audit_line(spark, place):
    paths, catalog, target = place(PRODUCTS, one=[{}], two=[{}])
    options = pipeline.Options(across_sources=True, partition_fact_by=["payment_status"])
    for run in ("r1", "r2"):
        pipeline.run(spark, paths, catalog, target, options, run_id=run)
    assert published.read(spark, target, "fact_sales", schemas.FACT_SALES).count() == 2
    assert published.read(spark, target, "dim_customer", schemas.DIM_CUSTOMER).count() == 1
    assert sorted(audit_lines(spark, target)) == [("r1", "Succeeded"), ("r2", "Succeeded")]


@pytest.mark.parametrize(
    "products, sources, message",
    [
        (PRODUCTS, {"one": [{}], "two": []}, "transactions: rows of two: expected 1, found 0"),
        ([], {"one": [{}], "two": [{}]}, "catalog: rows: expected 1, found 0"),
        (
            [*PRODUCTS, (102, "Mug", "Home", None)],
            {"one": [{}], "two": [{}]},
            "products: rows kept: expected 3, found 2",
        ),
        (
            [*PRODUCTS, PRODUCTS[0]],
            {"one": [{}], "two": [{}]},
            "products: rows kept: expected 3, found 2",
        ),
        (
            PRODUCTS,
            {"one": [{}], "two": [{"email": "nope"}]},
            "customers: rows of two: expected 1, found 0",
        ),
        (
            PRODUCTS,
            {"one": [{}], "two": [{}, {"city": "  "}, {"quantity": None}][1:]},
            "customers|sales: rows of two: expected 1, found 0",
        ),
    ],
)
def test_a_broken_gate_ends_the_run_and_is_recorded(spark, place, products, sources, message):
    paths, catalog, target = place(products, **sources)
    with pytest.raises(gates.GateFailure, match=message):
        pipeline.run(spark, paths, catalog, target, run_id="bad")
    assert audit_lines(spark, target) == [("bad", "Failed")]


@pytest.mark.parametrize("fmt", ["parquet", "csv"])
def test_reporting(spark, rows, place, fmt):
    paths, catalog, target = place(
        PRODUCTS, one=[{}], two=[{"transaction_id": 2, "product_id": 101, "transaction_date": "01-08-2024"}]
    )
    options = pipeline.Options(fmt=fmt)
    pipeline.run(spark, paths, catalog, target, options)
    pipeline.publish_reporting(spark, target, options)

    def table(name, schema):
        return published.read(spark, target, name, schema)

    days = table("dim_date", "date date, date_id int, year int, month int, day int")
    assert rows(days, "date_id") == [(20240105,), (20240106,), (20240107,), (20240108,)]
    total = table("kpi_summary", "revenue double, orders long, avg_order_value double")
    assert rows(total) == [(14.0, 2, 7.0)]
    assert table("kpi_by_month", "month string").count() >= 1


def test_reporting_refuses_repeated_products(spark, place):
    paths, catalog, target = place([*PRODUCTS, (100, "Pen", "Office", 6.0)], one=[{}], two=[{}])
    pipeline.run(spark, paths, catalog, target)
    with pytest.raises(gates.GateFailure, match="repeated product_id: expected 0, found 1"):
        pipeline.publish_reporting(spark, target)


def test_a_missing_source_is_recorded(spark, place):
    paths, catalog, target = place(PRODUCTS, one=[{}])
    with pytest.raises(Exception, match="nowhere"):
        pipeline.run(spark, {**paths, "two": f"{target}/nowhere"}, catalog, target, run_id="bad")
    assert audit_lines(spark, target) == [("bad", "Failed")]


def test_raw_copy_feeds_the_run(spark, place, tmp_path):
    paths, catalog, target = place(PRODUCTS, one=[{}], two=[{"transaction_id": 9}])
    raw = {name: f"{tmp_path}/raw/{name}" for name in paths}
    for name, landing in paths.items():
        delimited.landing_to_raw(spark, landing, raw[name], schemas.SALES)
    pipeline.run(spark, raw, catalog, target)
    assert published.read(spark, target, "fact_sales", schemas.FACT_SALES).count() == 2


def star_of(spark, target):
    return {
        name: published.read(spark, target, name, schema).count()
        for name, schema in (
            ("dim_product", schemas.DIM_PRODUCT),
            ("dim_customer", schemas.DIM_CUSTOMER),
            ("fact_sales", schemas.FACT_SALES),
        )
    }


@pytest.mark.parametrize("step", ["build_products", "build_customers", "build_fact", "record_findings"])
def test_a_stop_between_two_tables_leaves_the_old_set_whole(spark, place, monkeypatch, step):
    paths, catalog, target = place(PRODUCTS, one=[{}], two=[{"transaction_id": 2, "customer_id": 11}])
    pipeline.run(spark, paths, catalog, target, run_id="r1")
    before = star_of(spark, target)
    opened = published.read(spark, target, "fact_sales", schemas.FACT_SALES)
    more = csv_line({**GOOD, "transaction_id": 3, "customer_id": 12}[n] for n in schemas.SALES.names)
    with open(f"{paths['two']}/data.csv", "a") as raw:
        raw.write(more + "\n")
    done = getattr(pipeline, step)

    def stopped(*args):
        done(*args)
        raise RuntimeError("stopped")

    monkeypatch.setattr(pipeline, step, stopped)
    with pytest.raises(RuntimeError, match="stopped"):
        pipeline.run(spark, paths, catalog, target, run_id="r2")
    assert star_of(spark, target) == before
    monkeypatch.setattr(pipeline, step, done)
    pipeline.run(spark, paths, catalog, target, run_id="r2")
    assert star_of(spark, target)["fact_sales"] == before["fact_sales"] + 1
    assert opened.count() == before["fact_sales"]  # a reader of the old set is not disturbed
    assert sorted(audit_lines(spark, target)) == [("r1", "Succeeded"), ("r2", "Failed"), ("r2", "Succeeded")]


def test_a_run_id_used_again_leaves_one_set_of_findings(spark, rows, place):
    paths, catalog, target = place(PRODUCTS, one=[{}, {"city": "  "}], two=[{}])
    for run_id in ("7", "7", "8"):
        pipeline.run(spark, paths, catalog, target, run_id=run_id)
    found = audit.read_findings(spark, f"{target}/run_findings")
    assert rows(found.filter("finding = 'rejected_rows'"), "run_id", "row_count") == [("7", 1), ("8", 1)]
    assert [s for _, s in audit_lines(spark, target)] == ["Succeeded"] * 3


def test_old_folders_go_and_other_tables_stay(spark, place):
    paths, catalog, target = place(PRODUCTS, one=[{}], two=[{}])
    pipeline.run(spark, paths, catalog, target)
    pipeline.publish_reporting(spark, target)
    for _ in range(published.KEPT_VERSIONS):
        pipeline.run(spark, paths, catalog, target)
    # The newest sets, and the indicators that no newer run has replaced.
    assert len(list(Path(target).glob("_runs/*"))) == published.KEPT_VERSIONS + 1
    assert published.read(spark, target, "kpi_summary", "revenue double").count() == 1
    with pytest.raises(LookupError, match="no published table nothing"):
        published.read(spark, target, "nothing", "a int")


def test_a_run_over_raw_finds_what_a_run_over_landing_finds(spark, rows, place, tmp_path):
    paths, catalog, target = place(PRODUCTS, one=[{}, {"price": "abc"}], two=[{}])
    with open(f"{paths['two']}/data.csv", "a") as landing:
        landing.write(csv_line([*[GOOD[n] for n in schemas.SALES.names], "seventeenth"]) + "\n7,8\n")
    raw = {name: f"{tmp_path}/raw/{name}" for name in paths}
    for name, landing in paths.items():
        delimited.landing_to_raw(spark, landing, raw[name], schemas.SALES)
    pipeline.run(spark, paths, catalog, target)
    pipeline.run(spark, raw, catalog, f"{target}-raw")
    for name, schema in (("lost_values", schemas.LOST_VALUES), ("fact_sales", schemas.FACT_SALES)):
        assert rows(published.read(spark, f"{target}-raw", name, schema)) == rows(
            published.read(spark, target, name, schema)
        )
    lost = published.read(spark, f"{target}-raw", "lost_values", schemas.LOST_VALUES)
    assert ("two", "_corrupt_line", "7,8") in rows(lost)

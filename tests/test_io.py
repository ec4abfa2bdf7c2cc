from __future__ import annotations

import csv
from datetime import date, datetime
from decimal import Decimal
from pathlib import Path

import pytest
from pyspark.errors import PySparkException
from pyspark.sql import functions as F

from dispatchlens.operators.constraints import Lengths
from dispatchlens.plans import gate, reports, shared, store, versions
from dispatchlens.plans.analysis import Analysis
from dispatchlens.plans.session import recommended_options
from dispatchlens.schemas import CLEAN_TABLES, KEYS, RAW_COLUMNS
from dispatchlens.sources import csv_files, sinks, star_schema

from __spark_entry__ import SETTINGS
from tests.helpers import text_table

SF = "/root/testdata/sf0.001"
ANY = Lengths(None, None)


def write(path: Path, rows: list[list[str]]) -> str:
    with path.open("w", newline="", encoding="utf-8") as out:
        csv.writer(out).writerows(rows)
    return str(path)


def lines_of(folder) -> list[str]:
    parts = sorted(Path(folder).glob("part-*.csv"))
    assert len(parts) == 1
    return parts[0].read_text(encoding="utf-8").splitlines()


def test_records_may_span_lines(spark, tmp_path):
    header = RAW_COLUMNS["reviews"]
    body = [
        ["r1", "o1", "5", "good", 'first line\nsecond "line"\n\nlast, line', "2018-01-01", "2018-01-02"],
        ["r2", "o2", "1", "", "", "2018-01-01", "2018-01-02"],
    ]
    path = write(tmp_path / "reviews.csv", [header, *body])
    reviews = csv_files.load_raw(spark, "reviews", path)
    assert csv_files.count_records(reviews) == 2
    assert reviews.orderBy("review_id").first().review_comment_message == body[0][4]
    assert {f.dataType.simpleString() for f in reviews.schema.fields} == {"string"}


def test_columns_come_in_contract_order(spark, tmp_path):
    header = list(reversed(RAW_COLUMNS["sellers"]))
    path = write(tmp_path / "sellers.csv", [header, ["SP", "town", "00123", "s1"]])
    row = csv_files.load_raw(spark, "sellers", path).first()
    assert tuple(row) == ("s1", "00123", "town", "SP")


def test_all_source_problems_are_reported_together(spark, tmp_path):
    sellers = RAW_COLUMNS["sellers"]
    paths = {
        "sellers": write(tmp_path / "a.csv", [[*sellers[:-1], "state"], ["s", "1", "t", "SP"]]),
        "payments": write(tmp_path / "b.csv", [["order_id", "order_id"], ["1", "2"]]),
        "orders": str(tmp_path / "nowhere.csv"),
        "customers": write(tmp_path / "c.csv", [RAW_COLUMNS["customers"], ["1", "2", "3", "4", "5"]]),
    }
    frames, problems = csv_files.load_all(spark, paths)
    assert list(frames) == ["customers"]
    found = {
        (r.table_name, r.column_name, r.problem.split(" ")[-1])
        for r in csv_files.problems_frame(spark, problems).collect()
    }
    assert found == {
        ("sellers", "seller_state", "missing"), ("sellers", "state", "unexpected"),
        ("payments", None, "name"), ("orders", None, "found"),
    }
    with pytest.raises(csv_files.HeaderError, match="state unexpected"):
        csv_files.load_raw(spark, "sellers", paths["sellers"])
    (tmp_path / "empty.csv").write_text("")
    with pytest.raises(csv_files.HeaderError, match="empty"):
        csv_files.read_header(spark, str(tmp_path / "empty.csv"))


def test_every_file_of_a_table_must_have_the_header(spark, tmp_path):
    folder = tmp_path / "sellers"
    folder.mkdir()
    header = RAW_COLUMNS["sellers"]
    write(folder / "1.csv", [header, ["s1", "1", "t", "SP"]])
    write(folder / "2.csv", [list(reversed(header)), ["SP", "t", "1", "s2"]])
    with pytest.raises(Exception, match="header does not conform"):
        csv_files.load_raw(spark, "sellers", str(folder)).collect()


def test_value_texts(spark, tmp_path):
    frame = spark.createDataFrame(
        [(1, None, True, date(2018, 1, 2), Decimal("0.000001"), 'say "hi"')],
        "i int, n string, b boolean, d date, x decimal(14,6), s string",
    ).withColumn("t", F.lit(datetime(2018, 1, 2, 3, 4, 5)).cast("timestamp_ntz"))
    sinks.write_csv(frame.coalesce(1), str(tmp_path / "out"))
    assert lines_of(tmp_path / "out") == [
        "i,n,b,d,x,s,t", '1,,true,2018-01-02,0.000001,"say ""hi""",2018-01-02 03:04:05',
    ]


def test_clean_csv_reads_back_as_the_same_table(spark, tmp_path):
    analysis = Analysis(star_schema.load(spark, SF), SETTINGS, star_schema.MANUAL_TRANSLATIONS)
    sinks.write_csv(analysis.order_items, str(tmp_path / "items"))
    schema = CLEAN_TABLES["order_items"]
    text = csv_files.read_text(spark, str(tmp_path / "items"), schema.fieldNames(), False)
    back = sinks.conform(text, schema, "order_items")
    wanted = sinks.conform(analysis.order_items.select(*schema.fieldNames()), schema, "order_items")
    assert back.exceptAll(wanted).isEmpty() and wanted.exceptAll(back).isEmpty()


def test_conform_refuses_what_does_not_fit(spark):
    schema = CLEAN_TABLES["sellers"]
    good = text_table(spark, "sellers", [
        {"seller_id": "s", "seller_zip_code_prefix": "12", "seller_city": "t", "seller_state": "SP"}
    ])
    row = sinks.conform(good, schema, "sellers").first()
    assert row.seller_zip_code_prefix == 12
    for bad in (
        good.withColumn("seller_zip_code_prefix", F.lit("x")),
        good.withColumn("seller_city", F.lit(None).cast("string")),
    ):
        with pytest.raises(PySparkException, match="sellers.seller"):
            sinks.conform(bad, schema, "sellers").collect()


@pytest.fixture
def database(spark, tmp_path):
    name = f"db_{tmp_path.name.replace('-', '_')}"
    spark.sql(f"CREATE DATABASE {name} LOCATION '{tmp_path / 'db'}'")
    yield name
    spark.sql(f"DROP DATABASE {name} CASCADE")


def valid_analysis(spark):
    """The given tables without the defects that a strict load refuses."""
    raw = dict(star_schema.load(spark, SF))
    raw["orders"] = raw["orders"].join(raw["customers"].select("customer_id"), "customer_id", "left_semi")
    for child in ("order_items", "payments", "reviews"):
        whole = raw[child].join(raw["orders"].select("order_id"), "order_id", "left_semi")
        raw[child] = whole.dropDuplicates(KEYS[child])
    lookup = raw["products"].select("product_category_name").distinct().dropna()
    raw["category_translation"] = lookup.withColumn(
        "product_category_name_english", F.lower("product_category_name")
    )
    return Analysis(raw, SETTINGS)


def test_bootstrap_loads_once(spark, database):
    analysis = valid_analysis(spark)
    report = store.bootstrap(spark, analysis, database, lengths=ANY).collect()
    assert len(report) == 7 + 3 and {r.status for r in report} == {"OK"}
    again = store.bootstrap(spark, analysis, database, lengths=ANY).collect()
    assert sorted(map(str, again)) == sorted(map(str, report))
    loaded = store.loaded_analysis(spark, database, SETTINGS)
    got = spark.table("monthly_kpis").orderBy("purchase_month").collect()
    assert got == analysis.monthly_kpis.orderBy("purchase_month").collect()
    facts = loaded.order_facts
    assert facts.count() == analysis.order_facts.count()


def test_bootstrap_refuses_a_partial_load(spark, database):
    analysis = valid_analysis(spark)
    for name, schema in CLEAN_TABLES.items():
        sinks.create_table(spark, f"{database}.{name}", schema)
    sellers = CLEAN_TABLES["sellers"]
    sinks.load_table(analysis.sellers, f"{database}.sellers", sellers)
    with pytest.raises(sinks.LoadError, match="already holds rows"):
        sinks.load_table(analysis.sellers, f"{database}.sellers", sellers)
    with pytest.raises(sinks.LoadError, match="has columns"):
        sinks.load_table(analysis.sellers.drop("seller_city"), f"{database}.sellers", sellers)
    with pytest.raises(sinks.LoadError, match="does not exist"):
        sinks.load_table(analysis.sellers, f"{database}.nowhere", sellers)
    with pytest.raises(sinks.LoadError, match="in part"):
        store.bootstrap(spark, analysis, database)
    spark.sql(f"DROP TABLE {database}.reviews")
    with pytest.raises(sinks.LoadError, match="lacks the tables"):
        store.bootstrap(spark, analysis, database)


def test_exports_are_ordered_complete_and_repeatable(spark, tmp_path):
    analysis = Analysis(star_schema.load(spark, SF), SETTINGS, star_schema.MANUAL_TRANSLATIONS)
    rows = store.export(analysis, str(tmp_path / "one"))
    assert rows == store.export(analysis, str(tmp_path / "two"))
    for name, count in rows.items():
        first = lines_of(tmp_path / "one" / name)
        assert first == lines_of(tmp_path / "two" / name)
        assert len(first) == count + 1
        assert not set(first[0].split(",")) & set(reports.IDENTIFYING_COLUMNS)
    months = [line.split(",")[0] for line in lines_of(tmp_path / "one" / "monthly_kpis")[1:]]
    assert months == sorted(months) and len(months) == 60
    with pytest.raises(ValueError, match="no rows"):
        sinks.write_report(analysis.monthly_kpis.limit(0), str(tmp_path / "none"), [F.asc("purchase_month")])


def test_fact_store_gives_the_same_results(spark, tmp_path):
    raw = star_schema.load(spark, SF)
    analysis = Analysis(raw, SETTINGS, star_schema.MANUAL_TRANSLATIONS)
    path = str(tmp_path / "facts")
    store.write_fact_store(analysis, path)
    stored = store.read_fact_store(spark, path, raw["sellers"], SETTINGS)
    direct, again = analysis.investigate().results(), stored.investigate().results()
    for name in direct:
        mine, other = sorted(map(str, direct[name].collect())), sorted(map(str, again[name].collect()))
        assert mine == other, name


class Session:
    """As much of a session as the choice of the shared folder looks at."""

    def __init__(self, master: str, option: str = "") -> None:
        self.conf = {"spark.checkpoint.dir": option}
        self.sparkContext, self.master, self.folder = self, master, None

    def getCheckpointDir(self):
        return self.folder

    def setCheckpointDir(self, folder):
        self.folder = folder


def test_shared_folder_comes_from_the_session():
    assert shared.shared_folder(Session("yarn", "hdfs://a/b/")) == "hdfs://a/b"
    local = Session("local[2]")
    assert shared.shared_folder(local) == local.folder
    with pytest.raises(ValueError):
        shared.shared_folder(Session("yarn"))


def test_materialised_tables_never_share_a_path(spark):
    frame = spark.range(5).withColumn("x", F.lit(Decimal("1.50")))
    first, second = (shared.materialise(frame, "numbers") for _ in range(2))
    assert first.inputFiles() and not set(first.inputFiles()) & set(second.inputFiles())
    assert first.dtypes == frame.dtypes
    assert sorted(map(str, first.collect())) == sorted(map(str, frame.collect()))


def test_session_options_grow_with_the_input():
    small = recommended_options(40 * 2**20, 8)
    large = recommended_options(100 * 2**40, 8_000)
    assert small["spark.sql.shuffle.partitions"] == "8"
    assert 8_000 < int(large["spark.sql.shuffle.partitions"]) <= 50_000
    assert large["spark.sql.adaptive.skewJoin.enabled"] == "true"


def test_bootstrap_lists_what_is_wrong_before_it_writes(spark, database):
    raw = dict(star_schema.load(spark, SF))
    with pytest.raises(sinks.LoadError, match="repeated key: order_items") as failed:
        store.bootstrap(spark, Analysis(raw, SETTINGS, star_schema.MANUAL_TRANSLATIONS), database)
    assert "unmapped category: products" in str(failed.value)
    assert "rule: orders: order_id length" in str(failed.value)
    assert store.existing_tables(spark, database) == set()
    text = dict(star_schema.as_text(raw))
    text["orders"] = text["orders"].withColumn("order_approved_at", F.lit("never"))
    with pytest.raises(sinks.LoadError, match="unreadable: orders.order_approved_at"):
        gate.require_clean(Analysis(text, SETTINGS, star_schema.MANUAL_TRANSLATIONS))


def test_bootstrap_takes_up_a_broken_load(spark, database):
    analysis = valid_analysis(spark)
    for name, schema in CLEAN_TABLES.items():
        sinks.create_table(spark, f"{database}.{name}", schema)
    for name in ("customers", "sellers"):
        schema = CLEAN_TABLES[name]
        frame = analysis.clean_tables()[name].select(*schema.fieldNames())
        sinks.load_table(frame, f"{database}.{name}", schema)
    report = store.bootstrap(spark, analysis, database, resume=True, lengths=ANY).collect()
    assert {r.status for r in report} == {"OK"}


def test_reports_replace_and_leave_nothing_when_empty(spark, tmp_path):
    frame, order = spark.createDataFrame([(2,), (1,)], "n int"), [F.asc("n")]
    path = str(tmp_path / "report")
    with pytest.raises(ValueError, match="holds no rows"):
        sinks.write_report(frame.limit(0), path, order)
    assert list(tmp_path.iterdir()) == []
    assert sinks.write_report(frame, path, order) == 2
    with pytest.raises(ValueError, match="exists"):
        sinks.write_report(frame, path, order)
    with pytest.raises(ValueError, match="holds no rows"):
        sinks.write_report(frame.limit(0), path, order, replace=True)
    assert spark.read.csv(path, header=True).count() == 2
    assert sinks.write_report(frame.limit(1), path, order, replace=True) == 1
    assert [p.name for p in tmp_path.iterdir() if not p.name.startswith(".")] == ["report"]


def test_versions_are_shown_whole_or_not_at_all(spark, tmp_path, monkeypatch):
    root, analysis = str(tmp_path / "shop"), valid_analysis(spark)
    with pytest.raises(sinks.LoadError, match="nothing is published"):
        versions.published(spark, root)
    with pytest.raises(sinks.LoadError, match="rule: customers: customer_id length"):
        versions.publish(spark, analysis, root)
    assert versions.versions(spark, root) == []
    first = versions.publish(spark, analysis, root, ANY)
    assert versions.publish(spark, analysis, root, ANY) == first == versions.current(spark, root)

    # One seller more; the load breaks off after two tables.
    changed = valid_analysis(spark)
    more = changed.raw["sellers"].limit(1).withColumn("seller_id", F.lit(-1).cast("long"))
    changed.raw["sellers"] = changed.raw["sellers"].unionByName(more)
    conform, seen = sinks.conform, []

    def broken(frame, schema, table):
        seen.append(table)
        if len(seen) > 2:
            raise OSError("the cluster is gone")
        return conform(frame, schema, table)

    monkeypatch.setattr(sinks, "conform", broken)
    with pytest.raises(OSError, match="gone"):
        versions.publish(spark, changed, root, ANY)
    monkeypatch.undo()
    assert versions.current(spark, root) == first
    old = versions.published(spark, root, SETTINGS)
    assert old.sellers.count() == first.rows["sellers"]

    second = versions.publish(spark, changed, root, ANY)
    assert second.number == 2 and second.rows["sellers"] == first.rows["sellers"] + 1
    assert versions.published(spark, root, SETTINGS).sellers.filter("seller_id = '-1'").count() == 1
    # A reader that resolved the old version still reads it whole.
    assert old.sellers.count() == first.rows["sellers"]
    kpis = versions.published(spark, root, SETTINGS).monthly_kpis.orderBy("purchase_month")
    assert kpis.collect() == analysis.monthly_kpis.orderBy("purchase_month").collect()

    # A manifest that is still being written is not followed.
    (Path(root) / "manifest-000000000003").write_text('{"folder": "ver')
    assert versions.current(spark, root) == second
    (Path(root) / "manifest-000000000003").unlink()
    assert len(versions.drop_unseen(spark, root, keep=1)) == 2
    assert versions.versions(spark, root) == [second]
    assert versions.published(spark, root, SETTINGS).orders.count() == second.rows["orders"]

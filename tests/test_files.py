import json
import uuid

import pytest

from shelfline import Lakehouse
from shelfline.plans import silver
from shelfline.sources import files, schemas
from shelfline.streaming.ingest import load_new_files

PROMOTIONS = """promotion_id,product_category,promotion_type,discount_percentage,start_date,end_date,region
P1,"Drinks ""cold"", soft",Bundle,5,2024-01-01,2024-01-31,N
P2,Snacks
P3,Snacks,Coupon,7,2024-02-01,2024-02-02,S,extra
P4,Snacks,Coupon,7,not a date,2024-02-02,S
P5,Snacks,Coupon,150,2024-02-01,2024-02-02,S
"""
CALLS = """interaction_id,interaction_date,interaction_type,issue_category,description,duration_minutes,resolution_status,follow_up_required,customer_satisfaction
I1,2024-01-01,call,Billing,"late, again",12,Resolved,Yes,4
,2024-01-01,call,Billing,x,12,Resolved,Yes,4
"""
REVIEWS = """reviewer,name,rating,date,category
R1,"Bob, x",5

R2,Ann,4,2024-01-01,Snacks
R2,Ann,2,2024-03-01,Snacks
R3,Cy,x,2024-13-01,Snacks
"""
INVENTORY = [
    {"product_id": "A", "product_category": "Snacks", "current_stock": "7", "reorder_point": 10, "last_restock_date": "2024-01-01"},
    {"product_category": "lost"},
    {"product_id": "B", "current_stock": "many", "reorder_point": 10},
]
STORES = [{"store_id": "S", "square_footage": 12.345, "employee_count": 3}, {"store_id": "T", "square_footage": 0, "employee_count": 3}]


@pytest.fixture
def landing(tmp_path):
    for table, name in schemas.FILES.items():
        if table in schemas.CSV_SCHEMAS:
            (tmp_path / name).write_text(",".join(schemas.CSV_SCHEMAS[table].names) + "\n")
    (tmp_path / "promotions-data.csv").write_text(PROMOTIONS)
    (tmp_path / "customer_service_interactions.csv").write_text(CALLS)
    (tmp_path / "product_reviews.csv").write_text(REVIEWS)
    (tmp_path / "inventory.json").write_text(json.dumps(INVENTORY, indent=2))
    (tmp_path / "store_locations.json").write_text(json.dumps(STORES))
    return str(tmp_path)


def test_lines_that_do_not_fit_are_set_aside(spark, landing):
    scanned = files.scan(spark, landing, "promotions_data")
    good = files.accepted(scanned)
    assert [row.promotion_id for row in good.orderBy("promotion_id").collect()] == ["P1", "P5"]
    assert good.where("promotion_id = 'P1'").first().product_category == 'Drinks "cold", soft'
    # The verdict does not depend on the columns read.
    assert good.count() == good.select("region").count() == 2
    assert sorted(row.line[:2] for row in files.rejects(scanned).collect()) == ["P2", "P3", "P4"]
    assert files.rejects(scanned).count() == 3


def test_reject_report(spark, landing):
    report = {row.table_name: row.rejected_lines for row in files.reject_report(spark, landing).collect()}
    assert report["promotions_data"] == 3 and sum(report.values()) == 3 and len(report) == 11


def test_files_without_the_optional_columns_load(spark, landing):
    calls = files.read_bronze(spark, landing, "customer_service_interactions")
    assert calls.columns == schemas.CSV_SCHEMAS["customer_service_interactions"].names
    first = calls.where("interaction_id = 'I1'").first()
    assert (first.description, first.customer_satisfaction, first.customer_id) == ("late, again", 4, None)


def test_raw_lines_keep_quotes_and_commas(spark, landing):
    lines = {row.raw_line for row in files.read_bronze(spark, landing, "product_reviews").collect()}
    assert 'R1,"Bob, x",5' in lines and len(lines - {None, ""}) == 4


def test_json_lines(spark, tmp_path):
    (tmp_path / "docs.json").write_text('[{"product_id": "A"}]\nnot json\n[{"product_id": "B"}]\n')
    assert files.accepted(files.read_json_lines(spark, str(tmp_path / "docs.json"))).count() == 2


def test_silver_from_files(spark, landing, day):
    lake = Lakehouse.from_files(spark, landing, day("2024-06-01"))
    assert [row.promotion_id for row in lake.silver("promotions_clean").collect()] == ["P1"]
    assert lake.silver("customer_service_interactions_clean").first().is_resolved == 1
    reviews = {row.reviewer_id: row for row in lake.silver("product_reviews_clean").collect()}
    # Quoted commas shift the fields; the latest date wins; an unreadable rating stays.
    assert (reviews["R1"].reviewer_name, reviews["R1"].rating, reviews["R1"].product_category) == ('"Bob', None, "")
    assert (reviews["R2"].rating, reviews["R2"].sentiment) == (2, "Negative")
    assert (reviews["R3"].rating, reviews["R3"].review_date, reviews["R3"].sentiment) == (None, None, "Unknown")
    items = {row.product_id: row for row in lake.silver("inventory_clean").collect()}
    assert set(items) == {"A", "B"}
    assert (items["A"].current_stock, items["A"].stock_level, items["A"].days_since_restock) == (7, "Critique", 152)
    assert (items["B"].current_stock, items["B"].stock_level) == (None, "Élevé")
    stores = {row.store_id: row for row in lake.silver("store_locations_clean").collect()}
    assert float(stores["S"].square_footage) == 12.35 and stores["T"].employee_density is None
    for name in silver.TABLES:
        lake.silver(name).count()


def test_each_file_is_loaded_once(spark, tmp_path):
    landing = tmp_path / "landing"
    landing.mkdir()
    target, progress = str(tmp_path / f"loaded-{uuid.uuid4()}"), str(tmp_path / "progress")
    (landing / "a.csv").write_text(PROMOTIONS)

    def load():
        load_new_files(spark, "promotions_data", str(landing), target, progress).awaitTermination(120)
        return spark.read.parquet(target)

    assert load().count() == 5
    assert load().count() == 5
    (landing / "b.csv").write_text(PROMOTIONS.replace("P", "Q"))
    loaded = load()
    assert loaded.count() == 10
    assert files.accepted(loaded).count() == 4 and files.rejects(loaded).count() == 6


CALLS_LONG = CALLS.splitlines()[0] + ",customer_id,order_id\nI3,2024-01-02,call,Billing,x,3,Resolved,Yes,4,7,8\nI4,2024-01-02,call,Billing,x,3,Resolved,Yes,4,7\n"


def test_decimals_round_and_quoted_line_breaks_stay(spark, landing, tmp_path):
    header = ",".join(schemas.CSV_SCHEMAS["customer_demographics"].names)
    lines = [header, '1,"Ann\nLee",1990-01-01,Female,N,X,C,Single,45000.50', "2,Bob,1990-01-01,Male,N,X,C,Single,", "3,Cy,1990-01-01,Male,N,X,C,Single,much", "4,short"]
    (tmp_path / "customer_demographics.csv").write_text("\n".join(lines) + "\n")
    scanned = files.scan(spark, landing, "customer_demographics")
    good = {row.customer_id: (row.name, row.annual_income) for row in files.accepted(scanned).collect()}
    assert good == {1: ("Ann\nLee", 45001), 2: ("Bob", None)}
    assert sorted(row.line[:4] for row in files.rejects(scanned).collect()) == ["3,Cy", "4,sh"]


def test_one_folder_with_both_header_forms(spark, landing, tmp_path):
    folder = tmp_path / "customer_service_interactions.csv"
    folder.unlink()
    folder.mkdir()
    (folder / "a.csv").write_text(CALLS)
    (folder / "b.csv").write_text(CALLS_LONG)
    scanned = files.scan(spark, landing, "customer_service_interactions")
    good = {row.interaction_id: (row.description, row.customer_id, row.order_id) for row in files.accepted(scanned).collect()}
    assert good == {"I1": ("late, again", None, None), None: ("x", None, None), "I3": ("x", 7, 8)}
    assert [row.line[:2] for row in files.rejects(scanned).collect()] == ["I4"]


@pytest.mark.parametrize(
    "text, good, bad",
    [
        ('[{"product_id": "A"}]\n[{"product_id": "B"}]\n\n[{"product_id": "C"}]\n', "ABC", 0),
        ('[{"product_id": "A"}]\n[{"product_id": \n[{"product_id": "C"}]\n', "AC", 1),
        ('[\n{"product_id": "A"},\n{"product_id": "B"}\n]\n', "AB", 0),
        ('[\n{"product_id": "A"}\n]\n[\n{"product_id": "B"}\n]\n', "", 1),
        ('[{"product_id": "A"},', "", 1),
        ("", "", 0),
    ],
)
def test_json_documents_load_or_are_rejected(spark, landing, tmp_path, day, text, good, bad):
    (tmp_path / "inventory.json").write_text(text)
    lake = Lakehouse.from_files(spark, landing, day("2024-06-01"))
    assert sorted(row.product_id for row in lake.silver("inventory_clean").collect()) == list(good)
    report = {row.table_name: row.rejected_lines for row in files.reject_report(spark, landing).collect()}
    assert report["inventory_staging"] == bad


def test_loaded_folders_open_as_a_lakehouse(spark, landing, tmp_path, day):
    drop = tmp_path / "drop"
    for table, name, text in (
        ("financial_transactions", "t.csv", "h\nT1,2024-01-01,Sale,1 200,Cash,7,N,A\nT1,2024-01-02,Sale,5,Cash,7,N,A\n"),
        ("customer_service_interactions", "c.csv", CALLS),
        ("inventory_staging", "i.json", json.dumps(INVENTORY, indent=1)),
    ):
        (drop / table).mkdir(parents=True)
        (drop / table / name).write_text(text)
        load_new_files(spark, table, str(drop / table), str(tmp_path / "loaded" / table), str(tmp_path / "progress")).awaitTermination(120)
    lake = Lakehouse.from_loaded(spark, str(tmp_path / "loaded"), day("2024-06-01"))
    assert [(row.transaction_id, int(row.amount)) for row in lake.silver("financial_transactions_clean").collect()] == [("T1", 1200)]
    assert lake.silver("inventory_clean").count() == 2
    assert lake.bronze("customer_service_interactions").count() == 2


def test_a_swap_that_stops_halfway_loses_nothing(spark):
    from shelfline.sources.tables import recover_table, replace_table

    name = f"swap_{uuid.uuid4().hex}"
    replace_table(spark.range(3), name)
    replace_table(spark.range(4), name)
    assert spark.table(name).count() == 4
    spark.range(5).write.saveAsTable(f"{name}__next")
    spark.sql(f"ALTER TABLE {name} RENAME TO {name}__old")  # and here the run stops
    recover_table(spark, name)
    assert spark.table(name).count() == 4
    assert replace_table(spark.table(name).limit(2), name).count() == 2
    assert not spark.catalog.tableExists(f"{name}__old") and not spark.catalog.tableExists(f"{name}__next")


def test_record_layouts_of_delimited_files(spark, landing, tmp_path):
    header = ",".join(schemas.CSV_SCHEMAS["promotions_data"].names)
    records = [f'P{i},"Snacks, ""{i}""",Coupon,{i % 50},2024-02-01,2024-02-02,S' for i in range(3000)]
    (tmp_path / "promotions-data.csv").write_text("\n".join([header, *records, "P1,short", ""]) + "\n")
    before = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "16k")
    try:
        lines = files.scan(spark, landing, "promotions_data")
        quoted = files.scan(spark, landing, "promotions_data", {"promotions_data": "quoted"})
        assert lines.rdd.getNumPartitions() > 4 and quoted.rdd.getNumPartitions() == 1
        assert files.accepted(lines).count() == 3000 and files.accepted(lines).exceptAll(files.accepted(quoted)).isEmpty()
        assert [r.line for r in files.rejects(lines).collect()] == ["P1,short"] and files.rejects(quoted).count() == 1
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", before)
    # A line break in a field: one record where fields may hold them, otherwise two lines that are kept as rejects.
    (tmp_path / "promotions-data.csv").write_text(f'{header}\nP1,"Sna\ncks",Coupon,5,2024-02-01,2024-02-02,S\nP2,Snacks,Coupon,5,2024-02-01,2024-02-02,S\n')
    assert files.read_bronze(spark, landing, "promotions_data", {"promotions_data": "quoted"}).count() == 2
    assert [r.promotion_id for r in files.read_bronze(spark, landing, "promotions_data").collect()] == ["P2"]
    assert {r.table_name: r.rejected_lines for r in files.reject_report(spark, landing).collect()}["promotions_data"] == 2


def test_json_arrays_are_read_object_by_object(spark, landing, tmp_path, day):
    layouts = {"inventory_staging": "elements", "store_locations_staging": "elements"}
    whole = Lakehouse.from_files(spark, landing, day("2024-06-01"))
    single = Lakehouse.from_files(spark, landing, day("2024-06-01"), layouts)
    assert single.bronze("inventory_staging").count() == len(INVENTORY) and whole.bronze("inventory_staging").count() == 1
    for table in ("inventory_clean", "store_locations_clean"):
        assert sorted(map(str, single.silver(table).collect())) == sorted(map(str, whole.silver(table).collect()))
    (tmp_path / "inventory.json").write_text('[{"product_id": "A"}, {"product_id": ')
    scanned = files.scan(spark, landing, "inventory_staging", layouts)
    assert files.accepted(scanned).count() == 0 and [r.line[:4] for r in files.rejects(scanned).collect()] == ["[{"[:2] + '"p']
    assert files.rejects(scanned).count() == 1
    assert {r.table_name: r.rejected_lines for r in files.reject_report(spark, landing, layouts).collect()}["inventory_staging"] == 1


def test_files_skip_on_every_clustered_column(spark, tmp_path, day):
    from pyspark.sql import functions as F

    from shelfline.sources.tables import clustered

    rows = spark.range(40_000).select(
        F.when(F.col("id") % 3 > 0, F.concat(F.lit("R"), F.col("id") % 16)).alias("region"),
        F.date_add(F.lit(day("2024-01-01")), F.pmod(F.hash("id"), F.lit(300))).alias("day"),
        F.when(F.col("id") % 100 > 0, F.col("id") % 16).alias("kind"),
        "id",
    )
    clustered(rows, ["day", "region"], "id", files=16).write.parquet(str(tmp_path / "laid"))
    laid = spark.read.parquet(str(tmp_path / "laid"))
    assert laid.exceptAll(rows).isEmpty() and laid.count() == 40_000
    ends = laid.groupBy(F.input_file_name().alias("file")).agg(*(f(c).alias(f"{n}_{c}") for c in ("region", "day") for n, f in (("low", F.min), ("high", F.max))), F.count("*").alias("n"))
    files_ = ends.collect()
    assert len(files_) == 16 and max(f.n for f in files_) < 3 * 40_000 / 16
    for column, value in (("region", "R13"), ("region", "R2"), ("day", day("2024-02-20")), ("day", day("2024-09-01"))):
        read = [f for f in files_ if f[f"low_{column}"] is not None and f[f"low_{column}"] <= value <= f[f"high_{column}"]]
        assert 0 < len(read) <= 8, (column, value, len(read))
    empty = clustered(rows.where("false"), ["day", "region"], "id")
    assert empty.collect() == [] and clustered(rows.select(F.lit(None).cast("string").alias("x"), "id"), ["x"], "id").count() == 40_000

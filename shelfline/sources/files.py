"""Raw-file readers: lenient delimited files, undelimited lines and JSON documents.

Nothing read is lost: each record of a file is either accepted or kept as text in ``_bad`` and counted as a reject.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from shelfline.functions.dialect import lenient_date, lenient_id
from shelfline.sources import schemas

BAD = "_bad"

CSV_OPTIONS = {
    "header": "true",
    "quote": '"',
    "escape": '"',
    "mode": "PERMISSIVE",
    "columnNameOfCorruptRecord": BAD,
}
RAW_LINE_OPTIONS = {"header": "true", "sep": "\u0001", "quote": ""}


def csv_options(table: str, layout: str | None = None) -> dict[str, str]:
    """Reader options of a table's record layout, the declared one unless another is given."""
    return CSV_OPTIONS | {"multiLine": {"quoted": "true", "lines": "false"}[layout or schemas.CSV_LAYOUT[table]]}


def text_schema(schema: T.StructType) -> T.StructType:
    """All fields as text, and the column that keeps records of another shape."""
    return T.StructType([*(T.StructField(f.name, T.StringType()) for f in schema), T.StructField(BAD, T.StringType())])


def _typed(field: T.StructField, text: Column) -> Column:
    """A field's text in its type, NULL where it does not convert. Whole numbers round half up."""
    if isinstance(field.dataType, T.LongType):
        return lenient_id(text)
    if isinstance(field.dataType, T.DateType):
        return lenient_date(text)
    return text.try_cast(field.dataType)


def parsed(texts: DataFrame, table: str) -> DataFrame:
    """Typed columns of ``table`` and ``_bad`` from records read with ``text_schema``.

    A record is bad when its number of fields is wrong or a field that is not empty does not convert. Optional trailing
    fields may be absent, record by record, so one folder can hold files of both forms.
    """
    schema = schemas.CSV_SCHEMAS[table]
    optional = schemas.OPTIONAL_COLUMNS.get(table, ())
    names = [f.name for f in schema]
    # Without corrupt-record checks on the fields of one query alone: all fields are read together.
    whole = texts.select(F.struct(*names).alias("_fields"), BAD)
    if optional:
        short = T.StructType([f for f in schema if f.name not in optional])
        options = {k: v for k, v in CSV_OPTIONS.items() if k != "header"}
        ddl = ", ".join(f"{f.name} string" for f in text_schema(short))
        again = F.from_csv(F.col(BAD), F.lit(ddl), options)
        second = whole.withColumn("_again", F.when(F.col(BAD).isNotNull(), again))
        fits = F.col(BAD).isNotNull() & F.col(f"_again.{BAD}").isNull()
        fields = F.struct(*(F.when(fits, F.lit(None) if n in optional else F.col(f"_again.{n}")).otherwise(F.col(f"_fields.{n}")).alias(n) for n in names))
        whole = second.select(fields.alias("_fields"), F.when(~fits, F.col(BAD)).alias(BAD))
    texts_of = {f.name: F.col(f"_fields.{f.name}") for f in schema}
    wrong = F.lit(False)
    for f in schema:
        if not isinstance(f.dataType, T.StringType):
            text = texts_of[f.name]
            wrong |= text.isNotNull() & (F.trim(text) != "") & _typed(f, text).isNull()
    bad = F.when(F.col(BAD).isNotNull(), F.col(BAD)).when(wrong, F.to_csv("_fields"))
    return whole.select(*(_typed(f, texts_of[f.name]).alias(f.name) for f in schema), bad.alias(BAD))


def read_delimited(spark: SparkSession, path: str, table: str, layout: str | None = None) -> DataFrame:
    """Read every record; one that does not fit the table keeps its text in ``_bad``.

    ``layout`` overrides the declared one. Read as lines, a record with a line break in a field is two lines that do not fit.
    """
    return parsed(spark.read.schema(text_schema(schemas.CSV_SCHEMAS[table])).options(**csv_options(table, layout)).csv(path), table)


def accepted(scanned: DataFrame) -> DataFrame:
    return scanned.where(F.col(BAD).isNull()).drop(BAD)


def rejects(scanned: DataFrame) -> DataFrame:
    """Records that did not load, as text."""
    return scanned.where(F.col(BAD).isNotNull()).select(F.col(BAD).alias("line"))


def read_lines(spark: SparkSession, path: str, column: str = "raw_line") -> DataFrame:
    """Each line after the header as one text value, quotes and commas untouched."""
    schema = T.StructType([T.StructField(column, T.StringType())])
    return spark.read.schema(schema).options(**RAW_LINE_OPTIONS).csv(path)


def json_documents(texts: DataFrame, column: str = "raw_data") -> DataFrame:
    """(raw_data, _bad) of every JSON document in ``value``, the text of a whole file or of a line.

    A file whose first line is a document by itself holds one document a line; any other file is one document. What is
    not one complete document is kept as text in ``_bad``.
    """

    def document(text: Column) -> Column:
        """The variant; NULL unless the text is one complete value (text after the first value would be ignored)."""
        return F.when(F.try_parse_json(F.concat(F.lit("["), text, F.lit("]"))).isNotNull(), F.try_parse_json(text))

    lines = F.filter(F.split("value", "\r?\n"), lambda line: F.trim(line) != "")
    by_line = document(F.try_element_at(lines, F.lit(1))).isNotNull()
    pieces = texts.select(F.explode(F.when(by_line, lines).otherwise(F.array("value"))).alias("_text")).where(F.trim("_text") != "")
    made = pieces.select(document(F.col("_text")).alias(column), "_text")
    return made.select(column, F.when(F.col(column).isNull(), F.col("_text")).alias(BAD))


def read_json_documents(spark: SparkSession, path: str, column: str = "raw_data") -> DataFrame:
    """One variant per document, and rejects: a file may hold one document over many lines or one a line."""
    return json_documents(spark.read.text(path, wholetext=True), column)


def read_json_lines(spark: SparkSession, path: str, column: str = "raw_data") -> DataFrame:
    """One variant per line, and rejects, for large exports written one document a line; these split across tasks."""
    return json_documents(spark.read.text(path), column)


def read_json_elements(spark: SparkSession, path: str, fields: Sequence[tuple[str, str]], column: str = "raw_data") -> DataFrame:
    """One variant (an array of one object) per object of the files' arrays, and rejects.

    Spark's JSON source reads a file object by object, so its text is never one value; only ``fields`` are kept. A file that
    is not one well-formed array of objects is one reject with its whole text.
    """
    names = [name for name, _ in fields]
    schema = T.StructType([*(T.StructField(name, T.VariantType()) for name in names), T.StructField(BAD, T.StringType())])
    rows = spark.read.schema(schema).options(multiLine="true", mode="PERMISSIVE", columnNameOfCorruptRecord=BAD).json(path)
    # A broken file has no field. The test also makes the reader parse the fields where only rejects are asked for.
    empty = F.lit(True)
    for name in names:
        empty &= F.col(name).isNull()
    bad = F.when(empty, F.col(BAD))
    return rows.select(F.when(bad.isNull(), F.to_variant_object(F.array(F.struct(*names)))).alias(column), bad.alias(BAD))


def scan(spark: SparkSession, folder: str, table: str, layouts: Mapping[str, str] | None = None) -> DataFrame:
    """Scan one Bronze table's raw file, rejected records included in ``_bad``.

    ``layouts`` overrides the record layouts that ``schemas`` declares, table by table.
    """
    layout = (layouts or {}).get(table)
    path = f"{folder.rstrip('/')}/{schemas.FILES[table]}"
    if table in schemas.RAW_LINE_TABLES:
        return read_lines(spark, path).withColumn(BAD, F.lit(None).cast("string"))
    if table in schemas.JSON_TABLES:
        layout = layout or schemas.JSON_LAYOUT[table]
        if layout == "elements":
            return read_json_elements(spark, path, schemas.JSON_FIELDS[table])
        return {"lines": read_json_lines, "documents": read_json_documents}[layout](spark, path)
    return read_delimited(spark, path, table, layout)


def read_bronze(spark: SparkSession, folder: str, table: str, layouts: Mapping[str, str] | None = None) -> DataFrame:
    return accepted(scan(spark, folder, table, layouts))


def reject_report(spark: SparkSession, folder: str, layouts: Mapping[str, str] | None = None) -> DataFrame:
    """Rejected record count of each Bronze table."""
    parts = [
        rejects(scan(spark, folder, table, layouts)).agg(F.count("*").alias("rejected_lines"))
        .select(F.lit(table).alias("table_name"), "rejected_lines")
        for table in schemas.BRONZE_TABLES
    ]
    report = parts[0]
    for part in parts[1:]:
        report = report.unionByName(part)
    return report.orderBy("table_name")

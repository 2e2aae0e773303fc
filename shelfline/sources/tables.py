"""Written tables: clustered layout, build-then-swap, comments, and the report sink."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F


BITS = 5  # a column is cut into 2 ** BITS ranges
SAMPLE = 4096  # rows, about, that the cuts are taken from


def range_cuts(df: DataFrame, columns: Sequence[str], seed: int = 7) -> dict[str, list]:
    """For each column the values at which its ranges of about equal row counts begin, from a bounded sample of the rows.

    A value that holds several ranges' worth of rows is one range. The cuts decide on the layout only, never on results.
    """
    share = min(1.0, SAMPLE / max(1, df.count()))
    rows = df.select(*columns).sample(share, seed).collect()
    cuts = {}
    for column in columns:
        values = sorted(row[column] for row in rows if row[column] is not None)
        cuts[column] = sorted({values[len(values) * i >> BITS] for i in range(1, 1 << BITS)} - set(values[:1])) if values else []
    return cuts


def curve_position(cuts: Mapping[str, list]) -> Column:
    """Place of a row on a curve through the grid of all columns' ranges: the bits of the range numbers in turn.

    Rows near each other on the curve are near in every column, so a stretch of it, a file, has a narrow range of each. NULL
    counts as the lowest value.
    """

    def number(column: str, starts: list) -> Column:
        below = F.size(F.filter(F.array(*map(F.lit, starts)), lambda start: start <= F.col(column))) if starts else F.lit(0)
        return F.floor(below * ((1 << BITS) / (len(starts) + 1))).cast("int")

    numbers = [number(column, starts) for column, starts in cuts.items()]
    place = F.lit(0).cast("long")
    for bit in reversed(range(BITS)):
        for n in numbers:
            place = place * 2 + F.shiftright(n, bit).bitwiseAND(F.lit(1))
    return place


def clustered(df: DataFrame, columns: Sequence[str], spread_by: str, files: int | None = None) -> DataFrame:
    """Lay rows out along a curve over ``columns``, so that file statistics can skip files on each of them alone.

    ``spread_by``, a column of many values, ends the range key: a cell holding much of the table is then cut over several
    tasks instead of landing in one. ``files``: number of partitions; without it, adaptive execution chooses. Reads ``df``
    for the cuts at once, so it should be a table (``replace_clustered``).
    """
    placed = df.withColumn("_place", curve_position(range_cuts(df, columns)))
    key = ["_place", spread_by]
    ranged = placed.repartitionByRange(files, *key) if files else placed.repartitionByRange(*key)
    return ranged.sortWithinPartitions("_place", *columns, spread_by).drop("_place")


def replace_clustered(
    df: DataFrame, name: str, layout: tuple[Sequence[str], str], comment: str | None = None, columns: Mapping[str, str] | None = None
) -> DataFrame:
    """``replace_table`` with the rows laid out by ``layout`` (columns, spread_by).

    The query runs once, into a table that is dropped afterwards; cuts, range sampling and the final rows read that table.
    """
    spark, flat = df.sparkSession, f"{name}__flat"
    spark.sql(f"DROP TABLE IF EXISTS {flat}")
    df.write.format("parquet").saveAsTable(flat)
    table = replace_table(clustered(spark.table(flat), *layout), name, comment, columns)
    spark.sql(f"DROP TABLE {flat}")
    return table


def replace_table(df: DataFrame, name: str, comment: str | None = None, columns: Mapping[str, str] | None = None) -> DataFrame:
    """Create or replace a table from a query and return it as written.

    The rows go to a new table that then takes the name, so the query may read the table it replaces, and readers
    never see half of it. The old table steps aside until the new one has its name; a run that stops in between leaves
    a complete copy, which ``recover_table`` puts back at the start of the next run.
    """
    spark = df.sparkSession
    staged, aside = f"{name}__next", f"{name}__old"
    recover_table(spark, name)
    spark.sql(f"DROP TABLE IF EXISTS {staged}")
    df.write.format("parquet").saveAsTable(staged)
    if spark.catalog.tableExists(name):
        spark.sql(f"ALTER TABLE {name} RENAME TO {aside}")
    spark.sql(f"ALTER TABLE {staged} RENAME TO {name}")
    spark.sql(f"DROP TABLE IF EXISTS {aside}")
    describe(spark, name, comment, columns)
    return spark.table(name)


def replace_partitions(df: DataFrame, name: str, column: str) -> None:
    """Write ``df``, whose last column is ``column``, over the partitions of the table that it has rows for; others stay."""
    spark, mode = df.sparkSession, "spark.sql.sources.partitionOverwriteMode"
    if not spark.catalog.tableExists(name):
        df.write.format("parquet").partitionBy(column).saveAsTable(name)
        return
    before = spark.conf.get(mode)
    spark.conf.set(mode, "dynamic")
    try:
        df.write.mode("overwrite").insertInto(name)
    finally:
        spark.conf.set(mode, before)


def recover_table(spark: SparkSession, name: str) -> None:
    """Undo a swap that stopped halfway: without ``name``, its old copy is put back; with it, the old copy is dropped.

    The old table steps aside only once the new one is complete, and the new one is written again by the rerun.
    """
    aside = f"{name}__old"
    if spark.catalog.tableExists(aside):
        if spark.catalog.tableExists(name):
            spark.sql(f"DROP TABLE {aside}")
        else:
            spark.sql(f"ALTER TABLE {aside} RENAME TO {name}")


def describe(
    spark: SparkSession, name: str, comment: str | None = None, columns: Mapping[str, str] | None = None
) -> None:
    """Attach a table comment and column comments."""
    if comment:
        spark.sql(f"COMMENT ON TABLE {name} IS {quoted(comment)}")
    for column, text in (columns or {}).items():
        spark.sql(f"ALTER TABLE {name} ALTER COLUMN {column} COMMENT {quoted(text)}")


def quoted(text: str) -> str:
    """An SQL string literal."""
    return "'" + text.replace("\\", "\\\\").replace("'", "\\'") + "'"


def create_view(spark: SparkSession, name: str, query: str, comment: str | None = None) -> DataFrame:
    """Create or replace a view of the catalogue from the text of a query over tables, and return it.

    The text is stored, so every session of the catalogue can read the view and sees its comment.
    """
    spark.sql(f"CREATE OR REPLACE VIEW {name} {f'COMMENT {quoted(comment)} ' if comment else ''}AS {query}")
    return spark.table(name)


def replace_summary_view(df: DataFrame, name: str, comment: str | None = None, order: str = "") -> DataFrame:
    """A catalogue view, ordered by the SQL text ``order``, over the written rows of ``df`` (table ``name``__rows)."""
    replace_table(df, f"{name}__rows", comment)
    columns = ", ".join(f"`{column}`" for column in df.columns)
    return create_view(df.sparkSession, name, f"SELECT {columns} FROM {name}__rows" + (f" ORDER BY {order}" if order else ""), comment)


def write_report(report: DataFrame, path: str) -> None:
    """Write a report as a folder of CSV files with headers; its rows are not drawn into one task."""
    report.write.mode("overwrite").option("header", "true").csv(path)

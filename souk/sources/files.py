"""CSV in, typed parquet or bucketed tables out."""

from __future__ import annotations

from collections.abc import Callable, Collection, Mapping
from functools import partial

from pyspark.sql import DataFrame, SparkSession

from souk.plans import versions
from souk.plans.deal import parts
from souk.schema import SCHEMAS, Tables

# The one table with free text, whose quoted values hold line breaks.
MULTILINE = ("order_reviews",)

# Co-locating layout: everything about an order shares its bucket.
BUCKET_KEYS = {
    "customers": "customer_id",
    "orders": "order_id",
    "order_items": "order_id",
    "order_payments": "order_id",
    "order_reviews": "order_id",
}
#: Rows of a table in a bucket, about, unless fewer buckets than were asked for would do.
BUCKET_ROWS = 1 << 20


def read_csv_table(
    spark: SparkSession, name: str, path: str, multiline: bool | None = None
) -> DataFrame:
    """One table from CSV with a header, its columns taken by position.

    Bare empty fields are NULL and quoted ones empty strings; a doubled quote is a
    quote. Multiline files cannot be split, so only tables known to hold line breaks
    are read that way unless asked; a record that does not fit fails the read.
    """
    if multiline is None:
        multiline = name in MULTILINE
    return (
        spark.read.schema(SCHEMAS[name])
        .options(
            header=True, encoding="UTF-8", quote='"', escape='"', nullValue="\\N",
            mode="FAILFAST", multiLine=multiline,
        )
        .csv(path)
    )


def read_csv(
    spark: SparkSession, paths: Mapping[str, str], multiline: Collection[str] = MULTILINE
) -> Tables:
    """All tables from CSV; ``paths`` maps table names to files or folders."""
    return Tables(**{
        name: partial(read_csv_table, spark, name, paths[name], name in multiline)
        for name in SCHEMAS
    })


def write_csv(t: Tables, folder: str) -> None:
    """Create or replace the tables as folders of CSV files that ``read_csv`` reads."""
    for name, df in t.items():
        columns = (df[f.name].cast(f.dataType) for f in SCHEMAS[name])
        df.select(*columns).write.mode("overwrite").options(
            header=True, encoding="UTF-8", quote='"', escape='"', emptyValue='""', nullValue="\\N",
            timestampNTZFormat="yyyy-MM-dd HH:mm:ss",
        ).csv(f"{folder}/{name}")


def current(spark: SparkSession, folder: str) -> str:
    """Where the newest complete version of ``write_parquet``'s tables lies."""
    complete = versions.committed(spark, folder)
    if not complete:
        raise FileNotFoundError(f"no complete version in {folder}")
    return f"{folder}/v{complete[-1]}"


def read_parquet(spark: SparkSession, folder: str) -> Tables:
    """All tables of the newest version that ``write_parquet`` completed."""
    place = current(spark, folder)
    return Tables(**{
        name: partial(spark.read.schema(schema).parquet, f"{place}/{name}")
        for name, schema in SCHEMAS.items()
    })


def append_parquet(rows: Mapping[str, DataFrame], folder: str) -> None:
    """Add rows to some tables of the newest version."""
    for name, df in rows.items():
        df.write.mode("append").parquet(f"{current(df.sparkSession, folder)}/{name}")


def write_parquet(
    t: Tables, folder: str, keep: int = 2,
    watched: Callable[[str, DataFrame], DataFrame] = lambda name, df: df,
) -> None:
    """Create or replace the tables as parquet folders.

    All tables together are a version, written beside the one before: until the last is
    complete, and if writing fails, readers find the old ones. The ``keep`` newest stay, for
    readers that opened one. Two writers at a time don't mix: the later one to finish fails.
    ``watched`` sees each table's rows as they are written, once.

    Orders are laid out by time, so that a date range reads only the files that hold it;
    ordering equal times by id keeps a crowded moment from filling one file.
    """
    spark = t.orders.sparkSession
    complete = versions.committed(spark, folder)
    number = max(complete, default=0) + 1
    for name, df in t.items():
        if name == "orders":
            time = ["order_purchase_timestamp", "order_id"]
            df = df.repartitionByRange(*time).sortWithinPartitions(*time)
        watched(name, df).write.mode("overwrite").parquet(f"{folder}/v{number}/{name}")
    versions.commit(spark, folder, number)
    for old in [*complete, number][:-keep]:
        versions.retire(spark, folder, old, f"{folder}/v{old}")


def write_bucketed(
    t: Tables, database: str, buckets: int, location: str | None = None
) -> None:
    """Create or replace catalog tables bucketed so that joins on orders do not shuffle.

    A bucket is read by one task, so large tables get more ``buckets``: as many as leave each
    about ``BUCKET_ROWS`` rows of the largest, in all tables, as only equal numbers meet without
    a shuffle. Counts the rows, which runs jobs. A new database lies in ``location``, or where
    the catalog puts it.
    """
    spark = t.orders.sparkSession
    rows = max(df.count() for name, df in t.items() if name in BUCKET_KEYS)
    buckets = max(buckets, parts(rows, BUCKET_ROWS))
    place = f" LOCATION '{location}'" if location else ""
    spark.sql(f"CREATE DATABASE IF NOT EXISTS {database}{place}")
    for name, df in t.items():
        writer = df.write.mode("overwrite").format("parquet")
        if name in BUCKET_KEYS:
            key = BUCKET_KEYS[name]
            # Gathers a bucket's rows so that it gets few files, yet splits a hot key's.
            writer = (
                df.hint("rebalance", buckets, key)
                .write.mode("overwrite").format("parquet").bucketBy(buckets, key).sortBy(key)
            )
        writer.saveAsTable(f"{database}.{name}")


def read_catalog(spark: SparkSession, database: str) -> Tables:
    """All tables of a catalog database."""
    return Tables(**{name: partial(spark.table, f"{database}.{name}") for name in SCHEMAS})

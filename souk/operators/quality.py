"""Checks of what a database would enforce: counts, keys, references, NULLs, lengths."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from souk.operators.basic import monthly_orders
from souk.schema import FOREIGN_KEYS, PUBLISHED_ROW_COUNTS, SCHEMAS, UNIQUE_KEYS, Tables


def _stack(frames: list[DataFrame]) -> DataFrame:
    return reduce(DataFrame.unionByName, frames)


def row_count_validation(t: Tables, expected: Mapping[str, int] | None = None) -> DataFrame:
    """Rows per table beside the number expected, and whether they match.

    ``expected`` defaults to the published dataset's counts; a table it lacks has NULLs.
    """
    wanted = PUBLISHED_ROW_COUNTS if expected is None else expected
    return _stack([
        df.agg(
            F.lit(name).alias("table_name"),
            F.count("*").alias("row_count"),
            F.lit(wanted.get(name)).cast("bigint").alias("expected"),
            (F.count("*") == F.lit(wanted.get(name)).cast("bigint")).alias("matches"),
        )
        for name, df in t.items()
    ]).orderBy("table_name")


def key_uniqueness(t: Tables) -> DataFrame:
    """Keys that occur more than once, per declared key."""
    return _stack([
        getattr(t, name).groupBy(*key).agg(F.count("*").alias("n"))
        .agg(
            F.lit(name).alias("table_name"),
            F.lit(",".join(key)).alias("key_columns"),
            F.count_if(F.col("n") > 1).alias("n_dup_keys"),
        )
        for name, key in UNIQUE_KEYS.items()
    ]).orderBy("table_name")


def referential_integrity(t: Tables) -> DataFrame:
    """Rows whose reference names no row, per declared reference; NULLs refer to nothing."""
    return _stack(_referred_keys(t)).filter("check_name = 'references'").select(
        F.col("name").alias("fk"), F.col("n").alias("n_orphans")).orderBy("fk")


def integrity(t: Tables) -> DataFrame:
    """Repeated keys and orphaned references: (check_name, name, n).

    The rows that own a key and those that refer to it are one list, tagged and counted per
    key in one aggregate: a key's owner and referrers meet in one shuffle, whichever tables
    they are of, and repeated keys are counted before they move.
    """
    checks = _referred_keys(t) + [
        _stacked(_keys_of(t, name, key).agg(F.count_if(F.col("n") > 1).alias("keys 0")),
                 {"keys 0": ("keys", f"{name}.{','.join(key)}")})
        for name, key in UNIQUE_KEYS.items() if (name, *key) not in _REFERRED
    ]
    return _stack(checks).orderBy("check_name", "name")


# Keys that other tables refer to: (table, column).
_REFERRED = list(dict.fromkeys((parent, column) for _, column, parent in FOREIGN_KEYS))


def _referred_keys(t: Tables) -> list[DataFrame]:
    return [_referred(t, parent, column) for parent, column in _REFERRED]


def _keys_of(t: Tables, name: str, key: Sequence[str]) -> DataFrame:
    return getattr(t, name).groupBy(*key).agg(F.count("*").alias("n"))


def _referred(t: Tables, parent: str, column: str) -> DataFrame:
    """The checks of one key: its own repetition, and each table's references to it."""
    children = [table for table, c, p in FOREIGN_KEYS if (p, c) == (parent, column)]
    tagged = _stack([
        getattr(t, table).select(F.col(column).alias("key"), F.lit(tag).alias("tag"))
        for tag, table in enumerate([parent, *children])
    ])
    counted = tagged.groupBy("key").agg(*(
        F.count_if(F.col("tag") == tag).alias(f"rows_{tag}") for tag in range(len(children) + 1)))
    orphan = (F.col("rows_0") == 0) & F.col("key").isNotNull()
    found = counted.agg(F.count_if(F.col("rows_0") > 1).alias("keys 0"), *(
        F.coalesce(F.sum(F.when(orphan, F.col(f"rows_{tag}"))), F.lit(0)).alias(f"refs {tag}")
        for tag in range(1, len(children) + 1)))
    return _stacked(found, {"keys 0": ("keys", f"{parent}.{column}")} | {
        f"refs {tag}": ("references", f"{table}.{column}")
        for tag, table in enumerate(children, 1)})


def _stacked(found: DataFrame, names: dict[str, tuple[str, str]]) -> DataFrame:
    """One row of counts as rows (check_name, name, n)."""
    rows = ", ".join(f"'{check}', '{name}', `{column}`" for column, (check, name) in names.items())
    return found.select(F.expr(f"stack({len(names)}, {rows}) AS (check_name, name, n)"))


class LoadChecks:
    """Counts of rows, NULLs and over-long values, taken while tables are being written.

    Pass ``watched`` to ``files.write_parquet``; no table is read a second time. The counts
    are metrics of the write's own tasks, each counted once however often it was tried.
    """

    def __init__(self):
        self._seen: dict[str, Observation] = {}

    def watched(self, name: str, df: DataFrame) -> DataFrame:
        nulls, longs = _null_tests(name), _length_tests(name)
        self._seen[name] = Observation(f"load {name}")
        return df.observe(
            self._seen[name], F.count(F.lit(1)).alias("rows"),
            *(F.count_if(test).alias(f"nulls {column}") for column, test in nulls.items()),
            *(F.count_if(test).alias(f"long {column}") for column, test in longs.items()),
        )

    def report(self, spark: SparkSession) -> DataFrame:
        """Rows (check_name, table_name, column_name, n) of the tables written."""
        rows = [
            (*(measure.split(" ", 1) if " " in measure else (measure, "")), table, n)
            for table, seen in self._seen.items() for measure, n in seen.get.items()
        ]
        return spark.createDataFrame(
            rows, "check_name string, column_name string, table_name string, n bigint"
        ).select("check_name", "table_name", "column_name", "n").orderBy(
            "check_name", "table_name", "column_name")


def _null_tests(name: str) -> dict[str, Column]:
    return {f.name: F.col(f.name).isNull() for f in SCHEMAS[name] if not f.nullable}


def _length_tests(name: str) -> dict[str, Column]:
    return {
        f.name: F.length(F.col(f.name).cast("string")) > f.metadata["max_length"]
        for f in SCHEMAS[name] if "max_length" in f.metadata
    }


def _per_column(df: DataFrame, table: str, tests: dict[str, Column], result: str) -> DataFrame:
    """How many rows meet each test, a row per column, from one pass over the table."""
    counted = df.agg(*(F.count_if(test).alias(column) for column, test in tests.items()))
    pairs = ", ".join(f"'{column}', `{column}`" for column in tests)
    return counted.select(
        F.lit(table).alias("table_name"),
        F.expr(f"stack({len(tests)}, {pairs}) AS (column_name, {result})"),
    )


def null_checks(t: Tables) -> DataFrame:
    """NULLs in the columns declared NOT NULL."""
    return _stack([
        _per_column(df, name, _null_tests(name), "n_null") for name, df in t.items()
    ]).orderBy("table_name", "column_name")


def length_checks(t: Tables) -> DataFrame:
    """Values longer than their column's declared length."""
    return _stack([
        _per_column(df, name, _length_tests(name), "n_long") for name, df in t.items()
    ]).orderBy("table_name", "column_name")


def sparse_months(t: Tables, min_orders: int = 100) -> DataFrame:
    """Months with fewer than ``min_orders`` orders, as at the edges of the data."""
    return monthly_orders(t).filter(F.col("order_count") < min_orders)

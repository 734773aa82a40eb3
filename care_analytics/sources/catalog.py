"""Where the reference tables come from.

A :class:`Tables` maps the reference table names (``clients``,
``care_allocations``, ...) to DataFrames.  Three ways to fill it:

* :meth:`Tables.from_driver` – the test adapters over the driver Parquet;
* :meth:`Tables.from_parquet` – one Parquet folder per table under a root;
* :meth:`Tables.from_catalog` – tables registered in the session catalog.

All are lazy: a table is only read when a report touches it, and each read is
a plain ``spark.read`` / ``spark.table`` so Catalyst can prune columns and push
filters into the scan.
"""

from __future__ import annotations

import os
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession


class Tables:
    """Lazy mapping ``reference table name -> DataFrame``."""

    def __init__(self, spark: SparkSession, loader: Callable[[str], DataFrame]):
        self.spark = spark
        self._loader = loader
        self._cache: dict[str, DataFrame] = {}

    def __getitem__(self, name: str) -> DataFrame:
        if name not in self._cache:
            self._cache[name] = self._loader(name)
        return self._cache[name]

    def __getattr__(self, name: str) -> DataFrame:
        if name.startswith("_"):
            raise AttributeError(name)
        return self[name]

    # -- constructors -------------------------------------------------------
    @classmethod
    def from_driver(cls, spark: SparkSession, sf_dir: str) -> "Tables":
        """Reference tables as adapters over the driver tables in ``sf_dir``."""
        from care_analytics.sources import fixtures  # only here: test adapters

        raw: dict[str, DataFrame] = {}
        views: dict[str, DataFrame] = {}

        def resolve(name: str) -> DataFrame:
            if name in fixtures.VIEWS:
                if name not in views:
                    views[name] = fixtures.build_view(spark, name, resolve)
                return views[name]
            if name not in raw:
                raw[name] = spark.read.parquet(os.path.join(sf_dir, f"{name}.parquet"))
            return raw[name]

        def load(name: str) -> DataFrame:
            view = fixtures.REFERENCE_TABLES.get(name, name)
            return resolve(view)

        tables = cls(spark, load)
        tables.view = resolve  # adapters by fx_* name, for operator queries
        return tables

    @classmethod
    def from_parquet(cls, spark: SparkSession, root: str) -> "Tables":
        """One Parquet dataset per reference table: ``{root}/{name}``."""
        return cls(spark, lambda name: spark.read.parquet(os.path.join(root, name)))

    @classmethod
    def from_catalog(cls, spark: SparkSession, database: str | None = None) -> "Tables":
        """Tables registered in the session catalog (optionally in a database)."""
        prefix = f"{database}." if database else ""
        return cls(spark, lambda name: spark.table(prefix + name))


def materialize(tables: Tables, names, out_root: str, mode: str = "overwrite",
                files: int | None = None) -> None:
    """Write reference tables to ``{out_root}/{name}`` as Parquet.

    Used by the benchmark so that reports read stored tables, as they do in
    production, instead of re-deriving the adapters on every run.  ``files``
    spreads each table over that many files; by default the adapter's own
    partitions are written.
    """
    for name in names:
        df = tables[name] if files is None else tables[name].repartition(files)
        df.write.mode(mode).parquet(os.path.join(out_root, name))


# Layout of stored tables: the key whose rows stand in one bucket, and the columns
# that rows are sorted by in a file.  Client- and employee-keyed tables share their
# buckets, so joins and latest rows per client need no shuffle; sorting by the end
# lets a period skip the row groups that ended before it.
LAYOUT: dict[str, tuple[str, tuple[str, ...]]] = {
    "clients": ("objectId", ("objectId",)),
    "care_allocations": ("clientObjectId", ("dateEnd", "dateBegin")),
    "location_assignments": ("clientObjectId", ("endDate", "beginDate")),
    "relations": ("clientObjectId", ("updatedAt",)),
    "legitimaties": ("clientObjectId", ("tot", "van")),
    "cbsbj_jeugdhulps": ("clientObjectId", ("datumBeeindiging", "datumAanvang")),
    "employees": ("objectId", ("objectId",)),
    "contracts": ("employeeObjectId", ("endDate", "beginDate")),
    "team_assignments": ("employeeObjectId", ("endDate", "beginDate")),
    "expertise_profile_assignments": ("employeeObjectId", ("endTime", "startTime")),
    "expenses": ("employeeObjectId", ("expenseDate",)),
    "presence_logs": ("employeeId", ("startDate",)),
    "moves_shift_assignments": ("employee_id", ("date",)),
    "survey_results": ("objectId", ("objectId",)),
    "survey_answers": ("surveyResultObjectId", ("surveyResultObjectId", "objectId")),
    "documents": ("objectId", ("objectId",)),
    "document_expertise_groups": ("documentObjectId", ("documentObjectId",)),
    "document_rights": ("documentObjectId", ("documentObjectId",)),
    "document_tags": ("documentObjectId", ("documentObjectId",)),
}


def store(tables: Tables, names, root: str, database: str, buckets: int, **options) -> Tables:
    """Write reference tables under ``{root}/{name}`` as catalog tables of ``database``
    with the buckets and the order of :data:`LAYOUT`, and return them.

    ``buckets`` should give files of some hundred megabytes in the largest table.
    ``options`` go to the Parquet writer.
    """
    tables.spark.sql(f"CREATE DATABASE IF NOT EXISTS {database}")
    for name in names:
        df, place = tables[name], {"path": os.path.join(root, name), **options}
        if name in LAYOUT:
            key, order = LAYOUT[name]
            # each bucket is one file
            writer = df.repartition(buckets, key).write.bucketBy(buckets, key).sortBy(*order)
        else:
            writer = df.write
        writer.options(**place).mode("overwrite").format("parquet").saveAsTable(f"{database}.{name}")
    return Tables.from_catalog(tables.spark, database)

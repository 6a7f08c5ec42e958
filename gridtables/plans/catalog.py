"""Stored tables under names of the session's catalog.

A versioned table is two views: ``name`` has the rows valid now, as the reporting view shows them, ``name_versions`` all versions. Each is
defined over the files of the committed run, so a reader of the name never sees part of a run; ``publish`` after a run points them to
the new files and gives columns that came later, null in older versions. Tables of a commit (see ``sources.commits``) are one view each.
Names are renamed with ``ALTER VIEW``, which leaves the files alone; ``publish`` under the new name goes on from there.
"""

from __future__ import annotations

import json
from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.types import StructField, StructType

from gridtables.operators import scd2
from gridtables.plans import versioned
from gridtables.sources import commits


def _quoted(name: str) -> str:
    return ".".join(f"`{part.replace('`', '``')}`" for part in name.split("."))


def _files(paths: Sequence[str], held: StructType, wanted: Sequence[StructField]) -> list[str]:
    """A SELECT for each folder: the wanted columns, null where its files lack them."""
    columns = ", ".join(
        _quoted(f.name) if f.name in held.fieldNames() else f"CAST(NULL AS {f.dataType.simpleString()}) AS {_quoted(f.name)}" for f in wanted)
    return [f"SELECT {columns} FROM parquet.{_quoted_path(p)}" for p in paths]


def _quoted_path(path: str) -> str:
    return f"`{path.replace('`', '``')}`"


def publish(spark: SparkSession, name: str, root: str) -> None:
    """Points the views ``name`` and ``name_versions`` to the last committed run of the versioned table under ``root``."""
    current, past = versioned.committed(spark, root)
    if current is None:
        raise ValueError(f"no committed run under {root}")
    schema = spark.read.parquet(current).schema
    selects = _files([current], schema, schema.fields)
    # history of runs before a column came has files without it
    for path in past:
        selects += _files([path], spark.read.parquet(path).schema, schema.fields)
    spark.sql(f"CREATE OR REPLACE VIEW {_quoted(name + '_versions')} AS {' UNION ALL '.join(selects)}")
    now = ", ".join([_quoted(scd2.ID), *[_quoted(f.name) for f in schema if f.name not in (scd2.ID, scd2.FROM, scd2.TO)],
                     f"{_quoted(scd2.FROM)} AS last_modified_dttm"])
    spark.sql(f"CREATE OR REPLACE VIEW {_quoted(name)} AS SELECT {now} FROM {_quoted(name + '_versions')} "
              f"WHERE {_quoted(scd2.TO)} = TIMESTAMP_NTZ '{scd2.OPEN_END}'")


def publish_parts(spark: SparkSession, name: str, root: str, table: str) -> None:
    """Points the view ``name`` to a table of the last commit under ``root``."""
    mine = [p for p in commits.parts(spark, root) if p.table == table]
    if not mine:
        raise ValueError(f"{table} has no parts under {root}")
    schemas = {p.part: StructType.fromJson(json.loads(p.schema)) for p in mine}
    wanted = {f.name: f for schema in schemas.values() for f in schema}
    selects = [s for p in mine for s in _files([f"{root}/{p.part}"], schemas[p.part], [*wanted.values()])]
    spark.sql(f"CREATE OR REPLACE VIEW {_quoted(name)} AS {' UNION ALL '.join(selects)}")


def rename(spark: SparkSession, old: str, new: str) -> None:
    """Renames the views of a versioned table; the one over the other is defined anew."""
    spark.sql(f"ALTER VIEW {_quoted(old + '_versions')} RENAME TO {_quoted(new + '_versions')}")
    columns = ", ".join(_quoted(c) if c != "last_modified_dttm" else f"{_quoted(scd2.FROM)} AS last_modified_dttm" for c in _columns(spark, new))
    spark.sql(f"CREATE OR REPLACE VIEW {_quoted(new)} AS SELECT {columns} FROM {_quoted(new + '_versions')} "
              f"WHERE {_quoted(scd2.TO)} = TIMESTAMP_NTZ '{scd2.OPEN_END}'")
    spark.sql(f"DROP VIEW {_quoted(old)}")


def _columns(spark: SparkSession, name: str) -> list[str]:
    return [c for c in read(spark, f"{name}_versions").columns if c not in (scd2.FROM, scd2.TO)] + ["last_modified_dttm"]


def read(spark: SparkSession, name: str) -> DataFrame:
    return spark.table(_quoted(name))

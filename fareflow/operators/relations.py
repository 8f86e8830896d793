"""Finding tables of the session catalog by name."""

from __future__ import annotations

import re

from pyspark.sql import DataFrame, SparkSession


def like_regex(pattern: str) -> re.Pattern:
    """A case-insensitive expression for a LIKE pattern (``%`` any text, ``_`` one character)."""
    body = "".join({"%": ".*", "_": "."}.get(c, re.escape(c)) for c in pattern)
    return re.compile(f"^{body}$", re.IGNORECASE | re.DOTALL)


def tables_like(
    spark: SparkSession, schema_pattern: str, table_pattern: str, exclude: str = ""
) -> dict[str, DataFrame]:
    """Tables and views by schema and name pattern, sorted by name; temp views have schema ''."""
    schema_ok, table_ok, left_out = map(like_regex, (schema_pattern, table_pattern, exclude))
    found = {}
    for database in spark.catalog.listDatabases():
        for table in spark.catalog.listTables(database.name):
            schema = ".".join(table.namespace or [])
            if (schema_ok.match(schema) and table_ok.match(table.name)
                    and not left_out.match(table.name)):
                full = f"{schema}.{table.name}" if schema else table.name
                found[full] = spark.table(full)
    return dict(sorted(found.items()))


def tables_with_prefix(
    spark: SparkSession, schema: str, prefix: str, exclude: str = ""
) -> dict[str, DataFrame]:
    return tables_like(spark, schema, f"{prefix}%", exclude)

"""Name -> query and name -> SQL of everything outside the corpus subpackage."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from ledgerline.plans import domain, evidence, relational

FLAGSHIP = "entity_rollup"
QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {**relational.QUERIES, **domain.QUERIES, **evidence.QUERIES}
SQL: dict[str, str] = {**relational.SQL, **domain.SQL, **evidence.SQL}

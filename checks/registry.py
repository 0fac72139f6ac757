"""Where a module of queries collects them."""

from __future__ import annotations

from checks.fixtures import Fixtures, duckdb_sql


class Registry:
    """Queries by name with, where one exists, the DuckDB text giving the same rows."""

    def __init__(self):
        self.queries, self.oracles = {}, {}

    def __call__(self, name, sql=None):
        def add(fn):
            self.queries[name] = lambda spark, sf_dir: fn(Fixtures(spark, sf_dir))
            if sql:
                self.oracles[name] = duckdb_sql(sql)
            return fn
        return add

"""Registered queries: ``(spark, sf_dir) -> DataFrame`` plus DuckDB oracle SQL.

Importing :mod:`quire.plans.catalog` imports every family module, which
registers its queries through :func:`quire.plans.registry.query`.
"""

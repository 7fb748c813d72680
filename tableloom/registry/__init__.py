"""Registered queries with the SQL that checks them."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from tableloom.session import Tables

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def query(name: str, sql: str | None = None):
    """Register ``fn(tables) -> DataFrame`` under ``name``, with SQL when there is one."""

    def register(fn: Callable[[Tables], DataFrame]):
        if name in QUERIES:
            raise ValueError(f"{name} is registered twice")
        QUERIES[name] = lambda spark, directory: fn(Tables(spark, directory))
        if sql is not None:
            ORACLES[name] = sql
        return fn

    return register


def sql_draw(seed: int, *parts: str) -> str:
    """The SQL text of :func:`tableloom.functions.draws.draw`; ``parts`` are SQL expressions."""
    args = ", ".join([f"'{seed}'"] + [f"CAST({p} AS VARCHAR)" for p in parts])
    return f"CAST(('0x' || substr(md5(concat_ws(':', {args})), 1, 15)) AS BIGINT)"


def sql_unit(draw: str, plus: int = 0) -> str:
    """The SQL text of a double in [0, 1) made of the first 52 bits of a draw."""
    return f"((({draw}) >> 8) + {plus}) / CAST(4503599627370496 AS DOUBLE)"


def load_all() -> None:
    from importlib import import_module

    for module in MODULES:
        import_module(f"tableloom.registry.{module}")


MODULES = ["bayes", "flow", "scalars", "logs", "evolve", "tensor", "web", "io"]

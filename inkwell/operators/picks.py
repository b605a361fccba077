"""Picking rows: first wins, preferences, latest states, gaps and updates."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def first_wins(df: DataFrame, keys: list[str], order: list[str | Column], *, drop_null_keys: list[str] = ()) -> DataFrame:
    """One row for each key: the first by ``order`` (which must be unique within a key)."""
    rows = df.na.drop(subset=list(drop_null_keys)) if drop_null_keys else df
    rank = F.row_number().over(Window.partitionBy(*keys).orderBy(*order))
    return rows.withColumn("__rank", rank).where("__rank = 1").drop("__rank")


def numbered(df: DataFrame, keys: list[str], order: list[str | Column], name: str = "n") -> DataFrame:
    """Numbers from 1 within each key."""
    return df.withColumn(name, F.row_number().over(Window.partitionBy(*keys).orderBy(*order)))


def prefer(df: DataFrame, keys: list[str], choices: list[Column], order: list[str | Column]) -> DataFrame:
    """One row for each key by the first of ``choices`` that holds for any of its rows; none if none holds."""
    rank = reduce(lambda rest, k: F.when(choices[k], F.lit(k)).otherwise(rest), range(len(choices) - 1, -1, -1), F.lit(None).cast("int"))
    ranked = df.withColumn("__choice", rank).where(F.col("__choice").isNotNull())
    return first_wins(ranked, keys, ["__choice", *order]).drop("__choice")


def in_scope(mods: str | Column, mod: str | Column, field: str = "mod_abbreviation") -> Column:
    """A file without mods is everyone's; so is one with a null mod; else one of its mods must be ``mod``."""
    mods = F.col(mods) if isinstance(mods, str) else mods
    mod = F.lit(mod) if isinstance(mod, str) else mod
    return F.coalesce(F.size(mods), F.lit(0)).isin(0, -1) | F.exists(mods, lambda m: m[field].isNull() | (m[field] == mod))


def strictly_in_scope(mods: str, mod: str, field: str = "mod_abbreviation") -> Column:
    """Only a file that names ``mod``."""
    return F.coalesce(F.exists(F.col(mods), lambda m: F.coalesce(m[field] == mod, F.lit(False))), F.lit(False))


def named_scope(mods: str, field: str = "mod_abbreviation") -> Column:
    return F.coalesce(F.exists(F.col(mods), lambda m: m[field].isNotNull()), F.lit(False))


def latest_state(events: DataFrame, job: str = "job_id", order: str = "seq") -> DataFrame:
    """The current state of each job: its last event, by a partial aggregate."""
    rest = [c for c in events.columns if c not in (job,)]
    return events.groupBy(job).agg(F.max_by(F.struct(*rest), order).alias("__last")).select(job, "__last.*")


def missing(wanted: DataFrame, there: DataFrame, on: list[str]) -> DataFrame:
    return wanted.join(there, on, "left_anti")


def updated(df: DataFrame, changes: DataFrame, on: list[str], column: str, new: str) -> DataFrame:
    """``df`` with ``column`` replaced where ``changes`` has a value; nothing else is touched."""
    names = df.columns
    own = changes.select(*on, F.col(new).alias("__new"))
    return df.join(own, on, "left").withColumn(column, F.coalesce("__new", column)).select(*names)


def append_new(existing: DataFrame, rows: DataFrame, keys: list[str]) -> DataFrame:
    """Rows whose key is not yet there: an idempotent append (already present counts as success)."""
    fresh = first_wins(rows, keys, [F.to_json(F.struct(*rows.columns))])
    return fresh.join(existing.select(*keys).distinct(), keys, "left_anti")


def keep_unknown_dates(date: Column, floor: Column) -> Column:
    return date.isNull() | (date >= floor)

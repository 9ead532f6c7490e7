"""Days of a table, written aside and put in place by renaming.

A table's folder holds one folder for each day, and beside them, hidden from readers, what
is being written. A day is switched when all of its files are there: the old folder is moved
aside and the new one into its place, and only then is the old one removed. A write that is
cut short leaves every day as it was. If a switch itself is cut short, between its two
renames, the next write to the table puts the old day back first. Tables have one writer at a time,
and lie on a file system whose renames are single steps.
"""

from __future__ import annotations

import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import SparkSession

from cardvigil.session import listed, make_folder, move_folder, remove_folder

_NEW, _OLD = "_new-", "_old-"


@contextmanager
def beside(spark: SparkSession, table: str) -> Iterator[str]:
    """A folder inside the table's that readers do not see, removed at the end, also of a failure."""
    path = f"{table.rstrip('/')}/{_NEW}{uuid.uuid4().hex}"
    try:
        yield path
    finally:
        remove_folder(spark, path)


def _day_folders(spark: SparkSession, path: str, date_column: str) -> list[str]:
    return [name for name in listed(spark, path) if name.startswith(f"{date_column}=")]


def recover(spark: SparkSession, table: str, date_column: str) -> list[str]:
    """Puts back the days that a switch cut short has moved aside; returns their folders' names."""
    back = []
    for aside in (f"{table.rstrip('/')}/{name}" for name in listed(spark, table) if name.startswith(_OLD)):
        missing = set(_day_folders(spark, aside, date_column)) - set(_day_folders(spark, table, date_column))
        for day in sorted(missing):
            move_folder(spark, f"{aside}/{day}", f"{table.rstrip('/')}/{day}")
            back.append(day)
        remove_folder(spark, aside)
    return back


def publish_days(spark: SparkSession, made: str, table: str, date_column: str) -> None:
    """Puts the days below ``made``, a folder from :func:`beside`, in place of those of the table."""
    table = table.rstrip("/")
    make_folder(spark, table)
    recover(spark, table, date_column)
    known = set(_day_folders(spark, table, date_column))
    aside = f"{table}/{_OLD}{uuid.uuid4().hex}"
    make_folder(spark, aside)
    for day in _day_folders(spark, made, date_column):
        if day in known:
            move_folder(spark, f"{table}/{day}", f"{aside}/{day}")
        move_folder(spark, f"{made}/{day}", f"{table}/{day}")
    remove_folder(spark, aside)

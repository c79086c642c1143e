"""Versioned folders: data is written beside the older versions, and one small
file makes it the current one (B3, B8).

    table/v-3f1c.../part-*.parquet      a version
    table/_version-000000000007         its name; the highest number is current

A pointer is written under another name and renamed to its number, which fails
if the number is taken, so each commit is one atomic step and a reader sees the
old version or the new one, never none. The version before the current one
stays for queries that are still reading it; older ones are deleted.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrameWriter, SparkSession

from . import files

POINTER = "_version-"
VERSION = "v-"


def _children(spark: SparkSession, folder: str) -> list[str]:
    hpath, fs = files._fs(spark, folder)
    return [st.getPath().getName() for st in fs.listStatus(hpath)] if fs.exists(hpath) else []


def _pointers(spark: SparkSession, folder: str) -> list[int]:
    return sorted(int(n[len(POINTER):]) for n in _children(spark, folder) if n.startswith(POINTER))


def _pointer(folder: str, number: int) -> str:
    return f"{folder}/{POINTER}{number:012d}"


def current(spark: SparkSession, folder: str) -> str | None:
    """The folder that holds the current data: the newest committed version, or
    ``folder`` itself where it holds unversioned files; None if there is none."""
    folder = folder.rstrip("/")
    numbers = _pointers(spark, folder)
    if numbers:
        return f"{folder}/{files.read_text(spark, _pointer(folder, numbers[-1]))}"
    plain = [n for n in _children(spark, folder) if not n.startswith((VERSION, "_", "."))]
    return folder if plain else None


def fresh(folder: str) -> str:
    """The path of a new version, not visible until ``commit``."""
    return f"{folder.rstrip('/')}/{VERSION}{uuid.uuid4().hex[:12]}"


def commit(spark: SparkSession, version: str) -> int:
    """Make a written version the current one of its folder; of two writers at
    once the later commit wins. Returns its number."""
    folder, name = version.rsplit("/", 1)
    draft = f"{folder}/_draft-{uuid.uuid4().hex[:12]}"
    files.write_text(spark, draft, name)
    number = (_pointers(spark, folder) or [0])[-1] + 1
    while not files.rename_new(spark, draft, _pointer(folder, number)):
        number += 1
    for old in _pointers(spark, folder):
        if old < number - 1:
            files.delete(spark, f"{folder}/{files.read_text(spark, _pointer(folder, old))}")
            files.delete(spark, _pointer(folder, old))
    return number


def write(spark: SparkSession, writer: DataFrameWriter, folder: str) -> str:
    """Write Parquet as the new current version; a failed write leaves the
    current one as it was."""
    version = fresh(folder)
    try:
        writer.parquet(version)
    except Exception:
        files.delete(spark, version)
        raise
    commit(spark, version)
    return version

"""One commit for the lake and its manifest (B1 + B9).

A run writes its quarters and the new manifest into a folder of its own beside
the lake, then a journal that names them: from that step on the run counts as
done. Moving the quarters and the manifest into place only carries the journal
out, and can be repeated. A run that stopped before its journal is undone by
the next one (``recover``), one that stopped after it is completed.

One run at a time may ingest into a lake.
"""

from __future__ import annotations

import json
import uuid

from pyspark.sql import SparkSession

from . import files

_RUN = ".__ingest-"
_JOURNAL = "journal.json"


def staging(lake_dir: str) -> str:
    """A fresh folder for one run's output, beside the lake."""
    return f"{lake_dir.rstrip('/')}{_RUN}{uuid.uuid4().hex[:12]}"


def rows_dir(run: str) -> str:
    return f"{run}/rows"


def manifest_file(run: str) -> str:
    return f"{run}/manifest.json"


def quarter_dir(root: str, quarter: tuple[int, int]) -> str:
    return f"{root.rstrip('/')}/year={quarter[0]}/quarter={quarter[1]}"


def finish(spark: SparkSession, run: str, lake_dir: str, manifest_path: str,
           written: list[tuple[int, int]], emptied: list[tuple[int, int]]) -> None:
    """Commit a run whose quarters and manifest are staged, and carry it out."""
    entry = {"lake": lake_dir.rstrip("/"), "manifest": manifest_path, "written": written, "emptied": emptied}
    draft = f"{run}/_draft"
    files.write_text(spark, draft, json.dumps(entry))
    if not files.rename_new(spark, draft, f"{run}/{_JOURNAL}"):
        raise RuntimeError(f"could not write the journal of {run}")
    _carry_out(spark, run)


def _carry_out(spark: SparkSession, run: str) -> None:
    """Every step may have been done before, by a run that stopped half way."""
    entry = json.loads(files.read_text(spark, f"{run}/{_JOURNAL}"))
    for quarter in entry["written"]:
        staged = quarter_dir(rows_dir(run), quarter)
        if files.found(spark, staged):
            files.move_over(spark, staged, quarter_dir(entry["lake"], quarter))
    for quarter in entry["emptied"]:
        files.delete(spark, quarter_dir(entry["lake"], quarter))
    files.copy_file(spark, manifest_file(run), entry["manifest"])
    files.delete(spark, f"{run}/{_JOURNAL}")
    files.delete(spark, run)
    if files.found(spark, entry["lake"]):
        spark.catalog.refreshByPath(entry["lake"])


def recover(spark: SparkSession, lake_dir: str) -> dict[str, list[str]]:
    """Complete or undo the runs that stopped: their folders, by outcome."""
    done: dict[str, list[str]] = {"completed": [], "undone": []}
    for run in files.folders(spark, f"{lake_dir.rstrip('/')}{_RUN}*"):
        if files.found(spark, f"{run}/{_JOURNAL}"):
            _carry_out(spark, run)
            done["completed"].append(run)
        else:
            files.delete(spark, run)
            done["undone"].append(run)
    return done

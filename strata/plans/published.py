"""Views as numbered versions: readers see one whole set of views, or the one before.

Writing over a folder deletes before it writes, so its readers meet a gap, and
a job that fails in between leaves nothing. Here every write of a view goes to a
folder of its own, ``<base>/<view>/write=<id>``, and becomes visible when the next
version of the set, a small JSON file under ``<base>/_versions``, names it. All
views of a job come in one version, so they always belong together. A version is
never changed; of two writers that publish at once the later one adds its views
to the other's version.

A view with a ``date`` has one folder a day, and a version names each: a job for
some days replaces those and takes all others over from the version before.
"""

from __future__ import annotations

import json
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

from ..functions.time import parse_day
from ..session import path_exists, remove_path, subfolders
from ..store import newest_number, publish, read_text

#: The only part of a view without days.
WHOLE = ""


def _versions(base: str) -> str:
    return f"{base.rstrip('/')}/_versions"


def view_versions(spark: SparkSession, base: str, version: int | None = None) -> tuple[int, dict]:
    """The newest version of a set, or a given one: its number (0: none yet) and
    ``{view: {"schema", "format", "parts": {day: folder}}}``."""
    number = newest_number(spark, _versions(base)) if version is None else version
    return number, json.loads(read_text(spark, f"{_versions(base)}/{number:09d}.json")) if number else {}


def _write(spark: SparkSession, df: DataFrame, base: str, folder: str, fmt: str) -> dict:
    dated = "date" in df.columns
    w = df.hint("rebalance", "date").write.partitionBy("date") if dated else df.write
    w.format(fmt).save(f"{base}/{folder}")
    parts = {WHOLE: folder}
    if dated:
        days = (f for f in subfolders(spark, f"{base}/{folder}") if f.startswith("date="))
        parts = {f.split("=", 1)[1]: f"{folder}/{f}" for f in days}
    return {"schema": df.schema.json(), "format": fmt, "parts": parts}


def publish_views(spark: SparkSession, computed: dict[str, DataFrame], base: str, fmt: str = "parquet",
                  days=None) -> int:
    """Write the views, then show all of them at once; the version that does.

    With ``days`` views that have a ``date`` replace exactly those days (a day
    without rows loses its part) and keep the rest. Views of the set that are not
    among ``computed`` stay as they are. If a write fails, nothing of this call
    is shown or kept."""
    base = base.rstrip("/")
    asked = None if days is None else {parse_day(d).isoformat() for d in days}
    folders, written = [], {}
    try:
        for name, df in computed.items():
            folders.append(f"{name}/write={uuid.uuid4().hex}")
            written[name] = _write(spark, df, base, folders[-1], fmt)
        while True:
            number, views = view_versions(spark, base)
            for name, new in written.items():
                old = views.get(name)
                if asked is not None and old is not None and "date" in computed[name].columns:
                    if (old["schema"], old["format"]) != (new["schema"], new["format"]):
                        raise ValueError(f"{name} has other columns or another format than its other days")
                    kept = {d: p for d, p in old["parts"].items() if d not in asked}
                    new = {**new, "parts": kept | {d: p for d, p in new["parts"].items() if d in asked}}
                views[name] = new
            if publish(spark, _versions(base), number + 1, json.dumps(views)):
                return number + 1
    except BaseException:
        for folder in folders:
            remove_path(spark, f"{base}/{folder}")
        raise


def read_view(spark: SparkSession, base: str, name: str, version: int | None = None, days=None) -> DataFrame:
    """A view as its newest version (or a given one) has it. Only that version's
    folders are listed; with ``days`` only those days'. Later versions do not
    change what was read, until ``vacuum_views`` removes this one."""
    base = base.rstrip("/")
    number, views = view_versions(spark, base, version)
    if name not in views:
        raise ValueError(f"version {number} of {base} has no view {name}")
    view = views[name]
    schema = T.StructType.fromJson(json.loads(view["schema"]))
    asked = None if days is None else {parse_day(d).isoformat() for d in days}
    paths = sorted(f"{base}/{p}" for d, p in view["parts"].items() if asked is None or d == WHOLE or d in asked)
    if not paths:
        return spark.createDataFrame([], schema)
    rows = spark.read.schema(schema).option("basePath", f"{base}/{name}").format(view["format"]).load(paths)
    return rows.select(*schema.fieldNames())


def vacuum_views(spark: SparkSession, base: str, keep: int = 2) -> int:
    """Remove all versions but the newest ``keep`` and the folders that only they
    name (their readers must have ended). The number of folders removed."""
    base = base.rstrip("/")
    newest = newest_number(spark, _versions(base))

    def named(number: int) -> set[str]:
        return {p for v in view_versions(spark, base, number)[1].values() for p in v["parts"].values()}
    shown = set().union(*(named(n) for n in range(max(1, newest - keep + 1), newest + 1)))
    gone, n = set(), newest - keep
    while n > 0 and path_exists(spark, f"{_versions(base)}/{n:09d}.json"):
        gone |= named(n) - shown
        remove_path(spark, f"{_versions(base)}/{n:09d}.json")
        n -= 1
    writes = lambda paths: {"/".join(p.split("/")[:2]) for p in paths}
    for path in gone | (writes(gone) - writes(shown)):  # days, and writes of which no day is left
        remove_path(spark, f"{base}/{path}")
    return len(gone)

"""The store's manifest: which folders readers see, as numbered versions.

A load is written under ``<base>/part=<id>/data_type=/status=/year=/month=/day=``
(the hour is a column of the files, so a small load makes one file a day) and
becomes visible when the next version of the manifest, a small JSON file under
``<base>/_versions``, names its day folders. A version is never changed, and
its file is renamed into place only if there is none of that number, so of two
writers one succeeds and the other reads again and retries. A reader takes the
newest version once and keeps to its folders: it sees all of a load or nothing.

``compact_store`` merges the day folders of many loads into one, with an
``hour=`` level where a day is large, and swaps them in one version. The folders
before it stay for their readers until ``vacuum``.

The manifest holds a line for each visible day folder. It grows with loads only
between compactions, and then with days.
"""

from __future__ import annotations

import datetime as dt
import json
import logging
import re
import uuid
from dataclasses import asdict, dataclass, field
from urllib.parse import unquote

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .schemas import META_FIELDS, PART_COLUMNS, PARTITION_COLUMNS, RECORD
from .session import path_exists, remove_path, subfolders

log = logging.getLogger(__name__)

_NO_DAY = "__HIVE_DEFAULT_PARTITION__"

#: Bytes of a merged day from which on it gets a folder for each hour. A smaller
#: one is a few files, in which the rows of an hour stand together.
HOUR_BYTES = 256 << 20

#: Columns of the stored files: a record's fields, or a quarantined record's
#: text and metadata; the load it came with, and its hour.
STORED = T.StructType([
    *(T.StructField(f.name, T.TimestampType() if f.name == "timestamp" else f.dataType) for f in RECORD.fields),
    T.StructField("_rescued", T.StringType()), T.StructField("value", T.StringType()), *META_FIELDS,
    T.StructField("load", T.StringType()),
    T.StructField("data_type", T.StringType()), T.StructField("status", T.StringType()),
    *(T.StructField(c, T.IntegerType()) for c in PARTITION_COLUMNS)])


@dataclass
class Part:
    """One visible day folder. ``loads``: names of the loads whose rows it
    holds (``add_load``); ``changed``: the version that last changed its rows."""
    path: str
    data_type: str
    status: str
    day: str | None
    changed: int
    loads: dict = field(default_factory=dict)
    by_hour: bool = False

    @property
    def key(self) -> tuple:
        return self.data_type, self.status, self.day


@dataclass
class Manifest:
    version: int = 0
    parts: list[Part] = field(default_factory=list)
    #: data_type -> day -> version that last changed it, also by taking rows away.
    touched: dict = field(default_factory=dict)

    def touch(self, parts: list[Part], version: int) -> None:
        for p in parts:
            if p.status == "ok" and p.day is not None:
                self.touched.setdefault(p.data_type, {})[p.day] = version


# --- names of loads -------------------------------------------------------------------------------

def _split(load: str) -> tuple[str, int | None]:
    m = re.fullmatch(r"(.*)-(0|[1-9]\d{0,17})", load, re.S)
    return (m[1], int(m[2])) if m else (load, None)


def add_load(loads: dict, load: str) -> dict:
    """Names with a number at the end (micro-batches) are kept as ranges:
    ``{"<prefix>": {"named": bool, "ranges": [[low, high], ...]}}``."""
    prefix, number = _split(load)
    own = loads.setdefault(prefix, {"named": False, "ranges": []})
    if number is None:
        own["named"] = True
    else:
        own["ranges"] = _joined([*own["ranges"], [number, number]])
    return loads


def _joined(ranges: list) -> list:
    out: list[list[int]] = []
    for low, high in sorted(ranges):
        if out and low <= out[-1][1] + 1:
            out[-1][1] = max(out[-1][1], high)
        else:
            out.append([low, high])
    return out


def merge_loads(parts: list[Part]) -> dict:
    out: dict = {}
    for p in parts:
        for prefix, own in p.loads.items():
            held = out.setdefault(prefix, {"named": False, "ranges": []})
            held["named"] |= own["named"]
            held["ranges"] = _joined([*held["ranges"], *own["ranges"]])
    return out


def holds(loads: dict, load: str) -> bool:
    prefix, number = _split(load)
    own = loads.get(prefix)
    if own is None:
        return False
    return own["named"] if number is None else any(low <= number <= high for low, high in own["ranges"])


def _only(loads: dict, load: str) -> bool:
    return loads == add_load({}, load)


# --- versions -------------------------------------------------------------------------------------

def _fs(spark: SparkSession, path: str):
    p = spark._jvm.org.apache.hadoop.fs.Path(path)
    return p, p.getFileSystem(spark._jsc.hadoopConfiguration())


def newest_number(spark: SparkSession, folder: str) -> int:
    """The highest number among ``<folder>/<number>.json`` (0: none)."""
    p, fs = _fs(spark, folder)
    names = [f.getPath().getName() for f in fs.listStatus(p)] if fs.exists(p) else []
    return max((int(n[:-5]) for n in names if re.fullmatch(r"\d+\.json", n)), default=0)


def read_text(spark: SparkSession, path: str) -> str:
    p, fs = _fs(spark, path)
    stream = fs.open(p)
    try:
        return spark._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
    finally:
        stream.close()


def publish(spark: SparkSession, folder: str, number: int, text: str) -> bool:
    """Write ``<folder>/<number>.json`` as a whole, unless there is one: whether
    this call did."""
    target, fs = _fs(spark, f"{folder}/{number:09d}.json")
    made, _ = _fs(spark, f"{folder}/.{uuid.uuid4().hex}.tmp")
    if fs.exists(target):
        return False
    out = fs.create(made, True)
    try:
        out.write(bytearray(text.encode()))
    finally:
        out.close()
    context = spark._jvm.org.apache.hadoop.fs.FileContext.getFileContext(made.toUri(), spark._jsc.hadoopConfiguration())
    kind = spark._jvm.org.apache.hadoop.fs.Options.Rename
    options = spark._sc._gateway.new_array(kind, 1)
    options[0] = kind.NONE  # fails if the target exists
    try:
        context.rename(fs.makeQualified(made), fs.makeQualified(target), options)
    except Exception as e:  # noqa: BLE001
        fs.delete(made, False)
        if fs.exists(target):
            return False
        raise RuntimeError(f"cannot publish {target}") from e
    return True


def _versions(base: str) -> str:
    return f"{base.rstrip('/')}/_versions"


def load_manifest(spark: SparkSession, base: str, version: int | None = None) -> Manifest | None:
    """The newest version, or a given one; None for a store without any."""
    number = newest_number(spark, _versions(base)) if version is None else version
    if not number:
        return None
    held = json.loads(read_text(spark, f"{_versions(base)}/{number:09d}.json"))
    return Manifest(number, [Part(**p) for p in held["parts"]], held["touched"])


def _publish(spark: SparkSession, base: str, m: Manifest) -> bool:
    text = json.dumps({"parts": [asdict(p) for p in m.parts], "touched": m.touched})
    return publish(spark, _versions(base), m.version, text)


# --- folders --------------------------------------------------------------------------------------

def new_part(base: str) -> str:
    return f"{base.rstrip('/')}/part={uuid.uuid4().hex}"


def _found(spark: SparkSession, base: str, folder: str, by_hour: bool) -> list[Part]:
    """The day folders of a part that was just written."""
    levels = "/".join(f"{c}=*" for c in PART_COLUMNS)
    p, fs = _fs(spark, f"{folder}/{levels}")
    out = []
    for f in fs.globStatus(p) or []:
        tail = f.getPath().toString().split(folder.rsplit("/", 1)[1] + "/", 1)[1]
        data_type, status, year, month, day = (unquote(x.split("=", 1)[1]) for x in tail.split("/"))
        out.append(Part(f"{folder.rsplit('/', 1)[1]}/{tail}", "" if data_type == _NO_DAY else data_type, status,
                        None if _NO_DAY in (year, month, day) else f"{int(year):04d}-{month}-{day}", 0, by_hour=by_hour))
    return out


def read_parts(spark: SparkSession, base: str, parts: list[Part], schema: T.StructType = STORED) -> DataFrame:
    """The rows of the given day folders; only they are listed."""
    out = None
    for by_hour in (False, True):
        paths = sorted(f"{base.rstrip('/')}/{p.path}" for p in parts if p.by_hour == by_hour)
        if paths:
            rows = spark.read.schema(schema).option("basePath", base).parquet(*paths).select(*schema.fieldNames())
            out = rows if out is None else out.unionByName(rows)
    return spark.createDataFrame([], schema) if out is None else out


def _write(rows: DataFrame, folder: str, by_hour: bool, max_records_per_file: int) -> None:
    """One job. The ``rebalance`` hint gives evenly sized tasks: small days (or
    hours) share one, a large one is split over several."""
    columns = [*PART_COLUMNS, *(["hour"] if by_hour else [])]
    two = lambda c, n: F.lpad(F.col(c).cast("string"), n, "0")
    rows = rows.withColumns({"year": F.col("year").cast("string"), "month": two("month", 2), "day": two("day", 2),
                             "hour": two("hour", 2) if by_hour else F.col("hour").cast("int")})
    (rows.hint("rebalance", *columns).sortWithinPartitions(*PART_COLUMNS, "hour").write.option("maxRecordsPerFile", max_records_per_file)
     .partitionBy(*columns).parquet(folder))


# --- writing --------------------------------------------------------------------------------------

def _without(spark: SparkSession, base: str, parts: list[Part], load: str, max_records_per_file: int) -> list[Part]:
    """Merged parts written anew, without one load's rows."""
    out = []
    for by_hour in (False, True):
        own = [p for p in parts if p.by_hour == by_hour]
        if own:
            folder = new_part(base)
            _write(read_parts(spark, base, own).where(F.col("load") != load), folder, by_hour, max_records_per_file)
            out += _found(spark, base, folder, by_hour)
    for p in out:
        p.loads = merge_loads([q for q in parts if q.key == p.key])
        p.changed = max(q.changed for q in parts if q.key == p.key)
    return out


def commit_load(spark: SparkSession, base: str, load: str, rows: DataFrame, max_records_per_file: int = 1_000_000) -> int:
    """Write a load's rows and show them, in the place of all that the same
    load wrote before, on whatever days. The version that shows them."""
    base = base.rstrip("/")
    folder = new_part(base)
    _write(rows, folder, False, max_records_per_file)
    found = _found(spark, base, folder, False)
    rewritten: dict[tuple, list[Part]] = {}
    while True:
        m = load_manifest(spark, base) or Manifest()
        version = m.version + 1
        held = [p for p in m.parts if holds(p.loads, load)]
        merged = [p for p in held if not _only(p.loads, load)]
        key = tuple(sorted(p.path for p in merged))
        if merged and key not in rewritten:
            rewritten[key] = _without(spark, base, merged, load, max_records_per_file)
        for p in found:
            p.loads, p.changed = add_load({}, load), version
        gone = {p.path for p in held}
        m = Manifest(version, [p for p in m.parts if p.path not in gone] + rewritten.get(key, []) + found, m.touched)
        m.touch(held + found, version)
        if _publish(spark, base, m):
            return version
        log.info("another writer was first; trying again on version %d", version)


def _bytes(spark: SparkSession, base: str, parts: list[Part]) -> int:
    total = 0
    for part in parts:
        p, fs = _fs(spark, f"{base}/{part.path}")
        total += fs.getContentSummary(p).getLength()
    return total


def compact_store(spark: SparkSession, base: str, max_parts: int = 1, days: list[str] | None = None,
                  hour_bytes: int = HOUR_BYTES, max_records_per_file: int = 1_000_000) -> int | None:
    """Merge the day folders of every entity, status and day that has over
    ``max_parts``, in one job for the large days (``hour_bytes``) and one for the
    rest, and swap them in one version (None: nothing to do).

    Rows stay as they are. Loads that are added meanwhile stay beside the merged
    folders; if one of the merged folders was itself replaced meanwhile, nothing
    is swapped, and the merge starts again."""
    base = base.rstrip("/")
    while True:
        m = load_manifest(spark, base)
        by_key: dict[tuple, list[Part]] = {}
        for p in m.parts if m else []:
            if days is None or p.day in days:
                by_key.setdefault(p.key, []).append(p)
        groups = {k: ps for k, ps in by_key.items() if len(ps) > max_parts}
        if not groups:
            return None
        found, folders = [], []
        large = {k for k, ps in groups.items() if k[2] is not None and _bytes(spark, base, ps) >= hour_bytes}
        for by_hour in (False, True):
            own = [p for k, ps in groups.items() if (k in large) == by_hour for p in ps]
            if own:
                folders.append(new_part(base))
                _write(read_parts(spark, base, own), folders[-1], by_hour, max_records_per_file)
                found += _found(spark, base, folders[-1], by_hour)
        for p in found:
            p.loads, p.changed = merge_loads(groups[p.key]), max(q.changed for q in groups[p.key])
        gone = {p.path for ps in groups.values() for p in ps}
        while gone <= {p.path for p in m.parts}:
            m = Manifest(m.version + 1, [p for p in m.parts if p.path not in gone] + found, m.touched)
            if _publish(spark, base, m):
                return m.version
            m = load_manifest(spark, base)
        for folder in folders:
            remove_path(spark, folder)


def vacuum(spark: SparkSession, base: str, keep: int = 2, orphans_after: dt.timedelta | None = None) -> int:
    """Remove all versions but the newest ``keep`` and the day folders that only
    they show (readers of an older version must have ended). The number of
    folders removed.

    ``orphans_after``: parts that no version shows (a writer failed, or has not
    finished) are removed once they are that old."""
    base = base.rstrip("/")
    newest = newest_number(spark, _versions(base))
    p, fs = _fs(spark, _versions(base))
    numbers = sorted(int(f.getPath().getName()[:-5]) for f in fs.listStatus(p)
                     if re.fullmatch(r"\d+\.json", f.getPath().getName())) if fs.exists(p) else []
    old = [n for n in numbers if n <= newest - keep]
    shown = {q.path for n in numbers if n > newest - keep for q in load_manifest(spark, base, n).parts}
    gone = {q.path for n in old for q in load_manifest(spark, base, n).parts} - shown
    for path in sorted(gone):
        remove_path(spark, f"{base}/{path}")
    for n in old:
        remove_path(spark, f"{_versions(base)}/{n:09d}.json")
    used = {path.split("/", 1)[0] for path in shown}
    for name in {path.split("/", 1)[0] for path in gone} - used:
        remove_path(spark, f"{base}/{name}")
    if orphans_after is not None:
        before = (dt.datetime.now(dt.timezone.utc) - orphans_after).timestamp() * 1000
        for name in subfolders(spark, base):
            if name.startswith("part=") and name not in used:
                folder, _ = _fs(spark, f"{base}/{name}")
                if fs.getFileStatus(folder).getModificationTime() <= before:
                    remove_path(spark, f"{base}/{name}")
    return len(gone)


# --- reading --------------------------------------------------------------------------------------

def touched_days(spark: SparkSession, base: str, data_type: str, since: int = 0) -> tuple[list[str], int]:
    """The days whose stored rows changed after version ``since`` (added,
    replaced or taken away by a load; merging changes none), and the version
    that says so."""
    m = load_manifest(spark, base) or Manifest()
    return sorted(d for d, v in m.touched.get(data_type, {}).items() if v > since), m.version


def has_manifest(spark: SparkSession, base: str) -> bool:
    return path_exists(spark, _versions(base))

"""Tables whose days have versions: copy on write, one atomic pointer per commit, readers pinned to a version.

``{path}/data/commit=<id>/dt=<day>`` holds what one commit wrote of a day, and is never changed afterwards.
``{path}/versions/<number>.json`` is a version: which commit holds each day. Creating that file is the commit: it is
written under another name and renamed without overwriting, so a version appears whole or not at all, and of two writers
one wins. The loser works on what the winner stored. A writer that is killed leaves files that no version names, which no reader
sees and :func:`expire` removes. A frame that was read from a version goes on reading its files until that version expires.
"""

from __future__ import annotations

import json
import time
import uuid
from collections.abc import Callable, Iterable, Sequence
from dataclasses import asdict, dataclass, field
from datetime import date
from typing import Any

from py4j.protocol import Py4JJavaError
from pyspark.sql import Column, DataFrame, SparkSession, functions as F, types as T

from ..operators.keyed import dedupe, insert_ignore, upsert
from .shared import remove, run_folder
from .tables import DT, with_day, write_partitioned

#: Folder name of the rows without a time.
NO_DAY = "__HIVE_DEFAULT_PARTITION__"


class Conflict(Exception):
    """Another writer has committed the version that this one was about to."""


@dataclass(frozen=True)
class Version:
    """One version: the commit of each day, and the last batch taken in from each source."""
    number: int
    committed_at: float
    schema: str
    days: dict[str, str] = field(default_factory=dict)
    sources: dict[str, int] = field(default_factory=dict)

    @property
    def columns(self) -> T.StructType:
        return T.StructType.fromJson(json.loads(self.schema))


@dataclass(frozen=True)
class Staged:
    """Days written by a commit that no version names yet."""
    commit: str
    days: tuple[str, ...]
    schema: str


def _path(spark: SparkSession, path: str) -> Any:
    return spark._jvm.org.apache.hadoop.fs.Path(path)


def _files(spark: SparkSession, path: str) -> Any:
    return _path(spark, path).getFileSystem(spark._jsc.hadoopConfiguration())


def _numbers(spark: SparkSession, path: str) -> list[int]:
    """All versions there are, oldest first."""
    files = _files(spark, path)
    if not files.exists(_path(spark, f"{path}/versions")):
        return []
    names = [status.getPath().getName() for status in files.listStatus(_path(spark, f"{path}/versions"))]
    return sorted(int(name[:-5]) for name in names if name.endswith(".json") and name[:-5].isdigit())


def _pointer(path: str, number: int) -> str:
    return f"{path}/versions/{number:010d}.json"


def is_versioned(spark: SparkSession, path: str) -> bool:
    return bool(_files(spark, path).exists(_path(spark, f"{path}/versions")))


def load(spark: SparkSession, path: str, number: int | None = None) -> Version | None:
    """A version, by default the newest; none if the table has none."""
    if number is None:
        numbers = _numbers(spark, path)
        if not numbers:
            return None
        number = numbers[-1]
    stream = _files(spark, path).open(_path(spark, _pointer(path, number)))
    try:
        return Version(**json.loads(bytes(stream.readAllBytes())))
    finally:
        stream.close()


def _name(day: date | str | None) -> str:
    return NO_DAY if day is None else str(day)


def read(spark: SparkSession, path: str, version: Version | None = None, days: Iterable[date | str | None] | None = None) -> DataFrame:
    """Rows of a version, by default the newest, with their day as ``dt``; of ``days`` only, if given.

    The folders are listed one by one, so other days, commits and versions are neither listed nor read, and commits that follow
    change nothing in the frame.
    """
    version = version or load(spark, path)
    if version is None:
        raise ValueError(f"no version of {path}")
    wanted = version.days if days is None else {_name(d) for d in days} & version.days.keys()
    schema = T.StructType([*version.columns.fields, T.StructField("commit", T.StringType()), T.StructField(DT, T.DateType())])
    folders = sorted(f"{path}/data/commit={version.days[day]}/dt={day}" for day in wanted)
    rows = spark.read.schema(schema).option("basePath", f"{path}/data").parquet(*folders) if folders else spark.createDataFrame([], schema)
    return rows.drop("commit")


def stage(spark: SparkSession, rows: DataFrame, path: str) -> Staged:
    """Write the days of ``rows`` under a new commit that nobody sees yet."""
    commit, rows = uuid.uuid4().hex, rows.drop(DT)
    write_partitioned(rows, f"{path}/data/commit={commit}", mode="errorifexists")
    files, folder = _files(spark, path), _path(spark, f"{path}/data/commit={commit}")
    names = [status.getPath().getName() for status in files.listStatus(folder)]
    return Staged(commit, tuple(sorted(name[len(DT) + 1:] for name in names if name.startswith(f"{DT}="))), rows.schema.json())


def commit(spark: SparkSession, path: str, base: Version | None, staged: Staged, replaced: Iterable[str] = (),
           sources: dict[str, int] | None = None) -> Version:
    """Make the version after ``base``, in which the staged days replace those of the same name and the ``replaced`` ones."""
    gone = {*replaced, *staged.days}
    kept = {} if base is None else {day: c for day, c in base.days.items() if day not in gone}
    made = Version(0 if base is None else base.number + 1, time.time(), staged.schema, {**kept, **dict.fromkeys(staged.days, staged.commit)},
                   {**({} if base is None else base.sources), **(sources or {})})
    if base is not None and base.days and base.schema != made.schema:
        raise ValueError(f"{path} has other columns: {base.columns.simpleString()}, not {made.columns.simpleString()}")
    files, draft = _files(spark, path), f"{path}/versions/draft-{uuid.uuid4().hex}"
    out = files.create(_path(spark, draft), True)
    out.write(bytearray(json.dumps(asdict(made)).encode()))
    out.close()
    target = _path(spark, _pointer(path, made.number))
    qualified = files.makeQualified(target)
    context = spark._jvm.org.apache.hadoop.fs.FileContext.getFileContext(qualified.toUri(), spark._jsc.hadoopConfiguration())
    never = spark.sparkContext._gateway.new_array(spark._jvm.org.apache.hadoop.fs.Options.Rename, 0)
    try:
        context.rename(files.makeQualified(_path(spark, draft)), qualified, never)
    except Py4JJavaError as failed:
        files.delete(_path(spark, draft), False)
        if files.exists(target):
            raise Conflict(f"{path}: version {made.number} is there already") from failed
        raise
    return made


def merge(spark: SparkSession, path: str, changes: DataFrame, rebuild: Callable[[DataFrame | None, DataFrame], DataFrame],
          source: tuple[str, int] | None = None, notes: dict[str, int] | None = None, attempts: int = 5) -> Version | None:
    """Commit ``rebuild(rows of the touched days, changes)`` as the new rows of the days that ``changes`` touch.

    The rows are None where the table has none yet. ``source`` is a name and a growing batch number: a batch that was
    taken in before changes nothing, so a job that repeats it after a crash is safe. ``notes`` are kept with the sources. ``changes``
    is evaluated once. When another writer was faster, the days are built again from what it stored, ``attempts`` times at most.
    """
    def taken(base: Version | None) -> bool:
        return source is not None and base is not None and base.sources.get(source[0], -1) >= source[1]

    if taken(base := load(spark, path)):
        return base
    staging = run_folder(spark, "changes")
    try:
        changes.write.parquet(staging)
        changes = spark.read.schema(changes.schema).parquet(staging)
        touched = [row[0] for row in with_day(changes.select("ts")).select(DT).distinct().collect()]
        for _ in range(attempts):
            base = load(spark, path)
            if taken(base) or base is not None and not touched and source is None:
                return base
            old = read(spark, path, base, touched).drop(DT) if base is not None and base.days else None
            if not touched and base is not None:
                staged = Staged("", (), base.schema)
            else:
                staged = stage(spark, rebuild(old, changes), path)
            try:
                return commit(spark, path, base, staged, map(_name, touched), {**(notes or {}), **(dict([source]) if source else {})})
            except Exception as failed:
                if staged.commit:
                    remove(spark, f"{path}/data/commit={staged.commit}")
                if not isinstance(failed, Conflict):
                    raise
        raise Conflict(f"{path}: other writers were faster {attempts} times")
    finally:
        remove(spark, staging)


def upsert_versioned(spark: SparkSession, updates: DataFrame, path: str, key: Sequence[str], now: Column,
                     order: Sequence[str] = (), source: tuple[str, int] | None = None, notes: dict[str, int] | None = None) -> Version | None:
    """Last write wins. Only the days of the updates are read, and their new state appears at once.

    ``order`` picks among several updates of one key; without it they are an error. A row keeps its ``created_at``.
    """
    if "ts" not in key:
        raise ValueError("the key must hold ts: only the days of the updates are looked at")

    def rebuild(old: DataFrame | None, new: DataFrame) -> DataFrame:
        if not order and new.groupBy(*key).agg(F.count("*").alias("_n")).filter("_n > 1").limit(1).count():
            raise ValueError("several updates of one key: name the order that picks one")
        return new.withColumns({"created_at": now, "updated_at": now}) if old is None else upsert(old, new, key, now)

    return merge(spark, path, dedupe(updates, key, order) if order else updates, rebuild, source, notes)


def insert_versioned(spark: SparkSession, rows: DataFrame, path: str, key: Sequence[str], order: Sequence[str],
                     source: tuple[str, int] | None = None) -> Version | None:
    """First write wins: rows whose key is stored already change nothing."""
    return merge(spark, path, rows, lambda old, new: dedupe(new, key, order, keep="first") if old is None
                 else insert_ignore(old, new, key, order), source)


def create(spark: SparkSession, path: str) -> Version:
    """A table without rows, for writers and readers that ask whether a table is versioned. A plain table stays what it is."""
    made = load(spark, path)
    if made is None and _files(spark, path).exists(_path(spark, path)):
        raise ValueError(f"{path} is there already and has no versions")
    return made or commit(spark, path, None, Staged("", (), T.StructType([]).json()))


def known(spark: SparkSession, path: str, number: int | None) -> Version | None:
    """A version by number, none if it has expired."""
    return load(spark, path, number) if number in _numbers(spark, path) else None


def changed_days(before: Version | None, after: Version) -> list[str]:
    """Days that differ between two versions."""
    old = {} if before is None else before.days
    return sorted(day for day in {*old, *after.days} if old.get(day) != after.days.get(day))


def expire(spark: SparkSession, path: str, keep: int = 10, min_age_seconds: float = 86400.0, now: float | None = None) -> int:
    """Forget all but the newest ``keep`` versions and remove the days that none of them names; returns how many folders went.

    Files younger than ``min_age_seconds`` stay, since a writer may be about to commit them.
    """
    files, numbers = _files(spark, path), _numbers(spark, path)
    limit = ((time.time() if now is None else now) - min_age_seconds) * 1000
    for number in numbers[:-keep]:
        files.delete(_path(spark, _pointer(path, number)), False)
    live = {(c, day) for number in numbers[-keep:] for day, c in load(spark, path, number).days.items()}
    used, gone = {c for c, _ in live}, 0
    if files.exists(_path(spark, f"{path}/data")):
        for made in files.listStatus(_path(spark, f"{path}/data")):
            name = made.getPath().getName().removeprefix("commit=")
            if made.getModificationTime() > limit:
                continue
            if name not in used:
                gone += remove(spark, f"{path}/data/commit={name}")
                continue
            for day in files.listStatus(made.getPath()):
                at = day.getPath().getName()
                if day.isDirectory() and (name, at.removeprefix(f"{DT}=")) not in live:
                    gone += remove(spark, f"{path}/data/commit={name}/{at}")
    for draft in files.listStatus(_path(spark, f"{path}/versions")) if numbers else []:
        if draft.getPath().getName().startswith("draft-") and draft.getModificationTime() <= limit:
            files.delete(draft.getPath(), False)
    return gone

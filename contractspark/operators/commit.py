"""Outputs of a run replaced together: staged folders, a commit record, recovery.

A run writes every output to a new folder beside its target and keeps one record in the folder of the first target:

* ``_run-<id>.writing`` names the targets while their new versions are written. If the run fails, its folders go again.
* Renaming that file to ``_run-<id>.committed`` is the commit: one atomic step for all targets of the run.
* Then each target is set aside and its new version takes its place; then the old versions and the record go.

If a rename fails, the targets that were swapped are swapped back: all are old. If the process ends at any place after the
commit, the record stays, and the next start (``recover``, which every run calls first) finishes the swaps: all are new. Each
step asks what is there, so it can be done again. Folders of a run that ended before its commit go when its record is older than
``stale_after`` seconds, as another process might still write them.

Tables of the session catalog are swapped by renaming tables in the same way (``replace_table``, ``recover_table``).
"""

from __future__ import annotations

import json
import uuid
from collections.abc import Callable, Iterable

from pyspark.sql import SparkSession

WRITING, COMMITTED = ".writing", ".committed"
_MARK = "_run-"


class _Files:
    """The file system calls that a run needs, by path text; works on whatever file system a path names."""

    def __init__(self, spark: SparkSession):
        self.jvm, self.conf = spark._jvm, spark.sparkContext._jsc.hadoopConfiguration()

    def at(self, path: str):
        p = self.jvm.org.apache.hadoop.fs.Path(path)
        return p.getFileSystem(self.conf), p

    def exists(self, path: str) -> bool:
        fs, p = self.at(path)
        return fs.exists(p)

    def rename(self, old: str, new: str) -> None:
        fs, p = self.at(old)
        if not fs.rename(p, self.at(new)[1]):
            raise OSError(f"cannot rename {old} to {new}")

    def delete(self, path: str) -> None:
        fs, p = self.at(path)
        fs.delete(p, True)

    def size(self, path: str) -> int:
        fs, p = self.at(path)
        return fs.getContentSummary(p).getLength()

    def write(self, path: str, text: str) -> None:
        fs, p = self.at(path)
        out = fs.create(p, False)
        try:
            out.write(bytearray(text.encode()))
        finally:
            out.close()

    def read(self, path: str) -> str:
        fs, p = self.at(path)
        stream = fs.open(p)
        try:
            return self.jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
        finally:
            stream.close()

    def listed(self, folder: str) -> list[tuple[str, float]]:
        """(path, age in seconds) of what lies in the folder."""
        fs, p = self.at(folder)
        if not fs.exists(p):
            return []
        now = self.jvm.java.lang.System.currentTimeMillis()
        return [(s.getPath().toString(), (now - s.getModificationTime()) / 1000) for s in fs.listStatus(p)]


def _beside(path: str, kind: str, tag: str) -> str:
    """A hidden name in the target's folder; Spark's readers show names with ``=``, whatever they begin with."""
    folder, _, name = path.rpartition("/")
    name = name.replace("=", "-")
    return f"{folder}/_{kind}-{name}-{tag}" if folder else f"_{kind}-{name}-{tag}"


def _put(files: _Files, target: dict) -> None:
    """The new version in the target's place, whatever of that has been done before."""
    if files.exists(target["new"]):
        if files.exists(target["path"]):
            files.rename(target["path"], target["old"])
        files.rename(target["new"], target["path"])


def _put_back(files: _Files, target: dict) -> None:
    """The old version in the target's place again; the new one is where it was written."""
    if not files.exists(target["new"]) and files.exists(target["path"]):
        files.rename(target["path"], target["new"])
    if files.exists(target["old"]) and not files.exists(target["path"]):
        files.rename(target["old"], target["path"])


def _finish(files: _Files, record: str, targets: list[dict]) -> None:
    for t in targets:
        _put(files, t)
    for t in targets:
        files.delete(t["old"])
    files.delete(record)


def recover(spark: SparkSession, folder: str, stale_after: float = 86_400) -> list[str]:
    """Finish the committed runs and remove the stale unfinished ones whose records lie in ``folder``; the records seen to."""
    files, done = _Files(spark), []
    for path, age in files.listed(folder):
        name = path.rpartition("/")[2]
        if not name.startswith(_MARK):
            continue
        if name.endswith(COMMITTED):
            _finish(files, path, json.loads(files.read(path)))
            done.append(path)
        elif name.endswith(WRITING) and age > stale_after:
            text = files.read(path)
            for t in json.loads(text) if text.endswith("]") else []:  # a record that is cut off names nothing that was written
                files.delete(t["new"])
            files.delete(path)
            done.append(path)
    return done


def replace_all(spark: SparkSession, jobs: Iterable[tuple[str, Callable[[str], None]]], run: Callable[[list], None] | None = None) -> None:
    """Replace the folders of ``(path, write)`` jobs, all or none; ``write(folder)`` makes a new one.

    ``run`` calls the writes (default: one after another).
    """
    jobs = [(path.rstrip("/"), write) for path, write in jobs]
    if not jobs:
        return
    files, tag = _Files(spark), uuid.uuid4().hex
    folder = jobs[0][0].rpartition("/")[0] or "."
    recover(spark, folder)
    targets = [{"path": path, "new": _beside(path, "staging", tag), "old": _beside(path, "replaced", tag)} for path, _ in jobs]
    record = f"{folder}/{_MARK}{tag}"
    files.write(record + WRITING, json.dumps(targets))
    try:
        writes = [lambda w=write, to=t["new"]: w(to) for (_, write), t in zip(jobs, targets)]
        if run is None:
            for w in writes:
                w()
        else:
            run(writes)
        files.rename(record + WRITING, record + COMMITTED)
    except BaseException:
        for t in targets:
            files.delete(t["new"])
        files.delete(record + WRITING)
        raise
    try:
        for t in targets:
            _put(files, t)
    except Exception:
        for t in reversed(targets):  # if this fails too, the record stays and the next start finishes the run
            _put_back(files, t)
        for t in targets:
            files.delete(t["new"])
        files.delete(record + COMMITTED)
        raise
    _finish(files, record + COMMITTED, targets)


# ---- tables of the session catalog ---------------------------------------------------------------------------------------


def _renamed(spark: SparkSession, old: str, new: str) -> None:
    spark.sql(f"ALTER TABLE {old} RENAME TO {new}")


def _siblings(spark: SparkSession, table: str, kind: str) -> list[str]:
    """Tables ``<table>_<kind>_<id>`` in the table's database."""
    database, _, name = table.rpartition(".")
    shown = spark.sql(f"SHOW TABLES{f' IN {database}' if database else ''} LIKE '{name.strip('`').lower()}_{kind}_*'").collect()
    return [f"{database}.{r.tableName}" if database else r.tableName for r in shown if not r.isTemporary]


def recover_table(spark: SparkSession, table: str) -> None:
    """A run that ended between its two renames has left no table: put the old rows back. Otherwise drop what it set aside."""
    for old in _siblings(spark, table, "replaced"):
        if spark.catalog.tableExists(table):
            spark.sql(f"DROP TABLE IF EXISTS {old}")
        else:
            _renamed(spark, old, table)


def replace_table(spark: SparkSession, table: str, write: Callable[[str], None]) -> None:
    """``write(name)`` makes a new table, which then takes the place of ``table`` by rename; rows are written once."""
    recover_table(spark, table)
    tag = uuid.uuid4().hex
    new, old = f"{table}_staging_{tag}", f"{table}_replaced_{tag}"
    try:
        write(new)
        had = spark.catalog.tableExists(table)
        if had:
            _renamed(spark, table, old)
        try:
            _renamed(spark, new, table)
        except BaseException:
            if had:
                _renamed(spark, old, table)
            raise
    except BaseException:
        spark.sql(f"DROP TABLE IF EXISTS {new}")
        raise
    spark.sql(f"DROP TABLE IF EXISTS {old}")

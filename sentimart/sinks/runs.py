"""Runs that are published once (K9): a folder of commits that readers
resolve.

A run writes its outputs below a name that nothing else uses (its attempt)
and, last of all, one small commit file.  What has no commit does not
exist for a reader: a run that dies between two outputs leaves nothing
visible, and one that is repeated under its run id replaces what it had
published.  Commits are numbered; two that want the same number cannot both
have it, as a rename does not replace a file.
"""

from __future__ import annotations

import json
import time
import uuid
from dataclasses import asdict, dataclass

from pyspark.sql import SparkSession

COMMITS = "commits"
_COMMIT_SQL = "number long, run_id string, attempt string, kind string, processed long, failed long, committed_at double"
_TRIES = 50


@dataclass(frozen=True)
class Commit:
    number: int
    run_id: str
    attempt: str
    kind: str
    processed: int
    failed: int
    committed_at: float


def new_attempt() -> str:
    """A name for the outputs of one attempt at a run."""
    return uuid.uuid4().hex[:16]


def _files(spark: SparkSession, out_dir: str):
    """The file context and the folder of commits."""
    jvm, conf = spark.sparkContext._jvm, spark.sparkContext._jsc.hadoopConfiguration()
    folder = jvm.org.apache.hadoop.fs.Path(f"{out_dir}/{COMMITS}")
    folder = folder.getFileSystem(conf).makeQualified(folder)
    return jvm, folder, jvm.org.apache.hadoop.fs.FileContext.getFileContext(folder.toUri(), conf), folder.getFileSystem(conf)


def all_commits(spark: SparkSession, out_dir: str) -> list[Commit]:
    """Every commit, in order: one small row a run."""
    _, folder, _, fs = _files(spark, out_dir)
    if not fs.exists(folder):
        return []
    rows = spark.read.schema(_COMMIT_SQL).option("pathGlobFilter", "*.json").json(folder.toString()).collect()
    return sorted((Commit(**r.asDict()) for r in rows), key=lambda c: c.number)


def commits(spark: SparkSession, out_dir: str, without: str | None = None) -> list[Commit]:
    """The commits that hold: the last one of each run id, but for the run
    ``without``."""
    last = {c.run_id: c for c in all_commits(spark, out_dir) if c.run_id != without}
    return sorted(last.values(), key=lambda c: c.number)


def commit(spark: SparkSession, out_dir: str, run_id: str, attempt: str, kind: str, processed: int, failed: int) -> Commit:
    """Publish an attempt's outputs, under the next free number."""
    jvm, folder, context, fs = _files(spark, out_dir)
    path = jvm.org.apache.hadoop.fs.Path
    no_overwrite = spark.sparkContext._gateway.new_array(jvm.org.apache.hadoop.fs.Options.Rename, 0)
    for _ in range(_TRIES):
        taken = all_commits(spark, out_dir)
        fs.mkdirs(folder)
        entry = Commit(taken[-1].number + 1 if taken else 1, run_id, attempt, kind, processed, failed, time.time())
        aside = path(folder, f"_{attempt}-{entry.number}")
        stream = fs.create(aside, True)
        try:
            stream.write(bytearray(json.dumps(asdict(entry)).encode()))
        finally:
            stream.close()
        try:
            context.rename(aside, path(folder, f"{entry.number:012d}.json"), no_overwrite)
            return entry
        except Exception as e:  # noqa: BLE001 - another run took the number
            fs.delete(aside, False)
            if "FileAlreadyExists" not in str(e):
                raise
    raise RuntimeError(f"no free commit number in {out_dir} after {_TRIES} tries")


def exists(spark: SparkSession, path: str) -> bool:
    p = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).exists(p)


def dead_attempts(spark: SparkSession, out_dir: str, folder: str) -> list[str]:
    """The attempts below ``folder`` that no commit that holds names: of
    runs that died or were repeated."""
    jvm, _, _, fs = _files(spark, out_dir)
    where = jvm.org.apache.hadoop.fs.Path(f"{out_dir}/{folder}")
    if not fs.exists(where):
        return []
    live = {f"attempt={c.attempt}" for c in commits(spark, out_dir)}
    names = [s.getPath().getName() for s in fs.listStatus(where)]
    return sorted(f"{out_dir}/{folder}/{n}" for n in names if n.startswith("attempt=") and n not in live)

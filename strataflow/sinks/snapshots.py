"""Tables replaced as a whole, one numbered folder per version.

Parquet has no transactional replace, and a job cannot overwrite the files it
reads. Each write therefore goes to a new folder ``snapshot=<n>`` and counts only
once its ``_SUCCESS`` marker is there: readers see the old or the new version,
never a mixture, and a lost job leaves the old one in place. No data is renamed,
which would be a copy on object stores. A writer first claims its number by creating a
file that must not exist; where the store makes that atomic, two writers never share one.
A writer with a number of its own claims the version that it goes on from instead, so
no two versions are made from the same one.
"""

from __future__ import annotations

import itertools
import time

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession

PREFIX = "snapshot="
MARKER = "_SUCCESS"
CLAIMS = "_claims"
BASES = "_bases"
#: Seconds for which a superseded version, or an unfinished one, is left for its readers or writer.
RETAIN = 24 * 3600.0


class SnapshotConflict(RuntimeError):
    """Another writer has the version that this one would write."""


def _path(spark: SparkSession, text: str):
    return spark._jvm.org.apache.hadoop.fs.Path(text)


def _files(spark: SparkSession, path):
    """The file system of a path. Spark has no public call that creates or deletes a file."""
    return path.getFileSystem(spark._jsparkSession.sessionState().newHadoopConf())


def remove_path(spark: SparkSession, path: str) -> None:
    """Delete a folder, if it is there: staged data that is no longer needed."""
    place = _path(spark, path)
    _files(spark, place).delete(place, True)


def _numbers(spark: SparkSession, root: str, finished: bool) -> list[int]:
    path = _path(spark, root)
    files = _files(spark, path)
    if not files.exists(path):
        return []
    found = []
    for status in files.listStatus(path):
        name = status.getPath().getName()
        if not name.startswith(PREFIX):
            continue
        marker = _path(spark, f"{status.getPath().toString()}/{MARKER}")
        if not finished or files.exists(marker):
            found.append(int(name[len(PREFIX) :]))
    return sorted(found)


def _claimed(spark: SparkSession, root: str) -> list[int]:
    path = _path(spark, f"{root}/{CLAIMS}")
    files = _files(spark, path)
    if not files.exists(path):
        return []
    return [int(status.getPath().getName()) for status in files.listStatus(path)]


def _claim(spark: SparkSession, root: str, number: int) -> None:
    path = _path(spark, f"{root}/{CLAIMS}/{number}")
    try:
        _files(spark, path).create(path, False).close()
    except Exception as error:
        if _files(spark, path).exists(path):
            raise SnapshotConflict(f"version {number} of {root} is being written") from error
        raise


def _claim_base(spark: SparkSession, root: str, after: int, number: int, retain: float) -> str:
    """Claim the version ``after`` as the one that ``number`` goes on from; the claim's path.

    A retry of the same number takes its claim over. A claim of another number that has
    not become a version within ``retain`` seconds is passed over by a claim of the next turn.
    """
    for turn in itertools.count():
        claim = f"{root}/{BASES}/{after}.{turn}"
        path = _path(spark, claim)
        files = _files(spark, path)
        try:
            out = files.create(path, False)
        except Exception as error:
            if not files.exists(path):
                raise
            if files.getFileStatus(path).getLen():
                taken = files.open(path)
                try:
                    owner = taken.readLong()
                finally:
                    taken.close()
                if owner == number:
                    return claim
            if (age(spark, claim) or 0) <= retain:
                raise SnapshotConflict(
                    f"another version of {root} is being made from {after}"
                ) from error
            continue
        try:
            out.writeLong(number)
        finally:
            out.close()
        return claim
    raise AssertionError("unreachable")


def age(spark: SparkSession, path: str) -> float | None:
    """Seconds since a file was made, None if it is not there."""
    place = _path(spark, path)
    files = _files(spark, place)
    if not files.exists(place):
        return None
    return time.time() - files.getFileStatus(place).getModificationTime() / 1000


def child_names(spark: SparkSession, path: str) -> list[str]:
    """Names of what lies in a folder; none if it is not there."""
    place = _path(spark, path)
    files = _files(spark, place)
    if not files.exists(place):
        return []
    return [status.getPath().getName() for status in files.listStatus(place)]


def complete_snapshots(spark: SparkSession, root: str) -> list[int]:
    """Numbers of the complete versions that are still there, in order."""
    return _numbers(spark, root, finished=True)


def current_snapshot(spark: SparkSession, root: str) -> int | None:
    """Number of the newest complete version, None for an absent table."""
    numbers = _numbers(spark, root, finished=True)
    return numbers[-1] if numbers else None


def snapshot_path(root: str, number: int) -> str:
    return f"{root}/{PREFIX}{number}"


def has_snapshot(spark: SparkSession, root: str, number: int) -> bool:
    """Whether that version is complete and still there."""
    return number in _numbers(spark, root, finished=True)


def read_snapshot(
    spark: SparkSession, root: str, form: str = "parquet", number: int | None = None
) -> DataFrame:
    """The newest complete version, or the one of that ``number``."""
    if number is None:
        number = current_snapshot(spark, root)
    if number is None:
        raise AnalysisException(f"no complete snapshot under {root}")
    return spark.read.format(form).load(snapshot_path(root, number))


def write_snapshot(
    df: DataFrame,
    root: str,
    number: int | None = None,
    form: str = "parquet",
    retain: float = RETAIN,
    after: int | None = None,
) -> int:
    """Write a new version; returns its number.

    Without a ``number`` the next free one is claimed. With ``after``, the version that
    the rows were made from (-1: none), the new one has to be the next: if another writer has
    claimed that, ``SnapshotConflict`` is raised and nothing is lost. A claim that has not
    become a version within ``retain`` seconds is one of a lost job and is passed over.

    A given ``number`` (a micro-batch id) belongs to one writer. If that version is
    complete, a retry changes nothing; if not, it is written anew, unseen by readers. One
    below the current version is refused, as nobody would read it (a stream with a new
    checkpoint needs a new root). With ``after`` as well, that version is claimed: another
    number made from it is refused with ``SnapshotConflict``.
    """
    spark = df.sparkSession
    current = current_snapshot(spark, root)
    base = None
    if number is not None:
        if number < (current or 0):
            raise ValueError(f"snapshot {number} is older than the current one under {root}")
        if number == current:
            return number
        if after is not None:
            base = _claim_base(spark, root, after, number, retain)
            current = current_snapshot(spark, root)
            if (-1 if current is None else current) != after:
                remove_path(spark, base)
                raise SnapshotConflict(f"{root} moved on from version {after} to {current}")
        mode = "overwrite"
    else:
        taken = {*_claimed(spark, root), *_numbers(spark, root, finished=False)}
        if after is None:
            number = max(taken, default=-1) + 1
        else:
            if (-1 if current is None else current) != after:
                raise SnapshotConflict(f"{root} moved on from version {after} to {current}")
            number = after + 1
            while number in taken and (age(spark, f"{root}/{CLAIMS}/{number}") or 0) > retain:
                number += 1
        _claim(spark, root, number)
        mode = "errorifexists"
    try:
        df.write.mode(mode).format(form).save(snapshot_path(root, number))
    except BaseException:
        # The writer is alive and gives the number up itself.
        if mode == "errorifexists":
            remove_path(spark, snapshot_path(root, number))
            remove_path(spark, f"{root}/{CLAIMS}/{number}")
        elif base is not None:
            remove_path(spark, base)
        raise
    drop_old_snapshots(spark, root, retain)
    return number


def drop_old_snapshots(spark: SparkSession, root: str, retain: float = RETAIN) -> None:
    """Delete versions that were superseded, or left unfinished, ``retain`` seconds ago."""
    finished = _numbers(spark, root, finished=True)
    if not finished:
        return
    for number, following in zip(finished[:-1], finished[1:], strict=True):
        since = age(spark, f"{snapshot_path(root, following)}/{MARKER}")
        if since is not None and since > retain:
            _forget(spark, root, number)
    for number in set(_numbers(spark, root, finished=False)) - set(finished):
        since = age(spark, snapshot_path(root, number))
        if number < finished[-1] and since is not None and since > retain:
            _forget(spark, root, number)


def _forget(spark: SparkSession, root: str, number: int) -> None:
    """Delete a version and its claims."""
    remove_path(spark, snapshot_path(root, number))
    remove_path(spark, f"{root}/{CLAIMS}/{number}")
    bases = _path(spark, f"{root}/{BASES}")
    files = _files(spark, bases)
    if files.exists(bases):
        for status in files.listStatus(bases):
            if status.getPath().getName().startswith(f"{number}."):
                files.delete(status.getPath(), False)

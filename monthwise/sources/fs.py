"""Folder operations on the cluster file system (HDFS, object store, local)
through Hadoop's ``FileSystem`` -- the same API Spark's own writers use.

Only metadata moves through here (exists / delete / list a folder); no data.
Many files at once are renamed by tasks (``replace_all``).
"""

from __future__ import annotations

import uuid
from collections.abc import Iterable, Iterator

import pyarrow as pa
from pyspark.sql import SparkSession

#: Files that a task renames at once.
RENAMERS = 8


def _fs_and_path(spark: SparkSession, path: str):
    jvm = spark.sparkContext._jvm
    jpath = jvm.org.apache.hadoop.fs.Path(path)
    conf = spark.sparkContext._jsc.hadoopConfiguration()
    return jpath.getFileSystem(conf), jpath


def qualified(spark: SparkSession, path: str) -> str:
    """``path`` with its scheme, as the tasks' file system may not be the default one."""
    fs, p = _fs_and_path(spark, path)
    return fs.makeQualified(p).toString()


def exists(spark: SparkSession, path: str) -> bool:
    fs, p = _fs_and_path(spark, path)
    return bool(fs.exists(p))


def delete(spark: SparkSession, path: str, recursive: bool = True) -> bool:
    fs, p = _fs_and_path(spark, path)
    if not fs.exists(p):
        return False
    return bool(fs.delete(p, recursive))


def rename(spark: SparkSession, src: str, dst: str) -> None:
    """Rename a file or folder; raises if the file system did not do it
    (Hadoop reports some failures as a false return value only)."""
    fs, p = _fs_and_path(spark, src)
    _, q = _fs_and_path(spark, dst)
    parent = q.getParent()
    if parent is not None and not fs.exists(parent):
        fs.mkdirs(parent)
    if not _renamed(fs, p, q):
        raise OSError(f"rename failed: {src} -> {dst}")


def _renamed(fs, p, q) -> bool:
    return bool(fs.rename(p, q)) and bool(fs.exists(q))


def replace(spark: SparkSession, src: str, dst: str) -> None:
    """Put ``src`` in the place of ``dst``: the old one is renamed aside, the
    new one renamed in, and only then the old one deleted.  If the second
    rename fails, the old one is put back, so ``dst`` is never lost."""
    if not exists(spark, dst):
        rename(spark, src, dst)
        return
    parent, name = dst.rstrip("/").rsplit("/", 1)
    aside = f"{parent}/_old-{uuid.uuid4().hex[:8]}-{name}"
    rename(spark, dst, aside)
    try:
        rename(spark, src, dst)
    except Exception:
        rename(spark, aside, dst)
        raise
    delete(spark, aside)


def replace_all(spark: SparkSession, moves: list[tuple[str, str]]) -> None:
    """``replace`` for many files (source, target), renamed by tasks; a task
    tried again finds what it has done.  Files are renamed with pyarrow; where
    it cannot open the file system, the driver renames them."""
    if not moves:
        return
    whole = {folder: qualified(spark, folder) for folder in {p.rsplit("/", 1)[0] for move in moves for p in move}}
    for folder in {dst.rsplit("/", 1)[0] for _, dst in moves}:
        fs, p = _fs_and_path(spark, folder)
        fs.mkdirs(p)

    def full(path: str) -> str:
        folder, name = path.rsplit("/", 1)
        return f"{whole[folder]}/{name}"

    sc = spark.sparkContext
    pairs = sc.parallelize([(full(src), full(dst)) for src, dst in moves], min(len(moves), 4 * sc.defaultParallelism))
    for src, dst in pairs.mapPartitions(_replace_files).collect():
        replace(spark, src, dst)


def _replace_files(moves: Iterable[tuple[str, str]]) -> Iterator[tuple[str, str]]:
    """Renames the files; gives those whose file system cannot be opened."""
    from monthwise.sources.footers import at_once

    moves = list(moves)
    if moves:
        with at_once(moves[0][0], RENAMERS) as run:
            done = list(run(_replace_file, *zip(*moves)))
        yield from (move for move, was in zip(moves, done, strict=True) if not was)


def _replace_file(src: str, dst: str) -> bool:
    from pyarrow.fs import FileType, LocalFileSystem

    from monthwise.sources.footers import open_file_system

    try:
        fsys, p = open_file_system(src)
        _, q = open_file_system(dst)
    except (OSError, NotImplementedError, pa.ArrowException):
        return False
    new, old = fsys.get_file_info([p, q])
    if new.type == FileType.NotFound and old.type == FileType.File:
        return True  # an earlier try has renamed it
    # Hadoop keeps a local file's checksums beside it: they go along, and those
    # of a replaced file go first, as a file without any is read unchecked
    sums = [_checksums(p), _checksums(q)] if isinstance(fsys, LocalFileSystem) else []
    kept = [i.type == FileType.File for i in fsys.get_file_info(sums)] if sums else [False, False]
    if kept[1]:
        fsys.delete_file(sums[1])
    aside = None
    if old.type != FileType.NotFound:
        parent, name = q.rsplit("/", 1)
        aside = f"{parent}/_old-{uuid.uuid4().hex[:8]}-{name}"
        fsys.move(q, aside)
    try:
        fsys.move(p, q)
    except Exception:
        if aside:
            fsys.move(aside, q)
        raise
    if kept[0]:
        fsys.move(sums[0], sums[1])
    if aside:
        (fsys.delete_dir if old.type == FileType.Directory else fsys.delete_file)(aside)
    return True


def _checksums(path: str) -> str:
    parent, name = path.rsplit("/", 1)
    return f"{parent}/.{name}.crc"


def is_folder(spark: SparkSession, path: str) -> bool:
    fs, p = _fs_and_path(spark, path)
    return bool(fs.getFileStatus(p).isDirectory())


def walk(spark: SparkSession, path: str) -> list[str]:
    """Files below ``path``, folders whose names start with ``_`` or ``.`` left out."""
    fs, p = _fs_and_path(spark, path)
    out = []
    for status in fs.listStatus(p):
        child = status.getPath()
        if child.getName().startswith(("_", ".")):
            continue
        out += walk(spark, str(child)) if status.isDirectory() else [str(child)]
    return out


def set_modified(spark: SparkSession, path: str, millis: int) -> None:
    """Set a file's modification time, as a copy that preserves times does."""
    fs, p = _fs_and_path(spark, path)
    fs.setTimes(p, millis, -1)


def list_dir(spark: SparkSession, path: str) -> list[str]:
    """Names directly under ``path`` (files and folders); empty if absent."""
    fs, p = _fs_and_path(spark, path)
    if not fs.exists(p):
        return []
    return [s.getPath().getName() for s in fs.listStatus(p)]


"""Versioned state: a folder of commit files, each written once; readers take the highest complete one.

Nothing that a reader may look at is ever replaced or deleted first: a new state
is a new file, so a writer that dies at any step leaves the state before it.  A
file that was cut short fails its checksum and is passed over.  Creation refuses
an existing file, so of two writers with one number one is told
(:class:`Conflict`) and tries again on top of the other's state.

A state is a small JSON object; what it stands for (tables, folders) lies in
sub-folders of its own, written before the commit that names them.
:func:`expire` removes commits and folders that no reader can still be using:
older than ``keep_seconds`` and not the latest.
"""

from __future__ import annotations

import hashlib
import json
import time
import uuid
from collections.abc import Callable
from dataclasses import dataclass

from py4j.protocol import Py4JJavaError
from pyspark.sql import SparkSession

from podium.session import _fs_path, child_names, delete_path

#: seconds that superseded commits and their folders are kept for readers that hold them
KEEP_SECONDS = 24 * 3600


class Conflict(RuntimeError):
    """Another writer has committed since the state was read."""


@dataclass(frozen=True)
class Version:
    number: int
    state: dict


def _log(path: str) -> str:
    return f"{path.rstrip('/')}/_log"


def _file(path: str, number: int) -> str:
    return f"{_log(path)}/{number:020d}.json"


def _numbers(spark: SparkSession, path: str) -> list[int]:
    names = (n.removesuffix(".json") for n in child_names(spark, _log(path)) if n.endswith(".json"))
    return sorted(int(n) for n in names if n.isdigit())


def _signed(state: dict) -> bytes:
    body = json.dumps(state, sort_keys=True)
    return f"{body}\n{hashlib.sha256(body.encode()).hexdigest()}\n".encode()


def _read(spark: SparkSession, file: str) -> dict | None:
    """The state of a commit file; None if it is incomplete or gone."""
    fs, p = _fs_path(spark, file)
    if not fs.exists(p):
        return None
    stream = fs.open(p)
    try:
        body, _, digest = str(spark.sparkContext._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")).partition("\n")
    finally:
        stream.close()
    return json.loads(body) if hashlib.sha256(body.encode()).hexdigest() == digest.strip() else None


def _create(spark: SparkSession, file: str, content: bytes) -> None:
    """Write a file that must not exist yet."""
    fs, p = _fs_path(spark, file)
    if fs.exists(p):
        raise Conflict(file)
    out = fs.create(p, False)
    try:
        out.write(bytearray(content))
    finally:
        out.close()


def latest(spark: SparkSession, path: str) -> Version | None:
    """The highest complete version, if there is one."""
    for n in reversed(_numbers(spark, path)):
        state = _read(spark, _file(path, n))
        if state is not None:
            return Version(n, state)
    return None


def commit(spark: SparkSession, path: str, state: dict, after: Version | None) -> Version:
    """Make ``state`` the latest version, if the latest is still ``after``."""
    now = latest(spark, path)
    if (now and now.number) != (after and after.number):
        raise Conflict(f"{path}: version {now and now.number}, not {after and after.number}")
    number = max(_numbers(spark, path), default=0) + 1
    try:
        _create(spark, _file(path, number), _signed(state))
    except Py4JJavaError as e:
        raise Conflict(_file(path, number)) from e
    got = latest(spark, path)
    if got is None or got.number != number:
        raise Conflict(f"{path}: version {number} was overtaken")
    return got


def update(spark: SparkSession, path: str, change: Callable[[Version | None], dict], tries: int = 5) -> Version:
    """Commit ``change(latest)``, again on top of another writer's state if there was one."""
    for left in range(tries - 1, -1, -1):
        now = latest(spark, path)
        try:
            return commit(spark, path, change(now), now)
        except Conflict:
            if not left:
                raise
    raise AssertionError("unreachable")


def new_folder(prefix: str = "v") -> str:
    """A name for a folder that a later commit refers to."""
    return f"{prefix}-{uuid.uuid4().hex}"


def expire(
    spark: SparkSession, path: str, refers: Callable[[dict], list[str]], prefix: str = "v", keep_seconds: float = KEEP_SECONDS
) -> None:
    """Remove superseded commits, and folders ``<prefix>-…`` that no commit left refers to, once they are old."""
    before = (time.time() - keep_seconds) * 1000
    now = latest(spark, path)

    def old(p: str) -> bool:
        fs, q = _fs_path(spark, p)
        return fs.exists(q) and fs.getFileStatus(q).getModificationTime() <= before

    held: set[str] = set()
    for n in _numbers(spark, path):
        if now is not None and n < now.number and old(_file(path, n)):
            delete_path(spark, _file(path, n))
        else:
            held.update(refers(_read(spark, _file(path, n)) or {}))
    for name in child_names(spark, path):
        if name.startswith(f"{prefix}-") and name not in held and old(f"{path.rstrip('/')}/{name}"):
            delete_path(spark, f"{path.rstrip('/')}/{name}")

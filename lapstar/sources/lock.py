"""One writer per warehouse, across sessions and applications: a lock file with a lease.

The file is created atomically in the file system that all writers share, so one of several wins. Its holder renews it while
it works; a lock that was not renewed for a whole lease belongs to a writer that died and is taken away, by a
rename that again only one can win. Leases are judged by the file's own times, so all clocks but the file system's may differ.
"""

from __future__ import annotations

import threading
import time
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from py4j.protocol import Py4JJavaError
from pyspark.sql import SparkSession

LEASE = 60.0
PATIENCE = 3600.0
NAME = "_writer.lock"


class _File:
    """The lock's file, and what writers do with it."""

    def __init__(self, spark: SparkSession, folder: str):
        jvm = spark._jvm
        self.paths = jvm.org.apache.hadoop.fs.Path
        self.path = self.paths(f"{folder.rstrip('/')}/{NAME}")
        self.fs = self.path.getFileSystem(spark._jsc.hadoopConfiguration())
        self.folder, self.owner = folder.rstrip("/"), uuid.uuid4().hex

    def _write(self, path: object, text: str) -> None:
        out = self.fs.create(path, False)
        try:
            out.write(bytearray(text.encode()))
        finally:
            out.close()

    def create(self) -> bool:
        try:
            self._write(self.path, self.owner)
        except Py4JJavaError as error:
            if self.fs.exists(self.path) or "AlreadyExists" in str(error.java_exception):
                return False
            raise
        return True

    def held(self) -> tuple[str, int] | None:
        """Owner and time of the last renewal; None if nobody holds it."""
        try:
            time_ = self.fs.getFileStatus(self.path).getModificationTime()
            stream = self.fs.open(self.path)
            try:
                return bytes(stream.readNBytes(32)).decode(), time_
            finally:
                stream.close()
        except Py4JJavaError as error:
            if "FileNotFound" in str(error.java_exception):
                return None
            raise

    def now(self) -> int:
        """The file system's clock."""
        probe = self.paths(f"{self.folder}/{NAME}-{uuid.uuid4().hex}")
        self._write(probe, "")
        found = self.fs.getFileStatus(probe).getModificationTime()
        self.fs.delete(probe, False)
        return found

    def renew(self) -> None:
        if (self.held() or ("", 0))[0] == self.owner:
            self.fs.setTimes(self.path, self.now(), -1)

    def mine(self) -> bool:
        return (self.held() or ("", 0))[0] == self.owner

    def take_away(self, owner: str) -> None:
        """Remove a dead writer's lock, unless another writer did so first."""
        away = self.paths(f"{self.folder}/{NAME}-{uuid.uuid4().hex}")
        if (self.held() or ("", 0))[0] == owner and self.fs.rename(self.path, away):
            self.fs.delete(away, False)

    def release(self) -> None:
        if self.mine():
            self.fs.delete(self.path, False)


@contextmanager
def writer(spark: SparkSession, folder: str, lease: float | None = None, patience: float | None = None) -> Iterator[None]:
    """Holds the lock of ``folder`` for the block, waiting for it up to ``patience`` seconds.

    Raises ``TimeoutError`` if another writer holds it all that time, and ``RuntimeError`` at the end of a block whose lock
    was taken away, as happens to a writer that was held up for longer than its lease.
    """
    lease, patience = LEASE if lease is None else lease, PATIENCE if patience is None else patience
    lock, until = _File(spark, folder), time.monotonic() + patience
    while not lock.create():
        held = lock.held()
        if held and lock.now() - held[1] > 1000 * lease:
            lock.take_away(held[0])
        elif time.monotonic() > until:
            raise TimeoutError(f"{folder} has another writer")
        else:
            time.sleep(min(1.0, lease / 10))
    done = threading.Event()

    def keep() -> None:
        while not done.wait(lease / 3):
            lock.renew()

    keeper = threading.Thread(target=keep, daemon=True)
    keeper.start()
    try:
        yield
        if not lock.mine():
            raise RuntimeError(f"the lock of {folder} was taken away: load again")
    finally:
        done.set()
        keeper.join()
        lock.release()

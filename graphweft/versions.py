"""Numbered versions of a small text in a shared folder, each published once and as a whole.

A version is written under a name of its own and then given its number in one step that fails if the number is taken: a hard
link on local file systems, elsewhere a rename, which HDFS refuses if the target exists. So of several writers one wins, readers see whole
versions only, and a writer that dies leaves nothing but its own unnamed file. Object stores whose rename overwrites are not suited.
"""

from __future__ import annotations

import os
import re
import uuid
from collections.abc import Callable
from urllib.parse import unquote, urlparse

from pyspark.sql import SparkSession

_NAME = re.compile(r"v(\d{12})")


def _local(folder: str) -> str | None:
    parsed = urlparse(folder)
    if parsed.scheme == "file":
        return unquote(parsed.path)
    return folder if not parsed.scheme and folder.startswith("/") else None


class Versions:
    """The versions of one text below ``folder``, which all writers reach."""

    def __init__(self, spark: SparkSession, folder: str):
        self._jvm = spark._jvm
        path = self._jvm.org.apache.hadoop.fs.Path(folder)
        self._fs = path.getFileSystem(spark._jsc.hadoopConfiguration())
        self._path = self._fs.makeQualified(path)
        self._fs.mkdirs(self._path)

    def _child(self, name: str):
        return self._jvm.org.apache.hadoop.fs.Path(self._path, name)

    def latest(self) -> tuple[int, str | None]:
        """The newest number and its text; (0, None) before the first."""
        names = [status.getPath().getName() for status in self._fs.listStatus(self._path)]
        numbers = [int(m[1]) for m in map(_NAME.fullmatch, names) if m]
        if not numbers:
            return 0, None
        stream = self._fs.open(self._child(f"v{max(numbers):012d}"))
        try:
            return max(numbers), bytes(stream.readAllBytes()).decode()
        finally:
            stream.close()

    def publish(self, number: int, text: str) -> bool:
        """Make ``text`` version ``number``; False if another writer has taken that number."""
        draft, target = self._child(f"draft-{uuid.uuid4().hex}"), self._child(f"v{number:012d}")
        stream = self._fs.create(draft, False)
        try:
            stream.write(bytearray(text.encode()))
        finally:
            stream.close()
        try:
            here = _local(draft.toString())
            if here is None:
                return not self._fs.exists(target) and bool(self._fs.rename(draft, target))
            try:
                os.link(here, _local(target.toString()))
                return True
            except FileExistsError:
                return False
        finally:
            self._fs.delete(draft, False)

    def change(self, step: Callable[[str | None], str]) -> tuple[int, str]:
        """Publish ``step(latest text)``, anew on what another writer has published meanwhile."""
        while True:
            number, text = self.latest()
            new = step(text)
            if self.publish(number + 1, new):
                return number + 1, new

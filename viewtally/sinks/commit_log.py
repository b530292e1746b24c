"""A small table kept as numbered, complete versions (SNK-6).

A version is one file ``<root>/v<number>.json`` that holds the whole table.  It
is written under a name of its own first and then published by giving it its
final name in one step that never replaces a file: on a local disk a hard link,
elsewhere a rename through Hadoop's ``FileContext`` without the overwrite
option, which HDFS checks and performs in the name node.  So a version is seen
whole or not at all, and of two writers that make the same version one fails
(compare-and-set).  A store whose rename is a copy (most object stores) gives
no such guarantee and must not hold a log.
"""

from __future__ import annotations

import json
import re
import uuid

from py4j.protocol import Py4JJavaError
from pyspark.sql import SparkSession

NAME = re.compile(r"v(\d+)\.json")
#: versions kept behind the newest, for readers that listed them before
KEEP = 100


class Conflict(RuntimeError):
    """Another writer published the version first."""


class CommitLog:
    def __init__(self, spark: SparkSession, root: str):
        self.spark, self.root = spark, root.rstrip("/")
        self._jvm, self._conf = spark._jvm, spark._jsc.hadoopConfiguration()

    def _path(self, name: str = ""):
        return self._jvm.org.apache.hadoop.fs.Path(f"{self.root}/{name}" if name else self.root)

    def _fs(self):
        return self._path().getFileSystem(self._conf)

    def versions(self) -> list[int]:
        """Numbers of the published versions, ascending."""
        fs, root = self._fs(), self._path()
        if not fs.exists(root):
            return []
        found = (NAME.fullmatch(f.getPath().getName()) for f in fs.listStatus(root))
        return sorted(int(m[1]) for m in found if m)

    def load(self, version: int) -> list[dict]:
        stream = self._fs().open(self._path(f"v{version}.json"))
        try:
            return json.loads(bytes(stream.readAllBytes()).decode())
        finally:
            stream.close()

    def newest(self) -> tuple[int, list[dict]]:
        """Number and rows of the newest version; (0, []) before the first."""
        while versions := self.versions():
            try:
                return versions[-1], self.load(versions[-1])
            except Py4JJavaError:
                if self.versions() == versions:     # not outrun by KEEP commits
                    raise
        return 0, []

    def publish(self, version: int, rows: list[dict]) -> None:
        """Make ``rows`` the version; ``Conflict`` if there is one already."""
        fs = self._fs()
        fs.mkdirs(self._path())
        draft, final = self._path(f"_draft-{uuid.uuid4().hex}"), self._path(f"v{version}.json")
        stream = fs.create(draft, False)
        try:
            stream.write(bytearray(json.dumps(rows, indent=0).encode()))
        finally:
            stream.close()
        try:
            self._publish(draft, final)
        except Py4JJavaError as e:
            if "AlreadyExists" not in str(e.java_exception):
                raise
            raise Conflict(f"{final} was published by another writer") from None
        finally:
            fs.delete(draft, False)
        for old in self.versions():
            if old < version - KEEP:
                fs.delete(self._path(f"v{old}.json"), False)

    def _publish(self, draft, final) -> None:
        uri = self._fs().makeQualified(draft).toUri()
        if uri.getScheme() == "file":
            local = lambda p: self._jvm.java.io.File(self._fs().makeQualified(p).toUri().getPath()).toPath()
            self._jvm.java.nio.file.Files.createLink(local(final), local(draft))
            return
        options = self._jvm.org.apache.hadoop.fs.Options
        none = self.spark.sparkContext._gateway.new_array(options.Rename, 1)
        none[0] = options.Rename.NONE
        self._jvm.org.apache.hadoop.fs.FileContext.getFileContext(uri, self._conf).rename(draft, final, none)

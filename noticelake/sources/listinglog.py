"""Raw files found since the last look, without listing old folders again.

The folders right below a root have names that ascend with time, such as days or run numbers.
A log keeps a high-water mark, the greatest folder name seen, and the files found. The next look
lists the folder of the mark, which may still grow, and later ones; every file there that the log
does not have with the same time of change is new. So the cost of a look grows with what came
since, and with one listing of folder names. A file that arrives late in an older folder is found
by ``look(everything=True)``, which lists all and compares with the whole log.

A look changes nothing. ``commit`` makes its files known in one step, after they were handled: a
job that fails before finds them again. One writer at a time. Files that lie right in the root,
in no folder, are not looked at; names beginning with ``_`` or ``.`` are hidden.
"""

from __future__ import annotations

import json
import uuid
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from noticelake.sources import commits
from noticelake.sources.landing import RAW_FILE_PATTERN, list_raw

_FILES = "path string, modified_at timestamp, folder string"


@dataclass(frozen=True)
class Found:
    """``files`` (``path, modified_at, folder``) are new; ``folders`` were listed for them."""

    files: DataFrame
    folders: list[str]


class ListingLog:
    def __init__(self, spark: SparkSession, log: str, root: str, pattern: str = RAW_FILE_PATTERN):
        self.spark, self.log, self.root, self.pattern = spark, log.rstrip("/"), root.rstrip("/"), pattern

    def mark(self) -> str | None:
        """The greatest folder name committed."""
        newest = commits.latest(self.spark, self.log)
        return newest[1]["mark"] if newest else None

    def look(self, everything: bool = False) -> Found:
        newest = commits.latest(self.spark, self.log)
        mark = "" if everything or not newest else newest[1]["mark"]
        folders = [name for name in self._folders() if name >= mark]
        if not folders:
            return Found(self.spark.createDataFrame([], _FILES), [])
        # Only the folder of the mark can hold known files, unless all folders are listed.
        known = self._known(self._parts() if everything else newest[1]["parts"] if newest else [])
        path, depth = self._path()
        listed = list_raw(self.spark, [f"{path}/{name}" for name in folders], self.pattern)
        listed = listed.withColumn("folder", F.get(F.split("path", "/"), F.lit(depth)))
        return Found(listed.join(known, ["path", "modified_at"], "left_anti"), folders)

    def commit(self, found: Found) -> None:
        """Make the files of a look known; a look that listed no folder changes nothing."""
        if not found.folders:
            return
        newest = commits.latest(self.spark, self.log)
        part = f"files/{uuid.uuid4().hex}"
        found.files.write.parquet(f"{self.log}/{part}")
        mark = max(found.folders[-1], newest[1]["mark"] if newest else "")
        # Parts that may hold files of the folder of the mark.
        parts = [*(newest[1]["parts"] if newest and newest[1]["mark"] == mark else []), part]
        commits.commit(self.spark, self.log, {"mark": mark, "part": part, "parts": parts})

    def files(self) -> DataFrame:
        """All files known, a row for each time one was found."""
        return self._known(self._parts(), "folder")

    def _parts(self) -> list[str]:
        done = commits.history(self.spark, self.log)
        return [json.loads(r.entry)["part"] for r in done.collect()] if done else []

    def _known(self, parts: list[str], *more: str) -> DataFrame:
        names = ["path", "modified_at", *more]
        if not parts:
            return self.spark.createDataFrame([], _FILES).select(*names)
        return self.spark.read.schema(_FILES).parquet(*[f"{self.log}/{p}" for p in parts]).select(*names)

    def _folders(self) -> list[str]:
        """Names of the folders right below the root, ascending."""
        fs, path = self._file_system()
        names = [f.getPath().getName() for f in fs.listStatus(path) if f.isDirectory()]
        return sorted(n for n in names if not n.startswith(("_", ".")))

    def _file_system(self):
        path = self.spark._jvm.org.apache.hadoop.fs.Path(self.root)
        return path.getFileSystem(self.spark._jsc.hadoopConfiguration()), path

    def _path(self) -> tuple[str, int]:
        """The root in full, and how many slashes a listed path has before the folder's name."""
        fs, path = self._file_system()
        full = fs.makeQualified(path).toString()
        return full, len(full.split("/"))

"""Creating a small file that must not exist yet: the one step by which loads become visible.

Two writers may try the same name at once, and exactly one may win. How that is done depends on the file
system: some rename without overwriting in one step, others put an object only where there is none.
A file system that can do neither is refused, as two loads could both believe to have won there.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable
from typing import Any, Protocol

from pyspark.sql import SparkSession

from changefold.errors import PublishConflictError

#: Schemes whose rename is atomic and refuses an existing name.
RENAMING = ("file", "hdfs", "viewfs")
#: Schemes whose ``create`` without overwriting is a conditional put.
CREATING = ("abfs", "abfss", "gs")
# Fixed value: the name under which Hadoop's connectors offer a conditional put.
CONDITIONAL = "fs.option.create.conditional.overwrite"

#: Gives the file system of a path, and the path as that file system takes it.
Opener = Callable[[str], tuple[Any, Any]]


class Commit(Protocol):
    def create(self, path: str, text: str) -> None:
        """Create the file, or raise ``PublishConflictError`` if it is there."""


def taken(path: str) -> PublishConflictError:
    return PublishConflictError(f"{path} was published by another writer")


def _exists_already(refused: Exception) -> bool:
    said = f"{type(refused).__name__} {refused}"
    return any(sign in said for sign in ("FileAlreadyExists", "FileExists", "PreconditionFailed", "412"))


class RenameCommit:
    """Writes aside, then renames without overwriting, so that no half-written file shows."""

    def __init__(self, spark: SparkSession, opened: Opener) -> None:
        self.spark, self.opened = spark, opened

    def create(self, path: str, text: str) -> None:
        jvm = self.spark._jvm
        folder, name = path.rsplit("/", 1)
        # A leading underscore keeps a left-over out of every listing Spark makes.
        fs, aside = self.opened(f"{folder}/_{name}.{uuid.uuid4().hex}")
        out = fs.create(aside, False)
        out.write(bytearray(text.encode("utf-8")))
        out.close()
        context = jvm.org.apache.hadoop.fs.FileContext.getFileContext(
            aside.toUri(), self.spark._jsc.hadoopConfiguration()
        )
        rename = jvm.org.apache.hadoop.fs.Options.Rename
        options = self.spark.sparkContext._gateway.new_array(rename, 1)
        options[0] = rename.NONE
        try:
            context.rename(fs.makeQualified(aside), fs.makeQualified(jvm.org.apache.hadoop.fs.Path(path)), options)
        except Exception as refused:
            fs.delete(aside, False)
            if _exists_already(refused):
                raise taken(path) from refused
            raise


class PutCommit:
    """Puts the whole file in one request that fails where there is one. The file shows when it is closed."""

    def __init__(self, opened: Opener, conditional: bool) -> None:
        """``conditional`` asks for the put by name; without it ``create`` has that meaning already."""
        self.opened, self.conditional = opened, conditional

    def create(self, path: str, text: str) -> None:
        fs, wanted = self.opened(path)
        try:
            builder = fs.createFile(wanted).overwrite(False).recursive()
            if self.conditional:
                builder = builder.must(CONDITIONAL, True)
            out = builder.build()
            out.write(bytearray(text.encode("utf-8")))
            out.close()
        except Exception as refused:
            if _exists_already(refused):
                raise taken(path) from refused
            raise


def commit_for(spark: SparkSession, root: str, opened: Opener) -> Commit:
    """The commit that suits the file system of a store."""
    fs, path = opened(root)
    scheme = fs.getScheme()
    if scheme in RENAMING:
        return RenameCommit(spark, opened)
    if scheme in CREATING:
        return PutCommit(opened, conditional=False)
    if fs.hasPathCapability(path, CONDITIONAL):
        return PutCommit(opened, conditional=True)
    raise ValueError(f"{scheme} neither renames in one step nor puts a file only where there is none; no load could be published safely")

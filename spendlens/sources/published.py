"""Builds of tables that readers see whole or not at all.

Every build has a folder of its own below ``builds``. It becomes the current one when its manifest, a small JSON file,
gets its final name by one rename; manifests are numbered and never change. Readers take the folder from the newest
manifest, so a build that broke midway leaves them with the one before. The build before the current one stays for
readers that still use it.
"""

from __future__ import annotations

import json
import tempfile
import time
import uuid
from functools import lru_cache
from typing import Any

from pyspark.sql import DataFrame, SparkSession

KEPT = 2  # builds that stay, the current one among them
ABANDONED_HOURS = 72  # after which a build that was never published goes


class _Store:
    """The few calls to Hadoop's file system that publishing needs."""

    def __init__(self, spark: SparkSession, root: str) -> None:
        self.jvm = spark._jvm
        self.files = self.path(root).getFileSystem(spark._jsc.hadoopConfiguration())

    def path(self, name: str):
        return self.jvm.org.apache.hadoop.fs.Path(name)

    def names(self, folder: str) -> dict[str, int]:
        """Names in a folder with their times in milliseconds."""
        place = self.path(folder)
        if not self.files.exists(place):
            return {}
        return {s.getPath().getName(): s.getModificationTime() for s in self.files.listStatus(place)}

    def write(self, name: str, text: str) -> None:
        out = self.files.create(self.path(name), False)
        try:
            out.write(bytearray(text.encode()))
        finally:
            out.close()

    def read(self, name: str) -> str:
        stream = self.files.open(self.path(name))
        try:
            return self.jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
        finally:
            stream.close()

    def rename(self, old: str, new: str) -> bool:
        """False where the new name is taken."""
        if self.files.exists(self.path(new)):
            return False
        return self.files.rename(self.path(old), self.path(new))

    def delete(self, name: str) -> None:
        self.files.delete(self.path(name), True)


def new_build(root: str) -> str:
    """The folder of a new build; nobody reads it yet."""
    return f"{root.rstrip('/')}/builds/{uuid.uuid4().hex}"


def _manifests(store: _Store, root: str) -> list[str]:
    return sorted(n for n in store.names(f"{root}/published") if n.endswith(".json") and n[0].isdigit())


def publish(spark: SparkSession, root: str, build: str, facts: dict[str, Any] | None = None) -> int:
    """Make a finished build the current one; gives its number. ``facts`` go into the manifest."""
    root = root.rstrip("/")
    store = _Store(spark, root)
    draft = f"{root}/published/draft-{uuid.uuid4().hex}"
    store.write(draft, json.dumps({"build": build.rsplit("/", 1)[1], **(facts or {})}, ensure_ascii=False))
    number = 1 + int((_manifests(store, root) or ["0"])[-1].split(".")[0])
    while not store.rename(draft, f"{root}/published/{number:012d}.json"):
        number += 1  # another build was published meanwhile
    return number


def manifest(spark: SparkSession, root: str) -> dict[str, Any]:
    """The newest manifest."""
    root = root.rstrip("/")
    store = _Store(spark, root)
    names = _manifests(store, root)
    if not names:
        raise ValueError(f"nothing is published below {root}")
    return json.loads(store.read(f"{root}/published/{names[-1]}"))


def current(spark: SparkSession, root: str) -> str:
    """The folder of the current build."""
    return f"{root.rstrip('/')}/builds/{manifest(spark, root)['build']}"


def every(spark: SparkSession, root: str) -> list[str]:
    """The folders of all published builds, for tables that grow by builds instead of being replaced."""
    root = root.rstrip("/")
    store = _Store(spark, root)
    return [f"{root}/builds/{json.loads(store.read(f'{root}/published/{name}'))['build']}" for name in _manifests(store, root)]


def is_published(spark: SparkSession, root: str) -> bool:
    return bool(_manifests(_Store(spark, root), root.rstrip("/")))


def state_of(spark: SparkSession, path: str) -> list[tuple[str, int]]:
    """Names and times of the files of a table, one file or a folder: changes when the table does."""
    store = _Store(spark, path)
    return sorted(store.names(path).items())


def scratch(spark: SparkSession, name: str) -> str:
    """A folder for tables that a session keeps for itself, below spark.checkpoint.dir.

    Only a local session without that setting gets a folder of its own.
    """
    context = spark.sparkContext
    folder = context.getConf().get("spark.checkpoint.dir") or spark.conf.get("spark.checkpoint.dir", None)
    if folder is None:
        if not context.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
        folder = _local_folder()
    return f"{folder.rstrip('/')}/{context.applicationId}/{name}"


def stored(df: DataFrame, name: str, by: str | None = None) -> DataFrame:
    """The rows as a table of the session, written once: what follows reads it instead of making the rows again.

    ``by`` names a column whose values get folders of their own.
    """
    place = f"{scratch(df.sparkSession, name)}-{uuid.uuid4().hex}"
    (df.write.partitionBy(by) if by else df.write).parquet(place)
    return df.sparkSession.read.schema(df.schema).parquet(place)


@lru_cache(maxsize=1)
def _local_folder() -> str:
    return tempfile.mkdtemp(prefix="kept-")


def drop_folder(spark: SparkSession, folder: str) -> None:
    _Store(spark, folder).delete(folder)


def tidy(spark: SparkSession, root: str, keep: int = KEPT, abandoned_hours: float = ABANDONED_HOURS) -> list[str]:
    """Delete superseded builds, and old ones that were never published; gives their names."""
    root = root.rstrip("/")
    store = _Store(spark, root)
    names = _manifests(store, root)
    owners = {name: json.loads(store.read(f"{root}/published/{name}"))["build"] for name in names}
    kept = {owners[name] for name in names[-keep:]}
    limit = (time.time() - abandoned_hours * 3600) * 1000
    gone = []
    for build, at in store.names(f"{root}/builds").items():
        if build not in kept and (build in owners.values() or at < limit):
            store.delete(f"{root}/builds/{build}")
            gone.append(build)
    for name in names[:-keep]:
        store.delete(f"{root}/published/{name}")
    return gone

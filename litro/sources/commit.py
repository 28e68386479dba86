"""Publishing of staged partition folders by renames, so that data written once is not written again.

In the first phase every folder is brought below the target's root under a hidden name: by a rename where
both lie in one store that can, else by a copy. In the second each takes the place of what is there, one
rename away and one rename in. If that fails the old folder is put back. A run that died in between left
the old folder under a hidden name, from which the next one restores it. One writer at a time.
"""

from __future__ import annotations

import uuid
from collections.abc import Sequence

from pyspark.sql import SparkSession

from litro.sources.remote import hadoop_path

#: Hidden folders: readers skip names that start with an underscore and hold no `=`.
NEW, OLD = "_publishing-", "_replaced-"


class Store:
    """The few file operations that publishing takes, on the store of a folder."""

    def __init__(self, spark: SparkSession, root: str):
        self.spark = spark
        self.files, self.root = hadoop_path(spark, root)

    def at(self, *names: str):
        path = self.root
        for name in names:
            path = self.spark._jvm.org.apache.hadoop.fs.Path(path, name)
        return path

    def exists(self, path) -> bool:
        return self.files.exists(path)

    def folders(self, path) -> list[str]:
        return [s.getPath().getName() for s in self.files.listStatus(path) if s.isDirectory()] if self.exists(path) else []

    def rename(self, source, target) -> None:
        self.files.mkdirs(target.getParent())
        if not self.files.rename(source, target):
            raise OSError(f"Cannot rename {source} to {target}")

    def bring(self, source: str, target) -> None:
        """A folder of any store, by rename if it lies in this one."""
        other, path = hadoop_path(self.spark, source)
        self.files.mkdirs(target.getParent())
        if other.getUri().equals(self.files.getUri()) and self.files.rename(path, target):
            return
        conf = self.spark._jsc.hadoopConfiguration()
        if not self.spark._jvm.org.apache.hadoop.fs.FileUtil.copy(other, path, self.files, target, False, True, conf):
            raise OSError(f"Cannot copy {path} to {target}")

    def delete(self, path) -> None:
        self.files.delete(path, True)


def recover(store: Store) -> list[str]:
    """Puts back what a run that died had moved away and not replaced; returns those partitions."""
    back = []
    for hidden in store.folders(store.root):
        if hidden.startswith(OLD):
            for first in store.folders(store.at(hidden)):
                for second in store.folders(store.at(hidden, first)):
                    partition = f"{first}/{second}"
                    if not store.exists(store.at(partition)):
                        store.rename(store.at(hidden, partition), store.at(partition))
                        back.append(partition)
        if hidden.startswith((OLD, NEW)):
            store.delete(store.at(hidden))
    return back


def publish_folders(spark: SparkSession, staged: str, root: str, partitions: Sequence[str]) -> None:
    """Replaces the named partitions (`ano=…/semestre=…`) of `root` by those of `staged`; others stay.

    Names reach the driver, data doesn't. An error leaves the partition it concerns as it was, and those
    before it published.
    """
    store, token = Store(spark, root), uuid.uuid4().hex[:12]
    recover(store)
    new, old = f"{NEW}{token}", f"{OLD}{token}"
    try:
        for partition in partitions:
            store.bring(f"{staged.rstrip('/')}/{partition}", store.at(new, partition))
        for partition in partitions:
            target, kept = store.at(partition), store.at(old, partition)
            replaced = store.exists(target)
            if replaced:
                store.rename(target, kept)
            try:
                store.rename(store.at(new, partition), target)
            except BaseException:
                if replaced:
                    store.rename(kept, target)
                raise
    finally:
        store.delete(store.at(new))
        store.delete(store.at(old))

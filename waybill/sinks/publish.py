"""Publishing several report directories as a whole.

All reports are first written to a folder of their own beside the published
ones. Only when the last is there, a list of them is written, and then each
takes the place of its predecessor. A job that fails before the list leaves
what was published as it was; one that fails after it is finished by the next
``publish`` or ``recover`` on the same folder, which moves what is left.
"""

from __future__ import annotations

import json
import posixpath
import uuid
from collections.abc import Callable, Iterable
from urllib.parse import unquote

from pyspark.sql import DataFrame, SparkSession

from waybill.sinks.parquet import report_path

_FRESH, _LIST = "_fresh-", "_complete.json"


class Store:
    """The few file operations needed, on any file system that Spark reads."""

    def __init__(self, spark: SparkSession, base: str) -> None:
        self._jvm = spark.sparkContext._jvm
        conf = spark.sparkContext._jsc.hadoopConfiguration()
        self._fs = self._path(base).getFileSystem(conf)

    def _path(self, path: str):
        return self._jvm.org.apache.hadoop.fs.Path(path)

    def exists(self, path: str) -> bool:
        return self._fs.exists(self._path(path))

    def names(self, folder: str) -> list[str]:
        if not self.exists(folder):
            return []
        return sorted(s.getPath().getName() for s in self._fs.listStatus(self._path(folder)))

    def sizes(self, folder: str) -> dict[str, tuple[int, int]]:
        """File name -> bytes and time of change."""
        found = self._fs.listStatus(self._path(folder))
        return {s.getPath().getName(): (s.getLen(), s.getModificationTime()) for s in found}

    def move(self, source: str, target: str) -> None:
        if not self._fs.rename(self._path(source), self._path(target)):
            raise OSError(f"cannot move {source} to {target}")

    def remove(self, path: str) -> None:
        self._fs.delete(self._path(path), True)

    def write_text(self, path: str, text: str) -> None:
        """The whole text or no file: it is written beside and then moved."""
        beside = f"{path}.{uuid.uuid4().hex}"
        out = self._fs.create(self._path(beside), True)
        try:
            out.write(bytearray(text.encode()))
        finally:
            out.close()
        self.move(beside, path)

    def read_text(self, path: str) -> str:
        source = self._fs.open(self._path(path))
        try:
            return bytes(source.readAllBytes()).decode()
        finally:
            source.close()


def _take_places(store: Store, base: str, fresh: str, names: Iterable[str]) -> None:
    """Move every report still in ``fresh`` to its place; may be repeated at any point."""
    for name in names:
        new, place = report_path(f"{base}/{fresh}", name), report_path(base, name)
        if store.exists(new):
            store.remove(place)
            store.move(new, place)
    store.remove(f"{base}/{fresh}")


def recover(spark: SparkSession, base: str) -> None:
    """Finish a publication that was cut short after all its reports were there."""
    base = base.rstrip("/")
    store = Store(spark, base)
    for fresh in store.names(base):
        listed = f"{base}/{fresh}/{_LIST}"
        if fresh.startswith(_FRESH) and store.exists(listed):
            _take_places(store, base, fresh, json.loads(store.read_text(listed)))


def publish(
    spark: SparkSession,
    base: str,
    names: Iterable[str],
    write: Callable[[str], None],
) -> dict[str, str]:
    """Let ``write`` put all reports below a fresh folder, then publish them; name -> directory.

    If ``write`` fails, nothing published has changed and the fresh folder is removed.
    """
    base, names = base.rstrip("/"), list(names)
    recover(spark, base)
    store, fresh = Store(spark, base), f"{_FRESH}{uuid.uuid4().hex}"
    try:
        write(f"{base}/{fresh}")
    except BaseException:
        store.remove(f"{base}/{fresh}")
        raise
    store.write_text(f"{base}/{fresh}/{_LIST}", json.dumps(names))
    _take_places(store, base, fresh, names)
    return {name: report_path(base, name) for name in names}


def listed_files(spark: SparkSession, source: DataFrame) -> dict[str, tuple]:
    """The files behind a plain read, as Spark writes their paths -> bytes and time of change.

    Spark writes a path as a URL, with blanks and the like encoded; folders are
    listed by their real names.
    """
    stores, listed, found = {}, {}, {}
    for path in source.inputFiles():
        folder, name = posixpath.split(unquote(path))
        if folder not in listed:
            root = "/".join(folder.split("/", 3)[:3]) if "://" in folder else "/"
            stores.setdefault(root, Store(spark, folder))
            listed[folder] = stores[root].sizes(folder)
        found[path] = listed[folder].get(name, (None, None))
    return found

"""The index of known keys as tables: built from registry, manifest and blocklist, kept up with appends."""

from __future__ import annotations

import json
import shutil
from pathlib import Path
from uuid import uuid4

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from loamline.control import named_lock, replace_atomically
from loamline.operators.registry import FIELDS, known_keys
from loamline.sources.files import read_blocklist, read_manifest, read_registry, signature

_KEYS = "kind string, value string"


class CorpusIndex:
    """kind (url, title, id) and value of everything that is known, in folders that a small file names.

    The file holds the signature of the sources that the folders were made from, so a lookup rebuilds
    them exactly when a source has changed behind the index's back. An append writes a folder of the
    keys that are new and then swaps the file; readers see the old list of folders or the new one.
    folder must be one that the driver and all executors share.
    """

    def __init__(self, spark: SparkSession, folder: str, registry: str, manifest: str, blocklist: str):
        self.spark, self.folder = spark, Path(folder)
        self.registry, self.manifest, self.blocklist = registry, manifest, blocklist

    def sources(self) -> str:
        return signature(self.spark, self.registry, self.manifest, self.blocklist)

    def _meta(self) -> dict:
        path = self.folder / "index.json"
        return json.loads(path.read_text()) if path.exists() else {"signature": None, "folders": []}

    def _swap(self, signed: str, folders: list[str]) -> None:
        replace_atomically(self.folder / "index.json", json.dumps({"signature": signed, "folders": folders}).encode())

    def _write(self, keys: DataFrame) -> str:
        name = f"keys-{uuid4().hex}"
        keys.write.parquet(str(self.folder / name))
        return name

    def keys(self) -> DataFrame:
        """What the index holds, as it is."""
        folders = [str(self.folder / name) for name in self._meta()["folders"]]
        return self.spark.read.schema(_KEYS).parquet(*folders) if folders else self.spark.createDataFrame([], _KEYS)

    def rebuild(self) -> None:
        signed, before = self.sources(), self._meta()["folders"]
        entries = read_registry(self.spark, self.registry).select(*FIELDS)
        known = known_keys(read_manifest(self.spark, self.manifest), entries, read_blocklist(self.spark, self.blocklist))
        self._swap(signed, [self._write(known)])
        for name in before:
            shutil.rmtree(self.folder / name, ignore_errors=True)

    def ensure(self) -> None:
        """Rebuilds the index unless it was made from the sources as they are now."""
        if self._meta()["signature"] == self.sources():
            return
        with named_lock(self.folder, "corpus-index", timeout=120):
            if self._meta()["signature"] != self.sources():
                self.rebuild()

    def lookup(self, include_blocklist: bool = True) -> DataFrame:
        """The known keys, fresh. Keys of blocked addresses can't be told apart, so leaving them out is an error."""
        if not include_blocklist:
            raise ValueError("the index does not know which keys come from the blocklist; use known_keys without it")
        self.ensure()
        return self.keys()

    def record_appended(self, entries: DataFrame, prior: str) -> bool:
        """Adds the keys of entries that were appended to the registry, if the index was fresh before (prior).

        False: it was stale already, and the next lookup rebuilds it.
        """
        with named_lock(self.folder, "corpus-index", timeout=120):
            meta = self._meta()
            if meta["signature"] != prior:
                return False
            fresh = known_keys(entries.limit(0), entries).join(self.keys(), ["kind", "value"], "left_anti")
            self._swap(self.sources(), [*meta["folders"], self._write(fresh.select(F.col("kind"), F.col("value")))])
            return True

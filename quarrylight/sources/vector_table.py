"""Vector tables: embeddings of texts, kept in versions that readers see whole or not at all.

A table is a folder in a shared store. Rows lie in data folders that are written once and never changed; a manifest names
the data folders of a version, the folder with the ids that the version holds, and the contract of the embedder that made
the vectors. Manifests are numbered; the newest one is the table. A run writes its data first and its manifest last, under
a name that may not exist yet: a run that dies before leaves the old version, and of two runs on one version one fails.

``sync`` embeds only texts whose id the table lacks; ids that are no longer wanted leave the version without rewriting
vectors. ``compact`` rewrites what is left into one folder, ``vacuum`` deletes folders that no kept version names.
"""

from __future__ import annotations

import json
import uuid
from datetime import UTC, datetime

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from quarrylight.operators.embedding import Embedder, embedded

FORMAT = 1


class ContractMismatch(ValueError):
    """The table's vectors were made by another embedder."""


class NoManifest(ValueError):
    """There is no table, or one whose embedder nobody wrote down."""


def content_id(text: Column, *of: Column) -> Column:
    """An id of a text and of what it belongs to; columns are told apart and nulls from empty strings."""
    part = lambda c: F.coalesce(F.concat(F.length(c.cast("string")).cast("string"), F.lit(":"), c.cast("string")), F.lit("-"))
    return F.sha2(F.concat(*(part(c) for c in (*of, text))), 256)


class VectorTable:
    def __init__(self, spark: SparkSession, path: str, embedder: Embedder, collection: str = "default"):
        self.spark, self.path, self.embedder, self.collection = spark, path.rstrip("/"), embedder, collection

    # files of the table, in whatever store it lies in

    def _fs(self, path: str):
        where = self.spark._jvm.org.apache.hadoop.fs.Path(path)
        return where.getFileSystem(self.spark._jsc.hadoopConfiguration()), where

    def versions(self) -> list[int]:
        fs, where = self._fs(f"{self.path}/manifests")
        if not fs.exists(where):
            return []
        names = (f.getPath().getName() for f in fs.listStatus(where))
        return sorted(int(n.removesuffix(".json")) for n in names if n.endswith(".json"))

    def manifest(self, version: int | None = None) -> dict | None:
        """The manifest of a version, by default the newest one; None if there is none. One that can't be read is an error."""
        found = self.versions()
        if not found:
            return None
        fs, where = self._fs(f"{self.path}/manifests/{found[-1] if version is None else version:010d}.json")
        stream = fs.open(where)
        try:
            raw = bytes(self.spark._jvm.org.apache.hadoop.io.IOUtils.readFullyToByteArray(stream))
        finally:
            stream.close()
        try:
            told = json.loads(raw)
            if told["format"] != FORMAT or not {"version", "fingerprint", "contract", "collections"} <= told.keys():
                raise ValueError("unknown format or missing entries")
        except (ValueError, KeyError, TypeError) as error:
            raise NoManifest(f"the manifest {where} can't be read: {error}") from error
        return told

    def _commit(self, told: dict) -> None:
        """Puts a manifest in place in one step; fails if that version exists already."""
        jvm = self.spark._jvm
        target = f"{self.path}/manifests/{told['version']:010d}.json"
        fs, temporary = self._fs(f"{self.path}/manifests/.{uuid.uuid4().hex}.tmp")
        out = fs.create(temporary, False)
        try:
            out.write(bytearray(json.dumps(told, sort_keys=True, indent=1).encode()))
        finally:
            out.close()
        context = jvm.org.apache.hadoop.fs.FileContext.getFileContext(temporary.toUri(), self.spark._jsc.hadoopConfiguration())
        none = jvm.org.apache.hadoop.fs.Options.Rename.NONE
        options = self.spark.sparkContext._gateway.new_array(jvm.org.apache.hadoop.fs.Options.Rename, 1)
        options[0] = none
        context.rename(temporary, jvm.org.apache.hadoop.fs.Path(target), options)

    # reading

    def checked(self) -> dict:
        """The newest manifest, if this embedder made its vectors and the collection is in it."""
        told = self.manifest()
        if told is None:
            raise NoManifest(f"no manifest below {self.path}: it isn't known which embedder made its vectors; sync builds the table")
        self._same_embedder(told)
        if self.collection not in told["collections"]:
            raise NoManifest(f"the table {self.path} has no collection {self.collection!r}")
        return told

    def _same_embedder(self, told: dict) -> None:
        if told["fingerprint"] != self.embedder.fingerprint():
            raise ContractMismatch(f"the table {self.path} holds vectors of {told['contract']['name']} ({told['fingerprint']}), asked with {self.embedder.name} ({self.embedder.fingerprint()}); build a new one or use that embedder")

    def _rows(self, told: dict | None, name: str) -> DataFrame:
        """(id, embedding) of the folders, or (id) of the version."""
        entry = (told or {}).get("collections", {}).get(self.collection)
        kind = "id string" if name == "ids" else "id string, embedding array<double>"
        paths = [] if entry is None else [entry["ids"]] if name == "ids" else [f["folder"] for f in entry["data"]]
        return self.spark.read.schema(kind).parquet(*(f"{self.path}/{p}" for p in paths)) if paths else self.spark.createDataFrame([], kind)

    def read(self) -> DataFrame:
        """(id, embedding) of the newest version."""
        told = self.checked()
        entry = told["collections"][self.collection]
        rows = self._rows(told, "data")
        return rows if sum(f["rows"] for f in entry["data"]) == entry["rows"] else rows.join(self._rows(told, "ids"), "id", "left_semi")

    # writing

    def _next(self, told: dict | None, entry: dict) -> dict:
        collections = dict((told or {}).get("collections", {}))
        collections[self.collection] = entry
        return {
            "format": FORMAT,
            "version": (told["version"] if told else 0) + 1,
            "created": datetime.now(UTC).isoformat(),
            "fingerprint": self.embedder.fingerprint(),
            "contract": self.embedder.contract(),
            "collections": collections,
        }

    def _write(self, df: DataFrame, name: str) -> tuple[str, int]:
        folder = f"data/{name}-{uuid.uuid4().hex}"
        df.write.parquet(f"{self.path}/{folder}")
        return folder, self.spark.read.schema(df.schema).parquet(f"{self.path}/{folder}").count()

    def sync(self, wanted: DataFrame, rebuild: bool = False) -> DataFrame:
        """Makes the table hold exactly the ids of wanted (id, text): (id, action), action being embedded, reused or removed.

        Rows that repeat an id are one; their texts must be equal, which content_id() sees to. With nothing to add or
        remove no version is made. With rebuild all is embedded anew, and the embedder may be another one; other
        collections of the table are then dropped, since their vectors are not comparable.
        """
        told = self.manifest()
        if told is not None and not rebuild:
            self._same_embedder(told)
        base = None if rebuild else told
        held = self._rows(base, "ids")
        if rebuild and told is not None:  # a new line of versions, without the old collections
            base, told = None, {**told, "collections": {}}
        once = wanted.where(F.col("id").isNotNull()).select(F.col("id").cast("string").alias("id"), "text").dropDuplicates(["id"])
        folder, n = self._write(once.select("id"), "ids")
        ids = self.spark.read.schema("id string").parquet(f"{self.path}/{folder}")
        lacking = ids.join(held, "id", "left_anti")
        missing = wanted.select(F.col("id").cast("string").alias("id"), "text").join(lacking, "id", "left_semi").dropDuplicates(["id"])
        added, rows = self._write(missing.select("id", embedded(F.col("text"), self.embedder).alias("embedding")), "vectors")
        gone = held.join(ids, "id", "left_anti")
        entry = (base or {}).get("collections", {}).get(self.collection, {"data": []})
        report = lacking.withColumn("action", F.lit("embedded")).unionByName(ids.join(held, "id", "left_semi").withColumn("action", F.lit("reused"))).unionByName(gone.withColumn("action", F.lit("removed")))
        if rows or not entry.get("ids") or not gone.isEmpty():
            data = entry["data"] + ([{"folder": added, "rows": rows}] if rows else [])
            self._commit(self._next(told, {"data": data, "ids": folder, "rows": n}))
        return report

    def compact(self) -> None:
        """Rewrites the newest version's vectors into one folder, without rows that it no longer holds."""
        told = self.checked()
        folder, rows = self._write(self.read(), "vectors")
        self._commit(self._next(told, {**told["collections"][self.collection], "data": [{"folder": folder, "rows": rows}]}))

    def vacuum(self, keep: int = 1) -> list[str]:
        """Deletes manifests but the newest ``keep``, and data folders that none of those names; their names. Run it when no other run writes."""
        if keep < 1:
            raise ValueError("at least one version must stay")
        named: set[str] = set()
        for version in self.versions()[-keep:]:
            for entry in self.manifest(version)["collections"].values():
                named |= {entry["ids"], *(f["folder"] for f in entry["data"])}
        for version in self.versions()[:-keep]:
            fs, where = self._fs(f"{self.path}/manifests/{version:010d}.json")
            fs.delete(where, False)
        fs, where = self._fs(f"{self.path}/data")
        found = [f"data/{f.getPath().getName()}" for f in fs.listStatus(where)] if fs.exists(where) else []
        gone = sorted(set(found) - named)
        for name in gone:
            fs.delete(self._fs(f"{self.path}/{name}")[1], True)
        return gone

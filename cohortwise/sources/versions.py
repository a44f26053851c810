"""Versioned lookup tables with an unversioned view of the newest rows.

Every publish writes a folder of its own that is never changed, and then one
small manifest that says which folder each version and each concept is read
from. A publish that breaks off before its manifest leaves the old view as it
was; readers that hold the old manifest go on reading the old folders. A
publish that names a part of the concepts (those that a diff calls new or
updated) rewrites these alone: the files of all others stay where they are.
"""

from __future__ import annotations

import json
import uuid
from collections.abc import Iterable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from cohortwise.plans.sizing import write_balanced
from cohortwise.sources import smallfiles


def _order(version: str) -> list[int]:
    return [int(part) for part in version.split("_")]


class LookupStore:
    """Lookup rows by concept and version under ``root``.

    The rows need a ``concept`` (string); rows without one belong to no
    concept and are left out. Versions are numbers joined by underscores and
    compare by number. Manifests and the driver hold one entry a concept.
    """

    def __init__(self, spark: SparkSession, root: str):
        self.spark, self.root = spark, root

    def _manifest(self) -> tuple[int, dict]:
        names = smallfiles.names(self.spark, f"{self.root}/manifests")
        if not names:
            return 0, {"schema": None, "versions": {}, "current": {}}
        return int(names[-1].split(".")[0]), json.loads(smallfiles.get(self.spark, f"{self.root}/manifests/{names[-1]}"))

    def publish(self, df: DataFrame, version: str, concepts: Iterable[str] | None = None) -> None:
        """Add ``df`` as ``version``; its concepts' rows replace older ones in the view.

        ``concepts`` names what is replaced where ``df`` may hold no row of
        some. A version published again replaces its earlier rows; one that is
        older than what the view shows for a concept does not change that
        concept's view. Two publishes at once cannot both win: the second one's
        manifest is refused.
        """
        number, manifest = self._manifest()
        rows = df.where(F.col("concept").isNotNull())
        schema = json.loads(rows.schema.json())
        if manifest["schema"] not in (None, schema):
            raise ValueError("the rows have other columns than those published before")
        folder = f"{version}-{uuid.uuid4().hex}"
        write_balanced(rows, f"{self.root}/data/{folder}", ["concept"])
        held = self._read({folder: None}, schema).select("concept").distinct()
        names = sorted({r.concept for r in held.collect()} | set(concepts or ()))
        manifest["schema"] = schema
        manifest["versions"][version] = {"folder": folder, "concepts": names}
        for name in names:
            shown = manifest["current"].get(name)
            if shown is None or _order(shown[0]) <= _order(version):
                manifest["current"][name] = [version, folder]
        smallfiles.put(self.spark, f"{self.root}/manifests/{number + 1:09d}.json", json.dumps(manifest))

    def _read(self, folders: dict[str, tuple[str, list[str]] | None], schema: dict) -> DataFrame:
        """Rows of some folders; of each either all, or the version and concepts that the view takes from it."""
        typed = StructType.fromJson(schema)
        parts = []
        for folder, of in folders.items():
            part = self.spark.read.schema(typed).parquet(f"{self.root}/data/{folder}").select(*typed.names)
            parts.append(part if of is None else part.where(F.col("concept").isin(of[1])).withColumn("version", F.lit(of[0])))
        if not parts:
            return self.spark.createDataFrame([], typed).withColumn("version", F.lit(""))
        out = parts[0]
        for part in parts[1:]:
            out = out.unionByName(part)
        return out

    def versions(self) -> list[str]:
        return sorted(self._manifest()[1]["versions"], key=_order)

    def version(self, version: str) -> DataFrame:
        """The rows published as ``version``."""
        _, manifest = self._manifest()
        return self._read({manifest["versions"][version]["folder"]: None}, manifest["schema"])

    def current(self) -> DataFrame:
        """Each concept's newest rows, with their ``version``: only the concepts in use are read of a folder."""
        _, manifest = self._manifest()
        if manifest["schema"] is None:
            raise LookupError(f"nothing is published under {self.root}")
        folders: dict[str, tuple[str, list[str]]] = {}
        for concept, (version, folder) in manifest["current"].items():
            folders.setdefault(folder, (version, []))[1].append(concept)
        return self._read(folders, manifest["schema"])

    def register_view(self, name: str) -> DataFrame:
        """Temporary view ``name`` over ``current()``, as of now."""
        latest = self.current()
        latest.createOrReplaceTempView(name)
        return latest

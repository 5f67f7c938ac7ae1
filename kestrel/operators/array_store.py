"""A keyed array store: datasets under a key, written and replaced by regions.

A dataset is a long-form array ``(dims..., value)``.  Every write covers one
region, a half-open box of index ranges, and replaces all cells of it
(``dset[2:5, :] = ...``); cells it does not give become absent.  The files of
a write are never changed: a write adds a folder and commits a new version of
the manifest, a small JSON file that lists the live regions in order.  The
commit is one rename that fails if the version exists, so readers see a whole
write or none, and of two writers at once the second tries again on top of
the first.

A read takes the newest manifest, leaves out regions that the asked slice
does not touch or that a later region covers, and reads every other region
with plain range filters: inside the slice, outside the later regions.  Cells
are sorted by their indices within files, so those filters reach the Parquet
statistics.  No join and no shuffle is needed to lay regions over each other.
"""

from __future__ import annotations

import json
import threading
import uuid
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

Region = Sequence[tuple[int, int]]
_COMMIT = threading.Lock()      # the local file system looks for the target and renames in two steps


def _inside(dims: Sequence[str], region: Region) -> Column:
    out = F.lit(True)
    for d, (lo, hi) in zip(dims, region):
        out = out & (F.col(d) >= lo) & (F.col(d) < hi)
    return out


def _meet(a: Region, b: Region) -> bool:
    return all(max(x[0], y[0]) < min(x[1], y[1]) for x, y in zip(a, b))


def _covers(outer: Region, inner: Region) -> bool:
    return all(o[0] <= i[0] and i[1] <= o[1] for o, i in zip(outer, inner))


class ArrayStore:
    """Datasets below ``root`` (any folder that Spark reads and writes)."""

    def __init__(self, spark: SparkSession, root: str):
        self.spark, self.root = spark, root.rstrip("/")

    def _folder(self, key: str) -> str:
        return f"{self.root}/{key.strip('/')}"

    def _fs(self, path: str):
        jvm = self.spark._jvm
        p = jvm.org.apache.hadoop.fs.Path(path)
        return p, p.getFileSystem(self.spark._jsc.hadoopConfiguration())

    def _version(self, key: str) -> int:
        p, fs = self._fs(f"{self._folder(key)}/_manifest")
        if not fs.exists(p):
            return 0
        names = [str(s.getPath().getName()) for s in fs.listStatus(p)]
        return max((int(n.split(".")[0]) for n in names if n.endswith(".json") and n[0].isdigit()), default=0)

    def manifest(self, key: str, version: int | None = None) -> dict:
        """The manifest of ``key`` (the newest, or an earlier version)."""
        version = version or self._version(key)
        if not version:
            raise KeyError(f"no dataset {key!r} in {self.root}")
        path = f"{self._folder(key)}/_manifest/{version:012d}.json"
        return json.loads(self.spark.read.text(path, wholetext=True).first()[0])

    def keys(self) -> list[str]:
        """Keys of the datasets directly below ``root``."""
        p, fs = self._fs(self.root)
        names = [str(s.getPath().getName()) for s in fs.listStatus(p)] if fs.exists(p) else []
        return sorted(n for n in names if self._version(n))

    def _commit(self, key: str, version: int, manifest: dict) -> bool:
        """Publish ``manifest`` as ``version``; False if that version exists."""
        folder = f"{self._folder(key)}/_manifest"
        tmp, fs = self._fs(f"{folder}/_{uuid.uuid4().hex}")
        out = fs.create(tmp, False)
        out.write(bytearray(json.dumps(manifest).encode()))
        out.close()
        jvm, gateway = self.spark._jvm, self.spark.sparkContext._gateway
        target, _ = self._fs(f"{folder}/{version:012d}.json")
        context = jvm.org.apache.hadoop.fs.FileContext.getFileContext(target.toUri(), self.spark._jsc.hadoopConfiguration())
        plain = gateway.new_array(jvm.org.apache.hadoop.fs.Options.Rename, 0)      # rename that refuses to overwrite
        try:
            with _COMMIT:
                context.rename(tmp, target, plain)
            return True
        except Exception:
            if not fs.exists(target):
                raise
            fs.delete(tmp, False)
            return False

    def write(self, key: str, region: Region, cells: DataFrame, dims: Sequence[str], value: str = "value") -> int:
        """Write ``cells`` ``(dims..., value)`` as ``region`` of dataset ``key``
        (made by its first write) and return the new version.

        A cell outside the region, or a dataset of other dims or types, is
        refused before anything is published.  A cell given twice stays twice."""
        region, dims = [(int(lo), int(hi)) for lo, hi in region], list(dims)
        if len(region) != len(dims):
            raise ValueError("a region has one range per dimension")
        cells = cells.select(*[F.col(d).cast("bigint").alias(d) for d in dims], F.col(value).alias("value"))
        part = f"part-{uuid.uuid4().hex}"
        path = f"{self._folder(key)}/{part}"
        cells.repartitionByRange(*dims).sortWithinPartitions(*dims).write.parquet(path)
        outside = self.spark.read.schema(cells.schema).parquet(path).filter(~F.coalesce(_inside(dims, region), F.lit(False)))
        if not outside.isEmpty():
            self._remove(path)
            raise ValueError(f"cells outside the region {region}")
        entry = {"path": part, "region": region}
        while True:
            version = self._version(key)
            old = self.manifest(key, version) if version else {"dims": dims, "schema": cells.schema.jsonValue(), "parts": []}
            if old["dims"] != dims or [f["type"] for f in old["schema"]["fields"]] != [f["type"] for f in cells.schema.jsonValue()["fields"]]:
                self._remove(path)
                raise ValueError(f"dataset {key!r} has other dimensions or types")
            live = [p for p in old["parts"] if not _covers(region, p["region"])]
            if self._commit(key, version + 1, old | {"parts": [*live, entry]}):
                return version + 1

    def _remove(self, path: str) -> None:
        p, fs = self._fs(path)
        fs.delete(p, True)

    def read(self, key: str, region: Region | None = None, version: int | None = None) -> DataFrame:
        """The cells of ``key`` (inside ``region``), later writes over earlier ones."""
        m = self.manifest(key, version)
        schema, dims, parts = StructType.fromJson(m["schema"]), m["dims"], m["parts"]
        out = None
        for k, p in enumerate(parts):
            later = [q["region"] for q in parts[k + 1:]
                     if _meet(q["region"], p["region"]) and (region is None or _meet(q["region"], region))]
            if region is not None and not _meet(region, p["region"]):
                continue
            cells = self.spark.read.schema(schema).parquet(f"{self._folder(key)}/{p['path']}")
            if region is not None and not _covers(region, p["region"]):
                cells = cells.filter(_inside(dims, region))
            for r in later:
                cells = cells.filter(~_inside(dims, r))
            out = cells if out is None else out.unionByName(cells)
        return out if out is not None else self.spark.createDataFrame([], schema)

    def compact(self, key: str) -> int:
        """Rewrite all live cells as one region per dataset, so that reads
        open one folder; earlier versions stay readable until ``vacuum``."""
        version = self._version(key)
        m = self.manifest(key, version)
        if len(m["parts"]) < 2:
            return version
        box = [[min(p["region"][d][0] for p in m["parts"]), max(p["region"][d][1] for p in m["parts"])] for d in range(len(m["dims"]))]
        part = f"part-{uuid.uuid4().hex}"
        self.read(key, version=version).repartitionByRange(*m["dims"]).sortWithinPartitions(*m["dims"]) \
            .write.parquet(f"{self._folder(key)}/{part}")
        if self._commit(key, version + 1, m | {"parts": [{"path": part, "region": box}]}):
            return version + 1
        self._remove(f"{self._folder(key)}/{part}")
        raise RuntimeError(f"{key!r} was written meanwhile: compact again")

    def vacuum(self, key: str) -> None:
        """Delete the manifests before the newest and the folders it does not name."""
        newest = self._version(key)
        live = {p["path"] for p in self.manifest(key, newest)["parts"]}
        for folder, keep in ((self._folder(key), live), (f"{self._folder(key)}/_manifest", {f"{newest:012d}.json"})):
            p, fs = self._fs(folder)
            for s in fs.listStatus(p):
                name = str(s.getPath().getName())
                if name not in keep and (name.startswith("part-") or name.endswith(".json")):
                    fs.delete(s.getPath(), True)

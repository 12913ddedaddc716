"""Tables that storing procedures change: all of a call or nothing.

Layout of a stored table's folder::

    data/<id>/<column>=<value>/part-*.parquet    rows of one call, apart by what became of them
    commits/000000000007.json                    which of these folders are the table

A call writes its rows once, into a folder of its own, and then commits a
manifest that names it (``sources.manifest``).  Before the commit nobody sees
the rows; a call that fails anywhere leaves the table as it was and may
simply be made again.  A call that names its ``request`` is applied once,
however often it is made.  Readers keep the version they opened: ``pack`` and later calls
write new folders, and ``vacuum`` removes only what no kept version names.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from stockroom.session import scratch_dir
from stockroom.sources.manifest import KEEP, ConflictError, Manifest
from stockroom import files

REQUESTS = 10_000      # latest requests that are remembered
FILE_BYTES = 128 << 20
ATTEMPTS = 5


class StoredTable:
    def __init__(self, spark: SparkSession, path: str, schema: StructType):
        self.spark, self.path, self.schema = spark, path.rstrip("/"), schema
        self.manifest = Manifest(spark, f"{self.path}/commits")

    # -- reading -----------------------------------------------------------
    def version(self) -> int:
        """The latest version, -1 if nothing was committed."""
        return self.manifest.latest()[0]

    def _at(self, folder: str) -> str:
        """Folders of the table's own are named from its path."""
        return f"{self.path}/{folder}" if folder.startswith("data/") else folder

    def _open(self, dirs: list[str], schema: StructType) -> DataFrame:
        if not dirs:
            return self.spark.createDataFrame([], schema)
        return self.spark.read.schema(schema).parquet(*map(self._at, dirs))

    def rows(self, version: int | None = None) -> DataFrame:
        """The table as of ``version`` (the latest)."""
        doc = self.manifest.latest()[1] if version is None else self.manifest.read(version)
        return self._open(doc.get("rows", []), self.schema)

    def refused(self, version: int | None = None) -> DataFrame:
        """Rows that calls did not let in, with the reason."""
        doc = self.manifest.latest()[1] if version is None else self.manifest.read(version)
        schema = StructType.fromJson(doc["refused_schema"]) if "refused_schema" in doc else self.schema
        if not doc.get("refused"):
            return self.spark.createDataFrame([], schema).withColumn(doc.get("reason", "verdict"), F.lit(""))
        parts = [self._open([d], schema).withColumn(doc["reason"], F.lit(d.rsplit("=", 1)[1])) for d in doc["refused"]]
        out = parts[0]
        for p in parts[1:]:
            out = out.unionByName(p)
        return out

    # -- changing ----------------------------------------------------------
    def check_target(self) -> None:
        """A folder that holds anything but a stored table is not written to."""
        names = set(files.child_names(self.spark, self.path))
        if files.exists(self.spark, self.path) and not names <= {"data", "commits"}:
            raise ValueError(f"refusing to write {self.path}: it exists and is not a stored table")

    def adopt(self, dirs: list[str]) -> int:
        """Begin a table with Parquet folders that lie elsewhere; nothing is copied."""
        self.check_target()
        return self.manifest.commit({"rows": list(dirs), "refused": [], "requests": []}, -1)

    def write(self, rows: DataFrame, by: str) -> dict[str, str]:
        """Write ``rows`` once, apart by the column ``by``: folder of each value."""
        name = f"data/{uuid.uuid4().hex}"
        rows.write.partitionBy(by).parquet(f"{self.path}/{name}")
        return {n.split("=", 1)[1]: f"{name}/{n}" for n in files.child_names(self.spark, f"{self.path}/{name}")
                if n.startswith(f"{by}=")}

    def change(self, judge: Callable[[DataFrame | None, str], DataFrame], by: str, accepted: set[str],
               request: str | None = None, base: DataFrame | None = None, replace: bool = False) -> DataFrame:
        """Apply one call: ``judge(existing, scratch)`` gives its rows with the
        column ``by`` (``scratch`` is a folder that is removed when they are written); those with a value of ``accepted`` join the table (``replace``:
        become the table), the others are kept as refused.  ``base`` is the
        table before the first call, copied once (``adopt`` instead copies
        nothing).  If another writer commits meanwhile the rows are judged again."""
        self.check_target()
        for attempt in range(ATTEMPTS):
            version, doc = self.manifest.latest()
            if request is not None and request in doc.get("requests", []):
                return self.rows(version)
            kept = list(doc.get("rows", []))
            if version < 0 and base is not None and not replace:
                name = f"data/{uuid.uuid4().hex}"
                base.select(*self.schema.fieldNames()).write.parquet(f"{self.path}/{name}")
                kept = [name]
            existing = self._open(kept, self.schema) if version >= 0 or kept else base
            scratch = scratch_dir(self.spark, "call")
            try:
                rows = judge(existing, scratch)
                got = self.write(rows, by)
            finally:
                files.remove(self.spark, scratch)
            new = [d for v, d in sorted(got.items()) if v in accepted]
            refused_schema = StructType([f for f in rows.schema.fields if f.name != by])
            after = {"rows": new if replace else kept + new,
                     "refused": doc.get("refused", []) + [d for v, d in sorted(got.items()) if v not in accepted],
                     "refused_schema": refused_schema.jsonValue(), "reason": by,
                     "requests": (doc.get("requests", []) + ([request] if request is not None else []))[-REQUESTS:]}
            try:
                return self.rows(self.manifest.commit(after, version))
            except ConflictError:
                if attempt + 1 == ATTEMPTS:
                    raise
        raise AssertionError("unreachable")

    # -- upkeep ------------------------------------------------------------
    def pack(self, file_bytes: int = FILE_BYTES) -> int:
        """Bring folders whose files are small on average together in files of
        about ``file_bytes``; a new version, the rows stay the same."""
        version, doc = self.manifest.latest()
        small, large, total = [], [], 0
        for d in doc.get("rows", []):
            held = files.sizes(self.spark, self._at(d))
            if held and sum(held.values()) / len(held) < file_bytes / 2:
                small.append(d)
                total += sum(held.values())
            else:
                large.append(d)
        if len(small) < 2:
            return version
        name = f"data/{uuid.uuid4().hex}"
        self._open(small, self.schema).repartition(max(1, -(-total // file_bytes))).write.parquet(f"{self.path}/{name}")
        return self.manifest.commit({**doc, "rows": large + [name]}, version)

    def vacuum(self, keep: int = KEEP) -> int:
        """Remove the folders that neither the latest version nor the ``keep``
        before it name: left by failed calls, or packed since.  Not while a
        call is running.  Returns how many went."""
        self.manifest.trim(keep)
        named = {d for v in self.manifest.versions() for k in ("rows", "refused")
                 for d in self.manifest.read(v).get(k, []) if d.startswith("data/")}
        gone = []
        for call in files.child_names(self.spark, f"{self.path}/data"):
            own = f"data/{call}"
            if own in named:
                continue
            parts = [f"{own}/{n}" for n in files.child_names(self.spark, f"{self.path}/{own}") if "=" in n]
            # a folder goes as a whole if no part of it is named
            gone += [p for p in parts if p not in named] if named.intersection(parts) else [own]
        for d in gone:
            files.remove(self.spark, f"{self.path}/{d}")
        return len(gone)

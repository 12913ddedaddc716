"""Segments: what a trigger's committed batches wrote, folded off the stream.

A stream leaves one small folder for each batch.  A *round* folds the batches
that were committed since the last one into a segment, and whenever ``fanout``
segments of one level stand there it folds them, with the new batches, into
one of the next level.  So a row is written once a level: what rounds rewrite
grows with the logarithm of the number of batches, and at most
``fanout - 1`` segments of each level are open to readers.  A segment of
``full_bytes`` is as large as files need to be and is not folded again.

A manifest (``sources.manifest``) says which segments count.  Readers take
it, and the folders of the batches behind it.  What a round replaces (segments
and batch folders) stays until the next round, so a reader that opened the
output survives one round.  A round that fails leaves nothing that counts; its
folder is removed by the next.  One writer per output.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from stockroom.sources.manifest import Manifest
from stockroom import files

FANOUT = 4
FULL_BYTES = 1 << 30


class Segments:
    """Segments of one output below ``folder``."""

    def __init__(self, spark: SparkSession, folder: str, fanout: int = FANOUT, full_bytes: int = FULL_BYTES):
        self.spark, self.folder = spark, folder.rstrip("/")
        self.fanout, self.full_bytes = fanout, full_bytes
        self.manifest = Manifest(spark, f"{self.folder}/commits")

    def current(self) -> tuple[int, list[dict]]:
        """(the last batch that is folded, the segments)."""
        doc = self.manifest.latest()[1]
        return doc.get("upto", -1), doc.get("segments", [])

    def path(self, segment: dict) -> str:
        return f"{self.folder}/data/{segment['name']}"

    def _chosen(self, segments: list[dict]) -> tuple[list[dict], int]:
        """The segments that the new batches are folded with, and the level."""
        rest, level, chosen = list(segments), 0, []
        while True:
            same = [s for s in rest if s["level"] == level and s["bytes"] < self.full_bytes]
            if len(same) + 1 < self.fanout:
                return chosen, level
            rest = [s for s in rest if s not in same]
            chosen = same + chosen
            level += 1

    def round(self, upto: int, write: Callable[[list[dict], int, str], None]) -> dict | None:
        """Fold the batches up to ``upto``.  ``write(segments, after, path)``
        writes the rows of these segments and of the batches ``after < n <=
        upto`` to ``path``.  Returns the new segment (None: nothing to do)."""
        version, doc = self.manifest.latest()
        after, segments = doc.get("upto", -1), doc.get("segments", [])
        if upto <= after:
            return None
        self._clean(doc)
        chosen, level = self._chosen(segments)
        name = uuid.uuid4().hex
        path = f"{self.folder}/data/{name}"
        write(chosen, after, path)
        made = {"name": name, "level": level, "lo": min([after + 1, *(s["lo"] for s in chosen)]), "hi": upto,
                "bytes": sum(files.sizes(self.spark, path).values())}
        left = [s for s in segments if s not in chosen]
        self.manifest.commit({"upto": upto, "segments": left + [made], "replaced": [s["name"] for s in chosen],
                              "before": after}, version)
        self.manifest.trim()
        return made

    def _clean(self, doc: dict) -> None:
        """Remove what the round before replaced, and what failed rounds left."""
        named = {s["name"] for s in doc.get("segments", [])}
        for n in files.child_names(self.spark, f"{self.folder}/data"):
            if n not in named:
                files.remove(self.spark, f"{self.folder}/data/{n}")

    def settled(self) -> int:
        """The last batch that was folded a round ago: its folder is no longer
        named by this manifest or the one before."""
        return self.manifest.latest()[1].get("before", -1)

    def open(self, segments: list[dict] | None = None, **options: str) -> DataFrame | None:
        """The rows of the segments (None if there are none)."""
        segments = self.current()[1] if segments is None else segments
        if not segments:
            return None
        return self.spark.read.options(**options).parquet(*map(self.path, segments))

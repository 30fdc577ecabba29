"""A replicated table: a versioned base, a log of changes, and a manifest that says which changes the base holds.

Layout below ``root``::

    log/<stream>/batch=<id>/     changes of one micro-batch; a replay of the batch overwrites its folder
    base/<version>-<token>/      latest version of each key, deleted ones marked
    versions/<version>.json      manifest: the base folder, and per stream the last batch folded into it

A version counts from the moment its manifest is there, which is published by one rename. A fold writes a
new base beside the old one and then its manifest, so a crash between the two leaves a folder that nobody
reads. Readers take one manifest and the batches after those it names: whoever started before a fold goes on
reading the state of before, and a read costs the base and the changes since the last fold, however old
the log is. Batch numbers only grow, so a manifest stays as small as the number of streams.
"""

from __future__ import annotations

import json
import uuid
from collections.abc import Sequence
from typing import NamedTuple

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.streaming import StreamingQuery

from ..operators.versions import latest_by_key
from ..sources import folders
from .cdc import VERSION, initial_load


class Manifest(NamedTuple):
    version: int
    base: str
    folded: dict[str, int]  # stream -> last batch in the base


class Replica:
    """``keys`` identify a row of the table; changes are those of ``cdc.changes``."""

    def __init__(self, spark: SparkSession, root: str, keys: Sequence[str] = ("id",)):
        self.spark, self.root, self.keys = spark, root.rstrip("/"), list(keys)

    # --- versions ---------------------------------------------------------------
    def _numbers(self, ending: str) -> list[int]:
        return sorted(int(n.removesuffix(ending)) for n in folders.names(self.spark, f"{self.root}/versions")
                      if n.endswith(ending) and n.removesuffix(ending).isdigit())

    def manifest(self, version: int | None = None) -> Manifest:
        """The newest manifest, or that of ``version``."""
        known = self._numbers(".json")
        if not known or version is not None and version not in known:
            raise LookupError(f"{self.root} has no version {'' if version is None else version}".rstrip())
        number = known[-1] if version is None else version
        return Manifest(number, **json.loads(folders.read_text(self.spark, f"{self.root}/versions/{number:08d}.json")))

    def _write_version(self, rows: DataFrame, folded: dict[str, int]) -> Manifest:
        number = max(self._numbers(".json") + self._numbers(".claim"), default=0) + 1
        folders.claim(self.spark, f"{self.root}/versions/{number:08d}.claim")  # of two folds at once, one stops here
        base = f"base/{number:08d}-{uuid.uuid4().hex[:8]}"
        rows.write.mode("error").parquet(f"{self.root}/{base}")
        self._commit(number, base, folded)
        return Manifest(number, base, folded)

    def _commit(self, number: int, base: str, folded: dict[str, int]) -> None:
        folders.publish(self.spark, f"{self.root}/versions/{number:08d}.json", json.dumps({"base": base, "folded": folded}))

    def load(self, snapshot: DataFrame, ts: int = 0) -> Manifest:
        """First version: a full copy, older than any streamed change."""
        if self._numbers(".json"):
            raise ValueError(f"{self.root} has been loaded already")
        return self._write_version(initial_load(snapshot, ts), {})

    # --- the log ----------------------------------------------------------------
    def append(self, changes: DataFrame, checkpoint: str, *, stream: str = "main", available_now: bool = False,
               interval: str = "1 minute") -> StreamingQuery:
        """Log a stream of changes, each micro-batch in the folder of its number.

        ``stream`` names the checkpoint: another checkpoint counts its batches anew and needs a name of its own.
        """
        target = f"{self.root}/log/{stream}"

        def write(batch: DataFrame, batch_id: int) -> None:
            batch.write.mode("overwrite").parquet(f"{target}/batch={batch_id}")

        writer = changes.writeStream.foreachBatch(write).option("checkpointLocation", checkpoint)
        writer = writer.trigger(availableNow=True) if available_now else writer.trigger(processingTime=interval)
        return writer.start()

    def _batches(self, stream: str) -> list[int]:
        """Finished batches of a stream that are still in the log."""
        found = [int(n.removeprefix("batch=")) for n in folders.names(self.spark, f"{self.root}/log/{stream}") if n.startswith("batch=")]
        return sorted(b for b in found if folders.exists(self.spark, f"{self.root}/log/{stream}/batch={b}/_SUCCESS"))

    def pending(self, manifest: Manifest | None = None) -> dict[str, list[int]]:
        """Batches of each stream that the manifest's base does not hold."""
        folded = (manifest or self.manifest()).folded
        streams = folders.names(self.spark, f"{self.root}/log")
        return {s: [b for b in self._batches(s) if b > folded.get(s, -1)] for s in streams}

    def _paths(self, manifest: Manifest, batches: dict[str, list[int]]) -> list[str]:
        return [f"{self.root}/{manifest.base}", *(f"{self.root}/log/{s}/batch={b}" for s, ids in sorted(batches.items()) for b in ids)]

    # --- reading and folding ------------------------------------------------------
    def _rows(self, manifest: Manifest, batches: dict[str, list[int]]) -> DataFrame:
        paths = self._paths(manifest, batches)
        base = self.spark.read.parquet(paths[0])
        rows = base if len(paths) == 1 else base.unionByName(self.spark.read.schema(base.schema).parquet(*paths[1:]))
        return rows if len(paths) == 1 else latest_by_key(rows, self.keys, list(VERSION))

    def state(self, version: int | None = None) -> DataFrame:
        """Live rows as of now: the newest base and the changes since. With ``version``, that base alone."""
        manifest = self.manifest(version)
        batches = self.pending(manifest) if version is None else {}
        return self._rows(manifest, batches).filter("is_deleted = 0").drop("is_deleted", *VERSION)

    def fold(self) -> Manifest:
        """A new version with all finished batches in its base. Delete marks stay, so that a late change revives nothing."""
        manifest = self.manifest()
        batches = self.pending(manifest)
        if not any(batches.values()):
            return manifest
        folded = manifest.folded | {s: ids[-1] for s, ids in batches.items() if ids}
        return self._write_version(self._rows(manifest, batches), folded)

    def trim(self, keep: int = 1) -> None:
        """Remove what no version but the last ``keep`` + 1 needs: older bases and manifests, bases without a manifest,
        and batches that the oldest version kept holds already. Readers of the versions kept go on undisturbed.

        Not to be run beside a fold, whose unfinished base it would take for a crashed one's."""
        kept = [self.manifest(v) for v in self._numbers(".json")[-(keep + 1):]]
        bases = {m.base for m in kept}
        for name in folders.names(self.spark, f"{self.root}/base"):
            if f"base/{name}" not in bases:
                folders.remove(self.spark, f"{self.root}/base/{name}")
        for ending in (".json", ".claim"):
            for number in self._numbers(ending):
                if number < kept[0].version:
                    folders.remove(self.spark, f"{self.root}/versions/{number:08d}{ending}")
        for stream, last in kept[0].folded.items():
            for b in self._batches(stream):
                if b <= last:
                    folders.remove(self.spark, f"{self.root}/log/{stream}/batch={b}")

"""Steps of a run that are done once: a manifest of what is finished, keyed by the run's inputs and parameters."""

from __future__ import annotations

import hashlib
import json
import time
from collections.abc import Callable
from dataclasses import asdict

from pyspark.sql import SparkSession
from pyspark.sql import functions as F

from ..sources import places
from ..sources.files import RunConfig, require_input

# Raise it when a step writes something else than before.
LAYOUT = 2
_NO_PART = ("output", "shuffle_partitions", "resume")


def _files(spark: SparkSession, path: str) -> list:
    """Number, bytes and a sum of hashes of a path's files: their names, lengths and times; contents are not read."""
    listed = require_input(spark, path, "binaryFile")
    one = F.xxhash64("path", "length", F.col("modificationTime").cast("double")).cast("decimal(38,0)")
    found = listed.agg(F.count(F.lit(1)), F.coalesce(F.sum("length"), F.lit(0)), F.coalesce(F.sum(one), F.lit(0))).first()
    return [str(x) for x in found]


def fingerprint(spark: SparkSession, config: RunConfig) -> str:
    """The same for runs that would write the same."""
    told = {k: v for k, v in asdict(config).items() if k not in _NO_PART}
    inputs = {name: _files(spark, path) for name in ("sales", "targets", "geography") if (path := told[name])}
    text = json.dumps([LAYOUT, told, inputs], sort_keys=True)
    return hashlib.sha256(text.encode()).hexdigest()


class Steps:
    """What a run has done, in files under ``folder``.

    A step's record is put there after its work and taken away before it, so that it never stands beside
    what another run has half written.  Records of other inputs or parameters count for nothing.
    """

    def __init__(self, spark: SparkSession, folder: str, fingerprint: str):
        self.spark, self.folder, self.fingerprint = spark, folder, fingerprint
        self.skipped: list[str] = []

    def _record(self, name: str) -> dict | None:
        text = places.get_text(self.spark, f"{self.folder}/{name}.json")
        found = json.loads(text) if text else {}
        return found if found.get("fingerprint") == self.fingerprint else None

    def once(self, name: str, work: Callable[[], dict]) -> dict:
        """The facts ``work`` gave, with its seconds; not done again where the record says it is done."""
        found = self._record(name)
        if found is not None:
            self.skipped.append(name)
            return found["facts"]
        self.forget(name)
        began = time.monotonic()
        facts = work() | {"seconds": round(time.monotonic() - began, 3)}
        places.put_text(self.spark, f"{self.folder}/{name}.json", json.dumps({"fingerprint": self.fingerprint, "facts": facts}))
        return facts

    def forget(self, name: str) -> None:
        places.delete(self.spark, f"{self.folder}/{name}.json")

"""A table that micro-batches fold into: cut by a hash of its key, committed by one small file a batch.

A batch reads and rewrites only the cuts that its keys touch.  Its commit says
which version of each cut is current; until that file is there, readers see the
batch before.  A batch that died before its commit is written again, one that
comes again after it changes nothing.
"""

from __future__ import annotations

import json
from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..sources import files

Merge = Callable[[DataFrame], DataFrame]


@dataclass(frozen=True)
class KeyedTable:
    spark: SparkSession
    uri: str
    keys: tuple[str, ...]
    merge: Merge  # rows of some keys, old and new, to the rows that stay; the same for all at once as for some after others
    cuts: int = 256

    def _commits(self) -> list[int]:
        return sorted(int(n.removesuffix(".json")) for n in files.names(self.spark, f"{self.uri}/commits") if n.endswith(".json"))

    def _state(self, batch: int | None) -> dict[str, int]:
        """Version of each cut as of a batch."""
        return {} if batch is None else json.loads(files.read_text(self.spark, f"{self.uri}/commits/{batch:012d}.json"))["cuts"]

    def _read(self, state: dict[str, int], only: set[str] | None = None) -> DataFrame | None:
        paths = [f"{self.uri}/data/batch={version}/cut={cut}" for cut, version in sorted(state.items()) if only is None or cut in only]
        return self.spark.read.parquet(*paths) if paths else None

    def fold(self, rows: DataFrame, batch: int) -> None:
        """Fold a batch in; batches come in ascending order, any of them more than once."""
        done = self._commits()
        if batch in done:
            return
        if done and batch < done[-1]:
            raise ValueError(f"batch {batch} comes after {done[-1]}")
        dealt = rows.withColumn("cut", F.pmod(F.xxhash64(*self.keys), F.lit(self.cuts)).cast("string"))
        touched = {r["cut"] for r in dealt.select("cut").distinct().collect()}  # `cuts` at most
        state = self._state(done[-1] if done else None)
        old = self._read(state, touched)
        every = rows if old is None else old.unionByName(rows, allowMissingColumns=True)
        kept = self.merge(every).withColumn("cut", F.pmod(F.xxhash64(*self.keys), F.lit(self.cuts)).cast("string"))
        if touched:
            kept.repartition("cut").write.mode("overwrite").partitionBy("cut").parquet(f"{self.uri}/data/batch={batch}")
        self._commit(batch, state | dict.fromkeys(touched, batch))

    def _commit(self, batch: int, state: dict[str, int]) -> None:
        files.write_text(self.spark, f"{self.uri}/commits/{batch:012d}.json", json.dumps({"cuts": state, "of": self.cuts}, sort_keys=True), fresh=True)

    def current(self, batch: int | None = None) -> DataFrame:
        """The table as of the last commit, or of an earlier batch that is kept."""
        done = [b for b in self._commits() if batch is None or b <= batch]
        found = self._read(self._state(done[-1])) if done else None
        if found is None:
            raise FileNotFoundError(f"{self.uri} has no rows")
        return found

    def vacuum(self, keep: int = 1) -> list[int]:
        """Forget all but the last `keep` commits, and the batches that none of those needs; says which data went."""
        done = self._commits()
        stay = done[-keep:]
        needed = {v for b in stay for v in self._state(b).values()}
        for b in done[: -keep or None]:
            files.delete(self.spark, f"{self.uri}/commits/{b:012d}.json")
        gone = [v for n in files.names(self.spark, f"{self.uri}/data") if n.startswith("batch=") and (v := int(n[6:])) not in needed and (not stay or v <= stay[-1])]
        for v in gone:
            files.delete(self.spark, f"{self.uri}/data/batch={v}")
        return gone

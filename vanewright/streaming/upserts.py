"""A keyed table that micro-batches upsert into."""

from __future__ import annotations

import json
from collections.abc import Sequence
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import DateType, IntegralType, LongType, StructType

from vanewright.operators.bounded import MAX_BYTES, rows_if_small
from vanewright.operators.keyed import first_per_key, merge_rows
from vanewright.sources import files

#: The columns that say which batch of which stream a row comes from; rows of a rebuild are older than all batches.
_STREAM, _BATCH = "_stream", "_batch"


@dataclass
class Manifest:
    """A version of the table: where each bucket's rows lie, and the last batch of each stream folded into them."""

    version: int | None = None
    buckets: dict[str, int] = field(default_factory=dict)
    done: dict[int, int] = field(default_factory=dict)

    def text(self) -> str:
        return json.dumps({"buckets": self.buckets, "done": self.done})

    @staticmethod
    def of(version: int, text: str) -> "Manifest":
        known = json.loads(text)
        return Manifest(version, known["buckets"], {int(k): v for k, v in known["done"].items()})


class UpsertTable:
    """Keyed rows in buckets, plus one folder of changed rows per micro-batch.

    Applying a batch writes only that batch's rows, into a folder named by the stream and the batch id, so a replayed
    batch replaces itself, and one that is folded in already is left alone. Each checkpoint is a stream with a number of
    its own, claimed by creating a file that must not exist; changes of a larger number are newer. Every stored row
    carries the stream and batch it comes from, so the newest change of a key wins whenever and however often
    ``compact`` runs, and whatever order several streams write in.

    ``compact`` folds finished batches in: only the buckets they touch are written again, under the next version, and a
    manifest says for every bucket which version holds it. ``bucket`` is an expression over key columns alone; with the
    date of a time key, a day's changes rewrite that day. A version counts once its manifest is there. The last ``keep``
    manifests stay readable; what only older ones need, change folders and buckets, is removed.
    """

    def __init__(
        self, spark: SparkSession, root: str, keys: Sequence[str], schema: StructType, bucket: Column | None = None,
        buckets: int = 16, keep: int = 2,
    ):
        self.spark, self.root, self.keys, self.schema, self.keep = spark, root.rstrip("/"), list(keys), schema, keep
        hashed = F.pmod(F.xxhash64(*[F.col(k) for k in self.keys]), F.lit(buckets))
        bucket = hashed if bucket is None else bucket
        kind = spark.createDataFrame([], schema).select(bucket).schema[0].dataType
        named = F.coalesce(bucket.cast("string"), F.lit("none"))
        if isinstance(kind, DateType):  # far years have a plus
            self.bucket = F.replace(named, F.lit("+"), F.lit("-"))
        elif isinstance(kind, IntegralType):
            self.bucket = named
        else:  # also a folder's name; a pattern costs more than all else that a row's bucket takes
            self.bucket = F.regexp_replace(named, "[^0-9A-Za-z.-]", "-")

    # streams and their batches

    def stream_number(self, checkpoint: str) -> int:
        """The number of the stream that keeps this checkpoint. It is noted there; a new checkpoint claims the next."""
        path = f"{checkpoint.rstrip('/')}/upsert-stream"
        noted = files.read_text(self.spark, path)
        if noted is not None:
            return int(noted)
        number = files.claim_next(self.spark, f"{self.root}/streams", "number=", after=0)
        files.write_text(self.spark, path, str(number))
        return number

    def apply(
        self, batch: DataFrame, batch_id: int, order: Sequence[Column] = (), stream: int = 0, grouped: bool = False
    ) -> None:
        """Upsert a batch. Of several rows with one key the first in ``order`` is taken (without one: any). A batch that
        is ``grouped`` by the table's keys has one row each and is written as it comes, without a second grouping.

        The batches of a stream come in order; the last one may come again."""
        if batch_id <= self._manifest().done.get(stream, -1):
            return
        if order:
            batch = first_per_key(batch, self.keys, order)
        elif not grouped:
            batch = batch.dropDuplicates(self.keys)
        batch.select(*self.schema.names).write.mode("overwrite").parquet(self._change(stream, batch_id))

    def _change(self, stream: int, batch: int) -> str:
        return f"{self.root}/changes/{_STREAM}={stream}/{_BATCH}={batch}"

    def _unfolded(self, done: dict[int, int]) -> list[tuple[int, int]]:
        """(stream, batch) of the finished batches that are not folded in, in their order."""
        return [
            (stream, batch)
            for stream in files.numbers(self.spark, f"{self.root}/changes", f"{_STREAM}=")
            for batch in files.numbers(self.spark, f"{self.root}/changes/{_STREAM}={stream}", f"{_BATCH}=")
            if batch > done.get(stream, -1) and "_SUCCESS" in files.names(self.spark, self._change(stream, batch))
        ]

    # versions

    def _versions(self) -> list[int]:
        return files.numbers(self.spark, f"{self.root}/manifests", "version=")

    def _manifest(self, version: int | None = None) -> Manifest:
        versions = self._versions()
        if version is None and not versions:
            return Manifest()
        version = versions[-1] if version is None else version
        text = files.read_text(self.spark, f"{self.root}/manifests/version={version}")
        if text is None:
            raise FileNotFoundError(f"no version {version} of {self.root}")
        return Manifest.of(version, text)

    def _base(self, manifest: Manifest, buckets: Sequence[str]) -> DataFrame:
        """The stored rows of some buckets with the columns of today; columns they lacked are null."""
        tagged = self._tagged()
        paths = [f"{self.root}/base/version={manifest.buckets[b]}/bucket={b}" for b in buckets]
        if not paths:
            return self.spark.createDataFrame([], tagged)
        return self.spark.read.schema(tagged).parquet(*paths)

    def _tagged(self) -> StructType:
        return StructType(list(self.schema.fields)).add(_STREAM, LongType()).add(_BATCH, LongType())

    # reading

    def read(self, through: int | None = None) -> DataFrame:
        """Current rows; with ``through``, later batches left out."""
        manifest = self._manifest()
        new = [(s, b) for s, b in self._unfolded(manifest.done) if through is None or b <= through]
        return self._state(manifest, new, list(manifest.buckets), self._newest(new)).select(*self.schema.names)

    def _changes(self, batches: Sequence[tuple[int, int]]) -> DataFrame:
        paths = [self._change(*b) for b in batches]
        if not paths:
            return self.spark.createDataFrame([], self._tagged())
        return self.spark.read.schema(self._tagged()).option("basePath", f"{self.root}/changes").parquet(*paths)

    def _newest(self, batches: Sequence[tuple[int, int]]) -> DataFrame:
        """The newest change of each key."""
        return first_per_key(self._changes(batches), self.keys, [F.struct(_STREAM, _BATCH).desc()])

    def _newest_by_keys(self, batches: Sequence[tuple[int, int]]) -> DataFrame:
        """The same rows, for batches that mostly change different keys: the keys alone are counted first. While those
        of several batches are few, only they are looked up, and rows are neither shuffled nor sorted."""
        width = 1 + max(batch for _, batch in batches)
        changes = self._changes(batches).withColumn("_place", F.col(_STREAM) * F.lit(width) + F.col(_BATCH))
        again = changes.groupBy(*[F.col(k).alias(f"_again_{i}") for i, k in enumerate(self.keys)]).agg(
            F.max("_place").alias("_last"), F.count("*").alias("_times")
        ).where("_times > 1")
        found = rows_if_small(again)
        if found is None or sum(len(str(v)) for row in found for v in row) > MAX_BYTES:
            return self._newest(batches)
        older = F.col("_place") < F.col("_last")
        for i, k in enumerate(self.keys):
            older &= F.col(k).eqNullSafe(F.col(f"_again_{i}"))
        return changes.join(F.broadcast(again), older, "left_anti").drop("_place")

    def _state(
        self, manifest: Manifest, batches: Sequence[tuple[int, int]], buckets: Sequence[str], newest: DataFrame
    ) -> DataFrame:
        """Stored rows of some buckets with the newest change of each key laid over them."""
        base = self._base(manifest, buckets)
        if batches and manifest.done and batches[0][0] < max(manifest.done):
            # an earlier stream goes on after a later one was folded in: what that one wrote is newer
            stored = base.select(*self.keys, F.struct(_STREAM, _BATCH).alias("_stored"))
            older = newest.join(stored, self.keys).where(F.col("_stored") > F.struct(_STREAM, _BATCH))
            newest = newest.join(older.select(*self.keys), self.keys, "left_anti")
        return merge_rows(base, newest, self.keys) if buckets else newest

    # folding in

    def compact(self) -> int | None:
        """Fold all finished batches into a new version; None if there is nothing new."""
        manifest = self._manifest()
        batches = self._unfolded(manifest.done)
        if not batches:
            return None
        touched = [r[0] for r in self._changes(batches).select(self.bucket.alias("bucket")).distinct().collect()]
        stored = [b for b in touched if b in manifest.buckets]
        state = self._state(manifest, batches, stored, self._newest_by_keys(batches))
        return self._commit(state, manifest.buckets, {**manifest.done, **dict(batches)})

    def rebuild(self, df: DataFrame) -> int:
        """Replace all rows by ``df`` as a new version: batches applied so far no longer count."""
        done = self._manifest().done
        rows = df.select(*self.schema.names, *(F.lit(-1).cast("long").alias(c) for c in (_STREAM, _BATCH)))
        return self._commit(rows, {}, {**done, **dict(self._unfolded(done))})

    def _commit(self, rows: DataFrame, others: dict[str, int], done: dict[int, int]) -> int:
        """Write ``rows`` as the buckets they fall in, beside the ``others``; adaptive execution cuts large buckets into
        several files and gathers small ones."""
        latest = max([-1, *self._versions()])
        version = files.claim_next(self.spark, f"{self.root}/claims", "version=", after=latest)
        folder = f"{self.root}/base/version={version}"
        dealt = rows.withColumn("bucket", self.bucket).hint("rebalance", "bucket")
        dealt.write.partitionBy("bucket").mode("overwrite").parquet(folder)
        written = [n[len("bucket="):] for n in files.names(self.spark, folder) if n.startswith("bucket=")]
        manifest = Manifest(version, {**others, **dict.fromkeys(written, version)}, done)
        files.write_text(self.spark, f"{self.root}/manifests/version={version}", manifest.text())
        self._retire()
        return version

    def _retire(self) -> None:
        """Remove what only manifests before the last ``keep`` need. Versions without a manifest are left alone: another
        compaction may be writing them."""
        versions = self._versions()
        kept = [self._manifest(v) for v in versions[-self.keep:]]
        needed = {(b, v) for m in kept for b, v in m.buckets.items()}
        for version in versions[:-self.keep]:
            old = self._manifest(version)
            gone = [f"{self.root}/base/version={v}/bucket={b}" for b, v in old.buckets.items() if (b, v) not in needed]
            files.remove(self.spark, [*gone, f"{self.root}/manifests/version={version}", f"{self.root}/claims/version={version}"])
        for stream, last in kept[0].done.items() if len(kept) == self.keep else ():
            present = files.numbers(self.spark, f"{self.root}/changes/{_STREAM}={stream}", f"{_BATCH}=")
            files.remove(self.spark, [self._change(stream, b) for b in present if b <= last])

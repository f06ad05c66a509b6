"""Tables keyed by a text: rows lie in buckets of the key's hash.

A batch is compared with the buckets that its own keys fall in, and reads nothing but the key there, so
its cost follows the batch and not the table. Layout: `<path>/version=V/bucket=B/*.parquet`, and beside
it `<path>.state`, small lines that say how many buckets there are, which version counts, and the last
serial number given. One writer at a time.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import IntegerType, StructType

from webcorpus.operators.dedupe import first_wins, not_in
from webcorpus.session import written
from webcorpus.sources.files import exists, remove

# Buckets of a new table. At 100 TB take 16,384: a bucket is then some gigabytes.
BUCKETS = 16
# Most keys that are sent to every task that reads the table (some megabytes); more are joined by a shuffle.
SENT = 1 << 16

_STATE = "buckets int, version int, last long"


@dataclass(frozen=True)
class State:
    buckets: int
    version: int = 0
    last: int = 0


class KeyedTable:
    """The table at `path` with the columns of `schema`, keyed by its text column `key`."""

    def __init__(self, spark: SparkSession, path: str, schema: StructType, key: str,
                 buckets: int = BUCKETS) -> None:
        self.spark, self.path, self.schema, self.key = spark, path.rstrip("/"), schema, key
        self.fresh = State(buckets)

    @property
    def _state_path(self) -> str:
        return f"{self.path}.state"

    def exists(self) -> bool:
        return exists(self.spark, self._state_path)

    def state(self) -> State:
        """What the lines beside the table say; those of a table that does not exist yet."""
        if not self.exists():
            if exists(self.spark, self.path):
                raise ValueError(f"{self.path} holds files, but no keyed table")
            return self.fresh
        lines = self.spark.read.schema(_STATE).json(self._state_path)
        found = lines.agg(F.max("buckets"), F.max("version"), F.max("last")).first()
        return self.fresh if found[0] is None else State(*found)

    def _note(self, state: State) -> None:
        self.spark.range(1, numPartitions=1).select(
            F.lit(state.buckets).alias("buckets"), F.lit(state.version).alias("version"),
            F.lit(state.last).cast("long").alias("last")).write.mode("append").json(self._state_path)

    def bucket(self, key: Column, state: State) -> Column:
        return F.pmod(F.xxhash64(key), F.lit(state.buckets)).cast("int")

    def _files(self, state: State) -> DataFrame:
        kept = StructType([*self.schema.fields]).add("version", IntegerType()).add("bucket", IntegerType())
        place = f"{self.path}/version={state.version}"
        return self.spark.read.schema(kept).option("basePath", self.path).parquet(place)

    def _holds_rows(self, state: State) -> bool:
        return exists(self.spark, f"{self.path}/version={state.version}")

    def rows(self) -> DataFrame:
        """All rows; none while the table holds nothing."""
        state = self.state()
        if not self._holds_rows(state):
            return self.spark.createDataFrame([], self.schema)
        return self._files(state).select(self.schema.fieldNames())

    def _beside(self, keys: DataFrame, state: State | None) -> tuple[DataFrame, bool] | None:
        """The rows in the buckets of the different `keys`, and whether these keys are few."""
        state = state or self.state()
        if not self._holds_rows(state):
            return None
        touched = {r[0]: r[1] for r in keys.groupBy(self.bucket(F.col(self.key), state)).count().collect()}
        rows = self._files(state).filter(F.col("bucket").isin(sorted(touched))).select(self.schema.fieldNames())
        return rows, sum(touched.values()) <= SENT

    def among(self, keys: DataFrame, state: State | None = None) -> DataFrame | None:
        """The rows whose key is among the different `keys` of a batch; None while there are no rows.

        Only the buckets of these keys are read, and few keys go to the rows, which stay where they are.
        """
        if (found := self._beside(keys, state)) is None:
            return None
        rows, few = found
        wanted = keys.select(self.key)
        return rows.join(F.broadcast(wanted) if few else wanted, self.key, "left_semi")

    def beside(self, keys: DataFrame, state: State | None = None) -> DataFrame | None:
        """As `among`, but with many `keys` other rows of their buckets, too: for a join by the key.

        That join moves the rows anyhow; choosing them first would move them, with all they hold, twice.
        """
        if (found := self._beside(keys, state)) is None:
            return None
        rows, few = found
        return rows.join(F.broadcast(keys.select(self.key)), self.key, "left_semi") if few else rows

    def unseen(self, batch: DataFrame, arrival: str | list[str], state: State | None = None) -> DataFrame:
        """The first row of each key of `batch` that the table does not hold, written once."""
        first = written(first_wins(batch, self.key, arrival), "first")
        known = self.among(first.select(self.key), state)
        return first if known is None else not_in(first, self.key, known.select(self.key))

    def append(self, rows: DataFrame, state: State | None = None) -> None:
        """Add rows, in files of a reasonable size for each bucket, however many rows there are.

        `state` may carry a new last serial number. It is noted before the rows are written: a failure
        in between leaves a gap, never a number given twice.
        """
        state = state or self.state()
        self._note(state)
        placed = rows.select(self.schema.fieldNames()).withColumns(
            {"version": F.lit(state.version), "bucket": self.bucket(F.col(self.key), state)})
        placed.hint("rebalance", F.col("bucket")).write.partitionBy("version", "bucket") \
            .mode("append").parquet(self.path)

    def compact(self) -> None:
        """Write the small files that many batches leave anew, as few larger ones.

        Readers go on with the old files until the new ones are whole and noted. The old ones stay for
        them until the next compaction.
        """
        state = self.state()
        if not self._holds_rows(state):
            return
        following = State(state.buckets, state.version + 1, state.last)
        remove(self.spark, f"{self.path}/version={following.version}")  # what a failed compaction left
        self._files(state).withColumn("version", F.lit(following.version)).hint("rebalance", F.col("bucket")) \
            .write.partitionBy("version", "bucket").mode("append").parquet(self.path)
        self._note(following)
        if state.version:
            remove(self.spark, f"{self.path}/version={state.version - 1}")

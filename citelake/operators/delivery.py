"""Messages delivered more than once: a store that keeps one copy of each, batch by batch.

The store is cut into partitions by a hash of the identifier. Its identifier index is the identifier and order columns of the
partitions, which parquet keeps apart from the payload; a batch reads the index of the partitions it hits, never their
payload. The index tells for each incoming message whether its identifier is known and whether it beats the message kept so
far. New identifiers are added to their partition as further files. Only partitions where a kept message is beaten are read,
combined with the winners that beat it, and written again. The next manifest makes all of it visible at once; a batch that dies
before that leaves the store as it was, and taking it in again does the same.

A manifest is written beside and renamed to its number. On HDFS that rename is atomic and refuses an existing target, so of two
writers one fails. Local file systems and object stores don't promise that: there, let one writer at a time use a store.
Readers always see a whole version, since they take the highest number there is.
"""

from __future__ import annotations

import json
import uuid

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from citelake.session import drop_path, hadoop_path, scratch_path

ROWS_PER_PARTITION = 1_000_000
LEAST_SLOTS = 16


def winner_order(columns: list[str]) -> Column:
    """Smallest first, column by column; a null comes after every value."""
    parts = [x for i, c in enumerate(columns) for x in (F.col(c).isNull().alias(f"n{i}"), F.col(c).alias(f"v{i}"))]
    return F.struct(*parts)


class DeliveryStore:
    """One winning message per identifier: the first by `order` columns, nulls last.

    Messages without an identifier cannot be told to be copies; `merge` leaves them out. Of messages equal in identifier and
    order columns the one kept so far stays. `columns` are the payload; others, whatever their names, are not stored. A store
    at a path that has one goes on with it; its identifier, order and payload columns must be the same.
    """

    def __init__(self, spark: SparkSession, path: str, *, identifier: str, order: list[str], columns: list[str], rows_per_partition: int = ROWS_PER_PARTITION):
        self.spark, self.path = spark, path.rstrip("/")
        self.identifier, self.order = identifier, order
        self.columns = list(dict.fromkeys([identifier, *order, *columns]))
        # Stored under names of our own, so no payload column can clash with the store's.
        self.stored = {c: f"c{i}" for i, c in enumerate(self.columns)}
        self.key = self.stored[identifier]
        self.rows_per_partition = rows_per_partition
        self.manifest = self._latest()
        if self.manifest["columns"] and self.manifest["columns"] != self.columns:
            raise ValueError(f"the store has the columns {self.manifest['columns']}")

    def _versions(self) -> list[int]:
        fs, root = hadoop_path(self.spark, f"{self.path}/manifest")
        return sorted(int(n) for s in (fs.listStatus(root) if fs.exists(root) else []) if (n := s.getPath().getName()).isdigit())

    def _load(self, version: int) -> dict:
        fs, path = hadoop_path(self.spark, f"{self.path}/manifest/{version:010d}")
        stream = fs.open(path)
        try:
            return json.loads(bytes(stream.readAllBytes()).decode())
        finally:
            stream.close()

    def _latest(self) -> dict:
        versions = self._versions()
        return self._load(versions[-1]) if versions else {"version": 0, "columns": [], "schema": None, "slots": LEAST_SLOTS, "rows": 0, "files": {}, "batches": []}

    def _commit(self, **changes) -> None:
        manifest = self.manifest | changes | {"version": self.manifest["version"] + 1, "columns": self.columns}
        fs, beside = hadoop_path(self.spark, f"{self.path}/manifest/.{uuid.uuid4().hex}")
        stream = fs.create(beside)
        stream.write(json.dumps(manifest).encode())
        stream.close()
        target = hadoop_path(self.spark, f"{self.path}/manifest/{manifest['version']:010d}")[1]
        if fs.exists(target) or not fs.rename(beside, target):
            fs.delete(beside, False)
            raise RuntimeError("another writer has committed this version")
        self.manifest = manifest

    def _dirs(self, path: str) -> dict[int, str]:
        fs, root = hadoop_path(self.spark, path)
        names = [s.getPath().getName() for s in fs.listStatus(root) if s.isDirectory()] if fs.exists(root) else []
        return {int(n.removeprefix("slot=")): f"{path}/{n}" for n in names if n.startswith("slot=")}

    def _read(self, paths: list[str], schema: T.StructType) -> DataFrame:
        return self.spark.read.schema(schema).parquet(*paths) if paths else self.spark.createDataFrame([], schema)

    def _files(self, slots: list[int] | None = None) -> list[str]:
        files = self.manifest["files"]
        return [f for s in sorted(files, key=int) if slots is None or int(s) in slots for f in files[s]]

    @property
    def _schema(self) -> T.StructType:
        return T.StructType.fromJson(json.loads(self.manifest["schema"]))

    def _slot(self, slots: int) -> Column:
        return F.pmod(F.xxhash64(self.key), F.lit(slots))

    def _best(self, *after: str) -> Column:
        """Aggregates to the first row by order, then by `after`; map-side combined, so a hot identifier never meets in one task."""
        order = F.struct(winner_order([self.stored[c] for c in self.order]).alias("order"), *after)
        return F.min_by(F.struct(*after, *self.stored.values()), order).alias("w")

    def merge(self, batch: DataFrame, name: str) -> None:
        """Take in one batch; a batch of a name that was taken in before is ignored, so a rerun does no harm."""
        self.merge_all(batch, [name])

    def merge_all(self, batch: DataFrame, names: list[str]) -> None:
        """Take in several batches at once, `batch` holding the messages of all of them."""
        if set(names) <= set(self.manifest["batches"]):
            return
        if set(names) & set(self.manifest["batches"]):
            raise ValueError("some of these batches have been taken in before")
        rows = batch.select(*[F.col(f"`{c}`").alias(n) for c, n in self.stored.items()]).where(F.col(self.key).isNotNull())
        schema, slots, payload = rows.schema, self.manifest["slots"], list(self.stored.values())
        folder = f"{self.path}/data/{self.manifest['version'] + 1:06d}-{uuid.uuid4().hex}"
        index_columns = [self.key, *dict.fromkeys(self.stored[c] for c in self.order)]

        # The batch and the index of the partitions it hits, in one aggregation: the kept message goes first among equals.
        incoming = rows.withColumn("source", F.lit(1))
        known = self._read(self._files(self._hit(rows, slots)), T.StructType([f for f in schema if f.name in index_columns])).withColumn("source", F.lit(0))
        both = incoming.unionByName(known, allowMissingColumns=True)
        best = both.groupBy(self.key).agg(self._best("source"), F.min("source").alias("first_source"))
        won = best.where("w.source = 1").select(*[F.col(f"w.{c}").alias(c) for c in payload], (F.col("first_source") == 1).alias("fresh")).withColumn("slot", self._slot(slots))
        seen = Observation()
        won = won.observe(seen, F.count_if("fresh").alias("fresh"))
        won.hint("rebalance", "slot").write.partitionBy("fresh", "slot").parquet(f"{folder}/won")

        files = {int(s): f for s, f in self.manifest["files"].items()}
        beaten = self._dirs(f"{folder}/won/fresh=false")
        if beaten:
            # The beaten messages give way; a partition is of bounded size, and so are the winners of it.
            history = self._read(self._files(sorted(beaten)), schema).unionByName(self._read([beaten[s] for s in sorted(beaten)], schema))
            merged = history.groupBy(self.key).agg(self._best()).select(*[F.col(f"w.{c}").alias(c) for c in payload]).withColumn("slot", self._slot(slots))
            merged.hint("rebalance", "slot").write.partitionBy("slot").parquet(f"{folder}/merged")
            files |= {s: [f] for s, f in self._dirs(f"{folder}/merged").items()}
        for s, f in self._dirs(f"{folder}/won/fresh=true").items():
            files[s] = [*files.get(s, []), f]
        self._commit(schema=schema.json(), rows=self.manifest["rows"] + seen.get["fresh"], files=files, batches=[*self.manifest["batches"], *names], touched=sorted(beaten))
        if self.manifest["rows"] > 2 * slots * self.rows_per_partition:
            self.rearrange()

    def _hit(self, rows: DataFrame, slots: int) -> list[int]:
        """The partitions that have identifiers of a batch, at most `slots` numbers; in a store still at its least size, all."""
        if not self.manifest["files"] or slots <= LEAST_SLOTS:
            return list(range(slots))
        return [r["slot"] for r in rows.select(self._slot(slots).alias("slot")).distinct().collect()]

    def rearrange(self) -> None:
        """Write all partitions anew, each as one folder and twice as many while they are too large; so much only whenever the store has doubled."""
        slots = self.manifest["slots"]
        while self.manifest["rows"] > slots * self.rows_per_partition:
            slots *= 2
        folder = f"{self.path}/data/{self.manifest['version'] + 1:06d}-{uuid.uuid4().hex}"
        self._read(self._files(), self._schema).withColumn("slot", self._slot(slots)).hint("rebalance", "slot").write.partitionBy("slot").parquet(folder)
        self._commit(slots=slots, files={s: [f] for s, f in self._dirs(folder).items()}, touched=[])

    def vacuum(self, keep: int = 1) -> int:
        """Delete files that none of the last `keep` versions names; older versions can't be read then. Returns how many folders went."""
        versions = self._versions()
        used = {f for v in versions[-keep:] for of in self._load(v)["files"].values() for f in of}
        fs, root = hadoop_path(self.spark, f"{self.path}/data")
        gone = 0
        for run in fs.listStatus(root) if fs.exists(root) else []:
            base = f"{self.path}/data/{run.getPath().getName()}"
            for part in ("won/fresh=true", "won/fresh=false", "merged", ""):
                for path in self._dirs(f"{base}/{part}".rstrip("/")).values():
                    if path not in used:
                        gone += fs.delete(hadoop_path(self.spark, path)[1], True)
        for v in versions[:-keep]:
            fs.delete(hadoop_path(self.spark, f"{self.path}/manifest/{v:010d}")[1], False)
        return gone

    def read(self) -> DataFrame:
        """The winners as of the last commit."""
        if self.manifest["schema"] is None:
            raise ValueError("the store has no batch yet")
        return self._read(self._files(), self._schema).select(*[F.col(n).alias(c) for c, n in self.stored.items()])


def merges(sizes: list[int]) -> list[list[int]]:
    """Batches by place, grouped for merging: each group is at least as large as all before it together, the last one excepted.

    Looking into a store costs its size, so waiting batches are taken in by groups that double; all merges together then read
    no more index than there are messages.
    """
    out: list[list[int]] = []
    stored = waiting = 0
    for i, n in enumerate(sizes):
        if waiting == 0:
            out.append([])
        out[-1].append(i)
        waiting += n
        if waiting >= stored:
            stored, waiting = stored + waiting, 0
    return out


def merge_batches(df: DataFrame, *, identifier: str, order: list[str], columns: list[str], batch: str) -> DeliveryStore:
    """Put `df` through a new store in the shared folder, batch after batch by the column `batch` (null first).

    The needed columns are first laid out by batch, as deliveries would arrive, so no merge reads another's rows.
    """
    spark = df.sparkSession
    store = DeliveryStore(spark, scratch_path(spark, "deliveries"), identifier=identifier, order=order, columns=columns)
    rows = df.select(*[F.col(f"`{c}`").alias(n) for c, n in store.stored.items()], F.col(f"`{batch}`").alias("batch"))
    counts = rows.groupBy("batch").agg(F.count("*").alias("n")).collect()  # one row a batch
    sizes = sorted(((r["batch"], r["n"]) for r in counts), key=lambda x: (x[0] is not None, x[0]))
    landing = scratch_path(spark, "landing")
    parts = spark.createDataFrame([(b, i) for i, (b, _) in enumerate(sizes)], T.StructType([T.StructField("_batch", rows.schema["batch"].dataType), T.StructField("part", T.IntegerType())]))
    numbered = rows.join(F.broadcast(parts), F.col("batch").eqNullSafe(F.col("_batch"))).drop("batch", "_batch")
    numbered.hint("rebalance", "part").write.partitionBy("part").parquet(landing)
    landed = rows.drop("batch").schema
    back = [F.col(n).alias(c) for c, n in store.stored.items()]
    for group in merges([n for _, n in sizes]):
        store.merge_all(spark.read.schema(landed).parquet(*[f"{landing}/part={i}" for i in group]).select(*back), [str(sizes[i][0]) for i in group])
    if not sizes:
        store.merge_all(df.limit(0), ["none"])
    drop_path(spark, landing)
    return store


def superseded(df: DataFrame, winners: DataFrame, row: str) -> DataFrame:
    """`(row)` of the messages with no place among `winners`, as often as they are there; balanced by row, however hot an identifier is."""
    signed = df.select(F.col(row), F.lit(1).alias("n")).unionByName(winners.select(F.col(row), F.lit(-1).alias("n")))
    left = signed.groupBy(row).agg(F.sum("n").alias("n")).where("n > 0")
    return left.select(row, F.explode(F.sequence(F.lit(1), F.col("n").cast("int"))).alias("_")).drop("_")

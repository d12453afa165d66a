"""Tables of committed batches: what a reader sees changes from one commit to the next, never in between.

A batch is written to a folder of its own, `batch=<id>`, and then named in the manifest by one small file, which
appears as a whole.  Readers take the folders that the manifest names: the base, and the batches after it.  A batch
that failed before it was named is written anew when repeated; one that was named is not taken again.
Compaction merges the batches into the base, of which it rewrites only the buckets that they touch.

A batch may be dealt by keys: its rows lie in files by a hash of them, and the manifest says so.  Where all that a
version names is dealt alike, the planner is told, and rows of one key are brought together without a shuffle.

One job writes to a table; any number may read it.
"""

from __future__ import annotations

import json
import uuid
from collections.abc import Callable, Sequence
from dataclasses import dataclass, field
from functools import reduce

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from tidemart.session import held, shuffles_freed

#: Buckets of a base, by a hash of the keys.
BUCKETS = 64
#: How files are compressed: texts of changes repeat their field names.
COMPRESSION = {"compression": "zstd", "parquet.compression.codec.zstd.level": "6"}
#: Partitions, such as source tables, that a task writes side by side; a task with more sorts its rows, which are wide, by them.
WRITERS = 32
_ENTRY = "kind string, batch bigint, bucket int, buckets int, folder string, keys array<string>"
#: Keys by whose hash rows are dealt, and into how many files.
Deal = tuple[tuple[str, ...], int]


@dataclass
class Version:
    """What the manifest names: the base's folders by bucket, the last batch in it, and later batches."""

    upto: int | None = None
    base: dict[int, str] = field(default_factory=dict)
    buckets: int = BUCKETS
    deltas: dict[int, str] = field(default_factory=dict)
    base_deal: Deal | None = None
    delta_deals: dict[int, Deal | None] = field(default_factory=dict)

    @property
    def dealt(self) -> Deal | None:
        """How all that is named is dealt, if it is so alike."""
        deals = {*self.delta_deals.values(), *([self.base_deal] if self.base else [])}
        return deals.pop() if len(deals) == 1 else None

    @property
    def last(self) -> int | None:
        return max(self.deltas, default=self.upto)


def current_version(spark: SparkSession, path: str) -> Version:
    """The manifest as it is now; an empty version if there is none.  The driver gets one row per commit."""
    try:
        entries = spark.read.schema(_ENTRY).json(f"{path.rstrip('/')}/manifest").collect()
    except AnalysisException as error:
        if error.getCondition() != "PATH_NOT_FOUND":
            raise
        return Version()
    found = Version(upto=max((e.batch for e in entries if e.kind == "base"), default=None))
    for e in entries:
        if e.kind == "delta" and (found.upto is None or e.batch > found.upto):
            found.deltas[e.batch] = e.folder
            found.delta_deals[e.batch] = _deal(e)
        elif e.kind == "base" and e.batch == found.upto:
            found.buckets, found.base_deal = e.buckets, _deal(e)
            if e.folder:
                found.base[e.bucket] = e.folder
    return found


def _deal(entry) -> Deal | None:
    return (tuple(entry["keys"]), entry.buckets) if entry["keys"] else None


def _enter(spark: SparkSession, path: str, entries: Sequence[dict]) -> None:
    """Name folders in the manifest, in one file."""
    lines = "\n".join(json.dumps(e) for e in entries)
    spark.range(1).select(F.lit(lines).alias("value")).coalesce(1).write.mode("append").text(f"{path}/manifest")


def commit(
    rows: DataFrame, path: str, batch_id: int, partition_by: Sequence[str] = (), dealt_by: Sequence[str] = (),
) -> None:
    """Write a batch and make it visible, unless it is so already.

    With `dealt_by`, it is dealt by these keys into as many files as those before it, the first into one per shuffle partition.
    """
    spark, path = rows.sparkSession, path.rstrip("/")
    found = current_version(spark, path)
    if batch_id in found.deltas or found.upto is not None and batch_id <= found.upto:
        return
    folder, entry = f"batch={batch_id}", {}
    if dealt_by:
        known = {count for keys, count in filter(None, (found.base_deal, *found.delta_deals.values())) if keys == tuple(dealt_by)}
        entry = {"keys": list(dealt_by), "buckets": min(known, default=int(spark.conf.get("spark.sql.shuffle.partitions")))}
    _write(rows, f"{path}/{folder}", partition_by, (tuple(dealt_by), entry["buckets"]) if dealt_by else None)
    _enter(spark, path, [{"kind": "delta", "batch": batch_id, "folder": folder, **entry}])


def _write(rows: DataFrame, folder: str, partition_by: Sequence[str], deal: Deal | None = None) -> None:
    """Write a folder anew; the shuffles behind the rows end with it."""
    spark, writer = rows.sparkSession, rows.write.mode("overwrite").options(**COMPRESSION).partitionBy(*partition_by)
    with shuffles_freed(spark):
        if deal is None:
            with held(spark, {"spark.sql.maxConcurrentOutputFileWriters": str(WRITERS)}):
                writer.parquet(folder)
            return
        keys, count = deal
        # only a table can be written in buckets; it is of this folder, and is forgotten when written
        name = f"dealt_{uuid.uuid4().hex}"
        try:
            writer.bucketBy(count, *keys).format("parquet").option("path", folder).saveAsTable(name)
        finally:
            spark.sql(f"DROP TABLE IF EXISTS {name}")


def _hash(keys: Sequence[str], deal: Deal | None, count: int) -> Column:
    """The bucket of a row; that of dealt rows is the one of Spark's bucketed files."""
    return F.pmod(F.hash(*keys) if deal else F.xxhash64(*keys), F.lit(count)).cast("int")


def _read(spark: SparkSession, base_path: str, folders: Sequence[str], deal: Deal | None) -> DataFrame:
    rows = spark.read.option("basePath", base_path).parquet(*folders)
    if deal is None:
        return rows
    # the same files, with what their names say of the buckets; a reader has no option for it
    jvm, found = spark._jvm, rows._jdf.queryExecution().analyzed().relation()
    names = jvm.org.apache.spark.api.python.PythonUtils.toSeq
    spec = jvm.org.apache.spark.sql.catalyst.catalog.BucketSpec(deal[1], names(list(deal[0])), names([]))
    told = jvm.org.apache.spark.sql.execution.datasources.HadoopFsRelation(
        found.location(), found.partitionSchema(), found.dataSchema(), jvm.scala.Option.apply(spec), found.fileFormat(),
        found.options(), found.sparkSession())
    return DataFrame(spark._jsparkSession.baseRelationToDataFrame(told), spark)


def read_version(spark: SparkSession, path: str, version: Version, buckets: Sequence[int] | None = None) -> DataFrame | None:
    """The rows of a version with the `batch` they came in, those of the base with its last one; None if there are none.

    `buckets` reads only these of the base.
    """
    path = path.rstrip("/")
    folders = [f"{path}/{f}" for b, f in sorted(version.base.items()) if buckets is None or b in buckets]
    parts = [] if not folders else [_read(spark, f"{path}/merged", folders, version.dealt).drop("_run", "_bucket").withColumn(
        "batch", F.lit(version.upto).cast("long"))]
    if version.deltas:
        parts.append(_deltas(spark, path, version))
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), parts) if parts else None


def _deltas(spark: SparkSession, path: str, version: Version) -> DataFrame:
    folders = [f"{path}/{f}" for _, f in sorted(version.deltas.items())]
    return _read(spark, path, folders, version.dealt).withColumn("batch", F.col("batch").cast("long"))


def compact(
    spark: SparkSession, path: str, keys: Sequence[str], resolve: Callable[[DataFrame], DataFrame],
    partition_by: Sequence[str] = (), buckets: int = BUCKETS,
) -> None:
    """Merge the batches into the base, as `resolve` makes of the rows of a key what later reads need of them.

    Only buckets that a batch touches are read and rewritten; the switch is one manifest file.  The number of
    buckets is that of the first compaction, or that of the batches if these are dealt by the keys.  Files that the
    manifest no longer names stay for readers that have begun; such folders may be removed once no reader is older.
    """
    path, version = path.rstrip("/"), current_version(spark, path)
    if not version.deltas:
        return
    deal = version.dealt if version.dealt and version.dealt[0] == tuple(keys) else None
    if version.base and version.base_deal != deal:
        deal, count = version.base_deal, version.buckets
    else:
        count = deal[1] if deal else version.buckets if version.base else buckets
    bucket = _hash(keys, deal, count)
    touched = sorted(r["_bucket"] for r in _deltas(spark, path, version).select(bucket.alias("_bucket")).distinct().collect())
    rows = resolve(read_version(spark, path, version, touched)).drop("batch").withColumn("_bucket", bucket)
    folder = f"merged/_run={uuid.uuid4().hex}"
    # rows of batches that are dealt like the base lie by buckets already
    _write(rows if deal and version.dealt == deal else rows.repartition("_bucket"), f"{path}/{folder}", ["_bucket", *partition_by], deal)
    filled = {r["_bucket"] for r in spark.read.parquet(f"{path}/{folder}").select("_bucket").distinct().collect()}
    kept = {**{b: f for b, f in version.base.items() if b not in touched},
            **{b: f"{folder}/_bucket={b}" for b in touched if b in filled}}
    by = {"keys": list(keys)} if deal else {}
    _enter(spark, path, [{"kind": "base", "batch": version.last, "buckets": count, **by}] + [
        {"kind": "base", "batch": version.last, "bucket": b, "buckets": count, "folder": f, **by} for b, f in sorted(kept.items())])

"""Append-only tables written by micro-batches, safe to repeat.

A table is a folder of parts and a manifest. A part holds one batch, or a run of old batches that
were compacted; the manifest says which parts there are and what columns they have, so a reader opens
one small file and then exactly the parts it asks for, however long the stream has run. Every append
writes a new manifest, and the newest one counts.

Parts are compacted in tiers: as soon as there are FAN old parts of one tier, they become one part of
the next, so n batches are about FAN * log(n) parts and a row is rewritten log(n) times. What no
manifest refers to any more stays readable for GRACE further appends and is then removed.
"""

from __future__ import annotations

import json
from dataclasses import dataclass, field

from pyspark.sql import DataFrame, Row, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import IntegerType, StructField, StructType

from vitalgrid.streaming import files

#: Parts of one tier that are compacted into one.
FAN = 16
#: Appends for which superseded parts and manifests stay, for readers that opened an older manifest.
GRACE = 20
#: Bytes of a file that compaction writes.
FILE_BYTES = 128 << 20

BATCH = StructField("batch_id", IntegerType())


@dataclass
class Manifest:
    """The state of a table after an append. Parts are {first, last, path, tier}, oldest first."""

    number: int = 0
    schema: StructType = field(default_factory=StructType)
    parts: list[dict] = field(default_factory=list)
    superseded: list[dict] = field(default_factory=list)

    @staticmethod
    def load(spark: SparkSession, folder: str) -> Manifest | None:
        found = [n for n in files.names(spark, f"{folder}/_manifest") if n.endswith(".json")]
        if not found:
            return None
        content = json.loads(files.read_text(spark, f"{folder}/_manifest/{found[-1]}"))
        return Manifest(content["number"], StructType.fromJson(content["schema"]), content["parts"], content["superseded"])

    def save(self, spark: SparkSession, folder: str) -> None:
        self.number += 1
        expired = [s for s in self.superseded if s["number"] <= self.number - GRACE]
        self.superseded = [s for s in self.superseded if s not in expired]
        text = json.dumps({
            "number": self.number, "schema": self.schema.jsonValue(), "parts": self.parts, "superseded": self.superseded,
        })
        files.write_text(spark, f"{folder}/_manifest/{self.number:012d}.json", text)
        for name in files.names(spark, f"{folder}/_manifest"):
            if name.endswith(".json") and int(name.split(".")[0]) <= self.number - GRACE:
                files.remove(spark, f"{folder}/_manifest/{name}")
        for old in expired:
            files.remove(spark, f"{folder}/{old['path']}")

    def supersede(self, part: dict) -> None:
        self.parts.remove(part)
        self.superseded.append({"path": part["path"], "number": self.number + 1})

    def widen(self, schema: StructType) -> None:
        """Columns that are new are null in older batches; a column keeps its type."""
        known = {f.name: f.dataType for f in self.schema}
        for f in schema:
            if f.name not in known:
                self.schema = self.schema.add(f.name, f.dataType)
            elif known[f.name].simpleString() != f.dataType.simpleString():
                raise ValueError(f"column {f.name} was {known[f.name].simpleString()} and is {f.dataType.simpleString()}")

    def read(self, spark: SparkSession, folder: str, parts: list[dict]) -> DataFrame:
        schema = StructType([*self.schema.fields, BATCH])
        out = None
        for single in (True, False):
            paths = [f"{folder}/{p['path']}" for p in parts if (p["tier"] == 0) == single]
            if paths:
                reader = spark.read.schema(schema)
                reader = reader.option("basePath", folder) if single else reader
                found = reader.parquet(*paths).select(*schema.names)
                out = found if out is None else out.union(found)
        return spark.createDataFrame([], schema) if out is None else out


def _compact(spark: SparkSession, folder: str, manifest: Manifest, batch_id: int) -> None:
    """Old parts of a tier become one of the next; the batch that was just written may be repeated
    and stays as it is."""
    tier = 0
    while True:
        old = [p for p in manifest.parts if p["tier"] == tier and p["last"] < batch_id]
        if not [p for p in manifest.parts if p["tier"] >= tier]:
            return
        if len(old) >= FAN:
            _merge(spark, folder, manifest, old, tier + 1)
        tier += 1


def _merge(spark: SparkSession, folder: str, manifest: Manifest, old: list[dict], tier: int, rows: DataFrame | None = None) -> None:
    rows = manifest.read(spark, folder, old) if rows is None else rows
    first, last = min(p["first"] for p in old), max(p["last"] for p in old)
    path = f"segments/{first}-{last}-{manifest.number + 1}"
    total = sum(files.size(spark, f"{folder}/{p['path']}") for p in old)
    rows.coalesce(max(1, -(-total // FILE_BYTES))).write.mode("overwrite").parquet(f"{folder}/{path}")
    for part in old:
        manifest.supersede(part)
    manifest.parts.append({"first": first, "last": last, "path": path, "tier": tier})
    manifest.parts.sort(key=lambda p: p["first"])


def append_batch(df: DataFrame, folder: str, batch_id: int, keep: int | None = None) -> None:
    """Writes the rows of one micro-batch; a repeated batch replaces its own rows.

    With `keep`, only the newest so many batches are kept, and nothing is compacted.
    """
    spark, batch_id = df.sparkSession, int(batch_id)
    manifest = Manifest.load(spark, folder) or Manifest()
    manifest.widen(df.schema)
    path = f"batch_id={batch_id}"
    df.write.mode("overwrite").parquet(f"{folder}/{path}")
    # A batch that was superseded and comes again is in its folder once more.
    manifest.superseded = [s for s in manifest.superseded if s["path"] != path]
    for part in [p for p in manifest.parts if p["first"] <= batch_id <= p["last"]]:
        if part["tier"] == 0:
            manifest.parts.remove(part)
        else:
            others = manifest.read(spark, folder, [part]).filter(F.col("batch_id") != batch_id)
            _merge(spark, folder, manifest, [part], part["tier"], others)
    manifest.parts.append({"first": batch_id, "last": batch_id, "path": path, "tier": 0})
    manifest.parts.sort(key=lambda p: p["first"])
    if keep is None:
        _compact(spark, folder, manifest, batch_id)
    else:
        for part in manifest.parts[:-keep]:
            manifest.supersede(part)
    manifest.superseded = [s for s in manifest.superseded if s["path"] not in {p["path"] for p in manifest.parts}]
    manifest.save(spark, folder)


def read_log_or_none(spark: SparkSession, folder: str) -> DataFrame | None:
    """All batches with their `batch_id`, or None if nothing was written yet."""
    manifest = Manifest.load(spark, folder)
    return None if manifest is None else manifest.read(spark, folder, manifest.parts)


def read_log(spark: SparkSession, folder: str) -> DataFrame:
    table = read_log_or_none(spark, folder)
    if table is None:
        raise FileNotFoundError(f"nothing was written to {folder}")
    return table


def read_batches(spark: SparkSession, folder: str, first: int, last: int) -> DataFrame | None:
    """The batches `first` to `last`, from the parts that hold them."""
    manifest = Manifest.load(spark, folder)
    if last < first or manifest is None:
        return None
    parts = [p for p in manifest.parts if p["first"] <= last and p["last"] >= first]
    return manifest.read(spark, folder, parts).filter(F.col("batch_id").between(first, last))


def read_batch(spark: SparkSession, folder: str, batch_id: int) -> DataFrame | None:
    """One batch without its id, or None if there is no such batch."""
    manifest = Manifest.load(spark, folder)
    parts = [p for p in manifest.parts if p["first"] <= batch_id <= p["last"]] if manifest else []
    if not parts:
        return None
    return manifest.read(spark, folder, parts).filter(F.col("batch_id") == batch_id).drop("batch_id")


def state_before(spark: SparkSession, folder: str, batch_id: int) -> Row | None:
    """The row that the newest earlier micro-batch stored in a one-row-per-batch table."""
    manifest = Manifest.load(spark, folder)
    older = [p for p in manifest.parts if p["first"] < batch_id] if manifest else []
    if not older:
        return None
    # Parts do not overlap: the newest of the older ones holds the newest older batch.
    rows = manifest.read(spark, folder, older[-1:]).filter(F.col("batch_id") < batch_id)
    return rows.orderBy(F.col("batch_id").desc()).limit(1).first()


def newest_batch(spark: SparkSession, folder: str, before: int | None = None) -> int | None:
    """The largest batch id so far (below `before`), from the manifest alone if no segment is cut by
    `before`."""
    manifest = Manifest.load(spark, folder)
    older = [p for p in manifest.parts if before is None or p["first"] < before] if manifest else []
    if not older:
        return None
    last = older[-1]
    if before is None or last["last"] < before:
        return last["last"]
    rows = manifest.read(spark, folder, [last]).filter(F.col("batch_id") < before)
    return rows.agg(F.max("batch_id")).first()[0]

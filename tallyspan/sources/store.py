"""Keyed tables that are published atomically and stay bounded under small writes.

A store is a folder of immutable Parquet data and a folder of manifests.  A manifest names all data of
one version: a base, dealt into buckets by a hash of the key, and deltas, one for each batch that is not
yet part of the base.  Data is written first and the manifest last, under a name that only
one writer can take; a reader resolves the newest manifest once.  So a reader sees one whole version,
before or after a write, and a write that dies leaves files that no manifest names.

``append`` adds a delta, ``compact`` folds deltas into those buckets that they touch, ``upsert`` merges
columns by key, ``replace`` publishes a whole table.  Buckets that a write does not touch keep their files.
"""

from __future__ import annotations

import json
import uuid
from collections.abc import Sequence
from dataclasses import dataclass, field, replace as changed

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tallyspan.operators.refresh import upsert as merged_columns
from tallyspan.spec import require_columns

BUCKETS = 64
# Deltas that reads put up with before they are folded into the base.
MAX_DELTAS = 8
# Versions whose data stays for readers that resolved them.
KEEP = 3
BATCH = "batch_id"
# The batch of rows that came with none: older than any other.
FIRST_BATCH = -(1 << 62)


class Conflict(Exception):
    """Another writer published the version first; nothing was changed."""


@dataclass(frozen=True)
class Manifest:
    """``base``: folder of each bucket that has rows.  ``deltas``: (batch, folder), oldest first.
    ``folded``: the newest batch that is part of the base."""

    version: int = 0
    base: dict[str, str] = field(default_factory=dict)
    deltas: tuple[tuple[int, str], ...] = ()
    folded: int | None = None
    schema: str | None = None

    @property
    def folders(self) -> list[str]:
        return [*self.base.values(), *[f for _, f in self.deltas]]


@dataclass(frozen=True)
class Store:
    """A table with one row per ``key``; where batches repeat a key, the newest batch holds."""

    spark: SparkSession
    root: str
    key: str
    buckets: int = BUCKETS
    max_deltas: int = MAX_DELTAS
    keep: int = KEEP

    # -- versions ----------------------------------------------------------

    def _path(self, *parts: str):
        return self.spark._jvm.org.apache.hadoop.fs.Path("/".join((self.root, *parts)))

    def _files(self):
        return self._path().getFileSystem(self.spark._jsc.hadoopConfiguration())

    def _versions(self) -> list[int]:
        folder = self._path("manifests")
        files = self._files()
        if not files.exists(folder):
            return []
        names = [f.getPath().getName() for f in files.listStatus(folder)]
        return sorted(int(n) for n in names if n.isdigit())

    def manifest(self, version: int | None = None) -> Manifest:
        """The newest version's, or an empty one."""
        if version is None:
            found = self._versions()
            if not found:
                return Manifest()
            version = found[-1]
        text = self.spark.read.text(f"{self.root}/manifests/{version}", wholetext=True).first()[0]
        body = json.loads(text)
        return Manifest(**{**body, "deltas": tuple((b, f) for b, f in body["deltas"])})

    def _publish(self, manifest: Manifest) -> int:
        """Make a manifest the newest one: written aside, then renamed to a name not yet taken."""
        files, aside = self._files(), self._path("manifests", f"_{uuid.uuid4().hex}")
        files.mkdirs(self._path("manifests"))
        version = manifest.version + 1
        body = {**manifest.__dict__, "version": version, "deltas": [list(d) for d in manifest.deltas]}
        out = files.create(aside, False)
        out.write(bytearray(json.dumps(body).encode()))
        out.close()
        target = self._path("manifests", str(version))
        if files.exists(target) or not files.rename(aside, target):
            files.delete(aside, False)
            raise Conflict(f"Version {version} of {self.root} was published meanwhile.")
        self._sweep()
        return version

    def _sweep(self) -> None:
        """Delete manifests beyond the last ``keep`` and data that the remaining ones do not name.
        Data without any manifest may belong to a write in progress and stays until ``vacuum``."""
        files, versions = self._files(), self._versions()
        old, kept = versions[: -self.keep], versions[-self.keep :]
        if not old:
            return
        used = {f for v in kept for f in self.manifest(v).folders}
        for v in old:
            for folder in set(self.manifest(v).folders) - used:
                files.delete(self._path("data", folder), True)
            files.delete(self._path("manifests", str(v)), False)

    def vacuum(self) -> list[str]:
        """Delete data that no manifest names, as writes that died leave it.  Only while nobody writes."""
        files, folder = self._files(), self._path("data")
        if not files.exists(folder):
            return []
        used = {f.split("/")[0] for v in self._versions() for f in self.manifest(v).folders}
        lost = [f.getPath().getName() for f in files.listStatus(folder) if f.getPath().getName() not in used]
        for name in lost:
            files.delete(self._path("data", name), True)
        return lost

    # -- reading -----------------------------------------------------------

    def _bucket(self) -> Column:
        return F.pmod(F.xxhash64(self.key), F.lit(self.buckets))

    def _load(self, folders: Sequence[str], schema: str) -> DataFrame:
        if not folders:
            return self.spark.createDataFrame([], schema)
        return self.spark.read.schema(schema).parquet(*[f"{self.root}/data/{f}" for f in folders])

    def _newest(self, rows: DataFrame) -> DataFrame:
        """The row of the newest batch of each key; combines before the shuffle."""
        rest = [c for c in rows.columns if c != self.key]
        best = rows.groupBy(self.key).agg(F.max_by(F.struct(*rest), BATCH).alias("_row"))
        return best.select(*[F.col(self.key) if c == self.key else F.col(f"_row.{c}").alias(c) for c in rows.columns])

    def rows(self, manifest: Manifest | None = None) -> DataFrame:
        """One version's rows with the batch each came with; only deltas and the buckets of the base are read."""
        at = self.manifest() if manifest is None else manifest
        if at.schema is None:
            raise ValueError(f"Nothing was published under {self.root}.")
        base = self._load(list(at.base.values()), at.schema)
        if not at.deltas:
            return base
        return self._newest(base.unionByName(self._load([f for _, f in at.deltas], at.schema)))

    def read(self) -> DataFrame:
        return self.rows().drop(BATCH)

    # -- writing -----------------------------------------------------------

    def _schema(self, rows: DataFrame, at: Manifest) -> str:
        ddl = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in rows.schema.fields)
        if at.schema is not None and at.schema != ddl:
            raise ValueError(f"The table has columns {at.schema}, not {ddl}.")
        return ddl

    def _write_base(self, rows: DataFrame, name: str) -> dict[str, str]:
        """Rows into the folders of their buckets; the folder of each bucket that has rows."""
        placed = rows.withColumn("_bucket", self._bucket())
        placed.repartition(self.buckets, "_bucket").write.partitionBy("_bucket").parquet(f"{self.root}/data/{name}")
        found = self._files().listStatus(self._path("data", name))
        parts = [f.getPath().getName() for f in found if f.getPath().getName().startswith("_bucket=")]
        return {p.split("=")[1]: f"{name}/{p}" for p in parts}

    def append(self, df: DataFrame, batch: int) -> int:
        """Add a batch; rows of a key replace older ones.  A batch that is written again replaces itself,
        and one that the base already holds is left alone, so replays change nothing."""
        require_columns(df, [self.key])
        at = self.manifest()
        if at.folded is not None and batch <= at.folded:
            return at.version
        rows = df.where(F.col(self.key).isNotNull()).withColumn(BATCH, F.lit(batch).cast("bigint"))
        schema, name = self._schema(rows, at), f"delta-{batch}-{uuid.uuid4().hex}"
        rows.write.parquet(f"{self.root}/data/{name}")
        deltas = sorted([d for d in at.deltas if d[0] != batch] + [(batch, name)])
        version = self._publish(changed(at, deltas=tuple(deltas), schema=schema))
        return self.compact() if len(deltas) >= self.max_deltas else version

    def compact(self) -> int:
        """Fold all deltas into the buckets of the base that they touch."""
        at = self.manifest()
        if not at.deltas:
            return at.version
        fresh = self._load([f for _, f in at.deltas], at.schema)
        touched = {str(r[0]) for r in fresh.select(self._bucket()).distinct().collect()}  # at most ``buckets``
        base = self._load([f for b, f in at.base.items() if b in touched], at.schema)
        made = self._write_base(self._newest(base.unionByName(fresh)), f"base-{uuid.uuid4().hex}")
        last = max(b for b, _ in at.deltas)
        return self._publish(changed(at, base={**at.base, **made}, deltas=(), folded=last))

    def replace(self, df: DataFrame) -> int:
        """Publish a whole table; keys must be unique in it.  Its columns may differ from before."""
        require_columns(df, [self.key])
        rows = df.where(F.col(self.key).isNotNull()).withColumn(BATCH, F.lit(FIRST_BATCH).cast("bigint"))
        at = self.manifest()
        made = self._write_base(rows, f"base-{uuid.uuid4().hex}")
        return self._publish(Manifest(at.version, made, (), at.folded, self._schema(rows, Manifest())))

    def upsert(self, staging: DataFrame, columns: Sequence[str] | None = None) -> int:
        """Merge columns of staging rows (one per key) by key: matched rows take them and keep all else, new
        keys are added with the other columns NULL.  Staging is read once, only the buckets
        of its keys are read and written, and nothing is broadcast."""
        at = self.manifest()
        if at.schema is None:
            return self.replace(staging)
        if at.deltas:
            self.compact()
            at = self.manifest()
        name = f"staging-{uuid.uuid4().hex}"
        staged = staging.where(F.col(self.key).isNotNull())
        staged.write.parquet(f"{self.root}/data/{name}")
        fresh = self.spark.read.schema(staged.schema).parquet(f"{self.root}/data/{name}")
        touched = {str(r[0]) for r in fresh.select(self._bucket()).distinct().collect()}
        target = self._load([f for b, f in at.base.items() if b in touched], at.schema)
        rows = merged_columns(target, fresh, self.key, columns, small_rows=-1)
        rows = rows.select(*target.columns).withColumn(BATCH, F.coalesce(BATCH, F.lit(FIRST_BATCH)))
        made = self._write_base(rows, f"base-{uuid.uuid4().hex}")
        self._files().delete(self._path("data", name), True)
        return self._publish(changed(at, base={**at.base, **made}))

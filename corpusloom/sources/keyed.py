"""A keyed table whose commits write what changed: Parquet folders by hash bucket, merged when read.

A commit is one job that writes the changed rows and the keys of deleted ones, and a small file that lists the folders of the new version; a
pointer names the current version. Reading takes, of each key, the row of its latest change; buckets without a change are plain scans. Buckets of which
much has changed are rewritten by `compact`, the others are not touched; `vacuum` removes what only older versions read.
"""

from __future__ import annotations

import json
import time
import uuid
from collections.abc import Iterable, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .store import POINTER, Pointed, unreadable

#: Changed keys up to this number are broadcast to the base rows; their number is known from the commits.
BROADCAST_KEYS = 100_000


class KeyedStore(Pointed):
    """One row a key. schema: of a row; key: its column or columns; buckets: fixed when the store is made, so that a bucket fits a task."""

    def __init__(self, spark: SparkSession, path: str, schema: T.StructType | str, key: str | Sequence[str], buckets: int = 16):
        super().__init__(spark, path)
        self.schema = T.StructType.fromDDL(schema) if isinstance(schema, str) else schema
        self.key = [key] if isinstance(key, str) else list(key)
        known = self._version(None)
        self.buckets = known["buckets"] if known else buckets
        # A key need not be there in rows that only name deleted ones; nothing else is required of what a file holds.
        self._stored = T.StructType([*(T.StructField(f.name, f.dataType) for f in self.schema), T.StructField("_deleted", T.BooleanType()), T.StructField("_bucket", T.IntegerType())])

    # Versions: {version, name, buckets, base: [{folder, rows: {bucket: n}}], deltas: [the same, in order]}

    def _version(self, version: int | None) -> dict | None:
        at = self.current() if version is None else f"v{version:08d}"
        text = self.text_of(f"{at}.json") if at else None
        if text is None and version is not None:
            raise ValueError(f"there is no version {version} of {self.path}")
        return json.loads(text) if text else None

    def versions(self) -> list[int]:
        """The versions that can be read."""
        files = self._fs.listStatus(self._path(self.path)) if self._fs.exists(self._path(self.path)) else []
        names = [f.getPath().getName() for f in files]
        return sorted(int(n[1:9]) for n in names if n.startswith("v") and n.endswith(".json"))

    def _publish(self, version: dict) -> int:
        at = f"v{version['version']:08d}"
        self.put_text(f"{at}.json", json.dumps(version))
        self.put_text(POINTER, at)
        return version["version"]

    # Buckets

    def bucket(self) -> Column:
        return F.pmod(F.xxhash64(*self.key), F.lit(self.buckets)).cast("int")

    def _write(self, rows: DataFrame, kind: str) -> dict:
        """Rows with _bucket and _deleted into a new folder, a file for each bucket; and how many rows each has."""
        folder = f"{kind}-{uuid.uuid4().hex}"
        path = f"{self.path}/{folder}"
        width = int(self.spark.conf.get("spark.sql.shuffle.partitions"))
        rows.repartition(min(width, self.buckets), "_bucket").sortWithinPartitions("_bucket", *self.key).write.partitionBy("_bucket").parquet(path)
        counts = self.spark.read.schema(self._stored).parquet(path).groupBy("_bucket").agg(F.count("*").alias("n"), F.count_if("_deleted").alias("gone"))
        found = counts.collect()  # a row for each bucket
        return {"folder": folder, "rows": {str(r["_bucket"]): r["n"] for r in found}, "deleted": sum(r["gone"] for r in found)}

    def _folder(self, entry: dict, buckets: Iterable[int] | None) -> DataFrame | None:
        own = {int(b) for b in entry["rows"]}
        own = own if buckets is None else own & set(buckets)
        if not own:
            return None
        return self.spark.read.schema(self._stored).parquet(f"{self.path}/{entry['folder']}").where(F.col("_bucket").isin(sorted(own)))

    def _merged(self, version: dict, buckets: set[int] | None) -> DataFrame | None:
        """Rows with _bucket of a version."""
        changed = {int(b) for d in version["deltas"] for b in d["rows"]}
        changed = changed if buckets is None else changed & buckets
        quiet = [p for e in version["base"] if (p := self._folder(e, {int(b) for b in e["rows"] if buckets is None or int(b) in buckets} - changed)) is not None]
        parts = [p.drop("_deleted") for p in quiet]
        if changed:
            base = [p.drop("_deleted") for e in version["base"] if (p := self._folder(e, changed)) is not None]
            deltas = [p.withColumn("_seq", F.lit(k)) for k, e in enumerate(version["deltas"]) if (p := self._folder(e, changed)) is not None]
            every = reduce(DataFrame.unionByName, deltas)
            columns = [f.name for f in self._stored]
            latest = every.groupBy(*self.key).agg(F.max_by(F.struct(*columns), "_seq").alias("r")).select("r.*")
            if base:
                keys = every.select(*self.key).distinct()
                n = sum(n for d in version["deltas"] for b, n in d["rows"].items() if int(b) in changed)
                old = reduce(DataFrame.unionByName, base)
                same = reduce(Column.__and__, [F.col(f"_o.{k}").eqNullSafe(F.col(f"_k.{k}")) for k in self.key])
                parts.append(old.alias("_o").join((F.broadcast(keys) if n <= BROADCAST_KEYS else keys).alias("_k"), same, "left_anti"))
            parts.append(latest.where(~F.col("_deleted")).drop("_deleted"))
        return reduce(DataFrame.unionByName, parts) if parts else None

    # What callers use

    def read(self, version: int | None = None, buckets: Iterable[int] | None = None) -> DataFrame:
        """The rows of a version (None: the current one), of some buckets or of all; empty before the first commit."""
        at = self._version(version)
        merged = self._merged(at, None if buckets is None else set(buckets)) if at else None
        if merged is None:
            return self.spark.createDataFrame([], self.schema)
        return merged.select(*(F.col(f.name) for f in self.schema))

    def beside(self, keys: DataFrame) -> DataFrame:
        """The current rows of the buckets that some keys fall in: what an upsert of those keys has to look at."""
        return self.read(buckets=[r["b"] for r in keys.select(self.bucket().alias("b")).distinct().collect()])  # at most a row for each bucket

    def between(self, since: int | None, until: int | None = None) -> tuple[DataFrame, DataFrame]:
        """(rows as they were, rows as they are) of the keys that changed after a version (None: of all keys, before the first one). Rows that are the
        same in both may be among them. Only buckets with a folder that the older version does not have are read; of these, only keys of new changes,
        unless the bucket was rewritten since."""
        new = self._version(until)
        old = self._version(since) if since is not None else None
        folders = {e["folder"] for e in (*old["base"], *old["deltas"])} if old else set()
        fresh = lambda entries: [e for e in entries if e["folder"] not in folders]
        nothing = self.read(until).limit(0)
        if new is None:
            return nothing, nothing
        rewritten = {int(b) for e in fresh(new["base"]) for b in e["rows"]}
        live = {int(b) for e in (*new["base"], *new["deltas"]) for b in e["rows"]}
        rewritten |= {int(b) for e in (*old["base"], *old["deltas"]) for b in e["rows"]} - live if old else set()  # nothing is left of them
        changed = {int(b) for e in fresh(new["deltas"]) for b in e["rows"]} - rewritten
        if not rewritten and not changed:
            return nothing, nothing
        before = lambda b: self.read(since, b) if old else nothing
        sides = [before(rewritten), self.read(until, rewritten)]
        if changed:
            keys = reduce(DataFrame.unionByName, [p for e in fresh(new["deltas"]) if (p := self._folder(e, changed)) is not None]).select(*self.key).distinct().alias("_k")
            same = reduce(Column.__and__, [F.col(f"_o.{k}").eqNullSafe(F.col(f"_k.{k}")) for k in self.key])
            sides = [a.unionByName(b.alias("_o").join(keys, same, "left_semi")) for a, b in zip(sides, (before(changed), self.read(until, changed)))]
        return sides[0], sides[1]

    def commit(self, upserts: DataFrame | None = None, deletes: DataFrame | None = None, name: str | None = None) -> int:
        """Insert or replace rows and delete keys, as one new version. A key comes once at most; of a key in both the row counts.

        Only the given rows are written. name: of the commit; if the current version has it, nothing is done, so a replayed batch is not applied twice.
        """
        at = self._version(None) or {"version": 0, "name": None, "buckets": self.buckets, "base": [], "deltas": []}
        if name is not None and at["name"] == name:
            return at["version"]
        columns = [f.name for f in self.schema]
        rows = upserts.select(*(F.col(f.name).cast(f.dataType) for f in self.schema), F.lit(False).alias("_deleted")) if upserts is not None else None
        if deletes is not None:
            gone = deletes.select(*self.key).distinct()
            if rows is not None:
                gone = gone.join(rows.select(*self.key), self.key, "left_anti")
            gone = gone.select(*(F.col(c) if c in self.key else F.lit(None).cast(self.schema[c].dataType).alias(c) for c in columns), F.lit(True).alias("_deleted"))
            rows = gone if rows is None else rows.unionByName(gone)
        if rows is None:
            raise ValueError("nothing to commit")
        entry = self._write(rows.withColumn("_bucket", self.bucket()), "changes")
        first = not at["base"] and not at["deltas"] and not entry["deleted"]  # nothing to merge with
        new = {"base": [entry]} if first else {"deltas": [*at["deltas"], *([entry] if entry["rows"] else [])]}
        return self._publish(at | {"version": at["version"] + 1, "name": name} | new)

    def replace(self, rows: DataFrame) -> int:
        """Whole new content, as one new version."""
        entry = self._write(rows.select(*(F.col(f.name).cast(f.dataType) for f in self.schema), F.lit(False).alias("_deleted")).withColumn("_bucket", self.bucket()), "base")
        at = self._version(None) or {"version": 0}
        return self._publish({"version": at["version"] + 1, "name": None, "buckets": self.buckets, "base": [entry] if entry["rows"] else [], "deltas": []})

    def compact(self, share: float = 0.25, deltas: int = 8) -> list[int]:
        """Rewrite the buckets whose changes are more than a share of their base rows, or lie in more than so many folders; which they were.

        All others stay as they are. The content does not change, nor does what older versions give.
        """
        at = self._version(None)
        if at is None:
            return []
        count = lambda entries, b: sum(e["rows"].get(str(b), 0) for e in entries)
        changed = {int(b) for d in at["deltas"] for b in d["rows"]}
        worth = {b for b in changed if count(at["deltas"], b) > share * count(at["base"], b) or sum(str(b) in d["rows"] for d in at["deltas"]) > deltas}
        if not worth:
            return []
        entry = self._write(self._merged(at, worth).withColumn("_deleted", F.lit(False)), "base")
        without = lambda entries: [e | {"rows": r} for e in entries if (r := {b: n for b, n in e["rows"].items() if int(b) not in worth})]
        self._publish(at | {"version": at["version"] + 1, "base": [*without(at["base"]), *([entry] if entry["rows"] else [])], "deltas": without(at["deltas"])})
        return sorted(worth)

    def vacuum(self, keep: int = 2) -> list[str]:
        """Forget all versions but the latest ones, and remove the folders that none of these reads, with those of commits that failed. No
        commit may run meanwhile. Returns the removed folders."""
        kept = self.versions()[-max(1, keep) :]
        if not kept:
            return []
        for v in set(self.versions()) - set(kept):
            self._fs.delete(self._path(f"{self.path}/v{v:08d}.json"), False)
        read = {e["folder"] for v in kept for at in [self._version(v)] for e in (*at["base"], *at["deltas"])}
        found = [f.getPath().getName() for f in self._fs.listStatus(self._path(self.path)) if f.isDirectory()]
        gone = sorted(n for n in found if n.split("-")[0] in ("base", "changes") and n not in read)
        for name in gone:
            self._fs.delete(self._path(f"{self.path}/{name}"), True)
        return gone

    def quarantine(self) -> str | None:
        """Set all files aside under another name, and start empty."""
        if self.current() is None:
            return None
        aside = f"{self.path}.corrupt-{int(time.time() * 1000)}"
        self._fs.mkdirs(self._path(aside))
        for f in self._fs.listStatus(self._path(self.path)):
            if f.getPath().getName() != "_LOCK":
                self._fs.rename(f.getPath(), self._path(f"{aside}/{f.getPath().getName()}"))
        return aside

    def read_or_quarantine(self) -> DataFrame:
        """The current rows if all files can be read; else the store is set aside and is empty."""
        try:
            at = self._version(None)
            for e in (*at["base"], *at["deltas"]) if at else ():
                self.spark.read.schema(self._stored).parquet(f"{self.path}/{e['folder']}").agg(F.count("*")).collect()  # reads the footers of all files
            return self.read()
        except Exception as e:
            if not unreadable(e) and not isinstance(e, ValueError):
                raise
            self.quarantine()
            return self.read()

"""A stored table that micro-batches are merged into: batches are kept as they come and merged when read.

The stored rows lie in parts, each a range of the key's hash and a few files; a batch adds
files with its own rows only, whatever keys it touches. Reading folds the batches to
the last known value of each key's columns and lays them over the parts. Now and then
some parts are rewritten with the batches' rows in them: those that much of the batches
belongs to, and those whose files are out of bounds, which are split in halves of their
range or joined with their neighbours.

A version is a list of parts, written when all its files are there; no file is ever
written over while it can be read, so readers of an older version aren't disturbed. A
version is named after its batch: a batch that runs again after a failure writes the
same version from the same predecessor, so the result is as if it had run once.
"""

from __future__ import annotations

import math
from collections.abc import Iterable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

#: A part: where it lies, what it is (``part``; ``batch``; ``loose``: rows without a key), its range (the first ``bits``
#: bits of the key's hash are ``slot``), its bytes, its version, and up to which version it has the batches in it.
PART = "place string, kind string, bits int, slot long, bytes long, version long, upto long"
HASH, VERSION = "_hash", "_version"
#: A part is written by up to this many tasks, each with a range of its hash; a batch by as many as a shuffle has.
FILES_A_PART = 64
#: Ranges that a batch's rows are dealt by; small ones are put together by adaptive execution.
BATCH_BITS = 12


def folder(spark: SparkSession, path: str):
    """Hadoop's file system and path object: any store that Spark reads."""
    root = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return root.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), root


def listed(spark: SparkSession, path: str) -> list[str]:
    fs, root = folder(spark, path)
    return sorted(s.getPath().getName() for s in fs.listStatus(root)) if fs.exists(root) else []


def _first_bits(bits: int) -> Column:
    """The first ``bits`` bits of a row's hash, as a number."""
    return F.shiftrightunsigned(HASH, 64 - bits) if bits else F.lit(0).cast("long")


class MergedTable:
    """The table below ``path`` with one row for each ``key``; ``part_bytes`` is what a part should have, within a factor of four."""

    def __init__(self, spark: SparkSession, path: str, key: str, part_bytes: int = 128 << 20, rewrite_share: float = 0.25, most_batches: int = 20):
        self.spark, self.path, self.key = spark, path.rstrip("/"), key
        self.part_bytes, self.rewrite_share, self.most_batches = part_bytes, rewrite_share, most_batches

    # What is there.

    def versions(self) -> list[int]:
        """Finished versions, oldest first."""
        return sorted(int(n[1:]) for n in listed(self.spark, f"{self.path}/manifest") if "_SUCCESS" in listed(self.spark, f"{self.path}/manifest/{n}"))

    def parts(self, version: int) -> list[dict]:
        """The parts of a version: as many small rows as the table has files."""
        return [r.asDict() for r in self.spark.read.schema(PART).json(f"{self.path}/manifest/v{version}").collect()]

    def _latest(self, before: int | None) -> int:
        return max(v for v in self.versions() if before is None or v < before)

    def schema(self) -> str:
        return self.spark.read.json(f"{self.path}/schema", schema="ddl string").first()["ddl"]

    def _rows(self, parts: Iterable[dict], *more: str) -> DataFrame:
        places = [f"{self.path}/{p['place']}" for p in parts if p["place"]]
        ddl = ", ".join([self.schema(), f"{HASH} bigint", *more])
        return self.spark.read.schema(ddl).parquet(*places) if places else self.spark.createDataFrame([], ddl)

    # Reading.

    def _folded(self, batches: list[dict], bits: int = 0, slots: list[int] | None = None) -> DataFrame:
        """The batches' rows (of ``slots``), one for each key: in each column the last value that isn't null."""
        rows = self._rows(batches, f"{VERSION} bigint")
        if slots is not None and len(slots) < 1 << bits:
            few = F.broadcast(self.spark.createDataFrame([(s,) for s in slots], "_s long"))
            rows = rows.join(few, _first_bits(bits) == F.col("_s"), "left_semi")
        names = [c for c in rows.columns if c not in (self.key, HASH, VERSION)]
        last = [F.max_by(c, F.when(F.col(c).isNotNull(), F.col(VERSION))).alias(c) for c in names]
        return rows.groupBy(self.key, HASH).agg(*last)

    def _merged(self, stored: DataFrame, batches: list[dict], bits: int = 0, slots: list[int] | None = None) -> DataFrame:
        """``stored`` rows with the batches' over them; the smaller side can be broadcast, as rows are looked up and added."""
        if not batches:
            return stored
        new = self._folded(batches, bits, slots)
        names = [c for c in stored.columns if c not in (self.key, HASH)]
        there = new.select(F.col(self.key).alias("_k"), *(F.col(c).alias(f"_n_{c}") for c in names))
        kept = stored.join(there, F.col(self.key) == F.col("_k"), "left").select(self.key, *(F.coalesce(f"_n_{c}", c).alias(c) for c in names), HASH)
        added = new.join(stored.select(self.key), self.key, "left_anti").select(*kept.columns)
        return kept.unionByName(added)

    def read(self, version: int | None = None) -> DataFrame:
        """A version (the latest, if not given) with its batches merged; rows without a key are as they came."""
        parts = self.parts(self._latest(None) if version is None else version)
        of = lambda kind: [p for p in parts if p["kind"] == kind]
        made = self._merged(self._rows(of("part")), of("batch"))
        if loose := of("loose"):
            made = made.unionByName(self._rows(loose))
        return made.drop(HASH).select(*self.spark.createDataFrame([], self.schema()).columns)

    # Writing.

    def _hash(self) -> Column:
        return F.xxhash64(self.key)

    def _bytes(self, place: str) -> int:
        fs, root = folder(self.spark, f"{self.path}/{place}")
        return fs.getContentSummary(root).getLength()

    def _write_parts(self, rows: DataFrame, bits: int, slots: Iterable[int], place: str, version: int) -> list[dict]:
        """``rows`` (with HASH), all of ``slots``, as parts of ``bits`` bits below ``place``, a file each; one without rows has no place."""
        tasks = int(self.spark.conf.get("spark.sql.shuffle.partitions"))
        # Ranges finer than the parts, for how many bytes a part has isn't known before: as many tasks as the shuffle has; adaptive execution puts small ones together.
        more = min(int(math.log2(FILES_A_PART)), max(0, math.ceil(math.log2(tasks)) - bits))
        rows.withColumn("slot", _first_bits(bits)).repartition(_first_bits(bits + more)).sortWithinPartitions("slot", HASH).write.mode("overwrite").partitionBy("slot").parquet(f"{self.path}/{place}")
        made = {int(n.split("=")[1]) for n in listed(self.spark, f"{self.path}/{place}") if n.startswith("slot=")}
        of = lambda s: (f"{place}/slot={s}", self._bytes(f"{place}/slot={s}")) if s in made else ("", 0)
        return [{"place": at, "kind": "part", "bits": bits, "slot": s, "bytes": held, "version": version, "upto": version} for s in slots for at, held in [of(s)]]

    def _finish(self, parts: list[dict], version: int) -> None:
        names = [c.split()[0] for c in PART.split(", ")]
        self.spark.createDataFrame([tuple(p[n] for n in names) for p in parts], PART).coalesce(1).write.mode("overwrite").json(f"{self.path}/manifest/v{version}")

    def write(self, df: DataFrame, version: int, bits: int | None = None) -> None:
        """``df`` as the whole table. Without ``bits`` Spark's estimate of its size says how many parts it has at first."""
        ddl = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in df.schema)
        self.spark.createDataFrame([(ddl,)], "ddl string").coalesce(1).write.mode("overwrite").json(f"{self.path}/schema")
        if bits is None:
            estimate = int(str(df._jdf.queryExecution().optimizedPlan().stats().sizeInBytes()))
            bits = min(16, max(0, math.ceil(math.log2(max(1, estimate) / self.part_bytes))))
        self._finish(self._write_parts(df.withColumn(HASH, self._hash()), bits, range(1 << bits), f"v{version}/parts", version), version)

    def merge(self, batch: DataFrame, version: int) -> None:
        """The batch (a row for each key) as ``version``; only its own rows are written, unless its turn has come to rewrite parts."""
        before = self._latest(version)
        known = self.spark.createDataFrame([], self.schema())
        kinds = {f.name: f.dataType for f in known.schema}
        rows = batch.select(*((F.col(c).try_cast(kinds[c]) if c in batch.columns else F.lit(None).cast(kinds[c])).alias(c) for c in known.columns)).withColumn(HASH, self._hash())
        parts = self.parts(before)
        for kind, some in (("batch", rows.where(F.col(self.key).isNotNull()).withColumn(VERSION, F.lit(version).cast("long"))), ("loose", rows.where(F.col(self.key).isNull()))):
            place = f"v{version}/{kind}"
            some.repartition(_first_bits(BATCH_BITS)).sortWithinPartitions(HASH).write.mode("overwrite").parquet(f"{self.path}/{place}")
            if not self.spark.read.schema(f"{HASH} bigint").parquet(f"{self.path}/{place}").isEmpty():
                parts.append({"place": place, "kind": kind, "bits": 0, "slot": 0, "bytes": self._bytes(place), "version": version, "upto": version})
        if sum(p["kind"] == "batch" for p in parts) > self.most_batches:
            parts = self._rewritten(parts, version, whole=False)
        self._finish(parts, version)

    # Rewriting.

    def _bits_wanted(self, stored: list[dict]) -> int:
        """As many bits as the finest parts have, unless parts of that many would be far from the bytes that they should have."""
        total, bits = sum(p["bytes"] for p in stored), max(p["bits"] for p in stored)
        if self.part_bytes / 4 <= total / (1 << bits) <= self.part_bytes * 2:
            return bits
        exact = math.log2(max(1, total) / self.part_bytes)
        return max(0, math.ceil(exact) if total / (1 << bits) > self.part_bytes else math.floor(exact))

    def _rewritten(self, parts: list[dict], version: int, whole: bool) -> list[dict]:
        """The parts of a version after some ranges (all, if ``whole``) were rewritten; batches that no part needs any more are left out."""
        stored, batches, loose = ([p for p in parts if p["kind"] == kind] for kind in ("part", "batch", "loose"))
        bits = self._bits_wanted(stored)
        # What is rewritten together: neighbours that are to be joined, or a part by itself.
        units: dict[tuple[int, int], list[dict]] = {}
        for p in stored:
            b = min(p["bits"], bits)
            units.setdefault((b, p["slot"] >> (p["bits"] - b)), []).append(p)
        # Rows of the batches in each of the finest ranges: as many small rows as parts.
        finest = max(b for b, _ in units)
        waiting = {r["at"]: r["n"] for r in self._rows(batches).groupBy(_first_bits(finest).alias("at")).agg(F.count("*").alias("n")).collect()}
        row_bytes = sum(p["bytes"] for p in batches) / max(1, sum(waiting.values()))
        overdue = len(batches) > 2 * self.most_batches
        chosen: dict[int, list[int]] = {}
        for (b, slot), group in units.items():
            new = row_bytes * sum(waiting.get(s, 0) for s in range(slot << (finest - b), (slot + 1) << (finest - b)))
            if whole or overdue or len(group) > 1 or b < bits or new >= self.rewrite_share * max(1, sum(p["bytes"] for p in group)):
                chosen.setdefault(b, []).append(slot)
        made: list[dict] = []
        for b, slots in chosen.items():
            rows = self._merged(self._rows(p for s in slots for p in units[b, s]), batches, b, slots)
            to = max(b, bits)
            inside = [x for s in slots for x in range(s << (to - b), (s + 1) << (to - b))]
            made += self._write_parts(rows, to, inside, f"v{version}/parts{b}", version)
        kept = [p for (b, slot), group in units.items() if slot not in chosen.get(b, ()) for p in group]
        done = min(p["upto"] for p in [*kept, *made])
        return [*kept, *made, *(p for p in batches if p["version"] > done), *loose]

    def compact(self, version: int, keep: int = 1, whole: bool = True) -> None:
        """``version``: the latest one with its batches merged into the parts; then all versions but the last ``keep`` go, with the files that only they need."""
        parts = self._rewritten(self.parts(self._latest(version)), version, whole)
        self._finish(parts, version)
        every = self.versions()
        needed = {p["place"] for v in every[-keep:] for p in self.parts(v)}
        for v in every[:-keep]:
            for p in self.parts(v):
                if p["place"] and p["place"] not in needed:
                    fs, root = folder(self.spark, f"{self.path}/{p['place']}")
                    fs.delete(root, True)
            fs, root = folder(self.spark, f"{self.path}/manifest/v{v}")
            fs.delete(root, True)

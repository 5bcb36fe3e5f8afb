"""Archives of many small files: a source of their members, and a sink that packs volumes.

Files are opened with Arrow's file systems, on the executors, from wherever a path's
scheme says (local or shared folders, S3, GCS, HDFS). For stores that only Spark knows
there is ``readers.tar_documents``, which takes an archive whole.
"""

from __future__ import annotations

import hashlib
import json
import re
import tarfile
import uuid
from collections.abc import Iterator
from dataclasses import dataclass

import pyarrow as pa
import pyarrow.parquet as pq
from pyarrow import fs
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.datasource import DataSource, DataSourceArrowWriter, DataSourceReader, DataSourceStreamReader, InputPartition, WriterCommitMessage

#: What a task reads of archives, if there are many; below that, they are dealt to this many tasks.
SHARE_BYTES, FEW_SHARES = 32 << 20, 64
#: What is read at once, and what a batch of members has.
PIECE, BATCH_ROWS = 1 << 20, 2000
BLOCK = tarfile.BLOCKSIZE
MEMBER = "archive string, member string, offset long, size long, content binary"
COLUMNS = pa.schema([("archive", pa.string()), ("member", pa.string()), ("offset", pa.int64()), ("size", pa.int64()), ("content", pa.binary())])
MANIFEST = pa.schema([("volume", pa.int64()), ("path", pa.string()), ("files", pa.int64()), ("bytes", pa.int64())])


def opened(path: str) -> tuple[fs.FileSystem, str]:
    """The file system of a path and the path in it; Spark writes local ones with one slash or three."""
    return fs.FileSystem.from_uri(re.sub(r"^file:/+", "file:///", path))


def volume_name(volume: int) -> str:
    """As ``functions.text.volume_path``, without the ending."""
    return f"images/{volume // 1000}/{volume % 1000:03d}"


@dataclass
class Archive:
    path: str
    at: int = 0
    size: int = 0


@dataclass
class Share(InputPartition):
    """Archives that one task reads, one after another."""

    paths: list[str]


def shares(some: list[Archive]) -> list[Share]:
    """The archives in their order, a few small ones together: ``SHARE_BYTES`` or a large one, less if there are few tasks then."""
    most = min(SHARE_BYTES, sum(a.size for a in some) // FEW_SHARES)
    made: list[Share] = []
    held = most + 1
    for a in some:
        if held + a.size > most:
            made.append(Share([]))
            held = 0
        made[-1].paths.append(a.path)
        held += a.size
    return made


def archives(path: str) -> list[Archive]:
    """The tar files below a path with their times of change, oldest first."""
    store, root = opened(path)
    found = store.get_file_info(fs.FileSelector(root, recursive=True, allow_not_found=True))
    return sorted((Archive(f.path, f.mtime_ns or 0, f.size or 0) for f in found if f.is_file and f.path.endswith((".tar", ".tar.gz")) and "/_making/" not in f.path), key=lambda a: (a.at, a.path))


class _Rest:
    """A stream from some bytes on that were read of it already."""

    def __init__(self, held: bytes, stream):
        self.held, self.stream = held, stream

    def read(self, n: int) -> bytes:
        some, self.held = self.held[:n], self.held[n:]
        return some + self.stream.read(n - len(some)) if len(some) < n else some


def members(stream, archive: str) -> Iterator[tuple]:
    """Members of an archive as they come by, one held at a time; a broken archive is an error.

    Plain headers of files are read here; from the first other one on (compressed, long
    names, folders, what isn't a header) ``tarfile`` reads.
    """
    held, at, base = b"", 0, 0  # what is held begins at ``base``, the next header is at ``at`` in it

    def there(n: int) -> bool:
        """Whether ``n`` bytes follow; they are held then."""
        nonlocal held, at, base
        if len(held) - at < n:
            parts, have = [held[at:]], len(held) - at
            while have < n and (more := stream.read(max(PIECE, n - have))):
                parts.append(more)
                have += len(more)
            base, held, at = base + at, b"".join(parts), 0
        return len(held) - at >= n

    while there(BLOCK):
        head = held[at : at + BLOCK]
        # The places of a tar header's fields.
        digits, told = head[124:135], head[148:154]
        if head[257:262] != b"ustar" or head[156:157] not in b"0\0" or head[345:346] != b"\0" or not head[0] or not digits.isdigit() or not told.isdigit():
            break
        try:
            name, size = head[:100].rstrip(b"\0").decode(), int(digits, 8)
            if b"\0" in head[:100].rstrip(b"\0") or name.endswith("/") or int(told, 8) != sum(head[:148]) + sum(head[156:]) + 256:
                break
        except ValueError:
            break
        if not there(BLOCK + size):
            raise tarfile.ReadError(f"{archive}: unexpected end of data")
        offset = base + at + BLOCK
        yield archive, name, offset, size, held[at + BLOCK : at + BLOCK + size]
        padded = BLOCK + -(-size // BLOCK) * BLOCK
        if not there(padded):
            raise tarfile.ReadError(f"{archive}: unexpected end of data")
        at += padded
    begun = base + at
    if begun and len(held) == at or held[at : at + BLOCK] == b"\0" * BLOCK and begun:
        return
    with tarfile.open(fileobj=_Rest(held[at:], stream), mode="r|*") as tar:
        for m in tar:
            if m.isfile():
                yield archive, m.name, begun + m.offset_data, m.size, tar.extractfile(m).read()
            tar.members.clear()  # else it keeps a note of each


class _Read:
    """What the readers of tables and streams share."""

    def __init__(self, options: dict):
        self.path = options["path"]

    def read(self, partition: Share) -> Iterator[pa.RecordBatch]:
        store, _ = opened(self.path)
        rows: list[tuple] = []
        held = 0
        for path in partition.paths:
            with store.open_input_stream(path, compression=None) as stream:
                for row in members(stream, path):
                    rows.append(row)
                    held += row[3]
                    if held >= PIECE or len(rows) >= BATCH_ROWS:
                        yield self._batch(rows)
                        rows, held = [], 0
        yield self._batch(rows)

    def _batch(self, rows: list[tuple]) -> pa.RecordBatch:
        columns = zip(*rows, strict=True) if rows else [()] * len(COLUMNS)
        return pa.RecordBatch.from_arrays([pa.array(c, k.type) for c, k in zip(columns, COLUMNS, strict=True)], schema=COLUMNS)


class TarReader(_Read, DataSourceReader):
    def partitions(self) -> list[Share]:
        return shares(archives(self.path)) or [Share([])]


class TarStreamReader(_Read, DataSourceStreamReader):
    """An offset is the time and path of the last archive read; one that comes later but says it is older isn't read."""

    def initialOffset(self) -> dict:
        return {"at": 0, "path": ""}

    def latestOffset(self, *_: object) -> dict:
        there = archives(self.path)
        return {"at": there[-1].at, "path": there[-1].path} if there else self.initialOffset()

    def partitions(self, start: dict, end: dict) -> list[Share]:
        after, upto = ((o["at"], o["path"]) for o in (start, end))
        return shares([a for a in archives(self.path) if after < (a.at, a.path) <= upto])

    def commit(self, end: dict) -> None:
        pass


# The header of an empty file without a name, and what its bytes add up to.
_PLAIN = tarfile.TarInfo("").tobuf(tarfile.GNU_FORMAT, "utf-8", "surrogateescape")
_SUM = sum(_PLAIN[:124]) + sum(_PLAIN[136:148]) + sum(_PLAIN[156:]) + 256


def header(name: str, size: int) -> bytes:
    """A file's header as ``tarfile`` makes it."""
    raw = name.encode("utf-8", "surrogateescape")
    if len(raw) > tarfile.LENGTH_NAME or not name or name.endswith("/") or size >= 8**11:
        info = tarfile.TarInfo(name)
        info.size = size
        return info.tobuf(tarfile.GNU_FORMAT, "utf-8", "surrogateescape")
    digits = b"%011o" % size
    told = b"%06o\0 " % (_SUM + sum(raw) + sum(digits))
    return b"".join((raw, _PLAIN[len(raw) : 124], digits, _PLAIN[135:148], told, _PLAIN[156:]))


@dataclass
class Made(WriterCommitMessage):
    """Volumes that a task has finished: number, where they wait, files, bytes."""

    volumes: list[tuple[int, str, int, int]]


class VolumeWriter(DataSourceArrowWriter):
    """Rows (volume, name, content), a volume's next to one another, as tar files with notes beside them.

    A task writes below ``_making`` under a name of its own. Only when all tasks are done
    are volumes moved to their places, and the manifest is written last; what a task that
    was stopped has left goes then, or when the job fails.
    """

    def __init__(self, options: dict):
        self.path, self.making = options["path"], f"_making/{uuid.uuid4().hex}"

    def write(self, iterator: Iterator[pa.RecordBatch]) -> Made:
        store, root = opened(self.path)
        place = f"{root}/{self.making}/{uuid.uuid4().hex}"
        store.create_dir(place, recursive=True)
        done: list[tuple[int, str, int, int]] = []
        out, at = None, 0
        notes: list[str] = []
        volume, total = None, 0

        def finish():
            if out is not None:
                end = at + 2 * BLOCK  # two empty blocks, and whole records
                out.write(b"\0" * (-(-end // tarfile.RECORDSIZE) * tarfile.RECORDSIZE - at))
                out.close()
                with store.open_output_stream(f"{place}/{volume}.json") as side:
                    side.write(f'{{"volume": {volume}, "files": [{", ".join(notes)}]}}'.encode())
                done.append((volume, f"{place}/{volume}", len(notes), total))

        for batch in iterator:
            columns = (batch.column(c).to_pylist() for c in ("volume", "name", "content"))
            for number, name, content in zip(*columns, strict=True):
                if number != volume or out is None:
                    finish()
                    volume, total, at, notes = number, 0, 0, []
                    out = store.open_output_stream(f"{place}/{volume}.tar")
                body = content or b""
                size, head = len(body), header(name, len(body))
                at += len(head)
                notes.append(f'{{"name": {json.dumps(name)}, "offset": {at}, "size": {size}, "sha256": "{hashlib.sha256(body).hexdigest()}"}}')
                out.write(b"".join((head, body, b"\0" * (-size % BLOCK))))
                at += size + -size % BLOCK
                total += size
        finish()
        return Made(done)

    def commit(self, messages: list[Made | None]) -> None:
        store, root = opened(self.path)
        made = sorted(v for m in messages if m for v in m.volumes)
        numbers = [v for v, *_ in made]
        try:
            if len(set(numbers)) < len(numbers):
                raise ValueError("a volume was written by more than one task")
            there = [f.path for f in store.get_file_info([f"{root}/{volume_name(v)}.tar" for v in numbers]) if f.type != fs.FileType.NotFound]
            if there:
                raise ValueError(f"volumes are never written over: {there[0]}")
            for folder in {f"{root}/{volume_name(v)}".rpartition("/")[0] for v in numbers}:
                store.create_dir(folder, recursive=True)
            for v, held, _, _ in made:
                place = f"{root}/{volume_name(v)}"
                store.move(f"{held}.json", f"{place}.json")
                store.move(f"{held}.tar", f"{place}.tar")
            rows = [(v, f"{volume_name(v)}.tar", n, size) for v, _, n, size in made]
            table = pa.table([pa.array(c, k.type) for c, k in zip(zip(*rows, strict=True) if rows else [()] * 4, MANIFEST, strict=True)], schema=MANIFEST)
            store.create_dir(f"{root}/manifest", recursive=True)
            with store.open_output_stream(f"{root}/manifest/{uuid.uuid4().hex}.parquet") as out:
                pq.write_table(table, out)
        finally:
            self._clear(store, root)

    def abort(self, messages: list[Made | None]) -> None:
        self._clear(*opened(self.path))

    def _clear(self, store: fs.FileSystem, root: str) -> None:
        if store.get_file_info(f"{root}/{self.making}").type != fs.FileType.NotFound:
            store.delete_dir(f"{root}/{self.making}")


class TarSource(DataSource):
    """``tar_members``: reads archives, a partition each, as tables or streams; writes volumes."""

    @classmethod
    def name(cls) -> str:
        return "tar_members"

    def schema(self) -> str:
        return MEMBER

    def reader(self, schema) -> TarReader:
        return TarReader(self.options)

    def streamReader(self, schema) -> TarStreamReader:
        return TarStreamReader(self.options)

    def writer(self, schema, overwrite: bool) -> VolumeWriter:
        return VolumeWriter(self.options)


def tar_files(spark: SparkSession, path: str) -> DataFrame:
    """Members of the tar files below a path; an archive is read by one task, a member at a time."""
    spark.dataSource.register(TarSource)
    return spark.read.format(TarSource.name()).load(path)


def tar_stream(spark: SparkSession, path: str) -> DataFrame:
    """The same as a stream: each run reads the archives that came since the last."""
    spark.dataSource.register(TarSource)
    return spark.readStream.format(TarSource.name()).load(path)


def write_volumes(packed: DataFrame, path: str, key: str, name: str, content: str) -> DataFrame:
    """The rows' ``content`` (text or bytes; null: empty) as files ``name`` in the tar of their ``volume``, by ``key``; gives the manifest."""
    spark = packed.sparkSession
    spark.dataSource.register(TarSource)
    rows = packed.select("volume", key, packed[name].cast("string").alias("_name"), packed[content].cast("binary").alias("_content"))
    placed = rows.repartition("volume").sortWithinPartitions("volume", key).select(packed["volume"].cast("long").alias("volume"), rows["_name"].alias("name"), rows["_content"].alias("content"))
    placed.write.format(TarSource.name()).mode("append").save(path)
    return spark.read.parquet(f"{path}/manifest")


def volume_files(spark: SparkSession, path: str) -> DataFrame:
    """What the notes beside the volumes say: ``volume``, ``name``, ``offset``, ``size``, ``sha256``."""
    from pyspark.sql import functions as F

    notes = spark.read.schema("volume long, files array<struct<name: string, offset: long, size: long, sha256: string>>").option("multiLine", True).json(f"{path}/images/*/*.json")
    return notes.select("volume", F.explode("files").alias("f")).select("volume", "f.*")


def fetched(files: DataFrame, path: str) -> DataFrame:
    """``files`` (of ``volume_files``) with ``content``, each read by its offset alone."""

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        store, root = opened(path)
        for batch in batches:
            out = []
            for row in batch.select(["volume", "offset", "size"]).to_pylist():
                with store.open_input_file(f"{root}/{volume_name(row['volume'])}.tar") as f:
                    out.append(f.read_at(row["size"], row["offset"]))
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(out, pa.binary())], names=[*batch.schema.names, "content"])

    schema = ", ".join([*(f"{n} {k}" for n, k in files.dtypes), "content binary"])
    return files.mapInArrow(read, schema)

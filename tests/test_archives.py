"""Archives: what the sink leaves when tasks fail, and how the source reads."""

import hashlib
import io
import json
import tarfile

import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from lakeloom.sources import archives


def rows(*each):
    return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*each, strict=True), (pa.int64(), pa.string(), pa.binary()), strict=True)], names=["volume", "name", "content"])


def files_below(folder):
    return sorted(str(p.relative_to(folder)) for p in folder.rglob("*") if p.is_file())


def test_a_task_that_breaks_off_leaves_no_volume(tmp_path):
    writer = archives.VolumeWriter({"path": str(tmp_path)})

    def broken():
        yield rows((0, "a", b"1"), (0, "b", b"22"), (1, "c", b"3"))
        raise OSError("the executor is gone")

    with pytest.raises(OSError):
        writer.write(broken())
    again = writer.write(iter([rows((0, "a", b"1"), (0, "b", b"22")), rows((0, "e", None), (1, "c" * 200, b"3"))]))
    assert not (tmp_path / "images").exists()
    writer.commit([again, None])
    assert files_below(tmp_path / "images") == ["0/000.json", "0/000.tar", "0/001.json", "0/001.tar"] and not list((tmp_path / "_making").iterdir())
    with tarfile.open(tmp_path / "images/0/000.tar") as tar:
        assert [(m.name, tar.extractfile(m).read()) for m in tar] == [("a", b"1"), ("b", b"22"), ("e", b"")]
    for volume in (0, 1):
        whole = (tmp_path / f"images/0/00{volume}.tar").read_bytes()
        for f in json.loads((tmp_path / f"images/0/00{volume}.json").read_text())["files"]:
            assert hashlib.sha256(whole[f["offset"] : f["offset"] + f["size"]]).hexdigest() == f["sha256"]


def test_volumes_are_never_written_over(tmp_path):
    archives.VolumeWriter({"path": str(tmp_path)}).commit([archives.VolumeWriter({"path": str(tmp_path)}).write(iter([rows((7, "a", b"old"))]))])
    writer = archives.VolumeWriter({"path": str(tmp_path)})
    made = writer.write(iter([rows((6, "b", b"x"), (7, "b", b"new"))]))
    with pytest.raises(ValueError, match="never written over"):
        writer.commit([made])
    assert files_below(tmp_path / "images") == ["0/007.json", "0/007.tar"]
    twice = archives.VolumeWriter({"path": str(tmp_path)})
    with pytest.raises(ValueError, match="more than one task"):
        twice.commit([twice.write(iter([rows((8, "b", b"x"))])), twice.write(iter([rows((8, "b", b"x"))]))])
    gone = archives.VolumeWriter({"path": str(tmp_path)})
    gone.write(iter([rows((9, "b", b"x"))]))
    gone.abort([])
    assert not [f for f in files_below(tmp_path) if "008" in f or "009" in f or "_making" in f]


class Slow(io.RawIOBase):
    """An archive without end: it can only be read as it comes."""

    def __init__(self):
        self.made, self.at = b"", 0

    def read(self, n=-1):
        while len(self.made) < n:
            out = io.BytesIO()
            with tarfile.open(fileobj=out, mode="w") as tar:
                info = tarfile.TarInfo(f"{self.at}.json")
                info.size = 1 << 20
                tar.addfile(info, io.BytesIO(bytes(1 << 20)))
            self.made += out.getvalue()[: 512 + (1 << 20)]
            self.at += 1
        out, self.made = self.made[:n], self.made[n:]
        return out


def test_members_come_one_by_one():
    source = Slow()
    read = archives.members(source, "a")
    for i in range(300):  # far more than is held at a time
        _, name, offset, size, body = next(read)
        assert (name, size, len(body)) == (f"{i}.json", 1 << 20, 1 << 20) and offset == i * (512 + (1 << 20)) + 512
        assert source.at <= i + 3


def test_source_and_stream(spark, tmp_path):
    df = spark.createDataFrame([(i // 4, i, f"f{i}.json", f'{{"id": {i}}}') for i in range(10)], "volume long, id long, file string, body string")
    assert archives.tar_files(spark, str(tmp_path / "none")).count() == 0

    def run():
        stream = archives.tar_stream(spark, str(tmp_path / "in")).select("archive", F.get_json_object(F.col("content").cast("string"), "$.id").alias("id"))
        stream.writeStream.format("parquet").option("checkpointLocation", str(tmp_path / "state")).trigger(availableNow=True).start(str(tmp_path / "out")).awaitTermination()
        return sorted(int(r.id) for r in spark.read.schema("archive string, id string").parquet(str(tmp_path / "out")).collect())

    manifest = archives.write_volumes(df.where("volume < 2"), str(tmp_path / "in"), "id", "file", "body")
    assert sorted((r.volume, r.files) for r in manifest.collect()) == [(0, 4), (1, 4)]
    read = archives.tar_files(spark, str(tmp_path / "in"))
    assert read.count() == 8 and read.rdd.getNumPartitions() == 2
    assert run() == list(range(8)) and run() == list(range(8))
    archives.write_volumes(df.where("volume = 2"), str(tmp_path / "in"), "id", "file", "body")
    assert run() == list(range(10))
    assert archives.fetched(archives.volume_files(spark, str(tmp_path / "in")), str(tmp_path / "in")).where(F.sha2("content", 256) != F.col("sha256")).count() == 0


def test_broken_archives_are_errors(spark, tmp_path):
    archives.write_volumes(spark.createDataFrame([(0, 1, "a", "x" * 5000)], "volume long, id long, file string, body string"), str(tmp_path), "id", "file", "body")
    whole = next(tmp_path.rglob("*.tar"))
    whole.write_bytes(whole.read_bytes()[:3000])
    with pytest.raises(Exception, match="unexpected end of data"):
        archives.tar_files(spark, str(tmp_path)).collect()


def test_headers_are_those_of_tarfile():
    for name, size in (("a", 0), ("é/ü.json", 12), ("x" * 100, 8**11 - 1), ("x" * 101, 5), ("big", 8**11), ("7.json", 511)):
        info = tarfile.TarInfo(name)
        info.size = size
        assert archives.header(name, size) == info.tobuf(tarfile.GNU_FORMAT, "utf-8", "surrogateescape")


def test_members_of_any_archive_are_those_of_tarfile():
    """Plain headers first, then folders, long names and pax headers, in all three formats, cut anywhere."""
    for kind in (tarfile.USTAR_FORMAT, tarfile.GNU_FORMAT, tarfile.PAX_FORMAT):
        made = io.BytesIO()
        with tarfile.open(fileobj=made, mode="w", format=kind) as tar:
            for name, size in (("a", 0), ("b.json", 3), ("c", 512), ("big", 3 << 20), ("d/", 0), ("p/" * 60 + "long", 700), ("é", 5), ("z", 1)):
                info = tarfile.TarInfo(name)
                info.size, info.type = size, tarfile.DIRTYPE if name.endswith("/") and len(name) < 5 else tarfile.REGTYPE
                tar.addfile(info, io.BytesIO(b"x" * size))
        body = made.getvalue()
        with tarfile.open(fileobj=io.BytesIO(body)) as tar:
            expected = [("a.tar", m.name, m.offset_data, m.size, tar.extractfile(m).read()) for m in tar if m.isfile()]
        assert list(archives.members(io.BytesIO(body), "a.tar")) == expected and len(expected) == 7
        for cut in (600, 1100, 2000, 4000, 3 << 20):
            with pytest.raises(tarfile.ReadError):
                list(archives.members(io.BytesIO(body[:cut]), "a.tar"))


def test_small_archives_share_a_task():
    few = archives.shares([archives.Archive(f"{i}", i, 10 << 20) for i in range(10)])
    many = archives.shares([archives.Archive(f"{i}", i, 1 << 20) for i in range(50_000)])
    assert len(few) == 10 and 1500 < len(many) < 2000 and [p for s in many for p in s.paths] == [f"{i}" for i in range(50_000)]
    assert archives.shares([]) == [] and [s.paths for s in archives.shares([archives.Archive("a"), archives.Archive("b")])] == [["a", "b"]]

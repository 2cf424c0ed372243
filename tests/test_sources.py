"""Readers on files that the tests write."""

import bz2
import struct

import numpy as np
import pytest

from kinestream.operators.contract import ContractError
from kinestream.sources import bvh, rosbag, tables

BVH = """HIERARCHY
ROOT hip
{
 OFFSET 0 0 0
 CHANNELS 6 Xposition Yposition Zposition Zrotation Xrotation Yrotation
 JOINT knee
 {
  OFFSET 0 1 0
  CHANNELS 3 Zrotation Xrotation Yrotation
  End Site
  {
   OFFSET 0 2 0
  }
 }
}
MOTION
Frames: 2
Frame Time: 0.5
0 0 0 0 0 0 0 0 0
1 2 3 90 0 0 0 0 0
"""


def test_bvh(spark, tmp_path):
    (tmp_path / "a.bvh").write_text(BVH)
    assert [(r.name, r.parent) for r in bvh.read_nodes(spark, str(tmp_path)).orderBy("node").collect()] == [("hip", -1), ("knee", 0), ("knee_end", 1)]
    r = bvh.read_positions(spark, str(tmp_path), chunk=1).orderBy("frame", "node").collect()
    assert np.allclose([[x.x, x.y, x.z] for x in r], [[0, 0, 0], [0, 1, 0], [0, 3, 0], [1, 2, 3], [0, 2, 3], [-2, 2, 3]])
    with pytest.raises(ValueError):
        bvh.parse(BVH.replace("Frames: 2", "Frames: 3"))


def test_track_text(spark, tmp_path):
    (tmp_path / "m.tsv").write_text("NAME\tx\nFREQUENCY\t120\n\nFrameCounter\tMarker_1_Pos_X(mm)\tMarker_1_Pos_Y(mm)\tMarker_1_Pos_Z(mm)\r\n5\t1.5\t\t3\r\n6\t2\t4\t5\r\n")
    wanted = [f"Marker_1_Pos_{a}(mm)" for a in "XYZ"]
    wide = tables.read_track_text(spark, str(tmp_path), "FrameCounter", wanted)
    assert [tuple(r) for r in wide.orderBy("FrameCounter").collect()] == [(5, 1.5, None, 3.0), (6, 2.0, 4.0, 5.0)]
    assert [tuple(r) for r in tables.joint_rows(wide, "FrameCounter", ["Marker_1"]).orderBy("FrameCounter").collect()][1] == (6, 0, "Marker_1", 2.0, 4.0, 5.0)
    with pytest.raises(ContractError):
        tables.read_track_text(spark, str(tmp_path), "FrameCounter", ["none"])


def test_npz(spark, tmp_path):
    np.savez(tmp_path / "s.npz", time=[0.0, 0.1], glove=np.arange(12.0).reshape(2, 2, 3))
    r = tables.read_npz(spark, str(tmp_path), "time", ["glove", "rgb"]).orderBy("i").collect()
    assert r[1].glove == [6, 7, 8, 9, 10, 11] and r[0].rgb is None


def _record(fields, data):
    head = b"".join(struct.pack("<I", len(k) + 1 + len(v)) + k + b"=" + v for k, v in fields.items())
    return struct.pack("<I", len(head)) + head + struct.pack("<I", len(data)) + data


def test_bag(spark, tmp_path):
    """A bag that was never closed: no index section, records only."""
    conn = struct.pack("<I", 0)
    inner, places = b"", []
    for k, text in enumerate((b"one", b"two")):
        places.append(len(inner))
        inner += _record({b"op": b"\x02", b"conn": conn, b"time": struct.pack("<II", 7, k)}, text)
    chunk = _record({b"op": b"\x05", b"compression": b"bz2", b"size": struct.pack("<I", len(inner))}, bz2.compress(inner))
    index = _record({b"op": b"\x04", b"ver": struct.pack("<I", 1), b"conn": conn, b"count": struct.pack("<I", 2)}, b"".join(struct.pack("<III", 7, k, p) for k, p in enumerate(places)))
    connection = _record({b"op": b"\x07", b"conn": conn, b"topic": b"/cam"}, b"")
    (tmp_path / "a.bag").write_bytes(rosbag.MAGIC + connection + chunk + index)
    assert [(r.topic, r.message, r.ts_ns) for r in rosbag.read_index(spark, str(tmp_path)).orderBy("message").collect()] == [("/cam", 0, 7_000_000_000), ("/cam", 1, 7_000_000_001)]
    assert [bytes(r.payload) for r in rosbag.read_messages(spark, str(tmp_path), ["/cam"]).orderBy("ts_ns").collect()] == [b"one", b"two"]
    assert rosbag.read_messages(spark, str(tmp_path), ["/other"]).count() == 0
    of = lambda *frames: spark.createDataFrame([("/cam", k) for k in frames], "topic string, message long")
    assert [(r.message, bytes(r.payload)) for r in rosbag.read_selected(spark, str(tmp_path), of(1, 1)).collect()] == [(1, b"two")]
    assert [bytes(r.payload) for r in rosbag.read_selected(spark, str(tmp_path), of(0, 1)).orderBy("message").collect()] == [b"one", b"two"]
    with pytest.raises(ContractError):
        rosbag.read_selected(spark, str(tmp_path), of(1, 2))


@pytest.mark.parametrize("compression", ["none", "bz2"])
def test_bag_is_many_tasks(spark, tmp_path, compression):
    """Two bags of many chunks: a task for each range of chunks; a range of messages reads only its own chunks, in order."""
    rows = [(f"b{k % 2}", f"/t{k % 3}", 10**9 + 1000 * k, f"{k:05d}".encode() * 40) for k in range(600)]
    made = rosbag.write_bags(spark.createDataFrame(rows, "bag string, topic string, ts_ns long, payload binary"), str(tmp_path / "bags"), compression, 4096).collect()
    assert {(r.bag, r.messages) for r in made} == {("b0", 300), ("b1", 300)} and all(r.bytes == (tmp_path / f"bags/{r.bag}.bag").stat().st_size for r in made)
    assert sorted(p.name for p in (tmp_path / "bags").iterdir()) == ["b0.bag", "b1.bag"]
    path = str(tmp_path / "bags")
    index = rosbag.read_index(spark, path, task_bytes=8192)
    assert index.rdd.getNumPartitions() >= (4 if compression == "bz2" else 20)
    count, want = {}, []
    for bag, topic, ts, body in rows:
        n = count[bag, topic] = count.get((bag, topic), -1) + 1
        want.append((bag, topic, n, ts, body))
    name = lambda p: p.rsplit("/", 1)[1].removesuffix(".bag")
    assert sorted((name(r.path), r.topic, r.message, r.ts_ns) for r in index.collect()) == sorted(w[:4] for w in want)
    for size in (1, 8192, 1 << 30):
        got = rosbag.read_messages(spark, path, ["/t1", "/t2"], task_bytes=size).collect()
        assert sorted((name(r.path), r.topic, r.message, r.ts_ns, bytes(r.payload)) for r in got) == sorted(w for w in want if w[1] != "/t0")
    got = rosbag.read_range(spark, path, "/t1", 20, 31, task_bytes=1).collect()
    assert [(name(r.path), r.topic, r.message, r.ts_ns, bytes(r.payload)) for r in got] == sorted(w for w in want if w[1] == "/t1" and 20 <= w[2] < 31)
    for bad in ((0, 101), (5, 4)):
        with pytest.raises(Exception, match="ContractError|no range"):
            rosbag.read_range(spark, path, "/t1", *bad).collect()
    _, chunks, _ = rosbag.layout(f"{path}/b0.bag")
    raw = bytearray((tmp_path / "bags/b0.bag").read_bytes())
    for c in chunks[:3]:
        raw[c.at + 80 : c.at + 200] = b"\xff" * 120
    (tmp_path / "bags/b0.bag").write_bytes(raw)
    assert len(rosbag.read_range(spark, path, "/t1", 80, 90, task_bytes=1).collect()) == 20
    if compression == "bz2":  # chunks that aren't packed have no checksum
        with pytest.raises(Exception, match="(?i)invalid data"):
            rosbag.read_range(spark, path, "/t1", 0, 10).collect()


def test_bags_that_are_broken(spark, tmp_path):
    """Another file, an index beyond the end, a chunk of another size than stated, times that do not increase."""
    (tmp_path / "x.bag").write_bytes(b"#ROSBAG V1.2\n")
    with pytest.raises(ContractError, match="format 2.0"):
        rosbag.layout(str(tmp_path / "x.bag"))
    (tmp_path / "y.bag").write_bytes(rosbag.MAGIC + _record({b"op": b"\x03", b"index_pos": struct.pack("<Q", 10**6)}, b""))
    with pytest.raises(ContractError, match="index"):
        rosbag.layout(str(tmp_path / "y.bag"))
    with pytest.raises(ContractError, match="size"):
        rosbag._unpacked(bz2.compress(b"abc"), b"bz2", 4)
    with pytest.raises(ContractError):
        rosbag.write_bags(spark.createDataFrame([("a", "/t", None, b"x")], "bag string, topic string, ts_ns long, payload binary"), str(tmp_path / "none"))
    twice = spark.createDataFrame([("a", "/t", 5, b"x"), ("a", "/t", 5, b"y")], "bag string, topic string, ts_ns long, payload binary")
    rosbag.write_bags(twice, str(tmp_path / "twice"))
    with pytest.raises(ContractError, match="increase"):
        rosbag.read_range(spark, str(tmp_path / "twice"), "/t", 0, 2)


def test_files_are_written_once(spark, tmp_path):
    df = spark.range(3)
    tables.write_once(df, str(tmp_path / "t"))
    with pytest.raises(Exception, match="(?i)exist"):
        tables.write_once(df, str(tmp_path / "t"))
    assert tables.file_hashes(spark, str(tmp_path / "t")).count() >= 1


def test_tables_of_another_column_order(spark, tmp_path):
    (tmp_path / "a.txt").write_text("made by hand\nFrameCounter\tA\tB\n1\t1.5\t2\n")
    (tmp_path / "b.txt").write_text("FrameCounter\tB\tC\tA\n2\t7\tx\t8\n")
    got = tables.read_track_text(spark, str(tmp_path), "FrameCounter", ["A", "B"]).collect()
    assert sorted(map(tuple, got)) == [(1, 1.5, 2.0), (2, 8.0, 7.0)]
    (tmp_path / "c.txt").write_text("FrameCounter\tA\n3\t7\n")
    with pytest.raises(ContractError):
        tables.read_track_text(spark, str(tmp_path), "FrameCounter", ["A", "B"])


def test_metrics_come_last_and_are_plain(spark, tmp_path):
    import hashlib
    import json

    df = spark.createDataFrame([("t1", 1, 0.5), ("t1", 0, None), ("t2", 0, float("nan"))], "take string, frame int, x double")
    out = str(tmp_path / "out")
    tables.publish(spark, {"rows": df}, out, df.groupBy("take").agg({"x": "max"}).toDF("take", "most"))
    lines = [line.split("  ") for f in sorted((tmp_path / "out/SHA256SUMS").glob("part*")) for line in f.read_text().splitlines()]
    files = {str(f.relative_to(tmp_path / "out")): hashlib.sha256(f.read_bytes()).hexdigest() for f in (tmp_path / "out/rows").glob("part*")}
    assert {n: h for h, n in lines} == files and [n for _, n in lines] == sorted(files)
    metrics = [json.loads(line) for f in (tmp_path / "out/metrics").glob("part*") for line in f.read_text().splitlines()]
    assert sorted(metrics, key=str) == [{"take": "t1", "most": 0.5}, {"take": "t2", "most": None}]
    with pytest.raises(Exception, match="exists"):
        tables.publish(spark, {"rows": df}, out, df)
    tables.write_frame_map(df, str(tmp_path / "map"), ["frame"], "take")
    rows = [f.read_text().splitlines() for f in (tmp_path / "map/take=t1").glob("part*")]
    assert rows == [["frame,x", "0,", "1,0.5"]]
    for _ in range(2):
        tables.append_log(df.limit(1), str(tmp_path / "log"))
    assert spark.read.json(str(tmp_path / "log")).count() == 2
    (tmp_path / "rec_1_a").mkdir(), (tmp_path / "rec_2_a").mkdir(), (tmp_path / "rec_2_b").mkdir()
    assert tables.found_segments(spark, str(tmp_path), ["rec_1"])["rec_1"].endswith("/rec_1_a")
    with pytest.raises(ContractError):
        tables.found_segments(spark, str(tmp_path), ["rec_2"])


def test_calibrations_in_archives(spark, tmp_path):
    """One file of an archive is read and checked; none, several, or one outside of the folder is an error."""
    import io
    import json
    import tarfile

    from kinestream.operators import documents
    from kinestream.operators.documents import Field

    def archive(name, files):
        with tarfile.open(tmp_path / name, "w:gz") as out:
            for path, text in files:
                info = tarfile.TarInfo(path)
                info.size = len(text)
                out.addfile(info, io.BytesIO(text.encode()))

    archive("good.tar.gz", [("a/readme.txt", "x"), ("a/calibration.json", json.dumps({"schema": "v1", "matrix": [[1, 0.5], [0, 1]]}))])
    rows = tables.read_archived(spark, str(tmp_path / "good.tar.gz"), "calibration.json")
    fields = [Field("schema", "string", one_of=("v1",)), Field("matrix", shape=(2, 2))]
    r = documents.read(rows, ["name"], "text", fields).first()
    assert (r.name, r.schema, r.matrix) == ("a/calibration.json", "v1", [[1.0, 0.5], [0.0, 1.0]])
    for name, files in (("none.tar.gz", [("b.txt", "x")]), ("two.tar.gz", [("a/calibration.json", "{}"), ("b/calibration.json", "{}")]), ("out.tar.gz", [("../calibration.json", "{}")])):
        archive(name, files)
        with pytest.raises(Exception, match="ContractError"):
            tables.read_archived(spark, str(tmp_path / name), "calibration.json").collect()

"""ROS 1 bags (format 2.0) as a data source: index and messages by chunk ranges with seeks, and a sink that writes bags."""

from __future__ import annotations

import bz2
import json
import struct
import uuid
from collections.abc import Iterator
from dataclasses import dataclass, field

import pandas as pd
import pyarrow as pa
from pyarrow import fs
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.datasource import DataSource, DataSourceReader, InputPartition

from kinestream.operators.contract import ContractError, enforce
from kinestream.shared import written

MAGIC = b"#ROSBAG V2.0\n"
#: Record kinds of the format, and the length that the first record is filled up to.
MESSAGE, BAG, INDEX, CHUNK, CHUNK_INFO, CONNECTION = 2, 3, 4, 5, 6, 7
BAG_RECORD = 4096
INDEX_ROWS = "path string, topic string, message long, ts_ns long, chunk_at long, at long"
#: Bytes of chunks that a task reads, and messages of a batch that it hands on.
TASK_BYTES, BATCH = 64 << 20, 64


def opened(path: str) -> pa.NativeFile:
    """A file for reading with seeks, on any store that Arrow knows; ``file:`` may be left out."""
    store, inner = fs.FileSystem.from_uri(path) if "://" in path else (fs.LocalFileSystem(), path.removeprefix("file:"))
    return store.open_input_file(inner)


def _exactly(handle, n: int) -> bytes:
    raw = handle.read(n)
    if len(raw) != n:
        raise ContractError("a record ends before its stated length")
    return raw


def _fields(raw: bytes) -> dict[bytes, bytes]:
    out, at = {}, 0
    while at < len(raw):
        (size,) = struct.unpack_from("<I", raw, at)
        name, equals, value = raw[at + 4 : at + 4 + size].partition(b"=")
        if not equals or at + 4 + size > len(raw):
            raise ContractError("a record's header field is malformed")
        out[name] = value
        at += 4 + size
    return out


def _head(handle) -> tuple[dict[bytes, bytes], int]:
    """Header fields of the record at the handle's place, and the length of its data, where the handle then is."""
    found = _fields(_exactly(handle, *struct.unpack("<I", _exactly(handle, 4))))
    return found, struct.unpack("<I", _exactly(handle, 4))[0]


def _int(raw: bytes) -> int:
    return int.from_bytes(raw, "little")


def _time_ns(raw: bytes) -> int:
    sec, nsec = struct.unpack("<II", raw)
    return sec * 1_000_000_000 + nsec


def _topic(fields: dict[bytes, bytes]) -> str:
    return fields[b"topic"].decode("utf-8", "replace")


def _unpacked(data: bytes, how: bytes, size: int) -> bytes:
    if how == b"none":
        out = data
    elif how == b"bz2":
        out = bz2.decompress(data)
    elif how == b"lz4":
        import lz4.frame  # optional

        out = lz4.frame.decompress(data)
    else:
        raise ContractError(f"unknown chunk compression {how!r}")
    if len(out) != size:
        raise ContractError("a chunk has another size than stated")
    return out


@dataclass
class ChunkRef:
    """A chunk's place and the messages of each connection in it."""

    at: int
    counts: dict[int, int] = field(default_factory=dict)


def layout(path: str) -> tuple[dict[int, str], list[ChunkRef], int]:
    """Topics by connection, chunks in the order of the file, and where records of chunks end.

    A closed bag says so in its last section, which is all that is read: a few bytes a chunk. In a bag that was never closed the heads of all
    records are read, with a seek over each one's data.
    """
    with opened(path) as f:
        if f.read(len(MAGIC)) != MAGIC:
            raise ContractError(f"{path}: not a bag of format 2.0")
        topics, chunks, start, size = {}, [], f.tell(), f.size()
        head, length = _head(f) if size > start else ({}, 0)
        end = _int(head[b"index_pos"]) if head.get(b"op") == bytes([BAG]) else 0
        if end and not start < end <= size:
            raise ContractError(f"{path}: its index would be at {end} of {size} bytes")
        f.seek(end or start)
        while f.tell() < size:
            at = f.tell()
            head, length = _head(f)
            op = head[b"op"][0]
            if op == CONNECTION:
                topics[_int(head[b"conn"])] = _topic(head)
            elif op == CHUNK_INFO:
                data = _exactly(f, length)
                chunks.append(ChunkRef(_int(head[b"chunk_pos"]), dict(struct.iter_unpack("<II", data))))
                continue
            elif op == CHUNK and not end:
                chunks.append(ChunkRef(at))
            elif op == INDEX and not end:
                c = _int(head[b"conn"])
                chunks[-1].counts[c] = chunks[-1].counts.get(c, 0) + _int(head[b"count"])
            f.seek(f.tell() + length)
    return topics, sorted(chunks, key=lambda c: c.at), end or size


@dataclass
class BagRange(InputPartition):
    """Chunks [first, stop) of a bag by place, and how many messages of each topic come before them."""

    path: str
    first: int
    stop: int
    topics: dict[int, str]
    before: dict[str, int]


def _entries(f, end: int) -> Iterator[tuple[int, int, int]]:
    """(connection, time, place in the chunk) from the index records behind a chunk."""
    while f.tell() < end:
        at = f.tell()
        head, length = _head(f)
        if head[b"op"][0] != INDEX:
            f.seek(at)
            return
        data, n = _exactly(f, length), _int(head[b"count"])
        if length != 12 * n:
            raise ContractError("an index record has another length than its count says")
        for k in range(n):
            yield _int(head[b"conn"]), _time_ns(data[12 * k : 12 * k + 8]), struct.unpack_from("<I", data, 12 * k + 8)[0]


def _message(chunk: bytes, at: int, connection: int | None = None, ts: int | None = None) -> bytes:
    """The payload of the message at a place of an unpacked chunk; another record, connection or time there is an error."""
    (n,) = struct.unpack_from("<I", chunk, at)
    head = _fields(chunk[at + 4 : at + 4 + n])
    (m,) = struct.unpack_from("<I", chunk, at + 4 + n)
    body = chunk[at + 8 + n : at + 8 + n + m]
    if head[b"op"][0] != MESSAGE or len(body) != m or connection not in (None, _int(head[b"conn"])) or ts not in (None, _time_ns(head[b"time"])):
        raise ContractError("an index points to what is not its message")
    return body


class BagReader(DataSourceReader):
    """Options: paths and topics (JSON lists; no topics: all), payload, first and stop (messages of each topic, half open), taskBytes."""

    def __init__(self, options: dict[str, str]) -> None:
        self.paths = json.loads(options["paths"])
        self.wanted = set(json.loads(options.get("topics", "[]")))
        self.payload = options.get("payload") == "true"
        self.first, self.stop = int(options.get("first", 0)), int(options["stop"]) if "stop" in options else None
        self.task_bytes = int(options.get("taskBytes", TASK_BYTES))

    def partitions(self) -> list[BagRange]:
        """Ranges of chunks that hold a wanted message. Reads only what ``layout`` does."""
        out = []
        for path in self.paths:
            topics, chunks, end = layout(path)
            seen = {t: 0 for t in topics.values() if not self.wanted or t in self.wanted}
            now: BagRange | None = None
            for chunk, until in zip(chunks, [*[c.at for c in chunks[1:]], end], strict=True):
                mine: dict[str, int] = {}
                for c, n in chunk.counts.items():
                    if c not in topics:
                        raise ContractError(f"{path}: connection {c} has no record")
                    mine[topics[c]] = mine.get(topics[c], 0) + n
                held = any(t in seen and seen[t] + n > self.first and (self.stop is None or seen[t] < self.stop) for t, n in mine.items())
                if held and now is not None and now.stop == chunk.at and until - now.first <= self.task_bytes:
                    now.stop = until
                elif held:
                    now = BagRange(path, chunk.at, until, topics, dict(seen))
                    out.append(now)
                for t in seen:
                    seen[t] += mine.get(t, 0)
            if self.stop is not None and (short := {t: seen.get(t, 0) for t in self.wanted or seen if seen.get(t, 0) < self.stop}):
                raise ContractError(f"{path}: messages [{self.first}, {self.stop}) of {short}")
        return out

    def read(self, part: BagRange | None) -> Iterator[pa.RecordBatch]:
        if part is None:  # Spark asks so where there are no partitions
            return
        rows: list[tuple] = []
        count = dict(part.before)
        with opened(part.path) as f:
            f.seek(part.first)
            while f.tell() < part.stop:
                at = f.tell()
                head, length = _head(f)
                if head[b"op"][0] != CHUNK:
                    f.seek(f.tell() + length)
                    continue
                data_at = f.tell()
                f.seek(data_at + length)
                wanted = []
                for connection, ts, place in _entries(f, part.stop):
                    topic = part.topics[connection]
                    if topic in count:
                        if count[topic] >= self.first and (self.stop is None or count[topic] < self.stop):
                            wanted.append((part.path, topic, count[topic], ts, at, place, connection))
                        count[topic] += 1
                after = f.tell()
                if wanted and self.payload:
                    f.seek(data_at)
                    chunk = _unpacked(_exactly(f, length), head[b"compression"], _int(head[b"size"]))
                    f.seek(after)
                for *row, connection in wanted:
                    rows.append((*row, _message(chunk, row[5], connection, row[3])) if self.payload else tuple(row))
                    if len(rows) >= (BATCH if self.payload else 100 * BATCH):
                        yield self._batch(rows)
                        rows = []
        if rows:
            yield self._batch(rows)

    def _batch(self, rows: list[tuple]) -> pa.RecordBatch:
        kinds = [pa.string(), pa.string(), pa.int64(), pa.int64(), pa.int64(), pa.int64(), pa.binary()][: 6 + self.payload]
        names = ["path", "topic", "message", "ts_ns", "chunk_at", "at", "payload"]
        return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*rows, strict=True), kinds, strict=True)], names=names[: len(kinds)])


class BagSource(DataSource):
    """``spark.read.format("rosbag")`` once registered."""

    @classmethod
    def name(cls) -> str:
        return "rosbag"

    def schema(self) -> str:
        return INDEX_ROWS + (", payload binary" if self.options.get("payload") == "true" else "")

    def reader(self, schema) -> BagReader:
        return BagReader(self.options)  # names of options know no case


def _read(spark: SparkSession, path: str, **options: object) -> DataFrame:
    spark.dataSource.register(BagSource)
    # Spark lists what is there, folders and patterns of any store; contents aren't read.
    paths = sorted(r["path"] for r in spark.read.format("binaryFile").load(path).select("path").collect())
    given = {k: v if isinstance(v, str) else json.dumps(v) for k, v in options.items() if v is not None}
    return spark.read.format("rosbag").options(paths=json.dumps(paths), **given).load()


def read_index(spark: SparkSession, path: str, topics: list[str] | None = None, task_bytes: int = TASK_BYTES) -> DataFrame:
    """The message index of bags: path, topic, message, ts_ns, chunk_at, at. No chunk is unpacked, nor read.

    ``message`` counts a topic's messages from 0 in the order of the file's index. A bag of any size is a task for each ``task_bytes`` of chunks.
    """
    return _read(spark, path, topics=topics, taskBytes=task_bytes)


def read_messages(spark: SparkSession, path: str, topics: list[str] | None = None, task_bytes: int = TASK_BYTES) -> DataFrame:
    """path, topic, message, ts_ns, payload of bags; one chunk is in a task's memory at a time."""
    return _read(spark, path, topics=topics, payload=True, taskBytes=task_bytes).drop("chunk_at", "at")


def read_range(spark: SparkSession, path: str, topic: str, first: int, stop: int, task_bytes: int = TASK_BYTES) -> DataFrame:
    """Messages [first, stop) of a topic of each bag, in order; a bag with fewer is a ContractError.

    Chunks without such a message aren't read. Times that do not increase are an error, as are index entries that don't point to their message.
    """
    if not 0 <= first <= stop:
        raise ContractError(f"[{first}, {stop}) is no range of messages")
    found = _read(spark, path, topics=[topic], payload=True, first=first, stop=stop, taskBytes=task_bytes).drop("chunk_at", "at")
    near = found.select("path", "message", "ts_ns")
    after = near.select("path", (F.col("message") - 1).alias("message"), F.col("ts_ns").alias("next_ns"))
    enforce(near.join(after, ["path", "message"]).where("next_ns <= ts_ns"), f"{topic}: times do not increase")
    return found.orderBy("path", "message")


def read_selected(spark: SparkSession, path: str, wanted: DataFrame) -> DataFrame:
    """path, topic, message, ts_ns, payload of the wanted messages (topic, message) of every bag; one that a bag lacks is a ContractError.

    The index says where messages are. References are dealt by chunk and sorted, so each chunk is read and unpacked once, and only chunks with a wanted message.
    """
    index = written(read_index(spark, path), "bag-index")
    asked = wanted.select("topic", "message").distinct()
    refs = index.join(asked, ["topic", "message"])
    bags = spark.read.format("binaryFile").load(path).select("path").count()
    held = asked.join(refs.groupBy("topic", "message").agg(F.countDistinct("path").alias("bags")), ["topic", "message"], "left")
    enforce(held.where(F.coalesce("bags", F.lit(0)) < bags), f"{path}: messages that are not there")

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        open_at, chunk, f = None, b"", None
        for frame in frames:
            bodies = []
            for r in frame.itertuples():
                if (r.path, r.chunk_at) != open_at:
                    if open_at is None or r.path != open_at[0]:
                        f = opened(r.path)
                    f.seek(r.chunk_at)
                    head, length = _head(f)
                    chunk, open_at = _unpacked(_exactly(f, length), head[b"compression"], _int(head[b"size"])), (r.path, r.chunk_at)
                bodies.append(_message(chunk, r.at, ts=r.ts_ns))
            yield frame[["path", "topic", "message", "ts_ns"]].assign(payload=bodies)

    dealt = refs.repartition("path", "chunk_at").sortWithinPartitions("path", "chunk_at", "at")
    return dealt.mapInPandas(run, "path string, topic string, message long, ts_ns long, payload binary")


def _record(fields: dict[str, bytes], data: bytes) -> bytes:
    head = b"".join(struct.pack("<I", len(k) + 1 + len(v)) + k.encode() + b"=" + v for k, v in fields.items())
    return struct.pack("<I", len(head)) + head + struct.pack("<I", len(data)) + data


def _stamp(ns: int) -> bytes:
    return struct.pack("<II", *divmod(ns, 1_000_000_000))


class _Writer:
    """All of a bag but its magic and first record, from front to back; ``close`` gives that record."""

    def __init__(self, out, compression: str, chunk_bytes: int) -> None:
        self.out, self.how, self.most = out, compression, chunk_bytes
        self.topics: dict[str, int] = {}
        self.infos: list[bytes] = []
        self.at, self.inner, self.entries = len(MAGIC) + BAG_RECORD, b"", {}

    def add(self, topic: str, ts: int, body: bytes) -> None:
        if topic not in self.topics:
            self.topics[topic] = len(self.topics)
            self.inner += self._connection(topic)
        c = self.topics[topic]
        self.entries.setdefault(c, []).append((ts, len(self.inner)))
        self.inner += _record({"op": bytes([MESSAGE]), "conn": struct.pack("<I", c), "time": _stamp(ts)}, body)
        if len(self.inner) >= self.most:
            self.flush()

    def _connection(self, topic: str) -> bytes:
        head = {"op": bytes([CONNECTION]), "conn": struct.pack("<I", self.topics[topic]), "topic": topic.encode()}
        return _record(head, b"".join(struct.pack("<I", len(x)) + x for x in (b"topic=" + topic.encode(), b"type=std_msgs/String", b"md5sum=*", b"message_definition=")))

    def flush(self) -> None:
        if not self.entries:
            return
        packed = bz2.compress(self.inner) if self.how == "bz2" else self.inner
        chunk = _record({"op": bytes([CHUNK]), "compression": self.how.encode(), "size": struct.pack("<I", len(self.inner))}, packed)
        index = b"".join(_record({"op": bytes([INDEX]), "ver": struct.pack("<I", 1), "conn": struct.pack("<I", c), "count": struct.pack("<I", len(e))}, b"".join(_stamp(t) + struct.pack("<I", p) for t, p in e)) for c, e in self.entries.items())
        times = [t for e in self.entries.values() for t, _ in e]
        counts = b"".join(struct.pack("<II", c, len(e)) for c, e in self.entries.items())
        self.infos.append(_record({"op": bytes([CHUNK_INFO]), "ver": struct.pack("<I", 1), "chunk_pos": struct.pack("<Q", self.at), "start_time": _stamp(min(times)), "end_time": _stamp(max(times)), "count": struct.pack("<I", len(self.entries))}, counts))
        self.out.write(chunk + index)
        self.at += len(chunk) + len(index)
        self.inner, self.entries = b"", {}

    def close(self) -> bytes:
        """Write the last section; returns the first record."""
        self.flush()
        self.out.write(b"".join(map(self._connection, self.topics)) + b"".join(self.infos))
        fields = {"op": bytes([BAG]), "index_pos": struct.pack("<Q", self.at), "conn_count": struct.pack("<I", len(self.topics)), "chunk_count": struct.pack("<I", len(self.infos))}
        bare = len(_record(fields, b""))
        return _record(fields, b" " * (BAG_RECORD - bare))


def write_bags(df: DataFrame, path: str, compression: str = "bz2", chunk_bytes: int = 768 << 10) -> DataFrame:
    """Bags ``{path}/{bag}.bag`` from rows (bag, topic, ts_ns, payload), messages in the order of time; returns bag, messages and bytes of each.

    A bag is a file and so one task, which holds one chunk. Chunks go to a file beside it, and the bag gets its name when its head, which says where the index is, stands
    before them: a lost or repeated task leaves no torn bag. Rows without a topic, time or payload are an error.
    """
    enforce(df.where("bag is null or topic is null or ts_ns is null or payload is null").select("bag", "topic", "ts_ns"), "rows that no bag can hold")

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        store, folder = fs.FileSystem.from_uri(path) if "://" in path else (fs.LocalFileSystem(), path.removeprefix("file:"))
        store.create_dir(folder)
        bag, writer, n, part = None, None, 0, ""

        def finish() -> pd.DataFrame:
            head = MAGIC + writer.close()
            writer.out.close()
            with store.open_input_stream(f"{part}.body") as body, store.open_output_stream(f"{part}.whole") as out:
                out.write(head)
                while block := body.read(1 << 20):
                    out.write(block)
                size = out.tell()
            store.move(f"{part}.whole", f"{folder}/{bag}.bag")
            store.delete_file(f"{part}.body")
            return pd.DataFrame([(bag, n, size)], columns=["bag", "messages", "bytes"])

        for frame in frames:
            for r in frame.itertuples(index=False):
                if r.bag != bag:
                    if writer is not None:
                        yield finish()
                    bag, n, part = r.bag, 0, f"{folder}/_{uuid.uuid4().hex}"
                    writer = _Writer(store.open_output_stream(f"{part}.body"), compression, chunk_bytes)
                writer.add(r.topic, r.ts_ns, bytes(r.payload))
                n += 1
        if writer is not None:
            yield finish()

    dealt = df.select(F.col("bag").cast("string").alias("bag"), "topic", "ts_ns", "payload").repartition("bag").sortWithinPartitions("bag", "ts_ns", "topic", "payload")
    return written(dealt.mapInPandas(run, "bag string, messages long, bytes long"), "bags-written")

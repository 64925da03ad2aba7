"""Binary record formats as Spark data sources: `lpb` (little-endian int32
length, then payload), `tfrecord` (Example protobufs in checked frames) and
`zip` (one entry a task; written only).

Tasks open files through Arrow's filesystems, by the path's scheme (local or
mounted paths, s3, gs, hdfs), and read them record by record; paths of other
schemes are read through Spark's binaryFile. Small files are packed into
tasks. A write goes to a folder of its own under `_temporary`, and the driver
moves the files of the tasks that succeeded when all have; only then do
earlier files go. gzip by file name.
"""

from __future__ import annotations

import io
import struct
import uuid
import zipfile
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.fs as pafs
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T
from pyspark.sql.datasource import DataSource, DataSourceReader, DataSourceWriter, InputPartition, WriterCommitMessage
from pyspark.sql.pandas.types import to_arrow_schema

MOST_BYTES = 1 << 30
#: Bytes of files that one task reads, and of records in one batch of rows.
TASK_BYTES, BATCH_BYTES, BATCH_ROWS = 128 << 20, 8 << 20, 1000
#: Schemes that Arrow opens itself.
SCHEMES = ("file", "s3", "gs", "gcs", "hdfs")


class BadRecord(ValueError):
    pass


def _exactly(file, n: int, at: int) -> bytes:
    got = file.read(n)
    if len(got) < n:
        raise BadRecord(f"bad record at byte {at}")
    return got


def read_frames(file) -> Iterator[bytes]:
    """Payloads of a length-prefixed file, one at a time. Length 0 ends it; a
    negative or too large length, or a cut payload, is an error."""
    at = 0
    while head := file.read(4):
        n = struct.unpack("<i", head)[0] if len(head) == 4 else -1
        if n == 0:
            return
        if n < 0 or n > MOST_BYTES:
            raise BadRecord(f"bad record at byte {at}")
        yield _exactly(file, n, at)
        at += 4 + n


def read_tf_frames(file) -> Iterator[bytes]:
    """Payloads of a file of checked frames; checksums are compared some records at a time."""
    at, held, size = 0, [], 0
    while head := file.read(12):
        if len(head) < 12 or masked_crc(head[:8]) != struct.unpack_from("<I", head, 8)[0] or struct.unpack_from("<Q", head)[0] > MOST_BYTES:
            yield from _checked(held)
            raise BadRecord(f"bad record at byte {at}")
        (n,) = struct.unpack_from("<Q", head)
        try:
            body = _exactly(file, n + 4, at)
        except BadRecord:
            yield from _checked(held)
            raise
        held.append((at, body[:n], struct.unpack_from("<I", body, n)[0]))
        at, size = at + 16 + n, size + n
        if size > BATCH_BYTES or len(held) == BATCH_ROWS:
            yield from _checked(held)
            held, size = [], 0
    yield from _checked(held)


def _checked(held: list[tuple[int, bytes, int]]) -> Iterator[bytes]:
    for (at, payload, crc), own in zip(held, masked_crcs([h[1] for h in held]), strict=True):
        if crc != own:
            raise BadRecord(f"bad record at byte {at}")
        yield payload


def frames(data: bytes, strict: bool = True) -> Iterator[bytes]:
    """read_frames of bytes; not strict: a bad record ends them."""
    return _until_bad(read_frames(io.BytesIO(data)), not strict)


def tf_frames(data: bytes, strict: bool = True) -> Iterator[bytes]:
    return _until_bad(read_tf_frames(io.BytesIO(data)), not strict)


def _until_bad(records: Iterator[bytes], skip_bad: bool) -> Iterator[bytes]:
    try:
        yield from records
    except BadRecord:
        if not skip_bad:
            raise


def framed(payload: bytes) -> bytes:
    return struct.pack("<i", len(payload)) + payload


def _crc_table() -> list[int]:
    out = []
    for n in range(256):
        for _ in range(8):
            n = n >> 1 ^ (0x82F63B78 if n & 1 else 0)
        out.append(n)
    return out


_CRC = _crc_table()
_CRC_ARRAY = np.array(_CRC, np.uint32)
#: From so many records on, their bytes are taken side by side.
SIDE_BY_SIDE = 16


def _masked(c: int) -> int:
    c ^= 0xFFFFFFFF
    return ((c >> 15 | c << 17) + 0xA282EAD8) & 0xFFFFFFFF


def masked_crc(data: bytes) -> int:
    """CRC-32C, rotated by 15 bits and shifted, as the record frames have it."""
    c = 0xFFFFFFFF
    for b in data:
        c = c >> 8 ^ _CRC[(c ^ b) & 255]
    return _masked(c)


def masked_crcs(records: list[bytes]) -> list[int]:
    """masked_crc of many records: the j-th bytes of all of them at a time, while enough are that long."""
    order = sorted(range(len(records)), key=lambda i: -len(records[i]))
    sizes = np.array([len(records[i]) for i in order], np.int64)
    data = np.frombuffer(b"".join(records[i] for i in order), np.uint8)
    first = np.cumsum(sizes) - sizes
    c = np.full(len(order), 0xFFFFFFFF, np.uint32)
    j, many = 0, np.count_nonzero(sizes > 0)
    while many >= SIDE_BY_SIDE:
        own = c[:many]
        c[:many] = own >> np.uint32(8) ^ _CRC_ARRAY[(own ^ data[first[:many] + j]) & np.uint32(255)]
        j += 1
        many = np.searchsorted(-sizes, -j, "left")
    out = [0] * len(order)
    for k, i in enumerate(order):
        v = int(c[k])
        for b in records[i][j:]:
            v = v >> 8 ^ _CRC[(v ^ b) & 255]
        out[i] = _masked(v)
    return out


def tf_frame(payload: bytes) -> bytes:
    head = struct.pack("<Q", len(payload))
    return head + struct.pack("<I", masked_crc(head)) + payload + struct.pack("<I", masked_crc(payload))


def _varint(n: int) -> bytes:
    n &= (1 << 64) - 1
    out = bytearray()
    while n > 127:
        out.append(n & 127 | 128)
        n >>= 7
    return bytes([*out, n])


def _part(field: int, body: bytes) -> bytes:
    return _varint(field << 3 | 2) + _varint(len(body)) + body


def encode_example(row: dict) -> bytes:
    """An Example of bytes, float and int64 lists; null columns are left out."""
    out = b""
    for name, value in row.items():
        if value is None:
            continue
        values = value if isinstance(value, list | tuple) else [value]
        if all(isinstance(v, bool | int) for v in values):
            feature = _part(3, _part(1, b"".join(_varint(int(v)) for v in values)))
        elif all(isinstance(v, int | float) for v in values):
            feature = _part(2, _part(1, struct.pack(f"<{len(values)}f", *values)))
        else:
            feature = _part(1, b"".join(_part(1, v if isinstance(v, bytes | bytearray) else str(v).encode()) for v in values))
        out += _part(1, _part(1, name.encode()) + _part(2, feature))
    return _part(1, out)


def _fields(data: bytes) -> Iterator[tuple[int, int, bytes | int]]:
    at = 0

    def varint() -> int:
        nonlocal at
        n = shift = 0
        while True:
            b = data[at]
            at += 1
            n |= (b & 127) << shift
            shift += 7
            if b < 128:
                return n

    while at < len(data):
        tag = varint()
        kind = tag & 7
        if kind == 0:
            yield tag >> 3, kind, varint()
        else:
            size = varint() if kind == 2 else {5: 4, 1: 8}[kind]
            yield tag >> 3, kind, data[at : at + size]
            at += size


def decode_example(data: bytes) -> dict[str, list]:
    out: dict[str, list] = {}
    for _, _, features in _fields(data):
        for _, _, entry in _fields(features):
            parts = {f: v for f, _, v in _fields(entry)}
            name, values = parts[1].decode(), []
            for f, _, body in _fields(parts.get(2, b"")):
                for _, kind, v in _fields(body):
                    if f == 1:
                        values.append(v)
                    elif f == 2:
                        values += struct.unpack(f"<{len(v) // 4}f", v)
                    elif kind == 0:
                        values.append(v - (1 << 64) if v >> 63 else v)
                    else:  # packed
                        at = 0
                        while at < len(v):
                            n = shift = 0
                            while True:
                                b = v[at]
                                at += 1
                                n |= (b & 127) << shift
                                shift += 7
                                if b < 128:
                                    break
                            values.append(n - (1 << 64) if n >> 63 else n)
            out[name] = values
    return out


def filesystem(path: str) -> tuple[pafs.FileSystem, str]:
    """Arrow's filesystem for a path, and the path in it; the same in tasks and on the driver."""
    if path.startswith("file:"):
        path = "/" + path.removeprefix("file:").lstrip("/")
    if "://" not in path:
        return pafs.LocalFileSystem(), path
    return pafs.FileSystem.from_uri(path)


def _known(path: str) -> bool:
    return "://" not in path or path.split("://", 1)[0] in SCHEMES


def listed(paths: list[str]) -> list[tuple[str, str, int]]:
    """(path as given, path in its filesystem, size) of the files under paths, hidden ones left out."""
    out = []
    for p in paths:
        fs, where = filesystem(p)
        info = fs.get_file_info(where)
        if info.type == pafs.FileType.NotFound:
            raise FileNotFoundError(p)
        found = fs.get_file_info(pafs.FileSelector(where, recursive=True)) if info.type == pafs.FileType.Directory else [info]
        for f in found:
            inner = f.path[len(where.rstrip("/")) :].split("/") if f.path != where else []
            if f.type == pafs.FileType.File and not any(x.startswith(("_", ".")) for x in inner):
                out.append((p, f.path, f.size))
    return sorted(out)


def packed(files: list[tuple[str, str, int]], task_bytes: int = TASK_BYTES) -> list[list[tuple[str, str]]]:
    """Files in order, as many a task as task_bytes holds; a larger file is a task of its own."""
    out, size = [[]], 0
    for root, path, n in files:
        if out[-1] and size + n > task_bytes:
            out.append([])
            size = 0
        out[-1].append((root, path))
        size += n
    return out


def _rows(file, path: str, read, skip_bad: bool) -> Iterator[bytes]:
    if path.endswith(".gz"):
        file = pa.CompressedInputStream(file, "gzip")
    return _until_bad(read(io.BufferedReader(_Raw(file), 1 << 20)), skip_bad)


class _Raw(io.RawIOBase):
    """An Arrow stream as a plain one."""

    def __init__(self, file):
        self.file = file

    def readable(self) -> bool:
        return True

    def readinto(self, buffer) -> int:
        got = self.file.read(len(buffer))
        buffer[: len(got)] = got
        return len(got)


def _batches(rows: Iterator, make) -> Iterator[pa.RecordBatch]:
    held, size = [], 0
    for r in rows:
        held.append(r)
        size += len(r[1])
        if size > BATCH_BYTES or len(held) == BATCH_ROWS:
            yield make(held)
            held, size = [], 0
    if held:
        yield make(held)


def _scalar(kind: T.DataType):
    return {T.StringType: lambda v: v.decode() if isinstance(v, bytes) else str(v), T.BinaryType: bytes, T.FloatType: float, T.DoubleType: float}.get(type(kind), lambda v: int(v))


def _value(values: list | None, kind: T.DataType):
    if not values:
        return [] if isinstance(kind, T.ArrayType) and values is not None else None
    cast = _scalar(kind.elementType if isinstance(kind, T.ArrayType) else kind)
    return [cast(v) for v in values] if isinstance(kind, T.ArrayType) else cast(values[0])


def _raw_batch(schema: T.StructType):
    target = to_arrow_schema(schema)
    return lambda held: pa.RecordBatch.from_arrays([pa.array([p for p, _ in held], pa.string()), pa.array([r for _, r in held], pa.binary())], schema=target)


def _example_batch(schema: T.StructType):
    """Examples as typed columns; absent features are null; scalars take the first value."""
    target = to_arrow_schema(schema)

    def make(held) -> pa.RecordBatch:
        got = [decode_example(r) for _, r in held]
        return pa.RecordBatch.from_pylist([{f.name: _value(g.get(f.name), f.dataType) for f in schema.fields} for g in got], schema=target)

    return make


class _Files(InputPartition):
    def __init__(self, files: list[tuple[str, str]]):
        self.files = files


def _flag(options: dict, name: str) -> bool:
    return str(options.get(name, "false")).lower() == "true"


class _Reader(DataSourceReader):
    """Options: path, or paths (one a line); skip_bad (a bad record ends its
    file), skip_errors (a file that can't be read is left out); mode PERMISSIVE
    sets both; task_bytes."""

    def __init__(self, options: dict, schema: T.StructType, read, batch):
        loose = options.get("mode", "FAILFAST").upper() != "FAILFAST"
        self.skip_bad, self.skip_errors = loose or _flag(options, "skip_bad"), loose or _flag(options, "skip_errors")
        self.schema, self.read_file, self.batch = schema, read, batch
        self.paths = [p for p in (options.get("paths") or options.get("path") or "").split("\n") if p]
        self.task_bytes = int(options.get("task_bytes", TASK_BYTES))

    def partitions(self):
        return [_Files(f) for f in packed(listed(self.paths), self.task_bytes)]

    def _records(self, files) -> Iterator[tuple[str, bytes]]:
        for root, path in files:
            try:
                with filesystem(root)[0].open_input_stream(path, compression=None) as file:
                    for r in _rows(file, path, self.read_file, self.skip_bad):
                        yield path, r
            except OSError:
                if not self.skip_errors:
                    raise

    def read(self, partition):
        yield from _batches(self._records(partition.files), self.batch(self.schema))


class _Written(WriterCommitMessage):
    def __init__(self, name: str):
        self.name = name


class _Writer(DataSourceWriter):
    def __init__(self, options: dict, schema: T.StructType, overwrite: bool, frame, suffix: str):
        self.folder, self.overwrite = options["path"].rstrip("/"), overwrite
        self.zipped = options.get("compression", "none") == "gzip"
        self.schema, self.frame, self.suffix = schema, frame, suffix + (".gz" if self.zipped else "")
        self.job = uuid.uuid4().hex

    def _side(self) -> tuple[pafs.FileSystem, str, str]:
        fs, folder = filesystem(self.folder)
        return fs, folder, f"{folder}/_temporary/{self.job}"

    def write(self, rows):
        fs, _, side = self._side()
        name = f"part-{uuid.uuid4().hex}{self.suffix}"
        fs.create_dir(side, recursive=True)
        with fs.open_output_stream(f"{side}/{name}", compression="gzip" if self.zipped else None) as out:
            self.fill(out, rows, name)
        return _Written(name)

    def fill(self, out, rows, name: str) -> None:
        for r in rows:
            out.write(self.frame(r, self.schema))

    def commit(self, messages):
        fs, folder, side = self._side()
        fs.create_dir(folder, recursive=True)
        before = [f.path for f in fs.get_file_info(pafs.FileSelector(folder)) if not f.path.endswith("/_temporary")] if self.overwrite else []
        for m in messages:
            if m is not None:
                fs.move(f"{side}/{m.name}", f"{folder}/{m.name}")
        for path in before:
            fs.delete_dir(path) if fs.get_file_info(path).type == pafs.FileType.Directory else fs.delete_file(path)
        if self.overwrite:  # with what late tasks of failed jobs left
            side = f"{folder}/_temporary"
        self._clean(fs, folder, side)

    def abort(self, messages):
        self._clean(*self._side())

    def _clean(self, fs, folder: str, side: str) -> None:
        if fs.get_file_info(side).type != pafs.FileType.NotFound:
            fs.delete_dir(side)  # with what failed attempts left
        top = f"{folder}/_temporary"
        if fs.get_file_info(top).type != pafs.FileType.NotFound and not fs.get_file_info(pafs.FileSelector(top)):
            fs.delete_dir(top)


class _ZipWriter(_Writer):
    def fill(self, out, rows, name: str) -> None:
        with zipfile.ZipFile(out, "w", zipfile.ZIP_DEFLATED) as z, z.open(name.removesuffix(".zip"), "w", force_zip64=True) as entry:
            for r in rows:
                entry.write(self.frame(r, self.schema))


def _lpb_frame(row, schema) -> bytes:
    return framed(bytes(row[len(schema.fields) - 1]))


def _example_frame(row, schema) -> bytes:
    return tf_frame(encode_example(dict(zip([f.name for f in schema.fields], row, strict=True))))


def _first_bytes(row, schema) -> bytes:
    return bytes(row[0]) if isinstance(row[0], bytes | bytearray) else str(row[0]).encode()


class LengthPrefixed(DataSource):
    @classmethod
    def name(cls):
        return "lpb"

    def schema(self):
        return "path string, record binary"

    def reader(self, schema):
        return _Reader(self.options, schema, read_frames, _raw_batch)

    def writer(self, schema, overwrite):
        return _Writer(self.options, schema, overwrite, _lpb_frame, ".pb")


class Examples(DataSource):
    """Reading needs a schema: .schema(...) names the features to take."""

    @classmethod
    def name(cls):
        return "tfrecord"

    def schema(self):
        raise ValueError("tfrecord files have no schema of their own: give one with .schema(...)")

    def reader(self, schema):
        return _Reader(self.options, schema, read_tf_frames, _example_batch)

    def writer(self, schema, overwrite):
        return _Writer(self.options, schema, overwrite, _example_frame, ".tfrecord")


class Zipped(DataSource):
    @classmethod
    def name(cls):
        return "zip"

    def writer(self, schema, overwrite):
        return _ZipWriter(self.options, schema, overwrite, _first_bytes, ".zip")


def register(spark: SparkSession) -> None:
    for source in (LengthPrefixed, Examples, Zipped):
        spark.dataSource.register(source)


def _read(spark: SparkSession, paths: list[str], kind: str, schema: T.StructType, strict: bool, read, batch) -> DataFrame:
    register(spark)
    if all(_known(p) for p in paths):
        return spark.read.format(kind).schema(schema).option("paths", "\n".join(paths)).option("mode", "FAILFAST" if strict else "PERMISSIVE").load()
    files = spark.read.format("binaryFile").load(paths).where("length > 0").select("path", "content")

    def run(batches):
        for b in batches:
            for i in range(b.num_rows):
                path, content = b.column("path")[i].as_py(), b.column("content")[i].as_buffer()
                yield from _batches(((path, r) for r in _rows(pa.BufferReader(content), path, read, not strict)), batch(schema))

    return files.mapInArrow(run, schema)


def read_lpb(spark: SparkSession, paths: list[str], strict: bool = True) -> DataFrame:
    """(path, record) of length-prefixed files. Not strict: a bad record ends its file, unreadable files are left out."""
    return _read(spark, paths, "lpb", T._parse_datatype_string("path string, record binary"), strict, read_frames, _raw_batch)


def read_tfrecord(spark: SparkSession, paths: list[str], schema: str | T.StructType, strict: bool = True) -> DataFrame:
    """Examples as typed columns."""
    schema = T._parse_datatype_string(schema) if isinstance(schema, str) else schema
    return _read(spark, paths, "tfrecord", schema, strict, read_tf_frames, _example_batch)


def write_records(df: DataFrame, path: str, kind: str, mode: str = "overwrite", compression: str = "none") -> None:
    """lpb: the last column's bytes; tfrecord: all columns; zip: the first
    column's bytes, one entry a task. mode `ignore` leaves a folder that has files."""
    register(df.sparkSession)
    if mode == "ignore":
        fs, where = filesystem(path)
        if fs.get_file_info(where).type != pafs.FileType.NotFound and listed([path]):
            return
        mode = "append"
    df.write.format(kind).mode(mode).option("compression", compression).save(path)

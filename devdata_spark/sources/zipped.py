"""The data source `zip_members`: members of zip archives, each read by its byte range.

Planning reads the end of each archive, its central directory, and nothing of its members.
Members are dealt out to tasks by their size; a task seeks to each of its members, inflates
it as a stream and checks its sum. Archives and members may be of any size (zip64), and an
archive with many members is read by many tasks. A compressed stream can only be read from
its start, so one member is read by one task: land a very large one extracted.

This module is sent to the executors with the job (see `archives`), so it uses nothing of
this package.
"""

import csv as rows_of
import fnmatch
import io
import json
import struct
import zipfile
import zlib
from collections.abc import Iterator
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass

import pyarrow as pa
from pyarrow import csv, fs
from pyspark.sql.datasource import DataSource, DataSourceReader, InputPartition

# Members of up to so many compressed bytes together are read by one task.
TASK_BYTES = 16 << 20
PIECE = 1 << 20
ROWS = 10_000
# Archives whose directories are read at the same time.
THREADS = 16
LOCAL_HEADER = 30
STORED, DEFLATED = 0, 8
# Names that Spark has for stores that Arrow calls otherwise.
SCHEMES = {"s3a": "s3", "s3n": "s3"}


@dataclass(frozen=True)
class Member:
    """Where a member lies in its archive; `name` is None for an archive without members."""

    archive: str
    name: str | None
    start: int = 0
    packed: int = 0
    size: int = 0
    crc: int = 0
    deflated: bool = False


class Members(InputPartition):
    def __init__(self, members: list[Member]):
        self.members = members


def file_system(path: str) -> tuple[fs.FileSystem, str]:
    """The store of a path or URI, and the path in it."""
    scheme, colon, rest = path.partition(":")
    if not colon or "/" in scheme:
        return fs.LocalFileSystem(), path
    if scheme == "file":
        return fs.LocalFileSystem(), "/" + rest.lstrip("/")
    return fs.FileSystem.from_uri(f"{SCHEMES.get(scheme, scheme)}:{rest}")


class File(io.RawIOBase):
    """A file of any store for reading, as Python's own files behave."""

    def __init__(self, path: str):
        store, inside = file_system(path)
        self.file = store.open_input_file(inside)

    def readable(self) -> bool:
        return True

    def seekable(self) -> bool:
        return True

    def tell(self) -> int:
        return self.file.tell()

    def seek(self, offset: int, whence: int = io.SEEK_SET) -> int:
        at = offset + (0, self.file.tell(), self.file.size())[whence]
        if at < 0:
            raise OSError(f"No place {at} in a file")
        self.file.seek(at)
        return at

    def readinto(self, buffer) -> int:
        return self.file.readinto(buffer)

    def close(self) -> None:
        self.file.close()
        super().close()


def archives_at(path: str, pattern: str) -> list[str]:
    """An archive, or those of a folder whose name fits the pattern."""
    store, inside = file_system(path)
    found = store.get_file_info(inside)
    if found.type == fs.FileType.File:
        return [path]
    if found.type == fs.FileType.NotFound:
        raise FileNotFoundError(path)
    listed = store.get_file_info(fs.FileSelector(inside))
    names = [f.base_name for f in listed if f.type == fs.FileType.File]
    return [f"{path.rstrip('/')}/{n}" for n in sorted(names) if fnmatch.fnmatch(n, pattern)]


def directory(archive: str, prefix: str, suffix: str, opened: File | None = None) -> list[Member]:
    """The members of an archive whose name starts and ends as given, from its end alone.

    An archive without any member at all gives one of no name.
    """
    opened = File(archive) if opened is None else opened
    with opened, zipfile.ZipFile(opened) as z:
        infos = [i for i in z.infolist() if not i.is_dir()]
    if not infos:
        return [Member(archive, None)]
    found = []
    for i in infos:
        if not (i.filename.startswith(prefix) and i.filename.endswith(suffix)):
            continue
        if i.flag_bits & 1 or i.compress_type not in (STORED, DEFLATED):
            raise ValueError(f"Unsupported zip member {i.filename} in {archive}")
        deflated = i.compress_type == DEFLATED
        found.append(
            Member(archive, i.filename, i.header_offset, i.compress_size, i.file_size, i.CRC, deflated)
        )
    return found


class Stream(io.RawIOBase):
    """The bytes of a member, inflated piece by piece; a wrong sum is an error at the end."""

    def __init__(self, member: Member, opened: File):
        self.member, self.file = member, opened
        self.file.seek(member.start)
        header = self.file.read(LOCAL_HEADER)
        if header[:4] != b"PK\x03\x04":
            raise ValueError(f"No member {member.name} where {member.archive} says it is")
        name_size, extra_size = struct.unpack("<HH", header[26:30])
        self.file.seek(member.start + LOCAL_HEADER + name_size + extra_size)
        self.left, self.crc, self.size = member.packed, 0, 0
        self.inflater = zlib.decompressobj(-zlib.MAX_WBITS) if member.deflated else None

    def readable(self) -> bool:
        return True

    def _packed(self, most: int) -> bytes:
        piece = self.file.read(min(most, self.left))
        self.left -= len(piece)
        return piece

    def readinto(self, buffer) -> int:
        data = b""
        while not data:
            if self.inflater is None:
                data = self._packed(len(buffer))
                ended = not data
            else:
                packed = self.inflater.unconsumed_tail or self._packed(PIECE)
                data = self.inflater.decompress(packed, len(buffer))
                ended = not packed and not data
            if ended:
                if (self.crc, self.size) != (self.member.crc, self.member.size):
                    raise ValueError(f"{self.member.name} in {self.member.archive} is damaged")
                return 0
        self.crc, self.size = zlib.crc32(data, self.crc), self.size + len(data)
        buffer[: len(data)] = data
        return len(data)

    def close(self) -> None:
        self.file.close()
        super().close()


def csv_batches(
    member: Member, columns: list[str], may_lack: list[str], encoding: str
) -> Iterator[pa.RecordBatch]:
    """Text columns of a CSV member. A header without one of them is an error, unless it may lack."""
    read = csv.ReadOptions(encoding=encoding)
    split = csv.ParseOptions(newlines_in_values=True)
    convert = csv.ConvertOptions(
        column_types={c: pa.string() for c in columns},
        include_columns=columns,
        include_missing_columns=True,
        strings_can_be_null=False,
    )
    stream = io.BufferedReader(Stream(member, File(member.archive)), PIECE)
    start = stream.peek().decode(encoding, "ignore").removeprefix("\ufeff")
    header = next(rows_of.reader(io.StringIO(start, newline="")), [])
    missing = [c for c in columns if c not in header and c not in may_lack]
    if missing:
        raise ValueError(
            f"{member.name} in {member.archive} lacks columns {missing}; its header is {header}"
        )
    for found in csv.open_csv(stream, read, split, convert):
        for at in range(0, found.num_rows, ROWS):
            part = found.slice(at, ROWS)
            yield batch(
                [member] * part.num_rows, [part.column(c).cast(pa.string()) for c in columns], columns
            )


def batch(members: list[Member], columns: list[pa.Array], names: list[str]) -> pa.RecordBatch:
    """`archive` and `member` of each row, then the columns."""
    own = [pa.array([m.archive for m in members], pa.string()),
           pa.array([m.name for m in members], pa.string())]
    return pa.RecordBatch.from_arrays([*own, *columns], names=["archive", "member", *names])


class ZipMembers(DataSource):
    """Options: `paths` (a JSON list), `pattern`, `prefix`, `suffix` and `as`.

    as=list: `archive`, `member`, `packed_size`, `size`, without reading members; an archive
    without members has one row of NULL member. as=text: `archive`, `member`, `text`.
    as=csv: `archive`, `member` and the text `columns` (a JSON list, as is `optional`).
    """

    @classmethod
    def name(cls) -> str:
        return "zip_members"

    def schema(self) -> str:
        more = {
            "list": ["packed_size LONG", "size LONG"],
            "text": ["text STRING"],
            "csv": [f"`{c}` STRING" for c in json.loads(self.options.get("columns", "[]"))],
        }[self.options["as"]]
        return ", ".join(["archive STRING", "member STRING", *more])

    def reader(self, schema) -> "ZipReader":
        return ZipReader(dict(self.options))


class ZipReader(DataSourceReader):
    def __init__(self, options: dict):
        self.options = options

    def partitions(self) -> list[Members]:
        """Members in the order of their archives, dealt out by their compressed bytes."""
        pattern = self.options.get("pattern", "*.zip")
        paths = json.loads(self.options["paths"])
        names = [a for p in paths for a in archives_at(p, pattern)]
        ends = self.options.get("prefix", ""), self.options.get("suffix", "")
        with ThreadPoolExecutor(THREADS) as pool:
            listed = pool.map(lambda archive: directory(archive, *ends), names)
            members = [m for found in listed for m in found]
        if self.options["as"] != "list":
            members = [m for m in members if m.name is not None]
        dealt, size = [], 0
        for member in members:
            if not dealt or size + member.packed > TASK_BYTES or len(dealt[-1]) >= ROWS:
                dealt.append([])
                size = 0
            dealt[-1].append(member)
            size += member.packed
        return [Members(m) for m in dealt] or [Members([])]

    def read(self, partition: Members) -> Iterator[pa.RecordBatch]:
        kind, members = self.options["as"], partition.members
        encoding = self.options.get("encoding", "utf-8")
        if kind == "list":
            sizes = [pa.array([m.packed for m in members], pa.int64()),
                     pa.array([m.size for m in members], pa.int64())]
            yield batch(members, sizes, ["packed_size", "size"])
        elif kind == "text":
            for m in members:
                with io.BufferedReader(Stream(m, File(m.archive)), PIECE) as stream:
                    text = stream.read().decode(encoding)
                yield batch([m], [pa.array([text], pa.string())], ["text"])
        else:
            columns = json.loads(self.options["columns"])
            for m in members:
                yield from csv_batches(m, columns, json.loads(self.options["optional"]), encoding)

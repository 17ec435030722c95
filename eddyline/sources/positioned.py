"""Lines of files as a stream in which every line knows its position.

Spark's own text stream neither numbers lines nor keeps their order. This source reads the files
of a folder by ranges of bytes: a line's position is the number of its file, in the order of
their names, and its first byte there. Positions therefore sort as the lines do, whatever task
read them and however often. Later files have later names, as rotated logs do; the stream fails
on one that would change the numbers.

A stream remembers how far it has read each file. Files may grow; a last line without a line
feed waits for the rest of it, unless `complete` says that files come whole. Lines are cut at
line feeds, and a carriage return before one belongs to the cut.
"""

from __future__ import annotations

import sys
from collections.abc import Iterator
from dataclasses import dataclass

from pyspark import cloudpickle
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.datasource import DataSource, DataSourceStreamReader, InputPartition

#: Bits of a position that a byte of a file takes: files of up to a terabyte.
FILE_BITS = 40

_BLOCK = 1 << 16


@dataclass
class Range(InputPartition):
    """Lines that start in a range of bytes of a file; the range starts at a line or within one."""

    path: str
    number: int
    start: int
    end: int
    limit: int


def _filesystem(folder: str):
    from pyarrow import fs

    return fs.FileSystem.from_uri(folder if "://" in folder else f"file://{folder}")


def last_line_end(file, size: int) -> int:
    """The byte after the last line feed."""
    end = size
    while end > 0:
        start = max(0, end - _BLOCK)
        file.seek(start)
        found = file.read(end - start).rfind(b"\n")
        if found >= 0:
            return start + found + 1
        end = start
    return 0


def lines_from(file, part: Range) -> Iterator[tuple[int, bytes]]:
    """Position in the file and text of the lines that start in the range.

    The byte before the range tells whether a line starts with it.
    """
    place = part.start
    file.seek(max(0, place - 1))
    rest = b""
    skipping = place > 0
    if skipping:
        skipping = file.read(1) != b"\n"
    while place < part.end or rest:
        block = file.read(min(_BLOCK, part.limit - place - len(rest)))
        whole = rest + block
        if skipping:
            cut = whole.find(b"\n")
            if cut < 0:
                place += len(whole)
                rest = b""
                if not block:
                    return
                continue
            place, whole, skipping = place + cut + 1, whole[cut + 1:], False
        pieces = whole.split(b"\n")
        rest = pieces.pop()
        for piece in pieces:
            if place >= part.end:
                return
            yield place, piece.removesuffix(b"\r")
            place += len(piece) + 1
        if place >= part.end:
            return
        if not block:
            if rest:
                yield place, rest.removesuffix(b"\r")
            return


class _Reader(DataSourceStreamReader):
    def __init__(self, folder: str, complete: bool, range_bytes: int):
        self.folder = folder
        self.complete = complete
        self.range_bytes = range_bytes

    def initialOffset(self) -> dict:
        return {}

    def latestOffset(self) -> dict:
        """File -> its number and the bytes that can be read."""
        from pyarrow import fs

        files, root = _filesystem(self.folder)
        found = [
            entry for entry in files.get_file_info(fs.FileSelector(root, allow_not_found=True))
            if entry.type == fs.FileType.File and not entry.base_name.startswith(("_", "."))
        ]
        offset = {}
        for number, entry in enumerate(sorted(found, key=lambda entry: entry.base_name)):
            with files.open_input_file(entry.path) as file:
                end = entry.size if self.complete else last_line_end(file, entry.size)
            offset[entry.base_name] = {"number": number, "bytes": end}
        return offset

    def partitions(self, start: dict, end: dict) -> list[Range]:
        ranges = []
        for name, state in sorted(end.items(), key=lambda entry: entry[1]["number"]):
            before = start.get(name, {"number": state["number"], "bytes": 0})
            if before["number"] != state["number"]:
                raise ValueError(f"a file came whose name sorts before {name!r}, which has been read")
            for at in range(before["bytes"], state["bytes"], self.range_bytes):
                until = min(at + self.range_bytes, state["bytes"])
                ranges.append(Range(name, state["number"], at, until, state["bytes"]))
        return ranges

    def read(self, partition: Range) -> Iterator[tuple]:
        files, root = _filesystem(self.folder)
        with files.open_input_file(f"{root}/{partition.path}") as file:
            for place, line in lines_from(file, partition):
                yield line.decode("utf-8", "replace"), partition.path, partition.number << FILE_BITS | place

    def commit(self, end: dict) -> None:
        pass


class PositionedLines(DataSource):
    @classmethod
    def name(cls) -> str:
        return "positioned_lines"

    def schema(self) -> str:
        return "value string, file string, position long"

    def streamReader(self, schema) -> DataSourceStreamReader:
        return _Reader(
            self.options["path"], self.options.get("complete", "false") == "true",
            int(self.options.get("rangebytes", 16 << 20)),
        )


def stream_positioned_lines(
    spark: SparkSession, folder: str, complete: bool = False, range_bytes: int = 16 << 20,
) -> DataFrame:
    """The lines of a folder's files as a stream of value, file and position."""
    spark.dataSource.register(PositionedLines)
    reader = spark.readStream.format("positioned_lines").option("complete", str(complete).lower())
    return reader.option("rangebytes", str(range_bytes)).load(folder)


# Workers need not have this package installed.
cloudpickle.register_pickle_by_value(sys.modules[__name__])

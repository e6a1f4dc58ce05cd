"""A streaming source over append-only message files, with offsets of its own (format ``message_log``).

A topic is a folder. Its sub-folders are *shards* (files right in the topic are the shard ``""``); a shard's
files are *segments*, read in the order of their names. Only the last segment of a shard grows; a new one may
begin at any time under a later name. A message is a line and complete with its line end, so half a line at the
end of the growing segment waits for its rest; at the end of an earlier segment it is a message.

An offset is one ``[segment, byte]`` per shard, whatever the number of files. A batch admits about
``maxMessages`` messages, shared out evenly over the shards that have any (0: all there are); the
driver counts the line ends of that many messages, or looks at each shard's last block only. Segments are read in ranges of
``splitBytes``: a line belongs to the range in which it starts.

Spark gives a Python source no start offset when it asks for the next end, so ``positions`` names a file that holds
the last end given out, written before Spark learns it. After a restart the next batch starts where Spark's own checkpoint
says and ends after that point: at most one admission longer, nothing lost and nothing twice. One such file per query;
without it, everything available is one batch.

Rows: ``shard``, ``segment``, ``position`` (byte at which the line starts) and ``value`` (the line's bytes, without line end).
Empty lines are messages. Names that start with ``_`` or ``.`` are left out.
"""

from __future__ import annotations

import json
import sys

import pyarrow as pa
from pyarrow import fs as pafs
from pyspark import cloudpickle
from pyspark.sql import SparkSession
from pyspark.sql.datasource import DataSource, DataSourceStreamReader, InputPartition

NAME = "message_log"
SCHEMA = "shard string, segment string, position bigint, value binary"
BLOCK = 1 << 22
#: Lines and bytes of a record batch, whichever is reached first.
BATCH_ROWS, BATCH_BYTES = 10_000, BLOCK
#: Before every segment's name.
START = ["", 0]


def filesystem(path: str) -> tuple[pafs.FileSystem, str]:
    """The file system of a path or URI, as the driver and every task open it."""
    if "://" in path:
        return pafs.FileSystem.from_uri(path)
    return pafs.LocalFileSystem(), path[len("file:"):] if path.startswith("file:") else path


class Range(InputPartition):
    """The lines of a segment that start at bytes ``start`` to ``end`` - 1; ``start`` may lie inside a line."""

    def __init__(self, shard: str, segment: str, start: int, end: int, aligned: bool):
        self.shard, self.segment, self.start, self.end, self.aligned = shard, segment, start, end, aligned


def after_lines(source, start: int, end: int, lines: int) -> tuple[int, int]:
    """(position after the next ``lines`` whole lines, or after the last one before ``end``; lines passed)."""
    at, passed, found = start, start, 0
    source.seek(start)
    while at < end and found < lines:
        block = source.read(min(BLOCK, end - at))
        if not block:
            break
        n = block.count(b"\n")
        if found + n <= lines:
            found += n
            if n:
                passed = at + block.rfind(b"\n") + 1
        else:
            cut = -1
            for _ in range(lines - found):
                cut = block.find(b"\n", cut + 1)
            found, passed = lines, at + cut + 1
        at += len(block)
    return passed, found


def last_line_end(source, start: int, end: int) -> int:
    """Position after the last line end in bytes ``start`` to ``end`` - 1, looked for from the end; else ``start``."""
    while end > start:
        at = max(start, end - BLOCK)
        source.seek(at)
        cut = source.read(end - at).rfind(b"\n")
        if cut >= 0:
            return at + cut + 1
        end = at
    return start


def lines_from(source, start: int, end: int, aligned: bool):
    """(position, line) of the lines that start in the range. A last line without its end counts: it is never read before it is complete."""
    if not aligned:
        # The line that runs over ``start`` belongs to the range before.
        source.seek(start - 1)
        at = start - 1
        while True:
            block = source.read(BLOCK)
            cut = block.find(b"\n")
            if cut >= 0 or not block:
                break
            at += len(block)
        if not block:
            return
        start = at + cut + 1
    source.seek(start)
    at, parts = start, []
    while at < end:
        block = source.read(BLOCK)
        if not block:
            if parts:
                yield at, b"".join(parts)
            return
        first, *rest = block.split(b"\n")
        parts.append(first)
        for piece in rest:
            line = b"".join(parts)
            yield at, line
            at += len(line) + 1
            if at >= end:
                return
            parts = [piece]
        if len(parts) == 1 and not parts[0]:
            parts = []


class MessageLogReader(DataSourceStreamReader):
    def __init__(self, options):
        self.path = options["path"]
        self.most = int(options.get("maxMessages", "0"))
        self.split = int(options.get("splitBytes", str(64 << 20)))
        self.positions = options.get("positions")
        if self.most and not self.positions:
            raise ValueError("maxMessages needs a file for the last position (option positions)")
        self.end = self._restored()

    def initialOffset(self) -> dict:
        return {}

    def _restored(self) -> dict:
        if not self.positions:
            return {}
        system, path = filesystem(self.positions)
        if system.get_file_info(path).type == pafs.FileType.NotFound:
            return {}
        with system.open_input_stream(path) as f:
            return json.loads(f.read())

    def _segments(self) -> dict[str, list[tuple[str, int]]]:
        """Per shard its (segment, bytes) in order."""
        system, root = filesystem(self.path)
        found = system.get_file_info(pafs.FileSelector(root, recursive=True, allow_not_found=True))
        shards: dict[str, list] = {}
        base = root.rstrip("/") + "/"
        for f in found:
            name = f.path[f.path.index(base) + len(base):] if base in f.path else f.path
            if f.is_file and not any(part[:1] in "._" for part in name.split("/")):
                shard, _, segment = name.rpartition("/")
                shards.setdefault(shard, []).append((segment, f.size))
        return {shard: sorted(files) for shard, files in sorted(shards.items())}

    def _open(self, shard: str, segment: str):
        system, root = filesystem(self.path)
        return system.open_input_file("/".join(x for x in (root.rstrip("/"), shard, segment) if x))

    def _advance(self, shard: str, files: list, start: list, lines: int | None) -> tuple[list, int]:
        """(offset, lines passed) at most ``lines`` messages after ``start``; None: as far as lines are complete."""
        at, passed = start, 0
        for i, (segment, size) in enumerate(files):
            if segment < at[0]:
                continue
            begin = at[1] if segment == at[0] else 0
            growing = i == len(files) - 1
            if begin >= size:
                at = [segment, begin]
                continue
            if lines is None and not growing:
                at = [segment, size]
                continue
            with self._open(shard, segment) as source:
                if lines is None:
                    at = [segment, last_line_end(source, begin, size)]
                    break
                end, n = after_lines(source, begin, size, lines - passed)
            passed += n
            if not growing and end < size and passed < lines:
                # The rest of an ended segment, a message without line end.
                end, passed = size, passed + 1
            at = [segment, end]
            if passed >= lines:
                break
        return at, passed

    def latestOffset(self) -> dict:
        shards = self._segments()
        now = {shard: self.end.get(shard, START) for shard in shards}
        if not self.most:
            now = {shard: self._advance(shard, files, now[shard], None)[0] for shard, files in shards.items()}
        else:
            # What a shard leaves of its part goes to the ones that have more.
            left, open_shards = self.most, list(shards)
            while left and open_shards:
                part, still = -(-left // len(open_shards)), []
                for shard in open_shards:
                    want = min(part, left)
                    if not want:
                        break
                    now[shard], n = self._advance(shard, shards[shard], now[shard], want)
                    left -= n
                    if n == want:
                        still.append(shard)
                open_shards = still
        end = {**self.end, **{shard: at for shard, at in now.items() if at != START}}
        if end != self.end:
            self._keep(end)
            self.end = end
        return end

    def _keep(self, end: dict) -> None:
        if self.positions:
            system, path = filesystem(self.positions)
            with system.open_output_stream(path + ".next") as f:
                f.write(json.dumps(end).encode())
            system.move(path + ".next", path)

    def partitions(self, start: dict, end: dict):
        out = []
        segments = self._segments()
        for shard, (last, upto) in end.items():
            first, begin = start.get(shard, START)
            if [last, upto] < [first, begin]:
                raise ValueError(f"shard {shard!r} of {self.path} goes back from {first}:{begin} to {last}:{upto}; "
                                 "is its file of positions another query's or lost?")
            for segment, size in segments.get(shard, []):
                if first <= segment <= last:
                    low = begin if segment == first else 0
                    high = upto if segment == last else size
                    out += [Range(shard, segment, at, min(at + self.split, high), at == low)
                            for at in range(low, high, self.split)]
            names = {segment for segment, _ in segments.get(shard, [])}
            if upto and last not in names:
                raise FileNotFoundError(f"segment {last} of shard {shard!r} in {self.path} is gone before it was read")
        return out

    def read(self, partition):
        p = partition
        with self._open(p.shard, p.segment) as source:
            at, lines, size = [], [], 0
            for position, line in lines_from(source, p.start, p.end, p.aligned):
                at.append(position)
                lines.append(line)
                size += len(line)
                if len(lines) >= BATCH_ROWS or size >= BATCH_BYTES:
                    yield self._batch(p, at, lines)
                    at, lines, size = [], [], 0
            if lines:
                yield self._batch(p, at, lines)

    @staticmethod
    def _batch(p, at, lines):
        return pa.record_batch([pa.array([p.shard] * len(at)), pa.array([p.segment] * len(at)),
                                pa.array(at, pa.int64()), pa.array(lines, pa.binary())],
                               names=["shard", "segment", "position", "value"])


class MessageLog(DataSource):
    @classmethod
    def name(cls):
        return NAME

    def schema(self):
        return SCHEMA

    def streamReader(self, schema):
        return MessageLogReader(self.options)


def register(spark: SparkSession) -> None:
    """Make the format known; it travels by value, as the driver's planning process does not see shipped files."""
    cloudpickle.register_pickle_by_value(sys.modules[__name__])
    spark.dataSource.register(MessageLog)

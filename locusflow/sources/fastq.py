"""Paired FASTQ, FASTA and wiggle readers as Spark data sources.

Plain files are split by byte ranges, so one large file gives many tasks. What a range must know of the bytes before it
(lines, bases or steps so far) comes from a first pass that Spark runs over the same ranges; only a few numbers per range
reach the driver. Every task streams its range and never holds it whole. Compressed files are one task each. Any storage
known to Arrow (local, HDFS, S3, GCS) works; compression follows the file name.
"""

from __future__ import annotations

import fnmatch
import io
import json
import math
import posixpath
import re
from bisect import bisect_right

from pyspark.sql import DataFrame, SparkSession, functions as F
from pyspark.sql.datasource import DataSource, DataSourceReader, InputPartition

# Fixed pattern of read file names: <sample>_TAG<tag>_R<mate>_<lane>.fastq[.gz]
FILE_NAME = r"^(?P<sample>.+?)(?:_(?P<tag>TAG[0-9]+))?_R(?P<mate>[12])_(?P<lane>[0-9]+)\.f(?:ast)?q(?:\.gz)?$"
BATCH = 4096
SPLIT = 128 << 20  # bytes of a range, about
PACKED = (".gz", ".bz2", ".zst", ".lz4", ".br")


def _filesystem(path: str):
    from pyarrow import fs
    if "://" in path or path.startswith("file:"):
        return fs.FileSystem.from_uri(path)
    return fs.LocalFileSystem(), path


def list_files(pattern: str) -> list[str]:
    """Files matching a glob in their last path part, sorted."""
    from pyarrow import fs
    system, path = _filesystem(posixpath.dirname(pattern) or ".")
    infos = system.get_file_info(fs.FileSelector(path))
    prefix = pattern[: len(pattern) - len(posixpath.basename(pattern))]
    return sorted(prefix + i.base_name for i in infos
                  if i.is_file and fnmatch.fnmatch(i.base_name, posixpath.basename(pattern)))


class Lines:
    """Lines of a file from the first one that starts at or after byte ``low``; ``at`` is where the next one starts.

    ``passed`` tells whether the line that ``low`` lies in was left out.
    """

    def __init__(self, path: str, low: int = 0):
        system, inner = _filesystem(path)
        if path.endswith(PACKED):
            self.file = io.BufferedReader(system.open_input_stream(inner, compression="detect"), 1 << 20)
        else:
            file = system.open_input_file(inner)
            file.seek(max(low - 1, 0))
            self.file = io.BufferedReader(file, 1 << 20)
        self.at = max(low - 1, 0)
        self.passed = bool(low) and self.next() != b"\n"

    def next(self, most: int = -1) -> bytes:
        line = self.file.readline(most)
        self.at += len(line)
        return line

    def skip(self, lines: int) -> None:
        for _ in range(lines):
            self.next()

    def __enter__(self):
        return self

    def __exit__(self, *_):
        self.file.close()


def split_files(files: list[str], split: int) -> list[tuple[str, int, int | None]]:
    """Byte ranges ``(path, low, high)`` of all files; ``high`` is null for the last range of a file."""
    out = []
    for path in files:
        size = 0
        if not path.endswith(PACKED):
            system, inner = _filesystem(path)
            size = system.get_file_info(inner).size
        edges = list(range(0, max(size, 1), split))
        out += [(path, low, high) for low, high in zip(edges, [*edges[1:], None], strict=True)]
    return out


# ---- first pass --------------------------------------------------------------------------------


def _count_lines(path: str, low: int, high: int | None) -> dict:
    """Line ends of a range."""
    system, inner = _filesystem(path)
    n, left = 0, math.inf if high is None else high - low
    with system.open_input_file(inner) as file:
        file.seek(low)
        while left and (block := file.read(int(min(left, 1 << 20)))):
            n, left = n + block.count(b"\n"), left - len(block)
    return {"n": n}


def _bases(fragment: bytes) -> bytes:
    return fragment.translate(None, b" \t\r\n")


def _count_bases(path: str, low: int, high: int | None) -> dict:
    """Bases of a range up to its first line (``before``, unless a header runs on there) and after its last header."""
    before, n, name, new, header = 0, 0, None, low == 0, False
    with Lines(path) as lines:
        lines.file.seek(max(low - 1, 0))
        new = low == 0 or lines.file.read(1) == b"\n"
        lines.at, begun = low, new
        while high is None or lines.at < high:
            piece = lines.next(1 << 16 if high is None else min(1 << 16, high - lines.at))
            if not piece:
                break
            if new:
                header = piece.startswith(b">")
                if header:
                    rest = piece if piece.endswith(b"\n") else piece + lines.file.readline(1 << 16)
                    name, n = (rest[1:].split() or [b""])[0].decode(), 0
                    lines.file.seek(lines.at)
            if not header:
                before, n = (before, n + len(_bases(piece))) if begun else (before + len(_bases(piece)), n)
            new = piece.endswith(b"\n")
            begun, header = begun or new, header and not new
    return {"before": before, "begun": begun, "name": name, "n": n, "header": header}


def _count_steps(path: str, low: int, high: int | None) -> dict:
    """Last declaration of a range and the values after it."""
    name, n = None, 0
    with Lines(path, low) as lines:
        while high is None or lines.at < high:
            line = lines.next()
            if not line:
                break
            kind = _wig_kind(line)
            if kind == "step":
                name, n = line.decode().strip(), 0
            elif kind == "value":
                n += 1
    return {"name": name, "n": n}


_COUNTS = {"lines": _count_lines, "bases": _count_bases, "steps": _count_steps}


class _Range(InputPartition):
    def __init__(self, number: int, path: str, low: int, high: int | None, state: dict):
        self.number, self.path, self.low, self.high, self.state = number, path, low, high, state


class _Ranged(DataSourceReader):
    """A reader over ranges that the driver has given as JSON."""

    def __init__(self, options):
        self.options = options

    def partitions(self):
        return [_Range(i, *r) for i, r in enumerate(json.loads(self.options["ranges"]))]


class _CountReader(_Ranged):
    def read(self, partition):
        yield partition.number, json.dumps(_COUNTS[self.options["count"]](partition.path, partition.low, partition.high))


class RangeCounts(DataSource):
    @classmethod
    def name(cls):
        return "range_counts"

    def schema(self):
        return "number int, counts string"

    def reader(self, schema):
        return _CountReader(self.options)


def _counted(spark: SparkSession, ranges: list, count: str) -> list[dict]:
    """Counts of all ranges, taken by tasks; nothing is run when no file has more than one range."""
    if all(low == 0 for _, low, _ in ranges):
        return [{}] * len(ranges)
    spark.dataSource.register(RangeCounts)
    rows = spark.read.format("range_counts").option("count", count).option("ranges", json.dumps([(*r, {}) for r in ranges])).load().collect()
    return [json.loads(c) for _, c in sorted(map(tuple, rows))]


# ---- read pairs --------------------------------------------------------------------------------


class _PairReader(_Ranged):
    def read(self, partition):
        import pyarrow as pa
        name = re.match(FILE_NAME, posixpath.basename(partition.path))
        sample = name["sample"] if name else posixpath.basename(partition.path)
        tag, lane = (name["tag"], name["lane"]) if name else (None, None)
        columns = ("sample", "tag", "lane", "read_id", "r1_seq", "r1_qual", "r2_seq", "r2_qual")
        state, rows, high = partition.state, [], partition.high
        second = state["second"]
        with Lines(partition.path, partition.low) as one, Lines(second, state["low"]) as two:
            line = state["lines"] + one.passed
            one.skip(-line % 4)
            line += -line % 4  # the first record that starts in the range
            two.skip(line - state["second_lines"] - two.passed)
            while high is None or one.at < high:
                read = _record(one)
                if read is None:
                    break
                mate = _record(two)
                if mate is None or mate[0].removesuffix("/2") != read[0].removesuffix("/1"):
                    raise ValueError(f"mate of {read[0]} missing in {second}")
                rows.append((sample, tag, lane, read[0].removesuffix("/1"), *read[1:], *mate[1:]))
                if len(rows) == BATCH:
                    yield pa.RecordBatch.from_arrays([pa.array(c, pa.string()) for c in zip(*rows)], columns)
                    rows = []
            if high is None and two.next():
                raise ValueError(f"{second} holds more reads than {partition.path}")
        if rows:
            yield pa.RecordBatch.from_arrays([pa.array(c, pa.string()) for c in zip(*rows)], columns)


def _record(lines: Lines) -> tuple[str, str, str] | None:
    head = lines.next()
    if not head:
        return None
    seq, _, qual = lines.next(), lines.next(), lines.next()
    if not qual:
        raise ValueError("FASTQ file ends within a record")
    return head[1:].split()[0].decode(), seq.rstrip(b"\r\n").decode(), qual.rstrip(b"\r\n").decode()


class FastqPairs(DataSource):
    @classmethod
    def name(cls):
        return "fastq_pairs"

    def schema(self):
        return ("sample string, tag string, lane string, read_id string, r1_seq string, r1_qual string, "
                "r2_seq string, r2_qual string")

    def reader(self, schema):
        return _PairReader(self.options)


def read_fastq_pairs(spark: SparkSession, r1_glob: str, r2_glob: str, partitions: int | None = None, split: int = SPLIT) -> DataFrame:
    """Read pairs of all matching files; sample, tag and lane come from the file names.

    Plain files are read in ranges of about ``split`` bytes of R1; the lines of all ranges of both files are counted first, so
    that a task finds the mate of its first read. A compressed file is one task; ``partitions`` spreads its reads
    afterwards. The mates are read in step, so no join is needed.
    """
    ones, twos = list_files(r1_glob), list_files(r2_glob)
    if len(ones) != len(twos):
        raise ValueError(f"{len(ones)} R1 files but {len(twos)} R2 files")
    mate = dict(zip(ones, twos, strict=True))
    # a plain file whose mates are compressed is one range, too
    first = [r for path in ones for r in ([(path, 0, None)] if mate[path].endswith(PACKED) else split_files([path], split))]
    long = [mate[path] for path, low, _ in first if low]
    second = split_files(sorted(set(long)), split)
    counts = _counted(spark, [*first, *second], "lines") if long else [{"n": 0}] * len(first)
    starts: dict[str, list] = {}  # per file: where ranges start and how many lines lie before
    for (path, low, _), c in zip([*first, *second], counts, strict=False):
        at = starts.setdefault(path, [])
        at.append((low, 0 if not at else at[-1][2], (0 if not at else at[-1][2]) + c["n"]))
    ranges = []
    for path, low, high in first:
        lines = next(n for x, n, _ in starts[path] if x == low) if low else 0
        behind = starts.get(mate[path], [(0, 0, 0)])
        # the last range of the mates' file whose first line can't lie behind the one asked for
        j = max(bisect_right([n + (x > 0) for x, n, _ in behind], lines) - 1, 0)
        ranges.append((path, low, high, {"lines": lines, "second": mate[path], "low": behind[j][0], "second_lines": behind[j][1]}))
    spark.dataSource.register(FastqPairs)
    df = spark.read.format("fastq_pairs").option("ranges", json.dumps(ranges)).load()
    # by content, so that a recomputed task sends its rows to the same place
    return df.repartition(partitions, "sample", "tag", "read_id") if partitions else df


# ---- sequences ---------------------------------------------------------------------------------


class _FastaReader(_Ranged):
    """Chunks that begin in the range; the last one is completed from the bytes behind it."""

    def read(self, partition):
        import pyarrow as pa
        chunk, high, state = int(self.options["chunk"]), partition.high, partition.state
        chrom, at, header = state.get("chrom"), state.get("at", 0), state.get("header", False)
        skip, kept, rows = -at % chunk, bytearray(), []
        number = (at + skip) // chunk

        def batch():
            names = ("chrom", "chunk_no", "chunk_start", "seq")
            kinds = (pa.string(), pa.int64(), pa.int64(), pa.string())
            return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*rows), kinds, strict=True)], names)

        with Lines(partition.path) as lines:
            new = partition.low == 0
            if partition.low:
                lines.file.seek(partition.low - 1)
                new = lines.file.read(1) == b"\n"
                lines.at = partition.low
            while True:
                beyond = high is not None and lines.at >= high
                if beyond and not kept:
                    break
                piece = lines.next(1 << 16 if beyond or high is None else min(1 << 16, high - lines.at))
                if not piece or (beyond and new and piece.startswith(b">")):
                    break
                if new and piece.startswith(b">"):
                    if kept:
                        rows.append((chrom, number, number * chunk, kept.decode()))
                    while not piece.endswith(b"\n") and (more := lines.next(1 << 16)):
                        piece += more
                    chrom, number, skip, kept, new = (piece[1:].split() or [b""])[0].decode(), 0, 0, bytearray(), True
                    continue
                new = piece.endswith(b"\n")
                if header:  # the rest of a header that began before the range
                    header = not new
                    continue
                bases = _bases(piece)
                left = bases[skip:]
                skip -= len(bases) - len(left)
                kept += left
                while len(kept) >= chunk:
                    rows.append((chrom, number, number * chunk, kept[:chunk].decode()))
                    number, kept = number + 1, kept[chunk:]
                    if beyond:
                        kept = bytearray()
                if len(rows) >= BATCH:
                    yield batch()
                    rows = []
        if kept:
            rows.append((chrom, number, number * chunk, kept.decode()))
        if rows:
            yield batch()


class FastaChunks(DataSource):
    @classmethod
    def name(cls):
        return "fasta_chunks"

    def schema(self):
        return "chrom string, chunk_no bigint, chunk_start bigint, seq string"

    def reader(self, schema):
        return _FastaReader(self.options)


def read_fasta_chunks(spark: SparkSession, pattern: str, chunk: int = 1024, split: int = SPLIT) -> DataFrame:
    """Genome sequence in fixed-width chunks; meant to be landed once as Parquet.

    Plain files are read in ranges of about ``split`` bytes, wherever these fall: lines may be of any length. The bases of
    all ranges are counted first, so that every task knows the chromosome and position that it starts at.
    """
    ranges, out, state = split_files(list_files(pattern), split), [], {}
    for (path, low, high), c in zip(ranges, _counted(spark, ranges, "bases"), strict=True):
        if low == 0:
            state = {"chrom": None, "at": 0, "header": False}
        out.append((path, low, high, state))
        if c:
            at = state["at"] + (0 if state["header"] else c["before"])
            state = {"chrom": c["name"] if c["name"] is not None else state["chrom"], "at": c["n"] if c["name"] is not None else at + c["n"],
                     "header": c["header"] if c["begun"] else state["header"]}
    spark.dataSource.register(FastaChunks)
    return spark.read.format("fasta_chunks").option("chunk", str(chunk)).option("ranges", json.dumps(out)).load()


# ---- signal ------------------------------------------------------------------------------------


def _wig_kind(line: bytes) -> str:
    line = line.strip()
    if not line or line.startswith((b"#", b"track", b"browser")):
        return "other"
    return "step" if line.startswith((b"fixedStep", b"variableStep")) else "value"


def _wig_step(line: str) -> tuple[bool, str, int, int, int]:
    """Fixed or not, chromosome, start (from 0), step and span of a declaration."""
    given = dict(part.split("=", 1) for part in line.split()[1:])
    return line.startswith("fixedStep"), given["chrom"], int(given.get("start", 1)) - 1, int(given.get("step", 1)), int(given.get("span", 1))


class _WigReader(_Ranged):
    def read(self, partition):
        import pyarrow as pa
        track = re.sub(r"\.wig(\.gz)?$", "", posixpath.basename(partition.path))
        state, high, rows = partition.state, partition.high, []
        fixed, chrom, at, step, span = _wig_step(state["name"]) if state.get("name") else (True, None, 0, 1, 1)
        at += step * state.get("n", 0)

        def batch():
            chroms, starts, spans, values = zip(*rows, strict=True)
            starts = pa.array(starts, pa.int64())
            ends = pa.array([a + b for a, b in zip(starts.to_pylist(), spans, strict=True)], pa.int64())
            return pa.RecordBatch.from_arrays([pa.array([track] * len(rows)), pa.array(chroms, pa.string()), starts, ends, pa.array(values, pa.float64())],
                                              ["track", "chrom", "start0", "end0", "value"])

        with Lines(partition.path, partition.low) as lines:
            while high is None or lines.at < high:
                line = lines.next()
                if not line:
                    break
                kind = _wig_kind(line)
                if kind == "step":
                    fixed, chrom, at, step, span = _wig_step(line.decode().strip())
                elif kind == "value":
                    place, value = at, line
                    if fixed:
                        at += step
                    else:
                        word, value = line.split()
                        place = int(word) - 1
                    value = float(value)
                    if math.isfinite(value):  # a value that isn't finite is a gap
                        rows.append((chrom, place, span, value))
                        if len(rows) == BATCH:
                            yield batch()
                            rows = []
        if rows:
            yield batch()


class WigTracks(DataSource):
    @classmethod
    def name(cls):
        return "wig_tracks"

    def schema(self):
        return "track string, chrom string, start0 bigint, end0 bigint, value double"

    def reader(self, schema):
        return _WigReader(self.options)


def read_wig(spark: SparkSession, pattern: str, split: int = SPLIT) -> DataFrame:
    """Wiggle files, fixed or variable step, as signal intervals; the track is named after the file.

    Plain files are read in ranges of about ``split`` bytes; a first pass finds the declaration that holds at the start of
    each range and the values since then. Meant to be landed once as Parquet partitioned by chromosome.
    """
    ranges, out, state = split_files(list_files(pattern), split), [], {}
    for (path, low, high), c in zip(ranges, _counted(spark, ranges, "steps"), strict=True):
        if low == 0:
            state = {"name": None, "n": 0}
        out.append((path, low, high, state))
        if c:
            state = {"name": c["name"] or state["name"], "n": c["n"] + (0 if c["name"] else state["n"])}
    spark.dataSource.register(WigTracks)
    return spark.read.format("wig_tracks").option("ranges", json.dumps(out)).load()


def file_name_parts(df: DataFrame, path: str = "path") -> DataFrame:
    """Sample, tag and lane of a read file name, as columns."""
    base = F.regexp_extract(path, r"([^/]+)$", 1)
    pattern = re.sub(r"\?P<\w+>", "", FILE_NAME)
    return df.withColumns({c: F.regexp_extract(base, pattern, i) for i, c in ((1, "sample"), (2, "tag"), (4, "lane"))})

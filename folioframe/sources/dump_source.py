"""Dumps as a Spark data source that plans which files it opens, and which blocks of them each task reads.

Dumps in folders ``issn/year/order`` below the root (also ``issn=...`` and so on, as Spark writes them) have these three as columns, and with a
file name of five characters the pid of their document as well. What is sought of these columns, values or prefixes, plans the listing: a folder that
cannot match is not listed, so one pid lists three folders and opens one file. Files elsewhere have nulls there.

Filters of a query (``WHERE pid = '...'``) plan the listing only with the option ``pushdown``: Spark keeps the filters that were pushed last for a loaded table, so a
table that is loaded once and filtered twice would lose rows. With it, load the table anew for each query.

A large file is cut into blocks; a block has the lines, or the records, that begin in it, and reads on to their end. Their place is their offset in bytes, which orders
them without counting, and can be kept in an index (``dump_index``). So records are made where they are read (``read_dump_records``): nothing is shuffled to number
lines or to bring a record's fields together, as ``isis.read_records`` has to with lines from Spark's text reader.
"""

from __future__ import annotations

import json
import re
from collections.abc import Iterator, Mapping, Sequence
from dataclasses import dataclass, field
from functools import reduce

import pyarrow as pa
import pyarrow.fs
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.datasource import DataSource, DataSourceReader, EqualTo, Filter, In, InputPartition, StringStartsWith

from folioframe.sources.isis import field_content, field_tag, strip, subfields

#: ``line`` is a line's text without its end, or with the option ``records`` all lines of a record.
SCHEMA = "path string, issn string, year string, issue string, pid string, start long, stop long, line string"
_MARK = b"!ID "
#: Bytes of a block; small files share a task up to so many, each counting OPEN bytes more.
BLOCK, OPEN = 32 << 20, 1 << 16
_CHUNK, _ROWS = 4 << 20, 10_000
_EOL = re.compile(rb"\r\n|\r|\n")
_FOLDERS = (("issn", 9), ("year", 4), ("issue", 4))


def block_lines(file, start: int, end: int) -> Iterator[tuple[int, int, bytes]]:
    """(start, stop, line) of the lines that begin in [start, end); stop is behind the line's end mark."""
    base, inside = max(0, start - 1), start > 0  # from the byte before: if that ends a line, one begins here
    file.seek(base)
    held = b""
    while True:
        piece = file.read(_CHUNK)
        held, at = held + piece, 0
        for m in _EOL.finditer(held):
            if m.end() == len(held) and piece and m[0] == b"\r":
                break  # perhaps the first half of \r\n
            if not inside:
                yield base + at, base + m.end(), held[at : m.start()]
            inside, at = False, m.end()
            if base + at >= end:
                return
        base, held = base + at, held[at:]
        if not piece:
            break
    if held and not inside:
        yield base, base + len(held), held


def block_records(file, start: int, end: int, beyond: bool = True) -> Iterator[tuple[int, int, bytes]]:
    """(start, stop, lines) of the records whose mark begins in [start, end), read beyond it to their end if so; lines before the first mark of a file are a record too."""
    held, at, stop = [], start, start
    inside = start == 0
    for begin, behind, line in block_lines(file, start, 1 << 62 if beyond else end):
        if line.startswith(_MARK):
            if held:
                yield at, stop, b"\n".join(held)
            if begin >= end:
                return
            held, at, inside = [], begin, True
        elif begin >= end and not inside:
            return
        if inside:
            held.append(line)
            stop = behind
    if held:
        yield at, stop, b"\n".join(held)


def open_store(path: str) -> tuple[pa.fs.FileSystem, str]:
    """A path's store, and its path there."""
    return pa.fs.FileSystem.from_uri(re.sub(r"^file:/(?!/)", "file:///", path))


def file_columns(path: str) -> dict[str, str | None]:
    """issn, year, issue and pid of a file by its folders."""
    *_, a, b, c, name = ["", "", "", *path.split("/")]
    values = [x.split("=", 1)[-1] for x in (a, b, c)]
    if any(len(v) != n for v, (_, n) in zip(values, _FOLDERS, strict=True)):
        return dict.fromkeys(["issn", "year", "issue", "pid"])
    stem = name.rpartition(".")[0]
    return {"issn": values[0], "year": values[1], "issue": values[2], "pid": f"S{''.join(values)}{stem}" if len(stem) == 5 else None}


@dataclass
class Wanted:
    """For each level of folders, and for the file, sets of prefixes of which each must have one that fits."""

    levels: list[list[frozenset[str]]] = field(default_factory=lambda: [[], [], [], []])

    def push(self, f: Filter) -> None:
        """Narrow by a filter; what can't be used is left to Spark, which applies all of them again."""
        if isinstance(f, EqualTo | In | StringStartsWith) and len(f.attribute) == 1:
            self.add(f.attribute[0], f.value if isinstance(f, In) else [f.value], not isinstance(f, StringStartsWith))

    def add(self, column: str, values: Sequence[str | None], whole: bool) -> None:
        """Narrow to values of a column, or to prefixes of them."""
        values = [v for v in values if v is not None]
        names = [n for n, _ in _FOLDERS]
        if column in names:
            k = names.index(column)
            self.levels[k].append(frozenset(v for v in values if not whole or len(v) == _FOLDERS[k][1]))
        elif column == "pid":
            values = [v for v in values if v[:1] in ("S", "") and (len(v) == 23 or not whole and len(v) < 23)]
            for k, (a, b) in enumerate(((1, 10), (10, 14), (14, 18), (18, 23))):
                self.levels[k].append(frozenset(v[a:b] for v in values))

    def fits(self, level: int, name: str) -> bool:
        value = name.rpartition(".")[0] if level == 3 else name.split("=", 1)[-1]
        return all(any(value.startswith(p) for p in prefixes) for prefixes in self.levels[level])

    @property
    def any(self) -> bool:
        return any(self.levels)


@dataclass
class Blocks(InputPartition):
    """(path, from, to) of what a task reads."""

    parts: tuple[tuple[str, int, int], ...]

    def __init__(self, parts):
        super().__init__(None)
        self.parts = tuple(parts)


class DumpReader(DataSourceReader):
    def __init__(self, options):
        self.root, self.suffix = options["path"], options.get("suffix", ".id")
        self.block, self.encoding = int(options.get("block", BLOCK)), options.get("encoding", "ISO-8859-1")
        self.cut = block_records if options.get("records", "false").lower() == "true" else block_lines
        self.wanted, self.pushdown = Wanted(), options.get("pushdown", "false").lower() == "true"
        for column, values in json.loads(options.get("equal", "{}")).items():
            self.wanted.add(column, values, True)
        for column, values in json.loads(options.get("prefix", "{}")).items():
            self.wanted.add(column, values, False)

    def pushFilters(self, filters):
        for f in filters:
            if self.pushdown:
                self.wanted.push(f)
            yield f

    def files(self) -> list[tuple[str, int]]:
        """(path, size) of the files that may have rows, level by level; hidden ones, as Spark's commit marks, are left out."""
        store, root = open_store(self.root)
        if store.get_file_info(root).is_file:
            return [(root, store.get_file_info(root).size)]
        found, folders, level = [], [root], 0
        while folders:
            inside = [x for f in folders for x in store.get_file_info(pa.fs.FileSelector(f)) if not x.base_name.startswith(("_", "."))]
            deep = level == 3 or not self.wanted.any  # a file elsewhere has nulls, which fit no filter
            found += [(x.path, x.size) for x in inside if x.is_file and x.base_name.endswith(self.suffix) and deep and (not self.wanted.any or self.wanted.fits(3, x.base_name))]
            folders = [x.path for x in inside if not x.is_file and (not self.wanted.any or level < 3 and self.wanted.fits(level, x.base_name))]
            level += 1
        return sorted(found)

    def partitions(self):
        out, held, size = [], [], 0
        for path, n in self.files():
            for at in range(0, n, self.block):
                held.append((path, at, min(n, at + self.block)))
                size += held[-1][2] - at + OPEN
                if size >= self.block:
                    out, held, size = [*out, Blocks(held)], [], 0
        return [*out, Blocks(held)] if held or not out else out

    def read(self, partition):
        store, _ = open_store(self.root)
        for path, at, to in partition.parts:
            columns = file_columns(path)
            rows, size = [], 0
            with store.open_input_file(path) as file:
                for start, stop, line in self.cut(file, at, to):
                    rows.append((start, stop, line.decode(self.encoding)))
                    size += len(line)
                    if len(rows) == _ROWS or size > _CHUNK:
                        yield _batch(path, columns, rows)
                        rows, size = [], 0
            if rows:
                yield _batch(path, columns, rows)


def _batch(path: str, columns: dict[str, str | None], rows: list[tuple[int, int, str]]) -> pa.RecordBatch:
    start, stop, line = zip(*rows, strict=True)
    same = [pa.array([v] * len(rows), pa.string()) for v in (path, *columns.values())]
    return pa.RecordBatch.from_arrays([*same, pa.array(start, pa.int64()), pa.array(stop, pa.int64()), pa.array(line, pa.string())], [x.split()[0] for x in SCHEMA.split(", ")])


class DumpSource(DataSource):
    """``spark.read.format("folio_dump").load(root)``; options: suffix (.id), encoding (ISO-8859-1), block (bytes), records, equal and prefix (JSON of lists by column), pushdown."""

    @classmethod
    def name(cls):
        return "folio_dump"

    def schema(self):
        return SCHEMA

    def reader(self, schema):
        return DumpReader(self.options)


def read_dump_lines(spark: SparkSession, root: str, equal: Mapping[str, Sequence[str]] | None = None, prefix: Mapping[str, Sequence[str]] | None = None, **options) -> DataFrame:
    """(path, issn, year, issue, pid, start, stop, line) of all dumps below the root, or of one file.

    ``equal`` and ``prefix`` give for columns (issn, year, issue, pid) the values, or beginnings, that are sought: only files that may have them are
    listed and read, and only rows that have them come out. Any store that pyarrow knows can be read (a mounted folder, HDFS, S3, GCS); ``isis.read_lines`` reads those that only Spark does.
    """
    spark.conf.set("spark.sql.python.filterPushdown.enabled", "true")  # heeded by tables loaded with the option pushdown alone
    spark.dataSource.register(DumpSource)
    given = {"equal": json.dumps({k: list(v) for k, v in (equal or {}).items()}), "prefix": json.dumps({k: list(v) for k, v in (prefix or {}).items()})}
    lines = spark.read.format("folio_dump").options(**given, **{k: str(v) for k, v in options.items()}).load(root)
    for column, values in (equal or {}).items():
        lines = lines.filter(F.col(column).isin(list(values)))
    for column, values in (prefix or {}).items():
        lines = lines.filter(reduce(Column.__or__, [F.col(column).startswith(v) for v in values], F.lit(False)))
    return lines


def numbered_lines(lines: DataFrame) -> DataFrame:
    """(path, n, line) for the record engine: n is the line's offset."""
    return lines.select("path", F.col("start").alias("n"), strip(F.col("line")).alias("line"))


def records_of(raw: DataFrame) -> DataFrame:
    """(path, rec, record, start, stop) of records' lines (path, start, stop, line): fields with what continues them, their subfields, and their occurrences by tag, in the row.

    The same records as of ``isis.build_records``; rec is the offset. Records without any content are dropped.
    """
    lines = F.filter(F.transform(F.split("line", r"\r\n|\r|\n"), strip), lambda x: (x != "") & ~x.startswith("!ID "))
    # a line that begins no field goes on with the one before
    fields = F.filter(F.split(F.regexp_replace(F.array_join(lines, "\x1f"), "\x1f(?!!v)", " "), "\x1f"), lambda x: x.startswith("!v"))
    parsed = F.transform(fields, lambda x: F.struct(field_tag(x).alias("tag"), F.map_entries(subfields(field_content(x))).alias("occ")))
    full = raw.withColumn("_fields", F.filter(parsed, lambda f: (f["tag"] != "") & (F.size(f["occ"]) > 0))).filter(F.size("_fields") > 0)
    of = lambda t: F.transform(F.filter("_fields", lambda f: f["tag"] == t), lambda f: F.map_from_entries(f["occ"]))
    tags = F.array_distinct(F.transform("_fields", lambda f: f["tag"]))
    record = F.map_from_entries(F.transform(tags, lambda t: F.struct(t.alias("tag"), of(t).alias("occs"))))
    return full.select("path", F.col("start").alias("rec"), record.alias("record"), "start", "stop")


def read_dump_records(spark: SparkSession, root: str, equal: Mapping[str, Sequence[str]] | None = None, prefix: Mapping[str, Sequence[str]] | None = None, **options) -> DataFrame:
    """(path, rec, record, start, stop) of the dumps that ``read_dump_lines`` would read, without a shuffle."""
    return records_of(read_dump_lines(spark, root, equal, prefix, records=True, **options))

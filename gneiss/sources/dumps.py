"""SQL dumps read in byte ranges: a file of any size, whatever its lines and statements, is many tasks' work.

Whether a byte stands inside a string or a comment depends on all bytes before it. So a first pass over the ranges finds
what each turns every possible beginning into; composing these in order (six numbers a range) gives each range its true
beginning. A statement belongs to the range in which the statement before it ends, and is read past the range's end.
"""

from __future__ import annotations

import re
from collections.abc import Callable, Iterator, Sequence
from typing import IO

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession

from gneiss.sources.files import opened

RANGE_BYTES = 32 << 20
#: Rows of a batch handed to Spark, and bytes by which a range's last statement is read on.
_ROWS, _MORE = 4096, 1 << 20

#: What a range can begin in: plain text, the three quotes, a comment to the line's end, a comment to its closing mark.
STATES = ("", "'", '"', "`", "-", "*")
_CLOSED = {"'": rb"(?:[^'\\]+|\\.)*+'", '"': rb'(?:[^"\\]+|\\.)*+"', "`": rb"[^`]*+`", "-": rb"[^\n]*+\n", "*": rb".*?\*/"}
_OPENED = {"'": rb"'", '"': rb'"', "`": rb"`", "-": rb"(?:--(?=[ \t\r\n])|#)", "*": rb"/\*"}
_WHOLE = b"|".join(_OPENED[s] + _CLOSED[s] for s in STATES[1:])
_SINGLE = rb"-(?!-[ \t\r\n])|/(?!\*)"
_CLOSE = {s: re.compile(p, re.S) for s, p in _CLOSED.items()}
_OPEN = {s: re.compile(p, re.S) for s, p in _OPENED.items()}
_PLAIN = re.compile(rb"(?:[^'\"`#/\-]++|" + _WHOLE + b"|" + _SINGLE + rb")*+", re.S)
_STATEMENT = re.compile(rb"(?:[^'\"`#/\-;]++|" + _WHOLE + b"|" + _SINGLE + rb")*+;", re.S)
_LEADING = re.compile(rb"(?:\s++|" + _OPENED["-"] + _CLOSED["-"] + rb"|/\*(?!!).*?\*/)*+", re.S)
_VALUE = re.compile(r"""\s*(?:(?:_\w+\s*|[xbn])?(?:'((?:[^'\\]+|\\.|'')*+)'|"((?:[^"\\]+|\\.|"")*+)")|([^,()'"]*+(?:\([^()]*+\))?[^,()'"]*+))\s*([,)])""", re.S | re.I)
_ESCAPE = {q: re.compile(rf"\\(.)|{q}{q}", re.S) for q in "'\""}
_MEANS = {"n": "\n", "r": "\r", "t": "\t", "0": "\0", "Z": "\x1a", "b": "\b"}
_BETWEEN = re.compile(r"\s*,\s*")


def after(data: bytes, state: str) -> str:
    """The state at the end of data that begins in ``state``; data ends after a comma or a line."""
    at = 0
    if state:
        m = _CLOSE[state].match(data)
        if not m:
            return state
        at = m.end()
    at = _PLAIN.match(data, at).end()
    return next((s for s, p in _OPEN.items() if p.match(data, at)), "")


def _from_mark(f: IO[bytes], at: int, size: int) -> int:
    """The first place from ``at`` on that follows a comma or a line's end; no token of the syntax is cut there."""
    if at <= 0:
        return 0
    f.seek(at - 1)
    at -= 1
    while at < size:
        part = f.read(1 << 16)
        if not part:
            break
        found = re.search(rb"[,\n]", part)
        if found:
            return min(size, at + found.end())
        at += len(part)
    return size


def statements(f: IO[bytes], begin: int, end: int, state: str, size: int) -> Iterator[bytes]:
    """The statements that follow one that ends in begin..end (or the file's beginning), each to its semicolon."""
    f.seek(begin)
    data, at = f.read(end - begin), 0
    if begin:
        if state:
            m = _CLOSE[state].match(data)
            if not m:
                return
            at = m.end()
        m = _STATEMENT.match(data, at)
        if not m:
            return
        at = m.end()
    data, read = data[at:], end
    at, more = 0, _MORE
    while True:
        m = _STATEMENT.match(data, at)
        if m:
            yield data[at : m.end()]
            at = m.end()
            if read > end and at > len(data) - (read - end):  # it ended past the range
                return
        elif read >= size:
            yield data[at:]
            return
        else:
            f.seek(read)
            part = f.read(min(more, size - read))
            data, at, read, more = data[at:] + part, 0, read + len(part), 2 * more


def _name(table: str) -> bytes:
    return rb"(?:`?\w+`?\s*\.\s*)?`?" + re.escape(table.encode()) + rb"`?"


def create_columns(statement: bytes, table: str) -> list[str] | None:
    """The column names of the table's CREATE TABLE; None for another statement."""
    found = re.match(rb"CREATE\s+TABLE\s+(?:IF\s+NOT\s+EXISTS\s+)?" + _name(table) + rb"\s*\((.*)\)", statement, re.S | re.I)
    if not found:
        return None
    parts, depth = [""], 0
    for token in re.findall(r"`[^`]*`|'(?:[^'\\]|\\.|'')*'|[(),]|[^(),`']+", found[1].decode("utf-8", "replace"), re.S):
        depth += (token == "(") - (token == ")")
        if token == "," and not depth:
            parts.append("")
        else:
            parts[-1] += token
    kept = [p.strip() for p in parts if not re.match(r"\s*(?:PRIMARY|UNIQUE|KEY|INDEX|CONSTRAINT|FOREIGN|FULLTEXT|SPATIAL|CHECK)\b", p, re.I)]
    return [p[1 : p.index("`", 1)] if p.startswith("`") else p.split()[0] for p in kept if p]


def insert_rows(statement: bytes, table: str) -> tuple[list[str] | None, Iterator[list[str | None]]] | None:
    """(the statement's own columns or None, its rows); None for a statement that inserts nothing into the table."""
    head = re.match(rb"(?:INSERT|REPLACE)\s+(?:(?:IGNORE|DELAYED|LOW_PRIORITY)\s+)*(?:INTO\s+)?" + _name(table) + rb"\s*(?:\(([^)]*)\)\s*)?VALUES?\s*", statement, re.I)
    if not head:
        return None
    own = [c.strip().strip("`") for c in head[1].decode().split(",")] if head[1] is not None else None
    return own, _tuples(statement[head.end() :].decode("utf-8", "replace"))


def _tuples(text: str) -> Iterator[list[str | None]]:
    at = 0
    while at < len(text) and text[at] == "(":
        at, values = at + 1, []
        while m := _VALUE.match(text, at):
            quoted = m[1] if m[1] is not None else m[2]
            if quoted is not None:
                mark = "'" if m[1] is not None else '"'
                values.append(_ESCAPE[mark].sub(lambda e: _MEANS.get(e[1], e[1]) if e[1] else e[0][0], quoted))
            else:
                values.append(None if m[3].strip().upper() in ("NULL", "") else m[3].strip())
            at = m.end()
            if m[4] == ")":
                break
        else:
            return
        yield values
        more = _BETWEEN.match(text, at)
        if not more:
            return
        at = more.end()


def file_sizes(spark: SparkSession, path: str) -> list[tuple[str, int]]:
    """(address, bytes) of the files at a path, a pattern or in a folder, by name; hidden ones are left out."""
    jvm = spark.sparkContext._jvm
    pattern = jvm.org.apache.hadoop.fs.Path(path)
    fs = pattern.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    out = []
    for found in fs.globStatus(pattern) or []:
        for f in fs.listStatus(found.getPath()) if found.isDirectory() else [found]:
            if f.isFile() and f.getPath().getName()[0] not in "_.":
                out.append((f.getPath().toString(), f.getLen()))
    return sorted(out)


def _over(spark: SparkSession, ranges: list[tuple], schema: str, work: Callable[..., Iterator[tuple]], out: pa.Schema, ddl: str) -> DataFrame:
    """One row of ranges is one call of ``work`` with an open file and the row; what it yields is the result."""
    rows = spark.createDataFrame(ranges, schema).repartition(max(1, min(len(ranges), 4000)))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for row in zip(*(c.to_pylist() for c in b.columns), strict=True):
                with opened(row[0]) as f:
                    held: list[tuple] = []
                    for r in work(f, *row):
                        held.append(r)
                        if len(held) >= _ROWS:
                            yield _record(held, out)
                            held = []
                    if held:
                        yield _record(held, out)

    return rows.mapInArrow(run, ddl)


def _record(rows: list[tuple], schema: pa.Schema) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows, strict=True), schema.types, strict=True)], schema=schema)


def read_dump(spark: SparkSession, path: str, table: str, columns: Sequence[str], range_bytes: int = RANGE_BYTES) -> DataFrame:
    """(_source_file, _source_row, the columns as strings) of a table's INSERT statements in the dump files at a path.

    Columns are picked by the names in the statement or else in the table's CREATE TABLE of that file or, without one,
    taken as given; one that the dump lacks is null. Rows are numbered from 1 in each file. Strings may hold anything,
    statements inside them included. A table or a file without rows gives none. Three passes read the ranges: for their
    states, for their counts of rows and, when the frame is used, for the rows; the driver holds a small entry per range.
    """
    ranges = [(p, size, i, at) for p, size in file_sizes(spark, path) for i, at in enumerate(range(0, size, range_bytes))]
    schema = f"_source_file string, _source_row long, {', '.join(f'`{c}` string' for c in columns)}"
    if not ranges:
        return spark.createDataFrame([], schema)

    def turn(f: IO[bytes], p: str, size: int, i: int, at: int) -> Iterator[tuple]:
        begin, end = _from_mark(f, at, size), _from_mark(f, min(size, at + range_bytes), size)
        f.seek(begin)
        data = f.read(end - begin)
        yield p, i, begin, end, "".join(str(STATES.index(after(data, s))) for s in STATES)

    kinds = pa.schema([("path", pa.string()), ("i", pa.int64()), ("begin", pa.int64()), ("end", pa.int64()), ("turns", pa.string())])
    turned = _over(spark, ranges, "path string, size long, i long, at long", turn, kinds, "path string, i long, begin long, end long, turns string")
    sizes, begun, now = dict(r[:2] for r in ranges), [], {}
    for r in sorted(turned.collect()):
        state = now.get(r["path"], 0)
        if r["end"] > r["begin"]:
            begun.append((r["path"], sizes[r["path"]], r["begin"], r["end"], STATES[state]))
        now[r["path"]] = int(r["turns"][state])

    def count(f: IO[bytes], p: str, size: int, begin: int, end: int, state: str) -> Iterator[tuple]:
        n, create = 0, None
        for s in statements(f, begin, end, state, size):
            s = s[_LEADING.match(s).end() :]
            found = insert_rows(s, table)
            n += sum(1 for _ in found[1]) if found else 0
            create = (None if found else create_columns(s, table)) or create
        yield p, begin, n, create

    kinds = pa.schema([("path", pa.string()), ("begin", pa.int64()), ("n", pa.int64()), ("columns", pa.list_(pa.string()))])
    begun_schema = "path string, size long, begin long, end long, state string"
    counted = {(r["path"], r["begin"]): r for r in _over(spark, begun, begun_schema, count, kinds, "path string, begin long, n long, columns array<string>").collect()}
    creates, before, final = {p: r["columns"] for (p, _), r in counted.items() if r["columns"]}, {}, []
    for row in begun:
        r = counted[row[0], row[2]]
        if r["n"]:
            final.append((*row, before.get(row[0], 0), creates.get(row[0], list(columns))))
        before[row[0]] = before.get(row[0], 0) + r["n"]
    if not final:
        return spark.createDataFrame([], schema)

    def rows(f: IO[bytes], p: str, size: int, begin: int, end: int, state: str, at: int, order: list[str]) -> Iterator[tuple]:
        name = p.rsplit("/", 1)[-1]
        for s in statements(f, begin, end, state, size):
            found = insert_rows(s[_LEADING.match(s).end() :], table)
            if found:
                own = found[0] or order
                place = [own.index(c) if c in own else -1 for c in columns]
                for values in found[1]:
                    at += 1
                    yield name, at, *(values[k] if 0 <= k < len(values) else None for k in place)

    kinds = pa.schema([("_source_file", pa.string()), ("_source_row", pa.int64()), *((c, pa.string()) for c in columns)])
    return _over(spark, final, f"{begun_schema}, before long, columns array<string>", rows, kinds, schema)


def write_dump(rows: DataFrame, path: str, table: str, statement_rows: int = 500) -> None:
    """A dump of a frame in the same syntax: a file per partition, multi-row INSERT statements, a CREATE TABLE in each file.

    Values are written as strings with backslash escapes, null as NULL.
    """
    columns = rows.columns
    create = f"CREATE TABLE `{table}` (\n" + ",\n".join(f"  `{c}` text" for c in columns) + "\n) ENGINE=InnoDB;"
    escapes = str.maketrans({"\\": "\\\\", "'": "\\'", "\0": "\\0", "\n": "\\n"})

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        first = True
        for b in batches:
            cells = [c.to_pylist() for c in b.columns]
            tuples = ["(" + ",".join("NULL" if v is None else "'" + v.translate(escapes) + "'" for v in r) + ")" for r in zip(*cells, strict=True)]
            found = [create] if first else []
            first = False
            found += [f"INSERT INTO `{table}` VALUES " + ",".join(tuples[i : i + statement_rows]) + ";" for i in range(0, len(tuples), statement_rows)]
            yield pa.RecordBatch.from_arrays([pa.array(found, pa.string())], names=["value"])

    rows.select(*(rows[c].cast("string").alias(c) for c in columns)).mapInArrow(run, "value string").write.text(path)

"""S1-S3 for documents larger than a task should hold: record arrays read in pieces.

A JSON array without line breaks can't be split at lines, and as one value it has to
fit into one row.  Here the file is read at its closing braces (``lineSep``), so that
Spark splits it at ``spark.sql.files.maxPartitionBytes`` like any text, and the state
of the parser at the start of each piece is found from the pieces before:

1. Each piece is scanned from both states it can start in, inside a string or outside.
   What counts is small: whether it ends inside a string, how many brackets it closes
   that it didn't open, and those it leaves open, with their keys.  (Text that can't
   stand outside of strings rules one state out early.)
2. Per file these effects are folded in order, a row per piece, to the state at the
   start of every piece.
3. Each piece is scanned again from its state.  Records, the objects of the wanted
   arrays, leave as text, exactly as in the file; the parts of a record that crosses
   into other pieces are grouped by the piece it began in and joined.

The document's structure is checked on the way: brackets that don't match, a wanted
array that holds something other than objects, text after the document, or an end
inside of it fail the load.  Records are parsed by their schemas as usual.  A task holds
a batch of rows and the record it is in.

Defined cases: missing and empty arrays give no rows; an array that occurs twice under its
key gives the records of both; a file of blanks fails the load, one of no bytes gives no
rows (Spark skips it); keys are compared as written (no escapes); compressed files are
one piece each.
"""

from __future__ import annotations

import json
import re
from collections.abc import Iterator, Mapping

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from pitchlens.session import ship_package
from pitchlens.sources.published import TAG
from pitchlens.sources.tables import stored_copy

SEPARATOR = "}"
TOKEN = re.compile(r'"(?:[^"\\]|\\.)*+"|[{}\[\]]|"', re.DOTALL)
STRING_END = re.compile(r'(?:[^"\\]|\\.)*+"', re.DOTALL)
OUTSIDE = " \t\r\n,:0123456789.+-eEtrufalsn"  # what may stand between strings and brackets
KEY_LENGTH = 1000  # of a string that goes on in the next piece; longer ones are no wanted key
UNKNOWN = "\0"  # stands for the beginning, in earlier pieces, of the string a piece starts in; no character of JSON
OPENS = {"}": "{", "]": "["}


class Impossible(ValueError):
    """The text isn't JSON, read from the state assumed."""


class Scan:
    """A place in a document: the brackets open there (bracket, key), from the first one
    known on, and the string it is in.  ``closed`` counts brackets closed that were not known."""

    def __init__(self, stack: list | None = None, string: str | None = None):
        self.known = stack is not None
        self.stack = [tuple(x) for x in stack or ()]
        self.string = string  # its beginning
        self.closed = 0

    def tokens(self, text: str) -> Iterator[tuple[str, int, int, str | None, str]]:
        """(bracket or quote, start, end, the string right before, text between) of the brackets
        and strings that end in the next text; the state is that after each."""
        at, before = 0, None
        if self.string is not None:
            m = STRING_END.match(text)
            if m is None:
                self.string = (self.string + text)[:KEY_LENGTH]
                return
            before, self.string, at = self.string + text[:m.end() - 1], None, m.end()
            yield '"', 0, at, None, ""
        for m in TOKEN.finditer(text, at):
            gap = text[at:m.start()]
            if gap.strip(OUTSIDE):
                raise Impossible(f"unexpected text {gap.strip()[:40]!r}")
            start, at = m.span()
            c = text[start]
            if c == '"' and at - start == 1:
                self.string = text[at:][:KEY_LENGTH]
                yield c, start, len(text), before, gap
                return
            if c in OPENS:
                if self.stack:
                    if self.stack.pop()[0] != OPENS[c]:
                        raise Impossible(f"{c} closes another bracket")
                elif self.known:
                    raise Impossible(f"{c} without its bracket")
                else:
                    self.closed += 1
            elif c != '"':
                self.stack.append((c, before if ":" in gap else None))
            yield c, start, at, before, gap
            before = text[start + 1:at - 1] if c == '"' else None
        if text[at:].strip(OUTSIDE):
            raise Impossible(f"unexpected text {text[at:].strip()[:40]!r}")


def place(stack: list, tables: Mapping[str, str]) -> tuple[str | None, int]:
    """(table of the wanted array that the brackets lie in, the array's depth)."""
    depth = 1 if stack and stack[0][0] == "[" else 2
    array = stack[depth - 1] if len(stack) >= depth else ("", None)
    return (tables.get("" if depth == 1 else array[1]) if array[0] == "[" else None), depth


class Pieces:
    """The records of one piece of a document, from its texts in order."""

    def __init__(self, tables: Mapping[str, str], stack: list, string: str | None, began: int | None):
        self.tables, self.scan = tables, Scan(stack, string)
        self.table, self.depth = place(self.scan.stack, tables)
        self.open = self.table is not None and len(self.scan.stack) > self.depth  # in a record
        self.began = began  # the piece this record began in, unless it is this one
        self.parts: list[str] = []
        self.seen = bool(stack) or string is not None

    def _between(self, c: str, before: str | None, gap: str, depth: int) -> None:
        """Check what stands between records; ``depth`` is that before the bracket or string c."""
        if depth == 0:
            if self.seen or c == '"' or ("" in self.tables) != (c == "["):
                raise Impossible("text after the document" if self.seen else "a document of another type")
        elif self.table is not None:  # in the wanted array itself
            if gap.strip(" \t\r\n,") or c not in "{]":
                raise Impossible("an element of the array is no object")
        elif depth == 1 and before in self.tables and ":" in gap:
            value = gap.split(":", 1)[1].split(",")[0].strip()
            if value != ("" if c == "[" else "null"):
                raise Impossible(f"{before} is no array")

    def records(self, text: str) -> Iterator[tuple[str, int | None, str]]:
        """(table, earlier piece it began in, text) of the records that end in ``text``."""
        scan, at, done, depth = self.scan, 0, 0, len(self.scan.stack)
        for c, start, end, before, gap in scan.tokens(text):
            now = len(scan.stack)
            if self.open:
                if now == self.depth:
                    yield self.table, self.began, "".join([*self.parts, text[at:end]])
                    self.parts, self.open, self.began = [], False, None
            else:
                self._between(c, before, gap, depth)
                self.seen = True
                if self.table is not None and c == "{":
                    self.open, at = True, start
                elif now <= 2:
                    self.table, self.depth = place(scan.stack, self.tables)
            done, depth = end, now
        if self.open:
            self.parts.append(text[at:])
        elif scan.string is None and (self.table is not None or not depth) and text[done:].strip(" \t\r\n,"):
            raise Impossible("text that is no record" if depth else "text outside the document")


def _chunks(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[tuple, Iterator[tuple]]]:
    """((file, block), its rows in order): rows of a piece follow one another."""
    rows = (row for b in batches for row in zip(*(b.column(k).to_pylist() for k in range(b.num_columns)), strict=True))
    row = next(rows, None)

    def own(key: tuple) -> Iterator[tuple]:
        nonlocal row
        while row is not None and row[:2] == key:
            yield row
            row = next(rows, None)

    while row is not None:
        key = row[:2]
        group = own(key)
        yield key, group
        for _ in group:
            pass


def _fragments(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.option("lineSep", SEPARATOR).text(path).select(
        F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("block"), "value",
        F.octet_length("value").alias("bytes"), F.col("_metadata.file_size").alias("size"))


def piece_effects(fragments: DataFrame) -> DataFrame:
    """file, block, effects (of a start outside and inside of a string, as JSON), bytes (read in
    the piece, a brace after every fragment) and size (of the file)."""

    schema = pa.schema([("file", pa.string()), ("block", pa.int64()), ("effects", pa.string()), ("bytes", pa.int64()), ("size", pa.int64())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for (file, block), rows in _chunks(batches):
            scans = [Scan(), Scan(string=UNKNOWN)]
            n = size = 0
            for row in rows:
                n, size = n + row[3] + len(SEPARATOR), row[4]
                for k, scan in enumerate(scans):
                    try:
                        for _ in scan.tokens(row[2] + SEPARATOR) if scan else ():
                            pass
                    except Impossible:
                        scans[k] = None
            effects = [s and {"closed": s.closed, "open": s.stack, "string": s.string} for s in scans]
            yield pa.RecordBatch.from_pylist([{"file": file, "block": block, "effects": json.dumps(effects), "bytes": n, "size": size}], schema)

    return fragments.mapInArrow(run, "file string, block long, effects string, bytes long, size long")


def after(stack: list, string: str | None, began: int | None, block: int, effect: dict, tables: Mapping[str, str]) -> tuple:
    """The state (stack, string, began) after a piece with this effect."""

    def in_record(stack: list) -> bool:
        table, depth = place(stack, tables)
        return table is not None and len(stack) > depth

    def whole(text: str | None) -> str | None:
        return text if text is None or not text.startswith(UNKNOWN) else (string + text[len(UNKNOWN):])[:KEY_LENGTH]

    kept = len(stack) - effect["closed"]
    same = in_record(stack) and in_record(stack[:kept])
    stack = stack[:kept] + [(c, whole(key)) for c, key in effect["open"]]
    return stack, whole(effect["string"]), (began if same else block) if in_record(stack) else None


def piece_states(effects: DataFrame, wanted: Mapping[str, str]) -> DataFrame:
    """file, block, state (at the start, as JSON) and, in the last piece of a file, ends: whether
    a brace ends the file (``yes``, ``no``, or ``maybe`` where its size doesn't tell)."""
    tables = {field: table for table, field in wanted.items()}
    schema = pa.schema([("file", pa.string()), ("block", pa.int64()), ("state", pa.string()), ("ends", pa.string())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for (file, _), rows in _chunks(b.select(["file", "one", "block", "effects", "bytes", "size"]) for b in batches):
            stack, string, began, states = [], None, None, []
            total, previous = 0, None  # folded when another piece follows: the file's end may lack the brace
            for row in rows:
                if previous is not None:
                    _, _, block, effects, *_ = previous
                    effect = json.loads(effects)[string is not None]
                    if effect is None or effect["closed"] > len(stack):
                        raise Impossible(f"{file}: not JSON in the piece at byte {block}")
                    stack, string, began = after(stack, string, began, block, effect, tables)
                states.append({"file": file, "block": row[2], "ends": None,
                               "state": json.dumps({"stack": stack, "string": string, "began": began})})
                previous, total = row, total + row[4]
            states[-1]["ends"] = {total: "yes", total - len(SEPARATOR): "no"}.get(previous[5], "maybe")
            yield pa.RecordBatch.from_pylist(states, schema)

    ordered = effects.withColumn("one", F.lit(1)).repartition("file").sortWithinPartitions("file", "block")
    return ordered.mapInArrow(run, "file string, block long, state string, ends string")


def _piece_records(fragments: DataFrame, wanted: Mapping[str, str]) -> DataFrame:
    """file, table, began, block, text: records, and parts of those that cross pieces (``began`` not null)."""

    tables = {field: table for table, field in wanted.items()}

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        out: list[tuple] = []
        size = 0

        def flushed() -> pa.RecordBatch:
            cols = list(zip(*out, strict=True))
            kinds = (pa.string(), pa.string(), pa.int64(), pa.int64(), pa.string())
            return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(cols, kinds, strict=True)],
                                              names=["file", TAG, "began", "block", "text"])

        for (file, block), rows in _chunks(batches):
            pieces = held = ends = None

            def found(text: str, pieces: Pieces, file: str = file, block: int = block) -> Iterator[tuple]:
                try:
                    for table, began, record in pieces.records(text):
                        yield file, table, began, block, record
                except Impossible as e:
                    raise Impossible(f"{file}: {e} in the piece at byte {block}") from None

            for row in rows:
                if pieces is None:
                    state, ends = json.loads(row[3]), row[4]
                    pieces = Pieces(tables, state["stack"], state["string"], state["began"])
                else:
                    out.extend(found(held + SEPARATOR, pieces))
                    size += len(held)
                held = row[2]
                if size > 1 << 20:
                    if out:
                        yield flushed()
                    out, size = [], 0
            if ends == "maybe":  # the brace is there if one is open
                trial = Scan(pieces.scan.stack, pieces.scan.string)
                for _ in trial.tokens(held):
                    pass
                ends = "yes" if trial.stack else "no"
            out.extend(found(held + SEPARATOR * (ends != "no"), pieces))
            if ends and (pieces.scan.stack or pieces.scan.string is not None or not pieces.seen):
                raise Impossible(f"{file}: the document ends too early")
            if pieces.open:
                out.append((file, pieces.table, block if pieces.began is None else pieces.began, block, "".join(pieces.parts)))
        if out:
            yield flushed()

    return fragments.mapInArrow(run, f"file string, {TAG} string, began long, block long, text string")


def read_records(spark: SparkSession, path: str, wanted: Mapping[str, str]) -> DataFrame:
    """file, table (``TAG``) and text of every record of the JSON files under ``path``;
    ``wanted`` maps a table to its array's field (empty: the document is the array)."""
    ship_package(spark)
    fragments = _fragments(spark, path)
    states = stored_copy(piece_states(piece_effects(fragments), wanted), "piece-states")
    # a row per piece, that is per maxPartitionBytes of input
    started = fragments.join(F.broadcast(states), ["file", "block"]).select("file", "block", "value", "state", "ends")
    found = stored_copy(_piece_records(started, wanted), "piece-records")
    parts = found.where("began is not null").groupBy("file", TAG, "began").agg(F.sort_array(F.collect_list(F.struct("block", "text"))).alias("parts"))
    joined = parts.select("file", TAG, F.array_join(F.transform("parts", lambda p: p.text), "").alias("text"))
    return found.where("began is null").select("file", TAG, "text").unionByName(joined)

"""JSON of any size, read in byte ranges by many tasks.

*Lines.* A range has the lines that begin in it; the last of them is read to its end.

*Arrays.* Where an array's elements begin depends on everything before: whether a byte lies in a
string, and how deep it is nested. Each range is first summed up for itself: its number of quotes that
are not escaped, and how much deeper it ends than it begins, in case that it begins outside of a
string and in case that it begins inside. Running sums over the ranges of a file then tell each range
in which state it begins, and it has the elements that begin in it, the last read to its end.

Whatever a file or record does wrong becomes a row of the refused half. A value is held in memory
once, by the task that its beginning belongs to; nothing else grows with a value or a file.
"""

from __future__ import annotations

import json
import re
from collections.abc import Callable, Iterator, Sequence
from dataclasses import dataclass
from itertools import chain

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, functions as F

from quern.functions.text import RECORD_TEXT_KEYS
from quern.operators.ordered import ordered_sums
from quern.session import materialize, ship_package
from quern.sources.paths import described, filesystem, spread

#: Bytes of a range, and the most and least of what is read at a time beyond its end.
RANGE = 8 << 20
STEP = 1 << 20
LEAST_STEP = 1 << 12

_OPEN, _CLOSE, _COMMA = b"[{", b"]}", b","
_IS_STRUCTURE = np.zeros(256, bool)
_IS_STRUCTURE[list(b"[]{},")] = True
_DEEPER = np.zeros(256, np.int32)
_DEEPER[list(_OPEN)] = 1
_DEEPER[list(_CLOSE)] = -1
_BLANK = b" \t\r\n"

Read = Callable[[int, int], bytes]


@dataclass
class Structure:
    """Brackets and commas of a block outside of strings, and the state at its end."""

    places: np.ndarray
    chars: np.ndarray
    quotes: int
    inside: bool
    escaped: bool


def scan(block: bytes, inside: bool, escaped: bool) -> Structure:
    """The structure of a block that begins inside of a string or not, behind an odd run of backslashes or not."""
    raw = np.frombuffer(block, np.uint8)
    quotes = np.flatnonzero(raw == 0x22)
    slash = raw == 0x5C
    if slash.any() or escaped:
        index = np.arange(raw.size, dtype=np.int32)
        other = np.maximum.accumulate(np.where(slash, np.int32(-1), index)) if raw.size else index
        before = np.where(quotes > 0, other[quotes - 1], -1)
        run = quotes - 1 - before + np.where(before < 0, int(escaped), 0)
        quotes = quotes[run % 2 == 0]
        ending = raw.size - 1 - int(other[-1]) if raw.size else 0
        escaped = bool((ending + (int(escaped) if ending == raw.size else 0)) % 2)
    toggle = np.zeros(raw.size, np.uint8)
    toggle[quotes] = 1
    within = np.bitwise_xor.accumulate(toggle) ^ np.uint8(inside) if raw.size else toggle
    places = np.flatnonzero(_IS_STRUCTURE[raw] & (within == 0))
    return Structure(places, raw[places], len(quotes), bool((len(quotes) + inside) % 2), escaped)


def _odd_run(read: Read, at: int) -> bool:
    """Whether an odd number of backslashes stands directly before ``at``."""
    run = 0
    while at > 0:
        block = read(max(0, at - 4096), at)
        kept = len(block.rstrip(b"\\"))
        run += len(block) - kept
        if kept:
            break
        at -= len(block)
    return run % 2 == 1


def _blank_from(read: Read, at: int, size: int) -> bool:
    """Whether only white space follows."""
    return all(not read(i, min(i + STEP, size)).strip(_BLANK) for i in range(at, size, STEP))


def _elements(read: Read, size: int, begin: int, end: int, inside: bool, depth: int) -> Iterator[tuple[int, bytes | None, str]]:
    """(offset, bytes, problem) of the elements that begin in a range, and of faults of the structure."""
    escaped, at, limit = _odd_run(read, begin), begin, end
    # What is read for the last element grows with the element, not with the file.
    step = min(STEP, max(LEAST_STEP, (end - begin) // 8))
    began, first, parts, seen = -1, False, [], False
    while True:
        block = read(at, limit)
        found = scan(block, inside, escaped)
        after = depth + np.cumsum(_DEEPER[found.chars])
        before = after - _DEEPER[found.chars]
        comma = found.chars == _COMMA[0]
        edge = (comma & (after <= 1)) | (~comma & (np.minimum(before, after) <= 0))
        done = 0  # what of the block is dealt with
        outer = depth <= 0 and not inside
        for p, c, level in zip(found.places[edge].tolist(), found.chars[edge].tolist(), after[edge].tolist(), strict=True):
            here = at + p
            if outer and (rest := block[done:p].strip(_BLANK)):
                yield at + done, rest, "outside of an array"
            if c in _CLOSE or (c in _COMMA and level == 1):
                if began >= 0:
                    value = b"".join([*parts, block[max(done, began - at, 0) : p]])
                    if value.strip(_BLANK) or c in _COMMA or not first:
                        yield began, value, ""
                    began, parts = -1, []
                if here >= end:
                    return
                if c in _COMMA:
                    began, first = here + 1, False
                elif c != b"]"[0] or level < 0:
                    yield here, bytes([c]), "outside of an array"
            elif c in _OPEN and here < end:
                if c != b"["[0] or seen:
                    yield here, block[p : p + 200], "no array"
                began, first = here + 1, True
            elif here < end:
                yield here, bytes([c]), "outside of an array"
            done, outer, seen = p + 1, level <= 0, True
        if outer and at < end and (rest := block[done:].strip(_BLANK)):
            yield at + done, rest, "outside of an array"
        if begin == at == 0 and not seen and not block.strip(_BLANK) and _blank_from(read, limit, size):
            yield 0, b"", "no array"
        if began < 0:
            return
        parts.append(block[max(done, began - at, 0) :])
        inside, escaped, depth = found.inside, found.escaped, int(after[-1]) if len(after) else depth
        if limit >= size:
            yield began, b"".join(parts)[:200], "array not closed"
            return
        at, limit, step = limit, min(limit + step, size), min(2 * step, STEP)


_LINE_END = re.compile(rb"[\r\n]")


def _lines(read: Read, size: int, begin: int, end: int) -> Iterator[tuple[int, bytes]]:
    """(offset, bytes) of the lines that begin in a range; a line ends before a line feed or carriage return."""
    at, began, parts = max(begin - 1, 0), 0 if begin == 0 else -1, []
    limit = end
    while at < size:
        block = read(at, limit)
        done = 0
        for m in _LINE_END.finditer(block):
            if began >= 0:
                yield began, b"".join([*parts, block[done : m.start()]])
            done, parts, began = m.end(), [], at + m.end()
            if began >= end:
                return
        if began < 0:
            return
        parts.append(block[done:])
        at, limit = limit, min(limit + STEP, size)
    if began >= 0:
        yield began, b"".join(parts)


def _stream_lines(chunks: Iterator[bytes]) -> Iterator[tuple[int, bytes]]:
    """The lines of a stream, with their offsets in it."""
    began, parts, at = 0, [], 0
    for block in chunks:
        done = 0
        for m in _LINE_END.finditer(block):
            yield began, b"".join([*parts, block[done : m.start()]])
            done, parts, began = m.end(), [], at + m.end()
        parts.append(block[done:])
        at += len(block)
    yield began, b"".join(parts)


def file_ranges(files: DataFrame, size: int = RANGE) -> DataFrame:
    """(path, bytes, number, begin, end): ranges that cover each file of ``files`` (``path``, ``bytes``)."""
    count = F.greatest(F.ceil(F.col("bytes") / F.lit(size)), F.lit(1))
    numbered = files.select("path", F.col("bytes").cast("long").alias("bytes"), F.explode(F.sequence(F.lit(0).cast("long"), count - 1)).alias("number"))
    begin = F.col("number") * size
    return numbered.select("*", begin.alias("begin"), F.least(begin + size, F.col("bytes")).alias("end"))


def _opened(path: str):
    files, place = filesystem(path)
    return files.open_input_file(place)


def _reader(file) -> Read:
    def read(begin: int, end: int) -> bytes:
        out = file.read_at(end - begin, begin)
        if len(out) != end - begin:
            raise EOFError(f"{len(out)} of {end - begin} bytes at {begin}")
        return out

    return read


def _framed(rows: Iterator[tuple], columns: Sequence[str], chars: int = 8 << 20, most: int = 4096) -> Iterator[pd.DataFrame]:
    """Rows in frames of bounded size, whose last column but one may be a long text."""
    part, size = [], 0
    for row in rows:
        part.append(row)
        size += sum(len(x) for x in row if isinstance(x, str))
        if size >= chars or len(part) >= most:
            yield pd.DataFrame(part, columns=columns).convert_dtypes(dtype_backend="pyarrow")
            part, size = [], 0
    if part:
        yield pd.DataFrame(part, columns=columns).convert_dtypes(dtype_backend="pyarrow")


def _excerpt(value: bytes) -> str:
    return value[:400].decode("utf-8", "replace")[:50]


def _record_text(item: object, keys: Sequence[str]) -> str | None:
    """A string itself, or the value of the first of ``keys`` that an object has, if it is a string."""
    if isinstance(item, dict):
        item = next((item[k] for k in keys if k in item), None)
    if not isinstance(item, str):
        return None
    # A lone surrogate escape is no text that Spark could hold.
    return item.encode("utf-8", "surrogatepass").decode("utf-8", "replace")


_RECORD = ["source", "row_index", "text", "stage", "excerpt"]
_RECORD_SCHEMA = "source string, row_index long, text string, stage string, excerpt string"


def json_line_records(files: DataFrame, keys: Sequence[str] = RECORD_TEXT_KEYS, compressed: bool = False, size: int = RANGE) -> DataFrame:
    """(source, row_index, text, stage, excerpt): a row for each line of JSON Lines files, in one pass.

    ``row_index`` is the byte at which a line begins, in the decompressed file where there is compression.
    A line that holds no text has stage ``parse`` and its first fifty characters; a file that cannot
    be read, or read on, has stage ``read`` and the error. Blank lines are left out. Compressed files
    have no borders to begin at and are streamed by one task each.
    """
    ship_package(files.sparkSession)

    def judged(source: str, lines: Iterator[tuple[int, bytes]]) -> Iterator[tuple]:
        for at, line in lines:
            if not line.strip():
                continue
            try:
                text = _record_text(json.loads(line.decode()), keys)
            except (ValueError, RecursionError):
                text = None
            yield (source, at, text, None, None) if text is not None else (source, at, None, "parse", _excerpt(line))

    def ranges(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for r in batch.itertuples():
                yield from _framed(_safely(r.path, lambda r=r: _of_file(r.path, lambda f: judged(r.path, _lines(_reader(f), r.bytes, r.begin, r.end)))), _RECORD)

    def streams(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for path in batch["path"]:
                yield from _framed(_safely(path, lambda path=path: judged(path, _stream_lines(_decompressed(path)))), _RECORD)

    if compressed:
        return spread(files.select("path"), "path").mapInPandas(streams, _RECORD_SCHEMA)
    return spread(file_ranges(files, size), "path", "number").mapInPandas(ranges, _RECORD_SCHEMA)


def read_text_files(files: DataFrame, size: int = RANGE) -> tuple[DataFrame, DataFrame]:
    """Documents of text files, one per line that is not blank, trimmed; and what could not be read.

    ``row_index`` is the byte at which a line begins. A line that is no UTF-8 is refused alone.
    """
    ship_package(files.sparkSession)

    def judged(source: str, lines: Iterator[tuple[int, bytes]]) -> Iterator[tuple]:
        for at, line in lines:
            try:
                if text := line.decode().strip():
                    yield source, at, text, None, None
            except UnicodeDecodeError:
                yield source, at, None, "parse", _excerpt(line)

    def ranges(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for r in batch.itertuples():
                yield from _framed(_safely(r.path, lambda r=r: _of_file(r.path, lambda f: judged(r.path, _lines(_reader(f), r.bytes, r.begin, r.end)))), _RECORD)

    rows = spread(file_ranges(files, size), "path", "number").mapInPandas(ranges, _RECORD_SCHEMA)
    ok = F.col("stage").isNull()
    return rows.where(ok).select("source", "row_index", "text"), rows.where(~ok).select("source", "stage", "excerpt")


def _of_file(path: str, rows: Callable) -> Iterator[tuple]:
    with _opened(path) as file:
        yield from rows(file)


def _decompressed(path: str) -> Iterator[bytes]:
    files, place = filesystem(path)
    with files.open_input_stream(place, compression="zstd") as stream:
        while block := stream.read(STEP):
            yield block


def _safely(source: str, rows: Callable[[], Iterator[tuple]]) -> Iterator[tuple]:
    """The rows, and in place of an error the row that tells of it."""
    try:
        yield from rows()
    except Exception as error:  # whatever a broken file raises becomes its row
        yield source, None, None, "read", described(error)


def json_array_records(files: DataFrame, size: int = RANGE) -> tuple[DataFrame, DataFrame]:
    """Documents (source, row_index, text) of JSON array files of any size, and refused (source, stage, excerpt).

    A file has to be one array, of strings only or of objects only; any other file is refused as a
    whole, with stage ``parse``. ``row_index`` is the position in the array. Objects without ``text`` are left
    out; those whose text is no string are refused one by one. A file that cannot be read has stage
    ``read``. Elements are parsed once, into a table that both halves are made of.
    """
    ship_package(files.sparkSession)
    ranges = file_ranges(files, size)

    def sums(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            yield pd.DataFrame([_summed(*r) for r in batch[["path", "number", "begin", "end"]].itertuples(index=False)], columns=["path", "number", "quotes", "out", "in"])

    summed = spread(ranges, "path", "number").mapInPandas(sums, "path string, number long, quotes long, out long, in long")
    summed = materialize(summed, "ranges")
    inside = ordered_sums(summed, "path", "number", {"quotes_before": F.col("quotes")})
    inside = inside.withColumn("inside", F.col("quotes_before") % 2 == 1)
    states = ordered_sums(inside, "path", "number", {"depth": F.when(F.col("inside"), F.col("in")).otherwise(F.col("out"))})
    ready = ranges.join(states.select("path", "number", "inside", "depth"), ["path", "number"])

    def of_range(r) -> Iterator[tuple]:
        return _parsed(r.path, r.number, lambda f: enumerate(_elements(_reader(f), r.bytes, r.begin, r.end, bool(r.inside), int(r.depth))))

    def parse(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            # Ranges share frames, as a short one has but a few rows.
            rows = chain.from_iterable(of_range(r) for r in batch.itertuples())
            yield from _framed(rows, ["source", "number", "position", "at", "kind", "text", "excerpt"])

    schema = "source string, number long, position long, at long, kind string, text string, excerpt string"
    records = materialize(spread(ready, "path", "number").mapInPandas(parse, schema), "records")

    worst = records.groupBy("source").agg(
        F.min_by("excerpt", F.when(F.col("kind") == "read", F.struct("number", "position"))).alias("unread"),
        F.min_by("excerpt", F.when(~F.col("kind").isin("string", "object", "read"), F.struct("number", "position"))).alias("odd"),
        F.count_if(F.col("kind") == "string").alias("strings"), F.count_if(F.col("kind") == "object").alias("objects"),
        F.min_by("excerpt", F.struct("number", "position")).alias("any"),
    )
    mixed = (F.col("strings") > 0) & (F.col("objects") > 0)
    stage = F.when(F.col("unread").isNotNull(), "read").when(F.col("odd").isNotNull() | mixed, "parse")
    verdict = worst.select("source", stage.alias("stage"), F.coalesce("unread", "odd", "any").alias("excerpt"))
    bad = verdict.where("stage IS NOT NULL")
    held = records.groupBy("source", "number").agg(F.count("*").alias("held"))
    bases = ordered_sums(held, "source", "number", {"base": F.col("held")}).select("source", "number", "base")
    kept = records.where("kind IN ('string', 'object')").join(bad.select("source"), "source", "left_anti").join(bases, ["source", "number"])
    docs = kept.where("text IS NOT NULL").select("source", (F.col("base") + F.col("position")).alias("row_index"), "text")
    single = kept.where("text IS NULL AND excerpt IS NOT NULL").select("source", F.lit("parse").alias("stage"), "excerpt")
    return docs, bad.unionByName(single)


def _summed(path: str, number: int, begin: int, end: int) -> tuple:
    """A range's quotes and changes of depth; zeros where it cannot be read, which the next pass reports."""
    try:
        with _opened(path) as file:
            read = _reader(file)
            escaped, block = _odd_run(read, begin), read(begin, end)
            out = scan(block, False, escaped)
            within = scan(block, True, escaped)
        return path, number, out.quotes, int(_DEEPER[out.chars].sum()), int(_DEEPER[within.chars].sum())
    except Exception:
        return path, number, 0, 0, 0


def _parsed(source: str, number: int, rows: Callable) -> Iterator[tuple]:
    try:
        with _opened(source) as file:
            for i, (at, value, problem) in rows(file):
                if problem:
                    yield source, number, i, at, "odd", None, f"{problem}: {_excerpt(value)}"
                    continue
                try:
                    item = json.loads(value.decode())
                except (ValueError, RecursionError):
                    item = None
                if isinstance(item, str):
                    yield source, number, i, at, "string", _record_text(item, ()), _excerpt(value)
                elif isinstance(item, dict):
                    missing = "text" not in item
                    yield source, number, i, at, "object", _record_text(item, ("text",)), None if missing else _excerpt(value)
                else:
                    yield source, number, i, at, "other", None, _excerpt(value)
    except Exception as error:  # whatever a broken file raises becomes its row
        yield source, number, 0, 0, "read", None, described(error)

"""JSON arrays read element by element, however large the file is, as a batch or as a stream.

Spark's text reader unpacks a file bit by bit and cuts it at every closing brace; one task gets the parts of a gzip file in
order and puts the array's elements together from them. It holds one element at a time. A damaged element is rejected and
the rest of the file is read. (``files.read_json_array`` rejects a file with any damage as a whole.)
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from shelfseek.sources.files import BAD_FILE, BAD_LINE, NOT_OBJECT

CUT_SHORT = "array_not_closed"
TOO_LONG = "element_too_long"
# Characters of the longest element that is put together, and what is shown of a longer one.
MAX_ELEMENT = 64 << 20
SHOWN = 1000
ROWS_AT_ONCE = 1000

OPTIONS = {"lineSep": "}", "ignoreCorruptFiles": "true"}

IN_TEXT = re.compile(r'["\\]')
INSIDE = re.compile(r'["{}\[\]]')
BETWEEN = re.compile(r'["{}\[\],]')


class ArraySplitter:
    """Elements of one JSON array from its text in parts: ``feed`` gives those that end in a part, ``finish`` what is
    left over. Each is a text and a reason to reject it, None if there is none yet."""

    def __init__(self, longest: int = MAX_ELEMENT):
        self.longest = longest
        self.depth, self.in_text, self.escaped, self.broken = 0, False, False, False
        self.held: list[str] = []
        self.size = 0
        self.skipping = False

    def keep(self, text: str) -> None:
        if self.skipping or not text:
            return
        self.held.append(text)
        self.size += len(text)
        if self.size > self.longest:
            self.held, self.skipping = ["".join(self.held)[:SHOWN]], True

    def flush(self) -> Iterator[tuple[str, str | None]]:
        text, skipped = "".join(self.held).strip(), self.skipping
        self.held, self.size, self.skipping = [], 0, False
        if text:
            yield text, TOO_LONG if skipped else None

    def feed(self, text: str) -> Iterator[tuple[str, str | None]]:
        at, start = 0, 0
        while at < len(text):
            if self.broken:
                self.keep(text[start:])
                return
            if self.escaped:
                self.escaped = False
                at += 1
                continue
            found = (IN_TEXT if self.in_text else BETWEEN if self.depth <= 1 else INSIDE).search(text, at)
            if self.depth == 0 and text[at : found.start() if found else None].strip():
                self.broken = True
                continue
            if found is None:
                break
            sign, at = found.group(), found.end()
            if self.in_text:
                self.escaped = sign == "\\"
                self.in_text = sign != '"'
                if self.escaped:
                    self.in_text = True
            elif self.depth == 0:
                if sign != "[":
                    self.broken = True
                else:
                    self.depth, start = 1, at
            elif sign == '"':
                self.in_text = True
            elif sign == "," and self.depth == 1:
                self.keep(text[start : at - 1])
                yield from self.flush()
                start = at
            elif sign in "{[":
                self.depth += 1
            elif sign in "}]":
                self.depth -= 1
                if self.depth == 0:
                    self.keep(text[start : at - 1])
                    yield from self.flush()
                    start = at
        if self.depth or self.broken:
            self.keep(text[start:])

    def finish(self) -> Iterator[tuple[str, str | None]]:
        reason = BAD_FILE if self.broken else CUT_SHORT if self.depth else None
        left = list(self.flush())
        # A file that ends between two elements has lost some as well.
        for text, why in left or ([("", None)] if reason else []):
            yield text, why or reason


def split_arrays(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Elements of the arrays whose parts, file by file, are rows of ``value`` and ``source_file``."""
    splitter, file = ArraySplitter(), None
    rows: list[tuple[str, str, str | None]] = []

    def made() -> pa.RecordBatch:
        columns = [pa.array(list(c), pa.string()) for c in zip(*rows, strict=True)] if rows else [pa.array([], pa.string())] * 3
        rows.clear()
        return pa.RecordBatch.from_arrays(columns, names=["value", "source_file", "reason"])

    for batch in batches:
        for text, source in zip(batch["value"].to_pylist(), batch["source_file"].to_pylist(), strict=True):
            if source != file:
                rows += [(*found[:1], file, found[1]) for found in splitter.finish()]
                splitter, file = ArraySplitter(), source
            else:
                # The brace at which the reader cut.
                text = "}" + text
            for element, reason in splitter.feed(text):
                rows.append((element, file, reason))
                if len(rows) >= ROWS_AT_ONCE:
                    yield made()
    rows += [(*found[:1], file, found[1]) for found in splitter.finish()]
    yield made()


def elements(parts: DataFrame) -> DataFrame:
    split = parts.select("value", F.col("_metadata.file_path").alias("source_file"))
    texts = split.mapInArrow(split_arrays, "value string, source_file string, reason string")
    parsed = F.try_parse_json("value")
    is_object = parsed.try_cast("map<string,variant>").isNotNull()
    reason = F.coalesce("reason", F.when(parsed.isNull(), BAD_LINE).when(~is_object, NOT_OBJECT))
    return texts.select(F.coalesce(F.to_json(parsed), "value").alias("value"), "source_file", reason.alias("reject_reason"))


def read_array_elements(spark: SparkSession, path: str) -> DataFrame:
    """(value, source_file, reject_reason) for each element of the gzipped arrays in ``path``. A file that cannot be
    unpacked to its end gives what was read of it, and a rejected row."""
    return elements(spark.read.options(**OPTIONS).text(path))


def stream_array_elements(spark: SparkSession, path: str, files_per_batch: int | None = None) -> DataFrame:
    """The same as a stream: files that come to ``path`` are read once each."""
    reader = spark.readStream.options(**OPTIONS)
    if files_per_batch:
        reader = reader.option("maxFilesPerTrigger", files_per_batch)
    return elements(reader.text(path))

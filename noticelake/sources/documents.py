"""Raw JSON documents read as streams, a record at a time.

A document is an object with a list of records in it, and may be far larger than a task's
memory. Its text is read in parts, split at commas; neighbours are joined to chunks of some size
where they are read, and the chunks of a file are put in order in one task. There a scanner checks the form of the document outside its records token by token,
and hands on each record's text as soon as it ends; it holds one record and one part at most.
Spark's JSON parser then reads each record, once, wherever that row goes.

A comma at the end of a file is seen from the file's size. Of several lists of records in one
object the last counts. A record above ``LIMIT`` harms itself alone: it is kept as null.
"""

from __future__ import annotations

import json
import re
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from noticelake.functions import is_object
from noticelake.operators.rules import first_code
from noticelake.schemas import RAW_FILE_ERROR_TEXTS
from noticelake.session import shared_dir

# A VARIANT holds 128 MiB; a little less, as the text and the value differ in size.
LIMIT = 120 << 20
HEAD = ("source_id", "collection_run_id", "saved_at", "pages_fetched", "record_count")
# Text of the head's values that is kept.
_HEAD_CHARS = 1 << 16
# Bytes of parts that travel as one.
_CHUNK = 1 << 18

_ESCAPES = r'\\(?:["\\/bfnrt]|u[0-9a-fA-F]{4})'
_STRING_BODY = rf'(?:[^"\\\x00-\x1f]|{_ESCAPES})*+'
_SCALAR = rf'"{_STRING_BODY}"|-?(?:0|[1-9]\d*)(?:\.\d+)?(?:[eE][+-]?\d+)?|true|false|null'
_TOKEN = re.compile(rf"[ \t\r\n]*(?:({_SCALAR})|([{{}}\[\]:,])|(\")|$)")
_BODY = re.compile(_STRING_BODY)
_ANY_BODY = re.compile(r'(?:[^"\\]|\\.)*+', re.S)
_WHOLE_SCALAR = re.compile(_SCALAR)
_STRUCTURE = re.compile(r'["{}\[\],]')
# What opens and closes nothing inside a record's object or list, whole strings too.
_LEVEL = re.compile(r'(?:[^"{}\[\]]++|"(?:[^"\\]|\\.)*+")*+', re.S)
_SPACE = " \t\r\n"


class Scanner:
    """Reads one document; ``feed`` it parts and take the records they complete, then ``finish``."""

    def __init__(self, limit: int = LIMIT):
        self.limit = limit
        self.broken = False
        self.stack: list[str] = []
        self.expects = "value"
        self.key = ""
        self.head: dict[str, str | None] = {}
        self.is_list, self.generation, self.n_records = False, 0, 0
        # A string that goes on in the next part, outside records.
        self.string: list[str] | None = None
        self.in_records = False
        self._new_record()

    def feed(self, text: str) -> Iterator[tuple[int, str | None]]:
        """``(place, text)`` of each record that ends here; text is None if it is too large."""
        at = 0
        while at < len(text) and not self.broken:
            if self.in_records:
                at, ended = self._scan(text, at)
                if ended and (found := self._record(text[at - 1] == "]")):
                    yield found
            else:
                at = self._token(text, at)

    def finish(self) -> bool:
        """Whether the document was one well-formed object."""
        return not self.broken and self.expects == "end" and self.string is None

    # --- Outside records

    def _token(self, text: str, at: int) -> int:
        if self.string is not None:
            end = _BODY.match(text, at).end()
            self._keep(text[at:end])
            if end == len(text):
                return end
            if text[end] != '"':
                self.broken = True
                return end
            token, self.string = "".join(self.string) + '"', None
            self._scalar(token)
            return end + 1
        match = _TOKEN.match(text, at)
        if match is None:
            self.broken = True
            return at
        scalar, mark, quote = match.groups()
        if scalar is not None:
            self._scalar(scalar)
        elif mark is not None:
            self._mark(mark)
        elif quote is not None:
            self.string = ['"']
        return match.end()

    def _keep(self, text: str) -> None:
        self.string.append(text if len(text) < _HEAD_CHARS else "")

    def _scalar(self, token: str) -> None:
        if token[0] == '"' and self.expects in ("key", "first_key"):
            self.key, self.expects = json.loads(token) if len(self.stack) == 1 else "", "colon"
        elif self.expects in ("value", "first_value") and self.stack:
            self._value(token)
            self._after_value()
        else:
            self.broken = True

    def _value(self, token: str | None) -> None:
        """A value begins; what it is matters if it belongs to the head or is called records."""
        if len(self.stack) == 1 and self.stack[0] == "{":
            if self.key in HEAD:
                self.head[self.key] = token if token and len(token) < _HEAD_CHARS else None
            elif self.key == "records":
                self.is_list = False

    def _mark(self, mark: str) -> None:
        top = self.stack[-1] if self.stack else ""
        if mark in "{[" and self.expects in ("value", "first_value") and (self.stack or mark == "{"):
            self._value(None)
            if mark == "[" and len(self.stack) == 1 and top == "{" and self.key == "records":
                self.is_list, self.in_records, self.n_records = True, True, 0
                self.generation += 1
                self._new_record()
            else:
                self.stack.append(mark)
                self.expects = "first_key" if mark == "{" else "first_value"
        elif mark == "}" and top == "{" and self.expects in ("comma", "first_key"):
            self.stack.pop()
            self._after_value()
        elif mark == "]" and top == "[" and self.expects in ("comma", "first_value"):
            self.stack.pop()
            self._after_value()
        elif mark == "," and self.expects == "comma":
            self.expects = "key" if top == "{" else "value"
        elif mark == ":" and self.expects == "colon":
            self.expects = "value"
        else:
            self.broken = True

    def _after_value(self) -> None:
        self.expects = "comma" if self.stack else "end"

    # --- Inside the list of records

    def _new_record(self) -> None:
        self.parts: list[str] = []
        self.size, self.lost, self.depth, self.values, self.inside = 0, False, 0, 0, False

    def _scan(self, text: str, at: int) -> tuple[int, bool]:
        """Goes on to the end of the record or of the text; the place after it, and whether the record ended."""
        start = at
        while at < len(text):
            if self.inside:
                at = _ANY_BODY.match(text, at).end()
                if at < len(text) and text[at] == "\\":
                    self.broken = True  # a part ends at a comma, which nothing escapes
                    return len(text), False
                if at < len(text):
                    self.inside, at = False, at + 1
                continue
            if self.depth > 0:
                at = _LEVEL.match(text, at).end()
            found = _STRUCTURE.search(text, at)
            if found is None:
                at = len(text)
                break
            mark, at = found[0], found.end()
            if mark == '"':
                self.inside = True
            elif mark in ",]" and self.depth == 0:
                self._add(text[start : at - 1])
                return at, True
            elif mark in "{[":
                self.depth += 1
            elif mark in "}]":
                self.depth -= 1
                self.values += self.depth == 0
        self._add(text[start:at])
        return at, False

    def _add(self, text: str) -> None:
        self.size += len(text)
        self.lost = self.lost or self.size > self.limit
        self.parts = [] if self.lost else [*self.parts, text] if len(self.parts) < 64 else ["".join([*self.parts, text])]

    def _record(self, last: bool) -> tuple[int, str | None] | None:
        text, lost, values, depth = "".join(self.parts).strip(_SPACE), self.lost, self.values, self.depth
        self._new_record()
        if last:
            self.in_records = False
            self._after_value()
        if not text and not lost:
            # Nothing between the brackets is an empty list; elsewhere a record is missing.
            self.broken = not (last and self.n_records == 0)
            return None
        if not lost:
            one = values == 1 and text[-1] in "}]" if text[0] in "{[" else _WHOLE_SCALAR.fullmatch(text)
            self.broken = depth != 0 or not one
        self.n_records += 1
        return None if self.broken else (self.n_records, None if lost else text)


_CHUNKED = "file long, block long, place long, size long, octets long, part string"


def _join_parts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Parts that stand together in a block become one part with its commas: few rows are dealt out."""
    for batch in batches:
        if not batch.num_rows:
            continue
        octets = batch.column("octets").to_numpy().astype(np.int64)
        groups = (batch.column("file").to_numpy(), batch.column("block").to_numpy(), np.cumsum(octets + 1) // _CHUNK)
        cuts = np.flatnonzero([True, *np.any([np.diff(g) != 0 for g in groups], axis=0)])
        ends = np.append(cuts, batch.num_rows)
        held = {name: batch.column(name).take(pa.array(cuts)) for name in ("file", "block", "place", "size")}
        held["octets"] = pa.array(np.add.reduceat(octets, cuts) + np.diff(ends) - 1)
        held["part"] = pc.binary_join(pa.ListArray.from_arrays(pa.array(ends, pa.int32()), batch.column("part")), ",")
        yield pa.record_batch(held)


_SCANNED = "file long, generation int, row_number long, text string, well_formed boolean, is_list boolean, " + ", ".join(
    f"{name} string" for name in HEAD
)
_NAMES = [part.split()[0] for part in _SCANNED.split(", ")]


def _scan_files(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The records of the files in a task, and a row without a place for each file."""
    types = {"long": pa.int64(), "int": pa.int32(), "string": pa.string(), "boolean": pa.bool_()}
    schema = pa.schema([(name, types[kind]) for name, kind in (part.split() for part in _SCANNED.split(", "))])
    file, scanner, missing, began = None, Scanner(), 0, False

    def made(rows: list[tuple]) -> pa.RecordBatch:
        return pa.record_batch([pa.array(column, t) for column, t in zip(zip(*rows), schema.types)], schema=schema)

    def record(found: tuple[int, str | None]) -> tuple:
        return (file, scanner.generation, *found, *[None] * 7)

    def ended() -> Iterator[tuple]:
        if missing == 1:
            yield from map(record, scanner.feed(","))
        yield file, scanner.generation, None, None, scanner.finish(), scanner.is_list, *[scanner.head.get(h) for h in HEAD]

    rows: list[tuple] = []
    held = 0
    for batch in batches:
        if not batch.num_rows:
            continue
        names, octets = batch.column("file").to_numpy(), batch.column("octets").to_numpy()
        # The parts of a file stand together.
        cuts = [0, *(np.flatnonzero(np.diff(names)) + 1).tolist(), batch.num_rows]
        texts = pc.binary_join(pa.ListArray.from_arrays(pa.array(cuts, pa.int32()), batch.column("part")), ",")
        for text, low, high in zip(texts, cuts, cuts[1:]):
            if names[low] != file:
                if file is not None:
                    rows += ended()
                file, scanner, began = int(names[low]), Scanner(), False
                size = batch.column("size")[low].as_py()
                missing = -1 if size is None else size + 1
            missing -= int(octets[low:high].sum(dtype=np.int64)) + high - low
            text, began = "," * began + text.as_py(), True
            for found in scanner.feed(text):
                rows.append(record(found))
                held += len(found[1] or "")
                if held > 4 << 20 or len(rows) > 10_000:
                    yield made(rows)
                    rows, held = [], 0
    if file is not None:
        rows += ended()
    if rows:
        yield made(rows)


@dataclass(frozen=True)
class Documents:
    """``usable``: the files with their head and ``found`` records; ``records``: ``path, source_id,
    collection_run_id, row_number, record``; ``unusable``: ``path, code, problem``.

    For work that meets the records once more anyway, ``scanned`` has those of all files, also of
    unusable ones and of lists that don't count: ``file, generation, row_number, record``. ``lists``
    says which count: ``file, generation, path, last``, where ``last`` is the greatest row number.
    """

    usable: DataFrame
    records: DataFrame
    unusable: DataFrame
    scanned: DataFrame
    lists: DataFrame


def read_files(spark: SparkSession, root: str, pattern: str) -> Documents:
    """All documents below ``root``."""
    options = {"recursiveFileLookup": True, "pathGlobFilter": pattern}
    listed = spark.read.format("binaryFile").options(**options).load(root)
    files = listed.select(F.col("_metadata.file_path").alias("path"), F.col("modificationTime").alias("modified_at"))
    parts = spark.read.options(**options, lineSep=",").text(root).select(
        F.xxhash64("_metadata.file_path").alias("file"),
        F.col("_metadata.file_block_start").alias("block"),
        F.monotonically_increasing_id().alias("place"),
        F.col("_metadata.file_size").alias("size"),
        F.col("value").alias("part"),
    )
    return judged(_fewer_tasks(files), _fewer_tasks(parts))


def _fewer_tasks(scanned: DataFrame) -> DataFrame:
    """Small files come with few to a task, each of which costs more than it reads; eight tasks for each core are kept."""
    tasks, cores = scanned.rdd.getNumPartitions(), scanned.sparkSession.sparkContext.defaultParallelism
    wanted = max(8 * cores, tasks // 16)
    return scanned.coalesce(wanted) if wanted < tasks else scanned


def read_texts(files: DataFrame) -> Documents:
    """Documents that are held as ``path, modified_at, body``."""
    parts = files.select(
        F.xxhash64("path").alias("file"),
        F.lit(0).cast("long").alias("block"),
        F.lit(None).cast("long").alias("size"),
        F.posexplode(F.split(F.coalesce("body", F.lit("")), ",", -1)).alias("place", "part"),
    )
    return judged(files.select("path", "modified_at"), parts)


def judged(files: DataFrame, parts: DataFrame) -> Documents:
    """``files``: ``path, modified_at``; ``parts``: ``file, block, place, size, part``."""
    shared_dir(files.sparkSession)
    measured = parts.select(
        "file", "block", F.col("place").cast("long").alias("place"), "size", F.octet_length("part").alias("octets"), "part"
    )
    ordered = (
        measured.mapInArrow(_join_parts, _CHUNKED)
        .repartition("file")
        .sortWithinPartitions("file", "block", "place")
        .select("file", "size", "octets", "part")
    )
    scanned = ordered.mapInArrow(_scan_files, _SCANNED)
    # Kept, as records go on only once their whole document is known to be good.
    kept = scanned.withColumn("record", F.try_parse_json("text")).withColumn(
        "malformed", F.col("text").isNotNull() & F.col("record").isNull()
    )
    kept = kept.drop("text").checkpoint()
    records = kept.where("row_number IS NOT NULL").select("file", "generation", "row_number", "record", "malformed")
    strange = F.col("record").isNotNull() & ~is_object(F.col("record"))
    checked = records.groupBy("file", "generation").agg(
        F.max("malformed").alias("malformed"), F.max(strange).alias("strange"), F.count("*").alias("found")
    )
    per_file = checked.groupBy("file").agg(
        F.max("malformed").alias("malformed"), F.max(F.struct("generation", "strange", "found")).alias("last")
    )
    heads = kept.where("row_number IS NULL").select("file", "generation", "well_formed", "is_list", *HEAD)
    known = files.withColumn("file", F.xxhash64("path")).join(heads, "file", "left").join(per_file, "file", "left")
    # The last list may be empty, after one that was not.
    current = F.coalesce(F.col("last.generation") == F.col("generation"), F.lit(False))
    rules = [
        ("not_json_object", ~F.coalesce("well_formed", F.lit(False)) | F.coalesce("malformed", F.lit(False))),
        ("records_not_list", ~F.col("is_list")),
        ("record_not_object", current & F.col("last.strange")),
    ]
    texts = F.create_map(*[F.lit(p) for pair in RAW_FILE_ERROR_TEXTS.items() for p in pair])
    coded = known.withColumn("code", first_code(rules)).withColumn("problem", F.try_element_at(texts, F.col("code")))
    # A row per file, kept as all three results look at it: the files are listed and judged once.
    coded = coded.checkpoint()
    good = coded.where("code IS NULL").select(
        "file",
        "generation",
        "path",
        "modified_at",
        _whole("source_id", "bigint"),
        _whole("collection_run_id", "bigint"),
        F.try_parse_json("saved_at").try_cast("string").try_cast("timestamp").alias("saved_at"),
        _whole("pages_fetched", "int"),
        _whole("record_count", "bigint"),
        F.when(current, F.col("last.found")).otherwise(0).alias("found"),
    )
    named = good.select("file", "generation", "path", "source_id", "collection_run_id")
    rows = records.join(named, ["file", "generation"]).select(
        "path", "source_id", "collection_run_id", "row_number", "record"
    )
    return Documents(
        good.drop("file", "generation"),
        rows,
        coded.where("code IS NOT NULL").select("path", "code", "problem"),
        records.select("file", "generation", "row_number", "record"),
        good.select("file", "generation", "path", F.col("found").alias("last")),
    )


def _whole(name: str, kind: str) -> Column:
    """A number of the head, null if it is none."""
    return F.when(F.col(name).rlike(r"^-?\d+$"), F.col(name)).try_cast(kind).alias(name)

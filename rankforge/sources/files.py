"""Landing-folder sources and sinks: JSON documents in time-stamped pull folders.

Two layouts, which the writer and the reader of a folder both name. ``lines`` holds one
document per line, many in a file: files split, and their number does not follow the number of
documents. ``document`` holds one (multi-line) document per file, as some sources deliver it:
such a file is one row and one task cannot share it. Bronze keeps the payload object as raw
JSON text plus load metadata; silver parses it with the declared schema.
"""

from __future__ import annotations

import datetime as _dt
import json
import os
import re
import shutil
import uuid
from collections.abc import Iterator
from urllib.parse import quote

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .. import schemas

# File-name stamp of a landing file and its parse pattern.
STAMP_FORMAT = "%Y%m%d_%H%M%S"
STAMP_REGEX = r"_(\d{8}_\d{6})(?:\.json$|/)"
STAMP_PATTERN = "yyyyMMdd_HHmmss"


# Fixed value: name filter of landing files.
FILE_FILTER = "*.json"

# The layouts of a landing folder, and the most files that one stream
# micro-batch takes of each (the driver plans and logs the file list of a batch; a larger pull
# is cut into several batches, which gives the same tables).
LAYOUTS = {"lines": 1_000, "document": 100_000}

# What opening a local file counts for, in bytes read, and the most files of a list
# that a task reads at once.
FILE_COST = 16 * 1024
FILES_LISTED = 100

# Settings under which only Spark's reader does as they say.
READER_SETTINGS = {"spark.sql.files.ignoreMissingFiles": "true", "spark.sql.files.ignoreCorruptFiles": "true",
                   "spark.sql.json.enableExactStringParsing": "false"}


def _check(layout: str) -> None:
    if layout not in LAYOUTS:
        raise ValueError(f"layout must be one of {', '.join(LAYOUTS)}, not {layout!r}")


def _landing_options(reader, layout: str, file_filter: str = FILE_FILTER):
    """Every ``*.json`` file below the landing folder, pull folders included. A recursive
    directory listing with a name filter, not a path glob: a glob stats every file one by
    one on the driver (8 s for 5,000 files here, against 0.2 s)."""
    _check(layout)
    return (reader.option("multiLine", layout == "document").option("recursiveFileLookup", True)
            .option("pathGlobFilter", file_filter))


def _schema(dataset: str, as_text: bool, corrupt: bool, parsed: bool = False) -> T.StructType:
    found = schemas.landing_schema(dataset, as_text, parsed)
    return T.StructType([*found.fields, T.StructField("_corrupt_record", T.StringType())]) if corrupt else found


def read_landing(spark: SparkSession, landing_dir: str, dataset: str = "encounters",
                 as_text: bool = True, layout: str = "lines", file_filter: str = FILE_FILTER,
                 corrupt: bool = False, parsed: bool = False) -> DataFrame:
    """Batch scan of every landing file (A1). Declared schema, never inferred. With ``corrupt`` the
    text of what is no JSON comes in the column ``_corrupt_record`` (see ``plans.quarantine``).
    With ``parsed`` the payload comes as a VARIANT, parsed here once for all later hops.

    Payloads kept as text, one document per file, on a local (or mounted) file system: tasks read
    lists of files, and the driver plans lists, not files (see :func:`_read_document_files`)."""
    if layout == "document" and as_text and file_filter == FILE_FILTER and not (corrupt or parsed):
        found = _read_document_files(spark, landing_dir, schemas.PAYLOADS[dataset][0])
        if found is not None:
            return found
    reader = spark.read.schema(_schema(dataset, as_text, corrupt, parsed))
    return _landing_options(reader, layout, file_filter).json(landing_dir.rstrip("/"))


def stream_landing(spark: SparkSession, landing_dir: str, dataset: str = "encounters",
                   as_text: bool = True, layout: str = "lines", max_files_per_trigger: int | None = None,
                   file_filter: str = FILE_FILTER, corrupt: bool = False, parsed: bool = False) -> DataFrame:
    """Incremental file stream (A2): each file is picked up once; the checkpoint of the
    query that consumes this frame records which files were seen. A run to completion
    (``availableNow``) takes at most ``max_files_per_trigger`` files (by default those of the
    layout) per micro-batch."""
    reader = _landing_options(spark.readStream.schema(_schema(dataset, as_text, corrupt, parsed)), layout, file_filter)
    most = max_files_per_trigger or LAYOUTS[layout]
    return reader.option("maxFilesPerTrigger", most).json(landing_dir.rstrip("/"))


def stamp_from_file_name() -> Column:
    """Load time taken from the stamp in the file (or pull folder) name: deterministic
    across replays."""
    stamp = F.regexp_extract(F.col("_metadata.file_path"), STAMP_REGEX, 1)
    return F.to_timestamp(F.nullif(stamp, F.lit("")), STAMP_PATTERN)


def attach_metadata(df: DataFrame, source: str, ldts: Column | None = None) -> DataFrame:
    """Add ``ldts`` (load time; ``current_timestamp()`` unless given) and ``rsrc`` (A3)."""
    return df.withColumns({"ldts": ldts if ldts is not None else F.current_timestamp(),
                           "rsrc": F.lit(source)})


def bronze(df: DataFrame, source: str, ldts: Column | None = None) -> DataFrame:
    return attach_metadata(df, source, ldts)


def preview_sql(spark: SparkSession, landing_dir: str, source: str, drop: str = "_corrupt_record",
                view: str = "landing_preview", n: int = 5, order: list[str] = (), layout: str = "lines",
                file_filter: str = FILE_FILTER, schema: T.StructType | None = None,
                sampling_ratio: float | None = None) -> DataFrame:
    """SQL preview (A4): all columns except one, plus load metadata, first ``n`` rows in the
    order of the SQL expressions ``order`` (any rows without one).

    The landing folder is exposed as a temporary view ``USING json``. Pass the declared
    ``schema``: without it Spark infers one by reading the files (all of them, or a
    ``sampling_ratio`` share), a full extra pass over a large landing folder."""
    _check(layout)
    path = landing_dir.rstrip("/").replace("'", "\\'")
    columns = ""
    if schema is not None:
        columns = "(" + ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in schema.fields) + ") "
    ratio = f", samplingRatio '{float(sampling_ratio)}'" if sampling_ratio and schema is None else ""
    multi = "true" if layout == "document" else "false"
    spark.sql(f"CREATE OR REPLACE TEMPORARY VIEW {view} {columns}USING json "
              f"OPTIONS (path '{path}', multiLine '{multi}', recursiveFileLookup 'true', "
              f"pathGlobFilter '{file_filter}'{ratio})")
    star = f"* EXCEPT (`{drop}`)" if drop in spark.table(view).columns else "*"
    src = source.replace("'", "''")
    by = f"ORDER BY {', '.join(order)} " if order else ""
    return spark.sql(f"SELECT {star}, current_timestamp() AS ldts, '{src}' AS rsrc "
                     f"FROM {view} {by}LIMIT {int(n)}")


def landing_file_name(name: str, when: _dt.datetime | None = None) -> str:
    when = when or _dt.datetime.now(_dt.timezone.utc)
    return f"{name}_{when.strftime(STAMP_FORMAT)}.json"


def write_landing(docs: DataFrame, landing_dir: str, name: str, when: _dt.datetime | None = None,
                  layout: str = "lines") -> str:
    """JSON sink (A10): a time-stamped pull folder, appended, never overwriting an older
    pull; written in parallel by every task, as lines (a file per task) or one document per
    file."""
    _check(layout)
    target = f"{landing_dir.rstrip('/')}/{landing_file_name(name, when)[:-5]}"
    writer = docs.write.mode("append")
    if layout == "document":
        folder = _local_folder(docs.sparkSession, target)
        if folder is not None:
            _write_document_files(docs, folder)
            return target
        writer = writer.option("maxRecordsPerFile", 1)
    writer.json(target)
    return target


def _local_folder(spark: SparkSession, path: str) -> str | None:
    """The folder itself where ``path`` is one of the local (or a mounted, shared) file system."""
    place = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    fs = place.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    return place.toUri().getPath() if fs.getUri().getScheme() == "file" else None


def _write_document_files(docs: DataFrame, target: str) -> None:
    """One document per file below a folder of the local file system, where Spark's writer starts
    two processes (``chmod``) per file and the driver moves file by file. Each task writes a folder
    of its own, hidden until all tasks have ended; the driver moves one folder per task."""
    run = uuid.uuid4().hex[:12]
    staged = f"{target}/_temporary-{run}"

    def write(batches):
        task = TaskContext.get()
        folder, files = f"{staged}/{task.taskAttemptId()}", 0
        for batch in batches:
            if batch.num_rows:
                os.makedirs(folder, exist_ok=True)
            for text in batch.column(0).to_pylist():
                with open(f"{folder}/part-{task.partitionId():05d}-c{files:06d}.json", "wb") as out:
                    out.write(text + b"\n")
                files += 1
        if files:
            yield pa.RecordBatch.from_pydict({"folder": [folder], "part": [task.partitionId()]},
                                             pa.schema([("folder", pa.string()), ("part", pa.int32())]))

    columns = ["`" + c.replace("`", "``") + "`" for c in docs.columns]
    os.makedirs(staged)
    try:
        written = (docs.select(F.to_json(F.struct(*columns)).cast("binary").alias("text"))
                   .mapInArrow(write, "folder string, part int").collect())
        for row in written:
            os.rename(row.folder, f"{target}/part-{row.part:05d}-{run}")
        open(f"{target}/_SUCCESS", "wb").close()
    finally:
        shutil.rmtree(staged, ignore_errors=True)


def _document_lists(folder: str, most: int) -> Iterator[tuple[str, list[str], int]]:
    """The landing files below a folder as lists (folder, names, cost in bytes) of up to
    ``FILES_LISTED`` files and about ``most`` bytes, without those that Spark takes for hidden. A
    checksum file raises ``LookupError``: Hadoop's file system compares it with its file."""
    folders = [folder]
    while folders:
        at, names, cost = folders.pop(), [], 0
        with os.scandir(at) as entries:
            for entry in entries:
                if entry.name.startswith(".") and entry.name.endswith(".json.crc"):
                    raise LookupError(entry.path)
                hidden = entry.name.startswith(".") or entry.name.startswith("_") and "=" not in entry.name
                if entry.is_dir():
                    if not entry.name.endswith("._COPYING_") and (
                            not hidden or entry.name.startswith(("_metadata", "_common_metadata"))):
                        folders.append(entry.path)
                elif entry.name.endswith(FILE_FILTER[1:]) and not hidden:
                    try:
                        cost += entry.stat().st_size + FILE_COST
                    except FileNotFoundError:        # gone since, as in Spark's listing
                        continue
                    names.append(entry.name)
                    if len(names) == FILES_LISTED or cost >= most:
                        yield at, names, cost
                        names, cost = [], 0
        if names:
            yield at, names, cost


def _document_reader(column: str):
    """What a task does with lists of files: ``value`` is the top-level field ``column`` of each
    document, an object as it stands in the file. What is no plain JSON or beyond the limits of
    Spark's parser (Jackson's: 1,000 levels, numbers of 1,000 digits) goes out whole in ``odd``, for
    that parser to tell (it writes the object anew). As with Spark's reader a blank file gives no row,
    and one in no Unicode encoding a null, as an object in UTF-16 or UTF-32 does."""
    blank, scanstring = json.decoder.WHITESPACE.match, json.decoder.scanstring
    long_number, two = re.compile("[0-9]{1001}").search, re.compile("[0-9]{2}").search
    escaped = re.compile(r"[\x00-\x20\"#%<>?\[\\\]^`{|}\x7f-\xa0]")
    schema = pa.schema([("value", pa.string()), ("odd", pa.string()), ("file_path", pa.string()), ("file_name", pa.string()),
                        ("file_size", pa.int64()), ("modified", pa.int64())])

    def check_depth(value):
        level, depth = [value], 0
        while level := [x for v in level if isinstance(v, dict | list) for x in (v.values() if isinstance(v, dict) else v)]:
            depth += 1
            if depth > 990:
                raise ValueError("too deep")

    def field(text, at, scan, exact):
        """Of the object that begins at ``at``: the field, and where the object ends."""
        found, more = None, text[at] == "{"
        at = blank(text, at + 1).end()
        if more and text[at] == "}":
            return None, at + 1
        while more:
            if text[at] != '"':
                raise ValueError("no field name")
            name, at = scanstring(text, at + 1, True)
            at = blank(text, at).end()
            if text[at] != ":":
                raise ValueError("no value")
            begin = blank(text, at + 1).end()
            value, at = scan(text, begin)
            if text.count("[", begin, at) + text.count("{", begin, at) > 990:
                check_depth(value)
            if name == column:
                found = value if value is None or isinstance(value, str) else text[begin:at] if exact else None
            at = blank(text, at).end()
            if text[at] == "}":
                return found, at + 1
            more, at = text[at] == ",", blank(text, at + 1).end()
        raise ValueError("no object")

    def fields(text, scan, exact):
        if two(text[::500]) and long_number(text):   # a number that long has two of every 500th letters
            raise ValueError("a long number")
        at = blank(text, 0).end()
        if text[at] != "[":
            return [field(text, at, scan, exact)[0]]
        found, at = [], blank(text, at + 1).end()
        more = text[at] != "]"
        while more:
            value, at = field(text, at, scan, exact)
            found.append(value)
            at = blank(text, at).end()
            more = text[at] == ","
            if not more and text[at] != "]":
                raise ValueError("no list")
            at = blank(text, at + 1).end()
        return found

    def read(batches):
        scan = json.JSONDecoder().scan_once
        for batch in batches:
            for folder, names in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                rows = []
                for name in names:
                    with open(f"{folder}/{name}", "rb") as source:
                        data, changed = source.read(), os.fstat(source.fileno()).st_mtime_ns
                    path = "file:" + escaped.sub(lambda found: quote(found[0]), f"{folder}/{name}")
                    about = path, path.rpartition("/")[2], len(data), changed // 1_000_000
                    try:
                        text = data.decode(code := "utf-8" if len(data) == 3 else json.detect_encoding(data))
                    except UnicodeDecodeError:
                        rows.append((None, None, *about))
                        continue
                    if text.strip(" \t\r\n"):
                        try:
                            rows += [(None if v is None else v.encode("utf-8", "replace"), None, *about)
                                     for v in fields(text, scan, code.startswith("utf-8"))]
                        except (ValueError, IndexError, StopIteration, RecursionError):
                            rows.append((None, text, *about))
                columns = zip(*rows) if rows else [()] * len(schema)
                yield pa.RecordBatch.from_arrays([pa.array(list(c), k.type) for c, k in zip(columns, schema)], schema=schema)

    return read


def _read_document_files(spark: SparkSession, landing_dir: str, column: str) -> DataFrame | None:
    """The rows of Spark's multi-line reader over the documents below a folder of the local file
    system (else None). That reader keeps the status of every file on the driver and counts a file
    as 4 MB, so that a task gets a few documents; here the driver keeps names, in lists, and a task
    gets files for ``spark.sql.files.maxPartitionBytes``, an open file counted as ``FILE_COST``."""
    from ..operators.nested import explode_records

    folder = _local_folder(spark, landing_dir.rstrip("/"))
    if folder is None or not os.path.isdir(folder) or set(folder) & set("{}[]*?\\"):
        return None
    if any(spark.conf.get(name).lower() == value for name, value in READER_SETTINGS.items()):
        return None
    size = spark.sparkContext._jvm.org.apache.spark.network.util.JavaUtils.byteStringAsBytes(
        spark.conf.get("spark.sql.files.maxPartitionBytes"))
    kept, part, costs = [], [], 0
    kind = pa.schema([("folder", pa.string()), ("names", pa.list_(pa.string()))])
    try:
        for at, names, cost in _document_lists(os.path.abspath(folder), max(size // 8, 1)):
            part.append({"folder": at, "names": names})
            costs += cost
            if len(part) == 1_000:
                kept.append(pa.RecordBatch.from_pylist(part, kind))
                part = []
    except LookupError:
        return None
    table = pa.Table.from_batches([*kept, pa.RecordBatch.from_pylist(part, kind)], kind)
    tasks = min(max(spark.sparkContext.defaultParallelism, -(-costs // size)), max(table.num_rows, 1))
    read = (spark.createDataFrame(table).repartition(tasks)
            .mapInArrow(_document_reader(column), "value string, odd string, file_path string, file_name string, "
                                                  "file_size bigint, modified bigint"))
    name = "`" + column + "`"
    whole = F.transform(F.from_json("odd", f"array<struct<{name} string>>"), lambda d: d[column])
    found = F.when(F.col("odd").isNull(), F.array("value")).otherwise(whole)
    about = F.struct("file_path", "file_name", "file_size", F.lit(0).cast("bigint").alias("file_block_start"),
                     F.col("file_size").alias("file_block_length"),
                     F.timestamp_millis("modified").alias("file_modification_time"))
    rows = explode_records(read.select(F.coalesce(found, F.array(F.lit(None).cast("string"))).alias("_found"), about.alias("_about")),
                           "_found", column, carry=["_about"])
    return _hide_metadata(rows.select(column, F.col("_about").alias("_metadata", metadata={"__metadata_col": "_metadata"})))


def _hide_metadata(rows: DataFrame) -> DataFrame:
    """The frame without its last column, ``_metadata``, which can be named all the same, as the one
    that Spark's file scans have: hidden output of the projection, as a natural join has it."""
    shown = rows.select(*rows.columns[:-1])
    plan = shown._jdf.queryExecution().analyzed()
    known = plan.child().output()
    hidden = rows.sparkSession.sparkContext._jvm.org.apache.spark.sql.catalyst.plans.logical.Project.hiddenOutputTag()
    plan.setTagValue(hidden, known.drop(known.size() - 1))
    return shown


def raw_preview(docs: DataFrame, dataset: str = "guilds", n: int = 3) -> DataFrame:
    """Envelope of each document with only the first ``n`` records (A12), parsed with the
    declared schema, one row per document; other columns of ``docs`` are kept."""
    from ..operators.nested import slice_records

    column, payload = schemas.PAYLOADS[dataset]
    array_path = {"guilds": "guilds.data", "encounters": "encounter.characterRankings.rankings",
                  "reports": "reports.data"}[dataset]
    parsed = docs.withColumn(column, F.from_json(F.col(column), payload))
    return slice_records(parsed, f"{column}.{array_path}", n)

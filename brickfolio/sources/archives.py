"""Archives of archives, read on the executors one file per row.

Input is the shape of ``spark.read.format("binaryFile")``: ``path`` and
``content``. Members are streamed out record by record, so a task never holds
more than one archive and one piece of a member.
"""

from __future__ import annotations

import io
import re
import shutil
import tempfile
import zipfile
import zlib
from collections.abc import Callable, Iterator
from typing import BinaryIO

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from brickfolio.functions import columns as X

_PIECE = 1 << 20
_ROWS = 2000


def read_archives(spark: SparkSession, path: str, pattern: str = "*.zip") -> DataFrame:
    return spark.read.format("binaryFile").option("pathGlobFilter", pattern).option(
        "recursiveFileLookup", "true").load(path).select("path", "content")


def _members(blob: bytes | BinaryIO, prefix: str = "") -> Iterator[tuple[str, zipfile.ZipExtFile]]:
    """Open every file inside an archive, going into archives inside it."""
    with zipfile.ZipFile(blob if hasattr(blob, "read") else io.BytesIO(blob)) as outer:
        for name in sorted(outer.namelist()):
            if name.lower().endswith(".zip"):
                # on disk, as an archive may be as large as the one around it
                with tempfile.TemporaryFile() as inner:
                    with outer.open(name) as handle:
                        shutil.copyfileobj(handle, inner, _PIECE)
                    yield from _members(inner, f"{prefix}{name}/")
            elif not name.endswith("/"):
                with outer.open(name) as handle:
                    yield prefix + name, handle


def _guarded(path: str, content: pa.Scalar, errors: bool, read: Callable[[BinaryIO], Iterator[pa.RecordBatch]]) -> Iterator[pa.RecordBatch]:
    """The batches of one archive; with ``errors`` one that cannot be read ends in a row that says why."""
    try:
        # read where it lies: a copy would hold the archive twice
        for out in read(pa.BufferReader(content.as_buffer()) if content.is_valid else io.BytesIO()):
            yield out.append_column("error", pa.nulls(out.num_rows, pa.string())) if errors else out
    except (zipfile.BadZipFile, zlib.error, EOFError, UnicodeDecodeError, LookupError, NotImplementedError) as problem:
        if not errors:
            raise
        yield pa.RecordBatch.from_pydict({"path": [path], "error": [f"{type(problem).__name__}: {problem}"]},
                                         schema=pa.schema([("path", pa.string()), ("error", pa.string())]))


def _per_archive(archives: DataFrame, schema: str, errors: bool, read: Callable[[str, BinaryIO], Iterator[pa.RecordBatch]]) -> DataFrame:
    """Applies ``read`` to each archive of (path, content). ``schema`` begins with path; a broken archive has nulls beside its error."""
    wanted = schema + (", error string" if errors else "")
    names = [part.split()[0] for part in wanted.split(", ")]
    kinds = {"string": pa.string(), "binary": pa.binary()}
    types = [kinds[part.split()[1]] for part in wanted.split(", ")]

    def run(batches):
        for batch in batches:
            for path, content in zip(batch.column("path").to_pylist(), batch.column("content")):
                for out in _guarded(path, content, errors, lambda blob, path=path: read(path, blob)):
                    yield pa.record_batch([out.column(n) if n in out.schema.names else pa.nulls(out.num_rows, t) for n, t in zip(names, types)], names)

    return archives.select("path", "content").mapInArrow(run, wanted)


def members(archives: DataFrame, errors: bool = False) -> DataFrame:
    """(path, member, content) for the files of each archive; ``errors`` adds a row with ``error`` for a broken archive."""
    def read(path: str, blob: BinaryIO) -> Iterator[pa.RecordBatch]:
        for name, handle in _members(blob):
            yield pa.RecordBatch.from_pydict(
                {"path": [path], "member": [name], "content": [handle.read()]},
                schema=pa.schema([("path", pa.string()), ("member", pa.string()), ("content", pa.binary())]))
    return _per_archive(archives, "path string, member string, content binary", errors, read)


def xml_records(archives: DataFrame, tag: str, errors: bool = False) -> DataFrame:
    """(path, member, record): the text of each ``tag`` element of the XML members; ``errors`` as in ``members``."""
    opening = re.compile(rb"<(?:[\w.-]+:)?" + tag.encode() + rb"[\s>/]")
    closing = re.compile(rb"</(?:[\w.-]+:)?" + tag.encode() + rb"\s*>")
    empty = re.compile(rb"<[^<>]*/>")  # an element without content, at its opening
    declared = re.compile(rb"<\?xml[^>]*?encoding\s*=\s*[\"']([\w.-]+)")
    shape = pa.schema([("path", pa.string()), ("member", pa.string()), ("record", pa.string())])

    def elements(handle) -> Iterator[str]:
        rest, encoding = b"", None
        while True:
            piece = handle.read(_PIECE)
            rest += piece
            if encoding is None:
                found = declared.match(rest.removeprefix(b"\xef\xbb\xbf"))
                encoding = found[1].decode("ascii") if found else "utf-8"
            at = 0
            while start := opening.search(rest, at):
                end = empty.match(rest, start.start()) or closing.search(rest, start.start())
                if end is None:
                    break
                yield rest[start.start():end.end()].decode(encoding)
                at = end.end()
            rest = rest[at:]
            if not piece:
                return

    def read(path: str, blob: BinaryIO) -> Iterator[pa.RecordBatch]:
        for name, handle in _members(blob):
            if not name.lower().endswith(".xml"):
                continue
            rows: list[str] = []
            for text in elements(handle):
                rows.append(text)
                if len(rows) == _ROWS:
                    yield pa.RecordBatch.from_pydict(
                        {"path": [path] * len(rows), "member": [name] * len(rows), "record": rows}, schema=shape)
                    rows = []
            if rows:
                yield pa.RecordBatch.from_pydict(
                    {"path": [path] * len(rows), "member": [name] * len(rows), "record": rows}, schema=shape)

    return _per_archive(archives, "path string, member string, record string", errors, read)


# the Western code page differs from latin1 in these bytes; five it leaves undefined
_UNDEFINED = "".join(chr(b) for b in range(0x80, 0xA0) if bytes([b]).decode("cp1252", "ignore") == "")
_LATIN = "".join(chr(b) for b in range(0x80, 0xA0) if chr(b) not in _UNDEFINED)
_WESTERN = "".join(bytes([ord(c)]).decode("cp1252") for c in _LATIN)


def decoded(content: str | Column) -> Column:
    """Text of bytes: UTF-8 when valid, else cp1252, else latin1; a leading mark is dropped."""
    c = X.col(content)
    plain, latin = c.cast("string"), F.decode(c, "ISO-8859-1")
    western = F.when(F.translate(latin, _UNDEFINED, "") != latin, latin).otherwise(F.translate(latin, _LATIN, _WESTERN))
    return F.regexp_replace(F.when(F.is_valid_utf8(plain), plain).otherwise(western), "^\uFEFF", "")


def text_records(text: str | Column, sep: str = ";") -> Column:
    """Records of delimited text: lines, but for line ends inside a quoted field. A quote counts where it opens a field."""
    field = f'(?:"(?:[^"]++|"")*+"[^{sep}\\r\\n]*+|[^{sep}"\\r\\n][^{sep}\\r\\n]*+|)'
    found = F.regexp_extract_all(X.col(text), F.lit(f"({field}(?:{sep}{field})*+)(?:\\r?\\n|\\r|\\z)"), F.lit(1))
    # without a quote there is nothing to look for
    return F.when(F.contains(X.col(text), F.lit('"')), found).otherwise(F.split(X.col(text), "\r\n|\n|\r"))


def record_fields(record: str | Column, sep: str = ";") -> Column:
    """The fields of a record, unquoted; an empty field is null."""
    r = X.col(record)
    quoted = F.regexp_extract_all(F.concat(F.lit(sep), r), F.lit(f'{sep}("(?:[^"]++|"")*+"[^{sep}]*+|[^{sep}]*+)'), F.lit(1))
    plain = F.transform(quoted, lambda f: F.when(
        F.startswith(f, F.lit('"')), F.replace(F.regexp_replace(f, r'(?s)^"((?:[^"]++|"")*+)"(.*)$', "$1$2"), F.lit('""'), F.lit('"'))).otherwise(f))
    values = F.when(F.contains(r, F.lit('"')), plain).otherwise(F.split(r, sep))
    return F.transform(values, lambda f: F.nullif(f, F.lit("")))


def register_rows(files: DataFrame, columns: list[str], sep: str = ";", errors: bool = False) -> DataFrame:
    """The named columns of delimited text files with a header line, all as text.

    ``files`` holds ``path`` and ``content``. A record ends with its line, but not inside quotes; its values are picked
    by the names of its own file's header, so files may order their columns differently and be of any width. The places
    of the columns are found once per file, before its records become rows. A file without one of the columns is an
    error; with ``errors`` it is one row with ``error``, and so is a row of ``files`` that has an ``error`` already.
    """
    known = F.col("error") if "error" in files.columns else F.lit(None).cast("string")
    records = files.select("path", known.alias("known"), F.coalesce(text_records(decoded("content"), sep), F.array(F.lit(""))).alias("records"))
    header = F.transform(record_fields(F.get("records", F.lit(0)), sep), lambda h: F.trim(h))
    at = lambda c: F.nullif(F.array_position("header", F.lit(c)), F.lit(0)).cast("int")
    placed = records.withColumn("header", header).select("path", "known", F.array(*[at(c) for c in columns]).alias("at"), "records")
    names = F.array(*[F.lit(c) for c in columns])
    lost = F.array_join(F.transform(F.filter(F.arrays_zip(names.alias("name"), F.col("at").alias("at")), lambda z: z["at"].isNull()), lambda z: z["name"]), ", ")
    problem = F.coalesce("known", F.when(F.exists("at", lambda a: a.isNull()), F.concat(F.lit("no column "), lost, F.lit(" in "), F.col("path"))))
    if not errors:
        stop = F.raise_error(F.col("problem")).cast("array<string>")
        rows = placed.withColumn("problem", problem).withColumn("records", F.when(F.col("problem").isNotNull(), stop).otherwise(F.col("records")))
    else:
        one = F.array(F.lit("header"), F.lit("problem"))
        rows = placed.withColumn("problem", problem).withColumn("records", F.when(F.col("problem").isNotNull(), one).otherwise(F.col("records")))
    # the outer form, as the plain one would have its filter on the array computed below every projection
    rows = rows.select("path", "at", "problem", F.posexplode_outer("records").alias("line_number", "record")).filter((F.col("line_number") > 0) & (F.trim("record") != ""))
    values = rows.select("path", "at", "problem", record_fields("record", sep).alias("v"))
    out = values.select("path", *[F.when(F.col("problem").isNull(), F.get("v", F.get("at", F.lit(k)) - 1)).alias(c) for k, c in enumerate(columns)], "problem")
    return out.withColumnRenamed("problem", "error") if errors else out.drop("problem")


def latest_snapshot(rows: DataFrame, day: str = "report_date", member: str = "source_xml") -> DataFrame:
    """Rows of the last file (by name) of each day, whole-row duplicates removed.

    The last name per day is a small aggregate joined back, not a window over a
    day's rows, so one big day is not gathered in a task.
    """
    last = rows.groupBy(day).agg(F.max(member).alias(member))
    return rows.join(last, [day, member], "left_semi").dropDuplicates()


def archive_fingerprint(files: DataFrame) -> DataFrame:
    """Content hash per archive over its sorted members, blind to how it was packed."""
    hashed = members(files).select("path", "member", F.sha2("content", 256).alias("digest"))
    # an archive lists its members, so the list per path is bounded by one file
    return hashed.groupBy("path").agg(
        F.count(F.lit(1)).alias("members"),
        F.sha2(F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("member", "digest"))),
                                        lambda m: F.concat_ws(":", m["member"], m["digest"])), "\n"), 256)
        .alias("content_sha256"),
        F.max_by("digest", "member").alias("last_member_sha256"))

"""Directory listing (S9): ``path, name, is_dir, size, mtime`` of a watched folder.

Listing is control plane: file metadata, not file content.  It is read through the
Hadoop ``FileSystem`` of the session (so local, HDFS and object stores all work), is
non-recursive, and keeps zero-length files (``binaryFile`` would drop them, and with
them the readiness markers).  A flat folder is one call to the file system, so there is nothing
to spread over tasks; what cost time with many entries were the driver's calls for each attribute.
"""

from __future__ import annotations

import datetime as dt
import os
import re
import stat

from pyspark.sql import DataFrame, SparkSession

from filament.session import local_frame
from filament.spec import join_path

LISTING_SCHEMA = "path string, name string, is_dir boolean, size long, mtime timestamp, uri string"


#: a status as Hadoop prints it; the last fit counts, as a name may hold such text itself
_STATUS = re.compile(r"[^{]*\{path=(.*); isDirectory=(true|false)(?:; length=(\d+);.*?)?; modification_time=(\d+);(.*)", re.S)
#: what a URI's path doesn't spell as it is: ASCII but letters, digits and some marks; white space and controls
_ESCAPED = re.compile(r"[\x00-\x7f\s\x80-\x9f](?<![A-Za-z0-9_.!~'()*,;:$&+=@/-])")


def _local_statuses(folder: str) -> list[tuple[str, bool, int, int]]:
    rows = []
    with os.scandir(folder) as entries:
        for e in entries:
            try:
                st = e.stat()
            except FileNotFoundError:       # gone meanwhile, or a link to nothing
                continue
            rows.append((f"file:{folder.rstrip('/')}/{e.name}", stat.S_ISDIR(st.st_mode), st.st_size, st.st_mtime_ns // 1_000_000))
    return rows


def _statuses(spark: SparkSession, directory: str) -> list[tuple[str, bool, int, int]]:
    """``path, is_dir, size, mtime_ms`` of a folder's entries in a handful of calls to the JVM, however many entries
    there are.  A local folder is read here; other statuses are printed by the JVM, all in one text, separated by NUL
    (no name has one), and those of a file system that prints them otherwise are asked one by one.  (Local statuses are not
    printed: that runs a process for each owner.)"""
    jvm = spark.sparkContext._jvm
    p = jvm.org.apache.hadoop.fs.Path(directory)
    fs = p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    if not fs.exists(p):
        return []
    where = fs.makeQualified(p).toUri()
    if where.getScheme() == "file" and os.path.isdir(where.getPath()):
        return _local_statuses(where.getPath())
    return _printed_statuses(spark, jvm.org.apache.hadoop.util.functional.RemoteIterators.toList(fs.listStatusIterator(p)))


def _printed_statuses(spark: SparkSession, found) -> list[tuple[str, bool, int, int]]:
    printed = spark.sparkContext._jvm.org.apache.commons.lang3.StringUtils.join(found, "\0")
    rows = []
    for text in printed.split("\0") if printed else []:
        at = _STATUS.fullmatch(text)
        if not at or "/" not in at[1] or "isSymlink=true" in at[5]:
            return [(st.getPath().toString(), bool(st.isDirectory()), int(st.getLen()), int(st.getModificationTime())) for st in found]
        rows.append((at[1], at[2] == "true", int(at[3] or 0), int(at[4])))
    return rows


def list_entries(spark: SparkSession, directory: str) -> list[tuple]:
    rows = []
    for path, is_dir, size, mtime in _statuses(spark, directory):
        name = path.rsplit("/", 1)[-1]
        uri = _ESCAPED.sub(lambda m: "".join("%%%02X" % byte for byte in m[0].encode()), path)
        rows.append((join_path(directory, name), name, is_dir, size,
                     dt.datetime.fromtimestamp(mtime / 1000.0, tz=dt.timezone.utc), uri))
    return rows


def list_dir(spark: SparkSession, directory: str) -> DataFrame:
    """S9 as a DataFrame (one row per entry)."""
    return local_frame(spark, list_entries(spark, directory), LISTING_SCHEMA)

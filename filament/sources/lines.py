"""Line sources and line numbering.

A *lines frame* has one row per non-blank physical line:

``_file`` (plain path), ``_raw`` (line without its ``\\n`` and one trailing ``\\r``),
``_line`` (``_raw`` trimmed), ``_too_long`` (line over the scanner limit) and an order
that numbers lines within a file.  Two producers exist:

* ``scan_lines`` reads files with ``spark.read.text`` (``lineSep="\\n"``, so a lone
  ``\\r`` stays inside a line) and orders lines by split start and a row id.
  ``number_scanned`` numbers them without sorting the data: a per-split index
  (count, first row id, first line) is aggregated, running-summed per file and joined
  back, so a file holding a third of all rows never lands in one task.
* ``lines_from_frame`` turns any DataFrame with a path, a text and a unique integer
  order key into a lines frame; ``number_by_key`` numbers it with a bounded-width
  bucket of the key (each window partition holds at most ``bucket_width`` rows).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from filament.functions.text import WHITE_SPACE, decode_file_uri, go_trim, strip_cr, trim_column
from filament.operators.size import small_side
from filament.session import local_frame
from filament.sources.listing import list_entries


def is_hidden(path: str) -> bool:
    """Names that Spark's file sources pass over."""
    return path.rsplit("/", 1)[-1][:1] in ("_", ".")


def qualified(spark: SparkSession, paths: list[str]) -> list[str]:
    """Paths with scheme and root, as the session's file system has them; one call for each folder."""
    jvm, conf = spark.sparkContext._jvm, spark.sparkContext._jsc.hadoopConfiguration()
    folders: dict[str, str] = {}
    for p in paths:
        folder = p.rpartition("/")[0] or ("/" if p.startswith("/") else ".")
        if folder not in folders:
            hp = jvm.org.apache.hadoop.fs.Path(folder)
            folders[folder] = hp.getFileSystem(conf).makeQualified(hp).toString().rstrip("/")
    return [folders[p.rpartition("/")[0] or ("/" if p.startswith("/") else ".")] + "/" + p.rsplit("/", 1)[-1] for p in paths]


def open_source(where: str):
    """Arrow file system and name in it of a qualified path (called in tasks)."""
    from pyarrow import fs

    if where.startswith("file:"):
        return fs.LocalFileSystem(), "/" + where[5:].lstrip("/")
    return fs.FileSystem.from_uri(where)


# fixed values: endings that the stream reader unpacks; such files are one range
_PACKED = ("gz", "bz2", "zst", "lz4")


def byte_ranges(files: list[tuple[str, str, int]], width: int) -> list[tuple[str, str, int, int]]:
    """``(qualified, path, start, end)``: a file's bytes in ranges of ``width`` (compressed ones in one)."""
    out = []
    for where, path, size in files:
        step = max(size, 1) if path.rsplit(".", 1)[-1].lower() in _PACKED else width
        out += [(where, path, at, min(at + step, size)) for at in range(0, size, step)]
    return out


def range_lines(where: str, start: int, end: int, chunk: int = 4 << 20):
    """Lists of the lines that begin in ``[start, end)`` of a file.  A range begins behind the first line feed at or
    after the byte before it, and reads on to the end of its last line."""
    source, name = open_source(where)
    if name.rsplit(".", 1)[-1].lower() in _PACKED:
        with source.open_input_stream(name) as stream:
            rest = []
            while got := stream.read(chunk):
                *lines, last = got.split(b"\n")
                if lines:
                    yield [b"".join(rest) + lines[0], *lines[1:]]
                    rest = []
                rest.append(last)
            if last := b"".join(rest):
                yield [last]
        return
    with source.open_input_file(name) as stream:
        at = start
        if start:
            at = start - 1
            stream.seek(at)
            while True:
                got = stream.read(min(chunk, 1 << 16))
                if not got:
                    return
                cut = got.find(b"\n")
                if cut >= 0:
                    at += cut + 1
                    break
                at += len(got)
            stream.seek(at)
        rest: list[bytes] = []       # parts of the line that begins at ``at``
        while at < end and (got := stream.read(chunk)):
            *lines, last = got.split(b"\n")
            if not lines:
                rest.append(last)
                continue
            lines[0] = b"".join(rest) + lines[0]
            keep = []
            for line in lines:
                if at >= end:
                    break
                keep.append(line)
                at += len(line) + 1
            yield keep
            rest = [last] if last else []
        if at < end and rest:
            yield [b"".join(rest)]


def _hidden_text(spark: SparkSession, paths: list[str]) -> DataFrame:
    """``_uri, _block, _value`` of files whose names the text source passes over.  Each byte range of
    ``spark.sql.files.maxPartitionBytes`` is a row of its own, so one large file is read by many tasks."""
    sizes = {e[0]: e[3] for folder in {p.rpartition("/")[0] or ("/" if p.startswith("/") else ".") for p in paths}
             for e in list_entries(spark, folder)}
    width = int(spark._jsparkSession.sessionState().conf().filesMaxPartitionBytes())
    ranges = byte_ranges([(where, p, sizes.get(p, 1)) for where, p in zip(qualified(spark, paths), paths)], width)

    def read(batches):
        import urllib.parse

        import pyarrow as pa

        for b in batches:
            for where, path, start, end in zip(*(b.column(i).to_pylist() for i in range(4))):
                uri = "file:" + urllib.parse.quote(path) if "://" not in path else path
                for lines in range_lines(where, start, end):
                    yield pa.RecordBatch.from_arrays([pa.array([uri] * len(lines)), pa.array([start] * len(lines), pa.int64()),
                                                      pa.array(lines, pa.binary())], names=["_uri", "_block", "_bytes"])

    files = local_frame(spark, ranges, "qualified string, path string, start long, end long").repartition(max(1, len(ranges)))
    got = files.mapInArrow(read, "_uri string, _block long, _bytes binary")
    return got.select("_uri", "_block", F.col("_bytes").cast("string").alias("_value"))


#: session setting: schemes, comma-separated, whose files tasks open themselves to read a first line (through Arrow's file
#: systems, with the credentials that these find); local files if it is not set
HEAD_SCHEMES = "spark.filament.headSchemes"


def file_heads(spark: SparkSession, paths: list[str], keep_bytes: int | None = None) -> DataFrame | None:
    """``_file, _head_raw, _head_line``: each file's first non-blank line (S6), read by tasks from the file's beginning
    instead of a second scan of all lines.  ``_file`` is the path as given.  With ``keep_bytes``, a line of that many bytes
    is the first even if blank, as ``scan_lines`` keeps it.  A file that can't be read is an error that
    names it.  None where tasks can't open the files (another scheme or packing): the caller then probes the scan."""
    where = qualified(spark, paths)
    schemes = spark.conf.get(HEAD_SCHEMES, "file").split(",")
    if any(w.partition(":")[0] not in schemes for w in where) or any(
            p.rsplit(".", 1)[-1].lower() in ("deflate", "snappy", "lz4") for p in paths):
        return None

    def first_line(source: str, path: str) -> bytes | None:
        mark = b"" if is_hidden(path) else b"\xef\xbb\xbf"      # the text source drops it
        for lines in range_lines(source, 0, 1 << 62, 1 << 16):
            for line in lines:
                line, mark = line.removeprefix(mark), b""
                if line.decode("utf-8", "replace").strip(WHITE_SPACE) or keep_bytes and len(line) >= keep_bytes:
                    return line
        return None

    def read(batches):
        import pyarrow as pa

        for b in batches:
            names, heads = [], []
            for source, path in zip(b.column(0).to_pylist(), b.column(1).to_pylist()):
                try:
                    head = first_line(source, path)
                except OSError as e:
                    raise OSError(f"FAILED_READ_FILE {path} : {e}") from e    # named as the text source does
                if head is not None:
                    names.append(path)
                    heads.append(head)
            yield pa.RecordBatch.from_arrays([pa.array(names, pa.string()), pa.array(heads, pa.binary())], names=["_file", "_bytes"])

    files = local_frame(spark, list(zip(where, paths)), "qualified string, path string").repartition(max(1, min(len(paths) // 64 + 1, 1000)))
    got = files.mapInArrow(read, "_file string, _bytes binary").select("_file", F.col("_bytes").cast("string").alias("_value"))
    got = got.withColumn("_head_raw", strip_cr(F.col("_value")))
    return got.select("_file", "_head_raw", trim_column(F.col("_head_raw")).alias("_head_line"))


def escape_glob(p: str) -> str:
    """A literal path for readers that expand globs."""
    return "".join("\\" + ch if ch in "*?[]{}\\" else ch for ch in p)


def scan_lines(spark: SparkSession, paths: list[str] | str, max_line_bytes: int | None = None,
               keep_blank: bool = False, directory: str | None = None) -> DataFrame:
    """Every non-blank line of ``paths`` (a list: literal file paths, hidden names included;
    a string: a path or glob) with split coordinates for numbering.

    Columns: ``_uri, _file, _block, _mid, _raw, _line, _too_long``.  ``_raw`` holds the line's
    bytes as they are in the file.  With ``max_line_bytes``, a line of that many bytes or more
    (counting a trailing CR) is kept even when blank so the file can fail on it.  With ``directory``
    (a cleaned, configured folder), ``_file`` is that folder joined with the decoded base name —
    the path as the pipeline names it — instead of the absolute path decoded from the URI."""
    hidden = [p for p in paths if is_hidden(p)] if isinstance(paths, list) else []
    seen = [escape_glob(p) for p in paths if not is_hidden(p)] if isinstance(paths, list) else paths
    df = None
    if seen:
        text = spark.read.option("lineSep", "\n").text(seen)
        df = text.select(
            F.col("_metadata.file_path").alias("_uri"),
            F.col("_metadata.file_block_start").alias("_block"),
            F.col("value").alias("_value"),
        )
    if hidden:
        more = _hidden_text(spark, hidden)
        df = more if df is None else df.unionByName(more)
    too_long = F.octet_length("_value") >= F.lit(max_line_bytes) if max_line_bytes else F.lit(False)
    df = (df.withColumn("_raw", strip_cr(F.col("_value")))
            .withColumn("_line", trim_column(F.col("_raw")))
            .withColumn("_too_long", too_long)
            .filter((F.col("_line") != "") | F.col("_too_long") | F.lit(keep_blank))
            .drop("_value"))
    # Row id after the blank filter: ids of one split's kept lines are consecutive.
    df = df.withColumn("_mid", F.monotonically_increasing_id())
    plain = decode_file_uri(F.col("_uri"))
    if directory is not None:
        # only names with escapes are decoded
        name = F.substring_index(F.col("_uri"), "/", -1)
        name = F.when(name.contains("%"), F.substring_index(plain, "/", -1)).otherwise(name)
        if directory in (".", ""):
            plain = name
        else:
            plain = F.concat(F.lit(directory if directory.endswith("/") else directory + "/"), name)
    return df.withColumn("_file", plain)


def split_index(lines: DataFrame) -> DataFrame:
    """Per (file, split): lines before the split and the split's first row id, plus the
    row id of the file's first line.  Count and min only — a hash aggregate with
    partial aggregation; no string- or struct-valued buffer (those force a sort-based
    aggregate over every line).  One row per input split."""
    per_split = lines.groupBy("_uri", "_block").agg(
        F.count(F.lit(1)).alias("_n"),
        F.min("_mid").alias("_mid0"),
    )
    w = Window.partitionBy("_uri").orderBy("_block")
    return (per_split
            .withColumn("_base", F.coalesce(F.sum("_n").over(w.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)))
            .withColumn("_head_mid", F.first("_mid0").over(w.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)))
            .select("_uri", "_block", "_base", "_mid0", "_head_mid"))


def _join_index(df: DataFrame, index: DataFrame, keys: list[str], n_bytes: int | None) -> DataFrame:
    """Broadcast the index only behind a known bound (one row per split or bucket,
    estimated from the listing); without one, AQE converts the join at run time when
    the materialised index is small, else it stays a shuffle join."""
    return df.join(small_side(index, n_bytes), keys, "inner")


def attach_heads(numbered: DataFrame, heads: DataFrame, n_bytes: int | None) -> DataFrame:
    """Join each file's first line (``_head_raw``, ``_head_line``) onto its rows."""
    return numbered.join(small_side(heads, n_bytes), "_file", "left")


def number_scanned(lines: DataFrame, index_bytes: int | None = None, with_head: bool = True,
                   head_fn=None, heads: DataFrame | None = None, heads_bytes: int | None = None) -> DataFrame:
    """S3 on scanned lines: adds ``_line_no`` (1-based over non-blank lines) and, with
    ``with_head``, the file's first non-blank line ``_head_raw`` / ``_head_line``.
    ``index_bytes`` (one row a split, from the file listing) decides between broadcasting the split index
    and a shuffle join.  The first lines are those of ``heads`` (``file_heads``) or, without it, found
    by a broadcast probe on (file, first row id): one more light scan, no sort."""
    idx = split_index(lines)
    out = _join_index(lines, idx, ["_uri", "_block"], index_bytes)
    out = out.withColumn("_line_no", F.col("_base") + (F.col("_mid") - F.col("_mid0")) + 1)
    if with_head:
        if heads is None:
            head_ids = idx.select("_uri", F.col("_head_mid").alias("_mid")).distinct()
            heads = (_join_index(lines.select("_uri", "_mid", "_file", "_raw", "_line"), head_ids, ["_uri", "_mid"], index_bytes)
                     .select("_file", F.col("_raw").alias("_head_raw"), F.col("_line").alias("_head_line")))
        out = attach_heads(out, head_fn(heads) if head_fn else heads, heads_bytes)
    return out.drop("_base", "_mid0", "_head_mid")


def lines_from_frame(df: DataFrame, path: Column, text: Column, order: Column,
                     max_line_bytes: int | None = None) -> DataFrame:
    """A lines frame from table data: ``text`` may hold several ``\\n``-separated lines,
    ``order`` (a unique integer per text within the path) orders the texts."""
    base = df.select(path.alias("_file"), text.alias("_text"), order.cast("long").alias("_ord"))
    exploded = base.select("_file", "_ord", F.posexplode(F.split(F.col("_text"), "\n", -1)).alias("_pos", "_value"))
    out = (exploded.withColumn("_raw", strip_cr(F.col("_value")))
                   .withColumn("_line", go_trim(F.col("_raw")))
                   .withColumn("_too_long", F.octet_length("_value") >= F.lit(max_line_bytes) if max_line_bytes else F.lit(False))
                   .filter((F.col("_line") != "") | F.col("_too_long"))
                   .drop("_value"))
    return out


def number_by_key(lines: DataFrame, bucket_width: int = 65536, index_bytes: int | None = None,
                  with_head: bool = True, head_fn=None) -> DataFrame:
    """S3 on a lines frame ordered by (``_ord``, ``_pos``): ``_line_no`` and the file's
    first line.  Lines are bucketed by ``_ord // bucket_width``; a bucket's rows are
    numbered by a window over (file, bucket) — at most ``bucket_width`` texts per window
    partition, however large the file — and offset by the running count of the
    file's earlier buckets (a small index, broadcast when its size allows)."""
    b = lines.withColumn("_bucket", F.floor(F.col("_ord") / F.lit(bucket_width)).cast("long"))
    per_bucket = b.groupBy("_file", "_bucket").agg(F.count(F.lit(1)).alias("_n"), F.min("_ord").alias("_ord0"))
    w = Window.partitionBy("_file").orderBy("_bucket")
    idx = (per_bucket
           .withColumn("_base", F.coalesce(F.sum("_n").over(w.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)))
           .withColumn("_head_ord", F.first("_ord0").over(w.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing))))
    rn = F.row_number().over(Window.partitionBy("_file", "_bucket").orderBy("_ord", "_pos"))
    numbered = b.withColumn("_rn", rn)
    out = _join_index(numbered, idx.select("_file", "_bucket", "_base"), ["_file", "_bucket"], index_bytes)
    out = out.withColumn("_line_no", F.col("_base") + F.col("_rn")).drop("_base", "_rn", "_bucket")
    if with_head:
        head_ids = idx.select("_file", F.col("_head_ord").alias("_ord")).distinct()
        first_text = _join_index(lines.select("_file", "_ord", "_pos", "_raw", "_line"), head_ids, ["_file", "_ord"], index_bytes)
        # lines of one text per file: small, so a struct-valued min_by is fine here
        heads = first_text.groupBy("_file").agg(F.min_by(F.struct("_raw", "_line"), "_pos").alias("_h")).select(
            "_file", F.col("_h._raw").alias("_head_raw"), F.col("_h._line").alias("_head_line"))
        out = attach_heads(out, head_fn(heads) if head_fn else heads, None)
    return out


def order_columns(df: DataFrame) -> list[str]:
    """Columns ordering the lines of one file without numbering them: (split start,
    row id) for scanned lines, (order key, position) for derived ones."""
    return ["_block", "_mid"] if "_block" in df.columns else ["_ord", "_pos"]

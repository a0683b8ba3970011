"""Reader semantics: headers, skipping, numbering, delimiters, carriage returns, bytes that are not UTF-8."""
import hashlib
import os

import pytest
from pyspark.sql import functions as F

from filament.operators.chain import ChainContext
from filament.operators.provenance import record_id, row_hash
from filament.operators.verdict import file_verdict
from filament.plans.ingest import parse
from filament.sources.lines import lines_from_frame, number_scanned, scan_lines
from filament.spec import FieldSpec, PipelineSpec


def _write(tmp, name, data: bytes):
    p = os.path.join(tmp, name)
    with open(p, "wb") as fh:
        fh.write(data)
    return p


def _rows(spark, tmp, path, fields, **kw):
    spec = PipelineSpec(name="t", watch_dir=tmp, table="t", fields=[FieldSpec(f) for f in fields], **kw)
    return parse(scan_lines(spark, [path], directory=tmp), spec, ChainContext()).rows.collect()


def test_header_line_and_further_skips(spark, tmp):
    p = _write(tmp, "a.txt", b"\ncell-9,rack 4\nunits,ms\n7,1.5\n8,2.5\n")
    rows = _rows(spark, tmp, p, ["n", "ms"], delimiter=",", has_header_meta=True,
                 header_fields=[FieldSpec("cell"), FieldSpec("rack"), FieldSpec("room")], skip_header_lines=1)
    assert sorted((r.n, r.ms, r.cell, r.rack, r.room, r._line_no) for r in rows) == [
        ("7", "1.5", "cell-9", "rack 4", "", 3), ("8", "2.5", "cell-9", "rack 4", "", 4)]


def test_header_of_another_shape(spark, tmp):
    """The header is split with the row rule; a field named like a header key takes its value."""
    p = _write(tmp, "b.txt", b"'left\tright'\tx\n1\t2\n")
    rows = _rows(spark, tmp, p, ["k", "v"], delimiter="\t", has_header_meta=True, header_fields=[FieldSpec("title"), FieldSpec("v")])
    assert [(r.k, r.v, r.title) for r in rows] == [("1", "x", "left\tright")]


def test_delimiters(spark, tmp):
    p = _write(tmp, "c.txt", "a§b§c\n\"q§r\"§s\n".encode())
    assert sorted((r.x, r.y, r.z) for r in _rows(spark, tmp, p, ["x", "y", "z"], delimiter="§")) == [('"q', 'r"', "s"), ("a", "b", "c")]
    p = _write(tmp, "d.txt", b"m:=:n:=:o\np\n")
    assert sorted((r.x, r.y) for r in _rows(spark, tmp, p, ["x", "y"], delimiter=":=:")) == [("m", "n"), ("p", "")]


def test_cr_blank_lines_and_numbering(spark, tmp):
    p = _write(tmp, "e.txt", b"\r\n\t \none \r\r\n\n t\rwo\r\n\x0b\nend")
    n = number_scanned(scan_lines(spark, [p], directory=tmp))
    assert sorted((r._line_no, r._raw, r._line) for r in n.collect()) == [(1, "one \r", "one"), (2, " t\rwo", "t\rwo"), (3, "end", "end")]
    assert {r._file for r in n.select("_file").collect()} == {os.path.join(tmp, "e.txt")}


@pytest.mark.parametrize("name", ["f.txt", "_f.txt", ".f.txt"])
def test_bytes_are_kept(spark, tmp, name):
    """GBK and Latin-1 lines keep their bytes in the line, the hash and the record id, also with CRLF,
    in files with hidden names too."""
    lines = ["编号|名称|中文".encode("gbk"), "prix|café|à".encode("latin-1"), b"\xd6\xd0|\xc4\xe3|x", b"\xff\xfe|\x80\r", "plain|ascii|é".encode()]
    p = _write(tmp, name, b"\r\n".join(lines) + b"\r\n")
    n = number_scanned(scan_lines(spark, [p], directory=tmp))
    got = n.select("_line_no", F.col("_raw").cast("binary").alias("raw"), row_hash(F.col("_raw")).alias("h"),
                   record_id(F.col("_file"), F.col("_line_no").cast("string"), row_hash(F.col("_raw"))).alias("id"))
    for r in got.collect():
        line = lines[r._line_no - 1]
        h = hashlib.sha1(line).hexdigest()
        assert bytes(r.raw) == line and r.h == h
        assert r.id == hashlib.sha1(f"{p}\0{r._line_no}\0{h}\0".encode()).hexdigest()
    assert n.count() == len(lines)


def test_numbering_across_splits(spark, tmp):
    lines = [f"row {i} of it" if i % 5 else " \t" for i in range(30000)]
    p = _write(tmp, "big.txt", ("\n".join(lines) + "\n").encode())
    spark.conf.set("spark.sql.files.maxPartitionBytes", "20000")
    try:
        n = number_scanned(scan_lines(spark, [p], directory=tmp), index_bytes=100)
        got = sorted((r._line_no, r._line) for r in n.select("_line_no", "_line").collect())
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", "134217728")
    assert got == list(enumerate((x for x in lines if x.strip()), 1))


def test_first_error_position_is_not_bounded(spark):
    """Positions in one text and texts' order keys may both be large."""
    rows = [("/f", 1, 1 << 20, "late"), ("/f", 2, 0, "second"), ("/g", 1 << 50, 5, "b"), ("/g", 1 << 50, 4, "a"), ("/h", 1, 0, None)]
    df = spark.createDataFrame(rows, "_file string, _ord long, _pos int, m string").withColumn(
        "_err_field", F.when(F.col("m").isNotNull(), F.lit(0)))
    got = file_verdict(df, F.col("m")).collect()
    assert sorted((r._file, r.rows, r.errors, r.first_error) for r in got) == [("/f", 2, 2, "late"), ("/g", 2, 2, "a"), ("/h", 1, 0, None)]


def test_limits_are_opt_in(spark, tmp):
    p = _write(tmp, "long.txt", b"x" * (20 << 20) + b"\nshort\n")
    assert scan_lines(spark, [p], directory=tmp).filter("_too_long").count() == 0
    assert scan_lines(spark, [p], 1000, directory=tmp).filter("_too_long").count() == 1
    df = spark.createDataFrame([("/x", "a\nb\n\n c \r", 1)], "p string, t string, o long")
    assert sorted(r._line for r in lines_from_frame(df, F.col("p"), F.col("t"), F.col("o")).collect()) == ["a", "b", "c"]


def test_byte_ranges_of_hidden_files(spark, tmp):
    """A hidden file is read range by range (here 7 bytes each): every line once, in order, whatever the cuts."""
    from filament.sources.lines import byte_ranges, range_lines
    data = b"\nab\r\n\n" + b"x" * 40 + b"\nlast line\n\n12345\n1234567\nend"
    p = _write(tmp, "_r.txt", data)
    want = data.split(b"\n")
    for width in range(1, 20):
        for chunk in (1, 3, 1 << 16):
            got = [line for _, _, a, b in byte_ranges([("file:" + p, p, len(data))], width)
                   for lines in range_lines("file:" + p, a, b, chunk) for line in lines]
            assert got == want
    old = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "7b")
    try:
        n = number_scanned(scan_lines(spark, [p], directory=tmp))
        rows = sorted((r._line_no, r._raw, r._head_raw) for r in n.collect())
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", old)
    assert rows == [(i + 1, x, "ab") for i, x in enumerate(["ab", "x" * 40, "last line", "12345", "1234567", "end"])]


def test_first_lines_by_tasks(spark, tmp):
    """The first lines that tasks read equal those found by the scan: byte order mark, CR, blank lines, packed files."""
    import gzip

    from filament.sources.lines import file_heads
    files = {"a.txt": b"\n \t\r\n  head\xa7 1 \r\nrow\n", "b.txt": b"\xef\xbb\xbfmarked\nrow\n", "_c.txt": b"\xef\xbb\xbfmarked\nrow\n",
             "d e%.txt": b"only", "f.gz": gzip.compress(b"\npacked\nrow\n"), "empty.txt": b"", "blank.txt": b"\n\n \n",
             "long.txt": b"y" * 200_000 + b"\nrow\n", "mark.txt": b"\xef\xbb\xbf\nsecond\n"}
    paths = [_write(tmp, name, data) for name, data in files.items()]
    lines = scan_lines(spark, paths, directory=tmp)
    heads = file_heads(spark, paths)
    cols = ["_file", "_line_no", "_line", "_head_raw", "_head_line"]
    probed, fetched = number_scanned(lines).select(cols), number_scanned(lines, heads=heads).select(cols)
    hexed = [F.hex(F.col(c).cast("binary")).alias(c) if c != "_line_no" else F.col(c) for c in cols]
    assert sorted(probed.select(hexed).collect()) == sorted(fetched.select(hexed).collect())
    assert heads.count() == 7
    spark.conf.set("spark.filament.headSchemes", "hdfs")
    assert file_heads(spark, paths) is None                       # the caller probes the scan
    spark.conf.unset("spark.filament.headSchemes")
    plan = fetched._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("Relation [") < probed._jdf.queryExecution().optimizedPlan().toString().count("Relation [")


@pytest.mark.parametrize("scheme", ["file", "viewfs"])
def test_listing_in_few_calls(spark, tmp, monkeypatch, scheme):
    """Many entries cost a handful of calls to the JVM; odd names keep their path, size, kind and time."""
    from py4j.clientserver import ClientServerConnection

    from filament.sources.listing import list_entries
    spark.sparkContext._jsc.hadoopConfiguration().set("fs.viewfs.mounttable.lst.link./in", "file:" + tmp)
    root = tmp if scheme == "file" else "viewfs://lst/in"
    many = 3000 if scheme == "file" else 120
    odd = ["a; isDirectory=true; modification_time=1", "b c%20.txt", "é, ü.log", "{path=x", "_h", ".d"]
    for name in [*odd, *(f"f{i}.txt" for i in range(many))]:
        _write(tmp, name, name.encode())
    os.mkdir(os.path.join(tmp, "sub"))
    os.utime(os.path.join(tmp, "_h"), (1_000_000_000, 1_000_000_000))
    calls = []
    send = ClientServerConnection.send_command
    monkeypatch.setattr(ClientServerConnection, "send_command", lambda self, *a, **k: (calls.append(1), send(self, *a, **k))[1])
    got = {e[1]: e for e in list_entries(spark, root)}
    monkeypatch.undo()
    assert len(calls) < 100 or scheme == "viewfs"                      # its statuses are printed without paths
    assert set(got) == {*odd, "sub"} | {f"f{i}.txt" for i in range(many)}
    for name in odd:
        assert got[name][0] == root + "/" + name and got[name][3] == len(name.encode()) and not got[name][2]
        hp = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(("file:" if scheme == "file" else "") + root, name)
        assert got[name][5] == hp.toUri().toString()
    assert got["sub"][2] and got["_h"][4].timestamp() == 1_000_000_000
    assert list_entries(spark, root + "/none") == [] and list_entries(spark, root + "/sub") == []


def test_statuses_printed_in_one_text(spark):
    from filament.sources.listing import _printed_statuses
    jvm = spark.sparkContext._jvm
    want = [("hdfs://n:8020/w/a; isDirectory=true; modification_time=1;", False, 7, 5), ("hdfs://n:8020/w/{path=x", False, 0, 6),
            ("hdfs://n:8020/w/two\nlines", True, 0, 1_700_000_000_123)]
    found = jvm.java.util.ArrayList()
    for path, is_dir, size, mtime in want:
        found.add(jvm.org.apache.hadoop.fs.FileStatus(size, is_dir, 1, 1024, mtime, jvm.org.apache.hadoop.fs.Path(path)))
    assert _printed_statuses(spark, found) == want
    assert _printed_statuses(spark, jvm.java.util.ArrayList()) == []

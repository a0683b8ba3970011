"""Typed conversion: single cases plus randomized equality against small Python models of the
accepted grammars."""
import datetime as dt
import random

import pytest
from pyspark.sql import functions as F

from filament.functions.casts import cast_field
from filament.operators.typed import typed_projection
from filament.spec import FieldSpec


def _conv(spark, values, field):
    df = spark.createDataFrame([(i, v) for i, v in enumerate(values)], "i int, v string")
    v, e = cast_field(F.col("v"), field)
    if field.base_type in ("datetime", "datetime64"):
        v = v.cast("timestamp_ntz")           # year-1 zero time: collect as a wall-clock value
    return [(r.val, r.err) for r in df.select("i", v.alias("val"), e.alias("err")).orderBy("i").collect()]


def test_converter_cases(spark):
    df = spark.createDataFrame([("2026-05-17 10:00:01", "200", "", "true", "10.0.0.1", "1", None)],
                               "ts string, status string, bytes string, ok string, ip string, method string, absent string")
    fields = [FieldSpec("event_time", "DateTime", layout="2006-01-02 15:04:05", source="ts"),
              FieldSpec("status_code", "UInt16", source="status"), FieldSpec("bytes_sent", "UInt64", source="bytes"),
              FieldSpec("ok", "Bool"), FieldSpec("client_ip", "IPv4", source="ip"),
              FieldSpec("method_name", "String", source="method"),
              FieldSpec("maybe", "Nullable(DateTime)", source="absent", nullable=True)]
    r = typed_projection(df, fields).collect()[0]
    assert r.event_time == dt.datetime(2026, 5, 17, 10, 0, 1)
    assert r.status_code == 200 and int(r.bytes_sent) == 0 and r.ok is True
    assert r.client_ip == "10.0.0.1" and r.method_name == "1" and r.maybe is None and r._error is None


def test_bad_number(spark):
    assert _conv(spark, ["abc"], FieldSpec("status_code", "UInt16")) == [
        (None, 'field "status_code": strconv.ParseUint: parsing "abc": invalid syntax')]


def _int_model(text, bits, signed):
    t = text.strip(" \t") or "0"
    import re
    if not re.fullmatch(r"[+-]?[0-9]+" if signed else r"[0-9]+", t):
        return None, "syntax"
    v = int(t)
    lo, hi = (-(2 ** (bits - 1)), 2 ** (bits - 1) - 1) if signed else (0, 2 ** bits - 1)
    return (v, None) if lo <= v <= hi else (None, "range")


@pytest.mark.parametrize("typ,bits,signed", [("UInt8", 8, False), ("Int16", 16, True), ("UInt32", 32, False),
                                             ("Int64", 64, True), ("UInt64", 64, False)])
def test_ints_random(spark, typ, bits, signed):
    rnd = random.Random(bits * (2 if signed else 1))
    vals = []
    for _ in range(300):
        k = rnd.random()
        if k < 0.3:
            vals.append(str(rnd.randint(-2 ** bits, 2 ** bits)))
        elif k < 0.5:
            vals.append(rnd.choice(["+", "-", " ", "0", "00"]) + str(rnd.randint(0, 999)))
        elif k < 0.6:
            vals.append(rnd.choice(["1e3", "5.7", "", " ", "0x10", "1_000", "٣", "--1", "+-1"]))
        else:
            vals.append(str(rnd.randint(0, 2 ** min(bits, 62))))
    got = _conv(spark, vals, FieldSpec("x", typ))
    for v, (val, err) in zip(vals, got):
        mv, merr = _int_model(v, bits, signed)
        assert (None if val is None else int(val)) == mv, v
        assert (err is None) == (merr is None), v
        if merr:
            assert ("invalid syntax" if merr == "syntax" else "value out of range") in err, v


def test_floats(spark):
    vals = ["1.5", ".5", "5.", "-2.5E-3", "1e400", "inf", "-Infinity", "NaN", "1d", "", "0x1p-2", "1e39", " 7 "]
    got = _conv(spark, vals, FieldSpec("f", "Float64"))
    assert got[0][0] == 1.5 and got[1][0] == 0.5 and got[2][0] == 5.0 and got[3][0] == -0.0025
    assert got[4][0] is None and "out of range" in got[4][1]
    assert got[5][0] == float("inf") and got[6][0] == float("-inf") and got[7][0] != got[7][0]
    assert got[8][0] is None and "invalid syntax" in got[8][1]
    assert got[9][0] is None and "invalid syntax" in got[9][1]
    assert got[11][0] == 1e39 and got[12][0] == 7.0
    f32 = _conv(spark, ["1e39", "3.5"], FieldSpec("g", "Float32"))
    assert f32[0][0] is None and "out of range" in f32[0][1] and f32[1][0] == 3.5


def test_bools(spark):
    vals = ["1", "t", "T", "TRUE", "true", "True", "0", "f", "F", "FALSE", "false", "False", "", "yes", "tRUE"]
    got = _conv(spark, vals, FieldSpec("b", "Bool"))
    assert [g[0] for g in got] == [True] * 6 + [False] * 7 + [None, None]


def test_times(spark):
    vals = ["2026-05-17 9:00:01", "2026-05-17 10:00:01.25", "2026-02-30 10:00:00", "", "2026-05-17",
            "2026-05-17T10:11:12+02:00"]
    lay = _conv(spark, vals, FieldSpec("t", "DateTime", layout="2006-01-02 15:04:05"))
    assert lay[0][0] == dt.datetime(2026, 5, 17, 9, 0, 1) and lay[1][0] == dt.datetime(2026, 5, 17, 10, 0, 1)
    assert lay[2][0] is None and lay[3][0] == dt.datetime(1, 1, 1) and lay[4][0] is None
    auto = _conv(spark, vals, FieldSpec("t", "DateTime64(3)"))
    assert auto[1][0] == dt.datetime(2026, 5, 17, 10, 0, 1, 250000) and auto[4][0] == dt.datetime(2026, 5, 17)
    assert auto[5][0] == dt.datetime(2026, 5, 17, 8, 11, 12)


def test_defaults_and_nullable(spark):
    got = _conv(spark, ["", " ", "5"], FieldSpec("n", "Int32", default="7"))
    assert [g[0] for g in got] == [7, 7, 5]
    got = _conv(spark, ["", "5"], FieldSpec("n", "Nullable(Int32)", nullable=True))
    assert [g[0] for g in got] == [None, 5]
    # Nullable(...) in the type alone does not make NULLs
    got = _conv(spark, [""], FieldSpec("n", "Nullable(Int32)"))
    assert got == [(0, None)]
    got = _conv(spark, [""], FieldSpec("ip", "IPv4"))
    assert got[0][0] is None and "invalid IP" in got[0][1]


def test_more_floats(spark):
    vals = ["0x1p-2", "-0X1.8p+3", "0x.8p1", "0x1", "0x1p", "1_000.5", "1__0", "_1", "1_", "0x_1p4", "1e1_0", "0x1p2000"]
    got = _conv(spark, vals, FieldSpec("f", "Float64"))
    assert [g[0] for g in got] == [0.25, -12.0, 1.0, None, None, 1000.5, None, None, None, 16.0, 1e10, None]
    assert "out of range" in got[11][1] and all("invalid syntax" in got[i][1] for i in (3, 4, 6, 7, 8))
    assert _conv(spark, ["0x1.000001p0"], FieldSpec("g", "Float32"))[0][0] == 1.0


def test_compact_comma_and_long_fractions(spark):
    at = dt.datetime(2024, 12, 31, 7, 8, 9)
    assert _conv(spark, ["20241231070809", "20241231070809.5", "2024123107080"], FieldSpec("t", "DateTime64(3)", layout="20060102150405"))[:2] == [
        (at, None), (at.replace(microsecond=500000), None)]
    lay = FieldSpec("t", "DateTime64(6)", layout="2006-01-02 15:04:05")
    got = _conv(spark, ["2024-12-31 07:08:09,25", "2024-12-31 7:08:09.1234567891234", "2024-12-31 07:08:09."], lay)
    assert [g[0] for g in got] == [at.replace(microsecond=250000), at.replace(microsecond=123456), None]
    fixed = FieldSpec("t", "DateTime64(6)", layout="02.01.2006 15:04:05.000")
    assert [g[0] for g in _conv(spark, ["31.12.2024 07:08:09.250", "31.12.2024 07:08:09.25"], fixed)] == [at.replace(microsecond=250000), None]
    auto = _conv(spark, ["2024-12-31T07:08:09,5Z", "2024-12-31 07:08:09.99999999999", "2024-12-31"], FieldSpec("t", "DateTime64(6)"))
    assert [g[0] for g in auto] == [at.replace(microsecond=500000), at.replace(microsecond=999999), dt.datetime(2024, 12, 31)]


def test_ips(spark):
    """Accepted texts and their canonical form, as Python's ipaddress module writes it (mapped
    addresses as IPv4)."""
    import ipaddress
    rng = random.Random(11)
    vals = ["1.2.3.4", "01.2.3.4", "256.0.0.1", "::ffff:1.2.3.4", "2001:DB8:0:0:0:0:0:1", "fe80::1%eth0", "167772161", "::", "::1", "1::",
            "0:0:1::0:0:0", "1:0:0:2:0:0:0:3", "1:0:2:0:3:0:4:0", "::1.2.3.4", "64:ff9b::1.2.3.4", "0:0:0:0:0:ffff:0102:0304", "1:2:3:4:5:6:7::", "1:2:3:4:5:6:7:8:9", ":::", "g::1"]
    for _ in range(200):
        groups = [rng.choice(["0", "0", "0000", "1", "AbC", "0f0", "ffff"]) for _ in range(8)]
        text = ":".join(groups)
        if rng.random() < 0.4:
            a, b = sorted((rng.randrange(9), rng.randrange(9)))
            text = ":".join(groups[:a]) + "::" + ":".join(groups[b:]) if b - a else text
        vals.append(text)

    def model(v):
        try:
            ip = ipaddress.ip_address(v) if "%" not in v else None
        except ValueError:
            return None
        return None if ip is None else str(ip.ipv4_mapped) if ip.version == 6 and ip.ipv4_mapped else str(ip)

    got = _conv(spark, vals, FieldSpec("ip", "IPv4"))
    # Python writes ::102:304 for ::1.2.3.4 like we do
    assert [g[0] for g in got] == [model(v) for v in vals]


def test_generated_methods_are_compiled(spark):
    """No generated method of a wide typed projection reaches the JVM's limit for compiled code."""
    from filament.operators.typed import typed_codes, typed_with_errors
    types = ["UInt8", "Int8", "UInt16", "Int16", "UInt32", "Int32", "UInt64", "Int64", "Float64", "Float32", "Bool", "DateTime", "Date", "IPv4", "String"]
    df = spark.range(1).select(F.col("id").cast("string").alias("t"))
    fields = [FieldSpec(f"f{i}", t, source="t") for i, t in enumerate(types * 2)]
    for out in (typed_codes(df, fields), typed_with_errors(df, fields[:15])):
        sizes = [s._2().maxMethodCodeSize() for s in _codegen(spark, out)]
        assert all(s < 8000 for s in sizes), sizes


def _codegen(spark, df):
    """(source, statistics) of each whole-stage part of the plan."""
    jvm = spark.sparkContext._jvm
    parts = getattr(jvm.org.apache.spark.sql.execution, "debug").__getattr__("package$").__getattr__("MODULE$").codegenStringSeq(
        df._jdf.queryExecution().executedPlan())

    class Part:
        def __init__(self, p):
            self.p = p

        def _2(self):
            return self.p._3()

    return [Part(parts.apply(i)) for i in range(parts.size())]

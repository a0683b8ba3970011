import re

import pytest

from filament.spec import (FieldSpec, PipelineSpec, SpecError, glob_to_regex, go_layout_to_pattern,
                           normalize_type)


@pytest.mark.parametrize("typ,base", [
    ("LowCardinality(String)", "string"), ("Nullable(DateTime)", "datetime"), ("DateTime64(3)", "datetime64"),
    ("UInt16", "uint16"), ("LowCardinality(Nullable(String))", "string"), ("Decimal(10,2)", "decimal"),
    ("  IPv4 ", "ipv4"), ("(x)", "(x)"), ("Nullable( UInt8 )", " uint8 "),
])
def test_normalize_type(typ, base):
    assert normalize_type(typ) == base


def test_layouts():
    assert go_layout_to_pattern("2006-01-02 15:04:05") == "yyyy-MM-dd H:mm:ss[.SSSSSSSSS]"
    assert go_layout_to_pattern("2006-01-02T15:04:05Z07:00") == "yyyy-MM-dd'T'H:mm:ss[.SSSSSSSSS]XXX"
    assert go_layout_to_pattern("2006-01-02 15:04:05.000") == "yyyy-MM-dd H:mm:ss.SSS"
    assert go_layout_to_pattern("02/Jan/2006") == "dd/MMM/yyyy"
    assert go_layout_to_pattern("20060102150405") == "yyyyMMddHHmmss[.SSSSSSSSS]"
    assert go_layout_to_pattern("15h04 02.01.06") == "H'h'mm dd.MM.yy"
    with pytest.raises(SpecError):
        go_layout_to_pattern("_2 Jan")


def _glob_model(pat, name):
    # a small model of shell-style base-name matching
    import fnmatch
    return fnmatch.fnmatchcase(name, pat.replace("[^", "[!"))


@pytest.mark.parametrize("pat,name", [
    ("*.cdr", "a.cdr"), ("*.cdr", "a.cdr.ok"), ("*", ".hidden"), ("a?c", "abc"), ("a?c", "ac"),
    ("[a-c]x", "bx"), ("[^a-c]x", "bx"), ("[^a-c]x", "dx"), ("*.log", "x.LOG"), ("h*_*.log", "h1_2.log"),
])
def test_glob(pat, name):
    assert _java_like_match(glob_to_regex(pat), name) == _glob_model(pat, name)


def _java_like_match(rx, name):
    py = re.sub(r"\\x\{([0-9a-f]+)\}", lambda m: re.escape(chr(int(m.group(1), 16))), rx).replace("\\z", r"\Z")
    return re.search(py, name) is not None


def test_defaults_and_validation():
    s = PipelineSpec(name="p", watch_dir="/w", table="t", fields=[FieldSpec("a")], max_retries=0, delimiter="")
    assert s.max_retries == 3 and s.delimiter == "|" and s.file_pattern == "*"
    assert s.temp_suffixes == (".tmp", ".writing") and s.marker_suffix == ".ok"
    with pytest.raises(SpecError):
        PipelineSpec(name="p", watch_dir="/w", table="t", fields=[])
    with pytest.raises(SpecError):
        PipelineSpec(name="p", watch_dir="/w", table="t", fields=[FieldSpec("a")], has_header_meta=True)
    with pytest.raises(SpecError):
        PipelineSpec(name="p", watch_dir="/w", table="t", fields=[FieldSpec("a")], ready_strategy="fast")
    with pytest.raises(SpecError):
        PipelineSpec(name="p", watch_dir="/w", table="t", fields=[FieldSpec("a")], retry_interval_s=-1)


def test_input_names_skip_generated():
    s = PipelineSpec(name="p", watch_dir="/w", table="t", fields=[
        FieldSpec("event_time"), FieldSpec("src_ip"), FieldSpec("src_geo_country", generated=True),
        FieldSpec("method_name", source="method")])
    assert s.input_names == ["event_time", "src_ip", "method"]
    assert s.skip_lines == 0 and not s.needs_line_numbers

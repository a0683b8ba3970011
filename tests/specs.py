"""The two example pipelines of the fixtures: calls (header line, marker, quoted fields) and
shop requests (multi-byte delimiter, dictionary file)."""
import os

from filament.spec import FieldSpec, PipelineSpec, TransformSpec

DATA = os.path.join(os.path.dirname(os.path.abspath(__file__)), "data")
GEO = ["site", "owner"]


def voice_spec(watch_dir, **kw):
    fields = [FieldSpec("started", "DateTime", layout="2006-01-02 15:04:05"), FieldSpec("caller_ip", "IPv4"),
              FieldSpec("callee_ip", "IPv4"), FieldSpec("route", "String"),
              FieldSpec("codec", "LowCardinality(String)"), FieldSpec("cause", "UInt16")]
    fields += [FieldSpec(f"{p}_{a}", "LowCardinality(String)", generated=True) for p in ("caller", "callee") for a in GEO]
    return PipelineSpec(
        name="voice", watch_dir=watch_dir, table="cdr.voice", fields=fields, file_pattern="*.cdr",
        ready_strategy="marker", marker_suffix=".ok", delimiter=";", has_header_meta=True,
        header_fields=[FieldSpec("switch", "LowCardinality(String)"), FieldSpec("area", "LowCardinality(String)")],
        transformers=[TransformSpec("ip_matcher", fields=("caller_ip", "callee_ip"), label_fields=("caller", "callee")),
                      TransformSpec("dict_mapper", field="codec", dict={"0": "PCMU", "8": "PCMA", "18": "G729"})],
        retry_failed=True, max_retries=2, retry_interval_s=5, event_time_field="started",
        sort_fields=("started", "caller_ip"), **kw)


def shop_spec(watch_dir, **kw):
    fields = [FieldSpec("at", "DateTime", layout="2006-01-02 15:04:05"), FieldSpec("client_ip", "IPv4"),
              FieldSpec("server_ip", "IPv4"), FieldSpec("verb", "LowCardinality(String)"), FieldSpec("url", "String"),
              FieldSpec("status_code", "UInt16"), FieldSpec("bytes_sent", "UInt64"),
              FieldSpec("pop", "LowCardinality(String)"), FieldSpec("region", "LowCardinality(String)")]
    fields += [FieldSpec(f"{p}_{a}", "LowCardinality(String)", generated=True) for p in ("client", "server") for a in GEO]
    return PipelineSpec(
        name="shop", watch_dir=watch_dir, table="cdr.shop", fields=fields, file_pattern="*.log",
        ready_strategy="atomic_rename", delimiter="~|~",
        transformers=[TransformSpec("ip_matcher", fields=("client_ip", "server_ip"), label_fields=("client", "server")),
                      TransformSpec("dict_mapper", field="verb", dict_file=os.path.join(DATA, "verbs.csv"))],
        retry_failed=True, max_retries=kw.pop("max_retries", 2), retry_interval_s=5, event_time_field="at",
        sort_fields=("at", "client_ip", "status_code"), **kw)

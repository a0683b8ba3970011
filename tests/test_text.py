"""Trims, and which keys are known to be trimmed after each kind of step."""
import random

from pyspark.sql import functions as F

from filament.functions.text import WHITE_SPACE, go_trim, trim_column
from filament.operators.chain import ChainContext, trimmed_after, trimmed_after_chain
from filament.spec import TransformSpec


def test_both_trims(spark):
    rng = random.Random(6)
    marks = list(WHITE_SPACE) + list("ab\"'09~!\x00\x1f\x7f") + ["é", "日", "😀", "\ufeff", "\u200b"]
    texts = [None, "", *marks] + ["".join(rng.choice(marks) for _ in range(rng.randrange(1, 6))) for _ in range(2000)]
    df = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "i int, t string")
    for trim in (go_trim, trim_column):
        assert {r.i: r.g for r in df.select("i", trim(F.col("t")).alias("g")).collect()} == {
            i: None if t is None else t.strip(WHITE_SPACE) for i, t in enumerate(texts)}


def test_trimmed_after_steps():
    ctx = ChainContext(ip_attrs=["country", "isp"], trimmed=frozenset({"ip", "verb"}), ip_attrs_trimmed=True)
    ip = TransformSpec("ip_matcher", fields=("ip",), label_fields=("geo",))
    cols = ["ip", "verb", "_file"]
    assert trimmed_after(ip, ctx, ctx.trimmed, cols) == {"ip", "verb", "geo_country", "geo_isp"}
    assert trimmed_after(ip, ctx, ctx.trimmed, cols + ["geo_isp"]) == {"ip", "verb", "geo_country"}      # an untrimmed text may stay there
    ctx.ip_attrs_trimmed = False
    assert trimmed_after(ip, ctx, ctx.trimmed | {"geo_isp"}, cols) == {"ip", "verb"}
    clean, spaced = ({"a": "b"}, ""), ({"a": " b"}, "")
    for (mapping, default), want in ((clean, True), (spaced, False), (({"a": "b"}, "x\u3000"), False)):
        step = TransformSpec("dict_mapper", field="verb", dict=mapping, default=default)
        assert ("verb" in trimmed_after(step, ctx, ctx.trimmed, cols)) == want
    to = TransformSpec("dict_mapper", field="verb", dict={"a": "b"}, target="_file")
    assert "_file" not in trimmed_after(to, ctx, ctx.trimmed, cols)
    assert trimmed_after(TransformSpec("own"), ctx, ctx.trimmed, cols) == set()
    assert trimmed_after_chain([to, TransformSpec("dict_mapper", field="verb", dict={}, target="new")], ctx, cols) == {"ip", "verb", "new"}

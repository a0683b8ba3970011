"""Ordered transform chain (P20) and the transform registry.

A transform is ``f(df, step, ctx) -> df`` over the row-keyed frame (one column per
row key, NULL = absent).  Steps run in list order; later ones see earlier output.
A transform may mark failing rows by setting ``_transform_error``; such rows are
dropped and counted, the rest continue.  Built-ins: ``ip_matcher``, ``dict_mapper``.
An unregistered type (including ``custom``) is a spec error.
"""

from __future__ import annotations

from dataclasses import dataclass, field, replace
from typing import Callable

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from filament.functions.text import WHITE_SPACE
from filament.operators.dictmap import dict_map, dict_map_table
from filament.operators.iplookup import ip_enrich
from filament.spec import SpecError, TransformSpec

TRANSFORM_ERROR = "_transform_error"


@dataclass
class ChainContext:
    """Dimension inputs shared by the steps: the bucketed IP table (with its attribute
    names and counted bytes) and loaded dictionary tables by file path."""
    ip_table: DataFrame | None = None
    ip_attrs: list[str] = field(default_factory=list)
    ip_table_bytes: int | None = None
    dict_tables: dict[str, tuple[DataFrame, int | None]] = field(default_factory=dict)
    #: keys whose texts have no outer white space (the frame's, before a step) and whether the IP table's attributes have none
    trimmed: frozenset[str] = frozenset()
    ip_attrs_trimmed: bool = False
    #: cached frames behind the tables
    held: list[DataFrame] = field(default_factory=list)

    def close(self) -> None:
        """Release what was cached for this context (its tables are read anew if used again)."""
        while self.held:
            self.held.pop().unpersist()


Transform = Callable[[DataFrame, TransformSpec, ChainContext], DataFrame]
_REGISTRY: dict[str, Transform] = {}


def register(name: str, fn: Transform) -> None:
    """Make ``fn`` available as transform type ``name``."""
    _REGISTRY[name] = fn


def _ip_matcher(df: DataFrame, step: TransformSpec, ctx: ChainContext) -> DataFrame:
    if ctx.ip_table is None:
        raise SpecError("ip_matcher requires an IP table but none is configured")
    return ip_enrich(df, list(step.fields), list(step.label_fields), ctx.ip_table, ctx.ip_attrs, ctx.ip_table_bytes,
                     ctx.trimmed)


def _dict_mapper(df: DataFrame, step: TransformSpec, ctx: ChainContext) -> DataFrame:
    if step.dict_file:
        if step.dict_file not in ctx.dict_tables:
            raise SpecError(f"dictionary file {step.dict_file!r} is not loaded")
        table, n_bytes = ctx.dict_tables[step.dict_file]
        return dict_map_table(df, step.field, table, n_bytes, step.target, step.default)
    return dict_map(df, step.field, dict(step.dict or {}), step.target, step.default)


register("ip_matcher", _ip_matcher)
register("dict_mapper", _dict_mapper)


def resolve(steps: list[TransformSpec]) -> list[Transform]:
    out = []
    for s in steps:
        if s.type not in _REGISTRY:
            raise SpecError(f"unknown transformer type: {s.type}")
        out.append(_REGISTRY[s.type])
    return out


def trimmed_after(step: TransformSpec, ctx: ChainContext, trimmed: frozenset[str], columns: list[str]) -> frozenset[str]:
    """Which keys are known to be trimmed after a step, given those before it."""
    if step.type == "ip_matcher":
        labels = {f"{step.label_fields[i] if i < len(step.label_fields) else f}_{a}" for i, f in enumerate(step.fields) for a in ctx.ip_attrs}
        return trimmed | {n for n in labels if n in trimmed or n not in columns} if ctx.ip_attrs_trimmed else trimmed - labels
    if step.type == "dict_mapper":
        target = step.target or step.field
        texts = [step.default, *(() if step.dict_file else (step.dict or {}).values())]
        clean = all(t == t.strip(WHITE_SPACE) for t in texts) and (target in trimmed or target not in columns)
        return trimmed | {target} if clean else trimmed - {target}
    return frozenset()  # a registered transform may write any key


def trimmed_after_chain(steps: list[TransformSpec], ctx: ChainContext, columns: list[str]) -> frozenset[str]:
    """``trimmed_after`` all steps, over a frame of these columns."""
    trimmed = ctx.trimmed
    for step in steps:
        before, trimmed = trimmed, trimmed_after(step, ctx, trimmed, columns)
        columns = [*columns, *(trimmed - before)]
    return trimmed


def apply_chain(df: DataFrame, steps: list[TransformSpec], ctx: ChainContext) -> DataFrame:
    """P20: run the steps in order.  Keeps ``_transform_error`` (NULL when no step
    failed) so callers can split failed rows off and count them."""
    if TRANSFORM_ERROR not in df.columns:
        df = df.withColumn(TRANSFORM_ERROR, F.lit(None).cast("string"))
    for fn, step in zip(resolve(steps), steps):
        trimmed = trimmed_after(step, ctx, ctx.trimmed, df.columns)
        prev_err = df[TRANSFORM_ERROR]
        df = df.withColumn("_prev_terr", prev_err)
        df = fn(df, step, ctx)
        # an earlier failure sticks: the row left the chain at that step
        df = df.withColumn(TRANSFORM_ERROR, F.coalesce(F.col("_prev_terr"), F.col(TRANSFORM_ERROR))).drop("_prev_terr")
        ctx = replace(ctx, trimmed=trimmed)
    return df

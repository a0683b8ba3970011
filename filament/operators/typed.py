"""Typed output projection.

Output columns are the header fields then the fields, in declared order, each read
from its source key, converted by its declared type (with default / nullable
handling), and renamed to its name.  A row's first failing field in declared order
is carried as codes — ``_err_field`` (index), ``_err_kind``, ``_err_text`` — and its
message (``_error``) is built from them, so the per-row code stays small and the
message strings are only built where they are read.
"""

from __future__ import annotations

from collections.abc import Collection

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from filament.functions.casts import cast_code, error_message, parsed_integer, prepared_text
from filament.functions.text import col
from filament.spec import INT_BITS, UINT_BITS, FieldSpec

ERROR = "_error"
ERR_FIELD, ERR_KIND, ERR_TEXT = "_err_field", "_err_kind", "_err_text"


def prepared(df: DataFrame, fields: list[FieldSpec], keep: list[str], trimmed: Collection[str] = ()):
    """``keep`` and the prepared text of each field — one column for fields that read the same key with the same
    default — and, for integers, its parsed value.  Projections of their own: a conversion references its
    text many times inside CASE branches, where Spark does not share subexpressions.  Returns the frame, each field's
    text column and its parsed column (or None)."""
    texts: dict[tuple, str] = {}
    numbers: dict[tuple, str] = {}
    for f in fields:
        texts.setdefault((f.input_name, f.default), f"_tx{len(texts)}")
        if f.base_type in UINT_BITS or f.base_type in INT_BITS:
            numbers.setdefault((texts[f.input_name, f.default], f.base_type in INT_BITS), f"_nu{len(numbers)}")
    by_name = {name: key for key, name in texts.items()}
    declared = {(f.input_name, f.default): f for f in fields}
    missing = F.lit(None).cast("string")
    df = df.select(*[F.col(k) for k in keep], *[
        prepared_text(col(key[0]) if key[0] in df.columns else missing, declared[key], key[0] in trimmed).alias(name) for name, key in by_name.items()])
    if numbers:
        df = df.withColumns({name: parsed_integer(F.col(text), signed) for (text, signed), name in numbers.items()})
    tx = [texts[f.input_name, f.default] for f in fields]
    return df, tx, [F.col(numbers[t, f.base_type in INT_BITS]) if (t, f.base_type in INT_BITS) in numbers and
                    (f.base_type in UINT_BITS or f.base_type in INT_BITS) else None for t, f in zip(tx, fields)]


def typed_codes(df: DataFrame, fields: list[FieldSpec], keep: list[str] = (), trimmed: Collection[str] = ()) -> DataFrame:
    """Typed values plus ``_err_field, _err_kind, _err_text``.  Keys in ``trimmed`` hold texts without outer white
    space."""
    staged, tx, numbers = prepared(df, fields, keep, trimmed)
    # codes as columns first: the error columns read each of them three times
    values, codes = [], []
    for i, f in enumerate(fields):
        v, c = cast_code(F.col(tx[i]), f, numbers[i])
        values.append(v.alias(f.name))
        codes.append(c.cast("int").alias(f"_cd{i}"))
    coded = staged.select(*[F.col(k) for k in keep], *[F.col(t) for t in dict.fromkeys(tx)], *values, *codes)
    none_i = F.lit(None).cast("int")
    cd = [F.col(f"_cd{i}") for i in range(len(fields))]
    err_field = F.coalesce(*[F.when(c.isNotNull(), F.lit(i)) for i, c in enumerate(cd)], none_i)
    err_kind = F.coalesce(*cd, none_i)
    err_text = F.coalesce(*[F.when(c.isNotNull(), F.col(tx[i])) for i, c in enumerate(cd)],
                          F.lit(None).cast("string"))
    return coded.select(*[F.col(k) for k in keep], *[col(f.name) for f in fields], err_field.alias(ERR_FIELD),
                        err_kind.alias(ERR_KIND), err_text.alias(ERR_TEXT))


def message_column(fields: list[FieldSpec]) -> Column:
    """``_error`` message from the error codes (NULL for a good row)."""
    out = F.lit(None).cast("string")
    for i, f in reversed(list(enumerate(fields))):
        out = F.when(F.col(ERR_FIELD) == i, error_message(f, F.col(ERR_KIND), F.col(ERR_TEXT))).otherwise(out)
    return out


def typed_projection(df: DataFrame, fields: list[FieldSpec], keep: list[str] = ()) -> DataFrame:
    """Typed output columns plus ``_error`` (message) and any ``keep`` columns."""
    t = typed_codes(df, fields, keep)
    return t.withColumn(ERROR, message_column(fields)).drop(ERR_FIELD, ERR_KIND, ERR_TEXT)


def typed_with_errors(df: DataFrame, fields: list[FieldSpec], keep: list[str] = ()) -> DataFrame:
    """Each field's value and its own ``<name>_err`` message, in three projections
    (text → value + code → message) so no single generated method grows too large."""
    staged, tx, numbers = prepared(df, fields, keep)
    cols = []
    for i, f in enumerate(fields):
        v, c = cast_code(F.col(tx[i]), f, numbers[i])
        cols += [v.alias(f.name), c.alias(f"_cd{i}")]
    coded = staged.select(*[F.col(k) for k in keep], *[F.col(t) for t in dict.fromkeys(tx)], *cols)
    out = [F.col(k) for k in keep]
    for i, f in enumerate(fields):
        code = F.col(f"_cd{i}")
        out += [F.col(f.name), F.when(code.isNotNull(), error_message(f, code, F.col(tx[i]))).alias(f"{f.name}_err")]
    return coded.select(*out)

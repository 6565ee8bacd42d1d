"""Projection and cleaning steps: each takes a table and gives a table."""

from __future__ import annotations

import re
from collections.abc import Callable, Iterable, Mapping, Sequence
from functools import reduce
from operator import or_

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.dates import to_date_or_null, to_number_or
from ..functions.nulls import BLANK_DATE, BLANK_MARKS, BLANK_TEXT, as_date, blank_to_null

COMPARE: dict[str, Callable[[Column, object], Column]] = {
    ">": lambda c, v: c > v,
    ">=": lambda c, v: c >= v,
    "<": lambda c, v: c < v,
    "<=": lambda c, v: c <= v,
    "==": lambda c, v: c == v,
    "!=": lambda c, v: ~c.eqNullSafe(F.lit(v)),
}


def compare(col: Column, op: str, value) -> Column:
    if op not in COMPARE:
        raise ValueError(f"operator {op!r} is not one of {sorted(COMPARE)}")
    return COMPARE[op](col, value)


def quoted(name: str) -> Column:
    """The column called exactly ``name``, dots included."""
    return F.col("`" + name.replace("`", "``") + "`")


def safe_name(text: object) -> str:
    """Column-name form of a category value."""
    return re.sub(r"[^a-z0-9]+", "_", str(text).lower()).strip("_")


def value_names(values: Iterable, prefix: str = "", taken: Iterable[str] = ()) -> dict:
    """Column name per category value; two of one name are an error."""
    names = {v: f"{prefix}{safe_name(v)}" for v in values}
    seen = [*names.values(), *taken]
    twice = sorted({n for n in seen if [s.lower() for s in seen].count(n.lower()) > 1})
    if twice:
        raise ValueError(f"values give the same column name: {', '.join(twice)}")
    return names


def require_columns(df: DataFrame, cols: Iterable[str]) -> DataFrame:
    missing = [c for c in cols if c not in df.columns]
    if missing:
        raise ValueError(f"missing columns: {', '.join(missing)}")
    return df


def select_existing(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """Listed columns that exist, in list order."""
    return df.select(*[quoted(c) for c in cols if c in df.columns])


def rename_cols(df: DataFrame, names: Mapping[str, str]) -> DataFrame:
    return df.withColumnsRenamed(dict(names))


def strip_name_prefix(df: DataFrame, text: str, blanks: bool = True) -> DataFrame:
    """Remove ``text`` wherever it stands in a column name; blanks become ``_``."""
    names = [c.replace(text, "") for c in df.columns]
    return df.toDF(*[n.replace(" ", "_") if blanks else n for n in names])


def drop_duplicate_columns(df: DataFrame) -> DataFrame:
    """Keep the first of several columns with one name."""
    marks = [f"_c{i}" for i in range(len(df.columns))]
    first: dict[str, str] = {}
    for mark, name in zip(marks, df.columns):
        first.setdefault(name, mark)
    return df.toDF(*marks).select(*[F.col(m).alias(n) for n, m in first.items()])


def to_date_coerce(df: DataFrame, cols: Sequence[str], fmt: str | None = None) -> DataFrame:
    return df.withColumns({c: to_date_or_null(quoted(c), fmt) for c in cols if c in df.columns})


def to_number_coerce(df: DataFrame, col: str, fill: float | None = 0.0) -> DataFrame:
    return df.withColumn(col, to_number_or(quoted(col), fill))


def sentinel_to_null(df: DataFrame, cols: Sequence[str], marks: Sequence = BLANK_MARKS) -> DataFrame:
    return df.withColumns({c: blank_to_null(quoted(c), marks) for c in cols})


def fill_missing_by_type(
    df: DataFrame, date_cols: Sequence[str] = (), num_cols: Sequence[str] = ()
) -> DataFrame:
    """Fill nulls by type: a far date, zero or a fixed text."""
    out = {}
    for field in df.schema.fields:
        col = quoted(field.name)
        if field.name in date_cols or isinstance(
            field.dataType, (T.DateType, T.TimestampType, T.TimestampNTZType)
        ):
            out[field.name] = F.coalesce(col, F.lit(BLANK_DATE).cast(field.dataType))
        elif field.name in num_cols or isinstance(field.dataType, T.NumericType):
            out[field.name] = F.coalesce(col, F.lit(0).cast(field.dataType))
        elif isinstance(field.dataType, T.StringType):
            out[field.name] = F.coalesce(col, F.lit(BLANK_TEXT))
    return df.withColumns(out)


def fill_value(df: DataFrame, col: str, old, new) -> DataFrame:
    """One literal and null both become ``new``."""
    return df.withColumn(col, F.coalesce(F.nullif(quoted(col), F.lit(old)), F.lit(new)))


def coalesce_cols(df: DataFrame, out: str, *cols: str) -> DataFrame:
    return df.withColumn(out, F.coalesce(*[quoted(c) for c in cols]))


def map_values(df: DataFrame, col: str, mapping: Mapping, out: str | None = None, keep: bool = False) -> DataFrame:
    """Recode through a dictionary; unmapped values become null or stay."""
    pairs = [F.lit(x) for kv in mapping.items() for x in kv]
    hit = F.element_at(F.create_map(*pairs), quoted(col))
    return df.withColumn(out or col, F.coalesce(hit, quoted(col)) if keep else hit)


def flag_equals(df: DataFrame, col: str, out: str, value, yes="yes", no="no") -> DataFrame:
    return df.withColumn(out, F.when(quoted(col).eqNullSafe(F.lit(value)), yes).otherwise(no))


def flag_threshold(df: DataFrame, col: str, out: str, limit, yes="yes", no="no", op: str = ">") -> DataFrame:
    return df.withColumn(out, F.when(compare(quoted(col), op, limit), yes).otherwise(no))


def case_last_wins(df: DataFrame, out: str, rules: Sequence[tuple[Column, object]], default="other") -> DataFrame:
    """Several conditions on one column; a later rule overrides an earlier one."""
    expr = None
    for cond, value in reversed(rules):
        expr = F.when(cond, value) if expr is None else expr.when(cond, value)
    return df.withColumn(out, expr.otherwise(default))


def flag_any(
    df: DataFrame, cols: Sequence[str], limit=0, op: str = "!=", out: str = "status", yes="exeat", no="enrole"
) -> DataFrame:
    """yes when any of the numeric columns passes the test; bad numbers count as 0."""
    tests = [compare(to_number_or(quoted(c)), op, float(limit)) for c in cols]
    return df.withColumn(out, F.when(reduce(or_, tests), yes).otherwise(no))


def update_where(df: DataFrame, cond: Column, col: str, value) -> DataFrame:
    new = value if isinstance(value, Column) else F.lit(value)
    return df.withColumn(col, F.when(cond, new).otherwise(quoted(col)))


def clamp_dates(
    df: DataFrame, col: str, low=None, high=None, low_value=None, high_value=None, out: str | None = None
) -> DataFrame:
    """Raise dates below ``low`` and cap dates above ``high``; null stays null.

    The replacement is the limit itself unless another value is given.
    """
    day = as_date(quoted(col))
    expr = day
    if high is not None:
        expr = F.when(day > as_date(high), as_date(high_value or high)).otherwise(expr)
    if low is not None:
        expr = F.when(day < as_date(low), as_date(low_value or low)).otherwise(expr)
    return df.withColumn(out or col, expr)


def ensure_columns(df: DataFrame, defaults: Mapping[str, tuple[object, str]]) -> DataFrame:
    """Add absent columns as name -> (default, type)."""
    new = {n: F.lit(v).cast(t) for n, (v, t) in defaults.items() if n not in df.columns}
    return df.withColumns(new) if new else df


def make_code(df: DataFrame, col: str, out: str, prefix: str) -> DataFrame:
    """PREFIX-abc-wxyz from the first three and last four characters."""
    text = quoted(col)
    code = F.concat_ws("-", F.lit(prefix), F.substring(text, 1, 3), F.right(text, F.lit(4)))
    return df.withColumn(out, F.upper(code))


#: Most values that may be found and made columns; more have to be declared, or come as rows.
WIDE = 1000


def vocabulary(df: DataFrame, col: str) -> list:
    """Distinct non-null values of a category column, sorted; an error if too many to be columns."""
    rows = df.select(quoted(col).alias("v")).where("v is not null").distinct().limit(WIDE + 1).collect()
    if len(rows) > WIDE:
        raise ValueError(f"{col} has more than {WIDE} values: declare them, or ask for rows")
    return sorted(r.v for r in rows)


def long_flags(df: DataFrame, labels: Column) -> DataFrame:
    """One row per set flag, named in ``flag``; a row without any has a null flag once."""
    return df.withColumn("flag", F.explode_outer(labels))


def _flag_name(prefix: str, value: Column) -> Column:
    """The column name ``value_names`` would give, as an expression."""
    plain = F.regexp_replace(F.lower(value.cast("string")), "[^a-z0-9]+", "_")
    return F.concat(F.lit(prefix), F.btrim(plain, F.lit("_")))


def one_hot(df: DataFrame, col: str, values: Sequence | None = None, dummy_null: bool = False, as_rows: bool = False) -> DataFrame:
    """0/1 column per category, named ``col_value``, for the declared ``values`` or all that are found.

    ``as_rows`` gives the form of ``long_flags`` instead, with the same names,
    for any number of values.
    """
    if as_rows:
        missing = F.lit(f"{col}_null") if dummy_null else F.lit(None)
        return long_flags(df, F.array(F.coalesce(_flag_name(f"{col}_", quoted(col)), missing)))
    names = value_names(vocabulary(df, col) if values is None else values, f"{col}_")
    new = {n: F.when(quoted(col) == F.lit(v), 1).otherwise(0) for v, n in names.items()}
    if dummy_null:
        new[f"{col}_null"] = quoted(col).isNull().cast("int")
    return df.withColumns(new)


def multi_label_flags(
    df: DataFrame, col: str, values: Sequence[str] | None = None, alone: str | None = "aucun", prefix: str = "", as_rows: bool = False
) -> DataFrame:
    """0/1 column per blank-separated token; ``alone`` counts only by itself.

    Without ``values`` all that are found are taken; ``as_rows`` gives the form
    of ``long_flags`` instead, for any number of tokens.
    """
    tokens = F.filter(F.split(F.coalesce(F.lower(F.trim(quoted(col))), F.lit("")), r"\s+"), lambda x: x != "")
    if as_rows:
        counted = F.filter(F.array_distinct(tokens), lambda x: (x != F.lit(alone or "")) | (F.size(tokens) == 1))
        return long_flags(df, F.transform(counted, lambda x: _flag_name(prefix, x)))
    if values is None:
        values = vocabulary(df.select(F.explode(tokens).alias("token")), "token")
    new = {}
    for v, name in value_names(values, prefix).items():
        hit = F.array_contains(tokens, v)
        if v == alone:
            hit = hit & (F.size(tokens) == 1)
        new[name] = F.when(hit, 1).otherwise(0)
    return df.withColumns(new)


def row_max_date(df: DataFrame, out: str, *cols: str) -> DataFrame:
    """Latest of several dates, ignoring nulls."""
    return df.withColumn(out, F.greatest(*[as_date(quoted(c)) for c in cols]))


def probe(df: DataFrame, name: str) -> tuple[DataFrame, Observation]:
    """Count the rows that pass this step without a second job.

    Read ``observation.get["rows"]`` after any action on the result.
    """
    seen = Observation(name)
    return df.observe(seen, F.count(F.lit(1)).alias("rows")), seen


def pipe(df: DataFrame, *steps) -> DataFrame:
    """Apply steps in order; a step is a function or (function, args...)."""
    for step in steps:
        if callable(step):
            df = df.transform(step)
        else:
            func, *args = step
            df = df.transform(func, *args)
    return df

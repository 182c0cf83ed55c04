"""Lenient conversions: text that does not fit becomes null, never an error; NaN never survives."""

from __future__ import annotations

from collections.abc import Iterable, Mapping

from pyspark.sql import Column, DataFrame, functions as F, types as T

# Fill numbers of the solar-wind text format.
FILL_VALUES = (9999999.0, 999999.0, 99999.0, 9999.99, 99999.9, 999.99, 99.99, 9.999, 99.9)

# X-ray flare classes and their strength relative to X1.0.
FLARE_CLASSES = {"A": 1e-4, "B": 1e-3, "C": 1e-2, "M": 1e-1, "X": 1.0}


def utc_time(name: str) -> Column:
    """Timestamp from ISO-like text with a full date; zone-less text is read in the session zone (UTC)."""
    c = f"trim(`{name}`)"
    return F.expr(f"if({c} rlike '^[0-9]{{4}}-[0-9]{{2}}-[0-9]{{2}}', coalesce(try_cast({c} as timestamp), "
                  f"try_to_timestamp({c}, \"yyyy-MM-dd'T'HH:mmX\"), try_to_timestamp({c}, 'yyyy-MM-dd HH:mmX')), null)")


def number(text: str) -> str:
    """SQL for text -> DOUBLE. Java's `1d`/`1f` spellings are not numbers here, NaN is missing."""
    return f"nanvl(try_cast(if({text} rlike '(?i)^[^i]*[df] *$', null, {text}) as double), null)"


#: Expressions of a wide projection between two that are `apart`.
EVERY = 12


def apart(text: str) -> str:
    """SQL for `text` itself, by a lambda, which keeps its projection out of whole-stage code.

    Whole-stage code puts a projection into one method, and Java only interprets methods over 8,000 bytes, which some twenty
    casts or lists of fill values exceed. Outside it Spark cuts the code of the other expressions into small methods.
    """
    return f"get(transform(array({text}), x -> x), 0)"


def no_nan(df: DataFrame) -> DataFrame:
    """All DOUBLE/FLOAT columns with NaN replaced by null."""
    floats = {f.name for f in df.schema if isinstance(f.dataType, (T.DoubleType, T.FloatType))}
    return df.selectExpr(*[f"if(isnan(`{c}`), null, `{c}`) as `{c}`" if c in floats else f"`{c}`" for c in df.columns])


def to_numbers(df: DataFrame, exclude: Iterable[str] = ()) -> DataFrame:
    """Every column but `exclude` as DOUBLE."""
    skip = set(exclude)
    return df.selectExpr(*[f"`{c}`" if c in skip else f"{number(f'cast(`{c}` as string)')} as `{c}`" for c in df.columns])


def fills_to_null(df: DataFrame, columns: Iterable[str],
                  fills: Iterable[float] | Mapping[str, Iterable[float]] = FILL_VALUES) -> DataFrame:
    """Values equal to a fill number become null; `fills` may be given per column."""
    chosen = {c: tuple(fills.get(c, ()) if isinstance(fills, Mapping) else fills) for c in columns}

    marked = [c for c in df.columns if chosen.get(c)][EVERY - 1::EVERY]

    def cleaned(c: str) -> str:
        if not chosen.get(c):
            return f"`{c}`"
        kept = apart(f"`{c}`") if c in marked else f"`{c}`"
        return f"if(`{c}` in ({', '.join(f'{float(v)!r}D' for v in chosen[c])}), null, {kept}) as `{c}`"

    return df.selectExpr(*[cleaned(c) for c in df.columns])


def class_strength(name: str) -> Column:
    """Flare class text such as `M1.4` as a number on the scale where X1.0 is 1."""
    factors = " ".join(f"when '{letter}' then {value!r}D" for letter, value in FLARE_CLASSES.items())
    return F.expr(f"if(length(`{name}`) < 2, null, case upper(left(`{name}`, 1)) {factors} end * "
                  f"{number(f'substring(`{name}`, 2)')})")

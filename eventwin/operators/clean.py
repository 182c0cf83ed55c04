"""Column and row cleaning. Optional columns may be absent; required ones raise before any job runs."""

from __future__ import annotations

import warnings
from collections.abc import Iterable, Mapping, Sequence

from pyspark.sql import DataFrame, functions as F, types as T

from eventwin.operators.scan import _q


def require(df: DataFrame, columns: Iterable[str], what: str) -> None:
    missing = [c for c in columns if c not in df.columns]
    if missing:
        raise ValueError(f"{what} needs column(s) {missing}, found {df.columns}")


def rename_aliases(df: DataFrame, aliases: Mapping[str, Iterable[str]]) -> DataFrame:
    """Rename columns whose lower-cased name is a known synonym: canonical name -> synonyms."""
    canonical = {a: name for name, synonyms in aliases.items() for a in synonyms}
    return df.withColumnsRenamed({c: canonical[c.lower()] for c in df.columns if c.lower() in canonical})


def keep_between(df: DataFrame, ranges: Mapping[str, tuple[float, float]]) -> DataFrame:
    """Rows with every named column inside its closed range; missing values fail."""
    for column, (lo, hi) in ranges.items():
        df = df.where(F.col(column).between(lo, hi))
    return df


def keep_first(df: DataFrame, by: Sequence[str], order: Sequence[str]) -> DataFrame:
    """One row per `by`: the first in `order`, which should leave no ties.

    An aggregate, so copies are reduced before the shuffle however many share a key.
    """
    rest = [c for c in df.columns if c not in by]
    first = F.min_by(F.struct(*_q(rest)), F.struct(*_q(order))).alias("_row")
    return df.groupBy(*_q(by)).agg(first).select(*_q(by), "_row.*").select(*_q(df.columns))


def presence_flag(df: DataFrame, column: str, name: str) -> DataFrame:
    """Replace `column` by a 0/1 flag of whether it had a value."""
    return df.withColumn(name, F.col(column).isNotNull().cast("int")).drop(column)


def merge_categories(df: DataFrame, column: str, *, missing: str, merge: Mapping[str, str]) -> DataFrame:
    """Missing categories become `missing`; categories in `merge` take another's name."""
    filled = F.coalesce(F.col(column), F.lit(missing))
    for old, new in merge.items():
        filled = F.when(filled == old, F.lit(new)).otherwise(filled)
    return df.withColumn(column, filled)


def levels_of(df: DataFrame, column: str, limit: int | None = None) -> list[str]:
    """Sorted distinct values, each of which becomes a column; more than `limit`, if given, is an error."""
    found = df.select(column).where(F.col(column).isNotNull()).distinct()
    found = (found if limit is None else found.limit(limit + 1)).collect()
    if limit is not None and len(found) > limit:
        raise ValueError(f"column '{column}' has more than {limit} levels")
    return sorted(row[0] for row in found)


def one_hot(df: DataFrame, column: str, prefix: str, levels: Sequence[str] | None = None,
            drop_first: bool = True, max_levels: int | None = None) -> DataFrame:
    """Replace `column` by 0/1 columns `<prefix>_<level>`; levels come from the data unless given.

    More levels in the data than `max_levels`, if given, are an error.
    """
    names = list(levels) if levels is not None else levels_of(df, column, max_levels)
    flags = {f"{prefix}_{v}": F.coalesce(F.col(column) == F.lit(v), F.lit(False)).cast("int")
             for v in names[1 if drop_first else 0:]}
    return df.withColumns(flags).drop(column) if flags else df.drop(column)


def drop_all_missing(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Drop rows where every one of `columns` is missing."""
    if not columns:
        raise ValueError("no columns to look at")
    return df.where(" or ".join(f"`{c}` is not null" for c in columns))


def any_present(df: DataFrame, columns: Iterable[str], name: str) -> DataFrame:
    """Boolean column: does any of the existing `columns` have a value? False if none of them exists."""
    present = [c for c in columns if c in df.columns]
    return df.withColumn(name, F.expr(" or ".join(f"`{c}` is not null" for c in present) or "false"))


def feature_columns(df: DataFrame, *, label: str = "label_storm",
                    metadata: Iterable[str] = ("startTime", "year", "kp_max_h72"),
                    keys: Iterable[str] = ()) -> list[str]:
    """All columns that are neither label, metadata nor key."""
    skip = {label, *metadata, *keys}
    return [c for c in df.columns if c not in skip]


def features_and_label(df: DataFrame, features: Sequence[str] | None = None, *, label: str = "label_storm",
                       keys: Sequence[str] = (), metadata: Iterable[str] = ("startTime", "year", "kp_max_h72")
                       ) -> DataFrame:
    """Keys, feature columns (absent ones skipped) and the integer label in one table, never two to be zipped."""
    require(df, [label, *keys], "feature table")
    chosen = feature_columns(df, label=label, metadata=metadata, keys=keys) if features is None else features
    if absent := [c for c in chosen if c not in df.columns]:
        warnings.warn(f"feature table lacks {absent}: they are left out", stacklevel=2)
    return df.select(*_q(keys), *_q([c for c in chosen if c in df.columns]), F.col(label).cast("int"))


def column_kinds(df: DataFrame, columns: Sequence[str] | None = None) -> tuple[list[str], list[str]]:
    """(numeric, categorical) column names; booleans and strings are categorical."""
    kinds = {f.name: f.dataType for f in df.schema}
    chosen = columns if columns is not None else df.columns
    numeric = [c for c in chosen if isinstance(kinds[c], T.NumericType)]
    return numeric, [c for c in chosen if isinstance(kinds[c], (T.StringType, T.BooleanType))]


def feature_groups(prefix: str = "omni_w24_72", stats: Sequence[str] = ("mean", "min", "max", "std")
                   ) -> dict[str, list[str]]:
    """Named feature sets for ablation and reporting."""
    def windows(*columns: str) -> list[str]:
        return [f"{prefix}_{s}_{c}" for c in columns for s in stats]

    # Which features belong together.
    return {
        "cme_properties": ["analysis_speed", "log_speed", "analysis_halfAngle", "analysis_latitude",
                           "analysis_longitude", "abs_latitude", "is_fast_cme", "has_active_region", "cme_type_C",
                           "cme_type_O", "cme_type_S", "start_hour", "start_dow", "feat_cme_energy"],
        "imf_features": [*windows("Bmag", "By_gsm", "Bz_gsm"), "feat_bz_south_depth", "feat_bz_variability_ratio"],
        "solar_wind_features": [*windows("V", "Np", "T", "Pdyn", "beta", "MachA"), "feat_sw_ram_proxy",
                                "feat_coupling"],
        "geomagnetic_indices": windows("AE", "SYM_H"),
    }


def group_columns(df: DataFrame, group: str, **kwargs) -> list[str]:
    """The members of a feature group that the table has."""
    return [c for c in feature_groups(**kwargs)[group] if c in df.columns]

"""Layouts of the input files. Scalars are read as text and converted leniently afterwards."""

from __future__ import annotations

from pyspark.sql import types as T


def _strings(*names: str) -> list[T.StructField]:
    return [T.StructField(n, T.StringType()) for n in names]


# Names and order as in the source files.
ANALYSIS_FIELDS = ("speed", "type", "latitude", "longitude", "halfAngle", "isMostAccurate", "note")

EVENT_JSON = T.StructType([
    *_strings("activityID", "startTime", "sourceLocation", "activeRegionNum"),
    T.StructField("cmeAnalyses", T.ArrayType(T.StructType(_strings(*ANALYSIS_FIELDS)))),
    *_strings("note", "link"),
])

FLARE_JSON = T.StructType(_strings("flrID", "beginTime", "peakTime", "endTime", "classType", "sourceLocation",
                                   "activeRegionNum", "link"))

SOLAR_WIND_COLUMNS = (
    "year", "day", "hour", "minute",
    "imf_id", "plasma_id", "imf_npts", "plasma_npts", "interp_pct", "timeshift_sec", "timeshift_rms", "pfn_rms", "dbot1",
    "Bmag", "Bx_gse", "By_gse", "Bz_gse", "By_gsm", "Bz_gsm", "B_rms", "Bvec_rms",
    "V", "Vx_gse", "Vy_gse", "Vz_gse", "Np", "T", "Pdyn", "Efield", "beta", "MachA",
    "Xgse", "Ygse", "Zgse", "BSN_Xgse", "BSN_Ygse", "BSN_Zgse",
    "AE", "AL", "AU", "SYM_D", "SYM_H", "ASY_D", "ASY_H",
    "NaNp", "MachMS", "QI", "QF", "Lyman_alpha", "QF2", "QF3", "QF4", "QF5", "QF6",
)

EXPORTED_COLUMNS = ("time", "Bmag", "By_gsm", "Bz_gsm", "V", "Np", "T", "Pdyn", "Efield", "beta", "MachA", "AE", "SYM_H")

TIME_ALIASES = ("time", "datetime", "timestamp", "utc_time")
KP_ALIASES = {"time": (*TIME_ALIASES, "date_time"), "kp": ("kp", "kp_index", "kpvalue")}

import json
from datetime import datetime, timezone

import pytest

from eventwin.functions.parse import no_nan
from eventwin.operators.clean import keep_first
from eventwin.sources import catalogues, series, sinks
from eventwin.sources.schemas import EXPORTED_COLUMNS, SOLAR_WIND_COLUMNS


def at(*parts):
    return datetime(*parts, tzinfo=timezone.utc).replace(tzinfo=None)


def rows(df, *columns):
    return [tuple(r[c] for c in columns) for r in df.collect()]


EVENTS = [
    {"activityID": "a", "startTime": "2015-01-01T12:30Z", "activeRegionNum": 12242, "sourceLocation": "S1W2", "extra": 1,
     "cmeAnalyses": [{"speed": 500.5, "type": "S", "latitude": -3, "isMostAccurate": False, "note": "n"},
                     {"speed": 900, "type": "C", "isMostAccurate": True}]},
    {"activityID": "b", "startTime": "2015-01-01T12:30:00Z", "cmeAnalyses": []},
    {"activityID": "c", "startTime": "soon", "cmeAnalyses": None},
    {"activityID": "d", "startTime": "2016-02-29 00:00", "cmeAnalyses": [{"speed": "fast", "type": None, "halfAngle": "12"}]},
]


@pytest.mark.parametrize("lines", [False, True])
def test_events(spark, tmp_path, lines):
    path = tmp_path / "events.json"
    path.write_text("\n".join(map(json.dumps, EVENTS)) if lines else json.dumps(EVENTS, indent=1))
    df = catalogues.read_events(spark, str(path), multi_line=not lines)
    got = {r["activityID"]: r for r in df.collect()}
    assert [got[k]["startTime"] for k in "abcd"] == [at(2015, 1, 1, 12, 30)] * 2 + [None, at(2016, 2, 29)]
    assert (got["a"]["analysis_speed"], got["a"]["analysis_type"], got["a"]["analysis_isMostAccurate"]) == (500.5, "S", False)
    assert got["a"]["activeRegionNum"] == 12242.0 and got["b"]["activeRegionNum"] is None
    assert got["b"]["analysis_speed"] is None and got["c"]["analysis_type"] is None
    assert got["d"]["analysis_speed"] is None and got["d"]["analysis_halfAngle"] == 12.0
    assert len(df.columns) == 13
    flagged = {r["activityID"]: r["analysis_speed"] for r in catalogues.read_events(
        spark, str(path), pick="flagged", multi_line=not lines).collect()}
    assert flagged["a"] == 900.0


def test_flares(spark, tmp_path):
    path = tmp_path / "flares.json"
    classes = ["M1.4", "x2.0", "C", "Z1.0", "Mabc", None, "B1d"]
    path.write_text(json.dumps([{"flrID": str(i), "classType": c, "beginTime": "2015-01-01T12:30Z", "endTime": None}
                                for i, c in enumerate(classes)]))
    got = rows(catalogues.read_flares(spark, str(path)).orderBy("flrID"), "flare_strength")
    assert [None if g[0] is None else round(g[0], 9) for g in got] == [0.14, 2.0, None, None, None, None, None]


def test_kp_csv(spark, tmp_path):
    path = tmp_path / "kp.csv"
    path.write_text("Date_Time,KpValue\n2015-01-02 03:00,9\n2015-01-01 00:00,-1\n2015-01-01 03:00,0\n"
                    "2015-01-01 06:00,9.333\n2015-01-01 09:00,\n2015-01-01 12:00,x\nnever,3\n2015-01-02 03:00,4\n")
    got = sorted(rows(series.read_kp_csv(spark, str(path)), "time", "kp"))
    assert got == [(at(2015, 1, 1, 3), 0.0), (at(2015, 1, 2, 3), 4.0), (at(2015, 1, 2, 3), 9.0)]
    (tmp_path / "bad.csv").write_text("when,kp\n1,2\n")
    with pytest.raises(ValueError):
        series.read_kp_csv(spark, str(tmp_path / "bad.csv"))


def test_wide_csv(spark, tmp_path):
    path = tmp_path / "omni.csv"
    path.write_text("timestamp,V,Np\n2015-01-01 00:00:00+00:00,400,nan\n,1,2\n2015-01-01T00:05:00Z,abc,1e3\n")
    got = sorted(rows(series.read_wide_csv(spark, str(path)), "time", "V", "Np"))
    assert got == [(at(2015, 1, 1), 400.0, None), (at(2015, 1, 1, 0, 5), None, 1000.0)]


def kp_line(y, m, d, h, kp):
    return f"{y:4d} {m:02d} {d:02d} {h:4.1f}".ljust(46) + f"{kp:6.3f}"


def test_kp_fixed_width(spark, tmp_path):
    path = tmp_path / "kp.txt"
    path.write_text("\n".join(["# head", "", "2015 01", kp_line(2014, 12, 31, 21, 1), kp_line(2015, 1, 1, 0, 2.667),
                               kp_line(2015, 1, 1, 0, 3), kp_line(2015, 1, 2, 22.5, 4), kp_line(2015, 1, 3, 0, 5),
                               kp_line(2015, 2, 30, 0, 6), "text that is long enough to be cut but holds no numbers"]))
    got = sorted(rows(series.read_kp_text(spark, str(path), "2015-01-01", "2015-01-02"), "time", "kp"))
    assert got == [(at(2015, 1, 1), 2.667), (at(2015, 1, 2, 22, 30), 4.0)]


def wind_line(year, day, hour, minute, n=54, **values):
    cells = {**{c: "1" for c in SOLAR_WIND_COLUMNS}, "year": year, "day": day, "hour": hour, "minute": minute, **values}
    return "  ".join(str(cells.get(c, 7)) for c in [*SOLAR_WIND_COLUMNS, "x1", "x2"][:n])


def write_years(folder):
    (folder / "omni_5min2015.asc").write_text("\n".join([
        "YEAR DAY HR MN", wind_line(2015, 1, 0, 0, V=400.5, Bmag="9999.99", Np="999.99", T=9999999, AE="99999"),
        wind_line(2015, 1, 0, 5, n=30), wind_line(2015, 1, 0, 10, n=56, V="1d", SYM_H="nan"), wind_line(2015, 0, 0, 0),
        wind_line(2015, 367, 0, 0), wind_line(2015, 1, 24, 0), wind_line(1990, 1, 0, 0), wind_line(2015, 365, 23, 55),
        wind_line(2016, 1, 0, 0, V=111)]))
    (folder / "omni_5min2016.asc").write_text("\n".join([wind_line(2016, 1, 0, 0, V=222), wind_line(2016, 366, 0, 0, MachA="999.9")]))


def test_solar_wind_text(spark, tmp_path):
    write_years(tmp_path)
    got = {r["time"]: r for r in series.read_solar_wind_text(spark, f"{tmp_path}/*.asc").collect()}
    assert sorted(got) == [at(2015, 1, 1), at(2015, 1, 1, 0, 5), at(2015, 1, 1, 0, 10), at(2015, 12, 31, 23, 55),
                           at(2016, 1, 1), at(2016, 12, 31)]
    first = got[at(2015, 1, 1)]
    assert first["V"] == 400.5 and [first[c] for c in ("Bmag", "Np", "T", "AE")] == [None] * 4
    assert got[at(2015, 1, 1, 0, 5)]["AE"] is None and got[at(2015, 1, 1, 0, 5)]["V"] == 1.0
    assert got[at(2015, 1, 1, 0, 10)]["V"] is None and got[at(2015, 1, 1, 0, 10)]["SYM_H"] is None
    assert got[at(2016, 1, 1)]["V"] == 111.0  # the first file wins
    assert got[at(2016, 12, 31)]["MachA"] == 999.9
    own = series.read_solar_wind_text(spark, f"{tmp_path}/*.asc", fills={"MachA": [999.9]}).where("time > '2016-12-01'").first()
    assert own["MachA"] is None


def test_build_once(spark, tmp_path):
    raw, out = tmp_path / "raw", str(tmp_path / "series")
    raw.mkdir()
    with pytest.raises(FileNotFoundError):
        series.build_series_once(spark, str(raw), out, 2015, 2016)
    write_years(raw)
    first = series.build_series_once(spark, str(raw), out, 2015, 2016)
    assert first.columns == list(EXPORTED_COLUMNS) and first.count() == 6
    (raw / "omni_5min2016.asc").write_text(wind_line(2016, 5, 0, 0))
    assert series.build_series_once(spark, str(raw), out, 2015, 2016).count() == 6
    again = series.build_series_once(spark, str(raw), out, 2015, 2016, overwrite=True)
    assert again.count() == 6  # two instants of 2016 gone, one new, one left in the 2015 file
    csv = str(tmp_path / "csv")
    series.export_series(again, csv, ("time", "V", "absent"), format="csv")
    assert spark.read.csv(csv, header=True).columns == ["time", "V"]
    with pytest.raises(ValueError):
        series.combine_series()


def test_keep_first_is_deterministic(spark):
    df = spark.range(300).selectExpr("id % 7 as k", "id as o", "cast(null as string) as s")
    for n in (1, 11):
        assert sorted(rows(keep_first(df.repartition(n), ["k"], ["o"]), "k", "o", "s")) == [(i, i, None) for i in range(7)]


def test_no_nan_and_landing(spark, tmp_path):
    df = spark.createDataFrame([(1, float("nan")), (2, 2.0)], "i int, x double")
    assert sorted(rows(no_nan(df), "i", "x")) == [(1, None), (2, 2.0)]
    for kind in ("parquet", "csv"):
        landed = sinks.land(no_nan(df), str(tmp_path / kind), format=kind)
        assert sorted(rows(landed, "i", "x")) == [(1, None), (2, 2.0)]


# JSON arrays in byte ranges -----------------------------------------------------------------

def odd_objects(n):
    import random

    draw = random.Random(n)
    bits = ["}", "{", "[", "]", '"', "\\", "\n", "é", "\U0001f600", "a", ",", ":", " ", "\\\"", "}\\", "]}"]
    text = lambda: "".join(draw.choice(bits) for _ in range(draw.randint(0, 25)))
    return [{"id": i, text() or "k": text(), "deep": [{"x": [text(), {"y": text()}]}, []], "none": None} for i in range(n)]


@pytest.mark.parametrize("indent", [None, 0, 3])
@pytest.mark.parametrize("size", [64, 1_000, 1 << 27])
def test_arrays_are_read_in_ranges(spark, tmp_path, indent, size):
    """Ranges of any size give the same objects, however the array is laid out; most objects are longer than the smallest range."""
    from eventwin.sources.json_arrays import array_objects
    folder, want = tmp_path / "arrays", []
    folder.mkdir()
    for n in (0, 1, 40):
        objects = odd_objects(n)
        want += objects
        (folder / f"{n}.json").write_text(json.dumps(objects, indent=indent, ensure_ascii=n == 1) + "\n" * n)
    before = {k: spark.conf.get(k) for k in ("spark.sql.files.maxPartitionBytes", "spark.sql.files.openCostInBytes")}
    try:
        spark.conf.set("spark.sql.files.maxPartitionBytes", size)
        spark.conf.set("spark.sql.files.openCostInBytes", 0)
        parts = spark.read.option("lineSep", "}").text(str(folder)).rdd.getNumPartitions()
        got = [json.loads(r["value"]) for r in array_objects(spark, str(folder)).collect()]
    finally:
        for k, v in before.items():
            spark.conf.set(k, v)
    assert parts > 4 or size > 1_000
    key = lambda o: json.dumps(o, sort_keys=True)
    assert sorted(map(key, got)) == sorted(map(key, want))


def test_arrays_with_other_elements_and_no_end(spark, tmp_path):
    from eventwin.sources.json_arrays import array_objects, read_json_array
    (tmp_path / "mixed.json").write_text('[1, "a}", [{"no": 1}], {"id": 5}, null, {"id": 6, "t": {"u": "cut')
    assert sorted(r["value"] for r in array_objects(spark, str(tmp_path)).collect())[0].startswith('{"id": 5}')
    got = read_json_array(spark, str(tmp_path), "id int").collect()
    assert {r["id"] for r in got} >= {5} and len(got) == 2


# lines that are left out ----------------------------------------------------------------------

def test_every_line_is_accepted_or_has_a_reason(spark, tmp_path):
    wind = ["2015 1 0 0 1 2", "YEAR DAY HR MN", "", "   ", None, "1990 1 0 0", "2015 367 0 0", "2015 1 24 0", "2015 1 0 60", "2015 1 x 0", "2015 60 1 5 9.5"]
    lines = spark.createDataFrame([(v, f"f{i % 2}") for i, v in enumerate(wind)], "value string, file string")
    judged = series.judge_solar_wind_lines(lines)
    accepted, rejected = series.write_judged(judged, str(tmp_path / "wind"))
    key = lambda df: sorted(map(str, df.drop("value").collect()))
    assert key(accepted) == key(series.parse_solar_wind_lines(lines)) and accepted.count() == 2
    assert sorted(r["reason"] for r in rejected.collect()) == sorted(
        ["blank"] * 3 + ["no year", "no hour", "year out of range", "day out of range", "hour out of range", "minute out of range"])
    assert sum(r["n"] for r in series.line_report(judged, ["file"]).collect()) == len(wind)
    kp = ["# c", "", "2015 01 01 00.0".ljust(46) + " 1.333", "2015 13 01 00.0".ljust(46) + " 1.333", "2014 01 01 00.0".ljust(46) + " 1.333",
          "2015 01 02 00.0".ljust(46) + " none ", "short", None]
    judged = series.judge_kp_lines(spark.createDataFrame([(v,) for v in kp], "value string"), "2015-01-01", "2015-12-31")
    assert {r["reason"]: r["n"] for r in series.line_report(judged).collect()} == {
        "comment": 1, "blank": 2, "accepted": 1, "no time": 2, "outside the period": 1, "no value": 1}


# wide lines -------------------------------------------------------------------------------------

def _methods(spark, df):
    found = spark.sparkContext._jvm.org.apache.spark.sql.execution.debug.package.codegenStringSeq(df._jdf.queryExecution().executedPlan())
    return [found.apply(i)._3().maxMethodCodeSize() for i in range(found.size())]


def test_wide_lines_need_no_method_that_java_only_interprets(spark):
    from queries.parsing import QUERIES
    lines = spark.createDataFrame([("2015 1 0 0 1 2", "f")], "value string, file string")
    for df in (series.parse_solar_wind_lines(lines), series.judge_solar_wind_lines(lines), series.trim_series(series.parse_solar_wind_lines(lines)),
               QUERIES["whitespace_parse"](spark, "/root/testdata/sf0.001")):
        assert max(_methods(spark, df)) < 8_000


def test_words_of_any_spelling(spark):
    words = ["7", "-0", "+5", ".5", "5.", "-3.125", "0012", "1e3", "-1E-3", "1e400", "9" * 15, "9" * 16, "1." + "3" * 40, "0.1234567890123456789", "2.2250738585072012e-308",
             "1d", "1F", "0x1p3", "0x1p3d", "nan", "-inf", "Infinity", "infd", "1_0", "1,5", "1-2", "--1", "-", "e5", "\u0663", "\u00a01", "1\x00", "\x1c1", "99.99", "x"]
    gaps = [" ", "   ", "\t", " \t ", "\n", "\x0b", "\f", "\r\n"]
    plain = [f"2015 1 {i % 24} 0 {w} 2 {w}" for i, w in enumerate(words)]
    lines = plain + [f"{a}2015{g}1 2 3 {w}{g}4{b}" for g in gaps for w in ("1.5", "1d", "x") for a in ("", "  ", g) for b in ("", " ", g)]
    lines += [" ".join(["2015", "1", "1", "1", *map(str, range(n))]) for n in (1, 49, 50, 51)] + ["", " ", "2015", None, "1 " * 54]
    df = spark.createDataFrame([(i, v) for i, v in enumerate(lines)], "i int, value string")
    cut = r"transform(split(trim(value), '\\s+'), x -> if(x rlike '(?i)^[^i]*[df]$', null, x))"
    want = df.selectExpr("i", *[f"nanvl(try_cast(get({cut}, {k}) as double), null) as `{c}`" for k, c in enumerate(series.SOLAR_WIND_COLUMNS)])
    got = series.judge_solar_wind_lines(df, fills=()).select(*want.columns)
    key = lambda d: sorted(map(repr, d.collect()))
    assert key(got) == key(want)
    assert "ArrowEvalPython" in got._jdf.queryExecution().toString()


def test_text_of_lines(spark):
    from queries import parsing
    rows = [(k, p, s, n, q, 12345.67 * (p or 1), 0.07, 0.001 * (s or 1), t) for k, p, s, n, q, t in (
        (1, 1, 1, 1, 17.0, "1996-03-13"), (-7, 3, 7, 2, 1e7, "1996-12-31"), (10**15, 5, 13, 3, 0.5, "2030-01-01"), (797, 15, 91, 7, 50.0, "1995-02-28"),
        (5, None, 14, 4, None, "1997-01-01"), (None, 2, None, 5, 3.0, None), (6, 4, 21, None, 2.0, "1998-06-01"))]
    df = spark.createDataFrame(rows, "l_orderkey long, l_partkey long, l_suppkey long, l_linenumber int, l_quantity double, l_extendedprice double, "
                               "l_discount double, l_tax double, l_shipdate string").selectExpr("* except (l_shipdate)", "cast(l_shipdate as timestamp_ntz) as l_shipdate")
    own = {13: "if(l_partkey % 3 = 0, '99.99', cast(l_quantity as string))", 21: "if(l_partkey % 5 = 0, '99999.9', cast(l_extendedprice as string))", 25: "l_discount", 37: "l_linenumber", 41: "l_tax"}
    words = ["year(l_shipdate)", "dayofyear(l_shipdate)", "l_linenumber", "cast(l_quantity as int)"]
    words = [f"cast({w} as string)" for w in words + [own.get(i, f"(l_orderkey * {i} + l_linenumber) % 797 / 8D") for i in range(4, 54)]]
    want = df.selectExpr("l_orderkey", "l_partkey", "l_suppkey", "l_linenumber", f"""if(l_suppkey % 13 = 0, 'YEAR DAY HR MN', if(l_suppkey % 7 = 0,
concat_ws('  ', {", ".join(words[:38])}), concat(' ', concat_ws(' ', {", ".join(words)})))) as value""")
    assert sorted(map(repr, parsing._lines(df).collect())) == sorted(map(repr, want.collect()))


# versions and updates ---------------------------------------------------------------------------

def test_published_versions(spark, tmp_path):
    from eventwin.sources.versions import Build, published
    folder = str(tmp_path / "set")
    with pytest.raises(FileNotFoundError):
        published(spark, folder)
    numbers = []
    for n in (3, 4):
        build = Build(spark, folder)
        build.add("a", spark.range(n).selectExpr("id", "id % 2 as part"), ["part"])
        assert n == 3 or published(spark, folder)["a"].count() == 3  # written, not published
        build.add("b", spark.range(n))
        numbers.append(build.publish())
    lost = Build(spark, folder)
    lost.add("a", spark.range(9))
    got = published(spark, folder)
    assert numbers == [1, 2] and {name: df.count() for name, df in got.items()} == {"a": 4, "b": 4}
    assert {name: df.count() for name, df in published(spark, folder, 1).items()} == {"a": 3, "b": 3}
    with pytest.raises(FileNotFoundError):
        published(spark, folder, 7)


def test_updates_equal_a_single_reading(spark, tmp_path, monkeypatch):
    raw, out = tmp_path / "raw", str(tmp_path / "out")
    raw.mkdir()
    with pytest.raises(FileNotFoundError, match="2015, 2016"):
        series.update_series(spark, str(raw), out, 2015, 2016)
    write_years(raw)
    assert series.update_series(spark, str(raw), out, 2015, 2016) == [2015, 2016]
    assert series.update_series(spark, str(raw), out, 2015, 2016) == []

    def whole():
        files = [str(raw / f"omni_5min{y}.asc") for y in (2015, 2016)]
        return sorted(map(str, series.trim_series(series.read_solar_wind_text(spark, files)).collect()))

    read = lambda: sorted(map(str, series.updated_series(spark, out, 2015, 2016).collect()))
    assert read() == whole() and len(whole()) == 6
    before = read()
    (raw / "omni_5min2016.asc").write_text(wind_line(2016, 5, 0, 0) + wind_line(2016, 6, 0, 0))
    with monkeypatch.context() as patch:  # lost between the files and the commit
        def lost(*_):
            raise RuntimeError("lost")
        patch.setattr(series, "record", lost)
        with pytest.raises(RuntimeError):
            series.update_series(spark, str(raw), out, 2015, 2016)
    assert read() == before
    assert series.update_series(spark, str(raw), out, 2015, 2016) == [2016]
    assert read() == whole() != before
    with pytest.raises(FileNotFoundError, match="2017"):
        series.updated_series(spark, out, 2015, 2017)

"""Conversion of small trees, with exact values."""

import shutil
from datetime import datetime

import pyarrow.parquet as pq
import pytest

from isohyet.errors import ConfigurationError, DatasetNotFound, SchemaVarianceExceeded
from isohyet.operators.convert import Converter, Options, default_output
from isohyet.operators.validate import Limits, Validator, report_summary
from isohyet.plans.rowgroups import rows_per_group
from isohyet.plans.spec import EXPECTED, Kind, kind_of, type_of
from isohyet.sinks.parquet import ParquetOptions, codec, merge
from isohyet.sources import badc
from isohyet.sources.discovery import datasets, file_table, files, files_by_station

HEAD = "observation_station,G,{name}\nmidas_station_id,G,{id}\nhistoric_county_name,G,{county}\nlocation,G,{lat},{lon}\nheight,G,{h},m\n"
COLS = "ob_end_ctime,prcp_amt,prcp_amt_q"
ROWS = "2023-01-01,5.0,0\n2023-01-02,3.2,0\n2023-01-03,0.0,0\n"


def text(rows=ROWS, cols=COLS, id="00001", name="Test Station", county="testshire", lat="51.5", lon="-0.1", h="10", end="end data\n"):
    return HEAD.format(id=id, name=name, county=county, lat=lat, lon=lon, h=h) + f"data\n{cols}\n{rows}{end}"


@pytest.fixture
def tree(tmp_path):
    def make(files: dict, name="uk-daily-rain-obs"):
        root = tmp_path / "cache" / "sets" / name
        (root / "qcv-1").mkdir(parents=True)
        for path, content in files.items():
            f = root / "qcv-1" / path
            f.parent.mkdir(parents=True, exist_ok=True)
            f.write_bytes(content if isinstance(content, bytes) else content.encode())
        return str(root)

    return make


def converted(spark, root, **options):
    job = Converter(spark, root, options=Options(**options))
    return job.run(), spark.read.parquet(job.output)


def test_minimal_file(spark, tree):
    stats, df = converted(spark, tree({"a/s1/f.csv": text()}))
    assert (stats.files_processed, stats.files_failed, stats.total_rows) == (1, 0, 3)
    assert df.dtypes == [("ob_end_ctime", "timestamp_ntz"), ("prcp_amt", "double"), ("prcp_amt_q", "int"), ("station_id", "string"), ("station_name", "string"), ("county", "string"), ("latitude", "double"), ("longitude", "double"), ("height", "double"), ("height_units", "string")]
    assert [tuple(r) for r in df.collect()] == [(datetime(2023, 1, d), v, 0, "00001", "Test Station", "testshire", 51.5, -0.1, 10.0, "m") for d, v in ((1, 5.0), (2, 3.2), (3, 0.0))]


def test_discovery_only_and_empty(spark, tree):
    job = Converter(spark, tree({"a/s1/f.csv": text()}), options=Options(discovery_only=True))
    assert job.run().files_processed == 0
    assert [tuple(r) for r in job.discover().collect()] == [("ob_end_ctime", "timestamp_ntz", False, False, True), ("prcp_amt", "double", False, False, False), ("prcp_amt_q", "int", False, False, False)]


def test_empty_dataset(spark, tree):
    stats = Converter(spark, tree({})).run()
    assert (stats.files_processed, stats.files_failed, stats.total_rows, stats.output_path) == (0, 0, 0, None)


def test_missing_dataset(spark, tmp_path):
    with pytest.raises(DatasetNotFound) as e:
        files(spark, str(tmp_path / "none"))
    assert e.value.path == str(tmp_path / "none")


def test_union_by_name(spark, tree):
    """Columns that differ in order and number bind by name; a missing one is NULL."""
    root = tree(
        {
            "a/s1/1.csv": text("2023-01-01,1.5,0\n"),
            "a/s2/2.csv": text("0,2.5,2023-01-02\n", "prcp_amt_q,prcp_amt,ob_end_ctime", id="00002"),
            "a/s3/3.csv": text("2023-01-03,x y\n", "ob_end_ctime,extra_col", id="00003"),
        }
    )
    _, df = converted(spark, root)
    assert [tuple(r) for r in df.select("station_id", "prcp_amt", "prcp_amt_q", "extra_col").collect()] == [("00001", 1.5, 0, None), ("00002", 2.5, 0, None), ("00003", None, None, "x y")]
    with pytest.raises(SchemaVarianceExceeded):
        Converter(spark, root, options=Options(schema_variance=1)).run()


def test_missing_values_and_casts(spark, tree):
    rows = "2023-01-01,NA,5.0,NA\n2023-01-02, 2.5 , 7 ,a\n2023,1e1,99999999999,\nNA,abc,-3,\"x, y\"\n"
    _, df = converted(spark, tree({"a/s1/f.csv": text(rows, COLS + ",note")}))
    got = [tuple(r) for r in df.select("ob_end_ctime", "prcp_amt", "prcp_amt_q", "note").collect()]
    assert got[:2] == [(datetime(2023, 1, 1), None, None, None), (datetime(2023, 1, 2), 2.5, 7, "a")]
    assert sorted(map(str, got[2:])) == sorted(map(str, [(None, 10.0, None, None), (None, None, -3, "x, y")]))  # nulls last


def test_empty_columns(spark, tree):
    """A column that is empty in the first files but not in all stays; one without any value goes."""
    root = tree({"a/s1/1.csv": text("2023-01-01,NA,NA\n"), "a/s2/2.csv": text("2023-01-02,1.0,NA\n", id="2")})
    _, df = converted(spark, root)
    assert "prcp_amt" in df.columns and "prcp_amt_q" not in df.columns
    _, df = converted(spark, root, empty_columns="sample", sample_files=1)
    assert "prcp_amt" not in df.columns
    _, df = converted(spark, root, empty_columns="off")
    assert "prcp_amt_q" in df.columns


def test_file_outcomes(spark, tree):
    root = tree(
        {
            "a/s1/1_ok.csv": text(),
            "a/s1/2_crlf.csv": text(id="2").replace("\n", "\r\n"),
            "a/s1/3_no_marker.csv": "just some text\n",
            "a/s1/4_bad_header.csv": "observation_station,G,x\ndata\na\n1\nend data\n",
            "a/s1/5_zero.csv": "",
            "a/s1/6_no_end.csv": text("2023-01-01,1.0,0\n2023-01-02,2.0,0\n", id="3", end=""),
            "a/s1/7_bad_utf8.csv": text(name="X").encode().replace(b"X", b"\xff"),
            "a/s1/8_bad_height.csv": text(h="high"),
            "a/s1/9.txt": "no csv",
            "a/s1/deep/10.csv": text(),
        }
    )
    job = Converter(spark, root)
    got = {r["path"].rsplit("/", 1)[1]: (r["status"], r["error"], r["n_rows"]) for r in job.outcomes().collect()}
    assert got == {
        "1_ok.csv": ("ok", None, 3),
        "2_crlf.csv": ("ok", None, 3),
        "3_no_marker.csv": ("NoDataMarker", "no data marker", 0),
        "4_bad_header.csv": ("HeaderParsingFailed", "missing midas_station_id", 0),
        "5_zero.csv": ("NoDataMarker", "no data marker", 0),
        "6_no_end.csv": ("ok", None, 2),
        "7_bad_utf8.csv": ("InvalidEncoding", "not UTF-8", 0),
        "8_bad_height.csv": ("HeaderParsingFailed", "missing height", 0),
    }
    stats = job.run()
    assert (stats.files_processed, stats.files_failed, stats.total_rows) == (3, 5, 8)


def test_header_rules(spark, tree):
    """Comments, padding, repeated keys, per-variable lines, a repeated data line and the worked boundary."""
    head = "#c\n\n midas_station_id ,G, 00147 \nobservation_station,G,old\nobservation_station,G,braemar\nx,long_name,ob\nhistoric_county_name,G,aberdeenshire\nlocation,G,57.006,-3.398\nheight,G,339,m\n"
    root = tree({"a/s/1.csv": head + " data \nob_end_ctime\nend data\n", "a/s/2.csv": head + "data\nignored\ndata\nob_end_ctime\n2020-01-01\nend data\n", "a/s/3.csv": head + "location,G,nowhere\ndata\nc\nend data\n"})
    got = {r["path"][-5]: r for r in Converter(spark, root).parsed().collect()}
    one = got["1"]
    assert (one.station_id, one.station_name, one.county, one.latitude, one.longitude, one.height, one.height_units) == ("00147", "braemar", "aberdeenshire", 57.006, -3.398, 339.0, "m")
    assert (one.skip_rows, one.data_rows, one.rows) == (10, 1, [])
    assert got["2"].rows == ["2020-01-01"] and got["2"].cols == ["ob_end_ctime"]
    assert got["3"].error == "missing location"  # a later invalid value counts


def test_many_stations(spark, tree):
    rows = lambda n: "".join(f"2023-01-0{d},1.0,0\n" for d in range(1, n + 1))
    root = tree({"a/00001_x/f.csv": text(rows(2)), "a/00002_y/f.csv": text(rows(3), id="00002"), "b/00003_z/f.csv": text(rows(4), id="00003")})
    stats, df = converted(spark, root)
    assert (stats.files_processed, stats.total_rows) == (3, 9)
    found = file_table(spark, root)
    assert {r["station_key"]: len(r["files"]) for r in files_by_station(found).collect()} == {"00001": 1, "00002": 1, "00003": 1}
    listed = datasets(spark, root.rsplit("/", 1)[0])
    assert [(d.name, d.size.startswith("3 files, ~")) for d in listed] == [("uk-daily-rain-obs", True)]


def test_output_options(spark, tree, tmp_path):
    root = tree({"a/s/f.csv": text("".join(f"2023-01-{d:02d},{d}.0,0\n" for d in range(1, 31)))})
    for name in ("snappy", "zstd", "lz4", "none"):
        out = str(tmp_path / f"{name}.parquet")
        job = Converter(spark, root, out, Options(parquet=ParquetOptions(compression=name, rows_per_group=10)))
        assert job.run().total_rows == 30
        m = pq.ParquetFile(out).metadata
        assert [m.row_group(i).num_rows for i in range(m.num_row_groups)] == [10, 10, 10]
        assert m.row_group(0).column(0).is_stats_set
        assert {"created_by", "created_at", "repository"} <= {k.decode() for k in pq.ParquetFile(out).schema_arrow.metadata}
    assert codec("brotli")[0] == "snappy" and codec("brotli")[1]
    out = str(tmp_path / "dir")
    Converter(spark, root, out, Options(layout="directory")).run()
    assert spark.read.parquet(out).count() == 30
    assert merge(spark, out, str(tmp_path / "merged.parquet"), ["station_id", "ob_end_ctime"]) == 30


def test_odd_paths(spark, tree):
    """Blanks, per cents and plus signs in folders: outcomes and the sample find these files."""
    root = tree({"a b/00001_a b/f.csv": text(), "c%20d/00002_c%20d/g+h.csv": text(id="2"), "é/00003_%/x%2By.csv": text("2023-01-01,NA,1\n", id="3"), "a b/00004/bad one.csv": "nothing"}, "uk daily rain%20obs")
    job = Converter(spark, root, options=Options(empty_columns="sample", sample_files=1))
    got = {r["path"].rsplit("/", 1)[1]: (r["status"], r["n_rows"]) for r in job.outcomes().collect()}
    assert got == {"f.csv": ("ok", 3), "g+h.csv": ("ok", 3), "x%2By.csv": ("ok", 1), "bad one.csv": ("NoDataMarker", 0)}
    stats = job.run()
    assert (stats.files_processed, stats.files_failed, stats.total_rows) == (3, 1, 7)
    assert "prcp_amt" in spark.read.parquet(job.output).columns
    assert {r["path"].rsplit("/", 1)[1] for r in file_table(spark, root).collect()} == set(got)


def test_one_file_keeps_all_options(spark, tree, tmp_path):
    """No page is written anew: dictionary, bloom filters, page index and statistics are as the writer made them."""
    root = tree({"a/s/f.csv": text("".join(f"2023-01-{d:02d},{d % 3}.0,0\n" for d in range(1, 31)))})
    out = str(tmp_path / "x.parquet")
    for dictionary, statistics in ((True, True), (False, False)):
        options = ParquetOptions(dictionary=dictionary, statistics=statistics, bloom_columns=("station_id",), page_bytes=64)
        Converter(spark, root, out, Options(parquet=options)).run()
        f = pq.ParquetFile(out)
        columns = [f.metadata.row_group(0).column(i) for i in range(f.metadata.num_columns)]
        assert all(c.is_stats_set == statistics for c in columns)
        plain = [c for c in columns if c.path_in_schema == "prcp_amt"][0]
        assert ("RLE_DICTIONARY" in plain.encodings or "PLAIN_DICTIONARY" in plain.encodings) == dictionary
        assert all(c.has_offset_index for c in columns)
        assert f.read().num_rows == 30 and spark.read.parquet(out).count() == 30
    assert [x.name for x in tmp_path.iterdir() if x.name.startswith("x.") and not x.name.endswith(".crc")] == ["x.parquet"]


def test_footer_metadata_is_all_that_changes():
    import io

    import pyarrow as pa

    from isohyet.sources.footers import metadata_of, with_key_values

    for n in (1, 13, 14, 40):
        sink = io.BytesIO()
        schema = pa.schema([("a", pa.int64()), ("b", pa.list_(pa.string()))], metadata={f"k{i}": "v" * i * 9 for i in range(n)})
        pq.write_table(pa.table({"a": [1, 2], "b": [["x"], None]}, schema=schema), sink)
        data = sink.getvalue()
        size = int.from_bytes(data[-8:-4], "little")
        before = metadata_of(data[-8 - size : -8])
        after = metadata_of(with_key_values(data[-8 - size : -8], {"created_by": "é" * 200, "x": ""}))
        assert after.metadata == (before.metadata or {}) | {b"created_by": ("é" * 200).encode(), b"x": b""}
        assert after.to_dict()["row_groups"] == before.to_dict()["row_groups"] and after.schema.equals(before.schema)


def test_widths_warn(spark, tree):
    job = Converter(spark, tree({"a/s/f.csv": text()}))
    stats = job.run()
    assert len(stats.warnings) == 1 and "3 columns, 15 expected" in stats.warnings[0]
    assert "rain: 3 columns in 1 files" in job.discovered() and "times: ob_end_ctime" in job.discovered()


def test_many_rows_go_to_several_files(spark, tree, monkeypatch):
    from isohyet.operators import convert

    monkeypatch.setattr(convert, "MANY_ROWS", 2)
    job = Converter(spark, tree({"a/s/f.csv": text()}), options=Options(files_per_task=7))
    before = spark.conf.get("spark.sql.files.openCostInBytes", None)
    job.run()
    assert spark.read.parquet(job.output).count() == 3 and spark.conf.get("spark.sql.files.openCostInBytes", None) == before
    with pytest.raises(Exception, match="not a file|Is a directory|directory"):
        pq.ParquetFile(job.output)


def test_order_over_runs_and_files(spark, monkeypatch):
    from isohyet.operators import observations as obs

    monkeypatch.setattr(obs, "RUN", 3)
    rows = [("f1", i, s, t) for i, (s, t) in enumerate([("a", 1), ("a", 2), ("a", 3), ("a", 2), ("b", 1), ("b", None), ("b", 5), ("a", 9)])]
    rows += [("f2", 0, "a", 8), ("f2", 1, "c", 1), ("f3", 0, None, 1), ("f4", 0, "d", 1)]
    df = spark.createDataFrame(rows, "f string, r long, s string, t int")
    got = {r.file: (r.n_station, r.n_time, r.n_between) for r in obs.order_violations(df, "s", "t", obs.F.col("f"), obs.F.col("r")).collect()}
    assert got == {"f1": (1, 2, 0), "f2": (0, 0, 1), "f3": (0, 0, 0), "f4": (0, 0, 1)}


def test_equal_records_give_the_same_one_each_time(spark):
    from isohyet.operators import observations as obs

    rows = [("k", 1, 2, v) for v in "dacb"]
    for n in (1, 2, 4):
        df = spark.createDataFrame(rows, "k string, rec_st_ind int, version_num int, v string").repartition(n)
        assert [r.v for r in obs.one_record_each(df, ["k"]).collect()] == ["a"]


def test_kinds_of_all_datasets():
    names = ["uk-daily-rain-obs", "uk-hourly-rain-obs", "uk-daily-weather-obs", "uk-hourly-weather-obs", "uk-daily-temperature-obs", "uk-soil-temperature-obs", "uk-mean-wind-obs", "uk-radiation-obs"]
    assert [kind_of(n).value for n in names] == ["rain", "rain", "weather", "weather", "temperature", "soil", "wind", "radiation"]
    assert Kind.WEATHER.time_in(["ob_time", "x"]) == "ob_time" and Kind.SOIL.time_in(["x"]) is None and Kind.RAIN.time_in(["ob_end_time"]) == "ob_end_time"


def test_validation(spark, tree):
    root = tree({"a/s/f.csv": text(), "a/t/f.csv": text(id="00002")})
    job = Converter(spark, root)
    job.run()
    slow = dict(station_query_ms=60_000, time_query_ms=60_000, both_query_ms=60_000)
    good = Validator(spark, job.output, Kind.RAIN, root, Limits(rows_per_file=(1, 10), stations=(1, 10), group_rows=(1, 10), **slow)).report()
    assert [r["test_name"] for r in good.where("not passed").collect()] == []
    strict = Validator(spark, job.output, Kind.RAIN, root).report()
    assert {"rows_per_file", "stations", "row_groups"} <= {r["test_name"] for r in strict.where("not passed").collect()}
    assert report_summary(good).first()["success_rate"] == 100.0
    wrong = Validator(spark, job.output, Kind.WIND, root).report()
    assert not wrong.where("test_name = 'required_columns'").first()["passed"]


def test_validation_finds_disorder(spark, tmp_path):
    out = str(tmp_path / "x.parquet")
    spark.sql("select * from values ('b', timestamp_ntz'2020-01-02'), ('b', timestamp_ntz'2020-01-01'), ('a', timestamp_ntz'2020-01-01') as t(station_id, ob_end_time)").coalesce(1).write.parquet(out)
    got = {r["test_name"]: r["message"] for r in Validator(spark, out, Kind.WIND).report().collect()}
    assert got["station_order"] == "1 rows out of order" and got["time_order"] == "1 rows out of order"


def test_types_by_name():
    want = dict(ob_end_time="timestamp_ntz", ob_date="timestamp_ntz", max_gust_ctime="string", max_gust_ctime_q="string", midas_stmp_etime="string", prcp_amt_j_q="int", prcp_amt_j="string", prcp_dur="double", mean_wind_dir="double", ob_day_cnt_q="int", src_id="int", id="string", meto_stmp_time="string", quality_flag="string", glbl_irad_amt="double", OB_DATE="string")
    assert {n: type_of(n) for n in want} == want
    assert {k: len(v) for k, v in EXPECTED.items()} == {Kind.RAIN: 15, Kind.TEMPERATURE: 22, Kind.WIND: 24, Kind.RADIATION: 11}


def test_kind():
    assert kind_of("uk-daily-rain-obs-202407") is Kind.RAIN
    assert kind_of("uk-daily-temperature-obs", "x.csv", "/training/windows/x") is Kind.TEMPERATURE
    with pytest.raises(ConfigurationError, match="could not detect dataset type"):
        kind_of("nothing")


@pytest.mark.parametrize(
    "strategy, rows, stations, cores, mb, want",
    [("fixed", 1, 1, 1, 1, 500_000), ("adaptive", 1, 1, 1, 16384, 100_000), ("adaptive", 1, 1, 4, 16384, 400_000), ("adaptive", 1, 1, 32, 65536, 2_000_000), ("adaptive", 1, 1, 8, 256, 335_544), ("adaptive", 1, 1, 8, 7, 100_000), ("station", 1_000_000, 0, 4, 16384, 400_000), ("station", 1_000_000, 10, 4, 16384, 250_000), ("station", 10_000_000, 100, 8, 16384, 800_000)],
)
def test_row_groups(strategy, rows, stations, cores, mb, want):
    assert rows_per_group(strategy, rows=rows, stations=stations, cores=cores, memory_mb=mb) == want
    assert rows_per_group(strategy, target=123_456) == 123_456


def test_default_output():
    assert default_output("/c/sets/rain") == "/c/parquet/rain.parquet"
    assert default_output("rain") == "./parquet/rain.parquet"


def test_read_in_one_call(spark, tree):
    root = tree({"a/s/f.csv": text()})
    assert badc.read(spark, f"{root}/qcv-1/*/*/*.csv").count() == 3


def written_tree(root):
    return {str(p.relative_to(root)): p.read_bytes() for p in (root / "qcv-1").rglob("*") if p.is_file() and not p.name.endswith(".crc")}


def test_trees_are_written_by_tasks(spark, tmp_path, monkeypatch):
    """Files that tasks write are those that Spark writes and the driver renames; the driver renames none of them."""
    from isohyet.sinks import badc as badc_out

    rows = [("a b", "00001_c%20d", "f 1", "x\ny"), ("a b", "00001_c%20d", "f 1", "z"), ("é", "00002+e%", "g", ""), ("a", "s", "h", "é\n")]
    df = spark.createDataFrame(rows, "county_dir string, station_dir string, file string, text string").coalesce(1)
    with monkeypatch.context() as m:
        m.setattr(badc_out, "mounted", lambda *_: None)
        assert badc_out.write_tree(df, str(tmp_path / "renamed")) == 3
    monkeypatch.setattr(badc_out, "_write_and_rename", None)
    assert badc_out.write_tree(df, f"file://{tmp_path}/tasks") == 3
    assert written_tree(tmp_path / "tasks") == written_tree(tmp_path / "renamed")
    assert badc_out.write_tree(df.limit(0), str(tmp_path / "none")) == 0 and files(spark, str(tmp_path / "none")) == []


def test_files_are_listed_without_a_call_for_each(spark, tree, monkeypatch):
    """The same paths as the other stores' listing; folders with the name of a file are none."""
    from isohyet.sources import discovery

    root = tree({"a b/s%1/f.csv": text(), "a b/s%1/zero.csv": "", "é/s+2/.hidden.csv": "x", "é/s+2/folder.csv/g.csv": text(), "é/top.csv": text(), "é/s+2/n.txt": "x"})
    found = files(spark, root)
    assert [x.rsplit("/", 1)[1] for x in found] == ["f.csv", "zero.csv", ".hidden.csv"] and all(x.startswith("file:/") for x in found)
    monkeypatch.setattr(discovery, "mounted", lambda *_: None)
    assert files(spark, root) == found
    assert [r["path"] for r in file_table(spark, root).collect()] == found[:1]


def test_many_files_take_few_tasks(spark, tree):
    root = tree({f"a/s{i}/f.csv": text(id=str(i)) for i in range(700)})
    most = 4 * spark.sparkContext.defaultParallelism
    assert Converter(spark, root).parsed().rdd.getNumPartitions() <= most
    assert file_table(spark, root).rdd.getNumPartitions() <= most


def test_widths_need_one_look_at_all_files(spark, monkeypatch):
    import os

    from isohyet import catalog

    if not os.path.isdir("/root/testdata/sf0.001"):
        pytest.skip("no tables here")
    calls, look = [], badc.overview
    monkeypatch.setattr(badc, "overview", lambda parsed: calls.append(1) or look(parsed))
    assert catalog.schema_width(spark, "/root/testdata/sf0.001").count() == 3 and len(calls) == 1


def test_footer_report_has_one_file_however_many_stations(spark, monkeypatch):
    import os

    import duckdb

    from isohyet import catalog
    from isohyet.operators import convert

    if not os.path.isdir("/root/testdata/sf0.001"):
        pytest.skip("no tables here")
    monkeypatch.setattr(convert, "MANY_RAIN_STATIONS", 1)
    monkeypatch.setattr(convert, "MANY_ROWS", 1)
    con = duckdb.connect()
    con.execute("create view events as select * from '/root/testdata/sf0.001/events.parquet'")
    assert [tuple(r) for r in catalog.footer_report(spark, "/root/testdata/sf0.001").collect()] == con.execute(catalog.SQL["footer_report"]).fetchall()


ODD_TREE = {"a b/s%1/f.csv": text(), "a b/s%1/zero.csv": "", "é/s+2/.hidden.csv": "x", "é/_s/f.csv": "x", "é/_s=2/f.csv": text(id="3"), "é/s+2/folder.csv/g.csv": text(), "é/top.csv": text(), "é/s+2/n.txt": "x", "é/s+2/bad.csv": b"\xff\xfe"}


def test_tasks_list_and_read_what_readers_would(spark, tree, monkeypatch):
    """The same rows as Spark's readers give, whose entries for each file the driver no longer holds."""
    from isohyet.sources import discovery
    from isohyet.sources.registry import capability

    root = tree(ODD_TREE)
    look = lambda: [sorted(map(str, df.collect())) for df in (file_table(spark, root), discovery.csv_files(spark, root), Converter(spark, root).parsed(), badc.files_below(spark, [root, f"{root}/qcv-1", root]))]
    with monkeypatch.context() as m:
        m.setattr(discovery, "mounted", lambda *_: None)
        want = look()
    monkeypatch.setattr(badc, "whole_files", None)
    monkeypatch.setattr(discovery, "few_listings", None)
    assert look() == want and [len(x) for x in want] == [3, 5, 3, 5]
    monkeypatch.setattr(discovery, "BATCH_BYTES", 1)
    assert look() == want
    shutil.copytree(f"{root}/qcv-1", f"{root}/capability")
    assert capability(spark, [root]).count() == 5


def test_folders_are_dealt_whole(tmp_path):
    from isohyet.sources import discovery

    for path in ("a/b/c", "a/d", "e"):
        (tmp_path / path).mkdir(parents=True)
        (tmp_path / path / "f.csv").write_text("x")
    everything = sorted(discovery._csv_below(bytes(tmp_path), True))
    for least in (1, 2, 3, 100):
        parts = discovery._split(bytes(tmp_path), least)
        assert sorted(p for f, deep in parts for p in discovery._csv_below(f, deep)) == everything and len(everything) == 3


def test_small_files_are_written_by_all_cores(spark, tmp_path, monkeypatch):
    import pyarrow as pa

    from isohyet.sinks import badc as badc_out

    def busy(folder):
        def run(batches):
            yield pa.RecordBatch.from_pydict({"n": pa.array([int(sum(b.num_rows for b in batches) > 0)], pa.int64())})

        return run

    monkeypatch.setattr(badc_out, "_writer", busy)
    df = spark.range(400).selectExpr("'a' county_dir", "cast(id as string) station_dir", "'f' file", "'x' text")
    assert badc_out.write_tree(df, f"file://{tmp_path}/t") == 4 * spark.sparkContext.defaultParallelism


def test_split_rows_are_those_of_the_parser(spark, monkeypatch):
    """What is only split has the fields that Spark's parser finds."""
    from pyspark.sql import functions as F

    lines = ["a,b,c", "a,,", ",", "a", "a,b,c,d,e", " a , b\t, ", '"a,1",b', 'a,"b ""x""",c', 'a"b,c"', "a\\,b", "a\rb,c", "é, ,ü", "#,1", "a,b,", ",,,", "'a,b'", "a;b|c", "\0x,1", "1e5,-3.0,NA"]
    station = [F.lit(None).cast("string").alias(c) for c in badc.STATION_COLUMNS]
    parsed = spark.createDataFrame([(lines,)], "rows array<string>").select(*station, F.lit(badc.OK).alias("status"), F.array(*map(F.lit, "xyz")).alias("cols"), "rows")
    schema = badc.Schema.of([list("xyz")])
    look = lambda: [tuple(r) for r in badc.fields(parsed, schema).select(*[badc.raw(c) for c in "xyz"]).collect()]
    got = look()
    monkeypatch.setattr(badc, "SPECIAL", ("",))
    assert got == look() and len(got) == len(lines)


def test_rows_are_cast_once(spark, tree, monkeypatch):
    """One job casts rows and counts the values of each column; the sort reads what it wrote."""
    monkeypatch.setattr(badc, "column_presence", None)
    calls, cast = [], badc.observations
    monkeypatch.setattr(badc, "observations", lambda *a, **k: calls.append(1) or cast(*a, **k))
    root = tree({"a/s/f.csv": text("2023-01-01,NA,,\n2023-01-02, , ,NA\n", COLS + ",x`y z"), "a/t/f.csv": text("2023-01-01,1.5\n", "ob_end_ctime,prcp_amt", id="2")})
    for layout in ("file", "directory"):
        stats, df = converted(spark, root, layout=layout)
        assert (stats.total_rows, df.columns[:3], len(calls)) == (3, ["ob_end_ctime", "prcp_amt", "station_id"], 1)
        assert {(r["ob_end_ctime"].day, r["prcp_amt"]) for r in df.collect()} == {(1, 1.5), (1, None), (2, None)}
        calls.clear()
        shutil.rmtree(df.inputFiles()[0].removeprefix("file://").rsplit("/", 1)[0])
    job = Converter(spark, root, options=Options(empty_columns="off"))
    job.run()
    assert spark.read.parquet(job.output).columns[:4] == ["ob_end_ctime", "prcp_amt", "prcp_amt_q", "x`y z"]


def test_blank_lines_are_no_rows(spark, tree):
    root = tree({"a/s/f.csv": text("2023-01-01,1.0,0\n \t\n  \n\n​2023,2,0\n~,3.0,1\n")})
    assert [len(r["rows"]) for r in Converter(spark, root).parsed().collect()] == [3]


ODD_FILES = [
    text().encode(), text().replace("\n", "\r\n").encode(), b"\n", b"\n\n", b"data", b"data\n", b"end data\n", b"end data\ndata\nx\n", b"a,G\ndata\r\r\nb\nend data", text(end="").encode(), text("").encode(),
    text(h="10").replace("height,G,10,m", "height,G,-1e3, ft ").encode(), text(h="+nan").encode(), text(h="NaN").encode(), text(h="-inf").encode(), text(h="1_0").encode(), text(h="١").encode(), text(h=".5").encode(), text(h="1.").encode(), text(h="1e999").encode(),
    text(lat="", lon="").encode(), text(lat="1,2").encode(), text(name="").encode(), text(name="a,b,G,c").encode(), text(name="　x ").encode(), text(cols=" a , b,,a").encode(), text(cols="").encode(),
    text("2023,1,0\n \t\n\x1c\n \n\n\x00\n\"a\nb\",1\n").encode(), text("data\n1,2\n data \nc\n3\n").encode(), text("x\nend data \n1\nend data\n").encode(), text().replace("midas", "#midas").encode(), text().replace("midas", " midas").encode(), text().replace(",G,", ", G,").encode(),
    text().replace("data\n", "data\n").replace("end ", "").encode(), ("height,G,1,m\n" + text().replace("height", "h")).encode(), text(name="old").encode() + text(name="new").encode(), b"\xef\xbb\xbf" + text().encode(),
]


def test_tasks_parse_as_the_plan_does(spark):
    """Python's parser tells the same of odd files as the expressions that streams use."""
    from isohyet.sources import parsing

    df = spark.createDataFrame([(str(i), x.decode()) for i, x in enumerate(ODD_FILES)], "path string, value string")
    want = {r["path"]: tuple(map(str, r[1:])) for r in badc.headers(badc.lines_of(df)).collect()}
    got = {str(i): tuple(map(str, parsing.parse(x))) for i, x in enumerate(ODD_FILES)}
    assert got == want and {x[-2] for x in got.values()} == {"ok", "NoDataMarker", "HeaderParsingFailed"}
    *_, status, error = parsing.parse(text().encode() + b"\xff")
    assert (status, error) == ("InvalidEncoding", "not UTF-8")


def test_outcomes_need_no_list_of_files(spark, tree, monkeypatch):
    """The tasks that read the files find those without bytes and hidden ones; the driver lists none and joins none."""
    from isohyet.operators import convert
    from isohyet.sources import discovery

    root = tree(ODD_TREE | {"a b/.t/f.csv": text(), "é/s+2/no_end.csv": text(end="", id="9")})
    look = lambda: sorted(map(str, Converter(spark, root).outcomes().collect()))
    with monkeypatch.context() as m:
        m.setattr(discovery, "mounted", lambda *_: None)
        want = look()
    monkeypatch.setattr(convert, "files", None)
    monkeypatch.setattr(badc, "outcomes", None)
    assert look() == want and len(want) == 8 and sum("status='ok'" in x for x in want) == 3
    assert Converter(spark, tree({}, "uk-hourly-rain-obs")).outcomes().count() == 0
    with pytest.raises(DatasetNotFound):
        Converter(spark, f"{root}-none").outcomes()


def test_first_file_is_that_of_the_sorted_list(spark, tree):
    from isohyet.sources.discovery import first_file

    root = tree({"a/s/f.csv": text(), "a b/s/f.csv": text(), "a b/s!/g.csv": text(), "a b/s!/f.txt": "x", "B/s/t/f.csv": text()})
    assert first_file(spark, root) == files(spark, root)[0] and first_file(spark, root).endswith("/a b/s!/g.csv")
    assert first_file(spark, tree({"a/f.csv": "x"}, "uk-hourly-rain-obs")) is None


def test_listing_counts_suppliers_of_one_name(spark, tmp_path):
    """Suppliers that share name, nation and station are files of their own, as the SQL counts them."""
    from isohyet import catalog

    rows = [(1, "same", 3), (41, "same", 3), (81, "other", 3), (1, "same", 4)]
    spark.createDataFrame(rows, "s_suppkey long, s_name string, s_nationkey int").coalesce(1).write.parquet(f"{tmp_path}/supplier.parquet")
    assert [tuple(r) for r in catalog.dataset_listing(spark, str(tmp_path)).collect()] == [("uk-daily-rain-obs", 4, 2, 1)]


def test_tree_writer_holds_little_of_a_file(spark, tmp_path, monkeypatch):
    """A file's lines are written as they come; what another task has made already is no fault."""
    import pyarrow as pa

    from isohyet.sinks import badc as badc_out

    monkeypatch.setattr(badc_out, "HELD_BYTES", 3)
    (tmp_path / "a" / "s").mkdir(parents=True)
    lines = ["é" * 3, "", None, "xyz", "end"]
    batches = [pa.RecordBatch.from_pydict({"a": ["a"], "b": ["s"], "c": ["f"], "text": pa.array([x], pa.string())}) for x in lines]
    batches.append(pa.RecordBatch.from_pydict({"a": ["b"], "b": ["s"], "c": ["f"], "text": ["x"]}))
    assert [b.to_pylist() for b in badc_out._writer(str(tmp_path))(iter(batches))] == [[{"n": 2}]]
    assert (tmp_path / "a/s/f.csv").read_text() == "ééé\n\n\nxyz\nend\n" and (tmp_path / "b/s/f.csv").read_text() == "x\n"
    assert sorted(p.name for p in tmp_path.rglob("*.*")) == ["f.csv", "f.csv"]


def test_registry_is_parsed_by_tasks(spark, tree, monkeypatch):
    """Capability files are parsed where they are read; the last record of a station with status 9 counts."""
    from isohyet.sources.registry import registry

    cols = "src_id,rec_st_ind,met_domain_name"
    root = tree({"a/s/f.csv": text("7,9,first\n7, 9 ,last\n7,1,none\n8,1,other\n", cols), "a/s/deep/er/g.csv": text("9,9,é\n", cols), "a/s/bad.csv": "x", "a/s/zero.csv": ""})
    shutil.move(f"{root}/qcv-1", f"{root}/capability")
    monkeypatch.setattr(badc, "headers", None)
    monkeypatch.setattr(badc, "lines_of", None)
    got = registry(spark, [root, f"{root}/none"], cols.split(","))
    assert sorted((r["src_id"], r["rec_st_ind"], r["met_domain_name"], r["station_id"]) for r in got.collect()) == [(7, 9, "last", "00001"), (9, 9, "é", "00001")]


def test_discovery_looks_at_files_once(spark, tree, monkeypatch):
    """Values are counted by the tasks that read; only rows that need the parser are looked at once more, and all count."""
    from isohyet.sources import parsing

    plain_rows = {"a/s/1.csv": text("2023-01-01,NA,, \n2023-01-02, ,NA\n", COLS + ",x,x"), "a/s/2.csv": text("1,2\n", "prcp_amt,ob_end_ctime"), "a/s/3.csv": text("2023\n,,,,1\n", "ob_end_ctime,z"), "a/s/4.csv": "x"}
    look = lambda root, **o: [tuple(r) for r in Converter(spark, root, options=Options(**o)).discover().collect()]
    old = lambda root, **o: [tuple(r) for r in [r for job in [Converter(spark, root, options=Options(**o))] for r in badc.column_presence(badc.fields(job.parsed(), badc.dataset_schema(job.parsed())), badc.dataset_schema(job.parsed()), o.get("na_strings", ("NA", ""))).items()]]
    root = tree(plain_rows)
    counts = {o: (badc.surveyed(spark, root, o)[1], dict(old(root, na_strings=o))) for o in (("NA", ""), ("NA",), ("2023",))}
    assert all(a == b for a, b in counts.values()) and counts["NA", ""][0] == {"ob_end_ctime": 4, "prcp_amt": 1, "prcp_amt_q": 0, "x": 0, "z": 0}
    odd = tree({"a/s/1.csv": text('2023-01-01,"NA",\n"1,2",,"5"\n', COLS).replace("\n", "\r\n"), "a/s/2.csv": text("2023-01-03,,\n")}, "uk-daily-rain-2")
    assert badc.surveyed(spark, odd)[1] == dict(old(odd)) == {"ob_end_ctime": 3, "prcp_amt": 0, "prcp_amt_q": 1}
    want = look(odd)
    monkeypatch.setattr(parsing, "MOST_LISTS", 0)
    assert look(odd) == want and [r[0] for r in want if r[2]] == ["prcp_amt"]
    monkeypatch.setattr(badc, "column_presence", None)
    assert [r[0] for r in look(root) if r[2]] == ["prcp_amt_q", "x", "z"]
    assert look(tree({}, "uk-daily-rain-3")) == []


def test_outcomes_of_names_that_are_no_text(spark, tree):
    """Folders' names are bytes: what isn't UTF-8 is counted as well."""
    import os

    root = tree({"a b/s%1 +é/f.csv": text()})
    folder = os.fsencode(root) + b"/qcv-1/a b/\xff\xfe%"
    os.makedirs(folder)
    for name, content in ((b"g\xff.csv", text(id="2").encode()), (b"zero.csv", b"")):
        with open(folder + b"/" + name, "wb") as f:
            f.write(content)
    got = Converter(spark, root).outcomes().groupBy("status").sum("n_rows").collect()
    assert sorted(map(tuple, got)) == [("NoDataMarker", 0), ("ok", 6)]


def _files_of(folder):
    import os

    return {os.path.relpath(os.path.join(at, n), folder): open(os.path.join(at, n), "rb").read() for at, _, names in os.walk(folder) for n in names}


def test_trees_of_lines_need_one_shuffle(spark, tmp_path, monkeypatch):
    """Lines go to their files as they are: no list of a file's lines, nor a second shuffle of whole files."""
    from pyspark.sql.classic.dataframe import DataFrame

    from isohyet import catalog

    plans, plain = [], DataFrame.mapInArrow

    def seen(df, *args):
        plans.append(df._jdf.queryExecution().executedPlan().toString())
        return plain(df, *args)

    monkeypatch.setattr(DataFrame, "mapInArrow", seen)
    (tmp_path / "in").mkdir()
    spark.sql("select id event_id, timestamp_ntz'2024-01-05' + make_dt_interval(0, id) ts, id % 3 user_id, 'x' event_type, id / 4 value from range(2000)").write.parquet(f"{tmp_path}/in/events.parquet")
    root = catalog._odd_tree(spark, f"{tmp_path}/in")
    assert [(p.count("Exchange "), p.count("collect_list")) for p in plans] == [(1, 0)]
    found = _files_of(root.removeprefix("file:") + "/qcv-1")
    assert len(found) == 9 and sum(x.count(b"2024-") for x in found.values()) == 2000  # three stations and months


def test_lines_are_written_as_whole_files_were(spark, tmp_path, monkeypatch):
    """Equal bytes, wherever Arrow's batches end; rows come in any order, with ties and with times that are not there."""
    from pyspark.sql import functions as F

    from isohyet.sinks import badc as badc_out

    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", 7)
    try:
        rows = spark.range(500).selectExpr("id % 5 k", "if(id % 50 = 0, null, id % 11) t", "if(id % 2 = 0, 'é', concat('x ', id)) x", "if(id % 5 = 4, null, 'm') m").orderBy(F.rand(3))
        k = F.col("k")
        head = badc_out.header(F.lit("é station"), k, F.lit("c"), k, k, k, F.lit("m"))
        names = (F.when(k < 3, F.concat(F.lit("a "), k % 2)), F.when(k > 0, F.concat(k, F.lit("%2B+é"))), F.concat(F.lit("f "), "m", k))
        args = ([k, F.col("m")], ["t"], F.concat_ws(",", "t", "x"), names, head, F.when(k % 2 == 0, F.lit("a,b")).otherwise(F.lit("b,a")))
        assert badc_out.write_lines(rows, f"file://{tmp_path}/new", *args) == 5
        monkeypatch.setattr(badc_out, "mounted", lambda *_: None)
        assert badc_out.write_lines(rows, f"file://{tmp_path}/old", *args) == 5
        monkeypatch.undo()
        assert badc_out.write_lines(rows.limit(0), f"file://{tmp_path}/none", *args) == 0
    finally:
        spark.conf.unset("spark.sql.execution.arrow.maxRecordsPerBatch")
    new, old = _files_of(tmp_path / "new"), {p: x for p, x in _files_of(tmp_path / "old").items() if not p.endswith(".crc")}
    assert len(new) == 5 and new == old and _files_of(tmp_path / "none") == {}


def test_many_folders_take_few_tasks(spark):
    from isohyet.sources import discovery

    dealt = discovery._dealt(spark, [(b"/a/%d" % i, 0) for i in range(20_000)], None)
    assert dealt.rdd.getNumPartitions() == 4 * spark.sparkContext.defaultParallelism and dealt.count() == 20_000

"""File stream, command line, and a round trip of generated rows."""

import json
import os
import re

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from isohyet import cli
from isohyet.functions.lenient import to_double, to_int, to_timestamp, trimmed, whole_days
from isohyet.operators import observations as obs
from isohyet.operators.convert import Converter, Options
from isohyet.plans.spec import Kind, Schema
from isohyet.sources import badc
from isohyet.streaming import ingest
from isohyet.streaming.ingest import stream

from .test_convert import COLS, text


def put(root, path, content):
    f = root / "qcv-1" / path
    f.parent.mkdir(parents=True, exist_ok=True)
    f.write_text(content)


def test_stream_takes_each_file_once(spark, tmp_path):
    root, out, checkpoint = tmp_path / "rain", str(tmp_path / "out"), str(tmp_path / "cp")
    schema = Schema.of([COLS.split(",")])
    put(root, "a/s1/1.csv", text())
    put(root, "a/s1/2.csv", "broken")
    run = lambda: stream(spark, str(root), out, schema, Kind.RAIN, checkpoint=checkpoint).awaitTermination()
    run()
    assert spark.read.parquet(out).count() == 3
    put(root, "a/s2/3.csv", text("2023-01-05,1.0,0,z\n", COLS + ",new_column", id="00002"))
    run()
    run()
    got = spark.read.parquet(out)
    assert got.count() == 4 and {r.station_id for r in got.collect()} == {"00001", "00002"}
    told = {r.path[-5:]: (r.status, r.n_rows, r.left_out) for r in spark.read.parquet(f"{out}.outcomes").collect()}
    assert told == {"1.csv": ("ok", 3, []), "2.csv": ("NoDataMarker", 0, []), "3.csv": ("ok", 1, ["new_column"])}


def test_stream_writes_batches_together(spark, tmp_path, monkeypatch):
    """One plan for all batches, a folder for each; what a run took and did not come to write, the next one writes."""
    root, out, checkpoint = tmp_path / "rain", str(tmp_path / "out"), str(tmp_path / "cp")
    for i in range(12):
        put(root, f"a b/s{i}%20é/{i}.csv", "" if i == 5 else text(f"2023-01-05,{i}.0,0,z\n", id=f"{i:05d}"))
    plans, real, write = [], badc.observations, ingest._write_taken
    monkeypatch.setattr(badc, "observations", lambda *a, **k: plans.append(1) or real(*a, **k))
    run = lambda: stream(spark, str(root), out, Schema.of([COLS.split(",")]), Kind.RAIN, checkpoint=checkpoint, files_per_batch=2).awaitTermination()
    monkeypatch.setattr(ingest, "_write_taken", lambda *_: None)
    run()
    assert not os.path.exists(out)
    monkeypatch.setattr(ingest, "_write_taken", write)
    put(root, "a b/s12/12.csv", text("2023-01-05,12.0,0,z\n", id="00012"))
    run()
    run()
    assert len(plans) == 1
    got = spark.read.parquet(out).select("station_id", "prcp_amt", "batch").collect()
    assert sorted((r.station_id, r.prcp_amt) for r in got) == [(f"{i:05d}", float(i)) for i in range(13) if i != 5]
    assert {n: sum(r.batch == n for r in got) for n in range(7)} | {6: 1} == {n: 2 for n in range(6)} | {next(n for n in range(6) if sum(r.batch == n for r in got) == 1): 1, 6: 1}
    told = spark.read.parquet(f"{out}.outcomes").collect()
    assert sorted((r.path.removeprefix(f"file:{root}/qcv-1/"), r.status) for r in told) == sorted((f"a b/s{i}%20é/{i}.csv" if i < 12 else "a b/s12/12.csv", "ok" if i != 5 else "NoDataMarker") for i in range(13))
    assert not [x for x in os.listdir(tmp_path) if ".parsed-" in x]


def test_settings_in_layers(tmp_path):
    from isohyet.errors import ConfigurationError
    from isohyet.settings import settings as layered

    file = tmp_path / "isohyet" / "config.toml"
    file.parent.mkdir()
    file.write_text('compression = "zstd"\nsample_files = 4\nlayout = "file"\n')
    env = {"XDG_CONFIG_HOME": str(tmp_path), "ISOHYET_SAMPLE_FILES": "7", "ISOHYET_LAYOUT": "directory"}
    got = layered({"layout": "file", "compression": None}, env)
    assert (got.compression, got.sample_files, got.layout, got.empty_columns) == ("zstd", 7, "file", "exact")
    assert layered({}, {"HOME": str(tmp_path)}) == layered({}, {"HOME": str(tmp_path / "none")})
    for bad in ({"ISOHYET_LAYOUT": "tree"}, {"ISOHYET_SAMPLE_FILES": "0"}, {"ISOHYET_SAMPLE_FILES": "x"}, {"ISOHYET_CONFIG": str(tmp_path / "none.toml")}):
        with pytest.raises(ConfigurationError):
            layered({}, {"HOME": str(tmp_path)} | bad)
    file.write_text("colour = 1")
    with pytest.raises(ConfigurationError, match="colour"):
        layered({}, env)


def test_a_cluster_needs_a_shared_folder():
    from types import SimpleNamespace

    from isohyet.errors import ConfigurationError
    from isohyet.sinks.scratch import shared_dir

    session = SimpleNamespace(conf=SimpleNamespace(get=lambda *_: None), sparkContext=SimpleNamespace(master="spark://host:7077"))
    with pytest.raises(ConfigurationError, match="spark.checkpoint.dir"):
        shared_dir(session)


def test_memory_of_executors():
    from types import SimpleNamespace

    from isohyet.plans.rowgroups import executor_memory_mb

    def session(master, **conf):
        get = lambda key, default: conf.get(key.replace(".", "_"), default)
        return SimpleNamespace(sparkContext=SimpleNamespace(master=master, getConf=lambda: SimpleNamespace(get=get)))

    assert executor_memory_mb(session("spark://h", spark_executor_memory="24g")) == 24576
    assert executor_memory_mb(session("yarn", spark_executor_memory="1500m")) == 1500
    assert executor_memory_mb(session("local[4]", spark_driver_memory="2gb")) == 2048
    assert executor_memory_mb(session("yarn")) == 1024


def test_cli(spark, tmp_path, capsys):
    root, out = tmp_path / "sets" / "rain", str(tmp_path / "rain.parquet")
    put(root, "a/s1/1.csv", text())
    assert cli.main([str(root), "--discovery-only"], spark) == 0
    assert "prcp_amt" in capsys.readouterr().out and not os.path.exists(out)
    assert cli.main([str(root), "-o", out, "--compression", "zstd"], spark) == 0
    assert "total_rows=3" in capsys.readouterr().out
    report = str(tmp_path / "report.json")
    assert cli.main([str(root), "--validate", out, "--report", report], spark) == 1  # far too few stations
    assert {r["test_name"] for r in json.load(open(report))} >= {"stations", "one_codec"}
    assert cli.main([str(tmp_path / "none")], spark) == 1
    merged = str(tmp_path / "merged.parquet")
    assert cli.main(["--test-merge", out, "-o", merged], spark) == 0
    assert spark.read.parquet(merged).count() == 3


value = st.one_of(st.none(), st.floats(-1e6, 1e6, allow_nan=False).map(lambda x: round(x, 3)))
note = st.one_of(st.none(), st.text("abc ,\"é", min_size=1, max_size=8))
rows = st.lists(st.tuples(st.integers(1, 28), value, st.one_of(st.none(), st.integers(-(2**31), 2**31 - 1)), note), min_size=1, max_size=8)


def quoted(x):
    return "NA" if x is None else '"' + x.replace("\\", "\\\\").replace('"', '\\"') + '"'


@settings(max_examples=8, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(rows)
def test_round_trip(spark, tmp_path_factory, data):
    """Rows as a file, read back: the same values, missing ones as NULL."""
    root = tmp_path_factory.mktemp("trip")
    lines = "".join(f"2023-02-{d:02d},{'NA' if v is None else v},{'' if q is None else q},{quoted(s)}\n" for d, v, q, s in data)
    put(root, "a/s/1.csv", text(lines, "ob_end_ctime,prcp_amt,prcp_amt_q,note"))
    got = badc.read(spark, f"{root}/qcv-1/*/*/*.csv").select(F.dayofmonth("ob_end_ctime"), "prcp_amt", "prcp_amt_q", "note").collect()
    blank = lambda s: None if s is None or s.strip() in ("", "NA") else s.strip()
    assert sorted(map(str, map(tuple, got))) == sorted(str((d, v, q, blank(s))) for d, v, q, s in data)


@pytest.mark.parametrize(
    "f, cases",
    [
        (to_int, {"5": 5, "+5": 5, "5.0": None, "": None, "99999999999": None, "x": None}),
        (to_double, {"1e3": 1000.0, ".5": 0.5, "5.": 5.0, "1.0d": None, "-inf": float("-inf"), "1,0": None, "": None}),
        (lambda c: to_timestamp(c).cast("string"), {"2023-01-02": "2023-01-02 00:00:00", "2023-01-02 03:04:05": "2023-01-02 03:04:05", "2023-01-02T03:04:05Z": "2023-01-02 03:04:05", "2023": None, "2023-13-01": None}),
        (trimmed, {"\t  a b \r　": "a b", "": "", " ": ""}),
    ],
)
def test_lenient_functions(spark, f, cases):
    df = spark.createDataFrame([(i, k) for i, k in enumerate(cases)], "i int, s string").select("i", f(F.col("s")).alias("v"))
    assert [r.v for r in df.orderBy("i").collect()] == list(cases.values())


def test_whole_days_round_down(spark):
    df = spark.sql("select timestamp_ntz'2020-01-01 12:00:00' a, timestamp_ntz'2020-01-03 11:00:00' b")
    assert df.select(whole_days(F.col("a"), F.col("b"))).first()[0] == 1


def test_one_record_each(spark):
    df = spark.createDataFrame([("a", 1, 9, 1, "x"), ("a", 1, 1, 1, "y"), ("a", 2, 9, 1, "z"), ("a", 2, 9, 2, "w")], "s string, t int, rec_st_ind int, version_num int, v string")
    assert {r.v for r in obs.one_record_each(df, ["s", "t"]).collect()} == {"y", "w"}


def test_filters_reach_the_scan(spark, tmp_path):
    root = tmp_path / "rain"
    put(root, "a/s1/1.csv", text())
    job = Converter(spark, str(root), str(tmp_path / "o.parquet"), Options())
    job.run()
    plan = obs.of_station(spark.read.parquet(job.output), "00001").select("prcp_amt")._jdf.queryExecution().toString()
    assert re.search(r"PushedFilters: \[.*EqualTo\(station_id,00001\)", plan)
    assert re.search(r"ReadSchema: struct<prcp_amt:double,station_id:string>", plan)

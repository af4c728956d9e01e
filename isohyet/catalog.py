"""Registered queries over the driver's tables, each with its DuckDB SQL where SQL can express it.

events stand for observations: user_id is the station, ts the time, value the measurement.
"""

from __future__ import annotations

from collections.abc import Callable
from datetime import datetime

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .functions.lenient import in_year, size_text, whole_days
from .operators import observations as obs
from .operators.convert import Converter, Options
from .operators.validate import Limits, Validator
from .plans.rowgroups import rows_per_group
from .plans.spec import EXPECTED, Kind, Schema, type_of
from .sinks import badc as badc_out
from .sinks.parquet import ParquetOptions, merge, write
from .sinks.scratch import new_path
from .sources import badc
from .sources.discovery import _fs, datasets, file_table, files_by_station
from .sources.discovery import station_counts as station_level
from .sources.footers import column_chunks, footer_summary
from .sources.registry import registry

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
SQL: dict[str, str] = {}


def query(sql: str | None = None):
    """Registers a query under its name, with its SQL."""

    def add(f):
        QUERIES[f.__name__] = f
        if sql:
            SQL[f.__name__] = sql
        return f

    return add


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


# ------------------------------------------------------------------------------------------- trees made of the tables


def _station_head(number) -> F.Column:
    """Header of the station with this number."""
    return badc_out.header(F.concat(F.lit("station "), number.cast("string")), F.lpad(number.cast("string"), 5, "0"), F.concat(F.lit("county"), (number % 3).cast("string")), number % 50 + F.lit(0.5), -(number % 7) - F.lit(0.25), number * F.lit(1.5), F.lit("m"))


#: The same in SQL.
STATION = """lpad(cast({n} as varchar), 5, '0') as station_id, 'station ' || {n} as station_name, 'county' || ({n} % 3) as county,
cast({n} % 50 + 0.5 as double) as latitude, cast(-({n} % 7) - 0.25 as double) as longitude, cast({n} * 1.5 as double) as height, 'm' as height_units"""


def _events_tree(spark: SparkSession, sf_dir: str, line, columns, station_dir=None) -> str:
    """events as a rain dataset, a file for each station and month; line and columns are of a row and of a station."""
    n = F.col("user_id")
    county = F.concat(F.lit("county"), (n % 3).cast("string"))
    station = F.concat(F.lpad(n.cast("string"), 5, "0"), F.lit("_station")) if station_dir is None else station_dir
    file = F.concat(F.lit("rain_"), n.cast("string"), F.lit("_"), "month")
    root = new_path(spark, "tree") + "/uk-daily-rain-obs"
    key = [n, F.date_format("ts", "yyyyMM").alias("month")]
    badc_out.write_lines(table(spark, sf_dir, "events"), root, key, ["ts", "event_id"], line, (county, station, file), _station_head(n), columns)
    return root


def _plain_tree(spark: SparkSession, sf_dir: str, station_dir=None) -> str:
    line = F.concat_ws(",", F.col("ts").cast("string"), F.col("event_id").cast("string"), F.col("value").cast("string"), F.col("event_type"))
    return _events_tree(spark, sf_dir, line, F.lit("ob_end_ctime,id,prcp_amt,met_domain_name"), station_dir)


#: Folders of stations as caches have them: blanks, per cents, plus signs, letters beyond ASCII.
ODD_DIRS = ["{} a b", "{}_c%20d", "{}+e%", "{}_é%2Bf g"]


def _odd_tree(spark: SparkSession, sf_dir: str) -> str:
    n = F.col("user_id")
    name = F.element_at(F.array(*[F.lit(d) for d in ODD_DIRS]), (n % len(ODD_DIRS) + 1).cast("int"))
    return _plain_tree(spark, sf_dir, F.replace(name, F.lit("{}"), F.lpad(n.cast("string"), 5, "0")))


def _convert(spark: SparkSession, root: str, **options) -> DataFrame:
    job = Converter(spark, root, new_path(spark, "converted") + "/rain.parquet", Options(**options))
    job.run()
    return spark.read.parquet(job.output)


EVENTS = "select ts as ob_end_ctime, cast(event_id as varchar) as id, value as prcp_amt, event_type as met_domain_name, " + STATION.format(n="user_id") + " from events"


@query(EVENTS)
def badc_roundtrip(spark, sf_dir):
    """Events to a BADC tree, converted and read back."""
    return _convert(spark, _plain_tree(spark, sf_dir))


@query(EVENTS)
def badc_odd_paths(spark, sf_dir):
    """Folders with blanks and per cents, and the empty-column check on a sample of the files."""
    return _convert(spark, _odd_tree(spark, sf_dir), empty_columns="sample", sample_files=2)


@query("select 'ok' as status, count(distinct (user_id, strftime(ts, '%Y%m'))) as n_files, count(*) as n_rows from events")
def badc_odd_paths_status(spark, sf_dir):
    found = Converter(spark, _odd_tree(spark, sf_dir)).outcomes()
    return found.groupBy("status").agg(F.count("*").alias("n_files"), F.sum("n_rows").cast("bigint").alias("n_rows"))


@query("select ts as ob_end_ctime, cast(event_id as varchar) as id, value as prcp_amt, event_type as met_domain_name, lpad(cast(user_id as varchar), 5, '0') as station_id from events")
def streamed_roundtrip(spark, sf_dir):
    """The same files as a stream of batches."""
    from .streaming.ingest import stream

    out, names = new_path(spark, "streamed"), ["ob_end_ctime", "id", "prcp_amt", "met_domain_name"]
    stream(spark, _plain_tree(spark, sf_dir), out, Schema.of([names]), Kind.RAIN, checkpoint=new_path(spark, "offsets"), files_per_batch=100).awaitTermination()
    return spark.read.parquet(out).select(*names, "station_id")


@query("select ts as ob_end_ctime, case when user_id % 2 = 0 then value end as prcp_amt, event_type as met_domain_name, lpad(cast(user_id as varchar), 5, '0') as station_id from events")
def badc_union_by_name(spark, sf_dir):
    """Odd stations lack a column, even ones have theirs in another order."""
    even = F.col("user_id") % 2 == 0
    ts, value, kind = F.col("ts").cast("string"), F.col("value").cast("string"), F.col("event_type")
    line = F.when(even, F.concat_ws(",", kind, value, ts)).otherwise(F.concat_ws(",", ts, kind))
    columns = F.when(even, F.lit("met_domain_name,prcp_amt,ob_end_ctime")).otherwise(F.lit("ob_end_ctime,met_domain_name"))
    return _convert(spark, _events_tree(spark, sf_dir, line, columns)).select("ob_end_ctime", "prcp_amt", "met_domain_name", "station_id")


@query("""select case when event_id % 5 = 4 then null else ts end as ob_end_ctime, case when event_id % 3 = 0 then null else value end as prcp_amt,
cast(case when event_id % 4 = 0 then null else event_id % 100 end as integer) as prcp_amt_q, case when event_id % 2 = 0 then null else event_type end as met_domain_name from events""")
def badc_na_lenient_cast(spark, sf_dir):
    """NA and what does not parse is NULL."""
    i = F.col("event_id")
    parts = [
        F.when(i % 5 == 4, F.lit("2024")).otherwise(F.col("ts").cast("string")),
        F.when(i % 3 == 0, F.lit("NA")).otherwise(F.col("value").cast("string")),
        F.when(i % 4 == 0, F.lit("5.0")).otherwise(F.concat(F.lit(" "), (i % 100).cast("string"), F.lit(" "))),
        F.when(i % 2 == 0, F.lit("NA")).otherwise(F.col("event_type")),
    ]
    names = ["ob_end_ctime", "prcp_amt", "prcp_amt_q", "met_domain_name"]
    return _convert(spark, _events_tree(spark, sf_dir, F.concat_ws(",", *parts), F.lit(",".join(names)))).select(*names)


def _supplier_tree(spark, sf_dir, broken: bool) -> str:
    """A file for each supplier, in the county of its nation; some of them broken."""
    s = table(spark, sf_dir, "supplier").join(F.broadcast(table(spark, sf_dir, "nation")), F.col("s_nationkey") == F.col("n_nationkey"))  # 25 nations
    k = F.col("s_suppkey")
    head = badc_out.header(F.col("s_name"), F.lpad(k.cast("string"), 5, "0"), F.col("n_name"), k / F.lit(4.0), -k / F.lit(8.0), F.col("s_acctbal"), F.lit("m"))
    text = badc_out.file_text(head, F.lit("ob_end_ctime,prcp_amt"), F.array(F.lit("2024-01-01,1.5")))
    if broken:
        no_height = F.concat(F.regexp_replace(head, "\nheight,G,[^\n]*", ""), F.lit("\ndata\nob_end_ctime\nend data"))
        text = F.when(k % 4 == 1, F.lit("no station file")).when(k % 4 == 2, no_height).when(k % 4 == 3, F.lit("")).otherwise(text)
    files = s.select(F.concat(F.lit("county"), F.col("n_nationkey").cast("string")).alias("county_dir"), F.lpad(k.cast("string"), 5, "0").alias("station_dir"), F.concat(F.lit("rain"), k.cast("string")).alias("file"), text.alias("text"))
    root = new_path(spark, "tree") + "/uk-daily-rain-obs"
    badc_out.write_tree(files, root)
    return root


@query("""select lpad(cast(s_suppkey as varchar), 5, '0') as station_id, s_name as station_name, n_name as county, s_suppkey / 4.0 as latitude, -s_suppkey / 8.0 as longitude,
s_acctbal as height, 'm' as height_units, 6 as skip_rows, 2 as data_rows from supplier join nation on s_nationkey = n_nationkey""")
def badc_metadata_header(spark, sf_dir):
    """Station metadata and data window of all headers."""
    parsed = Converter(spark, _supplier_tree(spark, sf_dir, False)).parsed()
    return parsed.select("station_id", "station_name", "county", "latitude", "longitude", "height", "height_units", "skip_rows", "data_rows")


@query("""select case s_suppkey % 4 when 0 then 'ok' when 2 then 'HeaderParsingFailed' else 'NoDataMarker' end as status, count(*) as n_files, cast(sum(case s_suppkey % 4 when 0 then 1 else 0 end) as bigint) as n_rows from supplier group by 1""")
def badc_bad_files_status(spark, sf_dir):
    """Outcomes of files of which three in four are broken."""
    found = Converter(spark, _supplier_tree(spark, sf_dir, True)).outcomes()
    return found.groupBy("status").agg(F.count("*").alias("n_files"), F.sum("n_rows").cast("bigint").alias("n_rows"))


RULES = {"ob_end_time": "timestamp_ntz", "max_gust_ctime": "string", "max_gust_ctime_q": "string", "prcp_amt_j_q": "int", "prcp_amt_j": "string", "prcp_dur": "double", "mean_wind_dir": "double", "ob_day_cnt_q": "int", "src_id": "int", "id": "string", "midas_stmp_etime": "string", "extra": "string"}


@query("select * from (values " + ", ".join(f"('{n}', '{t}')" for n, t in RULES.items()) + ") as t(name, type)")
def type_inference_rules(spark, sf_dir):
    return spark.createDataFrame([(n, type_of(n)) for n in RULES], "name string, type string")


@query("""select 'ob_end_ctime' as name, count(*) = 0 as is_empty from events union all select 'prcp_amt', count(*) filter (event_id % 1000 = 7) = 0 from events union all select 'prcp_dur', true""")
def empty_column_detection(spark, sf_dir):
    """A column with few values stays, one with none is empty."""
    line = F.concat_ws(",", F.col("ts").cast("string"), F.when(F.col("event_id") % 1000 == 7, F.lit("1.0")).otherwise(F.lit("NA")), F.lit("NA"))
    return Converter(spark, _events_tree(spark, sf_dir, line, F.lit("ob_end_ctime,prcp_amt,prcp_dur"))).discover().select("name", "is_empty")


@query("select lpad(cast(user_id as varchar), 5, '0') as station_key, cast(count(distinct strftime(ts, '%Y%m')) as integer) as n_files from events group by user_id")
def files_of_stations(spark, sf_dir):
    return files_by_station(file_table(spark, _plain_tree(spark, sf_dir))).select("station_key", F.size("files").alias("n_files"))


# --------------------------------------------------------------------------------------------- queries on observations


def _obs(spark, sf_dir) -> DataFrame:
    return table(spark, sf_dir, "events").withColumnRenamed("user_id", "station_id")


@query("select event_id, ts, user_id as station_id, value from events where user_id = 8")
def station_filter(spark, sf_dir):
    return obs.of_station(_obs(spark, sf_dir), 8).select("event_id", "ts", "station_id", "value")


START = datetime(2024, 1, 15)


@query("select event_id, ts, value from events where ts > timestamp '2024-01-15'")
def time_range_filter(spark, sf_dir):
    return obs.after(_obs(spark, sf_dir), "ts", START).select("event_id", "ts", "value")


@query("select event_id, ts, value from events where user_id = 8 and ts > timestamp '2024-01-15'")
def station_time_filter(spark, sf_dir):
    return obs.after(obs.of_station(_obs(spark, sf_dir), 8), "ts", START).select("event_id", "ts", "value")


@query("select user_id as station_id, event_id, value from events where event_id % 7 <> 0")
def not_null_projection(spark, sf_dir):
    df = _obs(spark, sf_dir).withColumn("value", F.when(F.col("event_id") % 7 != 0, F.col("value")))
    return obs.with_value(df, "value").select("station_id", "event_id", "value")


@query("select o_orderkey, o_orderdate from orders where year(o_orderdate) = 1997")
def year_filter(spark, sf_dir):
    o = table(spark, sf_dir, "orders")
    return o.where(in_year(F.col("o_orderdate"), 1997)).select("o_orderkey", "o_orderdate")


@query("select l_orderkey, l_linenumber, l_discount from lineitem where l_discount between 0.02 and 0.05 and l_quantity between 5 and 20")
def range_bounds(spark, sf_dir):
    li = obs.within_bounds(table(spark, sf_dir, "lineitem"), l_discount=(0.02, 0.05), l_quantity=(5, 20))
    return li.select("l_orderkey", "l_linenumber", "l_discount")


@query("select count(*) as n_rows, count(distinct user_id) as n_stations, min(ts) as first_time, max(ts) as last_time from events")
def dataset_stats(spark, sf_dir):
    return obs.summary(_obs(spark, sf_dir), "station_id", "ts")


@query("select cast(floor((epoch_us(max(o_orderdate)) - epoch_us(min(o_orderdate))) / 86400000000) as bigint) as days, round(floor((epoch_us(max(o_orderdate)) - epoch_us(min(o_orderdate))) / 86400000000) / 365.25, 6) as years from orders")
def date_span_years(spark, sf_dir):
    days = whole_days(F.min("o_orderdate"), F.max("o_orderdate"))
    return table(spark, sf_dir, "orders").agg(days.alias("days"), F.round(days / 365.25, 6).alias("years"))


@query("select user_id as station_id, count(*) as n_rows from events group by user_id")
def station_counts(spark, sf_dir):
    return obs.station_counts(_obs(spark, sf_dir), "station_id")


@query("select count(*) as n_stations, round(avg(n), 6) as mean_rows from (select count(*) as n from events group by user_id)")
def station_count_summary(spark, sf_dir):
    return obs.station_counts(_obs(spark, sf_dir), "station_id").agg(F.count("*").alias("n_stations"), F.round(F.avg("n_rows"), 6).alias("mean_rows"))


@query("select o_custkey as station_id, cast(year(o_orderdate) as integer) as year, cast(month(o_orderdate) as integer) as month, round(avg(o_totalprice), 4) as mean from orders group by 1, 2, 3")
def monthly_mean(spark, sf_dir):
    o = table(spark, sf_dir, "orders").withColumnRenamed("o_custkey", "station_id")
    return obs.monthly(o, "station_id", "o_orderdate", "o_totalprice").withColumn("mean", F.round("mean", 4))


@query("select l_suppkey as station_id, cast(year(l_shipdate) as integer) as year, cast(month(l_shipdate) as integer) as month, coalesce(round(sum(case when l_quantity > 5 then l_quantity end), 4), 0) as total from lineitem group by 1, 2, 3")
def monthly_sum(spark, sf_dir):
    li = table(spark, sf_dir, "lineitem").select(F.col("l_suppkey").alias("station_id"), "l_shipdate", F.when(F.col("l_quantity") > 5, F.col("l_quantity")).alias("q"))
    return obs.monthly(li, "station_id", "l_shipdate", "q", "total").withColumn("total", F.round("total", 4))


@query("select 0 as n_station, 0 as n_time, 0 as n_between")
def sortedness_check(spark, sf_dir):
    """Rows out of order in a converted dataset of several files, and files out of order: none."""
    root = _plain_tree(spark, sf_dir)
    out = new_path(spark, "converted")
    Converter(spark, root, out, Options(layout="directory", parquet=ParquetOptions(files=5))).run()
    found = obs.order_violations(spark.read.parquet(out), "station_id", "ob_end_ctime")
    return found.agg(*[F.sum(c).cast("int").alias(c) for c in ("n_station", "n_time", "n_between")])


@query("""with e as (select *, event_id // 1000 as f from events), d as (select *, lag(user_id) over w as s, lag(ts) over w as t from e window w as (partition by f order by event_id)),
v as (select f, count(*) filter (user_id < s) as n_station, count(*) filter (user_id = s and ts < t) as n_time, arg_min(user_id, event_id) as a, arg_max(user_id, event_id) as z, arg_min(ts, event_id) as first_ts, arg_max(ts, event_id) as last_ts from d group by f)
select f as file, n_station, n_time, a as first_station, z as last_station, cast(coalesce(a < lag(z) over (order by f) or (a = lag(z) over (order by f) and first_ts < lag(last_ts) over (order by f)), false) as integer) as n_between from v""")
def order_violations(spark, sf_dir):
    """Files of a thousand rows each, in the order of events."""
    e = _obs(spark, sf_dir).withColumns({"f": F.floor(F.col("event_id") / 1000), "r": F.col("event_id")})
    return obs.order_violations(e, "station_id", "ts", F.col("f"), F.col("r"))


@query("select o_orderkey, case when o_orderkey % 3 = 0 then null else o_orderdate end as o_orderdate from orders order by 2 nulls last, 1 limit 500")
def sort_nulls_last_limit(spark, sf_dir):
    o = table(spark, sf_dir, "orders").select("o_orderkey", F.when(F.col("o_orderkey") % 3 != 0, F.col("o_orderdate")).alias("o_orderdate"))
    return obs.sort_nulls_last(o, "o_orderdate", "o_orderkey").limit(500)


@query("select cast(c_custkey as varchar) as id, cast(c_nationkey as double) as amount, cast(c_nationkey as bigint) as n from customer union all select s_name, s_acctbal, cast(null as bigint) from supplier union all select cast(n_nationkey as varchar), 1.5, 7 from nation")
def union_all_supertypes(spark, sf_dir):
    """Types that differ by column: number and text, integers and doubles, a part without a column."""
    a = table(spark, sf_dir, "customer").select(F.col("c_custkey").alias("id"), F.col("c_nationkey").alias("amount"), F.col("c_nationkey").cast("bigint").alias("n"))
    b = table(spark, sf_dir, "supplier").select(F.col("s_name").alias("id"), F.col("s_acctbal").alias("amount"))
    c = table(spark, sf_dir, "nation").select(F.lit(7).alias("n"), F.lit(1.5).cast("float").alias("amount"), F.col("n_nationkey").alias("id"))
    return obs.union_all(a, b, c)


@query("select event_id, user_id, cast(null as varchar) as extra from events where user_id % 2 = 0 union all select event_id, null, event_type from events where user_id % 2 = 1")
def diagonal_union(spark, sf_dir):
    e = table(spark, sf_dir, "events")
    return obs.union_all(e.where("user_id % 2 = 0").select("event_id", "user_id"), e.where("user_id % 2 = 1").select("event_id", F.col("event_type").alias("extra")))


@query("select distinct user_id as station_id from events where event_id % 3 = 0")
def distinct_stations(spark, sf_dir):
    """Each station once; rows without one do not count."""
    df = _obs(spark, sf_dir).withColumn("station_id", F.when(F.col("event_id") % 3 == 0, F.col("station_id")))
    return obs.distinct_values(df, "station_id")


@query("""select p_partkey, b, case when b > 1000000000 then printf('%d files, ~%.1f GB', p_size, b / 1e9) when b > 1000000 then printf('%d files, ~%.1f MB', p_size, b / 1e6)
when b > 1000 then printf('%d files, ~%.1f KB', p_size, b / 1e3) else printf('%d files, ~%d B', p_size, b) end as size from (select *, p_partkey * p_partkey * p_partkey + 17 as b from part)""")
def size_estimate_format(spark, sf_dir):
    p = table(spark, sf_dir, "part").withColumn("b", F.col("p_partkey") * F.col("p_partkey") * F.col("p_partkey") + 17)
    return p.select("p_partkey", "b", size_text(F.col("p_size"), F.col("b")).alias("size"))


@query("""select user_id as station_id, day, rec_st_ind, version_num, event_id from (select *, row_number() over (partition by user_id, day order by rec_st_ind, version_num desc) as n
from (select *, cast(ts as date) as day, case when event_id % 3 = 0 then 1 else 9 end as rec_st_ind, event_id as version_num from events)) where n = 1""")
def dedup_rec_status(spark, sf_dir):
    e = _obs(spark, sf_dir).withColumns({"day": F.to_date("ts"), "rec_st_ind": F.when(F.col("event_id") % 3 == 0, 1).otherwise(9), "version_num": F.col("event_id")})
    return obs.one_record_each(e, ["station_id", "day"]).select("station_id", "day", "rec_st_ind", "version_num", "event_id")


@query("select l_orderkey, l_linenumber, l_quantity from lineitem where l_linenumber in (0, 1)")
def qc_filter(spark, sf_dir):
    return obs.with_flags(table(spark, sf_dir, "lineitem"), "l_linenumber", ("valid", "suspect")).select("l_orderkey", "l_linenumber", "l_quantity")


@query("select l_orderkey, l_linenumber, l_suppkey as src_id, s_name, n_name from lineitem left join (select * from supplier join nation on s_nationkey = n_nationkey where s_suppkey % 5 <> 0) on l_suppkey = s_suppkey")
def registry_join(spark, sf_dir):
    stations = table(spark, sf_dir, "supplier").where("s_suppkey % 5 <> 0").join(F.broadcast(table(spark, sf_dir, "nation")), F.col("s_nationkey") == F.col("n_nationkey"))  # 25 nations
    li = table(spark, sf_dir, "lineitem").withColumnRenamed("l_suppkey", "src_id")
    return obs.with_registry(li, stations.withColumnRenamed("s_suppkey", "src_id"), "src_id").select("l_orderkey", "l_linenumber", "src_id", "s_name", "n_name")


@query("""select l_orderkey, l_linenumber, 'l_quantity' as metric, l_quantity as value from lineitem union all select l_orderkey, l_linenumber, 'l_discount', l_discount from lineitem""")
def long_view(spark, sf_dir):
    return obs.long_view(table(spark, sf_dir, "lineitem"), ["l_orderkey", "l_linenumber"], ["l_quantity", "l_discount"])


@query("select l_orderkey, l_linenumber, l_quantity as m_quantity, l_tax as m_tax from lineitem")
def measurement_map(spark, sf_dir):
    li = table(spark, sf_dir, "lineitem").select("l_orderkey", "l_linenumber", obs.measurements(None, ["l_quantity", "l_tax"]).alias("m"))
    return li.select("l_orderkey", "l_linenumber", F.col("m")["l_quantity"].alias("m_quantity"), F.col("m")["l_tax"].alias("m_tax"))


@query("select s_suppkey, s_nationkey as q_nation from supplier")
def flag_rename(spark, sf_dir):
    s = table(spark, sf_dir, "supplier").select("s_suppkey", F.col("s_nationkey").alias("nation_q"))
    return obs.flag_columns(s)


@query(EVENTS)
def parquet_merge(spark, sf_dir):
    """Sorted ranges in a folder, merged to one file."""
    folder, out = new_path(spark, "parts"), new_path(spark, "merged") + "/rain.parquet"
    job = Converter(spark, _plain_tree(spark, sf_dir), folder, Options(layout="directory"))
    job.run()
    merge(spark, folder, out, ["station_id", "ob_end_ctime"], ParquetOptions(compression="zstd"))
    return spark.read.parquet(out)


@query("select user_id, event_type, count(*) as n_rows from events group by 1, 2")
def partitioned_output(spark, sf_dir):
    """Output in folders by a column, read back."""
    out = new_path(spark, "partitioned")
    write(table(spark, sf_dir, "events"), out, ["user_id", "ts"], ParquetOptions(layout="directory", partition_by=("event_type",)))
    return spark.read.parquet(out).groupBy("user_id", "event_type").agg(F.count("*").alias("n_rows"))


GROUPS = "cast(ceil(count(*) / {n}.0) as bigint)"


@query("select " + GROUPS.format(n=700) + " as n_groups, case when count(*) % 700 = 0 then 700 else count(*) % 700 end as least, 700 as most, round(count(*) / " + GROUPS.format(n=700) + ", 6) as mean, 'ZSTD' as codecs, true as all_statistics from events")
def footer_report(spark, sf_dir):
    """Number and sizes of the row groups of a file with 700 rows in each."""
    options = ParquetOptions(rows_per_group=700, compression="zstd")
    job = Converter(spark, _plain_tree(spark, sf_dir), new_path(spark, "converted") + "/rain.parquet", Options(parquet=options, layout="file"))
    job.run()
    found = footer_summary(column_chunks(spark, job.output))
    return found.select("n_groups", "least", F.col("most").cast("int").alias("most"), F.round("mean", 6).alias("mean"), F.array_join("codecs", ",").alias("codecs"), "all_statistics")


WRITERS = {"snappy": ("SNAPPY", True), "zstd": ("ZSTD", True), "lz4": ("LZ4", True), "none": ("UNCOMPRESSED", False)}


@query("select * from (values " + ", ".join(f"('{name}', '{codec}', {str(stats).lower()})" for name, (codec, stats) in WRITERS.items()) + ") as t(option, codec, statistics), (select count(*) as n_rows from supplier)")
def writer_options(spark, sf_dir):
    """Codec and statistics that files have, by the options they were written with."""
    out = None
    for name, (_, stats) in WRITERS.items():
        path = new_path(spark, "written") + f"/{name}.parquet"
        n = write(table(spark, sf_dir, "supplier"), path, ["s_suppkey"], ParquetOptions(compression=name, statistics=stats))
        one = column_chunks(spark, path).agg(F.max("codec").alias("codec"), F.bool_or("has_statistics").alias("statistics"))
        one = one.select(F.lit(name).alias("option"), F.regexp_replace("codec", "_RAW$", "").alias("codec"), "statistics", F.lit(n).cast("bigint").alias("n_rows"))
        out = one if out is None else out.unionByName(one)
    return out


@query("""with n as (select count(*) as rows, count(distinct user_id) as stations, count(distinct (user_id, strftime(ts, '%Y%m'))) as files, cast(floor((epoch_us(max(ts)) - epoch_us(min(ts))) / 86400000000) as bigint) as days from events)
select 'source_files' as test_name, true as passed, files || ' files' as message from n union all select 'rows_per_file', false, printf('%.1f rows a file', rows / files) from n
union all select 'stations', stations between 50 and 1000, stations || ' stations' from n union all select 'date_span', true, printf('%.1f years', days / 365.25) from n
union all select 'required_columns', true, 'all there' union all select 'column_types', true, 'as they should be' union all select 'column_count', true, '11 columns'
union all select 'schema_width', true, '4 columns, 15 expected; missing: ob_date, id_type, version_num, ob_day_cnt, src_id, rec_st_ind, ob_day_cnt_q, prcp_amt_q, prcp_amt_j, meto_stmp_time, midas_stmp_etime; more: none'
union all select 'station_order', true, '0 rows out of order' union all select 'time_order', true, '0 rows out of order' union all select 'metadata', true, 'isohyet v0.1.0'
union all select 'one_codec', true, 'SNAPPY' union all select 'statistics', true, 'in all column chunks'""")
def validation_report(spark, sf_dir):
    """Checks whose result the data decide, with the limits of full datasets: months are too few rows for a file."""
    root = _plain_tree(spark, sf_dir)
    job = Converter(spark, root, new_path(spark, "converted") + "/rain.parquet")
    job.run()
    names = "source_files rows_per_file stations date_span required_columns column_types column_count schema_width station_order time_order metadata one_codec statistics".split()
    return Validator(spark, job.output, Kind.RAIN, root).report().where(F.col("test_name").isin(names)).select("test_name", "passed", "message")


@query("select 'empty' as dataset, 0 as files, 0 as n_rows union all select 'full', cast(count(*) as integer), cast(count(*) as integer) from supplier")
def empty_dataset(spark, sf_dir):
    """A dataset without files converts to nothing, one with files to their rows."""
    root = new_path(spark, "tree") + "/rain"
    fs, p = _fs(spark, f"{root}/qcv-1")
    fs.mkdirs(p)
    full = Converter(spark, _supplier_tree(spark, sf_dir, False), new_path(spark, "converted") + "/rain.parquet").run()
    empty = Converter(spark, root, f"{root}.parquet").run()
    rows = [(name, x.files_processed, x.total_rows) for name, x in (("empty", empty), ("full", full))]
    return spark.createDataFrame(rows, "dataset string, files int, n_rows int")


@query("""select cast(s_suppkey as integer) as src_id, lpad(cast(s_suppkey as varchar), 5, '0') as station_id, s_name as station_name, n_name as county, s_suppkey / 4.0 as latitude, -s_suppkey / 8.0 as longitude, s_acctbal as height, 'm' as height_units,
cast(9 as integer) as rec_st_ind, 'last of ' || s_suppkey as met_domain_name from supplier join nation on s_nationkey = n_nationkey where s_suppkey % 3 <> 0""")
def station_registry(spark, sf_dir):
    """Capability files at any depth: of the records of a station the last one with status 9 counts, others do not."""
    s = table(spark, sf_dir, "supplier").join(F.broadcast(table(spark, sf_dir, "nation")), F.col("s_nationkey") == F.col("n_nationkey"))  # 25 nations
    k = F.col("s_suppkey")
    head = badc_out.header(F.col("s_name"), F.lpad(k.cast("string"), 5, "0"), F.col("n_name"), k / F.lit(4.0), -k / F.lit(8.0), F.col("s_acctbal"), F.lit("m"))
    line = lambda status, text: F.concat_ws(",", k.cast("string"), status, F.concat(F.lit(text + " of "), k.cast("string")))
    real = F.when(k % 3 == 0, F.lit("1")).otherwise(F.lit("9"))
    rows = F.array(line(real, "first"), line(real, "last"), line(F.lit("1"), "none"))
    text = badc_out.file_text(head, F.lit("src_id,rec_st_ind,met_domain_name"), rows)
    files = s.select(F.concat(F.lit("county"), F.col("n_nationkey").cast("string")).alias("county_dir"), F.lpad(k.cast("string"), 5, "0").alias("station_dir"), F.concat(F.lit("capability"), k.cast("string")).alias("file"), text.alias("text"))
    root = new_path(spark, "tree") + "/uk-daily-rain-obs"
    badc_out.write_tree(files, root)
    fs, p = _fs(spark, f"{root}/qcv-1")
    fs.rename(p, _fs(spark, f"{root}/capability")[1])
    return registry(spark, [root, f"{root}/none"], ["src_id", "rec_st_ind", "met_domain_name"])


@query("""select case user_id % 3 when 0 then 'short' when 1 then 'usual' else 'long' end as layout, case user_id % 3 when 0 then 2 when 2 then 16 end as found, case user_id % 3 when 1 then null else 15 end as expected, case user_id % 3 when 0 then 13 when 2 then 0 end as n_missing, case user_id % 3 when 0 then 0 when 2 then 1 end as n_extra
from events group by user_id % 3""")
def schema_width(spark, sf_dir):
    """Files against the columns that rain files usually have."""
    usual = EXPECTED[Kind.RAIN]
    columns = {"short": ["ob_end_ctime", "prcp_amt"], "usual": usual, "long": [*usual, "extra"]}
    n = F.col("user_id") % 3
    pick = lambda of: F.when(n == 0, F.lit(of("short"))).when(n == 1, F.lit(of("usual"))).otherwise(F.lit(of("long")))
    root = _events_tree(spark, sf_dir, F.lit("2024-01-01"), pick(lambda x: ",".join(columns[x])))
    job = Converter(spark, root)
    seen = badc.overview(job.parsed())
    found = {tuple(seen.lists[path]): w for path, w in job.widths_of(seen).items()}
    there = {r["n"] for r in table(spark, sf_dir, "events").select((F.col("user_id") % 3).alias("n")).distinct().collect()}
    rows = []
    for i, (name, cols) in enumerate(columns.items()):
        w = found.get(tuple(cols))
        if i in there:
            rows.append((name, w and w.found, w and w.expected, w and len(w.missing), w and len(w.extra)))
    return spark.createDataFrame(rows, "layout string, found int, expected int, n_missing int, n_extra int")


@query("select cast(year(o_orderdate) as integer) as year, 'county' || (o_custkey % 4) as county, o_orderkey, o_totalprice from orders")
def year_county_partitions(spark, sf_dir):
    """Output in folders by year of the time and by county, read back with both."""
    out = new_path(spark, "partitioned")
    o = table(spark, sf_dir, "orders").withColumn("county", F.concat(F.lit("county"), (F.col("o_custkey") % 4).cast("string")))
    write(o, out, ["o_custkey", "o_orderdate"], ParquetOptions(year_of="o_orderdate", partition_by=("county",)))
    return spark.read.parquet(out).select("year", "county", "o_orderkey", "o_totalprice")


CORES, MEMORY = (1, 4, 8, 32), (7, 256, 16384, 65536)
SIZES = "least(2000000, greatest(100000, least(2684354, cores * 100000, cast(memory // 8 as bigint) * 1048576 // 100)))"


@query(f"""with x as (select cores, memory from (select unnest({list(CORES)}) as cores), (select unnest({list(MEMORY)}) as memory)), a as (select *, {SIZES} as adaptive from x),
n as (select count(*) * 1000 as rows, count(distinct l_suppkey) as stations from lineitem)
select cast(cores as integer) as cores, cast(memory as integer) as memory, cast(adaptive as integer) as adaptive, cast(least(2000000, greatest(250000, least(adaptive, (rows // stations) * greatest(stations // cores, 1)))) as integer) as by_station from a, n""")
def row_group_sizes(spark, sf_dir):
    """Rows of a row group by cores and memory, for a thousand times the rows of lineitem."""
    n = obs.summary(table(spark, sf_dir, "lineitem"), "l_suppkey", "l_shipdate").first()
    rows = [(c, m, rows_per_group("adaptive", cores=c, memory_mb=m), rows_per_group("station", rows=1000 * n["n_rows"], stations=n["n_stations"], cores=c, memory_mb=m)) for c in CORES for m in MEMORY]
    return spark.createDataFrame(rows, "cores int, memory int, adaptive int, by_station int")


@query("select 'uk-daily-rain-obs' as name, count(*) as n_files, count(distinct s_nationkey) as n_counties, count(distinct s_suppkey % 40) as n_stations from supplier")
def dataset_listing(spark, sf_dir):
    """Datasets of a folder by name, with their files, counties and stations; a station in two counties counts once."""
    s = table(spark, sf_dir, "supplier")
    files = s.select(F.concat(F.lit("county"), F.col("s_nationkey").cast("string")).alias("county_dir"), F.concat((F.col("s_suppkey") % 40).cast("string"), F.lit("_s")).alias("station_dir"), F.concat_ws("_", "s_name", F.col("s_suppkey").cast("string")).alias("file"), F.lit("x").alias("text"))
    cache = new_path(spark, "cache")
    badc_out.write_tree(files, f"{cache}/uk-daily-rain-obs")
    for other in ("parquet/qcv-1", "note.txt/qcv-1", "no-dataset"):
        fs, p = _fs(spark, f"{cache}/{other}")
        fs.mkdirs(p)
    rows = [(d.name, *station_level(file_table(spark, d.path)).first()) for d in datasets(spark, cache)]
    return spark.createDataFrame(rows, "name string, n_files bigint, n_counties bigint, n_stations bigint")


@query("select user_id, cast(extract(year from ts) as integer) as year, round(avg(value), 4) as mean from events group by 1, 2")
def converted_yearly_mean(spark, sf_dir):
    """Flagship: convert, read back, aggregate."""
    df = _convert(spark, _plain_tree(spark, sf_dir))
    return df.groupBy(F.col("station_id").cast("bigint").alias("user_id"), F.year("ob_end_ctime").alias("year")).agg(F.round(F.avg("prcp_amt"), 4).alias("mean"))


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return dict(QUERIES)


def oracle_sql() -> dict[str, str]:
    return dict(SQL)

"""Dataset kinds and the rules that give a column its type by its name."""

from __future__ import annotations

from dataclasses import dataclass
from enum import Enum

from ..errors import ConfigurationError


class Kind(Enum):
    """Kinds of the eight published datasets: daily and hourly rain, daily and hourly weather, daily and soil temperature,
    wind, radiation.  A name is looked through for them in this order."""

    SOIL = "soil"
    RAIN = "rain"
    TEMPERATURE = "temperature"
    WIND = "wind"
    RADIATION = "radiation"
    WEATHER = "weather"

    @property
    def time_column(self) -> str:
        return {Kind.RAIN: "ob_end_ctime", Kind.SOIL: "ob_time"}.get(self, "ob_end_time")

    def time_in(self, columns) -> str | None:
        """The time column of a dataset with these columns: the kind's own, or the first other there is."""
        return next((c for c in (self.time_column, "ob_end_time", "ob_time") if c in columns), None)


#: Columns that every dataset gets from the file headers, with their types.
STATION_COLUMNS = {
    "station_id": "string",
    "station_name": "string",
    "county": "string",
    "latitude": "double",
    "longitude": "double",
    "height": "double",
    "height_units": "string",
}

# Names and parts of names that decide a type.
TIME_NAMES = ("ob_end_time", "ob_date", "ob_end_ctime", "ob_time")
STAMP_PARTS = ("stmp_time", "ctime")
TEXT_NAMES = ("id", "id_type", "met_domain_name")
COUNT_NAMES = ("version_num", "ob_hour_count", "ob_day_cnt", "src_id", "rec_st_ind")
MEASURE_PARTS = ("temp", "prcp", "irad", "wind", "gust", "ilmn", "bal_amt")


def type_of(name: str) -> str:
    """Type of a column; the first rule that fits decides."""
    if name in TIME_NAMES:
        return "timestamp_ntz"
    if name in TEXT_NAMES or any(p in name for p in STAMP_PARTS):
        return "string"
    if name.endswith("_q"):
        return "int"
    if name.endswith("_j"):
        return "string"
    if name in COUNT_NAMES:
        return "int"
    return "double" if any(p in name for p in MEASURE_PARTS) else "string"


def is_descriptor(name: str) -> bool:
    return name.endswith("_j")


def is_timestamp(name: str) -> bool:
    return "time" in name


def kind_of(*texts: str) -> Kind:
    """Kind by the first text that names one: the dataset's directory, a file, the whole path, in this order."""
    for text in texts:
        for kind in Kind:
            if kind.value in text.lower():
                return kind
    raise ConfigurationError("could not detect dataset type from " + ", ".join(texts))


# Columns that files of each kind usually have, and those among them that are usually empty.
EXPECTED = {
    Kind.RAIN: "ob_date id id_type version_num met_domain_name ob_end_ctime ob_day_cnt src_id rec_st_ind prcp_amt ob_day_cnt_q prcp_amt_q prcp_amt_j meto_stmp_time midas_stmp_etime".split(),
    Kind.TEMPERATURE: "ob_end_time id_type id ob_hour_count version_num met_domain_name src_id rec_st_ind max_air_temp min_air_temp min_grss_temp min_conc_temp max_air_temp_q min_air_temp_q min_grss_temp_q min_conc_temp_q max_air_temp_j min_air_temp_j min_grss_temp_j min_conc_temp_j meto_stmp_time midas_stmp_etime".split(),
    Kind.WIND: "ob_end_time id_type id ob_hour_count met_domain_name version_num src_id rec_st_ind mean_wind_dir mean_wind_speed max_gust_dir max_gust_speed max_gust_ctime mean_wind_dir_q mean_wind_speed_q max_gust_dir_q max_gust_speed_q max_gust_ctime_q mean_wind_dir_j mean_wind_speed_j max_gust_dir_j max_gust_speed_j meto_stmp_time midas_stmp_etime".split(),
    Kind.RADIATION: "ob_end_time id id_type ob_hour_count version_num met_domain_name src_id rec_st_ind glbl_irad_amt meto_stmp_time midas_stmp_etime".split(),
}
OFTEN_EMPTY = {
    Kind.RAIN: "prcp_amt_j meto_stmp_time midas_stmp_etime".split(),
    Kind.TEMPERATURE: "min_grss_temp min_conc_temp min_grss_temp_q min_conc_temp_q min_grss_temp_j min_conc_temp_j".split(),
    Kind.WIND: "mean_wind_dir max_gust_dir max_gust_ctime".split(),
    Kind.RADIATION: [],
}


@dataclass(frozen=True)
class Width:
    """What the columns of a file are against those that its kind usually has."""

    expected: int
    found: int
    missing: tuple[str, ...]
    extra: tuple[str, ...]

    @classmethod
    def of(cls, kind: Kind, columns: list[str]) -> Width | None:
        """None where the kind has no usual columns, or the number is as usual."""
        usual = EXPECTED.get(kind)
        if not usual or len(columns) == len(usual):
            return None
        return cls(len(usual), len(columns), tuple(c for c in usual if c not in columns), tuple(c for c in columns if c not in usual))

    def __str__(self) -> str:
        return f"{self.found} columns, {self.expected} expected; missing: {', '.join(self.missing) or 'none'}; more: {', '.join(self.extra) or 'none'}"


def usually_empty(kind: Kind) -> list[str]:
    return OFTEN_EMPTY.get(kind, [])


@dataclass(frozen=True)
class Schema:
    """Ordered columns of a dataset with their types, and what is known of them."""

    columns: dict[str, str]
    empty: tuple[str, ...] = ()
    #: most columns that a file has; 0 where files have not been looked at
    widest: int = 0

    @classmethod
    def of(cls, column_lists: list[list[str]]) -> Schema:
        """Union of column lists by name, in order of first sight."""
        return cls({name: type_of(name) for cols in column_lists for name in cols})

    @property
    def kept(self) -> dict[str, str]:
        return {n: t for n, t in self.columns.items() if n not in self.empty}

    def differing(self, cols: list[str]) -> int:
        return len(set(self.columns) ^ set(cols))

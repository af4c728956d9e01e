"""Rows per Parquet row group."""

from __future__ import annotations

# Fixed values that decide the sizes; HARD_MOST is what 256 MiB hold of rows of 100 bytes.
FIXED = 500_000
LEAST, STATION_LEAST, MOST = 100_000, 250_000, 2_000_000
PER_CORE = 100_000
#: Memory that a row is taken to need, and the share of memory for one group.
ROW_BYTES, MEMORY_SHARE = 100, 8
HARD_MOST = 2_684_354


def executor_memory_mb(spark) -> int:
    """Memory of one executor as the session has it; on a local master, the driver's."""
    conf = spark.sparkContext.getConf()
    local = spark.sparkContext.master.startswith("local")
    text = conf.get("spark.driver.memory" if local else "spark.executor.memory", "1g").strip().lower().removesuffix("b")
    unit = {"k": 1 / 1024, "m": 1, "g": 1024, "t": 1 << 20}.get(text[-1:])
    return max(1, int(float(text[:-1]) * unit)) if unit else max(1, int(text) >> 20)


def between(n: int, low: int, high: int) -> int:
    return max(low, min(n, high))


def adaptive(cores: int, memory_mb: int) -> int:
    by_memory = memory_mb // MEMORY_SHARE * (1 << 20) // ROW_BYTES
    return between(min(HARD_MOST, cores * PER_CORE, by_memory), LEAST, MOST)


def rows_per_group(strategy: str = "fixed", *, target: int | None = None, rows: int = 0, stations: int = 0, cores: int = 1, memory_mb: int = 16_384) -> int:
    """strategy: fixed, adaptive (by cores and memory) or station (some whole stations a group); target overrides all."""
    if target:
        return target
    if strategy == "fixed":
        return FIXED
    limit = adaptive(cores, memory_mb)
    if strategy == "adaptive" or not stations:
        return limit
    if strategy == "station":
        return between(min(rows // stations * max(stations // cores, 1), limit), STATION_LEAST, MOST)
    raise ValueError(f"no strategy {strategy}")

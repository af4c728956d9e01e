"""Settings of the command line in layers: a file, then the environment, then arguments; later ones win."""

from __future__ import annotations

import os
import tomllib
from collections.abc import Mapping
from dataclasses import dataclass, fields

from .errors import ConfigurationError


@dataclass(frozen=True)
class Settings:
    cache: str | None = None
    output_path: str | None = None
    compression: str = "snappy"
    empty_columns: str = "exact"
    row_groups: str | None = None
    layout: str | None = None
    sample_files: int = 10
    files_per_task: int | None = None
    schema_variance: int | None = None

    def checked(self) -> Settings:
        """self, if all values are such as there can be."""
        for name, known in (("empty_columns", ("exact", "sample", "off")), ("row_groups", (None, "fixed", "adaptive", "station")), ("layout", (None, "file", "directory"))):
            if getattr(self, name) not in known:
                raise ConfigurationError(f"{name}: {getattr(self, name)!r} is none of {', '.join(map(str, known))}")
        for name, least in (("sample_files", 1), ("files_per_task", 1), ("schema_variance", 0)):
            if (value := getattr(self, name)) is not None and value < least:
                raise ConfigurationError(f"{name}: {value} is less than {least}")
        return self


PREFIX = "ISOHYET_"


def settings_file(env: Mapping[str, str]) -> str:
    base = env.get("XDG_CONFIG_HOME") or os.path.join(env.get("HOME", os.path.expanduser("~")), ".config")
    return env.get("ISOHYET_CONFIG") or os.path.join(base, "isohyet", "config.toml")


def settings(arguments: Mapping[str, object] | None = None, env: Mapping[str, str] | None = None) -> Settings:
    """arguments: those that were given; None counts as not given."""
    env = os.environ if env is None else env
    kinds = {f.name: f.type for f in fields(Settings)}
    found: dict[str, object] = {}
    path = settings_file(env)
    if os.path.exists(path):
        with open(path, "rb") as f:
            try:
                found |= tomllib.load(f)
            except tomllib.TOMLDecodeError as e:
                raise ConfigurationError(f"{path}: {e}") from e
    elif env.get("ISOHYET_CONFIG"):
        raise ConfigurationError(f"no file {path}")
    found |= {name: env[PREFIX + name.upper()] for name in kinds if env.get(PREFIX + name.upper())}
    found |= {name: value for name, value in (arguments or {}).items() if value is not None}
    if unknown := found.keys() - kinds.keys():
        raise ConfigurationError(f"no settings {', '.join(sorted(unknown))}")
    try:
        return Settings(**{n: int(v) if "int" in str(kinds[n]) and v is not None else str(v) for n, v in found.items()}).checked()
    except ValueError as e:
        raise ConfigurationError(str(e)) from e

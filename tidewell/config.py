"""Configuration of mirror and diff runs, read from YAML."""

from __future__ import annotations

from dataclasses import dataclass, field

import yaml

LEVELS = ("metadata_count", "exact_count", "primary_keys")
PREFIX = "tidewell_"


@dataclass(frozen=True)
class Endpoint:
    """Where tables lie: a ``path`` of parquet tables, or a database that a JDBC driver reaches."""

    host: str = ""
    port: int = 0
    database: str = ""
    user: str = ""
    password: str = field(default="", repr=False)
    schema: str = "public"
    path: str = ""


@dataclass(frozen=True)
class Settings:
    batch_size: int = 1000
    flush_interval_secs: int = 5
    parallel_loads: int = 4
    timeout_secs: int = 3600
    binary: bool = False


@dataclass(frozen=True)
class TableSpec:
    name: str
    key: tuple[str, ...] = ()
    level: str = "metadata_count"


@dataclass(frozen=True)
class Config:
    """One run. Publication and slot share a name made from ``mirror_name``."""

    source: Endpoint
    destination: Endpoint
    tables: tuple[TableSpec, ...]
    mirror_name: str = ""
    settings: Settings = Settings()

    @property
    def publication(self) -> str:
        return PREFIX + self.mirror_name

    slot = publication

    def qualified(self, table: str) -> str:
        return f"{self.destination.database}.{table}"


def _endpoint(raw: dict, port: int) -> Endpoint:
    return Endpoint(**{"port": port} | raw)


def parse(text: str) -> Config:
    """A mirror or diff configuration; tables are names, or mappings with name, key and level."""
    raw = yaml.safe_load(text) or {}
    tables = tuple(TableSpec(t) if isinstance(t, str) else TableSpec(t["name"], tuple(t.get("key", ())), t.get("level", LEVELS[0])) for t in raw.get("tables") or ())
    if not tables:
        raise ValueError("no tables are configured")
    if bad := [t.name for t in tables if t.level not in LEVELS]:
        raise ValueError(f"unknown level for {', '.join(bad)}")
    return Config(_endpoint(raw.get("source", {}), 5432), _endpoint(raw.get("destination", {}), 8123), tables, raw.get("mirror_name", ""), Settings(**raw.get("settings", {})))


def load(path: str) -> Config:
    with open(path, encoding="utf-8") as f:
        return parse(f.read())

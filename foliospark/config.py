"""Settings of a catalogue in a TOML file; paths are relative to the file."""

from __future__ import annotations

import os
import tomllib
from dataclasses import dataclass


class BadConfig(ValueError):
    """The file cannot be used; the message names the key."""


@dataclass(frozen=True)
class Config:
    source_root: str
    output_root: str
    namespace: str = "id"
    extractor_version: str = "7"


def load(path: str) -> Config:
    """Read and check a configuration: known keys, text values, roots that do not overlap."""
    try:
        with open(path, "rb") as f:
            given = tomllib.load(f)
    except (OSError, tomllib.TOMLDecodeError) as e:
        raise BadConfig("unreadable configuration") from e
    known = Config.__dataclass_fields__
    if bad := sorted(set(given) - set(known)):
        raise BadConfig(f"unknown key {bad[0]}")
    for k in known:
        if k in given and not (isinstance(given[k], str) and given[k]):
            raise BadConfig(f"{k} must be a text")
    if missing := [k for k in ("source_root", "output_root") if k not in given]:
        raise BadConfig(f"{missing[0]} is missing")
    base = os.path.dirname(os.path.abspath(path))
    roots = {k: os.path.realpath(os.path.join(base, given[k])) for k in ("source_root", "output_root")}
    a, b = roots["source_root"], roots["output_root"]
    if os.path.commonpath([a, b]) in (a, b):
        raise BadConfig("source_root and output_root overlap")
    return Config(**(given | roots))

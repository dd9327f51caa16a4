"""Settings of a run: what the command line says, then a TOML section or an .env file, then defaults."""

from __future__ import annotations

import tomllib
from pathlib import Path


def toml_section(path: str | Path, section: str) -> dict:
    """A section of a TOML file; no file or no section is empty."""
    p = Path(path)
    found = tomllib.loads(p.read_text(encoding="utf-8")).get(section, {}) if p.exists() else {}
    if not isinstance(found, dict):
        raise ValueError(f"[{section}] of {path} is no section")
    return found


def env_file(*paths: str | Path) -> dict[str, str]:
    """NAME=value lines of files, later files first; blank lines and # lines don't count, quotes around a value go."""
    out: dict[str, str] = {}
    for path in map(Path, paths):
        for line in path.read_text(encoding="utf-8").splitlines() if path.exists() else []:
            name, eq, value = line.strip().removeprefix("export ").partition("=")
            if eq and not name.startswith("#"):
                value = value.strip()
                out[name.strip()] = value[1:-1] if len(value) > 1 and value[0] == value[-1] and value[0] in "\"'" else value
    return out


def settings(defaults: dict, file: dict | None = None, given: dict | None = None) -> dict:
    """For each default the value given, else that of the file, else the default; None is not a value."""
    layers = ({k: v for k, v in (x or {}).items() if v is not None} for x in (file, given))
    out = dict(defaults)
    for layer in layers:
        out |= {k: v for k, v in layer.items() if k in defaults}
    return out

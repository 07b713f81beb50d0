"""Pipeline configuration files (YAML), read on the driver."""

from __future__ import annotations

from pathlib import Path


def read_config(path: str | Path) -> dict:
    """A YAML mapping; an empty file is an empty dict."""
    import yaml
    with open(path, encoding="utf-8") as fh:
        return yaml.safe_load(fh) or {}

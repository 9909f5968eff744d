"""Run settings: a registry with kinds and bounds, TOML in and out, and changes that apply all or not at all."""

from __future__ import annotations

import copy
import ipaddress
import tomllib
from dataclasses import dataclass
from pathlib import Path
from typing import Any


@dataclass(frozen=True)
class Setting:
    path: str
    kind: type
    default: Any
    low: float | None = None
    high: float | None = None
    choices: tuple = ()
    secret: bool = False
    settable: bool = True


REGISTRY = {
    s.path: s
    for s in (
        Setting("run.in_dir", str, "in", settable=False), Setting("run.out_dir", str, "out", settable=False), Setting("run.airgap", bool, False),
        Setting("run.granularity", str, "line", choices=("line", "word")), Setting("run.overlay_font", str, ""), Setting("run.max_upload_mb", int, 200, 1, 10_000),
        Setting("run.fuse_min_sim", float, 0.34, 0.0, 1.0), Setting("run.fuse_det_conf_trust", float, 0.80, 0.0, 1.0), Setting("run.vision_skip", float, 0.92, 0.0, 1.0),
        Setting("run.paddle_skip", float, 0.0, 0.0, 1.0), Setting("run.table_read", bool, True), Setting("run.settle_seconds", float, 2.0, 0.0, 3600.0),
        Setting("vlm.model", str, "general"), Setting("vlm.base_url", str, "http://127.0.0.1:8080/v1"), Setting("vlm.api_key", str, "", secret=True),
        Setting("vlm.escalation_model", str, ""), Setting("vlm.escalate_below", float, 0.0, 0.0, 1.0), Setting("vlm.escalation_base_url", str, ""),
        Setting("vlm.max_tokens", int, 4096, 1, 1_000_000), Setting("vlm.max_retries", int, 2, 0, 20), Setting("vlm.jpeg_quality", int, 90, 1, 100),
    )
}


class SettingError(ValueError):
    pass


def defaults() -> dict:
    out: dict = {"routing": {}}
    for s in REGISTRY.values():
        put(out, s.path, s.default)
    return out


def get(config: dict, path: str) -> Any:
    for part in path.split("."):
        config = config[part]
    return config


def put(config: dict, path: str, value: Any) -> None:
    *parents, last = path.split(".")
    for part in parents:
        config = config.setdefault(part, {})
    config[last] = value


def checked(path: str, value: Any) -> Any:
    """The value as its setting takes it; an error if it is unknown, of another kind or out of bounds."""
    s = REGISTRY.get(path)
    if s is None:
        raise SettingError(f"unknown setting {path}")
    if s.kind is float and isinstance(value, int) and not isinstance(value, bool):
        value = float(value)
    if not isinstance(value, s.kind) or (isinstance(value, bool) and s.kind is not bool):
        raise SettingError(f"{path} takes {s.kind.__name__}")
    if s.choices and value not in s.choices:
        raise SettingError(f"{path} is one of {', '.join(s.choices)}")
    if (s.low is not None and value < s.low) or (s.high is not None and value > s.high):
        raise SettingError(f"{path} lies in [{s.low}, {s.high}]")
    return value


def surface(config: dict) -> list[dict]:
    """All settings with their values, secrets masked."""
    return [{"path": s.path, "kind": s.kind.__name__, "settable": s.settable, "value": ("***" if get(config, s.path) else "") if s.secret else get(config, s.path)} for s in REGISTRY.values()]


def apply(config: dict, changes: dict[str, Any]) -> dict:
    """A copy of ``config`` with all changes; nothing changes if one of them is refused."""
    out = copy.deepcopy(config)
    for path, value in changes.items():
        value = checked(path, value)
        if not REGISTRY[path].settable:
            raise SettingError(f"{path} is fixed while running")
        put(out, path, value)
    return out


def load(path: str | Path) -> dict:
    """Settings of a TOML file over the defaults; a missing file is all defaults."""
    out = defaults()
    if Path(path).exists():
        given = tomllib.loads(Path(path).read_text(encoding="utf-8"))
        out["routing"] = given.pop("routing", {})
        for section, values in given.items():
            for name, value in values.items():
                put(out, f"{section}.{name}", checked(f"{section}.{name}", value))
    return out


def _toml(value: Any) -> str:
    if isinstance(value, bool):
        return str(value).lower()
    if isinstance(value, str):
        escaped = "".join({"\\": "\\\\", '"': '\\"', "\n": "\\n", "\t": "\\t", "\r": "\\r"}.get(c, c) for c in value)
        return f'"{escaped}"'
    return repr(value)


def save(config: dict, path: str | Path) -> None:
    lines = []
    for section in ("run", "vlm"):
        lines += [f"[{section}]", *(f"{k} = {_toml(v)}" for k, v in config[section].items()), ""]
    for script, values in config["routing"].items():
        lines += [f"[routing.{script}]", *(f"{k} = {_toml(v)}" for k, v in values.items()), ""]
    Path(path).write_text("\n".join(lines), encoding="utf-8")


def is_loopback(host: str) -> bool:
    """Whether a host is this machine: localhost, or a loopback address."""
    if host.lower() == "localhost":
        return True
    try:
        return ipaddress.ip_address(host.strip("[]")).is_loopback
    except ValueError:
        return False

"""Settings of an annotation run."""

from __future__ import annotations

import os
from dataclasses import dataclass, field

from tracewright.sources.files import parse_datasets

# Accepted names.
MODE_ALIASES = {"object_switch": "coarse", "action_phase": "fine"}
MODES, TARGETS, BACKENDS, LEVELS = ["coarse", "fine"], ["subtask", "memory"], ["dummy", "remote"], ["DEBUG", "INFO", "WARNING", "ERROR", "CRITICAL"]


@dataclass
class Settings:
    datasets: list[tuple[str, str]] = field(default_factory=list)
    mode: str = "coarse"
    targets: list[str] = field(default_factory=lambda: ["subtask"])
    backend: str = "dummy"
    level: str = "INFO"
    window_sec: float = 16.0
    step_sec: float = 8.0
    frames_per_window: int = 16
    tries: int = 5

    def __post_init__(self):
        self.mode = MODE_ALIASES.get(self.mode.lower(), self.mode.lower())
        if isinstance(self.targets, str):
            self.targets = self.targets.split(",")
        self.targets = list(dict.fromkeys(t.strip().lower() for t in self.targets))
        self.level = self.level.upper()
        for name, value, known in (("mode", self.mode, MODES), ("backend", self.backend, BACKENDS), ("level", self.level, LEVELS), *(("target", t, TARGETS) for t in self.targets)):
            if value not in known:
                raise ValueError(f"{name} {value} is not one of {known}")
        if not self.targets:
            raise ValueError("no target")

    @classmethod
    def load(cls, path: str | None = None) -> Settings:
        """A YAML file, else ./config.yaml, else the environment's DATASETS."""
        path = path or ("config.yaml" if os.path.exists("config.yaml") else None)
        if path:
            import yaml

            with open(path, encoding="utf-8") as f:
                got = yaml.safe_load(f) or {}
            # Settings may stand in sections; of one name the one outside sections counts.
            flat = {k: v for section in got.values() if isinstance(section, dict) for k, v in section.items()} | got
            return cls(**{k: v for k, v in flat.items() if k in cls.__dataclass_fields__})
        return cls(datasets=parse_datasets(os.environ.get("DATASETS", "")))

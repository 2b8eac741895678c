"""Settings: defaults, then a TOML file, then flags that were given. Checks come in a fixed order and the first that fails is told."""

from __future__ import annotations

import argparse
import os
import tomllib
from dataclasses import asdict, dataclass, fields

PAGE_SIZES = (10, 30, 60, 100)


@dataclass
class Config:
    """What a collection reads and writes, its limits and budgets. Times are milliseconds unless the name says otherwise."""

    input: str = "task.txt"
    data_dir: str = "./data"
    results_file: str = "results.txt"
    rows_file: str = "trademarks.tsv"
    rows_max_bytes: int = 256 << 20
    sweep_secs: int = 180
    done_file: str = "done.lst"
    failed_file: str = "failed.lst"
    short_file: str = "short.lst"
    threads: int = 3
    split_pages: bool = False
    max_attempts: int = 5
    proxy_list: str = "proxy.lst"
    proxy_probe_url: str = ""
    profiles_dir: str = "profiles"
    ua_file: str = "ua.txt"
    mode: str = "replay"
    headless: bool = False
    save_grid: bool = True
    save_full: bool = False
    save_pdf: bool = False
    rows_per_page: int = 100
    max_pages: int = 0
    prefetch_pages: int = 2
    start_page: int = 0
    end_page: int = 0
    submit_gap_ms: int = 3000
    submit_jitter_ms: int = 2500
    task_pause_ms: int = 2000
    task_pause_jitter_ms: int = 4000
    nav_timeout_ms: int = 120_000
    results_timeout_ms: int = 180_000
    watchdog_ms: int = 0
    proxy_fail_budget: int = 5
    proxy_cooldown_ms: int = 900_000
    proxy_probe_timeout_ms: int = 12_000
    proxy_probe_concurrency: int = 8
    proxy_latency_ref_ms: int = 3000
    timeout_scale_min: float = 1.0
    timeout_scale_max: float = 4.0
    errors_template: str = "errors.lst"
    all_threads_pause_duration: int = 300

    def problems(self):
        """Each check in turn: (whether it fails, what to say)."""
        for name in ("input", "data_dir", "results_file", "rows_file"):
            yield not getattr(self, name), f"{name} is required"
        at_least = lambda name, low: (getattr(self, name) < low, f"{name} must be >= {low}")
        yield at_least("rows_max_bytes", 0)
        yield at_least("sweep_secs", 0)
        for name in ("done_file", "failed_file", "short_file"):
            yield not getattr(self, name), f"{name} is required"
        yield at_least("threads", 1)
        yield self.mode not in ("replay", "browser"), 'mode must be "replay" or "browser"'
        yield at_least("max_attempts", 1)
        yield self.rows_per_page not in PAGE_SIZES, f"rows_per_page must be one of {', '.join(map(str, PAGE_SIZES))}"
        for name in ("max_pages", "prefetch_pages", "start_page", "end_page"):
            yield at_least(name, 0)
        yield self.start_page > 1 and 0 < self.end_page < self.start_page, f"end_page ({self.end_page}) is before start_page ({self.start_page})"
        for name, low in (("nav_timeout_ms", 1000), ("results_timeout_ms", 1000), ("watchdog_ms", 0), ("proxy_fail_budget", 1), ("proxy_cooldown_ms", 0), ("proxy_probe_timeout_ms", 1000), ("proxy_probe_concurrency", 1), ("proxy_latency_ref_ms", 1)):
            yield at_least(name, low)
        yield self.timeout_scale_min <= 0, "timeout_scale_min must be > 0"
        yield self.timeout_scale_max < self.timeout_scale_min, f"timeout_scale_max ({self.timeout_scale_max:g}) is below timeout_scale_min ({self.timeout_scale_min:g})"
        yield at_least("all_threads_pause_duration", 0)

    def validate(self) -> None:
        for failed, text in self.problems():
            if failed:
                raise ValueError(text)

    def watchdog(self) -> int:
        """How long a step may stay silent: as set, or the longest budget of a step, scaled all the way, and 30 seconds."""
        if self.watchdog_ms > 0:
            return self.watchdog_ms
        return int(max(self.nav_timeout_ms, self.results_timeout_ms) * max(1.0, self.timeout_scale_max)) + 30_000

    def toml(self) -> str:
        text = lambda v: str(v).lower() if isinstance(v, bool) else '"' + v.replace("\\", "\\\\").replace('"', '\\"') + '"' if isinstance(v, str) else repr(v)
        return "".join(f"{k} = {text(v)}\n" for k, v in asdict(self).items())


def loaded(path: str | None = None, arguments: list[str] | None = None) -> Config:
    """A missing file is no error; keys that are not known are ignored; a flag counts whenever it is given, even as 0 or false."""
    config = Config()
    kinds = {f.name: type(getattr(config, f.name)) for f in fields(config)}
    if path and os.path.exists(path):
        with open(path, "rb") as file:
            for k, v in tomllib.load(file).items():
                if k in kinds:
                    setattr(config, k, kinds[k](v))
    parser = argparse.ArgumentParser(argument_default=argparse.SUPPRESS, allow_abbrev=False)
    for k, kind in kinds.items():
        parser.add_argument("--" + k.replace("_", "-"), dest=k, type=(lambda v: v.lower() in ("1", "t", "true")) if kind is bool else kind, **({"nargs": "?", "const": True} if kind is bool else {}))
    for k, v in vars(parser.parse_args(arguments or [])).items():
        setattr(config, k, v)
    return config

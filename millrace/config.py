"""Settings as dataclasses. Unknown keys are errors; missing ones take their defaults."""

from __future__ import annotations

from collections.abc import Mapping
from dataclasses import dataclass, field, fields, is_dataclass
from typing import Any, get_type_hints


@dataclass(frozen=True)
class Discover:
    daily_quota: int = 10_000
    search_quota: int = 6_000
    pages_per_query: int = 5
    expand_channels: bool = True
    max_uploads_per_channel: int = 2_000
    queries: tuple[str, ...] = ()
    channels: tuple[str, ...] = ()


@dataclass(frozen=True)
class Filters:
    licenses: tuple[str, ...] = ("creativeCommon",)
    min_duration_s: int = 10
    max_duration_s: int = 3_600
    skip_live: bool = True
    skip_age_restricted: bool = True
    skip_made_for_kids: bool = True


@dataclass(frozen=True)
class Plan:
    shard_size: int = 500


@dataclass(frozen=True)
class Fetch:
    bot_check_backoff_s: int = 300
    bot_check_backoff_max_s: int = 86_400
    bot_check_limit: int = 3
    error_limit: int = 20
    max_videos_per_ip_per_hour: int = 0
    provider_prices: Mapping[str, float] = field(default_factory=dict)
    video_lease_s: int = 1_800
    max_attempts: int = 3
    retry_delay_s: int = 600


@dataclass(frozen=True)
class Config:
    discover: Discover = Discover()
    filters: Filters = Filters()
    plan: Plan = Plan()
    fetch: Fetch = Fetch()


def build(kind: type, given: Mapping[str, Any] | None) -> Any:
    """A dataclass from nested mappings; ValueError names the first unknown key."""
    given = given or {}
    known = {f.name for f in fields(kind)}
    if unknown := sorted(set(given) - known):
        raise ValueError(f"{kind.__name__}: unknown key {unknown[0]!r}")
    hints = get_type_hints(kind)
    return kind(**{k: build(hints[k], v) if is_dataclass(hints[k]) else tuple(v) if isinstance(v, list) else v for k, v in given.items()})


def load(path: str | None) -> Config:
    """The settings of a YAML file; the defaults if the file is missing."""
    import os

    import yaml

    if path is None or not os.path.exists(path):
        return Config()
    with open(path, encoding="utf-8") as f:
        return build(Config, yaml.safe_load(f))

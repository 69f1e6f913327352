"""Pipeline configuration: a YAML file or mapping, keys in kebab-case or camelCase, with or without a root key."""

from __future__ import annotations

import re
import warnings
from dataclasses import dataclass, field, fields, is_dataclass
from pathlib import Path
from typing import Any, get_type_hints


@dataclass
class KafkaConfig:
    bootstrap_servers: str = ""
    raw_topic: str = ""
    output_topic: str = ""
    starting_offsets: str = "earliest"
    dead_letter_topic: str = ""
    max_offsets_per_trigger: int = 0  # 0: no limit; bounds what a micro-batch holds of one document


@dataclass
class StoreConfig:
    hosts: list = field(default_factory=list)
    index: str = ""
    username: str = ""
    password: str = ""
    connect_timeout_ms: int = 5000
    socket_timeout_ms: int = 30000


@dataclass
class JoinerConfig:
    timeout_ms: int = 30000
    join_key: str = "document"  # or document_version
    reflow_expected: str = "all_reflow_enabled"  # or triggering_only


@dataclass
class ReflowConfig:
    slice_threshold: int = 10000
    max_slices: int = 10
    fetch_batch_size: int = 1000
    sort_field: str | None = None


@dataclass
class EnricherConfig:
    name: str = ""
    consumer_group: str | None = None
    reflow_topic: str | None = None
    reflow_consumer_group: str | None = None
    class_name: str = ""
    parallelism: int = 1
    properties: dict = field(default_factory=dict)
    reflow_enabled: bool = True
    async_timeout_ms: int = 30000
    async_capacity: int = 100
    bulk_enabled: bool = False
    bulk_size: int = 10
    retry_delay_ms: int = 5000
    max_retries: int = 3
    rate_limit_per_second: float = 0.0


@dataclass
class PipelineConfig:
    mode: str = "REALTIME"
    kafka: KafkaConfig = field(default_factory=KafkaConfig)
    elasticsearch: StoreConfig = field(default_factory=StoreConfig)
    joiner: JoinerConfig = field(default_factory=JoinerConfig)
    reflow: ReflowConfig = field(default_factory=ReflowConfig)
    enrichers: list[EnricherConfig] = field(default_factory=list)
    malformed: str = "dead_letter"  # or fail
    emit_update_count: bool = False

    def names(self) -> list[str]:
        return [e.name for e in self.enrichers]

    def reflow_names(self) -> list[str]:
        return [e.name for e in self.enrichers if e.reflow_enabled]

    def validate(self) -> PipelineConfig:
        """Raises on what can't run; warns about what races."""
        if self.mode not in ("REALTIME", "OFFLINE"):
            raise ValueError(f"unknown mode {self.mode}")
        if not self.enrichers:
            raise ValueError("no enrichers")
        if len(set(self.names())) < len(self.enrichers):
            raise ValueError("two enrichers have one name")
        for e in self.enrichers:
            if self.mode == "REALTIME" and not (e.consumer_group or "").strip():
                raise ValueError(f"{e.name}: consumerGroup is required in REALTIME mode")
            if e.reflow_enabled and not (e.reflow_topic or "").strip():
                raise ValueError(f"{e.name}: reflowTopic is required for reflow")
            if e.bulk_enabled and e.bulk_size > e.async_capacity:
                raise ValueError(f"{e.name}: bulkSize exceeds asyncCapacity")
            if self.joiner.timeout_ms <= e.async_timeout_ms:
                warnings.warn(f"{e.name}: the joiner may time out before the enricher does", stacklevel=2)
        return self


def _snake(key: str) -> str:
    return re.sub(r"(?<=[a-z0-9])([A-Z])", r"_\1", key).replace("-", "_").lower()


def _build(kind: Any, data: Any) -> Any:
    if is_dataclass(kind):
        hints = get_type_hints(kind)
        given = {_snake(k): v for k, v in (data or {}).items()}
        return kind(**{f.name: _build(hints[f.name], given[f.name]) for f in fields(kind) if given.get(f.name) is not None})
    if getattr(kind, "__origin__", None) is list and is_dataclass(kind.__args__[0]):
        return [_build(kind.__args__[0], x) for x in data]
    if kind in (int, float, bool, str) and not isinstance(data, kind):
        return str(data).strip().lower() == "true" if kind is bool else kind(data)
    return data


def from_mapping(data: dict, root: str | None = None) -> PipelineConfig:
    """A configuration from a mapping; the root key is found by itself if it isn't given."""
    if root is not None:
        data = data[root]
    elif "enrichers" not in data:
        data = next((v for v in data.values() if isinstance(v, dict) and "enrichers" in v), data)
    data = {_snake(k): v for k, v in data.items()}
    if isinstance(data.get("pipeline"), dict):
        data = {**{_snake(k): v for k, v in data.pop("pipeline").items()}, **data}
    return _build(PipelineConfig, data)


def load(path: str | Path, root: str | None = None) -> PipelineConfig:
    import yaml

    return from_mapping(yaml.safe_load(Path(path).read_text()) or {}, root)

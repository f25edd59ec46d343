"""Run settings: explicit argument, then environment or Spark conf, then default."""

from __future__ import annotations

import os
from collections.abc import Callable, Mapping
from dataclasses import dataclass, fields
from typing import Any

ENV_PREFIX = "KINFOLD_"
CONF_PREFIX = "spark.kinfold."


@dataclass(frozen=True)
class Settings:
    input_path: str = "data/records.csv"
    warehouse: str = "warehouse"
    catalog: str = ""  # a DSv2 catalog name; empty publishes Parquet snapshots under `warehouse`
    namespace: str = "kinfold"
    table: str = "golden_records"
    match_threshold: float = 0.9
    seed: int = 1729
    max_sampled_pairs: int = 10_000_000
    prior_recall: float = 0.8

    def __post_init__(self) -> None:
        shares = {"match_threshold": self.match_threshold, "prior_recall": self.prior_recall}
        wrong = [f"{name} = {x} is outside (0, 1]" for name, x in shares.items() if not 0 < x <= 1]
        wrong += [f"{name} is blank" for name in ("namespace", "table") if not getattr(self, name)]
        if self.max_sampled_pairs < 1:
            wrong.append(f"max_sampled_pairs = {self.max_sampled_pairs} leaves no pair to count")
        if wrong:
            raise ValueError("; ".join(wrong))

    @classmethod
    def from_environment(cls, env: Mapping[str, str] | None = None) -> Settings:
        """Read ``KINFOLD_<NAME>`` variables; unset or empty ones keep the default."""
        env = os.environ if env is None else env
        return cls._from_text(lambda name: env.get(ENV_PREFIX + name.upper()), ENV_PREFIX)

    @classmethod
    def from_session(cls, spark: Any) -> Settings:
        """Read ``spark.kinfold.<name>`` session settings."""
        return cls._from_text(lambda name: spark.conf.get(CONF_PREFIX + name, None), CONF_PREFIX)

    @classmethod
    def _from_text(cls, lookup: Callable[[str], str | None], prefix: str) -> Settings:
        found: dict[str, Any] = {}
        for f in fields(cls):
            text = lookup(f.name)
            if text:
                try:
                    found[f.name] = type(f.default)(text)
                except ValueError as exc:
                    raise ValueError(f"cannot read {prefix}{f.name} = {text!r} as {type(f.default).__name__}") from exc
        return cls(**found)

    @classmethod
    def based_on(cls, base: Settings, **changes: Any) -> Settings:
        """``base`` with the given values; ``None`` leaves a value as it is."""
        return cls(**{f.name: getattr(base, f.name) if changes.get(f.name) is None else changes[f.name] for f in fields(cls)})

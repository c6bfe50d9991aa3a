"""Configuration and prompt templates."""

from __future__ import annotations

import json
from dataclasses import dataclass, field
from pathlib import Path

#: Other names of providers, and sampling defaults.
ALIASES = {"gemini": "google", "google_adk": "google", "claude_sdk": "claude"}
PROVIDERS = ("ollama", "claude", "google", "vllm", "openai", "anthropic")
DEFAULTS = {"temperature": 0.7, "max_tokens": 24576}


def _read(path: Path) -> dict:
    text = path.read_text(encoding="utf-8")
    if path.suffix == ".json":
        return json.loads(text)
    import yaml

    return yaml.safe_load(text) or {}


def prompts(folder: str) -> dict[str, str]:
    """Templates of a folder: a file's ``prompt`` under its stem, otherwise its text values by key."""
    root = Path(folder)
    if not root.is_dir():
        raise FileNotFoundError(folder)
    out: dict[str, str] = {}
    for path in sorted([*root.glob("*.yaml"), *root.glob("*.yml"), *root.glob("*.json")]):
        data = _read(path)
        if isinstance(data.get("prompt"), str):
            out[path.stem] = data["prompt"]
        else:
            out |= {k: v for k, v in data.items() if isinstance(v, str)}
    return out


@dataclass(frozen=True)
class ModelConfig:
    """An immutable choice of provider, model and sampling."""

    provider: str = "stub"
    model: str = "offline"
    temperature: float = DEFAULTS["temperature"]
    max_tokens: int = DEFAULTS["max_tokens"]
    options: dict = field(default_factory=dict)


def resolve(section: dict, provider: str | None = None) -> ModelConfig:
    """The given provider before the section's; only that provider's own options are merged in."""
    from ..operators.models import providers

    name = provider or section.get("provider") or "stub"
    name = ALIASES.get(name, name)
    if name not in (*PROVIDERS, *providers()):
        raise ValueError(f"unknown provider: {name}")
    merged = {k: v for k, v in section.items() if not isinstance(v, dict)} | (section.get(name) or {})
    pick = lambda k: merged[k] if merged.get(k) is not None else DEFAULTS[k]
    known = {"provider", "model", "temperature", "max_tokens"}
    return ModelConfig(name, merged.get("model", "offline"), pick("temperature"), pick("max_tokens"), {k: v for k, v in merged.items() if k not in known})


def load(path: str) -> dict:
    return _read(Path(path))

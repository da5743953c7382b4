"""Run settings from YAML (or JSON, where no YAML reader is installed), and their errors."""

from __future__ import annotations

import json
from dataclasses import dataclass, fields, replace
from pathlib import Path

from . import storage


class GranaryError(Exception):
    """Any failure that this library reports on purpose."""


class ConfigError(GranaryError):
    pass


class DatasetError(GranaryError):
    pass


class ProcessingError(GranaryError):
    pass


@dataclass(frozen=True)
class Experiment:
    # The defaults of a settings file.
    embedding_dim: int = 768
    max_length: int = 512
    query_prefix: str = ""
    doc_prefix: str = ""
    instruction_template: str = ""


@dataclass(frozen=True)
class Inference:
    # The defaults of a settings file.
    batch_size: int = 64
    device: str = "cuda"
    embedding_api_url: str = ""
    timeout: float = 30.0
    max_retries: int = 2


@dataclass(frozen=True)
class Model:
    model_id: str
    provider: str
    experiment: Experiment = Experiment()
    inference: Inference = Inference()


@dataclass(frozen=True)
class Settings:
    datasets: tuple[str, ...]
    models: tuple[Model, ...]


#: What a model may override.
MODEL_EXPERIMENT = ("query_prefix", "doc_prefix", "instruction_template")
MODEL_INFERENCE = ("batch_size",)


def _mapping(value, what: str) -> dict:
    if value is None:
        return {}
    if not isinstance(value, dict):
        raise ConfigError(f"{what} must be a mapping")
    return value


def _typed(base, values: dict, names: tuple[str, ...], what: str):
    kinds = {f.name: type(getattr(base, f.name)) for f in fields(base)}
    try:
        return replace(base, **{n: kinds[n]("" if values[n] is None and kinds[n] is str else values[n]) for n in names if n in values})
    except (TypeError, ValueError) as e:
        raise ConfigError(f"{what}: {e}") from e


def settings(raw) -> Settings:
    root = _mapping(raw, "the settings")
    experiment = _typed(Experiment(), x := _mapping(root.get("experiment"), "experiment"), tuple(f.name for f in fields(Experiment)), "experiment")
    inference = _typed(Inference(), x := _mapping(root.get("inference"), "inference"), tuple(f.name for f in fields(Inference)), "inference")
    del x
    names = root.get("datasets")
    if not isinstance(names, list) or not names or not all(isinstance(n, str) and n.strip() for n in names):
        raise ConfigError("datasets must be a list of names that aren't blank")
    listed = root.get("models")
    if not isinstance(listed, list) or not listed:
        raise ConfigError("models must be a list that isn't empty")
    models: dict[str, Model] = {}
    for m in listed:
        if not isinstance(m, dict):
            raise ConfigError("a model must be a mapping")
        key, provider = (str(m.get(n) or "").strip() for n in ("model_id", "provider"))
        if not key or not provider:
            raise ConfigError("a model needs model_id and provider")
        if key in models:
            raise ConfigError(f"model_id {key} is given twice")
        models[key] = Model(key, provider, _typed(experiment, m, MODEL_EXPERIMENT, key), _typed(inference, m, MODEL_INFERENCE, key))
    return Settings(tuple(n.strip() for n in names), tuple(models.values()))


def load(path: str | Path) -> Settings:
    p = str(path)
    if not storage.is_file(p):
        raise ConfigError(f"no settings file {p}")
    text = storage.read_text(p)
    try:
        try:
            import yaml
        except ImportError:
            return settings(json.loads(text))
        return settings(yaml.safe_load(text))
    except ConfigError:
        raise
    except Exception as e:
        raise ConfigError(f"{p}: {e}") from e

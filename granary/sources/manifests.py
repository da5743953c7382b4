"""Dataset folders described by a dataset.json. Only metadata is read here, on the driver."""

from __future__ import annotations

import json
from dataclasses import dataclass
from pathlib import Path

from .. import storage
from ..config import DatasetError


@dataclass(frozen=True)
class Dataset:
    name: str
    folder: str
    docs: str
    queries: str


def require(*paths: str | Path) -> None:
    """Fails if any path isn't there, naming all that aren't."""
    missing = [str(p) for p in paths if not storage.exists(p)]
    if missing:
        raise FileNotFoundError(f"not there: {', '.join(missing)}")


def require_inputs(dataset_root: str | Path, settings_file: str | Path) -> None:
    if not storage.is_folder(dataset_root):
        raise DatasetError(f"no folder {dataset_root}")
    if not storage.is_file(settings_file):
        raise DatasetError(f"no file {settings_file}")


def dataset(root: str | Path, name: str) -> Dataset:
    """The training part of the dataset whose folder has exactly that name."""
    folder = f"{root}/{name}"
    if name not in storage.folders(root):
        raise DatasetError(f"no dataset {name} in {root}")
    about = f"{folder}/dataset.json"
    try:
        meta = json.loads(storage.read_text(about)) if storage.is_file(about) else None
    except ValueError as e:
        raise DatasetError(f"{about}: {e}") from e
    splits = meta.get("splits") if isinstance(meta, dict) else None
    train = splits.get("train") if isinstance(splits, dict) else None
    if not isinstance(train, dict):
        raise DatasetError(f"{about} has no splits.train")
    docs = f"{folder}/{meta.get('docs_file') or train.get('docs_file') or 'train/docs.jsonl'}"
    queries = f"{folder}/{train.get('queries_file') or 'train/queries.jsonl'}"
    for p in (docs, queries):
        if not storage.exists(p):
            raise DatasetError(f"{about} names {p}, which isn't there")
    return Dataset(name, folder, docs, queries)

"""Batched text encoders as Arrow column functions.

An encoder turns a list of texts into as many vectors. It is made once per Python worker, by a factory that is sent to the
executors; batches are as large as the encoder wants, across rows. Every encoder's vectors come out at length 1."""

from __future__ import annotations

import json
import logging
import os
import urllib.request
from collections.abc import Callable
from dataclasses import dataclass
from pathlib import Path
from typing import Protocol

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


log = logging.getLogger("granary")


class Encoder(Protocol):
    def encode(self, texts: list[str], is_query: bool) -> np.ndarray: ...


Factory = Callable[[], Encoder]


class EncoderError(RuntimeError):
    """An encoder can't be built, or gave no usable answer."""


def unit_rows(vectors: np.ndarray) -> np.ndarray:
    norms = np.linalg.norm(vectors, axis=1, keepdims=True) if vectors.size else np.ones((len(vectors), 1))
    return vectors / np.where(norms == 0, 1, norms)


def checked(vectors: np.ndarray, count: int, most: int) -> np.ndarray:
    """Two dimensions, a vector per text, no more than `most` numbers each."""
    vectors = np.asarray(vectors, dtype=np.float64)
    if vectors.ndim != 2 or len(vectors) != count or vectors.shape[1] > most:
        raise EncoderError(f"{vectors.shape} vectors for {count} texts and {most} dimensions")
    return vectors


class LetterProfile:
    """The stand-in encoder, which SQL can repeat: the counts of 16 frequent letters in the lower-cased text, and a constant."""

    letters = "etaoinshrdlucmfw"

    def encode(self, texts: list[str], is_query: bool = False) -> np.ndarray:
        rows = [[float(t.count(c)) for c in self.letters] + [1.0] for t in map(str.lower, texts)]
        return np.array(rows, dtype=np.float64).reshape(len(rows), len(self.letters) + 1)


def letter_profile(text: Column) -> Column:
    """LetterProfile as a JVM expression."""
    low = F.lower(text)
    return F.array(*[F.regexp_count(low, F.lit(c)).cast("double") for c in LetterProfile.letters], F.lit(1.0))


def token_lengths(encoder: Encoder, texts: list[str]) -> list[int] | None:
    """Of each text, if the encoder has a tokenizer to tell; else None."""
    own = getattr(encoder, "token_lengths", None)
    return own(texts) if own else None


def told_lengths(lengths: list[int], limit: int, name: str) -> dict[str, float]:
    """Logs how many tokens a batch's texts have, and a warning for each from 80 % of the limit on; returns the figures."""
    n = len(lengths)
    told = {"texts": n, "least": min(lengths, default=0), "most": max(lengths, default=0), "mean": sum(lengths) / n if n else 0.0, "over_limit": sum(x > limit for x in lengths)}
    log.info("%s: tokens of %d texts: %d to %d, %.2f on average, %d over %d", name, n, told["least"], told["most"], told["mean"], told["over_limit"], limit)
    near = int(limit * 0.8)
    for i, x in enumerate(lengths):
        if 0 < near <= x:
            log.warning("%s: text %d of the batch has %d tokens, limit %d", name, i, x, limit)
    return told


def post_json(url: str, body: dict, timeout: float) -> dict:
    request = urllib.request.Request(url, json.dumps(body).encode(), {"Content-Type": "application/json"})
    with urllib.request.urlopen(request, timeout=timeout) as reply:
        return json.load(reply)


@dataclass
class HttpEncoder:
    """Posts {"chunks": texts} and takes {"vectors": ...}; a failed or unusable answer is asked for again, retries times.
    Spark's own task retries come on top, so the service must allow repeated calls."""

    url: str
    dim: int
    batch_size: int = 64
    timeout: float = 30
    retries: int = 2
    post: Callable[[str, dict, float], dict] = post_json

    def encode(self, texts: list[str], is_query: bool = False) -> np.ndarray:
        parts = [self._batch(texts[i : i + self.batch_size]) for i in range(0, len(texts), self.batch_size)]
        return np.vstack(parts) if parts else np.zeros((0, self.dim))

    def _batch(self, texts: list[str]) -> np.ndarray:
        error: Exception | None = None
        for _ in range(self.retries + 1):
            try:
                reply = self.post(self.url, {"chunks": texts}, self.timeout)
                vectors = reply.get("vectors") if isinstance(reply, dict) else None
                if not isinstance(vectors, list) or len(vectors) != len(texts):
                    raise ValueError("not a vector per text")
                return unit_rows(np.array(vectors, dtype=np.float64))
            except (OSError, ValueError) as e:
                error = e
        raise EncoderError(f"no vectors from {self.url} in {self.retries + 1} attempts") from error


@dataclass
class LocalEncoder:
    """A model of an installed library. provider: sentence_transformers or flag_embedding."""

    provider: str
    model_id: str
    device: str = "cuda"
    batch_size: int = 64
    max_length: int = 512
    loader: Callable[[str, str, str], object] | None = None

    def __post_init__(self):
        self.model = (self.loader or _load)(self.provider, self.model_id, self.device)
        limit = getattr(self.model, "max_seq_length", None)
        self.length = min(self.max_length, limit) if isinstance(limit, int) and limit > 0 else self.max_length
        if hasattr(self.model, "max_seq_length"):
            self.model.max_seq_length = self.length

    def encode(self, texts: list[str], is_query: bool = False) -> np.ndarray:
        if self.provider == "sentence_transformers" and (lengths := token_lengths(self, texts)) is not None:
            told_lengths(lengths, self.length, self.model_id)
        if self.provider == "flag_embedding":
            try:
                out = self.model.encode(texts, batch_size=self.batch_size, max_length=self.length, return_dense=True)
            except TypeError:
                out = self.model.encode(texts, batch_size=self.batch_size)
            return unit_rows(np.asarray(out["dense_vecs"] if isinstance(out, dict) else out, dtype=np.float64))
        return unit_rows(np.asarray(self.model.encode(texts, batch_size=self.batch_size), dtype=np.float64))

    def token_lengths(self, texts: list[str]) -> list[int] | None:
        """Of each text by the model's tokenizer; None without one or if it fails."""
        tokenizer = getattr(self.model, "tokenizer", None)
        if tokenizer is None:
            return None
        try:
            return [len(x) for x in tokenizer(list(texts), add_special_tokens=True, truncation=False)["input_ids"]]
        except Exception:  # noqa: BLE001 - lengths are advice, whatever a tokenizer raises
            return None


def _load(provider: str, model_id: str, device: str) -> object:
    if provider == "sentence_transformers":
        from sentence_transformers import SentenceTransformer

        return SentenceTransformer(model_id, device=device)
    if provider == "flag_embedding":
        from FlagEmbedding import BGEM3FlagModel

        return BGEM3FlagModel(model_id, use_fp16=device == "cuda", devices=device)
    raise EncoderError(f"unknown provider {provider!r}")


def factory_for(model, inference, dim: int, max_length: int) -> Factory:
    """The factory of a configured model: over HTTP if the inference settings name a service, else local."""
    if (inference.embedding_api_url or "").strip():
        return lambda: HttpEncoder(inference.embedding_api_url.strip(), dim, inference.batch_size, inference.timeout, inference.max_retries)
    if model.provider not in ("sentence_transformers", "flag_embedding"):
        raise EncoderError(f"unknown provider {model.provider!r}")
    return lambda: LocalEncoder(model.provider, model.model_id, inference.device, inference.batch_size, max_length)


_made: dict[str, Encoder] = {}


def _encoder(name: str, factory: Factory) -> Encoder:
    """One encoder a worker and name."""
    if name not in _made:
        _made[name] = factory()
    return _made[name]


def encode_texts(name: str, factory: Factory, dim: int, is_query: bool) -> Callable[[Column], Column]:
    """Column function string -> array<double>."""

    def run(column: pa.Array) -> pa.Array:
        vectors = unit_rows(checked(_encoder(name, factory).encode(column.to_pylist(), is_query), len(column), dim))
        return pa.array(list(vectors), pa.list_(pa.float64()))

    run.__annotations__ = {"column": pa.Array, "return": pa.Array}
    return F.arrow_udf(run, "array<double>")


def encode_lists(name: str, factory: Factory, dim: int) -> Callable[[Column], Column]:
    """Column function array<string> -> array<array<double>>. The lists of a batch are encoded as one list of texts, so no
    shuffle regroups a document and the encoder still gets full batches."""

    def run(column: pa.Array) -> pa.Array:
        lists = column.to_pylist()
        texts = [t for x in lists for t in x or ()]
        vectors = list(unit_rows(checked(_encoder(name, factory).encode(texts, False), len(texts), dim))) if texts else []
        out, at = [], 0
        for x in lists:
            n = len(x or ())
            out.append(vectors[at : at + n])
            at += n
        return pa.array(out, pa.list_(pa.list_(pa.float64())))

    run.__annotations__ = {"column": pa.Array, "return": pa.Array}
    return F.arrow_udf(run, "array<array<double>>")


def length_stats(df: DataFrame, length: Column, limit: int) -> DataFrame:
    """(texts, least, most, mean, over_limit, near_limit): near is from 80 % of the limit on."""
    return df.agg(
        F.count(length).alias("texts"), F.min(length).alias("least"), F.max(length).alias("most"), F.avg(length).alias("mean"),
        F.count_if(length > limit).alias("over_limit"), F.count_if(length >= limit * 0.8).alias("near_limit"),
    )


#: The environment variables that model libraries read (the names; the folders are ours).
CACHE_FOLDERS = {"HF_HOME": "shared", "HF_HUB_CACHE": "downloads", "HUGGINGFACE_HUB_CACHE": "downloads", "SENTENCE_TRANSFORMERS_HOME": "sentences"}


def model_cache(root: str | Path | None = None, env: dict | None = None) -> tuple[Path, dict[str, str]]:
    """Makes the cache folder and sets the variables that aren't set; the second value is for spark.executorEnv."""
    env = os.environ if env is None else env
    base = Path(root or env.get("GRANARY_MODEL_CACHE") or Path.home() / ".cache" / "granary" / "models").expanduser()
    for name, sub in CACHE_FOLDERS.items():
        (base / sub).mkdir(parents=True, exist_ok=True)
        env.setdefault(name, str(base / sub))
    env.setdefault("GRANARY_MODEL_CACHE", str(base))
    return base, {n: env[n] for n in CACHE_FOLDERS}



"""Encoders: deterministic projections of feature vectors and prompts, and the place for model encoders."""

from __future__ import annotations

import hashlib
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from frameloom.functions.vectors import EPSILON

#: Seeds and dimensions of the two spaces' projections. Fixed values.
SPACES = {"dinov2": (11, 384), "clip_image": (22, 512)}


def projection(space: str, width: int) -> np.ndarray:
    seed, dim = SPACES[space]
    return np.random.default_rng(seed).standard_normal((dim, width)).astype(np.float32)


def _unit(x: np.ndarray) -> np.ndarray:
    return (x / (np.linalg.norm(x, axis=1, keepdims=True) + EPSILON)).astype(np.float32)


def map_vectors(frame: DataFrame, key: str, column: str, encode: Callable[[np.ndarray], np.ndarray], out: str) -> DataFrame:
    """key and the encoded vector of each row, a batch at a time. A model encoder is given as ``encode``; rows with null vectors stay null."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            rows = b.column(1).to_pylist()
            at = [i for i, r in enumerate(rows) if r]
            done = iter(encode(np.array([rows[i] for i in at], np.float32)) if at else ())
            result = [None] * len(rows)
            for i in at:
                result[i] = next(done)
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(result, pa.list_(pa.float32()))], [key, out])

    return frame.select(F.col(key), F.col(column).cast("array<float>")).mapInArrow(run, f"{key} {frame.schema[key].dataType.simpleString()}, {out} array<float>")


def encode_features(frame: DataFrame, key: str, column: str, space: str, width: int) -> DataFrame:
    """Random projection of ``width`` features to the space's dimension, of unit length."""
    turn = projection(space, width).T
    return map_vectors(frame, key, column, lambda x: _unit(x @ turn), space)


def prompt_vector(prompt: str, dim: int = 512) -> np.ndarray:
    """A unit Gaussian vector seeded by the MD5 of the lower-case prompt; a function of the prompt alone, wherever it stands."""
    seed = int(hashlib.md5(prompt.lower().encode()).hexdigest()[:8], 16)
    return _unit(np.random.default_rng(seed).standard_normal((1, dim)))[0]


def encode_prompts(frame: DataFrame, key: str = "prompt_id", column: str = "prompt", dim: int = 512) -> DataFrame:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            vectors = [None if p is None else prompt_vector(p, dim) for p in b.column(1).to_pylist()]
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(vectors, pa.list_(pa.float32()))], [key, "clip_text"])

    return frame.select(key, column).mapInArrow(run, f"{key} {frame.schema[key].dataType.simpleString()}, clip_text array<float>")


class ProjectionEncoder:
    """The encoder that needs no model: projections of picture features, and seeded prompt vectors."""

    backend = "projection"

    def encode_images(self, frame: DataFrame, key: str, column: str, width: int) -> DataFrame:
        """key, dinov2, clip_image, backend of rows with ``width`` picture features each."""
        both = encode_features(frame, key, column, "dinov2", width).join(encode_features(frame, key, column, "clip_image", width), key)
        return both.withColumn("backend", F.lit(self.backend))

    def encode_prompts(self, frame: DataFrame, key: str = "prompt_id", column: str = "prompt") -> DataFrame:
        return encode_prompts(frame, key, column)

    def encode_text(self, text: str, dim: int = 512) -> np.ndarray:
        return prompt_vector(text, dim)


class ModelEncoder:
    """An encoder of models. ``load`` is called once a worker process and returns two functions: a batch of image rows to a pair of
    matrices (of both spaces), and a list of texts to a matrix. Rows whose image is null stay null."""

    backend = "torch"

    def __init__(self, load: Callable[[], tuple[Callable, Callable]], batch_size: int = 16):
        self.load, self.batch_size, self._models = load, batch_size, None

    def models(self) -> tuple[Callable, Callable]:
        if self._models is None:
            self._models = self.load()
        return self._models

    def __getstate__(self) -> dict:
        return {**self.__dict__, "_models": None}

    def encode_images(self, frame: DataFrame, key: str, column: str, width: int | None = None) -> DataFrame:
        """key, dinov2, clip_image, backend of rows whose ``column`` holds an image, encoded or as features."""

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            images = self.models()[0]
            for b in batches:
                rows = b.column(1).to_pylist()
                at, out = [i for i, r in enumerate(rows) if r is not None], ([None] * len(rows), [None] * len(rows))
                for lo in range(0, len(at), self.batch_size):
                    part = at[lo : lo + self.batch_size]
                    for space, matrix in zip(out, images([rows[i] for i in part])):
                        for i, v in zip(part, _unit(np.asarray(matrix, np.float32))):
                            space[i] = v
                kind = pa.list_(pa.float32())
                yield pa.RecordBatch.from_arrays([b.column(0), pa.array(out[0], kind), pa.array(out[1], kind), pa.array([self.backend] * len(rows))], [key, "dinov2", "clip_image", "backend"])

        return frame.select(key, column).mapInArrow(run, f"{key} {frame.schema[key].dataType.simpleString()}, dinov2 array<float>, clip_image array<float>, backend string")

    def encode_prompts(self, frame: DataFrame, key: str = "prompt_id", column: str = "prompt") -> DataFrame:
        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            texts = self.models()[1]
            for b in batches:
                rows = b.column(1).to_pylist()
                found = iter(_unit(np.asarray(texts([r for r in rows if r is not None]), np.float32))) if any(r is not None for r in rows) else iter(())
                yield pa.RecordBatch.from_arrays([b.column(0), pa.array([None if r is None else next(found) for r in rows], pa.list_(pa.float32()))], [key, "clip_text"])

        return frame.select(key, column).mapInArrow(run, f"{key} {frame.schema[key].dataType.simpleString()}, clip_text array<float>")

    def encode_text(self, text: str, dim: int = 512) -> np.ndarray:
        return _unit(np.asarray(self.models()[1]([text]), np.float32))[0]


def get_encoder(prefer: str = "auto", load: Callable[[], tuple[Callable, Callable]] | None = None) -> ProjectionEncoder | ModelEncoder:
    """The projection encoder, or the models that ``load`` brings. ``torch`` raises if they can't be had; ``auto`` falls back."""
    if prefer not in ("auto", "torch", "projection"):
        raise ValueError(f"unknown encoder: {prefer}")
    if prefer == "projection" or (prefer == "auto" and load is None):
        return ProjectionEncoder()
    if load is None:
        raise ImportError("no models: give load, a function that brings them")
    encoder = ModelEncoder(load)
    try:
        encoder.models()
    except Exception:
        if prefer == "torch":
            raise
        return ProjectionEncoder()
    return encoder

"""Tokenizer files: read on the driver, sent to the executors by content, built once per Python worker."""

from __future__ import annotations

import hashlib
import os
from collections.abc import Callable

from pyspark.sql import SparkSession

MAX_BYTES = 64_000_000  # vocabulary files have a few MB; refuse to broadcast anything else

_built: dict[tuple[str, str], object] = {}


def read_vocabulary(spark: SparkSession, path: str):
    """Broadcast of the file's bytes; ``path`` is a file that the driver can read."""
    if os.path.getsize(path) > MAX_BYTES:
        raise ValueError(f"{path} is larger than {MAX_BYTES} bytes")
    with open(path, "rb") as file:
        return spark.sparkContext.broadcast(file.read())


def built(kind: str, content: bytes, build: Callable[[bytes], object]):
    """``build(content)``, made once per Python worker."""
    key = (kind, hashlib.md5(content).hexdigest())
    if key not in _built:
        os.environ["TOKENIZERS_PARALLELISM"] = "false"  # Spark's tasks are the parallelism
        _built[key] = build(content)
    return _built[key]

"""What is sent to Python workers, and what they keep from one task to the next."""
from __future__ import annotations

import ctypes
import pickle
import sys
from collections.abc import Callable
from types import ModuleType

import pyarrow as pa
from pyspark import Broadcast, cloudpickle
from pyspark.sql import SparkSession

_NAME = "_docquery_worker_memory"


def remembered(key: tuple, make: Callable):
    """`make()`, once in each worker process for each key.

    Task code travels by value, so its own module globals are new in each task; a module entry
    of the process is not. Only for what a key fully determines, such as a vocabulary's encoder.
    """
    kept = sys.modules.setdefault(_NAME, ModuleType(_NAME)).__dict__
    if key not in kept:
        kept[key] = make()
    return kept[key]


def send(spark: SparkSession, value) -> Broadcast:
    """Broadcast an object together with the code of its class, which workers need no copy of."""
    return spark.sparkContext.broadcast(cloudpickle.dumps(value))


def received(sent: Broadcast):
    return pickle.loads(sent.value)


def give_back() -> None:
    """Return what a batch no longer needs to the system; a worker keeps it otherwise, also when it is idle."""
    pa.default_memory_pool().release_unused()
    trim = getattr(ctypes.CDLL(None), "malloc_trim", None)
    if trim is not None:
        trim(0)


class Recent(dict):
    """Results of `make` by key. When full, it forgets what nobody asked for since it was last full."""

    def __init__(self, most: int, make: Callable):
        super().__init__()
        self.most, self.make, self.old = most, make, {}

    def __missing__(self, key):
        value = self.recall(key)
        if value is None:
            value = self.make(key)
        if len(self) >= self.most:
            self.turn()
        self[key] = value
        return value

    def recall(self, key):
        return self.old.get(key)

    def turn(self) -> None:
        self.old = dict(self)
        self.clear()

"""Objects of fixed or checked size for every task.

They travel pickled and are opened by the task itself, when its modules can be
imported.
"""

from __future__ import annotations

import pickle
from typing import Any

from pyspark import Broadcast
from pyspark.sql import SparkSession


def send(spark: SparkSession, value: Any) -> Broadcast[bytes]:
    return spark.sparkContext.broadcast(pickle.dumps(value))


def receive(shared: Broadcast[bytes]) -> Any:
    return pickle.loads(shared.value)

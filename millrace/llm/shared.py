"""Objects sent to the workers once.

Spark pickles what it broadcasts by reference to its classes, so a worker that
has no copy of this package couldn't read it.  Here the classes go along (as
they do with functions), and each process unpacks the object once.
"""

from __future__ import annotations

import pickle

from pyspark import cloudpickle
from pyspark.sql import SparkSession

from millrace.llm.subword import per_process, put_away


def share(spark: SparkSession, value):
    """Broadcast ``value``; tasks read it with :func:`unpack`."""
    return spark.sparkContext.broadcast(cloudpickle.dumps(value))


def unpack(sent):
    """The object; a process holds one at a time of those it was sent, and no tokenizer meanwhile."""
    put_away()
    held = per_process("shared", dict)
    if sent.value is not held.get("of"):
        held.update(of=sent.value, value=pickle.loads(sent.value))
    return held["value"]


def forget() -> None:
    """Drop the object that the process holds; :func:`unpack` would unpack it again."""
    per_process("shared", dict).clear()

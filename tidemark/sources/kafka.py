"""Kafka message source: option builders for ``spark.readStream.format("kafka")``.

The threshold job reads one topic partition starting ``N`` messages before its
end.  Structured Streaming expresses that with ``assign`` and a
``startingOffsets`` JSON; progress is then kept in the query checkpoint (no
consumer-group commits).  The Kafka connector jar is not bundled here, so the
functions only build options and the reader; the transformations downstream
are tested on file sources.
"""

from __future__ import annotations

import json
from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame, SparkSession

from tidemark.sources.records import project_record


def tail_start_offset(end_offset: int, tail_n: int, log_start: int = 0) -> int:
    """First offset of the last ``tail_n`` messages, never before the log start."""
    if tail_n < 0:
        raise ValueError("tail_n must be >= 0")
    return max(end_offset - tail_n, log_start)


def kafka_options(
    brokers: str,
    topic: str,
    partition: int | Sequence[int] | None = 0,
    start_offset: int | Mapping[int, int] | None = None,
    extra: Mapping[str, str] | None = None,
) -> dict[str, str]:
    """Reader options for one partition, several, or all of a topic (``partition=None``).

    ``start_offset`` is an offset for the one partition, or a mapping from
    partition to offset; partitions without one start at ``latest``.  Expired
    offsets fail the query (Spark's default): an incomplete result is not silent.
    """
    opts = {"kafka.bootstrap.servers": brokers, "includeHeaders": "false"}
    if partition is None:
        opts["subscribe"] = topic
        known = dict(start_offset or {})
    else:
        assigned = [partition] if isinstance(partition, int) else list(partition)
        opts["assign"] = json.dumps({topic: assigned})
        if isinstance(start_offset, int):
            if len(assigned) != 1:
                raise ValueError("one start offset needs one partition; give a mapping")
            start_offset = {assigned[0]: start_offset}
        # in a JSON of offsets, -1 is latest
        known = {p: (start_offset or {}).get(p, -1) for p in assigned} if start_offset else {}
    opts["startingOffsets"] = json.dumps({topic: {str(p): int(o) for p, o in known.items()}}) if known else "latest"
    if extra:
        opts.update(extra)
    return opts


#: Newest message first when several partitions are read: offsets only order one partition.
MESSAGE_ORDER = ("timestamp", "partition", "offset")


def kafka_stream(spark: SparkSession, options: Mapping[str, str]) -> DataFrame:
    """Streaming ``(key, value, offset, timestamp, partition)`` rows from Kafka (needs the
    Kafka connector); ``timestamp`` is the message time, i.e. arrival time.  With
    several partitions, order rows by :data:`MESSAGE_ORDER`."""
    raw = spark.readStream.format("kafka").options(**options).load()
    return project_record(raw, extra=("timestamp", "partition"))

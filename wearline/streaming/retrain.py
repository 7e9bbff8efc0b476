"""Retrain triggers with a cooldown, as a batch over a trigger table and as a stream."""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.streaming.state import GroupState, GroupStateTimeout

COOLDOWN_SECONDS = 30


def accepted_triggers(triggers: DataFrame, key: str = "model_key", ts: str = "ts", cooldown_s: float = COOLDOWN_SECONDS,
                      duration_s: float = 0.0) -> DataFrame:
    """Triggers that start a run: those at least the cooldown after the end of the last accepted one.

    A pause as long as the cooldown always ends with an accepted trigger, so the triggers between two
    such pauses form a chain that does not depend on any other. Chains are found on a table of
    occupied cooldown-long intervals, whose size depends on the calendar and not on the number of
    triggers, and are then folded in parallel, streaming through each task in time order.
    """
    rest = round((cooldown_s + duration_s) * 1_000_000)
    if rest <= 0:
        return triggers.select(key, ts).distinct()
    at = triggers.select(key, F.unix_micros(F.col(ts).cast("timestamp")).alias("us")).distinct()
    at = at.withColumn("_slot", F.floor(F.col("us") / F.lit(rest)))
    slots = at.groupBy(key, "_slot").agg(F.min("us").alias("_first"), F.max("us").alias("_last"))
    w = Window.partitionBy(key).orderBy("_slot")
    pause = F.col("_first") - F.lag("_last").over(w)
    slots = slots.withColumn("_head", F.when(F.coalesce(pause >= rest, F.lit(True)), F.col("_slot")))
    chains = slots.select(key, "_slot", F.last("_head", ignorenulls=True).over(w).alias("_chain"))
    rows = (at.join(chains, [key, "_slot"]).select(key, "_chain", "us")
            .repartition(key, "_chain").sortWithinPartitions(key, "_chain", "us"))
    kept = rows.mapInPandas(lambda batches: _fold(batches, key, rest), rows.schema)
    return kept.select(key, F.timestamp_micros("us").alias(ts))


def _fold(batches: Iterator[pd.DataFrame], key: str, rest: int) -> Iterator[pd.DataFrame]:
    """Keep the first trigger of a chain and each one `rest` after the last kept; input is in chain order."""
    chain, ready = None, 0
    for batch in batches:
        keep = []
        for k, c, us in zip(batch[key].array, batch["_chain"].array, batch["us"].array):
            if (k, c) != chain:
                chain, ready = (k, c), us
            keep.append(us >= ready)
            if us >= ready:
                ready = us + rest
        yield batch[keep]


def accepted_triggers_stream(triggers: DataFrame, key: str = "model_key", ts: str = "ts",
                             cooldown_s: float = COOLDOWN_SECONDS, duration_s: float = 0.0) -> DataFrame:
    """The same gate on a stream: the state of a key is the time of its last accepted trigger.

    Triggers are taken in time order within a micro-batch and in arrival order between batches.
    """
    rest = round((cooldown_s + duration_s) * 1_000_000)

    def gate(group: tuple, frames: Iterator[pd.DataFrame], state: GroupState) -> Iterator[pd.DataFrame]:
        ready = state.get[0] if state.exists else None
        times = sorted({int(t) for f in frames for t in f["us"]})
        kept = []
        for us in times:
            if ready is None or us >= ready:
                kept.append(us)
                ready = us + rest
        if ready is not None:
            state.update((ready,))
        yield pd.DataFrame({key: [group[0]] * len(kept), "us": kept})

    rows = triggers.select(key, F.unix_micros(F.col(ts).cast("timestamp")).alias("us"))
    out = rows.groupBy(key).applyInPandasWithState(
        gate, f"{key} string, us bigint", "ready bigint", "append", GroupStateTimeout.NoTimeout)
    return out.select(key, F.timestamp_micros("us").alias(ts))

"""Records that are delivered again in a later batch of a stream."""

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming.state import GroupStateTimeout

# offsets of one group: a topic-partition is spread over as many groups as it has such blocks
BLOCK_OFFSETS = 1 << 16
_INTERVALS = "starts array<long>, ends array<long>"


def inside(starts: np.ndarray, ends: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """Whether each offset lies in one of some closed intervals, which are sorted and apart."""
    if not len(starts):
        return np.zeros(len(offsets), bool)
    place = np.searchsorted(starts, offsets, side="right") - 1
    return (place >= 0) & (offsets <= ends[np.maximum(place, 0)])


def with_offsets(starts: np.ndarray, ends: np.ndarray, offsets: np.ndarray):
    """Intervals that hold some more offsets, joined where they touch."""
    first = np.concatenate([starts, offsets])
    last = np.concatenate([ends, offsets])[np.argsort(first, kind="stable")]
    first, reach = np.sort(first), np.maximum.accumulate(last)
    heads = np.flatnonzero(np.append(True, first[1:] > reach[:-1] + 1)) if len(first) else np.zeros(0, int)
    return first[heads], reach[np.append(heads[1:], len(first))[: len(heads)] - 1]


def first_deliveries(records: DataFrame, block: int = BLOCK_OFFSETS) -> DataFrame:
    """A stream of records without those of an offset that was delivered before.

    The state of a block of offsets is the set of those seen, as intervals, in the query's
    checkpoint: one interval for a block that arrived whole, whatever its number of records.
    Of copies within a micro-batch, one arrives. Records without an offset all pass.
    """
    columns = records.columns

    def keep(key, frames, state):
        starts, ends = (np.array(x, np.int64) for x in (state.get if state.exists else ([], [])))
        for frame in frames:
            if key[2] is None:
                yield frame[columns]
                continue
            frame = frame.drop_duplicates("offset")
            offsets = frame["offset"].to_numpy(np.int64)
            fresh = frame[~inside(starts, ends, offsets)]
            starts, ends = with_offsets(starts, ends, np.sort(offsets))
            if len(fresh):
                yield fresh[columns]
        state.update((starts.tolist(), ends.tolist()))

    keyed = records.withColumn("_block", F.expr(f"offset div {block}"))
    return keyed.groupBy("topic", "partition", "_block").applyInPandasWithState(
        keep, records.schema, _INTERVALS, "append", GroupStateTimeout.NoTimeout
    )

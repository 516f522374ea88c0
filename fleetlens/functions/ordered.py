"""Ordered passes over a keyed series with constant memory."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import pandas as pd
from pyspark.sql import DataFrame


def ordered_scan(
    df: DataFrame,
    keys: list[str],
    order: list[str],
    columns: list[str],
    new_state: Callable[[], object],
    step: Callable[[object, tuple], tuple],
    outputs: dict[str, str],
) -> DataFrame:
    """Run ``step(state, row)`` down each series and append its outputs.

    Series are hash-partitioned and sorted by Spark; Arrow batches then stream
    through one pass that keeps a single small state, so a long series is never
    held in memory. ``columns`` are the inputs handed to ``step``.
    """
    types = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in df.schema.fields)
    schema = types + "".join(f", `{name}` {kind}" for name, kind in outputs.items())
    names = list(outputs)

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        current, state = None, None
        for batch in batches:
            results = []
            for key, row in zip(
                zip(*[batch[k].tolist() for k in keys]), zip(*[batch[c].tolist() for c in columns])
            ):
                if key != current:
                    current, state = key, new_state()
                results.append(step(state, row))
            out = pd.DataFrame(results, columns=names, index=batch.index, dtype=object)
            yield pd.concat([batch, out], axis=1)

    return df.repartition(*keys).sortWithinPartitions(*keys, *order).mapInPandas(run, schema)

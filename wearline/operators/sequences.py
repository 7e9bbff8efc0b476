"""Fixed-length windows of past rows, and blends of two prediction columns."""

from __future__ import annotations

from collections.abc import Callable, Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, WindowSpec
from pyspark.sql import functions as F
from pyspark.sql import types as T

from wearline.operators.series import SeriesLayout, add_windows, plan_series
from wearline.spec import SPEC, TelemetrySpec

#: Windows that are copied at a time: some megabytes of a batch.
STEP_ROWS = 256
_POSITION = "_position"


def sequence_windows(df: DataFrame, columns: Sequence[str], length: int = 50, padding: float = 0.0,
                     spec: TelemetrySpec = SPEC, layout: SeriesLayout | None = None) -> DataFrame:
    """`sequence`: the last `length` rows as arrays of `columns`, padded in front for early rows."""
    layout = layout or plan_series(df, spec.keys, spec.order)
    return add_windows(df, layout, length - 1, _past(tuple(columns), length, float(padding)))


def _past(columns: tuple[str, ...], length: int, padding: float) -> Callable[[DataFrame, WindowSpec], DataFrame]:
    """The windows, as a build step of `add_windows`: Spark deals and sorts the series and numbers their rows, and the
    steps are copied batch by batch instead of being listed anew for every row."""
    def build(rows: DataFrame, w: WindowSpec) -> DataFrame:
        kept = rows.columns
        schema = T.StructType(rows.schema.fields + [T.StructField("sequence", T.ArrayType(T.ArrayType(T.DoubleType())))])

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            cells, missing = np.zeros((length - 1, len(columns))), np.zeros((length - 1, len(columns)), dtype=bool)
            for batch in batches:
                own = [batch.column(c).cast(pa.float64()) for c in columns]
                before = len(cells) - length + 1
                cells = np.concatenate([cells[before:], np.column_stack([c.to_numpy(zero_copy_only=False) for c in own])])
                missing = np.concatenate([missing[before:], np.column_stack(
                    [c.is_null().to_numpy(zero_copy_only=False) for c in own])])
                at = batch.column(_POSITION).to_numpy()
                for a in range(0, len(at), STEP_ROWS):
                    part = at[a:a + STEP_ROWS]
                    steps = np.arange(length) + np.arange(a, a + len(part))[:, None]
                    blank = np.arange(length) < length - part[:, None]
                    yield pa.RecordBatch.from_arrays(
                        [*(batch.column(k).slice(a, len(part)) for k in kept), _nested(cells, missing, steps, blank, padding)],
                        names=[*kept, "sequence"])

        return rows.withColumn(_POSITION, F.row_number().over(w)).mapInArrow(run, schema)

    return build


def _nested(cells: np.ndarray, missing: np.ndarray, steps: np.ndarray, blank: np.ndarray, padding: float) -> pa.Array:
    """Per row of `steps` the rows of `cells` it names, padded where `blank`; NULL stays NULL and NaN stays NaN."""
    values = cells[steps]
    values[blank] = padding
    none = missing[steps] & ~blank[..., None] if missing.any() else None
    flat = pa.array(values.ravel(), mask=None if none is None else none.ravel())
    n, length, width = values.shape
    rows = pa.ListArray.from_arrays(np.arange(0, n * length * width + 1, width, dtype=np.int32), flat)
    return pa.ListArray.from_arrays(np.arange(0, n * length + 1, length, dtype=np.int32), rows)


def weighted_blend(df: DataFrame, first: str, second: str, actual: str, steps: int = 20) -> DataFrame:
    """RMSE of w * first + (1 - w) * second for w = 0, 1/steps, ... 1, in one pass over the rows."""
    weights = [i / steps for i in range(steps + 1)]

    def error(w: float):
        e = F.col(actual) - (F.lit(w) * F.col(first) + F.lit(1 - w) * F.col(second))
        return F.sqrt(F.avg(e * e))

    grid = F.array(*[F.struct(F.lit(w).alias("weight"), error(w).alias("rmse")) for w in weights])
    return df.agg(grid.alias("_g")).select(F.explode("_g").alias("_r")).select("_r.*")


def best_blend(grid: DataFrame) -> DataFrame:
    """The weight of least error."""
    return grid.orderBy("rmse", "weight").limit(1)

"""Train/eval assignment."""

from __future__ import annotations

import sys
from collections.abc import Iterator, Sequence

import numpy as np
import pandas as pd
from pyspark import cloudpickle
from pyspark.sql import Column, DataFrame, functions as F

from millrace.config import DatasetOptions
from millrace.functions import twister
from millrace.operators.positions import with_positions

TRAIN, EVAL = "train", "eval"
_DRAW_BITS = 52
# A gap of so many draws costs less than a jump.
_DRAWN_THROUGH = 1 << 20


def hash_split(options: DatasetOptions, chunk_hash: str = "chunk_hash") -> Column:
    """Split as a function of seed and chunk text: 52 bits of a seeded SHA-1 as the draw.

    It needs no order, so it is the same under any partitioning and after any retry.
    """
    seeded = F.sha1(F.concat(F.lit(f"{options.seed}:"), F.col(chunk_hash)).cast("binary"))
    draw = F.conv(F.substring(seeded, 1, _DRAW_BITS // 4), 16, 10).cast("bigint")
    bound = F.lit(int(options.train_ratio * (1 << _DRAW_BITS))).cast("bigint")
    return F.when(draw < bound, TRAIN).otherwise(EVAL)


def sequence_split(
    keys: DataFrame, order: Sequence[str], options: DatasetOptions
) -> DataFrame:
    """Split by the n-th Mersenne Twister draw for the n-th row in ``order``.

    ``keys`` should be narrow. A task jumps to the draw of its first row, and again where its
    rows leave a gap too wide to draw through; then it draws once per row. The driver does
    nothing per row.
    """
    placed = with_positions(keys, [], order).drop("group_size")
    seed, ratio, polynomial = options.seed, options.train_ratio, twister.characteristic()

    def assign(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        generator, reached = twister.seeded(seed), 0
        for batch in batches:
            at = batch.pop("position").to_numpy()
            draws = np.empty(len(at))
            bounds = [0, *(np.flatnonzero(np.diff(at) != 1) + 1), len(at)]
            for begin, end in zip(bounds[:-1], bounds[1:]):
                if begin == end:
                    continue
                first = int(at[begin])
                if 0 <= first - reached <= _DRAWN_THROUGH:
                    generator.random_sample(first - reached)
                else:
                    generator = twister.at_draw(seed, first, polynomial)
                draws[begin:end] = generator.random_sample(end - begin)
                reached = first + end - begin
            yield batch.assign(split=np.where(draws < ratio, TRAIN, EVAL))

    fields = [f"`{f.name}` {f.dataType.simpleString()}" for f in keys.schema.fields]
    return placed.sortWithinPartitions("position").mapInPandas(
        assign, ", ".join([*fields, "split string"])
    )


# Task functions travel with the job, so executors need no copy of this package.
cloudpickle.register_pickle_by_value(sys.modules[__name__])

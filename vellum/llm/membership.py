"""Exact membership of keys without moving the rows that are asked about.

A Bloom table of the members lets some other keys through.  These are found
once, among all keys that can be asked for, and get a table of their own, which
lets some members through, and so on, until none is let through wrongly.  Every
table has a fixed size; where one is so full that this comes to no end, there is
no answer, and callers join.
"""

from __future__ import annotations

from collections.abc import Callable

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from . import vec
from .shared import Scratch

#: Most tables of a cascade, 8 MB each.
LEVELS, BITS = 8, 26


def _salted(h: np.ndarray, level: int) -> np.ndarray:
    """Hashes of a level's own: what one table lets through must not fill the next one's same places."""
    return vec.mix(h, 50 + level)


class Cascade:
    def __init__(self, levels: list[vec.Bloom]):
        self.levels = levels

    def has(self, h: np.ndarray) -> np.ndarray:
        """Of hashes of keys that the cascade was made for, which are members."""
        out, some = np.zeros(len(h), bool), np.arange(len(h))
        for k, level in enumerate(self.levels):
            some = some[level.has(_salted(h[some], k))]
            out[some] = k % 2 == 0
        return out


def cascade(members: DataFrame, every: DataFrame, hashed: Callable[..., np.ndarray], scratch: Scratch, bits: int = BITS) -> Cascade | None:
    """A cascade for the keys ``every``, of which ``members`` are some; both have the same columns, without nulls, which ``hashed`` takes as arrays."""

    keys, levels = every.columns, []
    inside, outside = members.select(keys), every
    while len(levels) < LEVELS:
        own = lambda *c, k=len(levels): _salted(hashed(*c), k)
        bloom = vec.bloom_of(inside, keys, bits, own)
        levels.append(bloom)

        def passing(batches, bloom=bloom, own=own):
            for batch in batches:
                yield batch.filter(pa.array(bloom.has(own(*(c.to_numpy() for c in batch.columns)))))

        through = outside.mapInArrow(passing, outside.schema)
        if len(levels) == 1:
            through = through.join(members.select(keys), keys, "left_anti")
        through = scratch.table(through, "cascade")
        if through.isEmpty():
            return Cascade(levels)
        inside, outside = through, inside
    return None

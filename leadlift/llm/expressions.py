"""Column helpers shared by the operators that run on DataFrame functions alone."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column
from pyspark.sql import functions as F

# Prefix values are combined within blocks of this many entries and over blocks
BLOCK = 128


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body(value)`` with the value computed once, also where the body uses it for every element of an array."""
    return F.get(F.transform(F.array(value), body), F.lit(0))


def running(values: Column, zero: Column, merge: Callable[[Column, Column], Column]) -> Column:
    """For each entry, the entries before it merged; work grows with the length times ``BLOCK``, not its square."""

    def merged(part: Column) -> Column:
        return F.aggregate(part, zero, merge)

    def per_block(v: Column) -> Column:
        last = F.floor((F.size(v) - 1) / BLOCK).cast("int")
        return F.transform(F.sequence(F.lit(0), last), lambda b: merged(F.slice(v, b * BLOCK + 1, F.lit(BLOCK))))

    def before_blocks(blocks: Column) -> Column:
        return F.transform(blocks, lambda _, b: merged(F.slice(blocks, F.lit(1), b)))

    def place(v: Column, before: Column) -> Column:
        return F.transform(
            v,
            lambda _, i: merge(
                F.get(before, F.floor(i / BLOCK).cast("int")),
                merged(F.slice(v, F.floor(i / BLOCK).cast("int") * BLOCK + 1, i % BLOCK)),
            ),
        )

    return let(
        values,
        lambda v: F.when(F.size(v) > 0, let(per_block(v), lambda b: let(before_blocks(b), lambda p: place(v, p)))).otherwise(
            v
        ),
    )

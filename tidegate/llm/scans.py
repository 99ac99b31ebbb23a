"""Running values of an array inside one row, by SQL functions, at a cost that grows with the array's length.

A fold that appends copies what it has so far. So an array is cut into blocks of ``BLOCK`` elements: one fold appends
within a block, another one appends whole blocks. Expressions are kept small, as plans of nested lambdas are slow to make. Long texts are likewise cut into chunks of ``CHUNK`` characters, so
that a piece of one is found without counting from its start.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column
from pyspark.sql import functions as F

BLOCK = 256
CHUNK = 512


def let(value: Column, use: Callable[[Column], Column]) -> Column:
    """``use`` of a value that is made once."""
    return F.get(F.transform(F.array(value), use), F.lit(0))


def elements_of(values: Column, first: Column, last: Column) -> Column:
    """The elements from ``first`` to ``last`` (from 0); unlike ``slice`` it does not copy the array to cut it."""
    return F.transform(F.sequence(first, last), lambda i: F.get(values, i))


def running(values: Column, zero: Column, merge: Callable[[Column, Column], Column]) -> Column:
    """What the elements before each one come to; ``zero`` is neutral. ``values`` has to be a column or bound by ``let``."""
    none = F.slice(F.array(zero), 1, 0).alias("out")

    def add(state: Column, element: Column) -> Column:
        out = F.concat(state["out"], F.array(state["at"]))
        return F.struct(merge(state["at"], element).alias("at"), out.alias("out"))

    def block(done: Column, k: Column) -> Column:
        start = F.struct(F.element_at(done, -1)["at"].alias("at"), none)
        return F.concat(done, F.array(F.aggregate(F.slice(values, k * BLOCK + 1, BLOCK), start, add)))

    blocks = F.sequence(F.lit(0), F.floor(F.size(values) / BLOCK).cast("int"))
    first = F.array(F.struct(zero.alias("at"), none))
    return F.aggregate(blocks, first, block, lambda done: F.flatten(F.transform(done, lambda x: x["out"])))


def chunks_of(text: Column) -> Column:
    """The text in pieces of ``CHUNK`` characters."""
    return F.regexp_extract_all(text, F.lit(f"(?s).{{1,{CHUNK}}}"), F.lit(0))


def part_of(chunks: Column, start: Column, stop: Column) -> Column:
    """Characters from ``start`` to before ``stop`` (empty if none), from the chunks around them."""
    first = F.floor(F.greatest(start, F.lit(0)) / CHUNK).cast("int")
    last = F.greatest(F.floor((stop - 1) / CHUNK).cast("int"), first)
    around = F.array_join(elements_of(chunks, first, last), "")
    return F.when(stop > start, F.substring(around, start - first * CHUNK + 1, stop - start)).otherwise("")

"""Pairs of boxes that meet, worked out block by block.

Both sides are laid over coarse cells.  The rows of a cell are put together to blocks of a
bounded number of rows, blocks of one cell meet by an equality join, and one pair of blocks is compared at a time as
arrays.  So no row is copied for each row it might meet, and memory is that of two blocks, whatever a cell holds.
Date ranges are laid in blocks of one scope and about one length, which are written once and read where they meet.
"""

import uuid
from collections.abc import Callable, Iterator, Sequence
from functools import lru_cache

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyarrow import fs
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from skyloom.operators.scale import USUAL_TOKENS, copied, interval_pairs
from skyloom.session import checkpointed, scratch

MOST_IN_BLOCK = 4096
AT_ONCE = 1 << 19  # pairs of rows that are compared, and given out, in one piece
RUNS_AT_ONCE = 1 << 15  # pairs of date ranges in one row of runs, as Spark holds all rows that come from one; a run is no longer than a block
BYTES_AT_ONCE = 4 << 20  # of rows of runs that are given out in one piece, beside the last
BATCHES_HELD = 16  # that a task keeps of those it has read

Columns = dict[str, np.ndarray]
Test = Callable[[Columns, Columns], np.ndarray]  # columns of the left rows as (n, 1), of the right ones as (m,)


def blocks(df: DataFrame, on: Sequence[str], name: str, most: int | None = None) -> DataFrame:
    """The rows of each value of ``on`` as lists of about ``most``, under ``name``."""
    slices = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    most = most or MOST_IN_BLOCK
    columns = [c for c in df.columns if c not in on]
    counted = df.groupBy(*on).agg(F.count(F.lit(1)).alias("_n"))
    part = F.pmod(F.xxhash64(*columns, F.lit("block")), F.ceil(F.col("_n") / most)).cast("int")
    placed = df.join(counted, list(on)).withColumn("_part", part)
    listed = placed.repartition(slices, *on, "_part").groupBy(*on, "_part").agg(F.collect_list(F.struct(*columns)).alias(name))
    return listed.withColumnRenamed("_part", f"{name}_part")


def meetings(
    left: DataFrame,
    right: DataFrame,
    on: Sequence[str],
    test: Test,
    columns: Sequence[str],
    at_most: tuple[str, int] | None = None,
    counted: str | None = None,
    least: str | None = None,
    along: tuple[str, str, str] | None = None,
) -> DataFrame:
    """Pairs of rows that agree on ``on`` and pass ``test``; ``columns`` of both sides, whose names differ.

    With ``at_most``, a column of the right side and a number, a row of the left side comes with so many pairs of
    each block of the right side, the first ones by that column.  With ``counted`` it comes once for each
    such block that it meets, with the number of its pairs, and their smallest value of the column ``least`` of the right side.
    ``along`` names two numbers of a left row and one of a right row, which ``test`` has between them: rows of a block that lie
    outside of them are not compared.
    """
    ours = [c for c in left.columns if c in columns]
    theirs = [c for c in right.columns if c in columns]
    types = {f.name: f.dataType for side in (left, right) for f in side.schema}
    theirs = [c for c in theirs if not counted or c == least]
    out = [T.StructField(c, types[c]) for c in ours + theirs]
    schema = T.StructType(out + ([T.StructField(counted, T.LongType())] if counted else []))
    dealt = _dealt(blocks(left, on, "_lefts"), blocks(right, on, "_rights"), on)

    def compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in range(batch.num_rows):
                a, b = (_rows(batch.column(c).slice(row, 1)) for c in ("_lefts", "_rights"))
                if at_most is not None or least is not None:
                    b = b.sort_by(least or at_most[0])
                yield from _compared(a, b, test, ours, theirs, at_most and at_most[1], counted, along)

    return dealt.select("_lefts", "_rights").mapInArrow(compare, schema)


def listed(
    left: DataFrame, right: DataFrame, on: Sequence[str], test: Test, one: str, value: str, name: str, most: int
) -> DataFrame:
    """For each row of ``left`` the list, under ``name``, of what passes ``test`` among the rows of ``right`` that agree on ``on``.

    Gives the column ``one`` of the left row and ``value`` of the right rows, in the order of all columns of ``right``; rows that
    meet nothing are left out.  ``right`` has at most ``most`` rows for each value of ``on``, which are compared as one
    block.  So a list is made where its row is, and neither pairs nor lists are shuffled.
    """
    types = {f.name: f.dataType for side in (left, right) for f in side.schema}
    schema = T.StructType([T.StructField(one, types[one]), T.StructField(name, T.ArrayType(types[value]))])
    rights = blocks(right, on, "_rights", most).withColumn("_rights", F.array_sort("_rights"))
    dealt = _dealt(blocks(left, on, "_lefts"), rights, on)

    def compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in range(batch.num_rows):
                a, b = (_rows(batch.column(c).slice(row, 1)) for c in ("_lefts", "_rights"))
                for some, met, _ in _tested(a, b, test):
                    n = met.sum(axis=1)
                    ends = np.concatenate([[0], np.cumsum(n[n > 0])])
                    values = b.column(value).take(pa.array(np.nonzero(met)[1]))
                    arrays = [some.column(one).take(pa.array(np.flatnonzero(n))), pa.ListArray.from_arrays(pa.array(ends, pa.int32()), values)]
                    if len(arrays[0]):
                        yield pa.RecordBatch.from_arrays(arrays, names=[one, name])

    return dealt.select("_lefts", "_rights").mapInArrow(compare, schema)


def _dealt(lefts: DataFrame, rights: DataFrame, on: Sequence[str]) -> DataFrame:
    """Pairs of blocks.  One is a piece of work of millions of comparisons, so they are dealt by number, not by bytes."""
    slices = int(lefts.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    joined = copied(lefts, USUAL_TOKENS).join(copied(rights, USUAL_TOKENS), list(on))
    return joined.repartition(slices, *on, "_lefts_part", "_rights_part")


def _rows(lists: pa.Array) -> pa.RecordBatch:
    return pa.RecordBatch.from_struct_array(lists.flatten())


def _numbers(rows: pa.RecordBatch) -> Columns:
    return {n: c.to_numpy(zero_copy_only=False) for n, c in zip(rows.schema.names, rows.columns) if pa.types.is_primitive(c.type)}


def _tested(
    a: pa.RecordBatch, b: pa.RecordBatch, test: Test, along: tuple[str, str, str] | None = None
) -> Iterator[tuple[pa.RecordBatch, np.ndarray, np.ndarray]]:
    """Some left rows at a time, the right rows that each of them meets, and which right rows were looked at."""
    if along is not None:
        a = a.sort_by(along[0])
    left, right = _numbers(a), _numbers(b)
    at = np.arange(b.num_rows)
    by_place = np.argsort(right[along[2]]) if along is not None else at
    step = max(1, AT_ONCE // max(1, b.num_rows))
    for low in range(0, a.num_rows, step):
        ours = {k: v[low : low + step, None] for k, v in left.items()}
        theirs = right
        if along is not None:
            ends = np.fmin.reduce(ours[along[0]], axis=None), np.fmax.reduce(ours[along[1]], axis=None)
            first = np.searchsorted(right[along[2]], ends[0], "left", by_place)
            last = np.searchsorted(right[along[2]], ends[1], "right", by_place)
            at = np.sort(by_place[first:last])
            theirs = {k: v[at] for k, v in right.items()}
        if len(at):
            yield a.slice(low, step), test(ours, theirs), at


def _compared(
    a: pa.RecordBatch, b: pa.RecordBatch, test: Test, ours: list, theirs: list, at_most: int | None, counted: str | None,
    along: tuple[str, str, str] | None,
) -> Iterator[pa.RecordBatch]:
    for some, met, at in _tested(a, b, test, along):
        if counted:
            n = met.sum(axis=1)
            i = np.flatnonzero(n)
            arrays = [some.column(c).take(pa.array(i)) for c in ours]
            arrays += [b.column(c).take(pa.array(at[met[i].argmax(axis=1)])) for c in theirs]  # sorted, so the first one is the smallest
            arrays.append(pa.array(n[n > 0], pa.int64()))
            names = [*ours, *theirs, counted]
        else:
            if at_most is not None:
                met &= met.cumsum(axis=1, dtype=np.int32) <= at_most
            i, j = np.nonzero(met)
            i, j = pa.array(i), pa.array(at[j])
            arrays = [some.column(c).take(i) for c in ours] + [b.column(c).take(j) for c in theirs]
            names = [*ours, *theirs]
        if len(arrays[0]):
            yield pa.RecordBatch.from_arrays(arrays, names=names)


def overlapping(
    left: DataFrame, right: DataFrame, scope: Sequence[str], left_range: tuple[str, str], right_range: tuple[str, str]
) -> DataFrame:
    """Pairs of rows whose date ranges, both ends included, overlap; a range without days meets nothing.

    Gives the columns of ``left``, with its range cut to the common days, and those of ``right`` without its range.  The rows of a
    scope (plain columns) whose ranges are about as long lie in blocks by their start.  Rows are written once, into files in the
    shared folder; blocks whose days overlap as a whole meet by :func:`interval_pairs`, as their places only, and a task reads two blocks at a
    time.  In these every pair is found by its place in the order of starts, so no pair is compared that does not overlap.  Pairs
    leave Python as runs of places beside the rows they are of, and are made into rows only after that.
    """
    folder = scratch(left.sparkSession, "ranges")
    asked = _laid(left, scope, left_range, folder, "_l")
    allowed = _laid(right, scope, right_range, folder, "_r")
    met = interval_pairs(asked, allowed, scope, ("_l_low", "_l_high"), ("_r_low", "_r_high"), ["_l_path", "_l_at", "_l_start"])
    slices = 4 * int(left.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    places = [f"{side}_{part}" for side in ("_l", "_r") for part in ("path", "at", "start", "stop")]
    dealt = met.select(places).repartition(slices, "_l_path", "_l_at", "_r_path").sortWithinPartitions(*places)
    rest = [[c for c in df.columns if c not in scope and c not in ends] for df, ends in ((left, left_range), (right, right_range))]
    columns = [["_first", "_last", *names] for names in rest]
    types = {f.name: f.dataType for f in (*right.schema, *left.schema)} | {c: T.IntegerType() for c in ("_first", "_last")}
    lists = [T.StructField(name, T.ArrayType(T.IntegerType())) for name in ("_outer", "_low", "_high")]
    lists += [T.StructField(f"_{side}{c}", T.ArrayType(types[c])) for side, names in zip("lr", columns, strict=True) for c in names]
    schema = T.StructType([left.schema[c] for c in scope] + [T.StructField("_begins", T.BooleanType()), *lists])
    most = RUNS_AT_ONCE

    def compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        store, _ = fs.FileSystem.from_uri(folder)

        @lru_cache(BATCHES_HELD)
        def read(path: str, at: int) -> pa.RecordBatch:
            with store.open_input_file(path) as file:
                return pa.ipc.open_file(file).get_batch(at)

        held, size = [], 0
        for batch in batches:
            for place in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                sides = [read(*place[k : k + 2]).slice(place[k + 2], place[k + 3] - place[k + 2]) for k in (0, 4)]
                days = ({c: side.column(c).to_numpy() for c in ("_first", "_last")} for side in sides)
                for begins, outer, low, high in _overlaps(*days, most):
                    starts, ends = (int(outer[0]), int(low.min())), (int(outer[-1]) + 1, int(high.max()))
                    parts = [side.slice(starts[k], ends[k] - starts[k]) for side, k in zip(sides, (0, 1) if begins else (1, 0), strict=True)]
                    arrays = [sides[0].column(c).slice(0, 1) for c in scope] + [pa.array([begins])]
                    arrays += [_one(pa.array(x, pa.int32())) for x in (outer - starts[0], low - starts[1], high - starts[1])]
                    arrays += [_one(part.column(c)) for part, names in zip(parts, columns, strict=True) for c in names]
                    held.append(pa.RecordBatch.from_arrays(arrays, names=schema.names))
                    size += held[-1].nbytes
                    if size >= BYTES_AT_ONCE:
                        yield from pa.Table.from_batches(held).combine_chunks().to_batches()
                        held, size = [], 0
        if held:
            yield from pa.Table.from_batches(held).combine_chunks().to_batches()

    def at(name: str, place: str) -> Column:
        return F.get(name, F.col(place))

    runs = dealt.mapInArrow(compare, schema).withColumn("_run", F.explode(F.sequence(F.lit(0), F.size("_outer") - 1)))
    pairs = runs.withColumn("_inner", F.explode(F.sequence(at("_low", "_run"), at("_high", "_run") - 1)))
    pairs = pairs.withColumns({"_i": F.when(F.col("_begins"), at("_outer", "_run")).otherwise(F.col("_inner"))})
    pairs = pairs.withColumns({"_j": F.when(F.col("_begins"), F.col("_inner")).otherwise(at("_outer", "_run"))})
    cut = {
        left_range[0]: F.date_from_unix_date(F.greatest(at("_l_first", "_i"), at("_r_first", "_j"))),
        left_range[1]: F.date_from_unix_date(F.least(at("_l_last", "_i"), at("_r_last", "_j"))),
    }
    ours = [(cut[c] if c in cut else at(f"_l{c}", "_i")).alias(c) for c in left.columns if c not in scope]
    return pairs.select(*scope, *ours, *[at(f"_r{c}", "_j").alias(c) for c in rest[1]])


def _one(values: pa.Array) -> pa.ListArray:
    """All values as one list."""
    return pa.ListArray.from_arrays(pa.array([0, len(values)], pa.int32()), values)


def _laid(df: DataFrame, scope: Sequence[str], ends: tuple[str, str], folder: str, side: str) -> DataFrame:
    """Write the rows, in the order of scope, length and start; returns the place and the first and last day of each block.

    Names of files are random and a file is listed when it is whole, so a task that runs again leaves a file nobody lists.
    """
    first, last = (F.col(c).cast("date") for c in ends)
    spread = [f.name for f in df.schema if "map<" not in f.dataType.simpleString()]
    rows = df.where(first <= last).dropna(subset=list(scope)) if scope else df.where(first <= last)
    rows = rows.withColumns({"_first": F.unix_date(first), "_last": F.unix_date(last), "_spread": F.xxhash64(*spread)})
    rows = rows.withColumn("_level", F.length(F.bin(F.col("_last") - F.col("_first"))))  # of one level: up to twice as long
    order = [*scope, "_level", "_first", "_spread"]
    kept = [c for c in rows.columns if c not in ends and c != "_spread"]
    ranged = rows.repartitionByRange(*order).sortWithinPartitions(*order).select(kept)
    named = [f"{side}_{c}" for c in ("path", "at", "start", "stop", "low", "high")]
    schema = T.StructType([df.schema[c] for c in scope] + [T.StructField(c, t) for c, t in zip(named, PLACE, strict=True)])
    most = MOST_IN_BLOCK

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        out, found = None, []
        for at, batch in enumerate(x for x in batches if x.num_rows):
            if out is None:
                store, root = fs.FileSystem.from_uri(folder)
                store.create_dir(root, recursive=True)
                path = f"{root}/{uuid.uuid4().hex}.arrow"
                out = store.open_output_stream(path)
                file = pa.ipc.new_file(out, batch.schema)
            file.write_batch(batch)
            low, high = _blocks_of(batch, [*scope, "_level"], most)
            days = [batch.column(c).to_numpy() for c in ("_first", "_last")]
            places = [pa.array([path] * len(low)), pa.array([at] * len(low), pa.int32()), pa.array(low, pa.int32()), pa.array(high, pa.int32())]
            hull = [days[0][low], np.maximum.reduceat(days[1], low)]
            arrays = [*(batch.column(c).take(pa.array(low)) for c in scope), *places, *(pa.array(x).view(pa.date32()) for x in hull)]
            found.append(pa.RecordBatch.from_arrays(arrays, names=schema.names))
        if out is not None:
            file.close()
            out.close()
        yield from found

    return checkpointed(ranged.mapInArrow(write, schema))


PLACE = (T.StringType(), T.IntegerType(), T.IntegerType(), T.IntegerType(), T.DateType(), T.DateType())


def _blocks_of(batch: pa.RecordBatch, on: Sequence[str], most: int) -> tuple[np.ndarray, np.ndarray]:
    """Where blocks of sorted rows begin and end: they agree on ``on`` and have ``most`` rows at most."""
    new = np.zeros(batch.num_rows, bool)
    new[0] = True
    for c in on:
        values = batch.column(c)
        new[1:] |= pc.not_equal(values.slice(1), values.slice(0, len(values) - 1)).to_numpy(zero_copy_only=False)
    starts = np.flatnonzero(new)
    stops = np.append(starts[1:], len(new))
    parts = -(-(stops - starts) // most)
    nth = np.arange(parts.sum()) - np.repeat(np.cumsum(parts) - parts, parts)
    low = np.repeat(starts, parts) + nth * np.repeat(stops - starts, parts) // np.repeat(parts, parts)
    return low, np.append(low[1:], len(new))


def _overlaps(a: Columns, b: Columns, most: int) -> Iterator[tuple[bool, np.ndarray, np.ndarray, np.ndarray]]:
    """Pairs of rows of two blocks, both in the order of their first days, that overlap, as runs of places.

    Either the second range begins in the first one, or the first one begins in the second one after its first day.  So there
    are places in the first block with the runs in the second one that they meet (true), and places in the second one with runs in the first,
    about ``most`` pairs at a time.
    """
    inside = np.searchsorted(b["_first"], a["_first"], "left"), np.searchsorted(b["_first"], a["_last"], "right")
    after = np.searchsorted(a["_first"], b["_first"], "right"), np.searchsorted(a["_first"], b["_last"], "right")
    for begins, (low, high) in ((True, inside), (False, after)):
        outer = np.flatnonzero(high > low)
        pieces = np.cumsum((high - low)[outer]) // most
        for some in np.split(outer, np.flatnonzero(np.diff(pieces)) + 1):
            if len(some):
                yield begins, some, low[some], high[some]

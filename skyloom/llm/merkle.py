"""A manifest of a dataset as a tree of hashes whose parents keep the hash state before each child's slot."""

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from skyloom.llm import midstates
from skyloom.llm.common import written
from skyloom.operators.scale import row_ordinals, salted_join

ARITY = 3
HEIGHT = 6
BLOCK = ARITY**HEIGHT  # leaves below one node of height HEIGHT: what a task holds of a tree at once
AT_ONCE = 8192

#: What the parent of a node keeps for it: its run's size, its slot, the state before the slot, the run's other digests.
RECORD = np.dtype([("size", "u1"), ("slot", "u1"), ("state", ">u4", (8,)), ("others", ">u4", (ARITY - 1, 8))])


def leaf(text: Column, *fields: Column) -> Column:
    """SHA-256 (binary) of the fields and the text, each as its length in bytes, a colon and itself; null as a dash."""

    def framed(value: Column) -> Column:
        value = value.cast("string")
        return F.when(value.isNull(), "-").otherwise(F.concat(F.octet_length(value).cast("string"), F.lit(":"), value))

    return F.unhex(F.sha2(F.concat(*map(framed, fields), framed(text)), 256))


def _levels(n: np.ndarray) -> np.ndarray:
    """How often runs of n nodes are hashed until one node is left."""
    levels, left = np.zeros(len(n), int), n.copy()
    while (left > 1).any():
        levels += left > 1
        left = -(-left // ARITY)
    return levels


def climb(group: np.ndarray, pos: np.ndarray, n: np.ndarray, digests: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Hash whole blocks of sorted nodes upwards: records by node and level, and the digest above each node.

    ``group`` numbers the blocks in order, ``pos`` is a node's place in its tree, and ``n`` the nodes of its tree.
    """
    steps = np.minimum(_levels(n), HEIGHT)
    records = np.zeros((len(pos), HEIGHT), RECORD)
    at = np.arange(len(pos))  # the present ancestor of each node
    for level in range(int(steps.max(initial=0))):
        run = pos // ARITY
        new = np.ones(len(pos), bool)
        new[1:] = (group[1:] != group[:-1]) | (run[1:] != run[:-1])
        parent = np.cumsum(new) - 1
        slot = pos % ARITY
        size = np.bincount(parent)
        children = np.zeros((len(size), ARITY, 8), np.uint32)
        children[parent, slot] = digests
        blocks = midstates.hex_blocks(children.reshape(-1, 8)).reshape(-1, ARITY, 16)
        before = np.zeros((len(size), ARITY, 8), np.uint32)
        state = midstates.start(len(size))
        for s in range(ARITY):
            before[:, s] = state
            there = np.flatnonzero(size > s)
            state[there] = midstates.step(state[there], blocks[there, s])
        closed = midstates.finish(state, size)
        active = steps[new] > level  # a tree that is one node already stays as it is
        closed[~active] = children[~active, 0]

        own, mine = parent[at], slot[at]
        record = records[:, level]
        record["size"] = np.where(active[own], size[own], 0)
        record["slot"], record["state"] = mine, before[own, mine]
        for k in range(ARITY - 1):
            record["others"][:, k] = children[own, k + (k >= mine)]
        at, digests = own, closed
        group, pos, steps = group[new], run[new], steps[new]
    return records, digests[at]


def fold(record: np.ndarray, folded: np.ndarray, proof: np.ndarray, count: np.ndarray) -> None:
    """One level up, in place: resume the state before the slot with the replacement, then the right siblings.

    ``proof`` and ``count`` are the hash state of all siblings so far and how many they are.
    """
    rows = np.flatnonzero(record["size"])
    record = record[rows]
    size, slot = record["size"].astype(int), record["slot"]
    others = midstates.hex_blocks(record["others"].reshape(-1, 8)).reshape(-1, ARITY - 1, 16)
    state = midstates.step(record["state"].astype(np.uint32), midstates.hex_blocks(folded[rows]))
    for k in range(ARITY - 1):
        there = k < size - 1
        right = there & (k >= slot)
        proof[rows[there]] = midstates.step(proof[rows[there]], others[there, k])
        count[rows[there]] += 1
        state[right] = midstates.step(state[right], others[right, k])
    folded[rows] = midstates.finish(state, size)


def _binary(rows: np.ndarray) -> pa.Array:
    """Rows of bytes of one width."""
    n, width = rows.shape
    offsets = np.arange(0, (n + 1) * width, width, dtype=np.int32)
    return pa.Array.from_buffers(pa.binary(), n, [None, pa.py_buffer(offsets), pa.py_buffer(np.ascontiguousarray(rows))])


def _words(column: pa.Array) -> np.ndarray:
    """Digests of a binary column as words."""
    return midstates.from_bytes(b"".join(column.to_pylist()), len(column))


def _whole_blocks(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[pa.Table, np.ndarray]]:
    """Tables of whole blocks with the blocks' numbers, about AT_ONCE rows each, from rows sorted by of, block, pos."""

    def groups(table: pa.Table) -> np.ndarray:
        name = pc.dictionary_encode(table["of"].combine_chunks()).indices.to_numpy(zero_copy_only=False)
        block = table["block"].to_numpy()
        return np.cumsum(np.r_[0, (name[1:] != name[:-1]) | (block[1:] != block[:-1])])

    held: list[pa.RecordBatch] = []
    for batch in batches:
        if batch.num_rows:
            held.append(batch)
        if sum(b.num_rows for b in held) >= AT_ONCE:
            table = pa.Table.from_batches(held)
            group = groups(table)
            whole = int(np.searchsorted(group, group[-1]))  # the last block may go on in the next batch
            if whole:
                yield table.slice(0, whole), group[:whole]
            held = table.slice(whole).combine_chunks().to_batches()
    if held:
        table = pa.Table.from_batches(held)
        yield table, groups(table)


def _climbed(table: pa.Table, group: np.ndarray, digest: str) -> tuple[np.ndarray, np.ndarray]:
    digests = _words(table[digest].combine_chunks())
    return climb(group, table["pos"].to_numpy(), table["n"].to_numpy(), digests)


def _leaf_blocks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for table, group in _whole_blocks(batches):
        records, above = _climbed(table, group, "leaf")
        folded = _words(table["offered"].combine_chunks())
        proof, count = midstates.start(len(folded)), np.zeros(len(folded), np.int64)
        for level in range(HEIGHT):
            fold(records[:, level], folded, proof, count)
        out = table.select(["of", "doc_id", "pos", "n", "leaf"])
        for name, rows in (("folded", folded), ("proof", proof), ("above", above)):
            out = out.append_column(name, _binary(midstates.to_bytes(rows)))
        yield from out.append_column("count", pa.array(count)).combine_chunks().to_batches()


def _node_blocks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for table, group in _whole_blocks(batches):
        records, above = _climbed(table, group, "digest")
        real = records["size"] > 0
        ends = np.r_[0, np.cumsum(real.sum(1)) * RECORD.itemsize].astype(np.int32)
        path = pa.Array.from_buffers(pa.binary(), len(above), [None, pa.py_buffer(ends), pa.py_buffer(records[real].tobytes())])
        out = table.select(["of", "pos", "n"]).append_column("path", path)
        yield from out.append_column("above", _binary(midstates.to_bytes(above))).combine_chunks().to_batches()


def _folded_to_root(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for start in range(0, batch.num_rows, AT_ONCE):
            part = batch.slice(start, AT_ONCE)
            folded, proof = _words(part["folded"]), _words(part["proof"])
            count = part["count"].to_numpy().copy()
            paths = part["path"].to_pylist()
            levels = np.array([len(p) // RECORD.itemsize for p in paths])
            first = np.cumsum(levels) - levels
            records = np.frombuffer(b"".join(paths), RECORD)
            for level in range(int(levels.max(initial=0))):
                record = np.zeros(len(paths), RECORD)
                there = levels > level
                record[there] = records[first[there] + level]
                fold(record, folded, proof, count)
            out = [part.column(c) for c in ("doc_id", "of", "pos", "leaf", "subroot", "root")]
            out += [_binary(midstates.to_bytes(midstates.finish(proof, count))), _binary(midstates.to_bytes(folded))]
            yield pa.RecordBatch.from_arrays(out, ["doc_id", "of", "place", "leaf", "subroot", "root", "proof", "folded"])


def _dealt(nodes: DataFrame) -> DataFrame:
    """Nodes dealt out by blocks of their trees; a tree of any size becomes many blocks of at most BLOCK nodes."""
    blocks = nodes.withColumn("block", F.floor(F.col("pos") / BLOCK))
    return blocks.repartition("of", "block").sortWithinPartitions("of", "block", "pos")


def _blocks_above(rows: DataFrame) -> DataFrame:
    """The nodes that stand above blocks of ``rows``, as nodes of trees."""
    return rows.where(F.col("pos") % BLOCK == 0).select(
        "of", F.floor(F.col("pos") / BLOCK).alias("pos"), F.ceil(F.col("n") / BLOCK).alias("n"), F.col("above").alias("digest")
    )


def paths(nodes: DataFrame) -> DataFrame:
    """All records from each node (of, pos, n, digest) up to its tree's root: of, pos, path, root.

    One pass takes HEIGHT levels, and the next one has BLOCK times fewer nodes.
    """
    schema = "of string, pos long, n long, path binary, above binary"
    here = written(_dealt(nodes).mapInArrow(_node_blocks, schema), "paths")
    if (here.agg(F.max("n")).first()[0] or 0) <= BLOCK:
        return here.select("of", "pos", "path", F.col("above").alias("root"))
    higher = paths(_blocks_above(here)).select("of", F.col("pos").alias("block"), F.col("path").alias("rest"), "root")
    joined = here.withColumn("block", F.floor(F.col("pos") / BLOCK)).join(higher, ["of", "block"])
    return joined.select("of", "pos", F.concat("path", "rest").alias("path"), "root")


def manifest(docs: DataFrame, offered: Column | None = None) -> DataFrame:
    """The tree of a dataset, and what comes of it where ``offered`` stands in place of a document's text.

    ``docs`` has doc_id, source, lang, n_chars and text.  A leaf is the hash of a row.  Leaves of a source ascend by
    doc_id, null first; rows with one doc_id ascend by leaf, and those equal in both stand side by side.
    Every run of three nodes becomes the hash of their hex digests, a shorter last run too, until one is left: the
    source's subroot.  Subroots by source, null first, become the root in the same way.  Every parent
    keeps the hash state before each child's slot, so a changed leaf is folded by going on from the
    states before it with its right siblings only.

    Returns of (``a`` and the source's name, empty for null), doc_id, place (in its source), leaf, subroot, root, proof (hash of all
    siblings on the way up) and folded (the root with the offered text), digests as binary.  Null or empty texts and other
    null columns are leaves like any other; an only row is its own subroot and root, and its proof the hash of nothing;
    an empty table gives an empty one; other columns of ``docs`` are not looked at.

    A task holds blocks of 729 nodes, so a source of any size is spread over many; rows travel without their texts.
    """
    rows = docs.select(
        F.coalesce(F.concat(F.lit("a"), F.col("source")), F.lit("")).alias("of"),
        "doc_id",
        leaf(F.col("text"), *map(F.col, ("doc_id", "source", "lang", "n_chars"))).alias("leaf"),
        leaf(F.col("text") if offered is None else offered, *map(F.col, ("doc_id", "source", "lang", "n_chars"))).alias("offered"),
        F.monotonically_increasing_id().alias("nth"),
    )
    ranked = row_ordinals(written(rows, "leaves"), ["of", "doc_id", "leaf", "nth"])
    spans = ranked.groupBy("of").agg(F.min("ordinal").alias("first"), F.count(F.lit(1)).alias("n"))
    placed = salted_join(ranked, spans, ["of"], ["ordinal"]).withColumn("pos", F.col("ordinal") - F.col("first"))
    kind = docs.schema["doc_id"].dataType.simpleString()
    low = _dealt(placed.select("of", "doc_id", "pos", "n", "leaf", "offered")).mapInArrow(
        _leaf_blocks,
        f"of string, doc_id {kind}, pos long, n long, leaf binary, folded binary, proof binary, above binary, count long",
    )
    low = written(low, "blocks")
    inside = written(paths(_blocks_above(low)).withColumnRenamed("root", "subroot"), "inside")

    sources = written(row_ordinals(inside.where("pos = 0").select("of", "subroot"), ["of"]), "sources")
    nodes = sources.select(
        F.lit("").alias("of"), F.col("ordinal").alias("pos"), F.lit(sources.count()).cast("long").alias("n"), F.col("subroot").alias("digest")
    )
    outside = paths(nodes).select(F.col("pos").alias("ordinal"), F.col("path").alias("rest"), "root")
    tops = sources.select("of", "ordinal").join(outside, "ordinal").drop("ordinal")
    whole = salted_join(inside, tops, ["of"], ["pos"]).select(
        "of", F.col("pos").alias("block"), "subroot", "root", F.concat("path", "rest").alias("path")
    )
    joined = low.withColumn("block", F.floor(F.col("pos") / BLOCK)).join(whole, ["of", "block"])
    return joined.select("doc_id", "of", "pos", "leaf", "folded", "proof", "count", "subroot", "root", "path").mapInArrow(
        _folded_to_root,
        f"doc_id {kind}, of string, place long, leaf binary, subroot binary, root binary, proof binary, folded binary",
    )

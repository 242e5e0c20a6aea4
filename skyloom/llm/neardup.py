"""Near duplicates by word shingles: MinHash signatures, a multi-index Hamming join, exact confirmation.

Texts with the same set of shingles are one node.  A node's signature has 64 components of 16 bits; it is split
into chunks so that two signatures with at most ``2 * chunks - 1`` different components have a chunk with at most
one (pigeonhole).  That one is enumerated: every chunk gives a key for each component left out, so all such pairs,
and more, share a key.  The number of chunks follows from the similarity asked for: a pair right at it has more
different components than that once in tens of thousands, and shares no key at all less than once in a million.

In a bucket of nodes with a common key all are held against the smallest (the pivot), which is linear.  Where a
member is not linked to its pivot, it is held against all members of that pivot's buckets: up to ``BLOCK`` of them
at once, without listing the pairs.  Larger groups get a reference set, what most of some members have.  The
differences of two sets to it tell exactly how they differ from each other, so links are found from small
differences alone, or inside the groups of a differing shingle.  No link between two nodes that share a key is
lost, and every link is confirmed on the full sets.
"""

import math
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from skyloom.llm.common import components, slices, written
from skyloom.llm.words import distinct_by_text, lowered, mix, shingles, span_hashes, text_bytes, word_spans

PARTS = 64
BLOCK = 256
DEPTH = 6
TILE = 4096


def text_sets(texts: pa.Array, width: int) -> list[np.ndarray]:
    data, at = text_bytes(texts)
    data = lowered(data)
    starts, stops, first = word_spans(data, at)
    return distinct_by_text(*shingles(span_hashes(data, starts, stops), first, width))


def signature_bits(sets: list[np.ndarray]) -> np.ndarray:
    """64 MinHash components of 16 bits by row; sets must not be empty."""
    values = np.concatenate(sets)
    where = np.cumsum([0, *map(len, sets)])[:-1]
    factors = mix(np.arange(1, PARTS + 1, dtype=np.uint64)) | np.uint64(1)
    least = np.stack([np.minimum.reduceat(values * a, where) for a in factors], axis=1)
    return (mix(least) & np.uint64(0xFFFF)).astype("<u2")


def chunk_count(similarity: tuple[int, int]) -> int:
    """Chunks with which signatures up to four deviations beyond the expected distance are sure to meet."""
    share = 1 - similarity[0] / similarity[1]
    radius = math.floor(PARTS * share + 4 * math.sqrt(PARTS * share * (1 - share)))
    return max(1, min(PARTS // 3, radius // 2 + 1))


def chunk_keys(bits: np.ndarray, chunks: int) -> np.ndarray:
    """For each signature and component, a hash of that component's chunk without it."""
    chunk = np.arange(PARTS) * chunks // PARTS
    place = mix(np.arange(1, PARTS + 1, dtype=np.uint64) << np.uint64(32))
    each = mix(bits.astype(np.uint64) + place)
    whole = np.add.reduceat(each, np.flatnonzero(np.diff(chunk, prepend=-1)), axis=1)
    return mix(whole[:, chunk] - each + place)


def nodes(docs: DataFrame, width: int) -> DataFrame:
    """By row: doc_id, row_key, n_shingles, set_key and signature; the last two are null without words."""

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch, "text"):
                sets = text_sets(part.column("text"), width)
                full = [s for s in sets if len(s)]
                bits = iter(signature_bits(full)) if full else iter(())
                yield pa.RecordBatch.from_arrays(
                    [
                        part.column("doc_id"),
                        part.column("row_key"),
                        pa.array([len(s) for s in sets], pa.int64()),
                        pa.array([xxhash.xxh3_128_digest(s.tobytes()) if len(s) else None for s in sets], pa.binary()),
                        pa.array([next(bits).tobytes() if len(s) else None for s in sets], pa.binary()),
                    ],
                    names=["doc_id", "row_key", "n_shingles", "set_key", "signature"],
                )

    return _keyed(docs).mapInArrow(scan, "doc_id long, row_key long, n_shingles long, set_key binary, signature binary")


def _keyed(docs: DataFrame) -> DataFrame:
    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.xxhash64("doc_id", "text").alias("row_key"), F.col("text").cast("string").alias("text"))


def _keys(classes: DataFrame, chunks: int) -> DataFrame:
    def spread(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows:
                bits = np.frombuffer(b"".join(batch.column(1).to_pylist()), "<u2").reshape(-1, PARTS)
                node = np.repeat(batch.column(0).to_numpy(), PARTS)
                yield pa.RecordBatch.from_arrays([pa.array(chunk_keys(bits, chunks).view(np.int64).ravel()), pa.array(node)], names=["key", "node"])

    return classes.select("node", "signature").mapInArrow(spread, "key long, node long")


def _sets(docs: DataFrame, wanted: DataFrame, width: int) -> DataFrame:
    """The sets of the nodes in ``wanted``, one by node; they grow with the documents: they are merged with the texts, never broadcast."""

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch, "text"):
                sets = text_sets(part.column("text"), width)
                yield pa.RecordBatch.from_arrays([part.column("node"), pa.array([s.tobytes() for s in sets], pa.binary())], names=["node", "members"])

    # Rows repeated with the same doc_id and text are one node; most of them go before the shuffle.
    texts = _keyed(docs).select(F.col("row_key").alias("node"), "text").dropDuplicates(["node"])
    texts = texts.join(wanted.hint("merge"), "node", "left_semi")
    return texts.mapInArrow(scan, "node long, members binary")


def shared(left: list[np.ndarray], right: list[np.ndarray]) -> np.ndarray:
    """Sizes of the intersections of sorted sets, all of one side with all of the other."""
    if len(left) == 1:
        base, values = left[0], np.concatenate(right)
        hit = base[np.minimum(np.searchsorted(base, values), len(base) - 1)] == values
        owner = np.repeat(np.arange(len(right)), [len(s) for s in right])
        return np.bincount(owner[hit], minlength=len(right))[None, :]
    words = np.intersect1d(np.concatenate(left), np.concatenate(right))
    total = np.zeros((len(left), len(right)), np.int64)
    for start in range(0, len(words), TILE):
        tile = words[start : start + TILE]
        total += (_incidence(left, tile) @ _incidence(right, tile).T).astype(np.int64)
    return total


def _incidence(sets: list[np.ndarray], tile: np.ndarray) -> np.ndarray:
    table = np.zeros((len(sets), len(tile)), np.float32)
    for row, s in enumerate(sets):
        part = s[np.searchsorted(s, tile[0]) : np.searchsorted(s, tile[-1], side="right")]
        at = np.searchsorted(tile, part)
        table[row, at[tile[at] == part]] = 1
    return table


def forest(linked: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """By row and by column, the smallest column that it reaches over links; the number of columns where none."""
    none = linked.shape[1]
    columns = np.where(linked.any(0), np.arange(none), none)
    while True:
        rows = np.where(linked, columns[None, :], none).min(1, initial=none)
        now = np.minimum(columns, np.where(linked, rows[:, None], none).min(0, initial=none))
        if (now == columns).all():
            return rows, columns
        columns = now


def _by_group(rows: DataFrame, judge: Callable[[int, list[tuple]], tuple], schema: str) -> DataFrame:
    """``judge`` each (p, i, j) of the rows, given p and its list of (side, node, members); it returns columns of ``schema``.

    Rows come sorted, and only one group is in memory.
    """
    kinds = {"long": pa.int64(), "boolean": pa.bool_(), "binary": pa.binary()}
    fields = pa.schema([(name, kinds[kind]) for name, kind in (field.split(" ") for field in schema.split(", "))])

    def batch_of(out: tuple) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array(x, f.type) for x, f in zip(out, fields, strict=True)], schema=fields)

    def walk(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        at, group, out = None, [], tuple([] for _ in fields)

        def close() -> None:
            if group:
                for whole, part in zip(out, judge(at[0], group), strict=True):
                    whole.extend(part)

        for batch in batches:
            keys = zip(*(batch.column(k).to_pylist() for k in range(3)), strict=True)
            sides, ids, members = (batch.column(k) for k in (3, 4, 5))
            for row, key in enumerate(keys):
                if key != at:
                    close()
                    at, group = key, []
                group.append((sides[row].as_py(), ids[row].as_py(), members[row].as_py()))
            yield batch_of(out)
            out = tuple([] for _ in fields)
        close()
        yield batch_of(out)

    # repartition() by key puts a group into one task; it has at most about two blocks of rows.
    dealt = rows.repartition("p", "i", "j").sortWithinPartitions("p", "i", "j", "side").select("p", "i", "j", "side", "node", "members")
    return dealt.mapInArrow(walk, schema)


def _held_together(rows: DataFrame, similarity: tuple[int, int], every: bool) -> DataFrame:
    """Hold the left rows (side 0) of each (p, i, j) against its right rows (side 1) on their full sets.

    Gives (a, b, linked): with ``every`` a row for each right row and the group's one left row, else links that span
    what the group's links connect.
    """
    share, of = similarity

    def judge(_: int, group: list[tuple]) -> tuple[list, list, list]:
        sides = [[(n, np.frombuffer(m, np.uint64)) for s, n, m in group if s == side] for side in (0, 1)]
        if not sides[0] or not sides[1]:
            return [], [], []
        if every:
            sides[0] = sides[0][:1]
        left, right = ([s for _, s in side] for side in sides)
        a, b = (np.array([n for n, _ in side], np.int64) for side in sides)
        both = shared(left, right)
        union = np.array([len(s) for s in left])[:, None] + np.array([len(s) for s in right])[None, :] - both
        linked = (of * both >= share * union) & (a[:, None] != b[None, :])
        if every:
            return [int(a[0])] * len(b), b.tolist(), linked[0].tolist()
        rows, columns = forest(linked)
        r, c = rows < len(b), columns < len(b)
        ends = np.concatenate([b[rows[r]], b[columns[c]]])
        return np.concatenate([a[r], b[c]]).tolist(), ends.tolist(), [True] * len(ends)

    return _by_group(rows, judge, "a long, b long, linked boolean")


def _block(node: str, parts: str) -> F.Column:
    return F.pmod(F.xxhash64(node), F.col(parts)).cast("int")


def _upto(parts: str) -> F.Column:
    return F.explode(F.sequence(F.lit(0), F.col(parts).cast("int") - 1))


def _star(pairs: DataFrame, sets: DataFrame, similarity: tuple[int, int]) -> DataFrame:
    """Each distinct pair (p, node) on full sets, as (p, node, linked)."""
    degree = pairs.groupBy("p").agg(F.ceil(F.count(F.lit(1)) / BLOCK).cast("int").alias("parts"))
    zero = F.lit(0)
    right = pairs.join(degree, "p").select("p", zero.alias("i"), _block("node", "parts").alias("j"), F.lit(1).alias("side"), "node")
    left = degree.select("p", zero.alias("i"), _upto("parts").alias("j"), zero.alias("side"), F.col("p").alias("node"))
    held = _held_together(right.unionByName(left).join(sets, "node"), similarity, True)
    return held.select(F.col("a").alias("p"), F.col("b").alias("node"), "linked")


def _loose(star: DataFrame) -> DataFrame:
    """Groups with a member that is not linked to the pivot, but may be to another member."""
    sizes = star.groupBy("p").agg(F.count_if(~F.col("linked")).alias("u"), F.count(F.lit(1)).alias("n"))
    return sizes.where("u > 0 and n > 1")


def _in_blocks(member: DataFrame, sets: DataFrame, similarity: tuple[int, int]) -> DataFrame:
    """What is not linked to its pivot against all members of the group; ``member`` has p, u, n, node and linked."""
    member = member.withColumn("us", F.ceil(F.col("u") / BLOCK)).withColumn("ns", F.ceil(F.col("n") / BLOCK))
    left = member.where(~F.col("linked")).select("p", _block("node", "us").alias("i"), _upto("ns").alias("j"), F.lit(0).alias("side"), "node")
    right = member.select("p", _upto("us").alias("i"), _block("node", "ns").alias("j"), F.lit(1).alias("side"), "node")
    return _held_together(left.unionByName(right).join(sets, "node"), similarity, False).select("a", "b")


def _usual(member: DataFrame, sets: DataFrame) -> DataFrame:
    """By group, shingles that are frequent among about ``BLOCK`` of its members, with codes (bounded by 16 sets of mean size).

    The code of a shingle is the number of members that have it; that of one of the group's reference set, which
    more than half have, is the number of those that lack it, as ``-1 - number``.
    """

    def judge(p: int, group: list[tuple]) -> tuple[list, list]:
        found, counts = np.unique(np.concatenate([np.frombuffer(m, np.uint64) for _, _, m in group]), return_counts=True)
        often = counts >= max(2, len(group) / 16)
        found, counts = found[often], counts[often]
        codes = np.where(2 * counts > len(group), counts - len(group) - 1, counts).astype(np.int64)
        return [p], [found.tobytes() + codes.tobytes()]

    some = member.where(F.pmod(F.xxhash64("node", "p"), F.ceil(F.col("n") / BLOCK)) == 0)
    one = F.lit(0)
    rows = some.select("p", one.alias("i"), one.alias("j"), one.alias("side"), "node").join(sets, "node")
    return _by_group(rows, judge, "p long, members binary")


def differences(own: np.ndarray, usual: bytes, similarity: tuple[int, int]) -> tuple[int, np.ndarray, np.ndarray]:
    """How a set differs from the reference set of its group: the spread, the rarest differing shingles, and their room.

    Two sets differ from each other in what their differences do not share.  With ``c = (1 - s) / (1 + s)`` for a
    similarity ``s``, they are linked if they differ in at most ``c`` times the sum of their sizes.  The spread is
    the size of the difference less ``c`` times the set's, in units of ``1 / (of + share)``: sets whose spreads add up
    to 0 or less are linked, and others only if their differences share a shingle.  As a partner differs in at most
    ``(1 - s) / s`` of the set, one more than that many of the rarest shingles hold a shared one.  Two sets have to share
    half the sum of their spreads; where a shingle is the first that they share, those after it are what is left for that.
    So a partner's spread is at most the room of that shingle.
    """
    share, of = similarity
    found, codes = np.frombuffer(usual, np.uint64).reshape(2, -1) if usual else np.zeros((2, 0), np.uint64)
    codes = codes.view(np.int64)
    apart = np.setxor1d(own, found[codes < 0], assume_unique=True)
    spread = (of + share) * len(apart) - (of - share) * len(own)
    rank = np.zeros(len(apart), np.int64)
    if len(found):
        at = np.minimum(np.searchsorted(found, apart), len(found) - 1)
        rank = np.where(found[at] == apart, np.where(codes[at] < 0, -1 - codes[at], codes[at]), 0)
    rare = apart[np.lexsort((apart, rank))[: (of - share) * len(own) // share + 1]]
    return spread, rare, 2 * (of + share) * (len(apart) - np.arange(len(rare))) - spread


def _rest(member: DataFrame, sets: DataFrame, similarity: tuple[int, int], depth: int = DEPTH) -> DataFrame:
    """Links that span those between members of groups, other than to pivots; ``member`` has p, u, n, node and linked.

    Groups of up to ``BLOCK`` are held together at once.  Larger ones fall into groups of a differing shingle, ``depth`` times at
    most; what is still larger then is compared in blocks.
    """
    large = member.where(F.col("n") > BLOCK)
    if not depth or large.isEmpty():
        return _in_blocks(member, sets, similarity)
    few = _in_blocks(member.where(F.col("n") <= BLOCK), sets, similarity)
    return few.unionByName(_crowded(large.select("p", "n", "node"), sets, similarity, depth))


def _crowded(member: DataFrame, sets: DataFrame, similarity: tuple[int, int], depth: int) -> DataFrame:
    """Links that span those between members of large groups (p, n, node), by what sets them apart from the usual.

    Where spreads add up to 0 or less, both are linked to the member with the smallest spread.  Other links lie inside the groups of
    one differing shingle: there all are held against the member with the smallest spread, and what that does not link
    goes on as a group of its own, which is as a rule much smaller.
    """

    def judge(p: int, group: list[tuple]) -> tuple[list, ...]:
        usual = next((m for side, _, m in group if side == 0), b"")
        out = ([], [], [], [], [])
        for _, node, members in (row for row in group if row[0] == 1):
            spread, rare, room = differences(np.frombuffer(members, np.uint64), usual, similarity)
            out[0].extend([p] * (len(rare) + 1))
            out[1].extend([node] * (len(rare) + 1))
            out[2].extend([None, *rare.view(np.int64).tolist()])
            out[3].extend([spread] * (len(rare) + 1))
            out[4].extend([None, *room.tolist()])
        return out

    zero, parts = F.lit(0), F.ceil(F.col("n") / BLOCK).cast("int")
    dealt = member.withColumn("parts", parts).select("p", zero.alias("i"), _block("node", "parts").alias("j"), F.lit(1).alias("side"), "node")
    dealt = dealt.join(sets, "node").select("p", "i", "j", "side", "node", "members")
    sizes = member.select("p", parts.alias("parts")).distinct()
    usual = _usual(member, sets).join(sizes, "p").select("p", zero.alias("i"), _upto("parts").alias("j"), zero.alias("side"), zero.cast("long").alias("node"), "members")
    apart = written(_by_group(dealt.unionByName(usual), judge, "p long, node long, token long, spread long, room long"), "differences")

    least = F.min(F.struct("spread", "node")).alias("least")
    whole = apart.where("token IS NULL")
    near = whole.join(whole.groupBy("p").agg(least), "p").where("spread + least.spread <= 0 and node <> least.node")
    near = near.select(F.col("least.node").alias("a"), F.col("node").alias("b"))

    tokens = apart.where("token IS NOT NULL")
    heads = tokens.groupBy("p", "token").agg(least, F.max("room").alias("most"), F.count(F.lit(1)).alias("n")).where("n > 1")
    inside = tokens.join(heads, ["p", "token"]).where("node <> least.node and least.spread <= room and spread <= most")
    inside = written(inside.select(F.xxhash64("p", "token").alias("group"), F.col("least.node").alias("p"), "node", "spread", "room"), "rare")
    star = written(_star(inside.select("p", "node").distinct(), sets, similarity), "rare-star")
    judged = inside.join(star, ["p", "node"]).select(F.col("group").alias("p"), "node", "linked", "spread", "room")
    able = judged.groupBy("p").agg(F.min("spread").alias("least"), F.max("room").alias("most"))
    judged = judged.join(able, "p").where("least <= room and spread <= most").select("p", "node", "linked").distinct()
    rest = _rest(written(judged.join(_loose(judged), "p"), "rare-loose"), sets, similarity, depth - 1)
    return near.unionByName(star.where("linked").select(F.col("p").alias("a"), F.col("node").alias("b"))).unionByName(rest)


def links(docs: DataFrame, classes: DataFrame, width: int, similarity: tuple[int, int]) -> DataFrame:
    """Edges (a, b) that connect exactly the nodes which confirmed links connect."""
    chunks = chunk_count(similarity)
    keys = _keys(classes, chunks)
    pivots = keys.groupBy("key").agg(F.min("node").alias("p"), F.max("node").alias("last")).where("p < last").select("key", "p")
    pairs = written(keys.join(pivots, "key").where("node <> p").select("p", "node").distinct(), "pairs")
    wanted = pairs.select("node").unionByName(pairs.select(F.col("p").alias("node"))).distinct()
    sets = written(_sets(docs, wanted, width), "sets")
    star = written(_star(pairs, sets, similarity), "star")
    rest = _rest(written(star.join(_loose(star), "p"), "loose"), sets, similarity)
    return star.where("linked").select(F.col("p").alias("a"), F.col("node").alias("b")).unionByName(rest)


def classes_of(rows: DataFrame) -> DataFrame:
    """One node for each set of shingles: its row key, signature and smallest doc_id."""
    first = F.min(F.struct("row_key", "signature"))
    by_set = rows.where(F.col("set_key").isNotNull()).groupBy("set_key").agg(first.alias("f"), F.min("doc_id").alias("doc"))
    return by_set.select("set_key", F.col("f.row_key").alias("node"), F.col("f.signature").alias("signature"), "doc")


def grouped(docs: DataFrame, width: int, similarity: tuple[int, int]) -> tuple[DataFrame, DataFrame]:
    """Rows of ``nodes`` and, by set_key, the root node, the smallest doc_id and smallest row key of its component."""
    rows = written(nodes(docs, width), "nodes")
    classes = written(classes_of(rows), "classes")
    roots = components(links(docs, classes, width, similarity))
    rooted = classes.join(roots, "node", "left").select("set_key", "doc", "node", F.coalesce("root", "node").alias("root"))
    whole = rooted.groupBy("root").agg(F.min("doc").alias("component_id"))
    return rows, rooted.join(whole, "root").select("set_key", "root", "component_id")


def near_duplicates(docs: DataFrame, width: int = 5, similarity: tuple[int, int] = (80, 100)) -> DataFrame:
    """The component of near duplicates of each row of ``docs`` (doc_id, text).

    Words are lower-cased in A to Z; two texts are linked if their sets of ``width``-word shingles have
    ``similarity`` or more in common (intersection to union, as a fraction of integers).  Returns doc_id,
    n_shingles, component_id (smallest doc_id that links reach, nulls aside) and kept (it is the row's own).

    A text with fewer words has them all as its one shingle.  A null, empty or blank text has no shingles, is
    linked with nothing and kept; repeated rows are linked; a null doc_id takes the id of its component, or null
    where that has none; an empty table gives an empty one; other columns are not looked at.
    """
    rows, found = grouped(docs, width, similarity)
    full = rows.where(F.col("set_key").isNotNull()).join(found, "set_key").select("doc_id", "n_shingles", "component_id")
    bare = rows.where(F.col("set_key").isNull()).select("doc_id", "n_shingles", F.col("doc_id").alias("component_id"))
    return full.unionByName(bare).withColumn("kept", F.col("doc_id").eqNullSafe(F.col("component_id")))


def one_of_each(docs: DataFrame, width: int = 5, similarity: tuple[int, int] = (80, 100)) -> DataFrame:
    """The rows of ``docs`` without near duplicates: of each component the row with the smallest doc_id, nulls last.

    Of rows repeated with the same doc_id and text one stays.  Rows without words all stay.
    """
    rows, found = grouped(docs, width, similarity)
    first = F.min(F.struct(F.col("doc_id").isNull().alias("none"), "doc_id", "row_key"))
    by_set = rows.where(F.col("set_key").isNotNull()).groupBy("set_key").agg(first.alias("f"))
    best = by_set.join(found, "set_key").groupBy("root").agg(F.min("f").alias("f"))
    stay = best.select(F.col("f.row_key").alias("_key"))
    row = docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row"), F.xxhash64("doc_id", "text").alias("_key"))
    bare = ~F.coalesce(F.col("row.text"), F.lit("")).rlike(r"[^\x20\x09-\x0D]")
    kept = row.where(~bare).join(stay, "_key", "left_semi").dropDuplicates(["_key"])
    return kept.select("row").unionByName(row.where(bare).select("row")).select("row.*")

"""Near duplicates among embeddings: spherical k-means cells, blocked cosines inside and between them, one of each group kept."""

import math
import uuid
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyarrow import fs
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from skyloom.llm.common import components, written
from skyloom.llm.neardup import forest
from skyloom.session import scratch

SAMPLE = 16_384
CELL = 2_048
BLOCK = 1_024  # rows that are compared at once
FILE_ROWS, FILE_BYTES = 16, 16 << 20  # blocks in a file, and bytes of its vectors in double precision, at most
AT_ONCE = 1 << 20  # numbers of an array that assigns rows to cells
MOST_TASKS = 20_000


def takes_part(vector: Column) -> Column:
    """Neither null nor empty, without null or non-finite components."""
    finite = F.forall(vector, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    return F.coalesce((F.size(vector) > 0) & finite, F.lit(False))


def unit(rows: pa.Array) -> np.ndarray:
    """Rows of equal length as unit vectors in double precision; the largest component is taken out first."""
    table = rows.flatten().to_numpy(zero_copy_only=False).astype(np.float64).reshape(len(rows), -1)
    table = table / np.abs(table).max(1, keepdims=True)
    return table / np.sqrt((table * table).sum(1, keepdims=True))


def centroids(classes: DataFrame, count: int, of: int, sample: int = SAMPLE, rounds: int = 8) -> dict[int, np.ndarray]:
    """Unit centroids by dimension, fitted on the ``sample`` of ``of`` vectors with the smallest hashes (the bound of the fit)."""
    least = min(2**63 - 1, -(2**63) + 2**64 * 2 * sample // max(1, of))  # twice the sample stands below it, so tasks need not rank all
    few = classes.where(F.col("node") <= least).select("vector", F.size("vector").alias("dim"), "node").orderBy("node").limit(sample)
    rows = few.select("vector", "dim").toArrow()
    found = {}
    for dim in set(rows.column("dim").to_pylist()):
        points = unit(rows.filter(pc.equal(rows.column("dim"), dim)).column("vector").combine_chunks())
        k = min(count, len(points))
        centres = points[:: max(1, len(points) // k)][:k].copy()
        for _ in range(rounds):
            nearest = (points @ centres.T).argmax(1)
            sums = np.zeros_like(centres)
            np.add.at(sums, nearest, points)
            norm = np.sqrt((sums * sums).sum(1))
            centres[norm > 0] = sums[norm > 0] / norm[norm > 0, None]
        found[dim] = np.unique(centres, axis=0)
    return found


def _homes(classes: DataFrame, centres: dict[int, np.ndarray]) -> DataFrame:
    """Each vector with its nearest cell (home)."""

    def assign(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            dims = batch.column(2).to_numpy()
            for dim in np.unique(dims):
                part = batch.filter(pa.array(dims == dim))
                centre = centres.get(int(dim), np.eye(1, int(dim)))
                step = max(1, AT_ONCE // max(int(dim), len(centre)))
                for low in range(0, part.num_rows, step):
                    some = part.slice(low, step)
                    cell = (unit(some.column(3)) @ centre.T).argmax(1).astype(np.int32)
                    yield pa.RecordBatch.from_arrays([*some.columns, pa.array(cell)], names=[*some.schema.names, "cell"])

    rows = classes.select("node", "label", F.size("vector").alias("dim"), "vector", "copies")
    kind = classes.schema["vector"].dataType.simpleString()
    return rows.mapInArrow(assign, f"node long, label long, dim int, vector {kind}, copies long, cell int")


def _files(cells: DataFrame, folder: str, rows: int) -> DataFrame:
    """Write the rows in the order of length, label and cell into files of one length each.

    Returns the path once for the first and once for the last label in it, as only these may go on in another file.
    Names are random and a file is one write, so a task that runs again leaves a file nobody lists.
    """
    order, most_rows = ["dim", "label", "cell", "node"], FILE_ROWS * BLOCK
    tasks = max(1, min(MOST_TASKS, math.ceil(rows / (2 * most_rows))))

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        store, root = fs.FileSystem.from_uri(folder)
        store.create_dir(root, recursive=True)
        held, n, at = [], 0, None

        def close() -> pa.RecordBatch:
            path = f"{root}/{uuid.uuid4().hex}.arrow"
            with store.open_output_stream(path) as out, pa.ipc.new_file(out, held[0].schema) as file:
                for part in held:
                    file.write_batch(part)
            ends = sorted({held[0].column(1)[0].as_py(), held[-1].column(1)[-1].as_py()})
            held.clear()
            return pa.RecordBatch.from_pydict(
                {"dim": pa.array([at] * len(ends), pa.int32()), "label": pa.array(ends, pa.int64()), "path": [path] * len(ends), "first": [label == ends[0] for label in ends]}
            )

        for batch in batches:
            dims = batch.column(2).to_numpy()
            low = 0
            while low < len(dims):
                if at != dims[low]:
                    if held:
                        yield close()
                    n, at = 0, int(dims[low])
                most = max(1, min(most_rows, FILE_BYTES // (8 * at)))
                high = min(low + most - n, int(np.searchsorted(dims, at, "right")))
                held.append(batch.slice(low, high - low))
                n, low = n + high - low, high
                if n == most:
                    yield close()
                    n = 0
        if held:
            yield close()

    placed = cells.repartitionByRange(tasks, *order).sortWithinPartitions(*order)
    return written(placed.mapInArrow(write, "dim int, label long, path string, first boolean"), "files")


class _Rows:
    """The rows of a file as unit vectors; they stand by label and cell."""

    def __init__(self, store: fs.FileSystem, path: str):
        with store.open_input_file(path) as file:
            table = pa.ipc.open_file(file).read_all()
        self.node, self.label, self.copies, self.cell = (table.column(c).to_numpy() for c in ("node", "label", "copies", "cell"))
        self.points = np.concatenate([unit(x) for x in table.column("vector").chunks if len(x)])
        self.rough = self.points.astype(np.float32)
        self.n_links = np.zeros(len(self.node), np.int64)

    def labels(self) -> Iterator[tuple[int, int, int]]:
        """Each label, where it begins and ends."""
        found, starts = np.unique(self.label, return_index=True)
        return zip(found.tolist(), starts.tolist(), [*starts[1:].tolist(), len(self.label)], strict=True)

    def cells(self, low: int, high: int) -> list[tuple[int, int, int]]:
        """Each cell of these rows, where it begins and ends."""
        found, starts = np.unique(self.cell[low:high], return_index=True)
        return list(zip(found.tolist(), (low + starts).tolist(), [*(low + starts[1:]).tolist(), high], strict=True))


class _Links:
    """Counts and spanning links between two files, which may be the same."""

    def __init__(self, a: _Rows, b: _Rows, centre: np.ndarray, similarity: float, most: int):
        self.a, self.b, self.centre, self.similarity, self.most = a, b, centre, similarity, most
        self.chord = math.sqrt(max(0.0, 2 - 2 * similarity)) + 1e-9
        self.near = similarity - (a.points.shape[1] + 8) * 2.0**-23  # what single precision can be wrong by, and more
        self.ends = []

    def label(self, a: tuple[int, int], b: tuple[int, int]) -> None:
        """The rows of one label, which stand from ``a[0]`` up to ``a[1]`` in one file and as ``b`` says in the other."""
        same, pairs, small = self.a is self.b, (a[1] - a[0]) * (b[1] - b[0]), (self.most // 4) ** 2
        ours, theirs = (self.a.cells(*a), self.b.cells(*b)) if pairs > small else ([], [])
        if pairs <= small or pairs <= len(ours) * len(theirs) * small:  # cells of few rows would cost more than they spare
            self.all(np.arange(*a), np.arange(*b), same)
            return
        for i, (cell, low, high) in enumerate(ours):
            for other, start, end in theirs[i if same else 0 :]:
                if cell == other:
                    self.all(np.arange(low, high), np.arange(start, end), same)
                else:
                    self.between((cell, low, high), (other, start, end))

    def between(self, ours: tuple[int, int, int], theirs: tuple[int, int, int]) -> None:
        """Rows of two cells, as far as they may be linked.

        The plane half way between the centroids separates the cells, so the distance of two rows is no less than their distances
        from it together.  A row that is farther from it than a link is long, less the nearest row on the other side, is no guest there.
        """
        across = self.centre[ours[0]] - self.centre[theirs[0]]
        across /= np.sqrt(across @ across)
        here = self.a.points[ours[1] : ours[2]] @ across
        there = -(self.b.points[theirs[1] : theirs[2]] @ across)
        guests = np.flatnonzero(here <= self.chord - there.min())
        hosts = np.flatnonzero(there <= self.chord - here.min())
        if not len(guests) or not len(hosts):
            return
        guests, hosts = guests[np.argsort(here[guests])], hosts[np.argsort(there[hosts])]
        far = there[hosts]
        step = max(1, self.most // 4)
        for low in range(0, len(guests), step):
            some = guests[low : low + step]
            met = hosts[: np.searchsorted(far, self.chord - here[some[0]], "right")]
            if not len(met):
                return
            for start in range(0, len(met), self.most):
                self.block(ours[1] + some, theirs[1] + met[start : start + self.most], False)

    def all(self, ours: np.ndarray, theirs: np.ndarray, same: bool) -> None:
        for low in range(0, len(ours), self.most):
            for start in range(low if same else 0, len(theirs), self.most):
                self.block(ours[low : low + self.most], theirs[start : start + self.most], same and start == low)

    def block(self, ours: np.ndarray, theirs: np.ndarray, same: bool) -> None:
        """One product in single precision; only rows and columns in which it leaves a doubt are worked out in double precision."""
        rough = self.a.rough[ours] @ self.b.rough[theirs].T
        if same:
            np.fill_diagonal(rough, -np.inf)
        if rough.max() < self.near:
            return
        rough = rough >= self.near
        ours, theirs = ours[rough.any(1)], theirs[rough.any(0)]
        linked = self.a.points[ours] @ self.b.points[theirs].T >= self.similarity
        if same:
            linked = np.triu(linked, 1)  # both sides are the same rows in the same order
        self.a.n_links[ours] += linked @ self.b.copies[theirs]
        self.b.n_links[theirs] += self.a.copies[ours] @ linked
        rows, columns = forest(linked)
        r, c = rows < len(theirs), columns < len(theirs)
        self.ends.append((self.a.node[ours[r]], self.b.node[theirs[rows[r]]]))
        self.ends.append((self.b.node[theirs[c]], self.b.node[theirs[columns[c]]]))

    def found(self) -> pa.RecordBatch:
        """(a, b, n): with b null, a has n links between these files; else a link that helps to connect a and b."""
        out = []
        for side in [self.a] if self.a is self.b else [self.a, self.b]:
            counted = side.n_links > 0
            out.append((side.node[counted], None, side.n_links[counted]))
            side.n_links[:] = 0
        out += [(x, y, np.zeros(len(x), np.int64)) for x, y in self.ends]
        a, n = (np.concatenate([x[k] for x in out]) for k in (0, 2))
        b = pa.concat_arrays([pa.nulls(len(x[0]), pa.int64()) if x[1] is None else pa.array(x[1]) for x in out])
        return pa.RecordBatch.from_arrays([pa.array(a), b, pa.array(n)], names=["a", "b", "n"])


def _compared(files: DataFrame, folder: str, centres: dict[int, np.ndarray], similarity: float) -> DataFrame:
    """Rows (a, b, n) as of :meth:`_Links.found`, for each file and each two files that have a label in common.

    Only the paths are dealt out; a task reads two files at a time, so no vector is copied for those that it is compared with.
    """
    one = files.select("dim", "label", F.col("path").alias("a"))
    two = files.select("dim", "label", F.col("path").alias("b"))
    own = files.where("first").select("dim", F.lit(None).cast("long").alias("label"), F.col("path").alias("a"), F.col("path").alias("b"))
    pairs = one.join(two, ["dim", "label"]).where("a < b").unionByName(own)
    most = BLOCK

    def compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        store, _ = fs.FileSystem.from_uri(folder)
        for batch in batches:
            for dim, label, a, b in zip(*(batch.column(c).to_pylist() for c in range(4)), strict=True):
                left = _Rows(store, a)
                right = left if a == b else _Rows(store, b)
                links = _Links(left, right, centres.get(dim, np.eye(1, dim)), similarity, most)
                places = [{key: (low, high) for key, low, high in side.labels() if label is None or key == label} for side in (left, right)]
                for key, place in places[0].items():
                    links.label(place, places[1][key])
                yield links.found()

    tasks = 16 * int(files.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    dealt = pairs.repartition(max(1, min(pairs.count(), tasks, MOST_TASKS)))
    return dealt.mapInArrow(compare, "a long, b long, n long").where("b is null or a <> b")


def near_duplicates(vectors: DataFrame, similarity: float = 0.93) -> DataFrame:
    """Links and components of the rows of ``vectors`` (vec_id, embedding, label).

    Two vectors are linked if their labels are equal and not null and their cosine in double precision is at
    least ``similarity``.  Equal vectors of a label are one node that counts its copies.  Cells come from k-means
    on a bounded sample; every vector is also a guest of the cells where a linked vector may be at home, so no pair
    is lost to a border.  Vectors are written once, by label and cell, into files of bounded size, and a task reads two files at a
    time.  They are compared in blocks of about 1,024 rows, as matrix products; tasks return counts and
    links that span, never all pairs.

    Returns vec_id, n_links (other vectors it is linked to), component_id (smallest vec_id reachable) and kept.  Vectors that are
    null, empty or zero, that hold null or non-finite components, or have no label, are linked with nothing.
    Vectors of different length are not compared.  Rows repeated with one vec_id count as others; a null vec_id takes
    its component's id, or null.  An empty table gives an empty one; other columns are not looked at.
    """
    narrow = vectors.schema["embedding"].dataType.simpleString() == "array<float>"  # half the bytes of the same numbers
    vector = F.col("embedding") if narrow else F.col("embedding").cast("array<double>")
    rows = vectors.select(F.col("vec_id").cast("long").alias("vec_id"), vector.alias("vector"), F.col("label").cast("long").alias("label"))
    able = takes_part(F.col("vector")) & F.col("label").isNotNull() & F.coalesce(F.exists("vector", lambda x: x != 0), F.lit(False))
    rows = rows.select("vec_id", "vector", "label", F.when(able, F.xxhash64("label", "vector")).alias("node"))
    in_play = rows.where(F.col("node").isNotNull())
    grouped = in_play.groupBy("node", "label", "vector").agg(F.count(F.lit(1)).alias("copies"), F.min("vec_id").alias("first"))
    classes = written(grouped, "classes")
    sizes = classes.groupBy(F.size("vector").alias("dim"), "label").agg(F.count(F.lit(1)).alias("n"))
    every, most = sizes.agg(F.coalesce(F.sum("n"), F.lit(0)), F.coalesce(F.max("n"), F.lit(0))).first()
    centres = centroids(classes, max(1, min(SAMPLE // 16, most // CELL)), every)
    folder = scratch(vectors.sparkSession, "vectors")
    files = _files(_homes(classes, centres), folder, every)
    pairs = written(_compared(files, folder, centres, similarity), "links")
    counted = pairs.where("b is null").groupBy(F.col("a").alias("node")).agg(F.sum("n").alias("n"))
    roots = components(pairs.where("b is not null").select("a", "b"))
    rooted = classes.select("node", "first", "copies").join(roots, "node", "left").withColumn("root", F.coalesce("root", "node"))
    least = rooted.groupBy("root").agg(F.min("first").alias("component_id"))
    n_links = F.col("copies") - 1 + F.coalesce("n", F.lit(0))
    found = rooted.join(least, "root").join(counted, "node", "left").select("node", n_links.alias("n_links"), "component_id")
    linked = in_play.select("vec_id", "node").join(found, "node").select("vec_id", "n_links", "component_id")
    alone = rows.where(F.col("node").isNull()).select("vec_id", F.lit(0).cast("long").alias("n_links"), F.col("vec_id").alias("component_id"))
    return linked.unionByName(alone).withColumn("kept", F.col("vec_id").eqNullSafe(F.col("component_id")))


def one_of_each(vectors: DataFrame, similarity: float = 0.93) -> DataFrame:
    """The ids that stay, one of each group of near duplicates."""
    return near_duplicates(vectors, similarity).where("kept").select("vec_id").distinct()

"""Repair the structure of conversations with the cheapest edits, and of these the least in the order of their letters."""

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from skyloom.llm import auditpaths as paths
from skyloom.llm.common import written
from skyloom.operators.scale import row_ordinals

SPACE = r"\x20\x09-\x0D"
PIECE_BITS = 12  # a piece has 4096 turns at most

REPORT = (
    "conv_id {kind}, gaps long, blank long, duplicate long, truncated long, illegal long, cost long, "
    "audit string, repaired_sha256 string"
)
TURNS = "conv_id {kind}, place long, edit string, turn long, role string, text string"


def _end(text: Column) -> Column:
    """The last character of a text that is no white space, empty where there is none."""
    return F.right(F.rtrim(text, F.lit(" \t\n\x0b\f\r")), F.lit(1))


def ordered_turns(rows: DataFrame) -> DataFrame:
    """All turns in the order of conversation, turn (null first), role and text; ``at`` ascends with it.

    One range shuffle puts them in order, so a long conversation lies in several partitions.  Equal rows stand side by side.
    """
    base = rows.select(
        F.coalesce(F.concat(F.lit("a"), F.col("conv_id").cast("string")), F.lit("")).alias("of"),
        "conv_id",
        F.col("turn").cast("long").alias("turn"),
        F.coalesce("role", F.lit(" ")).alias("role"),
        F.coalesce("text", F.lit(" ")).alias("text"),
        F.monotonically_increasing_id().alias("nth"),
    ).withColumn("said", F.sha2("text", 256))
    order = ["of", "turn", "role", "said", "nth"]
    ranged = base.repartitionByRange(*order).sortWithinPartitions(*order)
    return written(ranged.drop("nth").withColumn("at", F.monotonically_increasing_id()), "turns")


def pieces(turns: DataFrame, bits: int = PIECE_BITS) -> DataFrame:
    """of, piece and the symbols of up to 2^bits turns in a row of one conversation, a letter for each turn.

    A turn is a duplicate if its role and text were seen earlier; the first of each is found by a sum over all.
    """
    end, initial = _end(F.col("text")), F.substring("role", 1, 1)
    role = F.when(initial == "s", 0).when(initial == "u", 1).when(initial == "a", 2).otherwise(3)
    state = F.when(end == "", 2).when(end.isin(".", "!", "?"), 0).otherwise(1)
    first = turns.groupBy("of", "role", "said").agg(F.min("at").alias("at")).select("at", F.lit(True).alias("first"))
    marked = turns.select("of", "at", role.alias("role"), state.alias("state")).join(first, "at", "left")
    fault = F.when(F.col("state") == 2, 2).when(F.col("first").isNull(), 3).otherwise(F.col("state"))
    symbol = F.char(F.lit(97) + 4 * F.col("role") + fault)
    return (
        marked.select("of", F.shiftright("at", bits).alias("piece"), F.struct("at", symbol.alias("symbol")).alias("s"))
        .groupBy("of", "piece")
        .agg(F.array_join(F.transform(F.array_sort(F.collect_list("s")), lambda s: s.symbol), "").alias("symbols"))
    )


def _matrices(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        if batch.num_rows:
            words = [w.encode() for w in batch.column("symbols").to_pylist()]
            matrix = paths.matrices(words).reshape(len(words), 16).tolist()
            yield pa.RecordBatch.from_arrays(
                [batch.column("of"), batch.column("ord"), pa.array(matrix, pa.list_(pa.int64()))], ["of", "ord", "m"]
            )


def _solved(batch: pa.RecordBatch, begin: np.ndarray):
    words = [w.encode() for w in batch.column("symbols").to_pylist()]
    end = np.array(batch.column("end").to_pylist(), np.int64)
    return paths.audits(words, end, batch.column("last").to_numpy(zero_copy_only=False), begin)


def _state_maps(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        if batch.num_rows:
            _, states = _solved(batch, np.tile(np.arange(4), (batch.num_rows, 1)))
            maps = pa.array(states.tolist(), pa.list_(pa.int32()))
            yield pa.RecordBatch.from_arrays([batch.column("of"), batch.column("ord"), maps], ["of", "ord", "m"])


def _audits(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        if batch.num_rows:
            found, _ = _solved(batch, batch.column("begin").to_numpy()[:, None].astype(int))
            audit = pa.array([f[0].decode() for f in found], pa.string())
            columns = [batch.column(c) for c in ("of", "piece", "symbols")]
            yield pa.RecordBatch.from_arrays([*columns, audit], ["of", "piece", "symbols", "audit"])


def _scanned(table: DataFrame, rounds: int, step: int, joined: Column) -> DataFrame:
    """``m`` of each piece with those of all pieces after (step 1) or before it (step -1) in its conversation.

    In round k a piece takes in what the piece 2^k further has, so the rounds are the logarithm of the pieces.
    """
    for k in range(rounds):
        other = table.select("of", (F.col("ord") - step * (1 << k)).alias("ord"), F.col("m").alias("other"))
        table = written(
            table.join(other, ["of", "ord"], "left").select(
                "of", "ord", F.when(F.col("other").isNull(), F.col("m")).otherwise(joined).alias("m")
            ),
            "scan",
        )
    return table


def _least_sums(a: str, b: str) -> Column:
    """The product of two 4 x 4 matrices where sums stand for products and the least for the sum."""
    cells = [
        F.least(F.lit(int(paths.FAR)), *[F.get(a, F.lit(4 * s + m)) + F.get(b, F.lit(4 * m + t)) for m in range(4)])
        for s in range(4)
        for t in range(4)
    ]
    return F.array(*cells)


def audited(parts: DataFrame) -> DataFrame:
    """Pieces with the audit of their turns: of, piece, symbols, audit.

    A conversation of one piece, as nearly all are, is settled by itself.  Those of several get, by
    scans over their pieces, the costs to go after each piece and the state before it.
    """
    spans = parts.groupBy("of").agg(F.max("piece").alias("stop"), F.count(F.lit(1)).alias("n"))
    spanned = written(parts.join(spans, "of"), "pieces")
    at_end = F.array(*[F.lit(int(c)).cast("long") for c in paths.AT_END])
    alone = spanned.where("n = 1").select(
        "of", "piece", "symbols", at_end.alias("end"), F.lit(True).alias("last"), F.lit(0).cast("long").alias("begin")
    )
    most = spanned.agg(F.max("n")).first()[0] or 0
    schema = "of string, piece long, symbols string, audit string"
    if most < 2:
        return alone.mapInArrow(_audits, schema)
    rounds = (most - 1).bit_length()
    many = spanned.where("n > 1").select("of", "piece", "symbols", (F.col("piece") == F.col("stop")).alias("last"))
    many = written(row_ordinals(many, ["of", "piece"], "ord"), "numbered")
    costs = _scanned(written(many.mapInArrow(_matrices, "of string, ord long, m array<long>"), "matrices"), rounds, 1, _least_sums("m", "other"))
    to_go = F.array(*[F.least(*[F.get("m", F.lit(4 * s + t)) + F.get(at_end, F.lit(t)) for t in range(4)]) for s in range(4)])
    after = costs.select("of", (F.col("ord") - 1).alias("ord"), to_go.alias("after"))
    known = many.join(after, ["of", "ord"], "left").withColumn("end", F.coalesce("after", at_end)).drop("after")
    known = written(known, "known")
    maps = _scanned(
        written(known.mapInArrow(_state_maps, "of string, ord long, m array<int>"), "maps"),
        rounds, -1, F.transform("other", lambda s: F.get("m", s)),
    )
    before = maps.select("of", (F.col("ord") + 1).alias("ord"), F.get("m", F.lit(0)).cast("long").alias("state"))
    begun = known.join(before, ["of", "ord"], "left").withColumn("begin", F.coalesce("state", F.lit(0).cast("long")))
    return alone.unionByName(begun.select(*alone.columns)).mapInArrow(_audits, schema)


class _Reader:
    """One conversation at a time from rows in order; nothing of it is held but sums and the present piece's audit."""

    def __init__(self, of: str, conv_id) -> None:
        self.of, self.conv_id = of, conv_id
        self.counts = dict.fromkeys(("blank", "duplicate", "truncated", "illegal", "cost"), 0)
        self.audit: list[str] = []
        self.pending, self.symbols, self.place, self.turns = "", "", 0, 0
        self.state, self.before, self.out = 0, "", 0
        self.low = self.high = self.seen = None
        self.digest = hashlib.sha256()

    def piece(self, symbols: str, audit: str) -> None:
        self.audit.append(audit)
        self.pending, self.place = audit, 0
        codes = [ord(s) - 97 for s in symbols]
        for code in codes:
            role = "suao"[code // 4]
            self.counts["illegal"] += bool(self.before) and self.before + role not in ("su", "ua", "au")
            self.before = role
        for fault, name in ((1, "truncated"), (2, "blank"), (3, "duplicate")):
            self.counts[name] += sum(c % 4 == fault for c in codes)
        n = 0
        for letter in audit:
            self.counts["cost"] += {"K": paths.KEEP, "R": paths.REROLE, "D": paths.DELETE, "I": paths.INSERT}[letter]
            if letter != "I":
                self.counts["cost"] += paths.TRUNCATED * (letter != "D" and codes[n] % 4 == 1)
                n += 1

    def _said(self, edit: str, turn, role: str, text: str) -> tuple:
        self.state = 1 if self.state == 0 and role[:1] == "s" else int(paths.NEXT[self.state])
        if self.out:
            self.digest.update(b"\n")
        self.digest.update(f"{role}:{text}".encode())
        self.out += 1
        return self.conv_id, self.out - 1, edit, turn, role, text

    def _due(self) -> str:
        return "assistant" if paths.NEXT[self.state] == 3 else "user"

    def inserted(self) -> Iterator[tuple]:
        while self.place < len(self.pending) and self.pending[self.place] == "I":
            self.place += 1
            yield self._said("I", None, self._due(), "")

    def row(self, turn, role: str, text: str) -> Iterator[tuple]:
        if turn is not None:
            self.low, self.high = (turn if self.low is None else self.low), turn
            self.turns += turn != self.seen
            self.seen = turn
        yield from self.inserted()
        edit = self.pending[self.place]
        self.place += 1
        if edit != "D":
            yield self._said(edit, turn, self._due() if edit == "R" else role, text)
        yield from self.inserted()

    def report(self) -> tuple:
        gaps = 0 if self.low is None else min(self.high - self.low + 1 - self.turns, (1 << 63) - 1)
        return self.conv_id, gaps, *self.counts.values(), "".join(self.audit), self.digest.hexdigest()


def _read(batches: Iterator[pa.RecordBatch], rows: bool) -> Iterator[tuple]:
    """Repaired rows, or a report for each conversation."""
    now = None
    for batch in batches:
        for of, conv_id, _, step, _, turn, role, text in zip(*[c.to_pylist() for c in batch.columns], strict=True):
            if now is None or of != now.of:
                if now is not None and not rows:
                    yield now.report()
                now = _Reader(of, conv_id)
            if step == 1:
                now.piece(role, text)
            elif step == 2:
                said = now.row(turn, role, text)
                if rows:
                    yield from said
                else:
                    for _ in said:
                        pass
    if now is not None and not rows:
        yield now.report()


def _as_batches(found: Iterator[tuple], schema: pa.Schema, most: int = 1 << 22) -> Iterator[pa.RecordBatch]:
    held, size = [], 0
    for row in found:
        held.append(row)
        size += 64 + sum(len(v) for v in row if isinstance(v, str))
        if size > most:
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*held, strict=True), schema.types, strict=True)], schema=schema)
            held, size = [], 0
    if held:
        yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*held, strict=True), schema.types, strict=True)], schema=schema)


def _stream(rows: DataFrame, every: DataFrame | None, bits: int) -> DataFrame:
    """Conversations, audits of pieces and turns, each conversation in one place and in order."""
    turns = ordered_turns(rows)
    solved = written(audited(pieces(turns, bits)), "audits")
    none = F.lit(None)
    kind = rows.schema["conv_id"].dataType
    known = rows.select("conv_id") if every is None else rows.select("conv_id").unionByName(every.select("conv_id"))
    heads = known.distinct().select(
        F.coalesce(F.concat(F.lit("a"), F.col("conv_id").cast("string")), F.lit("")).alias("of"), F.col("conv_id").cast(kind),
        F.lit(-1).cast("long").alias("piece"), F.lit(0).alias("step"), none.cast("long").alias("at"), none.cast("long").alias("turn"),
        none.cast("string").alias("role"), none.cast("string").alias("text"),
    )
    plans = solved.select(
        "of", none.cast(kind).alias("conv_id"), "piece", F.lit(1).alias("step"), none.cast("long").alias("at"),
        none.cast("long").alias("turn"), F.col("symbols").alias("role"), F.col("audit").alias("text"),
    )
    said = turns.select("of", "conv_id", F.shiftright("at", bits).alias("piece"), F.lit(2).alias("step"), "at", "turn", "role", "text")
    return heads.unionByName(plans).unionByName(said).repartition("of").sortWithinPartitions("of", "piece", "step", "at")


def _made(rows: DataFrame, every: DataFrame | None, bits: int, schema: str, turns: bool) -> DataFrame:
    from pyspark.sql.pandas.types import to_arrow_schema
    from pyspark.sql.types import StructType

    kind = rows.schema["conv_id"].dataType.simpleString()
    text = schema.format(kind=kind)
    arrow = to_arrow_schema(StructType.fromDDL(text))

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        yield from _as_batches(_read(batches, turns), arrow)

    return _stream(rows, every, bits).mapInArrow(work, text)


def repaired(rows: DataFrame, bits: int = PIECE_BITS) -> DataFrame:
    """The repaired turns: conv_id, place from 0, the edit that made it (K, R or I), turn, role and text."""
    return _made(rows, None, bits, TURNS, True)


def repairs(rows: DataFrame, every: DataFrame | None = None, bits: int = PIECE_BITS) -> DataFrame:
    """What is wrong with each conversation (conv_id, turn, role, text) and the edits that mend it.

    Turns stand by turn, null first, those of one turn by role and the hash of their text.  A turn is blank,
    or repeats an earlier role and text, or does not end in ``.``, ``!`` or ``?``; its first fault counts.  Edits: Keep 0, Rerole 1,
    Delete 2 (a must for blank and repeated turns), Insert 5, and 5 for a truncated turn that stays.  They
    give the order ``(s?(ua)+)?`` of roles' initials at least cost and, of these, the least audit: costs to go by dynamic
    programming, then ranks of the nodes on cheapest paths by audits of 1, 2, 4 ... edits.

    Returns conv_id, gaps, blank, duplicate, truncated, illegal, cost, audit and the SHA-256 of the repaired
    ``role:text`` lines, one row for each conv_id of ``rows`` and, where given, of ``every``.  Null roles and texts are one space, null
    conv_ids are one conversation; one without turns has zeros, an empty audit and the hash of nothing; an empty
    table gives an empty one; other columns are not looked at.  A count of gaps beyond 64 bits is given as the largest number.

    Long conversations are cut into pieces whose costs and states are joined by scans, so no task holds one.  Only
    the hash, which has no parallel form, needs a conversation's turns in one task, which reads them in order and holds one at a time.
    """
    return _made(rows, every, bits, REPORT, False)


def damaged(rows: DataFrame) -> DataFrame:
    """Conversations with faults that follow from a hash of ``conv_id:turn``; null columns read as one space.

    Of twenty, 0 drops a turn, 1 empties its text, 2 takes its ``.``, ``!`` and ``?`` out, 3 repeats it, 4 gives it to the user.
    """
    name = F.concat_ws(":", *[F.coalesce(F.col(c).cast("string"), F.lit(" ")) for c in ("conv_id", "turn")])
    text, role = F.coalesce("text", F.lit(" ")), F.coalesce("role", F.lit(" "))
    code = F.pmod(F.crc32(name), F.lit(20))
    changed = F.when(code == 1, "").when(code == 2, F.regexp_replace(text, "[.!?]", "")).otherwise(text)
    copies = F.explode(F.array_repeat(F.lit(1), F.when(code == 0, 0).when(code == 3, 2).otherwise(1)))
    return rows.select("conv_id", "turn", F.when(code == 4, "user").otherwise(role).alias("role"), changed.alias("text"), copies.alias("copy")).drop("copy")

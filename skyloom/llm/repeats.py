"""Remove byte strings that stand more than once in a corpus, by prefix-free parsing.

A rolling hash is taken of every ``GRAM`` bytes; the trigger of a string of ``length`` bytes is its gram with the
smallest hash, the first of equal ones, so that equal strings have the same trigger at the same place.  A phrase is what
all strings with one trigger span together; phrases that follow each other overlap by ``length - 1`` bytes, so
every string of ``length`` bytes lies in exactly one phrase.  The distinct phrases with their counts are the dictionary, the phrases
of a document its parse.

Of the order of suffixes only this is asked: do two agree in their first ``length`` bytes.  So the suffixes of phrases
are not sorted to their end but put into classes of equal beginnings.  A phrase that is there twice settles all its
strings.  Other phrases are looked at only if their trigger is there twice.  Their strings are first held together in
steps of ``STEP`` neighbours by the bytes these have in common, and only where those recur one by one.
"""

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from skyloom.llm.common import slices, written
from skyloom.llm.words import mix, powers, text_bytes

LENGTH = 200
GRAM = 32
STEP = 16


class Hasher:
    """Hashes of any span of some bytes, read off prefix sums of a polynomial modulo 2^64."""

    def __init__(self, data: np.ndarray):
        self.sums = np.zeros(len(data) + 1, np.uint64)
        np.cumsum((data.astype(np.uint64) + np.uint64(1)) * powers(len(data)), out=self.sums[1:])
        self.down = powers(len(data) + 1, "down")

    def spans(self, starts: np.ndarray, stops: np.ndarray) -> np.ndarray:
        return mix((self.sums[stops] - self.sums[starts]) * self.down[starts] + mix((stops - starts).astype(np.uint64)))

    def grams(self, size: int) -> np.ndarray:
        return mix((self.sums[size:] - self.sums[:-size]) * self.down[: len(self.sums) - size])


class Phrases:
    """The phrases of some texts: text, first and last start of a string, place of the trigger, hashes of trigger and phrase."""

    def __init__(self, data: np.ndarray, at: np.ndarray, length: int):
        empty = np.zeros(0, np.int64)
        self.text, self.first, self.last, self.trigger = empty, empty, empty, empty
        self.gram = self.phrase = np.zeros(0, np.uint64)
        counts = np.maximum(np.diff(at) - length + 1, 0)
        if not counts.sum():
            return
        hasher = Hasher(data)
        gram_size = min(GRAM, length)
        grams = hasher.grams(gram_size)
        least = _sliding_least((grams & np.uint64(0xFFFFFFFF00000000)) | np.arange(len(grams), dtype=np.uint64), length - gram_size + 1)
        upto = np.cumsum(counts)
        start = np.arange(upto[-1]) + np.repeat(at[:-1] - (upto - counts), counts)
        text = np.repeat(np.arange(len(counts)), counts)
        trigger = (least[start] & np.uint64(0xFFFFFFFF)).astype(np.int64)
        new = np.ones(len(start), bool)
        new[1:] = (trigger[1:] != trigger[:-1]) | (text[1:] != text[:-1])
        begins = np.flatnonzero(new)
        ends = np.concatenate([begins[1:], [len(start)]]) - 1
        self.text, self.trigger, self.first, self.last = text[begins], trigger[begins], start[begins], start[ends]
        self.gram = grams[self.trigger]
        shape = ((self.trigger - self.first) << 32 | (self.trigger - self.last)).astype(np.uint64)
        self.phrase = mix(hasher.spans(self.first, self.last + length) + mix(shape))


def _sliding_least(values: np.ndarray, width: int) -> np.ndarray:
    """The least of each run of ``width`` values, from running minima of blocks in both directions."""
    blocks = -(-len(values) // width)
    table = np.full(blocks * width, np.iinfo(np.uint64).max, np.uint64)
    table[: len(values)] = values
    table = table.reshape(blocks, width)
    ahead = np.minimum.accumulate(table, axis=1).ravel()
    back = np.minimum.accumulate(table[:, ::-1], axis=1)[:, ::-1].ravel()
    n = len(values) - width + 1
    return np.minimum(back[:n], ahead[width - 1 : width - 1 + n])


def _signed(values: np.ndarray) -> pa.Array:
    return pa.array(np.ascontiguousarray(values).view(np.int64))


def _rows(docs: DataFrame) -> DataFrame:
    return docs.select("doc_id", F.xxhash64("doc_id", "text").alias("row_key"), F.col("text").cast("string").alias("text"))


def parse(docs: DataFrame, length: int) -> DataFrame:
    """The distinct phrases of each row, with ``times`` 2 where the row has it more than once."""

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch, "text"):
                found = Phrases(*text_bytes(part.column("text")), length)
                order = np.lexsort((found.phrase, found.text))
                text, phrase, gram = found.text[order], found.phrase[order], found.gram[order]
                new = np.ones(len(text), bool)
                new[1:] = (text[1:] != text[:-1]) | (phrase[1:] != phrase[:-1])
                at = np.flatnonzero(new)
                times = np.minimum(np.diff(np.concatenate([at, [len(text)]])), 2)
                yield pa.RecordBatch.from_arrays(
                    [part.column("row_key").take(pa.array(text[at])), _signed(gram[at]), _signed(phrase[at]), pa.array(times.astype(np.int64))],
                    names=["row_key", "gram", "phrase", "times"],
                )

    return _rows(docs).select("row_key", "text").mapInArrow(scan, "row_key long, gram long, phrase long, times long")


def _contents(docs: DataFrame, wanted: DataFrame, length: int) -> DataFrame:
    """The bytes of the phrases that ``wanted`` names (row_key, phrases)."""

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch, "text"):
                data, at = text_bytes(part.column("text"))
                found = Phrases(data, at, length)
                asked = part.column("phrases").flatten().to_numpy().view(np.uint64)
                hit = np.flatnonzero(np.isin(found.phrase, asked))
                raw = data.tobytes()
                spans = zip(found.first[hit].tolist(), found.last[hit].tolist(), strict=True)
                yield pa.RecordBatch.from_arrays(
                    [
                        _signed(found.phrase[hit]),
                        pa.array((found.trigger - found.first)[hit].astype(np.int32)),
                        pa.array((found.trigger - found.last)[hit].astype(np.int32)),
                        pa.array([raw[a : b + length] for a, b in spans], pa.binary()),
                    ],
                    names=["phrase", "most", "least", "content"],
                )

    texts = _rows(docs).select("row_key", "text").join(wanted, "row_key")
    return texts.mapInArrow(scan, "phrase long, most int, least int, content binary")


def _steps(contents: DataFrame, length: int) -> DataFrame:
    """A row for each step of strings in a phrase, with a hash of what the strings of the step have in common."""

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch, "content"):
                data, at = text_bytes(part.column("content"))
                most, least = (part.column(c).to_numpy().astype(np.int64) for c in (1, 2))
                counts = most // STEP - least // STEP + 1
                row = np.repeat(np.arange(len(counts)), counts)
                step = np.arange(counts.sum()) - np.repeat(np.cumsum(counts) - counts - least // STEP, counts)
                start = at[row] + most[row] - STEP * step
                key = mix(Hasher(data).spans(start, start + length - STEP + 1) + step.astype(np.uint64))
                yield pa.RecordBatch.from_arrays([_signed(key), part.column(0).take(pa.array(row)), pa.array(step.astype(np.int32))], names=["key", "phrase", "step"])

    return contents.select("phrase", "most", "least", "content").mapInArrow(scan, "key long, phrase long, step int")


def _strings(steps: DataFrame, length: int) -> DataFrame:
    """A row for each string of the given steps: its hash, phrase and distance to the trigger."""

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch, "content"):
                data, at = text_bytes(part.column("content"))
                step, most, least = (part.column(c).to_numpy().astype(np.int64) for c in (1, 2, 3))
                low, high = np.maximum(least, step * STEP), np.minimum(most, step * STEP + STEP - 1)
                counts = high - low + 1
                row = np.repeat(np.arange(len(counts)), counts)
                away = np.arange(counts.sum()) - np.repeat(np.cumsum(counts) - counts - low, counts)
                start = at[row] + most[row] - away
                yield pa.RecordBatch.from_arrays(
                    [_signed(Hasher(data).spans(start, start + length)), part.column(0).take(pa.array(row)), pa.array(away.astype(np.int32))],
                    names=["key", "phrase", "away"],
                )

    return steps.select("phrase", "step", "most", "least", "content").mapInArrow(scan, "key long, phrase long, away int")


def _recurring(rows: DataFrame) -> DataFrame:
    """The rows whose key is there more than once; keys are counted before the shuffle."""
    keys = rows.groupBy("key").agg(F.count(F.lit(1)).alias("n")).where("n > 1").select("key")
    return rows.join(keys, "key", "left_semi")


def repeated(docs: DataFrame, length: int) -> DataFrame:
    """By row_key, the phrases with repeated strings: ``away`` lists the strings' distances to the trigger, null means all."""
    grams = parse(docs, length).groupBy("gram").agg(F.sum("times").alias("n")).where("n > 1").select("gram")
    often = written(parse(docs, length).join(grams, "gram", "left_semi"), "parse")
    dictionary = written(often.groupBy("gram", "phrase").agg(F.sum("times").alias("n"), F.min("row_key").alias("row_key")), "dictionary")
    several = dictionary.groupBy("gram").agg(F.count(F.lit(1)).alias("phrases")).where("phrases > 1").select("gram")
    open_ones = dictionary.join(several, "gram", "left_semi")
    # A list per document, as long as its parse.
    wanted = open_ones.groupBy("row_key").agg(F.collect_list("phrase").alias("phrases"))
    contents = written(_contents(docs, wanted, length).dropDuplicates(["phrase"]), "phrases")
    steps = _recurring(_steps(contents, length)).select("phrase", "step").join(contents, "phrase")
    alone = dictionary.where("n = 1").select("phrase")
    strings = _recurring(_strings(steps, length)).join(alone, "phrase", "left_semi")
    some = strings.groupBy("phrase").agg(F.collect_set("away").alias("away"))
    none = F.lit(None).cast("array<int>")
    flagged = written(dictionary.where("n > 1").select("phrase", none.alias("away")).unionByName(some), "repeats")
    return often.select("row_key", "phrase").distinct().join(flagged, "phrase").groupBy("row_key").agg(F.collect_list(F.struct("phrase", "away")).alias("found"))


def without_repeats(docs: DataFrame, length: int = LENGTH) -> DataFrame:
    """Every row of ``docs`` (doc_id, text) without the bytes that a repeated string of ``length`` bytes covers.

    A string is repeated if it starts anywhere else in the input, in the same row or another; strings never span two rows, may overlap,
    and are judged on the input.  All occurrences go, the first too.  Returns doc_id, n_bytes, n_removed, n_spans,
    kept (the bytes that stay, which need not be whole characters), kept_sha256, and starts and stops of
    the removed runs.  A null or empty text, and one shorter than ``length``, keeps all; rows repeated with the same doc_id and text
    are repeats of each other; an empty table gives an empty one; other columns are not looked at.
    """
    found = repeated(docs, length)
    # Rows that are equal in doc_id and text share a row_key; their phrases are all there more than once.
    again = _rows(docs).groupBy("row_key").agg(F.count(F.lit(1)).alias("n")).where("n > 1").select("row_key", F.lit(True).alias("again"))
    rows = _rows(docs).join(found, "row_key", "left").join(again, "row_key", "left").select("doc_id", "text", "found", "again")
    names = ["doc_id", "n_bytes", "n_removed", "n_spans", "kept", "kept_sha256", "starts", "stops"]

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch, "text"):
                data, at = text_bytes(part.column("text"))
                covered = _covered(data, at, part.column("found"), part.column("again").to_pylist(), length)
                edge = np.diff(covered.astype(np.int8), prepend=0, append=0)
                inner = at[1:-1][(at[1:-1] > 0) & (at[1:-1] < len(data))]
                both = inner[covered[inner] & covered[inner - 1]]
                begins = np.sort(np.concatenate([np.flatnonzero(edge > 0), both]))
                ends = np.sort(np.concatenate([np.flatnonzero(edge < 0), both]))
                which = np.searchsorted(begins, at)
                out = []
                for row, (a, b) in enumerate(zip(at[:-1].tolist(), at[1:].tolist(), strict=True)):
                    kept = data[a:b][~covered[a:b]].tobytes()
                    lo, hi = which[row], which[row + 1]
                    out.append((b - a, b - a - len(kept), hi - lo, kept, hashlib.sha256(kept).hexdigest(), begins[lo:hi] - a, ends[lo:hi] - a))
                types = [pa.int64(), pa.int64(), pa.int64(), pa.binary(), pa.string(), pa.list_(pa.int64()), pa.list_(pa.int64())]
                columns = [pa.array(list(x), t) for x, t in zip(zip(*out, strict=True), types, strict=True)]
                yield pa.RecordBatch.from_arrays([part.column("doc_id"), *columns], names=names)

    kinds = ["long", "long", "long", "binary", "string", "array<long>", "array<long>"]
    id_type = docs.schema["doc_id"].dataType.simpleString()
    return rows.mapInArrow(cut, ", ".join(f"{n} {k}" for n, k in zip(names, [id_type, *kinds], strict=True)))


def _covered(data: np.ndarray, at: np.ndarray, found: pa.Array, again: list, length: int) -> np.ndarray:
    """Which bytes a repeated string covers."""
    lists = found.to_pylist()
    change = np.zeros(len(data) + 1, np.int64)
    for row, twice in enumerate(again):
        if twice and at[row + 1] - at[row] >= length:
            change[at[row]] += 1
            change[at[row + 1]] -= 1
    known = {x["phrase"]: x["away"] for items in lists if items for x in items}
    if known:
        phrases = Phrases(data, at, length)
        hit = np.flatnonzero(np.isin(phrases.phrase, np.fromiter(known, np.int64, len(known)).view(np.uint64)))
        for i in hit.tolist():
            away = known[int(phrases.phrase[i].view(np.int64))]
            if away is None:
                change[phrases.first[i]] += 1
                change[phrases.last[i] + length] -= 1
            else:
                starts = phrases.trigger[i] - np.array(away)
                np.add.at(change, starts, 1)
                np.add.at(change, starts + length, -1)
    return np.cumsum(change[:-1]) > 0

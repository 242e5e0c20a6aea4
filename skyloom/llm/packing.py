"""Best-two-fit packing of tokenized documents into sequences of a fixed length."""

import os
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from skyloom.llm.common import block_count, running_before, slices, written
from skyloom.llm.words import lowered, span_hashes, text_bytes, word_spans

PIECES = "doc_id long, piece int, start long, length long, ids_crc32 long"


class WordTokens:
    """Token ids of whole texts, where each distinct word is given to the tokenizer once.

    For tokenizers that drop white space and mark the ends of words, so that the ids of a text are those of its
    words, one after the other.  A word of letters, with or without one full stop or comma behind it, is looked up in
    lower case and without that sign, which is a token of its own; all other words are looked up as they are.  The
    memory of words is sorted arrays; it is emptied when it holds ``most`` of them.
    """

    def __init__(self, path: str, most: int = 1_500_000):
        # A task has one core; the library's own threads would also each keep memory.
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.tokenizer, self.most = Tokenizer.from_file(path), most
        suffix = self.tokenizer.model.end_of_word_suffix
        if not suffix:
            raise ValueError("the tokenizer does not mark the ends of words")
        self.ends = np.zeros(self.tokenizer.get_vocab_size(), bool)
        self.ends[[i for token, i in self.tokenizer.get_vocab().items() if token.endswith(suffix)]] = True
        self.signs = np.array([0, *(self.tokenizer.encode(x, add_special_tokens=False).ids[0] for x in ".,")], np.uint32)
        self.clear()

    def clear(self) -> None:
        self.hashes = np.zeros(0, np.uint64)
        self.entries = np.zeros(0, np.int64)
        self.lengths = np.zeros(0, np.int32)
        self.starts = np.zeros(0, np.int64)
        self.ids = np.zeros(0, np.uint32)

    def learn(self, hashes: np.ndarray, plain: list[str], others: list[str]) -> None:
        """Add words: ``hashes`` has those of ``plain`` (one run of letters each) first, then those of ``others``."""
        texts = [" ".join(plain[i : i + 200]) for i in range(0, len(plain), 200)]
        runs = [np.array(x.ids, np.uint32) for x in self.tokenizer.encode_batch_fast(texts, add_special_tokens=False)]
        flat = np.concatenate([*runs, np.zeros(0, np.uint32)])
        lengths = np.diff(np.flatnonzero(self.ends[flat]), prepend=-1)
        if len(lengths) != len(plain):
            raise ValueError("a run of letters is not one word to the tokenizer")
        rest = [np.array(x.ids, np.uint32) for x in self.tokenizer.encode_batch_fast(others, add_special_tokens=False)]
        lengths = np.concatenate([lengths, np.array([len(x) for x in rest], np.int64)])
        at, entry = np.searchsorted(self.hashes, hashes), len(self.lengths) + np.arange(len(hashes))
        order = np.argsort(hashes)
        self.hashes = np.insert(self.hashes, at[order], hashes[order])
        self.entries = np.insert(self.entries, at[order], entry[order])
        self.starts = np.concatenate([self.starts, len(self.ids) + np.cumsum(lengths) - lengths])
        self.lengths = np.concatenate([self.lengths, lengths.astype(np.int32)])
        self.ids = np.concatenate([self.ids, flat, *rest])

    def encode(self, texts: pa.Array, end: int) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all texts after each other, each followed by ``end``, and where each text's ids begin."""
        data, at = text_bytes(texts)
        starts, stops, first = word_spans(data, at)
        low = lowered(data)
        tail = np.zeros(len(starts), np.int64)
        if len(starts):
            sign = data[stops - 1]
            tail = np.where(stops - starts > 1, (sign == 46) + 2 * (sign == 44), 0)
        upto = np.concatenate([[0], np.cumsum(_letters(low))])
        core = stops - (tail > 0)
        plain = upto[core] - upto[starts] == core - starts
        tail[~plain] = 0
        hashes = np.where(plain, span_hashes(low, starts, core), ~span_hashes(data, starts, stops))
        unique, example, back = np.unique(hashes, return_index=True, return_inverse=True)
        if len(self.hashes) + len(unique) > self.most:
            self.clear()
        found = np.searchsorted(self.hashes, unique)
        new = np.ones(len(unique), bool)
        inside = found < len(self.hashes)
        new[inside] = self.hashes[found[inside]] != unique[inside]
        if new.any():
            where = example[new]
            order = np.argsort(~plain[where], kind="stable")
            where, letters = where[order], int(plain[where].sum())
            words = [raw[a:b].decode() for raw, part, stop in ((low.tobytes(), where[:letters], core), (data.tobytes(), where[letters:], stops)) for a, b in zip(starts[part].tolist(), stop[part].tolist(), strict=True)]
            self.learn(unique[new][order], words[:letters], words[letters:])
            found = np.searchsorted(self.hashes, unique)
        entry = self.entries[found][back]
        lengths = self.lengths[entry].astype(np.int64)
        upto = np.concatenate([[0], np.cumsum(lengths + (tail > 0))])
        begin = upto[first] + np.arange(len(first))
        ids = np.full(begin[-1], end, np.uint32)
        text = np.repeat(np.arange(len(first) - 1), np.diff(first))
        count = _counting(lengths)
        ids[np.repeat(upto[:-1] + text, lengths) + count] = self.ids[np.repeat(self.starts[entry], lengths) + count]
        signed = tail > 0
        ids[(upto[1:] + text - 1)[signed]] = self.signs[tail[signed]]
        return ids, begin


def _letters(data: np.ndarray) -> np.ndarray:
    """Bytes of lower-case ASCII letters and of the letters U+00C0 to U+00FF in UTF-8, which stand for themselves in NFC."""
    second = (data >= 0x80) & (data <= 0xBF) & (data != 0x97) & (data != 0xB7)
    lead = data == 0xC3
    pair = np.zeros(len(data), bool)
    pair[1:] = second[1:] & lead[:-1]
    both = pair.copy()
    both[:-1] |= pair[1:]
    return both | ((data >= 97) & (data <= 122))


def _counting(lengths: np.ndarray) -> np.ndarray:
    """0, 1, ... anew for each length."""
    upto = np.cumsum(lengths)
    return np.arange(upto[-1] if len(upto) else 0) - np.repeat(upto - lengths, lengths)


def pieces(docs: DataFrame, tokenizer: str, size: int = 4096, end: int = 1) -> DataFrame:
    """Token pieces of at most ``size`` ids of each document of ``docs`` (doc_id, text), as sizes and checksums."""

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        words = WordTokens(tokenizer)
        for batch in batches:
            for part in slices(batch, "text"):
                ids, begin = words.encode(part.column("text"), end)
                rows = []
                for row, (a, b) in enumerate(zip(begin[:-1].tolist(), begin[1:].tolist(), strict=True)):
                    for k, start in enumerate(range(a, b, size)):
                        stop = min(b, start + size)
                        rows.append((row, k, start - a, stop - start, zlib.crc32(ids[start:stop].astype("<u4").tobytes())))
                row, piece, start, length, crc = (np.array(x, np.int64) for x in zip(*rows, strict=True))
                yield pa.RecordBatch.from_arrays(
                    [part.column("doc_id").take(pa.array(row)), pa.array(piece.astype(np.int32)), pa.array(start), pa.array(length), pa.array(crc)],
                    names=["doc_id", "piece", "start", "length", "ids_crc32"],
                )

    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text")).mapInArrow(cut, PIECES)


def plan(counts: dict[int, int], size: int) -> list[tuple[int, list[tuple[int, int]]]]:
    """Patterns of lengths and how often each is used, from the number of pieces of each length.

    A pattern starts with the largest length left and is filled with the largest that still fits.  If a gap
    remains, its smallest piece is replaced by the two lengths left that fill the gap and that piece's room best,
    where they fill more of it.  The pattern is used as often as the lengths last, so there are at most a few
    patterns for each length, however many pieces there are.
    """
    left = np.zeros(size + 1, np.int64)
    for length, count in counts.items():
        left[length] = count
    patterns = []
    fits = _fits(left)
    while fits[size]:
        used: dict[int, int] = {}
        gap = size
        while gap:
            length = int(fits[gap])
            while length and left[length] <= used.get(length, 0):
                length = int(fits[length - 1])
            if not length:
                break
            take = min(gap // length, int(left[length]) - used.get(length, 0))
            used[length] = used.get(length, 0) + take
            gap -= take * length
        if gap:
            _two_for_one(used, gap, left)
        times = min(int(left[length]) // n for length, n in used.items())
        patterns.append((times, sorted(used.items(), reverse=True)))
        for length, n in used.items():
            left[length] -= times * n
        fits = _fits(left)
    return patterns


def _fits(left: np.ndarray) -> np.ndarray:
    """By room, the largest length left that fits it; 0 where none does."""
    return np.maximum.accumulate(np.where(left > 0, np.arange(len(left)), 0))


def _two_for_one(used: dict[int, int], gap: int, left: np.ndarray) -> None:
    smallest = min(used)
    room = gap + smallest
    free = left.copy()
    for length, n in used.items():
        free[length] -= n
    free[smallest] += 1
    fits = _fits(free)
    first = np.flatnonzero(free[: room + 1] > 0)
    first = first[first > 0]
    second = fits[room - first]
    twice = (second == first) & (free[first] < 2)
    second = np.where(twice, fits[np.maximum(second - 1, 0)], second)
    filled = np.where(second > 0, first + second, 0)
    if len(filled) and filled.max() > smallest:
        best = int(filled.argmax())
        used[smallest] -= 1
        if not used[smallest]:
            del used[smallest]
        for length in (int(first[best]), int(second[best])):
            used[length] = used.get(length, 0) + 1


def assigned(ranked: DataFrame, patterns: list[tuple[int, list[tuple[int, int]]]]) -> DataFrame:
    """Give each piece, by its rank among those of its length, a sequence and an offset in it."""
    places: dict[int, list[tuple[int, int, int, int]]] = {}
    used: dict[int, int] = {}
    sequence = 0
    for times, pattern in patterns:
        offset = 0
        for length, n in pattern:
            start = used.get(length, 0)
            places.setdefault(length, []).append((start, n, sequence, offset))
            used[length] = start + times * n
            offset += n * length
        sequence += times
    table = {length: np.array(rows, np.int64) for length, rows in places.items()}

    def give(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            length, rank = (batch.column(batch.schema.get_field_index(c)).to_numpy(zero_copy_only=False) for c in ("length", "rank"))
            to, offset = np.empty(len(length), np.int64), np.empty(len(length), np.int64)
            for one in np.unique(length):
                rows, at = table[int(one)], np.flatnonzero(length == one)
                found = rows[np.searchsorted(rows[:, 0], rank[at], side="right") - 1]
                nth = rank[at] - found[:, 0]
                to[at] = found[:, 2] + nth // found[:, 1]
                offset[at] = found[:, 3] + nth % found[:, 1] * one
            columns = [batch.column(batch.schema.get_field_index(c)) for c in ("doc_id", "piece", "start", "length", "ids_crc32")]
            yield pa.RecordBatch.from_arrays([*columns, pa.array(to), pa.array(offset)], names=[*_names(PIECES), "sequence_id", "offset"])

    return ranked.mapInArrow(give, PIECES + ", sequence_id long, offset long")


def _names(schema: str) -> list[str]:
    return [x.split()[0] for x in schema.split(", ")]


def pack(docs: DataFrame, tokenizer: str, size: int = 4096, end: int = 1) -> DataFrame:
    """Pack ``docs`` (doc_id, text) into as few sequences of at most ``size`` token ids as the method finds.

    Only the number of pieces of each length, at most ``size`` rows, comes to the driver, where best-two-fit
    plans patterns of lengths.  Each piece then takes the place that belongs to its rank among all pieces of its
    length.  Ranks are formed over blocks, so a length that very many documents share is no hot group.

    Returns one row per piece: doc_id, piece, start, length, ids_crc32, sequence_id, offset (ids before it in
    the sequence).  A null or empty text is the end id alone; repeated rows are packed as often as they are there
    and take each other's places; an empty table gives an empty one; other columns are not looked at.
    """
    cut = written(pieces(docs, tokenizer, size, end), "pieces")
    counts = {row["length"]: row["count"] for row in cut.groupBy("length").count().collect()}
    blocks = block_count(max(counts.values(), default=0))
    blocked = cut.withColumn("block", F.pmod(F.xxhash64("doc_id", "piece", "ids_crc32"), F.lit(blocks)))
    ranked = running_before(blocked, "length", "block", ["doc_id", "piece", "start", "ids_crc32"], name="rank")
    return assigned(ranked, plan(counts, size))

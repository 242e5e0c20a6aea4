"""Line dedup by a tree of line templates: lines whose template recurs across documents are dropped.

The tree has a fixed depth.  Its first level is a line's number of tokens, the next ones its leading tokens, where
a token with a digit counts as a variable field.  In a leaf a token is kept at its place if that many documents have
it there as a template needs; all others are variable fields.  What is left is the line's template.  Counts do
not depend on an order of lines, so leaves need no task of their own.
"""

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from skyloom.llm.common import slices, written
from skyloom.llm.words import mix, span_hashes, text_bytes, word_spans

FIELD = np.uint64(0x66690E1D)  # stands for a token with a digit


class Lines:
    """The lines of some texts: text, number of tokens, leaf of the tree, and a hash of the line's tokens.

    Lines end at line feeds.  Texts follow each other in ``data``; line ``i`` has the tokens
    ``first[i]`` to ``first[i + 1]`` and the bytes ``begins[i]`` to ``ends[i]``.
    """

    def __init__(self, texts: pa.Array, depth: int):
        self.data, at = text_bytes(texts)
        starts, stops, _ = word_spans(self.data, at)
        feeds = np.flatnonzero(self.data == 10)
        full = np.diff(at) > 0
        self.begins = np.sort(np.concatenate([at[:-1][full], feeds + 1]))
        self.ends = np.sort(np.concatenate([at[1:][full], feeds]))
        lines = np.where(full, np.diff(np.searchsorted(feeds, at)) + 1, 0)
        self.text = np.repeat(np.arange(len(lines)), lines)
        self.first = np.searchsorted(starts, np.concatenate([self.begins, [len(self.data)]]))
        digits = np.concatenate([[0], np.cumsum((self.data >= 48) & (self.data <= 57))])
        self.tokens = np.where(digits[stops] > digits[starts], FIELD, span_hashes(self.data, starts, stops))
        self.count = np.diff(self.first)
        place = np.arange(len(self.tokens)) - np.repeat(self.first[:-1], self.count)
        placed = mix(self.tokens + mix(place.astype(np.uint64) + np.uint64(1)))
        size = mix(self.count.astype(np.uint64))
        self.line = mix(self._sums(placed) + size)
        self.leaf = mix(self._sums(np.where(place < depth, placed, np.uint64(0))) + size + np.uint64(1))

    def _sums(self, values: np.ndarray) -> np.ndarray:
        upto = np.concatenate([np.zeros(1, np.uint64), np.cumsum(values, dtype=np.uint64)])
        return upto[self.first[1:]] - upto[self.first[:-1]]


def _signed(values: np.ndarray) -> pa.Array:
    return pa.array(np.ascontiguousarray(values).view(np.int64))


def _texts(docs: DataFrame) -> DataFrame:
    return docs.select(F.xxhash64("doc_id", "text").alias("row_key"), F.col("text").cast("string").alias("text"))


def lines_of(docs: DataFrame, depth: int, least_tokens: int) -> DataFrame:
    """The distinct lines of each document that are long enough; ``every`` counts the tokens of all its distinct lines."""

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch, "text"):
                found = Lines(part.column("text"), depth)
                order = np.lexsort((found.line, found.text))
                new = np.ones(len(order), bool)
                text, line = found.text[order], found.line[order]
                new[1:] = (text[1:] != text[:-1]) | (line[1:] != line[:-1])
                one = order[new]
                every = np.bincount(found.text[one], found.count[one], minlength=part.num_rows).astype(np.int64)
                one = one[found.count[one] >= least_tokens]
                at = found.text[one]
                yield pa.RecordBatch.from_arrays(
                    [part.column("row_key").take(pa.array(at)), _signed(found.leaf[one]), _signed(found.line[one]), pa.array(found.count[one]), pa.array(every[at])],
                    names=["row_key", "leaf", "id", "tokens", "every"],
                )

    return _texts(docs).mapInArrow(scan, "row_key long, leaf long, id long, tokens long, every long")


def _tokens_of(docs: DataFrame, wanted: DataFrame, depth: int) -> DataFrame:
    """The tokens, as hashes, of the lines that ``wanted`` lists by document."""

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch, "text"):
                found = Lines(part.column("text"), depth)
                asked = part.column("ids")
                ids = asked.flatten().to_numpy().view(np.uint64)
                owner = np.repeat(np.arange(part.num_rows), pc.list_value_length(asked).to_numpy())
                known = {}
                for text, line, i in zip(found.text.tolist(), found.line.tolist(), range(len(found.line)), strict=True):
                    known.setdefault((text, line), i)
                rows = np.array([known[key] for key in zip(owner.tolist(), ids.tolist(), strict=True)], np.int64)
                count = found.count[rows]
                at = np.arange(count.sum()) - np.repeat(np.cumsum(count) - count, count)
                yield pa.RecordBatch.from_arrays(
                    [_signed(np.repeat(ids, count)), pa.array(at.astype(np.int32)), _signed(found.tokens[np.repeat(found.first[rows], count) + at])],
                    names=["id", "at", "token"],
                )

    return _texts(docs).join(wanted.hint("merge"), "row_key").mapInArrow(scan, "id long, at int, token long")


def recurring_lines(docs: DataFrame, documents: int = 10, depth: int = 3, least_tokens: int = 3) -> DataFrame:
    """row_key and the hashes of the lines to drop from that document."""
    lines = written(lines_of(docs, depth, least_tokens), "lines")
    leaves = lines.groupBy("leaf").agg(F.count(F.lit(1)).alias("n")).where(F.col("n") >= documents).select("leaf")
    often = written(lines.join(leaves, "leaf", "left_semi").distinct(), "leaf-lines")

    shapes = often.groupBy("leaf", "id", "tokens").agg(F.count(F.lit(1)).alias("n"), F.min("row_key").alias("row_key"))
    # A list per document, as long as its lines.
    wanted = shapes.groupBy("row_key").agg(F.collect_list("id").alias("ids"))
    places = _tokens_of(docs, wanted, depth).distinct().join(shapes.select("id", "leaf", "tokens", "n"), "id")
    places = written(places, "tokens")
    firm = places.groupBy("leaf", "at", "token").agg(F.sum("n").alias("n")).where(F.col("n") >= documents)
    firm = firm.select("leaf", "at", "token", F.lit(True).alias("firm"))
    judged = places.join(firm, ["leaf", "at", "token"], "left")
    field = F.lit(int(FIELD)).cast("long")
    # One list per distinct line, as long as the line.
    token = F.when(F.col("firm") & (F.col("token") != field), F.col("token")).otherwise(field)
    shaped = judged.groupBy("leaf", "id", "tokens").agg(
        F.array_sort(F.collect_list(F.struct("at", token.alias("token")))).alias("parts"), F.count_if(token == field).alias("fields")
    )
    template = F.xxhash64("leaf", F.transform("parts", lambda p: p.token))
    shaped = shaped.where(2 * F.col("fields") <= F.col("tokens")).select("id", template.alias("template"))
    in_docs = written(often.join(shaped, "id").select("row_key", "id", "tokens", "every", "template"), "templates")

    def recurring(rows: DataFrame) -> DataFrame:
        each = rows.select("row_key", "template").distinct()
        return each.groupBy("template").agg(F.count(F.lit(1)).alias("n")).where(F.col("n") >= documents).select("template")

    shared = in_docs.join(recurring(in_docs), "template", "left_semi")
    same = shared.groupBy("row_key").agg(F.sum("tokens").alias("same"), F.max("every").alias("every"))
    copies = same.where(2 * F.col("same") > F.col("every")).select("row_key")
    rest = written(in_docs.join(copies, "row_key", "left_anti"), "no-copies")
    dropped = rest.join(recurring(rest), "template", "left_semi")
    return dropped.groupBy("row_key").agg(F.collect_set("id").alias("drop"))


def without_recurring_lines(docs: DataFrame, documents: int = 10, depth: int = 3, least_tokens: int = 3) -> DataFrame:
    """Every row of ``docs`` (doc_id, text, more) without the lines whose template recurs in ``documents`` or more of them.

    Adds ``kept_text``, ``n_lines`` and ``n_dropped`` beside ``row``, the input row.  A template must keep at least
    half of its tokens, and a line at least ``least_tokens``.  A document of which more than half the words stand in
    recurring lines is a copy of others: it is left whole, for near-dedup to decide on, and does not count when
    templates are counted again.  No row is dropped.  A null or empty text has no lines; a row repeated with the same
    doc_id and text is one document; an empty table gives an empty one; a text of one very long line is one line.
    """
    # The drops grow with the documents: they are merged with the texts, never broadcast.
    drops = recurring_lines(docs, documents, depth, least_tokens).hint("merge")
    row = F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row")
    rows = docs.select(row, F.xxhash64("doc_id", "text").alias("row_key"), F.col("text").cast("string").alias("text"))

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch, "text"):
                found = Lines(part.column("text"), depth)
                lines = np.bincount(found.text, minlength=part.num_rows)
                gone = np.zeros(part.num_rows, np.int64)
                texts = part.column("text").to_pylist()
                upto = np.concatenate([[0], np.cumsum(lines)])
                for i, drop in enumerate(part.column("drop").to_pylist()):
                    if drop:
                        own = found.line[upto[i] : upto[i + 1]].view(np.int64)
                        stays = ~np.isin(own, drop)
                        gone[i] = len(own) - stays.sum()
                        texts[i] = "\n".join(x for x, keep in zip(texts[i].split("\n"), stays.tolist(), strict=True) if keep)
                yield pa.RecordBatch.from_arrays(
                    [part.column("row"), pa.array(texts, pa.string()), pa.array(lines.astype(np.int64)), pa.array(gone)],
                    names=["row", "kept_text", "n_lines", "n_dropped"],
                )

    schema = T.StructType().add("row", docs.schema).add("kept_text", "string").add("n_lines", "long").add("n_dropped", "long")
    return rows.join(drops, "row_key", "left").select("row", "text", "drop").mapInArrow(cut, schema)


def cleaned(docs: DataFrame, **options) -> DataFrame:
    """The rows of ``docs`` with the kept lines as their text, and n_chars to match where there is such a column."""
    rows = without_recurring_lines(docs, **options)
    fields = []
    for c in docs.columns:
        if c == "text":
            fields.append(F.col("kept_text").alias("text"))
        elif c == "n_chars":
            size = F.when(F.col("n_dropped") == 0, F.col("row.n_chars")).otherwise(F.length("kept_text"))
            fields.append(size.cast(docs.schema[c].dataType).alias(c))
        else:
            fields.append(F.col(f"row.`{c}`").alias(c))
    return rows.select(*fields)

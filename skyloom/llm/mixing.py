"""Mix sources to target weights: each source is read in a random order, more than once if its target asks for it."""

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from skyloom.llm.common import block_count, running_before, written
from skyloom.operators.scale import row_ordinals

WORD = r"[^\x20\x09-\x0D]+"


def word_count(text: Column) -> Column:
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")


def random_key(doc_id: Column, text: Column) -> Column:
    """A hash that stands for a random number: it is the same in every run and spreads rows without an id by text."""
    return F.md5(F.concat(F.coalesce(doc_id.cast("string"), F.lit("")), F.lit(":"), F.coalesce(text, F.lit(""))))


def source_key(source: Column) -> Column:
    """A source's name as a text that is never null and sorts by code point, null last."""
    return F.when(source.isNotNull(), F.concat(F.lit("a"), source)).otherwise(F.lit("b"))


def targets(sizes: DataFrame, share: float, most: float) -> DataFrame:
    """Add ``target`` to a table of ``source_size`` and ``weight``, one row per source.

    Together the targets are ``share`` times all sizes.  None is above ``most`` times its source's size; what
    is above is shared anew by weight until none is.  Only sums reach the driver.
    """
    bound = F.col("source_size") * float(most)
    total, weights = sizes.agg(F.sum("source_size"), F.sum("weight")).first()
    level, full = (share * total / weights if weights else 0.0), -1
    while True:
        above = bound < F.lit(level) * F.col("weight")
        used, weight, count = sizes.where(above).agg(F.sum(bound), F.sum("weight"), F.count(F.lit(1))).first()
        if count == full or not count or weight == weights:
            break
        level, full = (share * total - used) / (weights - weight), count
    return sizes.withColumn("target", F.least(bound, F.lit(level) * F.col("weight")))


def mix(
    docs: DataFrame,
    weights: Sequence[float] = (5, 2, 1),
    share: float = 1.5,
    most: float = 2.0,
    keep_rows: bool = False,
) -> DataFrame:
    """How many words of each document a mix of the sources takes.

    ``docs`` has doc_id, text and source.  Sources in the order of their code points, null last, weigh
    ``weights``, repeating.  Every document gets a random key; the documents of a source stand in the order of
    their keys, prefix sums of their words are formed over blocks of keys, and each reading of the source (epoch)
    ends exactly at its target: ``taken`` is the whole document times the full epochs, plus what the last
    epoch takes, which is all words, none, or at the very end the first few.

    Returns doc_id, source, size, source_size, target, epochs, last, taken; with ``keep_rows`` also ``row``, the
    input row.  A null or empty text has no words and none taken; null sources are one source; a row that is
    repeated takes part as often as it is there; an empty table gives an empty one.  Other columns of
    ``docs`` are not looked at.
    """
    kept = [F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row")] if keep_rows else []
    sized = docs.select(
        F.col("doc_id"),
        F.col("source"),
        source_key(F.col("source")).alias("of"),
        word_count(F.col("text")).alias("size"),
        random_key(F.col("doc_id"), F.col("text")).alias("key"),
        *kept,
    )
    if not keep_rows:
        sized = written(sized, "sized")
    per_source = written(sized.groupBy("of").agg(F.sum("size").alias("source_size"), F.count(F.lit(1)).alias("rows")), "sources")
    largest = per_source.agg(F.max("rows")).first()[0] or 0
    place = F.pmod(F.col("place"), F.lit(len(weights))).cast("int")
    ranked = row_ordinals(per_source, ["of"], "place")
    weighed = ranked.withColumn("weight", F.get(F.array(*[F.lit(float(w)) for w in weights]), place))
    planned = targets(weighed, share, most).withColumn(
        "epochs", F.when(F.col("source_size") > 0, F.floor(F.col("target") / F.col("source_size"))).otherwise(F.lit(0)).cast("long")
    )
    planned = written(
        planned.select(
            "of", "source_size", "target", "epochs",
            (F.floor("target").cast("long") - F.col("epochs") * F.col("source_size")).alias("rest"),
        ),
        "targets",
    )
    digits = max(1, -(-(block_count(largest).bit_length() - 1) // 4))
    blocked = sized.withColumn("block", F.substring("key", 1, digits))
    placed = running_before(blocked, "of", "block", ["key", "doc_id", "size"], F.col("size"))
    last = F.greatest(F.lit(0).cast("long"), F.least(F.col("size"), F.col("rest") - F.col("before")))
    return (
        placed.join(planned, "of")
        .withColumn("last", last)
        .withColumn("taken", F.col("epochs") * F.col("size") + F.col("last"))
        .select("doc_id", "source", "size", "source_size", "target", "epochs", "last", "taken", *(["row"] if keep_rows else []))
    )


def mixed_rows(docs: DataFrame, **options) -> DataFrame:
    """The mix itself: the rows of ``docs``, each as often as it is taken.

    The document at which a source's last epoch ends is cut after the words that the target still holds; a
    document without words stays once, as it takes nothing from any budget.
    """
    taken = mix(docs, keep_rows=True, **options)
    whole = F.when(F.col("size") == 0, F.lit(1).cast("long")).otherwise(
        F.col("epochs") + F.when(F.col("last") == F.col("size"), 1).otherwise(0)
    )
    part = (F.col("last") > 0) & (F.col("last") < F.col("size"))
    words = F.regexp_extract_all("row.text", F.lit(r"[\x20\x09-\x0D]*[^\x20\x09-\x0D]+"), F.lit(0))
    cut = F.array_join(F.slice(words, 1, F.col("last").cast("int")), "")
    copies = taken.select(
        "row",
        F.explode(
            F.concat(F.array_repeat(F.col("row.text"), whole.cast("int")), F.when(part, F.array(cut)).otherwise(F.array()))
        ).alias("piece"),
    )
    fields = [F.col("piece").alias("text") if c == "text" else F.col(f"row.`{c}`").alias(c) for c in docs.columns]
    if "n_chars" in docs.columns:
        kind = docs.schema["n_chars"].dataType
        at = docs.columns.index("n_chars")
        same = F.col("piece").eqNullSafe(F.col("row.text"))
        fields[at] = F.when(same, F.col("row.n_chars")).otherwise(F.length("piece")).cast(kind).alias("n_chars")
    return copies.select(*fields)

"""Exact duplicates by content-defined chunks: texts are equal if their ordered lists of chunk identifiers are."""

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from skyloom.llm.common import written

#: A chunk ends at the first space after a mark that comes LEAST characters or more after its start, else after MOST.
LEAST, MOST = 1024, 8192


def normalised(text: Column) -> Column:
    """The text with each run of white space as one space; a null one is empty."""
    return F.regexp_replace(F.coalesce(text, F.lit("")), r"[\x20\x09-\x0D]+", " ")


def chunks(text: Column, least: int = LEAST, most: int = MOST) -> Column:
    """Cut a text where its content says so; the chunks in their order are the text, and an empty one has none.

    Where a chunk ends depends on the characters since its start only, so equal texts are cut alike and texts
    with equal passages come to the same cuts inside them.
    """
    pattern = rf"(?s).{{{least},{most - 2}}}?[.,;:!?)\]}}>] |.{{1,{most}}}"
    return F.regexp_extract_all(text, F.lit(pattern), F.lit(0))


def identifiers(chunk: Column, seed: int, bits: int = 64) -> list[Column]:
    """Two hashes of ``bits`` bits that stand for a chunk."""
    return [F.shiftrightunsigned(F.xxhash64(F.lit(seed + k), chunk), 64 - bits) for k in (0, 1)]


def verified_seed(texts: DataFrame, bits: int = 64, tries: int = 64, least: int = LEAST, most: int = MOST) -> int:
    """A seed under which no two chunks of the table share an identifier.

    Chunks are made distinct by content before they are shuffled, so what is moved are the distinct chunks of
    each task and never a document; two contents under one identifier count as a fault of the seed.
    """
    cut = texts.select(F.explode(chunks(F.col("normal"), least, most)).alias("chunk"))
    for seed in range(0, 2 * tries, 2):
        named = cut.select(*[c.alias(f"id{k}") for k, c in enumerate(identifiers(F.col("chunk"), seed, bits))], "chunk")
        contents = named.groupBy("id0", "id1", "chunk").agg(F.count(F.lit(1)).alias("n"))
        if contents.groupBy("id0", "id1").agg(F.count(F.lit(1)).alias("n")).where("n > 1").isEmpty():
            return seed
    raise ValueError(f"no identifiers of {2 * bits} bits without a collision in {tries} tries")


def recipe(text: Column, seed: int, bits: int = 64, least: int = LEAST, most: int = MOST) -> Column:
    """The ordered identifiers of a text's chunks."""
    return F.flatten(F.transform(chunks(text, least, most), lambda c: F.array(*identifiers(c, seed, bits))))


def duplicates(docs: DataFrame, bits: int = 64, least: int = LEAST, most: int = MOST) -> DataFrame:
    """Which rows of ``docs`` (doc_id, text) are equal once runs of white space are one space.

    Texts are cut into content-defined chunks, the distinct chunks get identifiers that are verified against
    their contents, and then only ordered lists of identifiers are compared: about two hundredths of the texts' bytes.  A group of copies
    of any size is summed by each task before it is shuffled, and its rows meet their group in a join that can be split.

    Returns doc_id, keep_id (the smallest doc_id of the group), group_size, kept and text_sha256, one row for each
    input row.  Null texts count as empty and are equal to each other and to empty ones; a null doc_id is
    larger than all others; of rows repeated with one doc_id and text one is kept at most; an empty table gives an
    empty one; other columns of ``docs`` are not looked at.
    """
    texts = docs.select("doc_id", normalised(F.col("text")).alias("normal"))
    seed = verified_seed(texts.select("normal"), bits, least=least, most=most)
    listed = texts.select(
        "doc_id", recipe(F.col("normal"), seed, bits, least, most).alias("recipe"), F.sha2("normal", 256).alias("text_sha256")
    )
    rows = written(listed, "recipes")
    groups = rows.groupBy("recipe").agg(F.min("doc_id").alias("keep_id"), F.count(F.lit(1)).alias("group_size"))
    copied = written(groups.where("group_size > 1"), "groups")
    equal = rows.groupBy("doc_id", "recipe", "text_sha256").agg(F.count(F.lit(1)).alias("n"))
    keep = F.when(F.col("group_size").isNull(), F.col("doc_id")).otherwise(F.col("keep_id"))
    return (
        equal.join(copied, "recipe", "left")
        .withColumn("keep_id", keep)
        .withColumn("nth", F.explode(F.sequence(F.lit(1).cast("long"), F.col("n"))))
        .select(
            "doc_id", "keep_id", F.coalesce("group_size", F.lit(1).cast("long")).alias("group_size"),
            (F.col("doc_id").eqNullSafe(F.col("keep_id")) & (F.col("nth") == 1)).alias("kept"), "text_sha256",
        )
    )

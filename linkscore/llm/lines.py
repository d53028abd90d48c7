"""Line dedup over the whole corpus, with DataFrame functions only.

Lines are exploded with their positions, normalised and hashed; documents are
counted per hash; the positions of lines over the limit go back to their text as
one list, and the text is reassembled from the positions that are left. The work on
a text grows with its lines alone. A line that very many documents share is combined
before the shuffle and meets its rows through a join that the adaptive planner can
split.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from linkscore.runtime import stored

BLANKS = " \t\n\x0b\x0c\r"
_UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
_FIRST = -(2**63)  # stands for a missing doc_id: before all others


def line_key(line: Column) -> Column:
    """A line without blanks at its ends, A-Z lower-cased."""
    return F.translate(F.btrim(line, F.lit(BLANKS)), _UPPER, _UPPER.lower())


def key_hash(key: Column) -> Column:
    """96 bits: lines are equal where both hashes are."""
    return F.struct(F.xxhash64(key).alias("a"), F.hash(key).alias("b"))


def dedup_lines(docs: DataFrame, min_chars: int = 20, min_docs: int = 3) -> DataFrame:
    """Drop repeated lines: ``docs`` with new ``text`` and ``n_lines``, ``n_dropped``.

    A key of at least ``min_chars`` code points that occurs in at least
    ``min_docs`` documents loses its lines everywhere but in the largest
    ``doc_id`` that holds it, where all of them stay. Null text becomes one empty
    line; texts of any length and number of lines are read whole. Rows with the same
    ``doc_id`` are one document here and keep their own texts; rows without one count
    together as a document before all others. Other columns pass through; ``n_lines``
    and ``n_dropped`` replace columns of these names. An empty table gives an empty
    table.
    """
    own = F.coalesce(F.col("doc_id").cast("long"), F.lit(_FIRST))
    text = F.coalesce(F.col("text").cast("string"), F.lit(""))
    lines = F.split(text, "\n")
    print_ = F.xxhash64(text)  # with the id it names a text, so equal rows share their positions
    keyed = stored(
        docs.select(own.alias("id"), print_.alias("print"), lines.alias("lines"))  # once a text, not once a line
        .select("id", "print", F.posexplode("lines").alias("pos", "line"))
        .where(F.length("line") >= min_chars)
        .select("id", "print", "pos", line_key(F.col("line")).alias("key"))
        .where(F.length("key") >= min_chars)
        .select("id", "print", "pos", key_hash(F.col("key")).alias("key")),
        "keys",
    )
    over = stored(
        keyed.groupBy("key")
        .agg(F.countDistinct("id").alias("n"), F.max("id").alias("last"))
        .where(F.col("n") >= min_docs)
        .select("key", "last"),
        "lines",
    )
    drops = (
        keyed.join(over, "key")
        .where(F.col("id") != F.col("last"))
        .groupBy("id", "print")
        .agg(F.collect_set("pos").alias("drops"))
    )
    # the row travels as one column, so names of the input cannot clash with those used here
    laid = docs.select(F.struct("*").alias("row"), own.alias("id"), print_.alias("print"), lines.alias("lines"))
    joined = laid.join(drops, ["id", "print"], "left")
    left = F.array_except(F.sequence(F.lit(0), F.size("lines") - 1), "drops")  # in order, by hashing
    kept = F.when(F.col("drops").isNull(), F.col("lines")).otherwise(F.transform(left, lambda i: F.get("lines", i)))
    columns = [f"row.`{c}`" for c in docs.columns if c.lower() not in ("text", "n_lines", "n_dropped")]
    return joined.withColumn("kept", kept).select(
        *columns,
        F.array_join("kept", "\n").alias("text"),
        F.size("lines").cast("long").alias("n_lines"),
        F.coalesce(F.size("drops"), F.lit(0)).cast("long").alias("n_dropped"),
    )

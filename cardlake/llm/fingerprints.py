"""Document fingerprints of closed syncmers, with DataFrame functions only.

A text is a row of tokens: its words, long runs in pieces of 16 characters. A k-mer is five tokens
in a row, its inner substrings are the four pairs of neighbours. A k-mer is chosen when the smallest
hash among its pairs is the first or the last pair: whether it is chosen depends on its own tokens
alone, so the same passage gives the same anchors in any document. A fingerprint is the 64 smallest
hashes of the distinct anchors; two of them estimate the Jaccard likeness of the anchor sets. A text may
have thousands of anchors, so the likeness of the whole sets stands beside each estimate.

Cases: a null text is empty; a text with fewer than five tokens has one anchor made of all of them;
a text without tokens has no anchors and an empty fingerprint, which is like another empty one (1)
and unlike any other (0); rows that repeat both doc_id and text count as one document; rows that
share a doc_id alone are ordered by a hash of their text; a null doc_id is the last; an empty table
gives no rows; other columns are ignored.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cardlake.llm.common import dense_key, documents, null_id, real_id, settle

TOKEN = r"[^\x20\x09-\x0D]{1,16}"
SKETCH = 64
_K = 5


def _with_pairs(df: DataFrame, text: Column) -> DataFrame:
    """Add the hashes of neighbouring tokens; each array is computed once, in its own step."""
    tokens = F.regexp_extract_all(text, F.lit(TOKEN), F.lit(0))
    df = df.withColumn("_words", F.transform(tokens, lambda w: F.xxhash64(w)))
    n = F.size("_words")
    pairs = F.zip_with(
        F.slice("_words", F.lit(1), F.greatest(n - 1, F.lit(0))),
        F.slice("_words", F.lit(2), F.greatest(n - 1, F.lit(0))),
        lambda a, b: F.xxhash64(a, b),
    )
    return df.withColumn("_pairs", pairs).withColumn("_few", F.when(n < _K, F.col("_words")))


def _windows() -> Column:
    """Structs of the four pairs in each k-mer."""
    count = F.greatest(F.size("_pairs") - (_K - 2), F.lit(0))
    return F.arrays_zip(
        *(F.slice("_pairs", F.lit(i), count).alias(f"p{i}") for i in range(1, _K))
    )


def _chosen(x: Column) -> Column:
    return F.least(x["p1"], x["p4"]) <= F.least(x["p2"], x["p3"])


def _anchor(x: Column) -> Column:
    return F.xxhash64(x["p1"], x["p3"], x["p4"])


def _whole() -> Column:
    """The single anchor of a short text."""
    return F.when(F.size("_few") > 0, F.array(F.xxhash64("_few"))).otherwise(
        F.array().cast("array<bigint>")
    )


def anchors(docs: DataFrame) -> DataFrame:
    """doc_id, position (of the first token, from 0), anchor: all closed syncmers of the texts."""
    df = _with_pairs(documents(docs), F.col("text")).select("doc_id", "_few", _windows().alias("_w"))
    numbered = F.transform(
        "_w", lambda x, i: F.struct(i.alias("position"), F.when(_chosen(x), _anchor(x)).alias("anchor"))
    )
    short = F.transform(
        _whole(), lambda a, i: F.struct(i.alias("position"), a.alias("anchor"))
    )
    kept = F.when(F.col("_few").isNull(), F.filter(numbered, lambda s: s["anchor"].isNotNull()))
    return df.select("doc_id", F.inline(F.coalesce(kept, short)))


def with_anchor_set(df: DataFrame, text: Column, name: str) -> DataFrame:
    """Add the sorted hashes (31 bits) of all distinct anchors of ``text``."""
    columns = df.columns
    df = _with_pairs(df, text).select(*columns, "_few", _windows().alias("_w"))
    long = F.transform(F.filter("_w", _chosen), _anchor)
    hashes = F.transform(
        F.when(F.col("_few").isNull(), long).otherwise(_whole()),
        lambda a: F.shiftrightunsigned(a, 33).cast("int"),
    )
    return df.select(*columns, F.sort_array(F.array_distinct(hashes)).alias(name))


def sketch(anchor_set: Column) -> Column:
    """The smallest hashes of a sorted set."""
    return F.slice(anchor_set, 1, SKETCH)


def fingerprint(sketch: Column) -> Column:
    """Eight hexadecimal digits for each hash of a sketch."""
    return F.array_join(F.transform(sketch, lambda x: F.lpad(F.lower(F.hex(x)), 8, "0")), "")


def likeness(a: Column, b: Column) -> Column:
    """Estimated Jaccard likeness: of the smallest hashes of both, the share that both have."""
    union = F.slice(F.sort_array(F.array_union(a, b)), 1, SKETCH)
    both = F.size(F.array_intersect(union, F.array_intersect(a, b)))
    return F.when(F.size(union) == 0, F.lit(1.0)).otherwise(
        both.cast("double") / F.size(union).cast("double")
    )


def set_likeness(a: Column, b: Column) -> Column:
    """Jaccard likeness of two whole sets; two empty ones are alike."""
    both = F.size(F.array_intersect(a, b))
    union = F.size(a) + F.size(b) - both
    return F.when(union == 0, F.lit(1.0)).otherwise(both.cast("double") / union.cast("double"))


def compare_with_next(docs: DataFrame) -> DataFrame:
    """Fingerprints of each text, of its edited text, and how alike both and its neighbour are.

    ``near_edited`` and ``near_next`` compare fingerprints, ``all_edited`` and ``all_next`` all anchors, of which
    a text has ``n_anchors``.

    The next document has the next smaller doc_id (after the last: the first). In the edited text
    the last third of the characters gives way to the first as many of the next document. Only the
    heads that are needed travel to the neighbour, and both joins use one shuffle of the texts.
    """
    rows = documents(docs).select(
        null_id("doc_id").alias("_id"), F.xxhash64("text").alias("_h"), "text"
    )
    # nothing but the text: both joins need the same columns, or Spark shuffles the texts once for each
    rows = rows.groupBy("_id", "_h").agg(F.first("text").alias("text"))
    lengths = documents(docs).select(
        null_id("doc_id").alias("_id"),
        F.xxhash64("text").alias("_h"),
        F.char_length("text").cast("bigint").alias("_n"),
    )
    lengths = lengths.groupBy("_id", "_h").agg(F.max("_n").alias("_n"), F.count("*").alias("_copies"))
    order = settle(dense_key(lengths, [F.col("_id").desc(), F.col("_h")], "_r", 0), "order")
    total = order.count()
    if total == 0:
        order = order.limit(0)
    before = order.select(
        ((F.col("_r") + 1) % max(total, 1)).alias("_r"),
        F.col("_id").alias("_to_id"),
        F.col("_h").alias("_to_h"),
        F.col("_r").alias("_to_r"),
        F.col("_n").alias("_to_n"),
        F.col("_copies").alias("_to_copies"),
    )
    heads = (
        rows.join(order.join(before, "_r"), ["_id", "_h"])
        .select(
            F.col("_to_id").alias("_id"),
            F.col("_to_h").alias("_h"),
            F.col("_to_r").alias("_r"),
            F.col("_to_n").alias("_n"),
            F.col("_to_copies").alias("_copies"),
            F.col("_r").alias("_next"),
            F.substring(F.col("text"), F.lit(1), F.floor(F.col("_to_n") / 3).cast("int")).alias("_head"),
        )
    )
    cut = (F.col("_n") - F.floor(F.col("_n") / 3)).cast("int")
    edited = rows.join(heads, ["_id", "_h"]).select(
        "_id", "_r", "_next", "_n", "_copies", "text",
        F.concat(F.substring(F.col("text"), F.lit(1), cut), F.col("_head")).alias("_edited"),
    )
    edited = edited.withColumn("_sha", F.sha2("_edited", 256))
    edited = with_anchor_set(edited, F.col("text"), "_own").drop("text")
    edited = with_anchor_set(edited, F.col("_edited"), "_all_new").drop("_edited")
    edited = edited.withColumn("_all_edited", set_likeness(F.col("_own"), F.col("_all_new")))
    edited = edited.withColumn("_new", sketch(F.col("_all_new"))).drop("_all_new")
    sketched = settle(edited, "fingerprints")
    following = sketched.select(F.col("_r").alias("_next"), F.col("_own").alias("_following"))
    compared = sketched.join(following, "_next")
    # rows that repeat doc_id and text are one document, and get a row each
    compared = compared.select("*", F.explode(F.sequence(F.lit(1), F.col("_copies"))).alias("_copy"))
    return compared.select(
        real_id("_id").alias("doc_id"),
        F.col("_n").alias("n_chars"),
        F.col("_sha").alias("edited_sha256"),
        fingerprint(sketch(F.col("_own"))).alias("fingerprint"),
        fingerprint(F.col("_new")).alias("edited_fingerprint"),
        likeness(sketch(F.col("_own")), F.col("_new")).alias("near_edited"),
        likeness(sketch(F.col("_own")), sketch(F.col("_following"))).alias("near_next"),
        F.size("_own").cast("bigint").alias("n_anchors"),
        F.col("_all_edited").alias("all_edited"),
        set_likeness(F.col("_own"), F.col("_following")).alias("all_next"),
    )

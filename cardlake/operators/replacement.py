"""Dictionary replacement inside texts: longest entry first, each on the result of the last.

A dictionary is a table ``old, new, rank``; ``rank`` orders entries of equal length. It may be as
large as the user table, so it is neither collected nor broadcast by force: entries find the texts
they occur in through an equi-join on substrings.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cardlake.sources.shared import settle

_SOURCE_STRIDE = 1 << 40
# Characters of an entry that a place in a text must match before longer pieces are compared.
_BEGINNING = 4


def combine_dictionaries(*dictionaries: DataFrame) -> DataFrame:
    """Later dictionaries override the replacement of an entry but not its place in the order."""
    parts = [
        d.select(
            "old",
            "new",
            (F.col("rank") + F.lit(i * _SOURCE_STRIDE)).alias("rank"),
            F.lit(i).alias("source"),
        )
        for i, d in enumerate(dictionaries)
    ]
    stacked = parts[0]
    for part in parts[1:]:
        stacked = stacked.unionByName(part)
    return stacked.groupBy("old").agg(
        F.max_by("new", "source").alias("new"), F.min("rank").alias("rank")
    )


def constant_dictionary(spark, pairs: Sequence[tuple[str, str]]) -> DataFrame:
    rows = [(old, new, i) for i, (old, new) in enumerate(pairs)]
    return spark.createDataFrame(rows, "old string, new string, rank bigint")


def _beginnings(dictionary: DataFrame) -> DataFrame:
    """Beginnings of entries (four characters, or the whole of a shorter entry) with their lengths."""
    start = F.least(F.length("old"), F.lit(_BEGINNING))
    found = dictionary.groupBy(F.left("old", start).alias("beginning"))
    return found.agg(F.collect_set(F.length("old")).alias("lengths"))


class _Index:
    """A dictionary laid out for finding its entries in texts."""

    def __init__(self, dictionary: DataFrame):
        kept = dictionary.filter(F.length("old") > 0).select("old", "new", "rank")
        self.entries = settle(kept, "dictionary")
        self.beginnings = settle(_beginnings(self.entries), "beginnings")
        # at most _BEGINNING numbers
        sizes = self.beginnings.select(F.length("beginning").alias("n")).distinct().collect()
        self.sizes = sorted(r["n"] for r in sizes)

    def found_in(self, texts: DataFrame) -> DataFrame:
        """(text, found): the entries that occur in one of the text's ``forms``, in order of use.

        Places of a form are first matched with the short table of entry beginnings, which also tells
        the lengths to look at; only the substrings left are matched with the dictionary itself. A
        short entry meets a beginning of its own length, so it makes no candidates for longer ones.
        Both tables are read from files, so Spark knows their sizes and broadcasts them only if small.
        """
        form, at = F.col("form"), F.col("at")
        starts = F.explode(F.array(*(F.lit(n) for n in self.sizes)))
        places = (
            texts.select("text", F.explode("forms").alias("form"))
            .select("text", "form", F.explode(F.sequence(F.lit(1), F.length(form))).alias("at"))
            .select("text", "form", "at", starts.alias("start"))
            .filter(at + F.col("start") - 1 <= F.length(form))
            .withColumn("beginning", F.substring(form, at, F.col("start")))
        )
        pieces = (
            places.join(self.beginnings, "beginning")
            .select("text", "form", "at", F.explode("lengths").alias("n"))
            .filter(at + F.col("n") - 1 <= F.length(form))
            .select("text", F.substring(form, at, F.col("n")).alias("old"))
        )
        # Longest first, then by rank: the order in which entries are applied.
        entry = F.struct((-F.length("old")).alias("shortness"), "rank", "old", "new")
        met = pieces.join(self.entries, "old").select("text", entry.alias("entry"))
        return met.groupBy("text").agg(F.array_sort(F.collect_set("entry")).alias("found"))


def _apply(entries: Column, text: Column) -> Column:
    """All forms the text takes, from the original to the final one."""

    def step(forms: Column, entry: Column) -> Column:
        last = F.element_at(forms, -1)
        return F.array_append(forms, F.replace(last, entry["old"], entry["new"]))

    return F.aggregate(entries, F.array(text), step)


def replacements_for(texts: DataFrame, dictionary: DataFrame) -> DataFrame:
    """(text, replaced) for each of the distinct texts that an entry occurs in.

    Entries are sought in the text and in every form it takes on the way, because a replacement
    can complete the text of a shorter entry. A round applies what is known of a text and searches
    the forms that are new; a text that gains no entry is finished and leaves. Applying only the found
    entries then equals applying the whole dictionary.
    """
    index = _Index(dictionary)
    none = texts.sparkSession.createDataFrame([], "text string, replaced string")
    if not index.sizes:
        return none
    known = index.found_in(texts.withColumn("forms", F.array("text")))
    active = known.select("text", F.col("found").alias("entries"), F.array("text").alias("searched"))
    finished = []
    while True:
        state = settle(
            active.withColumn("forms", _apply(F.col("entries"), F.col("text")))
            .withColumn("replaced", F.element_at("forms", -1))
            .withColumn("forms", F.array_except("forms", "searched")),
            "replaced",
        )
        met = index.found_in(state.filter(F.size("forms") > 0).select("text", "forms"))
        more = F.array_except("found", "entries")
        gained = settle(
            met.join(state, "text")
            .withColumn("more", more)
            .filter(F.size("more") > 0)
            .select("text", "entries", "more", "searched", "forms"),
            "gained",
        )
        if gained.isEmpty():
            finished.append(state.select("text", "replaced"))
            return reduce(DataFrame.unionByName, finished)
        finished.append(state.join(gained.select("text"), "text", "left_anti").select("text", "replaced"))
        active = gained.select(
            "text",
            F.array_sort(F.array_union("entries", "more")).alias("entries"),
            F.array_union("searched", "forms").alias("searched"),
        )


def replace_in_columns(
    df: DataFrame, columns: Sequence[str], dictionary: DataFrame
) -> DataFrame:
    """Apply the dictionary to text columns.

    Each distinct text is worked on once, however many rows hold it; results come back by a
    left join on the text, and rows without a match keep theirs.
    """
    texts = (
        df.select(F.explode(F.array(*(F.col(c) for c in columns))).alias("text"))
        .filter(F.length("text") > 0)
        .distinct()
    )
    results = replacements_for(texts, dictionary).filter("text <> replaced")
    out = df
    for c in columns:
        lookup = results.select(F.col("text").alias("_text"), F.col("replaced").alias("_replaced"))
        out = out.join(lookup, out[c] == F.col("_text"), "left").select(
            *(F.coalesce("_replaced", c).alias(c) if c == n else F.col(n) for n in df.columns)
        )
    return out

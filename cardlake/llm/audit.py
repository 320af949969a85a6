"""How the sources of a language differ in the words they use.

Terms are counted by length-bucketed packing. Inside a task the terms of a slice of texts are put into
buckets by length: up to 16 bytes they become one or two 64-bit words, whose 16-bit digits are
radix-sorted (numpy sorts 16-bit digits stably by radix; the number of passes follows from the length);
longer terms are byte strings, sorted in buckets of their own by width. Runs of equal terms then give
occurrences and documents. Spark adds up what the slices found.

Cases. Null text, lang and source are ''. Each row is a document, also a repeated one. A row without
terms still makes its (lang, source) group occur. Terms of any length are counted whole. An empty table
gives no rows. Only lang, source and text are read, so other columns can't clash.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from cardlake.llm.columns import slices, strings, text_bytes
from cardlake.llm.common import settle

#: Text bytes whose terms are sorted at once.
SLICE_BYTES = 8 << 20
#: Terms and sources that one task compares at once.
TERMS, SOURCES = 8192, 256
#: What a term counts besides its occurrences, and the units of a share.
PRIOR, UNITS = 5, 1_000_000_000

_COUNTS = "lang string, source string, term string, n bigint, docs bigint"
_LETTER = np.zeros(256, dtype=bool)
_LETTER[65:91] = _LETTER[97:123] = _LETTER[128:] = True
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32


def terms_of(data: np.ndarray, edges: np.ndarray):
    """Starts, lengths and text numbers of all runs of letters and bytes from 128 on."""
    inside = np.zeros(len(data) + 2, dtype=bool)
    inside[1:-1] = _LETTER[data]
    border = np.zeros(len(data) + 1, dtype=bool)
    border[edges] = True
    starts = np.flatnonzero(inside[1:-1] & (~inside[:-2] | border[:-1]))
    ends = np.flatnonzero(inside[1:-1] & (~inside[2:] | border[1:])) + 1
    texts = np.searchsorted(edges, starts, side="right") - 1
    return starts, ends - starts, texts


def radix_order(digits: list[np.ndarray]) -> np.ndarray:
    """The stable order of rows by 16-bit digits, the most significant first."""
    order = np.argsort(digits[-1], kind="stable")
    for digit in reversed(digits[:-1]):
        order = order[np.argsort(digit[order], kind="stable")]
    return order


def _group_digits(groups: np.ndarray) -> list[np.ndarray]:
    if len(groups) and groups.max() >= 1 << 16:
        return [(groups >> 16).astype(np.uint16), groups.astype(np.uint16)]
    return [groups.astype(np.uint16)]


def _runs(same: np.ndarray, texts: np.ndarray):
    """First rows of runs, how many rows and how many different texts each has."""
    first = np.flatnonzero(~same)
    new_text = np.ones(len(texts), dtype=np.int64)
    new_text[1:] = ~(same[1:] & (texts[1:] == texts[:-1]))
    return first, np.diff(np.append(first, len(texts))), np.add.reduceat(new_text, first)


def count_bucket(table: np.ndarray, lengths, groups, texts, packed: bool):
    """Runs of (term, group) of one bucket: term bytes, lengths, groups, occurrences, texts.

    table: one row for each term, its bytes and then zeros. ``texts`` ascend, and each is in one group.
    """
    if packed:  # rows of 8 or 16 bytes: one or two words, of which the digits in use are sorted by
        words = table.view(">u8").astype(np.uint64)
        most = int(lengths.max())
        digits = [
            (words[:, at // 4] >> np.uint64(48 - 16 * (at % 4))).astype(np.uint16)
            for at in range((most + 1) // 2)
        ]
        order = radix_order(digits + _group_digits(groups))
        words, groups, texts = words[order], groups[order], texts[order]
        equal = (words[1:] == words[:-1]).all(axis=1)
    else:
        keys = table.view(f"S{table.shape[1]}").ravel()
        order = radix_order(_group_digits(groups))
        order = order[np.argsort(keys[order], kind="stable")]
        keys, groups, texts = keys[order], groups[order], texts[order]
        equal = keys[1:] == keys[:-1]
    same = np.concatenate(([False], equal & (groups[1:] == groups[:-1])))
    first, n, docs = _runs(same, texts)
    rows = order[first]
    lengths = lengths[rows]
    inside = np.arange(table.shape[1]) < lengths[:, None]
    return table[rows][inside], lengths, groups[first], n, docs


def count_slice(data: np.ndarray, edges: np.ndarray, groups: np.ndarray):
    """For each length bucket: term bytes, lengths, groups, occurrences and texts of (term, group)."""
    starts, lengths, texts = terms_of(data, edges)
    if not len(starts):
        return
    widths = np.where(lengths <= 2, 2, 2 * ((lengths + 1) // 2))
    long = lengths > 16
    widths[long] = 1 << np.ceil(np.log2(lengths[long])).astype(np.int64)
    padded = np.concatenate((_LOWER[data], np.zeros(int(widths.max()) + 16, dtype=np.uint8)))
    for width in np.unique(widths):
        rows = np.flatnonzero(widths == width)
        cells = int(width) if width > 16 else 8 if width <= 8 else 16
        size = lengths[rows]
        table = np.lib.stride_tricks.sliding_window_view(padded, cells)[starts[rows]]
        table *= np.arange(cells) < size[:, None]
        yield count_bucket(table, size, groups[texts[rows]], texts[rows], width <= 16)


def count_terms(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Occurrences and documents of each (lang, source, term) of a slice of rows."""
    for batch in slices(batches, "text", SLICE_BYTES):
        names = pd.MultiIndex.from_arrays([batch.column(0).to_pylist(), batch.column(1).to_pylist()])
        groups, found = names.factorize()
        langs, sources = (pa.array([f[k] for f in found], type=pa.string()) for k in (0, 1))
        data, edges = text_bytes(batch.column(2))
        for letters, lengths, group, n, docs in count_slice(data, edges, groups.astype(np.int64)):
            of = pa.array(group)
            yield pa.RecordBatch.from_arrays(
                [langs.take(of), sources.take(of), strings(letters, lengths), pa.array(n), pa.array(docs)],
                names=["lang", "source", "term", "n", "docs"],
            )


def _share(count: Column | int, total: Column, terms: Column) -> Column:
    """1 + floor(UNITS * (count + PRIOR) / (total + PRIOR * terms)), exactly; null without terms."""
    count = F.lit(count) if isinstance(count, int) else count
    top = F.lit(UNITS).cast("decimal(10,0)") * (count + F.lit(PRIOR)).cast("decimal(19,0)")
    below = F.nullif(total + F.lit(PRIOR) * terms, F.lit(0)).cast("decimal(19,0)")
    return F.call_function("div", top, below) + F.lit(1)


def _differences(key, entries: pd.DataFrame, sources: pd.DataFrame) -> pd.DataFrame:
    """What the terms at hand add to the distance of two sources, beyond their shares at count 0."""
    lang, _, low, high = key
    names = sources["source"].to_numpy()
    zero = sources["zero"].to_numpy(dtype=np.int64)
    block = sources["block"].to_numpy()
    term, terms = pd.factorize(entries["term"])
    table = np.tile(zero, (len(terms), 1))
    table[term, pd.Index(names).get_indexer(entries["source"])] = entries["p"].to_numpy(dtype=np.int64)
    pairs, values = [], []
    for i in np.flatnonzero(block == low):
        others = np.flatnonzero(block == high)
        others = others[others > i] if low == high else others
        value = np.abs(table[:, others] - table[:, [i]]).sum(axis=0)
        values += (value - len(terms) * np.abs(zero[others] - zero[i])).tolist()
        pairs += [(names[i], names[k]) for k in others]
    columns = [pd.Series([p[k] for p in pairs], dtype=object) for k in (0, 1)]
    return pd.DataFrame(
        {
            "lang": pd.Series([lang] * len(pairs), dtype=object),
            "source": columns[0],
            "item": columns[1],
            "more": pd.Series(values, dtype="int64"),
        }
    )


def divergence(docs: DataFrame, least_docs: int = 30, top: int = 50) -> DataFrame:
    """lang, source, part, item, value, rank: distances between sources, and the terms typical of each.

    A language keeps the terms that ``least_docs`` of its documents hold. Part ``pair`` has a row for
    each other source of the language, part ``term`` at most ``top`` for each source. Counts are added up
    by (lang, term, source) before terms meet, so a source with most rows, or a word in all of them, is
    a row for each task. Pairs of sources are compared for some thousand terms at a time.
    """
    rows = docs.select(
        *(F.coalesce(F.col(c).cast("string"), F.lit("")).alias(c) for c in ("lang", "source", "text"))
    )
    counted = (
        rows.mapInArrow(count_terms, _COUNTS)
        .groupBy("lang", "term", "source")
        .agg(F.sum("n").alias("n"), F.sum("docs").alias("docs"))
    )
    kept = settle(
        counted.groupBy("lang", "term")
        .agg(
            F.sum("docs").alias("docs"),
            F.sum("n").alias("all_n"),
            F.collect_list(F.struct("source", "n")).alias("uses"),
        )
        .filter(F.col("docs") >= least_docs)
        .drop("docs"),
        "kept_terms",
    )
    uses = kept.select("lang", "term", "all_n", F.inline("uses"))
    langs = kept.groupBy("lang").agg(F.count("*").alias("terms"), F.sum("all_n").alias("all_total"))
    totals = uses.groupBy("lang", "source").agg(F.sum("n").alias("total"))
    sizes = rows.select("lang", "source").distinct().join(totals, ["lang", "source"], "left")
    groups = settle(
        sizes.join(langs, "lang", "left").select(
            "lang",
            "source",
            *(F.coalesce(c, F.lit(0)).alias(c) for c in ("total", "terms", "all_total")),
        ),
        "source_totals",
    )
    groups = groups.withColumn("zero", F.coalesce(_share(0, F.col("total"), F.col("terms")), F.lit(0)))
    parts = groups.groupBy("lang").agg(
        F.ceil(F.max("terms") / F.lit(TERMS)).cast("int").alias("chunks"),
        F.ceil(F.count("*") / F.lit(SOURCES)).cast("int").alias("blocks"),
    )
    groups = groups.join(parts, "lang").withColumn(
        "block", F.pmod(F.xxhash64("source"), F.col("blocks")).cast("int")
    )
    entries = settle(
        uses.join(groups, ["lang", "source"]).select(
            "lang",
            "source",
            "term",
            "block",
            "blocks",
            F.pmod(F.xxhash64("term"), F.col("chunks")).cast("int").alias("chunk"),
            _share(F.col("n"), F.col("total"), F.col("terms")).alias("p"),
            _share(F.col("all_n"), F.col("all_total"), F.col("terms")).alias("q"),
        ),
        "term_shares",
    )

    def paired(df: DataFrame, *take: str) -> DataFrame:
        """Each row for each pair of blocks that its own block is in."""
        other = F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)).alias("other")
        return df.select("*", other).select(
            "lang", "chunk", F.least("block", "other").alias("low"), F.greatest("block", "other").alias("high"),
            "source", *take,
        )

    keys = ["lang", "chunk", "low", "high"]
    everywhere = groups.filter("chunks > 0").withColumn(
        "chunk", F.explode(F.sequence(F.lit(0), F.col("chunks") - 1))
    )
    compared = (
        paired(entries, "term", "p")
        .groupBy(*keys)
        .cogroup(paired(everywhere, "zero", "block").groupBy(*keys))
        .applyInPandas(_differences, "lang string, source string, item string, more bigint")
        .groupBy("lang", "source", "item")
        .agg(F.sum("more").alias("more"))
    )
    both_ways = compared.unionByName(
        compared.select("lang", F.col("item").alias("source"), F.col("source").alias("item"), "more")
    )
    one = groups.select("lang", "source", "terms", "zero")
    two = groups.select("lang", F.col("source").alias("item"), F.col("zero").alias("item_zero"))
    apart = F.col("terms") * F.abs(F.col("zero") - F.col("item_zero"))
    pairs = (
        one.join(two, "lang")
        .filter("source <> item")
        .join(both_ways, ["lang", "source", "item"], "left")
        .select("lang", "source", F.lit("pair").alias("part"), "item", (apart + F.coalesce("more", F.lit(0))).alias("value"))
    )
    typical = entries.filter("p > q").select(
        "lang", "source", F.lit("term").alias("part"), F.col("term").alias("item"), (F.col("p") - F.col("q")).alias("value")
    )

    def ranked(df: DataFrame) -> DataFrame:
        order = Window.partitionBy("lang", "source").orderBy(F.desc("value"), "item")
        return df.withColumn("rank", F.row_number().over(order))

    return ranked(pairs).unionByName(ranked(typical).filter(F.col("rank") <= top))


#: The same rows in SQL.
DIVERGENCE_SQL = """
WITH rows_ AS (
  SELECT row_number() OVER () AS row_id, coalesce(lang, '') AS lang, coalesce(source, '') AS source,
    coalesce(text, '') AS text FROM documents),
words AS (
  SELECT row_id, lang, source, unnest(regexp_extract_all(
    translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
    '[^\\x00-\\x40\\x5B-\\x60\\x7B-\\x7F]+')) AS term FROM rows_),
kept AS (
  SELECT lang, term, count(*) AS all_n FROM words GROUP BY lang, term HAVING count(DISTINCT row_id) >= 30),
langs AS (SELECT lang, count(*) AS v, sum(all_n) AS all_total FROM kept GROUP BY lang),
uses AS (
  SELECT lang, source, term, count(*) AS n FROM words SEMI JOIN kept USING (lang, term)
  GROUP BY lang, source, term),
totals AS (SELECT lang, source, sum(n) AS total FROM uses GROUP BY lang, source),
groups_ AS (
  SELECT g.lang, g.source, coalesce(total, 0) AS total
  FROM (SELECT DISTINCT lang, source FROM rows_) g LEFT JOIN totals t USING (lang, source)),
shares AS (
  SELECT g.lang, g.source, k.term, coalesce(n, 0) AS n,
    1 + (1000000000::HUGEINT * (coalesce(n, 0) + 5)) // (total + 5 * v)::HUGEINT AS p,
    1 + (1000000000::HUGEINT * (all_n + 5)) // (all_total + 5 * v)::HUGEINT AS q
  FROM groups_ g JOIN kept k USING (lang) JOIN langs USING (lang)
  LEFT JOIN uses u ON u.lang = g.lang AND u.source = g.source AND u.term = k.term),
apart AS (
  SELECT a.lang, a.source, b.source AS item, sum(abs(a.p - b.p)) AS value
  FROM shares a JOIN shares b ON a.lang = b.lang AND a.term = b.term AND a.source <> b.source
  GROUP BY a.lang, a.source, b.source),
found AS (
  SELECT a.lang, a.source, 'pair' AS part, b.source AS item, coalesce(value, 0) AS value
  FROM groups_ a JOIN groups_ b ON a.lang = b.lang AND a.source <> b.source
  LEFT JOIN apart x ON x.lang = a.lang AND x.source = a.source AND x.item = b.source
  UNION ALL SELECT lang, source, 'term', term, p - q FROM shares WHERE n > 0 AND p > q),
ranked AS (
  SELECT *, row_number() OVER (PARTITION BY lang, source, part ORDER BY value DESC, item) AS rank FROM found)
SELECT lang, source, part, item, value::BIGINT AS value, rank::INTEGER AS rank
FROM ranked WHERE part = 'pair' OR rank <= 50"""

"""Source divergence audit: how far the word use of each source lies from the other sources and from its language.

Terms are counted by length. In a slice of texts, terms of up to 8 bytes
become one uint64 and terms of up to 16 bytes two, big-endian, so that numeric
order is byte order; both are radix-sorted by 16-bit digits and their runs
counted. Longer terms lie in a bucket for each length, sorted by their bytes.
A slice sends a row for each (language, source, term), Spark adds them up, and
the terms that enough documents of a language hold stay.

Shares are integers, p = 1 + floor(scale * (count + prior) / (total + prior * V)),
so every distance is exact. Each pair of sources of a language has the sum of
|p - q| over all kept terms: blocks of terms become dense tables of bounded
size, each for a strip of sources, and the blocks' sums add up. The terms that
a source overuses most follow as ranks.

Nulls and empties: null text, language and source count as ''. A group without
terms is listed, and its counts are 0. Ties of the value go to the smaller item by
UTF-8 bytes. Repeated rows are documents of their own. Texts of any length are
taken whole. An empty table gives no rows. Other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .runtime import Scratch, quoted
from .textkern import LOWER, slices, table

SCALE = 1_000_000_000
#: Bytes of text that are sorted at once.
SLICE = 8 << 20
#: Cells of a dense table of sources by terms, its least number of terms, and sources of a strip.
CELLS, LEAST_TERMS, STRIP = 1 << 16, 1024, 256
#: Terms are matches of [^\x00-\x40\x5B-\x60\x7B-\x7F]+.
TERM = table(word_bytes={*range(0x41, 0x5B), *range(0x61, 0x7B), *range(0x80, 0x100)})
_HEADS = np.array([0] + [(1 << 64) - (1 << 8 * (8 - k)) for k in range(1, 9)], np.uint64)


def radix_order(keys: list[np.ndarray]) -> np.ndarray:
    """The stable order of rows by keys, the most significant first; each pass is a radix sort of 16 bits."""
    order = np.arange(len(keys[0]))
    for key in reversed(keys):
        for shift in (0, 16, 32, 48):
            digit = (key >> np.uint64(shift)).astype(np.uint16)
            if len(digit) and (digit != digit[0]).any():
                order = order[np.argsort(digit[order], kind="stable")]
    return order


def _words(blob: np.ndarray, at: np.ndarray, size: np.ndarray) -> np.ndarray:
    """The size (0 to 8) bytes at each place as a big-endian number; blob ends with 16 spare bytes."""
    every = np.ndarray((len(blob) - 7,), np.uint64, blob, strides=(1,))
    return every[at].byteswap() & _HEADS[size]


def _runs(terms: list[np.ndarray], group: np.ndarray, row: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """First place, occurrences and rows of each run of equal (term, group) in sorted arrays."""
    new = np.ones(len(group), bool)
    new[1:] = group[1:] != group[:-1]
    for t in terms:
        new[1:] |= t[1:] != t[:-1]
    first = np.flatnonzero(new)
    new[1:] |= row[1:] != row[:-1]
    return first, np.diff(np.append(first, len(group))), np.add.reduceat(new.astype(np.int64), first) if len(first) else first


def counted(blob: np.ndarray, at: np.ndarray, end: np.ndarray, row: np.ndarray, group: np.ndarray) -> Iterator[tuple[pa.Array, np.ndarray, np.ndarray, np.ndarray]]:
    """Terms, groups, occurrences and rows of each (term, group), a batch for each length bucket.

    The terms are blob's bytes from at to end; row ascends, group is that of each row.
    """
    size = end - at
    blob = np.concatenate([LOWER[blob], np.zeros(16, np.uint8)])
    by_group = radix_order([group[row].astype(np.uint64)])
    for least, most in ((1, 8), (9, 16)):
        own = by_group[(size[by_group] >= least) & (size[by_group] <= most)]
        if not len(own):
            continue
        words = [_words(blob, at[own] + k, np.clip(size[own] - k, 0, 8)) for k in range(0, most, 8)]
        order = radix_order(words)
        words, r = [w[order] for w in words], row[own][order]
        first, n, rows = _runs(words, group[r], r)
        letters = np.stack([w[first] for w in words], axis=1).byteswap().view(np.uint8).reshape(len(first), most)
        held = letters != 0  # no term holds a zero byte
        ends = np.concatenate([[0], np.cumsum(held.sum(1))])
        yield _strings(ends, letters[held]), group[r[first]], n, rows
    long = by_group[size[by_group] > 16]
    for length in np.unique(size[long]).tolist():
        own = long[size[long] == length]
        letters = blob[at[own][:, None] + np.arange(length)]
        terms = letters.view(f"S{length}").ravel()
        order = np.argsort(terms, kind="stable")
        terms, r = terms[order], row[own][order]
        first, n, rows = _runs([terms], group[r], r)
        yield _strings(np.arange(len(first) + 1) * length, letters[order[first]].ravel()), group[r[first]], n, rows


def _strings(ends: np.ndarray, letters: np.ndarray) -> pa.Array:
    return pa.LargeStringArray.from_buffers(len(ends) - 1, pa.py_buffer(ends.astype(np.int64)), pa.py_buffer(np.ascontiguousarray(letters))).cast(pa.string())


def term_counts(docs: DataFrame) -> DataFrame:
    """lang, source, term, n and docs from rows of (text, lang, source), several rows for each key; the term '' marks each group."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names = ["lang", "source", "term", "n", "docs"]
        for batch in batches:
            lang, source = (pc.dictionary_encode(batch.column(k)) for k in (1, 2))
            pair = lang.indices.to_numpy().astype(np.int64) * max(1, len(source.dictionary)) + source.indices.to_numpy()
            pairs, group = np.unique(pair, return_inverse=True)
            langs, sources = lang.dictionary.take(pa.array(pairs // max(1, len(source.dictionary)))), source.dictionary.take(pa.array(pairs % max(1, len(source.dictionary))))
            none = pa.array(np.zeros(len(pairs), np.int64))
            yield pa.record_batch([langs, sources, pa.array([""] * len(pairs)), none, none], names=names)
            for s in slices(batch.column(0), SLICE):
                at, end, row = s.words(TERM)
                for term, g, n, rows in counted(s.blob, at, end, row, group[s.first : s.first + len(s)]):
                    yield pa.record_batch([langs.take(pa.array(g)), sources.take(pa.array(g)), term, pa.array(n.astype(np.int64)), pa.array(rows.astype(np.int64))], names=names)

    return docs.mapInArrow(run, "lang string, source string, term string, n long, docs long")


def share(count: np.ndarray, total: int, prior: int, terms: int) -> np.ndarray:
    """1 + floor(SCALE * (count + prior) / (total + prior * terms)) by long division, which no product overflows."""
    below = max(1, total + prior * terms)
    out, rest = np.divmod(count + prior, below)
    for _ in range(3):
        more, rest = np.divmod(rest * 1000, below)
        out = out * 1000 + more
    return out + 1


def _share(count: Column, total: Column, prior: int, terms: Column) -> Column:
    """share() as a column, in decimals of 38 digits."""
    wide = ((count + F.lit(prior)).cast("decimal(27,0)") * F.lit(SCALE).cast("decimal(10,0)")).cast("decimal(38,0)")
    return F.call_function("div", wide, (total + F.lit(prior) * terms).cast("decimal(20,0)")) + F.lit(1)


def divergence(docs: DataFrame, least_docs: int = 30, prior: int = 5, top: int = 50, text_col: str = "text", lang_col: str = "lang", source_col: str = "source") -> DataFrame:
    """lang, source, part ('pair' or 'term'), item, value and rank.

    pair: item is another source of the language, value the summed distance of
    all kept terms, largest first. term: the top terms that the source uses
    more than its language does, value the difference.
    """
    scratch = Scratch(docs.sparkSession)
    given = [F.coalesce(F.col(quoted(c)).cast("string"), F.lit("")).alias(k) for c, k in ((text_col, "text"), (lang_col, "lang"), (source_col, "source"))]
    counts = term_counts(docs.select(*given))
    # one exchange for both sums: rows lie by (lang, term)
    cells = counts.repartition("lang", "term").groupBy("lang", "term", "source").agg(F.sum("n").alias("n"), F.sum("docs").alias("docs"))
    by_term = Window.partitionBy("lang", "term")
    summed = cells.withColumns({"all_docs": F.sum("docs").over(by_term), "all_n": F.sum("n").over(by_term)})
    kept = scratch.table(summed.filter((F.col("all_docs") >= least_docs) | (F.col("term") == "")).select("lang", "source", "term", "n", "all_n"), "kept")

    # a row for each group, with its language's figures
    totals = kept.groupBy("lang", "source").agg(F.sum("n").alias("total"))
    vocabulary = kept.filter("term != ''").groupBy("lang", "term").agg(F.count(F.lit(1)).alias("k")).groupBy("lang").agg(F.count(F.lit(1)).alias("v"))
    langs = totals.groupBy("lang").agg(F.sum("total").alias("lang_total"), F.count(F.lit(1)).alias("sources")).join(vocabulary, "lang", "left").fillna(0, ["v"])
    blocks = F.greatest(F.lit(1), F.ceil(F.col("v") / F.greatest(F.lit(LEAST_TERMS), F.floor(CELLS / F.col("sources"))))).cast("int")
    strips = F.ceil(F.col("sources") / STRIP).cast("int")
    langs = scratch.table(langs.withColumns({"blocks": blocks, "strips": strips}), "langs")
    groups = scratch.table(totals.join(langs, "lang"), "groups")

    def dealt(rows: DataFrame, block: Column) -> DataFrame:
        strip = F.explode(F.sequence(F.lit(0), F.col("strips") - 1))
        return rows.select("lang", block.alias("block"), "strips", "source", "term", "n", "v").select("*", strip.alias("strip"))

    heads = dealt(groups.select("*", F.lit(None).cast("string").alias("term"), F.col("total").alias("n")), F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
    rows = dealt(kept.filter("term != ''").join(langs.select("lang", "blocks", "strips", "v"), "lang"), F.pmod(F.xxhash64("term"), F.col("blocks")).cast("int"))

    def distances(part: pd.DataFrame) -> pd.DataFrame:
        """Sums of |p - q| over a block's terms, for the sources of a strip and all others."""
        head = part[part.term.isna()].sort_values("source")
        own = part[part.term.notna()]
        names, terms = head.source.to_numpy(), int(head.v.iloc[0])
        column, kinds = pd.factorize(own.term)
        p = np.zeros((len(names), len(kinds)), np.int64)
        p[np.searchsorted(names, own.source.to_numpy()), column] = own.n.to_numpy()
        for k, total in enumerate(head.n.tolist()):
            p[k] = share(p[k], total, prior, terms)
        out = []
        for k in range(int(part.strip.iloc[0]), len(names), int(part.strips.iloc[0])):
            out.append(pd.DataFrame({"lang": part.lang.iloc[0], "source": names[k], "item": names, "value": np.abs(p - p[k]).sum(1)}).drop(index=k))
        return pd.concat(out) if out else pd.DataFrame({"lang": [], "source": [], "item": [], "value": []})

    summed = heads.unionByName(rows).groupBy("lang", "block", "strip").applyInPandas(distances, "lang string, source string, item string, value long")
    order = Window.partitionBy("lang", "source").orderBy(F.desc("value"), "item")
    pairs = summed.groupBy("lang", "source", "item").agg(F.sum("value").alias("value")).withColumn("rank", F.row_number().over(order))

    used = kept.filter("term != '' AND n > 0").join(groups.select("lang", "source", "total", "lang_total", "v"), ["lang", "source"])
    p, q = _share(F.col("n"), F.col("total"), prior, F.col("v")), _share(F.col("all_n"), F.col("lang_total"), prior, F.col("v"))
    over = used.select("lang", "source", F.col("term").alias("item"), (p - q).alias("value")).filter("value > 0")
    terms = over.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= top)
    columns = ("lang", "source", "part", "item", "value", "rank")
    return pairs.withColumn("part", F.lit("pair")).select(*columns).unionByName(terms.withColumn("part", F.lit("term")).select(*columns))

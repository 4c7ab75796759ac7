"""Quality rules with thresholds that adapt to each language and source.

Native DataFrame functions only. One pass measures every document and writes
the measures. Quantile summaries of them (mergeable: each task's partial
summary is merged, so a source with a third of all rows is summed where it is
read) give a median and an upper quartile for each (lang, source), language and
all documents. The three limits are pooled by their numbers of rows, so a small
group leans on its language, and a small language on all documents.
A document is rejected if a measure lies further above its group's median than
`spread` times the group's spread. For a share that is the inter-quartile
distance or, where most documents have none of the letters counted and it is
smaller, the grain: one letter of the lower quartile of the documents' sizes. No cutoff is fixed.
Repeated words and lines are judged by the base rule alone: among good documents they have no
upper end that quantiles show.

Nulls and empties: a null text has no words; null lang and source form groups
of their own; nulls in id_col are carried along; repeated rows are judged each.
An empty table gives no rows. filter_documents() keeps all columns of its
input, whatever their names.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .runtime import Scratch, fresh, neutral, quoted

SPACE = r"[\x20\x09-\x0D]+"
SYMBOLS = "[#*$%&|<>]"
MARKS = r"[!?#*$%&|<>{}\[\]\\^~=_+@/]"
UPPER = "[A-Z]"
#: The measures, and whether each is a share of letters.
MEASURES = {"symbol_share": True, "mark_share": True, "upper_share": True, "word_length": False}

COUNTS = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "n_marks", "n_upper", "n_lines"]


def _without(c: Column, letters: str) -> Column:
    return F.char_length(c) - F.char_length(F.regexp_replace(c, letters, ""))


def _repeats(p: str = "_wf_") -> Column:
    """Words in three-word windows found twice or more; the positions are sorted only where some are."""
    runs = f"{p}runs"
    hit = f"""size(array_distinct(flatten(transform(
        filter({runs}, (x, k) -> (k > 0 AND {runs}[k - 1].h = x.h) OR (k < size({runs}) - 1 AND {runs}[k + 1].h = x.h)),
        x -> array(x.i, x.i + 1, x.i + 2)))))"""
    return F.expr(hit)


def measured(df: DataFrame, text_col: str = "text", p: str = "_wf_") -> DataFrame:
    """df with the base counts (prefix p): n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, and letters counts."""
    t = F.coalesce(F.col(text_col), F.lit(""))
    lines = df.withColumns({f"{p}w": F.filter(F.split(t, SPACE), lambda w: w != ""), f"{p}l": F.filter(F.split(t, "\n"), lambda x: x.rlike(r"[^\x20\x09-\x0D]"))})
    # Sorted hashes show whether any window is repeated; only then are positions sorted too.
    hashed = lines.withColumn(f"{p}h", F.expr(f"CASE WHEN size({p}w) >= 4 THEN transform(sequence(0, size({p}w) - 3), i -> xxhash64({p}w[i], {p}w[i + 1], {p}w[i + 2])) END"))
    some = hashed.withColumn(f"{p}s", F.expr(f"size({p}h) > size(array_distinct({p}h))"))
    runs = some.withColumn(f"{p}runs", F.expr(f"CASE WHEN {p}s THEN sort_array(transform({p}h, (h, i) -> struct(h AS h, i AS i))) END"))
    counts = runs.withColumns(
        {
            f"{p}n_words": F.size(f"{p}w").cast("long"),
            f"{p}word_chars": F.char_length(F.regexp_replace(t, SPACE, "")).cast("long"),
            f"{p}n_symbols": _without(t, SYMBOLS).cast("long"),
            f"{p}n_dup_lines": (F.size(f"{p}l") - F.size(F.array_distinct(f"{p}l"))).cast("long"),
            f"{p}n_repeat_words": F.when(F.col(f"{p}s"), _repeats(p)).otherwise(0).cast("long"),
            f"{p}n_marks": _without(t, MARKS).cast("long"),
            f"{p}n_upper": _without(t, UPPER).cast("long"),
            f"{p}n_lines": F.size(f"{p}l").cast("long"),
        }
    )
    return counts.drop(*(f"{p}{x}" for x in ("w", "l", "h", "s", "runs")))


def _measures(p: str) -> dict[str, Column]:
    words, chars = F.greatest(F.col(f"{p}n_words"), F.lit(1)), F.greatest(F.col(f"{p}word_chars"), F.lit(1))
    return {
        "symbol_share": F.col(f"{p}n_symbols") / chars,
        "mark_share": F.col(f"{p}n_marks") / chars,
        "upper_share": F.col(f"{p}n_upper") / chars,
        "word_length": F.col(f"{p}word_chars") / words,
    }


def thresholds(table: DataFrame, spread: float, accuracy: int, min_group: int, p: str = "_wf_") -> DataFrame:
    """One row for each (lang, source) of a measured table: the upper threshold of each measure."""
    letters = F.greatest(F.col(f"{p}word_chars"), F.lit(1)).alias("letters")
    rows = table.filter(f"NOT {p}base_failed").select(F.col(f"{p}lang").alias("lang"), F.col(f"{p}source").alias("source"), letters, *(m.alias(k) for k, m in _measures(p).items()))
    sketch = [F.percentile_approx(k, [0.25, 0.5, 0.75], accuracy).alias(k) for k in MEASURES] + [F.percentile_approx("letters", 0.25, accuracy).alias("letters")]

    def fence(k: str) -> Column:
        q = F.col(k)
        grain = F.lit(1.0) / F.col("letters") if MEASURES[k] else F.lit(0.0)
        return (q[1] + spread * F.greatest(q[2] - q[0], grain)).alias(k)

    fences = [fence(k) for k in MEASURES]
    own = rows.groupBy("lang", "source").agg(*sketch, F.count(F.lit(1)).alias("n")).select("lang", "source", "n", *fences)
    lang = rows.groupBy("lang").agg(*sketch, F.count(F.lit(1)).alias("n")).select(F.col("lang").alias("l_lang"), F.col("n").alias("l_n"), *(c.alias(f"l_{k}") for k, c in zip(MEASURES, fences)))
    every = rows.agg(*sketch).select(*(c.alias(f"a_{k}") for k, c in zip(MEASURES, fences)))
    joined = own.join(lang, F.col("lang").eqNullSafe(F.col("l_lang"))).join(F.broadcast(every))  # one row

    def pooled(k: str) -> Column:
        """A group of n rows counts n times, its language as min_group rows, and in that all documents as min_group."""
        of_lang = (F.col("l_n") * F.col(f"l_{k}") + min_group * F.col(f"a_{k}")) / (F.col("l_n") + min_group)
        return ((F.col("n") * F.col(k) + min_group * of_lang) / (F.col("n") + min_group)).alias(f"{p}max_{k}")

    return joined.select(F.col("lang").alias(f"{p}t_lang"), F.col("source").alias(f"{p}t_source"), *map(pooled, MEASURES))


def judge(df: DataFrame, text_col: str = "text", lang_col: str = "lang", source_col: str = "source", spread: float = 12.0, accuracy: int = 10_000, min_group: int = 30, keep_columns: list[str] | None = None, p: str = "_wf_") -> DataFrame:
    """keep_columns of df (all of them by default), and with prefix p the counts, base_failed and, last, kept.

    An added name that a kept column has gets underscores behind it.

    base_failed: under 50 words, or over half of them in repeated windows.
    accuracy: the summaries' rank error is 1 / accuracy of a group, and they
    are exact for groups of up to accuracy rows.
    """
    scratch = Scratch(df.sparkSession)
    given, name = neutral(df)
    columns = df.columns if keep_columns is None else keep_columns
    own = [name[c] for c in columns]
    plain = measured(given, name[text_col], p)
    failed = (F.col(f"{p}n_words") < 50) | (100 * F.col(f"{p}n_repeat_words") > 50 * F.col(f"{p}n_words"))
    counts = [f"{p}{c}" for c in COUNTS]
    plain = plain.select(*own, *counts, F.col(name[lang_col]).alias(f"{p}lang"), F.col(name[source_col]).alias(f"{p}source"), failed.alias(f"{p}base_failed"))
    table = scratch.table(plain, "measured")
    limits = scratch.table(thresholds(table, spread, accuracy, min_group, p), "thresholds")
    on = table[f"{p}lang"].eqNullSafe(limits[f"{p}t_lang"]) & table[f"{p}source"].eqNullSafe(limits[f"{p}t_source"])
    above = [F.coalesce(m > F.col(f"{p}max_{k}"), F.lit(False)) for k, m in _measures(p).items()]
    over = above[0]
    for x in above[1:]:
        over = over | x
    joined = table.join(limits, on, "left").withColumn(f"{p}kept", ~F.col(f"{p}base_failed") & ~over)
    added = [*counts, f"{p}base_failed", f"{p}kept"]
    return joined.select(*own, *added).toDF(*columns, *fresh(columns, *added))


def filter_documents(df: DataFrame, **options) -> DataFrame:
    """The rows of df that the rules keep, with df's columns."""
    judged = judge(df, **options)
    return judged.filter(F.col(quoted(judged.columns[-1]))).select(*map(quoted, df.columns))

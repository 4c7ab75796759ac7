"""Line deduplication by a deletion-neighbourhood join, with words as symbols.

A line is dropped if an earlier line, in the order of (doc_id, line number),
is within one edit of it: the same words, or one word put in, left out or
replaced. An edit counts as one up to a min_words-th part of the longer line,
so lines of under min_words words need equal words: in a shorter line one word
is too large a part (`Chapter 1` and `Chapter 2`). The earlier line may itself
be one that goes, so of a chain of lines only the first is certain to stay.
Native DataFrame functions only.

1. Equal lines meet first (a 96-bit hash), so a line that a third of all rows
   hold is one row from then on, summed where it is read.
2. Two lines within one edit share their first or last half. Lines that share
   no half with another line are set aside; this loses no pair.
3. The others emit their deletion variants as hashed keys: the line itself,
   which meets lines with one word more, and the line without word i, keyed
   with i and the number of words, which meets those that differ in word i.
   Such groups are stars: the earliest line of a key is compared with each
   other one, so links number no more than keys, however large the group.
4. Each link's edit distance is verified on the words.
5. The places of lines are looked up again. The lines that hold over a
   thousandth of all places, a thousand at most, are sent to every task, so the
   places of a common line stay where they are.

Before each of these joins, and before texts meet the numbers of the lines that
they lose, a map of the few keys' hashes tells most rows that have none.

Nulls and empties: null and empty texts pass unchanged, lines without a word
are always kept; rows with a null doc_id come first, and rows with
one doc_id are told apart by their text's hash, and exact repeats of a row
count as one place, so their lines are kept or dropped alike. Letters' case is
ignored.
An empty table gives no rows. All columns of the input are kept, whatever
their names.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .runtime import Scratch, fresh, quoted

#: A map of keys has MAP_BITS bits for each, in rows of MAP_WORDS longs (4 KB), of which there are MAP_MOST (16 MB) at most.
MAP_BITS, MAP_WORDS, MAP_MOST = 32, 512, 4096
#: A line with over a HOT-th part of all places is common.
HOT = 1000


def _canonical(line: Column) -> Column:
    """The line's words, lower-cased, one space between them. Most lines are so already, and need no pattern."""
    low = F.lower(line)
    odd = low.startswith(" ") | low.endswith(" ") | low.contains("  ")
    for c in "\t\x0b\x0c\r":
        odd = odd | low.contains(c)
    return F.when(odd, F.trim(F.regexp_replace(low, r"[\x20\x09-\x0D]+", " "))).otherwise(low)


def _lines(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """doc, t (the text's hash), no and line."""
    text = F.col(quoted(text_col))
    rows = docs.select(F.coalesce(F.col(quoted(id_col)).cast("long"), F.lit(-(1 << 63))).alias("doc"), F.xxhash64(text).alias("t"), text.alias("text"))
    return rows.select("doc", "t", F.posexplode(F.split("text", "\n")).alias("no", "line"))


def _halves(min_words: int) -> Column:
    """Keys of the first and last (n - 1) // 2 and n // 2 words, tagged by end and length."""
    keys = [f"xxhash64('{end}', {size}, substring_index(line, ' ', {sign}({size})))" for end, sign in (("a", ""), ("b", "-")) for size in ("CAST((n - 1) div 2 AS INT)", "CAST(n div 2 AS INT)")]
    return F.expr(f"CASE WHEN n >= {min_words - 1} THEN array_distinct(array({', '.join(keys)})) END")


class _Map:
    """Bits set by the hashes of keys, sent to every task: most rows without a key of theirs are known before a join moves them.

    It grows with the keys up to MAP_MOST rows; beyond that more rows pass, and the join after it decides.
    """

    def __init__(self, keys: DataFrame, scratch: Scratch, name: str) -> None:
        self.rows = min(MAP_MOST, max(1, -(-keys.count() * MAP_BITS // (64 * MAP_WORDS))))
        some = keys.select(self._bit(keys.columns).alias("bit")).select(F.shiftright("bit", 6).alias("w"), F.expr("shiftleft(1L, CAST(bit % 64 AS INT))").alias("v"))
        words = some.groupBy("w").agg(F.bit_or("v").alias("v"))
        every = keys.sparkSession.range(self.rows * MAP_WORDS).select(F.col("id").alias("w")).join(words, "w", "left").fillna(0, ["v"])
        lists = every.groupBy(F.expr(f"w div {MAP_WORDS}").alias("m")).agg(F.array_sort(F.collect_list(F.struct("w", "v"))).alias("l"))
        self.table = scratch.table(lists.select("m", F.transform("l", lambda x: x.v).alias("bits")), name)

    def _bit(self, columns: list[str]) -> Column:
        return F.pmod(F.xxhash64(*(F.col(quoted(c)) for c in columns)), F.lit(self.rows * MAP_WORDS * 64))

    def marked(self, rows: DataFrame, columns: list[str], name: str) -> DataFrame:
        """rows with a column of that name: false where their columns are surely no key."""
        bit, m, bits = fresh([*rows.columns, name], "_wf_bit", "_wf_m", "_wf_bits")
        met = rows.withColumn(bit, self._bit(columns)).join(F.broadcast(self.table.toDF(m, bits)), F.expr(f"{bit} div {64 * MAP_WORDS} = {m}"))
        return met.withColumn(name, F.expr(f"getbit({bits}[CAST({bit} div 64 % {MAP_WORDS} AS INT)], CAST({bit} % 64 AS INT)) = 1")).drop(bit, m, bits)

    def met(self, rows: DataFrame, columns: list[str]) -> DataFrame:
        """The rows whose columns may be a key."""
        return self.marked(rows, columns, "maybe").filter("maybe").drop("maybe")


def removed_lines(docs: DataFrame, scratch: Scratch, min_words: int = 6, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc, t and gone (sorted line numbers) of each document that loses lines."""
    raw = _lines(docs, id_col, text_col)
    lines = raw.select("doc", "t", "no", _canonical(F.col("line")).alias("line")).filter("line != ''")
    lines = lines.withColumn("n", F.octet_length("line") - F.octet_length(F.replace("line", F.lit(" "), F.lit(""))) + 1)
    place = F.struct("doc", "t", "no")
    occurrences = scratch.table(lines.select("doc", "t", "no", F.xxhash64("line").alias("h"), F.hash("line").alias("g"), _halves(min_words).alias("keys")), "lines")
    # The halves come from the line's first place.
    distinct = scratch.table(occurrences.groupBy("h", "g").agg(F.min(F.struct("doc", "t", "no", "keys")).alias("first"), F.count(F.lit(1)).alias("times")), "distinct")

    # Lines that share a half with another distinct line.
    halves = distinct.filter("first.keys IS NOT NULL").select("h", "g", "first.doc", "first.t", "first.no", F.explode("first.keys").alias("key"))
    shared = halves.groupBy("key").agg(*(f(c).alias(f"{k}{c}") for c in "hg" for k, f in (("a", F.min), ("z", F.max)))).filter("ah != zh OR ag != zg").select("key")
    shared = scratch.table(shared, "shared")
    # An inner join, as a semi join would be moved before the map.
    near = _Map(shared, scratch, "shared-map").met(halves, ["key"]).join(shared, "key").select("h", "g", "doc", "t", "no").distinct()
    # Numbers that ascend with the place: ranges in order, and rows in order inside them.
    near = near.repartitionByRange("doc", "t", "no").sortWithinPartitions("doc", "t", "no").withColumn("id", F.monotonically_increasing_id())
    near = scratch.table(near, "near")

    # Their words are read again.
    at = ["doc", "t", "no"]
    maybe = _Map(near.select(*at), scratch, "near-map").met(raw, at)
    found = maybe.join(near.select("doc", "t", "no", "id"), ["doc", "t", "no"]).dropDuplicates(["id"])
    words = F.split("line", " ")
    worded = scratch.table(found.select("id", _canonical(F.col("line")).alias("line")).select("id", F.size(words).alias("n"), "line"), "worded")

    # A line's hash is the exclusive or of its words' hashes by position, so that without word i, and
    # with the words behind it moved up, takes running ors before and after i: one pass over the words.
    laid = worded.repartition(int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions")), "id")  # lines move before they become a row for each word
    spots = laid.select("id", "n", F.posexplode(words).alias("i", "w")).select("id", "n", "i", F.xxhash64("w", "i").alias("z"), F.xxhash64("w", F.col("i") - 1).alias("y"))
    line, upto = Window.partitionBy("id"), Window.partitionBy("id").orderBy("i").rowsBetween(Window.unboundedPreceding, 0)
    runs = spots.select("id", "n", "i", "z", F.bit_xor("z").over(line).alias("x"), F.bit_xor("y").over(line).alias("ys"), F.bit_xor("z").over(upto).alias("zi"), F.bit_xor("y").over(upto).alias("yi"))
    keys = runs.selectExpr(
        "id",
        f"""filter(array(
            CASE WHEN i = 0 THEN struct(xxhash64('d', n, x) AS key, 0 AS kind) END,
            CASE WHEN n >= {min_words} THEN struct(xxhash64('s', n, i, x ^ z) AS key, 1 AS kind) END,
            CASE WHEN n >= {min_words} THEN struct(xxhash64('d', n - 1, zi ^ z ^ ys ^ yi) AS key, 2 AS kind) END), v -> v IS NOT NULL) AS v""",
    )
    variants = scratch.table(keys.select("id", F.explode("v").alias("v")).select("id", "v.key", "v.kind"), "variants")

    # The earliest whole line and the earliest shortened one of each key are its star's centres.
    centres = variants.groupBy("key").agg(
        F.min(F.when(F.col("kind") == 0, F.col("id"))).alias("whole"), F.min(F.when(F.col("kind") != 0, F.col("id"))).alias("other"), F.max("id").alias("last"), F.min("id").alias("first")
    ).filter("first != last").select("key", "whole", "other")
    centres = scratch.table(centres, "centres")
    centre = F.when(F.col("kind") == 2, F.col("whole")).otherwise(F.col("other"))
    links = scratch.table(_Map(centres.select("key"), scratch, "centres-map").met(variants, ["key"]).join(centres, "key").select("id", centre.alias("to")).filter("to IS NOT NULL AND to < id").distinct(), "links")

    pairs = links.join(worded.select("id", F.col("line").alias("a")), "id").join(worded.select(F.col("id").alias("to"), F.col("line").alias("b")), "to")
    pairs = pairs.withColumns({c: F.split(c, " ") for c in "ab"})
    # Within one edit: what the two share at their start and end covers all but one word of the longer.
    front = "coalesce(array_position(zip_with(a, b, (x, y) -> coalesce(x = y, false)), false) - 1, -1)"
    back = "coalesce(array_position(zip_with(reverse(a), reverse(b), (x, y) -> coalesce(x = y, false)), false) - 1, -1)"
    most = "greatest(size(a), size(b))"
    pairs = pairs.withColumn("f", F.expr(f"CASE WHEN {front} < 0 THEN size(a) ELSE {front} END")).withColumn("e", F.expr(f"CASE WHEN {back} < 0 THEN size(a) ELSE {back} END"))
    close = pairs.filter(f"abs(size(a) - size(b)) <= 1 AND f + e >= {most} - 1").select("id").distinct()
    dropped = scratch.table(near.join(close, "id", "left_semi").select("h", "g", F.lit(True).alias("near")), "dropped")

    # Lines with an earlier equal line, and all places of lines with an earlier near one.
    held = _Map(dropped.select("h", "g"), scratch, "dropped-map").marked(distinct, ["h", "g"], "maybe").filter("times > 1 OR maybe")
    judged = scratch.table(held.join(dropped, ["h", "g"], "left").filter("times > 1 OR near").select("h", "g", "times", F.col("first.doc").alias("d1"), F.col("first.t").alias("t1"), F.col("first.no").alias("n1"), "near"), "judged")
    places = occurrences.select("doc", "t", "no", "h", "g")
    common = F.col("times") > places.count() / HOT
    few, many = F.broadcast(judged.filter(common)), judged.filter(~common)
    rest = _Map(judged.select("h", "g"), scratch, "judged-map").met(places, ["h", "g"]).join(few.select("h", "g"), ["h", "g"], "left_anti")
    met = places.join(few, ["h", "g"]).unionByName(rest.join(many, ["h", "g"]))
    gone = met.filter(F.col("near").isNotNull() | (place != F.struct("d1", "t1", "n1"))).select("doc", "t", "no").distinct()
    result = scratch.table(gone.groupBy("doc", "t").agg(F.array_sort(F.collect_list("no")).alias("gone")), "gone")
    scratch.drop("lines", "distinct", "near", "worded", "variants", "links", "judged", "shared", "centres", "dropped", *(f"{k}-map" for k in ("shared", "near", "centres", "dropped", "judged")))
    return result


def dedup_lines(docs: DataFrame, min_words: int = 6, id_col: str = "doc_id", text_col: str = "text", keep_columns: list[str] | None = None) -> DataFrame:
    """keep_columns of docs (all by default) with text_col rebuilt from the lines that stay; then the numbers of its lines and of those removed.

    The two last columns are called _wf_lines and _wf_removed, with underscores
    behind where a column of docs has that name.
    """
    scratch = Scratch(docs.sparkSession)
    columns = docs.columns if keep_columns is None else keep_columns
    row_id, text_hash, doc, t, gone, every, flags, n_lines, n_removed, hit = fresh(docs.columns, *(f"_wf_{c}" for c in ("id", "h", "doc", "t", "gone", "all", "flags", "lines", "removed", "hit")))
    text = F.col(quoted(text_col))
    found = removed_lines(docs, scratch, min_words, id_col, text_col).toDF(doc, t, gone)
    rows = docs.withColumns({row_id: F.coalesce(F.col(quoted(id_col)).cast("long"), F.lit(-(1 << 63))), text_hash: F.xxhash64(text)})
    # Texts that surely lose no line stay where they are.
    rows = _Map(found.select(doc, t), scratch, "gone-map").marked(rows, [row_id, text_hash], hit)
    moved = rows.filter(F.col(hit)).join(found, (F.col(row_id) == F.col(doc)) & (F.col(text_hash) == F.col(t)), "left")
    same = [F.col(quoted(c)) for c in docs.columns]
    rows = moved.select(*same, gone).union(rows.filter(~F.col(hit)).select(*same, F.lit(None).cast(found.schema[gone].dataType).alias(gone)))
    # The removed numbers, sorted, become a flag for each line in one pass.
    mark = F.expr(
        f"flatten(zip_with(concat(array(-1), {gone}), concat({gone}, array(size({every}))), "
        f"(a, b) -> concat(array_repeat(false, b - a - 1), CASE WHEN b < size({every}) THEN array(true) ELSE array() END)))"
    )
    lines = rows.withColumn(every, F.split(text, "\n")).withColumn(flags, F.when(F.col(gone).isNotNull(), mark))
    stay = F.array_join(F.zip_with(every, flags, lambda line, off: F.when(~off, line)), "\n")  # nulls are left out
    rebuilt = F.coalesce(F.when(F.col(gone).isNotNull(), stay), text)
    sizes = [F.greatest(F.coalesce(F.size(c), F.lit(0)), F.lit(0)).cast("long").alias(name) for c, name in ((every, n_lines), (gone, n_removed))]
    return lines.select(*(rebuilt.alias(c) if c == text_col else F.col(quoted(c)) for c in columns), *sizes)

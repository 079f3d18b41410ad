"""Repeated runs of lines by a suffix array over line names, without Python.

1. Lines get names in a global order (that of their hashes): the number of lines, counted with their copies, before them.
2. Prefix doubling: a place's rank, of its first k lines, and the rank of the place k lines on give the rank of
   its first 2k lines, by one distributed sort of the pairs that occur. Only places that share their rank take part; a
   place that doesn't keeps it, and a row leaves once all its places are done. Suffixes that are equal up to
   the ends of their texts keep one rank. Ranks are places in the suffix array throughout.
3. The longest common prefix of neighbours in the array comes from the ranks of each round: from the highest
   down, equal ranks at the lines reached so far add as many lines.
4. An interval of depth n is a maximal stretch of the array whose neighbours share n lines. Its least place, by document, stays,
   the others begin copies. Copies that continue each other make a maximal run, and every line of one is deleted.

A run is deleted if it has ``min_lines`` lines or, if it is given, ``min_words`` words: the intervals of depth ``min_lines`` give
all runs of so many lines or more, those of each depth below it the shorter ones, whose words are counted. A word ends at a
blank, after 16 characters, or after two where the script writes no blanks, so a paragraph in any script and unbroken
data have their size.

Cases: a null text has no line, an empty one a single empty line; lines are compared as they are; empty lines
count; a run may overlap its own copy; of equal runs the one in the row with the least id stays (null ids
last, repeated rows in the order of a stored row number); an empty table gives no rows; other columns are
not read. A line that a third of all rows hold is one row per task and rank in every aggregation, its pairs are
dealt over the sort's tasks by what follows it, and joins read stored tables, so that AQE can split it.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window as W

from splitsight.llm.places import numbered
from splitsight.llm.words import free_name
from splitsight.session import stored

MIN_LINES = 3
MIN_WORDS = 20
# Groups of the suffix array whose intervals one window finds.
BLOCK = 1 << 16
UNSPACED = r"\p{IsHan}\p{IsHiragana}\p{IsKatakana}\p{IsThai}\p{IsLao}\p{IsKhmer}\p{IsMyanmar}"
WORD = rf"[{UNSPACED}]{{1,2}}|[^\x09-\x0D\x20{UNSPACED}]{{1,16}}"


def _numbered(docs: DataFrame, doc_id: str, text: str, sizes: bool = False) -> DataFrame:
    """Stored (id, row, n, lines): pairs of hashes, 96 bits, stand for the lines; ``sizes`` are their words."""
    lines = F.split(F.col(text), "\n", -1)
    hashed = F.transform(lines, lambda x: F.struct(F.xxhash64(x).alias("h"), F.hash(x).alias("g")))
    counts = [F.transform(lines, lambda x: F.regexp_count(x, F.lit(WORD))).alias("sizes")] if sizes else []
    rows = docs.select(F.col(doc_id).alias("id"), hashed.alias("lines"), *counts, F.monotonically_increasing_id().alias("row"))
    return stored(rows.withColumn("n", F.when(F.col("lines").isNull(), 0).otherwise(F.size("lines"))), "lines")


def _place() -> Column:
    """Orders lines by document, then position."""
    return F.struct(F.col("id").isNull().alias("none"), "id", "row", "at")


def _before(groups: DataFrame, keys: list[str]) -> DataFrame:
    """``groups`` (keys, copies) with ``before``: the copies of all groups before, in the order of the keys."""
    ordered = stored(groups.orderBy(*keys).withColumn("seen", F.monotonically_increasing_id()), "line-order")
    ordered = ordered.withColumn("part", F.shiftright("seen", 33))
    within = F.sum("copies").over(W.partitionBy("part").orderBy("seen")) - F.col("copies")
    sizes = ordered.groupBy("part").agg(F.sum("copies").alias("size"))
    # One row per partition of the sort.
    earlier = F.coalesce(F.sum("size").over(W.orderBy("part").rowsBetween(W.unboundedPreceding, -1)), F.lit(0))
    sizes = F.broadcast(sizes.select("part", earlier.alias("earlier")))
    return ordered.withColumn("within", within).join(sizes, "part").select(*groups.columns, (F.col("earlier") + F.col("within")).alias("before"))


def suffix_ranks(rows: DataFrame) -> tuple[DataFrame, list[DataFrame]]:
    """Final ranks of all places whose line stands elsewhere too, and the stored ranks of each round.

    Ranks (id, row, n, at, line, rank) are equal for suffixes that are equal to the end. Round j has the ranks by 2^j lines,
    of the rows with places that still shared theirs.
    """
    lines = rows.select("id", "row", "n", F.posexplode("lines").alias("at", "line")).select("id", "row", "n", "at", "line.h", "line.g")
    names = _before(lines.groupBy("h", "g").agg(F.count("*").alias("copies")), ["h", "g"])
    shared = F.col("copies") > 1
    state = lines.join(names.hint("merge"), ["h", "g"]).select("id", "row", "n", "at", F.when(shared, F.col("before")).alias("line"), F.col("before").alias("rank"), shared.alias("open"))
    by_row = W.partitionBy("row")  # A document's lines are bounded by its text.
    levels, done = [], []
    while True:
        step = 1 << len(levels)
        following = F.coalesce(F.first("rank").over(by_row.orderBy("at").rangeBetween(step, step)), F.lit(-1))
        state = state.withColumn("live", F.max("open").over(by_row))
        # A text of lines that stand nowhere else takes no further part.
        state = stored((state if levels else state.where("live")).withColumn("next", following), "line-ranks")
        done.append(state.where("NOT live AND line IS NOT NULL").select("id", "row", "n", "at", "line", "rank"))
        pairs = stored(state.where("open").groupBy("rank", "next").agg(F.count("*").alias("copies")), "line-pairs")
        if pairs.isEmpty():
            break
        levels.append(state.where("live"))
        placed = stored(_before(pairs, ["rank", "next"]), "line-pairs")
        first = placed.groupBy("rank").agg(F.min("before").alias("first"))
        named = placed.join(first.hint("merge"), "rank")
        # Nothing follows: equal to the end.
        again = (F.col("copies") > 1) & (F.col("next") >= 0)
        named = named.select("rank", "next", (F.col("rank") + F.col("before") - F.col("first")).alias("renamed"), again.alias("open"))
        live = state.where("live").drop("live")
        renamed = live.where("open").drop("open").join(named.hint("merge"), ["rank", "next"]).drop("rank", "next").withColumnRenamed("renamed", "rank")
        state = renamed.unionByName(live.where("NOT open").drop("next"))
    final = done[0]
    for part in done[1:]:
        final = final.unionByName(part)
    return final, levels


def suffix_array(rows: DataFrame) -> tuple[DataFrame, DataFrame]:
    """The places (as of ``suffix_ranks``) and the stored array: one row per rank.

    ``number`` is the rank's from 0, ``least`` its least place, ``copies`` its places, ``length`` the lines to the end, and ``lcp`` the
    lines shared with the rank before; the places of one rank share all.
    """
    places, levels = suffix_ranks(rows)
    groups = places.groupBy("rank").agg(F.min("line").alias("line"), F.min(_place()).alias("least"), F.count("*").alias("copies"), F.min(F.col("n") - F.col("at")).alias("length"))
    groups = stored(numbered(stored(groups, "line-groups"), [F.col("rank")], "number"), "line-groups")
    previous = groups.select((F.col("number") + 1).alias("number"), F.col("line").alias("line_b"), F.col("least.row").alias("row_b"), F.col("least.at").alias("at_b"), F.col("length").alias("length_b"))
    beside = groups.select("number", "line", F.col("least.row").alias("row_a"), F.col("least.at").alias("at_a"), "length").join(previous.hint("merge"), "number")
    beside = beside.where("line = line_b").drop("line", "line_b").withColumn("lcp", F.lit(0))
    for j in range(len(levels) - 1, -1, -1):
        for side in "ab":
            reached = levels[j].select(F.col("row").alias(f"row_{side}"), F.col("at").alias(f"to_{side}"), F.col("rank").alias(f"rank_{side}"))
            beside = beside.withColumn(f"to_{side}", F.col(f"at_{side}") + F.col("lcp")).join(reached.hint("merge"), [f"row_{side}", f"to_{side}"], "left")
        longer = F.col("lcp") + F.when(F.col("rank_a") == F.col("rank_b"), 1 << j).otherwise(0)
        beside = stored(beside.withColumn("lcp", longer).drop("to_a", "to_b", "rank_a", "rank_b"), "line-prefixes")
    # Ranks of suffixes that end sooner stand for fewer lines.
    shared = beside.select("number", F.least("lcp", "length", "length_b").alias("lcp"))
    joined = groups.drop("line").join(shared.hint("merge"), "number", "left")
    return places, stored(joined.withColumn("lcp", F.coalesce("lcp", F.lit(0))), "suffix-array")


def _depth_ranks(places: DataFrame, array: DataFrame, depth: int) -> DataFrame:
    """(id, row, at, rank): places whose ``depth`` lines stand elsewhere too; the rank is the interval's least place."""
    block = F.floor(F.col("number") / BLOCK)
    begins = F.when(F.col("lcp") < depth, F.col("number"))
    marked = array.where(F.col("length") >= depth).select("number", "rank", "least", "copies", block.alias("block"), begins.alias("begins"))
    inside = F.max("begins").over(W.partitionBy("block").orderBy("number"))
    # One row per block.
    carried = marked.groupBy("block").agg(F.max("begins").alias("last"))
    carried = carried.select("block", F.max("last").over(W.orderBy("block").rowsBetween(W.unboundedPreceding, -1)).alias("carried"))
    marked = marked.withColumn("inside", inside).join(carried.hint("merge"), "block").select("rank", "least", "copies", F.coalesce("inside", "carried").alias("interval"))
    marked = stored(marked, "line-intervals")
    least = marked.groupBy("interval").agg(F.min("least").alias("first"), F.sum("copies").alias("copies")).where("copies > 1").drop("copies")
    named = stored(marked.select("rank", "interval").join(least.hint("merge"), "interval").select("rank", "first"), "line-intervals")
    held = places.where(F.col("n") - F.col("at") >= depth).select("id", "row", "at", "rank")
    return stored(held.join(named.hint("merge"), "rank").select("id", "row", "at", F.col("first").alias("rank")), "line-ranks")


def line_ranks(rows: DataFrame, depth: int) -> DataFrame:
    """(id, row, at, rank): places whose ``depth`` lines stand elsewhere too; equal ranks are one interval."""
    return _depth_ranks(*suffix_array(rows), depth)


def intervals(rows: DataFrame, depth: int) -> DataFrame:
    """The intervals of the suffix array: first place (id, row, at), number of places."""
    return line_ranks(rows, depth).groupBy("rank").agg(F.count("*").alias("n")).select("rank.id", "rank.row", "rank.at", "n")


def _copies(ranks: DataFrame) -> DataFrame:
    """Places whose lines stand earlier too, with the first of these places."""
    place = F.struct(F.col("row").alias("row"), F.col("at").alias("at"))
    copies = ranks.where(F.struct("rank.row", "rank.at") != place)
    return copies.select("row", "at", F.col("rank.row").alias("from_row"), F.col("rank.at").alias("from_at"), F.col("rank.id").alias("from_id"))


def copied_runs(rows: DataFrame, depth: int) -> DataFrame:
    """Maximal copied runs: row, first line, line after the last, and the row and line of the earlier copy."""
    return _runs(line_ranks(rows, depth), depth)


def _runs(ranks: DataFrame, depth: int) -> DataFrame:
    copies = _copies(ranks)
    order = W.partitionBy("row").orderBy("at")
    follows = (F.lag("at").over(order) == F.col("at") - 1) & (F.lag("from_row").over(order) == F.col("from_row")) & (F.lag("from_at").over(order) == F.col("from_at") - 1)
    marked = copies.withColumn("begins", F.when(follows, 0).otherwise(1))
    runs = marked.withColumn("run", F.sum("begins").over(order)).groupBy("row", "run")
    found = runs.agg(F.min("at").alias("first"), F.max("at").alias("last"), F.min("from_at").alias("from_at"), F.first("from_row").alias("from_row"), F.first("from_id").alias("from_id"))
    return found.select("row", "first", (F.col("last") + depth).alias("end"), "from_id", "from_row", "from_at")


def _wordy_runs(rows: DataFrame, ranks: DataFrame, depth: int, min_words: int) -> DataFrame:
    """Copied runs of just ``depth`` lines that have enough words."""
    window = F.transform("sizes", lambda _, i: F.aggregate(F.slice("sizes", i + 1, depth), F.lit(0), lambda a, x: a + x))
    enough = rows.select("row", F.posexplode(window).alias("at", "words")).where(F.col("words") >= min_words).select("row", "at")
    copies = _copies(ranks).join(enough.hint("merge"), ["row", "at"])
    return copies.select("row", F.col("at").alias("first"), (F.col("at") + depth).alias("end"), "from_id")


def repeated_lines(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", min_lines: int = MIN_LINES, min_words: int | None = None) -> DataFrame:
    """Per row: id, ``n_lines``, sorted ``deleted`` line numbers (from 0), and the ids that the runs come from.

    A run needs ``min_lines`` lines or, if it is given, ``min_words`` words.
    """
    rows = _numbered(docs, doc_id, text, min_words is not None)
    places, array = suffix_array(rows)
    runs = _runs(_depth_ranks(places, array, min_lines), min_lines).select("row", "first", "end", "from_id")
    if min_words is not None:
        for depth in range(1, min_lines):
            runs = runs.unionByName(_wordy_runs(rows, _depth_ranks(places, array, depth), depth, min_words))
    lines = F.array_sort(F.array_distinct(F.flatten(F.collect_list(F.sequence("first", F.col("end") - 1)))))
    per_row = runs.groupBy("row").agg(lines.alias("deleted"), F.array_sort(F.collect_set("from_id")).alias("from_ids"))
    kind = docs.schema[doc_id].dataType.simpleString()
    return rows.select("id", "row", "n").join(per_row, "row", "left").select(
        F.col("id").alias(doc_id),
        "row",
        F.col("n").cast("long").alias("n_lines"),
        F.coalesce("deleted", F.expr("cast(array() as array<int>)")).alias("deleted"),
        F.coalesce("from_ids", F.expr(f"cast(array() as array<{kind}>)")).alias("from_ids"),
    )


def without_repeated_lines(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", min_lines: int = MIN_LINES, min_words: int | None = None) -> DataFrame:
    """The rows without the lines of copied runs; the other columns as they are."""
    number, removed, known = (free_name(docs, name) for name in ("line_row", "deleted", "row_of_deleted"))
    rows = stored(docs.withColumn(number, F.monotonically_increasing_id()), "line-rows")
    key = F.struct(F.col(doc_id).isNull(), F.col(doc_id), F.col(number))
    found = repeated_lines(rows.withColumn(number, key), number, text, min_lines, min_words)
    found = found.where(F.size("deleted") > 0).select(F.col(f"{number}.{number}").alias(known), F.col("deleted").alias(removed))
    lines = F.split(F.col(text), "\n", -1)
    kept = F.filter(lines, lambda _, i: ~F.array_contains(F.col(removed), i))
    cut = F.when(F.col(removed).isNull(), F.col(text)).otherwise(F.array_join(kept, "\n"))
    joined = rows.join(found, F.col(number) == F.col(known), "left")
    return joined.select(*[cut.alias(c) if c == text else F.col(f"`{c}`") for c in docs.columns])

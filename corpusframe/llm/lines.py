"""Line dedup over a suffix array of line ids, built by distributed prefix doubling.

A document is its sequence of non-blank line ids. Suffixes are told apart by their first line, then by their
first two, four, eight ... lines, until no two are alike. A suffix carries one rank for each doubling: the ranks in order
(``path``) are its place in the suffix array, and its leading ranks say which prefixes it shares. A suffix whose prefix
is met once is settled and is not sorted again. Longest common prefixes of neighbours in the array are then put
together from shared ranks; neighbours that share at least ``min_lines`` lines form an interval, whose members are
the copies of one run. The earliest member stays, the lines of later ones go. Only DataFrame functions are used.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

from corpusframe.functions.text import bind
from corpusframe.llm.columns import apart
from corpusframe.llm.registry import register, table
from corpusframe.sources.scratch import written

MIN_LINES = 1
LAST = (1 << 63) - 1  # stands for a null id: later than every other
PLACE = ["_order", "_key", "_at"]
ROUNDS = 64  # more doublings than any text has; a rank is a place in a sort times this, plus its round
_BLANK = r"^[\x20\x09-\x0D]*$"


def _lines(text: str) -> Column:
    return F.split(F.coalesce(F.col(text), F.lit("")), "\n", -1)


def _identified(docs: DataFrame, doc_id: str, text: str) -> DataFrame:
    order = F.coalesce(F.col(doc_id).cast("long"), F.lit(LAST))
    return docs.withColumn("_order", order).withColumn("_key", F.xxhash64(F.col(text)))


def _ranked(groups: DataFrame, by: list[str], turn: int) -> DataFrame:
    """``groups`` with ``_rank``, which grows along a global sort and is met in no other round."""
    ordered = groups.orderBy(*by).withColumn("_rank", F.monotonically_increasing_id() * ROUNDS + turn)
    return written(ordered.drop(*[c for c in by if c.startswith("_sort")]), "ranks")


def first_ranks(docs: DataFrame, text: str = "text") -> DataFrame:
    """(_order, _key, _at, path, open) of lines that occur at least twice; blank lines are no part of a sequence."""
    lines = F.filter(_lines(text), lambda line: ~line.rlike(_BLANK))
    own = docs.select("_order", "_key", F.posexplode(lines).alias("_at", "line"))
    own = own.select(*PLACE, F.xxhash64("line").alias("a"), F.crc32(F.col("line").cast("binary")).alias("b"))
    repeated = own.groupBy("a", "b").agg(F.count(F.lit(1)).alias("n")).filter("n > 1").select("a", "b")
    ranks = _ranked(repeated, ["a", "b"], 0)
    found = own.join(ranks, ["a", "b"]).select(*PLACE, F.array("_rank").alias("path")).distinct()
    return written(found.withColumn("open", F.lit(True)), "suffixes")


def _last(path: str) -> Column:
    return F.element_at(path, -1)


def doubled(suffixes: DataFrame, turn: int) -> DataFrame:
    """Suffixes whose open ones carry one rank more: that of their first 2^turn lines.

    It is the place of (own prefix, prefix of the tail half as long) in sorted order. A tail that starts with a line met
    once, or behind the end, makes the suffix unlike all others. A last rank is met in one path only, so it stands for the path.
    """
    half = 1 << (turn - 1)
    still = suffixes.filter("open").drop("open").withColumn("a", _last("path"))
    tails = suffixes.select("_order", "_key", (F.col("_at") - half).alias("_at"), _last("path").alias("b"), F.col("path").alias("tail"))
    pairs = written(still.join(tails, PLACE, "left"), "pairs")
    groups = pairs.filter("b is not null").groupBy("a", "b").agg(F.first("tail").alias("_sort"), F.count(F.lit(1)).alias("n"))
    ranks = _ranked(groups.select("a", "b", "_sort", (F.col("n") > 1).alias("open")), ["a", "_sort"], turn)
    alike = pairs.filter("b is not null").join(ranks, ["a", "b"]).select(*PLACE, F.concat("path", F.array("_rank")).alias("path"), "open")
    own = -1 - (F.monotonically_increasing_id() * ROUNDS + turn)
    alone = pairs.filter("b is null").select(*PLACE, F.concat("path", F.array(own)).alias("path"), F.lit(False).alias("open"))
    return written(suffixes.filter("not open").unionByName(alike).unionByName(alone), "suffixes")


def suffix_array(docs: DataFrame, text: str = "text") -> DataFrame:
    """(_order, _key, _at, path) of all suffixes that start with a repeated line; ascending ``path`` is the array."""
    found, turn = first_ranks(docs, text), 1
    while not found.filter("open").isEmpty():
        found, turn = doubled(found, turn), turn + 1
    return found.drop("open")


def _shared(a: str, b: str) -> Column:
    """How many leading ranks two different paths share: n of them say that 2^(n-1) lines are shared and 2^n are not."""
    return F.array_position(F.zip_with(a, b, lambda x, y: F.coalesce(x == y, F.lit(False))), False) - 1


def common_prefixes(array: DataFrame) -> DataFrame:
    """(_order, _key, _at, length): the longest prefix that a suffix shares with a neighbour in the array, at least one line.

    Neighbours are found inside each range of the sorted array; of a range only the first and last member go on to the next.
    A shared 2^k lines are followed by comparing the tails behind them, whose shared part is shorter.
    """
    ordered = written(array.orderBy("path").withColumn("_place", F.monotonically_increasing_id()), "array")
    row = F.struct(*PLACE, "path")
    own = Window.partitionBy("_part").orderBy("_place")
    ranged = ordered.select("_place", F.shiftright("_place", 33).alias("_part"), row.alias("q"))
    inside = ranged.select(F.lag("q").over(own).alias("p"), "q").filter("p is not null")
    ends = ranged.groupBy("_part").agg(F.min_by("q", "_place").alias("q"), F.max_by("q", "_place").alias("end"))
    across = ends.select(F.lag("end").over(Window.orderBy("_part")).alias("p"), "q").filter("p is not null")  # one row for each range
    ahead = inside.unionByName(across).withColumn("n", _shared("p.path", "q.path")).filter("n > 0")
    drop = lambda side: F.struct(*[F.col(f"{side}.{c}").alias(c) for c in PLACE]).alias(side)
    step = F.expr("shiftleft(1L, cast(n - 1 AS int))")
    pairs = written(ahead.select(drop("p"), drop("q"), step.alias("length"), (F.col("n") > 1).alias("more")), "neighbours")
    done = [pairs.filter("not more").drop("more")]
    pairs = pairs.filter("more").drop("more")
    while not pairs.isEmpty():
        for side in "pq":
            at = array.select(*[F.col(c).alias(f"{side}{c}") for c in PLACE], F.col("path").alias(f"{side}_path"))
            pairs = pairs.join(at, [F.col(f"{side}._order") == F.col(f"{side}_order"), F.col(f"{side}._key") == F.col(f"{side}_key"), F.col(f"{side}._at") + F.col("length") == F.col(f"{side}_at")], "left")
        pairs = pairs.withColumn("n", F.coalesce(_shared("p_path", "q_path"), F.lit(0)))
        longer = F.col("length") + F.when(F.col("n") > 0, step).otherwise(0)
        pairs = written(pairs.select("p", "q", longer.alias("length"), (F.col("n") > 1).alias("more")), "neighbours")
        done.append(pairs.filter("not more").drop("more"))
        pairs = pairs.filter("more").drop("more")
    every = done[0]
    for part in done[1:]:
        every = every.unionByName(part)
    both = every.select(F.explode(F.array("p", "q")).alias("at"), "length")
    return both.groupBy(*[F.col(f"at.{c}").alias(c) for c in PLACE]).agg(F.max("length").alias("length"))


def maximal_runs(array: DataFrame, min_lines: int = MIN_LINES) -> DataFrame:
    """(_order, _key, start, length) of suffixes' longest repeated prefixes that are not the tail of one that starts a line before."""
    own = Window.partitionBy("_order", "_key").orderBy("_at")
    after = F.lag(F.struct("_at", "length")).over(own).alias("before")
    found = common_prefixes(array).select(*PLACE, "length", after)
    tail = (F.col("before._at") == F.col("_at") - 1) & (F.col("before.length") > F.col("length"))
    return found.filter((F.col("length") >= min_lines) & ~F.coalesce(tail, F.lit(False))).select("_order", "_key", F.col("_at").alias("start"), "length")


def repeated_runs(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", min_lines: int = MIN_LINES) -> DataFrame:
    """Maximal repeated runs: (doc_id, start, length) where ``length`` lines from non-blank line ``start`` (from 0)
    also stand elsewhere, one more does not, and the run is not the tail of one that starts a line before.

    Null and empty texts have no runs, a null id is kept, repeated rows of one id and text are one document.
    """
    runs = maximal_runs(suffix_array(_identified(docs, doc_id, text), text), min_lines)
    return runs.select(F.when(F.col("_order") != LAST, F.col("_order")).alias("doc_id"), "start", "length")


def _intervals(array: DataFrame, length: int) -> DataFrame:
    """(_order, _key, _at, interval): suffixes that share ``length`` lines with others have one interval number."""
    level = length.bit_length() - 1
    ranks = array.filter((F.size("path") > level) & (F.element_at("path", level + 1) >= 0)).select(*PLACE, F.element_at("path", level + 1).alias("interval"))
    rest = length - (1 << level)
    if not rest:
        return ranks
    tails = ranks.select("_order", "_key", (F.col("_at") - rest).alias("_at"), F.col("interval").alias("tail"))
    return ranks.join(tails, PLACE).select(*PLACE, F.struct("interval", "tail").alias("interval"))


def _removed(array: DataFrame, min_lines: int) -> DataFrame:
    """(_order, _key, gone): non-blank line numbers inside later copies of runs of ``min_lines`` lines or more."""
    members = _intervals(array, min_lines)
    place = F.struct(*PLACE)
    earliest = members.groupBy("interval").agg(F.min(place).alias("earliest"))
    later = members.join(earliest, "interval").filter(place > F.col("earliest"))
    each = later.select("_order", "_key", F.explode(F.sequence(F.col("_at"), F.col("_at") + min_lines - 1)).alias("_at"))
    if min_lines > 1:
        each = each.distinct()
    return each.groupBy("_order", "_key").agg(F.collect_list("_at").alias("gone"))


def with_lines_removed(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", min_lines: int = MIN_LINES, runs: bool = False) -> DataFrame:
    """``docs`` with ``_n_lines``, ``_n_removed`` and the kept text in ``_kept``; with ``runs`` also ``_n_runs``, the
    maximal repeated runs of the document, and ``_longest_run``, the lines of the longest.

    Lines end at line feeds. Every line goes that is covered by a run of ``min_lines`` non-blank lines
    whose lines also start earlier: in a document of smaller id (null last; equal ids go by the hash of
    the text), or earlier in the same one. Runs are judged on the input. Blank lines stay, and are passed
    over when runs are compared. Texts without removed lines stay as they are, null too; a null or empty
    text has no line that can go. Repeated rows of one id and text are one document, not copies.
    """
    named = _identified(docs, doc_id, text)
    array = suffix_array(named.select("_order", "_key", F.col(text).alias("text")), "text")
    gone = _removed(array, min_lines)
    if runs:
        counts = maximal_runs(array, min_lines).groupBy("_order", "_key").agg(F.count(F.lit(1)).alias("n_runs"), F.max("length").alias("longest"))
        gone = counts.join(gone, ["_order", "_key"], "left")
    gone = gone.select([F.col(c).alias({"_order": "_ld_order", "_key": "_ld_key"}.get(c, f"_ld_{c}")) for c in gone.columns])
    found = named.join(gone, [F.col("_order") == F.col("_ld_order"), F.col("_key") == F.col("_ld_key")], "left")
    there = F.col("_ld_gone").isNotNull()

    def keep(lines):
        every = F.sequence(F.lit(0), F.size(lines) - 1)
        full = F.filter(every, lambda i: ~F.get(lines, i).rlike(_BLANK))
        numbers = bind(full, lambda places: F.transform(F.col("_ld_gone"), lambda i: F.get(places, i)))
        return F.array_join(F.transform(F.array_except(every, numbers), lambda i: F.get(lines, i)), "\n")

    kept = bind(_lines(text), keep)
    n_lines = F.when(F.col(text).isNull(), 0).otherwise(F.length(F.col(text)) - F.length(F.translate(F.col(text), "\n", "")) + 1)
    return found.select(
        *[F.col(f"`{c}`") for c in docs.columns],
        n_lines.cast("long").alias("_n_lines"),
        F.when(there, F.size("_ld_gone")).otherwise(0).cast("long").alias("_n_removed"),
        F.when(there, kept).otherwise(F.col(text)).alias("_kept"),
        *([F.coalesce(F.col(c), F.lit(0)).cast("long").alias(a) for c, a in (("_ld_n_runs", "_n_runs"), ("_ld_longest", "_longest_run"))] if runs else []),
    )


def without_repeated_lines(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", min_lines: int = MIN_LINES) -> DataFrame:
    """``docs`` with later copies of repeated line runs taken out of the text; all rows and columns stay."""
    own, name = apart(docs)
    found = with_lines_removed(own, name[doc_id], name[text], min_lines)
    return found.select(*[F.col("_kept" if c == text else name[c]).alias(c) for c in docs.columns])


SQL = r"""
WITH l AS (SELECT doc_id, generate_subscripts(s, 1) AS i, unnest(s) AS line FROM (SELECT doc_id, string_split(coalesce(text, ''), chr(10)) AS s FROM documents)),
q AS (SELECT doc_id, i, line, row_number() OVER (PARTITION BY doc_id ORDER BY i) AS p FROM l WHERE NOT regexp_matches(line, '^[\x20\x09-\x0D]*$')),
g AS (SELECT doc_id, i FROM (SELECT *, min(struct_pack(d := doc_id, p := p)) OVER (PARTITION BY line) AS f FROM q) WHERE f.d < doc_id OR f.p < p),
k AS (SELECT l.doc_id, count(*) AS n, count(g.i) AS gone, coalesce(string_agg(CASE WHEN g.i IS NULL THEN l.line END, chr(10) ORDER BY l.i), '') AS kept
  FROM l LEFT JOIN g ON l.doc_id = g.doc_id AND l.i = g.i GROUP BY l.doc_id),
j AS (SELECT a.doc_id AS d, a.p, b.doc_id AS e, b.p - a.p AS s, a.p - row_number() OVER (PARTITION BY a.doc_id, b.doc_id, b.p - a.p ORDER BY a.p) AS island
  FROM q a JOIN q b ON a.line = b.line AND (a.doc_id <> b.doc_id OR a.p <> b.p)),
m AS (SELECT d, p, max(len) AS len FROM (SELECT d, p, max(p) OVER (PARTITION BY d, e, s, island) - p + 1 AS len FROM j) GROUP BY d, p),
r AS (SELECT a.d, count(*) AS n_runs, max(a.len) AS longest FROM m a LEFT JOIN m b ON a.d = b.d AND b.p = a.p - 1 WHERE coalesce(b.len, 0) <= a.len GROUP BY a.d)
SELECT doc_id, n AS n_lines, gone AS n_removed, sha256(kept) AS kept_sha256, coalesce(n_runs, 0) AS n_runs, coalesce(longest, 0) AS longest_run FROM k LEFT JOIN r ON doc_id = d
"""


@register("op8_line_suffix_array", SQL)
def op8_line_suffix_array(spark, sf_dir):
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    found = with_lines_removed(docs, runs=True)
    kept = F.sha2(F.coalesce("_kept", F.lit("")), 256).alias("kept_sha256")
    return found.select("doc_id", F.col("_n_lines").alias("n_lines"), F.col("_n_removed").alias("n_removed"), kept, F.col("_n_runs").alias("n_runs"), F.col("_longest_run").alias("longest_run"))

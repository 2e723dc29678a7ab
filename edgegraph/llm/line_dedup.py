"""Line dedup over repeated runs of lines (native).

Method: every document is a sequence of line IDs (blank lines left out). A suffix array over all sequences is grown by
distributed prefix doubling: at level k a position's rank orders the 2**k lines from there on, and comes from sorting the
distinct pairs of ranks at p and p + 2**(k-1). Lines and pairs that occur once cannot start a repeated run and drop out,
so a level only holds positions that still repeat. Positions that agree on their first ``len`` lines are an interval of
the suffix array with a common prefix of at least ``len``; such an interval is named by two overlapping ranks. Doubling
stops at the depth that ``min_words`` needs: a maximal repeated run of at least that many words is exactly covered by the
shortest stretches with ``min_words`` words that start or end at its lines. All copies of a run but the first, by
(doc_id, line), are deleted.

Hot lines: counts and minima are combined map-side, and the joins on a line or a pair of ranks have one row per key on
the other side, so skewed partitions can be split. Windows run over one document's repeated lines.

Defined results: null text has no lines and stays null; a null doc_id orders first; rows that agree in doc_id and text are one
document and are treated alike; lines are compared without blanks at their ends; an empty table gives an empty result;
extra columns are carried through.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from edgegraph.llm.tables import BLANKS, WORD, ckpt
from edgegraph.operators.positions import with_position

KEY = ["d", "t"]


def _key(docs: DataFrame) -> list[Column]:
    return [F.coalesce(F.col("doc_id").cast("bigint"), F.lit(-(1 << 63)).cast("bigint")).alias("d"),
            F.xxhash64("text").alias("t")]


def _split_lines(text: str = "text") -> Column:
    """Array of (line, no) of the lines with a word."""
    return F.filter(F.transform(F.split(F.col(text), "\n", -1),
                                lambda x, i: F.struct(F.trim(x, F.lit(BLANKS)).alias("line"), i.alias("no"))),
                    lambda s: s["line"] != "")


def line_table(docs: DataFrame) -> DataFrame:
    """``d, t, seq, id, w``: the words and 64-bit ID of every line with a word, numbered per document from 0."""
    d = docs.select(*_key(docs), F.posexplode(_split_lines()).alias("seq", "s"))
    return d.select(*KEY, "seq", F.xxhash64("s.line").alias("id"), F.size(F.regexp_extract_all("s.line", F.lit(WORD), F.lit(0)))
                    .alias("w"))


def _repeated(lines: DataFrame) -> DataFrame:
    """Lines whose ID occurs more than once, one row per (document, seq), with the stretch of consecutive seq."""
    ids = lines.groupBy("id").agg(F.count(F.lit(1)).alias("n")).where("n > 1").select("id")
    rows = lines.join(ids, "id").repartition(*KEY).dropDuplicates([*KEY, "seq"])
    by_doc = Window.partitionBy(*KEY).orderBy("seq")
    return rows.withColumn("isl", F.col("seq") - F.row_number().over(by_doc))


def _stretches(rows: DataFrame, min_words: int) -> DataFrame:
    """``d, t, start, len``: the shortest stretches of at least ``min_words`` words that start or end at each line.
    A line has a word, so the frames of ``min_words`` rows always reach far enough."""
    w = Window.partitionBy(*KEY, "isl").orderBy("seq")
    rows = rows.withColumn("cw", F.sum("w").over(w.rowsBetween(Window.unboundedPreceding, 0)))
    rows = (rows.withColumn("ahead", F.collect_list("cw").over(w.rowsBetween(0, min_words - 1)))
            .withColumn("back", F.collect_list(F.col("cw") - F.col("w")).over(w.rowsBetween(1 - min_words, 0))))
    ahead = F.expr(f"size(filter(ahead, c -> c - cw + w < {min_words})) + 1")
    back = F.expr(f"size(filter(back, c -> cw - c < {min_words})) + 1")
    f = rows.where(ahead <= F.size("ahead")).select(*KEY, F.col("seq").alias("start"), ahead.alias("len"))
    b = rows.where(back <= F.size("back")).select(*KEY, (F.col("seq") - back + 1).alias("start"), back.alias("len"))
    return f.unionByName(b).distinct()


def _next_level(ranks: DataFrame, step: int) -> DataFrame:
    """Ranks of twice the length: distinct repeated pairs, sorted and numbered, joined back to their positions."""
    w = Window.partitionBy(*KEY, "isl").orderBy("seq")
    # positions that dropped out leave gaps, so the partner is looked up by its distance in the document
    pairs = (ranks.withColumn("_s", F.collect_list(F.struct("seq", "r")).over(w.rangeBetween(step, step)))
             .where(F.size("_s") > 0).select(*KEY, "isl", "seq", F.col("r").alias("r1"), F.col("_s")[0]["r"].alias("r2")))
    pairs = ckpt(pairs)
    names = pairs.groupBy("r1", "r2").agg(F.count(F.lit(1)).alias("n")).where("n > 1").select("r1", "r2")
    names = with_position(names, ["r1", "r2"], "r")
    return ckpt(pairs.join(names, ["r1", "r2"]).select(*KEY, "isl", "seq", "r"))


def later_copies(lines: DataFrame, min_words: int = 50) -> DataFrame:
    """``d, t, start, len``: stretches of ``min_words`` words or a little more whose lines occur earlier."""
    rows = ckpt(_repeated(lines))
    runs = ckpt(_stretches(rows, min_words))
    ranks = rows.select(*KEY, "isl", "seq", F.col("id").alias("r"))
    longest = runs.agg(F.max("len")).first()[0] or 0
    found = None
    size = 1
    while size <= longest:
        mine = runs.where((F.col("len") >= size) & (F.col("len") < 2 * size))
        at = ranks.select(*KEY, "seq", "r")
        mine = (mine.join(at.withColumnsRenamed({"seq": "start", "r": "ra"}), [*KEY, "start"])
                .withColumn("seq", F.col("start") + F.col("len") - size)
                .join(at.withColumnRenamed("r", "rb"), [*KEY, "seq"]).drop("seq"))
        place = F.struct("d", "t", "start")
        groups = (mine.groupBy("len", "ra", "rb").agg(F.min(place).alias("first"), F.count(F.lit(1)).alias("n"))
                  .where("n > 1").drop("n"))
        hits = mine.join(groups, ["len", "ra", "rb"]).where(place > F.col("first")).select(*KEY, "start", "len")
        found = hits if found is None else found.unionByName(hits)
        if 2 * size <= longest:
            ranks = _next_level(ranks, size)
        size *= 2
    return runs.limit(0) if found is None else found


def deletions(docs: DataFrame, min_words: int = 50) -> DataFrame:
    """``d, t, removed``: per document with later copies, the sorted seq numbers of the lines to delete."""
    hits = later_copies(line_table(docs), min_words)
    return (hits.groupBy(*KEY).agg(F.collect_set(F.struct("start", "len")).alias("runs"))
            .select(*KEY, F.expr("array_sort(array_distinct(flatten(transform(runs, "
                                 "x -> sequence(x.start, x.start + x.len - 1)))))").alias("removed")))


def annotate(docs: DataFrame, keep: Sequence[str], min_words: int = 50,
             text: str | None = None) -> DataFrame:
    """``keep`` columns, n_lines, n_removed (lines with a word, all and deleted), removed_lines (their line numbers) and,
    if ``text`` names one of them or a field of one, ``new_text`` for every row."""
    dels = deletions(docs, min_words)
    nos = F.transform(_split_lines(), lambda s: s["no"]).alias("nos")
    j = docs.select(*keep, *_key(docs), nos).join(dels, KEY, "left")
    j = j.withColumn("removed_lines", F.expr("coalesce(transform(removed, s -> nos[s]), CAST(array() AS array<int>))"))
    out = [*keep, F.expr("CAST(coalesce(size(nos), 0) AS bigint)").alias("n_lines"),
           F.size("removed_lines").cast("bigint").alias("n_removed"), "removed_lines"]
    if text:
        out.append(F.when(F.size("removed_lines") == 0, F.col(text)).otherwise(F.expr(
            f"array_join(filter(split({text}, '\\n', -1), (x, i) -> NOT array_contains(removed_lines, i)), '\\n')"))
            .alias("new_text"))
    return j.select(*out)


def dedup_lines(docs: DataFrame, min_words: int = 50) -> DataFrame:
    """``docs`` with the later copies deleted from ``text``; n_chars follows the text if there is such a column. A document
    of which nothing is left but blank lines is a copy throughout and goes."""
    d = docs.select(F.struct(*docs.columns).alias("_row"), "doc_id", "text")
    a = annotate(d, ["_row"], min_words, "_row.text").where((F.col("n_removed") == 0) | (F.col("n_removed") < F.col("n_lines")))
    cols = {c: F.col("_row").getField(c) for c in docs.columns}
    cols["text"] = F.col("new_text")
    if "n_chars" in cols:
        cols["n_chars"] = (F.when(F.col("n_removed") > 0, F.length("new_text").cast(docs.schema["n_chars"].dataType))
                           .otherwise(cols["n_chars"]))
    return a.select(*[v.alias(k) for k, v in cols.items()])

"""Quality rules with adaptive thresholds (native).

Method: every text gets a few integer metrics; per (language, source, metric) they are summarised in a mergeable
quantile sketch, and the sketch decides the cut-off: it lies in the middle of the widest gap between neighbouring buckets from the
third quartile upwards, measured as a ratio, that is, where the group's own bulk ends and something of another kind begins.
Without a gap of ``FACTOR`` or more there is no cut-off, so even groups lose nothing. Ratios are taken after adding
``RESOLUTION``, below which differences of these metrics say nothing. The cut-offs are joined back to the documents. The sketch is a log-linear histogram: a value's bucket keeps its leading
``SKETCH_BITS`` bits, so a quantile has a relative error below 2**-(SKETCH_BITS-1), a sketch has a bounded number
of buckets whatever the data, and merging two sketches adds their bucket counts (``groupBy``, combined map-side).
Groups with fewer than ``min_docs`` documents use the sketch merged over their language, then over everything.

Defined results: null or blank text has zero counts and fails the base rule; null language or source is a group of
its own; repeated rows are judged alike; an empty table gives an empty result; extra columns are carried through
by :func:`filter_documents` and never read.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from edgegraph.llm.tables import BLANKS, WORD, WORD_CHAR, ckpt, sized_join

SKETCH_BITS = 7
# What makes a text unlike the bulk of its group. Repeated lines and words aren't among them: a few of them part a sound text from
# texts without any by as wide a gap; the base rule and line dedup see to them.
METRICS = ("symbol_rate", "word_length", "mark_rate", "upper_rate")
RESOLUTION = 20
FACTOR = 1.5
NO_CUT = 1 << 62


def text_counts(docs: DataFrame, keep: list[str]) -> DataFrame:
    """``keep`` columns plus n_words, word_chars, n_symbols, n_lines, n_dup_lines, n_repeat_words, n_upper, n_marks,
    n_letters (bigint) of every whole text. All in-row array expressions: no shuffle, no Python."""
    text = F.coalesce(F.col("text"), F.lit(""))
    d = docs.select(*keep, text.alias("_t"))
    d = d.select(*keep, "_t", F.regexp_extract_all("_t", F.lit(WORD), F.lit(0)).alias("_w"),
                 F.filter(F.split("_t", "\n", -1), lambda x: x.rlike(WORD_CHAR)).alias("_l"))
    # 64-bit hash of every 3-word window
    d = d.withColumn("_h", F.expr(
        "CASE WHEN size(_w) < 3 THEN CAST(array() AS array<bigint>) ELSE "
        "transform(sequence(0, size(_w) - 3), i -> xxhash64(_w[i], _w[i + 1], _w[i + 2])) END"))
    # only texts with an equal pair of windows sort them, to find which positions repeat
    d = d.withColumn("_s", F.expr(
        "CASE WHEN size(array_distinct(_h)) < size(_h) THEN sort_array(transform(_h, (h, i) -> struct(h, i))) END"))
    d = d.withColumn("_p", F.expr(
        "zip_with(zip_with(_s, concat(array(CAST(NULL AS struct<h:bigint,i:int>)), slice(_s, 1, size(_s) - 1)), "
        "(a, b) -> struct(a.h AS h, a.i AS i, coalesce(a.h = b.h, false) AS p)), "
        "concat(slice(_s, 2, size(_s) - 1), array(CAST(NULL AS struct<h:bigint,i:int>))), "
        "(a, b) -> CASE WHEN a.p OR coalesce(a.h = b.h, false) THEN a.i END)"))
    d = d.withColumn("_q", F.expr("sort_array(filter(_p, x -> x IS NOT NULL))"))
    repeat = F.expr(
        "CASE WHEN size(_q) > 0 THEN aggregate(zip_with(_q, concat(slice(_q, 2, size(_q) - 1), array(2147483647)), "
        "(a, b) -> least(3, b - a)), 0L, (s, x) -> s + x) ELSE 0L END")
    chars = F.length(F.translate("_t", BLANKS, ""))
    return d.select(
        *keep, F.size("_w").cast("bigint").alias("n_words"), chars.cast("bigint").alias("word_chars"),
        (F.length("_t") - F.length(F.translate("_t", "#*$%&|<>", ""))).cast("bigint").alias("n_symbols"),
        F.size("_l").cast("bigint").alias("n_lines"),
        (F.size("_l") - F.size(F.array_distinct("_l"))).cast("bigint").alias("n_dup_lines"),
        repeat.alias("n_repeat_words"),
        F.regexp_count("_t", F.lit("[A-Z]")).cast("bigint").alias("n_upper"),
        F.regexp_count("_t", F.lit("[!-/:-@\\[-`{-~]")).cast("bigint").alias("n_marks"))


def _metrics(d: DataFrame) -> DataFrame:
    """Integer metrics: rates per thousand, word length in hundredths of a character."""
    def rate(part: str, whole: str, scale: int = 1000):
        return F.expr(f"{part} * {scale} div greatest({whole}, 1)")

    return (d.withColumn("symbol_rate", rate("n_symbols", "word_chars"))
            .withColumn("word_length", rate("word_chars", "n_words", 100))
            .withColumn("mark_rate", rate("n_marks", "word_chars"))
            .withColumn("upper_rate", rate("n_upper", "word_chars"))
            .withColumn("base_failed", (F.col("n_words") < 50) | (F.col("n_repeat_words") * 100 > F.col("n_words") * 50))
            # filters that use it are not pushed below: they would repeat the nested array expressions many times
            .withColumn("_once", F.monotonically_increasing_id()))


def sketch(values: DataFrame, keys: list[str], value: str = "value") -> DataFrame:
    """Mergeable quantile sketch: ``keys, bucket, n`` (``bucket`` = the smallest value of the bucket)."""
    bits = f"length(bin({value})) - {SKETCH_BITS}"
    bucket = F.expr(f"CASE WHEN {value} < {1 << SKETCH_BITS} THEN {value} ELSE "
                    f"shiftleft(shiftright({value}, {bits}), {bits}) END")
    return values.select(*keys, bucket.alias("bucket")).groupBy(*keys, "bucket").agg(F.count(F.lit(1)).alias("n"))


def merge(sketches: DataFrame, keys: list[str]) -> DataFrame:
    """The union's sketch over coarser ``keys``."""
    return sketches.groupBy(*keys, "bucket").agg(F.sum("n").alias("n"))


def cut_offs(sketches: DataFrame, keys: list[str]) -> DataFrame:
    """``keys, n_docs, cut``: the middle of the widest gap from the third quartile upwards, ``NO_CUT`` without one.
    The windows run over one sketch, whose bucket number is bounded."""
    w = Window.partitionBy(*keys)
    up = w.orderBy("bucket")
    d = sketches.select(*keys, "bucket", F.sum("n").over(up.rowsBetween(Window.unboundedPreceding, Window.currentRow)).alias("_c"),
                        F.sum("n").over(w).alias("_n"), F.lead("bucket").over(up).alias("_next"))
    ratio = (F.col("_next") + float(RESOLUTION)) / (F.col("bucket") + float(RESOLUTION))
    gap = F.when((F.col("_c") * 4 >= F.col("_n") * 3) & (ratio >= FACTOR), F.struct(
        ratio.alias("ratio"), (-F.col("bucket")).alias("low"), F.expr("(bucket + _next) div 2").alias("cut")))
    return d.groupBy(*keys).agg(F.max("_n").alias("n_docs"), F.coalesce(F.max(gap)["cut"], F.lit(NO_CUT)).alias("cut"))


def thresholds(metrics: DataFrame, min_docs: int = 30) -> DataFrame:
    """One row per (lang, source) with the upper cut-off ``t_<metric>`` of every metric."""
    pairs = F.explode(F.array(*[F.struct(F.lit(m).alias("metric"), F.col(m).alias("value")) for m in METRICS]))
    fine = ckpt(sketch(metrics.where(~F.col("base_failed") & (F.col("_once") >= 0)).select("lang", "source", pairs.alias("_m"))
                       .select("lang", "source", "_m.metric", "_m.value"), ["lang", "source", "metric"]))
    by_lang = merge(fine, ["lang", "metric"])
    everything = merge(fine, ["metric"])

    def by(s: DataFrame, keys: list[str], name: str) -> DataFrame:
        q = cut_offs(s, keys + ["metric"])
        enough = F.col("n_docs") >= min_docs if keys else F.lit(True)
        return q.where(enough).groupBy(*keys).agg(
            *[F.max(F.when(F.col("metric") == m, F.col("cut"))).alias(f"{name}_{m}") for m in METRICS])

    groups = fine.select("lang", "source").distinct()  # groups whose documents all fail the base rule need no cut-off
    out = sized_join(groups, by(fine, ["lang", "source"], "s"), ["lang", "source"])
    out = sized_join(out, by(by_lang, ["lang"], "l"), ["lang"])
    overall = by(everything, [], "a").first()  # one row of a few numbers
    return ckpt(out.select("lang", "source", *[
        F.coalesce(F.col(f"s_{m}"), F.col(f"l_{m}"), F.lit(overall[f"a_{m}"]).cast("bigint")).alias(f"t_{m}")
        for m in METRICS]))


def judge(docs: DataFrame, keep: list[str], min_docs: int = 30) -> DataFrame:
    """``keep`` columns, the counts, ``base_failed`` and ``kept`` for every row of ``docs`` (text, lang, source).

    The texts are counted once; the counts (with the ``keep`` columns) go to the shared folder, as the cut-offs need all of them."""
    cols = list(dict.fromkeys([*keep, "lang", "source"]))
    m = ckpt(_metrics(text_counts(docs, cols)))
    t = thresholds(m, min_docs)
    j = sized_join(m, t, ["lang", "source"])
    over = F.lit(False)
    for name in METRICS:
        over = over | F.coalesce(F.col(name) > F.col(f"t_{name}"), F.lit(False))
    return j.withColumn("kept", ~F.col("base_failed") & ~over)


def filter_documents(docs: DataFrame, min_docs: int = 30) -> DataFrame:
    """The rows of ``docs`` that pass, all columns unchanged. Texts are not shuffled: only the cut-off table
    (size-checked) travels."""
    d = docs.select(F.struct(*docs.columns).alias("_row"), "text", "lang", "source")
    return judge(d, ["_row"], min_docs).where(F.col("kept") & (F.col("_once") >= 0)).select("_row.*")

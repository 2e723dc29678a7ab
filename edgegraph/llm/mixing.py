"""Mixing sources to target weights (native).

Method: every source is cut into disjoint blocks by a hash permutation of its documents (id and text). A source's target fixes how
many passes over all its blocks the mix takes, plus a prefix of the permuted blocks for the remainder, the last block
cut at the document nearest the target; rows equal in id and text are one unit there, of which as many are taken as come
nearest. A multivariate-hypergeometric splitting tree then deals the exact numbers of
block instances among the output shards: a node's instances are halved by selection sampling over its sources, so each
child's counts are a multivariate-hypergeometric draw and the quotas add up exactly at every level. Within a shard the
copies are ordered by a hash.

Only per-source and per-block tables are shuffled; texts stay where they are until the mix is written by shard. Blocks
spread a hot source over many rows; its running block totals are computed by range partition. A tree row holds at most
about ``SOURCES_PER_TREE`` sources; more sources mean more trees, which fill the same shards.

Defined results: a null or blank text has size 0 and is taken with its block; a null source is a source of its own,
last in order; null and equal ids are told apart by their texts; rows equal in both share their block and are counted each; an empty table gives an empty mix; extra columns
are carried through and never read.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from edgegraph.functions import md5_bigint
from edgegraph.llm.tables import WORD, ckpt, sized_join
from edgegraph.operators.positions import OrderedFrame, keyed_position

WEIGHTS = (5, 2, 1)
MAX_REPEATS = 3
SOURCES_PER_TREE = 1024
# A tree walks the block instances of a node: blocks grow with the corpus, so that there are about this many at most.
MOST_BLOCKS = 1 << 20
SHARD_WORDS = 20_000_000


def source_targets(sizes: DataFrame, weights: Sequence[int] = WEIGHTS, max_repeats: int = MAX_REPEATS) -> DataFrame:
    """``key, source_size, n_docs, target`` per source. Weighted shares of all words; a share above ``max_repeats``
    times its source's size stops there and the excess is reshared by weight (water filling: in the order of size per
    weight the stopped sources are a prefix). The windows run over one row per source."""
    src = sizes.groupBy("key").agg(F.sum("size").alias("source_size"), F.count(F.lit(1)).alias("n_docs"))
    by_key = Window.orderBy("key")
    w = F.array(*[F.lit(int(x)) for x in weights])
    src = (src.withColumn("w", w[(F.row_number().over(by_key) - 1) % len(weights)].cast("double"))
           .withColumn("cap", F.col("source_size").cast("double") * max_repeats))
    fill = Window.orderBy(F.col("cap") / F.col("w"), "key")
    before = fill.rowsBetween(Window.unboundedPreceding, -1)
    onward = fill.rowsBetween(Window.currentRow, Window.unboundedFollowing)
    whole = Window.partitionBy()
    src = (src.withColumn("total", F.sum("source_size").over(whole).cast("double"))
           .withColumn("level", (F.col("total") - F.coalesce(F.sum("cap").over(before), F.lit(0.0)))
                       / F.sum("w").over(onward))
           .withColumn("rank", F.row_number().over(fill))
           .withColumn("full", F.col("level") * F.col("w") >= F.col("cap")))
    level = F.min(F.when(~F.col("full"), F.struct("rank", "level"))).over(whole)["level"]
    return src.select("key", "source_size", "n_docs",
                      F.when(F.col("full"), F.col("cap")).otherwise(level * F.col("w")).alias("target"))


def _split_tree(quotas: DataFrame, levels: int, seed: str) -> DataFrame:
    """``key, shard, quota``: deal each source's ``quota`` block instances among ``2**levels`` shards."""
    n = quotas.count()
    trees = max(1, -(-n // SOURCES_PER_TREE))
    node = (quotas.groupBy(F.pmod(F.xxhash64("key"), F.lit(trees)).alias("tree"))
            .agg(F.sort_array(F.collect_list(F.struct("key", "quota"))).alias("q"))
            .select("tree", F.lit(0).cast("bigint").alias("shard"), "q"))
    for level in range(levels):
        # take = half of the node's instances, an odd one goes left or right by hash
        node = node.withColumn("total", F.expr("aggregate(q, 0L, (s, x) -> s + x.quota)"))
        node = node.withColumn("half", F.expr(
            f"(total + pmod(xxhash64('{seed}', tree, {level}, shard), 2L)) div 2"))
        # selection sampling: an instance goes left with probability (places left) / (instances left)
        left = F.expr(
            "aggregate(q, named_struct('rem', total, 'free', half, 'out', CAST(array() AS array<bigint>)), (a, s) -> "
            "aggregate(CASE WHEN s.quota > 0 THEN sequence(1L, s.quota) ELSE CAST(array() AS array<bigint>) END, "
            "named_struct('rem', a.rem, 'free', a.free, 'n', 0L), (b, i) -> "
            f"CASE WHEN pmod(xxhash64('{seed}', {level}, tree, shard, s.key, i), b.rem) < b.free "
            "THEN named_struct('rem', b.rem - 1, 'free', b.free - 1, 'n', b.n + 1) "
            "ELSE named_struct('rem', b.rem - 1, 'free', b.free, 'n', b.n) END, "
            "b -> named_struct('rem', b.rem, 'free', b.free, 'out', concat(a.out, array(b.n)))), a -> a.out)")
        node = node.withColumn("l", left)
        node = node.select("tree", F.explode(F.array(
            F.struct((F.col("shard") * 2).alias("shard"), F.expr(
                "zip_with(q, l, (s, n) -> named_struct('key', s.key, 'quota', n))").alias("q")),
            F.struct((F.col("shard") * 2 + 1).alias("shard"), F.expr(
                "zip_with(q, l, (s, n) -> named_struct('key', s.key, 'quota', s.quota - n))").alias("q")))).alias("c"))
        node = ckpt(node.select("tree", "c.shard", "c.q"))
    return (node.select("shard", F.explode("q").alias("s")).where("s.quota > 0")
            .select(F.col("s.key").alias("key"), "shard", F.col("s.quota").alias("quota")))


def _hash(seed: str):
    """Place of a row in its source's permutation."""
    return md5_bigint(F.lit(seed), F.coalesce(F.col("doc_id").cast("string"), F.lit("null")), F.coalesce(F.md5(F.col("text")), F.lit("null")))


def document_shards(docs: DataFrame, keep: Sequence[str], weights: Sequence[int] = WEIGHTS,
                    max_repeats: int = MAX_REPEATS, levels: int | None = 4, block_words: int = 20_000,
                    block_docs: int = 2_000, seed: str = "mix") -> DataFrame:
    """``keep`` columns of every row plus size, source_size, target and ``shards``: one output shard (0 to
    ``2**levels - 1``) for each copy that the mix takes. ``levels`` follows from the total size (``SHARD_WORDS`` words a shard) if
    it is None. ``block_words`` and ``block_docs`` are the least sizes of a block; beyond ``MOST_BLOCKS`` blocks they grow."""
    key = F.when(F.col("source").isNull(), F.lit("1")).otherwise(F.concat(F.lit("0"), F.col("source")))
    size = F.coalesce(F.regexp_count("text", F.lit(WORD)), F.lit(0)).cast("bigint")
    h = _hash(seed)
    narrow = ckpt(docs.select("doc_id", key.alias("key"), size.alias("size"), h.alias("h")))
    whole = narrow.agg(F.sum("size").alias("words"), F.count(F.lit(1)).alias("rows")).first()
    block_words = max(block_words, (whole["words"] or 0) // MOST_BLOCKS)
    block_docs = max(block_docs, whole["rows"] // MOST_BLOCKS)
    if levels is None:
        levels = max(0, -(-(whole["words"] or 0) // SHARD_WORDS) - 1).bit_length()
    src = source_targets(narrow, weights, max_repeats)
    src = ckpt(src.select("*", F.expr(
        f"greatest(1L, (source_size + {block_words - 1}) div {block_words}, (n_docs + {block_docs - 1}) div {block_docs})")
        .alias("n_blocks"),
        F.expr("CASE WHEN source_size = 0 THEN 0L ELSE CAST(floor(target / source_size) AS bigint) END").alias("passes"))
        .withColumn("rest", F.col("target") - (F.col("passes") * F.col("source_size")).cast("double")))
    dealt = sized_join(narrow, src.select("key", "n_blocks"), ["key"], "inner").withColumn(
        "block", F.col("h") % F.col("n_blocks"))
    blocks = dealt.groupBy("key", "block").agg(F.sum("size").alias("words"))
    blocks = blocks.withColumn("p", md5_bigint(F.lit(seed), F.col("key"), F.col("block")))
    ranked = (OrderedFrame(blocks, ["key"], ["p", "block"]).running("cum", "words")
              .running("rank", F.lit(1).cast("bigint")).result())
    filled = blocks.groupBy("key").agg(F.count(F.lit(1)).alias("filled"))  # a block may have got no document
    src = ckpt(sized_join(src, filled, ["key"], "inner"))
    ranked = ckpt(sized_join(ranked, src, ["key"], "inner"))
    # the block in which the remainder ends, cut after the document whose middle is the last one below it
    border = ranked.where((F.col("cum") > F.col("rest")) & (F.col("cum") - F.col("words") < F.col("rest")))
    border = border.select("key", "block", (F.col("rest") - (F.col("cum") - F.col("words"))).alias("need"))
    inside = sized_join(dealt, border, ["key", "block"], "inner")
    # rows of equal hash are one unit of ``copies`` rows, of which ``part`` lie before the middle that is the last one below it
    unit = inside.groupBy("key", "block", "need", "h", "size").agg(F.count(F.lit(1)).alias("copies"))
    up = Window.partitionBy("key", "block").orderBy("h", "size").rowsBetween(Window.unboundedPreceding, -1)
    unit = unit.withColumn("left", F.col("need") - F.coalesce(F.sum(F.col("size") * F.col("copies")).over(up), F.lit(0)))
    unit = unit.withColumn("part", F.when(F.col("size") == 0, F.when(F.col("left") >= 0, F.col("copies")).otherwise(0)).otherwise(
        F.least(F.col("copies"), F.floor(F.col("left") / F.greatest("size", F.lit(1)) + 0.5))))
    cuts = unit.where("part > 0").groupBy("key", "block").agg(
        F.max("h").alias("cut"), F.max_by(F.when(F.col("part") < F.col("copies"), F.col("part")), F.struct("h", "size")).alias("part"))
    cuts = ckpt(cuts)
    ranked = sized_join(ranked, cuts, ["key", "block"])
    extra = F.when((F.col("cum") <= F.col("rest")) | F.col("cut").isNotNull(), 1).otherwise(0)
    copies = ranked.withColumn("n", F.col("passes") + extra)
    quotas = copies.groupBy("key").agg(F.sum("n").alias("quota")).where("quota > 0")
    tree = _split_tree(ckpt(quotas), levels, seed)
    up = Window.partitionBy("key").orderBy("shard").rowsBetween(Window.unboundedPreceding, 0)
    places = (tree.withColumn("end", F.sum("quota").over(up))
              .select("key", "shard", F.explode(F.expr("sequence(end - quota, end - 1)")).alias("j")))
    drawn = (copies.where("n > 0").select("key", "block", "rank", "filled", "passes", "cut", "part",
                                          F.explode(F.expr("sequence(0L, n - 1)")).alias("pass"))
             .withColumn("j", F.col("pass") * F.col("filled") + F.col("rank") - 1))
    plan = (drawn.join(places, ["key", "j"]).groupBy("key", "block").agg(F.sort_array(F.collect_list(F.struct(
        "pass", "shard", F.when(F.col("pass") == F.col("passes"), F.col("cut")).alias("cut"),
        F.when(F.col("pass") == F.col("passes"), F.col("part")).alias("part")))).alias("copies")))
    rows = docs.select(*keep, key.alias("key"), size.alias("size"), h.alias("h"))
    rows = sized_join(rows, src.select("key", "source_size", "target", "n_blocks"), ["key"], "inner")
    rows = sized_join(rows.withColumn("block", F.col("h") % F.col("n_blocks")), ckpt(plan), ["key", "block"])
    partial = cuts.where("part IS NOT NULL").select("key", F.col("cut").alias("h"))
    if partial.limit(1).count():  # number the equal rows of which only a part is taken
        equal = sized_join(rows.withColumn("_place", F.monotonically_increasing_id()), partial, ["key", "h"], "inner")
        other = sized_join(rows, partial.withColumn("_split", F.lit(True)), ["key", "h"]).where("_split IS NULL").drop("_split")
        rows = other.withColumn("_nth", F.lit(1).cast("bigint")).unionByName(
            keyed_position(equal, ["key", "h"], ["_place"], "_nth").drop("_place"))
    else:
        rows = rows.withColumn("_nth", F.lit(1).cast("bigint"))
    shards = F.expr("transform(filter(coalesce(copies, array()), c -> c.cut IS NULL OR h < c.cut OR "
                    "(h = c.cut AND (c.part IS NULL OR _nth <= c.part))), c -> c.shard)")
    return rows.select(*keep, "size", "source_size", "target", shards.alias("shards"))


def mix(docs: DataFrame, levels: int | None = None, seed: str = "mix", **options) -> DataFrame:
    """The mixed corpus: every taken copy of every row with ``mix_shard`` and ``mix_order``, range-partitioned by
    (shard, order) and sorted; the order within a shard is a hash. Clashing input columns of these two names are replaced."""
    cols = [c for c in docs.columns if c not in ("mix_shard", "mix_order")]
    d = docs.select(*cols).withColumn("_row", F.struct(*cols))
    d = document_shards(d, ["_row"], levels=levels, seed=seed, **options)
    out = d.select("_row", F.posexplode("shards").alias("_copy", "mix_shard"))
    out = out.select("_row.*", "mix_shard", F.xxhash64(F.lit(seed), F.col("mix_shard"), F.col("_row.doc_id"),
                                                       F.col("_copy")).alias("mix_order"))
    return out.repartitionByRange("mix_shard", "mix_order").sortWithinPartitions("mix_shard", "mix_order")

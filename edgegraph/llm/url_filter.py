"""URL filters over a sorted digest array.

Method: a filter list becomes an array of 64-bit xxhash keys, sorted, cut into shards by the keys' high bits and written into
the shared folder together with the full strings. Scan tasks memory-map the shards they need, hash every string a URL
could match, probe all of a batch by vectorised binary search, and compare the stored string wherever a key agrees, so
a collision cannot match. A list of any length is built by Spark and never held by the driver or a single task.

Two kinds of entry share the array: rules ``host/path`` that allow or block a host, its subdomains and all paths that
begin so (the longest matching rule wins; of equally long ones the one with the longer host), and blocked terms, words of the host name. A URL
without a rule is blocked if its host holds a blocked term, else allowed.

Defined results: null URLs and URLs without ``://`` have empty host and path, fit no rule and are allowed; a rule that is listed
twice counts as its blocking entry; null or empty entries are ignored; repeated rows are judged alike; an empty table
gives an empty result, an empty list allows all; extra columns are carried through by :func:`filter_pages`.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import numpy as np
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from edgegraph.llm.tables import lower_ascii, make_folder, map_arrays, shared_folder, write_arrays

# The rules of the URL query.
RULES = (("org/", "allow"), ("example.org/es/", "block"), ("example.org/en/1", "block"), ("com/fr/", "allow"),
         ("com/de/", "block"))
# Words of host names that the method blocks.
BLOCKED_TERMS = ("ad", "ads", "adserver", "banner", "bet", "bets", "betting", "casino", "click", "clicks", "coupon", "doubleclick",
                 "jackpot", "lottery", "malware", "phishing", "poker", "popunder", "porn", "slots", "spam", "track", "tracker",
                 "tracking", "warez", "xxx")
SEED = 42  # of xxhash64 in Spark SQL


def host(url: Column) -> Column:
    return lower_ascii(F.coalesce(F.regexp_extract(url, "://([^/?#]*)", 1), F.lit("")))


def path(url: Column) -> Column:
    return F.coalesce(F.regexp_extract(url, "://[^/?#]*([^?#]*)", 1), F.lit(""))


def entries(spark: SparkSession, rules: Sequence[tuple[str, str]] = RULES, terms: Sequence[str] = BLOCKED_TERMS) -> DataFrame:
    """entry, verdict: rules as they are, terms after a blank (which no rule or host word holds)."""
    rows = [*rules, *((f" {t}", "block") for t in terms)]
    return spark.createDataFrame(rows, "entry string, verdict string")


class Index:
    """Where the shards lie; small, sent to every task."""

    def __init__(self, folder: str, bits: int, filled: list[bool], path_sizes: list[int]):
        self.folder, self.bits, self.filled, self.path_sizes = folder, bits, filled, path_sizes


def build(entry: DataFrame, bits: int | None = None) -> Index:
    """Write the digest array of ``entry`` (entry, verdict), ``2**bits`` shards (default: as the shuffle partitions)."""
    spark = entry.sparkSession
    if bits is None:
        bits = max(1, (int(spark.conf.get("spark.sql.shuffle.partitions")) - 1).bit_length())
    folder = shared_folder(spark, "urls")
    make_folder(folder)
    d = (entry.where("entry IS NOT NULL AND entry <> ''").groupBy("entry").agg(F.max("verdict").alias("verdict"))
         .withColumn("key", F.xxhash64("entry")).withColumn("shard", F.expr(f"shiftrightunsigned(key, {64 - bits})")))
    sizes = d.where("entry NOT LIKE ' %' AND instr(entry, '/') > 0").select(F.expr("length(entry) - instr(entry, '/') + 1").alias("n"))
    path_sizes = sorted(r[0] for r in sizes.distinct().collect())  # as many as path lengths

    def write(batches: Iterator) -> Iterator:
        import pyarrow as pa
        found: dict[int, list] = {}
        for b in batches:
            for s, key, text, verdict in zip(*(b.column(i).to_pylist() for i in range(4))):
                found.setdefault(s, []).append((key & 0xFFFFFFFFFFFFFFFF, text.encode(), verdict == "block"))
        for s, rows in found.items():
            rows.sort()
            texts = [r[1] for r in rows]
            write_arrays(f"{folder}/{s}", keys=np.array([r[0] for r in rows], np.uint64),
                         at=np.cumsum([0, *map(len, texts)]).astype(np.int64), text=np.frombuffer(b"".join(texts), np.uint8),
                         block=np.array([r[2] for r in rows], np.uint8))
        yield pa.RecordBatch.from_arrays([pa.array(list(found), pa.int64())], names=["shard"])

    rows = (d.select("shard", "key", "entry", "verdict").repartition(1 << bits, "shard").mapInArrow(write, "shard bigint")
            .collect())  # one row per shard
    filled = {r[0] for r in rows}
    return Index(folder, bits, [s in filled for s in range(1 << bits)], path_sizes)


class Probe:
    def __init__(self, index: Index):
        self.i, self.shards = index, {}

    def find(self, texts: list[bytes]) -> np.ndarray:
        """-1 for strings that are not in the array, else 1 for block and 0 for allow."""
        import xxhash
        out = np.full(len(texts), -1, np.int8)
        keys = np.fromiter((xxhash.xxh64_intdigest(t, SEED) for t in texts), np.uint64, len(texts))
        order = np.argsort(keys)
        cut = np.searchsorted((keys[order] >> np.uint64(64 - self.i.bits)).astype(np.int64), np.arange((1 << self.i.bits) + 1))
        for s in np.flatnonzero((np.diff(cut) > 0) & np.array(self.i.filled)):
            if s not in self.shards:
                self.shards[s] = map_arrays(f"{self.i.folder}/{s}")
            f, mine = self.shards[s], order[cut[s]:cut[s + 1]]
            lo = np.searchsorted(f["keys"], keys[mine], "left")
            hi = np.searchsorted(f["keys"], keys[mine], "right")
            for k in np.flatnonzero(hi > lo):
                for at in range(lo[k], hi[k]):  # equal keys: compare the strings
                    if f["text"][f["at"][at]:f["at"][at + 1]].tobytes() == texts[mine[k]]:
                        out[mine[k]] = f["block"][at]
        return out


def _judge(probe: Probe, hosts: list[str], paths: list[str]) -> tuple[list, list]:
    """Rule and verdict of each URL. All strings of the batch that could match are probed together."""
    number: dict[str, int] = {}
    wanted: list[tuple[list[int], list[int]]] = []
    for h, p in zip(hosts, paths):
        labels = h.split(".")
        fits = []
        if h:
            for i in range(len(labels)):
                suffix = ".".join(labels[i:])
                fits += [suffix + p[:n] for n in probe.i.path_sizes if n <= len(p)]
        fits.sort(key=lambda x: (-len(x), -x.find("/")))
        terms = [f" {t}" for label in labels for t in label.split("-") if t]
        wanted.append(([number.setdefault(x, len(number)) for x in fits], [number.setdefault(x, len(number)) for x in terms]))
    texts = list(number)
    found = probe.find([t.encode("utf-8", "surrogatepass") for t in texts])
    rule, verdict = [], []
    for fits, terms in wanted:
        best = next((x for x in fits if found[x] >= 0), None)
        rule.append(None if best is None else texts[best])
        blocked = found[best] == 1 if best is not None else any(found[x] == 1 for x in terms)
        verdict.append("block" if blocked else "allow")
    return rule, verdict


def judge(pages: DataFrame, index: Index, keep: Sequence[str]) -> DataFrame:
    """``keep`` columns (plain names), host, path, rule and verdict of every row's ``url``."""
    from pyspark.sql import types as T

    k = len(keep)

    def scan(batches: Iterator) -> Iterator:
        import pyarrow as pa
        probe = Probe(index)
        for b in batches:
            rule, verdict = _judge(probe, b.column(k).to_pylist(), b.column(k + 1).to_pylist())
            yield pa.RecordBatch.from_arrays([*b.columns, pa.array(rule, pa.string()), pa.array(verdict, pa.string())],
                                             names=[*keep, "host", "path", "rule", "verdict"])

    text = [T.StructField(c, T.StringType()) for c in ("host", "path", "rule", "verdict")]
    return (pages.select(*keep, host(F.col("url")).alias("_host"), path(F.col("url")).alias("_path"))
            .mapInArrow(scan, T.StructType([*[pages.schema[c] for c in keep], *text])))


def filter_pages(pages: DataFrame, index: Index) -> DataFrame:
    """The rows whose URL is allowed, unchanged."""
    d = pages.select(F.struct(*pages.columns).alias("_row"), "url")
    return judge(d, index, ["_row"]).where("verdict = 'allow'").select("_row.*")

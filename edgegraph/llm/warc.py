"""WARC archives and a globally ordered capture index.

Method: every page becomes one WARC record, written by Spark's text writer with a record separator of two line ends, so
files are committed atomically on any store. Pages with an equal payload of at least ``MIN_REVISIT`` bytes are stored
once: the smallest page_id is the response, the others are revisit records without a body. Archives are read back file by
file by Content-Length (a payload may hold anything), and response bodies are checked against their digest.

Index: each file's captures, sorted by (URL key, timestamp, page_id), are a run. Spark's range partitioning cuts the key
space into ranges of about ``range_rows`` captures; every run sends a sorted segment to each range, and one task per
range merges its k segments by a loser tree. Ranges are ordered among each other, so the result is one
global order; a URL captured very often spreads over several ranges, as the timestamp is part of the key.

Defined results: any bigint is a page_id (a page's capture time is ``EPOCH`` plus its page_id modulo ``SPAN`` seconds, so that
it exists for all of them); null html is an empty payload; null URLs have an empty key; null page_ids are responses unless a non-null one has
the payload; repeated rows of the smallest page_id are responses too; an empty table gives an empty index; other columns are
not archived.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from edgegraph.llm.tables import shared_folder, sized_join

MIN_REVISIT = 100
END = "\r\n\r\n"
REVISIT_PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
FILE_BYTES = 8 << 20
EPOCH = 1_700_000_000
SPAN = 1 << 33  # the last capture time lies in the year 2296
INDEX = ("page_id bigint, payload_bytes bigint, payload_digest string, record_type string, refers_to bigint, url string, "
         "url_key string, captured bigint, file string, offset bigint, length bigint")


def records(pages: DataFrame) -> DataFrame:
    """page_id, url, payload, bytes, digest, refers_to (null for responses) of every row."""
    payload = F.coalesce(F.col("html"), F.lit(""))
    d = pages.select(F.col("page_id").cast("bigint").alias("page_id"), "url", payload.alias("payload"),
                     F.octet_length(payload).cast("bigint").alias("bytes"),
                     F.sha2(payload.cast("binary"), 256).alias("digest"))
    first = (d.where(F.col("bytes") >= MIN_REVISIT).groupBy("digest").agg(
        F.min("page_id").alias("first"), F.count(F.lit(1)).alias("n")).where("n > 1").select("digest", "first"))
    d = sized_join(d, first, ["digest"])
    return d.withColumn("refers_to", F.when(~F.col("first").eqNullSafe(F.col("page_id")), F.col("first"))).drop("first")


def write(pages: DataFrame, folder: str) -> None:
    """Write the archives of all rows below ``folder``."""
    d = records(pages)
    mean = pages.agg(F.avg(F.octet_length("html"))).first()[0] or 0
    uri = F.regexp_replace(F.regexp_replace(F.regexp_replace(F.coalesce("url", F.lit("")), "%", "%25"), "\r", "%0D"), "\n", "%0A")
    revisit = F.col("refers_to").isNotNull()
    ident = F.concat(F.lit("<urn:page:"), F.coalesce(F.col("page_id").cast("string"), F.lit("null")), F.lit(">"))
    when = F.date_format(F.timestamp_seconds(F.lit(EPOCH) + F.pmod(F.coalesce("page_id", F.lit(0)), F.lit(SPAN))), "yyyy-MM-dd'T'HH:mm:ss'Z'")
    lines = [
        F.lit("WARC/1.1"), F.concat(F.lit("WARC-Type: "), F.when(revisit, "revisit").otherwise("response")),
        F.concat(F.lit("WARC-Record-ID: "), ident), F.concat(F.lit("WARC-Date: "), when),
        F.when(F.col("url").isNotNull(), F.concat(F.lit("WARC-Target-URI: "), uri)),
        F.concat(F.lit("WARC-Payload-Digest: sha256:"), F.col("digest")),
        F.when(revisit, F.lit(f"WARC-Profile: {REVISIT_PROFILE}")),
        F.when(revisit, F.concat(F.lit("WARC-Refers-To: <urn:page:"), F.col("refers_to").cast("string"), F.lit(">"))),
        F.when(revisit, F.concat(F.lit("X-Full-Payload-Length: "), F.col("bytes").cast("string"))),
        F.lit("Content-Type: text/html; charset=utf-8"),
        F.concat(F.lit("Content-Length: "), F.when(revisit, F.lit("0")).otherwise(F.col("bytes").cast("string"))),
    ]
    record = F.concat(F.concat_ws("\r\n", *lines), F.lit(END), F.when(revisit, "").otherwise(F.col("payload")))
    (d.select(record.alias("value")).write.option("lineSep", END)
     .option("maxRecordsPerFile", max(1, int(FILE_BYTES / (mean + 500)))).text(folder))


def url_key(url: str | None) -> str:
    """Host labels reversed, then the rest: sorts captures of a site together."""
    if not url or "://" not in url:
        return url or ""
    rest = url.split("://", 1)[1]
    cut = min([i for i in map(rest.find, "/?#") if i >= 0], default=len(rest))
    return ",".join(reversed(rest[:cut].lower().split("."))) + ")" + rest[cut:]


def parse(content, file: str) -> Iterator[tuple]:
    """Index rows of one archive (bytes or memory view)."""
    import calendar
    import re
    import time
    view, at = memoryview(content), 0
    while at < len(view):
        size = 4096
        while (end := bytes(view[at:at + size]).find(END.encode())) < 0:  # headers may be long
            if at + size >= len(view):
                raise ValueError(f"{file}: cut off in a record header at byte {at}")
            size *= 4
        head = bytes(view[at:at + end]).decode()
        fields = dict(line.split(": ", 1) for line in head.split("\r\n")[1:])
        if not head.startswith("WARC/1.1\r\n"):
            raise ValueError(f"{file}: no record at byte {at}")
        n = int(fields["Content-Length"])
        body = view[at + end + 4:at + end + 4 + n]
        digest = fields["WARC-Payload-Digest"].removeprefix("sha256:")
        kind = fields["WARC-Type"]
        if len(body) != n or (kind == "response" and hashlib.sha256(body).hexdigest() != digest):
            raise ValueError(f"{file}: damaged record at byte {at}")

        def number(name: str, fields=fields):
            m = re.fullmatch(r"<urn:page:(-?\d+)>", fields.get(name, ""))
            return int(m[1]) if m else None

        url = fields.get("WARC-Target-URI")
        if url is not None:
            url = url.replace("%0A", "\n").replace("%0D", "\r").replace("%25", "%")
        when = calendar.timegm(time.strptime(fields["WARC-Date"], "%Y-%m-%dT%H:%M:%SZ"))
        length = end + 4 + n + 4
        yield (number("WARC-Record-ID"), int(fields.get("X-Full-Payload-Length", n)), digest, kind, number("WARC-Refers-To"),
               url, url_key(url), when, file, at, length)
        at += length


def order(row: tuple) -> tuple:
    """Sort key of an index row: URL key, capture time, page_id (null first), file and offset."""
    return row[6].encode("utf-8", "surrogatepass"), row[7], row[0] is not None, row[0] or 0, row[8], row[9]


def read_runs(spark, folder: str) -> DataFrame:
    """One row per archive: ``run`` (its captures in order) as an array of index rows."""
    def scan(batches: Iterator) -> Iterator:
        import pyarrow as pa
        for b in batches:
            for file, content in zip(b.column(0).to_pylist(), b.column(1)):
                rows = sorted(parse(content.as_buffer(), file), key=order)
                yield pa.RecordBatch.from_arrays(
                    [pa.array([file]), pa.array([[dict(zip(_names(), r)) for r in rows]], _run_type())], names=["file", "run"])

    files = spark.read.format("binaryFile").load(folder).select("path", "content")
    return files.mapInArrow(scan, f"file string, run array<struct<{_struct()}>>")


def _names() -> list[str]:
    return [f.split()[0] for f in INDEX.split(", ")]


def _struct() -> str:
    return ", ".join(f.replace(" ", ": ", 1) for f in INDEX.split(", "))


def _run_type():
    import pyarrow as pa
    kinds = {"bigint": pa.int64(), "string": pa.string()}
    return pa.list_(pa.struct([(f.split()[0], kinds[f.split()[1]]) for f in INDEX.split(", ")]))


class LoserTree:
    """Merge of k sorted iterators: each inner node holds the loser of its match, so a step replays one path."""

    def __init__(self, runs: list[Iterator], key):
        self.runs, self.key, self.k = runs, key, len(runs)
        self.heads = [self._pull(i) for i in range(self.k)]
        self.tree = [-1] * max(self.k, 1)
        for i in range(self.k):
            self._replay(i)

    def _pull(self, i: int):
        row = next(self.runs[i], None)
        return None if row is None else (self.key(row), i, row)

    def _beats(self, a: int, b: int) -> bool:
        x, y = self.heads[a], self.heads[b]
        return x is not None and (y is None or x[:2] < y[:2])

    def _replay(self, winner: int) -> None:
        node = (winner + self.k) // 2
        while node > 0:
            other = self.tree[node]
            if other < 0:  # building: wait here for the opponent
                self.tree[node] = winner
                return
            if self._beats(other, winner):
                self.tree[node], winner = winner, other
            node //= 2
        self.tree[0] = winner

    def __iter__(self) -> Iterator:
        while self.k and self.heads[self.tree[0]] is not None:
            w = self.tree[0]
            yield self.heads[w][2]
            self.heads[w] = self._pull(w)
            self._replay(w)


def merge_runs(runs: DataFrame, range_rows: int = 100_000) -> DataFrame:
    """All captures of all runs with range_id and range_pos: ordered by both, they are the globally ordered index.
    ``runs`` is read several times: it should be a table."""
    total = runs.agg(F.sum(F.size("run"))).first()[0] or 0
    ranges = max(1, -(-total // range_rows))

    def merge(batches: Iterator) -> Iterator:
        """Rows of one range, run by run and sorted within each -> one order."""
        import pyarrow as pa
        from pyspark import TaskContext
        held: dict[str, list] = {}
        for b in batches:
            names = b.schema.names
            for row in zip(*(c.to_pylist() for c in b.columns)):
                held.setdefault(row[names.index("file")], []).append(row)
        now = TaskContext.get().partitionId()
        for start, rows in _chunks(iter(LoserTree([iter(r) for r in held.values()], order)), 10_000):
            cols = [pa.array([r[i] for r in rows], f.type) for i, f in enumerate(_run_type().value_type)]
            yield pa.RecordBatch.from_arrays(
                [pa.array([now] * len(rows), pa.int64()), pa.array(range(start, start + len(rows)), pa.int64()), *cols],
                names=["range_id", "range_pos", *_names()])

    captures = runs.select(F.explode("run").alias("r")).select("r.*")
    key = ["url_key", "captured", "page_id", "file", "offset"]
    return (captures.repartitionByRange(int(min(ranges, 1 << 20)), *key).sortWithinPartitions("file", *key)
            .select(*_names()).mapInArrow(merge, f"range_id bigint, range_pos bigint, {INDEX}"))


def _chunks(rows: Iterator, size: int) -> Iterator[tuple[int, list]]:
    at, held = 0, []
    for r in rows:
        held.append(r)
        if len(held) == size:
            yield at, held
            at, held = at + size, []
    if held:
        yield at, held


def archive_and_index(pages: DataFrame, range_rows: int = 100_000) -> DataFrame:
    """Write the archives into the shared folder, read them back and return the ordered index."""
    spark = pages.sparkSession
    folder = shared_folder(spark, "warc")
    write(pages, f"{folder}/archives")
    read_runs(spark, f"{folder}/archives").write.parquet(f"{folder}/runs")
    return merge_runs(spark.read.parquet(f"{folder}/runs"), range_rows)

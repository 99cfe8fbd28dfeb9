"""WARC archives and a globally ordered capture index.

Archives are written by Spark's text writer: one WARC record per row, records
end with a blank line pair, files are gzip (so one file is read by one task,
in order). Reading parses the records by their Content-Length. Each archive
gives a run of captures sorted by URL key and time; the runs are exchanged by
key range and merged with a loser tree in each range, which yields one global
order of captures.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from rttlab.session import persist_table, shared_path

from . import spans as S

CRLF = "\r\n"
RECORD_END = "\r\n\r\n"
MIN_REVISIT_BYTES = 1000
RANGE_ROWS = 200_000  # index entries that one task merges, about
REVISIT_PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
RECORD_SCHEMA = ("archive string, record_no long, page_id long, record_type string, target_uri string, captured string, "
                 "payload_digest string, payload_length long, refers_to long, block_bytes long, block binary")
INDEX_SCHEMA = ("url_key string, captured string, page_id long, archive string, record_no long, record_type string, "
                "payload_digest string, payload_length long, refers_to long, block_bytes long")


def url_key(url: Column) -> Column:
    """Sort key: host labels reversed and joined by commas, ``)``, then path and query, lower case; null: empty."""
    url = F.lower(F.coalesce(url, F.lit("")))
    host = F.regexp_extract(url, r"(?s)^[^:/?#]*://([^/?#]*)", 1)
    rest = F.regexp_extract(url, r"(?s)^[^:/?#]*://[^/?#]*([^#]*)", 1)
    return F.concat(F.array_join(F.reverse(F.split(host, r"\.")), ","), F.lit(")"), rest)


def plan_records(pages: DataFrame, min_bytes: int = MIN_REVISIT_BYTES) -> DataFrame:
    """``page_id, url, captured, payload, payload_digest, payload_bytes, record_type, refers_to`` per row.

    Of rows with equal payloads of at least ``min_bytes`` bytes, the one with
    the largest page_id is the response, the others revisit it. Equal means
    same SHA-1, length and SHA-256. Null payloads are empty; rows that repeat
    an id and its payload are all responses (they are the record referred to).
    """
    rows = pages.withColumn("payload", F.coalesce(F.col("html"), F.lit("")).cast("binary"))
    rows = (rows.withColumn("payload_digest", F.sha1("payload")).withColumn("payload_bytes", F.octet_length("payload").cast("long"))
            .withColumn("_key", F.sha2("payload", 256)))
    copies = (rows.filter(F.col("payload_bytes") >= min_bytes).groupBy("_key")
              .agg(F.max("page_id").alias("_last"), F.count(F.lit(1)).alias("_n")).filter("_n > 1")
              .withColumnRenamed("_key", "_copied"))
    rows = rows.join(copies.hint("shuffle_hash"), F.col("_key") == F.col("_copied"), "left")  # payloads are not sorted
    revisit = F.col("_last").isNotNull() & ~F.col("page_id").eqNullSafe(F.col("_last"))
    return rows.select("page_id", "url", "captured", "payload", "payload_digest", "payload_bytes",
                       F.when(revisit, "revisit").otherwise("response").alias("record_type"),
                       F.when(revisit, F.col("_last")).alias("refers_to"))


def _record(r: dict[str, Column]) -> Column:
    """The text of a WARC record, without the blank lines that end it."""
    line = lambda name, value: F.concat(F.lit(name + ": "), value, F.lit(CRLF))
    one_line = lambda c: F.regexp_replace(c, r"[\r\n]", "")
    revisit = F.col("record_type") == "revisit"
    block = F.when(revisit, F.lit("")).otherwise(F.col("payload").cast("string"))
    ident = lambda c: F.concat(F.lit("<urn:page:"), c.cast("string"), F.lit(">"))
    return F.concat(
        F.lit("WARC/1.1" + CRLF), line("WARC-Type", F.col("record_type")),
        F.when(F.col("page_id").isNotNull(), line("WARC-Record-ID", ident(F.col("page_id")))).otherwise(F.lit("")),
        F.when(F.col("url").isNotNull(), line("WARC-Target-URI", one_line(F.col("url")))).otherwise(F.lit("")),
        line("WARC-Date", F.col("captured")), line("WARC-Payload-Digest", F.concat(F.lit("sha1:"), F.col("payload_digest"))),
        line("X-Payload-Length", F.col("payload_bytes").cast("string")),
        F.when(revisit, F.concat(line("WARC-Profile", F.lit(REVISIT_PROFILE)), line("WARC-Refers-To", ident(F.col("refers_to")))))
        .otherwise(F.lit("")),
        line("Content-Length", F.octet_length(block).cast("string")), F.lit(CRLF), block)


def write_archives(records: DataFrame, path: str) -> None:
    """One gzip archive per partition of ``records`` (the columns of :func:`plan_records`)."""
    (records.select(_record({}).alias("value")).write.option("lineSep", RECORD_END).option("compression", "gzip").text(path))


class _Bytes:
    """A byte stream over chunks."""

    def __init__(self, chunks: Iterator[bytes]):
        self.chunks, self.buffer = chunks, bytearray()

    def _more(self) -> bool:
        chunk = next(self.chunks, None)
        if chunk is not None:
            self.buffer += chunk
        return chunk is not None

    def exactly(self, n: int) -> bytes:
        while len(self.buffer) < n and self._more():
            pass
        if len(self.buffer) < n:
            raise ValueError("an archive ends inside a record")
        out = bytes(self.buffer[:n])
        del self.buffer[:n]
        return out

    def until(self, mark: bytes) -> bytes | None:
        """Bytes before ``mark``, which is skipped; None at the end of the stream."""
        seen = 0
        while (at := self.buffer.find(mark, seen)) < 0:
            seen = max(0, len(self.buffer) - len(mark))
            if not self._more():
                if self.buffer:
                    raise ValueError("an archive ends inside a header")
                return None
        out = bytes(self.buffer[:at])
        del self.buffer[:at + len(mark)]
        return out


def parse_archive(chunks: Iterator[bytes]) -> Iterator[tuple[dict[str, str], bytes]]:
    """(headers, block) of the records in a byte stream; checks lengths and the digests of whole payloads."""
    stream, end = _Bytes(chunks), RECORD_END.encode()
    while (head := stream.until(end)) is not None:
        headers = dict(line.split(": ", 1) for line in head.decode("utf-8").split(CRLF)[1:] if ": " in line)
        block = stream.exactly(int(headers["Content-Length"]))
        if stream.exactly(len(end)) != end:
            raise ValueError("a record is longer than its header says")
        if headers["WARC-Type"] == "response" and headers["WARC-Payload-Digest"] != "sha1:" + hashlib.sha1(block).hexdigest():
            raise ValueError("a payload does not fit its digest")
        yield headers, block


def _page(ident: str | None) -> int | None:
    return int(ident.removeprefix("<urn:page:").removesuffix(">")) if ident else None


def read_archives(spark: SparkSession, path: str, keep_blocks: bool = True) -> DataFrame:
    """The records of all archives under ``path``, in file order; ``block`` is null without ``keep_blocks``."""
    pieces = (spark.read.option("lineSep", RECORD_END).text(path)
              .select(F.col("_metadata.file_path").alias("archive"), F.col("value").cast("binary").alias("value")))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names = [f.split()[0] for f in RECORD_SCHEMA.split(", ")]
        rows, size = [], 0

        def stream():
            for b in batches:
                yield from zip(b.column(0).to_pylist(), b.column(1).to_pylist(), strict=True)

        source, held = stream(), []

        def of(archive):
            for name, value in source:
                if name != archive:
                    held.append((name, value))
                    return
                yield value

        def out():
            arrays = [pa.array([r[i] for r in rows], t) for i, t in enumerate(_TYPES)]
            return pa.RecordBatch.from_arrays(arrays, names=names)

        first = next(source, None)
        while first is not None:
            archive = first[0]

            # The reader took the mark after each piece. A piece of one line end is an archive's last and had none: the
            # first match in an odd run of line ends starts one too early, and leaves the run's last.
            def whole(first=first, archive=archive):
                yield first[1] + RECORD_END.encode()
                for piece in of(archive):
                    yield piece if piece == CRLF.encode() else piece + RECORD_END.encode()

            for n, (h, block) in enumerate(parse_archive(whole())):
                rows.append((archive, n, _page(h.get("WARC-Record-ID")), h["WARC-Type"], h.get("WARC-Target-URI"),
                             h["WARC-Date"], h["WARC-Payload-Digest"].removeprefix("sha1:"), int(h["X-Payload-Length"]),
                             _page(h.get("WARC-Refers-To")), len(block), block if keep_blocks else None))
                size += len(block) if keep_blocks else 200
                if size > 4 << 20:
                    yield out()
                    rows, size = [], 0
            first = held.pop() if held else None
        if rows:
            yield out()

    return S.map_batches(pieces, run, RECORD_SCHEMA)


_TYPES = [pa.string(), pa.int64(), pa.int64(), pa.string(), pa.string(), pa.string(), pa.string(), pa.int64(), pa.int64(),
          pa.int64(), pa.binary()]


class LoserTree:
    """k-way merge of sorted iterators of (key, item): each step replays one path from a leaf to the root."""

    def __init__(self, runs):
        self.runs = [iter(r) for r in runs]
        self.k = len(self.runs)
        self.heads = [next(r, None) for r in self.runs]
        self.losers = [-1] * max(1, self.k)
        self.winner = -1
        for i in range(self.k):
            self._seed(i)

    def _beats(self, a: int, b: int) -> bool:
        x, y = self.heads[a], self.heads[b]
        if x is None or y is None:
            return y is None and (x is not None or a < b)
        return (x[0], a) < (y[0], b)

    def _seed(self, i: int) -> None:
        node = (i + self.k) // 2
        while node > 0:
            if self.losers[node] < 0:
                self.losers[node] = i
                return
            if self._beats(self.losers[node], i):
                i, self.losers[node] = self.losers[node], i
            node //= 2
        self.winner = i

    def __iter__(self):
        while self.k and self.heads[self.winner] is not None:
            i = self.winner
            yield self.heads[i][1]
            self.heads[i] = next(self.runs[i], None)
            node = (i + self.k) // 2
            while node > 0:
                if self._beats(self.losers[node], i):
                    i, self.losers[node] = self.losers[node], i
                node //= 2
            self.winner = i


def write_runs(records: DataFrame, path: str) -> None:
    """Index entries of read archives, as runs: those of an archive are sorted by (url_key, captured, page_id)."""
    (records.withColumn("url_key", url_key(F.col("target_uri"))).select(*[f.split()[0] for f in INDEX_SCHEMA.split(", ")])
     .sortWithinPartitions("archive", "url_key", "captured", "page_id", "record_no").write.parquet(path))


def merge_index(runs: DataFrame, parts: int) -> DataFrame:
    """Captures in global order: INDEX columns and ``index_part``, ``index_row``.

    The runs meet by ranges of (url_key, captured, page_id), ``parts`` of them,
    so a URL captured by many rows spreads over several ranges; within a range
    the sorted slices of the runs are merged by a loser tree. Ordering by
    (index_part, index_row) orders all captures.
    """
    order = ["url_key", "captured", "page_id", "archive", "record_no"]
    n = parts
    ranged = runs.repartitionByRange(n, *order).sortWithinPartitions("archive", *order[:3], "record_no")
    at = [runs.columns.index(c) for c in order]

    def merge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        batches = list(batches)  # one range of index entries: its size is set by the number of ranges
        if not batches:
            return
        table = pa.Table.from_batches(batches)
        cols = [table.column(i).to_pylist() for i in at]
        keys = [(a, b, c is not None, c or 0, e) for a, b, c, e in zip(cols[0], cols[1], cols[2], cols[4], strict=True)]
        cuts = [0, *[i for i in range(1, len(keys)) if cols[3][i] != cols[3][i - 1]], len(keys)]
        runs = [((keys[i], i) for i in range(a, b)) for a, b in zip(cuts, cuts[1:], strict=False)]
        merged = table.take(pa.array(list(LoserTree(runs)), pa.int64())).append_column("index_row", pa.array(range(len(keys)), pa.int64()))
        yield from merged.to_batches(max_chunksize=10_000)

    out = S.map_batches(ranged, merge, INDEX_SCHEMA + ", index_row long")
    return out.withColumn("index_part", F.spark_partition_id())


def capture_history(index: DataFrame) -> DataFrame:
    """``index`` with the previous capture of the same URL key as ``previous_page`` (null for the key's first).

    Within a range by a window; a range's first row of a key takes the last of
    the key's range before, of which there is one row per range and key.
    """
    index = persist_table(index, "capture-index")  # read twice: its ranges stay what they are
    here = Window.partitionBy("index_part", "url_key").orderBy("index_row")
    last = index.groupBy("url_key", "index_part").agg(F.max_by("page_id", "index_row").alias("last"))
    before = last.select(F.col("url_key").alias("k"), F.col("index_part").alias("p"),
                         F.lag("last").over(Window.partitionBy("url_key").orderBy("index_part")).alias("before"))
    rows = (index.withColumn("first", F.row_number().over(here) == 1).withColumn("inner", F.lag("page_id").over(here))
            .join(before, F.col("url_key").eqNullSafe(F.col("k")) & (F.col("index_part") == F.col("p"))))
    return rows.select(*index.columns, F.when(F.col("first"), F.col("before")).otherwise(F.col("inner")).alias("previous_page"))


def build_archives(pages: DataFrame, path: str, min_bytes: int = MIN_REVISIT_BYTES) -> DataFrame:
    """Write ``pages`` (page_id, url, html, captured) as archives under ``path``; their merged capture index.

    Null html is an empty payload, a null url gives a record without target;
    an empty table gives no captures. Other columns of ``pages`` are ignored.
    """
    spark = pages.sparkSession
    write_archives(plan_records(pages, min_bytes), path + "/archives")
    write_runs(read_archives(spark, path + "/archives", keep_blocks=False), path + "/runs")
    runs = spark.read.schema(INDEX_SCHEMA).parquet(path + "/runs")
    parts = max(int(spark.conf.get("spark.sql.shuffle.partitions")), -(-runs.count() // RANGE_ROWS))
    return merge_index(runs, parts)


def op5_warc(spark, sf: str) -> DataFrame:
    """Archives of all ``pages`` written, read back and indexed; a capture time is made from the page id."""
    pages = spark.read.parquet(f"{sf}/pages.parquet").withColumn(
        "captured", F.date_format(F.timestamp_seconds(F.lit(1_700_000_000) + F.coalesce("page_id", F.lit(0))), "yyyy-MM-dd'T'HH:mm:ss'Z'"))
    index = build_archives(pages, shared_path(spark, "warc"))
    return index.select("page_id", F.col("payload_length").alias("payload_bytes"), "payload_digest", "record_type",
                        "refers_to")


ORACLE = {"op5_warc": """
with p as (select page_id, coalesce(html, '') as h, strlen(coalesce(html, '')) as payload_bytes, sha1(coalesce(html, '')) as payload_digest from pages),
     g as (select h, max(page_id) as last from p where payload_bytes >= 1000 group by h having count(*) > 1)
select p.page_id, cast(payload_bytes as bigint) as payload_bytes, payload_digest,
       case when g.last is null or g.last = p.page_id then 'response' else 'revisit' end as record_type,
       case when g.last <> p.page_id then g.last end as refers_to
from p left join g on p.h = g.h
"""}

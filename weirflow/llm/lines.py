"""Line dedup by site-relative frequency.

Within a host, a line's frequency is the number of pages that contain it divided by
the host's number of pages. Lines above a boilerplate ratio go.

Copies are the business of document dedup, and must not turn a page's own text into
boilerplate. Pages of a host with exactly equal text count as one page in both numbers.
Near copies of one page count as one for the lines they share: each page that has a line
above the ratio gets ``SKETCHES`` minimum digests of its runs of five words, and pages that
agree in ``AGREE`` or more with the most frequent digests among the line's pages are taken
for copies of one page. A page that shares 0.8 of its runs with the page most were copied
from agrees so with probability 0.94, a page of which a common menu is one half with 0.36, a
quarter with 0.03. The line goes only if it is above the ratio, and on ``min_line_pages``
pages, when all those copies count as one.

The ratio is the method's parameter, not a property of the data: at 0.08 a line goes that
is on more than one page in twelve. A rarer line stays, also in a large host.

Lines are compared without surrounding white space. Empty lines are never judged.
A host with fewer than ``min_pages`` different pages has too few to tell, and keeps
all its lines; so does a line on fewer than ``min_line_pages`` of them.

Nulls: a null host is a host of its own, a null text has no lines and stays null.
Repeated rows are copies of a page. Ties between equally frequent digests go to the
smaller. Very long texts are handled line by line. Empty tables give empty tables.
A row passes as one value, so its columns may have any names, the operator's own included;
if a name of the two counts is taken, underscores are added to that of the count.

Counting shuffles two 64-bit digests per line, never texts; sketches are made of pages
with a line above the ratio only, in the tasks that read them. A host has at most
(average lines per page / ratio) boilerplate lines, so those are gathered per host
as a map and joined to the pages. The map table is written first: Spark then
knows its size and broadcasts it below its own threshold; above, the join shuffles by
host and AQE splits a hot host.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from weirflow.session import materialize

RATIO = 0.08
MIN_PAGES = 20
MIN_LINE_PAGES = 4
WORDS = 5
SKETCHES = 8
AGREE = 5

_TRIM = " \t\r"
_WORD = re.compile(r"[^ \t\r\n]+")


def _lines(text: Column) -> Column:
    return F.split(text, "\n", -1)


def _bare(line: Column) -> Column:
    return F.btrim(line, F.lit(_TRIM))


def sketch(text: str) -> list[int]:
    """The smallest digest of the text's runs of ``WORDS`` words, in ``SKETCHES`` orders.

    A run has one 128-bit digest; an order reads 64 of its bits, each from another byte on.
    """
    words = _WORD.findall(text)
    runs = {" ".join(words[i : i + WORDS]) for i in range(max(len(words) - WORDS + 1, 1))}
    digests = np.frombuffer(b"".join(hashlib.md5(r.encode()).digest() for r in runs), np.uint8).reshape(-1, 16)
    return [
        int(np.ascontiguousarray(digests[:, j : j + 8]).view(">u8").min().astype(np.uint64).view(np.int64))
        for j in range(SKETCHES)
    ]


def boilerplate_lines(
    pages: DataFrame,
    text: str = "text",
    host: str = "source",
    ratio: float = RATIO,
    min_pages: int = MIN_PAGES,
    min_line_pages: int = MIN_LINE_PAGES,
) -> DataFrame:
    """``(host, line_digest, line_pages, host_pages)`` of every boilerplate line.

    A line is counted under two digests, so chance collisions need 128 equal bits.
    """
    whole = pages.select(F.col(host).alias("host"), F.col(text).alias("body")).where(F.col("body").isNotNull())
    bare = F.filter(F.transform(_lines(F.col("body")), _bare), lambda line: line != "")
    digests = F.array_distinct(
        F.transform(
            bare, lambda line: F.struct(F.xxhash64(line).alias("a"), F.xxhash64(F.lit(7), line).alias("b"))
        )
    )
    page = [F.xxhash64("body").alias("p"), F.xxhash64(F.lit(7), "body").alias("q")]
    different = (
        whole.select("host", *page, digests.alias("lines")).groupBy("host", "p", "q").agg(F.first("lines").alias("lines"))
    )
    # The page itself is counted as a line without digest: one pass gives both numbers.
    counted = (
        different.select("host", F.explode(F.concat("lines", F.array(F.struct(
            F.lit(None).cast("long").alias("a"), F.lit(None).cast("long").alias("b"))))).alias("line"))
        .groupBy("host", "line.a", "line.b")
        .agg(F.count("*").alias("line_pages"))
        .where(F.col("a").isNull() | (F.col("line_pages") >= min_line_pages))
    )
    counted = materialize(counted, "line-counts")
    totals = counted.where(F.col("a").isNull()).select(
        F.col("host").alias("_host"), F.col("line_pages").alias("host_pages")
    )
    frequent = materialize(
        counted.where(F.col("a").isNotNull())
        .join(totals, F.col("host").eqNullSafe(F.col("_host")))
        .where(F.col("host_pages") >= min_pages)
        .where(F.col("line_pages") > F.lit(ratio) * F.col("host_pages"))
        .select("host", "a", "line_pages", "host_pages"),
        "frequent-lines",
    )
    return _without_copies(whole, frequent, bare, page, ratio, min_line_pages)


def _by_host(lines: DataFrame, digest: str, label: str) -> DataFrame:
    """``(of_host, lines)``: a map whose keys are the host's digests, written first."""
    gathered = lines.groupBy("host").agg(F.collect_set(digest).alias("found"))
    as_map = F.map_from_arrays("found", F.transform("found", lambda _: F.lit(True)))
    return materialize(gathered.select(F.col("host").alias("of_host"), as_map.alias("found")), label)


def _without_copies(
    whole: DataFrame, frequent: DataFrame, bare: Column, page: list[Column], ratio: float, min_line_pages: int
) -> DataFrame:
    """``frequent`` lines that stay so when near copies of one page count as one."""
    by_host = _by_host(frequent, "a", "frequent-by-host")
    own = F.array_distinct(F.filter(F.transform(bare, lambda line: F.xxhash64(line)), lambda a: F.map_contains_key("found", a)))
    sharing = (
        whole.join(by_host, F.col("host").eqNullSafe(F.col("of_host")))
        .select("host", *page, own.alias("lines"), "body")
        .where(F.size("lines") > 0)
    )

    def sketched(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = [sketch(t) for t in batch.column(4).to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [*batch.columns[:4], pa.array(rows, pa.list_(pa.int64()))], names=["host", "p", "q", "lines", "sketch"]
            )

    host_type = whole.schema["host"].dataType.simpleString()
    sketches = materialize(
        sharing.mapInArrow(sketched, f"host {host_type}, p bigint, q bigint, lines array<bigint>, sketch array<bigint>")
        .groupBy("host", "p", "q")
        .agg(F.first("lines").alias("lines"), F.first("sketch").alias("sketch")),
        "page-sketches",
    )
    places = sketches.select("host", F.explode("lines").alias("a"), "sketch")
    # Most pages share a digest or none do: what is counted here is small per line.
    seen = (
        places.select("host", "a", F.posexplode("sketch").alias("j", "s"))
        .groupBy("host", "a", "j", "s")
        .agg(F.count("*").alias("n"))
    )
    modes = materialize(
        seen.groupBy("host", "a", "j")
        .agg(F.min_by("s", F.struct(-F.col("n"), "s")).alias("mode"))
        .groupBy(F.col("host").alias("of_host"), F.col("a").alias("of_a"))
        .agg(F.transform(F.array_sort(F.collect_list(F.struct("j", "mode"))), lambda m: m["mode"]).alias("modes")),
        "page-modes",
    )
    agree = F.size(F.filter(F.zip_with("sketch", "modes", lambda s, m: s == m), lambda same: same))
    copies = (
        places.join(modes, F.col("host").eqNullSafe(F.col("of_host")) & (F.col("a") == F.col("of_a")))
        .where(agree >= AGREE)
        .groupBy(F.col("host").alias("of_host"), F.col("a").alias("of_a"))
        .agg(F.count("*").alias("copies"))
    )
    independent = F.col("line_pages") - F.greatest(F.coalesce("copies", F.lit(0)) - 1, F.lit(0))
    return (
        frequent.join(copies, F.col("host").eqNullSafe(F.col("of_host")) & (F.col("a") == F.col("of_a")), "left")
        .select("host", F.col("a").alias("line_digest"), independent.alias("line_pages"), "host_pages")
        .where((F.col("line_pages") >= min_line_pages) & (F.col("line_pages") > F.lit(ratio) * F.col("host_pages")))
    )


def drop_boilerplate(
    pages: DataFrame,
    text: str = "text",
    host: str = "source",
    ratio: float = RATIO,
    min_pages: int = MIN_PAGES,
    min_line_pages: int = MIN_LINE_PAGES,
    counts: bool = True,
) -> DataFrame:
    """The pages with boilerplate lines taken out of ``text``.

    With ``counts``, adds ``n_lines`` (lines before) and ``n_dropped``.
    """
    found = boilerplate_lines(pages, text, host, ratio, min_pages, min_line_pages)
    by_host = _by_host(found, "line_digest", "boilerplate")
    lines = _lines(F.col("body"))
    kept = F.when(
        F.col("found").isNotNull(),
        F.filter(lines, lambda line: ~F.map_contains_key("found", F.xxhash64(_bare(line)))),
    )
    rows = pages.select(F.struct(*pages.columns).alias("row"), F.col(host).alias("host"), F.col(text).alias("body"))
    joined = rows.join(by_host, F.col("host").eqNullSafe(F.col("of_host")), "left").withColumn("kept", kept)
    # Nothing to drop, a null text included: the text stays as it is.
    clean = F.when(F.col("kept").isNull(), F.col("body")).otherwise(F.array_join("kept", "\n"))
    out = [clean.alias(c) if c == text else F.col("row").getField(c).alias(c) for c in pages.columns]
    if counts:
        before = F.when(F.col("body").isNull(), 0).otherwise(F.size(lines))
        dropped = F.when(F.col("kept").isNull(), 0).otherwise(before - F.size("kept"))
        for name, value in (("n_lines", before), ("n_dropped", dropped)):
            while name in pages.columns:
                name += "_"
            out.append(value.cast("long").alias(name))
    return joined.select(*out)

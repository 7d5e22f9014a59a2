"""N-gram Jaccard join: MinHash banding finds candidates, full n-gram sets verify them.

An n-gram is five words (lower case, runs of letters, digits, underscores); a document
with fewer words has one n-gram of all of them. Two documents are linked if the Jaccard
similarity of their n-gram sets is at least 0.8. ``choose_bands`` picks the number of
bands and rows for a target recall at exactly that similarity.

Steps, each a Spark job over the whole input:

1. *Classes.* Documents with equal n-gram sets are one class, so copies cost one row.
2. *Bands.* Classes are shuffled on their band hashes. Whoever is alone in all bands is done.
3. *Tiles.* The rest is cut into chunks of at most ``CHUNK`` classes, those that share
   a bucket in the same chunk as far as possible. Two chunks that share a bucket make a tile.
   A pair of classes belongs to exactly one tile, however many bands it shares, and a
   large group of near copies is spread over many tasks.
4. *Verify.* Each tile computes all its pairs' exact similarities as a matrix product
   and returns one row per class: how many documents it links to, and the smallest
   class it is connected to. Pairs are never written out.
5. *Components.* Those connections are contracted by large-star and small-star rounds.

Nulls and empty texts: a document without words has no n-gram, links to none and is its
own class. A null id is a value like any other; a group's class id is its smallest id
that is not null. Ties, rows of equal id, go by a hash of the text. Repeated rows are
copies. Very long texts are read whole, one at a time where they are larger than a batch.
Empty tables give empty results. Only the id and text columns are read; ``keep_one`` passes
the others as they are, whatever their names.
"""

from __future__ import annotations

import hashlib
import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from weirflow.llm.words import WordTable, hash_table, mix, shingles, text_groups
from weirflow.session import materialize

N = 5
THRESHOLD = 0.8
RECALL = 0.9999
HASHES = 200
CHUNK = 128
CHUNK_GRAMS = 1 << 18
# Edges of one node are dealt to so many tasks.
SALTS = 8
_NONE = -(2**63)


def choose_bands(threshold: float, recall: float, hashes: int) -> tuple[int, int]:
    """The most rows per band, and the bands, that reach ``recall`` with ``hashes`` hashes."""
    best = None
    for rows in range(1, min(hashes, 60) + 1):
        same = threshold**rows
        bands = 1 if same >= 1 else math.ceil(math.log1p(-recall) / math.log1p(-same))
        if bands * rows <= hashes:
            best = bands, rows
    if best is None:
        raise ValueError("too few hashes for this recall")
    return best


def gram_sets(table: WordTable, texts: list[str | None], n: int) -> list[np.ndarray]:
    """The sorted n-gram hashes of each text, each once."""
    words, bounds = table.batch(texts)
    return [np.unique(shingles(words[a:b], n)) for a, b in zip(bounds[:-1], bounds[1:])]


def set_key(grams: np.ndarray) -> bytes:
    return hashlib.blake2b(grams.tobytes(), digest_size=16).digest()


def min_hashes(sets: list[np.ndarray], hashes: int) -> np.ndarray:
    """``len(sets)`` rows of ``hashes`` minima; sets must not be empty."""
    random = np.random.default_rng(2)
    a = random.integers(0, 2**63, hashes, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
    b = random.integers(0, 2**63, hashes, dtype=np.uint64)
    out = np.empty((len(sets), hashes), dtype=np.uint64)
    start = 0
    while start < len(sets):  # about 64k n-grams at once stay in a core's cache
        end, size = start, 0
        while end < len(sets) and (end == start or size + len(sets[end]) <= 65_536):
            size += len(sets[end])
            end += 1
        flat = np.concatenate(sets[start:end])
        lengths = np.array([len(s) for s in sets[start:end]])
        firsts = np.cumsum(lengths) - lengths
        for k in range(hashes):
            out[start:end, k] = np.minimum.reduceat(flat * a[k] + b[k], firsts)
        start = end
    return out


def band_hashes(minima: np.ndarray, bands: int, rows: int) -> np.ndarray:
    out = np.empty((len(minima), bands), dtype=np.uint64)
    for j in range(bands):
        total = np.full(len(minima), j, dtype=np.uint64)
        for k in range(j * rows, (j + 1) * rows):
            total = mix(total * np.uint64(31) + minima[:, k])
        out[:, j] = total
    return out


def _keys(id_column: str, text: str) -> list[Column]:
    """``_rid`` (the id, or the smallest number for null), ``_t1`` (a hash of the text)."""
    return [
        F.coalesce(F.col(id_column).cast("bigint"), F.lit(_NONE)).alias("_rid"),
        F.xxhash64(F.col(text)).alias("_t1"),
    ]


def signatures(docs: DataFrame, bands: int, rows: int, n: int = N) -> DataFrame:
    """Per document: ``_rid, _t1, k1, k2`` (key of its n-gram set), ``n_grams, bands``."""

    def sign(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table = hash_table()
        for part, texts in (g for batch in batches for g in text_groups(batch, 2)):
            sets = gram_sets(table, texts, n)
            full = np.array([i for i, s in enumerate(sets) if len(s)], dtype=np.int64)
            keys = np.zeros((len(sets), 2), dtype="<i8")
            hashed = np.zeros((len(sets), bands), dtype=np.int64)
            if len(full):
                some = [sets[i] for i in full]
                keys[full] = np.frombuffer(b"".join(map(set_key, some)), "<i8").reshape(-1, 2)
                hashed[full] = band_hashes(min_hashes(some, bands * rows), bands, rows).view(np.int64)
            empty = np.array([not len(s) for s in sets])
            offsets = pa.array(np.arange(len(sets) + 1) * bands, pa.int32())
            yield pa.RecordBatch.from_arrays(
                [
                    part.column(0),
                    part.column(1),
                    pa.array(keys[:, 0], mask=empty),
                    pa.array(keys[:, 1], mask=empty),
                    pa.array([len(s) for s in sets], pa.int64()),
                    pa.ListArray.from_arrays(offsets, pa.array(hashed.ravel())),
                ],
                names=["_rid", "_t1", "k1", "k2", "n_grams", "bands"],
            )

    return docs.mapInArrow(
        sign, "_rid bigint, _t1 bigint, k1 bigint, k2 bigint, n_grams bigint, bands array<bigint>"
    )


def _tiles(classes: DataFrame) -> tuple[DataFrame, DataFrame]:
    """``(cid, tiles)``: for each class with company, the tiles it belongs to; and chunks."""
    banded = classes.select("cid", F.explode("bands").alias("b"))
    shared = (
        banded.groupBy("b")
        .agg(F.count("*").alias("n"), F.min("cid").alias("leader"))
        .where("n > 1")
        .drop("n")
    )
    members = materialize(banded.join(shared, "b"), "band-members")
    labelled = members.groupBy("cid").agg(F.min("leader").alias("label"))
    sized = labelled.join(classes.select("cid", "n_grams"), "cid")
    sizes = sized.groupBy("label").agg(
        F.ceil(
            F.greatest(F.count("*") / CHUNK, F.sum("n_grams") / CHUNK_GRAMS, F.lit(1))
        ).alias("parts")
    )
    chunk = F.when(F.col("parts") == 1, F.col("label")).otherwise(
        F.xxhash64("label", F.pmod(F.xxhash64("cid"), F.col("parts")))
    )
    chunks = materialize(sized.join(sizes, "label").select("cid", chunk.alias("chunk")), "chunks")
    # A bucket has few chunks: as many as its members fill. Most have one.
    met = (
        members.join(chunks, "cid").select("b", "chunk").distinct()
        .groupBy("b").agg(F.array_sort(F.collect_list("chunk")).alias("cs"))
        .select("cs").distinct()
    )
    first = met.select("cs", F.posexplode("cs").alias("i", "c1"))
    tiles = first.select(
        "c1", F.explode(F.slice("cs", F.col("i") + 1, F.size("cs") - F.col("i"))).alias("c2")
    ).distinct()
    sides = F.when(
        F.col("c1") == F.col("c2"), F.array(F.struct(F.col("c1").alias("chunk"), F.lit(0).alias("side")))
    ).otherwise(
        F.array(
            F.struct(F.col("c1").alias("chunk"), F.lit(0).alias("side")),
            F.struct(F.col("c2").alias("chunk"), F.lit(1).alias("side")),
        )
    )
    routes = tiles.select(F.xxhash64("c1", "c2").alias("tile"), F.explode(sides).alias("s")).select(
        "tile", "s.chunk", "s.side"
    )
    return routes.groupBy("chunk").agg(F.collect_list(F.struct("tile", "side")).alias("tiles")), chunks


def _verify(threshold: float):
    def verify(table: pa.Table) -> pa.Table:
        ids = table.column("cid").to_numpy()
        _, rows = np.unique(ids, return_index=True)  # repeated rows of a class count once
        side = table.column("side").to_numpy()[rows]
        ids, weights = ids[rows], table.column("rows").to_numpy()[rows]
        lists = table.column("grams").combine_chunks()
        offsets, values = lists.offsets.to_numpy(), lists.values.to_numpy()
        sizes = (offsets[1:] - offsets[:-1])[rows].astype(np.int64)
        flat = np.concatenate([values[offsets[r] : offsets[r + 1]] for r in rows])
        owner = np.repeat(np.arange(len(rows)), sizes)
        _, place, count = np.unique(flat, return_inverse=True, return_counts=True)
        shared = count > 1  # an n-gram of one class is in no intersection
        column = np.cumsum(shared) - 1
        keep = shared[place]
        owner, place = owner[keep], column[place[keep]]
        left, right = np.flatnonzero(side == 0), np.flatnonzero(side == 1)
        if not len(right):
            right = left
        width = 4096
        common = np.zeros((len(left), len(right)), dtype=np.float32)
        order = np.argsort(place, kind="stable")
        owner, place = owner[order], place[order]
        for start in range(0, int(shared.sum()), width):
            a, b = np.searchsorted(place, [start, start + width])
            block = np.zeros((len(rows), width), dtype=np.float32)
            block[owner[a:b], place[a:b] - start] = 1
            common += block[left] @ block[right].T
        union = sizes[left][:, None] + sizes[right][None, :] - common
        linked = common >= threshold * union - 1e-6
        linked &= left[:, None] != right[None, :]
        both = np.zeros((len(rows), len(rows)), dtype=bool)
        both[np.ix_(left, right)] = linked
        both |= both.T
        parent = np.arange(len(rows))  # rows are in order of class id
        while True:
            least = np.where(both, parent[None, :], len(rows)).min(axis=1)
            new = np.minimum(parent, least)
            new = np.minimum(new, new[new])
            if (new == parent).all():
                break
            parent = new
        some = both.any(axis=1)
        return pa.table(
            {
                "cid": ids[some],
                "parent": ids[parent][some],
                "links": (both @ weights)[some].astype(np.int64),
            }
        )

    return verify


def components(edges: DataFrame) -> DataFrame:
    """``(node, root)`` of every node of ``edges(node, parent)``; root is the smallest node.

    Alternates large-star and small-star rounds, each written to the shared folder,
    until every edge leads to a root. The driver sees one number per round.
    """
    def with_least(edges: DataFrame, least: DataFrame) -> DataFrame:
        """``edges`` with ``m`` of their node, which may have very many of them.

        Nodes grow with the corpus, so this is a shuffle join at every size.
        """
        copies = least.select("node", "m", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))).alias("salt"))
        return edges.withColumn("salt", F.pmod(F.xxhash64("parent"), F.lit(SALTS)).cast("int")).join(
            copies.hint("merge"), ["node", "salt"]
        )

    edges = materialize(
        edges.where("node <> parent")
        .select(F.greatest("node", "parent").alias("node"), F.least("node", "parent").alias("parent"))
        .distinct(),
        "edges",
    )
    while True:
        ends = edges.select("node", F.lit(1).alias("up"), F.lit(0).alias("down")).union(
            edges.select("parent", F.lit(0), F.lit(1))
        )
        unsettled = (
            ends.groupBy("node").agg(F.sum("up").alias("up"), F.max("down").alias("down"))
            .where("up > 1 OR (up = 1 AND down = 1)")
        )
        if unsettled.isEmpty():
            return edges.select("node", F.col("parent").alias("root"))
        around = edges.union(edges.select("parent", "node"))
        least = around.groupBy("node").agg(F.min("parent").alias("m")).select(
            "node", F.least("node", "m").alias("m")
        )
        large = (
            with_least(around, least).where("parent > node")
            .select(F.col("parent").alias("node"), F.col("m").alias("parent")).distinct()
        )
        low = large.groupBy("node").agg(F.min("parent").alias("m"))
        small = (
            with_least(large, low)
            .select(F.explode(F.array(
                F.struct("node", F.col("m").alias("parent")),
                F.struct(F.col("parent").alias("node"), F.col("m").alias("parent")),
            )).alias("e"))
            .select("e.*").where("node <> parent").distinct()
        )
        edges = materialize(small, "edges")


def link_classes(
    docs: DataFrame,
    id_column: str = "doc_id",
    text: str = "text",
    n: int = N,
    threshold: float = THRESHOLD,
    recall: float = RECALL,
    hashes: int = HASHES,
) -> tuple[DataFrame, DataFrame]:
    """``(documents, classes)``.

    ``documents``: ``_rid, _t1, k1, k2`` per input row. ``classes``: ``k1, k2, root,
    rows, links`` and the class's first document ``rid, t1`` and smallest id ``least``.
    """
    bands, rows = choose_bands(threshold, recall, hashes)
    keyed = docs.select(*_keys(id_column, text), F.col(text).alias("text"))
    signed = materialize(signatures(keyed, bands, rows, n), "signatures")
    classes = materialize(
        signed.where(F.col("k1").isNotNull())
        .groupBy("k1", "k2")
        .agg(
            F.count("*").alias("rows"),
            F.min("_rid").alias("rid"),
            F.min_by("_t1", "_rid").alias("t1"),
            F.min(F.when(F.col("_rid") != _NONE, F.col("_rid"))).alias("least"),
            F.first("n_grams").alias("n_grams"),
            F.first("bands").alias("bands"),
        )
        .withColumn("cid", F.monotonically_increasing_id()),
        "classes",
    )
    routes, chunks = _tiles(classes)
    wanted = (
        chunks.join(routes, "chunk")
        .join(classes.select("cid", "k1", "k2", "rid", "t1", "rows"), "cid")
        .select("cid", "k1", "k2", "rid", "t1", "rows", "tiles")
    )
    wanted = materialize(wanted, "candidates")

    def sets(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table = hash_table()
        for part, texts in (g for batch in batches for g in text_groups(batch, 0)):
            found = gram_sets(table, texts, n)
            keys = part.select(["k1", "k2"]).to_pydict()
            same = [
                len(s) > 0 and tuple(np.frombuffer(set_key(s), "<i8").tolist()) == key
                for s, key in zip(found, zip(keys["k1"], keys["k2"]))
            ]
            kept = [s.view(np.int64) for s, yes in zip(found, same) if yes]
            rest = part.select(["cid", "rows", "tiles"]).filter(pa.array(same, pa.bool_()))
            offsets = np.concatenate([[0], np.cumsum([len(s) for s in kept], dtype=np.int64)])
            grams = pa.ListArray.from_arrays(
                pa.array(offsets, pa.int32()),
                pa.array(np.concatenate(kept) if kept else np.zeros(0, np.int64)),
            )
            yield rest.append_column("grams", grams)

    # The candidates grow with the corpus, so this is a shuffle join at every size.
    texts = keyed.join(
        wanted.hint("merge"), (F.col("_rid") == F.col("rid")) & (F.col("_t1") == F.col("t1"))
    ).select("text", "cid", "k1", "k2", "rows", "tiles")
    members = (
        texts.mapInArrow(
            sets,
            "cid bigint, rows bigint, tiles array<struct<tile: bigint, side: int>>, grams array<bigint>",
        )
        .select("cid", "rows", "grams", F.explode("tiles").alias("t"))
        .select("cid", "rows", "grams", "t.tile", "t.side")
    )
    checked = materialize(
        members.groupBy("tile").applyInArrow(
            _verify(threshold), "cid bigint, parent bigint, links bigint"
        ),
        "verified",
    )
    links = checked.groupBy("cid").agg(F.sum("links").alias("links"))
    roots = components(checked.select(F.col("cid").alias("node"), "parent"))
    merged = (
        classes.select("cid", "k1", "k2", "rows", "rid", "t1", "least")
        .join(links, "cid", "left")
        .join(roots.select(F.col("node").alias("cid"), "root"), "cid", "left")
        .withColumn("root", F.coalesce("root", "cid"))
        .withColumn("links", F.coalesce("links", F.lit(0)) + F.col("rows") - 1)
        .drop("cid")
    )
    return signed.select("_rid", "_t1", "k1", "k2"), materialize(merged, "linked-classes")


def jaccard_join(docs: DataFrame, id_column: str = "doc_id", text: str = "text", **options) -> DataFrame:
    """One row per document: its id, ``class_id`` and ``n_links``.

    ``class_id`` is the smallest id of all documents connected to it by links; a
    document without words has its own id. ``n_links`` counts every other document
    whose similarity reaches the threshold, copies included.
    """
    signed, classes = link_classes(docs, id_column, text, **options)
    named = classes.groupBy("root").agg(F.min("least").alias("class_id"))
    found = classes.join(named, "root").select("k1", "k2", "class_id", F.col("links").alias("n_links"))
    own = F.when(F.col("_rid") != _NONE, F.col("_rid"))
    return (
        signed.join(found, ["k1", "k2"], "left")
        .select(
            own.alias(id_column),
            F.when(F.col("k1").isNull(), own).otherwise(F.col("class_id")).alias("class_id"),
            F.coalesce("n_links", F.lit(0)).alias("n_links"),
        )
    )


def keep_one(docs: DataFrame, id_column: str = "doc_id", text: str = "text", **options) -> DataFrame:
    """``docs`` with one document of each connected group: the one with the smallest id.

    Rows equal in id and text are one document. Documents without words all stay.
    """
    signed, classes = link_classes(docs, id_column, text, **options)
    chosen = classes.groupBy("root").agg(
        F.min("rid").alias("_rid"), F.min_by("t1", "rid").alias("_t1")
    ).select("_rid", "_t1")
    wordless = signed.where(F.col("k1").isNull()).select("_rid", "_t1").distinct()
    # A row passes as one value, so its columns may have any names.
    rows = docs.select(*_keys(id_column, text), F.struct(*docs.columns).alias("row"))
    one = rows.dropDuplicates(["_rid", "_t1"]).join(chosen.union(wordless), ["_rid", "_t1"], "left_semi")
    return one.select(*[F.col("row").getField(c).alias(c) for c in docs.columns])

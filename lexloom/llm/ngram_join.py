"""N-gram Jaccard self-join of whole texts, exact, as components of linked documents.

1. Texts become sets of shingle ids; equal sets become one class, whose smallest document stands for it.
2. Tiles. Two sets with |A n B| / |A u B| >= t share an id among the first n - ceil(t n) + 1 of each, in any one order of
   ids. The order puts ids that many documents hold last (counted over all documents; it only decides the cost). A tile
   is such an id and its documents. Ids that one document holds end here.
3. Each document is first compared with the tile-mate that heads most of its tiles, by bitmap and then exactly; the
   links give components. In a few turns more, a document whose tiles hold another component is compared with a member of
   it, another member each turn: so a group of near copies comes together by as many comparisons as it has documents.
4. Tiles that hold several components are cut by bands of size (sizes must agree within t) and, where a band is large,
   into blocks; every pair of bands and blocks that can hold links is a task's unit of bounded size. In it, pairs of
   different components are bounded by hashed bitmaps: bits set only in A count ids that B lacks, so
   |A n B| <= |A| - popcount(A & ~B). What the bound leaves goes to the exact intersection of the sorted arrays.
5. The links found are added, and the components of all links are the result.
"""

from __future__ import annotations

import hashlib
import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lexloom.llm.bloom import filled, has, spots
from lexloom.llm.components import components
from lexloom.llm.shingles import shingle_ids
from lexloom.llm.tables import bound_batches, discard, keep, release, resting

#: Least bits of a bitmap (it has 1.5 for each id or more, a power of two); documents of a band in one block; children
#: compared with one copy of their parent.
BITS, BLOCK, CHILDREN = 512, 512, 512
#: Ids counted in a worker before counts under HEAVY_PART are forgotten; the most ids put last, and their least count.
COUNTED, HEAVY_PART, HEAVY_IDS, HEAVY = 2_000_000, 2, 1_000_000, 3
#: Documents to a file of the narrow tables between steps.
ROWS_IN_FILE = 40_000
#: Tiles of a document that tell where a pair meets first (pairs that meet in none of them are told wherever they meet).
FIRST_TILES = 32
#: Turns in which documents ask a member of another component of their tiles, before all pairs that are left are bounded.
TURNS = 3
#: Documents in a part of a tile; the bits of a tile that number its parts.
PART, PARTS = 20_000, np.uint64(255)


def _bitmap(ids: np.ndarray) -> bytes:
    bits = max(BITS, 1 << (3 * len(ids) // 2).bit_length())
    flags = np.zeros(bits, np.uint8)
    flags[(ids & np.uint64(bits - 1)).astype(np.int64)] = 1
    return np.packbits(flags).tobytes()


def _sets(df: DataFrame, key: str, text: str, k: int) -> DataFrame:
    """Rows of documents (n, set_hash, bitmap) and of ids that many of them hold (id, times)."""

    def counts(held: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
        ids, n = np.unique(np.concatenate(held), return_counts=True)
        return ids[n >= HEAVY_PART], n[n >= HEAVY_PART]

    def made(keys, n, h, maps, ids, times):
        m = len(n)
        return pa.RecordBatch.from_arrays(
            [
                pa.concat_arrays([keys, pa.nulls(len(ids), keys.type)]),
                pa.array([*n, *[None] * len(ids)], pa.int64()),
                pa.array([*h, *[None] * len(ids)], pa.binary()),
                pa.array([*maps, *[None] * len(ids)], pa.binary()),
                pa.concat_arrays([pa.nulls(m, pa.int64()), pa.array(ids.view(np.int64))]),
                pa.concat_arrays([pa.nulls(m, pa.int64()), pa.array(times.astype(np.int64))]),
            ],
            ["key", "n", "set_hash", "bitmap", "id", "times"],
        )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, size, none = [], 0, np.zeros(0, np.uint64)
        for batch in batches:
            n, h, maps = [], [], []
            for t in batch.column(1):
                ids = shingle_ids(t.as_py(), k)
                n.append(len(ids))
                h.append(hashlib.blake2b(ids.tobytes(), digest_size=16).digest())
                maps.append(_bitmap(ids))
                held.append(ids)
                size += len(ids)
                if size >= COUNTED:
                    yield made(batch.column(0)[:0], [], [], [], *counts(held))
                    held, size = [], 0
            yield made(batch.column(0), n, h, maps, none, none)
        if held:
            yield made(batch.column(0)[:0], [], [], [], *counts(held))

    return df.select(F.col(key).alias("key"), F.col(text)).mapInArrow(run, "key long, n long, set_hash binary, bitmap binary, id long, times long")


def _least_overlap(n: int, num: int, den: int) -> int:
    return -(-num * n // den)


def _index(df: DataFrame, key: str, text: str, k: int, num: int, den: int, heavy: tuple[np.ndarray, np.ndarray]) -> DataFrame:
    """Rows (tile, node): the ids under which a document is looked up. The low 8 bits of a tile are 0, or the number of a
    part (from 1) where very many documents share the id; equal sets share their parts."""
    shared = df.sparkSession.sparkContext.broadcast(heavy)  # at most HEAVY_IDS ids

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        last, times = shared.value
        for batch in batches:
            tiles = []
            for t in batch.column(1):
                ids = shingle_ids(t.as_py(), k)
                size = len(ids) - _least_overlap(len(ids), num, den) + 1 if len(ids) else 0
                own, part = ids[:size], np.uint64(0)
                if len(last) and len(ids):
                    at = np.minimum(np.searchsorted(last, ids), len(last) - 1)
                    weight = np.where(last[at] == ids, times[at], 0)
                    if weight.any():
                        order = np.argsort(weight, kind="stable")[:size]  # ids ascend, so ties are by id
                        own, weight = ids[order], weight[order]
                        parts, drawn = np.clip(weight // PART, 1, 255).astype(np.uint64), np.uint64(int.from_bytes(hashlib.blake2b(ids.tobytes(), digest_size=4).digest(), "little"))
                        part = np.where(parts > 1, drawn % parts + np.uint64(1), np.uint64(0))
                tiles.append((own & ~PARTS) | part)
            sizes = [len(x) for x in tiles]
            node = np.repeat(batch.column(0).to_numpy(zero_copy_only=False), sizes)
            yield pa.RecordBatch.from_arrays([pa.array(np.concatenate([np.zeros(0, np.uint64), *tiles]).view(np.int64)), pa.array(node.astype(np.int64))], ["tile", "node"])

    return df.select(F.col(key), F.col(text)).mapInArrow(run, "tile long, node long")


def _arrays(df: DataFrame, key: str, text: str, k: int, nodes: DataFrame) -> DataFrame:
    """node, ids (sorted, 8 bytes each) of the documents in `nodes`, and of a few others that a Bloom filter of fixed size
    lets through; so no text is shuffled."""
    shared = df.sparkSession.sparkContext.broadcast(filled(nodes, "node"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            x, y = (batch.column(i).to_numpy(zero_copy_only=False) for i in (2, 3))
            rows = np.flatnonzero(has(shared.value, x, y))
            ids = [shingle_ids(batch.column(1)[i].as_py(), k) for i in rows.tolist()]
            yield pa.RecordBatch.from_arrays([batch.column(0).take(pa.array(rows)), pa.array([i.tobytes() for i in ids], pa.binary())], ["node", "ids"])

    x, y = spots(F.col(key))
    return df.select(F.col(key), F.col(text), x.alias("x"), y.alias("y")).mapInArrow(run, "node long, ids binary").filter(F.octet_length("ids") > 0)


def _parted(tile: np.ndarray) -> np.ndarray:
    return (tile & np.int64(PARTS)) > 0


def _shared_tiles(rows: DataFrame) -> DataFrame:
    """rows (tile, node) -> those of tiles with more than one row, with `head`: the smallest node of the tile's part. A row
    alone in its part stays as its own head, as the id's other parts may hold more. One row is held between batches,
    whatever a tile's size."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, head = None, None  # the last row, which waits for the next one; the head of its run if that began before
        for batch in batches:
            tile, node = (c.to_numpy(zero_copy_only=False) for c in batch.columns)
            if not len(tile):
                continue
            if held is not None:
                tile, node = (np.concatenate([[h], c]) for h, c in zip(held, (tile, node), strict=True))
            same = tile[1:] == tile[:-1]
            first = np.concatenate([[True], ~same])
            heads = node[np.maximum.accumulate(np.where(first, np.arange(len(tile)), 0))]
            wanted = ~(first & np.concatenate([~same, [True]])) | _parted(tile)
            if head is not None:
                end = len(tile) if same.all() else int(np.argmin(same)) + 1
                heads[:end] = head
                wanted[0] = True
            yield made(tile[:-1], node[:-1], heads[:-1], wanted[:-1])
            continues = not first[-1] or (len(tile) == 1 and head is not None)
            head = heads[-1] if continues else None
            held = (tile[-1], node[-1])
        if held is not None and (head is not None or _parted(held[0])):
            yield made(*(np.array([x]) for x in (*held, held[1] if head is None else head)), np.array([True]))

    def made(tile, node, head, wanted):
        return pa.RecordBatch.from_arrays([pa.array(c[wanted].astype(np.int64)) for c in (tile, node, head)], ["tile", "node", "head"])

    return rows.repartition("tile").sortWithinPartitions("tile", "node").mapInArrow(run, "tile long, node long, head long")


def _verified(pairs: DataFrame, sets: DataFrame, num: int, den: int, files: int) -> DataFrame:
    """pairs (parent, child) that link, by exact intersection of sorted arrays. A parent's array goes to each part of its
    children; a part is of about CHILDREN."""
    degree = pairs.groupBy("parent").count().select("parent", F.ceil(F.col("count") / CHILDREN).alias("parts"))
    split = pairs.join(degree, "parent").select("parent", F.pmod(F.xxhash64("child"), F.col("parts")).alias("part"), "child")
    split = keep(split, "pairs", files)
    children = split.join(sets, split["child"] == sets["node"]).select("parent", "part", F.lit(1).alias("kind"), F.col("node"), "ids")
    parents = split.select("parent", "part").distinct().join(sets, F.col("parent") == F.col("node")).select("parent", "part", F.lit(0).alias("kind"), "node", "ids")
    rows = children.unionByName(parents).repartition("parent", "part").sortWithinPartitions("parent", "part", "kind")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now, own = None, []
        for batch in batches:
            a, b = [], []
            for parent, part, kind, node, ids in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                x = np.frombuffer(ids, np.uint64)
                if now != (parent, part):
                    now, own = (parent, part), []
                if kind == 0:
                    own.append(x)  # rows of one id with several texts have several sets
                    continue
                for y in own:
                    at = np.minimum(np.searchsorted(y, x), len(y) - 1)
                    both = int((y[at] == x).sum())
                    if den * both >= num * (len(x) + len(y) - both):
                        a.append(parent)
                        b.append(node)
                        break
            yield pa.RecordBatch.from_arrays([pa.array(a, pa.int64()), pa.array(b, pa.int64())], ["a", "b"])

    links = keep(rows.mapInArrow(run, "a long, b long"), "links", files)
    discard(split)
    return links


def _at_most(n: int, m: np.ndarray, x: np.ndarray, y: np.ndarray) -> np.ndarray:
    """The largest overlap that sizes and bitmaps leave possible, of one set and several of another width of bitmap (rows
    of y). A wider bitmap is folded: an id's bit is its rest by the width."""
    if y.shape[1] > len(x):
        y = np.bitwise_or.reduce(y.reshape(len(y), -1, len(x)), axis=1)
    elif y.shape[1] < len(x):
        x = np.bitwise_or.reduce(x.reshape(-1, y.shape[1]), axis=0)
    return np.minimum(n - np.bitwise_count(x & ~y).sum(1, dtype=np.int64), m - np.bitwise_count(y & ~x).sum(1, dtype=np.int64))


def _likely(pairs: DataFrame, meta: DataFrame, num: int, den: int) -> DataFrame:
    """pairs (parent, child) that sizes and bitmaps leave possible."""
    side = lambda name: meta.select(F.col("node").alias(name + "_"), F.col("n").alias(name + "_n"), F.col("bitmap").alias(name + "_b"))
    both = pairs.join(side("child"), F.col("child") == F.col("child_")).join(side("parent"), F.col("parent") == F.col("parent_"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            n, m = (batch.column(c).to_numpy() for c in ("child_n", "parent_n"))
            maps = zip(*(batch.column(c).to_pylist() for c in ("child_b", "parent_b")), strict=True)
            most = [int(_at_most(n[i], m[i], np.frombuffer(x, np.uint64), np.frombuffer(y, np.uint64)[None])[0]) for i, (x, y) in enumerate(maps)]
            hit = pa.array((num + den) * np.array(most, np.int64) >= num * (n + m))
            yield pa.RecordBatch.from_arrays([batch.column("parent").filter(hit), batch.column("child").filter(hit)], ["parent", "child"])

    return both.select("parent", "child", "child_n", "parent_n", "child_b", "parent_b").mapInArrow(run, "parent long, child long").distinct()


def _bounded_pairs(rows: DataFrame, num: int, den: int) -> DataFrame:
    """rows (unit columns, side, node, n, component, bitmap, own) -> pairs of different components within a unit that sizes
    and bitmaps leave possible. A unit has at most two blocks; `side` 0 and 1 are compared with each other, side 2 within.
    `own` are a document's first open tiles: a pair that meets in several tiles is told in the first of them."""
    unit = ["tile", "band", "i", "j"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kept = None
        for batch in batches:
            table = pa.Table.from_batches([batch])
            if kept is not None:
                table = pa.concat_tables([kept, table])
            table = table.combine_chunks()
            cols = [table.column(c).to_numpy() for c in unit]
            if not len(table):
                continue
            new = np.flatnonzero(np.any([c[1:] != c[:-1] for c in cols], 0)) + 1
            if not len(new):
                kept = table
                continue
            yield from pairs(table.slice(0, new[-1]), [0, *new])
            kept = table.slice(int(new[-1]))
        if kept is not None and len(kept):
            yield from pairs(kept, [0, len(kept)])

    def pairs(table, edges):
        side, node, n, comp = (table.column(c).to_numpy() for c in ("side", "node", "n", "component"))
        maps, tile, own_tiles = table.column("bitmap").to_pylist(), table.column("tile").to_numpy(), table.column("own")
        width = np.array([len(x) // 8 for x in maps])
        by_width = {w: (np.cumsum(width == w) - 1, np.frombuffer(b"".join(x for x in maps if len(x) == 8 * w), np.uint64).reshape(-1, w)) for w in np.unique(width).tolist()}
        for s, e in zip(edges, edges[1:], strict=False):
            order = s + np.argsort(n[s:e], kind="stable")
            a, b = [], []
            sizes = n[order]
            for q, i in enumerate(order.tolist()):
                stop = int(np.searchsorted(sizes, sizes[q] * den // num, "right"))
                others = order[q + 1 : stop]
                others = others[comp[others] != comp[i]]
                if side[i] != 2 and len(others):
                    others = others[side[others] != side[i]]
                if not len(others):
                    continue
                at, own = by_width[int(width[i])]
                for w, (place, rows) in by_width.items():
                    some = others[width[others] == w]
                    if len(some):
                        hit = some[(num + den) * _at_most(n[i], n[some], own[at[i]], rows[place[some]]) >= num * (n[i] + n[some])]
                        mine = set(own_tiles[i].as_py()) if len(hit) else None
                        for j in hit.tolist():
                            if min(mine.intersection(own_tiles[j].as_py()), default=tile[i]) == tile[i]:
                                a.append(int(node[i]))
                                b.append(int(node[j]))
            if a:
                yield pa.RecordBatch.from_arrays([pa.array(a, pa.int64()), pa.array(b, pa.int64())], ["a", "b"])

    ordered = rows.repartition(*unit).sortWithinPartitions(*unit).select(*unit, "side", "node", "n", "component", "bitmap", "own")
    return ordered.mapInArrow(run, "a long, b long").filter("a <> b").select(F.greatest("a", "b").alias("child"), F.least("a", "b").alias("parent")).distinct()


def _units(tiles: DataFrame, num: int, den: int) -> DataFrame:
    """tiles (tile, node, n, component) -> the units of comparison: a small tile is one; a large one is cut by bands of
    size, a large band into blocks; units are the pairs of blocks of one band or of two neighbouring bands."""
    band = F.floor(F.log(F.col("n").cast("double")) / math.log(den / num))  # linking sizes are in one band or neighbours
    rows = tiles.withColumn("band", band)
    per_band = rows.groupBy("tile", "band").count()
    whole = per_band.groupBy("tile").agg(F.sum("count").alias("all"), F.map_from_entries(F.collect_list(F.struct("band", F.ceil(F.col("count") / BLOCK)))).alias("blocks"))
    rows = rows.join(whole, "tile")
    of = lambda b: F.coalesce(F.element_at("blocks", b), F.lit(0)).cast("long")
    own = F.pmod(F.xxhash64("node"), of(F.col("band")))
    unit = lambda b, i, j, side: F.struct(b.cast("long").alias("band"), i.cast("long").alias("i"), j.cast("long").alias("j"), F.lit(side).alias("side"))
    # in units of two bands, i is a block of the lower band and j, moved past the band's own blocks, of the upper one
    upto = lambda n: F.when(n > 0, F.sequence(F.lit(0).cast("long"), n - 1)).otherwise(F.array().cast("array<long>"))
    here, above, below = of(F.col("band")), of(F.col("band") + 1), of(F.col("band") - 1)
    within = F.transform(upto(here), lambda x: F.when(x == own, unit(F.col("band"), own, own, 2)).when(x > own, unit(F.col("band"), own, x, 0)).otherwise(unit(F.col("band"), x, own, 1)))
    up = F.transform(upto(above), lambda x: unit(F.col("band"), own, -1 - x, 0))
    down = F.transform(upto(below), lambda x: unit(F.col("band") - 1, x, -1 - own, 1))
    zero = F.lit(0)
    units = F.when(F.col("all") <= BLOCK, F.array(unit(F.lit(-1), zero, zero, 2))).otherwise(F.concat(within, up, down))
    return rows.select("tile", "node", "n", "component", F.explode(units).alias("u")).select("tile", "u.*", "node", "n", "component")


def join(df: DataFrame, k: int = 5, num: int = 80, den: int = 100, key: str = "doc_id", text: str = "text") -> DataFrame:
    """key, n_shingles, component_id (the smallest key reachable by links, its own included) for every row of df. Two
    documents link when den * |A n B| >= num * |A u B| over their sets of k-word shingles.

    Null and empty texts and texts without words have n_shingles 0 and link with nothing. Keys are integers; rows of one
    key are one node of the links; a row without a key gets the smallest key with an equal set, or null, and links no
    others. Repeated rows each get a row. Extra columns are not read; an empty table gives an empty result."""
    docs = df.select(F.col(key).cast("long").alias("__key"), F.col(text).alias("__text"))
    bound_batches(df.sparkSession)
    files = max(2, -(-docs.select("__key").count() // ROWS_IN_FILE))
    first = keep(_sets(docs, "__key", "__text", k), "sets", files)
    of_docs = first.filter("n is not null").select("key", "n", "set_hash")
    classes = keep(of_docs.filter("n > 0").groupBy("set_hash").agg(F.min("key").alias("node")), "classes", files)
    top = first.filter("id is not null").groupBy("id").agg(F.sum("times").alias("times")).filter(F.col("times") >= HEAVY).orderBy(F.desc("times"), "id").limit(HEAVY_IDS)
    found = top.toArrow()  # 16 bytes a row
    ids, times = (found.column(c).to_numpy() for c in ("id", "times"))
    ids = ids.view(np.uint64)
    order = np.argsort(ids)
    heavy = (ids[order], times[order].astype(np.int32))
    del found, ids, times, order
    release(df.sparkSession)

    nodes = classes.filter("node is not null").select(F.col("node").alias("v"))
    keyed = docs.filter("__key is not null")
    shared = _shared_tiles(_index(keyed, "__key", "__text", k, num, den, heavy))
    # copies have the tiles of the document that stands for them, which is the smallest: only it goes on
    tiles = keep(shared.join(nodes.distinct(), F.col("node") == F.col("v"), "left_semi"), "tiles", files)

    meta = first.filter("n > 0 and key is not null").select(F.col("key").alias("node"), "n", "bitmap")
    mates = tiles.filter("node <> head")
    best = mates.groupBy("node", "head").count().groupBy("node").agg(F.max_by("head", F.struct(F.col("count"), -F.col("head"))).alias("parent"))

    def exact(pairs: DataFrame) -> DataFrame:
        arrays = keep(_arrays(keyed, "__key", "__text", k, pairs.select(F.explode(F.array("parent", "child")).alias("node")).distinct()), "arrays", files)
        found = _verified(pairs, arrays, num, den, files)
        discard(arrays)
        return found

    likely = keep(_likely(best.select("parent", F.col("node").alias("child")), meta, num, den), "likely", files)
    links = exact(likely)

    found = components(links, files)
    star = lambda: found.select(F.col("node").alias("v"), "component")

    def mixed(rows: DataFrame) -> DataFrame:
        """rows (tile, node) of the tiles that hold several components, with the component."""
        now = keep(rows.join(star(), F.col("node") == F.col("v"), "left").select("tile", "node", F.coalesce("component", "node").alias("component")), "placed", files)
        several = now.groupBy("tile").agg(F.min("component").alias("x"), F.max("component").alias("y")).filter("x <> y").select(F.col("tile").alias("m"))
        left = keep(now.join(several, F.col("tile") == F.col("m"), "left_semi"), "mixed", files)
        discard(now)
        return left

    open_tiles = mixed(tiles.select(F.col("tile").bitwiseAND(~255).alias("tile"), "node"))
    discard(tiles, likely, links)
    for turn in range(TURNS):
        # a member of the tile's first component, another one each turn; a document asks the one it meets most
        asked = open_tiles.groupBy(F.col("tile").alias("m")).agg(F.min(F.struct("component", F.xxhash64(F.lit(turn), "node").alias("h"), "node")).alias("r")).select("m", F.col("r.component").alias("c"), F.col("r.node").alias("head"))
        met = open_tiles.join(asked, F.col("tile") == F.col("m")).filter("component <> c").groupBy("node", "head").count()
        best = met.groupBy("node").agg(F.max_by("head", F.struct(F.col("count"), -F.col("head"))).alias("parent"))
        likely = keep(_likely(best.select("parent", F.col("node").alias("child")), meta, num, den), "likely", files)
        links = exact(likely)
        if links.isEmpty():
            discard(likely, links)
            break
        joined = components(star().select(F.col("v").alias("a"), F.col("component").alias("b")).unionByName(links), files)
        discard(found, likely, links)
        found, before = joined, open_tiles
        open_tiles = mixed(before.select("tile", "node"))
        discard(before)
    known, every_open = star(), open_tiles
    # of tiles with the same documents one is enough; a passage gives many such
    twins = open_tiles.groupBy("tile").agg(F.count(F.lit(1)).alias("k"), *[F.sum(F.xxhash64(F.lit(i), "node").cast("decimal(38,0)")).alias(f"s{i}") for i in (1, 2)])
    alone = twins.groupBy("k", "s1", "s2").agg(F.min("tile").alias("m")).select("m")
    open_tiles = open_tiles.join(alone, F.col("tile") == F.col("m"), "left_semi")
    sizes = meta.select(F.col("node").alias("v"), "n")
    open_tiles = keep(open_tiles.join(sizes, F.col("node") == F.col("v")).select("tile", "node", "n", "component").distinct(), "open", files)
    discard(every_open)
    bitmaps = meta.select(F.col("node").alias("v"), F.col("n").alias("vn"), "bitmap")
    marked = _units(open_tiles, num, den).join(bitmaps, (F.col("node") == F.col("v")) & (F.col("n") == F.col("vn"))).drop("v", "vn")
    first_tiles = open_tiles.groupBy(F.col("node").alias("v")).agg(F.slice(F.array_sort(F.collect_set("tile")), 1, FIRST_TILES).alias("own"))
    marked = marked.join(first_tiles, F.col("node") == F.col("v")).drop("v")
    possible = keep(_bounded_pairs(marked, num, den), "possible", files)
    discard(open_tiles)
    more = exact(possible.select("parent", "child"))
    stars = known.select(F.col("v").alias("a"), F.col("component").alias("b"))  # what is joined already needs no rounds
    final = components(stars.unionByName(more), files)

    of_class = classes.join(final.withColumnRenamed("node", "v"), F.col("node") == F.col("v"), "left").select(F.col("set_hash").alias("s2"), F.coalesce("component", "node").alias("component"))
    of_class = keep(of_class, "of_class", files)
    discard(possible, more, found, final, classes)
    out = of_docs.join(of_class, F.col("set_hash") == F.col("s2"), "left")
    return resting(out.select(F.col("key").alias(key), F.col("n").alias("n_shingles"), F.coalesce("component", "key").alias("component_id")), first, of_class)

"""Near duplicates by HyperMinHash sketches, banding, corrected estimates and exact verification.

1. One pass hashes every document's distinct word shingles.  The set's hashes
   fall into ``REGISTERS`` buckets; a register keeps the leading-zero count and
   ``MANTISSA`` bits of its bucket's smallest hash.
2. Documents with the same set are one class, found by an aggregate on a 128-bit
   digest of the set.  Only the class's smallest id goes on.
3. Bands of compressed registers propose pairs.  Within a bucket every member is
   first paired with the smallest id only, so a group of copies costs a line per
   copy and not a line per pair.
4. Registers estimate the Jaccard similarity, corrected for chance collisions;
   pairs well below the threshold are let go.  The rest are verified on the full
   sets, which are made again from the text for the documents concerned only.
5. Linked documents form components.  Members of a bucket that are still in
   different components are then compared as well, so that no link is lost to the
   choice of a bucket's first member; pairs within a component could add nothing.
   Small buckets (up to ``SMALL`` members) give pairs.  Large ones are joined into
   clusters, which mostly hold documents with common lines that are no copies.
   Of a cluster's members only those are compared that share one of their rarest
   shingles: two sets that are linked always do, if as many are taken of each set
   as it may miss, and one more.  Shingles shared by up to ``SMALL`` members give
   pairs again.  What shares a more frequent one meets in blocks of ``BLOCK``: a
   task multiplies the incidence matrices of two blocks and returns a spanning
   forest of the links.

Defined cases: null text counts as empty; a document without words has an empty
set and is linked with nothing; with fewer words than a shingle the whole
sequence is one; rows that share an id are one node; a row without an id is
linked with nothing and has a null component; ties don't arise, as links are
symmetric; further columns are not looked at.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import batches, byte_texts, components, discard, mixed, store, text_key, word_hashes

BUCKET_BITS = 7
REGISTERS = 1 << BUCKET_BITS
MANTISSA = 10
ROWS = 4                  # registers to a band: 32 bands
#: How far below the threshold an estimate may lie: 4.5 standard deviations of 128 registers.
SLACK = 0.15
CHUNK = 256               # members verified against one set in one go
SMALL = 32                # members of a bucket that are paired one by one
BLOCK = 2048              # members of a cluster's block
CELLS = 1 << 18           # at most, counts that tell frequent shingles from rare ones
PAGE = 1 << 15            # bits of a bitmap of Spark's


def shingles(text: bytes, width: int) -> np.ndarray:
    """Sorted hashes of the distinct shingles of a whole text, A-Z lower-cased."""
    words = text.lower().split()  # on bytes: ASCII letters and ASCII white space only
    if not words:
        return np.empty(0, dtype=np.uint64)
    h = word_hashes(words)
    n = max(1, len(h) - width + 1)
    out = np.full(n, len(words) if len(h) < width else width, dtype=np.uint64)
    for i in range(min(width, len(h))):
        out = mixed(out * np.uint64(0x9E3779B97F4A7C15) + h[i:i + n])
    return np.unique(out)


def smallest(hashes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Per bucket the smallest remaining hash, and whether there is any."""
    rest, full = np.zeros(REGISTERS, dtype=np.uint64), np.zeros(REGISTERS, dtype=bool)
    bucket, first = np.unique(hashes >> np.uint64(64 - BUCKET_BITS), return_index=True)
    rest[bucket] = hashes[first] << np.uint64(BUCKET_BITS)
    full[bucket] = True
    return rest, full


def compress(rest: np.ndarray, full: np.ndarray) -> np.ndarray:
    """Registers: 0 if empty, else 1 + leading zeros and mantissa bits."""
    exponent = np.frexp(rest.astype(np.float64))[1]
    zeros = np.clip(64 - exponent, 0, 62).astype(np.uint64)
    tail = (rest << zeros << np.uint64(1)) >> np.uint64(64 - MANTISSA)
    return np.where(full, ((zeros << np.uint64(MANTISSA)) | tail) + np.uint64(1), np.uint64(0)).astype(np.uint16)


def chance(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Expected share of registers in which independent sets of sizes a and b agree."""
    x, y = np.maximum(a, 1e-9) / REGISTERS, np.maximum(b, 1e-9) / REGISTERS
    total = np.zeros(np.broadcast(x, y).shape)
    for i in range(60):
        hi, lo = 2.0**-i, 2.0 ** -(i + 1)
        total += 2.0 ** -(i + 1 + MANTISSA) * x * y / (x + y) * (np.exp(-(x + y) * lo) - np.exp(-(x + y) * hi))
    return total


def jaccard(left: np.ndarray, right: np.ndarray, n_left: np.ndarray, n_right: np.ndarray) -> np.ndarray:
    """Collision-corrected estimate from registers, one row per pair."""
    some = ((left > 0) | (right > 0)).sum(1)
    same = ((left == right) & (left > 0)).sum(1)
    by_chance = np.minimum(chance(n_left, n_right) * REGISTERS, some)
    return np.clip((same - by_chance) / np.maximum(some - by_chance, 1e-9), 0, 1)


def sketches(docs: DataFrame, width: int) -> DataFrame:
    """doc_id, key of the text, n_shingles, digest of the set, registers, bands."""
    kind = pa.schema([("doc_id", pa.int64()), ("key", pa.int64()), ("n_shingles", pa.int64()), ("digest", pa.binary()),
                      ("registers", pa.binary()), ("bands", pa.list_(pa.int64()))])

    def run(rows: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches(rows):
            n, digest = [], []
            rest = np.zeros((batch.num_rows, REGISTERS), dtype=np.uint64)
            full = np.zeros((batch.num_rows, REGISTERS), dtype=bool)
            for i, text in enumerate(byte_texts(batch.column(2))):
                h = shingles(text, width)
                n.append(len(h))
                digest.append(xxhash.xxh3_128_digest(h.tobytes()) if len(h) else None)
                rest[i], full[i] = smallest(h)
            reg = compress(rest, full)
            grouped = reg.reshape(len(reg), -1, ROWS).astype(np.uint64)
            key = np.broadcast_to(np.arange(grouped.shape[1], dtype=np.uint64), grouped.shape[:2])
            for r in range(ROWS):
                key = mixed(key * np.uint64(0x9E3779B97F4A7C15) + grouped[:, :, r] + np.uint64(1))
            live = grouped.any(axis=2)
            bands = pa.array([k[m].view(np.int64) for k, m in zip(key, live, strict=True)], pa.list_(pa.int64()))
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(1), pa.array(n, pa.int64()), pa.array(digest, pa.binary()),
                 pa.array([r.tobytes() for r in reg], pa.binary()), bands], schema=kind)

    rows = docs.select(F.col("doc_id").cast("long"), text_key().alias("key"), F.col("text").cast("string"))
    return rows.mapInArrow(run, "doc_id bigint, key bigint, n_shingles bigint, digest binary, registers binary, bands array<bigint>")


def _likely(pairs: DataFrame, sketch: DataFrame, threshold: float) -> DataFrame:
    """The pairs (a, b) whose corrected estimate isn't well below the threshold."""
    side = lambda c: sketch.select(F.col("node").alias(c), F.col("registers").alias(f"r{c}"), F.col("n_shingles").alias(f"n{c}"))

    def run(rows: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in rows:
            if not batch.num_rows:
                continue
            ra, rb = (np.frombuffer(b"".join(batch.column(c).to_pylist()), dtype=np.uint16).reshape(-1, REGISTERS) for c in ("ra", "rb"))
            na, nb = (batch.column(c).to_numpy().astype(float) for c in ("na", "nb"))
            good = (jaccard(ra, rb, na, nb) >= threshold - SLACK) & (np.minimum(na, nb) >= (threshold - 1e-9) * np.maximum(na, nb))
            yield batch.select(["a", "b"]).filter(pa.array(good))

    return pairs.join(side("a"), "a").join(side("b"), "b").select("a", "b", "ra", "rb", "na", "nb").mapInArrow(run, "a bigint, b bigint")


def _requests(pairs: DataFrame) -> DataFrame:
    """Who has to bring a set where: pairs meet at (a, chunk), a's set first."""
    sizes = pairs.groupBy("a").agg(F.count("*").alias("n"))
    chunked = store(pairs.join(sizes, "a").select("a", "b", F.pmod(F.xxhash64("b"), F.ceil(F.col("n") / CHUNK)).alias("chunk")))
    row = lambda who, side: (F.col(who).alias("id"), F.lit(0).alias("kind"), F.col("a").alias("g"), F.col("chunk").alias("h"),
                             F.lit(side).alias("side"), F.lit(0).cast("long").alias("part"))
    return chunked.select(*row("b", 1)).unionByName(chunked.select(*row("a", 0)).distinct())


def _block_requests(members: DataFrame) -> DataFrame:
    """Members (cluster, id, part) meet block by block, unless both blocks are of one component."""
    order = Window.partitionBy("cluster").orderBy("part", "id")
    placed = store(members.withColumn("block", F.floor((F.row_number().over(order) - 1) / BLOCK)))
    blocks = placed.groupBy("cluster", "block").agg(F.min("part").alias("lo"), F.max("part").alias("hi"))
    right = blocks.select("cluster", F.col("block").alias("block2"), F.col("lo").alias("lo2"), F.col("hi").alias("hi2"))
    meet = blocks.join(right, "cluster").where("block <= block2 and least(lo, lo2) <> greatest(hi, hi2)")
    meet = meet.select("cluster", F.explode(F.array_distinct(F.array("block", "block2"))).alias("block"),
                       (F.col("block") * (1 << 31) + F.col("block2")).alias("h"), F.col("block").alias("left"))
    return placed.join(meet, ["cluster", "block"]).select(
        "id", F.lit(1).alias("kind"), F.col("cluster").alias("g"), "h", (F.col("block") != F.col("left")).cast("int").alias("side"), "part")


def forest(sets: list[np.ndarray], ids: list[int], sides: list[int], parts: list[int], percent: tuple[int, int]) -> list[tuple[int, int]]:
    """Links between the two sides (or within the only one), as few as connect the same components."""
    size = np.array([len(x) for x in sets])
    owner = np.repeat(np.arange(len(sets)), size)
    _, back, count = np.unique(np.concatenate(sets), return_inverse=True, return_counts=True)
    shared = np.cumsum(count > 1) - 1  # only hashes of two sets or more can be in an intersection
    keep = (count > 1)[back]
    column, owner = shared[back][keep], owner[keep]
    side, part = np.array(sides), np.array(parts)
    left, right = (np.flatnonzero(side == 0), np.flatnonzero(side == 1)) if side.any() else (np.arange(len(sets)),) * 2
    both = np.zeros((len(left), len(right)), dtype=np.float32)
    for at in range(0, int(shared[-1]) + 1, 4096):
        here = (column >= at) & (column < at + 4096)
        hit = np.zeros((len(sets), 4096), dtype=np.float32)
        hit[owner[here], column[here] - at] = 1
        both += hit[left] @ hit[right].T
    linked = percent[1] * both >= percent[0] * (size[left][:, None] + size[right][None, :] - both)
    i, j = np.nonzero(linked & (part[left][:, None] != part[right][None, :]))
    i, j = left[i], right[j]
    # one link of each pair of components is enough
    _, back = np.unique(part, return_inverse=True)
    _, first = np.unique(np.minimum(back[i], back[j]) * len(part) + np.maximum(back[i], back[j]), return_index=True)
    i, j = i[first], j[first]
    root: dict[int, int] = {}

    def top(x: int) -> int:
        while root.get(x, x) != x:
            root[x] = root.get(root[x], root[x])
            x = root[x]
        return x

    out = []
    for x, y in zip(i.tolist(), j.tolist(), strict=True):
        a, b = top(parts[x]), top(parts[y])
        if a != b:
            root[max(a, b)] = min(a, b)
            out.append((min(ids[x], ids[y]), max(ids[x], ids[y])))
    return out


def _texts(docs: DataFrame, wanted: DataFrame, heads: DataFrame) -> DataFrame:
    """``wanted``, which has an id, with the text that stands for it; a bitmap of hashes leaves nearly all other texts where they are."""
    keyed = store(wanted.join(heads.select(F.col("node").alias("id"), "doc_id", "key"), "id"))
    pages = 1 + 8 * keyed.count() // PAGE  # eight bits a text
    spot = F.pmod(F.xxhash64("doc_id", "key"), F.lit(pages * PAGE))
    page, at = F.floor(spot / PAGE).alias("page"), (spot % PAGE)
    bits = keyed.select(page, at.alias("at")).groupBy("page").agg(F.bitmap_construct_agg("at").alias("bits"))
    texts = docs.select(F.col("doc_id").cast("long").alias("doc_id"), text_key().alias("key"), F.col("text").cast("string"))
    near = texts.select("*", page, at.alias("at")).join(F.broadcast(bits), "page").where(
        "(cast(conv(hex(substring(bits, cast(at div 8 as int) + 1, 1)), 16, 10) as int) & shiftleft(1, cast(at % 8 as int))) <> 0")
    return near.select("doc_id", "key", "text").join(keyed, ["doc_id", "key"]).select("text", *wanted.columns)


def _rarest(members: DataFrame, docs: DataFrame, heads: DataFrame, width: int, percent: tuple[int, int]) -> DataFrame:
    """(cluster, shingle, id, part, n): each member's rarest shingles, so many that linked sets share one.

    A set of n links only to sets that hold ``least`` of its shingles.  In one order
    of all shingles, the first that two linked sets share is among the first n - least + 1 of
    both.  Any order will do; the one by counts puts those of common lines last.
    """
    held = store(_texts(docs, members, heads).select("id", "cluster", "part", "text"))
    total = heads.join(members.select(F.col("id").alias("node")), "node").agg(F.sum("n_shingles")).first()[0] or 0
    cells = min(CELLS, 1 << max(12, (total // 16).bit_length()))

    def count(rows: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen = np.zeros(cells, dtype=np.int64)
        for batch in batches(rows):
            if batch.num_rows:
                every = np.concatenate([shingles(text, width) for text in byte_texts(batch.column(0))])
                seen += np.bincount((every % np.uint64(cells)).astype(np.int64), minlength=cells)
        cell = np.flatnonzero(seen)
        yield pa.RecordBatch.from_arrays([pa.array(cell, pa.int64()), pa.array(seen[cell], pa.int64())], ["cell", "n"])

    counted = held.select("text").mapInArrow(count, "cell bigint, n bigint").groupBy("cell").agg(F.sum("n").alias("n")).toArrow()
    often = np.zeros(cells, dtype=np.int64)  # at most ``CELLS`` numbers
    often[counted.column("cell").to_numpy()] = counted.column("n").to_numpy()
    kinds = {"cluster": pa.int64(), "shingle": pa.int64(), "id": pa.int64(), "part": pa.int64(), "n": pa.int64()}

    def rarest(rows: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches(rows, 1 << 20):
            chosen, size = [], []
            for text in byte_texts(batch.column(3)):
                h = shingles(text, width)
                most = len(h) + percent[0] * len(h) // -percent[1] + 1
                chosen.append(h[np.lexsort((h, often[(h % np.uint64(cells)).astype(np.int64)]))[:most]])
                size.append(len(h))
            times = [len(c) for c in chosen]
            owner = np.repeat(np.arange(len(times)), times)
            tokens = np.concatenate(chosen) if chosen else np.empty(0, np.uint64)
            node, cluster, part = (batch.column(i).to_numpy()[owner] for i in range(3))
            columns = (cluster, tokens.view(np.int64), node, part, np.array(size, dtype=np.int64)[owner])
            yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds.values(), strict=True)], list(kinds))

    out = store(held.mapInArrow(rarest, ", ".join(f"{k} bigint" for k in kinds)))
    discard(held)
    return out


def _meetings(members: DataFrame, docs: DataFrame, heads: DataFrame, width: int, percent: tuple[int, int]) -> tuple[DataFrame, DataFrame]:
    """Pairs (a, b) of members (cluster, id, part) to compare, and members of new clusters to compare block by block."""
    rare = _rarest(members, docs, heads, width, percent)
    shared = rare.groupBy("cluster", "shingle").agg(
        F.min("part").alias("lo"), F.max("part").alias("hi"), F.min("id").alias("first"), F.count("*").alias("times"))
    met = store(rare.join(shared.where("lo <> hi").select("cluster", "shingle", "first", "times"), ["cluster", "shingle"]))
    discard(rare)
    often = components(met.where(F.col("times") > SMALL).select(F.col("first").alias("a"), F.col("id").alias("b")).distinct())
    group = store(often.withColumnRenamed("component", "group"))
    few = met.where(F.col("times") <= SMALL).join(group, "id", "left").select(
        "cluster", "shingle", "id", "part", "n", F.coalesce("group", "id").alias("c"))
    other = few.select("cluster", "shingle", F.col("id").alias("b"), F.col("part").alias("part_b"), F.col("n").alias("n_b"), F.col("c").alias("c_b"))
    alike = f"{percent[1]} * least(n, n_b) >= {percent[0]} * greatest(n, n_b)"
    pairs = few.join(other, ["cluster", "shingle"]).where(f"id < b and part <> part_b and c <> c_b and {alike}")
    blocks = group.join(members.select("id", "part"), "id").select(F.col("group").alias("cluster"), "id", "part")
    return pairs.select(F.col("id").alias("a"), "b").distinct(), blocks


def _verified(wanted: DataFrame, docs: DataFrame, heads: DataFrame, width: int, percent: tuple[int, int]) -> DataFrame:
    """Links (a, b) among those that meet, judged on full sets made from the text."""
    places = wanted.groupBy("id").agg(F.collect_list(F.struct("kind", "g", "h", "side", "part")).alias("places"))
    found = _texts(docs, places, heads).select("id", "text", "places")
    names = ("kind", "g", "h", "side", "part")

    def sets(rows: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches(rows, 1 << 18):
            out: tuple[list, ...] = ([], [], [], [], [], [], [])
            for doc, text, places in zip(batch.column(0).to_pylist(), byte_texts(batch.column(1)), batch.column(2).to_pylist(), strict=True):
                body = shingles(text, width).tobytes()
                for p in places:
                    for column, value in zip(out, (*(p[n] for n in names), doc, body), strict=True):
                        column.append(value)
            kinds = (pa.int32(), pa.int64(), pa.int64(), pa.int32(), pa.int64(), pa.int64(), pa.binary())
            yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(out, kinds, strict=True)], [*names, "id", "body"])

    def compare(rows: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        place, mine, held, last = None, np.empty(0, dtype=np.uint64), [], None
        for batch in rows:
            out: list[tuple[int, int]] = []
            for kind, g, h, side, part, doc, body in zip(*(batch.column(c).to_pylist() for c in (*names, "id", "body")), strict=True):
                if held and place != (kind, g, h):
                    out += forest(*map(list, zip(*held, strict=True)), percent)
                    held = []
                other = np.frombuffer(body, dtype=np.uint64)
                if kind == 0 and side == 0:
                    mine = other
                elif kind == 0:
                    both = len(np.intersect1d(mine, other, assume_unique=True))
                    if percent[1] * both >= percent[0] * (len(mine) + len(other) - both):
                        out.append((g, doc))
                elif place != (kind, g, h) or last != (side, doc):
                    held.append((other, doc, side, part))
                place, last = (kind, g, h), (side, doc)
            yield _links(out)
        yield _links(forest(*map(list, zip(*held, strict=True)), percent) if held else [])

    # a set comes before those it is compared with; repeated rows of one id come together
    bodies = found.mapInArrow(sets, "kind int, g bigint, h bigint, side int, part bigint, id bigint, body binary")
    met = bodies.repartition("kind", "g", "h").sortWithinPartitions("kind", "g", "h", "side", "id")
    return met.mapInArrow(compare, "a bigint, b bigint").distinct()


def _links(rows: list[tuple[int, int]]) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array([r[0] for r in rows], pa.int64()), pa.array([r[1] for r in rows], pa.int64())], ["a", "b"])


def near_duplicates(docs: DataFrame, *, width: int = 5, percent: tuple[int, int] = (80, 100)) -> DataFrame:
    """doc_id, key, n_shingles, component_id, kept; a row per row of ``docs``.

    Two documents are linked if ``percent[1] * |intersection| >= percent[0] * |union|``.
    """
    threshold = percent[0] / percent[1]
    sketch = store(sketches(docs, width))
    usable = sketch.where("n_shingles > 0 and doc_id is not null")
    classes = store(usable.groupBy("digest", "n_shingles").agg(F.min("doc_id").alias("class_id")))
    members = usable.select("doc_id", "digest", "n_shingles").join(classes, ["digest", "n_shingles"])
    same = members.where("doc_id <> class_id").select(F.col("class_id").alias("a"), F.col("doc_id").alias("b"))
    # a node per class, not per id: an id with several texts stands in several classes
    own = F.struct("doc_id", "key")
    first = store(usable.groupBy("digest", "n_shingles").agg(F.min_by(F.struct("doc_id", "key", "registers", "bands"), own).alias("x")))
    heads = store(first.select(F.monotonically_increasing_id().alias("node"), "n_shingles", "x.*"))
    discard(first)
    bands = heads.select("node", F.explode("bands").alias("band"))
    shared = bands.groupBy("band").agg(F.min("node").alias("first"), F.count("*").alias("n")).where("n > 1").select("band", "first")
    buckets = store(bands.join(shared, "band").select("band", "first", "node"))
    stars = buckets.where("node <> first").select(F.col("first").alias("a"), F.col("node").alias("b")).distinct()
    likely = store(_likely(stars, heads, threshold))
    links = store(_verified(_requests(likely), docs, heads, width, percent))
    parts = store(components(links))
    # what the stars left apart
    placed = buckets.join(parts.withColumnRenamed("id", "node"), "node", "left").select(
        "band", "node", F.coalesce("component", "node").alias("part"))
    apart = placed.groupBy("band").agg(F.min("part").alias("lo"), F.max("part").alias("hi"), F.min("node").alias("first"), F.count("*").alias("n"))
    left = store(placed.join(apart.where("lo <> hi").select("band", "first", "n"), "band"))
    large = components(left.where(F.col("n") > SMALL).select(F.col("first").alias("a"), F.col("node").alias("b")).distinct())
    cluster = store(large.withColumnsRenamed({"id": "node", "component": "cluster"}))
    small = left.where(F.col("n") <= SMALL).join(cluster, "node", "left").select("band", "node", "part", F.coalesce("cluster", "node").alias("c"))
    other = small.select("band", F.col("node").alias("b"), F.col("part").alias("part_b"), F.col("c").alias("c_b"))
    rest = small.join(other, "band").where("node < b and part <> part_b and c <> c_b").select(F.col("node").alias("a"), "b").distinct()
    rest = store(_likely(rest.join(stars, ["a", "b"], "left_anti"), heads, threshold))
    members = cluster.join(parts.withColumnRenamed("id", "node"), "node", "left").select(
        "cluster", F.col("node").alias("id"), F.coalesce("component", "node").alias("part"))
    pairs, blocks = _meetings(members, docs, heads, width, percent)
    rest = rest.unionByName(pairs).distinct()
    more = _verified(_requests(rest).unionByName(_block_requests(blocks)), docs, heads, width, percent)
    # links of classes are links of the ids that stand for them; ids of several classes join these
    head = lambda c: heads.select(F.col("node").alias(c), F.col("doc_id").alias(f"id_{c}"))
    found = links.unionByName(more).join(head("a"), "a").join(head("b"), "b").select(F.col("id_a").alias("a"), F.col("id_b").alias("b"))
    joined = components(store(found.unionByName(same.select("a", "b"))))
    out = sketch.select("doc_id", "key", "n_shingles", "digest").join(joined.withColumnRenamed("id", "doc_id"), "doc_id", "left")
    component = F.when(F.col("n_shingles") > 0, F.coalesce("component", "doc_id")).otherwise(F.col("doc_id"))
    return out.select(
        "doc_id", "key", "n_shingles", component.alias("component_id"),
        F.coalesce(component == F.col("doc_id"), F.lit(True)).alias("kept"))


def keep_one(docs: DataFrame, *, width: int = 5, percent: tuple[int, int] = (80, 100)) -> DataFrame:
    """The rows of ``docs`` without all but one document of each group; of rows with one id, one stays."""
    judged = near_duplicates(docs, width=width, percent=percent)
    kept = judged.where("kept").groupBy("doc_id").agg(F.min("key").alias("key")).where("doc_id is not null")
    names = docs.columns
    keyed = docs.select(*[F.col(c).alias(f"c{i}") for i, c in enumerate(names)], F.col("doc_id").cast("long").alias("id"), text_key().alias("key"))
    found = keyed.where("id is not null").join(kept.withColumnsRenamed({"doc_id": "id"}), ["id", "key"]).dropDuplicates(["id", "key"])
    loose = keyed.where("id is null")
    return found.unionByName(loose).select(*[F.col(f"c{i}").alias(c) for i, c in enumerate(names)])

"""N-gram Jaccard join and its groups: a size-aware heavy-light join of shingle sets.

A document's set holds its distinct 5-word shingles.  Equal sets are one class
with one 64-bit digest; the join runs over classes.

1. *Shared shingles.*  Every task sends the shingles of its classes, packed in
   binary blocks of five bytes each, to the partition of the shingle's first
   bits.  There the shingles of at least two classes are found with the number
   of classes that hold them, and go back to their classes.  Two sets can only
   share such shingles, so a class whose shared shingles are fewer than 80 % of
   its set links with nothing; most documents end here.
2. *Keys.*  Shared shingles are ordered rarest first; two linking sets share one
   of the first ``shared - ceil(0.8 n) + 1`` (prefix filter).  Small sets (up to a
   boundary) enumerate the 2-subsets of the prefix one longer, and meet where
   they share a whole subset; large sets meet in the inverted lists of single
   shingles.  The boundary is the power of two with the least summed cost:
   subsets made for small sets; for large ones list entries made, and entries
   scanned, as an entry of a set's prefix scans its whole list in a tile.  Sets from 80 % of the boundary on
   take part in the lists too, so pairs across the boundary are not lost.
3. *Scan.*  First the sets meet in the lists of their ``FIRST_KEYS`` rarest shared
   shingles, each with one hub of the list, the set with the smallest unshared
   part; verified links merge into components.  Then all keys are made, and the
   lists that still span several components are put together by their member with
   the least hash: lists of one group of near copies mostly have the same, so a set
   travels once for many lists.  The members are cut into blocks of about
   ``BLOCK_CODES`` shingles; a tile of two blocks finds all intersections of its
   sets by an inverted index, links those at 80 % and returns only links that
   connect what was apart (at most one less than its sets).  Pairs are never rows.
   Pairs within a component need no check: components, not links, are the result.

Verification intersects the shared shingles, which hold the whole
intersection; a shingle is known by 46 bits of its hash there (equality of two
different shingles within a pair: below 1e-8 for 600 shingles).

Defined results: null, empty and blank texts have an empty set, link with
nothing and are their own component; so are rows with a null id (component
null).  Repeated rows share a component.  Very long texts are whole.
"""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from modenorm.llm.common import U64, mix64, narrow, staged, text_slices, tidy, tidy_group
from modenorm.llm.components import components

SHINGLE = 5
#: links need 100 * intersection >= PCT * union
PCT = 80
SLICE_BYTES = 2 << 20
#: shingles a partition of the first exchange holds about
PARTITION_SHINGLES = 2_000_000
CODE_BITS = 46
#: lists of a set where it first meets hubs
FIRST_KEYS = 3
#: cost of scanning a list entry in a tile, where making an entry or a subset (a row to shuffle) costs 1
SCAN_COST = 0.001
#: shingles of a block of sets, about, and of the tiles that a task checks in one call
BLOCK_CODES = 500_000
CALL_CODES = 1_000_000


def shingle_sets(texts: list[str | None]) -> list[np.ndarray]:
    """Sorted distinct shingle hashes of each text."""
    digest = xxhash.xxh3_64_intdigest
    words = [t.encode().lower().split() if t else [] for t in texts]
    sizes = np.array([len(w) for w in words])
    flat = np.fromiter((h for ws in words for h in map(digest, ws)), U64, int(sizes.sum()))
    if len(flat) >= SHINGLE:
        rolled = flat[:len(flat) - SHINGLE + 1].copy()
        for j in range(1, SHINGLE):
            rolled *= U64(0x9E3779B97F4A7C15)
            rolled += flat[j:len(flat) - SHINGLE + 1 + j]
        rolled = mix64(rolled)
    out, at = [], 0
    for ws, n in zip(words, sizes.tolist()):
        if n >= SHINGLE:
            out.append(np.unique(rolled[at:at + n - SHINGLE + 1]))
        elif n:
            out.append(np.array([digest(b" ".join(ws), seed=n)], U64))
        else:
            out.append(np.zeros(0, U64))
        at += n
    return out


def set_digest(s: np.ndarray) -> int:
    """Signed 64-bit digest of a set."""
    return xxhash.xxh3_64_intdigest(s.tobytes()) - (1 << 63)


def set_sizes(docs: DataFrame) -> DataFrame:
    """``doc_id, n, digest`` of every document."""
    def run(batches):
        for b in batches:
            for i, j, texts in text_slices(b, 1, SLICE_BYTES):
                sets = shingle_sets(texts)
                yield pa.RecordBatch.from_arrays(
                    [b.column(0).slice(i, j - i), pa.array([len(s) for s in sets], pa.int64()),
                     pa.array([set_digest(s) for s in sets], pa.int64())], names=["doc_id", "n", "digest"])

    return docs.mapInArrow(tidy(run), "doc_id long, n long, digest long")


def shared_shingles(docs: DataFrame, bits: int) -> DataFrame:
    """``digest, n, codes`` of the classes that share shingles: codes are (classes, shingle bits), rarest first."""
    low = CODE_BITS - bits  # bits of a code that the partition number doesn't tell

    def send(batches):
        seen: set[int] = set()
        for b in batches:
            for _, _, texts in text_slices(b, 1, SLICE_BYTES):
                new = {}
                for s in shingle_sets(texts):
                    if len(s) and (d := set_digest(s)) not in seen:
                        seen.add(d)
                        new[d] = s
                if not new:
                    continue
                sizes = np.array([len(s) for s in new.values()])
                codes = np.concatenate(list(new.values())) >> U64(64 - CODE_BITS)
                part = (codes >> U64(low)).astype(np.int32)
                order = np.argsort(part, kind="stable")
                owner = np.repeat(np.arange(len(new)), sizes)[order]
                tails = codes[order].view(np.uint8).reshape(-1, 8)[:, :5]
                cuts = np.flatnonzero(np.diff(part[order], prepend=-1))
                digests = np.array(list(new), np.int64)
                blocks, parts = [], []
                for p, q in zip(cuts, np.append(cuts[1:], len(order))):
                    own, count = np.unique(owner[p:q], return_counts=True)
                    blocks.append(np.array([len(own)], np.int64).tobytes() + digests[own].tobytes()
                                  + sizes[own].astype(np.int32).tobytes() + count.astype(np.int32).tobytes()
                                  + tails[p:q].tobytes())
                    parts.append(int(part[order[p]]))
                yield pa.RecordBatch.from_arrays([pa.array(parts, pa.int32()), pa.array(blocks, pa.binary())],
                                                 names=["part", "block"])

    def meet(table: pa.Table) -> pa.Table:
        part = table.column("part")[0].as_py()
        digests, sizes, owners, tails, held = [], [], [], [], 0
        for chunk in table.column("block").chunks:
            for block in chunk:
                data = memoryview(block.as_buffer())
                k = int(np.frombuffer(data, np.int64, 1)[0])
                digests.append(np.frombuffer(data, np.int64, k, 8))
                sizes.append(np.frombuffer(data, np.int32, k, 8 + 8 * k))
                count = np.frombuffer(data, np.int32, k, 8 + 12 * k)
                owners.append(np.repeat(np.arange(held, held + k, dtype=np.int32), count))
                tails.append(np.frombuffer(data, np.uint8, offset=8 + 16 * k).reshape(-1, 5))
                held += k
        digests, sizes, owner = np.concatenate(digests), np.concatenate(sizes), np.concatenate(owners)
        wide = np.zeros((len(owner), 8), np.uint8)
        wide[:, :5] = np.concatenate(tails)
        code = (wide.view(U64)[:, 0] & U64((1 << low) - 1)) | U64(part << low)
        order = np.argsort(code)
        code, owner = code[order], owner[order]
        same = code[1:] == code[:-1]
        shared = np.append(same, False) | np.append(False, same)
        code, owner = code[shared], owner[shared]
        # one entry for each class: the same class may come from several tasks
        digest = digests[owner]
        order = np.lexsort((digest, code))
        code, digest, size = code[order], digest[order], sizes[owner[order]]
        first = np.append(True, (code[1:] != code[:-1]) | (digest[1:] != digest[:-1]))[:len(code)]
        code, digest, size = code[first], digest[first], size[first]
        starts = np.flatnonzero(np.append(True, code[1:] != code[:-1])[:len(code)])
        classes = np.diff(np.append(starts, len(code)))
        classes = np.repeat(classes, classes)
        keep = classes > 1
        code = (np.minimum(classes[keep], 65535).astype(U64) << U64(CODE_BITS)) | code[keep]
        digest, size = digest[keep], size[keep]
        order = np.argsort(digest, kind="stable")
        code, digest, size = code[order], digest[order], size[order]
        starts = np.flatnonzero(np.append(True, digest[1:] != digest[:-1])[:len(digest)])
        offsets = pa.array(np.append(starts, len(digest)).astype(np.int32))
        return pa.table({"digest": pa.array(digest[starts]), "n": pa.array(size[starts].astype(np.int64)),
                         "codes": pa.ListArray.from_arrays(offsets, pa.array(code.astype(np.int64)))})

    met = (docs.mapInArrow(tidy(send), "part int, block binary").groupBy("part")
           .applyInArrow(tidy_group(meet), "digest long, n long, codes array<long>"))
    return met.groupBy("digest", "n").agg(F.expr("sort_array(flatten(collect_list(codes))) AS codes"))


def boundary(sets: DataFrame) -> int:
    """Largest size of a small set: the power of two with the least cost (0: none is small)."""
    costs = sets.groupBy(F.expr("CAST(ceil(log2(n)) AS INT) AS size_class")).agg(
        F.sum(F.expr("CAST(q AS DOUBLE) * (q + 1) / 2")).alias("subsets"),
        F.sum(F.expr(f"aggregate(slice(codes, 1, CAST(q AS INT)), 0D, (a, c) -> a + 1 + {SCAN_COST}D * shiftright(c, {CODE_BITS}))"))
        .alias("scanned")).collect()  # one row for each power of two
    best = min(range(-1, 1 + max([c.size_class for c in costs], default=-1)), key=lambda k: sum(
        c.subsets if c.size_class <= k else c.scanned for c in costs))
    return 1 << best if best >= 0 else 0


def list_entries(sets: DataFrame, limit: int) -> DataFrame:
    """``key, digest, comp, size``: where each set meets others; keys are subsets of small sets, shingles of large ones."""
    base = sets.selectExpr("digest", "n", "q", "codes", "comp", "size(codes) AS size")
    small = base.where(f"n <= {limit}").selectExpr(
        "digest", "comp", "size",
        "explode(IF(n = 1, array(codes[0]), flatten(transform(sequence(1, CAST(q AS INT)), "
        "i -> transform(slice(codes, i + 1, CAST(q + 1 - i AS INT)), c -> xxhash64('pair', codes[i - 1], c)))))) AS key")
    large = base.where(f"n * 100 >= {PCT} * {limit}").selectExpr(
        "digest", "comp", "size", "explode(slice(codes, 1, CAST(q AS INT))) AS key")
    return small.unionByName(large)


SHARE = "CAST((n - size(codes)) * 1000000 DIV n AS LONG) AS share"


def possible(a: str, b: str) -> str:
    """SQL: may the sets of two list entries link, by size and by what can still be common?"""
    both = f"({a}.n + {b}.n)"
    return (f"least({a}.n, {b}.n) * 100 >= {PCT} * greatest({a}.n, {b}.n) "
            f"AND least({a}.rest, {b}.rest) * {100 + PCT} >= {PCT} * {both}")


def verified_hubs(pairs: DataFrame, sets: DataFrame) -> DataFrame:
    """The pairs ``a, b`` of digests that link, for some pairs a set: both sets join each pair."""
    left = sets.selectExpr("digest AS a", "n AS na", "codes AS ca")
    right = sets.selectExpr("digest AS b", "n AS nb", "codes AS cb")
    both = pairs.join(left, "a").join(right, "b").selectExpr(
        "a", "b", "na + nb AS total", "CAST(size(array_intersect(ca, cb)) AS LONG) AS common")
    return both.where(f"100 * common >= {PCT} * (total - common)").select("a", "b")


def hub_pairs(entries: DataFrame, order: str) -> DataFrame:
    """Pairs of each list's hub, the member first in ``order``, with its other members."""
    hubs = entries.groupBy("key").agg(F.min(F.expr(f"struct({order}, digest, n, rest)")).alias("hub"),
                                      F.count("*").alias("held")).where("held > 1").select("key", "hub").alias("y")
    return (entries.alias("x").join(hubs, F.expr("x.key = y.key AND x.digest <> y.hub.digest AND " + possible("x", "y.hub")))
            .selectExpr("least(x.digest, y.hub.digest) AS a", "greatest(x.digest, y.hub.digest) AS b"))


def meeting_groups(entries: DataFrame) -> DataFrame:
    """``grp, digest, comp, size``: the members of all lists that span components, by the member with the least hash."""
    lists = entries.groupBy("key").agg(F.min("comp").alias("lo"), F.max("comp").alias("hi"),
                                       F.min_by("digest", F.xxhash64("digest")).alias("grp"))
    return entries.join(lists.where("lo <> hi"), "key").select("grp", "digest", "comp", "size").distinct()


def tiles(members: DataFrame) -> DataFrame:
    """``tile, call, side, digest, comp``: each member once for every tile of two blocks that it is in.

    ``side``: 0 the first block, 1 the second, 2 both (a tile of one block).  ``call`` puts small tiles together.
    """
    groups = members.groupBy("grp").agg(F.sum("size").alias("codes"))
    groups = groups.selectExpr("grp", f"CAST(greatest(1, ceil(codes / {BLOCK_CODES}.0D)) AS INT) AS blocks", "codes")
    calls = max(1, math.ceil((groups.agg(F.sum("codes")).first()[0] or 0) / CALL_CODES))
    placed = members.join(groups, "grp").selectExpr("grp", "digest", "comp", "blocks", "pmod(xxhash64(digest, 7), blocks) AS own")
    return placed.selectExpr(
        "grp", "digest", "comp", "blocks", "own", "explode(sequence(0, blocks - 1)) AS other").selectExpr(
        "digest", "comp", "IF(own = other, 2, IF(own < other, 0, 1)) AS side",
        "xxhash64(grp, least(own, other), greatest(own, other)) AS tile",
        f"IF(blocks = 1, pmod(xxhash64(grp), {calls}L), xxhash64(grp, least(own, other), greatest(own, other))) AS call")


def tile_links(comp: np.ndarray, n: np.ndarray, side: np.ndarray, flat: np.ndarray, bounds: np.ndarray) -> list[tuple[int, int]]:
    """Links between the sets of one tile that connect different components: a forest.

    Every set of the first block is counted against all of the second, by an inverted index of the second.
    """
    right = np.flatnonzero(side != 0)
    size = bounds[1:] - bounds[:-1]
    count = size[right]
    take = np.repeat(bounds[right] - (np.cumsum(count) - count), count) + np.arange(count.sum())
    owner = np.repeat(np.arange(len(right)), count)
    codes = flat[take]
    order = np.argsort(codes, kind="stable")
    codes, owner = codes[order], owner[order]
    heads = np.flatnonzero(np.append(True, codes[1:] != codes[:-1])[:len(codes)])
    keys, ends = codes[heads], np.append(heads[1:], len(codes))
    label = comp.copy()
    n_right, out = n[right], []
    for x in np.flatnonzero(side != 1).tolist():
        apart = (label[right] != label[x]) & (100 * np.minimum(n_right, n[x]) >= PCT * np.maximum(n_right, n[x]))
        if not apart.any():
            continue
        mine = flat[bounds[x]:bounds[x + 1]]
        at = np.minimum(np.searchsorted(keys, mine), len(keys) - 1)
        at = at[keys[at] == mine]
        held = ends[at] - heads[at]
        met = owner[np.repeat(heads[at] - (np.cumsum(held) - held), held) + np.arange(held.sum())]
        common = np.bincount(met, minlength=len(right))
        for y in right[apart & (100 * common >= PCT * (n_right + n[x] - common))].tolist():
            if label[y] != label[x]:
                out.append((x, y))
                label[label == label[y]] = label[x]
    return out


def check_tiles(table: pa.Table) -> pa.Table:
    """The links that the tiles of one call add."""
    table = table.sort_by("tile").combine_chunks()
    digest, tile, comp, n, side = (table.column(c).to_numpy() for c in ("digest", "tile", "comp", "n", "side"))
    codes = table.column("codes").combine_chunks()
    codes = codes.chunk(0) if isinstance(codes, pa.ChunkedArray) else codes
    flat, bounds = codes.values.to_numpy(), codes.offsets.to_numpy().astype(np.int64)
    cuts = np.append(np.flatnonzero(np.append(True, tile[1:] != tile[:-1])[:len(tile)]), len(tile))
    out = []
    for i, j in zip(cuts[:-1].tolist(), cuts[1:].tolist()):
        out += [(digest[i + x], digest[i + y]) for x, y in
                tile_links(comp[i:j], n[i:j], side[i:j], flat, bounds[i:j + 1])]
    return pa.table({"a": pa.array([int(min(r)) for r in out], pa.int64()), "b": pa.array([int(max(r)) for r in out], pa.int64())})


def links_to_components(sets: DataFrame) -> DataFrame:
    """``node, component`` of all classes that link with another."""
    spark = sets.sparkSession
    first = (sets.selectExpr("digest", "n", SHARE, "size(codes) AS m",
                             f"posexplode(slice(codes, 1, CAST(least(q, {FIRST_KEYS}) AS INT))) AS (i, key)")
             .selectExpr("key", "digest", "n", "share", "m - i AS rest"))
    edges = staged(spark, verified_hubs(hub_pairs(first, "share").distinct(), sets), "jaccard-links")
    groups = components(edges)
    named = (sets.join(groups, F.col("digest") == F.col("node"), "left")
             .withColumn("comp", F.coalesce("component", "digest")).select(*sets.columns, "comp"))
    members = staged(spark, meeting_groups(list_entries(named, boundary(sets))), "jaccard-members")
    rows = tiles(members).join(sets.select("digest", "n", "codes"), "digest")
    new = staged(spark, rows.groupBy("call").applyInArrow(tidy_group(check_tiles), "a long, b long"), "jaccard-links")
    return groups if new.isEmpty() else components(edges.unionByName(new))


def group(df: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``doc_id, n_shingles, component_id`` of every row."""
    spark = df.sparkSession
    docs = narrow(df, id_col, text_col)
    members = staged(spark, set_sizes(docs), "jaccard-sizes")
    total = members.agg(F.sum("n")).first()[0] or 0
    bits = min(32, max(6, math.ceil(math.log2(max(1, total / PARTITION_SHINGLES)))))
    need = f"CAST(ceil({PCT} * n / 100D) AS LONG)"
    sets = staged(spark, shared_shingles(docs, bits).where(f"size(codes) >= {need}")
                  .withColumn("q", F.expr(f"size(codes) - {need} + 1")), "jaccard-sets")
    groups = links_to_components(sets)
    firsts = members.where("n > 0").groupBy("digest").agg(F.min("doc_id").alias("first"))
    named = firsts.join(groups, F.col("digest") == F.col("node"), "left").withColumn(
        "component", F.coalesce("component", "digest"))
    smallest = named.groupBy("component").agg(F.min("first").alias("component_id"))
    by_class = named.join(smallest, "component").select("digest", "component_id")
    return (members.join(by_class, "digest", "left")
            .select("doc_id", F.col("n").alias("n_shingles"),
                    F.when((F.col("n") > 0) & F.col("doc_id").isNotNull(), F.col("component_id"))
                    .otherwise(F.col("doc_id")).alias("component_id")))

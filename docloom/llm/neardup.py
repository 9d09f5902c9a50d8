"""MinHash near-duplicates: SuperMinHash signatures, banding, verification on full sets, union-find groups.

1. Each document gets its shingle count, a 128-bit key of its whole shingle set and the band keys of its
   SuperMinHash signature. Documents with equal sets are one class, told by its smallest doc_id.
2. Classes that share a band join a candidate cluster (min-label propagation with pointer jumping over
   star edges class -> smallest class of the band; no pair is emitted inside a band).
3. Clusters are verified on full shingle sets inside tasks, with union-find, so only a spanning forest of
   confirmed links leaves a task; in a block, members meet through their rarest shingles alone, which loses
   no link. A cluster over ``block_shingles`` shingles or ``block_members`` classes is cut in hash blocks, to
   each of which the same few seed classes are added; then only classes outside the cluster's largest
   confirmed component still meet all blocks. Every pair of a cluster is so either tested, ruled out by its
   rarest shingles or sizes, or already connected: no cap, no drop. Blocks bound a task; a cluster of R blocks'
   outsiders and B blocks costs R x B tasks.
4. Components of the confirmed links are joined back to all documents.

Links: 100 * |A & B| >= percent * |A | B|. With 32 bands of 5 ranks a pair at similarity 0.8 shares no band
with probability 3e-6. Intersections are counted on 64-bit shingle hashes, mixed from 64-bit word hashes that depend
on every byte of a word (see words.py): two different shingles of a pair of texts of 10,000 words count as one with
probability below 1e-11. Set equality is that of a 128-bit hash of the sorted shingle hashes.

Defined results: null text and texts without words have the empty set, are linked with nothing and are kept;
rows with null doc_id are linked with nothing, have a null component and are kept; very long texts take part whole,
one being a block of its own if need be; repeated rows have equal sets, and of documents with equal sets (ties) the
smallest doc_id stands for all; texts that share one doc_id are told as that document's, and a link of one of them is
its link; an empty table gives an empty result; other columns, whatever their names, are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from docloom.llm.common import MASK, drop_table, materialize, mix64, shingle_hashes, ship, written
from docloom.llm.words import Spans, buffers, spread

_U = np.uint64
_GAMMA = _U(0x9E3779B97F4A7C15)


# --- signatures ---------------------------------------------------------------------------------------


def superminhash(sets: list[np.ndarray], m: int) -> np.ndarray:
    """SuperMinHash signatures (one row of ``m`` floats a set) of nonempty sets of 64-bit hashes.

    Element e walks a random permutation of the m places; at step j it offers j + r (0 <= r < 1) to the
    place it reaches. All sets take step j together; a set stops before step j once all its values are
    below j, as no later offer can be smaller: the values equal those of the element-by-element walk.
    """
    rows = len(sets)
    sig = np.full((rows, m), np.inf)
    elements = np.concatenate(sets) if rows else np.zeros(0, np.uint64)
    owner = np.repeat(np.arange(rows), [len(s) for s in sets])
    walk: np.ndarray | None = None
    for j in range(m):
        x = mix64(elements + _U((j + 1) * int(_GAMMA) & MASK))
        value = (x >> _U(11)).astype(np.float64) * 2.0**-53 + j
        k = j + ((mix64(x) >> _U(32)) * _U(m - j) >> _U(32)).astype(np.int64)
        if j == 0:
            place = k
        else:
            at = np.arange(len(elements))
            place = walk[at, k].astype(np.int64)
            walk[at, k] = walk[at, j]
            walk[at, j] = place
        np.minimum.at(sig.reshape(-1), owner * m + place, value)
        live = sig.max(axis=1) >= j + 1
        on = live[owner]
        if not on.any():
            break
        if walk is None:
            elements, owner, k = elements[on], owner[on], k[on]
            walk = np.tile(np.arange(m, dtype=np.uint16), (len(elements), 1))
            walk[np.arange(len(elements)), k] = 0
            walk[:, 0] = k
        elif not on.all():
            elements, owner, walk = elements[on], owner[on], walk[on]
    return sig


def _runs(sets: list[np.ndarray], most: int) -> Iterator[list[np.ndarray]]:
    """Consecutive sets, together of about ``most`` elements or one set."""
    run, n = [], 0
    for s in sets:
        if run and n + len(s) > most:
            yield run
            run, n = [], 0
        run.append(s)
        n += len(s)
    if run:
        yield run


def signatures(docs: DataFrame, words: int, bands: int, ranks: int) -> DataFrame:
    """doc_id, n_shingles, set key (two longs) and band keys of whole texts, words folded from A-Z to a-z."""
    ship(docs.sparkSession)
    m = bands * ranks

    def sign(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            counts, keys, found = [], [], []
            for _, data, offsets in buffers(batch.column(1)):
                spans = Spans(data, offsets)
                h, first = spans.hashes(), spans.first.tolist()
                sets = [shingle_hashes(h[a:b], words) for a, b in zip(first[:-1], first[1:])]
                counts += [len(s) for s in sets]
                keys += [xxhash.xxh3_128_digest(s.tobytes()) if len(s) else None for s in sets]
                for run in _runs([s for s in sets if len(s)], 65_536):
                    found += _band_keys(superminhash(run, m), bands)
            ints = [np.frombuffer(k, "<i8").tolist() if k else [None, None] for k in keys]
            each = iter(found)
            bands_of = [next(each) if k else None for k in keys]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(counts, pa.int64()), pa.array([x[0] for x in ints], pa.int64()), pa.array([x[1] for x in ints], pa.int64()), pa.array(bands_of, pa.list_(pa.int64()))],
                names=["doc_id", "n_shingles", "key_a", "key_b", "bands"],
            )

    return docs.select(F.col("doc_id").cast("long"), "text").mapInArrow(sign, "doc_id long, n_shingles long, key_a long, key_b long, bands array<long>")


def _band_keys(sig: np.ndarray, bands: int) -> list[np.ndarray]:
    """One 64-bit key for each band: equal only for equal ranks of the same band."""
    bits = sig.view(np.uint64).reshape(len(sig), bands, -1)
    key = np.broadcast_to(np.arange(1, bands + 1, dtype=np.uint64) * _GAMMA, bits.shape[:2]).copy()
    for i in range(bits.shape[2]):
        key = mix64(key ^ bits[:, :, i]) + _U(i)
    return list(key.view(np.int64))


# --- components ---------------------------------------------------------------------------------------


def components(edges: DataFrame, label: str = "component") -> DataFrame:
    """(id, smallest id reachable) for every id of ``edges`` (a, b), by hooking and pointer jumping.

    Each round joins every node to the smallest label near it and then to that label's label; rounds are
    written tables, each dropped once the next is there, so neither lineage, the driver nor the folder grows.
    Ends when a round changes nothing.
    """
    spark = edges.sparkSession
    pairs, pairs_at = written(edges.select(F.col("a"), F.col("b")).union(edges.select(F.col("b"), F.col("a"))).where("a <> b").distinct(), "edges")
    now, now_at = written(pairs.groupBy(F.col("a").alias("id")).agg(F.min("b").alias("near")).select("id", F.least("id", "near").alias("root")), "labels")
    while True:
        # the smallest root among neighbours
        seen = pairs.join(now.select(F.col("id").alias("b"), F.col("root").alias("r")), "b").groupBy(F.col("a").alias("id")).agg(F.min("r").alias("r"))
        hooked = now.join(seen, "id").select("id", "root", F.least("root", "r").alias("best"))
        # a root follows the smallest root that any of its members sees
        by_root = hooked.groupBy(F.col("root").alias("old")).agg(F.min("best").alias("to"))
        stepped, stepped_at = written(hooked.join(by_root, hooked["root"] == by_root["old"]).select("id", F.col("root").alias("was"), F.least("best", "to").alias("root")), "hooked")
        drop_table(spark, now_at)
        jump = stepped.select(F.col("id").alias("root"), F.col("root").alias("up"))
        now, now_at = written(stepped.join(jump, "root", "left").select("id", "was", F.least("root", F.coalesce("up", "root")).alias("root")), "labels")
        drop_table(spark, stepped_at)
        if not now.where("root <> was").limit(1).count():
            drop_table(spark, pairs_at)
            return now.select("id", F.col("root").alias(label))
        now = now.select("id", "root")


# --- verification inside a task -----------------------------------------------------------------------


class _Groups:
    """Union-find over 0 .. n - 1 with a label for each member, so that groups of many members are read at once.

    The smaller group takes the larger's label: at most n log n labels change in all.
    """

    def __init__(self, n: int):
        self.label, self.members = np.arange(n), {}

    def join(self, x: int, y: int) -> None:
        x, y = int(self.label[x]), int(self.label[y])
        a, b = self.members.get(x, [x]), self.members.get(y, [y])
        if len(a) < len(b):
            x, y, a, b = y, x, b, a
        self.label[b] = x
        if isinstance(a, list):
            a.extend(b)
        self.members[x] = a
        self.members.pop(y, None)


def _forest(ids: np.ndarray, sets: list[np.ndarray], percent: int, left: np.ndarray, right: np.ndarray) -> list[tuple[int, int]]:
    """A spanning forest of the links between ``left`` and ``right`` members, confirmed on full sets.

    Shingles are put in order of how many members have them. Two sets can only link if they share one of their
    rarest n - ceil(percent * n / 100) + 1 shingles each, so a member meets those alone that do, largest sets first,
    whose sizes allow a link and with which it is not yet connected; few at first, as one link often settles the rest.
    """
    n = len(ids)
    sizes = np.fromiter(map(len, sets), np.int64, n)
    if n == 2:
        both = len(np.intersect1d(sets[0], sets[1], assume_unique=True))
        return [(int(ids[0]), int(ids[1]))] if 100 * both >= percent * (sizes.sum() - both) else []
    _, flat, had = np.unique(np.concatenate(sets), return_inverse=True, return_counts=True)
    rank = np.empty(len(had), np.int64)
    rank[np.argsort(had, kind="stable")] = np.arange(len(had))
    flat = rank[flat]  # rare shingles have small numbers
    begin = np.concatenate(([0], np.cumsum(sizes)))
    owner = np.repeat(np.arange(n), sizes)
    flat = flat[np.lexsort((flat, owner))]
    prefix = sizes - -(-percent * sizes // 100) + 1
    # members by shingle of their prefixes, for the right side
    at = np.arange(len(flat)) - np.repeat(begin[:-1], sizes)
    on = (at < np.repeat(prefix, sizes)) & np.repeat(right, sizes)
    keys, who = flat[on], owner[on]
    order = np.argsort(keys, kind="stable")
    keys, who = keys[order], who[order]
    marked, groups, forest = np.zeros(len(had), np.uint8), _Groups(n), []
    for i in np.argsort(-sizes, kind="stable"):
        if not left[i]:
            continue
        own = flat[begin[i] : begin[i + 1]]
        some = own[: prefix[i]]
        lows, highs = np.searchsorted(keys, some, "left"), np.searchsorted(keys, some, "right")
        others = np.unique(who[spread(lows, highs - lows)])
        others = others[(groups.label[others] != groups.label[i]) & (100 * np.minimum(sizes[others], sizes[i]) >= percent * np.maximum(sizes[others], sizes[i]))]
        if not len(others):
            continue
        others = others[np.argsort(-sizes[others], kind="stable")]
        marked[own] = 1
        step = 4
        while len(others):
            now, others = others[:step], others[step:]
            hits = marked[flat[spread(begin[now], sizes[now])]]
            both = np.add.reduceat(hits, np.concatenate(([0], np.cumsum(sizes[now])[:-1])), dtype=np.int64)
            linked = now[100 * both >= percent * (sizes[i] + sizes[now] - both)]
            for o in linked:
                if groups.label[o] != groups.label[i]:
                    groups.join(int(i), int(o))
                    forest.append((int(ids[i]), int(ids[o])))
            if len(linked):
                others = others[groups.label[others] != groups.label[i]]
            step = min(512, 2 * step)
        marked[own] = 0
    return forest


def _verify(rows: DataFrame, words: int, percent: int) -> DataFrame:
    """Confirmed links (a, b) of blocks: ``rows`` has block (string), id, text and side (1 left, 2 right, 3 both)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        block, ids, sets, sides = None, [], [], []

        def close() -> list[tuple[int, int]]:
            if len(ids) < 2:
                return []
            side = np.array(sides)
            return _forest(np.array(ids, np.int64), sets, percent, (side & 1) > 0, (side & 2) > 0)

        for batch in batches:
            links: list[tuple[int, int]] = []
            names, keys, marks = (batch.column(c).to_pylist() for c in ("block", "id", "side"))
            for at, data, offsets in buffers(batch.column("text")):
                spans = Spans(data, offsets)
                h, first = spans.hashes(), spans.first.tolist()
                for r in range(len(offsets) - 1):
                    if names[at + r] != block:
                        links += close()
                        block, ids, sets, sides = names[at + r], [], [], []
                    ids.append(keys[at + r])
                    sides.append(marks[at + r])
                    sets.append(shingle_hashes(h[first[r] : first[r + 1]], words))
            yield _links(links)
        yield _links(close())

    def _links(found: list[tuple[int, int]]) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array([x[k] for x in found], pa.int64()) for k in (0, 1)], names=["a", "b"])

    sent = rows.select("block", "id", "text", "side").repartition("block").sortWithinPartitions("block", "id")
    return sent.mapInArrow(run, "a long, b long")


def near_duplicates(docs: DataFrame, words: int = 5, percent: int = 80, bands: int = 32, ranks: int = 5, block_shingles: int = 6_000_000, block_members: int = 50_000, seeds: int = 64) -> DataFrame:
    """One row a document: doc_id, n_shingles, component_id (smallest doc_id reachable), kept."""
    signed = materialize(signatures(docs, words, bands, ranks), "signatures")
    full = signed.where("n_shingles > 0 and doc_id is not null")
    classes = materialize(full.groupBy("key_a", "key_b").agg(F.min("doc_id").alias("id")), "classes")
    texts = docs.select(F.col("doc_id").cast("long").alias("id"), "text")

    # candidate clusters: star edges from each member of a band to the band's smallest class
    keyed = full.withColumnRenamed("doc_id", "id")
    member = keyed.join(classes, ["id", "key_a", "key_b"], "left_semi").select("id", F.explode("bands").alias("band"))
    least = member.groupBy("band").agg(F.min("id").alias("low"), F.max("id").alias("high")).where("low < high").select("band", "low")
    stars = member.join(least, "band").where("id <> low").select(F.col("id").alias("a"), F.col("low").alias("b"))
    cluster = components(stars, "cluster")

    sized = materialize(cluster.join(signed.select(F.col("doc_id").alias("id"), "n_shingles").groupBy("id").agg(F.max("n_shingles").alias("n")), "id"), "clustered")
    totals = sized.groupBy("cluster").agg(F.sum("n").alias("n"), F.count(F.lit(1)).alias("size"))
    totals = totals.withColumn("blocks", F.greatest(F.ceil(F.col("n") / F.lit(block_shingles)), F.ceil(F.col("size") / F.lit(block_members))).cast("int"))
    dealt = materialize(
        sized.select("id", "cluster")
        .join(totals.select("cluster", "blocks", "size"), "cluster")
        .withColumn("part", F.pmod(F.xxhash64("id"), F.col("blocks")).cast("int"))
        .withColumn("seed", (F.col("blocks") > 1) & (F.pmod(F.xxhash64("id", F.lit(7)), F.col("size")) < seeds)),
        "dealt",
    )
    own = dealt.select("id", F.concat_ws(":", "cluster", "part").alias("block"), F.lit(3).alias("side"))
    every = dealt.where("seed").select("id", "cluster", "part", F.explode(F.expr("sequence(0, blocks - 1)")).alias("to")).where("part <> to")
    extra = every.select("id", F.concat_ws(":", "cluster", "to").alias("block"), F.lit(3).alias("side"))
    content = materialize(texts.join(dealt.select("id"), "id", "left_semi").distinct(), "texts")
    links = materialize(_verify(own.unionByName(extra).join(content, "id"), words, percent), "links")

    if dealt.where("blocks > 1").limit(1).count():
        links = _outsiders(dealt, content, links, words, percent)
    by_class = classes.join(components(links), "id", "left").select("key_a", "key_b", F.coalesce("component", "id").alias("component_id"))
    told = full.join(by_class, ["key_a", "key_b"]).select("doc_id", "n_shingles", "component_id")
    # rows without a set or an id are linked with nothing: no join on their null keys
    alone = signed.where("not (n_shingles > 0 and doc_id is not null)").select("doc_id", "n_shingles", F.col("doc_id").alias("component_id"))
    return told.unionByName(alone).withColumn("kept", F.coalesce(F.col("doc_id") == F.col("component_id"), F.lit(True)))


def _outsiders(dealt: DataFrame, content: DataFrame, links: DataFrame, words: int, percent: int) -> DataFrame:
    """Links of the second round: classes outside their cluster's largest component against all its blocks."""
    found = components(links)
    placed = dealt.where("blocks > 1").join(found, "id", "left").withColumn("component", F.coalesce("component", "id"))
    placed = materialize(placed, "placed")
    sizes = placed.groupBy("cluster", "component").count()
    main = sizes.groupBy("cluster").agg(F.max(F.struct("count", "component")).alias("m")).select("cluster", F.col("m.component").alias("main"))
    placed = placed.join(main, "cluster").withColumn("outside", F.col("component") != F.col("main"))
    fewer = placed.groupBy("cluster").agg(F.sum(F.col("outside").cast("long")).alias("n"), F.max("size").alias("all"), F.max("blocks").alias("k"))
    fewer = fewer.where("n > 0").select("cluster", F.greatest(F.lit(1), F.ceil(F.col("n") * F.col("k") / F.col("all"))).cast("int").alias("groups"))
    placed = placed.join(fewer, "cluster")
    group = F.pmod(F.xxhash64("id", F.lit(3)), F.col("groups")).cast("int")
    left = placed.where("outside").select("id", "cluster", group.alias("g"), F.explode(F.expr("sequence(0, blocks - 1)")).alias("p"), F.lit(1).alias("side"))
    right = placed.select("id", "cluster", F.explode(F.expr("sequence(0, groups - 1)")).alias("g"), F.col("part").alias("p"), F.lit(2).alias("side"))
    rows = left.unionByName(right).groupBy("id", F.concat_ws(":", "cluster", "g", "p").alias("block")).agg(F.sum("side").cast("int").alias("side"))
    more = materialize(_verify(rows.join(content, "id"), words, percent), "links")
    return links.unionByName(more)

"""Mixing sources to target weights by a low-discrepancy schedule over shuffled equal-token blocks.

1. A source's documents stand on a tape in keyed shuffled order, again and again up to ``most`` times. The tape is
   cut in blocks of equal words.
2. Targets: weights share all words; a source stops at ``most`` times its size and the excess is shared again by
   weight (on the driver, one row a source; sources are taken to be thousands at most).
3. The mix has as many slots as blocks fill all words. Slot i's golden-ratio point frac((i + 1) / phi), exact in 62
   bits, falls into one source's share of the cumulative targets. Slots are ranked per source, in chunks, so no task
   holds a source's slots; the slot with rank r plays block r of its source's tape.
4. A document's words in the mix are those of its words that slots play. So a source's words come from its slots: by
   the points' discrepancy they stay within a few blocks of its target, in every stretch of the mix as in the whole. A
   block has at most ``block`` words, fewer where all words would not fill ``least_slots`` slots, so the few blocks
   weigh little at any size. Slots beyond a tape's end (``most`` times through) play nothing.

Equal rows are counted first and stand side by side on the tape, so repeated rows are not one task's work, and
results depend on the rows alone, not on how they are split. A tape's order is that of a keyed digest of id and text.

Defined results: null or blank text has size 0 and is never taken; null is a source of its own, after all others;
repeated rows are documents of their own, each with its own place; ties (equal shuffle keys) stand in order of
doc_id and row hash; a very long text covers several blocks, which may stand in slots far apart; an empty table gives
an empty result; other columns are ignored by ``mix`` and kept by ``mixed_documents``, whatever their names.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from docloom.llm.common import WORD, materialize, number_copies, positioned, quoted

#: Weights of sources in order, repeating (fixed value of the contract).
WEIGHTS = (5.0, 2.0, 1.0)
#: The golden ratio's fraction in units of 2**-62.
GOLDEN = 2850178704830799621
UNIT = 1 << 62
_HALF = (1 << 31) - 1


def targets(sizes: list[int], weights: list[float], most: float) -> list[float]:
    """Shares of all sizes by weight, none above ``most`` times its size; the excess is shared again."""
    out, open_, left = [0.0] * len(sizes), list(range(len(sizes))), float(sum(sizes))
    while open_:
        whole = sum(weights[i] for i in open_)
        full = [i for i in open_ if left * weights[i] / whole > most * sizes[i]] if whole else open_
        if not full:
            for i in open_:
                out[i] = left * weights[i] / whole
            return out
        for i in full:
            out[i] = float(most * sizes[i])
        left = max(0.0, left - sum(out[i] for i in full))
        open_ = [i for i in open_ if i not in set(full)]
    return out


def point(slot: Column, step: int = GOLDEN) -> Column:
    """(slot + 1) * step modulo 2**62, exact for slots below 2**61: no product passes 63 bits."""
    i = slot + F.lit(1)
    low, high = i.bitwiseAND(F.lit(_HALF)), F.shiftright(i, 31)
    middle = (low * F.lit(step >> 31) + high * F.lit(step & _HALF)).bitwiseAND(F.lit(_HALF))
    return (low * F.lit(step & _HALF) + F.shiftleft(middle.cast("long"), 31)).bitwiseAND(F.lit(UNIT - 1))


def edges(want: list[float]) -> list[int]:
    """Upper ends of the sources' shares of the unit, in units of 2**-62."""
    whole, out, so_far = sum(want), [], 0.0
    for t in want:
        so_far += t
        out.append(min(UNIT, int(so_far / whole * UNIT)) if whole else 0)
    return [*out[:-1], UNIT] if out else out


def schedule(spark: SparkSession, ups: list[int], slots: int, chunk: int = 8192, step: int = GOLDEN) -> DataFrame:
    """(source_no, block, slot): the source that each slot's point falls to, and the slot's rank among that source's."""
    if not slots:
        return spark.createDataFrame([], "source_no int, block long, slot long")
    x = F.col("point")

    def find(low: int, high: int) -> Column:
        """Binary search among the upper ends, as a balanced tree of conditions."""
        if low == high:
            return F.lit(low)
        mid = (low + high) // 2
        return F.when(x < ups[mid], find(low, mid)).otherwise(find(mid + 1, high))

    table = spark.range(slots).select(F.col("id").alias("slot"), point(F.col("id"), step).alias("point"))
    table = table.select("slot", find(0, len(ups) - 1).cast("int").alias("source_no"), F.floor(F.col("slot") / chunk).alias("chunk"))
    inside = Window.partitionBy("source_no", "chunk").orderBy("slot")
    before = Window.partitionBy("source_no").orderBy("chunk").rowsBetween(Window.unboundedPreceding, -1)
    base = table.groupBy("source_no", "chunk").agg(F.count(F.lit(1)).alias("n")).withColumn("base", F.coalesce(F.sum("n").over(before), F.lit(0))).drop("n")
    ranks = table.withColumn("r", F.row_number().over(inside) - 1).join(base, ["source_no", "chunk"])
    return ranks.select("source_no", (F.col("r") + F.col("base")).alias("block"), "slot")


def _row_keys(docs: DataFrame) -> list[Column]:
    """Two 64-bit hashes of a row's columns (maps, which have no hash, left out)."""
    cells = quoted([f.name for f in docs.schema if "map<" not in f.dataType.simpleString()])
    return [F.xxhash64(*cells).alias("row_a"), F.xxhash64(F.lit(1), *cells).alias("row_b")]


def shuffle_key(seed: int) -> Column:
    """The place of a document in its source's shuffled order: a keyed digest of its id and text."""
    return F.md5(F.concat_ws("/", F.lit(str(seed)), F.coalesce(F.col("doc_id").cast("string"), F.lit("null")), F.coalesce("text", F.lit(""))))


def _played(docs: DataFrame, most: int, block: int, least_slots: int, seed: int, step: int) -> tuple[DataFrame, DataFrame, DataFrame, int]:
    """Copies (all documents), plays (words of a copy on one turn of its tape that slots play, and where), sources, slots."""
    spark = docs.sparkSession
    at, file, row = positioned(docs)
    sized = at.select(
        F.col("doc_id").cast("long").alias("doc_id"),
        F.col("source").cast("string").alias("source"),
        F.coalesce(F.regexp_count("text", F.lit(WORD)), F.lit(0)).cast("long").alias("size"),
        *_row_keys(docs),
        shuffle_key(seed).alias("key"),
        F.struct(F.col(file).alias("file"), F.col(row).alias("row")).alias("at"),
    )
    # equal rows become one row with its count, before anything is shuffled by a key
    rows = materialize(sized.groupBy("doc_id", "source", "size", "row_a", "row_b", "key").agg(F.count(F.lit(1)).alias("copies"), F.min("at").alias("at")), "rows")
    found = rows.groupBy("source").agg(F.sum(F.col("size") * F.col("copies")).alias("n")).collect()  # a row a source
    found.sort(key=lambda r: (r["source"] is None, r["source"] or ""))  # code points, null last
    sizes = [r["n"] for r in found]
    want = targets(sizes, [WEIGHTS[i % len(WEIGHTS)] for i in range(len(sizes))], most)
    total = sum(sizes)
    block = max(1, min(block, total // least_slots))
    slots = -(-total // block)
    sources = materialize(spark.createDataFrame([(i, r["source"], n, t) for i, (r, n, t) in enumerate(zip(found, sizes, want))], "source_no int, source string, source_size long, target double"), "sources")
    placed = rows.join(F.broadcast(sources.drop("target")), rows["source"].eqNullSafe(sources["source"])).drop(sources["source"])  # a row a source

    # the tape: buckets of the shuffled order, then places inside a bucket
    n = max(1, -(-rows.count() // 2_000))
    placed = placed.withColumn("bucket", F.floor(F.conv(F.substring("key", 1, 12), 16, 10).cast("double") / float(16**12) * n).cast("long"))  # in the order of keys
    words = F.col("size") * F.col("copies")
    before = Window.partitionBy("source_no").orderBy("bucket").rowsBetween(Window.unboundedPreceding, -1)
    base = placed.groupBy("source_no", "bucket").agg(F.sum(words).alias("words")).withColumn("base", F.coalesce(F.sum("words").over(before), F.lit(0))).drop("words")
    inside = Window.partitionBy("source_no", "bucket").orderBy("key", "doc_id", "row_a", "row_b").rowsBetween(Window.unboundedPreceding, -1)
    tape = placed.withColumn("place", F.coalesce(F.sum(words).over(inside), F.lit(0))).join(base, ["source_no", "bucket"])
    outer, inner = number_copies(F.col("copies"))
    copies = tape.withColumn("start", F.col("place") + F.col("base")).drop("place", "base", "key", "bucket").withColumn("_chunk", outer).withColumn("copy", inner)
    copies = materialize(copies.withColumn("start", F.col("start") + F.col("copy") * F.col("size")).drop("_chunk", "copies"), "tape")

    # each turn of a document, cut where blocks end, joined to the slots that play those blocks
    turns = copies.where("size > 0").select("*", F.explode(F.sequence(F.lit(0), F.lit(most - 1))).alias("turn")).withColumn("a", F.col("start") + F.col("turn") * F.col("source_size"))
    part = turns.select("*", F.explode(F.sequence(F.floor(F.col("a") / block), F.floor((F.col("a") + F.col("size") - 1) / block))).alias("block"))
    first = F.greatest("a", F.col("block") * block)
    part = part.withColumn("words", F.least(F.col("a") + F.col("size"), (F.col("block") + 1) * block) - first).withColumn("inside", first - F.col("block") * block)
    played = part.join(schedule(spark, edges(want), slots, step=step), ["source_no", "block"])
    return copies, played.withColumn("place", F.col("slot") * block + F.col("inside")), sources, slots


def mix(docs: DataFrame, most: int = 3, block: int = 2048, least_slots: int = 65_536, seed: int = 1, step: int = GOLDEN) -> DataFrame:
    """doc_id, size, source_size, target, taken, source, first_slot and first_place of each row of ``docs``.

    ``first_slot`` is the first slot that plays words of the document (null: none does), ``first_place`` the first such
    word's place in the mix, where every slot has ``block`` places; no two documents share a place.
    """
    copies, played, sources, _ = _played(docs, most, block, least_slots, seed, step)
    keys = ["doc_id", "size", "source_no", "row_a", "row_b", "copy"]
    # every document once with no words, so those that no slot plays stay, without an outer join on empty keys
    every = copies.select(*keys, F.lit(0).cast("long").alias("words"), F.lit(None).cast("long").alias("slot"), F.lit(None).cast("long").alias("place"))
    taken = played.select(*keys, "words", "slot", "place").unionByName(every).groupBy(*keys).agg(F.sum("words").alias("taken"), F.min("slot").alias("first_slot"), F.min("place").alias("first_place"))
    out = taken.join(F.broadcast(sources), "source_no")  # a row a source
    return out.select("doc_id", "size", "source_size", "target", "taken", "source", "first_slot", "first_place")


def mixed_documents(docs: DataFrame, most: int = 3, block: int = 2048, least_slots: int = 65_536, seed: int = 1, step: int = GOLDEN) -> DataFrame:
    """The mix itself, with the columns of ``docs``, in the order of the slots: partition after partition, row after row.

    A document stands once for each turn of its tape of which slots play half its words or more; so whole documents
    stand for their words, and only at the end of a source's part are they rounded.
    """
    spark, names = docs.sparkSession, docs.columns
    _, played, _, slots = _played(docs, most, block, least_slots, seed, step)
    turns = played.groupBy("row_a", "row_b", "copy", "turn", "size", "at").agg(F.sum("words").alias("words"), F.min("place").alias("place"), F.min("slot").alias("slot"))
    stands = turns.where(F.col("words") * 2 >= F.col("size")).select(F.col("at.file").alias("_f"), F.col("at.row").alias("_r"), "slot", "place")
    at, file, row = positioned(docs)
    rows = at.select(F.col(file).alias("_file"), F.col(row).alias("_row"), F.struct(*quoted(names)).alias("_doc"))
    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    to = F.floor(F.col("slot") * parts / max(1, slots)).cast("int")
    joined = rows.join(stands, (rows["_file"] == stands["_f"]) & (rows["_row"] == stands["_r"]))
    return joined.select("_doc", "place", to.alias("_to")).repartitionById(parts, "_to").sortWithinPartitions("place").select("_doc.*")

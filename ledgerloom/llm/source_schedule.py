"""Mixing sources to target weights by a low-discrepancy schedule of equal-token blocks.

The words of a source, its documents in shuffled order, are a stream cut into blocks of equal size. Golden-ratio
points fall on the sources in proportion to their targets; the k-th point of a source takes
its k-th block, and after the last block the stream begins again. Any stretch of the schedule
is mixed close to the targets, and the place of a block needs no state but a count.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgerloom.operators.running_totals import with_running_total
from ledgerloom.operators.hotkeys import attach_by_key
from ledgerloom.sources.writers import land

GOLDEN = 0.6180339887498949
BLOCK_TOKENS = 1024
MAX_EPOCHS = 3
WORD = r"[^\x20\x09-\x0D]+"
CHUNK = 1 << 16


def sized_documents(documents: DataFrame) -> DataFrame:
    """``doc_id, source, size``: the number of words of each whole text; null has none."""
    size = F.coalesce(F.regexp_count(F.col("text").cast("string"), F.lit(WORD)), F.lit(0)).cast("long")
    return documents.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("source").cast("string").alias("source"), size.alias("size"))


def source_targets(sized: DataFrame, weights: tuple[int, ...] = (1, 2, 3), max_epochs: int = MAX_EPOCHS) -> DataFrame:
    """``source, documents, source_size, weight, target`` of each source.

    Sources in code point order, null last, take the ``weights`` in turn and share the total size by
    them. No target exceeds ``max_epochs`` times the size of its source; what lies above is shared
    among the others by weight until none is above. The level that settles this is found from sums
    alone, one small row at a time.
    """
    sums = sized.groupBy("source").agg(F.sum("size").alias("source_size"), F.count(F.lit(1)).alias("documents"), F.lit(1).alias("one"))
    ranked = with_running_total(sums, [], [F.col("source").asc_nulls_last()], "one", "place")
    turn = F.element_at(F.array(*[F.lit(w) for w in weights]), (F.col("place") % len(weights) + 1).cast("int"))
    sources = land(ranked.select("source", "documents", "source_size", turn.alias("weight")), "sources")
    cap = F.col("source_size") * max_epochs
    level = 0.0
    while True:
        capped = cap < F.col("weight") * F.lit(level)
        total, taken, left = sources.agg(
            F.sum("source_size"), F.coalesce(F.sum(F.when(capped, cap)), F.lit(0)), F.coalesce(F.sum(F.when(~capped, F.col("weight"))), F.lit(0))
        ).first()
        higher = (total - taken) / left if left else level
        if higher <= level:
            break
        level = higher
    return sources.withColumn("target", F.least(cap.cast("double"), F.col("weight") * F.lit(float(level))))


def block_demand(targets: DataFrame, block_tokens: int = BLOCK_TOKENS) -> DataFrame:
    """Add to each source: whole words wanted, blocks in its stream, and slots it needs."""
    size, words = F.col("source_size"), F.col("words")
    blocks = F.ceil(size / block_tokens)
    rounds = F.when(size > 0, F.floor(words / size)).otherwise(0)
    rest = F.when(size > 0, words % size).otherwise(0)
    demand = targets.withColumn("words", F.floor("target")).withColumn("blocks", blocks)
    return demand.withColumn("slots", (rounds * F.col("blocks") + F.ceil(rest / block_tokens)).cast("long"))


def schedule(demand: DataFrame, block_tokens: int = BLOCK_TOKENS) -> DataFrame:
    """One row per slot: ``slot, source, block, first_word, end_word`` of the source's stream.

    The unit interval is divided among the sources by the slots they need. Points are ranked per source; a point
    beyond the need of its source is void, and slots that the points leave out follow at the end, so
    each source gets exactly the words it is due.
    """
    spark = demand.sparkSession
    demand = land(with_running_total(demand, [], [F.col("source").asc_nulls_last()], "slots", "low").filter("slots > 0"), "demand")
    n_sources, n_slots = demand.agg(F.count(F.lit(1)), F.coalesce(F.sum("slots"), F.lit(0))).first()
    width = max(1, n_slots // (8 * n_sources + 1024))
    cells = F.sequence(F.floor(F.col("low") / width), F.floor((F.col("low") + F.col("slots") - 1) / width))
    ranges = demand.select("source", "low", (F.col("low") + F.col("slots")).alias("high"), F.explode(cells).alias("cell"))
    at = F.least(F.pmod((F.col("id") + 1) * F.lit(GOLDEN), F.lit(1.0)) * F.lit(float(n_slots)), F.lit(n_slots - 0.5))
    points = spark.range(n_slots).select(F.col("id").alias("slot"), F.floor(at).alias("at"))
    points = points.withColumn("cell", F.floor(F.col("at") / width))
    fallen = points.join(ranges, "cell").filter("at >= low and at < high").select("slot", "source", F.lit(1).alias("one"))
    ranked = with_running_total(fallen, ["source"], [F.col("slot").asc()], "one", "turn").select(
        "slot", F.col("source").alias("__source"), F.col("turn").alias("__turn")
    )
    chunks = demand.withColumn("chunk", F.explode(F.sequence(F.lit(0), F.floor((F.col("slots") - 1) / CHUNK)))).repartition("source", "chunk")
    turns = chunks.withColumn(
        "turn", F.explode(F.sequence(F.col("chunk") * CHUNK, F.least((F.col("chunk") + 1) * CHUNK, F.col("slots")) - 1))
    )
    placed = turns.join(ranked, F.col("source").eqNullSafe(F.col("__source")) & (F.col("turn") == F.col("__turn")), "left")
    epoch = F.floor(F.col("turn") / F.col("blocks"))
    block = F.col("turn") % F.col("blocks")
    first = block * block_tokens
    end = F.least(first + block_tokens, F.col("source_size"), F.col("words") - epoch * F.col("source_size"))
    return placed.select(
        F.coalesce("slot", F.lit(n_slots) + F.col("low") + F.col("turn")).alias("slot"),
        "source", block.alias("block"), first.alias("first_word"), end.alias("end_word"),
    )


def document_blocks(sized: DataFrame, block_tokens: int = BLOCK_TOKENS) -> DataFrame:
    """The documents of each source in shuffled order as pieces of blocks: a piece is the part of a document in one block.

    The order is that of a digest of ``doc_id``, so it is the same in every run.
    """
    order = [F.md5(F.coalesce(F.col("doc_id").cast("string"), F.lit(""))).asc(), F.col("doc_id").asc(), F.col("size").asc()]
    streamed = with_running_total(sized, ["source"], order, "size", "start")
    end = F.col("start") + F.col("size")
    blocks = F.sequence(F.floor(F.col("start") / block_tokens), F.floor(F.greatest(end - 1, F.col("start")) / block_tokens))
    return streamed.select("doc_id", "source", "size", "start", end.alias("end"), F.explode(blocks).alias("block"))


def mixed_documents(
    documents: DataFrame, weights: tuple[int, ...] = (1, 2, 3), max_epochs: int = MAX_EPOCHS, block_tokens: int = BLOCK_TOKENS
) -> DataFrame:
    """One row per row of ``documents``: ``doc_id, size, source_size, target, taken, first_slot``.

    ``taken`` counts the words the mix takes from the document, repeats included, and is at most
    ``max_epochs`` times its size; ``first_slot`` is the first place in the schedule, null if none.
    A null source is a source; a null or empty text takes nothing; rows that repeat share their places
    in any order. An empty table gives an empty result; other columns are ignored.
    """
    sized = land(sized_documents(documents), "sizes")
    demand = land(block_demand(source_targets(sized, weights, max_epochs), block_tokens), "targets")
    if demand.filter("slots > 0").isEmpty():
        slots = demand.select(F.lit(0).alias("slot"), "source", F.lit(0).alias("block"), F.lit(0).alias("first_word"), F.lit(0).alias("end_word")).limit(0)
    else:
        slots = schedule(demand, block_tokens)
    wanted = slots.select(F.col("slot"), F.col("source").alias("__source"), F.col("block").alias("__block"), "end_word")
    pieces = document_blocks(sized, block_tokens)
    joined = pieces.join(wanted, F.col("source").eqNullSafe(F.col("__source")) & (F.col("block") == F.col("__block")), "left")
    low = F.greatest(F.col("start"), F.col("block") * block_tokens)
    high = F.least(F.col("end"), (F.col("block") + 1) * block_tokens, F.col("end_word"))
    words = F.when(F.col("slot").isNotNull(), F.greatest(high - low, F.lit(0))).otherwise(0)
    taken = joined.withColumn("__words", words).groupBy("source", "start", "doc_id", "size").agg(
        F.sum("__words").cast("long").alias("taken"), F.min(F.when(F.col("__words") > 0, F.col("slot"))).alias("first_slot")
    )
    filled = taken.filter("size > 0")
    empty = sized.filter("size = 0").select(
        "source", "doc_id", "size", F.lit(0).cast("long").alias("taken"), F.lit(None).cast("long").alias("first_slot")
    )
    rows = filled.select("source", "doc_id", "size", "taken", "first_slot").unionByName(empty)
    per_source = demand.select("source", "source_size", "target", "documents")
    return attach_by_key(land(rows, "mixed"), per_source, ["source"], ["source_size", "target"], "documents").select(
        "doc_id", "size", "source_size", "target", "taken", "first_slot"
    )

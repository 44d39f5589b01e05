"""Benchmark decontamination by templates, so that a question with other numbers or names is found too.

Numbers, units and names become typed slots; windows of template tokens are hashed and joined, and so are the same windows
with their values in lower case. For windows with slots, the values that stand in them are compared: within one
occurrence, one benchmark value must stand for one value of the document throughout, as when a question is asked again with other figures.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgerloom.operators.hotkeys import broadcast_if_at_most, null_safe_match
from ledgerloom.sources.writers import land

WINDOW = 5
COVERAGE = 0.8
LITERALS = 2
BROADCAST_WINDOWS = 500_000

# FIRST marks a capitalised word that begins a sentence: it may be a name or not, and is taken both ways
NUMBER, NAME, UNIT, FIRST = "\x01", "\x02", "\x03", "\x04"
PAIR = ["doc_id", "text_hash", "item_id"]
UNITS = (
    "%|°|€|kg|g|mg|km|cm|mm|m|mi|miles?|feet|ft|inch(?:es)?|lbs?|pounds?|litres?|liters?|ml|l|hours?|hrs?|h|minutes?|min|"
    "seconds?|sec|s|days?|weeks?|months?|years?|dollars?|euros?|cents?|percent|degrees?|mph|kmh|watts?|kw|w|volts?|v"
)
# a capital inside a sentence, its other letters small
NAME_PATTERN = r"\p{Lu}(?<=[^.!?:\s\x22(] \p{Lu})\p{Ll}+"
FIRST_PATTERN = r"(?<![\p{L}\p{N}\x02])\p{Lu}\p{Ll}+"
# a number with the unit after it, if it has one
NUMBER_PATTERN = rf"([0-9]+)(?:[ ]?((?i:{UNITS}))(?![\p{{L}}0-9]))?"


def template_tokens(text: Column) -> Column:
    """Lower-case tokens of letters and digits; a slot is its type mark followed by its value."""
    names = F.regexp_replace(F.coalesce(text.cast("string"), F.lit("")), NAME_PATTERN, f"{NAME}$0")
    names = F.regexp_replace(names, FIRST_PATTERN, f"{FIRST}$0")
    numbers = F.regexp_replace(names, NUMBER_PATTERN, f" {NUMBER}$1 {UNIT}$2 ")
    return F.array_remove(F.array_remove(F.split(F.lower(numbers), r"[^\p{L}\p{N}\x01-\x04]+", -1), ""), UNIT)


def _value(token: Column) -> Column:
    return F.when(token < F.lit("\x05"), F.substring(token, 2, 1 << 30)).otherwise(token)


def _type(token: Column) -> Column:
    """The mark of a slot, the word itself otherwise; a word that begins a sentence is no slot."""
    return F.when(token < F.lit(FIRST), F.substring(token, 1, 1)).otherwise(_value(token))


def _type_with_first(token: Column) -> Column:
    """The same, but a capitalised word that begins a sentence is a name."""
    return F.when(token.startswith(FIRST), F.lit(NAME)).otherwise(_type(token))


READINGS = (_value, _type, _type_with_first)


def _hashes(tokens: Column, read: Callable[[Column], Column]) -> Column:
    return F.transform(tokens, lambda t: F.xxhash64(read(t)))


def _hashed(tokens: Column, start: Column, window: int) -> Column:
    return F.xxhash64(*[F.get(tokens, start + k) for k in range(window)])


def _document_windows(documents: DataFrame, window: int, lengths: list[int]) -> DataFrame:
    """``doc_id, text_hash, doc_pos, hash``: of each position, the different hashes of its window by values and by types, and by values of
    its shorter windows of ``lengths``.

    Words are hashed once, in arrays; positions become rows before their windows are hashed, so that this is compiled code and not a
    lambda. A window without slots reads alike in all ways and gives one row.
    """
    tokens = documents.select(*_identity(), template_tokens(F.col("text")).alias("tokens"))
    names = [f"r{i}" for i in range(len(READINGS))]
    read = tokens.select("doc_id", "text_hash", *[_hashes(F.col("tokens"), f).alias(n) for f, n in zip(READINGS, names)])
    last = F.size("r0") - (min(lengths) if lengths else window)
    starts = F.when(last >= 0, F.sequence(F.lit(0), last)).otherwise(F.array().cast("array<int>"))
    placed = read.select("doc_id", "text_hash", *names, F.explode(starts).alias("doc_pos"))
    hashed = placed.select("doc_id", "text_hash", "doc_pos", *[_hashed(F.col(n), F.col("doc_pos"), window).alias(f"h{n}") for n in names], *[_hashed(F.col("r0"), F.col("doc_pos"), n).alias(f"short{n}") for n in lengths])
    several = F.array_distinct(F.array(*[f"h{n}" for n in names], *[f"short{n}" for n in lengths]))
    alike = (F.col("hr1") == F.col("hr0")) & (F.col("hr2") == F.col("hr0"))
    told = several if lengths else F.when(alike, F.array("hr0")).otherwise(several)
    return hashed.select("doc_id", "text_hash", "doc_pos", F.explode(told).alias("hash"))


def benchmark_windows(benchmark: DataFrame, window: int = WINDOW, literals: int = LITERALS) -> DataFrame:
    """``item_id, item_pos, hash, types, slots, length, poor, n_windows, n_poor``: each window by its values and, with slots, by its types.

    ``types`` are its words or marks, ``slots`` the places of its slots and what the item has there; both are empty for a window by values.
    A window by types that has fewer than ``literals`` plain words is ``poor``: it is not searched for, only looked up beside others.
    An item shorter than a window is one window by values of its whole ``length``.
    """
    items = benchmark.select(F.col("item_id").cast("long").alias("item_id"), template_tokens(F.col("text")).alias("tokens")).distinct().filter(F.size("tokens") > 0)
    starts = F.sequence(F.lit(0), F.greatest(F.lit(0), F.size("tokens") - window))
    placed = items.select("item_id", F.posexplode(F.transform(starts, lambda i: F.slice(F.col("tokens"), i + 1, window))).alias("item_pos", "own"))
    placed = placed.withColumn("length", F.size("own"))
    none = F.array().cast("array<string>")

    def reading(f: Callable[[Column], Column], slotted: bool) -> Column:
        types = F.transform("own", f)
        slots = F.filter(
            F.transform("own", lambda t, k: F.struct(k.alias("place"), F.concat(f(t), _value(t)).alias("item_value"), f(t).alias("mark"))),
            lambda s: F.lit(slotted) & (s["mark"] < F.lit(FIRST)) & (F.col("length") == window),
        )
        return F.struct(_hashed(_hashes(F.col("own"), f), F.lit(0), window).alias("hash"), (types if slotted else none).alias("types"), slots.alias("slots"))

    read = placed.select("item_id", "item_pos", "length", F.explode(F.array_distinct(F.array(*[reading(f, f is not _value) for f in READINGS]))).alias("r"))
    told = read.select("item_id", "item_pos", "length", "r.*").filter((F.size("types") == 0) | (F.size("slots") > 0))
    told = told.withColumn("poor", F.size("slots") > window - literals).distinct()
    n = told.groupBy("item_id").agg(F.count_distinct("item_pos").alias("n_windows"), F.count_distinct(F.when(F.col("poor"), F.col("item_pos"))).alias("n_poor"))
    return told.join(n.withColumnRenamed("item_id", "__item"), F.col("item_id").eqNullSafe(F.col("__item"))).drop("__item")


def _identity() -> list[Column]:
    return [F.col("doc_id").cast("long").alias("doc_id"), F.xxhash64(F.coalesce(F.col("text").cast("string"), F.lit(""))).alias("text_hash")]


def _same() -> Column:
    return F.col("doc_id").eqNullSafe(F.col("__id")) & (F.col("text_hash") == F.col("__hash"))


def _beside(left: DataFrame, right: DataFrame, keys: list[str], how: str) -> DataFrame:
    """A join that matches null keys, with the columns of ``left`` and what else ``right`` has."""
    names = [f"__{k}" for k in keys]
    joined = left.join(right.withColumnsRenamed(dict(zip(keys, names))), null_safe_match(keys, names), how)
    return joined if how in ("left_semi", "left_anti") else joined.drop(*names)


def leaked_items(documents: DataFrame, benchmark: DataFrame, window: int = WINDOW, coverage: float = COVERAGE) -> DataFrame:
    """``doc_id, text_hash, item_id, n_windows, n_matched, n_reworded`` of each benchmark item that a document holds.

    An item is held if ``coverage`` of its windows occur in the document: with the item's own values, in whatever case and place, or
    within one occurrence, or the whole document, with the value most often put there for each of the item's values; the best
    occurrence counts. ``n_reworded`` counts matched windows with no copy of the item's own values. An item shorter than a
    window is held if all its words follow each other. Null and empty texts hold and match nothing; rows that repeat count once;
    a null ``item_id`` or ``doc_id`` is an id like any other. Either table may be empty. Other columns are ignored.
    """
    items = land(benchmark_windows(benchmark, window), "benchmark-windows")
    # at most one length for each place of a window
    lengths = sorted(r[0] for r in items.filter(F.col("length") < window).select("length").distinct().collect())
    searched = items.filter(~F.col("poor"))
    wanted = broadcast_if_at_most(searched.select("hash").distinct(), BROADCAST_WINDOWS)
    found = land(_document_windows(documents, window, lengths).join(wanted, "hash"), "shared-windows")
    hits = found.join(searched, "hash")
    places = hits.groupBy(*PAIR, "n_windows", "n_poor", "item_pos").agg(F.min(F.size("slots")).alias("least_slots"))
    own = F.col("least_slots") == 0
    pairs = places.groupBy(*PAIR, "n_windows", "n_poor").agg(F.count(F.lit(1)).alias("n"), F.count_if(own).alias("n_own"))
    least = F.ceil(F.col("n_windows") * F.lit(coverage) - 1e-9)
    # pairs that could be held if every window counted
    possible = land(pairs.filter(F.col("n") + F.col("n_poor") >= least).select(*PAIR, "n_windows", "n_own"), "possible-leaks")
    slotted = land(_beside(hits.filter(F.size("slots") > 0), possible.select(*PAIR), PAIR, "left_semi"), "slotted-windows")
    if slotted.isEmpty():
        more = possible.withColumn("n_reworded", F.lit(0))
    else:
        copied = _beside(hits.filter(F.size("slots") == 0), possible.select(*PAIR), PAIR, "left_semi").select(*PAIR, "item_pos").distinct()
        reworded = _beside(_consistent(documents, slotted, items.filter("poor"), window), copied, [*PAIR, "item_pos"], "left_anti")
        best = reworded.groupBy(*PAIR, "occurrence").agg(F.count(F.lit(1)).alias("n")).groupBy(*PAIR).agg(F.max("n").alias("n_reworded"))
        more = _beside(possible, best, PAIR, "left")
    n_reworded = F.coalesce("n_reworded", F.lit(0)).cast("long")
    counted = more.select(*PAIR, "n_windows", (F.col("n_own") + n_reworded).alias("n_matched"), n_reworded.alias("n_reworded"))
    return counted.filter(F.col("n_matched") >= least)


def _consistent(documents: DataFrame, slotted: DataFrame, poor: DataFrame, window: int) -> DataFrame:
    """``item_pos`` of the windows whose values follow the substitution that most windows of their occurrence agree on.

    An occurrence is a stretch of shifts between item and document of half an item's length; stretches overlap by half, and the
    whole document is one more. Poor windows are looked up at the shifts of the others.
    """
    columns = [*PAIR, "n_windows", "item_pos", "doc_pos", "hash", "types", "slots"]
    shift = (F.col("doc_pos") - F.col("item_pos")).alias("shift")
    beside = _beside(slotted.select(*PAIR, shift).distinct(), poor, ["item_id"], "inner").withColumn("doc_pos", F.col("item_pos") + F.col("shift"))
    candidates = slotted.select(columns).unionByName(beside.filter("doc_pos >= 0").select(columns))
    asked = slotted.select(F.col("doc_id").alias("__id"), F.col("text_hash").alias("__hash")).distinct()
    texts = documents.select(*_identity(), "text").join(asked, _same())
    tokens = texts.select("__id", "__hash", template_tokens(F.col("text")).alias("tokens")).dropDuplicates(["__id", "__hash"])
    joined = candidates.join(tokens, _same()).withColumn("own", F.slice("tokens", F.col("doc_pos") + 1, window)).drop("tokens", "__id", "__hash")
    fits = F.zip_with("types", "own", lambda x, t: F.coalesce(x.isin(_type(t), _type_with_first(t)), F.lit(False)))
    fitting = joined.filter((F.size("own") == window) & F.forall(fits, lambda f: f))
    width = F.ceil((F.col("n_windows") + window - 1) / 2)
    stretches = F.array(
        F.struct(F.lit(0).alias("kind"), F.floor(shift / width).alias("at")), F.struct(F.lit(1).alias("kind"), F.floor((shift + width / 2) / width).alias("at")),
        F.struct(F.lit(2).alias("kind"), F.lit(0).cast("long").alias("at")),
    )
    put = F.transform(
        "slots", lambda s: F.struct(s["item_value"].alias("item_value"), F.concat(s["mark"], _value(F.get(F.col("own"), s["place"]))).alias("doc_value"))
    )
    windows = fitting.select(*PAIR, "item_pos", "doc_pos", "hash", put.alias("put"), F.explode(stretches).alias("occurrence"))
    values = land(windows.select("*", F.explode("put").alias("s")).select("*", "s.item_value", "s.doc_value").drop("s", "put"), "slot-values")
    votes = values.groupBy(*PAIR, "occurrence", "item_value", "doc_value").agg(F.count(F.lit(1)).alias("votes"))
    keys = [*PAIR, "occurrence", "item_value"]
    chosen = votes.groupBy(*keys).agg(F.min_by("doc_value", F.struct(-F.col("votes"), F.col("doc_value"))).alias("chosen"))
    judged = _beside(values, chosen, keys, "inner")
    per_window = judged.groupBy(*PAIR, "occurrence", "item_pos", "doc_pos", "hash").agg(F.every(F.col("doc_value") == F.col("chosen")).alias("agrees"))
    return per_window.filter("agrees").select(*PAIR, "occurrence", "item_pos").distinct()


def without_leaks(documents: DataFrame, benchmark: DataFrame, **options: float) -> DataFrame:
    """``documents``, all columns, without the rows that hold a benchmark item."""
    leaks = land(leaked_items(documents, benchmark, **options), "leaks")
    gone = leaks.select(F.col("doc_id").alias("__id"), F.col("text_hash").alias("__hash")).distinct()
    # whole rows travel as one column, so that no name of theirs can clash
    rows = documents.select(F.struct("*").alias("row"), *_identity())
    return rows.join(gone, _same(), "left_anti").select("row.*")

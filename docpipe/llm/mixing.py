"""Sources mixed to target weights by a low-discrepancy schedule of equal-token blocks.

Each source's documents are laid out in up to max_repeats shuffled rounds and cut into blocks of the same number of
tokens. Slot i of the schedule belongs to the source whose interval of cumulative weights holds the i-th golden-ratio
point; the k-th slot of a source takes its k-th block, and slots of sources that have run out are left out. Positions within a source and ranks of slots are prefix sums
in two levels, so no task ever holds a whole source.
"""

from __future__ import annotations

import math

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from docpipe.session import cut_lineage

BLOCK_TOKENS = 1024
GOLDEN = (math.sqrt(5) - 1) / 2
SLOTS_PER_CHUNK = 1 << 14
DOCS_PER_CHUNK = 1 << 14
SEED = 11


def source_plan(sizes: DataFrame, targets: DataFrame, block: int = BLOCK_TOKENS) -> DataFrame:
    """source, target_share, max_repeats, docs, tokens, whole, blocks, weight, lo, hi: one row per target source.

    sizes: source, tokens per document. weight is target_share over the sources that have tokens (the share of a
    source without any can't be reached and goes to the others in proportion); whole and blocks are what max_repeats rounds
    of its tokens give, without and with the last partial block. Negative or null shares and repeats count as 0.
    """
    have = sizes.where("source is not null").groupBy("source").agg(F.count("*").alias("docs"), F.sum("tokens").cast("long").alias("tokens"))
    t = targets.where("source is not null").groupBy("source").agg(F.greatest(F.coalesce(F.max("target_share"), F.lit(0.0)), F.lit(0.0)).alias("target_share"), F.greatest(F.coalesce(F.max("max_repeats"), F.lit(0)), F.lit(0)).alias("max_repeats"))
    plan = t.join(have, "source", "left").withColumns({"docs": F.coalesce("docs", F.lit(0)), "tokens": F.coalesce("tokens", F.lit(0))})
    uses = F.col("tokens") * F.col("max_repeats") / block
    plan = plan.withColumns({"whole": F.floor(uses), "blocks": F.ceil(uses)})
    usable = F.when(F.col("blocks") > 0, F.col("target_share")).otherwise(0.0)
    every = Window.partitionBy()  # one row per source of the target list, a list of fixed length
    plan = plan.withColumn("weight", F.coalesce(F.try_divide(usable, F.sum(usable).over(every)), F.lit(0.0)))
    upto = every.orderBy("source").rowsBetween(Window.unboundedPreceding, 0)
    return plan.withColumn("hi", F.sum("weight").over(upto)).withColumn("lo", F.col("hi") - F.col("weight"))


def _lasting(ends: list[tuple[float, float]]) -> int:
    """Slots of the longest schedule to whose end sources of at least half the weight last. ends: (slot of the end, weight)."""
    held = 0.0
    for end, weight in sorted(ends, reverse=True):
        held += weight
        if held > 0.5 - 1e-9:
            return int(end)
    return 0


def schedule(plan: DataFrame) -> DataFrame:
    """slot, source, rank: rank is the slot's number among those of its source; slots of sources that have run out are left out.

    Golden-ratio points give a source of weight w the share w of the first n slots to within 3 + 2.1 ln n slots,
    whatever its interval. So the schedule is drawn long enough by that bound, and where each source really ends is then
    counted, not estimated.
    """
    spark = plan.sparkSession
    # the target list is a few rows whatever the size of the corpus, so its bounds become literals
    known = [r for r in plan.orderBy("hi").collect() if r["weight"] > 0]
    if not known:
        return spark.createDataFrame([], "slot long, source string, rank long")
    slack = 3 + 2.1 * math.log(max(2.0, sum(r["blocks"] for r in known) / min(r["weight"] for r in known)))
    drawn = _lasting([(math.ceil((r["blocks"] + slack) / r["weight"]), r["weight"]) for r in known])
    u = F.pmod((F.col("id") + 1) * F.lit(GOLDEN), F.lit(1.0))
    # a source that ends the mixture ends with a whole block; one that runs out before, or is alone, gives its last part too
    lasts = {r["source"]: r["whole"] if r["whole"] and len(known) > 1 else r["blocks"] for r in known}
    owner, blocks, full = F.lit(known[-1]["source"]), F.lit(known[-1]["blocks"]), F.lit(lasts[known[-1]["source"]])
    for r in reversed(known[:-1]):
        here = u < F.lit(r["hi"])
        owner, blocks, full = F.when(here, F.lit(r["source"])).otherwise(owner), F.when(here, F.lit(r["blocks"])).otherwise(blocks), F.when(here, F.lit(lasts[r["source"]])).otherwise(full)
    placed = spark.range(drawn).select(F.col("id").alias("slot"), owner.alias("source"), blocks.cast("long").alias("blocks"), full.cast("long").alias("full"), F.floor(F.col("id") / SLOTS_PER_CHUNK).alias("chunk"))
    before = _before(placed.groupBy("source", "chunk").agg(F.count("*").alias("n")), ["source"], "chunk", "n")
    local = Window.partitionBy("source", "chunk").orderBy("slot")
    ranked = placed.withColumn("r", F.row_number().over(local) - 1).join(before, ["source", "chunk"]).withColumn("rank", F.col("r") + F.col("before"))
    ranked = cut_lineage(ranked.where("rank <= blocks").select("slot", "source", "rank", "blocks", "full", "chunk"))
    # the first slot that a source can't fill: at most a row per source
    ends = {r["source"]: r["slot"] for r in ranked.where("rank = full").select("source", "slot").collect()}
    slots = _lasting([(ends.get(r["source"], drawn), r["weight"]) for r in known])
    kept = ranked.where((F.col("slot") < slots) & (F.col("rank") < F.col("blocks")))
    before = _before(kept.groupBy("chunk").agg(F.count("*").alias("n")), [], "chunk", "n")
    number = F.row_number().over(Window.partitionBy("chunk").orderBy("slot")) - 1
    return kept.withColumn("r", number).join(before, "chunk").select((F.col("r") + F.col("before")).alias("slot"), "source", "rank")


def _before(sums: DataFrame, part: list[str], order: str, value: str) -> DataFrame:
    """Sum of `value` over the earlier chunks of each part; a row per chunk, so far fewer than rows of data."""
    w = Window.partitionBy(*part).orderBy(order).rowsBetween(Window.unboundedPreceding, -1)
    return sums.select(*part, order, F.coalesce(F.sum(value).over(w), F.lit(0)).alias("before"))


def mix_sources(docs: DataFrame, key: str, source: str, tokens: str, targets: DataFrame, block: int = BLOCK_TOKENS, seed: int = SEED) -> DataFrame:
    """slot, source, key, round, from_token, to_token: the mixture in order, as token ranges of documents.

    docs: one row per document with its number of tokens. The mixture is the longest one to whose end sources of at
    least half the weight last; the others run out, and what they can't give is missing from their reached share. Slots
    are numbered without gaps and hold exactly `block` tokens each, but for the last of a source that has run out; a
    document that spans blocks goes on in the source's next slot. round counts a document's uses (0 is the first), and
    is always below max_repeats. Documents without a source, without tokens, or of a source that has no target are
    left out; repeated rows of a key count once. Without any usable source the result is empty.
    """
    d = docs.where(F.col(key).isNotNull() & F.col(source).isNotNull() & (F.col(tokens) > 0)).select(F.col(key).alias("k"), F.col(source).alias("source"), F.col(tokens).cast("long").alias("tokens")).dropDuplicates(["k"])
    d = cut_lineage(d)
    plan = cut_lineage(source_plan(d.select("source", "tokens"), targets, block))
    ranks = schedule(plan)
    # how many rounds each source takes, then its documents once per round in an order of that round's own
    taken = ranks.groupBy("source").agg((F.max("rank") + 1).alias("taken"))
    rounds = plan.join(taken, "source").select("source", F.col("tokens").alias("total"), F.least("max_repeats", F.ceil(F.col("taken") * block / F.col("tokens"))).cast("int").alias("rounds"))
    chunks = max(1, math.ceil((plan.agg(F.sum("docs")).first()[0] or 0) / DOCS_PER_CHUNK))
    laid = (
        d.join(F.broadcast(rounds), "source")  # one row per source of the target list
        .withColumn("round", F.explode(F.sequence(F.lit(0), F.col("rounds") - 1)))
        .withColumn("order", F.xxhash64(F.lit(seed), "round", "k"))
        .withColumn("chunk", F.floor((F.shiftright("order", 1) + F.lit(1 << 62)) / F.lit((1 << 63) / chunks)).cast("int"))
    )
    before = _before(laid.groupBy("source", "round", "chunk").agg(F.sum("tokens").alias("n")), ["source", "round"], "chunk", "n")
    local = Window.partitionBy("source", "round", "chunk").orderBy("order", "k").rowsBetween(Window.unboundedPreceding, -1)
    laid = (
        laid.withColumn("inner", F.coalesce(F.sum("tokens").over(local), F.lit(0))).join(before, ["source", "round", "chunk"])
        .withColumn("start", F.col("round") * F.col("total") + F.col("before") + F.col("inner"))
        .withColumn("rank", F.explode(F.sequence(F.floor(F.col("start") / block), F.floor((F.col("start") + F.col("tokens") - 1) / block))))
    )
    cut = laid.select(
        "source", "rank", F.col("k").alias(key), "round",
        (F.greatest(F.col("start"), F.col("rank") * block) - F.col("start")).alias("from_token"),
        (F.least(F.col("start") + F.col("tokens"), (F.col("rank") + 1) * block) - F.col("start")).alias("to_token"),
    )
    return cut.join(ranks, ["source", "rank"]).select("slot", "source", key, "round", "from_token", "to_token")


def shares(mixture: DataFrame, docs: DataFrame, source: str, tokens: str, targets: DataFrame, key: str, block: int = BLOCK_TOKENS) -> DataFrame:
    """source, target_share, reached_share, tokens_used, tokens_available, docs, max_repeats, most_uses, reason: a row per source of either side.

    target_share is null for a source without a target; reached_share is its part of all tokens of the mixture. reason
    says why a source is below its target or absent: `no documents`, `no tokens`, `no target`, `no repeats allowed`,
    `used up` (every allowed use of its tokens is in the mixture), else null; where others are used up, the rest lie
    above their targets.
    """
    used = mixture.groupBy("source").agg(F.sum(F.col("to_token") - F.col("from_token")).alias("tokens_used"), (F.max("round") + 1).alias("most_uses"))
    have = docs.where(F.col(key).isNotNull() & F.col(source).isNotNull()).select(key, F.col(source).alias("source"), F.col(tokens).alias("n")).dropDuplicates([key])
    have = have.groupBy("source").agg(F.count("*").alias("docs"), F.sum("n").cast("long").alias("tokens_available"))
    t = targets.where("source is not null").groupBy("source").agg(F.max("target_share").alias("target_share"), F.max("max_repeats").alias("max_repeats"))
    every = Window.partitionBy()  # a row per source
    out = t.join(have, "source", "full").join(used, "source", "left").na.fill(0, ["tokens_used", "most_uses", "docs", "tokens_available"])
    out = out.withColumn("reached_share", F.coalesce(F.try_divide(F.col("tokens_used"), F.sum("tokens_used").over(every)), F.lit(0.0)))
    reason = (
        F.when(F.coalesce("target_share", F.lit(0.0)) <= 0, "no target").when(F.col("docs") == 0, "no documents").when(F.col("tokens_available") <= 0, "no tokens")
        .when(F.coalesce("max_repeats", F.lit(0)) <= 0, "no repeats allowed").when(F.col("tokens_used") >= F.col("tokens_available") * F.col("max_repeats"), "used up")
    )
    return out.select("source", "target_share", "reached_share", "tokens_used", "tokens_available", "docs", "max_repeats", "most_uses", reason.alias("reason"))

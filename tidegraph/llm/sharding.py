"""Sharding by balanced label propagation.

Documents with equal texts are linked. Labels spread over (text, shard) cells, which hold counts,
so a text that a third of all documents share costs no more than any other: each round joins the
cells with their text's most common shard, and cells ask to move there. Every row starts with a label
of its own, so a group starts torn over the shards, about evenly, and propagation is what brings its
copies together: a group that fits a quota gathers at once. One that exceeds a quota starts on as many shards
as it needs, and its moves are admitted while they fit under the shard's quota. Once groups are whole,
and while a shard is over its quota, whole groups leave it for the emptiest one. In the end documents take the places their cells have, and documents without links
fill every shard to its exact quota; what must still go is the oversized group's rows first, then
the rest group by group.

The law is ``rows``: shard counts are at most one apart.

Defined cases: null texts are not linked and have size 1. A text of any length is one link group by
its digest. Repeated rows are linked like other equal texts and each takes a place. With fewer
documents than shards some shards stay empty; an empty table gives no rows. Ties between shards go to
the smaller one; other columns, whatever their names, are not carried."""

from __future__ import annotations

from math import isqrt

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from tidegraph.llm.common import documents, materialise, row_numbers

SHARDS, ROUNDS = 8, 6
#: Hash buckets by which moves into a full shard are admitted.
BUCKETS = 1024


def described(df: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """doc_id, size, text_crc32 and the text's digest (null for a null text)."""
    body = F.col(text).cast("binary")
    return df.select(
        F.col(key).alias("doc_id"),
        (F.coalesce(F.octet_length(body), F.lit(0)) + 1).cast("long").alias("size"),
        F.crc32(F.coalesce(body, F.lit(b""))).alias("text_crc32"),
        F.unhex(F.md5(body)).alias("__group"),
    )


def _quotas(rows: int, shards: int) -> list[int]:
    return [rows // shards + (s < rows % shards) for s in range(shards)]


def propagate(cells: DataFrame, quotas: list[int], rounds: int = ROUNDS) -> tuple[DataFrame, list[int]]:
    """Move cells (group, shard, big, n) towards their group's commonest shard, big ones within the quotas, and
    groups that are whole from shards over their quota to the emptiest ones.

    Returns the cells and the cut: copies outside their group's commonest shard, by round."""
    cuts = []
    for turn in range(rounds):
        best = cells.groupBy("__group").agg(F.max_by("shard", F.struct("n", -F.col("shard"))).alias("to"))
        wish = cells.join(best, "__group").withColumn("b", F.pmod(F.xxhash64("__group", F.lit(turn)), F.lit(BUCKETS)))
        wish = materialise(wish, "moves")
        # at most 2 x shards x shards x BUCKETS rows, whatever the input
        asked = wish.groupBy("shard", "to", "b", "big").agg(F.sum("n").alias("n")).collect()
        load = [0] * len(quotas)
        for r in asked:
            load[r["shard"]] += r["n"]
        moving = sorted(((r["b"], r["shard"], r["to"], r["n"], r["big"]) for r in asked if r["shard"] != r["to"]))
        cuts.append(sum(m[3] for m in moving))
        granted = []
        # small groups first: what they leave is room for big ones
        for b, source, to, n, big in sorted(moving, key=lambda m: m[4]):
            if not big or load[to] + n <= quotas[to]:
                load[to] += n
                load[source] -= n
                granted.append((source, to, b, big, to))
        # the smallest first, so that what a shard holds of large groups stays
        whole = all(big for *_, big in moving)
        for n, b, source in sorted((r["n"], r["b"], r["shard"]) for r in asked if whole and r["shard"] == r["to"] and not r["big"]):
            free = max(range(len(quotas)), key=lambda s: quotas[s] - load[s])
            if load[source] > quotas[source] and load[free] + n <= quotas[free]:
                load[free] += n
                load[source] -= n
                granted.append((source, source, b, False, free))
        if not granted:
            break
        allowed = cells.sparkSession.createDataFrame(granted, "shard int, to int, b long, big boolean, new int")
        moved = wish.join(F.broadcast(allowed), ["shard", "to", "b", "big"], "left")  # bounded as above
        cells = moved.groupBy("__group", F.coalesce("new", "shard").alias("shard"), "big").agg(F.sum("n").alias("n"))
    return cells, cuts


def assign(df: DataFrame, shards: int = SHARDS, key: str = "doc_id", text: str = "text", rounds: int = ROUNDS) -> DataFrame:
    """doc_id, size, text_crc32, shard and slot of every document; counts are at most one apart."""
    docs = materialise(described(df, key, text), "described")
    total = docs.count()
    cells, quotas = max(1, isqrt(total)), _quotas(total, shards)
    spread = F.xxhash64("doc_id", F.monotonically_increasing_id())

    # a rank inside each linked group, numbered cell by cell
    sizes = docs.where(F.col("__group").isNotNull()).groupBy("__group").agg(F.count(F.lit(1)).alias("copies"))
    linked_groups = sizes.where("copies > 1")
    keyed = docs.withColumn("__part", F.pmod(spread, F.lit(cells)).cast("int"))
    keyed = materialise(keyed, "keyed")
    fragments = keyed.where(F.col("__group").isNotNull()).groupBy("__group", "__part").agg(F.count(F.lit(1)).alias("n"))
    fragments = fragments.join(linked_groups, "__group")

    # rows start with labels of their own; those of a group that is larger than a quota, with as many as it needs
    least = max(1, quotas[-1])
    needed = F.when(F.col("copies") > least, F.least(F.ceil(F.col("copies") / F.lit(least)), F.lit(shards))).otherwise(F.lit(shards))
    start = fragments.select(
        "__group",
        F.pmod(F.xxhash64("__group") + F.pmod(F.xxhash64("__part"), needed), F.lit(shards)).cast("int").alias("shard"),
        (F.col("copies") > least).alias("big"),
        "n",
    ).groupBy("__group", "shard", "big").agg(F.sum("n").alias("n"))
    placed, _ = propagate(materialise(start, "cells"), quotas, rounds)
    places = placed.groupBy("__group").agg(
        F.sort_array(F.collect_list(F.struct("shard", "n"))).alias("places")  # at most one entry a shard
    )
    offset = Window.partitionBy("__group").orderBy("__part").rowsBetween(Window.unboundedPreceding, -1)
    starts = fragments.select("__group", "__part", "copies", F.coalesce(F.sum("n").over(offset), F.lit(0)).alias("first"))
    starts = starts.join(places, "__group")

    within = F.row_number().over(Window.partitionBy("__group", "__part").orderBy("doc_id")) - 1
    linked = keyed.join(starts, ["__group", "__part"]).withColumn("rank", F.col("first") + within)
    shard_of = F.aggregate(
        "places",
        F.struct(F.lit(0).cast("long").alias("sum"), F.lit(-1).alias("shard")),
        lambda state, x: F.struct(
            (state["sum"] + x["n"]).alias("sum"),
            F.when((state["shard"] < 0) & (F.col("rank") < state["sum"] + x["n"]), x["shard"]).otherwise(state["shard"]).alias("shard"),
        ),
    )["shard"]
    # the order in which rows keep their places: group by group in cells of about `cells` rows, a big group's last
    columns, most = ["doc_id", "size", "text_crc32", "__group"], cells // shards + 2
    whole = F.pmod(F.xxhash64("__group", F.lit(-1)), F.lit(cells)) * most + F.pmod("__part", F.ceil(F.col("copies") / F.lit(cells)))
    order = F.when(F.col("copies") > least, cells * most + F.col("__part")).otherwise(whole)
    held = linked.select(*columns, shard_of.alias("wanted"), order.cast("int").alias("__part"))
    single = keyed.join(linked_groups.select("__group"), "__group", "left_anti").select(*columns, F.lit(shards).alias("wanted"), "__part")
    return _fill(materialise(held.unionByName(single), "wanted"), quotas, cells * (most + 1))


def _fill(docs: DataFrame, quotas: list[int], cells: int) -> DataFrame:
    """Exact quotas: a shard keeps its first places; what is over, and the rest, fills the gaps."""
    shards = len(quotas)
    wanted = {r["wanted"]: r["n"] for r in docs.groupBy("wanted").agg(F.count(F.lit(1)).alias("n")).collect()}
    kept = [min(wanted.get(s, 0), quotas[s]) for s in range(shards)]
    spill_before, spilled = [], wanted.get(shards, 0)
    for s in range(shards):
        spill_before.append(spilled)
        spilled += wanted.get(s, 0) - kept[s]
    gap_before, gaps = [], 0
    for s in range(shards):
        gap_before.append(gaps)
        gaps += quotas[s] - kept[s]

    ranked = row_numbers(docs, ["wanted"], F.col("__part"), [F.col("__group"), F.col("doc_id")], cells, "place")

    def pick(values: list[int], by: Column) -> Column:
        return F.element_at(F.array(*[F.lit(v).cast("long") for v in values]), by + 1)

    stays = (F.col("wanted") < shards) & (F.col("place") < pick([*kept, 0], F.col("wanted")))
    pool = F.when(F.col("wanted") == shards, F.col("place")).otherwise(
        pick([*spill_before, 0], F.col("wanted")) + F.col("place") - pick([*kept, 0], F.col("wanted"))
    )
    to = F.lit(-1)
    for s in range(shards):
        to = F.when(F.col("pool") >= gap_before[s], F.lit(s)).otherwise(to) if quotas[s] > kept[s] else to
    found = ranked.withColumn("pool", F.when(stays, F.lit(None).cast("long")).otherwise(pool))
    found = found.withColumn("shard", F.when(stays, F.col("wanted")).otherwise(to).cast("int"))
    slot = F.when(F.col("pool").isNull(), F.col("place")).otherwise(
        pick(kept, F.col("shard")) + F.col("pool") - pick(gap_before, F.col("shard"))
    )
    return found.withColumn("slot", slot.cast("long")).select("doc_id", "size", "text_crc32", "shard", "slot")


def cut(placed: DataFrame) -> DataFrame:
    """links, kept: of the copies beyond the first of each text, all, and those in their group's commonest shard.

    ``placed`` has text_crc32, size and shard; texts of one crc and size count as equal here."""
    cells = placed.groupBy("text_crc32", "size", "shard").agg(F.count(F.lit(1)).alias("n"))
    groups = cells.groupBy("text_crc32", "size").agg((F.sum("n") - 1).alias("links"), (F.max("n") - 1).alias("kept"))
    return groups.agg(F.coalesce(F.sum("links"), F.lit(0)).alias("links"), F.coalesce(F.sum("kept"), F.lit(0)).alias("kept"))


def op4_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    return assign(documents(spark, sf_dir).select("doc_id", "text")).select(
        "doc_id", "size", "text_crc32", F.lit("rows").alias("law"), "shard", "slot", F.lit(None).cast("int").alias("grown_shard")
    )

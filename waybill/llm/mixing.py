"""Mixing sources to target weights, by DataFrame operations only.

1. Every source gets a target: its weight's share of all words, at most
   ``max_repeats`` times its own size; what that cuts off goes to the others.
2. The whole is taken as equal-token blocks, and Sainte-Laguë apportionment
   gives them to sources by the highest quotients target / 1, / 3, / 5, ...
   A source whose target is below ``EXACT_BLOCKS`` blocks is not part of that:
   it gets its target in words, and the blocks left over go to the others.
3. Each source's blocks, or words, are apportioned over its shards in the same
   way. Shards hold about ``shard_words`` words, so a large source has many.
4. A shard lays its documents out in seeded order and takes its blocks from
   the front, as many rounds as the quota asks for. A document is taken whole
   in each round, except for the one in which the last block ends.

Targets rank one row per source. Quotas are found by counting quotients, so no
task holds all shards of a source; documents are summed up within their shard. NULL is a source of its own, behind all others. A
document without a word has size 0 and is not taken. Ids may repeat or be
NULL: order and shard come from a hash of seed, id and text, and rows equal in
all of that are interchangeable.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from waybill.llm.shared import SPACE, WORD, staged

WEIGHTS = (5, 2, 1)
MAX_REPEATS = 3
#: The size of a block; small inputs are cut into ``LEAST_BLOCKS`` smaller ones.
BLOCK_WORDS = 1024
LEAST_BLOCKS = 10_000
#: Below so many blocks a target is met in words.
EXACT_BLOCKS = 32
#: Ranges by which the quotients of a group are counted.
RANGES = 4_096
SHARD_WORDS = 1 << 20
SEED = 42


def sized(docs: DataFrame, seed: int = SEED, payload: Sequence[str] = ()) -> DataFrame:
    """doc_id, source, size in words and place in the seeded order, with ``payload``."""
    identity = F.concat_ws(
        ":",
        F.lit(str(seed)),
        F.coalesce(F.col("doc_id").cast("string"), F.lit("")),
        F.coalesce(F.col("text"), F.lit("")),
    )
    return docs.select(
        F.col("doc_id").alias("mix_id"),
        F.col("source").alias("mix_source"),
        F.coalesce(F.regexp_count("text", F.lit(WORD)), F.lit(0)).cast("long").alias("mix_size"),
        F.md5(identity).alias("mix_place"),
        *(F.col(name) for name in payload),
    )


def source_targets(
    documents: DataFrame, weights: Sequence[int] = WEIGHTS, max_repeats: int = MAX_REPEATS
) -> DataFrame:
    """One row per source: mix_source, number, source_size, target, words (of all sources).

    Targets rise in step with the weights until a source meets its limit, so
    the sources that stop are the first ones in the order of limit / weight.
    """
    every = Window.partitionBy(F.lit(0))
    by_name = every.orderBy(F.col("mix_source").asc_nulls_last())
    of_rank = F.array(*map(F.lit, weights))
    ranked = (
        documents.groupBy("mix_source")
        .agg(F.sum("mix_size").alias("source_size"))
        .withColumn("number", F.row_number().over(by_name) - 1)
        .withColumn("weight", F.get(of_rank, F.col("number") % len(weights)))
        .withColumn("limit", F.col("source_size") * max_repeats)
    )
    by_limit = every.orderBy(
        F.col("limit") / F.col("weight"), F.col("mix_source").asc_nulls_last()
    ).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    summed = ranked.select(
        "*",
        F.sum("source_size").over(every).alias("words"),
        (F.sum("limit").over(by_limit) - F.col("limit")).alias("limits_before"),
        (F.sum("weight").over(every) - F.sum("weight").over(by_limit) + F.col("weight")).alias(
            "weights_from"
        ),
    )
    at_limit = (
        F.col("limits_before") * F.col("weight") + F.col("limit") * F.col("weights_from")
        <= F.col("words") * F.col("weight")
    )
    stopped = summed.withColumn("stops", at_limit)
    left_words = F.col("words") - F.sum(F.when(F.col("stops"), F.col("limit")).otherwise(0)).over(every)
    left_weight = F.sum(F.when(F.col("stops"), 0).otherwise(F.col("weight"))).over(every)
    shared = stopped.select("*", left_words.alias("left_words"), left_weight.alias("left_weight"))
    open_target = F.col("weight") * F.col("left_words") / F.col("left_weight")
    return shared.select(
        "mix_source",
        "number",
        "source_size",
        F.when(F.col("stops"), F.col("limit").cast("double")).otherwise(open_target).alias("target"),
        "words",
    )


def apportion(parties: DataFrame, group: list[Column], votes: str, seats: str, tie: Column) -> DataFrame:
    """``parties`` with ``quota``: Sainte-Laguë's share of each group's ``seats``.

    Two divisors that give too few and too many seats bound the divisor that
    gives just as many, so no more than about two quotients per party are open;
    the rest of a party's seats are certain. Open quotients are counted by
    range, ``RANGES`` per group: ranges above the one where the seats run out
    win, and only the quotients inside of that range are ranked. So a task
    holds the ranges of a group, or one range's quotients, never all parties.
    Only equal quotients cannot be parted by range; ``tie``, one value per
    party of a group, decides among them. ``parties`` is read several times.
    """
    party = ["group_key", "tie_key"]
    keyed = parties.select("*", *(c.alias("group_key") for c in group), tie.alias("tie_key"))
    totals = keyed.groupBy("group_key").agg(
        F.sum(votes).alias("all_votes"),
        F.sum(F.when(F.col(votes) > 0, 0.5).otherwise(0.0)).alias("half"),
    )
    share = F.col(votes) / F.col("all_votes")
    some = F.col("all_votes") > 0
    fewest = F.greatest(F.lit(0), F.floor(share * (F.col(seats) - F.col("half")) + 0.5))
    most = F.floor(share * (F.col(seats) + F.col("half")) + 0.5)
    bounds = keyed.join(totals, "group_key").withColumns(
        {
            "certain": F.when(some, fewest).otherwise(F.lit(0)),
            "possible": F.when(some, most).otherwise(F.lit(0)),
        }
    )
    left = bounds.groupBy("group_key").agg((F.max(seats) - F.sum("certain")).alias("open"))
    asked = F.sequence(F.col("certain") + 1, F.col("possible"))
    quotients = (
        bounds.filter("possible > certain")
        .select(*party, F.col(votes).alias("own_votes"), F.explode(asked).alias("seat"))
        .withColumn("quotient", F.col("own_votes") / (2 * F.col("seat") - 1))
    )
    ends = quotients.groupBy("group_key").agg(
        F.min("quotient").alias("low"), F.max("quotient").alias("high")
    )
    below = (F.col("high") - F.col("quotient")) / (F.col("high") - F.col("low")) * RANGES
    ranged = quotients.join(ends, "group_key").select(
        *party,
        "seat",
        "quotient",
        F.when(F.col("high") > F.col("low"), F.floor(below)).otherwise(F.lit(0)).alias("range"),
    )
    counts = ranged.groupBy("group_key", "range").agg(F.count("*").alias("inside"))
    higher = Window.partitionBy("group_key").orderBy("range")
    before = F.coalesce(
        F.sum("inside").over(higher.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)
    )
    reached = (
        counts.withColumn("before", before)
        .join(left, "group_key")
        .filter("before < open")
        .select(
            "group_key",
            "range",
            (F.col("open") - F.col("before")).alias("room"),
            (F.col("before") + F.col("inside") <= F.col("open")).alias("whole"),
        )
    )
    found = ranged.join(reached, ["group_key", "range"])
    best = Window.partitionBy("group_key").orderBy(F.desc("quotient"), "tie_key", "seat")
    last = found.filter("NOT whole").withColumn("rank", F.row_number().over(best)).filter("rank <= room")
    won = found.filter("whole").select(party).unionByName(last.select(party))
    won = won.groupBy(party).agg(F.count("*").alias("won"))
    quota = F.col("certain") + F.coalesce("won", F.lit(0))
    return bounds.join(won, party, "left").select(*parties.columns, quota.alias("quota"))


def shard_quotas(
    documents: DataFrame,
    weights: Sequence[int] = WEIGHTS,
    max_repeats: int = MAX_REPEATS,
    block_words: int = BLOCK_WORDS,
    shard_words: int = SHARD_WORDS,
) -> DataFrame:
    """One row per source and shard: what the mix takes from it, in words.

    ``documents`` is a stored table as ``sized`` makes it. Columns mix_source,
    source_size, target, shards (of the source), shard, shard_size and goal.
    """
    every = Window.partitionBy(F.lit(0))
    block = F.col("words") / F.greatest(F.ceil(F.col("words") / block_words), F.lit(LEAST_BLOCKS))
    exact = F.col("target") < EXACT_BLOCKS * F.col("block")
    settled = F.when(F.col("exact"), F.col("target")).otherwise(0.0)
    targets = (
        source_targets(documents, weights, max_repeats)
        .withColumn("block", block)
        .withColumn("exact", exact)
        .withColumns(
            {
                "votes": F.col("target") - settled,
                "blocks": F.when(
                    F.col("words") > 0,
                    F.round((F.col("words") - F.sum(settled).over(every)) / F.col("block")),
                )
                .otherwise(0)
                .cast("long"),
                "shards": F.greatest(F.ceil(F.col("source_size") / shard_words), F.lit(1)),
                "all_sources": F.lit(0),
            }
        )
    )
    targets = staged(targets, "sources")
    by_source = (
        apportion(targets, [F.col("all_sources")], "votes", "blocks", F.col("number"))
        .withColumn(
            "source_quota",
            F.when(F.col("exact"), F.round("target").cast("long")).otherwise(F.col("quota")),
        )
        .withColumn("unit", F.when(F.col("exact"), 1.0).otherwise(F.col("block")))
        .drop("quota")
    )
    shards = (
        with_shard(documents, by_source)
        .groupBy(*by_source.columns, "shard")
        .agg(F.sum("mix_size").alias("shard_size"))
    )
    by_shard = apportion(
        staged(shards, "shards"), [F.col("number")], "shard_size", "source_quota", F.col("shard")
    )
    most = F.col("shard_size") * max_repeats
    goal = F.least(F.round(F.col("quota") * F.col("unit")).cast("long"), most)
    goals = by_shard.select(
        "mix_source", "source_size", "target", "shards", "shard", "shard_size", goal.alias("goal")
    )
    return staged(goals, "quotas")


def with_shard(documents: DataFrame, sources: DataFrame) -> DataFrame:
    """Documents with the columns of their source and their shard in it."""
    known = sources.withColumnRenamed("mix_source", "known_source")
    number = F.conv(F.substring("mix_place", 1, 15), 16, 10).cast("long")
    return (
        documents.join(known, F.col("mix_source").eqNullSafe(F.col("known_source")))
        .drop("known_source")
        .withColumn("shard", number % F.col("shards"))
    )


def take(documents: DataFrame, quotas: DataFrame) -> DataFrame:
    """Documents with what the mix takes of each.

    Adds source_size, target, shard, rounds (whole takes), part (words of one
    more, from its front) and taken (words, repeats counted).
    """
    sources = quotas.select("mix_source", "source_size", "target", "shards").distinct()
    goals = quotas.select(
        F.col("mix_source").alias("goal_source"),
        F.col("shard").alias("goal_shard"),
        "shard_size",
        "goal",
    )
    same = F.col("mix_source").eqNullSafe(F.col("goal_source")) & (
        F.col("shard") == F.col("goal_shard")
    )
    shard = Window.partitionBy("mix_source", "shard")
    before = shard.orderBy("mix_place", "mix_id").rowsBetween(Window.unboundedPreceding, -1)
    start = F.coalesce(F.sum("mix_size").over(before), F.lit(0))
    every = with_shard(documents, sources)
    # Documents without a word take no place; there may be very many in one shard.
    nothing = F.lit(0).cast("long")
    wordless = every.filter("mix_size <= 0").drop("shards")
    wordless = wordless.withColumns({"rounds": nothing, "part": nothing, "taken": nothing})
    placed = every.filter("mix_size > 0").withColumn("start", start)
    size, goal = F.col("mix_size"), F.col("goal")
    filled = F.col("shard_size") > 0
    rounds = F.when(filled, F.floor(goal / F.col("shard_size"))).otherwise(F.lit(0))
    over = F.when(filled, goal % F.col("shard_size")).otherwise(F.lit(0))
    part = F.greatest(F.lit(0), F.least(size, F.col("over") - F.col("start")))
    worded = (
        placed.join(goals, same)
        .withColumns({"rounds": rounds, "over": over})
        .withColumn("part", part)
        .withColumn("taken", F.col("rounds") * size + F.col("part"))
        .drop("goal_source", "goal_shard", "shard_size", "goal", "over", "start", "shards")
    )
    return worded.unionByName(wordless)


def mix(
    docs: DataFrame, weights: Sequence[int] = WEIGHTS, max_repeats: int = MAX_REPEATS, seed: int = SEED
) -> DataFrame:
    """doc_id, source, size, source_size, target and taken of every document."""
    documents = staged(sized(docs, seed), "sizes")
    return take(documents, shard_quotas(documents, weights, max_repeats)).select(
        F.col("mix_id").alias("doc_id"),
        F.col("mix_source").alias("source"),
        F.col("mix_size").alias("size"),
        "source_size",
        "target",
        "taken",
    )


def mixed_documents(
    docs: DataFrame, weights: Sequence[int] = WEIGHTS, max_repeats: int = MAX_REPEATS, seed: int = SEED
) -> DataFrame:
    """The rows of the mix with the columns of ``docs``: a row for each take of a document.

    Where the mix ends inside a document, that row's text ends there too and
    ``n_chars``, if there is such a column, counts what is left.
    """
    quotas = shard_quotas(staged(sized(docs, seed), "sizes"), weights, max_repeats)
    row = [F.struct(*(F.col(name) for name in docs.columns)).alias("mix_row")]
    packed = docs.select("doc_id", "source", "text", *row)
    taken = take(sized(packed, seed, ["mix_row"]), quotas).filter("taken > 0")
    copies = F.concat(
        F.array_repeat(F.lit(-1).cast("long"), F.col("rounds").cast("int")),
        F.when((F.col("part") > 0), F.array(F.col("part"))).otherwise(F.array().cast("array<long>")),
    )
    each = taken.select("mix_row", "mix_size", F.explode(copies).alias("words"))
    text = F.col("mix_row").getField("text")
    cut = (F.col("words") > 0) & (F.col("words") < F.col("mix_size"))
    pieces = F.split(text, f"(?<={SPACE})(?={WORD[:-1]})")
    lead = F.when(text.rlike(f"^{SPACE}"), 1).otherwise(0)
    front = F.array_join(F.slice(pieces, 1, (F.col("words") + lead).cast("int")), "")
    shown = F.when(cut, front).otherwise(text)
    columns = {name: F.col("mix_row").getField(name) for name in docs.columns}
    columns["text"] = shown
    if "n_chars" in columns:
        columns["n_chars"] = F.when(cut, F.length(shown).cast("long")).otherwise(columns["n_chars"])
    return each.select(*(value.alias(name) for name, value in columns.items()))


#: What ``mix`` returns over the view ``documents``.
SQL = f"""
WITH sized AS (
  SELECT doc_id, source,
    CAST(coalesce(len(regexp_extract_all(text, '[^\x20\x09-\x0D]+')), 0) AS BIGINT) AS size,
    md5('{SEED}:' || coalesce(CAST(doc_id AS VARCHAR), '') || ':' || coalesce(text, '')) AS place
  FROM documents
),
ranked AS (
  SELECT source, CAST(sum(size) AS BIGINT) AS source_size,
    CASE (row_number() OVER (ORDER BY encode(source) NULLS LAST) - 1) % 3
      WHEN 0 THEN 5 WHEN 1 THEN 2 ELSE 1 END AS weight
  FROM sized GROUP BY source
),
summed AS (
  SELECT *, {MAX_REPEATS} * source_size AS most, sum(source_size) OVER () AS words,
    coalesce(sum({MAX_REPEATS} * source_size) OVER below, 0) AS before,
    sum(weight) OVER () - coalesce(sum(weight) OVER below, 0) AS weights_from
  FROM ranked
  WINDOW below AS (ORDER BY {MAX_REPEATS} * source_size / weight, encode(source) NULLS LAST
    ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)
),
stopped AS (
  SELECT *, before * weight + most * weights_from <= words * weight AS stops FROM summed
),
targets AS (
  SELECT source, source_size, words,
    CASE WHEN stops THEN CAST(most AS DOUBLE)
      ELSE CAST(weight * (words - coalesce(sum(most) FILTER (stops) OVER (), 0)) AS DOUBLE)
        / CAST(sum(weight) FILTER (NOT stops) OVER () AS DOUBLE) END AS target,
    words / greatest(ceil(words / {BLOCK_WORDS}), {LEAST_BLOCKS}) AS block,
    CAST(greatest(ceil(source_size / {SHARD_WORDS}), 1) AS BIGINT) AS shards
  FROM stopped
),
settled AS (
  SELECT *, target < {EXACT_BLOCKS} * block AS exact,
    words - coalesce(sum(target) FILTER (target < {EXACT_BLOCKS} * block) OVER (), 0) AS open_words
  FROM targets
),
voters AS (
  SELECT source, target, sum(target) OVER () AS votes, count(*) OVER () AS voters,
    CAST(round(open_words / block) AS BIGINT) AS blocks
  FROM settled WHERE NOT exact AND words > 0 AND target > 0
),
source_seats AS (
  SELECT source, CAST(count(seat) AS BIGINT) AS quota FROM (
    SELECT source, seat, row_number() OVER (
      ORDER BY target / (2 * seat - 1) DESC, encode(source) NULLS LAST, seat) AS place, blocks
    FROM (SELECT source, target, blocks, unnest(range(1,
      CAST(floor(target / votes * (blocks + 0.5 * voters) + 0.5) AS BIGINT) + 1)) AS seat FROM voters)
  ) WHERE place <= blocks GROUP BY source
),
placed AS (
  SELECT s.*, t.source_size, t.target, CASE WHEN t.exact THEN 1.0 ELSE t.block END AS block,
    CASE WHEN t.exact THEN CAST(round(t.target) AS BIGINT) ELSE coalesce(q.quota, 0) END AS quota,
    CAST('0x' || substr(s.place, 1, 15) AS BIGINT) % t.shards AS shard
  FROM sized s JOIN settled t ON s.source IS NOT DISTINCT FROM t.source
  LEFT JOIN source_seats q ON s.source IS NOT DISTINCT FROM q.source
),
cells AS (
  SELECT source, shard, any_value(quota) AS quota, any_value(block) AS block,
    any_value(source_size) AS source_size, CAST(sum(size) AS BIGINT) AS shard_size,
    count(*) OVER (PARTITION BY source) AS neighbours
  FROM placed GROUP BY source, shard
),
cell_seats AS (
  SELECT source, shard, CAST(count(seat) AS BIGINT) AS quota FROM (
    SELECT source, shard, seat, quota, row_number() OVER (PARTITION BY source
      ORDER BY CAST(shard_size AS DOUBLE) / (2 * seat - 1) DESC, shard, seat) AS place
    FROM (SELECT *, unnest(range(1, CAST(floor(
      shard_size / source_size * (quota + 0.5 * neighbours) + 0.5) AS BIGINT) + 1)) AS seat
      FROM cells WHERE shard_size > 0)
  ) WHERE place <= quota GROUP BY source, shard
),
goals AS (
  SELECT c.source, c.shard, c.shard_size, least(CAST(round(coalesce(s.quota, 0) * block) AS BIGINT),
    {MAX_REPEATS} * shard_size) AS goal
  FROM cells c LEFT JOIN cell_seats s
    ON c.source IS NOT DISTINCT FROM s.source AND c.shard = s.shard
),
laid AS (
  SELECT p.*, g.shard_size, g.goal, coalesce(sum(size) OVER (PARTITION BY p.source, p.shard
    ORDER BY place, doc_id ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS start
  FROM placed p JOIN goals g ON p.source IS NOT DISTINCT FROM g.source AND p.shard = g.shard
)
SELECT doc_id, source, size, source_size, target,
  CASE WHEN shard_size = 0 THEN 0 ELSE CAST((goal // shard_size) * size
    + greatest(0, least(size, goal % shard_size - start)) AS BIGINT) END AS taken
FROM laid
"""

"""Mixing sources to target weights by temperature, with DataFrame operations only.

A source's weight is its share of all tokens to a power between 0 (all alike) and 1 (as they
are).  The power is found by bisection: the nearest to 1 whose weights reach a wanted
entropy, or the smallest that keeps the ratio of the most to the least repeated source within a
limit.  The weights become whole numbers of tokens per source; a source's documents follow each
other in keyed permutations, one per pass, and are cut into blocks that all hold the sources
in the same proportion.
"""

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from platewatch.llm.common import free_name, stored

# Powers are multiples of 1 / 2 ** LEVELS; one job settles so many levels of the bisection.
LEVELS = 20
LEVELS_A_JOB = 5
BLOCK_TOKENS = 1_000_000
# A source's permutation is laid out in pieces of about so many tokens, so no task sorts a whole source: by the
# first hexadecimal digits of a document's key, as many as the largest source needs and at least the minimum.
PIECE_TOKENS = 4_000_000
LEAST_DIGITS = 3
MOST_DIGITS = 8
REPEAT_LIMIT = 2.0
SEED = 5


def token_count(text: Column) -> Column:
    """Words between white space, and one for the end of the text; 1 for null and empty texts."""
    return (F.coalesce(F.regexp_count(text, F.lit(r"[^\x20\x09-\x0D]+")), F.lit(0)) + 1).cast("long")


def source_key(source: Column) -> Column:
    """Not null, and different for a null and an empty source."""
    return F.when(source.isNull(), "-").otherwise(F.concat(F.lit("+"), source.cast("string")))


def find_power(sources: DataFrame, entropy: float | None = None, repeat_limit: float | None = REPEAT_LIMIT) -> float:
    """The power for a table with one row and a positive ``tokens`` per source.

    ``entropy`` (nats) takes the largest power that reaches it, 0 if none does; otherwise the smallest
    power that keeps the repetition ratio within ``repeat_limit`` (at least 1).
    """
    total, count = sources.agg(F.sum("tokens"), F.count("*")).first()
    if not count:
        return 1.0
    low, high = -1, 1 << LEVELS  # the power 1 always keeps the ratio; -1 stands for none known
    if entropy is not None and _flat_enough(sources, total, [high], entropy, None)[high]:
        return 1.0
    while high - low > 1:
        parts = 1 << LEVELS_A_JOB
        nodes = sorted({low + (high - low) * i // parts for i in range(1, parts)} - {low, high}) or [low + 1]
        holds = _flat_enough(sources, total, nodes, entropy, repeat_limit)
        for node in nodes:
            if entropy is not None and holds[node]:
                low = max(low, node)
            elif entropy is None and not holds[node]:
                low = max(low, node)
        high = min([n for n in nodes if n > low] + [high])
    return max(low, 0) / (1 << LEVELS) if entropy is not None else high / (1 << LEVELS)


def _flat_enough(sources, total, nodes, entropy, repeat_limit):
    """For each power, in units of 2 ** -LEVELS, whether its weights meet the target."""
    power = F.col("node") / F.lit(float(1 << LEVELS))
    share = F.log(F.col("tokens") / F.lit(float(total)))
    rows = sources.select("tokens", F.explode(F.array(*[F.lit(n) for n in nodes])).alias("node"))
    weight = F.exp(power * share)
    if entropy is not None:
        mass, drawn = F.sum(weight), F.sum(weight * power * share)
        test = F.log(mass) - drawn / mass >= entropy - 1e-12
    else:
        spread = F.log(F.max("tokens") / F.min("tokens"))
        test = (1 - F.max(power)) * spread <= F.log(F.lit(float(repeat_limit)))
    return {r["node"]: r["holds"] for r in rows.groupBy("node").agg(test.alias("holds")).collect()}


def source_plan(sources: DataFrame, budget_tokens: int | None = None, **target) -> DataFrame:
    """source key, tokens, weight, quota (tokens to draw) and passes per source.

    Without a budget the total is the smallest that draws every document at least once.
    """
    power = find_power(sources, **target)
    raw = F.pow(F.col("tokens") / F.sum("tokens").over(Window.partitionBy()), F.lit(power))
    weighted = sources.withColumn("raw", raw).withColumn("weight", F.col("raw") / F.sum("raw").over(Window.partitionBy()))
    whole = F.max(F.col("tokens") / F.col("weight")).over(Window.partitionBy())
    budget = whole if budget_tokens is None else F.lit(float(budget_tokens))
    quota = F.round(F.col("weight") * budget).cast("long")
    return weighted.withColumn("quota", quota).select(
        "_source", "tokens", "weight", "quota", F.ceil(F.col("quota") / F.col("tokens")).alias("passes")
    )


def piece_digits(tokens: int) -> int:
    """How many digits cut a source of so many tokens into small enough pieces."""
    digits = LEAST_DIGITS
    while digits < MOST_DIGITS and tokens > PIECE_TOKENS * 16**digits:
        digits += 1
    return digits


def mixed(
    docs: DataFrame,
    source: str = "source",
    budget_tokens: int | None = None,
    block_tokens: int = BLOCK_TOKENS,
    columns: list[str] | None = None,
    seed: int = SEED,
    **target,
) -> DataFrame:
    """Documents drawn to the target weights: their columns, then epoch, block, slot, n_tokens.

    ``epoch`` counts the passes over the source, ``slot`` orders a block.  The last document of a quota is
    drawn whole.  A null source is a source of its own; null and empty texts count one
    token.  Repeated rows are drawn as often as they come.  New columns whose names are taken get a
    trailing underscore.  No documents give no rows.
    """
    columns = docs.columns if columns is None else columns
    epoch, block, slot, n = (free_name(docs, c) for c in ("epoch", "block", "slot", "n_tokens"))
    names = ("_source", "_row", "_who", "_texthash", "_order", "_piece", "_start", "_quota", "_passes")
    src, row, who, hashed, order, piece, start, quota, passes = (free_name(docs, c) for c in names)
    text_hash = F.xxhash64("text")
    # Rows are numbered and written once; from there only numbers and keys go through the windows, and each
    # row's own columns meet their place at the end.
    base = stored(
        docs.select(
            *columns,
            source_key(F.col(source)).alias(src),
            token_count(F.col("text")).alias(n),
            text_hash.alias(hashed),
            F.coalesce(F.col("doc_id").cast("long"), text_hash).alias(who),
            F.monotonically_increasing_id().alias(row),
        ),
        "rows",
    )
    light = set(columns) <= {"doc_id", source}
    small = base if light else base.select(src, n, hashed, who, row)
    totals = stored(small.groupBy(F.col(src).alias("_source")).agg(F.sum(n).alias("tokens")), "sources")
    plan = stored(source_plan(totals, budget_tokens, **target), "plan")
    whole, largest = plan.agg(F.sum("quota"), F.max("tokens")).first()
    blocks = max(1, round((whole or 0) / block_tokens))
    digits = piece_digits(largest or 0)

    # Every document once per pass, with the place its key gives it.
    rows = small.join(plan.select(F.col("_source").alias(src), F.col("passes").alias(passes)), src)
    rows = rows.withColumn(epoch, F.explode(F.sequence(F.lit(0), (F.col(passes) - 1).cast("int")))).drop(passes)
    key = F.md5(F.concat_ws("/", F.lit(seed), F.col(epoch), F.col(who), F.col(n)))
    rows = rows.withColumn(order, key).withColumn(piece, F.substring(order, 1, digits))

    sums = rows.groupBy(src, epoch, piece).agg(F.sum(n).alias(start))
    before = Window.partitionBy(src, epoch).orderBy(piece).rowsBetween(Window.unboundedPreceding, -1)
    sums = sums.join(plan.select(F.col("_source").alias(src), "tokens", F.col("quota").alias(quota)), src).select(
        src, epoch, piece, quota,
        (F.col(epoch) * F.col("tokens") + F.coalesce(F.sum(start).over(before), F.lit(0))).alias(start),
    )
    inside = Window.partitionBy(src, epoch, piece).orderBy(order, hashed)
    earlier = F.coalesce(F.sum(n).over(inside.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    rows = rows.join(sums, [src, epoch, piece]).withColumn(start, F.col(start) + earlier)
    rows = rows.where(F.col(start) < F.col(quota))
    place = F.floor(F.col(start).cast("double") / F.col(quota) * F.lit(blocks))
    rows = rows.withColumn(block, F.least(place, F.lit(blocks - 1)).cast("long"))
    # The later half of the key is independent of the place that its beginning gave.
    line = Window.partitionBy(block).orderBy(F.substring(order, 17, 16), src, hashed)
    rows = rows.withColumn(slot, (F.row_number().over(line) - 1).cast("long"))
    if not light:
        rows = rows.select(row, epoch, block, slot, n).join(base.select(row, *columns), row)
    return rows.select(*columns, epoch, block, slot, n)


# The same rows; the power in closed form, as the ratio of repetitions has one.
ORACLE = rf"""
WITH counted AS (
  SELECT doc_id, source, CASE WHEN source IS NULL THEN '-' ELSE '+' || source END AS src,
         coalesce(len(regexp_extract_all(text, '[^\x20\x09-\x0D]+')), 0) + 1 AS n
  FROM documents),
totals AS (SELECT src, sum(n)::BIGINT AS tokens FROM counted GROUP BY src),
power AS (
  SELECT CASE WHEN max(tokens) = min(tokens) THEN 0
              ELSE greatest(0, ceil({1 << LEVELS} * (1 - ln({REPEAT_LIMIT}) / ln(max(tokens) / min(tokens))))) / {1 << LEVELS} END AS p
  FROM totals),
raw AS (SELECT src, tokens, pow(tokens / sum(tokens) OVER (), p) AS r FROM totals, power),
weighted AS (SELECT src, tokens, r / sum(r) OVER () AS w FROM raw),
quotas AS (SELECT src, tokens, round(w * max(tokens / w) OVER ())::BIGINT AS quota FROM weighted),
drawn AS (
  SELECT c.doc_id, c.source, c.src, c.n, e.epoch, q.tokens, q.quota,
         md5(concat_ws('/', {SEED}, e.epoch, c.doc_id, c.n)) AS k
  FROM counted c JOIN quotas q USING (src), LATERAL (SELECT unnest(range(ceil(q.quota / q.tokens)::BIGINT)) AS epoch) e),
placed AS (
  SELECT *, epoch * tokens + coalesce(sum(n) OVER (PARTITION BY src, epoch ORDER BY k ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS start
  FROM drawn),
size AS (SELECT greatest(1, round(sum(quota) / {BLOCK_TOKENS})) AS blocks FROM quotas),
cut AS (
  SELECT doc_id, source, src, epoch, n, k,
         least(floor(start::DOUBLE / quota * blocks), blocks - 1)::BIGINT AS block
  FROM placed, size WHERE start < quota)
SELECT doc_id, source, epoch::INTEGER AS epoch, block, n::BIGINT AS n_tokens,
       row_number() OVER (PARTITION BY block ORDER BY substring(k, 17, 16), src) - 1 AS slot
FROM cut
"""

"""Mixing sources by temperature, with DataFrame operations only.

Shares of tokens are raised to an exponent between 0 and 1 and normalised. The
exponent is bisected: the largest whose weights reach a target entropy, but not so
small that a source is repeated more often than allowed. The weights are then realised
for a budget of tokens: the documents of a source are dealt to blocks, each epoch goes
through the blocks and through each block in an order of its own, and the last epoch
stops when the source's quota is reached. Every copy gets a place in the mix, so that
all sources run evenly from its beginning to its end.

The entropy needs only the number of sources for each number of tokens; that list,
which has at most about sqrt(2 * tokens) entries, is one row of the plan.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window

from penprint.session import staged

ENTROPY_SHARE = 0.9
MOST_REPEATS = 8.0
BLOCK_TOKENS = 131_072
STEPS = 60
WORD = "[^ \\t\\n\\x0B\\f\\r]+"

# exponent, and the sum of the powers, from the totals t (one entry per number of tokens:
# n tokens, c sources), all tokens, and all sources
_EXPONENT = """
aggregate(sequence(1, {steps}), named_struct('lo', double(0), 'hi', double(1)), (s, i) ->
  if({holds}, named_struct('lo', (s.lo + s.hi) / 2, 'hi', s.hi), named_struct('lo', s.lo, 'hi', (s.lo + s.hi) / 2)))
"""
_ENTROPY = """
aggregate(t, named_struct('z', double(0), 'w', double(0)), (a, x) -> named_struct(
  'z', a.z + x.c * pow(x.n / total, {e}), 'w', a.w + x.c * pow(x.n / total, {e}) * ln(x.n / total)),
  a -> ln(a.z) - {e} * a.w / a.z)
"""


def tokens_of(text: Column) -> Column:
    """Number of words of a text; null has none."""
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")


def source_key(source: Column) -> Column:
    """A text that tells a null source from every other."""
    return F.coalesce(F.concat(F.lit("s"), source.cast("string")), F.lit("n"))


def source_weights(
    sizes: DataFrame,
    entropy_share: float = ENTROPY_SHARE,
    most_repeats: float = MOST_REPEATS,
    budget: int | None = None,
) -> DataFrame:
    """Weight, quota of tokens and blocks of each source. ``sizes``: key, n (its tokens, over 0).

    ``budget``: tokens of the mix; without one it is the smallest with which every
    source is used in full at least once. Without any source the result is empty.
    """
    by_size = sizes.groupBy("n").agg(F.count("*").alias("c"))
    # four numbers reach the driver
    one = by_size.agg(
        F.sort_array(F.collect_list(F.struct("n", "c"))).alias("t"),
        F.sum(F.col("n") * F.col("c")).cast("double").alias("total"),
        F.sum("c").cast("double").alias("sources"),
        F.max("n").cast("double").alias("largest"),
        F.min("n").cast("double").alias("smallest"),
    ).where("sources > 0")
    middle = "((s.lo + s.hi) / 2)"
    target = f"{entropy_share} * ln(sources)"
    one = one.withColumn(
        "by_entropy",
        F.expr(
            f"if({_ENTROPY.format(e='double(1)')} >= {target}, double(1), "
            + _EXPONENT.format(steps=STEPS, holds=f"{_ENTROPY.format(e=middle)} >= {target}")
            + ".lo)"
        ),
    )
    if budget is None:
        # repeats go from 1 for the largest source to (largest / smallest) ** (1 - e)
        repeats = f"pow(largest / smallest, 1 - {middle})"
    else:
        # the smallest source is repeated most
        powers = f"aggregate(t, double(0), (a, x) -> a + x.c * pow(x.n / total, {middle}))"
        repeats = f"{float(budget)} * pow(smallest / total, {middle}) / {powers} / smallest"
    one = one.withColumn(
        "by_repeats", F.expr(_EXPONENT.format(steps=STEPS, holds=f"{repeats} > {float(most_repeats)}") + ".hi")
    )
    one = one.withColumn("exponent", F.expr(f"if({_holds_at_zero(budget, most_repeats)}, by_entropy, greatest(by_entropy, by_repeats))"))
    one = one.withColumn(
        "powers", F.expr("aggregate(t, double(0), (a, x) -> a + x.c * pow(x.n / total, exponent))")
    )
    tokens = (
        F.lit(float(budget))
        if budget is not None
        else F.expr("largest / (pow(largest / total, exponent) / powers)")
    )
    found = one.select("total", "exponent", "powers", tokens.alias("budget")).first()
    total, exponent, powers, tokens = found or (1.0, 1.0, 1.0, 0.0)
    share = F.pow(F.col("n") / F.lit(total), F.lit(exponent)) / F.lit(powers)
    return sizes.select(
        "key",
        "n",
        F.lit(exponent).alias("exponent"),
        share.alias("weight"),
        F.round(F.lit(tokens) * share).cast("long").alias("quota"),
        F.round(F.lit(tokens)).cast("long").alias("budget"),
    )


def _holds_at_zero(budget: int | None, most_repeats: float) -> str:
    """SQL: the limit on repeats holds even with equal weights."""
    if budget is None:
        return f"largest / smallest <= {float(most_repeats)}"
    return f"{float(budget)} / sources / smallest <= {float(most_repeats)}"


def _order(*parts: Column) -> Column:
    return F.md5(F.concat_ws("|", *[F.coalesce(p.cast("string"), F.lit("")) for p in parts]))


def mix(
    docs: DataFrame,
    entropy_share: float = ENTROPY_SHARE,
    most_repeats: float = MOST_REPEATS,
    budget: int | None = None,
    block_tokens: int = BLOCK_TOKENS,
) -> DataFrame:
    """All copies of documents that make up the mix.

    ``docs`` needs ``doc_id``, ``text`` and ``source``; all columns are passed on, with
    those below added (they replace columns of the same names). A null source is a
    source of its own. A document is taken when its first token is within the quota of
    its source; one without tokens when its place is. A source without any token has no
    weight and is left out. Repeated rows count as documents of their own.

    mix_tokens: words; mix_epoch: number of the copy, from 0; mix_block: block of the
    source; mix_place: block of the mix, from 0 to its number of blocks.
    """
    added = ["mix_tokens", "mix_epoch", "mix_block", "mix_place"]
    own = [c for c in docs.columns if c not in added]
    p = "mix_"
    while any(c.startswith(p) for c in own):
        p = "_" + p
    tokens, key, n, quota, start = (f"{p}{c}" for c in ("tokens", "key", "n", "quota", "start"))
    epoch, block = f"{p}epoch", f"{p}block"
    rows = docs.select(
        *own, tokens_of(F.col("text")).alias(tokens), source_key(F.col("source")).alias(key)
    )
    sizes = staged(
        rows.groupBy(F.col(key).alias("key")).agg(F.sum(tokens).alias("n")).where("n > 0"), "sizes"
    )
    weights = staged(source_weights(sizes, entropy_share, most_repeats, budget), "weights")
    per_source = weights.select(
        F.col("key").alias(key),
        F.col("n").alias(n),
        F.col("quota").alias(quota),
        F.ceil(F.col("n") / block_tokens).alias(f"{p}blocks"),
        F.ceil(F.col("budget") / block_tokens).alias(f"{p}places"),
    )
    number = F.conv(F.substring(_order(F.col("doc_id")), 1, 15), 16, 10).cast("long")
    dealt = rows.join(per_source, key).withColumn(block, number % F.col(f"{p}blocks"))
    last = F.floor((F.col(quota) - 1) / F.col(n))
    epochs = F.sequence(F.lit(0).cast("long"), F.greatest(last, F.lit(0)).cast("long"))

    # where each block of each epoch starts
    blocks = dealt.groupBy(key, n, quota, block).agg(F.sum(tokens).alias("size"))
    blocks = blocks.select("*", F.explode(epochs).alias(epoch))
    earlier = (
        Window.partitionBy(key, epoch)
        .orderBy(_order(F.col(key), F.col(epoch), F.col(block)), block)
        .rowsBetween(Window.unboundedPreceding, -1)
    )
    before = F.coalesce(F.sum("size").over(earlier), F.lit(0))
    starts = staged(
        blocks.select(key, epoch, block, (F.col(epoch) * F.col(n) + before).alias(start)), "blocks"
    )

    copies = dealt.select("*", F.explode(epochs).alias(epoch))
    inside = (
        Window.partitionBy(key, epoch, block)
        .orderBy(_order(F.col("doc_id"), F.col(epoch)), "doc_id")
        .rowsBetween(Window.unboundedPreceding, -1)
    )
    placed = (
        copies.join(starts, [key, epoch, block])
        .withColumn(start, F.col(start) + F.coalesce(F.sum(tokens).over(inside), F.lit(0)))
        .where(F.col(start) < F.col(quota))
    )
    place = F.floor(F.col(start).cast("double") / F.col(quota) * F.col(f"{p}places"))
    found = (F.col(tokens), F.col(epoch), F.col(block), place.cast("long"))
    return placed.select(*own, *[c.alias(name) for c, name in zip(found, added)])

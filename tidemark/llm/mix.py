"""Mixtures of sources by target weights."""

from __future__ import annotations

from collections.abc import Sequence
from math import gcd

import numpy as np
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tidemark.llm.encode import DEFAULT_VOCAB, encode_texts
from tidemark.session import written


SHARD_TOKENS = 20_000_000
GROUP_SHARDS = 512  # shards one level of the splitting deals to at most
MOST_BROADCAST = 100_000  # rows of a table of block uses that is broadcast at most


def splitting_tree(quota: Sequence[int], shards: int, rng: np.random.Generator) -> np.ndarray:
    """Blocks of each source in each shard: array (shards, sources) whose columns sum to ``quota``.

    Every node splits its exact quotas between two halves of its shards by one multivariate
    hypergeometric draw, as dealing a shuffled deck would; shard sizes differ by one block at most.
    """
    quota = np.asarray(quota, np.int64)
    out = np.zeros((shards, len(quota)), np.int64)
    size = np.full(shards, quota.sum() // shards)
    size[: int(quota.sum() % shards)] += 1
    stack = [(0, shards, quota)]
    while stack:
        a, b, have = stack.pop()
        if b - a == 1:
            out[a] = have
            continue
        mid = (a + b) // 2
        left = rng.multivariate_hypergeometric(have, int(size[a:mid].sum()), method="marginals")
        stack += [(a, mid, left), (mid, b, have - left)]
    return out


def levels(shards: int) -> tuple[int, int]:
    """``(groups, shards of a group)`` whose product is at least ``shards``: one group unless there are more than GROUP_SHARDS."""
    if shards <= GROUP_SHARDS:
        return 1, shards
    groups = -(-shards // GROUP_SHARDS) if shards <= GROUP_SHARDS**2 else int(np.ceil(np.sqrt(shards)))
    return groups, -(-shards // groups)


def _permutation(n: int, rng: np.random.Generator) -> tuple[int, int]:
    """``(a, c)`` of the permutation b -> (a * b + c) mod n."""
    a = int(rng.integers(1, n)) if n > 1 else 1
    while gcd(a, n) != 1:
        a = a % n + 1
    return a, int(rng.integers(0, n))


def token_sizes(docs: DataFrame, *, key: str, text: str, source: str, vocab: str = DEFAULT_VOCAB) -> DataFrame:
    """key, source (trimmed, lower case; blank is null) and n_tokens of every row."""
    s = F.lower(F.regexp_replace(F.col(source), r"^\s+|\s+$", ""))
    src = docs.select(F.col(key), F.when(s != "", s).alias("source"), F.col(text).alias("text"))
    return encode_texts(src, key=key, text="text", vocab=vocab, ids=False, counts=True, keep=("source",))


def mix_sources(
    sizes: DataFrame, targets: DataFrame, *, key: str, total: int | None = None, shards: int | None = None, blocks: int | None = None, tries: int = 32, seed: int = 0, max_sources: int = 1000
) -> DataFrame:
    """The mixture: shard, position, key, source, copy_no, n_tokens; one row per use of a row.

    ``sizes`` has key, source, n_tokens (see :func:`token_sizes`; it is read twice, so pass a
    written table), ``targets`` source, target_share and max_repeat.

    * ``total`` tokens are shared out by target_share. By default as many as possible while every
      source can give its share: the least of max_repeat * tokens / share. With a larger total a
      source that runs out gives all it may, and the reported shares show it.
    * Rows of a source fall into blocks by a hash of the key. The quota of a source is the number
      of its blocks whose tokens come nearest its share, in the best of ``tries`` random orders; after all blocks were
      used once a second copy starts, and so on up to max_repeat copies. The quotas are split among
      ``shards`` by :func:`splitting_tree`; each shard takes its own stretch of the permuted blocks,
      and its rows are shuffled within it (position from 1).
    * Without ``shards`` there are as many as give each SHARD_TOKENS tokens, 64 at least: a shard is sorted in one task. More than
      GROUP_SHARDS are dealt in two levels: blocks to groups, and the uses of a group, in blocks of another hash, to its
      shards by a tree of its own; ``shards`` is then rounded up to a multiple of the groups.
    * Rows of null or unlisted sources have no share and rows of no tokens no size: they are
      not drawn. A source without rows can't be repeated into being: its share stays 0 and doesn't
      bound the total. Null or negative shares and repeats below 1 count 0. Empty tables give an
      empty mixture. Equal rows are rows of their own.

    The driver holds (sources x blocks) sums and uses, and (GROUP_SHARDS x sources) quotas, whatever the data; ``blocks`` is by default 4,096, and less beyond
    100 sources, so that there are at most 409,600. They are broadcast if they are MOST_BROADCAST rows at most. ``max_sources`` bounds the target table; more raise ValueError.
    """
    spark = sizes.sparkSession
    goal = targets.where(F.col("source").isNotNull() & (F.col("target_share") > 0) & (F.col("max_repeat") >= 1))
    goal = goal.groupBy("source").agg(F.max("target_share").alias("share"), F.max("max_repeat").alias("repeat")).limit(max_sources + 1).collect()
    if len(goal) > max_sources:
        raise ValueError(f"more than {max_sources} target sources")
    goal = sorted(goal, key=lambda r: r.source)
    names = [r.source for r in goal]
    blocks = blocks or min(4096, 409_600 // max(1, len(names)))
    block = F.pmod(F.xxhash64(F.col(key), F.lit(seed)), F.lit(blocks)).cast("int")
    usable = sizes.where(F.col("source").isin(names) & (F.col("n_tokens") > 0)).withColumn("_block", block)
    sums = usable.groupBy("source", "_block").agg(F.sum("n_tokens").alias("tokens")).collect() if names else []
    rng = np.random.default_rng(seed)
    per = {n: np.zeros(blocks, np.int64) for n in names}
    for r in sums:
        per[r.source][r._block] = r.tokens
    have = {n: int(per[n].sum()) for n in names}
    if total is None:
        total = int(min((r.repeat * have[r.source] / r.share for r in goal if have[r.source]), default=0))
    quota, order = [], []
    for r in goal:
        want = min(total * r.share, r.repeat * have[r.source])
        passes, rest = divmod(want, have[r.source]) if have[r.source] else (0, 0)
        best = None
        for _ in range(tries):
            a, c = _permutation(blocks, rng)
            permuted = np.zeros(blocks, np.int64)
            permuted[(a * np.arange(blocks) + c) % blocks] = per[r.source]
            miss = np.abs(np.append(0, np.cumsum(permuted)) - rest)
            if best is None or miss.min() < best[0]:
                best = (miss.min(), int(miss.argmin()), a, c)
        quota.append(int(passes) * blocks + best[1])
        order.append(best[2:])
    groups, within = levels(shards or max(64, total // SHARD_TOKENS))
    n_first = within if groups == 1 else groups
    deal = splitting_tree(quota, n_first, rng) if names else np.zeros((n_first, 0), np.int64)
    uses: list[tuple[str, int, list[tuple[int, int]]]] = []
    for i, name in enumerate(names):
        a, c = order[i]
        ends = np.cumsum(deal[:, i])
        slot = (a * np.arange(blocks) + c) % blocks
        copies: list[list[tuple[int, int]]] = [[] for _ in range(blocks)]
        for r in range(-(-quota[i] // blocks)):
            drawn_now = np.flatnonzero((slot + r * blocks < quota[i]) & (per[name] > 0))
            for b, shard in zip(drawn_now.tolist(), np.searchsorted(ends, slot[drawn_now] + r * blocks, "right").tolist(), strict=True):
                copies[b].append((r + 1, shard))
        uses += [(name, b, u) for b, u in enumerate(copies) if u]
    fits = lambda rows, schema: (F.broadcast if len(rows) <= MOST_BROADCAST else lambda df: df)(spark.createDataFrame(rows, schema))
    table = fits(uses, "_s string, _b int, _uses array<struct<copy_no:int,shard:int>>")  # at most sources x blocks rows
    drawn = usable.join(table, (F.col("source") == F.col("_s")) & (F.col("_block") == F.col("_b"))).withColumn("_u", F.explode("_uses"))
    drawn = drawn.select(F.col("_u.shard").cast("bigint").alias("shard"), key, "source", F.col("_u.copy_no").alias("copy_no"), "n_tokens")
    if groups > 1:
        fine = within * max(1, 4096 // within)
        second = splitting_tree([fine] * len(names), within, rng)
        rows = []
        for i, name in enumerate(names):
            a, c = _permutation(fine, rng)
            slot = (a * np.arange(fine) + c) % fine
            rows += [(name, b, int(x)) for b, x in enumerate(np.searchsorted(np.cumsum(second[:, i]), slot, "right"))]
        turn = F.xxhash64("shard", F.lit(seed + 2))  # every group starts elsewhere in the deal
        sub = F.pmod(F.xxhash64(F.col(key), "copy_no", F.lit(seed + 3)) % fine + turn % fine, F.lit(fine)).cast("int")
        drawn = drawn.withColumn("_sub", sub).join(fits(rows, "_s2 string, _b2 int, _in int"), (F.col("source") == F.col("_s2")) & (F.col("_sub") == F.col("_b2")))
        drawn = drawn.select((F.col("shard") * within + F.col("_in")).alias("shard"), key, "source", "copy_no", "n_tokens")
    local = Window.partitionBy("shard").orderBy(F.xxhash64(F.col(key), "copy_no", F.lit(seed + 1)), key, "copy_no")
    return drawn.select("shard", F.row_number().over(local).alias("position"), key, "source", "copy_no", "n_tokens")


def mixture_shares(mixture: DataFrame, targets: DataFrame, sizes: DataFrame, *, key: str) -> DataFrame:
    """Per source: target_share, max_repeat, available_tokens, tokens, uses, max_copies and actual_share.

    Sources without a target (null and other spellings left as they are) are listed too.
    """
    got = mixture.groupBy("source").agg(F.sum("n_tokens").alias("tokens"), F.count(F.lit(1)).alias("uses"), F.max("copy_no").alias("max_copies"))
    there = sizes.groupBy("source").agg(F.sum("n_tokens").alias("available_tokens"))
    t = targets.groupBy("source").agg(F.max("target_share").alias("target_share"), F.max("max_repeat").alias("max_repeat"))
    there = there.withColumnRenamed("source", "_s")
    out = t.join(there, t["source"].eqNullSafe(there["_s"]), "full").select(F.coalesce("source", "_s").alias("source"), "target_share", "max_repeat", "available_tokens")
    out = out.join(got.withColumnRenamed("source", "_g"), F.col("source").eqNullSafe(F.col("_g")), "left").drop("_g")
    out = out.withColumn("_all", F.sum("tokens").over(Window.partitionBy(F.lit(1))))  # one row per source
    zero = lambda c: F.coalesce(F.col(c), F.lit(0)).alias(c)
    return out.select("source", "target_share", "max_repeat", zero("available_tokens"), zero("tokens"), zero("uses"), zero("max_copies"), F.coalesce(F.try_divide("tokens", "_all"), F.lit(0.0)).alias("actual_share"))


def mixture_of(docs: DataFrame, targets: DataFrame, *, key: str, text: str, source: str, vocab: str = DEFAULT_VOCAB, **options) -> tuple[DataFrame, DataFrame]:
    """``(mixture, sizes)`` of raw documents: sizes are counted once and written to the shared folder."""
    sizes = written(token_sizes(docs, key=key, text=text, source=source, vocab=vocab), "token-sizes")
    return mix_sources(sizes, targets, key=key, **options), sizes

"""New batches against everything accepted before: content-defined chunks in a persistent table."""

from __future__ import annotations

from collections.abc import Callable, Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Observation, SparkSession, Window
from pyspark.sql import functions as F

from tidemark.session import written

_GEAR = np.random.default_rng(20240601).integers(0, 2**63, 256, dtype=np.int64).astype(np.uint64)
_WINDOW = 6


def ends_of(raws: list[bytes], least: int, average: int, most: int) -> list[list[int]]:
    """Ends of the chunks of each content.

    A boundary falls where the gear hash of the last bytes is a multiple of ``average`` (once in as many
    bytes) and after ``most`` bytes; a chunk shorter than ``least`` goes on unless the content ends it.
    Equal content far enough from a difference is cut alike, wherever it stands.
    """
    whole = np.frombuffer(b"".join(raws), np.uint8)
    size = np.array([len(r) for r in raws], np.int64)
    start = np.cumsum(size) - size
    at = np.arange(len(whole)) + np.repeat(np.arange(1, len(raws) + 1) * _WINDOW, size)
    g = np.zeros(len(whole) + (len(raws) + 1) * _WINDOW, np.uint64)
    g[at] = _GEAR[whole]  # zeros between contents keep the bytes of one out of the next one's hashes
    h = np.zeros(len(g), np.uint64)
    for k in range(_WINDOW):
        h[k:] += g[: len(g) - k] << np.uint64(k)
    hit = np.flatnonzero(((h[at] >> np.uint64(20)) % np.uint64(average)) == 0)
    owner = np.searchsorted(start, hit, "right") - 1
    ends: list[list[int]] = [[] for _ in raws]
    last = np.zeros(len(raws), np.int64).tolist()
    for where, i in zip((hit - start[owner] + 1).tolist(), owner.tolist(), strict=True):
        _cut(ends[i], last, i, where, False, least, most)
    for i, n in enumerate(size.tolist()):
        if n:
            _cut(ends[i], last, i, n, True, least, most)
    return ends


def _cut(ends: list[int], last: list[int], i: int, at: int, must: bool, least: int, most: int) -> None:
    while at - last[i] > most:
        last[i] += most
        ends.append(last[i])
    if at > last[i] and (must or at - last[i] >= least):
        ends.append(at)
        last[i] = at


def chunk_ends(raw: bytes, **sizes: int) -> list[int]:
    return ends_of([raw], **sizes)[0]


def chunk_tables(raws: list[bytes], **sizes: int) -> list[dict[int, int]]:
    """For each content: hash of each distinct chunk -> its bytes in all."""
    from xxhash import xxh3_64_intdigest

    out = []
    for raw, ends in zip(raws, ends_of(raws, **sizes), strict=True):
        got: dict[int, int] = {}
        a = 0
        for e in ends:
            h = xxh3_64_intdigest(raw[a:e]) - 2**63
            got[h] = got.get(h, 0) + e - a
            a = e
        out.append(got)
    return out


def chunk_table(raw: bytes, **sizes: int) -> dict[int, int]:
    return chunk_tables([raw], **sizes)[0]


class ChunkStore:
    """Accepted records and the table of their chunks, kept as Parquet below ``path``, for as long as the folder stands.

    ``records``: k, content, guard, about, n_bytes, chunks of every accepted record; ``chunks``: the chunk-to-record table, one row
    (h, guard, n, k) per chunk; ``decisions``: what came out of each batch. Every batch adds one part to each and then its
    mark in ``commits``; only marked parts are read. A store opened on a folder goes on where the last commit left it, what a lost
    driver left half written is overwritten, and a batch whose name has a commit gives its decisions again and adds nothing.
    """

    def __init__(self, spark: SparkSession, path: str, *, least: int = 6, average: int = 8, most: int = 32, coverage: float = 0.3):
        self.spark, self.path = spark, path.rstrip("/")
        self.sizes = {"least": least, "average": average, "most": most}
        self.coverage = coverage
        self.commits: dict[str, int] = {}
        at = self._path("commits")
        if self._fs(at).exists(at):
            for f in self._fs(at).listStatus(at):
                part, _, name = f.getPath().getName().partition("-")
                self.commits[name] = int(part)

    def _path(self, *below: str):
        return self.spark._jvm.org.apache.hadoop.fs.Path("/".join((self.path, *below)))

    def _fs(self, at):
        return at.getFileSystem(self.spark._jsc.hadoopConfiguration())

    def _commit(self, name: str, part: int) -> None:
        at = self._path("commits", f"{part:06d}-{name}")
        self._fs(at).create(at, False).close()
        self.commits[name] = part

    def _part(self, table: str, part: int) -> str:
        return f"{self.path}/{table}/part={part:06d}"

    def _read(self, table: str, schema) -> DataFrame:
        return self.spark.read.schema(schema).parquet(*[self._part(table, p) for p in sorted(self.commits.values())])

    def ingest(
        self, batch: DataFrame, *, key: str, content: str, agrees: Callable[[DataFrame], DataFrame], guard: str | None = None, about: str | None = None, name: str | None = None
    ) -> DataFrame:
        """Decide a batch and append what it adds: (``key``, ``repeats``), one row per row of the batch.

        ``repeats`` is null for accepted rows, else the first accepted row that has the same content, guard and about, or
        whose chunks cover at least ``coverage`` of the row's bytes and with which it ``agrees``: an exact check, given pairs
        (content, about, other_content, other_about and more) and returning those that hold. ``guard`` is a column
        that rows which agree have in common; rows of different guard are never paired. ``key`` must be unique and rise
        from batch to batch; rows of one batch are compared with each other too, earlier ones standing first. ``name`` names the batch, else it
        is named by its number.

        Null contents are contents of no bytes: all null and empty contents (of equal guard and about) are one. An empty batch decides nothing.
        Other columns are ignored.

        * Equal rows are collapsed by a map-side-combined minimum, so a content that a third of
          all rows repeat is one row from there on, here and in the store.
        * Of the chunk table only rows of chunks and guards that the batch holds are taken; the batch's side is what moves.
          A row that shares enough bytes shares one of the rarest chunks, those that make up 1 - ``coverage`` of its
          bytes; only those make pairs. Shared byte totals are taken over all chunks of a pair. No candidate is left out.
        * Stored records are fetched for pairs only, within the range of their keys.
        * A row repeats accepted rows only, as if the rows came one by one: where a batch ends changes no decision.
        """
        part = len(self.commits)
        name = f"batch{part}" if name is None else name
        kind = dict(batch.dtypes)[key]
        out = f"k {kind}, repeats {kind}"
        if name in self.commits:
            return self.spark.read.schema(out).parquet(self._part("decisions", self.commits[name])).withColumnsRenamed({"k": key, "repeats": "repeats"})
        text = lambda c: (F.col(c) if c else F.lit(None)).cast("string")
        src = batch.select(F.col(key).alias("k"), F.coalesce(F.col(content), F.lit("")).alias("content"), text(guard).alias("guard"), text(about).alias("about"))
        own = ("content", "guard", "about")
        src = src.withColumns({f"w{i}": F.xxhash64(F.lit(i), *own) for i in (1, 2)})  # 128 bits stand for an equal row
        first = src.groupBy("w1", "w2").agg(F.min(F.struct("k", *own)).alias("r")).select("w1", "w2", "r.*")
        new = written(self._chunked(first), "dedupe-new")
        roots = self._roots(*self._near(new, kind, agrees))
        kept = new.join(roots.select("k"), "k", "left_anti").drop("w1", "w2")
        stored = self.spark.read.schema(kept.schema).parquet
        rows = lambda: stored(self._part("records", part)).select(F.explode("chunks").alias("c"), "guard", "k").select("c.h", "guard", "c.n", "k").sortWithinPartitions("h")
        decided = new.select("w1", "w2", F.col("k").alias("own")).join(roots.select(F.col("k").alias("own"), "root"), "own", "left")
        repeats = F.coalesce("root", F.when(F.col("k") != F.col("own"), F.col("own")))
        decisions = src.select("k", "w1", "w2").join(decided, ["w1", "w2"]).select("k", repeats.alias("repeats"))
        for table, adds in (("records", lambda: kept), ("chunks", rows), ("decisions", lambda: decisions)):
            adds().write.mode("overwrite").option("parquet.bloom.filter.enabled#h", "true").parquet(self._part(table, part))
        self._commit(name, part)
        self.spark._jvm.System.gc()  # else shuffles and broadcasts of every batch stay until the driver's heap is full
        return self.spark.read.schema(out).parquet(self._part("decisions", part)).withColumnRenamed("k", key)

    def _chunked(self, distinct: DataFrame) -> DataFrame:
        sizes = self.sizes
        struct = pa.list_(pa.struct([("h", pa.int64()), ("n", pa.int64())]))

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                raws = [t.encode("utf-8", "surrogatepass") for t in batch.column("content").to_pylist()]
                chunks = [[{"h": h, "n": n} for h, n in t.items()] for t in chunk_tables(raws, **sizes)]
                yield pa.RecordBatch.from_arrays([*batch.columns, pa.array([len(r) for r in raws], pa.int64()), pa.array(chunks, struct)], names=[*batch.schema.names, "n_bytes", "chunks"])

        kinds = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in distinct.schema)
        return distinct.mapInArrow(run, kinds + ", n_bytes bigint, chunks array<struct<h:bigint,n:bigint>>")

    def _near(self, new: DataFrame, kind: str, agrees) -> tuple[DataFrame, bool]:
        """(k, other, stored): other < k with enough shared bytes, for which the exact check holds; stored tells whether it is in the store. And whether any other is not."""
        mine = new.select("k", "n_bytes", F.coalesce("guard", F.lit("")).alias("guard"), F.explode("chunks").alias("c")).select("k", "n_bytes", "guard", "c.h", "c.n")
        others = mine.select("h", "guard", F.col("k").alias("other"), F.lit(False).alias("stored"))
        if self.commits:
            table = self._read("chunks", f"h bigint, guard string, n bigint, k {kind}").select("h", F.coalesce("guard", F.lit("")).alias("guard"), F.col("k").alias("other"), F.lit(True).alias("stored"))
            hits = written(table.join(mine.select("h", "guard"), ["h", "guard"], "left_semi"), "dedupe-hits")
            others = others.unionByName(hits)
        holders = others.groupBy("h", "guard").agg(F.count(F.lit(1)).alias("df")).where("df > 1")
        ranked = mine.join(holders, ["h", "guard"])
        # chunks that no other row holds come first in the order of rarity: their bytes are what the others leave
        lone = F.col("n_bytes") - F.sum("n").over(Window.partitionBy("k"))
        before = lone + F.coalesce(F.sum("n").over(Window.partitionBy("k").orderBy("df", "h").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
        probe = ranked.withColumn("_before", before).where(F.col("_before") <= (1 - self.coverage) * F.col("n_bytes")).select("h", "guard", "k")
        pairs = probe.join(others, ["h", "guard"]).where(F.col("stored") | (F.col("other") < F.col("k"))).select("k", "other", "stored").distinct()
        kept = F.when(F.col("stored"), F.col("other"))
        seen = Observation()
        pairs = written(pairs.observe(seen, F.count(F.lit(1)).alias("n"), F.min(kept).alias("lo"), F.max(kept).alias("hi")), "dedupe-pairs")
        span = seen.get
        if not span["n"]:
            return pairs, False
        right = new.select("k", "content", "about", "chunks").withColumn("_in", F.lit(False))
        if span["lo"] is not None:
            old = self._read("records", new.drop("w1", "w2").schema).where(F.col("k").between(span["lo"], span["hi"]))
            right = right.unionByName(old.select("k", "content", "about", "chunks").withColumn("_in", F.lit(True)))
        right = right.select(F.col("k").alias("_k"), "_in", F.col("content").alias("other_content"), F.col("about").alias("other_about"), F.col("chunks").alias("_b"))
        both = pairs.join(new.select("k", "content", "about", "n_bytes", "chunks"), "k").join(right, (F.col("other") == F.col("_k")) & (F.col("stored") == F.col("_in")))
        theirs = F.transform("_b", lambda d: d["h"])
        shared = F.aggregate(F.filter("chunks", lambda c: F.array_contains(theirs, c["h"])), F.lit(0).cast("bigint"), lambda s, c: s + c["n"])
        enough = both.where(shared >= self.coverage * F.col("n_bytes")).select("k", "other", "stored", "content", "about", "other_content", "other_about")
        held = Observation()
        near = written(agrees(enough).select("k", "other", "stored").observe(held, F.count_if(~F.col("stored")).alias("inside")), "dedupe-near")
        return near, held.get["inside"] > 0

    def _roots(self, near: DataFrame, inside: bool) -> DataFrame:
        """(k, root): rows with an accepted near row before them, and the first of those.

        Rows with a stored near row are skipped at once. The others are settled in rounds: a row is skipped if one of its near rows
        is accepted for certain, accepted if all are skipped, else left for the next round. Mostly one round settles all; the
        longest chain of slips bounds their number.
        """
        if not inside:
            return near.groupBy("k").agg(F.min("other").alias("root"))
        state = near.where("stored").select("k", F.lit(False).alias("open")).distinct()
        edges = near.where("NOT stored").select("k", "other").join(state.select("k"), "k", "left_anti")
        state = state.unionByName(edges.select("k", F.lit(True).alias("open")).distinct())
        skipped = near.where("stored").select("k")
        left = 1
        while left:
            of = state.select(F.col("k").alias("other"), "open")
            told = edges.join(of, "other", "left").groupBy("k").agg(F.max(F.col("open").isNull()).alias("hit"), F.max(F.coalesce("open", F.lit(False))).alias("wait"))
            seen = Observation()
            told = written(told.observe(seen, F.count_if(~F.col("hit") & F.col("wait")).alias("left")), "dedupe-told")
            left = seen.get["left"]
            skipped = skipped.unionByName(told.where("hit").select("k"))
            if left:
                skipped = written(skipped.distinct(), "dedupe-skipped")
                waiting = told.where("NOT hit AND wait").select("k", F.lit(True).alias("open"))
                edges = written(edges.join(waiting.select("k"), "k", "left_semi"), "dedupe-open")
                state = skipped.select("k", F.lit(False).alias("open")).unionByName(waiting)
        out = skipped.select(F.col("k").alias("other"), F.lit(False).alias("stored"))
        roots = near.join(skipped, "k", "left_semi").join(out, ["other", "stored"], "left_anti").groupBy("k").agg(F.min("other").alias("root"))
        return written(roots, "dedupe-roots")


def ingest_all(store: ChunkStore, batches: list[tuple[str, DataFrame]], **names) -> DataFrame:
    """Ingest named batches one after the other; all decisions."""
    return reduce(DataFrame.unionByName, [store.ingest(b, name=n, **names) for n, b in batches])

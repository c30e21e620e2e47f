"""Shards of bounded size by extendible hashing.

A document belongs to the bucket named by the first bits of the hash of its key.
A bucket whose bytes exceed the limit is split on the next bit, and only such a
bucket, until every bucket fits. The sizes of all prefixes down to a level are sums
of the level's cells, so one aggregate settles all splits of that level; cells that
are still too large go on alone at a deeper level. Only built-in functions run.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from abacarium.llm.common import stored

#: Bits of the hash that splits may use: the first 15 hexadecimal digits of an MD5.
HASH_BITS = 60
#: Levels that one aggregate settles. What does not fit then is read once more, so few tables should get there.
LEVELS = 16


def key_hash(key: Column) -> Column:
    """60 bits from the key as text; NULL keys count as the empty text."""
    return F.conv(F.substring(F.md5(F.coalesce(key.cast("string"), F.lit("")).cast("binary")), 1, 15), 16, 10).cast("long")


def _prefix(hash_: Column, depth: Column | int) -> Column:
    return F.call_function("shiftright", hash_, (F.lit(HASH_BITS) - depth).cast("int"))


def _levels(cells: DataFrame, top: int, bottom: int, limit: int) -> DataFrame:
    """Buckets of ``cells`` (prefixes of ``bottom`` bits) between two depths: the shallowest that fit.

    Cells at ``bottom`` that do not fit come with ``fits`` false.
    """
    depth = F.explode(F.sequence(F.lit(top), F.lit(bottom))).alias("depth")
    sums = cells.select("cell", "bytes", "docs", depth).groupBy(
        "depth", F.call_function("shiftright", F.col("cell"), (F.lit(bottom) - F.col("depth")).cast("int")).alias("prefix")).agg(
        F.sum("bytes").alias("bytes"), F.sum("docs").alias("docs"))
    sums = stored(sums, "levels")
    up = sums.select((F.col("depth") + 1).alias("depth"), F.col("prefix").alias("parent"), (F.col("bytes") > limit).alias("parent_full"))
    joined = sums.withColumn("parent", F.shiftright("prefix", 1)).join(up, ["depth", "parent"], "left")
    fits = F.col("bytes") <= limit
    return joined.where(F.coalesce("parent_full", F.lit(True)) & (fits | (F.col("depth") == bottom))).select(
        "depth", "prefix", "bytes", "docs", fits.alias("fits"))


def directory(docs: DataFrame, limit: int) -> DataFrame:
    """The buckets: ``depth``, ``prefix``, ``bytes``, ``docs``, ``fits`` for rows ``hash``, ``bytes``.

    Only a bucket whose rows all share one hash (a document above the limit, or one
    repeated key) cannot be split to fit; it ends at the last bit with ``fits`` false.
    """
    top, open_rows, done = 0, docs, None
    while True:
        bottom = min(top + LEVELS, HASH_BITS)
        cells = open_rows.groupBy(_prefix(F.col("hash"), bottom).alias("cell")).agg(
            F.sum("bytes").alias("bytes"), F.count(F.lit(1)).alias("docs"))
        found = stored(_levels(cells, top, bottom, limit), "buckets")
        settled = found if bottom == HASH_BITS else found.where("fits")
        done = settled if done is None else done.unionByName(settled)
        full = found.where("NOT fits")
        if bottom == HASH_BITS or full.isEmpty():
            return done
        open_rows = stored(open_rows.withColumn("prefix", _prefix(F.col("hash"), bottom)).join(full.select("prefix"), "prefix", "left_semi").drop("prefix"), "open")
        top = bottom


def assign_shards(docs: DataFrame, limit: int, key: str = "doc_id", text: str = "text") -> DataFrame:
    """One row per row of ``docs``: key, ``n_bytes``, ``depth``, ``shard``, ``shard_bytes``, ``shard_docs``, ``fits``.

    ``shard`` is the bucket's hash prefix in binary digits (empty if nothing had to be
    split). NULL texts have 0 bytes; rows with equal keys share a shard; an empty
    table gives no rows; other columns are ignored. Each row is looked up in the
    directory by its prefix at every depth in use and meets exactly one bucket.
    """
    rows = stored(docs.select(
        F.col(key).cast("long").alias("key"), key_hash(F.col(key)).alias("hash"),
        F.coalesce(F.octet_length(F.col(text)), F.lit(0)).cast("long").alias("bytes")), "sizes")
    buckets = stored(directory(rows, limit), "directory")
    depths = sorted(r[0] for r in buckets.select("depth").distinct().collect())
    looked = rows.withColumn("depth", F.explode(F.array(*[F.lit(d) for d in depths]).cast("array<int>"))).withColumn(
        "prefix", _prefix(F.col("hash"), F.col("depth")))
    found = looked.join(buckets.withColumnRenamed("bytes", "shard_bytes"), ["depth", "prefix"])
    shard = F.when(F.col("depth") > 0, F.lpad(F.conv(F.col("prefix").cast("string"), 10, 2), F.col("depth"), F.lit("0"))).otherwise("")
    return found.select(F.col("key").alias(key), F.col("bytes").alias("n_bytes"), "depth", shard.alias("shard"), "shard_bytes",
                        F.col("docs").alias("shard_docs"), "fits")


def write_shards(docs: DataFrame, limit: int, path: str, key: str = "doc_id", text: str = "text") -> str:
    """Write ``docs`` as Parquet with one folder per shard; returns the name of the folder column.

    That name is ``shard``, with underscores in front if ``docs`` has such a column. A
    shard that fits is written by one task; one that cannot (a single long document, or
    one repeated key) is dealt to as many tasks as limits fit into it.
    """
    def free(name: str) -> str:
        return free("_" + name) if name in docs.columns else name

    folder, own, parts = free("shard"), free("_key"), free("_parts")
    many = F.when(F.col("fits"), 1).otherwise(F.ceil(F.col("shard_bytes") / limit))
    shards = assign_shards(docs, limit, key, text).select(F.col(key).alias(own), F.col("shard").alias(folder), many.cast("int").alias(parts)).distinct()
    joined = docs.join(shards, docs[key].cast("long").eqNullSafe(shards[own])).drop(own)
    dealt = joined.withColumn(parts, F.pmod(F.monotonically_increasing_id(), F.col(parts).cast("long")))
    dealt.repartition(folder, parts).drop(parts).write.partitionBy(folder).parquet(path)
    return folder

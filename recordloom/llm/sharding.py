"""Sharding by extendible hashing, in DataFrame functions only.

Every document, cut into pieces where it alone exceeds the limit, has a 60-bit hash. The directory
is indexed by hash-prefix bits and starts as one shard; only a shard over its byte limit splits on
another bit, until all fit. The final shard of a piece is the shortest prefix of its hash whose
bytes fit, since prefixes are nested. Byte sums are taken ``STEP_BITS`` bits at a time: at most
2**STEP_BITS sums for the first step, then only under leaves that are still too large. Pieces whose
60 bits agree (rows repeated exactly) split on the bits of a second hash, of their row numbers.

Defined results: a null or empty text has no bytes and one piece; repeated rows each give their
pieces; ids may be null; an empty table gives no rows; other columns are ignored. No shard exceeds
the limit.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .scratch import cut

LIMIT_BYTES = 1 << 20
STEP_BITS = 15
HASH_BITS = 60


def pieces(docs: DataFrame, limit_bytes: int = LIMIT_BYTES) -> DataFrame:
    """doc_id, piece, start_char, n_chars, bytes, h, row: pieces of at most limit_bytes each.

    A code point has at most 4 bytes, so limit // 4 of them always fit. h is the first hash.
    """
    step = max(limit_bytes // 4, 1)
    text = F.coalesce(F.col("text"), F.lit(""))
    base = docs.select(F.col("doc_id").cast("long").alias("doc_id"), text.alias("text"), F.octet_length(text).cast("long").alias("all_bytes"), F.md5(text).alias("mark"))
    many = F.col("all_bytes") > limit_bytes
    last = F.floor((F.length("text") - 1) / F.lit(step)).cast("int")
    each = base.withColumn("piece", F.explode(F.when(many, F.sequence(F.lit(0), last)).otherwise(F.array(F.lit(0)))))
    start = (F.col("piece") * F.lit(step)).cast("int")
    part = F.when(many, F.substring(F.col("text"), start + 1, F.lit(step))).otherwise(F.col("text"))
    key = F.md5(F.concat_ws("|", F.coalesce(F.col("doc_id").cast("string"), F.lit("null")), "mark", F.col("piece").cast("string")))
    return each.select(
        "doc_id", F.col("piece").cast("long").alias("piece"), start.cast("long").alias("start_char"),
        F.length(part).cast("long").alias("n_chars"), F.octet_length(part).cast("long").alias("bytes"),
        F.conv(F.substring(key, 1, HASH_BITS // 4), 16, 10).cast("long").alias("h"), F.monotonically_increasing_id().alias("row"),
    )


def _bits(h: Column, n: int) -> Column:
    """The first n bits of a hash."""
    return F.shiftright(h, HASH_BITS - n)


def _split(todo: DataFrame, low: int, limit_bytes: int) -> DataFrame:
    """leaf, depth, shard_bytes for each prefix of low + STEP_BITS bits; depth is null where even the leaf is too large."""
    high = low + STEP_BITS
    leaves = cut(todo.groupBy("base", _bits(F.col("h"), high).alias("leaf")).agg(F.sum("bytes").alias("bytes")))
    depths = leaves.select("base", "leaf", "bytes", F.explode(F.sequence(F.lit(low), F.lit(high))).alias("depth"))
    prefix = F.expr(f"shiftright(leaf, {high} - depth)")
    sums = depths.groupBy("base", "depth", prefix.alias("prefix")).agg(F.sum("bytes").alias("shard_bytes")).filter(F.col("shard_bytes") <= limit_bytes)
    fits = depths.select("base", "leaf", "depth", prefix.alias("prefix")).join(sums, ["base", "depth", "prefix"])
    best = fits.groupBy("base", "leaf").agg(F.min(F.struct("depth", "shard_bytes")).alias("s"))
    return leaves.select("base", "leaf").join(best, ["base", "leaf"], "left").select("base", "leaf", "s.depth", "s.shard_bytes")


def shard(docs: DataFrame, limit_bytes: int = LIMIT_BYTES) -> DataFrame:
    """One row per piece: doc_id, piece, start_char, n_chars, bytes, depth, shard, shard_bytes.

    shard is the prefix as a bit string (that of a shard on second-hash bits is longer than 60).
    """
    todo = cut(pieces(docs, limit_bytes)).withColumn("base", F.lit(""))
    columns = ["doc_id", "piece", "start_char", "n_chars", "bytes"]
    out, low, passed = None, 0, 0
    while True:
        found = cut(_split(todo, low, limit_bytes))
        # the first step's directory has at most 2**STEP_BITS rows; later ones are joined as they come
        side = F.broadcast(found) if low == 0 and passed == 0 else found
        placed = todo.withColumn("leaf", _bits(F.col("h"), low + STEP_BITS)).join(side, ["base", "leaf"])
        bits = F.expr(f"substring(lpad(bin(shiftright(h, 0)), {HASH_BITS}, '0'), 1, depth)")
        done = placed.filter("depth is not null").select(*columns, (F.col("depth") + passed).cast("long").alias("depth"), F.concat("base", bits).alias("shard"), "shard_bytes")
        out = done if out is None else out.unionByName(done)
        if found.filter("depth is null").isEmpty():
            return out
        todo = cut(placed.filter("depth is null").drop("leaf", "depth", "shard_bytes"))
        low += STEP_BITS
        if low == HASH_BITS:
            low, passed = 0, passed + HASH_BITS
            second = F.pmod(F.xxhash64("row", F.lit(passed)), F.lit(1 << HASH_BITS))
            todo = todo.withColumn("base", F.concat("base", F.lpad(F.bin("h"), HASH_BITS, "0"))).withColumn("h", second)


def query(docs: DataFrame) -> DataFrame:
    return shard(docs)


#: The same directory in DuckDB SQL, for depths up to 15 (2**15 shards).
SQL = f"""
with base as (
  select doc_id, coalesce(text, '') as text, strlen(coalesce(text, '')) as all_bytes from documents
), each as (
  select *, unnest(case when all_bytes > {LIMIT_BYTES} then range(0, cast(floor((length(text) - 1) / {LIMIT_BYTES // 4}) as bigint) + 1) else [0] end) as piece from base
), p as (
  select doc_id, cast(piece as bigint) as piece, cast(piece * {LIMIT_BYTES // 4} as bigint) as start_char,
    case when all_bytes > {LIMIT_BYTES} then substr(text, piece * {LIMIT_BYTES // 4} + 1, {LIMIT_BYTES // 4}) else text end as part,
    cast('0x' || substr(md5(coalesce(doc_id::varchar, 'null') || '|' || md5(text) || '|' || piece), 1, 15) as bigint) as h
  from each
), s as (
  select depth, h >> (60 - depth) as prefix, cast(sum(strlen(part)) as bigint) as shard_bytes
  from p, range(0, 16) as d(depth) group by all
), f as (
  select p.*, s.depth, s.shard_bytes, row_number() over (partition by h, p.piece, p.doc_id order by s.depth) as rn
  from p join s on s.prefix = p.h >> (60 - s.depth) where s.shard_bytes <= {LIMIT_BYTES}
)
select doc_id, piece, start_char, length(part) as n_chars, strlen(part) as bytes, depth,
  substr(lpad(bin(h), 60, '0'), 1, cast(depth as integer)) as shard, shard_bytes
from f where rn = 1
"""

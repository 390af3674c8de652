"""Chat formatting by perspective rotation, in DataFrame functions only.

For every participant of a conversation the dialogue is rendered with that speaker as assistant and
everyone else as a named user; ``mask`` holds the code-point spans [start, end) of the rendered text
that the assistant wrote, its end mark included. System turns stay system turns in every rendering.

A rendering comes in blocks, so that no task gathers a conversation of unbounded length: a block
covers ``BLOCK`` turn numbers; where more than ``MOST`` turns share so few numbers, the block is cut
into parts of at most MOST consecutive turns. Blocks in the order of (block, part) are the whole
rendering; part is -1 where a block is whole. The spans of a mask count from its block's begin.

Defined results: a null text counts as empty, a null role is the speaker ``unknown``; turns without
a number come after all others; turns of equal number are ordered by role and text; a turn repeated
exactly is rendered once; conversation ids may be null; a conversation without participants has one
rendering with a null perspective; an empty table gives no rows; other columns are ignored. Markers
within a text or a role are broken up by blanks and line breaks in a role become blanks, so that
neither can begin or end a turn.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .scratch import cut

BLOCK, MOST = 32, 64
SYSTEM, UNKNOWN = "system", "unknown"
OPEN, CLOSE = "<|im_start|>", "<|im_end|>\n"


def _unmarked(x: Column) -> Column:
    return F.regexp_replace(x, r"<\|(im_start|im_end)\|>", "<| $1 |>")


def turns(conversations: DataFrame) -> DataFrame:
    """conv_id, turn, role, text: distinct turns with the defaults put in."""
    text = _unmarked(F.coalesce("text", F.lit("")))
    return conversations.select("conv_id", "turn", F.coalesce("role", F.lit(UNKNOWN)).alias("role"), text.alias("text")).distinct()


def blocks(own: DataFrame) -> DataFrame:
    """conv_id, block, part, turns: sorted arrays of a bounded number of turns."""
    last = F.lit(2**62)
    placed = own.withColumn("at", F.coalesce(F.col("turn").cast("long"), last)).withColumn("block", F.floor(F.col("at") / BLOCK))
    turn = F.struct("at", "role", "text")
    size = placed.groupBy("conv_id", "block").agg(F.count(F.lit(1)).alias("n")).filter(F.col("n") > MOST)
    crowded = cut(size.select(F.col("conv_id").alias("_c"), F.col("block").alias("_b")))
    within = F.col("conv_id").eqNullSafe(F.col("_c")) & (F.col("block") == F.col("_b"))
    if crowded.isEmpty():
        return placed.groupBy("conv_id", "block").agg(F.array_sort(F.collect_list(turn)).alias("turns")).withColumn("part", F.lit(-1).cast("long"))
    whole = placed.join(crowded, within, "left_anti").withColumn("part", F.lit(-1).cast("long"))
    # in the order of all crowded turns, dealt to tasks by ranges; a part is MOST consecutive numbers
    order = ["conv_id", "block", "at", "role", "text"]
    dealt = placed.join(crowded, within, "left_semi").repartitionByRange(*order).sortWithinPartitions(*order)
    parts = cut(dealt.withColumn("part", F.floor(F.monotonically_increasing_id() / MOST)))
    return whole.unionByName(parts).groupBy("conv_id", "block", "part").agg(F.array_sort(F.collect_list(turn)).alias("turns"))


def _render(perspective: Column) -> tuple[Column, Column]:
    def segment(t: Column) -> Column:
        own = t["role"] == perspective
        name = F.regexp_replace(_unmarked(t["role"]), "[\r\n]+", " ")
        head = F.when(t["role"] == SYSTEM, F.lit(OPEN + "system\n")).when(own, F.lit(OPEN + "assistant\n")).otherwise(F.concat(F.lit(OPEN + "user name="), name, F.lit("\n")))
        return F.struct(F.concat(head, t["text"], F.lit(CLOSE)).alias("all"), F.length(head).alias("head"), F.coalesce(own, F.lit(False)).alias("own"))

    parts = F.transform("turns", segment)
    zero = F.struct(F.lit(0).alias("at"), F.array().cast("array<string>").alias("spans"))

    def step(acc: Column, s: Column) -> Column:
        end = acc["at"] + F.length(s["all"])
        span = F.concat_ws(":", (acc["at"] + s["head"]).cast("string"), (end - 1).cast("string"))  # the final line feed is no token of the turn
        return F.struct(end.alias("at"), F.when(s["own"], F.concat(acc["spans"], F.array(span))).otherwise(acc["spans"]).alias("spans"))

    return F.array_join(F.transform(parts, lambda s: s["all"]), ""), F.array_join(F.aggregate(parts, zero, step, lambda a: a["spans"]), ",")


def perspectives(conversations: DataFrame) -> DataFrame:
    """conv_id, perspective, block, part, n_turns, text, mask: one row per block and participant."""
    own = turns(conversations)
    cast = own.filter(F.col("role") != SYSTEM).select(F.col("conv_id").alias("_c"), F.col("role").alias("perspective")).distinct()
    joined = blocks(own).join(cast, F.col("conv_id").eqNullSafe(F.col("_c")), "left")
    text, mask = _render(F.col("perspective"))
    return joined.select("conv_id", "perspective", "block", "part", F.size("turns").cast("long").alias("n_turns"), text.alias("text"), mask.alias("mask"))


def query(conversations: DataFrame) -> DataFrame:
    return perspectives(conversations)


#: The same rendering in DuckDB SQL (turn numbers within a block are distinct in the tables).
SQL = """
with t as (
  select distinct conv_id, coalesce(turn, 4611686018427387904) as at, coalesce(role, 'unknown') as role,
    regexp_replace(coalesce(text, ''), '<\\|(im_start|im_end)\\|>', '<| \\1 |>', 'g') as text
  from conversations
), c as (select distinct conv_id, role as perspective from t where role <> 'system'),
s as (
  select t.conv_id, c.perspective, cast(floor(t.at / 32) as bigint) as block, t.at as pos, t.role, t.text,
    case when t.role = 'system' then '<|im_start|>system' || chr(10)
         when t.role = c.perspective then '<|im_start|>assistant' || chr(10)
         else '<|im_start|>user name=' || regexp_replace(regexp_replace(t.role, '<\\|(im_start|im_end)\\|>', '<| \\1 |>', 'g'), '[\\r\\n]+', ' ', 'g') || chr(10) end as head,
    coalesce(t.role = c.perspective, false) as own
  from t left join c on t.conv_id is not distinct from c.conv_id
), p as (
  select *, head || text || '<|im_end|>' || chr(10) as seg,
    sum(length(head || text) + 11) over (partition by conv_id, perspective, block order by pos, role, text) as stop
  from s
)
select conv_id, perspective, block, cast(-1 as bigint) as part, count(*) as n_turns,
  string_agg(seg, '' order by pos, role, text) as text,
  coalesce(string_agg(case when own then cast(stop - length(text) - 11 as bigint)::varchar || ':' || cast(stop - 1 as bigint)::varchar end, ',' order by pos, role, text), '') as mask
from p group by conv_id, perspective, block
"""

"""Capping the records of each contributor by radix selection.

Score and identifier are encoded as order-preserving unsigned bytes (best record = smallest key). Round by round one byte
of each contributor's cutoff key is fixed: rows still on the cutoff's prefix are counted by (contributor, byte), at most 256
counters a contributor, and the byte on which the allowance runs out becomes part of the prefix. At last rows are kept by
comparing their key with the cutoff. No group of rows is ever sorted or gathered; only counters are shuffled. Bytes in which
all keys agree are skipped, so small identifiers take few rounds.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Row, Window
from pyspark.sql import functions as F

from loamstack.config import cut

SALT = 32
BROADCAST_ROWS = 200_000


def _rank(value: Column, low: int | None, high: int | None, descending: bool) -> Column:
    """A long whose order read as unsigned is the wanted order: the distance from the best value, so that it has few bytes."""
    x = value.cast("long")
    if low is None:
        return x
    if high - low < 1 << 63:
        return F.lit(high) - x if descending else x - F.lit(low)
    # too wide a range for a difference: moving the sign bit makes unsigned order of signed order; complement reverses it
    y = x.bitwiseXOR(F.lit(-(1 << 63)))
    return F.bitwise_not(y) if descending else y


def _byte(col: str, k: int) -> Column:
    return F.shiftrightunsigned(F.col(col), 8 * k).bitwiseAND(F.lit(255)).cast("int")


def _digits(r: Row) -> list[tuple[str, int]]:
    """The bytes that keys can differ in, most significant first, from the extremes of score and identifier."""

    def width(low: int | None, high: int | None, more: int) -> int:
        span = 0 if low is None else high - low + more
        return 8 if span >= 1 << 63 else -(-span.bit_length() // 8)

    out = [("_nul", 0)] if r.no_s and r.s0 is not None else []
    return out + [("_hi", k) for k in reversed(range(width(r.s0, r.s1, 0)))] + [("_lo", k) for k in reversed(range(width(r.i0, r.i1, 1 if r.no_i else 0)))]


def _with_state(keys: DataFrame, state: DataFrame, how: str, few: bool) -> DataFrame:
    """Join on the contributor: by broadcast if `few`, else by merging, with each contributor salted over SALT tasks."""
    if few:
        return keys.join(F.broadcast(state), "_who", how)
    state = state.withColumn("_salt", F.explode(F.sequence(F.lit(0), F.lit(SALT - 1))))
    return keys.join(state.hint("merge"), ["_who", "_salt"], how)


def cap_contributors(df: DataFrame, contributor: Column, score: str, identifier: str, max_count: int | None = None, max_share: float | None = None, left_out: bool = False) -> DataFrame:
    """The rows of `df` within each contributor's allowance, or with `left_out` all the others.

    The allowance is `max_count`, or floor(`max_share` * number of rows), or the lesser of both; best are the highest `score`,
    NULL lowest, then the smallest `identifier`. Both must be integers. A NULL contributor is one contributor of its own. NULL
    identifiers come last among equals. Rows with equal score and identifier are ordered by a hash of all columns; wholly equal
    rows are interchangeable and as many of them are kept as the allowance has room for. Empty input gives empty output. Columns are those of `df`;
    none whose name starts with `_cap_` may be among them.
    """
    for c in (score, identifier):
        if df.schema[c].dataType.typeName() not in ("integer", "long", "short", "byte", "void"):
            raise TypeError(f"{c} must be an integer column")
    if max_count is None and max_share is None:
        raise ValueError("give max_count or max_share")
    own = [F.col(f"`{c}`") for c in df.columns]
    limit = min(x for x in (max_count, None if max_share is None else int(max_share * df.count())) if x is not None)
    rows = df.withColumn("_cap_row", F.struct(*own)).select("_cap_row", F.coalesce(F.concat(F.lit("="), contributor.cast("string")), F.lit("")).alias("_who"), F.col(score).alias("_s"), F.col(identifier).alias("_i"))
    r = rows.agg(F.min("_s").cast("long").alias("s0"), F.max("_s").cast("long").alias("s1"), F.min("_i").cast("long").alias("i0"), F.max("_i").cast("long").alias("i1"), F.max(F.col("_s").isNull()).alias("no_s"), F.max(F.col("_i").isNull()).alias("no_i")).first()
    wide = r.i0 is not None and r.i1 - r.i0 + 1 >= 1 << 63
    # _nul: a missing score comes after every other; a missing identifier after its equals
    rows = rows.select(
        "_cap_row", "_who",
        F.when(F.col("_s").isNull(), 1).otherwise(0).cast("long").alias("_nul"),
        F.coalesce(_rank(F.col("_s"), r.s0, r.s1, True), F.lit(0).cast("long")).alias("_hi"),
        F.coalesce(_rank(F.col("_i"), r.i0, r.i1 + 1 if r.i1 is not None else None, False), F.lit(-1 if wide else 0 if r.i0 is None else r.i1 - r.i0 + 1).cast("long")).alias("_lo"),
    ).withColumn("_salt", F.pmod(F.hash("_lo"), F.lit(SALT)))
    keys = rows.select("_who", "_salt", "_nul", "_hi", "_lo")
    digits = _digits(r)
    zero = F.lit(0).cast("long")
    state = keys.groupBy("_who").count().where(F.col("count") > limit).select("_who", F.lit(limit).cast("long").alias("_left"), F.col("count").alias("_n"), zero.alias("_pnul"), zero.alias("_phi"), zero.alias("_plo"))
    few = state.limit(BROADCAST_ROWS + 1).count() <= BROADCAST_ROWS  # contributors over their allowance: counted, not guessed
    w = Window.partitionBy("_who").orderBy("_d")
    done: list[tuple[str, int]] = []
    for c, k in digits:
        on = _with_state(keys, state, "inner", few)
        for pc, pk in done:
            on = on.where(_byte(pc, pk) == F.shiftrightunsigned(F.col(f"_p{pc[1:]}"), 8 * pk).bitwiseAND(F.lit(255)).cast("int"))
        counts = on.groupBy("_who", "_left", "_pnul", "_phi", "_plo", _byte(c, k).alias("_d")).count()
        counts = counts.withColumn("_upto", F.sum("count").over(w))
        # the cutoff's byte: the first with which the allowance is used up (with none left, the first there is)
        at = counts.where((F.col("_upto") >= F.col("_left")) & (F.col("_upto") - F.col("count") < F.greatest(F.col("_left"), F.lit(1))))
        state = at.select(
            "_who",
            (F.col("_left") - (F.col("_upto") - F.col("count"))).alias("_left"),
            F.col("count").alias("_n"),  # after the last byte: the rows whose key is the cutoff
            *((F.col(f"_p{x}").bitwiseOR(F.shiftleft(F.col("_d").cast("long"), 8 * k)) if f"_{x}" == c else F.col(f"_p{x}")).alias(f"_p{x}") for x in ("nul", "hi", "lo")),
        )
        done.append((c, k))
    state = cut(state)  # a row a contributor over its allowance, in the shared folder
    # bytes in which all keys agree were never fixed: compare the fixed ones only
    def mark(of: DataFrame) -> DataFrame:
        cmp = F.lit(0)
        for c, k in reversed(done):
            a, b = _byte(c, k), F.shiftrightunsigned(F.col(f"_p{c[1:]}"), 8 * k).bitwiseAND(F.lit(255)).cast("int")
            cmp = F.when(a < b, -1).when(a > b, 1).otherwise(cmp)
        return _with_state(of, state, "left", few).withColumn("_cmp", F.when(F.col("_left").isNotNull(), cmp))

    on_cutoff = (F.col("_cmp") == 0) & (F.col("_left") > 0)
    ties = state.where("_left > 0 AND _n > _left").select("_who")
    keep = F.col("_cmp").isNull() | (F.col("_cmp") < 0) | on_cutoff
    marked = mark(rows)
    if ties.isEmpty():
        return marked.where(~keep if left_out else keep).select("_cap_row.*")
    marked = _with_state(marked, ties.withColumn("_split", F.lit(True)), "left", few)
    split = F.coalesce(F.col("_split"), F.lit(False)) & F.coalesce(F.col("_cmp") == 0, F.lit(False))
    whole = marked.where(~split & (~keep if left_out else keep)).select("_cap_row.*")
    # rows that share score and identifier beyond the room: counted by value, so equal rows are one row with a number
    some = marked.where(split).groupBy("_who", "_left", "_cap_row").count()
    over = Window.partitionBy("_who").orderBy(F.xxhash64("_cap_row"), F.to_json("_cap_row"))
    some = some.withColumn("_before", F.sum("count").over(over) - F.col("count"))
    kept = F.greatest(F.lit(0).cast("long"), F.least(F.col("count"), F.col("_left") - F.col("_before")))
    times = (F.col("count") - kept) if left_out else kept
    some = some.withColumn("_t", times.cast("int")).where("_t > 0").withColumn("_t", F.explode(F.sequence(F.lit(1), F.col("_t"))))
    return whole.unionByName(some.select("_cap_row.*"))

"""Mixing sources to target weights by pivotal dependent rounding.

Each row of a source is to be taken target / source_size times (0 to 2).
The whole part is certain; the fractional part is a probability.  Pairs
of fractional rows exchange word mass, at random and without bias, until
one of them is integral; the other stays and meets the next.  Chunks of
about ``FAN_IN`` rows are folded at once, each leaving at most one
fractional row, and the residuals of a level form the chunks of the next:
a reduction tree that no source, however hot, turns into one task.  Only
the last residual of a source is rounded alone, to the nearer whole number,
so the words taken from a source miss its target by at most half of its
longest document.

Everything is DataFrame and SQL expressions.

Defined cases: a null source is a source of its own and comes last; a
null or blank text has size 0, takes no words and is copied by an
independent draw; rows that share a key, or have none, are units of their
own, told apart by a number that a checkpoint of these rows fixes; an empty
table gives an empty result; reruns agree as every draw is a hash of the
row's key, level and seed, for repeated keys also of that number, which
follows the order in which the rows are read.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

from visitlens.llm.common import WORD, cut

FAN_IN = 96
WEIGHTS = (5, 2, 1)
SHARE = 1.5
CAP = 2


def source_targets(sizes: DataFrame, weights=WEIGHTS, share: float = SHARE, cap: int = CAP) -> DataFrame:
    """Columns source, source_size, target: one row per source.

    ``sizes`` has columns source and size.  Targets share ``share`` times
    all words by weight and stop at ``cap`` times the source's size; the
    excess goes to the others by weight until none is above.  That is the
    water level at which the capped shares sum to the whole: with sources
    in the order in which they reach their caps, the level follows from
    running sums.  The windows hold one row per source.
    """
    per = sizes.groupBy("source").agg(F.sum("size").alias("source_size"))
    weight = F.array(*[F.lit(float(w)) for w in weights])
    by_name = Window.orderBy(F.col("source").asc_nulls_last())
    n = len(weights)
    per = per.withColumn("weight", F.element_at(weight, (F.row_number().over(by_name) - 1) % n + 1))
    per = per.withColumn("most", F.col("source_size") * float(cap))
    per = per.withColumn("full_at", F.col("most") / F.col("weight"))
    order = Window.orderBy("full_at", F.col("source").asc_nulls_last())
    before = order.rowsBetween(Window.unboundedPreceding, -1)
    onward = order.rowsBetween(0, Window.unboundedFollowing)
    everything = Window.partitionBy()
    whole = order.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    level = ((F.sum("source_size").over(everything) * share - F.coalesce(F.sum("most").over(before), F.lit(0.0)))
             / F.sum("weight").over(onward))
    # The first source in order that the level does not fill fixes it.
    fits = F.when(F.col("level") <= F.col("full_at"), F.col("level"))
    per = per.withColumn("level", level).withColumn("level", F.first(fits, True).over(whole))
    target = F.when(F.col("level").isNull(), F.col("most")).otherwise(
        F.least("most", F.col("level") * F.col("weight")))
    return per.select("source", "source_size", target.alias("target"))


def _fold() -> str:
    """SQL of one chunk's fold over units (ord, x, w, u, row).

    State: cur, the unit that is still fractional, and done, the rows that
    became integral with the copy (0 or 1) that they got.  give is the mass
    that may move from the next unit to cur, take the other way; cur gains
    with probability take / (give + take), so its expectation stays."""
    masses = ("named_struct('give', least((1 - s.cur.x) * s.cur.w, n.x * n.w),"
              " 'take', least(s.cur.x * s.cur.w, (1 - n.x) * n.w))")
    unit = "named_struct('ord', {0}.ord, 'x', {1}, 'w', {0}.w, 'u', {0}.u, 'row', {0}.row)"
    end = "array(named_struct('row', {0}.row, 'got', {1}))"
    gains = "n.u * (m.give + m.take) < m.take"
    moved = (
        f"CASE WHEN s.cur IS NULL THEN named_struct('cur', n, 'done', s.done)"
        f" WHEN {gains} THEN"
        f" CASE WHEN (1 - s.cur.x) * s.cur.w <= n.x * n.w"
        f" THEN named_struct('cur', {unit.format('n', 'greatest(0D, n.x - m.give / n.w)')},"
        f" 'done', concat(s.done, {end.format('s.cur', '1')}))"
        f" ELSE named_struct('cur', {unit.format('s.cur', 'least(1D, s.cur.x + m.give / s.cur.w)')},"
        f" 'done', concat(s.done, {end.format('n', '0')})) END"
        f" WHEN s.cur.x * s.cur.w <= (1 - n.x) * n.w"
        f" THEN named_struct('cur', {unit.format('n', 'least(1D, n.x + m.take / n.w)')},"
        f" 'done', concat(s.done, {end.format('s.cur', '0')}))"
        f" ELSE named_struct('cur', {unit.format('s.cur', 'greatest(0D, s.cur.x - m.take / s.cur.w)')},"
        f" 'done', concat(s.done, {end.format('n', '1')})) END")
    return f"element_at(transform(array({masses}), m -> {moved}), 1)"


def _uniform(*parts):
    return F.shiftrightunsigned(F.xxhash64(*parts), 11) / F.lit(float(2 ** 53))


def numbered(rows: DataFrame, ids: list[Column]) -> DataFrame:
    """All columns and nth: null where a key stands once, else a number of
    the row's own.  The hash functions pass over nulls."""
    same = F.xxhash64(*ids)
    again = cut(rows.groupBy(same.alias("same")).agg(F.count("*").alias("c")).where("c > 1").select("same"))
    none = F.lit(None).cast("long").alias("nth")
    if again.isEmpty():
        return rows.select("*", none)
    each = rows.withColumn("nth", F.monotonically_increasing_id()).withColumn("same", same)
    several = cut(each.join(again, "same", "left_semi").drop("same"))
    once = rows.withColumn("same", same).join(again, "same", "left_anti").drop("same")
    return once.select("*", none).unionByName(several)


def chunk(level: int, chunks: int) -> Column:
    return F.pmod(F.xxhash64("place", F.lit(level)), F.lit(max(1, chunks))).alias("chunk")


def mix(rows: DataFrame, targets: DataFrame, key: list[str], seed: int = 7, fan_in: int = FAN_IN,
        total: int | None = None) -> DataFrame:
    """Whole copies for every row.

    ``rows`` has columns source, size and row (a struct that is carried
    along, with the fields of ``key``); ``targets`` is what
    ``source_targets`` gives.  Returns row, size, source_size, target and
    copies.  ``key`` names fields of row that tell documents apart.
    """
    total = rows.count() if total is None else total
    ids = [F.col(f"row.{k}") for k in key]
    joined = numbered(rows, ids).alias("r").join(targets.alias("t"), F.col("r.source").eqNullSafe(F.col("t.source"))).select(
        "r.row", "r.source", "r.size", "r.nth", "t.source_size", "t.target")
    ratio = F.when(F.col("source_size") > 0, F.col("target") / F.col("source_size")).otherwise(0.0)
    joined = joined.withColumn("ratio", ratio)
    part = F.col("ratio") - F.floor("ratio")
    ready = joined.select(
        F.struct("row", "size", "source_size", "target", F.floor("ratio").cast("int").alias("base")).alias("row"),
        "source", part.alias("x"), F.col("size").cast("double").alias("w"),
        _uniform(*ids, "nth", F.lit(seed)).alias("draw"), F.xxhash64(*ids, "nth", F.lit(seed + 1)).alias("place"))
    out = lambda got: [F.col("row.row").alias("row"), F.col("row.size").alias("size"),
                       F.col("row.source_size").alias("source_size"), F.col("row.target").alias("target"),
                       (F.col("row.base") + got).cast("int").alias("copies")]
    # Rows without words hold no mass to move: each draws alone.
    light = (F.col("w") <= 0) | (F.col("x") <= 0)
    done = ready.where(light).select(*out((F.col("draw") < F.col("x")).cast("int")))
    cur = ready.where(~light)
    level, chunks = 0, total
    while True:
        chunks = -(-chunks // fan_in)
        unit = F.struct(F.col("place").alias("ord"), "x", "w",
                        _uniform(F.col("place"), F.lit(seed + 2 + level)).alias("u"), "row")
        folded = cur.groupBy("source", chunk(level, chunks)).agg(F.sort_array(F.collect_list(unit)).alias("units"))
        folded = folded.select("source", F.expr(
            "aggregate(slice(units, 2, size(units)), named_struct('cur', units[0], 'done', "
            "filter(array(named_struct('row', units[0].row, 'got', 0)), z -> false)), (s, n) -> " + _fold() + ")"
        ).alias("s"))
        done = done.unionByName(folded.select(F.explode("s.done").alias("d")).select(
            F.col("d.row").alias("row"), F.col("d.got").alias("got")).select(*out(F.col("got"))))
        cur = folded.select("source", "s.cur.x", "s.cur.w", "s.cur.row", F.col("s.cur.ord").alias("place"))
        level += 1
        if chunks <= 1:
            break
    # Nothing is left to pair with: the nearer whole number.
    return done.unionByName(cur.select(*out((F.col("x") >= 0.5).cast("int"))))


def word_count(column: Column) -> Column:
    """Number of words of a text column; null has none."""
    return F.coalesce(F.regexp_count(column, F.lit(WORD)), F.lit(0)).cast("long")

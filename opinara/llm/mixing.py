"""Mixing sources to target weights by pivotal dependent rounding (op 3).

A source's rows are all wanted ``target / size of the source`` times. The whole
part of that is taken as it is; what remains is a probability of one more copy.
A row's probability meets that of the bundle of all shorter rows of its group: mass,
measured in words, moves at random from one to the other until one of them is
settled, which keeps both the words of the two and each row's expectation. What a
group of rows leaves over meets the leftovers of other groups in the next level of
a tree, up to one row a source.
"""

import random

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import free_of, materialise, names_for, numbered, union_all

MOST_COPIES = 3
WEIGHTS = (1, 2, 3)
ROWS_PER_GROUP = 2048
FAN_IN = 64
TINY = 1e-9  # a probability this close to 0 or 1 is taken for it
WORD = r"[^\x20\x09-\x0D]+"


def word_count(text):
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("bigint")


def targets(sources: DataFrame, weights=WEIGHTS, most=MOST_COPIES, total=None) -> DataFrame:
    """Add ``target`` to ``(source, source_size)``: shares of ``total`` (all sizes, if not given) by weight.

    Sources by code point, null last, take the weights in turn. A share stops at
    ``most`` times the source's size, and what is over goes to the others by
    weight until none is above its stop. Each round is one aggregate; only its
    two sums reach the driver.
    """
    sources = sources.withColumn("last", F.col("source").isNull()).withColumn("one", F.lit(1).cast("bigint"))
    ranked = numbered(sources, ["last", "source"], ["one"], "sources")
    turn = F.element_at(F.array(*[F.lit(float(w)) for w in weights]), (F.col("one_before") % len(weights) + 1).cast("int"))
    ranked = materialise(ranked.select("source", "source_size", turn.alias("weight")), "weights")
    if total is None:
        total = ranked.agg(F.coalesce(F.sum("source_size"), F.lit(0))).first()[0]
    stop, level, capped = F.col("source_size") * float(most), 0.0, -1
    while True:
        above = F.col("weight") * level >= stop if capped >= 0 else F.lit(False)
        n, fixed, open_weight = ranked.agg(
            F.count(F.when(above, 1)), F.sum(F.when(above, stop)), F.sum(F.when(~above, F.col("weight")))).first()
        if n == capped or not open_weight:
            break
        capped, level = n, max(0.0, float(total) - (fixed or 0.0)) / open_weight
    return ranked.select("source", "source_size", F.least(stop, F.col("weight") * level if open_weight else stop).alias("target"))


def settle(size, open, chance):
    """Settle the open probabilities of one group: ``(gained, open)``, with at most one row still open.

    Rows come from long to short. Each meets the bundle of all rows behind it:
    words move at random from one to the other until the row is 0 or 1, or no row
    of the bundle can move on. Rows of a bundle that are open alike stay so; others
    give or take in proportion to what each can do both ways. Either way every row
    keeps its expectation. A long row is thus settled while many short ones are there
    to make up for it, and what stays open is short, unless one row outweighs all
    others of its group.
    """
    p, gained = np.array(open, float), np.zeros(len(open), np.int32)
    for i in range(len(p)):
        draw = random.Random(int(chance[i] * (1 << 53)))
        rest, words = p[i + 1:], size[i + 1:]
        while p[i] > 0:
            alike = not len(rest) or np.ptp(rest) < TINY
            fall, rise = (rest.copy(), 1 - rest) if alike else (np.minimum(rest, 1 - rest),) * 2
            given, taken = float(fall @ words), float(rise @ words)
            if given <= 0 or taken <= 0:
                return gained, p  # nothing is open behind this row
            up, down = min((1 - p[i]) * size[i], given), min(p[i] * size[i], taken)
            if draw.random() * (up + down) < down:  # in proportion, so that the row keeps its expectation
                p[i] += up / size[i]
                rest -= up / given * fall
            else:
                p[i] -= down / size[i]
                rest += down / taken * rise
            for part, first in ((p[i:i + 1], i), (rest, i + 1)):
                gained[first:first + len(part)] += part > 1 - TINY
                part[(part > 1 - TINY) | (part < TINY)] = 0
    return gained, p


def settle_group(rows):
    """One level of the tree for one group of rows ``copies, size, open, chance``."""
    import pyarrow as pa

    rows = rows.sort_by([("size", "descending"), ("place", "ascending"), ("unit_id", "ascending"), ("unit_size", "ascending")])
    todo = rows.column("open").to_numpy() > 0
    copies, open = rows.column("copies").to_numpy().copy(), rows.column("open").to_numpy().copy()
    gained, open[todo] = settle(rows.column("size").to_numpy()[todo].astype(float), open[todo], rows.column("chance").to_numpy()[todo])
    copies[todo] += gained
    for name, values in (("copies", copies), ("open", open)):
        at = rows.schema.get_field_index(name)
        rows = rows.set_column(at, rows.schema.field(at), pa.chunked_array([pa.array(values)]))
    return rows


def mix(df: DataFrame, id="doc_id", text="text", source="source", weights=WEIGHTS, most=MOST_COPIES,
        total=None, seed=0) -> DataFrame:
    """Add ``size``, ``source_size``, ``target``, ``copies`` and ``taken`` (words, repeats counted) to every row.

    A source's taken words differ from its target by less than one row: by a short
    one, unless one row outweighs the others. Rows without words are taken by chance
    alone. Rows that repeat id, source and size
    get the same number of copies. The choice follows from ids and ``seed``, so
    reruns agree. Rows are grouped by a hash, hot source or not, and only narrow
    rows shuffle before the results go back by id. Null ids, texts (size 0) and
    sources are values like others; an empty table gives no rows; columns named
    like the new ones become ``<name>_in``.
    """
    added = ["size", "source_size", "target", "copies", "taken"]
    if {id.lower(), text.lower(), source.lower()} & set(added):
        raise ValueError("the id, text and source columns may not be named like the new ones")
    spark = df.sparkSession
    df = free_of(df, *added).withColumn("size", word_count(F.col(text)))
    units = (df.groupBy(F.col(id).alias("unit_id"), F.col(source).alias("source"), F.col("size").alias("unit_size"))
             .agg(F.count(F.lit(1)).alias("rows")))
    units = materialise(units.withColumn("size", F.col("unit_size") * F.col("rows")), "units")
    sources = materialise(targets(units.groupBy("source").agg(F.sum("size").alias("source_size")), weights, most, total), "targets")
    groups = max(1, units.count() // ROWS_PER_GROUP)
    own = F.xxhash64(F.lit(seed), "unit_id", "unit_size")
    wanted = F.coalesce(F.col("target") / F.col("source_size"), F.lit(0.0))

    def chance(level):
        return F.shiftrightunsigned(F.xxhash64(F.lit(seed + 1 + level), "unit_id", "unit_size", "source"), 11) / float(1 << 53)

    t = sources.select(F.col("source").alias("t_source"), "source_size", "target")
    rows = (units.join(t, F.col("source").eqNullSafe(F.col("t_source"))).drop("t_source")
            .withColumn("copies", F.floor(wanted).cast("int")).withColumn("open", wanted - F.floor(wanted))
            .withColumn("place", own).withColumn("chance", chance(0))
            .withColumn("level_group", F.pmod(F.col("place"), F.lit(groups))))
    by_chance = (F.col("size") <= 0) & (F.col("chance") < F.col("open"))
    rows = (rows.withColumn("copies", F.col("copies") + by_chance.cast("int"))
            .withColumn("open", F.when(F.col("size") > 0, F.col("open")).otherwise(0.0))
            .withColumn("no_source", F.col("source").isNull()).withColumn("source", F.coalesce("source", F.lit(""))))
    level, done = 0, []
    while True:
        grouped = rows.groupBy("source", "no_source", "level_group")  # some ROWS_PER_GROUP rows at most, hashed
        rows = materialise(grouped.applyInArrow(settle_group, rows.schema), f"level{level}")
        done.append(rows.where("open = 0"))
        rows = rows.where("open > 0")
        level += 1
        if groups == 1:
            break
        groups = -(-groups // FAN_IN)
        rows = rows.withColumn("level_group", F.floor(F.col("level_group") / FAN_IN)).withColumn("chance", chance(level))
    # One open row a source at most is left; chance settles it.
    done.append(rows.withColumn("copies", F.col("copies") + (chance(level) < F.col("open")).cast("int")).withColumn("open", F.lit(0.0)))
    u_id, u_source, u_size = names_for(df, "unit_id", "unit_source", "unit_size")
    settled = union_all([d.select(F.col("unit_id").alias(u_id), F.when(~F.col("no_source"), F.col("source")).alias(u_source),
                                  F.col("unit_size").alias(u_size), "source_size", "target", "copies") for d in done])
    same = (F.col(id).eqNullSafe(F.col(u_id)) & F.col(source).eqNullSafe(F.col(u_source)) & (F.col("size") == F.col(u_size)))
    return (df.join(settled.hint("merge"), same).drop(u_id, u_source, u_size)
            .withColumn("taken", F.col("copies") * F.col("size")))


def copied(mixed: DataFrame) -> DataFrame:
    """The rows of a mix, each as often as it was taken; the added columns go."""
    rows = mixed.where("copies > 0").withColumn("copies", F.explode(F.sequence(F.lit(1), F.col("copies"))))
    return rows.drop("size", "source_size", "target", "copies", "taken")

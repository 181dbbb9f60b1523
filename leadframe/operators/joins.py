"""Join shapes shared by the operators."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def spread_key(needed: Column, key: Column, row_id: Column) -> Column:
    """Join key for the rows that need a lookup, filler for the others.

    Rows without a key would otherwise share one NULL or '' key and land in one
    task.  The filler never equals a real key and spreads them evenly.
    """
    filler = F.concat(F.lit("\x00"), F.pmod(F.xxhash64(row_id), F.lit(65536)).cast("string"))
    return F.when(needed, key).otherwise(filler)


def pinned(df: DataFrame, name: str, value: Column) -> DataFrame:
    """Add a column whose expression stays where it is written.

    A filter on a projected column is pushed below the projection, which
    repeats the expression, and across equi joins.  A generated column is the
    barrier for expressions that are costly to repeat.
    """
    return df.select("*", F.explode(F.array(value)).alias(name))


def hot_keys(rows: DataFrame, key: Column, share: float, name: str = "_hk") -> DataFrame:
    """Keys that hold more than ``share`` of all rows: at most ``1 / share``.

    Rows are counted map-side first, so the hot key itself is no problem here.
    """
    counts = rows.groupBy(key.alias(name)).agg(F.count("*").alias("_n"))
    total = rows.agg(F.count("*")).scalar()
    return counts.where(F.col("_n") > total * F.lit(share)).select(name)


def lookup(base: DataFrame, table: DataFrame, key: Column, table_key: str,
           values: list[str], row_id: str | None = None, hot_share: float | None = 0.01,
           counted: Column | None = None) -> DataFrame:
    """Left-join ``values`` of a table with one row per key.

    The table grows with the data and gets no broadcast hint.  With ``row_id``
    the keys that hold more than ``hot_share`` of the base rows are answered
    from a broadcast of at most ``1 / hot_share`` rows, and their rows are
    spread over the shuffle like rows without a key.  ``counted`` is a cheaper
    expression to count by when ``key`` is costly and mostly equal to it.
    Counting reads the base once more; ``hot_share=None`` leaves it out.
    """
    answers = table.select(F.col(table_key).alias("_lk"), F.struct(*values).alias("_lv"))
    keyed = base.withColumn("_bk", key)
    if row_id is None or hot_share is None:
        joined = keyed.join(answers, F.col("_bk") == F.col("_lk"), "left")
        return joined.select(*base.columns, *[F.col(f"_lv.{v}").alias(v) for v in values])
    hot = hot_keys(base, key if counted is None else counted, hot_share)
    # a merge join shuffles the table exactly as the main join does, so that one
    # exchange serves both and the table is computed once
    hot = hot.join(answers.hint("merge"), F.col("_hk") == F.col("_lk"), "left") \
        .select("_hk", F.col("_lv").alias("_hv"))
    marked = keyed.join(F.broadcast(hot), F.col("_bk") == F.col("_hk"), "left") \
        .withColumn("_sk", spread_key(F.col("_hk").isNull(), F.col("_bk"), F.col(row_id)))
    joined = marked.join(answers, F.col("_sk") == F.col("_lk"), "left")
    return joined.select(*base.columns, *[
        F.coalesce(f"_hv.{v}", f"_lv.{v}").alias(v) for v in values])


_PROBES = 4
_MOST_BITS = 1 << 26


def might_be_in(key: Sequence[str | Column], wanted: DataFrame, wanted_key: Sequence[str]) -> Column:
    """Whether a row's key may be among those of a written table: never wrong about a key that is.

    A Bloom filter of the wanted keys is computed once, as a scalar of at most 8 MB
    (16 bits for a key while they last), and tested where the rows are read.  So rows with large
    columns can be reduced to small ones before anything is joined.
    """
    spark = wanted.sparkSession
    bits = 1 << max(10, min(_MOST_BITS.bit_length() - 1, (16 * wanted.count()).bit_length()))
    places = lambda columns: [F.pmod(F.xxhash64(F.lit(i), *columns), F.lit(bits)) for i in range(_PROBES)]
    marks = wanted.select(F.explode(F.array(*places(wanted_key))).alias("at")) \
        .groupBy(F.shiftright("at", 6).alias("id")).agg(F.bit_or(F.call_function("shiftleft", F.lit(1).cast("bigint"), (F.col("at") % 64).cast("int"))).alias("bits"))
    words = spark.range(bits // 64).join(marks, "id", "left").agg(F.sort_array(F.collect_list(
        F.struct("id", F.coalesce("bits", F.lit(0).cast("bigint")).alias("bits")))).alias("words"))
    held = words.select(F.transform("words", lambda w: w["bits"])).scalar()
    tests = [F.bit_get(F.get(held, F.shiftright(at, 6).cast("int")), (at % 64).cast("int")) == 1 for at in places(key)]
    out = tests[0]
    for test in tests[1:]:
        out = out & test
    return out

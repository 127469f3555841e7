"""Sums and means of doubles of any magnitude: exact, free of partition order, and without a value that is too large.

A finite double is a whole number times a power of two. That number is cut into pieces of 32 bits, each on its place
in one long binary number that spans all doubles, and pieces of one place are added up as integers. Only the few places of a
group are put together at the end, where the one rounding happens.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: The smallest double is 2 to the -1074; a factor of two more is left for the scaling below.
_LOWEST = 1140
_BITS = 32


def _pieces(column: str) -> str:
    """SQL of the array of (place, part) of a finite double, nulls and zeros without any.

    The logarithm may be wrong by one at a power of two; the scaled number is whole all the same and below 2 to the 55th.
    Scaling by two powers of two, either exact, keeps the steps inside the range of doubles.
    """
    exponent = f"CAST(floor(log2(abs({column}))) AS int) - 53"
    half = f"(-({exponent})) div 2"
    whole = f"CAST({column} * pow(2D, {half}) * pow(2D, -({exponent}) - {half}) AS bigint)"
    parts = []
    for shift, part in ((0, f"({whole} & 134217727)"), (27, f"shiftright({whole}, 27)")):
        place = f"({exponent} + {_LOWEST + shift})"
        moved = f"shiftleft({part}, {place} % {_BITS})"
        parts.append(f"struct({place} div {_BITS} AS place, {moved} & 4294967295 AS part)")
        parts.append(f"struct({place} div {_BITS} + 1L AS place, shiftright({moved}, {_BITS}) AS part)")
    return f"IF({column} <> 0 AND abs({column}) < double('Infinity'), array({', '.join(parts)}), NULL)"


def wide_sums(df: DataFrame, keys: Sequence[str], column: str) -> DataFrame:
    """keys, `total`, `average` and `n` of a double column: the exact sum, rounded once, and its quotient by the rows.

    Nulls, NaN and infinities are not counted; a group without any other value has null sums and n 0. No rows give no groups. A sum beyond
    the doubles is an infinity. Pieces are added up inside each partition first and never overflow.
    """
    if not keys:
        return wide_sums(df.select(F.lit(0).alias("all"), column), ["all"], column).drop("all")
    names = [f"k{i}" for i in range(len(keys))]
    rows = df.select(*(F.col(k).alias(n) for k, n in zip(keys, names)), F.col(column).cast("double").alias("v"))
    finite = F.abs("v") < float("inf")
    counted = rows.groupBy(*names).agg(F.count_if(finite).alias("n"))
    pieces = rows.select(*names, F.spark_partition_id().alias("part_of"), F.expr(f"explode({_pieces('v')})").alias("piece"))
    pieces = pieces.groupBy(*names, "part_of", "piece.place").agg(F.sum("piece.part").alias("part"))
    places = pieces.groupBy(*names, "place").agg(F.sum(F.col("part").cast("decimal(38,0)")).alias("part"))
    held = places.groupBy(*names).agg(F.collect_list(F.struct("place", F.col("part").cast("string").alias("part"))).alias("places"))
    joined = counted.alias("c").join(held.alias("h"), [F.col(f"c.{n}").eqNullSafe(F.col(f"h.{n}")) for n in names], "left")
    joined = joined.select(*(F.col(f"c.{n}") for n in names), "n", "places")
    schema = ", ".join([*(f"{f.name} {f.dataType.simpleString()}" for f in joined.schema.fields if f.name in names), "total double", "average double", "n long"])

    def put_together(batches: Iterator) -> Iterator:
        import pyarrow as pa

        def quotient(number: int, divisor: int) -> float:
            try:
                return number / divisor
            except OverflowError:
                return float("inf") if number > 0 else float("-inf")

        for batch in batches:
            totals, averages = [], []
            for places, n in zip(batch.column("places").to_pylist(), batch.column("n").to_pylist()):
                number = sum(int(p["part"]) << (_BITS * p["place"]) for p in places or ())
                totals.append(quotient(number, 1 << _LOWEST) if n else None)
                averages.append(quotient(number, n << _LOWEST) if n else None)
            columns = [*(batch.column(name) for name in names), pa.array(totals, pa.float64()), pa.array(averages, pa.float64()), batch.column("n")]
            yield pa.RecordBatch.from_arrays(columns, names=[*names, "total", "average", "n"])

    found = joined.mapInArrow(put_together, schema)
    return found.select(*(F.col(n).alias(k) for n, k in zip(names, keys)), "total", "average", "n")

"""Running sums, running maxima and the row before, in two passes, for keys of any size.

A window holds a key in one task. Here rows are dealt by ranges of key and order, so a key with very many rows lies in many
parts. The first pass goes through each part by itself; of a part, its last row tells what the next one begins with. These
last rows, one a part, are put together, and the second pass adds to the rows of each part's first key what came before.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import BooleanType, DoubleType, IntegerType, LongType, StructField, StructType

from ledgerline.sources import files


@dataclass(frozen=True)
class Sum:
    """The sum of a numeric column up to and with a row; nulls add nothing."""

    of: Column
    whole: bool = True


@dataclass(frozen=True)
class Max:
    """The greatest value of a column of whole numbers up to and with a row; null before the first that is not null."""

    of: Column


@dataclass(frozen=True)
class Before:
    """A column's value in the row before; null in a key's first row."""

    of: Column


_LEAST = np.iinfo(np.int64).min


def _changes(columns, last) -> np.ndarray:
    """Where a row's keys differ from the row before; nulls are equal. last: the keys of the row before the first, or None."""
    import pyarrow as pa
    import pyarrow.compute as pc

    n = len(columns[0]) if columns else 0
    out = np.zeros(n, bool)
    if not n:
        return out
    out[0] = last is None or any(c[0].as_py() != x for c, x in zip(columns, last))
    for c in columns:
        a, b = c.slice(1), c.slice(0, n - 1)
        other = pc.fill_null(pc.not_equal(a, b), False)
        gap = pc.xor(pc.is_null(a), pc.is_null(b))
        out[1:] |= np.asarray(pc.or_(other, gap).cast(pa.uint8())).astype(bool)
    return out


def parts(df: DataFrame, keys: list[str], order: list[str], number: int | None = None) -> DataFrame:
    """Rows dealt by ranges of keys and order, sorted within each, with the number of their part as __part."""
    number = number or int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return df.repartitionByRange(number, *keys, *order).sortWithinPartitions(*keys, *order).withColumn("__part", F.spark_partition_id())


def _first_pass(df: DataFrame, keys: list[str], sums: list[str], maxima: list[str], lags: list[str], whole: dict[str, bool]) -> DataFrame:
    """Adds to each row, within its part: the sums and maxima so far, the row before, its place, whether its key is the part's first and whether it is that key's first row."""
    import pyarrow as pa

    names = df.schema.names
    more = [*[StructField(f"__run_{c}", LongType() if whole[c] else DoubleType()) for c in sums], *[StructField(f"__run_{c}", LongType()) for c in maxima], *[StructField(f"__run_{c}", df.schema[c].dataType) for c in lags]]
    more += [StructField("__place", LongType()), StructField("__first", BooleanType()), StructField("__starts", BooleanType())]
    schema = StructType([*df.schema.fields, *more])

    def run(batches):
        last, place, first = None, 0, True
        total = dict.fromkeys(sums, 0)
        most = dict.fromkeys(maxima, _LEAST)
        before = dict.fromkeys(lags)
        for b in batches:
            if not b.num_rows:
                continue
            at = {c: b.column(names.index(c)) for c in names}
            own = [at[c] for c in keys]
            new = _changes(own, last) if keys else np.arange(b.num_rows) + place == 0
            starts = np.flatnonzero(new)
            # The run of rows that each row lies in, 0 for the one that goes on from the batch before.
            group = np.cumsum(new)
            out = []
            for c in sums:
                v = np.nan_to_num(np.asarray(at[c].cast(pa.int64() if whole[c] else pa.float64()).fill_null(0)))
                running = np.cumsum(v)
                base = np.concatenate([[-total[c]], running[starts] - v[starts]])
                own_sum = running - base[group]
                total[c] = own_sum[-1]
                out.append(pa.array(own_sum))
            for c in maxima:
                v = np.asarray(at[c].cast(pa.int64()).fill_null(_LEAST)).copy()
                if not new[0]:
                    v[0] = max(v[0], most[c])
                bounds = np.append(np.unique(np.append(0, starts)), len(v))
                for x, y in zip(bounds[:-1], bounds[1:]):
                    v[x:y] = np.maximum.accumulate(v[x:y])
                most[c] = v[-1]
                out.append(pa.array(v, mask=v == _LEAST))
            for c in lags:
                shifted = pa.concat_arrays([pa.array([before[c]], at[c].type), at[c].slice(0, b.num_rows - 1)])
                before[c] = at[c][b.num_rows - 1].as_py()
                mask = pa.array(new)
                out.append(pa.compute.if_else(mask, pa.scalar(None, at[c].type), shifted))
            places = np.arange(place, place + b.num_rows)
            firsts = np.full(b.num_rows, False) if not first else (group - (group[0] if place == 0 else 0)) == 0
            first = first and bool(firsts[-1])
            place += b.num_rows
            last = [c[b.num_rows - 1].as_py() for c in own]
            yield pa.RecordBatch.from_arrays([*b.columns, *out, pa.array(places), pa.array(firsts), pa.array(new)], schema.names)

    return df.mapInArrow(run, schema)


def running(df: DataFrame, keys: list[str], order: list[str], add: dict[str, Sum | Max | Before], number: int | None = None) -> DataFrame:
    """Adds columns that a window over the keys, in the order, from the first row to the current, would give.

    Rows of one key and one order have no order among them, and stay in one part: order should tell a key's rows apart.
    Null keys are a key, null orders come first. Columns that are added replace those of the same name. An empty table is
    given back with the columns. The rows are written once between the passes; what the second pass takes from the other
    parts is one row a part, which is sent to all tasks: its size is that of so many rows, however many rows the table has.
    """
    kept = [c for c in df.columns if c not in add]
    values = {f"__v{i}": x for i, x in enumerate(add.values())}
    typed = {n: x.of.cast("long") if isinstance(x, Max) or (isinstance(x, Sum) and x.whole) else x.of.cast("double") if isinstance(x, Sum) else x.of for n, x in values.items()}
    sums, maxima, lags = ([n for n, x in values.items() if isinstance(x, kind)] for kind in (Sum, Max, Before))
    own = parts(df.withColumns(typed).select(*dict.fromkeys([*kept, *keys, *order]), *values), keys, order, number)
    local = files.kept(_first_pass(own, keys, sums, maxima, lags, {n: getattr(values[n], "whole", True) for n in sums}), "running")
    key = F.struct(*[F.col(k).alias(f"k{i}") for i, k in enumerate(keys)]) if keys else F.lit(True)
    ends = local.groupBy("__part").agg(
        F.min_by(key, "__place").alias("first"), F.max_by(key, "__place").alias("last"),
        F.max_by(F.struct(*[F.col(f"__run_{n}").alias(n) for n in [*sums, *maxima]], *[F.col(n) for n in lags], F.lit(0).alias("none")), "__place").alias("end"),
    )
    of_key = Window.partitionBy("last").orderBy("__part").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    whole = ends.withColumns({f"c{n}": (F.sum if n in sums else F.max)(f"end.{n}").over(of_key) for n in [*sums, *maxima]})
    # One row a part: the part before it, whatever numbers lie between.
    by_part = Window.orderBy("__part")
    goes_on = F.lag("last").over(by_part).eqNullSafe(F.col("first")) & F.lag(F.lit(True)).over(by_part).isNotNull()
    carried = whole.select("__part", goes_on.alias("__goes_on"), *[F.lag(f"c{n}").over(by_part).alias(f"__c{n}") for n in [*sums, *maxima]], *[F.lag(f"end.{n}").over(by_part).alias(f"__c{n}") for n in lags])
    rows = local.join(F.broadcast(carried), "__part")
    here = F.col("__goes_on") & F.col("__first")
    out = {}
    for name, (n, x) in zip(add, values.items()):
        got, come = F.col(f"__run_{n}"), F.col(f"__c{n}")
        if isinstance(x, Sum):
            out[name] = got + F.when(here, come).otherwise(0)
        elif isinstance(x, Max):
            out[name] = F.when(here, F.greatest(got, come)).otherwise(got)
        else:
            out[name] = F.when(here & F.col("__starts"), come).otherwise(got)
    return rows.select(*kept, *[c.alias(name) for name, c in out.items()])

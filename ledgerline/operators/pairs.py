"""Similarities that are worked out once for each two texts, not once a row."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgerline.functions import similarity
from ledgerline.sources import files


class Pairs:
    """Stands in for functions.similarity where an expression is put together: it notes what is compared and gives columns to come.

    by = Pairs()
    score = some_score(F.col("a"), F.col("b"), by=by)
    rows.transform(by.compared).withColumn("score", score).transform(by.without)

    A comparison that a condition makes needless should be asked for with a null, which costs nothing.
    """

    def __init__(self) -> None:
        self.wanted: dict[str, list[tuple[str, Column, Column]]] = {}

    def _note(self, kind: str, a: Column, b: Column) -> Column:
        own = self.wanted.setdefault(kind, [])
        own.append((f"__{kind}_{len(own)}", a, b))
        return F.col(own[-1][0])

    def ratio(self, a: Column, b: Column) -> Column:
        return self._note("ratio", a, b)

    def token_set_ratio(self, a: Column, b: Column) -> Column:
        return self._note("token_set_ratio", a, b)

    def partial_ratio(self, a: Column, b: Column) -> Column:
        return self._note("partial_ratio", a, b)

    def compared(self, rows: DataFrame) -> DataFrame:
        """Rows with all that was noted. Different pairs are found by an aggregate that is combined before the shuffle, compared, written, and joined back by equality; a pair with a null is null."""
        for kind, own in self.wanted.items():
            rows = rows.withColumns({f"{n}_{k}": x for n, a, b in own for k, x in (("a", a), ("b", b))})
            each = F.explode(F.array(*[F.struct(F.col(f"{n}_a").alias("__a"), F.col(f"{n}_b").alias("__b")) for n, _, _ in own])).alias("p")
            two = rows.select(each).select("p.*").filter("__a is not null and __b is not null").distinct()
            known = files.kept(two.withColumn("__s", getattr(similarity, kind)(F.col("__a"), F.col("__b"))), "pairs")
            for n, _, _ in own:
                one = known.select(F.col("__a").alias(f"{n}_x"), F.col("__b").alias(f"{n}_y"), F.col("__s").alias(n))
                rows = rows.join(one, (F.col(f"{n}_a") == F.col(f"{n}_x")) & (F.col(f"{n}_b") == F.col(f"{n}_y")), "left").drop(f"{n}_a", f"{n}_b", f"{n}_x", f"{n}_y")
        return rows

    def without(self, rows: DataFrame) -> DataFrame:
        return rows.drop(*[n for own in self.wanted.values() for n, _, _ in own])

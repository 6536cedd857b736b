"""Similarities of texts as native expressions: 100 times shares of common subsequences."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

#: Positions that one number holds as bits, with room for a carry.
BITS = 61


def chars(x: Column) -> Column:
    return F.filter(F.split(x, ""), lambda c: c != "")


def let(value: Column, f) -> Column:
    """f of a value that is computed once: inside other lambdas a plain expression would be computed at every step."""
    return F.get(F.transform(F.array(value), f), 0)


def _shift(n: Column) -> Column:
    return F.call_function("shiftleft", F.lit(1).cast("long"), n)


def common_length(a: Column, b: Column) -> Column:
    """Length of the longest common subsequence of two texts.

    The shorter text's positions are bits. A sign of the longer one is added where it stands in the shorter; carries
    move along the bits, and those left unset count the subsequence. Where each sign stands is worked out once, for the
    signs that both have; others change nothing and are left out. A text of more than BITS positions is an array of
    numbers, a step goes through them from the first on, and what is carried out of one is added to the next.
    """

    def masks(xs: Column, first: Column, n: Column, sign: Column) -> Column:
        """Bits of the positions first to first + n at which a sign stands."""
        return F.aggregate(F.sequence(F.lit(0), n - 1), F.lit(0).cast("long"), lambda m, i: F.when(F.get(xs, first + i) == sign, m.bitwiseOR(_shift(i))).otherwise(m))

    def one(v: Column) -> Column:
        full = _shift(v["n"]) - 1
        table = F.transform(v["signs"], lambda c: masks(v["xs"], F.lit(0), v["n"], c))

        def of(w: Column) -> Column:
            step = lambda bits, m: (bits + bits.bitwiseAND(m)).bitwiseOR(bits.bitwiseAND(F.bitwise_not(m))).bitwiseAND(w["full"])
            return F.bit_count(w["full"].bitwiseAND(F.bitwise_not(F.aggregate(w["places"], w["full"], lambda bits, i: step(bits, F.get(w["table"], i)))))).cast("int")

        return let(F.struct(full.alias("full"), table.alias("table"), v["places"].alias("places")), of)

    def many(v: Column) -> Column:
        words = F.sequence(F.lit(0), F.floor((v["n"] - 1) / BITS).cast("int"))
        size = lambda k: F.least(v["n"] - k * BITS, F.lit(BITS))
        table = F.transform(v["signs"], lambda c: F.transform(words, lambda k: masks(v["xs"], k * BITS, size(k), c)))
        full = F.transform(words, lambda k: _shift(size(k)) - 1)
        start = F.struct(F.array().cast("array<bigint>").alias("bits"), F.lit(0).cast("long").alias("carry"))

        def add(state: Column, z: Column) -> Column:
            """A word's bits, its mask and its full set: the sum, what goes over its end to the next word."""
            total = z["b"] + z["b"].bitwiseAND(z["m"]) + state["carry"]
            own = total.bitwiseOR(z["b"].bitwiseAND(F.bitwise_not(z["m"]))).bitwiseAND(z["f"])
            return F.struct(F.concat(state["bits"], F.array(own)).alias("bits"), F.call_function("shiftright", total, F.lit(BITS)).alias("carry"))

        def of(w: Column) -> Column:
            def step(bits: Column, i: Column) -> Column:
                named = F.zip_with(F.zip_with(bits, F.get(w["table"], i), lambda b, m: F.struct(b.alias("b"), m.alias("m"))), w["full"], lambda z, f: F.struct(z["b"].alias("b"), z["m"].alias("m"), f.alias("f")))
                return F.aggregate(named, start, add, lambda s: s["bits"])

            left = F.zip_with(F.aggregate(w["places"], w["full"], step), w["full"], lambda b, f: F.bit_count(f.bitwiseAND(F.bitwise_not(b))))
            return F.aggregate(left, F.lit(0), lambda n, x: n + x.cast("int"))

        return let(F.struct(full.alias("full"), table.alias("table"), v["places"].alias("places")), of)

    def of(v: Column) -> Column:
        # Places of the longer text's signs among those that both texts have.
        signs = F.array_intersect(v["xs"], v["ys"])
        places = lambda w: F.filter(F.transform(w["ys"], lambda y: F.array_position(w["signs"], y).cast("int") - 1), lambda i: i >= 0)
        own = let(F.struct(v["xs"].alias("xs"), v["ys"].alias("ys"), signs.alias("signs")), lambda w: F.struct(w["xs"].alias("xs"), w["signs"].alias("signs"), places(w).alias("places"), F.size(w["xs"]).alias("n")))
        return let(own, lambda w: F.when(F.size(w["signs"]) == 0, 0).when(w["n"] <= BITS, one(w)).otherwise(many(w)))

    ordered = let(F.struct(chars(a).alias("p"), chars(b).alias("q")), lambda v: F.when(F.size(v["p"]) <= F.size(v["q"]), F.struct(v["p"].alias("xs"), v["q"].alias("ys"))).otherwise(F.struct(v["q"].alias("xs"), v["p"].alias("ys"))))
    return F.when(a == b, F.length(a)).when(a.isNotNull() & b.isNotNull(), let(ordered, of))


def ratio(a: Column, b: Column) -> Column:
    """200 * common subsequence / both lengths; 100 if both are empty, null if one is null."""
    total = F.length(a) + F.length(b)
    return F.when(total == 0, 100.0).otherwise(200.0 * common_length(a, b) / total)


def token_set_ratio(a: Column, b: Column) -> Column:
    """By common words: 100 if one text's words are all among the other's, 0 if either has none.

    Else the best of the ratios between the common words, sorted, and these with the rest of either text, or between
    the rests with what both share.
    """
    words = lambda t: F.array_distinct(F.filter(F.split(F.trim(t), r"\s+"), lambda w: w != ""))
    rest = lambda p, q: F.array_join(F.array_sort(F.array_except(p, q)), " ")

    def parts(v: Column) -> Column:
        both = F.array_intersect(v["x"], v["y"])
        return F.struct((F.size(v["x"]) == 0).alias("no_x"), (F.size(v["y"]) == 0).alias("no_y"), F.length(F.array_join(both, " ")).alias("size"), F.when(F.size(both) > 0, 1).otherwise(0).alias("gap"), rest(v["x"], v["y"]).alias("left"), rest(v["y"], v["x"]).alias("right"))

    def of(v: Column) -> Column:
        size, gap, left, right = v["size"], v["gap"], v["left"], v["right"]
        with_left, with_right = size + gap + F.length(left), size + gap + F.length(right)
        apart = F.length(left) + F.length(right) - 2 * common_length(left, right)
        rests = 100.0 * (1 - apart / (with_left + with_right))
        shared = F.greatest(100.0 * (1 - (gap + F.length(left)) / (size + with_left)), 100.0 * (1 - (gap + F.length(right)) / (size + with_right)))
        return F.when(v["no_x"] | v["no_y"], 0.0).when((gap > 0) & ((left == "") | (right == "")), 100.0).when(gap > 0, F.greatest(rests, shared)).otherwise(rests)

    own = let(F.struct(words(a).alias("x"), words(b).alias("y")), parts)
    return F.when(a.isNotNull() & b.isNotNull(), let(own, of))


def partial_ratio(a: Column, b: Column) -> Column:
    """The best ratio of the shorter text to any stretch of the longer one of its length, or cut at the ends; of two of one length, either way."""

    def of(v: Column) -> Column:
        x, y = v["x"], v["y"]
        n, m = F.length(x), F.length(y)
        stretch = lambda i: F.substring(y, F.greatest(i, F.lit(1)), n - F.greatest(1 - i, F.lit(0)))
        best = F.array_max(F.transform(F.sequence(2 - n, m), lambda i: ratio(x, stretch(i))))
        return F.when(n == 0, F.when(m == 0, 100.0).otherwise(0.0)).otherwise(best)

    way = lambda p, q: let(F.struct(p.alias("x"), q.alias("y")), of)
    n, m = F.length(a), F.length(b)
    return F.when(n < m, way(a, b)).when(n > m, way(b, a)).when(a == b, 100.0).when(n == m, F.greatest(way(a, b), way(b, a)))


def sounds(x: Column) -> Column:
    """Soundex of a text, empty for a blank one."""
    return F.when(F.trim(F.coalesce(x, F.lit(""))) == "", "").otherwise(F.soundex(x))

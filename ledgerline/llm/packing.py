"""Operator 9, best-two-fit packing.

Only the first piece of a document can be shorter than a sequence, so what has to be packed is a histogram of at most
``cap`` lengths, whatever the number of documents. The packing is planned on it, with equal bins planned once and
counted; documents then find their places by their rank among those of equal length.
"""

from __future__ import annotations

import zlib
from bisect import bisect_right

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from . import common, tokens

CAP = 1024


def plan(counts: dict[int, int], cap: int = CAP) -> list[tuple[tuple[int, ...], int]]:
    """Bins as (lengths, how many such bins). counts: documents of each length from 1 to cap.

    A bin is filled greedily, always with the largest document that fits. Then its smallest document goes back if two
    unpacked ones fit the gap it leaves, and the bin gets fuller by them. A bin is repeated while its lengths last:
    nothing that led to it has changed until then.
    """
    left = [0] * (cap + 1)
    for length, n in counts.items():
        left[length] = n
    lengths = sorted((x for x in counts if counts[x] > 0), reverse=True)
    bins = []
    while lengths:
        used: dict[int, int] = {}
        gap = cap
        for x in lengths:
            if x <= gap:
                n = min(gap // x, left[x])
                used[x], gap = n, gap - n * x
            if not gap:
                break
        least = min(used)
        if gap and sum(used.values()) > 1:
            spare = {x: left[x] - used.get(x, 0) for x in lengths}
            free = sorted(x for x in spare if spare[x] > 0 and x < gap + least)
            best, i, j = least, 0, len(free) - 1
            pair = None
            while i <= j:
                a, b = free[i], free[j]
                if a + b > gap + least:
                    j -= 1
                    continue
                if a + b > best and (i < j or spare[a] > 1):
                    best, pair = a + b, (a, b)
                i += 1
            # Two of one length lie where the pointers may not meet.
            for a in free:
                if spare[a] > 1 and best < 2 * a <= gap + least:
                    best, pair = 2 * a, (a, a)
            if pair:
                used[least] -= 1
                for a in pair:
                    used[a] = used.get(a, 0) + 1
                used = {x: n for x, n in used.items() if n}
        times = min(left[x] // n for x, n in used.items())
        bins.append((tuple(x for x in sorted(used, reverse=True) for _ in range(used[x])), times))
        for x, n in used.items():
            left[x] -= n * times
        lengths = [x for x in lengths if left[x]]
    return bins


def places(bins: list[tuple[tuple[int, ...], int]]) -> tuple[dict[int, tuple[list, list]], int]:
    """For each length the ranks at which a kind of bin begins, and (rank, first bin, documents a bin, offset) of each."""
    out: dict[int, tuple[list, list]] = {}
    first = 0
    for lengths, times in bins:
        offset, i = 0, 0
        while i < len(lengths):
            x, n = lengths[i], lengths.count(lengths[i])
            ranks, runs = out.setdefault(x, ([0], []))
            runs.append((ranks[-1], first, n, offset))
            ranks.append(ranks[-1] + n * times)
            offset, i = offset + n * x, i + n
        first += times
    return out, first


def _cut(n: int, cap: int) -> list[int]:
    return [n] if n <= cap else [n % cap] * (n % cap > 0) + [cap] * (n // cap)


def pack(docs: DataFrame, path: str, cap: int = CAP, end: int = 2, with_ids: bool = False) -> DataFrame:
    """A row a piece: doc_id, piece, start, length, ids_crc32, sequence_id, offset, and ids array<int> if asked for.

    A null text is empty: it is one piece that holds the end id. Equal rows are packed as often as they come. An empty
    table gives no rows. Columns other than doc_id and text are not read.
    """
    import pyarrow as pa

    spark = docs.sparkSession
    spec = tokens.spec(spark, path)
    tail = int(end).to_bytes(4, "little")

    def measure(batches):
        encode = tokens.encoder(spec.value)
        for b in batches:
            ns, crcs, ids = [], [], []
            for text in b.column(1).to_pylist():
                code = encode(text or "") + tail
                n, at, own = len(code) // 4, 0, []
                cuts = _cut(n, cap)
                for size in cuts:
                    own.append(zlib.crc32(code[4 * at : 4 * (at + size)]))
                    at += size
                ns.append(n)
                crcs.append(own)
                if with_ids:
                    ids.append(code)
            cols = [b.column(0), pa.array(ns, pa.int64()), pa.array(crcs, pa.list_(pa.int64()))]
            yield pa.RecordBatch.from_arrays(cols + ([pa.array(ids, pa.binary())] if with_ids else []), ["doc_id", "n", "crcs"] + ["code"] * with_ids)

    kind = dict(docs.dtypes)["doc_id"]
    extra = ", code binary" if with_ids else ""
    sized = docs.select("doc_id", "text").mapInArrow(measure, f"doc_id {kind}, n bigint, crcs array<bigint>{extra}")
    # part_of: the length of the piece to be packed, 0 if all pieces are full; deal: so that documents of one length are ranked in many tasks.
    deal = 4 * max(16, int(spark.conf.get("spark.sql.shuffle.partitions")))
    part_of = F.when(F.col("n") < cap, F.col("n")).otherwise(F.col("n") % cap)
    sized = sized.withColumn("part_of", part_of.cast("int")).withColumn("full", (F.col("n") / cap).cast("long"))
    sized = common.keep(sized.withColumn("deal", F.pmod(F.xxhash64("doc_id", "n", "crcs"), F.lit(deal)).cast("int")), "sized")
    groups = sized.groupBy("part_of", "deal").agg(F.count("*").alias("docs"), F.sum("full").alias("fulls"))
    before = Window.partitionBy("part_of").orderBy("deal").rowsBetween(Window.unboundedPreceding, -1)
    groups = common.keep(groups.select("part_of", "deal", "docs", "fulls", F.coalesce(F.sum("docs").over(before), F.lit(0)).alias("docs_before"), F.coalesce(F.sum("fulls").over(before), F.lit(0)).alias("fulls_before")), "groups")
    totals = {r[0]: (r[1], r[2]) for r in common.collect(groups.groupBy("part_of").agg(F.sum("docs"), F.sum("fulls")))}  # at most cap rows
    where, n_bins = places(plan({x: n for x, (n, _) in totals.items() if x}, cap))
    base, at = {}, n_bins
    for x in sorted(totals):
        base[x], at = at, at + totals[x][1]

    own = Window.partitionBy("part_of", "deal").orderBy("doc_id", "n", "crcs")
    ranked = sized.withColumn("nth", F.row_number().over(own) - 1)
    ranked = ranked.withColumn("own_fulls", F.coalesce(F.sum("full").over(own.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)))
    ranked = ranked.join(groups.select("part_of", "deal", "docs_before", "fulls_before"), ["part_of", "deal"])
    ranked = ranked.select("doc_id", "n", "crcs", "part_of", (F.col("nth") + F.col("docs_before")).alias("rank"), (F.col("own_fulls") + F.col("fulls_before")).alias("fulls"), *["code"] * with_ids)

    def place(batches):
        names = ["doc_id", "piece", "start", "length", "ids_crc32", "sequence_id", "offset"]
        kinds = [None, pa.int32()] + [pa.int64()] * 5
        for b in common.sliced(batches):
            out = [[] for _ in names]
            ids, index = [], []
            code = b.column(6).to_pylist() if with_ids else None
            rows = zip(*(b.column(i).to_pylist() for i in range(1, 6)))
            for row, (n, crcs, part, rank, fulls) in enumerate(rows):
                start, full = 0, base[part] + fulls
                for piece, (size, crc) in enumerate(zip(_cut(n, cap), crcs)):
                    if size == cap:
                        seq, offset, full = full, 0, full + 1
                    else:
                        ranks, runs = where[part]
                        lo, first, each, offset = runs[bisect_right(ranks, rank) - 1]
                        seq, offset = first + (rank - lo) // each, offset + (rank - lo) % each * part
                    for o, v in zip(out[1:], (piece, start, size, crc, seq, offset)):
                        o.append(v)
                    index.append(row)
                    if with_ids:
                        ids.append([int.from_bytes(code[row][i : i + 4], "little") for i in range(4 * start, 4 * (start + size), 4)])
                    start += size
            cols = [b.column(0).take(pa.array(index, pa.int64()))] + [pa.array(o, k) for o, k in zip(out[1:], kinds[1:])]
            yield pa.RecordBatch.from_arrays(cols + ([pa.array(ids, pa.list_(pa.int32()))] if with_ids else []), names + ["ids"] * with_ids)

    extra = ", ids array<int>" if with_ids else ""
    return ranked.mapInArrow(place, f"doc_id {kind}, piece int, start bigint, length bigint, ids_crc32 bigint, sequence_id bigint, offset bigint{extra}")


def assemble(pieces: DataFrame) -> DataFrame:
    """The sequences themselves, from pieces with ids: sequence_id, ids, and the doc_ids in their order. At most cap ids each."""
    order = F.array_sort(F.collect_list(F.struct("offset", "doc_id", "ids")))
    return pieces.groupBy("sequence_id").agg(order.alias("p")).select("sequence_id", F.flatten("p.ids").alias("ids"), F.col("p.doc_id").alias("doc_ids"))


def digest(docs: DataFrame) -> DataFrame:
    import public_tokenizers

    return pack(docs, public_tokenizers.path("byte_bpe_50k.json"))

"""Operator 5, n-gram Jaccard join with count-vector R-trees.

A document is the set of its distinct five-word shingles. Hashed into GROUPS groups, a set becomes a point, its counts.
The sum of the lesser coordinates of two points bounds their overlap, and so does the same sum over the upper corner of
a box of an R-tree; boxes whose bound cannot reach the needed overlap are passed over, pairs that survive are verified
on the sets themselves.

One tree over a whole corpus would prune little and fit no machine, so the space is dealt first: sets that reach the
similarity share one of the first tokens of each under any fixed order (about a quarter of each set), so each such token
has a tree of its own over the sets that have it. Trees would still meet all pairs of a group of near copies. Two
passes avoid that: first each set is compared with one or two others of its tokens only, and what is linked is one component;
then trees look for pairs of different components, and pass over boxes that hold one component. What is lost are links
within a component that is already connected, none between components.
"""

from __future__ import annotations

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import common

N = 5
#: Groups for sets of up to so many shingles: the larger a set, the more groups it takes for the bound to tell sets apart.
GROUPS = ((512, 256), (4096, 1024), (1 << 62, 4096))
#: A count that a coordinate cannot hold: a set with one has it everywhere, and pairs of this total size need no bound.
FULL, UNBOUNDED = 65535, 1 << 22
#: A pair links if OVER * intersection >= UNDER * (sum of sizes): 100 I >= 75 U.
OVER, UNDER = 7, 3
#: Documents in which shingles are counted to put the frequent last in the order; how many such shingles at most. The
#: order may be any, so these bounds change the cost and never the result.
SAMPLE, FREQUENT = 8192, 200_000
#: Members of one tree; a larger token is dealt out in blocks of it, each pair of blocks once.
TREE, LEAF = 4096, 32
#: Turns of comparing components before the trees.
TURNS = 1
#: Members that are compared with a set in one task.
HUB = 512
#: Entries (token, set) that a task gathers before it hands them on.
ENTRIES = 1 << 21
#: Entries of one token among these from which on they are dealt by their sets, over all buckets.
HOT = 2048

_FOLD = bytes(c + 32 if 65 <= c <= 90 else c for c in range(256))
_U = np.uint64
_P = _U(0x9E3779B97F4A7C15)


class _Known(dict):
    def __missing__(self, word):
        import xxhash

        if len(self) > 1 << 18:
            self.clear()
        out = self[word] = xxhash.xxh3_64_intdigest(word)
        return out


_known = _Known()


def words(text: bytes | None) -> list[bytes]:
    return [] if text is None else text.translate(_FOLD).split()


def _mix(h: np.ndarray) -> np.ndarray:
    h = (h ^ (h >> _U(32))) * _U(0xD6E8FEB86659FD93)
    h = (h ^ (h >> _U(32))) * _U(0xD6E8FEB86659FD93)
    return h ^ (h >> _U(32))


def shingles(texts: list[bytes | None]) -> list[np.ndarray]:
    """For each text the sorted 64-bit hashes of its distinct shingles."""
    lists = [words(t) for t in texts]
    w = np.fromiter((h for x in lists for h in map(_known.__getitem__, x)), _U, sum(map(len, lists)))
    s = w[: len(w) - N + 1].copy()
    for k in range(1, N):
        s = s * _P + w[k : len(w) - N + 1 + k]
    s = _mix(s)
    out, at = [], 0
    for x in lists:
        n = len(x)
        if n >= N:
            own = np.sort(s[at : at + n - N + 1])
            own = own[np.concatenate(([True], own[1:] != own[:-1]))]
        elif n:
            h = np.array([n], _U)
            for v in w[at : at + n]:
                h = h * _P + v
            own = _mix(h)
        else:
            own = s[:0]
        out.append(own)
        at += n
    return out


def key_of(own: np.ndarray) -> int | None:
    """A set's name: a signed 64-bit hash of it; None for the empty set."""
    import xxhash

    if not len(own):
        return None
    k = xxhash.xxh3_64_intdigest(own.tobytes())
    return k - (1 << 64) if k >> 63 else k


def kind_of(n: int) -> int:
    return next(k for k, (most, _) in enumerate(GROUPS) if n <= most)


def vector(own: np.ndarray) -> np.ndarray:
    groups = GROUPS[kind_of(len(own))][1]
    counts = np.bincount((own >> _U(65 - groups.bit_length())).astype(np.int64), minlength=groups)
    if counts.max() < 256:
        return counts.astype("u1")
    return (counts if counts.max() < FULL else np.full(groups, FULL)).astype("<u2")


def point(raw: bytes) -> np.ndarray:
    """A point as a row of 64-bit integers."""
    return np.frombuffer(raw, "u1" if any(len(raw) == g for _, g in GROUPS) else "<u2").astype(np.int64)[None]


def folded(vec: np.ndarray, groups: int) -> np.ndarray:
    """Points (rows) with fewer groups: neighbouring counts are summed, as a shorter prefix of the hash would count."""
    return vec.reshape(len(vec), groups, -1).sum(axis=2) if vec.shape[1] != groups else vec


def points(raw: list[bytes], groups: int) -> np.ndarray:
    return np.stack([folded(point(r), groups)[0].astype(np.int32) for r in raw])


def links(n: int, m: int, common_n: int) -> bool:
    return OVER * common_n >= UNDER * (n + m)


class Box:
    """A node of the R-tree: the upper corner of its points, their least and largest sizes, and their component if it is one."""

    __slots__ = ("rows", "hi", "least", "most", "part", "kids")

    def __init__(self, rows, size, vec, part):
        v = vec[rows]
        self.rows, self.hi = rows, v.max(axis=0)
        self.least, self.most = int(size[rows].min()), int(size[rows].max())
        own = part[rows]
        self.part = own[0] if (own == own[0]).all() else None
        self.kids = ()
        if len(rows) > LEAF and self.part is None:
            # Components first: boxes of one component can be passed over; else the coordinate that spreads most.
            values, counts = np.unique(own, return_counts=True)
            if counts.max() * 2 >= len(rows):
                inside = own == values[counts.argmax()]
                halves = rows[inside], rows[~inside]
            else:
                spread = v.std(axis=0) / np.sqrt(v.mean(axis=0) + 1)
                by = size[rows] if size[rows].std() > 0.2 * size[rows].mean() else v[:, spread.argmax()]
                order = rows[np.argsort(by, kind="stable")]
                halves = order[: len(order) // 2], order[len(order) // 2 :]
            self.kids = tuple(Box(h, size, vec, part) for h in halves)


def tree_pairs(size: np.ndarray, vec: np.ndarray, part: np.ndarray, side: np.ndarray | None = None):
    """Pairs of rows in different components whose bound reaches the needed overlap, in arrays of two columns. side: of two blocks, only pairs across them."""
    size, vec = size.astype(np.int64), vec.astype(np.int32)

    def meet(a: Box, b: Box):
        stack = [(a, b)]
        while stack:
            a, b = stack.pop()
            if a.part is not None and a.part == b.part:
                continue
            if 4 * a.most < 3 * b.least or 4 * b.most < 3 * a.least:
                continue
            if OVER * int(np.minimum(a.hi, b.hi).sum()) < UNDER * (a.least + b.least) <= UNDER * UNBOUNDED:
                continue
            if not a.kids and not b.kids:
                for i in range(0, len(a.rows), 64):
                    for j in range(0, len(b.rows), 64):
                        yield leaf(a.rows[i : i + 64], b.rows[j : j + 64], a is b)
            elif a is b:
                x, y = a.kids
                stack += [(x, x), (x, y), (y, y)]
            elif not b.kids or (a.kids and len(a.rows) >= len(b.rows)):
                stack += [(x, b) for x in a.kids]
            else:
                stack += [(a, x) for x in b.kids]

    def leaf(x: np.ndarray, y: np.ndarray, same: bool) -> np.ndarray:
        bound = np.stack([np.minimum(v, vec[y]).sum(axis=1) for v in vec[x]])
        both = size[x][:, None] + size[y][None, :]
        ok = ((OVER * bound >= UNDER * both) | (both > UNBOUNDED)) & (part[x][:, None] != part[y][None, :])
        i, j = np.nonzero(ok)
        p, q = x[i], y[j]
        keep = p < q if same else np.ones(len(p), bool)
        return np.stack((p[keep], q[keep]), axis=1)

    rows = np.arange(len(size))
    if side is None:
        root = Box(rows, size, vec, part)
        yield from meet(root, root)
    else:
        yield from meet(Box(rows[side == 0], size, vec, part), Box(rows[side == 1], size, vec, part))


def block_pairs(size: np.ndarray, raw: list[bytes], part: np.ndarray, side: np.ndarray | None = None):
    """tree_pairs() of points with different numbers of groups: those of one number in one tree, and next numbers across, folded."""
    kinds = np.array([kind_of(int(n)) for n in size])
    for k in range(len(GROUPS)):
        for rows, across in ((np.flatnonzero(kinds == k), False), (np.flatnonzero((kinds == k) | (kinds == k + 1)), True)):
            own = kinds[rows]
            if len(rows) < 2 or (across and (own == own[0]).all()):
                continue
            if across:  # only sizes near the border can link across it
                near = (own == k) & (4 * size[rows] >= 3 * GROUPS[k][0]) | (own == k + 1) & (3 * size[rows] <= 4 * GROUPS[k][0])
                rows = rows[near]
                if len(rows) < 2:
                    continue
            vec = points([raw[i] for i in rows.tolist()], GROUPS[k][1])
            sides = None if side is None else side[rows]
            if sides is not None and (sides == sides[0]).all():
                continue
            for pairs in tree_pairs(size[rows], vec, part[rows], sides):
                pairs = rows[pairs]
                yield pairs[kinds[pairs[:, 0]] != kinds[pairs[:, 1]]] if across else pairs


def _frequent(docs: DataFrame) -> np.ndarray:
    """Shingles that three documents or more of a bounded sample have, counted by the executors."""
    import pyarrow as pa

    def run(batches):
        for b in batches:
            sets = shingles(b.column(0).to_pylist())
            if sets:
                yield pa.RecordBatch.from_arrays([pa.array(np.concatenate(sets).view(np.int64))], ["h"])

    ids = docs.select("doc_id").filter("doc_id is not null").distinct().orderBy(F.xxhash64("doc_id"), "doc_id").limit(SAMPLE)
    texts = docs.select("doc_id", F.col("text").cast("binary").alias("t")).join(F.broadcast(ids), "doc_id").select("t")
    often = texts.mapInArrow(run, "h bigint").groupBy("h").count().filter("count >= 3").orderBy(F.desc("count"), "h").limit(FREQUENT)
    with common.tuned(docs.sparkSession):
        return np.sort(often.select("h").toArrow().column(0).to_numpy().view(np.uint64))


SETS = "bucket int, doc_id bigint, key bigint, n bigint, vec binary, toks binary, keys binary, homes binary, hot binary"


def _deal(docs: DataFrame, buckets: int) -> DataFrame:
    """Rows of documents (bucket null) and rows of entries for a bucket (tokens of 32 bits and set keys, side by side).

    A token belongs to the bucket that its hash names, its home. Entries of one that is hot go to buckets by their set, with
    their homes; the home is told that the token is hot, as tasks in which it is not send theirs there.
    """
    import pyarrow as pa

    frequent = docs.sparkSession.sparkContext.broadcast(_frequent(docs))
    names = [c.split()[0] for c in SETS.split(", ")]
    kinds = [pa.int32(), pa.int64(), pa.int64(), pa.int64(), *[pa.binary()] * 5]

    def run(batches):
        late = frequent.value
        toks, keys, held, sent = [], [], 0, set()

        def dealt(where, home, t, k, told):
            order = np.argsort(where, kind="stable")
            home, t, k = home[order].astype("<u4"), t[order], k[order]
            cuts = np.searchsorted(where[order], np.arange(buckets + 1)).tolist()
            return [(b, *[None] * 4, t[x:y].tobytes(), k[x:y].tobytes(), home[x:y].tobytes() if told else None, None) for b, (x, y) in enumerate(zip(cuts[:-1], cuts[1:])) if y > x]

        def flush():
            nonlocal toks, keys, held
            t = _mix(np.concatenate(toks)) if toks else np.zeros(0, _U)
            k = np.repeat(np.array([x[0] for x in keys], np.int64), [x[1] for x in keys]) if keys else np.zeros(0, np.int64)
            home, t = ((t >> _U(32)) % _U(buckets)).astype(np.int64), (t & _U(0xFFFFFFFF)).astype("<u4")
            name = home << 32 | t
            order = np.argsort(name, kind="stable")
            name, home, t, k = name[order], home[order], t[order], k[order].astype("<i8")
            first = np.flatnonzero(np.diff(name, prepend=name[:1] - 1))
            sizes = np.diff(np.append(first, len(name)))
            hot = np.repeat(sizes > HOT, sizes)
            rows = dealt(home[~hot], home[~hot], t[~hot], k[~hot], False)
            if hot.any():
                rows += dealt((_mix(k[hot].view(_U)) % _U(buckets)).astype(np.int64), home[hot], t[hot], k[hot], True)
                own = first[sizes > HOT]
                rows += [(b, *[None] * 4, None, None, None, t[own[home[own] == b]].tobytes()) for b in np.unique(home[own]).tolist()]
            toks, keys, held = [], [], 0
            return pa.RecordBatch.from_arrays([pa.array(c, kind) for c, kind in zip(zip(*rows), kinds)] if rows else [pa.array([], kind) for kind in kinds], names)

        for b in batches:
            rows = []
            for doc, own in zip(b.column(0).to_pylist(), shingles(b.column(1).to_pylist())):
                key = key_of(own)
                rows.append((None, doc, key, len(own), vector(own).tobytes() if len(own) else None, *[None] * 4))
                if key is None or key in sent:
                    continue
                if len(sent) < 1 << 20:
                    sent.add(key)
                n = len(own)
                first = n - (3 * n + 3) // 4 + 1
                if len(late):
                    at = np.minimum(np.searchsorted(late, own), len(late) - 1)
                    hot = late[at] == own
                    own = np.concatenate((own[~hot][:first], own[hot][: max(0, first - int((~hot).sum()))]))
                else:
                    own = own[:first]
                toks.append(own)
                keys.append((key, len(own)))
                held += len(own)
            yield pa.RecordBatch.from_arrays([pa.array(c, kind) for c, kind in zip(zip(*rows), kinds)] if rows else [pa.array([], kind) for kind in kinds], names)
            if held >= ENTRIES:
                yield flush()
        yield flush()

    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("binary").alias("text")).mapInArrow(run, SETS)


def _runs(entries: DataFrame) -> DataFrame:
    """Tokens that two sets or more have: (token, keys, hot, s, n), keys ascending signed 64-bit integers in bytes.

    A hot token has several rows, and one for a single set may be among them. s: a sum over the keys' hashes, of n keys.
    """
    import pyarrow as pa

    def run(batches):
        toks, keys, told, marked = [], [], [], [np.zeros(0, np.int64)]
        for b in batches:
            for bucket, t, k, homes, hot in zip(*(b.column(i).to_pylist() for i in range(5))):
                if hot is not None:
                    marked.append(np.frombuffer(hot, "<u4").astype(np.int64) | bucket << 32)
                    continue
                toks.append(np.frombuffer(t, "<u4").astype(np.int64) | (bucket if homes is None else np.frombuffer(homes, "<u4").astype(np.int64)) << 32)
                keys.append(np.frombuffer(k, "<i8"))
                told.append(np.full(len(keys[-1]), homes is not None))
        if not toks:
            return
        t, k, told = np.concatenate(toks), np.concatenate(keys), np.concatenate(told)
        del toks, keys
        order = np.lexsort((k, t))
        t, k, told = t[order], k[order], told[order]
        new = np.ones(len(t), bool)
        new[1:] = (t[1:] != t[:-1]) | (k[1:] != k[:-1])
        t, k, told = t[new], k[new], told[new]
        cuts = np.flatnonzero(np.concatenate(([True], t[1:] != t[:-1], [True])))
        hot = (np.add.reduceat(told, cuts[:-1]) > 0) | np.isin(t[cuts[:-1]], np.concatenate(marked))
        long = np.flatnonzero((np.diff(cuts) > 1) | hot)
        sums = np.add.reduceat(_mix(k.view(_U)), cuts[:-1]).view(np.int64)
        for at in range(0, len(long), 4096):
            own = long[at : at + 4096]
            raw = [k[cuts[i] : cuts[i + 1]].tobytes() for i in own.tolist()]
            cols = [pa.array(t[cuts[own]]), pa.array(raw, pa.binary()), pa.array(hot[own]), pa.array(sums[own]), pa.array(cuts[own + 1] - cuts[own])]
            yield pa.RecordBatch.from_arrays(cols, ["token", "keys", "hot", "s", "n"])

    return entries.select("bucket", "toks", "keys", "homes", "hot").repartition("bucket").mapInArrow(run, "token bigint, keys binary, hot boolean, s bigint, n bigint")


def _distinct(runs: DataFrame) -> DataFrame:
    """Tokens that the same sets have say the same: one of them is enough. Of hot ones, sums over all their sets are compared."""
    few = runs.filter("not hot").dropDuplicates(["keys"])
    sums = runs.filter("hot").groupBy("token").agg(F.sum(F.col("s").cast("decimal(38,0)")).alias("s"), F.sum(F.xxhash64("s").cast("decimal(38,0)")).alias("z"), F.sum("n").alias("n"))
    kept = sums.filter("n > 1").groupBy("s", "z", "n").agg(F.min("token").alias("token")).select("token")
    return few.union(runs.filter("hot").join(kept, "token", "left_semi").select(*few.columns)).select("token", "keys")


def _members(runs: DataFrame) -> DataFrame:
    """Rows (token, key, degree): who has a token, and how many of these tokens each has."""
    import pyarrow as pa

    def run(batches):
        for b in batches:
            keys = [np.frombuffer(raw, "<i8") for raw in b.column(1).to_pylist()]
            if keys:
                yield pa.RecordBatch.from_arrays([pa.array(np.repeat(b.column(0).to_numpy(), [len(k) for k in keys])), pa.array(np.concatenate(keys))], ["token", "key"])

    rows = runs.mapInArrow(run, "token bigint, key bigint")
    return rows.join(rows.groupBy("key").agg(F.count("*").alias("degree")), "key").select("token", "key", "degree")


def _stars(pairs: DataFrame) -> DataFrame:
    """Of what each set may be compared with (a, b, degree of b), the one met most often and the one of most tokens.

    Any choice would do, trees see to the rest. Of near copies of one text that text has most tokens, as each copy lacks
    those that it changed; it links copies that are too far from each other to link.
    """
    met = pairs.groupBy("a", "b").agg(F.count("*").alias("n"), F.max("degree").alias("degree"))
    best = met.groupBy("a").agg(F.max_by("b", F.struct("n", "degree", "b")).alias("often"), F.max_by("b", F.struct("degree", "n", "b")).alias("most"))
    return best.select("a", F.explode(F.array_distinct(F.array("often", "most"))).alias("b"))


def _between(members: DataFrame, parts: DataFrame | None, turn: int) -> DataFrame:
    """Pairs (a, b, degree) of a member of each component of a token and a member of one of its components.

    Without components every set is one. On even turns members of most tokens are taken, else others each turn.
    """
    rank = F.col("degree") if turn % 2 == 0 else F.xxhash64("key", F.lit(turn))
    if parts is None:
        first = members.select("token", F.col("key").alias("part"), F.struct(rank.alias("r"), "key", "degree").alias("k"))
    else:
        named = members.join(parts.withColumnRenamed("node", "key"), "key", "left").withColumn("part", F.coalesce("component", "key"))
        first = named.groupBy("token", "part").agg(F.max(F.struct(rank.alias("r"), "key", "degree")).alias("k"))
    heads = first.groupBy("token").agg(F.max(F.struct("k", "part")).alias("head"), F.count("*").alias("parts")).filter("parts > 1")
    return first.join(heads, "token").filter(F.col("part") != F.col("head.part")).select(F.col("k.key").alias("a"), F.col("head.k.key").alias("b"), F.col("head.k.degree").alias("degree"))


def _bounded(pairs: DataFrame, sets: DataFrame) -> DataFrame:
    """The pairs whose count vectors allow the needed overlap."""
    import pyarrow as pa

    def run(batches):
        for b in batches:
            if not b.num_rows:
                continue
            v, w, n, m = (b.column(i).to_pylist() for i in (2, 3, 4, 5))
            ok = []
            for x, y, p, q in zip(v, w, n, m):
                x, y = point(x), point(y)
                groups = min(x.shape[1], y.shape[1])
                overlap = int(np.minimum(folded(x, groups), folded(y, groups)).sum())
                ok.append(p + q > UNBOUNDED or (OVER * overlap >= UNDER * (p + q)))
            yield pa.RecordBatch.from_arrays([b.column(0), b.column(1)], ["a", "b"]).filter(pa.array(ok, pa.bool_()))

    own = sets.select("key", "n", "vec")
    rows = pairs.join(own.select(F.col("key").alias("a"), F.col("n").alias("na"), F.col("vec").alias("va")), "a").join(own.select(F.col("key").alias("b"), F.col("n").alias("nb"), F.col("vec").alias("vb")), "b")
    return rows.select("a", "b", "va", "vb", "na", "nb").mapInArrow(run, "a bigint, b bigint")


def _verified(pairs: DataFrame, sets: DataFrame, docs: DataFrame) -> DataFrame:
    """The pairs that link. The text of one document of each set goes to the sets it is to be compared with.

    Pairs meet at b. A set that very many are compared with is sent to several tasks, so none has them all.
    """
    import pyarrow as pa

    hubs = pairs.groupBy("b").agg(F.ceil(F.count("*") / HUB).cast("int").alias("salts"))
    members = pairs.join(hubs, "b").select(F.col("a").alias("key"), F.col("b").alias("dest"), F.pmod(F.xxhash64("a"), F.col("salts")).cast("int").alias("salt"), F.lit(1).alias("part"))
    send = members.union(hubs.select(F.col("b").alias("key"), F.col("b").alias("dest"), F.explode(F.sequence(F.lit(0), F.col("salts") - 1)).alias("salt"), F.lit(0).alias("part")))
    send = common.keep(send.join(sets.select("key", "least", "n"), "key"), "send")
    texts = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("binary").alias("text"))
    # The filter drops nothing; it lets Spark prune documents by a Bloom filter before they are dealt.
    found = texts.join(send.filter("n > 0"), texts["doc_id"] == send["least"]).select("key", "dest", "salt", "part", "text")
    unnamed = send.filter("least is null")
    if not common.is_empty(unnamed):

        def name(batches):
            for b in batches:
                t = b.column(0).to_pylist()
                yield pa.RecordBatch.from_arrays([pa.array([key_of(own) for own in shingles(t)], pa.int64()), b.column(0)], ["key", "text"])

        found = found.union(unnamed.join(texts.filter("doc_id is null").select("text").mapInArrow(name, "key bigint, text binary"), "key").select("key", "dest", "salt", "part", "text"))

    def test(batches):
        at, hub = None, None
        for b in batches:
            ok = []
            keys, dests, salts, parts = (b.column(i).to_pylist() for i in range(4))
            for key, dest, salt, part, own in zip(keys, dests, salts, parts, shingles(b.column(4).to_pylist())):
                if (dest, salt) != at:
                    at, hub = (dest, salt), None
                if key_of(own) != key:  # another text under the same doc_id
                    ok.append(False)
                elif part == 0:
                    hub = own
                    ok.append(False)
                else:
                    i = np.minimum(np.searchsorted(hub, own), len(hub) - 1)
                    ok.append(links(len(own), len(hub), int((hub[i] == own).sum())))
            yield pa.RecordBatch.from_arrays([b.column(0), b.column(1)], ["a", "b"]).filter(pa.array(ok, pa.bool_()))

    dealt = found.repartition("dest", "salt").sortWithinPartitions("dest", "salt", "part")
    return common.keep(dealt.mapInArrow(test, "a bigint, b bigint"), "links")


def _across(members: DataFrame, sets: DataFrame, parts: DataFrame) -> DataFrame:
    """Pairs of different components that the trees let through. parts: (node, component) of sets with a link so far."""
    import pyarrow as pa

    members = members.join(parts.withColumnRenamed("node", "key"), "key", "left")
    members = members.select("token", "key", F.coalesce("component", "key").alias("part"))
    mixed = members.groupBy("token").agg(F.min("part").alias("p"), F.max("part").alias("q"), F.count("*").alias("m")).filter("p <> q")
    mixed = common.keep(mixed.select("token", F.ceil(F.col("m") / TREE).cast("int").alias("blocks")), "mixed")
    rows = members.join(mixed, "token")
    block = F.pmod(F.xxhash64("key"), F.col("blocks")).cast("int")
    rows = rows.withColumn("block", block)
    # One block: once. More: block i goes to each pair (i, j), i <= j, in which it takes part.
    rows = rows.withColumn("other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
    rows = rows.select("token", "key", "part", F.least("block", "other").alias("i"), F.greatest("block", "other").alias("j"), "block")
    rows = rows.join(sets.select("key", "n", "vec"), "key").repartition("token", "i", "j").sortWithinPartitions("token", "i", "j")

    def run(batches):
        held, at = [], None

        def solve():
            key = np.array([r[0] for r in held], np.int64)
            part = np.array([r[1] for r in held], np.int64)
            size = np.array([r[3] for r in held], np.int64)
            side = None if at[1] == at[2] else (np.array([r[2] for r in held]) != at[1]).astype(int)
            for pairs in block_pairs(size, [r[4] for r in held], part, side):
                if len(pairs):
                    yield np.sort(key[pairs], axis=1)

        out: list[np.ndarray] = []

        def told():
            pairs = np.unique(np.concatenate(out), axis=0)
            out.clear()
            return pa.RecordBatch.from_arrays([pa.array(pairs[:, 0]), pa.array(pairs[:, 1])], ["a", "b"])

        def solved():
            n = sum(map(len, out))
            for pairs in solve():
                out.append(pairs)
                n += len(pairs)
                if n > 1 << 18:
                    yield told()
                    n = 0

        for b in batches:
            for token, key, part, i, j, block, n, vec in zip(*(b.column(c).to_pylist() for c in range(8))):
                if (token, i, j) != at:
                    if held:
                        yield from solved()
                    held, at = [], (token, i, j)
                held.append((key, part, block, n, vec))
        if held:
            yield from solved()
        if out:
            yield told()

    return rows.select("token", "key", "part", "i", "j", "block", "n", "vec").mapInArrow(run, "a bigint, b bigint").distinct()


def classes(docs: DataFrame) -> DataFrame:
    """A row a document: doc_id, n_shingles, component_id (the smallest doc_id reachable over links, itself included).

    Null and empty texts have the empty set and link with nothing; their component is their own doc_id. Documents with
    equal sets link. A null doc_id is passed over when the smallest is sought, and is the component only of documents
    that reach no other. Only doc_id and text are read. An empty table gives no rows.
    """
    spark = docs.sparkSession
    buckets = 4 * max(16, int(spark.conf.get("spark.sql.shuffle.partitions")))
    dealt = common.keep(_deal(docs, buckets), "dealt")
    own = common.keep(dealt.filter("bucket is null").select("doc_id", "key", "n", "vec"), "own")
    # Sets: one row a key, with the document that it can be made again from.
    sets = common.keep(own.filter("key is not null").groupBy("key").agg(F.min("doc_id").alias("least"), F.first("n").alias("n"), F.first("vec").alias("vec")), "keys")
    every = common.keep(_runs(dealt.filter("bucket is not null")), "every")
    common.drop(dealt)
    runs = common.keep(_distinct(every), "runs")
    common.drop(every)
    members = common.keep(_members(runs), "members")
    found = _verified(common.keep(_bounded(_stars(_between(members, None, 0)), sets), "pairs"), sets, docs)
    parts = common.keep(common.components(found), "parts")
    # Again, with components for sets: a member of each is compared, another each turn, while that links many.
    for turn in range(1, TURNS + 1):
        again = _verified(common.keep(_bounded(_stars(_between(members, parts, turn)), sets), "pairs"), sets, docs)
        if common.is_empty(again):
            break
        parts = common.keep(common.components(parts.select(F.col("node").alias("a"), F.col("component").alias("b")).union(again)), "parts")
    across = common.keep(_across(members, sets, parts), "pairs")
    more = _verified(across, sets, docs)
    if not common.is_empty(more):
        parts = common.keep(common.components(parts.select(F.col("node").alias("a"), F.col("component").alias("b")).union(more)), "parts")
    named = sets.select("key", "least").join(parts.withColumnRenamed("node", "key"), "key", "left").select("key", "least", F.coalesce("component", "key").alias("component"))
    tops = named.groupBy("component").agg(F.min("least").alias("component_id"))
    of = named.join(tops, "component").select("key", "component_id")
    docs_of = own.select("doc_id", "key", "n").join(of, "key", "left")
    return docs_of.select("doc_id", F.col("n").alias("n_shingles"), F.when(F.col("key").isNull(), F.col("doc_id")).otherwise(F.col("component_id")).alias("component_id"))


def dedupe(docs: DataFrame) -> DataFrame:
    """One document of each group of linked ones stays, that with the smallest doc_id; rows of one doc_id stay or go together."""
    gone = classes(docs).filter("doc_id <> component_id").select(F.col("doc_id").alias("__gone")).distinct()
    return docs.join(gone, docs["doc_id"] == gone["__gone"], "left_anti")


ORACLE = r"""
WITH RECURSIVE w AS (SELECT doc_id, list_filter(regexp_split_to_array(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[\x20\x09-\x0D]+'), lambda x: x <> '') AS ws FROM documents),
s AS (SELECT DISTINCT doc_id, array_to_string(ws[i:i + 4], ' ') AS k FROM w, unnest(range(1, greatest(2, len(ws) - 3))) r(i) WHERE len(ws) > 0),
n AS (SELECT doc_id, count(*) AS n FROM s GROUP BY doc_id),
p AS (SELECT a.doc_id AS x, b.doc_id AS y, count(*) AS c FROM s a JOIN s b ON a.k = b.k AND a.doc_id < b.doc_id GROUP BY ALL),
l AS (SELECT x, y FROM p JOIN n a ON a.doc_id = x JOIN n b ON b.doc_id = y WHERE 100 * c >= 75 * (a.n + b.n - c)),
e AS (SELECT x, y FROM l UNION SELECT y, x FROM l),
r AS (SELECT doc_id AS x, doc_id AS y FROM n UNION SELECT r.x, e.y FROM r JOIN e ON r.y = e.x),
c AS (SELECT x AS doc_id, min(y) AS component_id FROM r GROUP BY x)
SELECT w.doc_id, coalesce(n, 0)::BIGINT AS n_shingles, coalesce(component_id, w.doc_id) AS component_id FROM w LEFT JOIN n USING (doc_id) LEFT JOIN c USING (doc_id)
"""

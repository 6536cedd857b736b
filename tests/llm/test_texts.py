"""Decontamination, personal data, quality, toxicity, sharding."""

import hashlib
import random
import re
import zlib

import pytest

from ledgerline.llm import decontam, pii, quality, sharding, toxicity

from .fixtures import ODD, docs

WORD = re.compile("[^\x00-\x2f\x3a-\x60\x7b-\x7f]+")


def fold(text):
    return WORD.findall("".join(c.lower() if "A" <= c <= "Z" else c for c in text or ""))


def brute_hits(text, items):
    ws = fold(text)
    hit, names = set(), set()
    for name, t in items:
        own = fold(t)
        for i in range(max(1, len(own) - 12) if own else 0):
            w = own[i : i + 13]
            for k in range(len(ws) - len(w) + 1):
                if ws[k : k + len(w)] == w:
                    hit.update(range(k, k + len(w)))
                    names.add(str(name))
    return len(ws), len(hit), len(names), hashlib.sha256(",".join(sorted(names)).encode()).hexdigest(), bool(hit) and 20 * len(hit) >= len(ws)


@pytest.mark.parametrize("size", [1 << 20, 40])
def test_contamination(spark, monkeypatch, size):
    monkeypatch.setattr(decontam, "WORDS", size)
    rng = random.Random(6)
    vocabulary = ["a", "b", "straße", "Été", "x1"]
    prose = lambda n: " ".join(rng.choice(vocabulary) for _ in range(n))
    items = [(10, prose(20)), (9, prose(13)), (2, "Two Words"), (33, "x1"), (4, ""), (5, None), (6, "--"), (10, prose(15))]
    texts = [*ODD, "two  words", "TWO; words x", "two", *(prose(rng.randint(1, 30)) + " " + rng.choice(items)[1].__str__() + "! " + prose(200 * rng.randint(0, 1)) for _ in range(30)), items[0][1] * 3]
    bench = spark.createDataFrame(items, "item_id bigint, text string")
    got = {r["doc_id"]: tuple(r)[1:] for r in decontam.digest(docs(spark, texts), bench).collect()}
    assert [got[i + 1] for i in range(len(texts))] == [brute_hits(t, items) for t in texts]
    left = decontam.clean(docs(spark, texts), bench)
    assert sorted(r["doc_id"] for r in left.collect()) == [i + 1 for i, t in enumerate(texts) if not brute_hits(t, items)[4]] and left.columns[-1] == "part"


def test_contamination_of_awkward_tables(spark):
    bench = spark.createDataFrame([(1, "a b")], "item_id bigint, text string")
    assert decontam.digest(docs(spark, []), bench).collect() == []
    assert [r["n_hit"] for r in decontam.digest(docs(spark, ["a b", "a b"]), bench.filter("item_id > 1")).collect()] == [0, 0]
    assert sorted((r["doc_id"] or 0, r["n_hit"]) for r in decontam.digest(docs(spark, [(None, "a b"), (7, "a b"), (7, "b a")]), bench).collect()) == [(0, 2), (7, 0), (7, 2)]


def test_proximity(spark):
    index = decontam.build(docs(spark, ["red big car", "car red", "red a b c d car", "car | red fast car", None]))
    got = sorted((r["doc_id"], r["first"], r["last"]) for r in decontam.proximity(index, "Red car", 1).collect())
    assert got == [(1, 0, 2), (2, 0, 1), (4, 0, 1), (4, 1, 3)]


def test_one_index_serves_any_benchmark(spark, monkeypatch):
    monkeypatch.setattr(decontam, "MARKS", 4)
    index = decontam.build(docs(spark, ["a b c d", "c d e", "x a b", None]))
    for text, hits in (("a b", [2, 0, 2, 0]), ("c d", [2, 2, 0, 0]), ("d e f", [0, 0, 0, 0]), ("a a", [0, 0, 0, 0])):
        rows = decontam.search(index, spark.createDataFrame([("i", text), ("j", text)], "name string, text string")).collect()
        assert [r["n_hit"] for r in sorted(rows, key=lambda r: r["doc_id"])] == hits and all(r["items"] == (["i", "j"] if r["n_hit"] else []) for r in rows)


def test_spans_against_all_stretches():
    rng = random.Random(2)
    for _ in range(200):
        texts = [[rng.choice([b"a", b"b", b"c", b"d"]) for _ in range(rng.randint(0, 12))] for _ in range(3)]
        flat = [w for t in texts for w in (*t, None)]
        terms = sorted({w for t in texts for w in t})
        at = [[i for i, w in enumerate(flat) if w == t] for t in terms]
        seg = decontam.Index(terms, decontam.np.array([len(x) for x in at], int), decontam.np.array([i for x in at for i in x], int), decontam.np.array([len(t) for t in texts]))
        want, slop = rng.sample([b"a", b"b", b"c"], rng.randint(1, 3)), rng.randint(0, 3)
        got = seg.near(want, slop)
        whole = lambda i, j: None not in flat[i : j + 1] and set(want) <= set(flat[i : j + 1])
        least = [(i, j) for j in range(len(flat)) for i in range(max(0, j - len(want) - slop + 1), j + 1) if whole(i, j) and not whole(i + 1, j) and not (j and i < j and whole(i, j - 1))]
        assert got == least


def plain_base(text):
    out = []
    for m in re.finditer(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", text):
        out.append((0, *m.span()))
    for m in re.finditer(r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)", text):
        if all(int(p) <= 255 for p in m[0].split(".")):
            out.append((1, *m.span()))
    for m in re.finditer(r"[0-9]([\x20-]?[0-9])+", text):
        d = re.sub("[ -]", "", m[0])
        odd = sum(int(c) for c in d[-1::-2]) + sum(sum(divmod(2 * int(c), 10)) for c in d[-2::-2])
        if 16 <= len(d) <= 19 and odd % 10 == 0:
            out.append((2, *m.span()))
    for m in re.finditer(r"\+[0-9][\x20().0-9-]+[0-9]", text):
        if 8 <= len(re.findall("[0-9]", m[0])) <= 15:
            out.append((3, *m.span()))
    return out


def test_base_spans_are_those_of_the_patterns():
    rng = random.Random(8)
    parts = ["a.b@c.de", "@", "x@y", "é@b.c", "+1 (555) 010-9999", "1.2.3.4", "300.1.1.1.2", "4111 1111 1111 1111", "4111-1111-1111-1112", ".", " ", "+", "9", "0" * 17, "@a.b.c@d.ef", "%", "漢", "1.1.1.1.1.1.1.1"]
    for _ in range(4000):
        t = "".join(rng.choice(parts) for _ in range(rng.randint(0, 9)))
        assert pii.base(t) == plain_base(t), t


def test_personal_data(spark):
    texts = [*ODD, "mail a.b@c.de, ip 10.0.0.1", "call (844) 555-2728 now", "card 4111 1111 1111 1111", "write to joe (at) corp5 (dot) net today", "on 2024-01-31 at 10:20, 12,400.50 in 1.2.3"]
    weights = pii.fit([])
    rows = {r["doc_id"]: r for r in pii.digest(docs(spark, texts)).collect()}
    for i, t in enumerate(texts):
        r, base = rows[i + 1], plain_base(t or "")
        assert (r["n_email"], r["n_ip"], r["n_card"], r["n_phone"]) == tuple(sum(k == x for k, _, _ in base) for x in range(4))
        written = ",".join(f"{pii.KINDS[k]}:{s}:{e}" for k, s, e in base)
        assert r["base_sha256"] == hashlib.sha256(written.encode()).hexdigest()
        assert set(filter(None, written.split(","))) <= set(r["spans"].split(","))
    found = lambda t: [(pii.KINDS[k], t[s:e]) for k, s, e in pii.find(t, weights)[1]]
    assert found(texts[-4]) == [("phone", "(844) 555-2728")] and found(texts[-2]) == [("email", "joe (at) corp5 (dot) net")] and found(texts[-1]) == []
    assert pii.blank("x a@b.c y", [(0, 2, 7)]) == "x <EMAIL> y"
    out = pii.redact(docs(spark, texts)).filter("doc_id > 13").orderBy("doc_id").collect()
    assert out[0]["text"] == "mail <EMAIL>, ip <IP>" and out[0]["rank"] == "x" and out[4]["text"] == texts[-1]
    assert pii.digest(docs(spark, [])).collect() == []


def test_the_field_holds_on_made_contexts():
    weights, right, n = pii.fit([]), 0, 0
    for text, gold in pii.contexts([], seed=77):
        right += sorted(pii.find(text, weights)[1]) == sorted(gold) or bool(pii.base(text)) and not gold
        n += 1
    assert right >= 0.93 * n


SPACES = re.compile(r"[\x20\x09-\x0D]+")


def brute_quality(text):
    t = text or ""
    ws = [w for w in SPACES.split(t) if w]
    seen = {}
    for i in range(len(ws) - 2):
        seen.setdefault(tuple(ws[i : i + 3]), []).append(i)
    covered = {i + k for at in seen.values() if len(at) > 1 for i in at for k in range(3)}
    lines = [x for x in t.split("\n") if SPACES.sub("", x)]
    return len(ws), sum(map(len, ws)), sum(c in "#*$%&|<>" for c in t), len(lines) - len(set(lines)), len(covered)


def test_quality(spark):
    rng = random.Random(9)
    texts = [*ODD, "a b c a b c", "a a a a", "l\nl\n\nl\n m", "## && a", *(" ".join(rng.choice("abc") for _ in range(rng.randint(0, 80))) + "\nx\nx" for _ in range(40)), "\n".join(f"w{i} ok fine" for i in range(60))]
    got = {r["doc_id"]: r for r in quality.digest(docs(spark, texts)).collect()}
    for i, t in enumerate(texts):
        r, (n, chars, symbols, dup, rep) = got[i + 1], brute_quality(t)
        assert (r["n_words"], r["word_chars"], r["n_symbols"], r["n_dup_lines"], r["n_repeat_words"]) == (n, chars, symbols, dup, rep), t
        failed = n < 50 or 100 * rep > 50 * n
        assert r["base_failed"] == failed and not (failed and r["kept"])
    assert quality.digest(docs(spark, [])).collect() == []
    book = quality.ledger(docs(spark, texts))
    standard = quality.policy("standard", 1)
    rows = {r["rule"]: r for r in quality.ablate(book, standard).collect()}
    own = [r["fail_bits"] & standard.mask for r in got.values()]
    assert {r["n_rejected"] for r in rows.values()} == {sum(map(bool, own))} and set(rows) == set(standard.rules)
    for rule in quality.RULES[:5]:
        assert rows[rule.name]["n_failed"] == sum(b >> rule.bit & 1 for b in own)
        assert rows[rule.name]["n_only"] == own.count(1 << rule.bit) == sum(r["sole_rule"] == rule.name for r in got.values())
    kept = {(r["policy"], r["version"]): r["n_kept"] for r in quality.compare(book).collect()}
    assert kept == {(p.name, p.version): sum(not r["fail_bits"] & p.mask for r in got.values()) for p in quality.POLICIES}


def test_measurements_of_lines_and_signs(spark):
    text = "- one\n * two...\n\nTHREE 3… \n- one\nfour"
    r = quality.digest(docs(spark, [text, None, (None, "x"), (None, "x")])).collect()
    assert sum(x["doc_id"] is None for x in r) == 2
    r = next(x for x in r if x["doc_id"] == 1)
    assert (r["n_lines"], r["n_bullet_lines"], r["n_ellipsis_lines"], r["n_dup_lines"], r["n_dup_line_chars"], r["n_digits"], r["n_capitals"], r["n_letters"]) == (5, 3, 2, 1, 5, 1, 5, 18)


def test_a_stored_ledger_answers_to_any_policy(spark, tmp_path):
    texts = ["a b c " * 40, "plain words " * 40, "9 " * 60, None]
    quality.write(docs(spark, texts), str(tmp_path / "book"))
    book = quality.read(spark, str(tmp_path / "book"))
    assert "text" not in book.columns and book.count() == 4
    lenient = quality.Policy("lenient", 2, ("digits",))
    assert sorted(r["doc_id"] for r in quality.judge(book, lenient).filter("kept").collect()) == [1, 2, 4]


def toxic_corpus(seed, n=400):
    rng = random.Random(seed)
    word = lambda: rng.choice(["the", "of", "and", "thing", "over", "under", "house", "river", "stone", "letter", "winter"])
    bad = ["grumbar", "snorfel", "blatik"]
    texts, labels = [], []
    for i in range(n):
        ws = [word() for _ in range(rng.randint(5, 60))]
        y = i % 5 == 1
        for _ in range(rng.randint(2, 4) if y else 0):
            ws.insert(rng.randrange(len(ws)), rng.choice(bad))
        texts.append((i, " ".join(ws)))
        labels.append((i, None, int(y)))
    return texts, labels


def test_toxicity(spark):
    texts, labels = toxic_corpus(1)
    texts += [(1000, "snorfel gr u m b a r and g-r-u-m-b-a-r blatik"), (1001, "a sn0rfel of gruuuumbar and bl@tik sn0rf3l"), (1002, None), (1003, ""), (None, "the river"), (1004, "house " * 9000)]
    lab = spark.createDataFrame(labels, "doc_id bigint, quality int, toxic int")
    rows = {r["doc_id"]: r for r in toxicity.digest(docs(spark, texts), lab).collect()}
    assert all(r["held_out"] == (zlib.crc32(str(d if d is not None else "").encode()) % 5 == 0) and 0 <= r["score"] <= 1 and r["predicted"] == (r["score"] >= 0.5) for d, r in rows.items())
    held = [d for d, _, y in labels if rows[d]["held_out"]]
    right = sum(rows[d]["predicted"] == labels[d][2] for d in held)
    assert right >= 0.98 * len(held)
    assert [rows[d]["predicted"] for d in (1000, 1001, 1002, 1003, None, 1004)] == [1, 1, 0, 0, 0, 0]
    assert len({r.doc_id for r in toxicity.clean(docs(spark, texts), lab).collect()} & {1000, 1001}) == 0


def test_labels_of_held_out_rows_change_nothing(spark):
    texts, labels = toxic_corpus(2, 150)
    lab = lambda x: spark.createDataFrame(x, "doc_id bigint, quality int, toxic int")
    other = [(d, q, 1 - y if zlib.crc32(str(d).encode()) % 5 == 0 else y) for d, q, y in labels]
    one, two = ({r["doc_id"]: r["score"] for r in toxicity.digest(docs(spark, texts), lab(x)).collect()} for x in (labels, other))
    assert one == two


def ways(token):
    """All readings of a lattice with their channel's log-probability."""
    out = [("", 0.0)]
    for own in toxicity.lattice(token):
        out = [(w + t, s + c) for w, s in out for t, c in own]
    return out


def test_restored_words_are_the_likeliest_of_all_paths():
    rng = random.Random(4)
    counts: dict = {}
    for _ in range(300):
        for g in toxicity.grams("".join(rng.choice("abeilost") for _ in range(rng.randint(1, 7)))):
            counts[g] = counts.get(g, 0) + 1
    model = toxicity.CharModel(counts)
    score = lambda w, c: c + sum(map(model, toxicity.grams(w)))
    for _ in range(80):
        token = "".join(rng.choice("abeilost013457@$!") * rng.choice([1, 1, 1, 3]) for _ in range(rng.randint(1, 4)))
        scores = [(score(w, c), w) for w, c in ways(token)]
        word = toxicity.restore(token, model)
        assert abs(max(s for s, w in scores if w == word) - max(scores)[0]) < 1e-9, token


def test_repeated_rows_score_alike(spark):
    texts, labels = toxic_corpus(3, 150)
    lab = spark.createDataFrame(labels, "doc_id bigint, quality int, toxic int")
    rows = toxicity.digest(docs(spark, [*texts, *texts[:20], *texts[:20]]), lab).collect()
    assert len(rows) == 190 and len({(r["doc_id"], r["score"]) for r in rows}) == 150


def test_toxicity_of_awkward_tables(spark):
    none = spark.createDataFrame([], "doc_id bigint, quality int, toxic int")
    assert toxicity.digest(docs(spark, []), none).collect() == []
    assert [r["predicted"] for r in toxicity.digest(docs(spark, ["a", None]), none).collect()] == [0, 0]


def test_sharding(spark, tmp_path):
    rng = random.Random(4)
    texts = [(i, "x" * rng.randint(0, 200)) for i in range(300)] + [(7, "y" * 3000), (7, None), (None, "z"), (8, "same"), (8, "same")]
    limit = 1500
    rows = sharding.assign(docs(spark, texts), limit).collect()
    assert len(rows) == len(texts)
    size = {}
    for r in rows:
        size[r["shard"]] = size.get(r["shard"], 0) + r["n_bytes"]
    names = sorted(size)
    assert all(not b.startswith(a) for a, b in zip(names, names[1:])) and all(len(r["shard"]) == r["depth"] and r["shard_bytes"] == size[r["shard"]] for r in rows)
    assert all(r["oversized"] == (size[r["shard"]] > limit) for r in rows)
    assert [r["n_bytes"] for r in rows if r["oversized"]].count(3000) == 1 and sum(r["oversized"] for r in rows) == 1
    # Only what is over the limit was split: every shard's parent, with its other half, is.
    for n in names:
        if n:
            assert sum(v for k, v in size.items() if k.startswith(n[:-1])) > limit
    assert {r["shard"] for r in sharding.assign(docs(spark, texts), 1 << 30).collect()} == {""}
    assert sharding.assign(docs(spark, []), limit).collect() == [] and sharding.limit_of(0) == sharding.LEAST
    sharding.write(docs(spark, texts), str(tmp_path / "out"), limit)
    back = spark.read.parquet(str(tmp_path / "out"))
    assert back.count() == len(texts) and set(docs(spark, []).columns) < set(back.columns)
    own = {}
    for r in back.collect():
        own[r["shard"][1:]] = own.get(r["shard"][1:], 0) + len((r["text"] or "").encode())
    assert own == size


def test_sharding_goes_deeper_where_it_must(spark):
    """Leaves that are over the limit are refined alone, more than once, and one that no bit splits is given up at once."""
    texts = [(i, "x" * 50) for i in range(40)] + [(7, "y" * 900)] * 5 + [(100 + i, "") for i in range(50)]
    h = {r[0]: r[1] for r in docs(spark, texts).select("doc_id", sharding.hash_bits()).collect()}
    rows = sharding.assign(docs(spark, texts), 50).collect()
    assert sum(r["oversized"] and r["depth"] == 60 for r in rows) == 5 and len(h) == 90
    size = {}
    for r in rows:
        size[r["shard"]] = size.get(r["shard"], 0) + r["n_bytes"]
    assert all(v <= 50 or len(k) == 60 for k, v in size.items()) and max(map(len, size)) == 60
    sized = docs(spark, texts).select(sharding.hash_bits().alias("h"), sharding.size().alias("n_bytes"))
    assert len(sharding.directory(sized, 50, 6500)) >= 2

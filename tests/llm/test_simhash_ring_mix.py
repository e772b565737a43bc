"""SimHash near-dedup, sharding and mixing against plain Python versions."""

import random
import zlib
from collections import defaultdict

import numpy as np
import pytest
import xxhash

from lexicarve.llm import common, pareto_mix, ring_sharding, simhash_mih

DOCS = "doc_id long, text string, lang string, source string, n_chars long"


def union(nodes, links):
    par = {n: n for n in nodes}

    def find(x):
        while par[x] != x:
            par[x] = par[par[x]]
            x = par[x]
        return x
    for a, b in links:
        a, b = find(a), find(b)
        par[max(a, b)] = min(a, b)
    return {n: find(n) for n in nodes}


@pytest.fixture(scope="module")
def docs(spark):
    rnd = random.Random(5)
    words = [f"w{i}" for i in range(300)]
    rows = []
    for i in range(0, 120, 4):
        base = [rnd.choice(words) for _ in range(rnd.choice([1, 2, 3, 40, 400]))]
        near = base[:-1] + ["changed"]
        rows += [(i, " ".join(base), "en", f"s{i % 3}", 1), (i + 1, " ".join(base).upper(), "en", None, 1),
                 (i + 2, "\t".join(near) + "\n", None, "s0", 1), (i + 3, " ".join(rnd.sample(words, 50)), "xx", "s2", None)]
    rows += [(900, None, None, None, None), (901, "", "en", "s1", 0), (901, "", "en", "s1", 0), (902, " \t\n", "en", "s1", 0),
             (None, "no id here", "en", "s1", 0), (903, "é " * 20000, "fr", "s1", 0)]
    return spark.createDataFrame(rows, DOCS)


def plain_simhash(text):
    words = "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "").encode().split()
    if not words:
        return 0
    parts = [b" ".join(words[i:i + 3]) for i in range(max(len(words) - 2, 1))]
    h = [xxhash.xxh64_intdigest(p, seed=42) for p in parts]
    return sum(1 << b for b in range(64) if 2 * sum(x >> b & 1 for x in h) > len(h))


def test_probes_are_not_broadcast(spark):
    """Spark takes exploded rows for as few as there were before; 34 probes for each fingerprint must not go through the driver."""
    fps = spark.range(3000).selectExpr("xxhash64(id) as fp")
    plan = simhash_mih.fingerprint_links(fps)._jdf.queryExecution().sparkPlan()
    inside = []

    def visit(node, sent):
        name = node.nodeName()
        if sent and name == "Generate":
            inside.append(name)
        children = node.children()
        for i in range(children.size()):
            # before exchanges are planned, a join names the side that it broadcasts
            side = node.buildSide().toString() if name == "BroadcastHashJoin" else ""
            visit(children.apply(i), sent or side == ("BuildLeft", "BuildRight")[i] if side else sent)

    visit(plan, False)
    assert not inside


def test_components_match_union_find(spark):
    rnd = random.Random(1)
    links = [(rnd.randrange(200), rnd.randrange(200)) for _ in range(150)] + [(i, i + 1) for i in range(300, 360)] + [(500, 500 + i) for i in range(1, 50)]
    df = spark.createDataFrame(links + [(7, None), (9, 9)], "a long, b long")
    got = {r["node"]: r["component"] for r in common.connected_components(df, "t").collect()}
    real = [(a, b) for a, b in links if a != b]
    assert got == union({x for l in real for x in l}, real)
    assert common.connected_components(df.where("a < 0"), "t").count() == 0


def test_simhash_matches_definition():
    for t in [None, "", " ", "One", "one two", "One TWO three", "a b c d e f " * 50, "ünï cödé\x0bx"]:
        assert simhash_mih.simhash(t.encode() if t is not None else None) == plain_simhash(t)


@pytest.mark.parametrize("bucket_rows", [0, 2, 64])
def test_links_connect_the_same_components(spark, bucket_rows):
    rnd = random.Random(2)
    fps = {0, 1, 2, 3, 1 << 63}
    for _ in range(20):
        at = rnd.getrandbits(64)
        for _ in range(12):
            fps.add(at)
            for _ in range(rnd.randrange(4)):
                at ^= 1 << rnd.randrange(64)
    fps = sorted(fps)
    signed = [f - (1 << 64) if f >> 63 else f for f in fps]
    df = spark.createDataFrame([(f,) for f in signed], "fp long")
    got = [(r["a"], r["b"]) for r in simhash_mih.fingerprint_links(df, bucket_rows).collect()]
    mask = (1 << 64) - 1
    assert all(bin((a ^ b) & mask).count("1") <= 2 for a, b in got)
    want = [(a, b) for a in signed for b in signed if a < b and bin((a ^ b) & mask).count("1") <= 2]
    assert union(signed, got) == union(signed, want)


def test_near_duplicates_and_keep_one(spark, docs):
    rows = docs.collect()
    fp = [plain_simhash(r["text"]) for r in rows]
    links = [(a, b) for a in set(fp) for b in set(fp) if bin(a ^ b).count("1") <= 2]
    comp = union(set(fp), links)
    low = defaultdict(lambda: None)
    for r, f in zip(rows, fp):
        if r["doc_id"] is not None:
            low[comp[f]] = min(x for x in (low[comp[f]], r["doc_id"]) if x is not None)
    key = lambda x: (x[0] is None, x[0] or 0, x[1])
    want = sorted([(r["doc_id"], f"{f:016x}", low[comp[f]]) for r, f in zip(rows, fp)], key=key)
    out = simhash_mih.near_duplicates(docs).collect()
    assert sorted([(r["doc_id"], r["fingerprint"], r["component_id"]) for r in out], key=key) == want
    kept = simhash_mih.keep_one(docs)
    assert kept.columns == docs.columns
    ids = [r["doc_id"] for r in kept.collect()]
    assert sorted(i for i in ids if i is not None) == sorted({x for x in low.values() if x is not None})
    assert ids.count(None) == 1
    none = docs.where("doc_id < 0")
    assert simhash_mih.near_duplicates(none).count() == 0 and simhash_mih.keep_one(none).count() == 0


def plain_ring(rows, shards, epsilon):
    """Pieces go round the ring in the order that the operator defines, one at a time per round."""
    total = sum(r["size"] for r in rows)
    limit = max(1.0, total * (epsilon / (4 * shards)))

    def signed(h):
        return h - (1 << 64) if h >> 63 else h

    def xx(*values):
        seed = 42
        for v in values:
            if isinstance(v, int):
                v = (v & ((1 << 64) - 1)).to_bytes(8, "little")
            seed = xxhash.xxh64_intdigest(v, seed=seed)
        return seed
    cells = defaultdict(int)
    for r in rows:
        r["cell"] = (xx(r["doc_id"], b"null") if r["text"] is None else xx(r["text"].encode())) >> (64 - ring_sharding.CELL_BITS)
        cells[r["cell"]] += r["size"]
    pieces = defaultdict(int)
    for r in rows:
        w = cells[r["cell"]]
        n = -(-w // limit) if w > limit else 1
        r["sub"] = signed(xx(r["doc_id"], b"piece")) % int(n) if w > limit else 0
        pieces[r["cell"], r["sub"]] += r["size"]
    cap = -(-total * ((1 + epsilon) / shards) // 1)
    nodes = ring_sharding.vnode_positions(shards)
    pref = {}
    for c, s in pieces:
        at = c * (ring_sharding.RING >> ring_sharding.CELL_BITS)
        pref[c, s] = [x for _, x in sorted((min((p - at) % ring_sharding.RING for p in own), i) for i, own in enumerate(nodes))]
    k = {p: 0 for p in pieces}
    for _ in range(2 * shards):
        filled, new = defaultdict(int), dict(k)
        for p in sorted(pieces, key=lambda p: (k[p], p)):
            s = pref[p][k[p] % shards]
            filled[s] += pieces[p]
            room = cap + (max(pieces.values()) if k[p] >= shards else 0)
            if filled[s] > room:
                new[p] = k[p] + 1
        k = new
    return {p: pref[p][k[p] % shards] for p in pieces}, cap, max(pieces.values())


@pytest.mark.parametrize("hot", [0, 400])
def test_ring(spark, hot):
    rnd = random.Random(3)
    rows = [(i, "".join(rnd.choice("abcdé ") for _ in range(rnd.randrange(80)))) for i in range(600)]
    rows += [(1000 + i, "the same text over and over") for i in range(hot)] + [(5000, None), (5001, None), (5002, ""), (5002, ""), (5003, "y" * 900)]
    df = spark.createDataFrame(rows, "doc_id long, text string").selectExpr("*", "1 AS size", "'x' AS shard", "2 AS cell", "3 AS id")
    out = [r.asDict() for r in ring_sharding.assign(df, epsilon=0.05).collect()]
    assert sorted(r["doc_id"] for r in out) == sorted(i for i, _ in rows)
    text = dict(rows)
    for r in out:
        t = text[r["doc_id"]]
        assert r["size"] == len((t or "").encode()) + 1 and r["text_crc32"] == zlib.crc32((t or "").encode())
        assert r["law"] == "bytes" and r["grown_shard"] is None
        r["text"] = t
    where, cap, most = plain_ring(out, 8, 0.05)
    assert all(r["shard"] == where[r["cell"], r["sub"]] for r in out)
    for s in range(8):
        own = [r for r in out if r["shard"] == s]
        assert sorted(r["slot"] for r in own) == list(range(len(own)))
        assert sum(r["size"] for r in own) <= cap + most


def test_ring_empty_and_one(spark):
    df = spark.createDataFrame([(1, "x")], "doc_id long, text string")
    assert [r["slot"] for r in ring_sharding.assign(df).collect()] == [0]
    assert ring_sharding.assign(df.where("doc_id > 1")).count() == 0


def plain_mix(rows):
    """Targets by sharing the excess again and again; whole copies, then documents in rank order."""
    import hashlib
    import re

    ids, equal = defaultdict(int), defaultdict(int)
    for r in rows:
        ids[r["doc_id"]] += 1
    for r in rows:
        r["size"] = len(re.findall("[^\x20\x09-\x0D]+", r["text"] or ""))
        t = hashlib.md5((r["text"] or "").encode()).hexdigest()
        more = f"#{t}#{equal[r['doc_id'], t, r['source']]}" if ids[r["doc_id"]] > 1 else ""
        equal[r["doc_id"], t, r["source"]] += 1
        h = hashlib.md5(f"{'' if r['doc_id'] is None else r['doc_id']}{more}-{pareto_mix.SEED}".encode()).hexdigest()
        r["u"] = (int(h[:13], 16) + 0.5) / (1 << 52)

    def fill(total, weight, most):
        out, free, left = dict.fromkeys(weight, 0.0), set(weight), float(total)
        while free and left > 1e-9:
            w, add, left = sum(weight[g] for g in free), left, 0.0
            for g in sorted(free):
                out[g] += add * weight[g] / w
                if out[g] > most[g]:
                    left += out[g] - most[g]
                    out[g] = most[g]
                    free.discard(g)
        return out
    size = defaultdict(int)
    for r in rows:
        size[(r["source"] is None, r["source"] or "")] += r["size"]
    names = sorted(size)  # a source without words takes its turn
    target = fill(1.5 * sum(size.values()), {s: (3, 1, 2)[i % 3] for i, s in enumerate(names)}, {s: 2 * size[s] for s in names})
    for s in names:
        own = [r for r in rows if (r["source"] is None, r["source"] or "") == s and r["size"]]
        words = defaultdict(int)
        for r in own:
            r["cls"] = (r["size"] + 1).bit_length() - 1
            words[r["cls"]] += r["size"]
        share = fill(target[s], {c: w / (16 + c) for c, w in words.items()}, {c: 2 * w for c, w in words.items()})
        rest = 0
        for r in own:
            r["e"] = min(2.0, share[r["cls"]] / words[r["cls"]])
        rest = sum((min(2.0, share[c] / w) % 1) * w for c, w in words.items())
        run = 0
        for r in sorted((r for r in own if r["e"] % 1), key=lambda r: ((r["u"] / (1 - r["u"])) / (r["e"] % 1 / (1 - r["e"] % 1)), r["doc_id"] or 0)):
            run += r["size"]
            r["more"] = run - r["size"] / 2 <= rest
        for r in own:
            r["n"] = int(r["e"]) + r.get("more", False)
            r["target"] = target[s]
    return rows


def test_mix(spark, docs):
    rows = plain_mix([r.asDict() for r in docs.where("doc_id is not null").dropDuplicates(["doc_id"]).collect()])
    df = spark.createDataFrame([(r["doc_id"], r["text"], r["source"], "x", 9) for r in rows], "doc_id long, text string, source string, size string, u int")
    got = {r["doc_id"]: r for r in pareto_mix.mix(df).collect()}
    assert len(got) == len(rows)
    for r in rows:
        g = got[r["doc_id"]]
        assert g["size"] == r["size"] and g["taken"] <= 2 * g["size"]
        assert g["n_copies"] == r.get("n", 1)
        if r["size"]:
            assert g["target"] == pytest.approx(r["target"])
    by = defaultdict(list)
    for r in rows:
        by[r["source"]].append(r)
    for own in by.values():
        taken = sum(got[r["doc_id"]]["taken"] for r in own)
        assert abs(taken - max(r.get("target", 0) for r in own)) <= max(r["size"] for r in own)
    out = pareto_mix.mixed(df)
    assert out.columns == df.columns
    copies = defaultdict(int)
    for r in out.collect():
        copies[r["doc_id"]] += 1
    assert copies == {i: g["n_copies"] for i, g in got.items() if g["n_copies"]}


def test_mix_odd_tables(spark, docs):
    none = docs.where("doc_id < -1")
    assert pareto_mix.mix(none).count() == 0 and pareto_mix.mixed(none).count() == 0
    blank = spark.createDataFrame([(1, None, None), (2, " ", "a"), (2, " ", "a")], "doc_id long, text string, source string")
    assert [(r["size"], r["taken"], r["n_copies"]) for r in pareto_mix.mix(blank).collect()] == [(0, 0, 1)] * 3
    assert pareto_mix.mix(docs).count() == docs.count()
    one = spark.createDataFrame([(1, "a b c", "s")], "doc_id long, text string, source string")
    r = pareto_mix.mix(one).first()
    assert (r["target"], r["taken"]) == (4.5, 6)


def test_uniform_is_spread(spark):
    u = np.array([r[0] for r in spark.range(2000).select(pareto_mix.uniform(__import__("pyspark").sql.functions.col("id"))).collect()])
    assert 0 < u.min() and u.max() < 1 and abs(u.mean() - 0.5) < 0.03


def mix_rows(spark, rows):
    df = spark.createDataFrame(rows, "doc_id long, text string, source string")
    return df, pareto_mix.mix(df).collect()


def test_mix_source_without_words_takes_its_turn(spark):
    """a has no words and weighs 3; b weighs 1, c weighs 2: of 3,000 words b gets 1,000 and c 2,000."""
    rows = [(0, "", "a"), (1, None, "a")]
    rows += [(10 + i, "w " * 50, "b") for i in range(20)] + [(100 + i, "w " * 50, "c") for i in range(20)]
    _, out = mix_rows(spark, rows)
    by = {r["doc_id"]: r for r in out}
    assert by[0]["target"] == 0.0 and by[10]["target"] == pytest.approx(1000) and by[100]["target"] == pytest.approx(2000)
    taken = [sum(r["taken"] for r in out if lo <= r["doc_id"] < lo + 50) for lo in (10, 100)]
    assert abs(taken[0] - 1000) <= 50 and taken[1] == 2000


def test_mix_of_repeated_and_null_ids_meets_its_targets(spark):
    rows = [(None, f"w{i} x y z a b c", "s") for i in range(300)] + [(7, "one two three four five", "s")] * 300
    rows += [(1000 + i, "q r s t u v w x y z", "t") for i in range(200)]
    df, out = mix_rows(spark, rows)
    want = plain_mix([dict(zip(("doc_id", "text", "source"), r)) for r in rows])
    assert sorted((r["doc_id"] or -1, r["size"], r["n_copies"]) for r in out) == sorted((r["doc_id"] or -1, r["size"], r["n"]) for r in want)
    for s, size in (("s", 7), ("t", 10)):
        own = [r for r in out if (r["size"] == 10) == (s == "t")]
        assert abs(sum(r["taken"] for r in own) - own[0]["target"]) <= size
    assert pareto_mix.mixed(df.repartition(7)).count() == sum(r["n_copies"] for r in out)


def test_ring_of_repeated_and_null_ids_is_even(spark):
    rows = [(None, "the same text for all of these rows")] * 1500 + [(i, f"text number {i} " * 3) for i in range(1500)] + [(5, "again and again")] * 900
    out = ring_sharding.assign(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    load = defaultdict(int)
    for r in out:
        load[r["shard"]] += r["size"]
    mean = sum(load.values()) / 8
    assert len(out) == len(rows) and max(load.values()) <= 1.01 * mean + 60 and min(load.values()) >= 0.9 * mean
    for s in load:
        assert sorted(r["slot"] for r in out if r["shard"] == s) == list(range(sum(r["shard"] == s for r in out)))


def test_keep_one_judges_rows_that_share_an_id_by_their_texts(spark):
    t = " ".join(f"word{i}" for i in range(60))
    u = " ".join(f"other{i}" for i in range(60))
    rows = [(1, t), (2, t), (2, u), (None, u), (None, "alone here"), (None, "alone here"), (3, "")]
    df = spark.createDataFrame([(*r, "x", 1) for r in rows], "doc_id long, text string, _same string, name int")
    kept = simhash_mih.keep_one(df)
    assert kept.columns == df.columns
    key = lambda r: (r[0] is None, r[0] or 0, r[1])
    assert sorted([(r["doc_id"], r["text"]) for r in kept.collect()], key=key) == [(1, t), (2, u), (3, ""), (None, "alone here")]


@pytest.mark.parametrize("salts", [1, 4])
def test_number_repeated(spark, salts):
    from pyspark.sql import functions as F
    rows = [(1, "a")] * 50 + [(1, "b"), (2, "a"), (None, "c"), (None, "c"), (3, None)]
    df = spark.createDataFrame(rows, "i long, t string").repartition(5)
    same = F.xxhash64(F.col("i").isNull(), "i")
    out = defaultdict(list)
    for r in common.number_repeated(df, same, F.xxhash64(same, "t"), "no", salts).collect():
        out[r["i"], r["t"]].append(r["no"])
    assert sorted(out[1, "a"]) == list(range(50)) and out[1, "b"] == [0] and sorted(out[None, "c"]) == [0, 1]
    assert out[2, "a"] == [None] and out[3, None] == [None]

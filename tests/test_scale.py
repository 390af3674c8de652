"""Operators whose plans must not grow with a hot key, against brute force on shapes the given tables lack."""

import json
import math
import os
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from recordloom.operators import gates, graph, joins, scoring
from recordloom.streaming import flows


# keyed table of runs
def _size(path):
    return sum(os.path.getsize(os.path.join(d, f)) for d, _, fs in os.walk(path) for f in fs if f.endswith(".parquet"))


def _batch(spark, rows):
    return spark.createDataFrame(rows, "k long, ts long, v string, gone boolean").repartition(1)


def test_upsert_writes_follow_the_batch(spark, tmp_path):
    """20 batches of 40 rows over a table of 30,000: none writes more than a few batches' bytes."""
    root, rng = str(tmp_path / "t"), random.Random(4)
    flows.upsert(_batch(spark, [(k, 0, "x" * 30 + str(k), False) for k in range(30_000)]), 0, root, ["k"], ["ts"], fan=4)
    want = {k: (0, "x" * 30 + str(k), False) for k in range(30_000)}
    table, written = _size(f"{root}/runs"), []
    for n in range(1, 21):
        rows = [(rng.randrange(40_000), rng.randrange(n), f"b{n}-{i}", rng.random() < 0.2) for i in range(40)]
        for k, ts, v, gone in sorted(rows, key=lambda r: (r[1], r[2], r[3])):
            if k not in want or (ts, v, gone) > (want[k][0], want[k][1], want[k][2]):
                want[k] = (ts, v, gone)
        before = set(os.listdir(f"{root}/runs"))
        flows.upsert(_batch(spark, rows), n, root, ["k"], ["ts", "v", "gone"], fan=4)
        written.append(sum(_size(f"{root}/runs/{d}") for d in set(os.listdir(f"{root}/runs")) - before))
        if n == 9:  # once more, as after a failure
            flows.upsert(_batch(spark, rows), n, root, ["k"], ["ts", "v", "gone"], fan=4)
    got = {r.k: (r.ts, r.v, r.gone) for r in flows.read_table(spark, root).collect()}
    assert got == want
    assert max(written) < table / 5  # small runs are merged, the table never
    live = {r.k for r in flows.read_live(spark, root, "gone").collect()}
    assert live == {k for k, (_, _, gone) in want.items() if not gone}
    log = json.loads(open(f"{root}/_log/{20:012d}.json").read())
    assert len(log["runs"]) <= 3 * 4 and len(os.listdir(f"{root}/runs")) <= 2 * len(log["runs"]) + 4


def test_upsert_takes_what_is_newer_and_ties_once(spark, tmp_path):
    root = str(tmp_path / "t")
    step = lambda n, rows: flows.upsert(_batch(spark, rows), n, root, ["k"], ["ts"], since="ts")
    step(0, [(1, 5, "a", False), (2, 7, "b", False)])
    step(1, [(2, 7, "again", False), (3, 7, "tie", False), (4, 6, "late", False), (5, 8, "new", None)])
    step(2, [])
    step(3, [(None, 9, "null key", False), (None, 9, "null key", False)])
    got = {r.k: r.v for r in flows.read_table(spark, root).collect()}
    assert got == {1: "a", 2: "b", 3: "tie", 5: "new", None: "null key"}
    assert flows.read_table(spark, str(tmp_path / "none")) is None


def test_newer_takes_ties_once(spark):
    landed = spark.createDataFrame([(1, 5), (2, 7)], "k long, ts long")
    incoming = spark.createDataFrame([(2, 7), (3, 7), (4, 8), (5, 6), (6, None)], "k long, ts long")
    assert sorted(r.k for r in flows.newer(landed, incoming, "ts", ["k"]).collect()) == [3, 4]
    assert flows.newer(landed.limit(0), incoming, "ts", ["k"]).count() == 5


# nearest sites
def _miles(lat, lon, blat, blon):
    y, x, v, u = (np.radians(z) for z in (lat[:, None], lon[:, None], blat[None, :], blon[None, :]))
    return 2 * 3958.7613 * np.arcsin(np.sqrt(np.minimum(np.sin((v - y) / 2) ** 2 + np.cos(y) * np.cos(v) * np.sin((u - x) / 2) ** 2, 1)))


@pytest.mark.parametrize("k", [1, 3])
def test_nearest_anywhere(spark, k):
    """5,000 points: poles, both sides of the 180th meridian, empty oceans, a crowd of sites at one spot."""
    rng = np.random.default_rng(k)
    lat = np.concatenate([rng.uniform(-90, 90, 4000), [90, -90, 0, 0], rng.normal(65, 0.3, 996).clip(-90, 90)])
    lon = np.concatenate([rng.uniform(-180, 180, 4000), [0, 10, 180, -180], rng.normal(-150, 1, 996)])
    blat = np.concatenate([rng.normal(40, 1, 300), np.full(100, 64.5), [89.9, -89, 0.5, -0.5], rng.uniform(-30, 30, 40)])
    blon = np.concatenate([rng.normal(-100, 1, 300), np.full(100, -151.0), [120, 3, 179.9, -179.9], rng.uniform(-180, 180, 40)])
    points = spark.createDataFrame([(int(i), float(a), float(b)) for i, (a, b) in enumerate(zip(lat, lon))] + [(9_999, None, 1.0)], "p long, lat double, lon double")
    sites = spark.createDataFrame([(int(i), float(a), float(b)) for i, (a, b) in enumerate(zip(blat, blon))] + [(999, 1.0, None)], "s long, blat double, blon double")
    want = _miles(lat, lon, blat, blon)
    odd = np.arange(len(blat)) % 2 == 1
    met = joins.nearest(points, "p", sites, "s", k, {"all": F.lit(True), "odd": F.col("s") % 2 == 1}).collect()
    got = {(r.filter, r.p, r["rank"]): (r.s, r.miles) for r in met}
    assert len(got) == len(met) == 2 * k * len(lat)
    for name, away in (("all", want), ("odd", np.where(odd[None, :], want, np.inf))):
        best = np.sort(away, axis=1)[:, :k]
        for p in range(len(lat)):
            for rank in range(k):
                s, miles = got[name, p, rank + 1]
                assert miles == pytest.approx(best[p, rank], abs=1e-6) and away[p, s] == pytest.approx(miles, abs=1e-6)


def test_nearest_few_and_no_sites(spark):
    points = spark.createDataFrame([(1, 10.0, 20.0)], "p long, lat double, lon double")
    sites = spark.createDataFrame([(7, -10.0, -160.0)], "s long, blat double, blon double")
    assert [(r.p, r.s, r["rank"]) for r in joins.nearest(points, "p", sites, "s", 3).collect()] == [(1, 7, 1)]
    assert joins.nearest(points, "p", sites.limit(0), "s").count() == 0
    same = sites.select(F.explode(F.sequence(F.lit(0).cast("long"), F.lit(499).cast("long"))).alias("s"), "blat", "blon")
    assert [r.s for r in joins.nearest(points, "p", same, "s", 2).orderBy("rank").collect()] == [0, 1]


# hierarchies
def test_subtree_sum_chain_and_star(spark):
    n = 100_000
    chain = spark.range(1, n).select(F.col("id").alias("child"), (F.col("id") - 1).alias("parent"))
    ones = spark.range(n).select(F.col("id").alias("k"), F.lit(1.0).alias("m"))
    out = graph.subtree_sum(chain, ones, "k", "m")
    assert out.filter(F.col("total") != n - F.col("node")).isEmpty() and out.filter(F.col("members") != n - F.col("node")).isEmpty() and out.count() == n
    star = spark.range(1, 1_000_000).select(F.col("id").alias("child"), F.lit(0).cast("long").alias("parent"))
    top = graph.subtree_sum(star, spark.range(1_000_000).select(F.col("id").alias("k"), F.lit(1.0).alias("m")), "k", "m").filter("node = 0").first()
    assert (top.total, top.members) == (1_000_000.0, 1_000_000)


def test_subtree_sum_of_random_forests_and_cycles(spark):
    rng = random.Random(2)
    for _ in range(3):
        edges = [(c, rng.randrange(60)) for c in range(60) if rng.random() < 0.9] + [(70, None), (None, 3)]
        values = [(rng.randrange(65), float(rng.randrange(100))) for _ in range(80)]
        parent = {c: p for c, p in edges if c is not None and p is not None and c != p}
        total, members = {}, {}
        for k, m in values:
            seen, at = [], k
            while at is not None and at not in seen:
                seen.append(at)
                at = parent.get(at)
            for node in seen:
                total[node] = total.get(node, 0) + m
                members[node] = members.get(node, 0) + 1
        got = graph.subtree_sum(spark.createDataFrame(edges, "child long, parent long"), spark.createDataFrame(values, "k long, m double"), "k", "m").collect()
        assert {r.node: (r.total, r.members) for r in got} == {k: (total[k], members[k]) for k in total}


# co-occurrence
def test_pairs_of_a_heavy_key(spark):
    own = spark.range(1200).select(F.lit("hot").alias("k"), F.col("id").alias("item")).union(spark.createDataFrame([("a", 1), ("a", 2), ("a", 2), ("b", 7), (None, 1), (None, 2), ("a", None)], "k string, item long"))
    out = joins.pairs(own, "k", "item", block=100)
    assert out.count() == out.distinct().count() == 1200 * 1199 // 2 + 1
    assert out.filter("item_a >= item_b").isEmpty() and [(r.item_a, r.item_b) for r in out.filter("k = 'a'").collect()] == [(1, 2)]


def test_a_heavy_basket_is_dealt_out(spark):
    """No group holds more than a few hundredths of a basket's pairs."""
    own = spark.range(20_000).select(F.lit(1).alias("k"), F.col("id").alias("item"))
    out = joins.pairs(own, "k", "item", block=1000)
    assert "_i" in out._jdf.queryExecution().optimizedPlan().toString() and out.filter("item_a % 1000 = 0 and item_b % 1000 = 1").count() == 20 * 21 // 2


# fuzzy names
def _levenshtein(a, b):
    row = list(range(len(b) + 1))
    for i, x in enumerate(a, 1):
        row, left = [i], row
        for j, y in enumerate(b, 1):
            row.append(min(row[-1] + 1, left[j] + 1, left[j - 1] + (x != y)))
    return row[-1]


def test_fuzzy_match_brute_force(spark):
    rng = random.Random(8)
    word = lambda: "".join(rng.choices("abc", k=rng.randint(1, 12)))
    base = [" ".join(["acme", *[word() for _ in range(rng.randint(0, 8))]]) for _ in range(60)]

    def dented(name):
        out = list(name)
        for _ in range(rng.randint(0, 4)):
            at = rng.randrange(5, len(out) + 1) if len(out) >= 5 else 0
            out[at : at + rng.randint(0, 1)] = rng.choices("abc ", k=rng.randint(0, 1))
        return "".join(out)

    a = [(i, dented(rng.choice(base))) for i in range(150)] + [(150, None), (151, "")]
    b = [(i, dented(rng.choice(base))) for i in range(150)] + [(150, None), (151, "")]
    want = {}
    for i, x in a:
        for j, y in b:
            if x is None or y is None or x.split(" ")[0] != y.split(" ")[0]:
                continue
            p, q = sorted(x.split(" ")), sorted(y.split(" "))
            s, t = " ".join(p), " ".join(q)
            if min(len(p), len(q)) / max(len(p), len(q)) < 0.66 or not max(len(s), len(t)):
                continue
            sim = round(100.0 * (1 - _levenshtein(s, t) / max(len(s), len(t))), 4)
            if sim >= 95 and (-sim, j) < want.get(i, (0, 0)):
                want[i] = (-sim, j)
    got = joins.fuzzy_match(spark.createDataFrame(a, "ak long, an string"), "ak", "an", spark.createDataFrame(b, "bk long, bn string"), "bk", "bn").collect()
    assert {r.a_key: (-r.similarity, r.b_key) for r in got} == want and len(got) == len(want) > 40


def test_fuzzy_match_of_one_big_block(spark):
    """100,000 names a side, one first token: each finds its partner, one letter away."""
    n = 100_000
    name = F.concat(F.lit("acme "), F.sha1(F.col("id").cast("string")))
    a = spark.range(n).select("id", name.alias("n"))
    b = spark.range(n).select("id", F.concat(F.substring(name, 1, 20), F.lit("z"), F.substring(name, 22, 100)).alias("n"))
    out = joins.fuzzy_match(a, "id", "n", b, "id", "n")
    assert out.filter("a_key = b_key").count() == out.count() == n


# overlap of token sets
@pytest.mark.parametrize("common", [3, 200])
def test_overlap_candidates_brute_force(spark, common):
    rng = random.Random(common)
    sets = lambda n: [(i, ["all"] * (rng.random() < 0.9) + rng.sample([f"t{j}" for j in range(40)], rng.randint(0, 5))) for i in range(n)]
    a, b = sets(60) + [(60, None)], sets(80) + [(80, None)]
    want = {}
    for i, x in a:
        met = []
        for j, y in b:
            shared = len(set(x or []) & set(y or []))
            if shared:
                met.append((-shared / min(len(x), len(y)), -shared, j))
        for rank, (score, shared, j) in enumerate(sorted(met)[:3], 1):
            want[i, rank] = (j, -shared, -score)
    got = joins.overlap_candidates(spark.createDataFrame(a, "i long, tokens array<string>"), "i", spark.createDataFrame(b, "j long, tokens array<string>"), "j", 3, common).collect()
    assert {(r.i, r["rank"]): (r.j, r.shared, r.score) for r in got} == want


def test_overlap_with_a_token_of_all_rows(spark):
    """4,000 x 4,000 rows that share one token and little else meet in some thousand pairs."""
    side = lambda name: spark.range(4000).select(F.col("id").alias(name), F.array(F.lit("all"), F.concat(F.lit("r"), F.col("id").cast("string"))).alias("tokens"))
    out = joins.overlap_candidates(side("i"), "i", side("j"), "j", 2).collect()
    assert len(out) == 8000 and all((r.i == r.j) == (r["rank"] == 1) for r in out)


# gates and corrections
def test_digest_tells_rows_apart(spark):
    of = lambda rows, kind="a string, b string": gates.digest(spark.createDataFrame(rows, kind)).first().digest
    assert of([("a|b", "c")]) != of([("a", "b|c")])
    assert of([("a", None)]) != of([("a", "\\N")]) != of([("a", "")])
    assert of([("1", "x")]) != of([(1, "x")], "a long, b string")
    assert of([(["a, b"],)], "a array<string>") != of([(["a", "b"],)], "a array<string>")
    rows = [(str(i % 7), str(i)) for i in range(500)]
    shuffled = spark.createDataFrame(rows[::-1], "a string, b string").repartition(7)
    assert of(rows) == gates.digest(shuffled).first().digest != of(rows[1:]) and of(rows + rows[:1]) != of(rows)
    assert gates.digest(spark.range(0)).first().n == 0


def test_corrections_to_null(spark):
    facts = spark.createDataFrame([(1, "a", 5), (2, "b", 6)], "k long, x string, y int")
    ledger = spark.createDataFrame([(1, "x", "new", 1), (1, "x", None, 2), (2, "y", "9", 1)], "k long, field string, value string, seq long")
    assert sorted((r.k, r.x, r.y) for r in scoring.apply_corrections(facts, "k", ledger, ["x", "y"]).collect()) == [(1, None, 5), (2, "b", 9)]


def test_outer_resolve_without_times(spark):
    a = spark.createDataFrame([(1, None, "a"), (2, 5, "a"), (3, None, "a"), (4, 4, "a")], "k long, ts long, v string")
    b = spark.createDataFrame([(1, None, "b"), (2, None, "b"), (3, 1, "b"), (4, 4, "b"), (5, None, "b")], "k long, ts long, v string")
    assert sorted((r.k, r.side) for r in joins.outer_resolve(a, b, "k", "ts").collect()) == [(1, "a"), (2, "a"), (3, "b"), (4, "a"), (5, "b")]


def test_profile_of_many_values(spark):
    df = spark.range(5000).select((F.col("id") % 1000).cast("string").alias("c"), F.when(F.col("id") % 10 == 0, "hot").alias("d"))
    got = {r.column: (r.n_distinct, r.top, r.nulls) for r in gates.profile(df, ["c", "d"]).collect()}
    assert got == {"c": (1000, "0:5,1:5,10:5", 0), "d": (1, "hot:500", 4500)}
    assert math.isclose(gates.profile(df, ["d"]).first().null_rate, 0.9)


# approximate search
def test_code_search_reads_few_vectors(spark, monkeypatch):
    """Recall of at least 0.9 while under a quarter of the vectors are compared whole, in blocks too."""
    from recordloom.operators import vectors

    emb = spark.read.parquet("/root/testdata/sf0.1/embeddings.parquet")
    rows = emb.collect()
    x = np.array([r.embedding for r in rows], float)
    x /= np.linalg.norm(x, axis=1, keepdims=True)
    keys = np.array([r.vec_id for r in rows])
    own = emb.filter("vec_id % 100 = 0").select(F.col("vec_id").alias("query"), "embedding")
    centres, books = vectors.cell_centres(emb, "embedding", 16), vectors.codebooks(emb, "embedding", 16)
    for block in (50_000, 60):
        monkeypatch.setattr(vectors, "CODE_BLOCK", block)
        monkeypatch.setattr(vectors, "QUERY_BLOCK", 2_000 if block > 60 else 7)
        near = vectors.pq_candidates(own, "query", vectors.pq_encode(emb, "vec_id", "embedding", centres, books), "vec_id", "embedding", centres, books, 14, 100)
        assert near.groupBy("query").count().agg(F.max("count")).first()[0] <= 0.25 * len(rows)
        found = vectors.pq_search(own, "query", emb, "vec_id", "embedding", centres, books, 14, 10, 100).collect()
        got = {(r["query"], r.vec_id) for r in found}
        want = {(int(q), int(v)) for q in keys[keys % 100 == 0] for v in keys[np.argsort(-(x @ x[keys == q][0]), kind="stable")[:10]]}
        assert len(got & want) >= 0.9 * len(want) and len(got) == len(want)


# huge documents
@pytest.mark.parametrize("size", [700, 5_000, 1 << 20])
def test_elements_of_huge_documents(spark, tmp_path, size):
    """Byte ranges of any size, begun anywhere: in strings, keys, elements; several documents; equal to a parser."""
    from recordloom.sources.readers import read_elements

    rng = random.Random(size)
    word = lambda: "".join(rng.choices(["{", "}", "[", "]", '"', "\\", "a", "é", " ", ",", "\n", "🎉"], k=rng.randint(0, 9)))
    want = []
    for d in range(3):
        elements = [{"id": d * 1000 + i, "note": word(), "sub": {"x": [word() for _ in range(rng.randint(0, 30))]}} for i in range(60)]
        want += [(e["id"], e["note"], e["sub"]["x"]) for e in elements]
        doc = {"head": {"list": [{"id": -1}], "t": word()}, "body": {"other": [[{"id": -2}]], "list": [*elements[:5], 7, None, [{"id": -3}], *elements[5:]]}, "list": [{"id": -4}]}
        (tmp_path / f"{d}.json").write_text(json.dumps(doc, ensure_ascii=d == 1, indent=2 if d == 2 else None))
    (tmp_path / "3.json").write_text('{"body": {"list": []}}')
    before = spark.conf.get("spark.sql.files.maxPartitionBytes")
    try:
        spark.conf.set("spark.sql.files.maxPartitionBytes", size)
        read = lambda **more: read_elements(spark, str(tmp_path), ["body", "list"], "id long, note string, sub struct<x:array<string>>", **more)
        assert sorted((r.id, r.note, r["sub"].x) for r in read().collect()) == sorted(want)
        some = spark.createDataFrame([(5,), (1007,), (-2,)], "k long")
        assert sorted(r.id for r in read(keys=some, key="id").collect()) == [5, 1007]
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", before)


def test_elements_of_a_bare_array(spark, tmp_path):
    from recordloom.sources.readers import read_elements

    (tmp_path / "a.json").write_text('[{"id": 1}, {"id": 2, "x": {"id": 3}}]\n')
    assert sorted(r.id for r in read_elements(spark, str(tmp_path), [], "id long").collect()) == [1, 2]


# learned vectors
def _topics(rng, shared=0):
    """Texts of 30 topics with 60 words each; a text has 12 words of one topic. Pairs of texts without a common word."""
    texts = []
    for i in range(600):
        words = rng.sample([f"t{i % 30}w{j}" for j in range(60)], 24)
        texts += [" ".join(words[:12]), " ".join(words[12 - shared : 24 - shared])]
    return texts


def _nearest(x):
    near = x @ x.T
    np.fill_diagonal(near, -2)
    return near.argmax(1)


def test_word_vectors_are_the_singular_vectors(spark):
    """The space of the learned vectors holds the leading right singular vectors of the whole matrix."""
    from recordloom.operators import vectors

    texts = _topics(random.Random(1))
    df = spark.createDataFrame([(i, t) for i, t in enumerate(texts)] + [(9999, None), (9998, "")], "i long, t string").repartition(5)
    weights, basis = vectors.word_vectors(df, "t", width=40, buckets=1 << 12, passes=4)
    row, bucket, weight = vectors._weighed(texts, weights)
    a = np.zeros((len(texts), 1 << 12))
    a[row, bucket] = weight
    top = np.linalg.svd(a, full_matrices=False)[2][:20]
    assert np.linalg.norm(top @ basis, axis=1).min() > 0.95
    held = {b: sum(b in set(bucket[row == i]) for i in range(len(texts))) for b in bucket[:20].tolist()}
    assert all(weights[b] == pytest.approx(math.log((len(texts) + 3) / n)) for b, n in held.items())


def test_learned_vectors_find_what_hashing_cannot(spark):
    """Near copies are each other's nearest; texts of one topic without a common word are near, and by hashing are not."""
    from recordloom.operators import vectors

    rng = random.Random(3)
    texts = _topics(rng)
    df = spark.createDataFrame(list(enumerate(texts)), "i long, t string")
    model = vectors.word_model(spark, *vectors.word_vectors(df, "t", buckets=1 << 12))
    learned, hashed = model(texts), vectors.hashed_words(texts)
    topic = np.arange(len(texts)) // 2 % 30
    apart = lambda x: np.mean([x[i] @ x[i + 1] > np.median(x[i] @ x.T) + 0.3 for i in range(0, len(texts), 2)])
    assert apart(learned) > 0.9 > apart(hashed) and np.mean(topic[_nearest(learned)] == topic) > 0.95
    long = [" ".join(rng.choices(texts[0].split() + [w for t in texts[:200] for w in t.split()], k=80)) for _ in range(200)]
    near = [" ".join(w if rng.random() > 0.05 else "zzz" for w in t.split()) for t in long]
    both = spark.createDataFrame(list(enumerate(long + near)), "i long, t string")
    model = vectors.word_model(spark, *vectors.word_vectors(both, "t"))
    assert np.mean(_nearest(model(long + near)) == (np.arange(400) + 200) % 400) >= 0.9
    assert model(["", "unheard-of"]).tolist()[0] == [0.0] * 64


def test_header_goes_by_place(spark, tmp_path):
    """Each file's first line goes, whatever it says; a data row that says the same stays."""
    from recordloom.sources.readers import read_ragged

    (tmp_path / "a.csv").write_text("id,name\n1,x\nid,name\n2\n")
    (tmp_path / "b.csv").write_text("ID,NAME\n3,y\n4,y,z\n")
    rows, rejects = read_ragged(spark, str(tmp_path), ["id", "name"], header=True)
    assert sorted((r.id, r.name) for r in rows.collect()) == [("1", "x"), ("2", None), ("3", "y"), ("id", "name")]
    assert [r.line for r in rejects.collect()] == ["4,y,z"]


def test_vector_match_against_brute_force(spark, monkeypatch):
    """Ties and copies by least key, incumbents out, null, zero and shorter vectors left out, in blocks of any size."""
    from recordloom.operators import vectors

    rng = np.random.default_rng(6)
    x = rng.normal(size=(300, 8)).round(1)
    x[100:180] = x[7]  # copies, more than any k
    x[200:230] = x[:30] * 2  # as near as their likes
    rows = [(i, v.tolist()) for i, v in enumerate(x)] + [(300, None), (301, [0.0] * 8), (302, [1.0] * 5), (303, [1.0] * 7 + [None])]
    b = spark.createDataFrame(rows, "j long, v array<float>")
    a = b.filter("j % 20 = 7 or j >= 300").withColumnRenamed("j", "i")
    incumbents = [(7, 7), (7, 101), (27, 27), (27, 5), (47, None)]
    y = x.astype(np.float32).astype(float)
    y /= np.linalg.norm(y, axis=1, keepdims=True)
    want = {}
    for i in range(7, 300, 20):
        met = sorted((round(1 - float(y[i] @ y[j]), 6) + 0.0, j) for j in range(300) if (i, j) not in incumbents)
        want |= {(i, rank): (j, pytest.approx(d, abs=1e-6)) for rank, (d, j) in enumerate(met[:5], 1) if d <= 0.8}
    for block, asked in ((5_000, 1_000), (40, 4)):
        monkeypatch.setattr(vectors, "BLOCK_ROWS", block)
        monkeypatch.setattr(vectors, "ASKED_ROWS", asked)
        out = vectors.vector_match(a, "i", b, "j", "v", 5, 0.8, spark.createDataFrame(incumbents, "i long, j long")).collect()
        assert {(r.i, r["rank"]): (r.j, r.distance) for r in out if r.i < 300} == want
        assert [(r.i, r.j) for r in out if r.i >= 300] == [(302, 302)]
    close = vectors._close(b, "j", b.withColumnRenamed("j", "k"), "k", "v", 5, 2.1, None)
    assert close.count() < 302 * 8 * 20  # of 302 x 302 pairs, and in eight blocks

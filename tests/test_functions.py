"""Golden batteries of the scalar keys, and small fixtures of operators."""

import hashlib
import math
import random
import re

import pytest
from pyspark.sql import functions as F

from recordloom.functions import geo
from recordloom.functions import keys as K
from recordloom.functions import values as V
from recordloom.operators import gates, graph, joins, text, vectors, windows
from recordloom.sources import writers
from recordloom.sources.scratch import folder


def one(spark, column):
    return spark.range(1).select(column.alias("x")).first().x


# Inputs and results that the keys must match.
@pytest.mark.parametrize(
    "raw,want",
    [
        ("Smith & Sons", "SMITH AND SONS"), ("A&B", "A AND B"), ("&", "AND"), ("BRAND - STORE", "BRAND STORE"), ("BRAND-STORE", "BRAND STORE"),
        ("AAA–BBB", "AAA BBB"), ("AAA—BBB", "AAA BBB"), ("Café Niño", "CAF NIO"), ("O'Brien \"Inc\"", "OBRIEN INC"), ("ACME,  INC.", "ACME INC"),
        ("  Multiple   Spaces  ", "MULTIPLE SPACES"), ("***", None), ("", None), (None, None),
    ],
)
def test_name_norm(spark, raw, want):
    assert one(spark, K.name_norm(F.lit(raw).cast("string"))) == want


@pytest.mark.parametrize("raw,want", [("ACME CO LLC", "ACME"), ("FOO LLC INC", "FOO"), ("WIDGETS LTD", "WIDGETS"), ("TACO COMPANY", "TACO COMPANY"), ("ACME CORPORATION", "ACME CORPORATION"), ("PLAIN NAME", "PLAIN NAME"), ("LLC", "LLC")])
def test_legal_name_base(spark, raw, want):
    assert one(spark, K.legal_name_base(F.lit(raw))) == want


def test_addr_hash(spark):
    parts = [F.lit(x) for x in ("123  Main St.", " Springfield ", "il", "62704-1234")]
    assert one(spark, K.addr_key(*parts)) == "123 MAIN ST.|SPRINGFIELD|IL|62704"
    assert one(spark, K.addr_hash(*parts)) == "952f5c0740c4b100123137ae5cde4893"


@pytest.mark.parametrize("raw,want", [("10001-4567", "10001"), ("01234-5678", "01234"), ("no-digits!", None)])
def test_zip5(spark, raw, want):
    assert one(spark, K.zip5(F.lit(raw))) == want


@pytest.mark.parametrize(
    "function,raw,want",
    [
        (K.bare_host, "https://bob:pw@WWW.Host.com:80/x?y", "host.com"), (K.registrable_domain, "http://https://shop.firm.co.uk/a", "firm.co.uk"),
        (K.registrable_domain, "10.0.0.1", None), (K.registrable_domain, "a.b.example.com", "example.com"),
        (K.phone_e164, "1 (212) 555-0100 ext 4", "+12125550100"), (K.phone_e164, "112-555-0100", None),
        (K.linkedin_slug, "HTTPS://WWW.LINKEDIN.COM/COMPANY/Acme-Co/", "acme-co"), (K.linkedin_slug, "linkedin.com/in/someone", None),
        (K.person_key, "Dr. José Ñuñez, Jr.", "dr jose nunez"), (K.place_key, "De Kalb County", "DEKALB"), (K.place_key, "Saint Louis City", "ST LOUIS"),
        (K.fold_key, "water tanks", "watertank"), (K.fold_key, "batteries", "battery"), (K.fold_key, "truck chassis", "truckchassis"), (K.fold_key, "gas", "gas"), (K.fold_key, "spectacles", "spectacle"),
    ],
)
def test_keys(spark, function, raw, want):
    assert one(spark, function(F.lit(raw))) == want


def test_money_and_dates(spark):
    assert float(one(spark, V.parse_money(F.lit("($1,234.50)")))) == -1234.5
    assert str(one(spark, V.parse_date(F.lit(" 02/03/2024 "), ["yyyy-MM-dd", "MM/dd/yyyy"]))) == "2024-02-03"
    assert one(spark, V.fiscal_year(F.to_date(F.lit("2023-10-01")))) == 2024


def test_polygon(spark):
    square = F.lit("POLYGON ((0 0, 2 0, 2 2, 0 2, 0 0))")
    assert one(spark, geo.polygon_distance(F.lit(1.0), F.lit(1.0), square)) == 0
    assert one(spark, geo.polygon_distance(F.lit(3.0), F.lit(1.0), square)) == pytest.approx(1.0)


def test_chunks_cover_and_reassemble(spark):
    raw = "word " * 1000 + "x" * 3000
    df = spark.createDataFrame([(1, raw), (2, ""), (3, None)], "doc_id long, text string")
    chunks = text.chunk(df, "doc_id", "text")
    back = text.reassemble(chunks, "doc_id").collect()
    assert [(r.doc_id, r.text) for r in back] == [(1, re.sub(r"\n{3,}", "\n\n", re.sub(r"[ \t]+", " ", raw.replace("\r\n", "\n").replace("\r", "\n"))).strip())]


def test_designation_contexts(spark):
    df = spark.createDataFrame([(1, "alpha " + "." * 300 + " not beta " + "." * 300 + " alpha beta gamma")], "k long, t string")
    got = text.designations(df, "k", "t", {"alpha": "alpha", "beta": "beta", "gamma": "gamma"}, r"\bnot\b").collect()
    assert sorted((r.stem, r.context) for r in got) == [("alpha", "binding"), ("alpha", "listed"), ("beta", "listed"), ("beta", "negated"), ("gamma", "listed")]


def test_cycle_safe_closure(spark):
    edges = spark.createDataFrame([(2, 1), (3, 2), (8, 9), (9, 8), (7, 8)], "child long, parent long")
    got = {r.node: (r.root, r.depth, r.in_cycle) for r in graph.closure(edges).collect()}
    assert got == {2: (1, 1, False), 3: (1, 2, False), 8: (8, None, True), 9: (8, None, True), 7: (8, None, False)}


def test_scd2_smooths_one_row(spark):
    df = spark.createDataFrame([(1, i, v) for i, v in enumerate("aabaacc")], "k long, i long, v string")
    got = windows.scd2(df, "k", ["i"], ["v"], "i").orderBy("version").collect()
    assert [(r.v, r.valid_from, r.valid_to, r.is_current) for r in got] == [("a", 0, 5, False), ("c", 5, None, True)]


def test_left_join_refuses_fan_out(spark):
    a = spark.createDataFrame([(1,)], "k long")
    with pytest.raises(ValueError):
        joins.left_join_1(a, a.union(a), ["k"])


def test_publish_keeps_latest_on_failure(spark):
    root, df = folder(spark), spark.range(3)
    writers.publish(df, root, 1, {"rows": lambda d: d.count() == 3})
    with pytest.raises(ValueError):
        writers.publish(df.limit(1), root, 2, {"rows": lambda d: d.count() == 3})
    assert writers.read_latest(spark, root).count() == 3
    empty = folder(spark)
    writers.create_empty(spark, empty, "a long")
    with pytest.raises(Exception):
        writers.create_empty(spark, empty, "a long")


def test_plan_and_schema_gates(spark):
    a, b = spark.range(5), spark.range(5).withColumnRenamed("id", "x")
    assert gates.gate_plan(a.join(b, a.id == b.x)) == []
    assert gates.gate_plan(a.crossJoin(b)) != []
    assert [r.same for r in gates.gate_schema(spark, a, b).orderBy("column").collect()] == [False, False]
    assert gates.catalog(spark, {"a": a}).count() == 1


def test_cells_reach_recall(spark, sf_dir):
    emb = spark.read.parquet(f"{sf_dir}/embeddings.parquet")
    targets = emb.filter("vec_id % 5 = 0").select(F.col("vec_id").alias("target"), "embedding")
    exact = vectors.vector_match(emb, "vec_id", targets, "target", "embedding", 1, 0.5)
    near = vectors.vector_match(emb, "vec_id", targets, "target", "embedding", 1, 0.5, centres=vectors.cell_centres(targets, "embedding", 4))
    assert near.join(exact, ["vec_id", "target"]).count() >= 0.9 * exact.count()


def test_overlap_candidates_of_all_parts(spark):
    """Many rows share few token sets; every row gets its candidates, without a pair for each two rows."""
    from recordloom.queries import QUERIES
    from recordloom.sources.scratch import folder as scratch

    words, kinds = ["red bolt", "blue bolt", "red gear", "old rod", "hot red"], ["LARGE", "SMALL"]
    parts = [(i, words[i * 7 % 5], kinds[i // 3 % 2]) for i in range(380, 460)]
    root = scratch(spark)
    spark.createDataFrame(parts, "p_partkey long, p_name string, p_type string").write.parquet(f"{root}/part.parquet")
    sets = {k: set(f"{n} {t.lower()}".split()) for k, n, t in parts}
    want = set()
    for a in (k for k in sets if k % 2 == 0):
        met = [(-len(sets[a] & sets[b]) / min(len(sets[a]), len(sets[b])), -len(sets[a] & sets[b]), b) for b in sets if b % 2 and sets[a] & sets[b]]
        want |= {(a, b, -n, round(-s, 6), i + 1) for i, (s, n, b) in enumerate(sorted(met)[:3])}
    got = QUERIES["j19_overlap_candidates"](spark, root)
    assert {tuple(r) for r in got.select("a_part", "b_part", "shared", "score", "rank").collect()} == want


def test_vector_match_is_exact_in_blocks(spark, sf_dir, monkeypatch):
    """Blocks of the broadcast side change nothing, whichever side has fewer rows."""
    emb = spark.read.parquet(f"{sf_dir}/embeddings.parquet")
    few = emb.filter("vec_id % 4 = 0").select(F.col("vec_id").alias("target"), "embedding")
    run = lambda: [sorted(map(tuple, vectors.vector_match(*own, "embedding", 3, 0.9).collect())) for own in ((emb, "vec_id", few, "target"), (few, "target", emb, "vec_id"))]
    whole = run()
    monkeypatch.setattr(vectors, "BLOCK_ROWS", 10)
    assert run() == whole and all(whole)


def test_probing_search_reaches_recall(spark):
    """Recall of the registered search, with its own cells and probes, against brute force."""
    from recordloom.queries import QUERIES

    for size in ("sf0.01", "sf0.1"):
        exact = QUERIES["v03_vector_match"](spark, f"/root/testdata/{size}").filter("rank <= 9").select("query", "vec_id")
        near = QUERIES["v04_ivf_search"](spark, f"/root/testdata/{size}").filter("query <> vec_id").select("query", "vec_id")
        recall = near.join(exact, ["query", "vec_id"]).count() / exact.count()
        print(size, recall)
        assert recall >= 0.9


def test_designations_against_loops(spark):
    from recordloom.operators.text import designations

    stems, no = {"clown": "clown", "scum": "scum", "pathetic": "pathetic"}, "not |no "
    texts = ["clown", "é not a clown here", "clown scum pathetic", None, "", "scum " + "x " * 80 + "clown and pathetic", "no " + "y" * 80 + " clown scum", "clownclown"]
    want = []
    for key, text in enumerate(texts):
        mids = [(m.start() + m.end()) // 2 for m in re.finditer(no, text or "")]
        hits = [(n, m.start(), m.end()) for n, p in stems.items() for m in re.finditer(p, text or "")]
        for n, a, b in hits:
            near = {x for x, c, d in hits if abs((c + d) // 2 - (a + b) // 2) <= 100}
            want.append((key, n, a, b, "negated" if any(abs(m - (a + b) // 2) <= 60 for m in mids) else "listed" if len(near) >= 3 else "binding"))
    df = spark.createDataFrame(list(enumerate(texts)), "k long, t string")
    got = [tuple(r) for r in designations(df, "k", "t", stems, no).collect()]
    assert sorted(got) == sorted(want) and {w[4] for w in want} == {"negated", "listed", "binding"}


def test_extract_drops_negated_and_quotes(spark):
    from recordloom.operators.text import extract

    text = "You must bring 12 forms. Not needed: 34 forms. Later 12 forms, no. 56 forms"
    rows = {r.value: r for r in extract(spark.createDataFrame([(1, text), (2, None)], "k long, t string"), "k", "t", {"count": r"\d+ forms"}, "Not |no", margin=15).collect()}
    assert set(rows) == {"12 forms", "56 forms"} and rows["12 forms"].n == 2 and rows["12 forms"].mandatory and not rows["56 forms"].mandatory
    assert text[rows["12 forms"].start : rows["12 forms"].end] == "12 forms" and rows["12 forms"].quote == text[:38]


def test_closure_any_depth_and_cycles(spark):
    from recordloom.operators.graph import ancestors, closure

    edges = [(i, i - 1) for i in range(2, 42)] + [(100, 101), (101, 102), (102, 100), (103, 102), (104, 103), (200, 200)]
    out = {r.node: r for r in closure(spark.createDataFrame(edges, "child long, parent long"), max_depth=10).collect()}
    assert all(out[i].root == 1 and out[i].depth == i - 1 and out[i].capped == (i > 11) and not out[i].in_cycle for i in range(2, 42))
    assert all(out[i].root == 100 and out[i].in_cycle == (i < 103) and out[i].depth is None for i in range(100, 105)) and 200 not in out
    up = {(r.node, r.ancestor): r.depth for r in ancestors(spark.createDataFrame(edges, "child long, parent long")).collect()}
    assert up[41, 1] == 40 and up[100, 100] == 3 and up[104, 100] == 3 and len([k for k in up if k[0] == 41]) == 40
    assert closure(spark.createDataFrame([], "child long, parent long")).count() == 0


def test_radius_everywhere(spark):
    from recordloom.operators.joins import within_radius

    r = random.Random(2)
    points = [(i, r.uniform(-89.9, 89.9), r.choice([r.uniform(-180, 180), r.uniform(179, 180), r.uniform(-180, -179)])) for i in range(400)] + [(400, None, 1.0), (401, 90.0, 0.0), (402, 89.99, 180.0)]
    a, b = spark.createDataFrame(points, "i long, lat double, lon double"), spark.createDataFrame(points, "j long, blat double, blon double")

    def miles(p, q):
        (_, la, lo), (_, lb, lp) = p, q
        h = math.sin(math.radians(lb - la) / 2) ** 2 + math.cos(math.radians(la)) * math.cos(math.radians(lb)) * math.sin(math.radians(lp - lo) / 2) ** 2
        return 2 * 3958.7613 * math.asin(min(1, math.sqrt(h)))

    for limit in (50, 400):
        want = {(p[0], q[0]) for p in points for q in points if None not in (*p, *q) and miles(p, q) <= limit}
        got = [(x.i, x.j) for x in within_radius(a, b, limit).collect()]
        assert set(got) == want and len(got) == len(want)


def test_upserts_keep_one_row_a_key(spark):
    from recordloom.sources import writers as W

    base = spark.createDataFrame([(1, "a", 1), (2, "b", 1)], "k long, v string, at int")
    delta = spark.createDataFrame([(2, "c", 2), (2, "d", 3), (3, "e", 2), (3, "f", 1)], "k long, v string, at int")
    for f in (W.upsert, W.insert_new):
        with pytest.raises(ValueError):
            f(base, delta, ["k"])
    assert sorted(tuple(r) for r in W.upsert(base, delta, ["k"], "at").collect()) == [(1, "a", 1), (2, "d", 3), (3, "e", 2)]
    assert sorted(tuple(r) for r in W.insert_new(base, delta, ["k"], "at").collect()) == [(1, "a", 1), (2, "b", 1), (3, "e", 2)]
    assert sorted(r.v for r in W.backfill(base, delta, ["k"], ["v"], only_null=False, order="at").collect()) == ["a", "d"]


def test_publish_restores(spark, tmp_path):
    from recordloom.sources import writers as W

    root = f"file://{tmp_path}/t"
    for version in (1, 2):
        W.publish(spark.range(version), root, version, {})
    with pytest.raises(ValueError):
        W.publish(spark.range(0), root, 3, {"rows": lambda d: not d.isEmpty()})
    assert W.read_latest(spark, root).count() == 2 and W.restore(spark, root, 1).count() == 1
    W.publish(spark.range(5), root, 3, {})  # the failed version once more
    assert W.read_latest(spark, root).count() == 5
    with pytest.raises(ValueError):
        W.restore(spark, root, 9)


def test_documents_and_nested_files(spark, tmp_path):
    from recordloom.sources import readers as R

    for name, text in (("a.txt", "hello"), ("b.txt", "\n")):
        (tmp_path / name).write_text(text)
    found = {r.path.rsplit("/", 1)[1]: (r.length, r.content_hash) for r in R.read_documents(spark, str(tmp_path)).collect()}
    assert found == {"a.txt": (5, hashlib.sha256(b"hello").hexdigest()), "b.txt": (1, hashlib.sha256(b"\n").hexdigest())}
    (tmp_path / "n").mkdir()
    (tmp_path / "n" / "doc.json").write_text('{"all": [\n {"id": 1, "rates": [{"r": 5}, {"r": 6}]},\n {"id": 2, "rates": [{"r": 7}]}]}')
    doc = R.read_nested(spark, str(tmp_path / "n"), "all array<struct<id:long,rates:array<struct<r:long>>>>")
    flat = R.explode_nested(doc, ("all", "item"), ("item.rates", "rate"), keys=spark.createDataFrame([(1,)], "k long"), key="item.id")
    assert sorted(r.r for r in flat.select("rate.r").collect()) == [5, 6]


def test_parameters_are_one_row(spark):
    from recordloom.operators.joins import with_params

    assert with_params(spark.range(3), spark.range(1).toDF("p")).count() == 3
    for n in (0, 2):
        with pytest.raises(ValueError):
            with_params(spark.range(3), spark.range(n).toDF("p"))


def test_text_partner_ties_and_null_spine(spark):
    from recordloom.operators.aggregates import top_share
    from recordloom.plans.profiles import facility_360

    rows = spark.createDataFrame([(1, "b", 5.0), (1, "a", 5.0), (2, "z", 1.0)], "k long, p string, v double")
    assert {(r.k, r.top_partner, r.top_share) for r in top_share(rows, "k", "p", "v").collect()} == {(1, "a", 0.5), (2, "z", 1.0)}
    spine = spark.createDataFrame([(1, None), (9, 3.0)], "k long, beds double")
    out = {r.k: (r.beds, r.n_x, r.n_programs) for r in facility_360(spine, "k", {"x": rows.select("k")}).collect()}
    assert out == {1: (None, 2, 1), 9: (3.0, 0, 0)}


def test_polygons_with_holes_and_parts(spark):
    from recordloom.operators.joins import near_polygon

    wkt = "MULTIPOLYGON (((0 0, 4 0, 4 4, 0 4, 0 0), (1 1, 1 3, 3 3, 3 1, 1 1)), ((10 0, 12 0, 12 2, 10 2, 10 0)))"
    at = lambda x, y: one(spark, geo.polygon_distance(F.lit(x), F.lit(y), F.lit(wkt)))
    assert at(0.5, 0.5) == 0 and at(11.0, 1.0) == 0 and at(2.0, 2.0) == pytest.approx(1.0) and at(9.0, 1.0) == pytest.approx(1.0)
    c = one(spark, geo.wkt_centroid(F.lit(wkt)))  # areas 12 and 4
    assert (c.lon, c.lat) == pytest.approx(((2 * 12 + 11 * 4) / 16, (2 * 12 + 1 * 4) / 16))
    points = spark.createDataFrame([(1, 0.5, 0.5), (2, 2.0, 2.0), (3, 1.0, 9.2), (4, None, 1.0)], "i int, lat double, lon double")
    got = near_polygon(points, spark.createDataFrame([("p", wkt), ("q", None)], "name string, wkt string"), "wkt", 0.9)
    assert {(r.i, r.name, round(r.degrees, 6)) for r in got.collect()} == {(1, "p", 0.0), (3, "p", 0.8)}


def test_jdbc_partitions_by_predicate(spark):
    """A relational table, in Spark's own Derby, read by one partition a predicate."""
    from recordloom.sources.readers import read_jdbc

    url = "jdbc:derby:memory:recordloom;create=true"
    spark.range(20).selectExpr("id", "concat('n', id) as name").write.jdbc(url, "ITEMS", mode="overwrite", properties={"driver": "org.apache.derby.iapi.jdbc.AutoloadedDriver"})
    back = read_jdbc(spark, url, "ITEMS", ['"id" < 5', '"id" >= 15'], {"driver": "org.apache.derby.iapi.jdbc.AutoloadedDriver"})
    assert back.rdd.getNumPartitions() == 2 and sorted(r.id for r in back.collect()) == [*range(5), *range(15, 20)]


def test_gates_over_schemas_and_plans(spark):
    a, b = spark.range(3), spark.range(3).selectExpr("cast(id as int) as id", "1 as more")
    assert {(r.column, r.same) for r in gates.gate_schema(spark, a, b).collect()} == {("id", False), ("more", False)}
    assert gates.gate_plan(a.crossJoin(b.select("more"))) and not gates.gate_plan(a.join(a, "id"))


def test_list_members_are_trimmed(spark):
    assert one(spark, V.parse_list(F.lit(" 0a0 ;1b1;; c "), ";")) == ["0a0", "1b1", "c"]

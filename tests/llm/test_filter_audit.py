"""The filter audit against loops over every order, and its row-level steps."""

import random
import re
from collections import Counter
from itertools import permutations

import pytest
from pyspark.sql import functions as F

from recordloom.llm import filter_audit


def fails(text):
    words = re.findall(r"[^\x20\x09-\x0D]+", text)
    return {
        "A": len(words) < 200, "B": 100 * len(set(words)) < 50 * len(words),
        "C": 100 * len(re.findall("[A-Z]", text)) > 2 * len(text), "D": bool(re.search(r"[#$%&*|]", text)),
    }


def expected(docs, labels):
    """(part, order, step) -> counts, row by row."""
    good, toxic = ({d for d, *x in labels if x[i] == 1} for i in (0, 1))
    rows = []
    for d, text, source in docs:
        own = {k for k, bad in fails(text or "").items() if bad}
        if d is not None and any(e is not None and e < d and (t or "") == (text or "") for e, t, _ in docs):
            own.add("E")
        rows.append((source or "", own, d is not None and d in good, d is not None and d in toxic))
    out, shapley = {}, Counter()
    for order in map("".join, permutations("ABCDE")):
        for i, k in enumerate(order):
            for part in {r[0] for r in rows}:
                own = [r for r in rows if r[0] == part]
                alive = [r for r in own if not r[1] & set(order[:i])]
                gone = [r for r in alive if k in r[1]]
                shapley[part, k] += len(gone)
                failing = [r for r in own if k in r[1]]
                out[part, order, i + 1] = [len(alive) - len(gone), len(gone), len(failing) - len(gone), sum(r[1] == {k} for r in own), sum(r[2] for r in gone), sum(r[3] for r in gone)]
    return {k: (*v, shapley[k[0], k[1][k[2] - 1]]) for k, v in out.items()}


def table(spark, docs):
    df = spark.createDataFrame(docs, "doc_id long, text string, source string")
    return df.withColumns({"row": F.lit(1), "part": F.lit("x"), "held": F.lit(2), "digest": F.lit("y"), "good": F.lit(True), "n": F.lit(0)})


def documents():
    rng = random.Random(5)
    word = lambda: rng.choice(["alpha", "Beta", "GAMMA", "é", "x#", "日", "zeta", "\x85"])
    texts = [None, "", " \n", "\x1c", "same text", "same text"] + [" ".join(word() if rng.random() < 0.3 else f"w{rng.randrange(400)}" for _ in range(rng.choice([5, 199, 200, 230]))) for _ in range(60)]
    docs = [(rng.choice([i, i, None, 7]), rng.choice(texts), rng.choice(["a", "b", "", None])) for i in range(200)]
    labels = [(rng.choice([None, *range(200)]), rng.choice([0, 1, None]), rng.choice([0, 1, None])) for _ in range(150)]
    return docs, labels


@pytest.mark.parametrize("hot", [1000, 3])
def test_audit_by_loops(spark, monkeypatch, hot):
    """Nulls, empty texts, repeated ids, several labels of one id; copied texts on either side of the broadcast."""
    monkeypatch.setattr(filter_audit, "HOT", hot)
    docs, labels = documents()
    got = filter_audit.query(table(spark, docs), spark.createDataFrame(labels, "doc_id long, quality int, toxic int")).collect()
    names = ["kept", "removed", "redundant", "unique_fails", "good_lost", "toxic_lost", "shapley"]
    assert {(r.part, r.filter_order, r.step): tuple(r[n] for n in names) for r in got} == expected(docs, labels)
    assert len(got) == 3 * 600


def test_steps_hold_the_rows_that_are_counted(spark):
    docs, labels = documents()
    df, text = table(spark, docs), F.coalesce("text", F.lit(""))
    by_text = filter_audit.rules(text)
    known = filter_audit.facts(df, by_text, text, F.coalesce("source", F.lit("")))
    tables = filter_audit.relations(known, spark.createDataFrame(labels, "doc_id long, quality int, toxic int"), list(by_text))
    want = expected(docs, labels)
    for order in ("ABCDE", "EDCBA", "CEABD"):
        for i, k in enumerate(order):
            found = filter_audit.step(known.select("row", "part"), tables, order[:i], k)
            for j, name in enumerate(("kept", "removed", "redundant")):
                assert {r.part: r["count"] for r in found[name].groupBy("part").count().collect()} == {p: n[j] for (p, o, s), n in want.items() if (o, s) == (order, i + 1) and n[j]}


def test_empty_tables(spark):
    labels = spark.createDataFrame([], "doc_id long, quality int, toxic int")
    assert filter_audit.query(table(spark, documents()[0]).limit(0), labels).count() == 0
    assert filter_audit.query(table(spark, [(1, "x", "s")]), labels).filter("good_lost + toxic_lost > 0").count() == 0


def test_long_text(spark):
    text = "lorem ipsum dolor " * 300_000
    (r,) = filter_audit.query(table(spark, [(1, text, "s")]), spark.createDataFrame([(1, 1, 0)], "doc_id long, quality int, toxic int")).filter("filter_order = 'ABCDE' and step = 2").collect()
    assert (r.removed, r.good_lost, r.kept, r.unique_fails, r.shapley) == (1, 1, 0, 1, 120)

"""Every registered query of the library that SQL can express, against DuckDB."""

import pytest
from pyspark.sql import functions as F

from recordloom.queries import QUERIES, SQL

from .compare import rows_of, sql_rows


@pytest.mark.parametrize("name", sorted(SQL))
def test_matches_sql(spark, sf_dir, name):
    assert rows_of(QUERIES[name](spark, sf_dir)) == sql_rows(sf_dir, SQL[name])


@pytest.mark.parametrize("name", sorted(set(QUERIES) - set(SQL)))
def test_runs(spark, sf_dir, name):
    assert QUERIES[name](spark, sf_dir).count() > 0


def test_approximate_distinct_is_near(spark, sf_dir):
    """Within three relative standard deviations of the exact counts."""
    exact = dict(spark.read.parquet(f"{sf_dir}/events.parquet").groupBy("event_type").agg(F.count_distinct("user_id")).collect())
    got = {r.event_type: r.users for r in QUERIES["g04_approx_distinct"](spark, sf_dir).collect()}
    assert got.keys() == exact.keys() and all(abs(got[k] - n) <= max(0.15 * n, 1) for k, n in exact.items())


def test_embeds_only_what_lacks_a_vector(spark, sf_dir):
    """The odd documents alone, of length one, and equal texts alike; even ones have a vector and stay out."""
    texts = {r.doc_id: r.text for r in spark.read.parquet(f"{sf_dir}/documents.parquet").collect() if r.doc_id % 2}
    got = {r.doc_id: r.vector for r in QUERIES["v05_embed"](spark, sf_dir).collect()}
    assert got.keys() == texts.keys()
    first = {}
    for key, text in texts.items():
        assert len(got[key]) == 64 and sum(x * x for x in got[key]) == pytest.approx(1 if text.split() else 0, abs=1e-4)
        assert got[key] == pytest.approx(got[first.setdefault(text, key)], abs=1e-6)


def test_cells_are_the_nearest_centres(spark, sf_dir):
    """Each vector's cell has the nearest centre, by plain loops."""
    import numpy as np

    from recordloom.operators import vectors as V

    table = spark.read.parquet(f"{sf_dir}/embeddings.parquet")
    centres = V.cell_centres(table, "embedding", 16)
    got = {r.vec_id: r.cell for r in QUERIES["v04_ivf_assign"](spark, sf_dir).collect()}
    for r in table.collect():
        v = np.array(r.embedding, float)
        away = [float(np.linalg.norm(v - c)) for c in centres]
        assert away[got[r.vec_id]] - min(away) < 1e-6

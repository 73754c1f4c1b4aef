import numpy as np
import pytest
from pyspark.sql import functions as F

from pairsmith.operators import negatives, neighbours, ordering


def brute_force(queries, docs, k):
    """{query id: [(doc id, rounded score)]}, one query at a time."""
    found = {}
    for q, v in queries:
        scored = sorted((-round(float(np.dot(v, w)), 6), d) for d, w in docs)
        found[q] = [(d, -s) for s, d in scored[:k]]
    return found


def frame(spark, rows, name):
    return spark.createDataFrame([(int(i), [float(x) for x in v]) for i, v in rows], f"{name} long, vector array<float>")


def as_float32(rows):
    return [(i, np.asarray(v, dtype=np.float32).astype(float)) for i, v in rows]


def found_by(matched):
    result = {}
    for r in neighbours.exploded(matched).collect():
        result.setdefault(r.q, {})[r["rank"]] = (r.d, r.sim)
    return {q: [hits[i] for i in sorted(hits)] for q, hits in result.items()}


def clustered(n, dim, seed, copies=0, unit=True):
    """Points around a few centres; the first ``copies`` rows are one and the same vector."""
    rng = np.random.default_rng(seed)
    centres = rng.normal(size=(6, dim))
    points = centres[rng.integers(0, 6, n)] + 0.3 * rng.normal(size=(n, dim))
    if copies:
        points[:copies] = points[0]
    if unit:
        points /= np.linalg.norm(points, axis=1)[:, None]
    return as_float32(list(enumerate(points)))


@pytest.fixture
def small_tiles(monkeypatch):
    monkeypatch.setattr(neighbours, "TILE_ROWS", 40)
    monkeypatch.setattr(ordering, "HOT_MINIMUM", 20)


@pytest.mark.parametrize("unit", [True, False])
@pytest.mark.parametrize("pivots,fan", [(None, 2048), (9, 2048), (60, 8), (25, 2)])
def test_pruned_join_is_exact(spark, small_tiles, monkeypatch, unit, pivots, fan):
    """On one level and on two."""
    monkeypatch.setattr(neighbours, "FAN", fan)
    docs = clustered(600, 8, 1, copies=200, unit=unit)
    queries = [(i + 5000, v) for i, v in clustered(300, 8, 2, copies=100, unit=unit)] + [(9999, docs[0][1]), (9998, np.zeros(8))]
    got = found_by(neighbours.top_k(frame(spark, queries, "q"), frame(spark, docs, "d"), 7, pivots=pivots))
    assert got == brute_force(queries, docs, 7)


def test_tiles_without_pruning(spark, monkeypatch):
    monkeypatch.setattr(neighbours, "TILE_ROWS", 50)
    docs = clustered(400, 16, 3, copies=130)
    queries = clustered(200, 16, 4)
    got = found_by(neighbours.top_k(frame(spark, queries, "q"), frame(spark, docs, "d"), 10))
    assert got == brute_force(queries, docs, 10)


def test_groups_are_pruned(spark, small_tiles, monkeypatch):
    """Well separated groups meet only themselves in the second round."""
    visits = counted_visits(monkeypatch)
    rng = np.random.default_rng(5)
    centres = np.eye(12)[:10] * 1.0
    points = np.repeat(centres, 60, axis=0) + 0.02 * rng.normal(size=(600, 12))
    docs = as_float32(list(enumerate(points / np.linalg.norm(points, axis=1)[:, None])))
    got = found_by(neighbours.top_k(frame(spark, docs, "q"), frame(spark, docs, "d"), 5, pivots=30))
    assert got == brute_force(docs, docs, 5)
    assert sum(visits) < 600 * 12  # of 600 * 30 without pruning


def counted_visits(monkeypatch, rows=None):
    """Visits of each round, and in ``rows`` the pairs of vectors that they stand for."""
    visits, original = [], neighbours._sizes

    def counting(found, cells):
        per_cell = found.select(F.explode("cells").alias("cell")).groupBy("cell").count().withColumnRenamed("count", "n")
        joined = per_cell.join(cells, "cell").agg(F.sum("n").alias("n"), F.sum(F.col("n") * F.col("count")).alias("pairs")).first()
        visits.append(joined["n"] or 0)
        if rows is not None:
            rows.append(joined["pairs"] or 0)
        return original(found, cells)

    monkeypatch.setattr(neighbours, "_sizes", counting)
    return visits


def test_work_grows_with_the_rows_on_two_levels(spark, monkeypatch):
    """Clusters of a fixed size: four times the rows meet about four times the pairs."""
    monkeypatch.setattr(neighbours, "TILE_ROWS", 64)
    monkeypatch.setattr(neighbours, "FAN", 4)
    work = {}
    for clusters in (20, 80):
        rng = np.random.default_rng(clusters)
        points = np.repeat(rng.normal(size=(clusters, 24)), 24, axis=0)
        points += 0.05 * rng.normal(size=points.shape)
        docs = as_float32(list(enumerate(points / np.linalg.norm(points, axis=1)[:, None])))
        pairs = []
        with monkeypatch.context() as patch:
            counted_visits(patch, pairs)
            got = found_by(neighbours.top_k(frame(spark, docs, "q"), frame(spark, docs, "d"), 5, pivots=len(docs) // 6))
        assert got == brute_force(docs, docs, 5)
        work[clusters] = sum(pairs)
    assert work[80] < 6 * work[20] and work[80] < 0.1 * (80 * 24) ** 2, work


def test_k_above_the_corpus(spark):
    docs = clustered(6, 4, 7, copies=3)
    queries = clustered(4, 4, 8)
    got = found_by(neighbours.top_k(frame(spark, queries, "q"), frame(spark, docs, "d"), 50))
    assert got == brute_force(queries, docs, 50)


def test_unusable_vectors_are_set_apart(spark):
    docs, queries = clustered(120, 4, 7), clustered(90, 4, 8)
    bad = [None, [], [1.0, None, 0.0, 0.0], [float("nan")] * 4, [float("inf"), 0.0, 0.0, 0.0]]
    kind = "array<float>"
    more = lambda name: spark.createDataFrame([(9000 + i, v) for i, v in enumerate(bad)], f"{name} long, vector {kind}")
    matched = neighbours.top_k(frame(spark, queries, "q").unionByName(more("q")), frame(spark, docs, "d").unionByName(more("d")), 100, pivots=6)
    assert matched.where("q >= 9000 and size(neighbours) = 0").count() == len(bad)
    assert found_by(matched.where("q < 9000")) == brute_force(queries, docs, 100)


def test_vectors_of_different_lengths_are_refused(spark):
    rows = spark.createDataFrame([(1, [1.0] * 3), (2, [1.0] * 5), (3, [1.0] * 4)], "q long, vector array<float>")
    with pytest.raises(Exception, match="length|shape|inhomogeneous"):
        neighbours.top_k(rows, rows.withColumnRenamed("q", "d"), 2).collect()


def test_one_row_out_per_row_in(spark):
    df = spark.createDataFrame([(i, f"q{i}", f"p{i}", "old") for i in range(5)], "id long, query string, positive string, negative string")
    vectors = spark.createDataFrame([(i, [1.0, float(i)], [1.0, float(i)]) for i in range(2)], "id long, query_vector array<float>, positive_vector array<float>")
    got = {r.id: (r.negative, r.negative_branch) for r in negatives.pick_negatives(df, vectors, negatives.HardNegativeConfig(top_k=2)).collect()}
    assert got == {0: ("p1", "neighbour"), 1: ("p0", "neighbour"), 2: ("p3", "next_row"), 3: ("p4", "next_row"), 4: ("p0", "next_row")}
    with pytest.raises(ValueError):
        negatives.pick_negatives(df.union(df.limit(1)), vectors, negatives.HardNegativeConfig(top_k=2))


def test_tile_selection_with_and_without_ties():
    rng = np.random.default_rng(9)
    ids = rng.permutation(4000)[:2000]
    for products in (rng.normal(size=(5, 2000)), np.zeros((5, 2000)), np.round(rng.normal(size=(5, 2000)), 1)):
        for floor in (-np.inf, 2.0):
            rows, columns, scores = neighbours._tile_top(products, ids, 10, np.full(5, floor))
            for row in range(5):
                mine = sorted((-s, ids[c]) for c, s in zip(columns[rows == row], scores[rows == row]))
                best = sorted((-round(p, 6), i) for p, i in zip(products[row], ids))[:10]
                assert [m for m in mine if m[0] <= -floor] == [x for x in best if x[0] <= -floor]


def negatives_of(spark, rows, k, **options):
    df = spark.createDataFrame([(i, f"q{i}", p, "old") for i, (p, _) in enumerate(rows)],
                               "id long, query string, positive string, negative string")
    vectors = spark.createDataFrame([(i, [float(x) for x in v], [float(x) for x in v]) for i, (_, v) in enumerate(rows)],
                                    "id long, query_vector array<float>, positive_vector array<float>")
    out = negatives.pick_negatives(df, vectors, negatives.HardNegativeConfig(top_k=k, **options))
    assert out.columns == ["id", "query", "positive", "negative", "negative_branch"]
    return {r.id: (r.negative, r.negative_branch) for r in out.collect()}


A, B, C = (1, 0), (0.8, 0.6), (0, 1)


def test_hard_negative_branches(spark):
    assert negatives_of(spark, [("A", A), ("B", B), ("C", C)], 2)[0] == ("B", "neighbour")
    assert negatives_of(spark, [("A", A), ("A", B), ("C", C)], 2)[0] == ("A", "own_positive")
    assert negatives_of(spark, [("A", A), ("A", B), ("C", C)], 2, avoid_own_positive=True)[0] == ("C", "next_row")
    assert negatives_of(spark, [("A", A), (" \t", B), ("C", C)], 2)[0] == ("C", "next_row")
    assert negatives_of(spark, [("A", A), ("B", B), ("C", C)], 1)[2] == ("A", "next_row")
    assert set(negatives_of(spark, [("A", A), ("A", B), ("A", C)], 1).values()) == {(None, "unresolved")}


def test_choice_is_uniform_and_seeded(spark):
    rng = np.random.default_rng(1)
    rows = [(f"p{i}", (1, 0)) for i in range(400)]
    rng.shuffle(rows)
    one = negatives_of(spark, rows, 6, seed=1)
    assert one == negatives_of(spark, rows, 6, seed=1) and one != negatives_of(spark, rows, 6, seed=2)
    nearest = [rows[i][0] for i in range(6)]
    counts = [sum(n == p for n, _ in one.values()) for p in nearest]
    assert sum(counts) == 400 and min(counts) > 30


def test_popular_pick_is_joined_whole(spark, monkeypatch):
    monkeypatch.setattr(ordering, "HOT_MINIMUM", 20)
    monkeypatch.setattr(ordering, "HOT_SHARE", 10)
    rows = [("A", A)] * 150 + [("B", B)] + [("A", A)] * 50
    got = negatives_of(spark, rows, 250)
    assert len(got) == 201 and {got[i] for i in range(201) if i != 150} == {("B", "neighbour")} and got[150][0] == "A"


@pytest.mark.parametrize("seed", range(3))
def test_next_other_row(spark, seed):
    rng = np.random.default_rng(seed)
    n = 300
    keys = ["ABC"[rng.integers(3)] if rng.random() < 0.1 else " " if rng.random() < 0.3 else "A" if i < 200 else "B" for i in range(n)]
    rows = [(i * 3, k, k == " ", bool(rng.random() < 0.5)) for i, k in enumerate(keys)]
    df = spark.createDataFrame(rows, "id long, key string, blank boolean, open boolean").repartition(5)
    got = {r.id: r.pick for r in negatives.next_other(df).collect()}
    expected = {}
    for i, (row_id, key, _, is_open) in enumerate(rows):
        if is_open:
            following = [rows[(i + s) % n] for s in range(1, n)]
            expected[row_id] = next((r[0] for r in following if not r[2] and r[1] != key), None)
    assert got == expected


def test_dense_index(spark):
    df = spark.createDataFrame([(int(x),) for x in np.random.default_rng(0).permutation(500)], "x int").repartition(9)
    numbered, total = ordering.dense_index(df, [F.col("x").desc()])
    assert total == 500 and {(r.x, r.idx) for r in numbered.collect()} == {(x, 499 - x) for x in range(500)}
    empty, total = ordering.dense_index(df.where("false"), [F.col("x")])
    assert total == 0 and empty.count() == 0


def test_equal_rows_do_not_share_a_range(spark):
    df = spark.createDataFrame([("same",)] * 900 + [("zzz",)] * 100, "x string").repartition(6)
    numbered, total = ordering.dense_index(df, [F.col("x")])
    rows = numbered.withColumn("p", F.spark_partition_id()).collect()
    assert total == 1000 and sorted(r.idx for r in rows) == list(range(1000))
    assert all((r.x == "same") == (r.idx < 900) for r in rows)


def test_row_ids_follow_the_files(spark, tmp_path):
    folder = tmp_path / "rows"
    folder.mkdir()
    lines = [f"line {i % 7}" for i in range(3000)]
    (folder / "a.txt").write_text("\n".join(lines[:10]) + "\n")
    (folder / "b.txt").write_text("\n".join(lines[10:]) + "\n")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "4096")
    try:
        got = ordering.with_row_id(spark.read.text(str(folder)))
        assert [r.value for r in got.orderBy("id").collect()] == lines
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")


@pytest.mark.parametrize("pivots,fan", [(None, 2048), (12, 2048), (60, 8)])
def test_a_query_is_moved_once_a_slab(spark, monkeypatch, pivots, fan):
    """Not once for each group that it visits; and slabs of any number give the exact result."""
    monkeypatch.setattr(neighbours, "TILE_ROWS", 20)
    monkeypatch.setattr(neighbours, "FAN", fan)
    monkeypatch.setattr(neighbours, "SIDES", 3)
    rng = np.random.default_rng(11)
    docs, queries = (as_float32(list(enumerate(rng.normal(size=(n, 8))))) for n in (500, 150))
    moved, original = [], neighbours._sizes

    def counting(visits, cells):
        moved.append(visits.agg(F.sum(F.size("cells")), F.sum(F.size("parts"))).first())
        return original(visits, cells)

    monkeypatch.setattr(neighbours, "_sizes", counting)
    for tiles in (1, 8):
        monkeypatch.setattr(neighbours, "SLAB_TILES", tiles)
        assert found_by(neighbours.top_k(frame(spark, queries, "q"), frame(spark, docs, "d"), 5, pivots=pivots)) == brute_force(queries, docs, 5)
    if pivots == 12:
        cells, slabs = moved[-1]
        assert cells > 150 * 5 and slabs <= 150 * 7  # two blocks in a row hold more than 160 of the 500 rows, so there are 7 at most


def test_equal_vectors_meet_once(spark, monkeypatch):
    """Copies ride along with the one row of their vector that the slabs hold, and come out in the order of their ids."""
    held, original = [], neighbours.slab_join

    def counting(visits, corpus, *rest):
        held.append(corpus.count())
        return original(visits, corpus, *rest)

    monkeypatch.setattr(neighbours, "slab_join", counting)
    monkeypatch.setattr(neighbours, "TILE_ROWS", 40)
    docs = [(1000 - i, v) for i, v in clustered(500, 6, 13, copies=300)]
    docs += [(2000 + i, v) for i, v in docs[-150:]]
    queries = clustered(60, 6, 14)
    for pivots in (None, 9):
        assert found_by(neighbours.top_k(frame(spark, queries, "q"), frame(spark, docs, "d"), 7, pivots=pivots)) == brute_force(queries, docs, 7)
    assert held and set(held) == {201}


def test_screened_products_miss_nothing(monkeypatch):
    """Whatever the lengths of the vectors, with many scores closer to each other than 32-bit floats can tell."""
    monkeypatch.setattr(neighbours, "PART_ROWS", 7)
    rng = np.random.default_rng(15)
    base = rng.normal(size=(1, 20))
    for spread, lengths in ((1.0, 1.0), (1e-6, 1.0), (1.0, 10.0 ** rng.uniform(-6, 6, (900, 1))), (0.0, 1.0)):
        docs = ((base + spread * rng.normal(size=(900, 20))) * lengths).astype(np.float32)
        own = np.concatenate([base + spread * rng.normal(size=(30, 20)), np.zeros((1, 20))]).astype(np.float32).astype(float)
        ids, every = rng.permutation(900), np.arange(31)
        screen, best, floor = neighbours._Screen(docs), neighbours._BestOfTile(31, 5, ids), np.full(31, -np.inf)
        for start in range(0, 900, 400):
            best.add(*[x + y for x, y in zip(screen.top(screen.queries(own), every, start, min(start + 400, 900), ids, 5, floor), (0, start, 0.0))], floor, 20)
        row, column, score = best.found(floor)
        products = own @ docs.astype(float).T
        for i in every:
            expected = sorted((-np.rint(p * 1e6) / 1e6, d) for p, d in zip(products[i], ids))[:5]
            got = sorted((-s, ids[c]) for c, s in zip(column[row == i], score[row == i]))
            assert len(got) == 5 and np.allclose([s for s, _ in got], [s for s, _ in expected], rtol=1e-12, atol=2e-6)
            if np.isscalar(lengths):  # else a last digit of a large product may depend on the order of its sum
                assert [d for _, d in got] == [d for _, d in expected]

"""Groups larger than the window of the orders."""

import random

import numpy as np
import pytest

from dqspark.llm import components, forest
from tests.llm import brute


def _edited(rng, words, k):
    out = list(words)
    for at in rng.sample(range(len(words)), k):
        out[at] = f"e{rng.randrange(10 ** 9)}"
    return " ".join(out)


def test_copies_linked_only_through_their_base(spark):
    """Far more copies of one base than a window holds, no two of them similar enough."""
    rng = random.Random(2)
    base = [f"w{i}" for i in range(400)]
    rows = [(5000, " ".join(base))] + [(i, _edited(rng, base, 20)) for i in range(1200)]
    got = forest.near_duplicates(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    assert {r["component_id"] for r in got} == {0} and sum(r["kept"] for r in got) == 1


def test_pairs_among_many_of_one_template(spark):
    """Pairs are found among documents that share a template without being linked by it."""
    rng = random.Random(3)
    template = [f"w{i}" for i in range(300)]
    rows = []
    for i in range(500):
        words = template + [f"p{i}x{k}" for k in range(55)]
        rows += [(2 * i, " ".join(words)), (2 * i + 1, _edited(rng, words, 14))]
    got = forest.near_duplicates(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    expected = brute.near_groups(rows)
    assert len({c for _, c in expected.values()}) == 500
    assert {r["doc_id"]: (r["n_shingles"], r["component_id"]) for r in got} == expected


def test_one_id_with_two_texts(spark):
    """A near copy of either text of an id is linked with it."""
    rng = random.Random(4)
    one, two = ([f"{c}{i}" for i in range(200)] for c in "az")
    rows = [(1, " ".join(one)), (1, " ".join(two)), (2, _edited(rng, one, 3)), (3, _edited(rng, two, 3))]
    got = forest.near_duplicates(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    assert {r["component_id"] for r in got} == {1}


def test_overlaps_and_spanning():
    rng = np.random.default_rng(6)
    a, b = ([np.unique(rng.integers(0, high, rng.integers(1, 60)).astype(np.uint64)) for _ in range(n)]
            for n, high in ((40, 90), (30, 400)))
    assert forest.overlaps(a, b).tolist() == [[len(np.intersect1d(x, y)) for y in b] for x in a]
    assert forest.overlaps(a[:1], [np.array([9999], np.uint64)]).tolist() == [[0]]
    linked = np.zeros((4, 4), bool)
    linked[[0, 1, 1, 3], [1, 1, 2, 0]] = True
    assert sorted(forest.spanning(linked)) == [(0, 1, False), (0, 1, True), (0, 2, True), (3, 0, True)]


@pytest.fixture
def written(spark, monkeypatch):
    """(name, files) of the tables written meanwhile, with 16 partitions that Spark doesn't coalesce."""
    out = []

    def record(df, name, write=components.materialize):
        table = write(df, name)
        out.append((name, len(table.inputFiles())))
        return table

    conf = {"spark.sql.shuffle.partitions": "16", "spark.sql.adaptive.coalescePartitions.enabled": "false"}
    before = {k: spark.conf.get(k) for k in conf}
    for module in (components, forest):
        monkeypatch.setattr(module, "materialize", record)
    for k, v in conf.items():
        spark.conf.set(k, v)
    yield out
    for k, v in before.items():
        spark.conf.set(k, v)


def test_rounds_of_components_write_files_by_their_edges(spark, written, monkeypatch):
    edges = spark.createDataFrame([(i, i + 1) for i in range(0, 600) if i % 100 != 99], "u long, v long")
    expected = sorted((i, i // 100 * 100) for i in range(600))
    assert sorted(map(tuple, components.components(edges).collect())) == expected
    assert len(written) > 2 and {n for _, n in written[1:]} == {1}
    written.clear()
    monkeypatch.setattr(components, "EDGES", 100)
    assert sorted(map(tuple, components.components(edges).collect())) == expected
    assert {n for _, n in written[1:]} == {6}


def test_tables_that_are_read_once_are_not_written(spark, written):
    """A prefix with more rows than a window, in several components, so that all steps run."""
    rng = random.Random(5)
    template = [f"w{i}" for i in range(300)]
    rows = []
    for i in range(40):
        words = template + [f"p{i}x{k}" for k in range(55)]
        rows += [(2 * i, " ".join(words)), (2 * i + 1, _edited(rng, words, 14))]
    got = forest.near_duplicates(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    assert {r["doc_id"]: (r["n_shingles"], r["component_id"]) for r in got} == brute.near_groups(rows)
    names = {name for name, _ in written}
    assert "forest-finished" in names and "components" in names
    assert not names & {"forest-pair-ids", "forest-crowded", "forest-full", "forest-components"}
    assert sum(name == "forest-sets-of" for name, _ in written) == 2

"""Exact and near duplicates against comparisons of every pair."""

from __future__ import annotations

import hashlib
import random
import re

import numpy as np
import pytest
import xxhash
from small_corpus import frame, texts, words

from tablesync.llm import exact_dedup, simhash, spherical
from tablesync.llm.components import components
from tablesync.session import Scratch


@pytest.fixture
def scratch(spark):
    made = Scratch(spark)
    yield made
    made.clear()


def roots(n: int, links) -> list[int]:
    parent = list(range(n))

    def find(x):
        while parent[x] != x:
            parent[x] = parent[parent[x]]
            x = parent[x]
        return x

    for a, b in links:
        a, b = sorted((find(a), find(b)))
        parent[b] = a
    return [find(x) for x in range(n)]


@pytest.mark.parametrize("shape", ["chain", "star", "random", "none"])
def test_components(spark, scratch, shape):
    rng = random.Random(4)
    order = rng.sample(range(300), 300)
    links = {
        "chain": list(zip(order, order[1:])),
        "star": [(order[0], x) for x in order[1:]],
        "random": [(rng.randrange(300), rng.randrange(300)) for _ in range(200)],
        "none": [],
    }[shape]
    df = spark.createDataFrame(links + links[:3], "a long, b long")
    got = dict(components(df, scratch).collect())
    want = roots(300, links)
    assert got == {x: want[x] for pair in links for x in pair if pair[0] != pair[1]}


def lower(text: str | None) -> str:
    return re.sub("[A-Z]", lambda m: m.group().lower(), text or "")


@pytest.mark.parametrize("keep", ["largest", "smallest"])
@pytest.mark.parametrize("fan_in", [2, 16])
def test_exact(spark, scratch, keep, fan_in):
    given = texts() + ["Same Text"] * 40 + ["same text", "sAme text", "É", "é", "É"]
    df = frame(spark, given).repartition(7)
    rows = exact_dedup.exact_duplicates(df, scratch, keep=keep, fan_in=fan_in).collect()
    groups = {}
    for i, text in enumerate(given):
        groups.setdefault(lower(text), []).append(i)
    assert len(rows) == len(given)
    for row in rows:
        norm = lower(given[row.id])
        best = (max if keep == "largest" else min)(groups[norm])
        assert (row.keep_id, row.group_size, row.kept) == (best, len(groups[norm]), row.id == best)
        assert row.text_sha256 == hashlib.sha256(norm.encode()).hexdigest()
    stay = exact_dedup.drop_exact_duplicates(df, scratch, keep=keep)
    assert sorted(r.doc_id for r in stay.collect()) == sorted(r.id for r in rows if r.kept)
    assert stay.columns == df.columns


def test_exact_runs_meet_in_rounds(spark, scratch, monkeypatch):
    """Forty runs meet in groups, and what is left of them in a second round."""
    plans, write = {}, scratch.write
    monkeypatch.setattr(
        scratch, "write",
        lambda df, label: (plans.update({label: df._jdf.queryExecution().toString()}), write(df, label))[1],
    )
    df = frame(spark, ["a", "b", "A"] * 40).repartition(40)
    assert exact_dedup.exact_duplicates(df, scratch).where("kept").count() == 2
    assert plans["digests"].split("== Physical Plan ==")[1].count("Exchange hashpartitioning") == 2
    with pytest.raises(ValueError, match="two runs"):
        exact_dedup.exact_duplicates(df, scratch, fan_in=1)


def test_exact_odd_keys(spark, scratch):
    df = frame(spark, ["a", "A", "a", "b", "c"], [1, 1, None, None, 1])
    rows = exact_dedup.exact_duplicates(df, scratch, keep="largest").collect()
    assert sorted((str(r.id), str(r.keep_id), r.group_size, r.kept) for r in rows) == [
        ("1", "1", 1, True), ("1", "1", 3, True), ("1", "1", 3, True), ("None", "1", 3, False), ("None", "None", 1, True),
    ]
    stay = exact_dedup.drop_exact_duplicates(df, scratch, keep="largest")
    assert sorted(r.text for r in stay.collect()) == ["A", "a", "b", "c"]
    assert exact_dedup.exact_duplicates(frame(spark, []), scratch).collect() == []


def test_exact_main_path_has_no_python(spark, scratch, capsys):
    exact_dedup.exact_duplicates(frame(spark, ["a"]), scratch).explain()
    assert not re.search("Python|Pandas|Arrow", capsys.readouterr().out)


def plain_fingerprint(text: str | None) -> int:
    found = re.findall(r"[^\x20\x09-\x0D]+", lower(text))
    if not found:
        return 0
    shingles = [" ".join(found[i : i + 3]) for i in range(max(1, len(found) - 2))]
    hashes = [xxhash.xxh64_intdigest(s.encode(), 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def test_simhash_equals_every_pair(spark, scratch, monkeypatch):
    monkeypatch.setattr(simhash, "SLICE", 50)
    rng = random.Random(6)
    base = words(rng, 400).split()
    near = [" ".join(base[:i] + ["changed"] + base[i + 1 :]) for i in range(0, 400, 7)]
    given = texts() + near + ["a b", "A B", "x y z", "x y z"]
    prints = [plain_fingerprint(t) for t in given]
    links = [
        (a, b)
        for a in range(len(given))
        for b in range(a)
        if (prints[a] ^ prints[b]).bit_count() <= simhash.DISTANCE
    ]
    want = roots(len(given), links)
    rows = simhash.report(frame(spark, given), scratch).collect()
    assert {r.doc_id: (r.fingerprint, r.component_id) for r in rows} == {
        i: (f"{p:016x}", want[i]) for i, p in enumerate(prints)
    }
    assert len(set(want[len(texts()) : -4])) < len(near) / 2, "the fixture has no near copies"
    stay = simhash.keep_one(frame(spark, given), scratch).collect()
    assert sorted(r.doc_id for r in stay) == sorted(set(want))


@pytest.mark.parametrize("dense", [1, 32])
def test_links_connect_what_pairs_do(spark, scratch, monkeypatch, dense):
    """Clusters of many variants, links in either half or across both, sign bits included."""
    monkeypatch.setattr(simhash, "DENSE", dense)
    rng = random.Random(2)
    points = set()
    for _ in range(12):
        seed = rng.getrandbits(64)
        points.add(seed)
        for _ in range(60):
            flips = rng.sample(range(64), rng.choice([1, 2, 3, 4]))
            points.add(seed ^ sum(1 << b for b in flips))
    points |= {rng.getrandbits(64) for _ in range(200)} | {0, 1, 3, 7, (1 << 64) - 1, (1 << 63)}
    points = sorted(points)
    signed = [p - (1 << 64) if p >> 63 else p for p in points]
    found = simhash.links(spark.createDataFrame([(p,) for p in signed], "fp long"), scratch).collect()
    at = {p: i for i, p in enumerate(signed)}
    got = [(at[r.a], at[r.b]) for r in found]
    every = [
        (a, b) for a in range(len(points)) for b in range(a) if (points[a] ^ points[b]).bit_count() <= 2
    ]
    assert {tuple(sorted(p)) for p in got} <= {tuple(sorted(p)) for p in every}
    assert roots(len(points), got) == roots(len(points), every)


def test_simhash_odd_keys(spark, scratch):
    rows = simhash.near_duplicates(frame(spark, ["q w e"] * 3 + [None], [5, 5, None, 9]), scratch).collect()
    assert sorted(str(r.component_id) for r in rows) == ["5", "5", "5", "9"]
    assert simhash.near_duplicates(frame(spark, []), scratch).collect() == []


def test_keep_one_of_repeated_keys(spark, scratch):
    """A key with several texts, in several groups or in one, and whole rows repeated."""
    given = [(5, "a b c"), (9, "A b c"), (5, "x y z"), (3, "X y z"), (5, "p q r"), (5, "P q r"),
             (7, "k l m"), (7, "k l m"), (None, "k l m"), (None, "a b c")]
    df = frame(spark, [t for _, t in given], [i for i, _ in given]).repartition(3)
    stay = simhash.keep_one(df, scratch)
    assert stay.columns == df.columns
    rows = sorted((str(r.doc_id), r.text.lower()) for r in stay.collect())
    assert rows == [("3", "x y z"), ("5", "a b c"), ("5", "p q r"), ("7", "k l m"), ("None", "a b c"), ("None", "k l m")]


def vectors(seed: int = 0):
    rng = np.random.default_rng(seed)
    made = list(rng.standard_normal((120, 24)))
    for at in range(12):
        for _ in range(rng.integers(1, 40)):
            near = made[at] + rng.standard_normal(24) * 0.06 * np.linalg.norm(made[at])
            made += [near, near * 3] if rng.random() < 0.2 else [near]
    rows = [(i, [float(np.float32(x)) for x in v], int(i % 7 == 0)) for i, v in enumerate(made)]
    rows += [(r[0] + 5000, r[1], r[2]) for r in rows[:9]]
    odd = [None, [], [0.0] * 24, [float("nan")] * 24, [float("inf")] + [1.0] * 23, [None] + [1.0] * 23, [1.0] * 23]
    rows += [(9000 + i, v, 0) for i, v in enumerate(odd)]
    rows += [(9100, rows[0][1], None), (9101, rows[0][1], rows[0][2])]
    return rows


@pytest.mark.parametrize("block", [16, 1024])
def test_vectors_equal_every_pair(spark, scratch, monkeypatch, block):
    monkeypatch.setattr(spherical, "BLOCK", block)
    rows = vectors()
    usable = [
        v is not None and label is not None and len(v) > 0 and None not in v and np.isfinite(v).all() and any(v)
        for _, v, label in rows
    ]
    links = [
        (a, b)
        for a in range(len(rows))
        for b in range(a)
        if usable[a] and usable[b] and rows[a][2] == rows[b][2] and len(rows[a][1]) == len(rows[b][1])
        and np.dot(rows[a][1], rows[b][1]) >= 0.93 * np.linalg.norm(rows[a][1]) * np.linalg.norm(rows[b][1])
    ]
    want, count = roots(len(rows), links), np.zeros(len(rows), int)
    for a, b in links:
        count[a] += 1
        count[b] += 1
    df = spark.createDataFrame(rows, "vec_id long, embedding array<float>, label int")
    df = df.selectExpr("*", "1 AS node", "2 AS vector", "3 AS filter", "4 AS links", "5 AS copies")
    got = {r.vec_id: r for r in spherical.similar_vectors(df, scratch).collect()}
    assert len(got) == len(rows)
    found = sum(got[r[0]].n_links for r in rows)
    assert found >= 0.97 * 2 * len(links) and all(got[r[0]].n_links <= n for r, n in zip(rows, count))
    agree = sum(got[r[0]].component_id == rows[w][0] for r, w in zip(rows, want))
    assert agree >= 0.97 * len(rows)
    assert all(g.kept == (g.vec_id == g.component_id) for g in got.values())
    assert all(got[9000 + i].n_links == 0 and got[9000 + i].kept for i in range(7))


@pytest.mark.parametrize("rows", [100, 5_000, 40_000])
def test_filter_recall(rows):
    """Recall at the lowest cosine that links, in the dimension of the given table."""
    rng, size = np.random.default_rng(3), spherical.Size.of(rows)
    a = spherical.unit(rng.standard_normal((800, 64)))
    side = rng.standard_normal((800, 64))
    side = spherical.unit(side - (side * a).sum(axis=1, keepdims=True) * a)
    b = 0.93 * a + np.sqrt(1 - 0.93**2) * side
    hits = [np.intersect1d(x, y).size > 0 for x, y in zip(spherical.decode(a, size), spherical.decode(b, size))]
    assert np.mean(hits) >= 0.97


def test_candidates_of_a_vector_stay_about_the_same():
    """Random vectors of one label: eight times the rows, not eight times the candidates."""
    rng, found = np.random.default_rng(6), []
    for rows in (1_000, 8_000):
        units = spherical.unit(rng.standard_normal((rows, 64)))
        filters = np.concatenate(spherical.decode(units, spherical.Size.of(rows)))
        _, members = np.unique(filters, return_counts=True)
        found.append((members * (members - 1)).sum() / rows)
    assert found[1] < 1.5 * found[0]


def test_vectors_empty_table(spark, scratch):
    df = spark.createDataFrame([], "vec_id long, embedding array<float>, label int")
    assert spherical.similar_vectors(df, scratch).collect() == []

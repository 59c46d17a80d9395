"""SimHash, components and the flat graph against brute force."""

import numpy as np
import pytest
import xxhash

from dockline.llm import flat_graph, simhash
from dockline.llm.components import connected_components, local_roots


def plain_components(n, pairs):
    root = list(range(n))

    def find(x):
        while root[x] != x:
            root[x] = root[root[x]]
            x = root[x]
        return x

    for a, b in pairs:
        a, b = find(a), find(b)
        root[max(a, b)] = min(a, b)
    return [find(i) for i in range(n)]


def plain_fingerprint(text):
    import re
    words = re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))
    if not words:
        return 0
    grams = [" ".join(words[i:i + 3]) for i in range(max(1, len(words) - 2))]
    values = [xxhash.xxh64_intdigest(g.encode(), 42) for g in grams]
    return sum(1 << b for b in range(64) if 2 * sum(v >> b & 1 for v in values) > len(values))


def test_components_of_chains_stars_and_cliques(spark):
    pick = np.random.default_rng(3)
    pairs = [(i, i + 1) for i in range(60)] + [(100, i) for i in range(101, 140)] + \
        [(a, b) for a in range(200, 210) for b in range(200, 210)] + [tuple(map(int, p)) for p in pick.integers(300, 400, (60, 2))]
    got = {r["node"]: r["root"] for r in connected_components(spark.createDataFrame(pairs, "a bigint, b bigint")).collect()}
    want = plain_components(400, pairs)
    linked = {x for p in pairs if p[0] != p[1] for x in p}
    assert got == {i: want[i] for i in linked}
    assert connected_components(spark.createDataFrame([], "a bigint, b bigint")).count() == 0


def test_local_roots():
    pick = np.random.default_rng(0)
    pairs = pick.integers(0, 300, (200, 2))
    assert local_roots(300, pairs[:, 0], pairs[:, 1]).tolist() == plain_components(300, pairs.tolist())


@pytest.mark.parametrize("block", [16, 512])
def test_posting_links_span_all_near_pairs(monkeypatch, block):
    monkeypatch.setattr(simhash, "BLOCK", block)
    pick, values = np.random.default_rng(0), []
    for base in pick.integers(0, 2 ** 63, 30, dtype=np.uint64):
        for _ in range(40):
            value = int(base)
            for _ in range(pick.integers(0, 4)):
                value ^= 1 << int(pick.integers(0, 64))
            values.append(value)
    values = np.unique(np.array(values, np.uint64))
    near = np.argwhere(np.triu(np.bitwise_count(values[:, None] ^ values[None]) <= 2, 1))
    a, b = simhash.posting_links(values)
    assert local_roots(len(values), a, b).tolist() == plain_components(len(values), near.tolist())


def test_every_six_positions_hold_a_set():
    from itertools import combinations
    assert all(any(set(s) <= set(c) for s in simhash.position_sets()) for c in combinations(range(8), 6))


def near_texts():
    words = [f"w{i}" for i in range(400)]
    texts = [" ".join(words), " ".join(words[:-1] + ["other"]), " ".join(words).upper(), "", None, " \t\n", "\x0b", "one two", "One  Two",
             "é É", "x" * 3000]
    return texts + [" ".join([*words[:i], "new", *words[i:]]) for i in range(0, 400, 7)] + [f"text {i} of its own kind" for i in range(40)]


def test_groups_equal_brute_force(spark):
    texts = near_texts()
    rows = [(i, t, i) for i, t in enumerate(texts)] + [(2, texts[2], 0), (None, texts[0], 0), (None, "alone without id", 0)]
    prints = [plain_fingerprint(t) for _, t, _ in rows]
    pairs = [(a, b) for a in range(len(rows)) for b in range(a) if (prints[a] ^ prints[b]).bit_count() <= 2]
    root = plain_components(len(rows), pairs)
    least = {}
    for r, (i, _, _) in zip(root, rows):
        least[r] = min((x for x in (least.get(r), i) if x is not None), default=None)
    want = sorted(((i, f"{p:016x}", least[r]) for (i, _, _), p, r in zip(rows, prints, root)), key=str)
    docs = spark.createDataFrame(rows, "doc_id bigint, text string, fp bigint").repartition(4)
    assert sorted(map(tuple, simhash.simhash_groups(docs).collect()), key=str) == want
    assert any(len([x for x in root if x == r]) > 20 for r in set(root))
    kept = simhash.without_near_copies(docs)
    assert kept.columns == docs.columns
    assert sorted((r["doc_id"] for r in kept.collect()), key=str) == sorted(least.values(), key=str)
    assert simhash.simhash_groups(docs.limit(0)).count() == 0 and simhash.without_near_copies(docs.limit(0)).count() == 0


def clustered_vectors():
    pick, rows = np.random.default_rng(5), []
    for label in (0, 1, None):
        centre = pick.normal(size=(40, 16))
        for c in range(40):
            for _ in range(12 if c else 160):
                rows.append((len(rows), (centre[c] + pick.normal(size=16) * (0.04 if c % 2 else 0.12)).astype("f4").tolist(), label))
    rows += [(len(rows) + i, rows[5][1], 0) for i in range(9)]
    rows += [(5000, None, 0), (5001, [0.0] * 16, 0), (5002, [float("nan")] * 16, 0), (5003, [float("inf")] + [1.0] * 15, 1),
             (5004, [None] + [1.0] * 15, 1), (5005, [], 1), (5006, [1.0, 2.0], 1), (5007, [2.0, 4.0], 1), (None, rows[5][1], 0),
             (5008, [-0.0, 3.0], 7), (5009, [0.0, 3.0], 7), (5010, [1e-30, 3.0], 7)]
    return rows


@pytest.mark.parametrize("plan", [flat_graph.Plan(), flat_graph.Plan(cell=60, blocks_of=2)])
def test_vector_groups_against_brute_force(spark, plan):
    rows = clustered_vectors()
    frame = spark.createDataFrame([(i, v, k, "x") for i, v, k in rows], "vec_id bigint, embedding array<float>, label int, rep string")

    def usable(v):
        return v is not None and len(v) and all(x is not None and np.isfinite(x) for x in v) and any(v)

    unit = [np.array(v) / np.linalg.norm(v) if usable(v) else None for _, v, _ in rows]
    pairs = [(a, b) for a in range(len(rows)) for b in range(a) if unit[a] is not None and unit[b] is not None
             and rows[a][2] is not None and rows[a][2] == rows[b][2] and len(unit[a]) == len(unit[b]) and unit[a] @ unit[b] >= 0.93]
    degree, root = np.zeros(len(rows), int), plain_components(len(rows), pairs)
    for a, b in pairs:
        degree[a] += 1
        degree[b] += 1
    least = {}
    for r, (i, _, _) in zip(root, rows):
        least[r] = min((x for x in (least.get(r), i) if x is not None), default=None)
    got = {r["vec_id"]: r for r in flat_graph.embedding_groups(frame.repartition(3), plan).collect()}
    assert len(got) == len(rows)
    assert all(got[i]["n_links"] <= d for (i, _, _), d in zip(rows, degree))
    assert sum(r["n_links"] for r in got.values()) >= 0.97 * degree.sum() > 0
    assert all(got[i]["component_id"] == least[r] for (i, _, _), r in zip(rows, root))
    assert all(r["kept"] == (r["vec_id"] == r["component_id"]) for r in got.values())


def test_vector_recall_and_empty_table(spark, sf_dir):
    frame = spark.createDataFrame(clustered_vectors(), "vec_id bigint, embedding array<float>, label int")
    row = flat_graph.audit_recall(frame, flat_graph.Plan(cell=60, blocks_of=2), 3).first()
    assert row["found"] >= 0.9 * row["expected"] > 0
    assert flat_graph.embedding_groups(frame.limit(0)).count() == 0


def test_queries_visit_every_group_in_range(spark):
    # A third are near copies of one vector, spread over more cells than a fixed number of probes reaches.
    rng = np.random.default_rng(5)
    one = flat_graph._unit(rng.normal(size=(1, 16)))
    x = flat_graph._unit(np.concatenate([rng.normal(size=(2000, 16)), one + 0.065 * rng.normal(size=(1000, 16))]))
    near = x @ x.T >= 0.93
    frame = spark.createDataFrame([(i, v.tolist(), 0) for i, v in enumerate(x)], "vec_id bigint, embedding array<double>, label int")
    plan = flat_graph.Plan(cell=30, blocks_of=4)
    reps = flat_graph.distinct_vectors(frame)[1]
    cells = flat_graph.fit_cells(reps, plan)
    members = flat_graph.assigned(reps.drop("least"), cells, plan).cache()
    at = {r["rep"]: r["least"] for r in reps.select("rep", "least").collect()}
    home = {at[r["rep"]]: r["own"][0]["grp"] for r in members.select("rep", "own").collect()}
    visits = {at[r["rep"]]: set(r["probes"]) for r in flat_graph.probing(members, cells, plan).select("rep", "probes").collect()}
    assert len(set(home.values())) > 20
    assert all(home[b] in visits[a] for a, b in zip(*(k.tolist() for k in np.nonzero(near))))
    assert any(len(v) < len(set(home.values())) for v in visits.values())
    got = flat_graph.embedding_groups(frame, plan).select("vec_id", "n_links").collect()
    links = near.sum(1) - 1
    assert all(r["n_links"] <= links[r["vec_id"]] for r in got)
    assert sum(r["n_links"] for r in got) >= 0.98 * links.sum()


def test_rare_links_of_a_block_are_found():
    # Two pieces that no link joins, one query in a thousand with a link, none among 48 evenly spaced ones.
    rng = np.random.default_rng(9)
    x = flat_graph._unit(rng.normal(size=(600, 64)))
    q = flat_graph._unit(rng.normal(size=(1000, 64)))
    q[501] = flat_graph._unit(x[[599]] + 0.02 * rng.normal(size=(1, 64)))[0]
    lists, starts = [], []
    for begin in (0, 300):
        near, medoid = flat_graph.build_graph(x[begin:begin + 300])
        lists += [s + begin for s in near]
        starts.append(medoid + begin)
    lists[599] = np.zeros(0, np.int64)
    for s in range(599):
        lists[s] = lists[s][lists[s] != 599]  # no path leads to it
    rep = np.arange(600)
    linked, a, b = flat_graph.search_block(
        (x, rep, np.ones(600, np.int64), lists, np.array(starts), np.zeros(2, int), np.ones(600, bool)),
        (q, rep[-1] + 1 + np.arange(1000)), flat_graph.Plan())
    assert np.flatnonzero(linked).tolist() == [501] and {*a.tolist(), *b.tolist()} == {599, 1101}


def test_graph_is_reachable_and_pruned():
    x = flat_graph._unit(np.random.default_rng(1).normal(size=(300, 8)))
    lists, medoid = flat_graph.build_graph(x)
    seen, todo = {medoid}, [medoid]
    while todo:
        new = {int(v) for u in todo for v in lists[u]} - seen
        seen |= new
        todo = list(new)
    assert len(seen) == 300 and max(map(len, lists)) <= 3 * flat_graph.DEGREE
    for n in (1, 2, 5):
        assert len(flat_graph.build_graph(x[:n])[0]) == n


@pytest.mark.parametrize("plan", [flat_graph.Plan(), flat_graph.Plan(beam=1, starts=1)])
def test_the_graph_answers_with_few_cosines(plan):
    # 4,000 vectors without structure, one in fifty with a near copy; a beam of one is widened by the audit.
    rng = np.random.default_rng(3)
    x = rng.normal(size=(4000, 24))
    x[:80] = x[2000:2080] + 0.2 * rng.normal(size=(80, 24))
    x = flat_graph._unit(x)
    centre = flat_graph._means(x[::4], 16)
    own = np.argsort(-(x @ centre.T), axis=1)[:, :2]
    lists, starts = [[] for _ in x], []
    for c in range(16):
        piece = np.flatnonzero((own == c).any(1))
        near, medoid = flat_graph.build_graph(x[piece])
        starts.append(piece[medoid])
        for v, to in zip(piece, near):
            lists[v].append(piece[to])
    rep, told = np.arange(len(x)), []
    linked, _, _ = flat_graph.search_block(
        (x, rep, np.ones(len(x), np.int64), [np.unique(np.concatenate(s)) for s in lists], np.array(starts), np.arange(16), np.ones(len(x), bool)),
        (x, rep), plan, told)
    true = (x @ x.T >= 0.93).sum(1) - 1
    cosines, expected, found = told[0]
    assert (linked <= true).all() and linked.sum() >= 0.98 * true.sum() > 0
    assert found >= 0.98 * expected and cosines < 0.6 * len(x) ** 2


def test_turned_vectors_stay_in_range():
    x = flat_graph._unit(np.random.default_rng(4).normal(size=(50, 12)))
    for towards in (None, x[::-1]):
        cosine = np.einsum("ij,ij->i", flat_graph.turned(x, 1, towards), x)
        assert (cosine >= 0.93).all() and (cosine <= 0.97 + 1e-9).all()
    assert (flat_graph.turned(np.ones((3, 1)), 1) == 1).all()


def test_many_blocks_and_tasks_give_the_same_groups(spark):
    frame = spark.createDataFrame(clustered_vectors(), "vec_id bigint, embedding array<float>, label int")
    one = sorted(map(tuple, flat_graph.embedding_groups(frame).collect()), key=str)
    plan = flat_graph.Plan(cell=40, blocks_of=3, queries=50, numbers=5000)
    many = sorted(map(tuple, flat_graph.embedding_groups(frame, plan).collect()), key=str)
    assert [(r[0], r[2], r[3]) for r in many] == [(r[0], r[2], r[3]) for r in one]
    assert sum(r[1] for r in many) >= 0.98 * sum(r[1] for r in one)

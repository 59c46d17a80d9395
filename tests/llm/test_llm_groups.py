"""Source divergence and centroid clustering against plain versions."""

import hashlib
import math
import random
import re
from collections import Counter, defaultdict

import numpy as np
import pyarrow as pa
import pytest

from dockline.llm import centroids, divergence
from dockline.llm.queries import ORACLES, QUERIES
from tools.check import compare, connect

DOCS = "doc_id bigint, text string, lang string, source string, n_chars bigint, term string, v int, value double"


def plain_divergence(rows, least, top):
    """The contract, term by term over dense counts."""
    groups, langs, frequent = defaultdict(Counter), defaultdict(Counter), defaultdict(Counter)
    for text, lang, source in rows:
        lower = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
        terms = re.findall(r"[^\x00-\x40\x5B-\x60\x7B-\x7F]+", lower)
        groups[lang or "", source or ""].update(terms)
        langs[lang or ""].update(terms)
        frequent[lang or ""].update(set(terms))
    kept = {k: sorted(t for t, n in df.items() if n >= least) for k, df in frequent.items()}

    def shares(counts, terms):
        total = sum(counts[t] for t in terms)
        return {t: 1 + 1_000_000_000 * (counts[t] + 2) // (total + 2 * len(terms)) for t in terms}

    def ranked(found):
        order = sorted(found, key=lambda x: (-x[1], x[0].encode()))
        return [(item, value, i + 1) for i, (item, value) in enumerate(order)]

    apart = lambda p, q: (p - q) ** 2 // (p + q)
    p = {g: shares(c, kept[g[0]]) for g, c in groups.items()}
    usual = {k: shares(c, kept[k]) for k, c in langs.items()}
    out = []
    for lang, source in groups:
        own = p[lang, source]
        pairs = [(b, sum(apart(own[t], p[lang, b][t]) for t in kept[lang])) for k, b in groups if k == lang and b != source]
        terms = [(t, apart(own[t], usual[lang][t])) for t in kept[lang] if groups[lang, source][t] and own[t] > usual[lang][t]]
        out += [(lang, source, "pair", *r) for r in ranked(pairs)] + [(lang, source, "term", *r) for r in ranked(terms)[:top]]
    return sorted(out)


def made_rows():
    pick = random.Random(3)
    words = ["Alpha", "beta", "GAMMA", "\u00c9t\u00e9", "\u00e9t\u00e9", "\u0130x", "na\u00efve", "z", "\U0001f600", "delta's", "a1b"]
    rows = [(" ".join(pick.choices(words, k=pick.randint(0, 12))), pick.choice(["en", "de", None]), pick.choice(["s1", "s2", "s3", None, ""]))
            for _ in range(120)]
    rows += [(None, "en", "s1"), ("", "xx", "only"), ("1 2 3 ###", "xx", "other"), ("word " * 20_000, "de", "s9")]
    return rows + rows[:5]


@pytest.mark.parametrize("least,top", [(10, 10), (2, 3), (1000, 10)])
def test_divergence_equals_plain_counts(spark, least, top):
    rows = made_rows()
    docs = spark.createDataFrame([(i, t, k, s, 0, "x", 1, 1.5) for i, (t, k, s) in enumerate(rows)], DOCS).repartition(3)
    got = divergence.source_divergence(docs, least, top)
    assert sorted(map(tuple, got.collect())) == plain_divergence(rows, least, top)


def test_divergence_of_an_empty_table(spark):
    got = divergence.source_divergence(spark.createDataFrame([], DOCS))
    assert got.columns == ["lang", "source", "part", "item", "value", "rank"] and got.count() == 0


@pytest.mark.parametrize("pending,rows", [(2_000_000, 4096), (50, 7), (1, 1)])
def test_block_sums_over_many_batches(monkeypatch, pending, rows):
    """Sums are the same however often a task hands them on and wherever a block is cut into batches."""
    monkeypatch.setattr(divergence, "PENDING", pending)
    rng = np.random.default_rng(5)
    vectors = [("s%d" % rng.integers(4), rng.choice(5000, rng.integers(0, 60), replace=False)) for _ in range(90)]
    want = Counter()
    for source, places in vectors:
        want.update({(7, source, int(p)): int(p) % 5 + 1 for p in places})
    kind = pa.struct([("indices", pa.list_(pa.int32())), ("values", pa.list_(pa.float64()))])
    batch = pa.RecordBatch.from_arrays([
        pa.array([7] * len(vectors), pa.int32()), pa.array([s for s, _ in vectors]),
        pa.array([{"indices": p.tolist(), "values": (p % 5 + 1.0).tolist()} for _, p in vectors], kind)], ["v", "source", "vector"])
    cut = [batch.slice(i, rows) for i in range(0, batch.num_rows, rows)]
    blocks = pa.Table.from_batches(list(divergence._sum_vectors(cut))).sort_by([("source", "ascending"), ("block", "ascending")])
    got = pa.Table.from_batches(list(divergence._merge_blocks(blocks.to_batches(max_chunksize=rows)))).to_pylist()
    assert {(r["v"], r["source"], r["place"]): r["n"] for r in got} == dict(want) and len(got) == len(want)


def test_shares_beyond_a_billion_counts(spark):
    df = spark.createDataFrame([(10 ** 13, 10 ** 15, 10 ** 6)], "n bigint, total bigint, n_terms bigint")
    assert df.select(divergence._share("n", "total")).first()[0] == 1 + 10 ** 9 * (10 ** 13 + 2) // (10 ** 15 + 2 * 10 ** 6)


def plain_clusters(rows, size, k, rounds):
    kept = [(i, tuple(math.floor(1024 * x) for x in v)) for i, v in rows
            if v is not None and len(v) == size and all(x is not None and math.isfinite(x) for x in v)]
    first = sorted(kept, key=lambda r: ((0, hashlib.sha256(f"3:{r[0]}".encode()).hexdigest()) if r[0] is not None else (1, ""), r[1]))
    centres = [p for _, p in first[:k]]
    far = lambda a, b: sum((x - y) ** 2 for x, y in zip(a, b))
    nearest = lambda p: min((far(p, c), j) for j, c in enumerate(centres))
    for _ in range(rounds):
        own = defaultdict(list)
        for _, p in kept:
            own[nearest(p)[1]].append(p)
        centres = [tuple(sum(c) // len(own[j]) for c in zip(*own[j])) if j in own else c for j, c in enumerate(centres)]
    final = [(i, *reversed(nearest(p))) for i, p in kept]
    inertia = Counter()
    for _, j, d in final:
        inertia[j] += d
    sha = [hashlib.sha256(",".join(map(str, c)).encode()).hexdigest() for c in centres]
    return sorted(((i, j, d, inertia[j], sum(inertia.values()), sha[j]) for i, j, d in final), key=str)


def made_vectors(n, size=6):
    pick = random.Random(n)
    rows = [(i, [pick.choice([-1.5, 0.25, 1.0]) + pick.random() / 8 for _ in range(size)]) for i in range(n)]
    rows += rows[:3] + [(n + 1, None), (n + 2, []), (n + 3, [1.0] * (size + 1)), (n + 4, [None] + [1.0] * (size - 1)),
                        (n + 5, [float("nan")] * size), (n + 6, [float("inf")] + [0.0] * (size - 1)), (None, [0.5] * size), (n + 7, [0.0] * size)]
    return rows


@pytest.mark.parametrize("n,rounds", [(0, 10), (5, 10), (150, 1), (150, 10)])
def test_clusters_equal_plain_rounds(spark, n, rounds):
    rows = made_vectors(n)
    df = spark.createDataFrame([(i, v, 1, 2) for i, v in rows], "vec_id bigint, embedding array<float>, cluster int, point int").repartition(3)
    got = centroids.clusters_of(df, rounds=rounds, size=6)
    floats = [(i, None if v is None else [None if x is None else float(np.float32(x)) for x in v]) for i, v in rows]
    assert sorted(map(tuple, got.collect()), key=str) == plain_clusters(floats, 6, 8, rounds)


def test_clusters_of_no_vector_and_of_too_large_ones(spark):
    schema = "vec_id bigint, embedding array<float>"
    assert centroids.clusters_of(spark.createDataFrame([], schema)).count() == 0
    assert centroids.clusters_of(spark.createDataFrame([(1, None)], schema)).count() == 0
    with pytest.raises(Exception, match="too large"):
        centroids.clusters_of(spark.createDataFrame([(1, [1e30] * 64)], schema))


def test_products_move_by_changed_components(spark):
    points = spark.createDataFrame([(1, [3, 4]), (2, [-1, 5])], centroids.POINTS)
    before, after = np.array([[1, 2], [7, 7]]), np.array([[1, 9], [7, 7]])
    start = centroids.corrected(points, np.zeros_like(before), before)
    moved = {r["vec_id"]: r for r in centroids.corrected(start, before, after).collect()}
    assert moved[1]["dots"] == [39, 49] and moved[2]["dots"] == [44, 28]
    assert moved[2]["cluster"] == 0 and moved[2]["distance"] == 20


@pytest.mark.parametrize("name", ["op11_source_divergence", "op13_centroid_clusters"])
def test_queries_equal_their_sql(spark, sf_dir, name):
    assert compare(QUERIES[name](spark, sf_dir), connect(sf_dir), ORACLES[name]) == ""

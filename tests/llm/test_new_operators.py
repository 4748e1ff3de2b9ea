"""Sharding ring, hard negatives and whitening on small frames, against brute force."""

import math
import zlib
from collections import Counter, defaultdict
from hashlib import md5

import numpy as np
import pytest
from pyspark.sql import functions as F

from oddsframe.llm import hard_negatives, sharding_ring, topk_impact, whitening
from oddsframe.llm.common import ship_package

DOCS = "doc_id long, text string, shard string, arc int, n long"
VECTORS = "vec_id long, label int, embedding array<double>, score string, x int, d int"


@pytest.fixture(scope="module", autouse=True)
def shipped(spark):
    ship_package(spark)


# --- sharding -----------------------------------------------------------------------------------------------------

def _place(text):
    return int(md5(text.encode()).hexdigest()[:15], 16)


def _ring_by_hand(rows, shards, nodes, room):
    """One row at a time: the arc's shard, else the next clockwise with room. ``room`` None: no bound."""
    points = sorted((_place(f"node:{s}:{r}"), s) for s in range(shards) for r in range(nodes))
    arcs = []
    for doc_id, text in rows:
        at = _place("null" if doc_id is None else f"id:{doc_id}")
        arc = next((i for i, (p, _) in enumerate(points) if p >= at), 0)
        arcs.append((arc, at, -1 if doc_id is None else doc_id, zlib.crc32((text or "").encode()), len((text or "").encode()) + 1, doc_id))
    load, out = [0] * shards, []
    for arc, _, _, crc, size, doc_id in sorted(arcs, key=lambda a: a[:5]):
        shard = next(points[(arc + i) % len(points)][1] for i in range(len(points))
                     if room is None or load[points[(arc + i) % len(points)][1]] < room[points[(arc + i) % len(points)][1]])
        out.append((doc_id, size, crc, shard, load[shard]))
        load[shard] += 1
    return sorted(out, key=repr)


def _shard_rows():
    rows = [(i, f"text {i} " * (i % 7)) for i in range(150)]
    rows += [(7, "one id, many rows")] * 40 + [(7, f"one id, text {i}") for i in range(40)]
    return rows + [(None, None), (None, ""), (None, "é" * 4000), (200, None), (201, "Größe 漢字"), (202, "")]


@pytest.mark.parametrize("shards, nodes, slack", [(16, 128, 0.0), (5, 3, 0.0), (4, 8, 0.25), (1, 1, 0.0), (300, 1, 0.0)])
def test_ring_equals_one_row_at_a_time(spark, shards, nodes, slack):
    rows = _shard_rows()
    df = spark.createDataFrame([(i, t, "clash", 1, 2) for i, t in rows], DOCS).repartition(5)
    n = len(rows)
    room = [math.ceil((1 + slack) * n / shards)] * shards if slack else [n // shards + (s < n % shards) for s in range(shards)]
    got = sharding_ring.assign(df, shards, "rows", slack, nodes).collect()
    assert {r.law for r in got} == {"bounded" if slack else "rows"} and {r.grown_shard for r in got} == {None}
    assert sorted(((r.doc_id, r["size"], r.text_crc32, r.shard, r.slot) for r in got), key=repr) == _ring_by_hand(rows, shards, nodes, room)


def test_ring_rows_law_and_slots(spark):
    df = spark.createDataFrame([(i, t, "clash", 1, 2) for i, t in _shard_rows()], DOCS)
    slots = defaultdict(list)
    for r in sharding_ring.assign(df, 16).collect():
        slots[r.shard].append(r.slot)
    assert all(sorted(s) == list(range(len(s))) for s in slots.values())
    assert max(map(len, slots.values())) - min(map(len, slots.values())) <= 1


def test_ring_key_law_moves_rows_into_the_new_shard_only(spark):
    rows = _shard_rows()
    df = spark.createDataFrame([(i, t, "clash", 1, 2) for i, t in rows], DOCS)
    got = sharding_ring.assign(df, 6, "key").collect()
    assert sorted(((r.doc_id, r["size"], r.text_crc32, r.shard, r.slot) for r in got), key=repr) == _ring_by_hand(rows, 6, 128, None)
    assert len(got) == len(rows) and all(r.grown_shard in (r.shard, 6) for r in got)
    assert len({(r.doc_id, r.shard, r.grown_shard) for r in got}) == len({r.doc_id for r in got})
    seven = {r.doc_id: r.shard for r in sharding_ring.assign(df, 7, "key").collect()}
    assert all(seven[r.doc_id] == r.grown_shard for r in got)


def test_ring_slack_limits_movement(spark):
    df = spark.range(3000).select(F.col("id").alias("doc_id"), F.lit("t").alias("text"))
    before = {r.doc_id: r.shard for r in sharding_ring.assign(df, 16, slack=0.25).collect()}
    after = {r.doc_id: r.shard for r in sharding_ring.assign(df, 17, slack=0.25).collect()}
    assert max(Counter(before.values()).values()) <= math.ceil(1.25 * 3000 / 16)
    between_old = sum(after[i] not in (before[i], 16) for i in before)
    assert between_old < 0.05 * 3000


def test_ring_edges(spark):
    empty = spark.createDataFrame([], DOCS)
    assert sharding_ring.assign(empty).collect() == [] and sharding_ring.assign(empty, law="key").collect() == []
    kept = sharding_ring.assign(spark.createDataFrame([(1, "ab", "mine", 5, 6)], DOCS), 2, keep=("doc_id", "text", "arc", "n", "shard"))
    assert kept.columns == ["doc_id", "text", "arc", "n", "size", "text_crc32", "law", "shard", "slot", "grown_shard"]
    assert tuple(kept.first())[:6] == (1, "ab", 5, 6, 3, zlib.crc32(b"ab"))
    with pytest.raises(ValueError):
        sharding_ring.assign(empty, law="bytes")


# --- hard negatives -----------------------------------------------------------------------------------------------

def _mined_by_hand(rows, every=50, positives=5, negatives=3, low=50, high=95):
    good = [(i, lab, [math.floor(256 * v) for v in e]) for i, lab, e in rows if i is not None and lab is not None and e
            and all(v is not None and math.isfinite(v) for v in e)]
    score = lambda a, b: sum(p * q for p, q in zip(a, b))
    out = []
    for i, lab, e in {(i, lab, tuple(e)) for i, lab, e in good if i % every == 0}:
        others = sorted((-score(e, f), j, m == lab) for j, m, f in good if j != i and len(f) == len(e))
        for s, j, _ in [o for o in others if o[2]][:positives]:
            hits = [(t, h) for t, h, same in others if not same and low * -s <= 100 * -t <= high * -s][:negatives]
            out += [(i, j, r + 1, h, -s, -t) for r, (t, h) in enumerate(hits)]
    return sorted(out)


def _got(df):
    return sorted((r.anchor_id, r.positive_id, r["rank"], r.negative_id, r.positive_score, r.negative_score) for r in df.collect())


def _vector_rows(seed=5, n=700, d=6):
    rng = np.random.default_rng(seed)
    centres = rng.normal(size=(4, d))
    rows = [(i, int(i % 4) if i % 3 else 0, (centres[i % 4] + 0.5 * rng.normal(size=d)).round(2).tolist()) for i in range(n)]
    rows += [(n + i, 1 + i % 2, rows[3][2]) for i in range(30)]           # ties
    rows += [(250, 2, rows[9][2])] * 2 + [(9000, 1, [0.0] * d), (9050, 1, [0.0] * d)]
    return rows + [(None, 1, [1.0] * d), (9001, None, [1.0] * d), (9002, 1, None), (9003, 1, [None] * d), (9100, 1, [math.nan] * d),
                   (9150, 1, [math.inf] * d), (9200, 1, []), (9250, 1, [1.0, 2.0]), (9251, 1, [1.0, 3.0]), (9252, 2, [1.0, 2.0])]


def _frame(spark, rows):
    return spark.createDataFrame([(i, lab, e, "clash", 1, 2) for i, lab, e in rows], VECTORS)


def test_hard_negatives_against_brute_force(spark):
    rows = _vector_rows()
    got = _got(hard_negatives.mine(_frame(spark, rows), F.col("vec_id") % 50 == 0))
    assert got == _mined_by_hand(rows) and len(got) > 100
    assert hard_negatives.mine(_frame(spark, rows).limit(0), F.col("vec_id") % 50 == 0).count() == 0


def test_hard_negatives_in_shards_and_blocks_with_large_components(spark, monkeypatch):
    monkeypatch.setattr(hard_negatives, "SHARD_ROWS", 100)
    monkeypatch.setattr(hard_negatives, "ANCHOR_ROWS", 4)
    rng = np.random.default_rng(6)
    rows = _vector_rows(7, 300)
    rows += [(10000 + i, int(i % 3), (rng.normal(size=6) * 2.0 ** 20).tolist()) for i in range(60)]
    rows += [(20000 + 50 * i, int(i % 3), (rng.normal(size=6) * 2.0 ** 30).tolist()) for i in range(6)]
    got = _got(hard_negatives.mine(_frame(spark, rows), F.col("vec_id") % 50 == 0))
    held = lambda s: min(s, 2 ** 63 - 1)
    assert got == sorted((*w[:4], held(w[4]), held(w[5])) for w in _mined_by_hand(rows))
    assert any(g[0] >= 20000 for g in got) and any(g[4] < 2 ** 63 - 1 for g in got if g[0] >= 10000)


def test_angular_bounds_hold_scores_and_filter():
    rng = np.random.default_rng(8)
    x = np.floor(256 * rng.normal(size=(2000, 8)) + 400 * rng.normal(size=(1, 8)))
    x[5], x[6] = 0, x[7]
    directions = hard_negatives.references([r.tolist() for r in x[:500]])[8]
    assert np.allclose(np.linalg.norm(directions, axis=1), 1) and len(directions) == hard_negatives.REFERENCES
    held, norms = hard_negatives.angles(x, directions), np.linalg.norm(x, axis=1)
    outside = 0
    for a in (7, 100, 900):
        low, high = hard_negatives.bounds(norms, held, norms[a], held[a])
        score = x @ x[a]
        assert (low <= score).all() and (score <= high).all()
        outside += int((high < 0.9 * score.max()).sum())
    assert outside > 1500   # the filter leaves rows out


def test_topk_keeps_large_vectors_over_several_shards(spark, monkeypatch):
    monkeypatch.setattr(topk_impact, "SHARD_ROWS", 60)
    monkeypatch.setattr(topk_impact, "QUERY_ROWS", 3)
    rng = np.random.default_rng(9)
    rows = [(i, rng.normal(size=4).tolist()) for i in range(150)]
    rows += [(200 + i, (rng.normal(size=4) * 2.0 ** 24).tolist()) for i in range(40)] + [(300, [1e7, 0.0, 0.0, 1.0]), (350, [2.0 ** 31, 1.0, -1.0, 3.0])]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    whole = [(i, [math.floor(256 * v) for v in e]) for i, e in rows]
    want = []
    for i, e in whole:
        if i % 50 == 0:
            near = sorted((-sum(a * b for a, b in zip(e, f)), j) for j, f in whole if j != i)[:5]
            want += [(i, n + 1, j, min(-s, 2 ** 63 - 1)) for n, (s, j) in enumerate(near)]
    got = topk_impact.top_k(df, F.col("vec_id") % 50 == 0).collect()
    assert sorted((r.query_id, r["rank"], r.vec_id, r.score) for r in got) == sorted(want)


# --- whitening ----------------------------------------------------------------------------------------------------

def test_rank_one_updates_with_deflation():
    rng = np.random.default_rng(1)
    for d, updates in ((1, 3), (2, 5), (7, 40)):
        values, vectors, want = np.zeros(d), np.eye(d), np.zeros((d, d))
        for i in range(updates):
            v = rng.normal(size=d) * 10.0 ** rng.integers(-6, 4)
            if i % 3 == 0:
                v[1:] = 0                      # touches one eigenvector: the rest deflates
            if i % 5 == 4:
                v = np.full(d, 2.0)            # equal updates, equal eigenvalues
            values, vectors = whitening.rank_one(values, vectors, v)
            want += np.outer(v, v)
        assert np.allclose(vectors.T @ vectors, np.eye(d), atol=1e-12)
        assert np.abs(vectors * values @ vectors.T - want).max() <= 1e-12 * np.abs(want).max()


def test_spectrum_of_blocks_and_merges():
    rng = np.random.default_rng(2)
    x = rng.normal(size=(300, 12)) * np.linspace(0, 9, 12) + 50
    x[100:200] = x[100]
    parts = []
    for block in np.array_split(x, 4):
        s = whitening.Spectrum(12)
        for b in np.array_split(block, 3):
            s.add(b)
        parts.append(s)
    whole = parts[0]
    for s in parts[1:]:
        whole.merge(s)
    c = x - x.mean(axis=0)
    assert whole.n == 300 and np.allclose(whole.mean, x.mean(axis=0))
    assert np.abs(whole.vectors * whole.values @ whole.vectors.T - c.T @ c).max() < 1e-10 * np.trace(c.T @ c)


def _whitened_by_hand(rows, components=8):
    x = [[math.floor(1024 * v) + 100000 for v in e] for _, e in rows]
    n, d = len(x), len(x[0])
    s = [sum(r[i] for r in x) for i in range(d)]
    centred = np.array([[(n * a - b) / n for a, b in zip(r, s)] for r in x])
    e, vec = np.linalg.eigh(centred.T @ centred / n)
    e, vec = e[::-1], vec[:, ::-1]
    out = {}
    for (i, _), r, c in zip(rows, x, centred):
        dev = sum((n * a - b) ** 2 for a, b in zip(r, s))
        out[i] = (dev, [float(c @ vec[:, k] / math.sqrt(e[k])) for k in range(min(components, d))])
    return out, e / e.sum()


def test_whitening_against_eigh(spark):
    rng = np.random.default_rng(3)
    rows = [(i, (rng.normal(size=10) * np.linspace(0.2, 2, 10)).tolist()) for i in range(400)]
    rows += [(1000 + i, rows[0][1]) for i in range(100)]                                          # one vector, many rows
    bad = [(2000, None), (2001, [None] * 10), (2002, [math.nan] * 10), (2003, [math.inf] + [1.0] * 9), (2004, [])]
    df = spark.createDataFrame([(i, 1, e, "clash", 1, 2) for i, e in rows + bad], VECTORS).repartition(40)
    got = whitening.whiten(df).collect()
    want, share = _whitened_by_hand(rows)
    assert len(got) == 8 * len(rows) and {r.n for r in got} == {len(rows)}
    sign = {}
    for r in got:
        dev, values = want[r.vec_id]
        value = values[r.component - 1]
        assert r.deviation == dev and abs(r.explained - share[r.component - 1]) < 1e-9 and r.identity_error < 1e-9
        if abs(value) > 0.1:
            sign.setdefault(r.component, math.copysign(1, value * r.whitened))
    assert all(abs(r.whitened * sign[r.component] - want[r.vec_id][1][r.component - 1]) < 1e-7 for r in got)


def test_whitening_edges(spark):
    make = lambda rows: spark.createDataFrame([(i, 1, e, "clash", 1, 2) for i, e in rows], VECTORS)
    assert whitening.whiten(make([(1, None)]).filter("vec_id > 5")).collect() == []
    one = whitening.whiten(make([(1, [0.5, 1.0]), (None, [0.5, 1.0])])).collect()    # no variance at all
    assert [(r.vec_id, r.n, r.deviation, r.whitened, r.explained, r.identity_error) for r in sorted(one, key=repr)] == \
        [(1, 2, 0, None, 0.0, None)] * 2 + [(None, 2, 0, None, 0.0, None)] * 2
    two = whitening.whiten(make([(1, [1.0, 2.0]), (2, [3.0, 2.0]), (3, [1.0, 2.0, 3.0]), (4, [2.0, 2.0, 3.0]), (5, [1e18, -1e18, 0.0])])).collect()
    by = {(r.vec_id, r.component): r for r in two}
    assert by[1, 1].n == 2 and by[3, 1].n == 3 and abs(abs(by[1, 1].whitened) - 1) < 1e-12 and by[1, 2].whitened is None
    assert by[5, 1].deviation is None and len(two) == 4 + 9


def test_cells_give_what_single_rows_give():
    """Cells of rows (scores in one product) against rows bounded one by one, with ties, repeated rows and all labels."""
    import numpy as np
    import pandas as pd

    from oddsframe.llm import hard_negatives as HN
    rng = np.random.default_rng(5)
    x = np.floor(rng.normal(size=(900, 6)) * 3 + np.repeat(rng.normal(size=(9, 6)) * 6, 100, axis=0))
    x[7] = 0
    x[50:60] = x[40]
    refs = HN.references(x.tolist(), 5)[6]
    rows = pd.DataFrame({"vec_id": np.r_[np.arange(899), 5], "label": rng.integers(0, 3, 900).astype(str), "x": list(x),
                         "norm": np.linalg.norm(x, axis=1), "angles": list(HN.angles(x, refs))})
    anchors = rows.iloc[::30].assign(anchor_key=np.arange(30))
    shard, old = HN.Shard(rows), HN.CELL_ROWS
    HN.CELL_ROWS = 16
    try:
        got = HN._positives(4)(rows, anchors)
        want = [(a.anchor_key, i, str(s)) for a in anchors.itertuples() for i, s in shard.positives(a, 4)]
        assert list(got.itertuples(index=False, name=None)) == want
        anchors["positives"] = [[{"score": s} for k, _, s in want if k == key] for key in anchors["anchor_key"]]
        got = HN._negatives(3, 50, 95)(rows, anchors)
        want = [(a.anchor_key, n, i, str(s)) for a in anchors.itertuples()
                for n, hits in enumerate(shard.negatives(a, HN._windows([p["score"] for p in a.positives], 50, 95), 3)) for i, s in hits]
        assert want and list(got.itertuples(index=False, name=None)) == want
    finally:
        HN.CELL_ROWS = old
    cells = HN.Cells(rows)
    assert all(len(set(rows.label[rows.vec_id.isin(cells.ids[a:b])])) >= 1 and b - a <= old for a, b in zip(cells.starts, cells.ends))

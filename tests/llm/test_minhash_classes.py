"""Classes of near copies against all pairs: hot groups, chains, split blocks, odd rows."""

import random
from collections import defaultdict

import pytest
from pyspark.sql import functions as F

from oddsframe.llm import minhash
from oddsframe.llm.common import ship_package


def _classes(rows):
    """Brute force over all pairs of rows (doc_id, text)."""
    sets = [set(map(int, minhash.shingles(t or "", minhash._WordHash()))) for _, t in rows]
    root = list(range(len(rows)))

    def find(i):
        while root[i] != i:
            root[i] = root[root[i]]
            i = root[i]
        return i

    for i in range(len(rows)):
        for j in range(i):
            both = len(sets[i] & sets[j])
            if find(i) != find(j) and both >= 0.8 * (len(sets[i]) + len(sets[j]) - both):
                root[find(i)] = find(j)
    least = defaultdict(list)
    for i, (doc_id, _) in enumerate(rows):
        if doc_id is not None:
            least[find(i)].append(doc_id)
    return sorted(((d, min(least[find(i)], default=None)) for i, (d, _) in enumerate(rows)), key=str)


def _rows():
    rng = random.Random(5)
    words = [f"w{i}" for i in range(400)]
    base = rng.choices(words, k=120)
    texts = []
    for _ in range(70):  # copies of one text, many of which are alike only through others
        c = list(base)
        for at in rng.sample(range(120), rng.randrange(1, 5)):
            c[at] = f"e{rng.randrange(1000)}"
        texts.append(" ".join(c))
    chain = rng.choices(words, k=120)
    for i in range(0, 60, 2):  # a chain: neighbours alike, ends not
        chain[i] = f"c{i}"
        texts.append(" ".join(chain))
    texts += texts[:1] * 40 + ["", None, " \t", "short", "short"] + [" ".join(rng.choices(words, k=60)) for _ in range(20)]
    rng.shuffle(texts)
    return [(None if i % 17 == 0 else i // 2 if i % 5 == 0 else i, t) for i, t in enumerate(texts)]


@pytest.mark.parametrize("group,met", [(256, 4096), (3, 5)])
def test_classes_against_all_pairs(spark, monkeypatch, group, met):
    ship_package(spark)
    monkeypatch.setattr(minhash, "GROUP", group)
    monkeypatch.setattr(minhash, "MET", met)
    rows = _rows()
    df = spark.createDataFrame([(i, t, 1, 2) for i, t in rows], "doc_id long, text string, node int, class_id int").repartition(3)
    got = minhash.near_duplicates(df)
    assert got.columns == ["doc_id", "class_id"]
    assert sorted(((r.doc_id, r.class_id) for r in got.collect()), key=str) == _classes(rows)


def test_classes_of_one_hot_band(spark, monkeypatch):
    """All texts in one group whatever their words: only the comparisons decide."""
    ship_package(spark)
    monkeypatch.setattr(minhash, "GROUP", 4)
    rows = _rows()[:120]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    texts = minhash._noded(docs)
    signed = texts.select("doc_id", "node", F.lit("0" * 256).alias("fingerprint"))
    got = texts.join(minhash.classes(texts.select("node", "text"), signed), "node").select("doc_id", "class_id").collect()
    assert sorted(((r.doc_id, r.class_id) for r in got), key=str) == _classes(rows)


def test_classes_reach_the_rows_of_the_query(spark):
    ship_package(spark)
    rows = [r for r in _rows() if r[0] is not None]
    got = minhash.edited_fingerprints(spark.createDataFrame(rows, "doc_id long, text string")).select("doc_id", "class_id").collect()
    assert sorted(((r.doc_id, r.class_id) for r in got), key=str) == _classes(rows)
    empty = spark.createDataFrame([], "doc_id long, text string")
    assert minhash.near_duplicates(empty).count() == 0 and minhash.edited_fingerprints(empty).count() == 0

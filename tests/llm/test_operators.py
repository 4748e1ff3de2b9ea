"""Every corpus operator on small frames with nulls, empty and long texts, ties, repeated rows, empty tables and
clashing extra columns, against brute force, exact round trips or the libraries themselves."""

import base64
import hashlib
import math
import random
import zlib
from collections import defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

from oddsframe.llm import (components, html_wrappers, minhash, packing, quality_pu, sentencepiece_sa, simhash_bktree,
                           token_counts, topk_impact, toxicity_knn, warc)
from oddsframe.llm.common import ship_package, tokenizer_file

BYTE, WORD, PIECE = map(tokenizer_file, ("byte_bpe_50k.json", "word_bpe_49k.json", "piece_bpe_32k.model"))

ODD = ["", None, "a", "  two  spaces\n\n and\ttabs   nbsp ", "end <|endoftext|> in text<|endoftext|>", "Größe ÉTÉ ñandú ß İ Σς",
       "don't WE'LL it's 's 12,345.67 ***!! a.b,c", "日本語のテキスト。 漢字", "▁mark ▁▁two", "emoji 👩‍👩‍👧 é İ",
       "word " * 3000, "x" * 5000, " lead", "trail ", "tab\x1cfs\x85nel ls", "same text twice", "same text twice"]
DOCS = "doc_id long, text string, fingerprint string, score int, key long"


@pytest.fixture(scope="module")
def docs(spark):
    ship_package(spark)
    rows = [(i if i != 3 else None, t, "clash", 1, 2) for i, t in enumerate(ODD)] + [(1, "again", "x", 0, 0), (1, "again", "x", 0, 0)]
    return spark.createDataFrame(rows, DOCS)


@pytest.fixture(scope="module")
def none(spark):
    return spark.createDataFrame([], DOCS)


def _texts(docs):
    return [(r.doc_id, r.text or "") for r in docs.collect()]


def test_components_against_union_find(spark):
    rng = random.Random(5)
    pairs = [(rng.randrange(200), rng.randrange(200)) for _ in range(150)] + [(500, i) for i in range(300, 420)] + [(7, 7)]
    root = {}

    def find(x):
        root.setdefault(x, x)
        while root[x] != x:
            x = root[x]
        return x

    for a, b in pairs:
        a, b = find(a), find(b)
        root[max(a, b)] = min(a, b)
    want = {x: find(x) for x in root if find(x) != x}
    got = components.connected_components(spark.createDataFrame(pairs, "u long, v long")).collect()
    assert {r.node: r.root for r in got} == want and len(got) == len(want)
    assert components.connected_components(spark.createDataFrame([], "u long, v long")).count() == 0


def test_simhash_against_pairs(spark, docs, none):
    base = [f"w{i}" for i in range(60)]
    rng = random.Random(1)
    rows = [(100 + i, " ".join(base[:j] + [f"z{rng.randrange(9)}"] + base[j:])) for i, j in enumerate(rng.choices(range(60), k=80))]
    more = spark.createDataFrame([(i, t) for i, t in rows] + [(i, t) for i, t in _texts(docs)], "doc_id long, text string")
    got = simhash_bktree.near_duplicates(more).collect()
    fps = sorted({int(r.fingerprint, 16) for r in got})
    root = {x: x for x in fps}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for i, a in enumerate(fps):
        for b in fps[:i]:
            if (a ^ b).bit_count() <= 3:
                root[find(a)] = find(b)
    ids = defaultdict(set)
    for r in got:
        ids[find(int(r.fingerprint, 16))].add(r.doc_id)
    assert len(got) == more.count()
    assert all(r.component_id == min((x for x in ids[find(int(r.fingerprint, 16))] if x is not None), default=None) for r in got)
    assert simhash_bktree.near_duplicates(none).count() == 0
    assert simhash_bktree.simhash("") == simhash_bktree.simhash(" \t\n") == 0
    kept = simhash_bktree.representatives(docs)
    assert kept.columns == docs.columns
    assert sorted(r.doc_id for r in kept.filter("doc_id is not null").collect()) == sorted(
        {r.component_id for r in simhash_bktree.near_duplicates(docs).collect() if r.doc_id is not None})


def test_representatives_of_null_and_repeated_ids(spark):
    a, b = ("one clean text about rivers and hills", "quite another text on ships and the sea")
    rows = ([(None, a)] * 5 + [(None, b)] * 4 + [(9, b)]  # b has a named row, a has none
            + [(5, "first of two texts that share an id"), (5, "second text of that very same id here"),
               (9, "second text of that very same id here"), (None, None), (7, "")])
    df = spark.createDataFrame([(i, t, n) for n, (i, t) in enumerate(rows)], "doc_id long, text string, n int").repartition(3)
    kept = simhash_bktree.representatives(df)
    assert kept.columns == df.columns
    assert sorted((r.doc_id or -1, r.text or "") for r in kept.collect()) == sorted(
        [(-1, a), (9, b), (5, rows[10][1]), (5, rows[11][1]), (7, "")])


def test_simhash_split_trees_keep_all_links(spark):
    center = 0x0123456789ABCDEF
    fps = sorted({center ^ (1 << a) ^ (1 << b) for a in range(64) for b in range(a)})[:900]
    nodes = spark.createDataFrame([(x - (1 << 64) if x >> 63 else x,) for x in fps], "fp long")
    roots = components.connected_components(simhash_bktree.links(nodes, 3, tree_size=16)).collect()
    assert len(roots) == len(fps) - 1 and len({r.root for r in roots}) == 1


def test_token_counts_against_library(docs, none):
    from tokenizers import Tokenizer
    tok = Tokenizer.from_file(BYTE)
    want = sorted(((i, len(t.encode()), len(tok.encode(t, add_special_tokens=False).ids)) for i, t in _texts(docs)), key=str)
    got = token_counts.token_counts(docs, BYTE).collect()
    assert sorted(((r.doc_id, r.n_bytes, r.n_tokens) for r in got), key=str) == want
    assert all(r.over_limit == (r.n_tokens > 1024) for r in got)
    assert token_counts.token_counts(none, BYTE).count() == 0


def test_packing_round_trip(docs, none):
    from tokenizers import Tokenizer
    tok = Tokenizer.from_file(WORD)
    want = defaultdict(list)
    for i, t in _texts(docs):
        want[i].append(tok.encode(t, add_special_tokens=False).ids + [2])
    rows = packing.pack(docs, WORD, end_id=2, width=256).collect()
    sums, place = defaultdict(int), defaultdict(list)
    for r in rows:
        assert any(r.ids == d[r.start:r.start + r.length] and len(d) == r.doc_tokens for d in want[r.doc_id])
        assert r.ids_crc32 == zlib.crc32(np.array(r.ids, dtype="<u4").tobytes())
        sums[r.doc_id] += r.length
        place[r.sequence_id].append((r.offset, r.length))
    assert sums == {i: sum(map(len, d)) for i, d in want.items()}
    for pieces in place.values():
        at = 0
        for offset, length in sorted(pieces):
            assert offset == at
            at += length
        assert at <= 256
    assert packing.pack(none, WORD, end_id=2).count() == 0


def test_packing_special_strings_in_any_case():
    from tokenizers import Tokenizer
    tok = Tokenizer.from_file(WORD)
    texts = ["A <|ENDOFTEXT|> b", "<|EndOfText|>", "x<|StartOfText|>Y Z", "<|startoftext|><|STARTOFTEXT|>", "Plain Text <| |>"]
    ids, tokens, _ = packing.tokenise(texts, packing._Words(WORD, 2))
    want = [tok.encode(t, add_special_tokens=False).ids + [2] for t in texts]
    assert ids.tolist() == sum(want, []) and tokens.tolist() == list(map(len, want))


def test_packing_cuts_are_optimal():
    rng = np.random.default_rng(2)
    for _ in range(30):
        total = int(rng.integers(1, 600))
        ends = np.unique(rng.integers(1, total + 1, 12))
        at, cost = packing.candidate_cuts(total, np.append(ends, total), ends[:0], width=64, stretch=16)
        f = {0: 0}
        for p, c in zip(at.tolist()[1:], cost.tolist()[1:]):
            f[p] = min(f[q] + (0 if (n := p - q) >= packing.SHORTEST and n & (n - 1) == 0 else 64 - n) + c + packing.WINDOW_COST
                       for q in at.tolist() if q in f and q < p <= q + 64)
        got, price = packing.best_cuts(at, cost, 64), 0
        for a, b in zip([0] + got, got):
            price += (0 if b - a == 64 else 64 - (b - a)) + int(cost[np.searchsorted(at, b)]) + packing.WINDOW_COST
        assert price == f[total] and got[-1] == total


def test_sentencepiece_against_library(docs, none):
    import sentencepiece
    sp = sentencepiece.SentencePieceProcessor(model_file=PIECE)
    got = sentencepiece_sa.encode(docs, PIECE)
    rows = got.collect()
    assert sorted(((r.doc_id, tuple(r.ids)) for r in rows), key=str) == sorted(((i, tuple(sp.encode(t))) for i, t in _texts(docs)), key=str)
    back = {r.doc_id: r.text for r in sentencepiece_sa.decode(got.filter("doc_id > 4"), PIECE).collect()}
    assert all(back[r.doc_id] == sp.decode(list(r.ids)) for r in rows if r.doc_id is not None and r.doc_id > 4)
    assert sentencepiece_sa.encode(none, PIECE).count() == 0


def test_minhash_rows(spark, docs, none):
    def check(df):
        rows = _texts(df)
        ids = sorted({i for i, _ in rows if i is not None}, reverse=True)
        after = dict(zip(ids, ids[1:] + ids[:1])) | {None: ids[0]}
        first = {i: min(t for j, t in rows if j == i) for i in ids}
        want = sorted(((i, len(t), hashlib.sha256(minhash.edited(t, first[after[i]]).encode()).hexdigest()) for i, t in rows), key=str)
        got = minhash.edited_fingerprints(df).collect()
        assert sorted(((r.doc_id, r.n_chars, r.edited_sha256) for r in got), key=str) == want
        by_text = defaultdict(set)
        for r in got:
            by_text[dict(rows).get(r.doc_id) if r.doc_id != 1 else r.fingerprint].add(r.fingerprint)
        assert all(len(v) == 1 for v in by_text.values())
        assert all(0 <= r.near_edited <= 1 and 0 <= r.near_next <= 1 for r in got)

    check(docs)
    shuffled = [(i, f"text number {i} " * (i % 7)) for i in random.Random(3).sample(range(1000), 300)]
    check(spark.createDataFrame(shuffled, "doc_id long, text string").repartition(5))
    assert minhash.edited_fingerprints(none).count() == 0


def test_minhash_near_duplicates_against_jaccard(spark):
    rng = random.Random(8)
    words = [f"w{i}" for i in range(500)]
    base = [rng.choices(words, k=80) for _ in range(12)]
    texts = [" ".join(b) for b in base]
    for b in base[:6]:
        for _ in range(8):
            c = list(b)
            c[rng.randrange(80)] = "edit"
            texts.append(" ".join(c))
    texts += texts[:3] + ["", "short"]
    sets = [set(map(int, minhash.shingles(t, minhash._WordHash()))) for t in texts]
    root = list(range(len(texts)))

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    for i in range(len(texts)):
        for j in range(i):
            u = len(sets[i] | sets[j])
            if texts[i] == texts[j] or u and len(sets[i] & sets[j]) >= 0.8 * u:
                root[find(i)] = find(j)
    low = defaultdict(lambda: 10 ** 9)
    for i in range(len(texts)):
        low[find(i)] = min(low[find(i)], i)
    got = minhash.near_duplicates(spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")).collect()
    assert {r.doc_id: r.class_id for r in got} == {i: low[find(i)] for i in range(len(texts))}


def test_warc_round_trip(spark, none):
    ship_package(spark)
    trap = "WARC/1.1\r\nWARC-Type: response\r\nWARC-Record-ID: <urn:page:99>\r\nContent-Length: 4\r\n\r\nfake\r\n\r\n"
    pages = [(1, "http://a/", "<p>x</p>", "c"), (2, None, "<p>x</p>", "c"), (3, "http://b/\r\nX: y", trap + trap, "c"), (4, "u", None, "c"),
             (5, "u", "", "c"), (None, "u", "é漢", "c"), (7, "u", "long " * 50000, "c"), (7, "u", "long " * 50000, "c"), (8, "u", trap, "c")]
    got = warc.round_trip(spark.createDataFrame(pages, "page_id long, url string, html string, offset string")).collect()
    assert len(got) == len(pages) and all(r.intact for r in got)
    by_id = defaultdict(list)
    for r in got:
        by_id[r.page_id].append(r)
    for i, _, html, _ in pages:
        raw = (html or "").encode()
        for r in by_id[i]:
            assert (r.payload_bytes, r.payload_digest) == (len(raw), base64.b32encode(hashlib.sha1(raw).digest()).decode())
    kinds = {i: {(r.record_type, r.refers_to) for r in rows} for i, rows in by_id.items()}
    assert kinds[1] == {("revisit", 2)} and kinds[2] == {("response", None)}
    assert kinds[4] == {("revisit", 5)} and kinds[5] == kinds[7] == kinds[None] == {("response", None)}
    assert warc.round_trip(spark.createDataFrame([], "page_id long, url string, html string")).count() == 0


def test_warc_pointer_jumping():
    offsets = np.array([0, 10, 15, 30, 45])
    assert warc.reachable(offsets, np.array([10, 30, 99, 45, 60])).tolist() == [True, True, False, True, True]
    assert warc.reachable(np.array([5]), np.array([9])).tolist() == [False]


def test_topk_against_brute_force(spark):
    ship_package(spark)
    rng = np.random.default_rng(4)
    vecs = [(i, rng.normal(size=8).round(2).tolist()) for i in range(400)]
    vecs += [(400 + i, vecs[3][1]) for i in range(30)] + [(500, None), (501, [1.0, None] * 4), (502, [math.nan] * 8), (503, []),
                                                         (550, [0.0] * 8), (None, [1.0] * 8), (504, [1.0, 2.0]), (600, [1.0, 2.0])]
    df = spark.createDataFrame([(i, v, 0) for i, v in vecs], "vec_id long, embedding array<double>, score int")
    good = [(i, np.floor(256 * np.array(v)).astype(int)) for i, v in vecs
            if i is not None and v and all(x is not None and math.isfinite(x) for x in v)]
    want = []
    for q, x in good:
        if q % 50 == 0:
            near = sorted((-int(x @ y), i) for i, y in good if i != q and len(y) == len(x))[:5]
            want += [(q, n + 1, i, -s) for n, (s, i) in enumerate(near)]
    got = topk_impact.top_k(df, F.col("vec_id") % 50 == 0).collect()
    assert sorted((r.query_id, r["rank"], r.vec_id, r.score) for r in got) == sorted(want)
    assert topk_impact.top_k(df.limit(0), F.col("vec_id") % 50 == 0).count() == 0


def test_html_main_text(spark):
    ship_package(spark)
    def page(title, body, comments=""):
        return (f"<html><head><title>t</title><script>var a='<p>no</p>';</script></head><body><header>Site</header><nav><ul><li><a>m</a></li>"
                f"<li><a>n</a></li></ul></nav><div class='ad'>Buy {title}</div><article><h1>{title}</h1>{body}<div class='share-buttons'>Share</div>"
                f"<section id='comments'>{comments}</section></article><aside>side</aside><form>f</form><footer>&copy; x</footer></body></html>")
    pages = [(1, "http://h.example/1", page("One &amp; two", "<p>a <b>b</b>c&nbsp;d<br>e", "<p>me first</p>"), "x"),
             (2, "http://h.example/2", page("Two", "<p>x</p>\n<p> y  z </p><ul><li>i<li>j</ul>"), "x"),
             (3, None, None, "x"), (4, "not a url", "", "x"), (5, "http://k/", "plain &lt; text <b", "x"), (None, "http://h.example/3", page("T", ""), "x"),
             (6, "http://u/", "<body><div class=nav>menu</div><div><p>Long text here.</p><p>More of it.</p></div><div class='footer'>f</div>", "x")]
    got = {r.page_id: r for r in html_wrappers.main_text(spark.createDataFrame(pages, "page_id long, url string, html string, text string")).collect()}
    assert {i: r.text for i, r in got.items()} == {1: "One & two a bc d e", 2: "Two x y z i j", 3: "", 4: "", 5: "plain < text", None: "T",
                                                   6: "Long text here. More of it."}
    assert all(r.n_chars == len(r.text) for r in got.values())
    assert html_wrappers.main_text(spark.createDataFrame([], "page_id long, url string, html string")).count() == 0


def test_names_never_drop_the_main_group():
    text = "Long text of the page that must stay."
    for body in (f"<body class='right-sidebar'><article class='post comments-open'><p>{text}</p></article></body>",
                 f"<body class='search'><p>{text}</p></body>", f"<body><main id='search'><p>{text}</p></main></body>",
                 f"<body class='fixed topbar'><div class='content with-sidebar'><p>{text}</p></div></body>",
                 f"<body><div id='widget'><article><p>{text}</p></article></div></body>",
                 f"<body><div><p>{text}</p></div><div class='sidebar'>side</div><div id='comments'><article>me</article></div></body>"):
        assert html_wrappers.extract(body, None) == text


def _host(*pages):
    whole = None
    for p in pages:
        own = html_wrappers.fold(html_wrappers.parse(p))
        whole = own if whole is None else html_wrappers.align(whole, own)
    paths = html_wrappers.main_paths(whole)
    return [html_wrappers.extract(p, paths) for p in pages]


def test_wrapper_keeps_all_blocks_of_text():
    said = [f"{w} one {w}" for w in ("red", "green", "blue", "grey")]
    same = "<header>Site</header><div class='claim'>The same on all pages of this host</div>"
    split = [f"<body>{same}<div class='intro'>{w} intro text</div><div class='text'><p>{w}</p><p>rest {w}</p></div></body>" for w in said]
    assert _host(*split) == [f"{w} intro text {w} rest {w}" for w in said]
    marked = [f"<body><article class='lead'>{w} lead</article><article class='more'>{w} rest of it</article></body>" for w in said]
    assert _host(*marked) == [f"{w} lead {w} rest of it" for w in said]
    other = "<body><article></article><div>All of the text stands in another group.</div></body>"
    short = "<body><article>Hm</article><div>All of the text stands in another group.</div></body>"
    full = [f"<body><article>{w} and so on and on and on and on and on and on</article></body>" for w in said]
    got = _host(*full, other, short)
    assert got[4:] == ["All of the text stands in another group.", "Hm All of the text stands in another group."]
    assert got[:4] == [f"{w} and so on and on and on and on and on and on" for w in said]


def test_wrapper_expression():
    one = html_wrappers.fold(html_wrappers.parse("<ul><li>a<li>b</ul><p>same</p>"))
    two = html_wrappers.fold(html_wrappers.parse("<ul><li>a</ul><h2>t</h2><p>same</p>"))
    assert html_wrappers.expression(html_wrappers.align(one, two)) == "<ul>(<li>#text</>)+</>(<h2>text</>)?<p>text</>"


def test_nearest_examples_are_exact():
    rng = np.random.default_rng(0)
    model = toxicity_knn.Model(number={str(i): i for i in range(40)}, idf=rng.uniform(1, 5, 40))
    vectors = sorted({tuple(sorted(rng.choice(40, rng.integers(1, 9), replace=False).tolist())) for _ in range(400)})
    toxicity_knn._index(model, [((v, tuple(rng.integers(1, 4, len(v)).tolist())), i, 1, i % 2) for i, v in enumerate(vectors)])
    dense = np.zeros((len(model.rows), 40))
    for t in range(40):
        a, b = model.edge[t, 0], model.edge[t, -1]
        dense[model.example[a:b], t] = model.weight[a:b]
    for _ in range(50):
        t, w = model.vector({int(x): 1 for x in rng.choice(40, 5, replace=False)})
        best, cosine = model.nearest(t, w, 7)
        exact = np.sort(dense[:, t] @ w)[::-1][:7]
        assert np.allclose(cosine, exact[exact > 0]) and np.allclose(dense[best][:, t] @ w, cosine)


def _corpus(spark):
    rng = random.Random(2)
    plain = ["".join(rng.choices("abcdefgh", k=rng.randint(2, 7))) for _ in range(400)]
    rows, labels = [], []
    for i in range(400):
        w = rng.choices(plain, k=60)
        toxic, junk = i % 5 == 0, i % 4 == 1
        if toxic:
            w[10], w[30] = "vilex" + rng.choice(["", "ing", "ed"]), "vilexen"
        if junk:
            w = [x.upper() + "!!" for x in w]
        rows.append((i, " ".join(w) + ".", "s", 0.5))
        if i % 2 == 0 or i % 3 == 0:
            labels.append((i, 0 if junk else 1, int(toxic), "clash"))
    rows += [(400, None, "s", 0.1), (401, "", "s", 0.1), (None, "a b c", "s", 0.1), (5, rows[5][1], "s", 0.5)]
    labels += [(None, 1, 1, "x"), (7, None, None, "x")]
    return (spark.createDataFrame(rows, "doc_id long, text string, source string, score double"),
            spark.createDataFrame(labels, "doc_id long, quality int, toxic int, text string"))


def test_classifiers(spark):
    ship_package(spark)
    docs, labels = _corpus(spark)
    tox = toxicity_knn.score(docs, toxicity_knn.fit(docs, labels.filter("doc_id % 7 <> 0"))).collect()
    assert len(tox) == docs.count() and all(0 <= r._toxicity.score <= 1 for r in tox)
    held = [r for r in tox if r.doc_id is not None and r.doc_id < 400 and r.doc_id % 7 == 0]
    assert all((r._toxicity.score >= 0.7) == (r.doc_id % 5 == 0) for r in held)
    assert all(r._toxicity.evidence for r in held if r.doc_id % 5 == 0)
    good = quality_pu.score(docs, quality_pu.fit(docs, labels.filter("doc_id % 7 <> 0"))).collect()
    assert len(good) == docs.count() and all(0 <= r._quality <= 1 for r in good)
    held = [r for r in good if r.doc_id is not None and r.doc_id < 400 and r.doc_id % 7 == 0]
    assert np.mean([(r._quality >= 0.3) == (r.doc_id % 4 != 1) for r in held]) >= 0.95
    for empty in (labels.limit(0), labels.filter("doc_id = 7")):
        assert toxicity_knn.score(docs, toxicity_knn.fit(docs, empty)).filter("_toxicity.score <> 0").count() == 0
        assert quality_pu.score(docs, quality_pu.fit(docs, empty)).filter("_quality <> 0.5").count() == 0
    assert toxicity_knn.score(docs.limit(0), toxicity_knn.fit(docs.limit(0), labels)).count() == 0
    assert quality_pu.score(docs.limit(0), quality_pu.fit(docs.limit(0), labels)).count() == 0


def test_quality_reads_all_unlabelled_rows(spark):
    docs, labels = _corpus(spark)
    train = labels.filter("doc_id % 7 <> 0")
    rows = docs.select("doc_id", "text")
    # rows without an id all count, and a trusted id's rows weigh as one
    nameless = spark.createDataFrame([(None, "zz 99 ## !! " * 9)], "doc_id long, text string").crossJoin(spark.range(300)).drop("id")
    plain, more = quality_pu.fit(rows, train, 50), quality_pu.fit(rows.unionByName(nameless), train, 50)
    n, m = rows.count(), rows.count() + 300
    mark = quality_pu.features("zz 99 ## !! " * 9)
    sums = [quality_pu.features(r.text or "").astype(float) for r in rows.collect()]
    share = lambda mean, size, total: 2 * mean - total / size
    positives = share(plain.mean, n, np.sum(sums, axis=0))
    assert np.allclose(share(more.mean, m, np.sum(sums, axis=0) + 300 * mark.astype(float)), positives, atol=1e-6)
    assert more.prior < plain.prior
    one = train.filter("quality = 1").first().doc_id
    again = rows.filter(F.col("doc_id") == one).crossJoin(spark.range(200)).drop("id")
    twice = quality_pu.fit(rows.unionByName(again), train, 50)
    x = np.sum(sums, axis=0) + 200 * quality_pu.features(rows.filter(F.col("doc_id") == one).first().text or "").astype(float)
    assert np.allclose(share(twice.mean, n + 200, x), positives, atol=1e-6)


def test_histogram_prior_is_near_the_exact_one():
    rng = np.random.default_rng(3)
    p, u = rng.normal(2, 1, 3000), np.concatenate((rng.normal(2, 1, 2000), rng.normal(-2, 1, 3000)))
    bins = lambda z: np.histogram(z, 20_000, (-50, 50))[0].astype(float)
    assert abs(quality_pu.histogram_prior(bins(p), bins(u)) - quality_pu.class_prior(p, u)) < 0.005


def test_class_prior():
    rng = np.random.default_rng(1)
    p, n = rng.normal(2, 1, 8000), rng.normal(-2, 1, 8000)
    for share in (0.3, 0.7):
        u = np.concatenate((rng.normal(2, 1, int(8000 * share)), n[:int(8000 * (1 - share))]))
        assert abs(quality_pu.class_prior(p, u) - share) < 0.06

import collections

import numpy as np
import duckdb
import pytest

from siftworks.llm import near_dedup as nd
from siftworks.llm import topk_search
from tests.compare import connect, difference
from tests.llm.rows import SF, TEXTS, documents, given, tokens


def shingle_set(text):
    w = tokens(text)
    if len(w) < 5:
        return {tuple(w)} if w else set()
    return {tuple(w[i : i + 5]) for i in range(len(w) - 4)}


def brute_classes(docs):
    """class of each row: all pairs that share a shingle, united at 0.8."""
    sets = [shingle_set(t) for _, t in docs]
    holders = collections.defaultdict(list)
    for i, s in enumerate(sets):
        for g in s or {None}:
            holders[g].append(i)
    parent = list(range(len(docs)))

    def find(i):
        while parent[i] != i:
            parent[i] = parent[parent[i]]
            i = parent[i]
        return i

    for rows in holders.values():
        for x in range(len(rows)):
            for y in range(x):
                i, j = rows[x], rows[y]
                if find(i) != find(j) and len(sets[i] & sets[j]) >= 0.8 * len(sets[i] | sets[j]):
                    parent[find(i)] = find(j)
    smallest = {}
    for i, (d, _) in enumerate(docs):
        r = find(i)
        if d is not None:
            smallest[r] = min(smallest.get(r, d), d)
    return collections.Counter((d, smallest.get(find(i))) for i, (d, _) in enumerate(docs))


def got_classes(df):
    return collections.Counter(map(tuple, df.collect()))


def test_components_agree_with_the_probability_jaccard():
    rng = np.random.default_rng(3)
    common, a, b = (rng.integers(1, 2**62, n).astype(np.uint64) for n in (300, 60, 40))
    weights = rng.uniform(0.5, 4.0, 400)
    x, y = np.sort(np.concatenate([common, a])), np.sort(np.concatenate([common, b]))
    weight = dict(zip(np.concatenate([common, a, b]).tolist(), weights.tolist(), strict=True))
    wx, wy = (np.array([weight[e] for e in s.tolist()]) for s in (x, y))
    signature = nd.prob_min_hash(np.repeat([0, 1], [len(x), len(y)]), np.concatenate([x, y]), np.concatenate([wx, wy]), 2, 20_000)
    sx, sy = wx.sum(), wy.sum()
    both = [weight[e] for e in common.tolist()]
    # J_P: for each common element 1 / sum of the larger ratios.
    everything = set(x.tolist()) | set(y.tolist())
    inx, iny = set(x.tolist()), set(y.tolist())
    exact = sum(
        1
        / sum(
            max((weight[f] if f in inx else 0) / w, (weight[f] if f in iny else 0) / w) for f in everything
        )
        for w in both
    )
    assert sx > 0 and sy > 0
    assert (signature[0] == signature[1]).mean() == pytest.approx(exact, abs=0.02)


def test_one_element_fills_all_components():
    signature = nd.prob_min_hash(np.array([1]), np.array([77], np.uint64), np.array([1.0]), 3, 240)
    assert (signature[1] == 77).all() and not signature[[0, 2]].any()


def test_classes_of_the_given_documents(spark):
    docs = given(spark, sf=SF.replace("0.001", "0.01"))
    want = brute_classes([(r["doc_id"], r["text"]) for r in docs.collect()])
    assert got_classes(nd.near_dedup_digest(docs)) == want


def edited(words, at, new):
    return " ".join([*words[:at], new, *words[at + 1 :]])


def test_chains_hubs_and_awkward_documents(spark):
    rng = np.random.default_rng(5)
    words = [f"w{x}" for x in rng.integers(0, 10_000, 200)]
    texts = list(TEXTS)
    # Copies of one text, each edited elsewhere: alike to it, less so to each other.
    texts += [(1000 + i, edited(words, 3 + 9 * i % 190, f"n{i}"), "en", "a") for i in range(20)]
    texts.append((999, " ".join(words), "en", "a"))
    # A chain: each link moves the window a little, the ends have nothing in common.
    long = [f"c{x}" for x in range(900)]
    texts += [(2000 + i, " ".join(long[20 * i : 20 * i + 300]), "en", "a") for i in range(30)]
    # Alike in half of the words, no more.
    half = [f"h{x}" for x in range(100)]
    texts += [(3000 + i, " ".join(half + [f"k{i}x{j}" for j in range(100)]), "en", "a") for i in range(15)]
    out = nd.near_dedup_digest(documents(spark, texts))
    assert got_classes(out) == brute_classes([(i, t) for i, t, *_ in texts])


def test_repeated_shingles_keep_no_link_apart(spark):
    """Pairs alike as sets, one of them with a menu that repeats 10 or 100 times."""
    texts = []
    for i in range(20):
        for j, times in enumerate((10, 100)):
            shared = [f"s{i}x{j}x{k}" for k in range(100)]
            menu = [f"m{i}x{j}x{k}" for k in range(19)]
            at = 4 * i + 2 * j
            texts += [(at, " ".join(shared), "en", "a"), (at + 1, " ".join(shared + menu * times), "en", "a")]
    got = got_classes(nd.near_dedup_digest(documents(spark, texts)))
    assert got == brute_classes([(i, t) for i, t, *_ in texts])
    assert got == collections.Counter((i, i - i % 2) for i, *_ in texts)


def test_no_band_counts_twice():
    row, h = np.array([1, 1, 2, 2]), np.array([5, 9, 5, 9], np.uint64)
    hashes, keep = nd.all_bands(row, h, np.array([1, 1, 1, 50]), 3)
    assert keep.sum(axis=1)[:2].tolist() == [0, nd.BANDS] and keep[2].sum() > nd.BANDS
    assert len(np.unique(hashes[2][keep[2]])) == keep[2].sum()
    assert set(hashes[1][keep[1]]) <= set(hashes[2][keep[2]])


def test_one_document_of_each_class_stays(spark):
    docs = documents(spark)
    kept = nd.one_of_each(docs)
    assert kept.columns == docs.columns
    rows = kept.collect()
    # Id 4 has two texts, in two classes; the others without words go with id 1.
    assert sorted(r["doc_id"] for r in rows if r["doc_id"] is not None) == [1, 4, 4, 6, 7, 8, 9, 10]
    assert sum(r["doc_id"] is None for r in rows) == 1
    texts = [" ".join(x.decode() for x in tokens(r["text"])) for r in rows]
    assert len(texts) == len(set(texts))


def test_no_documents(spark):
    assert nd.near_dedup_digest(documents(spark, [])).count() == 0
    assert nd.one_of_each(documents(spark, [])).count() == 0


def test_components_of_paths_and_cycles(spark):
    edges = [(i, i + 1) for i in range(40)] + [(100, 101), (101, 102), (102, 100), (300, 200), (5, 5)]
    key = lambda i: i.to_bytes(4, "big")
    df = spark.createDataFrame([(key(a), key(b)) for a, b in edges], "a binary, b binary")
    got = {int.from_bytes(r["node"], "big"): int.from_bytes(r["root"], "big") for r in nd.components(df).collect()}
    want = {i: 0 for i in range(1, 41)} | {101: 100, 102: 100, 300: 200}
    assert got == want


def test_search_equals_its_sql(spark):
    con = connect(SF)
    assert difference(topk_search.topk_digest(given(spark, "embeddings")), con, topk_search.ORACLE) is None


def brute_top(rows, k=5):
    fine = [
        (i, tuple(int(np.floor(256 * float(x))) for x in v))
        for i, v in rows
        if i is not None and v is not None and all(x is not None and np.isfinite(x) for x in v)
    ]
    out = []
    for i, q in fine:
        if i % 50 == 0:
            scored = sorted(((-sum(a * b for a, b in zip(q, v, strict=True)), j) for j, v in fine if j != i and len(v) == len(q)))
            out += [(i, r + 1, j, -s) for r, (s, j) in enumerate(scored[:k])]
    return sorted(out)


def test_search_with_awkward_vectors(spark):
    rng = np.random.default_rng(2)
    rows = [(i, [float(x) for x in rng.normal(size=6)]) for i in range(400)]
    rows += [(1000 + i, [0.5] * 6) for i in range(300)]  # one common vector
    rows += [(2000, None), (2050, [1.0, None, 0.0, 0.0, 0.0, 0.0]), (2100, [float("nan")] * 6), (2150, [float("inf")] * 6)]
    # Candidates and queries that are there more than once.
    rows += [(50, rows[50][1]), (50, rows[50][1]), (1003, [0.5] * 6), (1003, [0.5] * 6), (100, rows[7][1]), (None, [1.0] * 6), (3000, [1.0, 2.0]), (3001, [2.0, 1.0]), (4000, [])]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<float>")
    given_rows = [(r["vec_id"], r["embedding"]) for r in df.collect()]
    for tree_rows in (64, 100_000):
        assert sorted(map(tuple, topk_search.top_k(df, tree_rows=tree_rows).collect())) == brute_top(given_rows)


def test_repeated_rows_by_the_sql(spark, tmp_path):
    rows = [(0, [1.0, 0.0]), (0, [1.0, 0.0])] + [(1, [0.5, 0.5])] * 3 + [(k, [0.1 * k, 0.0]) for k in range(2, 7)] + [(50, [1.0, 1.0])]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<float>")
    df.coalesce(1).write.parquet(str(tmp_path / "embeddings.parquet"))
    con = duckdb.connect()
    con.execute(f"CREATE VIEW embeddings AS SELECT * FROM read_parquet('{tmp_path}/embeddings.parquet/*.parquet')")
    assert difference(topk_search.topk_digest(df.repartition(3)), con, topk_search.ORACLE) is None


def test_vectors_whose_scores_would_pass_64_bits(spark):
    rows = [(0, [1e18, 0.0]), (1, [1.0, 0.0])]
    with pytest.raises(Exception, match="64 bits"):
        topk_search.topk_digest(spark.createDataFrame(rows, "vec_id long, embedding array<double>")).collect()


def test_trees_with_small_pages():
    rng = np.random.default_rng(8)
    v = rng.integers(-5, 6, (500, 4))
    tree = topk_search.MTree(v, np.arange(500), page=4)
    for i in range(0, 500, 25):
        want = sorted((-int(v[i] @ v[j]), j) for j in range(500) if j != i)[:5]
        assert tree.search(v[i], 5, i) == [(-s, j) for s, j in want]


def test_no_vectors(spark):
    assert topk_search.topk_digest(given(spark, "embeddings").limit(0)).count() == 0

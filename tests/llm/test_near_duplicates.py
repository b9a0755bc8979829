"""The prefix-tree join against all pairs, and the path for groups too large for one task."""

import numpy as np
import pytest

from flowvec.llm.trie_join import Tree, drop_near_duplicates, join_sets, near_duplicates, shingle_sets, signatures, size_classes
from flowvec.llm.wordhash import mix


def shingles(text, k=4):
    words = (text or "").encode().lower().split()
    if len(words) < k:
        return frozenset([tuple(words)] if words else [])
    return frozenset(tuple(words[i : i + k]) for i in range(len(words) - k + 1))


def brute(rows, percent=85, k=4):
    sets = [shingles(t, k) for _, t in rows]
    label = list(range(len(rows)))
    for i, a in enumerate(sets):
        for j in range(i):
            b = sets[j]
            if a and b and 100 * len(a & b) >= percent * len(a | b) and label[i] != label[j]:
                old, new = max(label[i], label[j]), min(label[i], label[j])
                label = [new if x == old else x for x in label]
    least = {}
    for (doc_id, _), x in zip(rows, label, strict=True):
        least[x] = min(least.get(x, doc_id), doc_id)
    return sorted((d, len(s), least[x]) for (d, _), s, x in zip(rows, sets, label, strict=True))


def texts(n, seed):
    random = np.random.default_rng(seed)
    bases = [[f"w{random.integers(400)}" for _ in range(random.integers(3, 70))] for _ in range(max(2, n // 8))]
    out = []
    for i in range(n):
        words = list(bases[random.integers(len(bases))])
        for _ in range(random.integers(0, 4)):
            words[random.integers(len(words))] = f"x{random.integers(50)}"
        out.append((i * 3, " ".join(words)))
    return out


@pytest.mark.parametrize("block", [512, 4])
def test_components(spark, block):
    rows = [*texts(120, 3), (1000, None), (1001, ""), (1002, " \n"), (1003, "One two"), (1004, "one  TWO"), (1005, "one")]
    docs = spark.createDataFrame(rows, "doc_id long, text string").withColumnRenamed("text", "text").selectExpr("*", "doc_id as key", "text as node")
    got = sorted(tuple(r) for r in near_duplicates(docs, block=block).select("doc_id", "n_shingles", "component_id").collect())
    assert got == brute(rows)


def test_large_group_without_common_ngrams(spark):
    """A chain of texts, each like its neighbours only: no n-gram is in most of them, and all are one component."""
    words = [f"w{i}" for i in range(400)]
    chain = [(i, " ".join(words[2 * i : 2 * i + 60])) for i in range(160)]
    apart = [(1000 + i, " ".join(words[i : i + 30] + [f"y{i}_{j}" for j in range(30)])) for i in range(0, 160, 20)]
    got = near_duplicates(spark.createDataFrame([*chain, *apart], "doc_id long, text string"), block=4)
    assert sorted(tuple(r) for r in got.select("doc_id", "n_shingles", "component_id").collect()) == brute([*chain, *apart])


def test_empty_and_repeated_rows(spark):
    schema = "doc_id long, text string"
    assert near_duplicates(spark.createDataFrame([], schema)).collect() == []
    rows = [(1, "a b c d e"), (1, "a b c d e"), (None, "a b c d e"), (2, None)]
    got = near_duplicates(spark.createDataFrame(rows, schema)).collect()
    assert sorted((r.doc_id is None, r.component_id) for r in got) == [(False, 1), (False, 1), (False, 2), (True, 1)]


def test_drop_keeps_one(spark):
    words = " ".join(f"w{i}" for i in range(60))
    rows = [(5, words), (2, words + " end"), (9, "quite another text of some words here"), (None, words)]
    kept = drop_near_duplicates(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    assert sorted((r.doc_id is None, r.doc_id or 0) for r in kept) == [(False, 2), (False, 9), (True, 0)]


def test_signatures_lose_no_pair():
    random = np.random.default_rng(5)
    ends = size_classes(85)
    for n in [6, 7, 9, 13, 20, 40, 77, 150, 400] * 12:
        a = np.unique(random.integers(0, 2**63, n).astype(np.uint64))
        most = 15 * 2 * len(a) // 185
        gone = random.integers(0, most // 2 + 1)
        b = np.unique(np.concatenate([a[gone:], random.integers(0, 2**63, most - gone - most // 3).astype(np.uint64)]))
        o = len(np.intersect1d(a, b))
        if len(a) != o and 100 * o >= 85 * (len(a) + len(b) - o):
            assert np.intersect1d(signatures(a, ends, 85), signatures(b, ends, 85)).size


@pytest.mark.parametrize("percent", [80, 85])
def test_signatures_of_long_sets(percent):
    """Few signatures for very long sets, and still no pair lost, whatever the share of empty parts."""
    random = np.random.default_rng(9)
    ends = size_classes(percent)
    for n in [900, 5_000, 40_000, 300_000]:
        a = np.unique(random.integers(0, 2**64, n, dtype=np.uint64))
        most = (100 - percent) * 2 * len(a) // (100 + percent)
        b = np.concatenate([a[most // 2 :], random.integers(0, 2**64, most - most // 2 - n // 400, dtype=np.uint64)])
        b = np.unique(b)
        o = len(np.intersect1d(a, b))
        assert 100 * o >= percent * (len(a) + len(b) - o)
        sa, sb = signatures(a, ends, percent), signatures(b, ends, percent)
        assert np.intersect1d(sa, sb).size and len(sa) < n


def test_tree_finds_all():
    random = np.random.default_rng(1)
    sets = [np.unique(random.integers(0, 60, random.integers(1, 40)).astype(np.uint64)) for _ in range(150)]
    tree = Tree(np.zeros(0, np.uint64))
    for i, s in enumerate(sets):
        tree.insert(s, i)
    for percent in (50, 85):
        for s in sets:
            want = [j for j, t in enumerate(sets) if 100 * (o := len(np.intersect1d(s, t))) >= percent * (len(s) + len(t) - o)]
            assert sorted(tree.similar(s, percent)) == want
    assert len(join_sets(sets, 85)) == len(sets)


def test_shingles_follow_words():
    sets = list(shingle_sets([b"a b  c\td", b"A b c d", None, b"a b", b"a  B", b"b a"]))
    assert sets[0].tolist() == sets[1].tolist() and sets[3].tolist() == sets[4].tolist()
    assert not len(sets[2]) and sets[3].tolist() != sets[5].tolist()


def test_a_full_bucket_of_ngrams_is_counted_in_little_memory():
    """Two tasks share what an executor has beside its heap."""
    import tracemalloc

    import pyarrow as pa

    from flowvec.llm.common import per_group
    from flowvec.llm.trie_join import BUCKET_GRAMS, _most_have

    grams = np.arange(BUCKET_GRAMS)
    blocks = [g.tobytes() for g in np.array_split(grams, 8)]
    times = [np.full(len(b) // 8, 5).tobytes() for b in blocks]
    table = pa.table({"component": [1] * 8, "bucket": [0] * 8, "grams": blocks, "times": times, "members": [20] * 8})
    del blocks, times
    tracemalloc.start()
    found = per_group(_most_have)(table)
    most = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert found.num_rows == 0 and most < 150e6


def test_chained_sets_without_a_partner_do_not_meet_in_blocks(spark, monkeypatch):
    """Texts that share half of their words are one group by signatures, and none is similar to another."""
    from flowvec.llm import trie_join

    half = [f"w{i}" for i in range(40)]
    rows = [(i, " ".join(half + [f"y{i}_{j}" for j in range(40)])) for i in range(60)]
    rows += [(100 + i, rows[i][1] + " end") for i in range(2)]
    met, compared = [], trie_join.large_group_links
    monkeypatch.setattr(trie_join, "large_group_links", lambda sets, percent: met.append(sets.count()) or compared(sets, percent))
    signed = {}
    for i, (_, text) in enumerate(rows):
        for x in signatures(next(shingle_sets([text.encode()])), size_classes(85), 85).tolist():
            signed.setdefault(x, []).append(i)
    assert max(map(len, signed.values())) > 8
    got = near_duplicates(spark.createDataFrame(rows, "doc_id long, text string"), block=4)
    assert sorted(tuple(r) for r in got.select("doc_id", "n_shingles", "component_id").collect()) == brute(rows)
    assert not met


def test_signatures_travel_in_few_bytes():
    import pyarrow as pa

    from flowvec.llm.trie_join import SIGNATURE_BITS, _signature_blocks, _unpacked

    rows = texts(150, 8)
    keys = np.array([k for k, _ in rows]) + 2**40
    blocks = _signature_blocks(3, 4, 85)(pa.table({"key": keys, "text": [t.encode() for _, t in rows]}))
    blocks = blocks.filter(pa.compute.greater_equal(blocks["bucket"], 0))
    ends, want = size_classes(85), {}
    for key, grams in zip(keys.tolist(), shingle_sets([t.encode() for _, t in rows]), strict=True):
        for x in (mix(signatures(grams, ends, 85)) & SIGNATURE_BITS).tolist():
            want.setdefault(x, key)
            want[x] = min(want[x], key)
    found, size = {}, 0
    for row in blocks.drop_columns(["bucket"]).to_pylist():
        value, key = _unpacked(row["left"], row["right"], row["place"])
        found.update(zip(value.tolist(), key.tolist(), strict=True))
        size += sum(map(len, row.values()))
    assert found.keys() == want.keys() and all(found[x] <= key for x, key in want.items()) and size < 10 * len(want)


def test_a_pair_that_shares_all_signatures_is_one_edge(spark, monkeypatch):
    """Near copies meet by many signatures, in many buckets; edges do not grow with the number of buckets."""
    from flowvec.llm import trie_join
    from flowvec.llm.common import keyed

    monkeypatch.setattr(trie_join, "BUCKET_SIGNATURES", 20)
    words = [[f"w{g}_{i}" for i in range(200)] for g in range(12)]
    rows = [(100 * g + i, " ".join(w[: 200 - i])) for g, w in enumerate(words) for i in range(4)]
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(7)
    edges = trie_join.candidate_edges(keyed(docs), 200 * len(rows), 4, 85)
    found = [tuple(r) for r in edges.collect()]
    assert len(found) < 3 * len(rows)
    node = np.array([d for d, _ in rows])
    a, b = trie_join.forest(*np.array(found).T)
    assert sorted(np.where(np.isin(node, a), b[np.minimum(np.searchsorted(a, node), len(a) - 1)], node)) == sorted(node // 100 * 100)


def test_forest():
    from flowvec.llm.trie_join import forest

    random = np.random.default_rng(2)
    for n in (0, 1, 5, 40, 90):
        pairs = random.integers(0, 60, (n, 2))
        label = list(range(60))
        for x, y in pairs.tolist():
            old, new = max(label[x], label[y]), min(label[x], label[y])
            label = [new if v == old else v for v in label]
        a, b = forest(pairs[:, 0], pairs[:, 1])
        assert dict(zip(a.tolist(), b.tolist(), strict=True)) == {i: v for i, v in enumerate(label) if i != v}
    chain = np.random.default_rng(3).permutation(5000)
    a, b = forest(chain[1:], chain[:-1])
    assert len(a) == 4999 and not b.any()

"""Simplex clusters, tokenizer alignment and byte-level backtracking against plain versions."""

import hashlib
import random
from collections import Counter

import numpy as np
import public_tokenizers as P
import pytest
import sentencepiece
import tiktoken
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from flowvec.llm import simplex_clusters as S
from flowvec.llm import token_alignment as T
from flowvec.llm.byte_backtrack import ByteEncoder, byte_digests, byte_encoder, byte_ids, byte_texts, ranks_path, read_ranks, word_pattern

LONG = " ".join(f"word{i % 97} the{i % 5}" for i in range(6000))
TEXTS = [
    (1, "The quick brown fox isn't here."), (2, None), (3, ""), (4, " \n\t "), (5, LONG), (6, "a" * 3000 + " " + "ab" * 900), (7, "Ünïcode Σ ﬁ <|endoftext|> <s> 'll 12 ▁x"),
    (None, "The quick brown fox"), (1, "The quick brown fox isn't here."), (8, "東京 😀 naïve\x00\x1c  x"), (9, "<0x41>     end"), (10, "x" * 70 + "\n\n  y "),
]


@pytest.fixture(scope="module")
def docs(spark):
    rows = spark.createDataFrame(TEXTS, "doc_id long, text string")
    clash = {c: F.lit("z") for c in ("ids", "piece", "pair", "links", "n", "key", "b", "best")}
    return rows.withColumns(clash)


def same(rows, want):
    order = lambda r: tuple((x is None, str(x)) for x in r)
    assert sorted(map(tuple, rows), key=order) == sorted(map(tuple, want), key=order)


# --- byte-level backtracking ------------------------------------------------


@pytest.fixture(scope="module")
def library():
    return tiktoken.Encoding("own", pat_str=P.PATTERN, mergeable_ranks=read_ranks(ranks_path()), special_tokens={})


def test_digests_are_those_of_the_library(docs, library):
    want = []
    for d, t in TEXTS:
        ids = library.encode_ordinary(t or "")
        want.append((d, len(ids), hashlib.sha256(" ".join(map(str, ids)).encode()).hexdigest(), hashlib.sha256(library.decode_bytes(ids)).hexdigest()))
    same(byte_digests(docs).collect(), want)
    assert byte_digests(docs.limit(0)).collect() == []


def test_ids_and_bytes_there_and_back(docs, library):
    ids = byte_ids(docs)
    same([(r.doc_id, str(r.ids)) for r in ids.collect()], [(d, str(library.encode_ordinary(t or ""))) for d, t in TEXTS])
    same([(r.doc_id, bytes(r.data)) for r in byte_texts(ids).collect()], [(d, (t or "").encode()) for d, t in TEXTS])


def test_any_characters_and_glued_tokens(library):
    own, choose = byte_encoder(), random.Random(1)
    signs = ["abc'reİΣ 1é", "aab", " \n\t\r\x1c\x85 ", "0123", "the in on er ing tion", None]
    for _ in range(3000):
        of = choose.choice(signs)
        code = lambda: chr(choose.choice([choose.randint(1, 0x2FFF), choose.randint(32, 127), choose.randint(0x4E00, 0x9000)]))
        text = "".join(code() if of is None else choose.choice(of) for _ in range(choose.randint(1, 60)))
        ids = own.encode(text)
        assert ids == library.encode_ordinary(text) and own.decode(ids) == text.encode()
    tokens = list(own.ranks)
    for _ in range(3000):
        data = b"".join(choose.choice(tokens) for _ in range(choose.randint(1, 6)))
        assert own.word(data) == library._core_bpe.encode_single_piece(data)


def test_a_small_vocabulary_has_to_backtrack():
    ranks = {bytes([b]): b for b in range(256)} | {b"ab": 256, b"bc": 257, b"abc": 258, b"cd": 259, b"bcd": 260, b"aa": 261, b"aaa": 262}
    own, library = ByteEncoder(ranks, r"\S+|\s+"), tiktoken.Encoding("s", pat_str=r"\S+|\s+", mergeable_ranks=ranks, special_tokens={})
    choose = random.Random(3)
    for _ in range(2000):
        text = "".join(choose.choice("abcd ") for _ in range(choose.randint(0, 14)))
        assert own.encode(text) == library.encode_ordinary(text)
    with pytest.raises(ValueError):
        ByteEncoder({b"a": 0}, r"\S+")


def test_work_grows_in_line_with_a_long_word(library):
    own = byte_encoder()
    text = "".join(random.Random(5).choice("etaoinshr") for _ in range(120_000))
    assert own.word(text.encode()) == library.encode_ordinary(text)
    parts = list(own.parts(" ".join(["word"] * 300_000)))
    assert len(parts) > 1 and sum(map(len, parts)) == 300_000


# --- simplex clusters -------------------------------------------------------


def by_hand(rows, k=40, rounds=5):
    kept = [(i, np.floor(np.array(v, np.float64) * 256).astype(int)) for i, v in rows if v is not None and len(v) == 64 and None not in v and np.isfinite(v).all()]
    if not kept:
        return []
    vectors = np.array([v for _, v in kept])
    order = sorted(range(len(kept)), key=lambda i: (kept[i][0] is None, hashlib.sha256(f"2:{kept[i][0]}".encode()).hexdigest() if kept[i][0] is not None else "", tuple(kept[i][1])))
    centroids = vectors[order[:k]].copy()
    assign = lambda: ((vectors[:, None, :] - centroids[None]) ** 2).sum(2)
    for _ in range(rounds):
        nearest = assign().argmin(1)
        for c in range(len(centroids)):
            if (nearest == c).any():
                centroids[c] = vectors[nearest == c].sum(0) // (nearest == c).sum()
    distance = assign()
    nearest, best = distance.argmin(1), distance.min(1)
    digest = [hashlib.sha256(",".join(map(str, c)).encode()).hexdigest() for c in centroids.tolist()]
    return [(i, int(n), int(d), int(best[nearest == n].sum()), int(best.sum()), digest[n]) for (i, _), n, d in zip(kept, nearest, best)]


def vectors(seed, n, spread=1.0):
    choose = np.random.default_rng(seed)
    centres = choose.normal(size=(9, 64)) * spread
    return [[float(x) for x in np.float32(centres[choose.integers(0, 9)] + choose.normal(size=64) * 0.1)] for _ in range(n)]


@pytest.mark.parametrize("pivots", [1, 6, 32])
def test_clusters_equal_plain_rounds(spark, pivots):
    rows = list(enumerate(vectors(1, 300)))
    rows += [(300 + i, rows[7][1]) for i in range(120)]  # a third are copies
    rows += [(900, None), (901, [1.0] * 63), (902, [float("nan")] * 64), (903, [float("-inf")] * 64), (904, [None, *[0.0] * 63]), (905, [0.0] * 64), (906, [])]
    rows += [(None, [0.5] * 64), (5, rows[5][1]), (5, rows[6][1])]  # no id, a repeated row, a repeated id
    table = spark.createDataFrame(rows, "vec_id long, embedding array<float>").withColumns({"cluster": F.lit("x"), "distance": F.lit("y"), "number": F.lit(1)})
    same(S.cluster_report(table, pivots=pivots).collect(), by_hand(rows))


def test_few_and_no_vectors(spark):
    schema = "vec_id long, embedding array<float>"
    few = list(enumerate(vectors(2, 5)))
    same(S.cluster_report(spark.createDataFrame(few, schema)).collect(), by_hand(few))
    same(S.cluster_report(spark.createDataFrame([(1, [0.25] * 64)] * 3, schema)).collect(), by_hand([(1, [0.25] * 64)] * 3))
    assert S.cluster_report(spark.createDataFrame([], schema)).collect() == []


def test_far_components_raise(spark):
    rows = [(1, [1e30] * 64), (2, [0.0] * 64)]
    with pytest.raises(Exception, match="would not fit a long"):
        S.cluster_report(spark.createDataFrame(rows, "vec_id long, embedding array<float>")).collect()


def test_bounds_hold_and_prune(spark):
    points = S.integers(np.array(vectors(3, 400, 4.0)))
    simplex = S.Simplex.over(points[:40], 8)
    apexes, centres = simplex.apexes(points), simplex.apexes(points[:40])
    lower, upper = S.bounds(apexes, centres)
    true = ((points[:, None, :] - points[None, :40]) ** 2).sum(2)
    slack = 1e-6 * true.max()
    assert (lower <= true + slack).all() and (upper >= true - slack).all()
    number, best, compared = S.nearest(points, apexes, points[:40], centres)
    assert (number == true.argmin(1)).all() and (best == true.min(1)).all() and compared < 0.3 * true.size


# --- tokenizer alignment ----------------------------------------------------


def plain_alignment(texts):
    """Tokens, links at common ends, groups and all overlaps, one text at a time with the libraries."""
    a_path, b_path = T.vocabulary_paths()
    first, second = Tokenizer.from_file(a_path), sentencepiece.SentencePieceProcessor(model_file=b_path)
    first.encode_special_tokens = True
    a_bytes = {i: t for t, i in T.read_byte_vocabulary(a_path).items()}
    found = []
    for _, text in texts:
        found.append(None)
        if not text:
            continue
        a, b = first.encode(" " + text, add_special_tokens=False).ids, second.encode(text)
        cut = [[a_bytes[i] for i in a], [bytes([int(second.id_to_piece(i)[3:-1], 16)]) if second.is_byte(i) else second.id_to_piece(i).replace("▁", " ").encode() for i in b]]
        if any(b"".join(c) != (" " + text).encode() for c in cut):
            continue
        ends = [np.cumsum([len(t) for t in c]).tolist() for c in cut]
        groups, links, i, j = [], [], 0, 0
        for end in sorted(set(ends[0]) & set(ends[1])):
            m, n = ends[0].index(end, i) + 1, ends[1].index(end, j) + 1
            groups.append((a[i:m], b[j:n]))
            links.append((a[m - 1], b[n - 1]))
            i, j = m, n
        found[-1] = (a, b, groups, links, ends)
    return found


def test_report_equals_the_plain_alignment(spark, docs):
    plain = plain_alignment(TEXTS)
    counts = Counter(link for p in plain if p for link in p[3])
    top = Counter()
    for (_, b), n in counts.items():
        top[b] = max(top[b], n)
    want = []
    for (d, _), p in zip(TEXTS, plain):
        if p is None:
            want.append((d, 0, 0, 0, 0, 0, 0, ""))
            continue
        a, b, groups, links, _ = p
        text = ";".join(",".join(map(str, x)) + "|" + ",".join(map(str, y)) for x, y in groups)
        want.append((d, len(a), len(b), len(groups), len(links), sum(counts[x] == top[x[1]] for x in links), sum(counts[x] for x in links), hashlib.sha256(text.encode()).hexdigest()))
    assert sum(p is None for p in plain) >= 3 and any(p and len(p[2]) < len(p[0]) for p in plain)
    columns = ["doc_id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256"]
    for piece_bytes in (50, 8_000_000):
        same(T.alignment_report(docs, piece_bytes=piece_bytes).select(*columns).collect(), want)
    assert T.alignment_report(docs.limit(0)).collect() == []


def test_links_of_every_kind(spark):
    texts = [(1, "unbelievable tokenisation, 東京!"), (2, "the the"), (3, None)]
    rows = spark.createDataFrame(texts, "doc_id long, text string")
    plain = plain_alignment(texts)
    for kind in T.KINDS:
        want = []
        for (d, _), p in zip(texts, plain):
            if p is None:
                continue
            a, b, _, _, (ea, eb) = p
            common = sorted(set(ea) & set(eb))
            for i, x in enumerate(ea):
                for j, y in enumerate(eb):
                    shared = min(x, y) - max(ea[i - 1] if i else 0, eb[j - 1] if j else 0)
                    group = lambda end: sum(c < end for c in common)
                    if kind == "group" and group(x) == group(y):
                        want.append((d, i, j, a[i], b[j], 1))
                    elif kind == "overlap" and shared > 0 or kind == "end" and x == y:
                        want.append((d, i, j, a[i], b[j], shared))
        same(T.token_links(rows, kind).collect(), want)
    with pytest.raises(ValueError):
        T.token_links(rows, "near")


def test_words_on_their_own_give_the_whole_text():
    own = T.aligner(*T.vocabulary_paths(), word_pattern())
    choose, texts = random.Random(3), []
    assert own.cuts
    for _ in range(1500):
        parts = ["a", "the", " ", "  ", "\n", "\t", " ", "\x1c", "x1", "é", "▁", "!", " the", ",", "'s", "　", "ing", " ", "\U0001f600"]
        texts.append("".join(choose.choice(parts) for _ in range(choose.randint(1, 40))))
    counts, groups, keys = own.align(texts)
    for i, text in enumerate(texts):
        found, n_a, n_b = own.pair.align([text])
        written = "".join(map(own.pair.written.__getitem__, found.codes(own.pair.width).tolist()))[1:]
        links = [found.a[a] * own.pair.b_width + found.b[b] for a, b, _ in found.links("end")]
        assert written == groups[i] and np.array_equal(np.concatenate([np.zeros(0, np.int64), *links]), keys[i])
        n_overlaps, n_shared = (sum(len(a) for a, _, _ in found.links(kind)) for kind in ("overlap", "group"))
        assert counts[i].tolist() == [n_a[0], n_b[0], found.groups, len(keys[i]), n_overlaps, n_shared]


def test_products_equal_dense_ones():
    choose = np.random.default_rng(6)
    for rows, inner, width in ((7, 5, 9), (1, 1, 1), (40, 30, 3), (4, 6, 8)):
        a, b = choose.integers(0, 3, (rows, inner)), choose.integers(0, 3, (inner, width))

        def sparse(m):
            place = [np.flatnonzero(r) for r in m]
            start = np.append(0, np.cumsum([len(x) for x in place]))
            column = np.concatenate(place)
            return T.Csr(start, column, m[np.repeat(np.arange(len(m)), np.diff(start)), column], m.shape[1])

        for terms in (1, 10, 10_000):
            dense = np.zeros((rows, width), int)
            for r, c, v in sparse(a).times(sparse(b), terms):
                assert (dense[r, c] == 0).all()
                dense[r, c] = v
            assert (dense == a @ b).all()
        assert (sparse(a).transpose().start == sparse(a.T).start).all() and (sparse(a).transpose().column == sparse(a.T).column).all()

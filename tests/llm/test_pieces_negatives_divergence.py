"""Operators 11 to 13 against the library, brute force and their defined results."""

import math
import random
import re
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest
import sentencepiece
from pyspark.sql import functions as F

from tactus.llm import divergence, hard_negatives, sentencepieces
from tactus.llm.tokens import tokenizer_path
from tests.llm.test_operators import corpus, read

MODEL = tokenizer_path("piece_bpe_32k.model")


@pytest.fixture(scope="module")
def library():
    return sentencepiece.SentencePieceProcessor(model_file=MODEL)


@pytest.fixture(scope="module")
def pieces():
    return sentencepieces.PieceModel(MODEL)


# --- sentencepiece


def encoded(pieces, texts):
    ids, cuts = pieces.encode(pa.array(texts, pa.string()))
    return [ids[a:b].tolist() for a, b in zip(cuts[:-1], cuts[1:])], [x.decode() for x in pieces.decode(ids.astype(np.int64), cuts)]


def compared(pieces, library, texts):
    want = library.encode([t or "" for t in texts], add_bos=True, add_eos=True)
    got, decoded = encoded(pieces, texts)
    assert got == want
    assert decoded == [library.decode(x) for x in want]


def test_pieces_of_edge_texts(pieces, library):
    marks = [None, "", " ", "a", " a", "a ", "▁", "▁▁x", "ab▁cd", *(" " * n for n in range(2, 40)), " " * 33 + "1", " " * 18 + "the", "1  2   3"]
    compared(pieces, library, [*marks, "\n\n \n", "<s>", "</s> <unk> <0x41>", "\x00a\x00", "日本語 梦", "😀😀 x😀", "é́ ó", "a" * 13, "ab" * 200, "�"])


@pytest.mark.parametrize("seed", range(4))
def test_pieces_of_random_texts(pieces, library, seed):
    r = random.Random(seed)
    parts = ["a", "b", "e", "t", "h", "i", "n", " ", "  ", "1", "\n", "\t", ".", "é", "日", "語", "😀", "▁", "the", "ing", "A", "zz", "_", "="]
    compared(pieces, library, ["".join(r.choice(parts) for _ in range(r.randint(0, 80))) for _ in range(500)])


@pytest.mark.parametrize("kind", ["letters", "spaces", "pairs", "any"])
def test_pieces_of_long_words(pieces, library, kind):
    r = random.Random(1)
    compared(pieces, library, [{"letters": "".join(r.choice("etaoin") for _ in range(50_000)), "spaces": " " * 300_000, "pairs": "ab" * 100_000, "any": "".join(chr(r.randint(33, 0x24FF)) for _ in range(50_000))}[kind]])


def test_any_ids_decode_as_in_the_library(pieces, library):
    """Bytes that make no character, control ids inside, leading marks."""
    r = random.Random(2)
    for _ in range(300):
        ids = [r.choice([r.randrange(3), r.randrange(3, 259), r.randrange(259, 32000), 259, 28705]) for _ in range(r.randint(0, 30))]
        assert pieces.decode(np.array(ids, np.int64), np.array([0, len(ids)]))[0].decode() == library.decode(ids)


def test_sentencepiece_of_documents(spark, rows, library):
    texts = corpus(2)
    docs = rows([*enumerate(texts), (None, "x"), (3, texts[3])])
    found = read(sentencepieces.decode_documents(sentencepieces.encode_documents(docs, MODEL), MODEL), "doc_id", "ids", "text")
    assert len(found) == len(texts) + 2
    for i, ids, text in found:
        want = library.encode("x" if i is None else texts[i] or "", add_bos=True, add_eos=True)
        assert ids == want and text == library.decode(want)
    sums = sentencepieces.digests(sentencepieces.decode_documents(sentencepieces.encode_documents(docs, MODEL), MODEL))
    assert sums.columns == ["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"]
    assert sentencepieces.encode_documents(rows([]), MODEL).count() == 0
    clash = rows([(1, "a b")]).withColumnRenamed("pos", "ids")
    assert read(sentencepieces.encode_documents(clash, MODEL), "ids") == [(library.encode("a b", add_bos=True, add_eos=True),)]


# --- hard negatives


def brute_negatives(table, is_anchor, k=5, low=80, high=100):
    kept = [(i, c, [math.floor(256 * x) for x in v]) for i, c, v in table if i is not None and c is not None and v is not None and all(x is not None and math.isfinite(x) for x in v)]
    out = []
    for i, c, v in {(i, c, tuple(v)) for i, c, v in kept if is_anchor(i)}:
        score = lambda w: sum(a * b for a, b in zip(v, w))
        for p, _, pw in sorted((r for r in kept if r[1] == c and r[0] != i), key=lambda r: (-score(r[2]), r[0]))[:k]:
            ps = score(pw)
            found = sorted((r for r in kept if r[1] != c and r[0] != i and low * ps <= 100 * score(r[2]) <= high * ps), key=lambda r: (-score(r[2]), r[0]))[:k]
            out += [(i, p, n, r[0], ps, score(r[2])) for n, r in enumerate(found, 1)]
    return sorted(out)


def vectors(spark, table):
    return spark.createDataFrame([(i, c, v, "x") for i, c, v in table], "id long, label int, vector array<float>, place string")


def random_table(seed, n, dims=6, spread=1.0):
    g = np.random.default_rng(seed)
    centres = g.normal(0, 1, (5, dims))
    return [(i, int(g.integers(3)), [float(np.float32(x)) for x in (centres[i % 5] + spread * g.normal(0, 0.3, dims)).round(2)]) for i in range(n)]


@pytest.mark.parametrize("seed", [0, 1])
def test_negatives_equal_brute_force(spark, monkeypatch, seed):
    monkeypatch.setattr(hard_negatives, "LEAF", 16)
    table = random_table(seed, 400)
    got = read(hard_negatives.hard_negatives(vectors(spark, table), F.col("id") % 10 == 0), "anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score")
    assert sorted(got) == brute_negatives(table, lambda i: i % 10 == 0)


def test_negatives_of_ties_copies_and_faulty_rows(spark):
    """Equal vectors tie by id, repeated rows take places of their own, equal anchors search once, faulty rows take no part."""
    same = [1.0, 0.5]
    table = [(i, i % 2, same) for i in range(40)] + [(10, 0, same), (11, 1, same), (3, 1, same)]
    table += [(50, 0, None), (60, None, same), (None, 0, same), (70, 0, [1.0, None]), (80, 0, [float("nan"), 1.0]), (90, 0, [float("inf"), 1.0]), (100, 0, [1.0]), (110, 1, []), (120, 1, [-1.0, -1.0])]
    got = read(hard_negatives.hard_negatives(vectors(spark, table), F.col("id") % 10 == 0), "anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score")
    assert sorted(got) == brute_negatives(table, lambda i: i is not None and i % 10 == 0)


@pytest.mark.parametrize("scale", [1e5, 1e12])
def test_negatives_of_large_components_are_exact(spark, scale):
    """Beyond the range where products of doubles are exact."""
    table = [(i, c, [float(np.float32(x * scale)) for x in v]) for i, c, v in random_table(3, 60, 3)]
    got = read(hard_negatives.hard_negatives(vectors(spark, table), F.col("id") % 10 == 0, scale=1), "anchor_id", "positive_id", "rank", "negative_id")
    clipped = lambda x: max(-(2**63), min(2**63 - 1, x))
    if scale > 1e9:  # scores are clipped to the longs' ends
        assert len(got) and clipped(2**80) == 2**63 - 1
    else:
        plain = [(i, c, [x / 256 for x in v]) for i, c, v in table]
        assert sorted(got) == [r[:4] for r in brute_negatives(plain, lambda i: i % 10 == 0)]


def test_negatives_of_no_rows_and_no_anchors(spark):
    assert hard_negatives.hard_negatives(vectors(spark, []), F.col("id") % 10 == 0).count() == 0
    assert hard_negatives.hard_negatives(vectors(spark, random_table(1, 9)[1:]), F.col("id") % 10 == 0).count() == 0
    assert hard_negatives.hard_negatives(vectors(spark, [(0, 1, [1.0, 2.0])]), F.col("id") % 10 == 0).count() == 0


def test_pivot_brackets_hold_and_part(spark):
    """Every score lies in its bracket; on clustered vectors most rows are shut out."""
    g = np.random.default_rng(4)
    centres = g.normal(0, 300, (20, 32))
    x = np.floor(centres[g.integers(0, 20, 2000)] + g.normal(0, 12, (2000, 32)))
    table = hard_negatives.Table(x[:500], 32, float((x**2).sum(1).max()), 16)
    d, a = table.stored(x), x[::100]
    low, high = table.bracket(a, table.asked(a), d, d)
    score = a @ x.T
    assert (low <= score).all() and (score <= high).all()
    fifth = np.sort(score, 1)[:, -5]
    assert (high >= fifth[:, None]).mean() < 0.2


# --- divergence


def brute_divergence(docs, min_docs=3, top=200):
    docs = [tuple(x or "" for x in d) for d in docs]
    words = [[w.translate({c: c + 32 for c in range(65, 91)}) for w in re.findall(r"[^\x00-\x40\x5B-\x60\x7B-\x7F]+", t)] for t, _, _ in docs]
    out = []
    for lang in {d[1] for d in docs}:
        at = [i for i, d in enumerate(docs) if d[1] == lang]
        spread = Counter(w for i in at for w in set(words[i]))
        kept = sorted((w for w, n in spread.items() if n >= min_docs), key=lambda w: w.encode())
        sources = sorted({docs[i][2] for i in at})
        count = {s: Counter(w for i in at if docs[i][2] == s for w in words[i] if spread[w] >= min_docs) for s in sources}
        total = sum(count.values(), Counter())
        chance = lambda c: {w: 1 + 10**9 * (c[w] + 1) // (sum(c.values()) + len(kept)) for w in kept}
        q, ps = chance(total), {s: chance(count[s]) for s in sources}
        f = lambda a, b: (a - b) * (a - b) // b
        for s in sources:
            pairs = [(o, sum(f(ps[s][w], ps[o][w]) for w in kept)) for o in sources if o != s]
            terms = [(w, f(ps[s][w], q[w])) for w in kept if count[s][w] and ps[s][w] > q[w]]
            for part, found, most in (("pair", pairs, None), ("term", terms, top)):
                found.sort(key=lambda x: (-x[1], x[0].encode()))
                out += [(lang, s, part, item, value, k) for k, (item, value) in enumerate(found[:most], 1)]
    return sorted(out)


COLUMNS = ("lang", "source", "part", "item", "value", "rank")


def labelled(spark, docs):
    return spark.createDataFrame([(i, *d) for i, d in enumerate(docs)], "n long, text string, lang string, source string")


@pytest.mark.parametrize("top", [200, 7])
def test_divergence_equals_brute_force(spark, top):
    r = random.Random(3)
    texts = [t for s in range(3) for t in corpus(s)]
    docs = [(t, r.choice(["en", "en", "fr", None, ""]), r.choice(["a", "a", "a", "b", "c", "é", None])) for t in texts]
    docs += [("Été ÉTÉ été straße STRASSE", "fr", "a")] * 4 + [("only once", "de", "z"), (None, "de", "y"), ("", None, None)]
    assert sorted(read(divergence.divergence_audit(labelled(spark, docs), top=top), *COLUMNS)) == brute_divergence(docs, top=top)


def test_divergence_of_many_sources_in_strips(spark, monkeypatch):
    """Terms that very many sources hold, in several strips, batches and folds."""
    monkeypatch.setattr(divergence, "_CELLS", 50)
    docs = [(f"word{i % 7} common term{i % 3}", "en", f"s{i % 23}") for i in range(200)]
    r = divergence._Shared()
    source, p, zero = np.arange(23)[None, :], np.arange(1, 24)[None, :] * 1000, np.arange(1, 24)[None, :]
    r.add(source, p, zero)
    r.place = {("en", f"s{k}"): k for k in range(23)}
    got = {(a, b): v for x in r.rows() for _, a, b, v in zip(*(c.to_pylist() for c in x.columns))}
    f = lambda a, b: (a - b) ** 2 // b
    assert got == {(f"s{a}", f"s{b}"): f(1000 * (a + 1), 1000 * (b + 1)) - f(1000 * (a + 1), b + 1) - f(a + 1, 1000 * (b + 1)) + f(a + 1, b + 1) for a in range(23) for b in range(23) if a != b}
    assert sorted(read(divergence.divergence_audit(labelled(spark, docs)), *COLUMNS)) == brute_divergence(docs)


def test_divergence_of_no_rows(spark):
    assert divergence.divergence_audit(labelled(spark, [])).count() == 0


def test_chance_of_large_counts(spark):
    """Exact where 10^9 times the count leaves the longs."""
    pairs = [(0, 1), (5 * 10**14, 8 * 10**15), (10**12, 10**12 + 1), (7, 3 * 10**9)]
    df = spark.createDataFrame(pairs, "c long, t long")
    assert read(df.select(divergence.chance(F.col("c"), F.col("t")).alias("p")), "p") == [(1 + 10**9 * (c + 1) // t,) for c, t in pairs]

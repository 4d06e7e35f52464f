"""Each operator against a brute-force version, and its defined results for nulls, empty and long texts, ties and repeated rows."""

import hashlib
import itertools
import os
import random
import re
import time
import zlib

import numpy as np
import pyarrow as pa
import pytest

from tactus.llm import components, decontamination, fingerprints, jaccard_join, language_id, line_dedup, packing, pii, substring_dedup, token_files, tokens, toxicity

WORDS = [f"{a}{b}" for a in ("ka", "mo", "ti", "re", "su", "na", "lo", "vi") for b in ("", "n", "la", "ro", "me", "st")]
EDGE = [None, "", " ", "\n", "a", "Zz", "é́ o", "line one\nline two\nline three"]


def prose(seed, n):
    r = random.Random(seed)
    out = []
    for _ in range(n):
        out.append(r.choice(WORDS) + r.choice(["", "", "", "", ".", ",", ".\n"]))
    return " ".join(out)


def corpus(seed=0, n=60):
    """Texts with copies, near copies, shared passages and edge cases."""
    r = random.Random(seed)
    texts = [prose(seed * 1000 + i, r.randint(3, 200)) for i in range(n)]
    passage = prose(999, 40)
    texts += [texts[0], texts[0], texts[1] + " tail", passage + " " + texts[2], texts[3] + " " + passage, passage]
    near = prose(77, 150).split(" ")
    for k in range(6):
        w = list(near)
        w[(20 * k + 7) % len(w)] = f"edit{k}"
        texts.append(" ".join(w))
    return [*texts, *EDGE, prose(5, 6000)]


def read(df, *cols):
    return [tuple(r[c] for c in cols) for r in df.collect()]


# --- similarity join


def brute_links(pairs, k=5, least=0.8):
    sets = []
    for _, t in pairs:
        w = (t or "").lower().split()
        sets.append({tuple(w[i : i + k]) for i in range(len(w) - k + 1)} if len(w) >= k else {tuple(w)} if w else set())
    links, root = [0] * len(pairs), list(range(len(pairs)))

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for a in range(len(pairs)):
        for b in range(a):
            both = len(sets[a] & sets[b])
            if both and both >= least * (len(sets[a]) + len(sets[b]) - both):
                links[a] += 1
                links[b] += 1
                x, y = sorted((find(a), find(b)))
                root[y] = x
    return {pairs[i][0]: (pairs[find(i)][0], links[i]) for i in range(len(pairs))}


@pytest.mark.parametrize("limit", [1024, 2])
def test_similarity_classes_equal_brute_force(spark, rows, limit):
    pairs = list(enumerate(corpus(1)))
    out = jaccard_join.similarity_classes(rows(pairs), limit=limit, block=3 if limit == 2 else 256)
    assert {i: (c, n) for i, c, n in read(out, "doc_id", "class_id", "n_links")} == brute_links(pairs)


def test_similarity_of_no_rows_and_null_ids(spark, rows):
    assert jaccard_join.similarity_classes(rows([])).count() == 0
    out = read(jaccard_join.similarity_classes(rows([(None, prose(1, 30)), (3, prose(1, 30)), (3, prose(1, 30))])), "doc_id", "class_id", "n_links")
    assert sorted(out, key=str) == [(3, 3, 1), (3, 3, 1), (None, None, 0)]


def test_similarity_of_several_texts_of_one_id(spark, rows):
    """Two texts of one id belong to different classes, each with its own links."""
    a, b = prose(1, 60).replace("\n", " "), prose(2, 60).replace("\n", " ")
    near = lambda t: " ".join([*t.split()[:-1], "changed"])
    pairs = [(1, a), (1, b), (2, near(a)), (3, near(b)), (4, a), (1, a)]
    out = read(jaccard_join.similarity_classes(rows(pairs)), "doc_id", "class_id", "n_links")
    assert sorted(out) == [(1, 1, 1), (1, 1, 3), (1, 1, 3), (2, 1, 3), (3, 1, 1), (4, 1, 3)]
    pairs = [(5, a), (5, b), (3, near(a))]
    assert sorted((r["doc_id"], r["text"]) for r in jaccard_join.stage_jaccard_join(spark, rows(pairs), "").collect()) == [(3, near(a)), (5, b)]


def test_similarity_of_a_long_chain(spark, rows):
    """Each version of a page is like the one before; ids ascend along the chain."""
    words = [f"w{k}" for k in range(360)]
    pairs = [(i, " ".join(words[i : i + 60])) for i in range(300)]
    assert {c for _, c in read(jaccard_join.similarity_classes(rows(pairs), block=64), "doc_id", "class_id")} == {0}
    assert [r["doc_id"] for r in jaccard_join.stage_jaccard_join(spark, rows(pairs), "").collect()] == [0]


def test_large_group_of_near_copies(spark, rows):
    """Every text of the group differs in one word; buckets of more than the limit are split, links are counted whole."""
    words = prose(4, 100).split()
    pairs = [(i, " ".join([*words[: 7 + i % 80], f"own{i}", *words[8 + i % 80 :]])) for i in range(700)]
    out = read(jaccard_join.similarity_classes(rows(pairs), limit=64, block=128), "doc_id", "class_id", "n_links")
    assert {i: (c, n) for i, c, n in out} == brute_links(pairs)


def test_classes_alone_equal_those_with_counts(spark, rows):
    """Edge by edge first: groups that the trees settle, and a chain of different texts whose candidates are wider than its links."""
    words = prose(4, 100).split()
    pairs = [(i, " ".join([*words[: 7 + i % 80], f"own{i}", *words[8 + i % 80 :]])) for i in range(60)]
    line = [f"w{k}" for k in range(300)]
    pairs += [(100 + i, " ".join(line[6 * i : 6 * i + 60])) for i in range(40)] + [(200, None), (201, "a"), (202, "a"), (203, pairs[0][1])]
    for limit in (4096, 16):
        a = jaccard_join._classified(rows(pairs), 0.8, jaccard_join.RECALL, 5, limit, 32, "doc_id", "text", counted=False)
        want = brute_links(pairs)
        assert {i: c for i, c in read(a, "doc_id", "class_id")} == {i: c for i, (c, _) in want.items()}


@pytest.mark.parametrize("order", ["ascending", "descending", "shuffled"])
def test_components_of_long_paths(spark, monkeypatch, order):
    n, steps = 5000, []
    ids = {"ascending": list(range(n)), "descending": list(range(n))[::-1], "shuffled": random.Random(1).sample(range(n), n)}[order]
    real = components.materialize
    monkeypatch.setattr(components, "materialize", lambda df, name: steps.append(name) or real(df, name))
    edges = spark.createDataFrame(list(zip(ids[:-1], ids[1:])) + [(9001, 9002), (9003, 9003)], "u long, v long")
    found = dict(read(components.components(edges), "node", "root"))
    assert {found[i] for i in ids} == {0} and found[9002] == 9001 and 9003 not in found
    assert steps.count("step") < 20


def test_stage_keeps_one_of_each_class(spark, rows):
    pairs = list(enumerate(corpus(2)))
    kept = {r["doc_id"] for r in jaccard_join.stage_jaccard_join(spark, rows(pairs), "").collect()}
    assert kept == {i for i, (c, _) in brute_links(pairs).items() if c == i}


def test_chosen_path_recall():
    r = np.random.default_rng(0)
    runs, met = jaccard_join.runs_for(jaccard_join.RECALL), 0
    for _ in range(200):
        base = r.integers(0, 2**63, 100, dtype=np.uint64)
        a, b = np.sort(base[:90]), np.sort(np.concatenate([base[:80], base[90:]]))
        met += bool(np.intersect1d(jaccard_join.chosen_paths(a, runs, 0.8)[0][0], jaccard_join.chosen_paths(b, runs, 0.8)[0][0]).size)
    assert met == 200


@pytest.mark.parametrize("depth", [1, 2, 3])
def test_chosen_path_recall_at_each_depth(depth):
    r = np.random.default_rng(1)
    runs, met = jaccard_join.runs_for(0.9, depth), 0
    for _ in range(1000):
        base = r.integers(0, 2**63, 100, dtype=np.uint64)
        a, b = np.sort(base[:90]), np.sort(np.concatenate([base[:80], base[90:]]))
        met += bool(np.intersect1d(jaccard_join.chosen_paths(a, runs, 0.8)[depth - 1][0], jaccard_join.chosen_paths(b, runs, 0.8)[depth - 1][0]).size)
    assert met >= 880
    assert jaccard_join.runs_for(jaccard_join.RECALL, depth) == [12, 19, 25][depth - 1]


# --- substring dedup


def brute_spans(pairs, n=13):
    first, out = {}, {}
    for i, t in sorted(pairs):
        w = re.findall(r"[^\x20\x09-\x0D]+", t or "")
        gone = [False] * len(w)
        for s in range(len(w) - n + 1):
            if first.setdefault(tuple(w[s : s + n]), i) < i:
                gone[s : s + n] = [True] * n
        kept = " ".join(x for x, g in zip(w, gone) if not g)
        out[i] = (len(w), sum(gone), hashlib.sha256(kept.encode()).hexdigest())
    return out


@pytest.mark.parametrize("hot", [512, 1])
def test_spans_equal_brute_force(spark, rows, hot):
    pairs = list(enumerate(corpus(3)))
    out = substring_dedup.dedup_spans(rows(pairs), hot=hot)
    assert {i: tuple(x) for i, *x in read(out, "doc_id", "n_words", "n_removed", "kept_sha256")} == brute_spans(pairs)


def test_spans_of_no_rows_null_ids_and_repeats(spark, rows):
    assert substring_dedup.dedup_spans(rows([])).count() == 0
    t = prose(8, 50)
    out = read(substring_dedup.dedup_spans(rows([(None, t), (4, t), (4, t), (9, t)])), "doc_id", "n_removed")
    assert sorted(out, key=str) == [(4, 0), (4, 0), (9, 50), (None, 0)]


def test_suffix_automaton_least_owner():
    a = substring_dedup.SuffixAutomaton()
    a.add(list("abcabd"), 5)
    a.add(list("xabcy"), 3)
    a.finish()
    assert a.statistics(list("abcabd"), 3) == [3, 5, 5, 5]
    assert a.statistics(list("zabcab"), 3) == [None, 3, 5, 5]


# --- line dedup


def brute_lines(pairs):
    seen, out = {}, {}
    for i, t in sorted(pairs):
        lines = [] if t is None else t.split("\n")
        gone = set()
        for p in range(len(lines) - 2):
            w = tuple(lines[p : p + 3])
            if "".join(w).strip(" ") and seen.setdefault(w, (i, p)) != (i, p):
                gone |= {p, p + 1, p + 2}
        kept = None if t is None else "\n".join(x for p, x in enumerate(lines) if p not in gone)
        out[i] = (kept, len(lines), len(gone))
    return out


def test_lines_equal_brute_force(spark, rows):
    block = "one\ntwo\nthree"
    texts = [block, f"zero\n{block}\nfour", f"{block}\n{block}", "\n\n\n\n", "\n\n\n\n", None, "", "one\ntwo", f"{block}\nfour", *corpus(4)]
    pairs = list(enumerate(texts))
    out = line_dedup.dedup_lines(rows(pairs))
    assert {i: tuple(x) for i, *x in read(out, "doc_id", "text", "n_lines", "n_removed")} == brute_lines(pairs)
    assert line_dedup.dedup_lines(rows([])).count() == 0
    kept = {r["doc_id"] for r in line_dedup.stage_line_dedup(spark, rows(pairs), "").collect()}
    assert kept == {i for i, (_, n, gone) in brute_lines(pairs).items() if not gone or gone < n}


def test_lines_with_clashing_columns_null_and_repeated_ids(spark):
    block = "one\ntwo\nthree"
    names = ("covered", "_doc", "_key", "text_key", "found", "n_lines", "n_removed", "n_chars")
    data = [(1, block), (2, f"x\n{block}"), (None, f"{block}\ny"), (2, "other\ntext"), (2, f"x\n{block}")]
    docs = spark.createDataFrame([(i, t, *range(8)) for i, t in data], "doc_id long, text string, " + ", ".join(f"{n} int" for n in names))
    out = read(line_dedup.dedup_lines(docs), "doc_id", "text", "covered", "n_removed")
    assert sorted(out, key=str) == sorted([(1, "", 0, 3), (2, "x", 0, 3), (None, f"{block}\ny", 0, 0), (2, "other\ntext", 0, 0), (2, "x", 0, 3)], key=str)
    left = line_dedup.stage_line_dedup(spark, docs, "")
    assert left.columns == docs.columns and {(r["doc_id"], r["n_lines"], r["n_chars"]) for r in left.collect()} == {(None, 5, 7), (2, 5, 7), (2, 5, 1)}


# --- decontamination


def test_contamination_of_copies_and_rewritten_questions(spark, rows, monkeypatch):
    item = "Anna has 12 apples and buys 5 kg of rice, then Anna gives 12 of her apples away to the poor. How many are left for the whole long winter"
    other = item.replace("Anna", "Zoe").replace("12", "37").replace("5 kg", "9 km")
    broken = item.replace("12 of", "13 of").replace("Anna gives", "Bob gives")
    pairs = [(1, f"Words before it. {item} and words behind it"), (2, f"So it says: {other}. The end"), (3, broken), (4, prose(1, 300)), (5, None), (6, ""), (7, item), (7, item)]
    bench = spark.createDataFrame([(0, item), (1, "too short"), (2, None), (None, item)], "item_id long, text string")
    found = {(i, k) for i, k in read(decontamination.contamination(rows(pairs), bench), "doc_id", "item_id")}
    assert {(1, 0), (2, 0), (7, 0)} <= found and not {i for i, _ in found} & {4, 5, 6}
    assert (3, 0) not in found
    decontamination_rows = sorted(read(decontamination.contamination(rows(pairs), bench), "doc_id", "item_id", "n_matched"))
    monkeypatch.setattr(decontamination, "BROADCAST", 0)
    assert sorted(read(decontamination.contamination(rows(pairs), bench), "doc_id", "item_id", "n_matched")) == decontamination_rows
    assert decontamination.contamination(rows(pairs), bench.limit(0)).count() == 0
    assert decontamination.contamination(rows([]), bench).count() == 0


def test_contamination_of_rewritten_sentences(spark, rows):
    """Names that begin sentences; windows with too few words don't count against an item."""
    item = "Anna buys 12 boxes of pens at the market for 3 dollars each. Anna gives 5 of the boxes to her brother after school. Anna then sells the rest of them for 4 dollars each"
    other = item.replace("Anna", "Zoe").replace("12", "37").replace("5 of", "9 of")
    mixed = item.replace("Anna buys", "Zoe buys").replace("Anna gives", "Bob gives").replace("Anna then", "Tom then")
    few = "the price of one kilo of apples rose to 1 2 3 4 5 6 7 8 9 10 11 12 13 14 15 16 17 18 19 20"
    bench = spark.createDataFrame([(0, item), (1, few)], "item_id long, text string")
    pairs = [(1, item), (2, other), (3, mixed), (4, few.replace("20", "21")), (5, "the price of one kilo of apples rose to nothing"), (6, prose(6, 90))]
    found = {(i, k) for i, k in read(decontamination.contamination(rows(pairs), bench), "doc_id", "item_id")}
    assert {(1, 0), (2, 0), (4, 1)} <= found
    assert (3, 0) not in found and not {i for i, _ in found} & {6}


def test_contamination_finds_every_copied_item(spark, rows):
    """Items copied whole into a document: of each length, of mostly names and numbers, of numbers alone; shorter ones as whole documents."""
    r = random.Random(11)
    word = lambda: r.choice(WORDS)
    items = [" ".join(word() for _ in range(n)) for n in (5, 6, 7, 8, 9, 20)]
    items.append("Anna Bob Carl Dora " + " ".join(word() for _ in range(9)) + " 1 2 3 4 5 6 7 8 9 10 11 12 Eva Finn Gina Hans Ida Jan Karl Lea")
    items += ["too short it is", "12 13 14 15 16 17 18 19 20", "What is 12 times 17?", "Yes."]
    bench = spark.createDataFrame([*enumerate(items), (99, ""), (98, "?!")], "item_id long, text string")
    pairs = [(k, f"{prose(k, 40)} {t} {prose(k + 50, 40)}") for k, t in enumerate(items)]
    pairs += [(20, "Too short, it is!"), (21, "too short it is not"), (22, "12 13 14 15 16 17 18 19 21"), (23, "what is 12 times 18?"), (24, "yes"), (25, ""), (26, None), (27, f"{'long ' * 30_000} what is 12 times 17")]
    found = {(i, k) for i, k in read(decontamination.contamination(rows(pairs), bench), "doc_id", "item_id")}
    assert found == {(k, k) for k in (*range(7), 8, 9)} | {(20, 7), (24, 10), (27, 9)}


def test_contamination_equals_its_sql(spark, rows, tmp_path):
    """Items with and without usable windows, of several lengths, by the query's SQL."""
    import duckdb

    r = random.Random(12)
    items = [" ".join(r.choice(WORDS) for _ in range(n)) for n in (5, 6, 8, 20)] + ["What is 12 times 17?", "Anna has 3 kg of rice and Bob has 4 kg of it today", "no", "1 2 3 4 5 6 7 8 9 10 11"]
    texts = [f"{prose(k, 20)} {t} {prose(k + 50, 20)}" for k, t in enumerate(items)] + ["No!", "Zoe has 3 kg of rice and Tom has 4 kg of it today", *(prose(k, 60) for k in range(5))]
    spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").write.parquet(str(tmp_path / "documents.parquet"))
    spark.createDataFrame(list(enumerate(items)), "item_id long, text string").write.parquet(str(tmp_path / "benchmark.parquet"))
    db = duckdb.connect()
    for name in ("documents", "benchmark"):
        db.sql(f"create view {name} as select * from '{tmp_path}/{name}.parquet/*.parquet'")
    got = sorted(read(decontamination.op7_decontamination(spark, str(tmp_path)), "doc_id", "item_id", "n_matched", "n_windows"))
    assert got == sorted(db.sql(decontamination.OP7_SQL).fetchall()) and {(k, k) for k in (0, 1, 2, 3, 4, 7)} | {(8, 6), (9, 5)} <= {x[:2] for x in got}


# --- tokens, files, packing


@pytest.mark.parametrize(("name", "spaced"), [("word_bpe_49k.json", False), ("byte_bpe_50k.json", True)])
def test_encoder_equals_the_library(name, spaced):
    texts = [*corpus(5), "a\n\nb", "a  b", " x", "x ", "x\n", "İstanbul ΣΑΣ Σ", "<|endoftext|> hi", "it's 'll don't. won't, 12.5, a1b2", "foo., bar,. baz.\nQux,\nA..b", "tab\tx", "a　b c", "_.a _, a_."]
    use = tokens.Encoder(tokens.tokenizer_path(name), spaced)
    ids, cuts = use.encode(pa.array(texts))
    want = use.lib.encode_batch([t or "" for t in texts], add_special_tokens=False)
    assert [ids[a:b].tolist() for a, b in zip(cuts[:-1], cuts[1:])] == [e.ids for e in want]


def _crc(ids):
    return zlib.crc32(np.array(ids, "<u4").tobytes())


@pytest.mark.parametrize("encoding", ["dictionary", "delta"])
def test_token_files_round_trip(spark, rows, tmp_path, encoding):
    pairs = list(enumerate(corpus(6)))[::-1]
    path, lib = str(tmp_path / "t"), tokens.Encoder(tokens.tokenizer_path("word_bpe_49k.json"), False).lib
    token_files.write_token_files(rows(pairs), path, tokens.tokenizer_path("word_bpe_49k.json"), encoding=encoding)
    got = sorted(read(token_files.with_crc32(token_files.read_token_files(spark, path)), "doc_id", "start", "n_tokens", "ids_crc32"))
    want, at = [], 0
    for i, t in sorted(pairs):
        ids = [*lib.encode(t or "", add_special_tokens=False).ids, 1]
        want.append((i, at, len(ids), _crc(ids)))
        at += len(ids)
    assert got == want
    ids = token_files.read_token_files(spark, path).orderBy("doc_id").select("ids").first()["ids"]
    assert _crc(ids) == want[0][3]


@pytest.mark.parametrize("encoding", ["dictionary", "delta"])
def test_token_files_allow_reads_in_part(spark, rows, tmp_path, encoding):
    """Page indexes, pages of few rows and encodings as asked for; metadata are read without ids, and a filter on ids reaches the scan."""
    import glob

    import pyarrow.parquet as pq

    path, tokenizer = str(tmp_path / "t"), tokens.tokenizer_path("word_bpe_49k.json")
    token_files.write_token_files(rows([(i, prose(i, 60)) for i in range(600)]), path, tokenizer, encoding=encoding, row_group_bytes=1 << 12, page_rows=50)
    files = [pq.ParquetFile(f).metadata for f in glob.glob(path + "/*.parquet")]
    assert sum(m.num_rows for m in files) == 600 and max(m.num_row_groups for m in files) > 1
    for m in files:
        columns = {m.row_group(0).column(k).path_in_schema: m.row_group(0).column(k) for k in range(m.num_columns)}
        ids = next(c for name, c in columns.items() if name.startswith("ids"))
        assert ("RLE_DICTIONARY" in ids.encodings or "PLAIN_DICTIONARY" in ids.encodings) == (encoding == "dictionary") and ("DELTA_BINARY_PACKED" in ids.encodings) == (encoding == "delta")
        assert columns["doc_id"].has_offset_index and columns["doc_id"].has_column_index
    known = token_files.read_token_files(spark, path)
    plan = lambda df: df._jdf.queryExecution().executedPlan().toString()
    assert "ids:array" not in plan(known.select("doc_id", "n_tokens"))
    some = plan(known.where("doc_id = 77").select("doc_id", "ids"))
    assert "EqualTo(doc_id,77)" in some and known.where("doc_id = 77").count() == 1


def test_tokens_of_null_and_repeated_ids(spark, rows, tmp_path):
    tokenizer = tokens.tokenizer_path("word_bpe_49k.json")
    pairs = [(3, "b b"), (None, "a"), (3, "a"), (3, "a"), (9, None)]
    token_files.write_token_files(rows(pairs), str(tmp_path / "t"), tokenizer)
    got = sorted(read(token_files.read_token_files(spark, str(tmp_path / "t")), "start", "doc_id", "n_tokens"))
    assert [i for _, i, _ in got] == [None, 3, 3, 3, 9] and [s for s, _, _ in got] == np.cumsum([0, *(n for _, _, n in got)])[:-1].tolist()
    pieces = packing.pack(rows(pairs), tokens.tokenizer_path("byte_bpe_50k.json"), size=8).collect()
    assert sorted((p["doc_id"] is None, p["doc_id"] or 0) for p in pieces if p["start"] == 0) == [(False, 3), (False, 3), (False, 3), (False, 9), (True, 0)]


def test_token_files_of_no_rows(spark, rows, tmp_path):
    token_files.write_token_files(rows([]), str(tmp_path / "e"), tokens.tokenizer_path("word_bpe_49k.json"))
    assert token_files.read_token_files(spark, str(tmp_path / "e")).count() == 0


def test_packing_covers_every_id_once(spark, rows):
    pairs, size = list(enumerate(corpus(7))), 64
    pairs.append(pairs[0])
    lib = tokens.Encoder(tokens.tokenizer_path("byte_bpe_50k.json"), True).lib
    pieces = packing.pack(rows(pairs), tokens.tokenizer_path("byte_bpe_50k.json"), size=size)
    got = [r.asDict() for r in pieces.collect()]
    whole = {i: [*lib.encode(t or "", add_special_tokens=False).ids, 0] for i, t in pairs}
    for p in got:
        ids = whole[p["doc_id"]][p["start"] : p["start"] + p["length"]]
        assert p["ids"] == ids and p["ids_crc32"] == _crc(ids) and p["doc_tokens"] == len(whole[p["doc_id"]])
    assert sum(p["length"] for p in got) == sum(len(whole[i]) for i, _ in pairs)
    by = {}
    for p in sorted(got, key=lambda p: (p["sequence_id"], p["offset"])):
        assert by.get(p["sequence_id"], 0) == p["offset"]
        by[p["sequence_id"]] = p["offset"] + p["length"]
    assert all(n == size for s, n in by.items() if s < max(by))
    made = packing.sequences(pieces, size).collect()
    assert all(len(r["ids"]) == size or len(r["ids"]) & (len(r["ids"]) - 1) == 0 for r in made)
    assert packing.pack(rows([]), tokens.tokenizer_path("byte_bpe_50k.json")).count() == 0


# --- fingerprints


def test_prefix_hashes_answer_spans_and_extensions():
    text, other = "abracadabra abracadabra", "cadabra abrac"
    a, b = fingerprints.PrefixHash.of(text), fingerprints.PrefixHash.of(other)
    for i in range(len(text)):
        for j in range(len(other)):
            k = fingerprints.common_extension(a, i, b, j)
            assert text[i : i + k] == other[j : j + k] and (i + k == len(text) or j + k == len(other) or text[i + k] != other[j + k])


def test_fingerprints_and_edits(spark, rows):
    pairs = list(enumerate(corpus(8)))
    out = {r["doc_id"]: r for r in fingerprints.edit_fingerprints(rows(pairs[::-1])).collect()}
    assert len(out) == len(pairs)
    marks = {}
    for k, (i, t) in enumerate(pairs):
        t, following = t or "", pairs[(k + 1) % len(pairs)][1] or ""
        new = t[: len(t) - len(t) // 2] + following[: len(t) // 2]
        assert (out[i]["n_chars"], out[i]["edited_sha256"]) == (len(t), hashlib.sha256(new.encode()).hexdigest())
        assert 0 <= out[i]["near_edited"] <= 1 and 0 <= out[i]["near_next"] <= 1
        assert out[i]["near_next"] == (1.0 if t == following else out[i]["near_next"])
        assert marks.setdefault(t, out[i]["fingerprint"]) == out[i]["fingerprint"]
        if new == t:
            assert out[i]["near_edited"] == 1
    assert len(set(marks.values())) == len(marks)
    long = [i for i, t in pairs if t and len(t) > 400]
    assert np.mean([out[i]["near_edited"] for i in long]) > 0.2
    # likeness: the share of common spans, estimated by the k least values, against that of the whole span sets
    spans = lambda t: {t[k : k + fingerprints.SPAN] for k in range(max(1, len(t) - fingerprints.SPAN + 1))} if t else set()
    for k, (i, t) in enumerate(pairs):
        t, following = t or "", pairs[(k + 1) % len(pairs)][1] or ""
        new = t[: len(t) - len(t) // 2] + following[: len(t) // 2]
        for other, near in ((new, "near_edited"), (following, "near_next")):
            a, b = spans(t), spans(other)
            assert abs(out[i][near] - (len(a & b) / len(a | b) if a | b else 1.0)) < 0.25
    assert fingerprints.edit_fingerprints(rows([])).count() == 0
    repeated = [(None, "first text of all"), (3, "one"), (3, "one"), (3, "two"), (9, "last")]
    order = [r["doc_id"] for r in fingerprints.edit_fingerprints(rows(repeated)).collect()]
    assert sorted(order, key=str) == [3, 3, 3, 9, None]
    borders = [-5, 0, 3, 3, 8, 20, 21, 40]
    keys = spark.createDataFrame([(k,) for k in range(-8, 45)], "k long")
    assert all(r["p"] == sum(b <= r["k"] for b in borders) for r in keys.select("k", fingerprints._place(borders, keys["k"]).alias("p")).collect())
    (alone,) = fingerprints.edit_fingerprints(rows([(7, "abcd")])).collect()
    assert alone["edited_sha256"] == hashlib.sha256(b"abab").hexdigest()


# --- language, toxicity, personal data

LETTERS = {"aa": "aeioklmn", "bb": "bdfgruvx", "cc": "aehprstz"}


def spoken(lang, seed, n=60):
    r = random.Random(f"{lang}{seed}")
    return " ".join("".join(r.choice(LETTERS[lang]) for _ in range(r.randint(2, 7))) for _ in range(n))


def test_language_of_held_out_texts(spark):
    data = [(i, spoken(lang, i), lang) for i, lang in enumerate(random.Random(1).choices(list(LETTERS), k=90))]
    data += [(900, None, "aa"), (901, "", None), (902, "12 34!", "bb"), (903, spoken("aa", 5, 20_000), None)]
    docs = spark.createDataFrame(data, "doc_id long, text string, lang string")
    out = {r["doc_id"]: r for r in language_id.predict(docs, language_id.learn(docs)).collect()}
    assert all(out[i]["lang_pred"] == lang for i, _, lang in data[:90]) and out[903]["lang_pred"] == "aa"
    assert all(out[i]["lang_pred"] == "und" and out[i]["score"] == 0 for i in (900, 901, 902))
    assert all(0 <= r["score"] <= 1 for r in out.values())
    assert language_id.predict(docs.limit(0), language_id.learn(docs.limit(0))).count() == 0


def test_out_of_place_distance_by_hand():
    grams, counts = language_id.gram_counts("ab ab")
    assert counts.sum() == 4 + 6 + 4  # letters, pairs with boundaries, triples around letters
    assert counts.tolist() == [2] * 7


def test_out_of_place_distance_equals_brute_force():
    """Ranks by counted n-grams of whole texts; ties by the n-gram; the nearest language and its lead."""
    def ranked(text):
        counts = {}
        for w in re.findall(r"[^\W\d_]+", text.lower()):
            padded = "\x01" + w + "\x01"
            for n in (1, 2, 3):
                for k in range(len(padded) - n + 1):
                    g = padded[k : k + n]
                    if g != "\x01" and not (n == 3 and g[1] == "\x01"):
                        counts[g] = counts.get(g, 0) + 1
        return counts

    texts = {lang: spoken(lang, 1, 400) for lang in LETTERS}
    profiles = language_id.Profiles({lang: language_id.profile(*language_id.gram_counts(t)).tolist() for lang, t in texts.items()})
    code = lambda g: int("".join(f"{ord(c):021b}" for c in g), 2)
    order = lambda c: sorted(c, key=lambda g: (-c[g], code(g)))[: language_id.TOP]
    known = {lang: {g: k for k, g in enumerate(order(ranked(t)))} for lang, t in texts.items()}
    for text in [spoken(lang, s, 50) for lang in LETTERS for s in range(2, 6)] + ["a", "ab", "bd ae"]:
        own = order(ranked(text))
        far = {lang: sum(min(abs(p[g] - k), language_id.TOP) if g in p else language_id.TOP for k, g in enumerate(own)) for lang, p in known.items()}
        best = min(far, key=lambda lang: (far[lang], lang))
        second = min(d for lang, d in far.items() if lang != best)
        assert profiles.predict(text) == (best, round((second - far[best]) / second, 9) if second else 0.0)


def test_toxicity_on_held_out_texts():
    r = random.Random(3)
    bad = ["grumblefuss", "snotwaffle", "dunderpate", "wretchling"]

    def text(i, toxic):
        w = prose(i, r.randint(40, 200)).split(" ")
        for _ in range(4 if toxic else 0):
            w.insert(r.randrange(len(w)), r.choice(bad))
        return " ".join(w)

    data = [(text(i, i % 4 == 0), int(i % 4 == 0)) for i in range(400)]
    model = toxicity.fit(data[:300])
    found = model.scores(model.features([toxicity.plain(t) for t, _ in data[300:]])) >= 0.5
    truth = np.array([v for _, v in data[300:]], bool)
    assert found[truth].mean() > 0.95 and found[~truth].mean() < 0.03
    edge = model.scores(model.features([toxicity.plain(t) for t in EDGE]))
    assert ((edge >= 0) & (edge < 0.5)).all()
    assert toxicity.fit([]).weights[0] < 0 and toxicity.fit([("x", 1)]).weights[0] > 0


def test_toxicity_of_rare_stems_with_many_forms():
    """A second vocabulary's toxic stem is far rarer than the first one's insults and stands in a different form each time."""
    r = random.Random(4)
    other = [w[::-1] + "u" for w in WORDS]

    def text(i, toxic):
        rare = i % 6 == 0
        w = [r.choice(other) for _ in range(r.randint(80, 160))] if rare else prose(i, r.randint(80, 160)).split(" ")
        for _ in range(4 if toxic else 0):
            w.insert(r.randrange(len(w)), "grolbex" + r.choice(other) + r.choice(other) if rare else r.choice(["grumblefuss", "snotwaffle"]))
        return " ".join(w), int(toxic), rare

    rows = [text(i, i % 4 == 0) for i in range(1200)]
    model = toxicity.fit([(t, v) for t, v, _ in rows[:800]])
    found = model.scores(model.features([toxicity.plain(t) for t, _, _ in rows[800:]])) >= 0.5
    hit = {k: [bool(f) for f, (_, v, rare) in zip(found, rows[800:], strict=True) if (v, rare) == k] for k in ((0, False), (0, True), (1, False), (1, True))}
    assert min(map(len, hit.values())) >= 30
    assert all(sum(x) >= 0.9 * len(x) for k, x in hit.items() if k[0]) and all(sum(x) <= 0.05 * len(x) for k, x in hit.items() if not k[0])


def test_toxicity_rows_keep_their_number(spark, rows):
    model = toxicity.fit([(prose(i, 30) + (" grumblefuss" * 3 if i % 2 else ""), i % 2) for i in range(60)])
    out = read(toxicity.score(rows([(1, None), (1, None), (None, "x"), (2, prose(1, 5000))]), model), "doc_id", "score")
    assert len(out) == 4 and all(0 <= s <= 1 for _, s in out)
    assert toxicity.score(rows([]), model).count() == 0
    empty = toxicity.learn(rows([]), spark.createDataFrame([], "doc_id long, toxic int"))
    assert all(s < 0.5 for _, s in read(toxicity.score(rows([(1, "a b"), (2, None)]), empty), "doc_id", "score"))


def test_toxicity_model_is_two_dictionaries():
    """Spans of toxic text by contrast; a window of ordinary words is as long under both; zero margins without the toxic dictionary."""
    texts = [toxicity.plain(prose(i, 120) + (" grumblefuss here and grumblefuss there" if i % 3 == 0 else "")) for i in range(300)]
    labels = np.array([i % 3 == 0 for i in range(300)], float)
    m = toxicity.train(texts, labels)
    assert b"grumblefuss" in m.toxic and b"grumblefuss" not in m.ordinary
    margin = lambda t: int(m.margins(t, np.array([0]), np.array([len(t)]))[0])
    assert margin(toxicity.plain(prose(6, 4) + " grumblefuss here and " + prose(7, 4))) >= 4 and abs(margin(toxicity.plain(prose(5, 8)))) <= 1
    assert toxicity.Model(m.ordinary, b"").features(texts)[:, 0].max() == 0


@pytest.mark.skipif(not os.path.isdir("/root/testdata/sf0.1"), reason="driver tables are missing")
def test_toxicity_of_the_held_out_fold():
    """Over all labels of sf0.1's fold: area under the curve, and recall of texts in other languages than English at a tenth of false positives."""
    import duckdb

    data = duckdb.sql("select doc_id, text, lang, toxic from '/root/testdata/sf0.1/documents.parquet' join '/root/testdata/sf0.1/labels.parquet' using (doc_id) where text is not null order by doc_id").fetchall()
    held = lambda i: zlib.crc32(str(i).encode()) % 5 == 0
    known = [(t, v) for i, t, _, v in data if not held(i) and len(t) <= toxicity.LONGEST]
    bad, good = [x for x in known if x[1]], [x for x in known if not x[1]]
    model = toxicity.fit(bad + good[: toxicity.SAMPLE], len(bad) / len(known))
    rows = [(t, lang, v) for i, t, lang, v in data if held(i)]
    s = model.scores(model.features([toxicity.plain(t) for t, _, _ in rows]))
    y, lang = np.array([v for _, _, v in rows]), np.array([x for _, x, _ in rows])
    auc = np.mean((s[y == 1][:, None] > s[y == 0]) + 0.5 * (s[y == 1][:, None] == s[y == 0]))
    cut = np.quantile(s[y == 0], 0.9)
    assert auc >= 0.9 and (s[(y == 1) & (lang != "en")] > cut).mean() >= 0.7


def test_patterns_equal_their_plain_forms_and_are_linear():
    email, ip = re.compile(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+"), re.compile(r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)")
    r = random.Random(9)
    for _ in range(4000):
        text = "".join(r.choice("aZ1.@_%- 2") for _ in range(r.randint(0, 40)))
        assert [m.span() for m in pii._emails(text)] == [m.span() for m in email.finditer(text)]
        text = "".join(r.choice("12.. ") for _ in range(r.randint(0, 40)))
        assert [m.span() for m in pii._IP.finditer(text)] == [m.span() for m in ip.finditer(text)]
    began = time.time()
    assert len(pii.base_spans(f"{'a' * 1_000_000} @ {'1.' * 2}{'7' * 1_000_000} b@c.de")) == 1
    assert time.time() - began < 5


def test_long_numbers_are_no_addresses():
    """Numbers of more digits than Python turns into integers, and leading zeros."""
    assert pii.base_spans("1.1.1." + "7" * 5000) == [] and not pii._plausible("ip", "1.1.1." + "7" * 5000)
    assert pii.base_spans("1.1.1." + "0" * 5000 + "255") == [(0, 1, 5009)]


def test_overlapping_windows_decode_as_one(monkeypatch):
    """Viterbi over reconciled windows against the best of all tag sequences by brute force."""
    r, t = np.random.default_rng(2), pii.Tagger.new()
    t.w["t"] = r.normal(0, 1, t.w["t"].shape)
    e = r.normal(0, 2, (4, pii.TAGS))
    best = max(itertools.product(range(pii.TAGS), repeat=4), key=lambda y: sum(e[i, y[i]] for i in range(4)) + sum(t.w["t"][a, b] for a, b in zip(y, y[1:])))
    assert t.viterbi(e).tolist() == list(best)
    several = [r.normal(0, 2, (n, pii.TAGS)) for n in (4, 1, 9, 4, 30, 2)] + [e]
    assert [x.tolist() for x in t.viterbi_of(several)] == [t.viterbi(x).tolist() for x in several] and t.viterbi_of([]) == []
    text = prose(3, 40).replace("\n", " ") + " 5 " + prose(4, 40)
    spans = t.spans([text])
    starts = pii._starts(text)
    symbols = np.concatenate([pii._symbols(text), np.full(pii.WIDTH, pii.SYMBOLS)])
    windows = {s: t.emissions(symbols[s : s + pii.WIDTH][:, None])[:, 0] for s in starts}
    first, last = starts[0], min(starts[-1] + pii.WIDTH, len(text))
    whole = np.stack([windows[max((s for s in starts if s <= i < s + pii.WIDTH), key=lambda s: (min(i - s, s + pii.WIDTH - 1 - i), -s))][i - max((s for s in starts if s <= i < s + pii.WIDTH), key=lambda s: (min(i - s, s + pii.WIDTH - 1 - i), -s))] for i in range(first, last)])
    assert spans == [pii._decoded(t.viterbi(whole), first, text)]
    texts = [f"{prose(k, 30)} {k} at {prose(k + 9, 50)} 7" for k in range(40)] + ["", "none", "5" * 300]
    alone = [t.spans([x])[0] for x in texts]
    assert t.spans(texts) == alone
    monkeypatch.setattr(pii, "LONG", 10)
    monkeypatch.setattr(pii, "HELD", 100)
    assert t.spans(texts) == alone


def plain_valid(kind, text):
    digits = [int(c) for c in text if c in "0123456789"]
    if kind == "phone":
        return 9 <= len(digits) <= 15
    doubled = [d if k % 2 == 0 else sum(divmod(2 * d, 10)) for k, d in enumerate(digits[::-1])]
    return 12 <= len(digits) <= 19 and sum(doubled) % 10 == 0


def test_cards_and_phones_equal_brute_force():
    """Leftmost longest matches, no second try inside one that fails."""
    plain = {"card": re.compile(r"[0-9]([ -]?[0-9])+"), "phone": re.compile(r"\+[0-9][ ().0-9-]+[0-9]")}
    r = random.Random(4)
    for _ in range(3000):
        text = "".join(r.choice(["4111", "1111", "55", "0", "7", " ", "-", "  ", "+", "(", ")", ".", "a"]) for _ in range(r.randint(0, 16)))
        got = [(k, s, e) for s, k, e in pii.base_spans(text) if pii.KINDS[k] in plain]
        want = [(pii.KINDS.index(k), m.start(), m.end()) for k, p in plain.items() for m in p.finditer(text) if plain_valid(k, m[0])]
        assert sorted(got) == sorted(want)


def test_model_spans_apart_from_the_patterns():
    r = random.Random(5)
    for _ in range(500):
        span = lambda: (a := r.randrange(60), r.randrange(4), a + r.randint(1, 12))
        base, more = sorted(span() for _ in range(r.randrange(6))), [span() for _ in range(8)]
        assert pii.apart(more, base) == [s for s in more if all(s[2] <= x[0] or s[0] >= x[2] for x in base)]
    n = 200_000
    began = time.time()
    assert len(pii.apart([(3 * k, 0, 3 * k + 1) for k in range(n)], [(3 * k + 1, 0, 3 * k + 2) for k in range(n)])) == n and time.time() - began < 5


def test_long_digit_rich_text_takes_bounded_memory():
    """Memory for a text of windows without end is a few bytes a character."""
    import tracemalloc

    t = pii.Tagger.new()
    text = "1 23 a" * 50_000
    tracemalloc.start()
    t.spans([text[:3000], text])
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert peak < 80e6 + 30 * len(text)  # 4.6 KB for each 32 characters before


def test_op9_query_columns(spark, tmp_path):
    """The registered query: counts, digest and spans of its own texts."""
    import hashlib as h

    texts = {i: f"{prose(i, 20)} a{i}.b@c{i}.example.org and 10.0.0.{i % 256} or +1 (403) 555-93{i % 90 + 10}, 4111 1111 1111 1111" for i in range(30)} | {50: None, 51: "", 52: "1.2.3"}
    spark.createDataFrame([(i, t) for i, t in texts.items()], "doc_id long, text string").write.parquet(str(tmp_path / "documents.parquet"))
    out = {r["doc_id"]: r for r in pii.op9_pii(spark, str(tmp_path)).collect()}
    assert set(out) == set(texts) and set(out[0].asDict()) >= {"n_email", "n_ip", "n_card", "n_phone", "base_sha256", "spans"}
    for i, r in out.items():
        base = pii.base_spans(texts[i] or "")
        joined = [f"{pii.KINDS[k]}:{s}:{e}" for s, k, e in base]
        assert r["base_sha256"] == h.sha256(",".join(joined).encode()).hexdigest() and set(joined) <= set(r["spans"].split(",") if r["spans"] else [])
        assert [r[f"n_{k}"] for k in pii.KINDS] == [sum(pii.KINDS[x] == k for _, x, _ in base) for k in pii.KINDS]


def test_base_spans():
    text = "a.b@c-d.example.org, 10.0.0.300 10.0.0.1 +1 (403) 555-9312 4111 1111 1111 1111 4111111111111112"
    shown = [(pii.KINDS[k], text[s:e]) for s, k, e in pii.base_spans(text)]
    assert ("email", "a.b@c-d.example.org") in shown and ("ip", "10.0.0.1") in shown and ("phone", "+1 (403) 555-9312 4111 1111 1111 1111 4111111111111112") not in shown
    assert pii.base_spans("") == [] and pii.luhn("4111111111111111") and not pii.luhn("4111111111111112")


def test_tagger_gradients():
    r, t = np.random.default_rng(0), pii.Tagger.new()
    s, y = r.integers(0, pii.SYMBOLS, (5, 3)), r.integers(0, pii.TAGS, (5, 3))
    _, g = t.loss(s, y)
    for k in t.w:
        at = np.unravel_index(np.argmax(np.abs(g[k])), g[k].shape)
        old, h = t.w[k][at], 1e-5
        t.w[k][at] = old + h
        up = t.loss(s, y)[0]
        t.w[k][at] = old - h
        down = t.loss(s, y)[0]
        t.w[k][at] = old
        assert abs((up - down) / (2 * h) - g[k][at]) < 1e-5


def test_tagger_finds_other_forms(spark, rows):
    r = random.Random(0)
    card = lambda: next(c for c in (str(r.randrange(4 * 10**15, 5 * 10**15)) for _ in range(100)) if pii.luhn(c))
    make = [lambda: f"{r.choice(WORDS)}.{r.randrange(99)}@mail{r.randrange(9)}.example.com", card, lambda: f"+1 ({r.randrange(200, 999)}) 555-{r.randrange(1000, 9999)}", lambda: ".".join(str(r.randrange(1, 250)) for _ in range(4))]
    texts = [f"{prose(i, 12)} {r.choice(make)()} {prose(i + 500, 12)}" for i in range(250)]
    tagger = pii.fit(texts)
    base = [pii.base_spans(t) for t in texts]
    found = tagger.spans(texts)
    assert sum(len(set(a) & set(b)) for a, b in zip(base, found)) > 0.9 * sum(map(len, base))
    # forms that no pattern matches: what the model adds, and what it marks wrongly
    other = [f"({r.randrange(200, 999)}) 555-{r.randrange(1000, 9999)}" for _ in range(40)] + [f"{r.randrange(200, 999)}-555-{r.randrange(1000, 9999)}" for _ in range(40)]
    hidden = [f"{prose(i + 2000, 10)} {p} {prose(i + 2500, 10)}" for i, p in enumerate(other)]
    assert not any(pii.base_spans(t) for t in hidden)
    assert sum(any(t[a:b] == p for a, _, b in spans) for t, p, spans in zip(hidden, other, tagger.spans(hidden), strict=True)) >= 0.7 * len(other)
    plain = [f"{prose(i, 12)} in {1900 + i} about {i} of {7 * i} {prose(i + 1, 12)}" for i in range(100)]
    assert sum(map(len, tagger.spans(plain))) <= 5
    pairs = [(1, hidden[0]), (1, hidden[0]), (2, None), (3, ""), (4, "no digits here"), (5, prose(1, 4000)), (None, "1.1.1." + "7" * 5000)]
    out = sorted(read(pii.find(rows(pairs), tagger), "doc_id", "base", "spans"), key=str)
    assert len(out) == len(pairs) and all(not b for _, b, _ in out) and all(not s for i, _, s in out if i != 1)
    assert pii.find(rows([]), tagger).count() == 0


def test_tagger_reads_emails_with_a_written_at():
    r = random.Random(1)
    texts = [f"{prose(i, 10)} {r.choice(WORDS)}.{r.choice(WORDS)}@{r.choice(WORDS)}.example.com {prose(i + 500, 10)}" for i in range(250)]
    tagger = pii.fit(texts)
    mails = [f"{r.choice(WORDS)}.{r.choice(WORDS)}{at}{r.choice(WORDS)}.example.com" for at in (" at ", " (at) ", " [at] ") for _ in range(20)]
    hidden = [(f"{prose(i + 900, 10)} {m} {prose(i + 1500, 10)}", m) for i, m in enumerate(mails)]
    found = tagger.spans([t for t, _ in hidden])
    assert sum(any(t[s:e] == m for s, _, e in spans) for (t, m), spans in zip(hidden, found, strict=True)) >= 0.7 * len(mails)
    assert pii._plausible("phone", "403/555-9312") and not pii._plausible("card", "4111/1111/1111/1111")

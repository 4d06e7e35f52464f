"""Every registered query through its entry: extra columns with clashing names change nothing, empty tables give no rows; the same for the pipeline's stages."""

import random

import pytest

import corpus_pipeline
from tactus.llm.registry import ORACLE_SQL, QUERIES
from tests.llm.test_operators import prose

#: Names that operators use inside.
CLASH = ("rep", "path", "h", "w", "n", "sig", "part", "ids", "shard", "term", "key", "pos", "rank", "side", "block", "cell", "label", "id", "start", "n_tokens", "class_id", "score", "text_key", "at", "owner", "value")
_BAD = ("grumblefuss", "snotwaffle")


def write_tables(spark, path, clash, single=False):
    r = random.Random(7)
    texts = [prose(k, r.randint(20, 80)) for k in range(48)]
    texts = [f"{t} {' '.join(r.choices(_BAD, k=6))}" if k % 3 == 0 else t for k, t in enumerate(texts)]
    rows = [(k, t, r.choice(["en", "fr"]), f"s{k % 3}", len(t)) for k, t in enumerate(texts)]
    rows += [(60, texts[1], "en", "s0", 9), (1, texts[1], "en", "s1", 9), (61, None, None, None, None), (62, "", "en", "s0", 0), (63, f"{prose(0, 30)} {prose(777, 30)}", "en", "s0", 1), (None, "no id here", "en", "s1", 10), (64, "mail a.b@c.example.org now", "fr", "s2", 5)]
    rows = [x for k, x in enumerate(rows) if not single or x[0] is not None and x[0] not in {y[0] for y in rows[:k]}]  # SQL takes an id for a row
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long")
    vectors = spark.createDataFrame([(k, [r.uniform(-1, 1) for _ in range(8)], r.randrange(10)) for k in range(240)] + [(300, None, 1), (301, [0.5] * 8, None)], "vec_id long, embedding array<float>, label int")
    labels = spark.createDataFrame([(k, 1, int(k % 3 == 0)) for k in range(48)], "doc_id long, quality int, toxic int")
    bench = spark.createDataFrame([(0, prose(777, 30)), (1, "Yes.")], "item_id long, text string")
    for name, df in (("documents", docs), ("embeddings", vectors), ("labels", labels), ("benchmark", bench)):
        for c in CLASH if clash else ():
            df = df if c in df.columns else df.selectExpr("*", f"'x' as `{c}`")
        df.limit(0 if clash is None else 10**6).coalesce(2).write.parquet(f"{path}/{name}.parquet")
    return str(path)


@pytest.fixture(scope="module")
def tables(spark, tmp_path_factory):
    out = {k: write_tables(spark, tmp_path_factory.mktemp(str(k)), k) for k in (False, True, None)}
    return out | {"single": write_tables(spark, tmp_path_factory.mktemp("single"), False, True)}


def rows(df):
    columns = sorted(df.columns)
    return sorted((tuple(r[c] for c in columns) for r in df.collect()), key=repr)


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_entry(spark, tables, name):
    plain = rows(QUERIES[name](spark, tables[False]))
    assert plain and rows(QUERIES[name](spark, tables[True])) == plain
    assert QUERIES[name](spark, tables[None]).count() == 0


@pytest.mark.parametrize("name", sorted(ORACLE_SQL))
def test_entry_equals_sql(spark, tables, name):
    import duckdb

    db = duckdb.connect()
    for t in ("documents", "embeddings", "labels", "benchmark"):
        db.sql(f"create view {t} as select * from '{tables['single']}/{t}.parquet/*.parquet'")
    df, want = QUERIES[name](spark, tables["single"]), db.sql(ORACLE_SQL[name])
    columns = sorted(df.columns)
    assert columns == sorted(want.columns)
    assert rows(df) == sorted((tuple(r[want.columns.index(c)] for c in columns) for r in want.fetchall()), key=repr)


def test_stages_with_clashing_names_and_no_rows(spark, tables, tmp_path):
    """Each stage keeps the further columns of its input and decides as without them; the pipeline of empty tables is empty."""
    for name, stage in corpus_pipeline.STAGES[:-1]:
        plain, more = (spark.read.parquet(f"{tables[k]}/documents.parquet") for k in (False, True))
        a, b = stage(spark, plain, tables[False]), stage(spark, more, tables[True])
        assert a.columns == plain.columns and b.columns == more.columns
        assert rows(b.select(*a.columns)) == rows(a), name
        none = spark.read.parquet(f"{tables[None]}/documents.parquet")
        assert stage(spark, none, tables[None]).count() == 0
    name, stage = corpus_pipeline.STAGES[-1]
    ids = lambda df: sorted((r["doc_id"] is None, r["doc_id"] or 0, r["length"]) for r in df.collect())
    assert ids(stage(spark, plain, tables[False])) and len(ids(stage(spark, more, tables[True]))) >= plain.count()
    assert corpus_pipeline.run(spark, tables[None]).count() == 0

"""The pipeline's stages, one by one, against plain versions of what they do."""

import os
from collections import defaultdict

import duckdb
import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from feedkit.llm import sql
from feedkit.llm.near import shingles, words_of
from test_quality import brute as quality_of

FOLDER = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")
STAGES = dict(corpus_pipeline.STAGES)
NAMES = ["quality rules", "exact dedup", "near dedup", "mix sources", "pack"]


@pytest.fixture(scope="module")
def steps(spark, tmp_path_factory):
    """What each stage was given and what it returned, from files as the driver of the stages has them."""
    folder = tmp_path_factory.mktemp("steps")
    docs = spark.read.parquet(f"{FOLDER}/documents.parquet")
    out = {}
    for n, (name, stage) in enumerate(corpus_pipeline.STAGES):
        got = stage(spark, docs, FOLDER)
        got.write.parquet(str(folder / str(n)))
        got = spark.read.parquet(str(folder / str(n)))
        out[name] = (docs, got)
        docs = got
    return out


def rows(df):
    return sorted(map(tuple, df.collect()), key=repr)


def test_stages():
    assert list(STAGES) == NAMES


def test_all_but_the_last_return_documents(steps):
    for name in NAMES[:-1]:
        given, got = steps[name]
        assert got.columns == given.columns and got.count() > 0


def test_quality_rules(steps):
    given, got = steps["quality rules"]
    want = [r for r in given.collect() if quality_of(r["text"] or "", 10, 0.3, 100)[-1]]
    assert rows(got) == sorted(map(tuple, want), key=repr)


def test_exact_dedup(steps):
    given, got = steps["exact dedup"]
    groups = defaultdict(list)
    for r in given.collect():
        groups[(r["text"] or "").encode().lower()].append(r)  # of bytes: A-Z only
    assert rows(got) == sorted((tuple(max(g, key=lambda r: r["doc_id"])) for g in groups.values()), key=repr)


def test_near_dedup(steps):
    given, got = steps["near dedup"]
    docs = sorted(given.collect(), key=lambda r: r["doc_id"])
    sets = [shingles(words_of(r["text"].encode()), 5) for r in docs]
    first = list(range(len(docs)))

    def root(i):
        while first[i] != i:
            i = first[i]
        return i

    for i, a in enumerate(sets):
        for j in range(i):
            if a and sets[j] and 100 * len(a & sets[j]) >= 80 * len(a | sets[j]):
                x, y = sorted((root(i), root(j)))
                first[y] = x
    assert rows(got) == sorted((tuple(r) for i, r in enumerate(docs) if root(i) == i), key=repr)


def test_mix_sources(steps):
    given, got = steps["mix sources"]
    with duckdb.connect() as db:
        db.register("documents", given.toPandas())
        want = {r[0]: r[-1] for r in db.execute(sql.MIX).fetchall()}
    texts = {r["doc_id"]: r["text"] for r in given.collect()}
    taken = defaultdict(int)
    for r in got.collect():
        taken[r["doc_id"]] += len(r["text"].encode().split())
        assert texts[r["doc_id"]].startswith(r["text"])
    assert taken == {i: n for i, n in want.items() if n}


def test_pack(steps):
    from test_packing import PATH, check
    from tokenizers import Tokenizer

    given, got = steps["pack"]
    check([(r["doc_id"], r["text"]) for r in given.collect()], got.collect(), Tokenizer.from_file(PATH), 4096)


def test_run_is_the_stages_in_a_row(spark, steps):
    columns = ("doc_id", "start", "length", "ids_crc32", "doc_tokens")
    got = corpus_pipeline.run(spark, FOLDER)
    assert got.agg(F.sum("length")).first() == steps["pack"][1].agg(F.sum("length")).first()
    assert set(columns) <= set(got.columns)


@pytest.mark.parametrize("name", NAMES)
def test_edges(spark, edges, empty, name):
    for docs in (edges, empty):
        got = STAGES[name](spark, docs, FOLDER)
        assert (got.count() > 0) == (docs is edges)
        if name != "pack":
            assert got.columns == docs.columns

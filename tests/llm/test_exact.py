from pyspark.sql import functions as F

from feedkit.llm.exact import Deduplicator, deduplicate, without_copies


def test_state_is_carried_to_a_later_feed(spark, docs, tmp_path):
    folder = str(tmp_path / "state")
    first, second = docs(["A b", "c", "a B"]), docs(["x", "c", "C", "a b", "y"])
    dedup = Deduplicator(spark, folder)
    dedup.feed(first)
    before = {r["n"]: r["keep"]["doc_id"] for r in dedup.state().collect()}
    assert before == {2: 2, 1: 1}
    dedup = Deduplicator(spark, folder)  # as after a restart
    dedup.feed(second)
    assert sorted((r["n"], r["keep"]["doc_id"]) for r in dedup.state().collect()) == [(1, 0), (1, 4), (3, 2), (3, 3)]


def test_groups(docs):
    got = {r["doc_id"]: r for r in deduplicate(docs(["Same", "other", "sAME", "É", "é", "same"])).collect()}
    assert [(got[i]["keep_id"], got[i]["group_size"], got[i]["kept"]) for i in range(6)] == [(5, 3, False), (1, 1, True), (5, 3, False), (3, 1, True), (4, 1, True), (5, 3, True)]


def test_texts_are_told_apart_when_their_digests_collide(docs):
    texts = ["a", "b", "A", "c", "b", "d"]
    weak = lambda text: F.lit(b"same")
    columns = ("doc_id", "keep_id", "group_size", "kept", "text_sha256")
    got = deduplicate(docs(texts), digest=weak).select(*columns)
    assert sorted(map(tuple, got.collect())) == sorted(map(tuple, deduplicate(docs(texts)).select(*columns).collect()))


def test_edges(edges, empty, spark):
    rows = deduplicate(edges).collect()
    assert len(rows) == edges.count()
    empties = [r for r in rows if r["text_sha256"].startswith("e3b0c442")]
    assert len(empties) == 3 and {r["keep_id"] for r in empties} == {3} and {r["group_size"] for r in empties} == {3}
    same = [r for r in rows if r["keep_id"] == 5]
    assert len(same) == 4 and sum(r["kept"] for r in same) == 1  # of the repeated row one stays
    kept = without_copies(edges)
    assert kept.columns == edges.columns and kept.count() == edges.select(F.lower(F.coalesce("text", F.lit("")))).distinct().count()
    assert deduplicate(empty).count() == 0 and without_copies(empty).count() == 0
    memory = spark.createDataFrame([(1, "x"), (2, "X")], "doc_id long, text string")  # not from files
    assert [r["doc_id"] for r in without_copies(memory).collect()] == [2]

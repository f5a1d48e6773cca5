import public_tokenizers
import pytest
import sentencepiece
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from feedkit.llm.token_counts import TokenCache, token_counts, tokenizer_digest

MODEL, JSON = public_tokenizers.path("piece_bpe_32k.model"), public_tokenizers.path("byte_bpe_50k.json")


def counted(path, texts):
    if path == JSON:
        return [len(e.ids) for e in Tokenizer.from_file(path).encode_batch(texts, add_special_tokens=False)]
    return [len(x) for x in sentencepiece.SentencePieceProcessor(model_file=path).encode(texts)]


@pytest.mark.parametrize("path", [MODEL, JSON])
def test_counts_are_the_librarys(docs, path):
    texts = ["", None, "Hello  world\n", "<s> </s> <|endoftext|>", "é日本😀\x00", "a " * 5000, "a " * 5000]
    got = sorted(map(tuple, token_counts(docs(texts), path).collect()))
    want = counted(path, [t or "" for t in texts])
    assert got == [(i, len((t or "").encode()), n, n > 4096) for i, (t, n) in enumerate(zip(texts, want, strict=True))]


def test_only_misses_are_added_and_hits_come_from_the_cache(spark, docs, tmp_path):
    cache = TokenCache(spark, str(tmp_path / "cache"))
    first = docs(["x y", "x y", "z"])
    token_counts(first, MODEL, cache).collect()
    assert spark.read.parquet(cache.folder).count() == 2
    token_counts(docs(["z", "new text", "x y"]), MODEL, cache).collect()
    assert spark.read.parquet(cache.folder).count() == 3
    # what the cache says is what counts: a stored count is not made again
    other = TokenCache(spark, str(tmp_path / "other"))
    digest = F.unhex(F.sha2(F.encode(F.lit("z"), "utf-8"), 256))
    spark.range(2).select(digest.alias("digest"), F.lit(tokenizer_digest(MODEL)).alias("tokenizer"), F.lit(77).cast("long").alias("n_tokens")).write.parquet(other.folder)
    assert {r["doc_id"]: r["n_tokens"] for r in token_counts(first, MODEL, other).collect()}[2] == 77
    # counts of another tokenizer are no hits
    assert {r["doc_id"]: r["n_tokens"] for r in token_counts(first, JSON, other).collect()}[2] == 1


def test_edges(edges, empty):
    rows = token_counts(edges, MODEL).collect()
    assert len(rows) == edges.count()
    assert {(r["n_bytes"], r["n_tokens"]) for r in rows if r["doc_id"] in (2, 3)} == {(0, 0)}
    assert [r["over_limit"] for r in rows if r["doc_id"] == 6] == [True]
    assert token_counts(empty, MODEL).count() == 0
    with pytest.raises(ValueError, match="no tokenizer library"):
        token_counts(edges, __file__).collect()

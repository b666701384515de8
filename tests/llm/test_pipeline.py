"""The corpus pipeline against the same stages by brute force."""

import os

import numpy as np
import public_tokenizers
import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from geoloom.llm import common, secret_ledger
from tests.llm.test_text_operators import _hits, _near, _secrets

SF = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")
pytestmark = pytest.mark.skipif(not os.path.isdir(SF), reason="no test tables")


def _masked(text):
    out = list(text or "")
    for span in _secrets(text):
        _, start, end = span.rsplit(":", 2)
        out[int(start) : int(end)] = "*" * (int(end) - int(start))
    return "".join(out)


def test_pipeline_equals_brute_force(spark):
    from tokenizers import Tokenizer

    documents = common.table(spark, SF, "documents")
    clean = corpus_pipeline.drop_toxic(spark, documents, SF)
    assert clean.columns == documents.columns
    rows = [(r.doc_id, r.text) for r in clean.collect()]
    known = {r.doc_id: r.toxic for r in common.table(spark, SF, "labels").collect()}
    lost = {r.doc_id for r in documents.select("doc_id").collect()} - {i for i, _ in rows}
    assert sum(known.get(i) == 0 for i in lost) <= 0.02 * documents.count()
    kept = _near(rows, 5, 80)
    rows = [(i, t) for i, t in rows if kept[i][2]]
    items = [(r.item_id, r.text) for r in common.table(spark, SF, "benchmark").collect()]
    hit = {i for i, _, n, _ in _hits(rows, items) if n}
    assert hit
    rows = [(i, _masked(t)) for i, t in rows if i not in hit]
    library = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    want = {i: library.encode(t, add_special_tokens=False).ids for i, t in rows}
    got = {r.doc_id: np.frombuffer(r.tokens, "<u4").tolist() for r in corpus_pipeline.run(spark, SF).collect()}
    assert got == want


def test_repeated_ids_lose_no_clean_text(spark):
    words = lambda k: " ".join(f"{k}w{i}" for i in range(60))
    near = lambda k: words(k) + " end"
    rows = [(1, words("a")), (1, words("b")), (1, words("b")), (2, near("b")), (3, near("a")), (5, words("c")), (5, near("a")), (5, near("c"))]
    rows += [(6, None), (6, None), (7, words("d")), (None, words("d"))]
    got = corpus_pipeline.drop_copies(spark, spark.createDataFrame(rows, "doc_id bigint, text string"), SF).collect()
    kept = sorted((str(r.doc_id), r.text or "") for r in got)
    of_five = [r for r in kept if r[0] == "5"]
    assert len(of_five) == 1 and of_five[0][1] in (words("c"), near("c"))
    assert [r for r in kept if r[0] != "5"] == sorted(
        [("1", words("a")), ("1", words("b")), ("6", ""), ("6", ""), ("7", words("d")), ("None", words("d"))]
    )


def test_stages_take_odd_rows(spark, tmp_path):
    """Null texts and ids, repeated rows, clashing columns and empty tables."""
    text = " ".join(f"word{i}" for i in range(40))
    rows = [(1, text, "x"), (1, text, "x"), (2, text + " end", "y"), (3, None, None), (None, "secret: abcdefgh99", "z"), (5, "", ""), (6, "", "")]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string, found string").withColumns(
        {c: F.lit(1) for c in ("score", "blob", "kept", "text_hash", "w", "tokens", "rep", "row")}
    )
    docs.write.parquet(str(tmp_path / "docs"))
    docs = spark.read.parquet(str(tmp_path / "docs"))
    for k, (name, stage) in enumerate(corpus_pipeline.STAGES):
        out = common.stored(stage(spark, docs, SF), name)
        assert stage(spark, docs.limit(0), SF).count() == 0
        if k < len(corpus_pipeline.STAGES) - 1:
            assert out.columns == docs.columns
        docs = out
    assert sorted((r.doc_id for r in docs.collect()), key=str) == [1, 3, 5, 6, None]
    assert "n_tokens" in docs.columns and secret_ledger.RULES

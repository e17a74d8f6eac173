"""The pipeline's stages, each against its own input."""

from collections import Counter

import corpus_pipeline
import public_tokenizers
import sentencepiece
from promolift.llm import mixing, neardup, quality, secrets
from promolift.llm.common import keep

from .conftest import SF_MORE


def test_stages(spark, more_documents):
    library = sentencepiece.SentencePieceProcessor(model_file=public_tokenizers.path("piece_bpe_32k.model"))
    docs, ids = more_documents, lambda df: Counter(r["doc_id"] for r in df.select("doc_id").collect())
    for k, (name, stage) in enumerate(corpus_pipeline.STAGES):
        out = keep(stage(spark, docs, SF_MORE), f"test-{k}")
        if k < len(corpus_pipeline.STAGES) - 1:
            assert out.columns == more_documents.columns and out.dtypes == more_documents.dtypes
        if k == 0:
            assert ids(out) == ids(quality.judge(docs).where("kept"))
        if k == 1:
            assert ids(out) == ids(neardup.link(docs, width=5, percent=80).where("kept"))
        if k == 2:
            assert ids(out) == ids(docs)
            before = {r["doc_id"]: r["text"] for r in docs.collect()}
            after = out.collect()
            assert all(r["text"] == secrets.hide(before[r["doc_id"]]) and r["n_chars"] == len(r["text"]) for r in after)
            assert any("[SECRET]" in r["text"] for r in after)
        if k == 3:
            copies = {r["row"]["doc_id"]: r["copies"] for r in mixing.mix(docs, passed=("doc_id",)).collect() if r["copies"]}
            assert ids(out) == Counter(copies)
        if k == 4:
            assert ids(out) == ids(docs)
            texts = {r["doc_id"]: r["text"] for r in docs.collect()}
            for r in out.limit(200).collect():
                assert list(r["ids"]) == library.encode(texts[r["doc_id"]]) and r["decoded"] == texts[r["doc_id"]].replace("▁", " ")
        docs = out


def test_stages_of_odd_documents(spark, odd_documents, no_documents):
    for start in (odd_documents, no_documents):
        for _, stage in corpus_pipeline.STAGES:
            stage(spark, start, SF_MORE).count()  # every stage takes any documents
        docs = start
        for k, (name, stage) in enumerate(corpus_pipeline.STAGES):
            docs = keep(stage(spark, docs, SF_MORE), f"odd-{k}")


def test_repeated_rows_go(spark):
    """Of rows with equal id and text, and of equal texts without an id, one stays; texts that an
    id shares with another stay as one document's."""
    t = "the very same words of one long enough text that is here many times over again"
    other = "quite another text with its own words that nobody else in this table has ever used"
    rows = [(1, t), (1, t), (None, t), (None, t), (2, t), (3, other), (3, other), (4, None), (4, None), (None, None), (None, None), (5, ""), (6, "")]
    df = spark.createDataFrame([(i, x, "en", "s", 0) for i, x in rows], "doc_id long, text string, lang string, source string, n_chars long").repartition(4)
    got = Counter((r["doc_id"], r["text"]) for r in neardup.drop_duplicates(df).collect())
    assert got == Counter([(1, t), (None, t), (3, other), (4, None), (None, None), (5, ""), (6, "")])


def test_a_share_of_hashes(spark):
    """Samples follow their share also where it is far below a millionth."""
    from pyspark.sql import functions as F

    from promolift.llm.common import drawn
    h = spark.range(200_000).select(F.xxhash64("id").alias("h"))
    assert 1800 < h.where(drawn(F.col("h"), 0.01)).count() < 2200 and h.where(drawn(F.col("h"), 2.0)).count() == 200_000
    edge = spark.createDataFrame([(-2**63,), (-2**63 + 10**6,), (0,)], "h long")
    assert edge.where(drawn(F.col("h"), 1e-15)).count() == 1

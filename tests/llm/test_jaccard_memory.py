"""The Jaccard join holds little at once: small Arrow batches, signatures worked out piece by piece."""

import tracemalloc

import numpy as np
import pyarrow as pa

from terraloom.llm import jaccard

KEYS = ("spark.sql.execution.arrow.maxBytesPerBatch", "spark.sql.parquet.columnarReaderBatchSize")


def test_batches_stay_small(spark, monkeypatch):
    """While the join runs no batch of texts passes the limit by more than a row; the settings come back afterwards."""
    texts = spark.range(3000).selectExpr("id AS doc_id", "concat(id, repeat(' word', 1000)) AS text").coalesce(1)
    seen, real = [], jaccard.staged

    def sizes(batches):
        for b in batches:
            yield pa.RecordBatch.from_pydict({"n": pa.array([b.nbytes])})

    def watched(df, name):
        if name == "known":
            seen.extend(r.n for r in texts.mapInArrow(sizes, "n long").collect())
        return real(df, name)

    monkeypatch.setattr(jaccard, "staged", watched)
    was = [spark.conf.get(k) for k in KEYS]
    spark.conf.set(KEYS[1], 1000)
    try:
        got = jaccard.jaccard_components(texts)
        assert [spark.conf.get(k) for k in KEYS] == [was[0], "1000"]
    finally:
        spark.conf.unset(KEYS[1])
    assert got.count() == 3000
    assert len(seen) > 2 and max(seen) <= jaccard.BATCH_BYTES + 20_000


def test_signatures_in_pieces(monkeypatch):
    rng = np.random.default_rng(3)
    size = np.r_[0, rng.integers(1, 900, 1500), 0, 200_000, 3]
    h = np.concatenate([np.unique(rng.integers(0, 1 << 63, n).astype(np.uint64)) for n in size])
    hot = np.sort(h[rng.integers(0, len(h), 200_000)])
    args = (h, size, np.unique(hot), np.full(len(np.unique(hot)), 9), 75, jaccard.band_plan(75))
    tracemalloc.start()
    sig, doc, slack = jaccard.signatures(*args)
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    monkeypatch.setattr(jaccard, "PIECE", 1 << 40)
    tracemalloc.start()
    sig1, doc1, slack1 = jaccard.signatures(*args)
    assert peak < 0.6 * tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    a, b = np.lexsort((sig, doc)), np.lexsort((sig1, doc1))
    assert (sig[a] == sig1[b]).all() and (doc[a] == doc1[b]).all() and (slack == slack1).all() and (slack < 0).any()

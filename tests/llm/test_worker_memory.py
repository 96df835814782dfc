"""What a Python worker holds at once is bounded, and texts go to it once."""

import os
import tracemalloc

import numpy as np
import pyarrow as pa
from millstat.llm import jaccard_join, langid, shared
from millstat.llm.words import WordTable


def test_pairs_are_bounded_by_blocks():
    rng = np.random.default_rng(2)
    n = 400
    frame = {"k": np.arange(n), "label": np.arange(n), "n": np.full(n, 300),
             "have": rng.integers(0, 4, (n, jaccard_join.CLASSES)).astype(np.uint8)}
    i, j = np.triu_indices(n, 1)
    for tree in (True, False):
        tracemalloc.start()
        a, b = jaccard_join._allowed(frame, i, j, 45, tree)
        most = tracemalloc.get_traced_memory()[1]
        tracemalloc.stop()
        assert most < 24e6  # with 50,000 pairs at once over 50 MB
        assert len(a) == (n - 1 if tree else len(set(zip(a.tolist(), b.tolist())))) and (a < b).all()


def test_new_words_are_computed_in_blocks():
    asked = []

    def compute(words):
        asked.append(len(words))
        return np.array([[float(w)] for w in words], np.float32)

    table, words = WordTable(compute, at_once=langid.NEW_WORDS), [str(i % 30_000) for i in range(60_000)]
    at = table.lookup(words)
    assert sum(asked) == 30_000 and max(asked) <= 8_192
    assert table.rows[at][:, 0].tolist() == [float(w) for w in words]


def test_batches_in_pieces():
    whole = pa.record_batch({"x": list(range(2_500))})
    got = list(shared.pieces(iter([whole, whole.slice(0, 0)])))
    assert [p.num_rows for p in got] == [1_000, 1_000, 500]
    assert pa.Table.from_batches(got).to_pydict() == whole.to_pydict()


def test_workers_give_memory_back(monkeypatch):
    told = []
    monkeypatch.setattr(shared, "give_back", lambda: told.append(len(seen)))
    seen = []

    def run(batches):
        for b in batches:
            seen.append(b)
            yield b

    assert list(shared.lean(run)(iter("abc"))) == list("abc")
    assert told == [1, 2, 3, 3]  # after each batch, and at the end


def test_freed_memory_leaves_the_process():
    def held():
        return int(open("/proc/self/statm").read().split()[1]) * os.sysconf("SC_PAGE_SIZE")

    arrays = [np.ones(100_000 // 8) for _ in range(2_000)]  # 200 MB in blocks that the C library keeps
    last, full = arrays[-1], held()
    del arrays
    shared.give_back()
    assert full - held() > 150e6 and last[0] == 1


def test_accepted_sends_texts_once(spark):
    docs = spark.createDataFrame([(i, "some english words here", "en") for i in range(20)], "doc_id long, text string, lang string")
    found = langid.accepted(docs, langid.learn(docs))
    assert sorted(map(tuple, found.collect())) == sorted(map(tuple, docs.collect()))
    plan = found._jdf.queryExecution().executedPlan().toString()
    assert "_text" not in plan
    # a text that is no string is still read as one
    odd = docs.withColumn("text", docs.text.cast("binary"))
    assert langid.accepted(odd, langid.learn(docs)).count() == 20

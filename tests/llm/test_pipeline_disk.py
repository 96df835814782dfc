"""The near-duplicate stage keeps no copy of the texts, moves few of them, and leaves no tables behind."""

import os

import corpus_pipeline
import numpy as np
import pytest
from millstat.llm import jaccard_join as J
from millstat.llm import shared
from millstat.session import local_fs_path, shared_dir
from pyspark.sql import functions as F


def tables(spark):
    top = local_fs_path(shared_dir(spark, "millstat"))
    return set(os.listdir(top)) if os.path.isdir(top) else set()


def texts(n, seed=3):
    rng = np.random.default_rng(seed)
    out = [" ".join(f"w{x}" for x in rng.zipf(1.3, 120) % 5_000) for _ in range(n)]
    return [(i, out[i % (n - n // 4)], None) for i in range(n)]  # a quarter are copies


@pytest.fixture()
def files(spark, tmp_dir):
    path = f"{tmp_dir}/documents.parquet"
    spark.createDataFrame(texts(400), "doc_id long, text string, _metadata string").repartition(5).write.parquet(path)
    return spark.read.parquet(path)


@pytest.mark.parametrize("few", [0, 10_000])
def test_near_duplicates_of_files_without_a_copy(spark, files, monkeypatch, few):
    monkeypatch.setattr(corpus_pipeline, "BROADCAST", few)  # 0: by a bitmap
    monkeypatch.setattr(shared, "BROADCAST", few)
    before = tables(spark)
    kept = corpus_pipeline.near_duplicates(spark, files, "")
    assert {r.doc_id for r in kept.collect()} == set(range(300)) and kept.columns == files.columns
    new = {x.rsplit("-", 1)[0] for x in tables(spark) - before}
    assert new <= {"jaccard-found", "pipeline-copies", "bitmap"}  # before: pipeline-rows, and all tables of the join


def test_rows_of_files_have_numbers_of_their_own(spark, files):
    one, two = ({(r.c0, r.row) for r in corpus_pipeline._placed(files).collect()} for _ in range(2))
    assert one == two and len({row for _, row in one}) == 400
    assert corpus_pipeline._placed(files.where("doc_id > 3")) is None  # computed: written, with a number
    assert corpus_pipeline._placed(spark.range(3)) is None
    assert corpus_pipeline._rows(files.where("doc_id > 3"), "pipeline-rows").select("row").distinct().count() == 396


@pytest.mark.parametrize("n, others", [(40_000, 20_000), (10, 200_000), (1 << 30, 2_000)])  # as many as said, more or fewer
def test_bitmap_holds_all_keys_and_few_others(spark, n, others):
    keys = spark.range(0, 40_000).select((F.col("id") * 3 - 60_000).alias("row"))
    hit = [r.row for r in spark.range(200_000).select((F.col("id") - 100_000).alias("row")).where(shared.bitmap_test(keys, "row", n)).collect()]
    want = {x * 3 - 60_000 for x in range(40_000)}
    assert want.intersection(range(-100_000, 100_000)) <= set(hit) and len(set(hit) - want) < others


def test_finished_deletes_also_when_it_fails(spark):
    before = tables(spark)

    def fails():
        shared.stored(spark.range(3), "half")
        raise ValueError

    with pytest.raises(ValueError):
        shared.finished(spark, fails, "whole")
    assert tables(spark) == before
    got = shared.finished(spark, lambda: shared.stored(spark.range(3), "half").where("id > 0"), "whole")
    assert {x.rsplit("-", 1)[0] for x in tables(spark) - before} == {"whole"} and got.count() == 2


def test_similar_sets_share_more_than_one_cell():
    rng = np.random.default_rng(1)
    table = rng.integers(0, 1 << 32, J.FREQUENT_BITS >> 5, np.uint64).astype(np.uint32)
    levels = rng.integers(0, J.TOP_RANK // J.WORDS + 1, J.SLOTS).astype(np.int16)
    closest = 0
    for n in (1, 4, 7, 30, 200, 900):
        for _ in range(40):
            words = [f"w{x}" for x in rng.zipf(1.4, n) % 3_000]
            other = list(words)
            for at in rng.integers(0, n, rng.integers(0, 1 + n // 40)):
                other[at] = "new"
            other = other[: len(other) - int(rng.integers(0, 1 + n // 12))]
            pair = [" ".join(words), " ".join(other)]
            x, y = next(J.shingle_sets(pair))
            both, union = J._overlap(x, y)
            if not both or 100 * both < J.PERCENT * union:
                continue
            keys, sizes, cells = next(J._prefixes(pair, J.WORDS, J.PERCENT, table, levels))
            a, b = np.split(cells, [sizes[0]])
            least = 1 + J.extra(min(len(x), len(y)))
            assert (keys == J._keys([x, y])).all() and len(np.intersect1d(a, b)) >= min(least, both)
            assert least >= 1 + J.extra(-(-max(len(x), len(y)) * J.PERCENT // 100))
            closest += both < union
    assert closest > 50

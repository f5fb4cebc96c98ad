"""What a task leaves behind in its Python worker, which later steps use again."""

import numpy as np
from pyspark.sql.classic.dataframe import DataFrame

import corpus_pipeline
from strandmill.llm import packing

SF = "/root/testdata/sf0.001"


def test_steps_of_the_pipeline_leave_nothing_behind(spark, monkeypatch):
    from strandmill.llm import common

    given, plain = [], DataFrame.mapInArrow
    monkeypatch.setattr(DataFrame, "mapInArrow", lambda df, f, *a, **k: (given.append(f), plain(df, f, *a, **k))[1])
    corpus_pipeline.run(spark, SF)
    assert {f.__module__.rpartition(".")[2] for f in given} >= {"language_id", "line_dedup", "ngram_join", "decontamination", "packing"}
    assert all(hasattr(f, "__wrapped__") for f in given)
    for f in given:
        if f.__name__ == "ranked":  # asks for its task
            continue
        packing.encoder_of(packing.tokenizer_path())
        assert list(f(iter(()))) is not None
        # only the step that encodes keeps the encoder for its next tasks
        assert packing.encoder_of.cache_info().currsize == (f.__name__ == "cut" and f.__module__.endswith("packing")), f
    assert common.KEPT == [packing.encoder_of]


def test_free_memory_is_given_back():
    from strandmill.llm import common

    pins = []

    def read(batches):
        for batch in batches:
            held = [np.ones(8 << 10) for _ in range(6000)]  # 400 MB in pieces that the allocator keeps
            pins.append(np.ones(1 << 10))
            del held
            yield batch

    before = common.own_bytes()
    assert list(common.lean(read)(iter([1]))) == [1]
    assert common.own_bytes() - before < 64 << 20

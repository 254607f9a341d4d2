"""What the plans of the BPE operator make the driver print and keep."""

from noticelake.llm import bpe


def test_the_head_is_folded_by_a_plan_without_adaptive_steps(spark, monkeypatch):
    frame, plans = type(spark.range(0)), []
    to_arrow = frame.toArrow

    def noted(self):
        plans.append(self._jdf.queryExecution().executedPlan().toString())
        return to_arrow(self)

    monkeypatch.setattr(frame, "toArrow", noted)
    ranks = bpe.read_ranks(bpe.vocabulary_path())
    texts = spark.createDataFrame([("notices of the month", ), ("notices of the month again", )], "text string")
    head = bpe.frequent(texts, bpe.rank_map(ranks), 100)
    found = dict(zip(head.words.to_pylist(), head.sizes.tolist()))
    assert found == {w: len(bpe.heap_merges(w.encode(), ranks)) for w in ["notices", " of", " the", " month"]}
    assert len(plans) == 1 and "transform" in plans[0]
    assert "Adaptive" not in plans[0] and "Exchange" not in plans[0]


def test_an_empty_head(spark):
    ranks = bpe.rank_map(bpe.read_ranks(bpe.vocabulary_path()))
    head = bpe.frequent(spark.createDataFrame([("once",), (None,)], "text string"), ranks, 100)
    assert len(head.words) == 0 and head.flat.size == 0 and head.sizes.size == 0

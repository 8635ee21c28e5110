"""Training of the language model."""

from conftest import SF_SMALL
from rewardlake.llm import lm
from rewardlake.llm.common import read_documents


def test_six_passes_of_training(spark, monkeypatch):
    """score() trains six passes or more, and each fits better than the one before."""
    used = []
    train = lm.train
    monkeypatch.setattr(lm, "train", lambda *a, **b: used.append(train(*a, **b)) or used[-1])
    lm.score(spark, read_documents(spark, SF_SMALL))
    fits = used[0][1]
    assert len(fits) >= 6 and all(a < b for a, b in zip(fits, fits[1:]))

"""Places where the code once did less than the whole job."""

from __future__ import annotations

from tilth.operators import learn as M
from workload import learn as L

FOLDER = "/root/testdata/sf0.001"


def test_learning_queries_keep_the_whole_vocabulary_and_all_rounds(spark, monkeypatch):
    steps, given = [], []
    fit = M.LinearSVC.fit

    def counted(self, data):
        model = fit(self, data)
        steps.append(model.summary().totalIterations)
        return model

    monkeypatch.setattr(M.LinearSVC, "fit", counted)
    assert len(L._model(spark, FOLDER, "svm").counts.stages[-1].vocabulary) == M.MAX_TERMS
    assert 25 < steps[0] < 1000  # the tolerance ended it
    monkeypatch.setattr(M, "run_cycle", lambda *a, **k: given.append(k) or (None, None))
    monkeypatch.setattr(M, "compare_strategies", lambda *a, **k: given.append(k) or (None, None))
    L.run_cycle(spark, FOLDER)
    L.compare_strategies(spark, FOLDER)
    assert len(given) == 2 and not any({"max_terms", "n_iterations"} & set(k) for k in given)

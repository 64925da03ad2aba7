import numpy as np

from samplewright.llm import ann


def test_calibration_leaves_the_query_out(monkeypatch):
    x = np.random.default_rng(6).normal(size=(1200, 16))
    asked = []
    for target in (0.35, 0.5, 0.7):
        monkeypatch.setattr(ann, "TARGET", target)
        router, ask = ann.learn(x, 16, 10)
        home, query = router.ranked(x)[:, 0], np.arange(600, 1100)
        d = ((x[query, None] - x[None]) ** 2).sum(2)
        d[np.arange(500), query] = np.inf
        near = np.argsort(d, 1)[:, :10]
        place = np.argsort(router.ranked(x[query]), 1)[np.arange(500)[:, None], home[near]]
        asked.append((ask, (place < ask).mean()))
    assert all(share >= target for (_, share), target in zip(asked, (0.35, 0.5, 0.7), strict=True)), asked

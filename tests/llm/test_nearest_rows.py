import numpy as np

from marketloom.llm import nearest


def test_unrelated_vectors_get_few_buckets_however_many_they_are():
    sample = np.random.default_rng(3).standard_normal((1500, 64))
    longest = float(np.linalg.norm(sample, axis=1).max())
    few, many = (nearest.Tables.cheapest(sample, longest, 20, n) for n in (10_000, 50_000))
    visits = [np.mean([len(b) for _, _, b in t.probes(sample[:50], 0)]) * t.tables for t in (few, many) if not t.held.fill(1)]
    assert visits[1] <= 1.5 * visits[0], visits

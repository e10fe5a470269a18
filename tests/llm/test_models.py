"""The text models' helpers, and site posteriors and rates against plain versions over given posteriors."""

import numpy as np
import pyarrow as pa

from wardflow.llm import mixing, site_quality, text_model


def test_word_places_are_word_ids():
    values = ["Hello,", "hello", "(x)", "...", "Straße", "ÉCOLE-", "αβγδεζηθ", "a" * 5000, "12345678", "\U0001F600\U0001F601\U0001F602\U0001F603\U0001F604", "abc", "abcd", "-"]
    owner, place = text_model.word_places(values)
    for i, v in enumerate(values):
        assert sorted(place[owner == i].tolist()) == text_model.word_ids(v)
    assert [len(x) for x in text_model.word_places([])] == [0, 0]


def test_sample_is_bounded_by_rows_and_bytes(spark):
    docs = spark.createDataFrame([(i, "word " * 20) for i in range(60)], "doc_id long, text string")
    labels = spark.createDataFrame([(i, i % 2) for i in range(60)], "doc_id long, quality int")
    count = lambda t: 0 if t is None else t.num_rows
    rows = text_model.labelled_rows(docs, labels, ["quality"], size=40)
    assert text_model.fitted(rows, count) == 40
    assert text_model.fitted(rows, count, limit=1) <= 40 and text_model.fitted(rows.where("doc_id < 0"), count) == 0


def plain_posteriors(rows):
    """site_quality.with_posteriors in plain numbers: (host, path, p) -> (host posterior, path posterior)."""
    def mean(x):
        return sum(x) / len(x)

    def kappa(groups):  # (values, parent)
        n = sum(len(v) for v, _ in groups)
        spread = sum(len(v) * (mean(v) - m) ** 2 for v, m in groups)
        between = max(spread - sum(m * (1 - m) for _, m in groups), 1e-9) / n
        return float(np.clip(sum(len(v) * m * (1 - m) for v, m in groups) / n / between - 1, 1, 1e6))

    hosts, paths = {}, {}
    for h, q, p in rows:
        hosts.setdefault(h, []).append(p)
        paths.setdefault((h, q), []).append(p)
    prior = float(np.clip(mean([p for *_, p in rows]), 1e-4, 1 - 1e-4))
    k_host = kappa([(v, prior) for v in hosts.values()])
    post = {h: (k_host * prior + sum(v)) / (k_host + len(v)) for h, v in hosts.items()}
    k_path = kappa([(v, post[h]) for (h, _), v in paths.items()])
    out = []
    for h, q, p in rows:
        own = (k_host * prior + sum(hosts[h]) - p) / (k_host + len(hosts[h]) - 1)
        out.append((own, (k_path * own + sum(paths[h, q]) - p) / (k_path + len(paths[h, q]) - 1)))
    return out


def test_site_posteriors_equal_a_plain_version(spark):
    rng = np.random.default_rng(4)
    rows = [(f"h{h}" if h else None, f"p{rng.integers(3)}", float(rng.beta(1 + h, 3))) for h in range(6) for _ in range(int(rng.integers(1, 60)))]
    df = spark.createDataFrame([(i, *r) for i, r in enumerate(rows)], "i int, host string, path string, p double")
    got = {r.i: (r.host_posterior, r.path_posterior) for r in site_quality.with_posteriors(df).collect()}
    want = plain_posteriors(rows)
    assert all(np.allclose(got[i], want[i], rtol=1e-9) for i in range(len(rows)))


def test_rounds_equal_a_plain_version(spark):
    rng = np.random.default_rng(8)
    n, p = rng.integers(0, 900, 300), rng.dirichlet([2, 1, 1, 1], 300)
    df = spark.createDataFrame([(int(a), b.tolist()) for a, b in zip(n, p)], "tokens long, p array<double>").repartition(4)
    steps, r = [], np.ones(300)
    goal, best = np.array(mixing.TARGETS) / sum(mixing.TARGETS) * n.sum(), (np.inf, 0)
    for _ in range(mixing.ROUNDS):
        left = goal - (r * n) @ p
        size = np.linalg.norm(left) / np.linalg.norm(goal)
        best = min(best, (size, len(steps)), key=lambda x: x[0])
        if size < mixing.CLOSE:
            break
        m = (p * np.where(r > 0, n, 0)[:, None]).T @ p
        steps.append(np.linalg.solve(m + np.eye(4) * 1e-6 * np.trace(m), left))
        r = np.where(n > 0, np.maximum(r + p @ steps[-1], 0), 1.0)
    got = mixing.fit_rates(df)
    assert len(got) == best[1] and np.allclose(got, steps[: best[1]], rtol=1e-6, atol=1e-9)


def test_training_without_rows_gives_even_posteriors():
    p, n = text_model.Softmax(4).predict(pa.array(["a b", "", None]))
    assert np.allclose(p, 0.25) and n.tolist() == [2, 0, 0]
    assert text_model.Softmax(2).predict(pa.array([], pa.string()))[0].shape == (0, 2)

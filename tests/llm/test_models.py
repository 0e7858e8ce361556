"""The models of toxicity and site quality against loops and finite differences."""

import math

import numpy as np
import pytest

from tidemark.llm import sites, toxicity


def plain_likelihood(params, rows, grades, n, penalty):
    """Sum over documents of the log of P(grade), thresholds by a loop."""
    cuts = [params[n]]
    for gap in params[n + 1 :]:
        cuts.append(cuts[-1] + math.exp(gap))
    total = 0.0
    for (places, x), grade in zip(rows, grades):
        score = sum(params[p] * v for p, v in zip(places, x))
        above = [1.0, *[1 / (1 + math.exp(cut - score)) for cut in cuts], 0.0]
        total += math.log(above[grade] - above[grade + 1])
    return total / len(rows) - penalty / 2 * sum(w * w for w in params[:n])


@pytest.mark.parametrize("levels", [1, 2, 4])
def test_ordinal_likelihood_and_gradient(levels):
    rng = np.random.default_rng(levels)
    n, rows = 6, []
    for _ in range(25):
        places = rng.choice(n, rng.integers(0, n), replace=False)
        rows.append((places, rng.random(len(places))))
    grades = rng.integers(0, levels + 1, len(rows))
    params = rng.normal(size=n + levels)
    owner = np.repeat(np.arange(len(rows)), [len(p) for p, _ in rows])
    place, x = np.concatenate([p for p, _ in rows]), np.concatenate([v for _, v in rows])

    value, gradient = toxicity.objective(params, owner, place, x, grades, n, 0.01)
    assert abs(value - plain_likelihood(params, rows, grades, n, 0.01)) < 1e-9
    for at in range(len(params)):
        step = np.zeros(len(params))
        step[at] = 1e-5
        slope = (plain_likelihood(params + step, rows, grades, n, 0.01) - plain_likelihood(params - step, rows, grades, n, 0.01)) / 2e-5
        assert abs(gradient[at] - slope) < 1e-6
    assert (np.diff(toxicity.thresholds_of(params, n)) > 0).all()


def test_fitted_thresholds_and_expected_severity():
    rng = np.random.default_rng(7)
    rows, grades = [], []
    for _ in range(400):
        x = rng.integers(1, 5, 3)
        rows.append((np.array([1, 2, 3]), x))
        grades.append(int(x[0] > 2) + int(x[0] > 3))
    model = toxicity.fit_ordinal(rows, np.array(grades), bits=4)
    assert (np.diff(model.thresholds) > 0).all()
    severity = [model.above(n, c).sum() for n, c in rows]
    means = [np.mean([s for s, g in zip(severity, grades) if g == grade]) for grade in range(3)]
    assert means[0] < means[1] < means[2]


def plain_strength(groups, towards):
    """Documents that the rate above is worth, by moments, over (evidences, rate above)."""
    n = sum(len(e) for e, _ in groups)
    k = len(groups)
    squares = sum(v * v for e, _ in groups for v in e)
    means = sum(len(e) * (sum(e) / len(e)) ** 2 for e, _ in groups)
    inside = max(1e-9, (squares - means) / max(1, n - k))
    between = sum(len(e) * (sum(e) / len(e) - above) ** 2 for e, above in groups) / n - inside * k / n
    return 1000.0 if between <= 0 else min(1000.0, max(2.0, inside / between))


def test_rates_of_hosts_and_paths_by_a_loop(spark):
    rng = np.random.default_rng(3)
    good, bad = "plain words in a line of text " * 4, "### $$$ !!! 1 2 3 " * 6
    rows = []
    for n in range(160):
        host, path = f"h{n % 3}", f"p{n % 5 % (n % 3 + 1)}"
        rows.append((n, good + str(n) if rng.random() < (0.2, 0.5, 0.9)[n % 3] else bad + "x" * (n % 7), host, path))
    rows += [(500, good, None, "lone"), (501, None, "h0", None)]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string, source string, lang string")
    labels = spark.createDataFrame([(i, int("plain" in (t or ""))) for i, t, _, _ in rows[:120]], "doc_id bigint, quality int")
    got = {r["doc_id"]: r for r in sites.site_quality(docs, labels).collect()}
    evidence = {i: got[i]["evidence"] for i, *_ in rows}

    hosts, paths = {}, {}
    for i, _, host, path in rows:
        hosts.setdefault(host or "", []).append(evidence[i])
        paths.setdefault((host or "", path or ""), []).append(evidence[i])
    general = (sum(evidence.values()) + 0.5) / (len(rows) + 1)
    m = plain_strength([(e, general) for e in hosts.values()], general)
    host_rate = {h: (sum(e) + m * general) / (len(e) + m) for h, e in hosts.items()}
    k = plain_strength([(e, host_rate[h]) for (h, _), e in paths.items()], None)
    odds = lambda p: math.log(p / (1 - p))
    for i, _, host, path in rows:
        h, e = host or "", paths[host or "", path or ""]
        rate = (sum(e) - evidence[i] + k * host_rate[h]) / (len(e) - 1 + k)
        posterior = 1 / (1 + math.exp(-(odds(evidence[i]) + odds(rate) - odds(general))))
        row = got[i]
        assert abs(row["host_rate"] - host_rate[h]) < 1e-9 and abs(row["path_rate"] - rate) < 1e-9
        assert abs(row["posterior"] - posterior) < 1e-9 and row["kept"] == (posterior >= sites.LIMIT)
    # a document alone on its path is judged by its evidence and its host
    assert abs(got[500]["path_rate"] - host_rate[""]) < 1e-9

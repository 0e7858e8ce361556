"""Document quality by hierarchical empirical Bayes.

A classifier turns a document's own measures into log-odds.  Sites add what
is known about their other documents: the mean probability of a host is
shrunk towards that of all documents, and the mean of a path within the host
towards the host's, each by a strength fitted to the spread between sites.
A document's posterior is its own evidence with the path's rate in place of
the general one.

The classifier is fitted on at most ``sample`` labelled rows, those with the
smallest hash of their id; measures, sites and verdicts cover all documents.
"""

from __future__ import annotations

import numpy as np
from pyspark.sql import Column, DataFrame, functions as F

from tidemark.llm.common import picked
from tidemark.operators.joins import equal_keys
from tidemark.session import written

SAMPLE = 20_000  # labelled rows the classifier is fitted on
LIMIT = 0.5
NAMES = ("log_words", "word_length", "distinct", "symbols", "upper", "marks", "digits", "lines", "sentences", "same_lines")


def measures(text: Column) -> list[Column]:
    """Shares and logarithms, each of about the same scale; empty texts give zeros."""
    words = F.filter(F.split(F.regexp_replace(text, r"[\x20\x09-\x0D]+", " "), " "), lambda w: w != "")
    chars, n = F.greatest(F.length(text), F.lit(1)), F.greatest(F.size(words), F.lit(1))

    def share(characters: str) -> Column:
        return (F.length(text) - F.length(F.regexp_replace(text, characters, ""))) / chars

    lines = F.split(text, "\n")
    return [
        F.log(n), F.length(F.regexp_replace(text, r"[\x20\x09-\x0D]+", "")) / n,
        F.size(F.array_distinct(words)) / n, share(r"[#*$%&|<>]"), share(r"\p{Lu}"), share(r"[!?]"), share(r"\d"),
        F.size(lines) / n, (F.length(text) - F.length(F.regexp_replace(text, r"[.]", ""))) / n,
        (F.size(lines) - F.size(F.array_distinct(lines))) / F.size(lines),
    ]


def expanded(x: np.ndarray) -> np.ndarray:
    """Measures, damped measures and a constant."""
    return np.hstack([x, np.sqrt(np.abs(x)), np.ones((len(x), 1))])


def fit_logistic(x: np.ndarray, y: np.ndarray, penalty: float = 1e-3, rounds: int = 30) -> tuple[np.ndarray, float]:
    """Weights for ``expanded`` measures by Newton steps, and the share of ones, never quite 0 or 1."""
    rate = float((y.sum() + 0.5) / (len(y) + 1)) if len(y) else 0.5
    width = 2 * len(NAMES) + 1
    if len(y) == 0 or y.min() == y.max():
        weights = np.zeros(width)
        weights[-1] = np.log(rate / (1 - rate))
        return weights, rate
    full = expanded(x)
    centre, scale = full.mean(axis=0), full.std(axis=0)
    constant = scale < 1e-9
    scale[constant] = 1.0
    centre[-1] = 0.0
    z = (full - centre) / scale
    w = np.zeros(width)
    for _ in range(rounds):
        p = 1 / (1 + np.exp(-np.clip(z @ w, -30, 30)))
        slope = z.T @ (y - p) / len(y) - penalty * w
        bend = (z * (p * (1 - p))[:, None]).T @ z / len(y) + penalty * np.eye(width)
        step = np.linalg.solve(bend, slope)
        w = w + step * min(1.0, 5.0 / max(1e-9, np.abs(step).max()))
    weights = w / scale
    weights[-1] = w[-1] - float((w[:-1] * centre[:-1] / scale[:-1]).sum())
    return weights, rate


def fit(docs: DataFrame, labels: DataFrame, id_col: str, text_col: str, label_col: str, sample: int) -> tuple[np.ndarray, float]:
    """Rows without an id or label are not labelled; an id labelled twice counts with its lowest label."""
    marks = picked(labels, of=(id_col, "long"), mark=(label_col, "int")).dropna().groupBy("of").agg(F.min("mark").alias("mark"))
    chosen = marks.orderBy(F.xxhash64("of"), "of").limit(sample)
    texts = picked(docs, id=(id_col, "long"), text=(text_col, "string")).fillna("", ["text"])
    found = texts.join(F.broadcast(chosen), F.col("id") == F.col("of")).select(
        "id", F.col("mark").cast("double"), *[m.cast("double").alias(n) for m, n in zip(measures(F.col("text")), NAMES)]
    )
    rows = np.array(sorted(map(tuple, found.collect())), float).reshape(-1, 2 + len(NAMES))
    return fit_logistic(rows[:, 2:], (rows[:, 1] > 0).astype(float))


def _logit(p: Column) -> Column:
    return F.log(p / (1 - p))


def _strength(groups: DataFrame, towards: str) -> float:
    """Documents the rate above is worth, by moments; takes one row of sums to the driver."""
    gap = F.col("mean") - F.col(towards)
    sums = groups.agg(
        F.sum("docs").alias("n"), F.count("*").alias("k"), F.sum(F.col("docs") * gap * gap).alias("between"),
        F.sum("squares").alias("squares"), F.sum(F.col("docs") * F.col("mean") * F.col("mean")).alias("means"),
    ).first()
    if not sums["n"]:
        return 10.0
    inside = max(1e-9, (sums["squares"] - sums["means"]) / max(1, sums["n"] - sums["k"]))
    between = sums["between"] / sums["n"] - inside * sums["k"] / sums["n"]
    return 1000.0 if between <= 0 else float(min(1000.0, max(2.0, inside / between)))


def site_quality(
    docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", host_col: str = "source",
    path_col: str = "lang", label_col: str = "quality", limit: float = LIMIT, sample: int = SAMPLE,
) -> DataFrame:
    """Per document: ``doc_id, evidence, host_rate, path_rate, posterior, kept``.

    ``evidence`` is the classifier's probability, ``path_rate`` the shrunk rate
    of the path's other documents.  Null texts count as empty, null hosts and
    paths as the empty name.  Repeated rows, also with the same id, are judged
    each by itself; without labels the evidence is one half for all; an empty
    table gives no rows; other columns are dropped, whatever their names.  A
    text is one value of an expression, of the size that Spark allows.
    """
    weights, rate = fit(docs, labels, id_col, text_col, label_col, sample)
    rows = picked(
        docs, doc_id=(id_col, "long"), text=(text_col, "string"), host=(host_col, "string"), path=(path_col, "string")
    ).fillna("", ["text", "host", "path"])
    own = rows.select("doc_id", "host", "path", *[m.cast("double").alias(n) for m, n in zip(measures(F.col("text")), NAMES)])
    terms = [float(w) * F.col(n) for w, n in zip(weights, NAMES)]
    terms += [float(w) * F.sqrt(F.abs(n)) for w, n in zip(weights[len(NAMES) :], NAMES)]
    log_odds = F.greatest(F.lit(-30.0), F.least(F.lit(30.0), sum(terms, F.lit(float(weights[-1])))))
    judged = written(own.select("doc_id", "host", "path", (1 / (1 + F.exp(-log_odds))).alias("evidence")), "evidence")

    paths = written(
        judged.groupBy("host", "path").agg(
            F.count("*").alias("docs"), F.sum("evidence").alias("sum"), F.sum(F.col("evidence") ** 2).alias("squares")
        ),
        "paths",
    )
    total = paths.agg(F.sum("sum").alias("s"), F.sum("docs").alias("n")).first()
    general = (total["s"] + 0.5) / (total["n"] + 1) if total["n"] else 0.5
    hosts = paths.groupBy("host").agg(
        F.sum("docs").alias("docs"), F.sum("sum").alias("sum"), F.sum("squares").alias("squares")
    ).withColumn("mean", F.col("sum") / F.col("docs")).withColumn("general", F.lit(float(general)))
    m = _strength(hosts, "general")
    hosts = written(
        hosts.select(F.col("host").alias("of"), ((F.col("sum") + m * general) / (F.col("docs") + m)).alias("host_rate")), "hosts"
    )
    within = written(
        paths.withColumn("mean", F.col("sum") / F.col("docs")).join(hosts, equal_keys(paths, hosts, {"host": "of"})).drop("of"),
        "within",
    )
    k = _strength(within, "host_rate")
    sites = written(
        within.select(F.col("host").alias("h"), F.col("path").alias("p"), "host_rate", "docs", "sum"), "sites"
    )
    joined = judged.join(sites, equal_keys(judged, sites, {"host": "h", "path": "p"}))
    # the rate of the other documents there: a document's own evidence counts once
    others = (F.col("sum") - F.col("evidence") + k * F.col("host_rate")) / (F.col("docs") - 1 + k)
    joined = joined.withColumn("path_rate", others)
    shift = _logit(F.col("path_rate")) - F.lit(float(np.log(general / (1 - general))))
    posterior = 1 / (1 + F.exp(-(_logit(F.col("evidence")) + shift)))
    return joined.select("doc_id", "evidence", "host_rate", "path_rate", posterior.alias("posterior")).withColumn(
        "kept", F.col("posterior") >= limit
    )

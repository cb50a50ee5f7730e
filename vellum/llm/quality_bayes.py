"""Quality by hierarchical empirical Bayes.

A logistic classifier of text counts (fitted on a bounded sample of labels)
gives each document a probability of good quality.  Sites get posteriors from
the soft counts of all their documents: a host's mean is shrunk towards the
whole table's, a path's towards its host's.  The strengths of both priors come
from the data by moments: where means of well-filled sites differ little
beyond chance the prior is strong, and sparse sites always stay near it.  A
document's own evidence is taken out of its sites' counts before these move
its log odds, so nothing counts twice.

Sums per site are aggregated map-side; a host with a third of all rows sends
one row per task.  Sites join back without forced broadcasts: Spark chooses by
measured size and splits skewed keys.

Defined results: null and empty texts have counts of 0 and are scored by them;
null hosts and paths are sites of their own; documents with contradictory labels
teach nothing; without labels of both kinds every document's own probability is
one half; rows that repeat count and are scored
alike; an empty table gives an empty result; other columns aren't read.
"""

from __future__ import annotations

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .quality_rules import counted
from .shared import materialize

#: Labelled rows that the classifier is fitted on, at most: those with the smallest hashes of doc_id.
SAMPLE = 20_000
#: Bounds of a prior's strength in documents.
WEAKEST, STRONGEST = 5.0, 1000.0
#: How far site evidence may move a document's log odds, either way.
LIMIT = 1.0

#: Logarithms of the counts' rates, one being added to each count as in the quality rules; words and their mean length.
_RATES = {
    "symbols": "ln((n_symbols + 1) / (word_chars + 1))",
    "dup_lines": "ln((n_dup_lines + 1) / (n_lines + 1))",
    "repeats": "ln((n_repeat_words + 1) / (n_words + 1))",
    "length": "ln(1 + n_words)",
    "word_length": "least(word_chars / greatest(n_words, 1), 20) / 10",
}


def rates() -> list[Column]:
    return [F.expr(f"cast({e} as double)").alias(k) for k, e in _RATES.items()]


def fitted(x: np.ndarray, y: np.ndarray) -> np.ndarray:
    """Ridge logistic regression on columns that lie in comparable ranges; first the intercept."""
    z = np.column_stack([np.ones(len(x)), x])
    beta = np.zeros(z.shape[1])
    for _ in range(100):
        p = 1 / (1 + np.exp(-np.clip(z @ beta, -30, 30)))
        step = np.linalg.solve(z.T @ (z * (p * (1 - p))[:, None]) + np.eye(len(beta)), z.T @ (y - p) - beta)
        beta += step
        if np.abs(step).max() < 1e-9:
            break
    return beta


def classifier(stats: DataFrame, labels: DataFrame, sample: int = SAMPLE) -> np.ndarray:
    """Coefficients from at most ``sample`` labelled rows; zeros without labels of both kinds."""
    own = labels.select(labels["doc_id"].cast("bigint").alias("label_id"), labels["quality"].cast("int").alias("quality")).where("quality in (0, 1) and label_id is not null")
    own = own.groupBy("label_id").agg(F.min("quality").alias("quality"), F.max("quality").alias("other")).where("quality = other").select("label_id", "quality")
    chosen = F.broadcast(own.orderBy(F.xxhash64("label_id"), "label_id").limit(sample))  # bounded by `sample`
    # rows that repeat a doc_id count once
    used = stats.join(chosen, F.col("doc_id") == F.col("label_id")).groupBy("label_id").agg(F.first("quality").alias("quality"), F.min(F.struct(*rates())).alias("x"))
    rows = sorted(tuple(r) for r in used.select("quality", "x.*").collect())
    y = np.array([r[0] for r in rows], float)
    if len(set(y)) < 2:
        return np.zeros(len(_RATES) + 1)
    return fitted(np.array([r[1:] for r in rows], float), y)


def strength(sites: DataFrame, within: Column, parent_mean: Column) -> float:
    """A Beta prior's strength by moments over sites ``(n, s, ss)``: mean(1 - mean) over the variance of site means beyond chance, less 1."""
    n, mean = F.col("n"), F.col("s") / F.col("n")
    noise = within / n
    row = sites.where("n > 1").agg(
        F.sum(n * (mean - parent_mean) ** 2).alias("spread"), F.sum(n * noise).alias("noise"), F.sum(n).alias("n"), F.sum(n * parent_mean * (1 - parent_mean)).alias("pq")
    ).first()
    if not row["n"]:
        return STRONGEST
    between = (row["spread"] - row["noise"]) / row["n"]
    return STRONGEST if between <= 0 else float(min(STRONGEST, max(WEAKEST, row["pq"] / row["n"] / between - 1)))


def logit(p: Column) -> Column:
    p = F.greatest(F.least(p, F.lit(1 - 1e-9)), F.lit(1e-9))
    return F.log(p / (1 - p))


def posteriors(evidence: DataFrame) -> DataFrame:
    """``evidence(doc_id, host, path, p)`` with host_post, path_post (both without the document itself) and score."""
    sums = [F.count("*").alias("n"), F.sum("p").alias("s"), F.sum(F.col("p") * F.col("p")).alias("ss")]
    paths = materialize(evidence.groupBy("host", "path").agg(*sums), "site-paths")
    hosts = materialize(paths.groupBy("host").agg(F.sum("n").alias("n"), F.sum("s").alias("s"), F.sum("ss").alias("ss")), "site-hosts")
    whole = hosts.agg(F.sum("n").alias("n"), F.sum("s").alias("s")).first()
    if not whole["n"]:
        theta, m_host, m_path = 0.5, STRONGEST, STRONGEST
    else:
        theta = (whole["s"] + 1) / (whole["n"] + 2)
        within = F.greatest(F.col("ss") / F.col("n") - (F.col("s") / F.col("n")) ** 2, F.lit(0.0))
        m_host = strength(hosts, within, F.lit(theta))
        h = hosts.select(F.col("host").alias("h"), (F.col("s") / F.col("n")).alias("host_mean"))
        m_path = strength(paths.join(h, F.col("host").eqNullSafe(F.col("h"))), within, F.col("host_mean"))
    h = hosts.select(F.col("host").alias("h_host"), F.col("n").alias("hn"), F.col("s").alias("hs"))
    sites = paths.join(h, F.col("host").eqNullSafe(F.col("h_host"))).select(F.col("host").alias("s_host"), F.col("path").alias("s_path"), "hn", "hs", F.col("n").alias("pn"), F.col("s").alias("ps"))
    joined = evidence.join(sites, F.col("host").eqNullSafe(F.col("s_host")) & F.col("path").eqNullSafe(F.col("s_path")))
    host_post = (F.col("hs") - F.col("p") + m_host * theta) / (F.col("hn") - 1 + m_host)
    with_host = joined.withColumn("host_post", host_post)
    with_path = with_host.withColumn("path_post", (F.col("ps") - F.col("p") + m_path * F.col("host_post")) / (F.col("pn") - 1 + m_path))
    shift = logit(F.col("path_post")) - logit(F.lit(theta))
    z = logit(F.col("p")) + F.greatest(F.least(shift, F.lit(LIMIT)), F.lit(-LIMIT))
    return with_path.withColumn("score", 1 / (1 + F.exp(-z)))


def scored(docs: DataFrame, labels: DataFrame, sample: int = SAMPLE) -> DataFrame:
    """``docs(doc_id, text, host, path)`` to ``(doc_id, doc_score, host_post, path_post, score, good)``."""
    own = docs.select("doc_id", "text", docs["host"].alias("lang"), docs["path"].alias("source"))
    stats = materialize(counted(own).withColumnsRenamed({"lang": "host", "source": "path"}), "site-counts")
    beta = classifier(stats, labels, sample)
    z = F.lit(float(beta[0]))
    for b, r in zip(beta[1:], rates(), strict=True):
        z = z + F.lit(float(b)) * r
    evidence = stats.select("doc_id", "host", "path", (1 / (1 + F.exp(-z))).alias("p"))
    out = posteriors(evidence)
    return out.select("doc_id", F.col("p").alias("doc_score"), "host_post", "path_post", "score", (F.col("score") >= 0.5).alias("good"))

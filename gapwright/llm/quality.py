"""Hierarchical empirical Bayes quality classifier.

A document's evidence is the log-likelihood ratio of a logistic regression over its distinct words and a few
binned style measures. Features are chosen by grouped counts over labelled rows (at most about `MOST_LABELS`,
drawn by row): style bins, and words whose shares of good and of other rows differ by `Z` standard errors, in
`LEAST_ROWS` rows or more, at most `MOST_FEATURES` of the most telling. The weights are fitted on about `FIT_ROWS` of these rows. Each
document's probability then enters the sums of its path and its host over the whole table; a path's rate is shrunk toward
its host's, a host's toward the global rate, each by a strength estimated from the spread of the groups (method of
moments). A document's own probability is left out of the rates that it is judged by, so its evidence counts once. The
posterior adds the evidence to the log odds of the path's shrunken rate. With `url_col`, host and path (its first
part) come from the address; else from two columns. `documents` has no address: there the source stands for the host and
the language section for the path, which is all that this table can show.

Nulls: a null text has no words (its style bins count); a null host or path is a group of its own; a null id is
kept as null; labels of null are ignored. A very long text is cut into features alone. Of several labels of one id all count. Empty tables give no rows;
without labels of both kinds every weight is 0 and the prior decides. Other columns are not read."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .shared import PUNCTUATED, arrow_map, buffer_of, slices, small, staged, words_of

MOST_LABELS, FIT_ROWS, MOST_FEATURES, Z, LEAST_ROWS = 200_000, 20_000, 20_000, 4.0, 5
#: A feature that every text has.
CONSTANT = -1_000_000


def features_of(h: np.ndarray, bare: np.ndarray, raw: np.ndarray) -> np.ndarray:
    """Distinct feature ids of one text: hashes (top bit cleared) of words as they stand and without
    punctuation, and style bins (small negative numbers)."""
    words = (np.unique(h) >> np.uint64(1)).astype(np.int64)
    stripped = (np.unique(bare) >> np.uint64(1)).astype(np.int64) ^ 1
    n = max(1, len(raw))
    odd = np.isin(raw, np.frombuffer(b"#*$%&|<>{}[]=_~^@", np.uint8)).sum() / n
    digit = ((raw >= 48) & (raw <= 57)).sum() / n
    upper = ((raw >= 65) & (raw <= 90)).sum() / n
    again = 1 - len(words) / max(1, len(h))
    mean = n / max(1, len(h))
    share = lambda x: int(min(19, x * 40))
    style = [share(odd), share(digit), share(upper), int(min(19, again * 20)), int(min(19, mean)), int(min(19, np.log2(1 + len(h))))]
    return np.concatenate([words, stripped, np.array([CONSTANT, *(-1 - 20 * k - x for k, x in enumerate(style))], np.int64)])


def _texts(part: pa.RecordBatch):
    buf, at = buffer_of(part.column("text"))
    h, _, _, first = words_of(buf, at)
    bare, _, _, first2 = words_of(buf, at, apart=PUNCTUATED)
    for a, b, c, d, s, e in zip(*(x.tolist() for x in (first[:-1], first[1:], first2[:-1], first2[1:], at[:-1], at[1:])), strict=True):
        yield features_of(h[a:b], bare[c:d], buf[s:e])


def fit(labelled: DataFrame) -> dict[int, float]:
    """Weights by feature of rows (text, good)."""

    def run(batches):
        for part in slices(batches, most=8 << 20):
            good = np.array(part.column("good").to_pylist(), bool)
            each = list(_texts(part))
            ids, where = np.unique(np.concatenate(each), return_inverse=True)
            side = np.repeat(good, [len(x) for x in each])
            yield pa.RecordBatch.from_arrays([pa.array(ids, pa.int64()), pa.array(np.bincount(where, side, len(ids)).astype(np.int64)), pa.array(np.bincount(where, ~side, len(ids)).astype(np.int64))], names=["feature", "n1", "n0"])

    total = {bool(r["good"]): r["n"] for r in labelled.groupBy("good").agg(F.count("*").alias("n")).collect()}
    t1, t0 = total.get(True, 0), total.get(False, 0)
    if not t1 or not t0:
        return {}
    counts = arrow_map(labelled, run, "feature long, n1 long, n0 long").groupBy("feature").agg(F.sum("n1").alias("n1"), F.sum("n0").alias("n0"))
    # two proportions against the pooled one: also tells for words that one kind never has
    rate = (F.col("n1") + F.col("n0")) / F.lit(float(t1 + t0))
    error = F.sqrt(rate * (1 - rate) * (1 / t1 + 1 / t0))
    z = F.abs(F.col("n1") / t1 - F.col("n0") / t0) / F.greatest(error, F.lit(1e-12))
    telling = counts.where(F.col("n1") + F.col("n0") >= LEAST_ROWS).select("feature", F.when(F.col("feature") < 0, F.lit(1e9)).otherwise(z).alias("z")).where(F.col("z") >= Z)
    keys = np.sort(np.array([r["feature"] for r in telling.orderBy(F.desc("z"), "feature").limit(MOST_FEATURES).collect()], np.int64))
    return dict(zip(keys.tolist(), _regression(labelled, keys, (t1 + t0)).tolist(), strict=True))


def _regression(labelled: DataFrame, keys: np.ndarray, rows: int, steps: int = 250, ridge: float = 3e-5) -> np.ndarray:
    """Weights of the features by full-batch Adam on a bounded sample; evidence is what they add to the base rate."""

    def run(batches):
        for part in slices(batches):
            out = []
            for x in _texts(part):
                at = np.searchsorted(keys, x)
                out.append(at[(at < len(keys)) & (keys[np.minimum(at, len(keys) - 1)] == x)].astype(np.int32))
            yield pa.RecordBatch.from_arrays([part.column("good"), pa.array(out, pa.list_(pa.int32()))], names=["good", "at"])

    if not len(keys):
        return np.zeros(0)
    part = min(1.0, FIT_ROWS / max(1, rows))
    # by row (of a staged table), so rows of one text are drawn each for itself
    some = labelled.where(F.rand(7) < part)
    data = arrow_map(some, run, "good boolean, at array<int>").toPandas()
    if not len(data):
        return np.zeros(len(keys))
    y = data["good"].to_numpy(bool).astype(float)
    sizes = np.array([len(x) for x in data["at"]])
    at, row = np.concatenate(list(data["at"])).astype(np.int64), np.repeat(np.arange(len(y)), sizes)
    base = float(np.clip(y.mean(), 1e-3, 1 - 1e-3))
    w, m, v = (np.zeros(len(keys)) for _ in range(3))
    for k in range(1, steps + 1):
        z = np.log(base / (1 - base)) + np.bincount(row, w[at], len(y))
        g = np.bincount(at, (1 / (1 + np.exp(-np.clip(z, -30, 30))) - y)[row], len(keys)) / len(y) + ridge * w
        m, v = 0.9 * m + 0.1 * g, 0.999 * v + 0.001 * g * g
        w -= 0.1 * m / (1 - 0.9**k) / (np.sqrt(v / (1 - 0.999**k)) + 1e-6)
    return w


def evidence(docs: DataFrame, weights: dict[int, float]) -> DataFrame:
    """docs (doc_id, text, host, path) -> doc_id, host, path, evidence."""
    keys = np.array(sorted(weights), np.int64)
    values = np.array([weights[k] for k in keys.tolist()])
    model = docs.sparkSession.sparkContext.broadcast((keys, values))

    def run(batches):
        keys, values = model.value
        for part in slices(batches):
            out = []
            for x in _texts(part):
                at = np.minimum(np.searchsorted(keys, x), max(0, len(keys) - 1))
                out.append(float(values[at[keys[at] == x]].sum()) if len(keys) else 0.0)
            yield pa.RecordBatch.from_arrays([*(part.column(c) for c in ("doc_id", "host", "path")), pa.array(out, pa.float64())], names=["doc_id", "host", "path", "evidence"])

    return arrow_map(docs, run, "doc_id long, host string, path string, evidence double")


def _strength(groups: DataFrame, parent: str) -> float:
    """Prior strength of a beta-binomial by the method of moments: within-group over between-group variance."""
    m = F.col(parent)
    r = groups.agg(F.sum("n"), F.sum(F.col("n") * (F.col("s") / F.col("n") - m) ** 2), F.sum(m * (1 - m)), F.sum(F.col("n") * m * (1 - m)), F.count("*")).first()
    n, spread, within, base, k = (float(x or 0) for x in r)
    if not n or k < 2:
        return 10.0
    between = max(1e-6, (spread - within) / n)
    return float(np.clip(base / n / between, 1.0, 10_000.0))


def classify(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", host_col: str = "source", path_col: str = "lang", url_col: str | None = None, good: str = "quality = 1 and toxic = 0", least: float = 0.5) -> DataFrame:
    """doc_id, evidence, host_rate, path_rate, score (posterior probability of good), kept (score >= least)."""
    host, path = F.col(host_col or url_col).cast("string"), F.col(path_col or url_col).cast("string")
    if url_col:
        bare = F.regexp_replace(F.col(url_col).cast("string"), r"^[A-Za-z][A-Za-z0-9+.-]*://(?:[^/?#@]*@)?", "")
        host, path = F.lower(F.regexp_extract(bare, r"^([^/?#:]*)", 1)), F.regexp_extract(bare, r"^[^/?#]*/([^/?#]*)", 1)
    source = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text"), host.alias("host"), path.alias("path"))
    known = staged(labels.select(F.col("doc_id").cast("long").alias("doc_id"), F.expr(good).alias("good")).where("doc_id is not null and good is not null"))
    some = min(1.0, MOST_LABELS / max(1, known.count()))
    chosen = staged(known.where(F.rand(5) < some))
    weights = fit(staged(source.join(F.broadcast(chosen), "doc_id").select("text", "good")))
    prior = chosen.agg(F.avg(F.col("good").cast("double"))).first()[0]
    prior = float(np.clip(0.5 if prior is None else prior, 1e-3, 1 - 1e-3))
    scored = staged(evidence(source, weights))
    logit = F.lit(float(np.log(prior / (1 - prior))))
    p = 1 / (1 + F.exp(-(F.col("evidence") + logit)))
    # sums by path, host and over all: partial sums first, so a hot host is one row a task
    paths = staged(scored.groupBy("host", "path").agg(F.count("*").alias("n"), F.sum(p).alias("s")))
    hosts = paths.groupBy("host").agg(F.sum("n").alias("n"), F.sum("s").alias("s"))
    total = paths.agg(F.sum("n"), F.sum("s")).first()
    mean = float(np.clip(total[1] / total[0], 1e-3, 1 - 1e-3)) if total[0] else prior
    hosts = staged(hosts.withColumn("mean", F.lit(mean)))
    mh = _strength(hosts, "mean")
    rate = lambda s, n, m, up: (F.greatest(s, F.lit(0.0)) + m * up) / (n + m)
    hosts = hosts.select("host", F.col("n").alias("nh"), F.col("s").alias("sh"), rate(F.col("s"), F.col("n"), mh, F.col("mean")).alias("up"))
    paths = staged(paths.alias("p").join(hosts.alias("h"), F.expr("p.host <=> h.host")).select("p.host", "path", "n", "s", "nh", "sh", "up"))
    mp = _strength(paths, "up")
    joined = scored.withColumn("p", p).alias("d").join(small(paths.drop("up")).alias("r"), F.expr("d.host <=> r.host and d.path <=> r.path"), "left")
    # the rates of the others: without the document itself
    joined = joined.select("doc_id", "evidence", "p", "n", "s", "nh", "sh").withColumn("host_rate", rate(F.col("sh") - F.col("p"), F.col("nh") - 1, mh, F.lit(mean)))
    joined = joined.withColumn("path_rate", rate(F.col("s") - F.col("p"), F.col("n") - 1, mp, F.col("host_rate")))
    odds = F.least(F.greatest("path_rate", F.lit(1e-6)), F.lit(1 - 1e-6))
    score = 1 / (1 + F.exp(-(F.col("evidence") + F.log(odds / (1 - odds)))))
    return joined.select("doc_id", "evidence", "host_rate", "path_rate", score.alias("score")).withColumn("kept", F.col("score") >= least)


def op4_empirical_bayes(spark, sf_dir: str) -> DataFrame:
    """Query: every document with its posterior; host is the source, path the language section of it."""
    out = classify(spark.read.parquet(f"{sf_dir}/documents.parquet"), spark.read.parquet(f"{sf_dir}/labels.parquet"))
    return out.select("doc_id", *(F.round(c, 6).alias(c) for c in ("evidence", "host_rate", "path_rate", "score")), "kept")

"""URL filtering: host and path rules first, gradient-boosted trees on lexical features else.

Rules are matched with column functions. URLs that a rule decides are the labelled ones;
trees are boosted on features of theirs (lengths, depth, digit ratio, entropy, parameter
counts, statistics of host suffixes) and decide the URLs that no rule fits.
"""

from __future__ import annotations

import math
import re
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from corvox.llm._shared import small_batches

BINS, DEPTH, ROUNDS, RATE, RIDGE = 32, 3, 40, 0.2, 1.0
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def host_of(url: Column) -> Column:
    """After the first ``://`` up to ``/``, ``?``, ``#`` or the end, A-Z lower-cased; else empty."""
    return F.translate(F.coalesce(F.regexp_extract(url, r"(?s)^.*?://([^/?#]*)", 1), F.lit("")), UPPER, LOWER)


def path_of(url: Column) -> Column:
    """What follows the host, up to ``?``, ``#`` or the end; else empty."""
    return F.coalesce(F.regexp_extract(url, r"(?s)^.*?://[^/?#]*([^?#]*)", 1), F.lit(""))


def matched_rule(host: Column, path: Column, rules: list[tuple[str, str]]) -> Column:
    """The longest fitting rule as struct(rule, verdict), null if none fits. Of rules of one
    length the first in order of (rule, verdict) is taken."""
    best = F.lit(None).cast("struct<rule:string,verdict:string>")
    for verdict, rule in sorted(rules, key=lambda r: (len(r[1]), [-ord(c) for c in r[1]], [-ord(c) for c in r[0]])):
        name, slash, rest = rule.partition("/")
        fits = ((host == name) | host.endswith("." + name)) & path.startswith(slash + rest)
        best = F.when(fits, F.struct(F.lit(rule).alias("rule"), F.lit(verdict).alias("verdict"))).otherwise(best)
    return best


def entropy(text: str) -> float:
    n = len(text)
    return -sum(k / n * math.log2(k / n) for k in Counter(text).values()) if n else 0.0


def suffixes(host: str) -> list[str]:
    """The last label, the last two, and the last three."""
    labels = host.split(".")
    return [".".join(labels[-k:]) for k in (1, 2, 3)]


def lexical(url: str | None) -> tuple[list[float], list[str]]:
    """(numbers, keys of statistics: host suffixes, first directory, file suffix); null counts as empty."""
    url = url or ""
    rest = url.partition("://")[2]
    host = re.split(r"[/?#]", rest)[0].translate(str.maketrans(UPPER, LOWER))
    path = re.split(r"[?#]", rest[len(host) :])[0]
    query = rest.partition("#")[0].partition("?")[2]
    digits = sum(c.isdigit() for c in url)
    numbers = [
        len(url), len(host), len(path), len(query), path.count("/"), host.count("."), host.count("-"),
        digits / max(1, len(url)), sum(c.isdigit() for c in host) / max(1, len(host)), entropy(url), entropy(host),
        len(query.split("&")) if query else 0, "#" in rest, url.startswith("https"), path.endswith("/"), "." in path.rpartition("/")[2],
    ]
    return [float(x) for x in numbers], [*suffixes(host), path[1:].partition("/")[0], path.rpartition(".")[2] if "." in path else ""]


@dataclass
class Trees:
    """A boosted model: suffix statistics, bin edges, and trees of (feature, bin) splits."""

    base: float
    stats: list[dict[str, float]]
    edges: list[np.ndarray]
    splits: list[tuple[np.ndarray, np.ndarray]]
    leaves: list[np.ndarray]

    def features(self, urls: list[str | None]) -> np.ndarray:
        rows = []
        for url in urls:
            numbers, keys = lexical(url)
            rows.append(numbers + [stat.get(key, 0.0) for stat, key in zip(self.stats, keys, strict=True)])
        return np.array(rows, np.float64).reshape(len(urls), -1)

    def binned(self, x: np.ndarray) -> np.ndarray:
        return np.stack([np.searchsorted(e, x[:, f], side="left") for f, e in enumerate(self.edges)], axis=1) if len(self.edges) else np.zeros((len(x), 0), int)

    def margin(self, urls: list[str | None]) -> np.ndarray:
        if not self.leaves:
            return np.full(len(urls), self.base)
        binned, out = self.binned(self.features(urls)), np.full(len(urls), self.base)
        for (feature, cut), leaf in zip(self.splits, self.leaves, strict=True):
            out += leaf[walk(binned, feature, cut)]
        return out


def walk(binned: np.ndarray, feature: np.ndarray, cut: np.ndarray) -> np.ndarray:
    """Leaf of each row in a full tree whose node k splits on feature[k] <= cut[k]."""
    node, rows = np.zeros(len(binned), np.int64), np.arange(len(binned))
    for _ in range(DEPTH):
        node = 2 * node + 1 + (binned[rows, feature[node]] > cut[node])
    return node - (2**DEPTH - 1)


def fit(urls: list[str], blocked: list[int]) -> Trees:
    """Boost ROUNDS trees on the log loss, with second-order splits over binned features."""
    y = np.asarray(blocked, np.float64)
    if not len(y) or y.min() == y.max():
        return Trees(8.0 if len(y) and y[0] else -8.0, [], [], [], [])
    prior = math.log(y.mean() / (1 - y.mean()))
    keys = [lexical(u)[1] for u in urls]
    stats = []
    for k in range(len(keys[0])):
        n, hit = Counter(row[k] for row in keys), Counter(row[k] for row, b in zip(keys, blocked, strict=True) if b)
        stats.append({key: math.log((hit[key] + y.mean()) / (c - hit[key] + 1 - y.mean())) - prior for key, c in n.items()})
    model = Trees(prior, stats, [], [], [])
    x = model.features(urls)
    model.edges = [np.unique(np.quantile(x[:, f], np.linspace(0, 1, BINS + 1)[1:-1])) for f in range(x.shape[1])]
    binned, margin, n_features = model.binned(x), np.full(len(y), prior), x.shape[1]
    for _ in range(ROUNDS):
        p = 1 / (1 + np.exp(-margin))
        g, h = p - y, p * (1 - p)
        feature, cut = np.zeros(2**DEPTH - 1, np.int64), np.full(2**DEPTH - 1, BINS, np.int64)
        node = np.zeros(len(y), np.int64)
        for level in range(DEPTH):
            for k in range(2**level - 1, 2 ** (level + 1) - 1):
                here = np.flatnonzero(node == k)
                if len(here) > 1:
                    sums = np.zeros((2, n_features, BINS + 1))
                    for f in range(n_features):
                        for s, v in enumerate((g, h)):
                            sums[s, f] = np.bincount(binned[here, f], v[here], BINS + 1)
                    left = np.cumsum(sums, axis=2)
                    total = left[:, :, -1:]
                    score = lambda s: s[0] ** 2 / (s[1] + RIDGE)
                    gain = score(left) + score(total - left) - score(total)
                    best = int(np.argmax(gain))
                    if gain.flat[best] > 1e-6:
                        feature[k], cut[k] = divmod(best, BINS + 1)
            rows = np.arange(len(y))
            node = 2 * node + 1 + (binned[rows, feature[node]] > cut[node])
        leaf_of = node - (2**DEPTH - 1)
        sum_g, sum_h = np.bincount(leaf_of, g, 2**DEPTH), np.bincount(leaf_of, h, 2**DEPTH)
        leaf = -RATE * sum_g / (sum_h + RIDGE)
        model.splits.append((feature, cut))
        model.leaves.append(leaf)
        margin += leaf[leaf_of]
    return model


def filter_urls(pages: DataFrame, rules: list[tuple[str, str]], id_col: str = "page_id", url_col: str = "url", labelled_rows: int = 20_000) -> DataFrame:
    """One row per row of ``pages``: id, host, path, rule, verdict and, where no rule decides, score.

    ``rules`` are (``block`` or ``allow``, ``host/path``). The trees are fitted on at most about
    ``labelled_rows`` of the URLs that a rule decides, chosen by a hash of the id, each once; with no such
    URL, or one verdict among them, all others get that verdict (``allow`` if there is none). Null
    URLs and those without ``://`` have empty host and path and fit no rule. Repeated rows
    are judged alike, null ids pass through, other columns are not read.
    """
    small_batches(pages.sparkSession)
    base = pages.select(F.col(id_col).alias("_id"), F.col(url_col).alias("_url")).withColumn("host", host_of(F.col("_url"))).withColumn("path", path_of(F.col("_url")))
    ruled = base.withColumn("_rule", matched_rule(F.col("host"), F.col("path"), rules))
    known = ruled.where(F.col("_rule").isNotNull()).select("_id", "_url", (F.col("_rule.verdict") == "block").cast("int").alias("_y"))
    share = min(1.0, labelled_rows / max(1, known.count()))
    unit = F.pmod(F.xxhash64(F.lit("urls"), F.col("_id"), F.col("_url")), F.lit(1_000_003)) / F.lit(1_000_003.0)
    sample = sorted((r["_url"], r["_y"]) for r in known.where(unit < share).select("_url", "_y").distinct().collect())
    model = pages.sparkSession.sparkContext.broadcast(fit([u for u, _ in sample], [y for _, y in sample]))

    names = ["_id", "host", "path", "rule", "_ruled", "_url"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ruled = batch.column(4).to_pylist()
            margin = model.value.margin(batch.column(5).to_pylist())
            score = [None if r else float(1 / (1 + np.exp(-m))) for r, m in zip(ruled, margin, strict=True)]
            verdict = [r or ("block" if s >= 0.5 else "allow") for r, s in zip(ruled, score, strict=True)]
            yield pa.RecordBatch.from_arrays([*batch.columns[:4], pa.array(verdict, pa.string()), pa.array(score, pa.float64())], names=[*names[:4], "verdict", "score"])

    flat = ruled.select("_id", "host", "path", F.col("_rule.rule").alias("rule"), F.col("_rule.verdict").alias("_ruled"), "_url")
    kind = flat.schema["_id"].dataType.simpleString()
    return flat.mapInArrow(run, f"_id {kind}, host string, path string, rule string, verdict string, score double").withColumnRenamed("_id", id_col)

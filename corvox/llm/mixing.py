"""Mixing to target weights by soft membership (DataFrame functions only).

1. A naive Bayes classifier over hashed words is counted from labelled rows; it gives each
   document posteriors over domains, so that a document belongs to several in part.
2. Rates (expected copies of each document, in a box) minimise the squared relative error
   between expected domain token totals and their targets, by projected gradient steps. A
   step needs one number a domain from all documents, and a document's rate follows from
   its posteriors and the residuals so far, so nothing but those numbers moves.
"""

from __future__ import annotations

import logging
import math
from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from corvox.llm._shared import materialize

BUCKETS, SMOOTH, EVIDENCE = 1 << 14, 0.5, 32.0
STEPS, ENOUGH, STILL, PATIENCE, WRITE_EACH = 400, 1e-3, 1e-3, 10, 5
logger = logging.getLogger(__name__)


def _unit(*columns: str | Column) -> Column:
    """A number in [0, 1) by hash."""
    return F.pmod(F.xxhash64(*columns), F.lit(1 << 40)) / F.lit(float(1 << 40))


def _words(text: Column) -> Column:
    return F.filter(F.split(F.translate(F.lower(F.coalesce(text, F.lit(""))), "\n\t\r", "   "), " "), lambda w: w != "")


def _bucket(word: Column) -> Column:
    return F.pmod(F.hash(word), F.lit(BUCKETS))


def classifier(docs: DataFrame, labels: DataFrame, domain: Column, domains: list[str], id_col: str, text_col: str, labelled_rows: int) -> tuple[DataFrame, dict[str, float], dict[str, float]]:
    """(model: bucket with a log weight for each domain; log weight of unseen buckets; log
    priors), from at most about ``labelled_rows`` labelled rows. The model has BUCKETS rows
    at most."""
    known = labels.select(F.col(id_col).alias("_id"), domain.alias("_domain")).where(F.col("_domain").isin(domains)).distinct()
    share = min(1.0, labelled_rows / max(1, known.count()))
    chosen = F.broadcast(known.where(_unit(F.lit("mixing"), "_id") < share))  # bounded by labelled_rows
    rows = docs.select(F.col(id_col).alias("_id"), F.col(text_col).alias("_text")).join(chosen, "_id")
    counted = materialize(rows.select("_domain", F.explode_outer(_words(F.col("_text"))).alias("_w")).groupBy("_domain", _bucket(F.col("_w")).alias("_b")).agg(F.count("_w").alias("n")), "mix-counts")
    total = {r["_domain"]: r["n"] for r in counted.groupBy("_domain").agg(F.sum("n").alias("n")).collect()}
    n_rows = {r["_domain"]: r["count"] for r in chosen.groupBy("_domain").count().collect()}
    all_rows = sum(n_rows.values())
    floor = {d: total.get(d, 0) + SMOOTH * BUCKETS for d in domains}
    log = lambda d, n: F.log((n + SMOOTH) / F.lit(floor[d]))
    model = counted.where("_b is not null").groupBy("_b").agg(*(log(d, F.coalesce(F.sum(F.when(F.col("_domain") == d, F.col("n"))), F.lit(0))).alias(f"_w{k}") for k, d in enumerate(domains)))
    unseen = {d: math.log(SMOOTH / floor[d]) for d in domains}
    prior = {d: math.log((n_rows.get(d, 0) + 1) / (all_rows + len(domains))) for d in domains}
    return model, unseen, prior


def posteriors(docs: DataFrame, model: DataFrame, unseen: dict[str, float], prior: dict[str, float], id_col: str, text_col: str) -> DataFrame:
    """_id, tokens (words) and p0.. (one a domain) of every row; whole texts. A word's
    evidence counts in full up to EVIDENCE words and as their mean beyond."""
    domains = list(prior)
    rows = docs.select(F.col(id_col).alias("_id"), F.monotonically_increasing_id().alias("_row"), F.col(text_col).alias("_text"))
    words = rows.select("_id", "_row", F.explode_outer(_words(F.col("_text"))).alias("_w")).withColumn("_b", _bucket(F.col("_w")))
    weighed = words.join(F.broadcast(model), "_b", "left")  # at most BUCKETS rows
    sums = weighed.groupBy("_row", "_id").agg(F.count("_w").alias("tokens"), *(F.sum(F.when(F.col("_w").isNotNull(), F.coalesce(f"_w{k}", F.lit(unseen[d])))).alias(f"_s{k}") for k, d in enumerate(domains)))
    scale = F.least(F.col("tokens").cast("double"), F.lit(EVIDENCE)) / F.greatest(F.col("tokens"), F.lit(1))
    scored = sums.select("_id", "tokens", *((F.lit(prior[d]) + F.coalesce(f"_s{k}", F.lit(0.0)) * scale).alias(f"_l{k}") for k, d in enumerate(domains)))
    top = F.greatest(*(F.col(f"_l{k}") for k in range(len(domains)))) if len(domains) > 1 else F.col("_l0")
    raised = scored.select("_id", "tokens", *(F.exp(F.col(f"_l{k}") - top).alias(f"_e{k}") for k in range(len(domains))))
    return raised.select("_id", "tokens", *((F.col(f"_e{k}") / sum(F.col(f"_e{j}") for j in range(len(domains)))).alias(f"p{k}") for k in range(len(domains))))


def _total(x: Column) -> Column:
    """A sum that doesn't depend on the order of rows: of whole 65,536ths."""
    return F.sum((x * 65536.0).cast("long").cast("decimal(20,0)")) / 65536


def fit_rates(table: DataFrame, shares: list[float], budget: float, low: float, high: float) -> tuple[DataFrame, list[float], list[float]]:
    """(``table`` with ``rate``, expected totals, targets): projected gradient descent, with momentum,
    from the rate that spends ``budget``. ``table`` must be a written one.

    A step moves two numbers a domain. It ends where all totals are within ``ENOUGH`` of their
    targets, or where none has moved by more than ``STILL`` in ``PATIENCE`` steps: then the box
    doesn't admit the targets. Rates are written every ``WRITE_EACH`` steps, so that a step's
    work doesn't grow.
    """
    k = len(shares)
    target = [max(s * budget, 1.0) for s in shares]
    each = [[F.sum(F.col("tokens") * F.col(f"p{i}") * F.col(f"p{j}")).alias(f"m{i}_{j}") for j in range(k)] for i in range(k)]
    first = table.agg(*(F.sum("tokens").alias("all"), *(x for row in each for x in row))).first()
    total = float(first["all"] or 0)
    matrix = [[float(first[f"m{i}_{j}"] or 0) / target[i] / target[j] for j in range(k)] for i in range(k)]
    vector, size = [1.0] * k, 0.0
    for _ in range(100):  # largest eigenvalue, for the step
        vector = [sum(m * v for m, v in zip(row, vector, strict=True)) for row in matrix]
        size = max(map(abs, vector)) or 1.0
        vector = [v / size for v in vector]
    size = float(f"{size:.6g}")  # sums of doubles differ in their last digits from run to run
    clip: Callable[[Column], Column] = lambda c: F.greatest(F.lit(low), F.least(F.lit(high), c))
    even = F.lit(min(high, max(low, budget / total if total else low)))
    table = table.withColumns({"rate": even, "ahead": even})
    totals: list[list[float]] = []
    momentum, error = 0, math.inf
    for step in range(STEPS + 1):
        at = [_total(F.col("tokens") * F.col(f"p{i}") * F.col(c)).alias(f"{c}{i}") for c in ("rate", "ahead") for i in range(k)]
        sums = table.agg(*at).first()
        reached, beyond = ([float(sums[f"{c}{i}"] or 0) for i in range(k)] for c in ("rate", "ahead"))
        off = [y / t - 1 for y, t in zip(reached, target, strict=True)]
        totals.append(reached)
        still = step >= PATIENCE and max(abs(y - x) / max(y, 1.0) for x, y in zip(totals[-1 - PATIENCE], reached, strict=True)) < STILL
        if step == STEPS or max(map(abs, off)) < ENOUGH or still:
            break
        momentum = momentum + 1 if sum(x * x for x in off) < error else 0
        error = sum(x * x for x in off)
        pull = [(y / t - 1) / t / size for y, t in zip(beyond, target, strict=True)]
        moved = table.withColumn("next", clip(F.col("ahead") - sum(F.col(f"p{i}") * F.lit(pull[i]) for i in range(k))))
        table = moved.withColumn("ahead", F.col("next") + momentum / (momentum + 3) * (F.col("next") - F.col("rate"))).withColumn("rate", F.col("next")).drop("next")
        if step % WRITE_EACH == WRITE_EACH - 1:
            table = materialize(table, "mix-rates")
    return table, reached, target


def mixing_rates(docs: DataFrame, labels: DataFrame, domain: Column, targets: dict[str, float], budget: float = 1.0, low: float = 0.0, high: float = 4.0, id_col: str = "doc_id", text_col: str = "text", labelled_rows: int = 10_000, totals: dict | None = None) -> DataFrame:
    """One row per row of ``docs``: id, tokens, p_<domain> for each, rate, copies.

    ``domain`` names the domain of a row of ``labels``; rows whose domain isn't among
    ``targets`` (or is null) are not learned from. ``targets`` are weights of the mixture's
    tokens, ``budget`` its size as a multiple of the tokens there are. Rates lie between
    ``low`` and ``high``; ``copies`` rounds a rate up or down by a hash of the id, so that it
    is the rate on average. If the box doesn't admit the targets, the fit ends near the closest
    totals, and a warning is logged for each domain over 1 % off; ``totals``, if given, gets
    (reached, target) by domain. The classifier's fit is bounded by ``labelled_rows``; everything
    else covers all rows and whole texts. Null and empty texts have no tokens and the priors as
    posteriors. Repeated rows are weighed each for itself, rows of equal posteriors get equal
    rates. With no labelled row all domains are alike. An empty table gives no rows. Other
    columns are not read.
    """
    domains = sorted(targets)
    model, unseen, prior = classifier(docs, labels, domain, domains, id_col, text_col, labelled_rows)
    table = materialize(posteriors(docs, model, unseen, prior, id_col, text_col), "mix-posteriors")
    weight = sum(targets.values())
    tokens = float(table.agg(F.sum("tokens")).first()[0] or 0)
    table, reached, target = fit_rates(table, [targets[d] / weight for d in domains], budget * tokens, low, high)
    for d, y, t in zip(domains, reached, target, strict=True):
        if totals is not None:
            totals[d] = y, t
        if tokens and abs(y / t - 1) > 0.01:
            logger.warning("mixing: domain %s gets %.0f expected tokens, its target is %.0f", d, y, t)
    rated = table.select(F.col("_id").alias(id_col), "tokens", *(F.col(f"p{k}").alias(f"p_{d}") for k, d in enumerate(domains)), "rate")
    return rated.withColumn("copies", (F.floor("rate") + (_unit(F.lit("copies"), id_col) < F.col("rate") - F.floor("rate")).cast("int")).cast("int"))


def mix(docs: DataFrame, labels: DataFrame, domain: Column, targets: dict[str, float], id_col: str = "doc_id", **fit) -> DataFrame:
    """The rows of ``docs`` with all their columns, whatever their names, each as often as its
    copies say; rows that share an id share their smallest number of copies."""
    rates = mixing_rates(docs, labels, domain, targets, id_col=id_col, **fit).groupBy(F.col(id_col).alias("mixed")).agg(F.min("copies").alias("copies"))
    rows = docs.select(F.struct(*docs.columns).alias("row"), F.col(id_col).alias("id"))
    joined = rows.join(rates, F.col("id").eqNullSafe(F.col("mixed"))).where("copies > 0")
    return joined.select("row", F.explode(F.sequence(F.lit(1), F.col("copies")))).select("row.*")

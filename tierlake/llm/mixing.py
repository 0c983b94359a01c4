"""Mixing to target weights with soft membership, in DataFrame expressions only.

A classifier learned from the labelled table gives each document a posterior over domains, and with it expected tokens per
domain. Projected-gradient least squares then finds a nonnegative rate for each document so that the expected token
totals of the domains meet their targets, and of all such rates those that are nearest to 1.

A gradient step moves a document's rate by its posterior times one number per domain, and the projection keeps it from falling
below zero, so that all rates follow from as many numbers as there are domains. A pass over the documents sums up what each
domain misses, and how the sums answer to those numbers while the documents at zero stay there; the driver scales the next
step by that small matrix, and halves a step that leads away. So a handful of passes meets the targets however much
the domains overlap. Targets that no rates can meet are missed by as little as possible, with a warning that says by how much.
"""

from __future__ import annotations

import math
import warnings
from collections.abc import Mapping
from functools import reduce

import numpy as np
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tierlake.llm.common import columns, fresh, stored

#: Share of tokens of each domain, which `domain_of` names.
TARGETS = {"prose": 0.95, "junk": 0.04, "toxic": 0.01}
#: Bounds of what is learned from: labelled documents, and words of the lexicon for each domain.
LABELLED, LEXICON = 4000, 64
#: A domain's tokens meet their target when they miss it by no more than this part of the tokens there are of it; what weight
#: nearness to 1 has beside that; and passes after which the miss is reported as it is.
CLOSE, NEARNESS, PASSES = 1e-6, 1e-10, 200
_SEEN = 8  # documents of the sample that a word of the lexicon is in, at least


def domain_of() -> Column:
    """The domain of a row of `labels`; NULL if the labels do not say."""
    toxic, quality = F.col("toxic"), F.col("quality")
    return F.when(toxic == 1, "toxic").when(quality == 0, "junk").when((quality == 1) & (toxic == 0), "prose")


def _words(text: Column) -> Column:
    return F.array_remove(F.split(F.lower(text), r"\s+"), "")


def _lexicon(sample: DataFrame, domains: list[str]) -> dict[str, list[str]]:
    """The words that tell each domain from the others, by log-odds."""
    words = sample.select("domain", F.explode(F.array_distinct(_words(F.col("text")))).alias("word"))
    own = words.groupBy("domain", "word").agg(F.count("*").alias("n"))
    odds = own.withColumn("all", F.sum("n").over(Window.partitionBy("word"))).filter(F.col("n") >= _SEEN)
    odds = odds.withColumn("odds", F.log((F.col("n") + 0.5) / (F.col("all") - F.col("n") + 0.5)))
    best = Window.partitionBy("domain").orderBy(F.desc("odds"), F.desc("n"), "word")
    rows = odds.withColumn("rank", F.row_number().over(best)).filter(F.col("rank") <= LEXICON).collect()
    return {d: sorted(row["word"] for row in rows if row["domain"] == d) for d in domains}


def _measures(text: Column, words: Column, lexicon: Mapping[str, list[str]]) -> list[Column]:
    """What the classifier looks at."""
    size, chars = F.greatest(F.size(words), F.lit(1)), F.greatest(F.length(text), F.lit(1))
    found = [
        F.log1p(chars / size),
        F.size(F.array_distinct(words)) / size,
        F.sqrt(F.regexp_count(text, F.lit(r"[^\p{L}\p{N}\s.,]")) / chars),
        F.sqrt(F.regexp_count(text, F.lit(r"\p{Lu}")) / chars),
    ]
    for own in lexicon.values():
        if own:
            found.append(F.log1p(F.size(F.array_intersect(words, F.array(*map(F.lit, own))))))
    return found


def _posterior(measured: DataFrame, measure: str, size: int, chosen: DataFrame, key: str, domains: list[str]) -> list[Column]:
    """The probability of each domain, from the mean and variance of the labelled documents' measures."""
    rows = measured.select(F.col(key).cast("long").alias("id"), F.col(measure).alias("m")).join(F.broadcast(chosen), "id")
    of = [f(F.col("m")[i]).alias(f"{name}{i}") for i in range(size) for name, f in (("mean", F.avg), ("var", F.var_pop))]
    known = {row["domain"]: row for row in rows.groupBy("domain").agg(F.count("*").alias("n"), *of).collect()}
    if not known:
        return []
    total = sum(row["n"] for row in known.values())
    logs = []
    for d in domains:
        if d not in known:
            logs.append(F.lit(float("-inf")))
            continue
        row, parts = known[d], F.lit(math.log(known[d]["n"] / total))
        for i in range(size):
            mean, var = row[f"mean{i}"], max(row[f"var{i}"], 1e-3)
            parts -= (F.col(measure)[i] - mean) * (F.col(measure)[i] - mean) / (2 * var) + 0.5 * math.log(var)
        logs.append(parts)
    top = F.greatest(*logs) if len(logs) > 1 else logs[0]
    likely = [F.exp(part - top) for part in logs]
    return [part / reduce(lambda a, b: a + b, likely) for part in likely]


def rates(
    docs: DataFrame,
    labels: DataFrame,
    targets: Mapping[str, float] = TARGETS,
    budget: float | None = None,
    whole: bool = False,
    keep: str | None = None,
) -> DataFrame:
    """One row per document, repeated ones too: doc_id, n_tokens, domain (the likeliest), rate, posterior (by domain's name).

    `whole` gives all columns of `docs` and the rate instead, named `rate` or, where that is taken, `rate_`. Tokens are words
    between white space. `targets` are shares by domain, and `budget` the tokens to hand out; without one it is as many as need
    no domain to be repeated. With the name of a domain in `keep` that domain's tokens all stay, and the shares of the others
    are what they may have at most beside it, so a scarce domain makes nothing else go. A NULL or empty text has no tokens, so its rate changes no total. A labelled row without a
    document, with NULLs or with conflicting repeats is used as far as it says something. With no labelled document, or
    no tokens, every rate is 1 and the domain NULL. An empty table gives no rows. Targets that cannot be met give a warning.
    """
    domains = sorted(targets)
    own = labels.select(F.col("doc_id").cast("long").alias("id"), domain_of().alias("domain")).dropna()
    own = own.filter(F.col("domain").isin(domains)).groupBy("id").agg(F.min("domain").alias("domain"))
    chosen = own.join(docs.select(F.col("doc_id").cast("long").alias("id")).distinct(), "id", "left_semi")
    chosen = stored(chosen.orderBy(F.xxhash64("id"), "id").limit(LABELLED))
    text = F.coalesce(F.col("text"), F.lit(""))
    sample = docs.select(F.col("doc_id").cast("long").alias("id"), text.alias("text"))
    sample = sample.join(F.broadcast(chosen), "id").dropDuplicates(["id"])  # LABELLED rows at most
    lexicon = _lexicon(sample, domains)

    if not whole:
        docs = docs.select("doc_id", "text")
    n, domain, rate, measure, words, soft = fresh(docs, "n_tokens", "domain", "rate", "measure", "words", "soft")
    split = docs.withColumn(words, _words(text))
    found = _measures(text, F.col(words), lexicon)
    own = columns(docs) if whole else [F.col("doc_id").cast("long").alias("doc_id")]
    measured = stored(split.select(*own, F.size(words).cast("long").alias(n), F.array(*found).alias(measure)))
    posterior = _posterior(measured, measure, len(found), chosen, "doc_id", domains)
    if posterior:
        small = stored(measured.select(n, F.array(*posterior).alias(soft)).filter(F.col(n) > 0))
        prices = _fit(small, n, soft, [targets[d] for d in domains], budget, domains.index(keep) if keep else None)
        likeliest = F.element_at(F.array(*map(F.lit, domains)), F.array_position(soft, F.array_max(soft)).cast("int"))
        measured = measured.withColumn(soft, F.array(*posterior))
        measured = measured.withColumns({rate: _rate(F.col(soft), prices), domain: likeliest})
    else:
        unknown = {soft: F.lit(None).cast("array<double>"), domain: F.lit(None).cast("string")}
        measured = measured.withColumns({rate: F.lit(1.0)} | unknown)
    if whole:
        return measured.select(*columns(docs), F.col(rate))
    return measured.select("doc_id", n, domain, rate, F.col(soft).alias("posterior"))


def _rate(soft: Column, prices: list[float]) -> Column:
    """The rate of a document with this posterior when a token of each domain costs so much."""
    return F.greatest(F.lit(0.0), F.lit(1.0) - _sum(soft[k] * float(price) for k, price in enumerate(prices)))


def _sum(parts) -> Column:
    return reduce(lambda a, b: a + b, parts)


def _goal(there: list[float], shares: list[float], budget: float | None, keep: int | None) -> list[float]:
    """Tokens that each domain shall have."""
    if budget is not None:
        return [budget * share for share in shares]
    if keep is None:
        budget = min(t / share for t, share in zip(there, shares, strict=True) if share > 0 and t > 0)
        return [budget * share for share in shares]
    if not (there[keep] > 0 and shares[keep] > 0):
        return there  # nothing to measure the others by
    budget = there[keep] / shares[keep]
    return [t if k == keep else min(t, budget * share) for k, (t, share) in enumerate(zip(there, shares, strict=True))]


def _fit(
    small: DataFrame, n: str, soft: str, shares: list[float], budget: float | None, keep: int | None = None
) -> list[float]:
    """The sum of all gradient steps, a number per domain from which `_rate` gives a document's rate.

    They minimise the squared misses, each relative to the tokens there are of its domain, and beside them, with a weight
    that is next to nothing, the squared distances of all rates from 1.
    """
    size = len(shares)
    pairs = [(k, m) for k in range(size) for m in range(k, size)]

    def passed(prices: np.ndarray) -> tuple[np.ndarray, np.ndarray, float]:
        """Tokens of each domain, how they fall as prices rise, and the sum of the squared rates."""
        rate, one = _rate(F.col(soft), prices.tolist()), [F.col(soft)[k] for k in range(size)]
        sums = [F.sum(F.col(n) * rate * one[k]) for k in range(size)]
        sums += [F.sum(F.when(rate > 0, F.col(n) * one[k] * one[m]).otherwise(0.0)) for k, m in pairs]
        row = small.agg(*(s.alias(f"s{i}") for i, s in enumerate([*sums, F.sum(F.col(n) * rate * rate)]))).first()
        row = [value or 0.0 for value in row]
        answer = np.zeros((size, size))
        for (k, m), value in zip(pairs, row[size:-1], strict=True):
            answer[k, m] = answer[m, k] = value
        return np.array(row[:size]), answer, row[-1]

    prices = np.zeros(size)
    now, answer, squares = passed(prices)
    there = now.copy()
    some = there > 0
    if not some.any():
        return prices.tolist()
    goal = np.where(some, _goal(there.tolist(), shares, budget, keep), 0.0)
    ridge = NEARNESS * np.where(some, there, 1.0)

    def cost(prices: np.ndarray, squares: float) -> float:
        """What falls with every step that is right: the dual of the least squares."""
        return squares / 2 + prices @ goal + (ridge * prices) @ prices / 2

    best, passes = cost(prices, squares), 1
    while passes < PASSES:
        slope = now - goal - ridge * prices
        if (np.abs(slope[some]) <= CLOSE / 10 * there[some]).all():
            break
        step, length = np.linalg.solve(answer + np.diag(ridge + 1e-12 * there.max()), slope), 1.0
        while passes < PASSES:
            tried = prices + length * step
            found = passed(tried)
            passes += 1
            if cost(tried, found[2]) <= best - 1e-4 * length * (step @ slope) + 1e-12 * abs(best):
                break
            length /= 2
        prices, (now, answer, squares) = tried, found
        best = cost(prices, squares)
    miss = np.abs(now - goal)[some] / there[some]
    if miss.max() > CLOSE:
        warnings.warn(f"the targets cannot be met; tokens of the domains miss them by {miss.round(6).tolist()} of what there is", stacklevel=3)
    return prices.tolist()


def resample(docs: DataFrame, labels: DataFrame, targets: Mapping[str, float] = TARGETS, keep: str | None = None) -> DataFrame:
    """The rows of `docs`, all columns, each as often as its rate says: the whole part of it, and once more with the rest as chance.

    Chance is a hash of the row, so runs agree, and rows that are equal in all columns have one fate; rows with a rate of 0 go.
    `keep` is as in `rates`, and so is what NULL, empty and long texts get. Columns may have any names.
    """
    weighted = rates(docs, labels, targets, whole=True, keep=keep)
    rate = weighted.columns[-1]
    (copy,) = fresh(weighted, "copy")
    chance = F.pmod(F.xxhash64(*columns(docs), F.lit("mix")), F.lit(1 << 40)) / float(1 << 40)
    times = F.floor(F.col(rate) + chance).cast("int")
    copies = weighted.withColumn(copy, F.explode(F.when(times > 0, F.sequence(F.lit(1), times)).otherwise(F.array())))
    return copies.select(*columns(docs))

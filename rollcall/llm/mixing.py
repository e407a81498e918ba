"""Mixing towards target weights with soft domain membership, in DataFrame functions only.

A classifier learnt from labelled documents gives every document posterior probabilities over the
domains. Distributed projected-gradient least squares then finds a rate for every document so that the
expected tokens of the domains come as near to their targets as the bounds on rates allow.
"""

from __future__ import annotations

import logging
import math
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from rollcall.llm.common import cut, stash


#: Copies of one document that are made side by side.
LOT = 16


def _spaced(text: Column) -> Column:
    """The text with each run of white space as one space, and a space at either end."""
    return F.concat(F.lit(" "), F.trim(F.regexp_replace(F.coalesce(text, F.lit("")), r"[\s]+", " ")), F.lit(" "))


def tokens(text: Column) -> Column:
    """Words of a text; none in a null, empty or blank one."""
    plain = _spaced(text)
    return F.greatest(F.length(plain) - F.length(F.replace(plain, F.lit(" "), F.lit(""))) - 1, F.lit(0)).cast("long") - (F.length(plain) == 2).cast("long")


def words(text: Column) -> Column:
    """Words of a text in lower case, runs of letters, so that marks and digits do not count; '' may be among them."""
    return F.split(F.lower(F.coalesce(text, F.lit(""))), r"[^\p{L}]+")


#: Posteriors are multiples of 1 / GRAIN, so that many documents have the same.
GRAIN = 1000


@dataclass(frozen=True)
class Domains:
    """Multinomial model over the cue words that a text has, each counted once: prior of each domain, and the smoothed share of
    its cue words that each is. Words that a text has not say nothing, so short texts keep their few cues' word."""

    names: tuple[str, ...]
    priors: tuple[float, ...]
    cues: tuple[str, ...]
    rates: tuple[tuple[float, ...], ...]  # by cue, then domain

    def posteriors(self, df: DataFrame, text: str, out: str) -> DataFrame:
        """``df`` with ``out``: array<double> in the order of ``names``, in thousandths that sum to 1.

        Each step is a column of its own that later steps refer to, so a text is searched once.
        """
        each = range(len(self.names))
        known = F.split(F.lit(" ".join(self.cues)), " ")
        # a word that no domain is likelier to have says nothing, so logarithms are taken against the first domain
        weights = [F.split(F.lit(" ".join(repr(math.log(r[k] / r[0])) for r in self.rates)), " ").cast("array<double>") for k in each]
        adding = lambda table: lambda total, at: total + F.element_at(table, at)
        df = df.withColumn("_at", F.transform(F.array_intersect(words(F.col(text)), known), lambda w: F.array_position(known, w).cast("int")))
        for k in each:
            start = F.lit(math.log(self.priors[k]))
            df = df.withColumn(f"_log{k}", F.aggregate("_at", start, adding(weights[k])) if k and self.cues else start)
        df = df.withColumn("_top", F.greatest(*[F.col(f"_log{k}") for k in each], F.lit(-1e300)))
        df = df.withColumns({f"_exp{k}": F.exp(F.col(f"_log{k}") - F.col("_top")) for k in each})
        df = df.withColumn("_sum", sum((F.col(f"_exp{k}") for k in each), F.lit(0.0)))
        # what is rounded is the sum of the first domains, so that the thousandths add up
        sums = [F.lit(0.0), *[F.round(sum((F.col(f"_exp{j}") for j in range(k + 1)), F.lit(0.0)) / F.col("_sum") * GRAIN) for k in each]]
        df = df.withColumns({f"_p{k}": (sums[k + 1] - sums[k]) / GRAIN for k in each})
        used = ["_at", "_top", "_sum", *[f"{x}{k}" for x in ("_log", "_exp", "_p") for k in each]]
        return df.withColumn(out, F.array(*[F.col(f"_p{k}") for k in each])).drop(*used)


def learn_domains(docs: DataFrame, labelled: DataFrame, max_rows: int = 4000, max_bytes: int = 100_000, cues: int = 300) -> Domains | None:
    """Learns from at most ``max_rows`` rows of ``labelled`` (doc_id, domain; of those with a row in ``docs`` the first
    by a hash of doc_id, and of several for a document the smallest domain) with texts of at most ``max_bytes``.
    Rows of ``labelled`` whose document is gone, as a copy of another, take no place in the sample.

    Cues are the words whose presence tells most about the domain (mutual information). None if
    nothing is labelled.
    """
    there = labelled.filter("doc_id is not null and domain is not null").join(docs.select("doc_id"), "doc_id", "left_semi")
    chosen = there.groupBy("doc_id").agg(F.min("domain").alias("_domain")).orderBy(F.xxhash64("doc_id"), "doc_id").limit(max_rows)
    sample = docs.select("doc_id", "text").filter(F.octet_length("text") <= max_bytes).join(F.broadcast(chosen), "doc_id")
    seen = cut(sample.select(F.col("_domain").cast("string").alias("d"), F.array_remove(F.array_distinct(words(F.col("text"))), "").alias("words")))
    count = {r["d"]: r["n"] for r in seen.groupBy("d").agg(F.count("*").alias("n")).collect()}
    if not count:
        return None
    names, total = sorted(count), sum(count.values())
    each = seen.select("d", F.explode("words").alias("w")).groupBy("w").agg(F.count("*").alias("n"), *[F.count_if(F.col("d") == d).alias(f"n{k}") for k, d in enumerate(names)])
    told = F.lit(0.0)
    for k, d in enumerate(names):
        for here, of in ((F.col(f"n{k}"), F.col("n")), (count[d] - F.col(f"n{k}"), total - F.col("n"))):
            told = told + F.when(here > 0, here / total * F.log(here * total / (of * count[d]))).otherwise(0.0)
    best = each.orderBy(told.desc(), "w").limit(cues).collect()
    sums = [sum(r[f"n{k}"] for r in best) + 0.5 * len(best) for k in range(len(names))]
    rates = tuple(tuple((r[f"n{k}"] + 0.5) / sums[k] for k in range(len(names))) for r in best)
    return Domains(tuple(names), tuple(count[d] / total for d in names), tuple(r["w"] for r in best), rates)


def _bounded(rate: Column, low: float, high: float) -> Column:
    return F.greatest(rate if math.isinf(high) else F.least(rate, F.lit(high)), F.lit(low))


def _rate(df: DataFrame, p: str, out: str, steps: list[list[float]], low: float, high: float) -> DataFrame:
    """``df`` with ``out``: a document's rate after these gradient steps, projected after each.

    The steps lie in one array that is gone through: an expression for each would lie within the next, and some
    hundred of them are too deep for the driver's stack.
    """
    rate = F.lit(min(max(1.0, low), high))
    if steps:
        d = len(steps[0])
        flat = F.split(F.lit(" ".join(repr(float(x)) for g in steps for x in g)), " ").cast("array<double>")
        move = lambda at: sum((F.col(p)[i] * F.element_at(flat, at + (i + 1)) for i in range(d)), F.lit(0.0))
        starts = F.sequence(F.lit(0), F.lit(d * (len(steps) - 1)), F.lit(d))
        rate = F.aggregate(starts, rate, lambda r, at: _bounded(r - move(at), low, high))
    return df.withColumn(out, rate)


def fit_rates(points: DataFrame, targets: list[float], low: float, high: float, rounds: int = 200, tolerance: float = 1e-3) -> list[list[float]]:
    """Gradient steps for ``points`` (p array<double>, t tokens), to be taken by ``_rate``.

    Minimises sum over domains of (tokens - target)^2 / present tokens. In the metric that weighs a
    document by its tokens, the gradient at a document is its posteriors times the domains' relative
    misses, so equal posteriors share a rate: the table is summed by posteriors first, and the driver
    sees only one sum for each domain and round. Targets are scaled to the least total that gives
    every present domain a rate of at least 1 (``low`` >= 1), or to the present total (``low`` < 1).
    Documents of several domains may keep a domain above its target at that total; with no ``high``
    the total then grows for as long as that brings the shares nearer. Wanted and reached shares are
    logged, as a warning where they differ by more than a hundredth of the wanted.
    """
    d = len(targets)
    sums = lambda df, r: df.agg(*[F.sum(F.col("t") * F.col("p")[k] * r).alias(f"s{k}") for k in range(d)]).first()
    now = [x or 0.0 for x in sums(points, F.lit(1.0))]
    total = sum(now)
    if not total:
        return []
    share = [x / total for x in now]
    weight = [w / sum(targets) for w in targets]
    scale = max([s / w for s, w in zip(share, weight, strict=True) if w > 0], default=1.0) if low >= 1 else 1.0
    goal = [w * scale for w in weight]
    miss = lambda got: [(g - b) / s if s > 0 else 0.0 for g, b, s in zip(got, goal, share, strict=True)]
    steps: list[list[float]] = []
    best, got = None, share  # what the shares miss at the total before, and the steps that lead there
    rated = points.withColumn("r", F.lit(min(max(1.0, low), high)))
    for k in range(rounds):
        got = [x / total for x in sums(rated, F.col("r"))]
        steps.append(miss(got))
        if max(map(abs, steps[-1])) < tolerance:
            break
        if k and max(abs(a - b) for a, b in zip(steps[-1], steps[-2], strict=True)) < tolerance:
            off = max(abs(g / sum(got) - w) for g, w in zip(got, weight, strict=True))
            if best and off > 0.9 * best[0]:
                _, steps, got = best
                break
            over = max((g / b for g, b in zip(got, goal, strict=True) if b > 0), default=1.0)
            if low < 1 or not math.isinf(high) or over < 1 + tolerance:
                break
            best, goal = (off, list(steps), got), [b * over for b in goal]
            steps[-1] = miss(got)
        rated = rated.withColumn("r", _bounded(F.col("r") - sum((F.col("p")[i] * g for i, g in enumerate(steps[-1])), F.lit(0.0)), low, high))
        if k % 10 == 9:  # so that the expression does not grow; in between it is taken once more
            rated = cut(rated)
    ends = [(round(w, 4), round(g / sum(got), 4)) for w, g in zip(weight, got, strict=True)]
    level = logging.WARNING if any(abs(g - w) > 0.01 * w for w, g in ends) else logging.INFO
    logging.getLogger(__name__).log(level, "shares of the domains, wanted and reached: %s", ends)
    return steps


def plan_mix(docs: DataFrame, labelled: DataFrame, targets: dict[str, float], low: float = 1.0, high: float = math.inf) -> DataFrame:
    """doc_id, text_tokens, posteriors (map by domain), rate, copies for every row of ``docs``.

    Rates are between ``low`` and ``high``, by default without a ceiling; ``copies`` is the rate's whole part, plus one with the
    probability of the rest, decided by a hash of doc_id. With ``low`` at least 1 no document goes.
    Domains without a target aim at 0. Null and empty texts have 0 tokens and the posteriors of a text without
    cues, the priors. Without labels or tokens every rate is 1 (or the nearest bound). Repeated rows each get the
    same rate. Whole texts are read, of any length; other columns are ignored, and an empty table gives an empty result.
    """
    model = learn_domains(docs, labelled)
    own = docs.select("doc_id", "text", tokens(F.col("text")).alias("t"))
    # written once: the fit reads it round after round, and later filters see a plain column
    own = stash((own.withColumn("p", F.array().cast("array<double>")) if model is None else model.posteriors(own, "text", "p")).drop("text"))
    own, _ = _rated(own, own, model, targets, low, high)
    as_map = F.map_from_arrays(F.lit(list(model.names)), F.col("p")) if model else F.create_map().cast("map<string,double>")
    return own.select("doc_id", F.col("t").alias("text_tokens"), as_map.alias("posteriors"), "rate", "copies")


def shares(plan: DataFrame, targets: dict[str, float]) -> dict[str, dict[str, float]]:
    """Of each domain its wanted share of the tokens, and those at present, by rates and by copies.

    ``plan`` is what ``plan_mix`` gives. A domain with a target of which there are no documents has 0.
    """
    each = plan.select("text_tokens", "rate", "copies", F.explode("posteriors").alias("domain", "p"))
    own = F.col("p") * F.col("text_tokens")
    got = {r["domain"]: r for r in each.groupBy("domain").agg(F.sum(own).alias("present"), F.sum(own * F.col("rate")).alias("reached"), F.sum(own * F.col("copies")).alias("dealt")).collect()}
    out = {d: {"wanted": targets.get(d, 0.0) / sum(targets.values())} for d in sorted({*got, *targets})}
    for x in ("present", "reached", "dealt"):
        total = sum(r[x] for r in got.values())
        for d in out:
            out[d][x] = got[d][x] / total if d in got and total else 0.0
    return out


def _rated(df: DataFrame, seen: DataFrame, model: Domains | None, targets: dict[str, float], low: float, high: float) -> tuple[DataFrame, float]:
    """``df`` (doc_id, p) with rate and copies, and the greatest rate; rates are fitted on ``seen`` (p, t)."""
    steps, most = [], min(max(1.0, low), high)
    if model is not None:
        points = cut(seen.groupBy("p").agg(F.sum("t").cast("double").alias("t")))
        steps = fit_rates(points, [float(targets.get(d, 0.0)) for d in model.names], low, high)
        most = _rate(points, "p", "r", steps, low, high).agg(F.max("r")).first()[0] or most
    df = _rate(df, "p", "rate", steps, low, high)
    chance = F.pmod(F.xxhash64("doc_id", F.lit(8)), F.lit(1 << 30)) / float(1 << 30)
    whole = F.floor("rate")
    return df.withColumn("copies", (whole + (chance < F.col("rate") - whole).cast("int")).cast("int")), most


def mix_documents(docs: DataFrame, labelled: DataFrame, targets: dict[str, float], low: float = 1.0, high: float = math.inf) -> DataFrame:
    """The rows of ``docs``, each as often as ``plan_mix`` says, with the same columns. Where a document has more than
    LOT copies, they are dealt over tasks in lots. Odd rows are treated as in ``plan_mix``."""
    model = learn_domains(docs, labelled)
    rows = docs.select(F.struct("*").alias("row"), F.col("doc_id"), F.col("text"))
    rows = rows.withColumn("p", F.array().cast("array<double>")) if model is None else model.posteriors(rows, "text", "p")
    rows, most = _rated(rows, rows.select("p", tokens(F.col("text")).alias("t")), model, targets, low, high)
    # copies of one document that are many come in lots, and the lots go to tasks of their own
    lots = F.ceil(F.col("copies") / LOT).cast("int")
    rows = rows.select("row", "copies", F.explode_outer(F.when(F.col("copies") > 0, F.sequence(F.lit(0), lots - 1))).alias("lot")).filter("lot is not null")
    if most > LOT:
        rows = rows.repartition(F.xxhash64("row.doc_id", "lot"))
    size = F.least(F.lit(LOT), F.col("copies") - F.col("lot") * LOT)
    return rows.select("row", F.explode(F.sequence(F.lit(1), size)).alias("k")).select("row.*")

"""Mixing sources to target weights: token weights raked to marginals, then calibrated sampling.

Documents are summed into cells of source, language and topic. Iterative proportional fitting scales the cells'
token weights to each target marginal in turn until all agree, with no cell above the greatest rate: a cell at that
bound counts with it, and the others make up for the rest. A document is kept with its cell's calibrated rate; a rate
above one repeats it. What the bound leaves of a target that it puts out of reach goes to the dimension's other values
and is reported.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from forumlens.llm.common import Scratch

DIMENSIONS = ("source", "lang", "topic")
TOLERANCE, MAX_ROUNDS = 1e-3, 60
SEED = 20


def form_topic(text: Column) -> Column:
    """A topic by the form of the whole text: tabular, itemised (short lines) or prose."""
    size = F.greatest(F.length(text), F.lit(1))
    count = lambda mark: F.length(text) - F.length(F.replace(text, F.lit(mark), F.lit("")))
    return F.when(count("|") * 40 > size, "tabular").when(count("\n") * 80 > size, "itemised").otherwise("prose")


def tempered(cells: DataFrame, dimension: str, power: float) -> DataFrame:
    """Target shares of a dimension: its shares of tokens to a power, made to sum to one."""
    sums = cells.groupBy(dimension).agg(F.sum("tokens").alias("n"))
    total = sums.agg(F.sum(F.pow("n", F.lit(power)))).first()[0] or 1.0
    return sums.select(dimension, (F.pow("n", F.lit(power)) / total).alias("target"))


def reachable(target: DataFrame, scratch: Scratch, name: str) -> DataFrame:
    """``target`` (``_value``, ``_asked``, ``_most``) with ``_target``: no value above ``_most``, the others in proportion."""
    state = scratch.save(target.withColumns({"_target": F.col("_asked"), "_full": F.lit(False)}), f"{name}_0")
    step = 0
    while state.where("not _full and _target > _most").limit(1).count():
        state = state.withColumn("_full", F.expr("_full or _target > _most"))
        left, asked = state.agg(F.sum(F.expr("if(_full, _most, 0D)")), F.sum(F.expr("if(_full, 0D, _asked)"))).first()
        scale = max(0.0, 1.0 - left) / asked if asked else 0.0
        step += 1
        state = scratch.save(state.withColumn("_target", F.when(F.col("_full"), F.col("_most")).otherwise(F.col("_asked") * scale)), f"{name}_{step}")
    return state.drop("_full")


def rake(
    cells: DataFrame, targets: dict[str, DataFrame], scratch: Scratch, most: float = float("inf"), tolerance: float = TOLERANCE, rounds: int = MAX_ROUNDS
) -> DataFrame:
    """``cells`` with ``weight``, shares that start as tokens and meet the target marginals, and ``unmet``.

    Each target has a column of its dimension's name and ``target``. Values without a target, or whose target is
    zero, weigh nothing; targets without tokens can't be met and are shared out among the others. No weight exceeds
    ``most`` times the cell's share of tokens; what a target exceeds its value's bounds by is shared out likewise. Stops
    when no marginal is off by more than ``tolerance``, or after ``rounds``. ``unmet`` is the greatest share that a
    target of the cell lacks, 0 within the tolerance.
    """
    total = cells.agg(F.sum("tokens")).first()[0] or 1
    share_of = F.col("tokens") / total
    work = scratch.save(cells.withColumns({"_free": share_of, "_bound": share_of * most}), "cells")
    present = {}
    for d, target in targets.items():
        met = target.join(cells.where("tokens > 0").select(d).distinct(), target[d].eqNullSafe(cells[d]), "left_semi")
        share = met.agg(F.sum("target")).first()[0] or 1.0
        asked = met.select(F.col(d).alias("_value"), (F.col("target") / share).alias("_asked"))
        bound = work.groupBy(F.col(d).alias("_of")).agg(F.sum("_bound").alias("_most"))
        present[d] = reachable(asked.join(bound, asked["_value"].eqNullSafe(bound["_of"])).drop("_of"), scratch, f"target_{d}")
    weight, last = F.least("_free", "_bound"), []
    for k in range(rounds):
        off = F.lit(0.0)
        for d, target in present.items():
            held = F.col("_free") >= F.col("_bound")
            sums = work.groupBy(F.col(d).alias("_value")).agg(
                F.sum(weight).alias("_sum"), F.sum(F.when(held, F.col("_bound")).otherwise(0.0)).alias("_held"), F.sum(F.when(held, 0.0).otherwise(F.col("_free"))).alias("_rest"))
            aim = F.coalesce("_target", F.lit(0.0))
            # a step of Newton's method towards the factor at which the bounded weights add up to the target
            step = F.when(F.abs(F.col("_sum") - aim) <= 1e-12, 1.0).when(aim <= F.col("_held"), aim / F.col("_sum"))
            step = step.when(F.col("_rest") > 0, (aim - F.col("_held")) / F.col("_rest")).otherwise(1.0)
            error = F.when(aim > 0, F.abs(F.col("_sum") - aim) / aim).otherwise(0.0)
            factor = sums.join(target, sums["_value"].eqNullSafe(target["_value"]), "left").select(
                sums["_value"], F.when(F.col("_sum") > 0, step).otherwise(0.0).alias("_factor"), error.alias(f"_off_{d}"))
            work = work.join(factor, work[d].eqNullSafe(factor["_value"])).drop("_value")
            # written after each dimension: else a plan holds those of the dimensions before twice over, and the driver all of them
            work = scratch.save(work.withColumn("_free", F.col("_free") * F.col("_factor")).drop("_factor"), f"round{k}-{d}")
            last.append(f"round{k}-{d}")
            off = F.greatest(off, F.when(F.col("_free") > 0, F.col(f"_off_{d}")).otherwise(0.0))
        worst = work.agg(F.max(off)).first()[0]
        work = work.select(*cells.columns, "_free", "_bound")
        scratch.drop(*last[:-1])  # and what the driver holds of the rounds before
        del last[:-1]
        if worst is None or worst <= tolerance:
            break
    work = work.select(*cells.columns, weight.alias("weight"), F.lit(0.0).alias("unmet"))
    for d, target in present.items():
        sums = work.groupBy(F.col(d).alias("_of")).agg(F.sum("weight").alias("_sum"))
        lacks = sums.join(target, sums["_of"].eqNullSafe(target["_value"])).select("_of", F.when(F.col("_asked") > 0, 1 - F.col("_sum") / F.col("_asked")).otherwise(0.0).alias("_lacks"))
        work = work.join(lacks, work[d].eqNullSafe(lacks["_of"]), "left").drop("_of")
        work = work.withColumn("unmet", F.greatest("unmet", F.when(F.col("_lacks") > tolerance, F.round("_lacks", 6)).otherwise(0.0))).drop("_lacks")
        work = scratch.save(work, f"unmet-{d}")
    return work


def _cell(docs: DataFrame, topic: Column | None) -> list[Column]:
    """The columns that mixing needs of a row, under names of their own."""
    text = F.coalesce(F.col("text").cast("string"), F.lit(""))
    even = F.pmod(F.xxhash64(F.lit(SEED), "doc_id", text), F.lit(1 << 30)) / float(1 << 30)
    return [
        F.col("source").alias("_source"), F.col("lang").alias("_lang"), (form_topic(text) if topic is None else topic).alias("_topic"),
        F.regexp_count(text, F.lit(r"\S+")).cast("long").alias("_tokens"), even.alias("_even"),
    ]


def cell_rates(rows: DataFrame, powers: dict[str, float], budget: float, max_repeats: int, scratch: Scratch) -> DataFrame:
    """The calibrated rate of each cell of ``rows``, which has the columns of ``_cell``."""
    cells = rows.groupBy(*(F.col(f"_{d}").alias(d) for d in DIMENSIONS)).agg(F.sum("_tokens").alias("tokens"))
    cells = scratch.save(cells, "sums")
    most = max_repeats / budget if budget > 0 else float("inf")
    raked = rake(cells, {d: tempered(cells, d, powers.get(d, 1.0)) for d in DIMENSIONS}, scratch, most)
    total = cells.agg(F.sum("tokens")).first()[0] or 0
    drawn = F.col("weight") * (budget * total) / F.col("tokens")
    # the bound holds already; this only takes off what rounding of floats adds to it
    rate = F.when(F.col("tokens") > 0, F.least(drawn, F.lit(float(max_repeats)))).otherwise(0.0)
    return scratch.save(raked.select(*(F.col(d).alias(f"_of_{d}") for d in DIMENSIONS), F.round(rate, 9).alias("_rate"), F.col("unmet").alias("_unmet")), "rates")


def _drawn(rows: DataFrame, rates: DataFrame) -> DataFrame:
    same = [rows[f"_{d}"].eqNullSafe(rates[f"_of_{d}"]) for d in DIMENSIONS]
    copies = F.floor("_rate") + F.when(F.col("_even") < F.col("_rate") - F.floor("_rate"), 1).otherwise(0)
    return rows.join(rates, same[0] & same[1] & same[2]).withColumn("_copies", copies.cast("long"))


def mix(docs: DataFrame, powers: dict[str, float], budget: float = 0.5, max_repeats: int = 4, topic: Column | None = None) -> DataFrame:
    """``doc_id``, ``source``, ``lang``, ``topic``, ``tokens``, ``rate``, ``copies`` and ``unmet`` of every row of ``docs``.

    ``powers`` tempers each marginal (1 keeps the corpus's shares, 0 makes them even); ``budget`` is the share
    of the corpus's tokens to draw, and no document is drawn more than ``max_repeats`` times. ``unmet`` is the share of
    its source's, language's or topic's target that this bound puts out of reach, the greatest of the three; the
    tokens go to the other values, so the budget is drawn in full up to ``max_repeats``. ``copies`` is the
    whole part of the rate, plus one where a hash of id and text, even over [0, 1), falls below the rest. Nulls
    are values of their own; null and blank texts have no tokens and are drawn at their cell's rate, a cell
    without tokens at none. Equal rows are drawn alike. Other columns are not read.
    """
    scratch = Scratch(docs.sparkSession, "mix")
    rows = scratch.save(docs.select("doc_id", *_cell(docs, topic)), "rows")
    drawn = _drawn(rows, cell_rates(rows, powers, budget, max_repeats, scratch))
    return drawn.select("doc_id", *(F.col(f"_{c}").alias(c) for c in (*DIMENSIONS, "tokens", "rate", "copies", "unmet")))


def draw(docs: DataFrame, powers: dict[str, float], budget: float = 1.0, max_repeats: int = 4, topic: Column | None = None) -> DataFrame:
    """The rows of ``docs`` that ``mix`` draws, with all their columns, of any names, and ``copies`` and ``unmet``, which replace columns so named."""
    scratch = Scratch(docs.sparkSession, "draw")
    rows = scratch.save(docs.select(*_cell(docs, topic)), "rows")
    rates = cell_rates(rows, powers, budget, max_repeats, scratch)
    own = [c for c in docs.columns if c not in ("copies", "unmet")]
    whole = F.struct(*[F.col(f"`{c}`").alias(f"c{i}") for i, c in enumerate(own)]).alias("_whole")
    drawn = _drawn(docs.select(whole, *_cell(docs, topic)), rates).where("_copies > 0")
    return drawn.select(*(F.col("_whole")[f"c{i}"].alias(c) for i, c in enumerate(own)), F.col("_copies").alias("copies"), F.col("_unmet").alias("unmet"))

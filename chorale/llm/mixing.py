"""Mixing sources to target token counts by entropy balancing.

Every document gets a rate between 0 and ``CAP`` copies. Among all rates that meet the token targets, those that stay
closest to one copy each in (bounded) entropy have the form ``CAP / (1 + exp(-lambda * z))`` with z the document's
size in units of its source's mean: an exponential tilt. The multipliers minimise a convex dual that falls apart by
source; Newton's method finds them all at once. An iteration is one aggregate over distinct (source, size) pairs, kept
inside a shrinking bracket, with its state in a small table in the shared folder.

Rates become whole copies by one threshold per source: a document is rounded up when its hash, divided by the
fraction of its rate, stays below it. The threshold is located to a billionth by counting sizes in 1,000 bins, three
times over. What is then still owed is less than the next document. It is paid by documents that fit into it, largest
sizes first: one walk over a source's distinct sizes says how many documents of each size go in, and a threshold for
each such size says which. So no document left out would still fit. The smallest one goes in as well if that comes
nearer. Nothing is drawn at random; reruns agree.

Sums over documents are of whole numbers, so they do not depend on the order in which tasks finish.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from chorale.llm.common import materialize

WORDS = r"[^\x20\x09-\x0D]+"
#: Weights of the sources in order, repeating; the share of all tokens to take; the most copies of a document.
WEIGHTS, SHARE_PERCENT, CAP = (5, 2, 1), 150, 2
#: Newton iterations at most, the relative error that ends them, and the largest multiplier.
ROUNDS, CLOSE, STEEPEST = 40, 1e-6, 1e5
#: Rates are summed in so many parts of a token. Bins of one rounding pass, and passes.
PARTS, BINS, PASSES = 1_000, 1_000, 3
#: A rule that rounds up: spots between ``low`` and ``high``, sizes from ``least`` to ``most``.
STEP = "struct<low:bigint,high:bigint,least:bigint,most:bigint>"


def word_count(text: Column) -> Column:
    return F.coalesce(F.regexp_count(text, F.lit(WORDS)), F.lit(0)).cast("long")


def source_targets(sized: DataFrame) -> DataFrame:
    """``source``, ``source_size``, ``rows``, ``target`` from rows of ``source`` and ``size``.

    Sources count by code point, a null source last. Targets are shares by
    weight, stopped at ``CAP`` times the source's size with the excess shared
    anew: water filling, solved in one pass over the sources in order of the
    level at which each one is full. The windows see one row per source.
    """
    totals = sized.groupBy("source").agg(F.sum("size").alias("source_size"), F.count("*").alias("rows"))
    place = F.row_number().over(Window.orderBy(F.col("source").asc_nulls_last())) - 1
    weight = F.element_at(F.array(*map(F.lit, WEIGHTS)), (place % len(WEIGHTS) + 1).cast("int"))
    totals = totals.withColumn("weight", weight.cast("long"))
    full = F.col("source_size") * CAP
    order = Window.orderBy(full / F.col("weight"), F.col("source").asc_nulls_last())
    before = order.rowsBetween(Window.unboundedPreceding, -1)
    after = order.rowsBetween(0, Window.unboundedFollowing)
    everything = Window.partitionBy(F.lit(1))
    # hundredths of a token, in whole numbers: what is left to share once all earlier sources are full
    left = F.sum("source_size").over(everything) * SHARE_PERCENT - 100 * F.coalesce(F.sum(full).over(before), F.lit(0))
    totals = totals.withColumns({"left": left, "open": F.sum("weight").over(after)})
    # the first source not filled by the level at its turn sets the level for all from there on
    fits = F.col("left") * F.col("weight") <= 100 * full * F.col("open")
    first = F.min(F.when(fits, F.struct(full / F.col("weight"), F.col("source").isNull(), "source", "left", "open"))).over(everything)
    level = totals.withColumns({"fits": fits, "level": first})
    shared = (F.col("level.left") * F.col("weight")).cast("double") / (100 * F.col("level.open"))
    target = F.least(F.coalesce(shared, full.cast("double")), full.cast("double"))
    return level.select("source", "source_size", "rows", target.alias("target"))


def _rate(multiplier: Column, size: Column, mean: Column) -> Column:
    return CAP / (1 + F.exp(-F.greatest(F.least(multiplier * size / mean, F.lit(700.0)), F.lit(-700.0))))


def solve_multipliers(sized: DataFrame, targets: DataFrame) -> DataFrame:
    """``targets`` with ``mean`` size and ``multiplier`` of every source that is neither empty nor full."""
    counts = materialize(sized.groupBy("source", "size").agg(F.count("*").alias("rows")), "source-sizes")
    state = targets.where((F.col("target") > 0) & (F.col("target") < F.col("source_size") * CAP)).select(
        "*",
        (F.col("source_size") / F.col("rows")).alias("mean"),
        F.lit(0.0).alias("multiplier"),
        F.lit(-STEEPEST).alias("low"),
        F.lit(STEEPEST).alias("high"),
        F.lit(1.0).alias("error"),
    )
    state = materialize(state, "multipliers")
    size, rows = F.col("size"), F.col("c.rows")
    for _ in range(ROUNDS):
        rate = _rate(F.col("multiplier"), size, F.col("mean"))
        gain, bend = rows * size * rate, rows * size * size / F.col("mean") * rate * (CAP - rate) / CAP
        joined = counts.alias("c").join(state.alias("s"), F.col("c.source").eqNullSafe(F.col("s.source")))
        sums = joined.groupBy("s.source").agg(
            F.sum(F.round(gain * PARTS).cast("decimal(38,0)")).alias("taken"),
            F.sum(F.round(bend * PARTS).cast("decimal(38,0)")).alias("slope"),
        )
        sums = sums.select(F.col("source").alias("of"), *[(F.col(c).cast("double") / PARTS).alias(c) for c in ("taken", "slope")])
        state = state.join(sums, F.col("source").eqNullSafe(F.col("of")))
        over = F.col("taken") > F.col("target")
        low = F.when(over, F.col("low")).otherwise(F.col("multiplier"))
        high = F.when(over, F.col("multiplier")).otherwise(F.col("high"))
        newton = F.col("multiplier") - (F.col("taken") - F.col("target")) / F.greatest("slope", F.lit(1e-9))
        inside = (newton > low) & (newton < high)
        # outside the bracket: halve it, on a scale that reaches far multipliers quickly
        halved = F.sinh((F.asinh(low) + F.asinh(high)) / 2)
        error = F.abs(F.col("taken") - F.col("target")) / F.col("target")
        moved = F.when(error <= CLOSE, F.col("multiplier")).otherwise(F.when(inside, newton).otherwise(halved))
        state = state.select(
            "source", "source_size", "rows", "target", "mean", moved.alias("multiplier"), low.alias("low"), high.alias("high"), error.alias("error")
        )
        state = materialize(state, "multipliers")
        if (state.agg(F.max("error")).first()[0] or 0.0) <= CLOSE:
            break
    return state.select("source", "mean", "multiplier", "target")


def _thresholds(rated: DataFrame, owed: DataFrame) -> DataFrame:
    """Per ``key``, the ``place`` (in ``BINS ** PASSES`` parts) below which fractions are rounded up, and what is then ``due``.

    ``rated``: ``key``, ``size``, ``spot``; ``owed``: ``key`` and the tokens
    ``due``. Each pass sums the sizes by bin, finds the bin in which the debt
    is paid and goes on inside it. What shares a spot is taken whole or left.
    """
    found = owed.select("key", F.lit(0).cast("long").alias("place"), "due")
    for step in range(PASSES):
        width = BINS ** (PASSES - 1 - step)
        inner = rated.alias("r").join(found.alias("f"), F.col("r.key").eqNullSafe(F.col("f.key")))
        inner = inner.where((F.col("spot") >= F.col("place")) & (F.col("spot") < F.col("place") + width * BINS))
        bins = inner.groupBy("f.key", F.floor((F.col("spot") - F.col("place")) / width).alias("bin")).agg(F.sum("size").alias("size"))
        # one row per bin, 1,000 at most in a window
        so_far = F.sum("size").over(Window.partitionBy("key").orderBy("bin"))
        bins = bins.select(F.col("key").alias("of"), "bin", so_far.alias("through"))
        paid = found.join(bins, F.col("key").eqNullSafe(F.col("of")), "left")
        before = F.max(F.when(F.col("through") <= F.col("due"), F.col("through")))
        inside = F.min(F.when(F.col("through") > F.col("due"), F.col("bin")))
        paid = paid.groupBy("key", "place", "due").agg(before.alias("before"), inside.alias("inside"))
        rest = F.col("due") - F.coalesce("before", F.lit(0))
        found = paid.select("key", (F.col("place") + F.coalesce("inside", F.lit(BINS)) * width).alias("place"), rest.alias("due"))
        found = materialize(found, "thresholds")
    return found


def _step(low: Column, high: Column, least: Column, most: Column) -> Column:
    names = ("low", "high", "least", "most")
    return F.struct(*[c.cast("long").alias(n) for n, c in zip(names, (low, high, least, most), strict=True)])


def _rounded_up(steps: Column) -> Column:
    """Whether a row of ``size`` and ``spot`` lies in one of the steps."""
    spot, size = F.col("spot"), F.col("size")
    inside = F.exists(steps, lambda s: (spot > s["low"]) & (spot < s["high"]) & (size >= s["least"]) & (size <= s["most"]))
    return F.coalesce(inside, F.lit(False))


def _largest_first(sizes: DataFrame) -> DataFrame:
    """``source``, ``size``, ``due``: how many tokens of each size a source still takes.

    ``sizes``: ``source``, ``due``, ``size``, ``rows`` with no size above the
    debt. A source's list is as long as it has distinct sizes below the first
    document that did not fit, and so bounded by the longest text. Of the sizes taken
    there are at most ``sqrt(2 * due)``, since together they pay the debt.
    """
    descending = F.sort_array(F.collect_list(F.struct("size", "rows")), asc=False)
    listed = sizes.groupBy("source", "due").agg(descending.alias("sizes"))
    start = F.struct(F.col("due").alias("left"), F.array().cast("array<struct<size:bigint,due:bigint>>").alias("taken"))

    def take(state: Column, entry: Column) -> Column:
        paid = F.least(entry["rows"], F.floor(state["left"] / entry["size"]).cast("long")) * entry["size"]
        more = F.array_append(state["taken"], F.struct(entry["size"].alias("size"), paid.alias("due")))
        return F.struct((state["left"] - paid).alias("left"), F.when(paid > 0, more).otherwise(state["taken"]).alias("taken"))

    taken = listed.select("source", F.explode(F.aggregate("sizes", start, take)["taken"]).alias("t"))
    return taken.select("source", "t.size", "t.due")


def _round_up(open_: DataFrame, owed: DataFrame) -> DataFrame:
    """Per ``source``, the ``steps`` that round documents up: ``open_`` (``source``, ``size``, ``spot``), ``owed`` (``source``, ``due``)."""
    beyond, none = F.lit((1 << 62)), F.lit(-1)
    one = F.struct("source").alias("key")
    swept = _thresholds(open_.select(one, "size", "spot"), owed.select(one, "due"))
    swept = swept.select(F.col("key.source").alias("of"), "place", "due")
    steps = swept.select("of", _step(none, F.col("place"), F.lit(1), beyond).alias("step"))

    left = open_.join(swept, F.col("source").eqNullSafe(F.col("of")))
    fits = left.where((F.col("spot") >= F.col("place")) & (F.col("size") <= F.col("due"))).select("source", "size", "spot", "due")
    fits = materialize(fits, "fitting-sizes")
    chosen = materialize(_largest_first(fits.groupBy("source", "due", "size").agg(F.count("*").alias("rows"))), "chosen-sizes")
    both = F.struct("source", "size").alias("key")
    found = _thresholds(fits.select(both, "size", "spot"), chosen.select(both, "due"))
    found = found.select(F.col("key.source").alias("of"), F.col("key.size").alias("size"), "place", F.col("due").alias("unpaid"))
    steps = steps.unionByName(found.select("of", _step(none, F.col("place"), F.col("size"), F.col("size")).alias("step")))

    paid = chosen.groupBy("source").agg(F.sum("due").alias("meant"))
    unpaid = found.groupBy(F.col("of").alias("with")).agg(F.sum("unpaid").alias("unpaid"))
    paid = paid.join(unpaid, F.col("source").eqNullSafe(F.col("with"))).select(F.col("source").alias("payer"), (F.col("meant") - F.col("unpaid")).alias("paid"))
    swept = swept.join(paid, F.col("of").eqNullSafe(F.col("payer")), "left")
    rest = swept.select("of", (F.col("due") - F.coalesce("paid", F.lit(0))).alias("rest"))
    gathered = steps.groupBy(F.col("of").alias("payer")).agg(F.collect_list("step").alias("steps"))
    rest = materialize(rest.join(gathered, F.col("of").eqNullSafe(F.col("payer"))).select("of", "rest", "steps"), "steps")

    # a group of equal rows beyond the debt, but nearer to it than nothing
    near = open_.join(rest, F.col("source").eqNullSafe(F.col("of"))).where(F.col("size") < 2 * F.col("rest"))
    near = near.where(~_rounded_up(F.col("steps"))).groupBy("source", "rest", "size", "spot").agg(F.sum("size").alias("weight"))
    near = near.where(F.col("weight") < 2 * F.col("rest")).groupBy("source").agg(F.min(F.struct("weight", "spot", "size")).alias("m"))
    last = _step(F.col("m.spot") - 1, F.col("m.spot") + 1, F.col("m.size"), F.col("m.size"))
    near = near.select(F.col("source").alias("payer"), F.array(last).alias("last"))
    steps = F.concat("steps", F.coalesce("last", F.array().cast(f"array<{STEP}>")))
    return rest.join(near, F.col("of").eqNullSafe(F.col("payer")), "left").select(F.col("of").alias("source"), steps.alias("steps"))


#: Sources whose state is broadcast; more are joined by a shuffle.
BROADCAST_SOURCES = 100_000


def mix_sources(documents: DataFrame, *, doc_id: str = "doc_id", text: str = "text", source: str = "source", out: str = "mix") -> DataFrame:
    """``documents`` with a struct added: ``size``, ``source_size``, ``target``, ``rate``, ``copies``.

    Sizes are words. Null texts have size 0; empty documents keep one copy, which takes nothing. A full source takes
    ``CAP`` copies of each document, a source without words has target 0. Repeated rows get equal copies; where they
    would overshoot together, all of them are left out. An empty table gives an empty result. A column named ``out`` is replaced. The texts are not shuffled.
    """
    size, drawn = word_count(F.col(text)), F.xxhash64(doc_id, text)
    drawn = (F.pmod(drawn, F.lit(1 << 40)) + 1) / float(1 << 40)
    sized = documents.select(F.col(source).cast("string").alias("source"), size.alias("size"), drawn.alias("drawn"))
    sized = materialize(sized, "sizes")
    targets = materialize(source_targets(sized), "targets")
    solved = solve_multipliers(sized, targets)

    solved = solved.select(F.col("source").alias("of"), "mean", "multiplier", "target")
    rate = _rate(F.col("multiplier"), F.col("size"), F.col("mean"))
    fraction = F.col("rate") - F.floor("rate")
    spot = F.floor(F.col("drawn") / (F.col("drawn") + fraction) * float(BINS**PASSES))
    spot = F.when(fraction > 0, F.least(spot, F.lit(BINS**PASSES - 1)))
    rated = sized.where("size > 0").join(solved, F.col("source").eqNullSafe(F.col("of"))).withColumn("rate", rate)
    rated = rated.select("source", "size", "target", F.floor("rate").alias("whole"), spot.alias("spot"))
    debt = rated.groupBy("source", "target").agg(F.sum(F.col("size") * F.col("whole")).alias("sure"))
    owed = debt.select("source", F.floor(F.col("target") - F.col("sure")).cast("long").alias("due"))
    steps = _round_up(rated.where("spot IS NOT NULL").select("source", "size", "spot"), materialize(owed, "debts"))
    steps = steps.withColumnRenamed("source", "payer")

    state = targets.join(solved.drop("target"), F.col("source").eqNullSafe(F.col("of")), "left").drop("of", "rows")
    state = state.join(steps, F.col("source").eqNullSafe(F.col("payer")), "left").drop("payer")
    state = materialize(state.withColumnRenamed("source", "of"), "mixing-state")
    full = F.col("mean").isNull() & (F.col("target") > 0)
    rate = F.when(F.col("size") == 0, F.lit(1.0)).when(full, F.lit(float(CAP))).otherwise(F.coalesce(rate, F.lit(0.0)))
    up = F.when((F.col("size") > 0) & _rounded_up(F.col("steps")), F.lit(1)).otherwise(F.lit(0))
    copies = F.least(F.floor("rate").cast("int") + up, F.lit(CAP))

    # names of the state could clash with the caller's columns, so these travel in one struct
    kept = F.struct(*[F.col(f"`{c}`") for c in documents.columns if c.lower() != out.lower()]).alias("kept")
    rows = documents.select(kept, F.col(source).cast("string").alias("source"), size.alias("size"), drawn.alias("drawn"))
    if state.count() <= BROADCAST_SOURCES:
        state = F.broadcast(state)
    mixed = rows.join(state, F.col("source").eqNullSafe(F.col("of"))).withColumn("rate", rate)
    mixed = mixed.withColumn("spot", F.when(F.col("steps").isNotNull(), spot)).withColumn("copies", copies)
    return mixed.select("kept.*", F.struct("size", "source_size", "target", "rate", "copies").alias(out))

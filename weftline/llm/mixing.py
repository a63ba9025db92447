"""Mixing sources to target weights by entropy balancing.

Rates r of the documents minimise the relative entropy, over tokens, to the
corpus as it is (sum of size * (r log r - r + 1)) with r at most ``most``, subject
to a token constraint per source (the rates of its documents, times their sizes,
sum to its target) and one that all sources share: the token-weighted mean of the
logarithmic document length stays that of the corpus, so that taking more of a
source of short documents does not shorten the mix. The convex dual has a
multiplier per source and one for the shared constraint, and its optimum tilts
documents exponentially: r = min(most, exp(source's multiplier + shared
multiplier * length)). A small ridge on the shared multiplier keeps it finite
where no rates can meet that constraint; the sources' own are met exactly.

Length enters by size class (eight for each doubling), so the sums over documents
that Newton needs are those over (source, class): they are pre-aggregated once.
The Hessian is an arrow (sources meet only in the shared row), so an iteration
solves each source's own multiplier from its row, sums gradient and Schur complement
of the shared one over all sources in a distributed aggregate, and takes Newton
steps on that inside a bracket, until the gradient vanishes; else it is an error.
Sums are decimal, so that reruns agree.

Rates become copies: every document gets floor(r) copies, and a share of each
class gets one more: the classes of a source, from large to small, each take up
what larger ones over- or undershot; inside a class by hash of the row, in
sub-blocks of bounded size, so that a source with a third of all rows is never in
one task. Running sums go by range in two levels, never over all rows in one task.

Defined results: a null text has size 0 and takes 0 words; the null source is a
source, the last; a source of size 0 has target 0; an empty table gives an empty
result; repeated rows are documents of their own (which of several equal rows
gets the extra copy is arbitrary, the rows that result are not)."""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import fresh, materialize, row_mark

#: White space separates words: U+0020 and U+0009 to U+000D.
WORD = r"[^\x20\x09-\x0D]+"
#: Rounds of Newton steps before the dual counts as failed; each at least halves the bracket, a handful are taken.
STEPS = 60
#: Ridge on the shared multiplier, per token.
RIDGE = 0.01
#: Rows of a sub-block, about; sub-blocks of a block of running sums.
BLOCK = 256
BLOCKS = 1024


def word_count(text: Column) -> Column:
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")


def take_copies(docs: DataFrame, mixed: DataFrame, id_col: str = "doc_id") -> DataFrame:
    """docs with every row as often as the mix of these docs takes it (rows that
    are equal in all columns are one row with the copies of all)."""
    mark, key, total, one, copy = (fresh(docs, n) for n in ("__mark", "__key", "__copies", "__one", "__copy"))
    named = lambda c: F.coalesce(c.cast("string"), F.lit("null"))
    taken = mixed.groupBy(F.col("mark").alias(mark), named(F.col(f"`{id_col}`")).alias(key)).agg(F.sum("copies").alias(total)).where(F.col(total) > 0)
    rows = docs.withColumns({mark: row_mark(docs), key: named(F.col(f"`{id_col}`"))}).join(taken, [mark, key])
    rows = rows.withColumn(one, F.row_number().over(Window.partitionBy(mark, key).orderBy(key))).where(F.col(one) == 1)
    rows = rows.withColumn(copy, F.explode(F.sequence(F.lit(1).cast("long"), F.col(total))))
    return rows.select(*[F.col(f"`{c}`") for c in docs.columns])


def sums_before(rows: DataFrame, order: list[Column], sums: dict[str, Column]) -> DataFrame:
    """rows with the sums over all rows before, in two levels: rows are dealt out
    by range, and only the ranges' totals are summed up in one place."""
    dealt = materialize(rows.repartitionByRange(*order).withColumn("__part", F.spark_partition_id()))
    totals = dealt.groupBy("__part").agg(*[F.sum(v).alias(f"__{n}") for n, v in sums.items()])
    ahead = Window.orderBy("__part").rowsBetween(Window.unboundedPreceding, -1)  # a row for each range
    totals = totals.select("__part", *[F.coalesce(F.sum(f"__{n}").over(ahead), F.lit(0)).alias(f"__{n}") for n in sums])
    own = Window.partitionBy("__part").orderBy(*order).rowsBetween(Window.unboundedPreceding, -1)
    inside = dealt.select("*", *[F.coalesce(F.sum(v).over(own), F.lit(0)).alias(n) for n, v in sums.items()])
    both = inside.join(totals, "__part")
    return both.select(*rows.columns, *[(F.col(n) + F.col(f"__{n}")).alias(n) for n in sums])


def source_targets(sizes: DataFrame, source: str = "source", weights: tuple[float, ...] = (1.0, 2.0, 3.0), most: float = 3.0) -> DataFrame:
    """(source, source_size, target, stops) from rows (source, size).

    Sources in code point order, null last, weigh ``weights`` in turn and share
    the total; a target stops at ``most`` times its source's size and the excess
    is shared by weight among the rest until none is above: with sources by
    their limit per weight, those below the common level stop and the level is
    what remains over the weight that remains."""
    totals = materialize(sizes.groupBy(F.col(source).alias("source")).agg(F.sum("size").alias("source_size")))
    ranked = sums_before(totals, [F.col("source").asc_nulls_last()], {"ahead": F.lit(1)})
    ranked = ranked.withColumn("weight", F.element_at(F.array(*[F.lit(float(w)) for w in weights]), (F.col("ahead") % len(weights) + 1).cast("int"))).drop("ahead")
    size, weight = ranked.agg(F.sum("source_size"), F.sum("weight")).first()
    limit = F.col("source_size") / F.col("weight")
    order = [limit.asc(), F.col("source").asc_nulls_last()]
    levelled = sums_before(ranked, order, {"used": F.lit(most) * F.col("source_size"), "gone": F.col("weight")})
    levelled = levelled.withColumn("level", (F.lit(float(size or 0)) - F.col("used")) / (F.lit(float(weight or 0)) - F.col("gone")))
    levelled = levelled.withColumn("stops", F.lit(most) * F.col("source_size") <= F.col("level") * F.col("weight"))
    # the level that holds is that of the first source that doesn't stop
    common = levelled.where("not stops").agg(F.min_by("level", limit)).first()[0]
    target = F.when(F.col("stops"), F.lit(most) * F.col("source_size")).otherwise(F.lit(common).cast("double") * F.col("weight"))
    return levelled.select("source", "source_size", target.cast("double").alias("target"), "stops")


def _tilted(c: Column, lam: Column, mu: float, most: float) -> Column:
    return F.least(F.exp(lam + F.lit(mu) * c["g"]), F.lit(most))


def _words(of) -> Column:
    """The sum over a source's classes of words times of(class)."""
    return F.aggregate("classes", F.lit(0.0), lambda s, c: s + c["words"] * of(c))


def _multiplier(mu: float, most: float) -> Column:
    """A source's multiplier, given the shared one: bisection between the values
    at which all rates are at most the mean and at which all reach ``most``, then
    Newton steps. Null for a source that stops or has no words."""
    taken = lambda lam: _words(lambda c: _tilted(c, lam, mu, most))
    slope = lambda lam: _words(lambda c: F.when(F.exp(lam + F.lit(mu) * c["g"]) < most, F.exp(lam + F.lit(mu) * c["g"])).otherwise(0.0))
    tilts = F.transform("classes", lambda c: F.lit(mu) * c["g"])
    low, high = F.log(F.col("target") / F.col("source_size")) - F.array_max(tilts), F.lit(math.log(most)) - F.array_min(tilts)

    def halve(held, _):
        half = (held["low"] + held["high"]) / 2
        under = taken(half) < F.col("target")
        return F.struct(F.when(under, half).otherwise(held["low"]).alias("low"), F.when(under, held["high"]).otherwise(half).alias("high"))

    found = F.aggregate(F.sequence(F.lit(1), F.lit(40)), F.struct(low.alias("low"), high.alias("high")), halve, lambda held: held["low"])
    newton = lambda lam, _: lam + F.coalesce(F.try_divide(F.col("target") - taken(lam), slope(lam)), F.lit(0.0))
    return F.when(~F.col("stops") & (F.col("source_size") > 0), F.aggregate(F.sequence(F.lit(1), F.lit(4)), found, newton))


def _exactly(x: Column) -> Column:
    """A sum that doesn't depend on the order of rows."""
    return F.sum(x.cast("decimal(38,9)")).cast("double")


def _taken(words: np.ndarray, g: np.ndarray, at: np.ndarray, target: np.ndarray, size: np.ndarray, stops: np.ndarray, mu: float, most: float) -> np.ndarray:
    """For each of the sources whose classes (words, g) begin at ``at``, given the
    shared multiplier: the sum over words of rate * g, and its slope."""
    n = np.diff(np.append(at, len(words)))
    own, sums = np.repeat(np.arange(len(at)), n), lambda x: np.add.reduceat(x, at)
    tilt = mu * g
    with np.errstate(over="ignore", divide="ignore"):
        low = np.log(target / size) - np.maximum.reduceat(tilt, at)
        high = math.log(most) - np.minimum.reduceat(tilt, at)
        for _ in range(60):  # to the last bit, by halves
            half = (low + high) / 2
            under = sums(words * np.minimum(np.exp(half[own] + tilt), most)) < target
            low, high = np.where(under, half, low), np.where(under, high, half)
        free = np.exp(low[own] + tilt)
    rate = np.where(stops[own], most, np.minimum(free, most))
    free = words * np.where(stops[own] | (free >= most), 0.0, free)
    a, b, d = sums(free), sums(free * g), sums(free * g * g)
    return np.stack([sums(words * rate * g), np.maximum(d - b * b / np.where(a > 0, a, 1.0), 0.0)])


def _slopes(listed: DataFrame, mus: list[float], most: float, size: float) -> list[tuple[float, float]]:
    """The dual's gradient and its slope at each of these shared multipliers."""

    def sums(batches):
        for batch in batches:
            classes = batch.column("classes")
            flat = classes.flatten()
            words, g = (np.asarray(flat.field(c)).astype(np.float64) for c in ("words", "g"))
            at = np.asarray(classes.offsets)[:-1] - np.asarray(classes.offsets)[0]
            own = [np.asarray(batch.column(c).cast(pa.float64())) for c in ("target", "source_size", "stops")]
            found = [_taken(words, g, at, own[0], own[1], own[2] > 0, mu, most) for mu in mus]
            yield pa.RecordBatch.from_arrays([pa.array(np.concatenate([x[k] for x in found])) for k in (0, 1)] + [pa.array(np.repeat(np.arange(len(mus)), batch.num_rows))], names=["shared", "bend", "k"])

    rows = listed.where("source_size > 0").select("classes", "target", "source_size", F.col("stops").cast("int").alias("stops"))
    found = rows.mapInArrow(sums, "shared double, bend double, k long").groupBy("k").agg(_exactly(F.col("shared")).alias("shared"), _exactly(F.col("bend")).alias("bend"))
    got = {r["k"]: (r["shared"], r["bend"]) for r in found.collect()}
    return [(got[k][0] + RIDGE * size * mu, got[k][1] + RIDGE * size) for k, mu in enumerate(mus)]


def balanced(listed: DataFrame, most: float) -> tuple[DataFrame, float]:
    """Rows (source, source_size, target, stops, classes of (class, n, words, g))
    with the source's multiplier ``lam`` (null: at ``most``, or no words), and
    the shared multiplier.

    The gradient rises with the shared multiplier, and the ridge alone outweighs
    all words where that is ``most`` times the largest length over the ridge. Each
    job looks at several multipliers at once: first a coarse row of them, then
    Newton steps from both ends of the bracket, the secant and the middle, which
    halves it at least. An optimum that isn't reached is an error."""
    top = listed.agg(F.sum("source_size"), F.max(F.array_max(F.transform("classes", lambda c: F.abs(c["g"]))))).first()
    size, reach = float(top[0] or 0), float(top[1] or 0)
    if not size or not reach:
        return listed.withColumn("lam", _multiplier(0.0, most)), 0.0
    end = 1.0 + most * reach / RIDGE
    mus = [0.0, *(x for m in (0.03, 0.3, 1.0, 3.0, 10.0, 30.0, 100.0) if m < end for x in (m, -m)), end, -end]
    low, high, best = (-math.inf, 0.0, 0.0), (math.inf, 0.0, 0.0), None
    for _ in range(STEPS):
        found = [(mu, *x) for mu, x in zip(mus, _slopes(listed, mus, most, size), strict=True)]
        best = min([*found, best] if best else found, key=lambda x: abs(x[1]))
        low = max([low, *(x for x in found if x[1] <= 0)], key=lambda x: x[0])
        high = min([high, *(x for x in found if x[1] >= 0)], key=lambda x: x[0])
        if abs(best[1]) <= 1e-10 * size or high[0] - low[0] <= 1e-12 * max(1.0, abs(best[0])):
            break
        gap = high[0] - low[0]
        new = [low[0] - low[1] / low[2], high[0] - high[1] / high[2], low[0] - low[1] * gap / (high[1] - low[1])]
        new += [x + k * abs(x - best[0]) * 1e-3 for x in new[:2] for k in (-1, 1)]  # so that a bracket closes from both sides
        mus = sorted({x for x in new if low[0] < x < high[0]} | {(low[0] + high[0]) / 2})
    if abs(best[1]) > 1e-7 * size:
        raise RuntimeError(f"the mix found no optimum: gradient {best[1] / size:.3g} a word at multiplier {best[0]:.6g}")
    return listed.withColumn("lam", _multiplier(best[0], most)), best[0]


def mix_sources(docs: DataFrame, id_col: str = "doc_id", text: str = "text", source: str = "source", weights: tuple[float, ...] = (1.0, 2.0, 3.0), most: int = 3) -> DataFrame:
    """(id_col, source, size, source_size, target, rate, mark, copies, taken)
    for every row; mark is row_mark()."""
    sizes = docs.select(F.col(f"`{id_col}`").alias("__id"), F.col(f"`{source}`").alias("source"), word_count(F.col(f"`{text}`")).alias("size"), row_mark(docs).alias("mark"))
    sizes = materialize(sizes.withColumn("class", F.floor(8 * F.log2(F.col("size") + 1)).cast("int")))
    targets = source_targets(sizes, "source", weights, most)
    classes = materialize(sizes.groupBy("source", "class").agg(F.count("*").alias("n"), F.sum("size").alias("words")).withColumn("g", F.log2(F.col("words") / F.col("n") + 1)))
    tokens, once, twice = (float(x or 0) for x in classes.agg(F.sum("words"), _exactly(F.col("words") * F.col("g")), _exactly(F.col("words") * F.col("g") * F.col("g"))).first())
    mean = once / tokens if tokens else 0.0
    spread = math.sqrt(max(0.0, twice / tokens - mean * mean)) if tokens else 0.0
    length = (F.col("g") - mean) / spread if spread > 1e-6 else F.lit(0.0)
    # classes of a source are few: 8 for each doubling of the size
    listed = classes.groupBy("source").agg(F.reverse(F.array_sort(F.collect_list(F.struct("class", "n", "words", length.alias("g"))))).alias("classes"))
    same = F.col("l.source").eqNullSafe(F.col("r.source"))
    listed = materialize(listed.alias("l").join(targets.alias("r"), same).select("r.source", "r.source_size", "r.target", "r.stops", "l.classes"))
    state, mu = balanced(listed, float(most))
    rate = lambda c: F.when(F.col("source_size") == 0, F.lit(0.0)).when(F.col("stops"), F.lit(float(most))).otherwise(F.least(F.exp(F.col("lam") + F.lit(mu) * c["g"]), F.lit(float(most))))
    # a rate within rounding of a whole number is that number
    whole = lambda c: F.floor(rate(c) + 1e-9).cast("bigint")
    rated = lambda c: F.struct(c["class"].alias("class"), c["n"].alias("n"), c["words"].alias("words"), rate(c).alias("rate"), whole(c).alias("base"), F.greatest(rate(c) - whole(c), F.lit(0.0)).alias("more"))
    state = materialize(state.withColumn("classes", F.transform("classes", rated)).drop("lam"))
    # extra copies by class, large to small; the running state carries the words still owed
    begin = F.struct(F.lit(0.0).alias("owed"), F.expr("cast(array() as array<struct<class:int,n:bigint,extra:bigint,rate:double,base:bigint>>)").alias("done"))

    def give(held, c):
        each = F.greatest(c["words"] / c["n"], F.lit(1e-9))
        owed = held["owed"] + c["more"] * c["words"]
        extra = F.greatest(F.lit(0), F.least(F.when(c["base"] < most, c["n"]).otherwise(0), F.round(owed / each).cast("long"))).cast("bigint")
        extra = F.when(c["words"] == 0, F.lit(0).cast("bigint")).otherwise(extra)
        return F.struct((owed - extra * each).alias("owed"), F.concat(held["done"], F.array(F.struct(c["class"].alias("class"), c["n"].alias("n"), extra.alias("extra"), c["rate"].alias("rate"), c["base"].alias("base")))).alias("done"))

    plan = state.withColumn("plan", F.aggregate("classes", begin, give)["done"])
    plan = materialize(plan.select("source", "source_size", "target", F.explode("plan").alias("p")).select("source", "source_size", "target", "p.*"))
    # sub-blocks: the hash deals a class out; each takes its part of the extra copies
    dealt = sizes.alias("l").join(plan.alias("r"), same & (F.col("l.class") == F.col("r.class"))).select("l.__id", "l.source", "l.size", "l.mark", "l.class", "r.source_size", "r.target", "r.rate", "r.base", "r.n", "r.extra")
    dealt = materialize(dealt.withColumn("block", F.pmod(F.col("mark"), F.ceil(F.col("n") / BLOCK))))
    blocks = dealt.groupBy("source", "class", "block").agg(F.count("*").alias("rows"), F.first("n").alias("n"), F.first("extra").alias("extra"))
    blocks = materialize(blocks.withColumn("over", F.floor(F.col("block") / BLOCKS)))
    overs = blocks.groupBy("source", "class", "over").agg(F.sum("rows").alias("all"))
    overs = overs.select("source", "class", "over", (F.sum("all").over(Window.partitionBy("source", "class").orderBy("over")) - F.col("all")).alias("ahead"))
    inside = F.sum("rows").over(Window.partitionBy("source", "class", "over").orderBy("block"))
    share = lambda rows: F.floor(F.col("extra") * rows / F.col("n"))
    counted = blocks.withColumn("inside", inside).alias("l").join(overs.alias("r"), same & (F.col("l.class") == F.col("r.class")) & (F.col("l.over") == F.col("r.over")))
    counted = counted.select("l.source", "l.class", "l.block", "l.rows", "l.n", "l.extra", (F.col("l.inside") + F.col("r.ahead")).alias("so_far"))
    blocks = materialize(counted.select("source", "class", "block", (share(F.col("so_far")) - share(F.col("so_far") - F.col("rows"))).alias("part")))
    order = Window.partitionBy("l.source", "l.class", "l.block").orderBy("l.mark", "l.__id")
    both = dealt.alias("l").join(blocks.alias("r"), same & (F.col("l.class") == F.col("r.class")) & (F.col("l.block") == F.col("r.block")))
    copies = F.col("l.base") + (F.row_number().over(order) <= F.col("r.part")).cast("long")
    out = both.select("l.__id", "l.source", "l.size", "l.source_size", "l.target", "l.rate", "l.mark", F.least(copies, F.lit(most).cast("long")).alias("copies"))
    return out.select(F.col("__id").alias(id_col), F.col("source").alias(source), "size", "source_size", "target", "rate", "mark", "copies", (F.col("copies") * F.col("size")).alias("taken"))

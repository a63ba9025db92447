"""SpotSigs fingerprints: chains of content words behind common-word anchors.

A spot is a common word (the anchor) that a content word follows; its signature
is 8 hex digits of the MD5 of the anchor and the next three content words. A
document's fingerprint is the sorted set of its signatures, joined; a text without
a spot takes the chains of all its words instead, one without a word has the
empty fingerprint. Likeness is the Jaccard similarity of two sets.

Only DataFrame functions are used: words are split, classified and chained by
higher-order functions over arrays inside a row, without a shuffle.

Near-duplicate links partition the sets by length, in steps of the threshold, so
that sets whose lengths alone rule a link out never meet; within a partition
candidates share one of their rarest signatures (as many as a link could miss,
and one more), and pairs are pruned by length again before they are compared.

Defined results: a null text is an empty one; two empty fingerprints have
likeness 1, an empty and another 0; equal texts have equal fingerprints; rows
with a null id come last in descending order; of rows that share an id the
hash of the text decides; the successor of a table's only row is itself.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import bound, materialize

#: Common words of English, German, French and Spanish.
ANCHORS = (
    "a an and are as at be but by for from had has have he her his i in is it its not of on or she that the their they this to was were which will with you "
    "als am auch auf aus bei das dem den der des die ein eine einem einen einer er es für hat ich im in ist mit nach nicht sich sie sind so und von war wie wird zu zum zur "
    "au aux avec ce cette dans de des du elle en est et il ils la le les leur ne nous on ou par pas plus pour qu que qui sa se son sont sur un une "
    "al con como de del el ella en es esta este la las lo los más no o para pero por que se sin su sus un una y"
).split()
CHAIN = 3


def spot_set(text: Column, anchors: list[str] | None = None, chain: int = CHAIN) -> Column:
    """The sorted set of a text's signatures, array<string>."""
    return spot_set_of_words(spot_words(text), anchors, chain)


def spot_words(text: Column) -> Column:
    """Lower-case words: runs of letters, marks and digits. What is common comes first in
    the class, which is tried part by part."""
    return F.filter(F.split(F.lower(F.coalesce(text, F.lit(""))), r"[^a-z\p{L}\p{M}\p{N}]+"), lambda w: w != "")


def spot_set_of_words(words: Column, anchors: list[str] | None = None, chain: int = CHAIN) -> Column:
    common = sorted(set(ANCHORS if anchors is None else anchors))
    signature = lambda *parts: F.substring(F.md5(F.concat_ws(" ", *parts)), 1, 8)
    ordered = lambda hashes: F.array_sort(F.array_distinct(hashes))

    def content(w: Column) -> Column:
        """Content words, each with the word before it if that is an anchor."""
        pairs = F.transform(w, lambda x, i: F.struct(x.alias("w"), F.get(w, i - 1).alias("a")))
        return F.transform(F.filter(pairs, lambda s: ~s["w"].isin(common)), lambda s: F.struct(s["w"].alias("w"), F.when(s["a"].isin(common), s["a"]).alias("a")))

    def spots(c: Column) -> Column:
        ahead = lambda i: [F.get(c, i + k)["w"] for k in range(1, chain)]
        chains = F.transform(c, lambda s, i: F.when(s["a"].isNotNull(), signature(s["a"], s["w"], *ahead(i))))
        return F.filter(chains, lambda h: h.isNotNull())

    def signatures(w: Column) -> Column:
        plain = F.transform(w, lambda x, i: signature(x, *[F.get(w, i + k) for k in range(1, chain)]))
        return bound(bound(content(w), spots), lambda found: F.when(F.size(found) > 0, ordered(found)).otherwise(ordered(plain)))

    return bound(words, signatures)


def spot_text(signatures: Column) -> Column:
    """A fingerprint as a string."""
    return F.array_join(signatures, "")


def spot_jaccard(a: Column, b: Column, least: float = 0.0) -> Column:
    """Jaccard similarity of two sets; 0 without a comparison where their
    lengths alone keep it under ``least``."""
    small, large = F.least(F.size(a), F.size(b)), F.greatest(F.size(a), F.size(b))
    both = F.size(F.array_intersect(a, b))
    value = F.when(large == 0, F.lit(1.0)).otherwise(both / (F.size(a) + F.size(b) - both))
    return value if least <= 0 else F.when(small < F.lit(least) * large, F.lit(0.0)).otherwise(value)


def with_next(docs: DataFrame, id_col: str = "doc_id", text: str = "text", buckets: int | None = None) -> DataFrame:
    """(__id, text, spots, next_text, next_spots): every row with the row of the
    next smaller id; the row of the largest id follows the last.

    Rows are dealt to buckets of neighbouring ids at quantiles of the id, and
    each bucket is ordered on its own; only the first row of each bucket meets
    the bucket before it."""
    spark = docs.sparkSession
    rows = docs.select(F.col(id_col).cast("long").alias("__id"), F.coalesce(F.col(text), F.lit("")).alias("text"))
    if buckets is None:
        buckets = min(4096, 4 * int(spark.conf.get("spark.sql.shuffle.partitions")))
    cuts = sorted(set(rows.stat.approxQuantile("__id", [i / buckets for i in range(1, buckets)], 0.1 / buckets) or []))
    bounds = F.array(*[F.lit(int(x)) for x in cuts]).cast("array<bigint>")
    bucket = F.when(F.col("__id").isNull(), -1).otherwise(F.size(F.filter(bounds, lambda x: x <= F.col("__id"))))
    rows = rows.withColumns({"bucket": bucket, "mark": F.xxhash64("text")})
    down = [F.col("__id").desc_nulls_last(), F.col("mark").desc()]
    # the first row of each bucket, and the bucket that it follows: as many rows as there are buckets
    heads = rows.groupBy("bucket").agg(F.max(F.struct(F.coalesce("__id", F.lit(-(2**63))).alias("id"), "mark")).alias("head"))
    heads = heads.withColumn("for", F.coalesce(F.lag("bucket").over(Window.orderBy(F.col("bucket").desc())), F.min("bucket").over(Window.partitionBy())))
    heads = heads.select(F.col("bucket").alias("hb"), "for", F.col("head.id").alias("hid"), F.col("head.mark").alias("hmark"))
    found = rows.join(F.broadcast(heads), (F.col("bucket") == F.col("hb")) & (F.coalesce("__id", F.lit(-(2**63))) == F.col("hid")) & (F.col("mark") == F.col("hmark")))
    found = found.groupBy(F.col("for").alias("bucket")).agg(F.first("text").alias("head_text"))
    found = materialize(found.withColumn("head_spots", spot_set(F.col("head_text"))))
    dealt = rows.repartition("bucket").withColumn("spots", spot_set(F.col("text")))
    order = Window.partitionBy("bucket").orderBy(*down)
    dealt = dealt.withColumns({"next_text": F.lead("text").over(order), "next_spots": F.lead("spots").over(order)})
    joined = dealt.join(found, "bucket", "left")
    return joined.select("__id", "text", "spots", F.coalesce("next_text", "head_text").alias("next_text"), F.coalesce("next_spots", "head_spots").alias("next_spots"))


def fingerprints_with_edits(docs: DataFrame, id_col: str = "doc_id", text: str = "text") -> DataFrame:
    """Every document's fingerprint beside that of its edited text: the last
    floor(n/2) code points replaced by the first as many of the next document."""
    rows = with_next(docs, id_col, text).withColumn("n_chars", F.length("text").cast("long"))
    half = F.floor(F.col("n_chars") / 2).cast("int")
    edited = F.concat(F.substring("text", F.lit(1), (F.col("n_chars") - half).cast("int")), F.substring("next_text", F.lit(1), half))
    rows = rows.select("__id", "n_chars", "spots", "next_spots", edited.alias("edited"))
    rows = rows.withColumn("edited_spots", spot_set(F.col("edited")))
    return rows.select(
        F.col("__id").alias(id_col),
        "n_chars",
        F.sha2("edited", 256).alias("edited_sha256"),
        spot_text(F.col("spots")).alias("fingerprint"),
        spot_text(F.col("edited_spots")).alias("edited_fingerprint"),
        spot_jaccard(F.col("spots"), F.col("edited_spots")).alias("near_edited"),
        spot_jaccard(F.col("spots"), F.col("next_spots")).alias("near_next"),
    )


def spot_links(docs: DataFrame, least: float = 0.8, id_col: str = "doc_id", text: str = "text") -> tuple[DataFrame, DataFrame]:
    """Near-duplicate links: (a, b, likeness) between representatives of equal
    fingerprints, and (id_col, class) for every row. Empty fingerprints form a
    class and link to nothing."""
    rows = materialize(docs.select(F.col(id_col).alias("__id"), spot_set(F.col(text)).alias("spots")).withColumn("print", F.sha2(spot_text(F.col("spots")), 256)))
    classes = materialize(rows.groupBy("print").agg(F.min("__id").alias("class"), F.first("spots").alias("spots")))
    member = rows.join(classes.select("print", "class"), "print").select(F.col("__id").alias(id_col), "class")
    sets = classes.where("class is not null and size(spots) > 0").select("class", "spots", F.size("spots").alias("n"))
    spots = sets.select("class", "n", F.explode("spots").alias("spot"))
    counts = spots.groupBy("spot").agg(F.count("*").alias("times"))
    # a link misses at most n - ceil(least * n) signatures: among the rarest so many and one, one is shared
    rare = Window.partitionBy("class").orderBy("times", "spot")
    prefix = spots.join(counts, "spot").withColumn("r", F.row_number().over(rare)).where(F.col("r") <= F.col("n") - F.ceil(F.col("n") * F.lit(least) - 1e-9) + 1)
    step = F.floor(F.log(F.col("n").cast("double")) / F.log(F.lit(1 / least)) + 1e-9)
    prefix = materialize(prefix.select("class", "n", "spot", step.alias("part")))
    right = prefix.withColumn("part", F.explode(F.array(F.col("part"), F.col("part") - 1)))
    pairs = prefix.alias("l").join(right.alias("r"), ["spot", "part"]).where("(l.n < r.n or (l.n = r.n and l.class < r.class)) and l.class <> r.class")
    pairs = pairs.where(F.col("l.n") >= F.lit(least) * F.col("r.n") - 1e-9).select(F.col("l.class").alias("a"), F.col("r.class").alias("b")).distinct()
    a, b = sets.select(F.col("class").alias("a"), F.col("spots").alias("sa")), sets.select(F.col("class").alias("b"), F.col("spots").alias("sb"))
    links = pairs.join(a, "a").join(b, "b").withColumn("likeness", spot_jaccard(F.col("sa"), F.col("sb"), least)).where(F.col("likeness") >= least - 1e-12)
    return links.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b"), "likeness"), member

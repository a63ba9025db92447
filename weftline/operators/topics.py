"""Topics over titles and comment bodies: terms of one and two words, LDA."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.text import words


def topic_texts(posts: DataFrame) -> DataFrame:
    """Titles and comment bodies that aren't blank, one a row."""
    titles = posts.select(F.col("title").alias("text"))
    bodies = posts.select(F.explode("comments").alias("c")).select(F.col("c.body").alias("text"))
    return titles.unionByName(bodies).where("text is not null and text <> ''")


def topic_terms(texts: DataFrame, k: int = 10, top: int = 10, vocabulary: int = 20_000, min_docs: int = 5, seed: int = 42, text: str = "text"):
    """(sizes, terms): (topic, size) of the dominant topics, largest first, and
    (topic, rank, term, weight)."""
    from pyspark.ml import Pipeline
    from pyspark.ml.clustering import LDA
    from pyspark.ml.feature import CountVectorizer, NGram

    both = texts.select(F.transform(words(F.lower(text)), lambda w: F.regexp_replace(w, r"[^\p{L}\p{N}]", "")).alias("all")).select(F.filter("all", lambda w: w != "").alias("one"))
    rows = NGram(n=2, inputCol="one", outputCol="two").transform(both).select(F.concat("one", "two").alias("terms")).persist()
    counter = CountVectorizer(inputCol="terms", outputCol="features", vocabSize=vocabulary, minDF=min_docs)
    lda = LDA(k=k, maxIter=10, seed=seed, optimizer="online")
    model = Pipeline(stages=[counter, lda]).fit(rows)
    vocab = model.stages[0].vocabulary
    from pyspark.ml.functions import vector_to_array

    spread = model.transform(rows).select(vector_to_array("topicDistribution").alias("d"))
    sizes = spread.select((F.array_position("d", F.array_max("d")) - 1).cast("int").alias("topic")).groupBy("topic").agg(F.count("*").alias("size")).orderBy(F.desc("size"), "topic")
    names = F.array(*[F.lit(v) for v in vocab]) if len(vocab) <= 5000 else None
    terms = model.stages[1].describeTopics(top).select("topic", F.posexplode(F.arrays_zip("termIndices", "termWeights")).alias("rank", "t"))
    if names is not None:
        terms = terms.select("topic", "rank", F.get(names, F.col("t.termIndices")).alias("term"), F.col("t.termWeights").alias("weight"))
    else:
        listed = texts.sparkSession.createDataFrame(list(enumerate(vocab)), "i int, term string")
        terms = terms.join(F.broadcast(listed), F.col("t.termIndices") == F.col("i")).select("topic", "rank", "term", F.col("t.termWeights").alias("weight"))
    return sizes, terms

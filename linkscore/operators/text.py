"""Words of texts, naive Bayes on word sets, spam model."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from linkscore.runtime import stored
from linkscore.skew import salted_join


def tokens(text: Column, min_len: int = 3) -> Column:
    """Lower-case words of at least ``min_len`` letters, split at non-word characters."""
    return F.filter(F.split(F.lower(text), r"\W+"), lambda w: F.length(w) >= min_len)


def regex_tokens(text: Column, gap: str = r"\W", min_len: int = 1) -> Column:
    return F.filter(F.split(F.lower(text), gap), lambda w: F.length(w) >= min_len)


def words(df: DataFrame, key: str, text: str, min_len: int = 3, keep: tuple[str, ...] = ()) -> DataFrame:
    """One row per word occurrence."""
    return df.select(key, *keep, F.explode(tokens(F.col(text), min_len)).alias("word"))


def vocabulary(occurrences: DataFrame, key: str) -> DataFrame:
    """(word, total, docs): occurrences and texts per word."""
    per_text = occurrences.groupBy(key, "word").agg(F.count(F.lit(1)).alias("n"))
    return per_text.groupBy("word").agg(F.sum("n").alias("total"), F.count(F.lit(1)).alias("docs"))


def bag_of_words(occurrences: DataFrame, key: str) -> DataFrame:
    """(key, word, n): word counts; ``n > 0`` is the set-of-words view."""
    return occurrences.groupBy(key, "word").agg(F.count(F.lit(1)).alias("n"))


def nb_fit(occurrences: DataFrame, texts: DataFrame, key: str, y: str) -> tuple[DataFrame, DataFrame]:
    """Word and class tables of a two-class naive Bayes on word sets.

    Word counts start at 1 and class totals at 2. Returns (word, lp0, lp1)
    and one row (prior0, prior1).
    """
    sets = occurrences.select(key, y, "word").distinct()
    counts = sets.groupBy("word").agg(
        F.count(F.when(F.col(y) == 0, 1)).alias("n0"), F.count(F.when(F.col(y) == 1, 1)).alias("n1")
    )
    total = counts.agg(F.struct(F.sum("n0").alias("t0"), F.sum("n1").alias("t1"))).scalar()
    model = counts.select(
        "word",
        F.log((F.col("n0") + 1) / (total["t0"] + 2)).alias("lp0"),
        F.log((F.col("n1") + 1) / (total["t1"] + 2)).alias("lp1"),
    )
    p1 = F.avg(F.col(y).cast("double"))
    return model, texts.agg(F.log(1 - p1).alias("prior0"), F.log(p1).alias("prior1"))


def nb_predict(occurrences: DataFrame, model: DataFrame, priors: DataFrame, key: str) -> DataFrame:
    """(key, s0, s1, predicted): the class of the larger sum, 0 on a tie.

    A frequent word's rows are spread over several tasks.
    """
    p = priors.select(F.struct("prior0", "prior1")).scalar()
    sets = stored(occurrences.select(key, "word").distinct(), "sets")  # read for the hot words and for the join
    sums = salted_join(sets, model, ["word"], F.col(key)).groupBy(key).agg(F.sum("lp0").alias("s0"), F.sum("lp1").alias("s1"))
    scored = sums.select(key, (F.col("s0") + p["prior0"]).alias("s0"), (F.col("s1") + p["prior1"]).alias("s1"))
    return scored.withColumn("predicted", (F.col("s1") > F.col("s0")).cast("int"))


def top_words(vocab: DataFrame, k: int = 30) -> DataFrame:
    return vocab.orderBy(F.desc("total"), "word").limit(k)


def without_top_words(occurrences: DataFrame, vocab: DataFrame, k: int = 30) -> DataFrame:
    """Occurrences of all words but the ``k`` most frequent ones (a list of k rows)."""
    return occurrences.join(F.broadcast(top_words(vocab, k).select("word")), "word", "left_anti")


def top_indicative(model: DataFrame, floor: float = -6.0) -> DataFrame:
    """(cls, rank, word, lp): words above a log-probability, best first per class."""
    long = model.select(
        "word",
        F.explode(F.array(F.struct(F.lit(0).alias("cls"), F.col("lp0").alias("lp")), F.struct(F.lit(1).alias("cls"), F.col("lp1").alias("lp")))).alias("e"),
    ).select("e.cls", "word", "e.lp")
    # a class has fewer than exp(-floor) words above the floor
    order = Window.partitionBy("cls").orderBy(F.desc("lp"), "word")
    return long.where(F.col("lp") > floor).withColumn("rank", F.row_number().over(order))


def hash_tf(df: DataFrame, col: str, n: int = 1 << 20, out: str = "features") -> DataFrame:
    from pyspark.ml.feature import HashingTF

    return HashingTF(numFeatures=n, inputCol=col, outputCol=out).transform(df)


def spam_model(df: DataFrame, text: str, y: str, n: int = 1 << 20):
    """Logistic regression on hashed word counts; returns a fitted pipeline."""
    from pyspark.ml import Pipeline
    from pyspark.ml.classification import LogisticRegression
    from pyspark.ml.feature import HashingTF, RegexTokenizer

    return Pipeline(
        stages=[
            RegexTokenizer(inputCol=text, outputCol="_words", pattern=r"\W+", minTokenLength=3),
            HashingTF(numFeatures=n, inputCol="_words", outputCol="features"),
            LogisticRegression(featuresCol="features", labelCol=y, maxIter=20, regParam=0.01),
        ]
    ).fit(df)

"""Review sentiment and product categories."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from tidewatch import schemas as S
from tidewatch.functions import scalar as X
from tidewatch.functions.text import truncate
from tidewatch.operators import classify as C
from tidewatch.operators.estimates import SMALL_SIDE_BYTES, is_small
from tidewatch.operators.joins import left_join, matching
from tidewatch.operators.ledger import ask_once
from tidewatch.operators.selection import indexed, sample_exact
from tidewatch.session import stage

UNKNOWN = "Unknown"
ORPHAN_WARN_SHARE = 0.20
RED_NEGATIVE_PCT = 20
LABEL_CHARS = {"rating": 30, "complaint": 35}


# ---- sentiment ------------------------------------------------------------


def with_text(reviews: DataFrame) -> DataFrame:
    return reviews.filter(F.col("review_comment_message").isNotNull())


def classified_reviews(
    reviews: DataFrame,
    provider: C.Provider = C.stem_provider,
    sample: int | None = None,
    seed: int = 42,
    **options,
) -> DataFrame:
    """Reviews with text, all or a drawn sample, with label and error mark.

    The result is stored, as every use would call the provider again.
    """
    chosen = with_text(reviews)
    if sample is not None:
        chosen = sample_exact(chosen, sample, "review_id", seed)
    chosen = chosen.select(S.REVIEWS.fieldNames())
    return stage(C.classify(chosen, provider, key="review_id", **options), "classified")


def sentiment_job(
    reviews: DataFrame,
    provider: C.Provider,
    ledger: str,
    key: str = "review_id",
    sample: int | None = None,
    seed: int = 42,
    batch: int = C.BATCH,
    **waves,
) -> DataFrame:
    """The whole job (K17): sample, row index, batches, requests, replies by the ledger, labels and error marks.

    Rows keep their columns and get ``batch_id``, ``position``, ``sentiment`` and ``is_error``. A later run on the
    same ledger path sends only the requests that failed or were never sent.
    """
    chosen = with_text(reviews)
    if sample is not None:
        chosen = sample_exact(chosen, sample, key, seed)
    numbered = indexed(chosen, key, seed)
    place = {"batch_id": F.floor(F.col("row_idx") / batch), "position": (F.col("row_idx") % batch).cast("int")}
    placed = stage(numbered.withColumns(place).drop("row_idx"), "review-batches")
    requests = C.requests(placed, "batch_id", "position", "review_comment_message", most=batch)
    replies = ask_once(requests, provider, ledger, **waves).withColumnRenamed("reply", "_reply")
    return C.apply_replies(placed, replies, "batch_id", "position", "_reply")


def classification_audit(classified: DataFrame) -> DataFrame:
    """Rows, rows of failed batches, invalid labels and usable rows (Q20)."""
    return classified.agg(
        F.count("*").alias("n"),
        F.count_if(F.col("is_error")).alias("errors"),
        F.count_if(~F.col("sentiment").isin(S.SENTIMENTS)).alias("invalid_labels"),
        F.count_if(~F.col("is_error")).alias("usable"),
    )


def sentiment_table(classified: DataFrame) -> DataFrame:
    """The rows that were really classified, in table order."""
    return C.accepted(classified).select(S.SENTIMENT.fieldNames())


def shares(sentiment: DataFrame) -> DataFrame:
    """Rows and share per label over the classified rows (M17); an empty table gives 0."""

    def share(label: str):
        hits = F.count_if(F.col("sentiment") == label).cast("double")
        return F.coalesce(F.try_divide(hits, F.count("sentiment")), F.lit(0.0))

    return sentiment.agg(
        F.count("*").alias("n"), *[share(label).alias(label.lower()) for label in S.SENTIMENTS]
    )


def label_counts(sentiment: DataFrame) -> DataFrame:
    counts = sentiment.groupBy("sentiment").agg(F.count("*").alias("n"))
    # Three labels pass through the window.
    pct = F.col("n") * 100.0 / F.sum("n").over(Window.partitionBy(F.lit(0)))
    return counts.withColumn("pct", pct).orderBy("sentiment")


def by_star(sentiment: DataFrame) -> DataFrame:
    """Labels per star rating; labels that do not occur count 0."""
    counted = sentiment.groupBy("review_score").pivot("sentiment", S.SENTIMENTS)
    return counted.agg(F.count(F.lit(1))).na.fill(0).orderBy("review_score")


def by_star_pct(sentiment: DataFrame) -> DataFrame:
    """The same in percent of each star rating."""
    total = sum((F.col(label) for label in S.SENTIMENTS[1:]), F.col(S.SENTIMENTS[0]))
    return by_star(sentiment).select(
        "review_score", *[(F.col(label) / total * 100).alias(label) for label in S.SENTIMENTS]
    )


# ---- categories -----------------------------------------------------------


def category_sentiment(
    sentiment: DataFrame,
    items: DataFrame,
    products: DataFrame,
    translation: DataFrame,
    small_side_bytes: int = SMALL_SIDE_BYTES,
    deal: bool = False,
) -> DataFrame:
    """One row per review and order item, with the product category.

    A review of several items counts once for each. Items are first cut down
    to the orders that were reviewed, if those are few. Where they are still
    too many to broadcast, their categories are looked up on the narrow item
    rows and stored, so the review texts are moved once. With ``deal`` they
    are also moved if items are broadcast: for results that are written out.
    """
    reviews = sentiment.select(
        "review_id",
        "order_id",
        F.col("review_score").alias("star_rating"),
        "sentiment",
        "review_comment_message",
    )
    lines = items.select("order_id", "product_id")
    limit = small_side_bytes
    if not is_small(lines, limit):
        lines = matching(lines, reviews.select("order_id"), "order_id", limit)
    if not is_small(lines, limit):
        looked_up = stage(_categories(lines, products, translation, limit), "item-lines")
        texts = dealt(reviews) if deal and is_small(looked_up, limit) else reviews
        joined = left_join(texts, looked_up, "order_id", small_side_bytes=limit)
    else:
        texts = dealt(reviews) if deal else reviews
        joined = _categories(left_join(texts, lines, "order_id", small_side_bytes=limit), products, translation, limit)
    category = F.coalesce("product_category_name_english", "product_category_name", F.lit(UNKNOWN))
    return joined.withColumn("category", category).select(S.CATEGORY_SENTIMENT.fieldNames())


def dealt(reviews: DataFrame) -> DataFrame:
    """Reviews in equal shares. Files of few large row groups would leave the writing of all texts to a few tasks."""
    return reviews.repartition("review_id", "review_comment_message")


def _categories(lines: DataFrame, products: DataFrame, translation: DataFrame, limit: int) -> DataFrame:
    """The category names of every line. Products that are not few are translated first, so that lines move once."""
    names = products.select("product_id", "product_category_name")
    if is_small(names, limit):
        named = left_join(lines, names, "product_id", small_side_bytes=limit)
        return left_join(named, translation, "product_category_name", small_side_bytes=limit).drop("product_id")
    translated = stage(left_join(names, translation, "product_category_name", small_side_bytes=limit), "product-names")
    return left_join(lines, translated, "product_id", small_side_bytes=limit).drop("product_id")


def orphans(categories: DataFrame) -> DataFrame:
    """Rows without a category, their share, and whether that is too much."""
    unknown = F.count_if(F.col("category") == UNKNOWN)
    share = F.coalesce(F.try_divide(unknown.cast("double"), F.count("*")), F.lit(0.0))
    return categories.agg(
        F.count("*").alias("joined_rows"),
        unknown.alias("unknown_rows"),
        share.alias("unknown_share"),
        (share > ORPHAN_WARN_SHARE).alias("is_poor"),
    )


def category_stats(categories: DataFrame) -> DataFrame:
    """Ratings and label fractions per category with enough rows.

    Enough is a hundredth of all joined rows, but at least 3 and at most 20.
    """

    def fraction(label: str):
        hits = F.count_if(F.col("sentiment") == label).cast("double")
        return X.round_half_away(hits / F.count("sentiment"), 3)

    grouped = categories.groupBy("category").agg(
        F.count("*").alias("review_count"),
        X.round_half_away(F.avg("star_rating"), 2).alias("avg_stars"),
        fraction("Positive").alias("pct_positive"),
        fraction("Negative").alias("pct_negative"),
        fraction("Neutral").alias("pct_neutral"),
    )
    # One row per category passes through the window.
    total = F.sum("review_count").over(Window.partitionBy(F.lit(0)))
    enough = F.greatest(F.lit(3), F.least(F.lit(20), F.floor(total / 100)))
    return (
        grouped.withColumn("_enough", enough)
        .filter(F.col("review_count") >= F.col("_enough"))
        .filter(F.col("category") != UNKNOWN)
        .drop("_enough")
        .orderBy(F.desc("avg_stars"), "category")
    )


def best_rated(stats: DataFrame, k: int = 5) -> DataFrame:
    """The first k categories by rating, with a chart label."""
    return _rating_label(stats.orderBy(F.desc("avg_stars"), "category").limit(k))


def worst_rated(stats: DataFrame, k: int = 10) -> DataFrame:
    """The last k categories by rating, the worst first (O3)."""
    return _rating_label(stats.orderBy("avg_stars", F.desc("category")).limit(k))


def _rating_label(stats: DataFrame) -> DataFrame:
    return stats.withColumn("label", truncate(F.col("category"), LABEL_CHARS["rating"]))


def most_complained(stats: DataFrame, k: int = 15) -> DataFrame:
    """The k categories with most negative rows, in percent, with a chart label."""
    return (
        stats.orderBy(F.desc("pct_negative"), "category")
        .limit(k)
        .select(
            "category",
            truncate(F.col("category"), LABEL_CHARS["complaint"]).alias("label"),
            "review_count",
            "avg_stars",
            "pct_negative",
            (F.col("pct_negative") * 100).alias("neg_pct"),
            (F.col("pct_negative") * 100 > RED_NEGATIVE_PCT).alias("is_red"),
        )
    )


def overall_averages(stats: DataFrame) -> DataFrame:
    """Means over the categories, each counting once.

    Stars hold two decimals and fractions three, so both are summed as whole
    numbers, which no order of rows can change.
    """

    def mean(column: str, scale: float):
        return F.sum(F.round(F.col(column) * scale).cast("long")) / (F.count(column) * scale)

    return stats.agg(
        F.count("*").alias("categories"),
        mean("avg_stars", 100.0).alias("avg_stars"),
        (mean("pct_negative", 1000.0) * 100).alias("avg_negative_pct"),
    )

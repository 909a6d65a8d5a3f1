"""Tweets: from raw messages to enriched rows and their statistics."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from kerbside.functions import text as X
from kerbside.operators.decode import BAD_RECORD, parse_json_marked, to_message
from kerbside.operators.validate import REASON, normalise_tweet, split_valid, tweet_rules, with_reject_reason
from kerbside.schemas import TWEET


def read_tweets(messages: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Valid tweets with defaults filled, and the rejected ones with the reason."""
    good, bad = split_valid(parse_json_marked(messages, TWEET), tweet_rules())
    return normalise_tweet(good.drop(BAD_RECORD)), bad


def enrich_tweets(df: DataFrame) -> DataFrame:
    """The 13 columns of an enriched tweet."""
    return df.select(
        "tweet_id",
        "user_handle",
        "text",
        "language",
        "created_at",
        "retweet_count",
        "like_count",
        X.hashtags("text").alias("hashtags"),
        X.mentions("text").alias("mentions"),
        X.url_count("text").alias("url_count"),
        X.sentiment("text").alias("sentiment_label"),
        X.word_count("text").alias("word_count"),
        F.unix_millis(F.current_timestamp()).alias("processed_at"),
    )


def tweet_stats(messages: DataFrame) -> DataFrame:
    """One row: processed, errors and the number of tweets per sentiment, from one pass over raw messages."""
    labels = ("positive", "neutral", "negative")
    marked = with_reject_reason(parse_json_marked(messages, TWEET), tweet_rules())
    good = F.col(REASON).isNull()
    seen = marked.select(good.alias("good"), F.when(good, X.sentiment("text")).alias("label"))
    return seen.agg(
        F.count_if("good").alias("processed"),
        F.count_if(~F.col("good")).alias("errors"),
        *[F.count_if(F.col("label") == label).alias(label) for label in labels],
    )


def enriched_messages(messages: DataFrame) -> DataFrame:
    """Raw tweet messages to enriched messages keyed by tweet id; works on streams."""
    good, _ = read_tweets(messages)
    return to_message(enrich_tweets(good), "tweet_id")

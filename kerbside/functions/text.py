"""Short-text enrichment: tags, mentions, links, sentiment and word counts."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

from kerbside.functions.scalars import as_column

# The two word lists.
POSITIVE = ("great", "awesome", "love", "excellent", "fantastic", "happy", "good", "best", "amazing")
NEGATIVE = ("bad", "terrible", "hate", "awful", "horrible", "sad", "worst", "poor", "broken")

# Letters, digits and underscore of every script.
WORD_CHARS = r"[\p{L}\p{N}_]+"
# White space of every script; Java's \s alone covers ASCII only.
SPACE = r"\s\x{0b}\x{1c}-\x{1f}\x{85}\x{a0}\x{1680}\x{2000}-\x{200a}\x{2028}\x{2029}\x{202f}\x{205f}\x{3000}"
# Anything else. Two wide ranges come first, so that most characters are decided by one comparison.
NON_SPACE = r"[!-~\x{a1}-\x{167f}" + f"[^{SPACE}]]"


def _tagged(text: Column | str, mark: str) -> Column:
    # Most texts have no mark; a plain search for it costs a third of the pattern.
    text = as_column(text)
    found = F.regexp_extract_all(text, F.lit(f"{mark}({WORD_CHARS})"), F.lit(1))
    return F.when(text.isNull() | text.contains(mark), found).otherwise(F.array().cast("array<string>"))


def hashtags(text: Column | str) -> Column:
    return _tagged(text, "#")


def mentions(text: Column | str) -> Column:
    return _tagged(text, "@")


def url_count(text: Column | str) -> Column:
    return F.regexp_count(as_column(text), F.lit(f"https?://{NON_SPACE}+"))


def word_count(text: Column | str) -> Column:
    """Runs of non-space characters, counted without building the list of words."""
    return F.regexp_count(as_column(text), F.lit(f"{NON_SPACE}+"))


def sentiment(
    text: Column | str, positive: Sequence[str] = POSITIVE, negative: Sequence[str] = NEGATIVE
) -> Column:
    """Which list shares more different words with the text. Punctuation stays attached to words.

    One pass picks out the listed words that stand alone between spaces; the other words of a long
    text are never built.
    """
    listed = "|".join(f"\\Q{word}\\E" for word in dict.fromkeys((*positive, *negative)))
    alone = f"(?<!{NON_SPACE})({listed})(?!{NON_SPACE})"
    found = F.array_distinct(F.regexp_extract_all(F.lower(as_column(text)), F.lit(alone), F.lit(1)))
    lean = F.aggregate(
        found,
        F.lit(0),
        lambda score, word: score + word.isin(*positive).cast("int") - word.isin(*negative).cast("int"),
    )
    labels = F.array(F.lit("negative"), F.lit("neutral"), F.lit("positive"))
    return F.element_at(labels, F.coalesce(F.signum(lean), F.lit(0)).cast("int") + 2)

"""Review text: sentinels, sentiment from the score, topics from a dictionary."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

# Texts that mean "nothing written".
NO_POSITIVE = "No Positive"
NO_NEGATIVE = "No Negative"

# Score bounds of the derived sentiment.
NEGATIVE_BELOW = 6.0
POSITIVE_ABOVE = 8.0

# Topic names. The words that mention them are a starting point to extend.
HOTEL_TOPICS: dict[str, tuple[str, ...]] = {
    "Breakfast": ("breakfast", "buffet", "coffee", "eggs", "croissant"),
    "Room Size": ("room size", "size", "spacious", "tiny", "cramped", "small"),
    "Staff": ("staff", "reception", "receptionist", "service", "concierge"),
    "Location": ("location", "located", "metro", "central", "station"),
    "Cleanliness": ("clean", "cleanliness", "dirty", "dust", "stain"),
    "Noise": ("noise", "noisy", "loud", "quiet", "soundproof"),
}

WORD_BREAK = r"[^\p{L}\p{N}]+"
WHITESPACE = " \t\n\r\v\f"


def absent_as_null(text: Column) -> Column:
    return F.when(~text.isin(NO_POSITIVE, NO_NEGATIVE), text)


def joined_text(positive: Column, negative: Column) -> Column:
    """Both halves of a review as one text, empty when neither was written."""
    both = F.concat_ws(" ", absent_as_null(positive), absent_as_null(negative))
    return F.btrim(both, F.lit(WHITESPACE))


def sentiment(score: Column) -> Column:
    return (
        F.when(score < NEGATIVE_BELOW, "Negative")
        .when(score > POSITIVE_ABOVE, "Positive")
        .otherwise("Neutral")
    )


def words_of(text: Column) -> Column:
    """The words of a text in lower case, in order."""
    return F.split(F.lower(text), WORD_BREAK)


def mentioned_words(words: Column, dictionary: Mapping[str, Sequence[str]]) -> Column:
    """The words and phrases of the dictionary that occur among the words of a text.

    A phrase is words with one space between them; any separator may stand
    between them in the text. Words are looked up in one pass; only a dictionary
    with phrases has the words joined again to search for them.
    """
    known = sorted({word for topic_words in dictionary.values() for word in topic_words})
    phrases = [word for word in known if " " in word]
    found = F.array_intersect(words, F.array(*map(F.lit, known)))
    if not phrases:
        return found
    spaced = F.concat(F.lit(" "), F.array_join(words, " "), F.lit(" "))
    held = F.filter(F.array(*map(F.lit, phrases)), lambda phrase: F.contains(spaced, F.concat(F.lit(" "), phrase, F.lit(" "))))
    return F.concat(found, held)


def topics_of(mentioned: Column, dictionary: Mapping[str, Sequence[str]]) -> Column:
    """Sorted array of the topics that one of the mentioned words belongs to."""
    hits = [
        F.when(F.arrays_overlap(mentioned, F.array(*map(F.lit, dictionary[topic]))), topic)
        for topic in sorted(dictionary)
    ]
    return F.array_except(F.array(*hits), F.array(F.lit(None).cast("string")))

"""Words of a text, and the words that carry no topic."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# A word is a run of letters of any script.  ``\W`` would not do: it is
# ASCII-only in Java and cuts accented words apart.
WORD = r"\p{L}+"

# Function words of the languages in the document tables.
STOP_WORDS = {
    "en": (
        "a an and are as at be but by for from has have he her his i if in is it its "
        "not of on or she so that the their they this to was we were will with you"
    ).split(),
    "fr": (
        "au aux ce ces dans de des du elle en et il je la le les leur lui ma mais me "
        "ne nous on ou par pas pour qu que qui sa se ses son sur un une vous"
    ).split(),
    "de": (
        "aber als am an auf aus bei das dem den der des die ein eine einen er es "
        "für ich ihr im in ist mit nicht oder sich sie sind und von was wir zu"
    ).split(),
    "es": (
        "al como con de del el ella en es esta este la las lo los más me mi no nos "
        "o para pero por que se si sin su sus un una y ya yo"
    ).split(),
}


def all_stop_words() -> list[str]:
    """The stop words of every language, each once, sorted."""
    return sorted({word for words in STOP_WORDS.values() for word in words})


def words(text: Column) -> Column:
    """The lower-cased words of a text, in order, without digits or punctuation."""
    return F.regexp_extract_all(F.lower(text), F.lit(WORD), F.lit(0))

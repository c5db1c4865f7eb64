"""Terms of English texts for full-text search: without accents and common words, reduced to stems."""

from __future__ import annotations

import re
import unicodedata
from functools import lru_cache

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F

#: Common words that tell nothing of a text.
STOP = frozenset(
    "a about above after again against all am an and any are as at be because been before being below between both but by can could did do does doing down during each few for from further had has have having he her here hers "
    "herself him himself his how i if in into is it its itself just me more most my myself no nor not now of off on once only or other our ours ourselves out over own same she should so some such than that the their theirs them "
    "themselves then there these they this those through to too under until up very was we were what when where which while who whom why will with would you your yours yourself yourselves".split()
)
#: The suffixes of the second, third and fourth step of the suffix-stripping algorithm of 1980, with what stands for them.
SECOND = {"ational": "ate", "tional": "tion", "enci": "ence", "anci": "ance", "izer": "ize", "abli": "able", "alli": "al", "entli": "ent", "eli": "e", "ousli": "ous", "ization": "ize", "ation": "ate", "ator": "ate", "alism": "al", "iveness": "ive", "fulness": "ful", "ousness": "ous", "aliti": "al", "iviti": "ive", "biliti": "ble"}
THIRD = {"icate": "ic", "ative": "", "alize": "al", "iciti": "ic", "ical": "ic", "ful": "", "ness": ""}
FOURTH = ("al", "ance", "ence", "er", "ic", "able", "ible", "ant", "ement", "ment", "ent", "ion", "ou", "ism", "ate", "iti", "ous", "ive", "ize")


def _sounds(word: str) -> str:
    """v for vowels, c for consonants; y is a vowel after a consonant."""
    out = ""
    for k, letter in enumerate(word):
        out += "v" if letter in "aeiou" or letter == "y" and k and out[-1] == "c" else "c"
    return out


def _measure(word: str) -> int:
    """How often a consonant follows a vowel."""
    return len(re.findall("vc", re.sub(r"(.)\1+", r"\1", _sounds(word))))


def _short(word: str) -> bool:
    """Whether a word ends consonant, vowel, consonant, the last not w, x or y."""
    return _sounds(word)[-3:] == "cvc" and word[-1] not in "wxy"


def _replaced(word: str, table: dict[str, str]) -> str:
    """The longest suffix of the table that the word ends with, replaced if what is left has a measure."""
    for suffix in sorted(table, key=len, reverse=True):
        if word.endswith(suffix):
            rest = word[: -len(suffix)]
            return rest + table[suffix] if _measure(rest) > 0 else word
    return word


@lru_cache(maxsize=200_000)
def stem(word: str) -> str:
    """The stem of a word in lower case by suffix stripping; words of two letters or with others than a to z stay."""
    if len(word) < 3 or not re.fullmatch("[a-z]+", word):
        return word
    if word.endswith(("sses", "ies")):
        word = word[:-2]
    elif word.endswith("s") and not word.endswith("ss"):
        word = word[:-1]
    if word.endswith("eed"):
        word = word[:-1] if _measure(word[:-3]) > 0 else word
    else:
        rest = word[:-2] if word.endswith("ed") else word[:-3] if word.endswith("ing") else ""
        if "v" in _sounds(rest):
            word = rest
            if word.endswith(("at", "bl", "iz")):
                word += "e"
            elif len(word) > 1 and word[-1] == word[-2] and _sounds(word)[-1] == "c" and word[-1] not in "lsz":
                word = word[:-1]
            elif _measure(word) == 1 and _short(word):
                word += "e"
    if word.endswith("y") and "v" in _sounds(word[:-1]):
        word = word[:-1] + "i"
    word = _replaced(_replaced(word, SECOND), THIRD)
    for suffix in sorted(FOURTH, key=len, reverse=True):
        if word.endswith(suffix):
            rest = word[: -len(suffix)]
            if _measure(rest) > 1 and (suffix != "ion" or rest[-1:] in ("s", "t")):
                word = rest
            break
    if word.endswith("e") and (_measure(word[:-1]) > 1 or _measure(word[:-1]) == 1 and not _short(word[:-1])):
        word = word[:-1]
    if word.endswith("ll") and _measure(word[:-1]) > 1:
        word = word[:-1]
    return word


def terms(text: Column) -> Column:
    """The stems of a text's words, in order, without STOP; null has none. Runs in Python, batch by batch."""

    @F.pandas_udf("array<string>")
    def found(texts: pd.Series) -> pd.Series:
        def one(t: str | None) -> list[str]:
            plain = "".join(c for c in unicodedata.normalize("NFKD", (t or "").lower()) if not unicodedata.combining(c))
            return [stem(w) for w in re.findall(r"[^\W_]+", plain) if w not in STOP]

        return texts.map(one)

    return found(text)

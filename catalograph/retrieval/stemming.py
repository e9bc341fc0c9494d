"""Porter's suffix stripping (1980), as his released program does it."""

from __future__ import annotations

import re
from functools import lru_cache, reduce

from pyspark.sql import Column
from pyspark.sql import functions as F

_STEP2 = {"ational": "ate", "tional": "tion", "enci": "ence", "anci": "ance", "izer": "ize",
          "bli": "ble", "alli": "al", "entli": "ent", "eli": "e", "ousli": "ous",
          "ization": "ize", "ation": "ate", "ator": "ate", "alism": "al", "iveness": "ive",
          "fulness": "ful", "ousness": "ous", "aliti": "al", "iviti": "ive", "biliti": "ble",
          "logi": "log"}
_STEP3 = {"icate": "ic", "ative": "", "alize": "al", "iciti": "ic", "ical": "ic", "ful": "",
          "ness": ""}
_STEP4 = ("al", "ance", "ence", "er", "ic", "able", "ible", "ant", "ement", "ment", "ent", "ion",
          "ou", "ism", "ate", "iti", "ous", "ive", "ize")


def _shape(word: str) -> str:
    """Letters as c (consonant) or v; y is a vowel after a consonant."""
    out = ""
    for letter in word:
        vowel = letter in "aeiou" or (letter == "y" and out.endswith("c"))
        out += "v" if vowel else "c"
    return out


def _measure(stem: str) -> int:
    return len(re.findall("v+c+", _shape(stem)))


def _has_vowel(stem: str) -> bool:
    return "v" in _shape(stem)


def _double(word: str) -> bool:
    return len(word) > 1 and word[-1] == word[-2] and _shape(word)[-1] == "c"


def _short_end(word: str) -> bool:
    return _shape(word)[-3:] == "cvc" and word[-1] not in "wxy"


def _longest(word: str, suffixes) -> str | None:
    return max((s for s in suffixes if word.endswith(s)), key=len, default=None)


def _swap(word: str, table: dict[str, str]) -> str:
    suffix = _longest(word, table)
    if suffix and _measure(word[:-len(suffix)]) > 0:
        return word[:-len(suffix)] + table[suffix]
    return word


def _plural(w: str) -> str:
    if w.endswith("sses") or w.endswith("ies"):
        return w[:-2]
    return w[:-1] if w.endswith("s") and not w.endswith("ss") else w


def _past(w: str) -> str:
    if w.endswith("eed"):
        return w[:-1] if _measure(w[:-3]) > 0 else w
    suffix = _longest(w, ("ed", "ing"))
    if not suffix or not _has_vowel(w[:-len(suffix)]):
        return w
    w = w[:-len(suffix)]
    if w.endswith(("at", "bl", "iz")):
        return w + "e"
    if _double(w) and w[-1] not in "lsz":
        return w[:-1]
    return w + "e" if _measure(w) == 1 and _short_end(w) else w


@lru_cache(maxsize=1_000_000)
def stem(word: str) -> str:
    if len(word) < 3:
        return word
    w = _past(_plural(word))
    if w.endswith("y") and _has_vowel(w[:-1]):
        w = w[:-1] + "i"
    w = _swap(_swap(w, _STEP2), _STEP3)
    suffix = _longest(w, _STEP4)
    if suffix and _measure(w[:-len(suffix)]) > 1 and (
            suffix != "ion" or w[:-3].endswith(("s", "t"))):
        w = w[:-len(suffix)]
    if w.endswith("e"):
        m = _measure(w[:-1])
        if m > 1 or (m == 1 and not _short_end(w[:-1])):
            w = w[:-1]
    return w[:-1] if _measure(w) > 1 and _double(w) and w.endswith("l") else w


# ---------------------------------------------------------------- the same rules over columns

_CONSONANTS, _VOWELS = "[^aeiou][^aeiouy]*", "[aeiouy][aeiou]*"
_ANY_VOWEL = f"^({_CONSONANTS})?[aeiouy]"
_MORE_THAN_0 = f"^({_CONSONANTS})?{_VOWELS}{_CONSONANTS}"
_EXACTLY_1 = f"^({_CONSONANTS})?{_VOWELS}{_CONSONANTS}({_VOWELS})?$"
_MORE_THAN_1 = f"{_MORE_THAN_0}{_VOWELS}{_CONSONANTS}"
_SHORT = f"^{_CONSONANTS}[aeiouy][^aeiouwxy]$"
_LAST_Y_CONSONANT = "[aeiou]y(yy)*$|[^aeiouy](yy)+$"
# A word too short to be stemmed ends in the first mark meanwhile, one that lost "ed" or "ing" in the second.
_KEPT, _CUT = "\x00", "\x01"


def _without(word: Column, last: int) -> Column:
    return F.left(word, F.length(word) - last)


def _ends(word: Column, *suffixes: str) -> Column:
    return reduce(lambda a, b: a | b, [F.endswith(word, F.lit(s)) for s in suffixes])


def _opened(w: Column) -> Column:
    """A first y is a consonant: written as Y, which no vowel class holds."""
    return F.when(F.length(w) < 3, F.concat(w, F.lit(_KEPT))).when(
        F.startswith(w, F.lit("y")), F.concat(F.lit("Y"), F.substring(w, 2, _LONGEST))).otherwise(w)


def _singular(w: Column) -> Column:
    return F.when(~_ends(w, "s"), w).when(_ends(w, "sses", "ies"), _without(w, 2)).when(
        ~_ends(w, "ss"), _without(w, 1)).otherwise(w)


def _present(w: Column) -> Column:
    return (F.when(~_ends(w, "ed", "ing"), w)
            .when(_ends(w, "eed"), F.when(_without(w, 3).rlike(_MORE_THAN_0), _without(w, 1)).otherwise(w))
            .when(_ends(w, "ed") & _without(w, 2).rlike(_ANY_VOWEL), F.concat(_without(w, 2), F.lit(_CUT)))
            .when(_ends(w, "ing") & _without(w, 3).rlike(_ANY_VOWEL), F.concat(_without(w, 3), F.lit(_CUT)))
            .otherwise(w))


def _mended(w: Column) -> Column:
    cut = _without(w, 1)
    double = (F.right(cut, F.lit(1)) == F.left(F.right(cut, F.lit(2)), F.lit(1))) & (F.length(cut) > 1)
    consonant = ~_ends(cut, *"aeioulsz") & (~_ends(cut, "y") | cut.rlike(_LAST_Y_CONSONANT))
    return (F.when(~_ends(w, _CUT), w).when(_ends(cut, "at", "bl", "iz"), F.concat(cut, F.lit("e")))
            .when(double & consonant, _without(w, 2)).when(cut.rlike(_SHORT), F.concat(cut, F.lit("e")))
            .otherwise(cut))


def _last_y(w: Column) -> Column:
    return F.when(_ends(w, "y") & _without(w, 1).rlike(_ANY_VOWEL), F.concat(_without(w, 1), F.lit("i"))).otherwise(w)


def _swapped(w: Column, table: dict[str, str], measure: str) -> Column:
    """The longest suffix of the table that the word ends in, replaced if the rest measures enough."""
    # Most words end in no suffix of the table: one look at their last two letters settles it.
    choice = F.when(~F.substring(w, -2, 2).isin(sorted({s[-2:] for s in table})), w)
    for suffix in sorted(table, key=len, reverse=True):
        rest = _without(w, len(suffix))
        enough = rest.rlike(measure)
        if suffix == "ion":
            enough = _ends(rest, "s", "t") & enough
        new = F.concat(rest, F.lit(table[suffix])) if table[suffix] else rest
        choice = choice.when(_ends(w, suffix), F.when(enough, new).otherwise(w))
    return choice.otherwise(w)


def _without_e(w: Column) -> Column:
    rest = _without(w, 1)
    return F.when(_ends(w, "e") & (rest.rlike(_MORE_THAN_1) | (rest.rlike(_EXACTLY_1) & ~rest.rlike(_SHORT))), rest).otherwise(w)


def _closed(w: Column) -> Column:
    w = F.when(_ends(w, _KEPT) | (_ends(w, "ll") & w.rlike(_MORE_THAN_1)), _without(w, 1)).otherwise(w)
    return F.when(F.startswith(w, F.lit("Y")), F.concat(F.lit("y"), F.substring(w, 2, _LONGEST))).otherwise(w)


_LONGEST = 2**31 - 1
_STEPS = (_opened, _singular, _present, _mended, _last_y, lambda w: _swapped(w, _STEP2, _MORE_THAN_0),
          lambda w: _swapped(w, _STEP3, _MORE_THAN_0), lambda w: _swapped(w, dict.fromkeys(_STEP4, ""), _MORE_THAN_1),
          _without_e, _closed)


def stem_all(tokens: Column) -> Column:
    """Every token of an array column stemmed, as ``stem`` does it, in the JVM; nulls (removed words) stay.

    Each step is one pass over the array, so no step's expression is written out inside the next one's.
    """
    return reduce(F.transform, _STEPS, tokens)

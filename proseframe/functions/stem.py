"""English suffix stripping for ROUGE tokens (Porter 1980, with the usual extensions)."""

from __future__ import annotations

from functools import lru_cache

# Suffix tables and irregular forms.
STEP2 = (
    ("ational", "ate"), ("tional", "tion"), ("enci", "ence"), ("anci", "ance"), ("izer", "ize"),
    ("bli", "ble"), ("alli", "al"), ("entli", "ent"), ("eli", "e"), ("ousli", "ous"),
    ("ization", "ize"), ("ation", "ate"), ("ator", "ate"), ("alism", "al"), ("iveness", "ive"),
    ("fulness", "ful"), ("ousness", "ous"), ("aliti", "al"), ("iviti", "ive"), ("biliti", "ble"),
    ("fulli", "ful"),
)
STEP3 = (
    ("icate", "ic"), ("ative", ""), ("alize", "al"), ("iciti", "ic"), ("ical", "ic"),
    ("ful", ""), ("ness", ""),
)
STEP4 = (
    "al", "ance", "ence", "er", "ic", "able", "ible", "ant", "ement", "ment", "ent", "ion",
    "ou", "ism", "ate", "iti", "ous", "ive", "ize",
)
STEP4_LONGEST_FIRST = tuple(sorted(STEP4, key=len, reverse=True))
IRREGULAR = {
    "sky": "sky", "skies": "sky", "dying": "die", "lying": "lie", "tying": "tie",
    "news": "news", "innings": "inning", "inning": "inning", "outings": "outing",
    "outing": "outing", "cannings": "canning", "canning": "canning", "howe": "howe",
    "proceed": "proceed", "exceed": "exceed", "succeed": "succeed",
}


CACHED_WORDS = 200_000


def _shape(word: str) -> str:
    """One letter per character: v for a vowel, c for a consonant (y depends on its left side)."""
    out = ""
    for i, ch in enumerate(word):
        vowel = ch in "aeiou" or (ch == "y" and i > 0 and out[-1] == "c")
        out += "v" if vowel else "c"
    return out


def _measure(word: str) -> int:
    return _shape(word).count("vc")


def _double(word: str) -> bool:
    return len(word) > 1 and word[-1] == word[-2] and _shape(word)[-1] == "c"


def _short_end(word: str) -> bool:
    shape = _shape(word)
    return (shape.endswith("cvc") and word[-1] not in "wxy") or shape == "vc"


def _swap(word: str, table, least: int) -> str:
    """Replace the first suffix of the table that fits, if enough stem is left."""
    for old, new in table:
        if word.endswith(old):
            stem = word[: len(word) - len(old)]
            return stem + new if _measure(stem) >= least else word
    return word


def stem(word: str) -> str:
    if word in IRREGULAR:
        return IRREGULAR[word]
    if len(word) <= 2:
        return word

    # plurals
    if word.endswith("ies") and len(word) == 4:
        word = word[:-1]
    elif word.endswith("sses") or word.endswith("ies"):
        word = word[:-2]
    elif word.endswith("s") and not word.endswith("ss"):
        word = word[:-1]

    # past and progressive forms
    if word.endswith("ied"):
        word = word[:-1] if len(word) == 4 else word[:-2]
    elif word.endswith("eed"):
        if _measure(word[:-3]) > 0:
            word = word[:-1]
    else:
        for suffix in ("ed", "ing"):
            base = word[: -len(suffix)]
            if word.endswith(suffix) and "v" in _shape(base):
                if base.endswith(("at", "bl", "iz")):
                    base += "e"
                elif _double(base):
                    if base[-1] not in "lsz":
                        base = base[:-1]
                elif _measure(base) == 1 and _short_end(base):
                    base += "e"
                word = base
                break

    # final y
    if word.endswith("y") and len(word) > 2 and _shape(word[:-1])[-1] == "c":
        word = word[:-1] + "i"

    # derivational suffixes
    if word.endswith("alli") and _measure(word[:-4]) > 0:
        word = word[:-2]
    if word.endswith("logi") and _measure(word[:-3]) > 0:
        word = word[:-1]
    else:
        word = _swap(word, STEP2, 1)
    word = _swap(word, STEP3, 1)
    for suffix in STEP4_LONGEST_FIRST:
        if word.endswith(suffix):
            base = word[: len(word) - len(suffix)]
            if _measure(base) > 1 and (suffix != "ion" or base.endswith(("s", "t"))):
                word = base
            break

    # final e and double l
    if word.endswith("e"):
        base = word[:-1]
        if _measure(base) > 1 or (_measure(base) == 1 and not _short_end(base)):
            word = base
    if word.endswith("ll") and _measure(word[:-1]) > 1:
        word = word[:-1]
    return word


@lru_cache(maxsize=CACHED_WORDS)
def cached_stem(token: str) -> str:
    """The stem of a token, from the worker's cache of recent ones."""
    return stem(token)


def stemmed(tokens: list[str]) -> list[str]:
    """The stems of a token list; tokens up to three characters stay.

    Stemming in place keeps the step free of shuffles: joining tokens to a stem
    table would move every token and put the commonest word in one task.
    """
    return [cached_stem(t) if len(t) > 3 else t for t in tokens]

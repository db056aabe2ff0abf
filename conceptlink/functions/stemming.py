"""Porter stemming as one column expression.

Each step is a lambda over a one-element array, so a step can look at its word
many times while the expression grows only linearly with the steps.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, functions as F

# Fixed values of the published algorithm and its later revisions, in matching order.
IRREGULAR = {
    "skies": "sky", "sky": "sky", "dying": "die", "lying": "lie", "tying": "tie",
    "news": "news", "innings": "inning", "inning": "inning", "outings": "outing",
    "outing": "outing", "cannings": "canning", "canning": "canning", "howe": "howe",
    "proceed": "proceed", "exceed": "exceed", "succeed": "succeed",
}
PLURALS = [("sses", "ss"), ("ies", "i"), ("ss", "ss"), ("s", "")]
DERIVED = [
    ("ational", "ate"), ("tional", "tion"), ("enci", "ence"), ("anci", "ance"),
    ("izer", "ize"), ("bli", "ble"), ("alli", "al"), ("entli", "ent"), ("eli", "e"),
    ("ousli", "ous"), ("ization", "ize"), ("ation", "ate"), ("ator", "ate"),
    ("alism", "al"), ("iveness", "ive"), ("fulness", "ful"), ("ousness", "ous"),
    ("aliti", "al"), ("iviti", "ive"), ("biliti", "ble"), ("fulli", "ful"),
]
QUALITIES = [
    ("icate", "ic"), ("ative", ""), ("alize", "al"), ("iciti", "ic"),
    ("ical", "ic"), ("ful", ""), ("ness", ""),
]
ENDINGS = [
    "al", "ance", "ence", "er", "ic", "able", "ible", "ant", "ement", "ment", "ent",
    "ion", "ou", "ism", "ate", "iti", "ous", "ive", "ize",
]

POSITIVE = "^C*V+C"  # a vowel run followed by a consonant
LONG = "^C*V+C+V+C"  # twice or more
SINGLE = "^C*V+C+V*$"  # exactly once


def letters(word: Column) -> Column:
    """Word as a string of V and C; y is a vowel right after a consonant."""
    vowel_y = F.regexp_replace(word, "(?<=[^aeiouy])y", "a")
    return F.regexp_replace(F.regexp_replace(vowel_y, "[aeiou]", "V"), "[^V]", "C")


def _cut(word: Column, n: int) -> Column:
    return F.substring(word, F.lit(1), F.length(word) - n)


def _measured(word: Column, pattern: str) -> Column:
    return letters(word).rlike(pattern)


def _short_syllable(stem: Column) -> Column:
    """Ends consonant-vowel-consonant, the last not w, x or y; or is a vowel and a consonant."""
    return (_measured(stem, "CVC$") & ~stem.rlike("[wxy]$")) | (letters(stem) == "VC")


def _choose(word: Column, cases: list[tuple[Column, Column]]) -> Column:
    """Result of the first case that holds, else the word."""
    first, *rest = cases
    chosen = F.when(*first)
    for case in rest:
        chosen = chosen.when(*case)
    return chosen.otherwise(word)


def _suffixes(word: Column, rules: list[tuple[str, str]], measure: str | None) -> list[tuple[Column, Column]]:
    """Cases that swap a suffix where the stem before it has the measure."""
    cases = []
    for suffix, ending in rules:
        before = _cut(word, len(suffix))
        swapped = F.concat(before, F.lit(ending))
        cases.append((word.endswith(suffix), F.when(_measured(before, measure), swapped).otherwise(word) if measure else swapped))
    return cases


def _plural(w: Column) -> Column:
    return _choose(w, [(w.endswith("ies") & (F.length(w) == 4), _cut(w, 1)), *_suffixes(w, PLURALS, None)])


def _past(w: Column) -> Column:
    bare = F.when(w.endswith("ed") & _measured(_cut(w, 2), "V"), _cut(w, 2)).when(
        w.endswith("ing") & _measured(_cut(w, 3), "V"), _cut(w, 3)
    )
    return _choose(
        w,
        [
            (w.endswith("ied"), F.when(F.length(w) == 4, _cut(w, 1)).otherwise(_cut(w, 2))),
            (w.endswith("eed"), F.when(_measured(_cut(w, 3), POSITIVE), _cut(w, 1)).otherwise(w)),
            (bare.isNotNull(), F.transform(F.array(bare), _mend)[0]),
        ],
    )


def _mend(w: Column) -> Column:
    """Repair of a word that lost -ed or -ing."""
    doubled = w.rlike(r"(.)\1$") & _measured(w, "C$")
    return _choose(
        w,
        [
            (w.rlike("(at|bl|iz)$"), F.concat(w, F.lit("e"))),
            (doubled, F.when(w.rlike("[lsz]$"), w).otherwise(_cut(w, 1))),
            (_measured(w, SINGLE) & _short_syllable(w), F.concat(w, F.lit("e"))),
        ],
    )


def _final_y(w: Column) -> Column:
    ends = w.endswith("y") & (F.length(w) > 2) & _measured(_cut(w, 1), "C$")
    return F.when(ends, F.concat(_cut(w, 1), F.lit("i"))).otherwise(w)


def _alli(w: Column) -> Column:
    """-alli becomes -al, to which the next step applies again."""
    return F.when(w.endswith("alli") & _measured(_cut(w, 4), POSITIVE), _cut(w, 2)).otherwise(w)


def _derived(w: Column) -> Column:
    logi = F.when(_measured(_cut(w, 3), POSITIVE), _cut(w, 1)).otherwise(w)
    return _choose(w, [*_suffixes(w, DERIVED, POSITIVE), (w.endswith("logi"), logi)])


def _quality(w: Column) -> Column:
    return _choose(w, _suffixes(w, QUALITIES, POSITIVE))


def _ending(w: Column) -> Column:
    cases = []
    for suffix in ENDINGS:
        before = _cut(w, len(suffix))
        wide = _measured(before, LONG)
        if suffix == "ion":
            wide = wide & before.rlike("[st]$")
        cases.append((w.endswith(suffix), F.when(wide, before).otherwise(w)))
    return _choose(w, cases)


def _final_e(w: Column) -> Column:
    before = _cut(w, 1)
    drop = _measured(before, LONG) | (_measured(before, SINGLE) & ~_short_syllable(before))
    return F.when(w.endswith("e") & drop, before).otherwise(w)


def _final_l(w: Column) -> Column:
    return F.when(w.endswith("ll") & _measured(_cut(w, 1), LONG), _cut(w, 1)).otherwise(w)


STEPS = [_plural, _past, _final_y, _alli, _derived, _quality, _ending, _final_e, _final_l]


def stem(word: Column) -> Column:
    """Porter stem of a word, lowercased; words of one or two letters stay as they are."""
    stepped = reduce(F.transform, STEPS, F.array(F.lower(word)))[0]
    fixed = F.element_at(F.create_map(*[F.lit(x) for pair in IRREGULAR.items() for x in pair]), F.lower(word))
    return F.coalesce(fixed, F.when(F.length(word) <= 2, F.lower(word)).otherwise(stepped))

"""The stemmer of M. F. Porter, "An algorithm for suffix stripping" (1980), as one column expression.

``paper`` has the author's later amendments (``bli`` and ``logi``). ``extended`` is the variant that natural language
toolkits use by default: short words in -ies and -ied keep their e (``dies`` to ``die``), a final y turns only after a
consonant (``enjoy`` stays), the second table knows ``fulli``, reads ``logi`` with its l and takes up again what
``alli`` leaves, and a few irregular words are listed.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from assayer.functions.binding import bind

# Suffix tables of the paper's steps 2, 3 and 4.
STEP_2 = {
    "ational": "ate", "tional": "tion", "enci": "ence", "anci": "ance", "izer": "ize",
    "bli": "ble", "alli": "al", "entli": "ent", "eli": "e", "ousli": "ous",
    "ization": "ize", "ation": "ate", "ator": "ate", "alism": "al", "iveness": "ive",
    "fulness": "ful", "ousness": "ous", "aliti": "al", "iviti": "ive",
    "biliti": "ble", "logi": "log",
}
STEP_3 = {
    "icate": "ic", "ative": "", "alize": "al", "iciti": "ic", "ical": "ic", "ful": "",
    "ness": "",
}
STEP_4 = [
    "al", "ance", "ence", "er", "ic", "able", "ible", "ant", "ement", "ment", "ent",
    "ion", "ou", "ism", "ate", "iti", "ous", "ive", "ize",
]

# Irregular words of the extended variant.
IRREGULAR = {
    "skies": "sky", "sky": "sky", "dying": "die", "lying": "lie", "tying": "tie", "news": "news",
    "innings": "inning", "inning": "inning", "outings": "outing", "outing": "outing",
    "cannings": "canning", "canning": "canning", "howe": "howe",
    "proceed": "proceed", "exceed": "exceed", "succeed": "succeed",
}

# A leading y is a consonant, elsewhere y is one only after a vowel.
CONSONANTS = "(?:^y|[^aeiouy]|(?<=[aeiou])y)"
VOWELS = "(?:[aeiou]|(?<!^)(?<![aeiou])y)"
HAS_VOWEL = f"{VOWELS}"
MEASURE_OVER_0 = f"{VOWELS}{CONSONANTS}"
MEASURE_OVER_1 = f"{VOWELS}{CONSONANTS}.*{VOWELS}{CONSONANTS}"
SHORT_END = "(?:^y|[^aeiouy])[aeiouy][^aeiouwxy]$"
EXTENDED_SHORT_END = f"{SHORT_END}|^[aeiou][^aeiou]$"  # a vowel and a consonant are short too


def before(word: Column, suffix: str) -> Column:
    return word.substr(F.lit(1), F.length(word) - len(suffix))


def strip_suffix(word: Column, table: dict[str, str], condition) -> Column:
    """The longest matching suffix decides: swapped if its stem meets the condition."""
    longest_first = sorted(table.items(), key=lambda pair: -len(pair[0]))
    chain = F
    for suffix, swap in longest_first:
        stem = before(word, suffix)
        outcome = F.when(condition(suffix, stem), F.concat(stem, F.lit(swap))).otherwise(word)
        chain = chain.when(word.endswith(suffix), outcome)
    return chain.otherwise(word)


def has_measure_over(level: int):
    pattern = MEASURE_OVER_1 if level else MEASURE_OVER_0
    return lambda _suffix, stem: stem.rlike(pattern)


def step_1a(word: Column) -> Column:
    return strip_suffix(word, {"sses": "ss", "ies": "i", "ss": "ss", "s": ""}, lambda *_: F.lit(True))


def after_removal(stem: Column, short_end: str = SHORT_END) -> Column:
    """Tidy a stem that lost ``ed`` or ``ing``."""
    last, previous = F.substring(stem, -1, 1), F.substring(stem, -2, 1)
    double = (F.length(stem) > 1) & (last == previous) & last.rlike("[^aeiouylsz]")
    short = stem.rlike(MEASURE_OVER_0) & ~stem.rlike(MEASURE_OVER_1) & stem.rlike(short_end)
    return (
        F.when(stem.rlike("(?:at|bl|iz)$"), F.concat(stem, F.lit("e")))
        .when(double, before(stem, "x"))
        .when(short, F.concat(stem, F.lit("e")))
        .otherwise(stem)
    )


def step_1b(word: Column, short_end: str = SHORT_END) -> Column:
    def shorten(suffix: str) -> Column:
        return bind(
            before(word, suffix),
            lambda stem: F.when(stem.rlike(HAS_VOWEL), after_removal(stem, short_end)).otherwise(word),
        )

    deep = before(word, "eed").rlike(MEASURE_OVER_0)
    return (
        F.when(word.endswith("eed"), F.when(deep, before(word, "d")).otherwise(word))
        .when(word.endswith("ed"), shorten("ed"))
        .when(word.endswith("ing"), shorten("ing"))
        .otherwise(word)
    )


def step_1c(word: Column) -> Column:
    turns = word.endswith("y") & before(word, "y").rlike(HAS_VOWEL)
    return F.when(turns, F.concat(before(word, "y"), F.lit("i"))).otherwise(word)


def step_4(word: Column) -> Column:
    def droppable(suffix: str, stem: Column) -> Column:
        deep = stem.rlike(MEASURE_OVER_1)
        return deep & stem.rlike("[st]$") if suffix == "ion" else deep

    return strip_suffix(word, dict.fromkeys(STEP_4, ""), droppable)


def step_5a(word: Column, short_end: str = SHORT_END) -> Column:
    stem = before(word, "e")
    drop = stem.rlike(MEASURE_OVER_1) | (stem.rlike(MEASURE_OVER_0) & ~stem.rlike(short_end))
    return F.when(word.endswith("e") & drop, stem).otherwise(word)


def step_5b(word: Column) -> Column:
    return F.when(word.endswith("ll") & word.rlike(MEASURE_OVER_1), before(word, "l")).otherwise(word)


def extended_1a(word: Column) -> Column:
    """A word of four letters in -ies loses its s only."""
    short = word.endswith("ies") & (F.length(word) == 4)
    return F.when(short, before(word, "s")).otherwise(step_1a(word))


def extended_1b(word: Column) -> Column:
    """-ied becomes -ie in a word of four letters and -i in others."""
    cut = F.when(F.length(word) == 4, before(word, "d")).otherwise(before(word, "ed"))
    return F.when(word.endswith("ied"), cut).otherwise(step_1b(word, EXTENDED_SHORT_END))


def extended_1c(word: Column) -> Column:
    """A final y turns after a consonant that is not the word's first letter."""
    stem = before(word, "y")
    turns = word.endswith("y") & (F.length(stem) > 1) & stem.rlike(f"{CONSONANTS}$")
    return F.when(turns, F.concat(stem, F.lit("i"))).otherwise(word)


EXTENDED_2 = {**STEP_2, "fulli": "ful"}


def extended_2(word: Column) -> Column:
    """The second table; what is left of -alli goes through it once more."""

    def deep(suffix: str, stem: Column) -> Column:
        # the l of -logi counts towards the stem
        measured = F.concat(stem, F.lit("l")) if suffix == "logi" else stem
        return measured.rlike(MEASURE_OVER_0)

    once = lambda w: strip_suffix(w, EXTENDED_2, deep)
    left = F.concat(before(word, "alli"), F.lit("al"))
    again = word.endswith("alli") & before(word, "alli").rlike(MEASURE_OVER_0)
    return F.when(again, bind(left, once)).otherwise(once(word))


STEPS = (
    step_1a,
    step_1b,
    step_1c,
    lambda word: strip_suffix(word, STEP_2, has_measure_over(0)),
    lambda word: strip_suffix(word, STEP_3, has_measure_over(0)),
    step_4,
    step_5a,
    step_5b,
)


EXTENDED_STEPS = (
    extended_1a,
    extended_1b,
    extended_1c,
    extended_2,
    STEPS[4],
    step_4,
    lambda word: step_5a(word, EXTENDED_SHORT_END),
    step_5b,
)
VARIANTS = {"paper": STEPS, "extended": EXTENDED_STEPS}


def porter_stem(term: Column, variant: str = "paper") -> Column:
    """Stem of a lower-case word; words of one or two letters stay."""
    if variant not in VARIANTS:
        raise ValueError(f"unknown variant {variant!r}")
    stem = term
    for step in VARIANTS[variant]:
        stem = bind(stem, step)
    kept = F.when(F.length(term) <= 2, term)
    if variant == "extended":
        for word, root in IRREGULAR.items():
            kept = kept.when(term == word, F.lit(root))
    return kept.otherwise(stem)

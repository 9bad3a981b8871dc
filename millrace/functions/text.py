"""Text cleaning and tokenising as regular-expression chains.

Character classes are written out because ``\\w`` is ASCII in Java and the
texts are not English only.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

WORD = r"\p{L}\p{N}_"
# White space as in Unicode texts: no-break, ideographic and other wide blanks too.
SPACE = (
    r" \t-\r\x1c-\x1f\x{85}\x{A0}\x{1680}\x{2000}-\x{200A}"
    r"\x{2028}\x{2029}\x{202F}\x{205F}\x{3000}"
)

# English function words (a public list, without apostrophes,
# as the cleaning below removes them).
ENGLISH_STOP_WORDS = """
i me my myself we our ours ourselves you your yours yourself yourselves he him
his himself she her hers herself it its itself they them their theirs
themselves what which who whom this that these those am is are was were be been
being have has had having do does did doing a an the and but if or because as
until while of at by for with about against between into through during before
after above below to from up down in out on off over under again further then
once here there when where why how all any both each few more most other some
such no nor not only own same so than too very s t can will just don should now
d ll m o re ve y ain aren couldn didn doesn hadn hasn haven isn ma mightn mustn
needn shan shouldn wasn weren won wouldn
""".split()

# Additions used for short social messages.
SOCIAL_STOP_WORDS = [
    "im", "youre", "shoulda", "gotta", "gonna", "dont", "cant", "didnt",
    "doesnt", "http", "https", "com", "twitpiccom2y1zl", "rt", "lol", "d",
]


def _c(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def clean_social(c: Column | str) -> Column:
    """Lower-case, then drop mentions, links and punctuation."""
    c = F.regexp_replace(F.lower(_c(c)), f"@[{WORD}]+", "")
    c = F.regexp_replace(c, f"http[^{SPACE}]+", "")
    return F.regexp_replace(c, f"[^{WORD}{SPACE}]+", "")


def clean_review(c: Column | str) -> Column:
    """Drop links, mentions, hash signs, digits and punctuation, then lower-case."""
    c = F.regexp_replace(_c(c), f"(http|www)[^{SPACE}]+", "")
    c = F.regexp_replace(c, f"@[{WORD}]+", "")
    # Hash signs, decimal digits and punctuation in one pass: all that is kept
    # are letters, other numerals, the underscore and blanks.
    return F.lower(F.regexp_replace(c, f"[^\\p{{L}}\\p{{Nl}}\\p{{No}}_{SPACE}]+", ""))


def collapse_spaces(c: Column | str) -> Column:
    """Two or more blanks become one."""
    return F.regexp_replace(_c(c), f"[{SPACE}]{{2,}}", " ")


def split_words(c: Column | str) -> Column:
    """Pieces between blanks; leading or trailing blanks leave empty pieces."""
    return F.split(_c(c), f"[{SPACE}]+")


def split_word_runs(c: Column | str) -> Column:
    """Runs of word characters; text may start or end with an empty piece."""
    return F.split(_c(c), f"[^{WORD}]+")


def drop_short_and_stop(tokens: Column, stop_words: list[str], min_length: int = 3) -> Column:
    """Keep the tokens that are long enough and no stop word.

    The list is a literal in the plan, hence for lists a person writes; a stop
    word table of any size goes through an anti join instead.
    """
    stop = sorted(w for w in set(stop_words) if len(w) >= min_length)
    return F.filter(tokens, lambda w: (F.char_length(w) >= min_length) & ~w.isin(stop))


def first_number(c: Column | str) -> Column:
    """First run of digits in a text, null when there is none."""
    return F.regexp_extract(_c(c), r"[0-9]+", 0).try_cast("bigint")

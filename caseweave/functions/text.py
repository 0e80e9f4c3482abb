"""Column expressions for text cleaning; all stay inside the JVM."""

from __future__ import annotations

import re
from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F

from caseweave import fixed_values as fv

# Java's \s, \b, $ and . differ from the usual linear-time dialects, so the
# classes are spelled out: ASCII white space, ASCII word start, end of text.
_SPACE = r"[\t\n\f\r ]"
_WORD_START = r"(?<![A-Za-z0-9_])"
_TO_END = r"[^\n]*\z"

# Two Unicode non-characters: they cannot occur in exchanged text.
_MARK = "\ufffe\uffff"


def trim_unicode(text: Column) -> Column:
    """Trim every Unicode white-space character, not only blanks."""
    return F.trim(text, F.lit(fv.UNICODE_SPACES))


def is_present(text: Column) -> Column:
    """True when the text is neither null nor blank; never null."""
    return text.isNotNull() & (trim_unicode(text) != "")


def _any_case(word: str) -> str:
    """A word for use under ``(?i)``, with the two letters that fold to ASCII."""
    return re.escape(word).replace("s", "[s\u017f]").replace("k", "[k\u212a]")


def boilerplate_pattern(phrases=fv.BOILERPLATE_PHRASES) -> str:
    """One alternation for all phrases: the text is scanned once, not per phrase."""
    parts = []
    for phrase, starts_word in phrases:
        words = [_any_case(w) for w in phrase.split(" ")]
        parts.append(
            _WORD_START + (_SPACE + "+").join(words) if starts_word else " ".join(words)
        )
    return "(?i)(?:" + "|".join(parts) + ")" + _TO_END


def may_have_boilerplate(text: Column, phrases=fv.BOILERPLATE_PHRASES) -> Column:
    """Cheap necessary condition: the longest sure piece of some phrase occurs.

    Pieces avoid ``s`` and ``k``, which other characters fold to.
    """
    lowered = F.lower(text)
    pieces = [max(re.split("[sk ]", phrase), key=len) for phrase, _ in phrases]
    return reduce(Column.__or__, [F.contains(lowered, F.lit(piece)) for piece in pieces])


def strip_boilerplate(text: Column, phrases=fv.BOILERPLATE_PHRASES) -> Column:
    return F.regexp_replace(text, boilerplate_pattern(phrases), "")


def flatten_spaces(text: Column) -> Column:
    """Turn ``_`` and ``-`` into blanks, collapse white space, trim."""
    blanks = F.replace(F.replace(text, F.lit("_"), F.lit(" ")), F.lit("-"), F.lit(" "))
    return trim_unicode(F.regexp_replace(blanks, _SPACE + "+", " "))


def title_case(text: Column, delimiters: str = fv.TITLE_DELIMITERS) -> Column:
    """Upper-case each letter that follows a delimiter, lower-case the rest.

    ``initcap`` only knows blanks, so a marked blank is put after every other
    delimiter, unless a blank follows anyway, and taken out again afterwards.
    """
    others = "[" + re.sub(r"([\[\]\\^\-&])", r"\\\1", delimiters.replace(" ", "")) + "]"
    marked = F.regexp_replace(text, "(" + others + ")(?=[^ ])", "$1" + _MARK + " ")
    return F.replace(F.initcap(marked), F.lit(_MARK + " "), F.lit(""))


def weak_pattern(min_length=fv.MIN_TEXT_LENGTH, stop=fv.STOP_TEXTS) -> str:
    """Whole texts that are too short or a stop text once flattened.

    A run of blanks counts as one character and outer white space as none, so
    the pattern reads the text as it stands and gives up after a few characters.
    Runs are possessive: none of them is ever given back, so a text of nothing
    but separators is read once.
    """
    blank = r"[\t\n\f\r _\-]"
    outer = "[_\\-" + fv.UNICODE_SPACES + "]*+"
    short = f"(?:{blank}++|[^\t\n\f\r _\\-]){{0,{min_length - 1}}}"
    words = [
        (blank + "++").join(
            re.escape(part).replace("k", "[k\u212a]") for part in re.split("[ _-]+", word)
        )
        for word in stop
    ]
    return r"(?i)\A" + outer + "(?:" + "|".join([short, *words]) + ")" + outer + r"\z"


def is_weak(text: Column, min_length=fv.MIN_TEXT_LENGTH, stop=fv.STOP_TEXTS) -> Column:
    """True for null, empty, too short and stop texts, raw or flattened; never null.

    The text occurs once in the expression, so pushing it into a filter does
    not multiply the work.
    """
    return F.coalesce(text.rlike(weak_pattern(min_length, stop)), F.lit(True))


def as_sentence(flat_text: Column) -> Column:
    """Title case with final punctuation.  Expects trimmed text."""
    titled = title_case(flat_text)
    ended = F.right(flat_text, F.lit(1)).isin(".", "!", "?")
    return F.when(ended, titled).otherwise(F.concat(titled, F.lit(".")))


def is_image_url(url: Column, extensions=fv.IMAGE_EXTENSIONS) -> Column:
    """Image extension at the end of the URL or just before ``?`` or ``#``."""
    ext = "|".join(extensions)
    return F.lower(url).rlike(rf"\.({ext})(?:\z|[?#])")


def first_group(text: Column, pattern: str) -> Column:
    """First capture group, null when the pattern does not occur."""
    return F.nullif(F.regexp_extract(text, pattern, 1), F.lit(""))


def first_word(text: Column) -> Column:
    return F.substring_index(text, " ", 1)


def fill(template: str, **columns: Column) -> Column:
    """Fill a ``{name}`` template; null if any filled column is null."""
    parts, at = [], 0
    for slot in re.finditer(r"\{\{|\}\}|\{(\w+)\}", template):
        if slot.start() > at:
            parts.append(F.lit(template[at:slot.start()]))
        name = slot.group(1)
        parts.append(columns[name] if name else F.lit(slot.group(0)[0]))
        at = slot.end()
    if at < len(template):
        parts.append(F.lit(template[at:]))
    return F.concat(*parts)


def tokens(text: Column) -> Column:
    """Lower-case words and numbers of the whole text."""
    return F.regexp_extract_all(F.lower(text), F.lit(r"[\p{L}\p{N}]+"), F.lit(0))


def same_ignoring_case(left: Column, right: Column) -> Column:
    """Equality without case, as the collation UTF8_LCASE has it; null if either side is.

    Strings are equal if their lower-case forms are, letter by letter: the Kelvin sign is a
    k, every sigma is the same wherever it stands, and the Turkish dotted capital I is
    an i followed by a combining dot.  Nothing is folded further, so ß is not ss.

    Both sides are plain strings, because Spark joins collated ones by sorting only:
    a small table of labels could not be broadcast.
    """
    return _without_case(left) == _without_case(right)


def _without_case(text: Column) -> Column:
    return F.translate(F.lower(text), "ς", "σ")

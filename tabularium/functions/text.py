"""Text columns: comment cleaning, page text, tokens."""

from __future__ import annotations

import re
from html.entities import name2codepoint

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F

# What a cleaned comment loses (mentions, links, runs of other characters), with
# white space spelled out so that every regex engine agrees on it.
NOT_SPACE = r"[^\s\x1c-\x1f\x{85}\p{Z}]"
COMMENT_NOISE = rf"@{NOT_SPACE}+|https?:{NOT_SPACE}+|http?:{NOT_SPACE}|[^A-Za-z0-9]+"

# The same for Python, on lower-case text; its classes are spelled out.
_VISIBLE = "[^\\t-\\r \\x1c-\\x1f\\x85\\xa0\\u1680\\u2000-\\u200a\\u2028\\u2029\\u202f\\u205f\\u3000]"
_NOISE = f"@{_VISIBLE}+|https?:{_VISIBLE}+|http?:{_VISIBLE}|[^a-z0-9]+"

# English stop words.
STOP_WORDS = (
    "i me my myself we our ours ourselves you you're you've you'll you'd your yours yourself "
    "yourselves he him his himself she she's her hers herself it it's its itself they them their "
    "theirs themselves what which who whom this that that'll these those am is are was were be "
    "been being have has had having do does did doing a an the and but if or because as until "
    "while of at by for with about against between into through during before after above below "
    "to from up down in out on off over under again further then once here there when where why "
    "how all any both each few more most other some such no nor not only own same so than too "
    "very s t can will just don don't should should've now d ll m o re ve y ain aren aren't "
    "couldn couldn't didn didn't doesn doesn't hadn hadn't hasn hasn't haven haven't isn isn't ma "
    "mightn mightn't mustn mustn't needn needn't shan shan't shouldn shouldn't wasn wasn't weren "
    "weren't won won't wouldn wouldn't"
).split()

# Label names and the decision threshold.
TROLL, NO_TROLL, UNDEFINED = "TROLL", "NO_TROLL", "undefined"
THRESHOLD = 0.5

# Punctuation that a token loses when asked for.
PUNCTUATION = """,.;)(:"'"""

SPACES = r"[\s\x1c-\x1f\x{85}\p{Z}]+"
HIDDEN = (
    r"(?is)<!--.*?-->|<script\b[^>]*>.*?(?:</script\s*>|\z)|<style\b[^>]*>.*?(?:</style\s*>|\z)"
)
TAGS = (
    r"""(?s)<[/!?]?[A-Za-z][^>"']*(?:"[^"]*"[^>"']*|'[^']*'[^>"']*)*>|<[/!?]?[A-Za-z][^>]*>"""
)


def _col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def _without_noise(text: str, noise: re.Pattern = re.compile(_NOISE), word: re.Pattern = re.compile("[a-z0-9]+")) -> list[str]:
    text = text.lower()
    if "@" in text or "htt" in text:  # mentions and links take more than the run of characters they begin with
        return noise.sub(" ", text).split()
    return word.findall(text)


def clean_text(text: Column | str, stop_words: list[str] | None = None) -> Column:
    """Lower-case alphanumeric words without mentions, links and stop words, joined by spaces.

    Texts are cleaned in Arrow batches: Spark's own regex functions take some eight times the CPU.
    """
    left_out = frozenset(STOP_WORDS if stop_words is None else stop_words)

    @F.pandas_udf("string")
    def cleaned(texts: pd.Series) -> pd.Series:
        words = lambda t: [w for w in _without_noise(t.decode("utf-8", "replace")) if w not in left_out]
        return pd.Series([None if t is None else " ".join(words(t)) for t in texts], dtype=object)

    return cleaned(_col(text).cast("binary"))


def clean_tokens(text: Column | str, stop_words: list[str] | None = None) -> Column:
    """The words of ``clean_text`` as an array."""
    return F.filter(F.split(clean_text(text, stop_words), " "), lambda t: t != "")


def label_name(flag: Column | str) -> Column:
    """``"1"`` -> TROLL, anything else NO_TROLL."""
    return F.when(_col(flag).try_cast("int") == 1, F.lit(TROLL)).otherwise(F.lit(NO_TROLL))


def label_of_score(score: Column | str, threshold: float = THRESHOLD) -> Column:
    return F.when(_col(score) < threshold, F.lit(NO_TROLL)).otherwise(F.lit(TROLL))


def training_line(text: Column | str, label: Column | str) -> Column:
    return F.concat(_col(text), F.lit(", "), _col(label))


def quoted_line(text: Column | str) -> Column:
    return F.concat(F.lit('"'), _col(text), F.lit('"'))


def _code_point(number: Column) -> Column:
    """Character of a code point; NULL outside the valid range."""
    valid = (number > 0) & (number < 0x110000) & ~number.between(0xD800, 0xDFFF)
    return F.when(valid, F.decode(F.unhex(F.lpad(F.hex(number), 8, "0")), "UTF-32"))


def unescape(text: Column | str) -> Column:
    """Named and numeric character references -> characters, in one left-to-right pass."""
    named = F.create_map(
        *[F.lit(v) for name, code in name2codepoint.items() for v in (name, chr(code))]
    )

    def piece(p: Column) -> Column:
        decimal = F.regexp_extract(p, "^#([0-9]{1,7});?", 1)
        hexa = F.regexp_extract(p, "^#[xX]([0-9A-Fa-f]{1,6});?", 1)
        name = F.regexp_extract(p, "^([A-Za-z][A-Za-z0-9]*);", 1)
        decoded = (
            F.when(decimal != "", _code_point(decimal.try_cast("long")))
            .when(hexa != "", _code_point(F.conv(hexa, 16, 10).cast("long")))
            .when(name != "", F.try_element_at(named, name))
        )
        rest = F.regexp_replace(p, "^(?:#[0-9]{1,7};?|#[xX][0-9A-Fa-f]{1,6};?|[A-Za-z][A-Za-z0-9]*;)", "")
        return F.when(decoded.isNull(), F.concat(F.lit("&"), p)).otherwise(F.concat(decoded, rest))

    parts = F.split(_col(text), "&", -1)
    tail = F.transform(F.slice(parts, 2, F.greatest(F.size(parts) - 1, F.lit(0))), piece)
    return F.concat(parts[0], F.array_join(tail, ""))


def html_text(html: Column | str) -> Column:
    """Visible text of a page: no scripts, styles, comments or tags; white space collapsed."""
    plain = F.regexp_replace(F.regexp_replace(_col(html), HIDDEN, ""), TAGS, "")
    return F.regexp_replace(unescape(plain), SPACES, " ")


def tokens(text: Column | str, strip_punct: bool = False) -> Column:
    """Lower-case pieces between single spaces; punctuation stays unless ``strip_punct``."""
    t = _col(text)
    if strip_punct:
        t = F.translate(t, PUNCTUATION, "")
    return F.split(F.lower(t), " ", -1)


def token_set(text: Column | str, strip_punct: bool = False) -> Column:
    return F.array_distinct(tokens(text, strip_punct))

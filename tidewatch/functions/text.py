"""Text expressions: cleaning, redaction, normalisation, links."""

from __future__ import annotations

from collections.abc import Callable, Iterable, Mapping, Sequence
from functools import reduce
from operator import or_

from pyspark.sql import Column
from pyspark.sql import functions as F

from tidewatch import fixed_values as V

# White space as text tools outside the JVM see it (Unicode, not only ASCII).
SPACE = r"\s\x0B\x1C-\x1F\x85\p{Z}"
# A position after which no further word character comes.
WORD_END = r"(?![\p{L}\p{N}_])"


def _col(value) -> Column:
    return F.col(value) if isinstance(value, str) else value


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body(value)`` with the value computed once, however often it is used."""
    return F.get(F.transform(F.array(value), lambda v: body(v)), F.lit(0))


def contains_any(text: Column, words: Iterable[str]) -> Column:
    """Any word is a substring: byte searches, far cheaper than one alternation."""
    return reduce(or_, [F.contains(text, F.lit(w)) for w in words])


def clean_text(text) -> Column:
    """Drop ``<...>`` tags (never across a line end), squeeze white space, trim."""
    no_tags = F.regexp_replace(_col(text), r"<[^>\n]*>", "")
    return F.trim(F.regexp_replace(no_tags, f"[{SPACE}]+", " "))


_TOKEN = f"[^{SPACE}]"
_REDACTED = (
    rf"https?://{_TOKEN}+|www\.{_TOKEN}+|(?<!{_TOKEN}){_TOKEN}+\.(?:{'|'.join(V.REDACTED_TLDS)}){WORD_END}"
)
_REDACTED_MARKS = ("http", "www.", *[f".{tld}" for tld in V.REDACTED_TLDS])


def redact_links(text) -> Column:
    """Replace links by a marker.

    Texts without any part of a link skip the pattern, which is nearly all of
    them. A bare domain can only start a token, which the look-behind states:
    one attempt per token instead of one per character, so long tokens stay
    linear.
    """
    text = _col(text)
    redacted = F.regexp_replace(text, _REDACTED, V.LINK_REMOVED)
    return F.when(contains_any(text, _REDACTED_MARKS), redacted).otherwise(text)


def has_link(text) -> Column:
    """1 if the text holds anything that ``redact_links`` would replace."""
    text = _col(text)
    return F.when(contains_any(text, _REDACTED_MARKS) & text.rlike(_REDACTED), 1).otherwise(0)


def words(text) -> Column:
    """White-space separated words without empty ones."""
    return F.filter(F.split(_col(text), f"[{SPACE}]+"), lambda w: w != "")


def word_count(text) -> Column:
    return F.size(words(text))


NO_TOKEN = r"[^\p{L}\p{N}]+"


def lower_tokens(text) -> Column:
    """Lower-case runs of letters and digits, in text order."""
    return F.filter(F.split(F.lower(_col(text)), NO_TOKEN), lambda w: w != "")


# ASCII characters that are neither letters nor white space.
ASCII_OTHERS = "".join(chr(c) for c in range(128) if not chr(c).isalpha() and not chr(c).isspace())


def normalize(text, mapping: Mapping[str, str] = V.LEET_MAP) -> Column:
    """Lower-case, undo substitutions, keep only ``a-z`` and white space.

    One translation substitutes and drops all ASCII at once. Only a text that
    still has other characters goes through the pattern.
    """
    dropped = "".join(c for c in ASCII_OTHERS if c not in mapping)
    ascii_done = F.translate(
        F.lower(_col(text)), "".join(mapping) + dropped, "".join(mapping.values())
    )

    def finish(t: Column) -> Column:
        is_ascii = F.octet_length(t) == F.char_length(t)
        return F.when(is_ascii, t).otherwise(F.regexp_replace(t, f"[^a-z{SPACE}]", ""))

    return let(ascii_done, finish)


def squeeze(normalized) -> Column:
    """Normalised text without blanks (tabs and line ends stay)."""
    return F.replace(_col(normalized), F.lit(" "), F.lit(""))


def token_hit(normalized, word_list: Sequence[str]) -> Column:
    """A whole word of the normalised text is on the list."""
    listed = F.array(*[F.lit(w) for w in word_list])
    return F.arrays_overlap(words(normalized), listed)


def keyword_hit(normalized, squeezed, word_list: Sequence[str], mode: str = "substring") -> Column:
    """Word check on normalised text and its squeezed form.

    ``substring``: token hit or substring of the squeezed text. A token never
    holds a blank, so it survives the squeezing and the substring test alone
    decides. ``token``: whole words only, list entries squeezed likewise.
    """
    if mode == "token":
        return token_hit(normalized, [w.replace(" ", "") for w in word_list])
    return let(_col(squeezed), lambda t: contains_any(t, word_list))


def phrase_hit(text, phrases: Sequence[str] = V.SPAM_PHRASES) -> Column:
    """Any phrase occurs in the lower-cased text."""
    return let(F.lower(_col(text)), lambda t: contains_any(t, phrases))


# A link without scheme ends its host in a country's two letters or one of these.
LINK_TLDS = tuple(
    "com org net edu gov mil int info biz name pro mobi aero coop museum jobs travel asia app dev xyz online site shop"
    " store tech club top live link click icu vip blog news cloud space fun art design agency email world today life"
    " media social network digital work games chat wiki page zone host press win bid loan download stream review date"
    " men party trade science cam bar bet casino porn xxx adult sexy dating test".split()
)
ANY_ENDING = ("[a-z]{2,24}",)


def url_pattern(endings: Sequence[str] = LINK_TLDS) -> str:
    """``endings``: patterns of top-level domains beside those of two letters."""
    return (
        r"(?i)(?:^|[^A-Za-z0-9.@/_-])"
        r"((?:https?://|www\.)[^\s<>\"']+"
        r"|(?:[A-Za-z0-9-]+\.)+(?:[a-z]{2}|" + "|".join(endings) + r")\b(?:[/?#:][^\s<>\"']*)?)"
    )


URL_TAIL = r"[\s.,;:!?()\[\]{}<>\"'|]+$"


def possible_urls(text) -> Column:
    """A cheap test that every text with a link passes."""
    return _col(text).rlike(r"\.[^\s.]|://")


def extract_urls(text, endings: Sequence[str] = LINK_TLDS) -> Column:
    """Links of a text in order: with scheme, ``www.`` or an ending.

    Two letters are always an ending; ``ANY_ENDING`` takes every word for one.

    Texts that cannot hold a link skip the pattern.
    """
    text = _col(text)
    found = F.regexp_extract_all(text, F.lit(url_pattern(endings)), F.lit(1))
    links = F.transform(found, lambda u: F.regexp_replace(u, URL_TAIL, ""))
    return F.when(possible_urls(text), links).when(text.isNotNull(), F.array().cast("array<string>"))


def url_host(url) -> Column:
    """Authority part, lower-case, one leading ``www.`` dropped; else empty."""
    authority = F.regexp_extract(_col(url), r"^(?:[A-Za-z][A-Za-z0-9+.-]*:)?//([^/?#]*)", 1)
    return F.regexp_replace(F.lower(F.coalesce(authority, F.lit(""))), r"^www\.", "")


def is_trusted(url, domains: Sequence[str] = V.TRUSTED_DOMAINS) -> Column:
    return url_host(url).isin(*domains) if domains else F.lit(False)


def normalize_domain(text) -> Column:
    """A domain as a moderator types it, brought to host form."""
    bare = F.regexp_replace(F.lower(_col(text)), f"^[{SPACE}]+|[{SPACE}]+$", "")
    for scheme in ("https://", "http://"):
        bare = F.replace(bare, F.lit(scheme), F.lit(""))
    return F.regexp_replace(F.substring_index(bare, "/", 1), r"^www\.", "")

"""Literal cases of the text expressions."""

import re

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from tidewatch.functions import text as T
from tidewatch.operators import chat

WORDS = ("ass", "asshat", "dumb", "dum", "stupid", "idiot")


def values(spark, build, texts):
    rows = spark.createDataFrame(list(enumerate(texts)), "i int, t string")
    return [r.v for r in rows.select("i", build(F.col("t")).alias("v")).orderBy("i").collect()]


@pytest.mark.parametrize(
    "text, normalized, token, squeezed",
    [
        ("y o u  a r e  a s s", "y o u  a r e  a s s", False, True),
        ("you...4ss!!!", "youassiii", False, True),
        ("The bit of the drill broke.", "the bit of the drill broke", False, False),
        ("I have a pain in my ass/butt.", "i haue a pain in my assbutt", False, True),
        ("This class is great", "this class is great", False, True),
        ("dvmb", "dumb", True, True),
        ("line one\nstupid", "line one\nstupid", True, True),
        ("1d10t", "idiot", True, True),
    ],
)
def test_keyword_check(spark, text, normalized, token, squeezed):
    row = chat.keyword_hits(spark.createDataFrame([(text,)], "text string"), WORDS).first()
    assert (row.normalized, row.token_hit, row.squeezed_hit, row.hit) == (
        normalized,
        token,
        squeezed,
        token or squeezed,
    )


def test_token_mode(spark):
    hit = lambda t: T.keyword_hit(T.normalize(t), None, ("ass", "kill yourself"), "token")
    assert values(spark, hit, ["This class", "you ass", "killyourself"]) == [False, True, True]


def test_clean_text(spark):
    cases = {
        "a <b>x</b>\n\n c ": "a x c",
        "x<a\ny>z": "x<a y>z",
        "a  b": "a b",
        "no < tag > here": "no here",
        "": "",
    }
    assert values(spark, T.clean_text, list(cases)) == list(cases.values())


LINKS = {
    "see https://a.b/c and foo.com now": "see [LINK REMOVED] and [LINK REMOVED] now",
    "foo.community": "foo.community",
    "mail me@x.org": "mail [LINK REMOVED]",
    "(http://x.com/path) www.y": "[LINK REMOVED]/path) [LINK REMOVED]",
    "a.com.b.org/x http:/no .com": "[LINK REMOVED]/x http:/no .com",
}


def test_redact_links(spark):
    assert values(spark, T.redact_links, list(LINKS)) == list(LINKS.values())


def test_redact_links_is_the_plain_pattern(spark):
    """The guarded, anchored form gives what the unanchored pattern gives."""
    plain = re.compile(r"https?://\S+|www\.\S+|\S+\.(com|org|net|gov|edu|co)\b")
    pieces = st.sampled_from(
        ["http://", "https://", "www.", ".com", ".org", ".co", "co", "a", "b1", "_", " ", "\n", ".", "/", "(", "é"]
    )
    texts = st.lists(st.lists(pieces, max_size=12).map("".join), min_size=30, max_size=60)

    @settings(max_examples=8, deadline=None)
    @given(texts)
    def check(batch):
        want = [plain.sub("[LINK REMOVED]", t) for t in batch]
        assert values(spark, T.redact_links, batch) == want

    check()


@pytest.mark.parametrize(
    "url, host",
    [
        ("https://www.youtube.com/x", "youtube.com"),
        ("HTTPS://YouTube.com/", "youtube.com"),
        ("youtube.com/x", ""),
        ("https://youtube.com:443/x", "youtube.com:443"),
        ("https://m.youtube.com", "m.youtube.com"),
        ("https://youtube.com?q=1", "youtube.com"),
        ("//tenor.com/a b", "tenor.com"),
    ],
)
def test_url_host(spark, url, host):
    assert values(spark, T.url_host, [url]) == [host]


def test_untrusted_urls_keeps_unparsable(spark):
    urls = spark.createDataFrame([("https://www.youtube.com/x",), ("youtube.com/x",), ("https://e.vil",)], "url string")
    expected = {"youtube.com/x", "https://e.vil"}
    assert {r.url for r in chat.untrusted_urls(urls).collect()} == expected
    domains = spark.createDataFrame([("youtube.com",)], "domain string")
    assert {r.url for r in chat.untrusted_urls(urls, "url", domains).collect()} == expected


def test_extract_urls(spark):
    text = "go to https://a.b/c?d=1, or www.x.y! also foo.com/p (bar.org). not me@x.org nor end.Next"
    assert values(spark, T.extract_urls, [text, "nothing here", None]) == [
        ["https://a.b/c?d=1", "www.x.y", "foo.com/p", "bar.org"],
        [],
        None,
    ]


def test_links_by_their_ending(spark):
    text = "see spam.xyz/a and b.app or x.ai; at.Home end.Next"
    assert values(spark, T.extract_urls, [text]) == [["spam.xyz/a", "b.app", "x.ai"]]
    every = values(spark, lambda t: T.extract_urls(t, T.ANY_ENDING), [text])
    assert every == [["spam.xyz/a", "b.app", "x.ai", "at.Home", "end.Next"]]


def test_domains(spark):
    typed = [" HTTPS://www.GitHub.com/x/y ", "http://a.b", "c.d/e", "\twww.f.g\n"]
    assert values(spark, T.normalize_domain, typed) == ["github.com", "a.b", "c.d", "f.g"]
    allow = spark.createDataFrame([("a.b",)], "domain string")
    more = spark.createDataFrame([(t,) for t in typed] + [("  ",)], "domain string")
    got = sorted(r.domain for r in chat.add_domain(allow, more).collect())
    assert got == ["a.b", "c.d", "f.g", "github.com"]


def test_words_and_links_flag(spark):
    assert values(spark, T.word_count, ["a  b c", " ", ""]) == [3, 0, 0]
    assert values(spark, T.has_link, ["x foo.com", "x foo"]) == [1, 0]


def test_phrases(spark):
    assert values(spark, T.phrase_hit, ["Get FREE Nitro now", "free  nitro"]) == [True, False]


def test_normalize_is_the_plain_rule(spark):
    """The two-step form equals: lower, substitute, drop all but a-z and space."""
    from tidewatch.fixed_values import LEET_MAP

    def plain(text):
        return re.sub(r"[^a-z\s]", "", "".join(LEET_MAP.get(c, c) for c in text.lower()))

    alphabet = "".join(map(chr, range(1, 128))) + "éßÄñ\x85\xa0   　€中😀"
    texts = st.lists(st.text(alphabet, max_size=25), min_size=30, max_size=60)

    @settings(max_examples=8, deadline=None)
    @given(texts)
    def check(batch):
        assert values(spark, T.normalize, batch) == [plain(t) for t in batch]
        assert values(spark, T.word_count, batch) == [len(t.split()) for t in batch]
        cleaned = [re.sub(r"\s+", " ", re.sub(r"<.*?>", "", t)).strip() for t in batch]
        assert values(spark, T.clean_text, batch) == cleaned

    check()

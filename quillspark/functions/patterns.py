"""Regular expressions with explicit Unicode classes, valid in Java and in RE2."""

WS = r"[\x{9}-\x{d}\x{1c}-\x{20}\x{85}\x{a0}\x{1680}\x{2000}-\x{200a}\x{2028}\x{2029}\x{202f}\x{205f}\x{3000}]"
NOT_WS = WS.replace("[", "[^", 1)
LINE_BREAK = r"\r\n|[\n-\r\x{1c}-\x{1e}\x{85}\x{2028}\x{2029}]"
_W = r"[\p{L}\p{N}_]"

# Rules of the curation step.
DEICTIC_WORDS = "das hier|dies|hier|was das|was das hier"
MAPS_URL = r"google\.(de|com)/maps"
MAPS_BOILER = rf"find local businesses|view maps|driving directions|google maps|postleitzahl{WS}*\|{WS}*quelle"
URL_ISH = rf"https?://|www\.|utm_|\.{_W}{{2,3}}/|\?"
GENERIC_PORTAL = rf"startseite|home{WS}*[-|]|index{WS}*[-|]|navigation|javascript is not available|reddit{WS}*-{WS}*the heart|cookie{WS}*(policy|settings|hinweis)"
BRAND_HOSTS = (
    "spiegel.de zeit.de tagesschau.de sueddeutsche.de derstandard.at heise.de golem.de faz.net bild.de theguardian.com nytimes.com washingtonpost.com bbc.co.uk reuters.com twitter.com youtube.com github.com"
).split()
NUMBER_UNIT = rf"CVE-|\p{{Nd}}+{WS}*(€|%|km|GB|MB|TB|°C|Mrd|Mio)"
SEPARATORS = "[|•–—]"
QUOTE_SIGNS = "[\"'„“:]"

# Labels of the audit, in the order in which they are tried; the flag says whether case is ignored.
AUDIT_LABELS = [
    ("javascript-placeholder", True, "javascript is not available"),
    ("wikipedia-title", True, "wikipedia"),
    ("maps-link", True, rf"google\.{NOT_WS}+/maps|(^|[^\p{{L}}\p{{N}}_])maps?([^\p{{L}}\p{{N}}_]|$)"),
    ("postal-code-lead", False, r"^\p{Nd}{5}([^\p{L}\p{N}_]|$)"),
    ("very-short-topic", False, "^.{0,18}$"),
    ("quoted-fragment", False, "^[\"'].+[\"']$"),
    ("generic-page-title", True, "^(home|startseite|index|news|artikel)$"),
    ("url-ish", True, r"https?://|www\.|utm_"),
]


def java(pattern: str, ignore_case: bool = False) -> str:
    """The pattern for Java, where ignoring case must be asked for Unicode."""
    return ("(?iu)" if ignore_case else "") + pattern


def whole_words(words: str) -> str:
    """Any of the words with a boundary on both sides, without look-around."""
    return rf"(^|[^\p{{L}}\p{{N}}_])({words})([^\p{{L}}\p{{N}}_]|$)"

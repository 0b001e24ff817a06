"""Word lists, patterns and formats that results depend on.

Patterns are in Java's dialect.  ``(?U)`` gives ``\\s \\w \\d`` their Unicode
meaning.  Where a pattern says more than "find this", the note beside it
explains what keeps it linear on long texts or safe from deep recursion.
"""

# Characters that count as blank: white space plus the four separators
# U+001C to U+001F.
BLANKS = (
    "\t\n\x0b\x0c\r\x1c\x1d\x1e\x1f \x85\xa0\u1680"
    "\u2000\u2001\u2002\u2003\u2004\u2005\u2006\u2007\u2008\u2009\u200a"
    "\u2028\u2029\u202f\u205f\u3000"
)
BLANK = r"[\s\x1c-\x1f]"
NOT_BLANK = r"[^\s\x1c-\x1f]"
BLANK_RUN = rf"(?U){BLANK}+"

# Numbers as text: digits with single underscores between them, fraction,
# exponent, and the words for infinity and not-a-number.
NUMBER = (
    r"(?i)[+-]?(?:(?:\d+(?:_\d+)*\.?(?:\d+(?:_\d+)*)?|\.\d+(?:_\d+)*)"
    r"(?:e[+-]?\d+(?:_\d+)*)?|inf(?:inity)?|nan)"
)

# Text cleaning.
EXCESS_NEWLINES = r"\n{3,}"
BLANK_STRETCH = r"[ \t][ \t]+|\t"  # a single space would be replaced by itself
BLANKS_AROUND_NEWLINE = r" \n ?|\n "  # blank stretches are single spaces by then
HTML_TAG = r"<[^>]+>"
URL_TO_MASK = rf"(?U)https?://{NOT_BLANK}+"
# A masked address is a whole run of non-blanks, so only run starts are tried.
EMAIL_TO_MASK = rf"(?U)(?<!{NOT_BLANK}){NOT_BLANK}+@{NOT_BLANK}+\.{NOT_BLANK}+"
CONTROL_CHARACTERS = r"[\x00-\x08\x0b\x0c\x0e-\x1f\x7f-\x9f]"
URL_MASK = "[URL]"
EMAIL_MASK = "[EMAIL]"
FOLDED_CHARACTERS = {
    "\u2018": "'",
    "\u2019": "'",
    "\u201c": '"',
    "\u201d": '"',
    "\u2013": "-",
    "\u2026": "...",
    "\xa0": " ",
}

# Markdown cleaning.
NAVIGATION_PHRASE = r"(Skip to (main )?content|Jump to|Table of [Cc]ontents)\n?"
COOKIE_BANNER = r"(?iu)(We use cookies|Accept all|Cookie policy)[^\n]*\n"
LONG_RULE = r"[-=]{5,}"
SHORT_RULE = "---"
EMPTY_HEADER = rf"(?dmU)^#{{1,6}}{BLANK}*$"
HEADER_AFTER_BLANK_LINES = r"\n{2,}(#{1,6})"
PARAGRAPH_BREAK = "\n\n"

# Entities.  The leading look-behind skips starts inside a run whose first
# character already failed; ``\G`` admits the end of the previous match.
EMAIL = r"(?:(?<![a-zA-Z0-9._%+-])|\G)[a-zA-Z0-9._%+-]+@[a-zA-Z0-9.-]+\.[a-zA-Z]{2,}"
PHONE_US = r"(?U)\+?1?[-.\s]?\(?\d{3}\)?[-.\s]?\d{3}[-.\s]?\d{4}"
PHONE_INTERNATIONAL = r"(?U)\+\d{1,3}[-.\s]?\d{3,4}[-.\s]?\d{3,4}[-.\s]?\d{3,4}"
# A phone number lies inside one run of these characters, at least this long.
NOT_IN_PHONE = r"(?U)[^-+.()\s\d]+"
SHORTEST_PHONE = 10
# One host unit is enough: the tail class holds every further host character.
URL = r"(?U)https?://(?:[-\w.]|%[\da-fA-F]{2})[/\w\-._~:/?#\[\]@!$&'()*+,;=%]*"
# What every date but the slashed ones contains.
FOUR_DIGITS = r"(?U)\d{4}"
DATE_ISO = r"(?U)\d{4}-\d{2}-\d{2}"
DATE_SLASHED = r"(?U)\d{1,2}/\d{1,2}/\d{2,4}"
DATE_MONTH_FIRST = (
    r"(?U)(?iu)(?=[jfmasond])\b(?:Jan|Feb|Mar|Apr|May|Jun|Jul|Aug|Sep|Oct|Nov|Dec)[a-z]*\s+\d{1,2},?\s+\d{4}\b"
)
DATE_DAY_FIRST = (
    r"(?U)(?iu)\d{1,2}\s+(?:Jan|Feb|Mar|Apr|May|Jun|Jul|Aug|Sep|Oct|Nov|Dec)[a-z]*\s+\d{4}"
)
# The signs stand apart from the digits: each sign is also the word that a text is searched for before its pattern runs.
MONEY_PREFIXES = {"$": "USD", "€": "EUR", "£": "GBP"}
MONEY_AFTER_PREFIX = r"[\d,]+(?:\.\d{2})?"
MONEY_CODES = ["USD", "EUR", "GBP", "INR"]
# A look-ahead for the first character spares the look-behind at all others.
MONEY_BEFORE_CODE = r"(?U)(?=[\d,])(?<![\d,])[\d,]+(?:\.\d{2})?\s*(?:USD|EUR|GBP|INR)"
# The possessive repeat is a loop in Java; the plain one recurses per word.
NAME = r"(?U)(?=[A-Z])(?<=[.!?]\s|^)[A-Z][a-z]+(?:\s+[A-Z][a-z]+)++"
NAME_STOP_WORDS = ["The", "This", "That", "These", "New", "San", "Los", "Las", "United"]
PAIR_SEPARATORS = [":", "=", "-"]
PAIR_KEY_LIMIT = 50

# Landed API pages: envelope keys in order of preference.
ENVELOPE_KEYS = ["results", "items", "data"]

# HTML: elements dropped with their content, and elements that become lines.
FURNITURE_TAGS = ["script", "style", "nav", "footer", "header"]
BLOCK_TAGS = ["h1", "h2", "h3", "h4", "p", "li", "pre", "code"]
# Elements without an end tag.
VOID_TAGS = [
    "area", "base", "basefont", "bgsound", "br", "col", "command", "embed", "frame", "hr",
    "image", "img", "input", "isindex", "keygen", "link", "menuitem", "meta", "nextid",
    "param", "source", "spacer", "track", "wbr",
]
# Elements whose text belongs to themselves alone.
OWN_TEXT_TAGS = ["rp", "rt", "script", "style", "template"]

# Character chunks: separators from coarse to fine.
CHUNK_SEPARATORS = ["\n\n", "\n", ". ", " ", ""]

# A character beyond ASCII for which the Unicode meaning of a class matters.
CLASSED_BEYOND_ASCII = r"(?U)[\x80-\x{10ffff}&&[\w\s]]"


def without_unicode_classes(pattern: str) -> str:
    """The pattern for ASCII texts, where both meanings of the classes agree."""
    return pattern.removeprefix("(?U)").replace("(?iu)", "(?i)")

"""Text cleaning, one column in and one column out."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column
from pyspark.sql import functions as F

from . import fixed_values as fixed
from .blank import is_ascii, let, strip


def _holds(t: Column, *needles: str) -> Column:
    condition = F.contains(t, F.lit(needles[0]))
    for needle in needles[1:]:
        condition = condition | F.contains(t, F.lit(needle))
    return condition


def _replace_where(c: Column, needles: list[str], pattern: str, replacement: str) -> Column:
    """Replace matches, skipping the pattern for texts without any of ``needles``.

    A search for a literal costs a fraction of a pass with a pattern.
    """
    return let(
        c,
        lambda t: F.when(_holds(t, *needles), F.regexp_replace(t, pattern, replacement)).otherwise(t),
    )


def normalize_whitespace(c: Column) -> Column:
    """Shorten newline runs, then blank runs, then trim around newlines."""
    c = _replace_where(c, ["\n\n\n"], fixed.EXCESS_NEWLINES, "\n\n")
    c = _replace_where(c, ["  ", "\t"], fixed.BLANK_STRETCH, " ")
    return _replace_where(c, [" \n", "\n "], fixed.BLANKS_AROUND_NEWLINE, "\n")


def remove_html_tags(c: Column) -> Column:
    return _replace_where(c, ["<"], fixed.HTML_TAG, "")


def mask_urls(c: Column) -> Column:
    return _replace_where(c, ["://"], fixed.URL_TO_MASK, fixed.URL_MASK)


def mask_emails(c: Column) -> Column:
    return _replace_where(c, ["@"], fixed.EMAIL_TO_MASK, fixed.EMAIL_MASK)


def fold_unicode(c: Column) -> Column:
    """Typographic quotes, en dash, ellipsis and no-break space to ASCII."""

    def fold(t: Column) -> Column:
        for typographic, plain in fixed.FOLDED_CHARACTERS.items():
            t = F.replace(t, F.lit(typographic), F.lit(plain))
        return t

    return let(c, lambda t: F.when(is_ascii(t), t).otherwise(fold(t)))


def drop_control_characters(c: Column) -> Column:
    return F.regexp_replace(c, fixed.CONTROL_CHARACTERS, "")


@dataclass(frozen=True)
class CleaningOptions:
    """Switches of :func:`clean_text`; the steps always run in this order."""

    normalize_whitespace: bool = True
    remove_html: bool = True
    remove_urls: bool = False
    remove_emails: bool = True
    normalize_unicode: bool = True
    remove_control_chars: bool = True


def clean_text(c: Column, options: CleaningOptions = CleaningOptions()) -> Column:
    """All enabled steps in order, then a final strip."""
    steps = [
        (options.normalize_whitespace, normalize_whitespace),
        (options.remove_html, remove_html_tags),
        (options.remove_urls, mask_urls),
        (options.remove_emails, mask_emails),
        (options.normalize_unicode, fold_unicode),
        (options.remove_control_chars, drop_control_characters),
    ]
    for enabled, step in steps:
        if enabled:
            c = step(c)
    return strip(c)


def clean_markdown(c: Column) -> Column:
    """Drop what crawling leaves in Markdown, then :func:`clean_text`."""
    c = F.regexp_replace(c, fixed.NAVIGATION_PHRASE, "")
    c = F.regexp_replace(c, fixed.COOKIE_BANNER, "")
    c = _replace_where(c, ["--", "==", "-=", "=-"], fixed.LONG_RULE, fixed.SHORT_RULE)
    c = _replace_where(c, ["#"], fixed.EMPTY_HEADER, "")
    c = _replace_where(c, ["\n#"], fixed.HEADER_AFTER_BLANK_LINES, "\n\n$1")
    return clean_text(c)


def deduplicate_paragraphs(c: Column) -> Column:
    """Keep the first of the paragraphs equal up to case and outer blanks.

    Sorting (key, position, paragraph) puts equal paragraphs side by side, so
    a text of n paragraphs costs n log n in its row and no shuffle.
    """
    keyed = F.filter(
        F.transform(
            F.split(c, fixed.PARAGRAPH_BREAK),
            lambda p, i: F.struct(F.lower(strip(p)).alias("key"), i.alias("at"), p.alias("text")),
        ),
        lambda p: p["key"] != "",
    )
    firsts = let(
        F.sort_array(keyed),
        lambda s: F.filter(
            s, lambda p, i: (i == 0) | (F.get(s, F.greatest(i - 1, F.lit(0)))["key"] != p["key"])
        ),
    )
    in_order = F.sort_array(F.transform(firsts, lambda p: F.struct(p["at"], p["text"])))
    return F.array_join(F.transform(in_order, lambda p: p["text"]), fixed.PARAGRAPH_BREAK)

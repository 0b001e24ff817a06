"""Names and request addresses made from URLs."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Scheme, authority and path of a URL (RFC 3986), and the
# parameters behind the last path segment.
URL_PARTS = r"^(?:[a-zA-Z][a-zA-Z0-9+.-]*:)?(?://([^/?#]*))?([^?#]*)"
SEGMENT_PARAMETERS = r";[^/]*$"


def url_filename(url: Column) -> Column:
    """``host_with_underscores_path_with_underscores.md``; the query does not count."""
    cleaned = F.regexp_replace(F.regexp_replace(url, r"^[\x00-\x20]+", ""), r"[\t\r\n]", "")
    host = F.replace(F.regexp_extract(cleaned, URL_PARTS, 1), F.lit("."), F.lit("_"))
    path = F.regexp_replace(F.regexp_extract(cleaned, URL_PARTS, 2), SEGMENT_PARAMETERS, "")
    path = F.replace(F.btrim(path, F.lit("/")), F.lit("/"), F.lit("_"))
    return F.concat(host, F.lit("_"), F.when(path == "", "index").otherwise(path), F.lit(".md"))


def page_url(
    base: Column, page: Column, page_param: str = "page", per_page_param: str = "per_page",
    per_page: int = 30,
) -> Column:
    """Address of one page of a paginated endpoint."""
    separator = F.when(F.contains(base, F.lit("?")), "&").otherwise("?")
    return F.concat(
        base, separator, F.lit(f"{page_param}="), page.cast("string"),
        F.lit(f"&{per_page_param}={per_page}"),
    )

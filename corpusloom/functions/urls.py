"""URL handling as column expressions. They accept any string; a malformed URL never fails a job."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

from corpusloom.functions.text import as_column

_AUTHORITY = r"^([A-Za-z][A-Za-z0-9+.\-]*:)?//[^/?#]*"
_SCHEME = r"^[A-Za-z][A-Za-z0-9+.\-]*:"

# Fixed pattern of the stories-by-domain report.
DOMAIN = "https?://([^/]+)"


def domain(url: Column | str) -> Column:
    """Host of an http(s) URL, empty when there is none."""
    return F.regexp_extract(as_column(url), DOMAIN, 1)


def host(url: Column | str) -> Column:
    return F.lower(F.regexp_extract(as_column(url), r"^(?:[A-Za-z][A-Za-z0-9+.\-]*:)?//([^/?#]*)", 1))


def without_fragment(url: Column | str) -> Column:
    return F.regexp_replace(as_column(url), "(?s)#.*$", "")


def canonical_url(url: Column | str) -> Column:
    """Visited-set key: lower-cased host, path and query; no scheme, no fragment."""
    url = as_column(url)
    return F.concat(host(url), F.regexp_replace(without_fragment(url), _AUTHORITY, ""))


def _tidy_path(path: Column) -> Column:
    """Resolve ``.`` and ``..`` segments of an absolute path."""
    segments = F.split(path, "/")
    last = F.element_at(segments, -1)
    kept = F.aggregate(
        segments,
        F.array().cast("array<string>"),
        lambda seen, part: F.when(part == ".", seen)
        .when(part == "..", F.slice(seen, F.lit(1), F.greatest(F.size(seen) - 1, F.lit(1))))
        .otherwise(F.concat(seen, F.array(part))),
    )
    joined = F.array_join(kept, "/")
    tail = F.when(last.isin(".", "..") & ~joined.endswith("/"), F.concat(joined, F.lit("/"))).otherwise(joined)
    return F.when(path.rlike(r"(^|/)\.\.?(/|$)"), tail).otherwise(path)


def resolve_url(base: Column | str, href: Column | str) -> Column:
    """Absolute form of ``href`` as found on the page at ``base``."""
    base, href = as_column(base), as_column(href)
    site = F.regexp_extract(base, _AUTHORITY, 0)
    page = F.regexp_replace(without_fragment(base), r"(?s)\?.*$", "")
    path = F.regexp_replace(page, _AUTHORITY, "")
    folder = F.regexp_extract(path, "(?s)^(.*/)", 1)
    folder = F.when(folder == "", F.lit("/")).otherwise(folder)
    target = F.regexp_extract(href, r"(?s)^[^?#]*", 0)
    extra = F.regexp_extract(href, r"(?s)[?#].*$", 0)
    return (
        F.when(href.rlike(_SCHEME), href)
        .when(href.startswith("//"), F.concat(F.regexp_extract(base, _SCHEME, 0), href))
        .when(href == "", base)
        .when(href.startswith("#"), F.concat(without_fragment(base), href))
        .when(href.startswith("?"), F.concat(page, href))
        .when(href.startswith("/"), F.concat(site, _tidy_path(target), extra))
        .otherwise(F.concat(site, _tidy_path(F.concat(folder, target)), extra))
    )


def is_same_site(base: Column | str, href: Column | str) -> Column:
    """Site-relative links and absolute links to the page's own host; ``//other-host`` does not count."""
    base, href = as_column(base), as_column(href)
    return (href.startswith("/") & ~href.startswith("//")) | ((host(href) != "") & (host(href) == host(base)))

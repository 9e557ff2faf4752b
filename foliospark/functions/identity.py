"""Stable identities, normalised URLs, calendar dates and catalogue paths.

What Catalyst can express comes as Columns; what needs a URL parser comes as plain functions, for use
within Arrow functions.
"""

from __future__ import annotations

import hashlib
import posixpath
import re
import unicodedata
from datetime import UTC, datetime
from urllib.parse import quote, quote_plus, unquote_plus, urljoin

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.functions import pandas_udf

#: Ports that a normalised URL leaves out.
DEFAULT_PORTS = {"http": 80, "https": 443}
#: Characters that stay as they are in the parts of a resolved URL.
SAFE_PATH = "/:@!$&'*+,;=-._~%"
SAFE_QUERY = "=&?/:;+,%@!$'*[]-._~"
SAFE_FRAGMENT = "?/:;+,%@!$&'*[]=-._~"
#: Error codes of timestamps.
INVALID_TIMESTAMP, NAIVE_TIMESTAMP, MISSING_TIMESTAMP = "invalid_timestamp", "naive_timestamp", "missing_publication_timestamp"


def clean_text(value: str) -> str:
    """All Unicode whitespace collapsed to single spaces, NFC."""
    return unicodedata.normalize("NFC", " ".join(value.split()))


#: scheme, site (what stands between "//" and the path), path, query, fragment
_PARTS = re.compile(r"(?:(?P<scheme>[A-Za-z][A-Za-z0-9+.-]*):)?(?P<site>//[^/?#]*)?(?P<path>[^?#]*)(?P<query>\?[^#]*)?(?P<fragment>#.*)?", re.S)
#: user and password, host (an address in brackets, or a name), port
_SITE = re.compile(r"(?:.*@)?(?:\[(?P<address>[^\[\]]*)\]|(?P<name>[^:\[\]]*))(?::(?P<port>[0-9]{0,5}))?", re.S)


class Url:
    """A URL taken apart. `host` is None where host or port cannot be read, and "" where there is none."""

    def __init__(self, text: str) -> None:
        m = _PARTS.fullmatch(re.sub(r"[\t\r\n]", "", text))
        self.scheme = (m["scheme"] or "").lower()
        self.path, self.query, self.fragment = m["path"], (m["query"] or "")[1:], (m["fragment"] or "")[1:]
        self.host, self.port = "", None
        site = _SITE.fullmatch((m["site"] or "//")[2:])
        if site is None or int(site["port"] or 0) > 65_535:
            self.host = None
        else:
            self.host = (site["name"] if site["address"] is None else site["address"]).lower().casefold()
            self.port = int(site["port"]) if site["port"] else None

    def is_web(self) -> bool:
        return self.scheme in DEFAULT_PORTS and bool(self.host)

    def site(self) -> str:
        """Host, and port if it is not the scheme's own."""
        usual = self.port is None or self.port == DEFAULT_PORTS.get(self.scheme)
        return self.host if usual else f"{self.host}:{self.port}"

    def text(self, path: str, query: str, fragment: str) -> str:
        """The URL put together with other parts behind its site."""
        out = f"{self.scheme}:" if self.scheme else ""
        if self.host or self.scheme in DEFAULT_PORTS:
            out += "//" + self.site() + ("" if path[:1] in ("", "/") else "/")
        return out + path + (f"?{query}" if query else "") + (f"#{fragment}" if fragment else "")


def sorted_query(query: str) -> str:
    """The pairs of a query, decoded, in order and encoded again; pairs without a value keep their "="."""
    pairs = [p.partition("=")[::2] for p in query.split("&") if p]
    return "&".join(f"{quote_plus(k)}={quote_plus(v)}" for k, v in sorted((unquote_plus(k), unquote_plus(v)) for k, v in pairs))


def normalize_url(value: str) -> str:
    """Lower scheme and host, no default port, no trailing slashes, sorted query, no fragment.

    A URL whose port cannot be read stays as it is, trimmed.
    """
    trimmed = value.strip()
    url = Url(trimmed)
    return trimmed if url.host is None else url.text(url.path.rstrip("/"), sorted_query(url.query), "")


def resolve_url(value: str, base: str | None) -> str | None:
    """An absolute, quoted http(s) URL, or None."""
    if not value.strip():
        return None
    try:
        url = Url(urljoin(base or "", value.strip()))
    except ValueError:  # what urljoin refuses, such as half an address in brackets
        return None
    quoted = (quote(part, safe=safe) for part, safe in ((url.path, SAFE_PATH), (url.query, SAFE_QUERY), (url.fragment, SAFE_FRAGMENT)))
    return url.text(*quoted) if url.is_web() else None


def is_http_url(value: str | None) -> bool:
    """Whether a stored URL is http(s), free of whitespace, and has a host and a readable port."""
    return bool(value) and not any(map(str.isspace, value)) and Url(value).is_web()


def article_identity(own_id: str | None, canonical_url: str | None, html_sha256: str, namespace: str) -> str:
    """namespace:<id>, else url:<hash of the normalised URL>, else html:<hash of the bytes>."""
    if own_id and own_id.strip():
        return f"{namespace}:{own_id.strip()}"
    if canonical_url and canonical_url.strip():
        return "url:" + hashlib.sha256(normalize_url(canonical_url).encode()).hexdigest()
    return f"html:{html_sha256}"


def parse_timestamp(value: str | None) -> tuple[datetime | None, str | None]:
    """(instant in UTC, error code) of an ISO-8601 text; a blank one gives neither."""
    text = (value or "").strip()
    if not text:
        return None, None
    if text[-1] in "zZ":
        text = text[:-1] + "+00:00"
    try:
        at = datetime.fromisoformat(text)
    except ValueError:
        return None, INVALID_TIMESTAMP
    return (at.astimezone(UTC), None) if at.tzinfo else (None, NAIVE_TIMESTAMP)


def is_safe_relative_path(path: str | None) -> bool:
    """A relative path without empty, "." or ".." parts, backslashes or NULs."""
    return bool(path) and not path.startswith("/") and "\\" not in path and "\0" not in path and all(p not in ("", ".", "..") for p in path.split("/")) and posixpath.normpath(path) == path


@pandas_udf(T.StringType())
def normalized_url(url: pd.Series) -> pd.Series:
    """`normalize_url` for a column; null and blank give null."""
    return url.map(lambda u: normalize_url(u) if u and u.strip() else None)


def identity(own_id: Column, normal_url: Column, html_sha256: Column, namespace: str) -> Column:
    """`article_identity` for a URL that is normalised already."""
    trimmed = F.trim(own_id)
    return F.coalesce(F.when(trimmed != "", F.concat(F.lit(namespace + ":"), trimmed)), F.when(F.trim(normal_url) != "", F.concat(F.lit("url:"), F.sha2(normal_url, 256))), F.concat(F.lit("html:"), html_sha256))


def new_york_date(instant: Column) -> Column:
    """The New York calendar date of an instant, daylight saving included."""
    return F.to_date(F.from_utc_timestamp(instant, "America/New_York"))


def markdown_path(article_id: Column, date: Column) -> Column:
    """text/YYYY/MM/DD/<sha256 of the id>.md"""
    return F.concat(F.lit("text/"), F.date_format(date, "yyyy/MM/dd"), F.lit("/"), F.sha2(article_id, 256), F.lit(".md"))


def is_safe_path(c: Column) -> Column:
    """`is_safe_relative_path` as a column; null for null."""
    return c.rlike(r"(?s)\A(?!/)(?!.*//)(?!.*/\z)(?!.*(?:\A|/)\.\.?(?:/|\z))[^\\\x00]+\z")


def http_url(c: Column) -> Column:
    """`is_http_url` as a column; null for null."""
    port = r"0*(?:[0-9]{1,4}|[1-5][0-9]{4}|6[0-4][0-9]{3}|65[0-4][0-9]{2}|655[0-2][0-9]|6553[0-5])"
    return c.rlike(rf"(?i)\Ahttps?://(?:[^\s/?#]*@)?(?:\[[^\s\[\]]+\]|[^\s:/?#\[\]@]+)(?::(?:{port})?)?(?:[/?#]\S*)?\z")


def is_sha256(c: Column) -> Column:
    """Exactly 64 lower hexadecimal digits; a trailing line end does not pass."""
    return F.coalesce(c.rlike(r"\A[0-9a-f]{64}\z"), F.lit(False))


def escape_markdown(c: Column) -> Column:
    """Backslashes before the characters that Markdown reads."""
    return F.regexp_replace(c, r"([\\`*_\[\]{}|])", r"\\$1")


def is_safe_label(c: Column, longest: int = 128) -> Column:
    """A model label: letters, digits and . _ - / : of bounded length, no empty or dot-only part."""
    parts = F.split(c, "/")
    return F.coalesce(c.rlike(r"\A[A-Za-z0-9][A-Za-z0-9._:/-]*\z") & (F.octet_length(c) <= longest) & ~F.exists(parts, lambda p: p.isin("", ".", "..")), F.lit(False))

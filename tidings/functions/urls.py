"""URL functions: plain Python for the page transforms, Spark expressions where built-ins suffice."""

from __future__ import annotations

from urllib.parse import parse_qs, quote, unquote_plus, urlencode, urljoin, urlsplit, urlunsplit

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

# URL schemes that are kept as they are.
OPAQUE = ("data:", "mailto:", "tel:")


def resolve_url(url: str | None, base: str | None) -> str | None:
    """Absolute form against a base; empty and opaque URLs stay."""
    if not url or url.strip().lower().startswith(OPAQUE) or not base:
        return url
    try:
        return urljoin(base, url)
    except ValueError:
        return url


def source_url(base: str, path: str) -> str:
    """Page of a notice: an absolute path as it is, a query appended to the base, anything else resolved against it."""
    if path.startswith(("http://", "https://")):
        return path
    if path.startswith("?"):
        return base + path
    return urljoin(base, path)


def origin_url(base: str, path: str) -> str:
    """Attachment address of the standard board: paths count from the host, queries from the board."""
    if path.startswith("http"):
        return path
    if path.startswith("?"):
        return base + path
    parts = urlsplit(base)
    return f"{parts.scheme}://{parts.netloc}/{path.lstrip('/')}" if not path.startswith("/") else f"{parts.scheme}://{parts.netloc}{path}"


def query_value(url: str, name: str) -> str | None:
    """One decoded query parameter; '+' reads as a space."""
    for pair in urlsplit(url).query.split("&"):
        key, _, value = pair.partition("=")
        if key == name and value:
            return unquote_plus(value)
    return None


def without_param(url: str, name: str) -> str:
    """The URL with one query parameter gone and the others encoded anew."""
    p = urlsplit(url)
    kept = {k: v for k, v in parse_qs(p.query).items() if k != name}
    return urlunsplit(p._replace(query=urlencode(kept, doseq=True)))


def with_missing_params(query: str, extra: dict[str, str]) -> str:
    """A query string with the extra parameters that it lacks."""
    flat = {k: v[0] for k, v in parse_qs(query, keep_blank_values=True).items()}
    return urlencode(flat | {k: v for k, v in extra.items() if k not in flat})


def quoted_query(params: dict[str, object]) -> str:
    return "&".join(f"{quote(str(k))}={quote(str(v))}" for k, v in params.items())


# Spark forms


def host(url: Column) -> Column:
    """Lower-case host; null where the URL has none or can't be read."""
    return F.lower(F.try_parse_url(url, F.lit("HOST")))


def host_allowed(url: Column, suffixes: list[str], strict: bool = False) -> Column:
    """Does the host end in one of the suffixes? `strict` also asks for a dot or nothing before the suffix."""
    out = F.lit(False)
    h = F.coalesce(host(url), F.lit(""))
    for s in suffixes:
        out = out | ((h == s) | h.endswith("." + s) if strict else h.endswith(s))
    return out


def query_param(url: Column, name: str) -> Column:
    return F.try_url_decode(F.try_parse_url(url, F.lit("QUERY"), F.lit(name)))


def drop_param(url: Column, name: str) -> Column:
    """Without one query parameter, the others untouched (no fragment behind them)."""
    gone = F.regexp_replace(url, rf"([?&]){name}=[^&]*(&|$)", "$1")
    return F.regexp_replace(gone, r"[?&]$", "")


@F.pandas_udf(T.StringType())
def resolve_url_udf(url: pd.Series, base: pd.Series) -> pd.Series:
    return pd.Series([resolve_url(u, b) for u, b in zip(url, base)], dtype=object)


@F.pandas_udf(T.StringType())
def source_url_udf(base: pd.Series, path: pd.Series) -> pd.Series:
    return pd.Series([None if b is None or p is None else source_url(b, p) for b, p in zip(base, path)], dtype=object)


def source_url_expr(base: Column, path: Column) -> Column:
    """`source_url`, with Python only for paths that must be resolved."""
    absolute = path.startswith("http://") | path.startswith("https://")
    return F.when(absolute, path).when(path.startswith("?"), F.concat(base, path)).otherwise(source_url_udf(base, path))

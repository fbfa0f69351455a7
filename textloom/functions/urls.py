"""URL parts and canonical form as built-in expressions.

Parts are taken with the generic URI pattern rather than a URI parser, so a
malformed link gives parts, not an error or a NULL.
"""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column
from pyspark.sql import functions as F

from textloom.functions import fixed

_URI = r"^(?:([^:/?#]+):)?(?://([^/?#]*))?([^?#]*)(?:\?([^#]*))?(?:#(.*))?"
_SCHEME, _AUTHORITY, _PATH, _QUERY = 1, 2, 3, 4
# Characters a path keeps as they are; all others are percent-encoded.
_PLAIN_PATH = r"^[A-Za-z0-9/._~!$&'()*+,;=:@\[\]-]*$"
# Escapes the form encoder makes of characters a path keeps.
_PATH_KEPT = {
    "+": "%20", "%2F": "/", "%3A": ":", "%40": "@", "%21": "!", "%24": "$", "%26": "&",
    "%27": "'", "%28": "(", "%29": ")", "%2B": "+", "%2C": ",", "%3B": ";", "%3D": "=",
    "%7E": "~", "%5B": "[", "%5D": "]", "%25": "%",
}


def _part(url: Column, group: int) -> Column:
    return F.regexp_extract(url, _URI, group)


def host(url: Column) -> Column:
    """Host name in lower case, without user or port."""
    without_user = F.regexp_replace(_part(url, _AUTHORITY), r"^[^@]*@", "")
    return F.lower(F.regexp_replace(without_user, r":\d*$", ""))


def ascii_authority(url: Column) -> Column:
    """Authority in lower case, host labels of other scripts as Punycode (IDNA of 2003),
    without an empty port. A host without such a form, as one with a label of more than 63
    characters, stays; so do user and port.

    The JVM's own encoder is called, and only for authorities that are not ASCII.
    """
    own = F.regexp_replace(F.lower(_part(url, _AUTHORITY)), ":$", "")
    user, name, port = (F.regexp_extract(own, r"^([^@]*@)?(.*?)(:\d*)?$", k) for k in (1, 2, 3))
    # 1: code points newer than the rule's tables are let through.
    encoded = F.try_reflect(F.lit("java.net.IDN"), F.lit("toASCII"), name, F.lit(1))
    full = F.coalesce(F.concat(user, F.lower(encoded), port), own)
    return F.when(own.rlike(r"[^\x00-\x7F]"), full).otherwise(own)


def path(url: Column) -> Column:
    return _part(url, _PATH)


def path_and_query(url: Column) -> Column:
    """What robots rules are matched with: path and query, ``/`` when empty."""
    query = F.regexp_extract(url, r"^[^?#]*(\?[^#]*)", 1)
    own_path = path(url)
    return F.concat(F.when(own_path == "", "/").otherwise(own_path), query)


def _escapes_upper(text: Column) -> Column:
    """Escapes with upper-case digits, everything else as it is."""
    parts = F.transform(
        F.split(text, "%"),
        lambda part, i: F.when((i == 0) | ~part.rlike("^[0-9A-Fa-f]{2}"), part).otherwise(
            F.concat(F.upper(F.substring(part, 1, 2)), F.substr(part, F.lit(3)))
        ),
    )
    return F.array_join(parts, "%")


def _no_text(decoded: Column, source: Column) -> Column:
    """True where escapes were no UTF-8: decoding put replacement characters in, which
    would make one URL of many."""
    given = F.upper(source).contains("%EF%BF%BD") | source.contains("\ufffd")
    return F.coalesce(decoded.contains("\ufffd") & ~given, F.lit(False))


def _canonical_path(url: Column) -> Column:
    own = path(url)
    # '+' is no space in a path, and an escaped '/' or '?' must stay escaped.
    guarded = F.replace(own, F.lit("+"), F.lit("%2B"))
    guarded = F.regexp_replace(guarded, r"%([23])[Ff]", "%25$1F")
    decoded = F.try_url_decode(guarded)
    encoded = F.url_encode(F.coalesce(decoded, own))
    for escape, char in _PATH_KEPT.items():
        encoded = F.replace(encoded, F.lit(escape), F.lit(char))
    return (
        F.when(own == "", "/").when(own.rlike(_PLAIN_PATH), own)
        .when(_no_text(decoded, own), _escapes_upper(own)).otherwise(encoded)
    )


def _canonical_query(url: Column) -> Column:
    def canonical(text: Column) -> Column:
        decoded = F.try_url_decode(text)
        encoded = F.url_encode(F.coalesce(decoded, text))
        encoded = F.replace(
            F.replace(encoded, F.lit("*"), F.lit("%2A")), F.lit("%7E"), F.lit("~")
        )
        return F.when(_no_text(decoded, text), _escapes_upper(text)).otherwise(encoded)

    def order(text: Column) -> Column:
        return F.coalesce(F.try_url_decode(text), text)

    def pair(arg: Column) -> Column:
        key = F.regexp_extract(arg, r"^([^=]*)", 1)
        value = F.regexp_extract(arg, r"^[^=]*=(.*)$", 1)
        return F.struct(
            order(key).alias("k"), order(value).alias("v"),
            canonical(key).alias("key"), canonical(value).alias("value"),
        )

    args = F.filter(F.split(_part(url, _QUERY), "&"), lambda arg: arg != "")
    pairs = F.sort_array(F.transform(args, pair))
    return F.array_join(
        F.transform(pairs, lambda p: F.concat_ws("=", p["key"], p["value"])), "&"
    )


def canonical_url(url: Column) -> Column:
    """One form for URLs that fetch the same thing: query sorted, fragment and empty port
    gone, host in ASCII. Escapes that are no UTF-8 stay escapes. URLs without an authority
    (``mailto:``) only lose their fragment."""
    query = _canonical_query(url)
    full = F.concat(
        F.lower(_part(url, _SCHEME)),
        F.lit("://"),
        ascii_authority(url),
        _canonical_path(url),
        F.when(_part(url, _QUERY).rlike("[^&]"), F.concat(F.lit("?"), query)).otherwise(""),
    )
    opaque = url.rlike(r"^[A-Za-z][A-Za-z0-9+.-]*:(?!//)")
    return F.when(opaque, F.regexp_replace(url, "#.*$", "")).otherwise(full)


def admitted(
    url: Column,
    deny: Iterable[str] = fixed.DENY_PATTERNS,
    deny_extensions: Iterable[str] = fixed.DENY_EXTENSIONS,
    max_length: int = fixed.MAX_URL_LENGTH,
) -> Column:
    """True for a URL worth following: not denied by pattern, type or length."""
    own_path = F.lower(path(url))
    keep = ~url.contains("robots.txt") & (F.length(url) <= max_length)
    deny, deny_extensions = list(deny), list(deny_extensions)
    if deny:
        keep = keep & ~url.rlike("|".join(f"(?:{pattern})" for pattern in deny))
    if deny_extensions:
        keep = keep & ~own_path.rlike(rf"\.(?:{'|'.join(deny_extensions)})$")
    return keep


def in_domains(url: Column, domains: Iterable[str] = ()) -> Column:
    """True when the host is one of ``domains`` or below one; no domains, no limit."""
    domains = [domain.lower() for domain in domains]
    if not domains:
        return F.lit(True)
    own = host(url)
    inside = own.isin(*domains)
    for domain in domains:
        inside = inside | own.endswith(f".{domain}")
    return inside
